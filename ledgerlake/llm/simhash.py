"""Operator 13: near duplicates by SimHash, compared exactly in tiles.

A fingerprint has 64 bits; bit k is 1 if more than half of the text's shingle
hashes have it.  Shingles are ``size`` words, repeats included; their hash is
XXH64 of the words joined by a space.  Fingerprints within ``radius`` bits link.

Two fingerprints within the radius differ by no more in their population counts:
the counts of any disjoint parts differ by ``radius`` together at most.  So

1. distinct fingerprints are sorted by the counts of their halves, quarters and
   eighths and cut into tiles of at most ``TILE``, each with one pair of counts of
   its halves (its cell) and the least and greatest count of every eighth;
2. tiles meet through a join on the cells within the radius; tile pairs whose
   eighths differ beyond it are skipped before any fingerprint is sent;
3. a task compares a pair of tiles by exclusive-or and bit counts, strip by strip,
   again skipping strips whose counts differ beyond the radius, and returns which
   fingerprints are connected: one link per fingerprint, never the pairs;
4. components of those links by large and small stars.

Every pair within the radius is compared, so the result is exact.  The work is
that of comparing all distinct fingerprints with those of near counts: it grows
with the square of their number, times the small share that the counts leave.

Defined cases: texts of fewer words have one shingle, all their words; NULL and
empty texts and those without words have the fingerprint zero, which links like any
other; repeated rows and equal fingerprints are one node and all returned;
rows with a NULL id are returned and link others, but name no component (one
without any id has the component NULL); an empty table gives no rows.  Only
doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, staged
from .components import components, merge_classes

SIZE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a tile, and in a strip of one.
TILE = 1 << 14
STRIP = 128
#: Strips compared with one strip at a time.
STRIPS = 8
#: Bytes of text and shingles hashed at a time.
SLICE = 2 << 20
BLOCK = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(raw: bytes, size: int = SIZE) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a text, in blocks."""
    from xxhash import xxh64_intdigest as xxh

    words = raw.translate(_LOWER).split()
    if not words:
        return
    text = b" ".join(words)
    if len(words) < size:
        yield np.array([xxh(text, SEED)], np.uint64)
        return
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    for k in range(0, len(starts), BLOCK):
        yield np.array([xxh(text[a:b], SEED) for a, b in zip(starts[k : k + BLOCK], ends[k : k + BLOCK])], np.uint64)


def fingerprint(raw: bytes, size: int = SIZE) -> int:
    """The fingerprint of a text, unsigned."""
    set_bits, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(raw, size):
        # little-endian bytes and bits: column k is bit k
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * set_bits > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed number) of every document."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part in byte_slices(batches, limit=SLICE):
            fps = np.array([fingerprint(t.encode() if t else b"", size) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(fps.view(np.int64))], ["doc_id", "fp"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _count(fp, part: int, parts: int):
    """Column: the population count of one of ``parts`` equal parts of ``fp``."""
    width = 64 // parts
    return F.bit_count(fp.bitwiseAND(F.lit(((1 << width) - 1) << (width * part) if part < parts - 1 else -1 << (64 - width))))


def tiles(fps: DataFrame, tile: int = TILE) -> DataFrame:
    """tile (its first fingerprint), low, high (its cell), least, most (of each eighth), raw: the fingerprints."""
    fp = F.col("fp")
    order = [_count(fp, 0, 2).alias("low"), _count(fp, 1, 2).alias("high")]
    order += [_count(fp, k, 4).alias(f"q{k}") for k in (0, 2)] + [_count(fp, k, 8).alias(f"e{k}") for k in (0, 2, 4, 6)]
    counted = fps.select(*order, "fp")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(cell, raw):
            fps = np.concatenate(raw)
            for k in range(0, len(fps), tile):
                one = fps[k : k + tile]
                eighths = np.bitwise_count(one.view(np.uint8).reshape(-1, 8))
                least, most = eighths.min(axis=0).tolist(), eighths.max(axis=0).tolist()
                yield (int(one[0]), *cell, least, most, one.tobytes())

        def batch(found):
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found), kinds)], ["tile", "low", "high", "least", "most", "raw"]
            )

        held, raw, size = None, [], 0
        for part in batches:
            low, high = (part.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            fps = part.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            edges = np.flatnonzero((low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(fps)]):
                if a == b:
                    continue
                cell = (int(low[a]), int(high[a]))
                if raw and (cell != held or size >= tile):
                    yield batch(rows(held, raw))
                    raw, size = [], 0
                held = cell
                raw.append(fps[a:b])
                size += b - a
        if raw:
            yield batch(rows(held, raw))

    names = [c for c in counted.columns]
    return (
        counted.repartitionByRange(parts, *names)
        .sortWithinPartitions(*names)
        .mapInArrow(cut, "tile long, low int, high int, least array<int>, most array<int>, raw binary")
    )


def tile_pairs(tiled: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: the pairs of tiles (a tile and itself included) whose counts are within the radius."""
    near = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if abs(i) + abs(j) <= radius]
    # of a cell and another one, the lesser looks for the greater
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in near if (i, j) >= (0, 0)])
    one = tiled.select(F.col("tile").alias("a"), "low", "high", F.col("least").alias("l1"), F.col("most").alias("m1"))
    one = one.withColumn("step", F.explode(steps)).select(
        "a", (F.col("low") + F.col("step.i")).alias("low"), (F.col("high") + F.col("step.j")).alias("high"),
        "l1", "m1", (F.col("step") == F.struct(F.lit(0), F.lit(0))).alias("same"),
    )
    other = tiled.select(F.col("tile").alias("b"), "low", "high", F.col("least").alias("l2"), F.col("most").alias("m2"))
    gap = sum(
        (F.greatest(F.lit(0), F.col("l1")[k] - F.col("m2")[k], F.col("l2")[k] - F.col("m1")[k]) for k in range(8)), F.lit(0)
    )
    return one.join(other, ["low", "high"]).filter((~F.col("same") | (F.col("a") <= F.col("b"))) & (gap <= radius)).select("a", "b")


def connected(x: np.ndarray, y: np.ndarray, radius: int = RADIUS, strip: int = STRIP) -> np.ndarray:
    """Labels of the fingerprints of two tiles (first x's, then y's): the place of one of their class.

    Classes are those of the links between x and y (unsigned numbers); memory is that of
    one strip against a few.
    """
    label = np.arange(len(x) + len(y))
    sx, sy = np.arange(0, len(x), strip), np.arange(0, len(y), strip)
    ex, ey = (np.bitwise_count(v.view(np.uint8).reshape(-1, 8)).astype(np.int16) for v in (x, y))
    low_x, high_x = np.minimum.reduceat(ex, sx), np.maximum.reduceat(ex, sx)
    low_y, high_y = np.minimum.reduceat(ey, sy), np.maximum.reduceat(ey, sy)
    for k, at in enumerate(sx.tolist()):
        gap = np.maximum(0, np.maximum(low_x[k] - high_y, low_y - high_x[k])).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        for some in np.split(near, range(STRIPS, len(near), STRIPS)):
            places = (some[:, None] * strip + np.arange(strip)).ravel()
            places = places[places < len(y)]
            differ = np.bitwise_count(x[at : at + strip, None] ^ y[places])
            if len(places) and differ.min() <= radius:
                i, j = np.nonzero(differ <= radius)
                merge_classes(label, i + at, places[j] + len(x))
    return label


def tile_links(tiled: DataFrame, pairs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """u, v: links that connect the fingerprints within the radius, at most one per fingerprint and tile pair."""
    raw = tiled.select("tile", "raw")
    both = pairs.join(raw.select(F.col("tile").alias("a"), F.col("raw").alias("x")), "a").join(
        raw.select(F.col("tile").alias("b"), F.col("raw").alias("y")), "b"
    )

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in ("x", "y"))
                label = connected(x, y, radius)
                moved = np.flatnonzero(label != np.arange(len(label)))
                if len(moved):
                    all_fps = np.concatenate((x, y)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(all_fps[moved]), pa.array(all_fps[label[moved]])], ["u", "v"]
                    )

    return both.select("x", "y").mapInArrow(compare, "u long, v long").filter("u <> v")


def near_groups(docs: DataFrame, radius: int = RADIUS, size: int = SIZE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every document."""
    rows = staged(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), size), "op13-rows")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    tiled = staged(tiles(nodes.select("fp")), "op13-tiles")
    links = tile_links(tiled, tile_pairs(tiled, radius), radius)
    comp = components(links, "op13-cc")
    named = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = staged(named, "op13-named")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    names = named.join(ids, "component").select("fp", "component_id")
    return rows.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
