"""Operator 1: n-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct 5-word shingles.  Sizes fall into bands
[2^i, 2^(i+1)); band i has an instance that cuts the shingle domain into m_i
partitions.  A set's signatures in an instance are its non-empty projections on
the partitions.  Sets A and B (|A| <= |B|) with Jaccard similarity t >= 0.75
differ in at most d = (|A|+|B|)/7 shingles, so they disagree on at most d
partitions: if B has more than 2|B|/7 >= d non-empty projections in its own
band's instance, A and B share one of them.  m_i is raised until that holds for
every set of the band (measured over all sets), so no link is lost.  A set
signs in its own band and, if a linked set can be that large, in the next one.
Small sets (under 32 shingles) take one partition per shingle.

What is done with signatures that several sets share:

1. equal sets are one node from the start;
2. every node is checked against one node of its groups at a time: first the
   smallest one it shares most signatures with, then, while that finds links,
   the most central one of another component.  The links found give components,
   so a large group of near copies collapses before pairs are looked at;
3. pairs across the components that are left: signatures are ranked by how many
   nodes still share them.  Of a linked pair either set lacks d signatures of the
   other at most, so their first t shared signatures lie among the first d + t of
   both, and frequent ones come last in the ranking.  Pairs that share signatures
   of few nodes are joined and counted, and those that share enough are checked;
   nodes of a signature that many look at are compared in tiles, by exact
   intersections as products of 0/1 matrices, which return links, never pairs.

Checks are exact intersections of the whole shingle sets.  Shingles, sets and
signatures are 64-bit hashes.

Defined cases: NULL and empty texts, and those without words, have no shingles
and are linked with nothing (their component is their own id); fewer than five
words are one shingle; repeated rows are one node and all returned; a component
is named by its smallest non-NULL id; rows with a NULL id are compared and linked
like others, they only name nothing; an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, discard, staged
from .components import components, merge_classes
from .shingles import _STEP, mix, shingle_sets

#: Similarity 3/4, as whole numbers: 4 * intersection >= 3 * union.
PART, WHOLE = 3, 4
SMALL_BAND = 5
#: Most rounds of checks against central nodes before the remaining pairs are counted.
ROUNDS = 1
#: Bytes of text hashed at a time, and signatures sent at a time: they bound a task's memory.
SLICE = 2 << 20
BLOCK = 1 << 20
#: Signatures grouped at a time.
RANGE = 1 << 18
#: Members checked against one node in one task, and checks a set is sent to at a time.
STAR = 4096
#: Nodes that look at a signature, up to which their pairs are joined; beyond, they are
#: compared in tiles of about so many bytes, so many sets and shingles at a time.
GROUP = 64
TILE_BYTES = 8 << 20
TILE = 256
COLUMNS = 4096
#: Bits that tell the documents a step may need from the others before their texts are shuffled (1 MB).
BITS = 1 << 23
BITMAP = 1 << 15
#: Of n shingles, n / SPARE more signatures are looked at than must be shared in part.
SPARE = 16


def most_differing(n: int) -> int:
    """The most shingles a set of n can differ in from a linked set that is not larger."""
    return 2 * n * (WHOLE - PART) // (WHOLE + PART)


def band(n: int) -> int:
    return n.bit_length() - 1


def partitions(i: int, level: int = 0) -> int:
    """Partitions of instance i; 0: one per shingle."""
    return 0 if i < SMALL_BAND else ((1 << (i + 1)) * 5 // 12 + (i == SMALL_BAND) * 6) << level


def signatures(u: np.ndarray, mixed: np.ndarray, i: int, m: int) -> np.ndarray:
    """Hashes of the non-empty projections of a sorted set in instance i."""
    if m == 0:
        return mix(mixed + np.uint64(i))
    part = ((u >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # rises with u: runs of the sorted set
    first = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1))
    return mix(np.add.reduceat(mixed, first) + part[first] * _STEP + np.uint64(i))


def own_count(u: np.ndarray) -> tuple[int, int]:
    """Signatures in the set's own band, and how often that band's partitions must be
    doubled for the guarantee to hold for this set."""
    i, most, level = band(len(u)), most_differing(len(u)), 0
    if i < SMALL_BAND:
        return len(u), 0
    counts = []
    while not counts or counts[-1] <= most:
        part = ((u >> np.uint64(32)) * np.uint64(partitions(i, level))) >> np.uint64(32)
        counts.append(1 + int((part[1:] != part[:-1]).sum()))
        level += 1
    return counts[0], level - 1


def next_count(u: np.ndarray) -> int:
    """Signatures in the next band (before any doubling of its partitions)."""
    m = partitions(band(len(u)) + 1)
    if m == 0:
        return len(u)
    part = ((u >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    return 1 + int((part[1:] != part[:-1]).sum())


def set_key(u: np.ndarray) -> int:
    """Signed 64-bit hash of a whole set."""
    key = mix(np.array([mix(u ^ _STEP).sum() + np.uint64(len(u))], np.uint64))
    return int(key.view(np.int64)[0])


def _texts(part) -> list[bytes]:
    return [t.encode() if t else b"" for t in part.column("text").to_pylist()]


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n, node, sigs, next_sigs, level: one narrow row per document.

    Where a band is raised, the counts (of the own and of the next band) stay those
    before: a lower count only makes the later steps look at more.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part in byte_slices(batches, limit=SLICE):
            sets = shingle_sets(_texts(part))
            own = [own_count(u) if len(u) else (0, 0) for u in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    part.column("text_hash"),
                    pa.array([len(u) for u in sets], pa.int64()),
                    pa.array([set_key(u) if len(u) else 0 for u in sets], pa.int64()),
                    pa.array([n for n, _ in own], pa.int64()),
                    pa.array([next_count(u) if len(u) else 0 for u in sets], pa.int64()),
                    pa.array([level for _, level in own], pa.int32()),
                ],
                ["doc_id", "text_hash", "n", "node", "sigs", "next_sigs", "level"],
            )

    schema = "doc_id long, text_hash long, n long, node long, sigs long, next_sigs long, level int"
    return docs.select("doc_id", "text", _text_hash().alias("text_hash")).mapInArrow(run, schema)


def _labels(spark, parts: int) -> list[int]:
    """A number per bucket, chosen so that every bucket is hashed to a partition of its own."""
    spread = spark.range(64 * parts).select(F.col("id").cast("int").alias("label"))
    spread = spread.withColumn("part", F.pmod(F.hash("label"), F.lit(parts)))
    return [r["label"] for r in spread.groupBy("part").agg(F.min("label").alias("label")).orderBy("part").collect()]


def shared_signatures(docs: DataFrame, levels: dict[int, int]) -> DataFrame:
    """sig, node, n, own, members, hub, hub_n, hub_own: signatures that at least two nodes share.

    Tasks send each reducer one block per slice: sorted signatures and, for each,
    the place of its node in a small table.  ``own``: it is of the node's own
    band; ``members``: the group's size; ``hub``: its smallest node.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = lambda i: partitions(i, levels.get(i, 0))
    labels = _labels(docs.sparkSession, parts)

    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: set[int] = set()
        sigs, owner, own, nodes, sizes = [], [], [], [], []
        held = 0

        def block():
            sig, tag = np.concatenate(sigs), np.concatenate(owner) * 2 + np.concatenate(own)
            order = np.argsort(sig)
            sig, tag = sig[order], tag[order]
            # buckets are ranges of the signature hash
            bucket = ((sig >> np.uint64(32)) * np.uint64(len(labels))) >> np.uint64(32)
            cuts = np.searchsorted(bucket, np.arange(len(labels) + 1, dtype=np.uint64))
            node, size = np.array(nodes, np.int64), np.array(sizes, np.int64)
            rows = []
            for b in range(len(labels)):
                x, y = int(cuts[b]), int(cuts[b + 1])
                if x < y:
                    used, place = np.unique(tag[x:y] >> 1, return_inverse=True)
                    code = (place * 2 + (tag[x:y] & 1)).astype(np.uint32)
                    rows.append((labels[b], sig[x:y].tobytes(), code.tobytes(), node[used].tobytes(), size[used].tobytes()))
            for x in (sigs, owner, own, nodes, sizes):
                x.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 4)],
                ["bucket", "sigs", "codes", "nodes", "sizes"],
            )

        for part in byte_slices(batches, limit=SLICE):
            for u in shingle_sets(_texts(part)):
                n = len(u)
                node = set_key(u) if n else 0
                if not n or node in seen:
                    continue
                seen.add(node)
                mixed, i = mix(u), band(n)
                # a linked set is larger by a third at most: may it lie in the next band?
                for j in (i, i + 1) if WHOLE * n >= PART << (i + 1) else (i,):
                    s = signatures(u, mixed, j, count(j))
                    sigs.append(s)
                    owner.append(np.full(len(s), len(nodes), np.int32))
                    own.append(np.full(len(s), j == i, np.int32))
                    held += len(s)
                nodes.append(node)
                sizes.append(n)
                if held >= BLOCK:
                    yield block()
                    held = 0
        if held:
            yield block()

    def group(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def shared(blocks):
            sig = np.concatenate([b[0] for b in blocks])
            node = np.concatenate([b[2][b[1] >> 1] for b in blocks])
            size = np.concatenate([b[3][b[1] >> 1] for b in blocks])
            own = np.concatenate([b[1] for b in blocks]) & 1
            order = np.lexsort((node, sig))
            sig, node, size, own = sig[order], node[order], size[order], own[order]
            # a node seen by several tasks comes once
            new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])))
            sig, node, size, own = sig[new], node[new], size[new], own[new]
            starts = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
            length = np.diff(np.append(starts, len(sig)))
            keep = np.repeat(length > 1, length)
            own = own.astype(bool)
            cols = [sig.view(np.int64), node, size, own, np.repeat(length, length)]
            cols += [np.repeat(c[starts], length) for c in (node, size, own)]
            names = ["sig", "node", "n", "own", "members", "hub", "hub_n", "hub_own"]
            return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], names)

        def by_range(blocks):
            """The bucket in ranges of signatures: each holds all members of its groups."""
            total = sum(len(b[0]) for b in blocks)
            top = max(int(b[0][-1]) for b in blocks)
            low = min(int(b[0][0]) for b in blocks)
            pieces = total // RANGE + 1
            edges = [low + (top - low) * k // pieces for k in range(1, pieces)]
            cuts = [[0, *np.searchsorted(b[0], np.array(edges, np.uint64)).tolist(), len(b[0])] for b in blocks]
            for k in range(pieces):
                part = [(b[0][c[k] : c[k + 1]], b[1][c[k] : c[k + 1]], b[2], b[3]) for b, c in zip(blocks, cuts)]
                part = [b for b in part if len(b[0])]
                if part:
                    yield shared(part)

        bucket, blocks = None, []
        types = (np.uint64, np.uint32, np.int64, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                label, *raw = (batch.column(c)[k] for c in range(5))
                if label.as_py() != bucket and blocks:
                    yield from by_range(blocks)
                    blocks = []
                bucket = label.as_py()
                blocks.append(tuple(np.frombuffer(x.as_buffer(), t) for x, t in zip(raw, types)))
        if blocks:
            yield from by_range(blocks)

    blocks = docs.select("text").mapInArrow(sign, "bucket int, sigs binary, codes binary, nodes binary, sizes binary")
    return (
        blocks.repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(group, "sig long, node long, n long, own boolean, members long, hub long, hub_n long, hub_own boolean")
    )


def needed(docs: DataFrame, tasks: DataFrame) -> DataFrame:
    """``docs`` without most rows that no task names (``_id``, ``_hash``): a join with the rest shuffles few texts.

    A document's place in a fixed number of bits tells: rows that are named always stay,
    others stay where the place is taken too.  The bits are broadcast, so their number is
    not that of the tasks.
    """
    place = lambda i, h: F.pmod(F.xxhash64(i, h), F.lit(BITS))
    taken = tasks.select(place(F.col("_id"), F.col("_hash")).alias("place"))
    taken = taken.groupBy(F.floor(F.col("place") / BITMAP).alias("_map")).agg(
        F.bitmap_construct_agg(F.col("place") % BITMAP).alias("_bits")
    )
    mine = place(F.col("doc_id"), _text_hash())
    byte = F.floor(mine % BITMAP / 8).cast("int") + 1
    byte = F.conv(F.hex(F.col("_bits").substr(byte, F.lit(1))), 16, 10).cast("int")
    is_taken = F.getbit(byte, (mine % 8).cast("int")) == 1
    return docs.join(F.broadcast(taken), (F.floor(mine / BITMAP) == F.col("_map")) & is_taken, "left_semi")


def linked(docs: DataFrame, pairs: DataFrame, where: DataFrame) -> DataFrame:
    """u, v: the pairs (``hub``, ``node``) whose sets reach the similarity.

    ``where``: node -> doc_id and text_hash of one document with that set.  Each set is
    sent once per pair to its hub's task, the hub's set first; a hub with very many
    nodes is dealt out to several tasks, a node with very many hubs to several rows.
    """
    spark = docs.sparkSession
    load = pairs.groupBy("hub").agg((F.floor(F.count(F.lit(1)) / STAR) + 1).cast("int").alias("salts"))
    dealt = pairs.join(load, "hub").select("hub", "node", F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"))
    roles = dealt.select("node", "hub", "salt", F.lit(1).alias("kind")).unionByName(
        load.select(F.col("hub").alias("node"), "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"))
    )
    slots = roles.groupBy("node").agg((F.floor(F.count(F.lit(1)) / STAR) + 1).alias("slots"))
    tasks = (
        roles.join(slots, "node")
        .groupBy("node", F.pmod(F.xxhash64("hub", "salt"), "slots").alias("slot"))
        .agg(F.collect_list(F.struct("hub", "salt", "kind")).alias("roles"))
        .join(where, "node")
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "node", "roles")
    )
    tasks = staged(tasks, "op1-roles")
    mine = F.col("doc_id").eqNullSafe(F.col("_id")) & (_text_hash() == F.col("_hash"))
    texts = needed(docs.select("doc_id", "text"), tasks).join(tasks, mine).select("text", "node", "roles")

    def send(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part in byte_slices(batches, limit=SLICE):
            nodes, roles = part.column("node").to_pylist(), part.column("roles").to_pylist()
            rows = []
            for u, node, jobs in zip(shingle_sets(_texts(part)), nodes, roles):
                if len(u) and set_key(u) == node:  # equal hashes of unequal texts
                    raw = u.tobytes()
                    rows += [(j["hub"], j["salt"], j["kind"], node, raw) for j in jobs]
            for k in range(0, len(rows), 500):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[k : k + 500]), [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()])],
                    ["hub", "salt", "kind", "node", "raw"],
                )

    def check(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, hub_set = None, None
        for batch in batches:
            out = []
            for hub, salt, kind, node, raw in zip(*(batch.column(k).to_pylist() for k in range(5))):
                u = np.frombuffer(raw, np.uint64)
                if kind == 0:
                    held, hub_set = (hub, salt), u
                elif held == (hub, salt):
                    both = len(np.intersect1d(u, hub_set, assume_unique=True))
                    if WHOLE * both >= PART * (len(u) + len(hub_set) - both):
                        out.append((hub, node))
            cols = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["u", "v"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = texts.mapInArrow(send, "hub long, salt int, kind int, node long, raw binary")
    return (
        sent.repartition(parts, "hub", "salt")
        .sortWithinPartitions("hub", "salt", "kind")
        .mapInArrow(check, "u long, v long")
        .distinct()
    )


def _best_hub(shared: DataFrame, sigs: DataFrame, tried: DataFrame | None = None) -> DataFrame:
    """hub, node: for every node the hub it shares most with, if they may be linked.

    Of the larger set's own signatures a linked pair shares all but (n + hub_n) / 7.
    """
    node_larger = F.struct("n", "node") > F.struct("hub_n", "hub")
    counted = (
        shared.filter((WHOLE * F.least("n", "hub_n") >= PART * F.greatest("n", "hub_n")))
        .groupBy("node", "hub", "n", "hub_n")
        .agg(F.sum(F.when(node_larger, F.col("own")).otherwise(F.col("hub_own")).cast("long")).alias("shared"))
        .withColumn("larger", F.when(node_larger, F.col("node")).otherwise(F.col("hub")))
        .join(sigs.select(F.col("node").alias("larger"), "sigs"), "larger")
        .filter(F.col("shared") >= F.col("sigs") - F.floor((F.col("n") + F.col("hub_n")) / 7))
    )
    if tried is not None:
        counted = counted.join(tried, ["node", "hub"], "left_anti")
    return counted.groupBy("node").agg(F.max(F.struct("shared", "hub")).alias("best")).select(
        F.col("best.hub").alias("hub"), "node"
    )


def _across(rows: DataFrame, comp: DataFrame, sigs: DataFrame) -> DataFrame:
    """What links between components can still come from, with ``component`` and ``able``.

    Groups within one component go.  A node is ``able`` to be the larger set of
    a link only if enough of its own signatures are left: a linked pair shares
    all of them but 2n/7 at most.  Groups without an own signature of an able
    node go too.
    """
    labelled = rows.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = labelled.groupBy("sig").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    mixed = staged(labelled.join(spread.filter("c0 <> c1").select("sig"), "sig", "left_semi"), "op1-mixed")
    own = mixed.filter("own")
    able = (
        own.groupBy("node", "n")
        .count()
        .join(sigs, "node")
        .filter(F.col("count") >= F.col("sigs") - F.floor(2 * F.col("n") / 7))
        .select("node", F.lit(True).alias("able"))
    )
    able = staged(able, "op1-able")
    live = own.join(able, "node", "left_semi").select("sig").distinct()
    rest = mixed.join(live, "sig", "left_semi").join(able, "node", "left")
    rest = staged(rest.withColumn("able", F.coalesce("able", F.lit(False))), "op1-rest")
    discard(mixed, able)
    return rest


def _other_hubs(rest: DataFrame, central: DataFrame) -> DataFrame:
    """Every row with its group's most central member of another component as ``hub``."""
    scored = rest.join(central, "node")
    member = F.struct("score", "node", "component", "n", "own")
    first = scored.groupBy("sig").agg(F.max(member).alias("a"))
    placed = scored.join(first, "sig")
    apart = placed.filter(F.col("component") != F.col("a.component"))
    second = apart.groupBy("sig").agg(F.max(member).alias("b"))
    hub = F.when(F.col("component") != F.col("a.component"), F.col("a")).otherwise(F.col("b"))
    named = placed.join(second, "sig").withColumn("hub", hub)
    return named.select(
        "node", "n", "own", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.own").alias("hub_own")
    )


def _prefixes(rest: DataFrame, sigs: DataFrame) -> DataFrame:
    """sig, node, n, component, looked, hub_looked, as_hub, as_node, members: the signatures to look at.

    Of the larger set (the hub) and the other one, a linked pair shares all
    signatures but (n + hub_n) / 7 in the hub's band, counted from either set.  The
    signatures of a set in a band are ranked: first those that no other component
    has, then by the number of nodes that have them.  The first x shared ones are
    among the first (n + hub_n) / 7 + x of both, so ``looked`` of each suffice.
    ``members``: how many nodes look at the signature.
    """
    frequent = rest.groupBy("sig").agg(F.count(F.lit(1)).alias("nodes"))
    rank = Window.partitionBy("node", "own").orderBy("nodes", "sig")
    all_of = Window.partitionBy("node", "own")
    ranked = (
        rest.join(frequent, "sig")
        .join(sigs, "node")
        .withColumn("alone", F.when(F.col("own"), F.col("sigs")).otherwise(F.col("next_sigs")) - F.count(F.lit(1)).over(all_of))
        .withColumn("place", F.row_number().over(rank) + F.greatest(F.col("alone"), F.lit(0)))
        .withColumn("hub_looked", F.floor(2 * F.col("n") / 7) + 1 + F.floor(F.col("n") / SPARE))
        # a hub is larger by a third at most
        .withColumn("looked", F.floor(F.col("n") / 3) + 1 + F.floor(4 * F.col("n") / (3 * SPARE)))
        .withColumn("as_hub", F.col("own") & F.col("able") & (F.col("place") <= F.col("hub_looked")))
        .withColumn("as_node", F.col("place") <= F.col("looked"))
        .filter("as_hub OR as_node")
        .select("sig", "node", "n", "component", "looked", "hub_looked", "as_hub", "as_node")
    )
    ranked = staged(ranked, "op1-ranked")
    members = ranked.groupBy("sig").agg(
        F.count(F.lit(1)).alias("members"), F.min("component").alias("c0"), F.max("component").alias("c1"), F.max("as_hub").alias("hubs")
    )
    out = staged(ranked.join(members.filter("c0 <> c1 AND hubs").select("sig", "members"), "sig"), "op1-prefix")
    discard(ranked)
    return out


def _pairs_across(prefix: DataFrame, group: int) -> DataFrame:
    """hub, node: the pairs of different components that may be linked and share no signature
    that more than ``group`` nodes look at (those are compared in tiles).

    A signature is joined ``group`` times at most.
    """
    few = prefix.filter(F.col("members") <= group)
    larger = few.filter("as_hub").select(
        "sig", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("component").alias("hub_component"), "hub_looked"
    )
    smaller = few.filter("as_node").select("sig", "node", "n", "component", "looked")
    return (
        larger.join(smaller, "sig")
        .filter(
            (F.struct("n", "node") < F.struct("hub_n", "hub"))
            & (F.col("component") != F.col("hub_component"))
            & (WHOLE * F.col("n") >= PART * F.col("hub_n"))
        )
        .groupBy("hub", "node", "hub_n", "n", "hub_looked", "looked")
        .count()
        .filter(F.col("count") >= F.least("looked", "hub_looked") - F.floor((F.col("n") + F.col("hub_n")) / 7))
        .select("hub", "node")
    )


def _placed_sets(docs: DataFrame, nodes: DataFrame, where: DataFrame) -> DataFrame:
    """home, salt, node, raw: the sets of ``nodes`` (node, home, salt)."""
    tasks = nodes.join(where, "node").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "node", "home", "salt"
    )
    tasks = staged(tasks, "op1-placed")
    mine = F.col("doc_id").eqNullSafe(F.col("_id")) & (_text_hash() == F.col("_hash"))
    texts = needed(docs.select("doc_id", "text"), tasks).join(tasks, mine).select("text", "home", "salt", "node")

    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part in byte_slices(batches, limit=SLICE):
            found = shingle_sets(_texts(part))
            node = part.column("node").to_pylist()
            same = pa.array([len(u) > 0 and set_key(u) == k for u, k in zip(found, node)])
            raw = pa.array([u.tobytes() for u in found], pa.binary())
            columns = [part.column(c) for c in ("home", "salt", "node")] + [raw]
            yield pa.RecordBatch.from_arrays(columns, ["home", "salt", "node", "raw"]).filter(same)

    # a row that stands twice in the documents comes twice
    return texts.mapInArrow(sets, "home long, salt int, node long, raw binary").dropDuplicates(["node"])


def set_links(x: list[np.ndarray], y: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places (in x, in y) of the pairs of sorted sets that reach the similarity, by exact intersections."""
    ax, ay = np.concatenate(x), np.concatenate(y)
    nx, ny = np.array([len(u) for u in x]), np.array([len(u) for u in y])
    # only shingles that both sides have can be shared: they are the columns of two 0/1 matrices
    both = np.intersect1d(ax, ay)
    rx, ry = np.repeat(np.arange(len(x)), nx), np.repeat(np.arange(len(y)), ny)
    common = np.zeros((len(x), len(y)), np.float32)
    for k in range(0, len(both), COLUMNS):
        some = both[k : k + COLUMNS]
        sides = []
        for flat, row, count in ((ax, rx, len(x)), (ay, ry, len(y))):
            place = np.searchsorted(some, flat)
            inside = (place < len(some)) & (some[np.minimum(place, len(some) - 1)] == flat)
            side = np.zeros((count, len(some)), np.float32)
            side[row[inside], place[inside]] = 1
            sides.append(side)
        common += sides[0] @ sides[1].T
    shared = common.astype(np.int64)
    return np.nonzero((WHOLE + PART) * shared >= PART * (nx[:, None] + ny[None, :]))


def tile_links(docs: DataFrame, prefix: DataFrame, where: DataFrame, group: int) -> DataFrame:
    """u, v: links that connect the linked nodes of the groups of more than ``group`` nodes.

    A node's home is its most frequent signature.  Homes meet if nodes of theirs share a
    frequent signature; tiles of about ``TILE_BYTES`` hold homes that meet the same large
    one, or a part of a home.  Tiles of homes that meet are compared, each pair once however
    many signatures they share.  A comparison returns one link per node at most, never its
    pairs.
    """
    spark = docs.sparkSession
    many = prefix.filter(F.col("members") > group)
    homes = many.groupBy("node").agg(F.max(F.struct("members", "sig")).alias("most"), F.max("n").alias("n"))
    homes = staged(homes.select("node", "n", F.col("most.sig").alias("home")), "op1-homes")
    load = staged(homes.groupBy("home").agg(F.sum(8 * F.col("n")).alias("bytes")), "op1-load")
    held = many.join(homes.select("node", "home"), "node").groupBy("sig", "home")
    held = held.agg(F.max("as_hub").alias("hubs"), F.max("as_node").alias("others"))
    other = held.select("sig", F.col("home").alias("b"), F.col("hubs").alias("b_hubs"), F.col("others").alias("b_others"))
    met = (
        held.withColumnRenamed("home", "a")
        .join(other, "sig")
        .filter("a <= b AND ((hubs AND b_others) OR (others AND b_hubs))")
        .select("a", "b")
        .distinct()
    )
    met = staged(met, "op1-met")
    # small homes go to the largest one they meet, so that homes that meet lie in the same few tiles
    size = load.select(F.col("home").alias("b"), "bytes")
    both = met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(size, "b")
    lead = both.groupBy(F.col("a").alias("home")).agg(F.max(F.struct("bytes", F.col("b").alias("lead"))).alias("best"))
    upto = Window.partitionBy("lead").orderBy("home").rowsBetween(Window.unboundedPreceding, -1)
    tiles = (
        load.join(lead.select("home", "best.lead"), "home", "left")
        .withColumn("lead", F.coalesce("lead", "home"))
        .withColumn("place", F.floor(F.coalesce(F.sum("bytes").over(upto), F.lit(0)) / TILE_BYTES))
        .withColumn("salts", (F.floor(F.col("bytes") / TILE_BYTES) + 1).cast("int"))
        .select("home", "salts", F.xxhash64("lead", "place").alias("tile"))
    )
    tiles = staged(tiles, "op1-tiles")
    # (tile, salt): homes of one tile with as many salts share them
    placed = homes.join(tiles, "home").select(
        "node", F.col("tile").alias("home"), F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt")
    )
    sets = staged(_placed_sets(docs, placed, where), "op1-sets")
    side = lambda k, i: tiles.select(F.col("home").alias(k), F.col("tile").alias(f"t{k}"), F.explode(F.expr("sequence(0, salts - 1)")).alias(i))
    pairs = met.join(side("a", "i"), "a").join(side("b", "j"), "b")
    turned = F.struct("tb", "j") < F.struct("ta", "i")
    pairs = pairs.select(
        F.when(turned, F.col("tb")).otherwise(F.col("ta")).alias("a"),
        F.when(turned, F.col("j")).otherwise(F.col("i")).alias("i"),
        F.when(turned, F.col("ta")).otherwise(F.col("tb")).alias("b"),
        F.when(turned, F.col("i")).otherwise(F.col("j")).alias("j"),
    )
    pairs = staged(pairs.distinct(), "op1-tile-pairs")
    # a tile goes to the task of each of its pairs, one that is compared with itself once
    sides = pairs.select("a", "i", "b", "j", F.lit(0).alias("side"), F.col("a").alias("home"), F.col("i").alias("salt")).unionByName(
        pairs.filter("a <> b OR i <> j").select(
            "a", "i", "b", "j", F.lit(1).alias("side"), F.col("b").alias("home"), F.col("j").alias("salt")
        )
    )

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def links(held):
            x, y = ([(n, np.frombuffer(raw, np.uint64)) for side, n, raw in held if side == k] for k in (0, 1))
            names = np.array([n for n, _ in x + y], np.int64)
            label = np.arange(len(names))
            for p in range(0, len(x), TILE):
                # a tile with itself: every pair of its parts once
                for q in range(0, len(y), TILE) if y else range(p, len(x), TILE):
                    u, v = x[p : p + TILE], (y or x)[q : q + TILE]
                    i, j = set_links([s for _, s in u], [s for _, s in v])
                    merge_classes(label, i + p, j + q + (len(x) if y else 0))
            moved = np.flatnonzero(label != np.arange(len(label)))
            return pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[label[moved]])], ["u", "v"])

        pair, held = None, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for a, i, b, j, side, node, raw in zip(*columns):
                if (a, i, b, j) != pair:
                    if held:
                        yield links(held)
                    pair, held = (a, i, b, j), []
                held.append((side, node, raw))
        if held:
            yield links(held)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        sets.join(sides, ["home", "salt"])
        .select("a", "i", "b", "j", "side", "node", "raw")
        .repartition(parts, "a", "i", "b", "j")
        .sortWithinPartitions("a", "i", "b", "j", "side")
        .mapInArrow(compare, "u long, v long")
    )


def near_groups(docs: DataFrame, rounds: int = ROUNDS, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return labelled_rows(docs, rounds, group).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with one document of each group: the one of smallest id, then of smallest text hash.

    Documents without words are in no group and all stay.
    """
    words = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("best")
    winners = staged(labelled_rows(docs, rounds).filter("n > 0").groupBy("component").agg(best), "op1-winners")
    winners = winners.select(F.col("best.doc_id").alias("_id"), F.col("best.text_hash").alias("_key"))
    rows = docs.filter(words).select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_doc"), _text_hash().alias("_hash")
    )
    kept = rows.join(
        winners.hint("merge"), F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key")), "left_semi"
    ).dropDuplicates(["_doc", "_hash"])
    return kept.select("_row.*").unionByName(docs.filter(~words))


def labelled_rows(docs: DataFrame, rounds: int = ROUNDS, group: int = GROUP) -> DataFrame:
    """doc_id, text_hash, n, component (NULL without shingles) and component_id of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(describe(docs), "op1-rows")
    full = rows.filter("n > 0")
    # one row per band: at most 63
    size_band = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    raised = full.filter("level > 0").groupBy(size_band.alias("band")).agg(F.max("level").alias("level")).collect()
    groups = staged(shared_signatures(docs, {r["band"]: r["level"] for r in raised}), "op1-groups")
    named_text = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("one")
    where = full.groupBy("node").agg(named_text).select("node", "one.doc_id", "one.text_hash")

    # each node against the smallest node it shares most signatures with
    sigs = staged(full.select("node", "sigs", "next_sigs").distinct(), "op1-sigs")
    stars = staged(_best_hub(groups.filter("node <> hub"), sigs), "op1-stars")
    links = staged(linked(docs, stars, where), "op1-links")
    comp = staged(components(links, "op1-cc"), "op1-comp")
    rest = _across(groups.select("sig", "node", "n", "own", "members"), comp, sigs)

    # then against the most central node of another component, while that finds links
    central = staged(groups.groupBy("node").agg(F.sum("members").alias("score")), "op1-central")
    tried = stars
    for _ in range(rounds):
        stars = staged(_best_hub(_other_hubs(rest, central), sigs, tried), "op1-stars")
        found = staged(linked(docs, stars, where), "op1-links")
        if found.isEmpty():
            break
        tried, links = tried.unionByName(stars), links.unionByName(found)
        comp = staged(components(links, "op1-cc"), "op1-comp")
        old, rest = rest, _across(rest.drop("component", "able"), comp, sigs)
        discard(old)

    prefix = _prefixes(rest, sigs)
    discard(groups, rest, central)
    in_tiles = staged(tile_links(docs, prefix, where, group), "op1-links")
    pairs = staged(_pairs_across(prefix, group), "op1-pairs")
    discard(prefix)
    comp = components(links.unionByName(in_tiles).unionByName(linked(docs, pairs, where)), "op1-cc")

    named = full.groupBy("node").agg(F.min("doc_id").alias("least")).join(comp, "node", "left")
    named = named.select("node", "least", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = named.select("node", "component").join(least, "component").select("node", "component", "component_id")
    columns = ["doc_id", "text_hash", "n", "component", "component_id"]
    none = rows.filter("n = 0").withColumn("component", F.lit(None).cast("long")).withColumn("component_id", F.col("doc_id"))
    return full.join(ids, "node").select(*columns).unionByName(none.select(*columns))
