"""SimHash tiles against plain fingerprints and all pairs."""

import random

import numpy as np
import xxhash

from ledgerlake.llm import simhash as S
from ledgerlake.llm.queries import QUERIES
from llm_data import SF_SMALL, documents, odd_documents  # noqa: F401

FOLD = {c: c + 32 for c in range(65, 91)}


def plain_fingerprint(text):
    import re

    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 4]) for i in range(len(ws) - 3)] or [" ".join(ws)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(fps, radius=4):
    """Class (least place) of every fingerprint, by all pairs."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    x = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x) <= radius).tolist():
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return [root(i) for i in range(len(fps))]


def test_query_equals_brute_force(spark, documents):
    rows = sorted((r["doc_id"], plain_fingerprint(r["text"])) for r in documents.collect())
    label = brute([f for _, f in rows])
    got = sorted(tuple(r) for r in QUERIES["op13_simhash_tiles"](spark, SF_SMALL).collect())
    assert got == [(i, f"{f:016x}", rows[label[k]][0]) for k, (i, f) in enumerate(rows)]


def links_of(spark, fps, tile=64, radius=4):
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").distinct()
    tiled = S.staged(S.tiles(nodes, tile), "t13")
    assert tiled.selectExpr("sum(length(raw)) / 8").first()[0] == len(set(fps))
    assert tiled.selectExpr("max(length(raw)) / 8").first()[0] <= tile
    return tiled, S.tile_links(tiled, S.tile_pairs(tiled, radius), radius)


def test_small_tiles_lose_no_link(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(700)] + [0, 1, (1 << 64) - 1, 1 << 63]
    for f in fps[:250]:  # chains of copies that differ in 1 to 6 bits
        for _ in range(3):
            for k in rng.sample(range(64), rng.choice([1, 2, 4, 4, 5, 6])):
                f ^= 1 << k
            fps.append(f)
    fps = sorted(set(fps))
    for radius in (4, 2):
        _, links = links_of(spark, fps, radius=radius)
        place = {f: k for k, f in enumerate(fps)}
        label = list(range(len(fps)))

        def root(i):
            while label[i] != i:
                i = label[i]
            return i

        for r in links.collect():
            a, b = sorted((root(place[r["u"] % (1 << 64)]), root(place[r["v"] % (1 << 64)])))
            label[b] = a
        assert [root(i) for i in range(len(fps))] == brute(fps, radius)


def test_dense_group_gives_links_not_pairs(spark):
    base = 0x123456789ABCDEF0
    fps = sorted({base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)})
    tiled, links = links_of(spark, fps, tile=256)
    n = tiled.count()
    assert links.count() <= 2 * len(fps) * n
    assert S.components(links).select("component").distinct().count() == 1


def test_tile_pairs_beyond_the_radius_are_skipped(spark):
    rng = random.Random(4)
    tiled, _ = links_of(spark, [rng.getrandbits(64) for _ in range(3000)], tile=32)
    n = tiled.count()
    assert S.tile_pairs(tiled).count() < n * (n + 1) / 2 / 3


def test_odd_rows(spark, odd_documents):
    rows = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in S.near_groups(odd_documents).collect()}
    zero = "0" * 16
    assert {rows[(k, zero)] for k in (1, 2, 3)} == {1}
    assert S.near_groups(odd_documents).count() == 9
    long_fp = f"{plain_fingerprint('alpha beta gamma delta epsilon ' * 4000):016x}"
    assert rows[(5, long_fp)] == rows[(6, long_fp)] == 5
    none = f"{plain_fingerprint('no id here'):016x}"
    assert rows[(None, none)] is None
    assert S.near_groups(odd_documents.limit(0)).count() == 0
