"""N-gram Jaccard join: sets, signatures, components; brute force over all pairs; odd rows."""

import random
import re

import numpy as np

from ledgerlake.llm import components as C
from ledgerlake.llm import ngram_join as J
from ledgerlake.llm.queries import QUERIES
from ledgerlake.llm.shingles import mix, shingle_sets
from llm_data import SF_SMALL, documents, odd_documents  # noqa: F401


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded)


def shingles(text):
    w = words_of(text)
    if len(w) >= 5:
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)] if w else [])


def brute(rows):
    """[(doc_id, n, component_id)] by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    by = {}
    for k, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(k)
    for a, b in {(a, b) for group in by.values() for a in group for b in group if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(
        ((str(i), len(s), str(least.get(root(k)) if s else i)) for k, ((i, _), s) in enumerate(zip(rows, sets)))
    )


def result(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def test_sets_equal_word_by_word():
    texts = ["a b", "A B", "", "x", "a b c d e f", "  \n ", "É é\x0bz \x1f q", "a b c d e a b c d e"]
    sets = shingle_sets([t.encode() for t in texts])
    assert [len(u) for u in sets] == [len(shingles(t)) for t in texts]
    assert (sets[0] == sets[1]).all() and len(np.intersect1d(sets[4], sets[7])) == 1


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for n in [*range(1, 70), 100, 127, 128, 200, 255, 256, 300, 511, 700, 3000]:
        for _ in range(20):
            big = rng.integers(0, (1 << 64) - 1, n, dtype=np.uint64)
            gone = int(rng.integers(0, n // 4 + 1))
            small = np.sort(big[gone:]) if gone < n else big
            big = np.sort(big)
            if 4 * len(small) < 3 * len(big):
                continue
            i, level = J.band(n), J.own_count(big)[1]
            assert level == 0
            sign = lambda u: set(J.signatures(u, mix(u), i, J.partitions(i)).tolist())
            assert len(sign(big)) == J.own_count(big)[0] > J.most_differing(n)
            shared = len(sign(big) & sign(small))
            assert shared >= len(sign(big)) - (n + len(small)) // 7 > 0
            assert J.band(len(small)) == i or 4 * len(small) >= 3 << J.band(len(small)) + 1


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7_000_000_000, 200), (200, 201), (201, 7_000_000_000)]
    df = C.components(spark.createDataFrame(edges, "u long, v long"))
    got = {r["node"]: r["component"] for r in df.collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200, 7_000_000_000: 200}
    assert got == want


def test_query_equals_brute_force(spark, documents):
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert len({c for _, _, c in want}) < len(want)
    assert result(QUERIES["op1_partenum_join"](spark, SF_SMALL)) == want


def planted(seed=9):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]
    rows = []
    for size in (4, 6, 12, 30, 80, 300):
        base = [word() for _ in range(size)]
        for k in range(25):  # near copies on both sides of the threshold
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, size // 14))):
                copy[rnd.randrange(size)] = word()
            rows.append(" ".join(copy[: size - rnd.randint(0, size // 8)]))
    for k in range(60):  # one passage in many short, otherwise different documents
        rows.append(" ".join([word() for _ in range(rnd.randint(0, 12))] + passage + [word() for _ in range(rnd.randint(0, 12))]))
    chain = [word() for _ in range(60)]
    for k in range(12):  # a chain: neighbours are linked, ends are not
        rows.append(" ".join(chain[: 44 + k]) + " " + " ".join(chain[44 + k + 4 :]))
    rnd.shuffle(rows)
    return [(3 * k, t) for k, t in enumerate(rows)]


def test_groups_on_planted_copies_and_hot_passages(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert result(J.near_groups(docs)) == want
    for group in (0, 5, 10**9):  # what the rounds leave is found in tiles, in both ways, and by joined pairs
        assert result(J.near_groups(docs, rounds=0, group=group)) == want


def test_near_copies_with_null_ids_are_linked(spark):
    rnd = random.Random(2)
    base = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    copies = [base[:k] + ["other"] + base[k + 1 :] for k in (0, 1, 59)]
    rows = [(None, copies[0]), (None, copies[1]), (7, copies[2]), (None, ["quite", "alone"]), (None, ["quite", "alone"])]
    rows = [(i, " ".join(t)) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for group in (0, 64):
        got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in J.near_groups(docs, group=group).collect())
        assert got == [(-1, 1, -1), (-1, 1, -1), (-1, 56, 7), (-1, 56, 7), (7, 56, 7)]
    kept = J.keep_one(docs).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["7", "None"]


def test_set_links_equal_plain_intersections():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 9000, dtype=np.uint64)
    base = rng.choice(pool, 5000, replace=False)
    sets = [np.unique(rng.choice(base, int(rng.integers(1, 5000)), replace=False)) for _ in range(40)]
    sets += [np.unique(rng.choice(pool, 30)) for _ in range(20)] + [np.unique(base), np.unique(base[:4000])]
    i, j = J.set_links(sets[:33], sets[20:])
    plain = set()
    for a, u in enumerate(sets[:33]):
        for b, v in enumerate(sets[20:]):
            both = len(np.intersect1d(u, v))
            if 4 * both >= 3 * (len(u) + len(v) - both):
                plain.add((a, b))
    assert set(zip(i.tolist(), j.tolist())) == plain and plain


def test_odd_rows_and_empty_table(odd_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert result(J.near_groups(odd_documents)) == brute(rows)
    assert J.near_groups(odd_documents.limit(0)).count() == 0


def test_texts_no_step_needs_are_not_shuffled(spark, monkeypatch):
    """Of the documents, those that tasks name stay (a NULL id and text too) and most others go before the join."""
    text = J.F.when(J.F.col("id") != 7, J.F.concat(J.F.lit("word "), "id"))
    docs = spark.range(5000).select(J.F.when(J.F.col("id") != 3, J.F.col("id")).alias("doc_id"), text.alias("text"))
    named = docs.filter("doc_id is null or doc_id % 50 = 7")
    tasks = named.select(J.F.col("doc_id").alias("_id"), J._text_hash().alias("_hash"))
    kept = {tuple(r) for r in J.needed(docs, tasks).collect()}
    assert {tuple(r) for r in named.collect()} <= kept and len(kept) < 150
    assert J.needed(docs, tasks.limit(0)).count() == 0
    # places that many share only keep more
    monkeypatch.setattr(J, "BITS", 64)
    monkeypatch.setattr(J, "BITMAP", 8)
    assert {tuple(r) for r in named.collect()} <= {tuple(r) for r in J.needed(docs, tasks).collect()}


def test_documents_left_out_before_the_joins_change_no_group(spark, monkeypatch):
    rng = random.Random(11)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(60)] for _ in range(12)]
    rows = [(k, " ".join(base[k % 12][:58] + [f"x{k}"])) for k in range(60)] + [(60 + k, f"alone {k}") for k in range(20)]
    monkeypatch.setattr(J, "BITS", 1 << 16)
    got = J.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), group=2).collect()
    assert sorted(map(tuple, got)) == [(k, 55, k % 12) for k in range(60)] + [(60 + k, 1, 60 + k) for k in range(20)]
