"""Line dedup: patience alignment, planted passages, brute force over the documents, odd rows."""

import random
import re

from ledgerlake.llm import line_dedup as L
from ledgerlake.llm.queries import QUERIES
from llm_data import SF_SMALL, documents, odd_documents  # noqa: F401

PASSAGE = " ".join(f"passage{i}" for i in range(55))


def test_patience_aligns_in_order():
    a, b = list("abcdxefgh"), list("zabcdefyhg")
    got = L.patience(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    assert {(0, 1), (3, 4), (5, 5)} <= set(got)
    assert L.patience(list("aaa"), list("aaa")) == [(0, 0), (1, 1), (2, 2)] and L.patience([], list("a")) == []


def brute(docs, min_words=L.MIN_WORDS, rare=L.RARE):
    """Whole table in memory: the same pairs, aligned the same way."""
    lines, holders = {}, {}
    for i, t in docs:
        rows = [(k, s) for k, s in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", s)]
        lines[i] = [(p, k, s, len(re.findall(r"[^\x20\x09-\x0D]+", s))) for p, (k, s) in enumerate(rows)]
        for _, s in rows:
            holders.setdefault(s, set()).add(i)
    shared = {i: [x for x in rows if len(holders[x[2]]) > 1] for i, rows in lines.items()}
    gone = {}
    for i, rows in shared.items():
        words = {}
        for s, w in {(x[2], x[3]) for x in rows}:
            early = {min(holders[s])} | (holders[s] if len(holders[s]) <= rare else set())
            for e in early:
                if e < i:
                    words[e] = words.get(e, 0) + w
        for e, w in words.items():
            if w >= min_words:
                gone.setdefault(i, set()).update(L.blocks_to_delete(shared[e], rows, min_words))
    return {i: sorted(g) for i, g in gone.items() if g}


def test_documents_equal_brute_force(spark, documents):
    got = QUERIES["op8_patience_line_dedup"](spark, SF_SMALL).collect()
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert want and {r["doc_id"]: [int(x) for x in r["deleted"].split(",")] for r in got if r["deleted"]} == want
    assert len(got) == documents.count()


def test_planted_passage_goes_from_all_but_the_first(spark):
    rows = [(i, f"own line {i} stays here\n{PASSAGE}\nlast own {i}", "k") for i in range(20)]
    rows += [(100, "own line 3 stays here\nnothing else", "k"), (101, "short\nline", "k"), (102, "short\nline", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, deleted_lines string")
    out = {r["doc_id"]: r for r in L.remove_repeats(docs).collect()}
    assert PASSAGE in out[0]["text"]
    assert all(out[i]["text"] == f"own line {i} stays here\nlast own {i}" for i in range(1, 20))
    assert all(out[i]["text"] == dict((r[0], r[1]) for r in rows)[i] for i in (100, 101, 102))
    assert out[5]["deleted_lines"] == "k" and out[5]["deleted_lines_"] == [1]


def test_odd_rows(odd_documents):
    out = L.remove_repeats(odd_documents).collect()
    assert len(out) == odd_documents.count()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[1] == [None] and by[2] == [""] and by[6] == ["", ""] and by[5][0].startswith("alpha")
    kept = L.drop_repeats(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i in (1, 2, 3, 4, 5, 7, None))
    assert L.remove_repeats(odd_documents.limit(0)).count() == 0


def all_pairs(docs, min_words=L.MIN_WORDS):
    """Whole table in memory: every document against every earlier one."""
    seqs = []
    for i, t in docs:
        rows = [(k, s) for k, s in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", s)]
        seqs.append((i, [(p, k, s, len(s.split())) for p, (k, s) in enumerate(rows)]))
    gone = {}
    for n, (i, late) in enumerate(seqs):
        for _, early in seqs[:n]:
            if {x[2] for x in early} & {x[2] for x in late}:
                gone.setdefault(i, set()).update(L.blocks_to_delete(early, late, min_words))
    return {i: sorted(g) for i, g in gone.items() if g}


def deleted(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["deleted_lines"] for r in L.remove_repeats(docs).collect() if r["deleted_lines"]}


def test_shortest_runs_cover_every_block():
    words = [5, 20, 20, 3, 41, 1, 39, 2]
    seq = [(p + (p > 5), p, str(p), w) for p, w in enumerate(words)]
    ok = lambda a, b: sum(words[a:b]) >= 40 and not (a <= 5 < b - 1)
    every = {(a, b) for a in range(8) for b in range(a + 1, 9) if ok(a, b)}
    want = {(a, b) for a, b in every if (a, b - 1) not in every or (a + 1, b) not in every}
    want = {(a, b) for a, b in want if not any((a, c) in every for c in range(b)) or not any((c, b) in every for c in range(a + 1, b))}
    assert set(L.shortest_runs(seq, 40)) == want


def test_lines_with_different_first_holders(spark):
    """B's block a x c y: later documents meet A for a and c only, B for x and y, under 40 words."""
    line = {k: " ".join(f"{k}{i}" for i in range(15)) for k in "abcdxy"}
    rows = [(0, "\n".join(line[k] for k in "abcd"))]
    rows += [(i, "\n".join([f"own {i}", *(line[k] for k in "axcy"), f"end {i}"])) for i in range(1, 31)]
    want = {i: [1, 2, 3, 4] for i in range(2, 31)}
    assert all_pairs(rows) == want and deleted(spark, rows) == want


def test_variants_of_boilerplate_equal_all_pairs(spark):
    rnd = random.Random(5)
    line = [" ".join(f"w{k}x{i}" for i in range(rnd.randint(5, 25))) for k in range(14)]
    rows = []
    for i in range(150):
        a = rnd.randint(0, 8)
        picked = [k for k in range(a, a + rnd.randint(2, 6)) if rnd.random() < 0.85]
        rows.append((i, "\n".join([f"own {i}", *(line[k] for k in picked), f"end {i}"])))
    want = all_pairs(rows)
    assert want and deleted(spark, rows) == want


def common_runs(early, late, min_words=L.MIN_WORDS):
    """Lines of ``late`` in any run of lines that ``early`` holds too; no alignment."""
    return {
        k
        for i in range(len(late))
        for n in range(1, len(late) - i + 1)
        if sum(len(s.split()) for s in late[i : i + n]) >= min_words
        and any(early[j : j + n] == late[i : i + n] for j in range(len(early) - n + 1))
        for k in range(i, i + n)
    }


def test_passages_repeated_or_in_another_order(spark):
    p, q = (["%s%d %s" % (c, k, " ".join(f"{c}{k}w{i}" for i in range(20))) for k in range(3)] for c in "pq")
    rows = [
        (0, ["x", *p, "y", *p, "z"]),  # the first holder has it twice
        *((i, p) for i in range(1, 13)),
        (20, ["x", *q, "own", *p, "z"]),
        (21, ["a", *p, "b", *p, "c", *q]),  # twice in the later one
        (22, [*q, p[0], p[1], "d", *p, *q]),
        (23, ["z", "y", "x", p[0], q[1], p[2]]),
    ]
    want = {i: sorted({k for _, early in rows[:n] for k in common_runs(early, late)}) for n, (i, late) in enumerate(rows)}
    want = {i: g for i, g in want.items() if g}
    assert all(want[i] == [0, 1, 2] for i in range(1, 13)) and 0 not in want and 23 not in want
    assert deleted(spark, [(i, "\n".join(x)) for i, x in rows]) == want


def test_blocks_equal_all_common_runs():
    rnd = random.Random(9)
    for _ in range(400):
        early, late = ([" ".join([rnd.choice("abcd")] * 15) for _ in range(rnd.randint(0, 12))] for _ in range(2))
        seqs = ([(k, k, s, 15) for k, s in enumerate(x)] for x in (early, late))
        assert sorted(L.blocks_to_delete(*seqs, 40)) == sorted(common_runs(early, late, 40))


def test_documents_equal_all_pairs(spark, documents):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    assert deleted(spark, rows) == all_pairs(rows)
