"""Periodic runs against all lags of every text, planted rows and odd rows."""

import hashlib
import random
import re
import zlib

import pytest

from ledgerlake.llm import periodic_runs as P
from ledgerlake.llm.queries import QUERIES
from llm_data import SF_SMALL, documents, odd_documents  # noqa: F401


def brute(ws, min_words=6, exponent=4):
    out, n = [], len(ws)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            size = j + q - i
            shorter = any(all(ws[k] == ws[k + d] for k in range(i, i + size - d)) for d in range(1, q))
            if size >= max(min_words, exponent * q) and not shorter:
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(ws, runs):
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    return [w for k, w in enumerate(ws) if k not in gone]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_all_lags_on_random_words(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        ws = []
        while len(ws) < rng.choice([5, 30, 200, 500]):
            letters = rng.choice([2, 3, 20])
            if rng.random() < 0.6:
                block = [b"%d" % rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64]))]
                block = block * 2 if rng.random() < 0.2 else block
                ws += (block * 10)[: int(len(block) * rng.uniform(1, 7))]
            else:
                ws += [b"%d" % rng.randrange(letters) for _ in range(rng.randrange(12))]
        texts.append(ws)
    assert P.text_runs(texts, 6, 4) == [brute(ws) for ws in texts]


def test_long_periods_are_found_and_maximal():
    rng = random.Random(9)
    block = [b"%d" % rng.randrange(50) for _ in range(9001)]
    ws = [b"x", b"y"] + block * 4 + block[:17] + [b"z"]
    assert P.text_runs([ws, block, block * 3], 6, 4) == [[(2, 4 * 9001 + 17, 9001)], [], []]


def test_other_parameters():
    ws = b"a b a b a b a b a c c c c c c c".split()
    assert P.text_runs([ws], 6, 4) == [[(0, 9, 2), (9, 7, 1)]]
    assert P.text_runs([ws], 8, 4) == [[(0, 9, 2)]]
    assert P.text_runs([ws], 6, 5) == [[(9, 7, 1)]]


def test_odd_rows(odd_documents):
    rows = P.periodic_runs(odd_documents).collect()
    assert len(rows) == 9
    by_id = {r["doc_id"]: r for r in rows}
    for k in (1, 2, 3):
        assert (by_id[k]["n_words"], by_id[k]["runs"], by_id[k]["collapsed"]) == (0, [], "")
    assert [tuple(r) for r in by_id[5]["runs"]] == [(0, 20_000, 5)]
    assert by_id[5]["collapsed"] == "alpha beta gamma delta epsilon"
    assert by_id[None]["collapsed"] == "no id here"
    text = {r["doc_id"]: r["text"] for r in odd_documents.collect()}
    assert by_id[7]["collapsed"] == " ".join(re.findall(r"[^\x20\x09-\x0D]+", text[7]))  # other blanks are letters
    assert P.periodic_runs(odd_documents.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.periodic_runs(odd_documents, exponent=3)


def planted(doc_id, ws):
    h, n = zlib.crc32(str(doc_id).encode()), len(ws)
    if h % 10 or not n:
        return ws
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    some = 0
    for d in rows:
        ws = planted(d["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
        if len(ws) > 3000 and zlib.crc32(str(d["doc_id"]).encode()) % 10:
            continue  # all lags of a very long text take too long here; planted ones are all compared
        runs, r = brute(ws) if len(ws) <= 3000 else P.text_runs([[w.encode() for w in ws]], 6, 4)[0], got[d["doc_id"]]
        some += bool(runs)
        assert r["n_runs"] == len(runs)
        text = "".join("%d,%d,%d\n" % run for run in runs)
        assert r["runs_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(kept_words(ws, runs)).encode()).hexdigest()
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
    assert some > 10
