"""Toxicity: gradients by differences, windows, held-out accuracy, odd rows."""

import dataclasses
import random
import zlib

import numpy as np
import pyarrow as pa

from ledgerlake.llm import toxicity as X
from ledgerlake.llm.queries import QUERIES
from llm_data import SF_SMALL, odd_documents  # noqa: F401

SMALL = dataclasses.replace(X.Settings(), window=6, stride=4, hidden=3, embed=2, word_buckets=64, char_buckets=64)


def test_gradients_equal_differences():
    texts = ["a bad word here and more words so that", "good text", "idiot", "", "one two three four five six seven"]
    codes, offsets, dictionary = X.words_of(pa.array(texts))
    table, y = X.WordTable(dictionary, SMALL), np.array([1, 0, 1, 0, 0], np.float32)
    p = {k: v.astype(np.float64) for k, v in X.initial(table, codes, offsets, y, SMALL).items()}
    start, length, text = X.windows(offsets, SMALL)
    g, _ = X.gradients(p, table, codes, start, length, y[text], SMALL)
    rng = np.random.default_rng(0)
    for k in p:
        live = np.argwhere(g[k] != 0)
        for i in map(tuple, live[rng.integers(0, len(live), 4)]):
            loss = []
            for d in (1e-2, -1e-2):
                q = {a: b.copy() for a, b in p.items()}
                q[k][i] += d
                loss.append(X.gradients(q, table, codes, start, length, y[text], SMALL)[1])
            assert abs((loss[0] - loss[1]) / 2e-2 - g[k][i]) < 1e-4


def test_windows_cover_every_word_and_overlap():
    offsets = np.array([0, 0, 1, 6, 7 + 6, 40])
    start, length, text = X.windows(offsets, SMALL)
    for k in range(len(offsets) - 1):
        mine = [(a, a + n) for a, n, t in zip(start, length, text) if t == k]
        assert mine and mine[0][0] == offsets[k] and mine[-1][1] == offsets[k + 1]
        assert all(b[0] < a[1] for a, b in zip(mine, mine[1:]))


def corpus(seed, n):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        text, toxic = [rnd.choice(words) for _ in range(rnd.randint(5, 200))], int(rnd.random() < 0.2)
        if toxic:  # new endings on known stems: the characters tell
            text.insert(rnd.randrange(len(text)), "vilkwort" + rnd.choice(words))
        rows.append((i, " ".join(text), toxic))
    return rows


def test_held_out_documents_are_told_apart(spark):
    rows = corpus(5, 700)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    out = X.score(docs, labels).collect()
    truth = {i: y for i, _, y in rows}
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in out)


def test_odd_rows_and_missing_labels(spark, odd_documents):
    labels = spark.createDataFrame([(4, 1, 1), (5, None, 0), (7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = X.score(odd_documents, labels).collect()
    assert len(out) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (1, 2, 3)}) == 1
    assert {r["score"] for r in X.score(odd_documents, labels.limit(0)).collect()} == {0.0}
    assert X.score(odd_documents.limit(0), labels).count() == 0


def test_query(spark):
    out = QUERIES["op7_gru_toxicity"](spark, SF_SMALL)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 200
