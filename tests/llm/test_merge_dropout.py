"""Merge-dropout: equal to the plain encoder without dropout, agenda by brute force, exact round trips."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from ledgerlake.llm import merge_dropout as M
from ledgerlake.llm.queries import QUERIES
from ledgerlake.llm.shingles import mix
from llm_data import SF_SMALL, documents, odd_documents  # noqa: F401

TEXTS = ["", " ", "  lead", "a  b ", "x y▁z", "日本 \U0001f600\x00 \n\n  ü", "a" * 40, "ab" * 500, "Hello  world\n x", "\U000fffff"]


@pytest.fixture(scope="module")
def model():
    return M.Model(M.default_model())


def split(flat, counts):
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


def test_without_dropout_equals_the_plain_encoder(model, documents):
    texts = [r["text"] or "" for r in documents.limit(80).collect()] + TEXTS
    sp = sentencepiece.SentencePieceProcessor(model_file=M.default_model())
    got = split(*M.Encoder(model, 1, 0.0)(list(range(len(texts))), pa.array(texts)))
    assert all(g == sp.encode(t) for g, t in zip(got, texts) if M.MARK not in t)


def agenda(model, syms, key, dropout):
    """One word, one candidate at a time: best score, then leftmost; drawn when it first appears."""
    joins = dict(zip(model.keys.tolist(), zip(model.joined.tolist(), model.join_rank.tolist())))
    limit = min(int(dropout * 2.0**64), (1 << 64) - 1)
    pieces = [(s, k) for k, s in enumerate(syms)]
    u = lambda x: np.array([x], np.uint64)
    while True:
        best = None
        for (a, p), (b, q) in zip(pieces, pieces[1:]):
            if a * model.n + b in joins:
                joined, rank = joins[a * model.n + b]
                h = u(key) ^ (u(p) * M._K[1]) ^ (u(q) * M._K[2])
                drawn = int(mix(mix(h) ^ (u(joined) * M._K[3]))[0])
                if (dropout == 0 or drawn >= limit) and (best is None or (rank, p) < best[:2]):
                    best = (rank, p, joined)
        if best is None:
            return [s for s, _ in pieces]
        k = [p for _, p in pieces].index(best[1])
        pieces[k : k + 2] = [(best[2], best[1])]


def test_rounds_equal_the_agenda(model):
    words = ["▁international", "▁the", "▁reconsidered", "▁banana", "▁xyzzyxyzzy", "▁" * 5]
    syms = [model.char[[ord(c) for c in w]] for w in words]
    sizes = np.array([len(s) for s in syms])
    for key in range(12):
        keys = mix(np.arange(len(words), dtype=np.uint64) + np.uint64(100 * key))
        for dropout in (0.0, 0.2, 0.6):
            got = split(*M.segment(model, np.concatenate(syms), sizes, keys, dropout))
            want = [agenda(model, s.tolist(), int(k), dropout) for s, k in zip(syms, keys)]
            assert got == want


def test_round_trips_and_variety(model):
    texts = TEXTS + ["international considerations " * 30]
    ids = list(range(len(texts)))
    seen = set()
    for seed in range(3):
        flat, counts = M.Encoder(model, seed, 0.3)(ids, pa.array(texts))
        again, _ = M.Encoder(model, seed, 0.3)(ids, pa.array(texts))
        assert (flat == again).all() and M.decode_ids(model, flat, counts) == texts
        seen.add(tuple(split(flat, counts)[-1]))
    assert len(seen) == 3
    # the slices a text comes in do not matter
    one = M.Encoder(model, 1, 0.3)([ids[-1]], pa.array(texts[-1:]))[0]
    assert tuple(one.tolist()) in seen


def test_every_occurrence_has_its_own_draws(model):
    """One word thousands of times: as many segmentations as the agenda with each occurrence's key gives."""
    n, texts = 4000, ["international " * 4000, "international " * 3]
    flat, counts = M.Encoder(model, 1, 0.3)([7, 8], pa.array(texts))
    assert M.decode_ids(model, flat, counts) == texts
    pieces, seen, ids = [], {}, flat[: counts[0]].tolist()
    for k in ids:  # a word starts with a blank mark
        if pieces and model.raw[model.raw_first[k]] == 32:
            seen[tuple(pieces)] = seen.get(tuple(pieces), 0) + 1
            pieces = []
        pieces.append(k)
    syms = [model.char[ord(c)] for c in "▁international"]
    keys = mix(np.arange(n, dtype=np.uint64))
    flat, counts = M.segment(model, np.tile(syms, n), np.full(n, len(syms)), keys, 0.3)
    want = {}
    for x in split(flat, counts):
        want[tuple(x)] = want.get(tuple(x), 0) + 1
    assert sum(seen.values()) >= n and len(seen) > 50
    assert abs(len(seen) - len(want)) < 0.2 * len(want)
    most = max(want, key=want.get)
    assert abs(seen[most] - want[most]) < 0.1 * n


def test_shared_occurrences_equal_the_agenda(model):
    """Pieces of each occurrence are those of its own key, whether shared or not."""
    words = ["international", "the", "reconsidered", "banana", "xyzzyxyzzy"]
    sym = [[int(model.char[ord(c)]) for c in "▁" + w] for w in words]
    sizes = np.array([len(x) for x in sym])
    which = np.arange(300) % len(words)
    keys = mix(np.arange(len(words), dtype=np.uint64))
    draw = mix(np.arange(300, dtype=np.uint64) + np.uint64(10**6))
    for dropout in (0.05, 0.3):
        flat, first, count = M.Encoder(model, 1, dropout)._pieces(np.concatenate(sym), sizes, keys, which, draw)
        for k, w in enumerate(which.tolist()):
            key = int(mix(keys[w : w + 1] ^ draw[k : k + 1])[0])
            assert flat[first[k] : first[k] + count[k]].tolist() == agenda(model, sym[w], key, dropout)


def test_query_decodes_every_document(spark, documents):
    got = {r["doc_id"]: r["decoded_sha256"] for r in QUERIES["op9_merge_dropout"](spark, SF_SMALL).collect()}
    assert got == {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in documents.collect()}


def test_odd_rows(odd_documents):
    back = M.decode(M.encode(odd_documents, dropout=0.5)).collect()
    want = sorted((str(r["doc_id"]), r["text"] or "") for r in odd_documents.collect())
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == want
    assert M.decode(M.encode(odd_documents.limit(0))).count() == 0
