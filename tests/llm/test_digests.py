"""Improbable-feature digests: entropies and features by brute force, followers, odd rows."""

import hashlib
import math
from collections import Counter

import numpy as np

from ledgerlake.llm import digests as D
from ledgerlake.llm.queries import QUERIES
from llm_data import SF_SMALL, documents, odd_documents  # noqa: F401


def slow_entropies(raw):
    top = 64 * 6 * (1 << 20)
    out = []
    for i in range(len(raw) - 63):
        counts = Counter(raw[i : i + 64]).values()
        out.append((top - sum(round(c * math.log2(c) * (1 << 20)) for c in counts)) * 1000 // top)
    return out


def slow_features(raw, rank, threshold):
    score = [int(rank[e]) for e in slow_entropies(raw)]
    points = Counter()
    for a in range(-63, len(score)):
        run = [(score[i], i) for i in range(max(a, 0), min(a + 64, len(score)))]
        if run:
            points[min(run)[1]] += 1
    return [i for i in sorted(points) if points[i] >= threshold and score[i] <= D.SCALE]


def test_entropies_and_features_equal_brute_force(documents):
    texts = [r["text"] for r in documents.orderBy("doc_id").limit(6).collect()]
    raws = [t.encode()[:700] for t in texts] + [b"", b"x" * 63, b"ab" * 200]
    for raw in raws:
        assert D.entropies(np.frombuffer(raw, np.uint8)).tolist() == slow_entropies(raw)
    rank = D.ranks(Counter(e for raw in raws for e in slow_entropies(raw)).items())
    data, starts, valid = D.layout(raws)
    found = D.features(data, valid, rank, 16)
    for k, raw in enumerate(raws):
        own = [int(i - starts[k]) for i in found if starts[k] <= i < starts[k] + len(raw)]
        assert own == slow_features(raw, rank, 16)


def brute(rows):
    """(doc_id, n_chars, sha of the edited text) with the whole table in order."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        e = t[: len(t) - half] + rows[(k + 1) % len(rows)][1][:half]
        out.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest()))
    return sorted(out)


def test_followers_on_documents(spark, documents):
    got = QUERIES["op6_feature_digest"](spark, SF_SMALL).collect()
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    long = [r for r in got if r["n_chars"] > 1000]
    assert np.median([r["near_edited"] for r in long]) > 0.3 > 0.05 > np.median([r["near_next"] for r in long])


def test_odd_rows(odd_documents):
    got = D.digests(odd_documents).collect()
    want = brute([(r["doc_id"], r["text"]) for r in odd_documents.collect()])
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == want
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert prints[5] == prints[6] and prints[1] == prints[2] != prints[3]
    assert D.digests(odd_documents.limit(0)).count() == 0
    one = D.digests(odd_documents.filter("doc_id = 4")).first()
    assert one["near_next"] == 1.0


def test_likeness_of_copies_and_strangers():
    rng = np.random.default_rng(1)
    text = "".join(chr(97 + c) for c in rng.integers(0, 26, 4000))
    other = "".join(chr(97 + c) for c in rng.integers(0, 26, 4000))
    data, _, valid = D.layout([text.encode(), other.encode()])
    rank = D.ranks(Counter(D.entropies(data)[valid].tolist()).items())
    a, b, c = D.fingerprints([text, other, text[:2000] + "Z" + text[2001:]], rank)
    assert D.likeness(a, a) == 1.0 and D.likeness(a, b) < 0.1 and D.likeness(a, c) > 0.85
    assert D.likeness(a, c) == D.likeness(c, a)
