"""Personal data: base spans by brute force, CRF on held-out lines, exact skipping, odd rows."""

import hashlib
import itertools
import re

import numpy as np
import pytest

from ledgerlake.llm import pii_crf as P
from ledgerlake.llm.queries import QUERIES
from llm_data import SF_SMALL, documents, odd_documents  # noqa: F401


@pytest.fixture(scope="module")
def tagger():
    return P.LineTagger(P.train(P.labelled_lines()))


def brute_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and P.luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], P.KINDS.index(s[0])))


CASES = [
    "a@b.com_x@y.com", "a@@b.c", "@b.c", "x@y", "x@y.", "1.2.3.4.5.6.7.8", "1.2.3.256 1.2.3.4", "0001.2.3.4",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+1 555-1234", "+12345678901234567", "+1 2 .",
    "été+1 (301) 555-0346 190.137.223.204", "12 34 56 78 90 12 3", "a.b@c.d.e. f@g.hh@i.jj", "", "+", "@", "1",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_equal_the_plain_patterns(text):
    assert P.base_spans(text) == brute_base(text)


def test_base_spans_on_all_documents(documents):
    for r in documents.collect():
        assert P.base_spans(r["text"] or "") == brute_base(r["text"] or "")


def test_base_spans_are_linear_on_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+1 " * 100_000, "1." * 100_000):
        P.base_spans(text)


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(3)
    e, t, s = rng.normal(size=(4, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    lengths = np.array([4, 2, 3, 1])
    got = P.viterbi(e, lengths, t, s)
    for b, n in enumerate(lengths):
        score = lambda p: s[p[0]] + sum(e[b, k, p[k]] for k in range(n)) + sum(t[p[k], p[k + 1]] for k in range(n - 1))
        assert tuple(got[b, :n]) == max(itertools.product(range(3), repeat=int(n)), key=score)


def test_held_out_accuracy(tagger):
    right = total = 0
    for line in P.labelled_lines(seed=99):
        states = tagger([[w for w, _ in line]])[0]
        right += sum(P.STATES[s] == y for s, (_, y) in zip(states, line))
        total += len(line)
    assert right / total > 0.98


def test_skipped_lines_would_decode_to_outside(tagger, documents):
    lines = [
        [m[0] for m in re.finditer(r"[^\x20\x09-\x0D]+", line)]
        for r in documents.limit(60).collect()
        for line in (r["text"] or "").split("\n")
    ]
    skipped = [x for x in lines if x and not any(tagger.may_leave(w) for w in x)]
    assert len(skipped) > 100
    assert not any(s.any() for s in tagger(skipped))


def test_secrets_are_added_and_plain_text_is_left_alone(tagger):
    texts = [
        'erti token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72" the',
        "In 2024 the 3 gardens had 120 windows, token = none.",
        "Call +1 (826) 555-4081 190.137.223.204 now",
    ]
    (_, a), (_, b), (base, c) = P.find_all(texts, tagger)
    assert [s[0] for s in a] == ["secret"] and texts[0][a[0][1] : a[0][2]].startswith("cb1a")
    assert b == []
    assert [s[0] for s in base] == ["ip"] and [s[0] for s in c] == ["phone", "ip"]


def test_query_on_odd_rows_and_empty_table(odd_documents):
    out = P.detect(odd_documents).collect()
    assert len(out) == odd_documents.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == empty and r["spans"] == "" for r in out)
    assert P.detect(odd_documents.limit(0)).count() == 0
    assert P.redact(odd_documents).collect() == odd_documents.collect()


def test_redaction_takes_effect(spark):
    docs = spark.createDataFrame([(1, "mail me: jo.12@mail3.example.com, ok", "k")], "doc_id long, text string, spans string")
    assert P.redact(docs).first().asDict() == {"doc_id": 1, "text": "mail me: [email], ok", "spans": "k"}


def test_query_counts(spark):
    row = QUERIES["op5_crf_pii"](spark, SF_SMALL).agg({"n_email": "sum"}).first()
    assert row[0] > 0
