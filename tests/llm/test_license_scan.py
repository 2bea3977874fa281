"""Licence scans: alignment, planted notices whole, altered and repeated, the exact bound, odd rows."""

import itertools
import random

from ledgerlake.llm import license_scan as S
from ledgerlake.llm.queries import QUERIES
from llm_data import SF_SMALL, documents, odd_documents  # noqa: F401

SCAN = S.Scanner(S.TEMPLATES, 0.8, 1.5)


def found(text):
    return {name: (n / size, times) for name, n, size, _, _, times in SCAN(text)}


def test_common_subsequence_is_longest():
    rnd = random.Random(2)
    for _ in range(40):
        a, b = ([rnd.choice("abc") for _ in range(rnd.randint(0, 6))] for _ in range(2))
        got = S._common(a, b, 0, len(a), 0, len(b))
        subs = {t for k in range(len(a) + 1) for t in itertools.combinations(a, k)}
        longest = max(k for k in range(len(b) + 1) for t in itertools.combinations(b, k) if t in subs)
        assert len(got) == longest and all(a[i] == b[j] for i, j in got)


def test_whole_altered_repeated_and_partial_notices():
    noise = "the of and to in is under this work " * 30
    for name, text in S.TEMPLATES.items():
        assert found(noise + text + " " + noise)[name] == (1.0, 1), name
        assert found((text + "\n") * 7)[name][1] == 7, name
        words = text.split()
        if len(words) > 20:
            changed = [w for k, w in enumerate(words) if k % 9]
            assert 0.8 <= found(noise + " ".join(changed))[name][0] < 1, name
        assert name not in found(noise + " ".join(words[: len(words) // 2]))
    assert found(noise) == {} and found("") == {}
    # the words are there, but far apart
    spread = (" filler" * 40 + " ").join(S.TEMPLATES["MIT"].split())
    assert found(spread) == {}


def test_documents_with_a_literal_notice_are_found(spark, documents):
    rows = QUERIES["op10_patience_licenses"](spark, SF_SMALL).collect()
    got = {(r["doc_id"], r["license"]) for r in rows}
    want = {
        (r["doc_id"], name)
        for r in documents.collect()
        for name, text in S.TEMPLATES.items()
        if text in (r["text"] or "")
    }
    assert want and want <= got
    assert all(0.8 <= r["coverage"] <= 1 and r["first_word"] <= r["last_word"] for r in rows)


def test_odd_rows(spark, odd_documents):
    assert S.scan(odd_documents).count() == 0
    assert S.scan(odd_documents.limit(0)).count() == 0
    docs = spark.createDataFrame([(None, "Released under the MIT License.", "x")] * 2, "doc_id long, text string, license string")
    assert [(r["doc_id"], r["license"]) for r in S.scan(docs).collect()] == [(None, "MIT-notice")] * 2
