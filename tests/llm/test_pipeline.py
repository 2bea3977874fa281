"""The pipeline, stage by stage, against the brute-force forms of its operators."""

import numpy as np

import corpus_pipeline as CP
from ledgerlake.llm import pii_crf
from llm_data import SF_SMALL, documents, odd_documents  # noqa: F401
from test_line_dedup import brute as brute_lines
from test_ngram_join import brute as brute_groups
from test_quality_rules import brute as brute_counts


def staged(df):
    from ledgerlake.llm.common import staged as write

    return write(df, "test")


def test_stages_equal_brute_force(spark, documents):
    docs, columns = documents, documents.columns
    stages = dict(CP.STAGES)
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}

    docs = staged(stages["quality rules"](spark, docs, SF_SMALL))
    counts = {i: brute_counts(t) for i, t in rows.items()}
    rows = {i: t for i, t in rows.items() if counts[i][0] >= 50 and 100 * counts[i][4] <= 50 * counts[i][0]}
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == rows

    docs = staged(stages["line dedup"](spark, docs, SF_SMALL))
    gone = brute_lines(list(rows.items()))
    for i, lines in gone.items():
        rows[i] = "\n".join(s for k, s in enumerate(rows[i].split("\n")) if k not in lines)
    rows = {i: t for i, t in rows.items() if t.split()}
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == rows

    docs = staged(stages["near duplicates"](spark, docs, SF_SMALL))
    rows = {i: rows[i] for i in {int(c) for _, _, c in brute_groups(list(rows.items()))}}
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == rows

    docs = staged(stages["personal data"](spark, docs, SF_SMALL))
    tagger = pii_crf.LineTagger(pii_crf.train(pii_crf.labelled_lines()))
    found = pii_crf.find_all(list(rows.values()), tagger)
    rows = {i: pii_crf.redact_text(t, spans) for (i, t), (_, spans) in zip(rows.items(), found)}
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == rows

    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = {}
    for r in stages["packing"](spark, docs, SF_SMALL).collect():
        parts.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()))
    got = {i: [x for _, ids in sorted(p) for x in ids] for i, p in parts.items()}
    assert got == {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in rows.items()}


def test_one_of_each_group_stays_on_odd_rows(spark, odd_documents):
    out = dict(CP.STAGES)["near duplicates"](spark, odd_documents, SF_SMALL)
    assert out.columns == odd_documents.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(["1", "2", "3", "4", "5", "7", "None"])
