"""Packing: an exact round trip of the token ids, capacity and padding."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import packing
from ledgerlake.llm.queries import QUERIES
from llm_data import SF_SMALL, documents, duck, odd_documents  # noqa: F401


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_pieces(pieces, texts, tokenizer, size=1024):
    """``texts``: (doc_id, text) rows; every id in one piece, sequences gapless and within capacity."""
    want = sorted(
        (str(i), np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
        for i, t in texts
    )
    seqs, docs = {}, {}
    for p in pieces:
        seqs.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        assert p["length"] * 4 == len(p["ids"]) and p["length"] > 0
        docs.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], bytes(p["ids"])))
    padded = 0
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        padded += 0 if at & (at - 1) == 0 else size - at
    assert padded == 0
    counts = {}
    for i, raw in want:
        counts.setdefault((i, raw), 0)
        counts[(i, raw)] += 1
    for (i, n), parts in docs.items():
        by_start = {}
        for start, raw in parts:
            by_start.setdefault(start, []).append(raw)
        if all(len(v) == 1 for v in by_start.values()):
            raw = b"".join(v[0] for _, v in sorted(by_start.items()))
            assert len(raw) == 4 * n and counts.pop((str(i), raw)) == 1
        else:  # repeated rows: the same tokens in total
            total = sum(len(r) for v in by_start.values() for r in v)
            same = [k for k in counts if k[0] == str(i) and len(k[1]) == 4 * n]
            assert total == sum(len(k[1]) * counts.pop(k) for k in same)
    assert not counts


def test_round_trip_on_the_documents(documents, tokenizer):
    pieces = packing.pack(documents).collect()
    check_pieces(pieces, [(r["doc_id"], r["text"]) for r in documents.collect()], tokenizer)


def test_odd_rows(odd_documents, tokenizer):
    pieces = packing.pack(odd_documents.coalesce(1), group_tokens=3000).collect()
    check_pieces(pieces, [(r["doc_id"], r["text"]) for r in odd_documents.collect()], tokenizer)


def test_added_tokens_have_their_ids(spark, tokenizer):
    end = "<|endoftext|>"
    texts = [
        end, f"a {end} b", f"x{end}y", f"{end}{end} z", f"two  blanks  {end}\n\n{end} ", f"{end[:-1]} {end[1:]}", f"<{end}>",
        f" {end}", "<|endof text|>", "plain", f"été {end}日本", f"plain words first {end}",
    ]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [64, 220, 50256, 275] in want
    rows = list(enumerate(texts))
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_pieces(pieces, rows, tokenizer)


def test_empty_table(odd_documents):
    assert packing.pack(odd_documents.limit(0)).count() == 0


def test_descending_documents_go_to_the_cheapest_sequence():
    packer = packing.Packer(10, 1.0, 0.1, 0)
    for k, n in enumerate([3, 7, 8, 2]):
        packer.add(k, b"\0\0\0\0" * n)
    packer.flush()
    # 8 opens the first sequence, 7 the second, 3 fills the cheaper one, 2 the other
    assert [(r[0], r[2], r[4], r[5]) for r in packer.rows] == [(2, 8, 0, 0), (1, 7, 1, 0), (0, 3, 1, 7), (3, 2, 0, 8)]
    assert not packer.open and packer.tokens == 0


def test_query_digest(spark):
    out = QUERIES["op2_cost_packing"](spark, SF_SMALL)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(out.columns)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    row = packing.pack(docs).withColumn("c", F.crc32("ids")).first()
    assert row["c"] == zlib.crc32(bytes(row["ids"]))
