"""Operator 8: repeated passages across documents, by pairwise line alignment.

Documents that share a passage are found through run hashes: of the runs of
adjacent lines with at least ``min_words`` words, the shortest from each line on
and the shortest up to each line.  Every line of a common block lies in such a
run inside the block, so a document is compared with the earliest holder of
each of its runs and nothing is lost by leaving out the other holders, however
many there are; the number of pairs grows with the lines, not with the square
of a passage's holders.  The pairs are aligned by patience diff over the line
hashes; common blocks (runs of lines aligned side by side in both) of at least
``min_words`` words are deleted from the later document.  Blocks the alignment
cannot follow, as one document holds them twice or both in another order, are
found in the pair by their runs and deleted as well, so a line goes exactly if
an earlier document holds a run of ``min_words`` words around it.  The earliest
holder of a block always keeps it, repeated inside or not.

Only line hashes are shuffled for the alignment, and only those of lines that
two documents share; texts meet the list of lines to delete once.

Defined cases: documents are ordered by doc_id, then by the hash of their text,
NULL ids last; rows alike in both are one document and all get the same result;
NULL texts stay NULL, empty ones empty; lines without a word are neither
compared nor deleted; an empty table gives no rows.  Lines count as equal by a
64-bit hash and their number of words.  Other columns are carried along.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_PATTERN, byte_slices, staged

MIN_WORDS = 40
#: Limits nothing any more; the tests still compare with the pairs of lines so rare.
RARE = 8


def _pairs_in_order(matches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of matches that rises on both sides (sorted by the first)."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(matches)
    for k, (_, j) in enumerate(matches):
        at = bisect_left(tails, j)
        before[k] = ends[at - 1] if at else -1
        tails[at : at + 1], ends[at : at + 1] = [j], [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(matches[k])
        k = before[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions of two sequences: equal ends, then unique anchors, gap by gap."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        ca, cb = Counter(a[i:m]), Counter(b[j:n])
        where = {b[k]: k for k in range(j, n) if cb[b[k]] == 1}
        anchors = _pairs_in_order([(k, where[a[k]]) for k in range(i, m) if ca[a[k]] == 1 and a[k] in where])
        if anchors:
            out.extend(anchors)
            edges = [(i - 1, j - 1), *anchors, (m, n)]
            todo.extend((p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:]))
    return sorted(out)


def shortest_runs(seq: list[tuple], min_words: int) -> list[tuple[int, int]]:
    """From and to (exclusive): runs of adjacent lines that reach ``min_words``, the shortest from and up to each line."""
    out: set[tuple[int, int]] = set()
    a = begun = total = 0
    for b, x in enumerate(seq):
        if b and seq[b - 1][0] + 1 != x[0]:
            a = begun = b
            total = 0
        total += x[3]
        while total - seq[a][3] >= min_words:
            total -= seq[a][3]
            a += 1
        if total >= min_words:
            out.update((k, b + 1) for k in range(begun, a + 1))
            out.add((a, b + 1))
            begun = max(begun, a + 1)
    return sorted(out)


def blocks_to_delete(early: list[tuple], late: list[tuple], min_words: int) -> list[int]:
    """Line numbers of ``late`` inside common blocks; items are (place, line, hash, words).

    What the alignment leaves (passages repeated in one of the two or in another
    order) is looked up by runs, whose shortest ones cover every common block.
    """
    mine, theirs = [x[2:] for x in late], [x[2:] for x in early]
    aligned = patience(mine, theirs)
    out: list[int] = []
    run: list[int] = []
    last = None
    for i, j in [*aligned, (None, None)]:
        here = None if i is None else (late[i][0], early[j][0])
        if run and (here is None or (here[0] - 1, here[1] - 1) != last):
            if sum(late[k][3] for k in run) >= min_words:
                out.extend(late[k][1] for k in run)
            run = []
        if i is not None:
            run.append(i)
        last = here
    if len(out) < len(late):
        gone = set(out)
        left = [(a, b) for a, b in shortest_runs(late, min_words) if any(late[k][1] not in gone for k in range(a, b))]
        held = {tuple(theirs[a:b]) for a, b in shortest_runs(early, min_words)} if left else set()
        gone.update(late[k][1] for a, b in left if tuple(mine[a:b]) in held for k in range(a, b))
        out = sorted(gone)
    return out


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shared_lines(docs: DataFrame) -> DataFrame:
    """doc (order key), place, line, h, w: lines with a word, held by two documents at least."""
    doc = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("long").alias("id"), _key(F.col("text")).alias("key"))
    numbered = F.transform(F.split("text", "\n"), lambda s, i: F.struct(i.alias("line"), s.alias("s")))
    worded = F.filter(numbered, lambda x: x["s"].rlike(r"[^\x20\x09-\x0D]"))
    lines = (
        docs.filter(F.col("text").isNotNull())
        .select(doc.alias("doc"), F.posexplode(worded).alias("place", "x"))
        .select(
            "doc",
            "place",
            F.col("x.line").alias("line"),
            F.xxhash64("x.s").alias("h"),
            F.size(F.array_remove(F.split("x.s", SPACE_PATTERN), "")).alias("w"),
        )
    )
    lines = staged(lines, "op8-lines")
    holders = (
        lines.groupBy("h", "w")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("final"))
        .filter("first <> final")
        .select("h", "w", "first")
    )
    return staged(lines.join(holders, ["h", "w"]).dropDuplicates(["doc", "place"]), "op8-shared")


def sequences(shared: DataFrame) -> DataFrame:
    """doc, seq: the shared lines of every document in order."""
    return shared.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("place", "line", "h", "w"))).alias("seq"))


def candidate_pairs(seqs: DataFrame, min_words: int) -> DataFrame:
    """early, late: every document with the earliest holder of each of its shortest runs."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            docs, hashes = [], []
            for k, row in enumerate(batch.column("seq").to_pylist()):
                seq = [(x["place"], x["line"], x["h"], x["w"]) for x in row]
                raw = array("q", [v for x in seq for v in x[2:]]).tobytes()
                mine = {blake2b(raw[16 * a : 16 * b], digest_size=8).digest() for a, b in shortest_runs(seq, min_words)}
                docs += [k] * len(mine)
                hashes += [int.from_bytes(h, "little", signed=True) for h in mine]
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(docs, pa.int64())), pa.array(hashes, pa.int64())], ["doc", "run"])

    doc_type = seqs.schema["doc"].dataType.simpleString()
    runs = staged(seqs.mapInArrow(run, f"doc {doc_type}, run long"), "op8-runs")
    first = runs.groupBy("run").agg(F.min("doc").alias("early"), F.max("doc").alias("final")).filter("early <> final")
    return (
        runs.join(first.select("run", "early"), "run")
        .filter("early < doc")
        .select("early", F.col("doc").alias("late"))
        .distinct()
    )


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc, lines: the line numbers to delete from each document that loses any."""
    seqs = sequences(shared_lines(docs))
    pairs = staged(candidate_pairs(seqs, min_words), "op8-pairs")
    both = pairs.join(seqs.select(F.col("doc").alias("early"), F.col("seq").alias("a")), "early").join(
        seqs.select(F.col("doc").alias("late"), F.col("seq").alias("b")), "late"
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            late, lines = [], []
            for row in batch.to_pylist():
                a, b = ([(x["place"], x["line"], x["h"], x["w"]) for x in row[k]] for k in "ab")
                gone = blocks_to_delete(a, b, min_words)
                late += [row["late"]] * len(gone)
                lines += gone
            kind = batch.schema.field("late").type
            yield pa.RecordBatch.from_arrays([pa.array(late, kind), pa.array(lines, pa.int32())], ["doc", "line"])

    doc_type = pairs.schema["late"].dataType.simpleString()
    found = both.select("late", "a", "b").mapInArrow(run, f"doc {doc_type}, line int")
    return staged(found.groupBy("doc").agg(F.sort_array(F.collect_set("line")).alias("lines")), "op8-deletions")


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated blocks, plus ``deleted_lines`` (array of line numbers)."""
    gone = deletions(docs, min_words).select(
        F.col("doc.id").alias("_id"), F.col("doc.key").alias("_key"), F.col("lines").alias("deleted_lines")
    )
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_doc"), _key(F.col("text")).alias("_text"))
    # always the same plan: texts are dealt out by id once, whatever the list's size
    joined = row.join(gone.hint("merge"), (F.col("_doc").eqNullSafe(F.col("_id"))) & (F.col("_text") == F.col("_key")), "left")
    joined = joined.select("_row.*", F.coalesce("deleted_lines", F.array().cast("array<int>")).alias("_gone"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part in byte_slices(batches):
            k, g = part.schema.get_field_index("text"), part.schema.get_field_index("_gone")
            texts, lists = part.column(k).to_pylist(), part.column(g).to_pylist()
            for i, lines in enumerate(lists):
                if lines:
                    drop = set(lines)
                    texts[i] = "\n".join(s for j, s in enumerate(texts[i].split("\n")) if j not in drop)
            yield part.set_column(k, part.schema.field(k), pa.array(texts, part.schema.field(k).type))

    schema = joined.schema
    name = "deleted_lines" if "deleted_lines" not in docs.columns else "deleted_lines_"
    return joined.mapInArrow(run, schema).withColumnRenamed("_gone", name)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; documents of which nothing but repeats was there go."""
    out = remove_repeats(docs)
    marker = [c for c in out.columns if c not in docs.columns][0]
    empty = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return out.filter((F.size(marker) == 0) | ~empty).select(*docs.columns)
