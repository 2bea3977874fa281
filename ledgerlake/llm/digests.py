"""Operator 6: improbable-feature digests of documents.

Every 64-byte window of a text has an entropy (a whole number from 0 to 1000).
A histogram over all windows of all documents says how rare each entropy is;
its order is the precedence of features (entropies near the ends of the scale
carry no information and never count).  In every run of ``POPULARITY``
neighbouring windows the rarest one gets a point (leftmost of equals), and
windows with at least ``threshold`` points are the text's features.  Features
are hashed and put into a chain of Bloom filters, each closed at ``CAPACITY``
features.  Likeness compares the filters' common bits with what chance and
full overlap would give, filter by filter of the shorter chain.

The next document (by descending id) is found by sorting the documents by id
over range partitions; each partition needs only the first document of the
next one, found with a short table of partition heads.

Defined cases: NULL text is empty; rows with equal ids are ordered by text;
rows with NULL id come last; a text without features (short or uniform) has
its bytes hashed as the only feature, so equal texts always have equal
fingerprints and likeness 1, and two different ones almost surely 0; a single
document is its own next one; an empty table gives no rows.  Only doc_id and
text are read.  Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices

WINDOW = 64
POPULARITY = 64
SCALE = 1000
CAPACITY = 160
FILTER_BITS = 2048
HASHES = 5
#: Bytes worked on at a time.
BLOCK = 1 << 17
#: Part of the room between chance and full overlap that counts as chance still.
SLACK = 0.1
#: Entropies outside carry no information: runs of few symbols, or pure noise.
LOWEST, HIGHEST = 100, 990
_SHIFTS = (np.arange(HASHES) * 11).astype(np.uint64)


def _terms():
    """c * log2(c) for c = 0 .. WINDOW, as whole numbers: sums are exact in any order."""
    c = np.arange(WINDOW + 1, dtype=np.float64)
    return np.rint(c * np.log2(np.maximum(c, 1)) * (1 << 20)).astype(np.int64)


def entropies(data):
    """Entropy of every window of a byte array, scaled to 0 .. SCALE.

    Moving a window by one byte changes two terms; how often the leaving and
    the entering byte occur in the bytes between is counted over all windows
    at once, one lag at a time.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    terms = _terms()
    ahead, behind = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        ahead[:-lag] += same
        behind[lag:] += same
    first = int(terms[np.bincount(data[:WINDOW], minlength=256)].sum())
    left = ahead[: n - WINDOW]  # the byte that leaves, among the 63 after it
    entered = behind[WINDOW:]  # the byte that enters, among the 63 before it
    step = terms[1:] - terms[:-1]
    sums = first + np.concatenate(([0], np.cumsum(step[entered] - step[left])))
    top = WINDOW * 6 * (1 << 20)  # all bytes different: log2(64) = 6 bits
    return np.clip((top - sums) * SCALE // top, 0, SCALE)


def layout(raws: list[bytes]):
    """Texts side by side between margins, their starts, and which windows lie in one text.

    The 63 windows across a border belong to no text, so no run of
    ``POPULARITY`` windows sees two texts: a text's features do not depend on
    its neighbours.
    """
    margin = b"\0" * (WINDOW + POPULARITY)
    data = np.frombuffer(b"".join([margin, *raws, margin]), np.uint8)
    size = np.fromiter(map(len, raws), np.int64, len(raws))
    starts = len(margin) + np.cumsum(size) - size
    step = np.zeros(len(data) + 1, np.int32)
    inside = np.maximum(size - WINDOW + 1, 0)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + inside, -1)
    return data, starts, np.cumsum(step)[: len(data) - WINDOW + 1] > 0


def features(data, valid, rank, threshold: int):
    """Starts of the selected windows: the rarest in enough neighbourhoods."""
    score = np.where(valid, rank[entropies(data)], SCALE + 1)
    n = len(score)
    bits = int(n).bit_length()
    kind = np.int32 if bits + 11 <= 31 else np.int64
    # smallest (rank, position) of every run of POPULARITY windows, by doubling
    low, span = (score.astype(kind) << bits) | np.arange(n, dtype=kind), 1
    while span < POPULARITY:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    points = np.bincount(low & ((1 << bits) - 1), minlength=n)
    return np.flatnonzero((points >= threshold) & (score <= SCALE))


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def feature_hashes(data, starts):
    """64-bit hashes of the windows at ``starts``."""
    words = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[starts]
    words = np.ascontiguousarray(words).view("<u8")
    h = np.full(len(starts), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words.shape[1]):
        h = _mix(h ^ words[:, k])
    return h


def fingerprints(texts: list[str], rank, threshold: int = 16) -> list[bytes]:
    """Chained Bloom filters of each text: the feature count (2 bytes), then the bits, per filter."""
    raws = [t.encode() for t in texts]
    out: list[bytes] = []
    i = 0
    while i < len(raws):
        # blocks that stay in the processor's cache; a longer text is one block
        j, size = i, 0
        while j < len(raws) and (j == i or size + len(raws[j]) <= BLOCK):
            size += len(raws[j])
            j += 1
        out += _block_fingerprints(raws[i:j], rank, threshold)
        i = j
    return out


def _block_fingerprints(raws: list[bytes], rank, threshold: int) -> list[bytes]:
    data, starts, valid = layout(raws)
    found = features(data, valid, rank, threshold)
    hashes = feature_hashes(data, found)
    cuts = np.searchsorted(found, starts).tolist() + [len(found)]
    out = []
    for k, raw in enumerate(raws):
        h = hashes[cuts[k] : cuts[k + 1]]
        if len(h):
            # a window that comes again adds nothing; the order of first sight stays
            _, first = np.unique(h, return_index=True)
            h = h[np.sort(first)]
        else:
            h = np.frombuffer(hashlib.sha256(raw).digest()[:8], "<u8")
        chain = []
        for i in range(0, len(h), CAPACITY):
            part = h[i : i + CAPACITY]
            bits = np.zeros(FILTER_BITS, np.uint8)
            at = (part[:, None] >> _SHIFTS) & np.uint64(FILTER_BITS - 1)
            bits[at.astype(np.int64).ravel()] = 1
            chain.append(len(part).to_bytes(2, "little") + np.packbits(bits).tobytes())
        out.append(b"".join(chain))
    return out


_SIZE = 2 + FILTER_BITS // 8


def _filters(print_: bytes):
    rows = np.frombuffer(print_, np.uint8).reshape(-1, _SIZE)
    counts = rows[:, 0].astype(np.int64) + 256 * rows[:, 1].astype(np.int64)
    return counts, rows[:, 2:]


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1; the mean, over the shorter chain's filters, of the best normalised overlap."""
    if a == b:
        return 1.0
    (na, fa), (nb, fb) = _filters(a), _filters(b)
    if len(fa) > len(fb) or (len(fa) == len(fb) and a > b):
        (na, fa), (nb, fb) = (nb, fb), (na, fa)
    ones_a = np.bitwise_count(fa).sum(axis=1).astype(np.int64)
    ones_b = np.bitwise_count(fb).sum(axis=1).astype(np.int64)
    words_a, words_b = np.ascontiguousarray(fa).view("<u8"), np.ascontiguousarray(fb).view("<u8")
    total = weight = 0.0
    for k in range(len(fa)):
        common = np.bitwise_count(words_b & words_a[k]).sum(axis=1)
        least = np.minimum(ones_b, ones_a[k])
        chance = ones_b * ones_a[k] / FILTER_BITS
        floor = chance + SLACK * (least - chance)
        share = np.clip((common - floor) / np.maximum(least - floor, 1e-9), 0.0, 1.0)
        total += float(share.max()) * int(na[k])
        weight += int(na[k])
    return total / weight


def edited(text: str, follower: str) -> str:
    """The last half of the code points replaced by the first as many of ``follower``."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def entropy_counts(docs: DataFrame) -> DataFrame:
    """entropy, n: windows of all texts by entropy; at most SCALE + 1 rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(SCALE + 1, np.int64)
        for part in byte_slices(batches):
            raws = [t.encode() for t in part.column("text").to_pylist() if t]
            i = 0
            while i < len(raws):
                j, size = i, 0
                while j < len(raws) and (j == i or size + len(raws[j]) <= BLOCK):
                    size += len(raws[j])
                    j += 1
                data, _, valid = layout(raws[i:j])
                total += np.bincount(entropies(data)[valid], minlength=SCALE + 1)
                i = j
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["entropy", "n"])

    return docs.select("text").mapInArrow(run, "entropy int, n long").groupBy("entropy").agg(F.sum("n").alias("n"))


def ranks(counts: list[tuple[int, int]]):
    """Rank by entropy, rarest first; entropies without information rank SCALE + 1."""
    n = np.zeros(SCALE + 1, np.int64)
    for entropy, count in counts:
        n[entropy] = count
    order = np.lexsort((np.arange(SCALE + 1), n))
    rank = np.empty(SCALE + 1, np.int64)
    rank[order] = np.arange(SCALE + 1)
    rank[:LOWEST] = SCALE + 1
    rank[HIGHEST + 1 :] = SCALE + 1
    return rank


def with_followers(docs: DataFrame, parts: int) -> DataFrame:
    """bucket, follower, doc_id, text: rows of a bucket in descending order of id,
    after them (``follower``) the first row of the next bucket.

    Buckets are ranges of ids between approximate quantiles; one shuffle of the
    texts, plus one text per bucket.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = 4 * parts
    cuts = docs.approxQuantile("doc_id", [k / buckets for k in range(1, buckets)], 0.2 / buckets)
    cuts = sorted({int(c) for c in cuts})
    above = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c > F.col("doc_id"))) if cuts else F.lit(0)
    last = len(cuts) + 1
    bucketed = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), last).otherwise(above))
    # first ids of the buckets: at most as many rows as buckets
    heads = {r["bucket"]: r["id"] for r in bucketed.groupBy("bucket").agg(F.max("doc_id").alias("id")).collect()}
    full = sorted(heads)
    moves = {heads[b]: full[k - 1] for k, b in enumerate(full)}  # the first one follows the last bucket
    ids = [i for i in moves if i is not None]
    is_head = F.col("doc_id").isin(ids) if ids else F.lit(False)
    is_head = is_head | F.col("doc_id").isNull() if None in moves else is_head
    pairs = [F.lit(x) for i in ids for x in (i, moves[i])]
    target = F.element_at(F.create_map(*pairs), F.col("doc_id")) if ids else F.lit(0)
    target = F.when(F.col("doc_id").isNull(), F.lit(moves.get(None, 0))).otherwise(target)
    followers = (
        docs.filter(is_head).groupBy("doc_id").agg(F.max("text").alias("text")).select(
            target.cast("int").alias("bucket"), F.lit(True).alias("follower"), "doc_id", "text"
        )
    )
    rows = bucketed.select(F.col("bucket").cast("int"), F.lit(False).alias("follower"), "doc_id", "text")
    return (
        rows.unionByName(followers)
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "follower", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    )


def digests(docs: DataFrame, threshold: int = 16) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints (hex) and both likenesses."""
    rank = ranks([(r["entropy"], r["n"]) for r in entropy_counts(docs).collect()])
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held = None  # the row before, not yet answered: (doc_id, text, fingerprint)
        for part in byte_slices(batches):
            ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
            follows = part.column("follower").to_pylist()
            prints = fingerprints(texts, rank, threshold)
            todo = []  # (row, its next row)
            for row in zip(ids, texts, prints, follows):
                if held is not None:
                    todo.append((held, row))
                held = None if row[3] else row
            changed = [edited(a[1], b[1]) for a, b in todo]
            new = fingerprints(changed, rank, threshold)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[0] for a, _ in todo], pa.int64()),
                    pa.array([len(a[1]) for a, _ in todo], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array([a[2].hex() for a, _ in todo], pa.string()),
                    pa.array([p.hex() for p in new], pa.string()),
                    pa.array([likeness(a[2], p) for (a, _), p in zip(todo, new)], pa.float64()),
                    pa.array([likeness(a[2], b[2]) for a, b in todo], pa.float64()),
                ],
                [f.split(" ")[0] for f in schema.split(", ")],
            )

    return with_followers(docs, parts).mapInArrow(run, schema)
