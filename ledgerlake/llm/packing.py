"""Operator 2: cost-balanced packing of tokenised documents into sequences.

Each task tokenises its rows and packs them in groups of bounded size, so no
text is shuffled and no task sees more than its own partition.  Within a group
of T tokens there are ``T // max_tokens`` sequences.  Documents longer than a
sequence give whole sequences first; what is left is assigned in descending
order of length, always to the sequence of lowest attention cost (linear plus
quadratic in each piece's length) that has capacity left, cut where the
capacity ends.  All these sequences come out exactly full.  What remains of a
group opens the next one; the remainder of a partition (under one sequence)
is laid out in sequences whose lengths are powers of two, so none is padded.

Token ids are those of the byte-level BPE vocabulary given by its rank file;
they equal those of the ``tokenizers`` file of the same vocabulary (tested),
which takes four times as long.  Its pre-tokenisation never joins text across a single blank between two non-blank characters, so a
text is the concatenation of its blank-separated parts and every distinct part
is encoded once per task (cache bounded by ``CACHE_PARTS`` entries, then
refilled).  Texts with any other use of white space are encoded whole.  Added
tokens (``<|endoftext|>``) are read from the ``tokenizers`` file beside the rank
file, if there is one; texts that hold one are cut at it and it gets its id.

Defined cases: NULL and empty texts are one id, the end id; repeated rows are
documents of their own; a NULL doc_id is carried through; an empty table gives
no rows.  Only doc_id and text are read.  A retried task repeats its ids and
numbers, as both depend on its rows and its partition number alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import byte_slices

CACHE_PARTS = 300_000
SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """String and id of the added tokens in the ``tokenizers`` file beside a rank file."""
    import json
    import os

    path = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    for t in added:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"added token {t['content']!r} does not stand for its plain string")
    return {t["content"]: t["id"] for t in added}


class PartEncoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import base64
        import re

        import numpy as np
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.bpe = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.n_bytes[rank] = len(token)
        self.cache: dict[bytes, bytes] = {}
        self.added = {t: i.to_bytes(4, "little") for t, i in added_tokens(path).items()}
        # of several at one place the longest
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def _encode(self, text: str) -> bytes:
        return self.bpe.encode_to_numpy(text).astype("<u4").tobytes()

    def _encode_cut(self, text: str) -> bytes:
        """A text that holds added tokens: they and the stretches between them, each apart."""
        return b"".join(self.added[s] if k % 2 else self._encode(s) for k, s in enumerate(self.cut.split(text)))

    def _learn(self, parts: list[bytes]) -> None:
        """Encode parts, each after a blank, in one call; cut where they end."""
        import numpy as np

        if not parts:
            return
        ids = self.bpe.encode_to_numpy((b" " + b" ".join(parts)).decode()).astype("<u4")
        ends = np.cumsum(self.n_bytes[ids])
        cuts = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)) + 1
        cuts = (cuts * 4).tolist()
        raw = ids.tobytes()
        self.cache.update((p, raw[a:b]) for p, a, b in zip(parts, [0, *cuts], cuts))

    def __call__(self, texts) -> list[bytes]:
        """``texts``: an Arrow string array without NULLs."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
        at = lists.offsets.to_numpy()
        at = (at - at[0]).tolist()
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        parts, odd = _distinct_parts(coded.dictionary)
        if len(self.cache) > CACHE_PARTS:
            self.cache = {}
        cache = self.cache
        self._learn([p for p, o in zip(parts, odd.tolist()) if not o and p not in cache])
        ids = [cache.get(p, b"") for p in parts]

        # all parts of all texts, one after the other, as one run of bytes
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(n) - n
        n_of = n[codes]
        ends = np.cumsum(n_of)
        pick = np.repeat(first[codes] - (ends - n_of), n_of) + np.arange(ends[-1] if len(ends) else 0)
        tokens = flat[pick].tobytes()
        ends = (np.concatenate(([0], ends)) * 4).tolist()

        is_odd = np.concatenate(([0], np.cumsum(odd[codes]))).tolist()
        holds = np.zeros(len(texts), bool)
        for token in self.added:
            holds |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        out: list[bytes] = []
        for k, (a, b, cut) in enumerate(zip(at[:-1], at[1:], holds.tolist())):
            if cut:
                out.append(self._encode_cut(texts[k].as_py()))
            elif is_odd[b] > is_odd[a]:
                out.append(self._encode(texts[k].as_py()))
            else:
                # the first part has no blank before it: encoded apart
                out.append(self._encode(parts[codes[a]].decode()) + tokens[ends[a + 1] : ends[b]])
        return out


def _distinct_parts(dictionary):
    """The strings as bytes, and which are empty or have white space at an end."""
    import numpy as np

    _, offsets, data = dictionary.buffers()
    n = len(dictionary)
    offs = np.frombuffer(offsets, np.int64, n + 1, dictionary.offset * 8)
    raw = data.to_pybytes() if data is not None else b""
    cuts = offs.tolist()
    parts = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
    size = np.diff(offs)
    odd = size == 0
    if raw:
        b = np.frombuffer(raw, np.uint8)
        head = b[np.minimum(offs[:-1], len(b) - 1)]
        tail = [b[np.maximum(offs[1:] - k, 0)] for k in (1, 2, 3)]
        odd |= (head <= 32) | (tail[0] <= 32)
        # white space beyond ASCII starts with one of these bytes
        wide = np.isin(head, (0xC2, 0xE1, 0xE2, 0xE3)) | (tail[1] == 0xC2) | np.isin(tail[2], (0xE1, 0xE2, 0xE3))
        for k in np.flatnonzero(wide & ~odd).tolist():
            s = parts[k].decode()
            odd[k] = s[0].isspace() or s[-1].isspace()
    return parts, odd


class Packer:
    """Groups of documents to pieces; keeps only what is not yet placed."""

    def __init__(self, max_tokens: int, linear: float, quadratic: float, first_id: int):
        self.size, self.linear, self.quadratic = max_tokens, linear, quadratic
        self.next_id = first_id
        self.open: list[tuple] = []  # (length, start, doc number, doc_id, doc_tokens, ids)
        self.tokens = 0
        self.rows: list[tuple] = []
        self.docs = 0

    def cost(self, n: int) -> float:
        return self.linear * n + self.quadratic * n * n

    def add(self, doc_id, ids: bytes) -> None:
        n = len(ids) // 4
        self.open.append((n, 0, self.docs, doc_id, n, ids))
        self.docs += 1
        self.tokens += n

    def _put(self, item: tuple, length: int, seq: int, offset: int) -> tuple:
        """Place the first ``length`` tokens of ``item``; what is left of it."""
        n, start, k, doc_id, total, ids = item
        self.rows.append((doc_id, start, length, total, seq, offset, ids[start * 4 : (start + length) * 4]))
        return (n - length, start + length, k, doc_id, total, ids)

    def flush(self) -> None:
        """Fill as many whole sequences as the open documents allow."""
        free = self.tokens // self.size
        self.tokens -= free * self.size
        items = []
        for item in self.open:
            while item[0] >= self.size:
                item = self._put(item, self.size, self.next_id, 0)
                self.next_id += 1
                free -= 1
            if item[0]:
                items.append(item)
        items.sort(key=lambda x: (-x[0], x[2]))
        heap = [(0.0, self.next_id + k, 0) for k in range(free)]
        self.next_id += free
        self.open = []
        for item in items:
            while item[0] and heap:
                cost, seq, used = heap[0]
                length = min(item[0], self.size - used)
                item = self._put(item, length, seq, used)
                if used + length == self.size:
                    heapq.heappop(heap)
                else:
                    heapq.heapreplace(heap, (cost + self.cost(length), seq, used + length))
            if item[0]:
                self.open.append(item)

    def finish(self) -> None:
        """The rest of the partition, in sequences of power-of-two lengths."""
        self.flush()
        bits = [1 << b for b in range(self.size.bit_length(), -1, -1) if self.tokens >> b & 1]
        seqs = [(self.next_id + k, n) for k, n in enumerate(bits)]
        self.next_id += len(seqs)
        used, k = 0, 0
        for item in sorted(self.open, key=lambda x: (-x[0], x[2])):
            while item[0]:
                seq, n = seqs[k]
                length = min(item[0], n - used)
                item = self._put(item, length, seq, used)
                used += length
                if used == n:
                    used, k = 0, k + 1
        self.open, self.tokens = [], 0


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    max_tokens: int = 1024,
    end_id: int = 0,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
    group_tokens: int = 1 << 21,
) -> DataFrame:
    """One row per piece: which tokens of which document lie where.

    ``ids`` holds the piece's token ids (little-endian unsigned 32-bit).
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        encode = PartEncoder(path)
        packer = Packer(max_tokens, linear, quadratic, TaskContext.get().partitionId() << 33)
        end = end_id.to_bytes(4, "little")
        types = [pa.int64()] * 6 + [pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

        def taken():
            rows, packer.rows = packer.rows, []
            for i in range(0, len(rows), 20_000):
                cols = zip(*rows[i : i + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for part in byte_slices(batches):
            texts = pc.fill_null(part.column("text"), "")
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(texts)):
                packer.add(doc_id, ids + end)
            if packer.tokens >= group_tokens:
                packer.flush()
                yield from taken()
        packer.finish()
        yield from taken()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
