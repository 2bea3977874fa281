"""Operator 9: SentencePiece encoding with seeded merge-dropout, and decoding.

A merge-type model joins, among all neighbouring pieces whose concatenation is
a piece, the pair of best score (leftmost of equals) until none is left.  With
dropout a candidate merge is skipped for good with probability ``dropout``; the
draw is a hash keyed by the seed, the document, the word's position in it, the
word and the candidate's place, so every occurrence has draws of its own, the
same run gives the same pieces on any cluster and another seed gives others.

Pieces never join across a blank, so texts are cut into words with the blanks
before them.  Every distinct (word, blanks) of a slice is segmented once without
dropout; occurrences none of whose candidates on that way is dropped take these
pieces, which are then theirs exactly.  All others are segmented each for
itself, many in step: a round merges the best candidate of each word.

Decoding is exact for every text: characters without a piece are byte pieces,
and so is the blank mark itself where a text contains it.

Defined cases: NULL and empty texts have no pieces and decode to the empty
text; white space is kept as it is; repeated rows (same id) get the same
pieces; a NULL id counts as 0 in the key; an empty table gives no rows.  Only
doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import byte_slices
from .shingles import mix

MARK = "▁"
#: Bytes of text segmented at a time; bounds a task's memory.
SLICE = 2 << 20
#: Symbols (or candidates) worked on in step; bounds the memory of a slice's occurrences.
STEP = 1 << 17
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def ragged(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``flat[first : first + size]`` one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(first - (ends - size), size) + np.arange(total)]


class Model:
    """Pieces, bytes, and the table of all joins, from a merge-type model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(k) for k in range(n)]
        plain = [not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)) for k in range(n)]
        self.byte = np.zeros(256, np.int64)
        raw = []
        for k, piece in enumerate(pieces):
            if sp.is_byte(k):
                value = int(piece[3:5], 16)
                self.byte[value] = k
                raw.append(bytes([value]))
            else:
                raw.append(piece.replace(MARK, " ").encode() if plain[k] else b"")
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size

        ids = {p: k for k, p in enumerate(pieces) if plain[k]}
        self.char = np.full(0x110000, -1, np.int64)
        for p, k in ids.items():
            if len(p) == 1:
                self.char[ord(p)] = k
        self.mark = ids[MARK]
        # best score first; equal scores share a rank
        scores = np.array([sp.get_score(k) for k in range(n)])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        joins = {}
        for p, k in ids.items():
            for cut in range(1, len(p)):
                a, b = ids.get(p[:cut]), ids.get(p[cut:])
                if a is not None and b is not None:
                    joins[a * n + b] = k
        self.n = n
        self.keys = np.array(sorted(joins), np.int64)
        self.joined = np.array([joins[k] for k in self.keys.tolist()], np.int64)
        self.join_rank = rank[self.joined]
        # the place of a key by some bits of a hash; only where keys share a slot it is searched
        bits = 21
        self.shift = np.uint64(64 - bits)
        slot = self._slot(self.keys)
        self.place = np.full(1 << bits, -1, np.int32)
        self.place[slot] = np.arange(len(self.keys), dtype=np.int32)
        self.crowded = np.bincount(slot, minlength=1 << bits) > 1

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * _K[0]) >> self.shift).astype(np.int64)

    def join(self, left: np.ndarray, right: np.ndarray):
        """(index into the joins, exists) of neighbouring pieces."""
        keys = left * self.n + right
        slot = self._slot(keys)
        found = self.place[slot].astype(np.int64)
        maybe = np.flatnonzero(found >= 0)
        hit = self.keys[found[maybe]] == keys[maybe]
        other = maybe[~hit]
        other = other[self.crowded[slot[other]]]
        if len(other):
            at = np.minimum(np.searchsorted(self.keys, keys[other]), len(self.keys) - 1)
            found[other] = at
        exists = np.zeros(len(keys), bool)
        exists[maybe[hit]] = True
        exists[other] = self.keys[found[other]] == keys[other]
        return found, exists


@lru_cache(maxsize=1)
def loaded(path: str) -> Model:
    """The model of a worker process: loaded once for all of its tasks."""
    return Model(path)


def _limit(dropout: float) -> np.uint64:
    return np.uint64(min(int(dropout * 2.0**64), (1 << 64) - 1))


def _place_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) * _K[1]) ^ (right.astype(np.uint64) * _K[2])


def _drawn(key: np.ndarray, place: np.ndarray, joined: np.ndarray) -> np.ndarray:
    return mix(mix(key ^ place) ^ (joined.astype(np.uint64) * _K[3]))


def steps(sizes: np.ndarray):
    """Ranges of about ``STEP`` in total size."""
    if len(sizes):
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // STEP)) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)])


def segment(model: Model, syms: np.ndarray, sizes: np.ndarray, keys: np.ndarray, dropout: float, log=None, begin=None):
    """Pieces of many words: flat ids and their number per word.

    ``syms`` are the words' first pieces one after the other (overwritten),
    ``sizes`` their numbers, ``keys`` the words' hash keys.  ``log`` takes the
    candidates met: word, places of both pieces, join.  ``begin`` is what
    ``model.join`` says of each first piece and the next one of its word.
    """
    limit = _limit(dropout)
    none = np.int64(1) << np.int64(62)
    done_ids, done_word, done_place = [], [], []

    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    start = (np.arange(len(syms)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)  # place in the word
    order = np.full(len(syms), none)  # rank and place of the merge with the next piece
    join = np.zeros(len(syms), np.int32)
    dirty = np.ones(len(syms), bool)
    while len(syms):
        # candidates that are new: look up, then draw
        order[dirty] = none
        if begin is None:
            at = np.flatnonzero(dirty[:-1] & (word[:-1] == word[1:]))
            found, exists = model.join(syms[at], syms[at + 1])
            at, found = at[exists], found[exists]
        else:
            at = np.flatnonzero(begin[1])
            found, begin = begin[0][at], None
        if log is not None:
            log.append((word[at], start[at], start[at + 1], found))
        if dropout > 0 and len(at):
            kept = _drawn(keys[word[at]], _place_key(start[at], start[at + 1]), model.joined[found]) >= limit
            at, found = at[kept], found[kept]
        order[at] = (model.join_rank[found] << 32) | start[at]
        join[at] = found
        dirty[:] = False

        first = np.concatenate(([True], word[1:] != word[:-1]))
        begins = np.flatnonzero(first)
        best = np.minimum.reduceat(order, begins)
        counts = np.diff(np.append(begins, len(syms)))
        live = np.repeat(best < none, counts)
        if not live.all():
            done_ids.append(syms[~live])
            done_word.append(word[~live])
            done_place.append(start[~live])
        chosen = np.flatnonzero((order == np.repeat(best, counts)) & live)
        syms[chosen] = model.joined[join[chosen]]
        dirty[chosen] = True
        back = chosen[chosen > 0] - 1
        dirty[back[word[back] == word[back + 1]]] = True
        live[chosen + 1] = False  # taken up by the piece before
        syms, word, start, order, join, dirty = (x[live] for x in (syms, word, start, order, join, dirty))
    ids, word, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_ids, done_word, done_place))
    by = np.lexsort((place, word))
    return ids[by], np.bincount(word, minlength=len(sizes))


class Encoder:
    def __init__(self, model: Model, seed: int, dropout: float):
        self.model, self.dropout = model, dropout
        self.seed = mix(np.array([seed & (1 << 63) - 1], np.uint64) + _K[0])[0]

    def __call__(self, doc_ids: list, texts) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of pieces of each text of an Arrow string array without NULLs."""
        import pyarrow as pa
        import pyarrow.compute as pc

        model = self.model
        lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
        offs = lists.offsets.to_numpy()
        offs = offs - offs[0]
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        parts = coded.dictionary.to_pylist()
        n = np.diff(offs)
        text = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(codes)) - offs[:-1][text]

        # an empty part is one more blank for the next one; at a text's end it stands alone
        empty = np.fromiter((not p for p in parts), bool, len(parts))[codes]
        last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
        unit = ~empty | last
        unit &= ~(empty & (n[text] == 1))  # the empty text has no pieces
        upto = np.cumsum(unit) - unit
        run = np.arange(len(codes)) - np.concatenate(([-1], np.flatnonzero(unit)))[upto] - 1
        first_of_text = offs[:-1][text]
        blanks = np.minimum(run, np.arange(len(codes)) - first_of_text) + 1
        code, blanks, text, place = codes[unit], blanks[unit], text[unit], place[unit]

        ids = np.array([(i or 0) & (1 << 63) - 1 for i in doc_ids], np.uint64)
        draw = mix(mix(ids[text] * _K[1] + self.seed) + place.astype(np.uint64))
        wide = int(blanks.max()) + 1 if len(blanks) else 1
        key, which = np.unique(code * wide + blanks, return_inverse=True)
        flat, first, count = self._pieces(*self._words(parts, key // wide, key % wide), which, draw)
        out = ragged(flat, first, count)
        return out, np.bincount(text, count, len(n)).astype(np.int64)

    def _pieces(self, syms, sizes, keys, which, draw):
        """Of every occurrence (its distinct word and its draw): where its pieces are, and their number."""
        model = self.model
        log: list = []
        plain, n_plain = segment(model, syms.copy(), sizes, keys, 0.0, log)
        first, count = (np.cumsum(n_plain) - n_plain)[which], n_plain[which]
        if self.dropout <= 0 or not len(which):
            return plain, first, count
        own_key = mix(keys[which] ^ draw)

        # occurrences that lose a candidate of the plain way
        word, left, right, found = (np.concatenate(x) for x in zip(*log))
        by = np.argsort(word, kind="stable")
        place, joined = _place_key(left[by], right[by]), model.joined[found[by]]
        n_met = np.bincount(word, minlength=len(sizes))
        from_met = np.cumsum(n_met) - n_met
        loses = np.zeros(len(which), bool)
        limit, all_met = _limit(self.dropout), np.arange(len(by))
        for a, b in steps(n_met[which]):
            w = which[a:b]
            at = ragged(all_met, from_met[w], n_met[w])
            owner = np.repeat(np.arange(a, b), n_met[w])
            loses[owner[_drawn(own_key[owner], place[at], joined[at]) < limit]] = True

        # these one by one, words of like length in step
        begin = np.flatnonzero(np.arange(len(syms)) + 1 < np.repeat(np.cumsum(sizes), sizes))
        found, exists = np.zeros(len(syms), np.int64), np.zeros(len(syms), bool)
        found[begin], exists[begin] = model.join(syms[begin], syms[begin + 1])
        from_sym, all_syms = np.cumsum(sizes) - sizes, np.arange(len(syms))
        todo = np.flatnonzero(loses)
        todo = todo[np.argsort(sizes[which[todo]], kind="stable")]
        out, done = [plain], len(plain)
        for a, b in steps(sizes[which[todo]]):
            mine = todo[a:b]
            w = which[mine]
            at = ragged(all_syms, from_sym[w], sizes[w])
            ids, n = segment(model, syms[at], sizes[w], own_key[mine], self.dropout, begin=(found[at], exists[at]))
            first[mine], count[mine] = done + np.cumsum(n) - n, n
            out.append(ids)
            done += len(ids)
        return np.concatenate(out), first, count

    def _words(self, parts, code, blanks):
        """First pieces, their number and keys of distinct words, given by part and number of blanks."""
        model = self.model
        joined = "".join(parts)
        cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        syms = model.char[cps]
        syms[cps == ord(MARK)] = -1
        # characters without a piece become byte pieces
        width = np.ones(len(cps), np.int64)
        lost = np.flatnonzero(syms < 0)
        if len(lost):
            utf = {c: chr(c).encode() for c in np.unique(cps[lost]).tolist()}
            width[lost] = [len(utf[c]) for c in cps[lost].tolist()]
            full = np.repeat(syms, width)
            full[full < 0] = model.byte[np.frombuffer(b"".join(utf[c] for c in cps[lost].tolist()), np.uint8)]
            syms = full
        upto = np.concatenate(([0], np.cumsum(width)))
        ends = np.cumsum(size)
        first, last = upto[ends - size], upto[ends]

        total = np.concatenate(([np.uint64(0)], np.cumsum(mix(cps.astype(np.uint64) + _K[2] * (np.arange(len(cps)) - np.repeat(ends - size, size)).astype(np.uint64)))))
        name = total[ends] - total[ends - size]
        keys = mix(mix(name[code] + self.seed) ^ (blanks.astype(np.uint64) * _K[3]))

        lengths = blanks + (last - first)[code]
        out = np.full(int(lengths.sum()), model.mark)
        starts = np.cumsum(lengths) - lengths
        inner = (last - first)[code]
        spot = np.repeat(starts + blanks - (np.cumsum(inner) - inner), inner) + np.arange(int(inner.sum()))
        out[spot] = ragged(syms, first[code], inner)
        return out, lengths, keys


def decode_ids(model: Model, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of flat piece ids."""
    size = model.raw_size[ids]
    raw = ragged(model.raw, model.raw_first[ids], size).tobytes()
    ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(counts)))].tolist()
    # the first byte is the blank before every text
    return [raw[a + 1 : b].decode() for a, b in zip(ends, ends[1:])]


def encode(docs: DataFrame, model: str | None = None, seed: int = 1, dropout: float = 0.1) -> DataFrame:
    """doc_id, ids: the pieces of every text."""
    path = model or default_model()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        encoder = Encoder(loaded(path), seed, dropout)
        for part in byte_slices(batches, limit=SLICE):
            ids = part.column("doc_id").cast(pa.int64())
            flat, counts = encoder(ids.to_pylist(), pc.fill_null(part.column("text"), ""))
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([ids, lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids, text."""
    path = model or default_model()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = loaded(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                lists = part.column("ids")
                offs = lists.offsets.to_numpy()
                texts = decode_ids(known, lists.flatten().to_numpy().astype(np.int64), np.diff(offs))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
