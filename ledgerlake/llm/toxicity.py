"""Operator 7: toxicity by a bidirectional GRU with attention pooling.

A step's input is a word: an embedding of the word (hashed to buckets) next to
the mean embedding of its character trigrams.  Two GRUs read a window of words
from both ends, attention pools their states, a logistic unit scores the
window.  A document's score is that of its most toxic window; windows overlap,
so they cover every word of the whole text, phrases across borders included.

The model is trained in numpy, in one task, from at most ``max_train`` labelled
documents of the training folds (the rows of smallest hash of their id, so the
choice does not depend on order or partitions): multiple-instance learning,
each document teaches by the window that scores highest.  Embeddings start
from smoothed log-odds of the training documents and are trained with the rest.
Scoring runs in Arrow batches inside the tasks.

Defined cases: NULL and empty texts are one empty window and get its score;
with no labelled row, or labels of one kind only, every score is the mean label
(0 without labels); labels that are NULL are ignored, and of several labels of
one id the largest counts; rows with a NULL id are scored and belong to no
held-out fold; repeated rows are scored alike.  Labels, lang, source and
doc_id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices


@dataclass(frozen=True)
class Settings:
    window: int = 48
    stride: int = 36
    hidden: int = 8
    embed: int = 6
    word_buckets: int = 1 << 14
    char_buckets: int = 1 << 15
    max_train: int = 5000
    epochs: int = 10
    min_steps: int = 250
    batch: int = 256
    rate: float = 0.02
    decay: float = 1e-4
    threshold: float = 0.7
    seed: int = 11


# ---------------------------------------------------------------- words and windows


def words_of(texts):
    """Lower-case words of an Arrow string array: codes, offsets per text, distinct words."""
    import pyarrow as pa
    import pyarrow.compute as pc

    plain = pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.large_string())), r"[^\pL\pN]+", " ")
    lists = pc.split_pattern(pc.utf8_trim(plain, " "), " ")
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0], coded.dictionary


class WordTable:
    """Word bucket and character trigram buckets of distinct words."""

    def __init__(self, dictionary, s: Settings):
        _, offsets, data = dictionary.buffers()
        n = len(dictionary)
        offs = np.frombuffer(offsets, np.int64, n + 1, dictionary.offset * 8)
        raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
        offs = offs - offs[0]
        size = np.diff(offs)
        self.starts, self.size, self.n = offs[:-1], size, n
        # one trigram around every byte; borders are marked by bytes no text holds
        b = raw.astype(np.uint64)
        before, after = np.full(len(b), 0xFE, np.uint64), np.full(len(b), 0xFF, np.uint64)
        if len(b):
            before[1:], after[:-1] = b[:-1], b[1:]
            before[offs[:-1][size > 0]] = 0xFE
            after[offs[1:][size > 0] - 1] = 0xFF
        mixed = ((before << np.uint64(16)) | (b << np.uint64(8)) | after) * np.uint64(0x9E3779B97F4A7C15)
        self.tri = ((mixed >> np.uint64(40)) % np.uint64(s.char_buckets)).astype(np.int64)
        place = np.arange(len(b), dtype=np.uint64) - np.repeat(self.starts, size).astype(np.uint64)
        with np.errstate(over="ignore"):
            spread = (mixed ^ (mixed >> np.uint64(29))) * (place * np.uint64(2) + np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread)))
        h = total[offs[1:]] - total[offs[:-1]]
        self.word = ((h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) >> np.uint64(33)).astype(np.int64) % s.word_buckets

    def trigrams(self, used: np.ndarray):
        """Trigram buckets of some words, and whose they are (position in ``used``)."""
        n = self.size[used]
        places = np.repeat(self.starts[used] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.tri[places], np.repeat(np.arange(len(used)), n)

    def inputs(self, p: dict, used: np.ndarray | None = None) -> np.ndarray:
        """One input vector per distinct word (or per word of ``used``); zero for the empty word."""
        used = np.arange(self.n) if used is None else used
        tri, owner = self.trigrams(used)
        n = np.maximum(self.size[used], 1)
        mean = np.stack([np.bincount(owner, col, len(used)) / n for col in p["char"].T[:, tri]], 1)
        x = np.concatenate((p["word"][self.word[used]], mean.astype(p["word"].dtype)), axis=1)
        x[self.size[used] == 0] = 0
        return x


def windows(offsets: np.ndarray, s: Settings):
    """Start, length and text number of all windows; every word is in one at least."""
    n = np.diff(offsets)
    count = np.maximum(0, -((n - s.window) // -s.stride)) + 1
    text = np.repeat(np.arange(len(n)), count)
    first = np.cumsum(count) - count
    start = offsets[:-1][text] + (np.arange(len(text)) - first[text]) * s.stride
    return start, np.minimum(s.window, offsets[1:][text] - start), text


# ---------------------------------------------------------------- network


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def gru(g, mask, u, keep: bool):
    """States (steps, batch, hidden) for the inputs' share ``g`` (steps, batch, 3 * hidden)."""
    steps, batch, wide = g.shape
    hid = wide // 3
    h = np.zeros((batch, hid), np.float32)
    out = np.empty((steps, batch, hid), np.float32)
    trail = []
    for t in range(steps):
        both = h @ u
        zr = _sigmoid(g[t, :, : 2 * hid] + both[:, : 2 * hid])
        z, r = zr[:, :hid], zr[:, hid:]
        n = np.tanh(g[t, :, 2 * hid :] + r * both[:, 2 * hid :])
        new = n + z * (h - n)
        if keep:
            trail.append((h, z, r, n, both[:, 2 * hid :]))
        h = h + mask[t] * (new - h)
        out[t] = h
    return out, trail


def gru_back(d_out, mask, u, trail):
    """Gradients of the inputs' share and of ``u``."""
    steps, batch, hid = d_out.shape
    d_g, d_u = np.empty((steps, batch, 3 * hid), np.float32), np.zeros_like(u)
    carry = np.zeros((batch, hid), np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, n, un = trail[t]
        carry = carry + d_out[t]
        d_new = mask[t] * carry
        d_n = d_new * (1 - z) * (1 - n * n)
        d_z = d_new * (h - n) * z * (1 - z)
        d_r = d_n * un * r * (1 - r)
        d_both = np.concatenate((d_z, d_r, d_n * r), axis=1)
        d_g[t] = np.concatenate((d_z, d_r, d_n), axis=1)
        d_u += h.T @ d_both
        carry = carry - d_new + d_new * z + d_both @ u.T
    return d_g, d_u


def pool(states, mask, p):
    """Attention over the steps, then the logit; also what the backward pass needs."""
    act = np.tanh(states @ p["att"])
    e = act @ p["ask"] + (mask[..., 0] - 1) * 1e4
    e = np.exp(e - e.max(axis=0))
    a = e / e.sum(axis=0)
    ctx = np.einsum("tb,tbh->bh", a, states)
    return ctx @ p["out"] + p["bias"][0], (act, a, ctx)


def scatter_sum(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of ``values`` by their place in a table of ``size`` rows."""
    out = np.zeros((size, values.shape[1]), values.dtype)
    if len(at):
        order = np.argsort(at, kind="stable")
        at = at[order]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        out[at[cuts]] = np.add.reduceat(values[order], cuts, axis=0)
    return out


def _gather(start, length, codes, steps):
    at = start[None, :] + np.minimum(np.arange(steps)[:, None], np.maximum(length - 1, 0)[None, :])
    mask = (np.arange(steps)[:, None] < length[None, :]).astype(np.float32)[..., None]
    return codes[at], mask


def window_logits(p, x, codes, start, length, s: Settings, chunk: int = 2048) -> np.ndarray:
    """Logits of all windows; ``x`` holds the distinct words' inputs."""
    fore, back = x @ p["w_f"] + p["b_f"], x @ p["w_b"] + p["b_b"]
    out = np.empty(len(start), np.float32)
    for i in range(0, len(start), chunk):
        c, mask = _gather(start[i : i + chunk], length[i : i + chunk], codes, s.window)
        hf, _ = gru(fore[c], mask, p["u_f"], False)
        hb, _ = gru(back[c[::-1]], mask[::-1], p["u_b"], False)
        out[i : i + chunk] = pool(np.concatenate((hf, hb[::-1]), axis=2), mask, p)[0]
    return out


def gradients(p, table: WordTable, codes, start, length, y, s: Settings) -> tuple[dict, float]:
    """Gradients of the mean logistic loss of some windows, and the loss."""
    c, mask = _gather(start, length, codes, s.window)
    used, c = np.unique(c, return_inverse=True)
    c = c.reshape(mask.shape[:2])
    xu = table.inputs(p, used)
    hf, tf = gru((xu @ p["w_f"] + p["b_f"])[c], mask, p["u_f"], True)
    hb, tb = gru((xu @ p["w_b"] + p["b_b"])[c[::-1]], mask[::-1], p["u_b"], True)
    states = np.concatenate((hf, hb[::-1]), axis=2)
    logit, (act, a, ctx) = pool(states, mask, p)
    prob = _sigmoid(logit)
    loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
    d = ((prob - y) / len(y)).astype(np.float32)
    g = {"out": ctx.T @ d, "bias": np.array([d.sum()], np.float32)}
    d_ctx = d[:, None] * p["out"]
    d_a = np.einsum("bh,tbh->tb", d_ctx, states)
    d_e = a * (d_a - (a * d_a).sum(axis=0))
    d_act = d_e[..., None] * p["ask"] * (1 - act * act)
    g["ask"] = np.einsum("tb,tbk->k", d_e, act)
    flat = states.reshape(-1, states.shape[2])
    g["att"] = flat.T @ d_act.reshape(-1, d_act.shape[2])
    d_states = a[..., None] * d_ctx + d_act @ p["att"].T
    hid = p["u_f"].shape[0]
    d_x = np.zeros_like(xu)
    for name, d_out, m, trail, at in (
        ("f", d_states[..., :hid], mask, tf, c),
        ("b", d_states[::-1, :, hid:], mask[::-1], tb, c[::-1]),
    ):
        d_g, g[f"u_{name}"] = gru_back(d_out, m, p[f"u_{name}"], trail)
        per = scatter_sum(at.ravel(), d_g.reshape(-1, d_g.shape[2]), len(used))
        g[f"w_{name}"], g[f"b_{name}"] = xu.T @ per, per.sum(axis=0)
        d_x += per @ p[f"w_{name}"].T
    d_x[table.size[used] == 0] = 0
    k = p["word"].shape[1]
    g["word"] = scatter_sum(table.word[used], d_x[:, :k], len(p["word"]))
    tri, owner = table.trigrams(used)
    g["char"] = scatter_sum(tri, (d_x[:, k:] / np.maximum(table.size[used], 1)[:, None])[owner], len(p["char"]))
    return g, loss


def _log_odds(pos, all_, prior: float):
    """Smoothed log-odds of label 1 for documents that hold a bucket."""
    rate = (pos + 2 * prior) / (all_ + 2)
    return np.log(rate / (1 - rate)) - np.log(prior / (1 - prior))


def _document_counts(table: WordTable, codes, offsets, y, s: Settings):
    """Per word and trigram bucket, the documents of label 1 and all that hold it."""
    out = np.zeros((2, s.word_buckets)), np.zeros((2, s.char_buckets))
    for k, label in enumerate(y):
        words = np.unique(codes[offsets[k] : offsets[k + 1]])
        for count, buckets in zip(out, (table.word[words], table.trigrams(words)[0])):
            seen = np.unique(buckets)
            count[0, seen] += label
            count[1, seen] += 1
    return out


def initial(table: WordTable, codes, offsets, y, s: Settings) -> dict:
    rng = np.random.default_rng(s.seed)
    f = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
    h, d = s.hidden, s.embed
    p = {"word": f(s.word_buckets, d, scale=0.1), "char": f(s.char_buckets, d, scale=0.1)}
    for name, (pos, all_) in zip(("word", "char"), _document_counts(table, codes, offsets, y, s)):
        p[name][:, 0] = _log_odds(pos, all_, float(y.mean()))
    for k in "fb":
        p[f"w_{k}"], p[f"u_{k}"] = f(2 * d, 3 * h, scale=0.3), f(h, 3 * h, scale=0.3)
        p[f"b_{k}"] = np.zeros(3 * h, np.float32)
    p["att"], p["ask"] = f(2 * h, h, scale=0.3), f(h, scale=0.3)
    p["out"], p["bias"] = f(2 * h, scale=0.3), np.array([np.log(y.mean() / (1 - y.mean()))], np.float32)
    return p


def train(texts: list[str], labels: list[int], s: Settings = Settings()) -> dict | None:
    """Parameters, or None where there is nothing to learn."""
    import pyarrow as pa

    once = dict(zip(texts, labels))  # a text given twice teaches once
    y = np.array(list(once.values()), np.float32)
    if len(y) == 0 or y.min() == y.max():
        return None
    codes, offsets, dictionary = words_of(pa.array(list(once), pa.string()))
    table = WordTable(dictionary, s)
    p = initial(table, codes, offsets, y, s)
    start, length, text = windows(offsets, s)
    first, second = [{k: np.zeros_like(v) for k, v in p.items()} for _ in range(2)]
    rng, step = np.random.default_rng(s.seed + 1), 0
    # few documents are gone over more often
    epochs = max(s.epochs, min(4 * s.epochs, -(-s.min_steps * s.batch // len(y))))
    for epoch in range(epochs):
        if epoch % 3 == 0:
            # the window that scores highest speaks for its document; at first, the one
            # with the most telling word
            if epoch:
                score = window_logits(p, table.inputs(p), codes, start, length, s)
            else:
                odds = np.concatenate((p["word"][table.word, 0][codes], [0.0]))
                score = np.maximum.reduceat(odds, np.stack((start, start + length), 1).ravel())[::2]
            order = np.lexsort((score, text))
            best = order[np.append(text[order][1:] != text[order][:-1], True)]
        some = np.concatenate((best, rng.choice(np.flatnonzero(y[text] == 0), len(best) // 2)))
        some = rng.permutation(some)
        rate = s.rate * (1 - epoch / epochs)
        for i in range(0, len(some), s.batch):
            k = some[i : i + s.batch]
            step += 1
            g, _ = gradients(p, table, codes, start[k], length[k], y[text[k]], s)
            for name, grad in g.items():
                m, v = first[name], second[name]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                p[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6) + rate * s.decay * p[name]
    return p


def score_texts(p: dict, texts, s: Settings = Settings()) -> np.ndarray:
    """Scores of an Arrow string array without NULLs."""
    codes, offsets, dictionary = words_of(texts)
    start, length, text = windows(offsets, s)
    logits = window_logits(p, WordTable(dictionary, s).inputs(p), codes, start, length, s)
    top = np.full(len(texts), -np.inf, np.float64)
    np.maximum.at(top, text, logits)
    return 1.0 / (1.0 + np.exp(-top))


# ---------------------------------------------------------------- tables


def is_held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> tuple[dict | None, float]:
    """Model and mean label from at most ``s.max_train`` labelled training rows."""
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(s.max_train)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic")

    def learn(batches: Iterator) -> Iterator:
        import io

        import pyarrow as pa

        rows = [r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(3)))]
        rows.sort(key=lambda r: (r[0], r[1] or ""))
        y = [int(r[2]) for r in rows]
        model = train([r[1] or "" for r in rows], y, s)
        raw = io.BytesIO()
        if model is not None:
            np.savez(raw, **model)
        mean = float(np.mean(y)) if y else 0.0
        yield pa.RecordBatch.from_arrays([pa.array([raw.getvalue()], pa.binary()), pa.array([mean])], ["model", "mean"])

    # a bounded sample: one task learns, so the driver holds the parameters only
    row = sample.repartition(1).mapInArrow(learn, "model binary, mean double").first()
    if row is None or not row["model"]:
        return None, row["mean"] if row else 0.0
    import io

    with np.load(io.BytesIO(bytes(row["model"]))) as saved:
        return {k: saved[k] for k in saved.files}, row["mean"]


def score(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model, mean = fit(docs, labels, s)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for part in byte_slices(batches, limit=4 << 20):
            texts = pc.fill_null(part.column("text"), "")
            p = shared.value
            scores = np.full(len(texts), mean) if p is None else score_texts(p, texts, s)
            ids = part.column("doc_id").cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(scores, pa.float64())], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return out.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= s.threshold).cast("int").alias("predicted"),
    )
