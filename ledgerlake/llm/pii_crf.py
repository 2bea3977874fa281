"""Operator 5: personal data by patterns and a linear-chain CRF.

Patterns give the base spans.  A conditional random field over word-shape
features adds spans the patterns miss (secrets such as keys and tokens, split
or oddly written numbers and addresses).  It is trained in numpy on a small
labelled table (``labelled_lines``: rule-made sentences, or any table of the
same form) by gradient ascent on the exact log-likelihood, and decoded by
Viterbi over batches of lines in numpy inside each task.

A line is decoded only if one of its words could leave the state "outside" at
all: a run of other states must hold a word whose best gain over "outside",
with the best transition bonus, is not negative.  All other lines decode to
"outside" throughout, so skipping them is exact.

Defined cases: NULL and empty texts have no spans; offsets count code points,
ends exclusive; a span of the CRF that overlaps a base span, or lies in it, is
not added; repeated rows give repeated results; NULL ids are carried through;
an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import byte_slices

KINDS = ["email", "ip", "card", "phone", "secret"]
BASE = KINDS[:4]
STATES = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# a run of digits fails or matches as a whole, so no start inside a run is tried
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; linear in the text's length."""
    out: list[tuple[str, int, int]] = []
    end, last, at = 0, 0, text.find("@")
    while at >= 0:
        head = text[max(end, last) : at]
        start = at - (len(head) - len(head.rstrip(_LOCAL)))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        last = at + 1
        at = text.find("@", max(last, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37:
            digits = _NON_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NON_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


# ---------------------------------------------------------------- features

_CORE = re.compile(r"[0-9A-Za-z+(À-￿](?:.*[0-9A-Za-z)À-￿])?", re.S)
_HEX = re.compile(r"[0-9a-fA-F]+")
_CUES = ("token", "key", "secret", "password", "pass", "api", "bearer", "phone", "tel", "call", "mail", "card", "ip")


def core(word: str) -> tuple[int, int]:
    """Start and end of a word without the punctuation around it."""
    m = _CORE.search(word)
    return m.span() if m else (0, len(word))


def shape_features(word: str) -> list[str]:
    """Features of a word's shape (not of the word itself, but for short cues)."""
    a, b = core(word)
    w = word[a:b]
    n_digits = sum(map(str.isdecimal, w))
    n_alpha = sum(map(str.isalpha, w))
    rest = len(w) - n_digits - n_alpha
    squeezed = re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", w[:64])))
    out = ["len=" + str(min(len(w).bit_length(), 7)), "bias"]
    if n_digits == 0 and "@" not in w:
        out.append("plain")
    else:
        out += ["shape=" + squeezed[:12], "digits=" + str(min(n_digits, 20) // 2)]
        if n_alpha and n_digits and rest == 0 and len(w) >= 16:
            out.append("mixed-long")
            if _HEX.fullmatch(w):
                out.append("hex-long")
        if "@" in w:
            out.append("at")
        if w.count(".") == 3 and not n_alpha:
            out.append("dots")
        if n_digits and not n_alpha:
            out.append("number" + ("-long" if n_digits >= 12 else "-mid" if n_digits >= 7 else ""))
        if w[:1] == "+":
            out.append("plus")
        if w[:1] == "(":
            out.append("paren")
    return out


def cue_features(word: str) -> list[str]:
    """What a word says about its neighbours."""
    w = word.strip("\"'.,;:!()").lower()
    if word in ("=", ":", ":="):
        return ["assign"]
    if w in _CUES:
        return ["cue=" + w]
    return ["number" if any(map(str.isdecimal, w)) else "plain"]


# ---------------------------------------------------------------- labelled table

_FILL = "The report was of in that with from reading garden window people under over again street".split()


def labelled_lines(seed: int = 7, per_template: int = 18) -> list[list[tuple[str, str]]]:
    """The small labelled table: sentences of (word, state), made from templates by rule."""
    import random

    rnd = random.Random(seed)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    plain = lambda: rnd.choice(_FILL) + rnd.choice(["", "", "", ",", "."])
    tail = lambda: rnd.choice(["", "", ".", ",", "###", "***", "&&&"])
    hexes = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.choice([24, 32, 40, 64])))
    keys = lambda: "".join(rnd.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmn0123456789") for _ in range(rnd.randint(24, 44))) + digits(1)

    def entity(kind: str) -> list[tuple[str, str]]:
        if kind == "email":
            words = [f"{rnd.choice(_FILL)}.{digits(2)}@mail{digits(1)}.example.com" + tail()]
        elif kind == "ip":
            words = [".".join(str(rnd.randint(1, 255)) for _ in range(4)) + tail()]
        elif kind == "card":
            words = [digits(16) + tail()] if rnd.random() < 0.7 else [digits(4) for _ in range(4)]
        elif kind == "phone":
            words = ["+" + digits(1), f"({digits(3)})", f"{digits(3)}-{digits(4)}" + tail()]
        else:
            value = f'"{rnd.choice([hexes, keys])()}"' + tail()
            cue = rnd.choice([["token", "="], ["api_key", "="], ["key", ":"], ["password", "="], []])
            return [(w, "O") for w in cue] + [(value, "B-secret")]
        return [(w, ("I-" if k else "B-") + kind) for k, w in enumerate(words)]

    def other() -> list[tuple[str, str]]:
        pick = rnd.randrange(6)
        if pick == 0:  # years, amounts, versions, ordinals: numbers that are nobody's
            return [(rnd.choice([digits(4), digits(2) + "%", "v" + digits(1) + "." + digits(1), digits(3), digits(5)]), "O")]
        if pick == 1:
            return [(rnd.choice(["token", "key", "password", "phone", "=", "|"]), "O"), (plain(), "O")]
        if pick == 2:
            return [(rnd.choice(_FILL).upper() + "!!", "O"), (rnd.choice(_FILL) + rnd.choice(["###", "$$$", "%%%"]), "O")]
        return [(plain(), "O") for _ in range(rnd.randint(1, 5))]

    lines = []
    for kind in [*KINDS, None]:
        for _ in range(per_template):
            line = other() + other()
            if kind:
                line += entity(kind) + other()
                if rnd.random() < 0.3:
                    line += entity(rnd.choice(KINDS)) + other()
            lines.append(line)
    return lines


# ---------------------------------------------------------------- model


class Crf:
    """States x features weights (own shape, cue before, cue after) and transitions."""

    def __init__(self, own, before, after, trans, start):
        self.own, self.before, self.after, self.trans, self.start = own, before, after, trans, start

    def word_scores(self, words: list[str]):
        """Emission scores of distinct words: own, as the word before, as the word after."""
        import numpy as np

        n = len(STATES)
        tables = [np.zeros((len(words), n)) for _ in range(3)]
        zero = np.zeros(n)
        known: dict[tuple, tuple] = {}  # few distinct feature lists, many words
        for k, word in enumerate(words):
            cue = tuple(cue_features(word))
            own = tuple(shape_features(word))
            if (own, cue) not in known:
                known[own, cue] = (
                    sum((self.own.get(f, zero) for f in own), zero),
                    sum((self.before.get(f, zero) for f in cue), zero),
                    sum((self.after.get(f, zero) for f in cue), zero),
                )
            for table, row in zip(tables, known[own, cue]):
                table[k] = row
        return tables

    def bonus(self) -> float:
        """The most a step can gain by its transitions over staying outside."""
        t = self.trans
        into = max(float((t[0, 1:] - t[0, 0]).max()), float((self.start[1:] - self.start[0]).max()))
        back = float((t[1:, 0] - t[0, 0]).max())
        inside = float((t[1:, 1:] - t[0, 0]).max())
        return max(0.0, into) + max(0.0, back) + max(0.0, inside)


def train(lines: list[list[tuple[str, str]]], rounds: int = 100, l2: float = 0.02) -> Crf:
    """Maximum likelihood with L2 by Adam; forward-backward over padded batches."""
    import numpy as np

    names: list[dict[str, int]] = [{}, {}, {}]
    coded = []
    for line in lines:
        cues = [cue_features(w) for w, _ in line]
        rows = []
        for k, (w, s) in enumerate(line):
            f = [shape_features(w), cues[k - 1] if k else ["edge"], cues[k + 1] if k + 1 < len(line) else ["edge"]]
            rows.append(([[names[j].setdefault(x, len(names[j])) for x in f[j]] for j in range(3)], STATES.index(s)))
        coded.append(rows)
    n, longest, count = len(STATES), max(map(len, coded)), len(coded)
    feats = [np.zeros((count, longest, len(names[j]))) for j in range(3)]
    gold = np.zeros((count, longest), int)
    mask = np.zeros((count, longest))
    for i, rows in enumerate(coded):
        for k, (ids, s) in enumerate(rows):
            for j in range(3):
                feats[j][i, k, ids[j]] = 1
            gold[i, k], mask[i, k] = s, 1
    x = np.concatenate(feats, axis=2).reshape(count * longest, -1)
    params = [np.zeros((x.shape[1], n)), np.zeros((n, n)), np.zeros(n)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    hot = np.eye(n)[gold] * mask[..., None]
    pair_mask = mask[:, 1:]
    gold_trans = np.einsum("bti,btj->ij", hot[:, :-1] * pair_mask[..., None], hot[:, 1:])

    def lse(a, axis):
        m = a.max(axis=axis, keepdims=True)
        return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, rounds + 1):
        w, t, s0 = params
        e = (x @ w).reshape(count, longest, n)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = s0 + e[:, 0]
        for k in range(1, longest):
            nxt = lse(alpha[:, k - 1, :, None] + t, 1) + e[:, k]
            alpha[:, k] = np.where(mask[:, k, None] > 0, nxt, alpha[:, k - 1])
        for k in range(longest - 2, -1, -1):
            prv = lse(t[None] + (e[:, k + 1] + beta[:, k + 1])[:, None, :], 2)
            beta[:, k] = np.where(mask[:, k + 1, None] > 0, prv, beta[:, k + 1])
        z = lse(alpha[:, -1], 1)
        post = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
        pair = np.exp(
            alpha[:, :-1, :, None] + t + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
        ) * pair_mask[..., None, None]
        grads = [
            x.T @ (hot - post).reshape(-1, n) / count - l2 * w,
            (gold_trans - pair.sum(axis=(0, 1))) / count - l2 * t,
            (hot[:, 0] - post[:, 0]).sum(axis=0) / count - l2 * s0,
        ]
        for j, g in enumerate(grads):
            first[j] = 0.9 * first[j] + 0.1 * g
            second[j] = 0.99 * second[j] + 0.01 * g * g
            params[j] += 0.2 * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.99**step)) + 1e-8)
    w, t, s0 = params
    cut = np.cumsum([0] + [len(d) for d in names])
    # a continuation of a kind can only follow that kind
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        for j in range(n):
            if j not in (inside - 1, inside):
                t[j, inside] = -1e4
        s0[inside] = -1e4
    tables = [{f: w[cut[j] + i] for f, i in names[j].items()} for j in range(3)]
    return Crf(*tables, t, s0)


def viterbi(emissions, lengths, trans, start):
    """Best states of a batch: ``emissions`` (lines, longest, states), right-padded."""
    import numpy as np

    count, longest, n = emissions.shape
    score = start + emissions[:, 0]
    back = np.zeros((count, longest, n), np.int8)
    for k in range(1, longest):
        cand = score[:, :, None] + trans
        best = cand.argmax(axis=1)
        live = (lengths > k)[:, None]
        back[:, k] = np.where(live, best, np.arange(n))
        score = np.where(live, np.take_along_axis(cand, best[:, None], 1)[:, 0] + emissions[:, k], score)
    states = np.zeros((count, longest), np.int8)
    states[:, -1] = score.argmax(axis=1)
    rows = np.arange(count)
    for k in range(longest - 1, 0, -1):
        states[:, k - 1] = back[rows, k, states[:, k]]
    return states


class LineTagger:
    """Decodes the lines of a batch of texts; word scores are kept per distinct word."""

    def __init__(self, crf: Crf):
        import numpy as np

        self.crf, self.bonus = crf, crf.bonus()
        edge = np.zeros(len(STATES))
        self.edge_before, self.edge_after = crf.before.get("edge", edge), crf.after.get("edge", edge)
        own, before, after = crf.word_scores(["plain"])
        # the best neighbours and edges can do for a word, state by state
        sides = []
        for table in (crf.before, crf.after):
            rows = np.array(list(table.values()))
            sides.append((rows[:, 1:] - rows[:, :1]).max(axis=0))
        self.side_gain = sides[0] + sides[1]
        self.active: dict[tuple, bool] = {}

    def may_leave(self, word: str) -> bool:
        """Whether the word could be part of a span at all, whatever its neighbours."""
        key = tuple(shape_features(word))
        if key not in self.active:
            own = self.crf.word_scores([word])[0][0]
            self.active[key] = bool(((own[1:] - own[0]) + self.side_gain).max() + self.bonus >= 0)
        return self.active[key]

    def __call__(self, lines: list[list[str]]):
        """States of each line's words."""
        import numpy as np

        crf, out = self.crf, [None] * len(lines)
        words = sorted({w for line in lines for w in line})
        at = {w: k for k, w in enumerate(words)}
        own, before, after = crf.word_scores(words)
        order = sorted(range(len(lines)), key=lambda k: len(lines[k]))
        i = 0
        while i < len(order):
            # batches of similar lengths, bounded by cells
            j = i
            while j < len(order) and (j - i + 1) * len(lines[order[j]]) <= 200_000:
                j += 1
            j = max(j, i + 1)
            group = order[i:j]
            lengths = np.array([len(lines[k]) for k in group])
            longest = int(lengths.max())
            codes = np.zeros((len(group), longest), np.int64)
            for r, k in enumerate(group):
                codes[r, : lengths[r]] = [at[w] for w in lines[k]]
            e = own[codes]
            e[:, 1:] += before[codes[:, :-1]]
            e[:, 0] += self.edge_before
            e[:, :-1] += after[codes[:, 1:]]
            rows = np.arange(len(group))
            if longest > 1:
                short = lengths < longest  # the last word of a padded line has no word after it
                e[rows[short], lengths[short] - 1] -= after[codes[rows[short], lengths[short]]]
            e[rows, lengths - 1] += self.edge_after
            states = viterbi(e, lengths, crf.trans, crf.start)
            for r, k in enumerate(group):
                out[k] = states[r, : lengths[r]]
            i = j
        return out


def spans_of(words: list[tuple[int, int]], text: str, states) -> list[tuple[str, int, int]]:
    """Runs of one kind as (kind, start, end), without the punctuation around them."""
    out, k, n = [], 0, len(words)
    states = [int(s) for s in states]
    while k < n:
        s = states[k]
        if s == 0:
            k += 1
            continue
        kind = (s - 1) // 2
        j = k + 1
        while j < n and states[j] == 2 + 2 * kind:
            j += 1
        a = words[k][0] + core(text[words[k][0] : words[k][1]])[0]
        b = words[j - 1][0] + core(text[words[j - 1][0] : words[j - 1][1]])[1]
        if a < b and plausible(KINDS[kind], text[a:b]):
            out.append((KINDS[kind], a, b))
        k = j
    return out


def plausible(kind: str, span: str) -> bool:
    """Checks that shapes cannot make: check digits, lengths, ranges."""
    digits = _NON_DIGIT.sub("", span)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        return all(p.isdecimal() and int(p[-4:]) <= 255 for p in span.split("."))
    if kind == "email":
        return "@" in span.strip("@")
    return len(span) >= 16


_SUSPECT = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")


def find_all(texts: list[str], tagger: LineTagger) -> list[tuple[list, list]]:
    """(base spans, all spans) of every text."""
    out, lines, where = [], [], []
    plain_leaves = tagger.may_leave("plain") or tagger.may_leave("Plain,") or tagger.may_leave("x" * 200)
    for i, text in enumerate(texts):
        out.append((base_spans(text), []))
        at = 0
        for line in text.split("\n"):
            # only words with a digit or "@" differ from the plain shape
            if plain_leaves or any(tagger.may_leave(w) for w in dict.fromkeys(_SUSPECT.findall(line))):
                words = [(m.start() + at, m.end() + at) for m in _WORD.finditer(line)]
                if words:
                    lines.append([text[a:b] for a, b in words])
                    where.append((i, words))
            at += len(line) + 1
    for (i, words), states in zip(where, tagger(lines)):
        out[i][1].extend(spans_of(words, texts[i], states))
    result = []
    for base, more in out:
        spans = list(base)
        taken = sorted((a, b) for _, a, b in base)
        for kind, a, b in more:
            if not any(a < y and x < b for x, y in taken):
                spans.append((kind, a, b))
        spans.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
        result.append((base, spans))
    return result


def as_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, lines: list[list[tuple[str, str]]] | None = None) -> DataFrame:
    """doc_id, counts of base kinds and of secrets, base_spans, spans (``kind:start:end``)."""
    crf = train(lines or labelled_lines())
    schema = (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, "
        "base_sha256 string, spans string"
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tagger = LineTagger(crf)
        for part in byte_slices(batches):
            found = find_all([t or "" for t in part.column("text").to_pylist()], tagger)
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in BASE]
            arrays = [part.column("doc_id").cast(pa.int64())] + [pa.array(c, pa.int64()) for c in counts]
            arrays.append(pa.array([len(a) - len(b) for b, a in found], pa.int64()))
            arrays.append(pa.array([hashlib.sha256(as_text(b).encode()).hexdigest() for b, _ in found]))
            arrays.append(pa.array([as_text(a) for _, a in found]))
            names = ["doc_id", *(f"n_{k}" for k in BASE), "n_added", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Every span replaced by its kind in brackets; overlapping spans as one."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans in ``text`` replaced; other columns and NULL texts stay."""
    crf = train(labelled_lines())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tagger = LineTagger(crf)
        for part in byte_slices(batches):
            k = part.schema.get_field_index("text")
            texts = part.column(k).to_pylist()
            found = find_all([t or "" for t in texts], tagger)
            new = [t if t is None else redact_text(t, spans) for t, (_, spans) in zip(texts, found)]
            yield part.set_column(k, part.schema.field(k), pa.array(new, part.schema.field(k).type))

    return docs.mapInArrow(run, docs.schema)
