"""Operator 10: licence notices in documents, by patience alignment of words.

Words are runs of letters and digits, lower-case.  A text and a template are
aligned as in patience diff: equal ends, then the words that are unique to both
as anchors, of those the longest run that rises on both sides, then the gaps
between the anchors in the same way; a small gap without anchors takes a
longest common subsequence.  Coverage is the share of the template's words that
are aligned within a stretch of text of at most ``spread`` times its length.

A text that repeats a notice has no unique words for it; then the
neighbourhoods of the occurrences of the template's rarest word are aligned
one by one, so every repetition is found.  A text without enough of a
template's words, each counted as often as in the template, cannot reach the
coverage and is not aligned; that bound is exact.

Defined cases: NULL and empty texts have no notice; of equal coverage the
earliest stretch counts; repeated rows give repeated results; NULL ids are
carried through; an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import byte_slices
from .line_dedup import patience

# Wordings of public licence notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions"
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

_WORD = re.compile(r"[^\W_]+")
#: Cells of a gap without anchors that still gets a common subsequence.
SMALL_GAP = 10_000


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _common(a: list, b: list, i: int, m: int, j: int, n: int) -> list[tuple[int, int]]:
    """A longest common subsequence of a[i:m] and b[j:n]."""
    best = [[0] * (n - j + 1) for _ in range(m - i + 1)]
    for p in range(m - i - 1, -1, -1):
        for q in range(n - j - 1, -1, -1):
            same = a[i + p] == b[j + q]
            best[p][q] = best[p + 1][q + 1] + 1 if same else max(best[p + 1][q], best[p][q + 1])
    out, p, q = [], 0, 0
    while p < m - i and q < n - j:
        if a[i + p] == b[j + q]:
            out.append((i + p, j + q))
            p, q = p + 1, q + 1
        elif best[p + 1][q] >= best[p][q + 1]:
            p += 1
        else:
            q += 1
    return out


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned positions: patience, then common subsequences in the small gaps left."""
    pairs = patience(text, template)
    out = list(pairs)
    edges = [(-1, -1), *pairs, (len(text), len(template))]
    for (p, q), (r, s) in zip(edges, edges[1:]):
        inner = p >= 0 and r < len(text)  # open ends of a long text say nothing
        if inner and r - p > 1 and s - q > 1 and (r - p) * (s - q) <= SMALL_GAP:
            out += _common(text, template, p + 1, r, q + 1, s)
    return sorted(out)


def best_stretch(pairs: list[tuple[int, int]], places: list[int], width: int) -> tuple[int, int, int]:
    """Most aligned words within ``width`` text words: (count, first place, last place)."""
    best, a = (0, 0, 0), 0
    for b in range(len(pairs)):
        while places[pairs[b][0]] - places[pairs[a][0]] >= width:
            a += 1
        if b - a + 1 > best[0]:
            best = (b - a + 1, places[pairs[a][0]], places[pairs[b][0]])
    return best


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float, spread: float):
        self.words = {name: words_of(text) for name, text in templates.items()}
        self.counts = {name: Counter(words) for name, words in self.words.items()}
        self.known = {w for words in self.words.values() for w in words}
        self.coverage, self.spread = coverage, spread

    def __call__(self, text: str) -> list[tuple[str, int, int, int, int, int]]:
        """(name, aligned, template words, first word, last word, times found)."""
        hits = [(w, k) for k, w in enumerate(words_of(text)) if w in self.known]
        have = Counter(w for w, _ in hits)
        out = []
        for name, template in self.words.items():
            want, need = self.counts[name], self.coverage * len(template)
            if sum(min(n, have[w]) for w, n in want.items()) < need:
                continue
            mine = [(w, k) for w, k in hits if w in want]
            width = max(1, int(self.spread * len(template)))
            found = [self._one(mine, template, width)]
            if found[0][0] < need or min(have[w] // n for w, n in want.items() if have[w]) > 1:
                found = self._around_rarest(mine, template, want, have, width) or found
            found = [f for f in found if f[0] >= need]
            if found:
                count, first, last = max(found, key=lambda f: (f[0], -f[1]))
                out.append((name, count, len(template), first, last, len(found)))
        return out

    def _one(self, mine, template, width):
        places = [k for _, k in mine]
        return best_stretch(align([w for w, _ in mine], template), places, width)

    def _around_rarest(self, mine, template, want, have, width):
        rarest = min((w for w in want if have[w]), key=lambda w: (have[w] / want[w], -len(w), w))
        at = [k for k, (w, _) in enumerate(mine) if w == rarest]
        found, start = [], 0
        for k, i in enumerate(at):
            # up to the next occurrence on both sides, and not farther than the width
            stop = at[k + 1] if k + 1 < len(at) else len(mine)
            part = [x for x in mine[start:stop] if abs(x[1] - mine[i][1]) < width]
            found.append(self._one(part, template, width))
            start = i + 1
        return found


def scan(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = 0.8, spread: float = 1.5
) -> DataFrame:
    """One row per document and licence found."""
    schema = (
        "doc_id long, license string, matched_words long, template_words long, coverage double, "
        "first_word long, last_word long, times long"
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner = Scanner(templates, coverage, spread)
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        for part in byte_slices(batches):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                for name, n, size, first, last, times in scanner(text or ""):
                    rows.append((doc_id, name, n, size, n / size, first, last, times))
            cols = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], [f.split(" ")[0] for f in schema.split(", ")]
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
