"""Licence scans: a trained classifier of paragraphs and windows, confirmed against templates.

A paragraph is a run of lines up to one that is blank once comment marks are removed. Pieces of a
text are scored: every line and every paragraph of at most ``WINDOWS[-1]`` words, and of longer ones
windows of each size of ``WINDOWS`` that overlap by three quarters and cover all words, so that a
notice is seen whole in a piece a few times its length at most, wherever it is wrapped.

A piece is scored by a softmax regression on its word one- and two-grams over
licence families and the class "unknown". Only n-grams of the templates carry weight, so the
model is small and a piece's other words cost one lookup each. Training rows come from
the templates (whole, cut, with words dropped and with ordinary words around) and, for the
unknown class, from paragraphs of a bounded sample of documents that no template resembles,
mixed with shuffled template words. A temperature and an offset of the unknown class are
fitted on rows held back, so that the stated probability is one. A predicted family is
confirmed if enough of a template's two-grams stand in the piece. Of predicted pieces that
overlap the best one stays.

Texts are scored in one scan, row by row, without a shuffle.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from vecspark.llm.common import blocks

# Short notices as the licences' stewards word them, by family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License", "This project is licensed under the terms of the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "GPL-2.0": (
        "Licensed under the GNU General Public License, version 2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 "
        "of the License, or (at your option) any later version",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Use of this source code is governed by a BSD-style license", "Licensed under the BSD 3-Clause License",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted", "Licensed under the ISC License",
    ),
    "CC-BY": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC0": ("Released under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
    "Proprietary": ("All rights reserved. No part of this work may be reproduced without permission of the publisher",),
}
UNKNOWN = "unknown"
#: Documents whose paragraphs stand for the unknown class.
SAMPLE = 1000
#: Paragraphs of them that are learned from, and the characters of each.
PARAGRAPHS, LONGEST = 4000, 2000
LEAST_LIKENESS = 0.7
#: Words of a window, by size; one starts at each quarter of the size.
WINDOWS = (8, 16, 32, 64)
#: Words of pieces that are scored at a time.
BLOCK = 1 << 18
_WORD = re.compile(r"[a-z0-9]+(?:[.'][a-z0-9]+)*")
#: What stands around a line of a comment.
_MARKS = " \t\r\f\v/*#;!%<>-\"'"


def lowered(text: str) -> str:
    """In lower case, with as many code points (only this one letter would become two)."""
    return text.replace("\u0130", "i").lower()


def words(text: str) -> list[str]:
    return _WORD.findall(lowered(text))


def pieces(lines: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in words, of all pieces of a text; ``lines`` has the words up to each line's
    start and the text's end, ``blank`` says which lines part paragraphs."""
    edge = np.flatnonzero(np.concatenate(([True], blank[1:] | blank[:-1], [True]))) if len(blank) else np.zeros(1, np.int64)
    runs = lines[edge]
    starts, ends = np.concatenate((lines[:-1], runs[:-1])), np.concatenate((lines[1:], runs[1:]))
    of_paragraph = np.arange(len(starts)) >= len(lines) - 1
    sizes = ends - starts
    whole = (sizes > 0) & (sizes <= WINDOWS[-1])
    found = [(starts[whole], ends[whole])]
    for size in WINDOWS:
        long = of_paragraph & (sizes > size)
        times = -(-(sizes[long] - size) // (size // 4)) + 1
        number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        last = np.repeat(ends[long], times)
        at = np.minimum(np.repeat(starts[long], times) + number * (size // 4), last - size)
        found.append((at, at + size))
    starts, ends = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    both = np.unique((starts << 32) | ends)
    return both >> 32, both & ((1 << 32) - 1)


def likeness(own: list[str], template: list[str]) -> float:
    """Share of the template's two-grams (its word, if one) that stand in ``own``."""
    if len(template) == 1:
        return float(template[0] in own)
    want = set(zip(template, template[1:]))
    return len(want & set(zip(own, own[1:]))) / len(want)


@dataclass
class LicenceModel:
    classes: list[str]
    slots: dict
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    unknown_offset: float
    _made: tuple | None = None

    def features(self, own: list[str]) -> tuple[list[int], float]:
        """Slots of the known n-grams that occur, and the value of each."""
        slots = self.slots
        found = {slots[w] for w in own if w in slots}
        if found:
            found.update(slots[p] for p in zip(own, own[1:]) if p in slots)
        return sorted(found), 1 / np.sqrt(max(1, len(own)))

    def probabilities(self, own: list[str]) -> np.ndarray:
        found, value = self.features(own)
        z = self.bias + self.weights[found].sum(axis=0) * value
        z = z / self.temperature
        z[0] += self.unknown_offset
        e = np.exp(z - z.max())
        return e / e.sum()

    def _tables(self) -> tuple[np.ndarray, np.ndarray, list, list]:
        """Sorted codes of the two-grams (slots of both words), the slot of each, and for each class
        its templates' numbers and for each template its two-grams' slots."""
        pairs = sorted((self.slots[g[0]] * len(self.slots) + self.slots[g[1]], at) for g, at in self.slots.items() if isinstance(g, tuple))
        of_class, grams = [[]], []
        for templates in TEMPLATES.values():
            of_class.append(list(range(len(grams), len(grams) + len(templates))))
            for t in templates:
                own = words(t)
                grams.append(np.unique([self.slots[p] for p in zip(own, own[1:])]))
        return np.array([c for c, _ in pairs], np.int64), np.array([at for _, at in pairs], np.int64), of_class, grams

    def paragraphs(self, text: str) -> list[tuple]:
        """(start, end, family, probability, likeness, confirmed) of the pieces that are predicted to
        be of a family; code points, end exclusive.

        A confirmed one reaches from its first to its last word of the template. Of those that
        overlap the first by this order stays: confirmed, likeness, shorter, probability."""
        lines = lowered(text).split("\n")
        get, slot, counts = self.slots.get, [], np.zeros(len(lines) + 1, np.int64)
        for i, line in enumerate(lines):
            found = _WORD.findall(line)
            counts[i + 1] = len(found)
            slot.append(np.fromiter((get(w, -1) for w in found), np.int32, len(found)))
        slot = np.concatenate(slot)
        if not (slot >= 0).any():
            return []  # with no known word the prediction is that of an empty piece: unknown
        firsts = np.cumsum(counts)
        starts, ends = pieces(firsts, np.array([not line.strip(_MARKS) for line in lines]))
        if self._made is None:
            self._made = self._tables()
        codes, at_code, of_class, grams = self._made
        both = (slot[:-1] >= 0) & (slot[1:] >= 0)
        place = np.flatnonzero(both)
        code = slot[place].astype(np.int64) * len(self.slots) + slot[place + 1]
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        known = codes[at] == code
        pair_place, pair_slot = place[known], at_code[at[known]]
        single = np.flatnonzero(slot >= 0)
        # Known n-grams by first word, the last word of each, and where the same one was before.
        first = np.concatenate((single, pair_place))
        gram = np.concatenate((slot[single], pair_slot)).astype(np.int64)
        order = np.argsort(first, kind="stable")
        first, gram = first[order], gram[order]
        wide = (order >= len(single)).astype(np.int64)
        by_gram = np.lexsort((first, gram))
        before = np.full(len(gram), -1, np.int64)
        same = gram[by_gram][1:] == gram[by_gram][:-1]
        before[by_gram[1:][same]] = first[by_gram[:-1][same]]
        lo, hi = np.searchsorted(first, starts), np.searchsorted(first, ends)
        some = hi > lo
        starts, ends, lo, hi = starts[some], ends[some], lo[some], hi[some]
        hits = []
        for part in blocks((hi - lo).tolist(), BLOCK):
            a, b, n = lo[part], hi[part], hi[part] - lo[part]
            head = np.cumsum(n) - n
            flat = np.arange(n.sum()) + np.repeat(a - head, n)
            # Each distinct n-gram that lies in the piece, once.
            keep = (before[flat] < np.repeat(starts[part], n)) & (first[flat] + wide[flat] < np.repeat(ends[part], n))
            sums = np.add.reduceat(self.weights[gram[flat]] * keep[:, None], head, axis=0)
            z = (self.bias + sums / np.sqrt(ends[part] - starts[part])[:, None]) / self.temperature
            z[:, 0] += self.unknown_offset
            p = _softmax(z)
            best = p.argmax(axis=1)
            for i in np.flatnonzero(best).tolist():
                c, x, y = int(best[i]), int(starts[part.start + i]), int(ends[part.start + i])
                inside = slice(*np.searchsorted(pair_place, (x, y - 1)).tolist())
                own, like, core = pair_slot[inside], 0.0, (x, y)
                for t in of_class[c]:
                    mine = np.isin(own, grams[t])
                    share = len(np.unique(own[mine])) / len(grams[t])
                    if share > like:
                        spot = pair_place[inside][mine]
                        like, core = share, (int(spot[0]), int(spot[-1]) + 2)
                sure = like >= LEAST_LIKENESS
                x, y = core if sure else (x, y)
                hits.append((not sure, -like, y - x, -float(p[i, c]), x, y, c))
        out, taken, spots, offsets = [], [], {}, np.cumsum([0, *[len(line) + 1 for line in lines]])

        def characters(word: int) -> tuple[int, int]:
            n = int(np.searchsorted(firsts, word, side="right")) - 1
            if n not in spots:
                spots[n] = np.array([m.span() for m in _WORD.finditer(lines[n])], np.int64)
            a, b = spots[n][word - firsts[n]].tolist()
            return int(offsets[n]) + a, int(offsets[n]) + b

        for unsure, like, _, probability, x, y, c in sorted(hits):
            # ``taken`` is in order and without overlaps, so that only the neighbours count.
            i = bisect.bisect_left(taken, (x, y))
            if (i < len(taken) and taken[i][0] < y) or (i and taken[i - 1][1] > x):
                continue
            taken.insert(i, (x, y))
            out.append((characters(x)[0], characters(y - 1)[1], self.classes[c], -probability, -like, not unsure))
        return sorted(out)

    def column(self, text: str) -> Column:
        names = ["start", "end", "family", "probability", "likeness", "confirmed"]

        def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series([[dict(zip(names, p)) for p in self.paragraphs(t or "")] for t in batch], dtype=object)

        scan.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        kind = "array<struct<start:int,end:int,family:string,probability:double,likeness:double,confirmed:boolean>>"
        return F.pandas_udf(scan, kind)(F.col(text))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(ordinary: list[str], seed: int = 11, per_template: int = 60, steps: int = 300, l2: float = 1e-4) -> LicenceModel:
    """Train on rows made from the templates and on ``ordinary`` paragraphs."""
    rng = np.random.default_rng(seed)
    classes = [UNKNOWN, *TEMPLATES]
    slots: dict = {}
    for templates in TEMPLATES.values():
        for t in templates:
            own = words(t)
            for gram in (*own, *zip(own, own[1:])):
                slots.setdefault(gram, len(slots))
    every = [words(t) for templates in TEMPLATES.values() for t in templates]
    plain = [w for w in (words(p) for p in ordinary) if w and max(likeness(w, t) for t in every) < 0.4]
    fill = np.array([w for p in plain for w in p] or ["and"], object)  # once, not at each draw
    rows, labels = [[]] * 20, [0] * 20
    for c, templates in enumerate(TEMPLATES.values(), 1):
        for t in templates:
            own = words(t)
            for _ in range(per_template):
                a, b = (0, len(own)) if rng.random() < 0.5 or len(own) < 9 else sorted(rng.choice(len(own) + 1, 2, False))
                kept = [w for w in own[a:b] if rng.random() > 0.05] if b - a >= 8 else own
                pad = [list(rng.choice(fill, rng.integers(0, 6))) if rng.random() < 0.3 else [] for _ in range(2)]
                rows.append([*pad[0], *kept, *pad[1]])
                labels.append(c)
    vocabulary = sorted({w for t in every for w in t})
    for p in plain:
        # As scans see them: whole, or a window where they are longer.
        size = int(rng.choice(WINDOWS))
        at = int(rng.integers(0, max(0, len(p) - size) + 1))
        rows.append(p if len(p) <= WINDOWS[-1] and rng.random() < 0.5 else p[at: at + size])
        labels.append(0)
    for _ in range(10 * per_template):
        rows.append(list(rng.permutation([*rng.choice(vocabulary, rng.integers(1, 8)), *rng.choice(fill, rng.integers(0, 20))])))
        labels.append(0)
    model = LicenceModel(classes, slots, np.zeros((len(slots), len(classes))), np.zeros(len(classes)), 1.0, 0.0)
    x = np.zeros((len(rows), len(slots)), np.float32)
    for i, own in enumerate(rows):
        found, value = model.features(own)
        x[i, found] = value
    y = np.array(labels)
    held = rng.random(len(y)) < 0.25
    target = np.eye(len(classes), dtype=np.float32)[y]
    w, b = np.zeros_like(model.weights), np.zeros(len(classes))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    train_x, train_t = x[~held], target[~held]
    for step in range(1, steps + 1):
        d = (_softmax(train_x @ w.astype(np.float32) + b) - train_t) / len(train_x)
        g, gb = train_x.T @ d + l2 * w, d.sum(axis=0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        b -= 0.3 * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    z, best = x[held] @ w + b, (np.inf, 1.0, 0.0)
    for temperature in np.geomspace(0.25, 4, 17):
        for offset in np.linspace(-2, 2, 17):
            scaled = z / temperature
            scaled[:, 0] += offset
            loss = -np.log(np.maximum(1e-12, _softmax(scaled)[np.arange(len(z)), y[held]])).mean()
            best = min(best, (loss, float(temperature), float(offset)))
    return LicenceModel(classes, slots, w, b, best[1], best[2])


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> LicenceModel:
    """Fit with at most ``PARAGRAPHS`` paragraphs of at most ``sample`` documents, the first of
    both by a hash. A paragraph of over ``LONGEST`` characters is represented by that many,
    from a place that the hash names."""
    rows = docs.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t"))
    ids = rows.select("_k").where("_k IS NOT NULL").distinct().orderBy(F.xxhash64("_k"), "_k").limit(sample)
    picked = rows.join(F.broadcast(ids), "_k")  # the rows of ``sample`` keys
    lines = picked.select("_k", F.posexplode(F.split("_t", "\n")).alias("_n", "_p")).where("trim(_p) <> ''")
    order = F.xxhash64("_k", "_n", "_p")
    start = F.pmod(order, F.greatest(F.length("_p") - LONGEST, F.lit(0)) + 1) + 1
    chosen = lines.select(order.alias("_o"), F.substring("_p", start.cast("int"), F.lit(LONGEST)).alias("_p"))
    rows = chosen.orderBy("_o", "_p").limit(PARAGRAPHS).collect()
    return fit([r["_p"] for r in rows])


def scan(docs: DataFrame, model: LicenceModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key and paragraphs (predicted families; see ``LicenceModel.paragraphs``).

    Null texts are empty; repeated rows are scanned each; other columns are left out.
    """
    return docs.select(F.col(key), model.column(text).alias("paragraphs"))
