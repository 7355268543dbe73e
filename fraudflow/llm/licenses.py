"""Licence scan by a trained paragraph classifier (dealt operator 7).

Paragraphs (lines, and runs of lines with words, joined, so that wrapped
notices are whole; long ones in overlapping windows) are sparse vectors of
hashed word 1- to 3-grams.  A multinomial logistic regression tells licence
families and an ``unknown`` class apart; a temperature fitted on examples kept
apart calibrates its probabilities.  The families that it gives a window at
least ``PROPOSE`` are compared with their templates, and so are their siblings,
whose templates share most of their word pairs.  A family is confirmed if
enough of one template's word pairs occur, and no sibling fits better.  What
the classifier doesn't propose is not looked for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import LOWER, NON_ALNUM, U64, Powers, grams, slices, span_hashes, spans

# The usual notices of public licences.
TEMPLATES = {
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "bsd-2-clause": [
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-nc-nd-4.0": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "cc-by-nc-sa-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "cc-by-nd-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0-1.0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "epl-2.0": [
        "Released under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "lgpl-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "lgpl-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "Released under the Mozilla Public License 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without prior written permission of the publisher.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}
UNKNOWN = "unknown"
WINDOW, STRIDE = 40, 20  # words of a window of a long line, and between their starts
FEATURES = 1 << 15
MAX_UNKNOWN = 4000  # paragraphs of the corpus that stand for the unknown class in training
SAMPLE_DOCUMENTS = 2000  # documents that these come from, those of the smallest hash of their id
PROPOSE = 0.01  # probability from which a family is proposed for a window (its recall: tests, README)
CONFIRM = 0.6  # share of a template's word pairs that confirms it
ALIKE = 0.5  # share of a template's word pairs that make another one its sibling


def windows(first: np.ndarray, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, begin, end) of the windows over units of words; of ``some`` units only, if given."""
    n = np.diff(first)
    k = np.where(n > WINDOW, -(-(n - WINDOW) // STRIDE) + 1, (n > 0).astype(np.int64))
    if some is not None:
        k = k * some
    unit = np.repeat(np.arange(len(n)), k)
    begin = first[unit] + (np.arange(len(unit)) - np.repeat(np.cumsum(k) - k, k)) * STRIDE
    return unit, begin, np.minimum(begin + WINDOW, first[unit + 1])


def line_words(buf: np.ndarray, off: np.ndarray, powers: Powers):
    """Words of a slice by line: lower-cased bytes, word hashes, byte starts, byte ends, lines' first word, texts' first line."""
    low = LOWER[buf]
    edge = np.unique(np.concatenate([off, np.flatnonzero(buf == 10) + 1]))
    edge = edge[edge <= off[-1]]
    s, e, first = spans(low, edge, NON_ALNUM)
    return low, span_hashes(low, s, e, powers), s, e, first, np.searchsorted(edge, off)


def joined(first: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of lines with words: their first words, and which have two lines or more.

    Comment marks are no words, so a line of them alone ends a run, as an empty one does.
    """
    has = np.diff(first) > 0
    start = has.copy()
    start[1:] &= ~has[:-1]
    texts = top[:-1][top[:-1] < len(has)]
    start[texts] = has[texts]
    at = np.flatnonzero(start)
    lines = np.add.reduceat(has.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    return np.append(first[at], first[-1]), lines > 1


def columns(words: np.ndarray, first: np.ndarray):
    """By n-gram length: the feature of the n-gram at each word, and whether one line holds it."""
    out = []
    for n in (1, 2, 3):
        h, ok = (words, np.ones(len(words), bool)) if n == 1 else grams(words, first, n, 30 + n)
        out.append(((h & U64(FEATURES - 1)).astype(np.int64), ok))
    return out


class Templates:
    """The templates' distinct word pairs as one sorted table, and which template has which."""

    def __init__(self, families: list[str], pairs: list[list[np.ndarray]]) -> None:
        """``pairs``: the templates' hashed word pairs, by family."""
        flat = [t for ts in pairs for t in ts]
        self.family = np.repeat(np.arange(len(pairs)), [len(ts) for ts in pairs])
        self.table = np.unique(np.concatenate(flat))
        self.has = np.stack([np.isin(self.table, t) for t in flat], axis=1)  # pairs x templates
        self.size = self.has.sum(axis=0)
        of = np.stack([self.has[:, self.family == k].any(axis=1) for k in range(len(pairs))], axis=1)
        self.of_family = of.astype(np.int32)
        # pairs that no other family's templates have
        self.own = self.has & (of.sum(axis=1) == 1)[:, None]
        shared = self.has.T.astype(np.int64) @ self.has
        self.alike = shared >= ALIKE * self.size[:, None]  # of the first template's pairs, in the second
        m = len(families)
        self.siblings = np.eye(m, dtype=bool)
        for i, j in zip(*np.nonzero(self.alike | self.alike.T)):
            self.siblings[self.family[i], self.family[j]] = True
        need = np.ceil(CONFIRM * self.size - 1e-9)
        self.need = np.array([need[self.family == k].min(initial=np.inf) for k in range(m)])  # of a family's pairs, at least

    def fit(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For distinct pairs (places in the table): the share of each template that occurs, and which may be confirmed at all."""
        rows = self.has[found]
        own = self.own[found].any(axis=0) | ~self.own.any(axis=0)
        return rows.sum(axis=0) / self.size, own

    def confirmed(self, found: np.ndarray, proposed: np.ndarray) -> list[tuple[int, float, int]]:
        """(family, share, template) of the proposed families with CONFIRM of a template's pairs, of siblings
        the one that fits best.  If a template has pairs that no other family's has, one of them must occur."""
        share, own = self.fit(found)
        best = {}
        for t in np.flatnonzero(own & proposed[self.family] & (share >= CONFIRM)):
            k = int(self.family[t])
            if k not in best or (share[t], self.size[t]) > (best[k][1], self.size[best[k][2]]):
                best[k] = (k, float(share[t]), int(t))
        return [x for x in best.values() if not any(y[1] > x[1] and self.alike[x[2], y[2]] for y in best.values())]


@dataclass
class Classifier:
    families: list[str]  # the last is UNKNOWN
    weights: np.ndarray  # FEATURES x families
    bias: np.ndarray
    temperature: float
    templates: Templates

    def probabilities(self, words, first, begin, end) -> np.ndarray:
        """Calibrated probabilities of windows [begin, end) over words; ``first``: the units' first words."""
        logits = np.zeros((len(begin), len(self.families)))
        size = np.zeros(len(begin))
        for n, (feature, ok) in enumerate(columns(words, first), 1):
            if not len(feature):
                continue
            rows = self.weights[feature]
            rows[~ok] = 0
            total = np.zeros((len(feature) + 1, len(self.families)))
            np.cumsum(rows, axis=0, dtype=np.float64, out=total[1:])
            stop = np.clip(end - n + 1, begin, len(feature))
            logits += total[stop] - total[np.minimum(begin, len(feature))]
            size += np.maximum(0, end - begin - n + 1)
        z = (logits / np.sqrt(np.maximum(size, 1))[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def notices(self, words, first, unit, begin, end):
        """Of windows over units: probabilities, the places of the templates' pairs among the words, and the confirmed
        notices as (window, family, probability, share, its pairs' first place, first and last place of all pairs near).

        What is left of a window beside the notices found in it is classified
        again, as two notices close together hide one another.
        """
        t, every = self.templates, None
        h, ok = grams(words, first, 2, 32)
        at = np.minimum(np.searchsorted(t.table, h), len(t.table) - 1)
        places = np.flatnonzero(ok & (t.table[at] == h))
        hits = at[places]
        upto = np.zeros((len(hits) + 1, len(t.need)), np.int32)
        np.cumsum(t.of_family[hits], axis=0, out=upto[1:])
        # a template may be longer than a window
        longest = max(WINDOW, int(t.size.max()) + 1)
        window, floor, top = np.arange(len(begin)), first[unit], first[unit + 1]
        out = []
        while len(window):
            p = self.probabilities(words, first, begin, end)
            every = p if every is None else every
            proposed = p[:, :-1] >= PROPOSE
            some = np.flatnonzero(proposed.any(axis=1))
            wanted = (proposed[some].astype(np.int32) @ t.siblings.astype(np.int32)) > 0
            low = np.searchsorted(places, np.maximum(floor[some], begin[some] - longest))
            high = np.searchsorted(places, np.minimum(top[some], end[some] + longest) - 1)
            wanted &= upto[high] - upto[low] >= t.need
            rest = []
            for i in np.flatnonzero(wanted.any(axis=1)):
                w, a, z = int(some[i]), int(low[i]), int(high[i])
                spans_ = []
                for k, share, template in t.confirmed(np.unique(hits[a:z]), wanted[i]):
                    x, y = _closest(places[a:z], hits[a:z], t.has[:, template])
                    spans_.append((x, y + 2))
                    out.append((int(window[w]), k, p[w, k], share, x, int(places[a]), int(places[z - 1])))
                left = int(begin[w])
                edge = int(floor[w])
                for x, y in sorted(spans_):
                    rest.append((window[w], left, min(x, int(end[w])), edge, x))
                    left, edge = max(left, y), max(edge, y)
                if spans_:
                    rest.append((window[w], left, int(end[w]), edge, int(top[w])))
            rest = [r for r in rest if r[2] - r[1] > 1]
            window, begin, end, floor, top = np.array(rest, np.int64).reshape(-1, 5).T
        return np.zeros((0, len(self.families))) if every is None else every, places, hits, out


def _closest(places: np.ndarray, hits: np.ndarray, has: np.ndarray) -> tuple[int, int]:
    """First and last place of the shortest stretch of twice a template's length with the most of its pairs."""
    own = has[hits]
    places, hits = places[own], hits[own]
    ends = np.searchsorted(places, places + 2 * has.sum())
    best = max(range(len(places)), key=lambda j: (len(np.unique(hits[j: ends[j]])), j))
    known, last = set(), best
    for j in range(best, ends[best]):  # repeats at the end don't belong
        if hits[j] not in known:
            known.add(hits[j])
            last = j
    return int(places[best]), int(places[last])


def _pairs(words: np.ndarray) -> np.ndarray:
    return np.unique(grams(words, np.array([0, len(words)]), 2, 32)[0]) if len(words) > 1 else words


def _hash(text: str, powers: Powers) -> np.ndarray:
    raw = LOWER[np.frombuffer(text.encode(), np.uint8)]
    s, e, _ = spans(raw, np.array([0, len(raw)]), NON_ALNUM)
    return span_hashes(raw, s, e, powers)


def _variants(template: str, fillers: list[str], rng: np.random.Generator, count: int) -> list[str]:
    """A template as it stands, and with words lost, or put before and after it."""
    out, words = [template], template.split()
    while len(out) < count:
        w = [x for x in words if len(words) < 6 or rng.random() > 0.06]
        if fillers and rng.random() < 0.5:
            f = fillers[rng.integers(len(fillers))].split()[: int(rng.integers(1, WINDOW))]
            at = int(rng.integers(len(f) + 1))
            w = f[:at] + w + f[at:]
        out.append(" ".join(w))
    return out


def train(paragraphs: list[str], templates: dict[str, list[str]] = TEMPLATES, copies: int = 40, epochs: int = 60, seed: int = 7) -> Classifier:
    """A classifier from templates and paragraphs of unknown kind.

    Paragraphs that hold CONFIRM of a template don't stand for the unknown
    class.  Every fifth example is kept apart for the temperature.
    """
    powers, rng = Powers(), np.random.default_rng(seed)
    families = [*sorted(templates), UNKNOWN]
    table = Templates(families[:-1], [[_pairs(_hash(t, powers)) for t in templates[f]] for f in families[:-1]])

    def holds(text):
        found = np.flatnonzero(np.isin(table.table, _pairs(_hash(text, powers))))
        return (table.fit(found)[0] >= CONFIRM).any()

    plain = [p for p in paragraphs if not holds(p)]
    texts, kinds = [], []
    for k, f in enumerate(families[:-1]):
        for t in templates[f]:
            made = _variants(t, plain, rng, copies)
            texts += made
            kinds += [k] * len(made)
            # a mere beginning, or words in another order, is no notice
            words = t.split()
            for _ in range(copies // 4):
                texts += [" ".join(words[: max(1, len(words) // 3)]), " ".join(rng.permutation(words)[: max(1, len(words) // 2)])]
                kinds += [len(families) - 1] * 2
    texts += plain
    kinds += [len(families) - 1] * len(plain)
    rows, cols, values = [], [], []
    for i, t in enumerate(texts):
        w = _hash(t, powers)
        c = np.concatenate([f[ok] for f, ok in columns(w, np.array([0, len(w)]))])
        rows.append(np.full(len(c), i))
        cols.append(c)
        values.append(np.full(len(c), 1 / np.sqrt(max(1, len(c)))))
    rows, cols, values, kinds = np.concatenate(rows), np.concatenate(cols), np.concatenate(values).astype(np.float32), np.array(kinds)
    apart = rng.permutation(len(texts)) % 5 == 0
    used, cols = np.unique(cols, return_inverse=True)
    m, n = len(families), len(texts)
    # entries by example, and by feature
    has, starts = np.unique(rows, return_index=True)
    by = np.argsort(cols, kind="stable")
    rows_by, values_by, starts_by = rows[by], values[by][:, None], np.searchsorted(cols[by], np.arange(len(used)))
    weights, bias = np.zeros((len(used), m), np.float32), np.zeros(m, np.float32)
    speed, speed_b = np.full((len(used), m), 1e-8, np.float32), np.full(m, 1e-8, np.float32)
    truth = np.eye(m, dtype=np.float32)[kinds]
    each = (~apart / np.maximum(1, np.bincount(kinds, minlength=m))[kinds])[:, None]  # classes weigh the same
    each = (each / each.sum()).astype(np.float32)

    def logits():
        z = np.zeros((n, m), np.float32)
        z[has] = np.add.reduceat(weights[cols] * values[:, None], starts, axis=0)
        return z + bias

    def soft(z):
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    for _ in range(epochs):
        g = (soft(logits()) - truth) * each
        d = np.add.reduceat(g[rows_by] * values_by, starts_by, axis=0) + 1e-6 * weights
        speed += d * d
        weights -= 0.5 * d / np.sqrt(speed)
        d = g.sum(axis=0)
        speed_b += d * d
        bias -= 0.5 * d / np.sqrt(speed_b)
    z = logits()[apart].astype(np.float64)
    loss = [(-np.log(np.maximum(1e-12, soft(z / t)[np.arange(len(z)), kinds[apart]])).mean(), t) for t in np.geomspace(0.2, 5, 33)]
    full = np.zeros((FEATURES, m), np.float32)
    full[used] = weights
    return Classifier(families, full, bias.astype(np.float64), float(min(loss)[1]), table)


def corpus_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = SAMPLE_DOCUMENTS, limit: int = MAX_UNKNOWN) -> list[str]:
    """At most ``limit`` paragraphs of at most WINDOW words, from the ``documents`` documents of the smallest hash of their id."""
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(documents)
    # at most ``documents`` ids are broadcast
    texts = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(ids), F.col("i") == F.col("_id"), "left_semi")

    def run(batches):
        import pyarrow as pa

        powers = Powers()
        for b in batches:
            for _, buf, off in slices(b.column("text")):
                low, _, s, e, first, _ = line_words(buf, off, powers)
                _, begin, end = windows(first)
                raw = low.tobytes()
                yield pa.record_batch({"p": pa.array([raw[s[x]: e[y - 1]].decode("utf-8", "replace") for x, y in zip(begin, end)], pa.string())})

    return [r["p"] for r in texts.select("text").mapInArrow(run, "p string").distinct().orderBy(F.xxhash64("p"), "p").limit(limit).collect()]


def scan_licenses(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, found (line, family, probability, similarity, confirmed) for every row of ``docs``.

    n_lines counts lines with a word; ``line`` counts all lines from 0.  For
    each line and family the best window counts, a confirmed one first.
    ``found`` holds the families that the classifier prefers to unknown on a
    line, and those proposed that a template confirms.  A notice over several
    lines stands at its first one.  A null or empty text has none.
    """
    def run(batches):
        import pyarrow as pa

        powers, t = Powers(), model.templates
        kind = pa.list_(pa.struct([("line", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_())]))
        for b in batches:
            for row, buf, off in slices(b.column("text"), 1 << 20):
                n = len(off) - 1
                _, words, _, _, first, top = line_words(buf, off, powers)
                found: list[dict] = [{} for _ in range(n)]

                def put(line, k, probability, same, sure):
                    doc = int(np.searchsorted(top, line, "right")) - 1
                    at, family = int(line - top[doc]), model.families[k]
                    old = found[doc].get((at, family))
                    if old is None or (old["confirmed"], old["probability"]) < (sure, probability):
                        found[doc][at, family] = {"line": at, "family": family, "probability": float(probability), "similarity": same, "confirmed": sure}

                line, begin, end = windows(first)
                p, places, hits, sure = model.notices(words, first, line, begin, end)
                for u, k, probability, same, *_ in sure:
                    put(line[u], k, probability, same, True)
                known = {x[:2] for x in sure}
                best = p.argmax(axis=1)
                for u in np.flatnonzero(best < len(model.families) - 1):
                    if (u, best[u]) not in known:
                        near = hits[np.searchsorted(places, begin[u]): np.searchsorted(places, end[u] - 1)]
                        put(line[u], best[u], p[u, best[u]], float(t.fit(np.unique(near))[0][t.family == best[u]].max()), False)

                runs, several = joined(first, top)
                run_of, begin, end = windows(runs, several)
                p, places, hits, sure = model.notices(words, runs, run_of, begin, end)
                for _, k, probability, same, start, *ends in sure:
                    a, z = np.searchsorted(first, ends, "right") - 1
                    doc = int(np.searchsorted(top, a, "right")) - 1
                    if any(f == model.families[k] and x["confirmed"] and a <= at + top[doc] <= z for (at, f), x in found[doc].items()):
                        continue  # on a line of its own, or in the window before
                    put(np.searchsorted(first, start, "right") - 1, k, probability, same, True)
                has = np.concatenate([[0], np.cumsum(np.diff(first) > 0)])
                lines = has[np.minimum(top[1:], len(has) - 1)] - has[np.minimum(top[:-1], len(has) - 1)]
                yield pa.record_batch([b.column("doc_id").slice(row, n), pa.array(lines), pa.array([[x[k] for k in sorted(x)] for x in found], kind)],
                                      names=["doc_id", "n_lines", "found"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_lines long, found array<struct<line:long,family:string,probability:double,similarity:double,confirmed:boolean>>")
