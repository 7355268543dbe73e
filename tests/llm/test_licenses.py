"""Operator 7: held-out accuracy, template confirmation, edge cases."""
import textwrap

import numpy as np
import pytest

from fraudflow.llm import catalog
from fraudflow.llm import licenses as L
from fraudflow.llm.licenses import TEMPLATES, corpus_paragraphs, scan_licenses, train
from fraudflow.llm.words import Powers

from .conftest import EDGE, table

MID = "/root/testdata/sf0.01"
LINES = {"apache-2.0": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.",
         "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.", "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.", "proprietary": "All rights reserved."}


@pytest.fixture(scope="module")
def model(spark):
    return train(corpus_paragraphs(spark.read.parquet(f"{MID}/documents.parquet")))


def found(df, model):
    return {r["doc_id"]: [(x["line"], x["family"], x["confirmed"]) for x in r["found"]] for r in scan_licenses(df, model).collect()}


def test_every_template_in_prose(spark, model):
    rng = np.random.default_rng(1)
    prose = corpus_paragraphs(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    rows, want = [], {}
    for f, ts in sorted(TEMPLATES.items()):
        for t in ts:
            want[len(rows)] = f
            rows.append((len(rows), "\n".join([*rng.choice(prose, 3), t, *rng.choice(prose, 2)])))
    got = found(table(spark, rows), model)
    for i, f in want.items():
        assert [x[:2] for x in got[i] if x[2]] == [(3, f)], (f, rows[i][1], got[i])


def test_unknown_paragraphs(spark, model):
    rows = [(1, "The licence of the river is under the old version of the bridge."), (2, "General public meetings are free of charge to any person."),
            (3, "Version 2.0 of the Apache helicopter"), (4, "reserved seats, all rights"), (5, "MIT is in Cambridge")]
    assert not any(c for x in found(table(spark, rows), model).values() for _, _, c in x)


def test_long_lines(spark, model):
    prose = " ".join(f"filler{i}" for i in range(500))
    got = found(table(spark, [(1, f"{prose} {LINES['gpl-3.0']} {prose}"), (2, prose)]), model)
    assert [x[1:] for x in got[1] if x[2]] == [("gpl-3.0", True)] and not got[2]


def test_probabilities_are_calibrated(spark, model):
    """On documents outside the training sample: a licence line is sure, other lines are unknown."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 10 = 3")
    got = {r["doc_id"]: r for r in scan_licenses(docs, model).collect()}
    right = wrong = 0
    for r in docs.collect():
        have = {f for f, t in LINES.items() if t in r["text"].split("\n")}
        said = {x["family"] for x in got[r["doc_id"]]["found"] if x["confirmed"]}
        right += have == said and bool(have)
        wrong += have != said
    assert right > 5 and wrong == 0


def test_registered_query(spark):
    got = {r["doc_id"]: r for r in catalog.QUERIES["op7_license_scan"](spark, MID).collect()}
    for r in spark.read.parquet(f"{MID}/documents.parquet").collect():
        lines = (r["text"] or "").split("\n")
        assert got[r["doc_id"]]["licenses"] == ",".join(sorted(f for f, t in LINES.items() if t in lines)), r["doc_id"]


def test_edge_cases(spark, edge, empty, model):
    got = scan_licenses(edge, model).collect()
    assert len(got) == len(EDGE) and not any(x["confirmed"] for r in got for x in r["found"])
    assert {r["doc_id"]: r["n_lines"] for r in got}[5] == 2 and {r["doc_id"]: r["n_lines"] for r in got}[1] == 0
    assert scan_licenses(empty, model).collect() == []
    assert corpus_paragraphs(empty) == []
    alone = train([])  # no paragraphs of unknown kind
    assert [x[1] for x in found(table(spark, [(1, LINES["mit"])]), alone)[1]] == ["mit"]


def test_wrapped_notices(spark, model):
    rows, want = [], {}
    for f, ts in sorted(TEMPLATES.items()):
        for t in ts:
            for mark in ("", "# ", " * "):
                body = "\n".join(mark + x for x in textwrap.wrap(t, 30))
                want[len(rows)] = f
                rows.append((len(rows), f"import os\n\n{body}\n\nThe river is wide here."))
    got = found(table(spark, rows), model)
    for i, f in want.items():
        assert [x for x in got[i] if x[2]] == [(2, f, True)], (rows[i][1], got[i])


def test_two_licences_on_a_line(spark, model):
    prose = " ".join(f"filler{i}" for i in range(200))
    texts = [f"{LINES['mit']} {LINES['gpl-3.0']}", f"{prose} {LINES['mit']} {prose} {LINES['apache-2.0']} {prose}", f"{LINES['apache-2.0']} {LINES['cc-by-nc-4.0']}"]
    got = found(table(spark, list(enumerate(texts))), model)
    want = [["gpl-3.0", "mit"], ["apache-2.0", "mit"], ["apache-2.0", "cc-by-nc-4.0"]]
    assert [[x[1] for x in got[i] if x[2]] for i in range(3)] == want


# Public licences' own headers, longer than the templates and not made from them.
HEADERS = {
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "lgpl-2.1": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "agpl-3.0": """This file is part of the tool.
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.""",
    "gpl-2.0": """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful,""",
    "isc": """Copyright (c) 2019, Someone
Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES""",
    "bsd": """Copyright 2020 Someone Else

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:
1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer.""",
    "epl-2.0": """Copyright (c) 2018 A Company and others.
This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "cc-by-nd-4.0": "The photographs of this page are licensed under CC BY-ND 4.0. Ask before you print them.",
    "cc-by-nc-sa-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License, as is its sequel.",
}


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_real_headers(spark, model, mark):
    """Siblings among them: of all families whose words stand there, the one that is meant, and no other."""
    rows = [(i, "int main;\n" + "\n".join(mark + x for x in t.split("\n")) + "\nThe river is wide.") for i, t in enumerate(HEADERS.values())]
    got = found(table(spark, rows), model)
    for i, f in enumerate(HEADERS):
        assert {x[1] for x in got[i] if x[2]} == {f}, (f, got[i])


def brute(text, model):
    """Confirmed families of a text: every window classified by itself, templates compared as sets."""
    powers, fams = Powers(), model.families
    pairs = {(f, i): set(L._pairs(L._hash(t, powers)).tolist()) for f in fams[:-1] for i, t in enumerate(TEMPLATES[f])}
    alike = lambda a, b: len(pairs[a] & pairs[b]) >= L.ALIKE * len(pairs[a])
    siblings = {f: {b[0] for a in pairs if a[0] == f for b in pairs if alike(a, b) or alike(b, a)} | {f} for f in fams[:-1]}
    own = {a: pairs[a] - set().union(*(pairs[b] for b in pairs if b[0] != a[0])) for a in pairs}
    longest = max(L.WINDOW, max(map(len, pairs.values())) + 1)
    lines = [L._hash(x, powers) for x in text.split("\n")]
    units, run = [w for w in lines if len(w)], []
    for w in [*lines, np.zeros(0, np.uint64)]:
        if len(w):
            run.append(w)
        elif run:
            units += [np.concatenate(run)] if len(run) > 1 else []
            run = []
    out = set()

    def look(words, begin, end, floor, top):
        if end - begin < 2:
            return
        w = words[begin:end]
        z, n = np.zeros(len(fams)), 0
        for feature, ok in L.columns(w, np.array([0, len(w)])):
            z, n = z + model.weights[feature[ok]].sum(axis=0, dtype=float), n + int(ok.sum())
        z = (z / np.sqrt(max(n, 1)) + model.bias) / model.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        proposed = set().union(*(siblings[f] for f, x in zip(fams, p[:-1]) if x >= L.PROPOSE))
        a, b = max(floor, begin - longest), min(top, end + longest)
        near = set(L._pairs(words[a:b]).tolist()) if b - a > 1 else set()
        share = {t: len(pairs[t] & near) / len(pairs[t]) for t in pairs if t[0] in proposed and (not own[t] or own[t] & near)}
        best = {}
        for t, x in share.items():
            if x >= L.CONFIRM and (t[0] not in best or (x, len(pairs[t])) > (best[t[0]][1], len(pairs[best[t[0]][0]]))):
                best[t[0]] = t, x
        sure = [t for t, x in best.values() if not any(y > x and alike(t, u) for u, y in best.values())]
        out.update(t[0] for t in sure)
        if sure:
            cuts = []
            for t in sure:
                at = [i for i in range(a, b - 1) if int(L._pairs(words[i: i + 2])[0]) in pairs[t]]
                ids = [int(L._pairs(words[i: i + 2])[0]) for i in at]
                stop = [next((j for j in range(len(at)) if at[j] >= x + 2 * len(pairs[t])), len(at)) for x in at]
                j = max(range(len(at)), key=lambda j: (len(set(ids[j: stop[j]])), j))
                cuts.append((at[j], max(at[ids.index(x, j)] for x in set(ids[j: stop[j]])) + 2))
            left, edge = begin, floor
            for x, y in sorted(cuts):
                look(words, left, min(x, end), edge, x)
                left, edge = max(left, y), max(edge, y)
            look(words, left, end, edge, top)

    for w in units:
        for at in range(0, max(1, -(-(len(w) - L.WINDOW) // L.STRIDE) + 1) * L.STRIDE, L.STRIDE) if len(w) else ():
            look(w, at, min(at + L.WINDOW, len(w)), 0, len(w))
    return out


def test_against_brute_force(spark, model):
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60).collect()]
    rng = np.random.default_rng(4)
    flat = [t for ts in TEMPLATES.values() for t in ts]
    prose = corpus_paragraphs(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    for _ in range(120):  # notices with words lost, of several families, in prose, on lines or run together
        parts = []
        for t in rng.choice(flat, rng.integers(1, 4)):
            parts.append(" ".join(x for x in t.split() if rng.random() > 0.12))
            parts.append(str(rng.choice(prose)))
        docs.append(str(rng.choice(["\n", " ", "\n\n"])).join("\n".join(textwrap.wrap(x, 45)) if rng.random() < 0.3 else x for x in parts))
    got = found(table(spark, list(enumerate(docs))), model)
    some = 0
    for i, text in enumerate(docs):
        want = brute(text, model)
        assert {x[1] for x in got[i] if x[2]} == want, text
        some += bool(want)
    assert some > 60


def test_recall_of_proposals(spark, model, monkeypatch):
    """Of notices with a tenth of their words lost, in prose of other documents than those trained on, the share that is
    found although the classifier must propose it first."""
    prose = corpus_paragraphs(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 10 = 7"))
    rng = np.random.default_rng(8)
    rows, want = [], []
    for f, ts in sorted(TEMPLATES.items()):
        for t in ts:
            for _ in range(12):
                w = t.split()
                kept = [x for x in w if len(w) < 8 or rng.random() > 0.1]
                before, after = (" ".join(str(x) for x in rng.choice(prose, 2)).split()[: rng.integers(0, 30)] for _ in range(2))
                rows.append((len(rows), " ".join([*before, *kept, *after])))
                want.append(f)
    got = found(table(spark, rows), model)
    hits = [f in {x[1] for x in got[i] if x[2]} for i, f in enumerate(want)]
    monkeypatch.setattr(L, "PROPOSE", 0.0)  # without the gate every family is proposed everywhere
    whole = found(table(spark, rows), model)
    at_all = [f in {x[1] for x in whole[i] if x[2]} for i, f in enumerate(want)]
    print("found", np.mean(hits), "confirmable", np.mean(at_all))
    assert sum(hits) >= 0.97 * sum(at_all)
