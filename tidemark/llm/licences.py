"""Licence scan: a trained classifier of paragraphs, with an unknown class and confirmation against templates."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8

# Short notices of licence families, as their texts and usual headers word them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "GPL-2.0": (
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "Zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "SPDX-License-Identifier: Zlib",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal",
        "This work is dedicated to the public domain.",
    ),
    "Proprietary": ("All rights reserved.", "All rights reserved. No part of this publication may be reproduced without prior written permission.",),
}
# How texts name the families, for short statements to learn from.
NAMES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache License 2.0", "Apache 2.0", "Apache-2.0", "Apache License, Version 2.0", "Apache License v2.0", "Apache Software License"),
    "MIT": ("MIT License", "MIT", "MIT licence", "Expat License"),
    "GPL-3.0": ("GNU General Public License v3", "GNU GPL v3", "GPLv3", "GPL version 3", "GPL-3.0", "GNU General Public License, version 3 or later"),
    "GPL-2.0": ("GNU General Public License v2", "GNU GPL v2", "GPLv2", "GPL version 2", "GPL-2.0", "GNU General Public License, version 2 only"),
    "LGPL": ("GNU Lesser General Public License", "LGPL", "GNU LGPL", "LGPLv3", "LGPL-2.1", "Lesser GPL"),
    "AGPL-3.0": ("GNU Affero General Public License", "AGPL", "AGPLv3", "GNU AGPL", "AGPL-3.0"),
    "BSD": ("BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "3-clause BSD", "BSD-style license", "New BSD License"),
    "MPL-2.0": ("Mozilla Public License", "MPL 2.0", "Mozilla Public License 2.0", "MPL"),
    "ISC": ("ISC License", "ISC"),
    "Zlib": ("zlib License", "zlib/libpng license"),
    "BSL-1.0": ("Boost Software License", "Boost Software License 1.0", "BSL-1.0"),
    "EPL-2.0": ("Eclipse Public License", "Eclipse Public License 2.0", "EPL"),
    "Unlicense": ("Unlicense", "The Unlicense"),
    "CC-BY": ("CC BY 4.0", "Creative Commons Attribution 4.0", "CC-BY", "Creative Commons Attribution License"),
    "CC-BY-SA": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0", "CC-BY-SA 3.0", "Creative Commons Attribution-ShareAlike License"),
    "CC-BY-NC": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0", "CC-BY-NC", "Creative Commons Attribution-NonCommercial License"),
    "CC0": ("CC0", "CC0 1.0", "Creative Commons Zero", "CC0 1.0 Universal"),
}
# What is said of a named licence.
FRAMES = ("Licensed under the {}.", "Released under {}", "This project is licensed under the terms of the {}", "Distributed under the {}, see the file COPYING", "published under {}", "The code is {} licensed", "License: {}")
# Statements of unnamed or other terms, and words that no terminal may consist of alone.
OTHER = (
    "Licensed under the terms of the agreement.", "See the license file for details.", "This software is provided under a custom license.",
    "Released under the terms below.", "Please read the license before use.", "Driver license number", "He holds a license to fish.", "version 2.0 of the software",
    "Distributed under the community license, version 1.", "the work is released to the public", "mit und von der", "Licensed under the Example Source License, version 4.",
)
COMMON = set("the of to and a in is it for on you not this that be or any as at with by under may if was are an without an so use can from all no one file copy mit der von und in use work terms provided following person".split())

TOKEN = re.compile(r"[a-z0-9]+")
NONE, UNKNOWN = "none", "unknown"
#: The family that grants nothing; its notice also opens texts of other licences, which then name the licence.
RESERVED = "Proprietary"
SHINGLE, CONFIRM = 5, 0.8


def _tokens(text: str) -> list[str]:
    return TOKEN.findall(text.casefold())


def _grams(tokens: list[str]) -> set[str]:
    return {" ".join(tokens[k : k + n]) for n in (1, 2, 3) for k in range(len(tokens) - n + 1)}


def _shingles(tokens: list[str]) -> set[tuple[str, ...]]:
    return {tuple(tokens[k : k + SHINGLE]) for k in range(max(1, len(tokens) - SHINGLE + 1))} if tokens else set()


@dataclass
class Model:
    families: list[str]
    terms: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    anchors: frozenset[str]

    def probabilities(self, tokens: list[str]) -> np.ndarray:
        at = [self.terms[g] for g in _grams(tokens) if g in self.terms]
        z = (self.bias + self.weights[at].sum(axis=0)) / self.temperature
        z = np.exp(z - z.max())
        return z / z.sum()

    def classify(self, paragraph: str) -> tuple[str, float, bool]:
        """(family, none or unknown; probability; whether a template confirms the family)."""
        return self.judge(_tokens(paragraph))

    def judge(self, tokens: list[str]) -> tuple[str, float, bool]:
        if self.anchors.isdisjoint(tokens):
            return NONE, 1.0, False
        p = self.probabilities(tokens)
        best = int(np.argmax(p))
        family, sure = self.families[best], float(p[best])
        if family in (NONE, UNKNOWN):
            return family, sure, False
        if sure < 0.5:
            return UNKNOWN, sure, False
        have = _shingles(tokens)
        held = max(self._inside(t, tokens, have) for t in TEMPLATES[family])
        return family, sure, held >= CONFIRM

    @staticmethod
    def _inside(template: str, tokens: list[str], have: set) -> float:
        want = _tokens(template)
        if len(want) < SHINGLE:
            return float(any(tokens[k : k + len(want)] == want for k in range(len(tokens) - len(want) + 1)))
        s = _shingles(want)
        return len(s & have) / len(s)


@lru_cache(maxsize=1)
def _parts() -> tuple[frozenset, dict, list]:
    """First three words of all template parts; (template, part) numbers by a part's words; words and distinct parts of each template.

    A part is a shingle, or the whole of a template shorter than one.
    """
    where: dict[tuple[str, ...], list[tuple[int, int]]] = {}
    lengths = []
    for k, t in enumerate(t for ts in TEMPLATES.values() for t in ts):
        want = _tokens(t)
        found = _shingles(want)
        lengths.append((len(want), len(found)))
        for n, part in enumerate(sorted(found)):
            where.setdefault(part, []).append((k, n))
    return frozenset(p[:3] for p in where), where, lengths


def notices(lines: list[list[str]], at: list[int]) -> Iterator[tuple[int, int, list[str]]]:
    """(first line, last line, words) of each place where lines joined hold CONFIRM of a template's parts, and no single line does.

    ``at`` has the lines' numbers in the text; a template shorter than a shingle doesn't run over empty lines.
    """
    starts, where, lengths = _parts()
    words = [w for line in lines for w in line]
    of = [k for k, line in enumerate(lines) for _ in line]
    sizes = sorted({len(p) for p in where})
    hits: dict[int, list[tuple[int, int]]] = {}
    for p, key in enumerate(zip(words, words[1:], words[2:])):
        if key in starts:
            for n in sizes:
                for k, part in where.get(tuple(words[p : p + n]), ()):
                    hits.setdefault(k, []).append((p, part))
    for k, found in hits.items():
        length, parts = lengths[k]
        end = min(length, SHINGLE)
        run: dict[int, int] = {}  # the last place of each part, in order

        def place() -> Iterator[tuple[int, int, list[str]]]:
            if len(run) >= CONFIRM * parts:
                p, q = next(iter(run.values())), next(reversed(run.values())) + end
                a, b = of[p], of[q - 1]
                if a < b and (length >= SHINGLE or at[b] - at[a] == b - a):
                    more = max(0, length - (q - p))  # words that set the family apart may be in the missing parts
                    yield a, b, words[max(0, p - more) : q + more]

        for p, part in found:
            if run and (p - next(reversed(run.values())) > length or part in run and len(run) >= CONFIRM * parts):
                yield from place()
                run.clear()
            run.pop(part, None)
            run[part] = p
        yield from place()


@lru_cache(maxsize=1)
def train(seed: int = 1, copies: int = 16) -> Model:
    """Sparse logistic regression on word n-grams, trained on noisy copies of the templates and of other statements.

    Copies lose and gain words and run into other text. Short statements name each family as texts do, and others name
    licences that don't exist. Half of the copies fit the weights; the temperature that makes
    probabilities honest is chosen on the other half.
    """
    rng = np.random.default_rng(seed)
    families = [*TEMPLATES, UNKNOWN, NONE]
    held = {w for ts in (*TEMPLATES.values(), *NAMES.values()) for t in ts for w in _tokens(t)} | {w for t in FRAMES for w in _tokens(t)}
    filler = [w for w in COMMON if len(w) > 1] + ["lorem", "anea", "thered", "data", "page", "text", "house", "value", "2020", "note"]
    rows: list[tuple[list[str], int]] = []

    def noisy(tokens: list[str], drop: float) -> list[str]:
        out = [t for t in tokens if rng.random() > drop]
        for _ in range(rng.integers(0, 4)):
            out.insert(int(rng.integers(0, len(out) + 1)), str(rng.choice(filler)))
        return [*rng.choice(filler, rng.integers(0, 12)).tolist(), *out, *rng.choice(filler, rng.integers(0, 12)).tolist()]

    def letters() -> str:
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 9)))

    for k, f in enumerate(families):
        for t in TEMPLATES.get(f, OTHER if f == UNKNOWN else ()):
            rows += [(noisy(_tokens(t), 0.05 if f in TEMPLATES else 0.1), k) for _ in range(copies)] + [(_tokens(t), k)] * 4
        for name in NAMES.get(f, ()):
            rows += [(noisy(_tokens(frame.format(name)), 0.03), k) for frame in FRAMES for _ in range(2)]
    for _ in range(copies * 10):  # names that no family has
        name = " ".join(letters().title() for _ in range(rng.integers(1, 3)))
        version = str(rng.choice(["", " 1.0", " 2.0", " v3", " 4.0"]))
        frame = str(rng.choice([*FRAMES, "Licensed under the {} License, version 2", "Licensed under the {} Public License", "SPDX-License-Identifier: {}", "SPDX-License-Identifier: {}", "SPDX-License-Identifier: LicenseRef-{}"]))
        rows.append((noisy(_tokens(frame.format(name + version)), 0), families.index(UNKNOWN)))
    pool = sorted(held)
    for _ in range(copies * 12):  # words of the templates in no order are no licence
        some = rng.choice(pool, rng.integers(2, 12)).tolist()
        rows.append((noisy(some, 0), families.index(UNKNOWN if len(set(some) - COMMON) > 2 else NONE)))
        rows.append((rng.choice(filler, rng.integers(1, 30)).tolist() + ([str(rng.choice(pool))] if rng.random() < 0.7 else []), families.index(NONE)))
    rng.shuffle(rows)
    anchored = lambda g: any(w not in COMMON and w in held for w in g.split())
    seen = Counter(g for t, _ in rows[::2] for g in _grams(t) if anchored(g))
    terms = {g: k for k, g in enumerate(sorted(g for g, n in seen.items() if n >= 3))}
    x = np.zeros((len(rows), len(terms)), np.float32)
    for k, (t, _) in enumerate(rows):
        x[k, [terms[g] for g in _grams(t) if g in terms]] = 1
    y = np.eye(len(families), dtype=np.float32)[[k for _, k in rows]]
    w, b = np.zeros((len(terms), len(families)), np.float32), np.zeros(len(families), np.float32)
    fit, check = x[::2], x[1::2]
    for step in range(150):
        z = fit @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - y[::2]) / len(fit)
        rate = 8.0 / (1 + step / 60)
        w -= rate * (fit.T @ d)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * 2e-5, 0)  # keeps it sparse
        b -= rate * d.sum(axis=0)
    z = check @ w + b

    def loss(t: float) -> float:
        s = z / t - np.log(np.exp(z / t - (z / t).max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) - (z / t).max(axis=1, keepdims=True)
        return -float((s * y[1::2]).sum())

    temperature = min((0.3, 0.5, 0.7, 1.0, 1.5, 2.0, 3.0), key=loss)
    some = np.abs(w).max(axis=1) > 0
    kept = {g: n for n, g in enumerate(g for g, k in terms.items() if some[k])}
    anchors = frozenset(a for g in kept for a in g.split() if a not in COMMON and a in held) | {"mit"}
    return Model(families, kept, w[some].astype(np.float64), b.astype(np.float64), temperature, anchors)


_MARK = re.compile(r"^\s*(?://+|/\*+|\*+/?|#+|--+|;+|%+|<!--|rem\b)?\s*|\s*(?:\*+/|-->)?\s*$", re.I)
_TAG = re.compile(r"[\w-]+:(\s|$)")
#: A line of so many characters may be one that was wrapped.
FULL = 40


def paragraphs(lines: list[tuple[int, str]]) -> list[list[int]]:
    """Places of the lines that run on into each other, without comment marks; ``lines`` has (number in the text, line).

    A line runs on if it ends no sentence, is no tag and is followed at once by one that begins with a small letter, or
    by any other if it is long enough to have been wrapped.
    """
    out: list[list[int]] = []
    before, number = "", -2
    for k, (n, line) in enumerate(lines):
        bare = _MARK.sub("", line)
        on = n == number + 1 and bare and before and before[-1] not in ".!?:" and not _TAG.match(bare) and not _TAG.match(before) and (bare[0].islower() or len(before) >= FULL)
        if on:
            out[-1].append(k)
        else:
            out.append([k])
        before, number = bare, n
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its paragraphs, and what licences they state.

    doc_id; n_paragraphs; licence (of the surest confirmed paragraph, of one that reserves all rights only if
    no other is confirmed, else null) with its probability;
    families (all confirmed ones, sorted); n_confirmed, n_unconfirmed and n_unknown count paragraphs.
    Null and empty texts have no paragraph. Each paragraph of the whole text is classified; one without any word that
    the model knows is none, as its score is then the bias alone. Repeated rows give repeated results.
    A paragraph is a line that a template confirms alone, lines that hold a template when joined, or what is left of
    lines that run on into each other; so a wrapped notice is one, whether a template words it or not. Null ids are
    carried; other columns are not read; an empty table gives no rows; texts are looked at whole, however long.
    """
    model = train()

    def look(text: str) -> tuple:
        numbered = [(k, x) for k, x in enumerate(text.split("\n")) if x and not x.isspace()]
        at, lines = [k for k, _ in numbered], [_tokens(x) for _, x in numbered]
        sure, licence, families = 0.0, None, set()
        if all(map(model.anchors.isdisjoint, lines)):
            return len(paragraphs(numbered)), None, None, [], 0, 0, 0
        judged = [model.judge(line) for line in lines]
        wrapped: list[tuple[int, int, str, float]] = []
        last: dict[str, int] = {}
        for a, b, words in sorted(notices(lines, at)):
            family, p, ok = model.judge(words)
            if ok and a > last.get(family, -1):
                wrapped.append((a, b, family, p))
                last[family] = b
        inside = {}
        for a, b, family, _ in wrapped:
            for k in range(a, b + 1):
                inside.setdefault(k, set()).add(family)
        found = [(f, p) for _, _, f, p in wrapped] + [(f, p) for k, (f, p, ok) in enumerate(judged) if ok and f not in inside.get(k, ())]
        rest = [k for k in range(len(lines)) if k not in inside and not judged[k][2]]
        left = [[rest[j] for j in p] for p in paragraphs([numbered[k] for k in rest])]
        kinds_left = [model.judge([w for k in p for w in lines[k]])[0] if len(p) > 1 else judged[p[0]][0] for p in left]
        unknown = kinds_left.count(UNKNOWN)
        un = len(kinds_left) - unknown - kinds_left.count(NONE)
        n = len(found) + len(left)
        for family, p in found:
            families.add(family)
            better = (licence == RESERVED) - (family == RESERVED) or p - sure
            if licence is None or better > 0 or (better == 0 and family < licence):
                sure, licence = p, family
        return n, licence, sure if licence else None, sorted(families), len(found), un, unknown

    kinds = [pa.int64(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.int64()]
    names = ["n_paragraphs", "licence", "probability", "families", "n_confirmed", "n_unconfirmed", "n_unknown"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [look(t.as_py().decode("utf-8", "replace")) for t in b.column(1)]
            cols = zip(*found) if found else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), t) for c, t in zip(cols, kinds))], names=["doc_id", *names])

    schema = "doc_id long, n_paragraphs long, licence string, probability double, families array<string>, n_confirmed long, n_unconfirmed long, n_unknown long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t")).mapInArrow(run, schema)
