"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are lines with a word, long ones taken in overlapping windows. A logistic regression over sparse word n-grams tells licence families
from each other and from anything else. It is trained here, on the templates, on shortened and garbled
forms of them, and on paragraphs of the corpus and notices of other licences as examples of no family. A
second part of these, with other licences that are not learned from, sets the temperature of its
probabilities and the level below which a paragraph counts as unknown.
A prediction stands when the paragraph also shares enough words and word pairs with a template of the family, and
has all phrases that tell this template from the notices of other licences.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.batches import small_batches
from tidegrid.llm.sampling import hashed_sample
from tidegrid.llm.shingles import U, window_hashes, word_hashes
from tidegrid.llm.word_encoder import in_groups

#: Usual notices of each family.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
}
#: Phrases of plain small letters that a notice of the family has, one of these sets of them.
MARKS = {
    "Apache-2.0": [("apache license", "2.0"), ("without warranties or conditions of any kind", "distributed under the license")],
    "BSD-3-Clause": [("bsd 3 clause",), ("redistribution and use in source and binary forms",), ("bsd style license",)],
    "CC-BY-4.0": [("cc by 4.0",), ("creative commons attribution 4.0",)],
    "CC-BY-NC-4.0": [("cc by nc 4.0",), ("creative commons attribution noncommercial 4.0",)],
    "CC-BY-SA-4.0": [("cc by sa 4.0",), ("creative commons attribution sharealike 4.0",)],
    "GPL-2.0": [("gnu general public license", "version 2")],
    "GPL-3.0": [("gnu general public license", "version 3")],
    "LGPL-3.0": [("gnu lesser general public license", "version 3")],
    "MIT": [("mit license",), ("hereby granted free of charge", "deal in the software"),
            ("permission notice shall be included in all copies",)],
    "MPL-2.0": [("mozilla public license", "2.0")],
}
#: Notices of licences that are none of the families; every second one is only for setting the level.
FOREIGN = [
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "Released under the BSD 2-Clause License.",
    "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "Licensed under CC BY-NC-SA 4.0.",
    "Licensed under CC BY-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Licensed under the Apache License, Version 1.1.",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    "Licensed under CC BY 3.0.",
    "This work is licensed under the GNU General Public License, version 1.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "Released under the ISC License.",
    "Licensed under the Eclipse Public License, version 2.0.",
    "Released under the Boost Software License, version 1.0.",
]
#: Words of a long paragraph that are looked at together, and how far apart such windows begin.
WIDTH, STRIDE = 128, 64
_PLAIN = re.compile(r"[^\w.]+")


def plain(paragraph: str) -> str:
    """Words with their inner points only, so that punctuation and quotes make no difference."""
    return " ".join(w.strip(".") for w in _PLAIN.sub(" ", paragraph).split() if w.strip("."))


def windows(paragraph: str) -> list[str]:
    """A plain paragraph in overlapping parts of at most :data:`WIDTH` words; each notice is in one of them as a whole."""
    words = paragraph.split(" ")
    if len(words) <= WIDTH:
        return [paragraph]
    begins = [*range(0, len(words) - WIDTH, STRIDE), len(words) - WIDTH]
    return [" ".join(words[a:a + WIDTH]) for a in begins]


def marked(paragraph: str, family: str) -> bool:
    """Whether a plain paragraph has what tells a notice of the family from those of other licences."""
    text = f" {paragraph.lower()} "
    return any(all(f" {phrase} " in text for phrase in phrases) for phrases in MARKS[family])


def ngrams(paragraphs: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and word pairs, and the paragraph each belongs to."""
    data = [p.encode() for p in paragraphs]
    begin, word = word_hashes(b"\n".join([*data, b""]))
    words = np.diff(np.searchsorted(begin, np.cumsum([len(d) + 1 for d in data])), prepend=0)
    owner = np.repeat(np.arange(len(data)), words)
    pair = window_hashes(word, 2)
    inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    return (np.concatenate([word, pair[inside]]).astype(np.uint64),
            np.concatenate([owner, owner[1:][inside]]).astype(np.int64))


def once(owner: np.ndarray, at: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram of a paragraph once, so that common words of long paragraphs do not add up."""
    both = np.unique(owner * max(1, known) + at)
    return both // max(1, known), both % max(1, known)


@dataclass
class LicenceModel:
    """``known`` n-grams in order with a row of ``weights`` each; a column for each family and one for none."""

    families: list[str]
    known: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    level: float
    pairs: list[list[np.ndarray]]

    def __post_init__(self) -> None:
        # most words of a text are in no licence: a small table of low bits lets those through quickly
        self.mask = U((1 << 16) - 1)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.known & self.mask).astype(np.int64)] = True

    def logits(self, paragraphs: Sequence[str]) -> np.ndarray:
        gram, owner = ngrams(paragraphs)
        some = self.maybe[(gram & self.mask).astype(np.int64)]
        gram, owner = gram[some], owner[some]
        at = np.minimum(np.searchsorted(self.known, gram), max(0, len(self.known) - 1))
        hit = self.known[at] == gram if len(self.known) else np.zeros(0, bool)
        out = np.tile(self.bias, (len(paragraphs), 1))
        owner, at = once(owner[hit], at[hit], len(self.known))
        np.add.at(out, owner, self.weights[at])
        return out

    def probabilities(self, paragraphs: Sequence[str]) -> np.ndarray:
        x = self.logits(paragraphs) / self.temperature
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)

    def similarity(self, paragraph: str, family: int) -> float:
        """The largest share of a template's or the paragraph's word pairs that both have."""
        gram, _ = ngrams([paragraph])
        own = np.unique(gram)
        best = 0.0
        for t in self.pairs[family]:
            both = len(np.intersect1d(own, t, assume_unique=True))
            best = max(best, both / max(1, min(len(t), len(own))))
        return best


def _examples(rng: Random, copies: int, notices: Sequence[Sequence[str]], families: int) -> list[tuple[str, int]]:
    """Notices with the place of their list, and forms with words left out, a part cut off, or strange words around.

    Notices of other licences keep their words: one without "Affero" would be a notice of a family.
    """
    out = []
    for f, own_notices in enumerate(notices):
        for t in own_notices:
            words = plain(t).split()
            out.append((" ".join(words), f))
            for _ in range(copies):
                own = [w for w in words if rng.random() > 0.1 or f >= families]
                if rng.random() < 0.3 and len(own) > 8:
                    a = rng.randrange(len(own) // 3)
                    own = own[a:a + max(6, 2 * len(own) // 3)]
                around = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(rng.randrange(4))]
                out.append((" ".join(around + own), f))
    return out


def fit_licences(others: Sequence[str], *, copies: int = 20, steps: int = 200, rate: float = 0.5, decay: float = 1e-4,
                 false_share: float = 0.001, seed: int = 0) -> LicenceModel:
    """Learn from the templates, notices of other licences, and paragraphs that are taken for no licence."""
    rng = Random(seed)
    families = sorted(TEMPLATES)
    none = len(families)
    learned = _examples(rng, copies, [*(TEMPLATES[f] for f in families), FOREIGN[::2]], none)
    rows = [(t, y, True) for t, y in learned] + [(plain(p), none, False) for p in others]
    rng.shuffle(rows)
    text, label = [r[0] for r in rows], np.array([r[1] for r in rows])
    notice = np.array([r[2] for r in rows])
    gram, owner = ngrams(text)
    keep = np.unique(gram[notice[owner]])  # n-grams of licences; the rest says nothing about families
    at = np.minimum(np.searchsorted(keep, gram), len(keep) - 1)
    hit = keep[at] == gram
    owner, at = once(owner[hit], at[hit], len(keep))
    train = np.arange(len(rows)) % 5 != 0
    weights, bias = np.zeros((len(keep), none + 1)), np.zeros(none + 1)
    goal = np.eye(none + 1)[label]
    size = 1 / np.bincount(label[train], minlength=none + 1).clip(1)[label] * train / (none + 1)  # all classes weigh the same
    scale = np.bincount(at, minlength=len(keep)).clip(1) ** -0.5
    for _ in range(steps):
        x = np.tile(bias, (len(rows), 1))
        np.add.at(x, owner, weights[at])
        p = np.exp(x - x.max(axis=1, keepdims=True))
        miss = (goal - p / p.sum(axis=1, keepdims=True)) * size[:, None]
        step = np.zeros_like(weights)
        np.add.at(step, at, miss[owner])
        weights += rate * 20 * (step * scale[:, None] - decay * weights)
        bias += rate * miss.sum(axis=0)
    pairs = [[np.unique(ngrams([plain(t)])[0]) for t in TEMPLATES[f]] for f in families]
    model = LicenceModel(families, keep, weights, bias, 1.0, 0.5, pairs)
    held = np.flatnonzero(~train)
    raw = model.logits([text[i] for i in held])

    def loss(temperature: float) -> float:
        x = raw / temperature
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(held)), label[held]]).mean())

    model.temperature = min((0.1, 0.2, 0.35, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=loss)
    # the level is for what the phrases let through
    unknown = [text[i] for i in held if label[i] == none] + [t for t, _ in _examples(rng, copies, [FOREIGN[1::2]], 0)]
    p = model.probabilities(unknown)[:, :none]
    outside = p.max(axis=1) * [marked(t, families[f]) for t, f in zip(unknown, p.argmax(axis=1))]
    model.level = max(0.5, float(np.quantile(outside, 1 - false_share)) if len(outside) else 0.5)
    return model


def scan_licences(docs: DataFrame, *, max_others: int = 2000, min_similarity: float = 0.6, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Licence paragraphs of every document: ``n_paragraphs``, ``n_licensed``, ``families``, ``score`` and ``similarity``.

    ``families`` lists the families found, in order of name; ``score`` and ``similarity`` are those of the
    surest window of a paragraph, null without one. Paragraphs are lines with a word; of more than :data:`WIDTH`
    words each window is looked at. Families other than those of :data:`TEMPLATES` are not reported. The examples of no licence are the
    first lines of at most ``max_others`` documents, chosen by a hash; lines that say licence, copyright
    or permission are left out of them. A null text is empty. Rows are kept one by one, with equal or
    no ids too; other columns are ignored. An empty table gives no rows.
    """
    line = F.substring_index(F.col(text_col), "\n", 1)
    lines = docs.select(F.col(id_col).alias("id"), line.alias("line")).where(F.length("line") > 0).where(
        ~F.lower("line").rlike("licen|copyright|permission|redistribut|warrant"))
    others = sorted({r["line"] for r in hashed_sample(lines, ["id", "line"], max_others).collect()})
    model = docs.sparkSession.sparkContext.broadcast(fit_licences(others))
    names = [id_col, "n_paragraphs", "n_licensed", "families", "score", "similarity"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        none = len(m.families)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in in_groups(texts, 1_000_000):
                lines = [[x for x in t.split("\n") if x.strip()] for t in texts[a:b]]
                count = [len(x) for x in lines]
                flat = [x for own in lines for x in own]
                owner = np.repeat(np.arange(b - a), count)
                parts = [windows(plain(x)) for x in flat]
                clean = [x for own in parts for x in own]
                line_of = np.repeat(np.arange(len(flat)), [len(x) for x in parts])
                p = m.probabilities(clean)[:, :none] if clean else np.zeros((0, none))
                best = p.argmax(axis=1)
                found: list[list[tuple[str, float, float]]] = [[] for _ in range(b - a)]
                licensed: list[set[int]] = [set() for _ in range(b - a)]
                for i in np.flatnonzero(p.max(axis=1) >= m.level):
                    same = m.similarity(clean[i], int(best[i]))
                    if same >= min_similarity and marked(clean[i], m.families[best[i]]):
                        doc = owner[line_of[i]]
                        found[doc].append((m.families[best[i]], float(p[i, best[i]]), same))
                        licensed[doc].add(line_of[i])
                top = [max(f, key=lambda x: (x[1], x[2], x[0]), default=(None, None, None)) for f in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(count, pa.int64()), pa.array([len(x) for x in licensed], pa.int64()),
                    pa.array([sorted({x[0] for x in f}) for f in found], pa.list_(pa.string())),
                    pa.array([t[1] for t in top], pa.float64()), pa.array([t[2] for t in top], pa.float64())], names)

    id_type = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs).select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, n_paragraphs long, n_licensed long, families array<string>, score double, similarity double")
