"""Licence statements in paragraphs: a trained classifier, confirmed by templates."""

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stayline.llm import texts as X

# Families and public notices of each.
TEMPLATES = {
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Affero General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'
        " except in compliance with the License.",
        "Available under the Apache Licence 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        ' distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
        " following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED'
        " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
        " PARTICULAR PURPOSE ARE DISCLAIMED.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED'
        " TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "reserved": [
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without permission.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "zlib": [
        "Distributed under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be"
        " held liable for any damages arising from the use of this software.",
        "SPDX-License-Identifier: Zlib",
    ],
}
# Fixed value: licence statements of no family, for the unknown class.
UNKNOWN = [
    "Licensed under the Artistic License 2.0.",
    "You may use this file under the terms of the Common Development and Distribution License (CDDL), version 1.0.",
    "Licensed under the EUPL, Version 1.2 only.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "This work is licensed under the Microsoft Public License (Ms-PL).",
    "Licensed under the Server Side Public License, v 1.",
    "Use of this software is governed by the Business Source License included in the LICENSE file.",
    "Licensed under the Elastic License 2.0.",
    "This file is subject to the terms of the Academic Free License version 3.0.",
    "Distributed under the terms of the CeCILL-B license.",
    "Licensed under the Python Software Foundation License.",
    "The use of this data is subject to the Open Database License (ODbL) v1.0.",
    "Released under the Example Software License.",
    "Licensed under the terms of our own community licence, version 1.",
    "This work is licensed under the conditions of the publisher.",
    "You may use this file under the licence agreement that came with it.",
]
NONE, OTHER = "none", "unknown"
# What a statement of an unknown licence must name.
CUE = re.compile(rb"\blicen[cs]|\bcopy(?:right|left)|\bspdx|rights reserved|public domain", re.IGNORECASE)
WORD = re.compile(rb"[a-z0-9]+(?:[.+-][a-z0-9]+)*")

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("paragraph", pa.int64()), ("family", pa.string()),
    ("probability", pa.float64()), ("similarity", pa.float64()), ("text", pa.binary()),
])
COLUMNS = "doc_id long, paragraph long, family string, probability double, similarity double, text binary"


def plain(text):
    """Words of a paragraph in lower case, without marks around them."""
    return WORD.findall(text.lower())


def features(hashes, size):
    """Buckets of all words and pairs of neighbours; pairs belong to their second word."""
    pair = np.zeros(len(hashes), np.uint64)
    pair[1:] = X.mixed(hashes[:-1] * np.uint64(X.BASE) + hashes[1:])
    shift = np.uint64(64 - size)
    return (X.mixed(hashes) >> shift).astype(np.int64), (pair >> shift).astype(np.int64)


def vector(text, size):
    hashes = X.Words([text]).hashes(lower=True)
    out = np.zeros(1 << size)
    if len(hashes):
        # A word said again at once counts once, here and in `scan`.
        hashes = hashes[np.append(True, hashes[1:] != hashes[:-1])]
        word, pair = features(hashes, size)
        np.add.at(out, word, 1)
        np.add.at(out, pair[1:], 1)
        out /= np.sqrt(2 * len(hashes) - 1)
    return out


def varied(text, draw, copies):
    """Copies of a notice with words lost, words around it, or another case."""
    words = text.split()
    yield text
    for _ in range(copies):
        kept = [w for w in words if draw.random() > 0.08] or words
        before = draw.choice(["", "", "Note:", "(c) 2021 The authors.", "Copyright 2019."])
        out = f"{before} {' '.join(kept)}".strip()
        yield draw.choice([out, out, out.lower(), out.rstrip("."), out.upper()])


class Classifier:
    """Multinomial logistic regression on hashed words and word pairs.

    Fitted on varied templates, licence statements of no family, and paragraphs of the
    corpus. One example in five is held back; on these the temperature that makes the
    probabilities fit best is chosen.
    """

    def __init__(self, negatives, size=11, copies=12, rounds=150, decay=1e-4, seed=5):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.size, self.labels = size, [*sorted(TEMPLATES), OTHER, NONE]
        rows = [(t, f) for f in sorted(TEMPLATES) for one in TEMPLATES[f] for t in varied(one, draw, copies)]
        rows += [(t, OTHER) for one in UNKNOWN for t in varied(one, draw, copies)]
        rows = [(t.encode(), f) for t, f in rows] + [(t, NONE) for t in negatives]
        x = np.stack([vector(t, size) for t, _ in rows])
        y = np.array([self.labels.index(f) for _, f in rows])
        held = np.arange(len(rows)) % 5 == 4
        self.weights, self.bias = self._fit(x[~held], y[~held], rounds, decay)
        logits = x[held] @ self.weights + self.bias
        right = (np.arange(held.sum()), y[held])
        grid = np.exp(np.linspace(-1.5, 1.5, 31))
        self.heat = grid[int(np.argmin([-np.log(self._softmax(logits / g)[right] + 1e-12).sum() for g in grid]))]

    @staticmethod
    def _softmax(logits):
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def _fit(self, x, y, rounds, decay):
        """Full-batch Adam; every class weighs the same."""
        target = np.eye(len(self.labels))[y]
        weight = (1 / (np.maximum(target.sum(axis=0), 1)))[y][:, None] / len(self.labels)
        theta = np.zeros((x.shape[1] + 1, len(self.labels)))
        first, second = np.zeros_like(theta), np.zeros_like(theta)
        for i in range(1, rounds + 1):
            error = (self._softmax(x @ theta[:-1] + theta[-1]) - target) * weight
            slope = np.vstack([x.T @ error + decay * theta[:-1], error.sum(axis=0)])
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            theta -= 0.2 * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-9)
        return theta[:-1], theta[-1]

    def probabilities(self, sums, count):
        """Calibrated probabilities from the weight sums of paragraphs with `count` n-grams."""
        return self._softmax((sums / np.sqrt(np.maximum(count, 1))[:, None] + self.bias) / self.heat)


@cache
def template_pairs():
    """For each family, the word-pair sets of its templates."""
    return {f: [_pairs(plain(t.encode())) for t in notices] for f, notices in TEMPLATES.items()}


def _pairs(words):
    return frozenset(zip(words, words[1:])) or frozenset((w,) for w in words)


def similarity(text, family):
    """Largest share of a template's word pairs that the paragraph holds."""
    own = _pairs(plain(text))
    return max(len(own & t) / len(t) for t in template_pairs()[family])


def best_template(text):
    """The family whose template the paragraph holds best, and how well (ties: by name)."""
    return max(((similarity(text, f), f) for f in sorted(TEMPLATES)), key=lambda x: x[0])


def negatives(docs, bound, chars=2000):
    """At most `bound` paragraphs that hold no template, from different texts, first by hash.

    A share of the hashes that holds about four times as many texts is read, and of each text
    one line, cut to `chars` where it is read; so tasks send the driver little at any size.
    """
    known = docs.where("text is not null").select("text", F.xxhash64("text").alias("h"))
    share = min(1.0, 4 * bound / max(1, known.count()))
    some = known.where(F.col("h") <= min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))
    lines = some.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).where(
        "size(lines) > 0").select("h", F.substring(F.element_at(
            "lines", F.pmod(F.col("h"), F.size("lines")).cast("int") + 1), 1, chars).alias("t"))
    found = lines.groupBy("h").agg(F.min("t").alias("t")).orderBy("h").limit(bound).collect()
    return [t for t in (r["t"].encode() for r in found) if best_template(t)[0] < 0.3]


def paragraphs(words):
    """First word of each line with a word, its text, and its number among the text's lines."""
    line = np.cumsum(words.buffer == 0x0A)[words.starts]
    text = words.texts()
    new = np.ones(len(words), bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    begin = np.searchsorted(text[first], np.arange(len(words.bounds)))
    return first, text[first], np.arange(len(first)) - begin[text[first]]


@cache
def notice_index():
    """Numbers of the templates' words, of their pairs, and which pairs each template has."""
    notices = [(f, pairs) for f in sorted(TEMPLATES) for pairs in template_pairs()[f]]
    every = sorted(set().union(*[pairs for _, pairs in notices]))
    vocabulary = {w: i for i, w in enumerate(sorted({w for pair in every for w in pair}), 1)}
    table = np.full((len(vocabulary) + 1, len(vocabulary) + 1), -1)
    for i, (a, b) in enumerate(every):
        table[vocabulary[a], vocabulary[b]] = i
    return vocabulary, table, [(len(pairs), np.array([p in pairs for p in every])) for _, pairs in notices]


@cache
def known_words():
    """Vocabulary numbers of the plain words in each word this worker has met, by hash."""
    return {}


def plain_words(words, hashes, bound=500_000):
    """Vocabulary numbers (0: none) of all plain words, and the word that each belongs to."""
    vocabulary, known = notice_index()[0], known_words()
    if len(known) > bound:
        known.clear()
    keys, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    found = []
    for key, i in zip(keys.tolist(), first.tolist()):
        if key not in known:
            known[key] = tuple(vocabulary.get(w, 0) for w in plain(words.word(i)))
        found.append(known[key])
    size = np.array([len(t) for t in found])
    flat, begin = np.array([x for t in found for x in t], np.int64), (np.cumsum(size) - size)[place]
    n = size[place]
    word = np.repeat(np.arange(len(place)), n)
    return flat[begin[word] + np.arange(len(word)) - (np.cumsum(n) - n)[word]], word


def notices(words, hashes, block, confirm):
    """(first word, last word) of each place that holds the share `confirm` of a template's pairs.

    The pairs lie in one block within twice the template's length. Of places that overlap,
    the one with the largest share is taken (ties: the longer template, then the first).
    """
    _, table, templates = notice_index()
    plain_word, word = plain_words(words, hashes)
    pair = table[plain_word[:-1], plain_word[1:]]
    pair[block[word[:-1]] != block[word[1:]]] = -1
    at = np.flatnonzero(pair >= 0)
    pair, own = pair[at], block[word[at]]
    places = []
    for size, member in templates:
        some = np.flatnonzero(member[pair])
        hit, kind, part = at[some], pair[some], own[some]
        need, reach = int(np.ceil(confirm * size - 1e-9)), 2 * size
        n = len(hit) - need + 1
        if n < 1:
            continue
        near = (hit[need - 1:] - hit[:n] < reach) & (part[need - 1:] == part[:n])
        for i in np.flatnonzero(near).tolist():
            seen, last = set(), i
            for j in range(i, min(len(hit), i + reach)):
                if hit[j] - hit[i] >= reach or part[j] != part[i]:
                    break
                if kind[j] not in seen:
                    seen.add(kind[j])
                    last = j
            if len(seen) >= need:
                places.append((-len(seen) / size, -size, int(word[hit[i]]), int(word[hit[last] + 1])))
    taken, out = np.zeros(len(words), bool), []
    for _, _, a, b in sorted(places):
        if not taken[a:b + 1].any():
            taken[a:b + 1] = True
            out.append((a, b))
    return sorted(out)


def spread(first, end, width, step):
    """Ranges of at most `width` that cover each range [first, end), each `step` after the last."""
    more = np.maximum(-(-(end - first - width) // step), 0) + 1
    own = np.repeat(np.arange(len(first)), more)
    start = first[own] + step * (np.arange(len(own)) - (np.cumsum(more) - more)[own])
    return start, np.minimum(start + width, end[own])


def scan(docs, sample=1500, least=0.5, confirm=0.6, sure=0.9, hint=0.02, size=11, width=64):
    """Licence statements of all documents, one row for each place that has one.

    A paragraph is a line with a word; lines without a blank one between them are a block.
    A line of at most `width` words is judged whole. Blocks of several lines or with a longer
    line are judged in overlapping windows of `width` words too, and every place of a block,
    across lines, that holds the share `confirm` of a template's word pairs within twice the
    template's length is judged by itself; it is a statement if the classifier gives `none` at
    most 1 - `least`, and its family is the confirmed one with the largest probability. A window can be `unknown` only with a word pair
    of a template, as repeated junk has none. A statement over several lines replaces those
    of its lines; its row has the number of its first line and the text of all its words. The classifier is fitted on the templates and at
    most `sample` paragraphs of the corpus (a bound for fitting alone); it judges every
    paragraph of every text. A family counts if its calibrated probability reaches
    `least` and the paragraph holds at least the share `confirm` of the word pairs of
    one of the family's templates. A licence-like paragraph (probability of `none` below
    1 - `least`) without that confirmation goes to the likeliest family that a template does
    confirm, if that has at least the probability `hint`; else it is `unknown` if it names a
    licence (`CUE`) and `none` has at most the probability 1 - `sure`. So templates confirm what the classifier says, and
    decide nothing alone.

    Returns doc_id, paragraph (its number, from 0), family, probability (of the family,
    or of any licence for `unknown`), similarity and text. Null and empty texts have no paragraph; repeated
    rows give repeated results; a null id stays null; an empty table gives no rows;
    columns beside doc_id and text are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(Classifier(negatives(docs, sample), size))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def judge(line, row, own):
        best = int(np.argmax(row))
        family, p = own.labels[best], float(row[best])
        if family in TEMPLATES and p >= least:
            alike = similarity(line, family)
            if alike >= confirm:
                return family, p, alike
        held = {f: similarity(line, f) for f in sorted(TEMPLATES)}
        likely = [(float(row[own.labels.index(f)]), f) for f in held if held[f] >= confirm]
        if likely and max(likely)[0] >= hint:
            p, family = max(likely)
            return family, p, held[family]
        return OTHER, float(1 - row[-1]) if CUE.search(line) else 0.0, max(held.values())

    def named(line, own):
        row = own.probabilities((vector(line, own.size) @ own.weights)[None], np.ones(1))[0]
        if row[-1] > 1 - least:
            return None
        alike = {f: similarity(line, f) for f in sorted(TEMPLATES)}
        family = max((f for f in alike if alike[f] >= confirm), key=lambda f: row[own.labels.index(f)], default=None)
        return family and (family, float(row[own.labels.index(family)]), alike[family])

    def work(batches):
        own = model.value
        weights = own.weights.astype(np.float32)
        for batch in X.slices(batches, limit=1 << 19):
            words = X.Words(batch.column("text").to_pylist())
            if not len(words):
                continue
            first, text, number = paragraphs(words)
            hashes = words.hashes(lower=True)
            word, pair = features(hashes, own.size)
            inner = np.ones(len(words), bool)
            inner[first] = False
            again = inner & np.append(False, hashes[1:] == hashes[:-1])
            grams = weights[word]
            grams[inner] += weights[pair[inner]]
            grams[again] = 0
            end = np.append(first[1:], len(words))
            newline = np.cumsum(words.buffer == 0x0A)[words.starts]
            apart = np.append(True, (text[1:] != text[:-1]) | (np.diff(newline[first]) > 1))
            line_of = np.repeat(np.arange(len(first)), end - first)
            block = (np.cumsum(apart) - 1)[line_of]
            head = first[apart]
            tail = np.append(head[1:], len(words))
            wide = np.bincount(block[first]) > 1
            wide[block[first[end - first > width]]] = True
            more = spread(head[wide], tail[wide], width, width // 2)
            start, stop = np.append(first, more[0]), np.append(end, more[1])
            edges = np.stack([start, stop], axis=1).ravel()
            # An empty row at the end, so that the last range may end there.
            once = np.add.reduceat(np.append(~again, False), edges, dtype=np.int64)[::2]
            sums = np.add.reduceat(np.vstack([grams, np.zeros((1, grams.shape[1]), grams.dtype)]), edges, axis=0)[::2]
            # The first word of a window inside a line has no pair there.
            cut = inner[start] & ~again[start]
            sums[cut] -= weights[pair[start[cut]]]
            p = own.probabilities(sums, np.maximum(2 * once - 1, 1))
            ids, rows = batch.column("doc_id"), []

            def spell(a, b):
                return words.raw[words.starts[a]:words.ends[b]]

            # Place (first and last word) and verdict: lines, then places of templates, then windows.
            found = []
            for i in np.flatnonzero(p[:len(first), -1] < 1 - least).tolist():
                verdict = judge(spell(first[i], end[i] - 1), p[i], own)
                if verdict[0] != OTHER or verdict[1] >= sure:
                    found.append((int(first[i]), int(end[i]) - 1, verdict))
            lines = {int(line_of[a]): (a, b, v) for a, b, v in found}
            for a, b in notices(words, hashes, block, confirm):
                i, j = int(line_of[a]), int(line_of[b])
                inside = [lines[k] for k in range(i, j + 1) if k in lines and lines[k][2][0] != OTHER]
                if i == j and inside and end[i] - first[i] <= width:
                    continue
                verdict = named(spell(a, b), own)
                if not verdict or any(v[0] != verdict[0] and v[2] >= verdict[2] and y - x < width for x, y, v in inside):
                    continue
                for k in range(i, j + 1):
                    lines.pop(k, None)
                if i == j and end[i] - first[i] <= width:
                    a, b = int(first[i]), int(end[i]) - 1
                rows.append((a, b, verdict))
            rows += lines.values()
            used = np.zeros(len(words), bool)
            for a, b, _ in rows:
                used[a:b + 1] = True
            for i in (len(first) + np.flatnonzero(p[len(first):, -1] <= 1 - sure)).tolist():
                a, b = int(start[i]), int(stop[i]) - 1
                if not used[a:b + 1].any():
                    verdict = judge(spell(a, b), p[i], own)
                    if verdict[1] and verdict[2]:
                        used[a:b + 1] = True
                        rows.append((a, b, verdict))
            rows = [(ids[int(text[line_of[a]])].as_py(), int(number[line_of[a]]), *v, spell(a, b))
                    for a, b, v in sorted(rows)]
            if rows:
                yield X.batch_of(RESULT, **dict(zip(RESULT.names, zip(*rows))))

    return source.mapInArrow(work, COLUMNS)
