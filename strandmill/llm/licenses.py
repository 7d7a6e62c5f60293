"""License scans with a positional index of rare licence words.

The index holds, for each word of the licence templates, its postings (template, position) and its IDF over the
templates. Of a file only the rare licence words of the highest IDF are looked up: in each stretch of ``2 * STRETCH + 1`` words the
``RANK`` highest values. Each posting of such a word votes for the place where its template would begin; votes intersect
if their places lie within ``SLACK`` words, so inserted and deleted words don't part them. Places with enough votes are
verified: the template's mandatory key phrases must stand near their places, and the share of the template's
words that stand there in order (longest common subsequence) is the score.

The base phrases' places and labels are a plain scan of all words; the index gives the other labels and the score.

Defined results: a null or empty text has no words, empty labels and a score of 0; a very long text is scanned whole; repeated rows are files
of their own; other columns are ignored, whatever their names; an empty table gives no rows. Nothing is shuffled; memory is bounded by the
longest text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandmill.llm.textspans import RollingHash, chunks, owner, span_bounds, texts_of
from strandmill.session import ship_package

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Phrases that always give their label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Words that a template's places may be apart, as texts are edited.
SLACK = 8
#: Licence words in at most this share of the templates are rare: only they are ever looked up.
RARE_SHARE = 0.25
#: A rare word is looked up if fewer than RANK words within STRETCH words of it have a higher IDF.
STRETCH = 8
RANK = 6
#: The share of the words that a template would look up of itself that must agree on one place (two of them at least).
VOTES = 0.2
#: The least score that gives a label.
MIN_SCORE = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrases: tuple[str, ...]


AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
GNU_NOTICE = "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
BSD_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."

TEMPLATES = (
    Template("mit", MIT_GRANT + " " + AS_IS, ("permission is hereby granted free of charge", "without restriction")),
    Template("mit", MIT_GRANT, ("permission is hereby granted free of charge", "without restriction")),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Licensed under the MIT License", ("mit license",)),
    Template("mit", "SPDX-License-Identifier: MIT", ("license identifier mit",)),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", ("in compliance with the license", "apache org licenses")),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("in compliance with the license", "apache org licenses")),
    Template("apache", "SPDX-License-Identifier: Apache-2.0", ("license identifier apache",)),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    Template("gpl", GNU_NOTICE.format(what="program", name="General", version="3"), ("gnu general public license", "free software foundation")),
    Template("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license", "free software foundation")),
    Template("gpl", "SPDX-License-Identifier: GPL-3.0", ("license identifier gpl",)),
    Template("lgpl", GNU_NOTICE.format(what="library", name="Lesser General", version="2.1"), ("gnu lesser general public license",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("lgpl", "SPDX-License-Identifier: LGPL-3.0", ("license identifier lgpl",)),
    Template("agpl", GNU_NOTICE.format(what="program", name="Affero General", version="3"), ("gnu affero general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("gnu affero general public license",)),
    Template("agpl", "SPDX-License-Identifier: AGPL-3.0", ("license identifier agpl",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. " + BSD_DISCLAIMER, ("redistribution and use in source and binary forms", "with or without modification")),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "with or without modification")),
    Template("bsd", "Released under the BSD License", ("bsd license",)),
    Template("bsd", "Licensed under the BSD 3-Clause License", ("bsd 3 clause",)),
    Template("bsd", "SPDX-License-Identifier: BSD-3-Clause", ("license identifier bsd",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/", ("mozilla public license",)),
    Template("mpl", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("mpl", "SPDX-License-Identifier: MPL-2.0", ("license identifier mpl",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", ("with or without fee is hereby granted",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("isc", "SPDX-License-Identifier: ISC", ("license identifier isc",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution",)),
    Template("cc-by", "SPDX-License-Identifier: CC-BY-4.0", ("license identifier cc by",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", ("free and unencumbered software", "public domain")),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", ("provided as is", "in no event will the authors")),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software", ("provided as is", "in no event will the authors")),
)

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[48:58] = _WORD_BYTE[97:123] = _WORD_BYTE[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def words_of(text: str) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def word_hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends = span_bounds(_WORD_BYTE[data], np.array([0, len(data)]))
    return RollingHash(data).spans(starts, ends)


def in_order(mine: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    row = np.zeros(len(words) + 1, np.int64)
    for x in mine:
        step = np.where(words == x, row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], step))
    return int(row[-1])


class LicenseIndex:
    """Licence words' postings in CSR form, their IDF, templates and key phrases as word hashes."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        listed = [words_of(t.text) for t in templates]
        self.words = [word_hashes(w) for w in listed]
        frequency: dict[str, int] = {}
        for w in listed:
            for x in set(w):
                frequency[x] = frequency.get(x, 0) + 1
        known = sorted(frequency)
        hashes = word_hashes(known)
        order = np.argsort(hashes)
        self.known = hashes[order]
        self.idf = np.array([math.log(len(templates) / frequency[known[i]]) for i in order])
        self.rare = self.idf >= math.log(1 / RARE_SHARE)
        postings = [[(t, q) for t, w in enumerate(listed) for q, x in enumerate(w) if x == known[i]] for i in order]
        self.first = np.concatenate([[0], np.cumsum([len(p) for p in postings])])
        self.template = np.array([t for p in postings for t, _ in p])
        self.position = np.array([q for p in postings for _, q in p])
        self.size = np.array([len(w) for w in listed])
        own = np.array([len(self.looked_up(w, np.zeros(len(w), np.int64))[0]) for w in self.words])
        self.need = np.maximum(np.ceil(own * VOTES).astype(int), np.minimum(own, 2))
        self.phrases = []
        for t, w in zip(templates, listed, strict=True):
            found = []
            for phrase in t.key_phrases:
                p = words_of(phrase)
                at = next(i for i in range(len(w)) if w[i : i + len(p)] == p)
                found.append((at, word_hashes(p)))
            self.phrases.append(found)
        self.base = [(word_hashes(words_of(p)), label) for p, label in BASE]

    def looked_up(self, words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the licence words of the highest IDF around them, and which words they are."""
        slot = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        hit = np.flatnonzero((self.known[slot] == words) & self.rare[slot])
        value = self.idf[slot[hit]]
        higher = np.zeros(len(hit), np.int64)
        for k in range(1, min(STRETCH, max(len(hit) - 1, 0)) + 1):  # the k-th licence word before and after, if it is near
            near = (hit[k:] - hit[:-k] <= STRETCH) & (text[hit[k:]] == text[hit[:-k]])
            higher[k:] += near & (value[:-k] > value[k:])
            higher[:-k] += near & (value[k:] > value[:-k])
        chosen = higher < RANK
        return hit[chosen], slot[hit[chosen]]

    def places(self, words: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Rows (text, template, first and last word where it would begin) where enough looked-up words agree within SLACK words."""
        hit, slot = self.looked_up(words, text)
        if not len(hit):
            return np.zeros((0, 4), np.int64)
        low = self.first[slot]
        many = self.first[slot + 1] - low
        which = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        at = np.repeat(hit, many)
        template, begin, name = self.template[which], at - self.position[which], self.position[which]
        # Votes of one text and template lie together, further apart from others than SLACK.
        span = len(words) + 4096
        key = (text[at] * len(self.templates) + template) * span + (begin + 2048)
        order = np.argsort(key, kind="stable")
        key, template, begin, name, owners = key[order], template[order], begin[order], name[order], text[at][order]
        last = np.searchsorted(key, key + SLACK, side="right")
        enough = np.flatnonzero(last - np.arange(len(key)) >= self.need[template])
        # One word of a template votes once a place: a word that a text repeats isn't many.
        enough = [i for i in enough.tolist() if len(set(name[i : last[i]].tolist())) >= self.need[template[i]]]
        out: list[list[int]] = []
        for i in enough:
            t, c = int(owners[i]), int(template[i])
            if out and out[-1][:2] == [t, c] and begin[i] <= out[-1][3]:
                out[-1][3] = int(begin[last[i] - 1])
            else:
                out.append([t, c, int(begin[i]), int(begin[last[i] - 1])])
        return np.array(out, np.int64).reshape(-1, 4)

    def score(self, words: np.ndarray, template: int, begin: int, end: int | None = None) -> float:
        """The share of the template's words that stand in order where it begins from begin to end; 0 unless each key phrase stands near its place,
        with one word put in at most. words: of one text."""
        end = begin if end is None else end
        for at, phrase in self.phrases[template]:
            k = len(phrase)
            low, high = max(begin + at - SLACK, 0), min(end + at + SLACK + k + 1, len(words))
            starts = np.flatnonzero(words[low:high] == phrase[0]) + low
            if not any(in_order(phrase, words[x : min(x + k + 1, high)]) == k for x in starts.tolist()):
                return 0.0
        mine = self.words[template]
        here = words[max(begin - SLACK, 0) : end + len(mine) + SLACK]
        if np.isin(mine, here).sum() < MIN_SCORE * len(mine):
            return 0.0
        return in_order(mine, here) / len(mine)


@lru_cache(1)
def default_index() -> LicenseIndex:
    return LicenseIndex(TEMPLATES)


def _scan(index: LicenseIndex, data: np.ndarray, offsets: np.ndarray) -> dict:
    n = len(offsets) - 1
    data = _LOWER[data]
    starts, ends = span_bounds(_WORD_BYTE[data], offsets)
    text = owner(offsets, starts)
    words = RollingHash(data).spans(starts, ends)
    n_words = np.bincount(text, minlength=n)
    first_of = np.concatenate([[0], np.cumsum(n_words)])
    n_base = np.zeros(n, np.int64)
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    base: list[set[str]] = [set() for _ in range(n)]
    for phrase, label in index.base:
        k = len(phrase)
        at = np.flatnonzero(words[k - 1 :] == phrase[-1]) if len(words) >= k else np.zeros(0, np.int64)
        for j in range(k - 1):
            at = at[words[at + j] == phrase[j]]
        at = at[text[at] == text[at + k - 1]]
        owners = text[at]
        np.add.at(n_base, owners, 1)
        np.minimum.at(low, owners, at - first_of[owners])
        np.maximum.at(high, owners, at - first_of[owners])
        for i in np.unique(owners):
            base[i].add(label)
    labels = [set(x) for x in base]
    score = np.where(n_base > 0, 0.25, 0.0)
    for i, template, begin, end in index.places(words, text).tolist():
        s = index.score(words[first_of[i] : first_of[i + 1]], template, begin - int(first_of[i]), end - int(first_of[i]))
        if s >= MIN_SCORE:
            labels[i].add(index.templates[template].label)
            score[i] = max(score[i], s)
    return {
        "n_words": n_words, "n_base": n_base,
        "first_word": pa.array(np.where(n_base > 0, low, 0), mask=n_base == 0), "last_word": pa.array(np.where(n_base > 0, high, 0), mask=n_base == 0),
        "base_labels": [",".join(sorted(x)) for x in base], "labels": [",".join(sorted(x)) for x in labels], "score": score,
    }


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = default_index()
    for batch in batches:
        for low, high, data, offsets in chunks(texts_of(batch.column(1))):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(low, high - low).cast(pa.int64()), **_scan(index, data, offsets)})


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document the base phrases' places and labels, all labels, and the score of the best template found."""
    ship_package(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(_run, SCHEMA)
