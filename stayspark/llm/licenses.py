"""License scans by patience alignment.

Words of a template and of a text region that occur once on either side are anchors; the longest increasing subsequence of the
anchors is kept, and the gaps between kept anchors are aligned in the same way. A gap without anchors gives the words that
it begins and ends with on both sides. Coverage is the share of the template's words that are aligned.

Regions: words foreign to a template are left out, since nothing aligns with them; a text is cut only where more of them stand
in a row than twice the template's length (GAP at least). So an insertion of any shorter length leaves a copy whole. Within a region, windows of the template's length are aligned wherever their words could reach the least
coverage, so that copies side by side are told apart; each such finding is then aligned again with all words up to its
neighbours. What is left between them is aligned as a whole, or in overlapping windows if it is long. A text that lacks the words for the least coverage of
a template is not aligned with it at all: that can't change a result.

Defined results: null, empty and blank texts give no row; every finding is a row, so repeated licenses and repeated rows give
as many; findings of one template don't overlap, ties go to the earlier one; of templates that overlap only the one
with more aligned words (then the larger coverage) counts, and all that tie in both; an empty table gives no row; other columns are ignored; whole texts are scanned.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stayspark.llm.common import ChunkValues, arrow_rows, cached, slices, table, texts, with_bytes

# Public notices of well-known licenses, as they stand at the head of files.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-line": "Released under the MIT License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "all-rights-reserved": "All rights reserved.",
}
COVERAGE = 0.7
GAP = 12
WORD = re.compile(rb"[a-z0-9]+")
A_CHUNK = 6
FINDINGS = "doc_id long, license string, coverage double, aligned int, words int, start int, end int"
_FINDINGS = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("aligned", pa.int32()), ("words", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (in order of the first) whose seconds increase, by patience piles."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            at.append(k)
        else:
            tops[pile], at[pile] = b, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of places of equal words, increasing on both sides, by patience alignment."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, k, k_end = todo.pop()
        while i < i_end and k < k_end and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < i_end and k < k_end and a[i_end - 1] == b[k_end - 1]:
            i_end, k_end = i_end - 1, k_end - 1
            out.append((i_end, k_end))
        if i >= i_end or k >= k_end:
            continue
        once_a, once_b = Counter(a[i:i_end]), Counter(b[k:k_end])
        where = {w: x for x, w in enumerate(b[k:k_end], k) if once_b[w] == 1}
        anchors = rising([(x, where[w]) for x, w in enumerate(a[i:i_end], i) if once_a[w] == 1 and w in where])
        if anchors:
            out += anchors
            edges = [(i - 1, k - 1), *anchors, (i_end, k_end)]
            todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False) if r > p + 1 and s > q + 1]
    return sorted(out)


@lru_cache(4)
def prepared(templates: tuple[tuple[str, str], ...]) -> tuple[dict[bytes, int], list[tuple[str, list[int]]], np.ndarray]:
    """Ids of the templates' words, each template's ids, and the share of each template that each word makes up."""
    ids: dict[bytes, int] = {}
    own = [(name, [ids.setdefault(w, len(ids)) for w in WORD.findall(text.lower().encode())]) for name, text in templates]
    share = np.zeros((len(own), len(ids)))
    for t, (_, words) in enumerate(own):
        for w in words:
            share[t, w] += 1 / len(words)
    return ids, own, share


def regions(places: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of template words, cut where more foreign words than a template of this size may hold stand between two."""
    return np.split(places, np.flatnonzero(np.diff(places) > max(GAP, 2 * size)) + 1)


def tight(w: list[int], template: list[int], needed: int) -> list[tuple[int, int, int]]:
    """(aligned, first, last + 1) of windows of the template's length that hold a copy; they may overlap."""
    want, have, bound, end = Counter(template), Counter(), 0, 0
    out, skip = [], 0
    for k in range(len(w) - needed + 1):
        while end < min(k + len(template), len(w)):
            have[w[end]] += 1
            bound += have[w[end]] <= want[w[end]]
            end += 1
        if k >= skip and bound >= needed and want[w[k]]:
            pairs = align(w[k:end], template)
            if len(pairs) >= needed:
                out.append((len(pairs), k + pairs[0][0], k + pairs[-1][0] + 1))
                if len(pairs) == len(template):
                    skip = end  # a whole copy without other words: nothing in it can do better
        bound -= have[w[k]] <= want[w[k]]
        have[w[k]] -= 1
    return out


def apart(hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Hits that don't overlap, in order of their places; of overlapping ones the one with more aligned words, then the earlier."""
    taken: list[tuple[int, int, int]] = []
    for n, a, b in sorted(hits, key=lambda h: (-h[0], h[1], h[2])):
        if all(b <= x or a >= y for _, x, y in taken):
            taken.append((n, a, b))
    return sorted(taken, key=lambda h: h[1])


def copies(w: list[int], template: list[int], needed: int) -> list[tuple[int, int, int]]:
    """(aligned, first, last + 1) of every copy of a template in the words of a region."""
    size, own = len(template), set(template)
    found = apart(tight(w, template, needed))
    for k, (n, a, b) in enumerate(found):
        low = max(found[k - 1][2] if k else 0, a - size)
        high = min(found[k + 1][1] if k + 1 < len(found) else len(w), b + size)
        pairs = align(w[low:high], template)
        if len(pairs) > n:
            found[k] = len(pairs), low + pairs[0][0], low + pairs[-1][0] + 1
    edges = [0, *chain.from_iterable((a, b) for _, a, b in found), len(w)]
    todo = list(zip(edges[::2], edges[1::2], strict=True))
    while todo:
        low, high = todo.pop()
        if high - low <= 2 * size:
            parts = [(low, high)]
        else:
            parts = [(k, min(high, k + 2 * size)) for k in range(low, high - size // 2, max(1, size // 2))]
        hits = []
        for a, b in parts:
            if sum(x in own for x in w[a:b]) >= needed:
                pairs = align(w[a:b], template)
                if len(pairs) >= needed:
                    hits.append((len(pairs), a + pairs[0][0], a + pairs[-1][0] + 1))
        if hits := apart(hits):
            found += hits
            edges = [low, *chain.from_iterable((a, b) for _, a, b in hits), high]
            todo += zip(edges[::2], edges[1::2], strict=True)
    return found


def scan(text: bytes, templates: tuple[tuple[str, str], ...], coverage: float) -> list[tuple]:
    """(license, coverage, aligned, words, start, end) of every finding in a text; start and end are byte offsets."""
    ids, own, share = prepared(templates)
    found = [(m.start(), m.end(), ids.get(m[0], -1)) for m in WORD.finditer(text.lower())]
    words = np.array([w for _, _, w in found], np.int64)
    present = np.zeros(share.shape[1])
    present[words[words >= 0]] = 1
    out = []
    for t in np.flatnonzero(share @ present >= coverage - 1e-9):
        name, template = own[t]
        needed = int(np.ceil(coverage * len(template) - 1e-9))
        for at in regions(np.flatnonzero((words >= 0) & (share[t][words] > 0)), len(template)):
            if len(at) >= needed:
                out += [(name, n / len(template), n, len(template), int(at[x]), int(at[y - 1]) + 1) for n, x, y in copies(words[at].tolist(), template, needed)]
    best = [f for f in out if not any((g[2], g[1]) > (f[2], f[1]) and g[4] < f[5] and f[4] < g[5] for g in out)]
    return [(name, round(c, 4), n, size, found[a][0], found[b - 1][1]) for name, c, n, size, a, b in sorted(best, key=lambda f: (f[4], f[5], f[0]))]


def findings(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, aligned, words, start, end) of every license text found."""
    fixed = tuple((templates or TEMPLATES).items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, _, share = prepared(fixed)
        n = share.shape[1]

        def learn(chunks: list[bytes]) -> np.ndarray:
            """Up to A_CHUNK template words in each chunk, and n for none; n + 1 marks a chunk with more."""
            out = np.full((len(chunks), A_CHUNK), n, np.int16)
            for k, c in enumerate(chunks):
                words = [ids[w] for w in WORD.findall(c) if w in ids]
                out[k, : len(words[:A_CHUNK])] = words[:A_CHUNK]
                if len(words) > A_CHUNK:
                    out[k, -1] = n + 1
            return out

        cache = cached("licenses", fixed, lambda: ChunkValues(learn, A_CHUNK, np.int16))
        for whole in batches:
            for batch in slices(whole):
                rows, own = [], texts(batch)
                split = [t.lower().split() for t in own]
                values = cache.lookup(list(chain.from_iterable(split)))
                ends = np.cumsum([len(x) for x in split])
                for doc, text, i, end in zip(batch.column("doc_id").to_pylist(), own, [0, *ends[:-1]], ends, strict=True):
                    present = np.zeros(n + 2)
                    present[values[i:end]] = 1
                    if present[n + 1] or (share @ present[:n]).max() >= coverage - 1e-9:
                        rows += [(doc, *f) for f in scan(text, fixed, coverage)]
                if rows:
                    yield arrow_rows(_FINDINGS, **dict(zip(_FINDINGS.names, zip(*rows, strict=True), strict=True)))

    return with_bytes(docs).mapInArrow(run, FINDINGS)


def op5_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(table(spark, sf_dir, "documents"))
