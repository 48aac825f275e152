"""License scans by patience alignment.

For each license template: words that stand exactly once in the text's stretch and once in the template
are anchors; the longest increasing subsequence of their places keeps those in template order; between
neighbouring anchors the same is done again, down to gaps without common unique words, where equal words
at both ends still count. The matched words over the template's words are the coverage.

A text can hold a license anywhere and more than once. Stretches to align are found by the template's
words themselves: its places are projected from every occurrence of each of its rarest words, and an
alignment is tried there if enough of the template's words occur near by; a coverage of at least the
threshold makes a finding, and findings of one template never overlap. What is left is chained: places of rare
words follow one another with at most twice the template's length of foreign words in between, and the window
runs from the first to the last projected place, so insertions (page headers, line prefixes, translations)
may add up to any length. A license line is searched as a
template of its own, and findings inside a longer one of the same family are part of it.

Words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII. Null and empty texts
have no findings. Repeated rows are scanned each. Extra columns are ignored. An empty table gives an empty
table.
"""

from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ByteHasher, text_chunks, word_spans
from usagelens.llm.decontaminate import _LOWER, _WORD, words_of

COVERAGE = 0.8
REACH = 2  # foreign words between two neighbouring rare words, as a multiple of the template's

# Public license texts and notices.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        'included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND "
        "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        'or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "MIT line": "Released under the MIT License.",
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "BSD line": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "GPL line": "This program is free software; you can redistribute it under the terms of the GNU General Public License.",
    "CC-BY-SA-4.0 line": "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0 line": "Licensed under the Creative Commons Attribution 4.0 International License.",
}


def unique_places(words, low: int, high: int) -> dict:
    """Place of every word that stands exactly once in words[low:high]."""
    places: dict = {}
    for at in range(low, high):
        places[words[at]] = -1 if words[at] in places else at
    return {word: at for word, at in places.items() if at >= 0}


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (a, b), sorted by a, in which b rises, too: piles of patience sorting."""
    tops, at, back = [], [], []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        if pile == len(tops):
            tops.append(b)
            at.append(i)
        else:
            tops[pile], at[pile] = b, i
        back.append(at[pile - 1] if pile else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(text, template, low: int, high: int) -> list[tuple[int, int]]:
    """Matched (text place, template place) of text[low:high] and the template, both rising."""
    matched: list[tuple[int, int]] = []
    gaps = [(low, high, 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            matched.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            matched.append((b, d))
        if a == b or c == d:
            continue
        mine, theirs = unique_places(text, a, b), unique_places(template, c, d)
        anchors = rising(sorted((at, theirs[word]) for word, at in mine.items() if word in theirs))
        if not anchors:
            continue
        matched += anchors
        before = (a - 1, c - 1)
        for after in [*anchors, (b, d)]:
            if after[0] - before[0] > 1 and after[1] - before[1] > 1:
                gaps.append((before[0] + 1, after[0], before[1] + 1, after[1]))
            before = after
    return sorted(matched)


@dataclass
class Template:
    name: str
    words: np.ndarray  # hashes
    counts: Counter
    rare: list[tuple[int, int]]  # hash and place of the words to project from


def compile_templates(templates: dict[str, str] | None = None) -> list[Template]:
    """Templates as word hashes.

    To reach a coverage c, at most a share 1 - c of the template's words can be missing; so of its words
    that occur once, any selection of more than that number contains one that is present. These words are
    the ones that fewest templates share.
    """
    texts = templates or TEMPLATES
    split = {name: words_of(text) for name, text in texts.items()}
    spread = Counter(w for words in split.values() for w in set(words))
    out = []
    for name, words in split.items():
        flat = b" ".join(words)
        sizes = np.array([len(w) for w in words])
        end = np.cumsum(sizes + 1) - 1
        hasher = ByteHasher()
        hasher.load(np.frombuffer(flat, np.uint8))
        hashes = hasher.between(end - sizes, end)
        once = [i for i, w in enumerate(words) if words.count(w) == 1]
        once.sort(key=lambda i: (spread[words[i]], -len(words[i]), i))
        need = int(np.floor(len(words) * (1 - COVERAGE) + 1e-9)) + 1
        chosen = once[:need]
        if len(chosen) < need:  # every place of words that recur
            chosen += [i for i in range(len(words)) if i not in set(chosen)][: need - len(chosen)]
        out.append(Template(name, hashes, Counter(hashes.tolist()), [(int(hashes[i]), i) for i in chosen]))
    return out


def scan(words: list[int], templates: list[Template], coverage: float = COVERAGE):
    """Findings in one text: (name, coverage, first word, last word + 1), by place."""
    present: dict[int, list[int]] = {}
    wanted = {h for t in templates for h, _ in t.rare}
    for at, word in enumerate(words):
        if word in wanted:
            present.setdefault(word, []).append(at)
    found = []
    for template in templates:
        n = len(template.words)
        spots = sorted({at - place for h, place in template.rare for at in present.get(h, ())})
        # insertions move later words; projections from one occurrence lie close together
        slack = max(2, n // 5)
        groups: list[list[int]] = []
        for spot in spots:
            if groups and spot - groups[-1][-1] <= slack:
                groups[-1].append(spot)
            else:
                groups.append([spot])
        taken, mine = 0, []
        body = template.words.tolist()
        for group in groups:
            for start in _tries(group, n):
                low, high = max(taken, start - slack), min(len(words), start + n + slack)
                if high - low < coverage * n:
                    continue
                shared = sum((Counter(words[low:high]) & template.counts).values())
                if shared < coverage * n:
                    continue
                matched = align(words, body, low, high)
                if len(matched) >= coverage * n:
                    if len(matched) < n:  # a part of it may lie behind an insertion
                        wider = align(words, body, max(taken, low - REACH * n), min(len(words), high + REACH * n))
                        matched = wider if len(wider) >= len(matched) + max(1, n // 20) else matched
                    taken = matched[-1][0] + 1
                    mine.append((template.name, len(matched) / n, matched[0][0], taken))
        found += mine + _stretched(words, template, present, mine, coverage)
    found.sort(key=lambda f: (f[2], -f[3], f[0]))
    return _without_parts(found)


def _stretched(words: list[int], template: Template, present: dict, mine: list, coverage: float):
    """Findings of a template with long insertions, outside of those in ``mine``."""
    n, body = len(template.words), template.words.tolist()
    spots = sorted({(at, -place) for h, place in template.rare for at in present.get(h, ())})
    blocks: list[tuple[int, int, list[tuple[int, int]]]] = []  # bounds of the window, (place in text, place in template)
    edges = [0, *(x for f in sorted(mine, key=lambda f: f[2]) for x in f[2:]), len(words)]
    for low, high in zip(edges[::2], edges[1::2], strict=True):
        block: list[tuple[int, int]] = []
        for at, place in ((at, -back) for at, back in spots[bisect_left(spots, (low, -n)) : bisect_left(spots, (high, -n))]):
            if block and at - block[-1][0] > (REACH + 1) * n:
                blocks.append((low, high, block))
                block = []
            block.append((at, place))
        if block:
            blocks.append((low, high, block))
    # a block, or the findings of its halves if they had any
    found = []

    def window(low, high, block):
        return max(low, block[0][0] - (REACH + 1) * n), min(high, block[-1][0] + (REACH + 1) * n)

    def search(low, high, block) -> bool:
        if not block:
            return False
        low, high = window(low, high, block)
        if high - low < coverage * n or sum((Counter(words[low:high]) & template.counts).values()) < coverage * n:
            return False
        falls = [i for i in range(1, len(block)) if block[i][1] < block[i - 1][1] and block[i][0] > block[i - 1][0]]
        new = [i for i in falls if block[i - 1][1] - block[i][1] >= n / 2]  # another copy seems to begin
        if new and halves(low, high, block, new):
            return True
        chain = rising(block)
        # words of the template before and behind the chain, and insertions among them
        first = max(low, chain[0][0] - chain[0][1] * (REACH + 1))
        last = min(high, chain[-1][0] + (n - chain[-1][1]) * (REACH + 1))
        matched = align(words, body, first, last)
        if len(matched) < coverage * n:
            matched = align(words, body, low, high)
        if len(matched) >= coverage * n:
            a, b = matched[0][0], matched[-1][0] + 1
            found.append((template.name, len(matched) / n, a, b))
            search(low, a, [x for x in block if x[0] < a])
            search(b, high, [x for x in block if x[0] >= b])
            return True
        return bool(falls) and not new and halves(low, high, block, falls)

    def halves(low, high, block, cuts) -> bool:
        cut = min(cuts, key=lambda i: abs(2 * i - len(block)))
        seen = len(found)
        search(low, block[cut][0], block[:cut])
        end = max([low, *(f[3] for f in found[seen:])])
        search(end, high, [x for x in block[cut:] if x[0] >= end])
        return len(found) > seen

    for low, high, block in blocks:
        search(max([low, *(f[3] for f in found)]), high, block)
    return found


def _tries(group: list[int], n: int) -> list[int]:
    """Projected starts to align at: one, or several where a group stretches over many template lengths."""
    out = [group[0]]
    for spot in group[1:]:
        if spot - out[-1] >= max(1, n // 2):
            out.append(spot)
    return out


def _without_parts(found):
    """Lines inside a finding of their own family's full text are part of it; of equal places the best stays."""
    kept = []
    for name, share, first, last in found:
        family = name.removesuffix(" line")
        inside = any(f <= first and last <= e and m.removesuffix(" line") == family and (m, f, e) != (name, first, last) for m, _, f, e in found)
        better = any(f < last and first < e and (s, m) > (share, name) and min(e, last) - max(f, first) > 0.8 * (last - first) for m, s, f, e in found)
        if not inside and not better:
            kept.append((name, share, first, last))
    return kept


_NAMES = ["doc_id", "n_words", "licenses", "coverage", "first_word", "last_word"]


def _scanned(templates: list[Template], coverage: float):
    wanted = np.unique(np.array([h for t in templates for h, _ in t.rare], np.uint64))

    def run(batches):
        hasher = ByteHasher()
        for batch in batches:
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body")):
                n = last - first
                lower = _LOWER[buf]
                start, end, row = word_spans(lower, offsets, _WORD)
                hasher.load(lower)
                words = hasher.between(start, end)
                spot = np.minimum(np.searchsorted(wanted, words), len(wanted) - 1)
                hit = np.bincount(row[wanted[spot] == words], minlength=n) > 0
                counts = np.bincount(row, minlength=n)
                begin = np.cumsum(counts) - counts
                columns: list[list] = [[], [], [], []]
                for i in range(n):
                    found = scan(words[begin[i] : begin[i] + counts[i]].tolist(), templates, coverage) if hit[i] else []
                    for column, at in zip(columns, range(4), strict=True):
                        column.append([f[at] for f in found])
                kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64()]
                lists = [pa.array(c, pa.list_(k)) for c, k in zip(columns, kinds, strict=True)]
                cut = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays([cut.column("doc_id"), pa.array(counts, pa.int64()), *lists], _NAMES)

    return run


def license_findings(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, n_words and, per finding in text order: licenses, coverage, first_word, last_word (exclusive).

    One pass, no shuffle; every document gives a row.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_words bigint, licenses array<string>, coverage array<double>, first_word array<bigint>, last_word array<bigint>"
    rows = docs.select("doc_id", F.col("text").alias("_ul_body"))
    return rows.mapInArrow(_scanned(compile_templates(templates), coverage), schema)


def document_licenses(docs: DataFrame) -> DataFrame:
    """Digest of all documents: doc_id, n_found, licenses (names, sorted, distinct), coverage (best), n_license_words."""
    found = license_findings(docs)
    covered = F.aggregate(F.zip_with("first_word", "last_word", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct("licenses")), ",").alias("licenses"),
        F.round(F.coalesce(F.array_max("coverage"), F.lit(0.0)), 6).alias("coverage"),
        covered.alias("n_license_words"),
    )
