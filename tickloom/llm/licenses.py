"""Licence notices in texts, by patience alignment with templates.

Words that occur once in a stretch of text and once in a template are anchors. The longest run of anchors in the same
order on both sides is kept, and the gaps between them are aligned in the same way, with words equal at a gap's ends
matched where it has no anchor. A template's coverage is the share of its words that are matched.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.llm.common import col

# The usual wordings of notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."),
}
COVERAGE, STRETCH = 0.8, 1.5
WORDS = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    counts: Counter

    @classmethod
    def of(cls, name: str, text: str) -> Template:
        found = tuple(w.lower() for w in WORDS.findall(text))
        return cls(name, found, Counter(found))


def rising(values: list[int]) -> list[int]:
    """The places of a longest rising subsequence, by patience sorting."""
    tops, ends, before = [], [], []
    for k, v in enumerate(values):
        pile = bisect_left(tops, v)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            ends.append(k)
        else:
            tops[pile], ends[pile] = v, k
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def align(text: list[str], template: tuple[str, ...] | list[str]) -> list[tuple[int, int]]:
    """Matched words as pairs of places in text and template, rising on both sides."""
    out, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        if a >= b or c >= d:
            continue
        ours, theirs = Counter(text[a:b]), Counter(template[c:d])
        at = {w: k for k, w in enumerate(text[a:b], a) if ours[w] == 1 and theirs.get(w) == 1}
        anchors = [(at[w], k) for k, w in enumerate(template[c:d], c) if w in at]
        if anchors:
            kept = [anchors[i] for i in rising([p for p, _ in anchors])]
            out += kept
            edges = [(a - 1, c - 1), *kept, (b, d)]
            gaps += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:])]
            continue
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
    return sorted(out)


def scan_words(found: list[str], template: Template, coverage: float, stretch: float) -> list[tuple[int, int, float]]:
    """Stretches of a list of words that cover a template: first word, end, share of the template matched.

    A stretch begins at one of the template's words and is up to ``stretch`` times as long as the template. It is
    aligned if it holds enough of the template's words for the coverage at all. Of overlapping stretches the one that covers
    more counts, and of equals the first.
    """
    size, out, at = len(template.words), [], 0
    need, width = math.ceil(coverage * size), math.ceil(stretch * size)
    hits = [k for k, w in enumerate(found) if w in template.counts]
    for i, start in enumerate(hits):
        if start < at:
            continue
        end = start + width
        held = 0
        for k in hits[i : i + width]:
            if k >= end:
                break
            held += 1
        if held < need:
            continue
        window = found[start:end]
        shared = Counter(window) & template.counts
        if sum(shared.values()) < need:
            continue
        pairs = align(window, template.words)
        share = len(pairs) / size
        if len(pairs) < need:
            continue
        first, last = start + pairs[0][0], start + pairs[-1][0] + 1
        if out and first < out[-1][1]:
            if share > out[-1][2]:
                out[-1] = (first, last, share)
        else:
            out.append((first, last, share))
        at = start + 1 if share < 1 else last
    return out


def scan(text: str | None, templates: list[Template], coverage: float, stretch: float) -> list[dict]:
    """The notices of a whole text, by where they start.

    Of notices that overlap, the one with the most words matched is told, of equals the one that covers more of its
    template, then the first by name: wordings that differ in a word or hold one another are found as what they are.
    """
    if not text:
        return []
    known = set(WORDS.findall(text.lower()))
    out, marks, found = [], None, None
    for t in templates:
        shared = sum(1 for w in t.counts if w in known)
        # words that repeat in the template may match more than once
        if shared + len(t.words) - len(t.counts) < math.ceil(coverage * len(t.words)) or not shared:
            continue
        if marks is None:
            marks = [(m.start(), m.end()) for m in WORDS.finditer(text)]
            found = [text[a:b].lower() for a, b in marks]
        out += [(-round(share * len(t.words)), -share, t.name, a, b) for a, b, share in scan_words(found, t, coverage, stretch)]
    kept: list[tuple] = []
    for x in sorted(out):
        if all(x[4] <= k[3] or k[4] <= x[3] for k in kept):
            kept.append(x)
    return sorted(
        ({"license": name, "start": marks[a][0], "end": marks[b - 1][1], "coverage": round(-share, 6)}
         for _, share, name, a, b in kept),
        key=lambda x: x["start"])


def with_licenses(
    docs: DataFrame, into: str = "licenses", templates: dict[str, str] | None = None, coverage: float = COVERAGE,
    stretch: float = STRETCH, text_col: str = "text",
) -> DataFrame:
    """``docs`` with an array ``into`` of license, start, end (code points, end exclusive) and coverage.

    Whole texts are scanned, however long, without a shuffle. A notice is found if at least ``coverage`` of its words
    stand in order in a stretch of ``stretch`` times its length; a text may have many. Letters' case and signs don't
    count. A null or empty text has none; repeated rows each get theirs; an empty table stays empty.
    Other columns stay; ``into`` must not be one of them. A template without words is never found.
    """
    known = [t for name, text in sorted((templates or TEMPLATES).items()) if (t := Template.of(name, text)).words]
    kind = T.ArrayType(
        T.StructType().add("license", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType())
        .add("coverage", T.DoubleType()))

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([scan(t, known, coverage, stretch) for t in texts])

    return docs.withColumn(into, F.pandas_udf(run, kind)(F.coalesce(col(docs, text_col), F.lit(""))))
