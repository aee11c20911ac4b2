"""License notices by patience alignment of words with templates.

Words that occur once in a stretch and once in a template are anchors; the longest
increasing subsequence of their places is kept, and the gaps between anchors are
aligned in the same way. The share of template words in the alignment is the
coverage. A stretch runs from a template's length before to twice its length after
a place where a sign word of the template stands, so texts are read whole. A template
has one sign word more than words may be missing, so one stands in every notice.
Stretches of just the template's length are tried too, so that notices that follow
each other are told apart.

A wording of few words must also have its license's own word (``OWN``), and that of a
variant the variant's (``VARIANT``), or other licenses would fit it. Of alignments over the same words only the fullest is kept: a notice of
the lesser license holds every word of the general one.

Null texts count as empty. One row for every document: its best notice (most
coverage, ties to the first listed), coverage and code-point span, or nulls below
``least``; and ``notices``, every alignment at or above ``least``, by place.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from pathkin.llm.base import ship, table, whole_text

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    " associated documentation files (the \"Software\"), to deal in the Software without restriction"
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"
    " is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met"
)
_BSD_2 = (
    " Redistributions of source code must retain the above copyright notice, this list of conditions and the"
    " following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission."
)


def _gnu(kind: str, version: str) -> list[str]:
    return [
        f"This work is licensed under the GNU {kind} License, version {version}",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        f" {kind} License as published by the Free Software Foundation, either version {version} of the License,"
        " or (at your option) any later version",
    ]


def _creative(kind: str, short: str) -> list[str]:
    return [
        f"Licensed under CC {short} 4.0",
        f"This work is licensed under a Creative Commons {kind} 4.0 International License",
    ]


# fixed values: wordings of public license notices
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ],
    "GPL-3.0": _gnu("General Public", "3"),
    "MIT": ["Released under the MIT License"],
    "CC-BY-NC-4.0": _creative("Attribution-NonCommercial", "BY-NC"),
    "CC-BY-4.0": _creative("Attribution", "BY"),
    "MIT-text": [
        _MIT,
        _MIT + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject"
        " to the following conditions: The above copyright notice and this permission notice shall be included in all"
        " copies or substantial portions of the Software.",
    ],
    "BSD": ["Released under the BSD License", _BSD],
    "BSD-2-Clause": [_BSD + _BSD_2],
    "BSD-3-Clause": [_BSD + _BSD_2 + _BSD_3],
    "ISC": ["Released under the ISC License", _ISC],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, Version 2.0",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1"],
    "GPL-2.0": _gnu("General Public", "2"),
    "LGPL-3.0": _gnu("Lesser General Public", "3"),
    "LGPL-2.1": _gnu("Lesser General Public", "2.1"),
    "AGPL-3.0": _gnu("Affero General Public", "3"),
    "CC-BY-SA-4.0": _creative("Attribution-ShareAlike", "BY-SA"),
    "CC-BY-ND-4.0": _creative("Attribution-NoDerivatives", "BY-ND"),
    "CC-BY-NC-SA-4.0": _creative("Attribution-NonCommercial-ShareAlike", "BY-NC-SA"),
    "CC-BY-NC-ND-4.0": _creative("Attribution-NonCommercial-NoDerivatives", "BY-NC-ND"),
}
# words that a license of a family has and the family's first has not
VARIANT = {
    "lesser", "affero", "attribution-noncommercial", "attribution-sharealike", "attribution-noderivatives",
    "attribution-noncommercial-sharealike", "attribution-noncommercial-noderivatives",
}
# wordings of fewer words than this must have their own word
SHORT = 10
OWN = {
    "apache", "mit", "bsd", "isc", "mozilla", "by", "by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd",
}
_WORD = re.compile(r"\w[\w.-]*\w|\w")


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence with both places increasing; ``pairs`` are ordered by the first."""
    tails: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        j = bisect_left(tails, y)
        back[i] = at[j - 1] if j else -1
        if j == len(tails):
            tails.append(y)
            at.append(i)
        else:
            tails[j], at[j] = y, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of equal words in both lists, by patience."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = increasing([(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in where])
        out += anchors
        if anchors:
            edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            work += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:])]
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str | list[str]], least: float = 0.8):
        self.least = least
        wordings = [(k, t) for k, ts in templates.items() for t in ([ts] if isinstance(ts, str) else ts)]
        self.names = [k for k, _ in wordings]
        self.words = [[w.lower() for w in _WORD.findall(t)] for _, t in wordings]
        spread = Counter(w for ws in self.words for w in set(ws))
        self.missing = [int((1 - least) * len(ws) + 1e-9) for ws in self.words]
        # more rare words of each template than may be missing from a notice
        self.signs = [
            sorted(set(ws), key=lambda w: (spread[w], -len(w), w))[: m + 1] for ws, m in zip(self.words, self.missing)
        ]
        self.own = [(VARIANT | OWN if len(ws) < SHORT else VARIANT) & set(ws) for ws in self.words]
        self.any_sign = {w for ws in self.signs for w in ws}
        self.any_word = {w for ws in self.words for w in ws}

    def alignment(self, words: list[str], k: int, at: int, low: int) -> list[tuple[int, int]]:
        """Best alignment of template ``k`` around a sign's place, not before ``low``; empty if below ``least``."""
        template = self.words[k]
        n = len(template)
        first, high = max(low, at - n), at + 2 * n
        there, wanted = Counter(words[first:high]), Counter(template)
        if sum((there & wanted).values()) < self.least * n - 1e-9:
            return []
        stretches = {(first, high)}
        for j in (j for j, w in enumerate(template) if w == words[at]):
            stretches |= {(max(low, at - j + d), at - j + d + n) for d in range(min(self.missing[k], j) + 1)}
        best: list[tuple[int, int]] = []
        for x, y in sorted(stretches):
            match = [(x + i, j) for i, j in aligned(words[x:y], template)]
            if not self.own[k] <= {template[j] for _, j in match}:
                continue
            rank = lambda m: (len(m), m[0][0] - m[-1][0]) if m else (0, 0)
            best = max(best, match, key=rank)
        return best if len(best) >= self.least * n - 1e-9 else []

    def notices(self, text: str) -> list[tuple]:
        """(license, coverage, start, end) of every notice, by place."""
        lowered = text.lower()
        if not any(sign in lowered for sign in self.any_sign):
            return []
        found = [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
        words = [f[0] for f in found]
        places: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.any_word:
                places.setdefault(w, []).append(i)
        made = []
        for k, template in enumerate(self.words):
            n, done = len(template), -1
            if not any(sign in places for sign in self.signs[k]):
                continue
            known = sorted(p for w in set(template) for p in places.get(w, []))
            for at in sorted(p for sign in self.signs[k] for p in places.get(sign, [])):
                low = max(done + 1, at - n)
                near = bisect_left(known, at + 2 * n) - bisect_left(known, low)
                if at <= done or near < self.least * n - 1e-9:
                    continue
                match = self.alignment(words, k, at, done + 1)
                if match:
                    made.append((k, match))
                    done = match[-1][0]
        return [
            (self.names[k], len(match) / len(self.words[k]), found[match[0][0]][1], found[match[-1][0]][2])
            for k, match in fullest(made)
        ]


def fullest(made: list[tuple[int, list]]) -> list[tuple[int, list]]:
    """Alignments whose words are not all in a fuller one, or an equal one listed before, by place."""
    made = sorted(made, key=lambda x: (x[1][0][0], -len(x[1]), -len(x[1]) / (x[1][-1][1] + 1), x[0]))
    starts = [m[0][0] for _, m in made]
    sets = [{i for i, _ in m} for _, m in made]
    longest = max((m[-1][0] - m[0][0] for _, m in made), default=0)
    out = []
    for i, (k, match) in enumerate(made):
        near = range(bisect_left(starts, match[0][0] - longest), bisect_right(starts, match[0][0]))
        if not any(sets[i] < sets[j] or (sets[i] == sets[j] and j < i) for j in near if j != i):
            out.append((k, match))
    return out


NOTICE = "struct<license:string,coverage:double,start:long,end:long>"


def scan(docs: DataFrame, templates: dict[str, str | list[str]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    ship(docs.sparkSession)

    def run(batches):
        scanner = Scanner(templates, least)
        listed = {k: i for i, k in enumerate(templates)}
        for batch in batches:
            rows = [scanner.notices(t) for t in batch["text"]]
            best = [min(r, key=lambda x: (-x[1], listed[x[0]], x[2]), default=(None,) * 4) for r in rows]
            out = pd.DataFrame(best, columns=["license", "coverage", "start", "end"])
            out["coverage"] = out["coverage"].astype(float)
            for c in ("start", "end"):
                out[c] = out[c].astype("Int64")
            out["notices"] = [[dict(zip(("license", "coverage", "start", "end"), x)) for x in r] for r in rows]
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").values)
            yield out

    return docs.select(docs["doc_id"].cast("long"), whole_text(docs).alias("text")).mapInPandas(
        run, f"doc_id long, license string, coverage double, start long, end long, notices array<{NOTICE}>"
    )


def op7_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
