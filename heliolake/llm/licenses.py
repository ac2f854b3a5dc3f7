"""License scans: Dice coefficient over word bigrams against licence templates."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame

#: Short notices and texts by which public licences are stated, by SPDX name.
_STATED: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                   "use this file except in compliance with the License. You may obtain a copy of "
                   "the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
            "and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("Apache-1.1", "Licensed under the Apache Software License, Version 1.1."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("BSD", "Released under the BSD License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met:"),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("MPL-1.1", "Licensed under the Mozilla Public License, Version 1.1."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
                "2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
                "at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related "
                "or neighboring rights to this work."),
    ("All-Rights-Reserved", "All rights reserved."),
)
#: Kinds and versions of families of licences that are stated in one form.
_GNU = (("GPL", "General", ("1.0", "2.0", "3.0")), ("LGPL", "Library General", ("2.0",)),
        ("LGPL", "Lesser General", ("2.1", "3.0")), ("AGPL", "Affero General", ("1.0", "3.0")))
_COMMONS = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
_COMMONS_VERSIONS = (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"),
                     ("2.0", "Generic"), ("1.0", "Generic"))
#: What licences are called. A template that holds one of these is matched by no
#: window without it.
NAMES = ("apache license", "apache software license", "mit license", "isc license", "bsd license",
         "bsd 2 clause", "bsd 3 clause", "mozilla public license", "gnu general public license",
         "gnu library general public license", "gnu lesser general public license",
         "gnu affero general public license", "cc by", "cc by sa", "cc by nc", "cc by nd",
         "cc by nc sa", "cc by nc nd", "creative commons attribution",
         "attribution sharealike", "attribution noncommercial", "attribution noderivatives",
         "attribution noncommercial sharealike", "attribution noncommercial noderivatives",
         "all rights reserved")


def _families() -> Iterator[tuple[str, str]]:
    for name, kind, versions in _GNU:
        for v in versions:
            for opening in ("This work is licensed", "Licensed"):
                yield (f"{name}-{v}", f"{opening} under the GNU {kind} Public License, version {v}.")
            yield (f"{name}-{v}",
                   "This program is free software: you can redistribute it and/or modify it under "
                   f"the terms of the GNU {kind} Public License as published by the Free Software "
                   f"Foundation, either version {v} of the License, or (at your option) any later "
                   "version.")
    for short, long in _COMMONS:
        for v, region in _COMMONS_VERSIONS:
            yield f"CC-{short}-{v}", f"Licensed under CC {short} {v}."
            yield (f"CC-{short}-{v}", "This work is licensed under a Creative Commons "
                                      f"{long} {v} {region} License.")


TEMPLATES: tuple[tuple[str, str], ...] = (*_STATED, *_families())

#: Words: runs of letters, and numbers with their points, so that 2.1 is not 2 and a 1 after it.
_WORD = re.compile(r"\d+(?:\.\d+){0,3}|[^\W\d_]+")
_ZEROS = re.compile(r"(?:\.0)+$", re.MULTILINE)
#: A word that denies, with no end of a sentence or line between it and what follows.
_DENIAL = r"\b(?:not|never|nor|neither|no longer|isn['\u2019]t|aren['\u2019]t|wasn['\u2019]t)\b"
_DENIES = re.compile(_DENIAL, re.IGNORECASE)
_DENIED = re.compile(_DENIAL + r"[^.!?;:\n]*$", re.IGNORECASE)
DENIAL_WORDS = 6
#: Templates of fewer bigrams are phrases of ordinary prose as well; they must end a clause.
SHORT = 4
_CLAUSE_END = re.compile(r"\s*\Z|[^\S\n]*(?:[^\w\s]|\n|[A-Z0-9]|(?:by|worldwide)\b)")


def normalised(text: str) -> list[str]:
    """Words in lower case; trailing zeros of version numbers go (2.0 is 2)."""
    joined = "\n".join(_WORD.findall(text)).lower()
    if ".0" in joined:
        joined = _ZEROS.sub("", joined)
    return joined.split("\n")


def bigrams(text: str) -> Counter:
    """Word bigrams of the normalised text."""
    words = normalised(text)
    return Counter(zip(words, words[1:], strict=False))


def dice(a: Counter, b: Counter) -> float:
    """Twice the shared bigrams over all bigrams (multisets)."""
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


def required(text: str) -> list[tuple[str, ...]]:
    """Phrases that a window must hold to match this template: the names in it, and its first
    number with the word before it."""
    words = normalised(text)
    line = f" {' '.join(words)} "
    out = [tuple(n.split()) for n in NAMES if f" {n} " in line]
    return out + [p for p in zip(words, words[1:], strict=False) if p[1][0].isdigit()][:1]


@dataclass(frozen=True)
class Match:
    license: str
    template: int
    dice: float
    start: int
    stop: int


class LicenseScanner:
    """Finds spans of consecutive words that resemble a template, anywhere in a text.

    For each template every window that begins and ends with one of its bigrams counts, within a
    line or over several: cutting a foreign bigram off either end only raises the Dice
    coefficient, so no better window is left out. A Dice coefficient of t needs t / (2 - t) times
    the template's bigrams at least and (2 - t) / t times at most, for each template by itself;
    a start without that many of the template's bigrams ahead is passed over. A window must hold
    the template's name and version (``required``). One that holds a denial the template has not,
    one that a denial precedes within ``DENIAL_WORDS`` words of its sentence, and one of a
    template below ``SHORT`` bigrams that does not end a clause state no licence."""

    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float):
        self.threshold = threshold
        self.templates = [(name, bigrams(text)) for name, text in templates]
        self.totals = [b.total() for _, b in self.templates]
        self.required = [required(text) for _, text in templates]
        low, high = threshold / (2 - threshold), (2 - threshold) / threshold
        self.bounds = [(max(1, ceil(low * n - 1e-9)), high * n + 1e-9) for n in self.totals]
        self.grams = {g for _, grams in self.templates for g in grams}
        self.denies = [bool(_DENIES.search(text)) for _, text in templates]
        self.keys = [[p for r in rs for p in zip(r, r[1:], strict=False)] for rs in self.required]

    def _phrases(self, k: int, at: dict[tuple[str, str], list[int]], words: list[str]
                 ) -> list[tuple[int, list[int]]]:
        """Length of each required phrase of template k, and where it begins."""
        return [(len(r), [i for i in at[r[:2]] if tuple(words[i:i + len(r)]) == r])
                for r in self.required[k]]

    def _best(self, k: int, at: list[int], phrases: list[tuple[int, list[int]]],
              words: list[str], a: int, end: int) -> tuple[float, int] | None:
        """Dice and stop of template k's best window from its a-th bigram to word ``end`` at most;
        of equal ones the longest. ``at`` has the places of the template's bigrams."""
        grams, total, (least, most) = self.templates[k][1], self.totals[k], self.bounds[k]
        if a + least > len(at) or at[a + least - 1] - at[a] + 1 > most:
            return None
        whole = 0  # the first stop with every phrase inside
        for n, places in phrases:
            first = bisect_left(places, at[a])
            if first == len(places):
                return None
            whole = max(whole, places[first] + n)
        if whole > end or whole - at[a] - 1 > most:
            return None
        shared, seen, best = 0, Counter(), None
        for b in range(a, len(at)):
            i = at[b]
            size = i - at[a] + 1
            if size > most or i + 2 > end:
                break
            g = words[i], words[i + 1]
            seen[g] += 1
            if seen[g] <= grams[g]:
                shared += 1
                d = 2 * shared / (size + total)
                if i + 2 >= whole and d >= self.threshold and (best is None or d >= best[0]):
                    best = d, i + 2
                    most = min(most, 2 * total / d - total + 1e-9)  # longer ones are worse
        return best

    def _stated(self, k: int, text: str, spans: list[tuple[int, int]], i: int, stop: int) -> bool:
        if self.totals[k] < SHORT and not _CLAUSE_END.match(text, spans[stop - 1][1]):
            return False
        if not self.denies[k] and _DENIES.search(text[spans[i][0]:spans[stop - 1][1]]):
            return False
        return not _DENIED.search(text[spans[max(0, i - DENIAL_WORDS)][0]:spans[i][0]])

    def scan(self, text: str) -> list[Match]:
        """Best matches that do not overlap: the highest Dice first, then the earliest, then the
        longest, then the earlier template."""
        words = normalised(text)
        where: dict[tuple[str, str], list[int]] = {}
        for i, g in enumerate(zip(words, words[1:], strict=False)):
            if g in self.grams:
                where.setdefault(g, []).append(i)
        at: dict[int, list[int]] = {}
        phrases: dict[int, list[tuple[int, list[int]]]] = {}
        heap = []
        for k, (_, grams) in enumerate(self.templates) if where else ():
            if not all(g in where for g in self.keys[k]):
                continue
            at[k] = sorted(i for g in grams.keys() & where.keys() for i in where[g])
            if len(at[k]) < self.bounds[k][0]:
                continue
            phrases[k] = self._phrases(k, where, words)
            for a, i in enumerate(at[k]):
                if found := self._best(k, at[k], phrases[k], words, a, len(words)):
                    heap.append((-found[0], i, -found[1], k, a))
        if not heap:
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        heapify(heap)
        starts: list[int] = []
        out: list[tuple[float, int, int, int]] = []  # by start
        while heap:
            d, i, stop, k, a = heappop(heap)
            n = bisect_right(starts, i)
            if n and out[n - 1][2] > i:
                continue
            if n < len(out) and -stop > starts[n]:  # the best one before the next match
                if found := self._best(k, at[k], phrases[k], words, a, starts[n]):
                    heappush(heap, (-found[0], i, -found[1], k, a))
                continue
            if not self._stated(k, text, spans, i, -stop):
                continue
            starts.insert(n, i)
            out.insert(n, (-d, i, -stop, k))
        return sorted((Match(self.templates[k][0], k, d, spans[i][0], spans[stop - 1][1])
                       for d, i, stop, k in out), key=lambda m: m.start)


SCANNED = ("doc_id long, license string, dice double, n_matches long, "
           "matches array<struct<license:string,dice:double,start:int,stop:int>>")


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES,
                  threshold: float = 0.8) -> DataFrame:
    """Licence statements of every document: doc_id, license and dice of the best match (null
    without one), n_matches, matches (license, dice, start, stop in characters of the text).

    A map over rows without a shuffle; templates are a short fixed list. Null and empty texts
    have no match; of equal matches the earlier counts, of equal templates the earlier one; repeated rows and null ids pass row by
    row; an empty table gives no rows; other columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(templates, threshold)
        kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()),
                                   ("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            found = [scanner.scan(t.as_py() or "") for t in batch.column("text")]
            best = [max(f, key=lambda m: (m.dice, -m.start), default=None) for f in found]
            yield pa.record_batch([
                batch.column("doc_id"),
                pa.array([b and b.license for b in best], pa.string()),
                pa.array([b and b.dice for b in best], pa.float64()),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array([[{"license": m.license, "dice": m.dice, "start": m.start,
                            "stop": m.stop} for m in f] for f in found], kind)],
                names=["doc_id", "license", "dice", "n_matches", "matches"])

    return (docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
            .mapInArrow(run, SCANNED))
