"""License scans by conditional compression.

A stretch of text that is worded like a license notice shrinks when it is compressed with the notice as zstandard's raw dictionary.
Candidate blocks of a whole text are those around cues: so many words of each notice that no place with nearly all of its words can
be without all of them; a block is about as long as the notice, since on a long one long notices save more than a short one that is
there. Each block is compressed alone and with its notice, in lower case. Those that the notice makes smaller are ranked by the share
of the size saved, and confirmed in that order by exact wording differences: nearly all of the notice's words must stand in order,
and what is missing or put in between is reported.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped

#: Short public wordings of license notices.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-text": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "Proprietary": "Copyright. All rights reserved.",
    "Proprietary-short": "All rights reserved.",
}
#: Words with one of these (lower case) are preferred as cues of a notice, as they are rare elsewhere.
CUES = ("licens", "permission", "redistribut", "public domain", "all rights reserved")
#: The share of a notice's words that must be there.
COVERED = 0.9
#: Of a notice that begins with "copyright", so many words after it (years and the holder) don't count as put in.
HOLDER = 12
_WORD = re.compile(r"[\w.+-]*\w")


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _reach(notice: list[str]) -> int:
    """The most words that a confirmed place of a notice spans, less those of years and a holder."""
    return int(len(notice) / COVERED)


def _cues(notice: list[str]) -> list[str]:
    """Words of a notice of which every confirmed place holds one: as many as make up more than may be missing."""
    spare, count = len(notice) - math.ceil(COVERED * len(notice)), Counter(notice)
    out: list[str] = []
    for w in sorted(count, key=lambda w: (not any(c in w for c in CUES), -len(w), w)):
        if sum(count[x] for x in out) > spare:
            break
        out.append(w)
    return out


def _starts(notice: list[str], words: list[str], cues: list[int]) -> Iterator[int]:
    """Where in words the notice may begin, given the places of its cues: near one of them, and not where too few of its words
    follow."""
    reach = _reach(notice) + (HOLDER if notice[0] == "copyright" else 0)
    least = math.ceil(COVERED * len(notice))
    heads, wanted, after = set(notice[: len(notice) - least + 1]), Counter(notice), 0
    for cue in cues:
        for s in range(max(after, cue - reach + 1), cue + 1):
            if words[s] in heads and (wanted & Counter(words[s : s + reach])).total() >= least:
                yield s
        after = cue + 1


def _aligned(notice: list[str], words: list[str], s: int, end: int) -> list[tuple[int, int]] | None:
    """Pairs of places (in notice, in words) that tell the longest common subsequence of the notice and words[s:end] for which
    nearly all of the notice is found, with few words put in; None if there is none."""
    best = None
    for gap in range(HOLDER + 1 if notice[0] == words[s] == "copyright" else 1):
        at = [s, *range(s + 1 + gap, min(end, s + gap + _reach(notice)))]
        rows = [[0] * (len(notice) + 1)]
        for j, p in enumerate(at):
            w, above, row = words[p], rows[-1], [0]
            for i, x in enumerate(notice):
                row.append(above[i] + 1 if x == w else max(above[i + 1], row[-1]))
            rows.append(row)
            found = row[-1]
            # Words put in count against a notice too, or a short one would be found spread over any long block.
            if found >= COVERED * len(notice) and found >= COVERED * (j + 1) and (best is None or (found, -j) > best[:2]):
                best = (found, -j, at, rows)
    if best is None:
        return None
    j, at, rows = 1 - best[1], *best[2:]
    i, pairs = len(notice), []
    while i and j:
        if notice[i - 1] == words[at[j - 1]]:
            i, j = i - 1, j - 1
            pairs.append((i, at[j]))
        elif rows[j - 1][i] >= rows[j][i - 1]:
            j -= 1
        else:
            i -= 1
    return pairs[::-1]


def _report(notice: list[str], words: list[str], pairs: list[tuple[int, int]]) -> tuple[float, str, str]:
    """(share of the notice's words found, missing words, words put in)."""
    held, used = map(set, zip(*pairs))
    extra = " ".join(words[p] for p in range(pairs[0][1], pairs[-1][1]) if p not in used)
    return len(pairs) / len(notice), " ".join(w for i, w in enumerate(notice) if i not in held), extra


class Scanner:
    def __init__(self, notices: dict[str, str] = NOTICES):
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.notices = {k: (_words(v), zstandard.ZstdCompressor(level=3, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(v.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))) for k, v in notices.items() if _words(v)}
        self.cues: dict[str, list[str]] = {}  # word -> notices that it is a cue of
        for k, (notice, _) in self.notices.items():
            for w in _cues(notice):
                self.cues.setdefault(w, []).append(k)

    def saved(self, name: str, stretch: str) -> float:
        raw = stretch.lower().encode("utf-8", "surrogatepass")
        return 1 - len(self.notices[name][1].compress(raw)) / len(self.plain.compress(raw))

    def blocks(self, words: list[str]) -> Iterator[tuple[str, list[int], int]]:
        """(notice, places where it may begin, end) of the candidate blocks; starts of one block are within the notice's reach."""
        cues: dict[str, list[int]] = {}
        for p, w in enumerate(words):
            for k in self.cues.get(w, ()):
                cues.setdefault(k, []).append(p)
        for k, found in cues.items():
            notice = self.notices[k][0]
            reach = _reach(notice) + (HOLDER if notice[0] == "copyright" else 0)
            starts: list[int] = []
            for s in _starts(notice, words, found):
                if starts and s >= starts[0] + reach:
                    yield k, starts, starts[-1] + reach
                    starts = []
                starts.append(s)
            if starts:
                yield k, starts, starts[-1] + reach

    def scan(self, text: str | None) -> list[tuple[int, str, float, float, str, str]]:
        """(start, license, share saved, share of the notice's words found, missing words, words put in) of each notice, by start.

        Of the confirmed places the one with most words found is told first, then the one with fewest missing and put in, then the
        one that saves most; its words are then masked, and the others have to do with the words between."""
        words = _words(text or "")
        if self.cues.keys().isdisjoint(words):
            return []
        at, out, places = [m.span() for m in _WORD.finditer(text)], [], []

        def consider(k: str, s: int, end: int) -> None:
            if pairs := _aligned(self.notices[k][0], words, s, end):
                first, last = pairs[0][1], pairs[-1][1]
                amiss = len(self.notices[k][0]) + last + 1 - first - 2 * len(pairs)
                heappush(places, (-len(pairs), amiss, -self.saved(k, text[at[first][0] : at[last][1]]), s, k, pairs))

        ranked = [(self.saved(k, text[at[starts[0]][0] : at[min(end, len(words)) - 1][1]]), k, starts) for k, starts, end in self.blocks(words)]
        for _, k, starts in sorted((r for r in ranked if r[0] > 0), key=lambda r: (-r[0], r[1], r[2])):
            for s in starts:
                consider(k, s, len(words))
        masked = bytearray(len(words))
        while places:
            _, _, less, s, k, pairs = heappop(places)
            first, last = pairs[0][1], pairs[-1][1] + 1
            if (end := masked.find(1, s, last)) >= 0:
                if end > s:
                    consider(k, s, end)
                continue
            masked[first:last] = b"\1" * (last - first)
            out.append((at[first][0], k, -less, *_report(self.notices[k][0], words, pairs)))
        return sorted(out)


def scan(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(doc_id, start, license, saved, covered, missing, extra): a row for each place that is confirmed as a notice; start in code
    points. Places don't overlap, and a notice that is there several times has as many rows. Null and empty texts have none. Of
    notices that fit a place equally well and save as much the first by name is told. Every row of docs is scanned whole and for
    itself, in place, so repeated and null ids have the places of each of their rows; columns other than doc_id and text are not
    looked at. No rows in, no rows out."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(notices)
        for b in batches:
            rows = [(i, *g) for i, t in zip(b["doc_id"], b["text"]) for g in scanner.scan(t)]
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "start", "license", "saved", "covered", "missing", "extra"]).astype({"doc_id": "Int64"})

    return mapped(docs.select(F.col("doc_id"), F.col("text")), f, "doc_id long, start long, license string, saved double, covered double, missing string, extra string")
