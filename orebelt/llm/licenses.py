"""License scans by conditional compression.

A block that holds a license's wording shrinks when the license is the compressor's dictionary.
Each candidate block is compressed alone and with every template as a raw zstandard dictionary;
templates are ranked by what they save, and all that save anything are confirmed by the exact difference
of words between template and block.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of licenses and the wording of their usual notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0 Universal.",),
}
#: A line with one of these may be part of a license.
TRIGGER = r"(?i)licen[cs]e|permission|redistribut|free software|public domain|creative commons|\bCC0|\bCC BY"
#: Least share of a template's words that the block must hold in order.
WORDING = 0.85
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_TRIGGER = re.compile(TRIGGER)
_WINDOW = 400


class _Scanner:
    def __init__(self) -> None:
        self.plain = zstandard.ZstdCompressor(level=3)
        self.known = []
        for name, forms in TEMPLATES.items():
            for form in forms:
                folded = " ".join(_WORD.findall(form.lower()))
                # a raw dictionary must have eight bytes at least, as all of these have
                data = zstandard.ZstdCompressionDict(folded.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.known.append((name, folded.split(), zstandard.ZstdCompressor(level=3, dict_data=data)))

    def _held(self, k: int, words: list[str], matcher: difflib.SequenceMatcher | None, at: int) -> Iterator[tuple]:
        """(difference, -length, start, end, license, missing, foreign, share) of each place of template k."""
        _, wanted, _ = self.known[k]
        if len(words) < WORDING * len(wanted):
            return
        if matcher is None:
            matcher = difflib.SequenceMatcher(None, (), words, autojunk=False)
        matcher.set_seq1(wanted)
        same = matcher.get_matching_blocks()[:-1]
        held = sum(m.size for m in same)
        if held < WORDING * len(wanted):
            return
        start, end = same[0].b, same[-1].b + same[-1].size
        missing, foreign = len(wanted) - held, end - start - held
        yield missing + foreign, -len(wanted), at + start, at + end, self.known[k][0], missing, foreign, held / len(wanted)
        # the notice may stand again on both sides
        yield from self._held(k, words[:start], None, at)
        yield from self._held(k, words[end:], None, at + end)

    def best(self, block: list[tuple[int, str]]) -> list[tuple[int, str, float, int, int, float]]:
        """(line, license, reduction, words missing, words foreign to it, share of wording) of confirmed licenses."""
        found = []
        every = [w for _, line in block for w in _WORD.findall(line.lower())]
        of = [n for n, line in block for _ in _WORD.findall(line.lower())]
        # long blocks are read in half-overlapping windows, each compressed on its own
        for at in range(0, max(1, len(every) - _WINDOW // 2), _WINDOW // 2):
            words = every[at : at + _WINDOW]
            data = " ".join(words).encode()
            alone = len(self.plain.compress(data))
            saved = [(1 - len(c.compress(data)) / alone, k) for k, (_, _, c) in enumerate(self.known)]
            matcher = difflib.SequenceMatcher(None, (), words, autojunk=False)
            for reduction, k in sorted(saved, key=lambda x: (-x[0], x[1])):
                if reduction > 0:
                    found += [(*x, reduction) for x in self._held(k, words, matcher, at)]
        # of wordings that overlap, the one with the fewest differences stays, then the longest
        kept: list[tuple] = []
        for x in sorted(found):
            over = [y for y in kept if y[2] < x[3] and x[2] < y[3]]
            if all(y[0] == x[0] and y[4] != x[4] for y in over):
                kept.append(x)
        return sorted((of[x[2]], x[4], round(x[8], 6), x[5], x[6], x[7]) for x in kept)


def blocks(text: str, reach: int) -> Iterator[list[tuple[int, str]]]:
    """Numbered lines around those with a trigger: at least ``reach`` words on both sides."""
    lines = text.split("\n")
    size = [len(_WORD.findall(x)) for x in lines]
    spans: list[list[int]] = []
    for i in (i for i, x in enumerate(lines) if _TRIGGER.search(x)):
        first, last, before, after = i, i, 0, 0
        while first > 0 and before < reach:
            first -= 1
            before += size[first]
        while last < len(lines) - 1 and after < reach:
            last += 1
            after += size[last]
        if spans and first <= spans[-1][1] + 1:
            spans[-1][1] = last
        else:
            spans.append([first, last])
    for first, last in spans:
        yield [(n + 1, lines[n]) for n in range(first, last + 1)]


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licenses that texts state: ``doc_id, line, license, reduction, missing, foreign, exact``.

    A candidate block is the lines around a line with a trigger word, as many words as the longest
    template has on both sides; blocks that meet are one. ``line`` (from 1) is where the wording
    starts. ``reduction`` is the share of the compressed size that the template saves,
    ``missing`` and ``foreign`` count the words of the template that the block lacks and the
    block's words between those it has; ``exact`` means neither. Of wordings that
    overlap only the closest is named, all of them if equally close. Null, empty and unlicensed texts have no rows;
    repeated rows have theirs again; lines of any length are read whole.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col(text).rlike(TRIGGER))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = _Scanner()
        reach = max(len(wanted) for _, wanted, _ in scanner.known)
        names = ["doc_id", "line", "license", "reduction", "missing", "foreign", "share"]
        for frame in frames:
            found = [(d, *row) for d, t in zip(frame["doc_id"].astype(object), frame["text"], strict=True) for b in blocks(t, reach) for row in scanner.best(b)]
            yield pd.DataFrame(found, columns=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    out = rows.mapInPandas(compare, f"doc_id {kind}, line int, license string, reduction double, missing int, foreign int, share double")
    return out.withColumn("exact", (F.col("missing") == 0) & (F.col("foreign") == 0)).drop("share")
