"""License notices by conditional compression (operator 7).

Blocks of lines that hold a cue of license notices are candidates. Around each cue, spans of about a template's length
that begin with one of its first words are compressed by themselves and with the template as a zstandard raw
dictionary. Spans whose compressed size shrinks by ``MIN_SAVED`` or more are ranked by the bytes saved, over all
templates; in that order the winners are confirmed by the exact differences of wording: words of the template that the
span lacks, with years, holders and other fill-ins (written <...> in the template) left open. A confirmed notice takes
its words, so what saved more decides between templates that the wording would allow.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stage import text_or_empty

# fixed values: wordings of public license notices; <...> stands for a fill-in
TEMPLATES = {
    "All-rights-reserved": 'All rights reserved.',
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0.',
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-3-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:',
    "CC-BY-4.0": 'Licensed under CC BY 4.0.',
    "CC-BY-NC-4.0": 'Licensed under CC BY-NC 4.0.',
    "CC-BY-SA-4.0": 'Licensed under CC BY-SA 4.0.',
    "CC-BY-4.0-notice": 'This work is licensed under a Creative Commons Attribution 4.0 International License.',
    "GPL-2.0": 'This work is licensed under the GNU General Public License, version 2.',
    "GPL-3.0": 'This work is licensed under the GNU General Public License, version 3.',
    "GPL-3.0-notice": 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.',
    "LGPL-3.0": 'This work is licensed under the GNU Lesser General Public License, version 3.',
    "MIT": 'Released under the MIT License.',
    "MIT-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "MPL-2.0": 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.',
    "Copyright": 'Copyright (c) <year> <holder>. All rights reserved.',
}
CUE = r"(?i)licen[sc]|copyright|\(c\)|©|spdx|creative commons|all rights reserved|redistribut|warrant|hereby granted"
#: Words of the template that may be missing or changed, as a part of them.
MAX_CHANGED = 0.1
#: Part of a span's compressed size that a template must save for its wording to be compared.
MIN_SAVED = 0.1
SEARCH_WORDS = re.compile(r"\w+|<\w+>")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in SEARCH_WORDS.findall(text)]


def differences(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """(changed, first, end): template words that the best-aligned part of the block lacks or replaces, fill-ins not
    counted, and extra words inside that part; the part's range of words. A number that is lacking or replaced (another
    version) changes the whole template."""
    match = SequenceMatcher(None, template, block, autojunk=False)
    runs = [m for m in match.get_matching_blocks() if m.size]
    if not runs:
        return len(template), 0, 0
    first, end = runs[0].b, runs[-1].b + runs[-1].size
    open_ = {i for i, w in enumerate(template) if w.startswith("<")}
    held = sum(m.size for m in runs)
    kept = {i for m in runs for i in range(m.a, m.a + m.size)}
    if any(w[0].isdigit() and i not in kept for i, w in enumerate(template)):
        return len(template), first, end
    missing = len(template) - held - len(open_)
    extra = max(0, (end - first) - held - 6 * len(open_))
    return max(0, missing) + extra, first, end


class Matcher:
    """Templates ready for use as dictionaries."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words = [words_of(t) for t in templates.values()]
        self.allowed = [int(MAX_CHANGED * len(t)) for t in self.words]
        # the longest part of a block that differences() can accept, and the words that may come first in it
        self.reach = [len(t) + n + 6 * sum(w.startswith("<") for w in t) for t, n in zip(self.words, self.allowed)]
        self.starts: dict[str, list[int]] = {}
        for k, t in enumerate(self.words):
            literal = [w for w in t if not w.startswith("<")]
            for w in set(literal[:self.allowed[k] + 1]):
                self.starts.setdefault(w, []).append(k)
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
        self.given = [zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, dict_data=zstandard.ZstdCompressionDict(
            t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for t in templates.values()]
        self.cue = re.compile(CUE)
        self.seen: dict[str, list[tuple]] = {}

    def saved(self, span: str, i: int) -> tuple[int, float]:
        """Bytes, and the part of them, that template ``i`` saves of the span's compressed size."""
        raw = span.encode()
        alone = len(self.plain.compress(raw))
        gain = alone - len(self.given[i].compress(raw))
        return gain, gain / alone

    def ranked(self, block: str) -> list[tuple[int, int, int, int]]:
        """(-bytes saved, template, first word, end) of the spans around the block's cues that a template shrinks enough."""
        at = [m.span() for m in SEARCH_WORDS.finditer(block)]
        starts = [a for a, _ in at]
        cues = sorted({max(0, bisect_right(starts, m.start()) - 1) for m in self.cue.finditer(block)})
        out = []
        for s, (a, e) in enumerate(at):
            for i in self.starts.get(block[a:e].lower(), ()):
                end = min(len(at), s + self.reach[i])
                k = bisect_left(cues, s)
                if k < len(cues) and cues[k] < end:
                    gain, part = self.saved(block[a:at[end - 1][1]], i)
                    if part >= MIN_SAVED:
                        out.append((-gain, i, s, end))
        return sorted(out)

    def confirm(self, block: str) -> list[tuple[str, float, int, int, int]]:
        """(template, part saved, changed words, offset, length) of the block's notices, on disjoint ranges of words: spans
        are confirmed by their wording in order of the bytes saved."""
        if block in self.seen:
            return self.seen[block]
        out, taken = [], []
        ranked = self.ranked(block)
        if ranked:
            words, at = words_of(block), [m.span() for m in SEARCH_WORDS.finditer(block)]
        for _, i, s, end in ranked:
            changed, a, b = differences(self.words[i], words[s:end])
            first, last = s + a, s + b
            if changed > self.allowed[i] or last <= first or any(x < last and first < y for x, y in taken):
                continue
            taken.append((first, last))
            span = block[at[first][0]:at[last - 1][1]]
            out.append((self.names[i], self.saved(span, i)[1], changed, at[first][0], len(span)))
        if len(block) <= 4000:
            if len(self.seen) > 20_000:
                self.seen.clear()
            self.seen[block] = out
        return out


def blocks(text: str, cue: re.Pattern) -> Iterator[tuple[int, str]]:
    """(offset, block): runs of neighbouring lines up to a blank line of which one has a cue, and each such line."""
    at, run, start = 0, [], 0
    for line in [*text.split("\n"), ""]:
        if not line.strip():
            if len(run) > 1 and any(cue.search(x) for x in run):
                yield start, "\n".join(run)
            run = []
        else:
            if not run:
                start = at
            run.append(line)
            if cue.search(line):
                yield at, line
        at += len(line) + 1


FOUND_DDL = "doc_id long, license string, start long, length long, saved double, changed long"


def _scanner(templates: dict[str, str]):
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                        ("saved", pa.float64()), ("changed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cue = Matcher(templates), re.compile(CUE)
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for at, block in blocks(text, cue):
                    for name, saved, changed, off, length in m.confirm(block):
                        rows.append((doc_id, name, at + off, length, saved, changed))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def license_notices(spark: SparkSession, docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """docs (doc_id, text) -> a row for each license of a document: doc_id, license, notices (places that the wording
    confirms), start (character offset of the first), saved (largest part that the template saves), changed (fewest
    words that differ).

    Null and empty texts have no blocks. A null doc_id is reported as such; rows that share a doc_id count as one text,
    their distinct places together. Where spans meet, the template that saves more bytes is reported. An empty table
    gives an empty result; other columns are ignored. Texts and blocks are searched whole.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).where(F.col("text").rlike(CUE))
    found = rows.mapInArrow(_scanner(templates or TEMPLATES), FOUND_DDL)
    return (found.groupBy("doc_id", "license").agg(F.countDistinct("start").alias("notices"), F.min("start").alias("start"),
                                                   F.max("saved").alias("saved"), F.min("changed").alias("changed")))
