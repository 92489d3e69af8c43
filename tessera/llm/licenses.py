"""License notices by conditional compression.

A document's candidate blocks are its words around each of ``CUES``, on both
sides as many as the longest notice can have; line ends are white space and
comment marks no words.  A block is ranked in stretches, wherever so many of a
template's words stand together that it can be there: each piece of a stretch,
of about twice the template's length, is compressed alone and once more with
every template as raw zstandard dictionary: the more of it a template already
says, the fewer bytes are left.  A stretch's template is looked for where it
is among those of a piece that save ``CHOSEN`` of its size or more; the others
are not.  What is chosen is confirmed by the exact wording: the words of the
template that the stretch lacks and the words that it has in their place, and
compressed by itself.  Of overlapping notices the one that saves the most bytes
stays, of those whose reduction is at least ``REDUCTION``; each template has
stretches of its own length, so a long form cannot hide a short one.

Blocks are searched in windows of ``WINDOW`` words that overlap by the
longest notice, so whole texts of any length are covered in bounded
memory.  Repeated stretches' reductions are remembered within a worker.

Defined results: NULL and empty texts have no notices (no rows); equal
savings rank by template name; repeated rows repeat their notices; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Iterator
from difflib import SequenceMatcher
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, utf8

#: A reduction by at least this share is looked at; a notice may lack or add up to this share of the template's words.
REDUCTION = 0.25
DIFFERENT = 0.25
#: A template is looked for in a stretch if it saves at least this share of a piece.
CHOSEN = 0.05
#: Words of a block searched at a time, reductions remembered (per generation).
WINDOW = 1024
REMEMBERED = 50_000

#: Marks of words that may belong to a license notice ("reserved" only after "rights").
CUES = ("licen", "copyright", "reserved", "permission", "warrant", "redistribut")

#: Public license notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so."),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}

SCHEMA = ("doc_id long, start long, license string, reduction double, exact boolean, "
          "missing array<string>, added array<string>")

_CUE, _CUE_BYTES = re.compile("|".join(CUES)), tuple(c.encode() for c in CUES)
_WORD = re.compile(r"\S+")
#: Marks around a word, those of comments too.
_MARKS = ".,;:!?\"'()*#$%&|/<>-"


class Notice(NamedTuple):
    start: int  # word of the window it begins at
    stop: int
    license: str
    reduction: float
    missing: list[str]
    added: list[str]


def tokens(text: str) -> list[str]:
    """Words as they are compared: lower case, without marks around them."""
    return [w for w in (x.strip(_MARKS).lower() for x in text.split()) if w]


def blocks(text: str, reach: int, limit: int) -> Iterator[tuple[list[str], list[int], bool]]:
    """Words and their places in the text, in blocks of up to ``reach`` words
    on both sides of cues (the end of one may begin the next); pieces of at most ``limit`` words, and whether the
    next piece goes on where this one ends."""
    before, words, places, left, last = deque(maxlen=reach), [], [], 0, ""
    for m in _WORD.finditer(text):
        word = m.group().strip(_MARKS).lower()
        if not word:
            continue
        if _CUE.search(word) and (word != "reserved" or last == "rights"):
            if not left:
                words, places = [w for w, _ in before], [i for _, i in before]
            left = reach + 1
        last = word
        before.append((word, m.start()))
        if not left:
            continue
        words.append(word)
        places.append(m.start())
        left -= 1
        if not left or len(words) >= limit:
            yield words, places, left > 0
            words, places = [], []
    if words:
        yield words, places, False


def differences(block: list[str], template: list[str]) -> tuple[list[str], list[str], int, int]:
    """Words of the template that the block lacks, words the block has
    between the first and the last it shares, and that stretch of the block:
    the one that shares the most words less those between."""
    found = [m for m in SequenceMatcher(None, block, template, autojunk=False).get_matching_blocks() if m.size]
    if not found:
        return template, [], 0, 0
    best, run, first, begin, end = 0, 0, 0, 0, 0
    for i, m in enumerate(found):
        run = run - (m.a - found[i - 1].a - found[i - 1].size) if i else 0
        if run <= 0:  # what lies before is too far away to belong to it
            run, first = 0, i
        run += m.size
        if run > best:
            best, begin, end = run, first, i + 1
    found = found[begin:end]
    here = {i for m in found for i in range(m.a, m.a + m.size)}
    there = {i for m in found for i in range(m.b, m.b + m.size)}
    first, stop = min(here), max(here) + 1
    return ([w for i, w in enumerate(template) if i not in there],
            [block[i] for i in range(first, stop) if i not in here], first, stop)


def stretches(words: list[str], template: Counter, width: int, least: int) -> Iterator[tuple[int, int]]:
    """Where runs of ``width`` words hold at least ``least`` of the
    template's; overlapping runs are one stretch."""
    have, shared, start, stop = Counter(), 0, 0, 0
    for i, word in enumerate(words):
        if word in template:
            have[word] += 1
            shared += have[word] <= template[word]
        old = words[i - width] if i >= width else None
        if old in template:
            shared -= have[old] <= template[old]
            have[old] -= 1
        if shared >= least:
            begin = max(i - width + 1, 0)
            if stop and begin > stop:
                yield start, stop
                stop = 0
            start, stop = start if stop else begin, i + 1
    if stop:
        yield start, stop


class Scanner:
    """Compressors for a set of templates."""

    def __init__(self, templates: dict[str, str]):
        import zstandard

        def made(content: bytes):
            kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(level=19, dict_data=kind, write_content_size=False)

        self.alone = zstandard.ZstdCompressor(level=19, write_content_size=False)
        self.templates = [(name, made(" ".join(tokens(text)).encode()), tokens(text)) for name, text in sorted(templates.items())]
        #: Words that the longest notice can have.
        self.reach = max((len(t) + int(DIFFERENT * len(t)) for _, _, t in self.templates), default=0)
        self.counts = [Counter(t) for _, _, t in self.templates]
        self.known = Memo(self._saved, REMEMBERED)
        self.ranked = Memo(lambda piece: frozenset(n for share, n, _ in self.rank(piece.encode()) if share >= CHOSEN), REMEMBERED)

    def rank(self, block: bytes) -> list[tuple[float, str, list[str]]]:
        """Templates by the share of the block's compressed size they save."""
        size = len(self.alone.compress(block))
        out = [((size - len(c.compress(block))) / size, name, words) for name, c, words in self.templates]
        return sorted(out, key=lambda x: (-x[0], x[1]))

    def _saved(self, key: tuple[int, str]) -> tuple[int, int]:
        """Compressed size of a stretch, and how much of it a template saves."""
        block = key[1].encode()
        size = len(self.alone.compress(block))
        return size, size - len(self.templates[key[0]][1].compress(block))

    def _chosen(self, words: list[str], start: int, stop: int, t: int) -> bool:
        """Is a template among those that compress a piece of
        ``words[start:stop]`` best?  (The pieces overlap by its longest
        notice, so each notice is whole in one.)"""
        name, _, template = self.templates[t]
        width = len(template) + int(DIFFERENT * len(template))
        return any(name in self.ranked[" ".join(words[a:min(a + 2 * width, stop)])]
                   for a in range(start, max(stop - width, start + 1), width))

    def _confirmed(self, words: list[str], start: int, stop: int, template: list[str]) -> Iterator[tuple]:
        """Stretches of ``words[start:stop]`` that word the template."""
        width = len(template) + int(DIFFERENT * len(template))
        while stop - start >= len(template) - int(DIFFERENT * len(template)):
            missing, added, first, end = differences(words[start:min(start + 2 * width, stop)], template)
            if end > first and len(missing) + len(added) <= DIFFERENT * len(template):
                yield from self._confirmed(words, start, start + first, template)
                yield start + first, start + end, missing, added
                start += end
            else:  # the longest shared run may be another's: a notice that begins first, by a narrower look
                near = differences(words[start:min(start + width, stop)], template)
                if near[3] > near[2] and len(near[0]) + len(near[1]) <= DIFFERENT * len(template):
                    yield start + near[2], start + near[3], near[0], near[1]
                    start += near[3]
                else:
                    start += max(width // 4, 1)

    def _notices(self, words: list[str]) -> list[Notice]:
        """Notices of one window, in order."""
        held, found = set(words), []
        for t, (name, _, template) in enumerate(self.templates):
            less = int(DIFFERENT * len(template))
            if sum(w not in held for w in self.counts[t]) > less:
                continue
            for start, stop in stretches(words, self.counts[t], len(template) + less, len(template) - less):
                if not self._chosen(words, start, stop, t):
                    continue
                for first, end, missing, added in self._confirmed(words, start, stop, template):
                    size, saved = self.known[t, " ".join(words[first:end])]
                    if saved >= REDUCTION * size:
                        found.append((-saved, name, Notice(first, end, name, round(saved / size, 6), missing, added)))
        taken = []
        for _, _, n in sorted(found, key=lambda x: (*x[:2], x[2].start)):
            if all(n.stop <= o.start or n.start >= o.stop for o in taken):
                taken.append(n)
        return sorted(taken, key=lambda n: n.start)

    def scan(self, data: bytes) -> Iterator[tuple[int, Notice]]:
        """Notices and the bytes they begin at."""
        self.known.turn()
        self.ranked.turn()
        low = data.lower()
        if not any(c in low for c in _CUE_BYTES):
            return
        text = data.decode("utf-8", "replace")
        words, places, at, byte, beyond = [], [], 0, 0, -1
        for more, where, goes_on in blocks(text, self.reach, WINDOW):
            new = bisect_right(where, beyond)
            words, places = words + more[new:], places + where[new:]
            # a notice is taken where it is seen whole, with what may overlap it
            own = len(words) - 2 * self.reach if goes_on else len(words)
            done = max(own, 0)
            for n in self._notices(words):
                if n.start < own:
                    byte, at = byte + len(text[at:places[n.start]].encode()), places[n.start]
                    yield byte, n
                    done, beyond = max(done, n.stop), places[n.stop - 1]
            words, places = (words[done:], places[done:]) if goes_on else ([], [])


_SCANNERS: dict[int, tuple[dict, Scanner]] = {}


def _scanner(templates: dict[str, str]) -> Scanner:
    key = hash(tuple(sorted(templates.items())))
    if key not in _SCANNERS:
        _SCANNERS[key] = (templates, Scanner(templates))
    return _SCANNERS[key][1]


def _scan(templates: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(templates)
        for batch in batches:
            out = {n: [] for n in ("doc_id", "start", "license", "reduction", "exact", "missing", "added")}
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                for start, n in scanner.scan(text):
                    row = (doc_id, start, n.license, n.reduction, not n.missing and not n.added, n.missing, n.added)
                    for values, value in zip(out.values(), row):
                        values.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_(), pa.list_(pa.string()),
                     pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    return run


def notices(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row for each notice found: ``doc_id``, ``start`` (byte offset of
    its first word), ``license``, ``reduction``, ``exact``, and the words
    ``missing`` and ``added``.  No shuffle."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.where(F.col("text").isNotNull()).mapInArrow(_scan(templates or TEMPLATES), SCHEMA)
