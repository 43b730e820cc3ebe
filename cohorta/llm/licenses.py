"""License scans by conditional compression.

Blocks of about a template's length are cut around its cues, runs of its words of which every copy keeps one. A block
that repeats a template costs few bytes once the template is the compressor's dictionary: each block is compressed with
every template as zstandard raw dictionary, templates are ranked by the bytes they save, and in this order those whose
exact wording differs little enough are confirmed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from cohorta.llm.common import texts

# Public license notices, by SPDX name or a plain one.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                        "International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                        "International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation; either version 2 of the "
                         "License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation, either version 3 of the "
                         "License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Licensed under the ISC License."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
]
# Identifiers that a file's tag line may name; each makes a template of its own.
TAGGED = ["AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0",
          "CC0-1.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
          "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense"]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in TAGGED]
#: Which share of a template's words may differ.
DIFFERENT = 0.12
# Words that are part of a license's name. One more, one less or another one is another license.
NAMING = {"affero", "apache", "attribution", "bsd", "by", "clause", "commercial", "derivatives", "general", "isc", "later",
          "lesser", "library", "mit", "mozilla", "nc", "nd", "noncommercial", "noderivatives", "noderivs", "only", "sa",
          "sharealike", "zero"}

FOUND = "doc_id long, line int, license string, saved double, n_different int, different string, quote string"
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Template:
    name: str
    words: list[str]
    packer: zstandard.ZstdCompressor

    @property
    def most(self) -> int:
        """How many of the words may differ."""
        return int(DIFFERENT * len(self.words))


@dataclass(frozen=True)
class Known:
    """Templates with what finds them: their cues, and the words that bind."""

    templates: list[Template]
    cues: ahocorasick.Automaton
    binding: set[str]
    alone: zstandard.ZstdCompressor


def _packer(held: zstandard.ZstdCompressionDict | None = None) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=19, dict_data=held, write_content_size=False, write_dict_id=False)


def cues(words: list[str], most: int) -> list[tuple[int, list[str]]]:
    """(place, run): the words cut into most + 1 runs. An edit spoils one run at most, so a copy with `most` edits holds
    at least one of them as it is."""
    edges = [k * len(words) // (most + 1) for k in range(most + 2)]
    return [(a, words[a:b]) for a, b in zip(edges, edges[1:])]


def known(rows: list[tuple[str, str]]) -> Known:
    """Templates ready for use. Besides NAMING, those words bind in which templates of two licenses differ that are so
    alike that one could be taken for the other. Templates without words are left out."""
    held = [Template(name, words, _packer(zstandard.ZstdCompressionDict(
        text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)))
        for name, text in rows if (words := _WORD.findall(text.lower()))]
    places_of: dict[str, list[tuple[int, int]]] = {}
    for k, t in enumerate(held):
        for at, run in cues(t.words, t.most):
            places_of.setdefault(f" {' '.join(run)} ", []).append((k, at))
    automaton, binding = ahocorasick.Automaton(), set(NAMING)
    for cue, spots in places_of.items():
        automaton.add_word(cue, (len(cue), spots))
    automaton.make_automaton()
    for t in held:
        for other in held:
            if t.name != other.name and t.most and abs(len(t.words) - len(other.words)) <= t.most and (
                    len(set(t.words) - set(other.words)) <= t.most):
                edits = differences(t.words, other.words)
                if len(edits) <= t.most:
                    binding |= _edited(edits)
    return Known(held, automaton, binding, _packer())


def _edited(edits: list[str]) -> set[str]:
    """The words that edits name."""
    return {w for d in edits for w in _WORD.findall(d)}


def differences(wanted: list[str], words: list[str]) -> list[str]:
    """The cheapest edits that make some run of `words` read `wanted`: "-gone", "+added", "old>new"."""
    cost = np.zeros((len(wanted) + 1, len(words) + 1), np.int64)
    cost[:, 0] = np.arange(len(wanted) + 1)
    for i, w in enumerate(wanted, 1):
        for j, v in enumerate(words, 1):
            cost[i, j] = min(cost[i - 1, j - 1] + (w != v), cost[i - 1, j] + 1, cost[i, j - 1] + 1)
    i, j, out = len(wanted), int(np.argmin(cost[-1])), []
    while i:
        if j and cost[i, j] == cost[i - 1, j - 1] + (wanted[i - 1] != words[j - 1]):
            if wanted[i - 1] != words[j - 1]:
                out.append(f"{wanted[i - 1]}>{words[j - 1]}")
            i, j = i - 1, j - 1
        elif cost[i, j] == cost[i - 1, j] + 1:
            out.append(f"-{wanted[i - 1]}")
            i -= 1
        else:
            out.append(f"+{words[j - 1]}")
            j -= 1
    return out[::-1]


def places(wanted: list[int], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edits, begin) for each end in `words`: the fewest edits that make a run that ends there read `wanted`, and where
    this run begins, the last such place. Row by row: a row's added words are a running minimum."""
    unit, n = 1 << 32, len(words)
    ramp = unit * np.arange(n + 1, dtype=np.int64)
    row = n - np.arange(n + 1, dtype=np.int64)
    for w in wanted:
        new = row + unit
        new[1:] = np.minimum(new[1:], row[:-1] + np.where(words == w, 0, unit))
        row = np.minimum.accumulate(new - ramp) + ramp
    return row >> 32, n - (row & (unit - 1))


def confirmed(t: Template, words: list[str], binding: set[str]) -> tuple[int, int, list[str]] | None:
    """(begin, end, edits) of the run of words that reads like the template, or None: at most `most` edits, none of them
    of a number or of a binding word. Of several runs the one with the fewest edits, then the first."""
    if len(words) < len(t.words) - t.most:
        return None
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    if sum(w in numbers for w in t.words) < len(t.words) - t.most:
        return None
    edits, begin = places([numbers.get(w, -1) for w in t.words], np.array([numbers[w] for w in words], np.int64))
    for _, end in sorted((int(edits[e]), e) for e in np.flatnonzero(edits <= t.most).tolist()):
        own = differences(t.words, words[begin[end]:end])
        named = _edited(own)
        if not (named & binding or any(c.isdigit() for w in named for c in w)):
            return int(begin[end]), end, own
    return None


def _blocks(low: str, found: list[str], held: Known) -> list[tuple[int, int]]:
    """(first word, end): a block around each place where a cue says that a template may stand, long enough for all
    that its edits may add. Cues of one copy make one block."""
    if not held.templates:
        return []
    begins: dict[int, set[int]] = {}
    line = f" {' '.join(found)} "
    starts = None
    for at, (size, spots) in held.cues.iter(line):
        if starts is None:
            starts = np.cumsum([0] + [len(w) + 1 for w in found])
        word = int(np.searchsorted(starts, at - size + 1))
        for k, place in spots:
            begins.setdefault(k, set()).add(word - place)
    out = set()
    for k, places_ in begins.items():
        t, group = held.templates[k], []
        for b in sorted(places_) + [None]:
            if group and (b is None or b - group[-1] > t.most):
                out.add((max(group[0] - t.most, 0), min(group[-1] + len(t.words) + t.most, len(found))))
                group = []
            if b is not None:
                group.append(b)
    return sorted(out)


def notices(low: str, held: Known) -> list[tuple]:
    """(first character, license, saved, differences, notice) of the notices in a text in small letters, in order; no
    two of them share a word. Of those that would, the one whose template saves most bytes of its block stands, then
    the one with the fewest edits, then the longer template."""
    blocks = _blocks(low, _WORD.findall(low), held)
    if not blocks:
        return []
    spans = [m.span() for m in _WORD.finditer(low)]
    ranked = []
    for first, end in blocks:
        text = low[spans[first][0]:spans[end - 1][1]].encode()
        words = [low[a:b] for a, b in spans[first:end]]
        whole = len(held.alone.compress(text))
        saved = [(len(t.packer.compress(text)) - whole, k) for k, t in enumerate(held.templates)]
        for cost, k in sorted(saved):
            t = held.templates[k]
            hit = confirmed(t, words, held.binding)
            if hit:
                ranked.append((cost, len(hit[2]), -len(t.words), first + hit[0], first + hit[1], k, hit[2], -cost / whole))
    out, taken = [], set()
    for _, _, _, a, b, k, edits, share in sorted(ranked):
        if taken.isdisjoint(range(a, b)):
            taken.update(range(a, b))
            out.append((spans[a][0], held.templates[k].name, share, edits, low[spans[a][0]:spans[b - 1][1]]))
    return sorted(out, key=lambda r: r[0])


def scan(docs: DataFrame, rows: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text"
         ) -> DataFrame:
    """One row per notice: doc_id, line (from 0) of its first word, license, saved (share of its block's compressed size
    that the template saves), n_different and different (edits of the template's words), quote (the notice, in small
    letters). `rows` are (license, notice) templates, TEMPLATES if not given; their cues come from their own words.

    One pass where the rows are read. Null, empty and cue-less texts give no rows, rows without id give rows without id,
    repeated rows repeated ones. Lines have no say: a text on one line may hold several notices, and a notice may be
    wrapped anywhere. An empty table gives no rows.
    """
    rows = TEMPLATES if rows is None else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = known(rows)
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                low = text.as_py().lower()
                for a, name, saved, edits, quote in notices(low, held):
                    out.append((doc, low.count("\n", 0, a), name, saved, len(edits), " ".join(edits), quote))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (
                        pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.string(), pa.string()))],
                    names=["doc_id", "line", "license", "saved", "n_different", "different", "quote"])

    return texts(docs, id_col, text_col).mapInArrow(run, FOUND)
