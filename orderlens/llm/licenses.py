"""License scans: MinHash bands over overlapping windows, verified by containment.

Every template is the set of its shingles of `SHINGLE` terms (letters, digits, non-ASCII;
lower case). For each template length, a text is cut into windows of that many terms at
every `length // 4` terms, so one window covers at least seven eighths of any occurrence. A
window's MinHash signature has `BANDS` bands of `ROWS` values; a band equal to a template's
band retrieves the template. A window and a template with Jaccard similarity of 0.6 meet
with probability 1 - (1 - 0.6^2)^16 > 0.999. A retrieved template is verified by the share
of its shingles in the window widened by half a length on each side: `CONTAINED` or more.
What sets it apart counts too: if another license's template has half of its shingles or
more (GPL-2.0 and GPL-3.0 differ by one term), `DISTINCT` of the others must be there.

Where templates of two licenses overlap in a text, the better one is reported: one whose
matched shingles are all among those that the other one matches there goes (the opening of
the GPL in a notice with a version, BSD-2-Clause in BSD-3-Clause); if both match the same
ones, the one with the lower containment goes.

Templates are the notices, titles and distinguishing paragraphs by which texts name or hold
a license: the keys of `TEMPLATES` are all the licenses that are found. `GPL`, `LGPL` and
`BSD` stand for notices that don't say which version or how many clauses.

Windows without any shingle of a template of their length (similarity 0) aren't sketched;
this drops nothing that could match. Templates are short and few; they travel with the tasks.

Results for edge cases: null or empty texts have no license; a template of fewer than three
terms has its whole sequence as one shingle and isn't found by windows (none of the fixed ones is so
short); repeated rows get their matches each; an empty table gives none; other columns are
ignored; texts are whole.
"""
from __future__ import annotations

from bisect import bisect_left, bisect_right
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernel as K
from .frames import map_texts

SHINGLE, BANDS, ROWS, CONTAINED, DISTINCT = 3, 16, 2, 0.75, 0.5
# Notices, titles and paragraphs of public licenses.
_GNU_OPENING = "is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License"
_GNU_NOTICES = (_GNU_OPENING + " as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.",
                _GNU_OPENING + " as published by the Free Software Foundation, version {}.",
                _GNU_OPENING + " version {} as published by the Free Software Foundation",
                "licensed under the GNU {} General Public License, version {}.", "licensed under the GNU {} General Public License v{}.")
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_2 = (_BSD_OPENING + ":\nRedistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
          "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
          "documentation and/or other materials provided with the distribution.")
_BSD_ADVERTISING = "\nAll advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by"
_BSD_NAMES = ("\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
              "software without specific prior written permission.")
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"


def _gnu(kind: str, version: str, date: str, years: str) -> tuple[str, ...]:
    return (*(x.format(kind, version) for x in _GNU_NOTICES),
            f"GNU {kind} General Public License Version {version}, {date} Copyright (C) {years} Free Software Foundation, Inc.")


def _cc(code: str, version: str, legal: str) -> tuple[str, ...]:
    return (f"This work is licensed under a Creative Commons {_CC[code]} {version} {legal} License.", f"Licensed under CC {code} {version}.")


TEMPLATES = {
    "0BSD": (_ISC + '. THE SOFTWARE IS PROVIDED "AS IS"',),
    "AGPL-3.0": _gnu("Affero", "3", "19 November 2007", "2007"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    "Artistic-1.0": ("The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control",),
    "BSD": (_BSD_OPENING,),
    "BSD-2-Clause": (_BSD_2, "Licensed under the BSD 2-Clause License."),
    "BSD-3-Clause": (_BSD_2 + _BSD_NAMES, "Licensed under the BSD 3-Clause License."),
    "BSD-4-Clause": (_BSD_2 + _BSD_ADVERTISING + _BSD_NAMES,),
    "BSL-1.0": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
                "Distributed under the Boost Software License, Version 1.0."),
    **{f"CC-{code}-{version}": _cc(code, version, legal) for code in _CC for version, legal in (("3.0", "Unported"), ("4.0", "International"))},
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
                "Creative Commons Legal Code CC0 1.0 Universal", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", "Licensed under CC0 1.0."),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
                "Eclipse Public License - v 2.0"),
    "GFDL-1.2": ("Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.2",
                 "GNU Free Documentation License Version 1.2, November 2002"),
    "GFDL-1.3": ("Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3",
                 "GNU Free Documentation License Version 1.3, 3 November 2008"),
    "GPL": (_GNU_OPENING.format(""), "licensed under the GNU General Public License"),
    "GPL-1.0": (*_gnu("", "1", "February 1989", "1989"),
                _GNU_OPENING.format("") + " as published by the Free Software Foundation; either version 1, or (at your option) any later version."),
    "GPL-2.0": _gnu("", "2", "June 1991", "1989, 1991"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", *_gnu("", "3", "29 June 2007", "2007")),
    "ISC": (_ISC + ", provided that the above copyright notice and this permission notice appear in all copies.", "Licensed under the ISC License."),
    "LGPL": (_GNU_OPENING.format("Lesser"), "licensed under the GNU Lesser General Public License"),
    "LGPL-2.0": _gnu("Library", "2", "June 1991", "1991"),
    "LGPL-2.1": _gnu("Lesser", "2.1", "February 1999", "1991, 1999"),
    "LGPL-3.0": _gnu("Lesser", "3", "29 June 2007", "2007"),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "MPL-1.1": ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0 1. Definitions"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",),
}
# Names of licenses in other licenses' texts, which say nothing of the text's own license.
_MENTIONS = tuple(f"the GNU {kind} General Public License, version {version}" for kind in ("", "Lesser", "Library", "Affero") for version in ("1", "2", "2.1", "3"))


class Template(NamedTuple):
    license: str
    length: int
    shingles: np.ndarray
    bands: np.ndarray
    apart: list[np.ndarray]  # for each similar template of another license, or mention: the shingles which that one lacks


def _shingle_hashes(text: str) -> tuple[int, np.ndarray]:
    """Number of terms, and the shingles of each paragraph (line): a text may number them."""
    hashes = [K.terms_of(K.texts_of(pa.array([line.lower()], pa.string())))[1] for line in text.split("\n")]
    return sum(map(len, hashes)), np.concatenate([K.run_hash(h, SHINGLE, seed=3) for h in hashes])


def _values(shingles: np.ndarray) -> np.ndarray:
    """One hash value a row of the signature for each shingle."""
    seeds = K.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
    return K.mix(shingles[:, None] ^ seeds[None, :])


def _bands(signature: np.ndarray) -> np.ndarray:
    s = signature.reshape(-1, BANDS, ROWS)
    out = K.mix(np.full(s.shape[:2], 1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    for r in range(ROWS):
        out = K.mix(out ^ s[:, :, r] * np.uint64(0x9E3779B97F4A7C15))
    return out


def _templates(texts: dict[str, tuple[str, ...]]) -> list[Template]:
    hashes = [(name, *_shingle_hashes(text)) for name, versions in sorted(texts.items()) for text in versions]
    mentions = [_shingle_hashes(text)[1] for text in _MENTIONS]
    out = []
    for name, length, h in hashes:
        if not len(h):
            continue
        mine = np.unique(h)
        others = [np.setdiff1d(mine, x) for x in (*(x for n, _, x in hashes if n != name), *mentions)]
        apart = [x for x in others if 0 < len(x) <= (1 - DISTINCT) * len(mine)]
        out.append(Template(name, length, mine, _bands(_values(h).min(axis=0))[0], apart))
    return out


class Match(NamedTuple):
    """A verified window of a text: its span and the places of the template's shingles in it."""

    text: int
    license: str
    begin: int
    end: int
    share: float
    places: frozenset[int]


def _best(found: list[Match]) -> list[Match]:
    """Those that no match of another license in the same place explains better."""
    by_text: dict[int, list[Match]] = {}
    for m in found:
        by_text.setdefault(m.text, []).append(m)
    kept = []
    for matches in by_text.values():
        by_name: dict[str, list[Match]] = {}
        for m in sorted(matches, key=lambda x: x.begin):
            by_name.setdefault(m.license, []).append(m)
        widest = {name: max(x.end - x.begin for x in some) for name, some in by_name.items()}
        for m in matches:
            worse = False
            for name, some in by_name.items():
                if name == m.license:
                    continue
                first = bisect_right(some, m.begin - widest[name], key=lambda x: x.begin)
                near = [x for x in some[first:bisect_left(some, m.end, key=lambda x: x.begin)] if x.end > m.begin]
                places = frozenset().union(*(x.places for x in near))
                worse |= m.places < places or m.places == places and max(x.share for x in near) > m.share
            if not worse:
                kept.append(m)
    return kept


def find(texts: K.Texts, templates: list[Template]) -> list[tuple[int, str, int, float]]:
    """(text, license, first term, containment) of each verified window."""
    words, h = K.terms_of(texts)
    if len(h) < SHINGLE:
        return []
    shingle, doc = K.run_hash(h, SHINGLE, seed=3), words.doc
    inside = doc[:len(shingle)] == doc[SHINGLE - 1:]
    holds = lambda known, x: known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x
    every = np.unique(np.concatenate([t.shingles for t in templates]))
    known = np.flatnonzero(inside & holds(every, shingle))
    found: list[Match] = []
    for length in sorted({t.length for t in templates}):
        mine = [t for t in templates if t.length == length]
        step, width = max(length // 4, 1), length - SHINGLE + 1
        place = known[holds(np.unique(np.concatenate([t.shingles for t in mine])), shingle[known])]
        at = place - words.first[doc[place]]  # windows (multiples of the step) that hold a known shingle
        lo, hi = np.maximum(-(-(at - width + 1) // step), 0), at // step
        window = np.unique(np.repeat(words.first[doc[place]], hi - lo + 1) + K.gather(np.arange(int(hi.max()) + 1 if len(hi) else 0), lo, hi - lo + 1) * step)
        for some in np.array_split(window, max(1, len(window) * width * BANDS * ROWS // 4_000_000 + 1)):
            if not len(some):
                continue
            owner = doc[some]
            begin, end = some, np.minimum(some + width, np.maximum(words.first[owner + 1] - SHINGLE + 1, some + 1))
            size = np.minimum(end, len(shingle)) - begin
            good = size > 0
            begin, size, owner = begin[good], size[good], owner[good]
            if not len(begin):
                continue
            values = _values(K.gather(shingle, begin, size))
            signature = np.minimum.reduceat(values, np.cumsum(size) - size, axis=0)
            bands = _bands(signature)
            for t in mine:
                for k in np.flatnonzero((bands == t.bands).any(axis=1)):
                    d = owner[k]
                    a = max(words.first[d], begin[k] - length // 2)
                    b = min(words.first[d + 1] - SHINGLE + 1, begin[k] + width + length // 2)
                    share = float(np.isin(t.shingles, shingle[a:b]).mean())
                    if share >= CONTAINED and all(np.isin(x, shingle[a:b]).mean() >= DISTINCT for x in t.apart):
                        places = frozenset((a + np.flatnonzero(holds(t.shingles, shingle[a:b]))).tolist())
                        found.append(Match(int(d), t.license, int(a), int(b), share, places))
    return [(m.text, m.license, int(m.begin - words.first[m.text]), m.share) for m in _best(found)]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """(id, licenses array<struct<license, containment>>) of each row: its licenses in
    order of name, each with the best containment; empty if there is none."""
    templates = _templates(texts)

    def rows(part: pa.RecordBatch):
        best: list[dict[str, float]] = [{} for _ in range(part.num_rows)]
        for d, name, _, share in find(K.texts_of(part.column(1)), templates):
            best[d][name] = max(share, best[d].get(name, 0.0))
        kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64())]))
        return [part.column(0), pa.array([[{"license": n, "containment": s} for n, s in sorted(x.items())] for x in best], kind)]

    lowered = docs.select(docs[id_col].alias("id"), F.lower(docs[text_col].cast("string")).alias("text"))
    return map_texts(lowered, "id", "text", "licenses array<struct<license:string,containment:double>>", rows).withColumnRenamed("id", id_col)
