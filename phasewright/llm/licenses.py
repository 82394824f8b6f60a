"""License notices in texts: MinHash bands over overlapping windows, then exact containment.

Templates fall into classes by length (powers of two). A window has twice the shingles of its
class and windows step by half, so any notice lies whole in one of them and makes up at least a
quarter of it. Windows and templates share a band with probability 1 - (1 - s)^b for Jaccard s:
48 bands of one hash find s = 0.2 (four fifths of the shortest notice of a class) with 0.99998.
Window minima are minima of two neighbouring blocks. Retrieved templates are verified: the
share of their shingles that the text around the window holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.llm.text import id_key, id_of, whole

WORDS = 5
BANDS = 48

# Sentences of notices and full texts by the short name of their license. Each is cut so that another
# license or version holds less than four fifths of it; "GPL" and "BSD" are what the versions of a family share.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL", "terms of the GNU General Public License as published by the Free Software Foundation"),
    *(
        (f"{short}-{version}", text)
        for short, start, name, version, said in (
            ("GPL", "under the", "General", "2.0", "2"), ("GPL", "under the", "General", "3.0", "3"), ("AGPL", "the", "Affero General", "3.0", "3"),
            ("LGPL", "the", "Library General", "2.0", "2"), ("LGPL", "the", "Lesser General", "2.1", "2.1"), ("LGPL", "the", "Lesser General", "3.0", "3"))
        for text in (
            f"{start} GNU {name} Public License, version {said}",
            f"terms of the GNU {name} Public License as published by the Free Software Foundation, either version {said} of the License, or")
    ),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT"),
    ("BSD-3-Clause", "contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-1.0", "Eclipse Public License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights"),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to"),
    *(
        (f"CC-{short}-4.0", text)
        for short, name in (
            ("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-ND", "-NoDerivatives"), ("BY-NC", "-NonCommercial"), ("BY-NC-SA", "-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "-NonCommercial-NoDerivatives"))
        for text in (f"This work is licensed under a Creative Commons Attribution{name} 4.0 International License.", f"Licensed under CC {short} 4.0.")
    ),
)
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")


def words(text: str | None) -> list[str]:
    """Lower-cased words without outer punctuation; words of punctuation only are left out."""
    own = [_EDGE.sub("", w) if not (w[0].isalnum() and w[-1].isalnum()) else w for w in (text or "").lower().split()]
    return [w for w in own if w]


def shingles(own: Sequence[str]) -> np.ndarray:
    """Hashes of the 5-word shingles in order; empty for fewer words."""
    n = len(own) - WORDS + 1
    if n < 1:
        return np.empty(0, np.uint64)
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in own), np.uint64, len(own))
    out = np.zeros(n, np.uint64)
    for i in range(WORDS):
        out = (out ^ hashed[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Templates:
    """Templates by class with their minima under each band's hash."""

    def __init__(self, templates: Sequence[tuple[str, str]], seed: int = 13):
        self.names = [name for name, _ in templates]
        self.sets = [np.unique(shingles(words(text))) for _, text in templates]
        short = [text for (_, text), s in zip(templates, self.sets, strict=True) if not len(s)]
        if short:
            raise ValueError(f"templates need at least {WORDS} words: {short}")
        draw = np.random.default_rng(seed)
        self.a = (draw.integers(0, 2**32, BANDS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
        self.b = draw.integers(0, 2**32, BANDS, dtype=np.uint64).astype(np.uint32)
        self.classes: dict[int, list[int]] = {}
        for i, s in enumerate(self.sets):
            self.classes.setdefault(1 << max(0, (len(s) - 1).bit_length()), []).append(i)
        self.minima = [self.hashed(s).min(axis=1) for s in self.sets]

    def hashed(self, s: np.ndarray) -> np.ndarray:
        folded = (s ^ (s >> np.uint64(32))).astype(np.uint32)
        return folded[None, :] * self.a[:, None] + self.b[:, None]

    def candidates(self, s: np.ndarray, chunk: int = 1 << 15) -> set[tuple[int, int]]:
        """(template, first shingle of a window) pairs that share a band."""
        found = set()
        most = max(self.classes)
        for begin in range(0, len(s), chunk):
            # chunks overlap by the longest window, so none is cut
            part = s[begin : begin + chunk + 2 * most]
            values = self.hashed(part)
            for size, members in self.classes.items():
                blocks = np.minimum.reduceat(values, np.arange(0, values.shape[1], size), axis=1)
                windows = np.minimum(blocks[:, :-1], blocks[:, 1:]) if blocks.shape[1] > 1 else blocks
                for t in members:
                    hit = (windows == self.minima[t][:, None]).any(axis=0)
                    found.update((t, begin + int(i) * size) for i in np.flatnonzero(hit))
        return found

    def matches(self, text: str | None, least: float) -> list[tuple[str, float, int]]:
        """(license, containment, first word) of every template that a place in the text holds."""
        s = shingles(words(text))
        best: dict[str, tuple[float, int]] = {}
        for t, first in sorted(self.candidates(s)) if len(s) else ():
            own = self.sets[t]
            size = 1 << max(0, (len(own) - 1).bit_length())
            low = max(0, first - size)
            region = s[low : first + 3 * size]
            held = np.isin(region, own)
            share = len(np.unique(region[held])) / len(own)
            if share >= least:
                at = low + int(np.flatnonzero(held)[0])
                known = best.get(self.names[t], (0.0, 0))
                best[self.names[t]] = max(known, (share, at), key=lambda x: (x[0], -x[1]))
        return [(name, share, at) for name, (share, at) in sorted(best.items())]


def _scan(batches: Iterator[pd.DataFrame], templates: Sequence[tuple[str, str]], least: float) -> Iterator[pd.DataFrame]:
    known = Templates(templates)
    for batch in batches:
        rows = [(doc_id, *m) for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True) for m in known.matches(text, least)]
        yield pd.DataFrame(rows, columns=["doc_id", "license", "containment", "first_word"]).astype({"doc_id": "int64", "containment": "float64", "first_word": "int64"})


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = 0.8, max_templates: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document and license it shows: ``doc_id``, ``license``, ``containment``, ``first_word``.

    ``containment`` is the share of the template's 5-word shingles found there, at least
    ``least``; ``first_word`` counts words as ``words`` does. Templates travel with the tasks, so
    there is a stated limit to their number; longer lists are scanned in several calls. Null,
    empty and shorter texts show none; repeated rows are scanned each.
    """
    if len(templates) > max_templates:
        raise ValueError(f"{len(templates)} templates; scan at most {max_templates} in one call")
    rows = docs.select(id_key(F.col(id_col)).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    run = lambda batches: _scan(batches, templates, least)
    out = rows.mapInPandas(run, "doc_id long, license string, containment double, first_word long")
    return out.withColumn("doc_id", id_of(F.col("doc_id")))
