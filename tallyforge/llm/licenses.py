"""Licence notices and full licence texts in texts: MinHash bands over overlapping windows, then exact containment."""

from __future__ import annotations

from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyforge.llm import shingles

# Notices by which works name their licence (SPDX identifier, wording); full texts follow.
_NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("EPL-1.0", "are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'),
)


def _full_texts() -> tuple[tuple[str, str], ...]:
    files = sorted((resources.files("tallyforge.llm") / "notices").iterdir(), key=lambda f: f.name)
    return tuple((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files if f.name.endswith(".txt"))


TEMPLATES = _NOTICES + _full_texts()

# Words (lower case, one blank between) that a match has to hold somewhere, by licence; and words that no notice
# of fewer than LONG words may hold.
NEEDS = {
    "GPL-2.0": ("version 2",), "GPL-3.0": ("version 3",), "LGPL-2.1": ("lesser", "version 2 1"), "LGPL-3.0": ("lesser", "version 3"),
    "AGPL-3.0": ("affero", "version 3"), "EPL-1.0": ("eclipse", "1 0"), "EPL-2.0": ("eclipse", "2 0"),
    "CC-BY-SA-4.0": ("sharealike",), "CC-BY-4.0": ("4 0",), "Apache-2.0": ("version 2 0",), "BSL-1.0": ("boost",),
}
BARS = {"GPL-2.0": ("lesser", "library general", "affero"), "GPL-3.0": ("lesser", "affero"), "CC-BY-4.0": ("sharealike", "noncommercial", "noderivatives")}
LONG = 100

# At least this share of a notice's shingles has to be in a window.
PERCENT = 75
# A window that holds so much of a notice has a Jaccard similarity of at least 0.75 / (1.25 + 0.25) = 0.5
# with it, so one band of one row collides with a chance of at least 0.5 and all BANDS miss with at most
# 2 ** -BANDS.
BANDS, ROWS = 40, 1


class Notices:
    """The notices' shingles and bands."""

    def __init__(self, templates=TEMPLATES, size: int = shingles.WORDS):
        self.size, self.names, self.sets, self.words, self.places = size, [], [], [], []
        self.seeds = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
        self.bands: dict[tuple[int, bytes], list[int]] = {}
        for name, text in templates:
            _, starts, _, hashes, _ = shingles.words_of([text.encode()], shingles.PLAIN)
            if len(starts) < size:
                raise ValueError(f"the notice {text!r} has fewer than {size} words")
            found = shingles.windows(hashes, size)
            own, at = np.unique(found, return_index=True)
            for band, key in enumerate(self.signature(own)):
                self.bands.setdefault((band, key), []).append(len(self.names))
            self.names.append(name), self.sets.append(own), self.words.append(len(starts)), self.places.append(at)
        self.all = np.unique(np.concatenate(self.sets)) if self.sets else np.empty(0, np.uint64)
        self.lengths = sorted(set(self.words))
        self.least = {n: min(len(s) for s, w in zip(self.sets, self.words) if w == n) for n in self.lengths}

    def signature(self, own: np.ndarray) -> list[bytes]:
        least = shingles.mix(own[None, :] ^ self.seeds[:, None]).min(axis=1).reshape(BANDS, ROWS)
        return [row.tobytes() for row in least]

    def scan(self, found: np.ndarray, hit: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(notice, first word, words, shingles found) for the shingles of one text; ``hit`` marks those
        that some notice has. A window without any collides with no notice and is not looked at.

        Windows are a quarter longer than a notice and overlap in all but a quarter of its length, so a
        notice always lies in one. Windows of one notice that overlap are cut into its occurrences.
        """
        at = np.flatnonzero(hit)
        seen = len(np.unique(found[at]))
        out: list[tuple[int, int, int, int]] = []
        for words in self.lengths:
            if 100 * seen < PERCENT * self.least[words]:
                continue
            step = max(1, words // 4)
            span = words + step - self.size + 1
            first = np.maximum(0, -(-(at - span + 1) // step))
            last = np.minimum(at, max(0, len(found) - 1)) // step
            starts = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first.tolist(), last.tolist())])) * step
            best: dict[int, list[list[int]]] = {}
            for s in starts.tolist():
                window = np.unique(found[s : s + span])
                near = {t for band, key in enumerate(self.signature(window)) for t in self.bands.get((band, key), ())}
                for t in near:
                    if self.words[t] != words:
                        continue
                    common = int(np.isin(self.sets[t], window, assume_unique=True).sum())
                    if 100 * common < PERCENT * len(self.sets[t]):
                        continue
                    rows = best.setdefault(t, [])
                    if rows and s < rows[-1][3] + span:
                        if common > rows[-1][1]:
                            rows[-1][:2] = [s, common]
                        rows[-1][3] = s
                    else:
                        rows.append([s, common, s, s])
            for t, rows in best.items():
                for s, common, begin, end in rows:
                    single = self._occurrences(t, found, begin, end + span)
                    out += single
                    if single:
                        continue
                    inside = np.flatnonzero(np.isin(found[s : s + span], self.sets[t])) + s
                    out.append((t, int(inside[0]), int(inside[-1]) - int(inside[0]) + self.size, common))
        return sorted(set(out), key=lambda r: (r[1], r[0]))

    def _occurrences(self, t: int, found: np.ndarray, begin: int, end: int) -> list[tuple[int, int, int, int]]:
        """Where notice ``t`` stands in a stretch, each place on its own. A shingle says where its notice
        begins; one that says so half a notice or more behind the others, or that the place has already,
        belongs to the next place."""
        own, places = self.sets[t], self.places[t]
        at = np.flatnonzero(np.isin(found[begin:end], own)) + begin
        index = np.searchsorted(own, found[at])
        out, has, first, last, start = [], set(), 0, 0, 0

        def close() -> None:
            if has and 100 * len(has) >= PERCENT * len(own):
                out.append((t, first, last - first + self.size, len(has)))

        for p, k, begins in zip(at.tolist(), index.tolist(), (at - places[index]).tolist()):
            if not has or begins - start >= max(1, self.words[t] // 2) and (k in has or places[k] <= self.words[t] // 4):
                close()
                has, first, start = set(), p, begins
            has.add(k)
            last = p
        close()
        return out

    def settle(self, rows: list[tuple[int, int, int, int]], words: list[str]) -> list[tuple[int, int, int, int]]:
        """Matches that hold what their licence needs, less those that another licence fits better: it lies
        over most of the match and more of its own shingles are found, or as many and it is longer."""
        kept = []
        for row in rows:
            t, w, n, _ = row
            text, name = f" {' '.join(words[w : w + n])} ", self.names[t]
            bars = BARS.get(name, ()) if self.words[t] < LONG else ()
            if all(f" {x} " in text for x in NEEDS.get(name, ())) and not any(f" {x} " in text for x in bars):
                kept.append(row)
        fits = lambda r: (r[3] / len(self.sets[r[0]]), r[2])
        beats = lambda o, r: (
            self.names[o[0]] != self.names[r[0]] and 2 * (min(o[1] + o[2], r[1] + r[2]) - max(o[1], r[1])) > r[2] and fits(o) > fits(r)
        )
        return [r for r in kept if not any(beats(o, r) for o in kept)]


def scan(docs: DataFrame, templates=TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence notices of every whole text: doc_id, license, notice (index of the wording), n_shingles of
    the notice, n_found of them in the window, start_byte, end_byte, matched (that part of the text).

    Words are runs of letters and digits in lower case; shingles are five words. A match holds at least
    PERCENT of a notice's shingles and the words that tell its licence from others (NEEDS, BARS); where
    several licences match a stretch, the best fitting one is named. A stretch can match several wordings of
    one licence (a short one inside a longer one), and each occurrence is a row. The notices are few and known, so nothing is shuffled and a text is one row's work.

    Null, empty and shorter texts have no match and give no row; repeated rows and null ids are scanned
    like any; an empty table gives an empty result. Other columns are left out, whatever their names.
    """
    picked = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    notices = Notices(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out, rows = 0, [], []
            for texts in shingles.portions(batch.column("text")):
                _, starts, ends, hashes, first = shingles.words_of(texts, shingles.PLAIN)
                all_ = shingles.windows(hashes, notices.size)
                place = np.minimum(np.searchsorted(notices.all, all_), max(0, len(notices.all) - 1))
                hit = notices.all[place] == all_ if len(notices.all) else np.zeros(len(all_), bool)
                begin = np.cumsum([0] + [len(t) + 1 for t in texts])
                # Texts with a hit; a shingle that runs into the next text does not count.
                for i in np.unique(np.searchsorted(first, np.flatnonzero(hit), side="right") - 1).tolist():
                    a, b = int(first[i]), int(first[i + 1]) - notices.size + 1
                    if b <= a or not hit[a:b].any():
                        continue
                    matches = notices.scan(all_[a:b], hit[a:b])
                    words = [texts[i][x - begin[i] : y - begin[i]].lower().decode() for x, y in zip(starts[a : b + notices.size - 1], ends[a : b + notices.size - 1])] if matches else []
                    for t, w, n, common in notices.settle(matches, words):
                        lo, hi = int(starts[a + w] - begin[i]), int(ends[a + w + n - 1] - begin[i])
                        rows.append(at + i)
                        out.append((notices.names[t], t, len(notices.sets[t]), common, lo, hi, texts[i][lo:hi].decode()))
                at += len(texts)
            if out:
                types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                names = ["license", "notice", "n_shingles", "n_found", "start_byte", "end_byte", "matched"]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), *columns], names=["doc_id", *names])

    return picked.mapInArrow(
        run, f"doc_id {kind}, license string, notice int, n_shingles long, n_found long, start_byte long, end_byte long, matched string"
    )
