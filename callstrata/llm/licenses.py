"""License notices in documents: MinHash bands over text windows, then exact shingle containment."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import Codes, limit_batches, mixed, remember_only, slices, text_key

WORD = regex.compile(r"\w+")
SHINGLE, CONTAINED = 5, 0.8
#: Chance with which a window that holds a template shares a band with it.
SURE = 0.999
#: Templates are sent to every task; their total length is checked against this many words.
TEMPLATE_WORDS = 2_000_000

# Short public notices by which a text states its license.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
}

CODES = Codes()


@dataclass(frozen=True)
class Shape:
    """Templates of one length, and the windows they are looked for in.

    A window is half as long again as the template and windows start every half template, so some
    window holds any occurrence whole. It shares at least `share` of the joint shingles with a
    template of which 0.8 occur in it, so with bands of one MinHash value each,
    1 - (1 - share) ** bands >= 0.999.
    """

    words: int
    width: int
    step: int
    window: int
    bands: int


def shape_of(words: int) -> Shape:
    width = min(SHINGLE, words)
    step = max(1, words // 2)
    window = words + step
    own, around = words - width + 1, window - width + 1
    share = CONTAINED * own / (around + (1 - CONTAINED) * own)
    return Shape(words, width, step, window, ceil(log(1 - SURE) / log(1 - share)))


def word_codes(text: str | None) -> np.ndarray:
    found = WORD.findall((text or "").lower())
    return CODES.of(found, len(found))


def shingles(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` words, never 0."""
    n = max(0, len(codes) - width + 1)
    out = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = mixed(out * np.uint64(31) + codes[k: k + n])
    return out | np.uint64(1)


def seeded(hashes: np.ndarray, band: int) -> np.ndarray:
    """The hashes in the order of one band (an odd factor permutes 64-bit numbers; 0 stays 0)."""
    with np.errstate(over="ignore"):
        return hashes * (mixed(np.array([band + 1], np.uint64)) | np.uint64(1))[0]


class Templates:
    """Templates by length, with their band values and shingle sets."""

    def __init__(self, texts: Mapping[str, str]):
        self.shingles: dict[str, frozenset[int]] = {}
        self.shapes: dict[Shape, list[dict[int, list[str]]]] = {}
        total = 0
        for name in sorted(texts):
            codes = word_codes(texts[name])
            total += len(codes)
            if not len(codes):
                continue
            shape = shape_of(len(codes))
            own = shingles(codes, shape.width)
            self.shingles[name] = frozenset(own.tolist())
            bands = self.shapes.setdefault(shape, [defaultdict(list) for _ in range(shape.bands)])
            for band, values in enumerate(bands):
                values[int(seeded(own, band).max())].append(name)
        if total > TEMPLATE_WORDS:
            raise ValueError(f"templates of {total} words; at most {TEMPLATE_WORDS} can be sent to every task")

    def scan(self, codes: np.ndarray, first: np.ndarray, sizes: np.ndarray):
        """(text, template, first word, last word, containment) of all windows that hold a template.

        The MinHash of a window is the greatest seeded hash in it. Greatest values over 1, 2, 4, ...
        places are computed once per band; two of them cover a window of any length.
        """
        for width in sorted({shape.width for shape in self.shapes}):
            hashes = np.zeros(len(codes), np.uint64)
            own = shingles(codes, width)
            hashes[: len(own)] = own
            for k in range(1, width):  # runs that reach into the next text
                hashes[np.maximum(first + sizes - k, 0)[sizes >= k]] = 0
            plans = [(shape, *windows(first, sizes, shape)) for shape in self.shapes if shape.width == width]
            plans = [plan for plan in plans if len(plan[1])]
            found: dict[tuple[int, int], set[str]] = defaultdict(set)
            for band in range(max((shape.bands for shape, *_ in plans), default=0)):
                active = [(i, *plan) for i, plan in enumerate(plans) if band < plan[0].bands]
                reach = [seeded(hashes, band)]
                while 2 << len(reach) - 1 <= max(int(lengths.max()) for _, _, _, lengths, _ in active):
                    half, step = reach[-1], 1 << len(reach) - 1
                    both = half.copy()
                    np.maximum(half[:-step], half[step:], out=both[:-step])
                    reach.append(both)
                for i, shape, starts, lengths, _ in active:
                    values = self.shapes[shape][band]
                    top = greatest(reach, starts, lengths)
                    for w in np.nonzero(listed(top, values))[0].tolist():
                        found[i, w].update(values[int(top[w])])
            for (i, w), names in found.items():
                shape, starts, lengths, texts = plans[i]
                start, text = int(starts[w]), int(texts[w])
                part = hashes[start: start + int(lengths[w])].tolist()
                for name in sorted(names):
                    template = self.shingles[name]
                    hit = [k for k, h in enumerate(part) if h in template]
                    containment = len({part[k] for k in hit}) / len(template)
                    if containment >= CONTAINED:
                        base = start - int(first[text])
                        yield text, name, base + hit[0], base + hit[-1] + shape.width - 1, containment


def greatest(reach: list[np.ndarray], starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Greatest value of each window from the greatest values over powers of two."""
    if lengths.min() == lengths.max():
        power = int(lengths[0]).bit_length() - 1
        return np.maximum(reach[power][starts], reach[power][starts + lengths - (1 << power)])
    out = np.zeros(len(starts), np.uint64)
    for power in range(len(reach)):
        own = np.nonzero((lengths >> power) == 1)[0]
        out[own] = np.maximum(reach[power][starts[own]], reach[power][starts[own] + lengths[own] - (1 << power)])
    return out


def listed(values: np.ndarray, wanted: Mapping[int, list[str]]) -> np.ndarray:
    keys = np.sort(np.fromiter(wanted, np.uint64, len(wanted)))
    if len(keys) <= 8:
        out = np.zeros(len(values), bool)
        for key in keys:
            out |= values == key
        return out
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def windows(first: np.ndarray, sizes: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First shingle, number of shingles and text of all windows: every step, the last one ending with
    its text; a text shorter than a window is one window."""
    per = shape.window - shape.width + 1
    usable = np.nonzero(sizes >= shape.width)[0]
    have = sizes[usable] - shape.width + 1
    counts = np.maximum(1, -(-(have - per) // shape.step) + 1)
    texts = np.repeat(usable, counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    last = np.maximum(np.repeat(have, counts) - per, 0)
    return first[texts] + np.minimum(number * shape.step, last), np.minimum(np.repeat(have, counts), per), texts


def licenses(docs: DataFrame, templates: Mapping[str, str] = NOTICES) -> DataFrame:
    """(doc_id, text_key, license, first_word, last_word, containment) of every notice found.

    Words are lower-cased runs of letters, digits and underscores; a template of fewer than five
    words is one shingle. A notice counts if some window holds at least 0.8 of the template's
    shingles; overlapping windows with the same notice give one row, from its first to its last
    word, with the best containment. Null, empty and short texts and templates without words match
    nothing. Repeated rows have repeated results. Only doc_id and text are read.
    """
    limit_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(Templates(templates))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_only(CODES)
        for batch in batches:
            for at, texts in slices(batch.column(2)):
                parts = [word_codes(x) for x in texts]
                sizes = np.array([len(x) for x in parts], np.int64)
                rows = joined(known.value.scan(np.concatenate(parts), np.cumsum(sizes) - sizes, sizes))
                where = pa.array([at + r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(where), batch.column(1).take(where),
                     *[pa.array([r[k] for r in rows], t) for k, t in
                       ((1, pa.string()), (2, pa.int64()), (3, pa.int64()), (4, pa.float64()))]],
                    ["doc_id", "text_key", "license", "first_word", "last_word", "containment"])

    return docs.where(F.col("text").isNotNull()).select(
        "doc_id", text_key(F.col("text")).alias("text_key"), "text"
    ).mapInArrow(run, f"doc_id {kind}, text_key bigint, license string, first_word bigint, last_word bigint, containment double")


def joined(found) -> list[tuple[int, str, int, int, float]]:
    """Overlapping finds of one notice in one text as one."""
    out: list[tuple[int, str, int, int, float]] = []
    for row in sorted(found):
        if out and out[-1][:2] == row[:2] and row[2] <= out[-1][3]:
            out[-1] = (*row[:2], out[-1][2], max(out[-1][3], row[3]), max(out[-1][4], row[4]))
        else:
            out.append(row)
    return out
