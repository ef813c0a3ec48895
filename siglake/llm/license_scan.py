"""License scan by a positional index of rare tokens.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` (ASCII letters in lower case).
The templates of ``TEMPLATES`` are indexed: each of their words has postings
(template, place). The inverse document frequency of the words is counted over the
whole table; the table of counts has one row for each word of the templates.

1. A file keeps its licence words with their places; all others are skipped at once.
2. A base phrase is anchored at its word of highest IDF: wherever the file has that
   word, the other words must stand at their places relative to it. No place is missed.
3. For whole templates the file's licence words are taken in the order of their
   IDF, rarest first, ``RARE`` distinct ones of each template. Each occurrence votes
   for (template, place in the file - place in the template). Starts within ``SLACK``
   words of each other, which small changes of the wording cause, count together.
4. A start with enough of the rare words is verified: the share of the template's
   words, weighted by IDF, that stand in order in that stretch of the file must reach
   ``SHARE``, and the template's mandatory key phrases must stand in it.
5. Labels of verified templates are added to those of the base phrases. The score is
   the best weighted share; a base phrase alone scores the share of its own words, 1.

Defined cases: a null or empty text has no words and no labels; very long texts are
read whole; rows that repeat an id each have a row; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import _LOWER, chunked, span_hashes, string_buffers

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label: (text, mandatory key phrases). The usual notices of public licences.
TEMPLATES: dict[str, tuple[str, list[str]]] = {
    "mit": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction", ["permission is hereby granted"]),
    "apache-2": ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                 "compliance with the License", ["apache license"]),
    "gpl-2": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation; either version 2 of the License",
              ["general public license", "version 2"]),
    "gpl-3": ("licensed under the GNU General Public License, version 3", ["gnu general public license", "version 3"]),
    "lgpl": ("licensed under the GNU Lesser General Public License", ["lesser general public license"]),
    "agpl-3": ("licensed under the GNU Affero General Public License, version 3", ["affero general public license"]),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met", ["redistribution and use in source and binary forms"]),
    "mpl-2": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ["mozilla public license"]),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted", ["with or without fee"]),
    "cc-by-sa": ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
                 ["creative commons", "sharealike"]),
    "cc-by-nc": ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
                 ["creative commons", "noncommercial"]),
    "cc-by": ("licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4"]),
    "cc0": ("the person who associated a work with this deed has dedicated the work to the public domain by waiving all of "
            "his or her rights to the work worldwide", ["public domain"]),
    "unlicense": ("This is free and unencumbered software released into the public domain", ["free and unencumbered"]),
}
RARE = 6                 # distinct words of a template, highest IDF first, that find its starts
ENOUGH = 3               # of them that a start needs (all, where a template has fewer)
SLACK = 3                # words by which starts may differ and count together
SHARE = 0.75             # share of a template's weight that stands in order

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_NOT = np.zeros(256, bool)
_NOT[0x00:0x30] = _NOT[0x3A:0x61] = _NOT[0x7B:0x80] = True


def split_words(text: str) -> list[str]:
    return _WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first bytes, end bytes, words of each row) of lower-cased bytes."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    word = ~_NOT[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    row = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
    first[row], last[row - 1] = word[row], word[row - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))


class Vocabulary:
    """The words of all templates, and each word of a batch as its number or -1; equal hashes are compared in full."""

    def __init__(self, words: list[str]):
        self.words = sorted(set(words))
        raw = [w.encode() for w in self.words]
        ends = np.cumsum([len(w) for w in raw]) if raw else np.zeros(0, np.int64)
        h = span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - np.array([len(w) for w in raw], np.int64), ends)
        order = np.argsort(h)
        self.hashes, self.number, self.raw = h[order], order, raw
        self.at = {w: i for i, w in enumerate(self.words)}

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = span_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
        out = np.full(len(h), -1, np.int64)
        for i in np.flatnonzero(self.hashes[at] == h).tolist() if len(self.hashes) else []:
            k = int(self.number[at[i]])
            if data[starts[i]:ends[i]].tobytes() == self.raw[k]:
                out[i] = k
        return out


@dataclass
class Index:
    """Positional postings of the templates' words; ``idf`` weighs them."""

    idf: dict[str, float]
    base: dict[str, str] = field(default_factory=lambda: BASE)
    templates: dict[str, tuple[str, list[str]]] = field(default_factory=lambda: TEMPLATES)

    def __post_init__(self):
        self.phrases = [(split_words(p), label) for p, label in self.base.items()]
        self.texts = [(label, split_words(t), [split_words(k) for k in keys]) for label, (t, keys) in self.templates.items()]
        self.vocabulary = Vocabulary([w for p, _ in self.phrases for w in p] + [w for _, t, _ in self.texts for w in t]
                                     + [w for _, _, keys in self.texts for k in keys for w in k])
        n = self.vocabulary.at
        weight = [self.idf.get(w, 0.0) for w in self.vocabulary.words]
        self.weight = np.array(weight)
        self.phrases = [([n[w] for w in p], label) for p, label in self.phrases]
        # the anchor of a phrase: its word of highest IDF, the first of equals
        self.anchors = [int(np.argmax(self.weight[p])) for p, _ in self.phrases]
        self.texts = [(label, np.array([n[w] for w in t]), [[n[w] for w in k] for k in keys]) for label, t, keys in self.texts]
        self.postings: dict[int, list[tuple[int, int]]] = {}
        self.needed = []
        for i, (_, t, _) in enumerate(self.texts):
            rare = sorted(set(t.tolist()), key=lambda w: (-self.weight[w], w))[:RARE]
            self.needed.append(min(ENOUGH, len(rare)))
            for place, w in enumerate(t.tolist()):
                if w in rare:
                    self.postings.setdefault(w, []).append((i, place))

    def places(self, phrase: list[int], anchor: int, held: dict[int, set[int]]) -> list[int]:
        """Starts of a phrase: places of its anchor at whose sides the other words stand."""
        return sorted(p - anchor for p in held.get(phrase[anchor], ())
                      if all(p - anchor + k in held.get(w, ()) for k, w in enumerate(phrase) if k != anchor))

    def starts(self, held: dict[int, set[int]]) -> dict[int, list[int]]:
        """Template: places where enough of its rare words say it starts."""
        votes: dict[int, list[tuple[int, int]]] = {}
        for w in sorted(held.keys() & self.postings.keys(), key=lambda w: -self.weight[w]):
            for i, place in self.postings[w]:
                votes.setdefault(i, []).extend((p - place, w) for p in held[w])
        out: dict[int, list[int]] = {}
        for i, cast in votes.items():
            cast.sort()
            lo = 0
            for hi in range(len(cast)):
                while cast[hi][0] - cast[lo][0] > SLACK:
                    lo += 1
                if len({w for _, w in cast[lo:hi + 1]}) >= self.needed[i]:
                    begin = cast[lo][0]
                    if not out.get(i) or begin - out[i][-1] > SLACK:
                        out.setdefault(i, []).append(begin)
        return out

    def verified(self, i: int, start: int, held: dict[int, set[int]]) -> float:
        """Weighted share of template ``i`` that stands in order from about ``start``, 0 without its key phrases."""
        _, text, keys = self.texts[i]
        lo, hi = start - SLACK, start + len(text) + 2 * SLACK
        near = {w: {p for p in held.get(w, ()) if lo <= p < hi} for w in {*text.tolist(), *(w for k in keys for w in k)}}
        if not all(self.places(k, 0, near) for k in keys):
            return 0.0
        at, got = lo - 1, 0.0
        for k, w in enumerate(text.tolist()):
            # the next place of the word, not far from where it should stand
            nxt = min((p for p in near[w] if at < p <= start + k + 2 * SLACK), default=None)
            if nxt is not None:
                at, got = nxt, got + self.weight[w]
        total = float(self.weight[text].sum())
        return got / total if total else 0.0

    def scan(self, words: np.ndarray, places: np.ndarray) -> tuple[int, int | None, int | None, set[str], set[str], float]:
        """(n_base, first_word, last_word, base labels, all labels, score) of a file's licence words at their places."""
        held: dict[int, set[int]] = {}
        for w, p in zip(words.tolist(), places.tolist()):
            held.setdefault(w, set()).add(p)
        n, found, labels = 0, [], set()
        for (phrase, label), anchor in zip(self.phrases, self.anchors):
            got = self.places(phrase, anchor, held)
            n += len(got)
            found += got
            labels |= {label} if got else set()
        every, score = set(labels), 1.0 if labels else 0.0
        for i, begins in self.starts(held).items():
            share = max((self.verified(i, s, held) for s in begins), default=0.0)
            if share >= SHARE:
                every.add(self.texts[i][0])
                score = max(score, share)
        return n, min(found, default=None), max(found, default=None), labels, every, round(min(1.0, score), 6)


def licence_idf(docs: DataFrame, text_col: str = "text", base: dict[str, str] = BASE,
                templates: dict[str, tuple[str, list[str]]] = TEMPLATES) -> dict[str, float]:
    """IDF of each word of the templates over all rows: log of rows over (rows that hold it + 1), 0 at least.

    One row for each word of the templates comes to the driver, whatever the table's size.
    """
    words = Vocabulary([w for p in base for w in split_words(p)] + [
        w for t, keys in templates.values() for x in (t, *keys) for w in split_words(x)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rows = np.zeros(len(words.words), np.int64), 0
        for b in chunked(batches, 4 << 20):
            rows += b.num_rows
            data, off = string_buffers(b.column(0))
            data = _LOWER[data]
            starts, ends, per_row = word_spans(data, off)
            found = words(data, starts, ends)
            row = np.repeat(np.arange(b.num_rows), per_row)
            hit = np.unique(np.stack([row[found >= 0], found[found >= 0]], 1), axis=0)
            n += np.bincount(hit[:, 1], minlength=len(n))
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(len(n))], pa.int32()), pa.array([rows, *n.tolist()], pa.int64())], names=["word", "n"])

    got = {r["word"]: r["n"] for r in docs.select(F.col(text_col).alias("text")).mapInArrow(
        count, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = got.get(-1) or 0
    return {w: max(0.0, float(np.log((total + 1) / (got.get(i, 0) + 1)))) for i, w in enumerate(words.words)}


_FOUND = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
          "score double")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", idf: dict[str, float] | None = None
                  ) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of ``docs``."""
    weights = licence_idf(docs, text_col) if idf is None else idf
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(weights)
        for b in chunked(batches, 2 << 20):
            data, off = string_buffers(b.column(1))
            data = _LOWER[data]
            starts, ends, per_row = word_spans(data, off)
            known = index.vocabulary(data, starts, ends)
            at = np.flatnonzero(known >= 0)
            begin = np.cumsum(per_row) - per_row
            cut = np.searchsorted(at, np.append(begin, len(known)))
            out = [index.scan(known[at[lo:hi]], at[lo:hi] - begin[i]) if hi > lo else (0, None, None, set(), set(), 0.0)
                   for i, (lo, hi) in enumerate(zip(cut.tolist(), cut[1:].tolist()))]
            n, first, last, base, labels, score = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(per_row, pa.int64()), *(pa.array(c, pa.int64()) for c in (n, first, last)),
                 *(pa.array([",".join(sorted(x)) for x in c], pa.string()) for c in (base, labels)),
                 pa.array(score, pa.float64())],
                names=["doc_id", *(f.split(" ")[0] for f in _FOUND.split(", "))])

    return rows.mapInArrow(apply, f"doc_id {id_type}, {_FOUND}")
