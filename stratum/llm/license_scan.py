"""License scan by exact set-similarity join (operator 7).

A text block is a window of the document's words, across its lines, at most
``1 / THRESHOLD`` times as long as the template; block and template are sets
of words.  A block meets a template if it holds at least ``THRESHOLD`` of the
template's words and the words that tell its license from others.

1. Document frequencies of the templates' words are counted over the whole
   corpus; sets are ordered by them, rarest first, ties by the word.
2. Filters on whole documents, which hold all of their windows.  Prefix
   filter: of a template of n words with need c = ceil(THRESHOLD * n), a block
   that meets it holds one of the first n - c + 1.  Length filter: the
   document has at least c different words.  Positional filter: a first common
   word at place i leaves at most n - i common words, which must reach c.
3. For the templates that are left, the longest window that ends at each of
   their words is verified; it begins at the last place that keeps its words.

Templates are a fixed, small list (a parameter); documents are scanned where
they lie.  ``license_blocks`` returns every line in which such a window begins;
``scan`` also counts the fixed phrases.

Words: runs of digits, letters and characters from U+0080 on, A-Z in lower
case.  Rows: a null text is empty; a null or repeated ``doc_id`` is kept, each
row by itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.words import batched

THRESHOLD = 0.8

#: Phrases whose words must stand consecutively.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

#: Sentences by which licenses are commonly granted.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

#: Words that tell a template's license from others of nearly the same words, by a word of the template:
#: all of the first must stand in a block that meets the template, none of the second.
SPECIFIC = (
    ("mit license", "mit", ""),
    ("apache license", "apache 2", ""),
    ("cc by nc", "nc", "sa nd"),
    ("attribution noncommercial", "noncommercial", "sharealike noderivatives noderivs"),
    ("attribution sharealike", "sharealike", "noncommercial"),
    ("gnu general public license version 3", "gnu general 3", "lesser library affero"),
    ("gnu general public license", "gnu general", "lesser library affero"),
    ("mozilla public license", "mozilla 2", ""),
)

_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def block_words(data: bytes) -> list[bytes]:
    return data.translate(_TABLE).split()


def template_sets(templates=TEMPLATES) -> list[tuple[str, frozenset[bytes]]]:
    return [(label, frozenset(block_words(text.encode()))) for label, text in templates]


def specific(text: str) -> tuple[frozenset[bytes], frozenset[bytes]]:
    """The words that a block of this template must hold, and those that it must not."""
    line = b" ".join([b"", *block_words(text.encode()), b""])
    for phrase, needs, bars in SPECIFIC:
        if f" {phrase} ".encode() in line:
            return frozenset(needs.encode().split()), frozenset(bars.encode().split())
    return frozenset(), frozenset()


def frequencies(docs: DataFrame, words: frozenset[bytes]) -> dict[bytes, int]:
    """How many blocks of the corpus hold each of these words."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                for line in (text.as_py() or "").encode("utf-8", "replace").translate(_LINES).split(b"\n"):
                    seen.update(words.intersection(line.split()))
        yield from batched(seen.items(), schema)

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r[0]): r[1] for r in counted.collect()}  # at most one row for each template word


_LINES = _TABLE[:10] + b"\n" + _TABLE[11:]


class Templates:
    """The templates in the global order, with their prefixes as an index."""

    def __init__(self, templates, counts: dict[bytes, int], threshold: float):
        self.sets = []
        self.index: dict[bytes, list[tuple[int, int]]] = {}
        for (label, words), (_, text) in zip(template_sets(templates), templates, strict=True):
            order = sorted(words, key=lambda w: (counts.get(w, 0), w))
            need = math.ceil(threshold * len(order) - 1e-9)
            for place, w in enumerate(order[: len(order) - need + 1]):
                self.index.setdefault(w, []).append((len(self.sets), place))
            self.sets.append((label, words, need, math.ceil(len(block_words(text.encode())) / threshold - 1e-9), *specific(text)))
        self.prefixes = frozenset(self.index)

    def meets(self, words: list[bytes]) -> Iterator[tuple[str, int, float]]:
        """(label, place of the first word, containment) of the windows that meet a template."""
        block = set(words)
        places: dict[int, int] = {}
        for w in self.prefixes.intersection(block):
            for t, place in self.index[w]:
                places[t] = min(place, places.get(t, place))
        for t, place in places.items():
            label, own, need, longest, needs, bars = self.sets[t]
            if len(block) >= need and len(own) - place >= need and len(own & block) >= need and needs <= block:
                for first, both in windows(words, own, longest, needs, bars):
                    if both >= need:
                        yield label, first, both / len(own)


def windows(words: list[bytes], own: frozenset[bytes], longest: int, needs: frozenset[bytes] = frozenset(), bars: frozenset[bytes] = frozenset()) -> Iterator[tuple[int, int]]:
    """(first place, different words of ``own``) of the longest window that ends at each word of ``own``.

    Only windows with all of ``needs`` (of ``own``) and none of ``bars``.
    """
    held: dict[bytes, int] = {}  # word -> its last place, oldest first
    for end, w in enumerate(words):
        if w in bars:
            held.clear()
        elif w in own:
            held.pop(w, None)
            held[w] = end
            while (first := next(iter(held.values()))) <= end - longest:
                del held[next(iter(held))]
            if needs <= held.keys():
                yield first, len(held)


def phrase_places(words: list[bytes], phrases: dict[str, bytes]) -> Iterator[tuple[str, int]]:
    """(label, first word) of each place where a phrase stands."""
    line = b" ".join([b"", *words, b""])
    for label, phrase in phrases.items():
        at = line.find(phrase)
        while at >= 0:
            yield label, line.count(b" ", 0, at)
            at = line.find(phrase, at + 1)


def _prepared(docs: DataFrame, templates, threshold: float) -> Templates:
    words = frozenset().union(*(s for _, s in template_sets(templates)))
    return Templates(templates, frequencies(docs, words), threshold)


def license_blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, block, label, containment``: each line (from 0) in which windows begin that meet a label, with the best containment."""
    ready = _prepared(docs, templates, threshold)
    schema = pa.schema([("doc_id", pa.int64()), ("block", pa.int64()), ("label", pa.string()), ("containment", pa.float64())])

    def rows(doc, text):
        lines = [block_words(line) for line in text.encode("utf-8", "replace").split(b"\n")]
        line_of = [n for n, line in enumerate(lines) for _ in line]
        met: dict[tuple[int, str], float] = {}
        for label, first, c in ready.meets([w for line in lines for w in line]):
            met[line_of[first], label] = max(c, met.get((line_of[first], label), 0.0))
        return [(doc, n, label, c) for (n, label), c in sorted(met.items())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched((row for batch in batches for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                            for row in rows(doc, text.as_py() or "")), schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, block long, label string, containment double")


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, phrases=None) -> DataFrame:
    """A row for each document: words, places of the phrases, labels of phrases and of templates met, best containment."""
    ready = _prepared(docs, templates, threshold)
    fixed = {label: f" {p} ".encode() for label, p in (phrases or PHRASES).items()}
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])

    def rows(doc, text):
        words = block_words(text.encode("utf-8", "replace"))
        found = list(phrase_places(words, fixed))
        met: dict[str, float] = {}
        for label, _, c in ready.meets(words):
            met[label] = max(c, met.get(label, 0.0))
        base, starts = {label for label, _ in found}, [p for _, p in found]
        return (doc, len(words), len(found), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | met.keys())), max(met.values(), default=0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched((rows(d, t.as_py() or "") for batch in batches for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)), schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
