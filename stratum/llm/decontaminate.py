"""Benchmark decontamination by pigeonhole edit matching (operator 5).

A test item of n words may have up to ``floor(ERRORS * n)`` = k word edits.
Cut into k + 1 pieces, one piece at least stands unchanged in any text that
holds the item with k edits.  An Aho-Corasick automaton finds all pieces of
all items in one pass over a text; each hit is verified by Myers' bit-parallel
distance, with words as letters, on the stretch around the hit.

Documents are scanned where they lie, without a shuffle.  The items travel to
the tasks in blocks of bounded size (``BLOCK_CHARS``); a larger benchmark
takes more passes, with the same result.

Words are runs of letters, digits and ``_`` in lower case.  Rows: a null text
or item, or one without words, matches nothing; items of fewer than 1 / ERRORS
words must stand unchanged; repeated items match each by its ``item_id``; a
null or repeated ``doc_id`` is kept, each row by itself; an empty table gives
no rows; other columns are kept and not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS = 0.2
BLOCK_CHARS = 20_000_000

_WORD = re.compile(r"\w+")
HITS = "array<struct<item_id: long, distance: int, start: int, end: int>>"


def item_words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def budget(n: int, errors: float = ERRORS) -> int:
    return int(errors * n + 1e-9)


def pieces(words: list[str], errors: float = ERRORS) -> list[tuple[int, list[str]]]:
    """``budget + 1`` nearly equal pieces with their places."""
    parts = budget(len(words), errors) + 1
    cuts = [len(words) * i // parts for i in range(parts + 1)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: list[str], text: list[str]) -> tuple[int, int]:
    """Least edit distance of the pattern to a stretch of the text, and where that stretch ends (the first of equals)."""
    m = len(pattern)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    plus, minus, score, best = mask, 0, m, (m, 0)
    for j, w in enumerate(text, 1):
        eq = where.get(w, 0)
        zero = ((((eq & plus) + plus) ^ plus) | eq | minus) & mask
        up, down = minus | (~(zero | plus) & mask), plus & zero
        score += bool(up & high) - bool(down & high)
        if score < best[0]:
            best = score, j
        up, down = up << 1 & mask, down << 1 & mask  # nothing is carried in: a stretch may start anywhere
        plus, minus = down | (~(zero | up) & mask), up & zero
    return best


class Items:
    """A block of items with the automaton over their pieces."""

    def __init__(self, rows: list[tuple[int, str]], errors: float):
        import ahocorasick

        self.errors, self.words = errors, {}
        places: dict[str, list[tuple[int, int, int]]] = {}
        for n, (item, text) in enumerate(rows):
            if words := item_words(text):
                self.words[n] = item, words
                for at, piece in pieces(words, errors):
                    places.setdefault(f" {' '.join(piece)} ", []).append((n, at, len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, own in places.items():
            self.automaton.add_word(piece, own)
        if places:
            self.automaton.make_automaton()

    def hits(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the items that stand in the text, each at its best place."""
        if not text or not self.words:
            return []
        line = " ".join(["", *_WORD.findall(text.lower()), ""])
        found, tried, words, spaces = {}, set(), None, None
        for end, own in self.automaton.iter(line):
            if spaces is None:
                words = line.split()
                spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), dtype="<u4") == 32)
            after = int(np.searchsorted(spaces, end))  # words up to the end of the piece
            for n, at, size in own:
                item, pattern = self.words[n]
                shift = after - size - at
                if (n, shift) in tried:
                    continue
                tried.add((n, shift))
                k = budget(len(pattern), self.errors)
                low = max(0, shift - k)
                stretch = words[low : max(0, shift + len(pattern) + k)]
                distance, stop = myers(pattern, stretch)
                if distance <= k and (n not in found or distance < found[n][1]):
                    # the start is where the reversed pattern ends in the reversed stretch
                    back = myers(pattern[::-1], stretch[:stop][::-1])[1]
                    found[n] = item, distance, low + stop - back, low + stop
        return sorted(found.values())


_BUILT: dict[str, Items] = {}


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    blocks = 1 + (items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars
    for b in range(blocks):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]


def hits_of(block: list[tuple[int, str]], docs: DataFrame, errors: float = ERRORS) -> Column:
    """The matches of a block of items in ``text``."""
    shared, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    @F.pandas_udf(HITS)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _BUILT:  # one automaton for each worker process
            _BUILT.clear()
            _BUILT[key] = Items(shared.value, errors)
        items = _BUILT[key]
        for part in texts:
            yield pd.Series([[dict(zip(("item_id", "distance", "start", "end"), h, strict=True)) for h in items.hits(t)] for t in part], dtype=object)

    return scan(F.col("text").cast("string"))


def contaminated(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, distance, start, end`` (words, end exclusive) of every item that stands in a document."""
    out = None
    for block in item_blocks(benchmark, block_chars):
        own = docs.select("doc_id", F.explode(hits_of(block, docs, errors)).alias("h")).select("doc_id", "h.*")
        out = own if out is None else out.unionByName(own)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents in which no item stands, with their columns."""
    out = docs
    for block in item_blocks(benchmark, block_chars):
        out = out.where(F.size(hits_of(block, docs, errors)) == 0)
    return out
