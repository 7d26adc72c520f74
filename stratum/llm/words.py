"""Words of whole texts as 64-bit hashes, and the streams of grouped rows that operators read."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard


class _Hashes(dict):
    """Word -> its hash, kept for repeated words; bounded by starting anew (hashes do not depend on it)."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()
_ODD = np.uint64(0x9E3779B97F4A7C15)  # an odd constant: multiplying by it permutes 64-bit numbers


def split_words(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII white space."""
    return text.lower().encode("utf-8", "replace").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def texts_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes of all these texts, one after the other, and each text's number of words.

    As ``word_hashes(split_words(t))`` of each, but a word is hashed once for all of them.
    """
    lists = pc.ascii_split_whitespace(pa.array([t.lower().encode("utf-8", "replace") for t in texts], type=pa.large_binary()).cast(pa.large_string()))
    words, counts = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    there = pc.binary_length(words).to_numpy() > 0  # Arrow puts an empty word beside outer white space
    before = np.concatenate([[0], np.cumsum(there, dtype=np.int64)])
    ends = np.cumsum(counts)
    coded = words.dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)), dtype=np.uint64, count=len(coded.dictionary))
    return hashes[coded.indices.to_numpy()[there]], before[ends] - before[ends - counts]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit numbers (two rounds of multiply and shift)."""
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in order; empty if there are fewer words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = hashes[:count].copy()
    for i in range(1, n):
        out = mixed(out) + hashes[i : i + count]
    return mixed(out)


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a text of fewer words has one, of all its words; none without words."""
    hashes = word_hashes(split_words(text))
    if not len(hashes):
        return hashes
    return np.unique(gram_hashes(hashes, min(n, len(hashes))))


def grouped(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of rows that are sorted by their first ``keys`` columns, across batches."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != now:
                if rows:
                    yield now, rows
                now, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield now, rows


def packed_columns(columns: list[np.ndarray]) -> bytes:
    """Columns of numbers as one compressed block; bytes of the same place stand together."""
    n = len(columns[0])
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(n, -1).T.tobytes() for c in columns))


def unpacked_columns(block: bytes, types: list[type]) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(block)
    sizes = [np.dtype(t).itemsize for t in types]
    n, at, out = len(data) // sum(sizes), 0, []
    for t, size in zip(types, sizes, strict=True):
        out.append(np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8, count=n * size, offset=at).reshape(size, n).T).view(t).reshape(n))
        at += n * size
    return out


def dealt_blocks(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """The rows of each bucket as a block, in their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    sides = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
    columns = [c[order] for c in columns]
    for s, e in pairwise(sides):
        yield int(bucket[order[s]]), packed_columns([c[s:e] for c in columns])


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
