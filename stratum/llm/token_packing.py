"""Best-fit-decreasing packing into binary id matrices (operator 1).

Each task tokenizes its documents, gathers pieces until ``window_tokens``
tokens are there, and packs that window best-fit decreasing, with a segment
tree that finds the smallest room.  A window holds some thousand sequences,
so the last, partly filled sequences of a window weigh little; packing needs
no shuffle and no written intermediate, and a lost executor only repeats its
own tasks.  Documents longer than the capacity are cut without loss.

One row for each sequence:

* ``sequence_id`` (unique), ``n_tokens``
* ``input_ids``: ``capacity`` ids as little-endian unsigned 32-bit binary, padded with ``pad_id``
* ``cu_seqlens``: cumulative segment lengths, from 0 to ``n_tokens``
* ``position_ids``: binary as above; the position starts anew at 0 with each segment
* ``doc_ids``, ``starts``: each segment's document, and its first token there

A null text is empty (the end id alone); a null or repeated ``doc_id`` is
kept, each row by itself; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.slots import best_fit_decreasing, place
from stratum.llm.tokens import ID_DTYPE, default_vocabulary, word_tokenizer

CAPACITY = 2048
END_ID = 1
PAD_ID = 0
WINDOW_TOKENS = 4_000_000

SCHEMA = ("sequence_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids binary, "
          "doc_ids array<long>, starts array<long>")
ARROW = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("input_ids", pa.binary()),
                   ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary()),
                   ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64()))])


def pack_window(pieces: list[tuple[int | None, int, bytes]], capacity: int, pad_id: int, first: int) -> Iterator[pa.RecordBatch]:
    """Sequences of one window of pieces (doc_id, start, packed ids), numbered from ``first``."""
    width = ID_DTYPE.itemsize
    sizes = np.array([len(p[2]) // width for p in pieces], dtype=np.int64)
    plan = best_fit_decreasing(Counter(sizes.tolist()), capacity)
    order = np.argsort(sizes, kind="stable")
    rank = np.empty(len(sizes), dtype=np.int64)
    rank[order] = np.arange(len(sizes)) - np.searchsorted(sizes[order], sizes[order])
    bins, offsets = place(plan.arrays(), sizes, rank)
    rows: list[tuple] = []
    members = np.lexsort((offsets, bins))
    cuts = np.searchsorted(bins[members], np.arange(plan.bins + 1))
    for b in range(plan.bins):
        own = [pieces[i] for i in members[cuts[b] : cuts[b + 1]]]
        lengths = np.array([len(p[2]) // width for p in own])
        ends = np.cumsum(lengths)
        ids = np.full(capacity, pad_id, dtype="<u4")
        ids[: ends[-1]] = np.frombuffer(b"".join(p[2] for p in own), dtype=ID_DTYPE)
        positions = np.zeros(capacity, dtype="<u4")
        positions[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
        rows.append((first + b, int(ends[-1]), ids.tobytes(), [0, *ends.tolist()], positions.tobytes(),
                     [p[0] for p in own], [p[1] for p in own]))
        if len(rows) == 256 or b == plan.bins - 1:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)], schema=ARROW)
            rows = []


def packed_matrices(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                    pad_id: int = PAD_ID, window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """Token-id matrices of every document; see the module's docstring."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = word_tokenizer(path), np.array([end_id], dtype=ID_DTYPE).tobytes()
        step, first, held = capacity * ID_DTYPE.itemsize, TaskContext.get().partitionId() << 40, 0
        window: list[tuple[int | None, int, bytes]] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch.column(1).slice(at, 256).to_pylist()]
                for doc, packed in zip(batch.column(0).slice(at, 256).to_pylist(), tokenizer.encode_many(texts), strict=True):
                    packed += end
                    window += [(doc, s // ID_DTYPE.itemsize, packed[s : s + step]) for s in range(0, len(packed), step)]
                    held += len(packed) // ID_DTYPE.itemsize
                if held >= window_tokens:
                    for out in pack_window(window, capacity, pad_id, first):
                        first += out.num_rows
                        yield out
                    window, held = [], 0
        if window:
            yield from pack_window(window, capacity, pad_id, first)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
