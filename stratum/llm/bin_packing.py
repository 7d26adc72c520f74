"""Best-fit packing with large-item matching (operator 10).

1. Tokenize every document once and cut it into pieces of at most the
   capacity; write one light row for each piece (no ids) to the shared folder.
2. Count pieces by length: at most ``capacity`` numbers, whatever the corpus.
   Pieces above a third of the capacity are paired, smaller ones best-fit the
   gaps (``slots.match_large``), on runs of equal lengths.
3. Rank the pieces of each length.  ``part``, written with the piece, deals
   the pieces of one length over ``parts`` groups, so that a length that a
   third of all pieces share is ranked by many tasks; the groups' counts give
   each group's first rank.
4. Look up each piece's place by length and rank.

Rows: a null text is empty (one piece with the end id alone); a null or
repeated ``doc_id`` is kept, each row is packed by itself; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.slots import Plan, match_large, place
from stratum.llm.stage import staged
from stratum.llm.tokens import ID_DTYPE, default_vocabulary, word_tokenizer

CAPACITY = 4096
END_ID = 1
PARTS = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, parts: int = PARTS) -> DataFrame:
    """One row for each piece of each document; the last piece may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end, n = word_tokenizer(vocabulary), np.array([END_ID], dtype=ID_DTYPE).tobytes(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids = batch.column(0).slice(at, 256).to_pylist()
                texts = [t or "" for t in batch.column(1).slice(at, 256).to_pylist()]
                rows: list[tuple] = []
                for doc, packed in zip(ids, tokenizer.encode_many(texts), strict=True):
                    tokens = np.frombuffer(packed + end, dtype=ID_DTYPE).astype("<u4")
                    for piece, start in enumerate(range(0, len(tokens), capacity)):
                        own = tokens[start : start + capacity]
                        rows.append((doc, piece, start, len(own), zlib.crc32(own.tobytes()), n % parts))
                        n += 1
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
                columns = [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "part"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY, parts: int = PARTS, planner=match_large) -> tuple[DataFrame, Plan]:
    """Adds ``sequence_id`` and ``offset`` to written pieces (``length``, ``part``); also returns the plan."""
    counts = pieces.groupBy("length", "part").count().toPandas()  # at most capacity x parts numbers
    table = np.zeros((capacity + 1, parts), dtype=np.int64)
    table[counts["length"].to_numpy(dtype=np.int64), counts["part"].to_numpy(dtype=np.int64)] = counts["count"].to_numpy()
    totals = table.sum(axis=1)
    plan = planner({int(s): int(totals[s]) for s in np.flatnonzero(totals)}, capacity)
    before, runs = np.cumsum(table, axis=1) - table, plan.arrays()

    def look_up(frames):
        for f in frames:
            size = f["length"].to_numpy(dtype=np.int64)
            rank = before[size, f["part"].to_numpy(dtype=np.int64)] + f["n"].to_numpy(dtype=np.int64) - 1
            f["sequence_id"], f["offset"] = place(runs, size, rank)
            yield f.drop(columns="n")

    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("n", F.row_number().over(order))
    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInPandas(look_up, schema), plan


def best_fit_packing(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = staged(token_pieces(docs, vocabulary or default_vocabulary(), capacity), "pieces")
    return pack(pieces, capacity)[0].drop("part")
