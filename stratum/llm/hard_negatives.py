"""Hard negatives by angular triangle filtering (operator 13).

A row's score for an anchor is the integer inner product of their vectors,
each component of which is floor(256 x).

1. Index: every row stores its norm and its angles to ``REFERENCES``
   reference directions (rows picked by hash).  Rows are dealt by range of
   (label, nearest direction, angle to it) into blocks of ``block_rows`` rows
   at most, and a block's rows, in that order, into windows of ``WINDOW``.
2. Bounds: angles keep the triangle inequality, so from the angles of an
   anchor and the least and greatest angles of a block or window follows an
   interval of their angle, from it one of the cosine, and times the norms one
   of the score, widened by more than all rounding.
3. Positives: an anchor meets the blocks that may hold its label and reach
   the score that blocks of its label are sure to give; in them only windows
   that reach it are scored.
4. Negatives: the scores of an anchor's positives give the ranges in which
   its negatives lie; only blocks, and in them only windows, whose interval
   overlaps one of the ranges are scored.

Anchors are a stated query set (``vec_id`` divisible by 100 in the query);
they travel to the blocks, which are read once each, and pass through a task
one after the other.  No pair of rows is made outside a window's scoring, and
of a block's scores only the first few go on, to meet those of other blocks.
The bounds only save work: results are those of scoring everything.

``hard_negatives`` returns for each anchor and each of its first
``positives`` other rows of its label (by score descending, ``vec_id``
ascending) the first ``negatives`` rows of other labels with
``30 * positive_score <= 100 * negative_score <= 90 * positive_score``:
``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

Rows: a null ``vec_id``, label or vector, or a null or not finite component
(also once times 256) takes no part; rows that repeat a ``vec_id`` count as
one, that of the least label, then vector; a shorter vector ends in zeros;
ties go by ``vec_id``; scores beyond 64 bits stand at their limit; an anchor
without positives, or a positive without negatives, has no rows; an empty
table gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.stage import shuffle_partitions, staged

REFERENCES = 16
BLOCK_ROWS = 65_536
WINDOW = 64
POSITIVES = 5
NEGATIVES = 10
#: Relative widening of score bounds: angles near 0 are known to about 1e-7.
SLACK = 1e-6
#: Norms whose products stay below 2 ** 52, so that sums of doubles are exact.
EXACT_NORM = float(2**26)
CELLS = 2_000_000  # scores held at once


def _rows(embeddings: DataFrame, vector: str) -> DataFrame:
    """``vec_id, label, x``: the rows that take part, one for each ``vec_id``."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * 256) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """The lists as rows of doubles, shorter ones filled with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _norms(q: np.ndarray) -> np.ndarray:
    """Lengths; infinite where sums of doubles would not be exact."""
    with np.errstate(over="ignore"):
        out = np.sqrt((q * q).sum(axis=1))
    out[~(out < EXACT_NORM)] = np.inf
    return out


def angles(q: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of the rows to the reference directions (unit vectors); a right angle where there is none."""
    usable = (norms > 0) & np.isfinite(norms)
    cosines = np.zeros((len(q), len(references)))
    cosines[usable] = (q[usable] @ references.T) / norms[usable, None]
    return np.arccos(np.clip(cosines, -1, 1))


INDEX = "block long, vec_id long, label long, norm double, angles array<double>, q array<double>"
INDEX_ARROW = pa.schema([("block", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("norm", pa.float64()), ("angles", pa.list_(pa.float64())), ("q", pa.list_(pa.float64()))])


def _lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(np.ascontiguousarray(m).ravel()))


def index(embeddings: DataFrame, vector: str = "embedding", references: int = REFERENCES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every row that takes part with its block, norm and angles, written."""
    rows = staged(_rows(embeddings, vector), "vectors")
    dims = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 1)
    # the reference directions: as many rows as stated, with a length, picked by hash
    picked = rows.where(F.exists("x", lambda v: F.abs(v) >= 1 / 256)).orderBy(F.xxhash64("vec_id"), "vec_id").limit(references).select("x").collect()
    units = np.eye(1, dims) if not picked else np.array([[*r.x, *[0.0] * (dims - len(r.x))] for r in picked])
    units = units / np.abs(units).max(axis=1, keepdims=True)
    units = units / np.sqrt((units * units).sum(axis=1, keepdims=True))

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = np.floor(256 * _matrix(batch.column(2), dims))
            norms = _norms(q)
            a = angles(q, norms, units)
            near = a.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(norms), _lists(a), _lists(q), pa.array(near), pa.array(a[np.arange(len(a)), near])],
                                             names=["vec_id", "label", "norm", "angles", "q", "cell", "near"])

    out = rows.mapInArrow(measured, "vec_id long, label long, norm double, angles array<double>, q array<double>, cell long, near double")
    order = ["label", "cell", "near", "vec_id"]
    dealt = out.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)

    def blocked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            block = first + (n + np.arange(batch.num_rows)) // block_rows
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(block), *batch.columns[:5]], names=INDEX_ARROW.names)

    return staged(dealt.mapInArrow(blocked, INDEX), "vector-index")


def _summaries(rows: DataFrame, references: int) -> DataFrame:
    """For each block: its rows, labels, norms and angles, least and greatest."""
    of = [f(F.col("angles")[i]).alias(f"{n}{i}") for i in range(references) for n, f in (("low", F.min), ("high", F.max))]
    return rows.groupBy("block").agg(F.count("*").alias("size"), F.min("label").alias("label0"), F.max("label").alias("label1"), F.min("norm").alias("norm0"), F.max("norm").alias("norm1"), *of)


def _pairs(anchors: DataFrame, summaries: DataFrame, references: int, salts: int) -> DataFrame:
    """Each anchor with each block, and the bounds ``least`` and ``most`` of their scores.

    Both sides meet on a salt, which every block has once and every anchor one of.
    """
    spread = summaries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    own = anchors.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int"))
    both = own.join(spread, "salt")
    apart = F.greatest(F.lit(0.0), F.lit(0.0), *(x for i in range(references) for x in (F.col(f"low{i}") - F.col("angles")[i], F.col("angles")[i] - F.col(f"high{i}"))))
    wide = F.least(F.lit(np.pi), F.lit(np.pi), *(x for i in range(references) for x in (F.col("angles")[i] + F.col(f"high{i}"), 2 * np.pi - F.col("angles")[i] - F.col(f"low{i}"))))
    unknown = (F.col("norm") == float("inf")) | (F.col("norm1") == float("inf"))
    slack = F.col("norm") * F.col("norm1") * SLACK + 1

    def bound(cosine: Column, up: bool) -> Column:
        larger, smaller = (F.col("norm1"), F.col("norm0")) if up else (F.col("norm0"), F.col("norm1"))
        value = cosine * F.col("norm") * F.when(cosine >= 0, larger).otherwise(smaller)
        return F.when(unknown, F.lit(float("inf") if up else float("-inf"))).otherwise(value + slack if up else value - slack)

    return both.withColumn("least", bound(F.cos(wide), False)).withColumn("most", bound(F.cos(apart), True))


def window_bounds(a: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray, norm0: np.ndarray, norm1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) score of each anchor (angles ``a``, ``norms``) in each window."""
    apart = np.zeros((len(a), len(low)))
    wide = np.full((len(a), len(low)), np.pi)
    for i in range(a.shape[1]):
        own = a[:, i : i + 1]
        np.maximum(apart, np.maximum(low[:, i] - own, own - high[:, i]), out=apart)
        np.minimum(wide, np.minimum(own + high[:, i], 2 * np.pi - own - low[:, i]), out=wide)
    with np.errstate(invalid="ignore"):
        most, least = np.cos(apart), np.cos(wide)
        most = most * norms[:, None] * np.where(most >= 0, norm1, norm0)
        least = least * norms[:, None] * np.where(least >= 0, norm0, norm1)
        slack = norms[:, None] * norm1 * SLACK + 1
        unknown = ~np.isfinite(norms[:, None] + norm1)
        return np.where(unknown, -np.inf, least - slack), np.where(unknown, np.inf, most + slack)


def _scores(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; by doubles where those are exact, else by Python's whole numbers."""
    if exact:
        return (q @ x.T).astype(np.int64)
    whole = [[int(v) for v in row] for row in x.tolist()]
    most = 2**63 - 1
    return np.array([[max(-most, min(most, sum(s * t for s, t in zip(row, other)))) for other in whole] for row in ([int(v) for v in r] for r in q.tolist())],
                    dtype=np.int64).reshape(len(q), len(x))


class Block:
    """The rows of one block, and its windows."""

    def __init__(self, rows: pa.Table, window: int = WINDOW):
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.norms = rows["norm"].to_numpy()
        self.q = _matrix(rows["q"].combine_chunks(), len(rows["q"][0]))
        a = _matrix(rows["angles"].combine_chunks(), len(rows["angles"][0]))
        self.starts = np.arange(0, len(self.ids), window)
        self.stops = np.minimum(self.starts + window, len(self.ids))
        self.low, self.high = np.minimum.reduceat(a, self.starts), np.maximum.reduceat(a, self.starts)
        self.norm0, self.norm1 = np.minimum.reduceat(self.norms, self.starts), np.maximum.reduceat(self.norms, self.starts)

    def scored(self, q: np.ndarray, a: np.ndarray, norms: np.ndarray, wanted: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, places, scores) of the rows in windows that overlap one of the anchor's ``wanted`` ranges (rows: least, most)."""
        step = max(1, CELLS // len(self.ids))
        for at in range(0, len(q), step):
            part = slice(at, at + step)
            least, most = window_bounds(a[part], norms[part], self.low, self.high, self.norm0, self.norm1)
            meet = np.array([((most[i][:, None] >= w[:, 0]) & (least[i][:, None] <= w[:, 1])).any(axis=1) for i, w in enumerate(wanted[part])])
            held: list[tuple[list, list]] = [([], []) for _ in range(len(meet))]
            for n in np.flatnonzero(meet.any(axis=0)).tolist():
                own = np.flatnonzero(meet[:, n])
                rows = slice(self.starts[n], self.stops[n])
                scores = _scores(q[part][own], self.q[rows], bool(np.isfinite(norms[part][own].max() + self.norm1[n])))
                for i, s in zip(own.tolist(), scores):
                    held[i][0].append(np.arange(rows.start, rows.stop))
                    held[i][1].append(s)
            for i, (places, scores) in enumerate(held):
                if places:
                    yield at + i, np.concatenate(places), np.concatenate(scores)


def first(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` by score descending, id ascending."""
    if len(scores) > n:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:n]


def _met(rows: DataFrame, anchors: DataFrame, pick, result: str, schema: pa.Schema, partitions: int) -> DataFrame:
    """Blocks and the anchors sent to them meet; ``pick(block, places, scores, anchor)`` gives columns of results.

    ``anchors``: the index columns, ``block``, and the ranges ``wanted_least``, ``wanted_most`` (arrays), ``extra`` (array).
    """
    none = F.lit(None).cast("array<long>")
    columns = ["block", "kind", "vec_id", "label", "norm", "angles", "q", "wanted_least", "wanted_most", "extra"]
    sides = rows.select("block", F.lit(0).alias("kind"), "vec_id", "label", "norm", "angles", "q", none.alias("wanted_least"), none.alias("wanted_most"), none.alias("extra")).unionByName(
        anchors.withColumn("kind", F.lit(1)).select(columns))
    # a block's rows come before its anchors, and keep the order that makes windows narrow
    near = F.when(F.col("kind") == 0, F.array_min("angles"))
    dealt = sides.withColumn("near", near).repartition(partitions, "block").sortWithinPartitions("block", "kind", "label", F.array_position("angles", F.col("near")), "near").drop("near")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, waiting, now = None, [], None
        for batch in batches:
            for part in _runs(batch):
                number, kind = part.column(0)[0].as_py(), part.column(1)[0].as_py()
                if kind == 0:
                    if number != now:
                        block, waiting, now = None, [], number
                    waiting.append(part)
                    continue
                if number != now:
                    continue
                if block is None:
                    block, waiting = Block(pa.Table.from_batches(waiting)), []
                low, high = part.column(7).to_pylist(), part.column(8).to_pylist()
                extra = part.column(9).to_pylist()
                wanted = [np.array([x, y], dtype=np.float64).T for x, y in zip(low, high, strict=True)]
                ids, labels = part.column(2).to_pylist(), part.column(3).to_pylist()
                q, a, norms = _matrix(part.column(6), block.q.shape[1]), _matrix(part.column(5), block.low.shape[1]), part.column(4).to_numpy()
                out: list[tuple] = []
                for i, places, scores in block.scored(q, a, norms, wanted):
                    out += pick(block, places, scores, ids[i], labels[i], low[i], high[i], extra[i])
                    if len(out) >= 20_000:
                        yield _batch(out, schema)
                        out = []
                if out:
                    yield _batch(out, schema)

    return dealt.mapInArrow(run, result)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of one block and kind each."""
    key = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
    for s, e in zip(cuts, cuts[1:]):
        if e > s:
            yield batch.slice(s, e - s)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


POSITIVE = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score")])
NEGATIVE = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")])


def _sql(schema: pa.Schema) -> str:
    return ", ".join(f"{n} long" for n in schema.names)


def first_positives(rows: DataFrame, anchors: DataFrame, n: int = POSITIVES, references: int = REFERENCES) -> DataFrame:
    """``anchor_id, positive_id, positive_score``: each anchor's first ``n`` other rows of its label."""
    parts = shuffle_partitions(rows.sparkSession)
    pairs = _pairs(anchors.drop("block"), _summaries(rows, references), references, parts).where("label between label0 and label1")
    # the anchor itself may be one of a block's rows
    sure = F.max(F.when((F.col("label0") == F.col("label1")) & (F.col("size") > n), F.col("least"))).over(Window.partitionBy("vec_id"))
    reach = F.coalesce("sure", F.lit(float("-inf")))
    sent = pairs.withColumn("sure", sure).where(F.col("most") >= reach).withColumn("reach", F.ceil(F.greatest(reach, F.lit(-9.2e18))))
    sent = sent.select("block", "vec_id", "label", "norm", "angles", "q", F.array(F.col("reach").cast("long")).alias("wanted_least"),
                       F.array(F.lit(2**63 - 1).cast("long")).alias("wanted_most"), F.lit(None).cast("array<long>").alias("extra"))

    def pick(block: Block, places, scores, anchor, label, low, high, extra):
        keep = (block.labels[places] == label) & (block.ids[places] != anchor)
        places, scores = places[keep], scores[keep]
        own = first(block.ids[places], scores, n)
        return [(anchor, i, s) for i, s in zip(block.ids[places[own]].tolist(), scores[own].tolist())]

    found = _met(rows, sent, pick, _sql(POSITIVE), POSITIVE, parts)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")


def hard_negatives(embeddings: DataFrame, anchor: Column, vector: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   references: int = REFERENCES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Negatives for the rows for which ``anchor`` (a condition on ``vec_id``) holds; see the module's docstring."""
    rows = index(embeddings, vector, references, block_rows)
    parts = shuffle_partitions(rows.sparkSession)
    held = rows.agg(F.max(F.size("angles"))).first()[0] or 1  # fewer where the table has fewer rows
    anchors = staged(rows.where(anchor), "anchors")
    found = staged(first_positives(rows, anchors, positives, held), "positives")
    # 30 p <= 100 s <= 90 p in whole numbers; no score does if p is negative
    ranged = found.where("positive_score >= 0").select("anchor_id", F.struct(
        F.expr("cast((cast(positive_score as decimal(20, 0)) * 30 + 99) div 100 as long)").alias("low"),
        F.expr("cast((cast(positive_score as decimal(20, 0)) * 90) div 100 as long)").alias("high"), "positive_id", "positive_score").alias("p"))
    ranged = ranged.groupBy("anchor_id").agg(F.collect_list("p").alias("p"))
    wanting = anchors.drop("block").join(ranged, anchors["vec_id"] == ranged["anchor_id"])
    pairs = _pairs(wanting, _summaries(rows, held), held, parts)
    sent = pairs.where((F.col("label0") != F.col("label")) | (F.col("label1") != F.col("label"))).where(
        F.exists("p", lambda p: (F.col("most") >= p["low"]) & (F.col("least") <= p["high"])))
    sent = sent.select("block", "vec_id", "label", "norm", "angles", "q", F.col("p.low").alias("wanted_least"), F.col("p.high").alias("wanted_most"),
                       F.concat("p.positive_id", "p.positive_score").alias("extra"))

    def pick(block: Block, places, scores, anchor_id, label, low, high, extra):
        keep = block.labels[places] != label
        places, scores = places[keep], scores[keep]
        ids, out = block.ids[places], []
        for s, e, positive, score in zip(low, high, extra[: len(low)], extra[len(low) :], strict=True):
            inside = np.flatnonzero((scores >= s) & (scores <= e))
            own = inside[first(ids[inside], scores[inside], negatives)]
            out += [(anchor_id, positive, score, i, x) for i, x in zip(ids[own].tolist(), scores[own].tolist())]
        return out

    met = _met(rows, sent, pick, _sql(NEGATIVE), NEGATIVE, parts)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle() -> str:
    """DuckDB SQL of the query: every anchor scored against every row."""
    return f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         list_sum([a.q[i] * r.q[i] FOR i IN range(1, least(len(a.q), len(r.q)) + 1)])::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= {NEGATIVES}"""
