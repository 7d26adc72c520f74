"""Substring deduplication by collinear chaining (operator 8).

1. Seeds: of each document's word k-mers, winnowing keeps the least hash of
   every ``window`` consecutive ones, so any run of ``window + k - 1`` words
   that two documents share gives both the same seed.  Each document is seeded
   once; the seeds are shuffled once, by hash, as compressed blocks.
2. Anchors: every occurrence of a seed is joined to the seed's first
   occurrence (least document, then least place) and to that in the document
   before its own among those that hold the seed.  An occurrence makes two
   anchors at most.  A seed with more than ``COMMON`` occurrences is cut by
   ids, so that many tasks look through it.
3. Chains: for each pair (document, earlier document) the anchors that
   ascend in both are chained; the best predecessor under linear gap costs
   comes from a Fenwick tree over the places in the earlier document.
4. Alignment: the earlier document's words around each chain go to the later
   document; the gaps between anchors are aligned, a run below the identity
   is split into its best-scoring sub-runs, and their ends are extended
   across edits.
5. Spans of one document that touch in it and in one earlier document form a
   passage; passages of at least ``min_words`` words are repeated, and those
   that touch, of whatever earlier documents, form a region.

``fuzzy_passages`` returns a row for each span of such a passage: ``doc_id``,
``ref_doc_id``, ``start``, ``end``, ``ref_start``, ``ref_end`` (words from 0,
end exclusive), ``matched`` (words), ``region_start``, ``region_end``.
``without_passages`` returns the documents with the regions cut out of their
text (``n_chars``, if there, follows it); the first document that has a passage
keeps it, and one of which no word is left goes.

Rows: a null text or one of fewer than ``min_words`` words has no passages; a
row with a null ``doc_id`` is neither compared nor changed; rows that repeat
a ``doc_id`` are each treated by themselves, against smaller ids only; an
empty table gives no rows; other columns are kept and not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import pairwise
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.stage import passing, shuffle_partitions, small_batches, staged
from stratum.llm.words import batched, dealt_blocks, gram_hashes, grouped, mixed, packed_columns, split_words, texts_hashes, unpacked_columns

K = 6
WINDOW = 4
MIN_WORDS = 50
GAP_COST = 0.1
MAX_GAP = 48
MARGIN = 64
TOUCH = 3
PARTS_OF_IDS = 256
IDENTITY = 0.8
REACH = 8
EDIT_COST = 2


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash (the last of equals) of each window."""
    n = len(hashes)
    if n <= window:
        return np.array([n - 1 - int(np.argmin(hashes[::-1]))]) if n else np.empty(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes[::-1], window)
    return np.unique(n - 1 - (np.argmin(views, axis=1) + np.arange(len(views))))


def chosen(texts: list[str], k: int, window: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seeds of these texts: hash, number of the text, place. Texts of fewer than ``min_words`` words have none."""
    hashes, counts = texts_hashes(texts)
    n = len(hashes)
    grams = np.empty(max(0, n - k + 1), dtype=np.uint64)
    for at in range(0, len(grams), 1 << 16):  # what is worked on stays in the processor's cache
        grams[at : at + (1 << 16)] = gram_hashes(hashes[at : at + (1 << 16) + k - 1], k)
    taken = np.zeros(len(grams), dtype=bool)
    ends = np.cumsum(counts)
    starts = ends - counts
    if (whole := len(grams) - window + 1) > 0:
        # the last of equal least ones of each window, if the window ends within its text
        least, step = grams[:whole].copy(), np.zeros(whole, dtype=np.int64)
        for j in range(1, window):
            own = grams[j : j + whole]
            step[own <= least] = j
            np.minimum(least, own, out=least)
        held = np.repeat(np.where(counts >= min_words, ends, 0), counts)[:whole]
        inside = np.flatnonzero(np.arange(k + window - 1, whole + k + window - 1) <= held)
        taken[inside + step[inside]] = True
    for i in np.flatnonzero((counts >= max(min_words, k)) & (counts < k + window - 1)).tolist():
        taken[starts[i] + winnow(grams[starts[i] : ends[i] - k + 1], window)] = True
    own = np.flatnonzero(taken)
    text = np.repeat(np.arange(len(texts)), counts)[own]
    return grams[own], text, (own - starts[text]).astype(np.int32)


#: Characters of texts that are seeded together, and rows that are dealt into blocks together.
CHARS = 1_000_000
ROWS = 250_000
BUCKETS_OF_A_PARTITION = 4
#: Occurrences from which on a seed is linked by ``anchored``, in many tasks.
COMMON = 200_000

BLOCKS = pa.schema([("bucket", pa.int32()), ("block", pa.binary())])
BLOCKS_SQL = "bucket int, block binary"
SEED = [np.uint64, np.int64, np.int32]  # seed, document, place
ANCHOR = [np.int64, np.int64, np.int32, np.int32]  # document, earlier document, place, earlier place


class _Dealer:
    """Holds rows until there are ``ROWS``, then deals them by a key into blocks of buckets."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.size = buckets, [], 0

    def put(self, key: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
        self.held.append((key, *columns))
        self.size += len(key)
        if self.size >= ROWS:
            yield from self.rest()

    def rest(self) -> Iterator[tuple[int, bytes]]:
        if self.size:
            key, *columns = (np.concatenate(c) for c in zip(*self.held, strict=True))
            self.held, self.size = [], 0
            yield from dealt_blocks((key % np.uint64(self.buckets)).astype(np.int32), columns)


def _of_document(doc: np.ndarray) -> np.ndarray:
    return mixed(doc.view(np.uint64))


def seeds(docs: DataFrame, k: int, window: int, min_words: int, buckets: int) -> DataFrame:
    """``bucket, block``: the seeds of all documents, dealt by the seed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            dealer = _Dealer(buckets)
            for batch in batches:
                ids, size, texts = batch.column(0).to_numpy(), 0, []
                for i, text in enumerate(batch.column(1)):
                    texts.append(text.as_py())
                    size += len(texts[-1])
                    if size >= CHARS or i + 1 == batch.num_rows:
                        marks, own, places = chosen(texts, k, window, min_words)
                        yield from dealer.put(marks, marks, ids[i + 1 - len(texts) : i + 1][own], places)
                        size, texts = 0, []
            yield from dealer.rest()

        yield from batched(rows(), BLOCKS, 64)
        pa.default_memory_pool().release_unused()  # the worker goes on with other steps

    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, BLOCKS_SQL)


def links(seed: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of each occurrence: with the seed's first one and with the first in the latest document before its own."""
    order = np.argsort(seed)
    same = np.diff(seed[order].view(np.int64)) == 0
    repeated = np.zeros(len(seed), dtype=bool)  # a seed that stands once has no anchor
    repeated[1:] |= same
    repeated[:-1] |= same
    own = order[repeated]
    own = own[np.lexsort((pos[own], doc[own], seed[own]))]
    seed, doc, pos = seed[own], doc[own], pos[own]
    n = len(own)
    new_seed, new_doc = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    new_seed[1:] = seed[1:] != seed[:-1]
    new_doc[1:] = new_seed[1:] | (doc[1:] != doc[:-1])
    first = np.maximum.accumulate(np.where(new_seed, np.arange(n), 0))
    starts = np.flatnonzero(new_doc)
    own_doc = np.cumsum(new_doc) - 1
    later = np.flatnonzero(starts[own_doc] != first)
    previous = starts[own_doc[later] - 1]
    twice = previous != first[later]
    at, to = np.concatenate([later, later[twice]]), np.concatenate([first[later], previous[twice]])
    return doc[at], doc[to], pos[at], pos[to]


def linked_blocks(blocks: DataFrame, partitions: int, buckets: int, common: int = COMMON) -> DataFrame:
    """``bucket, block``: anchors dealt by the later document; in bucket -1 the occurrences of seeds that have more than ``common``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            dealer, apart = _Dealer(buckets), np.empty(0, dtype=np.uint64)

            def split(held):
                """Without the seeds that are common by now, whose occurrences go out."""
                seed, doc, pos = (np.concatenate(c) for c in zip(*held, strict=True))
                kinds, counts = np.unique(seed, return_counts=True)
                now = np.union1d(apart, kinds[counts > common])
                out = np.isin(seed, now)
                return now, [(seed[~out], doc[~out], pos[~out])], [x[out] for x in (seed, doc, pos)]

            for _, group in grouped(batches, 1):
                held, size, limit = [], 0, 8 * common
                apart = apart[:0]
                for (block,) in group:
                    held.append(unpacked_columns(block, SEED))
                    size += len(held[-1][0])
                    if size > limit:
                        apart, held, out = split(held)
                        size = len(held[0][0])
                        limit = max(limit, 2 * size)
                        if len(out[0]):
                            yield -1, packed_columns(out)
                if size > common:
                    apart, held, out = split(held)
                    if len(out[0]):
                        yield -1, packed_columns(out)
                anchors = links(*(np.concatenate(c) for c in zip(*held, strict=True)))
                yield from dealer.put(_of_document(anchors[0]), *anchors)
            yield from dealer.rest()

        yield from batched(rows(), BLOCKS, 64)

    return blocks.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(run, BLOCKS_SQL)


def _common_anchors(blocks: DataFrame, ids: list[int], buckets: int) -> DataFrame:
    """``bucket, block``: anchors of the seeds in bucket -1, each looked through in many tasks."""
    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0):
                seed, doc, pos = unpacked_columns(block.as_py(), SEED)
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(doc), pa.array(pos)], names=["seed", "doc_id", "pos"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            dealer = _Dealer(buckets)
            for batch in batches:
                columns = [c.to_numpy() for c in batch.columns]
                yield from dealer.put(_of_document(columns[0]), *columns)
            yield from dealer.rest()

        yield from batched(rows(), BLOCKS, 64)

    every = blocks.where("bucket = -1").select("block").mapInArrow(occurrences, "seed long, doc_id long, pos int")
    first = every.groupBy("seed").agg(F.min(F.struct("doc_id", "pos")).alias("f")).select("seed", F.col("f.doc_id").alias("ref"), F.col("f.pos").alias("at"))
    return anchored(every.join(first, "seed"), ids).select("doc_id", "ref", "pos", "at").mapInArrow(dealt, BLOCKS_SQL)


def anchored(shared: DataFrame, ids: list[int]) -> DataFrame:
    """``doc_id, ref, pos, at``: each occurrence with the seed's first one and with the first in the latest document before its own.

    ``ids``: bounds that cut the documents into parts, so that a common seed
    is looked through in many tasks; the parts' latest documents then meet.
    """
    bounds = np.array(ids, dtype=np.int64)

    @F.pandas_udf("int")
    def part(of: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, of.to_numpy()).astype(np.int32))

    dealt = shared.withColumn("part", part("doc_id"))
    latest = F.max(F.struct("doc_id", (-F.col("pos")).alias("back")))
    own = Window.partitionBy("seed", "part")
    inside = dealt.withColumn("n", F.dense_rank().over(own.orderBy("doc_id"))).withColumn(
        "near", latest.over(own.orderBy("n").rangeBetween(Window.unboundedPreceding, -1)))
    tops = dealt.groupBy("seed", "part").agg(latest.alias("top")).withColumn(
        "far", F.max("top").over(Window.partitionBy("seed").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).where("far is not null")
    both = inside.where("doc_id > ref").join(tops.select("seed", "part", "far"), ["seed", "part"], "left").withColumn("prev", F.coalesce("near", "far"))
    links = F.array_distinct(F.array(F.struct("ref", "at"), F.struct(F.col("prev.doc_id").alias("ref"), (-F.col("prev.back")).alias("at"))))
    return both.select("doc_id", "pos", F.explode(links).alias("l")).select("doc_id", "l.ref", "pos", "l.at")


class Fenwick:
    """Greatest (value, item) of a prefix."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(0.0, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def prefix(self, i: int) -> tuple[float, int]:
        """Over the places below ``i``."""
        out = (0.0, -1)
        while i > 0:
            if self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


def _scores(anchors: list[tuple[int, int]], k: int, gap_cost: float) -> tuple[list[float], list[int]]:
    """Score of the best chain that ends in each of these sorted anchors, and its last but one."""
    score, back = [float(k)], [-1]
    if all(p < q and r < t for (p, r), (q, t) in pairwise(anchors)):
        # all ascend: a chain gains at least k with each, so the one before is the best predecessor
        for i in range(1, len(anchors)):
            gain = score[-1] + gap_cost * sum(anchors[i - 1]) - gap_cost * sum(anchors[i])
            score.append(k + max(0.0, gain))
            back.append(i - 1 if gain > 0 else -1)
        return score, back
    ranks = {r: i for i, r in enumerate(sorted({r for _, r in anchors}))}
    tree, score, back, wait = Fenwick(len(ranks)), [], [], []
    for i, (p, r) in enumerate(anchors):
        while wait and anchors[wait[0]][0] < p:  # those at the same place are no predecessors
            j = wait.pop(0)
            tree.put(ranks[anchors[j][1]], (score[j] + gap_cost * sum(anchors[j]), j))
        value, j = tree.prefix(ranks[r])
        gain = value - gap_cost * (p + r) if j >= 0 else 0.0
        score.append(k + max(0.0, gain))
        back.append(j if gain > 0 else -1)
        wait.append(i)
    return score, back


def chains(anchors: list[tuple[int, int]], k: int, gap_cost: float = GAP_COST, max_gap: int = MAX_GAP) -> list[list[tuple[int, int]]]:
    """Best chains of anchors (place, earlier place), ascending in both; each anchor is in one at most."""
    if len(anchors) == 1:
        return [anchors]
    anchors = sorted(set(anchors))
    score, back = _scores(anchors, k, gap_cost)
    out, used = [], set()
    for i in sorted(range(len(anchors)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and i not in used:
            used.add(i)
            if chain and max(chain[-1][0] - anchors[i][0], chain[-1][1] - anchors[i][1]) > max_gap:
                out.append(chain[::-1])
                chain = []
            chain.append(anchors[i])
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


def folded(found: list[list[tuple[int, int]]]) -> bytes:
    """The chains of a pair as numbers: how many, their lengths, their places, their earlier places."""
    return np.array([len(found), *map(len, found), *(p for c in found for p, _ in c), *(r for c in found for _, r in c)], dtype=np.int32).tobytes()


def unfolded(numbers: bytes) -> list[tuple[list[int], list[int]]]:
    n, *rest = np.frombuffer(numbers, dtype=np.int32).tolist()
    total, at, out = sum(rest[:n]), n, []
    for length in rest[:n]:
        out.append((rest[at : at + length], rest[at + total : at + total + length]))
        at += length
    return out


CHAINS = pa.schema([("doc_id", pa.int64()), ("ref", pa.int64()), ("chains", pa.binary())])


def chained(anchors: DataFrame, k: int, partitions: int) -> DataFrame:
    """``doc_id, ref, chains``: a row for each pair. ``anchors``: blocks dealt by the later document, whose anchors are bounded by its own seeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for _, group in grouped(batches, 1):
                doc, ref, pos, at = (np.concatenate(c) for c in zip(*(unpacked_columns(g[0], ANCHOR) for g in group), strict=True))
                order = np.lexsort((ref, doc))
                doc, ref, points = doc[order], ref[order], list(zip(pos[order].tolist(), at[order].tolist(), strict=True))
                sides = [0, *(np.flatnonzero((np.diff(doc) != 0) | (np.diff(ref) != 0)) + 1).tolist(), len(points)]
                for s, e in pairwise(sides):
                    yield int(doc[s]), int(ref[s]), folded(chains(points[s:e], k))

        yield from batched(rows(), CHAINS)

    return anchors.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "doc_id long, ref long, chains binary")


def _matches(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence of two short stretches."""
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b, 1):
            diagonal, left = left, row[j]
            row[j] = diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


#: Words skipped in the two texts after a mismatch, least first; changed words before inserted or lost ones of the next length.
_EDITS = [(p, q) for d in range(1, REACH + 1) for p, q in [*((d, q) for q in range(d)), *((p, d) for p in range(d)), (d, d)]]


def _extend(a: list[bytes], b: list[bytes], cost: float) -> tuple[int, int, int]:
    """Words of ``a``, words of ``b`` and matches of the best-scoring alignment from their starts.

    A match counts 1, an edited word ``-cost``; after a mismatch at most
    ``REACH`` words are skipped, and it ends ``REACH`` edits below the best.
    """
    x = y = matched = 0
    score, best, out = 0.0, 0.0, (0, 0, 0)
    n, m = len(a), len(b)
    while x < n and y < m:
        if a[x] == b[y]:
            run, most = 1, min(n - x, m - y)
            while run + 16 <= most and a[x + run : x + run + 16] == b[y + run : y + run + 16]:
                run += 16
            while run < most and a[x + run] == b[y + run]:
                run += 1
            x, y, matched = x + run, y + run, matched + run
            score += run
            if score > best:
                best, out = score, (x, y, matched)
            continue
        left, right = a[x : x + REACH + 1], b[y : y + REACH + 1]
        if set(left).isdisjoint(right):
            break
        n_left, n_right = len(left), len(right)
        for p, q in _EDITS:
            # off the diagonal two equal words in a row are asked for: one common word stands anywhere
            if p < n_left and q < n_right and left[p] == right[q] and (p == q or a[x + p + 1 : x + p + 2] == b[y + q + 1 : y + q + 2]):
                x, y, score = x + p, y + q, score - cost * max(p, q)
                break
        else:
            break
        if score < best - REACH * cost:
            break
    return out


def _parts(gains: list[float], first: int, last: int, reaches: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """The run of anchors ``first .. last`` if it reaches the identity, else its best-scoring sub-runs.

    ``gains[j]``: score of the piece from anchor j to the next.
    """
    out, todo = [], [(first, last)]
    while todo:
        first, last = todo.pop()
        if first > last:
            continue
        if reaches(first, last):
            out.append((first, last))
            continue
        best, score, start, part = 0.0, 0.0, first, (first, first)
        for j in range(first, last):
            score += gains[j]
            if score < 0:
                score, start = 0.0, j + 1
            elif score > best:
                best, part = score, (start, j + 1)
        out.append(part)
        todo += [(first, part[0] - 1), (part[1] + 1, last)]
    return sorted(out)


def align(words: list[bytes], near: list[bytes], base: int, pos: list[int], at: list[int], k: int, identity: float = IDENTITY) -> Iterator[tuple[int, int, int, int, int]]:
    """Aligned spans (start, end, ref_start, ref_end, matched) of a chain.

    ``near``: the earlier document's words from its word ``base`` on.
    """
    r = [x - base for x in at]
    cuts, run = [], [0]
    got = []
    for j in range(len(pos) - 1):
        a, b = words[pos[j] : pos[j + 1]], near[r[j] : r[j + 1]]
        if a == b:
            got.append(len(a))
        else:
            got.append(_matches(a, b))
            if got[-1] < 0.5 * max(len(a), len(b)) and max(len(a), len(b)) > k + 2:
                cuts.append(run)
                run = []
        run.append(j + 1)
    cuts.append(run)
    # the words each piece gains over the identity
    gains = [m - identity * max(pos[j + 1] - pos[j], r[j + 1] - r[j]) for j, m in enumerate(got)]

    def reaches(i: int, j: int) -> bool:
        return sum(got[i:j]) + k >= identity * (max(pos[j] - pos[i], r[j] - r[i]) + k)

    for first, last in (part for run in cuts for part in _parts(gains, run[0], run[-1], reaches)) if got else [(0, 0)]:
        s, e, t, f = pos[first], pos[last] + k, r[first], r[last] + k
        matched = sum(got[first:last]) + k
        before, after = words[max(0, s - t - REACH) : s][::-1], words[e : e + len(near) - f + REACH]
        for cost in (EDIT_COST, identity / (1 - identity) + 1e-9):  # the second never takes the identity below the limit
            left, right = _extend(before, near[:t][::-1], cost), _extend(after, near[f:], cost)
            span = s - left[0], e + right[0], t - left[1], f + right[1], matched + left[2] + right[2]
            if span[4] >= identity * max(span[1] - span[0], span[3] - span[2]):
                yield span[0], span[1], span[2] + base, span[3] + base, span[4]
                break


def passages(spans: list[tuple], min_words: int, touch: int = TOUCH) -> list[tuple[int, int, list[tuple]]]:
    """Unions (start, end, their spans) of spans that touch on both sides, each in one earlier document, of at least ``min_words`` words."""
    out = []
    open_, ref = [], None
    for span in sorted(set(spans), key=lambda x: (x[2], x)):
        s, e, own, t, f, _ = span
        if own != ref:
            open_, ref = [], own
        open_ = [g for g in open_ if s <= g[1] + touch]
        g = next((g for g in open_ if g[2] <= t <= g[3] + touch), None)
        if g is None:
            g = [s, e, t, f, []]
            open_.append(g)
            out.append(g)
        g[1], g[3] = max(g[1], e), max(g[3], f)
        g[4].append(span)
    return [(s, e, own) for s, e, _, _, own in out if e - s >= min_words]


def regions(found: list[tuple[int, int, list[tuple]]], touch: int = TOUCH) -> list[tuple[int, int]]:
    """Unions of passages that touch."""
    out: list[list[int]] = []
    for s, e, _ in sorted(found, key=lambda x: x[:2]):
        if out and s <= out[-1][1] + touch:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


_WORD = re.compile(r"[^ \t-\r]+")


def cut(text: str, parts: list[tuple[int, int]]) -> str:
    """``text`` without these word ranges and the white space after each."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, last = [], 0
    for s, e in parts:
        out.append(text[last : at[s]])
        last = at[e]
    return "".join([*out, text[last:]])


def _linked(docs: DataFrame, k: int, window: int, min_words: int, write: Callable[[DataFrame, str], DataFrame], common: int = COMMON) -> DataFrame:
    """The chains of all pairs, written by ``write``; the tables that lead to them go."""
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    buckets = BUCKETS_OF_A_PARTITION * partitions
    with small_batches(spark), passing(spark) as put:
        with passing(spark):  # the shuffled seeds go before the anchors are shuffled
            blocks = put(linked_blocks(seeds(docs, k, window, min_words, buckets), partitions, buckets, common), "links")
        anchors = blocks.where("bucket >= 0")
        if not blocks.where("bucket = -1").isEmpty():
            ids = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [i / PARTS_OF_IDS for i in range(1, PARTS_OF_IDS)], 10_000)).first()[0]
            anchors = anchors.union(_common_anchors(blocks, sorted(set(ids or [])), buckets))
        return write(chained(anchors, k, partitions), "chains")


def around(at: list[int], k: int) -> tuple[int, int]:
    """The earlier document's words that a chain is aligned with."""
    return max(0, at[0] - MARGIN), at[-1] + k + MARGIN


def stretches(found: list[tuple[list[int], list[int]]], k: int) -> list[tuple[int, int]]:
    """Unions of the words around a pair's chains, so that none is sent twice."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(around(at, k) for _, at in found):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


def _found(docs: DataFrame, linked: DataFrame, k: int, min_words: int, only_spans: bool) -> DataFrame:
    """The chains aligned: spans of passages (``only_spans``), or for each document with regions its text and their places."""
    partitions = shuffle_partitions(docs.sparkSession)
    text = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("ref"), F.col("text").cast("string").alias("text"))
    near_schema = pa.schema([*CHAINS, ("near", pa.binary())])

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()

        def rows():
            kept, words = None, []
            for batch in batches:
                for doc, ref, numbers, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if kept != packed:
                        kept, words = packed, split_words(unpack.decompress(packed).decode("utf-8"))
                    parts = stretches(unfolded(numbers), k)
                    yield doc, ref, numbers, pack.compress(b"\n".join(b" ".join(words[s:e]) for s, e in parts))

        yield from batched(rows(), near_schema, 500)

    near = linked.join(_packed(text, "ref"), "ref").select("doc_id", "ref", "chains", "z").mapInArrow(surround, "doc_id long, ref long, chains binary, near binary")
    own = _packed(docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id")
    sides = near.select("doc_id", F.lit(1).alias("kind"), "ref", "chains", "near").union(
        own.select("doc_id", F.lit(0), F.lit(None).cast("long"), F.lit(None).cast("binary"), "z"))
    # documents and their chains meet: one document's rows are bounded by its own seeds
    dealt = sides.repartition(partitions, "doc_id").sortWithinPartitions("doc_id", "kind")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def rows():
            for (doc,), group in grouped(batches, 1):
                texts = list(dict.fromkeys(g[3] for g in group if not g[0]))
                links = [g for g in group if g[0]]
                for packed in texts:
                    text, spans = unpack.decompress(packed).decode("utf-8"), []
                    words = split_words(text) if links else []
                    for _, ref, numbers, near in links:
                        found = unfolded(numbers)
                        parts, stretched = stretches(found, k), [x.split() for x in unpack.decompress(near).split(b"\n")]
                        for pos, at in found:
                            if pos[-1] + k <= len(words):
                                base, last = around(at, k)
                                i = bisect_right(parts, base, key=itemgetter(0)) - 1
                                own = stretched[i][base - parts[i][0] : last - parts[i][0]]
                                spans += [(s, e, ref, t, f, m) for s, e, t, f, m in align(words, own, base, pos, at, k)]
                    held = passages(spans, min_words)
                    parts = regions(held)
                    if only_spans:
                        for s, e in parts:
                            for x in sorted({x for first, last, own in held if s <= first and last <= e for x in own}):
                                yield doc, x[2], x[0], x[1], x[3], x[4], x[5], s, e
                    elif parts:
                        yield doc, packed, [p[0] for p in parts], [p[1] for p in parts]

        yield from batched(rows(), SPANS if only_spans else PARTS, 1000)

    return dealt.mapInArrow(meet, SPANS_SQL if only_spans else "doc_id long, z binary, starts array<int>, ends array<int>")


SPANS_SQL = "doc_id long, ref_doc_id long, start int, end int, ref_start int, ref_end int, matched int, region_start int, region_end int"
SPANS = pa.schema([(n, pa.int64() if n.endswith("doc_id") else pa.int32()) for n in (x.split()[0] for x in SPANS_SQL.split(", "))])
PARTS = pa.schema([("doc_id", pa.int64()), ("z", pa.binary()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])


def _packed(texts: DataFrame, key: str) -> DataFrame:
    """Texts compressed before they are shuffled."""
    schema = pa.schema([(key, pa.int64()), ("z", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield from batched(((d, pack.compress(t.as_py().encode("utf-8", "replace"))) for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)), schema, 1000)

    return texts.mapInArrow(run, f"{key} long, z binary")


def fuzzy_passages(docs: DataFrame, k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS) -> DataFrame:
    """Spans of repeated passages; see the module's docstring."""
    return _found(docs, _linked(docs, k, window, min_words, staged), k, min_words, True)


def without_passages(docs: DataFrame, k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, with repeated passages cut out of ``text``; columns and their order stay."""
    with small_batches(docs.sparkSession), passing(docs.sparkSession) as put:
        found = _found(docs, _linked(docs, k, window, min_words, put), k, min_words, False)
        parts = staged(found.select("doc_id", "starts", "ends", "z"), "parts")
    return _cut_all(docs, parts)


def _cut_all(docs: DataFrame, parts: DataFrame) -> DataFrame:
    # only documents with a passage are shuffled with their new text; the others pass beside them by an anti join on ids
    spark_type = dict(docs.dtypes)
    p = parts.select(F.col("doc_id").alias("__id"), "starts", "ends", "z")
    schema = pa.schema([("__id", pa.int64()), ("__text", pa.string()), ("__cut", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def rows():
            for batch in batches:
                for doc, starts, ends, z in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    text = unpack.decompress(z).decode("utf-8")
                    yield doc, text, cut(text, list(zip(starts, ends, strict=True)))

        yield from batched(rows(), schema, 500)

    new = p.mapInArrow(run, "__id long, __text string, __cut string").withColumn("__h", F.xxhash64("__text")).drop("__text")
    joined = docs.join(new, (docs["doc_id"].cast("long") == new["__id"]) & (F.xxhash64(docs["text"].cast("string")) == new["__h"]), "left")
    text = F.when(F.col("__id").isNotNull(), F.col("__cut")).otherwise(docs["text"].cast("string")).cast(spark_type["text"])
    # a count of characters follows the text; a document of which nothing is left goes
    short = {"text": text, "n_chars": F.when(F.col("__id").isNotNull(), F.length("__cut").cast(spark_type.get("n_chars", "long"))).otherwise(docs["n_chars"])} if "n_chars" in docs.columns else {"text": text}
    some = F.col("__id").isNull() | F.col("__cut").rlike("[^ \\t-\\r]")
    return joined.where(some).select(*[short[c].alias(c) if c in short else docs[c] for c in docs.columns])
