"""N-gram Jaccard join by MinHash banding (operator 6).

1. Each text becomes its set of hashed word 5-grams.  Texts with equal sets
   form a class (exact copies and more); one row for each class goes on.
2. Each class has a MinHash signature; ``choose_bands`` picks bands and rows
   for the target recall at the similarity threshold.  Rows (band hash,
   class) are shuffled on the band hash.  A bucket sends one link from each
   member to its least member, never its pairs.
3. Buckets that overlap join into candidate clusters (``components``).  A
   cluster is cut into blocks; each pair of blocks is one small task group.
   There an inverted index over the blocks' full n-gram sets counts every
   overlap exactly, so every pair of a cluster is verified, and no pair
   becomes a row: a block pair returns link counts for its classes and the
   edges of a spanning forest.
4. Components of the verified edges are the near-duplicate groups.

Result, one row for each row of the input: ``doc_id``; ``class_id``, the least
doc_id of its near-duplicate group; ``text_class``, the least doc_id with the
same n-gram set; ``n_links``, how many other rows have similarity of at least
the threshold (copies count each); ``stays``, true for the group's row with the
least id and for every row without a group; ``text_hash``.

Rows: a null text or one without words is in no class and has no links
(``class_id`` is its own id); a text of one to four words has one n-gram, all
its words; repeated rows are copies of each other; a null ``doc_id`` takes
part, and a group of null ids alone has a null ``class_id``; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.components import components
from stratum.llm.stage import shuffle_partitions, small_batches, staged
from stratum.llm.words import batched, grouped, shingle_set

N = 5
THRESHOLD = 0.8
RECALL = 0.9995
BLOCK = 1024


def choose_bands(threshold: float, recall: float, rows: int = 8) -> int:
    """The fewest bands of ``rows`` rows that catch a pair at the threshold with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


class MinHash:
    """Band hashes of n-gram sets; the permutations follow from a fixed seed."""

    def __init__(self, bands: int, rows: int = 8):
        rng = np.random.default_rng(20240601)
        self.bands, self.rows = bands, rows
        self.xor = rng.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint32)
        self.times = rng.integers(0, 1 << 31, (bands * rows, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.mix = rng.integers(0, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = rng.integers(0, 1 << 63, bands, dtype=np.uint64)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """One 64-bit hash for each band."""
        x = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
        least = np.full(self.bands * self.rows, 0xFFFFFFFF, dtype=np.uint32)
        for i in range(0, len(x), 256):
            v = (x[None, i : i + 256] ^ self.xor) * self.times
            np.minimum(least, (v ^ (v >> np.uint32(15))).min(axis=1), out=least)
        rows = least.reshape(self.bands, self.rows).astype(np.uint64)
        h = ((rows + np.uint64(1)) * self.mix).sum(axis=1, dtype=np.uint64) ^ self.salt
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (h ^ (h >> np.uint64(29))).view(np.int64)


SIGNED = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])


def signatures(docs: DataFrame, n: int, bands: int) -> DataFrame:
    """``doc_id, text_hash, digest, bands``; a text without words has a null digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, recent = MinHash(bands), {}

        def rows():
            for batch in batches:
                for doc, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    grams = shingle_set(text.as_py(), n)
                    if not len(grams):
                        yield doc, h, None, None
                        continue
                    digest = xxhash.xxh3_128_digest(grams.tobytes())
                    if (keys := recent.get(digest)) is None:
                        if len(recent) > 2000:
                            recent.clear()
                        recent[digest] = keys = hashing.keys(grams)
                    yield doc, h, digest, keys

        yield from batched(rows(), SIGNED)

    return docs.select(F.col("doc_id").cast("long"), text_hash(), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, text_hash long, digest binary, bands array<long>")


def text_hash():
    return F.xxhash64(F.col("text").cast("string")).alias("text_hash")


class _Union:
    """A spanning forest of the links seen."""

    def __init__(self):
        self.up: dict[bytes, bytes] = {}

    def find(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _links(left: list[tuple], right: list[tuple] | None, threshold: float) -> Iterator[tuple]:
    """Verified links of a block pair (``right`` None: within one block) as (class, links, other class of a forest edge).

    Members are (digest, copies, grams); each pair is met once.
    """
    other = left if right is None else right
    sets = [np.frombuffer(m[2], dtype=np.uint64) for m in other]
    sizes = np.array([len(s) for s in sets])
    copies = np.array([m[1] for m in other])
    grams, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    links_other, forest = np.zeros(len(sets), dtype=np.int64), _Union()
    for i, (digest, count, own) in enumerate(left):
        own = np.frombuffer(own, dtype=np.uint64)
        low, high = np.searchsorted(grams, own, "left"), np.searchsorted(grams, own, "right")
        runs = high - low
        total = int(runs.sum())
        at = np.repeat(low - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(total)
        both = np.bincount(owner[at], minlength=len(sets))
        good = both >= threshold * (sizes + len(own) - both) - 1e-9
        if right is None:
            good[: i + 1] = False
        hits = np.flatnonzero(good)
        if len(hits):
            links_other[hits] += count
            yield digest, int(copies[hits].sum()), None
            for j in hits.tolist():
                if forest.join(digest, other[j][0]):
                    yield digest, 0, other[j][0]
    for j in np.flatnonzero(links_other).tolist():
        yield other[j][0], int(links_other[j]), None


FOUND = pa.schema([("digest", pa.binary()), ("links", pa.int64()), ("other", pa.binary())])


def verified(members: DataFrame, threshold: float, partitions: int) -> DataFrame:
    """Links of clusters.  ``members``: cluster, block, blocks, digest, copies, grams."""
    # block pair (i, j), i <= j: a member of block k goes to the pairs (i, k) and (k, j)
    sides = F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = members.withColumn("o", F.explode(sides)).select(
        "cluster", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "digest", "copies", "grams")
    dealt = spread.repartition(partitions, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "block", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (_, i, j), group in grouped(batches, 3):
                once = {m[1]: m for m in group}.values()  # a repeated row brings its class again
                left = [m[1:] for m in once if m[0] == i]
                right = None if i == j else [m[1:] for m in once if m[0] == j]
                if left and (right is None or right):
                    yield from _links(left, right, threshold)

        yield from batched(rows(), FOUND)

    return dealt.mapInArrow(run, "digest binary, links long, other binary")


def near_duplicates(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """See the module's docstring."""
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    with small_batches(spark):
        signed = staged(signatures(docs, n, choose_bands(threshold, recall)), "signatures")
    classes = signed.where("digest is not null").groupBy("digest").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("text_class"))
    # the bands are a function of the digest, so one row's will do.  Candidates go by the digest's first
    # eight bytes: two digests that share them only meet for verification
    banded = signed.where("digest is not null").dropDuplicates(["digest"]).select(
        F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long").alias("node"), F.explode("bands").alias("key"))
    least = banded.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b < top").drop("top")
    candidates = banded.join(least, "key").where("node > b").select(F.col("node").alias("a"), "b")
    clusters = staged(components(candidates, "candidates"), "clusters")

    # blocks by hash: a cluster of m classes has about m / block of them
    sizes = clusters.groupBy("root").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    of_node = classes.withColumn("node", F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long"))
    own = clusters.join(sizes, "root").join(of_node, "node").select(
        F.col("root").alias("cluster"), F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int").alias("block"), "blocks",
        "digest", "copies")
    # the text of one row of each class
    pick = signed.where("digest is not null").groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id"))["doc_id"].alias("doc_id"))
    one = own.join(pick, "digest")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    members = _with_grams(one, texts, n)
    with small_batches(spark):
        found = staged(verified(members, threshold, partitions), "links")

    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    groups = components(found.where("other is not null").select(F.col("digest").alias("a"), F.col("other").alias("b")), "groups")
    # of each group the row with the least id stays; equal ids go by the text's hash
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    firsts = signed.where("digest is not null").groupBy("digest").agg(first.alias("first"))
    linked = groups.join(firsts.withColumnRenamed("digest", "node"), "node")
    of_group = groups.join(linked.groupBy("root").agg(F.min("first").alias("group_first")), "root").select(F.col("node").alias("digest"), "group_first")
    facts = classes.join(of_group, "digest", "left").where("copies > 1 or group_first is not null").join(firsts, "digest").join(links, "digest", "left")
    # written, so that the join below is of two plain shuffles and a hot class can be split
    facts = staged(facts.select("digest", "copies", "text_class", "links", F.coalesce("group_first", "first").alias("best")), "facts")
    out = signed.select("doc_id", "text_hash", "digest").join(facts, "digest", "left")
    grouped_row = F.col("copies").isNotNull()
    return out.select(
        "doc_id", F.when(grouped_row, F.col("best.doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(grouped_row, F.col("text_class")).otherwise(F.col("doc_id")).alias("text_class"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        (~grouped_row | (F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.text_hash") == F.col("text_hash")))).alias("stays"), "text_hash")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents with one row of each near-duplicate group, and all without one; columns stay."""
    keep = near_duplicates(docs, **options).where("stays").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    rows = docs.withColumn("__hash", text_hash())
    left = rows.join(keep.withColumnRenamed("__hash", "__keep"), F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__keep")), "left_semi")
    words = F.col("text").cast("string").rlike("[^ \\t-\\r]")
    # rows that repeat both id and text are copies of each other too
    order = Window.partitionBy("doc_id", "__hash").orderBy("__hash")
    numbered = left.withColumn("__n", F.row_number().over(order))
    return numbered.where((F.col("__n") == 1) | ~F.coalesce(words, F.lit(False))).select(*docs.columns)


def _with_grams(one: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    # ``one`` has a row for each class of a cluster.  A repeated doc_id may bring a foreign text: its digest tells
    joined = one.join(texts, one["doc_id"].eqNullSafe(texts["doc_id"])).select(one["cluster"], "block", "blocks", "digest", "copies", "text")
    schema = pa.schema([("cluster", pa.int64()), ("block", pa.int32()), ("blocks", pa.int32()), ("digest", pa.binary()), ("copies", pa.int64()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for c, b, m, d, k, t in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                    grams = shingle_set(t, n).tobytes()
                    if xxhash.xxh3_128_digest(grams) == d:
                        yield c, b, m, d, k, grams

        yield from batched(rows(), schema, 500)

    return joined.mapInArrow(run, "cluster long, block int, blocks int, digest binary, copies long, grams binary")
