"""Phrase collocations by Toivonen's sampling (operator 11).

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?]`` and line ends,
and pieces into words; a phrase is 1 to ``longest`` words that stand together
in a piece, and everything is counted by language (null: ``und``).

1. A sample of the documents, by hash, is mined level by level at a lowered
   threshold.  Its frequent phrases are the proposal.
2. A pass over all documents counts the proposal and its negative border
   exactly: a phrase is counted if the two phrases of one word less in it are
   proposed (any single word is).  No other phrase can be frequent unless one
   of the border is.
3. Frequent phrases that were not proposed are border failures.  They join
   the proposal and another pass counts what they newly admit, until no
   failure is left.  A frequent phrase that is newly admitted holds a failure
   of the pass before, so only documents are counted in which one stands (as
   a string; found by an Aho-Corasick automaton of at most ``MOST_FAILURES``
   failures, else all documents are counted).  The result is exact whatever
   the sample held; a better sample only saves passes.

The proposal stands in a filter of hashed phrases: one 64-bit slot for each
phrase, of at most ``2 ** MOST_SLOTS_LOG2`` slots (32 MB), which is broadcast.
A false hit of the filter makes a phrase be counted, never be missed, so the
bound costs counting and no results.  Tasks count windows of ``WINDOW`` words
by dense numbers of words and phrases.  What a window counted is dealt by the
phrases' hashes into buckets, ``BUCKETS_OF_A_PARTITION`` for each shuffle
partition, and shuffled as a compressed block for each; a bucket's blocks are
then summed by the phrase itself, with no hash standing for it.

``collocations`` returns each language's first ``top`` phrases by score:
``lang, rank, phrase, a, l, r, n, score``.  Candidates are phrases of two
words or more with ``a >= least`` occurrences.  A cut into a first part (of
``l`` occurrences) and the rest (``r``) scores floor(1000 a n / (l r)), n
being the language's words; the least score counts, of equal ones that of the
shortest first part.  A candidate that lies in a longer one as frequent as
itself is dropped (``100 f >= 100 a`` can only be ``f = a``; if a longer one
has it, so has one of one word more).

Rows: a null or empty text has no words; rows are counted as they come, so
repeated rows and repeated ids count each; an empty table gives no rows; very
long texts are counted whole, in several windows that share no phrase twice;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.stage import shuffle_partitions, staged
from stratum.llm.words import batched, grouped, mixed

LEAST = 100
LONGEST = 5
TOP = 2000
SAMPLE_OF = 8
WINDOW = 1_500_000
MOST_SLOTS_LOG2 = 22
MOST_FAILURES = 50_000
BUCKETS_OF_A_PARTITION = 4
SALTS = 16
UND = "und"

#: What ends a piece, each put as a full stop.
_PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_BLANKS = re.compile(rb"[ \t]+")
_U = np.uint64


class PhraseFilter:
    """Which hashed phrases are proposed: no false misses, few false hits (four bits of one slot for each)."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.shift = _U(64 - (len(slots).bit_length() - 1))

    @classmethod
    def empty(cls) -> PhraseFilter:
        return cls(np.zeros(2, dtype=np.uint64))

    @staticmethod
    def mask(hashes: np.ndarray) -> np.ndarray:
        one, low = _U(1), _U(63)
        return one << (hashes & low) | one << (hashes >> _U(6) & low) | one << (hashes >> _U(12) & low) | one << (hashes >> _U(18) & low)

    def place(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> self.shift).astype(np.int64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        mask = self.mask(hashes)
        return self.slots[self.place(hashes)] & mask == mask


class _Words(dict):
    """Word -> number, in order of appearance; numbers and hashes of one language's window."""

    def __init__(self, lang: bytes):
        self.seed = xxhash.xxh3_64_intdigest(lang)
        self.names: list[bytes] = []
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word, self.seed))
        return n


def _joined(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all but its last word and that of the last."""
    return mixed(prefix * _U(3) + word)


def phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    """The hashes that windows give these phrases."""
    words: dict[str, _Words] = {}
    spelt: dict[int, list[tuple[int, list[int]]]] = {}
    for i, (lang, phrase) in enumerate(zip(langs, phrases, strict=True)):
        own = words.get(lang)
        if own is None:
            own = words[lang] = _Words(lang.encode("utf-8"))
        hashes = [own.hashes[own[w]] for w in phrase.encode("utf-8").split(b" ")]
        spelt.setdefault(len(hashes), []).append((i, hashes))
    out = np.empty(len(phrases), dtype=np.uint64)
    for rows in spelt.values():
        parts = np.array([h for _, h in rows], dtype=np.uint64).T
        joined = parts[0]
        for p in parts[1:]:
            joined = _joined(joined, p)
        out[[i for i, _ in rows]] = joined
    return out


class _Window:
    """The words of one language until they are counted; -1 between pieces."""

    def __init__(self, lang: str):
        self.words = _Words(lang.encode("utf-8"))
        self.words[b"."] = -1  # ends of pieces
        self.numbers: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        tokens = text.replace(b".", b" . ").split()
        self.numbers.append(np.fromiter(map(self.words.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
        self.numbers.append(np.array([-1], dtype=np.int32))
        self.size += len(tokens)

    def counted(self, proposed: PhraseFilter, before: PhraseFilter | None, levels: range, buckets: int = 1) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
        """(bucket, phrases, counts) of each level, those of a bucket together: those whose parts are all in ``proposed`` and were not already in ``before``.

        Level 0 is the count of all words, under an empty phrase.
        """
        numbers = np.concatenate(self.numbers)
        names, total = self.words.names, int(np.count_nonzero(numbers >= 0))
        if not total:
            return
        word_hash = np.array(self.words.hashes, dtype=np.uint64)
        if 0 in levels:
            yield 0, [b""], np.array([total])
        if 1 in levels:
            counts = np.bincount(numbers[numbers >= 0], minlength=len(names))
            for bucket, own in _dealt(word_hash, np.arange(len(names)), buckets):
                yield bucket, [names[i] for i in own.tolist()], counts[own]
        # at[i]: number of the phrase of k words from i on, -1 if there is none that is proposed
        # done: those that an earlier pass has counted, which takes their parts to be proposed and counted by then
        hashes, at, done = word_hash, numbers, np.ones(len(names), dtype=bool)
        spell = np.arange(len(names), dtype=np.int32).reshape(-1, 1)
        for k in range(2, levels.stop):
            known = proposed(hashes)
            old = done & before(hashes) if before is not None else np.zeros(len(hashes), dtype=bool)
            own, following = at[:-1], at[1:]
            places = np.flatnonzero((own >= 0) & (following >= 0))
            places = places[known[own[places]] & known[following[places]]]
            if not len(places):
                return
            last = numbers[places + k - 1].astype(np.int64)
            keys, which, counts = np.unique(own[places].astype(np.int64) * len(names) + last, return_inverse=True, return_counts=True)
            first, last = keys // len(names), keys % len(names)
            tail = np.empty(len(keys), dtype=np.int64)
            tail[which] = following[places]
            done = old[first] & old[tail]
            joined = _joined(hashes[first], word_hash[last])
            if k in levels:
                for bucket, own in _dealt(joined, np.flatnonzero(~done), buckets):
                    rows = np.column_stack([spell[first[own]], last[own]]).tolist()
                    yield bucket, [b" ".join([names[i] for i in row]) for row in rows], counts[own]
            if k + 1 < levels.stop:
                spell = np.column_stack([spell[first], last.astype(np.int32)])
                hashes = joined
                at = np.full(len(numbers) - k + 1, -1, dtype=np.int64)
                at[places] = which


def _dealt(hashes: np.ndarray, places: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its places), in order."""
    bucket = (mixed(hashes[places]) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for n in np.flatnonzero(np.diff(cuts)).tolist():
        yield n, places[order[cuts[n] : cuts[n + 1]]]


BLOCKS = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("block", pa.binary())])
COUNTS = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def packed(parts: list[tuple[list[bytes], np.ndarray]]) -> bytes:
    """Phrases, which hold no line ends, and their counts as one compressed block."""
    phrases = b"\n".join([p for own, _ in parts for p in own])
    counts = np.concatenate([c for _, c in parts]).astype("<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(len(phrases).to_bytes(8, "little") + phrases + counts)


def unpacked(block: bytes) -> tuple[list[bytes], list[int]]:
    data = zstandard.ZstdDecompressor().decompress(block)
    end = 8 + int.from_bytes(data[:8], "little")
    return data[8:end].split(b"\n"), np.frombuffer(data[end:], dtype="<u4").tolist()


def _counts(docs: DataFrame, proposed: PhraseFilter, before: PhraseFilter | None, levels: range, window: int, least: int, failures: list[str] | None = None) -> DataFrame:
    """``lang, words, phrase, f`` for the levels that ``_Window.counted`` admits and ``f >= least``, over all documents or those in which one of ``failures`` stands.

    The number of a language's words comes as the empty phrase, however few they are.
    """
    context, partitions = docs.sparkSession.sparkContext, shuffle_partitions(docs.sparkSession)
    buckets = partitions * BUCKETS_OF_A_PARTITION
    shared = context.broadcast((proposed.slots, None if before is None else before.slots, failures))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, old, wanted = shared.value
        now, old = PhraseFilter(now), None if old is None else PhraseFilter(old)
        holds = None if wanted is None else _holder(wanted)
        held: dict[str, _Window] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                own: dict[int, list[tuple[list[bytes], np.ndarray]]] = {}
                for bucket, phrases, counts in held.pop(lang).counted(now, old, levels, buckets):
                    own.setdefault(bucket, []).append((phrases, counts))
                yield from batched(((bucket, lang, packed(own.pop(bucket))) for bucket in list(own)), BLOCKS, 500)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for part in _portions(text.as_py(), window):
                    if holds is not None and not holds(part):
                        continue
                    if lang not in held:
                        held[lang] = _Window(lang)
                    held[lang].add(part)
                    if sum(w.size for w in held.values()) >= window:
                        yield from flushed()
        yield from flushed()

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (_, lang), blocks in grouped(batches, 2):
                total: dict[bytes, int] = {}
                for (block,) in blocks:
                    for phrase, n in zip(*unpacked(block), strict=True):
                        total[phrase] = total.get(phrase, 0) + n
                for phrase, n in total.items():
                    if n >= least or not phrase:
                        yield lang, phrase.count(b" ") + 1 if phrase else 0, phrase.decode("utf-8"), n

        yield from batched(rows(), COUNTS, 10_000)

    blocks = docs.mapInArrow(run, "bucket int, lang string, block binary").repartition(partitions, "bucket").sortWithinPartitions("bucket", "lang")
    return blocks.mapInArrow(summed, "lang string, words int, phrase string, f long")


def _holder(phrases: list[str]) -> Callable[[bytes], bool]:
    """Whether one of the phrases stands in a portion, perhaps within longer words."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for p in phrases:
        automaton.add_word(p, 1)
    automaton.make_automaton()

    def holds(portion: bytes) -> bool:
        if b"\t" in portion or b"  " in portion:
            portion = _BLANKS.sub(b" ", portion)
        return next(automaton.iter(portion.decode("utf-8")), None) is not None

    return holds


def _portions(text: str | None, window: int) -> Iterator[bytes]:
    """The text's pieces, lower-cased, in portions that end between pieces where a portion would be too long."""
    if not text:
        return
    data = text.encode("utf-8", "replace").lower().translate(_PIECES)
    most, at = 4 * window, 0
    while len(data) - at > most and (cut := data.find(b".", at + most)) >= 0:
        yield data[at:cut]
        at = cut
    yield data[at:]


def _with(filter_: PhraseFilter, phrases: DataFrame, size: int) -> PhraseFilter:
    """The filter and these ``lang, phrase`` rows; slots are made in tasks, and at most all slots come to the driver."""
    wanted = min(MOST_SLOTS_LOG2, max(10, (2 * size).bit_length()))
    if len(filter_.slots) > 2:
        wanted = len(filter_.slots).bit_length() - 1  # slots of another number would ask for the hashes again
    empty = PhraseFilter(np.zeros(2**wanted, dtype=np.uint64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = phrase_hashes(*(c.to_pylist() for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(empty.place(hashes)), pa.array(PhraseFilter.mask(hashes).view(np.int64))], names=["slot", "mask"])

    got = phrases.select("lang", "phrase").mapInArrow(run, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    slots = filter_.slots.copy() if len(filter_.slots) > 2 else empty.slots
    slots[got["slot"].to_numpy()] |= got["mask"].to_numpy().view(np.uint64)
    return PhraseFilter(slots)


def _missed(frequent: DataFrame, proposed: PhraseFilter) -> DataFrame:
    """The rows whose phrase is not proposed."""
    shared = frequent.sparkSession.sparkContext.broadcast(proposed.slots)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = PhraseFilter(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(~known(phrase_hashes(*(c.to_pylist() for c in batch.columns)))))

    return frequent.select("lang", "phrase").mapInArrow(run, "lang string, phrase string")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UND)).alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")


def propose(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample_of: int = SAMPLE_OF, window: int = WINDOW) -> PhraseFilter:
    """Frequent phrases of the sample (one document of ``sample_of``), level by level.

    The threshold in the sample is two fifths of what a phrase with
    ``least`` occurrences has there on average, and 2 at least.
    """
    sample = staged(docs.where(F.pmod(F.xxhash64("lang", "text"), F.lit(sample_of)) == 0), "phrase-sample")
    lowered = max(2, 4 * least // (10 * sample_of))
    out, found = PhraseFilter.empty(), None
    for k in range(1, longest):
        own = staged(_counts(sample, out, None, range(k, k + 1), window, lowered), "proposed")
        size = own.count()
        if not size:
            break
        # all levels so far, so that the filter is of the size that they need
        found = own if found is None else found.unionByName(own)
        out = _with(PhraseFilter.empty(), found, found.count())
    return out


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample_of: int = SAMPLE_OF, window: int = WINDOW,
                     proposed: PhraseFilter | None = None) -> DataFrame:
    """``lang, words, phrase, f`` of all phrases with ``f >= least``, and of each language's number of words (0 words, empty phrase).

    ``proposed``: in place of the sample's (tests); the result does not depend on it.
    """
    texts = _texts(docs)
    now = propose(texts, least, longest, sample_of, window) if proposed is None else proposed
    parts, before, levels, wanted = [], None, range(0, longest + 1), None
    while True:
        kept = staged(_counts(texts, now, before, levels, window, least, wanted), "frequent")
        parts.append(kept)
        failures = staged(_missed(kept.where(f"words between 1 and {longest - 1}"), now), "failures")
        size = failures.count()
        if not size:
            break
        before, now = now, _with(now, failures, size)
        levels = range(2, longest + 1)
        wanted = [r.phrase for r in failures.select("phrase").distinct().collect()] if size <= MOST_FAILURES else None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, sample_of: int = SAMPLE_OF, window: int = WINDOW,
                 proposed: PhraseFilter | None = None) -> DataFrame:
    """Each language's first phrases by score; see the module's docstring."""
    every = frequent_phrases(docs, least, longest, sample_of, window, proposed)
    frequent = every.where("words > 0")
    totals = every.where("words = 0").select("lang", F.col("f").alias("n"))
    candidates = frequent.where("words > 1")
    words = F.split("phrase", " ")
    inner = candidates.where("words > 2").select("lang", "f", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("words") - 1), " "))).alias("phrase"))
    alone = candidates.join(inner, ["lang", "phrase", "f"], "left_anti")
    cuts = alone.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"), words.alias("w")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest"))
    # few languages hold all phrases: what meets by language is salted
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    totals = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = frequent.select("lang", "phrase", "f")
    scored = (cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
              .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).withColumn("salt", salt).join(totals, ["lang", "salt"]))
    # a n / (l r) passes 64 bits: 38 digits hold counts below 10 ** 15
    product = F.expr("cast(1000 as decimal(4, 0)) * cast(a as decimal(15, 0)) * cast(n as decimal(17, 0))")
    scored = scored.withColumn("top", product.cast("decimal(38, 0)")).withColumn("bottom", F.expr("cast(l as decimal(15, 0)) * cast(r as decimal(15, 0))").cast("decimal(38, 0)"))
    scored = scored.withColumn("score", F.expr("top div bottom"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*", salt.alias("salt"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    near = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> str:
    """DuckDB SQL: all phrases counted, without a sample."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH pieces AS (
  SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF w <> ''] AS words
  FROM (SELECT coalesce(lang, '{UND}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
sized AS (SELECT *, unnest(range(1, {longest + 1})) AS k FROM places),
f AS (SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM sized WHERE i + k - 1 <= len(words) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, f, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {least}),
inner_ AS (SELECT DISTINCT lang, f, array_to_string(w[unnest([1, 2]) : len(w) - 2 + unnest([1, 2])], ' ') AS phrase FROM candidates WHERE len(w) > 2),
alone AS (SELECT c.* FROM candidates c ANTI JOIN inner_ i ON c.lang = i.lang AND c.phrase = i.phrase AND c.f = i.f),
cuts AS (SELECT lang, phrase, f AS a, w, unnest(range(1, len(w))) AS k FROM alone),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : len(c.w)], ' ') JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) WHERE rank <= {top}"""
