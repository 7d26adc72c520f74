"""Language identification in two steps (operator 4): first the family, then the language within it.

Features are hashed byte n-grams (one to three) of the lower-cased letters of
the whole text, as square roots of their shares.  Models are linear support
vector machines with squared hinge loss: one for each family against the
rest, then one for each pair of languages of a family, which vote.

They are fitted on a bounded sample: the ``per_language`` labelled documents
of each language with the least hash of their ``doc_id``; each gives its
whole text and two short stretches of it, so that short texts are learned as
well.  Held-out documents (crc32 of the id as text, modulo 5, is 0) are never
in it.  Each machine is trained in a task of its own; the weights, bounded by
the number of languages, go to the driver and from there to the tasks.

Rows: a null text or one without a letter is ``und`` with score 0, and so is
every text if nothing can be learned; a null language is not learned from;
a null ``doc_id`` is neither held out nor learned from; repeated rows are
each predicted; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.stage import staged
from stratum.llm.words import batched

PER_LANGUAGE = 500
BITS = 12
FOLDS = 5

#: Families of languages by their codes; another code is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTER = re.compile(r"[^\W\d_]")
_SPACES = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))


def family(lang: str) -> str:
    return _FAMILY.get(lang, lang)


def features(text: str) -> np.ndarray:
    """Square roots of the shares of the hashed n-grams; of length 1."""
    b = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_SPACES).split()) + b" ", dtype=np.uint8).astype(np.uint32)
    size, shift = 1 << BITS, np.uint32(32 - BITS)
    counts = np.zeros(size, dtype=np.int64)
    code = np.zeros(0, dtype=np.uint32)
    for n in (1, 2, 3):
        code = b + np.uint32(1) if n == 1 else code[:-1] * np.uint32(257) + b[n - 1 :]
        if len(code):
            counts += np.bincount((code * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519) >> shift, minlength=size)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def examples(text: str, seed: int) -> list[np.ndarray]:
    """The whole text and two stretches of 2 to 12 words."""
    words, rng = text.split(), np.random.default_rng(seed)
    out = [features(text)]
    for _ in range(2):
        n = int(rng.integers(2, 13))
        at = int(rng.integers(0, max(1, len(words) - n)))
        if _LETTER.search(part := " ".join(words[at : at + n])):
            out.append(features(part))
    return out


def svm(x: np.ndarray, y: np.ndarray, rounds: int = 120, decay: float = 1e-4) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine for y in (-1, 1), classes weighted alike; accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], dtype=np.float32)
    ahead, step = w.copy(), 0.2
    for i in range(rounds):
        short = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (decay * ahead - 2 * ((share * y * short) @ x))
        ahead, w = new + i / (i + 3) * (new - w), new
    return w


def trained(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], dict[str, np.ndarray]]:
    """Learned languages and the machines by name: ``f:family``, ``p:a:b`` (a positive)."""
    usable = docs.where("doc_id is not null and lang is not null and text is not null").where(~held_out())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    pick = usable.select(F.col("lang").alias("lang"), "doc_id").withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language)
    pick = staged(pick.select("lang", "doc_id"), "sample")  # few rows of a known size: texts need not be shuffled to meet them
    langs = sorted(r[0] for r in pick.select("lang").distinct().collect())
    if len(langs) < 2:
        return langs, {}
    families = sorted({family(x) for x in langs})
    tasks: dict[str, list[tuple[str, int]]] = {x: [] for x in langs}
    for x in langs:
        if len(families) > 1:
            tasks[x] += [(f"f:{f}", 1 if family(x) == f else -1) for f in families]
        for a, b in combinations(langs, 2):
            if family(a) == family(b) and x in (a, b):
                tasks[x].append((f"p:{a}:{b}", 1 if x == a else -1))
    schema = pa.schema([("task", pa.string()), ("y", pa.int32()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(((task, y, x.astype(np.float16).tobytes()) for batch in batches for doc, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                            if _LETTER.search(text) for x in examples(text, doc & 0xFFFFFFFF) for task, y in tasks.get(lang, ())), schema, 500)

    chosen = usable.join(pick.select("doc_id").distinct(), "doc_id", "left_semi").select(F.col("doc_id").cast("long"), "lang", F.col("text").cast("string"))
    rows = chosen.mapInArrow(run, "task string, y int, x binary")

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["y", "x"])  # the same sums in any order of arrival
        x = np.frombuffer(b"".join(frame["x"]), dtype=np.float16).reshape(len(frame), -1).astype(np.float32)
        return pd.DataFrame({"task": [frame["task"].iloc[0]], "w": [svm(x, frame["y"].to_numpy(dtype=np.float32)).tobytes()]})

    weights = rows.groupBy("task").applyInPandas(fit, "task string, w binary").collect()
    return langs, {r[0]: np.frombuffer(r[1], dtype=np.float32) for r in weights}


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class Predictor:
    def __init__(self, langs: list[str], machines: dict[str, np.ndarray]):
        self.langs, self.names = langs, sorted(machines)
        self.weights = np.stack([machines[n] for n in self.names], axis=1) if machines else None
        self.families: dict[str, list[str]] = {}
        for x in langs:
            self.families.setdefault(family(x), []).append(x)

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not _LETTER.search(text):
            return "und", 0.0
        if self.weights is None:
            return self.langs[0], 1.0
        margins = dict(zip(self.names, (features(text) @ self.weights[:-1] + self.weights[-1]).tolist(), strict=True))
        ranked = sorted(((margins.get(f"f:{f}", 0.0), f) for f in self.families), reverse=True)
        least = ranked[0][0] - ranked[1][0] if len(ranked) > 1 else np.inf
        own = self.families[ranked[0][1]]
        votes = {x: [0, 0.0] for x in own}
        for a, b in combinations(own, 2):
            m = margins.get(f"p:{a}:{b}", 0.0)
            for x, v in ((a, m), (b, -m)):
                votes[x][0] += v > 0
                votes[x][1] += v
        best = max(own, key=lambda x: (*votes[x], x))
        for a, b in combinations(own, 2):
            if best in (a, b):
                m = margins.get(f"p:{a}:{b}", 0.0)
                least = min(least, m if best == a else -m)
        return best, float(1 / (1 + np.exp(-4 * max(-10.0, min(10.0, least)))))


def languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``."""
    langs, machines = trained(docs, per_language)
    predict = Predictor(langs, machines)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(((d, h, *predict(t.as_py())) for batch in batches for d, h, t in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True)), schema)

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")
