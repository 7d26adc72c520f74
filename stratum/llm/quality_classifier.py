"""Quality classifier by hierarchical empirical Bayes (operator 2).

Document evidence: each text's counts (``quality_rules``) fall into bins; the
log likelihood ratio of each bin between good and bad labelled documents,
from one grouped aggregation over all labelled rows, is summed (the table is
a few dozen numbers).  Site evidence: labelled documents are counted by host
and by path.  A host's rate is shrunk to the corpus' rate, a path's rate to
its host's; how far follows from the spread between the groups (method of
moments), so a sparse site stays near its prior and a well-known one near its
own rate.  The path's log odds plus the document's evidence make the
posterior.

Result: ``doc_id, host, path, evidence, host_rate, path_rate, quality``
(posterior probability) and ``kept`` (quality of at least a half).

Rows: a null text has no words, a bin like any other; a null host or path is
a group of its own; a null ``doc_id`` has no label; several labels of one
document count as their mean; a host or path without labels has its prior;
without any label every document has quality 0.5; repeated rows are each
classified; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.quality_rules import COUNTS, RATIOS, counts_of, ratio
from stratum.llm.stage import staged

SMOOTH = 1.0
WEAKEST, STRONGEST = 2.0, 1000.0

BINS = (*RATIOS, "length")


def _bin(name: str) -> Column:
    """0 for 0, else one more than the whole part of the binary logarithm."""
    v = F.col("n_words") if name == "length" else ratio(name)
    return F.when(v > 0, F.length(F.bin(v))).otherwise(0).cast("int")


def _strength(groups: DataFrame, prior: Column) -> float:
    """Weight of the prior, in labelled documents, from the spread of ``k / n`` around it."""
    r = groups.select("n", (F.col("k") / F.col("n")).alias("r"), prior.alias("p")).agg(
        F.sum(F.col("n") * (F.col("r") - F.col("p")) ** 2).alias("spread"), F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.count("*").alias("groups"), (F.sum(F.col("n") * F.col("p")) / F.sum("n")).alias("p")).first()
    if not r["all"] or r["groups"] < 2 or r["all"] <= r["squares"] / r["all"]:
        return STRONGEST
    within = r["p"] * (1 - r["p"])
    between = (r["spread"] - (r["groups"] - 1) * within) / (r["all"] - r["squares"] / r["all"])
    return STRONGEST if between <= 0 else min(STRONGEST, max(WEAKEST, within / between - 1))


def quality_posteriors(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """See the module's docstring; ``host`` and ``path`` are columns of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long"), host.cast("string").alias("host"), path.cast("string").alias("path"),
                       counts_of(F.col("text").cast("string")).alias("m")).select("doc_id", "host", "path", "m.*")
    binned = staged(rows.select("doc_id", "host", "path", *[_bin(n).alias(f"b_{n}") for n in BINS]), "bins")
    y = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    known = staged(binned.join(y, "doc_id"), "labelled")

    cells = known.select("y", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"b_{n}").alias("bin")) for n in BINS])).alias("c")).groupBy(
        "c.name", "c.bin").agg(F.sum("y").alias("good"), F.sum(1 - F.col("y")).alias("bad")).collect()
    evidence = F.lit(0.0)
    for n in BINS:
        own = [c for c in cells if c["name"] == n]
        good, bad = (sum(c[s] for c in own) + SMOOTH * len(own) for s in ("good", "bad"))
        table = {c["bin"]: (c["good"] + SMOOTH) / good / ((c["bad"] + SMOOTH) / bad) for c in own}
        pairs = [x for b, r in sorted(table.items()) for x in (F.lit(b), F.log(F.lit(float(r))))]
        if pairs:
            evidence = evidence + F.coalesce(F.element_at(F.create_map(*pairs), F.col(f"b_{n}")), F.lit(0.0))

    total = known.agg(F.avg("y")).first()[0]
    rate = min(0.999, max(0.001, total)) if total is not None else 0.5
    by_host = known.groupBy("host").agg(F.count("*").alias("n"), F.sum("y").alias("k"))
    m = _strength(by_host, F.lit(rate))
    hosts = staged(by_host.select("host", ((F.col("k") + m * rate) / (F.col("n") + m)).alias("host_rate")), "hosts")
    by_path = known.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("y").alias("k"))
    paths = by_path.join(hosts.withColumnRenamed("host", "__h"), F.col("host").eqNullSafe(F.col("__h")))
    m = _strength(paths, F.col("host_rate"))
    sites = staged(paths.select(F.col("host").alias("__host"), F.col("path").alias("__path"),
                                ((F.col("k") + m * F.col("host_rate")) / (F.col("n") + m)).alias("path_rate")), "paths")

    out = binned.join(hosts.withColumnRenamed("host", "__h"), F.col("host").eqNullSafe(F.col("__h")), "left").join(
        sites, F.col("host").eqNullSafe(F.col("__host")) & F.col("path").eqNullSafe(F.col("__path")), "left")
    out = out.select("doc_id", "host", "path", evidence.alias("evidence"), F.coalesce("host_rate", F.lit(rate)).alias("host_rate"),
                     F.coalesce("path_rate", "host_rate", F.lit(rate)).alias("path_rate"))
    odds = F.col("evidence") + F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    return out.withColumn("quality", 1 / (1 + F.exp(-odds))).withColumn("kept", F.col("quality") >= 0.5)
