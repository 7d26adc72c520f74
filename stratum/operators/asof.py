"""As-of joins: what held at a fact's own time.

Facts and the versions of what they refer to are put together, ordered by time
within a key, and each fact takes the last version before it: one shuffle and
one window, whatever the number of versions.  A key with many facts is cut
into slices, each with all versions of the key, so that no window holds more
than about ``rows_per_slice`` facts; facts do not depend on each other, so the
slices change no result.  The keys that are cut are few (facts over
``rows_per_slice`` of them at most).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.predicates import not_null

ROWS_PER_SLICE = 1_000_000


def as_of(facts: DataFrame, versions: DataFrame, keys: Sequence[str], fact_time: str, version_time: str, columns: Sequence[str], into: str,
          rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``facts`` and, as a struct ``into``, the ``columns`` of the version that held at ``fact_time``.

    That is the version of the greatest ``version_time`` not after it; null
    before the first one, without a time, or with a null key part.  Of
    versions with one time the greatest (``columns`` in order) counts.
    """
    keys = list(keys)
    whole = not_null([*keys, fact_time])
    able, unable = facts.where(whole), facts.where(~whole)
    dated = versions.where(not_null([*keys, version_time])).select(*keys, F.col(version_time).cast("timestamp").alias("_time"), F.struct(*columns).alias("_version"))
    hot = able.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_slice).select(
        *keys, F.ceil(F.col("_n") / rows_per_slice).cast("int").alias("_slices"))
    slices = F.coalesce("_slices", F.lit(1))
    f = able.join(hot, keys, "left").select(*keys, F.pmod(F.xxhash64(*[able[c] for c in facts.columns]), slices).cast("int").alias("_slice"),
                                            F.col(fact_time).cast("timestamp").alias("_time"), F.lit(None).cast(dated.schema["_version"].dataType).alias("_version"),
                                            F.struct(*[able[c] for c in facts.columns]).alias("_fact"))
    v = dated.join(hot, keys, "left").select(*keys, F.explode(F.sequence(F.lit(0), slices - 1)).alias("_slice"), "_time", "_version",
                                             F.lit(None).cast(f.schema["_fact"].dataType).alias("_fact"))
    # at one time versions come before facts, the greatest last
    order = Window.partitionBy(*keys, "_slice").orderBy("_time", F.col("_fact").isNotNull(), "_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = f.unionByName(v).withColumn(into, F.last("_version", ignorenulls=True).over(order)).where(F.col("_fact").isNotNull())
    return held.select("_fact.*", into).unionByName(unable.withColumn(into, F.lit(None).cast(dated.schema["_version"].dataType)))
