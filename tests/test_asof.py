"""As-of joins against brute force: ties, hot keys, nulls, facts before the first version."""

import datetime as dt
import random

from stratum.operators.asof import as_of


def test_equals_brute_force(spark):
    rng = random.Random(4)
    day = lambda n: None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    facts = [(i, "hot" if i % 3 else rng.choice("abc"), rng.choice(["x", "x", None]), day(rng.choice([None, *range(12)])), "note") for i in range(400)]
    versions = [(k, "x", day(rng.choice([None, *range(2, 10)])), rng.choice([True, False]), n) for n, k in enumerate(["hot", "a", "b", None] * 12)]
    f = spark.createDataFrame(facts, "id long, k string, part string, at timestamp, _note string").repartition(3)
    v = spark.createDataFrame(versions, "k string, part string, since timestamp, valid boolean, n int").repartition(3)

    def held(k, part, at):
        found = [(since, valid, n) for key, p, since, valid, n in versions if key is not None and key == k and p == part and since is not None and at is not None and since <= at]
        return max(found)[1:] if found else None

    expected = sorted((i, held(k, part, at)) for i, k, part, at, _ in facts)
    for rows_per_slice in (10_000, 20):  # one window for each key; many slices of the hot one
        out = as_of(f, v, ["k", "part"], "at", "since", ["valid", "n"], "then", rows_per_slice)
        assert out.columns == [*f.columns, "then"]
        assert sorted((r.id, None if r.then is None else tuple(r.then)) for r in out.collect()) == expected
    assert as_of(f, v.limit(0), ["k", "part"], "at", "since", ["valid"], "then").where("then is not null").count() == 0
    assert as_of(f.limit(0), v, ["k", "part"], "at", "since", ["valid"], "then").count() == 0


def test_slices_spread_a_hot_key(spark):
    f = spark.range(4000).selectExpr("id", "'k' as k", "timestamp'2024-01-02' as at")
    v = spark.sql("select 'k' as k, timestamp'2024-01-01' as since, 1 as n")
    out = as_of(f, v, ["k"], "at", "since", ["n"], "then", 100)
    assert out.where("then.n = 1").count() == 4000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_slice" in plan.split("Window", 1)[1]
