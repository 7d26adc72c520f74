import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators.merge import assert_unique_keys, count_unique_keys, insert_only, merge_condition, new_rows, upsert

S = "k string, loc string, v string, created timestamp"
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_update_insert_untouched_preserved(spark):
    target = spark.createDataFrame([("A", "x", "old", T1), ("B", "x", "keep", T1)], S)
    source = spark.createDataFrame([("A", "x", "new", T2), ("C", "x", "ins", T2)], S)
    out = upsert(target, source, ["k", "loc"], exclude_update_columns=["created"])
    assert _rows(out) == _rows(spark.createDataFrame(
        [("A", "x", "new", T1), ("B", "x", "keep", T1), ("C", "x", "ins", T2)], S))


def test_upsert_empty_source_is_target(spark):
    target = spark.createDataFrame([("A", "x", "old", T1)], S)
    assert _rows(upsert(target, spark.createDataFrame([], S), ["k", "loc"])) == _rows(target)


def test_upsert_null_key_part_safe_vs_plain(spark):
    target = spark.createDataFrame([("A", None, "old", T1)], S)
    source = spark.createDataFrame([("A", None, "new", T2)], S)
    safe = upsert(target, source, ["k", "loc"], null_safe=True)
    plain = upsert(target, source, ["k", "loc"], null_safe=False)
    assert _rows(safe) == [("A", None, "new", T2)]
    assert len(plain.collect()) == 2  # inserted again (reference behaviour, D5)


def test_duplicate_source_key_fails(spark):
    source = spark.createDataFrame([("A", "x", "1", T1), ("A", "x", "2", T1)], S)
    with pytest.raises(ValueError, match="duplicate"):
        assert_unique_keys(source, ["k", "loc"])


def test_empty_key_list(spark):
    df = spark.createDataFrame([], S)
    with pytest.raises(ValueError):
        merge_condition([], df, df)
    with pytest.raises(ValueError):
        upsert(df, df, [])


def test_column_mismatch_fails(spark):
    a = spark.createDataFrame([], S)
    with pytest.raises(ValueError, match="differ"):
        upsert(a, a.drop("v"), ["k"])


def test_insert_only(spark):
    target = spark.createDataFrame([("A", "x", "old", T1)], S)
    source = spark.createDataFrame([("A", "x", "changed", T2), ("B", "x", "new", T2)], S)
    out = insert_only(target, source, ["k", "loc"])
    assert _rows(out) == _rows(spark.createDataFrame([("A", "x", "old", T1), ("B", "x", "new", T2)], S))
    assert [r.k for r in new_rows(target, source, ["k", "loc"]).collect()] == ["B"]


keyed = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from(["x", None]),
                           st.text("pq", max_size=2)), max_size=8)


def _unique(rows, ts):
    seen, out = set(), []
    for k, loc, v in rows:
        if (k, loc) not in seen:
            seen.add((k, loc))
            out.append((k, loc, v, ts))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(t_rows=keyed, s_rows=keyed)
def test_upsert_properties(spark, t_rows, s_rows):
    t = spark.createDataFrame(_unique(t_rows, T1), S)
    s = spark.createDataFrame(_unique(s_rows, T2), S)
    once = upsert(t, s, ["k", "loc"], ["created"])
    keys = {(r.k, r.loc) for r in once.collect()}
    assert keys == {(r[0], r[1]) for r in _unique(t_rows, T1)} | {(r[0], r[1]) for r in _unique(s_rows, T2)}
    assert len(keys) == once.count()
    twice = upsert(once, s, ["k", "loc"], ["created"])
    assert _rows(once) == _rows(twice)  # idempotent (null-safe)
    # insert-only never changes an existing target row
    ins = {(r.k, r.loc): tuple(r) for r in insert_only(t, s, ["k", "loc"], null_safe=True).collect()}
    for row in _unique(t_rows, T1):
        assert ins[(row[0], row[1])] == row


def test_unique_keys_are_counted_by_hashes(spark):
    kind = "k string, loc string"
    alike = spark.createDataFrame([("A", None), (None, "A"), ("B", "x")], kind)  # the first two have one hash, not one key
    assert alike.selectExpr("xxhash64(k, loc) AS h").distinct().count() == 2
    assert count_unique_keys(alike, ["k", "loc"]) == 3 and count_unique_keys(alike.limit(0), ["k", "loc"]) == 0
    for twice in ([("A", None)] * 2, [("B", "x")] * 2):
        with pytest.raises(ValueError, match="duplicate keys"):
            count_unique_keys(alike.unionByName(spark.createDataFrame(twice, kind)), ["k", "loc"])
    nulls = spark.createDataFrame([("A", None)] * 2, kind)
    assert count_unique_keys(nulls, ["k", "loc"], null_safe=False) == 2
