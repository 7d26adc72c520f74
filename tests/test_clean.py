import pytest
from pyspark.sql import functions as F

from stratum.functions import clean
from stratum.operators.columns import validate_columns


def _col(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")


def _vals(df, c="x"):
    return [r[c] for r in df.orderBy("i").collect()]


def test_trim_null_tokens_upper_order(spark):
    df = _col(spark, [" ab ", " N/A ", "na", "n/a", "Null", "  ", None, "\tx"])
    out = clean.standardize(df, trim=["x"], null_tokens=["x"], upper=["x"])
    assert _vals(out) == ["AB", None, "NA", "N/A", "NULL", None, None, "\tX"]


def test_helpers_chain_equals_standardize(spark):
    df = _col(spark, [" ab ", " N/A ", "na", "n/a", "Null", "  ", None, "\tx"])
    chained = clean.uppercase_columns(clean.normalize_null_values(clean.trim_columns(df, ["x"]), ["x"]), ["x"])
    assert _vals(chained) == _vals(clean.standardize(df, trim=["x"], null_tokens=["x"], upper=["x"]))


def test_normalize_null_values_alone_keeps_untrimmed(spark):
    df = _col(spark, [" x ", " NULL ", "null", "N/A", "NA", "", "nA"])
    assert _vals(clean.normalize_null_values(df, ["x"])) == [" x ", None, None, None, None, None, "nA"]


def test_normalize_custom_tokens(spark):
    df = _col(spark, ["-", " - ", "x"])
    assert _vals(clean.normalize_null_values(df, ["x"], null_values=["-"])) == [None, None, "x"]


def test_nullify_empty_strings(spark):
    df = _col(spark, ["  ", " x ", "", None])
    assert _vals(clean.nullify_empty_strings(df, ["x"])) == [None, " x ", None, None]


def test_lowercase(spark):
    assert _vals(clean.lowercase_columns(_col(spark, ["AbC", None]), ["x"])) == ["abc", None]


def test_trim_keeps_tabs_and_newlines(spark):
    assert _vals(clean.trim_columns(_col(spark, ["\t a \n", "  b  "]), ["x"])) == ["\t a \n", "b"]


def test_record_id_skip_null(spark):
    df = spark.createDataFrame([("P1", None), (None, None), ("P2", "3")], "a string, b string")
    out = df.select(clean.record_id_concat_skip_null(["a", "b"]).alias("r"))
    assert [r.r for r in out.collect()] == ["P1", "", "P2|3"]


def test_record_id_keep_empty(spark):
    df = spark.createDataFrame([("2024-01-01", "M1", "P1", None)], "d string, m string, p string, s string")
    df = df.withColumn("d", F.col("d").cast("date"))
    out = df.select(clean.record_id_concat_keep_empty(["d", "m", "p", "s"]).alias("r"))
    assert out.first().r == "2024-01-01|M1|P1|"


def test_validate_columns_sorted_error(spark):
    df = _col(spark, ["a"])
    with pytest.raises(ValueError, match=r"\['aa', 'zz'\]"):
        validate_columns(df, ["zz", "aa", "x"])
    with pytest.raises(ValueError):
        clean.trim_columns(df, ["nope"])
