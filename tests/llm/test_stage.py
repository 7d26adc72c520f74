"""Written intermediate tables."""

import os

import pyarrow as pa
import pytest

from stratum.llm import stage


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file:").replace("///", "/"))


def test_passing_tables_go_when_their_block_ends(spark):
    with stage.passing(spark) as put:
        one, two = put(spark.range(5), "one"), put(spark.range(0).selectExpr("id", "'x' as name"), "two")
        kept = stage.staged(one.join(two, "id", "left"), "kept")
        path = folder(one)
        assert os.path.isdir(path) and two.columns == ["id", "name"] and two.count() == 0
    assert not os.path.exists(path) and kept.count() == 5 and os.path.isdir(folder(kept))
    with pytest.raises(RuntimeError), stage.passing(spark) as put:
        path = folder(put(spark.range(5), "one"))
        raise RuntimeError("a later step failed")
    assert not os.path.exists(path)


def test_small_batches_hold_within_their_block(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    def largest():
        return max(r.n for r in spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long").collect())

    with stage.small_batches(spark):
        assert largest() == stage.BATCH_ROWS
        with stage.small_batches(spark):
            assert largest() == stage.BATCH_ROWS
    assert largest() == 5000
    spark.conf.set(stage.BATCH_CONF, "70")  # what a user set lower stays
    try:
        with stage.small_batches(spark):
            assert largest() == 70
        assert spark.conf.get(stage.BATCH_CONF) == "70"
    finally:
        spark.conf.unset(stage.BATCH_CONF)
