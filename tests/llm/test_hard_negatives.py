"""Hard negatives against scoring everything, bounds against true scores, odd rows."""

import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.llm import hard_negatives, queries
from tools.check_oracle import digest, duck

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, block int, q string"


def plain(rows, divisor=10, positives=5, negatives=10):
    """By the definition, with Python's whole numbers."""
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in v):
            continue
        if i not in held or (label, v) < held[i]:
            held[i] = (label, v)
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in held.items()}
    most, out = 2**63 - 1, []
    for a, (label, v) in q.items():
        if a % divisor:
            continue
        scores = {i: (other, max(-most, min(most, sum(x * y for x, y in zip(v, w))))) for i, (other, w) in q.items() if i != a}
        own = sorted((-s, i) for i, (other, s) in scores.items() if other == label)[:positives]
        for p, i in own:
            inside = sorted((-s, j) for j, (other, s) in scores.items() if other != label and 30 * -p <= 100 * s <= 90 * -p)[:negatives]
            out += [(a, i, n, j, -p, -s) for n, (s, j) in enumerate(inside, 1)]
    return sorted(out)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, label, "x", 7, "y") for i, v, label in rows], SCHEMA).repartition(parts)


def mined(df, divisor=10, **how):
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % divisor == 0, **how).collect()))


def clustered(seed, n, dims=6, grid=None):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    x = centres[rng.integers(0, 4, n)] + 0.4 * rng.normal(size=(n, dims))
    x = np.round(x * grid) / grid if grid else x
    return [(i, x[i].tolist(), int(label)) for i, label in enumerate(rng.integers(0, 4, n))]


@pytest.mark.parametrize("how", [{}, {"block_rows": 16}, {"references": 1}, {"references": 2, "block_rows": 3}, {"positives": 2, "negatives": 3, "block_rows": 50}])
def test_equals_scoring_everything(spark, how):
    rows = clustered(1, 400)
    assert mined(frame(spark, rows), **how) == plain(rows, **{k: v for k, v in how.items() if k in ("positives", "negatives")})


def test_ties_and_a_hot_vector(spark):
    """Few distinct scores; a third of the rows are one vector; one label holds half of them."""
    rows = [(i, [0.5, 1.0, 0.0] if i % 3 == 0 else v[:3], 1 if i % 2 else label) for i, v, label in clustered(2, 500, 3, grid=2)]
    assert mined(frame(spark, rows), block_rows=40) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(3, 120)
    rows += [(None, [1.0] * 6, 1), (1000, None, 1), (1001, [1.0] * 6, None), (1002, [1.0, None], 1), (1003, [nan] * 6, 1), (1004, [inf] * 6, 1), (1005, [1e307] * 6, 1),
             (1010, [], 1), (1020, [0.0] * 6, 2), (1030, [0.7], 1), (1040, [0.5] * 9, 2), (1050, [1e30, -1e30, 1.0], 2), (1060, [3e5] * 4, 1), (1061, [2e5] * 4, 2),
             (1070, [-1.0] * 6, 3), (-10, [0.3] * 6, 1), (-7, [0.4] * 6, 2), *rows[:5], (10, [9.0] * 6, 0), (20, [1.0] * 6, 99)]
    assert mined(frame(spark, rows)) == plain(rows)
    assert mined(frame(spark, rows), block_rows=7) == plain(rows)


def test_none_and_few_rows(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)], [(0, [0.0], 1), (1, [0.0], 1), (2, [0.0], 2)]):
        assert mined(frame(spark, rows, 1)) == plain(rows)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.sampled_from([0.01, 1.0, 300.0]))
def test_bounds_hold(seed, dims, size):
    rng = np.random.default_rng(seed)
    q, x = (np.floor(256 * size * (rng.normal(size=(n, dims)) + rng.normal(size=dims))) for n in (7, 40))
    x[:3] = q[0]  # angles of nought
    x[3] = 0
    q[1] = -x[5]
    units = rng.normal(size=(4, dims))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    units[0] = q[0] / max(1e-9, np.linalg.norm(q[0])) if q[0].any() else units[0]
    nq, nx = hard_negatives._norms(q), hard_negatives._norms(x)
    a, b = hard_negatives.angles(q, nq, units), hard_negatives.angles(x, nx, units)
    for width in (1, 8):
        s = np.arange(0, len(x), width)
        least, most = hard_negatives.window_bounds(a, nq, np.minimum.reduceat(b, s), np.maximum.reduceat(b, s), np.minimum.reduceat(nx, s), np.maximum.reduceat(nx, s))
        scores = q @ x.T
        assert (np.repeat(least, width, axis=1)[:, : len(x)] <= scores).all() and (scores <= np.repeat(most, width, axis=1)[:, : len(x)]).all()


def test_bounds_of_blocks_hold_and_windows_are_left_out(spark):
    rows = clustered(5, 600, 4)
    index = hard_negatives.index(frame(spark, rows), block_rows=32)
    refs = len(index.first().angles)
    vectors = {r.vec_id: np.array(r.q) for r in index.collect()}
    of = {}
    for r in index.collect():
        of.setdefault(r.block, []).append(r.vec_id)
    pairs = hard_negatives._pairs(index.where("vec_id % 50 = 0").drop("block"), hard_negatives._summaries(index, refs), refs, 3).collect()
    assert len(pairs) == 12 * len(of)
    for p in pairs:
        scores = [int(vectors[p.vec_id] @ vectors[i]) for i in of[p.block]]
        assert p.least <= min(scores) and max(scores) <= p.most
    # narrow windows: most of them are not scored for a range that few rows reach
    own = index.where(F.col("block") == max(of, key=lambda b: len(of[b]))).orderBy("label", "vec_id").toArrow()
    block = hard_negatives.Block(own, window=1)
    q, a, norms = block.q[:4], np.array(own["angles"].to_pylist())[:4], block.norms[:4]
    top = [np.array([[float(n * n) * 0.95, np.inf]]) for n in norms]
    seen = sum(len(places) for _, places, _ in block.scored(q, a, norms, top))
    assert 4 <= seen < 0.7 * 4 * len(block.ids)


def test_first_breaks_ties_by_id():
    ids, scores = np.array([9, 3, 5, 1, 7]), np.array([4, 4, 9, 4, 1])
    assert ids[hard_negatives.first(ids, scores, 3)].tolist() == [5, 1, 3]
    assert ids[hard_negatives.first(ids, scores, 9)].tolist() == [5, 1, 3, 9, 7]


def test_lists_are_filled_with_zeros():
    m = hard_negatives._matrix(pa.array([[1.0, 2.0], [], [3.0]], pa.list_(pa.float64())).slice(0, 3), 3)
    assert m.tolist() == [[1, 2, 0], [0, 0, 0], [3, 0, 0]]
    m = hard_negatives._matrix(pa.array([[1.0], [2.0, 5.0], [3.0]], pa.list_(pa.float64())).slice(1, 2), 2)
    assert m.tolist() == [[2, 5], [3, 0]]


def test_query_equals_its_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        got = queries.op13_angular_hard_negatives(spark, sf).toPandas()
        assert digest(got) == digest(duck(sf).execute(queries.SQL["op13_angular_hard_negatives"]).df())
