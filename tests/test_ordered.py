"""Skew-safe ordered helpers: forced segments must equal the plain window."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casework.functions.ordered import cut_points, running
from casework.functions.quantiles import exact_quantiles

FORCE = {"split_bytes": 0, "segments": 16, "samples": 4}


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows; another is null."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        key = "hot" if rng.random() < 0.66 else rng.choice(["a", "b", "c", None])
        rows.append((key, rng.randrange(500), i, rng.choice([None, rng.random()]), rng.randrange(10)))
    return spark.createDataFrame(rows, "k string, t int, id int, v double, n int").repartition(5)


def outputs():
    return {"no": ("number", None), "total": ("sum", "n"), "before": ("lag", "v"), "after": ("lead", "v"), "seen": ("last", "v"), "vsum": ("sum", "v"), "top": ("max", "v")}


@pytest.mark.parametrize("keys", [["k"], []])
def test_segments_equal_plain_window(skewed, keys):
    order = ["t", "id"]
    plain = {r.id: r for r in running(skewed, keys, order, **outputs()).collect()}
    cut = {r.id: r for r in running(skewed, keys, order, **FORCE, **outputs()).collect()}
    assert plain.keys() == cut.keys()
    for i, r in plain.items():
        c = cut[i]
        assert (r.no, r.total, r.before, r.after, r.seen, r.top) == (c.no, c.total, c.before, c.after, c.seen, c.top)
        assert r.vsum == pytest.approx(c.vsum) if r.vsum is not None else c.vsum is None


def test_only_hot_keys_are_cut(skewed):
    cuts, _ = cut_points(skewed, ["k"], [F.col("t"), F.col("id")], 16, 4)
    assert [c[0] for c in cuts][-1:] == ["hot"] and len(dict((c[0], 1) for c in cuts)) <= 2
    assert len(next(c for c in cuts if c[0] == "hot")[1]) >= 5


def test_timestamps_can_be_cut(spark):
    df = spark.range(4000).select(
        F.lit(1).alias("k"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 37 % 4000).cast("decimal(18,6)"))).alias("t"), "id"
    )
    out = running(df, ["k"], ["t", "id"], no=("number", None), **FORCE)
    assert out.where(F.col("no") != F.col("id") * 37 % 4000 + 1).count() == 0


@pytest.mark.parametrize("options", [{}, FORCE])
def test_exact_quantiles(skewed, options):
    probs = {"p10": 0.1, "p50": 0.5, "p95": 0.95}
    got = {r.k: r for r in exact_quantiles(skewed.where("k is not null"), ["k"], "v", probs, **options).collect()}
    rows = skewed.where("k is not null and v is not null").select("k", "v").collect()
    for k, r in got.items():
        values = [x.v for x in rows if x.k == k]
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p))
    everything = exact_quantiles(skewed, [], "v", probs, **options).collect()[0]
    assert everything.p50 == pytest.approx(np.quantile([r.v for r in skewed.where("v is not null").collect()], 0.5))
