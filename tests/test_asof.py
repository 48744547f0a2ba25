"""As-of nearest join (E3-E5) and agreement with pandas."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wattgrid.operators.asof import merge_nearest, merge_weather

T0 = dt.datetime(2024, 1, 1)


def frames(spark, left_minutes, right):
    left = spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m)) for i, m in enumerate(left_minutes)],
                                 "lid long, ts timestamp_ntz")
    r = spark.createDataFrame([(T0 + dt.timedelta(minutes=m), float(v), i) for i, (m, v) in enumerate(right)],
                              "ts timestamp_ntz, w double, rseq long")
    return left, r


def matched(spark, left_minutes, right, tol="1h"):
    left, r = frames(spark, left_minutes, right)
    out = merge_nearest(left, r, tolerance=tol, right_order="rseq").orderBy("lid").collect()
    return [row["w"] for row in out]


def test_e3_tie_goes_to_the_earlier_row(spark):
    assert matched(spark, [60], [(30, 1), (90, 2)]) == [1.0]


def test_e4_tolerance_is_inclusive(spark):
    assert matched(spark, [9 * 60], [(10 * 60, 3)]) == [3.0]
    assert matched(spark, [9 * 60], [(10 * 60 + 1, 3)]) == [None]


def test_e5_duplicates(spark):
    assert matched(spark, [60], [(60, 1), (60, 2)]) == [2.0]
    assert matched(spark, [60], [(61, 1), (61, 2)]) == [1.0]


def test_overlapping_names_get_suffixes(spark):
    left = spark.createDataFrame([(T0, 1.0)], "ts timestamp_ntz, v double")
    right = spark.createDataFrame([(T0, 2.0)], "ts timestamp_ntz, v double")
    out = merge_nearest(left, right)
    assert set(out.columns) == {"ts", "v_x", "v_y"}
    assert merge_weather(left, None) is left


def test_matches_pandas_on_random_series(spark):
    rng = np.random.default_rng(5)
    for trial in range(4):
        lm = np.sort(rng.integers(0, 600, 40))
        rm = np.sort(rng.integers(0, 600, 25))
        rv = rng.integers(0, 1000, 25)
        got = matched(spark, lm.tolist(), list(zip(rm.tolist(), rv.tolist())), tol="30min")
        lp = pd.DataFrame({"ts": [T0 + dt.timedelta(minutes=int(m)) for m in lm]})
        rp = pd.DataFrame({"ts": [T0 + dt.timedelta(minutes=int(m)) for m in rm], "w": rv.astype(float)})
        exp = pd.merge_asof(lp, rp, on="ts", direction="nearest", tolerance=pd.Timedelta("30min"))["w"]
        assert [None if pd.isna(x) else x for x in exp] == got, trial


def test_keyed_join(spark):
    left = spark.createDataFrame([(1, T0), (2, T0)], "k long, ts timestamp_ntz")
    right = spark.createDataFrame([(1, T0, 1.0), (2, T0 + dt.timedelta(minutes=5), 2.0)],
                                  "k long, ts timestamp_ntz, w double")
    out = {r["k"]: r["w"] for r in merge_nearest(left, right, by=["k"]).collect()}
    assert out == {1: 1.0, 2: 2.0}


def test_salted_join_gives_the_same_rows(spark):
    rng = np.random.default_rng(9)
    lm = np.sort(rng.integers(0, 300, 200)).tolist()
    rm = np.sort(rng.integers(0, 300, 30)).tolist()
    left, r = frames(spark, lm, list(zip(rm, range(len(rm)))))
    plain = merge_nearest(left, r, tolerance="20min", right_order="rseq").orderBy("lid").collect()
    salted = merge_nearest(left, r, tolerance="20min", right_order="rseq", salt=5).orderBy("lid").collect()
    assert plain == salted


def test_keyed_suffixes_duplicates_and_null_keys(spark):
    schema = "k long, ts timestamp_ntz, v long"
    big = 9007199254740993
    left = spark.createDataFrame([(1, T0, 5), (2, T0, 6), (3, T0, 7), (None, T0, 8), (1, None, 9)], schema)
    right = spark.createDataFrame([(1, T0, big), (2, T0 + dt.timedelta(minutes=5), None),
                                   (2, T0 + dt.timedelta(minutes=5), 3), (None, T0, 4), (1, None, 1)], schema)
    out = merge_nearest(left, right.withColumn("o", F.monotonically_increasing_id()), by=["k"], right_order="o").drop("o")
    assert set(out.columns) == {"k", "ts", "v_x", "v_y"}
    assert {r["v_x"]: r["v_y"] for r in out.collect()} == {5: big, 6: None, 7: None, 8: None, 9: None}


def test_pieces_of_any_size_give_the_same_rows(spark):
    """A third of all rows in one bucket, ties, duplicates, cells that are hot by
    themselves; against pandas, whatever the size of a piece."""
    rng = np.random.default_rng(3)
    lm = np.sort(np.concatenate([rng.integers(0, 3000, 300), rng.integers(600, 640, 150), np.full(60, 615)]))
    rm = np.sort(np.concatenate([rng.integers(0, 3000, 60), rng.integers(600, 640, 60), np.full(9, 615)]))
    lp = pd.DataFrame({"ts": [T0 + dt.timedelta(minutes=int(m)) for m in lm]})
    rp = pd.DataFrame({"ts": [T0 + dt.timedelta(minutes=int(m)) for m in rm], "w": np.arange(len(rm), dtype=float)})
    exp = pd.merge_asof(lp, rp, on="ts", direction="nearest", tolerance=pd.Timedelta("40min"))["w"]
    exp = [None if pd.isna(x) else x for x in exp]
    left, r = frames(spark, lm.tolist(), [(int(m), i) for i, m in enumerate(rm)])
    for rows, salt in ((7, None), (40, 3), (10_000, None)):
        out = merge_nearest(left, r, tolerance="40min", right_order="rseq", part_rows=rows, salt=salt)
        assert [x["w"] for x in out.orderBy("lid").collect()] == exp, (rows, salt)


def test_hot_bucket_is_spread_over_pieces(spark):
    """Half of the left rows in one hour, a third of these in one second: no
    window partition has much more rows than asked for."""
    from wattgrid.operators.asof import _staged

    rng = np.random.default_rng(4)
    seconds = np.concatenate([rng.integers(0, 3_600_000, 3000), 7200 + rng.integers(0, 3600, 2000), np.full(1000, 9000)])
    left = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=int(x))) for i, x in enumerate(seconds)], "lid long, ts timestamp_ntz")
    right = spark.createDataFrame([(T0 + dt.timedelta(seconds=int(x)), float(x)) for x in rng.integers(0, 3_600_000, 500)],
                                  "ts timestamp_ntz, w double")
    staged = _staged(left, right, "ts", [], "1h", None, ("_x", "_y"), None, 100)[0]
    sizes = sorted(r["n"] for r in staged.groupBy("_key", "_b", "_p", "_salt").agg(F.count("*").alias("n")).collect())
    assert sum(sizes) >= len(seconds) and sizes[-1] <= 250
    assert merge_nearest(left, right, part_rows=100).count() == len(seconds)
