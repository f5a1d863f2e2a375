"""The hot-group-safe ordered scan against a plain pandas computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators.scan import Scan, global_position, ordered_scan


def _brute(pdf, group, order, val):
    pdf = pdf.sort_values(group + order).copy()
    g = pdf.groupby(group, dropna=False, sort=False) if group else pdf.groupby(np.zeros(len(pdf)))
    pdf["rn"] = g.cumcount() + 1
    pdf["s"] = g[val].transform(lambda x: x.fillna(0).cumsum())
    pdf["ff"] = g[val].transform(lambda x: x.ffill())
    pdf["lg"] = g[val].shift(1)
    return pdf


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("n_part", [1, 3, 7])
def test_scan_matches_pandas(spark, hot, n_part):
    rng = np.random.default_rng(7 + n_part)
    n = 3000
    grp = rng.integers(0, 40, n)
    if hot:                      # one group holds most of the rows
        grp[: 2 * n // 3] = 5
    vals = rng.integers(-50, 50, n)
    nulls = rng.random(n) < 0.3
    pdf = pd.DataFrame({"id": np.arange(n), "g": grp, "t": rng.permutation(n),
                        "v": np.where(nulls, np.nan, vals)})
    rows = [(int(i), int(g), int(t), None if m else int(v))
            for i, g, t, v, m in zip(pdf.id, pdf.g, pdf.t, vals, nulls)]
    df = spark.createDataFrame(rows, "id long, g long, t long, v long")
    res = ordered_scan(df, ["t", "id"], ["g"], [Scan("rn", "row_number"), Scan("s", "sum", "v"),
                                                Scan("ff", "ffill", "v"), Scan("lg", "lag", "v")],
                       n_partitions=n_part).toPandas().set_index("id").sort_index()
    exp = _brute(pdf, ["g"], ["t", "id"], "v").set_index("id").sort_index()
    assert (res["rn"].to_numpy() == exp["rn"].to_numpy()).all()
    assert np.allclose(res["s"].to_numpy(dtype=float), exp["s"].to_numpy(dtype=float))
    pd.testing.assert_series_equal(res["ff"].astype("float64"), exp["ff"].astype("float64"), check_names=False)
    pd.testing.assert_series_equal(res["lg"].astype("float64"), exp["lg"].astype("float64"), check_names=False)


def test_global_position(spark):
    df = spark.range(0, 5000).selectExpr("id", "(id * 7919) % 5000 as k")
    res = global_position(df, ["k", "id"], n_partitions=6)
    rows = sorted(res.collect(), key=lambda r: r.pos)
    assert [r.pos for r in rows] == list(range(1, 5001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan


def test_empty_input(spark):
    df = spark.range(0).selectExpr("id", "id as g")
    assert ordered_scan(df, ["id"], ["g"], [Scan("rn", "row_number")], n_partitions=3).count() == 0


@pytest.mark.parametrize("n_part", [1, 4, 9])
def test_segment_scan_matches_pandas(spark, n_part):
    rng = np.random.default_rng(11 + n_part)
    n = 2500
    grp = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 6, n))     # group 0 is hot
    t = np.cumsum(rng.integers(1, 40, n))
    rows = [(int(i), int(g), int(x)) for i, g, x in zip(range(n), grp, t)]
    df = spark.createDataFrame(rows, "id long, g long, t long")
    res = ordered_scan(df, ["t", "id"], ["g"], [Scan("seg", "segment", "t", gap=60)], n_partitions=n_part)
    got = {r.id: r.seg for r in res.collect()}
    pdf = pd.DataFrame(rows, columns=["id", "g", "t"]).sort_values(["g", "t", "id"])
    gap = pdf.groupby("g")["t"].diff()
    pdf["seg"] = (gap.isna() | (gap >= 60)).astype(int).groupby(pdf["g"]).cumsum()
    assert all(got[i] == s for i, s in zip(pdf["id"], pdf["seg"]))


def test_rows_do_not_rest_on_exchange_reuse(spark):
    df = spark.range(0, 20000, numPartitions=7).selectExpr("id", "(id * 31) % 20011 as k")
    res = global_position(df, ["k", "id"], n_partitions=5)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert sorted(r.pos for r in res.collect()) == list(range(1, 20001))
        assert spark.conf.get("spark.sql.exchange.reuse") == "false"
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_buckets_cut_a_hot_group(spark):
    from strata.operators.scan import _B, _bucketed

    df = spark.range(0, 8000).selectExpr("id", "if(id % 3 = 0, 7, id % 50) as g")
    sizes = [r["count"] for r in _bucketed(df, ["g", "id"], 10).groupBy(_B).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2.5 * 800


def test_keys_with_nulls_and_of_other_types(spark):
    import datetime
    import decimal

    rows = [(None if i % 11 == 0 else f"g{i % 3}", None if i % 7 == 0 else decimal.Decimal(i % 5),
             datetime.date(2020, 1, 1 + i % 20), bytes([i % 256]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, d decimal(10,2), t date, b binary, id long")
    res = ordered_scan(df, ["d", "t", "b", "id"], ["g"], [Scan("rn", "row_number"), Scan("lg", "lag", "id")],
                       n_partitions=5)
    got = {r.id: (r.rn, r.lg) for r in res.collect()}
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3], r[4]))
        for i, r in enumerate(mine):
            assert got[r[4]] == (i + 1, mine[i - 1][4] if i else None)


@pytest.mark.parametrize("n_part", [1, 4])
def test_sums_follow_spark(spark, n_part):
    from decimal import Decimal

    rows = [(i, Decimal("10000000000000000.01")) for i in range(1, 9)] + [(9, None)]
    df = spark.createDataFrame(rows, "t long, v decimal(20,2)")
    out = {r.t: r.s for r in ordered_scan(df, ["t"], [], [Scan("s", "sum", "v")], n_partitions=n_part).collect()}
    assert out == {t: min(t, 8) * Decimal("10000000000000000.01") for t in range(1, 10)}
    df = spark.createDataFrame([(1, 1.0), (2, float("inf")), (3, 2.0), (4, float("nan")), (5, 1.0)], "t long, v double")
    out = {r.t: r.s for r in ordered_scan(df, ["t"], [], [Scan("s", "sum", "v")], n_partitions=n_part).collect()}
    assert out[1] == 1.0 and out[2] == out[3] == float("inf") and np.isnan(out[4]) and np.isnan(out[5])
    df = spark.createDataFrame([(1, 2 ** 62), (2, 2 ** 62), (3, 2 ** 62)], "t long, v long")
    with pytest.raises(Exception, match="(?i)overflow"):
        ordered_scan(df, ["t"], [], [Scan("s", "sum", "v")], n_partitions=n_part).collect()


def test_bucket_count_follows_the_bytes(spark, monkeypatch):
    from strata.operators import splits as S

    assert S.measured_partitions(spark.range(10)) == 1
    monkeypatch.setattr(S, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(S, "SMALL_BUCKET_BYTES", 1000)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        assert S.measured_partitions(spark.range(100_000)) == 800          # 8 bytes a row, no session cap
        big = spark.range(2000).join(spark.range(2000).withColumnRenamed("id", "j"), F.col("id") == F.col("j"))
        assert S.measured_partitions(big) == 2000 * 16 // 1000             # bytes summed, not sizes multiplied
        wide = spark.range(50).selectExpr("id", "repeat('x', 10000) as s", "array(id, id) as a", "named_struct('a', 1) as m")
        n = S.measured_partitions(wide)
        assert 50 * 10_000 // 1000 <= n <= 50 * 10_100 // 1000             # wide rows count by their bytes
        assert S.plan(wide, ["id"])[0] == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_tasks_follow_buckets_and_plans_do_not_grow(spark):
    df = spark.range(0, 4000).selectExpr("id", "(id * 31) % 4001 as k", "id % 3 as g")
    sizes = []
    for n in (6, 60):
        placed = global_position(df, ["k", "id"], n_partitions=n)
        assert sorted(r.pos for r in placed.collect()) == list(range(1, 4001))
        scanned = ordered_scan(df, ["k", "id"], ["g"], [Scan("s", "sum", "id")], n_partitions=n)
        plan = scanned._jdf.queryExecution().optimizedPlan().toString()
        assert f", {n}" in plan and "shufflepartitionidpassthrough" in \
            scanned._jdf.queryExecution().executedPlan().toString().lower()
        sizes.append(len(plan))
    assert abs(sizes[1] - sizes[0]) < 200


def test_sum_is_exact_for_large_integers(spark):
    big = 2 ** 60
    df = spark.createDataFrame([(1, big + 1), (2, None), (3, big + 3)], "t long, v long")
    out = sorted((r.t, r.s) for r in ordered_scan(df, ["t"], [], [Scan("s", "sum", "v")], n_partitions=2).collect())
    assert out == [(1, big + 1), (2, big + 1), (3, 2 * big + 4)]
