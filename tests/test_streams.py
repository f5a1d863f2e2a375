"""Stream twins: state across runs, and late requests."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.columns import micros
from strata.operators import lease as LS
from strata.session import fresh_dir
from strata.streaming import common as C
from strata.streaming import streams as S

T0 = dt.datetime(2024, 1, 1)


def _run(spark, parts):
    """Land each part, then run the lease stream once per part on one checkpoint."""
    C.use_rocksdb(spark)
    landing, out, ckpt = fresh_dir(spark, "t-land"), fresh_dir(spark, "t-out"), fresh_dir(spark, "t-ckpt")
    directory = spark.createDataFrame([("group01", "c1", 0), ("group02", "c1", 0)],
                                      "grp string, cluster string, cluster_order int")
    schema = "request_id long, ts timestamp_ntz, msg string"
    for rows in parts:
        spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), m) for i, s, m in rows], schema) \
             .write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        classified = LS.resolve_cluster(LS.parse_requests(stream), directory).withColumn("t_us", micros("ts"))
        C.run_available_now(S.streaming_leases(classified), C.append_batches(out), ckpt)
    return {r.request_id: (r.action, r.holder) for r in spark.read.parquet(out).collect()}


def test_state_survives_restart_and_late_requests_are_flagged(spark):
    got = _run(spark, [
        [(0, 0, "group01"), (1, 100, "group02")],
        [(2, 200, "group02"), (3, 50, "group02"), (4, 1000, "group02")],   # 3 is older than 1
    ])
    assert got[0] == ("book", "group01")
    assert got[1] == ("wait", "group01")
    assert got[2] == ("wait", "group01")          # the booking from the first run is still live
    assert got[3][0] == "late"
    assert got[4] == ("book", "group02")          # 1000 s after the booking: expired


def _run_batched(spark, parts):
    landing, out = fresh_dir(spark, "tb-land"), fresh_dir(spark, "tb-out")
    state, ckpt = fresh_dir(spark, "tb-state"), fresh_dir(spark, "tb-ckpt")
    directory = spark.createDataFrame([("group01", "c1", 0), ("group02", "c1", 0)],
                                      "grp string, cluster string, cluster_order int")
    schema = "request_id long, ts timestamp_ntz, msg string"
    for rows in parts:
        spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), m) for i, s, m in rows], schema) \
             .write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        classified = LS.resolve_cluster(LS.parse_requests(stream), directory).withColumn("t_us", micros("ts"))
        C.run_available_now(classified, S.lease_batches_sink(out, state), ckpt)
    return {r.request_id: (r.action, r.holder) for r in spark.read.parquet(out).collect()}


def test_batched_lease_stream_carries_state_and_flags_late(spark):
    got = _run_batched(spark, [
        [(0, 0, "group01"), (1, 100, "group02")],
        [(2, 200, "group02"), (3, 50, "group02"), (4, 1000, "group02"), (5, 1010, "group01 off")],
    ])
    assert got[0] == ("book", "group01")
    assert got[1] == ("wait", "group01")
    assert got[2] == ("wait", "group01")          # the lease from the first run is still live
    assert got[3][0] == "late"
    assert got[4] == ("book", "group02")
    assert got[5] == ("status", "group02")        # group01 no longer holds it


def test_sinks_are_idempotent_on_replay(spark):
    ev = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=10 * i)) for i in range(10)],
                               "event_id long, ts timestamp_ntz")
    out, totals = fresh_dir(spark, "tr-out"), fresh_dir(spark, "tr-totals")
    sink = S.counter_values_sink(out, totals, ["ts", "event_id"])
    first, second = ev.where("event_id < 6"), ev.where("event_id >= 6")
    sink(first, 0)
    sink(first, 0)            # replay after a failure
    sink(second, 1)
    got = sorted((r.event_id, r.counter) for r in spark.read.parquet(out).collect())
    assert got == [(i, i + 1) for i in range(10)]

    directory = spark.createDataFrame([("group01", "c1", 0), ("group02", "c1", 0)],
                                      "grp string, cluster string, cluster_order int")
    req = spark.createDataFrame([(0, T0, "group01"), (1, T0 + dt.timedelta(seconds=100), "group02"),
                                 (2, T0 + dt.timedelta(seconds=200), "group02")],
                                "request_id long, ts timestamp_ntz, msg string")
    classified = LS.resolve_cluster(LS.parse_requests(req), directory).withColumn("t_us", micros("ts"))
    out2, state = fresh_dir(spark, "tr-out2"), fresh_dir(spark, "tr-state")
    lease = S.lease_batches_sink(out2, state)
    a, b = classified.where("request_id < 2"), classified.where("request_id >= 2")
    lease(a, 0)
    lease(a, 0)
    lease(b, 1)
    got2 = {r.request_id: (r.action, r.holder) for r in spark.read.parquet(out2).collect()}
    assert got2 == {0: ("book", "group01"), 1: ("wait", "group01"), 2: ("wait", "group01")}


def test_negative_ids_are_answered(spark):
    got = _run_batched(spark, [[(-7, 0, "group01"), (3, 100, "group02")], [(-9, 200, "group02"), (-2, 1000, "group02")]])
    assert got == {-7: ("book", "group01"), 3: ("wait", "group01"), -9: ("wait", "group01"), -2: ("book", "group02")}


def test_an_unreadable_state_fails_the_batch(spark):
    import pytest

    ev = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=10 * i)) for i in range(10)],
                               "event_id long, ts timestamp_ntz")
    out, totals = fresh_dir(spark, "tu-out"), fresh_dir(spark, "tu-totals")
    sink = S.counter_values_sink(out, totals, ["ts", "event_id"])
    sink(ev.where("event_id < 5"), 0)
    spark.createDataFrame([("not a total",)], "total string").write.mode("overwrite").text(f"{totals}/batch_id=0")
    with pytest.raises(Exception):
        sink(ev.where("event_id >= 5"), 1)
    with pytest.raises(Exception):
        S.lease_batches_sink(out, fresh_dir(spark, "tu-state"))(ev, 1)      # batch 1 without the state of batch 0


def test_late_requests_are_counted(spark):
    df = spark.createDataFrame([("c1", "book"), ("c1", "late"), ("c1", "wait"), (None, "status")], "cluster string, action string")
    assert [tuple(r) for r in S.late_requests(df).collect()] == [("c1", 2, 1)]


def _leases(spark, parts, **options):
    """(answers, last query): each part is landed and run on one checkpoint."""
    C.use_rocksdb(spark)
    landing, out = fresh_dir(spark, "te-land"), fresh_dir(spark, "te-out")
    ckpt = options.pop("ckpt", None) or fresh_dir(spark, "te-ckpt")
    schema = "request_id long, ts timestamp_ntz, msg string"
    directory = spark.createDataFrame([("group01", "c1", 0), ("group02", "c1", 0), ("group03", "c2", 0)],
                                      "grp string, cluster string, cluster_order int")
    for rows in parts:
        spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), m) for i, s, m in rows], schema) \
             .write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        classified = LS.resolve_cluster(LS.parse_requests(stream), directory).withColumn("t_us", micros("ts"))
        q = C.run_available_now(S.streaming_leases(classified, **options), C.append_batches(out), ckpt)
    return sorted((r.request_id, r.cluster, r.grp, r.action, r.holder) for r in spark.read.parquet(out).collect()
                  if r.action != "expired"), sorted(
        (r.cluster, r.grp, r.booked_us) for r in spark.read.parquet(out).where("action = 'expired'").collect()), q


def test_timers_answer_leases_that_run_out_without_a_request(spark):
    us = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    # only c2 is asked again: its request moves the watermark past c1's limit; c1 gets no request
    answers, expired, _ = _leases(spark, [[(0, 0, "group01"), (1, 10, "group03"), (2, 20, "group03 off")],
                                          [(3, 950, "group03")]], expire=True)
    assert expired == [("c1", "group01", us)]
    assert [a[3] for a in answers] == ["book", "book", "off", "book"]
    # a request that finds the lease run out answers it once, and the timer does not again
    answers, expired, _ = _leases(spark, [[(0, 0, "group01"), (1, 1000, "group02")], [(2, 1100, "group01"), (3, 2500, "group03")]],
                                  expire=True)
    assert expired == [("c1", "group01", us), ("c1", "group02", us + 1_000_000_000)]
    assert [(a[0], a[3]) for a in answers] == [(0, "book"), (1, "book"), (2, "wait"), (3, "book")]


def test_requests_behind_the_watermark_are_counted_by_the_query(spark):
    parts = [[(0, 0, "group01"), (1, 600, "group03")], [(2, 100, "group02"), (3, 550, "group02"), (4, 700, "group02")]]
    answers, _, q = _leases(spark, parts, expire=True, lateness_s=100)
    assert S.dropped_late(q) == 1                                        # 100 s is behind 600 s - 100 s
    assert [a[0] for a in answers] == [0, 1, 3, 4]


def test_state_is_exported_and_starts_a_new_checkpoint(spark):
    import os

    from strata.session import remove_folder

    first = [(0, 0, "group01"), (1, 100, "group02"), (5, 150, "group03"), (6, 160, "group03 off")]
    second = [(2, 200, "group02"), (3, 50, "group02"), (4, 1000, "group02"), (7, 1010, "group03")]
    whole, _, _ = _leases(spark, [first, second])
    ckpt = fresh_dir(spark, "te-first")
    one, _, _ = _leases(spark, [first], ckpt=ckpt)
    state = S.export_leases(spark, ckpt)
    rows = state.collect()
    assert {(r.cluster, r.holder, r.last_id) for r in rows} == {("c1", "group01", 1), ("c2", "", 6)}
    snapshot = spark.createDataFrame(rows, state.schema)
    remove_folder(spark, ckpt)
    assert not os.path.exists(ckpt)
    two, _, _ = _leases(spark, [second], initial=snapshot)
    assert sorted(one + two) == whole and ("late" in {a[3] for a in two})
