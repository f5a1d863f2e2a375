"""Lease resolution (L1-L12) on the fixture's lease case, and the segmented
fold against a plain sequential fold on random request logs."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import lease as LS

T0 = dt.datetime(2024, 1, 1)
CASE = [  # (t seconds, message, action, holder after)
    (0, "group01", "book", "group01"),
    (60, "group02", "wait", "group01"),
    (100, "group01", "wait", "group01"),
    (200, "group02 off", "status", "group01"),
    (300, "group01 off", "off", ""),
    (310, "group02", "book", "group02"),
    (1209, "group03", "wait", "group02"),
    (1210, "group03", "book", "group03"),
    (1300, "group03 now", "wait", "group03"),
    (1310, "group03 off please", "wait", "group03"),
    (2200, "group04", "book", "group04"),
    (3100, "group04 off", "status", ""),
    (3200, "status", "status", None),
    (3300, "group99", "wrong_group", None),
]


def _directory(spark):
    rows = [(f"group{4 * c + g + 1:02d}", f"c{c + 1}", c) for c in range(4) for g in range(4)]
    return spark.createDataFrame(rows, "grp string, cluster string, cluster_order int")


def _requests(spark, case):
    rows = [(i, T0 + dt.timedelta(seconds=t), m) for i, (t, m, *_ ) in enumerate(case)]
    return spark.createDataFrame(rows, "request_id long, ts timestamp_ntz, msg string")


def _resolve(spark, case, n=3):
    c = LS.resolve_cluster(LS.parse_requests(_requests(spark, case)), _directory(spark))
    return LS.resolve_leases(c, n_partitions=n)


def test_lease_case(spark):
    r = _resolve(spark, CASE)
    got = {x.request_id: (x.action, x.holder) for x in r.collect()}
    for i, (_, _, action, holder) in enumerate(CASE):
        assert got[i] == (action, holder), (i, CASE[i], got[i])
    waits = {x.request_id: (x.wait_min, x.wait_sec) for x in LS.wait_time(r).collect()}
    assert waits[1] == (14, 0) and waits[6] == (0, 1)
    iv = {x.booking_id: (x.end_reason, x.held_us // 1_000_000) for x in LS.lease_intervals(r).collect()}
    assert iv == {0: ("off", 300), 5: ("expired", 900), 7: ("expired", 900), 10: ("expired", 900)}
    replies = {x.request_id: x.reply for x in LS.replies(r, ["c1", "c2", "c3", "c4"]).collect()}
    assert replies[1].startswith("group01 is on c1. Please wait for [14 min 0 sec].\n")
    assert replies[0].split("\n")[1] == '["c1": group01] ["c2": ] ["c3": ] ["c4": ]'
    assert replies[13].startswith("Wrong Group Name.")
    assert replies[4].startswith("[group01] Your booking is off.")


def test_parse_edges(spark):
    df = spark.createDataFrame([("  group01   off ",), ("group01 off please",), ("",), ("status",)], "msg string")
    got = [(r.grp, r.is_off) for r in LS.parse_requests(df).collect()]
    assert got == [("group01", True), ("group01", False), ("", False), ("status", False)]


def test_status_and_detectors(spark):
    r = _resolve(spark, CASE)
    us = lambda s: int(s * 1_000_000) + int((T0 - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    probes = spark.createDataFrame([(1, us(50)), (2, us(305)), (3, us(1220)), (4, us(2119))],
                                   "probe_id long, t_us long")
    snap = {(x.probe_id, x.cluster): x.holder for x in LS.status_snapshot(r, probes, ["c1", "c2"]).collect()}
    assert snap[(1, "c1")] == "group01" and snap[(2, "c1")] == "" and snap[(3, "c1")] == "group03"
    assert snap[(4, "c1")] == "" and snap[(1, "c2")] == ""          # 909 s old: expired
    # jobs seen while free, aged from the last booking start (the off at 300 does not reset it)
    seen = spark.createDataFrame([(1, "c1", us(300 + 1)), (2, "c1", us(419)), (3, "c1", us(420)),
                                  (4, "c1", us(2119 + 1)), (5, "c2", us(10))],
                                 "probe_id long, cluster string, t_us long")
    flagged = {x.probe_id for x in LS.idle_jobs(r, seen).collect()}
    assert flagged == {1, 4, 5}
    # free for 119 s after the booking start: not flagged; 120 s: flagged
    short = [(0, "group05", None, None), (50, "group05 off", None, None)]
    r2 = _resolve(spark, short)
    seen3 = spark.createDataFrame([(8, "c2", us(119)), (9, "c2", us(120))], "probe_id long, cluster string, t_us long")
    assert {x.probe_id for x in LS.idle_jobs(r2, seen3).collect()} == {9}
    seen2 = spark.createDataFrame([(6, "c1", us(3101)), (7, "c1", us(3150))], "probe_id long, cluster string, t_us long")
    assert {x.probe_id for x in LS.idle_jobs(r, seen2).collect()} == {6, 7}
    # foreign paths: within 10 s of a booking, minus white list and own folder
    lst = spark.createDataFrame([(1, "c1", us(1215), "/user/group03"), (1, "c1", us(1215), "/tmp"),
                                 (1, "c1", us(1215), "/user/group02"), (2, "c1", us(1221), "/x")],
                                "probe_id long, cluster string, t_us long, path string")
    assert [(x.probe_id, x.path) for x in LS.foreign_paths(r, lst).collect()] == [(1, "/user/group02")]


def _plain_fold(case_rows, limit=900):
    """Sequential reference: one cluster, no segments."""
    holder, booked, out = "", None, []
    for t, grp, off in case_rows:
        live = holder != "" and t - booked < limit
        if not live:
            holder = ""
        if off:
            if live and holder == grp:
                out.append("off")
                holder = ""
            else:
                out.append("status")
        elif not live:
            out.append("book")
            holder, booked = grp, t
        else:
            out.append("wait")
    return out


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 1100), st.integers(1, 3), st.booleans()), min_size=1, max_size=60))
def test_segmented_fold_equals_plain_fold(spark, steps):
    t, case = 0, []
    for gap, g, off in steps:
        t += gap
        case.append((t, f"group0{g}" + (" off" if off else ""), None, None))
    r = _resolve(spark, case, n=4)
    got = [x.action for x in r.orderBy("request_id").collect()]
    plain = _plain_fold([(tt, m.split()[0], m.endswith(" off")) for tt, m, *_ in case])
    assert got == plain


def test_dense_and_sparse_stretches(spark):
    """One long segment, then short ones, over several buckets."""
    import random

    rnd = random.Random(5)
    case, t = [], 0
    for i in range(260):
        t += rnd.randint(1, 120) if i < 200 else rnd.randint(600, 1200)   # dense, then sparse
        g = rnd.randint(1, 3)
        case.append((t, f"group0{g}" + (" off" if rnd.random() < 0.3 else ""), None, None))
    got = [x.action for x in _resolve(spark, case, n=3).orderBy("request_id").collect()]
    plain = _plain_fold([(tt, m.split()[0], m.endswith(" off")) for tt, m, *_ in case])
    assert got == plain


def test_listings_of_many_clusters(spark):
    clusters = [f"c{i}" for i in range(300)]
    d = spark.createDataFrame([(f"group{i}", c, i) for i, c in enumerate(clusters)], "grp string, cluster string, cluster_order int")
    assert LS.cluster_list(d) == clusters
    req = spark.createDataFrame([(i, dt.datetime(2024, 1, 1, 0, i), f"group{i}") for i in range(3)]
                                + [(9, dt.datetime(2024, 1, 1, 0, 16, 30), "status")],
                                "request_id long, ts timestamp_ntz, msg string")
    r = LS.resolve_leases(LS.resolve_cluster(LS.parse_requests(req), d))
    replies = {x.request_id: x.reply for x in LS.replies(r, clusters).collect()}
    items = replies[9].split("] ")
    assert len(items) == 300 and items[1:4] == ['["c1": ', '["c2": group2', '["c3": ']      # c1's ran out at 16:00


@pytest.mark.parametrize("start", [0, -40 * 365 * 86400 - 30000, -54 * 365 * 86400 - 200000])
def test_any_epoch(spark, start):
    """Times before 1970 and across it resolve like any other."""
    import random

    rnd = random.Random(start)
    case, t = [], start
    for _ in range(300):
        t += rnd.choice([0, 1, 60, 300, 899, 900, 2000])
        case.append((t, f"group0{rnd.randint(1, 3)}" + (" off" if rnd.random() < 0.35 else ""), None, None))
    got = [x.action for x in _resolve(spark, case, n=3).orderBy("request_id").collect()]
    assert got == _plain_fold([(tt, m.split()[0], m.endswith(" off")) for tt, m, *_ in case])


@pytest.mark.parametrize("msg,grp,off", [("group01 off\n", "group01", True), ("\tgroup01 off", "group01", True),
                                         ("group01\r\n", "group01", False), ("\n group01\toff\r", "group01", True),
                                         (" group01 off please\n", "group01", False), ("", "", False), ("\n", "", False)])
def test_line_ends_and_tabs(spark, msg, grp, off):
    r = LS.parse_requests(spark.createDataFrame([(msg,)], "msg string")).first()
    assert (r.grp, r.is_off) == (grp, off)


def _fold(rows, limit):
    """Row by row: {request_id: (action, holder, booked)}."""
    state, out = {}, {}
    for cluster, t, rid, grp, off in sorted(rows):
        holder, booked = state.get(cluster, ("", None))
        live = holder != "" and t - booked < limit
        holder = holder if live else ""
        action = "wait" if live else "book"
        if off:
            action = "off" if live and holder == grp else "status"
            holder = "" if action == "off" else holder
        elif not live:
            holder, booked = grp, t
        state[cluster] = (holder, booked)
        out[rid] = (action, holder, booked if holder != "" or action == "off" else None)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 40])
@pytest.mark.parametrize("seed, walked", [(1, 200_000), (3, 0), (4, 200_000)])
def test_pieces_equal_the_fold(spark, monkeypatch, n, seed, walked):
    """Dense logs (a lease spans several pieces), equal times, sparse ones; border links walked and doubled."""
    import random

    from strata.operators import lease_chain as LC

    monkeypatch.setattr(LC, "WALKED_LINKS", walked)
    rng, rows, t = random.Random(seed), [], dict.fromkeys("abc", 0)
    for i in range(700):
        c = rng.choice("aaaab" if seed % 2 else "abc")
        t[c] += rng.choice([0, 0, 1, 3, 10, 30] if seed < 4 else [0, 5, 60, 250])
        rows.append((c, t[c], i * 7 % 1009, f"g{rng.randrange(4)}", rng.random() < .35))
    df = spark.createDataFrame(rows, "cluster string, t_us long, request_id long, grp string, is_off boolean")
    got = LC.resolve_by_chain(df.withColumn("extra", F.lit("kept")), 100, n).collect()
    assert {r.request_id: (r.action, r.holder, r.booked_us) for r in got} == _fold(rows, 100)
    assert len(got) == len(rows) and all(r.extra == "kept" for r in got)


def test_a_changed_log_is_resolved_anew(spark, tmp_path):
    from strata.plans import lease as P

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.limit(50).write.parquet(f"{tmp_path}/events.parquet")
    assert P.lease_resolve(spark, str(tmp_path)).count() == ev.limit(50).where("event_type <> 'view'").count()
    ev.write.mode("append").parquet(f"{tmp_path}/events.parquet")
    n = ev.where("event_type <> 'view'").count()
    assert P.lease_resolve(spark, str(tmp_path)).count() > n
