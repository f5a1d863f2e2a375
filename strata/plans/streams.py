"""Stream twins over the driver tables.

Each query lands its input table in four time-ordered parts in a fresh
folder of the shared checkpoint directory and runs an ``availableNow``
stream after each part on one checkpoint: every run resumes from the
state of the one before. The result is compared with the batch twin's SQL.
Micro-batches are bounded by ``maxFilesPerTrigger``; requests that arrive
after newer ones of their cluster are answered ``late`` by the lease stream.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import micros, ntz_from_micros
from ..operators import lease as LS
from ..operators import ledger as L
from ..operators.splits import measured_partitions
from ..session import fresh_dir, materialize, remove_folder
from ..sources.tables import table
from ..streaming import common as C
from ..streaming import streams as S
from . import lease as lease_plan
from . import vectors as vector_plan


class _sized_shuffles:
    """Size shuffle partitions from the input for the stream's runs, then
    give the session its setting back (state partitions are fixed by the
    first run of a checkpoint)."""

    def __init__(self, spark, df):
        self.spark, self.n = spark, measured_partitions(df)

    def __enter__(self):
        self.before = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", str(self.n))

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.before)
        return False


def _run_parts(spark, df, ts, name, sink, build=lambda stream: stream, mode="append"):
    """Land ``df`` part by part in time order, with a run after each on one checkpoint: arrival order equals
    time order between micro-batches, so the twin must equal the batch result."""
    landing, writers = C.land_in_runs(spark, df, ts, name)
    ckpt = fresh_dir(spark, f"{name}-ckpt")
    with _sized_shuffles(spark, df):
        for write in writers:
            write()
            C.run_available_now(build(C.open_stream(spark, df.schema, landing)), sink, ckpt, None, mode)


def counter_values_stream(spark, sf_dir):
    """A3 per row on a stream: the counter's value after each event, in
    arrival order (the second run continues from the first run's total)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    out, totals = fresh_dir(spark, "counter-values-out"), fresh_dir(spark, "counter-values-totals")
    _run_parts(spark, ev, "ts", "counter-values", S.counter_values_sink(out, totals, ["ts", "event_id"]))
    return spark.read.parquet(out).select("event_id", "counter")


def counter_stream(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    out = fresh_dir(spark, "counter-out")
    _run_parts(spark, ev, "ts", "counter", C.append_batches(out), S.running_count, "update")
    return C.latest_per_key(spark, out, [], ["n"])


def balances_stream(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    n_cust = table(spark, sf_dir, "customer").count()   # one number, used as a literal in the stream

    def build(stream):
        transfers = stream.select(
            F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("src"),
            ((F.col("o_custkey") * 7 + 1) % F.lit(n_cust)).alias("dst"),
            F.round(F.col("o_totalprice") * 100).cast("long").alias("amount"))
        return S.running_balances(transfers)

    out = fresh_dir(spark, "balances-out")
    _run_parts(spark, o, "o_orderdate", "balances", C.append_batches(out), build, "update")
    moved = C.latest_per_key(spark, out, ["acct"], ["moved"])
    acc = vector_plan._accounts(spark, sf_dir)
    return (acc.join(moved, "acct", "left")
               .select("acct", "opening",
                       (F.col("opening") + F.coalesce(F.col("moved"), F.lit(0))).alias("closing")))


def lease_stream(spark, sf_dir):
    C.use_rocksdb(spark)
    log = lease_plan.request_log(spark, sf_dir)
    directory = lease_plan.directory(spark, sf_dir)

    def build(stream):
        classified = LS.resolve_cluster(LS.parse_requests(stream), directory)
        return S.streaming_leases(classified.withColumn("t_us", micros("ts")))

    out = fresh_dir(spark, "lease-out")
    _run_parts(spark, log, "ts", "lease", C.append_batches(out), build)
    res = spark.read.parquet(out)          # batch_id comes from the folder names
    return res.select("request_id", "cluster", "grp", "action", "holder",
                      ntz_from_micros(F.col("booked_us")).alias("booked_at"))


def lease_stream_batched(spark, sf_dir):
    """L9 through the batch resolver per micro-batch (busy clusters split)."""
    log = lease_plan.request_log(spark, sf_dir)
    directory = lease_plan.directory(spark, sf_dir)
    out, state = fresh_dir(spark, "lease-batched-out"), fresh_dir(spark, "lease-batched-state")

    def build(stream):
        return LS.resolve_cluster(LS.parse_requests(stream), directory).withColumn("t_us", micros("ts"))

    _run_parts(spark, log, "ts", "lease-batched", S.lease_batches_sink(out, state), build)
    res = spark.read.parquet(out)
    return res.select("request_id", "cluster", "grp", "action", "holder",
                      ntz_from_micros(F.col("booked_us")).alias("booked_at"))


def lease_expiry_stream(spark, sf_dir):
    """L9 with timers: every lease that ran out, answered when the watermark passed its limit or a later request
    found it so."""
    C.use_rocksdb(spark)
    log = lease_plan.request_log(spark, sf_dir)
    directory = lease_plan.directory(spark, sf_dir)

    def build(stream):
        classified = LS.resolve_cluster(LS.parse_requests(stream), directory)
        return S.streaming_leases(classified.withColumn("t_us", micros("ts")), expire=True)

    out = fresh_dir(spark, "lease-expiry-out")
    _run_parts(spark, log, "ts", "lease-expiry", C.append_batches(out), build)
    gone = spark.read.parquet(out).where("action = 'expired'")
    return gone.select("cluster", F.col("grp").alias("holder"), ntz_from_micros(F.col("booked_us")).alias("booked_at"),
                       ntz_from_micros(F.col("booked_us") + LS.LIMIT_SECONDS * LS.US).alias("expired_at"))


def lease_restart_stream(spark, sf_dir):
    """The stream is stopped halfway, its leases are exported to a table, its checkpoint is removed, and a new
    checkpoint starts from the table."""
    C.use_rocksdb(spark)
    log = lease_plan.request_log(spark, sf_dir)
    directory = lease_plan.directory(spark, sf_dir)
    t = micros("ts")
    lo, hi = log.agg(F.min(t), F.max(t)).first()
    middle = F.lit(((lo or 0) + (hi or 0)) // 2)
    out = fresh_dir(spark, "lease-restart-out")
    initial = None
    with _sized_shuffles(spark, log):
        for i, half in enumerate((log.where(t < middle), log.where(t >= middle))):
            landing, ckpt = fresh_dir(spark, f"lease-restart-{i}"), fresh_dir(spark, f"lease-restart-ckpt-{i}")
            half.write.parquet(landing)
            classified = LS.resolve_cluster(LS.parse_requests(C.open_stream(spark, log.schema, landing)), directory)
            answers = S.streaming_leases(classified.withColumn("t_us", t), initial=initial)
            C.run_available_now(answers, C.append_batches(f"{out}/half={i}"), ckpt)
            initial = materialize(S.export_leases(spark, ckpt), "lease-snapshot")
            remove_folder(spark, ckpt)
    return spark.read.parquet(out).select("request_id", "cluster", "grp", "action", "holder",
                                          ntz_from_micros(F.col("booked_us")).alias("booked_at"))


QUERIES = {
    "lease_expiry_stream": lease_expiry_stream,
    "lease_restart_stream": lease_restart_stream,
    "counter_values_stream": counter_values_stream,
    "counter_stream": counter_stream,
    "balances_stream": balances_stream,
    "lease_stream": lease_stream,
    "lease_stream_batched": lease_stream_batched,
}


def _sql():
    from . import lease, vectors

    return {
        "counter_values_stream": vectors.SQL["counter_values"],
        "counter_stream": vectors.SQL["counter"],
        "balances_stream": vectors.SQL["balances"],
        "lease_stream": lease.SQL["lease_resolve"],
        "lease_stream_batched": lease.SQL["lease_resolve"],
        "lease_restart_stream": lease.SQL["lease_resolve"],
        "lease_expiry_stream": lease._BASE + lease._INTERVALS + """
            select cluster, holder, start as booked_at, start + interval 900 seconds as expired_at from iv
            where end_reason = 'expired'""",
    }


SQL = _sql()
