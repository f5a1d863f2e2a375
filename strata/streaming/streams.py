"""Stream twins of the counter (A3), the balances (A9) and the lease service.

Each works on a ``readStream`` frame and keeps its state in the state store,
so a restarted query continues where it stopped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.lease import LIMIT_SECONDS, US
from ..operators.ledger import transfer_legs
from ..session import remove_folder, ship_package

# The stateful processor is also unpickled in a driver-side Python worker
# that does not see ``addPyFile`` entries: ship this module's code by value.
from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(sys.modules[__name__])


def running_count(stream: DataFrame, out: str = "n") -> DataFrame:
    """A3: the exact counter, updated after every micro-batch (update mode)."""
    return stream.groupBy().agg(F.count(F.lit(1)).alias(out))


def counter_values_sink(out: str, totals: str, order):
    """A3 per row, as a ``foreachBatch`` sink: the counter after each increment.

    A micro-batch is ranked in arrival order with the hot-safe global
    position (spread over all tasks, no single-key state) and shifted by the
    total of all earlier batches, kept as a one-row table per batch id. A
    replayed batch reads the same earlier totals and overwrites its own
    folders, so it is idempotent.
    """
    from pyspark.sql import functions as F

    from ..operators.scan import global_position

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # every batch writes its total; one that can't be read fails this batch
        prev = spark.read.parquet(f"{totals}/batch_id={batch_id - 1}").first()["total"] if batch_id else 0
        ranked = global_position(batch, order, out="_pos")
        ranked = materialize_batch(ranked.withColumn("counter", F.col("_pos") + F.lit(prev)).drop("_pos"),
                                   f"{out}/batch_id={batch_id}")
        n = ranked.count()
        spark.createDataFrame([(prev + n,)], "total long").write.mode("overwrite") \
             .parquet(f"{totals}/batch_id={batch_id}")
    return on_batch


def materialize_batch(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def running_balances(transfers: DataFrame) -> DataFrame:
    """Money moved per account so far; transfers apply as they arrive."""
    return transfer_legs(transfers).groupBy("acct").agg(F.sum("delta").alias("moved"))


LEASE_OUT = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("cluster", T.StringType()),
    T.StructField("grp", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("holder", T.StringType()),
    T.StructField("booked_us", T.LongType()),
])


LEASE_STATE = "holder string, booked_us long, last_t long, last_id long"


class LeaseProcessor(StatefulProcessor):
    """Per cluster, holder, booking time and the last (time, id) served,
    in a ValueState.

    Rows of one cluster in a micro-batch are folded in (time, id) order with
    the same rules as the batch fold (eager expiry at ``booked + limit``).
    A request older than the last one served arrives too late to be served
    in order: it is answered ``late`` and leaves the state alone (counted,
    not applied). A cluster's rows of one micro-batch are held by one task;
    bound them with ``maxFilesPerTrigger`` / ``maxBytesPerTrigger``.

    With ``expire`` every lease that runs out is answered too, by a row ``expired`` without a request: when the
    watermark passes ``booked + limit`` (an event-time timer), or when a later request finds it run out.
    State given at the start (``handleInitialState``) is taken over as it is.
    """

    def __init__(self, limit_s: int = LIMIT_SECONDS, idle_ttl_s: int | None = None, expire: bool = False):
        self.limit_us = limit_s * US
        self.idle_ttl_s = idle_ttl_s
        self.expire = expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = self.idle_ttl_s * 1000 if self.idle_ttl_s else None
        self.handle = handle
        self.lease = handle.getValueState("lease", LEASE_STATE, ttl)

    def _timer_ms(self, booked: int) -> int:
        return -(-(booked + self.limit_us) // 1000)

    def _set_timer(self, holder: str, booked) -> None:
        """One timer per cluster, for the lease in force."""
        if not self.expire:
            return
        wanted = self._timer_ms(booked) if holder and booked is not None else None
        for t in list(self.handle.listTimers()):
            if t != wanted:
                self.handle.deleteTimer(t)
        if wanted is not None:
            self.handle.registerTimer(wanted)

    def _expired_row(self, cluster, holder, booked) -> tuple:
        return None, cluster, holder, "expired", "", booked

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        r = initialState.iloc[0]
        booked, last_t, last_id = (None if pd.isna(r[c]) else int(r[c]) for c in ("booked_us", "last_t", "last_id"))
        self.lease.update((r["holder"] or "", booked, last_t, last_id))
        self._set_timer(r["holder"] or "", booked)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.lease.exists():
            return
        holder, booked, last_t, last_id = self.lease.get()
        if holder and booked is not None and self._timer_ms(booked) <= expiredTimerInfo.getExpiryTimeInMs():
            self.lease.update(("", booked, last_t, last_id))
            yield _answers([self._expired_row(key[0], holder, booked)])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["t_us", "request_id"], kind="stable")
        if self.lease.exists():
            holder, booked, last_t, last_id = self.lease.get()
        else:
            holder, booked, last_t, last_id = "", None, None, None
        out = []
        for grp, off, t, rid in zip(pdf["grp"], pdf["is_off"], pdf["t_us"].tolist(), pdf["request_id"].tolist()):
            if last_t is not None and (t, rid) < (last_t, last_id):
                out.append((rid, key[0], grp, "late", None, None))
                continue
            last_t, last_id = t, rid
            live = holder != "" and booked is not None and t - booked < self.limit_us
            if not live:
                if holder != "" and self.expire:
                    out.append(self._expired_row(key[0], holder, booked))
                holder = ""
            if off:
                action = "off" if live and holder == grp else "status"
                holder = "" if action == "off" else holder
            elif live:
                action = "wait"
            else:
                action, holder, booked = "book", grp, t
            out.append((rid, key[0], grp, action, holder, booked if holder != "" or action == "off" else None))
        self.lease.update((holder, booked, last_t, last_id))
        self._set_timer(holder, booked)
        yield _answers(out)

    def close(self) -> None:
        pass


def _answers(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=LEASE_OUT.names)
    return out.astype({"request_id": "Int64", "booked_us": "Int64"})


def late_requests(answers: DataFrame) -> DataFrame:
    """Per cluster: requests served, and requests that came too late to be served in order."""
    return answers.where("cluster is not null").groupBy("cluster").agg(
        F.count_if(F.col("action") != "late").alias("served"), F.count_if(F.col("action") == "late").alias("late"))


def streaming_leases(classified: DataFrame, limit_s: int = LIMIT_SECONDS, idle_ttl_s: int | None = None,
                     expire: bool = False, lateness_s: int = 0, initial: DataFrame | None = None) -> DataFrame:
    """One action per request as requests arrive.

    ``idle_ttl_s``: the state of a cluster without requests for so long (processing time) is dropped;
    by default it is kept. ``expire``: answer leases that run out as well (see ``LeaseProcessor``), on the
    watermark of the requests' own time less ``lateness_s``; Spark drops requests older than the watermark and
    counts them (``dropped_late``). ``initial``: the state to start a new checkpoint from, as ``export_leases``
    gives it.

    ``classified``: a stream of ``request_id, t_us, grp, is_off, cluster, kind``.
    Requests of a known cluster go through the stateful processor; status
    and wrong-group requests need no state.
    """
    if expire and idle_ttl_s:
        raise ValueError("state can be timed by the events (expire) or by the clock (idle_ttl_s), not by both")
    ship_package(classified.sparkSession)
    columns = ["request_id", "t_us", "grp", "is_off", "cluster"]
    if expire:
        classified = classified.withColumn("event_time", F.timestamp_micros("t_us")) \
                               .withWatermark("event_time", f"{lateness_s} seconds")
        columns.append("event_time")
    req = classified.where(F.col("kind") == "request").select(*columns)
    stateful = req.groupBy("cluster").transformWithStateInPandas(
        statefulProcessor=LeaseProcessor(limit_s, idle_ttl_s, expire), outputStructType=LEASE_OUT,
        outputMode="Append", timeMode="EventTime" if expire else "ProcessingTime" if idle_ttl_s else "None",
        initialState=None if initial is None else initial.select(
            "cluster", "holder", "booked_us", "last_t", "last_id").groupBy("cluster"))
    others = classified.where(F.col("kind") != "request").select(
        "request_id", "cluster", "grp", F.col("kind").alias("action"),
        F.lit(None).cast("string").alias("holder"), F.lit(None).cast("long").alias("booked_us"))
    return stateful.unionByName(others)


def export_leases(spark, checkpoint: str) -> DataFrame:
    """The lease state of a stopped stream's last committed batch, one row per cluster, read from its checkpoint."""
    state = spark.read.format("statestore").option("stateVarName", "lease").load(checkpoint)
    return state.select(F.col("key.cluster").alias("cluster"), *[F.col(f"value.{c}").alias(c) for c in
                                                                 ("holder", "booked_us", "last_t", "last_id")])


def dropped_late(query) -> int:
    """Requests older than the watermark that the query's recent batches dropped."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


STATE_COLS = "cluster string, holder string, booked_us long, last_t long, last_id long"


def lease_batches_sink(out: str, state: str, limit_s: int = LIMIT_SECONDS):
    """L9 for busy clusters, as a ``foreachBatch`` sink.

    Each micro-batch is resolved by the batch resolver (pieces and their
    borders), so one busy cluster is spread over all tasks. The
    state between batches is one row per cluster (holder, lease start, last
    request served), written per batch id in the shared folder. A live lease
    enters the next batch as a pseudo booking at its start time; requests
    older than the last one served are answered ``late``. Replaying a batch
    reads the same earlier state and overwrites its own folders.
    """
    from ..functions.columns import ntz_from_micros
    from ..operators.lease import resolve_leases

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # every batch writes the whole state; one that can't be read fails this batch
        prev = (spark.read.schema(STATE_COLS).parquet(f"{state}/batch_id={batch_id - 1}") if batch_id
                else spark.createDataFrame([], STATE_COLS))
        req = batch.where(F.col("kind") == "request")
        p = prev.select(F.col("cluster").alias("_pc"), F.col("last_t").alias("_lt"), F.col("last_id").alias("_li"))
        tagged = req.join(p, F.col("cluster") == F.col("_pc"), "left")
        is_late = F.col("_lt").isNotNull() & ((F.col("t_us") < F.col("_lt")) |
                                              ((F.col("t_us") == F.col("_lt")) & (F.col("request_id") < F.col("_li"))))
        tagged = tagged.withColumn("_late", is_late).drop("_pc", "_lt", "_li")
        in_order = tagged.where(~F.col("_late")).drop("_late", "t_us")
        late = tagged.where(F.col("_late")).select(
            "request_id", "cluster", "grp", F.lit("late").alias("action"),
            F.lit(None).cast("string").alias("holder"), F.lit(None).cast("long").alias("booked_us"), "t_us")
        # a live lease from earlier batches re-enters as a pseudo booking, under the id of the last request
        # served there: before all requests of this batch, whatever their ids are
        live = prev.where((F.col("holder") != "") & F.col("booked_us").isNotNull())
        pseudo = live.select(
            F.col("last_id").alias("request_id"), F.lit(True).alias("_carried"),
            ntz_from_micros(F.col("booked_us")).alias("ts"), F.lit(None).cast("string").alias("msg"),
            F.col("holder").alias("grp"), F.lit(False).alias("is_off"), "cluster", F.lit("request").alias("kind"))
        resolved = resolve_leases(in_order.unionByName(pseudo, allowMissingColumns=True)
                                  .unionByName(batch.where(F.col("kind") != "request").drop("t_us"),
                                               allowMissingColumns=True), limit_s)
        answered = resolved.where(F.col("_carried").isNull()).select(
            "request_id", "cluster", "grp", "action", "holder", "booked_us", "t_us")
        path = f"{out}/batch_id={batch_id}"
        answered.unionByName(late).write.mode("overwrite").parquet(path)
        # new state: the last request served per cluster (or the old row),
        # taken from the written answers so the batch is resolved once
        written = spark.read.parquet(path)
        served = (written.where(F.col("cluster").isNotNull() & (F.col("action") != "late"))
                  .groupBy("cluster")
                  .agg(F.max_by(F.struct(F.coalesce("holder", F.lit("")).alias("holder"), "booked_us",
                                         F.col("t_us").alias("last_t"), F.col("request_id").alias("last_id")),
                                F.struct("t_us", "request_id")).alias("_s"))
                  .select("cluster", "_s.*"))
        kept = prev.join(served.select("cluster"), "cluster", "left_anti")
        served.unionByName(kept).write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
        # a replay of this batch reads the state before it; what is older is read by nobody
        remove_folder(spark, f"{state}/batch_id={batch_id - 2}")
    return on_batch
