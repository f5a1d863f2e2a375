"""Shared pieces of the stream twins: landing folders, runs, update-mode sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import micros
from ..session import fresh_dir

#: bound of a micro-batch; with files of one block that is what one trigger holds
FILES_PER_TRIGGER = 1000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State of the stateful streams lives in RocksDB (set before the first run)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def land_in_runs(spark: SparkSession, df: DataFrame, ts: str, name: str, parts: int = 4):
    """Split ``df`` into ``parts`` equal stretches of its time range, and return
    ``(landing_dir, writers)``, one writer per part.

    The stream reads the landing folder; a run after each writer on the same
    checkpoint shows that state carries across batches and restarts.
    """
    landing = fresh_dir(spark, f"{name}-landing")
    t = micros(ts)
    lo_hi = df.agg(F.min(t).alias("lo"), F.max(t).alias("hi")).first()  # two numbers to the driver

    def writer(part: DataFrame):
        return lambda: part.write.mode("append").parquet(landing)

    if lo_hi["lo"] is None:
        return landing, [writer(df)]
    cuts = [lo_hi["lo"] + (lo_hi["hi"] - lo_hi["lo"]) * i // parts for i in range(1, parts)]
    edges = [None, *cuts, None]
    writers = []
    for lo, hi in zip(edges, edges[1:]):
        inside = F.lit(True)
        if lo is not None:
            inside &= t >= F.lit(lo)
        if hi is not None:
            inside &= t < F.lit(hi)
        writers.append(writer(df.where(inside)))
    return landing, writers


def open_stream(spark: SparkSession, schema, landing: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """A file stream whose micro-batches are bounded."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)


def run_available_now(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
                      name: str | None = None, mode: str = "append"):
    """Process everything present, in micro-batches, then stop; the stopped query is returned."""
    w = stream.writeStream.outputMode(mode)
    if name:
        w = w.queryName(name)
    q = (w.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
          .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def append_batches(out: str, keep: list[str] | None = None):
    """foreachBatch sink, idempotent: batch ``N`` goes to ``out/batch_id=N``
    in overwrite mode, so a batch replayed after a failure replaces its own
    earlier attempt instead of adding rows twice."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        b = batch if keep is None else batch.select(*keep)
        b.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return on_batch


def latest_per_key(spark: SparkSession, out: str, keys: list[str], values: list[str]) -> DataFrame:
    """Final table of an update-mode stream: each key's row from its last batch."""
    df = spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("long"))
    latest = F.max_by(F.struct(*values), "batch_id")
    if keys:
        return df.groupBy(*keys).agg(latest.alias("_v")).select(*keys, "_v.*")
    return df.agg(latest.alias("_v")).select("_v.*")
