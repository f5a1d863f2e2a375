"""Session helpers: one place for the settings every job in this package relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "strata") -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and the UI off.

    What is already set (by spark-submit, ``spark-defaults.conf`` or an active session) stays as it is;
    only arguments given here override it. Without any master the session is local.
    """
    from pyspark import SparkConf, SparkContext

    cpus = os.environ.get("BENCH_CPUS", "8")
    if "PYSPARK_GATEWAY_PORT" in os.environ:        # started by spark-submit: its settings are in the JVM
        SparkContext._ensure_initialized()
    submitted = SparkConf()
    master = master or os.environ.get("SPARK_MASTER") or submitted.get("spark.master", None) or f"local[{cpus}]"
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # the lease stream keeps per-cluster state in RocksDB
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if master.startswith("local"):
        defaults |= {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    conf = {k: v for k, v in defaults.items() if not submitted.contains(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    active = SparkSession.getActiveSession()
    if active is not None:
        conf = {"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}
    spark = SparkSession.builder.appName(app).master(master).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; that value is always
    used. Only when it is unset and the master is local (tests, bench) a scratch
    folder is made and registered, so later calls agree; on a cluster that is an error, as
    each machine would write to a disk of its own.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        path = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df, name: str):
    """Write ``df`` once as parquet into a fresh folder of the shared checkpoint
    directory and read it back: a lineage cut for frames that feed several
    branches, which survives the loss of executors (unlike a local checkpoint)."""
    path = fresh_dir(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def is_written(spark: SparkSession, path: str) -> bool:
    """Has a job that wrote a table to ``path`` been committed?"""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote and nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``strata`` importable in the Python workers (what ``--py-files`` does).

    Functions handed to ``mapInArrow``/``mapInPandas``, the record source and
    the stateful processor live in this package; the workers must import it.
    Once per application the package is zipped into the shared checkpoint
    folder and added with ``addPyFile``, so executors fetch it from there.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import io
    import zipfile

    import strata

    root = os.path.dirname(os.path.abspath(strata.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    folder = fresh_dir(spark, "pyfiles")
    from pyarrow import fs as pafs

    fs, base = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/strata.zip") as out:
        out.write(buf.getvalue())
    sc.addPyFile(f"{folder}/strata.zip")
    _SHIPPED.add(sc.applicationId)
