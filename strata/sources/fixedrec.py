"""``fixedrec``: a file source and sink for fixed-length binary records.

A file is records back to back: ``key_len`` key bytes then ``value_len``
value bytes, no header, no separator.

Reading (S1-S3). Input files are listed in path order (order is data, not
accident) and cut into splits of ``splitSize`` bytes. A split owns the
records whose *first* byte lies in it: it starts at the first record
boundary at or after its start, and its last record may run past its end.
A file that ends inside a record raises ``EOFError("read past eof ...")``
naming file and offset; a file that ends on a boundary ends cleanly.
Records are turned into Arrow binary arrays straight from the file bytes.
``includeOrigin=true`` adds ``_file`` and ``_offset`` so order can be kept
as data.

Writing (S4, S5). One file per partition, ``part-NNNNN`` by partition
index, so a range-sorted frame gives files whose concatenation is sorted.
Parts stay where they are written: every task attempt writes a file of its own into the job's folder,
and the commit writes one small manifest, ``_manifests/<job>.json``, that names the parts of the successful
attempts in order. A part is read only if a manifest names it, so a job that dies before its manifest
leaves nothing visible, and nothing is renamed or moved, which object stores cannot do. A manifest
ends with a digest of itself; one that was cut short counts as not written. Files
that lie in the folder outside of job folders (written by other tools) are read before the jobs' parts.
The output path must be given. ``write_records``
refuses an existing output by default (``error``); ``append`` writes into
it (the reference's behaviour); the manifest of an ``overwrite`` hides what it found, which is then deleted.
``columns=key`` reads keys only. All file access goes through ``pyarrow.fs``.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .records import KEY_LEN, VALUE_LEN

NAME = "fixedrec"
DEFAULT_SPLIT = 128 * 1024 * 1024
READ_RECORDS = 65536          # records per Arrow batch


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _binary(data: bytes, width: int, n: int) -> pa.Array:
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


@dataclass
class _Split(InputPartition):
    path: str
    start: int
    length: int


class _Reader(DataSourceReader):
    def __init__(self, options, schema):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("fixedrec: a path is required")
        self.key_len = int(options.get("keyLength", KEY_LEN))
        self.value_len = int(options.get("valueLength", VALUE_LEN))
        self.split = int(options.get("splitSize", DEFAULT_SPLIT))
        self.origin = options.get("includeOrigin", "false").lower() == "true"
        self.columns = _columns(options)

    def partitions(self):
        from pyarrow import fs as pafs

        fs, root = _fs(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.Directory:
            files = _visible(fs, root)
        elif info.type == pafs.FileType.File:
            files = [(info.path, info.size)]
        else:
            raise FileNotFoundError(f"fixedrec: no such path {self.path}")
        parts = []
        for path, size in files:
            path = path if "://" not in self.path else self.path.split("://")[0] + "://" + path
            for start in range(0, size, self.split):
                parts.append(_Split(path, start, min(self.split, size - start)))
        return parts

    def read(self, partition: _Split):
        if partition is None:                     # no input bytes at all
            return
        rec = self.key_len + self.value_len
        fs, path = _fs(partition.path)
        first = (rec - partition.start % rec) % rec          # first record boundary in the split
        if first >= partition.length:
            return
        n_total = -(-(partition.length - first) // rec)     # records that start in the split
        pos = partition.start + first
        with fs.open_input_file(path) as f:
            size = f.size()
            remaining = n_total
            while remaining > 0:
                n = min(READ_RECORDS, remaining)
                want = n * rec
                buf = f.read_at(min(want, max(size - pos, 0)), pos)
                got = len(buf)
                if got < want:                            # the file ends inside this chunk
                    if got % rec:
                        raise EOFError(f"{partition.path} ends inside a record, which starts at offset {pos + got - got % rec}")
                    n, remaining = got // rec, got // rec
                    if n == 0:
                        return
                rows = np.frombuffer(buf, dtype=np.uint8, count=n * rec).reshape(n, rec)
                cols, names = [], []
                if "key" in self.columns:
                    cols.append(_binary(rows[:, :self.key_len].tobytes(), self.key_len, n))
                    names.append("key")
                if "value" in self.columns:
                    cols.append(_binary(rows[:, self.key_len:].tobytes(), self.value_len, n))
                    names.append("value")
                if self.origin:
                    cols += [pa.array([partition.path] * n, pa.string()),
                             pa.array(pos + np.arange(n, dtype=np.int64) * rec, pa.int64())]
                    names += ["_file", "_offset"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
                pos += n * rec
                remaining -= n


def _columns(options) -> list[str]:
    """``columns=key`` reads keys only (the value bytes are skipped)."""
    cols = [c.strip() for c in options.get("columns", "key,value").split(",") if c.strip()]
    bad = set(cols) - {"key", "value"}
    if bad or not cols:
        raise ValueError(f"fixedrec: columns must be key and/or value, not {sorted(bad) or cols}")
    return cols


MANIFESTS = "_manifests"


def _sealed(body: dict) -> bytes:
    """A manifest's bytes: the JSON and, on a line of its own, its digest."""
    text = json.dumps(body, sort_keys=True)
    return f"{text}\n{hashlib.sha256(text.encode()).hexdigest()}\n".encode()


def _opened(raw: bytes) -> dict | None:
    """A manifest's content, or None if it isn't whole."""
    text, _, seal = raw.decode(errors="replace").rstrip("\n").rpartition("\n")
    return json.loads(text) if text and hashlib.sha256(text.encode()).hexdigest() == seal else None


def _manifests(fs, root: str) -> list[tuple[str, dict]]:
    """(path, content) of the whole manifests, in commit order."""
    from pyarrow import fs as pafs

    found = []
    for f in fs.get_file_info(pafs.FileSelector(f"{root}/{MANIFESTS}", allow_not_found=True)):
        with fs.open_input_stream(f.path) as i:
            body = _opened(i.read())
        if body is not None:
            found.append((f.path, body))
    return sorted(found, key=lambda m: m[0])


def _plain(fs, root: str) -> list[tuple[str, int]]:
    """(path, bytes) of files outside of job folders, in path order."""
    from pyarrow import fs as pafs

    out = []
    for f in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        names = f.path.removeprefix(root).strip("/").split("/")
        if f.type == pafs.FileType.File and not names[0].startswith("job-") \
                and not any(n.startswith(("_", ".")) for n in names):
            out.append((f.path, f.size))
    return sorted(out)


def _visible(fs, root: str) -> list[tuple[str, int]]:
    """(path, bytes) of what a reader sees, in order: plain files, then each job's parts."""
    jobs = [body for _, body in _manifests(fs, root)]
    at = max((i for i, body in enumerate(jobs) if body["overwrite"]), default=0)
    hidden = set(jobs[at]["replaces"]) if jobs else set()
    plain = [(p, size) for p, size in _plain(fs, root) if p.removeprefix(root).strip("/") not in hidden]
    return plain + [(f"{root}/{name}", size) for body in jobs[at:] for name, size in body["parts"]]


@dataclass
class _Written(WriterCommitMessage):
    name: str
    size: int
    partition: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options, schema, overwrite):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("fixedrec: no path to write to")
        self.key_len = int(options.get("keyLength", KEY_LEN))
        self.value_len = int(options.get("valueLength", VALUE_LEN))
        self.overwrite = overwrite
        # sorts after every earlier job's name, so appended records come after what is there
        self.job = f"job-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        names = [f.name for f in schema.fields]
        if names[:2] != ["key", "value"]:
            raise ValueError("fixedrec: the frame must start with key and value columns")
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)

    def write(self, iterator):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid, attempt = ctx.partitionId(), ctx.attemptNumber()
        fs, root = _fs(self.path)
        fs.create_dir(f"{root}/{self.job}", recursive=True)
        # one file per attempt: the manifest names the attempt that succeeded
        name, size = f"{self.job}/part-{pid:010d}-{attempt}-{ctx.taskAttemptId()}", 0
        with fs.open_output_stream(f"{root}/{name}") as out:
            for batch in iterator:
                n = batch.num_rows
                if n == 0:
                    continue
                k, v = batch.column(0), batch.column(1)
                kb = np.frombuffer(k.buffers()[2], dtype=np.uint8)
                vb = np.frombuffer(v.buffers()[2], dtype=np.uint8)
                ko = np.frombuffer(k.buffers()[1], dtype=np.int32)[k.offset:k.offset + n + 1]
                vo = np.frombuffer(v.buffers()[1], dtype=np.int32)[v.offset:v.offset + n + 1]
                if k.null_count or v.null_count or np.any(np.diff(ko) != self.key_len) \
                        or np.any(np.diff(vo) != self.value_len):
                    raise ValueError(f"fixedrec: keys must be {self.key_len} bytes and values "
                                     f"{self.value_len} bytes, not NULL")
                rows = np.empty((n, self.key_len + self.value_len), dtype=np.uint8)
                rows[:, :self.key_len] = kb[ko[0]:ko[-1]].reshape(n, self.key_len)
                rows[:, self.key_len:] = vb[vo[0]:vo[-1]].reshape(n, self.value_len)
                out.write(rows.tobytes())
                size += rows.size
        return _Written(name, size, pid)

    def commit(self, messages):
        """One manifest publishes the job, whatever its number of parts."""
        fs, root = _fs(self.path)
        older, plain = (_manifests(fs, root), _plain(fs, root)) if self.overwrite else ([], [])
        done = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        body = {"job": self.job, "overwrite": bool(self.overwrite), "parts": [[m.name, m.size] for m in done],
                "replaces": [p.removeprefix(root).strip("/") for p, _ in plain]}
        fs.create_dir(f"{root}/{MANIFESTS}", recursive=True)
        with fs.open_output_stream(f"{root}/{MANIFESTS}/{self.job}.json") as out:
            out.write(_sealed(body))
        # from here on what the manifest hides is seen by nobody
        for path, old in older:
            _drop(fs, f"{root}/{old['job']}")
            fs.delete_file(path)
        for path, _ in plain:
            fs.delete_file(path)

    def abort(self, messages):
        fs, root = _fs(self.path)
        _drop(fs, f"{root}/{self.job}")


def _drop(fs, folder: str) -> None:
    try:
        fs.delete_dir(folder)
    except OSError:              # a job without rows has none
        pass


class FixedRecordSource(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        fields = [StructField(c, BinaryType()) for c in _columns(self.options)]
        if self.options.get("includeOrigin", "false").lower() == "true":
            fields += [StructField("_file", StringType()), StructField("_offset", LongType())]
        return StructType(fields)

    def reader(self, schema):
        return _Reader(self.options, schema)

    def writer(self, schema, overwrite):
        return _Writer(self.options, schema, overwrite)


def register(spark) -> None:
    from ..session import ship_package

    ship_package(spark)
    spark.dataSource.register(FixedRecordSource)


def read_records(spark, path: str, split_size: int | None = None, include_origin: bool = False,
                 key_len: int = KEY_LEN, value_len: int = VALUE_LEN, columns: str = "key,value"):
    """S1-S3 as a DataFrame: ``key, value`` (and ``_file, _offset``).

    Python sources get no column pruning from Spark, so ``columns="key"``
    asks for the keys alone."""
    register(spark)
    r = (spark.read.format(NAME).option("keyLength", key_len).option("valueLength", value_len)
         .option("includeOrigin", str(include_origin).lower()).option("columns", columns))
    if split_size:
        r = r.option("splitSize", split_size)
    return r.load(path)


def write_records(df, path: str, mode: str = "error", key_len: int = KEY_LEN, value_len: int = VALUE_LEN):
    """One file per partition, in partition order.

    Every write makes a folder and a manifest of its own whose names sort after earlier ones.
    ``mode``: ``error`` (default) refuses a folder that already holds committed files; ``append`` adds to it;
    ``overwrite`` replaces what it holds. Spark offers only append and overwrite to Python
    sinks, so the refusal is checked here, before any task runs.
    """
    register(df.sparkSession)
    if not path:
        raise ValueError("fixedrec: no path to write to")
    mode = mode.lower()
    if mode in ("error", "errorifexists"):
        from pyarrow import fs as pafs

        fs, root = _fs(path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File or (
                info.type == pafs.FileType.Directory and (_manifests(fs, root) or _plain(fs, root))):
            raise FileExistsError(f"fixedrec: output {path} already exists")
        mode = "append"
    elif mode not in ("append", "overwrite"):
        raise ValueError(f"fixedrec: unsupported mode {mode!r}")
    (df.select("key", "value").write.format(NAME).mode(mode)
       .option("keyLength", key_len).option("valueLength", value_len).save(path))


def sort_records(spark, in_path: str, out_path: str, n: int | None = None, mode: str = "error",
                 key_len: int = KEY_LEN, value_len: int = VALUE_LEN) -> None:
    """The sort job: record files in, record files out, sorted by unsigned key bytes, then value bytes.

    ``n`` output partitions (default: shuffle parallelism); the parts one after the other are sorted.
    """
    from ..operators.ordering import range_sort

    records = read_records(spark, in_path, key_len=key_len, value_len=value_len)
    write_records(range_sort(records, ["key", "value"], n), out_path, mode, key_len, value_len)
