"""Line numbers from file and place: the same for any split size, over several files."""

import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from strata.plans.gradebook import sheet_files
from strata.plans.lines import line_files
from strata.session import checkpoint_dir
from strata.sources import textfiles
from strata.sources.textfiles import read_lines, read_sheet


@pytest.fixture
def folder(tmp_path):
    want = {}
    for name, n in (("a.txt", 4000), ("b.txt", 1), ("c.txt", 0), ("d.txt", 900)):
        lines = [f"{name} line {i}" + ("é\r" if i % 7 == 0 else "") + " " * (i % 90) for i in range(n)]
        lines = ["" if i % 11 == 5 else x for i, x in enumerate(lines)]
        (tmp_path / name).write_bytes("".join(x + "\n" for x in lines).encode())
        want |= {(name, i + 1): x for i, x in enumerate(lines)}
    return str(tmp_path), want


@pytest.mark.parametrize("split", ["1k", "10k", "128m"])
def test_numbers_do_not_depend_on_splits(spark, folder, split):
    path, want = folder
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = read_lines(spark, path)
        assert {(r.file.rsplit("/", 1)[1], r.line_no): r.line for r in got.collect()} == want
        assert got.count() == len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sheet_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,t\n1,"x, y"\n2,\n')
    (tmp_path / "b.csv").write_text('n,t\n3,""\n')
    rows = read_sheet(spark, str(tmp_path), "n int, t string", header_lines=1).orderBy("row_idx").collect()
    assert [(r.row_idx, r.n, r.t) for r in rows] == [(2, 1, "x, y"), (3, 2, None), (4, 3, "")]


def _written(spark, name, build):
    """What ``build`` returns, and the sizes of the files it wrote to its folder ``name``."""
    folders = lambda: set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/{name}-*"))      # noqa: E731
    before = folders()
    out = build()
    (folder,) = folders() - before
    return out, [n for n in map(os.path.getsize, glob.glob(f"{folder}/part-*")) if n]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("n_docs", [100, 400])
def test_line_files_grow_in_number(spark, tmp_path, monkeypatch, n_docs, hot):
    monkeypatch.setattr(textfiles, "FILE_BYTES", 100_000, raising=False)
    texts = {i: "\n".join(f"{i} {j} {'x' * 180}" if j % 5 else "" for j in range(25)) for i in range(n_docs)}
    texts[n_docs] = None
    if hot:                                  # a document with most of the lines is cut over files
        texts[7] = "\n".join(f"{j} {'y' * 180}" for j in range(60 * n_docs))
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3) \
         .write.parquet(f"{tmp_path}/documents.parquet")
    out, sizes = _written(spark, "line-files", lambda: line_files(spark, str(tmp_path)))
    assert max(sizes) < 300_000 and len(sizes) >= max(3, sum(sizes) / 150_000)
    want = [x for i in sorted(texts) if texts[i] is not None for x in texts[i].split("\n")]
    got = [(r.pos, r.line_md5) for r in out.orderBy("pos").collect()]
    assert got == [(i, hashlib.md5(x.encode()).hexdigest()) for i, x in enumerate(want, 1)]


def test_sheet_files_grow_in_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textfiles, "FILE_BYTES", 100_000, raising=False)
    parts = spark.range(0, 8000, numPartitions=3).selectExpr(
        "id as p_partkey", "concat('name ', id, ', \"a\" ', repeat('z', 60)) as p_name", "concat('Brand#', id % 50) as p_brand",
        "cast(id % 50 as int) as p_size", "'SMALL TIN' as p_type", "cast(900 + id % 100 as double) as p_retailprice")
    parts.repartition(4).write.parquet(f"{tmp_path}/part.parquet")
    out, sizes = _written(spark, "sheet-files", lambda: sheet_files(spark, str(tmp_path)))
    assert max(sizes) < 300_000 and len(sizes) >= sum(sizes) / 150_000 > 6
    got = [(r.row_idx, r.first, r["last"], r.id_number, r.group_num) for r in out.orderBy("row_idx").collect()]
    assert got == [(i + 2, "name", f'{i}, "a" {"z" * 60}', f"Brand#{i % 50}", i % 16 + 1) for i in range(8000)]


@pytest.mark.parametrize("query, name, schema", [
    (line_files, "documents", "doc_id long, text string"),
    (sheet_files, "part", "p_partkey long, p_name string, p_brand string, p_size int, p_type string, p_retailprice double")])
def test_files_of_empty_tables(spark, tmp_path, query, name, schema):
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert query(spark, str(tmp_path)).count() == 0
