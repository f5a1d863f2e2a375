"""Fixed-record source and sink."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from strata.operators.ordering import range_sort
from strata.sources.fixedrec import read_records, write_records
from strata.sources.records import text_records


def _write(path, n, seed=3):
    import random

    rnd = random.Random(seed)
    recs = [bytes(rnd.getrandbits(8) for _ in range(100)) for _ in range(n)]
    with open(path, "wb") as f:
        f.write(b"".join(recs))
    return recs


@pytest.mark.parametrize("split", [1, 99, 100, 101, 333, 10_000])
def test_each_record_once_for_any_split(spark, split):
    d = tempfile.mkdtemp()
    recs = _write(f"{d}/a", 7) + _write(f"{d}/b", 5, seed=4)
    got = read_records(spark, d, split_size=split, include_origin=True).collect()
    assert sorted(bytes(r.key) + bytes(r.value) for r in got) == sorted(recs)
    # ordered listing: files in path order, offsets ascending
    order = sorted(got, key=lambda r: (r._file, r._offset))
    assert [bytes(r.key) + bytes(r.value) for r in order] == recs


def test_truncated_file_raises_and_empty_file_is_empty(spark):
    d = tempfile.mkdtemp()
    with open(f"{d}/f", "wb") as f:
        f.write(b"x" * 250)
    with pytest.raises(Exception, match="ends inside a record"):
        read_records(spark, d).collect()
    with open(f"{d}/f", "wb") as f:
        f.write(b"")
    assert read_records(spark, d).count() == 0


def test_sort_write_read_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    recs = text_records(docs, "doc_id", "text").select("key", "value")
    out = tempfile.mkdtemp() + "/out"
    write_records(range_sort(recs, ["key"], 3), out)
    (job,) = [x for x in os.listdir(out) if x.startswith("job-")]
    out_job = f"{out}/{job}"
    assert [x[:15] for x in sorted(os.listdir(out_job))] == [f"part-{i:010d}" for i in range(3)]
    assert os.listdir(f"{out}/_manifests") == [f"{job}.json"]
    # the concatenated files are sorted by unsigned key
    blob = b"".join(open(f"{out_job}/{f}", "rb").read() for f in sorted(os.listdir(out_job)))
    keys = [blob[i:i + 10] for i in range(0, len(blob), 100)]
    assert keys == sorted(keys) and len(blob) % 100 == 0
    back = read_records(spark, out, split_size=4096)
    a = recs.select(F.hex("key"), F.hex("value"))
    b = back.select(F.hex("key"), F.hex("value"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # append adds, after what is there
    write_records(recs.limit(1), out, mode="append")
    both = read_records(spark, out, include_origin=True).orderBy("_file", "_offset").collect()
    assert len(both) == recs.count() + 1
    assert b"".join(bytes(r.key) for r in both[:-1]) == b"".join(keys)


def test_text_records_cover_whole_texts(spark):
    df = spark.createDataFrame([(1, "a" * 250), (2, ""), (3, "é")], "doc_id long, text string")
    rows = text_records(df, "doc_id", "text").orderBy("doc_id", "chunk").collect()
    assert [(r.doc_id, r.chunk) for r in rows] == [(1, 0), (1, 1), (1, 2), (3, 0)]
    assert bytes(rows[2].key) + bytes(rows[2].value) == b"a" * 50 + b"\x00" * 50
    assert bytes(rows[3].key)[:2] == "é".encode()


def test_key_only_read(spark):
    d = tempfile.mkdtemp()
    recs = _write(f"{d}/a", 9)
    got = read_records(spark, d, columns="key", split_size=250).collect()
    assert [list(r.asDict()) for r in got[:1]] == [["key"]]
    assert sorted(bytes(r.key) for r in got) == sorted(r[:10] for r in recs)


def test_error_mode_refuses_existing_output(spark):
    out = tempfile.mkdtemp()
    df = spark.createDataFrame([(b"0123456789", b"v" * 90)], "key binary, value binary")
    write_records(df, out + "/new")                       # default mode: error, folder absent
    with pytest.raises(FileExistsError):
        write_records(df, out + "/new")
    write_records(df, out + "/new", mode="overwrite")
    assert read_records(spark, out + "/new").count() == 1


def test_append_keeps_earlier_records(spark):
    d = tempfile.mkdtemp()
    recs = _write(f"{d}/a", 6)
    out = d + "/out"
    write_records(read_records(spark, f"{d}/a"), out)
    more = spark.createDataFrame([(b"0123456789", b"v" * 90)], "key binary, value binary")
    write_records(more, out, mode="append")
    assert sorted(bytes(r.key) + bytes(r.value) for r in read_records(spark, out).collect()) == \
        sorted(recs + [b"0123456789" + b"v" * 90])
    write_records(more, out, mode="overwrite")
    assert read_records(spark, out).count() == 1
    assert len(os.listdir(out)) == 2 and len(os.listdir(f"{out}/_manifests")) == 1       # older jobs are gone


def test_part_names_sort_at_any_count():
    names = [f"part-{i:010d}" for i in (0, 99_999, 100_000, 9_999_999)]
    assert names == sorted(names)


def test_sort_job(spark):
    from strata.sources.fixedrec import sort_records

    d = tempfile.mkdtemp()
    recs = _write(f"{d}/a", 500)
    sort_records(spark, f"{d}/a", f"{d}/out", n=4)
    got = read_records(spark, f"{d}/out", include_origin=True).orderBy("_file", "_offset").collect()
    assert [bytes(r.key) + bytes(r.value) for r in got] == sorted(recs)
    assert len({r._file for r in got}) == 4
    with pytest.raises(FileExistsError):
        sort_records(spark, f"{d}/a", f"{d}/out")


def test_a_job_without_its_manifest_is_invisible(spark):
    import shutil

    d = tempfile.mkdtemp()
    recs = _write(f"{d}/a", 20)
    out = d + "/out"
    write_records(read_records(spark, f"{d}/a"), out)
    (job,) = [x for x in os.listdir(out) if x.startswith("job-")]
    (manifest,) = os.listdir(f"{out}/_manifests")
    # killed before the commit: parts lie there, no manifest; killed inside it: the manifest is cut short
    shutil.copytree(f"{out}/{job}", f"{out}/job-99999999999999999999-dead")
    whole = open(f"{out}/_manifests/{manifest}", "rb").read()
    for cut in (0, 10, len(whole) - 30):
        with open(f"{out}/_manifests/job-99999999999999999999-dead.json", "wb") as f:
            f.write(whole[:cut])
        assert read_records(spark, out).count() == 20
    # a second attempt's file that no manifest names is not read either
    part = sorted(os.listdir(f"{out}/{job}"))[0]
    shutil.copy(f"{out}/{job}/{part}", f"{out}/{job}/{part}9")
    assert sorted(bytes(r.key) + bytes(r.value) for r in read_records(spark, out).collect()) == sorted(recs)
    with pytest.raises(FileExistsError):
        write_records(read_records(spark, f"{d}/a"), out)


def test_a_failed_job_leaves_what_was_there(spark):
    d = tempfile.mkdtemp()
    recs = _write(f"{d}/a", 8)
    out = d + "/out"
    write_records(read_records(spark, f"{d}/a"), out)
    bad = spark.createDataFrame([(b"0123456789", b"v" * 90), (b"short", b"v")], "key binary, value binary").repartition(2)
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="10 bytes"):
            write_records(bad, out, mode=mode)
        assert sorted(bytes(r.key) + bytes(r.value) for r in read_records(spark, out).collect()) == sorted(recs)


def test_files_of_other_tools_come_first_and_go_with_an_overwrite(spark):
    d = tempfile.mkdtemp()
    recs = _write(f"{d}/a", 5)
    more = spark.createDataFrame([(b"0123456789", b"v" * 90)], "key binary, value binary")
    write_records(more, d, mode="append")
    got = read_records(spark, d).coalesce(1).collect()
    assert [bytes(r.key) for r in got] == [r[:10] for r in recs] + [b"0123456789"]
    write_records(more, d, mode="overwrite")
    assert read_records(spark, d).count() == 1 and not os.path.exists(f"{d}/a")
    _write(f"{d}/b", 5)
    assert read_records(spark, d).count() == 6
