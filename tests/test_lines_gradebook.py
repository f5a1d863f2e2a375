"""Text-line extraction (T1-T6) and score tables."""

import pytest
from pyspark.sql import functions as F

from strata.operators import gradebook as G
from strata.operators import lines as X


def test_pids_and_paths(spark):
    jps = spark.createDataFrame([(1, "123 SparkSubmit\n124 Jps\n 77 SparkSubmit")], "id long, text string")
    assert [r.pid for r in X.pids(jps, "text", ["id"]).orderBy("match_no").collect()] == ["123", "77"]
    lines = spark.createDataFrame([("drwx - u g 0 2021-01-01 10:00 /user/group02",), ("Found 3 items",),
                                   ("a /b c /d/e f",)], "line string")
    assert [r.path for r in X.listing_paths(lines).collect()] == ["/user/group02", "/d/e f"]


def test_hosts_map_and_roles(spark):
    rows = [(1, "10.244.40.4 student96-x2"), (2, "junk line"), (3, "10.0.0.1 student96-x2"),
            (4, "10.0.0.2 student96-x1")]
    df = spark.createDataFrame(rows, "line_no long, line string")
    e = X.host_entries(df, "line", ["line_no"])
    assert [(r.ip, r.name, r.id) for r in e.orderBy("line_no").collect()][0] == ("10.244.40.4", "student96", "x2")
    assert e.count() == 3
    assert sorted(map(tuple, X.host_map(e).collect())) == [("student96", "x1", "10.0.0.2"),
                                                           ("student96", "x2", "10.0.0.1")]   # later line wins
    more = spark.createDataFrame([(9, "10.0.0.9 student96-x4"), (8, "10.0.0.8 student7-y")], "line_no long, line string")
    got = X.host_map(X.host_entries(more, "line", ["line_no"])).collect()
    assert sorted(map(tuple, got)) == [("student7", "y", "10.0.0.8"), ("student96", "x4", "10.0.0.9")]
    hosts = spark.createDataFrame([(0, n, f"student{93 + n}", f"x{i}") for n in range(4) for i in (1, 2, 3)],
                                  "cluster long, node_no long, name string, id string")
    roles = [r.role for r in X.roles(hosts, n_partitions=3).orderBy("node_no", "id").collect()]
    assert roles == ["master"] + [f"worker{i}" for i in range(1, 12)]


def test_extract_rows_all_matches(spark):
    df = spark.createDataFrame([(1, "a 1.2.3.4 b 10.20.30.40\nnone\n5.6.7.8")], "doc_id long, text string")
    lines = X.text_lines(df, "text", ["doc_id"])
    got = [(r.line_no, r.match_no, r.o1) for r in
           X.extract_rows(lines, "line", r"(\d+)\.(\d+)\.(\d+)\.(\d+)", ["o1", "o2", "o3", "o4"], ["line_no"])
           .orderBy("line_no", "match_no").collect()]
    assert got == [(1, 1, "1"), (1, 2, "10"), (3, 1, "5")]


@pytest.mark.parametrize("text,value", [("7.5", 7.5), ("abc", None), ("None", None), (" 8 ", 8.0),
                                        ("1_000", 1000.0), ("1e3", 1000.0), ("1.5d", None), ("", None)])
def test_grade_coercion(spark, text, value):
    df = spark.createDataFrame([(text,)], "g string")
    r = df.select(G.coerce_grade(F.col("g")).alias("v"), G.grade_cell(F.col("g")).alias("cell")).first()
    assert r.v == value and r.cell == ("-" if value is None else str(value))


def _sheet(spark):
    rows = [(2, "Ann", "Lee", "u1", 3, "1", "ok", "2", "fine", "3", "good"),
            (3, "Bob", "Ray", "u2", 12, "x", "", "5", "", "6", ""),
            (4, "Cy", "Annex", "u3", 7, "9", "", "9", "", "9", "")]
    return spark.createDataFrame(rows, "row_idx int, first string, last string, id_number string, group_num int, "
                                       "g1 string, f1 string, g2 string, f2 string, g3 string, f3 string")


def test_wide_to_long_updates_lookup(spark):
    lg = G.grades_long(_sheet(spark))
    assert lg.count() == 9
    saves = spark.createDataFrame([(1, 2, 1, "7", "a"), (2, 2, 1, "abc", "b"), (3, 3, 2, " 8 ", "c")],
                                  "seq long, row_idx int, assignment int, grade string, feedback string")
    up = {(r.row_idx, r.assignment): (r.grade, r.feedback) for r in G.apply_updates(lg, saves).collect()}
    assert up[(2, 1)] == (None, "b") and up[(3, 2)] == (8.0, "c") and up[(2, 2)] == (2.0, "fine")
    # a save with neither grade nor feedback clears the cell
    none = spark.createDataFrame([(1, 2, 1, "7", "a"), (2, 2, 1, None, None)], saves.schema)
    r = G.apply_updates(lg, none).where("row_idx = 2 and assignment = 1").first()
    assert (r.grade, r.cell, r.feedback, r.updated) == (None, "-", None, True)
    req = spark.createDataFrame([(2, 3)], "row_idx int, assignment int")
    assert G.lookup(lg, req).first().grade == "3"
    with pytest.raises(Exception, match="numbered 1 to 3"):
        G.lookup(lg, spark.createDataFrame([(2, 4)], "row_idx int, assignment int")).collect()


def test_first_match_and_label(spark):
    s = _sheet(spark)
    labels = s.select("row_idx", G.label(F.col("group_num"), F.col("first"), F.col("last")).alias("label"))
    assert labels.orderBy("row_idx").first().label == "(03) Ann Lee"
    terms = spark.createDataFrame([("ANN",), ("annex",), ("zzz",), ("",), ("ray",), ("(12) bob",)], "term string")
    got = {r.term: r.first_row for r in G.first_match(labels, terms).collect()}
    assert got == {"ANN": 2, "annex": 4, "zzz": -1, "": 2, "ray": 3, "(12) bob": 3}


def test_sheet_window(spark):
    s = spark.range(0, 100).selectExpr("cast(id as int) as row_idx")
    w = G.sheet_window(s)
    assert w.count() == 64 and w.agg(F.min("row_idx"), F.max("row_idx")).first() == (2, 65)


from hypothesis import given, settings
from hypothesis import strategies as st

_ALPHA = st.text(alphabet="abAB ()1", min_size=0, max_size=8)


@settings(max_examples=10, deadline=None)
@given(st.lists(_ALPHA, min_size=1, max_size=12), st.lists(_ALPHA, min_size=1, max_size=8))
def test_first_match_equals_brute_force(spark, labels, terms):
    lab = spark.createDataFrame([(i + 2, x) for i, x in enumerate(labels)], "row_idx int, label string")
    ts = spark.createDataFrame([(x,) for x in terms], "term string")
    got = {r.term: r.first_row for r in G.first_match(lab, ts).collect()}
    for term in set(terms):
        hits = [i + 2 for i, x in enumerate(labels) if term.lower() in x.lower()]
        assert got[term] == (hits[0] if hits else -1), (term, labels)


@pytest.mark.parametrize("block", [300, 1 << 24])
def test_first_match_over_term_blocks(spark, block):
    labels = [(i, f"({i % 7:02d}) Anna-{i} O'Neil é{i * i}") for i in range(2, 200)] + [(1, None), (None, "nobody")]
    terms = ["anna", "É4", "zzz", "", "o'neil é9", "(03)", "Anna-1", "anna-19", "nobody", "a" * 300, *[str(i) for i in range(40)]]
    got = {r.term: r.first_row for r in G.first_match(spark.createDataFrame(labels, "row_idx long, label string").repartition(5),
                                                     spark.createDataFrame([(t,) for t in terms], "term string"),
                                                     block_bytes=block).collect()}
    known = sorted((i, x.lower()) for i, x in labels if i is not None and x is not None)
    for t in terms:
        want = 1 if t == "" else next((i for i, x in known if t.lower() in x), -1)
        assert got[t] == want, t
