"""Driver-table queries for text lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lines as X
from ..session import fresh_dir
from ..sources.tables import table
from ..sources.textfiles import place_lines, read_lines, write_lines

DOTTED_QUAD = r"(\d+)\.(\d+)\.(\d+)\.(\d+)"
LISTING_PREFIX = "drwxr-xr-x   - hduser supergroup          0 2024-01-01 10:00 "
NODE_BASE = "student"
N_FILES = 3          # at least; more for more bytes


def text_lines(spark, sf_dir):
    """Every line of every document, whole texts."""
    lines = X.text_lines(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return lines.select("doc_id", "line_no", F.length("line").cast("long").alias("line_chars"))


def line_files(spark, sf_dir):
    """S6 from a path: the documents' lines are written as ordered text files and read back, each with its number;
    ``pos`` is the line's place over all files."""
    lines = X.text_lines(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    folder = fresh_dir(spark, "line-files")
    write_lines(lines, ["doc_id", "line_no"], "line", folder, N_FILES)
    placed = place_lines(read_lines(spark, folder))
    return placed.select("pos", F.md5("line").alias("line_md5"))


def extract_rows(spark, sf_dir):
    """Dotted quads in document lines, one row per match."""
    lines = X.text_lines(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return X.extract_rows(lines, "line", DOTTED_QUAD, ["o1", "o2", "o3", "o4"], ["doc_id", "line_no"])


def _jps_output(spark, sf_dir):
    """A three-line process listing per order."""
    o = table(spark, sf_dir, "orders")
    p1 = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "SparkSubmit").otherwise("NameNode")
    p2 = F.when(F.col("o_orderstatus") == "O", "SparkSubmit").otherwise("DataNode")
    text = F.concat_ws("\n",
                       F.concat_ws(" ", F.col("o_orderkey").cast("string"), p1),
                       F.concat_ws(" ", F.col("o_custkey").cast("string"), p2),
                       F.concat_ws(" ", (F.col("o_orderkey") + 1).cast("string"), F.lit("Jps")))
    return o.select("o_orderkey", text.alias("text"))


def pids(spark, sf_dir):
    """Process ids of SparkSubmit entries over each whole listing."""
    return X.pids(_jps_output(spark, sf_dir), "text", ["o_orderkey"])


def _hdfs_listing(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    upath = F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1)
    text = F.concat(F.lit("Found 1 items\n"), F.lit(LISTING_PREFIX), upath)
    return pages.select("page_id", text.alias("text"))


def listing_paths(spark, sf_dir):
    """The path of each listing line; header lines give nothing."""
    lines = X.text_lines(_hdfs_listing(spark, sf_dir), "text", ["page_id"])
    return X.listing_paths(lines, "line", ["page_id", "line_no"]).drop("match_no")


def _hosts_file(spark, sf_dir):
    """Host lines from suppliers; a negative balance gives a line without a host name."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    ip = F.concat_ws(".", F.lit("10"), F.col("s_nationkey").cast("string"),
                     (F.floor(k / 256) % 256).cast("string"), (k % 256).cast("string"))
    host = F.concat(F.lit(NODE_BASE), (F.lit(90) + F.floor(k / 3) % 20).cast("string"),
                    F.lit("-x"), (k % 4 + 1).cast("string"))
    line = F.when(F.col("s_acctbal") < 0, F.concat(ip, F.lit(" localhost"))) \
            .otherwise(F.concat_ws(" ", ip, host))
    return s.select(k.alias("line_no"), line.alias("line"))


def host_entries(spark, sf_dir):
    return X.host_entries(_hosts_file(spark, sf_dir), "line", ["line_no"])


def host_map(spark, sf_dir):
    return X.host_map(X.host_entries(_hosts_file(spark, sf_dir), "line", ["line_no"]))


def roles(spark, sf_dir):
    """Nodes in groups of four consecutive numbers form a cluster."""
    e = X.host_entries(_hosts_file(spark, sf_dir), "line", ["line_no"])
    latest = e.groupBy("name", "id").agg(F.max_by("ip", "line_no").alias("ip"))
    node_no = F.substr("name", F.lit(len(NODE_BASE) + 1)).cast("long")
    base = latest.select(F.min(node_no)).scalar()
    hosts = latest.select("name", "id", "ip", node_no.alias("node_no"),
                          F.floor((node_no - base) / 4).cast("long").alias("cluster"))
    return X.roles(hosts).select("cluster", "name", "id", "ip", "role")


QUERIES = {
    "text_lines": text_lines,
    "line_files": line_files,
    "extract_rows": extract_rows,
    "pids": pids,
    "listing_paths": listing_paths,
    "host_entries": host_entries,
    "host_map": host_map,
    "roles": roles,
}

_DOC_LINES = """with d as (select doc_id, string_split(text, chr(10)) as arr from documents),
    l as (select doc_id, generate_subscripts(arr, 1)::bigint as line_no, unnest(arr) as line from d)"""
_HOSTS = """with s as (select s_suppkey as line_no,
        case when s_acctbal < 0 then '10.' || s_nationkey || '.' || (s_suppkey // 256) % 256 || '.' || s_suppkey % 256
                                     || ' localhost'
             else '10.' || s_nationkey || '.' || (s_suppkey // 256) % 256 || '.' || s_suppkey % 256
                  || ' student' || (90 + (s_suppkey // 3) % 20) || '-x' || (s_suppkey % 4 + 1) end as line
        from supplier),
    e as (select line_no, regexp_extract(line, '(\\d+.\\d+.\\d+.\\d+) (student\\d+)-(.*)', 1) as ip,
                 regexp_extract(line, '(\\d+.\\d+.\\d+.\\d+) (student\\d+)-(.*)', 2) as name,
                 regexp_extract(line, '(\\d+.\\d+.\\d+.\\d+) (student\\d+)-(.*)', 3) as id
          from s where len(regexp_extract_all(line, '(\\d+.\\d+.\\d+.\\d+) (student\\d+)-(.*)', 0)) = 1)"""

SQL = {
    "text_lines": _DOC_LINES + " select doc_id, line_no, length(line)::bigint as line_chars from l",
    "line_files": _DOC_LINES + " select row_number() over (order by doc_id, line_no) as pos, md5(line) as line_md5 from l",
    "extract_rows": _DOC_LINES + r""",
        m as (select doc_id, line_no, regexp_extract_all(line, '(\d+)\.(\d+)\.(\d+)\.(\d+)', 1) as a1,
                     regexp_extract_all(line, '(\d+)\.(\d+)\.(\d+)\.(\d+)', 2) as a2,
                     regexp_extract_all(line, '(\d+)\.(\d+)\.(\d+)\.(\d+)', 3) as a3,
                     regexp_extract_all(line, '(\d+)\.(\d+)\.(\d+)\.(\d+)', 4) as a4 from l)
        select doc_id, line_no, generate_subscripts(a1, 1)::bigint as match_no,
               unnest(a1) as o1, unnest(a2) as o2, unnest(a3) as o3, unnest(a4) as o4 from m""",
    "pids": r"""
        with t as (select o_orderkey,
            o_orderkey || ' ' || case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'SparkSubmit'
                                      else 'NameNode' end || chr(10) ||
            o_custkey || ' ' || case when o_orderstatus = 'O' then 'SparkSubmit' else 'DataNode' end || chr(10) ||
            (o_orderkey + 1) || ' Jps' as text from orders),
        m as (select o_orderkey, regexp_extract_all(text, '(\d+) SparkSubmit', 1) as a from t)
        select o_orderkey, generate_subscripts(a, 1)::bigint as match_no, unnest(a) as pid from m""",
    "listing_paths": f"""
        with t as (select page_id, 'Found 1 items' || chr(10) || '{LISTING_PREFIX}'
                          || regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) as text from pages),
        d as (select page_id, string_split(text, chr(10)) as arr from t),
        l as (select page_id, generate_subscripts(arr, 1)::bigint as line_no, unnest(arr) as line from d),
        m as (select page_id, line_no, regexp_extract_all(line, '(.+) (/.*)', 2) as a from l)
        select page_id, line_no, unnest(a) as path from m""",
    "host_entries": _HOSTS + " select line_no, ip, name, id from e",
    "host_map": _HOSTS + """
        select name, id, max_by(ip, line_no) as ip from e group by name, id""",
    "roles": _HOSTS + """,
        h as (select name, id, max_by(ip, line_no) as ip, substr(name, 8)::bigint as node_no from e group by name, id),
        c as (select *, ((node_no - (select min(node_no) from h)) // 4)::bigint as cluster from h)
        select cluster, name, id, ip,
               case when row_number() over (partition by cluster order by node_no, id) = 1 then 'master'
                    else 'worker' || (row_number() over (partition by cluster order by node_no, id) - 1) end as role
        from c""",
}
