"""Rows extracted from text lines by regular expressions.

Spark's regular expressions are Java's: ``\\d`` and ``\\s`` are ASCII only,
which is the meaning kept here (DuckDB's RE2 agrees).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import Scan, ordered_scan

# fixed values: the patterns and names the service scripts use
PID_PATTERN = r"(\d+) SparkSubmit"
LISTING_PATTERN = r"(.+) (/.*)"
HOST_PATTERN = r"(\d+.\d+.\d+.\d+) (student\d+)-(.*)"
MASTER_ROLE = "master"
WORKER_ROLE = "worker"


def text_lines(df: DataFrame, text_col: str, keep: Sequence[str] = (), line_col: str = "line") -> DataFrame:
    """One row per line of each whole text, with its 1-based ``line_no``."""
    return df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("_p", line_col)) \
             .select(*keep, (F.col("_p") + 1).cast("long").alias("line_no"), line_col)


def extract_rows(df: DataFrame, line_col: str, pattern: str, names: Sequence[str],
                 keep: Sequence[str] = ()) -> DataFrame:
    """Every non-overlapping match of ``pattern`` in each line, one row each.

    ``names[i]`` receives capture group ``i + 1``; ``match_no`` is 1-based.
    """
    groups = [F.regexp_extract_all(F.col(line_col), F.lit(pattern), i + 1).alias(n)
              for i, n in enumerate(names)]
    z = df.select(*keep, F.arrays_zip(*groups).alias("_m"))
    return (z.select(*keep, F.posexplode("_m").alias("_i", "_g"))
             .select(*keep, (F.col("_i") + 1).cast("long").alias("match_no"),
                     *[F.col(f"_g.{n}").alias(n) for n in names]))


def single_match_rows(df: DataFrame, line_col: str, pattern: str, names: Sequence[str],
                      keep: Sequence[str] = ()) -> DataFrame:
    """T4 filter: keep lines with exactly one match, as one row of its groups."""
    n = F.size(F.regexp_extract_all(F.col(line_col), F.lit(pattern), 0))
    one = df.where(n == 1)
    return one.select(*keep, *[F.regexp_extract(F.col(line_col), pattern, i + 1).alias(nm)
                               for i, nm in enumerate(names)])


def pids(lines: DataFrame, line_col: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """Process ids of ``SparkSubmit`` lines."""
    return extract_rows(lines, line_col, PID_PATTERN, ["pid"], keep)


def listing_paths(lines: DataFrame, line_col: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """The path of a directory-listing line: the text after its last ``" /"``.
    Lines without one (``Found n items``) give nothing."""
    return extract_rows(lines, line_col, LISTING_PATTERN, ["_head", "path"], keep).drop("_head")


def host_entries(lines: DataFrame, line_col: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """T4: ``(ip, name, id)`` of host lines; lines without exactly one match drop out."""
    return single_match_rows(lines, line_col, HOST_PATTERN, ["ip", "name", "id"], keep)


def host_map(entries: DataFrame, order: str = "line_no") -> DataFrame:
    """T5: ``name -> {id -> ip}`` as rows ``(name, id, ip)``, whatever ids there are; a later line wins."""
    return entries.groupBy("name", "id").agg(F.max_by("ip", order).alias("ip"))


def roles(hosts: DataFrame, cluster: str = "cluster", node_order: str = "node_no",
          n_partitions: int | None = None) -> DataFrame:
    """Hosts of a cluster in (node, id) order; ordinal 0 is the master,
    ordinal n is ``worker<n>`` (3 hosts per node: 1 master + 11 workers on 4 nodes)."""
    ranked = ordered_scan(hosts, [node_order, "id"], [cluster], [Scan("_ord", "row_number")], n_partitions)
    ordinal = F.col("_ord") - 1
    role = F.when(ordinal == 0, F.lit(MASTER_ROLE)).otherwise(F.concat(F.lit(WORKER_ROLE), ordinal.cast("string")))
    return ranked.select(*[c for c in hosts.columns], role.alias("role"))
