"""URL rules by expressions, hash prefixes and full digests.

Every URL is expanded into expressions: a suffix of its host (on label borders)
followed by a prefix of its path. Expressions and rules meet in an equi-join on
the first ``PREFIX_HEX`` hex digits of their SHA-256; the full digest confirms a
match. Of the rules that
fit, the longest wins, then block over allow, then the greater rule text.

Only (labels, path length) shapes that some rule has are expanded: the shapes are a table, joined by the number of
labels, and each expression is a row of its own, so no URL's expressions are held together. Distinct (host, path)
pairs are judged once, so a hot host or URL is pre-aggregated before any shuffle, and go by a digest from there.
The rule table is small or large as it comes: Spark broadcasts it by its measured
size or joins by a shuffle.

Defined results: a null URL or one without ``://`` has empty host and path; a URL
that no rule fits gets the default verdict and a null rule; repeated rows each
get a row; rules with a null host or path or another action than allow or block
fit nothing; an empty rule table fits nothing; extra columns pass through.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_small, unused

PREFIX_HEX = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?`` or ``#``)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def _suffix(host: Column, labels: Column) -> Column:
    """The last ``labels`` labels of a host."""
    parts = F.split(host, r"\.")
    return F.array_join(F.slice(parts, -labels, labels), ".")


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> tuple[DataFrame, dict[str, str]]:
    """``pages`` plus (host, path, rule, verdict) under unused names (second result: field -> column).

    ``rules``: (host, path, action), action allow or block.
    """
    r = rules.select(F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("host"), "path",
                     "action").where("host is not null and path is not null and action in ('allow', 'block')")
    shapes = r.select(_labels(F.col("host")).alias("labels"), F.length("path").alias("chars")).distinct()
    r = (r.select(F.concat("host", "path").alias("rule"),
                  (F.col("action") == "block").alias("block")).distinct()
         .withColumn("rule_digest", F.sha2("rule", 256))
         .withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX)))
    names = {n: unused(pages, n) for n in ("host", "path", "rule", "verdict")}
    host, path = host_and_path(F.col(url_col))
    split = pages.withColumns({names["host"]: host, names["path"]: path})
    h, p, pair, b = F.col(names["host"]), F.col(names["path"]), unused(split, "_pair"), unused(split, "_best")
    split = split.withColumn(pair, F.sha2(F.concat(h, F.lit("\x00"), p), 256))
    pairs = split.select(F.col(pair).alias("pair"), h.alias("host"), p.alias("path")).distinct()
    by_label = pairs.withColumn("labels", F.explode(F.sequence(F.lit(1), _labels(F.col("host")))))
    shaped = join_small(by_label, shapes, ["labels"]).where(F.col("chars") <= F.length("path"))
    expression = F.concat(_suffix(F.col("host"), F.col("labels")), F.substr("path", F.lit(1), F.col("chars")))
    digests = shaped.select("pair", F.sha2(expression, 256).alias("digest"))
    digests = digests.withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    fits = digests.join(r, "prefix").where("digest = rule_digest")
    best = fits.groupBy(F.col("pair").alias(pair)).agg(
        F.max(F.struct(F.length("rule").alias("size"), "block", "rule")).alias(b))
    out = split.join(best, pair, "left")
    verdict = F.when(F.col(b).isNull(), F.lit(default)).when(F.col(b)["block"], "block").otherwise("allow")
    return out.withColumns({names["rule"]: F.col(b)["rule"], names["verdict"]: verdict}).select(
        *pages.columns, *names.values()), names
