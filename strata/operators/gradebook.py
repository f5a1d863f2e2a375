"""Score tables: wide to long, grade coercion, last-write-wins updates,
substring search, display labels and lookups (S8, G1-G6)."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the sheet layout of the grade editor
FIRST_ROW, LAST_ROW = 2, 65
ASSIGNMENTS = [(1, "g1", "f1"), (2, "g2", "f2"), (3, "g3", "f3")]
LABEL_FORMAT = "(%02d) %s %s"
NOT_A_NUMBER = "-"

# a number as the grade editor accepts it, after trimming and removing
# underscores between digits: decimal or exponent form, or nan / inf words
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(nan|inf|infinity)$"


def sheet_window(sheet: DataFrame, row: str = "row_idx", lo: int = FIRST_ROW, hi: int = LAST_ROW) -> DataFrame:
    """The fixed row window of the sheet (a pushed-down range filter)."""
    return sheet.where(F.col(row).between(lo, hi))


def grades_long(sheet: DataFrame, row: str = "row_idx") -> DataFrame:
    """G1: one row per (row, assignment) with its grade and feedback cells."""
    stack = ", ".join(f"{i}, {g}, {f}" for i, g, f in ASSIGNMENTS)
    return sheet.selectExpr(row, f"stack({len(ASSIGNMENTS)}, {stack}) as (assignment, grade, feedback)")


def check_assignment(c: Column) -> Column:
    """An assignment index outside 1..3 is an error, as in the editor."""
    n = len(ASSIGNMENTS)
    return F.when(c.between(1, n), c).otherwise(
        F.raise_error(F.concat(F.lit(f"assignments are numbered 1 to {n}, not "), c.cast("string")))).cast("int")


def coerce_grade(s: Column) -> Column:
    """The grade as a double if the text is a number, else NULL (``grade_cell`` shows '-')."""
    t = F.regexp_replace(F.regexp_replace(s, r"^\s+|\s+$", ""), r"(?<=\d)_(?=\d)", "")
    return F.when(F.lower(t).rlike(_NUMBER), t.try_cast("double"))


def grade_cell(s: Column) -> Column:
    """The cell's text: the number, or ``-`` where the text is none."""
    return F.coalesce(coerce_grade(s).cast("string"), F.lit(NOT_A_NUMBER))


def apply_updates(base: DataFrame, updates: DataFrame, keys=("row_idx", "assignment"),
                  seq: str = "seq") -> DataFrame:
    """The latest save of each cell overwrites grade and feedback.

    ``base``: keys + ``grade`` (text) + ``feedback``. ``updates``: keys +
    ``seq`` + ``grade`` (input text) + ``feedback``. The latest save per cell
    is found by an aggregate (partial per task, so a much-edited cell costs
    one row per task), then joined onto the base by the cell key. A save
    counts whatever it holds: one with neither grade nor feedback clears the cell.
    """
    keys = list(keys)
    latest = (updates.groupBy(*keys)
              .agg(F.max_by(F.struct("grade", "feedback"), seq).alias("_u"))
              .select(*keys, F.col("_u.grade").alias("_ug"), F.col("_u.feedback").alias("_uf"),
                      F.lit(True).alias("_saved")))
    j = base.join(latest, keys, "left")
    updated = F.col("_saved").isNotNull()
    text = F.when(updated, F.col("_ug")).otherwise(F.col("grade"))
    return j.select(*keys, coerce_grade(text).alias("grade"), grade_cell(text).alias("cell"),
                    F.when(updated, F.col("_uf")).otherwise(F.col("feedback")).alias("feedback"),
                    updated.alias("updated"))


def label(group_num: Column, first: Column, last: Column) -> Column:
    """Display label ``(gg) first last``."""
    return F.format_string(LABEL_FORMAT, group_num.cast("int"), first, last)


TERM_BYTES = 16 << 20            # of terms whose automaton a task holds


def _matcher(terms: list[str]):
    """Per task: (term number, lowest row of a label that holds it) of every batch of (row, label)."""

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        words = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            words.add_word(t, i)
        words.make_automaton()
        least: dict[int, int] = {}
        for b in batches:
            for at, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for _, i in words.iter(text):
                    if at < least.get(i, at + 1):
                        least[i] = at
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()), pa.array(list(least.values()), pa.int64())],
                                         names=["_i", "_hit"])
    return run


def first_match(labels: DataFrame, terms: DataFrame, row: str = "row_idx", text: str = "label",
                term: str = "term", block_bytes: int = TERM_BYTES) -> DataFrame:
    """For each term, the first row (lowest ``row``) whose label contains
    it, case-insensitively; -1 if none; the empty term matches the first row.

    No (term, row) pair is ever formed. Each task reads its labels once through an Aho-Corasick automaton of all
    terms, whatever their lengths, and returns the lowest row of every term that it met. Terms are taken in
    blocks of about ``block_bytes`` (measured); each block is one pass over the labels.
    """
    t = terms.select(F.col(term).alias("term")).distinct().withColumn("_t", F.lower("term"))
    first_row = labels.select(F.min(row)).scalar()
    lab = labels.select(F.col(row).cast("long").alias("_row"), F.lower(F.col(text)).alias("_l")).where(
        "_row is not null and _l is not null")
    words = t.where("_t <> ''").select("_t").distinct()
    size = words.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    seen = []
    for i in range(blocks):
        mine = words.where(F.pmod(F.xxhash64("_t"), F.lit(blocks)) == i) if blocks > 1 else words
        some = [r["_t"] for r in mine.collect()]                   # one block
        if not some:
            continue
        found = lab.mapInArrow(_matcher(some), "_i int, _hit long").groupBy("_i").agg(F.min("_hit").alias("_hit"))
        names = labels.sparkSession.createDataFrame(pd.DataFrame({"_s": some, "_n": range(len(some))}), "_s string, _n int")
        seen.append(found.join(names, F.col("_i") == F.col("_n")).select("_s", "_hit"))
    if not seen:
        seen = [labels.sparkSession.createDataFrame([], "_s string, _hit long")]
    hits = t.join(reduce(DataFrame.unionByName, seen), F.col("_t") == F.col("_s"), "left")
    hit = F.when(F.length("_t") == 0, first_row).otherwise(F.col("_hit"))
    return hits.select("term", F.coalesce(hit.cast("long"), F.lit(-1).cast("long")).alias("first_row"))


def lookup(long: DataFrame, requests: DataFrame, keys=("row_idx", "assignment")) -> DataFrame:
    """Grade and feedback of each requested (row, assignment)."""
    keys = list(keys)
    req = requests.withColumn("assignment", check_assignment(F.col("assignment")))
    return req.join(long, keys, "left")
