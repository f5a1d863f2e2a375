"""Driver-table queries for the score tables.

The sheet is built from ``part``: one row per part, ``row_idx = p_partkey + 2``,
names from ``p_name``, three (grade, feedback) pairs from size, price and a
mix of number-like texts. Saves come from ``orders``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gradebook as G
from ..session import fresh_dir
from ..sources.tables import table
from ..sources.textfiles import read_sheet, write_lines


ROW_OFFSET = 2      # row_idx = p_partkey + 2 (the sheet's first data row is 2)
N_FILES = 3         # at least; more for more bytes


def sheet(spark, sf_dir, rows: tuple[int, int] | None = None):
    """The sheet; ``rows=(lo, hi)`` keeps that row window, stated on the
    source key so the range reaches the parquet scan as a pushed filter."""
    p = table(spark, sf_dir, "part")
    if rows is not None:
        p = p.where(F.col("p_partkey").between(rows[0] - ROW_OFFSET, rows[1] - ROW_OFFSET))
    words = F.split("p_name", " ")
    size = F.col("p_size").cast("string")
    g3 = (F.when(F.col("p_size") % 5 == 0, F.concat(F.lit(" "), size, F.lit(" ")))
           .when(F.col("p_size") % 5 == 1, F.lit("abc"))
           .when(F.col("p_size") % 5 == 2, F.concat(size, F.lit("_000")))
           .when(F.col("p_size") % 5 == 3, F.lit("None"))
           .otherwise(F.concat(size, F.lit("e1"))))
    return p.select(
        (F.col("p_partkey") + ROW_OFFSET).cast("int").alias("row_idx"),
        F.element_at(words, 1).alias("first"),
        F.array_join(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), " ").alias("last"),
        F.col("p_brand").alias("id_number"),
        (F.col("p_partkey") % 16 + 1).cast("int").alias("group_num"),
        size.alias("g1"), F.col("p_type").alias("f1"),
        F.format_string("%.2f", "p_retailprice").alias("g2"), F.col("p_brand").alias("f2"),
        g3.alias("g3"), F.col("p_name").alias("f3"))


def _saves(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    grade = (F.when(F.col("o_orderstatus") == "F", (F.floor("o_totalprice") % 100).cast("string"))
              .when(F.col("o_orderstatus") == "O", F.lit("n/a"))
              .otherwise(F.concat(F.lit(" "), F.floor(F.col("o_totalprice") / 1000).cast("string"),
                                  F.lit("_000 "))))
    return o.select(F.col("o_orderkey").alias("seq"), (F.col("o_custkey") + 2).cast("int").alias("row_idx"),
                    (F.col("o_orderkey") % 3 + 1).cast("int").alias("assignment"),
                    grade.alias("grade"), F.col("o_orderpriority").alias("feedback"))


def sheet_files(spark, sf_dir):
    """S8 from a path: the sheet is written as CSV files in row order and read back, rows numbered by file and line."""
    rows = sheet(spark, sf_dir)
    cells = [c for c in rows.columns if c != "row_idx"]
    folder = fresh_dir(spark, "sheet-files")
    as_is = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    write_lines(rows, ["row_idx"], F.to_csv(F.struct(*cells), as_is), folder, N_FILES)
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in cells)
    back = read_sheet(spark, folder, schema, first_row=G.FIRST_ROW)
    return back.select("row_idx", "first", "last", "id_number", "group_num", "g3")


def sheet_window(spark, sf_dir):
    """Rows 2..65 of the sheet (the window is also re-checked on row_idx)."""
    s = sheet(spark, sf_dir, rows=(G.FIRST_ROW, G.LAST_ROW))
    return G.sheet_window(s).select("row_idx", "first", "last", "id_number", "group_num")


def grade_long(spark, sf_dir):
    return G.grades_long(sheet(spark, sf_dir))


def grade_coerce(spark, sf_dir):
    lg = G.grades_long(sheet(spark, sf_dir))
    return lg.select("row_idx", "assignment", G.coerce_grade(F.col("grade")).alias("grade_num"),
                     G.grade_cell(F.col("grade")).alias("cell"))


def grade_update(spark, sf_dir):
    return G.apply_updates(G.grades_long(sheet(spark, sf_dir)), _saves(spark, sf_dir))


def _labels(spark, sf_dir):
    s = sheet(spark, sf_dir)
    return s.select("row_idx", G.label(F.col("group_num"), F.col("first"), F.col("last")).alias("label"))


def grade_label(spark, sf_dir):
    return _labels(spark, sf_dir)


def first_match(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    words = p.select(F.explode(F.transform(F.split("p_name", " "), F.upper)).alias("term"))
    brands = p.select(F.col("p_brand").alias("term"))
    frags = p.select(F.explode(F.split("p_type", " ")).alias("term"))
    terms = words.unionByName(brands).unionByName(frags)
    return G.first_match(_labels(spark, sf_dir), terms)


def grade_lookup(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    req = o.select("o_orderkey", (F.col("o_custkey") + 2).cast("int").alias("row_idx"),
                   (F.col("o_orderkey") % 3 + 1).cast("int").alias("assignment"))
    return G.lookup(G.grades_long(sheet(spark, sf_dir)), req).select(
        "o_orderkey", "row_idx", "assignment", "grade", "feedback")


QUERIES = {
    "sheet_window": sheet_window,
    "sheet_files": sheet_files,
    "grade_long": grade_long,
    "grade_coerce": grade_coerce,
    "grade_update": grade_update,
    "grade_label": grade_label,
    "first_match": first_match,
    "grade_lookup": grade_lookup,
}

_SHEET = r"""with sheet as (
  select (p_partkey + 2)::int as row_idx, string_split(p_name, ' ')[1] as first,
         array_to_string(string_split(p_name, ' ')[2:], ' ') as last, p_brand as id_number, (p_partkey % 16 + 1)::int as group_num,
         p_size::varchar as g1, p_type as f1, printf('%.2f', p_retailprice) as g2, p_brand as f2,
         case p_size % 5 when 0 then ' ' || p_size || ' ' when 1 then 'abc' when 2 then p_size || '_000'
                         when 3 then 'None' else p_size || 'e1' end as g3,
         p_name as f3
  from part),
long as (
  select row_idx, 1 as assignment, g1 as grade, f1 as feedback from sheet
  union all select row_idx, 2, g2, f2 from sheet
  union all select row_idx, 3, g3, f3 from sheet)"""


def _coerce(x):
    t = rf"regexp_replace(trim({x}), '(\d)_(\d)', '\1\2', 'g')"
    return (rf"(case when regexp_matches(lower({t}), '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(nan|inf|infinity)$')"
            rf" then try_cast({t} as double) end)")


SQL = {
    "sheet_window": _SHEET + " select row_idx, first, last, id_number, group_num from sheet where row_idx between 2 and 65",
    "sheet_files": _SHEET + " select row_idx, first, last, id_number, group_num, g3 from sheet",
    "grade_long": _SHEET + " select row_idx, assignment, grade, feedback from long",
    "grade_coerce": _SHEET + f" select row_idx, assignment, {_coerce('grade')} as grade_num,"
                    f" coalesce({_coerce('grade')}::varchar, '-') as cell from long",
    "grade_update": _SHEET + f""",
        saves as (select o_orderkey as seq, (o_custkey + 2)::int as row_idx, (o_orderkey % 3 + 1)::int as assignment,
                         case when o_orderstatus = 'F' then (floor(o_totalprice) % 100)::bigint::varchar
                              when o_orderstatus = 'O' then 'n/a'
                              else ' ' || floor(o_totalprice / 1000)::bigint || '_000 ' end as grade,
                         o_orderpriority as feedback from orders),
        latest as (select row_idx, assignment, max_by(grade, seq) as ug, max_by(feedback, seq) as uf
                   from saves group by all)
        select l.row_idx, l.assignment,
               case when u.row_idx is not null then {_coerce('u.ug')} else {_coerce('l.grade')} end as grade,
               coalesce(case when u.row_idx is not null then {_coerce('u.ug')} else {_coerce('l.grade')} end::varchar,
                        '-') as cell,
               case when u.row_idx is not null then u.uf else l.feedback end as feedback,
               u.row_idx is not null as updated
        from long l left join latest u using (row_idx, assignment)""",
    "grade_label": _SHEET + " select row_idx, printf('(%02d) %s %s', group_num, first, last) as label from sheet",
    "first_match": _SHEET + """,
        lab as (select row_idx, lower(printf('(%02d) %s %s', group_num, first, last)) as l from sheet),
        terms as (select distinct term from (
                    select upper(unnest(string_split(p_name, ' '))) as term from part
                    union all select p_brand from part
                    union all select unnest(string_split(p_type, ' ')) from part))
        select t.term, coalesce((select min(row_idx) from lab where contains(lab.l, lower(t.term))), -1)::bigint
               as first_row
        from terms t""",
    "grade_lookup": _SHEET + """
        select o_orderkey, (o_custkey + 2)::int as row_idx, (o_orderkey % 3 + 1)::int as assignment,
               l.grade, l.feedback
        from orders o left join long l on l.row_idx = o.o_custkey + 2 and l.assignment = o.o_orderkey % 3 + 1""",
}
