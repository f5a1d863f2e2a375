import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import quality as Q


def words(rng, n):
    return " ".join(rng.choice(["river", "stone", "morning", "quiet", "garden", "letter", "window", "of", "the"])
                    for _ in range(n)).capitalize() + "."


def junk(rng, n):
    return "!! ".join(rng.choice(["BUY", "CLICK", "WIN", "FREE", "$$$", "###"]) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(2)
    docs = [(i, (words if i % 4 else junk)(rng, rng.randint(20, 200)), "s", 0.5) for i in range(600)]
    labels = [(i, int(i % 4 > 0), None) for i in range(500)]
    return (spark.createDataFrame(docs, "doc_id long, text string, score string, predicted double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_learns_and_keeps_good(tables):
    docs, labels = tables
    m = Q.train_on_labels(docs, labels)
    out, (score, predicted) = Q.score(docs, m)
    assert out.columns[:4] == docs.columns and not {score, predicted} & set(docs.columns)
    rows = out.collect()
    assert all(r[predicted] == int(r.doc_id % 4 > 0) for r in rows)
    kept = Q.keep_good(docs, m)
    assert kept.columns == docs.columns and kept.count() == 450


def test_held_out_rows_teach_nothing(spark, tables):
    docs, labels = tables
    m = Q.train_on_labels(docs, labels)
    wrong = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                1 - F.col("quality")).otherwise(F.col("quality")))
    assert Q.train_on_labels(docs, wrong) == m


def test_edge_rows(spark, tables):
    m = Q.train_on_labels(*tables)
    rows = [(1, None), (2, ""), (3, "x" * 300_000), (None, "the river"), (4, "the river"), (4, "the river")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out, (score, _) = Q.score(df, m)
    got = {(r.doc_id, (r.text or "")[:3]): r[score] for r in out.collect()}
    assert all(0 <= v <= 1 for v in got.values()) and out.count() == 6
    assert got[1, ""] == got[2, ""] == pytest.approx(float(m.score(np.array([0.0]))[0]))
    assert Q.score(df.limit(0), m)[0].collect() == []


def test_without_both_labels(spark, tables):
    docs, labels = tables
    for some in (labels.limit(0), labels.where("quality = 1"), labels.withColumn("quality", F.lit(None).cast("int"))):
        m = Q.train_on_labels(docs, some)
        out, (score, predicted) = Q.score(docs, m)
        assert {(r[score], r[predicted]) for r in out.collect()} == {(0.5, 1)}
    assert Q.train_on_labels(docs.limit(0), labels).slope == 0


def test_whole_text_counts():
    rng = random.Random(3)
    e = Q.Evidence(words(rng, 3000).encode(), junk(rng, 3000).encode())
    good, bad = words(rng, 2000), junk(rng, 2000)
    assert e(good) > e(good + bad) > e(bad)


def test_shares_hold_beyond_the_sample(spark):
    most = 4 * max(Q.SAMPLE_ROWS, Q.CALIBRATION_ROWS)
    # labels that say nothing of the text, so the score is the share of good rows: 4 in 5
    docs = spark.range(9 * most).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("river "), F.sha1(F.col("id").cast("string"))).alias("text"))
    labels = docs.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) > 0).cast("int").alias("quality"))
    out = ~Q.held_out(F.col("doc_id"))
    assert min(r["count"] for r in labels.where(out).groupBy("quality").count().collect()) > most
    # rows without a text teach nothing, so they do not count either
    blank = spark.range(9 * most, 20 * most).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    both = docs.unionByName(blank), labels.unionByName(blank.select("doc_id", F.lit(0).alias("quality")))
    m = Q.train_on_labels(*both)
    scored, (score, _) = Q.score(docs, m)
    assert scored.agg(F.avg(score)).first()[0] == pytest.approx(0.8, abs=0.03)
