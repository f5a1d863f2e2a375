import collections

import numpy as np
import pytest

from strata.llm import langid as L

TEXTS = {"en": "the quick brown fox jumps over the lazy dog and then the other thing that they want",
         "fr": "le vif renard brun saute par dessus le chien paresseux et puis une autre chose que nous voulons",
         "de": "der schnelle braune fuchs springt über den faulen hund und dann noch eine andere sache die wir wollen"}


def plain_grams(text):
    out = collections.Counter()
    word = ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            p = f" {word} "
            out.update(word)
            out.update(p[i:i + 2] for i in range(len(p) - 1))
            out.update(p[i:i + 3] for i in range(len(p) - 2))
            word = ""
    return out


def code(g):
    c = 0
    for x in g:
        c = c << 21 | ord(x)
    return c


@pytest.mark.parametrize("text", [None, "", "42 !!", "Ab, c!", "İstanbul ẞ 中文 x", "a b  cc\n\ndd", "é1é", *TEXTS.values()])
def test_grams(text):
    codes, n = L.grams(text)
    assert dict(zip(codes.tolist(), n.tolist())) == {code(g): k for g, k in plain_grams(text).items()}
    assert (np.diff(codes) > 0).all()


def test_distances_equal_plain():
    prof = {k: sorted(plain_grams(t), key=lambda g, t=t: (-plain_grams(t)[g], code(g)))[:40] for k, t in TEXTS.items()}
    p = L.Profiles({k: [code(g) for g in v] for k, v in prof.items()}, 40)
    text = "the fox und der dog saute 中"
    g = plain_grams(text)
    mine = sorted(g, key=lambda x: (-g[x], code(x)))[:40]
    want = [sum(abs(prof[k].index(x) - i) if x in prof[k] else 40 for i, x in enumerate(mine)) for k in sorted(prof)]
    assert p.distances(L.ranked(*L.grams(text), 40)).tolist() == want


def frame(spark):
    rows = [(i, t, k, "x") for i, (k, t) in enumerate([*TEXTS.items()] * 12)]
    rows += [(None, TEXTS["en"], "en", None), (100, None, "en", None), (101, "", None, "y"), (102, "12 34", "fr", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")


def test_predicts(spark):
    df = frame(spark)
    out, (lang, score) = L.predict(df, L.train_on_documents(df))
    assert lang not in df.columns and out.count() == df.count()
    for r in out.collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert (r[lang], r[score]) == ("und", 0.0)
        else:
            assert r[lang] == r.lang and 0 < r[score] <= 1


def test_held_out_rows_teach_nothing(spark):
    from pyspark.sql import functions as F
    from strata.llm.common import held_out
    df = frame(spark)
    wrong = df.withColumn("text", F.when(held_out(F.col("doc_id")), "zzz").otherwise(F.col("text")))
    a, b = L.train_on_documents(df), L.train_on_documents(wrong)
    assert a.names == b.names and (a.codes == b.codes).all() and (a.rank == b.rank).all()


def test_ties_and_empty(spark):
    p = L.Profiles({"b": [97], "a": [97]}, 10)
    assert p.predict("a") == ("a", p.predict("a")[1])
    df = frame(spark)
    none = L.train_on_documents(df.limit(0))
    assert {r.lang_pred_x for r in L.predict(df.drop("lang_pred"), none)[0].withColumnRenamed(
        "lang_pred", "lang_pred_x").collect()} == {"und"}
    assert L.predict(df.limit(0), p)[0].collect() == []


def test_long_text():
    p = L.Profiles({k: L.ranked(*L.grams(t)).tolist() for k, t in TEXTS.items()})
    assert p.predict(TEXTS["de"] * 3000)[0] == "de"


def test_every_group_is_sampled(spark, monkeypatch):
    from pyspark.sql import functions as F

    from strata.llm import common
    df = spark.range(20_100).select("id", F.when(F.col("id") > 0, F.col("id") % 10_050).alias("lang"))
    got = common.bounded_sample(df, F.col("lang"), F.col("id"), 1)
    assert got.count() == got.distinct().count() == 10_051          # one of each, and the null group
    monkeypatch.setattr(common, "BROADCAST_GROUPS", 10, raising=False)
    assert sorted(map(str, common.bounded_sample(df, F.col("lang"), F.col("id"), 1).collect())) == sorted(map(str, got.collect()))


def test_a_repeated_document_fills_no_sample(spark, monkeypatch):
    """Half as many copies of the id with the smallest hash as there are ids: the sample still holds distinct ids."""
    seen = []
    monkeypatch.setattr(L, "train", lambda rows, *a: seen.append(rows.collect()))
    ids = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang")
    hot = ids.where(~L.held_out(ids["doc_id"])).selectExpr(
        "min_by(doc_id, pmod(xxhash64(doc_id), shiftleft(1L, 40))) as doc_id").first()[0]
    copies = spark.range(2500).selectExpr(f"{hot}L as doc_id", "'a copy' as text", "'en' as lang")
    L.train_on_documents(ids.unionByName(copies), sample_rows=300)
    assert len(seen[0]) == len({r.doc_id for r in seen[0]}) == 300 and hot in {r.doc_id for r in seen[0]}
