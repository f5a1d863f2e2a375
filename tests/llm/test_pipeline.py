import re
import zlib

import pytest

import corpus_pipeline as P
from strata.llm import decontam, langid, quality, simhash
from strata.session import materialize
from strata.sources.tables import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, fn in P.STAGES:
        docs = materialize(fn(spark, docs, SF), "stage")
        out.append(docs)
    return out


def test_order_and_columns(spark, stages):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup",
                                        "benchmark decontamination", "BPE encoding and decoding"]
    columns = table(spark, SF, "documents").columns
    assert all(s.columns == columns for s in stages[:-1])
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_each_stage_decides_on_its_input(spark, stages):
    docs = table(spark, SF, "documents")
    inputs = [[r.asDict() for r in d.collect()] for d in (docs, *stages)]
    ids = [{r["doc_id"] for r in rows} for rows in inputs]
    model = quality.train_on_labels(docs, table(spark, SF, "labels"))
    of = quality.Evidence(model.good, model.bad)
    assert ids[1] == {r["doc_id"] for r in inputs[0] if model.slope * of(r["text"]) + model.offset >= -0.8472978603872036}
    p = langid.train_on_documents(stages[0])
    assert ids[2] == {r["doc_id"] for r in inputs[1] if p.predict(r["text"])[0] == r["lang"]}
    fp = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in inputs[2]}
    left = dict(fp)
    kept = set()
    while left:
        todo = [min(left)]
        kept.add(todo[0])
        del left[todo[0]]
        while todo:
            x = fp[todo.pop()]
            near = [d for d, y in left.items() if (x ^ y).bit_count() <= 3]
            for d in near:
                del left[d]
            todo += near
    assert ids[3] == kept
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = decontam.words_of(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))}
    assert ids[4] == {r["doc_id"] for r in inputs[3] if not any(
        tuple(w[i:i + 10]) in windows for w in [decontam.words_of(r["text"])] for i in range(len(w)))}
    assert ids[5] == ids[4]
    assert len(ids[5]) > 0.7 * len(ids[0])                       # clean documents stay


def test_labelled_good_documents_stay(spark, stages):
    good = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()
            if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    kept = {r.doc_id for r in stages[0].select("doc_id").collect()}
    assert len(good & kept) >= 0.97 * len(good)


def test_run(spark, stages):
    got = P.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].collect()))
    assert P.ORACLE_SQL is None


@pytest.mark.parametrize("rows", [[], "edge"])
def test_edge_tables(spark, rows):
    schema = table(spark, SF, "documents").schema.add("score", "double").add("fp", "string")
    if rows == "edge":
        text = " ".join(re.findall(r"\w+", table(spark, SF, "documents").first().text)[:80])
        rows = [(1, text, "en", None, None, 0.5, "x"), (1, text, "en", None, None, 0.5, "x"), (2, None, None, None, None, None, None),
                (3, "", "en", "s", 0, None, None), (None, text + " more", None, None, None, None, None),
                (4, text * 200, "fr", "s", 1, 0.1, "y")]
    docs = spark.createDataFrame(rows, schema)
    for name, fn in P.STAGES:
        out = fn(spark, docs, SF)
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns
        else:
            assert out.count() == docs.count()
        docs = materialize(out, "edge")


def test_language_stage_keeps_what_it_cannot_judge(spark):
    known_language = dict(P.STAGES)["language ID"]
    schema = table(spark, SF, "documents").select("doc_id", "text", "lang").schema
    texts = {r.lang: r.text for r in table(spark, SF, "documents").collect()}
    untagged = [(i, t, None) for i, t in enumerate(texts.values())] + [(90, "42 !!", None), (91, None, None)]
    got = known_language(spark, spark.createDataFrame(untagged, schema), SF).collect()
    assert {r.doc_id for r in got} == set(range(len(texts)))
    held = [i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 5 == 0]
    one, other = sorted(texts)[:2]
    seen = [i for i in range(100, 200) if i not in held]
    rows = [*((i, texts[one], one) for i in seen[:20]), *((i, texts[other], other) for i in seen[20:40]),
            (held[0], texts[one], "xx"), (held[1], texts[one], other), (held[2], "42", "xx")]
    got = {r.doc_id for r in known_language(spark, spark.createDataFrame(rows, schema), SF).collect()}
    assert got == {*seen[:40], held[0]}
