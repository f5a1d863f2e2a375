"""The corpus operators on the driver tables: one query opN_<name> each, and the pipeline.

Every query reads its whole table and returns its full result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import fresh_dir
from ..sources.tables import table
from . import (balltree, bpe, decontam, fim, hardneg, htmlcrf, langid, oph, quality, simhash, tokencount, toolcalls,
               urlfilter)
from .common import held_out, place


def vocabulary(name: str) -> str:
    """Where a public tokenizer file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out, text = htmlcrf.extract(pages, htmlcrf.train(pages))
    return out.select("page_id", "url", F.col(text).alias("text"), F.length(text).cast("long").alias("n_chars"))


#: tools that the conversations' turns are read as calls of: (name, param, type, required)
TOOL_SCHEMAS = [("reply", "text", "string", True), ("reply", "n_words", "integer", True),
                ("reply", "topic", "string", False), ("configure", "text", "string", True),
                ("configure", "n_words", "integer", True), ("configure", "topic", "string", True)]


def tool_messages(conversations):
    """(calls, results) read from chat turns. A turn of the user calls ``reply`` and one of the system
    ``configure``, by the id <conversation>:<turn>, going on from the call two turns earlier; a turn of the
    assistant is the result of the call one turn earlier. The topic is what comes before the first comma;
    a text with more lines than one gives its word count as text, which the schema refuses. Without a
    conversation or a turn there is no id."""
    turn, text = F.col("turn"), F.col("text")

    def call_id(t):
        return F.concat(F.col("conv_id").cast("string"), F.lit(":"), t.cast("string"))

    words = F.size(F.split(F.trim(text), r"\s+"))
    topic = F.regexp_extract(text, r"^([^,\n]*),", 1)
    odd = F.instr(text, "\n") > 0
    shared = [text.alias("text"), F.when(topic != "", topic).alias("topic")]
    arguments = F.when(odd, F.to_json(F.struct(words.cast("string").alias("n_words"), *shared))) \
        .otherwise(F.to_json(F.struct(words.alias("n_words"), *shared)))
    is_result = F.coalesce(F.col("role") == "assistant", F.lit(False))
    calls = conversations.where(~is_result).select(
        "conv_id", call_id(turn).alias("call_id"), "turn",
        F.when(F.col("role") == "system", "configure").otherwise("reply").alias("name"),
        arguments.alias("arguments"), call_id(turn - 2).alias("parent_id"))
    results = conversations.where(is_result).select("conv_id", call_id(turn - 1).alias("call_id"), "turn",
                                                    text.alias("content"))
    return calls, results


def op2_tool_call_linking(spark, sf_dir):
    calls, results = tool_messages(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(TOOL_SCHEMAS, "name string, param string, type string, required boolean")
    out = toolcalls.link_calls(calls, results, schemas, copies=True)
    return out.select("conv_id", "call_id", "turn", "level", "status", "valid",
                      F.array_join("errors", ",").alias("errors"), "n_calls", "n_results", "json")


#: (host, path, action)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op3_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    out, at = urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select("page_id", *(F.col(at[n]).alias(n) for n in ("host", "path", "rule", "verdict")))


def op4_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = balltree.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def op5_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", width=3, max_bits=3)


def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train_on_labels(docs, table(spark, sf_dir, "labels"))
    scored, (score, predicted) = quality.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(score).alias("score"),
                         F.col(predicted).alias("predicted"))


def op7_bpe_encode_decode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, names = bpe.round_trip(docs, vocabulary("byte_bpe_50k.json"))
    return out.select("doc_id", *names)


def op8_token_counts(spark, sf_dir):
    # a cache of its own for each run: what is timed is a cold cache
    cache = fresh_dir(spark, "token-cache")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = tokencount.count_tokens(docs, vocabulary("word_bpe_49k.json"), cache, drops_white_space=True,
                                     key=place(docs))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op9_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, at = decontam.find_matches(docs, table(spark, sf_dir, "benchmark"))
    items = F.col(at["items"])
    n_hit = decontam.n_hit(F.col(at["hit_starts"]), F.col(at["hit_ends"]))
    return found.select("doc_id", F.col(at["n_words"]).alias("n_words"), n_hit.alias("n_hit"),
                        F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
                        (F.size(items) > 0).alias("contaminated"))


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = langid.train_on_documents(docs)
    out, (lang, score) = langid.predict(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(lang).alias("lang_pred"),
                      F.col(score).alias("score"))


def op11_fill_in_middle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, at = fim.rearrange(docs, "doc_id", "text")
    back, text = fim.restore(out.drop("text"), at["output"], at["form"])
    return back.select("doc_id", F.col(at["n"]).alias("n"), F.col(at["form"]).alias("form"),
                       F.col(at["prefix_units"]).alias("prefix_chars"), F.col(at["middle_units"]).alias("middle_chars"),
                       F.sha2(at["output"], 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hardneg.mine(vectors, F.col("vec_id") % 50 == 0)


def op13_document_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return oph.edited_neighbours(docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint",
                                              "edited_fingerprint", "near_edited", "near_next")


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_tool_call_linking, op3_url_filter, op4_exact_top_k, op5_simhash_near_dedup,
    op6_quality_classifier, op7_bpe_encode_decode, op8_token_counts, op9_benchmark_decontamination, op10_language_id,
    op11_fill_in_middle, op12_hard_negatives, op13_document_fingerprints)}

_RULES = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)

SQL: dict[str, str] = {
    "op3_url_filter": f"""
        with r(rhost, rpath, action) as (values {_RULES}),
        u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
              from pages),
        h as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from u),
        p as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                     regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from h),
        d as (select distinct host, path from p),
        f as (select host, path, rhost || rpath as rule, action,
                     row_number() over (partition by host, path order by length(rhost || rpath) desc, action desc,
                                        rhost || rpath desc) as k
              from d join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
        select page_id, p.host, p.path, rule, coalesce(action, 'allow') as verdict
        from p left join f on p.host = f.host and p.path = f.path and k = 1""",
    "op4_exact_top_k": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
                   from embeddings where vec_id is not null and len(embedding) > 0
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id as query_id, b.vec_id,
                     list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::bigint as score
              from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q))
        select query_id, rank::int as rank, vec_id, score from (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        where rank <= 5""",
    "op9_benchmark_decontamination": """
        with words as (
            select 'd' as kind, doc_id as id, list_filter(regexp_split_to_array(translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w from documents
            union all
            select 'b', item_id, list_filter(regexp_split_to_array(translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') from benchmark),
        size as (select distinct least(len(w), 10) as n from words where kind = 'b' and len(w) > 0),
        wnd as (select distinct id as item_id, least(len(w), 10) as n,
                       unnest(list_transform(range(1, (len(w) - least(len(w), 10) + 2)::bigint),
                              lambda i: array_to_string(w[i:(i + least(len(w), 10) - 1)], ' '))) as g
                from words where kind = 'b' and len(w) > 0),
        pos as (select id as doc_id, n, unnest(range(1, (len(w) - n + 2)::bigint)) as i, w
                from words, size where kind = 'd' and len(w) >= n),
        hit as (select doc_id, pos.n, i, item_id from pos join wnd
                on wnd.n = pos.n and wnd.g = array_to_string(w[i:(i + pos.n - 1)], ' ')),
        covered as (select doc_id, count(distinct k)::bigint as n_hit
                    from (select doc_id, unnest(range(i, i + n)) as k from hit) group by doc_id),
        named as (select doc_id, count(distinct item_id::varchar)::bigint as n_items,
                         string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
                  from hit group by doc_id)
        select d.id as doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0) as n_hit,
               coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from words d left join covered c on c.doc_id = d.id left join named m on m.doc_id = d.id
        where d.kind = 'd'""",
    "op11_fill_in_middle": """
        with d as (select doc_id, coalesce(text, '') as t, length(coalesce(text, ''))::bigint as n,
                          sha256('1:' || coalesce(doc_id::varchar, '')) as x from documents),
        h as (select doc_id, t, n, ('0x' || x[1:8])::bigint % (n + 1) as c1, ('0x' || x[9:16])::bigint % (n + 1) as c2,
                     ('0x' || x[17:24])::bigint as h3, ('0x' || x[25:32])::bigint as h4 from d),
        f as (select doc_id, t, n, least(c1, c2) as a, greatest(c1, c2) as b,
                     case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                               or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
              from h),
        p as (select *, '<P>' || substring(t, 1, a) as pre, '<M>' || substring(t, a + 1, b - a) as mid,
                     '<S>' || substring(t, b + 1, n - b) as suf from f)
        select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
               case when form <> 'plain' then b - a end as middle_chars,
               sha256(case form when 'plain' then t when 'psm' then pre || suf || mid else suf || pre || mid end)
                   as output_sha256, sha256(t) as restored_sha256
        from p""",
    "op12_hard_negatives": """
        with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                          list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
                   from embeddings where vec_id is not null and label is not null and embedding is not null
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
                     coalesce(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])), 0)::bigint
                         as score
              from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
        p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
              qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
        n as (select anchor_id, positive_id, vec_id as negative_id, positive_score, s.score as negative_score,
                     row_number() over (partition by anchor_id, positive_id order by s.score desc, vec_id) as rank
              from p join s using (anchor_id)
              where not same and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
        select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
        from n where rank <= 3""",
}
