"""The operators of this subpackage over the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillgate.llm import ann, chat, common as c, decontaminate, hard_negatives, infill, language_id, mixing, near_dedup, packing, pii, quality, suffix_tree, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Text and label of the rows that may be learned from."""
    return (
        docs.select("doc_id", "text")
        .join(labels.select("doc_id", F.col(label).alias("label")).filter(F.col("label").isNotNull()), "doc_id")
        .filter(c.fold("doc_id", 5) != 0)
    )


@query
def op2_language_codes(spark, sf):
    docs = table(spark, sf, "documents")
    model = language_id.train(docs.filter(c.fold("doc_id", 4) != 2))
    held_out = (c.fold("doc_id", 4) == 2).alias("held_out")
    return language_id.predict(docs, model, keep=[held_out]).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op6_quality(spark, sf):
    docs = table(spark, sf, "documents")
    model = quality.train(docs, labelled(docs, table(spark, sf, "labels"), "quality"))
    got = quality.score(docs, model)
    return got.select("doc_id", (c.fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op7_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.train(labelled(docs, table(spark, sf, "labels"), "toxic"))
    got = toxicity.score(docs, model)
    return got.select("doc_id", (c.fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op9_suffix_tree(spark, sf):
    return suffix_tree.score(table(spark, sf, "documents"), c.fold("doc_id", 7) != 2)


@query
def op8_temperature_mix(spark, sf):
    docs = table(spark, sf, "documents")
    return mixing.mix(docs).select("doc_id", "source", F.col("_pass").alias("pass"), F.col("_place").alias("place"))


@query
def op10_chat_format(spark, sf):
    planted = spark.sql(
        "select -7L as conv_id, turn, role, '</s>[INST] ok [/INST]' as text "
        "from values (0, 'user'), (1, 'assistant') as t(turn, role)"
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    got = chat.with_loss_mask(chat.format_conversations(turns))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return got.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_CONTROL = r"([\[<])(\\*)(/?INST\]|/?s>)"
ORACLES["op10_chat_format"] = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
led as (
    select *, lag(role) over (partition by conv_id order by turn, role, text) as before from turns),
sized as (
    select *, length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g'))
        + case when before is null then 13 + length(regexp_replace(role, '{_CONTROL}', '\1\\\2\3', 'g'))
               when before = role then 3
               else 17 + length(regexp_replace(role, '{_CONTROL}', '\1\\\2\3', 'g')) end as chars
    from led)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    (sum(chars) + 4)::bigint as formatted_chars
from sized group by conv_id
"""


@query
def op5_projection_forest(spark, sf):
    return ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op3_skip_chain(spark, sf):
    docs = table(spark, sf, "documents")
    got = pii.find(docs, pii.train(docs), keep=[F.col("doc_id")])
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return got.select("doc_id", *counts, F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"),
                      pii.listed(F.col("spans")).alias("spans"))


@query
def op1_weighted_minhash(spark, sf):
    return near_dedup.classes(table(spark, sf, "documents"))


@query
def op4_latent_decontamination(spark, sf):
    found = decontaminate.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"), keep=[F.col("doc_id")])
    return found.select("doc_id", F.inline("matches"))


@query
def op12_skip_list(spark, sf):
    got = infill.rearrange(table(spark, sf, "documents"), keep=[F.col("doc_id")])

    def sha(text):
        return F.sha2(text.cast("binary"), 256)

    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                      sha(infill.restored()).alias("restored_sha256"))


ORACLES["op12_skip_list"] = """
with cut as (
    select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
        sha256('1:' || doc_id) as h from documents),
drawn as (
    select *, len(u) as n, ('0x' || h[1:8])::ubigint % (len(u) + 1) as a, ('0x' || h[9:16])::ubigint % (len(u) + 1) as b,
        ('0x' || h[17:24])::ubigint % 100 as c, ('0x' || h[25:32])::ubigint % 100 as d from cut),
formed as (
    select *, case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or c >= 90 then 'plain'
                   when d < 20 then 'spm' else 'psm' end as form,
        array_to_string(u[1:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m,
        array_to_string(u[greatest(a, b) + 1:], '') as s from drawn)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
    case when form <> 'plain' then length(m) end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                     else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(t) as restored_sha256
from formed
"""


@query
def op11_column_generation(spark, sf):
    packed = packing.pack(table(spark, sf, "documents"), keep=[F.col("doc_id")], vocabulary=public_tokenizers.path("word_bpe_49k.json"))
    return packed.pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op13_cover_tree(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


ORACLES["op13_cover_tree"] = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, list_dot_product(a.v, b.v)::bigint as score
    from rows a join rows b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
near as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select n.anchor_id, positive_id,
    (row_number() over (partition by n.anchor_id, positive_id order by score desc, vec_id))::int as rank,
    vec_id as negative_id, positive_score, score as negative_score
from near n join scored s on n.anchor_id = s.anchor_id and not same
    and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""
