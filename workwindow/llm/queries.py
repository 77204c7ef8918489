"""Registered queries of the operators, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workwindow.llm import (
    bpe,
    chat,
    extraction,
    licenses,
    lm_scores,
    mixing,
    near_duplicates,
    neighbours,
    packing,
    quality,
    ranking,
    repair,
    token_counts,
)
from workwindow.llm.common import table, tokenizer
from workwindow.llm.oracles import SQL


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.read_ranks(tokenizer("byte_bpe_50k.tiktoken"))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), pieces)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in directories source/lang."""
    place = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang", "doc_id")]
    files = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", *place).alias("path"), "text")
    return licenses.scan(files, keep=("doc_id",))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.judge(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = turns.unionByName(planted).withColumn("parts", chat.text_part(F.col("text")))
    out = chat.format_conversations(turns)
    parsed = chat.parse_turns(F.col("formatted"))
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    said = F.transform(parsed, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        F.size(parsed).cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def chat_typed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with an image, an audio and a document part put into every turn, the
    first inside the text; control strings lie across the others."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    none = F.lit(None)

    def part(kind: str, text=none, ref=none, a=none, b=none):
        return F.struct(
            F.lit(kind).alias("kind"),
            text.cast("string").alias("text"),
            ref.cast("string").alias("ref"),
            a.cast("double").alias("size_a"),
            b.cast("double").alias("size_b"),
        )

    parts = F.array(
        part("text", F.substring("text", F.lit(1), half)),
        part("image", ref=F.col("turn"), a=n % 500, b=n % 300),
        part("text", F.substring("text", half + 1, n)),
        part("text", F.lit("<")),
        part("text", F.lit("|turn|> <|image|>")),
        part("audio", a=n % 60),
        part("document", a=n % 7),
    )
    out = chat.format_conversations(turns.withColumn("parts", parts))
    images = F.filter(F.flatten(F.transform(chat.parse_parts(F.col("formatted")), lambda t: t["parts"])), lambda p: p["kind"] == "image")
    return out.select(
        "conv_id",
        "n_turns",
        F.size(images).cast("long").alias("n_images"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "n_attachment_tokens",
        F.sha2("formatted", 256).alias("formatted_sha256"),
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train(pages))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scores.lm_scores(table(spark, sf_dir, "documents"))
    # sums of floats are as exact as their order lets them be
    means = F.round("mean_log_score", 6)
    return scored.select("doc_id", "n_words", "n_backed_off", means.alias("mean_log_score"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("shards")).alias("taken"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.report(conversations, repair.damaged(conversations))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    pieces = packing.pieces_of(documents, tokenizer("word_bpe_49k.json"), with_ids=False)
    return packing.pack(pieces)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scan": op2_license_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_chat_formatting": op5_chat_formatting,
    "chat_typed_parts": chat_typed_parts,
    "op6_html_extraction": op6_html_extraction,
    "op7_bpe": op7_bpe,
    "op8_lm_scores": op8_lm_scores,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_mixing": op10_mixing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_lexical_search": op13_lexical_search,
}
ORACLES = {name: SQL[name] for name in QUERIES if name in SQL}
