"""The registered queries of this folder: thin uses of the operators on whole tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import (
    class_lm, conversation_repair, decontaminate, exact_dedup, hard_negatives, language_id, line_dedup, near_dedup,
    quality, secrets, sentencepiece, substring_dedup, url_filter,
)
from lotwise.llm.common import fold, table


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


RULES = [
    url_filter.Rule("org/", "allow"),
    url_filter.Rule("example.org/es/", "block"),
    url_filter.Rule("example.org/en/1", "block"),
    url_filter.Rule("com/fr/", "allow"),
    url_filter.Rule("com/de/", "block"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = sentencepiece.with_pieces(docs, piece_model())
    return pieces.select(
        "doc_id",
        "pieces.n_tokens",
        F.sha2("pieces.ids", 256).alias("ids_sha256"),
        F.sha2("pieces.decoded", 256).alias("decoded_sha256"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = language_id.train(docs.where(~held_out))
    found = language_id.with_language(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.bits_per_byte").alias("bits_per_byte"),
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=2)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("bigint")

    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2("base_text", 256).alias("base_sha256"),
        "spans",
    )


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 10) == 0
    numbered, model = class_lm.train(docs, ~held_out)
    return class_lm.scores(numbered, model).withColumn("held_out", held_out)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    held_out = fold("doc_id", 4) == 2
    model = quality.train(docs.where(~held_out), labels.where(~held_out))
    return (
        docs.select("doc_id", held_out.alias("held_out"), quality.scored(docs, model).alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
    )


def _damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that their id and turn decide."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    hurt = F.crc32(key.cast("binary")) % 20
    whole = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    text = F.when(hurt == 1, "").when(hurt == 2, F.regexp_replace(whole["text"], "[.!?]", "")).otherwise(whole["text"])
    copies = F.sequence(F.lit(1), F.when(hurt == 3, 2).otherwise(1))
    return conversations.where(hurt != 0).select(
        "conv_id", "turn", F.when(hurt == 4, "user").otherwise(whole["role"]).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found = conversation_repair.repair(_damaged(conversations))
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    columns = [F.coalesce(c, F.lit(nothing.get(c, 0))).cast(t).alias(c) for c, t in found.drop("conv_id").dtypes]
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(F.col("id").alias("conv_id"), *columns)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.with_kept_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_sentencepiece, op3_language_id, op4_near_dedup, op5_substring_dedup,
        op6_secrets, op7_class_lm, op8_exact_dedup, op9_decontaminate,
        op10_quality, op11_conversation_repair, op12_line_dedup, op13_hard_negatives,
    )
}
