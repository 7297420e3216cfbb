"""The queries of the operators, with production parameters; each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_work_dir
from . import decontaminate, langid, near_dup, packing, quality, simhash, suffix_dedup, token_store, toxicity, url_filter, vector_codes, whitening, wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def remainder(column: str, by: int) -> F.Column:
    """crc32 of an id as text, modulo ``by``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


def op1_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 3) == 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("hits").alias("n_hits"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(remainder("doc_id", 5) != 0))
    return langid.predict(docs, model).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    rows = token_store.documents(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return token_store.with_starts(rows, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]


def rule_labels(pages: DataFrame, rules: list[url_filter.Rule]) -> DataFrame:
    """The labelled URL table: urls that a rule fits, with its verdict."""
    place = url_filter.longest_rule(rules, url_filter.url_host(F.col("url")), url_filter.url_path(F.col("url")))
    blocking = [r.place for r in rules if r.verdict == url_filter.BLOCK]
    return pages.select("url", place.alias("rule")).where("rule IS NOT NULL").select("url", F.col("rule").isin(blocking).alias("blocked"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = url_filter.train(rule_labels(pages, URL_RULES))
    return url_filter.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "blocked_score")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        decontaminate.items_digest(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    return codes.rows.select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it is beyond a long; the operator itself gives it as a decimal."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


QUERIES = {
    "op1_wrapper": op1_wrapper,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_language": op4_language,
    "op5_token_files": op5_token_files,
    "op6_quality": op6_quality,
    "op7_url_filter": op7_url_filter,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_decontamination": op9_decontamination,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_whitening": op12_whitening,
    "op13_simhash": op13_simhash,
}

ORACLE_SQL = {
    "op6_quality": quality.judge_sql(),
    "op9_decontamination": decontaminate.DECONTAMINATION_SQL,
}
