"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm import hosts, pii, plain_sql, quality, toxicity
from gapwise.llm.common import WORD, table
from gapwise.llm.mixing import mix
from gapwise.llm.near_text import near_duplicates
from gapwise.llm.near_vectors import near_vectors
from gapwise.llm.packing import pack
from gapwise.llm.pages import extract
from gapwise.llm.phrases import collocations
from gapwise.llm.repeats import repeated_passages
from gapwise.llm.runs import periodic_runs
from gapwise.llm.sharding import place_in_shards
from gapwise.scratch import Scratch


#: Fixed values of the contract: shards; least count and lines of a language.
SHARDS = 8
LEAST, MOST = 100, 2000


def op1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, _ = Scratch(spark).write(quality.with_counts(table(spark, sf_dir, "documents")))
    labels = table(spark, sf_dir, "labels").filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"))
    kept, rule = quality.verdict(quality.fit(counts.join(labels, "id")))
    failed = quality.base_failed()
    return counts.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & kept).alias("kept"),
        rule.alias("rule"),
    )


def op3_near_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3.0)
    return documents.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    score = F.col("toxicity.score")
    return toxicity.scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        F.col("toxicity.offending").alias("offending"),
    )


#: Fixed rules of the contract.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op8_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hosts.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), RULES, least_good=0.8, z=1.645)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.findings(docs, pii.disclosing_terms(docs))
    return found.select(
        "doc_id",
        *[F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in pii.PATTERNS],
        F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("found")).alias("spans"),
    )


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_in_shards(table(spark, sf_dir, "documents"), shards=SHARDS).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def with_repetition(docs: DataFrame) -> DataFrame:
    """The texts of the contract: of a tenth of the documents a first part is repeated to the end."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    docs = docs.withColumn("turned", (F.col("h") % 10 == 0) & F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    n, g = F.size(words), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), repeated), F.lit(1), n), " ")
    return docs.select("doc_id", F.when(F.col("turned"), changed).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repetition(table(spark, sf_dir, "documents")), keep=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=LEAST, longest=5, covered=100, most=MOST)


QUERIES = {
    "op1_pages": op1_pages,
    "op2_quality": op2_quality,
    "op3_near_text": op3_near_text,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_near_vectors": op6_near_vectors,
    "op7_toxicity": op7_toxicity,
    "op8_hosts": op8_hosts,
    "op9_pii": op9_pii,
    "op10_repeats": op10_repeats,
    "op11_sharding": op11_sharding,
    "op12_runs": op12_runs,
    "op13_phrases": op13_phrases,
}
ORACLES = {
    "op8_hosts": hosts.ORACLE,
    "op11_sharding": plain_sql.shards_sql(SHARDS),
    "op12_runs": plain_sql.RUNS,
    "op13_phrases": plain_sql.phrases_sql(LEAST, 5, MOST),
}
