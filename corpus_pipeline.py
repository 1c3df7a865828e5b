"""The corpus pipeline: toxicity, near-duplicates, personal data, mixing, packing.

Every stage takes (spark, docs, sf_dir), where docs has the columns of ``documents``, and
works on all rows its predecessor kept. ``run`` writes each stage's rows as Parquet to the
shared folder of the session and reads them again, so a lost executor costs no stage twice.

What each stage keeps and changes:

* toxicity: rows that score 0.5 or more go. Null and empty texts score 0 and stay.
* near_duplicates: of every group linked at five-word shingles and a similarity of 0.8 the
  smallest doc_id stays. Rows without an id or words stay.
* personal_data: texts are sanitised and ``n_chars`` counted again (null for a null text).
* mixing: a document is repeated as often as the mix takes it and leaves if it is not taken.
* packing: one row for each piece of a document, with its sequence and place.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm import pii, toxicity
from gapwise.llm.common import table
from gapwise.llm.mixing import mix
from gapwise.llm.near_text import near_duplicates
from gapwise.llm.packing import pack
from gapwise.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    return toxicity.scored(docs.select(*COLUMNS), model).filter("toxicity.score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_duplicates(docs, shingle=5, percent=80).filter("NOT kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.sanitised(docs.select(*COLUMNS), pii.disclosing_terms(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    documents, _ = mix(docs)
    times = documents.filter("repeats > 0").groupBy("id").agg(F.max("repeats").alias("repeats"))
    taken = docs.select(*COLUMNS).join(times, F.col("doc_id") == F.col("id"))
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))).select(*COLUMNS)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", sanitise),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]

#: Learning, set similarity and packing are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs, _ = scratch.write(stage(spark, docs, sf_dir))
    return docs
