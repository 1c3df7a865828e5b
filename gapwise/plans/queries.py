"""Queries over the given tables, one per operator, each with its SQL twin where SQL has one.

The feature table is ``orders`` with missing values put in by key hash: a price is null in
bucket 0 and NaN in bucket 1, a customer number, a priority and a label are null in bucket
0 of hashes of their own.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from gapwise.functions import (
    dense_array,
    fill_constant,
    fill_normal,

    md5_bucket,
    missing_profile,
    nudge_zero,
    present_or_null,
    vector_element,
    vector_parts,
    zero_when,
)
from gapwise.operators.assemble import SparseVectorAssembler, assembler
from gapwise.operators.boost import (
    BoostedTreeClassifier,
    BoostedTreeModel,
    best_splits,
    bin_columns,
    entry_arrays,
    gradient_histogram,
    plain_boosted_trees,
    split_candidates,
)
from gapwise.operators.category import (
    CategoryIndexer,
    category_counts,
    category_dictionary,
    label_indexer,
    ordinal_indexer,
    rare_to_other,
)
from gapwise.operators.evaluate import area_under_roc, class_score, roc_points
from gapwise.operators.scale import NumericNormalizer, NumericNormalizerWithReplacement
from gapwise.operators.split import hash_split, random_split, with_side
from gapwise.operators.stats import column_stats, stats_frame
from gapwise.operators.transforms import apply_function, interact, within_bounds, zscore_bounds
from gapwise.plans import variants
from gapwise.plans.boost_sql import boosted_sql, first_round_sql
from gapwise.scratch import Scratch
from gapwise.sources import read_delimited

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    hashed = table(spark, sf_dir, "orders").select(
        "*", *[md5_bucket(key, 100, salt).alias(f"b{salt or 0}") for salt in ("", "c", "p", "l")]
    )
    b = F.col("b0")
    price = F.when(b == 0, None).when(b == 1, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    high = F.col("o_totalprice") + 3 * F.col("o_custkey") + 2000 * b > 300000
    return hashed.select(
        key.alias("k"),
        price.alias("price"),
        F.when(F.col("bc") != 0, F.col("o_custkey").cast("double")).alias("cust"),
        b.cast("double").alias("b"),
        F.when(F.col("bp") != 0, F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("bl") != 0, F.when(high, "high").otherwise("low")).alias("label_text"),
    )


def _bucket_sql(key: str, salt: str = "") -> str:
    return f"(CAST('0x' || substr(md5('{salt}' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 100)"


_HASHED = f"""hashed AS (
  SELECT *, {_bucket_sql('o_orderkey')} AS b0, {_bucket_sql('o_orderkey', 'c')} AS bc,
    {_bucket_sql('o_orderkey', 'p')} AS bp, {_bucket_sql('o_orderkey', 'l')} AS bl FROM orders)"""
FEATURES_SQL = f"""{_HASHED}, feat AS (
  SELECT o_orderkey AS k,
    CASE WHEN b0 = 0 THEN NULL WHEN b0 = 1 THEN CAST('nan' AS DOUBLE) ELSE o_totalprice END AS price,
    CASE WHEN bc <> 0 THEN CAST(o_custkey AS DOUBLE) END AS cust,
    CAST(b0 AS DOUBLE) AS b,
    CASE WHEN bp <> 0 THEN o_orderpriority END AS priority,
    o_orderstatus AS status,
    CASE WHEN bl <> 0 THEN CASE WHEN o_totalprice + 3 * o_custkey + 2000 * b0 > 300000 THEN 'high' ELSE 'low' END END
      AS label_text
  FROM hashed),
clean AS (SELECT *, CASE WHEN isnan(price) THEN NULL ELSE price END AS price0 FROM feat),
mom AS (SELECT avg(price0) AS mu, stddev_samp(price0) AS sd, avg(cust) AS mu_c, stddev_samp(cust) AS sd_c FROM clean)"""


def r6(c):
    """Rounded to 6 places, with minus zero made plain."""
    return F.round(c, 6) + F.lit(0.0)


# ---- sources and splits -------------------------------------------------------------------

_CSV_SCHEMA = StructType(
    [
        StructField("k", LongType(), True),
        StructField("amount", IntegerType(), True),
        StructField("price", DoubleType(), True),
        StructField("status", StringType(), True),
    ]
)


@query(
    "csv_roundtrip_scan",
    f"""WITH {_HASHED} SELECT o_orderkey AS k,
      CASE WHEN b0 IN (2, 3) THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS amount,
      CASE WHEN b0 = 0 THEN NULL ELSE o_totalprice END AS price,
      CASE WHEN b0 = 4 THEN NULL WHEN b0 = 5 THEN '?' ELSE o_orderstatus END AS status FROM hashed""",
)
def csv_roundtrip_scan(spark, sf_dir):
    b = md5_bucket(F.col("o_orderkey"))
    path = Scratch(spark).new_path()
    table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(b == 2, "n17").when(b != 3, F.col("o_custkey").cast("string")),
        F.when(b != 0, F.col("o_totalprice")),
        F.when(b == 4, "").when(b == 5, "?").otherwise(F.col("o_orderstatus")),
    ).write.csv(path, sep=";", header=False)
    return read_delimited(spark, path, _CSV_SCHEMA)


@query(
    "random_split_sizes",
    "SELECT count(*) AS rows_total, count(*) AS rows_in_sides, 0::BIGINT AS keys_in_both, true AS both_sides_used FROM orders",
)
def random_split_sizes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    sides = [s.withColumn("side", F.lit(i)) for i, s in enumerate(random_split(orders, [0.8, 0.2], 123))]
    per_key = sides[0].unionByName(sides[1]).groupBy("o_orderkey").agg(
        F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high")
    )
    total = orders.count()
    return per_key.agg(
        F.lit(total).cast("bigint").alias("rows_total"),
        F.sum("n").alias("rows_in_sides"),
        F.count_if(F.col("low") != F.col("high")).alias("keys_in_both"),
        ((F.min("low") == 0) & (F.max("high") == 1)).alias("both_sides_used"),
    )


@query(
    "hash_split_counts",
    f"""SELECT CAST(CASE WHEN {_bucket_sql('o_orderkey', 'split')} < 80 THEN 0 ELSE 1 END AS BIGINT) AS side,
      count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""",
)
def hash_split_counts(spark, sf_dir):
    tagged = with_side(table(spark, sf_dir, "orders"), "o_orderkey", [80, 20])
    return tagged.groupBy(F.col("side").cast("bigint").alias("side")).agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


# ---- statistics and missing values --------------------------------------------------------


@query(
    "missing_profile",
    f"""WITH {FEATURES_SQL}, n AS (
      SELECT 'price' AS "column", count(*) AS "rows", count_if(price IS NULL) AS nulls, count_if(isnan(price)) AS nans,
        count_if(price = 0) AS zeros FROM feat
      UNION ALL SELECT 'cust', count(*), count_if(cust IS NULL), count_if(isnan(cust)), count_if(cust = 0) FROM feat
      UNION ALL SELECT 'b', count(*), count_if(b IS NULL), count_if(isnan(b)), count_if(b = 0) FROM feat
      UNION ALL SELECT 'priority', count(*), count_if(priority IS NULL), 0, 0 FROM feat)
    SELECT "column", CAST("rows" AS BIGINT) AS "rows", CAST(nulls AS BIGINT) AS nulls, CAST(nans AS BIGINT) AS nans,
      CAST(zeros AS BIGINT) AS zeros, round((nulls + nans) / "rows", 6) + 0.0 AS missing_rate FROM n""",
)
def missing_profile_query(spark, sf_dir):
    profile = missing_profile(features(spark, sf_dir), ["price", "cust", "b", "priority"])
    return profile.withColumn("missing_rate", r6(F.col("missing_rate")))


_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "column_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) + 0.0 AS mean,
        round(stddev_samp({c}), 6) + 0.0 AS std_dev FROM lineitem"""
        for c in _LINE_COLUMNS
    ),
)
def column_stats_query(spark, sf_dir):
    stats = stats_frame(table(spark, sf_dir, "lineitem"), _LINE_COLUMNS)
    return stats.withColumns({"mean": r6(F.col("mean")), "std_dev": r6(F.col("std_dev"))})


@query(
    "trimmed_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) + 0.0 AS mean,
        round(stddev_samp({c}) FILTER (WHERE {c} < 1.5 * (SELECT avg({c}) FROM lineitem)), 6) + 0.0 AS std_dev
        FROM lineitem"""
        for c in _LINE_COLUMNS
    ),
)
def trimmed_stats(spark, sf_dir):
    stats = stats_frame(table(spark, sf_dir, "lineitem"), _LINE_COLUMNS, trim_factor=1.5)
    return stats.withColumns({"mean": r6(F.col("mean")), "std_dev": r6(F.col("std_dev"))})


def _filled(name: str, select: str):
    return query(name, f"WITH {FEATURES_SQL} SELECT k, round({select}, 6) + 0.0 AS filled FROM clean, mom")


def _price_stats(df: DataFrame):
    return column_stats(df, ["price"])["price"]


@_filled("impute_mean", "coalesce(price0, mu)")
def impute_mean(spark, sf_dir):
    df = features(spark, sf_dir)
    return df.select("k", r6(fill_constant(F.col("price"), _price_stats(df).mean)).alias("filled"))


@_filled("impute_sentinel", "coalesce(price0, -999999)")
def impute_sentinel(spark, sf_dir):
    return features(spark, sf_dir).select("k", r6(fill_constant(F.col("price"), -999999)).alias("filled"))


@_filled(
    "impute_normal",
    """coalesce(price0, mu + sd
        * sqrt(-2 * ln((CAST('0x' || substr(md5('normal7:' || CAST(k AS VARCHAR)), 1, 8) AS BIGINT) + 1) / 4294967297.0::DOUBLE))
        * cos(2 * pi() * ((CAST('0x' || substr(md5('normal7:' || CAST(k AS VARCHAR)), 9, 8) AS BIGINT) + 1) / 4294967297.0::DOUBLE)))""",
)
def impute_normal(spark, sf_dir):
    df = features(spark, sf_dir)
    s = _price_stats(df)
    return df.select("k", r6(fill_normal(F.col("price"), s.mean, s.std_dev, 7, F.col("k"))).alias("filled"))


@query(
    "nudge_zero",
    f"""WITH {FEATURES_SQL} SELECT k,
      CASE WHEN cust IS NULL THEN 0.0::DOUBLE WHEN cust % 7 = 0 THEN 0.0001::DOUBLE ELSE cust % 7 END AS filled FROM feat""",
)
def nudge_zero_query(spark, sf_dir):
    return features(spark, sf_dir).select("k", nudge_zero(F.col("cust") % 7).alias("filled"))


@query(
    "conditional_zero",
    f"""WITH {FEATURES_SQL} SELECT k, CASE WHEN price0 IS NULL AND status = 'O' THEN 0.0::DOUBLE ELSE price0 END AS filled
      FROM clean""",
)
def conditional_zero(spark, sf_dir):
    return features(spark, sf_dir).select("k", zero_when(F.col("price"), F.col("status") == "O").alias("filled"))


# ---- categories ---------------------------------------------------------------------------

_DICTIONARY_SQL = """dictionary AS (
  SELECT v, n, row_number() OVER (ORDER BY n DESC, v) - 1 AS idx FROM (
    SELECT {column} AS v, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1))"""


@query(
    "category_dictionary",
    """WITH c AS (
      SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 2
      UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY 2
      UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY 2)
    SELECT "column", value, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) - 1 AS idx FROM c""",
)
def category_dictionary_query(spark, sf_dir):
    counts = category_counts(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus", "o_custkey"])
    return category_dictionary(counts)


@query(
    "category_index_keep",
    f"""WITH {FEATURES_SQL}, {_DICTIONARY_SQL.format(column='priority', source='feat')}
      SELECT k, CAST(coalesce(idx, (SELECT count(*) FROM dictionary)) AS DOUBLE) AS priority_index
      FROM feat LEFT JOIN dictionary ON v = priority""",
)
def category_index_keep(spark, sf_dir):
    df = features(spark, sf_dir).select("k", "priority")
    model = CategoryIndexer(inputCols=["priority"], outputCols=["priority_index"]).fit(df)
    return model.transform(df).select("k", "priority_index")


@query(
    "category_index_table",
    f"""WITH {FEATURES_SQL}, named AS (SELECT k, CAST(CAST(cust AS BIGINT) AS VARCHAR) AS name FROM feat),
      {_DICTIONARY_SQL.format(column='name', source='named')}
      SELECT k, CAST(coalesce(idx, (SELECT count(*) FROM dictionary)) AS DOUBLE) AS name_index
      FROM named LEFT JOIN dictionary ON v = name""",
)
def category_index_table(spark, sf_dir):
    """A dictionary larger than the driver bound, set low here: ranked as a table, applied by join."""
    df = features(spark, sf_dir).select("k", F.col("cust").cast("bigint").cast("string").alias("name"))
    model = CategoryIndexer(inputCols=["name"], outputCols=["name_index"]).fit(df)
    return model.transform(df).select("k", "name_index")


@query(
    "label_index_skip",
    f"""WITH {FEATURES_SQL}, {_DICTIONARY_SQL.format(column='label_text', source='feat')}
      SELECT k, CAST(idx AS DOUBLE) AS label FROM feat JOIN dictionary ON v = label_text""",
)
def label_index_skip(spark, sf_dir):
    df = features(spark, sf_dir).select("k", "label_text")
    return label_indexer(df, "label_text", "label").transform(df).select("k", "label")


@query(
    "index_to_label",
    f"""WITH {FEATURES_SQL}, {_DICTIONARY_SQL.format(column='label_text', source='feat')}
      SELECT k, CAST(idx AS DOUBLE) AS label, v AS label_back FROM feat JOIN dictionary ON v = label_text""",
)
def index_to_label(spark, sf_dir):
    df = features(spark, sf_dir).select("k", "label_text")
    model = label_indexer(df, "label_text", "label")
    back = IndexToString(inputCol="label", outputCol="label_back", labels=model.labels)
    return variants.apply_stages(df, [model, back]).select("k", "label", "label_back")


@query(
    "ordinal_index",
    f"""WITH {FEATURES_SQL} SELECT k, CAST(CASE priority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2
      WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 ELSE 5 END AS DOUBLE) AS priority_order FROM feat""",
)
def ordinal_index(spark, sf_dir):
    order = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
    df = features(spark, sf_dir).select("k", "priority")
    return ordinal_indexer(order, "priority", "priority_order").transform(df).select("k", "priority_order")


@query(
    "rare_to_other",
    """WITH c AS (SELECT source, count(*) AS n, sum(count(*)) OVER () AS total FROM documents WHERE source IS NOT NULL GROUP BY 1)
      SELECT CASE WHEN n >= 0.05 * total THEN source ELSE 'other' END AS source_group, CAST(sum(n) AS BIGINT) AS docs
      FROM c GROUP BY 1""",
)
def rare_to_other_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source")
    grouped = rare_to_other(docs.filter("source IS NOT NULL"), "source", "source_group", 0.05)
    return grouped.groupBy("source_group").agg(F.count("*").alias("docs"))


# ---- standard scores ----------------------------------------------------------------------


def _scored(df: DataFrame, out: str = "score") -> DataFrame:
    score = F.col(out)
    return df.select("k", F.isnan(score).alias("missing"), r6(present_or_null(score)).alias("score"))


@query(
    "standard_score_keep",
    f"""WITH {FEATURES_SQL} SELECT k, price0 IS NULL AS missing, round((price0 - mu) / sd, 6) + 0.0 AS score FROM clean, mom""",
)
def standard_score_keep(spark, sf_dir):
    df = features(spark, sf_dir)
    s = _price_stats(df)
    stage = NumericNormalizer(inputCol="price", outputCol="score", handleInvalid="keep", mean=s.mean, stdDev=s.std_dev)
    return _scored(stage.transform(df))


@query(
    "standard_score_skip",
    f"""WITH {FEATURES_SQL} SELECT k, false AS missing, round((price0 - mu) / sd, 6) + 0.0 AS score
      FROM clean, mom WHERE price0 IS NOT NULL""",
)
def standard_score_skip(spark, sf_dir):
    df = features(spark, sf_dir)
    s = _price_stats(df)
    stage = NumericNormalizer(inputCol="price", outputCol="score", handleInvalid="skip", mean=s.mean, stdDev=s.std_dev)
    return _scored(stage.transform(df))


@query(
    "standard_score_replace",
    f"""WITH {FEATURES_SQL} SELECT k, false AS missing, round(coalesce((price0 - mu) / sd, 0), 6) + 0.0 AS score FROM clean, mom""",
)
def standard_score_replace(spark, sf_dir):
    df = features(spark, sf_dir)
    s = _price_stats(df)
    stage = NumericNormalizerWithReplacement(inputCol="price", outputCol="score", mean=s.mean, stdDev=s.std_dev)
    return _scored(stage.transform(df))


# ---- vectors ------------------------------------------------------------------------------


def _entries(df: DataFrame, values) -> DataFrame:
    """Long form of an array of doubles: key, position, missing flag, value."""
    return df.select("k", F.posexplode(values).alias("position", "v")).select(
        "k", "position", F.isnan("v").alias("missing"), r6(present_or_null(F.col("v"))).alias("value")
    )


def _dense_sql(where: str) -> str:
    return f"""WITH {FEATURES_SQL}, long AS (
      SELECT k, 0 AS position, price0 AS v FROM clean WHERE {where} UNION ALL
      SELECT k, 1, cust FROM clean WHERE {where} UNION ALL SELECT k, 2, b FROM clean WHERE {where})
      SELECT k, position, v IS NULL AS missing, round(v, 6) + 0.0 AS value FROM long"""


@query("dense_assemble_skip", _dense_sql("price0 IS NOT NULL AND cust IS NOT NULL"))
def dense_assemble_skip(spark, sf_dir):
    df = assembler(["price", "cust", "b"], "features", "skip").transform(features(spark, sf_dir))
    return _entries(df, dense_array(F.col("features"), 0.0))


@query("dense_assemble_keep", _dense_sql("true"))
def dense_assemble_keep(spark, sf_dir):
    df = assembler(["price", "cust", "b"], "features", "keep").transform(features(spark, sf_dir))
    return _entries(df, dense_array(F.col("features"), 0.0))


@query("sparse_assemble", f"SELECT k, position, value FROM ({_dense_sql('true')}) WHERE NOT missing")
def sparse_assemble(spark, sf_dir):
    stage = SparseVectorAssembler(inputCols=["price", "cust", "b"], outputCol="features")
    parts = vector_parts(F.col("features"))
    df = stage.transform(features(spark, sf_dir).select("k", "price", "cust", "b"))
    pairs = F.arrays_zip(parts["indices"].alias("position"), parts["values"].alias("value"))
    return df.select("k", F.inline(pairs)).select("k", "position", r6(F.col("value")).alias("value"))


@query("sparse_to_dense", _dense_sql("true"))
def sparse_to_dense(spark, sf_dir):
    """Absent entries come back as missing, not as zero."""
    stage = SparseVectorAssembler(inputCols=["price", "cust", "b"], outputCol="features")
    df = stage.transform(features(spark, sf_dir).select("k", "price", "cust", "b"))
    return _entries(df, dense_array(F.col("features")))


@query(
    "vector_density",
    f"""WITH {FEATURES_SQL}, n AS (SELECT k, (b % 2 <> 0)::INT + (b % 3 <> 0)::INT + (b % 5 <> 0)::INT + (b % 7 <> 0)::INT
        + (cust IS NULL OR cust % 4 <> 0)::INT AS nonzeros FROM feat)
      SELECT k, CASE WHEN 1.5 * nonzeros + 2 < 5 THEN nonzeros ELSE 5 END AS stored, 1.5 * nonzeros + 2 < 5 AS is_sparse FROM n""",
)
def vector_density(spark, sf_dir):
    parts = vector_parts(F.col("features"))
    df = features(spark, sf_dir).select(
        "k", *[(F.col("b") % m).alias(f"r{m}") for m in (2, 3, 5, 7)], (F.col("cust") % 4).alias("c4")
    )
    df = assembler(["r2", "r3", "r5", "r7", "c4"], "features", "keep").transform(df)
    return df.select("k", F.size(parts["values"]).alias("stored"), (parts["type"] == 0).alias("is_sparse"))


# ---- scores and curves --------------------------------------------------------------------


def _formula_scores(spark, sf_dir) -> DataFrame:
    share = F.floor(F.col("o_totalprice") / 1000) / 1000.0
    key = F.col("o_orderkey")
    high = F.col("o_totalprice") + 3 * F.col("o_custkey") + 2000 * md5_bucket(key) > 300000
    return table(spark, sf_dir, "orders").select(
        key.alias("k"),
        high.cast("double").alias("label"),
        array_to_vector(F.array(1 - share, share)).alias("probability"),
    )


_SCORES_SQL = f"""{_HASHED}, scored AS (SELECT o_orderkey AS k, floor(o_totalprice / 1000) / 1000.0::DOUBLE AS score,
   CASE WHEN o_totalprice + 3 * o_custkey + 2000 * b0 > 300000 THEN 1 ELSE 0 END AS label FROM hashed)"""
_AUC_SQL = """(SELECT (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0)
      / (sum(label) * (count(*) - sum(label))) FROM (
        SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored))"""


@query(
    "score_pick",
    f"WITH {_SCORES_SQL} SELECT k, round(1 - score, 6) + 0.0 AS score_0, round(score, 6) + 0.0 AS score_1 FROM scored",
)
def score_pick(spark, sf_dir):
    vector = F.col("probability")
    return _formula_scores(spark, sf_dir).select(
        "k", r6(vector_element(vector, 0)).alias("score_0"), r6(vector_element(vector, 1)).alias("score_1")
    )


@query(
    "auc_exact",
    f"""WITH {_SCORES_SQL} SELECT CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
      round({_AUC_SQL}, 9) AS auc, round(1 - {_AUC_SQL}, 9) AS auc_of_class_0 FROM scored""",
)
def auc_exact(spark, sf_dir):
    df = _formula_scores(spark, sf_dir).select("label", class_score().alias("s1"))
    return area_under_roc(df, "s1", "label").select(
        "positives", "negatives", F.round("auc", 9).alias("auc"), F.round("auc_reversed", 9).alias("auc_of_class_0")
    )


@query(
    "roc_points",
    f"""WITH {_SCORES_SQL}, g AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM scored GROUP BY 1),
      c AS (SELECT score, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp,
        sum(p) OVER () AS pos, sum(n) OVER () AS neg FROM g)
      SELECT round(score, 6) + 0.0 AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
        round(tp / pos, 9) AS tpr, round(fp / neg, 9) AS fpr FROM c""",
)
def roc_points_query(spark, sf_dir):
    df = _formula_scores(spark, sf_dir).select("label", class_score().alias("s"))
    return roc_points(df, "s", "label").select(
        r6(F.col("score")).alias("score"), "tp", "fp", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr")
    )


# ---- boosted trees ------------------------------------------------------------------------

# Cut points given to both engines, so that the trees can be compared line by line.
BOOST_CUTS = [
    [31250.0 * i for i in range(1, 16)],
    [100.0 * i for i in range(1, 15)],
    [10.0 * i for i in range(1, 10)],
]
BOOST_ROUNDS, BOOST_DEPTH = 2, 2
_TRAIN_SQL = f"{FEATURES_SQL}, train AS (SELECT k, price0 AS x0, cust AS x1, b AS x2, CASE WHEN label_text = 'high' THEN 1 ELSE 0 END AS y FROM clean WHERE label_text IS NOT NULL)"


def _train(spark, sf_dir) -> DataFrame:
    return (
        features(spark, sf_dir)
        .filter(F.col("label_text").isNotNull())
        .select("k", "price", "cust", "b", (F.col("label_text") == "high").cast("double").alias("label"))
    )


def _first_round(spark, sf_dir) -> DataFrame:
    names = ["price", "cust", "b"]
    rows = bin_columns(_train(spark, sf_dir).withColumn("price", present_or_null(F.col("price"))), names, BOOST_CUTS)
    rows = entry_arrays(rows, names)
    scale = 2.0**30
    histogram = gradient_histogram(
        rows.selectExpr(
            "1 AS class",
            "1 AS node",
            f"CAST((0.5D - label) * {scale!r}D AS BIGINT) AS g",
            f"CAST(0.5D * {scale!r}D AS BIGINT) AS h",
            "positions",
            "bins",
        )
    )
    return split_candidates(histogram, scale, 1.0, 0.0, 1.0).filter("feature >= 0")


@query("split_gain_table", f"WITH {_TRAIN_SQL}, {first_round_sql(BOOST_CUTS)} SELECT feature, bin, default_left, round(gain, 6) + 0.0 AS gain FROM candidates_1_0 WHERE bin >= 0")
def split_gain_table(spark, sf_dir):
    return _first_round(spark, sf_dir).select("feature", "bin", "default_left", r6(F.col("gain")).alias("gain"))


@query("best_split", f"WITH {_TRAIN_SQL}, {first_round_sql(BOOST_CUTS)} SELECT feature, bin, default_left, round(gain, 6) + 0.0 AS gain FROM best_1_0")
def best_split(spark, sf_dir):
    return best_splits(_first_round(spark, sf_dir)).select("feature", "bin", "default_left", r6(F.col("gain")).alias("gain"))


def _boosted(spark, sf_dir) -> tuple[DataFrame, BoostedTreeModel]:
    train = _train(spark, sf_dir)
    trainer = BoostedTreeClassifier(
        inputCols=["price", "cust", "b"],
        numRound=BOOST_ROUNDS,
        maxDepth=BOOST_DEPTH,
        cutPoints=json.dumps(BOOST_CUTS),
    )
    return train, trainer.fit(train)


_BOOST_SQL = f"WITH {_TRAIN_SQL}, {boosted_sql(BOOST_CUTS, BOOST_ROUNDS, BOOST_DEPTH)}"


@query(
    "boost_trees",
    f"{_BOOST_SQL} SELECT round, node, feature, bin, default_left, round(gain, 5) + 0.0 AS gain FROM trees",
)
def boost_trees(spark, sf_dir):
    _, model = _boosted(spark, sf_dir)
    return model.tree_table(spark).filter("feature IS NOT NULL").select(
        "round", "node", "feature", "bin", "default_left", (F.round("gain", 5) + F.lit(0.0)).alias("gain")
    )


@query(
    "boost_predict",
    f"""{_BOOST_SQL} SELECT k, round(1 / (1 + exp(-2 * m)), 6) + 0.0 AS probability_1,
      CASE WHEN m > -m THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM state_{BOOST_ROUNDS + 1}""",
)
def boost_predict(spark, sf_dir):
    train, model = _boosted(spark, sf_dir)
    return model.transform(train).select("k", r6(class_score()).alias("probability_1"), "prediction")


@query(
    "feature_gain",
    f"{_BOOST_SQL} SELECT feature, round(sum(gain), 5) + 0.0 AS gain, count(*) AS splits FROM trees GROUP BY 1",
)
def feature_gain(spark, sf_dir):
    _, model = _boosted(spark, sf_dir)
    return model.feature_gain(spark).select("feature", (F.round("gain", 5) + F.lit(0.0)).alias("gain"), "splits")


QUERY_ROUNDS = 3
ORDER_ROLES = variants.Roles(["priority", "status"], ["price", "cust", "b"], "label_text")
_KEPT = {
    "drop_missing": "label_text IS NOT NULL AND price0 IS NOT NULL AND cust IS NOT NULL",
    "scaled_drop": "label_text IS NOT NULL AND price0 IS NOT NULL AND cust IS NOT NULL",
    "scaled_keep": "label_text IS NOT NULL",
    "imputed": "label_text IS NOT NULL",
    "sparse": "label_text IS NOT NULL",
}


def _variant(variant: str, trainer=None):
    def run(spark, sf_dir):
        data = features(spark, sf_dir)
        training, test = hash_split(data, "k", [80, 20])
        chosen = trainer() if trainer else variants.default_trainer(variant, {"num_round": QUERY_ROUNDS})
        model = variants.fit(variant, training, ORDER_ROLES, labelled=data, trainer=chosen, text_out="predicted_label")
        scored = model.transform(test).select("label", "label_text", "predicted_label", class_score().alias("score"))
        auc = area_under_roc(scored, "score", "label").first()["auc"]
        return scored.agg(
            F.count("*").alias("rows_scored"),
            F.count_if(F.col("predicted_label").isin("high", "low")).alias("rows_labelled"),
            F.lit(auc > 0.9).alias("auc_above_0_9"),
            (F.count_if(F.col("predicted_label") == F.col("label_text")) > 0.8 * F.count("*")).alias("mostly_right"),
        )

    return run


for _name, _kept in _KEPT.items():
    query(
        f"model_{_name}",
        f"""WITH {FEATURES_SQL} SELECT count(*) AS rows_scored, count(*) AS rows_labelled, true AS auc_above_0_9,
          true AS mostly_right FROM clean WHERE {_bucket_sql('k', 'split')} >= 80 AND {_kept}""",
    )(_variant(_name))
query("gbt_predict", ORACLES["model_drop_missing"])(
    _variant("drop_missing", lambda: plain_boosted_trees(maxIter=QUERY_ROUNDS))
)


# ---- further transforms -------------------------------------------------------------------


@query(
    "outlier_filter",
    """SELECT c_custkey, c_acctbal FROM customer, (SELECT avg(c_acctbal) AS mu, stddev_samp(c_acctbal) AS sd FROM customer)
      WHERE c_acctbal BETWEEN mu - 1.5 * sd AND mu + 1.5 * sd""",
)
def outlier_filter(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return within_bounds(customer, zscore_bounds(customer, ["c_acctbal"], 1.5), keep_missing=False)


@query("interaction", f"WITH {FEATURES_SQL} SELECT k, round(price0 * cust, 2) + 0.0 AS product FROM clean")
def interaction(spark, sf_dir):
    return features(spark, sf_dir).select("k", (F.round(interact(F.col("price"), F.col("cust")), 2) + F.lit(0.0)).alias("product"))


@query(
    "math_transform",
    """SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END, 6) + 0.0 AS log_value,
      round(exp(c_acctbal / 10000), 6) + 0.0 AS exp_value, round(c_acctbal * c_acctbal, 4) + 0.0 AS square_value,
      round(sin(c_acctbal), 6) + 0.0 AS sin_value FROM customer""",
)
def math_transform(spark, sf_dir):
    c = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        r6(apply_function(c, "log")).alias("log_value"),
        r6(apply_function(c / 10000, "exp")).alias("exp_value"),
        (F.round(apply_function(c, "square"), 4) + F.lit(0.0)).alias("square_value"),
        r6(apply_function(c, "sin")).alias("sin_value"),
    )


# ---- flagship -----------------------------------------------------------------------------


@query(
    "prepared_features",
    f"""WITH {FEATURES_SQL}, {_DICTIONARY_SQL.format(column='priority', source='feat')}
      SELECT k, CAST(coalesce(idx, (SELECT count(*) FROM dictionary)) AS DOUBLE) AS priority_index,
        round(coalesce((price0 - mu) / sd, 0), 6) + 0.0 AS price_norm, round(coalesce((cust - mu_c) / sd_c, 0), 6) + 0.0 AS cust_norm
      FROM clean CROSS JOIN mom LEFT JOIN dictionary ON v = priority""",
)
def prepared_features(spark, sf_dir):
    """Index and standardise in two fits: the preparation half of the imputing variant."""
    from gapwise.operators.scale import StandardScore

    df = features(spark, sf_dir).select("k", "priority", "price", "cust")
    stages = [
        CategoryIndexer(inputCols=["priority"], outputCols=["priority_index"]).fit(df),
        StandardScore(
            inputCols=["price", "cust"], outputCols=["price_norm", "cust_norm"], replacementValue=0.0
        ).fit(df),
    ]
    return variants.apply_stages(df, stages).select(
        "k", "priority_index", r6(F.col("price_norm")).alias("price_norm"), r6(F.col("cust_norm")).alias("cust_norm")
    )
