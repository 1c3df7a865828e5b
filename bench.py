"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "missing_profile",
    "column_stats",
    "trimmed_stats",
    "category_dictionary",
    "category_index_keep",
    "category_index_table",
    "standard_score_replace",
    "prepared_features",
    "dense_assemble_keep",
    "sparse_assemble",
    "auc_exact",
    "best_split",
    "boost_predict",
]


def boosted_rounds(spark: SparkSession, rounds: int, plain: bool) -> None:
    from pyspark.ml.feature import VectorAssembler

    from gapwise.operators.boost import BoostedTreeClassifier, plain_boosted_trees
    from gapwise.operators.split import hash_split
    from gapwise.plans.queries import features

    df = features(spark, SF_DIR).filter("label_text IS NOT NULL")
    columns = ["price", "cust", "b"]
    df = df.select(
        "k",
        (F.col("label_text") == "high").cast("double").alias("label"),
        *[F.coalesce(F.nanvl(c, F.lit(None)), F.lit(0.0)).alias(c) for c in columns],
    )
    train, test = hash_split(df, "k", [80, 20])
    if plain:
        assembler = VectorAssembler(inputCols=columns, outputCol="features")
        model = plain_boosted_trees(maxIter=rounds).fit(assembler.transform(train))
        scored = model.transform(assembler.transform(test))
    else:
        scored = BoostedTreeClassifier(inputCols=columns, numRound=rounds).fit(train).transform(test)
    scored.agg(F.count_if(F.col("prediction") == F.col("label"))).first()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("gapwise-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from gapwise.plans.queries import QUERIES

    jobs = {name: (lambda q=QUERIES[name]: q(spark, SF_DIR).write.format("noop").mode("overwrite").save()) for name in HEADLINE}
    jobs["boosted_10_rounds"] = lambda: boosted_rounds(spark, 10, plain=False)
    jobs["plain_trees_10_rounds"] = lambda: boosted_rounds(spark, 10, plain=True)
    jobs["missing_profile"]()  # start the JVM's warm-up outside the clock
    seconds = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": SF_DIR}))
    spark.stop()


if __name__ == "__main__":
    main()
