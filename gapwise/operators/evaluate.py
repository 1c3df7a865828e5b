"""ROC points and the exact area under the curve, with no sort of the data in one place.

Scores are grouped first, so a score shared by a third of all rows is one line from then
on. The distinct scores are sorted into ranges across tasks and written once, so that every
line keeps its range; each range is a window of its own, and ranges are tied together by
their totals, one line per range. Ranges only decide which task does what: the result is
exact for any of them. The scored frame is evaluated once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.functions.missing import is_missing
from gapwise.functions.vectors import vector_element
from gapwise.scratch import Scratch


def class_score(probability: str = "probability", class_index: int = 1) -> Column:
    """The score of one class. 1 is the positive class; element 0 would turn the curve over."""
    return vector_element(F.col(probability), class_index)


def _ranges(df: DataFrame, score: str, label: str, ranges: int | None) -> DataFrame:
    """``range, score, pos, neg`` per distinct score."""
    pairs = df.select(F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("label"))
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gone = is_missing(F.col("score")) | is_missing(F.col("label"))
    positive = F.col("label") > 0.5
    by_score = pairs.groupBy("score").agg(
        F.count_if(gone).alias("missing"), F.count_if(positive & ~gone).alias("pos"), F.count_if(~positive & ~gone).alias("neg")
    )
    ranged = by_score.repartitionByRange(ranges, "score").withColumn("range", F.spark_partition_id())
    written, _ = Scratch(df.sparkSession).write(ranged)
    missing = written.agg(F.sum("missing")).first()[0]
    if missing:
        raise ValueError(f"{missing} rows have a missing score or label and cannot be ranked")
    return written


def _running_totals(totals: DataFrame) -> DataFrame:
    """Add to each range the totals above it and over all. There is one line per range, at
    most ``ranges`` lines whatever the data, so one window over all of them is small.
    """
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return totals.select(
        "range",
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("neg_above"),
        F.sum("pos").over(every).alias("positives"),
        F.sum("neg").over(every).alias("negatives"),
    )


def roc_points(df: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """``score, tp, fp, tpr, fpr`` at every distinct score; counts cover that score and those above."""
    by_score = _ranges(df, score, label, ranges)
    totals = _running_totals(by_score.groupBy("range").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    down = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = by_score.select(
        "range", "score", F.sum("pos").over(down).alias("tp_in"), F.sum("neg").over(down).alias("fp_in")
    )
    # totals has one line per range, and there are at most `ranges` of them
    return ranked.join(F.broadcast(totals), "range").select(
        "score",
        (F.col("tp_in") + F.col("pos_above")).alias("tp"),
        (F.col("fp_in") + F.col("neg_above")).alias("fp"),
        F.try_divide(F.col("tp_in") + F.col("pos_above"), F.col("positives")).alias("tpr"),
        F.try_divide(F.col("fp_in") + F.col("neg_above"), F.col("negatives")).alias("fpr"),
    )


def area_under_roc(df: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """One line ``positives, negatives, auc, auc_reversed``: the share of (positive, negative)
    pairs ranked the right way round, ties counting half, and the share with the scores turned
    over, as by the other class's probability. Null if a class is absent.
    """
    by_score = _ranges(df, score, label, ranges)
    below = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("pos") * (F.coalesce(F.sum("neg").over(below), F.lit(0)) + F.col("neg") / 2.0)
    per_range = (
        by_score.select("range", "pos", "neg", won.alias("won"))
        .groupBy("range")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    )
    listed = per_range.agg(F.array_sort(F.collect_list(F.struct("range", "pos", "neg", "won"))).alias("t"))
    zero = F.lit(0).cast("bigint")
    total = F.aggregate(
        "t",
        F.struct(zero.alias("pos"), zero.alias("neg"), F.lit(0.0).alias("won")),
        lambda a, x: F.struct(
            (a["pos"] + x["pos"]).alias("pos"),
            (a["neg"] + x["neg"]).alias("neg"),
            (a["won"] + x["won"] + x["pos"].cast("double") * a["neg"]).alias("won"),
        ),
    )
    pairs = F.col("r.pos").cast("double") * F.col("r.neg")
    return listed.select(total.alias("r")).select(
        F.col("r.pos").alias("positives"),
        F.col("r.neg").alias("negatives"),
        F.try_divide(F.col("r.won"), pairs).alias("auc"),
        F.try_divide(pairs - F.col("r.won"), pairs).alias("auc_reversed"),
    )
