"""Quality of scores and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.running import running_sum


def rmse(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), F.lit(2)))).alias("rmse"))


def threshold_counts(df: DataFrame, score: str, label: str, steps: int = 100, strict: bool = False) -> DataFrame:
    """Confusion counts at the thresholds 0/steps .. steps/steps.

    Each row is put once into the bucket of the highest threshold it reaches;
    the counts of all thresholds are sums over at most ``steps + 2`` buckets.
    ``strict`` counts ``score > t`` as positive, else ``score >= t``.
    """
    # Decimal arithmetic: a score that equals a threshold must hit it exactly.
    scaled = F.col(score).cast("decimal(18,12)") * steps
    reached = (F.ceil(scaled) - 1) if strict else F.floor(scaled)
    # -1: below every threshold
    reached = F.greatest(F.least(reached, F.lit(steps)), F.lit(-1)).cast("int")
    buckets = df.filter(F.col(score).isNotNull()).groupBy(reached.alias("_b")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")
    )
    marks = df.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("_b"))
    full = marks.join(buckets, "_b", "left").na.fill(0)
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("_b"))
    every = Window.partitionBy(F.lit(0))
    got = full.select(
        "_b", F.sum("_p").over(down).alias("tp"), F.sum("_n").over(down).alias("fp"),
        F.sum("_p").over(every).alias("_pos"), F.sum("_n").over(every).alias("_neg"),
    ).filter("_b >= 0")
    return got.select(
        F.col("_b").alias("t"), "tp", "fp",
        (F.col("_pos") - F.col("tp")).alias("fn"), (F.col("_neg") - F.col("fp")).alias("tn"),
        F.try_divide("tp", "_pos").alias("tpr"), F.try_divide("fp", "_neg").alias("fpr"),
    )


def accuracy_by_threshold(df: DataFrame, score: str, label: str, steps: int, strict: bool = False) -> DataFrame:
    counts = threshold_counts(df, score, label, steps, strict)
    right = F.col("tp") + F.col("tn")
    return counts.select("t", F.try_divide(right, right + F.col("fp") + F.col("fn")).alias("accuracy"))


def auc(df: DataFrame, score: str, label: str, chunk: Column) -> DataFrame:
    """Area under the ROC curve from rank sums, tied scores sharing their mean rank.

    Rows are counted per score first; ``chunk`` is a monotone function of the
    score.  Rows without a score or a label take no part, as in ``threshold_counts``.
    """
    counts = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(score).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(label) == 1).alias("_p")
    )
    got = running_sum(counts, [], chunk, [F.col(score)], F.col("_n"), "_upto")
    rank = F.col("_upto") - (F.col("_n") - 1) / 2
    sums = got.agg(
        F.sum(rank * F.col("_p")).alias("r"), F.sum("_p").cast("double").alias("p"),
        F.sum(F.col("_n") - F.col("_p")).cast("double").alias("n"),
    )
    area = F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * F.col("n"))
    return sums.select(area.alias("auc"), F.col("p").cast("long").alias("n_pos"), F.col("n").cast("long").alias("n_neg"))
