"""Exact order statistics that never gather the values of a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Histogram steps per power of two, and steps inside one histogram bucket.
_COARSE, _FINE = 64, 65536


def exact_median(df: DataFrame, value: str, out: str) -> DataFrame:
    """One row with the exact median of a numeric column (mean of the two middle values).

    A histogram over the exponent of the value (a fixed number of buckets) finds the bucket of the
    middle ranks; two finer histograms, each between the least and the greatest value of what is
    left, narrow it down; only the distinct values of the last slice are counted and put in order.
    Each step scans the column again and shuffles no more than the buckets of each task.
    """
    v = F.col(value).cast("double")
    counts = df.where(v.isNotNull()).select(v.alias("__v"), F.lit(1).cast("long").alias("__c"))
    exponent = F.floor(F.log2(F.abs("__v")) * _COARSE) + 100 * 1000
    rows = counts.withColumn("__s", F.when(F.col("__v") == 0, F.lit(0).cast("long")).otherwise(F.signum("__v").cast("long") * exponent))
    everything = Window.partitionBy(F.lit(1))

    def middle(steps: DataFrame, order: str) -> DataFrame:
        """The steps that hold a middle rank; `__first` becomes the number of values before each."""
        upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = steps.withColumn("__upto", F.col("__first") + F.sum("__c").over(upto))
        held = ranked.where((F.col("__upto") > F.col("__r1")) & (F.col("__upto") - F.col("__c") <= F.col("__r2")))
        return held.withColumn("__first", F.col("__upto") - F.col("__c"))

    edges = [F.sum("__c").alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")]
    steps = rows.groupBy("__s").agg(*edges).withColumn("__n", F.sum("__c").over(everything)).select(
        "__s", "__c", "__lo", "__hi", F.lit(0).cast("long").alias("__first"),
        F.expr("(__n - 1) div 2").alias("__r1"), F.expr("__n div 2").alias("__r2"),
    )
    key = ["__s"]
    for _finer in range(2):
        # At most two steps hold the two middle ranks, so the broadcast is tiny. Steps are disjoint,
        # so the least value names a step and gives its place in the order.
        kept = middle(steps, "__lo").select(*key, F.col("__lo").alias("__from"), "__hi", "__first", "__r1", "__r2")
        rows = rows.join(F.broadcast(kept), key).drop(*key).withColumn(
            "__s", F.when(F.col("__hi") > F.col("__from"), F.floor((F.col("__v") - F.col("__from")) / (F.col("__hi") - F.col("__from")) * _FINE)).otherwise(0)
        ).withColumnRenamed("__from", "__step")
        key = ["__step", "__s"]
        steps = rows.groupBy(*key, "__r1", "__r2").agg(*edges, F.min("__first").alias("__first"))
        steps = steps.withColumn("__first", F.min("__first").over(everything))
        rows = rows.select("__v", "__c", *key)
    kept = middle(steps, "__lo").select(*key, "__first", "__r1", "__r2")
    last = rows.join(F.broadcast(kept), key).groupBy("__v", "__r1", "__r2").agg(F.sum("__c").alias("__c"), F.min("__first").alias("__first"))
    last = last.withColumn("__first", F.min("__first").over(everything))
    return middle(last, "__v").agg(((F.min("__v") + F.max("__v")) / 2).alias(out))
