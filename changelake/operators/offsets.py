"""Coverage of a topic's offsets by landed records (S1, T1, T2): ranges, gaps, repeats, committed offset.

Offsets are merged to ranges inside buckets of ``width`` offsets first, so a
partition with a third of all records is many tasks' work; the ranges of the
buckets, a row for each and each gap, are merged across buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTITION = ("topic", "partition")


def offset_ranges(records: DataFrame, width: int = 1 << 20) -> DataFrame:
    """``records(topic, partition, offset)`` -> ``topic, partition, lo, hi, n_records, n_repeated``: the longest ranges of
    offsets that were all landed, the records in each, and those of them that came again.

    A NULL topic is a topic; rows with a NULL partition or offset are left out."""
    rows = records.select(*PARTITION, F.col("offset").cast("long").alias("offset")).where("partition is not null and offset is not null")
    rows = rows.withColumn("bucket", F.expr(f"offset div {width}")).repartition(*PARTITION, "bucket")
    each = rows.groupBy(*PARTITION, "bucket", "offset").agg(F.count(F.lit(1)).alias("n"))
    # in a range, offset less row number stays the same
    nth = F.row_number().over(Window.partitionBy(*PARTITION, "bucket").orderBy("offset"))
    inside = each.withColumn("run", F.col("offset") - nth).groupBy(*PARTITION, "bucket", "run").agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.sum("n").alias("n"))
    return merge_ranges(inside.select(*PARTITION, "lo", "hi", "n"))


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges ``topic, partition, lo, hi, n`` (``n``: records in it), which may touch or overlap -> disjoint ones.

    Kept ranges of earlier landings and new ones merge to those of all."""
    order = Window.partitionBy(*PARTITION).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.withColumn("fresh", F.coalesce((F.col("lo") > reach + 1).cast("int"), F.lit(1)))
    joint = opened.withColumn("range", F.sum("fresh").over(order))
    return joint.groupBy(*PARTITION, "range").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n_records")).select(
        *PARTITION, "lo", "hi", "n_records", (F.col("n_records") - (F.col("hi") - F.col("lo") + 1)).alias("n_repeated"))


def offset_gaps(ranges: DataFrame, begin: int | None = None) -> DataFrame:
    """``topic, partition, lo, hi`` of the offsets missing between the ranges (and from ``begin`` to the first of them)."""
    order = Window.partitionBy(*PARTITION).orderBy("lo")
    before = F.lag("hi", 1).over(order)
    start = before if begin is None else F.coalesce(before, F.lit(begin - 1).cast("long"))
    return (ranges.withColumn("before", start).where(F.col("lo") > F.col("before") + 1)
            .select(*PARTITION, (F.col("before") + 1).alias("lo"), (F.col("lo") - 1).alias("hi")))


def committed_offsets(ranges: DataFrame, begin: int | None = None) -> DataFrame:
    """``topic, partition, committed``: the first offset up to which nothing is missing; with ``begin`` a partition
    whose first range starts later has committed ``begin`` only."""
    first = ranges.groupBy(*PARTITION).agg(F.min(F.struct("lo", "hi")).alias("r"))
    upto = F.col("r.hi") + 1
    if begin is not None:
        upto = F.when(F.col("r.lo") <= begin, upto).otherwise(F.lit(begin).cast("long"))
    return first.select(*PARTITION, upto.alias("committed"))
