"""Join of points with intervals by day buckets, without a nested loop.

Days are grouped into buckets of 1, 2, 4, ... days. An interval of n days is the
union of at most 2 log2(n) such buckets (``cover``), and a day lies in one bucket
of each size, so that "the day lies in the interval" becomes an equality
of (size, bucket): a shuffle join that any number of intervals of any length
may enter. Facts are counted per day first; what meets the intervals is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bucket sizes 2^0 to 2^22 days: intervals up to 11,000 years.
LEVELS = 23


def cover(first: Column, last: Column) -> Column:
    """The fewest buckets that make up the days from ``first`` to ``last`` (day numbers): array<struct<level, bucket>>."""
    def bucket(level, number):
        return F.array(F.struct(level.cast("int").alias("level"), number.cast("long").alias("bucket")))

    def step(state, level):
        lo, hi, none = state["lo"], state["hi"], F.array().cast("array<struct<level: int, bucket: bigint>>")
        top = level == LEVELS - 1
        open_ = lo < hi
        left = open_ & ((lo.bitwiseAND(F.lit(1)) == 1) | top)
        after = F.when(left, lo + 1).otherwise(lo)
        right = (after < hi) & ((hi.bitwiseAND(F.lit(1)) == 1) | top)
        end = F.when(right, hi - 1).otherwise(hi)
        found = F.concat(state["out"], F.when(left, bucket(level, lo)).otherwise(none),
                         F.when(right, bucket(level, hi - 1)).otherwise(none))
        return F.struct(F.shiftright(after, 1).alias("lo"), F.shiftright(end, 1).alias("hi"), found.alias("out"))

    start = F.struct(first.cast("long").alias("lo"), (last.cast("long") + 1).alias("hi"),
                     F.array().cast("array<struct<level: int, bucket: bigint>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), start, step, lambda s: s["out"])


def counts_by_bucket(facts: DataFrame, date_col: str) -> DataFrame:
    """(level, bucket, n): facts in each bucket that holds any; null dates are in none."""
    days = (facts.where(F.col(date_col).isNotNull()).groupBy(F.unix_date(date_col).cast("long").alias("day"))
            .agg(F.count(F.lit(1)).alias("n")))
    levels = days.select("n", "day", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
    return (levels.groupBy("level", F.expr("shiftright(day, level)").alias("bucket")).agg(F.sum("n").alias("n")))


def count_in_windows(facts: DataFrame, windows: DataFrame, date_col: str, key: str, first: str, last: str) -> DataFrame:
    """(key, n): how many facts lie in each window, both ends included.

    ``key`` names one row of ``windows``. A window without an end, or that ends
    before it begins, holds nothing.
    """
    covered = windows.select(key, F.explode_outer(cover(F.unix_date(first), F.unix_date(last))).alias("c"))
    counts = counts_by_bucket(facts, date_col)
    return (covered.select(key, "c.level", "c.bucket").join(counts, ["level", "bucket"], "left")
            .groupBy(key).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")))
