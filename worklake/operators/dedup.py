"""First-wins de-duplication (fetch-time M1 and batch M2).

``row_number() over (partition by key order by _src, _pos) = 1`` — Spark
plans this with a partial ``WindowGroupLimit`` before the shuffle, so each map
task already keeps only its first row per key: a key with millions of copies
sends one row per task across the network, never the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklake.operators.flatten import REJECT, flatten
from worklake.schema import KEY, ORDER_COLUMNS

RANK = "_rank"


def first_wins(df: DataFrame, key: str | list[str], order: tuple[str, ...] = ORDER_COLUMNS,
               keep_rank: bool = False) -> DataFrame:
    """Keep the first row per ``key`` in ``order`` (deterministic, unlike dropDuplicates)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order])
    out = df.withColumn(RANK, F.row_number().over(w)).filter(F.col(RANK) == 1)
    return out if keep_rank else out.drop(RANK)


def _own_group() -> Column:
    """A partition value unique to the row (its source position); always used
    together with a flag column, so it cannot collide with a real key."""
    return F.concat_ws("#", *[F.col(c).cast("string") for c in ORDER_COLUMNS])


def fetch_dedup(raw: DataFrame) -> DataFrame:
    """M1: de-duplicate raw works on the *full* raw id, before any validation.

    Records without an id (NULL or '') are all kept (rejected later): each is
    ranked in a group of its own, so one pass serves both kinds of rows.
    """
    has_id = F.coalesce(F.col("id") != "", F.lit(False))
    keyed = raw.withColumns({"_has_id": has_id,
                             "_fetch_key": F.when(has_id, F.col("id")).otherwise(_own_group())})
    return first_wins(keyed, ["_has_id", "_fetch_key"]).drop("_has_id", "_fetch_key")


def fetch_duplicates_skipped(raw: DataFrame) -> DataFrame:
    """Number of raw records M1 drops (one-row DataFrame)."""
    has_id = F.coalesce(F.col("id") != "", F.lit(False))
    return raw.filter(has_id).agg(
        (F.count(F.lit(1)) - F.count_distinct("id")).alias("duplicates_skipped"))


def batch_dedup(flat: DataFrame) -> DataFrame:
    """M2: first *valid* row per short id; rejected rows never shadow valid ones."""
    valid = flat.filter(F.col(REJECT).isNull()).drop(REJECT)
    return first_wins(valid, KEY)


def prepare_rows(raw: DataFrame) -> DataFrame:
    """Flatten + reject + M2, tagging every raw row with its fate.

    Output keeps all rows with ``state`` in {accepted, invalid, duplicate};
    rejected rows are ranked in groups of their own (one pass, no union).
    """
    flat = flatten(raw)
    valid = F.col(REJECT).isNull()
    group = F.when(valid, F.col(KEY)).otherwise(_own_group())
    w = Window.partitionBy(valid, group).orderBy(*[F.col(c).asc() for c in ORDER_COLUMNS])
    return (flat.withColumn(RANK, F.row_number().over(w))
            .withColumn("state", F.when(~valid, "invalid")
                        .when(F.col(RANK) == 1, "accepted").otherwise("duplicate"))
            .drop(RANK))


def ingest_counters(raw: DataFrame) -> DataFrame:
    """(papers, upserted, skipped_invalid, duplicates_in_file) in one shuffle.

    Rows are counted per (key, valid) with a partial aggregate before the
    exchange (a key with many copies is combined map-side), then one small
    global aggregate: duplicates = valid rows − distinct valid keys, so no
    per-row ranking is needed just to count.
    """
    return counters_of_flat(flatten(raw))


def counters_of_flat(flat: DataFrame) -> DataFrame:
    """A13 over already flattened rows (with ``reject_reason``)."""
    valid = F.col(REJECT).isNull()
    per_key = (flat.select(F.when(valid, F.col(KEY)).alias("k"), valid.alias("v"))
               .groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")))
    return per_key.agg(
        F.sum("n").alias("papers"),
        F.count_if(F.col("v")).alias("upserted"),
        F.coalesce(F.sum(F.when(~F.col("v"), F.col("n"))), F.lit(0)).alias("skipped_invalid"),
        (F.coalesce(F.sum(F.when(F.col("v"), F.col("n"))), F.lit(0))
         - F.count_if(F.col("v"))).alias("duplicates_in_file"),
    )
