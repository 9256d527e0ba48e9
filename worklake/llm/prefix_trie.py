"""Prefix trie of conversations by whole-sequence collapse.

1. ``rebuild``: a conversation takes its first turns from another one and
   continues with its own. Turns are reduced to a 128-bit digest and their bytes
   before the first shuffle; texts are read once and never sent.
2. ``prefix_keys``: a prefix is known by its depth and two 64-bit sums over
   hashes of (place, turn).
3. ``prefix_nodes``: identical rebuilt conversations collapse into one weighted
   sequence with the list of their ids; sequences that are proper prefixes of others are dropped by
   an anti-join, which leaves the leaves; the prefixes of one conversation per
   sequence, with its weight, are then aggregated to nodes. A node's saving is put on the
   sequence of its smallest member, summed from its end towards the root, and added up per prefix.

Hot keys. A conversation of any length is cut at range partitions: ``running`` sums
within a partition and adds what the partitions before hold (at most two rows
a partition, broadcast). Prefixes that very many conversations share are
aggregated before the shuffle. Ids of one sequence are joined to one string per range
partition, and those strings are streamed through the digest. Parents with more
than a ten-thousandth of all nodes as children (at most 10,000 of them) are broadcast to
them, all others meet theirs by a shuffle.

Defined results: turns are ordered by turn (null first), ties by their digest;
null roles and texts are empty; rows that repeat a turn are turns of their own; rows with
a null id belong to no conversation; a conversation without turns is a member of the root alone; an
empty table gives no rows, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from worklake.llm.common import small_batches, stage
from worklake.session import unstage

KEY = ["depth", "s1", "s2"]
SUM = "decimal(30,0)"
#: Parents with more children than this part of all nodes are broadcast.
HOT_PARENTS = 10_000
#: Most turns that ``rebuild`` takes over.
MOST_TAKEN = 8


def ranged(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``df`` in range partitions by keys and order, written; ``part`` is the partition's number.

    The last criterion is a running number, so that rows that are all alike are
    spread over several partitions, too.
    """
    spread = F.xxhash64(F.monotonically_increasing_id())
    return stage(df.repartitionByRange(*[F.col(k) for k in keys], *order, spread)
                 .withColumn("part", F.spark_partition_id()), name)


def running(rows: DataFrame, keys: list[str], order: list[Column], values: dict[str, Column], types: dict[str, str],
            backwards: bool = False) -> DataFrame:
    """``rows`` of ``ranged`` with the sum of each value over the key's rows up to and with this one in ``order``.

    ``backwards`` says that ``order`` runs against the partitions' numbers.
    """
    mine = W.partitionBy("part", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = rows.groupBy("part", *keys).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    number = F.col("part").desc() if backwards else F.col("part")
    earlier = W.partitionBy(*keys).orderBy(number).rowsBetween(W.unboundedPreceding, -1)
    carried = (parts.withColumn("parts", F.count(F.lit(1)).over(W.partitionBy(*keys))).where("parts > 1")
               .select("part", *keys, *[F.sum(n).over(earlier).alias(f"{n}_carried") for n in values]))
    here = rows.select("*", *[F.sum(v).over(mine).alias(n) for n, v in values.items()])
    joined = here.join(F.broadcast(carried), ["part", *keys], "left")
    return joined.select(*rows.columns, *[
        (F.col(n) + F.coalesce(F.col(f"{n}_carried"), F.lit(0))).cast(types[n]).alias(n) for n in values])


def rebuild(turns: DataFrame, base: Column, taken: Column, id_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns of the rebuilt conversations, one row per conversation with its length).

    ``base`` and ``taken`` are columns over ``conv_id``: a conversation begins
    with the first ``taken`` (at most ``MOST_TAKEN``) turns of conversation ``base`` and goes on with its own behind its first ``taken``.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    given = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                         F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit("second"), text, role).alias("t2"),
                         F.octet_length(text).cast("long").alias("bytes")).where("conv_id IS NOT NULL")
    order = [F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")]
    spread = ranged(given, ["conv_id"], order, "turns")
    placed = stage(running(spread, ["conv_id"], order, {"pos": F.lit(1).cast("long")}, {"pos": "long"})
                   .withColumn("taken", taken.cast("long")), "placed")
    unstage(spread)

    convs = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.first("taken").alias("taken")).withColumn("base", base.cast("long"))
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    head = F.least("taken", F.coalesce("n_base", F.lit(0).cast("long")))
    convs = stage(convs.join(sizes, "base", "left").withColumn("head", head).select(
        "conv_id", "base", "taken", "head", (F.col("head") + F.greatest(F.col("n") - F.col("taken"), F.lit(0))).alias("length")), "convs")

    first = (placed.where(F.col("pos") <= MOST_TAKEN).groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "t1", "t2", "bytes"))).alias("turns")))
    heads = (convs.where("head > 0").join(first, "base")
             .select("conv_id", "length", F.explode(F.slice("turns", F.lit(1), F.col("head").cast("int"))).alias("t"))
             .select("conv_id", "length", F.col("t.pos").alias("depth"), "t.t1", "t.t2", "t.bytes"))
    # Per partition one row of each conversation in it: a long one is joined partition by partition.
    near = placed.select("part", "conv_id").distinct().join(convs.select("conv_id", "head", "length"), "conv_id")
    tails = (placed.where("pos > taken").join(near, ["part", "conv_id"])
             .select("conv_id", "length", (F.col("head") + F.col("pos") - F.col("taken")).alias("depth"), "t1", "t2", "bytes"))
    return heads.unionByName(tails), convs.select("conv_id", "length")


def prefix_keys(rebuilt: DataFrame) -> DataFrame:
    """The rebuilt turns with the key of the prefix that they end and the hashes by which it differs from its parent's."""
    hashed = rebuilt.select("conv_id", "length", "depth", "bytes", F.xxhash64("depth", "t1", "t2").alias("h1"),
                            F.xxhash64(F.lit("second"), "t2", "depth", "t1").alias("h2"))
    spread = ranged(hashed, ["conv_id"], [F.col("depth")], "rebuilt")
    wide = {n: F.col(h).cast("decimal(20,0)") for n, h in (("s1", "h1"), ("s2", "h2"))}
    keyed = stage(running(spread, ["conv_id"], [F.col("depth")], wide, {"s1": SUM, "s2": SUM}), "prefixes")
    unstage(spread)
    return keyed


def end_lists(full: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of each sequence, comma-joined."""
    spread = ranged(full, KEY, [F.col("conv_id")], "ends")
    pieces = (spread.groupBy("part", *KEY).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
              .repartition(*KEY).sortWithinPartitions(*KEY, "part").select(*KEY, "ids"))

    def run(batches):
        import pyarrow as pa

        def rows(done):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in done], pa.int64()), *[pa.array([r[k] for r in done], pa.decimal128(30, 0)) for k in (1, 2)],
                 pa.array([r[3] for r in done], pa.string())], [*KEY, "ends_sha256"])

        key, digest = None, None
        for batch in batches:
            done = []
            for now, ids in zip(zip(*[batch.column(k).to_pylist() for k in range(3)]), batch.column(3).to_pylist()):
                if now == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = now, hashlib.sha256()
                digest.update(ids.encode())
            yield rows(done)
        if key is not None:
            yield rows([(*key, digest.hexdigest())])

    return small_batches(pieces).mapInArrow(run, f"depth long, s1 {SUM}, s2 {SUM}, ends_sha256 string")


def prefix_nodes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included."""
    zero = [F.lit(0).cast("long").alias("depth"), F.lit(0).cast(SUM).alias("s1"), F.lit(0).cast(SUM).alias("s2")]
    full = prefixes.where("depth = length").select("conv_id", *KEY).unionByName(
        convs.where("length = 0").select("conv_id", *zero))
    sequences = stage(full.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")
    proper = prefixes.where("depth < length").select(*KEY).unionByName(
        prefixes.where("depth = 1").select(*zero)).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    weighted = stage(sequences.join(leaves, "conv_id", "left").select(
        "conv_id", "weight", F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf")), "weighted")

    near = prefixes.select("part", "conv_id").distinct().join(weighted, "conv_id")
    standing = stage(prefixes.join(near, ["part", "conv_id"]), "standing")
    sums = [F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("leaf").alias("n_leaves")]
    inner = standing.groupBy(*KEY).agg(*sums, F.max("bytes").alias("bytes"), F.max("h1").alias("h1"), F.max("h2").alias("h2"))
    root = weighted.agg(*sums).where("n_convs > 0").select(
        *zero, *["n_convs", "conv_id", "n_leaves"], *[F.lit(0).cast("long").alias(c) for c in ("bytes", "h1", "h2")])
    nodes = stage(inner.unionByName(root).select(
        *KEY, "n_convs", "conv_id", "n_leaves", ((F.col("n_convs") - 1) * F.col("bytes")).alias("own"),
        (F.col("depth") - 1).alias("p_depth"), (F.col("s1") - F.col("h1")).cast(SUM).alias("p_s1"),
        (F.col("s2") - F.col("h2")).cast(SUM).alias("p_s2")), "nodes")

    # (conv_id, depth) names a node: its saving goes to that place of its smallest member's sequence.
    own = standing.select("part", "conv_id", *KEY).join(nodes.where("depth > 0").select("conv_id", "depth", "own"), ["conv_id", "depth"], "left")
    below = running(own, ["conv_id"], [F.col("depth").desc()], {"saved": F.coalesce("own", F.lit(0).cast("long"))}, {"saved": "long"}, backwards=True)
    saved = below.groupBy(*KEY).agg(F.sum("saved").alias("saved")).unionByName(
        nodes.agg(F.sum("own").alias("saved")).where("saved IS NOT NULL").select(*zero, "saved"))

    up = {"p_depth": "depth", "p_s1": "s1", "p_s2": "s2"}
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children")).withColumnsRenamed(up)
    whole = (nodes.join(saved, KEY, "left").join(children, KEY, "left").join(end_lists(full), KEY, "left"))
    whole = stage(whole.select(
        *KEY, *up, "conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
        F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")), "whole")

    parent = whole.select(*[F.col(c).alias(p) for p, c in up.items()], F.col("conv_id").alias("parent_conv_id"), "n_children")
    many = F.col("n_children") > max(1, whole.count() // HOT_PARENTS)
    hot = parent.where(many).drop("n_children")
    tried = whole.where("depth > 0").join(F.broadcast(hot), list(up), "left")
    rest = tried.where("parent_conv_id IS NULL").drop("parent_conv_id").join(parent.where(~many).drop("n_children"), list(up))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return (tried.where("parent_conv_id IS NOT NULL").select(*out).unionByName(rest.select(*out)).unionByName(
        whole.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*out)))


def conversation_trie(turns: DataFrame, base: Column, taken: Column, **columns: str) -> DataFrame:
    """The nodes of the trie of the conversations that ``rebuild`` gives."""
    rebuilt, convs = rebuild(turns, base, taken, **columns)
    return prefix_nodes(prefix_keys(rebuilt), convs)
