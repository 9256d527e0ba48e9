"""Exact n-gram Jaccard self-join with size-banded tiles and bitmap signatures.

A text's set holds the 64-bit hashes of its distinct word n-grams. Steps:

1. ``frequent``: n-grams that occur in many documents, counted over all of
   them; the table is bounded and only orders n-grams (any order is right).
2. ``signatures``: size, digest of the set and its prefix, the rarest
   n - ceil(t n) + 1 members. Two linked sets share a member of their prefixes.
   Documents with equal sets form a class, of which one represents it.
3. Star round: within a shared n-gram and size band every set is paired with
   the smallest id; of these the one met most often is intersected exactly. Groups of
   copies collapse here into few components, in linear work.
4. Tiles: n-grams whose sets are still in different components, with the same
   smallest id, form one tile per size band (copies share most of their n-grams: one
   tile holds what each of them would hold again). Tiles of more than ``TILE`` sets
   are split into pairs of blocks. A hashed bitmap per set bounds the overlap from above:
   |x & y| <= |x| - popcount(bits(x) & ~bits(y)), and the same for y. Pairs of
   different components that stay possible are intersected exactly.
5. Connected components over all links.

Defined results: null, empty and wordless texts have empty sets, linked with
nothing; a text with fewer words than n has its whole sequence as its one
member; equal texts are linked; rows repeated with their id are alike, and an id with
several texts links with what any of them links with (rows are then linked first, and ids by their rows); rows with a null id get a
null component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from worklake.llm.common import fresh, release, small_batches, stage, text_or_empty
from worklake.llm.graph import components

#: Rows of the table of frequent n-grams, and how often one occurs in a task's chunk to be told of.
FREQUENT_ROWS, TOLD, FREQUENT = 1 << 17, 3, 12
#: Sets in one block of a tile.
TILE = 768
#: Up to so many ids (32 MB at 16 bytes) go to the texts; beyond, texts are shuffled to the ids.
SENT_IDS = 2_000_000

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def ngrams(text: str, n: int) -> np.ndarray:
    """Sorted distinct hashes (uint64) of the text's word n-grams; A-Z count as a-z."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(w) for w in words], dtype=np.uint64)
    if len(words) < n:
        out = np.array([len(words)], np.uint64)
        for w in h:
            out = mix(out) + w
        return mix(out + _GOLD)
    count = len(words) - n + 1
    out = h[:count]
    for k in range(1, n):
        out = mix(out) * _GOLD + h[k:k + count]
    return np.unique(mix(out))


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def linked(overlap, a, b, percent: int):
    """Whether 100 * |x & y| >= percent * |x | y|."""
    return 100 * overlap >= percent * (a + b - overlap)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def frequent(texts: DataFrame, n: int, rows: int = FREQUENT_ROWS, least: int = FREQUENT):
    """(sorted hashes, their counts) of the n-grams in at least ``least`` documents, the
    ``rows`` most frequent of them. A task tells of those it met ``TOLD`` times in a chunk."""
    def run(batches):
        import pyarrow as pa

        def told(parts):
            h, c = np.unique(np.concatenate(parts), return_counts=True)
            keep = c >= TOLD
            return pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(c[keep].astype(np.int64))], ["h", "c"])

        parts, held = [], 0
        for batch in batches:
            for t in batch.column(0):
                parts.append(ngrams(t.as_py(), n))
                held += parts[-1].size
                if held > 1_500_000:
                    yield told(parts)
                    parts, held = [], 0
        if parts:
            yield told(parts)

    top = (texts.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
           .where(F.col("c") >= least).orderBy(F.desc("c"), "h").limit(rows).toPandas())
    h = top["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], top["c"].to_numpy(np.int64)[order]


def signatures(texts: DataFrame, n: int, percent: int, common) -> DataFrame:
    """(doc_id, size, digest, prefix) of every document."""
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        import pyarrow as pa
        import xxhash

        known, count = shared.value
        for batch in batches:
            sizes, digests, prefixes = [], [], []
            for t in batch.column(1):
                h = ngrams(t.as_py(), n)
                sizes.append(h.size)
                digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                if not h.size:
                    prefixes.append([])
                    continue
                size = prefix_length(h.size, percent)
                if known.size:
                    at = np.minimum(np.searchsorted(known, h), known.size - 1)
                    common_c = np.where(known[at] == h, count[at], 0)
                    h = h[np.argsort(common_c, kind="stable")[:size]]
                prefixes.append(h[:size].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64()))], ["doc_id", "size", "digest", "prefix"])

    return texts.mapInArrow(run, "doc_id long, size int, digest binary, prefix array<long>")


def band_of(size, percent: int):
    """Size band: sizes of linked sets lie in the same or in neighbouring bands."""
    return F.floor(F.log(size.cast("double")) / math.log(100 / percent) + 1e-9).cast("int")


def set_arrays(texts: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, members as bytes) of the documents named in ``ids`` (column id), with ids' other columns."""
    extra = [c for c in ids.columns if c != "id"]
    ids = stage(ids, "ids")
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    found = texts.join(ids, F.col("doc_id") == F.col("id")).select("id", *extra, "text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [ngrams(t.as_py(), n).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ["id", *extra]] + [pa.array(sets, pa.binary())], ["id", *extra, "members"])

    kinds = dict(ids.dtypes)
    return found.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in ["id", *extra]] + ["members binary"]))


def overlap_size(x: np.ndarray, y: np.ndarray) -> int:
    """Members that two sorted arrays share."""
    if x.size > y.size:
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == y.size] = y.size - 1
    return int((y[at] == x).sum()) if x.size else 0


def verify(texts: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets are linked, by exact sorted-array intersection."""
    left = set_arrays(texts, pairs.select(F.col("a").alias("id"), "b"), n).select(
        F.col("id").alias("a"), "b", F.col("members").alias("x"))
    right = set_arrays(texts, pairs.select(F.col("b").alias("id")).distinct(), n).select(
        F.col("id").alias("r"), F.col("members").alias("y"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                keep.append(linked(overlap_size(x, y), x.size, y.size, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return left.join(right, F.col("b") == F.col("r")).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def bitmap(members: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` (a power of two) as uint64 words, one set per member."""
    out = np.zeros(bits // 8, np.uint8)
    at = (members & np.uint64(bits - 1)).astype(np.int64)
    np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return out.view(np.uint64)


def bits_of_band(band: int, percent: int) -> int:
    """Bits of the bitmaps of a band: two to four per member, alike for a band and its upper neighbour."""
    size = (100 / percent) ** (band + 1)
    return int(min(max(256, 1 << math.ceil(math.log2(2 * size))), 1 << 16))


def possible(bx, sx, by, sy, percent: int) -> np.ndarray:
    """Index pairs (i, j) of rows whose overlap bound still allows a link."""
    out = []
    step = max(1, (1 << 19) // max(1, by.size))
    for at in range(0, len(bx), step):
        x, s = bx[at:at + step, None, :], sx[at:at + step, None]
        bound = np.minimum(s - np.bitwise_count(x & ~by[None]).sum(-1, dtype=np.int64),
                           sy[None] - np.bitwise_count(~x & by[None]).sum(-1, dtype=np.int64))
        i, j = np.nonzero(linked(bound, s, sy[None], percent))
        out.append(np.column_stack([i + at, j]))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


TILE_COLUMNS = ("hub", "band", "part_x", "part_y", "side", "below", "id", "size", "component", "bits")


def compare_tile(table: dict, one_block: bool, percent: int) -> np.ndarray:
    """Possible pairs of one tile: sets of its band with each other, and with those of the band
    below, across its two blocks (``side``) or within its one block."""
    side, size, ids, comp = (np.array(table[c], np.int64) for c in ("side", "size", "id", "component"))
    below = np.array(table["below"], bool)
    bits = np.frombuffer(b"".join(table["bits"]), np.uint64).reshape(len(ids), -1)
    at = lambda s, b: np.flatnonzero((side == s) & (below == b))
    if one_block:
        meets = ((at(0, False), at(0, False)), (at(0, False), at(0, True)))
    else:
        meets = ((at(0, False), at(1, False)), (at(0, False), at(1, True)), (at(1, False), at(0, True)))
    found = [np.zeros((0, 2), np.int64)]
    for k, (x, y) in enumerate(meets):
        if len(x) and len(y):
            p = possible(bits[x], size[x], bits[y], size[y], percent)
            i, j = x[p[:, 0]], y[p[:, 1]]
            ok = comp[i] != comp[j]
            if one_block and not k:
                ok &= i < j
            found.append(np.column_stack([ids[i[ok]], ids[j[ok]]]))
    return np.unique(np.sort(np.concatenate(found), axis=1), axis=0)


def tile_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``TILE_COLUMNS`` rows that the bitmaps leave possible.

    Tiles are read one after the other from sorted partitions; only pairs that may link leave them.
    """
    by = TILE_COLUMNS[:4]

    def run(batches):
        import pyarrow as pa

        held, key = [], None

        def done():
            table = {c: [v for part in held for v in part[c]] for c in TILE_COLUMNS[4:]}
            pairs = compare_tile(table, key[2] == key[3], percent)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, k]) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in TILE_COLUMNS}
            keys = list(zip(*(cols[c] for c in by), strict=True))
            start = 0
            for k in range(1, len(keys) + 1):
                if k == len(keys) or keys[k] != keys[start]:
                    if held and key != keys[start]:
                        yield done()
                        held = []
                    key = keys[start]
                    held.append({c: cols[c][start:k] for c in TILE_COLUMNS[4:]})
                    start = k
        if held:
            yield done()

    return (rows.select(*TILE_COLUMNS).repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(run, "a long, b long").distinct())


def link_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; sets link at ``percent`` Jaccard."""
    spark = docs.sparkSession
    texts = _texts(small_batches(docs), id_col, text_col)
    signed = stage(signatures(texts, n, percent, frequent(texts, n)), "signatures")
    known = signed.where("size > 0 AND doc_id IS NOT NULL")
    if not known.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").isEmpty():
        return _link_ids(docs, n, percent, id_col, text_col, tile)
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = (known.join(classes.select("rep").distinct(), F.col("doc_id") == F.col("rep"), "left_semi")
            .select(F.col("doc_id").alias("id"), "size", "prefix").dropDuplicates(["id"]))
    met = (reps.select("id", "size", F.posexplode("prefix").alias("pos", "token"))
           .withColumn("met", F.count(F.lit(1)).over(W.partitionBy("token"))).where("met > 1").drop("met")
           .withColumn("band", band_of(F.col("size"), percent)))
    met = stage(met, "met")
    release(spark)

    hubs = met.groupBy("token", "band").agg(F.min("id").alias("hub"))
    stars = (met.join(hubs, ["token", "band"]).where("id > hub").groupBy("id", "hub").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("id").agg(F.max(F.struct("n", (-F.col("hub")).alias("less"))).alias("best"))
             .select(F.col("id").alias("a"), (-F.col("best.less")).alias("b")))
    stars = stage(stars, "stars")
    links = stage(verify(texts, stars, n, percent), "links")
    release(spark)
    stars_of = components(links)

    labelled = stage(met.join(stars_of, "id", "left").withColumn("component", F.coalesce("component", "id")), "labelled")
    # A tile holds the sets of its band (home) and of the band below, as far as its n-gram may be the
    # first that they share with a set of the band: what stands before it in the order is then not shared.
    own = F.struct(F.col("band"), F.lit(0).alias("below"))
    least = F.floor(F.pow(F.lit(100 / percent), F.col("band") + 1) * (1 - 1e-8))
    reaches = (100 + percent) * (F.col("size") - F.col("pos")) >= percent * (F.col("size") + least)
    above = F.struct((F.col("band") + 1).alias("band"), F.lit(1).alias("below"))
    spread = labelled.select("token", "id", "size", "component", F.explode(
        F.when(reaches, F.array(own, above)).otherwise(F.array(own))).alias("t")).select(
            "token", "t.band", "t.below", "id", "size", "component")
    open_tiles = (spread.groupBy("token", "band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min("below").alias("home"), F.min("id").alias("hub"))
        .where("low < high AND home = 0").select("token", "band", "hub"))
    # Tiles with one hub are one: a set is in it once, not once per n-gram.
    rows = stage(spread.join(open_tiles, ["token", "band"])
                 .groupBy("hub", "band", "below", "id").agg(F.first("size").alias("size"), F.first("component").alias("component")),
                 "tiles")
    parts = rows.groupBy("hub", "band").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))
    rows = stage(rows.join(parts, ["hub", "band"])
                 .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), "open")
    release(spark)

    def maps_of(batches):
        import pyarrow as pa

        for batch in batches:
            ids, tiles, bits = [], [], []
            for i, wanted, raw in zip(*batch.columns, strict=True):
                h = np.frombuffer(raw.as_buffer(), np.uint64)
                for b in wanted.as_py():
                    ids.append(i.as_py())
                    tiles.append(b)
                    bits.append(bitmap(h, bits_of_band(b, percent)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tiles, pa.int32()),
                                              pa.array(bits, pa.binary())], ["id", "band", "bits"])

    wanted = rows.groupBy("id").agg(F.collect_set("band").alias("bands"))
    maps = (set_arrays(texts, wanted, n).mapInArrow(maps_of, "id long, band int, bits binary")
            .dropDuplicates(["id", "band"]))
    # A set goes to every pair of blocks that its own block is in.
    spots = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.struct(
        F.least(q, F.col("part")).alias("part_x"), F.greatest(q, F.col("part")).alias("part_y"),
        (q < F.col("part")).cast("int").alias("side")))
    placed = (rows.join(maps, ["id", "band"]).withColumn("spot", F.explode(spots))
              .select("hub", "band", "spot.part_x", "spot.part_y", "spot.side", "below", "id", "size",
                      "component", "bits"))
    more = stage(verify(texts, stage(tile_pairs(placed, percent), "possible"), n, percent), "links")
    release(spark)
    labels = components(links.unionByName(more)).withColumnRenamed("id", "rep")
    # Documents of a class carry its representative's component.
    named = signed.select("doc_id", "size", "digest").join(classes, "digest", "left")
    return (named.join(labels, "rep", "left")
            .select("doc_id", F.col("size").cast("long").alias("n_shingles"),
                    F.when((F.col("size") == 0) | F.col("doc_id").isNull(), F.col("doc_id"))
                    .otherwise(F.coalesce("component", "rep")).alias("component_id")))


def _link_ids(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str, tile: int) -> DataFrame:
    """``link_components`` where an id has several texts: rows are linked, then the rows of one id."""
    rows = stage(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                             F.monotonically_increasing_id().alias("row")), "rows")
    linked = (link_components(rows, n, percent, "row", "text", tile)
              .withColumnsRenamed({"doc_id": "row", "component_id": "group"}).join(rows.select("row", "id"), "row"))
    linked = stage(linked, "linked")
    known = linked.where("n_shingles > 0 AND id IS NOT NULL")
    least = known.groupBy("id").agg(F.min("group").alias("least"))
    merged = components(known.join(least, "id").select(F.col("group").alias("a"), F.col("least").alias("b")))
    merged = merged.withColumnsRenamed({"id": "group", "component": "whole"})
    named = linked.join(merged, "group", "left").withColumn("whole", F.coalesce("whole", "group"))
    firsts = named.where("n_shingles > 0").groupBy("whole").agg(F.min("id").alias("first"))
    return named.join(firsts, "whole", "left").select(
        F.col("id").alias("doc_id"), "n_shingles",
        F.when((F.col("n_shingles") == 0) | F.col("id").isNull(), F.col("id")).otherwise(F.col("first")).alias("component_id"))


def keep_first(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row of each component, all columns: that with the smallest id, null last.

    Of rows that repeat a document with its id one stays, and rows without an id are linked like
    others: if there are any, rows are numbered and linked instead of ids. Rows with an empty set all stay.
    """
    number = F.col(id_col).cast("long")
    if docs.groupBy(number.alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR id IS NULL").isEmpty():
        key = fresh("copy_id", docs)
        gone = (link_components(docs, n, percent, id_col, text_col).where("doc_id <> component_id")
                .select(F.col("doc_id").alias(key)))
        return docs.join(gone, number == F.col(key), "left_anti")
    row = fresh("row_number", docs)
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    linked = link_components(rows, n, percent, row, text_col).where("n_shingles > 0").withColumnsRenamed(
        {"doc_id": "row", "component_id": "group"})
    linked = linked.join(rows.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id")), "row")
    linked = stage(linked.select("row", "group", F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("place")), "linked")
    first = linked.groupBy("group").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = linked.join(first, "group").where("place <> first").select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").drop(row)
