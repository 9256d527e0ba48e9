"""Binding: derive raw nested works from the driver's TPC-H-like tables.

One work per order (``k = o_orderkey``). The nested shape is really built —
structs, an ``authorships`` array with one entry per line item — and then goes
through ``flatten`` like any exported record would. Dirt is planted on purpose
so every reject rule and every data-quality check has something to find.

Fixed values (planted dirt, by order key k):
  id NULL if k%211=0; short id 'X<k>' instead of 'W<k>' if k%223=0
  title NULL if k%101=0; display_name NULL if k%303=0
  publication_date NULL if k%307=0; publication_year one too high if k%97=0
  primary topic name NULL if k%53=0; source name NULL if k%31=0
  countries_distinct_count one too high if k%89=0; cited_by_count -1 if k%113=0
  top-10% flag NULL if k%7=0
  title '' if k%103=0; topic id with a trailing '/' if k%61=0; whole location NULL if k%59=0
  fwci too large for its column if k%401=0; no updated date if k%37=0
  works with k%19=0 are delivered twice (the copy later, title + ' (dup)')
Fixed values (mapping): order priority 1→gold 2→green 3→hybrid 4→NULL 5→closed;
  open access = status is not 'O'; top 1% = price > 480000; top 10% = price > 450000;
  fwci = floor(price/10)/10000; percentile = floor(price/2)/200000; topic score = (k%1000)/1000;
  type by k%4, language by nation; retracted if k%29=0, full text if k%2=0; core source if k%3=0,
  unknown if k%3=1; counts of references, institutions, locations = k%50, k%9, k%5 (each NULL if 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklake.operators.joins import broadcast_if_small
from worklake.schema import WORK_SCHEMA

ID_BASE = "https://openalex.org/"
DOI_BASE = "https://doi.org/10.5555/"
SUBFIELD_BASE = "https://openalex.org/subfields/"
DUP_EVERY = 19

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


# The driver's tables are read-only: one scan definition per application and
# path is reused (saves the file listing and footer read per query build).
_tables: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    from worklake.session import session_key

    key = (session_key(spark), path)
    if key not in _tables:
        _tables[key] = spark.read.parquet(path)
    return _tables[key]


def _copies(key: str) -> str:
    """One row per record of an order: 0, and 1 for a planted copy."""
    return f"explode(CASE WHEN {key} % {DUP_EVERY} = 0 THEN array(0, 1) ELSE array(0) END)"


def authorships_by_order(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """Per order: authorships (one per line item, country = supplier nation),
    total quantity and number of distinct countries.

    Line items are dealt by order once, as three numbers, and sorted there with their
    nations' names. Suppliers are joined as a plain scan, whose size the optimizer knows (that of a
    join it overrates, and line items would be dealt by supplier as well):
    the list of an order is read off in passing, and the join with the orders finds
    its layout and order. A hot supplier is no group here; a hot order's line items
    meet in one task, as smaller rows than the one record they become.

    With ``files`` there is a list per record (``l_copy``), dealt by order and copy to so many partitions.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    sup = broadcast_if_small(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
    nat = broadcast_if_small(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    lines = li.join(sup, li.l_suppkey == sup.s_suppkey).select("l_orderkey", "s_nationkey", "l_quantity")
    by = ["l_orderkey"]
    if files:
        lines, by = lines.selectExpr("*", f"{_copies('l_orderkey')} AS l_copy"), [*by, "l_copy"]
    lines = (
        (lines.repartition(files, *by) if files else lines.repartition(*by))
        .join(nat, F.col("s_nationkey") == nat.n_nationkey).select(*by, "n_name", "l_quantity")
        .sortWithinPartitions(*by, "n_name")
    )
    # A struct holds a missing name, which a list of names would leave out.
    per_order = lines.groupBy(*by).agg(
        F.collect_list(F.struct(F.array("n_name").alias("countries"))).alias("authorships"),
        F.sum("l_quantity").alias("qty"),
    )
    return per_order.select(
        *by,
        "authorships",
        F.col("qty").cast("int").alias("qty"),
        F.size(F.array_distinct(F.flatten("authorships.countries"))).alias("n_countries"),
    )


def _work_fields() -> list[str]:
    """Raw work fields as SQL expressions over the joined order row.

    ``k`` = order key, ``_copy`` = 1 for a planted copy. One ``selectExpr``
    builds the whole nested record (parsed once on the JVM side).
    """
    ks = "CAST(k AS STRING)"
    price = "o_totalprice"
    return [
        f"CASE WHEN k % 211 = 0 THEN NULL WHEN k % 223 = 0 THEN concat('{ID_BASE}X', {ks}) "
        f"ELSE concat('{ID_BASE}W', {ks}) END AS id",
        f"concat('{DOI_BASE}', {ks}) AS doi",
        f"CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN '' ELSE concat(c_name, ' / ', {ks}, "
        f"CASE WHEN _copy = 1 THEN ' (dup)' ELSE '' END) END AS title",
        f"CASE WHEN k % 303 <> 0 THEN concat('Order ', {ks}) END AS display_name",
        "CASE WHEN k % 307 <> 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') END AS publication_date",
        "year(o_orderdate) + CASE WHEN k % 97 = 0 THEN 1 ELSE 0 END AS publication_year",
        "element_at(array('article', 'review', 'preprint', 'dataset'), CAST(k % 4 AS INT) + 1) AS type",
        "CASE WHEN n_nationkey % 5 <> 0 THEN concat('l', CAST(n_nationkey AS STRING)) END AS language",
        "k % 29 = 0 AS is_retracted",
        "CASE WHEN k % 5 <> 0 THEN k % 2 = 0 END AS has_fulltext",
        "named_struct('is_oa', o_orderstatus <> 'O', "
        "'oa_status', CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'gold' WHEN '2' THEN 'green' "
        "WHEN '3' THEN 'hybrid' WHEN '5' THEN 'closed' END, "
        f"'oa_url', CASE WHEN o_orderstatus = 'F' THEN concat('https://oa.example.org/', {ks}) END) AS open_access",
        f"CASE WHEN k % 59 <> 0 THEN named_struct('landing_page_url', concat('https://example.org/', {ks}), 'source', named_struct("
        f"'id', concat('{ID_BASE}S', CAST(c_custkey AS STRING)), "
        "'display_name', CASE WHEN k % 31 <> 0 THEN c_name END, 'type', CASE WHEN c_custkey % 2 = 0 THEN 'journal' ELSE 'repository' END, "
        "'host_organization_name', r_name, 'is_core', CASE k % 3 WHEN 0 THEN true WHEN 2 THEN false END)) END AS primary_location",
        f"named_struct('id', concat('{ID_BASE}T', CAST(n_nationkey AS STRING), CASE WHEN k % 61 = 0 THEN '/' ELSE '' END), "
        "'display_name', CASE WHEN k % 53 <> 0 THEN n_name END, 'score', CAST((k % 1000) / 1000 AS DOUBLE), "
        f"'subfield', named_struct('id', concat('{SUBFIELD_BASE}', c_mktsegment), 'display_name', c_mktsegment), "
        "'field', named_struct('display_name', r_name), "
        "'domain', CASE WHEN n_nationkey % 2 = 0 THEN named_struct('display_name', concat('Domain ', r_name)) END) AS primary_topic",
        f"named_struct('value', floor({price} / 2) / 200000, 'is_in_top_1_percent', {price} > 480000, "
        f"'is_in_top_10_percent', CASE WHEN k % 7 <> 0 THEN {price} > 450000 END) "
        "AS citation_normalized_percentile",
        "authorships",
        "CASE WHEN k % 113 = 0 THEN -1 ELSE qty END AS cited_by_count",
        f"CASE WHEN k % 401 = 0 THEN 1e7 ELSE CAST(floor({price} / 10) / 10000 AS DOUBLE) END AS fwci",
        "CAST(nullif(k % 50, 0) AS INT) AS referenced_works_count",
        "coalesce(n_countries, 0) + CASE WHEN k % 89 = 0 THEN 1 ELSE 0 END AS countries_distinct_count",
        "CAST(nullif(k % 9, 0) AS INT) AS institutions_distinct_count",
        "CAST(nullif(k % 5, 0) AS INT) AS locations_count",
        "CASE WHEN k % 37 <> 0 THEN date_format(o_orderdate, \"yyyy-MM-dd'T12:30:00'\") END AS updated_date",
    ]


def works_from_testdata(spark: SparkSession, sf_dir: str, with_copies: bool = True, files: int | None = None) -> DataFrame:
    """Raw works (WORK_SCHEMA columns) plus first-wins order ``_src``, ``_pos``.

    Originals come from source ``part-0`` at position k; planted copies from
    ``part-1``, so every copy is later than its original.

    With ``files`` they are dealt by their place to so many partitions, so that copies lie apart: the
    tables' rows are, before they become works, which are several times as large.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    geo = broadcast_if_small(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
        .join(broadcast_if_small(table(spark, sf_dir, "region").select("r_regionkey", "r_name")),
              F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name"))
    per_order = authorships_by_order(spark, sf_dir, files if with_copies else None)
    # Names of nations and regions are added behind the shuffle.
    sold = orders.join(customer, orders.o_custkey == customer.c_custkey)
    same = F.col("o_orderkey") == F.col("l_orderkey")
    if files and with_copies:
        sold = sold.selectExpr("*", f"{_copies('o_orderkey')} AS _copy").repartition(files, "o_orderkey", "_copy")
        same = same & (F.col("_copy") == F.col("l_copy"))
    base = (
        sold.join(per_order, same, "left")
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("k", F.col("o_orderkey"))
    )
    # Each order yields one record, or two for the planted copies; a generator
    # in the same projection, so the joined plan is computed once.
    works = base if "_copy" in base.columns else base.selectExpr("*", f"{_copies('k') if with_copies else 0} AS _copy")
    return works.selectExpr("concat('part-', CAST(_copy AS STRING)) AS _src", "k AS _pos",
                            *_work_fields())
