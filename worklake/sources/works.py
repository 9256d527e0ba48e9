"""Raw works I/O: JSON Lines landing folders and export envelopes.

* ``read_works``   S1 — JSON Lines landing folder. Every line is parsed whole
  (``from_json`` on the line, scalar leaves as text), so that the record's
  verdict is the same whatever columns a query selects; malformed lines are
  kept in ``_corrupt_record``.
* ``read_export``  S3 — envelope documents (one JSON object per file with a
  ``papers`` array), split by ``sources.envelopes``; each paper's own text is
  parsed exactly as a landing line, with its place in the array for the first-wins order.
* ``write_export`` S4 — papers as JSON Lines (parallel write) plus a one-row
  manifest with the envelope header; the papers are never gathered into one
  document or one task.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklake.schema import ENVELOPE_SCHEMA, ORDER_COLUMNS, RAW_SCHEMA, WORK_SCHEMA
from worklake.sources.envelopes import pieces

CORRUPT = "_corrupt_record"
LANDING_SCHEMA = T.StructType(
    [T.StructField("_src", T.StringType()), T.StructField("_pos", T.LongType())]
    + RAW_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
#: The part of a record that names its subfield.
SUBFIELD_SCHEMA = T.StructType([T.StructField("primary_topic", T.StructType([T.StructField(
    "subfield", RAW_SCHEMA["primary_topic"].dataType["subfield"].dataType)]))])
#: How JSON lines are written: packed, as lightly as gzip does.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

MANIFEST_SCHEMA = T.StructType([
    T.StructField("fetched_at", T.StringType()),
    T.StructField("filters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("subfield", T.StructType([T.StructField("id", T.StringType()),
                                           T.StructField("display_name", T.StringType())])),
    T.StructField("date_range", T.StructType([T.StructField("from", T.StringType()),
                                             T.StructField("to", T.StringType())])),
    T.StructField("count", T.LongType()),
    T.StructField("duplicates_skipped", T.LongType()),
])


def parse_line(line: Column, schema: T.StructType = LANDING_SCHEMA) -> Column:
    return F.from_json(line, schema, _PERMISSIVE)


def works_of_lines(lines: DataFrame, *carried: str) -> DataFrame:
    """Raw works of rows with ``value`` (a JSON record), ``_file`` and ``_row`` (its place), and the carried columns."""
    parsed = lines.where(F.trim("value") != "").select("_file", "_row", *carried, parse_line(F.col("value")).alias("w"))
    return parsed.select(F.coalesce("w._src", "_file").alias("_src"), F.coalesce("w._pos", "_row").alias("_pos"),
                         *carried, *[F.col(f"w.{c}").alias(c) for c in (*RAW_SCHEMA.fieldNames(), CORRUPT)])


#: Folder column of a parted landing: the publication month, or ``OTHER_MONTH`` without a valid date.
MONTH, OTHER_MONTH = "published", "none"


def write_landing(works: DataFrame, folder: str) -> None:
    """Works as JSON Lines in one folder per publication month, which ``read_window`` prunes."""
    order = [c for c in ORDER_COLUMNS if c in works.columns]
    month = F.date_format(F.try_to_date(F.col("publication_date"), "yyyy-MM-dd"), "yyyy-MM")
    (works.select(json_line(works, order + WORK_SCHEMA.fieldNames()).alias("value"), F.coalesce(month, F.lit(OTHER_MONTH)).alias(MONTH))
     .write.partitionBy(MONTH).mode("overwrite").options(**PACKED).text(folder))


def read_window(spark: SparkSession, path: str, subfield_id: str, from_date, to_date) -> DataFrame:
    """S1 + F6: the works of one subfield in an inclusive date window, parsing as little as possible.

    Month folders outside the window aren't opened, if the landing has any. Lines without the
    last segment of the subfield's id in their text (nor an escaped character, which may hide it) can't match
    and are dropped before the JSON parse; the records that remain are filtered as ``source_filter`` does.
    """
    lines = spark.read.text(path)
    if MONTH in lines.columns:
        first, last = (F.date_format(F.lit(d).cast("date"), "yyyy-MM") for d in (from_date, to_date))
        lines = lines.where(F.col(MONTH).cast("string").between(first, last))
    tail = subfield_id.rstrip("/").split("/")[-1]
    lines = lines.where(F.col("value").contains(tail) | F.col("value").contains("\\u"))
    works = works_of_lines(lines.select("value", F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_row")))
    return source_filter(works, subfield_id, from_date, to_date)


def read_works(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON Lines works with first-wins order columns.

    Files written by ``write_export`` carry ``_src``/``_pos``; for other
    files the order falls back to (file name, row position within the file).
    """
    paths = [path] if isinstance(path, str) else path
    return works_of_lines(spark.read.text(paths).select(
        "value", F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_row")))


def read_envelopes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The envelopes' own fields, one row per document, with the file name as ``_src``.

    ``papers`` is empty: its records are ``read_export``'s. A path that the
    session's file systems don't have is an error of the read.
    """
    _, around = pieces(spark, path)
    return around.select(F.col("file").alias("_src"), parse_line(F.col("text"), ENVELOPE_SCHEMA).alias("e")).select("_src", "e.*")


class EnvelopeError(ValueError):
    """An envelope that is no JSON object of the expected shape."""


def check_envelopes(envelopes: DataFrame) -> None:
    bad = [r["_src"] for r in envelopes.where(F.col(CORRUPT).isNotNull()).select("_src").limit(5).collect()]
    if bad:
        raise EnvelopeError("unreadable export envelope(s): " + ", ".join(bad))


def read_export(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S3: the works of the envelopes' ``papers``; a paper's place is its place in the array."""
    elements, _ = pieces(spark, path)
    return works_of_lines(elements.select(F.col("text").alias("value"), F.col("file").alias("_file"), F.col("place").alias("_row")))


def write_export(works: DataFrame, out_dir: str, header: dict,
                 duplicates_skipped: int | None = None) -> str:
    """Write ``works`` under ``out_dir/run=<YYYYmmdd_HHMMSS>/`` and return the folder.

    ``header`` holds ``fetched_at``, ``subfield`` {id, display_name} and
    ``date_range`` {from, to}; ``count`` is filled from the data.
    """
    stamp = header.get("stamp") or dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    folder = f"{out_dir.rstrip('/')}/run={stamp}"
    order = [c for c in ORDER_COLUMNS if c in works.columns]
    counted = Observation("export")
    # Counted while it is written: the works are computed once.
    (works.select(json_line(works, order + WORK_SCHEMA.fieldNames()).alias("value"))
     .observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").options(**PACKED).text(f"{folder}/papers"))
    spark = works.sparkSession
    subfield, window = header.get("subfield") or {}, header.get("date_range") or {}
    manifest = {
        "fetched_at": header.get("fetched_at"),
        "filters": {
            "primary_topic.subfield.id": subfield.get("id"),
            "from_publication_date": window.get("from"),
            "to_publication_date": window.get("to"),
        },
        "subfield": header.get("subfield"),
        "date_range": header.get("date_range"),
        "count": counted.get["n"],
        "duplicates_skipped": duplicates_skipped or 0,
    }
    (spark.createDataFrame([json.dumps(manifest, ensure_ascii=False)], "string")
     .coalesce(1).write.mode("overwrite").text(f"{folder}/manifest"))
    return folder


def _leaves(kind: T.DataType, wanted: type) -> set[str]:
    if isinstance(kind, T.ArrayType):
        return _leaves(kind.elementType, wanted)
    if not isinstance(kind, T.StructType):
        return set()
    return set().union(*[{f.name} if isinstance(f.dataType, wanted) else _leaves(f.dataType, wanted) for f in kind.fields])


def json_line(works: DataFrame, columns: list[str]) -> Column:
    """The works' JSON line. Text leaves that are a number or boolean, where the schema has
    one, are written as such; any other text stays text, so that reading the line back
    gives the same verdict. (Quotes inside a value are escaped and never match.)
    Only leaves that are text in ``works`` are looked for.
    """
    line = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    text = _leaves(T.StructType([works.schema[c] for c in columns]), T.StringType)
    numbers = "|".join(sorted(_leaves(WORK_SCHEMA, T.NumericType) & text))
    flags = "|".join(sorted(_leaves(WORK_SCHEMA, T.BooleanType) & text))
    if numbers:
        line = F.regexp_replace(line, f'"({numbers})":"(-?(?:0|[1-9][0-9]*)(?:\\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)"', '"$1":$2')
    return F.regexp_replace(line, f'"({flags})":"(true|false)"', '"$1":$2') if flags else line


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{folder.rstrip('/')}/manifest")


def read_export_folder(spark: SparkSession, folder: str) -> DataFrame:
    return read_works(spark, f"{folder.rstrip('/')}/papers")


def subfields(raw: DataFrame) -> DataFrame:
    """Subfield dimension (id, display_name) as seen in the raw works."""
    return (raw.select(F.col("primary_topic.subfield.id").alias("id"),
                       F.col("primary_topic.subfield.display_name").alias("display_name"))
            .filter(F.col("id").isNotNull()).distinct())


def landed_subfields(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``subfields`` of a landing, without reading the other fields' values from its lines."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return subfields(lines.select(parse_line(F.col("value"), SUBFIELD_SCHEMA).alias("w")).select("w.*"))


class SubfieldLookupError(RuntimeError):
    """The searched subfield isn't in the dimension; ``similar`` names some that contain the term."""

    def __init__(self, term: str, similar: list[str]) -> None:
        self.term, self.similar = term, similar
        known = ", ".join(repr(s) for s in similar) if similar else "none"
        super().__init__(f"subfield {term!r} is unknown; names that contain it: {known}")


def lookup_subfield(dim: DataFrame, term: str) -> DataFrame:
    """The rows whose name equals ``term`` without regard to case, over the whole dimension."""
    return dim.filter(F.lower("display_name") == F.lower(F.lit(term))).select("id", "display_name")


def resolve_subfield(dim: DataFrame, term: str, similar: int = 5) -> dict:
    """``lookup_subfield`` on the driver: the match with the smallest id, or an error that names
    up to ``similar`` subfields containing the term."""
    found = lookup_subfield(dim, term).orderBy("id").first()
    if found is not None:
        return found.asDict()
    names = (dim.filter(F.lower("display_name").contains(F.lower(F.lit(term))))
             .select("display_name").distinct().orderBy("display_name").limit(similar).collect())
    raise SubfieldLookupError(term, [r[0] for r in names])


def source_filter(raw: DataFrame, subfield_id: str, from_date, to_date) -> DataFrame:
    """works of one subfield (nested id equality) in an inclusive date window."""
    d = F.try_to_date(F.col("publication_date"), "yyyy-MM-dd")
    return raw.filter((F.col("primary_topic.subfield.id") == F.lit(subfield_id))
                      & d.between(F.lit(from_date).cast("date"), F.lit(to_date).cast("date")))


def select_recent(raw: DataFrame, subfield_id: str, from_date, to_date) -> DataFrame:
    """S1 + T6: the source query, newest publication first (order only at output)."""
    return source_filter(raw, subfield_id, from_date, to_date).orderBy(
        F.desc("publication_date"), *[F.asc(c) for c in ORDER_COLUMNS if c in raw.columns])
