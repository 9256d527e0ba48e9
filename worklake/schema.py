"""Schemas: raw nested work, export envelope, stored fact table, run log."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw work record as delivered by the catalogue (only the fields that are read).
SOURCE_STRUCT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("host_organization_name", T.StringType()),
    T.StructField("is_core", T.BooleanType()),
])

WORK_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("publication_date", T.StringType()),
    T.StructField("publication_year", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("is_retracted", T.BooleanType()),
    T.StructField("has_fulltext", T.BooleanType()),
    T.StructField("open_access", T.StructType([
        T.StructField("is_oa", T.BooleanType()),
        T.StructField("oa_status", T.StringType()),
        T.StructField("oa_url", T.StringType()),
    ])),
    T.StructField("primary_location", T.StructType([
        T.StructField("landing_page_url", T.StringType()),
        T.StructField("source", SOURCE_STRUCT),
    ])),
    T.StructField("primary_topic", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("subfield", T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("display_name", T.StringType()),
        ])),
        T.StructField("field", T.StructType([T.StructField("display_name", T.StringType())])),
        T.StructField("domain", T.StructType([T.StructField("display_name", T.StringType())])),
    ])),
    T.StructField("citation_normalized_percentile", T.StructType([
        T.StructField("value", T.DoubleType()),
        T.StructField("is_in_top_1_percent", T.BooleanType()),
        T.StructField("is_in_top_10_percent", T.BooleanType()),
    ])),
    T.StructField("authorships", T.ArrayType(T.StructType([
        T.StructField("countries", T.ArrayType(T.StringType())),
    ]))),
    T.StructField("cited_by_count", T.IntegerType()),
    T.StructField("fwci", T.DoubleType()),
    T.StructField("referenced_works_count", T.IntegerType()),
    T.StructField("countries_distinct_count", T.IntegerType()),
    T.StructField("institutions_distinct_count", T.IntegerType()),
    T.StructField("locations_count", T.IntegerType()),
    T.StructField("updated_date", T.StringType()),
])



def text_leaves(kind: T.DataType) -> T.DataType:
    """The type with every scalar leaf as text, as JSON records are read."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, text_leaves(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(text_leaves(kind.elementType))
    return T.StringType()


# A work as read: whether a value fits its column is decided in ``flatten``, by a
# rule that names the column, not by the parser.
RAW_SCHEMA = text_leaves(WORK_SCHEMA)

# First-wins order carried next to every raw record: source file and position.
ORDER_COLUMNS = ("_src", "_pos")

SUBFIELD_STRUCT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("display_name", T.StringType()),
])

# Export envelope: one JSON document per fetch.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("fetched_at", T.StringType()),
    T.StructField("filters", T.StructType([
        T.StructField("primary_topic.subfield.id", T.StringType()),
        T.StructField("from_publication_date", T.StringType()),
        T.StructField("to_publication_date", T.StringType()),
    ])),
    T.StructField("subfield", SUBFIELD_STRUCT),
    T.StructField("date_range", T.StructType([
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
    ])),
    T.StructField("count", T.LongType()),
    T.StructField("duplicates_skipped", T.LongType()),
    # Each paper's own text: landing lines and papers are parsed alike.
    T.StructField("papers", T.ArrayType(T.StringType())),
    T.StructField("_corrupt_record", T.StringType()),
])

# The 37 flat columns of a loaded paper, in table order.
FLAT_COLUMNS = (
    "openalex_id", "doi", "title", "landing_page_url", "oa_url",
    "publication_date", "publication_year", "work_type", "language",
    "is_oa", "oa_status", "is_retracted", "has_fulltext",
    "primary_topic_id", "primary_topic_name", "primary_topic_score",
    "subfield_id", "subfield_name", "field_name", "domain_name",
    "source_id", "source_name", "source_type", "host_organization", "is_core_source",
    "cited_by_count", "fwci", "citation_percentile",
    "is_top_1_percent", "is_top_10_percent", "referenced_works_count",
    "author_count", "countries_count", "institutions_count", "locations_count",
    "country_codes", "openalex_updated_at",
)

KEY = "openalex_id"

PAPERS_SCHEMA = T.StructType([
    T.StructField("openalex_id", T.StringType(), False),
    T.StructField("doi", T.StringType()),
    T.StructField("title", T.StringType(), False),
    T.StructField("landing_page_url", T.StringType()),
    T.StructField("oa_url", T.StringType()),
    T.StructField("publication_date", T.DateType(), False),
    T.StructField("publication_year", T.ShortType(), False),
    T.StructField("work_type", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("is_oa", T.BooleanType(), False),
    T.StructField("oa_status", T.StringType()),
    T.StructField("is_retracted", T.BooleanType(), False),
    T.StructField("has_fulltext", T.BooleanType(), False),
    T.StructField("primary_topic_id", T.StringType()),
    T.StructField("primary_topic_name", T.StringType()),
    T.StructField("primary_topic_score", T.DecimalType(6, 5)),
    T.StructField("subfield_id", T.StringType()),
    T.StructField("subfield_name", T.StringType()),
    T.StructField("field_name", T.StringType()),
    T.StructField("domain_name", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("host_organization", T.StringType()),
    T.StructField("is_core_source", T.BooleanType()),
    T.StructField("cited_by_count", T.IntegerType(), False),
    T.StructField("fwci", T.DecimalType(8, 4)),
    T.StructField("citation_percentile", T.DecimalType(8, 6)),
    T.StructField("is_top_1_percent", T.BooleanType()),
    T.StructField("is_top_10_percent", T.BooleanType()),
    T.StructField("referenced_works_count", T.IntegerType(), False),
    T.StructField("author_count", T.ShortType(), False),
    T.StructField("countries_count", T.ShortType(), False),
    T.StructField("institutions_count", T.ShortType(), False),
    T.StructField("locations_count", T.ShortType(), False),
    T.StructField("country_codes", T.ArrayType(T.StringType(), False)),
    T.StructField("openalex_updated_at", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType(), False),
])

RUNS_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("fetched_at", T.TimestampType(), False),
    T.StructField("from_date", T.DateType(), False),
    T.StructField("to_date", T.DateType(), False),
    T.StructField("subfield_id", T.StringType(), False),
    T.StructField("paper_count", T.LongType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])

# One row per load of a stored table: the version in force from then on and the one
# before, its number of buckets, the highest run id so far and the load's run-log row.
LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("version", T.StringType()),
    T.StructField("previous", T.StringType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("last_run", T.IntegerType()),
    T.StructField("run", RUNS_SCHEMA),
])
