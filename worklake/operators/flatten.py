"""Nested work → typed flat row, with reject routing (one projection, no UDF).

``flatten(raw)`` keeps every input row and adds ``reject_reason``:

* ``missing_id`` / ``missing_title`` / ``missing_date`` — the three source
  rules, tested in that order (the first that hits is reported);
* ``bad_date`` / ``bad_value:<col>`` / ``out_of_range:<col>`` / ``malformed`` —
  values the stored table's types cannot hold (a database would abort the
  whole batch; here the row is quarantined, or
  ``assert_no_constraint_violations`` raises).

Scalar leaves may be text, as records are read, or already typed. Whole numbers
written with a fraction (``3.0``) are taken, other fractions rounded; booleans
are ``true`` and ``false`` in any case. Everything is one projection without
lambda functions, in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklake.functions.scalar import (
    sql_bool,
    sql_country_set,
    sql_int,
    sql_last_segment,
    sql_null_to_false,
    sql_null_to_zero,
    sql_truthy,
    sql_truthy_or,
)
from worklake.schema import FLAT_COLUMNS, ORDER_COLUMNS

REJECT = "reject_reason"


def flat_sql() -> dict[str, str]:
    """The 37 flat expressions (Spark SQL over raw column paths), by output name."""
    return {
        "openalex_id": sql_truthy(sql_last_segment("id")),
        "doi": "doi",
        "title": sql_truthy_or("title", "display_name"),
        "landing_page_url": "primary_location.landing_page_url",
        "oa_url": "open_access.oa_url",
        "publication_date": "try_to_date(publication_date, 'yyyy-MM-dd')",
        "publication_year": sql_int("publication_year", "SMALLINT"),
        "work_type": "type",
        "language": "language",
        "is_oa": sql_null_to_false(sql_bool("open_access.is_oa")),
        "oa_status": "open_access.oa_status",
        "is_retracted": sql_null_to_false(sql_bool("is_retracted")),
        "has_fulltext": sql_null_to_false(sql_bool("has_fulltext")),
        "primary_topic_id": sql_last_segment("primary_topic.id"),
        "primary_topic_name": "primary_topic.display_name",
        "primary_topic_score": "try_cast(primary_topic.score AS DECIMAL(6,5))",
        "subfield_id": sql_last_segment("primary_topic.subfield.id"),
        "subfield_name": "primary_topic.subfield.display_name",
        "field_name": "primary_topic.field.display_name",
        "domain_name": "primary_topic.domain.display_name",
        "source_id": sql_last_segment("primary_location.source.id"),
        "source_name": "primary_location.source.display_name",
        "source_type": "primary_location.source.type",
        "host_organization": "primary_location.source.host_organization_name",
        "is_core_source": sql_bool("primary_location.source.is_core"),
        "cited_by_count": sql_null_to_zero(sql_int("cited_by_count")),
        "fwci": "try_cast(fwci AS DECIMAL(8,4))",
        "citation_percentile": "try_cast(citation_normalized_percentile.value AS DECIMAL(8,6))",
        "is_top_1_percent": sql_bool("citation_normalized_percentile.is_in_top_1_percent"),
        "is_top_10_percent": sql_bool("citation_normalized_percentile.is_in_top_10_percent"),
        "referenced_works_count": sql_null_to_zero(sql_int("referenced_works_count")),
        # explicit NULL test: size(NULL) is -1 when a session runs without ANSI
        "author_count": "try_cast(CASE WHEN authorships IS NULL THEN 0 ELSE size(authorships) END AS SMALLINT)",
        "countries_count": sql_null_to_zero(sql_int("countries_distinct_count", "SMALLINT")),
        "institutions_count": sql_null_to_zero(sql_int("institutions_distinct_count", "SMALLINT")),
        "locations_count": sql_null_to_zero(sql_int("locations_count", "SMALLINT")),
        "country_codes": sql_country_set("authorships"),
        "openalex_updated_at": "try_to_timestamp(updated_date)",
    }


# Columns whose source value must survive the cast: no value after the cast where
# the source had one means that the stored type cannot hold it.
_NUMBERS = {
    "publication_year": "publication_year",
    "primary_topic_score": "primary_topic.score",
    "fwci": "fwci",
    "citation_percentile": "citation_normalized_percentile.value",
    "cited_by_count": "cited_by_count",
    "referenced_works_count": "referenced_works_count",
    "countries_count": "countries_distinct_count",
    "institutions_count": "institutions_distinct_count",
    "locations_count": "locations_count",
}
_FLAGS = {
    "is_oa": "open_access.is_oa",
    "is_retracted": "is_retracted",
    "has_fulltext": "has_fulltext",
    "is_core_source": "primary_location.source.is_core",
    "is_top_1_percent": "citation_normalized_percentile.is_in_top_1_percent",
    "is_top_10_percent": "citation_normalized_percentile.is_in_top_10_percent",
}
# Largest absolute value and decimal places that a column holds.
_HOLDS = {"primary_topic_score": (10, 5), "fwci": (10_000, 4), "citation_percentile": (100, 6),
          "cited_by_count": (2**31, 0), "referenced_works_count": (2**31, 0)}
_SMALL = (2**15, 0)


def _too_large(name: str, source: str) -> str:
    """Whether a number doesn't fit its column.

    Stated on the source, not on the flat expression: the optimizer would
    rewrite each flat expression inside this condition by its column, in every
    combination, when it infers constraints. Rounding goes through decimals, so only
    numbers that may reach the bound by it (it adds less than 1) are rounded.
    """
    most, places = _HOLDS.get(name, _SMALL)
    number = f"try_cast({source} AS DOUBLE)"
    return f"abs({number}) >= {most - 1} AND abs(round({number}, {places})) >= {most}"


def reject_sql(flat: dict[str, str]) -> str:
    """CASE over the rules, first hit wins."""
    whens = [
        ("_corrupt_record IS NOT NULL", "malformed"),
        (f"({flat['openalex_id']}) IS NULL", "missing_id"),
        (f"({flat['title']}) IS NULL", "missing_title"),
        (f"{sql_truthy('publication_date')} IS NULL OR publication_year IS NULL", "missing_date"),
        (f"({flat['publication_date']}) IS NULL", "bad_date"),
    ]
    whens += [(f"{src} IS NOT NULL AND try_cast({src} AS DOUBLE) IS NULL", "bad_value:" + name)
              for name, src in _NUMBERS.items()]
    whens += [(_too_large(name, src), "out_of_range:" + name) for name, src in _NUMBERS.items()]
    whens += [(f"lower(CAST({src} AS STRING)) NOT IN ('true', 'false')", "bad_value:" + name)
              for name, src in _FLAGS.items()]
    whens.append(("size(authorships) >= 32768", "out_of_range:author_count"))
    return "CASE " + " ".join(f"WHEN {cond} THEN '{label}'" for cond, label in whens) + " END"


def flatten(raw: DataFrame, keep: tuple[str, ...] = ORDER_COLUMNS) -> DataFrame:
    """Project raw works to the 37 flat columns plus ``reject_reason``.

    ``keep`` lists raw columns carried through unchanged (first-wins order).
    Rows without a ``_corrupt_record`` column are treated as well-formed.
    """
    cols = raw.columns
    flat = flat_sql()
    corrupt = [] if "_corrupt_record" in cols else ["CAST(NULL AS STRING) AS _corrupt_record"]
    kept = [k for k in keep if k in cols]
    exprs = kept + [f"{flat[n]} AS {n}" for n in FLAT_COLUMNS] + [f"{reject_sql(flat)} AS {REJECT}"]
    if corrupt:
        raw = raw.selectExpr("*", *corrupt)
    return raw.selectExpr(*exprs)


def accepted(flat: DataFrame) -> DataFrame:
    return flat.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected(flat: DataFrame) -> DataFrame:
    return flat.filter(F.col(REJECT).isNotNull())


class ConstraintError(ValueError):
    """Raised in strict mode when a batch holds rows the table cannot store."""


def assert_no_constraint_violations(flat: DataFrame) -> None:
    """Strict mode: fail like a database would on type / NOT NULL violations."""
    bad = (flat.filter(F.col(REJECT).startswith("out_of_range") | F.col(REJECT).startswith("bad_value")
                       | (F.col(REJECT) == "bad_date") | (F.col(REJECT) == "malformed"))
           .groupBy(REJECT).count().collect())  # at most a handful of reason rows
    if bad:
        detail = ", ".join(f"{r[REJECT]}: {r['count']}" for r in bad)
        raise ConstraintError("batch violates table constraints: " + detail)
