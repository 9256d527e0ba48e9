"""Scalar expressions used by flatten, data quality and reports.

The ``sql_*`` builders return Spark SQL expression text over column paths:
a wide projection is then parsed once on the JVM side (one call per
column) instead of being assembled from many small Column objects.
The Column helpers are used by the reports.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: public page of a work, followed by its short id.
WORK_URL_PREFIX = "https://openalex.org/works/"


def sql_last_segment(x: str) -> str:
    """Text after the last '/'; NULL or '' give NULL; no '/' gives the whole text.

    A trailing '/' gives '' (kept: only the work id treats '' as missing).
    """
    return f"CASE WHEN {x} <> '' THEN substring_index({x}, '/', -1) END"


def sql_truthy(x: str) -> str:
    """NULL for NULL or the empty string (Python truthiness of a str)."""
    return f"nullif({x}, '')"


def sql_truthy_or(*xs: str) -> str:
    """First value that is neither NULL nor '' (``a or b``)."""
    return "coalesce(" + ", ".join(sql_truthy(x) for x in xs) + ")"


def sql_null_to_false(x: str) -> str:
    return f"coalesce({x}, false)"


def sql_null_to_zero(x: str) -> str:
    return f"coalesce({x}, 0)"


def sql_int(x: str, kind: str = "INT") -> str:
    """A whole number from text or a number; NULL if it is none or doesn't fit.

    Exact for whole numbers; values written with a fraction are rounded.
    """
    return f"coalesce(try_cast({x} AS {kind}), try_cast(round(try_cast({x} AS DOUBLE)) AS {kind}))"


def sql_bool(x: str) -> str:
    """``true`` / ``false`` from text or a boolean; NULL for anything else."""
    return f"CASE lower(CAST({x} AS STRING)) WHEN 'true' THEN true WHEN 'false' THEN false END"


def sql_country_set(authorships: str) -> str:
    """Distinct, ascending country codes over all authorships; NULL when none.

    NULL authorship entries, NULL ``countries`` lists and NULL codes are
    skipped. Field access on the array (no lambda) keeps the projection in
    whole-stage codegen; ``array_except`` against a NULL element drops NULLs
    after ``flatten``, and before it if a list is NULL (as ``flatten`` then is).
    """
    lists = f"array_except({authorships}.countries, array(CAST(NULL AS ARRAY<STRING>)))"
    codes = f"coalesce(flatten({authorships}.countries), flatten({lists}))"
    return sql_empty_to_null(f"sort_array(array_except({codes}, array(CAST(NULL AS STRING))))")


def sql_empty_to_null(arr: str) -> str:
    return f"nullif({arr}, CAST(array() AS ARRAY<STRING>))"


def work_url(short_id: Column) -> Column:
    return F.concat(F.lit(WORK_URL_PREFIX), short_id)


def bool_label(c: Column) -> Column:
    """True → 'Yes', False → 'No', NULL stays NULL."""
    return F.when(c, F.lit("Yes")).when(~c, F.lit("No"))


def join_list(c: Column, sep: str = ", ") -> Column:
    """Array joined with ``sep``; NULL array gives ''."""
    return F.coalesce(F.array_join(c, sep), F.lit(""))
