"""Scalar expressions (SQL text builders and Column helpers); no UDFs."""

from worklake.functions.scalar import (  # noqa: F401
    bool_label,
    join_list,
    sql_country_set,
    sql_empty_to_null,
    sql_last_segment,
    sql_null_to_false,
    sql_null_to_zero,
    sql_truthy,
    sql_truthy_or,
    work_url,
)
