"""Functions for SQL text: plain expressions that the optimiser inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from opsloom.functions.scalars import DATE_LAYOUTS
from opsloom.functions.words import GENERIC_WORDS, WORD_LETTERS


def register_sql_functions(spark: SparkSession) -> None:
    """Define parse_mixed_date, worktime_coeff and significant_words for the session."""
    tries = ", ".join(f"to_date(try_to_timestamp(t, '{layout}'))" for layout in DATE_LAYOUTS[:-1])
    short = f"to_date(try_to_timestamp(t, '{DATE_LAYOUTS[-1]}'))"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION parse_mixed_date(t STRING) RETURNS DATE
      RETURN coalesce({tries}, CASE WHEN year({short}) > 2068 THEN add_months({short}, -1200) ELSE {short} END)""")
    plain = r"replace(regexp_replace(t, '^\\s+|\\s+$', ''), '%', '')"
    number = f"try_cast({plain} AS DOUBLE)"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION worktime_coeff(t STRING) RETURNS DOUBLE
      RETURN CASE WHEN t IS NULL THEN 1.0D WHEN {number} > 1 THEN {number} / 100 WHEN {number} IS NOT NULL THEN {number}
        WHEN contains(lower(t), 'plein') THEN 1.0D WHEN contains(lower(t), 'partiel') THEN 0.8D ELSE 1.0D END""")
    generic = ", ".join(f"'{w}'" for w in GENERIC_WORDS)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION significant_words(t STRING) RETURNS ARRAY<STRING>
      RETURN array_distinct(filter(regexp_extract_all(lower(t), '([{WORD_LETTERS}]+)', 1),
        w -> length(w) > 3 AND w NOT IN ({generic})))""")
