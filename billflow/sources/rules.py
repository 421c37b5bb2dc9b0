"""Rule sheets: ragged config columns -> one long ``(rule_name, value)`` table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billflow.schema import CODE_RULES, RULE_COLUMNS


def _int_text(c):
    """'993.0' / '993' / 993.0 -> '993'. A code that is not a number stops the
    run: dropping it could empty its list, and an empty list lets every service
    through."""
    code = c.try_cast("double").try_cast("bigint").cast("string")
    bad = F.raise_error(F.concat(F.lit("rule sheet: procedure code is not a number: "), c)).cast("string")
    return F.when(c.isNull() | code.isNotNull(), code).otherwise(bad)


def rules_long(sheet: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Unpivot a ragged rule sheet (O-02).

    Each column of the sheet is an independent list; NULL cells are padding
    and are dropped, and code columns are normalised to integer text.
    ``columns`` maps sheet header -> rule name (default: ``RULE_COLUMNS``
    restricted to the headers present).
    """
    columns = columns or {h: r for h, r in RULE_COLUMNS.items() if h in sheet.columns}
    renamed = sheet.select([F.col(f"`{h}`").cast("string").alias(r) for h, r in columns.items()])
    long = renamed.unpivot([], list(columns.values()), "rule_name", "value")
    value = F.when(F.col("rule_name").isin(list(CODE_RULES)), _int_text(F.col("value"))) \
        .otherwise(F.col("value"))
    return long.select("rule_name", value.alias("value")).filter(F.col("value").isNotNull())


def rules_from_lists(spark: SparkSession, rules: dict[str, list]) -> DataFrame:
    """Build the long rule table from in-memory lists (config parameters)."""
    rows = [(name, str(v)) for name, vals in rules.items() for v in vals if v is not None]
    pdf = pd.DataFrame(rows, columns=["rule_name", "value"], dtype="string")
    # Arrow path -> a LocalRelation in the plan (no Python worker at run time).
    return spark.createDataFrame(pdf, "rule_name string, value string")


def rule_values(rules: DataFrame, name: str, alias: str = "value") -> DataFrame:
    """The non-null values of one rule as a one-column DataFrame."""
    return rules.filter(F.col("rule_name") == name).select(F.col("value").alias(alias))
