"""Column masks and row filters by user group.

For DataFrames, group membership is an argument: the caller knows the user. The checks fold to
constants when the plan is made, so an admin's read costs nothing extra and a region
filter reaches the parquet scan. A policy view looks the reader up in a membership table.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from tillwork.sources.schemas import PLACE

# The group that sees everything, the masked text, the tag of sensitive
# columns, and the region each manager group may see.
ADMIN_GROUP = "admin_group"
MASK_TEXT = "CONFIDENTIAL DATA"
TAG, SENSITIVE = "sensitivity", "PII"
REGION_RULES = {"latam_managers": "LATAM", "apac_managers": "APAC"}


def mask_columns(df: DataFrame, names: Sequence[str], groups: Collection[str]) -> DataFrame:
    """Constant text in place of each named string column, unless an admin reads."""
    wrong = [n for n in names if not isinstance(df.schema[n].dataType, StringType)]
    if wrong:
        raise ValueError(f"only string columns can be masked, not {wrong}")
    allowed = F.lit(ADMIN_GROUP in groups)
    return df.withColumns(
        {
            n: F.when(allowed, F.col(n)).otherwise(F.lit(MASK_TEXT)).alias(n, metadata=df.schema[n].metadata)
            for n in names
        }
    )


def tag_sensitive(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mark columns as sensitive; the tag is column metadata and is kept in parquet."""
    for name in names:
        df = df.withMetadata(name, {**df.schema[name].metadata, TAG: SENSITIVE})
    return df


def sensitive_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if TAG in field.metadata]


def mask_tagged(df: DataFrame, groups: Collection[str]) -> DataFrame:
    return mask_columns(df, sensitive_columns(df), groups)


def filter_rows(
    df: DataFrame,
    groups: Collection[str],
    column: str = "region",
    rules: Mapping[str, str] = REGION_RULES,
) -> DataFrame:
    """Rows of the regions the groups manage; all rows for admins, none for others."""
    if ADMIN_GROUP in groups:
        return df
    return df.filter(F.col(column).isin([value for group, value in rules.items() if group in groups]))


def governed_view(df: DataFrame, groups: Collection[str]) -> DataFrame:
    """Row filter first, then the mask of every tagged column."""
    return mask_tagged(filter_rows(df, groups), groups)


def _text(value: str) -> str:
    """A text as an SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _name(column: str) -> str:
    escaped = column.replace("`", "``")
    return f"`{escaped}`"


def create_policy_view(
    spark: SparkSession,
    view_name: str,
    table_name: str,
    members_table: str,
    masked: Sequence[str],
    column: str = "region",
    rules: Mapping[str, str] = REGION_RULES,
    reader: str = "current_user()",
) -> None:
    """A catalog view that shows each reader what their groups may see.

    ``members_table`` has a row ``(user_name, group_name)`` per membership; the view joins the
    table with the groups of whoever reads it, so one view serves all readers and follows
    changes of membership. The reader's regions are a handful of rows: Spark broadcasts them
    and filters the table's scan by them at run time. ``reader`` is the expression that names
    the reader. A mask needs a string column.
    """
    table = spark.table(table_name)
    wrong = [n for n in masked if n not in table.columns or not isinstance(table.schema[n].dataType, StringType)]
    if wrong:
        raise ValueError(f"{table_name} has no string columns {sorted(wrong)}")
    mine = f"SELECT group_name FROM {members_table} WHERE user_name = {reader}"
    # One row: whether the reader is an admin, and the regions of the reader's groups.
    pairs = ", ".join(f"({_text(group)}, {_text(value)})" for group, value in sorted(rules.items()))
    regions = (
        f"SELECT r.value FROM VALUES {pairs} AS r(group_name, value) WHERE r.group_name IN ({mine})"
        if pairs else "SELECT CAST(NULL AS STRING) WHERE false"
    )
    admin = f"(SELECT count(*) > 0 FROM ({mine}) WHERE group_name = {_text(ADMIN_GROUP)})"
    shown = [
        f"CASE WHEN {admin} THEN t.{_name(n)} ELSE {_text(MASK_TEXT)} END AS {_name(n)}" if n in masked else f"t.{_name(n)}"
        for n in table.columns if n not in PLACE
    ]
    spark.sql(
        f"CREATE OR REPLACE VIEW {view_name} AS SELECT {', '.join(shown)} FROM {table_name} t"
        f" WHERE {admin} OR t.{_name(column)} IN ({regions})"
    )


def create_governed_view(
    spark: SparkSession,
    view_name: str,
    table_name: str,
    groups: Collection[str],
    masked: Sequence[str],
    column: str = "region",
    rules: Mapping[str, str] = REGION_RULES,
) -> None:
    """A catalog view of a table for readers of ``groups``, whom its creator names.

    Rows and masks are those of ``governed_view``; readers of the view can't choose others,
    and the view follows the table.
    """
    table, admin = spark.table(table_name), ADMIN_GROUP in groups
    columns = [n for n in table.columns if n not in PLACE]
    unknown = set(masked) - set(columns)
    if unknown:
        raise ValueError(f"{table_name} has no columns {sorted(unknown)}")
    shown = [f"{_text(MASK_TEXT)} AS {_name(n)}" if n in masked and not admin else _name(n) for n in columns]
    values = ", ".join(_text(value) for group, value in sorted(rules.items()) if group in groups)
    rows = "true" if admin else f"{_name(column)} IN ({values})" if values else "false"
    spark.sql(f"CREATE OR REPLACE VIEW {view_name} AS SELECT {', '.join(shown)} FROM {table_name} WHERE {rows}")


def register_sql_functions(spark: SparkSession) -> None:
    """The mask and the row predicate as SQL functions; the groups are an array argument."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION mask_pii(val STRING, user_groups ARRAY<STRING>)
        RETURNS STRING
        RETURN IF(array_contains(user_groups, '{ADMIN_GROUP}'), val, '{MASK_TEXT}')"""
    )
    managed = " OR ".join(
        f"(array_contains(user_groups, '{group}') AND region <=> '{value}')"
        for group, value in REGION_RULES.items()
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION can_read_region(region STRING, user_groups ARRAY<STRING>)
        RETURNS BOOLEAN
        RETURN array_contains(user_groups, '{ADMIN_GROUP}') OR {managed}"""
    )
