"""Row changes between two states of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

CHANGE = "_change_type"


def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], ignored: Sequence[str] = ()) -> DataFrame:
    """Rows that differ, marked insert, delete, update_pre (before) or update_post (after).

    Keys are unique in each state; a missing key value equals a missing one. Both
    states need the same columns. Rows that differ in ``ignored`` columns only are the same.
    """
    names = new.columns
    before = old.select(F.struct(*[old[n] for n in names]).alias("before"))
    after = new.select(F.struct(*[new[n] for n in names]).alias("after"))
    match = F.lit(True)
    for key in keys:
        match = match & F.col(f"before.{key}").eqNullSafe(F.col(f"after.{key}"))
    paired = before.join(after, match, "full_outer")

    def change(kind: str, row: str):
        return F.struct(F.lit(kind).alias(CHANGE), F.col(row).alias("row"))

    changes = (
        F.when(F.col("before").isNull(), F.array(change("insert", "after")))
        .when(F.col("after").isNull(), F.array(change("delete", "before")))
        .otherwise(F.array(change("update_pre", "before"), change("update_post", "after")))
    )
    def compared(row: str):
        if not ignored:
            return F.col(row)
        return F.when(F.col(row).isNotNull(), F.struct(*[F.col(f"{row}.{n}") for n in names if n not in ignored]))

    return (
        paired.filter(~compared("before").eqNullSafe(compared("after")))
        .select(F.explode(changes).alias("change"))
        .select(f"change.{CHANGE}", "change.row.*")
    )
