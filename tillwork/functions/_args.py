from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = str | Column


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value
