"""How column types of a feed grow: the least type that holds the values of both."""

from __future__ import annotations

from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())
DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
WIDEST_DECIMAL = 38


def wider(a: DataType, b: DataType) -> DataType:
    """Whole numbers grow by size, then to decimal, then to double; what has nothing else in common is text."""
    if a == b:
        return a
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if {a, b} == {DateType(), TimestampType()}:
        return TimestampType()
    if {a, b} == {FloatType(), DoubleType()}:
        return DoubleType()
    numbers = [x for x in (a, b) if x in WHOLE or isinstance(x, (DecimalType, FloatType, DoubleType))]
    if len(numbers) < 2:
        return StringType()
    if any(isinstance(x, (FloatType, DoubleType)) for x in numbers):
        return DoubleType()
    parts = [(DIGITS[x], 0) if x in WHOLE else (x.precision - x.scale, x.scale) for x in numbers]
    whole, scale = (max(p) for p in zip(*parts))
    return DecimalType(whole + scale, scale) if whole + scale <= WIDEST_DECIMAL else DoubleType()


def widened(known: StructType, found: StructType) -> StructType:
    """``known`` with the types that its columns need for ``found``, too; names go without regard to case."""
    new = {f.name.lower(): f.dataType for f in found}
    return StructType([
        StructField(f.name, wider(f.dataType, new[f.name.lower()]) if f.name.lower() in new else f.dataType) for f in known
    ])


def read_as(stored: DataType, wanted: DataType) -> bool:
    """Whether Spark reads parquet files of one type in another one."""
    if stored == wanted:
        return True
    small = stored in WHOLE[:3]
    if isinstance(wanted, DecimalType):
        if isinstance(stored, DecimalType):
            return wanted.scale >= stored.scale and wanted.precision - wanted.scale >= stored.precision - stored.scale
        return stored in WHOLE and wanted.precision - wanted.scale >= (10 if small else 20)
    return (small and wanted in (*WHOLE[2:], DoubleType())) or (stored == FloatType() and wanted == DoubleType())
