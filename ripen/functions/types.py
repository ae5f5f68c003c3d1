"""Schema rules shared by every operator (no Spark job is run here)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def is_numeric(dt: T.DataType) -> bool:
    """Numeric in the broad sense: numbers and booleans (one-hot output)."""
    return isinstance(dt, (T.NumericType, T.BooleanType))


def is_stat_numeric(dt: T.DataType) -> bool:
    """Numbers only: statistics, correlations and outliers skip booleans."""
    return isinstance(dt, T.NumericType)


def is_categorical(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.VarcharType, T.CharType))


def is_datetime(dt: T.DataType) -> bool:
    return isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType))


def dtype_label(dt: T.DataType) -> str:
    return "numeric" if is_numeric(dt) else "categorical"


def field_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def columns_where(df: DataFrame, pred, exclude=()) -> list[str]:
    ex = set(exclude or ())
    return [f.name for f in df.schema.fields if f.name not in ex and pred(f.dataType)]


def check_column(df: DataFrame, col: str | None, target: str | None = None) -> str:
    """Guard shared by every column operator: present, known, not the target."""
    if not col:
        raise ValueError("this operator requires a column")
    if col not in df.columns:
        raise ValueError(f"column {col!r} not found; available: {df.columns[:8]}")
    if target is not None and col == target:
        raise ValueError(f"cannot modify target column {col!r}")
    return col


def q(name: str) -> str:
    """Back-quote a column name for SQL expressions / col() lookups."""
    return "`" + name.replace("`", "``") + "`"
