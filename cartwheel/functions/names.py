"""Column-name helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snake_to_camel(name: str) -> str:
    """``user_id`` -> ``userId`` (names only: done on the driver, no data)."""
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def rename_columns_camel(df: DataFrame) -> DataFrame:
    """S9 ``underScoreToCamel``: rename every column."""
    return df.toDF(*[snake_to_camel(c) for c in df.columns])


def snake_to_camel_col(c) -> Column:
    """F7 on data: ``a_b_c`` -> ``aBC`` as a column expression."""
    c = F.col(c) if isinstance(c, str) else c
    parts = F.split(c, "_")
    tail = F.transform(F.slice(parts, 2, 1 << 30), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))
    return F.concat(F.element_at(parts, 1), F.array_join(tail, ""))


def null_or_empty(c) -> Column:
    """F9."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (c == "")
