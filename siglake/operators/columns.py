"""Column types: numeric casts and naturally ordered categories."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.functions.numbers import to_double, to_long
from siglake.functions.text import natural_key
from siglake.operators.ranking import ROWS_PER_SLICE, global_ordinal
from siglake.session import broadcast_if_small

ORDINAL_SUFFIX = "_ord"

# Type names as the dtype names of numeric columns.
TYPES = {
    "float": "double", "float64": "double", "float32": "float", "double": "double",
    "int": "bigint", "int64": "bigint", "int32": "int", "bigint": "bigint",
    "str": "string", "bool": "boolean",
}


def _cast(df: DataFrame, column: str, target: str, strict: bool) -> Column:
    if strict:
        return F.col(column).cast(target)
    if isinstance(df.schema[column].dataType, T.StringType):
        if target in ("double", "float"):
            return to_double(F.col(column)).cast(target)
        if target in ("bigint", "int"):
            return to_long(F.col(column)).try_cast(target)
    return F.col(column).try_cast(target)


def _targets(df: DataFrame, numerical: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    wanted = dict(numerical) if isinstance(numerical, Mapping) else dict.fromkeys(numerical, "float")
    return {c: TYPES.get(t, t) for c, t in wanted.items() if c in df.columns}


def cast_columns(
    df: DataFrame, numerical: Sequence[str] | Mapping[str, str], strict: bool = False
) -> DataFrame:
    """Cast those of the listed columns that exist, to double unless a type is named.

    What is not a number becomes NULL, or fails the query if ``strict``.
    """
    targets = _targets(df, numerical)
    if not targets:
        return df
    return df.withColumns({c: _cast(df, c, t, strict) for c, t in targets.items()})


def cast_failures(df: DataFrame, numerical: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """How many values of each column ``cast_columns`` turns into NULL."""
    targets = _targets(df, numerical)
    return df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & _cast(df, c, t, False).isNull()).alias(c)
            for c, t in targets.items()
        ]
    )


def category_order(
    df: DataFrame, column: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Distinct values of a column and their place in natural order, from 0."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    text = isinstance(df.schema[column].dataType, T.StringType)
    order = [natural_key(F.col(column)), F.col(column)] if text else [F.col(column)]
    return global_ordinal(values, order, f"{column}{ORDINAL_SUFFIX}", rows_per_slice)


def order_categories(
    df: DataFrame, columns: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add the ordinal of each category over the whole dataset as ``<column>_ord``."""
    for column in columns:
        if column in df.columns:
            df = df.drop(f"{column}{ORDINAL_SUFFIX}")
            categories = broadcast_if_small(category_order(df, column, rows_per_slice))
            df = df.join(categories, column, "left")
    return df


def convert_columns(
    df: DataFrame,
    categorical: Sequence[str] = (),
    numerical: Sequence[str] | Mapping[str, str] = (),
    strict: bool = False,
) -> DataFrame:
    return cast_columns(order_categories(df, categorical), numerical, strict)


def map_column(
    df: DataFrame, input_column: str, output_column: str, function: Callable[[Column], Column]
) -> DataFrame:
    """Apply a column function (or a pandas UDF) to one column."""
    return df.withColumn(output_column, function(F.col(input_column)))
