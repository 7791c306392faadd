"""Selecting signals, scalars and statistics by name, pattern, module or position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.functions.text import ascii_like
from siglake.model import ROW, SOURCE, STATISTIC_COLUMNS

# The columns shown by default.
INSPECTED_COLUMNS = (
    "v2x_rate", "repetition", "prefix", "moduleName", "variable", "ql", "eventNumber",
    "simtimeRaw", "vectorName", "value",
)


def _kept(df: DataFrame, columns: Sequence[str], flags: dict[str, bool]) -> list[str]:
    return [c for c in columns if flags.get(c, True) and c in df.columns]


def run_attributes(run_attrs: DataFrame) -> DataFrame:
    return run_attrs.select(SOURCE, ROW, "attrName", "attrValue")


def run_parameters(run_params: DataFrame) -> DataFrame:
    return run_params.select(SOURCE, ROW, "key", "value")


def signal_names(signals: DataFrame) -> DataFrame:
    return signals.select("vectorName").distinct()


def statistics_where(
    statistics: DataFrame, condition: str | Column, **flags: bool
) -> DataFrame:
    """Statistic rows under a condition; pass ``statMean=False`` and so on to leave columns out."""
    columns = _kept(statistics, STATISTIC_COLUMNS, flags)
    return statistics.where(condition).select(SOURCE, ROW, *columns)


def statistics_by_name(statistics: DataFrame, name: str, **flags: bool) -> DataFrame:
    return statistics_where(statistics, F.col("statName") == name, **flags)


def scalars_where(
    scalars: DataFrame,
    condition: str | Column,
    value_label: str = "scalarValue",
    runId: bool = True,
    moduleName: bool = True,
    scalarName: bool = False,
    scalarId: bool = False,
) -> DataFrame:
    flags = {
        "runId": runId, "moduleName": moduleName, "scalarName": scalarName, "scalarId": scalarId
    }
    value = F.col("scalarValue").alias(value_label)
    return scalars.where(condition).select(SOURCE, ROW, *_kept(scalars, list(flags), flags), value)


def scalars_by_name(scalars: DataFrame, name: str, value_label: str = "scalarValue", **flags: bool):
    return scalars_where(scalars, F.col("scalarName") == name, value_label, **flags)


def scalars_like(scalars: DataFrame, pattern: str, value_label: str = "scalarValue", **flags: bool):
    return scalars_where(scalars, ascii_like(F.col("scalarName"), pattern), value_label, **flags)


def signals_where(
    signals: DataFrame,
    condition: str | Column,
    value_label: str = "value",
    vectorName: bool = False,
    moduleName: bool = True,
    simtimeRaw: bool = True,
    eventNumber: bool = False,
) -> DataFrame:
    flags = {
        "vectorName": vectorName, "moduleName": moduleName,
        "simtimeRaw": simtimeRaw, "eventNumber": eventNumber,
    }
    value = F.col("value").alias(value_label)
    return signals.where(condition).select(SOURCE, ROW, *_kept(signals, list(flags), flags), value)


def signals_by_name(signals: DataFrame, name: str, value_label: str = "value", **flags: bool):
    return signals_where(signals, F.col("vectorName") == name, value_label, **flags)


def signals_like(signals: DataFrame, pattern: str, value_label: str = "value", **flags: bool):
    return signals_where(signals, ascii_like(F.col("vectorName"), pattern), value_label, **flags)


def signals_for_module(
    signals: DataFrame, name: str, module: str, value_label: str = "value", **flags: bool
) -> DataFrame:
    condition = (F.col("vectorName") == name) & ascii_like(F.col("moduleName"), module)
    return signals_where(signals, condition, value_label, **flags)


def positions(
    signals: DataFrame,
    x_signal: str,
    y_signal: str,
    x_alias: str = "posX",
    y_alias: str = "posY",
    area: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Pair x and y samples of the same event; ``area`` is (x_min, y_min, x_max, y_max), inclusive.

    Module, time and row come from the x sample.
    """
    xs = signals.where(F.col("vectorName") == x_signal)
    ys = signals.where(F.col("vectorName") == y_signal)
    if area is not None:
        x_min, y_min, x_max, y_max = area
        xs = xs.where(F.col("value").between(x_min, x_max))
        ys = ys.where(F.col("value").between(y_min, y_max))
    xs = xs.select(
        SOURCE, "eventNumber", ROW, "moduleName", "simtimeRaw", F.col("value").alias(x_alias)
    )
    ys = ys.select(SOURCE, "eventNumber", F.col("value").alias(y_alias))
    return xs.join(ys, [SOURCE, "eventNumber"])


def signals_with_position(
    signals: DataFrame,
    x_signal: str,
    y_signal: str,
    signal: str,
    x_alias: str = "posX",
    y_alias: str = "posY",
    value_label: str = "value",
    area: tuple[float, float, float, float] | None = None,
    moduleName: bool = True,
    simtimeRaw: bool = True,
    eventNumber: bool = False,
) -> DataFrame:
    """Samples of a signal with the position recorded in the same event.

    Both joins are on file and event, so the positions are not shuffled again.
    """
    pos = positions(signals, x_signal, y_signal, x_alias, y_alias, area)
    samples = signals.where(F.col("vectorName") == signal).select(
        SOURCE, "eventNumber", F.col("value").alias(value_label)
    )
    flags = {"moduleName": moduleName, "simtimeRaw": simtimeRaw, "eventNumber": eventNumber}
    joined = pos.join(samples, [SOURCE, "eventNumber"])
    return joined.select(
        SOURCE, ROW, *_kept(joined, list(flags), flags), x_alias, y_alias, value_label
    )


def select_rows(df: DataFrame, condition: str | Column | None = None) -> DataFrame:
    """Rows to summarise, chosen by any SQL expression over the columns."""
    return df if condition is None else df.where(condition)


def inspect(
    df: DataFrame,
    condition: str | Column | None = None,
    columns: Sequence[str] = INSPECTED_COLUMNS,
) -> DataFrame:
    """Filter, and show those of the usual columns that exist."""
    return select_rows(df, condition).select([c for c in columns if c in df.columns])
