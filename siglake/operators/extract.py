"""Extraction: choose rows, attach tags, convert columns. The result is a dataset of frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.functions.text import Pattern
from siglake.model import DATA_COLUMNS, FRAME, SOURCE
from siglake.operators import query, tags
from siglake.operators.columns import convert_columns
from siglake.sources.results import Results


@dataclass(frozen=True)
class Options:
    """What every extraction can be told."""

    base_tags: Sequence[str] | None = None
    additional_tags: Sequence[str] = ()
    minimal_tags: bool = True
    moduleName: bool = True
    simtimeRaw: bool = True
    eventNumber: bool = True
    include_filename: bool = False
    categorical: Sequence[str] = ()
    numerical: Sequence[str] | Mapping[str, str] = ()
    rules: tags.RuleSet | None = None

    def signal_flags(self) -> dict[str, bool]:
        return {
            "moduleName": self.moduleName,
            "simtimeRaw": self.simtimeRaw,
            "eventNumber": self.eventNumber,
        }


DEFAULTS = Options()
MAX_BROADCAST_BYTES = 256 << 20


def file_tags(
    results: Results, options: Options = DEFAULTS, data_columns: Sequence[str] = ()
) -> DataFrame:
    """The allowed tags of every file, one row per file.

    A tag named like a data column is left out where no run has it, so that
    conditions on the column still reach the scan.
    """
    rules = options.rules or tags.RuleSet.build()
    allowed = tags.allowed_tags(options.base_tags, options.additional_tags, options.minimal_tags)
    metadata, types = results.metadata, rules.types()
    unused = set(DATA_COLUMNS).intersection(data_columns).difference(metadata.data_columns, types)
    allowed = [tag for tag in allowed if tag not in unused]
    found = tags.all_tags(results.run_params, results.run_attrs, rules.only(allowed))
    wide = tags.wide_tags(found, allowed, types)
    # A tag is read from the metadata; its column takes up to 16 bytes beside the text.
    size = metadata.text_bytes + 16 * metadata.rows * len(allowed)
    return F.broadcast(wide) if size <= MAX_BROADCAST_BYTES else wide


def finish(rows: DataFrame, results: Results, options: Options) -> DataFrame:
    """Tag and convert selected rows, and make each file a frame."""
    tagged = tags.tag_rows(rows, file_tags(results, options, rows.columns))
    if options.include_filename:
        tagged = tagged.withColumn("filename", F.col(SOURCE))
    converted = convert_columns(tagged, options.categorical, options.numerical)
    return converted.withColumn(FRAME, F.col(SOURCE))


def extract_signal(
    results: Results, signal: str, alias: str, options: Options = DEFAULTS
) -> DataFrame:
    rows = query.signals_by_name(results.signals, signal, alias, **options.signal_flags())
    return finish(rows, results, options)


def extract_scalar(
    results: Results,
    scalar: str,
    alias: str,
    options: Options = DEFAULTS,
    runId: bool = True,
    scalarName: bool = False,
    scalarId: bool = False,
) -> DataFrame:
    rows = query.scalars_by_name(
        results.scalars, scalar, alias, runId=runId, moduleName=options.moduleName,
        scalarName=scalarName, scalarId=scalarId,
    )
    return finish(rows, results, options)


def extract_statistic(
    results: Results,
    statistic: str,
    options: Options = DEFAULTS,
    runId: bool = True,
    statName: bool = True,
    statId: bool = True,
) -> DataFrame:
    rows = query.statistics_by_name(
        results.statistics, statistic, runId=runId, moduleName=options.moduleName,
        statName=statName, statId=statId,
    )
    return finish(rows, results, options)


def extract_with_position(
    results: Results,
    x_signal: str,
    x_alias: str,
    y_signal: str,
    y_alias: str,
    signal: str,
    alias: str,
    area: tuple[float, float, float, float] | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    signals = results.signals if results.events is None else results.events
    rows = query.signals_with_position(
        signals, x_signal, y_signal, signal, x_alias, y_alias, alias, area,
        **options.signal_flags(),
    )
    return finish(rows, results, options)


def extract_matching(
    results: Results,
    pattern: str,
    alias_pattern: str,
    options: Options = DEFAULTS,
) -> DataFrame:
    """Signals whose name matches; ``variable`` is the alias filled with the matched groups.

    One pass over all signals, however many names match.
    """
    regex = Pattern(pattern)
    matching = regex.found(F.col("vectorName"))
    rows = query.signals_where(
        results.signals, matching, vectorName=True, **options.signal_flags()
    )
    named = rows.withColumn("variable", regex.format(F.col("vectorName"), alias_pattern))
    value_last = [c for c in named.columns if c not in ("vectorName", "value")]
    return finish(named.select(*value_last, "value"), results, options)


def variable_name(name, alias_match_pattern: str, alias_pattern: str):
    """The filled alias, or the name as it is where the pattern is not found."""
    regex = Pattern(alias_match_pattern)
    return F.when(regex.found(name), regex.format(name, alias_pattern)).otherwise(name)


def extract_like(
    results: Results,
    pattern: str,
    alias: str,
    alias_match_pattern: str,
    alias_pattern: str,
    options: Options = DEFAULTS,
) -> DataFrame:
    """Signals whose name is LIKE the pattern, told apart by ``variable``."""
    rows = query.signals_like(
        results.signals, pattern, alias, vectorName=True, **options.signal_flags()
    )
    variable = variable_name(F.col("vectorName"), alias_match_pattern, alias_pattern)
    return finish(rows.withColumn("variable", variable).drop("vectorName"), results, options)


def extract_scalars_like(
    results: Results,
    pattern: str,
    alias: str,
    alias_match_pattern: str,
    alias_pattern: str,
    options: Options = DEFAULTS,
    scalarName: bool = False,
    scalarId: bool = False,
    runId: bool = False,
) -> DataFrame:
    """Scalars whose name is LIKE the pattern, told apart by ``variable``."""
    rows = query.scalars_like(
        results.scalars, pattern, alias, runId=runId, moduleName=options.moduleName,
        scalarName=True, scalarId=scalarId,
    )
    variable = variable_name(F.col("scalarName"), alias_match_pattern, alias_pattern)
    named = rows.withColumn("variable", variable)
    return finish(named if scalarName else named.drop("scalarName"), results, options)


def melt(
    df: DataFrame, values: Sequence[str], ids: Sequence[str] | None = None, value_name: str = "value"
) -> DataFrame:
    """Turn value columns into rows of ``variable`` and value; all others identify the row."""
    ids = [c for c in df.columns if c not in values] if ids is None else list(ids)
    return df.unpivot(ids, list(values), "variable", value_name)
