"""Transforms of datasets: concatenate, apply functions to frames, rows and groups.

Group functions come in two forms. Column functions (``F.avg``, or any
expression over aggregates) are combined before the shuffle, whatever the size
of a group. Pandas functions over a whole group hold it in one task. For groups of any size
there are ``stream_*``, to which a group's rows come in batches and in order, and
``fold_groups_pandas``, whose states are merged before they move.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import chain, groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.model import FRAME, PART, ROW, group_keys, row_order, with_keys_present
from siglake.operators.ranking import group_quantiles, slice_cuts
from siglake.operators.ranking import present as numbers
from siglake.session import broadcast_if_small

# Groups that a task of ``fold_groups_pandas`` holds before it hands on their states.
HELD_GROUPS = 10_000

Aggregate = Callable[[Column], Column]

NATIVE: dict[str, Aggregate] = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "count": F.count,
    "size": lambda _: F.count(F.lit(1)),
}
QUANTILES = {"median": 0.5}


def concat(datasets: Sequence[DataFrame], name: str = "concat") -> DataFrame:
    """All rows of the datasets as one frame, united by column name.

    Rows keep the order of the datasets, and inside each that of its frames.
    """
    pieces = []
    for number, df in enumerate(datasets):
        inner = [F.nullif(F.col(PART), F.lit(""))] if PART in df.columns else []
        piece = F.concat_ws("/", F.lit(f"{number:06d}"), F.col(FRAME), *inner)
        pieces.append(df.withColumn(PART, piece).withColumn(FRAME, F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)


def apply_frame(df: DataFrame, function: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a function that works on each frame alike, such as a chain of column expressions."""
    return df.transform(function)


def apply_frame_pandas(
    df: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Apply a pandas function to each frame; rows arrive in their order."""
    return apply_groups_pandas(df, [], function, schema)


def _template(df: DataFrame, groups: Sequence[str], dropped: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in groups and c not in dropped]


def aggregate_groups(
    df: DataFrame,
    keys: Sequence[str],
    input_column: str,
    output_column: str,
    function: str | Aggregate,
    across_frames: bool = False,
) -> DataFrame:
    """One row per group: the group's first row without the input column, plus the aggregate."""
    if isinstance(function, str) and function in QUANTILES:
        return _quantile_of_groups(
            df, keys, input_column, output_column, QUANTILES[function], across_frames
        )
    function = NATIVE[function] if isinstance(function, str) else function
    return apply_groups(
        df, keys, input_column, output_column, lambda: function(F.col(input_column)), across_frames
    )


def _quantile_of_groups(df, keys, input_column, output_column, probability, across_frames):
    groups = group_keys(keys, across_frames)
    present = with_keys_present(df, groups)
    cuts = slice_cuts(present, input_column)
    if not cuts:
        exact = lambda: F.percentile(numbers(input_column), probability)
        return apply_groups(df, keys, input_column, output_column, exact, across_frames)
    quantile = group_quantiles(present, groups, input_column, [probability], cuts=cuts)
    none = lambda: F.lit(None)
    first = apply_groups(df, keys, input_column, output_column, none, across_frames).drop(output_column)
    result = quantile.select(*groups, F.col("q")[0].alias(output_column))
    return first.join(result, groups, "left").select(*first.columns, output_column)


def aggregate_groups_raw(
    df: DataFrame,
    keys: Sequence[str],
    output_column: str,
    result: Mapping[str, Column],
    across_frames: bool = False,
) -> DataFrame:
    """Group keys and a struct of aggregates, without a template row."""
    groups = group_keys(keys, across_frames)
    fields = F.struct(*[value.alias(name) for name, value in result.items()])
    return with_keys_present(df, groups).groupBy(*groups).agg(fields.alias(output_column))


def apply_groups(
    df: DataFrame,
    keys: Sequence[str],
    input_column: str,
    output_column: str,
    function: Callable[[], Column],
    across_frames: bool = False,
) -> DataFrame:
    """Like ``aggregate_groups``, for an expression that reads several columns.

    A task keeps the first row and the partial result of each of its groups in a hash
    table, so rows are neither sorted nor read twice. Tasks with more groups than
    ``session.SETTINGS`` allows in memory go on by sorting what they have.

    By themselves, texts and structs would make Spark sort all rows, as its hash table of
    fixed width has no place for them. Beside a list, here an empty one, it keeps all
    results as objects in a hash table.
    """
    groups = group_keys(keys, across_frames)
    carried = _template(df, groups, (input_column, output_column))
    aggregates = [function().alias(output_column)]
    if carried:
        aggregates.append(F.min_by(F.struct(*carried), row_order(df)).alias("_first"))
        aggregates.append(F.collect_list(F.lit(None).cast("boolean")).alias("_none"))
    columns = [c for c in df.columns if c not in (input_column, output_column)]
    result = with_keys_present(df, groups).groupBy(*groups).agg(*aggregates)
    if carried:
        result = result.where(F.size("_none") == 0)
    return result.select(
        *[F.col(c) if c in groups else F.col(f"_first.{c}").alias(c) for c in columns],
        output_column,
    )


def assign_groups(
    df: DataFrame,
    keys: Sequence[str],
    output_column: str,
    aggregates: Mapping[str, Column],
    expression: Column | None = None,
    across_frames: bool = False,
) -> DataFrame:
    """Add a column computed from group aggregates to every row of the group.

    The aggregates are combined first and joined back, which leaves the rows of
    a large group spread out, and unshuffled if the groups are few. Without an
    expression the (only) aggregate is assigned.
    """
    groups = group_keys(keys, across_frames)
    rows = with_keys_present(df, groups)
    named = {name: f"_agg_{name}" for name in aggregates}
    per_group = rows.groupBy(*groups).agg(
        *[value.alias(named[name]) for name, value in aggregates.items()]
    )
    joined = rows.join(broadcast_if_small(per_group), groups).withColumnsRenamed(
        {hidden: name for name, hidden in named.items() if name not in df.columns}
    )
    if expression is None:
        (name,) = aggregates
        expression = F.col(name if name not in df.columns else named[name])
    kept = [c for c in df.columns if c != output_column]
    return joined.select(*kept, expression.alias(output_column))


def aggregate_groups_pandas(
    df: DataFrame,
    keys: Sequence[str],
    input_column: str,
    output_column: str,
    function: Callable[[pd.Series], object],
    result_type: str = "double",
    across_frames: bool = False,
) -> DataFrame:
    """``aggregate_groups`` for a function from a pandas series to a scalar."""
    groups = group_keys(keys, across_frames)
    rows = with_keys_present(df, groups)
    # Spark reads the kind of a pandas UDF from its type hints.
    def aggregate(values: pd.Series) -> object:
        return function(values)

    aggregate.__annotations__ = {"values": pd.Series, "return": float}
    udf = F.pandas_udf(aggregate, result_type)
    results = rows.groupBy(*groups).agg(udf(F.col(input_column)).alias(output_column))
    first = apply_groups(
        df, keys, input_column, output_column, lambda: F.lit(None), across_frames
    ).drop(output_column)
    return first.join(results, groups).select(*first.columns, output_column)


def apply_groups_pandas(
    df: DataFrame,
    keys: Sequence[str],
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    across_frames: bool = False,
) -> DataFrame:
    """Apply a pandas function to each whole group; rows arrive in their order."""
    groups = group_keys(keys, across_frames)
    order = [c for c in (FRAME, PART, ROW) if c in df.columns]
    rows = with_keys_present(df, groups)

    def ordered(frame: pd.DataFrame) -> pd.DataFrame:
        return function(frame.sort_values(order, ignore_index=True))

    return rows.groupBy(*groups).applyInPandas(ordered, schema)


def assign_groups_pandas(
    df: DataFrame,
    keys: Sequence[str],
    input_column: str,
    output_column: str,
    function: Callable[[pd.Series], pd.Series],
    result_type: str = "double",
    across_frames: bool = False,
) -> DataFrame:
    """A column from a function of a whole group's series to a series as long."""
    kept = [c for c in df.columns if c != output_column]
    schema = ", ".join(f"`{c}` {t}" for c, t in df.select(*kept).dtypes)

    def assigned(frame: pd.DataFrame) -> pd.DataFrame:
        return frame[kept].assign(**{output_column: function(frame[input_column]).to_numpy()})

    return apply_groups_pandas(df, keys, assigned, f"{schema}, `{output_column}` {result_type}", across_frames)


def apply_groups_raw(
    df: DataFrame,
    keys: Sequence[str],
    output_column: str,
    function: Callable[[pd.DataFrame], dict],
    result_type: str,
    across_frames: bool = False,
) -> DataFrame:
    """The group's keys and the object that a function makes of the group, as a struct."""
    groups = group_keys(keys, across_frames)
    key_types = dict(df.dtypes)
    schema = ", ".join([*[f"`{k}` {key_types[k]}" for k in groups], f"`{output_column}` {result_type}"])

    def raw(frame: pd.DataFrame) -> pd.DataFrame:
        row = {k: [frame[k].iloc[0]] for k in groups}
        return pd.DataFrame(row | {output_column: [function(frame)]})

    return apply_groups_pandas(df, keys, raw, schema, across_frames)


def fold_groups_pandas(
    df: DataFrame,
    keys: Sequence[str],
    output_column: str,
    start: Callable[[pd.DataFrame], object],
    merge: Callable[[object, object], object],
    finish: Callable[[object], object],
    state_type: str,
    result_type: str = "double",
    across_frames: bool = False,
) -> DataFrame:
    """Keys and a result for groups of any size.

    ``start`` makes a state of some of a group's rows, ``merge`` one of two, ``finish``
    the result of the last. Tasks merge what they have of a group before it moves, so
    a group arrives as one state or a few from each task.
    """
    groups = group_keys(keys, across_frames)
    rows = with_keys_present(df, groups)
    key_types = dict(df.dtypes)
    key_schema = ", ".join(f"`{k}` {key_types[k]}" for k in groups)

    def frame_of(states: dict, column: str) -> pd.DataFrame:
        out = pd.DataFrame(list(states), columns=groups)
        out[column] = pd.Series(list(states.values()), dtype=object)
        return out

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict = {}
        for batch in batches:
            for key, part in batch.groupby(groups, sort=False):
                state = start(part)
                states[key] = merge(states[key], state) if key in states else state
            if len(states) > HELD_GROUPS:
                yield frame_of(states, "_state")
                states = {}
        if states:
            yield frame_of(states, "_state")

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        key = {k: [frame[k].iloc[0]] for k in groups}
        return pd.DataFrame(key | {output_column: [finish(reduce(merge, frame["_state"]))]})

    states = rows.mapInPandas(partial, f"{key_schema}, _state {state_type}")
    return states.groupBy(*groups).applyInPandas(whole, f"{key_schema}, `{output_column}` {result_type}")


Batches = Iterator[pd.DataFrame]
Series = Iterator[pd.Series]


def _schema_of(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.select(*columns).dtypes)


def stream_groups(
    df: DataFrame,
    keys: Sequence[str],
    function: Callable[[Batches], Batches],
    schema: str,
    across_frames: bool = False,
) -> DataFrame:
    """Apply a function to the batches of each group; rows come in their order.

    Rows are sorted by group and place, on disk if need be, and pass through the task
    in batches, so a group can be larger than the memory of a worker. A group is in one
    task, as the order of its rows asks for.
    """
    groups = group_keys(keys, across_frames)
    order = [c for c in (FRAME, PART, ROW) if c in df.columns and c not in groups]
    rows = with_keys_present(df, groups).repartition(*groups).sortWithinPartitions(*groups, *order)

    def streamed(batches: Batches) -> Batches:
        for _, group in groupby(_pieces(batches, groups), key=lambda piece: piece[0]):
            yield from function(rows for _, rows in group)

    return rows.mapInPandas(streamed, schema)


def _pieces(batches: Batches, groups: Sequence[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The batches cut where a group ends, each piece with its group."""
    for batch in batches:
        new = np.ones(len(batch), bool)
        if len(batch) > 1:
            new[1:] = np.any([batch[g].to_numpy()[1:] != batch[g].to_numpy()[:-1] for g in groups], axis=0)
        starts = [*np.flatnonzero(new), len(batch)]
        for start, end in zip(starts, starts[1:]):
            rows = batch.iloc[start:end].reset_index(drop=True)
            yield tuple(rows[g].iloc[0] for g in groups), rows


def stream_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    input_column: str,
    output_column: str,
    function: Callable[[Series], object],
    result_type: str = "double",
    across_frames: bool = False,
) -> DataFrame:
    """``aggregate_groups`` for a function that takes a group's series piece by piece, in order."""
    kept = [c for c in df.columns if c not in (input_column, output_column)]

    def aggregate(batches: Batches) -> Batches:
        first = next(batches)
        result = function(chain([first[input_column]], (b[input_column] for b in batches)))
        yield first[kept].head(1).assign(**{output_column: [result]})

    schema = f"{_schema_of(df, kept)}, `{output_column}` {result_type}"
    return stream_groups(df, keys, aggregate, schema, across_frames)


def stream_assign(
    df: DataFrame,
    keys: Sequence[str],
    input_column: str,
    output_column: str,
    function: Callable[[Series], Series],
    result_type: str = "double",
    across_frames: bool = False,
) -> DataFrame:
    """A column from a function that makes of each piece of a group's series one as long, in order.

    The function may look ahead; batches wait until it has given their values.
    """
    kept = [c for c in df.columns if c != output_column]

    def assign(batches: Batches) -> Batches:
        waiting: deque[pd.DataFrame] = deque()

        def pieces() -> Series:
            for batch in batches:
                waiting.append(batch)
                yield batch[input_column]

        for values in function(pieces()):
            yield waiting.popleft()[kept].assign(**{output_column: values.to_numpy()})
        if waiting:
            raise ValueError("the function gave fewer series than it took")

    schema = f"{_schema_of(df, kept)}, `{output_column}` {result_type}"
    return stream_groups(df, keys, assign, schema, across_frames)


def stream_raw(
    df: DataFrame,
    keys: Sequence[str],
    output_column: str,
    function: Callable[[Batches], dict],
    result_type: str,
    across_frames: bool = False,
) -> DataFrame:
    """The group's keys and the object that a function makes of the group's batches, as a struct."""
    groups = group_keys(keys, across_frames)

    def raw(batches: Batches) -> Batches:
        first = next(batches)
        result = function(chain([first], batches))
        yield pd.DataFrame({k: [first[k].iloc[0]] for k in groups} | {output_column: [result]})

    return stream_groups(df, keys, raw, f"{_schema_of(df, groups)}, `{output_column}` {result_type}", across_frames)
