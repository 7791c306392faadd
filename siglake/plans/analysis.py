"""Registered queries: transforms, metrics, summaries and comparison."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from siglake.functions.numbers import truncated_bin
from siglake.model import FRAME, nan_to_null
from siglake.operators import columns, compare, extract, frames, metrics, query, ranking, summary
from siglake.plans import fixtures
from siglake.plans.registry import r6, register, rounded
from siglake.plans.selection import AOI_PATTERN, PPE_PATTERN
from siglake.session import shared_folder
from siglake.sources import arrow_files, sinks

RATE_KEYS = ["v2x_rate", "moduleName"]


def cbr(spark, d):
    """The channel signal with its tags, one frame per file."""
    df = extract.extract_signal(fixtures.results(spark, d, "signals"), "cbr:vector", "cbr")
    return df.drop("value", "var", "runnumber", "sumocfgname")


def ppe(spark, d):
    """The pairs of scalars with kind and object read from their name."""
    df = extract.extract_scalars_like(
        fixtures.results(spark, d, "scalars"), "ppe_for_%", "ppe", PPE_PATTERN, "ppe_{object}_{kind}"
    )
    df = columns.map_column(df, "variable", "type", metrics.last_field)
    df = columns.map_column(df, "variable", "objId", lambda v: metrics.numbered_field(v, 1))
    return df.select("_frame", "_row", "source_file", "moduleName", "objId", "type", "ppe")


# Transforms ------------------------------------------------------------------------------

_FIRST = "arg_min({column}, _row) AS {column}"
_TEMPLATE = ", ".join(
    _FIRST.format(column=c)
    for c in ("simtimeRaw", "eventNumber", "repetition", "configname", "experiment", "prefix")
)


@register(f"""
SELECT source_file, v2x_rate, moduleName, min(_row) AS _row, {_TEMPLATE}, round(avg(cbr), 10) AS cbr_mean
FROM f_cbr GROUP BY source_file, v2x_rate, moduleName""")
def group_mean(spark, d):
    """Mean per rate and module of each file, on the first row of the group."""
    means = frames.aggregate_groups(cbr(spark, d), RATE_KEYS, "cbr", "cbr_mean", "mean")
    return rounded(means.drop(FRAME), "cbr_mean", digits=10)


@register("""
SELECT v2x_rate, moduleName, arg_min(source_file, (source_file, _row)) AS source_file,
  arg_min(_row, (source_file, _row)) AS _row, arg_min(simtimeRaw, (source_file, _row)) AS simtimeRaw,
  round(avg(cbr), 10) AS cbr_mean
FROM f_cbr GROUP BY v2x_rate, moduleName""")
def group_mean_across_frames(spark, d):
    kept = ["_frame", "_row", "source_file", "simtimeRaw", "cbr", *RATE_KEYS]
    means = frames.aggregate_groups(
        cbr(spark, d).select(kept), RATE_KEYS, "cbr", "cbr_mean", "mean", across_frames=True
    )
    return rounded(means.drop(FRAME), "cbr_mean", digits=10)


@register("""
SELECT source_file, moduleName, min(_row) AS _row, round(median(cbr), 10) AS cbr_median
FROM f_cbr GROUP BY source_file, moduleName""")
def group_median(spark, d):
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")
    medians = frames.aggregate_groups(rows, ["moduleName"], "cbr", "cbr_median", "median")
    return rounded(medians.drop(FRAME), "cbr_median", digits=10)


def _with_gaps(spark, d):
    """The channel signal with every seventh value missing, as NULL or NaN in turn."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")
    gap = F.when(F.col("_row") % 14 == 0, F.lit(None)).when(F.col("_row") % 7 == 0, F.lit(float("nan")))
    return rows.withColumn("cbr", F.when(F.col("_row") % 7 == 0, gap).otherwise(F.col("cbr")))


@register("""
SELECT source_file, moduleName, min(_row) AS _row,
  round(median(cbr) FILTER (WHERE _row % 7 <> 0), 10) AS cbr_median
FROM f_cbr GROUP BY source_file, moduleName""")
def group_median_missing(spark, d):
    """Missing values have no rank; a group of nothing else has no median."""
    medians = frames.aggregate_groups(_with_gaps(spark, d), ["moduleName"], "cbr", "cbr_median", "median")
    return rounded(medians.drop(FRAME), "cbr_median", digits=10)


@register("""
SELECT source_file, coalesce(place, -1) AS _row,
  row_number() OVER (PARTITION BY source_file ORDER BY place NULLS FIRST) - 1 AS nth
FROM (SELECT source_file, CASE WHEN _row % 7 <> 0 THEN _row END AS place FROM f_cbr)""")
def row_ordinal_missing(spark, d):
    """Rows without the ordered column come first, in any order."""
    at = F.when(F.col("_row") % 7 != 0, F.col("_row"))
    rows = cbr(spark, d).select("source_file", at.alias("_row"))
    numbered = ranking.row_ordinal(rows, ["source_file"], "_row", "nth")
    return numbered.withColumn("_row", F.coalesce("_row", F.lit(-1)))


@register("""
SELECT source_file, moduleName, min(_row) AS _row, round(max(cbr) - min(cbr), 10) AS spread
FROM f_cbr GROUP BY source_file, moduleName""")
def group_pandas_aggregate(spark, d):
    """A function from a group's series to a number."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")
    spread = frames.aggregate_groups_pandas(rows, ["moduleName"], "cbr", "spread", lambda s: s.max() - s.min())
    return rounded(spread.drop(FRAME), "spread", digits=10)


@register("""
SELECT source_file, moduleName, first(cbr ORDER BY _row) AS first_cbr, last(cbr ORDER BY _row) AS last_cbr,
  count(*) AS n FROM f_cbr GROUP BY source_file, moduleName""")
def group_pandas_apply(spark, d):
    """A function from a group's rows, in order, to a table."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")

    def ends(group: pd.DataFrame) -> pd.DataFrame:
        found = group[["source_file", "moduleName"]].head(1)
        return found.assign(first_cbr=group.cbr.iloc[0], last_cbr=group.cbr.iloc[-1], n=len(group))

    schema = "source_file string, moduleName string, first_cbr double, last_cbr double, n long"
    return frames.apply_groups_pandas(rows, ["moduleName"], ends, schema)


@register("""
SELECT source_file, _row, moduleName, cbr,
  round(cbr - lag(cbr) OVER (PARTITION BY source_file, moduleName ORDER BY _row), 10) AS step
FROM f_cbr""")
def group_pandas_series(spark, d):
    """A function from a group's series to a series as long."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")
    steps = frames.assign_groups_pandas(rows, ["moduleName"], "cbr", "step", lambda s: s.diff())
    return rounded(nan_to_null(steps.drop(FRAME)), "step", digits=10)


@register("""
SELECT source_file, moduleName, count(*) AS n, round(max(cbr), 10) AS top,
  count(*) FILTER (WHERE cbr > 0.9) AS n_high
FROM f_cbr GROUP BY source_file, moduleName""")
def apply_groups_raw(spark, d):
    """Keys and an object with a list, flattened for the comparison."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")

    def describe(group: pd.DataFrame) -> dict:
        return {"n": len(group), "top": float(group.cbr.max()), "high": group.cbr[group.cbr > 0.9].tolist()}

    raw = frames.apply_groups_raw(
        rows, ["moduleName"], "found", describe, "struct<n:bigint,top:double,high:array<double>>"
    )
    return raw.select(
        F.col(FRAME).alias("source_file"), "moduleName", "found.n", F.round("found.top", 10).alias("top"),
        F.size("found.high").cast("bigint").alias("n_high"),
    )


@register("""
SELECT source_file, moduleName, round(avg(cbr), 8) AS mean_cbr FROM f_cbr GROUP BY source_file, moduleName""")
def group_pandas_fold(spark, d):
    """A mean from states that are merged before they move."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")
    means = frames.fold_groups_pandas(
        rows,
        ["moduleName"],
        "mean_cbr",
        lambda part: [float(part.cbr.sum()), float(part.cbr.count())],
        lambda a, b: [a[0] + b[0], a[1] + b[1]],
        lambda state: state[0] / state[1],
        "array<double>",
    )
    return means.select(F.col(FRAME).alias("source_file"), "moduleName", F.round("mean_cbr", 8).alias("mean_cbr"))


@register("""
SELECT source_file, moduleName, min(_row) AS _row, round(max(top - cbr), 10) AS drawdown
FROM (SELECT *, max(cbr) OVER (PARTITION BY source_file, moduleName ORDER BY _row) AS top FROM f_cbr)
GROUP BY source_file, moduleName""")
def group_stream_aggregate(spark, d):
    """The deepest fall below the highest value so far, from series that come in pieces."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")

    def drawdown(pieces) -> float:
        top, deepest = float("-inf"), 0.0
        for values in pieces:
            tops = values.cummax().clip(lower=top)
            top, deepest = tops.iloc[-1], max(deepest, (tops - values).max())
        return deepest

    found = frames.stream_aggregate(rows, ["moduleName"], "cbr", "drawdown", drawdown)
    return rounded(found.drop(FRAME), "drawdown", digits=10)


@register("""
SELECT source_file, _row, moduleName, cbr,
  round(cbr - lag(cbr) OVER (PARTITION BY source_file, moduleName ORDER BY _row), 10) AS step
FROM f_cbr""")
def group_stream_series(spark, d):
    """Steps between values, also across the pieces of a group."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")

    def steps(pieces):
        last = None
        for values in pieces:
            yield values.diff().fillna(float("nan") if last is None else values.iloc[0] - last)
            last = values.iloc[-1]

    found = frames.stream_assign(rows, ["moduleName"], "cbr", "step", steps)
    return rounded(nan_to_null(found.drop(FRAME)), "step", digits=10)


@register("""
SELECT source_file, moduleName, _row, cbr FROM (
  SELECT *, max(cbr) OVER (PARTITION BY source_file, moduleName ORDER BY _row
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM f_cbr)
WHERE top IS NULL OR cbr > top""")
def group_stream_apply(spark, d):
    """Rows whose value exceeds all before it in the group."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")

    def records(batches):
        top = float("-inf")
        for batch in batches:
            tops = batch.cbr.cummax().clip(lower=top)
            yield batch.loc[batch.cbr > tops.shift(fill_value=top), ["source_file", "moduleName", "_row", "cbr"]]
            top = tops.iloc[-1]

    return frames.stream_groups(
        rows, ["moduleName"], records, "source_file string, moduleName string, _row bigint, cbr double"
    )


@register("""
SELECT source_file, moduleName, count(*) AS n, first(cbr ORDER BY _row) AS first_cbr, last(cbr ORDER BY _row) AS last_cbr
FROM f_cbr GROUP BY source_file, moduleName""")
def group_stream_raw(spark, d):
    """Keys and an object made of a group's batches."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")

    def ends(batches) -> dict:
        n, first, last = 0, None, None
        for batch in batches:
            first = batch.cbr.iloc[0] if first is None else first
            n, last = n + len(batch), batch.cbr.iloc[-1]
        return {"n": n, "first_cbr": first, "last_cbr": last}

    raw = frames.stream_raw(rows, ["moduleName"], "found", ends, "struct<n:bigint,first_cbr:double,last_cbr:double>")
    return raw.select(F.col(FRAME).alias("source_file"), "moduleName", "found.*")


@register("""
SELECT source_file, moduleName, count(*) AS n, round(sum(cbr), 6) AS total,
  round(stddev_samp(cbr), 6) AS spread FROM f_cbr GROUP BY source_file, moduleName""")
def group_raw(spark, d):
    """Keys and a struct of results, without a template row; flattened for the comparison."""
    raw = frames.aggregate_groups_raw(
        cbr(spark, d),
        ["moduleName"],
        "result",
        {"n": F.count(F.lit(1)), "total": r6(F.sum("cbr")), "spread": r6(F.stddev_samp("cbr"))},
    )
    return raw.select(F.col(FRAME).alias("source_file"), "moduleName", "result.*")


@register("""
SELECT source_file, moduleName, min(_row) AS _row,
  round(corr(cbr, eventNumber::DOUBLE), 6) AS coupling
FROM f_cbr GROUP BY source_file, moduleName""")
def group_function(spark, d):
    """A group result computed from several columns."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr", "eventNumber")
    coupled = frames.apply_groups(
        rows, ["moduleName"], "cbr", "coupling", lambda: F.corr("cbr", "eventNumber")
    )
    return rounded(coupled.drop(FRAME, "eventNumber"), "coupling")


@register("""
SELECT source_file, _row, moduleName, cbr,
  round(cbr - avg(cbr) OVER (PARTITION BY source_file, moduleName), 10) AS offset_cbr
FROM f_cbr""")
def group_assign(spark, d):
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "cbr")
    assigned = frames.assign_groups(
        rows, ["moduleName"], "offset_cbr", {"mean": F.avg("cbr")}, F.col("cbr") - F.col("mean")
    )
    return rounded(assigned.drop(FRAME), "offset_cbr", digits=10)


@register("""
SELECT source_file, _row, cbr, round(cbr * 100, 6) AS percent,
  CASE WHEN cbr > 0.5 THEN 'busy' ELSE 'idle' END AS state FROM f_cbr""")
def apply_frame(spark, d):
    def states(df):
        return df.withColumns(
            {
                "percent": F.col("cbr") * 100,
                "state": F.when(F.col("cbr") > 0.5, "busy").otherwise("idle"),
            }
        )

    rows = cbr(spark, d).select("source_file", "_row", "cbr")
    return rounded(frames.apply_frame(rows, states), "percent")


@register("SELECT source_file, _row, moduleName, round(1.0 - statMin, 6) AS loss FROM f_statistic")
def complement(spark, d):
    rows = fixtures.statistics(spark, d).select("source_file", "_row", "moduleName", "statMin")
    mapped = columns.map_column(rows, "statMin", "loss", metrics.complement)
    return rounded(mapped.drop("statMin"), "loss")


@register("SELECT source_file, source_file AS _frame, _row, moduleName, simtimeRaw, cbr FROM f_cbr")
def read_written_arrow(spark, d):
    """A dataset written as Arrow files, one folder per frame, and read back."""
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "moduleName", "simtimeRaw", "cbr")
    folder = f"{shared_folder(spark).rstrip('/')}/arrow-{uuid.uuid4().hex}"
    sinks.save(rows, folder, "arrow", separate=True)
    return arrow_files.read_arrow_folder(spark, folder)


# Metrics ---------------------------------------------------------------------------------


@register("""
SELECT source_file, v2x_rate, moduleName, min(_row) AS _row, round(avg(gap) / 1e9, 6) AS update_interval
FROM (SELECT *, simtimeRaw - lag(simtimeRaw) OVER (
        PARTITION BY source_file, v2x_rate, moduleName ORDER BY simtimeRaw) AS gap FROM f_cbr)
GROUP BY source_file, v2x_rate, moduleName""")
def update_interval(spark, d):
    rows = cbr(spark, d).select("_frame", "_row", "source_file", "simtimeRaw", "cbr", *RATE_KEYS)
    mean = metrics.update_interval(rows, RATE_KEYS, "cbr")
    seconds = F.col("update_interval") / 1e9
    return rounded(mean.drop(FRAME, "simtimeRaw").withColumn("update_interval", seconds), "update_interval")


@register(r"""
SELECT source_file, moduleName, variable, min(_row) AS _row, round(sum(value) /
    (max(simtimeRaw) * 1e-9 - regexp_extract(variable, '_(\d+)$', 1)::BIGINT), 6) AS mean_aoi
FROM (SELECT *, regexp_replace(regexp_extract(vectorName, 'coordination_(aoi_.*):', 1), 'x', '') AS variable
      FROM f_signal WHERE vectorName LIKE 'coordination%')
GROUP BY source_file, moduleName, variable""")
def age_of_information(spark, d):
    df = extract.extract_like(
        fixtures.results(spark, d, "signals"), "coordination_aoi_%", "aoi", AOI_PATTERN, "aoi_{index}_{gentime}"
    )
    rows = df.select("_frame", "_row", "source_file", "moduleName", "variable", "simtimeRaw", "aoi")
    mean = metrics.age_of_information(rows, ["moduleName", "variable"], "aoi")
    return rounded(mean.drop(FRAME, "simtimeRaw"), "mean_aoi")


@register(r"""
SELECT source_file, moduleName, regexp_extract(scalarName, '_(\d+):', 1)::BIGINT AS "objId",
  min(_row) AS _row, arg_min(split_part(scalarName, ':', 2), _row) AS type,
  round(max(scalarValue) FILTER (WHERE scalarName LIKE '%:sum')
    / max(scalarValue) FILTER (WHERE scalarName LIKE '%:count'), 6) AS mean_ppe
FROM f_scalar GROUP BY source_file, moduleName, regexp_extract(scalarName, '_(\d+):', 1)
HAVING count(*) = 2""")
def sum_over_count(spark, d):
    mean = metrics.sum_over_count(ppe(spark, d), ["moduleName", "objId"], "ppe", "mean_ppe")
    return rounded(mean.drop(FRAME), "mean_ppe")


@register(r"""
SELECT source_file, runName, regexp_extract(source_file, '([a-z]+)_([0-9]+)\.([a-z]+)', 1) AS kind,
  regexp_extract(source_file, '([a-z]+)_([0-9]+)\.([a-z]+)', 2) AS number,
  regexp_extract(source_file, '([a-z]+)_([0-9]+)\.([a-z]+)', 3) AS suffix,
  regexp_extract(source_file, '[0-9]+', 0) || ' of ' || runName AS label
FROM f_run""")
def path_features(spark, d):
    rows = fixtures.runs(spark, d).select("source_file", "runName")
    pattern = r"(?P<kind>[a-z]+)_(?P<number>[0-9]+)\.(?P<suffix>[a-z]+)"
    features = metrics.path_features(rows, "source_file", pattern)
    return features.withColumn("label", F.concat("number", F.lit(" of "), "runName"))


@register("""
SELECT bucket, count(*) AS n, round(avg(value), 6) AS mean
FROM (SELECT trunc(simtimeRaw / 1e17) / 10 AS bucket, value FROM f_signal) GROUP BY bucket""")
def time_bucket(spark, d):
    """Mean per tumbling bucket of simulation time."""
    rows = metrics.time_bucket(fixtures.signals(spark, d), "bucket", bucket=1e17)
    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("value")).alias("mean")
    )


@register(r"""
SELECT source_file, _row, split_part(scalarName, ':', 2) AS type,
  regexp_extract(scalarName, '_(\d+):', 1)::BIGINT AS "objId" FROM f_scalar""")
def split_variable(spark, d):
    return ppe(spark, d).select("source_file", "_row", "type", "objId")


@register("""
SELECT source_file, CASE WHEN attrValue LIKE '%MCO%' THEN 'MCO' ELSE 'SCO' END AS prefix
FROM f_runAttr WHERE attrName = 'configname'""")
def relabel(spark, d):
    names = fixtures.run_attrs(spark, d).where("attrName = 'configname'")
    renamed = columns.map_column(
        names, "attrValue", "prefix", lambda v: metrics.relabel(v, "MCO", "SCO")
    )
    return renamed.select("source_file", "prefix")


# Summaries -------------------------------------------------------------------------------


@register("""
SELECT prefix, v2x_rate, round(avg(cbr), 10) AS mean, round(stddev_samp(cbr), 6) AS sd, count(*) AS n
FROM f_cbr GROUP BY prefix, v2x_rate""")
def line_summary(spark, d):
    lines = summary.line_summary(cbr(spark, d), "v2x_rate", "cbr", ["prefix"])
    return rounded(lines, "mean", digits=10).withColumn("sd", r6(F.col("sd")))


@register("SELECT experiment, simtimeRaw, cbr FROM f_cbr")
def scatter_points(spark, d):
    return summary.points(cbr(spark, d), "simtimeRaw", "cbr", ["experiment"])


@register("SELECT event_type, user_id, value FROM events")
def strip_points(spark, d):
    return summary.points(fixtures.events(spark, d), "user_id", "value", ["event_type"])


_MEANS = """
SELECT {x}, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, count(*) AS n,
  round(avg(value) - 1.96 * stddev_samp(value) / sqrt(count(*)), 6) AS low,
  round(avg(value) + 1.96 * stddev_samp(value) / sqrt(count(*)), 6) AS high
FROM events GROUP BY {x}"""


@register(_MEANS.format(x="event_type"))
def bar_means(spark, d):
    means = summary.category_means(fixtures.events(spark, d), "event_type", "value")
    return rounded(means, "mean", "sd", "low", "high")


@register(_MEANS.format(x="event_type, user_id"))
def point_means(spark, d):
    means = summary.category_means(fixtures.events(spark, d), "user_id", "value", ["event_type"])
    return rounded(means, "mean", "sd", "low", "high")


@register("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY event_type, user_id")
def category_counts(spark, d):
    return summary.category_counts(fixtures.events(spark, d), "user_id", ["event_type"])


@register("""
SELECT DISTINCT event_type, value,
  round(cume_dist() OVER (PARTITION BY event_type ORDER BY value), 6) AS proportion FROM events""")
def ecdf(spark, d):
    return rounded(summary.ecdf(fixtures.events(spark, d), "value", ["event_type"]), "proportion")


@register("""
WITH e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 25e0 AS w FROM events)
SELECT event_type, bin, round(any_value(lo) + bin * any_value(w), 6) AS "left", count(*) AS n
FROM (SELECT event_type, least(floor((value - lo) / w), 24)::INTEGER AS bin, lo, w FROM events, e)
GROUP BY event_type, bin""")
def histogram(spark, d):
    counts = summary.histogram(fixtures.events(spark, d), "value", 25, ["event_type"])
    return rounded(counts, "left")


_BOX = """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type),
b AS (SELECT e.event_type, value, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo,
    q3 + 1.5 * (q3 - q1) AS hi FROM events e JOIN q ON e.event_type = q.event_type)
"""


@register(_BOX + """
SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  count(*) AS n, round(avg(value), 6) AS mean,
  round(least(min(value) FILTER (WHERE value >= lo), q1), 6) AS whisker_low,
  round(greatest(max(value) FILTER (WHERE value <= hi), q3), 6) AS whisker_high,
  count(*) FILTER (WHERE value < lo OR value > hi) AS outliers, round(q3 - q1, 6) AS iqr,
  round(median - 1.57 * (q3 - q1) / sqrt(count(*)), 6) AS notch_low,
  round(median + 1.57 * (q3 - q1) / sqrt(count(*)), 6) AS notch_high
FROM b GROUP BY event_type, q1, median, q3""")
def box_stats(spark, d):
    boxes = summary.box_stats(fixtures.events(spark, d), "value", ["event_type"])
    return rounded(boxes, *[c for c in boxes.columns if c not in ("event_type", "n", "outliers")])


@register(_BOX + "SELECT event_type, value FROM b WHERE value < lo OR value > hi")
def box_outliers(spark, d):
    return summary.box_outliers(fixtures.events(spark, d), "value", ["event_type"])


@register("""
WITH k AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.5) AS median,
    greatest(floor(log2(count(*))) - 3, 1)::INTEGER AS k FROM events GROUP BY event_type),
l AS (SELECT event_type, n, median, unnest(range(1, k + 1))::INTEGER AS level FROM k),
r AS (SELECT event_type, value,
    row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS r FROM events),
p AS (SELECT *, pow(0.5, level + 1) * (n - 1) AS a, (1 - pow(0.5, level + 1)) * (n - 1) AS z FROM l)
SELECT p.event_type, p.n, round(p.median, 12) AS median, level,
  round(any_value(lo.value) + any_value(a - floor(a)) * (any_value(lo1.value) - any_value(lo.value)), 12) AS low,
  round(any_value(hi.value) + any_value(z - floor(z)) * (any_value(hi1.value) - any_value(hi.value)), 12) AS high
FROM p JOIN r lo ON lo.event_type = p.event_type AND lo.r = floor(a)::BIGINT
JOIN r lo1 ON lo1.event_type = p.event_type AND lo1.r = ceil(a)::BIGINT
JOIN r hi ON hi.event_type = p.event_type AND hi.r = floor(z)::BIGINT
JOIN r hi1 ON hi1.event_type = p.event_type AND hi1.r = ceil(z)::BIGINT
GROUP BY p.event_type, p.n, p.median, level""")
def letter_values(spark, d):
    letters = summary.letter_values(fixtures.events(spark, d), "value", ["event_type"])
    # Interpolated hundredths often end in a 5 further up.
    return rounded(letters, "median", "low", "high", digits=12)


@register("""
SELECT source_file, simtimeRaw, series, value FROM (
  SELECT source_file, simtimeRaw, 'posX' AS series, value FROM f_signal WHERE vectorName = 'posX:vector'
  UNION ALL SELECT source_file, simtimeRaw, 'cbr', value FROM f_signal WHERE vectorName = 'cbr:vector')
WHERE value IS NOT NULL""")
def multi_series(spark, d):
    """Two signals of unlike datasets laid over one time axis."""
    sides = [
        query.signals_by_name(fixtures.signals(spark, d), name, alias, moduleName=False).withColumn(
            FRAME, F.col("source_file")
        )
        for name, alias in (("posX:vector", "posX"), ("cbr:vector", "cbr"))
    ]
    return summary.multi_series(frames.concat(sides), "simtimeRaw", ["posX", "cbr"], ["source_file"])


@register("""
SELECT experiment || '|' || prefix AS facet, count(*) AS n FROM f_cbr GROUP BY experiment, prefix""")
def facet_counts(spark, d):
    rows = cbr(spark, d).select(summary.facet_key(["experiment", "prefix"]))
    return summary.category_counts(rows, "facet")


@register("""
WITH s AS (SELECT event_type, count(*) AS n, min(value) AS lo, max(value) AS hi,
    stddev_samp(value) * pow(count(*), -0.2) AS bw FROM events GROUP BY event_type),
g AS (SELECT *, unnest(range(0, 100))::INTEGER AS point FROM s),
p AS (SELECT *, (lo - 2 * bw) + point * ((hi - lo + 4 * bw) / 99) AS grid FROM g)
SELECT p.event_type, point, round(any_value(grid), 6) AS grid,
  round(sum(exp(-0.5 * ((grid - value) / bw) * ((grid - value) / bw)))
    / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 6) AS density
FROM p JOIN events e ON e.event_type = p.event_type GROUP BY p.event_type, point""")
def density_grid(spark, d):
    grid = summary.density_grid(fixtures.events(spark, d), "value", ["event_type"])
    return rounded(grid, "grid", "density")


_POSITION_CELLS = """
SELECT x.source_file, trunc(x.value / 500) * 500 + 0.0 AS "posX",
  {sign} trunc(y.value / 500) * 500 + 0.0 AS "posY", v.value AS cbr
FROM f_signal x JOIN f_signal y ON x.source_file = y.source_file AND x.eventNumber = y.eventNumber
JOIN f_signal v ON v.source_file = x.source_file AND v.eventNumber = x.eventNumber
WHERE x.vectorName = 'posX:vector' AND y.vectorName = 'posY:vector' AND v.vectorName = 'cbr:vector'"""


def _measured_positions(spark, d):
    return query.signals_with_position(
        fixtures.signals(spark, d), "posX:vector", "posY:vector", "cbr:vector", value_label="cbr"
    )


@register(f"""
SELECT "posX", "posY", round(avg(cbr), 10) AS cbr FROM ({_POSITION_CELLS.format(sign="")})
GROUP BY "posX", "posY" """)
def heat_cells(spark, d):
    cells = summary.heat_cells(_measured_positions(spark, d), "posX", "posY", "cbr", 500.0)
    return rounded(cells, "cbr", digits=10)


@register(f"""
WITH c AS (SELECT "posX", "posY", avg(cbr) AS cbr FROM ({_POSITION_CELLS.format(sign="")})
  GROUP BY "posX", "posY")
SELECT x."posX", y."posY", round(coalesce(cbr, 0), 10) AS cbr
FROM (SELECT DISTINCT "posX" FROM c) x CROSS JOIN (SELECT DISTINCT "posY" FROM c) y
LEFT JOIN c ON c."posX" = x."posX" AND c."posY" = y."posY" """)
def heat_grid(spark, d):
    grid = summary.heat_grid(_measured_positions(spark, d), "posX", "posY", "cbr", 500.0)
    return rounded(grid, "cbr", digits=10)


@register(f"""
WITH c AS (SELECT source_file, "posX", "posY", avg(cbr) AS cbr
  FROM ({_POSITION_CELLS.format(sign="-")}) GROUP BY source_file, "posX", "posY")
SELECT x.source_file, x."posX", y."posY", round(coalesce(cbr, 0), 10) AS cbr
FROM (SELECT DISTINCT source_file, "posX" FROM c) x
JOIN (SELECT DISTINCT source_file, "posY" FROM c) y ON x.source_file = y.source_file
LEFT JOIN c ON c.source_file = x.source_file AND c."posX" = x."posX" AND c."posY" = y."posY" """)
def heat_grid_by(spark, d):
    """One picture per file, the y axis turned over."""
    grid = summary.heat_grid(
        _measured_positions(spark, d), "posX", "posY", "cbr", 500.0, ["source_file"], negate_y=True
    )
    return rounded(grid, "cbr", digits=10)


@register("""
SELECT trunc(statMin / 300) * 300 + 0.0 AS bin, count(*) AS n FROM f_statistic GROUP BY 1""")
def truncated_bins(spark, d):
    """Bins cut toward zero."""
    bins = fixtures.statistics(spark, d).select(truncated_bin(F.col("statMin"), 300.0).alias("bin"))
    return summary.category_counts(bins, "bin")


# Comparison ------------------------------------------------------------------------------


def _axis(spark, d, name):
    return query.signals_by_name(
        fixtures.signals(spark, d), name, eventNumber=True, simtimeRaw=False
    ).withColumn(FRAME, F.col("source_file"))


@register("""
SELECT 0 AS pair, true AS equal UNION ALL
SELECT 1, coalesce(bool_and(coalesce(x.value = y.value, false)), true)
FROM (SELECT * FROM f_signal WHERE vectorName = 'posX:vector') x
FULL JOIN (SELECT * FROM f_signal WHERE vectorName = 'posY:vector') y
ON x.source_file = y.source_file AND x.eventNumber = y.eventNumber""")
def frames_equal(spark, d):
    x, y = _axis(spark, d, "posX:vector"), _axis(spark, d, "posY:vector")
    return compare.frames_equal([x, x, y], on=["source_file", "eventNumber"])


@register("""
SELECT x.source_file, x.eventNumber, 'value' AS "column", round(x.value, 6) AS self,
  round(y.value, 6) AS other
FROM f_signal x JOIN f_signal y ON x.source_file = y.source_file AND x.eventNumber = y.eventNumber
WHERE x.vectorName = 'posX:vector' AND y.vectorName = 'posY:vector' AND x.value <> y.value""")
def frames_diff(spark, d):
    x, y = _axis(spark, d, "posX:vector"), _axis(spark, d, "posY:vector")
    cells = compare.frames_diff(x, y, on=["source_file", "eventNumber"])
    return cells.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("self", "other")})


@register("""
WITH a AS (SELECT source_file, moduleName, value FROM f_signal WHERE vectorName = 'cbr:vector'),
b AS (SELECT source_file, moduleName, round(value, 1) AS value FROM f_signal
      WHERE vectorName = 'cbr:vector')
SELECT *, count(*) AS n FROM (
  SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
  UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) GROUP BY ALL""")
def rows_differ(spark, d):
    """Measured against rounded values, regardless of row order."""
    left = _axis(spark, d, "cbr:vector").select("source_file", "moduleName", "value")
    return compare.rows_differ(left, left.withColumn("value", F.round("value", 1)))


@register("""
SELECT source_file, _row, row_number() OVER (PARTITION BY source_file ORDER BY _row) - 1 AS _ordinal
FROM f_signal""")
def row_ordinal(spark, d):
    rows = fixtures.signals(spark, d).withColumn(FRAME, F.col("source_file"))
    return compare.with_ordinal(rows).select("source_file", "_row", "_ordinal")


@register("SELECT source_file, row_number() OVER (ORDER BY source_file) - 1 AS nth FROM f_run")
def frame_ordinal(spark, d):
    files = fixtures.runs(spark, d).select("source_file")
    return ranking.global_ordinal(files, [F.col("source_file")], "nth")
