"""Registered queries: selecting, joining, tagging and extracting."""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import functions as F

from siglake.functions.numbers import simtime_seconds
from siglake.functions.text import strip
from siglake.operators import columns, extract, frames, joins, query, tags
from siglake.plans import fixtures
from siglake.plans.registry import register, rounded
from siglake.session import not_broadcast_if_large, shared_folder, written
from siglake.sources import files, layouts
from siglake.sources.results import join_signals, sql_per_file, unify_parameters
from siglake.sources.sinks import output_name

AREA = (0.0, 500.0, 5000.0, 3000.0)
AOI_PATTERN = r"coordination_aoi_(?P<index>\d+)_(?P<gentime>\d+)"
PPE_PATTERN = r"ppe_for_ObjectID_(?P<object>[0-9]+):(?P<kind>[a-z]+)"


# Signals, scalars and statistics ---------------------------------------------------------


@register("""
SELECT source_file, _row, moduleName, simtimeRaw, eventNumber, value AS cbr
FROM f_signal WHERE vectorName = 'cbr:vector'""")
def signal_by_name(spark, d):
    return query.signals_by_name(fixtures.signals(spark, d), "cbr:vector", "cbr", eventNumber=True)


@register("""
SELECT source_file, _row, vectorName, moduleName, simtimeRaw, value AS aoi
FROM f_signal WHERE vectorName ILIKE 'COORDINATION_aoi_1%'""")
def signal_like(spark, d):
    return query.signals_like(
        fixtures.signals(spark, d), "COORDINATION_aoi_1%", "aoi", vectorName=True
    )


@register("""
SELECT source_file, _row, moduleName, simtimeRaw, value
FROM f_signal WHERE vectorName = 'cbr:vector' AND moduleName ILIKE '%NODE[1%'""")
def signal_for_module(spark, d):
    return query.signals_for_module(fixtures.signals(spark, d), "cbr:vector", "%NODE[1%")


@register("""
SELECT source_file, _row, vectorName, value AS high
FROM f_signal WHERE vectorName LIKE 'pos%' AND value > 4000""")
def signal_where(spark, d):
    return query.signals_where(
        fixtures.signals(spark, d), "vectorName LIKE 'pos%' AND value > 4000", "high",
        vectorName=True, moduleName=False, simtimeRaw=False,
    )


@register("SELECT DISTINCT vectorName FROM f_signal")
def signal_names(spark, d):
    return query.signal_names(fixtures.signals(spark, d))


@register("""
SELECT d.source_file, d.vectorId, d._row, eventNumber, simtimeRaw, value, moduleName, vectorName
FROM f_vectorData d JOIN f_vector v ON d.source_file = v.source_file AND d.vectorId = v.vectorId""")
def signal_join(spark, d):
    return join_signals(fixtures.vectors(spark, d), fixtures.vector_data(spark, d))


@register("""
SELECT s.source_file, s._row, moduleName, value,
  round(simtimeRaw * pow(10e0, simtimeExp), 6) AS simtime
FROM f_signal s JOIN f_run r ON s.source_file = r.source_file WHERE vectorName = 'posX:vector'""")
def signal_seconds(spark, d):
    """Times in seconds by the exponent each run recorded."""
    rows = query.signals_by_name(fixtures.signals(spark, d), "posX:vector")
    exponents = fixtures.runs(spark, d).select("source_file", "simtimeExp")
    timed = rows.join(exponents, "source_file").withColumn(
        "simtime", simtime_seconds(F.col("simtimeRaw"), F.col("simtimeExp"))
    )
    return rounded(timed.drop("simtimeRaw", "simtimeExp"), "simtime")


@register("""
SELECT source_file, _row, runId, moduleName, scalarName, scalarId, scalarValue FROM f_scalar""")
def scalar_table(spark, d):
    return query.scalars_where(
        fixtures.scalars(spark, d), F.lit(True), scalarName=True, scalarId=True
    )


@register("""
SELECT source_file, _row, runId, moduleName, scalarValue AS ppe
FROM f_scalar WHERE scalarName = 'ppe_for_ObjectID_7:sum'""")
def scalar_by_name(spark, d):
    return query.scalars_by_name(fixtures.scalars(spark, d), "ppe_for_ObjectID_7:sum", "ppe")


@register("""
SELECT source_file, _row, runId, moduleName, scalarName, scalarValue
FROM f_scalar WHERE scalarName ILIKE 'PPE%:COUNT'""")
def scalar_like(spark, d):
    return query.scalars_like(fixtures.scalars(spark, d), "PPE%:COUNT", scalarName=True)


_STATISTICS = """
SELECT source_file, _row, statId, runId, moduleName, statName, statCount,
  round(statMean, 6) AS statMean, round(statStddev, 6) AS statStddev,
  round(statSum, 6) AS statSum, statMin, statMax FROM f_statistic"""


@register(_STATISTICS)
def statistic_table(spark, d):
    rows = query.statistics_where(fixtures.statistics(spark, d), F.lit(True))
    return rounded(rows, "statMean", "statStddev", "statSum")


@register(_STATISTICS + " WHERE statName = 'acctbal:stats'")
def statistic_by_name(spark, d):
    rows = query.statistics_by_name(fixtures.statistics(spark, d), "acctbal:stats")
    return rounded(rows, "statMean", "statStddev", "statSum")


@register("""
SELECT source_file, _row, runId, moduleName, statCount, statMin, statMax
FROM f_statistic WHERE statCount >= 10 AND statMin < 0""")
def statistic_where(spark, d):
    return query.statistics_where(
        fixtures.statistics(spark, d), "statCount >= 10 AND statMin < 0", statId=False,
        statName=False, statMean=False, statStddev=False, statSum=False,
    )


@register("SELECT source_file, _row, attrName, attrValue FROM f_runAttr")
def run_attrs(spark, d):
    return query.run_attributes(fixtures.run_attrs(spark, d))


@register("SELECT source_file, _row, paramKey AS key, paramValue AS value FROM f_runParam")
def run_params(spark, d):
    return query.run_parameters(unify_parameters(fixtures.run_param(spark, d), None))


@register("SELECT source_file, _row, configKey AS key, configValue AS value FROM f_runConfig")
def run_configs(spark, d):
    return query.run_parameters(unify_parameters(None, fixtures.run_config(spark, d)))


@register("""
SELECT source_file, _row, paramKey AS key, paramValue AS value, paramOrder AS ord FROM f_runParam
UNION ALL
SELECT source_file, _row, configKey, configValue, configOrder FROM f_runConfig""")
def run_params_unified(spark, d):
    return unify_parameters(fixtures.run_param(spark, d), fixtures.run_config(spark, d))


@register("""
SELECT source_file, _row, moduleName, simtimeRaw, value
FROM f_signal WHERE vectorName = 'cbr:vector'
  AND value BETWEEN 0.2 AND 0.8 AND regexp_matches(moduleName, 'node\\[1[0-9]?\\]')""")
def plot_selector(spark, d):
    rows = query.signals_by_name(fixtures.signals(spark, d), "cbr:vector")
    condition = r"value BETWEEN 0.2 AND 0.8 AND moduleName RLIKE r'node\[1[0-9]?\]'"
    return query.select_rows(rows, condition)


@register("""
SELECT moduleName, eventNumber, simtimeRaw, vectorName, value
FROM f_signal WHERE value > 1000""")
def inspect_query(spark, d):
    return query.inspect(fixtures.signals(spark, d), "value > 1000")


# Positions -------------------------------------------------------------------------------

_POSITIONS = """
SELECT x.source_file, x._row, x.moduleName, x.simtimeRaw, x.eventNumber,
  x.value AS posX, round(y.value, 6) AS posY{value}
FROM f_signal x JOIN f_signal y ON x.source_file = y.source_file AND x.eventNumber = y.eventNumber{join}
WHERE x.vectorName = 'posX:vector' AND y.vectorName = 'posY:vector'{where}"""
_CBR_VALUE = ", v.value AS cbr"
_CBR_JOIN = " JOIN f_signal v ON v.source_file = x.source_file AND v.eventNumber = x.eventNumber"
_CBR_WHERE = " AND v.vectorName = 'cbr:vector'"
_AREA_WHERE = " AND x.value BETWEEN 0 AND 5000 AND y.value BETWEEN 500 AND 3000"


@register(_POSITIONS.format(value="", join="", where=""))
def position_pair(spark, d):
    pairs = query.positions(fixtures.signals(spark, d), "posX:vector", "posY:vector")
    return rounded(pairs, "posY")


def _position_values(spark, d, area):
    rows = query.signals_with_position(
        fixtures.signals(spark, d), "posX:vector", "posY:vector", "cbr:vector",
        value_label="cbr", area=area, eventNumber=True,
    )
    return rounded(rows, "posY")


@register(_POSITIONS.format(value=_CBR_VALUE, join=_CBR_JOIN, where=_CBR_WHERE))
def position_join(spark, d):
    return _position_values(spark, d, None)


@register(_POSITIONS.format(value=_CBR_VALUE, join=_CBR_JOIN, where=_CBR_WHERE + _AREA_WHERE))
def position_join_area(spark, d):
    return _position_values(spark, d, AREA)


@register(_POSITIONS.format(value=_CBR_VALUE, join=_CBR_JOIN, where=_CBR_WHERE))
def position_join_events(spark, d):
    """The same join on signals written in buckets of file and event: no row is moved for it."""
    path = f"{shared_folder(spark).rstrip('/')}/events-{uuid.uuid4().hex}"
    rows = query.signals_with_position(
        layouts.write_events(fixtures.signals(spark, d), path), "posX:vector", "posY:vector", "cbr:vector",
        value_label="cbr", eventNumber=True,
    )
    return rounded(rows, "posY")


@register(_POSITIONS.format(value="", join="", where=_AREA_WHERE))
def position_area_ordered(spark, d):
    """Positions written along a Z-curve, of which an area reads a few stretches."""
    path = f"{shared_folder(spark).rstrip('/')}/positions-{uuid.uuid4().hex}"
    pairs = layouts.write_positions(fixtures.signals(spark, d), "posX:vector", "posY:vector", path)
    return rounded(layouts.in_area(pairs, AREA), "posY")


# Tags ------------------------------------------------------------------------------------

_RAW_TAGS = """
SELECT source_file, paramKey AS key, paramValue AS value FROM f_runParam
UNION ALL SELECT source_file, attrName, attrValue FROM f_runAttr"""


@register(_RAW_TAGS)
def tags_raw(spark, d):
    results = fixtures.results(spark, d)
    params = tags.raw_tags(results.run_params, "key", "value", tags.Stage.RAW_PARAMETER)
    attrs = tags.raw_tags(results.run_attrs, "attrName", "attrValue", tags.Stage.RAW_ATTRIBUTE)
    return params.unionByName(attrs).drop("precedence")


_PARAM_TAGS = r"""
SELECT source_file, 'v2x_rate' AS key, paramValue AS value
FROM f_runParam WHERE paramKey LIKE '%**.vehicle!_rate%' ESCAPE '!'
UNION ALL SELECT source_file, 'dcc', trim(paramValue, '"')
FROM f_runParam WHERE paramKey LIKE '%**.vanetza[*].dcc.typename%'
UNION ALL SELECT source_file, 'traciStart',
  (regexp_extract(paramValue, '(\d+)s\+(\d+)s', 1)::BIGINT
   + regexp_extract(paramValue, '(\d+)s\+(\d+)s', 2)::BIGINT) || '.0'
FROM f_runParam WHERE paramKey LIKE '%*.traci.core.startTime%'
UNION ALL SELECT source_file, 'queueLength', paramValue
FROM f_runParam WHERE paramKey LIKE '%**.vanetza[*].dcc.queueLength%'"""


@register(f"""
SELECT source_file, key, CASE WHEN key = 'v2x_rate' THEN value::DOUBLE::VARCHAR ELSE value END AS value
FROM ({_PARAM_TAGS})""")
def tags_params(spark, d):
    return tags.parameter_tags(fixtures.results(spark, d).run_params).drop("precedence")


@register("""
SELECT source_file, t.key, CASE t.key WHEN 'prefix' THEN attrValue
  WHEN 'MCO' THEN (attrValue LIKE '%MCO%')::VARCHAR ELSE (attrValue LIKE '%SCO%')::VARCHAR END AS value
FROM f_runAttr, (SELECT unnest(['prefix', 'MCO', 'SCO']) AS key) t
WHERE attrName LIKE '%configname%'""")
def tags_attrs(spark, d):
    return tags.attribute_tags(fixtures.run_attrs(spark, d)).drop("precedence")


_ITERVARS_TAGS = r"""
SELECT source_file, t.key, CASE t.key
    WHEN 'period' THEN regexp_extract(attrValue, '\$period=(.*?)s', 1)::DOUBLE::VARCHAR
    WHEN 'v2x_rate' THEN regexp_extract(attrValue, 'vehicles-(.*)-plain', 1)::DOUBLE::VARCHAR
    WHEN 'simulationEnd' THEN (regexp_extract(attrValue, '\$1=(\d+)s\+(\d+)s', 1)::DOUBLE
      + regexp_extract(attrValue, '\$1=(\d+)s\+(\d+)s', 2)::DOUBLE)::VARCHAR
    ELSE regexp_extract(attrValue, '\$sensorConf=(.*?),', 1) END AS value
FROM f_runAttr, (SELECT unnest(['period', 'v2x_rate', 'simulationEnd', 'sensors']) AS key) t
WHERE attrName = 'iterationvars'"""


@register(_ITERVARS_TAGS)
def tags_itervars(spark, d):
    return tags.iterationvars_tags(fixtures.run_attrs(spark, d)).drop("precedence")


@register(f"""
WITH parsed AS (
  SELECT source_file, key, value, 1 AS stage FROM ({_RAW_TAGS})
  UNION ALL SELECT source_file, key,
    CASE WHEN key = 'v2x_rate' THEN value::DOUBLE::VARCHAR ELSE value END, 2 FROM ({_PARAM_TAGS})
  UNION ALL SELECT source_file, key, CASE key WHEN 'prefix' THEN value
    WHEN 'MCO' THEN (value LIKE '%MCO%')::VARCHAR ELSE (value LIKE '%SCO%')::VARCHAR END, 3
  FROM (SELECT source_file, t.key, attrValue AS value
        FROM f_runAttr, (SELECT unnest(['prefix', 'MCO', 'SCO']) AS key) t
        WHERE attrName = 'configname')
  UNION ALL SELECT source_file, key, value, 4 FROM ({_ITERVARS_TAGS}))
SELECT source_file, key, arg_max(value, stage) AS value FROM parsed GROUP BY source_file, key""")
def tags_precedence(spark, d):
    """Every tag of every file after the last writer."""
    results = fixtures.results(spark, d)
    return tags.last_writer(tags.all_tags(results.run_params, results.run_attrs))


@register(r"""
SELECT a.source_file,
  regexp_extract(max(attrValue) FILTER (WHERE attrName = 'iterationvars'),
    'vehicles-(.*)-plain', 1)::DOUBLE AS v2x_rate,
  trim(max(paramValue) FILTER (WHERE paramKey LIKE '%typename'), '"') AS dcc,
  (max(paramValue) FILTER (WHERE paramKey LIKE '%queueLength'))::BIGINT AS "queueLength",
  regexp_extract(max(attrValue) FILTER (WHERE attrName = 'iterationvars'),
    '\$period=(.*?)s', 1)::DOUBLE AS period,
  regexp_extract(max(attrValue) FILTER (WHERE attrName = 'iterationvars'),
    '\$sensorConf=(.*?),', 1) AS sensors,
  max(attrValue) FILTER (WHERE attrName = 'repetition') AS repetition,
  (max(attrValue) FILTER (WHERE attrName = 'configname')) LIKE '%MCO%' AS "MCO",
  NULL::VARCHAR AS zoi
FROM f_runAttr a JOIN f_runParam p ON a.source_file = p.source_file GROUP BY a.source_file""")
def tags_wide(spark, d):
    """Allowed tags as typed columns; a tag no file has is NULL."""
    results = fixtures.results(spark, d)
    allowed = [
        "v2x_rate", "dcc", "queueLength", "period", "sensors", "repetition", "MCO", "zoi"
    ]
    return tags.wide_tags(tags.all_tags(results.run_params, results.run_attrs), allowed)


@register(r"""
SELECT source_file, key, value FROM (
  SELECT source_file, 'dcc' AS key, arg_max(value, rule) AS value FROM (
    SELECT source_file, paramValue AS value, 0 AS rule FROM f_runParam WHERE paramKey LIKE '%typename'
    UNION ALL SELECT source_file, 'queue ' || paramValue, 1 FROM f_runParam
      WHERE paramKey LIKE '%queueLength') GROUP BY source_file)""")
def tags_custom(spark, d):
    """Two custom rules for one tag, in place of the built-in one; the later hit wins."""
    custom = {
        "dcc": [
            tags.Rule(re.escape("dcc.typename"), lambda v: v),
            tags.Rule(r"queueLength$", lambda v: F.concat(F.lit("queue "), v)),
        ]
    }
    rules = tags.RuleSet.build(parameters=custom)
    found = tags.parameter_tags(fixtures.results(spark, d).run_params, rules.parameters)
    return tags.last_writer(found).where(F.col("key") == "dcc")


@register("""
SELECT DISTINCT source_file, dcc, start FROM (
  SELECT source_file,
    max(trim(paramValue, '"')) FILTER (WHERE paramKey LIKE '%typename') AS dcc,
    sum(x::DOUBLE) FILTER (WHERE paramKey LIKE '%startTime') AS start
  FROM (SELECT source_file, paramKey, paramValue,
          unnest(CASE WHEN paramKey LIKE '%startTime' THEN regexp_extract_all(paramValue, '[0-9]+')
            ELSE ['0'] END) AS x FROM f_runParam)
  GROUP BY source_file)""")
def tag_functions(spark, d):
    """Strip quotes, and evaluate a sum of times."""
    found = tags.parameter_tags(fixtures.results(spark, d).run_params)
    wide = tags.wide_tags(found, ["dcc", "traciStart"])
    return wide.select(
        "source_file", strip(F.col("dcc"), '"').alias("dcc"), F.col("traciStart").alias("start")
    )


# Extraction ------------------------------------------------------------------------------

_TAGS = "v2x_rate, repetition, configname, experiment, prefix"


def _known(df, *more):
    """Without the tags no file of the fixture has."""
    return df.drop("_frame", "var", "runnumber", "sumocfgname", *more)


@register(f"""
SELECT source_file, _row, moduleName, simtimeRaw, eventNumber, cbr, {_TAGS} FROM f_cbr""")
def tagged_signal(spark, d):
    df = extract.extract_signal(fixtures.results(spark, d, "signals"), "cbr:vector", "cbr")
    return _known(df, "value")


@register(f"""
SELECT s.source_file, s._row, runId, moduleName, scalarValue AS ppe, {_TAGS}
FROM f_scalar s JOIN f_tags t ON s.source_file = t.source_file
WHERE scalarName = 'ppe_for_ObjectID_7:sum'""")
def extract_scalar(spark, d):
    df = extract.extract_scalar(fixtures.results(spark, d, "scalars"), "ppe_for_ObjectID_7:sum", "ppe")
    return _known(df, "value", "simtimeRaw", "eventNumber")


@register(f"""
SELECT s.source_file, s._row, statId, runId, moduleName, statName, statCount,
  round(statMean, 6) AS statMean, round(statStddev, 6) AS statStddev,
  round(statSum, 6) AS statSum, statMin, statMax, {_TAGS}
FROM f_statistic s JOIN f_tags t ON s.source_file = t.source_file
WHERE statName = 'acctbal:stats'""")
def extract_statistic(spark, d):
    df = extract.extract_statistic(fixtures.results(spark, d, "statistics"), "acctbal:stats")
    df = _known(df, "value", "simtimeRaw", "eventNumber")
    return rounded(df, "statMean", "statStddev", "statSum")


@register(f"""
SELECT p.*, dcc, {_TAGS} FROM ({_POSITIONS.format(
    value=_CBR_VALUE, join=_CBR_JOIN, where=_CBR_WHERE + _AREA_WHERE)}) p
JOIN f_tags t ON p.source_file = t.source_file
JOIN (SELECT source_file, trim(paramValue, '"') AS dcc FROM f_runParam
      WHERE paramKey LIKE '%typename') q ON p.source_file = q.source_file""")
def extract_with_position(spark, d):
    options = extract.Options(additional_tags=["dcc"])
    df = extract.extract_with_position(
        fixtures.results(spark, d, "signals"), "posX:vector", "posX", "posY:vector", "posY",
        "cbr:vector", "cbr", AREA, options,
    )
    return rounded(_known(df, "value"), "posY")


@register(f"""
SELECT s.source_file, s._row, moduleName, simtimeRaw, eventNumber,
  'aoi_' || regexp_extract(vectorName, 'aoi_([0-9]+)_([0-9]+)', 2) || '_of_'
    || regexp_extract(vectorName, 'aoi_([0-9]+)_([0-9]+)', 1) AS variable,
  value, {_TAGS}
FROM f_signal s JOIN f_tags t ON s.source_file = t.source_file
WHERE regexp_matches(vectorName, 'coordination_aoi_[0-9]+_[0-9]+')""")
def matching_variable(spark, d):
    df = extract.extract_matching(
        fixtures.results(spark, d, "signals"), AOI_PATTERN, "aoi_{gentime}_of_{index}"
    )
    return _known(df)


@register(f"""
SELECT s.source_file, s._row, moduleName, simtimeRaw, eventNumber, value AS pos,
  CASE WHEN vectorName = 'posX:vector' THEN 'axis_X' ELSE vectorName END AS variable, {_TAGS}
FROM f_signal s JOIN f_tags t ON s.source_file = t.source_file WHERE vectorName ILIKE 'POS_:%'""")
def like_bulk_variable(spark, d):
    """A name the alias pattern is not found in stays as it is."""
    df = extract.extract_like(
        fixtures.results(spark, d, "signals"), "POS_:%", "pos", "pos(?P<axis>[XZ]):", "axis_{axis}"
    )
    return _known(df, "value")


@register(f"""
SELECT s.source_file, s._row, moduleName, scalarValue AS ppe,
  'ppe_' || regexp_extract(scalarName, '_([0-9]+):([a-z]+)', 1) || '_'
    || regexp_extract(scalarName, '_([0-9]+):([a-z]+)', 2) AS variable, {_TAGS}
FROM f_scalar s JOIN f_tags t ON s.source_file = t.source_file""")
def scalar_like_bulk(spark, d):
    df = extract.extract_scalars_like(
        fixtures.results(spark, d, "scalars"), "ppe_for_%", "ppe", PPE_PATTERN, "ppe_{object}_{kind}"
    )
    return _known(df, "value", "simtimeRaw", "eventNumber")


@register("""
SELECT source_file, moduleName, variable, value FROM (
  UNPIVOT (SELECT source_file, moduleName, statMin, statMax FROM f_statistic)
  ON statMin, statMax INTO NAME variable VALUE value)""")
def melt_columns(spark, d):
    stats = fixtures.statistics(spark, d).select("source_file", "moduleName", "statMin", "statMax")
    return extract.melt(stats, ["statMin", "statMax"])


# Columns ---------------------------------------------------------------------------------


@register(r"""
WITH names AS (
  SELECT scalarName, row_number() OVER (
    ORDER BY regexp_extract(scalarName, '_(\d+):', 1)::BIGINT, split_part(scalarName, ':', 2)) - 1 AS ord
  FROM (SELECT DISTINCT scalarName FROM f_scalar))
SELECT source_file, _row, s.scalarName, ord AS "scalarName_ord"
FROM f_scalar s JOIN names n ON s.scalarName = n.scalarName""")
def natural_order(spark, d):
    rows = fixtures.scalars(spark, d).select("source_file", "_row", "scalarName")
    return columns.order_categories(rows, ["scalarName"])


@register("""
SELECT source_file, _row, attrName, try_cast(attrValue AS DOUBLE) AS attrValue FROM f_runAttr""")
def cast_columns(spark, d):
    """Texts that are no number become NULL."""
    rows = fixtures.run_attrs(spark, d).select("source_file", "_row", "attrName", "attrValue")
    return columns.cast_columns(rows, ["attrValue", "not_there"])


@register("""
SELECT count(*) FILTER (WHERE try_cast(attrValue AS BIGINT) IS NULL) AS attrValue FROM f_runAttr""")
def cast_failures(spark, d):
    return columns.cast_failures(fixtures.run_attrs(spark, d), {"attrValue": "int"})


@register("SELECT p_partkey, CASE WHEN p_size = 0 THEN NULL ELSE p_size::DOUBLE END AS p_size FROM part")
def map_column_pandas(spark, d):
    """A vectorized Python function on one column."""

    @F.pandas_udf("double")
    def without_zero(values: pd.Series) -> pd.Series:
        return values.where(values != 0).astype(float)

    rows = fixtures.table(spark, d, "part").select("p_partkey", "p_size")
    return columns.map_column(rows, "p_size", "p_size", without_zero)


# Files -----------------------------------------------------------------------------------


@register("""
SELECT source_file, _row, scalarName FROM f_scalar WHERE regexp_matches(source_file, 'run_1.*vec$')
UNION ALL SELECT source_file, _row, scalarName FROM f_scalar
WHERE regexp_matches(source_file, 'run_(11|2)\\.')""")
def select_files(spark, d):
    """Two patterns; rows of a file that matches both come twice."""
    rows = fixtures.scalars(spark, d).select("source_file", "_row", "scalarName")
    return files.select_files(rows, [r"run_1.*vec$", r"run_(11|2)\."])


@register("""
SELECT 'orders.parquet' AS file, count(*) AS n FROM orders""")
def source_file(spark, d):
    rows = files.with_source_file(fixtures.table(spark, d, "orders"), "path")
    return rows.groupBy(F.substring_index("path", "/", -1).alias("file")).agg(
        F.count(F.lit(1)).alias("n")
    )


_SAMPLE = """
SELECT source_file, _row, value FROM (
  SELECT source_file, _row, value,
    row_number() OVER (PARTITION BY source_file ORDER BY md5('23|' || _row), _row) AS r,
    round_even(0.3 * count(*) OVER (PARTITION BY source_file), 0) AS quota
  FROM f_signal) WHERE r <= quota"""


def _frames(spark, d):
    return fixtures.signals(spark, d).withColumn("_frame", F.col("source_file"))


@register(_SAMPLE)
def sample_exact(spark, d):
    sampled = files.sample_rows(_frames(spark, d), 0.3)
    return sampled.select("source_file", "_row", "value")


@register("""
SELECT source_file, _row, piece FROM (
  SELECT *, row_number() OVER (ORDER BY md5('23|' || _part || '|' || _row), _part, _row) AS r,
    round_even(0.5 * count(*) OVER (), 0) AS quota
  FROM (
    SELECT source_file, _row, 'all' AS piece, '000000/' || source_file AS _part FROM f_signal
    UNION ALL
    SELECT source_file, _row, 'large' AS piece, '000001/' || source_file AS _part FROM f_signal WHERE value > 1000
  )) WHERE r <= quota""")
def sample_concat(spark, d):
    """Half of the rows of a concatenation whose pieces share their row numbers."""
    rows = _frames(spark, d).select("_frame", "source_file", "_row", "value")
    pieces = [rows.withColumn("piece", F.lit("all")), rows.where("value > 1000").withColumn("piece", F.lit("large"))]
    return files.sample_rows(frames.concat(pieces), 0.5).select("source_file", "_row", "piece")


@register("""
SELECT source_file, replace(replace('v2x/' || source_file || '/a=1', '/', '%2F'), '=', '%3D') || '_cbr' AS output
FROM f_run""")
def output_names(spark, d):
    """Folder names of frames: below the root, distinct, with an alias."""
    path = F.concat(F.lit("/data/r+1/v2x/"), "source_file", F.lit("/a=1"))
    return fixtures.runs(spark, d).select("source_file", output_name(path, "/data/r+1", ["cbr"]).alias("output"))


@register(f"SELECT * FROM ({_SAMPLE}) WHERE value > 1000")
def sample_then_filter(spark, d):
    sampled = files.sample_then_filter(_frames(spark, d), 0.3, "value > 1000")
    return sampled.select("source_file", "_row", "value")


@register("""
SELECT source_file, scalarValue, simtimeExp, source_file AS filename
FROM (SELECT s.*, simtimeExp FROM f_scalar s JOIN f_run r ON s.source_file = r.source_file)
WHERE scalarValue > 5""")
def sql_text(spark, d):
    """SQL text over the tables of all files."""
    tables = {"scalar": fixtures.scalars(spark, d), "run": fixtures.runs(spark, d)}
    statement = (
        "SELECT source_file, scalarValue, simtimeExp FROM scalar JOIN run USING (source_file) "
        "WHERE scalarValue > 5"
    )
    return sql_per_file(spark, tables, statement, include_filename=True)


# Merging ---------------------------------------------------------------------------------


@register("""
SELECT x.source_file, x._row, x.eventNumber, x.moduleName, x.value, y.moduleName AS "moduleName_r",
  round(y.value, 6) AS value_r
FROM f_signal x JOIN f_signal y ON x.source_file = y.source_file AND x.eventNumber = y.eventNumber
WHERE x.vectorName = 'posX:vector' AND y.vectorName = 'posY:vector'""")
def merge_by_file(spark, d):
    sides = [
        query.signals_by_name(fixtures.signals(spark, d), name, eventNumber=True, simtimeRaw=False)
        for name in ("posX:vector", "posY:vector")
    ]
    merged = joins.merge_by_attribute(*sides, left_keys=["eventNumber"])
    return rounded(merged, "value_r")


@register("""
SELECT x.source_file, x.moduleName, y.source_file AS "source_file_r", count(*) AS n,
  min(x.eventNumber) AS first_event, max(x.eventNumber) AS last_event
FROM f_signal x JOIN f_signal y ON x.moduleName = y.moduleName AND x.eventNumber % 1000 = y.eventNumber % 1000
WHERE x.vectorName = 'posX:vector' AND y.vectorName = 'posY:vector'
GROUP BY x.source_file, x.moduleName, y.source_file""")
def merge_concatenated(spark, d):
    """Two concatenations of the same files; rows of different files meet, counted per pair of files.

    Rows of one file with equal keys meet the same rows. They are merged as one, with their
    number: all pairs of rows would be as many as the square of the rows per key.
    """
    sides = []
    for name in ("posX:vector", "posY:vector"):
        rows = fixtures.signals(spark, d).where(F.col("vectorName") == name).withColumn("_frame", F.col("source_file"))
        rows = rows.select("_frame", "_row", "source_file", "moduleName", "eventNumber")
        sides.append(frames.concat([rows.withColumn("slot", F.col("eventNumber") % 1000)], "all"))
    keys = ["moduleName", "slot"]
    left, right = [side.groupBy("_frame", "source_file", *keys) for side in sides]
    n = F.count(F.lit(1)).alias("n")
    left = written(left.agg(n, F.min("eventNumber").alias("first_event"), F.max("eventNumber").alias("last_event")))
    right = not_broadcast_if_large(written(right.agg(n)))
    merged = joins.merge_by_files(left, right, keys, keys)
    return merged.groupBy("source_file", "moduleName", "source_file_r").agg(
        F.sum(F.col("n") * F.col("n_r")).alias("n"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event")
    )


@register("""
WITH files AS (SELECT source_file, row_number() OVER (ORDER BY source_file) AS nth FROM f_run),
names AS (SELECT source_file, runName, row_number() OVER (ORDER BY runName) AS nth FROM f_run)
SELECT a.source_file, a.moduleName, a.statMin, b.statMin AS "statMin_r", n.runName
FROM f_statistic a JOIN files f ON a.source_file = f.source_file
JOIN names n ON n.nth = f.nth
JOIN f_statistic b ON b.source_file = n.source_file AND b.moduleName = a.moduleName""")
def merge_by_position(spark, d):
    """The n-th file with the n-th run by name."""
    stats = fixtures.statistics(spark, d).select("source_file", "_row", "moduleName", "statMin")
    left = stats.withColumn("_frame", F.col("source_file"))
    names = fixtures.runs(spark, d).select("source_file", "runName")
    right = stats.join(names, "source_file").withColumn("_frame", F.col("runName"))
    merged = joins.merge_by_position(left, right.drop("source_file"), ["moduleName"])
    return merged.drop("_frame", "_row")


@register("""
SELECT s.source_file, s._row, s.runId, s.moduleName, s.scalarValue, r.runName
FROM f_scalar s JOIN f_run r ON s.source_file = r.source_file AND s.runId = r.runId""")
def natural_merge(spark, d):
    left = query.scalars_where(fixtures.scalars(spark, d), F.lit(True))
    right = fixtures.runs(spark, d).select("source_file", "runId", "runName")
    return joins.natural_merge(left, right)


@register("""
SELECT s.source_file, s._row, s.moduleName, s.scalarValue, a.attrName, a.attrValue
FROM f_scalar s JOIN f_runAttr a ON s.source_file = a.source_file""")
def per_file_cross(spark, d):
    """Each row with every attribute of its file."""
    facts = query.scalars_where(fixtures.scalars(spark, d), F.lit(True), runId=False)
    attrs = fixtures.run_attrs(spark, d).select("source_file", "attrName", "attrValue")
    return joins.join_per_file(facts, attrs)


@register("""
SELECT source_file, moduleName, value AS cbr, NULL::DOUBLE AS pos FROM f_signal
WHERE vectorName = 'cbr:vector'
UNION ALL SELECT source_file, moduleName, NULL, value FROM f_signal WHERE vectorName = 'posX:vector'""")
def concat(spark, d):
    sides = [
        query.signals_by_name(fixtures.signals(spark, d), name, alias, simtimeRaw=False).withColumn(
            "_frame", F.col("source_file")
        )
        for name, alias in (("cbr:vector", "cbr"), ("posX:vector", "pos"))
    ]
    return frames.concat(sides).select("source_file", "moduleName", "cbr", "pos")
