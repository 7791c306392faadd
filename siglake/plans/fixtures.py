"""Result tables derived from the driver tables: one result file per nation.

Each table is defined twice, as a DataFrame and as SQL for the comparison.
"""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from siglake.session import configure
from siglake.sources.results import Results, unify_parameters


@cache
def _schema(path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def runs(spark, d) -> DataFrame:
    return table(spark, d, "nation").selectExpr(
        "concat('run_', n_nationkey, '.vec') AS source_file",
        "bigint(n_nationkey) AS _row",
        "bigint(n_nationkey) AS runId",
        "n_name AS runName",
        "-9 AS simtimeExp",
    )


def run_attrs(spark, d) -> DataFrame:
    nations = table(spark, d, "nation").join(
        table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )
    return nations.selectExpr(
        "concat('run_', n_nationkey, '.vec') AS source_file",
        "bigint(n_nationkey) AS runId",
        """inline(array(
            named_struct('_row', 1L, 'attrName', 'configname', 'attrValue',
                concat(if(n_nationkey % 2 = 0, 'cfg_MCO_', 'cfg_SCO_'), n_regionkey)),
            named_struct('_row', 2L, 'attrName', 'repetition', 'attrValue', string(n_nationkey % 5)),
            named_struct('_row', 3L, 'attrName', 'experiment', 'attrValue', r_name),
            named_struct('_row', 4L, 'attrName', 'iterationvars', 'attrValue',
                concat('$sensorConf=s', n_nationkey % 3, ', $period=', n_nationkey % 4, '.5s, $1=',
                    n_nationkey, 's+10s, vehicles-0.', n_nationkey % 10, '-plain-0.5.'))))""",
    )


def run_param(spark, d, prefix: str = "param", file_prefix: str = "run_") -> DataFrame:
    key, value = f"'{prefix}Key'", f"'{prefix}Value'"
    rows = table(spark, d, "nation").selectExpr(
        f"concat('{file_prefix}', n_nationkey, '.vec') AS source_file",
        "bigint(n_nationkey) AS runId",
        f"""inline(array(
            named_struct('_row', 1L, {key}, '**.vehicle_rate', {value}, concat('0.', n_nationkey % 7)),
            named_struct('_row', 2L, {key}, '**.vanetza[*].dcc.typename',
                {value}, concat('"Dcc', n_nationkey % 2, '"')),
            named_struct('_row', 3L, {key}, '*.traci.core.startTime', {value}, concat(n_nationkey, 's+5s')),
            named_struct('_row', 4L, {key}, '**.vanetza[*].dcc.queueLength', {value}, string(n_nationkey))))""",
    )
    return rows.selectExpr("*", f"int(_row) AS {prefix}Order")


def run_config(spark, d) -> DataFrame:
    """The same parameters as recorded by files of the newer format."""
    return run_param(spark, d, "config", "run_v6_")


def signals(spark, d) -> DataFrame:
    """Four samples per order. A query by name reads the branch of that name only."""
    customers = table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    orders = table(spark, d, "orders").join(customers, "o_custkey")
    parts = [
        ("'posX:vector'", "c_acctbal"),
        ("'posY:vector'", "o_totalprice / 100"),
        ("'cbr:vector'", "(o_orderkey % 100) / 100D"),
        (
            "concat('coordination_aoi_', o_orderkey % 10, '_', o_custkey % 1000, ':vector')",
            "o_totalprice",
        ),
    ]
    branches = [
        orders.selectExpr(
            "concat('run_', c_nationkey, '.vec') AS source_file",
            f"o_orderkey * 4 + {number} AS _row",
            "concat('World.node[', o_custkey % 20, '].middleware') AS moduleName",
            f"{name} AS vectorName",
            "o_orderkey AS eventNumber",
            "(unix_micros(timestamp(o_orderdate)) - 694224000000000) * 1000 AS simtimeRaw",
            f"{value} AS value",
        )
        for number, (name, value) in enumerate(parts)
    ]
    return reduce(DataFrame.unionAll, branches)


def vectors(spark, d) -> DataFrame:
    """Thirteen vectors per customer: one for each name its samples can have."""
    return table(spark, d, "customer").selectExpr(
        "concat('run_', c_nationkey, '.vec') AS source_file",
        "concat('World.node[', c_custkey % 20, '].middleware') AS moduleName",
        """inline(array(
            named_struct('vectorId', c_custkey * 16, 'vectorName', 'posX:vector'),
            named_struct('vectorId', c_custkey * 16 + 1, 'vectorName', 'posY:vector'),
            named_struct('vectorId', c_custkey * 16 + 2, 'vectorName', 'cbr:vector'))
            || transform(sequence(0, 9), i -> named_struct('vectorId', c_custkey * 16 + 3 + i,
                'vectorName', concat('coordination_aoi_', i, '_', c_custkey % 1000, ':vector'))))""",
    )


def vector_data(spark, d) -> DataFrame:
    sampled = signals(spark, d)
    orders = table(spark, d, "orders").selectExpr("o_orderkey AS eventNumber", "o_custkey")
    return sampled.join(orders, "eventNumber").selectExpr(
        "source_file", "_row",
        "o_custkey * 16 + if(_row % 4 = 3, 3 + eventNumber % 10, _row % 4) AS vectorId",
        "eventNumber", "simtimeRaw",
        "value",
    )


def scalars(spark, d) -> DataFrame:
    """Two scalars per supplier, the sum and the count of one measure."""
    rows = table(spark, d, "supplier").selectExpr(
        "concat('run_', s_nationkey, '.vec') AS source_file",
        "bigint(s_nationkey) AS runId",
        "concat('World.node[', s_suppkey % 20, ']') AS moduleName",
        """inline(array(
            named_struct('_row', s_suppkey * 2,
                'scalarName', concat('ppe_for_ObjectID_', s_suppkey, ':sum'), 'scalarValue', s_acctbal),
            named_struct('_row', s_suppkey * 2 + 1,
                'scalarName', concat('ppe_for_ObjectID_', s_suppkey, ':count'),
                'scalarValue', double(s_suppkey % 7 + 1))))""",
    )
    return rows.selectExpr("*", "_row AS scalarId")


def statistics(spark, d) -> DataFrame:
    return spark.sql("""
        SELECT concat('run_', c_nationkey, '.vec') AS source_file,
            bigint(ascii(c_mktsegment)) AS _row, bigint(ascii(c_mktsegment)) AS statId,
            bigint(c_nationkey) AS runId, c_mktsegment AS moduleName, 'acctbal:stats' AS statName,
            count(*) AS statCount, avg(c_acctbal) AS statMean, stddev_samp(c_acctbal) AS statStddev,
            sum(c_acctbal) AS statSum, min(c_acctbal) AS statMin, max(c_acctbal) AS statMax
        FROM {customer} GROUP BY c_nationkey, c_mktsegment""", customer=table(spark, d, "customer"))


def events(spark, d) -> DataFrame:
    return table(spark, d, "events")


@cache
def _results(application: str, d: str, tables: tuple[str, ...]) -> Results:
    spark = SparkSession.active()
    measured = {"signals": signals, "scalars": scalars, "statistics": statistics}
    return Results(
        run_attrs=run_attrs(spark, d),
        run_params=unify_parameters(run_param(spark, d), None),
        **{name: measured[name](spark, d) for name in tables},
    )


def results(spark: SparkSession, d: str, *tables: str) -> Results:
    """Run metadata, and the named ones of ``signals``, ``scalars`` and ``statistics``.

    One object for all queries of an application, as for a user with many queries.
    """
    configure(spark)
    return _results(spark.sparkContext.applicationId, d, tables)


_PARAMETERS_SQL = """
SELECT '{file}' || n_nationkey || '.vec' AS source_file, n_nationkey::BIGINT AS runId, r._row,
  CASE r._row WHEN 1 THEN '**.vehicle_rate' WHEN 2 THEN '**.vanetza[*].dcc.typename'
    WHEN 3 THEN '*.traci.core.startTime' ELSE '**.vanetza[*].dcc.queueLength' END AS {prefix}Key,
  CASE r._row WHEN 1 THEN '0.' || n_nationkey % 7 WHEN 2 THEN '"Dcc' || n_nationkey % 2 || '"'
    WHEN 3 THEN n_nationkey || 's+5s' ELSE n_nationkey::VARCHAR END AS {prefix}Value,
  r._row::INTEGER AS {prefix}Order
FROM nation, (SELECT unnest([1, 2, 3, 4])::BIGINT AS _row) r"""

_SIGNAL_SQL = """
SELECT 'run_' || c_nationkey || '.vec' AS source_file, o_orderkey * 4 + {number} AS _row,
  'World.node[' || (o_custkey % 20) || '].middleware' AS moduleName, {name} AS vectorName,
  o_orderkey AS eventNumber, (epoch_us(o_orderdate) - 694224000000000) * 1000 AS simtimeRaw,
  {value} AS value
FROM orders JOIN customer ON o_custkey = c_custkey"""

_VARIABLES = "max(attrValue) FILTER (WHERE attrName = 'iterationvars')"

# The same tables for DuckDB. A query's SQL names those it needs.
SQL = {
    "f_run": """
SELECT 'run_' || n_nationkey || '.vec' AS source_file, n_nationkey::BIGINT AS _row,
  n_nationkey::BIGINT AS runId, n_name AS runName, -9 AS simtimeExp
FROM nation""",
    "f_runAttr": """
SELECT 'run_' || n_nationkey || '.vec' AS source_file, n_nationkey::BIGINT AS runId, r._row,
  CASE r._row WHEN 1 THEN 'configname' WHEN 2 THEN 'repetition' WHEN 3 THEN 'experiment'
    ELSE 'iterationvars' END AS attrName,
  CASE r._row WHEN 1 THEN CASE WHEN n_nationkey % 2 = 0 THEN 'cfg_MCO_' ELSE 'cfg_SCO_' END || n_regionkey
    WHEN 2 THEN (n_nationkey % 5)::VARCHAR WHEN 3 THEN r_name
    ELSE '$sensorConf=s' || n_nationkey % 3 || ', $period=' || n_nationkey % 4 || '.5s, $1=' ||
      n_nationkey || 's+10s, vehicles-0.' || n_nationkey % 10 || '-plain-0.5.' END AS attrValue
FROM nation JOIN region ON n_regionkey = r_regionkey,
  (SELECT unnest([1, 2, 3, 4])::BIGINT AS _row) r""",
    "f_runParam": _PARAMETERS_SQL.format(prefix="param", file="run_"),
    "f_runConfig": _PARAMETERS_SQL.format(prefix="config", file="run_v6_"),
    "f_signal": " UNION ALL ".join(
        _SIGNAL_SQL.format(number=number, name=name, value=value)
        for number, (name, value) in enumerate(
            [
                ("'posX:vector'", "c_acctbal"),
                ("'posY:vector'", "o_totalprice / 100"),
                ("'cbr:vector'", "(o_orderkey % 100) / 100e0"),
                (
                    "'coordination_aoi_' || (o_orderkey % 10) || '_' || (o_custkey % 1000) || ':vector'",
                    "o_totalprice",
                ),
            ]
        )
    ),
    "f_vector": """
SELECT 'run_' || c_nationkey || '.vec' AS source_file, c_custkey * 16 + v.n AS vectorId,
  'World.node[' || (c_custkey % 20) || '].middleware' AS moduleName,
  coalesce(v.name, 'coordination_aoi_' || (v.n - 3) || '_' || (c_custkey % 1000) || ':vector') AS vectorName
FROM customer,
  (VALUES (0, 'posX:vector'), (1, 'posY:vector'), (2, 'cbr:vector'), (3, NULL), (4, NULL), (5, NULL),
    (6, NULL), (7, NULL), (8, NULL), (9, NULL), (10, NULL), (11, NULL), (12, NULL)) v(n, name)""",
    "f_vectorData": """
SELECT source_file, _row,
  o_custkey * 16 + CASE _row % 4 WHEN 3 THEN 3 + eventNumber % 10 ELSE _row % 4 END AS vectorId,
  eventNumber, simtimeRaw, value
FROM f_signal JOIN orders ON eventNumber = o_orderkey""",
    "f_scalar": """
SELECT 'run_' || s_nationkey || '.vec' AS source_file, s_suppkey * 2 + k.n AS _row,
  s_suppkey * 2 + k.n AS scalarId, s_nationkey::BIGINT AS runId,
  'World.node[' || (s_suppkey % 20) || ']' AS moduleName,
  'ppe_for_ObjectID_' || s_suppkey || k.kind AS scalarName,
  CASE k.n WHEN 0 THEN s_acctbal ELSE (s_suppkey % 7 + 1)::DOUBLE END AS scalarValue
FROM supplier, (VALUES (0, ':sum'), (1, ':count')) k(n, kind)""",
    "f_statistic": """
SELECT 'run_' || c_nationkey || '.vec' AS source_file, ascii(c_mktsegment)::BIGINT AS _row,
  ascii(c_mktsegment)::BIGINT AS statId, c_nationkey::BIGINT AS runId, c_mktsegment AS moduleName,
  'acctbal:stats' AS statName, count(*) AS statCount, avg(c_acctbal) AS statMean,
  stddev_samp(c_acctbal) AS statStddev, sum(c_acctbal) AS statSum, min(c_acctbal) AS statMin,
  max(c_acctbal) AS statMax
FROM customer GROUP BY c_nationkey, c_mktsegment""",
    # The minimal tags of each file, parsed from the attribute texts.
    "f_tags": rf"""
SELECT source_file,
  split_part(regexp_extract({_VARIABLES}, 'vehicles-.*-plain', 0), '-', 2)::DOUBLE AS v2x_rate,
  max(attrValue) FILTER (WHERE attrName = 'repetition') AS repetition,
  max(attrValue) FILTER (WHERE attrName = 'configname') AS configname,
  max(attrValue) FILTER (WHERE attrName = 'experiment') AS experiment,
  max(attrValue) FILTER (WHERE attrName = 'configname') AS prefix
FROM f_runAttr GROUP BY source_file""",
    "f_cbr": """
SELECT s.source_file, s._row, moduleName, simtimeRaw, eventNumber, value AS cbr,
  v2x_rate, repetition, configname, experiment, prefix
FROM f_signal s LEFT JOIN f_tags t ON s.source_file = t.source_file
WHERE vectorName = 'cbr:vector'""",
}
