"""Layouts of the ingested signals: what joins move and what scans read."""

import pytest
from pyspark.sql import functions as F
from test_sources import write_result

from siglake.operators import extract, query
from siglake.sources import layouts, results


def rows_read(df):
    """Rows that come out of the scans of ``df``."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture
def plain_plans(spark):
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    usual = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in usual.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def signals(spark):
    names = F.element_at(F.array(*map(F.lit, ["posX:vector", "posY:vector", "cbr:vector"])), (F.col("n") + 1).cast("int"))
    wave = lambda k: F.abs(F.hash("event", F.lit(k))) % 1000
    return spark.range(30_000).select(
        F.concat(F.lit("run_"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11), F.lit(".vec")).alias("source_file"),
        F.col("id").alias("event"),
        F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("n"),
    ).select(
        "source_file", (F.col("event") * 3 + F.col("n")).alias("_row"), F.concat(F.lit("m"), F.col("event") % 5000).alias("moduleName"),
        names.alias("vectorName"), F.col("event").alias("eventNumber"), F.col("event").alias("simtimeRaw"),
        F.when(F.col("n") == 0, wave(1)).when(F.col("n") == 1, wave(2)).otherwise(F.col("event") % 100).cast("double").alias("value"),
    )


def test_joins_on_events_move_no_row(spark, signals, tmp_path, plain_plans):
    events = layouts.write_events(signals, str(tmp_path / "events"), buckets=6)
    area = (0.0, 0.0, 500.0, 700.0)
    joined = query.signals_with_position(events, "posX:vector", "posY:vector", "cbr:vector", area=area, eventNumber=True)
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    expected = query.signals_with_position(signals, "posX:vector", "posY:vector", "cbr:vector", area=area, eventNumber=True)
    assert "Exchange" in expected._jdf.queryExecution().executedPlan().toString()
    assert joined.count() > 5000 and joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    sizes = [r["count"] for r in events.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * min(sizes)  # the large file too is spread


def test_events_of_an_ingest_in_a_later_session(spark, tmp_path, plain_plans):
    write_result(tmp_path / "a.vec", rows=40)
    target = str(tmp_path / "tables")
    results.ingest(spark, [str(tmp_path / "a.vec")], target, by_event=True)
    spark.sql(f"DROP TABLE {layouts._table_name(target + '/signal_events')}")  # as in a new session
    loaded = results.load(spark, target)
    assert loaded.events.exceptAll(loaded.signals).isEmpty() and loaded.events.count() == 40
    pairs = query.positions(loaded.events, "cbr:vector", "posX:vector")
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    found = extract.extract_with_position(loaded, "cbr:vector", "x", "cbr:vector", "y", "cbr:vector", "v")
    assert found.count() == 20
    results.ingest(spark, [str(tmp_path / "a.vec")], target)
    assert results.load(spark, target).events is None


def test_an_area_reads_its_share_of_the_positions(spark, signals, tmp_path, plain_plans):
    pairs = layouts.write_positions(signals, "posX:vector", "posY:vector", str(tmp_path / "p"), parts=256)
    expected = query.positions(signals, "posX:vector", "posY:vector")
    assert pairs.exceptAll(expected).isEmpty() and pairs.count() == expected.count() == 30_000
    for side in (500, 250, 125):
        area = (200.0, 300.0, 200.0 + side, 300.0 + side)
        most = (side / 1000 + 2.5 / 16) ** 2  # 256 parts are about 16 by 16, of which the sides cut some
        found = layouts.in_area(pairs, area)
        assert 0 < rows_read(found) < 30_000 * most, side
        assert found.count() == layouts.in_area(expected, area).count()


def test_tasks_order_a_bounded_number_of_positions(spark, signals, tmp_path, monkeypatch):
    """Few stored bytes can be many rows."""
    monkeypatch.setattr(layouts, "ROWS_PER_PART", 2_000)
    pairs = layouts.write_positions(signals, "posX:vector", "posY:vector", str(tmp_path / "p"))
    sizes = [r["count"] for r in pairs.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 4_000


def test_positions_without_a_number_and_without_rows(spark, tmp_path):
    schema = "source_file string, _row long, moduleName string, vectorName string, eventNumber long, simtimeRaw long, value double"
    rows = [("f", 1, "m", "x", 1, 1, float("nan")), ("f", 2, "m", "y", 1, 1, 2.0), ("f", 3, "m", "x", 2, 1, None), ("f", 4, "m", "y", 2, 1, 5.0)]
    pairs = layouts.write_positions(spark.createDataFrame(rows, schema), "x", "y", str(tmp_path / "some"))
    assert pairs.count() == 2 and layouts.in_area(pairs, (0, 0, 9, 9)).count() == 0
    assert layouts.write_positions(spark.createDataFrame([], schema), "x", "y", str(tmp_path / "none")).count() == 0


def test_row_groups_without_a_value_are_skipped(spark, signals, tmp_path, plain_plans):
    odd = signals.withColumn("eventNumber", F.col("eventNumber") * 2 + 1).repartitionByRange(24, "vectorName", "_row")
    read = {}
    for name, options in (("plain", {}), ("bloom", results.BLOOM_FILTERS["signals"])):
        # The dictionary would tell as much as long as it is small, which it is not in large row groups.
        odd.write.options(**options).option("parquet.enable.dictionary", "false").parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        read[name] = [rows_read(df.where(c)) for c in ("eventNumber = 30001", "eventNumber = 30000", "moduleName = 'm77x'")]
        assert df.where("eventNumber = 30001").count() == 3
    assert read["bloom"][1:] == [0, 0] and read["bloom"][0] < read["plain"][0] and min(read["plain"]) > 0
