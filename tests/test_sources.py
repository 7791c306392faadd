import sqlite3

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siglake.operators import extract, frames
from siglake.sources import arrow_files, files, results, sinks
from siglake.sources.sqlite import RUN_PARAMETERS


def write_result(path, version=5, rows=10):
    connection = sqlite3.connect(path)
    name, prefix = ("runParam", "param") if version < 6 else ("runConfig", "config")
    connection.executescript(f"""
        CREATE TABLE run (runId INTEGER PRIMARY KEY, runName TEXT, simtimeExp INTEGER);
        CREATE TABLE runAttr (rowId INTEGER PRIMARY KEY, runId INTEGER, attrName TEXT, attrValue TEXT);
        CREATE TABLE {name} (rowId INTEGER PRIMARY KEY, runId INTEGER, {prefix}Key TEXT, {prefix}Value TEXT, {prefix}Order INTEGER);
        CREATE TABLE vector (vectorId INTEGER PRIMARY KEY, runId INTEGER, moduleName TEXT, vectorName TEXT);
        CREATE TABLE vectorData (rowId INTEGER PRIMARY KEY, vectorId INTEGER, eventNumber INTEGER, simtimeRaw INTEGER, value REAL);
        CREATE TABLE scalar (scalarId INTEGER PRIMARY KEY, runId INTEGER, moduleName TEXT, scalarName TEXT, scalarValue REAL);
        CREATE TABLE statistic (statId INTEGER PRIMARY KEY, runId INTEGER, moduleName TEXT, statName TEXT, statCount INTEGER, statMean REAL);
        INSERT INTO run VALUES (1, 'r', -12);
        INSERT INTO runAttr VALUES (1, 1, 'configname', 'c{version}'), (2, 1, 'iterationvars', '$period=1.5s');
        INSERT INTO {name} VALUES (1, 1, '**.vehicle_rate', '0.{version}', 0);
        INSERT INTO vector VALUES (1, 1, 'm1', 'cbr:vector'), (2, 1, 'm2', 'posX:vector');
        INSERT INTO scalar VALUES (1, 1, 'm1', 's', 2.5), (2, 1, 'm1', 't', NULL);
        INSERT INTO statistic VALUES (1, 1, 'm1', 'st', 3, 1.5);
    """)
    data = [(1 + i % 2, 100 + i, i * 10**9, i / 2) for i in range(rows)]
    connection.executemany("INSERT INTO vectorData (vectorId, eventNumber, simtimeRaw, value) VALUES (?, ?, ?, ?)", data)
    connection.commit()
    connection.close()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("results")
    (root / "runs").mkdir()
    write_result(root / "runs" / "a.vec")
    write_result(root / "runs" / "b.vec", version=6, rows=25)
    (root / "runs" / "broken.vec").write_text("no database, but long enough to be looked at" * 50)
    connection = sqlite3.connect(root / "runs" / "empty.vec")
    connection.execute("CREATE TABLE other (x INTEGER)")
    connection.commit()
    connection.close()
    return root


def test_files_are_listed_by_pattern(spark, folder):
    root, found = files.list_files(str(folder) + r"/runs/[ab]\.vec$")
    assert [p.rsplit("/", 1)[1] for p in found] == ["a.vec", "b.vec"]
    assert str(folder).startswith(root)
    _, twice = files.list_files([str(folder) + "/runs/a.*", str(folder) + "/.*a.vec"])
    assert len(twice) == 2
    with pytest.raises(FileNotFoundError):
        files.list_files(str(folder) + "/nothing_here")


def test_rows_are_selected_by_pattern(spark):
    df = spark.createDataFrame([("/d/x/a.vec",), ("/d/y/b.vec",), ("/e/a.vec",)], "source_file string")
    assert files.select_files(df, "/d/x/.*vec").count() == 1
    assert files.select_files(df, ["/d/.*vec", r"/d/.*a\.vec"]).count() == 3


def test_one_partition_per_file_or_row_range(spark, folder):
    paths = [str(folder / "runs" / n) for n in ("a.vec", "b.vec")]
    assert results.read_sqlite(spark, paths, "vectorData").rdd.getNumPartitions() == 2
    third = (folder / "runs" / "b.vec").stat().st_size // 3 + 1
    split = results.read_sqlite(spark, paths, "vectorData", splitBytes=third)
    assert split.rdd.getNumPartitions() == 6
    assert results.read_sqlite(spark, paths, "run", splitBytes=third).rdd.getNumPartitions() == 2
    assert split.count() == 35 and split.select("source_file", "rowId").distinct().count() == 35


def test_ingest(spark, folder, tmp_path):
    _, paths = files.list_files(str(folder) + r"/runs/.*vec$")
    target = str(tmp_path / "tables")
    results.ingest(spark, paths, target)
    errors = spark.read.parquet(f"{target}/ingest_errors")
    assert {r.source_file.rsplit("/", 1)[1] for r in errors.collect()} == {"broken.vec", "empty.vec"}
    assert RUN_PARAMETERS in {r.table for r in errors.collect()}

    loaded = results.load(spark, target)
    assert loaded.signals.count() == 35
    assert {r.key for r in loaded.run_params.collect()} == {"**.vehicle_rate"}
    df = extract.extract_signal(loaded, "cbr:vector", "cbr", extract.Options(additional_tags=["period"]))
    expected = {("c5", 0.5, 1.5, i / 2) for i in range(0, 10, 2)} | {("c6", 0.6, 1.5, i / 2) for i in range(0, 25, 2)}
    assert {(r.prefix, r.v2x_rate, r.period, r.cbr) for r in df.collect()} == expected
    assert {r._row for r in df.where("prefix = 'c5'").collect()} == {1, 3, 5, 7, 9}
    scalar = extract.extract_scalar(loaded, "s", "value_of_s", extract.Options(moduleName=False))
    assert [r.value_of_s for r in scalar.collect()] == [2.5, 2.5]
    stat = extract.extract_statistic(loaded, "st", statId=False).first()
    assert (stat.statMean, stat.statName) == (1.5, "st") and "statId" not in stat


def test_written_signals_are_read_by_name(spark, folder, tmp_path):
    target = str(tmp_path / "tables")
    results.ingest(spark, [str(folder / "runs" / "a.vec")], target)
    signals = results.load(spark, target).signals.where("vectorName = 'cbr:vector'").select("value")
    plan = signals._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(vectorName,cbr:vector)" in plan and "ReadSchema: struct<value:double,vectorName:string>" in plan


@pytest.mark.parametrize(("modules", "join"), [(40_000, "SortMergeJoin"), (10, "BroadcastHashJoin")])
def test_many_vectors_of_few_rows_are_not_broadcast(spark, modules, join):
    """The optimizer takes rows made by inline for as few as they were made from."""
    made = "inline(transform(sequence(0, 12), i -> named_struct('vectorId', id * 16 + i, 'vectorName', concat('name_', i, ':vector'))))"
    vector = spark.range(modules).selectExpr("'f' AS source_file", "concat('World.node[', id, ']') AS moduleName", made)
    data = spark.range(2_000_000).selectExpr("'f' AS source_file", "id AS _row", f"id % {modules * 16} AS vectorId", "1D AS value")
    joined = results.join_signals(vector, data)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert join in plan
    assert joined.count() == sum(i % (modules * 16) % 16 < 13 for i in range(2_000_000))


def test_sql_per_file(spark):
    flows = spark.createDataFrame([("f", 1, 0.5), ("g", 2, 0.7)], "source_file string, rowId long, loss double")
    config = spark.createDataFrame([("f", 100), ("g", 200)], "source_file string, payload int")
    df = results.sql_per_file(
        spark, {"flows": flows, "config": config},
        "SELECT * FROM flows JOIN config USING (source_file)", include_filename=True,
    )
    assert sorted(tuple(r) for r in df.collect()) == [("f", 0.5, 100, "f"), ("g", 0.7, 200, "g")]


def test_arrow_frames(spark, tmp_path):
    one = pd.DataFrame({"x": [1.0, None], "c": pd.Categorical(["u", "v"])})
    two = pd.DataFrame({"x": [3.0], "extra": [7]})
    one.to_feather(tmp_path / "one.feather", compression="lz4")
    two.to_feather(tmp_path / "two.feather")
    df = arrow_files.read_arrow(spark, [str(tmp_path / "one.feather"), str(tmp_path / "two.feather")])
    assert sorted(((r.x, r.c, r.extra) for r in df.collect()), key=repr) == [
        (1.0, "u", None), (3.0, None, 7), (None, "v", None)
    ]
    assert df.select("_frame").distinct().count() == 2
    got = frames.aggregate_groups(df, [], "x", "n", "size").collect()
    assert sorted(r.n for r in got) == [1, 2]


def test_sample_comes_before_the_filter(spark):
    df = spark.range(1000).selectExpr("'f' AS _frame", "id AS _row", "id % 2 AS odd")
    kept = files.sample_then_filter(df, 0.25, "odd = 1")
    sampled = files.sample_rows(df, 0.25)
    assert sampled.count() == 250 and kept.count() == sampled.where("odd = 1").count() < 250
    assert 150 < files.sample_rows(df, 0.25, exact=False).count() < 350
    assert files.sample_then_filter(df, condition="odd = 1").count() == 500


def test_a_failing_table_costs_only_itself(spark, folder, tmp_path):
    import shutil
    import sqlite3

    path = tmp_path / "part.vec"
    shutil.copy(folder / "runs" / "a.vec", path)
    with sqlite3.connect(path) as connection:
        connection.execute("DROP TABLE statistic")
    target = str(tmp_path / "tables")
    results.ingest(spark, [str(path), str(folder / "runs" / "b.vec")], target)
    loaded = results.load(spark, target)
    assert loaded.signals.select("source_file").distinct().count() == 2
    assert loaded.statistics.select("source_file").distinct().count() == 1
    assert [r.table for r in spark.read.parquet(f"{target}/ingest_errors").collect()] == ["statistic"]
    assert not (tmp_path / "tables" / "_staging").exists()


def test_arrow_types_are_widened(spark, tmp_path):
    import numpy as np

    paths = [str(tmp_path / f"{n}.feather") for n in "abc"]
    pd.DataFrame({"x": [1], "u": np.array([2**40], "uint64"), "t": [pd.Timestamp("2020-01-02")]}).to_feather(paths[0])
    pd.DataFrame({"x": [0.5], "u": np.array([3], "uint8")}).to_feather(paths[1])
    pd.DataFrame({"x": ["text"]}).to_feather(paths[2])
    df = arrow_files.read_arrow(spark, paths[:2])
    assert dict(df.dtypes)["x"] == "double" and sorted(r.x for r in df.collect()) == [0.5, 1.0]
    assert sorted(int(r.u) for r in df.collect()) == [3, 2**40]
    assert [str(r.t) for r in df.where("t IS NOT NULL").collect()] == ["2020-01-02 00:00:00"]
    assert sorted(r.x for r in arrow_files.read_arrow(spark, paths).collect()) == ["0.5", "1", "text"]


def test_samples_of_pieces_and_saved_datasets(spark, tmp_path):
    df = spark.range(101).selectExpr("'f' AS _frame", "id AS _row")
    both = frames.concat([df, df])
    assert files.sample_rows(both, 0.5).count() == 101
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "plain"))
    read = arrow_files.read_parquet_frames(spark, str(tmp_path / "plain"))
    assert read.select("_part", "_row").distinct().count() == 100
    sizes = [r["count"] for r in read.groupBy("_frame").count().collect()]
    assert files.sample_rows(read, 0.5).count() == sum(round(0.5 * n) for n in sizes)


def test_output_names_stay_distinct(spark):
    paths = ["/d/r+1/a/b", "/d/r+1/a_b", "/d/r+1/a%2Fb", "/x/a"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    names = [r.n for r in df.select(sinks.output_name(F.col("p"), "/d/r+1").alias("n")).collect()]
    assert names == ["a%2Fb", "a_b", "a%252Fb", "%2Fx%2Fa"]


def test_saving(spark, tmp_path):
    df = spark.createDataFrame(
        [("/root/in/a.vec", "/root/in/a.vec", 1, "2.5"), ("/root/in/b.vec", "/root/in/b.vec", 1, "x")],
        "_frame string, source_file string, _row long, v string",
    )
    whole, parts, raw = (str(tmp_path / n) for n in ("whole", "parts", "raw"))
    assert sinks.save(df, whole, numerical=["v"])
    assert sorted(r.v or 0 for r in arrow_files.read_parquet_frames(spark, whole).collect()) == [0, 2.5]
    assert sinks.save(df, parts, separate=True, common_root="/root", aliases=["v"], file_format="json")
    assert {p.name for p in (tmp_path / "parts").iterdir() if p.is_dir()} == {
        "output=in%252Fa.vec_v", "output=in%252Fb.vec_v"
    }
    grouped = frames.aggregate_groups_raw(df, [], "r", {"all": F.collect_set("v")})
    assert sinks.save(grouped, raw, "json", raw=True)
    assert spark.read.json(raw).where("_frame like '%a.vec'").first().r["all"] == ["2.5"]
    assert not sinks.save(df.where("false"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    with pytest.raises(ValueError):
        sinks.save(df, whole, "hdf")


def test_saved_frames_of_unlike_width(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    spark.range(2).selectExpr("id", "double('nan') AS x").coalesce(1).write.parquet(str(tmp_path / "b"))
    next((tmp_path / "b").glob("*.parquet")).with_name("bad.parquet").write_bytes(b"no parquet")
    df = arrow_files.read_parquet_frames(spark, str(tmp_path / "a"), str(tmp_path / "b"), tolerant=True)
    assert df.count() == 5 and df.where("x IS NOT NULL").count() == 0
    assert df.where("_frame LIKE '%/b/%'").select("_frame").distinct().count() == 1


@pytest.fixture(scope="module")
def mounted(spark, folder):
    """The folder as one that only Spark's readers can open."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.lab.link./in", f"file:{folder}")
    return "viewfs://lab/in"


def test_ingest_from_a_store_that_only_spark_opens(spark, folder, mounted, tmp_path):
    wal = sqlite3.connect(folder / "runs" / "wal.vec")
    wal.execute("PRAGMA journal_mode=wal")
    wal.close()
    write_result(folder / "runs" / "wal.vec", rows=4)
    root, paths = files.list_files(mounted + r"/runs/.*vec$")
    assert root == "viewfs://lab/in" and [p[len(root) :] for p in paths] == [
        f"/runs/{n}.vec" for n in ("a", "b", "broken", "empty", "wal")
    ]
    near, far = str(tmp_path / "near"), str(tmp_path / "far")
    results.ingest(spark, files.list_files(str(folder) + r"/runs/.*vec$")[1], near)
    results.ingest(spark, [*paths, f"{mounted}/runs/gone.vec"], far)
    name = F.substring_index("source_file", "/", -1)
    for table in ("signals", "scalars", "statistics", "run_attrs", "run_params", "runs"):
        a, b = (spark.read.parquet(f"{t}/{table}").withColumn("source_file", name) for t in (near, far))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty(), table
    errors = spark.read.parquet(f"{far}/ingest_errors").withColumn("source_file", name)
    assert {r.source_file for r in errors.collect()} == {"broken.vec", "empty.vec", "gone.vec"}
    (folder / "runs" / "wal.vec").unlink()


def test_files_too_large_for_memory_are_errors(spark, mounted):
    from siglake.sources import store

    found = {r.path[-5:]: (r.content, r.error) for r in store.contents(spark, [f"{mounted}/runs/a.vec"], 100).collect()}
    assert found["a.vec"][0] is None and "in one piece" in found["a.vec"][1]


def arrow_rows(df):
    return sorted(map(tuple, df.select("_frame", "_row", "k", "x", "t").collect()), key=repr)


@pytest.fixture(scope="module")
def saved(spark):
    rows = spark.range(1000).selectExpr(
        "concat('/d/run=', id % 3, '/a.vec') AS _frame", "id AS _row", "string(id % 7) AS k",
        "if(id % 5 = 0, null, id / 8) AS x", "timestamp_seconds(id) AS t",
    )
    return rows.repartition(4, "_row")


def test_arrow_files_come_back_as_they_were_saved(spark, saved, tmp_path, folder):
    path = str(tmp_path / "whole")
    assert sinks.save(saved, path, "arrow") and arrow_rows(arrow_files.read_arrow_folder(spark, path)) == arrow_rows(saved)
    assert sinks.save(saved, path, "arrow", mode="append") and arrow_files.read_arrow_folder(spark, path).count() == 2000
    assert sinks.save(saved.where("k = '3'"), path, "arrow")  # replaces
    assert arrow_rows(arrow_files.read_arrow_folder(spark, path)) == arrow_rows(saved.where("k = '3'"))
    assert not sinks.save(saved.where("false"), str(tmp_path / "none"), "arrow") and not (tmp_path / "none").exists()
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.saved.link./out", f"file:{path}")
    assert arrow_rows(arrow_files.read_arrow_folder(spark, "viewfs://saved/out")) == arrow_rows(saved.where("k = '3'"))


def test_arrow_files_of_each_frame_in_order(spark, saved, tmp_path):
    path = tmp_path / "frames"
    assert sinks.save(saved, str(path), "arrow", separate=True, common_root="/d")
    folders = sorted(p.name for p in path.iterdir())
    assert folders == [f"output=run%3D{i}%2Fa.vec" for i in range(3)]
    for found in path.rglob("*.arrow"):
        rows = pa.ipc.open_file(str(found)).read_all().column("_row").to_pylist()
        assert rows == sorted(rows)
    assert arrow_rows(arrow_files.read_arrow_folder(spark, str(path))) == arrow_rows(saved)


def test_a_failed_task_leaves_no_arrow_file(spark, saved, tmp_path):
    path = tmp_path / "kept"
    assert sinks.save(saved, str(path), "arrow")
    before = sorted(path.rglob("*"))
    failing = saved.withColumn("x", F.when(F.col("_row") == 777, F.raise_error(F.lit("no"))).otherwise(F.col("x")))
    with pytest.raises(Exception):
        sinks.save(failing, str(path), "arrow")
    assert sorted(path.rglob("*")) == before and arrow_rows(arrow_files.read_arrow_folder(spark, str(path))) == arrow_rows(saved)
