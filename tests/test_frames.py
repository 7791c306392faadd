import pandas as pd
import pytest
from pyspark.sql import functions as F

from siglake.operators import columns, compare, frames, joins, ranking
from siglake.plans import selection


@pytest.fixture(scope="module")
def df(spark):
    rows = [
        ("a", 2, "k1", 1.0, "second"), ("a", 1, "k1", 3.0, "first"), ("a", 3, "k2", 5.0, "third"),
        ("b", 1, "k1", 7.0, "other file"), ("b", 2, None, 9.0, "no key"), ("b", 3, "k1", None, "no value"),
    ]
    return spark.createDataFrame(rows, "_frame string, _row long, k string, x double, note string")


def rows(df, *names):
    return sorted(df.select(*names).collect(), key=repr)


def test_groups_stay_within_a_frame_and_carry_the_first_row(df):
    got = frames.aggregate_groups(df, ["k"], "x", "mean", "mean")
    assert got.columns == ["_frame", "_row", "k", "note", "mean"]
    assert rows(got, "_frame", "k", "note", "mean") == [
        ("a", "k1", "first", 2.0), ("a", "k2", "third", 5.0), ("b", "k1", "other file", 7.0)
    ]


def test_groups_across_frames(df):
    got = frames.aggregate_groups(df, ["k"], "x", "total", "sum", across_frames=True)
    assert rows(got, "_frame", "k", "note", "total") == [("a", "k1", "first", 11.0), ("a", "k2", "third", 5.0)]


@pytest.mark.parametrize(
    "name, expected",
    [("size", 4), ("count", 3), ("min", 1.0), ("max", 7.0), ("median", 3.0), ("var", 28 / 3)],
)
def test_named_aggregates(df, name, expected):
    got = frames.aggregate_groups(df, ["k"], "x", "r", name, across_frames=True)
    assert got.where("k = 'k1'").first().r == pytest.approx(expected)


def test_median_of_input_that_needs_several_slices(df, monkeypatch):
    whole = frames.aggregate_groups(df, ["k"], "x", "r", "median")
    monkeypatch.setattr(frames, "slice_cuts", lambda df, x: ranking.slice_cuts(df, x, 2))
    got = frames.aggregate_groups(df, ["k"], "x", "r", "median")
    assert got.columns == whole.columns == ["_frame", "_row", "k", "note", "r"]
    assert rows(got, *got.columns) == rows(whole, *got.columns) and got.count() == 3


def test_median_of_missing_values_in_several_slices(spark, monkeypatch):
    monkeypatch.setattr(frames, "slice_cuts", lambda df, x: ranking.slice_cuts(df, x, 2))
    values = [("k1", 1.0), ("k1", None), ("k1", float("nan")), ("k1", 4.0), ("k2", float("nan")), ("k2", None), ("k3", 6.0), (None, 8.0)]
    data = spark.createDataFrame([("a", i, k, x) for i, (k, x) in enumerate(values)], "_frame string, _row long, k string, x double")
    got = frames.aggregate_groups(data, ["k"], "x", "r", "median")
    assert rows(got, "_row", "k", "r") == [(0, "k1", 2.5), (4, "k2", None), (6, "k3", 6.0)]


def test_raw_groups(df):
    got = frames.aggregate_groups_raw(df, ["k"], "r", {"lo": F.min("x"), "hi": F.max("x")})
    assert rows(got, "_frame", "k", "r.lo", "r.hi") == [
        ("a", "k1", 1.0, 3.0), ("a", "k2", 5.0, 5.0), ("b", "k1", 7.0, 7.0)
    ]


def test_assigned_aggregate_and_expression(df):
    got = frames.assign_groups(df, ["k"], "m", {"mean": F.avg("x")})
    assert rows(got, "_frame", "_row", "m") == [
        ("a", 1, 2.0), ("a", 2, 2.0), ("a", 3, 5.0), ("b", 1, 7.0), ("b", 3, 7.0)
    ]
    off = frames.assign_groups(df, ["k"], "x", {"mean": F.avg("x")}, F.col("x") - F.col("mean"))
    assert rows(off, "_frame", "_row", "x")[:2] == [("a", 1, 1.0), ("a", 2, -1.0)]


def test_pandas_functions_agree_with_native_ones(df):
    native = frames.aggregate_groups(df, ["k"], "x", "r", "mean")
    series = frames.aggregate_groups_pandas(df, ["k"], "x", "r", lambda s: s.mean())
    assert rows(series, *native.columns) == rows(native, *native.columns)
    whole = frames.apply_groups_pandas(
        df, ["k"], lambda p: pd.DataFrame({"k": p.k.iloc[:1], "first": p.note.iloc[:1]}), "k string, first string"
    )
    assert rows(whole, "k", "first") == [("k1", "first"), ("k1", "other file"), ("k2", "third")]
    framed = frames.apply_frame_pandas(df, lambda p: p.head(1), df.schema.simpleString()[7:-1].replace(":", " "))
    assert rows(framed, "_frame", "note") == [("a", "first"), ("b", "other file")]


def test_concat_is_one_frame_in_dataset_order(spark, df):
    more = spark.createDataFrame([("a", 0, 1)], "_frame string, _row long, extra int")
    both = frames.concat([df, more], "all")
    assert {r._frame for r in both.collect()} == {"all"} and both.count() == 7
    assert set(both.columns) == {"_frame", "_row", "_part", "k", "x", "note", "extra"}
    first = frames.aggregate_groups(both.fillna({"k": "none"}), [], "x", "n", "size").first()
    assert (first.note, first.n) == ("first", 7)  # dataset order before row order
    again = frames.concat([both, df], "twice")
    assert frames.aggregate_groups(again, [], "x", "n", "size").first().n == 13


def test_frame_function(df):
    assert frames.apply_frame(df, lambda d: d.where("x > 4")).count() == 3


def test_conversion(spark):
    df = spark.createDataFrame([("1.5", "a10"), ("x", "a2"), (None, None)], "n string, c string")
    got = columns.convert_columns(df, ["c", "missing"], {"n": "float", "gone": "int"})
    assert rows(got, "n", "c_ord") == [(1.5, 1), (None, 0), (None, None)]
    assert columns.cast_failures(df, ["n"]).first().n == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        columns.cast_columns(df, ["n"], strict=True).collect()


# Merging ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(
        [("f", "f", 1, "a", 1), ("f", "f", 2, None, 2), ("g", "g", 1, "a", 3), ("z", "z", 1, "a", 9)],
        "_frame string, source_file string, _row long, k string, v int",
    )
    right = spark.createDataFrame(
        [("f", "f", 1, "a", 10), ("f", "f", 2, None, 20), ("g", "g", 1, "b", 30)],
        "_frame string, source_file string, _row long, k string, v int",
    )
    return left, right


def test_merge_matches_missing_keys_and_renames_clashes(sides):
    got = joins.merge_by_attribute(*sides, left_keys=["k"])
    assert got.columns == ["_frame", "source_file", "_row", "k", "v", "v_r"]
    assert rows(got, "k", "v", "v_r") == [("a", 1, 10), (None, 2, 20)]


def test_merge_with_unlike_key_names(sides):
    left, right = sides
    got = joins.merge_by_attribute(left, right.withColumnRenamed("k", "q"), ["k"], ["q"])
    assert rows(got, "k", "q", "v_r") == [("a", "a", 10), (None, None, 20)]


def test_natural_merge_uses_all_shared_columns(sides):
    left, right = sides
    assert joins.natural_merge(left, right).count() == 0  # k and v
    assert joins.natural_merge(left, right.withColumnRenamed("v", "w")).count() == 2
    with pytest.raises(ValueError):
        joins.natural_merge(left, right.select("_frame", "source_file"))


@pytest.mark.parametrize("size", [100, 1])
def test_merge_by_position_pairs_nth_frames(spark, sides, size):
    left, right = sides
    renamed = right.withColumn("_frame", F.concat(F.lit("other_"), "_frame")).drop("source_file")
    got = joins.merge_by_position(left, renamed, ["k"], rows_per_slice=size)
    assert rows(got, "_frame", "k", "v", "v_r") == [("f", "a", 1, 10), ("f", None, 2, 20)]


def test_join_per_file(spark, sides):
    config = spark.createDataFrame([("f", 5), ("f", 6), ("g", 7)], "source_file string, payload int")
    assert rows(joins.join_per_file(sides[0], config), "v", "payload") == [(1, 5), (1, 6), (2, 5), (2, 6), (3, 7)]


def test_concatenated_files_are_merged_without_all_pairs_of_rows(spark, tmp_path):
    """Two files with 300 and 200 events of one module and slot."""
    orders = [(7 + 1000 * i, 20 if i % 5 < 3 else 40, 100.0 * i) for i in range(500)]
    tables = {
        "customer": spark.createDataFrame([(20, "c", 1, 5.0, "m"), (40, "d", 2, 6.0, "m")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").selectExpr("*", "timestamp_ntz'1995-01-01' AS o_orderdate"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = selection.merge_concatenated(spark, str(tmp_path))
    found = {(r["source_file"], r["source_file_r"]): (r["n"], r["first_event"], r["last_event"]) for r in got.collect()}
    one, two = (300, 7, 497_007), (200, 3_007, 499_007)
    assert found == {(f"run_{a}.vec", f"run_{b}.vec"): (x[0] * y[0], *x[1:]) for a, x in ((1, one), (2, two)) for b, y in ((1, one), (2, two))}
    plan = got._jdf.queryExecution().executedPlan().finalPhysicalPlan()

    def joined(node):
        if "Join" in node.nodeName():
            yield node.metrics().apply("numOutputRows").value()
        inner = node.plan() if "QueryStage" in node.nodeName() else node
        for i in range(inner.children().size()):
            yield from joined(inner.children().apply(i))

    assert max(joined(plan)) == 4


# Comparison ------------------------------------------------------------------------------


def test_comparison(spark, df):
    assert [r.equal for r in compare.frames_equal([df, df]).collect()] == [False]  # NULL cells
    full = df.where("k IS NOT NULL AND x IS NOT NULL")
    changed = full.withColumn("x", F.when(F.col("_row") == 2, 0.0).otherwise(F.col("x")))
    assert [r.equal for r in compare.frames_equal([full, full, changed]).orderBy("pair").collect()] == [True, False]
    assert compare.frames_diff(df, df).count() == 0
    cell, = compare.frames_diff(full, changed).collect()
    assert tuple(cell) == ("a", 2, "x", "1.0", "0.0")
    assert rows(compare.rows_differ(full, changed), "x", "side", "n") == [(0.0, "right", 1), (1.0, "left", 1)]
    twice = compare.rows_differ(full.unionAll(full).unionAll(full), full)
    assert {(r.side, r.n) for r in twice.collect()} == {("left", 2)}
    with pytest.raises(ValueError):
        compare.frames_diff(df, df.drop("x"))


@pytest.mark.parametrize("size", [100, 2])
def test_rows_paired_by_position(df, size):
    numbered = compare.with_ordinal(df, size)
    assert rows(numbered, "_frame", "_row", "_ordinal") == [
        (f, r, r - 1) for f in "ab" for r in (1, 2, 3)
    ]


def test_group_results_are_not_sorted(spark):
    import __spark_entry__ as contract

    for name in ("group_mean", "group_mean_across_frames", "update_interval", "age_of_information", "sum_over_count", "group_function"):
        df = contract.queries()[name](spark, "/root/testdata/sf0.001")
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString(), name


def test_more_groups_than_fit_in_memory_are_sorted(spark):
    rows = spark.range(5000).selectExpr("'f' AS _frame", "5000 - id AS _row", "id % 700 AS k", "id AS x", "string(id) AS note")
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    usual = spark.conf.get(name)
    got = []
    for threshold in (usual, "3"):
        spark.conf.set(name, threshold)
        got.append(sorted(frames.aggregate_groups(rows, ["k"], "x", "total", "sum").collect()))
    spark.conf.set(name, usual)
    assert got[0] == got[1] and len(got[0]) == 700
    assert {(r.k, r.note) for r in got[0]} == {(i % 700, str(i)) for i in range(4300, 5000)}


def test_groups_pass_through_in_batches_and_in_order(spark):
    rows = spark.range(20_000).selectExpr("'f' AS _frame", "19999 - id AS _row", "id % 2 AS k", "double(id) AS x").repartition(7)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, "128")

    def check(batches):
        last, largest, n = -1, 0, 0
        for batch in batches:
            assert batch["_row"].is_monotonic_increasing and batch["_row"].iloc[0] > last
            last, largest, n = batch["_row"].iloc[-1], max(largest, len(batch)), n + len(batch)
        return {"n": n, "largest": largest}

    try:
        found = frames.stream_raw(rows, ["k"], "r", check, "struct<n:bigint,largest:bigint>").collect()
        assert [(r.r.n, r.r.largest) for r in found] == [(10_000, 128)] * 2
        series = frames.stream_assign(rows, ["k"], "x", "y", lambda pieces: (p * 2 for p in pieces))
        assert series.where("y = 2 * x").count() == 20_000
        plan = series._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Sort [") == 1
        first = frames.stream_aggregate(rows, ["k"], "x", "n", lambda pieces: sum(map(len, pieces)), "long").collect()
        assert sorted((r.k, r._row, r.n) for r in first) == [(0, 1, 10_000), (1, 0, 10_000)]
    finally:
        spark.conf.set(name, usual)


def test_a_streamed_function_has_to_answer_each_batch(spark, df):
    with pytest.raises(Exception, match="fewer series"):
        frames.stream_assign(df, ["k"], "x", "y", lambda pieces: (p for p in list(pieces)[1:])).collect()
