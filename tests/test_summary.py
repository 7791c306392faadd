import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siglake.operators import metrics, summary

SLICES = [10**6, 50]


@pytest.fixture(scope="module")
def values():
    random.seed(3)
    found = {"hot": [round(random.gauss(0, 5) ** 3, 2) for _ in range(900)]}
    found["even"] = [float(i % 50) for i in range(300)]
    found["few"] = [1.0, 2.0, 4.0]
    found["single"] = [3.0]
    return found


@pytest.fixture(scope="module")
def df(spark, values):
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("few", None), ("few", math.nan), (None, 1.0)]
    return spark.createDataFrame(rows, "g string, x double")


@pytest.mark.parametrize("size", SLICES)
def test_box_stats(df, values, size):
    got = {r.g: r for r in summary.box_stats(df, "x", ["g"], size).collect()}
    outliers = summary.box_outliers(df, "x", ["g"], size).collect()
    assert set(got) == set(values)
    for group, data in values.items():
        data, box = np.array(data), got[group]
        q1, median, q3 = np.percentile(data, [25, 50, 75])
        reach = 1.5 * (q3 - q1)
        inside = data[(data >= q1 - reach) & (data <= q3 + reach)]
        expected = (q1, median, q3, data.mean(), inside.min(), inside.max())
        assert np.allclose(expected, (box.q1, box.median, box.q3, box.mean, box.whisker_low, box.whisker_high))
        assert box.n == len(data) and box.outliers == len(data) - len(inside)
        notch = 1.57 * (q3 - q1) / math.sqrt(len(data))
        assert np.allclose((median - notch, median + notch), (box.notch_low, box.notch_high))
        beyond = data[(data < q1 - reach) | (data > q3 + reach)]
        assert sorted(r.x for r in outliers if r.g == group) == sorted(beyond.tolist())


@pytest.mark.parametrize("size", SLICES)
def test_boxes_of_everything(df, values, size):
    hot = df.where("g = 'hot'")
    box = summary.box_stats(hot, "x", rows_per_slice=size).first()
    assert box.median == pytest.approx(np.median(values["hot"])) and "_all" not in box
    assert summary.box_outliers(hot, "x", rows_per_slice=size).count() == box.outliers
    inner = summary.letter_values(hot, "x", rows_per_slice=size).where("level = 1").first()
    assert (inner.low, inner.high) == pytest.approx((box.q1, box.q3))


def test_whiskers_stop_at_the_box(spark):
    rows = [("a", v) for v in (0.0, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 100.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    box = summary.box_stats(df, "x", ["g"]).first()
    assert (box.whisker_low, box.whisker_high, box.outliers) == (0.0, 1.0, 1)


@pytest.mark.parametrize("size", SLICES)
def test_letter_values(df, values, size):
    got = summary.letter_values(df, "x", ["g"], size).collect()
    for group, data in values.items():
        depth = max(int(math.log2(len(data))) - 3, 1)
        boxes = {r.level: r for r in got if r.g == group}
        assert set(boxes) == set(range(1, depth + 1))
        for level, box in boxes.items():
            tail = 0.5 ** (level + 1)
            assert np.allclose(np.quantile(data, [tail, 1 - tail]), [box.low, box.high])


@pytest.mark.parametrize("size", SLICES)
def test_ecdf_ends_at_one(df, values, size):
    got = summary.ecdf(df, "x", ["g"], size).collect()
    for group, data in values.items():
        points = {r.x: r.proportion for r in got if r.g == group}
        assert set(points) == set(data) and points[max(data)] == 1.0
        middle = sorted(points)[len(points) // 2]
        assert points[middle] == pytest.approx(np.mean(np.array(data) <= middle))
    assert summary.ecdf(df, "x").agg(F.max("proportion")).first()[0] == 1.0


def test_histogram(df, values):
    got = summary.histogram(df, "x", 7, ["g"]).collect()
    everything = [v for vs in values.values() for v in vs]
    edges = np.histogram_bin_edges(everything, 7)
    for group, data in values.items():
        expected = {i: n for i, n in enumerate(np.histogram(data, edges)[0]) if n}
        assert {r.bin: r.n for r in got if r.g == group} == expected
        assert all(r.left == pytest.approx(edges[r.bin]) for r in got)
    same = df.where("g = 'single'")
    assert [(r.bin, r.n) for r in summary.histogram(same, "x", 5).collect()] == [(0, 1)]


@pytest.mark.parametrize("size", SLICES)
def test_automatic_bins(df, values, size):
    for group in values:
        expected = len(np.histogram_bin_edges(values[group], "auto")) - 1
        got = summary.automatic_bins(df.where(f"g = '{group}'"), "x", size)
        assert got == expected, group
    assert summary.automatic_bins(df.where("false"), "x") == 1
    counts = summary.histogram(df, "x", by=["g"]).agg(F.sum("n")).first()[0]
    assert counts == sum(len(v) for v in values.values())


def test_lines_and_counts(df, values):
    lines = {r.g: r for r in summary.line_summary(df, "g", "x").collect()}
    for group, data in values.items():
        assert lines[group].mean == pytest.approx(np.mean(data)) and lines[group].n == len(data)
    assert lines["single"].sd is None
    assert lines["even"].sd == pytest.approx(np.std(values["even"], ddof=1))
    means = summary.category_means(df, "g", "x").where("g = 'even'").first()
    assert means.high - means.mean == pytest.approx(1.96 * means.sd / math.sqrt(300))
    counts = {r.g: r.n for r in summary.category_counts(df, "g").collect()}
    assert counts == {"hot": 900, "even": 300, "few": 5, "single": 1}


def test_density(df, values):
    got = summary.density_grid(df, "x", ["g"], 50).collect()
    assert {r.g for r in got} == {"hot", "even", "few"}  # a single value has no bandwidth
    for group in ("hot", "even", "few"):
        data = np.array(values[group])
        width = data.std(ddof=1) * len(data) ** -0.2
        grid = np.linspace(data.min() - 2 * width, data.max() + 2 * width, 50)
        z = (grid[:, None] - data[None, :]) / width
        density = np.exp(-0.5 * z * z).sum(axis=1) / (len(data) * width * math.sqrt(2 * math.pi))
        rows = sorted((r.point, r.grid, r.density) for r in got if r.g == group)
        assert np.allclose([r[1] for r in rows], grid) and np.allclose([r[2] for r in rows], density)
    whole = summary.density_grid(df.where("g = 'few'"), "x", (), 50).count()
    assert whole == 50


def test_heat(spark):
    rows = [("a", -0.5, 0.5, 1.0), ("a", 0.5, 0.2, 3.0), ("a", 3.0, -2.5, 5.0), ("b", 9.0, 9.0, 7.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double")
    cells = {(r.x, r.y): r.z for r in summary.heat_cells(df.where("g='a'"), "x", "y", "z", 1.0).collect()}
    assert cells == {(0.0, 0.0): 2.0, (3.0, -2.0): 5.0}
    grid = {(r.x, r.y): r.z for r in summary.heat_grid(df.where("g='a'"), "x", "y", "z", 1.0).collect()}
    assert grid == {(0.0, 0.0): 2.0, (0.0, -2.0): 0.0, (3.0, 0.0): 0.0, (3.0, -2.0): 5.0}
    by = summary.heat_grid(df, "x", "y", "z", 1.0, ["g"], negate_y=True).collect()
    assert len(by) == 5 and {r.y for r in by if r.g == "a"} == {0.0, 2.0}
    matrix = summary.heat_matrix(df.where("g='a'"), "x", "y", "z", 1.0).orderBy("y").collect()
    assert [(r.y, [tuple(c) for c in r.cells]) for r in matrix] == [(-2.0, [(3.0, 5.0)]), (0.0, [(0.0, 2.0)])]


def test_values_beyond_all_numbers_and_no_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (None,)], "x double")
    found = sorted((r.left, r.n) for r in summary.histogram(df, "x", 2).collect())
    assert found == [(1.0, 1), (1.5, 1)]
    assert summary.letter_values(df.where("false"), "x").count() == 0


def test_density_over_a_wide_gap_has_all_points(spark):
    df = spark.createDataFrame([(v,) for v in [0.0] * 5000 + [1.0] * 5000 + [1e3]], "x double")
    points = summary.density_grid(df, "x").collect()
    assert len(points) == summary.GRID_POINTS and min(p.density for p in points) >= 0


def test_series_and_facets(spark):
    df = spark.createDataFrame([("h", 1, 2.0, None), ("h", 2, 3.0, 4)], "hue string, t int, a double, b int")
    rows = sorted(tuple(r) for r in summary.multi_series(df, "t", ["a", "b"], ["hue"]).collect())
    assert rows == [("h", 1, "a", 2.0), ("h", 2, "a", 3.0), ("h", 2, "b", 4.0)]
    assert df.select(summary.facet_key(["hue", "t"])).first().facet == "h|1"
    assert summary.points(df, "t", "a", ["hue"]).columns == ["hue", "t", "a"]


# Metrics ---------------------------------------------------------------------------------


def test_update_interval_is_the_mean_difference(spark):
    random.seed(5)
    data = [("f", i, f"m{i % 3}", random.randrange(10**9), 0.0) for i in range(100)]
    data += [("f", 100, "lone", 5, 0.0)]
    df = spark.createDataFrame(data, "_frame string, _row long, m string, simtimeRaw long, cbr double")
    got = {r.m: r.update_interval for r in metrics.update_interval(df, ["m"], "cbr").collect()}
    for module in ("m0", "m1", "m2"):
        times = np.sort([r[3] for r in data if r[2] == module])
        assert got[module] == pytest.approx(np.diff(times).mean())
    assert got["lone"] is None


def test_age_of_information(spark):
    data = [
        ("f", 1, "a", "aoi_1_100", 300 * 10**9, 10.0), ("f", 2, "a", "aoi_1_100", 200 * 10**9, 30.0),
        ("f", 3, "b", "aoi_1_100", 100 * 10**9, 5.0), ("f", 4, "c", "aoi_1_x", 100 * 10**9, 5.0),
    ]
    df = spark.createDataFrame(
        data, "_frame string, _row long, m string, variable string, simtimeRaw long, aoi string"
    )
    got = {r.m: r.mean_aoi for r in metrics.age_of_information(df, ["m"], "aoi").collect()}
    assert got == {"a": pytest.approx(0.2), "b": None, "c": None}


def test_sum_over_count(spark):
    data = [
        ("f", 1, "a", "sum", 8.0), ("f", 2, "a", "count", 2.0), ("f", 3, "b", "sum", 8.0),
        ("f", 4, "c", "sum", 8.0), ("f", 5, "c", "sum", 1.0), ("f", 6, "d", "sum", 1.0), ("f", 7, "d", "count", 0.0),
    ]
    df = spark.createDataFrame(data, "_frame string, _row long, m string, type string, v double")
    got = {r.m: r.mean for r in metrics.sum_over_count(df, ["m"], "v", "mean").collect()}
    assert got == {"a": 4.0, "b": None, "c": None, "d": None}


def test_small_steps(spark):
    df = spark.createDataFrame([("/x/city_dense/run-12/a.db", "ppe_7_12_sum")], "f string, v string")
    got = metrics.path_features(df, "f", r"/(?P<place>[a-z]+)_(?P<load>[a-z]+)/run-(?P<run>[0-9]+)(?P<rest>x)?/")
    assert got.select("place", "load", "run", "rest").first() == ("city", "dense", "12", None)
    row = df.select(
        metrics.last_field(F.col("v")), metrics.numbered_field(F.col("v"), 2),
        metrics.numbered_field(F.col("v"), 3), metrics.relabel(F.col("v"), "ppe", "no"),
        metrics.complement(F.lit(0.25)),
    ).first()
    assert tuple(row) == ("sum", 12, None, "ppe", 0.75)
