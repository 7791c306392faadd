"""Order statistics on small slices against brute force, one group holding most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siglake.operators import ranking
from siglake.operators.columns import order_categories
from siglake.sources.files import sample_rows

SLICES = [ranking.ROWS_PER_SLICE, 40]


@pytest.fixture(scope="module")
def rows():
    random.seed(7)
    data = []
    for i in range(1500):
        group = "hot" if i % 3 else f"g{i % 17}"
        value = 5.0 if random.random() < 0.3 else round(random.lognormvariate(0, 3), 2)
        data.append((group, value, i))
    return [*data, ("hot", None, 1500), ("one", 1.0, 1501)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "g string, x double, id long").repartition(5)


def groups(rows):
    found = {}
    for group, value, _ in rows:
        if value is not None:
            found.setdefault(group, []).append(value)
    return found


@pytest.mark.parametrize("size", SLICES)
def test_quantiles(df, rows, size):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.g: r for r in ranking.group_quantiles(df, ["g"], "x", probabilities, size).collect()}
    for group, values in groups(rows).items():
        assert got[group].n == len(values)
        assert np.allclose(got[group].q, np.quantile(values, probabilities)), group


@pytest.mark.parametrize("size", SLICES)
def test_cumulative_counts(df, rows, size):
    got = {(r.g, r.x): r for r in ranking.cumulative_counts(df, ["g"], "x", size).collect()}
    expected = {(g, v) for g, values in groups(rows).items() for v in values}
    assert set(got) == expected
    for (group, value), row in got.items():
        values = groups(rows)[group]
        assert row.n == values.count(value)
        assert row.cumulative == sum(v <= value for v in values)
        assert row.total == len(values)


@pytest.mark.parametrize("size", SLICES)
def test_row_ordinals(df, rows, size):
    got = ranking.row_ordinal(df, ["g"], "id", "nth", size).collect()
    assert len(got) == len(rows)
    for group in {r.g for r in got}:
        part = sorted((r.id, r.nth) for r in got if r.g == group)
        assert [n for _, n in part] == list(range(len(part)))


@pytest.mark.parametrize("size", SLICES)
def test_global_ordinals(df, rows, size):
    got = ranking.global_ordinal(df, [F.col("g"), F.col("id")], "nth", size).collect()
    assert [r.nth for r in sorted(got, key=lambda r: (r.g, r.id))] == list(range(len(rows)))


@pytest.mark.parametrize("size", SLICES)
def test_category_ordinals(spark, size):
    names = [f"s_{i}" for i in range(120)]
    df = spark.createDataFrame([(n,) for n in names * 3] + [(None,)], "c string")
    got = order_categories(df, ["c"], size).collect()
    assert len(got) == 361
    assert all(r.c_ord == (None if r.c is None else int(r.c[2:])) for r in got)


@pytest.mark.parametrize("fraction", [0.0, 0.013, 0.5, 1.0])
def test_sample_is_exact_per_frame_and_repeatable(df, rows, fraction):
    named = df.withColumnsRenamed({"g": "_frame", "id": "_row"})
    first = {(r._frame, r._row) for r in sample_rows(named, fraction).collect()}
    again = {(r._frame, r._row) for r in sample_rows(named.repartition(3), fraction).collect()}
    assert first == again
    sizes = {}
    for group, _, _ in rows:
        sizes[group] = sizes.get(group, 0) + 1
    for group, size in sizes.items():
        assert sum(f == group for f, _ in first) == round(fraction * size)


@pytest.mark.parametrize("size", SLICES)
def test_missing_and_infinite_values(spark, size):
    inf, nan = float("inf"), float("nan")
    values = [float(i % 60) for i in range(300)] + [None, nan, inf, -inf, None, nan]
    df = spark.createDataFrame([("hot", v, i) for i, v in enumerate(values)], "g string, x double, id long").repartition(4)
    numbers = sorted(v for v in values if v is not None and v == v)
    found = ranking.group_quantiles(df, ["g"], "x", [0.0, 0.5, 1.0], size).first()
    assert found.n == len(numbers) and list(found.q) == [-inf, float(np.median(numbers)), inf]
    counts = {r.x: r.cumulative for r in ranking.cumulative_counts(df, ["g"], "x", size).collect()}
    assert counts == {v: sum(w <= v for w in numbers) for v in set(numbers)}
    rows = ranking.row_ordinal(df, ["g"], "x", "nth", size).collect()
    assert sorted(r.nth for r in rows) == list(range(len(values)))
    rank = lambda v: (0, 0.0) if v is None else (2, 0.0) if v != v else (1, v)
    assert [rank(r.x) for r in sorted(rows, key=lambda r: r.nth)] == sorted(map(rank, values))


def test_one_pass_of_statistics(spark):
    from siglake.operators import ranking

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.range(20_000).selectExpr("double(hash(id)) AS x").mapInPandas(counted, "x double")
    assert len(ranking.slice_cuts(df, "x", 1_000)) == 19
    assert read.value == 20_000


def test_cuts_are_near_the_quantiles(spark):
    from siglake.operators import ranking

    df = spark.range(200_000).selectExpr("if(id % 10 = 0, double('infinity'), pow(id, 2)) AS x").repartition(9)
    cuts = ranking.slice_cuts(df, "x", 10_000)
    assert len(cuts) == 19 and all(abs(c**0.5 - 10_000 * (i + 1)) < 1000 for i, c in enumerate(cuts))
    assert ranking.slice_cuts(df.where("x > 1e308"), "x", 100) == []
    assert ranking.slice_cuts(df.where("x < 0"), "x", 100) == []
