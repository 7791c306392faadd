import pytest
from pyspark.sql import functions as F

from siglake.operators import extract, tags
from siglake.sources.results import Results

CP = "*.node[*].middleware.CpService."
DCC = "*.node[*].middleware.facDcc."


def params(spark, rows):
    data = [("f", i, k, v) for i, (k, v) in enumerate(rows)]
    return spark.createDataFrame(data, "source_file string, _row long, key string, value string")


def attrs(spark, rows, file="f"):
    data = [(file, i, k, v) for i, (k, v) in enumerate(rows)]
    return spark.createDataFrame(data, "source_file string, _row long, attrName string, attrValue string")


def found(df):
    return {r.key: r.value for r in df.collect()}


PARAMETERS = [
    ("**.vehicle_rate", "0.3", "v2x_rate", "0.3"),
    ("x **.plain_rate y", "0.1", "plain_rate", "0.1"),
    ("**.cp_rate", "1", "cp_rate", "1.0"),
    ("**.ca_rate", "bad", "ca_rate", None),
    ("**.vanetza[*].dcc.typename", '"Dcc"', "dcc", "Dcc"),
    (CP + "generationRule", '"rule"', "gen_rule", "rule"),
    (CP + "RedundancyMitigation_Method", '"m"', "red_mit", "m"),
    (CP + "RedundancyMitigation_W_Redundancy", "w", "w_red", "w"),
    (CP + "RedundancyMitigation_N_Redundancy", "n", "n_red", "n"),
    (CP + "RedundancyMitigation_P_Redundancy", "p", "p_red", "p"),
    (CP + "RedundancyMitigation_S_Redundancy", "s", "s_red", "s"),
    (CP + "RedundancyMitigation_WD_Redundancy", "wd", "wd_red", "wd"),
    ("*.traci.core.startTime", "5s-3s", "traciStart", "2.0"),
    ("$warmup-period=20s", "w=5s+3s", "warmup", "8.0"),
    ("$limit=20s", "w=5s", "limit", "5.0"),
    ("**.vanetza[*].dcc.queueLength", "4", "queueLength", "4"),
    (CP + "dccProfile", "3", "dcc_profile", "3"),
    ("*.ca_weight", "0.5", "ca_weight", "0.5"),
    ("*.cp_weight", "0.25", "cp_weight", "0.25"),
    (DCC + "schedulerParameterAlpha", "0.1", "scheduler_parameter_alpha", "0.1"),
    ("*.node[*].middleware.ExampleServiceCam.packetLength", "300", "cam_length", "300"),
    ("*.node[*].middleware.ExampleServiceCpm.packetLength", "400", "cpm_length", "400"),
    (DCC + "useWfqScheduler", "false", "wfq_scheduler", "true"),
    (DCC + "useWfqSelector", "", "wfq_selector", "false"),
    ("*.radioMedium.pathLossType", '"Two"', "pathloss", "Two"),
]


def test_every_parameter_rule(spark):
    df = params(spark, [(k, v) for k, v, _, _ in PARAMETERS])
    assert found(tags.parameter_tags(df)) == {tag: value for _, _, tag, value in PARAMETERS}


def test_every_iterationvars_rule(spark):
    text = (
        "$sensorConf=abc, $period=0.5s, $traciStart=5s-1s, $simulationStart=7s, $1=10s+20s, "
        "$limit=9s, vehicles-0.3-plain-0.5., services-ca-0.1-cp-0.25"
    )
    df = attrs(spark, [("iterationvars", text), ("iterationvars", "$period=99s")])
    assert found(tags.iterationvars_tags(df)) == {
        # the patterns take the shortest text: up to the first s, and one decimal
        "sensors": "abc", "period": "0.5", "traciStart": "5.0", "simulationStart": "7.0",
        "simulationEnd": "30.0", "limit": "9.0", "v2x_rate": "0.3", "cp_rate": "0.2",
    }


def test_attribute_rules(spark):
    df = attrs(spark, [("configname", "base_MCO")])
    assert found(tags.attribute_tags(df)) == {"prefix": "base_MCO", "MCO": "true", "SCO": "false"}


def test_last_writer_wins(spark):
    p = params(spark, [("**.vehicle_rate", "0.1"), ("v2x_rate", "0.9"), ("**.vehicle_rate", "0.2")])
    a = attrs(spark, [("other", "1")])
    assert found(tags.last_writer(tags.all_tags(p, a)))["v2x_rate"] == "0.2"
    a = attrs(spark, [("v2x_rate", "0.5")])
    assert found(tags.last_writer(tags.all_tags(p, a)))["v2x_rate"] == "0.5"
    a = attrs(spark, [("iterationvars", "vehicles-0.7-plain-0.1."), ("v2x_rate", "0.5")])
    assert found(tags.last_writer(tags.all_tags(p, a)))["v2x_rate"] == "0.7"


def test_custom_rules_replace_those_of_a_tag(spark):
    rules = tags.RuleSet.build(
        parameters={"dcc": [tags.Rule("own", F.upper), tags.Rule("own$", F.reverse)]}
    )
    p = params(spark, [("own", "abc"), ("**.vanetza[*].dcc.typename", "no"), ("**.cp_rate", "1")])
    got = found(tags.last_writer(tags.parameter_tags(p, rules.parameters)))
    assert got == {"dcc": "cba", "cp_rate": "1.0"}


def test_wide_tags_are_typed_and_limited_to_the_list(spark):
    p = params(spark, [("**.vehicle_rate", "0.1"), (DCC + "useWfqScheduler", "1"), ("extra", "z")])
    a = attrs(spark, [("repetition", "3"), ("configname", "x")])
    allowed = tags.allowed_tags(additional=["wfq_scheduler", "queueLength"])
    row = tags.wide_tags(tags.all_tags(p, a), allowed).first()
    assert (row.v2x_rate, row.wfq_scheduler, row.queueLength, row.repetition) == (0.1, True, None, "3")
    assert row.prefix == "x" and "extra" not in row
    assert "dcc" in tags.allowed_tags(minimal=False) and tags.allowed_tags(["a"], ["b"]) == ["a", "b"]


def test_tag_overwrites_a_data_column(spark):
    facts = spark.createDataFrame([("f", 1.0), ("g", 2.0)], "source_file string, value double")
    wide = spark.createDataFrame([("f", "7", "t")], "source_file string, value string, tag string")
    rows = sorted(tuple(r) for r in tags.tag_rows(facts, wide).collect())
    assert rows == [("f", 7.0, "t"), ("g", 2.0, None)]


@pytest.fixture(scope="module")
def results(spark):
    signals = spark.createDataFrame(
        [
            ("f", 1, "m0", "PdrDistance_7:vector", 10, 100, 0.5),
            ("f", 2, "m1", "pdrdistance_x:vector", 11, 200, 0.6),
            ("f", 3, "m1", "cbr:vector", 12, 300, 0.7),
        ],
        "source_file string, _row long, moduleName string, vectorName string, eventNumber long, "
        "simtimeRaw long, value double",
    )
    scalars = spark.createDataFrame(
        [("f", 1, 0, "m", "n_1:sum", 4.0), ("f", 2, 0, "m", "other", 1.0)],
        "source_file string, _row long, runId long, moduleName string, scalarName string, scalarValue double",
    )
    return Results(
        signals=signals, scalars=scalars,
        run_params=params(spark, [("**.vehicle_rate", "0.1")]),
        run_attrs=attrs(spark, [("configname", "c")]),  # no iteration variables
    )


def test_extract_matching_drops_other_names(results):
    df = extract.extract_matching(results, r"PdrDistance_(?P<index>[0-9]+):", "pdr_{index}")
    row, = df.collect()
    assert (row.variable, row.value, row.v2x_rate, row.prefix, row._frame) == ("pdr_7", 0.5, 0.1, "c", "f")
    assert "vectorName" not in df.columns


def test_extract_like_keeps_names_without_match(results):
    df = extract.extract_like(results, "PDR%", "pdr", r"Distance_(?P<index>\d+)", "pdr_{index}")
    assert {r.variable: r.pdr for r in df.collect()} == {"pdr_7": 0.5, "pdrdistance_x:vector": 0.6}


def test_extract_options(results):
    options = extract.Options(
        base_tags=["prefix"], moduleName=False, eventNumber=False, include_filename=True,
        categorical=["prefix"], numerical={"simtimeRaw": "float"},
    )
    df = extract.extract_signal(results, "cbr:vector", "cbr", options)
    assert set(df.columns) == {
        "source_file", "_row", "simtimeRaw", "cbr", "prefix", "filename", "prefix_ord", "_frame"
    }
    assert (df.first().filename, df.first().simtimeRaw, df.first().prefix_ord) == ("f", 300.0, 0)


def test_conditions_after_extraction_reach_the_scan(spark, results, tmp_path):
    results.signals.write.parquet(str(tmp_path / "signals"))
    stored = Results(
        signals=spark.read.parquet(str(tmp_path / "signals")),
        run_params=results.run_params, run_attrs=results.run_attrs,
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = extract.extract_signal(stored, "cbr:vector", "cbr").where("moduleName = 'm1'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(moduleName,m1)" in plan and df.count() == 1


def test_run_key_named_like_a_data_column_is_a_tag(spark, results):
    named = Results(
        signals=results.signals, run_params=results.run_params,
        run_attrs=results.run_attrs.unionAll(attrs(spark, [("moduleName", "from the run")])),
    )
    assert named.metadata.data_columns == ["moduleName"]
    assert extract.extract_signal(named, "cbr:vector", "cbr").first().moduleName == "from the run"


def test_extract_scalars_like(results):
    df = extract.extract_scalars_like(results, "N_%", "ppe", "n_(?P<o>.*):(?P<k>.*)", "{k}_{o}", scalarName=True)
    row, = df.collect()
    assert (row.variable, row.scalarName, row.ppe) == ("sum_1", "n_1:sum", 4.0)


def test_melt(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, a double, b double")
    assert sorted(tuple(r) for r in extract.melt(df, ["a", "b"]).collect()) == [(1, "a", 2.0), (1, "b", 3.0)]
