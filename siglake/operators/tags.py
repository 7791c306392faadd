"""Tags: run metadata parsed by rules and attached to rows as typed columns.

A tag rule searches a pattern in a parameter or attribute name (or in the
``iterationvars`` text) and turns the value into a tag. All rules run in one
pass over the metadata, which gives a long table ``(source_file, key, value)``;
of several values for a key the last writer wins, in the order of ``Stage``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from enum import IntEnum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.functions.numbers import eval_sum, to_double, to_long
from siglake.functions.text import Pattern, field, remove, strip
from siglake.model import ROW, SOURCE
from siglake.operators.columns import TYPES


class Stage(IntEnum):
    RAW_PARAMETER = 1
    PARAMETER = 2
    RAW_ATTRIBUTE = 3
    ATTRIBUTE = 4
    ITERATIONVARS = 5


@dataclass(frozen=True)
class Rule:
    pattern: str
    transform: Callable[[Column], Column]
    type: str = "string"


Rules = Mapping[str, Sequence[Rule]]


def _number(pattern: str) -> list[Rule]:
    return [Rule(re.escape(pattern), to_double, "double")]


def _integer(pattern: str) -> list[Rule]:
    return [Rule(re.escape(pattern), to_long, "bigint")]


def without_quotes(text: Column) -> Column:
    return strip(text, '"')


def is_set(text: Column) -> Column:
    """Any text counts as true, even ``false``."""
    return F.length(text) > 0


def seconds(text: Column) -> Column:
    """``5s+3s`` read as 8."""
    return eval_sum(remove(text, "s"))


def assigned_seconds(text: Column) -> Column:
    """``$name=5s+3s`` read as 8."""
    return seconds(field(text, "=", 1))


def as_is(text: Column) -> Column:
    return text


def _unquoted(pattern: str) -> list[Rule]:
    return [Rule(re.escape(pattern), without_quotes)]


def _truthy(pattern: str) -> list[Rule]:
    return [Rule(re.escape(pattern), is_set, "boolean")]


def _assigned_sum(pattern: str) -> list[Rule]:
    return [Rule(pattern, assigned_seconds, "double")]


# Tag names and the parameter names they are read from.
PARAMETER_RULES: Rules = {
    "v2x_rate": _number("**.vehicle_rate"),
    "plain_rate": _number("**.plain_rate"),
    "cp_rate": _number("**.cp_rate"),
    "ca_rate": _number("**.ca_rate"),
    "dcc": _unquoted("**.vanetza[*].dcc.typename"),
    "gen_rule": _unquoted("*.node[*].middleware.CpService.generationRule"),
    "red_mit": _unquoted("*.node[*].middleware.CpService.RedundancyMitigation_Method"),
    "w_red": _unquoted("*.node[*].middleware.CpService.RedundancyMitigation_W_Redundancy"),
    "n_red": _unquoted("*.node[*].middleware.CpService.RedundancyMitigation_N_Redundancy"),
    "p_red": _unquoted("*.node[*].middleware.CpService.RedundancyMitigation_P_Redundancy"),
    "s_red": _unquoted("*.node[*].middleware.CpService.RedundancyMitigation_S_Redundancy"),
    "wd_red": _unquoted("*.node[*].middleware.CpService.RedundancyMitigation_WD_Redundancy"),
    "traciStart": [Rule(re.escape("*.traci.core.startTime"), seconds, "double")],
    "warmup": _assigned_sum(r"\$warmup-period=.*?s"),
    "limit": _assigned_sum(r"\$limit=.*?s"),
    "queueLength": _integer("**.vanetza[*].dcc.queueLength"),
    "dcc_profile": _integer("*.node[*].middleware.CpService.dccProfile"),
    "ca_weight": _number("*.ca_weight"),
    "cp_weight": _number("*.cp_weight"),
    "scheduler_parameter_alpha": _number("*.node[*].middleware.facDcc.schedulerParameterAlpha"),
    "cam_length": _integer("*.node[*].middleware.ExampleServiceCam.packetLength"),
    "cpm_length": _integer("*.node[*].middleware.ExampleServiceCpm.packetLength"),
    "wfq_scheduler": _truthy("*.node[*].middleware.facDcc.useWfqScheduler"),
    "wfq_selector": _truthy("*.node[*].middleware.facDcc.useWfqSelector"),
    "pathloss": _unquoted("*.radioMedium.pathLossType"),
}

# Patterns searched in the text of the iteration variables.
ITERATIONVARS_RULES: Rules = {
    "period": [
        Rule(r"\$period=.*?s", lambda v: to_double(strip(field(v, "=", 1), "s")), "double")
    ],
    "v2x_rate": [
        Rule(
            r"vehicles-((.\..)|(.\...))-plain-((.\..\.)|(.\...\.))",
            lambda v: to_double(field(v, "-", 1)),
            "double",
        )
    ],
    "cp_rate": [
        Rule(
            r"services-ca-((.\..)|(.\...))-cp-((.\..)|(.\...))",
            lambda v: to_double(field(v, "-", 4)),
            "double",
        )
    ],
    "traciStart": _assigned_sum(r"\$traciStart=.*?s"),
    "simulationStart": _assigned_sum(r"\$simulationStart=.*?s"),
    "simulationEnd": _assigned_sum(r"\$1=.*?s\+.*?s"),
    "limit": _assigned_sum(r"\$limit=.*?s"),
    "sensors": [Rule(r"\$sensorConf=.*?,", lambda v: field(strip(v, ","), "=", 1))],
}

# Tags read from run attributes.
ATTRIBUTE_RULES: Rules = {
    "prefix": [Rule("configname", as_is)],
    "MCO": [Rule("configname", lambda v: v.contains("MCO"), "boolean")],
    "SCO": [Rule("configname", lambda v: v.contains("SCO"), "boolean")],
}

# Tags attached unless a list is given.
MINIMAL_TAGS = (
    "v2x_rate", "value", "var", "moduleName", "repetition", "simtimeRaw", "eventNumber",
    "configname", "experiment", "prefix", "runnumber", "sumocfgname",
)
FULL_TAGS = (
    "v2x_rate", "red_mit", "value", "var", "moduleName", "repetition", "simtimeRaw",
    "eventNumber", "configname", "datetime", "dcc", "dcc_profile", "experiment", "gen_rule",
    "index", "inifile", "iterationvars", "iterationvarsf", "measurement", "network", "pathloss",
    "period", "plain_rate", "prefix", "processid", "queueLength", "replication", "resultdir",
    "runnumber", "seedset", "simulationEnd", "traciStart", "MCO", "SCO", "n_red", "p_red",
    "s_red", "wd_red", "zoi", "mcmI", "mcmL", "sumocfgname", "Lp_tx_min", "delta_t",
)


@dataclass(frozen=True)
class RuleSet:
    parameters: Rules = None
    attributes: Rules = None
    iterationvars: Rules = None

    @staticmethod
    def build(
        parameters: Rules | None = None,
        attributes: Rules | None = None,
        iterationvars: Rules | None = None,
    ) -> "RuleSet":
        """Built-in rules; custom ones replace all rules of the same tag and category."""
        return RuleSet(
            {**PARAMETER_RULES, **(parameters or {})},
            {**ATTRIBUTE_RULES, **(attributes or {})},
            {**ITERATIONVARS_RULES, **(iterationvars or {})},
        )

    def only(self, allowed: Sequence[str]) -> "RuleSet":
        """The rules that feed one of the tags."""
        keep = set(allowed)
        return RuleSet(
            *[
                {tag: rules for tag, rules in category.items() if tag in keep}
                for category in (self.parameters, self.attributes, self.iterationvars)
            ]
        )

    def types(self) -> dict[str, str]:
        """Type of each tag; the category that writes last decides."""
        found = {}
        for rules in (self.parameters, self.attributes, self.iterationvars):
            found |= {tag: TYPES.get(r.type, r.type) for tag, rs in rules.items() for r in rs}
        return found


class _Kinds(list):
    """The distinct transforms in use, addressed by number."""

    def number(self, transform: Callable[[Column], Column]) -> int:
        if transform not in self:
            self.append(transform)
        return self.index(transform)


def _quoted(text: str) -> str:
    """SQL literal of a text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _candidate(key: str, text: str, kind: int, stage: Stage, row: str, rule: int) -> str:
    precedence = f"named_struct('stage', {int(stage)}, 'row', {row}, 'rule', {rule})"
    return f"named_struct('key', {key}, 'text', {text}, 'kind', {kind}, 'precedence', {precedence})"


def _raw(name: str, value: str, stage: Stage, kinds: _Kinds) -> list[str]:
    return [_candidate(name, value, kinds.number(as_is), stage, ROW, 0)]


def _hits(
    rules: Rules, searched: str, value: str | None, stage: Stage, row: str, kinds: _Kinds
) -> list[str]:
    """One SQL expression per rule; without a value column it takes the text that matched."""
    found = []
    for tag, rule in [(tag, rule) for tag, rules_of_tag in rules.items() for rule in rules_of_tag]:
        pattern = _quoted(Pattern(rule.pattern).java)
        text = value or f"regexp_extract({searched}, {pattern}, 0)"
        kind = kinds.number(rule.transform)
        hit = _candidate(_quoted(tag), text, kind, stage, row, len(found))
        found.append(f"CASE WHEN {searched} RLIKE {pattern} THEN {hit} END")
    return found


def _explode(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """The candidates that hit, one per row."""
    hits = f"inline(array_compact(array({', '.join(candidates)})))"
    return df.select(SOURCE, F.expr(hits))


def _evaluate(candidates: DataFrame, kinds: _Kinds) -> DataFrame:
    """Turn the text of each hit into its value."""
    value = F.lit(None).cast("string")
    for number, transform in enumerate(kinds):
        value = F.when(F.col("kind") == number, transform(F.col("text")).cast("string")).otherwise(value)
    return candidates.select(SOURCE, "key", value.alias("value"), "precedence")


def _first_iterationvars(run_attrs: DataFrame) -> DataFrame:
    return (
        run_attrs.where(F.col("attrName") == "iterationvars")
        .groupBy(SOURCE)
        .agg(F.array_min(F.collect_list(F.struct(ROW, "attrValue")))["attrValue"].alias("variables"))
    )


def raw_tags(df: DataFrame, key: str, value: str, stage: Stage) -> DataFrame:
    """Every key and value as it is."""
    kinds = _Kinds()
    return _evaluate(_explode(df, _raw(key, value, stage, kinds)), kinds)


def parameter_tags(run_params: DataFrame, rules: Rules = PARAMETER_RULES) -> DataFrame:
    """Tags by rule on the parameter name."""
    kinds = _Kinds()
    hits = _hits(rules, "key", "value", Stage.PARAMETER, ROW, kinds)
    return _evaluate(_explode(run_params, hits), kinds)


def attribute_tags(run_attrs: DataFrame, rules: Rules = ATTRIBUTE_RULES) -> DataFrame:
    """Tags by rule on the attribute name."""
    kinds = _Kinds()
    hits = _hits(rules, "attrName", "attrValue", Stage.ATTRIBUTE, ROW, kinds)
    return _evaluate(_explode(run_attrs, hits), kinds)


def iterationvars_tags(run_attrs: DataFrame, rules: Rules = ITERATIONVARS_RULES) -> DataFrame:
    """Tags parsed from the matched text of each file's first ``iterationvars`` attribute."""
    kinds = _Kinds()
    hits = _hits(rules, "variables", None, Stage.ITERATIONVARS, "0L", kinds)
    return _evaluate(_explode(_first_iterationvars(run_attrs), hits), kinds)


def all_tags(run_params: DataFrame, run_attrs: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """Every tag of every file, with its precedence."""
    rules = rules or RuleSet.build()
    kinds = _Kinds()
    params = _raw("key", "value", Stage.RAW_PARAMETER, kinds)
    params += _hits(rules.parameters, "key", "value", Stage.PARAMETER, ROW, kinds)
    attrs = _raw("attrName", "attrValue", Stage.RAW_ATTRIBUTE, kinds)
    attrs += _hits(rules.attributes, "attrName", "attrValue", Stage.ATTRIBUTE, ROW, kinds)
    candidates = _explode(run_params, params).unionByName(_explode(run_attrs, attrs))
    variables = _hits(rules.iterationvars, "variables", None, Stage.ITERATIONVARS, "0L", kinds)
    if variables:
        first = _first_iterationvars(run_attrs)
        candidates = candidates.unionByName(_explode(first, variables))
    return _evaluate(candidates, kinds)


def last_writer(tags: DataFrame) -> DataFrame:
    return tags.groupBy(SOURCE, "key").agg(F.max_by("value", "precedence").alias("value"))


def allowed_tags(
    base: Sequence[str] | None = None, additional: Sequence[str] = (), minimal: bool = True
) -> list[str]:
    base = base or (MINIMAL_TAGS if minimal else FULL_TAGS)
    return list(dict.fromkeys([*base, *additional]))


def wide_tags(
    tags: DataFrame, allowed: Sequence[str], types: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per file and one typed column per allowed tag; NULL where a file lacks it.

    A file's candidates are gathered as a list, from which the last writer of each tag is taken.
    """
    types = RuleSet.build().types() if types is None else types
    names = list(allowed)
    listed = F.collect_list(F.struct("key", "precedence", "value"))
    found = tags.where(F.col("key").isin(names)).groupBy(SOURCE).agg(listed.alias("_found"))

    def last(name: str) -> Column:
        return F.array_max(F.filter("_found", lambda t: t["key"] == name))["value"].alias(name)

    wide = found.select(SOURCE, *[last(n) for n in names])
    parsed = {
        "double": to_double, "bigint": to_long, "boolean": lambda v: v.try_cast("boolean")
    }
    typed = {n: parsed[types[n]](F.col(f"`{n}`")) for n in names if types.get(n) in parsed}
    return wide.withColumns(typed)


def tag_rows(facts: DataFrame, wide: DataFrame) -> DataFrame:
    """Attach each file's tags to its rows; a tag overwrites a data column of its name.

    The column keeps its type; a tag that is no value of it makes it NULL.
    """
    clashing = [c for c in wide.columns if c in facts.columns and c != SOURCE]
    renamed = wide.withColumnsRenamed({c: f"_tag_{c}" for c in clashing})
    joined = facts.join(renamed, SOURCE, "left")
    columns = [
        F.when(F.col(f"_tag_{c}").isNull(), F.col(c))
        .otherwise(F.col(f"_tag_{c}").try_cast(facts.schema[c].dataType))
        .alias(c)
        if c in clashing
        else F.col(c)
        for c in facts.columns
    ]
    added = [F.col(f"`{c}`") for c in wide.columns if c not in facts.columns]
    return joined.select(*columns, *added)
