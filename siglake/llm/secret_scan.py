"""Secret scans over a ledger of content-addressed texts.

A text's address is its SHA-256. The ledger has one row per address with the rules it
was scanned by and the spans found. Each distinct text is scanned once, and only by
rules (name and version) that the ledger does not have for it; findings are joined
back to every row that holds the text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import filled, folded, let, unused, with_once
from siglake.session import written

SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    ``hints``: one of these has to occur, in either case, for a match to be possible.
    ``base`` marks the rules that ``base_sha256`` covers. A changed rule needs a new version.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    version: int = 1
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# A key with its body: up to the END line, also in a quoted or commented string, or, if
# there is none, to the end of the base64 lines. Long bodies are matched by character
# classes, never by a repeated group, which would be recursive.
_GAP, _BASE64 = r"[\t\n\r ]*", r"A-Za-z0-9+/=\\"
_HEADERS = rf"(?:{_GAP}[A-Za-z-]+:[^\n]*\n){{0,8}}"
_TO_END = rf"""{_HEADERS}[{_BASE64}\t\n\r "',>#*|]*-----END [A-Z ]*PRIVATE KEY-----"""
_TO_LAST_LINE = (
    rf"{_HEADERS}(?:{_GAP}[{_BASE64}\r\n]*[{_BASE64}]{{16,}}){{1,60}}(?:{_GAP}[{_BASE64}]{{1,15}}(?:\r?\n|\z))?"
)
PRIVATE_KEY = rf"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:{_TO_END}|{_TO_LAST_LINE})?"

RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, ("akia",), base=True),
    # A run is found whole, so shorter runs can be left out by the pattern.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("private_key", PRIVATE_KEY, 0, 1, ("private key-----",), version=2),
)


def spans(text: Column, rules: tuple[Rule, ...] = RULES, skip: Column | None = None) -> Column:
    """Spans of all rules in a text by start and rule; ``end`` is exclusive, in code points.

    ``skip``: keys of rules that are left out for this row.
    """

    def of_rule(rank: int, rule: Rule, lower: Column) -> Column:
        none = F.array().cast(SPAN)
        wanted = reduce(lambda a, b: a | b, [F.contains(lower, F.lit(h)) for h in rule.hints]) if rule.hints else F.lit(True)
        if skip is not None:
            wanted &= ~F.array_contains(skip, rule.key)
        found = let(
            F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
            lambda whole: F.when(F.size(whole) == 0, none).otherwise(
                let(
                    F.struct(
                        F.split(text, rule.pattern, -1).alias("gaps"),
                        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("values"),
                    ),
                    lambda parts: _placed(whole, parts["gaps"], parts["values"], rank, rule),
                )
            ),
        )
        return F.when(wanted, found).otherwise(none)

    return let(
        folded(text),
        lambda lower: F.sort_array(F.concat(*[of_rule(rank, rule, lower) for rank, rule in enumerate(rules)])),
    )


def _placed(whole: Column, gaps: Column, values: Column, rank: int, rule: Rule) -> Column:
    """Matches and the texts between them, turned into positions."""

    def step(state: Column, i: Column) -> Column:
        start = state["at"] + F.length(F.get(gaps, i))
        end = start + F.length(F.get(whole, i))
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end")
        )
        good = F.length(F.get(values, i)) >= rule.least
        return F.struct(
            end.alias("at"), F.when(good, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(whole) - 1), start, step)["out"]


def address(text: str | Column) -> Column:
    return F.sha2(filled(text), 256)


def scan(
    docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text"
) -> DataFrame:
    """The ledger after scanning ``docs``: ``blob``, ``rules`` (keys), ``spans``.

    Rows of the given ledger stay. A missing text is the empty one; repeated texts are
    met within each task before the distinct ones are moved to their address's task, so
    a text that fills a third of all rows is moved once per task. Other columns are not read.
    """
    keys = F.array(*[F.lit(rule.key) for rule in rules])
    texts = docs.select(address(text_col).alias("blob"), filled(text_col).alias("text"))
    blobs = texts.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        done = with_once(blobs, "spans", spans(F.col("text"), rules))
        return done.select("blob", keys.alias("rules"), "spans")
    seen = ledger.select(F.col("blob"), F.col("rules").alias("_rules"), F.col("spans").alias("_spans"))
    both = blobs.join(seen, "blob", "full_outer").withColumn("_rules", F.coalesce("_rules", F.array().cast("array<string>")))
    fresh = F.when(F.col("text").isNull(), F.array().cast(SPAN)).otherwise(spans(F.col("text"), rules, F.col("_rules")))
    done = with_once(both, "_fresh", fresh)
    scanned = F.when(F.col("text").isNull(), F.col("_rules")).otherwise(F.array_union("_rules", keys))
    merged = F.array_distinct(F.sort_array(F.concat(F.coalesce("_spans", F.array().cast(SPAN)), "_fresh")))
    return done.select("blob", scanned.alias("rules"), merged.alias("spans"))


def findings(docs: DataFrame, ledger: DataFrame, text_col: str = "text", name: str = "spans") -> DataFrame:
    """All rows and columns of ``docs`` with the spans of their text; a column ``name`` is replaced.

    Joins on the address; a frequent text's rows are split over tasks when the join runs.
    """
    rest = docs.drop(name)
    key, blob, found = (unused(f"_{x}", rest) for x in ("key", "blob", "found"))
    hits = ledger.where(F.size("spans") > 0).select(F.col("blob").alias(blob), F.col("spans").alias(found))
    joined = with_once(rest, key, address(text_col)).join(hits, F.col(key) == F.col(blob), "left")
    return joined.select(*rest.columns, F.coalesce(found, F.array().cast(SPAN)).alias(name))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(kinds))


def redacted(docs: DataFrame, ledger: DataFrame | None = None, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; ``n_chars``, if there, follows.

    Overlapping spans become one mark. Texts without a secret, missing ones too, stay as they are.
    """
    name = unused("_spans", docs)
    hits = written(scan(docs, ledger, text_col=text_col).where(F.size("spans") > 0))
    text = F.col(text_col)

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        overlaps = (F.size(state["out"]) > 0) & (s["start"] < state["at"])
        out = F.when(overlaps, state["out"]).otherwise(F.concat(state["out"], F.array(gap, F.lit(mark))))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = let(
        F.aggregate(F.col(name), start, step),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))),
    )
    found = findings(docs, hits, text_col, name)
    fresh = unused("_clean", found)
    found = with_once(found, fresh, F.when(F.size(name) == 0, text).otherwise(clean))
    columns = [
        F.col(fresh).alias(c) if c == text_col
        else F.when(F.size(name) == 0, F.col(c)).otherwise(F.length(fresh)).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars"
        else F.col(c)
        for c in docs.columns
    ]
    return found.select(*columns)
