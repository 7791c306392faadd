"""Quality rules with thresholds learnt from the corpus itself.

Each document gets a few rates. Per language and source, quantile sketches of the
rates give an upper fence (and a lower one for the word length); documents beyond a
fence go, and so do those that fail the base rules. Sketches merge, so a source with
few documents takes the fences of its language, and a small language those of all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import SPACES, filled, let, ratio, unused, with_once, words
from siglake.session import written

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rules:
    """min_words, max_repeat_percent: the base rules. whiskers: a fence is the upper
    quartile plus so many quartile distances plus the rate's slack. min_group: with
    fewer documents, the fences of the language or of all are used. k: size of the
    sketches, which are exact up to so many documents."""

    min_words: int = 50
    max_repeat_percent: int = 50
    whiskers: float = 3.0
    min_group: int = 20
    k: int = 4096
    slack: tuple[tuple[str, float], ...] = (
        ("symbol_rate", 0.05),
        ("capital_rate", 0.15),
        ("dup_line_rate", 0.5),
        ("repeat_rate", 0.4),
        ("word_length", 1.0),
    )

    @property
    def rates(self) -> list[str]:
        return [name for name, _ in self.slack]


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the text.

    Windows are compared by a 64-bit hash of their words.
    """
    windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(tokens) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)).alias("h"), i.alias("i")
            ),
        )
    )
    return F.when(F.size(tokens) < 3, F.lit(0).cast("long")).otherwise(let(windows, _covered))


def _covered(windows: Column) -> Column:
    """Words under the windows whose hash a neighbour in the sorted list shares."""
    same = lambda x, i: F.coalesce(F.get(windows, i)["h"] == x["h"], F.lit(False))
    found = F.filter(windows, lambda x, i: same(x, i - 1) | same(x, i + 1))
    total = F.aggregate(
        F.sort_array(F.transform(found, lambda x: x["i"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
    )
    return total["n"]


def _counts(text: Column, rules: Rules) -> Column:
    """Struct of counts and rates of a text."""
    long = lambda x: x.cast("long")
    without = lambda symbols: F.length(text) - F.length(F.translate(text, symbols, ""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    counts = let(
        words(text),
        lambda w: F.struct(
            long(F.size(w)).alias("n_words"),
            long(F.length(F.translate(text, SPACES, ""))).alias("word_chars"),
            long(without(SYMBOLS)).alias("n_symbols"),
            long(without(CAPITALS)).alias("n_capitals"),
            let(lines, lambda x: F.struct(long(F.size(x)).alias("n"), long(F.size(F.array_distinct(x))).alias("d"))).alias(
                "lines"
            ),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    return let(
        counts,
        lambda n: F.struct(
            n["n_words"].alias("n_words"),
            n["word_chars"].alias("word_chars"),
            n["n_symbols"].alias("n_symbols"),
            (n["lines"]["n"] - n["lines"]["d"]).alias("n_dup_lines"),
            n["n_repeat_words"].alias("n_repeat_words"),
            ratio(n["n_symbols"], n["word_chars"]).alias("symbol_rate"),
            ratio(n["n_capitals"], n["word_chars"]).alias("capital_rate"),
            ratio(n["lines"]["n"] - n["lines"]["d"], n["lines"]["n"]).alias("dup_line_rate"),
            ratio(n["n_repeat_words"], n["n_words"]).alias("repeat_rate"),
            ratio(n["word_chars"], n["n_words"]).alias("word_length"),
            (
                (n["n_words"] < rules.min_words)
                | (100 * n["n_repeat_words"] > rules.max_repeat_percent * n["n_words"])
            ).alias("base_failed"),
        ),
    )


def fences(measured: DataFrame, rules: Rules) -> DataFrame:
    """One row per language and source: ``lang``, ``source``, and ``low``/``high`` structs.

    ``measured`` has ``lang``, ``source`` and the struct ``m``. Documents that fail
    the base rules shape no fence. What is gathered is one sketch per group and task.
    """
    passing = measured.where(~F.col("m.base_failed"))
    groups = passing.groupBy("lang", "source").agg(
        *[F.kll_sketch_agg_double(F.col("m")[r], rules.k).alias(r) for r in rules.rates]
    )
    groups = written(groups)
    merged = [F.kll_merge_agg_double(r, rules.k).alias(r) for r in rules.rates]
    by_lang = groups.groupBy(F.col("lang").alias("_lang")).agg(*merged)
    overall = _bounds(groups.groupBy().agg(*merged), rules).first()
    if not overall["n"]:
        return _bounds(groups, rules).select("lang", "source", "low", "high")
    total = {side: F.struct(*[F.lit(float(overall[side][r])).alias(r) for r in rules.rates]) for side in ("low", "high")}
    own, lang = _bounds(groups, rules), _bounds(by_lang, rules, "_l")
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("_lang")))
    pick = lambda side: (
        F.when(F.col("n") >= rules.min_group, F.col(side))
        .when(F.col("n_l") >= rules.min_group, F.col(f"{side}_l"))
        .otherwise(total[side])
    )
    return joined.select("lang", "source", pick("low").alias("low"), pick("high").alias("high"))


def _bounds(sketches: DataFrame, rules: Rules, suffix: str = "") -> DataFrame:
    n = F.kll_sketch_get_n_double(rules.rates[0])
    at = lambda r, q: F.when(n > 0, F.kll_sketch_get_quantile_double(F.col(r), F.lit(q)))
    high, low = [], []
    for rate, slack in rules.slack:
        spread = rules.whiskers * (at(rate, 0.75) - at(rate, 0.25)) + slack
        high.append((at(rate, 0.75) + spread).alias(rate))
        # Only short words speak against a text; low rates of symbols or repeats do not.
        low.append((at(rate, 0.25) - spread if rate == "word_length" else F.lit(float("-inf"))).alias(rate))
    kept = [c for c in sketches.columns if c not in rules.rates]
    return sketches.select(
        *kept,
        n.alias(f"n{suffix}"),
        F.struct(*low).alias(f"low{suffix}"),
        F.struct(*high).alias(f"high{suffix}"),
    )


def judge(
    docs: DataFrame,
    rules: Rules = Rules(),
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    verdict: str = "quality",
    columns: list[str] | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` and a struct column ``verdict``.

    ``columns``: hand on only these columns of ``docs``. Without the text among them,
    the counts are written and each text is read once.

    It has n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, the rates,
    ``base_failed`` and ``kept``. A missing text counts as empty, which fails the base
    rules; missing languages or sources form a group of their own; ties share one
    fence and repeated rows one verdict; no rows give no rows. A column of the
    verdict's name is replaced, other columns stay. Texts are read twice and moved
    between tasks only if the fences are too many to be sent to every task.
    """
    rest = docs.drop(verdict)
    out = [c for c in rest.columns if columns is None or c in columns]
    m, lang, source, low, high = (unused(f"_{x}", rest) for x in ("m", "lang", "source", "low", "high"))
    measured = with_once(rest, m, let(filled(text_col), lambda text: _counts(text, rules)))
    if text_col not in out:
        measured = written(measured.select(*{c: None for c in (*out, lang_col, source_col, m)}))
    narrow = measured.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(m).alias("m"))
    found = written(fences(narrow, rules)).toDF(lang, source, low, high)
    joined = measured.join(
        found, F.col(lang_col).eqNullSafe(F.col(lang)) & F.col(source_col).eqNullSafe(F.col(source)), "left"
    )
    inside = ~F.col(m)["base_failed"]
    for rate in rules.rates:
        inside &= F.col(m)[rate].between(F.col(low)[rate], F.col(high)[rate])
    judged = F.col(m).withField("kept", F.coalesce(inside, F.lit(False)))
    return joined.select(*out, judged.alias(verdict))


def kept(docs: DataFrame, rules: Rules = Rules(), **columns: str) -> DataFrame:
    """The rows of ``docs`` that pass, with its columns."""
    verdict = unused("_quality", docs)
    return judge(docs, rules, verdict=verdict, **columns).where(F.col(verdict)["kept"]).drop(verdict)
