"""What the operators share: input tables and null-free texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Code points that end a word: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(text: str | Column) -> Column:
    """The text, or an empty one for a missing text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order; none for a missing text."""
    spaced = F.trim(F.translate(text, SPACES[1:], " " * 5))
    return F.when(F.coalesce(spaced, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " +"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that later filters and expressions read and never compute anew."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def unused(name: str, *frames: DataFrame) -> str:
    """The name, made longer until no frame has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def folded(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ratio(part: Column, whole: Column) -> Column:
    """A quotient that is 0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
