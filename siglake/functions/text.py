"""String expressions: LIKE, regular expressions with named groups, natural order."""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER = string.ascii_uppercase
_LOWER = string.ascii_lowercase
_ESCAPE = "\x01"

# One token of a regular expression: escaped pair, class, group opener, or character.
_TOKEN = re.compile(
    r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|\(\?P<(?P<define>\w+)>|\(\?P=(?P<refer>\w+)\)|.", re.S
)


def ascii_like(column: Column, pattern: str) -> Column:
    """LIKE that ignores the case of ASCII letters only and has no escape character."""
    folded = pattern.translate(str.maketrans(_UPPER, _LOWER))
    return F.like(F.translate(column, _UPPER, _LOWER), F.lit(folded), F.lit(_ESCAPE))


@dataclass(frozen=True)
class Pattern:
    """A Python-flavoured regular expression, usable in Spark expressions."""

    source: str

    @property
    def groups(self) -> dict[str, int]:
        return dict(re.compile(self.source).groupindex)

    @property
    def java(self) -> str:
        """The same expression without named groups; ``.`` and classes as in Python."""

        def rewrite(match: re.Match) -> str:
            token = match.group()
            if match["define"]:
                return "("
            if match["refer"]:
                return f"(?:\\{self.groups[match['refer']]})"
            if token == r"\Z":
                return r"\z"
            if token[0] == "[" and len(token) > 1:
                return "[" + token[1:].replace("[", r"\[").replace("&&", r"&\&")
            return token

        return "(?dU)" + _TOKEN.sub(rewrite, self.source)

    def found(self, column: Column) -> Column:
        return column.rlike(self.java)

    def group(self, column: Column, group: str | int = 0) -> Column:
        """Text of a group; the empty string where it took no part, NULL without a match."""
        index = group if isinstance(group, int) else self.groups[group]
        return F.when(self.found(column), F.regexp_extract(column, self.java, index))

    def can_be_empty(self, name: str) -> bool:
        """Whether the named group could match the empty string."""
        start = self.source.index(f"(?P<{name}>")
        depth = 0
        for token in _TOKEN.finditer(self.source, start):
            text = token.group()
            depth += text.startswith("(") and not text.startswith("(?P=")
            depth -= text == ")"
            if depth == 0:
                body = self.source[start + len(f"(?P<{name}>") : token.start()]
                return re.fullmatch(body, "") is not None
        return False

    def format(self, column: Column, template: str) -> Column:
        """Fill a ``"name_{group}"`` template; a group that took no part reads ``None``."""
        pieces = []
        for literal, name, spec, conversion in string.Formatter().parse(template):
            if spec or conversion:
                raise ValueError(f"only plain {{name}} fields are supported: {template!r}")
            if literal:
                pieces.append(F.lit(literal))
            if name is not None:
                text = F.regexp_extract(column, self.java, self.groups[name])
                if not self.can_be_empty(name):
                    text = F.when(text == "", F.lit("None")).otherwise(text)
                pieces.append(text)
        return F.concat(*pieces) if pieces else F.lit("")

    def columns(self, column: Column) -> dict[str, Column]:
        """One expression per named group; NULL where there is no text."""
        return {name: F.nullif(self.group(column, name), F.lit("")) for name in self.groups}


def strip(column: Column, characters: str) -> Column:
    return F.btrim(column, F.lit(characters))


def remove(column: Column, characters: str) -> Column:
    return F.translate(column, characters, "")


def field(column: Column, separator: str, index: int) -> Column:
    """Field ``index`` (from 0; negative from the end) of a separated text, else NULL."""
    parts = F.split(column, re.escape(separator))
    return F.try_element_at(parts, F.lit(index + 1 if index >= 0 else index))


def natural_key(column: Column) -> Column:
    """Sort key of natural order: numbers by value, then texts run by run.

    Letters are compared as they are and digit runs by value; a text holding
    anything else than letters, digits and ``- _ : space`` is compared as a whole.
    """
    whole_number = column.rlike("^[0-9]+$")
    number = F.when(
        whole_number | column.rlike(r"^(?:[0-9]+\.[0-9]*|\.[0-9]+)$"), column.try_cast("double")
    )
    digits = F.regexp_extract_all(column, F.lit(r"\p{L}+|[0-9]+"), F.lit(0))

    def padded(run: Column) -> Column:
        stripped = F.regexp_replace(run, "^0+(?=.)", "")
        size = F.lpad(F.length(stripped).cast("string"), 9, "0")
        return F.when(run.rlike("^[0-9]"), F.concat(size, stripped)).otherwise(run)

    mixed = column.rlike(r"^[\p{L}0-9\-_: ]*[\p{L}0-9][\p{L}0-9\-_: ]*$")
    runs = F.when(mixed, F.transform(digits, padded)).otherwise(F.array(column))
    return F.struct(
        F.when(number.isNull(), 1).otherwise(0).alias("kind"),
        number.alias("number"),
        F.when(number.isNull(), runs).alias("runs"),
    )
