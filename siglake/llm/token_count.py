"""Token counts without tokens: Viterbi that carries a score and a count.

An Aho-Corasick automaton finds all pieces that end at a character; the best of them
extends the best path to its start. Of equal scores the piece that starts first wins,
as in the tokenizer, which looks at starts in order and replaces only by more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.llm.pieces import BLANK, PARTS, Pieces, load

# Parts kept by a task, about 150 bytes each. A full table starts anew.
KEPT_PARTS = 1_000_000


class Counter(dict):
    """Number of tokens of a cut part, counted on first use."""

    def __init__(self, pieces: Pieces, kept: int = KEPT_PARTS):
        super().__init__()
        if any("\n" in piece for piece in pieces.scores):
            raise ValueError("a piece has a line feed, so texts cannot be cut at line feeds")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = pieces.unknown_score
        self.kept = kept
        self.parts = re.compile(PARTS).findall

    def __missing__(self, part: str) -> int:
        if len(self) >= self.kept:
            self.clear()
        found = self[part] = self.count(part.replace(" ", BLANK))
        return found

    def count(self, part: str) -> int:
        ends: list[list[tuple[int, float]]] = [[] for _ in part]
        for end, match in self.automaton.iter(part):
            ends[end].append(match)
        scores, counts = [0.0], [0]
        for end, matches in enumerate(ends, 1):
            best, count = None, 0
            for length, score in sorted(matches, reverse=True):
                total = scores[end - length] + score
                if best is None or total > best:
                    best, count = total, counts[end - length] + 1
            if not any(length == 1 for length, _ in matches):
                total = scores[end - 1] + self.unknown
                if best is None or total > best:
                    best, count = total, counts[end - 1] + len(part[end - 1].encode())
            scores.append(best)
            counts.append(count)
        return counts[-1]

    def of_text(self, text: str | None) -> int:
        return sum(map(self.__getitem__, self.parts(" " + text))) if text else 0


def count_tokens(docs: DataFrame, pieces: Pieces | None = None, text_col: str = "text", name: str = "n_tokens") -> DataFrame:
    """All rows and columns of ``docs`` and the number of tokens in column ``name``.

    A missing or empty text has none. A column ``name`` is replaced, others pass
    unread. Rows stay in their task; memory holds one text and a bounded table.
    """
    pieces = pieces or load()

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(pieces)
        for texts in batches:
            yield pd.Series([counter.of_text(t) for t in texts], dtype="int64")

    return docs.drop(name).withColumn(name, count(F.col(text_col)))
