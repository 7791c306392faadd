"""Removal of word sequences that occurred before, by seeds that are extended.

Of all runs of ``gram`` words inside a window of ``length`` words, the one with the
smallest hash is the window's anchor (winnowing), so equal windows have equal anchors
in the same place. Documents are joined on anchors; an anchor's windows are the seed
extended to both sides as far as the anchor holds.

* Occurrences whose whole extension is equal need only their first one: all later ones
  are repeats from end to end. Within a block of texts this is decided before anything moves.
* Where an anchor occurs in several extensions, the extensions are compared window by
  window, each with the first occurrence of that window. Neighbouring matches along one
  diagonal join into maximal repeats.

No group is ever compared pair by pair: each member meets its group's first one only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siglake.session import Steps

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_ODD = np.uint64(0x9E3779B97F4A7C15)
# Bytes of text whose words a task holds at a time.
BLOCK_BYTES = 8 << 20
SPANS = "array<struct<start: int, end: int>>"


@dataclass(frozen=True)
class Settings:
    """length: words of the shortest repeat. gram: words of an anchor; the fewer, the fewer
    anchors there are, and the more of them agree by chance."""

    length: int = 20
    gram: int = 6


def _followed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of sequences from those of their two parts."""
    x = a * _ODD + b
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words, put together from runs of binary lengths."""
    n = len(words) - size + 1
    power, width, out, done = words, 1, None, 0
    while True:
        if size & width:
            out = power[:n] if out is None else _followed(out, power[done : done + n])
            done += width
        if 2 * width > size:
            return out
        power = _followed(power[:-width], power[width:])
        width *= 2


def _smallest(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the first smallest value in each run of ``size`` values."""
    n = len(values) - size + 1
    best, place = values[:n].copy(), np.arange(n)
    for j in range(1, size):
        less = values[j : n + j] < best
        best[less] = values[j : n + j][less]
        place[less] = np.flatnonzero(less) + j
    return place


class Words:
    """The words of several texts: one after the other, with the text and place of each."""

    def __init__(self, texts: list[bytes]):
        found = [t.split() for t in texts]
        self.lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.words = [w for words in found for w in words]
        self.text = np.repeat(np.arange(len(found)), self.lengths)
        self.hashes = word_hashes(self.words)

    def windows(self, length: int) -> np.ndarray:
        """Where a window of ``length`` words inside one text starts."""
        if len(self.words) < length:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.text[: len(self.text) - length + 1] == self.text[length - 1 :])


def extensions(found: Words, settings: Settings) -> tuple[np.ndarray, ...]:
    """The anchors of the texts: text, hash, hash of the extension, start and end of its words.

    The extension of an anchor is all windows that have it as their anchor; together
    they are one run of words, told by its first and last window and the anchor's place.
    """
    starts = found.windows(settings.length)
    if not len(starts):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    first, _ = found.hashes
    windows, grams = run_hashes(first, settings.length), run_hashes(first, settings.gram)
    anchor = _smallest(grams, settings.length - settings.gram + 1)[starts]
    text = found.text[starts]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    first_of = np.flatnonzero(new)
    low, high = starts[first_of], starts[np.concatenate([first_of[1:], [len(starts)]]) - 1]
    anchor, text = anchor[first_of], text[first_of]
    place = ((anchor - low) * settings.length + (high - low)).astype(np.uint64)
    whole = _followed(_followed(windows[low], windows[high]), place)
    begin = found.begins[text]
    return text, grams[anchor].view(np.int64), whole.view(np.int64), low - begin, high + settings.length - begin


def _lists(rows: np.ndarray, size: int, **fields: np.ndarray) -> pa.ListArray:
    """Lists of structs, one for each of ``size`` rows."""
    order = np.argsort(rows, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=size))])
    structs = pa.StructArray.from_arrays([pa.array(c[order]) for c in fields.values()], list(fields))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches in blocks of a few texts, with the texts of ``_text``; a missing one is empty."""
    for batch in batches:
        texts = batch.column("_text").fill_null(b"")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // BLOCK_BYTES
        edges = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a), texts.slice(a, b - a).to_pylist()


def _int32(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int32)


def marked(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per text (_at, _key): ``anchors`` to compare with other blocks, and ``spans`` found to be repeats.

    Of equal extensions in a block of texts only the first goes on; the later ones are
    repeats already. Rows that share an id and a place are one occurrence.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in _blocks(batches):
            row, anchor, whole, low, high = extensions(Words(texts), settings)
            at = block.column("_at").to_numpy()[row]
            order = np.lexsort((low, at, whole, anchor))
            row, at, anchor, whole, low, high = (c[order] for c in (row, at, anchor, whole, low, high))
            new = np.ones(len(row), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            later = (at != at[head]) | (low != low[head])
            start, end, size = _int32(low), _int32(high), len(texts)
            go_on = {"a": anchor, "whole": whole, "start": start, "end": end}
            anchors = _lists(row[~later], size, **{k: v[~later] for k, v in go_on.items()})
            spans = _lists(row[later], size, start=start[later], end=end[later])
            yield pa.record_batch(
                [block.column("_at"), block.column("_key"), anchors, spans], ["_at", "_key", "anchors", "spans"]
            )

    kinds = f"_at long, _key long, anchors array<struct<a: long, whole: long, start: int, end: int>>, spans {SPANS}"
    return docs.select("_at", "_key", "_text").mapInArrow(mark, kinds)


def _ranges(lists: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of each row's list of spans."""
    lists = lists.fill_null([]) if lists.null_count else lists
    offsets, spans = lists.offsets.to_numpy(), lists.values
    starts, ends = (spans.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    return [(starts[a:b], ends[a:b]) for a, b in zip(offsets, offsets[1:])]


def window_hashes(docs: DataFrame, settings: Settings) -> DataFrame:
    """The windows of the extensions ``runs`` of each text: two hashes and the first word."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in _blocks(batches):
            found = Words(texts)
            windows = [
                np.unique(np.concatenate([np.arange(a, b - settings.length + 1) for a, b in zip(*run)]))
                for run in _ranges(block.column("runs"))
            ]
            row = np.repeat(np.arange(len(texts)), [len(w) for w in windows])
            start = np.concatenate(windows)
            place = found.begins[row] + start
            hashes = [run_hashes(h, settings.length)[place].view(np.int64) for h in found.hashes]
            owner = [block.column(c).to_numpy()[row] for c in ("_at", "_key")]
            columns = map(pa.array, [*hashes, *owner, _int32(start)])
            yield pa.record_batch(list(columns), ["h1", "h2", "_at", "_key", "start"])

    kinds = "h1 long, h2 long, _at long, _key long, start int"
    return docs.select("_at", "_key", "_text", "runs").mapInArrow(cut, kinds)


def maximal(matches: DataFrame, settings: Settings) -> DataFrame:
    """Maximal repeats (_at, _key, start, end, to, to_start) from matching windows.

    Matches of neighbouring windows of two texts with the same distance are one repeat.
    """
    shift = matches.withColumn("shift", F.col("start") - F.col("to_start")).repartition("_at", "_key")
    line = Window.partitionBy("_at", "_key", "to", "shift").orderBy("start")
    chained = shift.withColumn("chain", F.col("start") - F.row_number().over(line))
    return (
        chained.groupBy("_at", "_key", "to", "shift", "chain")
        .agg(F.min("start").alias("start"), (F.max("start") + settings.length).alias("end"))
        .select("_at", "_key", "start", "end", "to", (F.col("start") - F.col("shift")).alias("to_start"))
    )


def repeats(docs: DataFrame, steps: Steps, settings: Settings) -> DataFrame:
    """(_at, _key, spans): the repeated words of each text (_at, _key, _text), as written rows."""
    marks = steps.write(marked(docs, settings), "marks")
    anchors = marks.select("_at", "_key", F.explode("anchors").alias("e")).select("_at", "_key", "e.*")
    # Most anchors occur once. What moves to find them is their hashes only.
    seeds = anchors.groupBy("a").agg((F.min("whole") != F.max("whole")).alias("several"), F.count("*").alias("n"))
    shared = steps.write(anchors.join(seeds.where("n > 1").drop("n"), "a"), "seeds")
    place = F.struct("_at", "start")
    firsts = shared.groupBy("a", "whole").agg(F.min(place).alias("first"))
    judged = shared.join(firsts, ["a", "whole"]).withColumn("later", place > F.col("first"))
    judged = steps.write(judged.where("later or several").select("_at", "_key", "start", "end", "later"), "judged")
    # Extensions that differ from others of their anchor are compared window by window.
    span = F.struct("start", "end")
    runs = judged.where("not later").groupBy("_at", "_key").agg(F.collect_list(span).alias("runs"))
    windows = steps.write(window_hashes(docs.join(runs, ["_at", "_key"]), settings), "windows")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    matches = windows.join(first.drop("n"), ["h1", "h2"]).where(place > F.col("first"))
    found = maximal(
        matches.select("_at", "_key", "start", F.col("first._at").alias("to"), F.col("first.start").alias("to_start")), settings
    )
    one = F.array(span.cast("struct<start: int, end: int>")).alias("spans")
    pieces = (
        marks.select("_at", "_key", "spans")
        .unionByName(judged.where("later").select("_at", "_key", one))
        .unionByName(found.select("_at", "_key", one))
    )
    spans = pieces.where(F.size("spans") > 0).groupBy("_at", "_key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    out = steps.write(spans, "spans")
    steps.remove("marks", "seeds", "judged", "windows")
    return out


def without_repeats(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: the id column, ``n_words``, ``n_removed``, ``removed`` (spans of
    words, merged) and ``text``: the kept words joined by one blank.

    A word is removed if it lies in a window of ``length`` words that also starts
    earlier: in a document with a smaller id, or before in the same one. Ids are whole
    numbers; a missing id comes before all others. Rows that share an id are copies of one document:
    the same place in them is one occurrence. A missing text, or one without words, has
    an empty text. Other columns are not read. Memory holds one
    batch of texts and the words of one block, or of one longer text.
    """
    at = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    text = F.col(text_col).cast("binary")
    rows = docs.select(F.col(id_col).alias("_id"), at.alias("_at"), F.xxhash64(text).alias("_key"), text.alias("_text"))
    steps = Steps(docs.sparkSession, "substrings")
    spans = repeats(rows.drop("_id"), steps, settings)

    id_type = docs.schema[id_col].dataType
    kinds = T.StructType([T.StructField("_id", id_type), *T.StructType.fromDDL(f"n_words long, n_removed long, removed {SPANS}, text binary")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in _blocks(batches):
            counts, starts, ends, rows, kept = [], [], [], [], []
            for row, (text, spans) in enumerate(zip(texts, _ranges(block.column("spans")))):
                words = text.split()
                gone = merged(*spans)
                left, at = [], 0
                for start, end in gone:
                    left += words[at:start]
                    at = end
                left += words[at:]
                counts.append((len(words), len(words) - len(left)))
                kept.append(b" ".join(left))
                rows += [row] * len(gone)
                starts += [a for a, _ in gone]
                ends += [b for _, b in gone]
            whole = lambda values: np.array(values, np.int32)
            removed = _lists(np.array(rows, np.int64), len(texts), start=whole(starts), end=whole(ends))
            n_words, n_removed = (pa.array(c, pa.int64()) for c in zip(*counts))
            ids = block.column("_id").cast(to_arrow_type(id_type))
            yield pa.record_batch([ids, n_words, n_removed, removed, pa.array(kept, pa.binary())], kinds.names)

    found = rows.join(spans, ["_at", "_key"], "left").select("_id", "_text", "spans").mapInArrow(cut, kinds)
    return found.select(F.col("_id").alias(id_col), "n_words", "n_removed", "removed", F.col("text").cast("string").alias("text"))


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The spans in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(starts.tolist(), ends.tolist())):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
