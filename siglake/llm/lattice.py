"""SentencePiece encoding and decoding with joins.

The parts of a text (see ``pieces``) become lattices: the beginnings of substrings are joined
to the table of pieces, which makes the edges, and a fold over a part's characters finds the best path,
of which it carries a score and the last edge for each end. Memory and work grow linearly
with a part, however long it is: the substrings of a long part are taken from short
windows of it.

All joined tables are bounded and sent to every task, so that the rows of a text stay in
their task and in order, and nothing is shuffled but the counts of parts in some texts.
These say which parts are frequent: the paths of such parts are found beforehand. Other
parts are cut further where no piece holds both neighbours, into stretches with a best path of
their own, of which the frequent ones are known beforehand too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import filled, let
from siglake.llm.pieces import BLANK, PARTS, Pieces, load
from siglake.session import Steps

# Characters of a part whose substrings are taken from one window.
_WINDOW = 256
# Characters by which pieces of as many or more are found.
_PREFIX = 4
# Groups of characters by what may follow them in a piece.
_GROUPS = 8
# Longest parts that may be known beforehand, and that are folded many at a time.
_SHORT = 40
# Known parts, at most, and the texts whose parts are counted to choose them. They change the work, never a result.
KNOWN = 1 << 18
TOLD = 20_000
# Rows of a task that are folded at a time.
_ROWS = 200_000
# An edge in 61 bits: its end, 255 less its length, whether it is a character that is no piece, and its id or code point.
_END, _LENGTH, _CHAR = 30, 22, 21


def parts_of(text: Column) -> Column:
    """The parts of a text in order, with blanks in front."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(F.concat(F.lit(" "), text), F.lit(PARTS), F.lit(0))
    )


def stretches_of(part: Column, pieces: Pieces) -> Column:
    """A part, with its blanks as pieces have them, cut where no piece holds both neighbours."""
    chars = F.replace(part, F.lit(" "), F.lit(BLANK))
    cut = F.split(F.regexp_replace(chars, cuts(pieces), "\n"), "\n", -1)
    return F.when(F.length(part) > 1, cut).otherwise(F.array(chars))


def cuts(pieces: Pieces) -> str:
    """A pattern for places between two characters that follow each other in no piece.

    Characters are taken together by what may follow them, until there are ``_GROUPS`` groups;
    what may follow one of a group counts for all, so that some places are not found.
    """
    follow: dict[str, set[str]] = {}
    for piece in pieces.scores:
        for a, b in zip(piece, piece[1:]):
            follow.setdefault(a, set()).add(b)
    alike: dict[frozenset[str], str] = {}
    for a, after in follow.items():
        alike[frozenset(after)] = alike.get(frozenset(after), "") + a
    groups = [(chars, set(after)) for after, chars in alike.items()]
    while len(groups) > _GROUPS:
        lost = lambda x, y: len(x[0]) * len(y[1] - x[1]) + len(y[0]) * len(x[1] - y[1])
        least = min(groups, key=lambda g: len(g[0]) * len(g[1]))
        groups.remove(least)
        nearest = min(groups, key=lambda g: lost(g, least))
        groups.remove(nearest)
        groups.append((nearest[0] + least[0], nearest[1] | least[1]))
    listed = lambda chars: "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in _runs(sorted(map(ord, chars))))
    places = [f"(?<=[{listed(chars)}])(?=[^{listed(after)}])" for chars, after in groups]
    return "(?s)" + "|".join([*places, f"(?<=[^{listed(follow)}])(?=.)" if follow else "(?<=.)(?=.)"])


def _runs(codes: list[int]) -> list[tuple[int, int]]:
    """First and last of each run of codes that follow each other."""
    firsts = [b for a, b in zip([-2, *codes], codes) if b != a + 1]
    lasts = [a for a, b in zip(codes, [*codes[1:], -1]) if b != a + 1]
    return list(zip(firsts, lasts))


def _levelled(counts: DataFrame) -> tuple[DataFrame, int]:
    """``counts`` (part, n) with a ``level``, and the least level whose parts, with those above, are at most ``KNOWN``."""
    counts = counts.withColumn("level", F.floor(4 * F.log2("n")))
    levels = counts.where("n > 1").groupBy("level").agg(F.count("*").alias("m")).collect()
    least, held = 1, 0
    for level, m in sorted(levels, reverse=True):
        held += m
        if held > KNOWN:
            least = level + 1
            break
    return counts, least


def frequent_parts(rows: DataFrame, pieces: Pieces, steps: Steps) -> tuple[DataFrame, DataFrame]:
    """At most ``KNOWN`` parts that occur in the most of about ``TOLD`` of the rows (id, parts), chosen by hash.

    And as many stretches that are the most frequent in the other parts of these rows.
    """
    told = F.pmod(F.xxhash64("id", "parts"), F.lit(max(rows.count(), 1))) < TOLD
    part = rows.where(told).select(F.explode(F.array_distinct("parts")).alias("part")).where(F.length("part") <= _SHORT)
    counts, least = _levelled(steps.write(part.groupBy("part").agg(F.count("*").alias("n")), "counts"))
    others = counts.where(F.col("level") < least).select(F.explode(stretches_of(F.col("part"), pieces)).alias("part"), "n")
    stretches, most = _levelled(steps.write(others.groupBy("part").agg(F.sum("n").alias("n")), "stretches"))
    return counts.where(F.col("level") >= least).select("part"), stretches.where(F.col("level") >= most).select("part")


def edges_of(parts: DataFrame, pieces: Pieces) -> DataFrame:
    """``parts`` (part, ids, ...) with a row for each ``edge`` of those without ids, in order of start.

    A part with ids keeps its one row, without an edge. Of each start, the one to ``_PREFIX``
    characters that follow are joined to the pieces that begin with them: those of fewer than
    ``_PREFIX`` characters are such a beginning themselves, longer ones are compared with the text.
    The table of pieces is sent to every task; ``pieces.MAX_PIECES`` bounds it.
    """
    if pieces.longest > 255:
        raise ValueError("a piece is too long")
    spark = parts.sparkSession
    listed = [(piece[:_PREFIX], piece, len(piece), pieces.ids[piece]) for piece in pieces.scores]
    table = spark.createDataFrame(listed, "begin string, piece string, size int, piece_id int")
    none = F.col("part").isNull() | F.col("ids").isNotNull()
    kept = [c for c in parts.columns if c != "part"]
    # Every step is an expression that Spark compiles; functions on arrays' elements would be interpreted, for all rows.
    ats = F.sequence(F.lit(0), F.when(none, 0).otherwise(F.greatest(F.length("part") - 1, F.lit(0))), F.lit(_WINDOW))
    windows = parts.select(*kept, "part", F.explode(ats).alias("from"))
    chars = F.replace("part", F.lit(" "), F.lit(BLANK))
    window = F.substring(chars, F.col("from") + 1, F.lit(_WINDOW + pieces.longest - 1))
    windows = windows.select(*kept, "from", F.when(none, None).when(F.length("part") <= _SHORT, chars).otherwise(window).alias("chars"))
    places = F.sequence(F.lit(1), F.least(F.lit(_WINDOW), F.greatest(F.coalesce(F.length("chars"), F.lit(1)), F.lit(1))))
    starts = windows.select(*kept, "from", "chars", F.explode(places).alias("place"))
    tail = F.substring("chars", F.col("place"), F.lit(pieces.longest))
    starts = starts.select(*kept, (F.col("from") + F.col("place") - 1).alias("start"), tail.alias("tail"))
    room = F.sequence(F.lit(1), F.least(F.lit(_PREFIX), F.greatest(F.coalesce(F.length("tail"), F.lit(1)), F.lit(1))))
    subs = starts.select(*kept, "start", "tail", F.explode(room).alias("length"))
    subs = subs.withColumn("beginning", F.substring("tail", F.lit(1), F.col("length")))
    met = subs.join(F.broadcast(table), (F.col("beginning") == F.col("begin")) & F.startswith("tail", "piece"), "left")
    met = met.where(F.col("piece_id").isNotNull() | (F.col("length") == 1))
    code = F.conv(F.hex(F.encode("beginning", "UTF-32")), 16, 10).cast("long")
    size = F.coalesce("size", F.lit(1))
    edge = (
        F.shiftleft((F.col("start") + size).cast("long"), _END)
        + F.shiftleft((255 - size).cast("long"), _LENGTH)
        + F.when(F.col("piece_id").isNull(), F.lit(1 << _CHAR) + code).otherwise(F.col("piece_id").cast("long"))
    )
    return met.select(*kept, F.when(F.col("tail").isNotNull(), edge).alias("edge"))


class _Fold:
    """Best paths of lattices by a fold over their edges, and back over the edges of the best path.

    Of equal scores the first start wins. A character that is no piece is spelt in bytes.
    """

    def __init__(self, pieces: Pieces):
        self.scores = np.zeros(max(pieces.ids.values()) + 1)
        for piece, score in pieces.scores.items():
            self.scores[pieces.ids[piece]] = score
        self.unknown, self.byte_ids = pieces.unknown_score, pieces.byte_ids

    def ids(self, edges: np.ndarray, part: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``n`` parts one after the other, and how many each has. Edges come by part, start and length."""
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, part, edges >> _END)
        long = longest > _SHORT
        inside = np.flatnonzero(~long[part])
        last, owner = self._together(edges[inside], part[inside], n)
        last = inside[last]
        for p in np.flatnonzero(long):
            first, stop = np.searchsorted(part, [p, p + 1])
            path = first + self._alone(edges[first:stop])
            last, owner = np.concatenate([last, path]), np.concatenate([owner, np.full(len(path), p)])
        if long.any():
            order = np.argsort(owner, kind="stable")
            last, owner = last[order], owner[order]
        chosen = edges[last]
        values = chosen & (1 << _CHAR) - 1
        chars = (chosen >> _CHAR & 1).astype(bool)
        spelt = [[self.byte_ids[x] for x in chr(v).encode()] for v in values[chars]]
        sizes = np.ones(len(chosen), np.int64)
        sizes[chars] = [len(s) for s in spelt]
        found = np.repeat(values, sizes)
        found[np.repeat(chars, sizes)] = [x for s in spelt for x in s]
        return found, np.bincount(owner, weights=sizes, minlength=n).astype(np.int64)

    def _together(self, edges: np.ndarray, part: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Edges of the best paths of short parts, in order, and their parts."""
        ends, lengths = (edges >> _END).astype(np.uint8), 255 - (edges >> _LENGTH & 255)
        weights = np.where(edges >> _CHAR & 1, self.unknown, self.scores[np.minimum(edges & (1 << _CHAR) - 1, len(self.scores) - 1)])
        best = np.zeros((n, _SHORT + 1))
        last = np.zeros((n, _SHORT + 1), np.int64)
        at = np.zeros(n, np.int64)
        by_end = np.argsort(ends, kind="stable")
        bounds = np.searchsorted(ends[by_end], np.arange(_SHORT + 2))
        for end in range(1, _SHORT + 1):
            some = by_end[bounds[end] : bounds[end + 1]]
            if not len(some):
                break
            p = part[some]
            scores = best[p, end - lengths[some]] + weights[some]
            firsts = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
            highest = np.maximum.reduceat(scores, firsts)
            best[p[firsts], end] = highest
            at[p[firsts]] = end
            hit = np.flatnonzero(scores == np.repeat(highest, np.diff(np.append(firsts, len(p)))))[::-1]
            last[p[hit], end] = some[hit]  # of several, the first is written last
        steps, owners = [], []
        going = np.flatnonzero(at)
        while len(going):
            chosen = last[going, at[going]]
            steps.append(chosen)
            owners.append(going)
            at[going] -= lengths[chosen]
            going = going[at[going] > 0]
        if not steps:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        chosen, owner = np.concatenate(steps[::-1]), np.concatenate(owners[::-1])
        order = np.argsort(owner, kind="stable")
        return chosen[order], owner[order]

    def _alone(self, edges: np.ndarray) -> np.ndarray:
        """Edges of the best path of one part, in order."""
        order = np.argsort(edges)
        edges = edges[order]
        ends, lengths = (edges >> _END).tolist(), (255 - (edges >> _LENGTH & 255)).tolist()
        chars, values = (edges >> _CHAR & 1).tolist(), (edges & (1 << _CHAR) - 1).tolist()
        best = [float("-inf")] * (ends[-1] + 1)
        last = [0] * len(best)
        best[0] = 0.0
        for i, end in enumerate(ends):
            score = best[end - lengths[i]] + (self.unknown if chars[i] else self.scores[values[i]])
            if score > best[end]:
                best[end], last[end] = score, i
        path: list[int] = []
        at = ends[-1]
        while at:
            path.append(last[at])
            at -= lengths[last[at]]
        return order[path[::-1]]


def _gathered(pieces: Pieces):
    """From rows (id, row, at, ids, edge) of texts in order to a row (id, ids) for each text."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = _Fold(pieces)
        texts = _Texts()
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= _ROWS:
                rest, whole = _split(held)
                if whole is not None:
                    yield from texts.add(whole, fold)
                held = rest
        if held:
            yield from texts.add(pa.Table.from_batches(held).combine_chunks(), fold)
        yield from texts.end()

    return gather


def _split(held: list[pa.RecordBatch]) -> tuple[list[pa.RecordBatch], pa.Table | None]:
    """The rows of the last part, which may go on, and all rows before."""
    row, at = (held[-1].column(c)[-1].as_py() for c in ("row", "at"))
    rest: list[pa.RecordBatch] = []
    while held:
        batch = held.pop()
        same = (batch.column("row").to_numpy() == row) & (batch.column("at").to_numpy() == at)
        first = len(batch) - (np.append(same[::-1], False).argmin())
        rest.insert(0, batch.slice(first))
        if first:
            return rest, pa.Table.from_batches([*held, batch.slice(0, first)]).combine_chunks()
    return rest, None


class _Texts:
    """Puts the ids of parts together; holds those of the text that may go on."""

    def __init__(self):
        self.at, self.id, self.parts = (-1, -1), None, []

    def add(self, rows: pa.Table, fold: _Fold) -> Iterator[pa.RecordBatch]:
        row, at = rows.column("row").to_numpy(), rows.column("at").to_numpy()
        ahead = (np.diff(row) > 0) | ((np.diff(row) == 0) & (np.diff(at) >= 0))
        if not ahead.all() or (int(row[0]), int(at[0])) <= self.at:
            raise RuntimeError("the rows of a text are not in order")
        firsts = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (at[1:] != at[:-1])]))
        ids = rows.column("ids").combine_chunks()
        ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
        sizes = np.asarray(ids.value_lengths().fill_null(0))[firsts].astype(np.int64)
        edges = rows.column("edge")
        is_edge = np.asarray(edges.is_valid())
        unknown = is_edge[firsts]
        part = np.cumsum(unknown) - 1
        owner = np.repeat(part, np.diff(np.append(firsts, len(row))))[is_edge]
        known = np.asarray(ids.flatten())
        found, counts = fold.ids(edges.drop_null().to_numpy(), owner, int(unknown.sum())) if is_edge.any() else (known[:0], sizes[:0])
        sizes[unknown] = counts
        of_unknown = np.repeat(unknown, sizes)
        flat = np.empty(int(sizes.sum()), np.int32)
        flat[of_unknown] = found
        flat[~of_unknown] = known
        ends = np.cumsum(sizes)
        new = np.flatnonzero(np.concatenate([[True], row[firsts][1:] != row[firsts][:-1]]))
        cuts = np.append(0, ends)[new]
        if int(row[0]) == self.at[0]:
            new, cuts = new[1:], cuts[1:]
            self.parts.append(flat[: cuts[0]] if len(cuts) else flat)
        if len(new):
            yield from self.end()
            whole = cuts[: len(cuts)].astype(np.int32)
            if len(new) > 1:
                values = pa.array(flat[whole[0] : whole[-1]])
                lists = pa.ListArray.from_arrays(pa.array(whole - whole[0]), values)
                yield pa.RecordBatch.from_arrays([rows.column("id").take(pa.array(firsts[new[:-1]])).combine_chunks(), lists], ["id", "ids"])
            self.id, self.parts = rows.column("id").slice(int(firsts[new[-1]]), 1).combine_chunks(), [flat[whole[-1] :]]
        self.at = (int(row[-1]), int(at[-1]))

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.id is not None:
            flat = np.concatenate(self.parts)
            yield pa.RecordBatch.from_arrays([self.id, pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat))], ["id", "ids"])
        self.id = None


def encoded_parts(rows: DataFrame, pieces: Pieces, known: DataFrame | None = None, stretches: DataFrame | None = None) -> DataFrame:
    """(id, ids) of rows (id, parts). ``known`` and ``stretches`` have the ids of some parts and
    stretches (part, ids) and are sent to every task."""
    parts = rows.withColumn("row", F.monotonically_increasing_id()).select("id", "row", F.posexplode_outer("parts").alias("at", "part"))
    parts = parts.withColumn("at", F.coalesce("at", F.lit(0)))
    if known is None:
        parts = parts.withColumn("ids", F.lit(None).cast("array<int>"))
    else:
        parts = parts.join(F.broadcast(known), "part", "left")
    if stretches is not None:
        cut = F.when(F.col("part").isNull() | F.col("ids").isNotNull(), F.array("part")).otherwise(stretches_of(F.col("part"), pieces))
        parts = parts.select("id", "row", "at", "ids", F.posexplode(cut).alias("n", "part"))
        parts = parts.select("id", "row", F.expr("shiftleft(cast(at as bigint), 32) + n").alias("at"), "part", F.col("ids").alias("of_part"))
        parts = parts.join(F.broadcast(stretches), "part", "left").withColumn("ids", F.coalesce("of_part", "ids"))
    edges = edges_of(parts.select("id", "row", "at", "part", "ids"), pieces).select("id", "row", "at", "ids", "edge")
    # Behind a missing list, Arrow's writer fills in all offsets since the last list anew for each row of a batch.
    edges = edges.withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    kind = dict(rows.dtypes)["id"]
    return edges.mapInArrow(_gathered(pieces), f"id {kind}, ids array<int>")


def encode(docs: DataFrame, pieces: Pieces | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id column and ``ids``, the pieces of the whole text in order.

    A missing or empty text has no pieces; repeated rows are encoded each. Rows stay in
    their task. A text without blanks is one part. Other columns are not read.
    """
    pieces = pieces or load()
    rows = docs.select(F.col(id_col).alias("id"), parts_of(filled(text_col)).alias("parts"))
    steps = Steps(docs.sparkSession, "lattice")
    found: list[DataFrame] = []
    for name, part in zip(("known_stretches", "known"), frequent_parts(rows, pieces, steps)[::-1]):
        alone = part.select(F.col("part").alias("id"), F.array("part").alias("parts"))
        found.append(steps.write(encoded_parts(alone, pieces).withColumnRenamed("id", "part"), name))
    steps.remove("counts", "stretches")
    return encoded_parts(rows, pieces, *found[::-1]).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, pieces: Pieces | None = None, ids_col: str = "ids", name: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in column ``name``; ids that are no piece have no text.

    Pieces are looked up in a literal array of the bounded vocabulary, and bytes are read as UTF-8.
    """
    pieces = pieces or load()
    code = {i: piece.replace(BLANK, " ").encode().hex() for piece, i in pieces.ids.items()}
    code |= {i: f"{b:02x}" for b, i in enumerate(pieces.byte_ids)}
    codes = F.split(F.lit(",".join(code.get(i, "") for i in range(max(code) + 1))), ",", -1)
    text = let(
        codes,
        lambda c: F.decode(F.unhex(F.array_join(F.transform(F.col(ids_col), lambda i: F.coalesce(F.get(c, i), F.lit(""))), "")), "UTF-8"),
    )
    whole = F.when(F.coalesce(F.size(ids_col), F.lit(0)) == 0, F.lit("")).otherwise(F.substring(text, 2, 2147483647))
    return encoded.withColumn(name, whole)
