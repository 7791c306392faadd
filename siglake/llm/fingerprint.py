"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches.

A text's paragraphs, each counted once, are hashed: its lines that are not empty, and
of lines of more than 64 characters the pieces that end with a sentence or with a word
whose hash says so, one in eight. Words of more than 64 characters are cut likewise,
where the hash of four characters says so. A cut depends on the words around it only, so
text that stays keeps its pieces. Each hash is put into one cell of each of three tables: a cell has the number of its
hashes, their exclusive or, and that of a second hash of them. Subtracting one text's
cells from another's leaves the paragraphs in which they differ. A cell with one of
them names it; taking it out of its other cells frees more. If paragraphs remain in
cells that no longer free any, the pair is tried again with larger tables.

All steps for a document happen where its row is: once documents are dealt out by
their place in the order, their hashes are written in buckets, and nothing is moved. Tables are peeled one after the other, as
within one table a paragraph has one cell only and is therefore never taken out twice.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siglake.llm.common import filled, let, with_once
from siglake.session import Steps, written

# Cells in each of the three tables of the fingerprint itself, and growth per retry.
CELLS = 16
GROWTH = 4
SWEEPS = 4
_SEGMENTS = 64
# Lines and words of more characters are cut; one cut in so many words, or characters of such words.
_LONG = 64
_ONE_IN = 8
_SENTENCE_END = r"[.!?\x{3002}\x{FF01}\x{FF1F}][\x22'\x29\x5D\x{201D}\x{2019}\x{00BB}]*\x20*$"
_TALLY = -1
# Buckets for each shuffle partition: a task groups the cells of its bucket in memory.
BUCKETS = 4


def with_next(docs: DataFrame, id_col: str, text_col: str, name: str, parts: int) -> DataFrame:
    """(``bucket``, ``row``, id, ``text``, ``own``, ``name``, ``next``): each text and that of the next
    document by id, and the paragraphs of both, which are found once per text.

    After the last comes the first; repeated ids follow each other by their text's hash,
    missing ids come first. Ids are dealt into about sqrt(n) buckets of about sqrt(n)
    documents, evenly within each of 64 quantile ranges. Only the first id of each
    bucket is ordered as a whole.
    """
    rows = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    at = [i / _SEGMENTS for i in range(_SEGMENTS + 1)]
    stats = rows.agg(F.count("*").alias("n"), F.percentile_approx("id", at, 10_000).alias("cuts")).first()
    cuts = sorted(set(stats["cuts"] or [0]))
    per_bucket = max(256, math.isqrt(stats["n"]))
    parts = max(1, stats["n"] // len(cuts) // per_bucket)
    widths = [max(1, -(-(b - a) // parts)) for a, b in zip(cuts, [*cuts[1:], cuts[-1] + 1])]
    segment = reduce(lambda a, b: a + b, [(F.col("id") >= c).cast("int") for c in cuts[1:]], F.lit(0))
    pick = lambda values, i: F.get(F.array(*[F.lit(v).cast("long") for v in values]), i)
    rows = rows.withColumn("segment", segment)
    place = F.floor((F.col("id") - pick(cuts, F.col("segment"))) / pick(widths, F.col("segment")))
    bucket = F.coalesce(F.col("segment") * F.lit(1 << 32) + F.greatest(place, F.lit(0)), F.lit(-1).cast("long"))
    rows = rows.select(bucket.alias("bucket"), "id", "text")

    first = written(rows.groupBy("bucket").agg(F.min("id").alias("first_id")))
    lowest = first.agg(F.min("bucket")).first()[0]
    before = first.select(
        "bucket",
        "first_id",
        F.lag("bucket").over(Window.orderBy("bucket")).alias("to"),
        F.max("bucket").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"),
    ).select("bucket", "first_id", F.coalesce("to", "last").alias("to"))
    before = written(before)
    borders = rows.join(
        before.withColumnRenamed("bucket", "b"), (F.col("bucket") == F.col("b")) & F.col("id").eqNullSafe(F.col("first_id"))
    )
    order = F.struct(F.xxhash64("text").alias("h"), "text")
    ghosts = borders.groupBy("to").agg(F.min(order).alias("o")).select(
        F.col("to").alias("bucket"), F.lit(None).cast(rows.schema["id"].dataType).alias("id"), F.col("o.text").alias("text"), F.lit(1).alias("ghost")
    )
    both = rows.withColumn("ghost", F.lit(0)).unionByName(ghosts).repartition(parts, "bucket")
    both = with_once(both, "own", paragraphs(F.col("text")))
    window = Window.partitionBy("bucket").orderBy("ghost", F.col("id").asc_nulls_first(), F.xxhash64("text"), "text")
    following = both.select(
        "bucket", F.row_number().over(window).alias("row"), "id", "text", "own", "ghost",
        F.lead("text").over(window).alias(name), F.lead("own").over(window).alias("next"),
    )
    return following.where("ghost = 0").drop("ghost") if lowest is not None else following.drop("ghost")


def _grouped(tokens: Column, ends: Callable[[Column, Column], Column]) -> Column:
    """Tokens joined up to each one that ends a group, or is the last."""

    def groups(tokens: Column) -> Column:
        last = F.size(tokens) - 1
        places = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | ends(tokens, i))
        start = lambda at, j: F.coalesce(F.get(at, j - 1) + 1, F.lit(0))
        return let(
            places,
            lambda at: F.transform(at, lambda i, j: F.array_join(F.slice(tokens, start(at, j) + 1, i - start(at, j) + 1), "")),
        )

    return let(tokens, groups)


def _pieces(line: Column) -> Column:
    """A long line cut by its own words, each with the blank behind it."""
    chosen = lambda value: F.pmod(F.xxhash64(value), F.lit(_ONE_IN)) == 0
    four = lambda chars, i: F.concat(*[F.coalesce(F.get(chars, i - k), F.lit("")) for k in range(4)])
    cut = lambda word: _grouped(
        F.split(word, "", -1), lambda chars, i: chosen(four(chars, i)) | F.rlike(F.get(chars, i), F.lit(_SENTENCE_END))
    )
    words = F.flatten(
        F.transform(F.split(line, "(?<= )", -1), lambda w: F.when(F.length(w) > _LONG, cut(w)).otherwise(F.array(w)))
    )
    ended = lambda words, i: chosen(F.rtrim(F.get(words, i))) | F.rlike(F.get(words, i), F.lit(_SENTENCE_END))
    return F.filter(F.transform(_grouped(words, ended), lambda x: F.trim(x)), lambda x: x != "")


def paragraphs(text: Column) -> Column:
    """64-bit hashes of the distinct paragraphs."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x != "")
    units = F.flatten(
        F.transform(
            lines,
            lambda x: F.when((F.length(x) > _LONG) & (F.trim(x) != ""), _pieces(x)).otherwise(F.array(x)),
        )
    )
    return F.array_distinct(F.transform(units, lambda x: F.xxhash64(x)))


def _cell(key: Column, table: int, cells: Column) -> Column:
    return (table * cells + F.pmod(F.xxhash64(key, F.lit(table)), cells)).cast("int")


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


# Documents are told apart by bucket and row; all their rows lie in the bucket.
PLACE = ("bucket", "row")
# What is compared: the document's own paragraphs and those of another side.
PAIRS = {"edited": "other", "next": "next"}


def _merged(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys, "cell").agg(F.sum("c").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"))


def with_sketches(keys: DataFrame, columns: dict[str, str], carried: Sequence[str], cells: int = CELLS) -> DataFrame:
    """(carried, sketches): a sketch of the paragraphs in each array column, named as in ``columns``.

    A sketch is an array of its cells in order. The carried columns travel in one entry of
    their own, so that no join brings them back.
    """
    kept = F.struct(*carried)
    entry = lambda side, k, kept: F.struct(F.lit(side).cast("string").alias("side"), k.cast("long").alias("k"), kept.alias("kept"))
    nothing = F.when(F.lit(False), kept)
    tagged = lambda c: F.transform(F.col(c), lambda k: entry(c, k, nothing))
    sides = [tagged(c) for c in columns]
    entries = keys.select(*PLACE, F.explode(F.concat(F.array(entry(None, F.lit(None), kept)), *sides)).alias("e")).select(*PLACE, "e.*")
    places = F.when(F.col("k").isNull(), F.array(F.lit(_TALLY))).otherwise(F.array(*[_cell(F.col("k"), t, F.lit(cells)) for t in range(3)]))
    spread = entries.select(*PLACE, "side", "kept", "k", F.explode(places).alias("cell"))
    one = F.lit(1).cast("long").alias("c")
    placed = _merged(spread.select(*PLACE, "side", "kept", "cell", one, "k", _check(F.col("k")).alias("h")), *PLACE, "side", "kept")
    cell = F.struct("cell", "c", "k", "h")
    listed = [F.sort_array(F.collect_list(F.when(F.col("side") == c, cell))).alias(name) for c, name in columns.items()]
    return placed.groupBy(*PLACE).agg(F.max("kept").alias("kept"), *listed).select("kept.*", *columns.values())


def subtracted(pairs: DataFrame) -> DataFrame:
    """(bucket, row, pair, size, cell, c, k, h): the own sketch less the other one; empty cells fall away.

    ``pairs`` has the paragraphs of both sides as ``a`` and ``b`` and the ``size`` of a table.
    A tally, which counts what is peeled off, says that there is the pair.
    """
    some = lambda side, sign: F.transform(
        F.col(side), lambda k: F.struct(k.alias("k"), F.lit(sign).cast("long").alias("c"))
    )
    tally = F.array(F.struct(F.lit(None).cast("long").alias("k"), F.lit(0).cast("long").alias("c")))
    keys = pairs.select(*PAIR, F.explode(F.concat(tally, some("a", 1), some("b", -1))).alias("e")).select(*PAIR, "e.*")
    places = F.array(*[_cell(F.col("k"), t, F.col("size")) for t in range(3)])
    cells = keys.select(*PAIR, "k", "c", F.explode(F.when(F.col("k").isNull(), F.array(F.lit(_TALLY))).otherwise(places)).alias("cell"))
    zero = F.lit(0).cast("long")
    named = F.col("k").isNotNull()
    rows = cells.select(*PAIR, "cell", "c", F.when(named, _check(F.col("k"))).otherwise(zero).alias("h"), F.coalesce("k", zero).alias("k"))
    return _filled(_merged(rows, *PAIR))


def _filled(cells: DataFrame) -> DataFrame:
    return cells.where((F.col("cell") == _TALLY) | (F.col("c") != 0) | (F.col("k") != 0) | (F.col("h") != 0))


PAIR = (*PLACE, "pair", "size")


def _peeled(cells: DataFrame) -> DataFrame:
    """Take out what a cell of one paragraph names, table after table; a tally counts it."""
    size = F.col("size")
    for sweep in range(3 * SWEEPS):
        table = sweep % 3
        c, k, h = (F.col(x) for x in ("c", "k", "h"))
        single = (
            F.col("cell").between(table * size, (table + 1) * size - 1)
            & (F.abs(c) == 1)
            & (h == _check(k))
            & (F.col("cell") == _cell(k, table, size))
        )
        row = lambda cell, c, k, h: F.struct(cell.alias("cell"), c.alias("c"), k.alias("k"), h.alias("h"))
        zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        taken = F.array(
            row(F.lit(_TALLY), one, zero, zero), *[row(_cell(k, t, size), -c, k, h) for t in range(3) if t != table]
        )
        out = F.explode(F.when(single, taken).otherwise(F.array(row(F.col("cell"), c, k, h)))).alias("x")
        cells = _filled(_merged(cells.select(*PAIR, out).select(*PAIR, "x.*"), *PAIR))
    return cells


def differences(keys: DataFrame, steps: Steps) -> DataFrame:
    """(bucket, row, pair, ``n``): in how many paragraphs the sides of a pair differ.

    The fingerprints of both sides are subtracted and peeled. They hold up to about forty
    paragraphs that differ: pairs with more than ``4 * CELLS`` in both texts, and those
    whose cells cannot be emptied, are tried with larger sketches, each time four times as
    large. No step moves a row.
    """
    sides = F.array(*[F.struct(F.lit(p).alias("pair"), F.col("own").alias("a"), F.col(side).alias("b")) for p, side in PAIRS.items()])
    pairs = keys.select(*PLACE, F.explode(sides).alias("p")).select(*PLACE, "p.*")
    both = F.size("a") + F.size("b")
    size = F.when(both <= 4 * CELLS, F.lit(CELLS)).otherwise(F.pow(F.lit(2), F.ceil(F.log2(both / 2))).cast("int"))
    pairs = pairs.select("*", size.alias("size"))
    done, wanted, turn = [], pairs, 0
    tally = F.col("cell") == _TALLY
    while True:
        result = _peeled(subtracted(wanted)).groupBy(*PAIR).agg(
            F.sum(F.when(tally, F.col("c")).otherwise(F.lit(0).cast("long"))).alias("n"), F.sum(F.when(tally, F.lit(0)).otherwise(F.lit(1))).alias("left")
        )
        result = steps.write_buckets(result, f"peeled-{turn}", "bucket", BUCKETS)
        done.append(result.where("left = 0").select(*PLACE, "pair", "n"))
        failed = result.where("left > 0")
        if failed.isEmpty():
            return reduce(DataFrame.unionByName, done)
        larger = F.struct(F.col("pair").alias("open"), (F.col("size") * GROWTH).alias("size"))
        failed = failed.groupBy(*PLACE).agg(F.collect_list(larger).alias("again"))
        again = pairs.drop("size").join(failed, list(PLACE)).select(*PLACE, "pair", "a", "b", F.explode("again").alias("t"))
        wanted, turn = again.where("pair = t.open").select(*PLACE, "pair", "a", "b", "t.size"), turn + 1


def likeness(n_a: Column, n_b: Column, differing: Column) -> Column:
    """Shared paragraphs over all of both texts; 1 for two texts without any."""
    total = n_a + n_b
    return F.when(total == 0, F.lit(1.0)).otherwise((total - differing) / (total + differing))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n / 2) code points replaced by the first as many of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_chars``, ``edited_sha256``, the sketches ``cells`` and
    ``edited_cells`` (arrays of cell, count, hash, check), ``near_edited``, ``near_next``.

    A missing text is empty; a text without a paragraph has no cells. The id has to be a
    whole number; rows with equal ids follow each other. The only document of a table
    is its own next. Paragraphs that are only reordered or repeated make no difference.
    Other columns are not read.
    """
    steps = Steps(docs.sparkSession, "fingerprints")
    # Tables in equal buckets are joined by document where they are.
    docs.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    rows = with_next(docs, id_col, text_col, "following", steps.buckets(BUCKETS))
    rows = with_once(rows, "edited", edited(F.col("text"), F.col("following")))
    keys = rows.select(
        *PLACE,
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "own",
        paragraphs(F.col("edited")).alias("other"),
        "next",
    )
    keys = steps.write_buckets(keys, "keys", "bucket", BUCKETS)
    found = differences(keys, steps)
    value = lambda pair: F.max(F.when(F.col("pair") == pair, F.col("n"))).alias(f"d_{pair}")
    counts = found.groupBy(*PLACE).agg(*map(value, PAIRS)).repartition(steps.buckets(BUCKETS), "bucket")
    counts = steps.write_buckets(counts, "counts", "bucket", BUCKETS)
    n = F.size
    told = keys.join(counts, list(PLACE), "left").withColumns(
        {
            "near_edited": likeness(n("own"), n("other"), F.col("d_edited")),
            "near_next": likeness(n("own"), n("next"), F.col("d_next")),
        }
    )
    carried = ["id", "n_chars", "edited_sha256", "near_edited", "near_next"]
    out = with_sketches(told, {"own": "cells", "other": "edited_cells"}, carried)
    return out.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "cells", "edited_cells", "near_edited", "near_next")


def spelled(cells: Column) -> Column:
    """A sketch as text: place, count, hash and check of each cell that is not empty."""
    text = F.transform(
        F.coalesce(cells, F.array().cast("array<struct<cell:int,c:bigint,k:bigint,h:bigint>>")),
        lambda x: F.concat_ws(":", x["cell"], x["c"], x["k"], x["h"]),
    )
    return F.array_join(text, ",")
