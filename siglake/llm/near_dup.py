"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct word shingles, as 64-bit hashes. Each hash falls into
one of REGISTERS buckets; a bucket keeps its smallest value, compressed to the number
of leading zeros and some mantissa bits. Bands of registers find candidates, the
registers of a pair estimate its similarity with chance agreements taken out, and what
may pass is confirmed on the full sets.

Documents with one set are one class, and only classes are compared. In a band's group
each class is first compared with one member (the hub) only, a different one in each
band. Then only groups that still hold several components are looked at: their pairs
across components are all compared. Groups too large for that form families, whose
members are described by their difference to what most of the family has in common.
Two members are as far apart as their differences are, so similar ones share rare items
of these, which finds every similar pair exactly (``sharing_differences``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import unused, with_once
from siglake.session import Steps, small_batches

REGISTERS = 256
MANTISSA = 10
# Members whose sets say what a family has in common.
TELLERS = 64
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """shingle: words per shingle. percent: similarity from which two are linked.
    bands, rows: bands of so many registers each; two sets of just that similarity share
    no band in 4 of 100,000 cases (2 of 10,000 for CORPUS), more alike ones far less often. pair_factor: a group's remaining
    pairs are compared if they are at most so many times its members. class_ratio: differences
    within this ratio of sizes are one size class. slack: how far below the threshold an estimate may be for the pair to be confirmed, in
    standard deviations of the estimate."""

    shingle: int = 3
    percent: int = 85
    bands: int = 32
    rows: int = 8
    pair_factor: int = 8
    class_ratio: float = 1.25
    slack: float = 6.0


# What a corpus pipeline uses.
CORPUS = Settings(shingle=5, percent=80, bands=36, rows=7)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _ODD)]))[:n]


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; A-Z count as a-z."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    # A word's hash is a polynomial of its bytes, mixed.
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(len(data)) - np.repeat(starts, lengths)
    powers = _powers(int(lengths.max()))
    hashes = _mixed(np.add.reduceat(data * powers[within], starts) + lengths.astype(np.uint64) * _MIX[1])
    size = min(size, len(words))
    found = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        found = _mixed(found * _ODD + hashes[k : len(hashes) - size + 1 + k] + np.uint64(size))
    return np.unique(found)


def registers(hashes: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of each bucket's smallest value; 0 for an empty bucket.

    The number grows as the value falls, so a bucket's register is its maximum.
    """
    bucket = (hashes >> np.uint64(56)).astype(np.int64)
    rest = hashes << np.uint64(8)
    order = np.lexsort((rest, bucket))
    bucket, rest = bucket[order], rest[order]
    first = np.concatenate([[True], bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, bool)
    bucket, value = bucket[first], rest[first]
    zeros = np.zeros(len(value), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        small = value < (np.uint64(1) << np.uint64(64 - step))
        zeros += np.where(small, step, 0)
        value = np.where(small, value << np.uint64(step), value)
    mantissa = ((value << np.uint64(1)) >> np.uint64(64 - MANTISSA)).astype(np.int64)
    out = np.zeros(REGISTERS, np.uint16)
    out[bucket] = ((zeros + 1) << MANTISSA) | ((1 << MANTISSA) - 1 - mantissa)
    return out


def _detours() -> np.ndarray:
    """For each bucket, all buckets in an order of its own."""
    n = REGISTERS
    scores = _mixed(np.arange(1, n * n + 1, dtype=np.uint64) * _ODD).reshape(n, n)
    return np.argsort(scores, axis=1, kind="stable")


_DETOURS = _detours()


def densified(signature: np.ndarray) -> np.ndarray:
    """The registers, where an empty bucket takes the first filled one on its own detour.

    Any two sets then agree in any register with odds equal to their similarity, small
    sets too, whose bands would else hold few values and agree too easily.
    """
    filled = signature > 0
    empty = np.flatnonzero(~filled)
    if len(empty) in (0, len(signature)):
        return signature
    ways = _DETOURS[empty]
    dense = signature.copy()
    dense[empty] = signature[ways[np.arange(len(empty)), filled[ways].argmax(axis=1)]]
    return dense


def band_keys(signature: np.ndarray, settings: Settings) -> np.ndarray:
    """A 64-bit key of each band; the band's number is part of it. None for an empty set."""
    if not signature.any():
        return np.empty(0, np.int64)
    dense = densified(signature)[: settings.bands * settings.rows]
    keys = np.arange(1, settings.bands + 1, dtype=np.uint64)
    for column in dense.reshape(settings.bands, settings.rows).astype(np.uint64).T:
        keys = _mixed(keys * _ODD + column)
    return keys.view(np.int64)


def estimates(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series, settings: Settings) -> pd.Series:
    """Whether pairs of signatures may reach the threshold.

    The share of agreeing registers overstates the similarity: unlike values agree by
    chance if they fall into one cell of leading zeros and mantissa. The expected share
    of such agreements, from the number of values per bucket, is taken out.
    """
    x = np.frombuffer(b"".join(a), np.uint16).reshape(len(a), REGISTERS)
    y = np.frombuffer(b"".join(b), np.uint16).reshape(len(b), REGISTERS)
    either = (x > 0) | (y > 0)
    n = np.maximum(either.sum(axis=1), 1)
    agree = (either & (x == y)).sum(axis=1) / n
    # Two minima lie in one leading-zero class with odds of at most 1/2, and then in one
    # of 2**MANTISSA cells; both buckets have to hold a value.
    filled = ((x > 0) & (y > 0)).sum(axis=1) / n
    chance = filled * 0.5 / (1 << MANTISSA)
    similar = np.clip((agree - chance) / (1 - chance), 0, 1)
    limit = settings.percent / 100
    return pd.Series(similar + settings.slack * np.sqrt(limit * (1 - limit) / n) >= limit)


def _digest(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per row of ``id``, ``text``: ``id``, ``n`` (set size), ``node`` (digest of the set), ``keys`` of its bands."""

    @F.pandas_udf("n long, node binary, keys array<long>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        rows = ((len(s), _digest(s), band_keys(registers(s), settings)) for s in (shingle_set(t, settings.shingle) for t in texts))
        return pd.DataFrame(rows, columns=["n", "node", "keys"])

    return with_once(docs.select("id", sketch("text").alias("s")), "t", F.col("s")).select("id", "t.*")


def full_sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per row of ``id``, ``text``: ``node``, ``n``, ``signature`` and the set itself as ``items``."""

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 256):  # sets are larger than texts
                part = batch["text"][start : start + 256]
                sets = [shingle_set(t, settings.shingle) for t in part]
                yield pd.DataFrame(
                    {
                        "node": [_digest(s) for s in sets],
                        "n": [len(s) for s in sets],
                        "signature": [registers(s).tobytes() for s in sets],
                        "items": [s.view(np.int64) for s in sets],
                    }
                )

    return docs.mapInPandas(whole, "node binary, n long, signature binary, items array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""

    @F.pandas_udf("boolean")
    def may_pass(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        return estimates(a, b, n_a, n_b, settings)

    side = lambda x, *cs: sets.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in cs])
    sizes = pairs.join(side("a", "n", "signature"), "a").join(side("b", "n", "signature"), "b")
    close = 100 * F.least("n_a", "n_b") >= settings.percent * F.greatest("n_a", "n_b")
    likely = sizes.where(close).where(may_pass("signature_a", "signature_b", "n_a", "n_b")).select("a", "b", "n_a", "n_b")
    both = likely.join(side("a", "items"), "a").join(side("b", "items"), "b")
    shared = F.size(F.array_intersect("items_a", "items_b"))
    alike = 100 * shared >= settings.percent * (F.col("n_a") + F.col("n_b") - shared)
    return both.where(alike).select("a", "b")


def components(links: DataFrame, steps: Steps, name: str) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b); the component is its smallest node.

    Every node takes the smallest label next to it and then that label's label, until
    nothing changes, which takes about as many rounds as the logarithm of the longest path.
    """
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = steps.write(links.select(F.explode(both).alias("e")).select("e.*"), f"{name}-edges")
    labels = steps.write(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")),
        f"{name}-0",
    )
    turn = 0
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.node == near.a).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        lower = steps.write(lower, f"{name}-{turn}-lower")
        target = lower.select(F.col("node").alias("via"), F.col("label").alias("far"))
        jumped = lower.join(target, lower.label == target.via).select("node", F.least("label", "far").alias("label"), "was")
        jumped = steps.write(jumped, f"{name}-{turn + 1}")
        labels = jumped.select("node", "label")
        steps.remove(f"{name}-{turn}", f"{name}-{turn}-lower")
        turn += 1
        if jumped.where(F.col("label") != F.col("was")).isEmpty():
            steps.remove(f"{name}-edges")
            return labels.withColumnRenamed("label", "component")


def _labelled(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """``members`` (g, node) with the component of each node."""
    if found is None:
        return members.withColumn("component", F.col("node"))
    return members.join(found, "node", "left").select("g", "node", F.coalesce("component", "node").alias("component"))


def differences(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """``nodes`` (node, family, ...) with the size ``n`` of their sets and ``away``, their difference to the family.

    A family is described by the items that more than half of some members have, about
    ``TELLERS`` of them chosen by hash; ``away`` holds what a member has beside these, and
    what it lacks of them. Any description serves: it decides how many pairs are compared,
    not which links are found.
    """
    rows = sets.select("node", "n", "items").join(nodes, "node")
    sizes = nodes.groupBy("family").agg(F.count("*").alias("all"))
    told = F.pmod(F.xxhash64("node"), F.col("all")) < TELLERS
    some = rows.join(sizes, "family").where(told).select("family", "node", "items")
    counts = some.select("family", F.explode("items").alias("item")).groupBy("family", "item").agg(F.count("*").alias("f"))
    tellers = some.groupBy("family").agg(F.count("*").alias("m"))
    common = counts.join(tellers, "family").where("2 * f > m").groupBy("family").agg(F.collect_list("item").alias("common"))
    none = F.array().cast("array<long>")
    both = rows.join(common, "family", "left").withColumn("common", F.coalesce("common", none))
    away = F.concat(F.array_except("items", "common"), F.array_except("common", "items"))
    return both.withColumn("away", away).drop("items", "common")


def sharing_differences(nodes: DataFrame, sets: DataFrame, settings: Settings, steps: Steps) -> DataFrame:
    """Pairs (a, b) of one family and of different components, all linked ones among them.

    ``nodes`` has node, component and family. Sets A and B may differ in t items, and they
    differ in as many as their differences dA and dB to the family do. So

    * if |dA| + |dB| is at most t they are linked for certain. It is enough to pair every
      member for which that holds with the family's most central one.
    * else dA and dB share at least (|dA| + |dB| - t) / 2 items, hence one of the first few
      of each, whatever the order of items. With the rarest first, these are a member's
      own edits, which few others share. How few is enough depends on both sizes, so
      items are joined per pair of size classes.

    Common items that are not among the first few of both come after the last of these of one
    of the two, so that they are fewer than that one's ``shared``. Pairs whose common first
    items and these together are too few for a link are not handed on.
    """
    p = settings.percent
    rows = differences(nodes, sets).withColumn("k", F.size("away"))
    rows = steps.write(rows.withColumn("far", F.col("k") * (100 + p) - F.col("n") * (100 - p)), "differences")
    centres = rows.groupBy("family").agg(F.min(F.struct("far", "node", "component")).alias("centre"))
    certain = rows.join(centres, "family").where((F.col("far") + F.col("centre.far") <= 0) & (F.col("component") != F.col("centre.component")))
    certain = certain.select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))

    items = rows.select("family", "node", F.explode("away").alias("item"))
    often = items.groupBy("family", "item").agg(F.count("*").alias("f"))
    ranked = items.join(often, ["family", "item"]).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "item"))).alias("items"))
    most = F.col("n") * (100 - p) / p  # items by which a linked set can differ, at most
    ratio = settings.class_ratio
    # The class of a size, and the smallest size of a class; rounding errors only widen a class's range.
    class_of = lambda k: F.floor(F.log(k.cast("double")) / F.log(F.lit(ratio)) + 1e-9).cast("int")
    least_of = lambda c: F.floor(F.pow(F.lit(ratio), c) - 1e-6)
    partners = F.explode(F.sequence(class_of(F.greatest(F.col("k") - most, F.lit(1.0))) - 1, class_of(F.col("k") + most) + 1))
    own = rows.drop("away", "far").where("k > 0").join(ranked, "node").withColumn("own", class_of(F.col("k")))
    own = own.select("*", partners.alias("other"))
    smallest = F.greatest(least_of(F.col("other")), F.col("k") - most)
    shared = F.greatest(F.ceil((F.col("k") + smallest - most) / 2 - 1e-6), F.lit(1))
    first = F.filter(F.slice("items", 1, F.greatest(F.col("k") - shared + 1, F.lit(0)).cast("int")), lambda e: e["f"] > 1)
    seeds = own.select(
        "family", "node", "component", "n", "k", shared.alias("shared"), F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", F.explode(first).alias("e")
    )
    seeds = steps.write(seeds.select("*", F.col("e.item").alias("item")).drop("e"), "seeds")
    left = seeds.where("own = low")
    right = seeds.where("own = high").select(
        "family", "item", "low", "high", F.col("node").alias("b"), F.col("component").alias("component_b"), F.col("n").alias("n_b"),
        F.col("k").alias("k_b"), F.col("shared").alias("shared_b"),
    )
    close = 100 * F.least("n", "n_b") >= p * F.greatest("n", "n_b")
    apart = (F.col("component") != F.col("component_b")) & ((F.col("low") < F.col("high")) | (F.col("node") < F.col("b")))
    near = left.join(right, ["family", "item", "low", "high"]).where(apart & close)
    met = near.groupBy(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).agg(
        F.count("*").alias("met"), F.first(F.greatest("shared", "shared_b")).alias("shared"),
        F.first(F.col("k") + F.col("k_b")).alias("k"), F.first(F.col("n") + F.col("n_b")).alias("n"),
    )
    enough = 2 * (100 + p) * (F.col("met") + F.col("shared") - 1) >= F.col("k") * (100 + p) - F.col("n") * (100 - p)
    return certain.unionByName(met.where(enough).select("a", "b"))


def links_of(members: DataFrame, sets: DataFrame, settings: Settings, steps: Steps) -> DataFrame | None:
    """(node, component) from ``members`` (g, node) of the bands' groups; None without a link."""
    groups = members.groupBy("g").agg(F.min("node").alias("hub"))
    stars = members.join(groups, "g").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = steps.write(confirmed(stars.distinct(), sets, settings), "links")
    found = None if links.isEmpty() else components(links, steps, "first")
    labelled = _labelled(members, found)
    parts = labelled.groupBy("g", "component").agg(F.count("*").alias("m"))
    sizes = parts.groupBy("g").agg(
        F.sum("m").alias("m"), F.count("*").alias("parts"), F.max_by("component", "m").alias("main"), F.max("m").alias("main_m")
    ).where("parts > 1")
    large = (F.col("m") > settings.pair_factor) & (F.col("m") - F.col("main_m") > settings.pair_factor)
    members = steps.write(labelled.join(sizes.select("g", "main", large.alias("large")), "g"), "members-apart")
    small = members.where("not large")
    rest = small.where("component <> main").select("g", F.col("node").alias("other"), F.col("component").alias("theirs"))
    chosen = small.join(rest, "g").where("component <> theirs").select("node", "other")
    pairs = chosen.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    crowded = members.where("large")
    if not crowded.isEmpty():
        heads = crowded.groupBy("g").agg(F.min("node").alias("head"))
        ties = crowded.join(heads, "g").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
        families = components(ties, steps, "families").withColumnRenamed("component", "family")
        nodes = steps.write(crowded.select("node", "component").distinct().join(families, "node"), "families")
        pairs = pairs.unionByName(sharing_differences(nodes, sets, settings, steps))
    fresh = steps.write(confirmed(pairs.distinct(), sets, settings), "links-apart")
    if fresh.isEmpty():
        return found
    return components(links.unionByName(fresh), steps, "second")


def near_duplicates(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: the id column, ``n_shingles``, ``component_id`` and ``kept``.

    The component's id is the smallest id linked to the document, its own included;
    the row with that id is kept. A missing text, or one without words, has an empty
    set and is linked with nothing. A text of fewer words than a shingle is one
    shingle. Rows with equal sets always share a component; a repeated id counts row by
    row. A missing id can be linked but is no component's name, unless all are missing.
    Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    steps = Steps(docs.sparkSession, "near-duplicates")
    with small_batches(docs.sparkSession):
        sketched = steps.write(sketches(rows, settings), "sketches")
        classes = sketched.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.first("keys").alias("keys"))
        classes = steps.write(classes, "classes")
        keys = classes.select("node", F.explode("keys").alias("key"))
        shared = keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
        members = steps.write(keys.join(shared, "key").select(F.col("key").alias("g"), "node"), "members")
        nodes = members.select("node").distinct()
        ids = steps.write(classes.join(nodes, "node", "left_semi").select(F.col("id").alias("_id")).distinct(), "ids")
        texts = rows.join(ids, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
        sets = full_sets(texts, settings).join(nodes, "node", "left_semi").dropDuplicates(["node"])
        sets = steps.write(sets, "sets")
        found = links_of(members, sets, settings, steps)
    steps.remove("sets", "members", "members-apart", "ids", "differences", "seeds", "families")
    named = classes.select("node", "id")
    if found is None:
        labelled = named.select("node", F.col("id").alias("component_id"))
    else:
        labelled = named.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        names = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
        labelled = labelled.join(names, "component").select("node", "component_id")
    out = sketched.select("id", "n", "node").join(labelled, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def deduplicated(
    docs: DataFrame, settings: Settings = CORPUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component, with the columns of ``docs``: the one whose id names it.

    An id is taken to name one document: rows that share an id stay or go together, and
    go if one of their texts is a copy of a document with a smaller id.
    """
    gone = near_duplicates(docs, settings, id_col, text_col).where(~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct()
    name = unused("_gone", docs)
    left = docs.join(gone.withColumnRenamed("_gone", name), F.col(id_col) == F.col(name), "left_anti")
    return left
