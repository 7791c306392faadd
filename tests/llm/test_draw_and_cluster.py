"""Resampling, repeated word sequences and centroids against plain Python."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siglake.llm import centroids, queries, resample, substrings

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Resampling --------------------------------------------------------------------------------


def plain_resample(docs, target):
    def buckets(text):
        words = RUN_WORD.findall((text or "").translate(AZ))
        runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]

    source, wanted = Counter(), Counter()
    for _, text in docs:
        source.update(buckets(text)[1])
    for text in target:
        wanted.update(buckets(text)[1])
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = lambda b: math.floor(
        1000 * math.log((wanted[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000)))
    )
    rows, able = [], []
    for doc_id, text in docs:
        n, found = buckets(text)
        h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score))
        if n >= 20:
            able.append((-score, doc_id))
    ranks = {doc_id: i + 1 for i, (_, doc_id) in enumerate(sorted(able)[: 5 * len(able) // 100])}
    return sorted((*row, ranks.get(row[0])) for row in rows)


@needs_data
def test_op11_agrees_with_plain(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op11_resample"](spark, SF_DIR).collect())
    assert got == plain_resample(docs, target)


def test_words_of_runs():
    n, buckets = resample.run_buckets("A-b1 Ä_c\x7fd".encode(), resample.Settings())
    runs = ["a", "b1", "Ä", "c", "d", "a b1", "b1 Ä", "Ä c", "c d", "a b1 Ä", "b1 Ä c", "Ä c d"]
    assert n == 5 and buckets.tolist() == [zlib.crc32(r.encode()) % 10000 for r in runs]


def test_ties_go_to_smaller_ids_then_to_one_row_each(spark):
    text = " ".join(f"w{i}" for i in range(30))
    settings = resample.Settings(percent=50, cuts=3)
    docs = spark.createDataFrame([(7, text)] * 5 + [(None, text)], "doc_id long, text string")
    rows = resample.resample(docs, docs.limit(0), settings).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3]
    scores = spark.range(1000).select((F.col("id") % 10).alias("a"), F.col("id").alias("b"))
    for quota in (0, 1, 99, 100, 101, 555, 1000):
        kept = scores.where(resample.drawn(scores, ["a", "b"], quota, 4)).collect()
        assert sorted(map(tuple, kept)) == sorted((i % 10, i) for i in range(1000))[:quota]


def test_cutoff_over_the_whole_range_of_longs(spark):
    rows = spark.createDataFrame([(-(2**63),), (-5,), (0,), (0,), (2**63 - 1,)], "k long")
    assert [resample.cutoff(rows, "k", q, 15)[0] for q in range(1, 6)] == [-(2**63), -5, 0, 0, 2**63 - 1]


def test_resample_of_awkward_rows(spark, awkward, empty, clashing):
    clashing = clashing.selectExpr("*", "1 AS weight", "1 AS score", "1 AS rank", "1 AS _place")
    rows = {r["doc_id"]: r for r in resample.resample(clashing, empty).collect()}
    assert rows[2]["n_features"] == rows[2]["weight"] == rows[3]["weight"] == 0 and rows[5]["n_words"] == 6001
    assert resample.resample(empty, awkward).count() == 0
    assert resample.resample(awkward, empty).count() == awkward.count()


# Repeated word sequences -------------------------------------------------------------------


def plain_substrings(docs, length=20):
    """Per row: the words that no earlier window covers. Rows of one id and place are one occurrence."""
    first = {}
    texts = [(-math.inf if i is None else i, WORD.findall(t or "")) for i, t in docs]
    for doc_id, words in sorted(texts, key=lambda r: r[0]):
        for s in range(len(words) - length + 1):
            seq = tuple(words[s : s + length])
            first[seq] = min(first.get(seq, (doc_id, s)), (doc_id, s))
    out = []
    for (doc_id, _), (at, words) in zip(docs, texts):
        gone = set()
        for s in range(len(words) - length + 1):
            if first[tuple(words[s : s + length])] < (at, s):
                gone.update(range(s, s + length))
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def got_substrings(docs, settings=substrings.Settings()):
    rows = substrings.without_repeats(docs, settings).collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in rows), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_repeats_agree_with_all_windows(spark, seed):
    """Passages copied into other documents, edited, cut short and strung together."""
    rng = random.Random(seed)
    length = [4, 7, 20, 20][seed]
    vocabulary = [f"v{i}" for i in range([6, 30, 400, 12][seed])]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(length, 4 * length))] for _ in range(6)]
    docs = []
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 2 * length))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            words += p[a : a + rng.randint(1, len(p))] + [rng.choice(vocabulary) for _ in range(rng.randint(0, 3))]
        docs.append((rng.randint(0, 300) if i % 9 else None, rng.choice([" ", "\n", "\t "]).join(words)))
    docs = list({d[0]: d for d in docs}.values())
    docs.append(docs[0])
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    settings = substrings.Settings(length=length, gram=2 if length < 20 else 6)
    assert got_substrings(df, settings) == plain_substrings(docs, length)


def test_words_said_over_and_over(spark):
    docs = [(1, "word " * 500), (2, "word " * 30 + "end"), (3, "x " + "word " * 19), (4, "word " * 500)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got_substrings(df) == plain_substrings(docs)


def test_one_hot_passage_in_many_contexts(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    own = lambda i: " ".join(f"d{i}w{rng.randint(0, 9)}" for _ in range(25))
    docs = [(i, f"{own(i)} {passage} {own(i)}") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    assert got_substrings(df) == plain_substrings(docs)


def test_maximal_repeats_name_their_first_occurrence(spark, tmp_path):
    matches = [(2, 0, s, 1, s - 3) for s in range(10, 15)] + [(2, 0, 15, 1, 40), (2, 0, 30, 1, 27)]
    df = spark.createDataFrame(matches, "_at long, _key long, start int, to long, to_start int")
    found = substrings.maximal(df, substrings.Settings())
    assert sorted((r["start"], r["end"], r["to_start"]) for r in found.collect()) == [(10, 34, 7), (15, 35, 40), (30, 50, 27)]


def test_substrings_of_awkward_rows(spark, awkward, empty, clashing):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    expected = plain_substrings(docs)
    assert got_substrings(awkward) == expected
    assert got_substrings(clashing.selectExpr("*", "1 AS n_words", "1 AS spans", "1 AS _key", "1 AS removed")) == expected
    assert got_substrings(empty) == []


# Centroids ---------------------------------------------------------------------------------


def all_distances(vectors, centres):
    d = ((vectors[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    return d.argmin(axis=1).tolist(), d.min(axis=1).tolist()


@pytest.mark.parametrize("spread", [1, 2, 50, 2**20])
def test_threshold_algorithm_finds_the_nearest(spread):
    rng = np.random.default_rng(spread)
    for k, size in ((1, 3), (5, 1), (16, 64), (40, 7)):
        centres = rng.integers(-spread, spread + 1, (k, size))
        vectors = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (1500, size)), centres, centres + 1])
        clusters, distances = centroids.nearest(vectors, centres)
        assert (clusters.tolist(), distances.tolist()) == all_distances(vectors, centres)


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, distance long, label int")


def test_odd_vectors_are_left_out_and_ties_go_to_the_first(spark):
    nan, inf = float("nan"), float("inf")
    settings = centroids.Settings(clusters=3, size=2, scale=64, rounds=2)
    good = [(1, [0.5, -0.01]), (1, [0.5, -0.01]), (2, [0.5, -0.01]), (None, [9.0, 9.0]), (4, [-3.0, 2.0])]
    bad = [(5, None), (6, []), (7, [1.0]), (8, [1.0, None]), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [1.0, -inf]), (12, [1.0] * 3)]
    rows = centroids.cluster(vectors_of(spark, [(*r, 0, 0, 0) for r in good + bad]), settings).collect()
    assert sorted(str(r["vec_id"]) for r in rows) == ["1", "1", "2", "4", "None"]
    same = {(r["cluster"], r["distance"]) for r in rows if r["vec_id"] in (1, 2)}
    assert len(same) == 1 and {r["inertia"] for r in rows} == {sum(r["distance"] for r in rows)}
    assert centroids.whole(vectors_of(spark, [(1, [0.5, -0.01], 0, 0, 0)]), settings).first()["_v"] == [32, -1]


def test_no_vector_and_too_large_ones(spark):
    settings = centroids.Settings(clusters=3, size=2)
    assert centroids.cluster(vectors_of(spark, []), settings).collect() == []
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(vectors_of(spark, [(1, [1e30, 0.0], 0, 0, 0)]), settings)


def test_empty_centroids_stay(spark):
    settings = centroids.Settings(clusters=2, size=1, scale=1)
    numbers = spark.createDataFrame([(1, [4]), (2, [5])], "_id long, _v array<long>")
    assert centroids.moved(numbers, np.array([[4], [100]]), settings).tolist() == [[4], [100]]
    assert centroids.moved(numbers, np.array([[-4], [-9]]), settings).tolist() == [[4], [-9]]
