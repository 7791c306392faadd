"""Near-copies of one text, edited further apart than the threshold: the join on differences beside all pairs."""

import random

import numpy as np
import pytest

from siglake.llm import near_dup
from siglake.session import BATCH_BYTES, Steps


def joined(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def family(rng, base, members, most):
    """Copies with random items replaced by their own, dropped, or replaced by what others use too."""
    out = []
    for _ in range(members):
        kept = set(base)
        for item in rng.sample(sorted(base), rng.randint(0, most)):
            kept.discard(item)
            kind = rng.random()
            if kind < 0.5:
                kept.add(rng.getrandbits(40))
            elif kind < 0.7:
                kept.add(item + 10**15)
        out.append(frozenset(kept))
        if rng.random() < 0.3:  # a near copy of the copy
            out.append(frozenset((kept - {min(kept)}) | {rng.getrandbits(40)}))
    return out


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("seed", [1, 2])
def test_differences_find_all_links(spark, tmp_path, percent, seed):
    rng = random.Random(seed)
    sizes = [12, 40, 150]
    sets, families = {}, {}
    for number, size in enumerate(sizes):
        for s in family(rng, [rng.getrandbits(40) for _ in range(size)], 60, size // 2):
            node = len(sets).to_bytes(16, "big")
            sets[node], families[node] = s, bytes([number])
    for s in (frozenset([1]), frozenset([1, 2]), frozenset(range(50, 90)), frozenset(range(53, 93))):  # nothing in common with most
        node = len(sets).to_bytes(16, "big")
        sets[node], families[node] = s, bytes([2])
    component = {n: n if rng.random() < 0.9 else families[n] for n in sets}
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    everything = [
        (a, b) for a in sets for b in sets
        if a < b and families[a] == families[b] and (linked(a, b) or component[a] == component[b])
    ]
    rows = [(n, len(s), near_dup.registers(np.array(sorted(s), np.uint64)).tobytes(), sorted(s)) for n, s in sets.items()]
    table = spark.createDataFrame(rows, "node binary, n long, signature binary, items array<long>")
    nodes = spark.createDataFrame([(n, component[n], families[n]) for n in sets], "node binary, component binary, family binary")
    settings = near_dup.Settings(percent=percent)
    steps = Steps(spark, "test")
    got = [(bytes(r["a"]), bytes(r["b"])) for r in near_dup.sharing_differences(nodes, table, settings, steps).collect()]
    assert all(families[a] == families[b] and component[a] != component[b] for a, b in got)
    known = [(a, b) for a in sets for b in sets if a < b and component[a] == component[b] and families[a] == families[b]]
    assert joined([p for p in got if linked(*p)] + known, sets) == joined(everything, sets)


def test_a_crowd_of_far_copies_makes_few_pairs(spark):
    """Each pair of copies shares most of the text, and hardly any two are linked."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(600):
        words = list(base)
        for at in rng.sample(range(150), 12):
            words[at] = f"e{rng.randint(0, 400)}"
        docs.append((i, " ".join(words)))
        if i % 50 == 0:
            docs.append((10_000 + i, " ".join([*words[:-1], "z"])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counts, whole = [], near_dup.sharing_differences

    def counted(*arguments):
        pairs = whole(*arguments)
        counts.append(pairs.count())
        return pairs

    try:
        near_dup.sharing_differences = counted
        got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(df).select("doc_id", "component_id").collect()}
    finally:
        near_dup.sharing_differences = whole
    assert all(got[10_000 + i] == got[i] for i in range(0, 600, 50))
    assert counts and max(counts) < 10 * len(docs)  # of 186,966 pairs


def test_pairs_that_share_too_few_items_are_not_compared(spark):
    """Copies whose edits come from one small pool: any two share some, hardly any two are linked."""
    rng = random.Random(5)
    base, pool = [rng.getrandbits(40) for _ in range(150)], [rng.getrandbits(40) for _ in range(120)]
    sets = {i.to_bytes(16, "big"): frozenset(rng.sample(base, 128)) | frozenset(rng.sample(pool, 22)) for i in range(300)}
    for i in range(0, 300, 30):
        sets[(1000 + i).to_bytes(16, "big")] = frozenset(sorted(sets[i.to_bytes(16, "big")])[:-8]) | {10**15 + i}
    rows = [(n, len(s), near_dup.registers(np.array(sorted(s), np.uint64)).tobytes(), sorted(s)) for n, s in sets.items()]
    table = spark.createDataFrame(rows, "node binary, n long, signature binary, items array<long>")
    nodes = spark.createDataFrame([(n, n, b"f") for n in sets], "node binary, component binary, family binary")
    found = near_dup.sharing_differences(nodes, table, near_dup.CORPUS, Steps(spark, "test")).collect()
    got = {(bytes(r["a"]), bytes(r["b"])) for r in found}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(links) >= 10 and links <= got
    assert len(got) < 3_000  # of 47,895 pairs


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    """Thousands of texts of one task are not held by one batch, and the session's setting comes back."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(setting), set()
    write = Steps.write
    monkeypatch.setattr(Steps, "write", lambda self, df, name: seen.add(spark.conf.get(setting)) or write(self, df, name))
    texts = [(i, " ".join(f"w{i // 2}x{j}" for j in range(40))) for i in range(6)]
    docs = spark.createDataFrame([*texts, (6, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert found == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4, 6: 6}
    assert seen == {str(BATCH_BYTES)} and spark.conf.get(setting) == before
