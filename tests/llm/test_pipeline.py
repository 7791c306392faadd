"""The pipeline and the contracted queries against plain Python on the smallest tables."""

import array
import math
import os
import re
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
import xxhash
from test_awkward import expected_spans
from tokenizers import Tokenizer

import corpus_pipeline
from siglake.llm import langid, quality, queries, secret_scan

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def counts(text):
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {j for found in windows.values() if len(found) > 1 for i in found for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    chars = sum(map(len, words))
    share = lambda part, whole: part / whole if whole else 0.0
    rates = {
        "symbol_rate": share(len(re.findall(r"[#*$%&|<>]", text)), chars),
        "capital_rate": share(len(re.findall("[A-Z]", text)), chars),
        "dup_line_rate": share(len(lines) - len(set(lines)), len(lines)),
        "repeat_rate": share(len(covered), len(words)),
        "word_length": share(chars, len(words)),
    }
    return rates, len(words) < 50 or 100 * len(covered) > 50 * len(words)


def plain_quality(docs):
    rules, kept = quality.Rules(), []
    measured = [(d, *counts(d["text"] or "")) for d in docs]
    values = defaultdict(lambda: defaultdict(list))
    for d, rates, failed in measured:
        if not failed:
            for group in ((d["lang"], d["source"]), (d["lang"],), ()):
                for rate, value in rates.items():
                    values[group][rate].append(value)

    def at(group, rate, p):
        ordered = sorted(values[group][rate])
        return ordered[math.ceil(p * len(ordered)) - 1]

    for d, rates, failed in measured:
        if failed:
            continue
        own, lang = (d["lang"], d["source"]), (d["lang"],)
        enough = lambda g: len(values[g]["word_length"]) >= rules.min_group
        group = own if enough(own) else lang if enough(lang) else ()
        good = True
        for rate, slack in rules.slack:
            low, high = at(group, rate, 0.25), at(group, rate, 0.75)
            reach = rules.whiskers * (high - low) + slack
            good &= rates[rate] <= high + reach and (rate != "word_length" or rates[rate] >= low - reach)
        if good:
            kept.append(d)
    return kept


def plain_language(docs):
    import zlib

    settings, hashed = langid.Settings(), defaultdict(dict)
    for d in docs:
        if zlib.crc32(str(d["doc_id"]).encode()) % 4 != 2 and d["lang"] and any(map(str.isalpha, d["text"])):
            h = xxhash.xxh64_intdigest(d["text"].encode(), 42)
            hashed[d["lang"]][h - (1 << 64) if h >> 63 else h] = d["text"][: settings.sample_chars]
    contents = {
        lang: langid.letters("\n".join(found[h] for h in sorted(found)[: settings.sample_docs])).encode()
        for lang, found in sorted(hashed.items())
    }
    model, kept = langid.Compressors(contents, settings), []
    for d in docs:
        sizes = sorted(model.sizes(d["text"]))
        if (sizes[1] - sizes[0]) / sizes[1] >= settings.margin:
            kept.append(d)
    return kept


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def plain_components(docs, size, percent):
    sets = {d["doc_id"]: shingles(d["text"], size) for d in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    x, y = root(i), root(j)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}, sets


def redacted(text):
    out, at = [], 0
    for start, _, _, end in expected_spans(text):
        if start >= at or not out:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_pipeline(spark, docs):
    kept = plain_language(plain_quality(docs))
    components, _ = plain_components(kept, 5, 80)
    kept = [d for d in kept if components[d["doc_id"]] == d["doc_id"]]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {
        d["doc_id"]: array.array("I", tokenizer.encode(redacted(d["text"]), add_special_tokens=False).ids + [2]).tobytes()
        for d in kept
    }
    got = defaultdict(dict)
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        got[r["doc_id"]][r["start"]] = bytes(r["ids"])
    assert {i: b"".join(x[s] for s in sorted(x)) for i, x in got.items()} == want
    assert 0 < len(want) < len(docs)


def test_near_duplicates_against_all_pairs(spark, docs):
    components, sets = plain_components(docs, 3, 85)
    for r in queries.QUERIES["op3_near_duplicates"](spark, SF_DIR).collect():
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == components[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])


def test_quality_query(spark, docs):
    kept = {d["doc_id"] for d in plain_quality(docs)}
    rows = queries.QUERIES["op6_quality"](spark, SF_DIR).collect()
    assert {r["doc_id"] for r in rows if r["kept"]} == kept
    assert {r["doc_id"]: r["base_failed"] for r in rows} == {d["doc_id"]: counts(d["text"])[1] for d in docs}


def test_held_out_accuracy(spark, docs):
    langs = {d["doc_id"]: d["lang"] for d in docs}
    out = [r for r in queries.QUERIES["op1_language_id"](spark, SF_DIR).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in out) >= 0.95 * len(out) > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_beside_its_sql(spark, name):
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
    from check_queries import connect, difference

    got = queries.QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(connect(SF_DIR).execute(queries.ORACLES[name]).df(), got) is None


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
    assert secret_scan.redacted(docs).count() == docs.count()


def test_packing_query(spark, docs):
    """Ids of the tokenizer itself; pieces of binary length, one to a sequence."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(dict)
    rows = queries.QUERIES["op4_packing"](spark, SF_DIR).collect()
    for r in rows:
        pieces[r["doc_id"]][r["start"]] = r
        assert r["offset"] == 0 and r["length"] <= 4096 and r["length"] & (r["length"] - 1) == 0
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for d in docs:
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        at = 0
        for start, r in sorted(pieces[d["doc_id"]].items()):
            assert start == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(array.array("I", ids[at : at + r["length"]]).tobytes())
            at += r["length"]
        assert at == len(ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_packing_with_other_tokenizers(spark, name):
    from siglake.llm import packing

    texts = ["It's  <b>\n\n 12 words, ÄÖ don't'll x'S", "", "a <|endoftext|> b", "tabs\t\tand   blanks  "]
    path = public_tokenizers.path(name)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = defaultdict(bytes)
    for r in packing.pack(docs, tokenizer_path=path).orderBy("doc_id", "start").collect():
        got[r["doc_id"]] += bytes(r["ids"])
    tokenizer = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        assert got[i] == array.array("I", [*tokenizer.encode(text, add_special_tokens=False).ids, 2]).tobytes(), text
