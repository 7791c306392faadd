"""One registered query for each operator, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.llm import (
    centroids,
    fingerprint,
    html_extract,
    langid,
    lattice,
    license_scan,
    near_dup,
    packing,
    quality,
    resample,
    secret_scan,
    substrings,
    token_count,
)
from siglake.llm.common import table
from siglake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        query.__name__, query.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = query
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def secret_scan_sql() -> str:
    """The rules over every row's text, without a ledger."""
    literal = lambda text: "'" + text.replace("'", "''") + "'"
    rules = " UNION ALL ".join(
        f"SELECT doc_id, {rank} AS rank, {literal(r.kind)} AS kind, {r.least} AS least, {r.base} AS base,"
        f" regexp_extract_all(t, {literal(r.pattern)}, 0) AS whole,"
        f" regexp_extract_all(t, {literal(r.pattern)}, {r.group}) AS vals,"
        f" string_split_regex(t, {literal(r.pattern)}) AS gaps FROM texts"
        for rank, r in enumerate(secret_scan.RULES)
    )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
matches AS (SELECT * FROM ({rules}) WHERE len(whole) > 0),
placed AS (
  SELECT doc_id, rank, kind, least, base, length(vals[i]) AS n, length(whole[i]) AS w,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM matches)
),
found AS (
  SELECT doc_id, rank, kind, base, s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + w AS BIGINT) AS item
  FROM placed WHERE n >= least
),
grouped AS (
  SELECT doc_id,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(item, ',' ORDER BY s, rank) FILTER (base) AS base_items,
    string_agg(item, ',' ORDER BY s, rank) AS spans
  FROM found GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_items, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN grouped g ON t.doc_id IS NOT DISTINCT FROM g.doc_id
"""


@register()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of power-of-two length."""
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        packing.ids_crc32(F.col("ids")).alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@register()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality.judge(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select("doc_id", "quality.*")


@register(secret_scan_sql())
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, joined back from the ledger of its distinct texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.findings(docs, secret_scan.scan(docs))
    base = [rule.kind for rule in secret_scan.RULES if rule.base]
    count = lambda kind: F.size(secret_scan.of_kinds(F.col("spans"), [kind])).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.listed(secret_scan.of_kinds(F.col("spans"), base)), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


@register()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of the documents is kept from learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.held_out(F.col("doc_id"))
    learnt = langid.dictionaries(docs.where(~out))
    return langid.predict(docs.drop("lang"), learnt).select("doc_id", out.alias("held_out"), "language.*")


@register()
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, on three words at 85 percent."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@register()
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    found = fingerprint.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint.spelled(F.col("cells")).alias("fingerprint"),
        fingerprint.spelled(F.col("edited_cells")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@register()
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register()
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and whether they spell its text again."""
    docs = table(spark, sf_dir, "documents")
    encoded = lattice.encode(docs)
    decoded = lattice.decode(encoded)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("text_sha256"),
    )


@register()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs).select("doc_id", "n_tokens")


def license_scan_sql() -> str:
    """Every line and whole text against every template."""
    literal = lambda text: "'" + text.replace("'", "''") + "'"
    templates = ", ".join(f"({literal(a)}, {literal(b)})" for a, b in license_scan.TEMPLATES)
    words = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+(?:\.\p{{N}}+)*')"
    pairs = (
        "CASE WHEN len({0}) >= 2 THEN list_distinct(list_transform(range(1, len({0})),"
        " lambda i: {0}[i] || ' ' || {0}[i + 1])) ELSE {0} END"
    )
    return f"""
WITH templates AS (
  SELECT license, {pairs.format("w")} AS tb
  FROM (SELECT license, {words.format("t")} AS w FROM (VALUES {templates}) v(license, t))
),
lines AS (
  SELECT doc_id, unnest(list_concat([coalesce(text, '')], string_split(coalesce(text, ''), chr(10)))) AS line,
    generate_subscripts(list_concat([coalesce(text, '')], string_split(coalesce(text, ''), chr(10))), 1) - 1 AS n
  FROM documents
),
bigrams AS (SELECT doc_id, n, {pairs.format("w")} AS b FROM (SELECT doc_id, n, {words.format("line")} AS w FROM lines)),
scored AS (
  SELECT doc_id, n, license, max(2.0 * len(list_intersect(b, tb)) / (len(b) + len(tb))) AS dice
  FROM bigrams JOIN templates
    ON len(b) * {2 - license_scan.LEAST} >= len(tb) * {license_scan.LEAST} - 1e-9
    AND len(tb) * {2 - license_scan.LEAST} >= len(b) * {license_scan.LEAST} - 1e-9 AND len(b) > 0
  GROUP BY doc_id, n, license HAVING max(2.0 * len(list_intersect(b, tb)) / (len(b) + len(tb))) >= {license_scan.LEAST}
),
grouped AS (
  SELECT doc_id, string_agg(license || ':' || n, ',' ORDER BY license, n) AS licenses,
    first(license ORDER BY dice DESC, license) AS best, CAST(count(*) AS BIGINT) AS n_matches, round(max(dice), 6) AS dice
  FROM scored GROUP BY doc_id
)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, best, coalesce(n_matches, 0) AS n_matches, coalesce(dice, 0.0) AS dice
FROM documents d LEFT JOIN grouped g ON d.doc_id = g.doc_id
"""


@register(license_scan_sql())
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document: licence and line, the closest licence and its coefficient."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs)
    listed = F.transform("licenses", lambda s: F.concat_ws(":", s["license"], s["line"]))
    return found.select(
        "doc_id",
        F.array_join(listed, ",").alias("licenses"),
        license_scan.best(F.col("licenses")).alias("best"),
        F.size("licenses").cast("long").alias("n_matches"),
        F.round(F.coalesce(F.array_max(F.transform("licenses", lambda s: s["dice"])), F.lit(0.0)), 6).alias("dice"),
    )


@register()
def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents most like the benchmark, five of a hundred, drawn with Gumbel numbers."""
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


SUBSTRINGS_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS seq
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words)
),
later AS (
  SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) > 1
),
covered AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later),
single AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM single ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept ON words.doc_id = kept.doc_id
"""


@register(SUBSTRINGS_SQL)
def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document, less those in windows of twenty words that occurred before."""
    found = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def centroids_sql(settings: centroids.Settings = centroids.Settings()) -> str:
    """The rounds written out, with all distances."""
    size = settings.size
    distance = f"list_sum(list_transform(range(1, {size + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    steps = []
    for turn in range(settings.rounds + 1):
        steps.append(f"""
a{turn} AS (
  SELECT r, k, CAST(d AS BIGINT) AS distance FROM (SELECT r, k, {distance} AS d FROM kept, c{turn})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1
)""")
        steps.append(f"""
c{turn + 1} AS (
  SELECT k, coalesce(m, c) AS c FROM c{turn} LEFT JOIN (
    SELECT k, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS m
    FROM (SELECT k, i, sum(x) AS s, count(*) AS n
      FROM (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept) JOIN a{turn} USING (r) GROUP BY k, i)
    GROUP BY k) USING (k)
)""")
    last = settings.rounds
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({settings.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size} AND len(embedding) = {size}
),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{settings.seed}:' || vec_id), v) - 1 AS k, v AS c
  FROM kept QUALIFY k < {settings.clusters}
),{",".join(steps[:-1])}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN c{last} USING (k)
"""


@register(centroids_sql())
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its cluster after three rounds."""
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))
