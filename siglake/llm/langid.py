"""Language identification by compression.

Each language has a raw-content zstandard dictionary of texts in it. A text is cut
into blocks, each block is compressed with every dictionary, and the language with
the smallest total is chosen; a narrow margin means that the text is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siglake.llm.common import unused

UNKNOWN = "und"

# Only letters tell languages apart; capitals, digits and symbols cost all of them alike.
_OTHERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    return _OTHERS.sub(" ", text.lower())


@dataclass(frozen=True)
class Settings:
    """sample_docs, sample_chars: the bounded sample of labelled rows that makes up a
    language's dictionary, so many texts with so many characters of each at most.
    block_bytes: texts are compressed in blocks of this size, so that the dictionary
    matters for the last one as for the first. margin: the runner-up has to be larger
    by this share, or the text is rejected."""

    sample_docs: int = 256
    sample_chars: int = 400
    block_bytes: int = 4096
    level: int = 6
    margin: float = 0.01


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: the CRC-32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def dictionaries(
    labelled: DataFrame, settings: Settings = Settings(), text_col: str = "text", lang_col: str = "lang"
) -> dict[str, bytes]:
    """The dictionary of each language, from the texts with the lowest hashes.

    Rows without a language or a letter teach nothing; copies of a text count once.
    What reaches the driver is bounded by languages x sample_docs x sample_chars.
    """
    hashed = labelled.where(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
    ).select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    first = Window.partitionBy("lang").orderBy("h")
    # Each task sends on its lowest rows only, so no language meets in one task as a whole.
    lowest = (
        hashed.select("lang", "h")
        .withColumn("rank", F.dense_rank().over(first))
        .where(F.col("rank") <= settings.sample_docs)
    )
    limits = {r["lang"]: r["h"] for r in lowest.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    if not limits:
        return {}
    limit = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])
    rows = (
        hashed.where(F.col("h") <= F.element_at(limit, F.col("lang")))
        .groupBy("lang", "h")
        .agg(F.min(F.substring("text", 1, settings.sample_chars)).alias("text"))
        .collect()
    )
    texts: dict[str, list] = {lang: [] for lang in sorted(limits)}
    for row in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        texts[row["lang"]].append(row["text"])
    return {lang: letters("\n".join(found)).encode() for lang, found in texts.items()}


class Compressors:
    """Compressed sizes of a text by language."""

    def __init__(self, dictionaries: dict[str, bytes], settings: Settings):
        self.block, self.langs, self.compress = settings.block_bytes, [], []
        for lang, content in dictionaries.items():
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=settings.level)
            compressor = zstandard.ZstdCompressor(
                level=settings.level, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False
            )
            self.langs.append(lang)
            self.compress.append(compressor.compress)

    def sizes(self, text: str) -> list[int]:
        data = memoryview(letters(text).encode())
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(compress(block)) for block in blocks) for compress in self.compress]


def predict(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    settings: Settings = Settings(),
    text_col: str = "text",
    name: str = "language",
) -> DataFrame:
    """All rows and columns of ``docs`` and the struct column ``name``.

    It has ``lang_pred``, ``score`` (share by which the runner-up is larger, 0 to 1)
    and ``accepted`` (the margin is wide enough). A text without a letter, or a missing
    one, is ``und`` with score 0 and not accepted; so is every text if nothing was
    learnt. Of equal sizes the language first in order wins, with score 0. With one
    language the score is 1. A column ``name`` is replaced; others pass unread. Rows
    stay in their task; memory holds one text.
    """
    rest = docs.drop(name)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Compressors(dictionaries, settings)
        for texts in batches:
            yield pd.DataFrame(
                [_choice(model, t, settings) for t in texts], columns=["lang_pred", "score", "accepted"]
            )

    return rest.withColumn(name, guess(F.col(text_col)))


def _choice(model: Compressors, text: str | None, settings: Settings) -> tuple[str, float, bool]:
    if not text or not model.langs or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, False
    sizes = model.sizes(text)
    if len(sizes) == 1:
        return model.langs[0], 1.0, True
    best, second = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))[:2]
    score = (sizes[second] - sizes[best]) / sizes[second]
    return model.langs[best], score, score >= settings.margin


def accepted(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows whose language is recognised with a wide margin, with the columns of ``docs``.

    Learns from the rows of ``docs`` that are not held out.
    """
    name = unused("_language", docs)
    learnt = dictionaries(docs.where(~held_out(F.col(id_col))), settings, text_col, lang_col)
    return predict(docs, learnt, settings, text_col, name).where(F.col(name)["accepted"]).drop(name)
