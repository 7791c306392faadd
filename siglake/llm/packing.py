"""Packing by powers of two: pieces of binary length, each a sequence of its own.

A document of n tokens becomes n // max_length pieces of max_length tokens and one
piece for each binary digit of the rest, longest first. Pieces of one length form a
bucket, from which batches of that length are drawn; so no sequence crosses
documents and none is padded.

Words are encoded once per worker process and kept in a bounded table: white space ends
every token of the tokenizer, so a text's ids are those of its words in order. Texts of
tokenizers of another kind are encoded as a whole.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
MAX_LENGTH = 4096
# Words kept by a worker process, about 150 bytes each. A full table starts anew.
KEPT_WORDS = 1_000_000
# Bytes of ids after which a task hands on what it has.
BLOCK_BYTES = 4 << 20

_TAIL = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~|"


# The steps before the model of tokenizers whose words can be encoded one by one.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


def takes_words(tokenizer: Tokenizer) -> bool:
    """Whether the ids of a text are those of its words, and those of a word as ``WordIds`` finds them."""
    told = json.loads(tokenizer.to_str())
    normalizer, split = told["normalizer"] or {}, told["pre_tokenizer"] or {}
    first = (split.get("pretokenizers") or [{}])[0]
    return (
        normalizer.get("normalizers") == _NORMALIZER
        and (first.get("pattern"), first.get("invert")) == (_SPLIT, True)
        and told["model"].get("end_of_word_suffix") is not None
    )


class WordIds(dict):
    """Ids of words as little-endian bytes of 32-bit numbers, encoded on first use."""

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kept = kept
        if not takes_words(self.tokenizer):
            self.of_text = lambda text: _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.kept:
            self.clear()
        found = self[word] = self._encoded(word)
        return found

    def _encoded(self, word: bytes) -> bytes:
        # Letters end before a run of punctuation, except after an apostrophe or in a special token.
        if not (b"'" in word or b"<" in word or b">" in word):
            lower = word.lower()
            stem = lower.rstrip(_TAIL)
            if stem != lower and stem and (stem.isalpha() or stem.decode()[-1].isalpha()):
                return self[stem] + self[lower[len(stem):]]
            if lower.isalpha():
                return _packed(token.id for token in self.model.tokenize(lower.decode()))
            if lower != word:
                return self[lower]
        return _packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    def of_text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split()))


def _packed(ids) -> bytes:
    packed = array("I", ids)
    if packed.itemsize != 4:
        raise RuntimeError("array type I must have four bytes")
    return packed.tobytes()


_TABLES: dict[tuple[str, int], WordIds] = {}


def word_ids(path: str, kept: int = KEPT_WORDS) -> WordIds:
    """The table of a tokenizer, which all tasks of a worker process share."""
    if (path, kept) not in _TABLES:
        _TABLES.clear()
        _TABLES[path, kept] = WordIds(path, kept)
    return _TABLES[path, kept]


def binary_lengths(n: int, max_length: int) -> Iterator[int]:
    """Powers of two that sum to n, none over max_length, longest first."""
    for _ in range(n // max_length):
        yield max_length
    rest, power = n % max_length, max_length
    while rest:
        power >>= 1
        if rest >= power:
            rest -= power
            yield power


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    max_length: int = MAX_LENGTH,
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """Cut every document into sequences whose lengths are powers of two.

    One row per piece: the id column, ``start`` (the document's tokens before it),
    ``length``, ``ids`` (binary, little-endian unsigned 32-bit), ``doc_tokens``,
    ``bucket`` (the length's binary logarithm), ``sequence_id`` and ``offset`` (0, as
    a sequence is one piece). A missing or empty text is the end id alone. Rows with
    a missing or repeated id are packed like any other row. Other columns are not
    read. No row is moved between tasks; memory holds one text and its ids.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    fields = [("_start", pa.int64()), ("_length", pa.int64()), ("_ids", pa.binary()), ("_tokens", pa.int64())]
    schema = pa.schema([("_id", id_type), *fields])
    end = _packed([end_id])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path, kept_words)
        for batch in batches:
            rows, columns, size = [], [[], [], [], []], 0
            for row, text in enumerate(batch.column(1)):
                ids = words.of_text(text.as_py() or "") + end
                tokens, start = len(ids) // 4, 0
                for length in binary_lengths(tokens, max_length):
                    rows.append(row)
                    piece = (start, length, ids[4 * start : 4 * (start + length)], tokens)
                    for column, value in zip(columns, piece):
                        column.append(value)
                    start += length
                    size += 4 * length
                    if size >= BLOCK_BYTES:
                        yield _block(batch, rows, columns, schema)
                        rows, columns, size = [], [[], [], [], []], 0
            if rows:
                yield _block(batch, rows, columns, schema)

    spark_schema = T.StructType(
        [
            T.StructField("_id", docs.schema[id_col].dataType),
            T.StructField("_start", T.LongType()),
            T.StructField("_length", T.LongType()),
            T.StructField("_ids", T.BinaryType()),
            T.StructField("_tokens", T.LongType()),
        ]
    )
    pieces = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, spark_schema)
    return pieces.select(
        F.col("_id").alias(id_col),
        F.col("_start").alias("start"),
        F.col("_length").alias("length"),
        F.col("_ids").alias("ids"),
        F.col("_tokens").alias("doc_tokens"),
        F.round(F.log2("_length")).cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def _block(batch: pa.RecordBatch, rows: list, columns: list, schema: pa.Schema) -> pa.RecordBatch:
    ids = batch.column(0).take(pa.array(rows, pa.int64()))
    return pa.record_batch(
        [ids.cast(schema.field(0).type), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema
    )


def ids_crc32(ids: Column) -> Column:
    return F.crc32(ids)
