"""Shared helpers of the text operators: table access, byte-level symbols, text splitting.

Every operator starts from :func:`documents`, which keeps the two columns that it needs. Extra
columns of the input, whatever their names, therefore cannot clash with a result column.
"""

from __future__ import annotations

import re
import tempfile
import unicodedata
import zipfile
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20

#: Words of the contracts: runs of characters other than space and \t \n \v \f \r.
WORD_BREAKS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Give the session's Python workers this package, once, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_txnscope_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="txnscope-code-")) / "txnscope_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))
    # batches sent to Python are cut by their bytes, so that long texts do not fill workers' memory
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc._txnscope_shipped = True


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` (bigint) and ``text`` (string, null becomes the empty string)."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def shuffle_width(spark: SparkSession) -> int:
    """Buckets for work dealt out by hand: the session's shuffle partitions, set by its user."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_blocks(batch: pa.RecordBatch, column: int, max_chars: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows with about ``max_chars`` characters at a time."""
    values, first, block, size = batch.column(column), 0, [], 0
    for i in range(len(values)):
        text = values[i].as_py()
        block.append(text)
        size += len(text)
        if size >= max_chars:
            yield first, block
            first, block, size = i + 1, [], 0
    if block:
        yield first, block


#: Common characters: up to Latin Extended-B, and general punctuation. Their categories, cases and
#: compositions are the same in every Unicode version, so Python's tables serve. Texts with other
#: characters are split by the tokenizer library's own tables.
COMMON = "\\x00-\\u024f\\u2000-\\u206f"


@cache
def rare_characters() -> re.Pattern:
    return re.compile(f"[^{COMMON}]")


@cache
def category_class(major: str) -> str:
    """Character-class body with the common characters of a Unicode major category (L, N)."""
    common = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070)]]
    return "".join(re.escape(c) for c in common if unicodedata.category(c)[0] == major)


#: The Unicode White_Space characters among the common ones.
UNICODE_SPACE = "\\t-\\r \\x85\\xa0\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f"
#: The contraction endings that the byte-level tokenizers split off.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: The two tokenizers' splitting patterns over all of Unicode.
LOWER_WORDS = CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACED_WORDS = CONTRACTIONS + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def lower_word_pattern() -> re.Pattern:
    """Words of the lower-casing tokenizer: contractions, letter runs, single digits, rest runs."""
    letter, number, space = category_class("L"), category_class("N"), UNICODE_SPACE
    return re.compile(f"[{letter}]+|'(?:s|t|re|ve|m|ll|d)|[{number}]|[^{space}{letter}{number}]+")


@cache
def spaced_word_pattern() -> re.Pattern:
    """Pieces of the byte-level tokenizer: words with one leading space, and space runs."""
    letter, number, space = category_class("L"), category_class("N"), UNICODE_SPACE
    return re.compile(
        f" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?[{number}]+| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


@cache
def _library_split(lower: bool):
    from tokenizers import Regex, normalizers, pre_tokenizers

    norm = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]) if lower else None
    pattern = LOWER_WORDS if lower else SPACED_WORDS
    return norm, pre_tokenizers.Split(Regex(pattern), "removed", invert=True)


def rare_lower_words(text: str) -> list[str]:
    norm, split = _library_split(True)
    return [w for w, _ in split.pre_tokenize_str(norm.normalize_str(text))]


def rare_spaced_words(text: str) -> list[str]:
    return [w for w, _ in _library_split(False)[1].pre_tokenize_str(text)]


@cache
def byte_symbols() -> tuple[str, ...]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code points from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return tuple(chr(b if b in printable else next(spare)) for b in range(256))
