"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document. The ledger keeps the measurements and one integer with a
bit for each rule that failed. A policy is a versioned set of rules, a mask; applying it, changing it or
asking what each of its rules costs needs only the stored bits, never the text. Ablations are computed on
the counts of distinct bit patterns: at most 2 ** (number of rules) rows, whatever the corpus size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.llm.text import WORD_BREAKS
from txnscope.session import scratch_path

WINDOW = 5
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``fails``: SQL condition over the measurements. The position in RULES is the rule's bit."""

    name: str
    fails: str


RULES = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols_to_words", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("mean_word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    Rule("capitals", "100 * n_capitals > 30 * word_chars"),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}
#: Policies by version: the rules whose failure rejects a document. Published versions stay as they are.
POLICIES = {
    "base": BIT["too_few_words"] | BIT["repeated_windows"],
    "v1": sum(BIT.values()),
}
CURRENT = "v1"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


def measure(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``row`` (a struct of the carried columns) and the measurements of the whole text, as bigints.

    n_words, word_chars (code points in words), n_symbols, n_lines (with a word), n_dup_lines (equal to an
    earlier line), n_repeat_words (words in repeated windows, first occurrence included), n_capitals.
    Null texts count as empty: all zero.
    """
    symbols = "[^" + "".join("\\" + c for c in SYMBOLS) + "]+"
    d = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select(
        "row",
        # split() leaves an empty string before leading and after trailing white space
        F.array_remove(F.split("text", WORD_BREAKS), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.char_length(F.regexp_replace("text", symbols, "")).cast("bigint").alias("n_symbols"),
        F.char_length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("bigint").alias("n_capitals"),
    )
    d = d.select(
        "row",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_capitals",
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    kept = ["row", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_capitals"]
    later = ", ".join(f"get(h, i + {k})" for k in range(1, WINDOW))
    d = d.select(
        *kept,
        "words",
        # one hash per window; those that would run over the end are cut off
        F.expr(f"slice(transform(h, (x, i) -> xxhash64(x, {later})), 1, greatest(size(h) - {WINDOW - 1}, 0))").alias("g"),
    )
    # Equal windows have equal hashes, so distinct hashes settle most texts. In the others one sort brings
    # equal hashes together, and a window counts if it equals a neighbour word for word.
    d = d.withColumn(
        "placed",
        F.expr("IF(size(array_distinct(g)) < size(g), sort_array(transform(g, (x, i) -> struct(x AS g, i AS i))), NULL)"),
    )
    same = f"x.g <=> get(placed, k {{0}}).g AND slice(words, x.i + 1, {WINDOW}) = slice(words, get(placed, k {{0}}).i + 1, {WINDOW})"
    d = d.withColumn(
        "at",
        F.expr(f"sort_array(transform(filter(placed, (x, k) -> ({same.format('- 1')}) OR ({same.format('+ 1')})), x -> x.i))"),
    )
    covered = F.expr(
        f"""aggregate(at, named_struct('words', 0, 'next', 0),
                (s, i) -> named_struct('words', s.words + i + {WINDOW} - greatest(i, s.next), 'next', i + {WINDOW}),
                s -> s.words)"""
    )
    return d.select(*kept, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def ledger(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The measurements and ``fail_bits``: bit i is set if rule i fails. Every rule is evaluated once."""
    bits = "CAST(" + " | ".join(f"IF({r.fails}, {BIT[r.name]}, 0)" for r in RULES) + " AS BIGINT)"
    return measure(docs, carry).withColumn("fail_bits", F.expr(bits))


def rejects(mask: int, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask)) != 0


def ablations(led: DataFrame, mask: int) -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it rejects, and kept without it."""
    counts = led.groupBy("fail_bits").agg(F.count("*").alias("n"))
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask))
    rows = []
    for rule in RULES:
        bit = BIT[rule.name]
        if mask & bit:
            rows += [
                F.sum(F.when(failed.bitwiseAND(F.lit(bit)) != 0, F.col("n")).otherwise(0)).alias(f"{rule.name}_fails"),
                F.sum(F.when(failed == bit, F.col("n")).otherwise(0)).alias(f"{rule.name}_only"),
                F.sum(F.when(failed.bitwiseAND(F.lit(~bit)) == 0, F.col("n")).otherwise(0)).alias(f"{rule.name}_kept"),
            ]
    wide = counts.agg(*rows)
    names = [r.name for r in RULES if mask & BIT[r.name]]
    parts = ", ".join(f"'{n}', {n}_fails, {n}_only, {n}_kept" for n in names)
    return wide.select(F.expr(f"stack({len(names)}, {parts}) AS (rule, n_failing, n_only_this, n_kept_without)"))


def policy(version: str) -> int:
    """The mask of a policy; the base rules always belong to it."""
    return POLICIES["base"] | POLICIES[version]


def stored_ledger(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The ledger as a table in the shared folder.

    Read back, its bits and measurements are columns to filter by. Without the table, the optimizer would push a
    filter below the measurements and evaluate these once more for every use.
    """
    path = scratch_path(docs.sparkSession, "ledger")
    ledger(docs, carry).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def verdicts(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """One row per row of the table: doc_id, the ledger, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the first rule. Repeated rows each get a row.
    """
    return stored_ledger(docs, ["doc_id"]).select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"),
        *MEASURES,
        "fail_bits",
        rejects(POLICIES["base"]).alias("base_failed"),
        (~rejects(policy(version))).alias("kept"),
    )


def kept_documents(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The rows that the policy keeps, with all their columns unchanged."""
    return stored_ledger(docs, docs.columns).where(~rejects(policy(version))).select("row.*")
