"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one ``long`` of failure bits; a policy is a versioned mask over those
bits, so applying, changing or ablating a policy never reads a text again.

Null and empty texts have no words (they fail ``few_words``); a document of
any length is one row; repeated rows are judged one by one; other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import covered, let, positions, space_words, stored, words_at

WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"
# Regular expressions of the further measurements, for words and lines.
LETTER = r"[A-Za-z]|[^\x00-\x7F]"
TWO_CAPITALS, NOT_CAPITAL = "[A-Z].*[A-Z]", r"[a-z]|[^\x00-\x7F]"
BULLET = r"\A[\x20\x09-\x0D]*[-*•]"
ELLIPSIS = r"(\.\.\.|…)[\x20\x09-\x0D]*\z"
LINE_END = r"""[.!?"'”’。！？][\x20\x09-\x0D]*\z"""
PLACEHOLDER = "[Ll][Oo][Rr][Ee][Mm] [Ii][Pp][Ss][Uu][Mm]"
SHORT_LINE = 30  # characters


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measurement columns


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]


# The place of a rule in this tuple is its bit; append only.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 5 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("letter_words", "100 * n_letter_words < 50 * n_words"),
    Rule("bullet_lines", "100 * n_bullet_lines > 90 * n_lines"),
    Rule("ellipsis_lines", "100 * n_ellipsis_lines > 30 * n_lines"),
    Rule("repeated_line_chars", "100 * dup_line_chars > 30 * line_chars"),
    Rule("placeholder", "n_placeholders > 0"),
    Rule("braces", "10 * n_braces > n_words"),
    Rule("capitals", "100 * n_capital_words > 50 * n_words"),
    Rule("line_ends", "100 * n_ended_lines < 12 * n_lines"),
    Rule("short_lines", "100 * n_short_lines > 67 * n_lines"),
)
BASE = Policy("base", 1, ("few_words", "repeated_windows"))
FULL_1 = Policy("full", 1, ("few_words", "repeated_windows", "word_length", "symbols", "repeated_lines"))
# the two rules on how lines end and how long they are suit prose only
FULL = Policy("full", 2, (*FULL_1.rules, "letter_words", "bullet_lines", "ellipsis_lines", "repeated_line_chars", "placeholder", "braces", "capitals"))
PROSE = Policy("prose", 1, tuple(r.name for r in RULES))


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(bits[n] for n in set(policy.rules))


FURTHER = ("n_letter_words", "n_capital_words", "n_bullet_lines", "n_ellipsis_lines", "n_ended_lines", "n_short_lines", "line_chars", "dup_line_chars",
           "n_braces", "n_placeholders")


def further(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Measurements of the rules on letters, kinds of lines and markers."""
    def number(of: Column, pattern: str) -> Column:
        return F.size(F.filter(of, lambda x: x.rlike(pattern)))

    def chars(of: Column) -> Column:
        return F.char_length(F.array_join(of, ""))
    capitals = F.size(F.filter(words, lambda x: x.rlike(TWO_CAPITALS) & ~x.rlike(NOT_CAPITAL)))
    return dict(zip(FURTHER, (
        number(words, LETTER), capitals, number(lines, BULLET), number(lines, ELLIPSIS), number(lines, LINE_END),
        F.size(F.filter(lines, lambda x: F.char_length(x) <= SHORT_LINE)), chars(lines), chars(lines) - chars(F.array_distinct(lines)),
        F.regexp_count(text, F.lit("[{}]")), F.regexp_count(text, F.lit(PLACEHOLDER)))))


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the counts that the rules look at.

    Repeated windows: windows of four words are hashed, and if two agree,
    windows of eight; only if two of those agree are the windows sorted and
    compared word by word with their neighbours, and the words they cover
    counted."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    d = d.select("doc_id", "text", space_words(F.col("text")).alias("words"),
                 F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"))

    def pairs(a: Column, gap: int) -> Column:  # hash of the entries i and i + gap
        return let(a, lambda v: F.transform(positions(F.size(v) - gap), lambda i: F.xxhash64(F.get(v, i), F.get(v, i + gap))))

    d = d.select(
        "doc_id", "words",
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        *[x.cast("long").alias(name) for name, x in further(F.col("text"), F.col("words"), F.col("lines")).items()],
        pairs(pairs(F.col("words"), 1), 2).alias("fours"))
    # a window of eight can only repeat where one of four does
    d = d.withColumn("hashes", F.when(F.size(F.array_distinct("fours")) < F.size("fours"), pairs(F.col("fours"), 4))).drop("fours")
    by_hash = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("sorted", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), by_hash)).drop("hashes")

    def same(k: Column, j: Column) -> Column:
        a, b = F.get("sorted", k), F.get("sorted", j)
        word_by_word = reduce(and_, [x == y for x, y in zip(words_at(F.col("words"), a["i"], WINDOW), words_at(F.col("words"), b["i"], WINDOW))])
        return F.coalesce((a["h"] == b["h"]) & word_by_word, F.lit(False))

    starts = F.sort_array(F.transform(
        F.filter(positions(F.size("sorted")), lambda k: (k > 0) & same(k, k - 1) | same(k, k + 1)),
        lambda k: F.get("sorted", k)["i"]))
    repeat = F.when(F.col("sorted").isNull(), 0).otherwise(covered(starts, WINDOW))
    return d.select("doc_id", F.col("n").cast("long").alias("n_words"), F.col("word_chars").cast("long").alias("word_chars"),
                    F.col("n_symbols").cast("long").alias("n_symbols"), F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
                    repeat.cast("long").alias("n_repeat_words"), F.col("n_lines").cast("long").alias("n_lines"), *FURTHER)


def build_ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus ``fail_bits``: bit i is set if rule i fails. Stored
    once in the shared folder (a few dozen bytes a document)."""
    m = measurements(docs, id_col, text_col)
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return stored(m.withColumn("fail_bits", bits), "rule-ledger")


def apply_policy(ledger: DataFrame, policy: Policy, out: str = "kept", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    return ledger.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0)


def ablations(ledger: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per rule of the policy: documents that it fails, that it alone
    fails, and that would be kept without it; no rows if the ledger has none.
    The ledger shrinks to its distinct bit patterns before anything is
    exploded."""
    m = mask(policy, rules)
    patterns = ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    table = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
                                for i, r in enumerate(rules) if r.name in policy.rules]))
    p = patterns.select("bits", "n", table.alias("r")).select("bits", "n", "r.*")
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return p.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(F.col("bits") == F.col("bit")).alias("n_only"),
        total(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"),
    ).withColumns({"policy": F.lit(policy.name), "version": F.lit(policy.version)})
