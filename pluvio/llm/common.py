"""Shared column helpers of the text operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.session import scratch_path

# The separators between words in the two word definitions.
SPACE_RUN = r"[\x20\x09-\x0D]+"
NON_WORD_RUN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # between words, before lower-casing
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read
    it back: later branches start from files that every executor sees, so a
    lost executor costs only its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Arrow batches of at most ``n`` rows for the jobs run inside: rows that
    carry texts or lists are wide, and a batch is held whole on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(n, int(before) if int(before) > 0 else n)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it until no column has it
    (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once inside an expression (a one-element transform), so
    that a lambda which uses it per element does not recompute it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings take the fast built-in."""
    return F.when(_is_ascii(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def text_key(text: Column) -> Column:
    """Content key of a text; a null text is an empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def space_words(text: Column) -> Column:
    """Maximal runs of characters other than space and 0x09-0x0D."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def any_case_words(text: Column) -> Column:
    """Maximal runs of digits, letters and non-ASCII characters, as they
    stand. Lower-casing A-Z, or all letters, moves no boundary, so it can
    wait until a word is looked at."""
    return F.array_remove(F.split(text, NON_WORD_RUN), "")


def positions(n: Column) -> Column:
    """Array 0..n-1; empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def words_at(words: Column, i: Column, n: int) -> list[Column]:
    """The ``n`` words from position ``i`` (null beyond the end). Single
    lookups: inside a lambda ``slice`` would copy the whole array each time."""
    return [F.get(words, i + k) for k in range(n)]


def covered(starts: Column, width: int) -> Column:
    """Number of positions inside the union of ``[s, s + width)`` over an
    ascending array of distinct starts."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end"))
    return F.aggregate(
        starts, zero,
        lambda a, s: F.struct((a["n"] + F.lit(width) - F.greatest(F.lit(0), a["end"] - s)).alias("n"),
                              (s + F.lit(width)).alias("end")),
        lambda a: a["n"])


def bounded_broadcast(small: DataFrame, limit_bytes: int = 32 << 20) -> tuple[DataFrame, bool]:
    """``small`` with a broadcast hint if its measured size is under the
    bound, else unchanged (the join then shuffles). The size is an exact sum
    over the table, not an estimate; call it on stored or tiny tables."""
    width = F.lit(32 * len(small.columns)).cast("long")
    for name, kind in small.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
        elif kind == "array<string>":
            width = width + F.coalesce(F.octet_length(F.array_join(F.col(f"`{name}`"), "")), F.lit(0)) + 16 * F.size(F.col(f"`{name}`"))
        elif kind.startswith("array"):
            width = width + 8 * F.size(F.col(f"`{name}`"))
    size = small.agg(F.sum(width)).first()[0] or 0
    return (F.broadcast(small), True) if size <= limit_bytes else (small, False)
