"""Benchmark decontamination by a prefix-filtered set join.

The windows of an item (13 consecutive words; all its words if fewer) must be
contained whole in a document. A contained window has all its tokens there,
so its single rarest token (rarity: occurrences over all documents) is a
sufficient prefix: document words are joined with that one token per distinct
window, the token's offset fixes the only possible place, length and position
bounds drop what would stick out, and the surviving places are verified word
by word. Tokens are joined by their full lower case, which is fast and finds
a superset; the words verified are those with A-Z lowered.

Null and empty texts have no words and no hits; items without words have no
windows; equal windows are joined once and mapped to all their items; equal
items each count; item ids keep their type; texts are judged whole at any
length; repeated rows are judged once and written as often as they occur;
empty tables give no rows (no items: no hits); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import any_case_words, ascii_lower, bounded_broadcast, positions, stored, text_key

WIDTH = 13  # fixed value: words of a window
MAX_BITS = 1 << 22  # of the token bitmap (512 KB); 64 bits a prefix token below that


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (window words, items)."""
    d = items.select(F.col(id_col).alias("item_id"), any_case_words(F.coalesce(F.col(text_col), F.lit(""))).alias("w")).where(F.size("w") > 0)
    d = d.select("item_id", F.transform("w", ascii_lower).alias("w"), F.size("w").alias("n"))
    d = d.select("item_id", "w", "n")
    d = d.select("item_id", F.explode(F.transform(positions(F.greatest(F.col("n") - (WIDTH - 1), F.lit(1))),
                                                  lambda i: F.slice("w", i + 1, WIDTH))).alias("win"))
    return d.groupBy("win").agg(F.collect_set("item_id").alias("items"))


def tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), any_case_words(F.coalesce(F.col(text_col), F.lit(""))).alias("w"))


def with_prefix(windows: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add each window's rarest token and its offset there. The count runs
    over every word of every document, summed map-side; only words that occur
    in a window are kept."""
    vocab, small = bounded_broadcast(windows.select(F.explode("win").alias("token")).select(F.lower("token").alias("token")).distinct())
    words = tokens(docs, id_col, text_col).select(F.explode("w").alias("token")).select(F.lower("token").alias("token"))
    if small:
        words = words.join(vocab, "token", "left_semi")
    freq = words.groupBy("token").agg(F.count("*").alias("df"))
    if not small:  # the vocabulary is shuffled, so the words are summed up first
        freq = freq.join(vocab, "token", "left_semi")
    each = windows.select("win_id", F.posexplode("win").alias("off", "token")).withColumn("token", F.lower("token")).join(freq, "token", "left")
    rarest = each.groupBy("win_id").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token", "off")).alias("r"))
    return windows.join(rarest, "win_id").select("win_id", "win", "items", F.col("r.token").alias("token"), F.col("r.off").alias("off"),
                                                 F.size("win").alias("len"), F.col("r.df").alias("df")).where("df > 0")


def maybe_prefix(prefixes: DataFrame) -> Callable[[Column], Column]:
    """Test of a token that is true for every prefix token and by chance for
    others (one in a thousand at 64 bits a token). The bitmap is summed up in
    Spark; the driver gets at most MAX_BITS / 64 numbers, whatever the number
    of tokens, and the plan carries them as one array."""
    known = prefixes.select("token").distinct()
    bits = min(1 << 12, MAX_BITS)
    n = known.count()
    while bits < min(64 * n, MAX_BITS):
        bits *= 2

    def places(token: Column) -> list[Column]:  # two places of a token
        h = F.xxhash64(token)
        return [F.pmod(h, F.lit(bits)).cast("int"), F.pmod(F.shiftrightunsigned(h, 32), F.lit(bits)).cast("int")]

    def word(place: Column) -> Column:
        return F.shiftright(place, 6)

    def bit(place: Column) -> Column:
        return place.bitwiseAND(F.lit(63))
    each = known.select(F.explode(F.array(*places(F.col("token")))).alias("p"))
    each = each.select(word(F.col("p")).alias("word"), F.expr("shiftleft(1L, p & 63)").alias("mask"))
    held = dict(each.groupBy("word").agg(F.bit_or("mask")).collect())
    bitmap = F.split(F.lit(",".join(str(held.get(i, 0)) for i in range(bits // 64))), ",").cast("array<bigint>")

    def test(token: Column) -> Column:
        first, second = places(token)
        return (F.getbit(F.get(bitmap, word(first)), bit(first)) == 1) & (F.getbit(F.get(bitmap, word(second)), bit(second)) == 1)
    return test


def occurrences(docs: DataFrame, prefixes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, start, len, items): places where a window stands
    whole, and for every document row one end row (start = number of words,
    len 0).

    A document word that is some window's prefix token carries the words
    around it that a window through it could need, so verification needs no
    second join and no text is shuffled. Words are tested inside the row
    first (``maybe_prefix``); the few that pass by chance meet nothing in the
    join. The end row meets the empty window on the empty token, which is no
    word; in a join that shuffles it goes round the join instead, as all
    documents would meet on that token."""
    spark, none = docs.sparkSession, F.array().cast(prefixes.schema["items"].dataType)
    end = spark.range(1).select(F.lit("").alias("token"), F.lit(0).alias("off"), F.lit(0).alias("len"),
                                F.expr("cast(array() as array<string>)").alias("win"), none.alias("items"))
    near, small = bounded_broadcast(prefixes.select("token", "off", "len", "win", "items").unionByName(end))
    prefix = maybe_prefix(prefixes)
    at = F.array_compact(F.transform("w", lambda x, i: F.when(prefix(F.lower(x)), i)))
    reach = range(-(WIDTH - 1), WIDTH)
    around = F.transform(F.col("at"), lambda i: F.struct(i.alias("pos"), F.lower(F.get("w", i)).alias("token"),
                                                         F.array(*[F.get("w", F.when(i + k >= 0, i + k)) for k in reach]).alias("ctx")))
    stop = F.array(F.struct(F.col("n").alias("pos"), F.lit("").alias("token"), F.expr("cast(array() as array<string>)").alias("ctx")))
    d = tokens(docs, id_col, text_col).select("doc_id", "text_key", "w", F.size("w").alias("n"), at.alias("at"))
    d = d.select("doc_id", "text_key", "n", F.explode(F.concat(around, stop)).alias("a"))
    d = d.select("doc_id", "text_key", "n", "a.pos", "a.token", "a.ctx")
    start = F.col("pos") - F.col("off")
    fits = (start >= 0) & (start + F.col("len") <= F.col("n"))
    there = F.transform(F.slice("ctx", F.lit(WIDTH) - F.col("off"), F.col("len")), ascii_lower)
    same = there == F.col("win")
    columns = ["doc_id", "text_key", start.alias("start"), "len", "items"]
    if small:
        return d.join(near, "token").where(fits & same).select(*columns)
    met = d.where("token <> ''").join(near, "token").where(fits & same).select(*columns)
    return met.unionByName(d.where("token = ''").select("doc_id", "text_key", F.col("pos").alias("start"), F.lit(0).alias("len"), none.alias("items")))


def hit_count(places: Column) -> Column:
    """Words under the union of (start, len) intervals sorted by start."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(a: Column, p: Column) -> Column:
        end = p["start"] + p["len"]
        return F.struct((a["n"] + F.greatest(F.lit(0), end - F.greatest(a["end"], p["start"]))).alias("n"), F.greatest(a["end"], end).alias("end"))
    return F.aggregate(places, zero, step, lambda a: a["n"])


def judged(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per doc_id and text: text_key, n_rows (document rows that are
    so), n_words, n_hit, n_items, item_ids, contaminated.

    Places are gathered per document (at most one per word and length), never
    per item or window, so an item that many documents share is no hot key.
    Rows that repeat a doc_id (null included) with other texts are documents
    of their own."""
    # numbered by content, so a recomputation gives the same numbers
    wins = item_windows(items, item_id, item_text).withColumn("win_id", F.sha2(F.array_join("win", " ").cast("binary"), 256))
    wins = stored(wins, "windows")
    prefixes = stored(with_prefix(wins, docs, id_col, text_col), "prefixes")
    hits = occurrences(docs, prefixes, id_col, text_col).groupBy("doc_id", "text_key").agg(
        F.count_if(F.col("len") == 0).alias("n_rows"),
        F.sort_array(F.collect_set(F.struct("start", "len"))).alias("places"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
        F.max(F.when(F.col("len") == 0, F.col("start"))).cast("long").alias("n_words"))
    n_hit = hit_count(F.col("places")).cast("long")
    return hits.select("doc_id", "text_key", "n_rows", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "item_ids").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, item_ids,
    contaminated."""
    rows = judged(docs, items, id_col, text_col, item_id, item_text).withColumn("copy", F.explode(F.sequence(F.lit(1), "n_rows")))
    return rows.drop("text_key", "n_rows", "copy")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    ids = F.array_join(F.sort_array(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return contamination(docs, items).select("doc_id", "n_words", "n_hit", "n_items",
                                             F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated")


__all__ = ["contamination", "item_windows", "judged", "occurrences", "report"]
