"""Secret scanning over an incremental, content-addressed blob ledger.

A blob is a distinct text, addressed by its SHA-256. The ledger holds one row
per (blob, rule version) with the spans found; a scan looks only at blobs
that the ledger does not have for a rule version, appends them, and joins the
findings back to every document (path) that carries the blob.

Null texts count as empty; empty texts have no spans; texts are scanned whole;
repeated rows share one blob; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm.common import let


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds leftmost non-overlapping matches; a match counts if
    ``min_chars`` holds for its group ``group`` (0: the whole match)."""
    name: str
    pattern: str
    group: int
    min_chars: int
    needs: str  # cheap test of the text; without it there is no match


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key")
KINDS = (
    Kind("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, rf"(?:{_KEYWORDS})[\"']?\x20*[:=]"),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18, "AKIA[A-Z0-9]{14}"),
    # a maximal run of 16 or more is found either way; shorter runs are dropped
    Kind("hex", r"[0-9a-f]{16,}", 0, 16, "[0-9a-f]{16}"),
    Kind("github", r"gh[pousr]_[A-Za-z0-9]{20,}", 0, 24, "gh[pousr]_"),
    Kind("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, "xox[abprs]-"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 24, "eyJ"),
    Kind("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----", 0, 30, "PRIVATE KEY-----"),
)
BASE_KINDS = ("assign", "access", "hex")
RULE_VERSION = "kinds-1"
BLOCK = 256  # matches of one kind that are walked together


def spans(text: Column, kind: Kind, order: int) -> Column:
    """Array of (start, ord, kind, end) of one kind, in code points.

    ``split`` gives the gaps between the matches that ``regexp_extract_all``
    gives, so a match starts after the gaps and matches before it. Matches go
    in blocks: appending copies the list so far, which is a block's at most."""
    kept = F.expr("cast(array() as array<struct<start:int,ord:int,kind:string,end:int>>)")

    def walk(arrays: Column) -> Column:
        gaps, found, inner = arrays["gaps"], arrays["found"], arrays["inner"]
        n = F.size(found)

        def chars(i: Column) -> Column:  # from one match's end to the next one's
            return F.char_length(F.get(gaps, i)) + F.char_length(F.get(found, i))

        def block(b: Column) -> Column:  # its matches
            return F.sequence(b * BLOCK, F.least(n, (b + 1) * BLOCK) - 1)

        def step(a: Column, i: Column) -> Column:
            end = a["at"] + chars(i)
            start = end - F.char_length(F.get(found, i))
            one = F.array(F.struct(start.cast("int").alias("start"), F.lit(order).alias("ord"), F.lit(kind.name).alias("kind"), end.cast("int").alias("end")))
            ok = F.char_length(F.get(inner, i)) >= kind.min_chars
            return F.struct(end.cast("int").alias("at"), F.when(ok, F.concat(a["out"], one)).otherwise(a["out"]).alias("out"))

        blocks = F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))
        lengths = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), lambda a, i: a + chars(i)))
        starts = F.aggregate(lengths, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return let(starts, lambda s: F.flatten(F.transform(blocks, lambda b: F.aggregate(
            block(b), F.struct(F.get(s, b).alias("at"), kept.alias("out")), step, lambda a: a["out"]))))

    arrays = F.struct(F.split(text, kind.pattern, -1).alias("gaps"),
                      F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"),
                      F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)).alias("inner"))
    found = let(arrays, lambda a: F.when(F.size(a["found"]) > 0, walk(a)).otherwise(kept))
    return F.when(text.rlike(kind.needs), found).otherwise(kept)


def joined(all_spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    if kinds is not None:
        all_spans = F.filter(all_spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(all_spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(blobs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(blob, spans) of (blob, text)."""
    every = F.array_sort(F.concat(*[spans(F.col("text"), k, i) for i, k in enumerate(kinds)]))
    return blobs.select("blob", every.alias("spans"))


class BlobLedger:
    """Ledger table in the shared folder: (blob, spans), one folder per rule
    version and scan. A ledger without a folder yet is an empty one; every
    scan appends a batch with the next free number and never touches an
    earlier one, so findings are only added. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema = "blob binary, spans array<struct<start:int,ord:int,kind:string,end:int>>, rule_version string, batch int"

    def batches(self, rule_version: str) -> list[int]:
        """Numbers of the scans so far, from the names of their folders."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/rule_version={rule_version}")
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def read(self, rule_version: str = RULE_VERSION) -> DataFrame:
        """Scanned blobs of one rule version, from every batch so far."""
        if not self.batches(rule_version):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).where(F.col("rule_version") == rule_version)

    def scan_unseen(self, docs: DataFrame, rule_version: str = RULE_VERSION, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
        """Scan each (blob, rule version) of ``docs`` (doc_id, blob, text) that
        no earlier batch has, and return the ledger. One copy per blob is kept
        map-side before the shuffle, so thousands of copies cost one scan and
        no hot task. A scan that fails leaves an empty batch at most; the next
        one scans its blobs again."""
        blobs, done = docs.select("blob", "text").dropDuplicates(["blob"]), self.batches(rule_version)
        if done:
            blobs = blobs.join(self.read(rule_version).select("blob"), "blob", "left_anti")
        batch = done[-1] + 1 if done else 0
        scan(blobs, kinds).write.mode("errorifexists").parquet(f"{self.path}/rule_version={rule_version}/batch={batch}")
        return self.read(rule_version)


def addressed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"), text.alias("text"))


def findings(docs: DataFrame, ledger: BlobLedger, rule_version: str = RULE_VERSION, scanned: bool = False,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its blob and spans (empty array: none). Unseen
    blobs are scanned first, unless the caller has had them ``scanned``."""
    paths = addressed(docs, id_col, text_col)
    every = ledger.read(rule_version) if scanned else ledger.scan_unseen(paths, rule_version)
    hits = every.where(F.size("spans") > 0).select("blob", "spans")
    none = F.expr("cast(array() as array<struct<start:int,ord:int,kind:string,end:int>>)")
    return (paths.select("doc_id", "blob").join(hits, "blob", "left")
            .select("doc_id", "blob", F.coalesce("spans", none).alias("spans")))


def redacted(text: Column, all_spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``; overlapping or touching
    spans become one."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fresh = (s["start"] > a["at"]) | (a["out"] == "") & (s["start"] == 0)
        piece = F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(fresh, piece).otherwise(a["out"]).alias("out"))
    rest = F.aggregate(all_spans, zero, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))
    return F.when(F.size(all_spans) > 0, rest).otherwise(text)


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def report(docs: DataFrame, ledger: BlobLedger, deliveries: tuple[Column, ...] = ()) -> DataFrame:
    """The digest columns of ``op3``: counts and base spans are of the base
    kinds, ``spans`` has the further kinds too. ``deliveries`` are conditions
    that part the documents; each part is scanned in turn over the one ledger,
    so a later part is scanned for blobs that no earlier one had."""
    for part in deliveries:
        ledger.scan_unseen(addressed(docs.where(part)))
    f = findings(docs, ledger, scanned=bool(deliveries))
    return f.select("doc_id", *[count_of(k) for k in BASE_KINDS], F.sha2(joined(F.col("spans"), BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
                    joined(F.col("spans")).alias("spans"))


__all__ = ["BlobLedger", "KINDS", "Kind", "addressed", "findings", "redacted", "report", "scan"]
