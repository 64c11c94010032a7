"""N-gram Jaccard self-join by chosen paths.

A document is the set of its five-word shingles; two documents link if their
sets have a Jaccard similarity of at least 0.8. Equal sets are collapsed
first. Each set is embedded as 64 min-hash tokens (each a sampled shingle, so
sharing a token is sharing a shingle). In each of several runs every node of
a random tree lets a set choose some of its tokens, by a hash of (path,
token); sets that choose the same token meet in the same child. Nodes that
are small enough are leaves and are compared by brute force; larger ones are
split again. Runs repeat until the chance to miss a pair at the threshold is
below ``1 - recall``.

A pair that meets in several leaves counts in the first of their shared
leaves only, so links are counted without ever writing out the pairs of a
group; a leaf emits one row per set and a spanning forest of its links.

Null and empty texts have no shingles and link to nothing; a text of fewer
than five words is one shingle; equal texts are copies of one set; rows
without doc_id get no class; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import arrow_rows, stored, text_key
from pluvio.llm.textvec import chunks, mix, shingles, trim, word_hashes

COORDS = 64
_SEEDS = mix(np.arange(1, COORDS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


@dataclass(frozen=True)
class Join:
    words: int = 5
    threshold: float = 0.8
    recall: float = 0.99999  # of a pair exactly at the threshold
    children: float = 2.0  # tokens that a set chooses at a node, on average
    leaf: int = 1000  # sets that are compared by brute force at once
    depth: int = 5  # levels; what is larger below them is compared in blocks

    def miss(self, runs: int) -> float:
        """Chance that a pair at the threshold shares no leaf in any run. All
        runs draw on one sketch, so the number k of tokens that the pair
        shares is drawn once, from Binomial(64, threshold). Given k, a shared
        node has Binomial(k, children / 64) shared children, and the chance
        that a run reaches the deepest level follows by iteration."""
        total = 0.0
        for k in range(COORDS + 1):
            alive = 1.0
            for _ in range(self.depth):
                alive = 1 - (1 - self.children / COORDS * alive) ** k
            total += math.comb(COORDS, k) * self.threshold ** k * (1 - self.threshold) ** (COORDS - k) * (1 - alive) ** runs
        return total

    @property
    def runs(self) -> int:
        """Least number of runs that misses a pair at the threshold with a
        chance of at most ``1 - recall``."""
        return next(r for r in range(1, 1000) if self.miss(r) <= 1 - self.recall)

    @property
    def agree(self) -> int:
        """Min-hash tokens of 64 that must agree: five standard deviations
        below the mean at the threshold."""
        t = self.threshold
        return math.floor(COORDS * t - 5 * math.sqrt(COORDS * t * (1 - t)))


def sets_of(texts: pd.Series, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Sorted distinct shingle hashes of each text, in chunks."""
    for first, enc in chunks(texts):
        h, n = shingles(*word_hashes(enc), k)
        yield first, [np.unique(x) for x in np.split(h, np.cumsum(n)[:-1])]


def set_id(tokens: np.ndarray) -> bytes:
    """16 bytes that identify a set: two sums of independently mixed tokens."""
    a, b = mix(tokens).sum(dtype=np.uint64), mix(tokens ^ np.uint64(0xA5A5A5A5DEADBEEF)).sum(dtype=np.uint64)
    return np.array([a, b ^ np.uint64(len(tokens))], dtype=np.uint64).tobytes()


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """(number of sets, 64) min-hash values; no set may be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDS), dtype=np.uint32)
    for j in range(COORDS):
        out[:, j] = (np.minimum.reduceat(flat * _SEEDS[j], starts) >> np.uint64(32)).astype(np.uint32)
    return out


def embed(docs: DataFrame, cfg: Join) -> DataFrame:
    """(doc_id, text_key, sid, sketch); sid is null for texts without words."""
    def run(batches):
        for b in batches:
            sids, sketches = [None] * len(b), [None] * len(b)
            for first, sets in sets_of(b["text"], cfg.words):
                full = [i for i, s in enumerate(sets) if len(s)]
                if full:
                    for i, row in zip(full, sketch([sets[i] for i in full])):
                        sids[first + i], sketches[first + i] = set_id(sets[i]), row.tobytes()
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_key": b["text_key"], "sid": sids, "sketch": sketches})
        trim()
    return docs.mapInPandas(run, "doc_id long, text_key binary, sid binary, sketch binary")


def chosen(paths: np.ndarray, sketches: np.ndarray, cfg: Join) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, child paths): token (j, value) is chosen at a path if the
    hash of both falls under children / 64."""
    token = mix(sketches.astype(np.uint64) * np.uint64(COORDS) + np.arange(COORDS, dtype=np.uint64))
    h = mix(token ^ mix(paths)[:, None])
    row, col = np.nonzero(h < np.uint64(int(cfg.children / COORDS * 2**64)))
    return row, mix(h[row, col]).view(np.int64)


def first_level(sets: DataFrame, cfg: Join) -> DataFrame:
    def run(batches):
        for b in batches:
            sk = np.frombuffer(b"".join(b["sketch"]), dtype=np.uint32).reshape(-1, COORDS)
            sid = b["sid"].to_numpy()
            for r in range(cfg.runs):
                root = np.full(len(b), mix(np.array([r + 1], dtype=np.uint64))[0], dtype=np.uint64)
                row, path = chosen(root, sk, cfg)
                yield pd.DataFrame({"sid": sid[row], "path": path})
    return sets.select("sid", "sketch").mapInPandas(run, "sid binary, path long")


def next_level(large: DataFrame, sets: DataFrame, cfg: Join) -> DataFrame:
    def run(batches):
        for b in batches:
            sk = np.frombuffer(b"".join(b["sketch"]), dtype=np.uint32).reshape(-1, COORDS)
            row, path = chosen(b["path"].to_numpy().view(np.uint64), sk, cfg)
            yield pd.DataFrame({"sid": b["sid"].to_numpy()[row], "path": path, "parent": b["path"].to_numpy()[row]})
    return large.join(sets.select("sid", "sketch"), "sid").select("sid", "path", "sketch").mapInPandas(run, "sid binary, path long, parent long")


def leaves(sets: DataFrame, cfg: Join) -> DataFrame:
    """(sid, path, n) of every leaf with two sets or more. Node sizes are
    summed map-side; a node that nobody shares is dropped. One above ``leaf``
    is split if that at least halves the pairs to compare (the squares of its
    children's sizes); a dense node, whose sets are alike, would only be
    repeated in its children, so it is a leaf of any size."""
    out, rows = None, stored(first_level(sets, cfg), "paths")
    for level in range(1, cfg.depth + 1):
        n = rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        met = stored(rows.join(n, "path").select("sid", "path", "n"), "nodes")
        small = met.where(F.col("n") <= cfg.leaf)
        out = small if out is None else out.unionByName(small)
        large = met.where(F.col("n") > cfg.leaf)
        if large.isEmpty():
            return out
        if level == cfg.depth:
            return out.unionByName(large)
        kids = stored(next_level(large, sets, cfg), "paths")
        sizes = kids.groupBy("parent", "path").agg(F.count("*").cast("double").alias("c"))
        pairs = sizes.groupBy("parent").agg(F.sum(F.col("c") * F.col("c")).alias("pairs"))
        nodes = large.select("path", "n").distinct().join(pairs, F.col("path") == F.col("parent"), "left")
        dense = stored(nodes.where(2 * F.coalesce("pairs", F.lit(0.0)) >= F.col("n") * F.col("n")).select("path"), "dense")
        out = out.unionByName(large.join(dense, "path", "left_semi").select("sid", "path", "n"))
        rows = kids.join(dense.withColumnRenamed("path", "parent"), "parent", "left_anti").select("sid", "path")
    return out


def dealt(met: DataFrame, cfg: Join) -> DataFrame:
    """Add the bucket that a leaf's rows meet in. A leaf above the bound is
    cut into blocks by a hash of the set, and each pair of blocks is a bucket
    in which only pairs across the two are compared (for a block with itself:
    all of its pairs), so no task ever holds more than a leaf's bound."""
    blocks = F.greatest(F.lit(1), F.ceil(2 * F.col("n") / cfg.leaf)).cast("int")
    blocks = F.when(F.col("n") <= cfg.leaf, 1).otherwise(blocks)
    own = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    d = met.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return d.withColumns({"bucket": F.xxhash64("path", low, high), "cross": low != high}).drop("n", "other")


def to_compare(b: pd.DataFrame) -> np.ndarray | bool:
    """Pairs that a bucket is there for."""
    if not b["cross"].iloc[0]:
        return True
    own = b["own"].to_numpy()
    return own[:, None] != own[None, :]


def first_meetings(path: int, lists: list[np.ndarray]) -> np.ndarray:
    """Matrix: do the sets i and j share no leaf that comes before ``path``?"""
    m = len(lists)
    flat = np.concatenate(lists)
    of = np.repeat(np.arange(m), [len(x) for x in lists])
    keep = flat < path
    ids, col, n = np.unique(flat[keep], return_inverse=True, return_counts=True)
    of, good = of[keep], n[col] > 1 if len(ids) else np.zeros(0, bool)
    met = np.zeros((m, m), dtype=np.float32)
    if good.any():
        ids, col = np.unique(col[good], return_inverse=True)
        of = of[good]
        for lo in range(0, len(ids), 4096):
            part = (col >= lo) & (col < lo + 4096)
            b = np.zeros((m, min(4096, len(ids) - lo)), dtype=np.float32)
            b[of[part], col[part] - lo] = 1
            met += b @ b.T
    return met == 0


def met_before(path: int, lists: list[np.ndarray]) -> np.ndarray:
    """Sets of a bucket that share one earlier leaf, the commonest there, if
    most of them do; no pair of theirs is to be compared here."""
    flat = np.concatenate(lists)
    of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])[flat < path]
    flat = flat[flat < path]
    out = np.zeros(len(lists), dtype=bool)
    if len(flat):
        ids, n = np.unique(flat, return_counts=True)
        if 2 * n.max() > len(lists):
            out[of[flat == ids[n.argmax()]]] = True
    return out


def agreement(sk: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sketch values in which each of ``rows`` agrees with every set."""
    if len(sk) <= 32:
        return (sk[rows][:, None, :] == sk[None, :, :]).sum(axis=2)
    out = np.zeros((len(rows), len(sk)), dtype=np.uint8)
    for j in range(COORDS):
        out += sk[rows, None, j] == sk[None, :, j]
    return out


def agreeing(b: pd.DataFrame, least: int) -> np.ndarray:
    """Matrix of the pairs that a bucket is there for and whose sketches agree
    in ``least`` values. Where most sets of a large bucket have met in an
    earlier leaf, only the others are compared with all."""
    sk = np.frombuffer(b"".join(b["sketch"]), dtype=np.uint8).reshape(-1, COORDS)
    rows = np.arange(len(b))
    if len(b) > 64:
        rows = np.flatnonzero(~met_before(b["path"].iloc[0], list(b["leaves"])))
    good, part = np.zeros((len(b), len(b)), dtype=bool), agreement(sk, rows) >= least
    good[rows] = part
    good[:, rows] |= part.T
    good &= to_compare(b)
    np.fill_diagonal(good, False)
    return good


def buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole buckets from batches sorted by bucket; at most one is carried over."""
    held: list[pd.DataFrame] = []
    for b in batches:
        path = b["bucket"].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(path[1:] != path[:-1]) + 1, [len(path)]]) if len(path) else [0]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            piece = b.iloc[lo:hi]
            if held and held[0]["bucket"].iloc[0] != path[lo]:
                yield held[0] if len(held) == 1 else pd.concat(held)
                held = []
            held.append(piece)
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held)


_PLACE = ["bucket", "path", "own", "cross"]
_PLACE_TYPES = "bucket long, path long, own int, cross boolean"


def candidates(members: DataFrame, cfg: Join) -> DataFrame:
    """Rows of the sets that have, in that bucket, a partner they meet first
    in that leaf and whose sketch agrees well enough."""
    def run(batches):
        out = []
        for b in buckets(batches):
            if len(b) < 2:
                continue
            good = agreeing(b, cfg.agree)
            has = good.any(axis=1)
            if has.any():
                b, good = b[has], good[np.ix_(has, has)]
                good &= first_meetings(b["path"].iloc[0], list(b["leaves"]))
                b = b[good.any(axis=1)]
                if len(b):
                    out.append(b[_PLACE + ["sid", "leaves"]])
            if sum(map(len, out)) > 2000:
                yield pd.concat(out)
                out = []
        if out:
            yield pd.concat(out)
        trim()
    met = members.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInPandas(run, f"{_PLACE_TYPES}, sid binary, leaves array<long>")


TOKENS_AT_ONCE = 1 << 20


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Exact: matrix of pairs with intersection >= threshold * union. Tokens
    are sorted hashes, so long sets are gone through in ranges of the hash
    and no step holds much more than TOKENS_AT_ONCE of them."""
    m, sizes = len(sets), np.array([len(s) for s in sets], dtype=np.float32)
    inter, n_parts = np.zeros((m, m), dtype=np.float32), 1 + int(sizes.sum()) // TOKENS_AT_ONCE
    cuts = np.array([(p << 64) // n_parts for p in range(n_parts)], dtype=np.uint64)
    at = np.array([[*np.searchsorted(s, cuts), len(s)] for s in sets])
    for p in range(n_parts):
        part = [s[x[p]:x[p + 1]] for s, x in zip(sets, at)]
        tokens, col, n = np.unique(np.concatenate(part), return_inverse=True, return_counts=True)
        of = np.repeat(np.arange(m), [len(x) for x in part])
        shared = n[col] > 1
        ids, col = np.unique(col[shared], return_inverse=True)
        of = of[shared]
        order = np.argsort(col, kind="stable")
        of, col = of[order], col[order]
        for lo in range(0, len(ids), 1024):
            a, z = np.searchsorted(col, [lo, lo + 1024])
            b = np.zeros((m, min(1024, len(ids) - lo)), dtype=np.float32)
            b[of[a:z], col[a:z] - lo] = 1
            inter += b @ b.T
    ok, sizes = np.zeros((m, m), dtype=bool), sizes.astype(np.float64)
    for lo in range(0, m, 256):
        x = inter[lo:lo + 256].astype(np.float64)
        ok[lo:lo + 256] = x >= threshold * (sizes[lo:lo + 256, None] + sizes[None, :] - x) - 1e-6
    np.fill_diagonal(ok, False)
    return ok


def verified(found: DataFrame, docs: DataFrame, classes: DataFrame, cfg: Join) -> DataFrame:
    """(sid, links, root): for each set of each leaf the documents it links to
    there, and the least set id of its component there. The texts of
    representatives come in by one join and are cut into shingles again."""
    want = found.join(classes.select("sid", "copies", F.col("rep").alias("doc_id")), "sid")
    want = want.groupBy("doc_id", "sid", "copies").agg(F.collect_list(F.struct(*_PLACE)).alias("places"), F.first("leaves").alias("leaves"))
    texts = want.join(docs.where("doc_id IS NOT NULL"), "doc_id").select("sid", "copies", "places", "leaves", "text")

    def cut(batches):
        columns = [*_PLACE, "sid", "copies", "leaves", "tokens"]
        for b in batches:
            rows, size = [], 0
            for first, sets in sets_of(b["text"], cfg.words):
                part = b.iloc[first:first + len(sets)]
                for s, c, ps, lv, t in zip(part["sid"], part["copies"], part["places"], part["leaves"], sets):
                    if not len(t) or set_id(t) != s:
                        continue
                    tokens = t.tobytes()
                    for p in ps:
                        rows.append((*(p[k] for k in _PLACE), s, c, lv, tokens))
                        size += len(tokens) + 8 * len(lv)
                        if size > 8 << 20:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=columns)
        trim()

    def check(batches):
        out = []
        for b in buckets(batches):
            b = b[~b["sid"].duplicated()]
            if len(b) < 2:
                continue
            ok = similar([np.frombuffer(t, dtype=np.uint64) for t in b["tokens"]], cfg.threshold) & to_compare(b)
            if ok.any():
                ok &= first_meetings(b["path"].iloc[0], list(b["leaves"]))
                sid, copies = b["sid"].to_numpy(), b["copies"].to_numpy()
                out += [(s, n, r) for s, n, r in zip(sid, ok @ copies, roots(ok, sid)) if n]
            if len(out) > 5000:
                yield pd.DataFrame(out, columns=["sid", "links", "root"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["sid", "links", "root"])
        trim()

    cutup = texts.mapInPandas(cut, f"{_PLACE_TYPES}, sid binary, copies long, leaves array<long>, tokens binary")
    return cutup.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(check, "sid binary, links long, root binary")


def roots(ok: np.ndarray, sid: np.ndarray) -> list[bytes]:
    """Least set id of each row's connected component in a boolean matrix."""
    order = np.argsort(sid)
    rank = np.empty(len(sid), dtype=np.int64)
    rank[order] = np.arange(len(sid))
    label = rank.copy()
    while True:
        best = np.minimum(label, np.where(ok, label[None, :], len(sid)).min(axis=1))
        if (best == label).all():
            return [sid[order[x]] for x in label]
        label = best


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the connected components of (a, b), by alternating
    large and small stars until nothing changes; each round is stored."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b < a")
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        pairs = both.join(least, "a")
        out = pairs.where("b > a") if large else pairs
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.unionByName(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = stored(edges.where("a <> b").distinct(), "edges")
    now = state(e)
    while now[0]:
        e = stored(star(star(e, True), False), "edges")
        before, now = now, state(e)
        if before == now:
            break
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def members_of_classes(docs: DataFrame, cfg: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``join`` with text_key and root: the connected component itself (null
    for texts without words and rows without doc_id), as components that
    share a repeated doc_id may have the same class_id."""
    with arrow_rows(docs.sparkSession, 1000):
        return _members(docs, cfg, id_col, text_col)


def _members(docs: DataFrame, cfg: Join, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(embed(docs.withColumn("text_key", text_key(F.col("text"))), cfg), "sketches")
    ids = rows.where("sid IS NOT NULL AND doc_id IS NOT NULL")
    classes = stored(ids.groupBy("sid").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sketch").alias("sketch")), "classes")
    met = stored(leaves(classes, cfg), "leaves")
    low = F.expr("cast(array_join(transform(sequence(0, 63), i -> substring(hex(sketch), 8 * i + 1, 2)), '') as string)")
    byte = F.unhex(low).alias("sketch")  # the low byte of each value
    of_set = met.groupBy("sid").agg(F.sort_array(F.collect_set(F.struct("path", "n"))).alias("met")).join(classes.select("sid", byte), "sid")
    members = of_set.select("sid", "sketch", F.col("met.path").alias("leaves"), F.explode("met").alias("m"))
    members = dealt(members.select("sid", "sketch", "leaves", "m.path", "m.n"), cfg)
    found = stored(candidates(members, cfg), "candidates")
    links = stored(verified(found, docs, classes, cfg), "links")
    comp = components(links.select(F.col("sid").alias("a"), F.col("root").alias("b")))
    named = classes.select("sid", "rep", "copies").join(comp.withColumnRenamed("node", "sid"), "sid", "left")
    named = named.withColumn("root", F.coalesce("root", "sid"))
    least = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    n = links.groupBy("sid").agg(F.sum("links").alias("links"))
    named = named.join(least, "root").join(n, "sid", "left").select(
        "sid", "root", "rep", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.select("doc_id", "text_key", F.when(F.col("doc_id").isNotNull(), F.col("sid")).alias("sid")).join(named, "sid", "left").select(
        "doc_id", "text_key", "root", F.coalesce("rep", "doc_id").alias("rep_id"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def join(docs: DataFrame, cfg: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, rep_id (least id among equal sets),
    class_id (least id of the connected component), n_links (other documents
    at or above the threshold, copies included)."""
    return members_of_classes(docs, cfg, id_col, text_col).drop("text_key", "root")
