"""Sequence packing by non-negative least squares.

Documents become token ids plus an end id. What exceeds full windows is cut
into a piece that is a multiple of a quantum and a short tail, so the pieces'
lengths form a small histogram. Shallow combinations of lengths that fill a
window exactly are enumerated; non-negative least squares finds how often to
use each so as to meet the histogram; the counts are rounded down, and the
residual pieces and the tails are packed greedily, again on histograms. The
plan (a few thousand rows at any input size) is then joined to the pieces:
the k-th piece of a length goes where the plan's k-th place for it is.

Null and empty texts are the end id alone; texts of any length are cut into
windows; equal texts are packed one by one; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import stored


@dataclass(frozen=True)
class Packing:
    window: int = 4096
    quantum: int = 64
    depth: int = 4  # pieces in an enumerated combination
    end_id: int = 2
    tokenizer: str = "word_bpe_49k.json"
    rows_per_block: int = 5_000


# Texts of these characters alone: composed Latin letters, so normalisation
# is lower-casing, and words never reach across white space.
_PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
# Fixed value: the split pattern of the tokenizer, over those characters.
_LETTER = "a-zß-öø-ÿ"
_PRETOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\\s0-9{_LETTER}]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable letter: printable bytes
    as themselves, the rest from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Remembered(dict):
    """Word -> its ids as bytes, encoded when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.encode(word)
        return ids


class WordIds:
    """Token ids of texts by the tokenizers library, with the ids of each
    word that its split pattern gives remembered: a plain text is split and
    looked up word by word, any other goes to the library whole."""

    LIMIT = 1_000_000  # remembered words; a full memory is emptied

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.wide = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.letters = _byte_letters()
        self.words = Remembered(self._word)
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.tok.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]
        return b"".join([i.to_bytes(self.wide.itemsize, "little") for i in ids])

    def encode(self, text: str) -> np.ndarray:
        """Unsigned 32-bit ids."""
        if not _PLAIN.fullmatch(text) or "<|" in text and any(s in text.lower() for s in self.specials):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if len(self.words) > self.LIMIT:
            self.words.clear()
        parts = map(self.words.__getitem__, _PRETOKEN.findall(text.lower()))
        return np.frombuffer(b"".join(parts), dtype=self.wide).astype("<u4")


_held: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process; tasks that reuse the process share it."""
    if path not in _held:
        _held[path] = WordIds(path)
    return _held[path]


def cuts(n: int, cfg: Packing) -> list[tuple[int, int]]:
    """(start, length): full windows, one multiple of the quantum, one tail."""
    full = n // cfg.window * cfg.window
    tail = (n - full) % cfg.quantum
    out = [(s, cfg.window) for s in range(0, full, cfg.window)]
    if n - full - tail:
        out.append((full, n - full - tail))
    if tail:
        out.append((n - tail, tail))
    return out


def pieces(docs: DataFrame, tokenizer_path: str, cfg: Packing, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    end = np.array([cfg.end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = word_ids(tokenizer_path)
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"].astype("Int64"), b["text"]):
                data = (ids.encode(text).tobytes() if isinstance(text, str) else b"") + end
                n = len(data) // 4
                rows += [(doc, s, k, zlib.crc32(data[4 * s:4 * (s + k)]), n) for s, k in cuts(n, cfg)]
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield out.astype({"doc_id": "Int64"})
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInPandas(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def combinations(total: int, depth: int, top: int | None = None) -> Iterator[tuple[int, ...]]:
    """Descending tuples of at most ``depth`` positive parts that sum up to
    ``total``."""
    top = total if top is None else min(top, total)
    for first in range(top, 0, -1):
        if first == total:
            yield (first,)
        elif depth > 1:
            for rest in combinations(total - first, depth - 1, first):
                yield (first, *rest)


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min |a x - b| over x >= 0, by an active set: take the column with the
    steepest gain, solve on the taken ones, step back to the border while any
    would turn negative."""
    x, taken = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(3 * a.shape[1]):
        gain = a.T @ (b - a @ x)
        gain[taken] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        taken[best] = True
        while True:
            trial = np.zeros_like(x)
            trial[taken] = np.linalg.lstsq(a[:, taken], b, rcond=None)[0]
            low = taken & (trial <= 1e-12)
            if not low.any():
                break
            step = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + min(1.0, step) * (trial - x)
            taken &= x > 1e-12
            x[~taken] = 0
        x = trial
    return x


def greedy(left: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """(contents of a window, repeats): the longest first, then whatever is
    the longest that still fits; a window is repeated until one of its
    lengths runs out, so there are few more windows than lengths."""
    left, out = {k: n for k, n in left.items() if n > 0}, []
    while left:
        room, inside = window, {}
        for size in sorted(left, reverse=True):
            n = min(left[size], room // size)
            if n:
                inside[size], room = n, room - n * size
        times = min(left[s] // n for s, n in inside.items())
        out.append((inside, times))
        for s, n in inside.items():
            left[s] -= n * times
        left = {k: n for k, n in left.items() if n > 0}
    return out


def plan(histogram: dict[int, int], cfg: Packing) -> list[tuple[dict[int, int], int]]:
    """(contents, repeats) for every piece of the histogram of lengths."""
    units = cfg.window // cfg.quantum
    have = {u: histogram.get(u * cfg.quantum, 0) for u in range(1, units)}
    out = [({cfg.window: 1}, histogram[cfg.window])] if histogram.get(cfg.window) else []
    if any(have.values()):
        combos = [c for c in combinations(units, cfg.depth) if len(c) > 1 and all(have[u] for u in c)]
        a = np.zeros((units - 1, len(combos)))
        for j, c in enumerate(combos):
            for u in c:
                a[u - 1, j] += 1
        x = nnls(a, np.array([have[u] for u in range(1, units)], dtype=float)) if combos else np.zeros(0)
        for j in np.argsort(-x, kind="stable"):
            inside = {u: combos[j].count(u) for u in set(combos[j])}
            times = min([int(x[j] + 1e-9), *[have[u] // n for u, n in inside.items()]])
            if times > 0:
                out.append(({u * cfg.quantum: n for u, n in inside.items()}, times))
                for u, n in inside.items():
                    have[u] -= n * times
        out += greedy({u * cfg.quantum: n for u, n in have.items()}, cfg.window)
    return out + greedy({k: n for k, n in histogram.items() if k < cfg.quantum}, cfg.window)


def places(windows: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, per window, first window, offset): the pieces
    ``first`` to ``last`` of a length fill ``per window`` neighbouring places
    of each window from ``first window`` on."""
    used: dict[int, int] = {}
    out, window = [], 0
    for inside, times in windows:
        offset = 0
        for size in sorted(inside, reverse=True):
            n = inside[size]
            first = used.get(size, 0)
            out.append((size, first, first + n * times - 1, n, window, offset))
            used[size] = first + n * times
            offset += n * size
        window += times
    return out


def pack(docs: DataFrame, tokenizer_path: str, cfg: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with its sequence and offset there. Pieces are
    numbered inside (length, block), the blocks by a running sum of their
    counts, so no length is numbered in one task."""
    spark = docs.sparkSession
    p = stored(pieces(docs, tokenizer_path, cfg, id_col, text_col), "pieces")
    histogram = {r.length: r.n for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most two quanta of lengths
    slots = spark.createDataFrame(places(plan(histogram, cfg)) or [(0, 0, 0, 1, 0, 0)],
                                  "length long, first long, last long, per long, window long, at long")
    n_blocks = max(1, sum(histogram.values()) // (cfg.rows_per_block * max(1, min(len(histogram), 16))))
    d = p.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n_blocks)).cast("int"))
    counts = d.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = counts.select("length", "block", (F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")).alias("before"))
    d = d.withColumn("k", F.row_number().over(Window.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32")) - 1)
    d = d.join(before, ["length", "block"]).withColumn("k", F.col("k") + F.col("before"))
    s = F.broadcast(slots).alias("s")  # the plan: bounded by the lengths, not by the input
    d = d.alias("d").join(s, (F.col("d.length") == F.col("s.length")) & F.col("k").between(F.col("first"), F.col("last")))
    j = F.col("k") - F.col("first")
    return d.select("doc_id", "start", F.col("d.length").alias("length"), "ids_crc32", "doc_tokens",
                    (F.col("window") + F.floor(j / F.col("per"))).cast("long").alias("sequence_id"),
                    (F.col("at") + F.pmod(j, F.col("per")) * F.col("d.length")).cast("long").alias("offset"))
