"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms of a text are its style (trigrams of runs of character classes: lower,
upper, digit, space, line break, each punctuation mark; repeated or single;
and words that repeat the one before) and its words, hashed. A bounded sample of labelled texts
gives the term-document matrix (square roots of term shares, times inverse
document frequency); its leading singular directions are the latent space.
The sample's vectors are broadcast; every document is projected, its cosine
with every labelled vector is computed exactly, block by block, and the
nearest ones vote with their similarity.

Null and empty texts have no terms and score 0; without labelled rows every
text scores 0.5; repeated labels of a document are averaged, and of the texts
that share a labelled id one is taken; null labels and ids are no labels; whole texts are read; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.textvec import LONG, chunks, mix, pieces, trim, word_hashes

TERMS = 4096  # hashed trigrams; two terms for repeats follow, then the hashed words
WORDS = 2048
DIM = TERMS + 2 + WORDS
PARTS = ((slice(0, TERMS), 1.0), (slice(TERMS, TERMS + 2), 1.0), (slice(TERMS + 2, DIM), 0.5))  # normalised apart, with their weights
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[65:91], _CLASS[48:58], _CLASS[[9, 32]], _CLASS[[10, 13]] = 1, 2, 3, 4
_CLASS[:9] = _CLASS[11:13] = _CLASS[14:32] = _CLASS[127] = 5
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_MARKS] = np.arange(6, 6 + len(_MARKS))
_STOP = 79  # between texts


@dataclass(frozen=True)
class Voting:
    max_labelled: int = 4096  # labelled texts in the sample: the bound of all that is broadcast
    rank: int = 48
    neighbours: int = 25
    block: int = 256  # documents per matrix product


@dataclass(frozen=True)
class Space:
    """What is broadcast: at most (DIM + max_labelled) x rank numbers."""
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def term_counts(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, term, count), every text's terms together. A text of
    several MB is counted piece by piece; the pieces end behind a word."""
    if any(len(b) > LONG for b in encoded):
        parts = [(i, term_counts([p])) for i, b in enumerate(encoded) for p in pieces(b)]
        keys = np.concatenate([i * DIM + t for i, (_, t, _) in parts])
        keys, back = np.unique(keys, return_inverse=True)
        return keys // DIM, keys % DIM, np.bincount(back, np.concatenate([c for _, (_, _, c) in parts])).astype(np.int64)
    buf = np.frombuffer(b"\x00".join(encoded) + b"\x00", dtype=np.uint8)
    cls = _CLASS[buf].copy()
    ends = np.cumsum([len(b) + 1 for b in encoded]) - 1
    cls[ends] = _STOP
    cut = np.concatenate([[0], np.flatnonzero(cls[1:] != cls[:-1]) + 1])
    run, long = cls[cut], np.diff(np.concatenate([cut, [len(cls)]])) > 1
    code = run + 40 * (long & ((run == 1) | (run == 2) | (run >= 6)) & (run != _STOP))
    of = np.searchsorted(ends, cut, side="left")
    a, b, c = code[:-2], code[1:-1], code[2:]
    inside = (of[:-2] == of[2:]) & (run[2:] != _STOP) & (run[1:-1] != _STOP) & (run[:-2] != _STOP)
    tri = (mix(((a * 128 + b) * 128 + c).astype(np.uint64)) % np.uint64(TERMS)).astype(np.int64)[inside]
    text = of[:-2][inside]
    words, n = word_hashes(encoded)
    own = np.repeat(np.arange(len(n)), n)
    follows = own[1:] == own[:-1]
    again = words[1:] == words[:-1]
    word = TERMS + 2 + (words % np.uint64(WORDS)).astype(np.int64)
    key = np.concatenate([text * DIM + tri, own * DIM + word, (own[1:] * DIM + np.where(again, TERMS, TERMS + 1))[follows]])
    keys, counts = np.unique(key, return_counts=True)
    return keys // DIM, keys % DIM, counts


def matrix(text: np.ndarray, term: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Rows of square roots of term shares, each part by itself."""
    x = np.zeros((n, DIM), dtype=np.float32)
    x[text, term] = count
    return shares(x)


def shares(x: np.ndarray) -> np.ndarray:
    """Rows of counts, changed in place as ``matrix`` says."""
    for part, weight in PARTS:
        x[:, part] /= np.maximum(x[:, part].sum(axis=1, keepdims=True), 1) / weight ** 2
    return np.sqrt(x, out=x)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Sample:
    """Term weights of the labelled texts, without the zeros: those of text
    ``i`` stand at ``at[i]:at[i + 1]``. Only ``step`` texts at a time are
    spread out to rows, so the driver never holds the whole matrix."""
    at: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    step: int

    def blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        n = len(self.at) - 1
        for lo in range(0, n, self.step):
            hi = min(n, lo + self.step)
            part, x = slice(self.at[lo], self.at[hi]), np.zeros((hi - lo, DIM), dtype=np.float32)
            x[np.repeat(np.arange(hi - lo), np.diff(self.at[lo:hi + 1])), self.terms[part]] = self.weights[part]
            yield slice(lo, hi), x

    def times(self, q: np.ndarray) -> np.ndarray:
        return np.concatenate([x @ q for _, x in self.blocks()])

    def normal(self, q: np.ndarray) -> np.ndarray:
        """The transposed matrix times the matrix times ``q``. Ranges of terms
        are spread out, not of texts: each sum over the texts stays one sum."""
        y, n = self.times(q), len(self.at) - 1
        of = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.at))
        order = np.argsort(self.terms, kind="stable")
        cuts, width = np.searchsorted(self.terms, np.arange(DIM + 1), sorter=order), max(1, self.step * DIM // n)
        out = []
        for lo in range(0, DIM, width):
            hi = min(DIM, lo + width)
            part, x = order[cuts[lo]:cuts[hi]], np.zeros((n, hi - lo), dtype=np.float32)
            x[of[part], self.terms[part] - lo] = self.weights[part]
            out.append(x.T @ y)
        return np.concatenate(out)


def weighted(terms: list[bytes], counts: list[bytes], step: int) -> tuple[np.ndarray, Sample]:
    """Inverse document frequencies, and the sample with rows of length 1."""
    at = np.cumsum([0] + [len(t) // 2 for t in terms])
    terms = np.frombuffer(b"".join(terms), dtype=np.int16)
    idf = (np.log((len(at)) / (1 + np.bincount(terms, minlength=DIM))) + 0.1).astype(np.float32)
    raw = Sample(at, terms, np.frombuffer(b"".join(counts), dtype=np.int32), step)
    weights = np.empty(len(terms), dtype=np.float32)
    for rows, x in raw.blocks():
        part = slice(at[rows.start], at[rows.stop])
        of = np.repeat(np.arange(len(x)), np.diff(at[rows.start:rows.stop + 1]))
        weights[part] = unit(shares(x) * idf)[of, terms[part]]
    return idf, Sample(at, terms, weights, step)


def fit(idf: np.ndarray, w: Sample, labels: np.ndarray, cfg: Voting) -> Space:
    """Leading right singular vectors of the weighted matrix by subspace
    iteration from a fixed start."""
    rank = min(cfg.rank, len(labels))
    q = np.random.default_rng(7).standard_normal((DIM, rank + 8)).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(w.normal(q))
    _, _, v = np.linalg.svd(w.times(q), full_matrices=False)
    axes = (q @ v.T)[:, :rank].astype(np.float32)
    return Space(idf, axes, unit(w.times(axes)).astype(np.float32), labels.astype(np.float32))


def vote(x: np.ndarray, space: Space, cfg: Voting) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest neighbours."""
    z = unit((x * space.idf) @ space.axes)
    cos = z @ space.vectors.T
    k = min(cfg.neighbours, cos.shape[1])
    near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cos, near, axis=1), 0) ** 8
    total = weight.sum(axis=1)
    return np.where(total > 0, (weight * space.labels[near]).sum(axis=1) / np.maximum(total, 1e-30), 0.0)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, cfg: Voting = Voting(), id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Space | None:
    """Fit on at most ``max_labelled`` labelled documents that are not held
    out, those with the least hash of their id: the driver gets their terms
    only, a bounded number of rows."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("y").alias("y"))
    # ids first (twice the bound, as some have no text), then only their texts
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * cfg.max_labelled)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text <> ''")
    rows = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first, enc in chunks(b["text"]):
                text, term, count = term_counts(enc)
                cuts = np.searchsorted(text, np.arange(1, len(enc)))
                part = b.iloc[first:first + len(enc)]
                yield pd.DataFrame({"doc_id": part["doc_id"], "y": part["y"], "terms": [t.astype(np.int16).tobytes() for t in np.split(term, cuts)],
                                    "counts": [c.astype(np.int32).tobytes() for c in np.split(count, cuts)]})

    got = rows.mapInPandas(run, "doc_id long, y double, terms binary, counts binary")
    got = got.orderBy(F.xxhash64("doc_id"), "doc_id", "terms").limit(cfg.max_labelled).toPandas()
    if not len(got):
        return None
    idf, w = weighted(list(got["terms"]), list(got["counts"]), cfg.block)
    space = fit(idf, w, got["y"].to_numpy(), cfg)
    trim()
    return space


def score(docs: DataFrame, space: Space | None, cfg: Voting = Voting(), text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with one more column; no shuffle."""
    if space is None:
        return docs.withColumn(out, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(space)

    @F.pandas_udf("double")
    def voted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            scores = np.zeros(len(texts))
            for first, enc in chunks(texts):
                for lo in range(0, len(enc), cfg.block):
                    some = enc[lo:lo + cfg.block]
                    scores[first + lo:first + lo + len(some)] = vote(matrix(*term_counts(some), len(some)), shared.value, cfg)
            yield pd.Series(scores)

    return docs.withColumn(out, voted(F.col(text_col)))


def report(docs: DataFrame, labels: DataFrame, cfg: Voting = Voting()) -> DataFrame:
    """The columns of ``op10``; rows without id are not held out."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, cfg), cfg)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
