"""Vectorised text splitting for the operators that work in Arrow batches.

Texts are handled as one UTF-8 byte buffer; every step is a numpy pass over
bytes or words, never a Python loop over words.
"""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[65:91] = True
_WORD[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def trim() -> None:
    """Hand free memory back to the system at the end of a partition; the
    worker process stays and would keep it otherwise. Does nothing where the
    C library or pyarrow lacks the call."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if release is not None:
        release(0)


LONG = 4 << 20  # bytes of a text that are handled at once
_GAP = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_inv = pow(int(_BASE), -1, 1 << 64)


def chunks(texts, limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, encoded texts) with about ``limit`` bytes."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if held and size + len(b) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield first, held


def word_hashes(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every lower-cased word of all texts in order, and the
    number of words of each text. Words are runs of digits, letters and
    non-ASCII characters. Polynomial in an odd base modulo 2^64, finalised."""
    if any(len(b) > LONG for b in encoded):
        per_text = [np.concatenate([_one_buffer([p])[0] for p in pieces(b)]) for b in encoded]
        return np.concatenate(per_text), np.array([len(w) for w in per_text])
    return _one_buffer(encoded)


def pieces(text: bytes) -> list[bytes]:
    """A text in pieces of about half of LONG, cut behind the next byte that
    is in no word (a word longer than that stays whole)."""
    out, at = [], 0
    while at < len(text):
        cut = _GAP.search(text, at + LONG // 2)
        end = cut.end() if cut else len(text)
        out.append(text[at:end])
        at = end
    return out or [b""]


def _one_buffer(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = b" ".join(encoded) + b" "
    buf = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
    is_word = _WORD[buf]
    edge = np.flatnonzero(is_word[1:] != is_word[:-1]) + 1
    if len(buf) and is_word[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    at = np.cumsum([0] + [len(b) + 1 for b in encoded])
    counts = np.diff(np.searchsorted(starts, at))
    acc = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * _powers(_BASE, len(buf)), dtype=np.uint64, out=acc[1:])
    raw = acc[ends] - acc[starts]
    shift = _powers(np.uint64(_inv), len(buf) + 1)
    return mix(raw * shift[starts]), counts


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text and their number; a text of
    fewer words, but not none, is one shingle."""
    n_out = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    first = np.cumsum(counts) - counts
    offs = np.arange(n_out.sum()) - np.repeat(np.cumsum(n_out) - n_out, n_out)
    start = np.repeat(first, n_out) + offs
    left = np.repeat(counts, n_out)
    out = np.full(len(start), 0x5851F42D4C957F2D, dtype=np.uint64)
    for j in range(k):
        has = j < left
        nxt = np.where(has, hashes[np.minimum(start + j, max(len(hashes) - 1, 0))], np.uint64(0)) if len(hashes) else np.zeros(len(start), np.uint64)
        out = mix(out * _BASE + nxt + np.uint64(j))
    return out, n_out
