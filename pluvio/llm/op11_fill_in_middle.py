"""Fill-in-the-middle transformation with a sparse exception index.

A text is cut at two places into prefix, middle and suffix, and written as
prefix-suffix-middle or suffix-prefix-middle between markers. All work is
done on the UTF-8 bytes of a whole Arrow batch. Only the multibyte
characters are recorded: the byte position of each and the bytes it has
beyond one, summed up. Between them a character is a byte, so a cut converts
from bytes to code points, or back, by one binary search in that index and a
subtraction.

Places are counted in units: lines (each with its line break; a last one may
have none) or characters. The cuts and the form of a document are drawn from
the SHA-256 of the seed and its id, so they do not depend on the run.

Null texts are empty ones; empty texts and texts that contain a marker stay
plain; texts of any length are cut whole; a null id draws as an empty one;
repeated rows give equal rows; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.textvec import trim


@dataclass(frozen=True)
class Fim:
    seed: int = 7
    percent: int = 100  # of documents that are transformed
    spm_percent: int = 50  # of those, written suffix first
    unit: str = "line"  # or "char"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class ByteIndex:
    """Exceptions to "a character is a byte" in a UTF-8 buffer."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)  # lead bytes of multibyte characters
        lead = data[self.at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(extra)])
        self.char_at = self.at - self.excess[:-1]

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """Code points before byte positions that begin a character."""
        return byte - self.excess[np.searchsorted(self.at, byte)]

    def bytes(self, char: np.ndarray) -> np.ndarray:
        """Byte positions of code points."""
        return char + self.excess[np.searchsorted(self.char_at, char)]


class LineUnits:
    """Line ends of the texts ``[bounds[i], bounds[i + 1])`` of a buffer."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, index: ByteIndex):
        self.bounds, self.ends = bounds, np.flatnonzero(data == 10) + 1
        self.first = np.searchsorted(self.ends, bounds[:-1], side="right")
        self.closed = np.searchsorted(self.ends, bounds[1:], side="right") - self.first
        last = np.where(bounds[1:] > bounds[:-1], data[np.maximum(bounds[1:] - 1, 0)] if len(data) else 0, 10)
        self.count = self.closed + (last != 10)

    def byte_after(self, units: np.ndarray) -> np.ndarray:
        inner = (units > 0) & (units <= self.closed)
        out = np.where(units == 0, self.bounds[:-1], self.bounds[1:])
        out[inner] = self.ends[(self.first + units - 1)[inner]]
        return out


class CharUnits:
    def __init__(self, data: np.ndarray, bounds: np.ndarray, index: ByteIndex):
        self.index, self.begin = index, index.chars(bounds[:-1])
        self.count = index.chars(bounds[1:]) - self.begin

    def byte_after(self, units: np.ndarray) -> np.ndarray:
        return self.index.bytes(self.begin + units)


UNITS = {"line": LineUnits, "char": CharUnits}


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column without copying its text."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1)
    return np.frombuffer(data if data is not None else b"", dtype=np.uint8)[:int(bounds[-1])], bounds.astype(np.int64)


def holding(data: np.ndarray, bounds: np.ndarray, token: bytes) -> np.ndarray:
    """Which texts contain ``token`` whole."""
    at = np.flatnonzero(data[:max(len(data) - len(token) + 1, 0)] == token[0])
    for k in range(1, len(token)):
        at = at[data[at + k] == token[k]]
    at = at[at >= bounds[0]]
    of = np.searchsorted(bounds, at, side="right") - 1
    found = np.zeros(len(bounds) - 1, dtype=bool)
    found[of[at + len(token) <= bounds[of + 1]]] = True
    return found


def transformed(ids: pa.Array, texts: pa.Array, draws: np.ndarray, cfg: Fim, names: list[str], limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of (id, n, form, prefix_chars, middle_chars, output), in batches
    of about ``limit`` bytes. ``draws``: four numbers for each text."""
    data, bounds = text_buffer(texts)
    index = ByteIndex(data)
    units = UNITS[cfg.unit](data, bounds, index)
    pick = np.sort(draws[:, :2] % (units.count + 1)[:, None], axis=1)
    a, z = units.byte_after(pick[:, 0]), units.byte_after(pick[:, 1])
    plain = (bounds[1:] == bounds[:-1]) | (draws[:, 2] % 100 >= cfg.percent)
    marks = [m.encode() for m in (cfg.prefix, cfg.suffix, cfg.middle)]
    for m in marks:
        plain |= holding(data, bounds, m)
    spm = draws[:, 3] % 100 < cfg.spm_percent
    prefix, middle = index.chars(a) - index.chars(bounds[:-1]), index.chars(z) - index.chars(a)
    view, (p, s, m) = memoryview(data), marks
    out, size, first = [], 0, 0
    for i in range(len(texts)):
        lo, hi = bounds[i], bounds[i + 1]
        if plain[i]:
            out.append(bytes(view[lo:hi]))
        elif spm[i]:
            out.append(b"".join((s, view[z[i]:hi], p, view[lo:a[i]], m, view[a[i]:z[i]])))
        else:
            out.append(b"".join((p, view[lo:a[i]], s, view[z[i]:hi], m, view[a[i]:z[i]])))
        size += len(out[-1])
        if size > limit or i == len(texts) - 1:
            part = slice(first, i + 1)
            form = np.where(plain[part], "plain", np.where(spm[part], "spm", "psm"))
            yield pa.RecordBatch.from_arrays(
                [ids[part], pa.array(units.count[part], pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix[part], pa.int64(), mask=plain[part]), pa.array(middle[part], pa.int64(), mask=plain[part]),
                 pa.array(out, pa.binary()).cast(pa.string())], names=names)
            out, size, first = [], 0, i + 1


def draws_of(doc_id: Column, seed: int) -> list[Column]:
    """h1 to h4: the first four 8-digit groups of the hex SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(docs: DataFrame, cfg: Fim = Fim(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): ``n`` units, the
    code points of prefix and middle (null if plain), and the new text. No
    shuffle."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                draws = np.stack([b.column(2 + k).to_numpy() for k in range(4)], axis=1)
                yield from transformed(b.column(0), b.column(1), draws, cfg, names)
        trim()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *draws_of(F.col(id_col), cfg.seed))
    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column, cfg: Fim = Fim()) -> Column:
    """The text again, from output and form alone."""
    marks = "|".join(rf"\Q{m}\E" for m in (cfg.prefix, cfg.suffix, cfg.middle))
    part = F.split(output, marks, -1)
    first, second, third = (F.get(part, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, third, second)).when(form == "spm", F.concat(second, third, first)).otherwise(output)


def report(docs: DataFrame, cfg: Fim = Fim()) -> DataFrame:
    """The digest columns of ``op11``."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return transform(docs, cfg).select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                                       digest(restored(F.col("output"), F.col("form"), cfg)).alias("restored_sha256"))


__all__ = ["ByteIndex", "Fim", "report", "restored", "transform"]
