"""Token counts by a compiled finite-state tokenizer.

The merge rules of a piece vocabulary are compiled, state by state as texts
need them, into a deterministic transducer over characters whose transitions
carry the change in the number of tokens. What makes this exact: the last
token of the encoding of a prefix is the one vocabulary piece that ends there
and is compatible with the last token before it (two tokens are compatible if
encoding their concatenation gives them back). A state holds, for every
suffix that may still grow into a piece, that suffix, the last token before
it and the tokens since; states that agree in this are one state. Between two
characters that stand side by side in no piece the automaton starts afresh.

No piece reaches from a letter into a following space mark, nor over a
character that the vocabulary lacks, so every state map of a text chunk with
such a boundary forgets where it started: it is (characters before the first
boundary, tokens between, characters after the last). Such maps compose
associatively, and a prefix scan over a text's chunks gives its count.

Null and empty texts have no tokens; texts are counted whole; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"


@dataclass(frozen=True)
class ChunkMap:
    """State map of a chunk. ``tokens`` is None if it has no boundary (then
    ``head`` is all of it)."""
    head: str
    tokens: int | None
    tail: str


class State(dict):
    """One state; its entries are the transitions compiled so far: character
    -> (next state, tokens added)."""

    __slots__ = ("compiler", "suffix", "marks")

    def __init__(self, compiler: Transducer, suffix: str, marks: tuple):
        super().__init__()
        self.compiler, self.suffix, self.marks = compiler, suffix, marks

    def __missing__(self, char: str) -> tuple[State, int]:
        move = self[char] = self.compiler.move(self, char)
        return move


class Counted(dict):
    """Segment -> tokens, counted when first asked for."""

    def __init__(self, compiler: Transducer):
        super().__init__()
        self.compiler = compiler

    def __missing__(self, segment: str) -> int:
        n = self[segment] = self.compiler.run(segment)
        return n


class Transducer:
    STATES, SEGMENTS = 400_000, 1_000_000  # kept before a fresh start

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
                      if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.letters = {c for p in self.score for c in p}
        self.prefixes = {p[:k] for p in self.score for k in range(1, len(p))}
        self.inside = {a + b for p in self.score for a, b in zip(p, p[1:])}  # neighbours in some piece
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.score) or "\n" in self.letters:
            raise ValueError("the vocabulary has pieces across the boundaries that the compiler relies on")
        self.segment = re.compile(r" *[^ \n]+|\n| +")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.single: dict[str, bool] = {}
        self._fresh()

    def _fresh(self) -> None:
        self.start = State(self, "", ((0, "", 0),))
        self.states = {("", self.start.marks): self.start}
        self.counted = Counted(self)

    def merge(self, text: str) -> list[str]:
        """Encoding of a short string by the merge rules themselves."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                x = score.get(parts[i] + parts[i + 1])
                if x is not None and (best is None or x > best):
                    best, at = x, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, last: str, piece: str) -> bool:
        own = self.single.get(piece)
        if own is None:
            own = self.single[piece] = len(self.merge(piece)) == 1
        if not own or not last or last[-1] + piece[0] not in self.inside:
            return own
        key = (last, piece)
        if key not in self.pairs:
            self.pairs[key] = self.merge(last + piece) == [last, piece]
        return self.pairs[key]

    def move(self, state: State, char: str) -> tuple[State, int]:
        """Compile one transition: (next state, tokens added)."""
        if char == " ":
            char = SPACE
        suffix, marks = state.suffix, state.marks
        if char not in self.letters:  # byte pieces; nothing reaches across
            return self.start, len(char.encode("utf-8", "surrogatepass"))
        if suffix and suffix[-1] + char not in self.inside:  # nothing reaches across
            return self.start[char]
        # marks: (length of a live suffix, last token before it, tokens since)
        n = len(suffix)
        end = next(((suffix[n - d:] + char, since) for d, last, since in reversed(marks)
                    if suffix[n - d:] + char in self.score and self._fits(last, suffix[n - d:] + char)), None)
        if end is None:
            raise ValueError(f"no piece ends at {char!r} after {suffix!r}")
        piece, since = end
        added = 1 - since
        live = [(d + 1, last, s + added) for d, last, s in marks if suffix[n - d:] + char in self.prefixes]
        # the last character stays known even where no piece goes on from it
        deepest = live[-1][0] if live else 1
        new = ((suffix + char)[n + 1 - deepest:], ((0, piece, 0), *live))
        if new not in self.states:
            self.states[new] = State(self, *new)
        return self.states[new], added

    def run(self, segment: str) -> int:
        """Tokens of a segment that starts at a boundary."""
        state, tokens = self.start, 0
        for c in segment:
            state, n = state[c]
            tokens += n
        return tokens

    def _sum(self, segments: list[str]) -> int:
        if len(self.states) > self.STATES or len(self.counted) > self.SEGMENTS:
            self._fresh()
        return sum(map(self.counted.__getitem__, segments))

    def chunk_map(self, chunk: str) -> ChunkMap:
        segments = self.segment.findall(chunk)
        if len(segments) < 2:
            return ChunkMap(chunk, None, "")
        return ChunkMap(segments[0], self._sum(segments[1:-1]), segments[-1])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of chunk a followed by chunk b."""
        middle = (a.head if a.tokens is None else a.tail) + b.head
        cut = self.segment.findall(middle)
        if a.tokens is None and b.tokens is None:
            return self.chunk_map(middle)
        if a.tokens is None:
            return ChunkMap(cut[0], b.tokens + self._sum(cut[1:]), b.tail) if cut else ChunkMap("", b.tokens, b.tail)
        if b.tokens is None:
            return ChunkMap(a.head, a.tokens + self._sum(cut[:-1]), cut[-1] if cut else "")
        return ChunkMap(a.head, a.tokens + self._sum(cut) + b.tokens, b.tail)

    def scan(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """Inclusive prefix scan by doubling: log2(n) rounds of independent
        compositions."""
        gap = 1
        while gap < len(maps):
            maps = [m if i < gap else self.compose(maps[i - gap], m) for i, m in enumerate(maps)]
            gap *= 2
        return maps

    def total(self, m: ChunkMap) -> int:
        return self._sum(self.segment.findall(m.head)) + (m.tokens or 0) + self._sum(self.segment.findall(m.tail))

    def count(self, text: str, chunk: int = 1 << 16) -> int:
        if not text:
            return 0
        text = " " + text.replace(SPACE, " ")
        if len(text) <= chunk:
            return self._sum(self.segment.findall(text))
        return self.total(self.scan([self.chunk_map(text[i:i + chunk]) for i in range(0, len(text), chunk)])[-1])


_held: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per worker process: what a task compiled, the next one reuses."""
    if path not in _held:
        _held[path] = Transducer(path)
    return _held[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit; no shuffle."""
    @F.pandas_udf("long")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = transducer(model_path)
        for texts in parts:
            yield pd.Series([t.count(x) if isinstance(x, str) else 0 for x in texts], dtype="int64")

    n = counted(F.col(text_col))
    return docs.withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")).withColumn("n_tokens", n).withColumn(
        "over_limit", F.col("n_tokens") > limit)
