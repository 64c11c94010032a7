"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to one string. The
operator renders the successive prefixes of a conversation, compares each
output with the one before, and so locates the span that each turn added,
without knowing how the template works. A template that changes what it has
already written is detected: the turn is marked ``rewrites`` and gets no
span. The loss mask covers the part of an assistant turn's span that holds
its escaped text.

Rows without role count as role ''; null texts are empty; equal (conv_id,
turn) rows stay and are ordered by role and text; a conversation without rows
does not exist; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

# The marks of the template and the characters with which it
# and the known control strings (</s>, [INST], <<SYS>> ...) begin. A template
# that only appends may state how many turns it looks back (``looks_back``).
OPEN, CLOSE, SEP = "<|turn|>", "<|end|>", "\n"
PROBE = "\x00"
CONTEXT = 8  # turns
_ESCAPED = re.compile(r"[\\<\[]")
_CODED = re.compile(r"([<\[])\\|\\(\\)|\\n")


def escape(text: str) -> str:
    """Reversible: a backslash goes behind every backslash, '<' and '[', so
    neither a mark of the template nor a control string can remain."""
    return _ESCAPED.sub(lambda m: m[0] + "\\", text)


def escape_role(role: str) -> str:
    """As ``escape``; line breaks too, since a line break ends the role."""
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _CODED.sub(lambda m: m[1] or m[2] or "\n", text)


def marked_template(turns: Turns) -> str:
    """Default template: <|turn|>role newline text <|end|> newline."""
    return "".join(f"{OPEN}{escape_role(role)}{SEP}{escape(text)}{CLOSE}{SEP}" for role, text in turns)


marked_template.looks_back = CONTEXT  # a turn's part is the same after any of the turns before


def spans(turns: Turns, template: Template = marked_template) -> tuple[str, list[tuple[int, int] | None], int]:
    """The output, for each turn its (start, end) there, and the number of
    turns of context that rendering a turn needs (0: all before it). A turn's
    span is None if its rendering rewrote the output before it, or if a later
    one rewrote it.

    Rendering every prefix takes the square of the turns, and nothing less
    shows what an unknown template does to some prefix. So it is spared, for
    conversations of any length, only where the template states by
    ``looks_back`` that it appends and how many turns before a turn its part
    depends on at most: prefixes of these turns are rendered, and their spans
    must still be the full rendering when put together."""
    output, context = template(turns), getattr(template, "looks_back", 0)
    if context:
        at, found = 0, []
        for k in range(len(turns)):
            recent = turns[max(0, k - context):k + 1]
            before, now = template(recent[:-1]), template(recent)
            at = len(before) if k == 0 else at
            size = len(now) - len(before)
            if not now.startswith(before) or output[at:at + size] != now[len(before):]:
                break
            found.append((at, at + size))
            at += size
        if len(found) == len(turns) and at == len(output) and output.startswith(template([])):
            return output, found, context
    before, found = template([]), []
    for k in range(1, len(turns) + 1):
        now = template(turns[:k])
        if now.startswith(before):
            found.append((len(before), len(now)))
        else:
            same = next((i for i, (a, b) in enumerate(zip(before, now)) if a != b), min(len(before), len(now)))
            found = [s if s is not None and s[1] <= same else None for s in found] + [None]
        before = now
    return output, found, 0


def text_span(turns: Turns, shown: str, start: int, template: Template) -> tuple[int, int] | None:
    """Where the last turn's text stands in ``shown``, what that turn added:
    the same turns are rendered with a probe character for that text; what
    stands before and after the probe must frame the text."""
    probed = template([*turns[:-1], (turns[-1][0], PROBE)])[len(template(turns[:-1])):]
    at = probed.find(PROBE)
    if at < 0 or probed[:at] != shown[:at]:
        return None
    end = len(shown) - (len(probed) - at - len(PROBE))
    return (start + at, start + end) if end >= at and shown[end:] == probed[at + len(PROBE):] else None


def read_back(output: str, found: list[tuple[int, int] | None]) -> Turns:
    """The turns, from the output and the spans alone."""
    turns = []
    for s in found:
        role, _, rest = output[s[0] + len(OPEN):s[1] - len(CLOSE) - len(SEP)].partition(SEP)
        turns.append((unescape(role), unescape(rest)))
    return turns


def format_one(turns: Turns, template: Template = marked_template) -> dict:
    output, found, context = spans(turns, template)
    rewritten = sum(s is None for s in found)
    row = {"n_turns": len(turns), "formatted": output, "n_rewritten": rewritten, "formatted_chars": len(output),
           "span_starts": [s[0] if s else -1 for s in found], "span_ends": [s[1] if s else -1 for s in found]}
    masks = []
    if not rewritten:
        masks = [text_span(turns[max(0, k - context) if context else 0:k + 1], output[s[0]:s[1]], s[0], template)
                 for k, s in enumerate(found) if turns[k][0] == "assistant"]
        masks = [m for m in masks if m is not None]
    return row | {"loss_starts": [m[0] for m in masks], "loss_ends": [m[1] for m in masks]}


FORMATTED = ("conv_id long, n_turns long, formatted string, n_rewritten long, formatted_chars long, span_starts array<long>, "
             "span_ends array<long>, loss_starts array<long>, loss_ends array<long>")


def format_conversations(conv: DataFrame, template: Template = marked_template, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: output, spans of the turns, loss spans.

    Turns meet by conversation in one shuffle and are streamed in order, one
    conversation at a time; a task holds one conversation, not a group of
    them."""
    t = conv.select(F.col(id_col).alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, turns, out = None, [], []
        for b in batches:
            ids = b["conv_id"].astype(object).where(b["conv_id"].notna(), None)
            for c, role, text in zip(ids, b["role"], b["text"]):
                if turns and c != now:
                    out.append({"conv_id": now} | format_one(turns, template))
                    turns = []
                now = c
                turns.append((role, text))
            if len(out) >= 256:
                yield _frame(out)
                out = []
        if turns:
            out.append({"conv_id": now} | format_one(turns, template))
        if out:
            yield _frame(out)

    return t.mapInPandas(run, FORMATTED)


def _frame(rows: list[dict]) -> pd.DataFrame:
    f = pd.DataFrame(rows)
    f["conv_id"] = f["conv_id"].astype("Int64")
    return f


def digests(formatted: DataFrame) -> DataFrame:
    """The digest columns of ``op9``, read back from outputs and spans."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            turns_sha, loss_n, loss_sha = [], [], []
            for out, s, e, ls, le in zip(b["formatted"], b["span_starts"], b["span_ends"], b["loss_starts"], b["loss_ends"]):
                turns = read_back(out, list(zip(s, e))) if all(x >= 0 for x in s) else []
                turns_sha.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                loss = "".join(unescape(out[x:y]) for x, y in zip(ls, le))
                loss_n.append(len(loss))
                loss_sha.append(hashlib.sha256(loss.encode()).hexdigest())
            yield pd.DataFrame({"conv_id": b["conv_id"].astype("Int64"), "n_turns": b["n_turns"], "turns_sha256": turns_sha, "loss_chars": loss_n,
                                "loss_sha256": loss_sha, "formatted_chars": b["formatted_chars"], "n_rewritten": b["n_rewritten"]})
    return formatted.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                      "formatted_chars long, n_rewritten long")
