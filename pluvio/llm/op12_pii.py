"""Personal data by patterns and a character-level BiLSTM-CRF.

Every whole text gives its pattern spans (e-mail and IP addresses, card and
phone numbers) and the spans of a tagger that reads it in windows.

The tagger (``crf_tagger``) is trained in numpy from labelled spans: those of
the patterns in at most ``max_train`` documents chosen by hash, each also with
its span rewritten in a way the patterns do not know (no plus, other
separators, "(at)") and with look-alikes that are no personal data (dates,
versions, prices, hashes). Labelled spans of one's own can be given instead.

Texts are decoded in windows of ``width`` characters that overlap by half. The
result is that of all windows of the text, though most need not be decoded: a
span that is kept is ``valid``, so it holds a digit, an @, "(at)" or "[at]",
and only spans that overlap or touch it, or one another in a chain to it, have
a say in whether and where it stays. So the windows with such a mark are
decoded, then, as long as there are some, those at a span that was found.

The windows of a document are reconciled together: a span that a window's
edge cuts gives way to the whole one of the next window, pieces that no window
sees whole are joined, equal spans count once with their best marginal, and
the set of disjoint spans with the largest sum of marginals stays. A tagged
span is kept if its text, without separators, is a valid value of its kind
(an address with a domain, four parts up to 255, 13 to 19 digits that pass
Luhn, 9 to 15 digits), if no letter or digit stands beside it, and if it does
not touch a pattern span; pattern spans always stay.

Null texts are empty ones and have no spans; texts of any length are read
whole; repeated rows give equal rows, null ids stay rows; an empty table gives
no rows; without labelled spans there is no tagger and the patterns stand
alone; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import stored
from pluvio.llm.crf_tagger import Tagger, TaggerConfig, codes_of, train_tagger
from pluvio.llm.textvec import trim

KINDS = ("email", "ip", "card", "phone")  # fixed order


@dataclass(frozen=True)
class Pii:
    width: int = 128  # characters of a window
    train_width: int = 64
    max_train: int = 800  # documents that give training windows: the bound of what reaches the driver
    least: float = 0.5  # mean marginal of a span that counts
    windows_at_once: int = 256
    tagger: TaggerConfig = field(default_factory=TaggerConfig)


# Possessive, and anchored where a match can begin at all, so that no text takes more than a few passes.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGNAL = re.compile("[0-9@]")
_MARK = re.compile(r"[0-9@]|\(at\)|\[at\]")  # ``valid`` takes no text without one


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part contains no @, so a match is one @ with the characters
    before it (not before the end of the last match) and a domain behind."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(last, at + 1))


def card_shapes(text: str) -> Iterator[re.Match]:
    return (m for m in _CARD.finditer(text) if 13 <= len(digits_of(m[0])) <= 19)


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out = [(0, *s) for s in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    out += [(2, m.start(), m.end()) for m in card_shapes(text) if luhn(digits_of(m[0]))]
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def regions_of(text: str, width: int) -> list[tuple[int, str]]:
    """(start, text) of the joined windows, placed at multiples of half a
    window, that hold a digit or an @: pieces to train on."""
    half, at = width // 2, np.array([m.start() for m in _SIGNAL.finditer(text)], dtype=np.int64)
    if not len(at):
        return []
    cells = np.unique(np.concatenate([at // half, np.maximum(at // half - 1, 0)]))  # a window is two cells
    cuts, out = np.flatnonzero(np.diff(cells) > 1) + 1, []
    for run in np.split(cells, cuts):
        lo, hi = int(run[0]) * half, (int(run[-1]) + 2) * half
        out.append((lo, text[lo:hi]))
    return out


_SPANS = "array<struct<kind:int,start:int,end:int>>"
_REGIONS = "array<struct<start:int,text:string>>"


def prepared(docs: DataFrame, cfg: Pii, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, hash, base, regions) of every row, to choose training pieces."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            base, regions, size, first = [], [], 0, 0
            texts = b["text"].tolist()
            for i, t in enumerate(texts):
                t = t if isinstance(t, str) else ""
                if _SIGNAL.search(t):
                    base.append([{"kind": k, "start": s, "end": e} for k, s, e in pattern_spans(t)])
                    regions.append([{"start": lo, "text": r} for lo, r in regions_of(t, cfg.width)])
                    size += sum(len(r["text"]) for r in regions[-1])
                else:
                    base.append([])
                    regions.append([])
                if size > 8 << 20 or i == len(texts) - 1:
                    part = b.iloc[first:i + 1]
                    yield pd.DataFrame({"doc_id": part["doc_id"], "hash": part["hash"], "base": base, "regions": regions})
                    base, regions, size, first = [], [], 0, i + 1
        trim()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("hash"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, f"doc_id {kind}, hash long, base {_SPANS}, regions {_REGIONS}")


# --- training -----------------------------------------------------------------

def _grouped(d: str, rnd: np.random.Generator, seps: list[str]) -> str:
    sep, at, out = rnd.choice(seps), 0, []
    while at < len(d):
        n = int(rnd.choice([4, 4, 4, 3, 2])) if len(seps) > 4 else 4
        out.append(d[at:at + n])
        at += n
    return sep.join(out)


def rewritten(kind: int, s: str, rnd: np.random.Generator) -> str:
    """The same datum in a writing that the patterns miss."""
    d = digits_of(s)
    if kind == 0:
        local, _, domain = s.partition("@")
        return f"{local}{rnd.choice([' @ ', '(at)', ' (at) ', '[at]', ' @', '@ '])}{domain}"
    if kind == 1:
        return rnd.choice([" . ", "[.]", "(.)", ". "]).join(s.split("."))
    if kind == 2:
        return _grouped(d, rnd, [".", "  ", "/", "–"])
    return rnd.choice([f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}", f"{d[-10:-7]}.{d[-7:-4]}.{d[-4:]}",
                       f"{d[:-10]} ({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}".strip(), f"{d[-10:-7]} {d[-7:-4]} {d[-4:]}", f"00{d[:-7]}/{d[-7:]}"])


def lookalike(rnd: np.random.Generator) -> str:
    """Something with digits or an @ that is no personal data."""
    n = lambda lo, hi: str(rnd.integers(lo, hi))
    digits = lambda k: "".join(rnd.choice(list("0123456789"), k))
    kind = rnd.integers(0, 10)
    if kind == 0:
        return f"{n(1900, 2100)}-{n(1, 13).zfill(2)}-{n(1, 32).zfill(2)}"
    if kind == 1:
        return f"{n(0, 24).zfill(2)}:{n(0, 60).zfill(2)}:{n(0, 60).zfill(2)}"
    if kind == 2:
        return f"{n(0, 30)}.{n(0, 30)}.{n(0, 30)}"
    if kind == 3:
        return f"{n(1, 999)},{digits(3)}.{digits(2)}"
    if kind == 4:
        return "".join(rnd.choice(list("0123456789abcdef"), int(rnd.integers(12, 33))))
    if kind == 5:
        return digits(int(rnd.integers(1, 9)))
    if kind == 6:
        return digits(int(rnd.integers(20, 28)))
    if kind == 7:
        return "@" + "".join(rnd.choice(list("abcdefghijkl"), int(rnd.integers(3, 10))))
    if kind == 8:
        return f"{n(1900, 2100)}-{n(1900, 2100)}"
    return f"{n(1, 40)}/{n(1, 40)} {n(1, 99)}%"


def training_windows(rows: list[tuple[str, list[tuple[int, int, int]]]], cfg: Pii) -> tuple[np.ndarray, np.ndarray]:
    """(codes, labels) from (text, labelled spans) pieces. Each piece gives a
    window as it stands, one with its spans rewritten and one with look-alikes
    in their place; a window begins at a random place before a span."""
    rnd = np.random.default_rng(cfg.tagger.seed)
    width, codes, labels = cfg.train_width, [], []

    def add(parts: list[tuple[str, int | None]]) -> None:
        text, label = "".join(p for p, _ in parts), []
        for p, k in parts:
            label += [0] * len(p) if k is None else [1 + 2 * k] + [2 + 2 * k] * (len(p) - 1)
        at = next((i for i, x in enumerate(label) if x), len(text) // 2)
        lo = max(0, min(at - int(rnd.integers(0, 24)), len(text)))
        if lo and label[lo] and label[lo] % 2 == 0:
            lo = at
        codes.append(codes_of(text[lo:lo + width], width))
        padded = np.zeros(width, dtype=np.int64)
        padded[:len(label[lo:lo + width])] = label[lo:lo + width]
        labels.append(padded)

    for text, spans in rows:
        disjoint, at = [], 0
        for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
            if s >= at and e <= len(text):
                disjoint.append((k, s, e))
                at = e
        for how in (0, 1, 2):
            parts, at = [], 0
            for k, s, e in disjoint:
                new = text[s:e] if how == 0 else rewritten(k, text[s:e], rnd) if how == 1 else lookalike(rnd)
                parts += [(text[at:s], None), (new, None if how == 2 else k)]
                at = e
            if not disjoint and how:
                middle = len(text) // 2
                parts, at = [(text[:middle] + " " + lookalike(rnd) + " ", None)], middle
            add([*parts, (text[at:], None)])
    return np.array(codes), np.array(labels)


def pieces_of(ready: DataFrame, cfg: Pii) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """At most about ``1.5 * max_train`` pieces of text (twice the training
    width each) with their pattern spans, from documents chosen by hash, two
    thirds around a span and a third from regions without one."""
    size = 2 * cfg.train_width

    def run(batches):
        for b in batches:
            out = []
            for h, base, regions in zip(b["hash"], b["base"], b["regions"]):
                base = [(int(s["kind"]), int(s["start"]), int(s["end"])) for s in base]
                target = base[h % len(base)][1] if base else int(regions[h % len(regions)]["start"]) + cfg.width // 2
                region = next(r for r in regions if r["start"] <= target < r["start"] + max(len(r["text"]), 1) + cfg.width)
                lo = max(int(region["start"]), target - size // 2)
                text = region["text"][lo - int(region["start"]):][:size]
                inside = [(k, s - lo, e - lo) for k, s, e in base if lo <= s and e <= lo + len(text)]
                # a span cut by the piece's end would be a false negative
                end = min([s - lo for _, s, e in base if s < lo + len(text) < e], default=len(text))
                begin = max([e - lo for _, s, e in base if s < lo < e], default=0)
                text, inside = text[begin:end], [(k, s - begin, e - begin) for k, s, e in inside if begin <= s and e <= end]
                # a tagger cannot add up check digits, so it learns the shape of a card; validity is looked at afterwards
                inside += [(2, m.start(), m.end()) for m in card_shapes(text) if 0 < m.start() and m.end() < len(text) and not luhn(digits_of(m[0]))]
                out.append({"hash": h, "text": text, "spans": [{"kind": k, "start": s, "end": e} for k, s, e in inside]})
            if out:
                yield pd.DataFrame(out)
    got = []
    for rows, share in ((ready.where("size(base) > 0"), 2 / 3), (ready.where("size(base) = 0 AND size(regions) > 0"), 1 / 3)):
        n = rows.count()
        below = 1.5 * cfg.max_train * share / max(n, 1)
        unit = (F.pmod(F.xxhash64(F.lit(5), "hash"), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
        some = rows.where(unit < below).select("hash", "base", "regions").mapInPandas(run, f"hash long, text string, spans {_SPANS}")
        got += some.dropDuplicates(["hash"]).collect()
    return [(r.text, [(s.kind, s.start, s.end) for s in r.spans]) for r in sorted(got, key=lambda r: (r.hash, r.text))]


def fit(pieces: list[tuple[str, list[tuple[int, int, int]]]], cfg: Pii = Pii()) -> Tagger | None:
    """A tagger from (text, [(kind, start, end)]); None without any span."""
    if not any(spans for _, spans in pieces):
        return None
    return train_tagger(*training_windows(pieces, cfg), cfg.tagger)


# --- decoding -----------------------------------------------------------------

def window_spans(path: np.ndarray, prob: np.ndarray, length: int) -> Iterator[tuple[int, int, int, float]]:
    """(kind, start, end, mean marginal) of a label path."""
    t = 0
    while t < length:
        if path[t] % 2 == 1:
            end = t + 1
            while end < length and path[end] == path[t] + 1:
                end += 1
            yield int(path[t]) // 2, t, end, float(prob[t:end].mean())
            t = end
        else:
            t += 1


def reconciled(found: list[tuple[int, int, int, float, bool]], least: float) -> list[tuple[int, int, int, float]]:
    """Spans of a document from those of all its windows: (kind, start, end,
    score, cut by an edge)."""
    whole: dict[tuple[int, int, int], float] = {}
    for k, s, e, p, cut in found:
        if not cut:
            whole[k, s, e] = max(whole.get((k, s, e), 0.0), p)
    pieces = sorted((k, s, e, p) for k, s, e, p, cut in found if cut and not any(k == k2 and s < e2 and s2 < e for k2, s2, e2 in whole))
    joined: list[list] = []
    for k, s, e, p in pieces:
        if joined and joined[-1][0] == k and s <= joined[-1][2]:
            joined[-1][2], joined[-1][3] = max(joined[-1][2], e), min(joined[-1][3], p)
        else:
            joined.append([k, s, e, p])
    every = sorted([(e, s, k, p) for (k, s, e), p in whole.items() if p >= least] + [(e, s, k, p) for k, s, e, p in joined if p >= least])
    ends, best, took = [x[0] for x in every], [0.0], []
    for i, (e, s, k, p) in enumerate(every):
        before = int(np.searchsorted(ends[:i], s, side="right"))
        take = best[before] + p
        took.append((take > best[i], before))
        best.append(max(take, best[i]))
    out, i = [], len(every)
    while i:
        yes, before = took[i - 1]
        if yes:
            e, s, k, p = every[i - 1]
            out.append((k, s, e, p))
        i = before if yes else i - 1
    return out[::-1]


def valid(kind: int, s: str) -> bool:
    """Is the text, without separators, a value of its kind?"""
    d = digits_of(s)
    if kind == 0:
        mail = re.sub(r"\s*(?:@|\(at\)|\[at\])\s*", "@", s)
        return mail.count("@") == 1 and [*emails(mail)] == [(0, len(mail))]
    if any(c.isalpha() for c in s):
        return False
    if kind == 1:
        parts = re.split(r"[^0-9]+", s)
        return len(parts) == 4 and all(p and len(p) < 4 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15


def marked_cells(regions: list[tuple[int, str]], half: int) -> set[int]:
    """Numbers of the half windows with a character of a mark."""
    return {c for lo, text in regions for m in _MARK.finditer(text) for c in range((lo + m.start()) // half, (lo + m.end() - 1) // half + 1)}


def tagged(tagger: Tagger, regions: list[list[tuple[int, str]]], lengths: list[int], cfg: Pii) -> list[list[tuple[int, int, int, float]]]:
    """Reconciled spans of each document from its regions (the whole text is
    one region): of the windows that hold a mark, and of those that a found
    span overlaps or touches. Window w has the half windows w and w + 1."""
    half = cfg.width // 2
    there = [[(lo // half, lo // half + max(-(-len(t) // half) - 2, 0)) for lo, t in mine] for mine in regions]
    around = lambda doc, cells: {w for c in cells for w in (c - 1, c) if any(a <= w <= b for a, b in there[doc])}
    found: list[list] = [[] for _ in regions]
    done: list[set[int]] = [set() for _ in regions]
    todo = [around(doc, marked_cells(mine, half)) for doc, mine in enumerate(regions)]
    while any(todo):
        places = [(doc, w * half) for doc, mine in enumerate(todo) for w in sorted(mine)]
        done = [d | t for d, t in zip(done, todo)]
        todo = [set() for _ in regions]
        for at in range(0, len(places), cfg.windows_at_once):
            some = [(doc, lo, next(t[lo - a:lo - a + cfg.width] for a, t in regions[doc] if a <= lo < a + len(t))) for doc, lo in places[at:at + cfg.windows_at_once]]
            paths, probs = tagger.decode(np.array([codes_of(part, cfg.width) for _, _, part in some]))
            for (doc, lo, part), path, prob in zip(some, paths, probs):
                for k, s, e, p in window_spans(path, prob, len(part)):
                    cut = (s == 0 and lo > 0) or (e == len(part) and lo + len(part) < lengths[doc])
                    found[doc].append((k, lo + s, lo + e, p, cut))
                    todo[doc] |= around(doc, range((lo + s - 1) // half, (lo + e) // half + 1)) - done[doc]
    return [reconciled(f, cfg.least) for f in found]


def narrowed(text: str, s: int, e: int) -> tuple[int, int]:
    """Without blanks and closing punctuation at the ends."""
    while s < e and text[0] in " \n\t,;:":
        text, s = text[1:], s + 1
    while s < e and text[-1] in " \n\t,;:.!?":
        text, e = text[:-1], e - 1
    return s, e


def find(docs: DataFrame, cfg: Pii = Pii(), tagger: Tagger | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, more): pattern spans by kind, then start, and the spans
    that the tagger adds. Without a ``tagger`` one is trained from the
    patterns' own spans."""
    tagger = tagger or fit(pieces_of(stored(prepared(docs, cfg, id_col, text_col), "pii-regions"), cfg), cfg)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches):
        for b in batches:
            texts = [t if isinstance(t, str) else "" for t in b["text"]]
            for lo, hi in pieces_by_size(texts):
                base = [pattern_spans(t) if _SIGNAL.search(t) else [] for t in texts[lo:hi]]
                spans = tagged(shared.value, [[(0, t)] for t in texts[lo:hi]], [len(t) for t in texts[lo:hi]], cfg) if shared.value else [[]] * (hi - lo)
                more = [kept_spans(*x) for x in zip(texts[lo:hi], spans, base)]
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[lo:hi], "base": [_named(x) for x in base], "more": [_named(x) for x in more]})
        trim()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, base {_SPANS}, more {_SPANS}")


def pieces_by_size(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Rows of a batch in pieces of about 8 million characters."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > 8 << 20 or i == len(texts) - 1:
            yield lo, i + 1
            lo, size = i + 1, 0


def kept_spans(text: str, spans: list[tuple[int, int, int, float]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Tagged spans that are a value of their kind, stand alone and touch no pattern span."""
    kept = []
    for k, s, e, _ in spans:
        s, e = narrowed(text[s:e], s, e)
        beside = text[max(s - 1, 0):s] + text[e:e + 1]
        if not any(c.isalnum() for c in beside) and valid(k, text[s:e]) and not any(s < y and x < e for _, x, y in base):
            kept.append((k, s, e))
    return kept


def _named(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def joined(spans: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, cfg: Pii = Pii()) -> DataFrame:
    """The digest columns of ``op12``."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return find(docs, cfg).select("doc_id", *[count(k) for k in range(len(KINDS))], F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                                  joined(F.concat("base", "more")).alias("spans"))


__all__ = ["KINDS", "Pii", "find", "fit", "pattern_spans", "report"]
