"""Fill-in-the-middle, personal data and whitening against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import crf_tagger as ct
from pluvio.llm import op11_fill_in_middle as op11
from pluvio.llm import op12_pii as op12
from pluvio.llm import op13_embedding_whitening as op13

SF = "/root/testdata/sf0.001"


def plain_middle(doc_id, text, cfg):
    text = text or ""
    digest = hashlib.sha256(f"{cfg.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if cfg.unit == "line" else list(text)
    n = len(units)
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, z), (z, n)))
    if not text or any(k in text for k in (cfg.prefix, cfg.suffix, cfg.middle)) or h[2] % 100 >= cfg.percent:
        return n, "plain", None, None, text
    if h[3] % 100 < cfg.spm_percent:
        return n, "spm", len(p), len(m), cfg.suffix + s + cfg.prefix + p + cfg.middle + m
    return n, "psm", len(p), len(m), cfg.prefix + p + cfg.suffix + s + cfg.middle + m


@pytest.mark.parametrize("cfg", [op11.Fim(), op11.Fim(unit="char", percent=60), op11.Fim(seed=3, spm_percent=100, prefix="[a", suffix="b*", middle="\\Q")])
def test_middle_matches_plain_version(spark, awkward, cfg):
    rnd = random.Random(6)
    bits = ["a", "é", "日", "🙂", "\n", "\n\n", "word ", "\r\n", "<P", ">", "<M>", "S>", "\x00", "[a", "b*"]
    rows = [(i, "".join(rnd.choice(bits[:8] if i % 3 else bits) for _ in range(rnd.randrange(40)))) for i in range(300)]
    rows += [(1000, "<S>"), (1001, "<S"), (1002, "<"), (1003, "\n"), (1004, "x<P>"), (1005, "日本"), (1006, "é\n" * 50_000)]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    out = op11.transform(docs, cfg)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = sorted(((r.doc_id, *plain_middle(r.doc_id, r.text, cfg)) for r in docs.collect()), key=str)
    assert got == want
    back = out.select("doc_id", op11.restored(F.col("output"), F.col("form"), cfg).alias("t"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)


def test_middle_defined_results(spark, awkward, empty):
    assert op11.report(empty).count() == 0 and op11.report(awkward).count() == awkward.count()
    clash = awkward.select("doc_id", "text", F.lit(1).alias("h1"), F.lit(2).alias("form"), F.lit(3).alias("output"), F.lit(4).alias("n"))
    assert sorted(map(tuple, op11.report(clash).collect()), key=str) == sorted(map(tuple, op11.report(awkward).collect()), key=str)
    named = spark.createDataFrame([("a/1", "x\ny\n")], "id string, body string")
    assert op11.transform(named, id_col="id", text_col="body").first().n == 2


def test_byte_index_converts_both_ways():
    text = "aé日🙂\n" * 7 + "plain" + "ñ"
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    index = op11.ByteIndex(data)
    at = np.array([len(text[:i].encode()) for i in range(len(text) + 1)])
    assert index.chars(at).tolist() == list(range(len(text) + 1)) and index.bytes(np.arange(len(text) + 1)).tolist() == at.tolist()
    assert len(index.at) == sum(ord(c) > 127 for c in text)  # nothing is kept for ASCII


PLAIN = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(re.sub("[^0-9]", "", s)) <= 19 and plain_luhn(re.sub("[^0-9]", "", s))),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15))


def plain_luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def plain_private(text):
    return [(k, m.start(), m.end()) for k, (_, p, ok) in enumerate(PLAIN) for m in re.finditer(p, text or "") if ok(m[0])]


def private_texts(n, seed):
    rnd = random.Random(seed)
    bits = ["a.b", "@", "mail-1.example.com", "x@y.z", " ", "-", "10.0.0.1", ".", "256", "4713403953524564", "4713 4039 5352 4564", "+1 (482) 555-7163", "+", "(", ")",
            "12", "é", "\n", "_", "%", "word", "0", "@@", "..", "4111-1111-1111-1111", "+4 (((", "+44 20 7946 0958"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randrange(40))) for _ in range(n)]


def test_patterns_match_plain_scan():
    for t in private_texts(4000, 3):
        assert op12.pattern_spans(t) == plain_private(t), t
    for t in ("9" * 200_000, "a" * 200_000, "1." * 100_000, "+1" + "." * 200_000, "a@" * 100_000, "@" * 100_000, "a@b" * 50_000):
        op12.pattern_spans(t)  # in a few passes


def test_regions_hold_every_signal():
    rnd = random.Random(4)
    for _ in range(300):
        t = "".join(rnd.choice("abc" * 40 + "1@é") for _ in range(rnd.randrange(900)))
        regions = op12.regions_of(t, 128)
        assert all(t[lo:lo + len(r)] == r for lo, r in regions) and all(a + len(x) <= b for (a, x), (b, _) in zip(regions, regions[1:]))
        assert sum(len(re.findall("[0-9@]", r)) for _, r in regions) == len(re.findall("[0-9@]", t))


def test_tagger_gradients_and_decoding():
    """Gradients against differences; marginals and the best path against all paths."""
    rnd = np.random.default_rng(2)
    t = ct.fresh(ct.TaggerConfig(kinds=1, hidden=3))
    t.w = {k: v.astype(np.float64) + 0.1 * rnd.standard_normal(v.shape) for k, v in t.w.items()}
    codes, labels = rnd.integers(0, ct.CODES, (3, 5)), np.array([[0, 1, 2, 2, 0], [1, 1, 2, 0, 0], [0, 0, 0, 0, 1]])
    _, grads = ct.gradients(t, codes, labels)
    for name, at in (("x_f", (codes[0, 1], 4)), ("h_f", (1, 2)), ("x_b", (codes[2, 3], 7)), ("h_b", (2, 5)), ("out", (4, 1)), ("bias", 2), ("step", (1, 2)), ("start", 1)):
        value, sides = t.w[name][at], []
        for e in (1e-3, -1e-3):
            t.w[name][at] = value + e
            sides.append(ct.gradients(t, codes, labels)[0])
        t.w[name][at] = value
        assert abs((sides[0] - sides[1]) / 2e-3 - grads[name][at]) < 2e-5, name
    em = t.emissions(codes)
    step, start = t.w["step"] + ct.forbidden(1), t.w["start"] + ct.forbidden_start(1)
    paths = np.array(np.meshgrid(*[range(3)] * 5)).reshape(5, -1).T
    score = np.array([[start[p[0]] + sum(em[i, n, p[i]] for i in range(5)) + sum(step[p[i], p[i + 1]] for i in range(4)) for p in paths] for n in range(3)])
    weight = np.exp(score - score.max(axis=1, keepdims=True))
    best, prob = t.decode(codes)
    marg = ct.marginals(em, *ct.potentials(t))[0]
    for n in range(3):
        assert best[n].tolist() == paths[score[n].argmax()].tolist()
        for i in range(5):
            assert np.allclose([weight[n][paths[:, i] == k].sum() / weight[n].sum() for k in range(3)], marg[i, n], atol=1e-4)


def test_windows_are_reconciled():
    got = op12.reconciled([(2, 10, 40, .9, False), (2, 10, 30, .8, True), (3, 35, 50, .7, False), (2, 10, 40, .6, False), (0, 60, 64, .9, True),
                           (0, 64, 80, .8, True), (1, 90, 95, .2, False)], 0.5)
    assert got == [(2, 10, 40, .9), (0, 60, 80, .8)]
    assert op12.reconciled([(0, 0, 5, .6, False), (1, 4, 9, .9, False), (2, 8, 12, .6, False)], 0.5) == [(0, 0, 5, .6), (2, 8, 12, .6)]
    assert op12.reconciled([], 0.5) == []


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").where(F.col("text").rlike("[0-9@]")).collect()
    half = lambda r: int(hashlib.md5(str(r.doc_id).encode()).hexdigest(), 16) % 2
    return [[r for r in docs if half(r) == k] for k in (0, 1)]


@pytest.fixture(scope="module")
def trained(spark, labelled):
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in labelled[0]], "doc_id long, text string")
    pieces = op12.pieces_of(op12.prepared(docs, op12.Pii(), "doc_id", "text"), op12.Pii())
    assert len(pieces) <= 1.5 * op12.Pii().max_train + 200
    return op12.fit(pieces)


def test_tagger_finds_held_out_data(labelled, trained):
    """Spans of documents that were not trained on, as they stand and in a
    writing that no pattern knows."""
    cfg, rnd = op12.Pii(), np.random.default_rng(8)
    found, total, new_found, new_total = 0, 0, 0, 0
    for r in labelled[1]:
        for k, s, e in op12.pattern_spans(r.text)[:2]:
            lo = max(0, s - 300)
            for how, datum in enumerate((r.text[s:e], op12.rewritten(k, r.text[s:e], rnd))):
                text = r.text[lo:s] + datum + r.text[e:e + 300]
                got = op12.tagged(trained, [op12.regions_of(text, cfg.width)], [len(text)], cfg)[0]
                hit = any(k == k2 and abs(s2 - (s - lo)) <= 2 and abs(e2 - (s - lo) - len(datum)) <= 2 for k2, s2, e2, _ in got)
                if how:
                    new_total, new_found = new_total + 1, new_found + hit
                else:
                    total, found = total + 1, found + hit
    assert total > 200 and found >= 0.9 * total and new_found >= 0.85 * new_total


def test_private_data_in_documents(spark, labelled, trained, awkward):
    texts = private_texts(300, 9) + ["Call me at (482) 555-7163 or never.", "no data here", "v 1.2.3 of 2021-03-04", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(awkward.select("doc_id", "text"))
    every = {r.doc_id: r for r in op12.find(docs.where("doc_id < 500"), tagger=trained).collect()}
    for i, t in enumerate(texts):
        if i > 11:  # awkward uses the ids before
            base = [(s.kind, s.start, s.end) for s in every[i].base]
            assert base == plain_private(t)
            assert all(op12.valid(s.kind, t[s.start:s.end]) and all(s.end <= x or y <= s.start for _, x, y in base) for s in every[i].more)
    n = len(texts)
    assert every[n - 4].more == [] and every[n - 3].more == [] and every[n - 2].base == every[n - 1].base == []
    clean = [r.doc_id for r in labelled[1] if not op12.pattern_spans(r.text)]
    rows = op12.find(spark.createDataFrame([(r.doc_id, r.text) for r in labelled[1]], "doc_id long, text string"), tagger=trained).collect()
    assert sum(len(r.more) for r in rows if r.doc_id in clean) <= 0.05 * max(len(clean), 20)


def all_windows(tagger, text, cfg):
    """Kept spans from every window of the text."""
    half, found = cfg.width // 2, []
    for lo in range(0, max(len(text) - half, 1), half):
        part = text[lo:lo + cfg.width]
        paths, probs = tagger.decode(np.array([ct.codes_of(part, cfg.width)]))
        found += [(k, lo + s, lo + e, p, (s == 0 and lo > 0) or (e == len(part) and lo + len(part) < len(text)))
                  for k, s, e, p in op12.window_spans(paths[0], probs[0], len(part))]
    return op12.kept_spans(text, op12.reconciled(found, cfg.least), op12.pattern_spans(text))


def test_tagged_spans_are_those_of_all_windows(spark, labelled, trained):
    """Addresses without a digit or an @, and spans of several windows; a
    second tagger marks long stretches, so that spans reach far from a mark."""
    rnd, cfg, words = random.Random(5), op12.Pii(), "please write to the office about our next meeting in march and bring notes".split()
    said = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    name = lambda n: "".join(rnd.choice("abcdefghijklmnoprstuvw") for _ in range(n))
    texts = [f"{said(rnd.randrange(60))} {name(5)}{rnd.choice(['(at)', ' (at) ', '[at]'])}mail.example.com {said(rnd.randrange(60))}" for _ in range(60)]
    assert not any(re.search("[0-9@]", t) for t in texts)
    rows = op12.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tagger=trained).collect()
    more = {r.doc_id: [(s.kind, s.start, s.end) for s in r.more] for r in rows}
    assert sum(any(k == 0 and "at" in texts[i][s:e] for k, s, e in more[i]) for i in more) > 0  # an address as such, without any before
    texts += [f"{said(30)} {name(n)} @ {name(n)}.com {said(30)}" for n in (20, 70, 130, 200)] + [r.text[:3000] for r in labelled[1][:40]]
    wide = ct.fresh(ct.TaggerConfig())
    wide.w["step"][1:, 0] -= 6
    for tagger in (trained, wide):
        got = op12.tagged(tagger, [[(0, t)] for t in texts], [len(t) for t in texts], cfg)
        for t, spans in zip(texts, got):
            assert op12.kept_spans(t, spans, op12.pattern_spans(t)) == all_windows(tagger, t, cfg), t


def test_private_report_and_defined_results(spark, awkward, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(9_000_000 + i, t) for i, t in enumerate(private_texts(60, 12))], "doc_id long, text string"))
    rows = {r.doc_id: r for r in op12.report(docs).collect()}
    for r in docs.collect():
        base = plain_private(r.text)
        line = ",".join(f"{op12.KINDS[k]}:{s}:{e}" for k, s, e in base)
        got = rows[r.doc_id]
        assert [got.n_email, got.n_ip, got.n_card, got.n_phone] == [sum(k == j for k, _, _ in base) for j in range(4)]
        assert got.base_sha256 == hashlib.sha256(line.encode()).hexdigest() and set(line.split(",")) <= set(got.spans.split(",")) | {""}
    assert op12.report(empty).count() == 0 and op12.report(awkward).count() == awkward.count()
    clash = awkward.select("doc_id", "text", F.lit(1).alias("base"), F.lit(2).alias("regions"), F.lit(2).alias("hash"))
    assert op12.report(clash).count() == awkward.count()
    none = spark.createDataFrame([(1, "no signal"), (1, "no signal"), (None, None)], "doc_id long, text string")
    assert [r.spans for r in op12.report(none).collect()] == [""] * 3


def plain_whitening(rows, components=32):
    keep = [(i, [int(np.floor(64.0 * np.float64(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    dims = [len(x) for _, x in keep]
    dim = max(set(dims), key=lambda d: (dims.count(d), d))
    keep = [(i, x) for i, x in keep if len(x) == dim]
    x = np.array([x for _, x in keep], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, a = np.linalg.eigh(c.T @ c / n)
    e, a = e[::-1][:components], a[:, ::-1][:, :components]
    return keep, n, ((n * x - s) ** 2).sum(axis=1), c @ a, e, e / np.trace(c.T @ c / n)


def check_whitening(got, rows, components=32):
    keep, n, dev, proj, e, share = plain_whitening(rows, components)
    usable = int((e > 1e-9 * e[0]).sum())
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    sign = {}
    assert len(got) == len(keep) * min(components, len(e))
    for at, (i, _) in enumerate(keep):
        for k in range(len(e)):
            r = by_id[i][k + 1][0]
            assert r.n == n and abs(r.explained - share[k]) <= 1e-9 + 1e-4 * share[k]
            if k >= usable:
                continue
            want = proj[at, k] / np.sqrt(e[k])
            if abs(want) > 1e-3:
                sign.setdefault(k, np.sign(r.whitened) * np.sign(want))
                assert abs(r.whitened - sign[k] * want) < 1e-6 * max(1, abs(want))
            assert r.identity_error < 1e-4
        assert {r.deviation for rs in by_id[i].values() for r in rs} == {int(dev[at])}


def test_whitening_matches_plain_version(spark):
    rnd = np.random.default_rng(5)
    mixed = (rnd.standard_normal((400, 6)) @ rnd.standard_normal((6, 6))).astype(np.float32)
    hot = mixed[0].tolist()
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)] + [(1000 + i, hot) for i in range(300)]
    rows += [(5000, None), (5001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (5002, [float("nan")] * 6), (5003, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (5004, [1.0, 2.0]), (5005, [])]
    d = spark.createDataFrame([(i, v, 1, "k") for i, v in rows], "vec_id long, embedding array<float>, label int, key string")
    check_whitening(op13.whiten(d).collect(), rows)
    check_whitening(op13.whiten(d, op13.Whitening(components=3, block=7)).collect(), rows, 3)
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    check_whitening(op13.whiten(table).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_whitening_counts_each_distinct_vector_once(spark):
    rows = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [0.0, 2.0]), (4, [0.0, 2.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = op13.whiten(d, op13.Whitening(weights="one")).collect()
    assert len(one) == 10 and {r.n for r in one} == {3}
    same = op13.whiten(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")).collect()
    pick = lambda rs: sorted((r.vec_id, r.component, round(abs(r.whitened), 9), r.deviation) for r in rs if r.vec_id < 3)
    assert pick(one) == pick(same)


def test_whitening_defined_results(spark):
    kind = "vec_id long, embedding array<float>"
    assert op13.whiten(spark.createDataFrame([], kind)).count() == 0
    assert op13.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    flat = op13.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], kind)).collect()
    assert len(flat) == 6 and all(r.whitened is None and r.deviation == 0 and r.identity_error is None and r.n == 3 for r in flat)
    line = op13.whiten(spark.createDataFrame([(i, [float(i), float(i)]) for i in range(4)], kind)).collect()
    assert [r.whitened is None for r in sorted(line, key=lambda r: (r.vec_id, r.component))] == [False, True] * 4
    assert op13.deviations(np.array([[1 << 40, 0]]), 3, np.array([0, 0])) == [None]
    assert op13.deviations(np.array([[5, 7]]), 2, np.array([9, 20])) == [37]
