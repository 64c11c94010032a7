import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pluvio.llm import op01_quality_rules as op1
from pluvio.llm import op03_secret_scans as op3
from pluvio.llm import op04_license_scans as op4
from pluvio.session import scratch_path

SF = "/root/testdata/sf0.001"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rule_counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = {}
    for i, x in enumerate(win):
        seen.setdefault(x, []).append(i)
    covered = {p for s in seen.values() if len(s) > 1 for i in s for p in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_rules_match_plain_count(spark, awkward):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(["a ", "b ", "c\n", "# ", "|", "É ", "\x0b", "d  "]) for _ in range(rnd.randrange(90))) for _ in range(150)]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = op1.measurements(docs).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    want = [rule_counts(r.text) for r in docs.collect()]
    assert sorted(map(tuple, got)) == sorted(want)


def further_counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    ends = [x.rstrip(" \t\x0b\x0c\r") for x in lines]
    chars = sum(map(len, lines))
    return (sum(any(c.isascii() and c.isalpha() or not c.isascii() for c in x) for x in w),
            sum(x.isascii() and sum("A" <= c <= "Z" for c in x) > 1 and not any("a" <= c <= "z" for c in x) for x in w),
            sum(x.lstrip(" \t\x0b\x0c\r")[0] in "-*•" for x in lines), sum(x.endswith(("...", "…")) for x in ends),
            sum(x[-1] in ".!?\"'”’。！？" for x in ends), sum(len(x) <= 30 for x in lines), chars, chars - sum(map(len, set(lines))),
            t.count("{") + t.count("}"), len(re.findall("lorem ipsum", t, re.I | re.A)))


def test_further_measurements_match_plain_count(spark, awkward):
    rnd = random.Random(6)
    bits = ["a ", "AB ", "A1B", "Ab", "\n", "\n", "- ", "* ", "• ", "...", "…", ".", "!", "\" ", "”\r", "{", "} ", "Lorem Ipsum ", "É", "日本 ", "12 ", "\x0b", "\u2028", "\x85"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(60))) for _ in range(200)] + ["same line.\nsame line.\nother line which is longer than thirty..."]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = op1.measurements(docs).select(*op1.FURTHER).collect()
    assert sorted(map(tuple, got)) == sorted(further_counts(r.text) for r in docs.collect())


def test_each_rule_fails_its_own_text(spark):
    """One plain text that passes every rule, and one text for each further
    rule that fails it."""
    prose = "\n".join(f"This is line number{i} of a plain text, and it tells w{i} something new." for i in range(8))
    texts = {"none": prose, "letter_words": prose + " 1" * 200, "bullet_lines": prose.replace("This", "- This"),
             "ellipsis_lines": prose.replace(".", "..."), "repeated_line_chars": prose + ("\n" + "x" * 15) * 60, "placeholder": prose + "\nLorem ipsum.",
             "braces": prose.replace("it", "{it}"), "capitals": prose.upper(), "line_ends": prose.replace(".", ","), "short_lines": prose.replace(" ", ".\n")}
    ledger = op1.build_ledger(spark.createDataFrame([(i, t) for i, t in enumerate(texts.values())], "doc_id long, text string"))
    bits = {r.doc_id: r.fail_bits for r in ledger.collect()}
    assert bits[0] == 0
    place = {r.name: i for i, r in enumerate(op1.RULES)}
    assert all(bits[i] >> place[name] & 1 for i, name in enumerate(texts) if name != "none")


def test_policies_and_ablations(spark):
    docs = spark.createDataFrame([(1, "short"), (2, "word " * 40), (3, " ".join(f"w{i}" for i in range(40))), (4, "# " * 9)], "doc_id long, text string")
    ledger = op1.build_ledger(docs)
    kept = {r.doc_id: (r.kept, r.base) for r in op1.apply_policy(op1.apply_policy(ledger, op1.FULL), op1.BASE, "base").collect()}
    assert kept == {1: (False, False), 2: (False, False), 3: (True, True), 4: (False, False)}
    ab = {r.rule: (r.n_failed, r.n_only, r.n_kept_without) for r in op1.ablations(ledger, op1.PROSE).collect()}
    bits = {r.doc_id: r.fail_bits for r in ledger.collect()}
    for i, rule in enumerate(op1.RULES):
        assert ab[rule.name] == (sum(b >> i & 1 for b in bits.values()), sum(b == 1 << i for b in bits.values()),
                                 sum(b & ~(1 << i) == 0 for b in bits.values()))


def test_rules_on_empty_table(empty):
    ledger = op1.build_ledger(empty)
    assert ledger.count() == 0 and op1.ablations(ledger, op1.FULL).count() == 0


def plain_spans(text):
    out = []
    for i, k in enumerate(op3.KINDS):
        for m in re.finditer(k.pattern, text or ""):
            if len(m[k.group]) >= k.min_chars:
                out.append((m.start(), i, k.name, m.end()))
    return sorted(out)


def test_spans_match_plain_scan(spark, awkward):
    rnd = random.Random(5)
    bits = ["token", "API_KEY", "password", " = ", ":", "'", "abcdefABC123/+", "AKIA", "ABCDEFGH0123456789", "0123456789abcdef", "é", "\n", "ghp_", "x" * 20, "=", " "]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(60))) for _ in range(200)]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    ledger = op3.BlobLedger(spark, scratch_path(spark, "ledger"))
    rows = op3.findings(docs, ledger)
    got = sorted(([r.doc_id or -1, [tuple(s) for s in r.spans]] for r in rows.collect()), key=str)
    want = sorted(([r.doc_id or -1, plain_spans(r.text)] for r in docs.collect()), key=str)
    assert got == want
    base = ",".join(f"{k}:{s}:{e}" for s, _, k, e in plain_spans(texts[0]) if k in op3.BASE_KINDS)
    row = op3.report(docs, op3.BlobLedger(spark, scratch_path(spark, "ledger"))).where("doc_id = 100").first()
    assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()


@pytest.mark.parametrize("block", [1, 3, 256])
def test_spans_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(op3, "BLOCK", block)
    texts = ["é " + "0123456789abcdef é short=abc token=abcdefghijk%d, " % n * n for n in (0, 1, 2, 3, 4, 6, 7, 300)]
    docs = op3.addressed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.blob: [tuple(s) for s in r.spans] for r in op3.scan(docs.select("blob", "text")).collect()}
    assert all(got[r.blob] == plain_spans(r.text) for r in docs.collect())


def test_ledger_scans_only_unseen_blobs(spark):
    """Scans in a row with default arguments: every batch stays."""
    ledger = op3.BlobLedger(spark, scratch_path(spark, "ledger"))
    assert ledger.batches(op3.RULE_VERSION) == [] and ledger.read().count() == 0
    a = spark.createDataFrame([(1, "token=aaaaaaaaaaaa1"), (2, "plain"), (3, "plain")], "doc_id long, text string")
    b = spark.createDataFrame([(4, "token=aaaaaaaaaaaa1"), (5, "AKIA" + "A" * 16), (6, "plain")], "doc_id long, text string")
    c = spark.createDataFrame([(7, "new"), (8, "AKIA" + "A" * 16)], "doc_id long, text string")
    found = [{r.doc_id: len(r.spans) for r in op3.findings(d, ledger).collect()} for d in (a, b, c, a)]
    assert found == [{1: 1, 2: 0, 3: 0}, {4: 1, 5: 1, 6: 0}, {7: 0, 8: 1}, {1: 1, 2: 0, 3: 0}]
    sizes = {r.batch: r["count"] for r in ledger.read().groupBy("batch").count().collect()}
    assert sizes == {0: 2, 1: 1, 2: 1} and ledger.batches(op3.RULE_VERSION) == [0, 1, 2, 3]
    assert ledger.read("other rules").count() == 0 and {r.doc_id: len(r.spans) for r in op3.findings(a, ledger, "other rules").collect()} == found[0]
    assert ledger.read("other rules").count() == 2 and ledger.read().count() == 4


def test_report_over_deliveries_equals_one_scan(spark, awkward):
    fresh = lambda: op3.BlobLedger(spark, scratch_path(spark, "ledger"))
    odd = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
    ledger = fresh()
    parts = op3.report(awkward, ledger, (odd, ~odd)).collect()
    assert sorted(parts, key=str) == sorted(op3.report(awkward, fresh()).collect(), key=str) and ledger.batches(op3.RULE_VERSION) == [0, 1]


def test_redaction(spark):
    d = spark.createDataFrame([(1, "token=aaaaaaaaaaaa1 mid AKIA" + "B" * 16 + " end"), (2, "AKIA" + "C" * 16), (3, "clean")], "doc_id long, text string")
    f = op3.findings(d, op3.BlobLedger(spark, scratch_path(spark, "ledger"))).join(d, "doc_id")
    got = {r.doc_id: r.t for r in f.select("doc_id", op3.redacted(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert got == {1: "[SECRET] mid [SECRET] end", 2: "[SECRET]", 3: "clean"}


def test_secrets_on_empty_table(spark, empty):
    assert op3.report(empty, op3.BlobLedger(spark, scratch_path(spark, "ledger"))).count() == 0


def plain_licence(text):
    w = re.findall(WORD, lowered(text))
    places = {}
    for phrase, label in op4.BASE_PHRASES.items():
        p = phrase.split()
        places[label] = [i for i in range(len(w)) if w[i:i + len(p)] == p]
    every = sorted(i for s in places.values() for i in s)
    return (len(w), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(k for k, v in places.items() if v)))


def test_licence_base_matches_plain_scan(spark, awkward):
    rnd = random.Random(6)
    bits = ["MIT", "license", "License,", "CC", "BY-", "gnu", "General", "public", "apache", "é", "\n", "word", "mit license"]
    texts = [" ".join(rnd.choice(bits) for _ in range(rnd.randrange(50))) for _ in range(200)]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = op4.scan(docs).select("n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(plain_licence(r.text)) for r in docs.collect())


def test_licence_templates_need_their_key_phrase(spark):
    mit = op4.TEMPLATES[10].text
    docs = spark.createDataFrame([
        (1, "intro words here. " + mit + " tail"), (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "warranty software copy permission granted obtaining files " * 3), (4, "Licensed under CC BY-NC 4.0."),
        (5, mit.replace("free of charge", "for money")), (6, None)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, round(r.score, 2)) for r in op4.scan(docs).collect()}
    assert got[1] == ("mit", 1.0) and got[2] == ("gpl,gpl-3.0", 1.0) and got[3] == ("", 0.0)
    assert got[4] == ("cc-by,cc-by-nc-4.0", 1.0) and got[5] == ("", 0.0) and got[6] == ("", 0.0)


def test_licence_words_do_not_crowd_each_other_out(spark):
    """Every pair of templates, and a template among many other template words."""
    ts = op4.TEMPLATES
    pairs = [(a, b) for a in range(len(ts)) for b in range(len(ts)) if ts[a].label != ts[b].label]
    vocab = sorted({w for w, _, _ in op4.postings()})
    rows = [(i, f"{ts[a].text}. Then other words follow here. {ts[b].text}.") for i, (a, b) in enumerate(pairs)]
    rows += [(1000 + t, " and ".join(vocab) + f". {x.text}.") for t, x in enumerate(ts)]
    got = {r.doc_id: r for r in op4.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (a, b) in enumerate(pairs):
        assert {ts[a].label, ts[b].label} <= set(got[i].labels.split(",")) and got[i].score == 1.0
    for t, x in enumerate(ts):
        assert x.label in got[1000 + t].labels.split(",") and got[1000 + t].score == 1.0


def plain_labels(text):
    """Every template at every offset, every word compared."""
    w = re.findall(WORD, lowered(text))
    low = [x.lower() for x in w]
    labels, best = set(plain_licence(text)[4].split(",")) - {""}, 0.5 if plain_licence(text)[1] else 0.0
    for t in op4.TEMPLATES:
        own = [(x, i) for i, x in enumerate(t.words) if x not in op4.FUNCTION_WORDS]
        k, key_at, first = t.key_words, t.key_at, 1 - len(t.words)
        keys = {i for i in range(len(w)) if w[i:i + len(k)] == k}
        full = min(len(own), op4.FULL_WORDS)
        for off in range(first, len(w)) if keys else ():
            if any(off + key_at + d in keys for d in range(-op4.SLACK, op4.SLACK + 1)):
                agreed = sum(0 <= off + i < len(w) and low[off + i] == x for x, i in own)
                if agreed >= 2 and agreed >= op4.AGREE * full:
                    labels.add(t.label)
                    best = max(best, min(1.0, agreed / full))
    return ",".join(sorted(labels)), round(best, 9)


def test_licence_labels_match_every_place_tried(spark, awkward):
    """Cut, spoiled, doubled and mixed templates against every offset."""
    rnd = random.Random(8)
    texts = [" ".join([op4.TEMPLATES[5].text] * 60), " ".join(["MIT License"] * 200)]
    for _ in range(220):
        parts = []
        for _ in range(rnd.randrange(1, 4)):
            w = rnd.choice(op4.TEMPLATES).text.split()
            lo = rnd.choice([0, 0, rnd.randrange(len(w))])
            w = w[lo:lo + rnd.choice([len(w), 30, 12])]
            spoil = rnd.choice([0, 0, 0.1, 0.3, 0.5])
            parts.append(" ".join(rnd.choice(["other", "software", "É", ""]) if rnd.random() < spoil else x for x in w))
            parts.append(rnd.choice(["", "and then", "License", "\n\n"]))
        texts.append(" ".join(parts))
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = sorted((str(r.doc_id), r.labels, round(r.score, 9)) for r in op4.scan(docs).collect())
    want = sorted((str(r.doc_id), *plain_labels(r.text)) for r in docs.collect())
    assert got == want
    assert sum("," in x[1] for x in want) > 30 and sum(0.5 < x[2] < 1 for x in want) > 20


def test_licence_lookups_leave_out_the_frequent_words():
    files = {w: n for n, w in enumerate(sorted({w for w, _, _ in op4.postings()}))}
    rare, of = op4.probes(op4.TEMPLATES, files), op4.content(op4.TEMPLATES)
    for t, words in of.items():
        own = [(w, i) for w, u, i in rare if u == t]
        left = [x for x in words if x not in own]
        assert len(left) == op4.needed(len(words)) - 1  # fewer than must agree, so one that agrees is looked up
        assert max(files[w] for w, _ in own) <= min((files[w] for w, _ in left), default=10**9)


def test_licences_on_empty_table(empty):
    assert op4.scan(empty).count() == 0
