import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from pluvio.llm import op03_secret_scans as op3
from pluvio.llm import op05_packing as op5
from pluvio.llm import op07_token_counts as op7
from pluvio.llm import op09_chat_format as op9
from pluvio.llm import op10_quality_classifier as op10
from pluvio.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def transducer():
    return op7.Transducer(tokenizer_file("piece_bpe_32k.model"))


def lib_counts(texts):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    return [len(x) for x in sp.encode(texts, num_threads=1)]


def test_counts_match_the_library(spark, transducer):
    rnd = random.Random(1)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", "  ", "\n\n x\t y  z   ", "▁▁x▁", "日本語 😀😀", "\x00a", "</s> <s> <unk> <0x0A>", " lead", "trail ", "a" * 900, " " * 100 + "x" + " " * 37]
    texts += ["".join(rnd.choice("ab the\n .,éß中=-_<>/0123") for _ in range(200)) for _ in range(100)]
    assert [transducer.count(t) for t in texts] == lib_counts(texts)


@pytest.mark.parametrize("chunk", [1, 7, 64, 1000])
def test_chunk_maps_compose(transducer, chunk):
    texts = ["aaaa bb  cc\nline  two " * 20, "x" * 300, "日本 a\n\n b" * 30]
    assert [transducer.count(t, chunk) for t in texts] == lib_counts(texts)


def test_counts_of_awkward_rows(spark, awkward, empty):
    path = tokenizer_file("piece_bpe_32k.model")
    rows = op7.token_counts(awkward.select("doc_id", "text"), path, limit=100).collect()
    assert [r.n_tokens for r in rows] == lib_counts([r.text or "" for r in rows])
    assert all(r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 100) for r in rows)
    assert op7.token_counts(empty, path).count() == 0


def test_chat_round_trip(spark):
    rows = [(1, 0, "system", "</s>\\<|end|>\n"), (1, 1, "assistant", "[INST] ok"), (1, 2, "assistant", ""), (1, 3, "user", None), (2, 0, None, "x"),
            (2, 0, "ro\nle", "tie"), (None, 0, "assistant", "no id"), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    conv = spark.createDataFrame([(c, t, r, x, 9) for c, t, r, x in rows], "conv_id long, turn long, role string, text string, n_turns int")
    formatted = op9.format_conversations(conv)
    outs = {r.conv_id: r.formatted for r in formatted.collect()}
    assert not any(c in o.replace("<|turn|>", "").replace("<|end|>", "") for o in outs.values() for c in ("</s>", "[INST]", "[/INST]", "<|"))
    for r in op9.digests(formatted).collect():
        turns = sorted(((t, a or "", x or "") for c, t, a, x in rows if c == r.conv_id))
        loss = "".join(x for _, a, x in turns if a == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss) and r.formatted_chars == len(outs[r.conv_id])
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{x}\n" for _, a, x in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert op9.format_conversations(conv.limit(0)).count() == 0


def test_templates_that_rewrite_history_are_found():
    last_only = lambda turns: "".join(f"[{t if i == len(turns) - 1 else '...'}]" for i, (_, t) in enumerate(turns))
    _, found, _ = op9.spans([("user", "aa"), ("user", "bb")], last_only)
    assert found == [None, None]
    counted = lambda turns: f"{len(turns)}:" + "".join(t for _, t in turns)
    assert op9.format_one([("user", "a"), ("assistant", "b")], counted)["n_rewritten"] == 2


def test_long_conversations():
    rnd = random.Random(9)
    turns = [(rnd.choice(["user", "assistant"]), "".join(rnd.choice("ab<[\\\n|") for _ in range(rnd.randrange(9)))) for _ in range(300)]
    out, found, context = op9.spans(turns)
    assert context == op9.CONTEXT and op9.read_back(out, found) == turns
    row = op9.format_one(turns)
    assert [op9.unescape(out[a:b]) for a, b in zip(row["loss_starts"], row["loss_ends"])] == [t for r, t in turns if r == "assistant"]
    numbered = lambda ts: "".join(f"{i}:{t};" for i, (_, t) in enumerate(ts))  # noqa: E731  needs all turns before
    out, found, context = op9.spans(turns, numbered)
    assert context == 0 and all(out[s[0]:s[1]] == f"{i}:{t};" for i, (s, (_, t)) in enumerate(zip(found, turns)))
    assert op9.format_one(turns, lambda ts: f"{len(ts)}!" + "".join(t for _, t in ts))["n_rewritten"] > 0


def test_rewriting_is_found_at_any_length():
    """A template that writes otherwise when it renders 12 turns: found by the
    prefix of 12 turns, in a conversation of 14 as in one of 40."""
    odd = lambda ts: ("#" if len(ts) == 12 else "") + "".join(f"{r}:{t};" for r, t in ts)
    for n in (14, 17, 40):
        turns = [("assistant" if k % 2 else "user", str(k)) for k in range(n)]
        _, found, context = op9.spans(turns, odd)
        assert context == 0 and found[:12] == [None] * 12 and op9.format_one(turns, odd)["n_rewritten"] == 13
        row, same = op9.format_one(turns), op9.format_one(turns, lambda ts: op9.marked_template(ts))
        assert row == same  # what the default template states holds


def test_any_appending_template_has_spans_and_masks():
    other = lambda turns: "BOS" + "".join(f"<{r.upper()}>{t.swapcase()}</{r}>" for r, t in turns)
    row = op9.format_one([("user", "Hi"), ("assistant", "Yo"), ("assistant", "</assistant>")], other)
    assert row["n_rewritten"] == 0 and [row["formatted"][a:b] for a, b in zip(row["loss_starts"], row["loss_ends"])] == ["yO", "</ASSISTANT>"]


def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op10_quality_classifier"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    test = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in test) / len(test) > 0.97
    assert sum(p for p, y in test if y == 1) / sum(y for _, y in test) > 0.98


def test_classifier_separates_by_words_alone(spark):
    """Texts of one shape (five small letters a word), of two vocabularies."""
    rnd = random.Random(12)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(120)]
    rows = [(i, " ".join(rnd.choice(vocab[:60] if i % 2 else vocab[40:]) for _ in range(40)) + ".") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r for r in op10.report(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")).collect() if r.held_out]
    assert len(got) > 150 and sum(r.predicted == r.doc_id % 2 for r in got) / len(got) > 0.95


def test_a_labelled_id_that_repeats_counts_once(spark):
    rows = [(0, f"text number {i}") for i in range(400)] + [(i, f"other {i}") for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 as quality").distinct()
    n = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(60))
    assert len(op10.train(docs, labels).labels) == n and len(op10.train(docs, labels, op10.Voting(max_labelled=10)).labels) == 10


def test_training_never_holds_the_whole_matrix(spark):
    docs = spark.range(6400).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 30), i -> concat('w', id * i % 997))) as text")
    tracemalloc.start()
    space = op10.train(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(space.labels) == 4096 and peak < 64 << 20  # the matrix alone would take 100 MB


def test_blocks_of_the_sample_give_what_one_block_gives():
    texts = [" ".join(f"w{i * j % 97}" for j in range(1, 20)).encode() + b"!" * (i % 3) for i in range(40)]
    found = [op10.term_counts([t])[1:] for t in texts]
    terms, counts = [t.astype("int16").tobytes() for t, _ in found], [c.astype("int32").tobytes() for _, c in found]
    labels = np.arange(40) % 2
    one, some = (op10.fit(*op10.weighted(terms, counts, step), labels, op10.Voting()) for step in (40, 7))
    x = op10.matrix(*op10.term_counts(texts), 40)
    assert np.allclose(op10.vote(x, one, op10.Voting()), op10.vote(x, some, op10.Voting()), atol=1e-4)
    plain = op10.unit(x * one.idf)
    assert np.allclose(one.vectors, op10.unit(plain @ one.axes), atol=1e-5)


def test_terms_of_a_long_text_come_piece_by_piece(monkeypatch):
    text = ("Some words, words | and ### more.\n" * 400).encode()
    whole = op10.matrix(*op10.term_counts([text, b"x", b""]), 3)
    monkeypatch.setattr(op10, "LONG", 1 << 10)
    monkeypatch.setattr("pluvio.llm.textvec.LONG", 1 << 10)
    parts = op10.matrix(*op10.term_counts([text, b"x", b""]), 3)
    assert abs(whole - parts).max() < 0.02 and (whole[1] == parts[1]).all() and not parts[2].any()


def test_classifier_defined_results(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 1), (7, 0), (None, 1), (5, None), (77, 1)], "doc_id long, quality int")
    rows = op10.report(awkward, labels).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows) and all(r.score == 0 for r in rows if r.doc_id in (1, 2))
    none = op10.report(awkward, labels.limit(0)).collect()
    assert all(r.score == 0.5 and r.predicted == 1 for r in none)
    assert op10.report(empty, labels).count() == 0


def test_pipeline_against_plain_stages(spark):
    """Each stage held against a plain version of its decision on its input."""
    from test_join_pack_shard import brute_classes, brute_contamination, check_packing
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    space = op10.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in op10.score(docs, space).where("score >= 0.5").collect()}
    kept = cp.classify(spark, docs, SF)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == good
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    one = cp.deduplicate(spark, kept, SF)
    classes = brute_classes(rows)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {c for c, _ in classes.values()}
    rows = [(r.doc_id, r.text) for r in one.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = cp.decontaminate(spark, one, SF)
    bad = {d for d, v in brute_contamination(rows, items).items() if v[3]}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - bad
    before = {r.doc_id: r.text for r in clean.collect()}
    safe = cp.redact(spark, clean, SF)
    after = {r.doc_id: r for r in safe.collect()}
    assert safe.columns == docs.columns and set(after) == set(before)
    import re
    for d, t in before.items():
        secret = [m[0] for k in op3.KINDS for m in re.finditer(k.pattern, t) if len(m[k.group]) >= k.min_chars]
        assert (after[d].text == t) == (not secret) and not any(s in after[d].text for s in secret) and after[d].n_chars == len(after[d].text)
    lib = op5.WordIds(tokenizer_file("word_bpe_49k.json")).tok
    got = cp.pack(spark, safe, SF).collect()
    check_packing(got, {d: lib.encode(r.text, add_special_tokens=False).ids + [2] for d, r in after.items()})
    final = cp.run(spark, SF)
    assert sorted(map(tuple, final.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in got)


def test_pipeline_stages_on_awkward_and_empty_tables(spark, awkward, empty):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in cp.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert {r.doc_id for r in cp.deduplicate(spark, docs, SF).collect()} == {1, 2, 3, 4, 5, 6, 7, 8, 9, None}
    assert cp.pack(spark, docs, SF).count() > 0


def test_pipeline_stages_give_clashing_columns_back(spark, awkward):
    """Columns with the names that the stages use inside come out as they went in."""
    names = ["_score", "_blob", "_spans", "_own", "_bad", "_bad_text", "_text_key", "_TEXT_KEY_"]
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars").withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id"), F.lit(-1))) for n in names})
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert out.columns == docs.columns and (rows or name == "quality classifier"), name
        assert all(r[n] == f"{n}{-1 if r.doc_id is None else r.doc_id}" for r in rows for n in names), name
    assert cp.pack(spark, docs, SF).count() > 0
