import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import op02_ngram_jaccard as op2
from pluvio.llm import op05_packing as op5
from pluvio.llm import op06_decontamination as op6
from pluvio.llm import op08_sharding as op8
from pluvio.llm import textvec
from pluvio.llm.queries import tokenizer_file

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows, threshold=0.8):
    ids = [i for i, _ in rows if i is not None]
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    links, parent = {i: 0 for i in ids}, {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, a in enumerate(ids):
        for b in ids[:k]:
            inter = len(sets[a] & sets[b])
            if inter and inter >= threshold * (len(sets[a]) + len(sets[b]) - inter) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (root(i), links[i]) for i in ids}


def near_copies(n, length, changes, seed):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(changes + 1)):
            w[rnd.randrange(length)] = f"v{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_word_hashes_follow_the_word_definition():
    texts = ["", "A b", "straße Éa  x1-y", "b a", "\x00", "日本 語", "x" * 50]
    h, n = textvec.word_hashes([t.encode() for t in texts])
    assert n.tolist() == [len(words(t)) for t in texts]
    flat = [w for t in texts for w in words(t)]
    assert len(set(h.tolist())) == len(set(flat))
    assert {w: x for w, x in zip(flat, h.tolist())} == dict(zip(flat, h.tolist()))
    long = " ".join(f"w{i}" for i in range(200_000)) * 5
    a, k = textvec.word_hashes([long.encode()])
    assert len(long) > 4 << 20 and k.tolist() == [len(long.split())] and (a[:1000] == textvec.word_hashes([long[:20_000].encode()])[0][:1000]).all()


@pytest.mark.parametrize("cfg", [op2.Join(), op2.Join(leaf=16, depth=3)])
def test_join_matches_brute_force(spark, awkward, cfg):
    texts = near_copies(60, 60, 4, 1) + near_copies(25, 200, 12, 2) + ["a b", "a b", "a  B", "b a", "", None]
    texts += [f"shared line of boiler plate text here {' '.join(f'z{i}x{j}' for j in range(30))}" for i in range(40)]
    rows = [(1000 + i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in op2.join(docs, cfg).collect()}
    assert got == brute_classes(rows)


def test_join_defined_results(spark, awkward, empty):
    got = {}
    for r in op2.join(awkward).collect():
        got.setdefault(r.doc_id, []).append((r.class_id, r.n_links))
    assert got[5] == [(5, 1), (5, 1)] and got[1] == [(1, 0)] and got[2] == [(2, 0)] and got[None] == [(None, 0)] * 2
    assert op2.join(empty).count() == 0


def test_deduplicate_keeps_one_row_of_each_class_when_ids_repeat(spark):
    import corpus_pipeline as cp
    text = lambda c, n=60: " ".join(f"{c}{i}" for i in range(n))
    near = text("a") + " end"
    rows = [(1, text("a")), (5, near), (5, text("b")), (5, text("b")), (5, text("b") + " end"), (5, text("c")),
            (6, None), (6, ""), (None, text("a"))]
    left = [tuple(r) for r in cp.deduplicate(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()]
    assert len(left) == 6 and sorted(t[:1] for i, t in left if i == 5) == ["b", "c"] and near not in [t for _, t in left]
    assert (1, text("a")) in left and (None, text("a")) in left and (6, None) in left and (6, "") in left


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in op2.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[j] == 100 for j in range(101, 160))


def brute_contamination(docs, items):
    wins = [(k, tuple(w[i:i + 13])) for k, t in items for w in [words(t)] for i in range(max(1, len(w) - 12)) if w]
    out = {}
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for k, x in wins:
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i:i + len(x)]) == x:
                    hit |= set(range(i, i + len(x)))
                    found.add(k)
        out[d] = (len(w), len(hit), len(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("bits", [1 << 22, 64])
def test_contamination_matches_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(op6, "MAX_BITS", bits)  # 64: most words pass the test and go through the join
    rnd = random.Random(8)
    vocab = ["a", "b", "É", "the", "Of", "x1"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([0, 2, 3, 13, 20]))) for i in range(12)] + [(50, None), (51, "the of"), (52, "The of")]
    docs = [(i, text(rnd.randrange(60)) + " " + (items[i % 12][1] or "") + ". " + text(5)) for i in range(40)] + [(90, None), (91, ""), (92, "the")]
    got = op6.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got.collect()} == brute_contamination(docs, items)


def test_contamination_judges_every_row_by_its_own_text(spark, tmp_path):
    import corpus_pipeline as cp
    item = " ".join(f"q{i}" for i in range(13))
    clean, long = "nothing of it here", " ".join(f"z{i}" for i in range(1000))
    docs = [(None, clean), (None, "x " + item), (None, long), (None, None), (7, clean), (7, item), (7, long), (8, item), (8, item), (9, "")]
    items = [(1, item)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in op6.contamination(d, it).collect()]
    want = [(i, *brute_contamination([(0, t)], items)[0]) for i, t in docs]
    assert sorted(got, key=str) == sorted(want, key=str)
    it.write.parquet(str(tmp_path / "benchmark.parquet"))
    left = [tuple(r) for r in cp.decontaminate(spark, d, str(tmp_path)).collect()]
    assert sorted(left, key=str) == sorted([(i, t) for i, t in docs if item not in (t or "")], key=str)


def test_contamination_without_items_or_documents(spark, awkward, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 and not r.contaminated for r in op6.contamination(awkward, none).collect())
    some = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert op6.contamination(empty, some).count() == 0
    got = {r.doc_id: r.contaminated for r in op6.contamination(awkward, some).collect()}
    assert got[4] is True and got[1] is False and None in got


def test_ids_are_the_library_s():
    ids = op5.WordIds(tokenizer_file("word_bpe_49k.json"))
    for t in ["It's DON'T we'LL x<|endoftext|>y", "<|ENDOFTEXT|> a", "İstanbul ΣΑΣ 1½²", "a\x0bb\x0cc\x1cd", "'s's'tt''re", "ÀÉÎ ß Ÿ", "", " \n ", "x" * 3000]:
        assert ids.encode(t).tolist() == ids.tok.encode(t, add_special_tokens=False).ids


def test_nnls_against_a_known_solution():
    rnd = np.random.default_rng(1)
    a = rnd.random((12, 30))
    x = np.maximum(rnd.standard_normal(30), 0) * (rnd.random(30) < 0.3)
    got = op5.nnls(a, a @ x)
    assert (got >= 0).all() and np.linalg.norm(a @ got - a @ x) < 1e-6


def test_plan_uses_every_piece_once():
    cfg = op5.Packing()
    h = {4096: 3, 64: 1000, 128: 7, 4032: 11, 1024: 4, 2048: 5, 5: 900, 63: 1}
    plan = op5.plan(h, cfg)
    used = {}
    for inside, times in plan:
        assert sum(k * n for k, n in inside.items()) <= cfg.window
        for k, n in inside.items():
            used[k] = used.get(k, 0) + n * times
    assert used == h


def check_packing(rows, want):
    """want: doc_id -> ids with the end id."""
    seqs, docs = {}, {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append(r)
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 4096
    for d, ids in want.items():
        at = 0
        for r in sorted(docs[d], key=lambda r: r.start):
            piece = np.array(ids[at:at + r.length], dtype="<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(piece.tobytes()))
            at += r.length
        assert at == len(ids)
    return len(seqs)


def test_packing_round_trip(spark):
    path = tokenizer_file("word_bpe_49k.json")
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["Hello", "wörld", "x1", "don't"]) for _ in range(rnd.choice([0, 3, 50, 700, 6000])))) for i in range(80)] + [(99, None)]
    got = op5.pack(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    lib = op5.WordIds(path).tok
    want = {i: lib.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    n = check_packing(got, want)
    assert n <= -(-sum(map(len, want.values())) // 4096) + 2


def test_packing_awkward_rows(spark, awkward, empty):
    path = tokenizer_file("word_bpe_49k.json")
    got = op5.pack(awkward, path).collect()
    assert sum(r.length for r in got if r.start == 0 and r.length == r.doc_tokens) >= 1
    assert sum(1 for r in got if r.doc_id is None and r.start == 0) == 2 and op5.pack(empty, path).count() == 0


def test_shards(spark, awkward, empty):
    rnd = random.Random(3)
    rows = [(i, "t" * rnd.randrange(1, 400) + str(i)) for i in range(3000)] + [(10_000 + i, "hot text " * 9) for i in range(1500)] + [(20_000, None), (20_001, "")]
    got = op8.shard(spark.createDataFrame(rows, "doc_id long, text string"), 16, rows_per_block=50).collect()
    sizes, slots, groups = {}, {}, {}
    text = dict(rows)
    for r in got:
        assert r.size == len((text[r.doc_id] or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode())
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        groups.setdefault(text[r.doc_id] or "", set()).add(r.shard)
    assert sorted(r.doc_id for r in got) == sorted(text) and set(sizes) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) < 1.05 * min(sizes.values())
    assert sum(len(s) > 1 for s in groups.values()) <= 1  # only the text that fills more than a shard
    assert op8.shard(awkward).count() == awkward.count() and op8.shard(empty).count() == 0


def test_shards_split_rows_that_repeat(spark):
    """One text in all rows, without ids: the shards still come out even."""
    d = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    got = op8.shard(d, 16, rows_per_block=100).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"),
                                                                   F.max("slot").alias("last")).collect()
    n = [r.n for r in got]
    assert len(n) == 16 and sum(n) == 20_000 and max(n) <= 1.05 * min(n)
    assert all(r.slots == r.n and r.last == r.n - 1 for r in got)


def test_sampled_keys_are_bounded(spark):
    rows = op8.measured(spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.col("id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int"))).alias("text")))
    total = rows.agg(F.sum("size")).first()[0]
    cuts = op8.splitters(rows, 64, total, 500)
    got = rows.groupBy(op8.range_of(F.col("key"), cuts).alias("r")).agg(F.sum("size").alias("b")).collect()
    assert len(cuts) == 63 and len(got) == 64 and max(r.b for r in got) < 4 * total / 64


def test_similar_in_ranges_of_the_hash(monkeypatch):
    rnd = np.random.default_rng(4)
    base = np.unique(rnd.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2))
    sets = [np.unique(np.concatenate([base[rnd.random(len(base)) < p], rnd.integers(0, 1 << 63, 30, dtype=np.uint64)])) for p in (1, 1, .95, .9, .8, .5, 1, .99)]
    want = [[i != j and len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    assert op2.similar(sets, 0.8).tolist() == want
    monkeypatch.setattr(op2, "TOKENS_AT_ONCE", 100)
    assert op2.similar(sets, 0.8).tolist() == want


def test_runs_reach_the_recall():
    cfg = op2.Join()
    assert cfg.miss(cfg.runs) <= 1 - cfg.recall < cfg.miss(cfg.runs - 1)


@pytest.mark.parametrize("bits,share", [(1 << 22, 0.01), (1 << 16, 0.2)])
def test_prefix_bitmap_passes_every_prefix_and_few_others(spark, monkeypatch, bits, share):
    monkeypatch.setattr(op6, "MAX_BITS", bits)
    own = spark.range(12_000).select(F.concat(F.lit("é"), F.col("id").cast("string")).alias("token"))
    prefix = op6.maybe_prefix(own)
    assert own.where(~prefix(F.col("token"))).count() == 0
    others = spark.range(50_000).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("token"))
    assert others.where(prefix(F.col("token"))).count() < share * 50_000
    none = op6.maybe_prefix(own.limit(0))
    assert others.where(none(F.col("token"))).count() == 0


def test_item_ids_keep_their_type(spark):
    d = spark.createDataFrame([(1, "the quick fox"), (2, "none")], "doc_id long, text string")
    it = spark.createDataFrame([("a-1", "quick fox"), ("b/2", "Quick FOX")], "item_id string, text string")
    assert {r.doc_id: sorted(r.item_ids) for r in op6.contamination(d, it).collect()} == {1: ["a-1", "b/2"], 2: []}


def test_decontamination_without_broadcast(spark, monkeypatch):
    """A benchmark too large to broadcast: end rows go round the join."""
    monkeypatch.setattr(op6, "bounded_broadcast", lambda df: (df, False))
    d = spark.createDataFrame([(1, "the quick fox"), (2, None), (3, ""), (3, "")], "doc_id long, text string")
    it = spark.createDataFrame([(7, "quick fox")], "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit) for r in op6.contamination(d, it).collect())
    assert got == [(1, 3, 2), (2, 0, 0), (3, 0, 0), (3, 0, 0)]
