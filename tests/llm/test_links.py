"""The Jaccard join's number of links against all pairs."""

import collections
import ctypes
import random
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from cinderspark.llm import bpe, common, jaccard_join
from cinderspark.sources import tables


def shingle_set(text, width):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def all_pairs(made, width, num):
    """For each text the number of other distinct shingle sets that link to its own."""
    sets = [shingle_set(t, width) for t in made]
    distinct = [s for s in set(sets) if s]
    degree = collections.Counter()
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            both = len(a & b)
            if 100 * both >= num * (len(a) + len(b) - both):
                degree[a] += 1
                degree[b] += 1
    return [degree[s] for s in sets]


def copies(n, seed, groups=2):
    """Groups of near copies, with exact copies, and texts that link to nothing."""
    rng = random.Random(seed)
    out = ["", "a lone text that nothing else is like", None]
    for g in range(groups):
        base = [f"w{g}x{rng.randrange(400)}" for _ in range(120)]
        for _ in range(n):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(9)}"
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [512, 7])
def test_every_link_of_a_group_is_counted(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", block)
    made = copies(60, 3)
    got = {r["doc_id"]: r["n_links"] for r in jaccard_join.jaccard_components(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect()}
    want = all_pairs(made, 4, 85)
    assert max(want) > 20
    assert [got[i] for i in range(len(made))] == want


def test_rows_of_one_id_have_the_links_of_their_texts(spark):
    made = copies(8, 5)
    ids = [i // 2 for i in range(len(made))]
    rows = jaccard_join.jaccard_components(spark.createDataFrame(list(zip(ids, made, strict=True)), "doc_id long, text string")).collect()
    key = lambda i, n, k: (i, n, k)
    want = sorted(key(i, len(shingle_set(t, 4)), k) for i, t, k in zip(ids, made, all_pairs(made, 4, 85), strict=True))
    assert sorted(key(r["doc_id"], r["n_shingles"], r["n_links"]) for r in rows) == want


def test_the_query_has_the_links_of_all_pairs(spark):
    import __spark_entry__ as entry

    at = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{at}/documents.parquet").collect()}
    ids = sorted(texts)
    want = dict(zip(ids, all_pairs([texts[i] for i in ids], 4, 85), strict=True))
    got = {r["doc_id"]: r["n_links"] for r in entry.queries()["op1_jaccard"](spark, at).collect()}
    assert got == want and max(want.values()) > 0


def test_every_pair_of_blocks_of_one_signature_is_compared(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", 3)
    rows = [(9, i, i % 2 == 0, i % 5, 8, [0] * 8, 20) for i in range(20)]
    open_ = spark.createDataFrame(rows, "sig long, doc long, own boolean, component long, n long, sk array<bigint>, holders long")
    got = sorted((r["a"], r["b"]) for r in jaccard_join._in_blocks(open_, 85, 100).collect())
    assert got == sorted((a, b) for a in range(20) for b in range(a) if a % 5 != b % 5 and (a % 2 == 0 or b % 2 == 0))


def test_plans_choose_neighbourhoods_where_runs_are_frequent():
    rare, often = (jaccard_join.plans(85, 100, others)[1] for others in ((0.0, 0.0, 0.0, 0.0), (500.0, 100.0, 20.0, 4.0)))
    large = [i for i, p in enumerate(rare) if 60 <= p.high < 3000]
    assert any(often[i].get().a > 0 for i in large) and all(p.get().m + p.get().a > p.get().most for plans in (rare, often) for p in plans[10:40])


@pytest.mark.parametrize("num", [80, 85])
def test_fine_sketches_reject_what_is_apart_and_no_link(num):
    rng = np.random.default_rng(num)
    for _ in range(200):
        n = int(rng.integers(1, 6000))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.r_[x[rng.random(len(x)) > rng.random() * 0.3], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 4))).astype(np.uint64)])
        both = len(np.intersect1d(x, y))
        bits = jaccard_join.apart(jaccard_join.fine_sketch(x), jaccard_join.fine_sketch(y))
        assert bits == jaccard_join.apart(jaccard_join.fine_sketch(y), jaccard_join.fine_sketch(x)) <= len(x) + len(y) - 2 * both
        if len(y) and 100 * both >= num * (len(x) + len(y) - both):
            assert bits * (100 + num) <= (len(x) + len(y)) * (100 - num)
    x, y = (np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64)) for _ in range(2))
    assert jaccard_join.apart(jaccard_join.fine_sketch(x), jaccard_join.fine_sketch(y)) * (100 + num) > (len(x) + len(y)) * (100 - num)


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_only_texts_of_likely_pairs_are_verified(spark, monkeypatch, sent):
    """Long texts that share a passage share signatures, but no more; their texts don't travel."""
    monkeypatch.setattr(jaccard_join, "SENT_IDS", sent)
    asked, plain = [], jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *rest: asked.append(pairs.count()) or plain(pairs, *rest))
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(1200)]
    made = [" ".join(passage + [f"t{i}x{rng.randrange(10**9)}" for _ in range(1800)]) for i in range(12)]
    made += [made[0] + " more", made[5] + " and more"]
    rows = {r["doc_id"]: r for r in jaccard_join.jaccard_components(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect()}
    assert [rows[i]["component_id"] for i in range(14)] == [*range(12), 0, 5]
    assert [rows[i]["n_links"] for i in range(14)] == all_pairs(made, 4, 85)
    assert sum(asked) == 2


@pytest.mark.parametrize("others", [(0.0,) * 4, (500.0, 100.0, 20.0, 4.0), (1e6,) * 4])
def test_linked_sets_share_a_signature_whatever_the_sampled_frequencies(others):
    """Frequencies of runs choose how sets are cut; a linked pair shares a signature, one of them an own one, for all of them."""
    rng = np.random.default_rng(5)
    linked = 0
    for _ in range(150):
        x = np.unique(rng.integers(0, 1 << 63, int(rng.integers(20, 200))).astype(np.uint64))
        y = np.unique(np.r_[x[rng.random(len(x)) > rng.random() * 0.12], rng.integers(0, 1 << 63, int(rng.integers(0, 6))).astype(np.uint64)])
        both = len(np.intersect1d(x, y))
        if 100 * both < 85 * (len(x) + len(y) - both):
            continue
        linked += 1
        (own, less), (own2, less2) = (jaccard_join.signatures(s, 85, 100, others) for s in (x, y))
        assert len(np.intersect1d(own, np.r_[own2, less2])) or len(np.intersect1d(less, own2))
    assert linked > 50


def test_texts_reach_python_in_small_batches_while_a_working_table_is_written(spark):
    docs = spark.range(0, 300, 1, 1).selectExpr("id", "repeat('some words ', 10000) as text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    kept = tables.written(docs.mapInArrow(sizes, "size long"), "sizes")
    got = [r["size"] for r in kept.collect()]
    tables.drop(kept)
    assert sum(got) > 30_000_000 and max(got) < 4_000_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != tables.WRITING["spark.sql.execution.arrow.maxBytesPerBatch"]


def test_sets_of_many_texts_need_little_memory(monkeypatch):
    monkeypatch.setattr(common, "_powers", [])
    made = [" ".join(f"w{i * j % 977}" for j in range(300)) for i in range(1500)]
    few = list(jaccard_join.shingle_sets(made, 4))
    assert sum(map(len, made)) > 1 << 20 and sum(p.nbytes for p in common._powers) <= 8 << 20
    for x, y in zip(few, jaccard_join.shingle_sets(made, 4, 1 << 22), strict=True):
        assert np.array_equal(x, y)


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="the C library has no such call")
def test_a_task_gives_freed_memory_back():
    held = lambda: int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024
    kept = [np.ones(12_000) for _ in range(3000)]
    kept = kept[::300]
    before = held()
    assert list(common.rows(iter([]), "x")) == [] and before - held() > 150


def test_small_blocks_give_the_same_token_ids(spark):
    made = [(i, f"words of text {i * 7919} and more " * (i % 9)) for i in range(60)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    few, many = ({r["doc_id"]: r["ids"] for r in bpe.bpe_encode(docs, ranks, most_chars=n).collect()} for n in (24_000_000, 50))
    assert few == many and len(few) == 60


def test_linked_sets_meet_in_a_signature_that_neither_leaves_out():
    """Whatever the frequencies are, as long as both documents order equal signatures in the same way."""
    rng = np.random.default_rng(4)
    band = np.uint64((1 << jaccard_join.BAND_BITS) - 1)
    spared = 0
    for others in ((0.0,) * 4, (8.0, 1.0, 0.6, 0.4), (500.0, 100.0, 20.0, 4.0)):
        for _ in range(150):
            n = int(rng.integers(1, 1500))
            x = np.unique(rng.integers(0, (1 << 64) - 1, n, dtype=np.uint64))
            gone = int(rng.integers(0, int(0.15 * len(x)) + 1))
            y = np.sort(np.r_[rng.choice(x, len(x) - gone, replace=False), rng.integers(0, (1 << 64) - 1, int(rng.integers(0, gone // 4 + 1)), dtype=np.uint64)])
            both = len(np.intersect1d(x, y))
            if 100 * both < 85 * (len(x) + len(y) - both) or np.array_equal(x, y):
                continue
            salt, held = rng.integers(1, 1 << 60, dtype=np.uint64), []
            for z in (x, y):
                own, less, spare = jaccard_join.spared_signatures(z, 85, 100, others)
                often = common.mix(own ^ salt) % np.uint64(7)  # how often a signature is held: any function of it
                kept = set()
                for b in np.unique(own & band):
                    of = np.flatnonzero(((own & band) == b) & (spare > 0))
                    order = of[np.lexsort((own[of], -often[of].astype(int)))]
                    kept |= {int(own[i]) for k, i in enumerate(order, 1) if k > spare[i]}
                    kept |= {int(s) for s in own[((own & band) == b) & (spare == 0)]}
                    spared += len(order) > 0
                held.append((kept, {int(s) for s in less}))
            (own, less), (own2, less2) = held
            assert own & own2 or own & less2 or less & own2
    assert spared > 300


def test_long_texts_that_share_frequent_phrases_by_chance_are_not_paired(spark, monkeypatch):
    """Each two of 240 texts share some 50 of 200 phrases among 1,400 shingles, far from a link; near copies among them are found."""
    rng = random.Random(6)
    phrases = [" ".join(f"p{k}x{i}" for i in range(4)) for k in range(200)]
    made = []
    for d in range(240):
        parts = [" ".join(f"d{d}w{i}v{j}" for j in range(20)) for i in range(50)]
        for phrase in rng.sample(phrases, 100):
            parts.insert(rng.randrange(len(parts)), phrase)
        made.append(" ".join(parts))
    made += [" ".join(w if i % 400 else "other" for i, w in enumerate(t.split())) for t in made[:10]]
    asked, plain = [], jaccard_join._links
    monkeypatch.setattr(jaccard_join, "_links", lambda pairs, *rest: asked.append(pairs.count()) or plain(pairs, *rest))
    rows = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect()}
    assert [rows[i] for i in range(250)] == [*range(240), *range(10)]
    assert sum(asked) < 60, asked
