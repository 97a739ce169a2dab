"""Every operator over nulls, empty and long texts, repeated rows, empty tables and columns with clashing names."""

import zlib

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest

from cinderspark.llm import bpe, decontaminate, jaccard_join, language, line_dedup, neighbours, secrets, suffix_tree, token_store, toxicity

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
LONG = "word " * 30_000
ROWS = [(1, None, "n1"), (2, "", "n2"), (3, "  \t\n ", "x"), (4, "One two three.\nfour five six seven eight", "y"), (4, "One two three.\nfour five six seven eight", "y"), (5, LONG, "z"), (None, "a null id has text", "w"), (6, "ÀÉ 中文 \U0001f600 don't", "v"), (7, "q7" * 150_000, "u")]


@pytest.fixture(scope="module")
def docs(spark):
    named = [(*r, r[2], 0, 0.5) for r in ROWS]
    return spark.createDataFrame(named, "doc_id long, text string, lang string, lost string, n int, score double")


def spec():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


OPERATORS = {
    "jaccard": lambda d: jaccard_join.jaccard_components(d),
    "line texts": lambda d: line_dedup.dedup_texts(d, 3, 2),
    "encode": lambda d: bpe.bpe_encode(d, RANKS),
    "round trip": lambda d: bpe.bpe_decode(bpe.bpe_encode(d, RANKS), RANKS),
    "index": lambda d: decontaminate.ask_index(decontaminate.build_index(d), d.selectExpr("doc_id as item_id", "text")),
    "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.fit_toxicity(d, d.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))),
    "suffix tree": lambda d: suffix_tree.score_texts(d),
    "secrets": lambda d: secrets.scan_secrets(d, secrets.fit_secrets(d)),
    "language": lambda d: language.predict_languages(d, language.fit_languages(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(docs, name):
    got = OPERATORS[name](docs)
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(r[0]) for r in ROWS)
    assert OPERATORS[name](docs.where("false")).count() == 0


def test_files_hold_each_row(spark, docs, tmp_path):
    for table, n in ((docs, len(ROWS)), (docs.where("false"), 0)):
        path = f"file:{tmp_path}/ids{n}"
        manifest = token_store.write_ids(table, spec(), path)
        got = token_store.read_ids(manifest, path).collect()
        assert len(got) == n
    starts = sorted((r["start"], r["n_tokens"]) for r in token_store.read_ids(token_store.write_ids(docs, spec(), f"file:{tmp_path}/x"), f"file:{tmp_path}/x").collect())
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))


def test_defined_results(docs):
    j = {r["doc_id"]: r for r in jaccard_join.jaccard_components(docs).collect()}
    assert (j[1]["n_shingles"], j[3]["n_shingles"], j[1]["component_id"], j[None]["component_id"], j[5]["n_shingles"]) == (0, 0, 1, None, 1)
    lines = {r["doc_id"]: r for r in line_dedup.dedup_texts(docs, 3, 2).collect()}
    assert line_dedup.line_dedup(docs, 3, 2).count() == line_dedup.line_dedup(docs.where("false"), 3, 2).count() == 0
    assert lines[1]["n_lines"] == lines[2]["n_lines"] == 1 and lines[4]["n_dropped"] == 0
    s = {r["doc_id"]: r for r in suffix_tree.score_texts(docs).collect()}
    assert s[1]["n_tokens"] == s[2]["n_tokens"] == s[3]["n_tokens"] == 1 and s[5]["n_tokens"] == 30_001
    lang = {r["doc_id"]: r for r in language.predict_languages(docs, language.fit_languages(docs)).collect()}
    assert lang[1]["lang_pred"] == lang[2]["lang_pred"] == "und" and lang[6]["lang_pred"] != "und"


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [1.0, inf]), (7, [None, 1.0]), (8, [1.0, 1.0]), (None, [1.0, 1.0]), (9, [1.0]), (10, [3.0, 0.0])]
    v = neighbours.usable(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, v int"))
    index, books = neighbours.build_index(v)
    got = neighbours.search(index, books, index.where("vec_id = 1").select("vec_id", "v")).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [2, 10, 8] and got[0]["score"] == 1.0
    index, books = neighbours.build_index(v.where("false"))
    assert neighbours.search(index, books, v.select("vec_id", "v")).count() == 0


def _recall(spark, x, **how):
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.tolist()}), "vec_id long, embedding array<double>")
    index, books = neighbours.build_index(neighbours.usable(table), sample_rows=6000)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for r in neighbours.search(index, books, index.where("vec_id % 500 = 0").select("vec_id", "v"), **how).orderBy("rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = 0
    for q, got in found.items():
        s = u @ u[q]
        s[q] = -2
        hits += len(set(np.lexsort((np.arange(len(s)), -s))[:5]) & set(got))
    assert len(found) == -(-len(x) // 500)
    return hits / (5 * len(found)), books, found


def test_neighbours_recall(spark):
    """50,000 vectors in groups around centres, and none: the lists and the shortlist lose few neighbours."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50_000, 32)) + 2 * rng.normal(size=(300, 32))[rng.integers(0, 300, 50_000)]
    recall, books, _ = _recall(spark, x)
    assert recall >= 0.9 and books.probes < 256
    assert _recall(spark, rng.normal(size=(20_000, 24)))[0] >= 0.9


def test_neighbours_of_many_copies(spark):
    """Of thousands of equal vectors in one list, in many pieces, the smallest ids come first."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 8))
    x[1000:4000] = x[0]
    _, _, found = _recall(spark, x, rows_at_once=500, queries_at_once=4)
    assert found[0] == [1000, 1001, 1002, 1003, 1004] and found[2000] == [0, 1000, 1001, 1002, 1003]


def test_crc_folds(spark):
    from pyspark.sql import functions as F

    from cinderspark.llm.common import fold

    got = {r["i"]: r["f"] for r in spark.range(50).withColumnRenamed("id", "i").select("i", fold("i", 5).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(50)}
    assert spark.range(1).select(F.lit(None).cast("long").alias("i")).select(fold("i", 5)).first()[0] == -1
