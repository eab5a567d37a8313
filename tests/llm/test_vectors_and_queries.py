"""Top-k search, and every registered query against its SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from pannier.llm import topk
from pannier.llm.oracle import SQL
from pannier.llm.queries import QUERIES
from pannier.sources.scratch import Scratch


def best(rows, k, asks):
    vectors = {}
    for key, x in rows:
        if key is not None and x is not None and all(v is not None and np.isfinite(v) for v in x):
            vectors[key] = [int(np.floor(1024 * float(v))) for v in x]
    out = set()
    for q, x in vectors.items():
        if asks(q):
            scored = [(-sum(a * b for a, b in zip(x, y)), c) for c, y in vectors.items() if c != q and len(y) == len(x)]
            out |= {(q, rank, c, -score) for rank, (score, c) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("shard, block", [(32_768, 2_048), (40, 2)])
def test_top_k(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block)
    rng = np.random.default_rng(4)
    rows = [(k, [float(v) for v in rng.integers(-2, 3, 4) / 4]) for k in range(300)]  # many ties
    rows += [(300, None), (310, [1.0, None, 0.0, 0.0]), (320, [float("nan")] * 4), (330, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [1.0] * 4), (340, [1.0, 2.0]), (350, [0.5, -1.0]), (360, []), (0, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("clash"))
    found = {tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 10 == 0, k=5).collect()}
    assert found == best(rows, 5, lambda q: q % 10 == 0)
    assert topk.top_k(frame.limit(0), F.lit(True)).count() == 0
    assert topk.top_k(frame, F.lit(False)).count() == 0


def _rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(tuple, frame.where(frame.notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    assert _rows(QUERIES[name](spark, SMALL).toPandas()) == _rows(con.execute(SQL[name]).df())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, {"start": docs.toPandas()}
    for name, stage in corpus_pipeline.STAGES:
        docs = Scratch.of(spark).keep(stage(spark, docs, SMALL), name)
        seen[name] = docs.toPandas()
        if name != "packing":
            assert docs.columns == columns
    texts = seen["start"].text.fillna("")
    assert len(seen["language"]) == sum(any(c.isalpha() for c in t) for t in texts)
    groups = QUERIES["op6_jaccard_join"](spark, SMALL).toPandas()
    kept = set(seen["language"].doc_id)
    assert set(seen["near_copies"].doc_id) == set(groups[groups.doc_id.isin(kept)].groupby("component_id").doc_id.min())
    assert set(seen["repeated_passages"].doc_id) <= set(seen["near_copies"].doc_id)
    assert (seen["repeated_passages"].text.str.len() == seen["repeated_passages"].n_chars).all()
    copies = seen["source_mix"].groupby("doc_id").size()
    assert copies.max() <= 3 and set(copies.index) <= set(seen["repeated_passages"].doc_id)
    packed = seen["packing"]
    assert packed[packed.start == 0].groupby("doc_id").size().to_dict() == copies.to_dict()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = Scratch.of(spark).keep(stage(spark, docs, SMALL), name)
        assert docs.count() == 0


def test_near_copies_of_repeated_ids(spark):
    """A group keeps one row, whatever other texts stand under its doc_id."""
    def words(name, n=40):
        return " ".join(f"{name}{k}" for k in range(n))

    rows = [(1, words("a")), (1, words("b")), (1, words("c")), (2, words("a") + " end"), (3, words("b")), (1, words("a"))]
    rows += [(4, words("d")), (None, words("e")), (None, words("e")), (5, ""), (5, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect()), key=repr)
    kept = [(1, words("a")), (1, words("b")), (1, words("c")), (4, words("d")), (None, words("e")), (None, words("e")), (5, ""), (5, None)]
    assert found == sorted(kept, key=repr)


def test_top_k_of_repeated_keys(spark, monkeypatch):
    """Different vectors under one key are all candidates and queries, as in the SQL."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 20)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(7)
    rows = sorted({(int(k), tuple(int(v) for v in rng.integers(-4, 5, 3))) for k in rng.integers(0, 30, 150)})
    frame = spark.createDataFrame([(k, [v / 1024 for v in x]) for k, x in rows], "vec_id bigint, embedding array<float>")
    want = []
    for q in range(0, 30, 10):
        scored = sorted((-sum(a * b for a, b in zip(x, y)), c) for k, x in rows if k == q for c, y in rows if c != q)
        want += [(q, rank, c, -score) for rank, (score, c) in enumerate(scored[:10], 1)]
    assert sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 10 == 0).collect())) == sorted(want)
