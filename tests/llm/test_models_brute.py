"""Samples, statistics, rules, networks and extensions against plain versions."""

import math
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pannier.llm import fingerprints as fp
from pannier.llm import langid, quality, token_counts
from pannier.llm.queries import QUERIES
from pannier.llm.sampling import lowest_marks
from pannier.sources.scratch import shared_folder

LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [1, 7, 50, 5000])
def test_lowest_marks(spark, n):
    rng = np.random.default_rng(n)
    marks = [int(m) for m in rng.integers(-(2**63), 2**63 - 1, 900)] + [-(2**63), 2**63 - 1]
    rows = [(m, g) for m in marks for g in ("a", "b", None) if m % 3 or g != "b"]
    rows += [rows[5]] * 1000 + [(m, "few") for m in marks[:3]]
    df = spark.createDataFrame(rows, "mark bigint, g string").repartition(5)
    found = {r["g"]: r["last_mark"] for r in lowest_marks(df, n, ["g"]).collect()}
    expected = {g: sorted({m for m, h in rows if h == g})[:n][-1] for g in ("a", "b", None, "few")}
    assert found == expected
    assert lowest_marks(df, n).first()["last_mark"] == sorted({m for m, _ in rows})[:n][-1]


def test_lowest_marks_of_close_values_and_of_none(spark):
    df = spark.range(100, 400).select(F.col("id").alias("mark"), F.lit("x").alias("g"))  # all in one range
    assert [tuple(r) for r in lowest_marks(df, 9, ["g"]).collect()] == [("x", 108)]
    assert lowest_marks(df.limit(0), 9, ["g"]).count() == 0
    assert lowest_marks(df.limit(0), 9).collect()[0]["last_mark"] is None  # the one group of all rows


def plain_statistics(text):
    data = (text or "").encode()
    size = max(len(data), 1)
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = re.findall(rb"[^\n]+", data)

    def share(members):
        return sum(b in members for b in data) / size

    return {
        "log_bytes": math.log1p(len(data)),
        "log_words": math.log1p(len(words)),
        "word_length": sum(map(len, words)) / max(len(words), 1),
        "longest_word": math.log1p(max(map(len, words), default=0)),
        "upper_share": share(bytes(range(65, 91))),
        "digit_share": share(bytes(range(48, 58))),
        "mark_share": share(b"#$%&*+<=>@[\\]^_`{}~/"),
        "bar_share": share(b"|"),
        "exclamation_share": share(b"!"),
        "line_share": share(b"\n"),
        "stop_share": share(b".,;:?"),
        "distinct_words": len(set(words)) / max(len(words), 1),
        "repeated_words": sum(a == b for a, b in zip(words, words[1:])) / max(len(words), 1),
        "distinct_lines": len(set(lines)) / max(len(lines), 1),
    }


def test_quality_of_every_document_by_hand(spark):
    """Statistics, rules and scores of whole texts, each recomputed plainly."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(-1, None), (-2, ""), (-3, " \n\t "), (-4, "a a  a\n\na a\nünï ünï"), (-5, "X" * 50_000 + "!|#9\n" * 9)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    measured = quality.statistics(docs, ["doc_id"])
    model = quality.train(measured, spark.read.parquet(f"{SMALL}/labels.parquet"), F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    assert model.rules
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = {r["doc_id"]: r for r in quality.classify(measured, model, ["doc_id"]).collect()}
    for row in measured.collect():
        plain = plain_statistics(texts[row["doc_id"]])
        assert {n: row[n] for n in quality.STATISTICS} == pytest.approx(plain, abs=1e-12)
        held = [w for rule, w in model.rules if all(low < row[name] <= high for name, low, high in rule)]
        assert scores[row["doc_id"]]["score"] == pytest.approx(1 / (1 + math.exp(-model.intercept - sum(held))), abs=1e-12)
    assert len(scores) == len(texts)


def test_quality_accuracy_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = QUERIES["op1_quality"](spark, LARGER).filter("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    for truth in (0, 1):  # of each label, so that the frequent one does not decide
        of = [r["predicted"] == truth for r in rows if r["quality"] == truth]
        assert len(of) > 10 and sum(of) >= 0.85 * len(of)


def _gate(x):
    return np.minimum(np.maximum(0.25 * x + 0.5, 0), 1)


def _plain_states(direction, symbols):
    """The recurrence written out, one byte after the other."""
    h, last, states = direction.hidden, np.zeros(direction.hidden), []
    for symbol in symbols:
        read, carried = direction.byte[:, symbol].astype(float), direction.state.astype(float) @ last
        update, reset = _gate(read[:h] + carried[:h]), _gate(read[h : 2 * h] + carried[h : 2 * h])
        candidate = np.tanh(read[2 * h :] + reset * carried[2 * h :])
        last = last + update * (candidate - last)
        states.append(last)
    return states


def plain_language(network, text):
    data, total = text.encode(), np.zeros(len(network.labels))
    for at in range(0, len(data), langid.WINDOW):
        window = list(data[at : at + langid.WINDOW])
        ahead, back = _plain_states(network.ahead, window), _plain_states(network.back, window[::-1])[::-1]
        for one, two in zip(ahead, back):
            scores = network.out.astype(float) @ np.concatenate([one, two]) + network.bias[:, 0]
            total += np.exp(scores - scores.max()) / np.exp(scores - scores.max()).sum()
    return total / len(data)


def test_language_of_documents_by_hand(spark):
    """Every byte of whole texts labelled and pooled by a plain version of the network."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    network = langid.train(docs, steps=60)
    texts = [(-1, "x"), (-2, "é"), (-3, "ab" * 64), (-4, "ab" * 64 + "c"), (-5, "東京 " * 300)]
    texts += [(r["doc_id"], r["text"]) for r in docs.filter("length(text) BETWEEN 1 AND 1500").orderBy("doc_id").limit(25).collect()]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in langid.identify(df, network, ["doc_id"]).collect()}
    for key, text in texts:
        means = plain_language(network, text)
        if found[key]["lang_pred"] != "und":
            assert found[key]["score"] == pytest.approx(means.max(), abs=1e-4)
            assert means[network.labels.index(found[key]["lang_pred"])] == pytest.approx(means.max(), abs=1e-4)
        else:
            assert not any(c.isalpha() for c in text)


def test_windows_end_in_padding():
    data = np.frombuffer("abcdefé".encode(), np.uint8)
    symbols, of = langid.windows(data, np.array([0, 3, 3]), np.array([3, 3, 8]), 4)
    assert symbols.T.tolist() == [[97, 98, 99, langid.PAD], [100, 101, 102, 0xC3], [0xA9, *[langid.PAD] * 3]]
    assert of.tolist() == [0, 2, 2]


def test_language_sample_ignores_repeats(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    hot = docs.filter("crc32(CAST(doc_id AS STRING)) % 5 <> 0 AND length(text) > 0 AND lang IS NOT NULL").orderBy("doc_id").limit(1)
    repeated = docs.unionByName(hot.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("again"))
    one, two = (langid.train(d, docs_per_label=20, steps=3) for d in (docs, repeated))
    assert one.labels == two.labels
    assert all(np.array_equal(a, b) for a, b in zip(one.weights(), two.weights()))


def test_token_counts_are_stored_between_runs(spark, monkeypatch):
    first = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op10_token_counts"](spark, SMALL).collect()}
    cache = f"{shared_folder(spark).rstrip('/')}/pannier-token-cache"
    stored = spark.read.parquet(cache).count()

    def refuse(path):
        def encode(batches):
            for batch in batches:
                assert batch.num_rows == 0, "a stored text is encoded again"
                yield batch.drop_columns(["text"])

        return encode

    monkeypatch.setattr(token_counts, "_encode", refuse)
    again = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op10_token_counts"](spark, SMALL).collect()}
    assert again == first and spark.read.parquet(cache).count() == stored


def test_common_starts_are_longest_common_extensions(spark):
    texts = ["same start, one end", "same start, another", "same start, another", "", "東京 is", "東京 was", "x" * 5000 + "a", "x" * 5000 + "b", "é", "e"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {r["doc_id"]: r["common_start"] for r in fp.fingerprints(df).collect()}
    assert found == {at: len(os.path.commonprefix([t, texts[(at + 1) % len(texts)]])) for at, t in enumerate(texts)}
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = ("".join(rng.choice(list("ab"), rng.integers(0, 40))) for _ in range(2))
        i, j = (int(rng.integers(0, len(t) + 1)) for t in (a, b))
        assert fp.PrefixHash(a).extension(i, fp.PrefixHash(b), j) == len(os.path.commonprefix([a[i:], b[j:]]))
