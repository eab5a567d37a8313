"""The Jaccard join where rows repeat, hashes might meet and blocks are large."""

import random

import pytest

import corpus_pipeline
from conftest import SMALL
from pannier.llm import jaccard
from test_text_operators import reachable, shingle_set


def words(name, n=40):
    return " ".join(f"{name}{k}" for k in range(n))


def _components(spark, rows, parts=1):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    found = jaccard.near_duplicates(frame, ["doc_id"], group="g").collect()
    return found


def test_equal_sets_have_one_id_wherever_they_stand(spark):
    rows = [(k, words(f"x{k}")) for k in range(50)]
    for k in range(60):
        rows.insert(k * 2 % len(rows), (100 + k, words("same")))
    for parts in (1, 4):
        found = _components(spark, rows, parts)
        assert {r["component_id"] for r in found if r["doc_id"] >= 100} == {100}
        assert len({r["g"] for r in found if r["doc_id"] >= 100}) == 1


def test_repeated_rows_keep_their_links(spark):
    rows = [(5, words("w")), (9, words("v")), (5, words("w")), (8, words("u")), (5, words("w")), (1, words("w") + " end")]
    assert sorted(r["component_id"] for r in _components(spark, rows) if r["doc_id"] == 5) == [1, 1, 1]


def test_words_of_equal_polynomials_are_not_linked(spark):
    def thue_morse(a, b, n=1024):
        return "".join((a, b)[bin(k).count("1") % 2] for k in range(n))

    found = _components(spark, [(1, thue_morse("a", "b")), (2, thue_morse("b", "a")), (3, thue_morse("a", "b"))])
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(1, 1), (2, 2), (3, 1)]


@pytest.mark.parametrize("part, half", [(1024, 4096), (8, 12)])
def test_families_of_near_copies(spark, monkeypatch, part, half):
    """Chains of changes, so that members of a family are linked through others only; blocks are cut or not."""
    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard, "HALF", half)
    rng, rows = random.Random(11), []
    for family in range(4):
        text = [f"f{family}w{k}" for k in range(60)]
        for member in range(30):
            if rng.random() < 0.6:
                text = list(text)
                text[rng.randrange(60)] = f"new{family}.{member}"
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
    rows += [(2000 + k, words("line", 8) + " " + words(f"own{k}", 3)) for k in range(40)]  # a shared line in short texts
    rng.shuffle(rows)
    want = reachable({k: shingle_set(t) for k, t in rows})
    assert {r["doc_id"]: r["component_id"] for r in _components(spark, rows, 3)} == want


def test_pipeline_keeps_one_of_equal_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(5, words("w"), "en", "s", 1), (9, words("v"), "en", "s", 1), (5, words("w"), "en", "s", 1), (6, words("w"), None, None, None)]
    rows += [(7, "", "en", "s", 0), (7, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, schema).repartition(1)
    found = sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect())
    assert found == [5, 7, 7, 9]
