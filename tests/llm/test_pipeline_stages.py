"""Each stage of the pipeline on its own rows, against brute force: NULLs, repeats, ties, long texts, other columns."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from pannier.llm import tokens
from pannier.llm.queries import TOKENIZERS
from test_text_operators import PASSAGE, TEXTS, check_packing, texts

COLUMNS = corpus_pipeline.COLUMNS
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    """Edge cases, equal rows, NULL in every column, and columns whose names the operators use themselves."""
    rows = [(k, t, "en" if k % 3 else "de", f"s{k % 4}" if k % 5 else None, len(t or "")) for k, t in enumerate(TEXTS)]
    rows += [rows[8], rows[8], rows[3], (None, None, None, None, None), (None, "no key " + PASSAGE, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    clashing = ("score", "size", "row_key", "_text", "_row", "spans", "label", "hash_key", "taken", "copy")
    return frame.select("*", *(F.lit(1).alias(name) for name in clashing)).repartition(3)


def rows_of(frame):
    assert frame.columns == COLUMNS
    return Counter(map(tuple, frame.collect()))


def test_language_rejects_texts_without_a_letter(spark, docs):
    want = Counter(tuple(r) for r in docs.select(*COLUMNS).collect() if any(c.isalpha() for c in r["text"] or ""))
    assert rows_of(STAGES["language"](spark, docs, SMALL)) == want


def plain_cut(all_texts):
    """Each text without the bytes that a string of 200 bytes found elsewhere too covers, and whether any went."""
    raw = [(t or "").encode() for t in all_texts]
    times = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    for text, b in zip(all_texts, raw):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if times[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]).decode(errors="ignore")
        yield (None if text is None else kept), bool(gone.any())


def test_repeated_passages_are_cut(spark, docs):
    rows = docs.select(*COLUMNS).collect()
    want = Counter()
    for r, (kept, cut) in zip(rows, plain_cut([r["text"] for r in rows])):
        if not cut or kept.strip(" "):
            want[(r["doc_id"], kept, r["lang"], r["source"], None if kept is None else len(kept))] += 1
    assert rows_of(STAGES["repeated_passages"](spark, docs, SMALL)) == want
    assert sum(want.values()) < len(rows)


def plain_targets(sizes):
    """Shares by weight; the excess of a source stopped at three times its size goes to the others."""
    weight = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [5, 2, 1] * len(sizes)))
    targets, free = {}, set(sizes)
    while True:
        level = (sum(sizes.values()) - sum(targets.values())) / max(1, sum(weight[s] for s in free))
        above = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not above:
            return targets | {s: level * weight[s] for s in free}
        targets |= {s: 3 * sizes[s] for s in above}
        free -= above


def test_source_mix_takes_each_budget(spark, docs):
    rows = docs.select(*COLUMNS).collect()
    words = lambda t: len((t or "").encode().translate(bytes.maketrans(b"\t\n\v\f\r", b"     ")).split(b" ")) - (
        (t or "").encode().translate(bytes.maketrans(b"\t\n\v\f\r", b"     ")).split(b" ").count(b"")
    )
    sizes, most, took = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += words(r["text"])
        most[r["source"]] = max(most[r["source"]], words(r["text"]))
    found, given = rows_of(STAGES["source_mix"](spark, docs, SMALL)), Counter(map(tuple, rows))
    for row, times in found.items():
        assert times <= 3 * given[row]
        took[row[3]] += times * words(row[1])
    for source, target in plain_targets(dict(sizes)).items():
        assert int(target) <= took[source] < int(target) + most[source] + (not most[source])
    assert found == rows_of(STAGES["source_mix"](spark, docs.repartition(5), SMALL))


def test_packing_holds_every_id_once(spark, docs):
    alone = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    tok = tokens.tokenizer(f"{TOKENIZERS}/byte_bpe_50k.json")
    expected = {k: tok.encode(t, add_special_tokens=False).ids + [1] for k, t in texts(alone).items()}
    check_packing(STAGES["packing"](spark, alone, SMALL).collect(), expected)
    total = sum(len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.select("text").collect())
    assert STAGES["packing"](spark, docs, SMALL).agg(F.sum("length")).first()[0] == total
