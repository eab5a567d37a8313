"""Operators on texts against brute force, over edge cases and the smallest documents."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pannier.llm import fingerprints as fp
from pannier.llm import jaccard, langid, licenses, mixing, packing, passages, quality, token_counts, tokens
from pannier.llm.components import connected
from pannier.llm.queries import QUERIES, TOKENIZERS
from pannier.sources.scratch import Scratch

PASSAGE = " ".join(f"word{n} of the passage" for n in range(30))
LONG = " ".join(f"t{n * 7919 % 10007}" for n in range(6000))
TEXTS = [
    None, "", " \t\n", "one", "Three Words here", "same text", "same text", "ünïcödé ñandú straße 東京 𝔘",
    PASSAGE, "before it " + PASSAGE + " and after", PASSAGE.upper(), LONG, LONG + " tail", "a" * 700, "ab" * 400,
    "It's  double  spaced \n\n text\t. <|endoftext|> <|startoftext|> x<|endoftext|>y", "word " * 300,
    " leading and trailing ", "nbsp  here   and\x1cthere", "12 34!? ...",
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n bigint, score double, size bigint, key bigint, spans string"


@pytest.fixture(scope="module")
def docs(spark):
    """Edge cases, rows repeated, a NULL key, and columns whose names operators use themselves."""
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, 1, 0.5, 2, 3, "x") for i, t in enumerate(TEXTS)]
    rows += [rows[8], (None, "no key here at all", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts(df):
    return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def reachable(sets):
    """Smallest key reachable by links, of keys in sets."""
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for at, a in enumerate(keys):
        for b in keys[:at]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


# Packing and token counts


def check_packing(rows, expected, size=2048):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for key, ids in expected.items():
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    return len(by_sequence)


def test_packing_edges(docs, empty):
    path = f"{TOKENIZERS}/byte_bpe_50k.json"
    tok = tokens.tokenizer(path)
    one_each = docs.dropDuplicates(["doc_id"])
    rows = packing.pack(one_each, path, size=256, open_windows=2, least_cut=16, merged_tasks=2).collect()
    expected = {k: tok.encode(t, add_special_tokens=False).ids + [1] for k, t in texts(one_each).items()}
    check_packing(rows, expected, 256)
    assert packing.pack(docs, path).agg(F.sum("length")).first()[0] == sum(map(len, expected.values())) + len(expected[8])
    assert packing.pack(empty, path).count() == 0


def test_packing_pads_little(spark, corpus):
    path = f"{TOKENIZERS}/byte_bpe_50k.json"
    tok = tokens.tokenizer(path)
    rows = QUERIES["op3_packing"](spark, SMALL).collect()
    expected = {k: tok.encode(t, add_special_tokens=False).ids + [1] for k, t in texts(corpus).items()}
    sequences = check_packing(rows, expected)
    assert sum(map(len, expected.values())) > 0.9 * 2048 * (sequences - 1)


def test_token_counts(spark, docs, empty):
    path = f"{TOKENIZERS}/word_bpe_49k.json"
    tok = tokens.tokenizer(path)
    cache = Scratch.of(spark).path("cache")
    for _ in range(2):  # the second time everything is in the cache
        rows = token_counts.token_counts(docs, path, cache, ["doc_id", "text"]).collect()
        assert len(rows) == len(TEXTS) + 2
        for r in rows:
            text = r["text"] or ""
            assert r["n_tokens"] == len(tok.encode(text, add_special_tokens=False).ids), text[:40]
            assert r["n_bytes"] == len(text.encode()) and r["over_limit"] == (r["n_tokens"] > 2048)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() < len(rows)
    assert token_counts.token_counts(empty, path, cache).count() == 0


# Fingerprints


def test_prefix_hashes_find_extensions():
    a, b = fp.PrefixHash("xxabcdefgh"), fp.PrefixHash("abcdefzz")
    assert a.extension(2, b, 0) == 6 and a.extension(0, b, 0) == 0
    assert a.span(2, 8) == b.span(0, 6) != b.span(1, 7)


def test_fingerprints(spark, docs, empty):
    rows = fp.fingerprints(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    order = sorted(
        ((r["doc_id"], r["text"] or "") for r in docs.collect()),
        key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()),
    )
    expected = []
    for at, (key, text) in enumerate(order):
        following, half = order[(at + 1) % len(order)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), text))
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows)
    assert got == Counter(e[:3] for e in expected)
    by_key = {r["doc_id"]: r for r in rows}
    assert by_key[5]["fingerprint"] == by_key[6]["fingerprint"] and by_key[5]["near_next"] == 1.0
    assert len({r["fingerprint"] for r in rows}) == len({t for *_, t in expected})
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))
    single = fp.fingerprints(docs.filter("doc_id = 11")).first()
    assert single["near_next"] == 1.0 and fp.fingerprints(empty).count() == 0


# Mixing


def test_targets_are_reshared_until_none_is_above(spark):
    sizes = spark.createDataFrame([("is a", 10), ("is b", 1000), ("is c", 1000), ("null", 0)], "source_key string, source_size bigint")
    targets = {r[0]: r[2] for r in mixing.source_targets(sizes).collect()}
    assert targets["is a"] == 30 and targets["null"] == 0
    assert targets["is b"] == pytest.approx(1980 * 2 / 3) and targets["is c"] == pytest.approx(1980 / 3)


def test_mix(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["target"]] += r["taken"]
        target[r["target"]] = r
    assert all(total == int(t) for t, total in taken.items())
    assert Counter(rows) == Counter(mixing.mix(docs.repartition(7)).collect())
    assert mixing.mix(empty).count() == 0


# Near duplicates


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 15, 16, 31, 33, 64, 100, 127, 128, 130, 1000])
def test_linked_sets_share_a_block(n):
    rng = np.random.default_rng(n)
    for _ in range(40):
        base = rng.integers(0, 1 << 54, 2 * n, dtype=np.uint64)
        common = int(np.ceil(0.8 * n))
        m = rng.integers(common, int(common * 1.25) + 1)  # sizes of a linked partner
        extra = min(n - common, int(common / 0.8) - common)
        while common < n and 5 * common < 4 * (n + m - common):
            common += 1
        if 5 * common < 4 * (n + m - common) or common > m:
            continue
        one, two = base[:n], np.concatenate([base[:common], base[n : n + m - common]])
        of = np.repeat([0, 1], [len(one), len(two)])
        order = np.lexsort((np.concatenate([one, two]), of))
        owner, keys = jaccard.block_keys(of, np.concatenate([one, two])[order], np.array([len(one), len(two)]))
        assert set(keys[owner == 0]) & set(keys[owner == 1]), (n, m, common, extra)


def test_tree_pairs_are_all_pairs_within_the_bound():
    rng = np.random.default_rng(3)
    vectors = rng.poisson(1, (200, jaccard.GROUPS)).astype(np.uint32)
    vectors[100:] = vectors[:100]
    vectors[100:, 0] += 1
    n, component = vectors.sum(axis=1).astype(np.int64), np.arange(200) % 150
    tree = jaccard.RTree(vectors, n, component)
    rough, found = ({tuple(sorted(p)) for a, b, _ in tree.pairs(fine) for p in zip(a.tolist(), b.tolist())} for fine in (False, True))
    assert found <= rough
    expected = {
        (a, b) for b in range(200) for a in range(b)
        if component[a] != component[b] and 9 * np.minimum(vectors[a], vectors[b]).sum() >= 4 * (n[a] + n[b])
    }
    assert found == expected and len(found) >= 50


def test_components(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 102), (102, 101), (7, 7), (50, 50)]
    rows = connected(spark.createDataFrame(path, "a bigint, b bigint")).collect()
    assert {r["id"]: r["component"] for r in rows} == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100, 50: 50}


def test_near_duplicates_edges(docs, empty):
    one_each = docs.dropDuplicates(["doc_id"])
    sets = {k: shingle_set(t) for k, t in texts(one_each).items()}
    roots = reachable({k: s for k, s in sets.items() if k is not None})
    rows = jaccard.near_duplicates(docs, ["doc_id"]).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == (None if r["doc_id"] is None else roots[r["doc_id"]])
    assert jaccard.near_duplicates(empty, ["doc_id"]).count() == 0


def test_near_duplicates_of_families(spark):
    """Chains of edits, near copies in number, and a line that all share."""
    rng = np.random.default_rng(1)
    rows = []
    for family in range(6):
        words = [f"f{family}w{n}" for n in range(60 + 40 * family)]
        for copy in range(25):
            for _ in range(1 + copy % 3):
                words[rng.integers(len(words))] = f"x{rng.integers(1 << 30)}"
            rows.append((len(rows), "a line that very many documents share " + " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(frame, ["doc_id"]).collect()}
    assert found == reachable({k: shingle_set(t) for k, t in rows})
    assert 6 < len(set(found.values())) < len(rows)


def test_near_duplicates_of_the_corpus(spark, corpus):
    found = {r["doc_id"]: r["component_id"] for r in QUERIES["op6_jaccard_join"](spark, SMALL).collect()}
    assert found == reachable({k: shingle_set(t) for k, t in texts(corpus).items()})


# Repeated passages


def removed(all_texts):
    """What is removed of each text, given as (key, text) with repeats."""
    raw = [(k, (t or "").encode()) for k, t in all_texts]
    times = Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    out = []
    for key, b in raw:
        mark = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if times[b[i : i + 200]] > 1:
                mark[i : i + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~mark[:-1]])
        spans = int((mark[:-1] & ~np.concatenate([[False], mark[:-2]])).sum()) if len(b) else 0
        out.append((key, len(b), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("group", [passages.GROUP, 1])
def test_removal_edges(docs, empty, group):
    rows = passages.remove_repeats(docs, ["doc_id"], group=group).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    assert got == removed([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert passages.remove_repeats(empty, ["doc_id"]).count() == 0


@pytest.mark.parametrize("group", [passages.GROUP, 4])
def test_passages_with_many_neighbours(spark, group):
    """A passage in many documents: its first and last triggers have a phrase for each."""
    rng = np.random.default_rng(5)
    noise = lambda n: " ".join(f"{x:x}" for x in rng.integers(0, 1 << 30, n))
    rows = [(k, f"{noise(40)} {PASSAGE[: 200 + k * 9]} {noise(40)}") for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = passages.remove_repeats(frame, ["doc_id"], group=group).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert got == removed(rows)


def test_removal_of_the_corpus(spark, corpus):
    rows = QUERIES["op4_suffix_dedup"](spark, SMALL).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    assert got == removed(texts(corpus).items())


# Models


def test_language_edges(docs, empty):
    network = langid.train(docs, steps=2)
    rows = langid.identify(docs, network, ["doc_id", "text"]).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        has = any(c.isalpha() for c in r["text"] or "")
        assert r["lang_pred"] == ("en" if has else "und") and 0 <= r["score"] <= 1
    assert langid.train(empty) is None
    assert langid.identify(docs, None, ["doc_id"]).filter("lang_pred <> 'und'").count() == 0
    assert langid.identify(empty, network, ["doc_id"]).count() == 0


def test_network_gradients():
    rng = np.random.default_rng(2)
    network = langid.Network(["a", "b"], hidden=3)
    symbols = rng.integers(0, 5, (6, 4)).astype(np.int16)
    symbols[4:, 1] = langid.PAD
    truth = np.array([0, 1, 1, 0])

    def loss():
        found, _ = network.positions(symbols)
        inside = symbols != langid.PAD
        return -(np.log(found[:, truth, np.arange(4)].astype(np.float64)) * inside).sum() / inside.sum()

    found = network.gradients(symbols, truth)
    for weight, gradient in zip(network.weights(), found):
        for at in list(np.ndindex(weight.shape))[:: max(1, weight.size // 12)]:
            if weight.shape[1] == langid.PAD + 1 and at[1] == langid.PAD:
                continue
            old = weight[at]
            weight[at] = old + 1e-2
            up = loss()
            weight[at] = old - 1e-2
            slope, weight[at] = (up - loss()) / 2e-2, old
            assert gradient[at] == pytest.approx(slope, abs=2e-3)


def test_language_accuracy(spark, corpus):
    rows = QUERIES["op7_language_id"](spark, SMALL).join(corpus.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_quality_edges(spark, docs, empty):
    measured = quality.statistics(docs, ["doc_id"])
    rows = {r["doc_id"]: r for r in measured.collect()}
    assert rows[0][1:] == rows[1][1:] and set(rows[0][1:]) == {0.0}
    assert rows[16]["repeated_words"] == pytest.approx(299 / 300) and rows[4]["distinct_words"] == 1.0
    labels = spark.createDataFrame([(3, 1, 0), (11, 1, 0), (12, 0, 0), (12, 0, 0), (13, 0, None), (None, 1, 1), (14, None, 1)], "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.filter("quality = 1"), labels.limit(0)):
        model = quality.train(measured, known, F.lit(True))
        scored = quality.classify(measured, model, ["doc_id"]).collect()
        assert len(scored) == len(TEXTS) + 2 and all(0 <= r["score"] <= 1 for r in scored)
        assert all(r["predicted"] == (r["score"] >= 0.3) for r in scored)
    assert quality.statistics(empty, ["doc_id"]).count() == 0


def test_quality_accuracy(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = QUERIES["op1_quality"](spark, SMALL).join(labels, "doc_id").collect()
    assert sum(r["quality"] == r["predicted"] for r in rows) >= 0.9 * len(rows)


# Licenses


def test_license_scan(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "h/a/LICENSE", gpl), (2, "h/a/b/c.txt", "nothing"), (3, "h/a/d.txt", "Released under the MIT License."),
        (4, "h/x/y", "text"), (5, "h/LICENSE", "<p>Licensed under CC BY-NC 4.0.</p><script>Released under the MIT License</script>"),
        (6, None, gpl), (7, "h/a/e", None), (8, "h/x/z", "A long story about people who read the MIT pages and learn a lot from them."),
        (9, "h/x/z", "second part"), (10, "", "rootless"),
    ]
    files = spark.createDataFrame(rows, "id int, path string, text string").withColumn("license", F.lit("clash"))
    found = licenses.scan_with_inheritance(files, F.col("path").endswith("LICENSE"), ["id"]).collect()
    got = {r["id"]: (r["license"], r["inherited_from"]) for r in found}
    assert got == {
        1: ("GPL-3.0", None), 2: ("GPL-3.0", "h/a"), 3: ("MIT", None), 4: ("CC-BY-NC-4.0", "h"), 5: ("CC-BY-NC-4.0", None),
        6: (None, None), 7: ("GPL-3.0", "h/a"), 8: ("CC-BY-NC-4.0", "h"), 9: ("CC-BY-NC-4.0", "h"), 10: (None, None),
    }
    assert licenses.scan_with_inheritance(files.limit(0), F.lit(True), ["id"]).count() == 0


def test_license_variants(spark):
    """Statements, headers and license files, none of which is in the fixture."""
    gnu = "\n# it under the terms of the GNU {} as published by\n# the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.\n#\n# See the file."
    mit = "MIT License\n\nCopyright (c) 2020 Someone\n\n" + licenses.TEXTS["MIT"].replace("conditions: The", "conditions:\n\nThe")
    two, three = (f"Copyright 2019, X\n\n{licenses.TEXTS[f'BSD-{n}-Clause']}\n\ndef code(): pass" for n in (2, 3))
    cases = [
        ("Licensed under CC BY 4.0", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("Licensed under CC BY-ND 4.0", "CC-BY-ND-4.0"), ("Licensed under CC BY-NC-SA 3.0", "CC-BY-NC-SA-3.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("Text is available under the Creative Commons Attribution 3.0 Unported License", "CC-BY-3.0"),
        ("This article is available under the terms of the Creative Commons Attribution-ShareAlike 3.0 Unported License", "CC-BY-SA-3.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("Licensed under GPLv3", "GPL-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
        ("Released under the BSD License", "BSD"), ("Released under the BSD 2-Clause License.", "BSD-2-Clause"),
        ("Released under the GPL", "GPL"), ("Licensed under the Apache License, Version 1.1", "Apache-1.1"),
        (licenses.MIT_GRANT, "MIT"), (licenses.ISC_GRANT, "ISC"), (mit, "MIT"), (two, "BSD-2-Clause"), (three, "BSD-3-Clause"),
        ("# This program is free software; you can redistribute it and/or modify" + gnu.format("General Public License", 2), "GPL-2.0"),
        ("# This library is free software; you can redistribute it and/or modify" + gnu.format("Lesser General Public License", 2.1), "LGPL-2.1"),
        ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Preamble", "GPL-3.0"),
        ("Released under CC0 1.0", "CC0-1.0"), ("Mozilla Public License Version 2.0\n====\n\n1. Definitions", "MPL-2.0"),
        ("A long story about people who read the GPL version 3 and the MIT pages and learn a lot from them.", None),
        ("Ein Haus mit Garten", None), ("mit", None), ("Mit 4", None), ("CC", None), ("Apache", None), ("Permission of the owner is needed.", None), ("CC the manager by 4.0 pm", None),
    ]
    frame = spark.createDataFrame([(str(k), t) for k, (t, _) in enumerate(cases)], "path string, text string")
    found = {r["path"]: r["license"] for r in licenses.scan(frame).collect()}
    wrong = [(t[:60], found.get(str(k)), name) for k, (t, name) in enumerate(cases) if found.get(str(k)) != name]
    assert wrong == []
