"""Vector codes, periodic runs and decontamination against brute force, with edge cases."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pannier.llm import codes
from pannier.llm.codes import BLOCK
from pannier.llm.contamination import decontaminate
from pannier.llm.periods import periodic_runs

# Vector codes


@pytest.mark.parametrize("dims, side", [(2, 16), (3, 4), (4, 4)])
def test_hilbert_neighbours_touch(dims, side):
    grid = np.array(list(itertools.product(range(side), repeat=dims)), np.int64)
    walked = grid[np.argsort(codes.hilbert_keys(grid))]
    assert (np.abs(np.diff(walked, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_lose_no_nearest_entry():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, dims = rng.integers(1, 400), rng.integers(1, 6)
        points = rng.integers(-20, 20, (n, dims))
        points = points[np.argsort(codes.hilbert_keys(points), kind="stable")]
        entries, cut = rng.integers(-20, 20, (rng.integers(1, 9), dims)), np.arange(0, n, BLOCK)
        low, high, sums = (f.reduceat(points, cut, axis=0) for f in (np.minimum, np.maximum, np.add))
        away = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        at, best = codes.nearest(points, low, high, entries)
        assert (at == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()
        count, total = codes._sums(points, low, high, sums, entries)
        for e in range(len(entries)):
            mine = points[away.argmin(axis=1) == e]
            assert count[e] == len(mine) and (total[e] == mine.sum(axis=0)).all()


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = np.array([[int(np.floor(4096 * np.float64(np.float32(x)))) for x in r[1]] for r in kept], object)
    pieces = whole.reshape(len(kept), parts, -1)
    book = [[list(pieces[e, p]) for e in range(min(entries, len(kept)))] for p in range(parts)]

    def assign(p):
        away = [[sum((a - b) ** 2 for a, b in zip(x, e)) for e in book[p]] for x in pieces[:, p]]
        return [(min(d), d.index(min(d))) for d in away]

    for _ in range(rounds):
        for p in range(parts):
            near = assign(p)
            for e in range(len(book[p])):
                mine = [pieces[k, p] for k in range(len(kept)) if near[k][1] == e]
                if mine:
                    book[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    near = [assign(p) for p in range(parts)]
    errors = [sum(near[p][k][0] for p in range(parts)) for k in range(len(kept))]
    out = []
    for k, (key, _, label) in enumerate(kept):
        total = sum(e for e, r in zip(errors, kept) if r[2] == label)
        out.append((key, "".join(f"{near[p][k][1]:02x}" for p in range(parts)), errors[k], total))
    flat = ",".join(str(x) for p in book for e in p for x in e)
    return sorted(out, key=repr), hashlib.sha256(flat.encode()).hexdigest()


def _coded(frame):
    coded, book = codes.compress(frame, ["vec_id", "label"])
    found = codes.label_errors(coded, "label").select("vec_id", "code", "error", "label_error")
    return sorted(map(tuple, found.collect()), key=repr), codes.digest(book)


@pytest.mark.parametrize("dims, n", [(8, 300), (24, 150), (16, 9)])
def test_codes(spark, dims, n):
    rng = np.random.default_rng(dims)
    rows = [(int(k), [float(np.float32(x)) for x in rng.integers(-9, 9, dims) / 7], int(k) % 3 if k % 5 else None) for k in range(n)]
    rows += [rows[2], rows[2], (None, rows[3][1], 1), (3, rows[4][1], None)]  # repeated rows, a NULL key, a key of two vectors
    rows += [(900, None, 1), (901, [None] * dims, 1), (902, [float("nan")] * dims, 2), (903, [float("-inf")] * dims, 2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    frame = frame.withColumn("code", F.lit("clash")).withColumn("error", F.lit(1)).repartition(4)
    assert _coded(frame) == plain_codes(rows)


def test_codes_of_odd_tables(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert _coded(spark.createDataFrame([], schema)) == ([], hashlib.sha256(b"").hexdigest())
    assert _coded(spark.createDataFrame([(1, None, 1), (2, [None] * 8, 1)], schema))[0] == []
    with pytest.raises(Exception, match="one length"):
        _coded(spark.createDataFrame([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], schema))
    with pytest.raises(Exception, match="below 16384"):
        _coded(spark.createDataFrame([(1, [1e9] * 8, 1)], schema))


# Periodic runs


def plain_runs(words):
    found = set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_periodic_runs(spark):
    rng, rows = random.Random(3), [(None, "a a a a a a b"), (1, None), (1, ""), (2, " \n"), (3, "x")]
    for key in range(400):
        words = [rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 8])]) for _ in range(rng.choice([0, 1, 5, 6, 20, 60, 150]))]
        for _ in range(rng.choice([0, 1, 3])):
            at, period = rng.randrange(len(words) + 1), rng.randint(1, 9)
            words[at:at] = words[at : at + period] * rng.randint(2, 7)
        rows.append((key, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [rows[9], rows[9], (7, "a " * 20_000), (8, " ".join(f"w{k % 999}" for k in range(9_000)))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("runs", F.lit("clash")).repartition(3)
    want = []
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        if len(words) < 9_000:
            found = plain_runs(words)
        else:
            found = [(0, len(words), 1 if key == 7 else 999)]
        dropped = {i for s, n, p in found for i in range(s + p, s + n)}
        top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        want.append((key, len(words), tuple(found), top, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    got = [
        (r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["top"] and tuple(r["top"]), r["collapsed"])
        for r in periodic_runs(frame, ["doc_id"]).collect()
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic_runs(frame.limit(0), ["doc_id"]).count() == 0


# Decontamination


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_hits(docs, items):
    windows = {}
    for item, text in items:
        words = tokens(text)
        for at in range(max(1, len(words) - 9)) if words else ():
            windows.setdefault(tuple(words[at : at + 10]), set()).add(item)
    out = []
    for key, text in docs:
        words, hit, named = tokens(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                found = windows.get(tuple(words[at : at + size]))
                if found is not None:
                    hit |= set(range(at, at + size))
                    named |= {str(x) for x in found if x is not None}
        listed = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((key, len(words), len(hit), len(named), listed, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_decontamination(spark, conf, threshold):
    conf(autoBroadcastJoinThreshold=threshold)
    rng = random.Random(5)

    def words(n, letters="abc"):
        return [rng.choice(letters) for _ in range(n)]

    items = [(k, " ".join(words(rng.choice([10, 11, 15, 30])))) for k in range(12)]
    items += [(20, "É, one-two"), (21, "solo"), (22, "a b"), (23, None), (24, " .,!"), (None, " ".join(words(12, "xyz"))), (0, "second text of zero here"), (25, items[3][1])]
    docs = [(None, "a b A-B"), (1, None), (1, ""), (2, "ünï solo É é ONE two É!ONE\x00two"), (3, "é one two"), (4, " ".join("a" * 40))]
    for key in range(5, 60):
        text = words(rng.choice([3, 9, 10, 40, 200]))
        for _ in range(rng.choice([0, 1, 2])):
            at, said = rng.randrange(len(text) + 1), tokens(rng.choice(items)[1])
            text[at:at] = said if rng.random() < 0.5 else said[: rng.choice([9, 10, 12])]
        docs.append((key, rng.choice([" ", "-", ".\n"]).join(text).title()))
    docs += [docs[20], docs[20], (99, docs[21][1]), (98, " ".join(words(20_000, "abcdefghijkl") + tokens(items[5][1])))]
    schema = "doc_id bigint, text string"
    frame = spark.createDataFrame(docs, schema).withColumn("words", F.lit("clash")).withColumn("n_hit", F.lit(3)).repartition(4)
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("size", F.lit("clash"))
    found = decontaminate(frame, bench, ["doc_id"])
    assert sorted(map(tuple, found.collect()), key=repr) == plain_hits(docs, items)


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words of a text"), (2, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "words of a text")], "item_id bigint, text string")
    assert decontaminate(docs.limit(0), bench, ["doc_id"]).count() == 0
    for nothing in (bench.limit(0), spark.createDataFrame([(1, None), (2, "?")], "item_id bigint, text string")):
        found = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate(docs, nothing, ["doc_id"]).collect()]
        assert sorted(found) == [(1, 5, 0, 0, False), (2, 0, 0, 0, False)]
