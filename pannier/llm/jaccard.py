"""N-gram Jaccard join with R-trees over count vectors."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pannier.llm.arrays import IS_SPACE, LOWER, mixed, runs, slices, text_bytes, word_hashes, words_array
from pannier.llm.components import connected
from pannier.sources.scratch import Scratch

WORDS = 5
GROUPS, FOLD = 256, 8  # coordinates of a count vector; a tree's boxes add up so many of them to one
LEAF = 32
PART = 1024  # sets of a block that one task links first
HALF = 4096  # of a large block that one task holds against another half, or searches alone
PAIRS = 100_000  # of a batch
BITS = 54  # of a shingle's hash; a text's number in its slice takes the bits above
LOW = np.uint64((1 << BITS) - 1)
# Similarity 0.8: a link needs 5 * common >= 4 * union, that is 9 * common >= 4 * (n + m), so the
# texts differ in at most (n + m) / 9 <= n / 4 shingles, and 0.8 <= n / m <= 1.25.


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts: each one's text, and the hashes, ascending in a text."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, of = runs(~IS_SPACE[data], offsets)
    word = word_hashes(words_array(data, starts, ends))
    counts = np.bincount(of, minlength=len(texts))
    first = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    begin = np.flatnonzero(of[: max(0, len(of) - WORDS + 1)] == of[WORDS - 1 :]) if len(of) >= WORDS else np.empty(0, np.int64)
    value = word[begin]
    for k in range(1, WORDS):
        value = mixed(value * np.uint64(3) + word[begin + k])
    whole = word[first[short]] if len(short) else np.empty(0, np.uint64)
    for k in range(1, WORDS):
        more = counts[short] > k
        whole[more] = mixed(whole[more] * np.uint64(5) + word[first[short][more] + k])
    value = np.concatenate([value, mixed(whole + counts[short].astype(np.uint64))])
    owner = np.concatenate([of[begin], short]).astype(np.uint64)
    both = np.sort(owner << np.uint64(BITS) | value & LOW)
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    return (both >> np.uint64(BITS)).astype(np.int64), both & LOW


def exact_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same shingles by their words: numbers that are equal, within these texts, for equal shingles only."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, of = runs(~IS_SPACE[data], offsets)
    words = words_array(data, starts, ends).indices.to_numpy().astype(np.int64) + 1
    counts = np.bincount(of, minlength=len(texts))
    first = np.cumsum(counts) - counts
    length = np.minimum(counts, WORDS)  # 0 stands for words that a short text lacks
    begin = np.arange(len(of))
    begin = begin[begin - first[of] <= counts[of] - length[of]]
    number, size = words[begin], int(words.max(initial=0)) + 1
    for k in range(1, WORDS):
        more = length[of[begin]] > k
        following = np.where(more, words[np.where(more, begin + k, 0)], 0) if len(begin) else begin
        _, number = np.unique(number * size + following, return_inverse=True)
    owner = of[begin]
    both = np.unique(owner * (int(number.max(initial=0)) + 1) + number)
    return both // (int(number.max(initial=0)) + 1), both % (int(number.max(initial=0)) + 1)


def _lowest(of: np.ndarray, values: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``most[text]`` smallest values of each text."""
    both = np.sort(of.astype(np.uint64) << np.uint64(BITS) | values)
    of = (both >> np.uint64(BITS)).astype(np.int64)
    counts = np.bincount(of, minlength=len(most))
    place = np.arange(len(of)) - (np.cumsum(counts) - counts)[of]
    kept = place < most[of]
    return of[kept], both[kept] & LOW


def block_keys(of: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys such that two linked texts share one: each key's text, and the keys.

    Texts of sizes from a power of two to the next hash their shingles to the same number of
    groups. Linked texts differ in at most ``d = n // 4`` shingles, so at most ``d`` of a
    text's filled groups are not the other's too, shingle by shingle; among any ``d + 1`` of
    them, the lowest by a hash of their content for instance, is a common one. A text whose
    larger partners may fall into the next class takes keys there too. Where a text has no
    more than ``d`` filled groups it takes all, and its lowest ``d + 1`` shingles besides, for
    partners of which the same holds.
    """
    texts, d = len(counts), counts // 4
    size_class = np.frexp(np.maximum(counts, 1))[1] - 1
    out_of, out_keys = [], []
    for step in (0, 1):
        classes = size_class + step
        takes = counts > 0 if step == 0 else (5 * counts // 4 >= 1 << classes) & (counts > 0)
        number = np.where(takes, np.maximum(1, (3 << classes) // 5), 0)
        base = np.cumsum(number) - number
        chosen = takes[of]
        o, h = of[chosen], hashes[chosen]
        spread = mixed(h + np.uint64(0x51ED27))
        group = (spread >> np.uint64(20)).astype(np.int64) % np.maximum(number[o], 1)
        at = base[o] + group
        total = int(number.sum())
        filled = np.flatnonzero(np.bincount(at, minlength=total))
        low = np.bincount(at, (h & np.uint64((1 << 27) - 1)).astype(np.float64), total)[filled].astype(np.uint64)
        high = np.bincount(at, (h >> np.uint64(27)).astype(np.float64), total)[filled].astype(np.uint64)
        owner = np.searchsorted(base + number, filled, side="right")
        name = (filled - base[owner] << 6 | classes[owner]).astype(np.uint64)
        content = mixed(mixed(mixed(low) + high) + name) & LOW
        full = np.bincount(owner, minlength=texts)
        a, b = _lowest(owner, content, np.where(full > d, d + 1, full))
        out_of.append(a)
        out_keys.append(b.astype(np.int64))
        if step == 0 or (takes & (full <= d)).any():
            rare = (full <= d) & takes
            mine = rare[of]
            a, b = _lowest(of[mine], hashes[mine], np.where(rare, d + 1, 0))
            out_of.append(a)
            out_keys.append(-1 - b.astype(np.int64))  # apart from keys of groups
    return np.concatenate(out_of), np.concatenate(out_keys)


SET = "n bigint, digest binary, vector binary, block_keys array<bigint>"


def _sets(keep: list[str]):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                n = part.num_rows
                of, hashes = shingles(part.column("_text"))
                counts = np.bincount(of, minlength=n)
                ends = np.cumsum(counts)
                digests = [blake2b(own.tobytes(), digest_size=16).digest() for own in np.split(hashes, ends[:-1])]
                vectors = np.bincount(of * GROUPS + (hashes % np.uint64(GROUPS)).astype(np.int64), minlength=n * GROUPS)
                vectors = vectors.reshape(n, GROUPS)
                large = vectors.max(axis=1, initial=0) > 255  # counts are bytes wherever they fit
                owner, keys = block_keys(of, hashes, counts)
                order = np.argsort(owner, kind="stable")
                limits = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
                columns = [
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([v.astype("<u4" if x else "u1").tobytes() for v, x in zip(vectors, large)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(limits), pa.array(keys[order])),
                ]
                names = ["n", "digest", "vector", "block_keys"]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *columns], [*keep, *names])

    return sets


def _runs_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of whole runs of equal values, and where each run starts, of rows sorted by ``column``."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        frame = batch.to_pandas()
        if not len(frame):
            continue
        values = frame[column].to_numpy()
        last = np.flatnonzero(values != values[-1])
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut or (held and held[-1][column].iloc[-1] != values[0]):
            ready = pd.concat([*held, frame.iloc[:cut]], ignore_index=True)
            held = [frame.iloc[cut:]]
            values = ready[column].to_numpy()
            yield ready, np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        else:
            held.append(frame)
    if held:
        ready = pd.concat(held, ignore_index=True)
        values = ready[column].to_numpy()
        yield ready, np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def _shared_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of two sets or more, named after their members, so that equal blocks are one."""
    for frame, starts in _runs_of(batches, "key"):
        ids = frame["set_id"].to_numpy()
        sizes = np.diff(np.concatenate([starts, [len(ids)]]))
        names = mixed(np.add.reduceat(mixed(ids.view(np.uint64)), starts) + sizes.astype(np.uint64)).view(np.int64)
        shared = np.repeat(sizes > 1, sizes)
        found = pd.DataFrame({"block": np.repeat(names, sizes)[shared], "set_id": ids[shared]}).drop_duplicates()
        yield pa.RecordBatch.from_pandas(found, preserve_index=False)


class RTree:
    """Boxes over count vectors: a node has the largest count of each group, its sizes and components.

    Boxes have the sums of ``FOLD`` groups as coordinates.
    """

    def __init__(self, vectors: np.ndarray, n: np.ndarray, component: np.ndarray):
        self.fine, self.n, self.component = vectors, n, component
        self.vectors = vectors.reshape(len(vectors), -1, FOLD).sum(axis=2, dtype=np.int32)
        self.nodes: list[tuple] = []
        self.root = self._build(np.argsort(n, kind="stable"))

    def _build(self, rows: np.ndarray) -> int:
        inside = self.vectors[rows]
        high, sizes, components = inside.max(axis=0), self.n[rows], self.component[rows]
        only = components[0] if (components == components[0]).all() else None
        children = None
        if len(rows) > LEAF:
            spread = high - inside.min(axis=0)
            by = self.n[rows] if np.ptp(sizes) > spread.max() else inside[:, int(np.argmax(spread))]
            order = np.argsort(by, kind="stable")
            middle = len(rows) // 2
            children = self._build(rows[order[:middle]]), self._build(rows[order[middle:]])
        self.nodes.append((rows, high, int(sizes.min()), int(sizes.max()), only, children))
        return len(self.nodes) - 1

    def pairs(self, fine: bool, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows (a, b) of different components that may be linked, and the bound of their similarity.

        With ``fine``, pairs are also held against the bound of all groups. Where rows have two
        sides, pairs of one side are left out.
        """
        crossing = side is not None and len(side) > 0 and bool((side != side[0]).any())
        stack = [(self.root, self.root)]
        while stack:
            one, two = stack.pop()
            rows_a, high_a, least_a, most_a, only_a, kids_a = self.nodes[one]
            rows_b, high_b, least_b, most_b, only_b, kids_b = self.nodes[two]
            if only_a is not None and only_a == only_b or 5 * most_a < 4 * least_b or 5 * most_b < 4 * least_a:
                continue
            if 9 * int(np.minimum(high_a, high_b).sum()) < 4 * (least_a + least_b):
                continue
            if kids_a is None and kids_b is None:
                common = np.minimum(self.vectors[rows_a][:, None], self.vectors[rows_b][None]).sum(axis=2, dtype=np.int64)
                total = self.n[rows_a][:, None] + self.n[rows_b][None]
                fits = (9 * common >= 4 * total) & (self.component[rows_a][:, None] != self.component[rows_b][None])
                if crossing:
                    fits &= side[rows_a][:, None] != side[rows_b][None]
                a, b = np.nonzero(np.triu(fits, 1) if one == two else fits)
                common, total = common[a, b], total[a, b]
                if fine and len(a):
                    common = np.minimum(self.fine[rows_a[a]], self.fine[rows_b[b]]).sum(axis=1, dtype=np.int64)
                    kept = 9 * common >= 4 * total
                    a, b, common, total = a[kept], b[kept], common[kept], total[kept]
                if len(a):
                    yield rows_a[a], rows_b[b], common / (total - common)
            elif one == two:
                stack += [(kids_a[0], kids_a[0]), (kids_a[0], kids_a[1]), (kids_a[1], kids_a[1])]
            elif kids_b is None or kids_a is not None and len(rows_a) >= len(rows_b):
                stack += [(kid, two) for kid in kids_a]
            else:
                stack += [(one, kid) for kid in kids_b]


def _candidates(fine: bool, every: bool):
    """Pairs of a block's sets that its R-tree leaves; unless ``every``, each set's likeliest earlier one.

    In the second case a set that is in pairs, but has no earlier one, is paired with itself; so
    is every set of a part of a block, as it may be in pairs with the other parts.
    """

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(out: list[tuple]) -> pa.RecordBatch:
            a, b, bound = (np.concatenate(c) for c in zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(bound)], ["a", "b", "bound"])

        for frame, starts in _runs_of(batches, "block"):
            n, component, ids, side, part = (frame[c].to_numpy() for c in ("n", "component", "set_id", "side", "part"))
            out, held = [], 0
            for begin, end in zip(starts, [*starts[1:], len(frame)]):
                at = slice(begin, end)
                vectors = np.empty((end - begin, GROUPS), np.uint32)
                for k, raw in enumerate(frame["vector"].iloc[at]):
                    vectors[k] = np.frombuffer(raw, "u1" if len(raw) == GROUPS else "<u4")
                best: dict[int, tuple[float, int]] = {}
                met: set[int] = set(ids[at].tolist()) if not every and part[begin] else set()
                for a, b, bound in RTree(vectors, n[at], component[at]).pairs(fine, side[at]):
                    a, b = ids[at][a], ids[at][b]
                    earlier, later = np.minimum(a, b), np.maximum(a, b)
                    if every:
                        out.append((earlier, later, bound))
                        held += len(a)
                        if held > PAIRS:
                            yield table(out)
                            out, held = [], 0
                        continue
                    met.update(a.tolist(), b.tolist())
                    order = np.lexsort((earlier, -bound, later))
                    first = order[np.concatenate([[True], later[order][1:] != later[order][:-1]])]
                    for k in first:
                        found = (float(bound[k]), int(earlier[k]))
                        if found > best.get(int(later[k]), (-1.0, 0)):
                            best[int(later[k])] = found
                if best or met:
                    rows = [(e, later, bound) for later, (bound, e) in best.items()]
                    rows += [(x, x, -1.0) for x in met - best.keys()]
                    out.append(tuple(np.array(c) for c in zip(*rows)))
            if out:
                yield table(out)

    return candidates


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a set's shingles in a power of two of groups, about half as many as shingles."""
    for batch in batches:
        for part in slices(batch, "_text"):
            of, hashes = shingles(part.column("_text"))
            counts = np.bincount(of, minlength=part.num_rows)
            sketches = []
            for own, n in zip(np.split(hashes, np.cumsum(counts)[:-1]), counts):
                groups = max(GROUPS, 1 << int(n // 2).bit_length())
                found = np.bincount((own % np.uint64(groups)).astype(np.int64), minlength=groups)
                sketches.append(found.astype("<u2").tobytes())  # n is below 2**16 times its groups
            yield pa.RecordBatch.from_arrays(
                [part.column("set_id"), pa.array(counts, pa.int64()), pa.array(sketches, pa.binary())], ["set_id", "n", "sketch"]
            )


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose smaller counts, in as many groups as both have, allow a link."""
    for batch in batches:
        kept = []
        for one, two, n, m in zip(*(batch.column(c).to_pylist() for c in ("one", "two", "n", "m"))):
            one, two = (np.frombuffer(x, "<u2").astype(np.int64) for x in (one, two))
            groups = min(len(one), len(two))
            one, two = (x.reshape(-1, groups).sum(axis=0) for x in (one, two))
            kept.append(9 * int(np.minimum(one, two).sum()) >= 4 * (n + m))
        mask = pa.array(kept, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of texts that are linked, by their words."""
    for batch in batches:
        for part in slices(batch, "one"):
            n = part.num_rows
            both = pa.concat_arrays([part.column(c).cast(pa.large_string()) for c in ("one", "two")])
            of, number = exact_shingles(both)
            total = np.bincount(of, minlength=2 * n)
            pair = np.sort(of % n * (int(number.max(initial=0)) + 1) + number)
            twice = pair[1:][pair[1:] == pair[:-1]] // (int(number.max(initial=0)) + 1)
            common = np.bincount(twice, minlength=n)
            linked = pa.array(100 * common >= 80 * (total[:n] + total[n:] - common))
            yield pa.RecordBatch.from_arrays([part.column("a").filter(linked), part.column("b").filter(linked)], ["a", "b"])


def near_duplicates(
    docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", group: str | None = None
) -> DataFrame:
    """``keep``, n_shingles and component_id, the smallest key reachable by links of similarity 0.8 or more.

    Words are runs of bytes other than ASCII white space, A to Z in lower case; shingles are
    five words, or the whole sequence of fewer. Equal sets fold to one. Sets that can be
    linked share a block (see ``block_keys``), and each block is searched with an R-tree over
    vectors that count a set's shingles by hash group: the sum of smaller counts bounds what
    two sets have in common. The pairs left are verified on the sets.

    Pairs are verified in rounds, as only what is reachable counts: first each set with the
    likeliest earlier one, again with the likeliest of another component, and then all pairs
    between sets of a block that are still in different components. So no link between
    components is lost, and a large family of near copies needs a few pairs for each member.
    A block of more than ``PART`` sets is linked in parts first, then by one set of each
    component; in the rounds after that, one of more than ``HALF`` is searched by pairs of
    halves, a task each. So no task holds more than two halves, and none is left out.

    Texts that are NULL, empty or without words have no shingles and are linked with nothing;
    their component is their own key. Repeated rows and equal texts are linked. NULL keys do
    not name a component unless all its keys are NULL. Other columns are ignored; an empty
    table gives an empty result.

    Where keys repeat, components may share a ``component_id``. ``group`` names a column for
    the component's own number, which they do not share; it is NULL without shingles.
    """
    if key not in keep:
        raise ValueError("keep must hold the key")
    scratch = Scratch.of(docs.sparkSession)
    rows = docs.select(*keep, F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("text_id"), F.col(text).alias("_text"))
    kept = [*keep, "text_id"]
    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in kept)
    measured = scratch.keep(rows.mapInArrow(_sets(kept), f"{kinds}, {SET}"), "sets")

    # Equal sets are one, with a number of its own; any of their texts stands for them.
    held = [F.first(c).alias(c) for c in ("n", "vector", "block_keys")]
    sets = measured.filter("n > 0").groupBy("digest").agg(F.min("text_id").alias("text_id"), *held)
    sets = scratch.keep(sets.withColumn("set_id", F.monotonically_increasing_id()), "distinct-sets")
    named = measured.select(*keep, F.col(key).alias("_key"), "n", "digest").join(sets.select("digest", "set_id"), "digest", "left")
    named = scratch.keep(named.drop("digest"), "rows")
    scratch.discard(measured)

    keyed = sets.select("set_id", F.explode("block_keys").alias("key")).repartition("key").sortWithinPartitions("key")
    blocks = keyed.mapInArrow(_shared_blocks, "block bigint, set_id bigint").distinct()
    members = scratch.keep(blocks, "block-members")

    def parted(light: DataFrame, most: int, halves: bool) -> DataFrame:
        """Blocks of more than ``most`` sets cut by a hash into parts, or into pairs of halves, that are blocks of their own."""
        large = light.groupBy("block").count().filter(F.col("count") > most)
        cut = light.join(scratch.keep(large.withColumn("parts", F.ceil(F.col("count") / most).cast("int")).drop("count"), "large-blocks"), "block", "left")
        cut = cut.withColumn("side", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("set_id"), "parts").cast("int")))
        cut = cut.withColumn("part", F.col("parts").isNotNull())
        if halves:
            other = F.when(F.col("part"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0)))
            cut = cut.withColumn("other", F.explode(other))
            name = F.xxhash64("block", F.least("side", "other"), F.greatest("side", "other"))
        else:
            name = F.xxhash64("block", "side")
        cut = cut.withColumn("block", F.when(F.col("part"), name).otherwise(F.col("block")))
        return cut.select("block", "set_id", "component", F.col("side") if halves else F.lit(0).alias("side"), "part")

    texts: DataFrame | None = None  # of sets that are in any pair

    def candidates(labels: DataFrame | None, every: bool, one_each: bool) -> DataFrame:
        """Pairs to verify, between components so far; ``one_each``: of one set of each component in a block."""
        light = members
        if labels is None:
            light = parted(members.withColumn("component", F.col("set_id")), PART, halves=False)
        else:  # only sets that were in pairs, and blocks of several components
            light = members.join(texts.select("set_id"), "set_id", "left_semi")
            light = light.join(labels.withColumnRenamed("id", "set_id"), "set_id", "left")
            light = light.withColumn("component", F.coalesce("component", "set_id"))
            several = light.groupBy("block").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"))
            several = several.filter("x <> y") if not one_each else several.filter((F.col("x") != F.col("y")) & (F.col("size") > PART))
            light = light.join(several.select("block"), "block", "left_semi")
            if one_each:
                light = light.groupBy("block", "component").agg(F.min("set_id").alias("set_id"))
            light = parted(scratch.keep(light, "open-blocks"), HALF, halves=True)
        inside = light.join(sets.select("set_id", "n", "vector"), "set_id")
        found = inside.repartition("block").sortWithinPartitions("block").mapInArrow(
            _candidates(labels is not None, every), "a bigint, b bigint, bound double"
        )
        if every:
            return scratch.keep(found.select("a", "b").distinct(), "pairs")
        likeliest = F.max(F.struct("bound", "a")).alias("best")
        return scratch.keep(found.groupBy("b").agg(likeliest).select("best.a", "b"), "pairs")

    def texts_of(pairs: DataFrame) -> DataFrame:
        """The text of one row of every set in pairs."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct().join(sets.select("set_id", "text_id"), "set_id")
        found = rows.select("text_id", "_text").join(wanted.hint("merge"), "text_id").dropDuplicates(["text_id"])
        return scratch.keep(found.select("set_id", "_text"), "texts")

    def with_both(pairs: DataFrame, values: DataFrame, *columns: tuple[str, str, str]) -> DataFrame:
        """Pairs with values of both sets. Both sides grow with the corpus, so these are merge joins at any size."""
        a = values.select(F.col("set_id").alias("a"), *(F.col(c).alias(x) for c, x, _ in columns))
        b = values.select(F.col("set_id").alias("b"), *(F.col(c).alias(y) for c, _, y in columns))
        return pairs.join(b.hint("merge"), "b").join(a.hint("merge"), "a")

    def verified(pairs: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
        """The linked pairs; those that finer counts rule out go before texts are moved."""
        counted = with_both(pairs, sketches, ("sketch", "one", "two"), ("n", "n", "m"))
        likely = scratch.keep(counted.mapInArrow(_bounded, "a bigint, b bigint"), "likely")
        asked = likely.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        spoken = texts.join(scratch.keep(asked, "asked"), "set_id", "left_semi")
        return scratch.keep(with_both(likely, spoken, ("_text", "one", "two")).mapInArrow(_verify, "a bigint, b bigint"), "verified")

    labels, links, sketches = None, None, None
    has_large = not members.groupBy("block").count().filter(F.col("count") > PART).isEmpty()
    for every, one_each in ((False, False), *([(False, True)] if has_large else []), (False, False), (True, False)):
        pairs = candidates(labels, every, one_each)
        if texts is None:
            texts = texts_of(pairs)
            sketches = scratch.keep(texts.mapInArrow(_sketches, "set_id bigint, n bigint, sketch binary"), "sketches")
        pairs = pairs.filter("a <> b")
        if pairs.isEmpty():
            if labels is None and has_large:
                labels = scratch.keep(sets.select(F.col("set_id").alias("id"), F.col("set_id").alias("component")).limit(0), "labels")
            if one_each or labels is not None and links is None:
                continue
            break
        found = verified(pairs, texts, sketches)
        links = found if links is None else links.unionByName(found)
        labels = connected(links)
    if texts is not None:
        scratch.discard(texts, sketches)

    if labels is not None:
        named = named.join(labels.withColumnRenamed("id", "set_id"), "set_id", "left")
        named = named.withColumn("component", F.coalesce("component", "set_id"))
    else:
        named = named.withColumn("component", F.col("set_id"))
    smallest = named.filter("n > 0").groupBy("component").agg(F.min("_key").alias("component_id"))
    joined = named.join(smallest, "component", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_key"))
    numbers = [F.when(F.col("n") > 0, F.col("component")).alias(group)] if group else []
    return joined.select(*keep, F.col("n").alias("n_shingles"), own.alias("component_id"), *numbers)
