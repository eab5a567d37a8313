"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pannier.llm.sampling import lowest_marks
from pannier.sources.scratch import Scratch

PAD = 256  # the symbol after the end of a text; it leaves the state as it is
WINDOW = 128  # bytes that the network reads at a time


def held_out(key: str) -> Column:
    """Whether the row is kept for testing: crc32 of the key as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


class Direction:
    """Gated recurrent units reading left to right; states are columns, one per window.

    Gates are piecewise linear. ``byte`` holds what a byte adds to the update gate, the
    reset gate and the candidate, ``state`` what the last state adds.
    """

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        self.byte = rng.normal(0, 0.3, (3 * hidden, PAD + 1)).astype(np.float32)
        self.byte[:hidden, PAD] = -1e3  # the update gate stays shut
        self.state = rng.normal(0, hidden**-0.5, (3 * hidden, hidden)).astype(np.float32)

    def forward(self, symbols: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States after each of ``symbols`` (time, window), as (time, hidden, window)."""
        h, n = self.hidden, symbols.shape[1]
        states = np.empty((len(symbols), h, n), np.float32)
        last, read, carried = np.zeros((h, n), np.float32), np.empty((3 * h, n), np.float32), np.empty((3 * h, n), np.float32)
        for t, now in enumerate(symbols):
            np.take(self.byte, now, axis=1, out=read, mode="clip")
            np.matmul(self.state, last, out=carried)
            gates = read[: 2 * h]
            gates += carried[: 2 * h]
            gates *= 0.25
            gates += 0.5
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            new = gates[h:] * carried[2 * h :]
            new += read[2 * h :]
            np.tanh(new, out=new)
            if trace is not None:
                trace.append((now, last, gates.copy(), carried[2 * h :].copy(), new.copy()))
            new -= last
            new *= gates[:h]
            last = np.add(last, new, out=states[t])
        return states

    def backward(self, trace: list, errors: np.ndarray) -> list[np.ndarray]:
        """Gradients of ``byte`` and ``state`` from those of the states, back through time."""
        h = self.hidden
        d_byte, d_state = np.zeros_like(self.byte), np.zeros_like(self.state)
        later = np.zeros_like(errors[0])
        for t in range(len(trace) - 1, -1, -1):
            now, last, gates, carried, new = trace[t]
            update, reset = gates[:h], gates[h:]
            error = errors[t] + later
            open_gate = ((gates > 0) & (gates < 1)) * np.float32(0.25)
            d_new = error * update * (1 - new * new)
            d_update = error * (new - last) * open_gate[:h]
            d_reset = d_new * carried * open_gate[h:]
            to_read = np.concatenate([d_update, d_reset, d_new])
            to_state = np.concatenate([d_update, d_reset, d_new * reset])
            d_state += to_state @ last.T
            np.add.at(d_byte.T, now, to_read.T)
            later = error * (1 - update) + self.state.T @ to_state
        d_byte[:, PAD] = 0
        return [d_byte, d_state]


class Network:
    """Two directions and a linear layer that labels every position."""

    def __init__(self, labels: list[str], hidden: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.ahead, self.back = labels, Direction(hidden, rng), Direction(hidden, rng)
        self.out = rng.normal(0, 0.3, (len(labels), 2 * hidden)).astype(np.float32)
        self.bias = np.zeros((len(labels), 1), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.byte, self.ahead.state, self.back.byte, self.back.state, self.out, self.bias]

    def positions(self, symbols: np.ndarray, traces: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities (time, label, window) and the states behind them."""
        one, two = traces or (None, None)
        states = np.concatenate(
            [self.ahead.forward(symbols, one), self.back.forward(symbols[::-1], two)[::-1]], axis=1
        )
        scores = self.out @ states + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores, states

    def gradients(self, symbols: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy over positions of windows with labels ``truth``."""
        traces: tuple[list, list] = ([], [])
        errors, states = self.positions(symbols, traces)
        inside = symbols != PAD
        errors[:, truth, np.arange(len(truth))] -= 1
        errors *= inside[:, None, :] / np.float32(max(1, inside.sum()))
        d_out = np.einsum("tln,thn->lh", errors, states, optimize=True)
        d_states = self.out.T @ errors
        h = self.ahead.hidden
        return [
            *self.ahead.backward(traces[0], d_states[:, :h]),
            *self.back.backward(traces[1], d_states[::-1, h:]),
            d_out,
            errors.sum(axis=(0, 2))[:, None],
        ]

    def fit(self, symbols: np.ndarray, truth: np.ndarray, steps: int, batch: int = 128, rate: float = 0.02, seed: int = 7) -> None:
        """Adam over batches in which every label is as frequent as any other."""
        rng = np.random.default_rng(seed)
        weights = self.weights()
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        of_label = [np.flatnonzero(truth == label) for label in range(len(self.labels))]
        for step in range(1, steps + 1):
            picked = np.concatenate([rng.choice(rows, 1 + batch // len(of_label)) for rows in of_label])
            found = self.gradients(symbols[:, picked], truth[picked])
            size = np.sqrt(sum(float((g * g).sum()) for g in found))
            now = rate * (1 - step / (steps + 1)) * min(1.0, 1.0 / (size + 1e-9))
            for w, g, m, v in zip(weights, found, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut texts, spans of ``data``, into windows: symbols (time, window) and each window's text."""
    pieces = -(-(ends - starts) // size)
    of = np.repeat(np.arange(len(starts)), pieces)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = (starts[of] + nth * size)[None, :] + np.arange(size)[:, None]
    inside = at < ends[of][None, :]
    symbols = np.full(at.shape, PAD, np.int16)  # wider than a byte, which PAD does not fit in
    symbols[inside] = data[at[inside]]
    return symbols, of


def train(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    docs_per_label: int = 400,
    windows_per_doc: int = 8,
    steps: int = 500,
    hidden: int = 8,
) -> Network | None:
    """Fit a network to a bounded sample of the rows that are not held out, or None if there are none.

    The sample is, per language, the ``docs_per_label`` different rows lowest by a hash of key
    and text, and of each ``windows_per_doc`` windows at places of the whole text that the hash
    decides. Only fitting is bounded by it; predictions read whole texts. Rows that are equal
    in key, text and language count once.
    """
    learns = docs.filter(~held_out(key) & F.col(key).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0))
    rows = learns.select(F.col(lang).alias("label"), F.col(text).alias("text"), F.xxhash64(key, text, F.lit(7)).alias("mark"))
    last = lowest_marks(Scratch.of(docs.sparkSession).keep(rows.select("label", "mark"), "language-marks"), docs_per_label, ["label"])
    chosen = rows.join(last, "label").filter(F.col("mark") <= F.col("last_mark"))
    spare = F.greatest(F.length("text") - WINDOW // 2, F.lit(0)) + 1
    places = F.transform(F.sequence(F.lit(1), F.lit(windows_per_doc)), lambda i: F.pmod(F.xxhash64("mark", i), spare).cast("int") + 1)
    pieces = F.transform(F.array_distinct(places), lambda at: F.substring(F.col("text"), at, F.lit(WINDOW // 2)))
    picked = chosen.select("label", "mark", pieces.alias("pieces")).dropDuplicates(["label", "mark"])
    sample = picked.select("label", "mark", F.posexplode("pieces").alias("place", "piece")).orderBy("label", "mark", "place").collect()
    if not sample:
        return None
    labels = sorted({r["label"] for r in sample})
    texts = [np.frombuffer(r["piece"].encode(), np.uint8) for r in sample]
    ends = np.cumsum([len(x) for x in texts])
    symbols, of = windows(np.concatenate(texts), ends - [len(x) for x in texts], ends, WINDOW // 2)
    truth = np.array([labels.index(r["label"]) for r in sample])[of]
    network = Network(labels, hidden)
    network.fit(symbols, truth, steps)
    return network


def _predict(network: Network, names: list[str], batch_windows: int = 4096):
    def label(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Best label and its mean probability over the positions of each text."""
        texts = texts.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        total = np.zeros((len(texts), len(network.labels)))
        symbols, of = windows(data, offsets[:-1], offsets[1:], WINDOW)
        for at in range(0, len(of), batch_windows):
            part = symbols[:, at : at + batch_windows]
            found, _ = network.positions(part)
            found *= (part != PAD)[:, None, :]
            np.add.at(total, of[at : at + batch_windows], found.sum(axis=0).T)
        total /= np.maximum(offsets[1:] - offsets[:-1], 1)[:, None]
        return total.argmax(axis=1), total.max(axis=1)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                best, score = label(part.column("text"))
                letters = part.column("letters").to_numpy(zero_copy_only=False).astype(bool)
                named = [network.labels[b] if has else "und" for b, has in zip(best, letters)]
                kept = [part.column(n) for n in names]
                score = np.clip(np.where(letters, score, 0.0), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(named, pa.string()), pa.array(score)], [*names, "lang_pred", "score"]
                )

    return predict


def identify(docs: DataFrame, network: Network | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, lang_pred and score of every whole text, without any shuffle.

    Texts are cut into windows, every byte gets label probabilities from both directions of
    its window, and a document's are their mean. NULL texts and texts without a letter are
    ``und`` with score 0, as is everything without a network. Repeated rows get equal labels;
    names that clash with the results are not accepted in ``keep``.
    """
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if network is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(*keep, *([] if text in keep else [text]), letters.alias("letters"))
    rows = rows.withColumnRenamed(text, "text") if text not in keep and text != "text" else rows
    fields = [f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep]
    return rows.mapInArrow(_predict(network, keep), ", ".join([*fields, "lang_pred string", "score double"]))
