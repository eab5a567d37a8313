"""Encoding with the public tokenizer files, word by word with a memo.

Neither tokenizer lets a token reach over a space, so a text is cut before single spaces and
every distinct word is encoded once per task. The memo is emptied when it is full.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pannier.llm.arrays import text_bytes

MEMO_WORDS, MEMO_UNITS = 300_000, 600_000
# Kinds of ASCII bytes at which the split pattern always or never cuts; "|" and "<" are parts of special strings.
OTHER, BREAK, PRINTED, MARK, LETTER = range(5)
KINDS = np.full(256, OTHER, np.uint8)
KINDS[33:127] = PRINTED
KINDS[[*b".,;:!?"]] = MARK
KINDS[[*range(65, 91), *range(97, 123)]] = LETTER
KINDS[10] = BREAK
# The split pattern of the byte-level vocabulary.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A run of white space that holds a space may be one token; such texts are encoded whole.
_SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_RUN = f" {_SPACE}|{_SPACE} "
# Beyond these, two libraries may know different editions of Unicode.
_RARE = re.compile("[^\x00-ɏ‐-‧]")


def tokenizer(path: str):
    """The tokenizer of a ``.json`` file, single-threaded as Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _bytes_of_characters() -> dict[str, int]:
    """Byte-level vocabularies write a byte that is not printable as a later character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + at): b for at, b in enumerate(others)}


def _fast_encoder(path: str):
    """The same vocabulary as ranks, if ids ascend as merges do; else None."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in spec["model"]["merges"]]
    ids = [vocab["".join(pair)] for pair in pairs]
    pre = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or ids != sorted(ids):
        return None
    known = _bytes_of_characters()
    ranks = {bytes(known[c] for c in token): at for token, at in vocab.items() if token not in special}
    return tiktoken.Encoding("vocabulary", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens=special)


def batch_encoder(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function from texts to their ids in a row and where each text's begin, with the end of the last.

    The ids of a text equal ``encode(text, add_special_tokens=False)``. Texts are cut before
    every space and where else the split pattern surely cuts; the units of a batch are numbered by Arrow, only those not met before are
    encoded, and all ids are gathered at once.
    """
    slow, fast = tokenizer(path), _fast_encoder(path)
    known: dict[bytes, int] = {}  # a unit's place in the memo
    memo, starts, lengths = np.empty(1 << 16, "<u4"), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
    used = 0

    def encode(unit: bytes) -> list[int]:
        if fast is not None and (unit[1:] if unit[:1] == b" " else unit).isalpha():
            return fast._encode_single_piece(unit)  # ASCII letters are never cut
        text = unit.decode()
        if fast is None or _RARE.search(text):
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode(text, allowed_special="all")

    def places(units: list[bytes]) -> np.ndarray:
        nonlocal memo, starts, lengths, used
        if len(known) > MEMO_UNITS:
            known.clear()
            used = 0
        new = [unit for unit in units if unit not in known]
        if new:
            found = list(map(encode, new))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            first, end = len(known), used + int(sizes.sum())
            while end > len(memo):
                memo = np.concatenate([memo, np.empty_like(memo)])
            while first + len(new) > len(starts):
                starts, lengths = (np.concatenate([x, np.empty_like(x)]) for x in (starts, lengths))
            memo[used:end] = np.fromiter(chain.from_iterable(found), "<u4", end - used)
            starts[first : first + len(new)] = used + np.cumsum(sizes) - sizes
            lengths[first : first + len(new)] = sizes
            known.update(zip(new, range(first, first + len(new))))
            used = end
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))

    def ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(texts)
        whole = fast is None or pc.match_substring_regex(texts.cast(pa.large_string()).fill_null(""), _RUN).to_numpy(zero_copy_only=False)
        cut = np.zeros(len(data) + 1, bool)
        cut[:-1] = data == 32
        if fast is not None:  # also between a letter and a mark, and around a line break between printed characters
            kind = KINDS[data]
            cut[1:-1] |= (kind[:-1] == LETTER) & (kind[1:] == MARK)
            lone = (kind[1:-1] == BREAK) & (kind[:-2] >= PRINTED)
            cut[1:-2] |= lone
            cut[2:-1] |= lone & (kind[2:] >= PRINTED)
        for text in np.flatnonzero(np.broadcast_to(whole, len(texts))):
            cut[offsets[text] : offsets[text + 1]] = False
        cut[offsets] = True
        cut[-1] = True
        limits = np.flatnonzero(cut)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(limits) - 1, [None, pa.py_buffer(limits), pa.py_buffer(np.ascontiguousarray(data))])
        numbered = units.dictionary_encode()
        at = places(numbered.dictionary.to_pylist())[numbered.indices.to_numpy()]
        sizes = lengths[at]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        gathered = memo[np.repeat(starts[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        return gathered, ends[np.searchsorted(limits, offsets)]

    return ids


def id_encoder(path: str) -> Callable[[str], np.ndarray]:
    """``batch_encoder`` of one text at a time."""
    encode = batch_encoder(path)
    return lambda text: encode(pa.array([text]))[0]


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to token counts, for a tokenizer that drops white space.

    Its tokens cannot hold white space, so the count of a text is the sum over its words,
    special strings included, as these hold none either.
    """
    slow = tokenizer(path)
    memo: dict[str, int] = {"": 0}

    def counts(texts: list[str]) -> list[int]:
        if len(memo) >= MEMO_WORDS:
            memo.clear()
            memo[""] = 0
        words = [text.replace("\n", " ").split(" ") for text in texts]
        new = list({word for text in words for word in text if word not in memo})
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            encoded = slow.encode_batch_fast(part, add_special_tokens=False)
            memo.update(zip(part, map(len, encoded)))
        return [sum(map(memo.__getitem__, text)) for text in words]

    return counts
