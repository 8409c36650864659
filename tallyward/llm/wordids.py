"""Ids of a public word tokenizer for whole batches of texts.

The tokenizer cuts a text into letter runs, single digits and runs of other signs, and merges
the bytes of each in order of rank. Distinct pieces of a batch are merged together: a round
takes, in every piece at once, the pair of least rank. Words with signs whose cutting or
case needs the whole library (most of Unicode, apostrophes, names of special tokens) are
handed to it, each distinct one once.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyward.llm.common import LOWER, SPACE, bytes_and_offsets

#: Bytes of text that are encoded at once.
CHUNK = 1 << 21
#: Bytes from which a word goes to the library, which merges it in one pass.
LONG = 4096
NO_RANK = np.int32(1 << 30)

LETTER, DIGIT, SIGN, LIBRARY = 1, 2, 3, 4
#: Kinds of bytes: ASCII only; controls, the apostrophe and < need the library.
KIND = np.full(256, LIBRARY, np.uint8)
KIND[0x21:0x7F] = SIGN
KIND[0x41:0x5B] = KIND[0x61:0x7B] = LETTER
KIND[0x30:0x3A] = DIGIT
KIND[[0x27, 0x3C]] = LIBRARY
KIND[SPACE] = 0
#: Second bytes, after 0xC3, of the letters from U+00C0 to U+00FF, and those of capitals.
SECOND = np.zeros(256, bool)
SECOND[0x80:0xC0] = True
SECOND[[0x97, 0xB7]] = False
CAPITAL = np.zeros(256, bool)
CAPITAL[0x80:0x9F] = True
CAPITAL[0x97] = False


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary: itself if it can be seen."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def model_tables(text: str) -> dict[str, object]:
    """What a task needs of a tokenizer file; ValueError if it works in another way."""
    spec = json.loads(text)
    model = spec["model"]
    steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = [s.get("type") for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    if model.get("type", "BPE") != "BPE" or not model.get("end_of_word_suffix") or steps != ["NFC", "Replace", "Lowercase"] or cuts != ["Split", "ByteLevel"]:
        raise ValueError("not a byte-level merge tokenizer of lower-case words with word ends")
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int64)
    names = byte_characters()
    inside, last = (np.array([vocab[names[b] + tail] for b in range(256)], np.int32) for tail in ("", end))
    # an open hash table of pairs
    size = 1 << 18
    keys, rank = np.full(size, -1, np.int64), np.full(size, NO_RANK, np.int32)
    for r, key in enumerate((ids[:, 0] << 20 | ids[:, 1]).tolist()):
        slot = _slots(np.array([key]))[0]
        while keys[slot] >= 0:
            slot = (slot + 1) % size
        keys[slot], rank[slot] = key, r
    return {"text": text, "keys": keys, "rank": rank, "made": ids[:, 2].astype(np.int32), "inside": inside, "last": last}


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64)


class WordIds:
    """Encodes texts by the tables of a tokenizer file."""

    def __init__(self, tables: dict[str, object]):
        self.__dict__.update(tables)
        self.library = None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NO_RANK for those that do not merge."""
        key = left.astype(np.int64) << 20 | right
        slot = _slots(key)
        found = self.keys[slot]
        out = np.where(found == key, self.rank[slot], NO_RANK)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % len(self.keys)
            found = self.keys[slot[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.rank[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def merged(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and their number for each piece."""
        data, at = bytes_and_offsets(pieces)
        symbol = self.inside[data]
        symbol[at[1:] - 1] = self.last[data[at[1:] - 1]]
        piece = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
        rank = np.full(len(symbol), NO_RANK, np.int32)  # of a symbol with the next one
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
        done = []
        while len(symbol):
            first = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
            sizes = np.diff(np.append(first, len(piece)))
            least = np.repeat(np.minimum.reduceat(rank, first), sizes)
            settled = least == NO_RANK
            if settled.any():
                done.append((piece[settled], symbol[settled]))
                symbol, piece, rank, least = (x[~settled] for x in (symbol, piece, rank, least))
                if not len(symbol):
                    break
            take = rank == least
            both = np.flatnonzero(take[1:] & take[:-1]) + 1
            for i in both.tolist():  # one symbol three times or more: pairs from the left
                take[i] = not take[i - 1]
            at = np.flatnonzero(take)
            symbol[at] = self.made[rank[at]]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            rank[at] = rank[at + 1]  # whether a next symbol is there is told by the piece
            place = np.cumsum(stay) - 1
            at = place[at]
            symbol, piece, rank = symbol[stay], piece[stay], rank[stay]
            for left in (at, at[at > 0] - 1):
                has = left + 1 < len(piece)
                has[has] = piece[left[has]] == piece[left[has] + 1]
                rank[left[~has]] = NO_RANK
                left = left[has]
                rank[left] = self.ranks(symbol[left], symbol[left + 1])
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(at) - 1 if len(pieces) else 0, np.int64)
        piece, symbol = (np.concatenate([d[k] for d in done]) for k in range(2))
        order = np.argsort(piece, kind="stable")
        return symbol[order], np.bincount(piece, minlength=len(pieces))

    def by_library(self, words: list[str]) -> list[list[int]]:
        if self.library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.text)
        return [e.ids for e in self.library.encode_batch(words, add_special_tokens=False)]

    def __call__(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with ``end`` after each text, and where each text's ids begin."""
        data, offsets = bytes_and_offsets(texts)
        kind = KIND[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        lead = lead[SECOND[data[lead + 1]]]
        kind[lead] = kind[lead + 1] = LETTER
        cut = np.ones(len(data) + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        cut[offsets] = True
        # whole words for the library: no cut inside, bytes as they are
        space = kind == 0
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = space[1:] != space[:-1]
        edge[offsets] = True
        starts = np.flatnonzero(edge[:-1]) if len(data) else np.zeros(0, np.int64)
        own = np.zeros(len(data), bool)
        if len(starts):
            sizes = np.diff(np.append(starts, len(data)))
            odd = (np.maximum.reduceat(kind, starts) == LIBRARY) | ((sizes > LONG) & ~space[starts])
            own = np.repeat(odd, sizes)
            cut[:-1][own] = edge[:-1][own]
        low = LOWER[data]
        capital = lead[CAPITAL[data[lead + 1]]] + 1
        low[capital] += 0x20
        low[own] = data[own]

        begins = np.flatnonzero(cut[:-1] & ~space) if len(data) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(np.flatnonzero(cut[:-1]), len(data)))[~space[np.flatnonzero(cut[:-1])]] if len(data) else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        raw = pa.py_buffer(low[~space])
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), raw])
        flat, counts, index = self._of_pieces(pieces, own[begins] if len(begins) else np.zeros(0, bool))

        # gather: the ids of each piece, and the end after the last one of each text
        counts = np.append(counts, 1)
        flat = np.append(flat, np.int32(end))
        first = np.cumsum(counts) - counts
        bounds = np.searchsorted(begins, offsets)
        index = np.insert(index, bounds[1:], len(counts) - 1)
        size = counts[index]
        stops = np.cumsum(size)
        total = int(stops[-1]) if len(stops) else 0
        ids = flat[np.repeat(first[index] - (stops - size), size) + np.arange(total)]
        return ids, np.concatenate(([0], stops))[bounds + np.arange(len(bounds))]

    def _of_pieces(self, pieces: pa.LargeBinaryArray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and counts of the distinct pieces, and which of them each piece is."""
        plain = pieces.filter(pa.array(~own)).dictionary_encode()
        flat, counts = self.merged(plain.dictionary)
        index = np.zeros(len(pieces), np.int64)
        index[~own] = plain.indices.to_numpy()
        if own.any():
            words = pieces.filter(pa.array(own)).dictionary_encode()
            found = self.by_library(words.dictionary.cast(pa.large_string()).to_pylist())
            index[own] = words.indices.to_numpy().astype(np.int64) + len(counts)
            flat = np.concatenate([flat, *(np.array(x, np.int32) for x in found)])
            counts = np.concatenate([counts, [len(x) for x in found]])
        return flat, counts.astype(np.int64), index


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts of about a chunk."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts.cast(pa.large_string())), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(texts):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
        yield texts.slice(low, high - low)
        low = high
