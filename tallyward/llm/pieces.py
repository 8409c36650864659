"""Encoding and decoding with a SentencePiece model, by a Viterbi pass over batches of words.

Words of equal length advance together, one character at a time. Every substring that ends
there is hashed from prefix sums and probed among the sorted keys of the pieces; the best
piece that ends there is kept with a back pointer, and paths are read back for all words at
once.

The model at hand merges pairs (BPE), so the best piece is the one that the merges would
leave: of all pieces ending at a place exactly one is *stable* after the piece before it,
which means that no earlier merge would have joined their edges. Two pieces are tested by
undoing their merges from the last to the first; tested pairs are remembered. The result is
that of the model's own merges.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The mark that stands for a blank in pieces (fixed by the model format).
MARK = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Text handled at a time, units remembered by a task, slots for tested pairs, ids decoded at a time.
CHUNK, REMEMBERED, TESTED, DECODED = 1 << 21, 200_000, 1 << 20, 1 << 19


class Pieces:
    """The tables of a model: piece keys, ranks, the last merge of each, and their bytes."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        self.size = n
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int32)
        raw = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte_ids[int(name[1:-1], 16)] = i
                raw.append(bytes([int(name[1:-1], 16)]))
            else:
                raw.append(name.replace(MARK, " ").encode() if plain[i] else b"")
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array(list(map(len, raw)), np.int64)
        self.raw_start = np.concatenate(([0], np.cumsum(self.raw_size)))[:-1]
        own = [i for i in range(n) if plain[i]]
        if any(MARK in names[i].lstrip(MARK) for i in own):
            raise ValueError("pieces that run over a blank are not supported")
        self.alone = "".join(c for c in "\n" if not any(c in names[i] for i in own))
        self.longest = max(len(names[i]) for i in own)
        ids = {names[i]: i for i in own}
        # rank: the order of merges; single characters come first and are never merged
        order = sorted((i for i in own if len(names[i]) > 1), key=lambda i: -model.get_score(i))
        self.rank = np.zeros(n + 1, np.int64)
        self.rank[order] = np.arange(1, len(order) + 1)
        self.left, self.right = np.full(n + 1, -1, np.int32), np.full(n + 1, -1, np.int32)
        self.whole = np.zeros(n + 1, bool)
        self.whole[n] = True
        for i in own:
            parts = list(names[i])
            last = None
            while len(parts) > 1:
                ranked = [(self.rank[ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ids]
                if not ranked:
                    break
                k = min(ranked)[1]
                last = (parts[k], parts[k + 1])
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            self.whole[i] = len(parts) == 1
            if last and len(parts) == 1:
                self.left[i], self.right[i] = ids.get(last[0], n), ids.get(last[1], n)
        self.length = np.zeros(n + 1, np.int64)
        self.key = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(self.longest + 1, BASE))), dtype=np.uint64)
            for i in own:
                self.length[i] = len(names[i])
                codes = np.array(list(map(ord, names[i])), np.uint64) + np.uint64(1)
                self.key[i] = (codes * self.power[: len(codes)][::-1]).sum(dtype=np.uint64)
        at = np.argsort(self.key[own])
        self.keys, self.ids = self.key[own][at], np.array(own, np.int32)[at]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 for none."""
        out = np.full(len(keys), -1, np.int32)
        some = np.flatnonzero(self.maybe[(keys >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, keys[some]), len(self.keys) - 1)
        hit = self.keys[at] == keys[some]
        out[some[hit]] = self.ids[at[hit]]
        return out

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that two pieces make, or one above all ranks."""
        fits = (self.length[a] + self.length[b] <= self.longest) & (a < self.size) & (b < self.size)
        out = np.full(len(a), self.size + 1, np.int64)
        i = np.flatnonzero(fits)
        piece = self.find(self.key[a[i]] * self.power[self.length[b[i]]] + self.key[b[i]])
        out[i[piece >= 0]] = self.rank[piece[piece >= 0]]
        return out

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge joins piece a with piece b after it."""
        ok = self.whole[a] & self.whole[b]
        live = np.flatnonzero(ok)
        x, y = a[live].copy(), b[live].copy()
        limit = np.full(len(live), self.size + 1, np.int64)
        while len(live):
            bad = self.joined(x, y) < limit
            ok[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            undo_x = rx > ry
            over = (~undo_x) & (ry == 0)  # both are single characters
            stay = ~(bad | over)
            live, x, y, undo_x, rx, ry = live[stay], x[stay], y[stay], undo_x[stay], rx[stay], ry[stay]
            limit = np.where(undo_x, rx, ry + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return ok


class Encoder:
    """Encodes units (a run of marks and what follows up to the next), each distinct one once."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.units = re.compile(f"{MARK}+[^{MARK}{pieces.alone}]*|[^{MARK}{pieces.alone}]+" + (f"|[{pieces.alone}]" if pieces.alone else ""))
        self.tested = np.full(TESTED, -1, np.int64)
        self.tested_ok = np.zeros(TESTED, bool)
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) * (self.p.size + 1) + b
        slot = (keys * 2654435761) & (TESTED - 1)
        new = np.flatnonzero(self.tested[slot] != keys)
        out = self.tested_ok[slot]
        if len(new):
            fresh, back = np.unique(keys[new], return_inverse=True)
            ok = self.p.stable((fresh // (self.p.size + 1)).astype(np.int32), (fresh % (self.p.size + 1)).astype(np.int32))
            out[new] = ok[back]
            at = (fresh * 2654435761) & (TESTED - 1)
            self.tested[at], self.tested_ok[at] = -1, False
            at, one = np.unique(at, return_index=True)
            self.tested[at], self.tested_ok[at] = fresh[one], ok[one]
        return out

    def same_length(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of words of one length, one word after the other, and each one's count."""
        p, m, n = self.p, len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(m, n).astype(np.uint64) + np.uint64(1)
        sums = np.zeros((n + 1, m), np.uint64)
        for i in range(n):
            sums[i + 1] = sums[i] * BASE + codes[:, i]
        last = np.full((n + 1, m), p.size, np.int32)
        step = np.zeros((n + 1, m), np.int16)
        for i in range(1, n + 1):
            for size in range(1, min(i, p.longest) + 1):
                piece = p.find(sums[i] - sums[i - size] * p.power[size])
                if size == 1:  # a character without a piece stands for its bytes
                    piece[piece < 0] = p.size
                rows = np.flatnonzero(piece >= 0)
                piece = piece[rows]
                ok = p.whole[piece] if i == size else self.follows(last[i - size, rows], piece)
                # one candidate is stable; the maximum over sizes is its back pointer
                rows = rows[ok]
                step[i, rows], last[i, rows] = size, piece[ok]
        if (step[1:] == 0).any():
            raise ValueError("no stable piece")
        at, column, ends, places = np.full(m, n), np.arange(m), [], []
        while (at > 0).any():
            ends.append(np.where(at > 0, last[at, column], -1))
            places.append(at)
            at = np.where(at > 0, at - step[at, column], at)
        path, place = np.stack(ends[::-1]).T, np.stack(places[::-1]).T
        kept = path >= 0
        flat, counts = path[kept], kept.sum(axis=1)
        if (unknown := flat == p.size).any():
            chars = [words[k][i - 1].encode() for k, i in zip(np.repeat(column, counts)[unknown].tolist(), place[kept][unknown].tolist())]
            sizes = np.ones(len(flat), np.int64)
            sizes[unknown] = list(map(len, chars))
            counts = np.bincount(np.repeat(column, counts), weights=sizes, minlength=m).astype(np.int64)
            fills = np.repeat(unknown, sizes)
            flat = np.repeat(flat, sizes)
            flat[fills] = p.byte_ids[np.frombuffer(b"".join(chars), np.uint8)]
        return flat.astype(np.int32), counts

    def learn(self, new: list[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for w in new:
            by_length.setdefault(len(w), []).append(w)
        flats, counts = [self.flat], [self.count]
        for n, words in sorted(by_length.items()):
            wide = max(1, 400_000 // n)
            for i in range(0, len(words), wide):
                flat, count = self.same_length(words[i : i + wide])
                flats.append(flat)
                counts.append(count)
                self.known |= zip(words[i : i + wide], range(len(self.known), len(self.known) + len(count)))
        self.flat, self.count = np.concatenate(flats), np.concatenate(counts)
        self.start = np.cumsum(self.count) - self.count

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and each one's count."""
        own: defaultdict[str, int] = defaultdict()  # each distinct unit is held once
        own.default_factory = own.__len__
        units = [np.fromiter(map(own.__getitem__, us), np.int32, len(us)) for us in map(self.units.findall, texts)]
        own.default_factory = None  # else it holds itself
        if len(self.known) > REMEMBERED:
            self.reset()
        new = [u for u in own if u not in self.known]
        if new:
            self.learn(new)
        places = np.fromiter(map(self.known.__getitem__, own), np.int64, len(own))
        at = places[np.concatenate(units)] if units else places
        counts = self.count[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.start[at] - (ends - counts), counts) + np.arange(total)]
        cuts = np.cumsum([0, *map(len, units)])
        return flat, np.diff(np.concatenate(([0], ends))[cuts])


def cuts(text: str) -> Iterator[str]:
    """A marked text in parts of about a chunk, cut before a mark that follows something else."""
    low = 0
    while len(text) - low > CHUNK:
        at = re.compile(f"(?<=[^{MARK}]){MARK}").search(text, low + CHUNK)
        if not at:
            break
        yield text[low : at.start()]
        low = at.start()
    yield text[low:]


def grouped(texts: list[str | None]) -> Iterator[list[int]]:
    """Neighbouring texts that together are about a chunk."""
    group, held = [], 0
    for i, t in enumerate(texts):
        group.append(i)
        held += len(t or "")
        if held >= CHUNK:
            yield group
            group, held = [], 0
    if group:
        yield group


def chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of neighbouring texts that together are about a chunk."""
    low, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), 1):
        held += n
        if held >= CHUNK:
            yield texts.slice(low, i - low)
            low, held = i, 0
    if low < len(texts):
        yield texts.slice(low)


def restored(kind: type, tables: dict):
    """An object of ``kind`` made of tables that were broadcast."""
    made = object.__new__(kind)
    made.__dict__.update(tables)
    return made


def load_pieces(model_file: str) -> Pieces:
    """The tables of a model file; ValueError if it is of another kind than is built here.

    Some texts are encoded in both ways: a model that does not merge pairs, or that
    normalises text or blanks, gives other ids than these tables do.
    """
    import sentencepiece

    pieces = Pieces(model_file)
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    names = [model.id_to_piece(i).replace(MARK, " ") for i in range(0, pieces.size, max(1, pieces.size // 2000)) if not model.is_byte(i)]
    texts = [" two  blanks ", "Ａ ﬁ ① é é", "tab\tand\nline", "🙂 日本語", "A" * 50, "".join(names), " ".join(names), *names[-200:]]
    flat, counts = Encoder(pieces).ids([MARK + t.replace(" ", MARK) for t in texts])
    own = np.split(flat, np.cumsum(counts)[:-1])
    for text, ids in zip(texts, own):
        if ids.tolist() != model.encode(text):
            raise ValueError(f"the model encodes {text[:40]!r} in another way: not a pair-merging model without normalisation")
    return pieces


def encoded(pieces: Pieces, df: DataFrame, text: Column) -> Column:
    """``array<int>``: the ids of a text; null for null, none for the empty text.

    Blanks count one by one and one is put before the text, as the model does. Characters
    without a piece become the pieces of their bytes. Texts of any length are read whole,
    in parts cut at blanks.
    """
    shared = df.sparkSession.sparkContext.broadcast(vars(pieces))

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(restored(Pieces, shared.value))
        for texts in chain.from_iterable(map(chunks, batches)):  # told chunk by chunk: no batch is held whole
            rows = texts.to_pylist()
            parts, of = [], []
            for i, row in enumerate(rows):
                if row:
                    new = list(cuts(MARK + row.replace(" ", MARK)))
                    parts += new
                    of += [i] * len(new)
            if len(parts) > len(rows):  # very long ones: part by part
                both = [encoder.ids([x]) for x in parts]
                flat, count = np.concatenate([x for x, _ in both]), np.concatenate([x for _, x in both])
            else:
                flat, count = encoder.ids(parts)
            sizes = np.bincount(np.array(of, np.int64), weights=count, minlength=len(rows)).astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int32()), mask=texts.is_null())

    return F.arrow_udf(encode, "array<int>")(text)


def _texts(p: Pieces, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The texts of rows of ids: all bytes gathered at once, then cut by row."""
    known = (ids >= 0) & (ids < p.size)
    row, ids = np.repeat(np.arange(len(sizes)), sizes)[known], ids[known]
    n = p.raw_size[ids]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    raw = p.raw[np.repeat(p.raw_start[ids] - (ends - n), n) + np.arange(total)]
    length = np.bincount(row, weights=n, minlength=len(sizes)).astype(np.int64)
    first = (np.cumsum(length) - length)[length > 0]
    blank = first[raw[first] == 0x20]  # the one put before a text
    length[np.searchsorted(np.cumsum(length), blank, "right")] -= 1
    raw = np.delete(raw, blank)
    offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int64)
    cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])
    try:
        return cut.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace") for b in cut.to_pylist()], pa.string())


def decoded(pieces: Pieces, df: DataFrame, ids: Column) -> Column:
    """The text of ``array<int>`` ids; null for null, unknown or null ids give nothing.

    Bytes that are not UTF-8 become U+FFFD. Blanks and marks of a text come back as blanks.
    """
    shared = df.sparkSession.sparkContext.broadcast(vars(pieces))

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        p = restored(Pieces, shared.value)
        for lists in batches:
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            ends, low = np.cumsum(sizes), 0
            while low < len(sizes):  # neighbouring rows that together are about a chunk
                before = int(ends[low - 1]) if low else 0
                high = max(low + 1, int(np.searchsorted(ends, before + DECODED, "right")))
                texts = _texts(p, values[before : int(ends[high - 1])], sizes[low:high])
                yield pc.if_else(lists.slice(low, high - low).is_valid(), texts, pa.scalar(None, pa.string()))
                low = high

    return F.arrow_udf(decode, "string")(ids)
