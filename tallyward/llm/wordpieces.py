"""Token counts of greedy longest-match word pieces, by an automaton that is linear in the text.

The pieces form a trie over bytes. Where the trie has no arc, a node's failure link leads to
the node of what is left after the pieces that greedy matching would have taken there, and a
count says how many those were. So a word is read once, left to right, and its number of
pieces is the sum of the counts on the way; no piece is ever built.

Links and counts are made complete: a table gives each node's next node and count for every
byte. Distinct words advance through it together, byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.pieces import CHUNK, Pieces, grouped, restored

#: Distinct words remembered by a task, and words that advance together.
REMEMBERED, TOGETHER = 400_000, 20_000


class Automaton:
    """Trie of ``pieces`` (non-empty bytes) with every single byte as a piece of last resort."""

    def __init__(self, pieces: list[bytes]):
        arcs: list[dict[int, int]] = [{}]
        final = [False]
        parent = [(0, 0)]
        for piece in [*pieces, *(bytes([b]) for b in range(256))]:
            at = 0
            for byte in piece:
                if byte not in arcs[at]:
                    arcs[at][byte] = len(arcs)
                    arcs.append({})
                    final.append(False)
                    parent.append((at, byte))
                at = arcs[at][byte]
            if piece:
                final[at] = True
        n = len(arcs)
        # breadth first: a node's link needs those of shorter nodes only
        order, depth = [0], [0] * n
        for node in order:
            for child in arcs[node].values():
                depth[child] = depth[node] + 1
                order.append(child)
        link, popped = [0] * n, [0] * n
        for node in order[1:]:
            if final[node]:
                link[node], popped[node] = 0, 1
                continue
            up, byte = parent[node]
            at, count = link[up], popped[up]
            while byte not in arcs[at]:  # ends at the root, which has every byte
                count += popped[at]
                at = link[at]
            link[node], popped[node] = arcs[at][byte], count
        self.link, self.popped = np.array(link, np.int32), np.array(popped, np.int32)
        keys = sorted((a * 256 + b, c) for a in range(n) for b, c in arcs[a].items())
        self.arcs = np.array([k for k, _ in keys], np.int64)
        self.to = np.array([c for _, c in keys], np.int32)
        self.first = np.array([arcs[0][b] for b in range(256)], np.int32)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of pieces of each word; 0 for the empty one."""
        sizes = np.array(list(map(len, words)), np.int64)
        order = np.argsort(-sizes, kind="stable")
        ordered = sizes[order]
        data = np.frombuffer(b"".join([words[i] for i in order]), np.uint8)
        start = np.cumsum(ordered) - ordered
        at, total = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
        for i in range(int(ordered[0]) if len(ordered) else 0):
            live = int(np.searchsorted(-ordered, -i, side="left"))  # words longer than i
            todo, byte = np.arange(live), data[start[:live] + i]
            while len(todo):
                node = at[todo]
                key = node.astype(np.int64) * 256 + byte
                place = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
                found = self.arcs[place] == key
                at[todo[found]] = self.to[place[found]]
                todo, byte, node = todo[~found], byte[~found], node[~found]
                total[todo] += self.popped[node]
                at[todo] = self.link[node]
        while (more := np.flatnonzero(at)).size:  # the end: pop what is left
            total[more] += self.popped[at[more]]
            at[more] = self.link[at[more]]
        out = np.empty(len(words), np.int64)
        out[order] = total
        return out


def greedy_pieces(pieces: Pieces) -> Automaton:
    """The automaton of a model's pieces; a blank before a word is part of its first piece."""
    raw = pieces.raw.tobytes()
    return Automaton([raw[s : s + n] for s, n in zip(pieces.raw_start.tolist(), pieces.raw_size.tolist()) if n])


def token_counts(automaton: Automaton, df: DataFrame, text: Column) -> Column:
    """``struct<n_words: long, n_tokens: long>`` of a text.

    Words are ``[^\\x20\\x09-\\x0D]+``; each is matched greedily from a blank put before it,
    longest piece first; bytes that start no piece count one each. Null, empty and blank
    texts have 0 words. Texts of any length are read whole, in parts.
    """
    shared = df.sparkSession.sparkContext.broadcast(vars(automaton))

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, known = restored(Automaton, shared.value), {}
        for texts in batches:
            raw = texts.cast(pa.binary()).to_pylist()
            n_words, n_tokens = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
            for group in grouped(raw):
                parts = [(i, part) for i in group for part in _parts(raw[i] or b"")]
                for low in range(0, len(parts), len(group)):  # a very long text: some parts at a time
                    words = [(i, part.split()) for i, part in parts[low : low + len(group)]]
                    if len(known) > REMEMBERED:
                        known = {}
                    new = list(set().union(*(w for _, w in words)) - known.keys())
                    for at in range(0, len(new), TOGETHER):
                        some = new[at : at + TOGETHER]
                        known |= zip(some, table.counts([b" " + w for w in some]).tolist())
                    for i, w in words:
                        n_words[i] += len(w)
                        n_tokens[i] += sum(map(known.__getitem__, w))
            yield pa.StructArray.from_arrays([pa.array(n_words), pa.array(n_tokens)], ["n_words", "n_tokens"])

    return F.arrow_udf(count, "struct<n_words:long,n_tokens:long>")(text.cast("string"))


def _parts(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of about a chunk, cut at a blank."""
    low = 0
    while len(data) - low > CHUNK:
        at = min((k for k in (data.find(b, low + CHUNK) for b in (b" ", b"\n", b"\t")) if k >= 0), default=-1)
        if at < 0:
            break
        yield data[low:at]
        low = at
    yield data[low:]
