"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as many of the
longest as fit, then one per bit of the rest. Each piece is a sequence of its own, so none
crosses documents and none is padded; sequences of one length form a bucket, from which
batches of equal shape are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import saved
from tallyward.llm.wordids import WordIds, model_tables, slices

#: Parts of a bucket that are numbered on their own.
CELLS = 1024

PIECES = "array<struct<start:long,length:long,ids:binary,doc_tokens:long>>"


def binary_pieces(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens, the longest first; ``longest`` is a power of two."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def cut_documents(docs: DataFrame, tokenizer_file: str, text_col: str = "text", longest: int = 2048, end: int = 1) -> DataFrame:
    """A row per piece: the columns of ``docs``, then ``start``, ``length``, ``ids`` and ``doc_tokens``.

    A document's tokens are those of the public tokenizer in ``tokenizer_file``, then
    ``end``; each lies in exactly one piece. ``ids`` are little-endian unsigned 32-bit
    numbers, as training files hold them. ``start`` counts the document's tokens before the
    piece, ``doc_tokens`` all of them. A null text counts as empty, an empty one has the one
    piece of its end. Repeated rows are each cut.
    Very long texts are read whole. Columns of these names are replaced, all others stay.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    with open(tokenizer_file, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(model_tables(file.read()))

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = WordIds(model.value)
        for batch in batches:
            for texts in slices(batch):
                flat, bounds = encode(texts, end)
                lengths = [binary_pieces(n, longest) for n in np.diff(bounds).tolist()]
                counts = np.array([len(x) for x in lengths], np.int64)
                size = np.array([n for x in lengths for n in x], np.int64)
                ends = np.cumsum(size)
                starts = ends - size - np.repeat(bounds[:-1], counts)
                offsets = (np.concatenate(([0], ends)) * 4).astype(np.int32)
                ids = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(flat.astype("<u4"))])
                whole = pa.array(np.repeat(np.diff(bounds), counts))
                pieces = pa.StructArray.from_arrays([pa.array(starts), pa.array(size), ids, whole], ["start", "length", "ids", "doc_tokens"])
                yield pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), pieces)

    kept = [c for c in docs.columns if c not in ("start", "length", "ids", "doc_tokens")]
    pieces = F.arrow_udf(cut, PIECES)(F.col(text_col).cast("string"))
    return docs.select(*kept, F.explode(pieces).alias("__piece")).select(*kept, "__piece.*")


def bucketed(pieces: DataFrame, seed: int = 0) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: each piece is one sequence, filled from 0.

    Sequences are numbered from 0 without gaps, the shortest bucket first and within one in
    an order given by a seeded hash of the row's place in the written table, so neighbours
    in a bucket come from anywhere in the corpus and equal rows do not meet in one task. A
    bucket is numbered in ``CELLS`` parts; only the counts of the parts are summed up in one
    place, at most ``CELLS`` per length. The same files read in the same order give the same
    numbers. ``length`` must not be null; columns of these names are replaced.
    """
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.select(*own, F.monotonically_increasing_id().alias("__place"))
    mark = F.xxhash64(F.lit(seed), "__place")
    rows = saved(rows.withColumns({"__mark": mark, "__cell": F.pmod(mark, F.lit(CELLS)).cast("int")}))
    counts = rows.groupBy("length", "__cell").agg(F.count(F.lit(1)).alias("n"))
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n"))
    so_far = lambda w: F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1))
    lengths = lengths.select("length", F.coalesce(so_far(Window.orderBy("length")), F.lit(0)).alias("bucket"))
    cells = Window.partitionBy("length").orderBy("__cell")
    counts = counts.select("length", "__cell", F.coalesce(so_far(cells), F.lit(0)).alias("before"))
    first = counts.join(lengths, "length").select("length", "__cell", (F.col("bucket") + F.col("before")).alias("__first"))
    order = Window.partitionBy("length", "__cell").orderBy("__mark")
    out = rows.withColumn("__at", F.row_number().over(order) - 1).join(first, ["length", "__cell"])
    return out.select(*own, (F.col("__first") + F.col("__at")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def with_batches(sequences: DataFrame, tokens: int) -> DataFrame:
    """``sequences`` with ``batch``, the number within their length of the batch they are in.

    A batch holds ``tokens`` tokens of sequences of one length (at least one sequence); the
    last one of a length may hold fewer. A length begins where its least number is.
    """
    first = sequences.groupBy("length").agg(F.min("sequence_id").alias("__least"))
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(tokens) / F.col("length")))
    batch = F.floor((F.col("sequence_id") - F.col("__least")) / per_batch).cast("long")
    return sequences.drop("batch").join(first, "length").withColumn("batch", batch).drop("__least")
