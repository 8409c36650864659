"""Helpers shared by the operators: durable tables, components, fast word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.sources.staging import shared_folder


#: Whether the shuffle files of a write go as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: cut lineage, any executor may be lost.

    What was shuffled for it is deleted at once, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def freed(*tables: DataFrame) -> None:
    """Deletes tables that ``saved`` gave, which nothing reads from then on."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            if path.getName().startswith("table-"):
                path.getFileSystem(conf).delete(path, True)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long); component is the least node.

    Alternating large and small stars, each two joins and counts on edges; the number of
    rounds grows with the logarithm of the longest path. Nulls, loops and repeated edges
    add nothing. Hot nodes are combined in map tasks before each shuffle.
    """
    edges = saved(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )

    def state(e: DataFrame):
        row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    before = state(edges)
    for _ in range(rounds if before[0] else 0):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = saved(
            small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a != b")
            .distinct()
        )
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components not settled after {rounds} rounds")
    heads = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads)


# --- words of UTF-8 texts as 64-bit hashes, whole batches at a time -----------------

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
WINDOW = 1 << 20
#: Bytes of text that a task works on together.
SLICE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse; the usual length is kept."""
    if n in POWERS:
        return POWERS[n]
    up, down = np.full(n, BASE), np.full(n, INVERSE)
    up[0] = down[0] = 1
    made = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    if n <= WINDOW:
        POWERS[n] = made
    return made


def bytes_and_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and each text's offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``SLICE`` bytes in the column at ``text``."""
    sizes = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, and each text's offsets in them.

    Works through windows of about a megabyte, so memory beyond the texts is eight bytes a word.
    """
    data, offsets = bytes_and_offsets(texts)
    found, places, low, n = [], [], 0, len(data)
    while low < n:
        high = min(low + WINDOW, n)
        if high < n:  # back to the last blank, or on to the next one where there is none
            blank = np.flatnonzero(SPACE[data[low:high]])
            while not len(blank) and high < n:
                start, high = high, min(high + WINDOW, n)
                blank = np.flatnonzero(SPACE[data[start:high]]) + (start - low)
            high = low + int(blank[-1]) + 1 if len(blank) and high < n else high
        part = LOWER[data[low:high]]
        word = ~SPACE[part]
        first = np.zeros(len(part) + 1, bool)
        cuts = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high)] - low
        first[cuts] = True
        starts = np.flatnonzero(word & (first[:-1] | np.concatenate(([True], ~word[:-1]))))
        ends = np.flatnonzero(word & (first[1:] | np.concatenate((~word[1:], [True])))) + 1
        up, down = powers(WINDOW if len(part) <= WINDOW else len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(LETTER[part] * up[: len(part)], out=sums[1:])
        found.append(mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        places.append(starts + low)
        low = high
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    places = np.concatenate(places) if places else np.zeros(0, np.int64)
    return hashes, np.searchsorted(places, offsets)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``size`` words.

    A text with fewer words has its whole sequence as its one shingle, one without words none.
    """
    words, at = word_hashes(texts)
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        rolled = rolled * BASE + words[i : i + len(rolled)]
    rolled = mixed(rolled)
    out = []
    for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
        if high - low >= size:
            out.append(np.unique(rolled[low : high - size + 1]))
        elif high > low:
            one = np.uint64(high - low)
            with np.errstate(over="ignore"):
                for w in words[low:high]:
                    one = one * BASE + w
            out.append(mixed(np.array([one ^ np.uint64(0x5851F42D4C957F2D)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
