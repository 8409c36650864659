"""Spelling variants by partition-and-enumerate signatures of letter multisets.

A word's letters, each numbered by its occurrence (the second l is a letter of its own), are
a binary vector. One replaced letter changes two of its places, one letter more changes one.
The places are dealt to parts by a fixed hash; words at a distance of k agree in all parts
but k, so each choice of the other parts is an exact signature: two words within k share at
least one. Words of one length are joined for k = 2, words whose lengths differ by one for
k = 1. What meets is verified letter by letter.

A signature alone is shared by ever more words as a vocabulary grows. An edit lies in the
first or in the second half of a word, so each signature is joined with the half that must
then be equal; a bucket stays as small as the words are unlike, and no pair is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import mixed, saved

#: Parts of the places for words of one length (k = 2) and of neighbouring lengths (k = 1).
SAME, NEXT = 4, 2


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words, one after the other, and where each word's begin."""
    texts = words.to_pylist()
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return flat, np.cumsum([0, *map(len, texts)])


def place_hashes(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word and the hash of each place that is set: letter and number of its occurrence."""
    word = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((points, word))
    word, points = word[order], points[order]
    first = np.ones(len(word), bool)
    first[1:] = (word[1:] != word[:-1]) | (points[1:] != points[:-1])
    runs = np.flatnonzero(first)
    number = np.arange(len(word)) - np.repeat(runs, np.diff(np.append(runs, len(word))))
    return word, mixed(points * np.uint64(0x9E3779B97F4A7C15) + mixed(number.astype(np.uint64) + np.uint64(1)))


def signatures(words: int, word: np.ndarray, place: np.ndarray, parts: int, apart: int) -> np.ndarray:
    """(word, choice): hashes of the places outside of each choice of ``apart`` parts."""
    part = (place >> np.uint64(40)) % np.uint64(parts)
    sums = np.zeros((words, parts), np.uint64)
    np.add.at(sums, (word, part.astype(np.int64)), mixed(place))
    choices = list(itertools.combinations(range(parts), parts - apart))
    out = np.zeros((words, len(choices)), np.uint64)
    for c, chosen in enumerate(choices):
        out[:, c] = mixed(sums[:, chosen].sum(axis=1, dtype=np.uint64) + np.uint64(c + 1 + 1000 * parts))
    return out


def half_hashes(points: np.ndarray, at: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """(word, side): hashes of the first half, and of the rest from the end, for a given length."""
    size = np.diff(at)
    up = np.cumprod(np.full(max(1, int(size.max(initial=0)) + 1), 0x9E3779B97F4A7C15, np.uint64))
    position = np.arange(len(points)) - np.repeat(at[:-1], size)
    fore = np.concatenate(([np.uint64(0)], np.cumsum(mixed(points) * up[position], dtype=np.uint64)))
    back = np.concatenate(([np.uint64(0)], np.cumsum(mixed(points) * up[np.repeat(size, size) - 1 - position], dtype=np.uint64)))
    left = shorter // 2
    cut = at[1:] - (shorter - left)
    return np.stack([fore[at[:-1] + left] - fore[at[:-1]], back[at[1:]] - back[cut]], axis=1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, side, word, n): side 0 meets its own kind, side 1 (shorter) meets 2 (longer)."""
    for batch in batches:
        words = batch.column(0)
        points, at = code_points(words)
        size, n = np.diff(at), len(words)
        word, place = place_hashes(points, at)
        same, near = signatures(n, word, place, SAME, 2), signatures(n, word, place, NEXT, 1)
        for side, sign, shorter in ((0, same, size), (1, near, size), (2, near, size - 1)):
            halves = half_hashes(points, at, shorter)
            length = mixed(shorter.astype(np.uint64) * np.uint64(2) + np.uint64(side > 0))
            key = mixed(sign[:, :, None] + mixed(halves + np.array([11, 13], np.uint64))[:, None, :] + length[:, None, None]).reshape(n, -1)
            each = key.shape[1]
            of = pa.array(np.repeat(np.arange(n), each))
            yield pa.record_batch(
                [pa.array(key.ravel().view(np.int64)), pa.array(np.full(n * each, side, np.int8)), words.take(of), batch.column(1).take(of)],
                ["key", "side", "word", "n"],
            )


def near_words(words: DataFrame) -> DataFrame:
    """(a, b, a_n, b_n), once each, a before b: words of ``words`` (word, n) one edit apart."""
    keys = saved(words.mapInArrow(_keys, "key long, side byte, word string, n long"))
    # one shuffle for both sides; a key that only one word has meets nothing
    a, b = (keys.select("key", *(F.col(c).alias(f"{s}_{c}") for c in ("side", "word", "n"))) for s in "ab")
    meets = ((F.col("a_side") == 0) & (F.col("b_side") == 0) & (F.col("a_word") < F.col("b_word"))) | ((F.col("a_side") == 1) & (F.col("b_side") == 2))
    pairs = a.join(b, "key").where(meets).where(F.levenshtein("a_word", "b_word", 1) == 1)
    a_first = F.col("a_word") < F.col("b_word")
    own, other = (F.struct(F.col(f"{s}_word").alias("w"), F.col(f"{s}_n").alias("n")) for s in "ab")
    pairs = pairs.select(F.when(a_first, own).otherwise(other).alias("x"), F.when(a_first, other).otherwise(own).alias("y"))
    return pairs.distinct().select(F.col("x.w").alias("a"), F.col("y.w").alias("b"), F.col("x.n").alias("a_n"), F.col("y.n").alias("b_n"))


def roots(forms: DataFrame, rounds: int = 40) -> DataFrame:
    """(word, root) of ``forms`` (word, form): where forms, followed to the last, end.

    Every round doubles the steps taken. A form must be commoner than its word, so there is
    no circle and the rounds grow with the logarithm of the longest chain.
    """
    state = saved(forms.select("word", F.col("form").alias("root")))
    for _ in range(rounds):
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = saved(state.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")
    raise RuntimeError(f"roots not settled after {rounds} rounds")


def spelling_groups(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``words`` (word, n) with ``n_near``, ``form``, ``form_n`` and ``root``.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form
    is its near word of the largest n (ties: the first in code-point order) if that is at
    least ``ratio`` (two or more) times its own, else null; ``root`` follows forms to the last, and is the
    word itself where there is none. ``words`` must hold each word once; null words and
    counts are left out, the empty word is a word. Words of any length are compared whole.
    An empty table gives no row.
    """
    if ratio < 2:
        raise ValueError("a form must be commoner than its word")
    words = saved(words.select(F.col("word").cast("string"), F.col("n").cast("long")).where("word is not null and n is not null"))
    pairs = near_words(words)
    side = lambda x, y: F.struct(F.col(x).alias("word"), F.col(f"{x}_n").alias("n"), F.col(y).alias("other"), F.col(f"{y}_n").alias("other_n"))
    near = pairs.select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("p")).select("p.*")
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form"))).alias("best")
    near = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    found = saved(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.rank") >= ratio * F.col("n"), F.struct(F.col("best.form").alias("form"), (-F.col("best.rank")).alias("n"))).alias("form")))
    found = found.select("word", "n", "n_near", F.col("form.form").alias("form"), F.col("form.n").alias("form_n"))
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def counted(words: DataFrame, least_points: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of a table of occurrences (word): those long and frequent enough."""
    return words.where(F.length("word") >= least_points).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def runs(docs: DataFrame, letters: str, text_col: str = "text", least_points: int = 1) -> DataFrame:
    """``docs`` by maximal run of ``letters`` (a class, both cases of A-Z in it), as ``run``.

    Only A-Z are lower-cased. Runs shorter than ``least_points`` are left out; null texts
    have none. All columns of ``docs`` but the text are kept.
    """
    low = F.translate(F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(low, F.lit(f"[{letters}]{{{least_points},}}"), 0)
    kept = [c for c in docs.columns if c not in (text_col, "run")]
    # an outer generator: no filter works the runs out again
    return docs.select(*kept, F.explode_outer(found).alias("run")).where("run is not null")


def without_point(word: Column, at: Column) -> Column:
    """A word without the code point at a place, from 0."""
    return F.concat(F.left(word, at), F.substr(word, at + F.lit(2)))
