"""Language identification by compression with one zstandard dictionary per language.

A dictionary is raw text of its language; a text belongs to the language whose dictionary
compresses it to the fewest bytes. Texts are reduced to their letters in lower case and
compressed in blocks of which each starts afresh, so that the dictionary counts over the
whole text and not only at its start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
#: Short matches count: three letters, found by binary trees with lazy choice.
SEARCH = {"window_log": 20, "chain_log": 17, "hash_log": 17, "search_log": 3, "min_match": 3, "target_length": 32, "strategy": zstandard.STRATEGY_BTLAZY2}
UNKNOWN = "und"


def letters_only(text: Column) -> Column:
    """Lower case, with a blank for each run of anything but letters."""
    return F.lower(F.regexp_replace(text, r"\P{L}+", " "))


def train_dictionaries(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_chars: int = 2000,
    sample_texts: int = 64,
    most_langs: int = 200,
) -> dict[str, bytes]:
    """One raw-content dictionary per language of ``labelled``.

    The sample is bounded: of each language the ``sample_texts`` distinct texts of least
    hash, at most ``sample_chars`` characters from the middle of each (the model's size is
    thus at most ``most_langs * sample_texts * sample_chars * 4`` bytes). Rows with a null
    language or text, or without a letter, are not learned from. More than ``most_langs``
    languages raise an error.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null").where(has_letter(F.col("text")))
    rows = rows.withColumn("text", letters_only(F.col("text")))
    start = F.greatest(F.lit(1), ((F.length("text") - sample_chars) / 2).cast("int") + 1)
    rows = rows.select("lang", F.xxhash64("text").alias("h"), F.substr("text", start, F.lit(sample_chars)).alias("part"))
    # the least hashes of each language: limited in every task, then in all
    spread = rows.groupBy("lang", F.pmod("h", F.lit(sample_texts)).alias("slot")).agg(F.min(F.struct("h", "part")).alias("least"))
    parts = spread.groupBy("lang").agg(F.array_sort(F.collect_list("least")).alias("parts")).limit(most_langs + 1).collect()
    if len(parts) > most_langs:
        raise ValueError(f"more than {most_langs} languages")
    return {r["lang"]: "\n".join(p["part"] for p in r["parts"]).encode() for r in sorted(parts, key=lambda r: r["lang"])}


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def _sizes(texts: list[bytes], dictionaries: list[bytes]) -> np.ndarray:
    """Compressed bytes of each text with each dictionary, over all its blocks."""
    out = np.zeros((len(texts), len(dictionaries)))
    blocks = [[t[i : i + BLOCK] for i in range(0, len(t), BLOCK)] for t in texts]
    for k, data in enumerate(dictionaries):
        model = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        search = zstandard.ZstdCompressionParameters(**SEARCH, write_content_size=False, write_checksum=False, write_dict_id=False)
        model.precompute_compress(compression_params=search)
        press = zstandard.ZstdCompressor(dict_data=model, compression_params=search).compress
        out[:, k] = [sum([len(press(b)) for b in bs]) for bs in blocks]
    return out


def predict_language(
    docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_margin: float = 0.01
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``; only the text is looked at.

    ``score`` is the share of bytes that the best dictionary saves against the second best
    (0 to 1; 1 with one language). ``rejected`` marks texts without language (null, empty or
    without a letter, or nothing was learned: ``und``, score 0) and those with a margin under
    ``min_margin``, ties among them, for which ``lang_pred`` still names the best, of equal
    ones the first by name. Very long texts are read whole, in blocks. Columns of these
    names are replaced, all others stay as they are.
    """
    names = sorted(dictionaries)
    shared = docs.sparkSession.sparkContext.broadcast([dictionaries[n] for n in names])

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for (texts,) in ((b,) if not isinstance(b, tuple) else b for b in batches):
            raw = [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]
            if not names:
                best, score = np.full(len(raw), -1), np.zeros(len(raw))
            else:
                sizes = _sizes(raw, shared.value)
                best = sizes.argmin(axis=1)
                ranked = np.sort(sizes, axis=1)
                second = ranked[:, 1] if len(names) > 1 else np.inf
                with np.errstate(invalid="ignore", divide="ignore"):
                    score = np.where(ranked[:, 0] > 0, 1 - ranked[:, 0] / second, 0.0)
            yield pa.StructArray.from_arrays(
                [pa.array([names[i] if i >= 0 else UNKNOWN for i in best.tolist()], pa.string()), pa.array(score, pa.float64())], ["lang", "score"]
            )

    judged = F.arrow_udf(judge, "struct<lang:string,score:double>")
    text = F.col(text_col).cast("string")
    letters = F.coalesce(has_letter(text), F.lit(False))
    out = docs.withColumn("lang_pred", F.when(letters, judged(letters_only(text))))
    return out.withColumns(
        {
            "lang_pred": F.coalesce("lang_pred.lang", F.lit(UNKNOWN)),
            "score": F.coalesce("lang_pred.score", F.lit(0.0)),
            "rejected": F.coalesce((F.col("lang_pred.score") < min_margin) | (F.col("lang_pred.lang") == UNKNOWN), F.lit(True)),
        }
    )
