"""Divergence between sources of a language, by three-dimensional cube partitioning.

Shares of terms are whole billionths, and the divergence of two groups is the sum over all
kept terms of the language of ``(p - q)**2 // (p + q)``, so every figure is exact. Groups and
terms of a language are dealt to blocks; the task of a cell (group block, group block, term
block) gets the slices of both group blocks for its terms, works out the partial sums of all
pairs between the blocks, and the partial sums are added along the term axis. No task sees
all terms of a group, nor all groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import LOWER, bytes_and_offsets, saved

#: Groups in a block, and terms that a block holds on average.
GROUPS, TERMS = 64, 4096
#: Bytes of text that are counted at once.
CHUNK = 1 << 23
BILLION = 1_000_000_000

#: Bytes of a term (ASCII letters, and all of longer characters) in lower case, others as blanks.
TERM = np.where((np.arange(256) >= 0x80) | ((LOWER >= 0x61) & (LOWER <= 0x7A)), LOWER, 0x20).astype(np.uint8)


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about a chunk."""
    low = 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1)
        yield low, high
        low = high


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of each chunk of (lang, source, text)."""
    for batch in batches:
        data, offsets = bytes_and_offsets(batch.column(2))
        for low, high in _chunks(offsets):
            rows = batch.slice(low, high - low)
            lang, source = (rows.column(i).dictionary_encode() for i in (0, 1))
            group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            ends = (offsets[low : high + 1] - offsets[low]).astype(np.int64)
            part = TERM[data[offsets[low] : offsets[high]]]
            texts = pa.LargeStringArray.from_buffers(high - low, pa.py_buffer(ends), pa.py_buffer(part))
            lists = pc.ascii_split_whitespace(texts)
            terms = lists.flatten().dictionary_encode()
            row = np.repeat(np.arange(high - low), np.diff(lists.offsets.to_numpy()))
            kinds = max(1, len(terms.dictionary))
            pairs, times = np.unique(row * kinds + terms.indices.to_numpy(), return_counts=True)
            keys, at = np.unique(group[pairs // kinds] * kinds + pairs % kinds, return_inverse=True)
            n, docs = np.bincount(at, times).astype(np.int64), np.bincount(at).astype(np.int64)
            of, term = keys // kinds, terms.dictionary.take(pa.array(keys % kinds)).cast(pa.string())
            out = pa.record_batch(
                [lang.dictionary.take(pa.array(of // len(source.dictionary))), source.dictionary.take(pa.array(of % len(source.dictionary))), term, pa.array(n), pa.array(docs)],
                ["lang", "source", "term", "n", "docs"],
            )
            yield out.filter(pc.not_equal(term, ""))


def term_counts(docs: DataFrame) -> DataFrame:
    """Per (lang, source, term) of ``docs`` (lang, source, text, no nulls): occurrences and documents."""
    found = docs.select("lang", "source", "text").mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kinds: Column) -> Column:
    """``1 + floor(1e9 * (count + 2) / (total + 2 * kinds))`` in whole numbers, three digits at a time."""
    whole = (total + 2 * kinds).cast("decimal(38,0)")
    up = (count + 2).cast("decimal(38,0)") * F.lit(BILLION).cast("decimal(10,0)")
    return F.call_function("div", up, whole) + 1


def distance(p: Column, q: Column) -> Column:
    """``floor((p - q) ** 2 / (p + q))`` of two shares."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(1e9 * (counts + 2) / total)``, exact for totals up to 9e15: digits by long division."""
    whole, rest = np.divmod(counts + 2, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def _cell(key: tuple, rows: pa.Table) -> pa.Table:
    """Partial divergences of all pairs of groups between the two blocks of a cell."""
    lang, low, high, _ = (k.as_py() for k in key)
    heads = rows.filter(pc.is_null(rows["term"]))
    rest = rows.filter(pc.is_valid(rows["term"])).combine_chunks()
    n_terms = heads["n_terms"][0].as_py()
    terms = rest["term"].combine_chunks().dictionary_encode() if rest.num_rows else None
    seen = len(terms.dictionary) if terms else 0
    sides = {}
    for block in {low, high}:
        own = heads.filter(pc.equal(heads["block"], block))
        slots = own["slots"].combine_chunks().flatten().to_numpy()
        total = np.zeros(GROUPS, np.int64)
        total[slots] = own["counts"].combine_chunks().flatten().to_numpy()
        counts = np.zeros((GROUPS, seen + 1), np.int64)  # the last column: a term that neither has
        if terms:
            mine = pc.equal(rest["block"].combine_chunks(), block)
            lists = rest["slots"].combine_chunks().filter(mine)
            at = np.repeat(terms.indices.filter(mine).to_numpy(), pc.list_value_length(lists).to_numpy())
            counts[lists.flatten().to_numpy(), at] = rest["counts"].combine_chunks().filter(mine).flatten().to_numpy()
        slots = np.sort(slots)
        sides[block] = slots, shares(counts[slots], np.maximum(total, 1)[slots, None])
    times = np.ones(seen + 1, np.int64)
    times[-1] = n_terms - seen
    (slots_a, p), (slots_b, q) = sides[low], sides[high]
    out = []
    for i, a in enumerate(slots_a.tolist()):
        after = int(np.searchsorted(slots_b, a, "right")) if low == high else 0
        gap = q[after:] - p[i]
        sums = (gap * gap // (q[after:] + p[i])) @ times
        out.append((np.full(len(sums), low * GROUPS + a), high * GROUPS + slots_b[after:], sums))
    a, b, sums = (np.concatenate([o[k] for o in out]).astype(np.int64) for k in range(3))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "value": sums})


def source_divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 10, most_terms: int = 10
) -> DataFrame:
    """How each (language, source) group differs from the others and from its language.

    Terms are runs of ASCII letters, lower-cased, and of all characters beyond ASCII. A
    language keeps the terms in at least ``least_docs`` of its documents, V in all. A group,
    and the language as a whole, gives each of them ``p = 1 + floor(1e9 * (n + 2) / (N + 2 V))``,
    n its occurrences there, N those of all kept terms. Part ``pair``: the divergence from
    each other source of the language, over all kept terms (0 if there is none). Part
    ``term``: the ``most_terms`` terms that the group has more of than its language, by their
    term of that sum. Ranks go by value, then item.

    Null text, language and source are ''. Every row is a document, repeated ones too. A
    group without terms is compared as well. Documents of any length are read whole; an
    empty table gives no row. Other columns are not looked at.
    """
    named = {"lang": lang_col, "source": source_col, "text": text_col}
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in named.items()))
    counts = saved(term_counts(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least_docs)
    kept = saved(kept.select("lang", "term", "lang_n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("lang_n").alias("lang_total"))
    counts = saved(counts.drop("docs").join(kept, ["lang", "term"]))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["kinds", "total", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    n_groups = F.count(F.lit(1)).over(Window.partitionBy("lang"))
    groups = saved(groups.withColumns({"g": number, "blocks": F.ceil(n_groups / GROUPS).cast("long"), "parts": F.greatest(F.lit(1), F.ceil(F.col("kinds") / TERMS)).cast("long")}))
    counts = counts.join(groups, ["lang", "source"])

    # terms that a group has more of than its language
    p, q = share(F.col("n"), F.col("total"), F.col("kinds")), share(F.col("lang_n"), F.col("lang_total"), F.col("kinds"))
    more = counts.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    more = more.select("lang", "source", F.lit("term").alias("part"), "item", distance(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    more = more.withColumn("rank", rank).where(F.col("rank") <= most_terms)

    # cells: (block, block, part of the terms), each side with its groups' totals as a row without term
    block, slot = F.floor(F.col("g") / GROUPS).alias("block"), F.pmod("g", F.lit(GROUPS)).alias("slot")
    part = F.pmod(F.xxhash64("term"), F.col("parts")).alias("part")
    of_block = lambda df, *keys: df.groupBy("lang", "block", "blocks", *keys).agg(F.collect_list(F.struct("slot", "value")).alias("own"))
    slices = of_block(counts.select("lang", block, "blocks", part, "term", slot, F.col("n").alias("value")), "part", "term")
    slices = slices.withColumn("n_terms", F.lit(0).cast("long"))
    total = (F.col("total") + 2 * F.col("kinds")).alias("value")
    heads = of_block(groups.select("lang", block, "blocks", "parts", slot, total), "parts")
    heads = heads.select("lang", "block", "blocks", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    sizes = kept.join(groups.select("lang", "parts").distinct(), "lang").groupBy("lang", part).agg(F.count(F.lit(1)).alias("n_terms"))
    heads = heads.join(sizes, ["lang", "part"], "left").withColumn("term", F.lit(None).cast("string")).fillna(0, ["n_terms"])
    rows = slices.unionByName(heads)
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("partner")
    rows = rows.select("lang", "block", "part", "term", "n_terms", F.col("own.slot").alias("slots"), F.col("own.value").alias("counts"), partner)
    rows = rows.select("*", F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"))
    sums = rows.groupBy("lang", "low", "high", "part").applyInArrow(_cell, "lang string, a long, b long, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("g"), F.col("b").alias("other")), F.struct(F.col("b").alias("g"), F.col("a").alias("other")))).alias("x")
    names = groups.select("lang", "g", "source")
    pairs = sums.select("lang", both, "value").select("lang", "x.g", "x.other", "value").join(names, ["lang", "g"])
    pairs = pairs.join(names.select("lang", F.col("g").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", rank)
    return pairs.unionByName(more)
