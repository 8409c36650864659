"""Packing, spelling variants and source divergence against plain Python on small tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm import divergence, packing, spelling, wordids
from tallyward.llm.queries import WORDS

ODD = ["", None, "   \n", "a", "It's  O'Neill’s <|endoftext|> x́ ́y", "ÀÉ straße Σας ΣΑΣ", "x" * 5000, "1234 5.6e7 --== \x0b\x1c z", " a\u0085b", "日本語 テスト 🙂🙂"]


def words(rng, n, kinds=300):
    return " ".join("".join(rng.choice("abcdéß'") for _ in range(1 + rng.randrange(kinds) % 9)) for _ in range(n))


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in ("start", "length", "ids", "term", "n", "word", "h", "run", "part", "value", "g", "key", "side", "sequence_id", "offset", "doc_tokens")})


# --- packing ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def packed(spark):
    rng = random.Random(5)
    texts = ODD + [words(rng, rng.randrange(1, 900)) for _ in range(40)] + [words(rng, 30_000)]
    data = [(i, t) for i, t in enumerate(texts)]
    data += [(7, texts[7]), (12, texts[12]), (None, texts[12])]
    df = clashing(spark.createDataFrame(data, "doc_id long, text string")).repartition(3)
    rows = packing.bucketed(packing.cut_documents(df, WORDS)).withColumn("crc", F.crc32("ids"))
    return data, [Row(**r.asDict() | {"ids": np.frombuffer(r.ids, "<u4").tolist()}) for r in rows.collect()]


def test_packing_holds_every_token_once(packed):
    data, rows = packed
    tokenizer = Tokenizer.from_file(WORDS)
    whole = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in data}
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.text].append(r)
        assert r.length == len(r.ids) and r.offset == 0 and r.key == "clash"
        assert r.crc == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.doc_tokens == len(whole[r.text])
    copies = Counter(data)
    assert set(got) == set(copies)
    for (_, text), times in zip(got, (copies[k] for k in got)):
        pieces = sorted(got[_, text], key=lambda r: r.start)
        ids, least = whole[text], 0
        for start in range(0, len(pieces), times):
            same = pieces[start : start + times]
            assert len({tuple(r.ids) for r in same}) == 1 and same[0].start == least
            assert same[0].ids == ids[least : least + same[0].length]
            least += same[0].length
        assert least == len(ids)


def test_packing_lengths_are_binary_and_sequences_gapless(packed):
    _, rows = packed
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    by_length = defaultdict(list)
    for r in rows:
        assert r.length <= 2048 and r.length & (r.length - 1) == 0
        by_length[r.length].append(r.sequence_id)
    for ids in by_length.values():
        assert max(ids) - min(ids) == len(ids) - 1
    one = [r.length for r in rows if r.doc_id == 50]
    assert Counter(one).most_common(1)[0][0] == 2048 and len([n for n in one if n < 2048]) == len({n for n in one if n < 2048})


def test_packing_batches(spark, packed):
    _, rows = packed
    df = spark.createDataFrame([(r.length, r.sequence_id) for r in rows], "length long, sequence_id long")
    out = packing.with_batches(df, 4096).groupBy("length", "batch").agg(F.sum("length").alias("n")).collect()
    last = {}
    for r in out:
        last[r.length] = max(last.get(r.length, 0), r.batch)
    assert all(r.n == 4096 for r in out if r.batch < last[r.length])


def test_packing_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.bucketed(packing.cut_documents(empty, WORDS)).collect() == []
    with pytest.raises(ValueError):
        packing.cut_documents(empty, WORDS, longest=1000)
    assert [packing.binary_pieces(n, 8) for n in (1, 7, 8, 21)] == [[1], [4, 2, 1], [8], [8, 8, 4, 1]]


def test_packing_same_numbers_again(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, words(rng, 50)) for i in range(30)], "doc_id long, text string").repartition(3, "doc_id")
    runs = [sorted(map(tuple, packing.bucketed(packing.cut_documents(df, WORDS)).select("sequence_id", "doc_id", "start").collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def test_word_ids_equal_the_library():
    with open(WORDS, encoding="utf-8") as file:
        encode = wordids.WordIds(wordids.model_tables(file.read()))
    library = Tokenizer.from_file(WORDS)
    rng = random.Random(1)
    signs = "abcdeABCDEéÉßÿ÷×Ññ'.,-1239 \n\t<|>_\u0301́ŁłИи日\x00\x1fſİK"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ODD + ["aaaa aaaaa hahahahaha", "x" * 3 + " " + "xy" * 4000, "Ã", " É", "<|startoftext|>A"]
    for some in (texts, [], [""], [None]):
        flat, at = encode(pa.array(some, pa.string()), 1)
        want = [[*e.ids, 1] for e in library.encode_batch([t or "" for t in some], add_special_tokens=False)]
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    with pytest.raises(ValueError, match="not a byte-level"):
        wordids.model_tables('{"model": {"type": "Unigram"}}')


# --- spelling variants -----------------------------------------------------------------


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def groups_by_hand(counts):
    near = {w: [x for x in counts if one_apart(w, x)] for w in counts}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] is not None else None, root)
    return out


def test_spelling_groups(spark):
    rng = random.Random(2)
    some = {"".join(rng.choice("abéñ") for _ in range(rng.randrange(0, 9))) for _ in range(400)}
    some |= {"a" * 300, "a" * 301, "a" * 299 + "b", "b" + "a" * 299, "ba" * 150, "aabb", "abab", "bbaa"}
    some |= {"".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(50)}
    counts = {w: rng.choice([3, 3, 4, 6, 8, 16, 40, 100, 1000]) for w in some}
    df = spark.createDataFrame([*counts.items(), (None, 5), ("zzz", None)], "word string, n long").repartition(3)
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_groups(df).collect()}
    assert got == groups_by_hand(counts)
    assert spelling.spelling_groups(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_groups(df, ratio=1)


def test_spelling_roots_of_a_long_chain(spark):
    chain = [("".join("b" if j < i else "a" for j in range(20)), 3 * 2**i) for i in range(20)]
    got = {r.word: r.root for r in spelling.spelling_groups(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert set(got.values()) == {chain[-1][0]} and len(got) == 20


def test_spelling_keys_do_not_all_meet(spark):
    """Words of the same letters share all signatures; their halves keep them apart."""
    rng = random.Random(4)
    letters = list("abcdefghijkl")
    some = set()
    while len(some) < 2000:
        rng.shuffle(letters)
        some.add("".join(letters))
    batch = pa.record_batch([pa.array(sorted(some)), pa.array([3] * 2000)], ["word", "n"])
    keys = Counter(k for b in spelling._keys(iter([batch])) for k in b.column(0).to_pylist())
    assert max(keys.values()) < 20


def test_runs_and_lost_letters(spark):
    texts = ["Größe ÀÀÀÀÀ-abcd ABCDE", None, "", "ÿþ×÷ñ1234zzzzz", "aaaaa_aaaaa"]
    df = clashing(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = spelling.runs(df, "A-Za-zÀ-ÿ", least_points=5).select("doc_id", "run").collect()
    want = [(i, x.translate({c: c + 32 for c in range(65, 91)})) for i, t in enumerate(texts) for x in re.findall("[A-Za-zÀ-ÿ]+", t or "") if len(x) >= 5]
    assert sorted(map(tuple, got)) == sorted(want)
    cut = spark.range(6).select(spelling.without_point(F.lit("größer"), F.col("id").cast("int")).alias("x"))
    assert [r.x for r in cut.collect()] == ["rößer", "gößer", "grßer", "gröer", "größr", "größe"]


# --- source divergence ---------------------------------------------------------------------


def by_hand(rows, least_docs, most):
    found = [(lang or "", source or "", Counter(x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""))) for lang, source, text in rows]
    out = set()
    for lang in {r[0] for r in found}:
        docs = Counter(t for r in found if r[0] == lang for t in r[2])
        kept = sorted(t for t, n in docs.items() if n >= least_docs)
        sources = sorted({r[1] for r in found if r[0] == lang})
        counts = {s: Counter() for s in sources}
        for l, s, c in found:
            if l == lang:
                counts[s].update(c)
        share = {}
        for s, c in [*counts.items(), (None, sum(counts.values(), Counter()))]:
            total = sum(c[t] for t in kept)
            share[s] = [1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept]
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pair = [(sum(map(f, share[s], share[o])), o) for o in sources if o != s]
            term = [(f(p, q), t) for t, p, q in zip(kept, share[s], share[None]) if counts[s][t] and p > q]
            for part, some, limit in (("pair", pair, None), ("term", term, most)):
                ranked = sorted(some, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)}
    return out


def some_rows(seed=6):
    rng = random.Random(seed)
    rows = []
    for _ in range(300):
        lang, source = rng.choice(["en", "fr", None, ""]), rng.choice(["a", "b", "ç", None, "d", "𝒳", "￮"])
        rows.append((lang, source, " ".join(rng.choice(["Äb", "x", "the", "The", "naïve", "日本", "zz9zz", f"w{rng.randrange(40)}k", "q" * rng.randrange(1, 6)]) for _ in range(rng.randrange(60)))))
    rows += [("en", "none", None), ("en", "digits", "123 456"), ("xx", "lone", "few words only"), ("xx", "other", ""), (None, None, None)]
    return rows + rows[:20]


def divergences(spark, rows, **kw):
    df = clashing(spark.createDataFrame(rows, "lang string, source string, text string")).repartition(5)
    got = divergence.source_divergence(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_source_divergence(spark):
    rows = some_rows()
    assert divergences(spark, rows) == by_hand(rows, 10, 10)
    assert divergences(spark, [], least_docs=1) == set()


def test_source_divergence_over_many_cells(spark, monkeypatch):
    """Small blocks: several of groups and of terms, also ones where a group has no term."""
    monkeypatch.setattr(divergence, "GROUPS", 2)
    monkeypatch.setattr(divergence, "TERMS", 5)
    rows = some_rows(8)
    assert divergences(spark, rows, least_docs=3, most_terms=4) == by_hand(rows, 3, 4)


def test_shares_are_exact():
    rng = random.Random(3)
    total = [rng.randrange(1, 9 * 10**15) for _ in range(200)]
    counts = [rng.randrange(0, t) for t in total]
    got = divergence.shares(np.array([counts]).T, np.array([total]).T)
    assert got[:, 0].tolist() == [1 + 10**9 * (c + 2) // t for c, t in zip(counts, total)]
