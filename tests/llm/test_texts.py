"""Operators on texts against row-by-row Python on small tables."""

from __future__ import annotations

import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallyward.llm import common, jaccard, lines, lm, mixing, pieces, shards, wordpieces
from tallyward.llm.common import components, word_hashes
from tallyward.llm.langid import predict_language, train_dictionaries
from tallyward.llm.queries import PIECES

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def some_texts():
    """Copies, near copies, shared passages, short, empty, blank and null texts."""
    rng = random.Random(7)
    out = [sentence(rng, 60, 5000) for _ in range(25)]
    passage = sentence(rng, 12, 5000)
    for i in range(20):
        words = out[i % 5].split()
        words[rng.randrange(len(words))] = f"new{i}"
        out.append(" ".join(words))
    out += [f"{sentence(rng, 20)} {passage} {sentence(rng, 20)}" for _ in range(30)]
    out += [out[0], out[0].upper(), "a b", "A B", "a  b\n", "a", "", " \t\n", None, None, "a b c d e"]
    out.append(sentence(rng, 60_000, 10**6))
    return out


def table(spark, texts, extra=""):
    """doc_id and text, and columns whose names the operators use inside."""
    data = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string, n string")
    names = ("mark", "gram", "u", "tie", "pattern", "row", "h", "slot", "shard", "key", "word", "a", "b")
    return df.withColumns({c: F.lit("clash") for c in names}).repartition(3)


@pytest.fixture(scope="module")
def texts():
    return some_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts)


def empty(docs):
    return docs.where("doc_id < 0")


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_word_hashes_tell_words_apart():
    texts = ["The the  THE\tthé", None, "", "x" * 3_000_000 + " y", "a b c"]
    hashes, at = word_hashes(pa.array(texts))
    assert np.diff(at).tolist() == [4, 0, 0, 2, 2]
    assert len(set(hashes.tolist())) == 6
    again, _ = word_hashes(pa.array(["the"] + texts).slice(1))
    assert (again == hashes).all()


def test_components_against_search(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)]
    edges += [(1000, k) for k in range(1001, 1200)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges + [(None, 3)], "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(parent, x) for x in linked}


def test_ngram_jaccard(docs, texts):
    sets = []
    for t in texts:
        w = WORDS.findall((t or "").encode().lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    parent = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.ngram_jaccard(docs).collect()}
    assert got == {i: (len(x), find(parent, i)) for i, x in enumerate(sets)}
    assert len(set(parent)) < len(parent) - 10


def test_ngram_jaccard_long_columns(spark):
    """A large group of near copies and one passage in unlike documents; two far members of one group."""
    rng = random.Random(3)
    base = sentence(rng, 120, 10**6).split()
    data = []
    for i in range(60):
        own = list(base)
        own[rng.randrange(120)] = f"x{i}"
        data.append(" ".join(own))
    data += [" ".join(base[:50]) + " " + sentence(rng, 100, 10**6) for _ in range(40)]
    step = list(base)
    for i in range(40):  # a chain that leads away from the group
        step[i] = f"y{i}"
        data.append(" ".join(step))
    test_ngram_jaccard(table(spark, data), data)


def test_ngram_jaccard_leaves_texts_in_place_beside_few_ids(spark, monkeypatch):
    """The texts to be verified are met by a table of ids of known size, so they are not shuffled."""
    rng = random.Random(8)
    texts = [sentence(rng, 60, 10**6) for _ in range(300)]
    texts[7] = texts[6] + " x"
    plans, was = [], jaccard.saved

    def saved(df):
        if df.columns == ["mark", "grams"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return was(df)

    monkeypatch.setattr(jaccard, "saved", saved)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        got = {r.doc_id: r.component_id for r in jaccard.ngram_jaccard(table(spark, texts)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: 6 if i == 7 else i for i in range(300)}
    assert plans and not any("hashpartitioning" in p for p in plans), plans


def peak_mb(work):
    """What ``work`` yields, and the MB of numpy that it held at most."""
    tracemalloc.start()
    out = list(work())
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, peak


def test_ngram_jaccard_holds_a_slice_of_a_batch():
    rng = random.Random(5)
    texts = [" ".join(rng.choices(some := [f"w{i}" for i in range(5000)], k=400)) for _ in range(4000)]
    batch = pa.record_batch([pa.array(range(4000), pa.int64()), pa.array([None, *texts[1:-1], ""])], ["doc_id", "text"])
    assert len(some) == 5000 and batch.nbytes > 8e6
    common.powers(common.WINDOW)
    whole = common.shingle_sets(batch.column(1))
    got, peak = peak_mb(lambda: jaccard._sets(iter([batch]), 5))
    assert peak < 45, peak  # 26 MB; 64 when the batch was held whole
    got = pa.Table.from_batches(got)
    assert got["mark"].to_pylist() == list(map(jaccard.fingerprint, whole))
    assert got["grams"].to_pylist() == [x.tobytes() for x in whole]


def test_ngram_order_counts_what_each_task_finds_twice(spark):
    """An n-gram that no task finds more than twice is known as frequent if many tasks find it."""
    rng = random.Random(2)
    texts = [(f"{sentence(rng, 20, 10**6)} passage of six common words here {sentence(rng, 20, 10**6)}",) for _ in range(20)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(texts, 10), "text string")  # two in each task
    _, n = jaccard._often(df, 5, 100)
    assert n.tolist() == [20, 20]
    table_ = df.select(F.monotonically_increasing_id().alias("doc_id"), "text")
    assert jaccard.ngram_jaccard(table_).where("doc_id != component_id").count() == 0


def test_ngram_jaccard_reports_what_is_seen_often():
    for n in (0, 1, 3, 4, 5, 4000):
        grams = np.random.default_rng(n).integers(0, 1 + n // 4, n).astype(np.uint64)
        wanted = {g: k for g, k in zip(*(x.tolist() for x in np.unique(grams, return_counts=True))) if k >= jaccard.REPORTED}
        got = jaccard._reported(grams)
        assert dict(zip(*(c.to_pylist() for c in got.columns))) == wanted


def test_ngram_jaccard_block_holds_a_strip_of_its_pairs():
    """2,000 classes that all share enough: the pairs of a block are handed on strip by strip."""
    k = 2000
    gram = np.tile(np.arange(4), k)
    mark, ones = np.repeat(np.arange(k), 4), np.ones(4 * k, np.int64)
    block = [0 * ones, 0 * ones, 0 * ones, 0 * ones, gram, mark, 80 * ones, mark, 40 * ones]

    def product():
        found = jaccard._block_pairs(block, 75)
        for batch in [found] if isinstance(found, pa.RecordBatch) else found:
            a, b = (c.to_numpy() for c in batch.columns)
            yield len(a), bool((a < b).all()), np.unique(a * k + b).size

    found, peak = peak_mb(product)
    assert peak < 90, peak  # 51 MB; 130 when all pairs were held
    assert [sum(x) for x in zip(*found)] == [k * (k - 1) // 2, len(found), k * (k - 1) // 2]


def test_ngram_jaccard_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (0, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard.ngram_jaccard(df).collect()), key=str)
    assert got == [(0, 0, 0), (1, 2, 1), (1, 2, 1), (None, 2, None)]
    assert jaccard.ngram_jaccard(df.limit(0)).collect() == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_line_dedup(spark):
    """Equal to linking all pairs by edit similarity alone."""
    rng = random.Random(5)
    long = [sentence(rng, 60) for _ in range(6)]
    near = [t.replace("w1", "w2", 1) for t in long] + [f"{t} w399" for t in long]
    pool = long + near + ["Short line", "short   LINE!", "--- ---", "", "other", sentence(rng, 700), "é À", "É à."]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    texts += [None, "", "\n", texts[0], sentence(rng, 300)]
    out = lines.dedup_lines(table(spark, texts)).collect()
    norm = lambda t: re.sub(r"[\W_]+", " ", t).lower().strip()
    every = sorted({norm(x) for t in texts if t is not None for x in t.split("\n")} - {""})
    parent = list(range(len(every)))
    links = 0
    for i in range(len(every)):
        for j in range(i):
            most = int(max(len(every[i]), len(every[j])) * 0.2 + 1e-9)
            if distance(every[i], every[j]) <= most:
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
                links += 1
    assert links
    group = {x: find(parent, i) for i, x in enumerate(every)}
    seen, want = set(), {}
    for i, t in enumerate(texts):
        kept = []
        for x in (t or "").split("\n"):
            if norm(x) and group[norm(x)] in seen:
                continue
            seen.add(group.get(norm(x)))
            kept.append(x)
        want[i] = None if t is None else "\n".join(kept)
    # texts[0] and its later copy differ in id, so the copy loses its lines
    assert {r.doc_id: r.text for r in out} == want
    assert all(r.a == "clash" and (r.n_lines > 0 or r.text is None) for r in out)


def test_line_dedup_edges(spark):
    df = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "x y"), (2, "X, Y\nz")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text, r.n_dropped) for r in lines.dedup_lines(df).collect()), key=str)
    assert got == [(1, "", 1), (1, "", 1), (2, "z", 1), (None, "x y", 0)]
    assert lines.dedup_lines(df.limit(0)).collect() == []


def test_models_of_another_kind_are_refused(tmp_path):
    """A model that picks pieces by score, or one that folds blanks, would give other ids."""
    with open(PIECES, "rb") as file:
        raw = file.read()
    scored, folding = raw.replace(b"tok_v0\x18\x02", b"tok_v0\x18\x01"), raw.replace(b"identity\x12\x00\x18\x01 \x00", b"identity\x12\x00\x18\x01 \x01")
    for k, other in enumerate((scored, folding)):
        assert other != raw
        (tmp_path / f"{k}.model").write_bytes(other)
        with pytest.raises(ValueError, match="in another way"):
            pieces.load_pieces(str(tmp_path / f"{k}.model"))
    pieces.load_pieces(PIECES)


def test_a_chunk_holds_each_distinct_unit_once():
    encoder = pieces.Encoder(pieces.load_pieces(PIECES))
    text = "".join(f"{pieces.MARK}word{i % 500}" for i in range(2_000))
    one, _ = encoder.ids([text])
    tracemalloc.start()
    try:
        flat, counts = encoder.ids([text] * 300)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (flat == np.tile(one, 300)).all() and (counts == len(one)).all()
    assert peak < 8 * flat.nbytes
    assert [len(x) for x in encoder.ids([])] == [0, 0]


def test_texts_are_encoded_and_decoded_chunk_by_chunk(spark, monkeypatch):
    """No batch is held whole: its texts come in runs of about a chunk, in order, nulls and long ones included."""
    texts = pa.array([None, "ab cd", "", "é" * 30, None, "x y " * 20, "z"] * 5)
    monkeypatch.setattr(pieces, "CHUNK", 20)
    runs = list(pieces.chunks(texts))
    assert pa.concat_arrays(runs).equals(texts) and len(runs) == 11
    assert list(pieces.chunks(texts.slice(0, 0))) == []
    monkeypatch.undo()
    model = pieces.load_pieces(PIECES)
    rows = [None, "", "word " * 300_000, "a", None, *(f"text {i} " * 40_000 for i in range(12)), "end"]
    df = table(spark, rows).coalesce(1)
    out = df.withColumn("ids", pieces.encoded(model, df, F.col("text")))
    out = out.withColumn("back", pieces.decoded(model, df, F.col("ids"))).orderBy("doc_id").collect()
    want = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert [r.back for r in out] == rows
    assert [r.ids for r in out] == [None if t is None else want.encode(t) for t in rows]


@pytest.mark.parametrize("times", [1, 2, 3])
def test_line_dedup_of_repeated_rows(spark, times):
    """Near copies are found however often their rows are repeated."""
    rng = random.Random(12)
    data = []
    for i in range(20):
        words = sentence(rng, 150, 10**6).split()
        data.append((i, " ".join(words)))
        words[rng.randrange(150)] = "changed"
        data += [(100 + i, " ".join(words))] * times
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = lines.dedup_lines(df).select("doc_id", "n_dropped").collect()
    assert sorted(map(tuple, got)) == sorted((i, int(i >= 100)) for i, _ in data)


def test_dedup_lines_frees_what_it_has_read(spark, monkeypatch):
    """When the result is handed on, only places, lines, components and no texts are left on disk."""
    rng = random.Random(12)
    data = [sentence(rng, 30, 10**6) for _ in range(50)]
    data += [x + " tail" for x in data[:20]]
    made, was = [], lines.saved

    def saved(df):
        made.append(out := was(df))
        return out

    monkeypatch.setattr(lines, "saved", saved)
    _, kept = lines.line_groups(table(spark, data))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def is_there(df):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(df._jdf.inputFiles()[0]))
        return path.getFileSystem(conf).exists(path)

    left = [df.columns for df in made if is_there(df)]
    assert left == [["h", "doc_id", "row", "pos"], ["h", "at", "times"]], left
    assert kept.count() == 40


def near_lines(rng, n, share):
    """Pairs of lines of ``n`` words in which a share of the words, at least one, is replaced."""
    spell = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10)))
    words = [spell() for _ in range(n)]
    other = list(words)
    for i in rng.sample(range(n), max(1, int(n * share))):
        other[i] = spell()
    return " ".join(words), " ".join(other)


@pytest.mark.parametrize(("share", "least"), [(0, 0.97), (0.05, 0.95), (0.1, 0.9), (0.15, 0.8)])
def test_line_dedup_recall(spark, share, least):
    """Of pairs at an edit similarity of 0.8 or more, told by edit distance alone, those linked."""
    rng = random.Random(int(share * 100))
    data, near = [], {}
    for n in (5, 6, 8, 10, 12, 16, 20, 24, 31, 33, 40, 50, 60):
        kept = 0
        while kept < 40:
            x, y = near_lines(rng, n, share)
            if distance(x, y) > int(max(len(x), len(y)) * 0.2 + 1e-9):
                if n * share >= 1 or n > 6:
                    kept += share > 0.12  # too far apart: counts for nothing, but ends
                continue
            near.setdefault(n, []).append(len(data) + 1)
            data += [x, y]
            kept += 1
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(4)
    gone = {r.doc_id for r in lines.dedup_lines(df).collect() if r.n_dropped}
    found = {n: sum(i in gone for i in ids) / len(ids) for n, ids in near.items()}
    assert gone <= {i for ids in near.values() for i in ids}
    assert np.mean([i in gone for ids in near.values() for i in ids]) >= least
    if share == 0:
        assert min(found.values()) >= 0.9, found


def test_line_buckets_stay_small(spark):
    """Lines of two words out of many share no bucket for one common word."""
    rng = random.Random(1)
    df = spark.createDataFrame([(f"the w{rng.randrange(10**6)}",) for _ in range(3000)], "t string")
    keys = df.select(F.explode(lines.block_keys(F.split("t", " "))).alias("key"))
    assert keys.groupBy("key").count().agg(F.max("count")).first()[0] < 5


def test_sketches_rule_out_unlike_lines_only(spark):
    """No pair that shares two fifths of its words is lost; most lines with two words in common are told apart."""
    rng = random.Random(9)
    texts = [" ".join(["of", "the", *(f"v{rng.randrange(3000)}" for _ in range(rng.choice((5, 6, 20, 60))))]) for _ in range(60)]
    texts += [" ".join(rng.sample(t.split(), len(t.split()) // 2)) + f" z{i}" for i, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "h int, norm string").select("h", *lines.sketched(F.split("norm", " ")))
    left, right = (df.select(*(F.col(c).alias(c + side) for c in df.columns)) for side in "ab")
    got = {(r.ha, r.hb) for r in left.crossJoin(right).where("ha < hb").where(lines.may_share("a", "b")).collect()}
    sets = [set(t.split()) for t in texts]
    pairs = [(i, j) for j in range(len(texts)) for i in range(j)]
    alike = {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.4 * min(len(sets[i]), len(sets[j]))}
    assert len(alike) >= 50 and alike <= got
    assert len(got - alike) < 0.1 * len(pairs)


@pytest.mark.parametrize("common", [False, True])
def test_lines_with_few_words_in_common_are_linked(spark, common):
    """Lines that agree in a block are linked by edit distance alone; with ``common``, all lie in one bucket, seldom side by side."""
    rng = random.Random(3)
    spell = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(10))
    pool = spark.createDataFrame([(spell(),) for _ in range(300)], "w string").orderBy(F.xxhash64("w"))
    pool = [r.w for r in pool.collect()]  # words side by side here mostly are a block of a line that has both
    data = []
    for i in range(150):
        kept, others = pool[:2] if common else pool[2 * i : 2 * i + 2], [spell() for _ in range(4)]
        changed = [w[:4] + ("y" if w[4] == "x" else "x") + w[5:] for w in others]
        data += [" ".join(kept + others), " ".join(kept + changed)]
    df = table(spark, data).repartition(4)
    keys = {r.doc_id: set(r["keys"]) for r in df.select("doc_id", lines.block_keys(F.split("text", " ")).alias("keys")).collect()}
    want = {i + 1 for i in range(0, len(data), 2) if keys[i] & keys[i + 1]}
    assert len(want) > 30
    assert all(distance(data[i - 1], data[i]) == 4 for i in want)
    gone = {r.doc_id for r in lines.dedup_lines(df).collect() if r.n_dropped}
    assert gone == want


def test_letters_rule_out_distant_lines_only(spark):
    """No pair within the edits is lost; most lines of other words are told apart, long ones never."""
    rng = random.Random(4)
    spell = lambda: "".join(rng.choice("aabcdeeefghiijklmnnoorsttuéß9") for _ in range(rng.randrange(2, 9)))
    texts = [" ".join(spell() for _ in range(n)) for n in (1, 2, 3, 6, 9, 12, 18) for _ in range(8)]
    texts += [t[: len(t) // 2] + "z" * (len(t) // 9) + t[len(t) // 2 + len(t) // 12 :] for t in texts] + ["a" * 40, "a" * 33, "x" * 127, "x" * 130]
    df = spark.createDataFrame(list(enumerate(texts)), "h int, t string").select("h", F.length("t").alias("len"), lines.lettered(F.col("t")).alias("own"))
    df = df.select("h", "len", "own.*")
    left, right = (df.select(*(F.col(c).alias(c + side) for c in df.columns)) for side in "ab")
    most = F.floor(F.greatest("lena", "lenb") * 0.2 + 1e-9).cast("int")
    got = {(r.ha, r.hb) for r in left.crossJoin(right).where("ha < hb").where(lines.may_be_near("a", "b", most)).collect()}
    pairs = [(i, j) for j in range(len(texts)) for i in range(j) if min(len(texts[i]), len(texts[j])) > 20]
    near = {(i, j) for i, j in pairs if distance(texts[i], texts[j]) <= int(max(len(texts[i]), len(texts[j])) * 0.2 + 1e-9)}
    assert len(near) > 20 and near <= got
    assert len(got & set(pairs) - near) < 0.15 * len(pairs)
    assert df.where("len > 128").where("l0 is not null").count() == 0


def test_line_distances_told_by_words_agree_with_edit_distance(spark):
    """Words replaced in place, and words replaced beside one that is lost, link up to the same distance."""
    rng = random.Random(1)
    spell = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    data, want = [], []
    for change, lost in ((1, 0), (1, 1), (0, 1), (6, 0), (6, 1)):
        words = [spell() for _ in range(20)]
        other = [spell() if k % 3 == 0 and k // 3 < change else w for k, w in enumerate(words)]
        data += [" ".join(words), " ".join(other[:10] + other[10 + lost :])]
        want += [0, int(distance(*data[-2:]) <= len(data[-2]) * 0.2)]
    gone = [r.n_dropped for r in lines.dedup_lines(table(spark, data)).orderBy("doc_id").collect()]
    assert gone == want == [0, 1, 0, 1, 0, 1, 0, 0, 0, 0]


def test_edit_distance_bounds(spark):
    """Bounds by words are never below the edit distance, and near lines are the same with them."""
    rng = random.Random(5)
    data = []
    for n in (1, 3, 12, 40):
        for share in (0, 0.1, 0.2, 0.3, 0.6):
            words = [rng.choice(("the", "of", "wörd", f"w{rng.randrange(10**6)}")) for _ in range(n)]
            other = [w for w in words if rng.random() > share / 2]
            for k in range(int(share * n / 2)):
                other.insert(rng.randrange(len(other) + 1), f"x{k}")
            data.append((" ".join(words), " ".join(other) or "x"))
    split = F.struct(F.split("x", " ").alias("x"), F.split("y", " ").alias("y"))
    bound = lambda most, compared: lines._let(split, lambda w: lines._aligned(w["x"], w["y"], most, compared))
    df = spark.createDataFrame(data, "x string, y string").withColumn("most", F.floor(F.greatest(F.length("x"), F.length("y")) * 0.2).cast("int"))
    got = df.select("*", *(bound(F.lit(10**6), c).alias(f"c{int(c)}") for c in (False, True)), bound(F.col("most"), True).alias("cut"), lines._within(F.col("x"), F.col("y"), F.col("most")).alias("near"))
    seen = set()
    for r in got.collect():
        d = distance(r.x, r.y)
        assert d <= r.c1 <= r.c0 and r.near == (d <= r.most) and (r.cut > r.most or d <= r.cut), r
        seen.add((r.near, r.c1 <= r.most))
    assert {(True, True), (False, False)} <= seen


def test_keyed_blocks_are_block_keys(spark):
    """A row per block has the keys that a line's array has."""
    rng = random.Random(8)
    data = [(i, sentence(rng, n, 300) + " a b cd" * (i % 2)) for i, n in enumerate([1, 2, 3, 6, 7, 8, 9, 15, 16, 17, 31, 33, 60, 300] * 2)]
    df = spark.createDataFrame(data, "h long, norm string")
    rows = {(r.h, r.len, r.key) for r in lines.keyed_blocks(df).collect()}
    arrays = df.select("h", F.length("norm"), F.explode(lines.block_keys(F.split("norm", " ")))).collect()
    assert rows == set(map(tuple, arrays)) and len(rows) == len(arrays)


def test_saved_leaves_no_shuffle_files(spark):
    """What a table was shuffled for goes with the write, not with the driver's garbage."""
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    df = spark.range(1000).repartition(4, "id")
    before = files()
    out = common.saved(df.groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and out.count() == 7
    assert spark.conf.get(common.CLEANUP) == "false"


@pytest.mark.parametrize("n", range(1, 8))
def test_simhash_is_the_majority_of_bits(spark, n):
    rng = random.Random(n)
    hashes = [rng.randrange(-(2**63), 2**63) for _ in range(n)]
    df = spark.createDataFrame([(hashes,)], "x array<long>")
    sim = df.select(lines.simhash(F.col("x"), F.size("x")).alias("sim")).first().sim
    assert sim % 2**64 == sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in hashes) > n)


def test_line_blocks_against_plain_python(spark):
    """Blocks are the words that follow the eight places of the ring, in both sizes near an edge."""
    rng = random.Random(6)
    texts = [sentence(rng, n, 10**6) for n in (1, 2, 3, 7, 8, 9, 14, 15, 16, 17, 30, 31, 33, 40, 200)]
    texts += [f"{t} a b cd" for t in texts] + ["a b c d e f g h i j k"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hashed = {r.w: r.h for r in df.select(F.explode(F.split("t", " ")).alias("w")).select("w", F.xxhash64("w").alias("h")).collect()}
    got = {r.t: r["keys"] for r in df.select("t", lines.block_keys(F.split("t", " ")).alias("keys")).collect()}
    for t in texts:
        every = set(t.split())
        n, edge = len(every), -(-len(every) // 16)
        ends = [b for b, _ in lines.BLOCKS[1:]] + [10**9]
        blocks = set()
        for (low, m), end in zip(lines.BLOCKS, ends):
            if n + edge >= low and n - edge < end:
                long = {w for w in every if len(w) > 3}
                ring = sorted(hashed[w] for w in (long if m > 2 and len(long) >= 3 else every))
                places = [sum(x < -(2**63) + (k << 61) for x in ring) % len(ring) for k in range(8)]
                blocks |= {(m, frozenset((ring * 8)[p:][: min(m, len(ring))])) for p in places}
        assert len(got[t]) == len(set(got[t])) == len(blocks)


def test_language_on_held_out_texts(spark):
    rng = random.Random(2)
    parts = {"xx": ["ba", "lo", "mi", "tu"], "yy": ["sch", "ung", "keit", "ver"], "zz": ["ção", "ñe", "ll", "qui"]}

    def text(lang, n):
        return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))

    rows = [(i, text(lang, rng.randrange(8, 200)), lang) for i, lang in enumerate(rng.choices(list(parts), k=150))]
    train = spark.createDataFrame(rows[:100] + [(900, None, "xx"), (901, "text", None), (902, "123", "yy")], "doc_id long, text string, lang string")
    model = train_dictionaries(train)
    assert sorted(model) == ["xx", "yy", "zz"]
    other = [(500, None, None), (501, "", None), (502, "12 + 3", None), (503, text("yy", 200_000), "yy")]
    test = spark.createDataFrame(rows[100:] + other, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in predict_language(test, model).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows[100:]) >= 48
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in (500, 501, 502)] == [("und", 0.0, True)] * 3
    assert got[503].lang_pred == "yy" and not got[503].rejected
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in predict_language(test, {}).collect()} == {"und"}
    assert train_dictionaries(train.limit(0)) == {}


def test_shards(spark, docs, texts):
    got = shards.shard_rows(docs, 7).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert sorted(len(x) for x in by.values())[0] >= len(texts) // 7
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert r.size == len(data) + 8 and r.law == "rows" and r.grown_shard is None
        assert r.text_crc32 == (None if texts[r.doc_id] is None else zlib.crc32(data))
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, shards.shard_rows(docs, 7).collect()), key=str)
    assert shards.shard_rows(empty(docs), 7).collect() == []


def test_shards_follow_the_ring_with_limited_movement(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    before = {r.doc_id: r.shard for r in shards.shard_rows(docs, 24).collect()}
    after = {r.doc_id: r.shard for r in shards.shard_rows(docs.where("doc_id % 20 != 1"), 24).collect()}
    assert sum(before[i] != s for i, s in after.items()) < 0.2 * len(after)
    grown = {r.doc_id: r.shard for r in shards.shard_rows(docs, 25).collect()}
    assert sum(before[i] != s for i, s in grown.items()) < 0.3 * len(grown)


def test_shards_of_one_hot_id(spark):
    docs = spark.range(300).select(F.when(F.col("id") < 200, 5).otherwise(F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    counts = Counter(r.shard for r in shards.shard_rows(docs, 4).collect())
    assert sorted(counts.values()) == [75] * 4


def test_targets_fill_up():
    sizes = {"b": 100, "a": 10, None: 0, "c": 1000}
    got = mixing.target_words(sizes)
    assert got["a"] == 20 and got["b"] == 200 and got[None] == 0
    assert got["c"] == pytest.approx(1.5 * 1110 - 220)
    assert mixing.target_words({"a": 10, "b": 10}) == pytest.approx({"a": 18, "b": 12}) or mixing.target_words({"a": 10, "b": 10}) == {"a": 20.0, "b": 10.0}
    assert mixing.target_words({}) == {}


def test_route_is_cheapest():
    patterns = {("a",): 10, ("b",): 10, ("a", "b"): 20}
    got = mixing.route(patterns, {"a": 25, "b": 25}, 2)
    assert sum(got.values()) == 50
    # 40 words are free, ten are repetitions
    assert sum(max(0, n - patterns[p]) for p, n in got.items()) == 10
    assert mixing.route({("a",): 5}, {"a": 100}, 2) == {("a",): 10}
    assert mixing.route({("a", "b"): 10, ("b",): 10}, {"a": 10, "b": 10}, 2) == {("a", "b"): 10, ("b",): 10}


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, rng.randrange(1, 40)), rng.choice(["s1", "s2", "s3", None] + ["hot"] * 4)) for i in range(600)]
    rows += [(700, None, "s1"), (701, "", "s2"), (702, " ", "empty"), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(1) for c in ("u", "tie", "pattern", "size", "taken", "low", "part")})
    mix, words, targets = mixing.mix_sources(df, carry=True)
    got = mix.collect()
    size = {i: len((t or "").split()) for i, t, _ in rows}
    total = Counter()
    for r in got:
        assert r["size"] == size[r.doc_id] and r.taken in {k * r["size"] for k in (0, 1, 2)}
        assert r["row"].u == 1 and r["row"].doc_id == r.doc_id
        total[r.sources[0]] += r.taken
    assert len(got) == len(rows)
    want = mixing.target_words({s: sum(size[i] for i, _, x in rows if x == s) for s in {x for _, _, x in rows}})
    assert targets == pytest.approx(want)
    for s, t in targets.items():
        assert abs(total[s] - t) <= max(3, 0.02 * t)
    again = mixing.mix_sources(df.repartition(5))[0].collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)
    assert mixing.mix_sources(df.limit(0))[0].collect() == []


def test_mixing_of_overlapping_sources(spark):
    rows = [(i, "a b c d", s) for i, s in enumerate([["x"], ["x", "y"], ["y", "x"], ["y"], [], None] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    mix, words, targets = mixing.mix_sources(df)
    assert words == {"x": 240, "y": 240, None: 160}
    taken = Counter()
    for r in mix.collect():
        assert r.taken in (0, 4, 8)
        taken[tuple(r.sources)] += r.taken
    assert abs(sum(taken.values()) - sum(min(t, 2 * words[s]) for s, t in targets.items())) <= 12


SAMPLES = [
    None, "", " ", "a", "Hello world", "  two  blanks ", "tab\tand\n\nlines ", "naïve 日本語 🙂 x", "aaaaaaaaaaaaaaaaaaaa",
    "<s> </s> <unk> <0x0A>", "http://www.example.com/a?b=c&d=1234567890", "ÀÉÎ ñandú größer", "." * 300, "end ", "\u0000\u0001",
]


def test_encoding_equals_the_model(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(8)
    letters = "etaoinshrdlu ETA.,;-'éß日\n"
    texts = SAMPLES + ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(150)]
    df = table(spark, texts)
    table_of = pieces.load_pieces(PIECES)
    out = df.withColumn("ids", pieces.encoded(table_of, df, F.col("text")))
    out = out.withColumn("back", pieces.decoded(table_of, df, F.col("ids")))
    for r in out.collect():
        t = texts[r.doc_id]
        assert r.ids == (None if t is None else model.encode(t))
        assert r.back == t
    assert out.where("doc_id < 0").collect() == []


def test_encoding_of_a_long_text_and_decoding_of_any_ids(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(9)
    long = sentence(rng, 300_000, 1000)
    table_of = pieces.load_pieces(PIECES)
    df = spark.createDataFrame([(1, long, [3, 40000, -5, None, 0, 1, 400, 258])], "doc_id long, text string, odd array<int>")
    got = df.select(pieces.encoded(table_of, df, F.col("text")).alias("ids"), pieces.decoded(table_of, df, F.col("odd")).alias("odd")).first()
    assert got.ids == model.encode(long)
    assert got.odd.startswith("\x00") and got.odd.endswith("�")


def test_greedy_counts(spark):
    table_of = pieces.load_pieces(PIECES)
    automaton = wordpieces.greedy_pieces(table_of)
    raw = table_of.raw.tobytes()
    vocabulary = {raw[s : s + n] for s, n in zip(table_of.raw_start.tolist(), table_of.raw_size.tolist()) if n}

    def greedy(word):
        n = i = 0
        while i < len(word):
            i += next((k for k in range(min(48, len(word) - i), 0, -1) if word[i : i + k] in vocabulary), 1)
            n += 1
        return n

    rng = random.Random(6)
    texts = SAMPLES + ["".join(rng.choice("etaoin shrdé日.\n") for _ in range(200)) for _ in range(50)] + ["word " * 400_000]
    df = table(spark, texts)
    for r in df.select("doc_id", wordpieces.token_counts(automaton, df, F.col("text")).alias("c")).collect():
        words = (texts[r.doc_id] or "").encode().split()
        if len(words) < 1000:
            assert (r.c.n_words, r.c.n_tokens) == (len(words), sum(greedy(b" " + w) for w in words))
        else:
            assert (r.c.n_words, r.c.n_tokens) == (400_000, 400_000 * greedy(b" word"))


def test_automaton_against_matching():
    rng = random.Random(11)
    vocabulary = {bytes(rng.choices(b"ab", k=rng.randrange(1, 7))) for _ in range(25)}
    automaton = wordpieces.Automaton(sorted(vocabulary))
    words = [bytes(rng.choices(b"abc", k=rng.randrange(0, 20))) for _ in range(2000)]

    def greedy(word):
        n = i = 0
        while i < len(word):
            i += next((k for k in range(6, 0, -1) if word[i : i + k] in vocabulary and i + k <= len(word)), 1)
            n += 1
        return n

    assert automaton.counts(words).tolist() == [greedy(w) for w in words]


def test_language_model(spark):
    rng = random.Random(12)
    lines_ = [sentence(rng, 15, 200) for _ in range(40)]
    texts = [" ".join(rng.choice(lines_) for _ in range(6)) + " " + sentence(rng, 10, 3000) for _ in range(300)]
    texts += [None, "", "  ", texts[0].upper(), "unseen words only", sentence(rng, 50_000, 400)]
    df = table(spark, texts)
    got = {r.doc_id: r for r in lm.score_texts(df, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2).collect()}
    tokens = {i: WORDS.findall((t or "").encode().lower()) + ["end"] for i, t in enumerate(texts)}
    held = {i for i in tokens if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter(w for i, ws in tokens.items() if i not in held for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        assert np.isfinite(r.score) and r.score < 0
    own = [i for i in held if len(tokens[i]) > 5]
    assert sum(got[i].score for i in own) > 0.8 * sum(got[i].base_score for i in own)


def test_language_model_without_training(spark):
    df = spark.createDataFrame([(1, "a b"), (None, None), (1, "a b")], "doc_id long, text string")
    got = sorted((tuple(r) for r in lm.score_texts(df, F.lit(False)).collect()), key=str)
    assert [r[2:5] for r in got] == [(3, 0, 0), (3, 0, 0), (1, 0, 0)]
    assert all(r[5] == 0 and np.isfinite(r[6]) for r in got)
    assert lm.score_texts(df.limit(0), F.lit(True)).collect() == []


def test_spelling_tree_is_a_distribution():
    """Chances of all symbols sum to one in every state."""
    levels = [
        (np.zeros(3, np.int64), np.array([97, 98, 32]), np.array([50, 30, 20])),
        (np.array([97, 97, 98, 32]), np.array([98, 32, 97, 97]), np.array([30, 10, 30, 30])),
    ]
    tree = lm.SuffixTree(levels)
    share = np.ones(tree.log.shape[1])
    share[-1] = lm.SYMBOLS - (len(share) - 1)
    assert (10.0 ** tree.log.astype(float) * share).sum(axis=1) == pytest.approx(1, abs=1e-5)
    assert tree.score([b"ab", b"zz"])[0] > tree.score([b"ab", b"zz"])[1]


def test_mixing_goes_on_after_a_document_that_does_not_fit(spark):
    """A document of half the words: the others still fill the target."""
    rows = [(i, "w " * 10, "s") for i in range(100)] + [(100, "w " * 1000, "s")]
    rows += [(200 + i, "w " * n, "t") for i, n in enumerate([7] * 60 + [3, 2, 1, 400, 150, 80])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    size = {i: len(t.split()) for i, t, _ in rows}
    for seed in range(4):
        mix, _, targets = mixing.mix_sources(df, seed=seed, weights=(1,), share=1.5)
        got = mix.collect()
        assert all(r.taken in (size[r.doc_id], 2 * size[r.doc_id]) for r in got)
        for s, target in targets.items():
            gap = round(target) - sum(r.taken for r in got if r.sources[0] == s)
            left = [r["size"] for r in got if r.sources[0] == s and r.taken == r["size"]]
            assert 0 <= gap < min(left, default=gap + 1)


def test_line_dedup_of_unicode_punctuation(spark):
    """Quotes, dashes, ellipses, guillemets, bullets and no-break spaces part words as blanks do; alone they are no line."""
    same = ["she said yes and left", "“She said: yes” – and left…", "«she said» yes — and left", "• She said yes – and left。"]
    marks = ["———", "• •", "…"]
    df = spark.createDataFrame([(i, "\n".join([x, *marks])) for i, x in enumerate(same)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(df).collect()}
    assert got == {i: "\n".join([same[0], *marks] if i == 0 else marks) for i in range(len(same))}


def test_language_model_does_not_depend_on_partitions(spark):
    """Phrases that occur once in each of many tasks count as they do in one task."""
    rng = random.Random(21)
    phrases = ["alpha beta gamma", "delta beta epsilon"]
    data = [(i, f"{sentence(rng, 6, 3000)} {phrases[i % 2]} {sentence(rng, 6, 3000)}") for i in range(64)]
    scores = []
    for n in (1, 64):
        df = spark.createDataFrame(spark.sparkContext.parallelize(data, n), "doc_id long, text string")
        scores.append({r.doc_id: r.score for r in lm.score_texts(df, F.col("doc_id") % 7 != 2).collect()})
    assert scores[0] == pytest.approx(scores[1], abs=1e-6)


def test_language_model_frees_what_it_has_read(spark, monkeypatch):
    """When the scores are handed on, only what they are added up from is left on disk, and no two lengths were there at once."""
    rng = random.Random(3)
    df = table(spark, [sentence(rng, 30, 40) for _ in range(60)])
    made, was, most = [], lm.saved, []
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def is_there(x):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(x._jdf.inputFiles()[0]))
        return path.getFileSystem(conf).exists(path)

    def saved(x):
        made.append(out := was(x))
        most.append(sum("g" in y.columns and is_there(y) for y in made))
        return out

    monkeypatch.setattr(lm, "saved", saved)
    out = lm.score_texts(df, F.col("doc_id") % 7 != 2)
    assert [x.columns[0] for x in made if is_there(x)] == ["doc_id", "row", "row"]
    assert max(most) == 2 and most.count(2) == 2 * lm.WORDS + lm.WORDS  # a table and the one made of it
    assert out.count() == 60


def test_language_model_against_plain_python(spark, monkeypatch):
    """All states and next words count, also when tasks know only the ten hottest."""
    monkeypatch.setattr(lm, "OFTEN", 10)
    monkeypatch.setattr(lm, "HOT", 10)
    rng = random.Random(31)
    phrases = [sentence(rng, 5, 30) for _ in range(30)]
    texts = [" ".join(rng.choice(phrases) for _ in range(4)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.score_texts(df, F.col("doc_id") % 7 != 2).collect()}
    words = {i: [*t.split(), "\n"] for i, t in enumerate(texts)}
    learned = [w for i, w in words.items() if i % 7 != 2]
    counts = Counter(w for ws in learned for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    spelled = lm.grow(spark.createDataFrame([(w.encode(), n) for w, n in counts.items() if w != "\n"], "word binary, n long"), len(learned))
    spelling = lambda w: 10.0 ** (spelled.end if w == "\n" else spelled.score([w.encode()])[0])
    root = {w: (n + kinds * spelling(w)) / (total + kinds) for w, n in counts.items()}
    after = defaultdict(Counter)
    for ws in learned:
        for i, w in enumerate(ws):
            for d in range(1, min(i, lm.WORDS) + 1):
                after[tuple(ws[i - d : i])][w] += 1
    states = set()

    def chance(context, w):
        if not context:
            return root[w]
        base = chance(context[1:], w)
        if context not in states:
            return base
        n = after[context]
        return (n[w] + len(n) * base) / (n.total() + len(n))

    for context in sorted(after, key=len):
        n = after[context]
        if n.total() >= lm.LEAST:
            base = {w: chance(context[1:], w) for w in n}
            gain = sum(n[w] * np.log((n[w] + len(n) * base[w]) / (n.total() + len(n)) / base[w]) for w in n)
            if gain > len(n) / 2 * np.log(total):
                states.add(context)
    assert {len(c) for c in states} >= {1, 2}
    want = {i: sum(log10(chance(tuple(ws[max(0, k - lm.WORDS) : k]), w)) for k, w in enumerate(ws)) for i, ws in words.items()}
    assert got == pytest.approx(want, abs=1e-4)
