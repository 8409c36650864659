"""The queries of these operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tallyward.llm.divergence import source_divergence
from tallyward.llm.jaccard import ngram_jaccard
from tallyward.llm.langid import predict_language, train_dictionaries
from tallyward.llm.lines import dedup_lines
from tallyward.llm.lm import score_texts
from tallyward.llm.mixing import mix_sources
from tallyward.llm.packing import bucketed, cut_documents
from tallyward.llm.pieces import decoded, encoded, load_pieces
from tallyward.llm.shards import shard_rows
from tallyward.llm.spelling import counted, runs, spelling_groups, without_point
from tallyward.llm.vectors import near_duplicates, nearest
from tallyward.llm.wordpieces import greedy_pieces, token_counts

#: The public tokenizer files that the queries read.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
WORDS = "/opt/tokenizers/word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, by: int):
    """crc32 of the id as text, modulo ``by``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(by))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated lines: how many went, and what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs)
    left = F.octet_length("text").cast("long")
    return out.select("doc_id", "n_lines", "n_dropped", left.alias("n_bytes"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = train_dictionaries(docs.where(~held_out))
    out = predict_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by shingles of five words at a similarity of 0.75."""
    return ngram_jaccard(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards."""
    return shard_rows(table(spark, sf_dir, "documents"), 24)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = load_pieces(PIECES)
    out = docs.withColumn("ids", encoded(pieces, docs, F.col("text")))
    out = out.withColumn("back", decoded(pieces, docs, F.col("ids")))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), F.col("back").eqNullSafe(F.col("text")).alias("round_trip"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of all documents, learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, remainder("doc_id", 7) != 2)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word pieces of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = docs.withColumn("c", token_counts(greedy_pieces(load_pieces(PIECES)), docs, F.col("text")))
    return counted.select("doc_id", "c.n_words", "c.n_tokens")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors at a cosine of 0.9."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the targets of their sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mix, words, targets = mix_sources(docs)
    wanted = spark.createDataFrame([(s, words[s], float(targets[s])) for s in words], "source string, source_size long, target double")
    mix = mix.withColumn("source", F.get("sources", 0)).join(wanted.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector among all."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("vec_id") % 100 == 0)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into sequences of up to 2048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = cut_documents(docs, WORDS).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return bucketed(pieces)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, one run in 97 with a letter lost, by near words."""
    docs = table(spark, sf_dir, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    found = runs(docs, "A-Za-z\u00C0-\u00FF", least_points=5).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    lost = without_point(F.col("run"), F.pmod(F.col("h"), F.length("run")).cast("int"))
    out = spelling_groups(counted(found.select(F.when(F.col("h") % 97 == 0, lost).otherwise(F.col("run")).alias("word"))))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: each source of a language against the others, and against the language."""
    return source_divergence(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_language_id": op2_language_id,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_sharding": op4_sharding,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_token_counts": op7_token_counts,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_mixing": op9_mixing,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_packing": op11_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": pipeline,
}

#: SQL of the queries that SQL can express; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op3_ngram_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(
             generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
rows AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM rows a JOIN rows b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other)
SELECT s.doc_id, CAST(coalesce(len(s.s), 0) AS BIGINT) AS n_shingles,
       coalesce(min(r.other), s.doc_id) AS component_id
FROM sets s LEFT JOIN reach r USING (doc_id) GROUP BY s.doc_id, s.s""",
    "op8_embedding_near_dedup": """
WITH RECURSIVE rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
usable AS (
  SELECT vec_id, v FROM rows
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT a AS vec_id, a AS other FROM links
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id = coalesce(component_id, vec_id) AS kept
FROM rows LEFT JOIN counts USING (vec_id) LEFT JOIN least USING (vec_id)""",
    "op12_spelling_variants": r"""
WITH RECURSIVE crc(i, k, x) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM crc WHERE k < 8),
lookup AS MATERIALIZED (SELECT list(x ORDER BY i) AS t FROM crc WHERE k = 8),
low AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM low),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, n, regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..') AS b
  FROM counted),
marked AS (
  SELECT run, n, xor(list_reduce(list_transform(b, lambda y: CAST('0x' || y AS BIGINT)),
           lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM bytes, lookup),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, n FROM marked)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(generate_series(0, length(word) - 1)) AS i FROM words),
less AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM places),
links AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, n, count(*) AS n_near, min(struct_pack(r := -other_n, f := encode(other))) AS best
  FROM links GROUP BY word, n),
forms AS (
  SELECT word, CASE WHEN -best.r >= 2 * n THEN decode(best.f) END AS form,
         CASE WHEN -best.r >= 2 * n THEN CAST(-best.r AS BIGINT) END AS form_n, n_near FROM best),
chain AS (
  SELECT word, word AS here, 0 AS k FROM words
  UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN forms f ON f.word = c.here WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, k) AS root FROM chain GROUP BY word)
SELECT w.word, f.form, r.root, w.n, CAST(coalesce(f.n_near, 0) AS BIGINT) AS n_near, f.form_n
FROM words w JOIN roots r USING (word) LEFT JOIN forms f USING (word)""",
    "op13_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
found AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
all_groups AS (
  SELECT DISTINCT d.lang, d.source, coalesce(t.total, 0) AS total
  FROM docs d LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) t
  ON t.lang = d.lang AND t.source = d.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v) AS HUGEINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS HUGEINT) AS q
  FROM all_groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM all_groups a JOIN all_groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank
FROM found_parts
QUALIFY part = 'pair' OR rank <= 10""",
}
