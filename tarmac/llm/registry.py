"""Queries of this package: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    bpe, hashing, licenses, merkle, minhash, mixing, parsing, quality, repeats, sitetree, suffixtree, toxicity, transducer,
)
from tarmac.llm.common import id_fold, read_table, ship

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(function):
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@_query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")), "doc_id")


@_query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: 4-word shingles, similarity 0.8."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, percent=80)


ORACLE["op2_minhash"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 3], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a third of the labels is held out."""
    docs, held = read_table(spark, sf_dir, "documents"), id_fold("doc_id", 3) == 1
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels").filter(~held))
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


@_query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a fifth of the labels is held out."""
    docs, held = read_table(spark, sf_dir, "documents"), id_fold("doc_id", 5) == 0
    model = quality.fit(docs, read_table(spark, sf_dir, "labels").filter(~held))
    return quality.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


@_query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken when no source repeats more than 1.5 times."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sources = mixing.plan(docs, max_repetition=1.5)
    return mixing.decide(docs, sources).select(
        "row.doc_id", "row.source", mixing.n_tokens("row.text").alias("n_tokens"), "weight", "repetition", "block",
        "copies")


@_query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return licenses.summary(licenses.scan(read_table(spark, sf_dir, "documents")))


@_query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return parsing.edited_fingerprints(read_table(spark, sf_dir, "documents"))


@_query
def op8_suffixtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document; a seventh of the documents is held out."""
    docs, held = read_table(spark, sf_dir, "documents"), id_fold("doc_id", 7) == 2
    model, vocabulary = suffixtree.fit(docs.filter(~held))
    return suffixtree.score(docs, model, vocabulary).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op4_sitetree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return sitetree.extract(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@_query
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    return hashing.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@_query
def op11_filteraudit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of five filters over the documents of each source."""
    return transducer.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query
def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that documents with smaller ids hold."""
    return repeats.summary(read_table(spark, sf_dir, "documents"))


@_query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and inclusion proofs of the documents, checked against tampered leaves."""
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0,
                      F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.summary(docs, ["doc_id", "source", "lang", "n_chars", "text"], {"text": tampered})


ORACLE["op11_filteraudit"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
earliest AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, good, toxic, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first, false) AS INT) AS mask
  FROM w JOIN earliest USING (t) LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM failed GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS bit,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i, 1)) - 65))), 0)::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
done AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT * EXCLUDE (bit), CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM done
"""

ORACLE["op12_repeats"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT doc_id, first, substr(h, 2 * first + 1, 2098) AS s
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49, 1000)) AS first FROM d)),
windows AS (SELECT doc_id, first + i AS i, md5(substr(s, 2 * i + 1, 100)) AS k
  FROM (SELECT doc_id, first, s, unnest(range(0, len(s) // 2 - 49)) AS i FROM blocks)),
owners AS (SELECT k, min(doc_id) AS owner FROM windows GROUP BY k),
gone AS (SELECT doc_id, i FROM windows JOIN owners USING (k) WHERE owner < doc_id),
runs AS (
  SELECT *, sum(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM gone)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b, b - a AS n FROM spans
  UNION ALL SELECT doc_id, coalesce(max(b), 0), any_value(len(h)) // 2, 0 FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id)
SELECT doc_id, any_value(len(h)) // 2 AS n_bytes, CAST(sum(n) AS BIGINT) AS n_removed, count(*) - 1 AS n_spans,
  sha256(unhex(string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a))) AS kept_sha256
FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
"""

ORACLE["op13_merkle"] = r"""
WITH RECURSIVE rows AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 2 = 0 AS tampered,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    sha256(head || CASE WHEN text IS NULL THEN '-' WHEN tampered
      THEN strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')
      ELSE strlen(text) || ':' || text END) AS changed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY source) AS n
  FROM rows),
tree(source, level, place, node, n) AS (
  SELECT source, 0, place, leaf, n FROM leaves
  UNION ALL SELECT source, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM tree WHERE n > 1 GROUP BY source, level, place // 3),
subroots AS (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY source IS NOT NULL, source) - 1 AS place,
    count(*) OVER () AS n FROM tree WHERE n = 1),
top(level, place, node, n) AS (
  SELECT 0, place, subroot, n FROM subroots
  UNION ALL SELECT level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM top WHERE n > 1 GROUP BY level, place // 3),
steps AS (
  SELECT l.doc_id, t.level, string_agg(t.node, '' ORDER BY t.place) FILTER (t.place < l.place // (3 ** t.level)::BIGINT) AS a,
    string_agg(t.node, '' ORDER BY t.place) FILTER (t.place > l.place // (3 ** t.level)::BIGINT) AS b
  FROM leaves l JOIN tree t ON t.source IS NOT DISTINCT FROM l.source AND t.n > 1
    AND t.place // 3 = (l.place // (3 ** t.level)::BIGINT) // 3 GROUP BY ALL
  UNION ALL
  SELECT l.doc_id, 1000 + t.level, string_agg(t.node, '' ORDER BY t.place) FILTER (t.place < s.place // (3 ** t.level)::BIGINT),
    string_agg(t.node, '' ORDER BY t.place) FILTER (t.place > s.place // (3 ** t.level)::BIGINT)
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN top t ON t.n > 1
    AND t.place // 3 = (s.place // (3 ** t.level)::BIGINT) // 3 GROUP BY ALL),
proofs AS (
  SELECT doc_id, array_agg({'a': coalesce(a, ''), 'b': coalesce(b, '')} ORDER BY level) AS steps FROM steps GROUP BY doc_id),
folded AS (
  SELECT l.doc_id, leaf, subroot, (SELECT node FROM top WHERE n = 1) AS root,
    sha256(coalesce(array_to_string(list_transform(steps, lambda s: s.a || s.b), ''), '')) AS proof_sha256,
    list_reduce(list_prepend({'a': changed, 'b': ''}, coalesce(steps, [])),
      lambda x, s: {'a': sha256(s.a || x.a || s.b), 'b': ''}).a AS folded_root
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source LEFT JOIN proofs USING (doc_id))
SELECT *, folded_root = root AS verified FROM folded
"""
