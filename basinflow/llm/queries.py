"""Registered queries of this subpackage, with SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.llm import (
    alignment, bpe, chat, decontamination, exact, minhash, mixing, quality, ranked, substring, toxicity, vectors, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary() -> str:
    """The file of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_vocabulary() -> str:
    """The file of the public sentencepiece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def held_out(id_col: str = "doc_id"):
    """Rows that labels are never learned from; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


@query(r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM w WHERE len(ws) >= 13)),
m AS (SELECT doc_id, p, doc_id > min(doc_id) OVER (PARTITION BY g) AS hit FROM g),
c AS (SELECT DISTINCT doc_id, p + i AS p FROM (SELECT doc_id, p FROM m WHERE hit), (SELECT unnest(range(13)) AS i)),
k AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM c GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(
    list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(coalesce(ps, []), i)), lambda i: ws[i]), ' '))
    AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
""")
def op1_substring(spark, sf):
    """Every document with the words that repeat a passage of an earlier document counted and removed."""
    docs = table(spark, sf, "documents")
    left = substring.left_of_texts(docs)
    left = left.select("key", "least", "gone", F.sha2("left", 256).alias("left"))
    return substring.per_document(docs, left).select(
        "doc_id", "n_words", "n_removed",
        F.when(F.col("n_removed") == 0, F.col("digest")).when(F.col("n_removed") == F.col("n_words"), F.sha2(F.lit(""), 256))
        .otherwise(F.col("left")).alias("kept_sha256"),
    )


@query()
def op2_bpe(spark, sf):
    """Digests of every document's token ids and of the text they decode to."""
    path = vocabulary()
    tokens = bpe.encode(table(spark, sf, "documents"), path).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
    )
    texts = bpe.decode(tokens, path, keep=("n_tokens", "ids_sha256"))
    return texts.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


@query(rf"""
WITH t AS (
  SELECT conv_id, list({{'r': role, 'x': text}} ORDER BY turn, role, text) AS turns, count(*) AS n_turns,
         string_agg('{chat.OPEN}' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '')
                    || '{chat.CLOSE}' || chr(10), '' ORDER BY turn, role, text) AS text
  FROM conversations GROUP BY conv_id),
k AS (SELECT turns, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM t GROUP BY turns, n_turns),
p AS (SELECT DISTINCT turns[1:i] AS turns
      FROM (SELECT turns, unnest(range(1, n_turns)) AS i FROM t))
SELECT k.conv_id, 0::BIGINT AS part, k.n_turns, k.n_copies, t.text
FROM k JOIN t USING (conv_id) ANTI JOIN p ON k.turns = p.turns
""")
def op4_chat(spark, sf):
    """Maximal conversations as training text."""
    return chat.render(table(spark, sf, "conversations"))


@query()
def op5_toxicity(spark, sf):
    """Every document's toxicity."""
    docs = table(spark, sf, "documents")
    model = toxicity.learn(docs, table(spark, sf, "labels"), ~held_out())
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
  FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x AS a JOIN x AS b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT doc_id AS id, doc_id AS c FROM s UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id AND r.c < e.b),
c AS (SELECT id, min(c) AS component_id FROM r GROUP BY id)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c ON c.id = s.doc_id
""")
def op6_minhash(spark, sf):
    """Every document's group of near copies, on sets of four-word shingles."""
    return minhash.groups(table(spark, sf, "documents"), minhash.Settings(shingle=4))


_HASH = "('0x' || substr(md5({0}), 1, 15))::BIGINT"


@query(rf"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         {_HASH.format("'7|' || coalesce(doc_id::VARCHAR, '~')")} AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM s),
r AS (SELECT *, ((sid - 1) % 3 + 1)::BIGINT AS weight, source_size * 3 AS most FROM w),
o AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(most) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
         sum(weight) OVER ()
           - coalesce(sum(weight) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM r WINDOW q AS (ORDER BY most / weight, sid)),
f AS (SELECT *, most * rest > weight * (total - gone) AS fits FROM o),
l AS (SELECT (total - gone)::BIGINT AS lft, rest::BIGINT AS lw FROM f WHERE fits
      ORDER BY most / weight, sid LIMIT 1),
t AS (SELECT f.source, f.sid, f.n_docs, f.source_size,
             CASE WHEN fits THEN (weight::DOUBLE * lft::DOUBLE) / lw ELSE most::DOUBLE END AS target
      FROM f LEFT JOIN l ON true),
b AS (
  SELECT d.*, t.sid, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         h % greatest(1, ceil(n_docs / greatest(256.0, ceil(sqrt(n_docs::DOUBLE)))))::BIGINT AS bucket
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY bucket, size, h, doc_id NULLS FIRST) AS k,
             {_HASH.format("'7|offset|' || coalesce(source, '~')")} / 1152921504606846976.0::DOUBLE AS u
      FROM b)
SELECT doc_id, size, source_size, target,
       (least(floor(k * rate + u) - floor((k - 1) * rate + u), 3) * size)::BIGINT AS taken, source
FROM n
""")
def op7_mixing(spark, sf):
    """All documents with their source's target and the words the mix takes of them."""
    return mixing.plan(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "source",
    )


@query(r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
""")
def op8_exact(spark, sf):
    """Every document with the one that stays of its group of equal texts."""
    return exact.mark(table(spark, sf, "documents"))


@query()
def op10_quality(spark, sf):
    """Every document's quality."""
    docs = table(spark, sf, "documents")
    model = quality.learn(docs, table(spark, sf, "labels"), ~held_out())
    return quality.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query(r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         coalesce(html, '') AS x FROM pages),
q AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY x) END AS k FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN k IS NULL OR k = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k <> page_id THEN k END AS refers_to
FROM q
""")
def op9_warc(spark, sf):
    """Every page after a way through ARC and WARC archives."""
    return warc.page_records(table(spark, sf, "pages")).select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )


@query(r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(embedding, lambda x: x::DOUBLE * x)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
      ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION
      SELECT e.b, r.c FROM r JOIN e ON e.a = r.id AND r.c < e.b),
c AS (SELECT id, min(c) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT c.id AS vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, c.id = component_id AS kept
FROM c LEFT JOIN n ON n.a = c.id
""")
def op3_vectors(spark, sf):
    """Every vector with the number of its near copies and the group they make."""
    return vectors.near_duplicates(table(spark, sf, "embeddings"))


_TERMS = r"""regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(rf"""
WITH d AS (SELECT doc_id, {_TERMS.format("text")} AS ws FROM documents),
b AS (SELECT item_id, {_TERMS.format("text")} AS ws FROM benchmark),
i AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[p:p + 9], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS p FROM b WHERE len(ws) > 0)),
l AS (SELECT DISTINCT k FROM i),
g AS (
  SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM d JOIN l ON len(ws) >= k)),
m AS (SELECT DISTINCT doc_id, g.k, p, item_id FROM g JOIN i ON g.k = i.k AND g.g = i.g),
c AS (SELECT doc_id, count(DISTINCT p + o) AS n
      FROM (SELECT doc_id, p, unnest(range(k)) AS o FROM m) GROUP BY doc_id),
s AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit,
  len(coalesce(items, []))::BIGINT AS n_items,
  sha256(array_to_string(list_sort(coalesce(items, [])), ',')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id
""")
def op11_decontamination(spark, sf):
    """Every document with the words it shares with benchmark items and the items they come from."""
    found = decontamination.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format("text")} AS ws FROM documents),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
p AS (SELECT r, doc_id, n, t, count(*)::BIGINT AS tf
      FROM (SELECT r, doc_id, len(ws)::BIGINT AS n, unnest(ws) AS t FROM d) GROUP BY r, doc_id, n, t),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, c),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS.format("text")}) AS t FROM benchmark)),
s AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT
    AS score
  FROM q JOIN w USING (t) JOIN p USING (t), c GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 50
""")
def op13_ranked(spark, sf):
    """The fifty best documents for each benchmark item."""
    return ranked.best(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select(
        F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score"
    )


@query()
def op12_alignment(spark, sf):
    """Every document's alignment of the tokens of two tokenizers, with corpus-wide counts of the pairs linked."""
    found = alignment.per_document(table(spark, sf, "documents"), vocabulary(), piece_vocabulary())
    return found.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
