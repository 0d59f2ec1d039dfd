"""Registered queries of this subpackage, and their SQL where SQL can express them.

Each takes (spark, sf_dir), applies its operator to the whole table and derives the columns it returns
from the operator's own output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    bpe,
    centroids,
    crf,
    exact_dedup,
    jaccard_join,
    licenses,
    mixing,
    secrets,
    spelling,
    token_counts,
    token_files,
    topk,
    warc,
)
from tidemill.session import prepare, scratch_path

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
COUNTED_BY = "byte_bpe_50k.json"
STORED_BY = "word_bpe_49k.json"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def bpe_digests(docs: DataFrame) -> DataFrame:
    ranks = public_tokenizers.path(BPE_RANKS)
    encoded = bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    encoded = encoded.withColumn("ids_sha256", F.sha2("ids", 256))
    decoded = bpe.decode_documents(encoded, ranks)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_digests(table(spark, sf, "documents"))


def op2_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    found = topk.top_k(table(spark, sf, "embeddings"), F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = warc.write_archives(table(spark, sf, "pages"), scratch_path(spark, "warc"))
    full = warc.read_archives(spark, folder).where("record_type = 'response'")
    full = full.select(
        "record_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        warc.base32(F.sha1("payload")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    again = warc.read_archives(spark, folder, payload=False).where("record_type = 'revisit'")
    both = full.unionByName(again.select(*full.columns))
    return both.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(
        table(spark, sf, "documents"), folder, public_tokenizers.path(STORED_BY), end_id=1
    )
    stored = token_files.read_token_files(spark, folder, with_ids=False)
    return stored.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op5_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def op6_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    groups = jaccard_join.jaccard_groups(table(spark, sf, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op7_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path(COUNTED_BY))


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = crf.score_documents(docs, crf.train(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", crf.held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_centroids(spark: SparkSession, sf: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf, "embeddings"))
    components = F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string")))
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", F.sha2(components, 256).alias("centroid_sha256")
    )


def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf, "documents"), misspell_every=97)
    return spelling.group_spellings(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_licenses(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf, "documents"))
    joined = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", *joined, "score")


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_exact_topk, op3_warc, op4_token_files, op5_secrets, op6_jaccard_join, op7_exact_dedup,
        op8_token_counts, op9_mixing, op10_quality, op11_centroids, op12_spelling,
        op13_licenses,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _values(rows: list[tuple[str, str]], first: int, k: int) -> str:
    quoted = [[x.replace("'", "''") for x in row] for row in rows]
    return ", ".join(f"({first + i}, '{label}', '{text}', {k})" for i, (label, text) in enumerate(quoted))


def _rounds(n: int) -> str:
    """SQL of n rounds of assignment and new means, then the last assignment, on kept (r, vec_id, v) and c0 (c, v)."""
    parts = []
    for i in range(n + 1):
        parts.append(f"""a{i} AS (
  SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, arg_min(c, (far, c)) AS c, min(far) AS far
  FROM (SELECT r, vec_id, k.v AS x, c, (list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, m.v)
    + list_inner_product(m.v, m.v))::BIGINT AS far FROM kept k CROSS JOIN c{i} m) GROUP BY r
)""")
        if i < n:
            parts.append(f"""c{i + 1} AS (
  SELECT m.c, coalesce(moved.v, m.v) AS v FROM c{i} m LEFT JOIN (
    SELECT c, list(floor_mean::DOUBLE ORDER BY d) AS v FROM (
      SELECT c, d, (s - ((s % n) + n) % n) // n AS floor_mean FROM (
        SELECT c, d, sum(x[d]::BIGINT) AS s, count(*) AS n FROM a{i}, unnest(range(1, 65)) AS t(d) GROUP BY c, d))
    GROUP BY c) moved ON moved.c = m.c
)""")
    return ", ".join(parts)


SQL = {
    "op2_exact_topk": """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op3_warc": """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
), coded AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(hex, 10 * (k // 8) + 1, 10))::BIGINT >> (35 - 5 * (k % 8)::INTEGER)) & 31) + 1), 1)), 'string_agg', '') AS payload_digest
  FROM digests
), best AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM coded
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM best
""",
    "op6_jaccard_join": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), sized AS (
  SELECT doc_id, len(s)::BIGINT AS n, unnest(s) AS token FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM sized a JOIN sized b ON a.token = b.token AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id AS start, doc_id AS node FROM documents
  UNION
  SELECT r.start, l.y FROM reached r JOIN links l ON l.x = r.node
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id
FROM sets s JOIN (SELECT start, min(node) AS component_id FROM reached GROUP BY start) c ON c.start = s.doc_id
""",
    "op7_exact_dedup": f"""
WITH texts AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY norm)
""",
    "op11_centroids": f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept QUALIFY c < 16
), {_rounds(3)}, digests AS (
  SELECT c, sha256(array_to_string(list_transform(v, lambda x: x::BIGINT), ',')) AS centroid_sha256 FROM c3
)
SELECT vec_id, c::INTEGER AS cluster, far AS distance, (sum(far) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(far) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a3 JOIN digests USING (c)
""",
    "op12_spelling": r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*)::BIGINT AS n, hex(encode(concat(doc_id, ':', run))) AS code FROM runs WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
  SELECT doc_id, run, n, xor(4294967295, list_reduce(
    list_transform(range(len(code) // 2), lambda i: ('0x' || substr(code, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS h
  FROM counted CROSS JOIN crc_table
), spelled AS (
  SELECT n, CASE WHEN doc_id IS NOT NULL AND h % 97 = 0
    THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), shorter AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS spot, left(word, spot - 1) || substr(word, spot + 1) AS less FROM words
), inserted AS (
  SELECT DISTINCT s.word AS long, w.word AS short FROM shorter s JOIN words w ON s.less = w.word
), near AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.spot = b.spot AND a.less = b.less AND a.word <> b.word
  UNION ALL SELECT long, short FROM inserted UNION ALL SELECT short, long FROM inserted
), best AS (
  SELECT near.word, count(*) AS n_near, arg_min(other, (-w.n, other)) AS other, max(w.n) AS other_n
  FROM near JOIN words w ON w.word = near.other GROUP BY near.word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
    CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), steps AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT s.word, s.root FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
""",
    "op13_licenses": f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), listed(t, label, body, k) AS (
  VALUES {_values(licenses.TEMPLATES, 0, 3)}, {_values(licenses.PHRASES, len(licenses.TEMPLATES), 2)}
), known AS (
  SELECT t, label, k, regexp_extract_all(lower(body), '[a-z0-9]+') AS w FROM listed
), template_grams AS (
  SELECT t, label, k, len(w) AS size, unnest(range(0, len(w) - k + 1)) AS place, array_to_string(w[place + 1:place + k], ' ') AS gram FROM known
), grams AS (
  SELECT r, k, unnest(range(0, len(w) - k + 1)) AS pos, array_to_string(w[pos + 1:pos + k], ' ') AS gram
  FROM texts CROSS JOIN (VALUES (2), (3)) AS sizes(k)
), hits AS (
  SELECT r, t, label, g.k, size, pos, place, pos - place AS diagonal FROM grams g JOIN template_grams USING (gram, k)
), apart AS (
  SELECT *, diagonal - lag(diagonal) OVER same AS gap FROM hits WINDOW same AS (PARTITION BY r, t ORDER BY diagonal)
), numbered AS (
  SELECT *, sum(CASE WHEN gap IS NULL OR gap > CASE WHEN k = 2 THEN 0 ELSE 3 END THEN 1 ELSE 0 END)
    OVER (PARTITION BY r, t ORDER BY diagonal RANGE UNBOUNDED PRECEDING) AS span FROM apart
), covering AS (
  SELECT r, t, label, k, size, span, min(pos) AS low, max(pos) + k AS high, list(place) AS places FROM numbered GROUP BY r, t, label, k, size, span
), verified AS (
  SELECT *, len(list_distinct(flatten(list_transform(places, lambda p: range(p, p + k))))) AS covered FROM covering
), good AS (
  SELECT *, k = 2 AS phrase FROM verified
  WHERE CASE WHEN k = 2 THEN covered = size ELSE 4 * covered >= 3 * size AND 2 * covered >= high - low END
), found AS (
  SELECT r, count(*) FILTER (phrase) AS n_base, min(low) FILTER (phrase) AS first_word, max(low) FILTER (phrase) AS last_word,
    list_sort(list(DISTINCT label) FILTER (phrase)) AS base_labels, list_sort(list(DISTINCT label)) AS labels, max(covered / size) AS score
  FROM good GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(array_to_string(base_labels, ','), '') AS base_labels,
  coalesce(array_to_string(labels, ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM texts LEFT JOIN found USING (r)
""",
}
