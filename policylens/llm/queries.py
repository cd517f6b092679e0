"""The registered queries of these operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policylens.llm import ann, chat, fm_toxicity, hard_negatives, host_rules, knn_quality, mixing, packing, page_text, pq_codes, setsketch, substring, warc
from policylens.llm.text import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, and read back from the archives."""
    pages = table(spark, sf_dir, "pages")
    scratch = Scratch(spark, "warc")
    path = scratch.path("archives")
    payload = F.encode(F.coalesce(pages["html"].cast("string"), F.lit("")), "UTF-8")
    warc.write_warc(warc.with_revisits(pages, payload), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, docs["doc_id"], docs["text"], packing.Packing(tokenizer_path()))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substring.Repeats(docs, docs["doc_id"], docs["text"]).digests()


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows["vec_id"], rows["embedding"], rows["vec_id"] % 100 == 0)


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return host_rules.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("host_rate", 9).alias("host_rate"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture's rows: doc_id, source, epoch and position."""
    out = mixing.mixed(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "row.source", "epoch", "position")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return knn_quality.score(docs, knn_quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fm_toxicity.score(docs, fm_toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return setsketch.NearDuplicates(docs, docs["doc_id"], docs["text"], setsketch.Sketching(shingle=2)).result()


CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    out = chat.formatted_conversations(chat.conversation_records(rows.unionAll(extra)))
    back = out.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    return hard_negatives.mine(rows, rows["vec_id"], rows["embedding"], label, rows["vec_id"] % 100 == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return pq_codes.digests(pq_codes.fit(rows, rows["vec_id"], rows["embedding"], rows["label"]))


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = page_text.fit(pages, pages["page_id"], pages["html"])
    return page_text.extracted(pages, pages["page_id"], pages["url"], pages["html"], model)


WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SQL1 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
g AS (SELECT h, max(page_id) AS first FROM d WHERE n >= 1000 GROUP BY h)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
       CASE WHEN g.first IS NOT NULL AND d.page_id IS DISTINCT FROM g.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first IS NOT NULL AND d.page_id IS DISTINCT FROM g.first THEN g.first END AS refers_to
FROM d LEFT JOIN g ON d.n >= 1000 AND d.h = g.h
"""

SQL3 = f"""
WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
v AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM t WHERE len(w) >= 35),
g AS MATERIALIZED (SELECT r, i, hash(array_to_string(w[i:i + 34], ' ')) AS h, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM v),
again AS (SELECT h, k FROM g GROUP BY h, k HAVING count(*) > 1),
hit AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM g JOIN again USING (h, k)),
gone AS (SELECT r, list(j) AS js, count(*) AS n FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
              ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(js, i)), ' ') END) AS kept_sha256
FROM t LEFT JOIN gone USING (r)
"""

SQL5 = f"""
WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {WORDS} AS w,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)),
again AS (SELECT r, g FROM g GROUP BY r, g HAVING count(*) > 1),
hit AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM g JOIN again USING (r, g)) GROUP BY r),
s AS MATERIALIZED (SELECT r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
      CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
      CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_repeat_words FROM t LEFT JOIN hit USING (r)),
b AS MATERIALIZED (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n,
      CAST(count(*) FILTER (base_failed OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines) AS DOUBLE) AS f FROM b GROUP BY source),
m AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS q, count(*) / sum(n) AS c FROM h),
p AS (SELECT m, CASE WHEN m * (1 - m) <= 0 THEN 1.0 ELSE greatest(1.0, m * (1 - m) / greatest(q - m * m - m * (1 - m) * c, 1e-9) - 1) END AS k FROM m),
rated AS (SELECT source, (f + m * k) / (n + k) AS rate, least(0.5, greatest(0.25, m + 2 * sqrt(m * (1 - m) / (k + 1)))) AS most FROM h, p),
bad AS (SELECT source, rate, rate > most AS bad FROM rated)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept, round(rate, 9) AS host_rate
FROM b JOIN bad ON b.source IS NOT DISTINCT FROM bad.source
"""

SQL9 = f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT doc_id, {WORDS} AS w
      FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
s AS MATERIALIZED (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) = 1 THEN w
      ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM t)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
l AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM t UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.c = l.a)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id, t.doc_id = min(r.c) AS kept
FROM t LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = t.doc_id GROUP BY t.doc_id, n.n
"""

SQL10 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
g AS (SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
      string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
      coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
      CAST(sum(14 + length(role) + length(text) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + length(regexp_replace(text, '[^\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
      FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""

FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

SQL11 = f"""
WITH e AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {FINITE}),
a AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM (SELECT DISTINCT * FROM e WHERE vec_id % 100 = 0)),
s AS MATERIALIZED (SELECT a.r, a.vec_id AS anchor_id, a.label = e.label AS same, e.vec_id, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
      FROM a, e WHERE a.vec_id <> e.vec_id OR a.label <> e.label),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
      row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.r = p.r AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def lloyd_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Each round scans the whole codebook: places (row, part), nearest entry by (distance, index), floored means."""
    steps = [f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, label NULLS FIRST, embedding) AS r, vec_id, label,
      list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE {FINITE}),
cut AS MATERIALIZED (SELECT r, p, v[p * w + 1:p * w + w] AS x FROM (SELECT r, v, len(v) // {parts} AS w, unnest(range({parts})) AS p FROM kept)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM cut WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""
n{k} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min([list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e]) AS m
      FROM cut JOIN b{k} USING (p) GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""
s{k} AS (SELECT p, e, i, CAST((s - (s % n + n) % n) // n AS BIGINT) AS c FROM (SELECT p, m[2] AS e, i, sum(x[i]) AS s, count(*) AS n
      FROM (SELECT p, m, x, unnest(range(1, len(x) + 1)) AS i FROM n{k}) GROUP BY p, m[2], i)),
b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(u.c, b{k}.c) AS c FROM b{k} LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS c FROM s{k} GROUP BY p, e) u USING (p, e))""")
    return ",".join(steps) + f""",
one AS (SELECT r, string_agg(printf('%02x', CAST(m[2] AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m[1]) AS BIGINT) AS error FROM n{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM kept JOIN one USING (r), h
"""

#: The test pages all have one article of headings and paragraphs, so there the text blocks can be cut out by patterns.
SQL13 = r"""
WITH a AS (SELECT page_id, url, list_transform(regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?(p|h1)>'),
      lambda b: regexp_replace(replace(replace(replace(regexp_replace(replace(b, '<br>', ' '), '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g')) AS b FROM pages),
t AS (SELECT page_id, url, array_to_string(list_filter(list_transform(b, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM a)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""


def queries() -> dict:
    return {f.__name__: f for f in (op1_warc, op2_packing, op3_substring_dedup, op4_nearest_vectors, op5_host_rules, op6_mixing, op7_quality,
                                    op8_toxicity, op9_near_duplicates, op10_chat, op11_hard_negatives, op12_vector_codes, op13_page_text)}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": SQL1, "op3_substring_dedup": SQL3, "op5_host_rules": SQL5, "op9_near_duplicates": SQL9, "op10_chat": SQL10, "op11_hard_negatives": SQL11,
            "op12_vector_codes": lloyd_sql(), "op13_page_text": SQL13}
