"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm import (
    bpe, chat, decontamination, fill_in_middle, hard_negatives, imatch, quality, secrets, sharding, simhash,
    token_counts, toxicity, url_filter,
)
from rowmill.session import fresh_path

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"
TOKEN_LIMIT = 4096
SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(key: str, parts: int) -> Column:
    """Which of ``parts`` folds a row belongs to."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts start from an empty cache each time, so the query always does the whole work."""
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), fresh_path(spark, "token-cache")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0))
    scored = docs.select("doc_id", quality.quality(F.col("text"), model, spark).alias("score"))
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.compare_edited(docs, imatch.lexicon(docs))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list comes from the captures: a page with a junk title lists its host, and its host with
    the first path segment, from the day of its capture; a day with none but clean ones takes them
    off.  The given pages have no times: page n counts as fetched in minute 997 n of a leap year."""
    pages = table(spark, sf_dir, "pages")
    minute = F.pmod(F.col("page_id") * 997, F.lit(366 * 1440))
    fetched = F.expr("timestamp_ntz '2024-01-01 00:00:00'") + F.make_interval(mins=minute.cast("int"))
    title = F.regexp_extract(F.coalesce("html", F.lit("")), "<title>([^<]*)", 1)
    junk = title.rlike(r"%%%|\$\$\$|###|\*\*\*|!!|(&amp;){3}")
    seen = pages.select("page_id", "url", fetched.alias("fetched"), junk.alias("junk"))
    host, head = url_filter.host_of(F.col("url")), url_filter.path_head(F.col("url"))
    named = F.when(host != "", F.array(host, F.when(head != "", F.concat_ws("/", host, head))))
    entries = seen.select(F.explode(named).alias("entry"), F.to_date("fetched").alias("day"), F.col("junk").alias("listed"))
    return url_filter.judge(seen, entries, "page_id", "url", "fetched", "2024-01-01", "2024-12-01")


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes((page_id * 997) % 527040) AS fetched,
    regexp_replace(regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '^www\.', '') AS host,
    regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://[^/?#]*/([^/?#]*)', 1) AS head,
    regexp_matches(regexp_extract(coalesce(html, ''), '<title>([^<]*)', 1), '%%%|\$\$\$|###|\*\*\*|!!|(&amp;){3}') AS junk
  FROM pages),
e AS (
  SELECT host AS entry, CAST(fetched AS DATE) AS day, junk FROM p WHERE host <> ''
  UNION ALL SELECT host || '/' || head, CAST(fetched AS DATE), junk FROM p WHERE host <> '' AND head <> ''),
d AS (SELECT entry, day, max(CAST(junk AS INTEGER)) AS listed FROM e GROUP BY entry, day),
i AS (SELECT entry, listed, day AS valid_from,
    coalesce(lead(day) OVER (PARTITION BY entry ORDER BY day), DATE '9999-12-31') AS valid_to FROM d),
k AS (
  SELECT page_id, fetched, host || '/' || head AS entry FROM p WHERE host <> '' AND head <> ''
  UNION
  SELECT page_id, fetched, array_to_string(labels[n:], '.') AS entry FROM (
    SELECT page_id, fetched, string_split(host, '.') AS labels,
      unnest(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1)) AS n FROM p WHERE host <> '')),
h AS (
  SELECT k.page_id, k.entry, i.valid_from,
    row_number() OVER (PARTITION BY k.page_id ORDER BY length(k.entry) DESC, k.entry) AS rank
  FROM k JOIN i ON i.entry = k.entry AND i.listed = 1
    AND i.valid_from <= CAST(k.fetched AS DATE) AND CAST(k.fetched AS DATE) < i.valid_to)
SELECT p.page_id, p.fetched, p.host, h.entry IS NOT NULL AS blocked, h.entry, h.valid_from AS listed_since
FROM p LEFT JOIN h ON h.page_id = p.page_id AND h.rank = 1
"""


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_records(table(spark, sf_dir, "documents"), [1.0] * SHARDS, 1.0)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def encoded_digests(docs: DataFrame) -> DataFrame:
    coded = bpe.encode_texts(docs, public_tokenizers.path(BYTES))
    numbers = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.hexadecimal("fingerprint").alias("fingerprint"), F.col("component").alias("component_id")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2))
    scored = docs.select("doc_id", toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the table are records of one layout, conversation -1 is a record of another."""
    rows = table(spark, sf_dir, "conversations")
    kept = F.struct(*[F.col(name) for name in ("conv_id", "turn", "role", "text")])
    record = F.to_json(kept, {"ignoreNullFields": "false"})
    extra = spark.range(1).select(F.to_json(F.struct(
        F.lit(-1).alias("id"),
        F.array(*[
            F.struct(F.lit(role).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("content"))
            for role in ("user", "assistant")
        ]).alias("messages"),
    )).alias("record"))
    turns = chat.canonical_turns(rows.select(record.alias("record")).unionByName(extra))
    return chat.read_back(chat.conversations(chat.formatted_turns(turns)))


OP10_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(regexp_replace(text, '(\[|<)(\\*)(/?INST\]|/?s>)', '\1\\\2\3', 'g')) + length(role)
    + CASE WHEN role = 'assistant' THEN 8 ELSE 19 END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
g AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    CAST('0x' || substring(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substring(d, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substring(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substring(d, 25, 8) AS BIGINT) AS h4
  FROM h),
f AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
      THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM g),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM f),
p AS (
  SELECT *, CASE WHEN a = 0 THEN '' ELSE array_to_string(units[1:a], '') END AS prefix,
    CASE WHEN a = b THEN '' ELSE array_to_string(units[a + 1:b], '') END AS middle,
    CASE WHEN b = n THEN '' ELSE array_to_string(units[b + 1:n], '') END AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM p
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    whole = rows.select(
        "vec_id", hard_negatives.mixed_label(F.col("vec_id"), F.col("label")).alias("label"),
        hard_negatives.whole_components("embedding").alias("vector"),
    )
    return hard_negatives.mine(whole, "vec_id", "label", "vector", F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source counts as the owner of its documents, each of which counts as one repository."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != secrets.KINDS[-1])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(test) -> Column:
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(kind: str) -> Column:
        return number(lambda s: s["kind"] == kind).alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(of_kind, secrets.KINDS[:-1]),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        number(lambda s: s["live"]).alias("n_live"), number(lambda s: ~s["live"]).alias("n_copied"),
    )


_ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
OP13_SQL = rf"""
WITH k AS (
  SELECT * FROM (VALUES (0, 'assign', '{_ASSIGN}'), (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]{{24,}}'),
    (3, 'owned', '[A-Za-z0-9+/_-]{{20,}}')) AS v(kind, name, pattern)),
d AS (SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT n, doc_id, source, kind, name, regexp_extract_all(text, pattern) AS found, string_split_regex(text, pattern) AS rest,
    regexp_extract_all(text, pattern, 2 - least(2 * kind, 2)) AS secrets FROM d, k),
s AS (
  SELECT n, doc_id, source, kind, name, found[i] AS span, secrets[i] AS secret,
    coalesce(list_sum(list_transform(rest[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m)),
b AS (
  SELECT *, CAST(start AS BIGINT) AS from_, CAST(start + length(span) AS BIGINT) AS to_ FROM s
  WHERE kind = 2 OR (kind = 0 AND length(secret) >= 6) OR (kind = 1 AND length(span) >= 20)
    OR (kind = 3 AND regexp_matches(span, '[0-9]') AND regexp_matches(span, '[A-Za-z]') AND len(list_distinct(string_split(span, ''))) >= 10)),
c AS (
  SELECT * FROM b AS x WHERE kind < 3 OR NOT EXISTS (
    SELECT 1 FROM b AS y WHERE y.n = x.n AND y.kind < 3 AND y.from_ < x.to_ AND x.from_ < y.to_)),
o AS (SELECT secret, count(DISTINCT source) AS owners FROM c GROUP BY secret),
f AS (SELECT c.*, owners <= 2 AS live, name || ':' || from_ || ':' || to_ AS shown FROM c JOIN o USING (secret) WHERE kind < 3 OR owners <= 2)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(shown, ',' ORDER BY from_, kind) FILTER (kind < 3), '')) AS base_sha256,
  coalesce(string_agg(shown, ',' ORDER BY from_, kind), '') AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
FROM d LEFT JOIN f ON f.n = d.n GROUP BY d.n, d.doc_id
"""


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_quality": op2_quality,
    "op3_fingerprints": op3_fingerprints,
    "op4_url_filter": op4_url_filter,
    "op5_sharding": op5_sharding,
    "op6_decontamination": op6_decontamination,
    "op7_bpe": op7_bpe,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_chat": op10_chat,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_secrets": op13_secrets,
}

ORACLES = {
    "op4_url_filter": OP4_SQL, "op10_chat": OP10_SQL, "op11_fill_in_middle": OP11_SQL, "op12_hard_negatives": OP12_SQL,
    "op13_secrets": OP13_SQL,
}
