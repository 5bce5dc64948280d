"""Queries over the operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import (
    bpe,
    conversation_trie,
    embedding_dedup,
    exact_dedup,
    fingerprints,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    periodic,
    sharding,
    toxicity,
    warc,
)
from kpiloom.llm.common import checkpointed, lookup, table
from kpiloom.session import remove_folder, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return register


LICENSE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         string_split(regexp_replace(text, '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)) AS parts
  FROM documents WHERE length(text) > 0),
cut AS (
  SELECT r, doc_id, list_filter(list_transform(parts, lambda x: regexp_extract_all(x, '[0-9A-Za-z]+')),
                                lambda w: len(w) > 0) AS pieces FROM docs),
listed AS (SELECT r, doc_id, generate_subscripts(pieces, 1) - 1 AS piece, unnest(pieces) AS words FROM cut),
placed AS (
  SELECT r, doc_id, piece, len(words) AS len, words,
         CAST(sum(len(words)) OVER w AS INTEGER) - len(words) AS first, lead(words[1]) OVER w AS after,
         lag(words[-1]) OVER w AS before
  FROM listed WINDOW w AS (PARTITION BY r ORDER BY piece)),
grams AS (
  SELECT r, doc_id, piece, len, first, unnest(range(first, first + len)) AS pos,
         unnest(list_transform(range(1, len + 1),
                lambda i: lower(words[i] || ' ' || coalesce(words[i + 1], after)))) AS gram, false AS leads
  FROM placed
  UNION ALL SELECT r, doc_id, piece, len, first, first - 1, lower(before || ' ' || words[1]), true
  FROM placed WHERE piece > 0),
templates(license_id, template, size, gram, times) AS (VALUES %s),
hits AS (SELECT * FROM grams JOIN templates USING (gram)),
edges AS (
  SELECT r, license_id, template, size, piece, first, first + len - 1 AS last
  FROM hits GROUP BY r, license_id, template, size, piece, first, len HAVING count(*) >= len * 0.4::DOUBLE),
runs AS (
  SELECT a.r, a.license_id, a.template, a.size, a.first, b.last, a.piece AS first_piece, b.piece AS last_piece,
         b.last - a.first AS n
  FROM edges a JOIN edges b ON a.r = b.r AND a.license_id = b.license_id AND a.template = b.template
  WHERE b.last > a.first AND 2 * least(b.last - a.first, a.size)::DOUBLE / (b.last - a.first + a.size) >= 0.8::DOUBLE),
counts AS (
  SELECT h.doc_id, u.*, least(count(*), max(h.times)) AS shared
  FROM runs u JOIN hits h ON h.r = u.r AND h.license_id = u.license_id AND h.template = u.template
    AND NOT h.leads AND h.pos >= u.first AND h.pos < u.last
  GROUP BY h.doc_id, u.r, u.license_id, u.template, u.size, u.first, u.last, u.first_piece, u.last_piece, u.n, h.gram),
scores AS (
  SELECT doc_id, r, license_id, template, first, last, first_piece, last_piece,
         CAST(2 * sum(shared) AS DOUBLE) / (n + size) AS dice
  FROM counts GROUP BY doc_id, r, license_id, template, size, first, last, first_piece, last_piece, n
  HAVING CAST(2 * sum(shared) AS DOUBLE) / (n + size) >= 0.8::DOUBLE),
covered AS (SELECT *, unnest(range(first_piece, last_piece + 1)) AS piece FROM scores),
best AS (
  SELECT * EXCLUDE piece FROM covered
  QUALIFY row_number() OVER (PARTITION BY r, piece ORDER BY dice DESC, first, last, license_id, template) = 1)
SELECT doc_id, CAST(first_piece AS INTEGER) AS first_piece, CAST(last_piece AS INTEGER) AS last_piece,
       CAST(first AS INTEGER) AS first_word, CAST(last - first + 1 AS INTEGER) AS n_words, license_id,
       CAST(template AS INTEGER) AS template, dice
FROM (SELECT DISTINCT * FROM best)
""" % licenses.template_values()


@query("op1_license_scan", LICENSE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM docs GROUP BY source),
placed AS (SELECT source, s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sums),
weighed AS (
  SELECT source, s, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM placed),
filled AS (
  SELECT source, s, w,
         row_number() OVER (ORDER BY s / w, source NULLS LAST) AS k,
         coalesce(sum(3 * s) OVER (ORDER BY s / w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
         sum(w) OVER (ORDER BY s / w, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w,
         sum(s) OVER () AS t
  FROM weighed),
-- The first source, by words per weight, whose share fits under its cap; those before it are capped.
level AS (
  SELECT k, c, left_w, t FROM filled
  WHERE (t - c) * w <= 3 * s * left_w ORDER BY k LIMIT 1),
targets AS (
  SELECT f.source, f.s AS source_size,
         CASE WHEN l.k IS NULL OR f.k < l.k THEN CAST(3 * f.s AS DOUBLE)
              ELSE CAST(l.t - l.c AS DOUBLE) * f.w / CAST(l.left_w AS DOUBLE) END AS target
  FROM filled f LEFT JOIN level l ON TRUE),
rates AS (
  SELECT d.doc_id, d.size, t.source, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || coalesce(d.text, '')), 1, 13)
           AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
-- 64 draws a source, of which the one nearest to its target is taken.
draws AS (
  SELECT source, k, abs(sum(CASE WHEN u + k * 0.015625::DOUBLE - floor(u + k * 0.015625::DOUBLE) < rate - floor(rate)
                                 THEN size ELSE 0 END)
                        - (any_value(target) - floor(any_value(rate)) * any_value(source_size))) AS miss
  FROM rates, range(64) AS turns(k) GROUP BY source, k),
chosen AS (SELECT source, k FROM draws QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, k) = 1)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u + k * 0.015625::DOUBLE - floor(u + k * 0.015625::DOUBLE) < rate - floor(rate)
                                       THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates r JOIN chosen c ON r.source IS NOT DISTINCT FROM c.source
"""


@query("op2_mix_sources", MIX_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", taken)


EXACT_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
placed AS (
  SELECT r, doc_id, sha256(body) AS text_sha256, count(*) OVER (PARTITION BY body) AS group_size,
         first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place
  FROM docs WINDOW w AS (PARTITION BY body ORDER BY n_chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM placed
"""


@query("op3_exact_dedup", EXACT_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: Name of the vocabulary file among the public tokenizers.
TOKENIZER = "byte_bpe_50k.json"


@query("op4_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path(TOKENIZER), full=False)


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op6_ring_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_minhash_bayes")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, percent=85)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return groups.select("doc_id", "n_shingles", "component_id", kept)


@query("op9_spotsigs")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


WARC_SQL = """
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
groups AS (
  SELECT page_id, body, min(page_id) OVER (PARTITION BY body) AS first_id,
         array_to_string(list_transform(range(0, 4), lambda k: array_to_string(list_transform(range(0, 8),
           lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + CAST((CAST('0x' || substr(hex, CAST(1 + 10 * k AS INTEGER), 10) AS BIGINT)
                       >> CAST(35 - 5 * i AS BIGINT)) & 31 AS INTEGER), 1)), '')), '') AS payload_digest
  FROM bodies)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM groups
"""


@query("op10_warc_roundtrip", WARC_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    records = warc.read_warc(spark, folder)
    found = checkpointed(records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    remove_folder(spark, folder)
    return found


def _cycled(text: Column, doc_id: Column) -> Column:
    """Of each tenth document, by the CRC of its id, the words from a place on repeat a few times; null ids stay."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    cycled = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (F.coalesce(n, F.lit(0)) > 0), cycled).otherwise(text)


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _cycled(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.find_runs(docs, keep_text=False)
    # Runs come by start, then period; of equal exponents the first stays.
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda x, r: F.when(r["length"] * x["period"] > x["length"] * r["period"], r).otherwise(x),
    )
    told = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(told, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: CRC-32 of a short text, bit by bit.
_CRC_SQL = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}, ''), "
    "lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
    "lambda s, x: xor(xor(s, x) >> 1, (xor(s, x) & 1) * 3988292384)), 4294967295)"
)

TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC_SQL.format("conv_id::VARCHAR")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
both_parts AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
path AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS size,
         string_agg(sha256(length(role) || ':' || role || text), '/') OVER w AS node
  FROM both_parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
members AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
  lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends FROM path),
nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, any_value(size) AS size, min(conv_id) AS conv_id,
         count(*) AS n, bool_and(ends) AS leaf,
         sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS digest
  FROM members GROUP BY node),
-- The nodes above a node are on the path of its smallest member.
totals AS (
  SELECT p.node, sum(v.leaf::INT) AS leaves, sum((v.n - 1) * v.size) AS saved
  FROM nodes v JOIN path p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.node),
kids AS (SELECT parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(kids.n, 0) AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, v.digest AS ends_sha256
FROM nodes v JOIN totals s ON s.node = v.node LEFT JOIN kids ON kids.parent = v.node
LEFT JOIN nodes u ON u.node = v.parent
"""


def _rebuilt(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Each conversation after the first turns of the hundred's first one; as many of its own go, 0 to 5 by its id's CRC."""
    first = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    base = F.col("conv_id") - F.col("conv_id") % 100
    heads = turns.filter((F.col("conv_id") % 100 == 0) & (F.col("depth") <= 5)).withColumnsRenamed(
        {"conv_id": "h_id", "depth": "h_depth"}
    )
    there = heads.groupBy(F.col("h_id").alias("b_id")).agg(F.max("h_depth").alias("b_turns"))
    facts = conversations.select(F.col("conv_id").alias("f_id"), first.alias("first"), base.alias("base"))
    facts = facts.join(there, F.col("base") == F.col("b_id"), "left")
    head = F.least("first", F.coalesce("b_turns", F.lit(0))).alias("head")
    facts = checkpointed(facts.select("f_id", "first", "base", head))
    own = lookup(turns, facts, [("conv_id", "f_id")]).filter(F.col("depth") > F.col("first"))
    own = own.withColumn("depth", F.col("depth") - F.col("first") + F.col("head")).select(*turns.columns)
    lent = facts.join(heads, (F.col("base") == F.col("h_id")) & (F.col("h_depth") <= F.col("head")))
    lent = lent.withColumnsRenamed({"f_id": "conv_id", "h_depth": "depth"})
    return own.unionByName(lent.select(*turns.columns))


@query("op12_conversation_trie", TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    numbered = checkpointed(conversation_trie.numbered_turns(turns))
    conversations = checkpointed(numbered.select("conv_id").distinct())
    rebuilt = checkpointed(_rebuilt(numbered, conversations))
    return conversation_trie.prefix_trie(rebuilt, conversations)


@query("op13_embedding_neighbours")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    found = embedding_dedup.near_vectors(vectors, cosine=0.93)
    return found.select("vec_id", "n_links", "component_id", "kept")
