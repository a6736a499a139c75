"""One query per operator over its whole table, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.files import shared_folder
from . import chat, decontaminate, language, neardup, packing, pages, quality, scoring, tokens, trie, urls, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Host and path rules, and what they say.
URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op1_html(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


@query("""
    WITH w AS (
      SELECT doc_id, row_number() OVER () AS r,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
      FROM documents),
    i AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
      FROM benchmark),
    g AS (
      SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS win
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS p FROM i WHERE len(ws) > 0)),
    d AS (
      SELECT r, k, p, array_to_string(ws[p:p + k - 1], ' ') AS win
      FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM w, (SELECT DISTINCT k FROM g) WHERE len(ws) >= k)),
    h AS (SELECT d.r, d.p, d.k, g.item_id FROM d JOIN g USING (k, win)),
    n AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT r, p, k FROM h)) GROUP BY r),
    s AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM h WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM w LEFT JOIN n USING (r) LEFT JOIN s USING (r)
""")
def op2_decontamination(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join("hit_items", ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query()
def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


@query()
def op4_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("""
    WITH c AS (
      SELECT conv_id, turn, role, text FROM conversations
      UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
    t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(19 + length(role) + length(regexp_replace(role, '[^\\\\<\\[]', '', 'g')) + length(text) + length(regexp_replace(text, '[^\\\\<\\[]', '', 'g'))) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
""")
def op5_chat(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    fixed = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(fixed)
    made = chat.format_conversations(rows)
    read = made.select(
        "conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"), chat.turns(F.col("formatted")).alias("turns"),
        chat.learned(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


@query()
def op6_warc(spark, sf_dir):
    return warc.derive(warc.responses(table(spark, sf_dir, "pages"))).withColumnRenamed("key", "page_id")


@query()
def op7_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    prototypes = language.train(docs.where(~language.held_out(docs)))
    found = language.predict(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", language.held_out(found).alias("held_out"), "lang_pred", "score")


@query()
def op8_urls(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@query()
def op9_quality(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "quality")


@query()
def op10_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scoring.pseudo_likelihood(docs).select("doc_id", "n_tokens", "log_likelihood", "per_token")


#: CRC-32 of a decimal number's text, in integers: a byte at a time, eight divisions by the polynomial each.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(CAST({0} AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST({0} AS VARCHAR), i, 1)) AS BIGINT))),
        lambda c, b: xor(c >> 8, list_reduce([xor(c & 255, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))))"""


@query(f"""
    WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r FROM conversations WHERE conv_id IS NOT NULL),
    k AS (SELECT c, c - c % 5 AS f, {_CRC.format("c")} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
    b AS (
      SELECT k.c, 1 AS part, t.r, t.role, t.text FROM k JOIN t ON t.c = k.f AND t.r <= k.h
      UNION ALL SELECT k.c, 2, t.r, t.role, t.text FROM k JOIN t ON t.c = k.c AND t.r > k.h),
    o AS (SELECT k.c, coalesce(list({{'role': role, 'text': text}} ORDER BY part, r) FILTER (WHERE part IS NOT NULL), []) AS turns FROM k LEFT JOIN b ON b.c = k.c GROUP BY k.c),
    p AS (SELECT c, len(turns) AS l, unnest(range(0, len(turns) + 1)) AS d, turns FROM o),
    q AS (SELECT c, l, d, turns[1:d] AS path, turns[1:d - 1] AS up, coalesce(octet_length(encode(turns[d].text)), 0) AS bytes FROM p),
    n AS (SELECT d, path, any_value(CASE WHEN d > 0 THEN up END) AS up, min(c) AS conv_id, count(*) AS n_convs, max(CASE WHEN d > 0 THEN bytes ELSE 0 END) AS bytes,
                 coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE l = d), '') AS ends FROM q GROUP BY d, path),
    s AS (SELECT a.d, a.path, count(*) FILTER (WHERE b.d = a.d + 1) AS n_children,
                 count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM n e WHERE e.d = b.d + 1 AND e.up = b.path)) AS n_leaves, sum((b.n_convs - 1) * b.bytes) AS saved
          FROM n a JOIN n b ON b.d >= a.d AND b.path[1:a.d] = a.path GROUP BY a.d, a.path)
    SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
    FROM n JOIN s ON s.d = n.d AND s.path = n.path LEFT JOIN n u ON u.d = n.d - 1 AND u.path = n.up
""")
def op11_trie(spark, sf_dir):
    turns = trie.digests(table(spark, sf_dir, "conversations"))
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9))
    return trie.trie(trie.rebuilt(turns, F.col("conv_id") - F.col("conv_id") % 5, head, 8))


@query()
def op12_whitening(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


@query()
def op13_tokens(spark, sf_dir):
    path = shared_folder(spark, "tokens")
    tokens.write(table(spark, sf_dir, "documents"), tokenizer(), path)
    return tokens.documents(spark, path)
