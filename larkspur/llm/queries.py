"""Registered queries of the operators and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bond, bpe, common, decontam, langid, mixing, prefixes, repair, rlz, simhash, spotsigs, urlrules, warc, wordpiece

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
URL_RULES: list[urlrules.Rule] = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, decoded="decoded").drop("text")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return rlz.digests(rlz.with_spans(docs)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    archived = warc.archive(pages, common.fresh_folder(spark, "warc"))
    found = warc.lookup(archived, pages.select("url"), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    labels = _table(spark, folder, "labels")
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when((F.col("toxic") == 0) & (F.col("quality") == 1), 0)
    labelled = pages.join(labels, pages.page_id == labels.doc_id).select("url", bad.alias("bad"))
    judged = urlrules.judge(pages, urlrules.mine(labelled), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "n_matched")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = langid.fit(docs, langid.learnable("doc_id"))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return bond.top_k(vectors, F.col("vec_id") % 20 == 0)


def op7_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.edits(_table(spark, folder, "documents"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.grouped(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op9_mix(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.taken(_table(spark, folder, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    counted = wordpiece.token_counts(docs, public_tokenizers.path(PIECES))
    return counted.select("doc_id", "n_words", "n_tokens", "n_unknown", "most_tokens")


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    found = repair.repair(repair.damaged(_table(spark, folder, "conversations")))
    return found.where("last").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.find(docs, _table(spark, folder, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.trie(prefixes.rebuilt(_table(spark, folder, "conversations")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_substring_dedup, op3_warc, op4_url_rules, op5_language_id,
        op6_exact_top_k, op7_spot_signatures, op8_simhash, op9_mix, op10_token_counts, op11_repair, op12_decontaminate,
        op13_prefix_trie,
    )
}

ORACLES: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        places AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM split),
        windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win FROM places),
        firsts AS (SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win),
        later AS (
            SELECT doc_id, list(i) AS starts FROM windows JOIN firsts USING (win)
            WHERE doc_id > first_id GROUP BY doc_id),
        gone AS (
            SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda i: generate_series(i, i + 12)))) AS cut
            FROM later)
        SELECT s.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(cut), 0)::BIGINT AS n_removed,
               sha256(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(coalesce(cut, []), i)), ' ')) AS kept_sha256
        FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id""",
    "op3_warc": """
        WITH own AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS digest FROM pages),
        top AS (SELECT digest, max(page_id) AS top_id FROM own WHERE n >= 1000 GROUP BY digest)
        SELECT page_id, n AS payload_bytes, own.digest AS payload_digest,
               CASE WHEN page_id < top_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < top_id THEN top_id END AS refers_to
        FROM own LEFT JOIN top ON own.digest = top.digest AND n >= 1000""",
    "op6_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS "rank" FROM scored)
        SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 20""",
    "op12_decontaminate": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM documents),
        items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM benchmark),
        asked AS (
            SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
            FROM (SELECT *, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS i FROM items WHERE len(ws) > 0)),
        sizes AS (SELECT DISTINCT n FROM asked),
        places AS (
            SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
            FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM split, sizes)),
        met AS (SELECT DISTINCT doc_id, item_id, n, i FROM places JOIN asked USING (n, win)),
        hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM met) GROUP BY doc_id),
        found AS (
            SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM met) GROUP BY doc_id)
        SELECT s.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM split s LEFT JOIN hits h ON s.doc_id = h.doc_id LEFT JOIN found f ON s.doc_id = f.doc_id""",
    "op13_prefix_trie": """
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place,
                   coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        sizes AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base FROM turns GROUP BY conv_id),
        bits AS (SELECT conv_id, n, base, conv_id::VARCHAR AS s FROM sizes),
        crc AS (
            SELECT conv_id, n, base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                       generate_series(1, length(s)), lambda k: ascii(s[k])::BIGINT)), lambda a, b:
                       list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]), lambda x, y:
                           xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295) % 9 AS h
            FROM bits),
        rebuilt AS (
            SELECT c.conv_id, t.place, role, text FROM crc c JOIN turns t ON t.conv_id = c.base AND t.place < c.h
            UNION ALL
            SELECT c.conv_id, t.place - h + least(h, coalesce(b.n, 0)), role, text
            FROM crc c JOIN turns t ON t.conv_id = c.conv_id AND t.place >= c.h LEFT JOIN sizes b ON b.conv_id = c.base),
        chains AS (
            SELECT conv_id, place + 1 AS depth, strlen(text) AS n_bytes,
                   string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY place) AS path
            FROM rebuilt
            UNION ALL SELECT conv_id, 0, 0, '' FROM sizes),
        members AS (SELECT conv_id, depth, n_bytes, sha256(path) AS node FROM chains),
        lasts AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
        nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n_bytes) AS w FROM members GROUP BY node, depth),
        kids AS (
            SELECT up.node, count(DISTINCT m.node) AS n FROM members m JOIN members up ON up.conv_id = m.conv_id AND up.depth = m.depth - 1
            GROUP BY up.node),
        sums AS (
            SELECT up.node, sum(v.w) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
            FROM nodes v JOIN members up ON up.conv_id = v.conv_id AND up.depth <= v.depth LEFT JOIN kids k ON k.node = v.node
            GROUP BY up.node),
        ends AS (
            SELECT m.node, sha256(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id)) AS digest
            FROM members m JOIN lasts l ON l.conv_id = m.conv_id AND l.depth = m.depth GROUP BY m.node)
        SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n, 0) AS n_children,
               leaves AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
        FROM nodes v JOIN sums s ON s.node = v.node LEFT JOIN kids k ON k.node = v.node LEFT JOIN ends e ON e.node = v.node
        LEFT JOIN members up ON up.conv_id = v.conv_id AND up.depth = v.depth - 1
        LEFT JOIN nodes p ON p.node = up.node""",
}
