"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import chatformat, convtrie, decontaminate, embeddings, filteraudit, licenses, linededup, packing, quality, simhash, tokencount, toxicity, warc


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.filter_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return chatformat.read_back(chatformat.format_chats(chatformat.with_planted(conversations)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination, op2_line_dedup, op3_simhash_near_dedup, op4_quality_classifier, op5_best_fit_packing, op6_license_scan,
        op7_embedding_near_dedup, op8_toxicity, op9_warc_capture_index, op10_token_counts, op11_filter_audit, op12_conversation_prefix_trie, op13_chat_formatting,
    )
}

_LICENSE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))



def _license_pattern(template: str) -> str:
    """A template as a regular expression over the words of a text, each with a space after it."""
    marks = {"<<optional>>": "(", "<</optional>>": ")?"}
    parts = re.findall(r"<<optional>>|<</optional>>|<<any:\d+>>|[^\s<>]+", template)
    return " " + "".join(marks.get(x) or (f"([^ ]+ ){{0,{x[6:-2]}}}" if x.startswith("<<any:") else f"{x} ") for x in parts)


def _license_sql() -> str:
    places, labels = [], []
    for phrase, label in _LICENSE_PHRASES:
        words = phrase.split()
        test = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
        places.append(f"list_filter(range(len(w)), lambda i: {test})")
        labels.append(f"CASE WHEN len({places[-1]}) > 0 THEN ['{label}'] ELSE []::VARCHAR[] END")
    patterns = [(k, _license_pattern(v)) for k, v in licenses.TEMPLATES.items()]
    own = [f"CASE WHEN regexp_matches(j, '{pattern}') THEN ['{label}'] ELSE []::VARCHAR[] END" for label, pattern in patterns]
    return f"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        found AS (
            SELECT doc_id, len(w) AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS j,
                flatten([{", ".join(places)}]) AS places, flatten([{", ".join(labels)}]) AS base FROM words),
        labelled AS (SELECT *, flatten([{", ".join(own)}]) AS own FROM found)
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
            CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
            array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
            array_to_string(list_sort(list_distinct(list_concat(base, own))), ',') AS labels,
            CASE WHEN len(own) > 0 THEN 1.0::DOUBLE WHEN len(base) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
        FROM labelled"""


def _line_sql(least: int = 32, half: int = 16) -> str:
    """Two lines one edit apart agree in their first or their last ``half`` characters, which gives
    the pairs that are compared character by character."""
    differing = "list_filter(range(len(short)), lambda i: long[i + 1] <> short[i + 1])"
    return f"""
        WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
        lines AS (
            SELECT doc_id, unnest(range(len(l))) AS line,
                trim(translate(unnest(l), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS x FROM split),
        firsts AS (SELECT x, min(doc_id * 1000000 + line) AS pos FROM lines WHERE x <> '' GROUP BY x),
        longs AS (SELECT x, pos, length(x) AS n, left(x, {half}) AS head, right(x, {half}) AS tail FROM firsts WHERE length(x) >= {least}),
        near AS (
            SELECT a.x AS x, a.pos AS pos, b.x AS y FROM longs a JOIN longs b ON a.head = b.head AND b.pos < a.pos AND abs(a.n - b.n) <= 1
            UNION SELECT a.x, a.pos, b.x FROM longs a JOIN longs b ON a.tail = b.tail AND b.pos < a.pos AND abs(a.n - b.n) <= 1),
        chars AS (
            SELECT pos, string_split(CASE WHEN length(x) >= length(y) THEN x ELSE y END, '') AS long,
                string_split(CASE WHEN length(x) >= length(y) THEN y ELSE x END, '') AS short FROM near),
        differ AS (SELECT *, {differing} AS d FROM chars),
        gone AS (
            SELECT DISTINCT pos FROM differ WHERE CASE WHEN len(long) = len(short) THEN len(d) = 1
                ELSE long[coalesce(d[1], len(short)) + 2:] = short[coalesce(d[1], len(short)) + 1:] END),
        per AS (
            SELECT f.pos // 1000000 AS doc_id, count(*) FILTER (WHERE g.pos IS NULL) AS kept, count(*) FILTER (WHERE g.pos IS NOT NULL) AS near
            FROM firsts f LEFT JOIN gone g ON f.pos = g.pos GROUP BY 1),
        blanks AS (SELECT doc_id, count(*) AS n FROM lines WHERE x = '' GROUP BY doc_id)
        SELECT s.doc_id, CAST(coalesce(len(s.l), 0) AS BIGINT) AS n_lines, CAST(coalesce(b.n, 0) AS BIGINT) AS n_blank,
            CAST(coalesce(p.kept, 0) AS BIGINT) AS n_kept, CAST(coalesce(p.near, 0) AS BIGINT) AS n_near
        FROM split s LEFT JOIN per p ON s.doc_id = p.doc_id LEFT JOIN blanks b ON s.doc_id = b.doc_id"""


SQL: dict[str, str] = {
    "op2_line_dedup": _line_sql(),
    "op6_license_scan": _license_sql(),
    "op7_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
        reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)""",
    "op9_warc_capture_index": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        h AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS holder FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
            CASE WHEN n >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN n >= 1000 AND page_id <> holder THEN holder END AS refers_to
        FROM h""",
    "op11_filter_audit": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        f AS (
            SELECT d.doc_id, part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic, map {
                'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                'D': regexp_matches(t, '[#$%&*|]'), 'E': d.doc_id > min(d.doc_id) OVER (PARTITION BY t)} AS fails
            FROM d LEFT JOIN labels l ON d.doc_id = l.doc_id),
        counts AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
        orders(o) AS (SELECT '' UNION ALL SELECT o || x FROM orders, (SELECT unnest(string_split('ABCDE', '')) AS x) WHERE NOT contains(o, x)),
        steps AS (SELECT o, s, substr(o, s, 1) AS filter, left(o, s - 1) AS before FROM orders, range(1, 6) r(s) WHERE length(o) = 5),
        seen AS (
            SELECT part, o, s, filter, n, good, toxic, fails[filter] AS fail, len(list_filter(string_split(before, ''), lambda x: x <> '' AND fails[x])) > 0 AS gone,
                len(list_filter(map_values(fails), lambda x: x)) = 1 AS alone
            FROM counts, steps),
        sums AS (
            SELECT part, o, s, filter, coalesce(sum(n) FILTER (NOT gone AND NOT fail), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fail), 0) AS removed,
                coalesce(sum(n) FILTER (gone AND fail), 0) AS redundant, coalesce(sum(n) FILTER (fail AND alone), 0) AS unique_fails,
                coalesce(sum(good) FILTER (NOT gone AND fail), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fail), 0) AS toxic_lost
            FROM seen GROUP BY ALL)
        SELECT part, o AS filter_order, CAST(s AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
            CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
            CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
        FROM sums""",
    # CRC-32 bit by bit over the digits; a prefix is the list of its turns; the nodes above one are the prefixes of its smallest member
    "op12_conversation_prefix_trie": """
        WITH t AS (
            SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32)) - 1 AS i,
                {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT c, list(x ORDER BY i) AS l FROM t GROUP BY c),
        crc AS (
            SELECT c, l, xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda y: ord(y)::BIGINT), lambda v, b: list_reduce(range(8),
                lambda z, k: xor(z >> 1, CASE WHEN z & 1 = 1 THEN 3988292384 ELSE 0 END), xor(v, b)), 4294967295), 4294967295) % 9 AS h FROM own),
        seq AS (SELECT crc.c, list_concat(coalesce(b.l, [])[:h], crc.l[h + 1:]) AS s FROM crc LEFT JOIN own b ON b.c = crc.c - crc.c % 5),
        pre AS (SELECT c, d, s[:d] AS p, d = len(s) AS last, CASE WHEN d > 0 THEN strlen(s[d].t) ELSE 0 END AS n FROM seq, LATERAL (SELECT unnest(range(len(s) + 1)) AS d)),
        nodes AS (
            SELECT p, d, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
                sha256(coalesce(string_agg(CASE WHEN last THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends FROM pre GROUP BY p, d),
        numbered AS (SELECT *, row_number() OVER () AS id FROM nodes),
        path AS (SELECT pre.c, pre.d, id, m.c AS first FROM pre JOIN numbered m ON m.p = pre.p AND m.d = pre.d),
        links AS (SELECT m.id, up.id AS parent, up.first FROM numbered m JOIN path up ON up.c = m.c AND up.d = m.d - 1),
        kids AS (SELECT parent AS id, count(*) AS n FROM links GROUP BY parent),
        below AS (
            SELECT up.id, count(*) FILTER (k.n IS NULL) AS leaves, sum(m.saved) AS saved
            FROM numbered m JOIN path up ON up.c = m.c AND up.d <= m.d LEFT JOIN kids k ON k.id = m.id GROUP BY up.id)
        SELECT m.c AS conv_id, CAST(m.d AS BIGINT) AS depth, l.first AS parent_conv_id, n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
            CAST(leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
        FROM numbered m JOIN below b USING (id) LEFT JOIN links l USING (id) LEFT JOIN kids k USING (id)""",
    "op13_chat_formatting": r"""
        WITH t AS (
            SELECT conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, i + 4611686018427387905, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
        e AS (
            SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>') AS body,
                replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), ':', '\:') AS name FROM t),
        s AS (
            SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
                sum(length('### ' || name || ': ' || body || '</turn>' || chr(10))) AS n FROM e GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars FROM s""",
}
