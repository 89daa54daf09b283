"""The operators over the whole tables, registered as opN_<name>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    blocks, bpe, chat, collocations, counts, decontaminate, jaccard, language, licenses, packing, repair, repetition, secret_scan,
)

Runner = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.groups(_documents(spark, folder))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_documents(spark, folder))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return blocks.groups(_documents(spark, folder))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.assess(_documents(spark, folder))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digests(packing.pack(_documents(spark, folder)))


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_documents(spark, folder))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(_documents(spark, folder))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.token_counts(_documents(spark, folder))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_documents(spark, folder))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text"
        " FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    return chat.digests(chat.conversations(rows.unionByName(extra)))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_documents(spark, folder))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = repair.damage(spark.read.parquet(f"{folder}/conversations.parquet"))
    return repair.repair(rows, gone_col="gone").withColumnRenamed("conv", "conv_id")


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet")).drop("spans")


QUERIES: dict[str, Runner] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_language_id, op3_exact_dedup, op4_quality_rules, op5_packing, op6_bpe,
        op7_secret_scan, op8_token_counts, op9_license_scan, op10_chat_format, op11_collocations,
        op12_conversation_repair, op13_decontamination,
    )
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 80 * (nx.n + ny.n - i)),
        r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT x, c FROM r JOIN l ON y = r.doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id
        FROM (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)""",
    "op3_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY text)""",
    "op10_chat_format": """
        WITH c AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (
          SELECT *, replace(replace(replace(replace(replace(text, '~', '~0'), '</s>', '~1'), '[/INST]', '~2'), '[INST]', '~3'), '<s>', '~4') AS told,
                 row_number() OVER same - 1 AS k, coalesce(lag(role) OVER same, 'start') AS state, count(*) OVER (PARTITION BY conv_id) AS n
          FROM c WINDOW same AS (PARTITION BY conv_id ORDER BY turn, role, text)),
        f AS (
          SELECT *, CASE WHEN state || '>' || role NOT IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') THEN k
                         WHEN k = n - 1 AND role <> 'assistant' THEN n END AS bad FROM e)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<s>[INST]  [/INST]</s>') + length(role) + length(told)) AS BIGINT) AS formatted_chars,
               min(bad) IS NULL AS valid, CAST(min(bad) AS INTEGER) AS bad_turn
        FROM f GROUP BY conv_id""",
    "op11_collocations": r"""
        WITH p AS (
          SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
              FROM w, (VALUES (1), (2), (3)) AS depth(k)),
        f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL),
        words AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY 1),
        s AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS s, unnest(range(1, k)) AS j FROM f WHERE k > 1 AND n >= 10),
        c AS (
          SELECT s.lang, s.k, s.phrase, a, j, x.n AS l, y.n AS r, (1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS score
          FROM s JOIN f x ON x.lang = s.lang AND x.phrase = array_to_string(s[1:j], ' ')
                 JOIN f y ON y.lang = s.lang AND y.phrase = array_to_string(s[j + 1:], ' ')),
        b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        o AS (
          SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b
          WHERE NOT EXISTS (
            SELECT 1 FROM (SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS sub
                           FROM b WHERE k = 3) t
            WHERE t.lang = b.lang AND t.sub = b.phrase AND 100 * t.a >= 50 * b.a))
        SELECT lang, rank, phrase, a, l, r, CAST(words.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM o JOIN words USING (lang) WHERE rank <= 2000""",
    "op12_conversation_repair": r"""
        WITH k AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS name FROM conversations),
        z AS (  -- a checksum bit by bit: each byte, then seven more steps
          SELECT *, xor(list_reduce(flatten(list_transform(name, lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
                                    lambda h, x: xor(xor(h, x) >> 1, 3988292384 * (xor(h, x) & 1)), 4294967295), 4294967295) % 20 AS z FROM k),
        d AS (
          SELECT conv_id, turn, CASE WHEN z = 4 THEN 'user' ELSE role END AS role,
                 CASE z WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(CASE WHEN z = 3 THEN [0, 1] ELSE [0] END) AS copy
          FROM z WHERE z <> 0),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos, left(role, 1) AS i FROM d),
        f AS (
          SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS two,
                 CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2
                      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM n),
        c AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                 count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                 count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal,
                 list({'i': i, 'fault': fault, 'role': role, 'text': text} ORDER BY pos) AS rows
          FROM f GROUP BY conv_id),
        -- least (cost, audit) at the start, after a system turn, inside a pair and after one
        m AS (
          SELECT *, list_reduce(rows, lambda s, x:
            list_transform([list_transform(
              [CASE WHEN x.fault IN (1, 2) THEN 1000000000 WHEN x.fault = 3 THEN 5 ELSE 0 END], lambda t: [
                {'c': s[1].c + 2, 'a': s[1].a || 'D'},
                least({'c': s[2].c + 2, 'a': s[2].a || 'D'}, {'c': s[1].c + t + CASE WHEN x.i = 's' THEN 0 ELSE 1000000000 END, 'a': s[1].a || 'K'}),
                list_min(list_concat([{'c': s[3].c + 2, 'a': s[3].a || 'D'}],
                  list_transform([s[1], s[2], s[4]], lambda q: {'c': q.c + t + CASE WHEN x.i = 'u' THEN 0 ELSE 1 END, 'a': q.a || CASE WHEN x.i = 'u' THEN 'K' ELSE 'R' END}))),
                least({'c': s[4].c + 2, 'a': s[4].a || 'D'}, {'c': s[3].c + t + CASE WHEN x.i = 'a' THEN 0 ELSE 1 END, 'a': s[3].a || CASE WHEN x.i = 'a' THEN 'K' ELSE 'R' END})
              ])[1]], lambda b:
              list_transform([list_min([b[3], {'c': b[1].c + 5, 'a': b[1].a || 'I'}, {'c': b[2].c + 5, 'a': b[2].a || 'I'}, {'c': b[4].c + 5, 'a': b[4].a || 'I'}])],
                             lambda u: [b[1], b[2], u, least(b[4], {'c': u.c + 5, 'a': u.a || 'I'})])[1])[1],
            [{'c': 0, 'a': ''}, {'c': 1000000000, 'a': ''}, {'c': 5, 'a': 'I'}, {'c': 10, 'a': 'II'}]) AS s FROM c),
        e AS (SELECT *, least(s[1], s[4]) AS best FROM m),
        r AS (
          SELECT *, list_reduce(string_split(best.a, ''), lambda h, x: CASE
            WHEN x = 'D' THEN {'u': h.u, 'k': h.k + 1, 't': h.t}
            WHEN x = 'K' THEN {'u': rows[h.k].i = 'u', 'k': h.k + 1, 't': list_append(h.t, rows[h.k].role || ':' || rows[h.k].text)}
            WHEN x = 'R' THEN {'u': NOT h.u, 'k': h.k + 1, 't': list_append(h.t, CASE WHEN h.u THEN 'assistant:' ELSE 'user:' END || rows[h.k].text)}
            ELSE {'u': NOT h.u, 'k': h.k, 't': list_append(h.t, CASE WHEN h.u THEN 'assistant:' ELSE 'user:' END)} END,
            {'u': false, 'k': 1, 't': []::VARCHAR[]}).t AS told FROM e WHERE best.a <> '')
        SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
               coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(CAST(r.best.c AS BIGINT), 0) AS cost,
               coalesce(r.best.a, '') AS audit, sha256(coalesce(array_to_string(r.told, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
             LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op13_decontamination": r"""
        WITH d AS (
          SELECT doc_id, row_number() OVER () AS row,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (
          SELECT coalesce(item_id::VARCHAR, '') AS item,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        q AS (SELECT DISTINCT item, least(len(w), 10) AS m, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS g
              FROM b WHERE len(w) > 0),
        h AS (
          SELECT row, item, i, m FROM (
            SELECT row, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: {'i': i, 'g': array_to_string(w[i:i + m - 1], ' ')}), recursive := true)
            FROM d, (SELECT DISTINCT m FROM q)) JOIN q USING (m, g)),
        n AS (SELECT row, count(DISTINCT pos) AS n_hit FROM (SELECT row, unnest(range(i, i + m)) AS pos FROM h) GROUP BY row),
        t AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM h) GROUP BY row)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (row) LEFT JOIN t USING (row)""",
}
