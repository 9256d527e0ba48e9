"""The queries of the training-data operators: thin views over the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklake.llm import (chat_format, decontaminate, html_extract, license_scan, line_dedup, ngram_join, packing,
                          periodic_runs, prefix_trie, quality_model, quality_rules, token_counts, warc)
from worklake.llm.common import read_table
from worklake.llm.quality_rules import let, words_of


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe() -> tuple:
    """Arguments of ``packing.encoder`` for the 50k byte vocabulary."""
    import public_tokenizers

    return (_tokenizer("byte_bpe_50k.json"), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_ngram_join(spark, sf):
    return ngram_join.link_components(read_table(spark, sf, "documents"), n=4, percent=85)


def op2_quality_classifier(spark, sf):
    return quality_model.classify(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def op3_html_extraction(spark, sf):
    return html_extract.extract_text(read_table(spark, sf, "pages"))


def op4_decontamination(spark, sf):
    return decontaminate.find_leaks(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op5_packing(spark, sf):
    return packing.pack(read_table(spark, sf, "documents"), byte_bpe())


def op6_quality_rules(spark, sf):
    return quality_rules.apply_rules(read_table(spark, sf, "documents"))


def op7_license_scan(spark, sf):
    return license_scan.scan_licenses(read_table(spark, sf, "documents"))


def op8_token_counts(spark, sf):
    return token_counts.token_counts(read_table(spark, sf, "documents"), _tokenizer("piece_bpe_32k.model"))


def op9_warc(spark, sf):
    return warc.archive_round_trip(spark, read_table(spark, sf, "pages"))


def op10_line_dedup(spark, sf):
    return line_dedup.dedup_lines(read_table(spark, sf, "documents"))


def op11_chat_format(spark, sf):
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    turns = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    return chat_format.digest_conversations(
        chat_format.format_conversations(turns.select("conv_id", "turn", "role", chat_format.text_part(F.col("text")).alias("parts"))))


def repeat_tails(docs):
    """The documents, of which every tenth by crc32 of its id repeats its words periodically from one of them on."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(crc / 10)

    def periodic(words):
        n = F.size(words)
        begin, period = g % n, lambda a: 1 + F.floor((n - a) / (3 + g % 8))

        def repeated(at):
            return F.transform(words, lambda w, i: F.when(i < at["a"], w).otherwise(
                F.get(words, (at["a"] + (i - at["a"]) % at["p"]).cast("int"))))

        return F.when(n > 0, F.array_join(let(F.struct(begin.alias("a"), period(begin).alias("p")), repeated), " "))

    return docs.select("doc_id", F.when(crc % 10 == 0, let(words_of(F.col("text")), periodic)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf):
    return periodic_runs.run_digests(periodic_runs.periodic_runs(repeat_tails(read_table(spark, sf, "documents"))))


def op13_prefix_trie(spark, sf):
    conv = F.col("conv_id")
    return prefix_trie.conversation_trie(
        read_table(spark, sf, "conversations"), base=conv - conv % 5, taken=F.crc32(conv.cast("string").cast("binary")) % 9)


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_quality_classifier, op3_html_extraction, op4_decontamination, op5_packing, op6_quality_rules,
    op7_license_scan, op8_token_counts, op9_warc, op10_line_dedup, op11_chat_format, op12_periodic_runs, op13_prefix_trie)}

_CONTROL = r"\\|<(?:/?role>|/turn>|(?:text|image|audio|document)/>)"

ORACLE_SQL: dict[str, str] = {
    # Every pair that shares a shingle is counted, every link followed.
    "op1_ngram_join": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w FROM documents),
        sets AS (
          SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                   ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FOR i IN range(1, len(w) - 2)] END) AS s FROM words),
        members AS (SELECT doc_id, unnest(s) AS m FROM sets),
        pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM members a JOIN members b ON a.m = b.m AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT x, y FROM pairs JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
                  WHERE 100 * n >= 85 * (len(a.s) + len(b.s) - n)),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, l.y FROM reach r JOIN both_ways l ON l.x = r.y)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(first, doc_id)) AS component_id
        FROM sets LEFT JOIN (SELECT x, min(y) AS first FROM reach GROUP BY x) ON x = doc_id""",
    "op9_warc": """
        WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages),
        originals AS (SELECT digest, min(page_id) AS original FROM payloads WHERE bytes >= 100 GROUP BY digest)
        SELECT page_id, bytes::BIGINT AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN original < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original < page_id THEN original END AS refers_to
        FROM payloads p LEFT JOIN originals o ON o.digest = p.digest""",
    "op11_chat_format": f"""
        WITH given AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
        whole AS (
          SELECT conv_id, count(*) AS n_turns,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
            coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
            sum(length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROL}'))
                + len(regexp_extract_all(text, '{_CONTROL}')) + length('<role></role></turn>') + 1) AS chars
          FROM given GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               chars::BIGINT AS formatted_chars FROM whole""",
    # crc32 bit by bit; a prefix is the chain of its turns' digests, its parent the chain without the last.
    "op13_prefix_trie": """
        WITH convs AS (
          SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
            [4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')],
            lambda crc, b: list_reduce([xor(crc, b)] || range(8), lambda x, _: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        t AS (
          SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
                 coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
        rebuilt AS (
          SELECT c.conv_id, t.pos AS depth, role, text FROM convs c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
          UNION ALL
          SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.pos - c.h, role, text
          FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN convs b ON b.conv_id = c.base),
        prefix AS (
          SELECT conv_id, depth, strlen(text) AS bytes,
                 string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS k FROM rebuilt
          UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
        node AS (SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM prefix GROUP BY k, depth),
        child AS (SELECT left(k, length(k) - 64) AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
        last AS (SELECT conv_id, arg_max(k, depth) AS k FROM prefix GROUP BY conv_id),
        ends AS (SELECT k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM last GROUP BY k),
        below AS (
          SELECT a.k, sum((n.n_convs - 1) * n.bytes) AS saved, count(*) FILTER (WHERE c.k IS NULL) AS n_leaves
          FROM node n JOIN prefix a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN child c ON c.k = n.k GROUP BY a.k)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
               n_leaves, saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
        FROM node n LEFT JOIN node p ON n.depth > 0 AND p.k = left(n.k, length(n.k) - 64)
        LEFT JOIN child c ON c.k = n.k LEFT JOIN ends e ON e.k = n.k JOIN below b ON b.k = n.k""",
}
