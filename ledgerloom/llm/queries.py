"""The corpus queries of the entry point: opN_<name>(spark, sf_dir)."""

from __future__ import annotations

from ledgerloom.llm import decontamination, exact_dedup, html_main, langid, lm_scoring, mixing, near_dedup, packing, phrases, prefix_trie, quality, toxicity, warc
from ledgerloom.llm.common import table


def op1_hilbert_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_line_chain_quality(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_context_mixing(spark, sf_dir):
    return lm_scoring.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_rank_profiles(spark, sf_dir):
    return langid.identified(table(spark, sf_dir, "documents"))


def op5_coordinate_join(spark, sf_dir):
    return near_dedup.classes_of(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4)


def op6_template_removal(spark, sf_dir):
    return html_main.extract(table(spark, sf_dir, "pages"))


def op7_stream_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_sharded_warc(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages")).drop("url", "payload")


def op9_budget_mixing(spark, sf_dir):
    return mixing.sizes_taken(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op10_chain_toxicity(spark, sf_dir):
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_tiled_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_broadcast_windows(spark, sf_dir):
    return decontamination.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_turn_matrix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_hilbert_packing, op2_line_chain_quality, op3_context_mixing, op4_rank_profiles, op5_coordinate_join, op6_template_removal, op7_stream_dedup, op8_sharded_warc, op9_budget_mixing, op10_chain_toxicity, op11_tiled_phrases, op12_broadcast_windows, op13_turn_matrix_trie)}

ORACLES: dict[str, str] = {
    "op7_stream_dedup": r"""
        WITH n AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
        g AS (SELECT norm, count(*) AS group_size, arg_min(doc_id, row(-length(t), doc_id)) AS keep_id FROM n GROUP BY norm)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256 FROM n JOIN g USING (norm)
    """,
    "op8_sharded_warc": r"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        q AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
        r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM q)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND head <> page_id THEN head END AS refers_to
        FROM r
    """,
    "op11_tiled_phrases": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        g AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 6) s(m) WHERE len(w) >= m),
        f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
        c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 100),
        inner_of AS (SELECT lang, a, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM c, range(2, 5) s(k) WHERE k < m)),
        over_ AS (SELECT lang, phrase, max(a) AS over_a FROM inner_of GROUP BY ALL),
        kept AS (SELECT c.* FROM c LEFT JOIN over_ o USING (lang, phrase) WHERE over_a IS NULL OR 100 * over_a < 100 * c.a),
        cuts AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
        sides AS (SELECT cuts.lang, cuts.phrase, a, k, l.f AS l, r.f AS r FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(ws[1:k], ' ') JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(ws[k + 1:], ' ')),
        scored AS (SELECT lang, phrase, a, l, r, k, n, ((1000::HUGEINT * a * n) // (l::HUGEINT * r))::BIGINT AS score FROM sides JOIN n USING (lang)),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
        SELECT lang, rank, phrase, a, l, r, n, score FROM placed WHERE rank <= 2000
    """,
    "op12_broadcast_windows": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') AS t FROM documents),
        dw AS (SELECT rid, doc_id, CASE WHEN t = '' THEN [] ELSE string_split(t, ' ') END AS w FROM d),
        b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') AS t FROM benchmark),
        bw AS (SELECT item, string_split(t, ' ') AS w FROM b WHERE t <> ''),
        bi AS (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM bw),
        wins AS (SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS size FROM bi),
        sizes AS (SELECT DISTINCT size FROM wins),
        di AS (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM dw, sizes WHERE len(w) >= size),
        dwin AS (SELECT rid, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM di),
        hits AS (SELECT rid, i, dwin.size, item FROM dwin JOIN wins USING (win)),
        places AS (SELECT DISTINCT rid, unnest(range(i, i + size)) AS at FROM hits),
        n AS (SELECT rid, count(*) AS n_hit FROM places GROUP BY rid),
        its AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY rid)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM dw LEFT JOIN n USING (rid) LEFT JOIN its USING (rid)
    """,
    "op13_turn_matrix_trie": r"""
        WITH RECURSIVE t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
        i AS (SELECT conv_id, turn, role, text, md5(concat(octet_length(encode(role)), ':', role, text)) AS id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM t),
        x AS (SELECT conv_id, id, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(text, 1, 64), id) - 1 AS r FROM i),
        c AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM x),
        crc(conv_id, s, k, v) AS (
            SELECT conv_id, s, 0, 4294967295::BIGINT FROM c
            UNION ALL
            SELECT conv_id, s, k + 1, (CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384::BIGINT) ELSE y // 2 END)
            FROM (SELECT conv_id, s, k, CASE WHEN k % 8 = 0 THEN xor(v, ascii(s[k // 8 + 1])::BIGINT) ELSE v END AS y FROM crc WHERE k < 8 * len(s))
        ),
        h AS (SELECT conv_id, xor(v, 4294967295::BIGINT) % 4 AS h FROM crc WHERE k = 8 * len(s)),
        re AS (
            SELECT h.conv_id, 0 AS part, r, id, words FROM h JOIN x ON x.conv_id = h.conv_id - h.conv_id % 20 WHERE r < h
            UNION ALL SELECT x.conv_id, 1, r, id, words FROM x JOIN h USING (conv_id) WHERE r >= h
        ),
        l AS (SELECT conv_id, list(id ORDER BY part, r) AS ids, list(words ORDER BY part, r) AS ws FROM re GROUP BY conv_id),
        seqs AS (SELECT c.conv_id, coalesce(ids, []) AS ids, coalesce(ws, []) AS ws FROM c LEFT JOIN l USING (conv_id)),
        pre AS (SELECT conv_id, len(ids) AS size, d, ids[1:d] AS p, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM seqs)),
        node AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d) AS ends FROM pre GROUP BY p, d),
        kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
        full_node AS (SELECT node.*, coalesce(n, 0) AS n_children FROM node LEFT JOIN kids USING (p)),
        up AS (SELECT p[1:a] AS p, sum((n_convs - 1) * w)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_node) GROUP BY 1)
        SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
        FROM full_node f JOIN up USING (p) LEFT JOIN node q ON f.d > 0 AND q.p = f.p[1:f.d - 1]
    """,
}
