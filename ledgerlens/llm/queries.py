"""The registered ``opN_*`` queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bit_sliced, decontam, hilbert, license_scan, line_dedup, packing, prefix_trie, ranked_search, run_index_dedup, simhash, toxicity,
    warc, weighted_sampling)
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.shard_documents(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def op3_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return bit_sliced.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op4_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(read_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "source", "text", F.col("_n_lines").alias("n_lines"),
                          F.col("_n_dropped").alias("n_dropped"))


def op5_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents")).drop("n_kept")


def op6_run_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_index_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """Where the public byte-level tokenizer lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op7_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), added_tokens=True)


def op8_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_simhash_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        decontam.items_digest(F.col("item_ids")).alias("items_sha256"), "contaminated",
                        F.size("near_item_ids").cast("long").alias("n_near_items"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations")).drop("n_ends")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_counterfactual_toxicity": op1_counterfactual_toxicity,
    "op2_hilbert_sharding": op2_hilbert_sharding,
    "op3_bit_sliced_top_k": op3_bit_sliced_top_k,
    "op4_site_line_dedup": op4_site_line_dedup,
    "op5_license_rules": op5_license_rules,
    "op6_run_index_dedup": op6_run_index_dedup,
    "op7_bounded_packing": op7_bounded_packing,
    "op8_warc_zstd": op8_warc_zstd,
    "op9_simhash_mih": op9_simhash_mih,
    "op10_positional_decontamination": op10_positional_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_ranked_search": op12_ranked_search,
    "op13_weighted_sampling": op13_weighted_sampling,
}

ORACLES: dict[str, str] = {
    "op3_bit_sliced_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op4_site_line_dedup": """
        WITH l AS (
            SELECT doc_id, source, i, ls[i] AS line, trim(ls[i], ' ') AS t
            FROM (SELECT doc_id, source, ls, unnest(range(1, len(ls) + 1)) AS i
                  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents))),
        pages AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        common AS (
            SELECT source, t FROM (SELECT source, t, count(DISTINCT doc_id) AS n FROM l WHERE t <> '' GROUP BY source, t) c
            JOIN pages p USING (source) WHERE c.n >= 10 AND c.n > 0.05::DOUBLE * p.n),
        kept AS (
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE common.t IS NOT NULL) AS n_dropped,
                   coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE common.t IS NULL), '') AS text
            FROM l LEFT JOIN common USING (source, t) GROUP BY doc_id)
        SELECT d.doc_id, d.source, kept.text, coalesce(n_lines, 0)::BIGINT AS n_lines,
               coalesce(n_dropped, 0)::BIGINT AS n_dropped
        FROM documents d LEFT JOIN kept USING (doc_id)""",
    "op8_warc_zstd": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN newest END AS refers_to
        FROM g""",
    "op10_positional_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(list_slice(w, i, i + 12), ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT k FROM win),
        grams AS (
            SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS g
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes WHERE len(w) >= k)),
        m AS (SELECT doc_id, item_id, p, grams.k AS k FROM grams JOIN win ON grams.k = win.k AND grams.g = win.g),
        hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS pos FROM m)
                GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY doc_id),
        phrases AS (SELECT row_number() OVER () AS wid, item_id, k, string_split(g, ' ') AS ws FROM win),
        places AS (SELECT wid, item_id, k, unnest(ws) AS word, unnest(range(k)) AS o FROM phrases),
        pos AS (SELECT doc_id, word, p FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d)
                WHERE word IN (SELECT word FROM places)),
        rarest AS (SELECT wid, arg_min({'word': word, 'o': o}, n) AS r FROM places
                   JOIN (SELECT word, count(*) AS n FROM pos GROUP BY word) USING (word) GROUP BY wid, k HAVING count(*) = k),
        starts AS (SELECT DISTINCT wid, doc_id, p - r.o + s AS base FROM rarest JOIN pos ON word = r.word, range(-2, 3) AS t(s)),
        near AS (SELECT doc_id, count(DISTINCT item_id) AS n FROM (
                   SELECT wid, doc_id, base, any_value(item_id) AS item_id
                   FROM starts JOIN places USING (wid) JOIN pos USING (doc_id, word)
                   WHERE p BETWEEN base + o - 2 AND base + o + 2 GROUP BY wid, doc_id, base, k HAVING count(DISTINCT o) = k)
                 GROUP BY doc_id)
        SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
               coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
               coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= coalesce(len(w), 0) AS contaminated,
               coalesce(near.n, 0)::BIGINT AS n_near_items
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)""",
    "op11_prefix_trie": """
        WITH t AS (
            SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
            FROM conversations WHERE conv_id IS NOT NULL),
        given AS (
            SELECT c, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, md5(length(r) || ':' || r || x)) AS l FROM t GROUP BY c),
        opening AS (
            SELECT c, l, c - c % 100 AS home, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, [ascii(s)::BIGINT FOR s IN string_split(c::VARCHAR, '')]),
                lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT FOR i IN range(8)]),
                                         lambda z, i: xor(z >> 1, 3988292384 * (z & 1))))) % 6 AS h
            FROM given),
        rebuilt AS (
            SELECT o.c, list_concat(coalesce(list_slice(g.l, 1, h), []), list_slice(o.l, h + 1, len(o.l))) AS l
            FROM opening o LEFT JOIN given g ON g.c = o.home),
        paths AS (
            SELECT c, d, len(l) AS n, md5(to_json(list_slice(l, 1, d))::VARCHAR) AS k, md5(to_json(list_slice(l, 1, d - 1))::VARCHAR) AS up,
                   CASE WHEN d > 0 THEN length(l[d].x) ELSE 0 END AS chars
            FROM (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM rebuilt)),
        nodes AS (
            SELECT d, k, CASE WHEN d > 0 THEN min(up) END AS up, min(c) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * min(chars) AS saved,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = n), '')) AS ends_sha256
            FROM paths GROUP BY d, k),
        linked AS (
            SELECT a.*, p.conv_id AS parent_conv_id,
                   (SELECT count(*) FROM nodes b WHERE b.up = a.k AND b.d = a.d + 1) AS n_children
            FROM nodes a LEFT JOIN nodes p ON p.k = a.up AND p.d = a.d - 1),
        sums AS (
            SELECT p.d, p.k, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum(u.saved)::BIGINT AS saved_tokens
            FROM linked u JOIN paths p ON p.c = u.conv_id AND p.d <= u.d GROUP BY p.d, p.k)
        SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        FROM linked JOIN sums USING (d, k)""",
    "op12_ranked_search": r"""
        WITH d AS (
            SELECT doc_id, t.term, count(*) AS tf FROM documents, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t(term) GROUP BY doc_id, t.term),
        q AS (
            SELECT item_id, t.term, count(*) AS times FROM benchmark, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t(term) GROUP BY item_id, t.term),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM d GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
        w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM d, totals GROUP BY term, docs),
        s AS (
            SELECT item_id, doc_id,
                   sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN d USING (term) JOIN sizes USING (doc_id), totals GROUP BY item_id, doc_id)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 10""",
}
