"""The operators as queries over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoweave.llm import exact_dedup, language, maxscore, packing, pair_index, pieces, simhash, spelling, suffix_dedup, template_lines, token_counts, topk_search, toxicity
from cartoweave.llm.common import table


def op1_kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op2_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _remainder(parts: int):
    """The part of a document; rows without id are in none."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts, F.lit(-1))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(F.col("doc_id").isNotNull() & (_remainder(4) != 2)))
    found = language.predict(docs, model, reject=False)
    return found.select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score", "trusted")


def op5_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op6_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = template_lines.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_heavy_hitter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_pigeonring_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


def op9_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(F.col("doc_id").isNotNull() & (_remainder(5) != 0)))
    return toxicity.score(docs, model).select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", "predicted")


def op10_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents"), decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_reduced_alphabet_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pair_index.encode(table(spark, sf_dir, "documents"), decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_block_max_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_kd_tree_top_k,
        op2_hilbert_packing,
        op3_suffix_array_dedup,
        op4_language_id,
        op5_prefix_token_counts,
        op6_template_lines,
        op7_heavy_hitter_dedup,
        op8_pigeonring_simhash,
        op9_factorization_toxicity,
        op10_piece_round_trip,
        op11_reduced_alphabet_variants,
        op12_pair_index_bpe,
        op13_block_max_maxscore,
    )
}

ORACLES = {
    "op1_kd_tree_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
            WHERE len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT * FROM r WHERE rank <= 5
    """,
    "op6_template_lines": template_lines.ORACLE,
    "op7_heavy_hitter_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n
    """,
    # The checksum goes byte by byte over a table made from its polynomial; words one edit
    # apart share what is left when a letter goes from one or both.
    "op11_reduced_alphabet_variants": r"""
        WITH RECURSIVE polynomial AS (
            SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS sums
        ), runs AS (
            SELECT doc_id, run, count(*) AS times FROM (
                SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
                FROM documents
            ) WHERE length(run) >= 7 GROUP BY doc_id, run
        ), coded AS (
            SELECT doc_id, run, times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS digits FROM runs
        ), summed AS (
            SELECT run, times, xor(list_reduce(
                list_transform(range(1, length(digits), 2), lambda i: CAST('0x' || substring(digits, CAST(i AS INTEGER), 2) AS BIGINT)),
                lambda c, b: xor(c >> 8, sums[1 + (xor(c, b) & 255)]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
            FROM coded, polynomial
        ), words AS (
            SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
                SELECT times, CASE WHEN h % 31 = 0 THEN substring(run, 1, CAST(h % length(run) AS INTEGER)) || substring(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word
                FROM summed
            ) WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
        ), cuts AS (
            SELECT word, i, substring(word, 1, i) || substring(word, i + 2) AS rest FROM (SELECT word, CAST(unnest(range(length(word))) AS INTEGER) AS i FROM words)
        ), near AS (
            SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.rest = w.word
            UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word
        ), best AS (
            SELECT a, count(*) AS n_near, min({'less': -n, 'word': b}) AS top FROM near JOIN words ON b = word GROUP BY a
        ), held AS (
            SELECT word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN -top.less >= 10 * n THEN top.word END AS form, CASE WHEN -top.less >= 10 * n THEN -top.less END AS form_n
            FROM words LEFT JOIN best ON word = a
        ), walk AS (
            SELECT word, word AS root FROM held
            UNION ALL
            SELECT walk.word, held.form FROM walk JOIN held ON walk.root = held.word WHERE held.form IS NOT NULL
        ), ends AS (
            SELECT walk.word, walk.root FROM walk JOIN held ON walk.root = held.word WHERE held.form IS NULL
        )
        SELECT held.word, form, root, n, n_near, form_n FROM held JOIN ends ON held.word = ends.word
    """,
    "op13_block_max_maxscore": r"""
        WITH t AS (
            SELECT row_number() OVER () AS d, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), q AS (
            SELECT row_number() OVER () AS i, item_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM benchmark
        ), c AS (
            SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM t
        ), p AS (
            SELECT d, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
            FROM (SELECT d, doc_id, len(terms) AS n, unnest(terms) AS term FROM t) GROUP BY d, term
        ), w AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM p, c GROUP BY term
        ), a AS (
            SELECT i, any_value(item_id) AS item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(terms) AS term FROM q) GROUP BY i, term
        ), s AS (
            SELECT i, any_value(a.item_id) AS item_id, d, any_value(doc_id) AS doc_id,
                   CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // length)))) AS BIGINT) AS score
            FROM a JOIN w USING (term) JOIN p USING (term), c GROUP BY i, d
        ), r AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
            FROM s WHERE score > 0
        )
        SELECT * FROM r WHERE rank <= 20
    """,
}
