r"""Dropping lines that recur across documents, by a log-template tree.

A line's tokens go down a tree of fixed depth: first by how many there are, then by the
leading ``DEPTH`` tokens, where a token with a digit is a field (``<*>``). In a leaf that
lines of at least ``min_docs`` documents reach, a later token stays in the template if at
least ``min_docs`` lines (counted once per document) have it at that place; all others
are fields. A template recurs if at least ``min_docs`` documents have a line of it, at
least ``similarity`` of its tokens are the same in all its lines or hold a digit in all,
and at least ``least`` are not fields. Lines of recurring templates go, and so do lines
that are the same token for token in at least ``min_docs`` documents, digits or not.

All steps are built-in expressions. First only hashes of leaves travel, to find the shared
ones; then lines travel once. Templates are worked out on the distinct lines of shared
leaves, so a line that a third of all documents hold is one row there, and on hashes of
their tokens. Joins are on hashes of leaf, line and template, which Spark can split where
one is frequent.

Defined results: null text is empty; lines end at ``\n``; white space around and between
tokens does not count; blank lines stay; rows that repeat a ``doc_id`` count as one
document, each with its own text, and so do all rows without one; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoweave.llm.common import staged, texts

DEPTH = 3
MIN_DOCS = 3
SIMILARITY = 0.75
LEAST = 0.25
FIELD = "<*>"
BLANK = r"[\x20\x09-\x0D]+"


def _tokens(line: Column) -> Column:
    """Tokens of a line that is not blank; most lines are cut at single spaces."""
    odd = line.rlike(r"[\x09-\x0D]|\x20\x20|^\x20|\x20$")
    return F.when(odd, F.filter(F.split(line, BLANK), lambda t: t != "")).otherwise(F.split(line, " "))


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(FIELD)).otherwise(token)


def _leaf(tokens: Column, depth: int) -> Column:
    return F.xxhash64(F.size(tokens), F.array_join(F.transform(F.slice(tokens, 1, depth), _masked), " "))


def recurring_lines(source: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY, least: float = LEAST) -> DataFrame:
    """``doc_id, tag, dropped``: the places (from 0) of the lines to drop in the texts of
    ``source(doc_id, tag, lines)`` that have any."""
    full = F.filter("lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    leaves = F.transform(F.transform(full, _tokens), lambda tokens: _leaf(tokens, depth))
    # Rows, not documents, are counted here: no leaf is missed, the documents come later.
    shared = source.select(F.explode(F.array_distinct(leaves)).alias("leaf")).groupBy("leaf").count().where(F.col("count") >= min_docs).select("leaf")

    lines = source.select("doc_id", "tag", F.posexplode("lines").alias("place", "line")).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    cut = lines.select("doc_id", "tag", "place", _tokens(F.col("line")).alias("tokens"))
    plain = F.array_join("tokens", " ")
    masked = F.when(plain.rlike("[0-9]"), F.array_join(F.transform("tokens", _masked), " ")).otherwise(plain)
    # Templates tell all recurring lines but those that are nearly all digits.
    plainly = F.size(F.filter("tokens", lambda t: ~t.rlike("[0-9]"))) / F.size("tokens") < least
    exact = F.when(plain.rlike("[0-9]") & plainly, F.xxhash64(plain))
    spread = cut.select("doc_id", "tag", "place", _leaf(F.col("tokens"), depth).alias("leaf"), masked.alias("body"), exact.alias("exact"))
    # Leaves and drops grow with the corpus: they are never broadcast, whatever their size.
    held = staged(spread.join(shared.hint("merge"), "leaf").select("doc_id", "tag", "place", "leaf", F.xxhash64("leaf", "body").alias("line"), "body", "exact"))

    # One row per distinct line, with the number of documents that hold it.
    docs = held.select("line", "doc_id").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("docs"))
    bodies = held.groupBy("line").agg(F.first("leaf").alias("leaf"), F.first("body").alias("body"))
    distinct = staged(bodies.join(docs, "line").select("line", "leaf", "docs", F.split("body", " ").alias("tokens")))

    # Tokens behind the leading ones, as hashes of leaf, place and token.
    later = distinct.select("line", "leaf", "docs", F.posexplode("tokens").alias("at", "token")).where((F.col("at") >= depth) & (F.col("token") != FIELD))
    later = later.select("line", "docs", "at", F.xxhash64("leaf", "at", "token").alias("key"))
    constant = later.groupBy("key").agg(F.sum("docs").alias("seen")).where(F.col("seen") >= min_docs).select("key")
    stays = later.join(constant, "key").groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("at", "key"))).alias("rest"))
    leading = F.size(F.filter(F.slice("tokens", 1, depth), lambda t: t != FIELD))
    digits = F.size(F.filter("tokens", lambda t: t == FIELD))
    constants = F.col("leading") + F.coalesce("n", F.lit(0))
    templates = staged(
        distinct.select("line", "leaf", F.size("tokens").alias("size"), leading.alias("leading"), digits.alias("digits"))
        .join(stays, "line", "left")
        .where(((constants + F.col("digits")) / F.col("size") >= similarity) & (constants / F.col("size") >= least))
        # The leaf holds the leading tokens and the length, so this is the template.
        .select("line", F.xxhash64("leaf", "rest").alias("template"))
    )
    recurring = held.select("line", "doc_id").join(templates, "line").select("template", "doc_id").distinct().groupBy("template").count().where(F.col("count") >= min_docs).select("template")
    gone = templates.join(recurring, "template").select("line")
    same = held.where("exact IS NOT NULL")
    often = same.select("exact", "doc_id").distinct().groupBy("exact").count().where(F.col("count") >= min_docs).select("exact")
    places = held.select("doc_id", "tag", "place", "line").join(gone, "line").drop("line").unionByName(same.select("doc_id", "tag", "place", "exact").join(often, "exact").drop("exact"))
    return places.groupBy("doc_id", "tag").agg(F.collect_set("place").alias("dropped"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY, least: float = LEAST) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` of every row: the text without its lines of
    recurring templates."""
    source = texts(docs, id_col, text_col).select(F.col("__id").alias("doc_id"), F.xxhash64("__text").alias("tag"), F.split("__text", "\n").alias("lines"))
    dropped = staged(recurring_lines(source, depth, min_docs, similarity, least).select(F.col("doc_id").alias("__own"), F.col("tag").alias("__tag"), "dropped"))
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda line, i: ~F.array_contains(F.col("dropped"), i)))
    own = F.col("doc_id").eqNullSafe(F.col("__own")) & (F.col("tag") == F.col("__tag"))
    return source.join(dropped.hint("merge"), own, "left").select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("text"),
    )


ORACLE = r"""
    WITH lines AS (
        SELECT r, doc_id, coalesce(CAST(doc_id AS VARCHAR), 'none') AS d, unnest(range(len(l))) AS place, unnest(l) AS line
        FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
    ), words AS (
        SELECT r, d, place, [t for t in regexp_split_to_array(line, '[\x20\x09-\x0D]+') if t <> ''] AS words
        FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    ), tokens AS (
        SELECT r, d, place, array_to_string(words, ' ') AS plain, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END for t in words] AS tokens FROM words
    ), leaves AS (
        SELECT *, len(tokens) || ' ' || array_to_string(tokens[1:3], ' ') AS leaf, array_to_string(tokens, ' ') AS line FROM tokens
    ), held AS (
        SELECT * FROM leaves WHERE leaf IN (SELECT leaf FROM leaves GROUP BY leaf HAVING min(r) <> max(r))
    ), uniq AS (
        SELECT leaf, line, any_value(tokens) AS tokens, count(DISTINCT d) AS docs FROM held GROUP BY leaf, line
    ), spots AS (
        SELECT leaf, line, docs, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token FROM uniq
    ), seen AS (
        SELECT leaf, pos, token, sum(docs) >= 3 OR pos < 3 AS often FROM spots GROUP BY leaf, pos, token
    ), templates AS (
        SELECT leaf, line, string_agg(CASE WHEN often THEN token ELSE '<*>' END, ' ' ORDER BY pos) AS template
        FROM spots JOIN seen USING (leaf, pos, token)
        GROUP BY leaf, line HAVING avg(CASE WHEN often OR token = '<*>' THEN 1 ELSE 0 END) >= 0.75 AND avg(CASE WHEN often AND token <> '<*>' THEN 1 ELSE 0 END) >= 0.25
    ), recurring AS (
        SELECT leaf, template FROM held JOIN templates USING (leaf, line) GROUP BY leaf, template HAVING count(DISTINCT d) >= 3
    ), gone AS (
        SELECT r, place FROM held JOIN templates USING (leaf, line) JOIN recurring USING (leaf, template)
        UNION SELECT r, place FROM held WHERE plain IN (SELECT plain FROM held GROUP BY plain HAVING count(DISTINCT d) >= 3)
    ), marked AS (
        SELECT l.r, l.doc_id, l.place, l.line, g.place IS NOT NULL AS dropped FROM lines l LEFT JOIN gone g USING (r, place)
    )
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, sum(CASE WHEN dropped THEN 1 ELSE 0 END)::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY r
"""
