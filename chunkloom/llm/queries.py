"""The registered queries pN_... of the training-data operators and the SQL that some can be checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm import credentials, docpairs, grouped_split, handwritten, leaks, neighbours, overlap, splitting, stuffing, tokenize
from chunkloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return credentials.find(table(spark, d, "chunks")).select("chunk_id", "line_no").distinct()


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    return credentials.redacted(table(spark, d, "chunks"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.pairs(table(spark, d, "chunk_vectors"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(table(spark, d, "chunks")).select("chunk_id").distinct()


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(table(spark, d, "chunks"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return grouped_split.violations(table(spark, d, "chunks"), table(spark, d, "repo_links")).select("repo_name").distinct()


def p4_assigned(spark: SparkSession, d: str) -> DataFrame:
    return grouped_split.assign(table(spark, d, "chunks"), table(spark, d, "repo_links"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlaps(table(spark, d, "chunks")).select("chunk_id_a", "chunk_id_b")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.report(table(spark, d, "chunks"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return handwritten.files(table(spark, d, "chunks")).select("repo_name", "path").distinct()


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return docpairs.found(table(spark, d, "chunks"))


def p7_pairs(spark: SparkSession, d: str) -> DataFrame:
    return docpairs.documented_functions(table(spark, d, "chunks"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode_corpus(table(spark, d, "documents"), vocabulary=tokenize.vocabulary_path())


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "heldout_items")).select("doc_id", "item_id").distinct()


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "heldout_items")
    return leaks.leak_report(leaks.leaks(table(spark, d, "documents"), items), items)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.stuffed(table(spark, d, "documents")).select(F.col("doc_id"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (p1_found, p1_redacted, p2_found, p3_found, p3_pieces, p4_found, p4_assigned, p5_found, p5_report, p6_found, p7_found, p7_pairs, p8_ids, p9_found, p9_report, p10_found)
}

_TOK = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\t-\r ]"


def _canonical_sql(c: str) -> str:
    bare = rf"regexp_replace(lower(trim({c})), '^(?:[a-z][a-z0-9+.\-]*://[^/\s]*/+|[^/@\s]*@[^/:\s]+[:/]+)', '')"
    owner = rf"regexp_extract({bare}, '^/*([^/\s?#]+)/+([^/\s?#@]+)', 1)"
    repo = rf"regexp_replace(regexp_extract({bare}, '^/*([^/\s?#]+)/+([^/\s?#@]+)', 2), '(?:\.git)+$', '')"
    return f"CASE WHEN {owner} <> '' AND {repo} <> '' THEN {owner} || '/' || {repo} ELSE nullif(lower(trim({c})), '') END"


_P4_SQL = f"""WITH RECURSIVE l AS (SELECT {_canonical_sql('src_repo')} AS a, {_canonical_sql('dst_repo')} AS b FROM repo_links WHERE lower(trim(relation)) IN ('renamed_to', 'moved_to', 'forked_from', 'mirror_of')),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), reach(n, m) AS (SELECT a, a FROM e UNION SELECT r.n, e.b FROM reach r JOIN e ON r.m = e.a), label AS (SELECT n, min(m) AS label FROM reach GROUP BY n),
c AS (SELECT repo_name, {_canonical_sql('repo_name')} AS n, nullif(trim(eval_split), '') AS s FROM chunks WHERE repo_name IS NOT NULL)
SELECT min(repo_name) AS repo_name FROM c LEFT JOIN label USING (n) WHERE n IS NOT NULL GROUP BY coalesce(label, n) HAVING count(DISTINCT s) > 1"""

_P5_PAIRS = f"""WITH b AS (SELECT DISTINCT chunk_id, trim(eval_split) IN ('eval_test', 'eval_valid') AS is_eval, text, query_text FROM chunks WHERE trim(eval_split) IN ('eval_test', 'eval_valid', 'index_only')),
t AS (SELECT chunk_id, is_eval, regexp_extract_all(lower(text), '{_TOK}') AS k FROM b WHERE text IS NOT NULL),
g AS (SELECT DISTINCT chunk_id, is_eval, k[i] || chr(1) || k[i+1] || chr(1) || k[i+2] AS g FROM (SELECT *, unnest(range(1, len(k) - 1)) AS i FROM t WHERE len(k) >= 30)),
n AS (SELECT chunk_id, count(*) AS n FROM (SELECT DISTINCT chunk_id, g FROM g) GROUP BY chunk_id),
o AS (SELECT x.chunk_id AS e, y.chunk_id AS t, count(*) AS common FROM g x JOIN g y ON x.g = y.g AND x.is_eval AND NOT y.is_eval GROUP BY ALL),
p AS (SELECT e, t FROM o JOIN n a ON a.chunk_id = e JOIN n z ON z.chunk_id = t WHERE common::DOUBLE / (a.n + z.n - common) >= 0.7),
q AS (SELECT chunk_id, is_eval, regexp_extract_all(lower(query_text), '[\\p{{L}}\\p{{N}}]+') AS w FROM b),
r AS (SELECT x.chunk_id AS e, y.chunk_id AS t FROM q x JOIN q y ON x.w = y.w AND x.is_eval AND NOT y.is_eval WHERE len(x.w) >= 8),
x AS (SELECT DISTINCT e, t FROM (SELECT * FROM p UNION SELECT * FROM r) WHERE e <> t)
"""
_P5_SQL = _P5_PAIRS + "SELECT DISTINCT least(e, t) AS chunk_id_a, greatest(e, t) AS chunk_id_b FROM x"
_P5_REPORT_SQL = _P5_PAIRS.rstrip() + """,
i AS (SELECT chunk_id, min(eval_split) AS eval_split, min(repo_name) AS repo_name FROM chunks WHERE trim(eval_split) IN ('eval_test', 'eval_valid') GROUP BY chunk_id),
h AS (SELECT e AS chunk_id, count(*) AS n FROM x GROUP BY e)
SELECT eval_split, repo_name, count(*) AS chunks, count(n) AS leaked, CAST(coalesce(sum(n), 0) AS BIGINT) AS pairs FROM i LEFT JOIN h USING (chunk_id) GROUP BY ALL"""

_P9_SQL = r"""WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents), i AS (SELECT item_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM heldout_items),
dg AS (SELECT DISTINCT id, array_to_string(w[k:k+9], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 8)) AS k FROM d WHERE len(w) >= 10)),
ig AS (SELECT DISTINCT id, array_to_string(w[k:k+9], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 8)) AS k FROM i WHERE len(w) >= 10))
SELECT DISTINCT dg.id AS doc_id, ig.id AS item_id FROM dg JOIN ig USING (g)"""

#: Queries that SQL cannot express in a usable time have none; tests/llm holds them against brute force.
ORACLE: dict[str, str] = {
    "p3_found": f"SELECT DISTINCT chunk_id FROM chunks WHERE len(regexp_extract_all(text, '{_TOK}')) > 512",
    "p4_found": _P4_SQL,
    "p5_found": _P5_SQL,
    "p5_report": _P5_REPORT_SQL,
    "p9_found": _P9_SQL,
}
