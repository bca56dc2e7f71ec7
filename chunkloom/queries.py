"""The registered queries of the engine's own operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.config import Corpus
from chunkloom.functions import docs, keys, text, vectors
from chunkloom.operators import chunking, embedding, metrics, search, sharding
from chunkloom.plans import evaluate, pipeline, publish
from chunkloom.schema import CHUNK_COLUMNS
from chunkloom.sources import files, npy
from chunkloom.sources.files import table
from chunkloom.sources.fs import glob, shared_folder, write_bytes
from chunkloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ALLOW = Corpus().license_allowlist
LANGUAGES = Corpus().languages
SEED = 42
_ALLOW_SQL = ", ".join(f"'{x}'" for x in ALLOW)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def chunks_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks")


#: One row per chunk_id in SQL: the rows of a chunk differ in their snapshot only.
_ONCE = "(SELECT chunk_id, arg_min(language, coalesce(corpus_snapshot,'')) AS language, any_value(text) AS text, any_value(query_text) AS query_text, any_value(eval_split) AS eval_split, any_value(repo_name) AS repo_name FROM chunks GROUP BY chunk_id)"
#: Python's white space, for RE2.
_WS = r"[\t-\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TOK = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\t-\r ]"


def _norm_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


# -- scans, projections, filters -------------------------------------------------------------------------------------


@query("SELECT doc_id, coalesce(nullif(text,''),'') AS content, coalesce(nullif(source,''),'') AS repo_name, 'doc-'||doc_id AS path, coalesce(code_language,'') AS language FROM documents")
def corpus_project_alias(spark, d):
    raw = table(spark, d, "documents").select("doc_id", "text", F.col("source").alias("repository_name"), F.concat(F.lit("doc-"), F.col("doc_id")).alias("filename"), F.col("code_language").alias("language"))
    return raw.select("doc_id", text.first_truthy(F.col("text")).alias("content"), text.first_truthy(F.col("repository_name")).alias("repo_name"), text.first_truthy(F.col("filename")).alias("path"), text.blank_to(F.col("language")).alias("language"))


@query(f"SELECT chunk_id, license, coalesce(license IN ({_ALLOW_SQL}), false) AS publishable, count(*) AS n FROM chunks GROUP BY ALL")
def license_gate(spark, d):
    return chunks_of(spark, d).select("chunk_id", "license", text.is_allowed(F.col("license"), ALLOW).alias("publishable")).groupBy("chunk_id", "license", "publishable").agg(F.count("*").alias("n"))


@query(f"SELECT count(*) AS n_rows, coalesce(bool_or({_norm_sql('text')} <> ''), false) AS any_content, coalesce(bool_or({_norm_sql('repo_name')} <> ''), false) AS any_repo_name, coalesce(bool_or({_norm_sql('license')} <> ''), false) AS any_license FROM chunks")
def corpus_quality_asserts(spark, d):
    return files.quality(chunks_of(spark, d).withColumnRenamed("text", "content"))


@query("SELECT chunk_id, language, path FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY path, chunk_id) AS r FROM (SELECT DISTINCT chunk_id, coalesce(language,'') AS language, coalesce(path,'') AS path FROM chunks)) WHERE r <= 100")
def corpus_cap_per_lang(spark, d):
    rows = chunks_of(spark, d).select("chunk_id", text.blank_to(F.col("language")).alias("language"), text.blank_to(F.col("path")).alias("path")).distinct()
    return sharding.cap_per_group(rows, "language", 100, ["path", "chunk_id"])


@query("SELECT language, coalesce(license,'') AS license, count(*) AS n_chunks, count(DISTINCT chunk_id) AS n_ids FROM chunks WHERE language = 'python' GROUP BY ALL")
def language_scan(spark, d):
    rows = files.read_chunks(spark, f"{d}/chunks.parquet", ["python"]).select("language", text.blank_to(F.col("license")).alias("license"), "chunk_id")
    return rows.groupBy("language", "license").agg(F.count("*").alias("n_chunks"), F.countDistinct("chunk_id").alias("n_ids"))


# -- scalar functions ----------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, md5({_norm_sql('text')}) AS digest, length({_norm_sql('text')}) AS n FROM documents")
def normalize_text(spark, d):
    t = text.normalize_text(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(t).alias("digest"), F.length(t).cast("bigint").alias("n"))


_ID_SQL = f"md5(concat_ws(chr(0), coalesce({_norm_sql('text')},''), coalesce(repo_name,''), coalesce(path,''), coalesce(start_line::VARCHAR,''), coalesce(end_line::VARCHAR,'')))"


@query(f"SELECT DISTINCT chunk_id, {_ID_SQL} AS content_id FROM chunks")
def chunk_id_md5(spark, d):
    made = keys.chunk_id(F.col("text"), F.col("repo_name"), F.col("path"), F.col("start_line"), F.col("end_line"), "md5")
    return chunks_of(spark, d).select("chunk_id", made.alias("content_id")).distinct()


@query("SELECT DISTINCT chunk_id, (('0x'||substr(md5(chunk_id),1,16))::UBIGINT & 9223372036854775807::UBIGINT)::BIGINT AS id64 FROM chunks")
def chunk_int64(spark, d):
    return chunks_of(spark, d).select("chunk_id", keys.int64_of_hex(F.md5("chunk_id")).alias("id64")).distinct()


@query("SELECT DISTINCT chunk_id, (('0x'||substr(chunk_id,1,16))::UBIGINT & 9223372036854775807::UBIGINT)::BIGINT AS id64 FROM chunks")
def chunk_int64_any(spark, d):
    return chunks_of(spark, d).select("chunk_id", keys.chunk_int64(F.col("chunk_id")).alias("id64")).distinct()


@query()
def blake2b_chunk_id(spark, d):
    made = keys.chunk_id(F.col("text"), F.col("repo_name"), F.col("path"), F.col("start_line"), F.col("end_line"))
    return chunks_of(spark, d).select("chunk_id", made.alias("content_id")).distinct()


@query(
    f"""WITH t AS (SELECT DISTINCT chunk_id, coalesce(text,'') AS text FROM chunks),
    u AS (SELECT chunk_id, length(text) AS n, len(regexp_extract_all(text, '{_TOK}')) AS e FROM t)
    SELECT chunk_id, CAST(e AS INT) AS n_exact, CAST(CASE WHEN greatest(1, n//2) < 8 THEN NULL WHEN greatest(1, n//2) <= 512 AND n//5 >= 8 THEN greatest(8, n//3) WHEN e >= 8 THEN e END AS INT) AS n_tokens FROM u"""
)
def token_count_bounds(spark, d):
    rows = chunks_of(spark, d).select("chunk_id", text.blank_to(F.col("text")).alias("text")).distinct()
    counted = rows.withColumn("n_exact", text.count_tokens(F.col("text")))  # once, for it is used twice
    return counted.select("chunk_id", "n_exact", text.bounded_tokens(F.col("text"), F.col("n_exact"), 8, 512).alias("n_tokens"))


@query(
    f"""WITH t AS (SELECT doc_id AS id, regexp_extract_all(coalesce(text,''), '{_TOK}') AS k FROM documents), n AS (SELECT id, k, len(k) AS n FROM t WHERE len(k) > 0),
    w AS (SELECT id, k, unnest(range(CAST(greatest(0, ceil((n-128)/112.0)) AS BIGINT) + 1)) AS win FROM n)
    SELECT id, CAST(win AS INT) AS win, CAST(win*112 AS INT) AS start, CAST(len(k[win*112+1:win*112+128]) AS INT) AS n, array_to_string(k[win*112+1:win*112+128], ' ') AS text FROM w"""
)
def token_windows(spark, d):
    return chunking.token_windows(table(spark, d, "documents"), "doc_id", "text", 128, 16)


def _clean_sql(c: str) -> str:
    one = rf"trim(regexp_replace(regexp_replace(trim({c}), '(?m)^\s*\*\s?', '', 'g'), '\s+', ' ', 'g'))"
    return rf"CASE WHEN regexp_matches({one}, '^.*?[.!?]\s') THEN regexp_extract({one}, '^(.*?[.!?])\s', 1) ELSE {one} END"


@query(f"SELECT DISTINCT chunk_id, {_clean_sql('query_text')} AS first_sentence FROM chunks WHERE query_text IS NOT NULL")
def clean_doc_first_sentence(spark, d):
    return chunks_of(spark, d).where("query_text is not null").select("chunk_id", text.clean_doc(F.col("query_text")).alias("first_sentence")).distinct()


@query(
    f"""WITH b AS (SELECT DISTINCT chunk_id, CASE WHEN query_source='codesearchnet' THEN query_text END AS a, CASE WHEN query_source='docstring' THEN query_text END AS b, CASE WHEN query_source='commit' THEN query_text END AS c FROM chunks),
    q AS (SELECT chunk_id, nullif({_clean_sql('a')},'') AS a, nullif({_clean_sql('b')},'') AS b, nullif({_clean_sql('c')},'') AS c FROM b)
    SELECT chunk_id, coalesce(a,b,c,'') AS query_text, CASE WHEN a IS NOT NULL THEN 'codesearchnet' WHEN b IS NOT NULL THEN 'docstring' WHEN c IS NOT NULL THEN 'commit' ELSE 'none' END AS query_source FROM q"""
)
def assign_query_priority(spark, d):
    def of(source: str):
        return F.when(F.col("query_source") == source, F.col("query_text"))

    rows = chunks_of(spark, d).select("chunk_id", of("codesearchnet").alias("a"), of("docstring").alias("b"), of("commit").alias("c")).distinct()
    return rows.select("chunk_id", text.assign_query(F.col("a"), F.col("b"), F.col("c")).alias("q")).select("chunk_id", "q.query_text", "q.query_source")


@query(
    f"""WITH b AS (SELECT DISTINCT chunk_id, coalesce(text,'') AS text FROM chunks), d AS (SELECT chunk_id, min(query_text) AS doc FROM chunks WHERE query_source='codesearchnet' GROUP BY 1),
    c AS (SELECT chunk_id, min(query_text) AS doc FROM chunks WHERE query_source='commit' GROUP BY 1), q AS (SELECT b.chunk_id, nullif({_clean_sql('d.doc')},'') AS a, nullif({_clean_sql('c.doc')},'') AS c FROM b LEFT JOIN d USING (chunk_id) LEFT JOIN c USING (chunk_id))
    SELECT chunk_id, coalesce(a, c, '') AS query_text, CASE WHEN a IS NOT NULL THEN 'codesearchnet' WHEN c IS NOT NULL THEN 'commit' ELSE 'none' END AS query_source FROM q"""
)
def joined_docs_priority(spark, d):
    def told(source: str):
        return chunks_of(spark, d).where(F.col("query_source") == source).select("chunk_id", F.col("query_text").alias("doc"))

    rows = chunks_of(spark, d).select("chunk_id").distinct()
    rows = pipeline.attach_docs(pipeline.attach_docs(rows, told("codesearchnet"), "a"), told("commit"), "c")
    return rows.select("chunk_id", text.assign_query(F.col("a"), F.lit(None).cast("string"), F.col("c")).alias("q")).select("chunk_id", "q.query_text", "q.query_source")


@query(r"SELECT item_id, 'Instruct: Given a natural language query, retrieve relevant code snippets' || chr(10) || 'Query: ' || text AS wrapped FROM heldout_items")
def query_wrapper(spark, d):
    return table(spark, d, "heldout_items").select("item_id", text.wrap_query("Given a natural language query, retrieve relevant code snippets", F.col("text")).alias("wrapped"))


@query(f"SELECT doc_id, CASE WHEN {_norm_sql('text')} <> '' THEN text ELSE ' ' END AS body FROM documents")
def stripped_fallback(spark, d):
    return table(spark, d, "documents").select("doc_id", text.stripped_or_original(F.lit(" \n"), F.col("text")).alias("body"))


_TRIPLE = r'''(?:"""(?s:(.*?))"""|\'\'\'(?s:(.*?))\'\'\')'''


def _sql(pattern: str) -> str:
    """A pattern within an SQL string."""
    return pattern.replace("\\'", "'").replace("'", "''")


_DEFINED = _sql(r"(?:def|class)\s+\w+\s*\([^)]*\)\s*(?:->[^:]+)?:\s*\n\s*[rub]?" + _TRIPLE)
_BLOCK = r"/\*\*(?s:(.*?))\*/"


def _extract_sql(c: str, language: str) -> str:
    own = f"regexp_extract({c}, '{_DEFINED}', 1) || regexp_extract({c}, '{_DEFINED}', 2)"
    return f"coalesce(CASE WHEN {language} = 'python' AND regexp_matches({c}, '{_DEFINED}') THEN {_clean_sql(own)} ELSE {_clean_sql(f"regexp_extract({c}, '{_BLOCK}', 1)")} END, '')"


def _strip_sql(c: str, language: str) -> str:
    """The leading documentation taken off, as the operator does."""
    header, quoted = r"^(\s*(?:async\s+)?(?:def|class)\b[^\n]*:\s*\n)", r'''(?:"""(?s:.*?)"""|\'\'\'(?s:.*?)\'\'\')'''
    inner, module = _sql(header + r"[ \t]+[rRuUbB]{0,2}" + quoted), _sql(r"^(\s*[rRuUbB]{0,2})" + quoted)
    python = f"CASE WHEN regexp_matches({c}, '{inner}') THEN regexp_replace({c}, '{inner}', '\\1') WHEN regexp_matches({c}, '{module}') THEN regexp_replace({c}, '{module}', '\\1') ELSE {c} END"
    block = r"^\s*/\*(?s:.*?)\*/[ \t]*\n?"

    def lines(mark: str) -> str:
        return f"CASE WHEN regexp_matches({c}, '^\\s*{mark}') THEN regexp_replace({c}, '^(?:[^\\S\\n]*(?:{mark}[^\\n]*)?\\n)*(?:[^\\S\\n]*(?:{mark}[^\\n]*)?$)?', '') ELSE {c} END"

    braces = f"CASE WHEN regexp_matches({c}, '{block}') THEN regexp_replace({c}, '{block}', '') ELSE {lines('//')} END"
    return f"CASE {language} WHEN 'python' THEN {python} WHEN 'ruby' THEN {lines('#')} WHEN 'java' THEN {braces} WHEN 'javascript' THEN {braces} WHEN 'php' THEN {braces} WHEN 'go' THEN {braces} ELSE {c} END"


@query(f"SELECT DISTINCT chunk_id, {_extract_sql('text', 'lower(language)')} AS query_text FROM chunks")
def docstring_extract(spark, d):
    return chunks_of(spark, d).select("chunk_id", docs.extract_docstring("text", F.lower("language")).alias("query_text")).distinct()


@query(f"SELECT DISTINCT chunk_id, {_strip_sql('text', 'lower(language)')} AS body FROM chunks")
def strip_leading_doc(spark, d):
    return chunks_of(spark, d).select("chunk_id", docs.strip_leading_doc("text", F.lower("language")).alias("body")).distinct()


# -- splits --------------------------------------------------------------------------------------------------------

_BUCKET = f"CAST(('0x'||substr(md5('{SEED}:'||coalesce(repo_name,'')),1,16))::UBIGINT % 1000 AS INT)"


@query(f"SELECT repo_name, {_BUCKET} AS slot, CASE WHEN {_BUCKET} < 50 THEN 'eval_valid' WHEN {_BUCKET} < 100 THEN 'eval_test' ELSE 'index_only' END AS eval_split, count(*) AS n FROM chunks GROUP BY repo_name")
def repo_bucket_split(spark, d):
    slot = keys.bucket(F.col("repo_name"), SEED, hash_fn="md5")
    return chunks_of(spark, d).groupBy("repo_name").agg(F.count("*").alias("n")).select("repo_name", slot.alias("slot"), keys.eval_split(slot, F.lit(False), F.lit(True)).alias("eval_split"), "n")


@query(
    f"""WITH l AS (SELECT DISTINCT src_repo AS repo_name FROM repo_links WHERE relation='mentions')
    SELECT repo_name, CASE WHEN repo_name IN (SELECT repo_name FROM l) THEN 'eval_test' WHEN {_BUCKET} < 50 THEN 'eval_valid' ELSE 'index_only' END AS eval_split, count(*) AS n FROM chunks WHERE repo_name IS NOT NULL GROUP BY repo_name"""
)
def repo_split_with_list(spark, d):
    listed = table(spark, d, "repo_links").where("relation = 'mentions'").select(F.col("src_repo").alias("repo_name"))
    rows = chunks_of(spark, d).where("repo_name is not null").select("chunk_id", "repo_name", "language", "text", "query_text")
    return pipeline.assign_pairs(rows, listed, SEED, "md5").groupBy("repo_name", "eval_split").agg(F.count("*").alias("n"))


@query("SELECT repo_name, count(DISTINCT nullif(eval_split,'')) AS n_splits, count(*) AS n FROM chunks WHERE repo_name IS NOT NULL GROUP BY repo_name HAVING count(DISTINCT nullif(eval_split,'')) > 1")
def split_leakage_check(spark, d):
    per = chunks_of(spark, d).where("repo_name is not null").groupBy("repo_name").agg(F.countDistinct(F.nullif("eval_split", F.lit(""))).alias("n_splits"), F.count("*").alias("n"))
    return per.where("n_splits > 1")


# -- deduplication, shards, manifest ---------------------------------------------------------------------------------


@query("SELECT chunk_id, coalesce(language,'') AS language, coalesce(min(corpus_snapshot),'') AS corpus_snapshot FROM chunks GROUP BY 1, 2")
def dedupe_keep_first(spark, d):
    rows = chunks_of(spark, d).select("chunk_id", text.blank_to(F.col("language")).alias("language"), text.blank_to(F.col("corpus_snapshot")).alias("corpus_snapshot"))
    return sharding.keep_first(rows, ["language", "chunk_id"], ["corpus_snapshot"])


@query('SELECT CAST(sum(n) AS BIGINT) AS "rows", count(*) AS distinct_keys, CAST(sum(n) - count(*) AS BIGINT) AS duplicates FROM (SELECT chunk_id, count(*) AS n FROM chunks GROUP BY chunk_id)')
def duplicate_count(spark, d):
    return sharding.duplicate_count(chunks_of(spark, d), ["chunk_id"])


_TARGET = 250
_SHARDED = f"""WITH o AS (SELECT DISTINCT coalesce(lower(language),'') AS language, chunk_id FROM chunks),
n AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY chunk_id) - 1 AS r FROM o),
s AS (SELECT *, r // {_TARGET} AS slice FROM n),
i AS (SELECT language, slice, row_number() OVER (ORDER BY CASE language {' '.join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(LANGUAGES))} ELSE {len(LANGUAGES)} END, language, slice) - 1 AS shard_id FROM (SELECT DISTINCT language, slice FROM s))
"""


def _sharded(spark, d) -> DataFrame:
    rows = chunks_of(spark, d).select(F.coalesce(F.lower("language"), F.lit("")).alias("language"), "chunk_id").distinct()
    return sharding.assign_shards(rows, _TARGET, LANGUAGES)


@query(_SHARDED + f"SELECT s.chunk_id, s.language, CAST(shard_id AS INT) AS shard_id, CAST(r % {_TARGET} AS INT) AS row_in_shard FROM s JOIN i USING (language, slice)")
def shard_assign(spark, d):
    return _sharded(spark, d).select("chunk_id", "language", "shard_id", "row_in_shard")


@query(_SHARDED + "SELECT CAST(shard_id AS INT) AS shard_id, language, CAST(count(*) AS INT) AS approx_chunks, printf('shards/lang=%s/shard-%05d.parquet', coalesce(nullif(language, ''), '__none__'), CAST(shard_id AS INT)) AS out_parquet, 'pending' AS status FROM s JOIN i USING (language, slice) GROUP BY shard_id, language")
def shard_manifest(spark, d):
    return sharding.manifest(_sharded(spark, d)).select("shard_id", "language", "approx_chunks", "out_parquet", "status")


_LATEST = "(SELECT shard_id, arg_max(status, {'a': logged_at, 'b': received_at, 'c': status}) AS status, max(logged_at) AS logged_at FROM shard_status WHERE shard_id IS NOT NULL GROUP BY shard_id)"


@query(f"SELECT m.shard_id, m.language, m.approx_chunks FROM shard_manifest m WHERE m.shard_id NOT IN (SELECT shard_id FROM {_LATEST} WHERE status = 'done')")
def pending_shards(spark, d):
    return sharding.pending_shards(table(spark, d, "shard_manifest"), table(spark, d, "shard_status")).select("shard_id", "language", "approx_chunks")


@query(f"SELECT m.shard_id, m.language, coalesce(s.status, 'pending') AS status FROM shard_manifest m LEFT JOIN {_LATEST} s USING (shard_id)")
def shard_state(spark, d):
    return sharding.with_status(table(spark, d, "shard_manifest"), table(spark, d, "shard_status")).select("shard_id", "language", "status")


@query("SELECT shard_id, language, approx_chunks, out_npy, status, CAST(unnest(input_files) AS VARCHAR) AS input_file FROM shard_manifest")
def manifest_files(spark, d):
    """The manifest written as JSON lines and read back."""
    folder = f"{shared_folder(spark, 'manifest')}/manifest"
    files.write_manifest(table(spark, d, "shard_manifest"), folder)
    return files.read_manifest(spark, folder).select("shard_id", "language", "approx_chunks", "out_npy", "status", F.explode("input_files").alias("input_file"))


@query("SELECT shard_id, language, approx_chunks FROM shard_manifest WHERE shard_id = 3")
def manifest_shard(spark, d):
    return files.get_shard(table(spark, d, "shard_manifest"), 3).select("shard_id", "language", "approx_chunks")


@query("SELECT count(DISTINCT language) AS languages, CAST(sum(approx_chunks) AS BIGINT) AS chunks, count(*) AS shards FROM shard_manifest")
def manifest_totals(spark, d):
    return sharding.totals(table(spark, d, "shard_manifest"))


@query("SELECT DISTINCT chunk_id FROM chunk_vectors WHERE trim(chunk_id) <> ''")
def committed_log(spark, d):
    """A log of committed ids, one a line, and one whose only line is torn: what is whole is read back."""
    folder = shared_folder(spark, "log")
    table(spark, d, "chunk_vectors").select("chunk_id").where("chunk_id is not null").write.text(f"{folder}/log")
    write_bytes(spark, f"{folder}/log/torn.txt", b"not-whole")
    return files.read_committed(spark, f"{folder}/log")


@query(f"SELECT DISTINCT {_norm_sql('src_repo')} AS repo_name FROM repo_links WHERE {_norm_sql('src_repo')} <> ''")
def eval_repo_list(spark, d):
    folder = f"{shared_folder(spark, 'list')}/list"
    table(spark, d, "repo_links").select(F.concat(F.lit("  "), F.coalesce("src_repo", F.lit("")))).write.text(folder)
    return files.read_names(spark, folder)


@query("SELECT DISTINCT chunk_id, language, n_tokens FROM chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM chunk_vectors)")
def resume_remaining(spark, d):
    rows = chunks_of(spark, d).select("chunk_id", "language", "n_tokens").distinct()
    return sharding.remaining_rows(rows, table(spark, d, "chunk_vectors"))


@query(
    """WITH g AS (SELECT CAST(regexp_extract(vector_shard, 'shard-([0-9]+)', 1) AS INT) AS shard_id, count(*) AS got FROM chunk_vectors GROUP BY 1)
    SELECT coalesce(m.shard_id, g.shard_id) AS shard_id, CAST(coalesce(approx_chunks, 0) AS BIGINT) AS expected, coalesce(got, 0) AS got FROM shard_manifest m FULL JOIN g ON m.shard_id = g.shard_id WHERE coalesce(approx_chunks, 0) <> coalesce(got, 0)"""
)
def shard_reconciliation(spark, d):
    rows = table(spark, d, "chunk_vectors").select(F.regexp_extract("vector_shard", "shard-([0-9]+)", 1).cast("int").alias("shard_id"))
    return sharding.reconcile(rows, table(spark, d, "shard_manifest"))


@query("SELECT run, count(*) AS n, count(n_tokens) AS with_tokens, count(score) AS with_score FROM (SELECT 'chunks' AS run, chunk_id, n_tokens, NULL AS score FROM chunks UNION ALL SELECT 'qrels', corpus_id, NULL, score FROM qrels) GROUP BY run")
def union_runs(spark, d):
    a = chunks_of(spark, d).select("chunk_id", "n_tokens")
    b = table(spark, d, "qrels").select(F.col("corpus_id").alias("chunk_id"), "score")
    return sharding.union_runs({"chunks": a, "qrels": b}).groupBy("run").agg(F.count("*").alias("n"), F.count("n_tokens").alias("with_tokens"), F.count("score").alias("with_score"))


# -- published views -----------------------------------------------------------------------------------------------


@query("SELECT DISTINCT chunk_id, query_text, query_source, eval_split, language FROM chunks WHERE query_text <> ''")
def queries_view(spark, d):
    return publish.queries_view(chunks_of(spark, d)).distinct()


@query("SELECT DISTINCT chunk_id AS query_id, chunk_id AS corpus_id, CAST(1 AS INT) AS score, eval_split AS split FROM chunks WHERE eval_split <> 'index_only'")
def qrels_view(spark, d):
    return publish.qrels_view(chunks_of(spark, d)).distinct()


@query("SELECT DISTINCT chunk_id, language, license, CASE WHEN coalesce(text_publishable, false) THEN text ELSE '' END AS text FROM chunks")
def corpus_view_gated(spark, d):
    return publish.corpus_view(chunks_of(spark, d)).select("chunk_id", "language", "license", "text").distinct()


@query(
    f"""WITH v AS (SELECT DISTINCT query_id, corpus_id, score, split FROM qrels), c AS {_ONCE}
    SELECT v.split, coalesce(c.eval_split,'') AS current_split, count(*) AS n FROM v LEFT JOIN c ON v.corpus_id = c.chunk_id GROUP BY ALL"""
)
def qrels_currency(spark, d):
    v = table(spark, d, "qrels").select("corpus_id", "query_id", "score", "split").distinct()
    c = sharding.keep_first(chunks_of(spark, d).select("chunk_id", "eval_split"), ["chunk_id"], ["eval_split"])
    return v.join(c, v["corpus_id"] == c["chunk_id"], "left").groupBy("split", text.blank_to(F.col("eval_split")).alias("current_split")).agg(F.count("*").alias("n"))


# -- vectors -------------------------------------------------------------------------------------------------------


@query(
    """WITH t AS (SELECT vec_id, list_transform(embedding[1:32], lambda x: x::DOUBLE) AS v FROM embeddings)
    SELECT vec_id, round(v[1] / n, 6) AS v0, round(v[32] / n, 6) AS v31, CAST(len(v) AS INT) AS dim FROM (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x*x))) AS n FROM t)"""
)
def mrl_truncate_normalize(spark, d):
    v = vectors.truncate_and_normalize(F.col("embedding"), 32)
    t = table(spark, d, "embeddings").select("vec_id", v.alias("v"))
    return t.select("vec_id", F.round(F.col("v")[0], 6).alias("v0"), F.round(F.col("v")[31], 6).alias("v31"), F.size("v").alias("dim"))


def _topk_sql(score: str, k: int) -> str:
    return f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), q AS (SELECT * FROM v WHERE vec_id % 100 = 0),
    s AS (SELECT q.vec_id AS qid, c.vec_id AS cid, round({score}, 9) AS score FROM q, v c),
    r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) - 1 AS rank FROM s)
    SELECT qid, cid, CAST(rank AS INT) AS rank FROM r WHERE rank < {k}"""


def _vector_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    v = table(spark, d, "embeddings")
    return v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), "embedding"), v.select(F.col("vec_id").alias("cid"), "embedding")


@query(_topk_sql("list_inner_product(q.v, c.v)", 100))
def exact_topk_ip(spark, d):
    return search.exact_topk(*_vector_sides(spark, d), 100).drop("score")


@query(_topk_sql("-(list_inner_product(q.v, q.v) - 2*list_inner_product(q.v, c.v) + list_inner_product(c.v, c.v))", 100))
def exact_topk_l2(spark, d):
    return search.exact_topk(*_vector_sides(spark, d), 100, "l2").drop("score")


@query(_topk_sql("list_inner_product(q.v, c.v)", 10))
def sharded_topk_merge(spark, d):
    q, c = _vector_sides(spark, d)
    return search.exact_topk(q, c.repartition(7, "cid"), 10).drop("score")


@query(f"SELECT vec_id, label FROM embeddings ORDER BY md5('{SEED}:'||vec_id::VARCHAR), vec_id LIMIT 200")
def train_sample(spark, d):
    return sharding.sample(table(spark, d, "embeddings").select("vec_id", "label"), 200, "vec_id", SEED)


@query(
    f"""WITH v AS (SELECT chunk_id, arg_min(embedding, {{'a': vector_shard, 'b': row_in_shard}}) AS e FROM chunk_vectors WHERE len(embedding) = 64 GROUP BY chunk_id)
    SELECT chunk_id, c.language, round(list_sum(list_transform(e, lambda x: x::DOUBLE)), 4) AS total FROM {_ONCE} c JOIN v USING (chunk_id)"""
)
def vector_row_join(spark, d):
    """Each chunk with its vector, one to one: repeated rows of either side are reduced first, the join checks it."""
    v = sharding.keep_first(table(spark, d, "chunk_vectors").where("size(embedding) = 64").select("chunk_id", "vector_shard", "row_in_shard", "embedding"), ["chunk_id"], ["vector_shard", "row_in_shard"])
    rows = sharding.keep_first(chunks_of(spark, d).select("chunk_id", "language", "corpus_snapshot"), ["chunk_id"], ["corpus_snapshot"]).join(v.select("chunk_id"), "chunk_id", "left_semi")
    return embedding.attach_vectors(rows, v.select("chunk_id", "embedding")).select("chunk_id", "language", F.round(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double")), 4).alias("total"))


def _index_query(spark, d, parts: int = 0, rotate: bool = False) -> DataFrame:
    """Lists by the size of the table, four fifths of them probed; a quarter of each list's codes is re-ranked."""
    q, c = _vector_sides(spark, d)
    lists = search.lists_for(c.where("embedding is not null").count())
    ix = search.train_index(c, lists, parts, 32 if parts else 256, rotate, min(125 * lists, 100_000), SEED)
    return search.search_index(q, search.add_to_index(c, ix), ix, 10, -(-4 * lists // 5), rerank=8 if parts else 1, rerank_share=0.25 if parts else 0.0)


def _recall(spark, d, found: DataFrame) -> DataFrame:
    """One row: queries, and whether the found neighbours hold at least nine tenths of the exact ones."""
    exact = search.exact_topk(*_vector_sides(spark, d), 10).select("qid", "cid")
    n = exact.join(found.select("qid", "cid").withColumn("hit", F.lit(1)), ["qid", "cid"], "left").agg(F.countDistinct("qid").alias("queries"), F.count("*").alias("wanted"), F.count("hit").alias("hits"))
    return n.select("queries", "wanted", (F.col("hits") >= 0.9 * F.col("wanted")).alias("recall_reached"))


_RECALL_SQL = "SELECT count(*) AS queries, count(*) * least(10, (SELECT count(*) FROM embeddings)) AS wanted, true AS recall_reached FROM embeddings WHERE vec_id % 100 = 0"


@query(_RECALL_SQL)
def ivf_recall(spark, d):
    return _recall(spark, d, ivf_search(spark, d))


@query(_RECALL_SQL)
def pq_recall(spark, d):
    return _recall(spark, d, pq_search(spark, d))


@query()
def ivf_search(spark, d):
    return _index_query(spark, d)


@query()
def pq_search(spark, d):
    return _index_query(spark, d, 8, True)


# -- embedding and evaluation --------------------------------------------------------------------------------------

_TF = partial(embedding.HashedTf, embed_dim=256, normalize=False)
_DIM_SQL = 256


def _hits_sql(split: str) -> str:
    return f"""WITH c AS {_ONCE},
body AS (SELECT chunk_id, text, {_strip_sql('text', "lower(coalesce(language, ''))")} AS stripped FROM c),
ct AS (SELECT chunk_id, ('0x'||substr(md5(w),1,8))::UBIGINT % {_DIM_SQL} AS b, count(*) AS n FROM (SELECT chunk_id, unnest(regexp_extract_all(lower(CASE WHEN {_norm_sql('stripped')} <> '' THEN stripped ELSE coalesce(text, '') END), '[a-z0-9_]+')) AS w FROM body) GROUP BY ALL),
qt AS (SELECT chunk_id, ('0x'||substr(md5(w),1,8))::UBIGINT % {_DIM_SQL} AS b, count(*) AS n FROM (SELECT chunk_id, unnest(regexp_extract_all(lower(query_text), '[a-z0-9_]+')) AS w FROM c WHERE eval_split='{split}' AND query_text <> '') GROUP BY ALL),
cn AS (SELECT chunk_id, sum(n*n) AS z FROM ct GROUP BY chunk_id), qn AS (SELECT chunk_id, sum(n*n) AS z FROM qt GROUP BY chunk_id),
dp AS (SELECT qt.chunk_id AS qid, ct.chunk_id AS cid, sum(qt.n*ct.n) AS dot FROM qt JOIN ct USING (b) GROUP BY ALL),
rel AS (SELECT chunk_id AS qid FROM c WHERE eval_split='{split}' AND query_text <> ''),
pairs AS (SELECT rel.qid, c.chunk_id AS cid, coalesce(round(dp.dot::DOUBLE / sqrt(qn.z::DOUBLE * cn.z::DOUBLE), 9), 0.0) AS score FROM rel CROSS JOIN c LEFT JOIN qn ON qn.chunk_id = rel.qid LEFT JOIN cn ON cn.chunk_id = c.chunk_id LEFT JOIN dp ON dp.qid = rel.qid AND dp.cid = c.chunk_id),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) - 1 AS rank FROM pairs) WHERE rank < 100),
ranks AS (SELECT rel.qid, h.rank FROM rel LEFT JOIN hits h ON h.qid = rel.qid AND h.cid = rel.qid)
"""


_METRICS = (
    "SELECT count(*) AS n_queries, "
    + ", ".join(f"round(avg(CASE WHEN rank < {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 9) AS recall_at_{k}" for k in (1, 5, 10, 100))
    + ", round(avg(CASE WHEN rank < 10 THEN 1.0::DOUBLE/(rank+1) ELSE 0.0::DOUBLE END), 9) AS mrr_at_10, round(avg(CASE WHEN rank < 10 THEN 1.0::DOUBLE/log2(rank+2.0::DOUBLE) ELSE 0.0::DOUBLE END), 9) AS ndcg_at_10 FROM ranks"
)
_HITS = _hits_sql("eval_test")


@query(_HITS + "SELECT qid, cid, CAST(rank AS INT) AS rank FROM hits WHERE rank < 10")
def hashed_tf_topk(spark, d):
    return evaluate.hits(chunks_of(spark, d), "test", 10, make=_TF)[1].drop("score")


@query(_HITS + "SELECT qid, CAST(rank AS INT) AS rank FROM ranks")
def retrieval_ranks(spark, d):
    return evaluate.retrieval_ranks(chunks_of(spark, d), "test", 100)


@query(_HITS + _METRICS)
def retrieval_metrics(spark, d):
    return metrics.metrics(evaluate.retrieval_ranks(chunks_of(spark, d), "test", 100), [1, 5, 10, 100])


@query(_hits_sql("eval_valid") + _METRICS)
def eval_report(spark, d):
    return evaluate.report(chunks_of(spark, d), "valid")


# -- chunking, files, streams --------------------------------------------------------------------------------------


@query(
    f"""WITH t AS (SELECT doc_id, text, length(text) AS n, len(regexp_extract_all(text, '{_TOK}')) AS e, len(text) - len(replace(text, chr(10), '')) + 1 AS last FROM documents WHERE text <> ''),
    w AS (SELECT doc_id, last, e, unnest(range(CAST(greatest(0, ceil((e-512)/480.0)) AS BIGINT) + 1)) AS win FROM t WHERE n//2 >= 8 AND NOT (greatest(1, n//2) <= 512 AND n//5 >= 8) AND e >= 8),
    c AS (SELECT doc_id, 'whole_file' AS symbol_kind, last, greatest(8, n//3) AS n_tokens, false AS truncated FROM t WHERE n//2 >= 8 AND greatest(1, n//2) <= 512 AND n//5 >= 8
    UNION ALL SELECT doc_id, CASE WHEN e <= 512 THEN 'whole_file' ELSE 'window' END, last, least(e, win*480+512) - win*480, e > 512 FROM w WHERE least(e, win*480+512) - win*480 >= 8)
    SELECT 'doc-'||doc_id AS path, symbol_kind, CAST(1 AS INT) AS start_line, CAST(last AS INT) AS end_line, CAST(n_tokens AS INT) AS n_tokens, truncated, count(*) AS n FROM c GROUP BY ALL"""
)
def whole_file_chunks(spark, d):
    """Files as spans of their own, cut into windows of tokens where they are too long."""
    raw = table(spark, d, "documents").select(F.col("text").alias("content"), F.col("source").alias("repo_name"), F.concat(F.lit("doc-"), F.col("doc_id")).alias("path"), F.lower("code_language").alias("language"), F.lit("MIT").alias("license"))
    rows = chunking.chunk_files(raw, ALLOW, "test", 512, 32, 8, unit="file")
    return rows.groupBy("path", "symbol_kind", "start_line", "end_line", "n_tokens", "truncated").agg(F.count("*").alias("n"))


@query("SELECT coalesce(text,'') AS content, coalesce(source,'') AS repo_name, 'doc-'||doc_id AS path, lower(code_language) AS language, 'MIT' AS license FROM documents WHERE lower(code_language) IN ('python', 'java', 'javascript', 'php', 'go', 'ruby')")
def staged_corpus(spark, d):
    """Raw rows under other names staged as files and read back."""
    raw = table(spark, d, "documents").select(F.col("text"), F.col("source").alias("repository_name"), F.concat(F.lit("doc-"), F.col("doc_id")).alias("filename"), F.lower("code_language").alias("language"), F.array(F.lit("MIT"), F.lit("ISC")).alias("detected_licenses"))
    folder = f"{shared_folder(spark, 'corpus')}/corpus"
    files.stage_corpus(raw, folder, LANGUAGES)
    return files.read_corpus(spark, folder).select(*files.CORPUS_COLUMNS)


@query("SELECT 'corpus' AS name, count(*) AS n FROM documents UNION ALL SELECT 'qrels', count(*) FROM qrels UNION ALL SELECT 'queries', count(*) FROM heldout_items")
def staged_eval_pack(spark, d):
    """The tables of an evaluation pack copied; one that is missing is only reported."""
    folder = shared_folder(spark, "pack")
    failed = files.stage_eval_pack(spark, {"corpus": f"{d}/documents.parquet", "queries": f"{d}/heldout_items.parquet", "qrels": f"{d}/qrels.parquet", "pairs": f"{d}/missing.parquet"}, folder)
    parts = [spark.read.parquet(f"{folder}/{n}").agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in ("corpus", "qrels", "queries") if n not in failed]
    return files.union(*parts)


@query()
def symbol_chunks(spark, d):
    docs_ = table(spark, d, "documents")
    raw = docs_.select(F.col("text").alias("content"), F.col("source").alias("repo_name"), F.concat(F.lit("doc-"), F.col("doc_id")).alias("path"), F.lower("code_language").alias("language"), F.lit("MIT").alias("license"))
    return chunking.chunk_files(raw, ALLOW, "test", 512, 32, 8).select(*[c for c in CHUNK_COLUMNS if c != "corpus_snapshot"])


def _stream_of(spark, d, name: str, schema) -> DataFrame:
    """A table, one file or a folder of them, as a stream of files."""
    folder = f"{d}/{name}.parquet"
    return ingest.read_stream(spark, folder, schema) if glob(spark, f"{folder}/*.parquet") else ingest.read_stream(spark, d, schema, glob=f"{name}.parquet")


@query("SELECT chunk_id, count(*) AS n FROM (SELECT DISTINCT chunk_id FROM chunks) GROUP BY chunk_id")
def stream_resume(spark, d):
    """Three runs over one folder: the second finds nothing new, the third the same ids in new files, so each is there once."""
    rows = chunks_of(spark, d).select("chunk_id", "language")
    folder = shared_folder(spark, "stream")
    rows.write.parquet(f"{folder}/in")
    for k in range(3):
        if k == 2:
            rows.write.mode("append").parquet(f"{folder}/in")
        ingest.embed_stream(ingest.read_stream(spark, f"{folder}/in", rows.schema), lambda b: b.select("chunk_id"), f"{folder}/out", f"{folder}/checkpoint")
    return ingest.read_sink(spark, f"{folder}/out").groupBy("chunk_id").agg(F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, logged_at) AS hour, status, language, count(*) AS messages FROM (SELECT DISTINCT shard_id, status, logged_at, coalesce(language,'') AS language FROM shard_status WHERE shard_id IS NOT NULL) GROUP BY ALL")
def status_per_hour(spark, d):
    """The status messages as a stream, counted by window of the time logged."""
    rows = table(spark, d, "shard_status")
    counted = ingest.status_counts(_stream_of(spark, d, "shard_status", rows.schema))
    folder = shared_folder(spark, "status")
    ingest.complete(counted, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "status", "language", "messages")


@query(f"""WITH o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS r, embedding FROM embeddings)
SELECT vec_id, printf('vectors/lang=x/run-v1-part-%05d.npy', CAST(r // 300 AS INT)) AS vector_shard, CAST(r % 300 AS INT) AS row_in_shard, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 5) AS total FROM o""")
def vector_pointers(spark, d):
    """Vectors in shards of 300, written as the files that their pointers name, and each read back by its pointer."""
    npy.register(spark)
    rows = table(spark, d, "embeddings").select(F.lit("x").alias("language"), "vec_id", "embedding")
    placed = sharding.assign_shards(rows, 300, [], ["vec_id"])
    told = placed.withColumn("vector_shard", F.format_string("vectors/lang=%s/run-v1-part-%05d.npy", sharding.folder_name(F.col("language")), F.col("shard_id")))
    folder = shared_folder(spark, "pointers")
    files_ = npy.write_files(told.select(F.col("vector_shard").alias("file"), F.col("row_in_shard").alias("row"), F.col("embedding").alias("vector")), folder)
    if files_.agg(F.sum("rows")).first()[0] != rows.count():
        raise ValueError("rows are missing")
    back = spark.read.format("npy").option("path", folder).load().withColumn("vector_shard", F.regexp_extract("path", "(vectors/.*)$", 1))
    total = F.round(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double")), 5)
    return told.select("vec_id", "vector_shard", "row_in_shard").join(back.select("vector_shard", F.col("row").alias("row_in_shard"), total.alias("total")), ["vector_shard", "row_in_shard"])


@query("SELECT count(*) AS n, round(sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE))), 3) AS total FROM embeddings")
def npy_roundtrip(spark, d):
    npy.register(spark)
    folder = shared_folder(spark, "npy")
    table(spark, d, "embeddings").select(F.col("embedding").alias("vector")).write.format("npy").option("path", folder).mode("append").save()
    got = spark.read.format("npy").option("path", folder).load()
    return got.select(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double")).alias("s")).agg(F.count("*").alias("n"), F.round(F.sum("s"), 3).alias("total"))
