import copy
import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chunkloom import config, schema
from chunkloom.cli import main, parser
from chunkloom.operators import embedding, metrics, search, sharding
from chunkloom.functions import tokenizers
from chunkloom.operators.chunking import chunk_files, span_chunks
from chunkloom.plans import evaluate, pipeline, publish
from chunkloom.queries import QUERIES, _vector_sides
from chunkloom.sources import files, fs, npy
from chunkloom.streaming import ingest


def test_keep_first_is_idempotent_and_takes_nulls(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), (None, 1, "y"), (None, 1, "y")], "k string, o int, v string")
    once = sharding.keep_first(df, ["k"], ["o"])
    assert {tuple(r) for r in once.collect()} == {("a", 1, "x"), (None, 1, "y")}
    assert {tuple(r) for r in sharding.keep_first(once, ["k"], ["o"]).collect()} == {("a", 1, "x"), (None, 1, "y")}
    assert sharding.keep_first(df.limit(0), ["k"], ["o"]).count() == 0
    assert tuple(sharding.duplicate_count(df, ["k"]).first()) == (4, 2, 2)


def test_shards_are_contiguous(spark):
    df = spark.range(103).select(F.format_string("%03d", "id").alias("chunk_id"), F.when(F.col("id") % 3 == 0, "java").when(F.col("id") % 3 == 1, "python").otherwise("odd").alias("language"))
    got = sharding.assign_shards(df, 10, ["python", "java"]).orderBy("shard_id", "row_in_shard").collect()
    ids = sorted({r.shard_id for r in got})
    assert ids == list(range(len(ids))) and len(got) == 103
    for i in ids:
        rows = [r for r in got if r.shard_id == i]
        assert [r.row_in_shard for r in rows] == list(range(len(rows)))
        assert [r.chunk_id for r in rows] == sorted(r.chunk_id for r in rows) and len({r.language for r in rows}) == 1
    assert [r.language for r in got][0] == "python" and got[-1].language == "odd"
    m = sharding.manifest(sharding.assign_shards(df, 10, ["python", "java"]))
    assert m.agg(F.sum("approx_chunks")).first()[0] == 103


def test_pending_and_reconcile(spark):
    shards = spark.createDataFrame([(0, "a", 2), (1, "a", 1), (2, "b", 1)], "shard_id int, language string, approx_chunks int")
    log = spark.createDataFrame([(0, "running", 1, 1), (0, "done", 2, 2), (1, "done", 1, 1), (1, "running", 3, 3)], "shard_id int, status string, logged_at int, received_at int")
    assert sorted(r.shard_id for r in sharding.pending_shards(shards, log).collect()) == [1, 2]
    assert {r.shard_id: r.status for r in sharding.with_status(shards, log).collect()} == {0: "done", 1: "running", 2: "pending"}
    rows = spark.createDataFrame([(0,), (0,), (2,), (2,)], "shard_id int")
    assert {(r.shard_id, r.got) for r in sharding.reconcile(rows, shards).collect()} == {(1, 0), (2, 2)}


def test_exact_topk_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-2, 3, (60, 4)).astype(float)
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "cid int, embedding array<float>").repartition(5)
    q = spark.createDataFrame([(i, x[i].tolist()) for i in range(5)], "qid int, embedding array<float>")
    got = {}
    for r in search.exact_topk(q, c, 7).collect():
        got.setdefault(r.qid, {})[r["rank"]] = r.cid
    for i in range(5):
        want = sorted(range(60), key=lambda j: (-(x[i] @ x[j]), j))[:7]
        assert [got[i][k] for k in range(7)] == want
    assert search.exact_topk(q.limit(0), c, 3).count() == 0
    with pytest.raises(ValueError):
        search.score_block(x, x, "other")


def test_exact_topk_in_blocks_reads_the_corpus_once(spark, monkeypatch):
    """Many blocks of queries: the engine sees each corpus text once, and ties go to the smaller key whatever the blocks."""
    monkeypatch.setattr(search, "BLOCK_NUMBERS", 12)
    monkeypatch.setattr(search, "SCORES", 200)
    rng = np.random.default_rng(4)
    x = rng.integers(-1, 2, (300, 4)).astype(float)
    keys = [f"{i:04d}" for i in rng.permutation(300)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    c = spark.createDataFrame([(k, v.tolist()) for k, v in zip(keys, x)], "cid string, embedding array<float>").repartition(3)
    q = spark.createDataFrame([(f"q{i}", x[i].tolist()) for i in range(10)], "qid string, embedding array<float>").repartition(2)
    got = {}
    for r in search.exact_topk(q, c.mapInArrow(count, c.schema), 9).collect():
        got.setdefault(r.qid, {})[r["rank"]] = r.cid
    for i in range(10):
        want = sorted(range(300), key=lambda j: (-(x[i] @ x[j]), keys[j]))[:9]
        assert [got[f"q{i}"][k] for k in range(9)] == [keys[j] for j in want]
    assert seen.value == 300


def test_sample_is_the_least_hashes(spark):
    df = spark.range(3000).repartition(5)
    by_hand = [r.id for r in df.orderBy(F.md5(F.concat(F.lit("7:"), F.col("id").cast("string"))), "id").limit(700).collect()]
    assert sorted(r.id for r in sharding.sample(df, 700, "id", 7).collect()) == sorted(by_hand)
    assert sharding.sample(df, 9999, "id", 7).count() == 3000 and sharding.sample(df.limit(0), 5, "id", 7).count() == 0


@pytest.mark.parametrize("metric", ["inner_product", "l2"])
def test_index_trained_in_the_cluster_with_split_lists(spark, metric):
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(9, 8)), 80, axis=0) + 0.2 * rng.normal(size=(720, 8))
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cid int, embedding array<float>").repartition(4)
    ix = search.train_index(c, 6, train_sample=600, driver_numbers=8 * 50, list_rows=40)
    assert ix.centroids.shape == (6, 8) and ix.splits.max() > 1
    table = search.add_to_index(c, ix)
    sizes = table.groupBy("list_id", "part").count().collect()
    assert sum(r["count"] for r in sizes) == 720 and len(sizes) > 6
    q = c.where("cid % 40 = 0").withColumnRenamed("cid", "qid")
    exact = {(r.qid, r.cid) for r in search.exact_topk(q, c, 5, metric).collect()}
    all_lists = {(r.qid, r.cid) for r in search.search_index(q, table, ix, 5, 6, metric=metric).collect()}
    assert all_lists == exact
    some = {(r.qid, r.cid) for r in search.search_index(q, table, ix, 5, 4, metric=metric).collect()}
    assert len(some & exact) >= 0.9 * len(exact)
    coded = search.train_index(c, 3, parts=4, codes=32, rotate=True)
    near = {(r.qid, r.cid) for r in search.search_index(q, search.add_to_index(c, coded), coded, 5, 3, 8, metric=metric).collect()}
    assert len(near & exact) >= 0.9 * len(exact)
    with pytest.raises(ValueError):
        search.search_index(q, table, ix, 5, metric="other")


def test_vectors_are_attached_one_to_one(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "chunk_id string, n int")
    v = spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("c", [3.0])], "chunk_id string, embedding array<float>")
    assert {(r.chunk_id, r.n, r.embedding[0]) for r in embedding.attach_vectors(rows, v.where("chunk_id <> 'c'")).collect()} == {("a", 1, 1.0), ("b", 2, 2.0)}
    for a, b in ((rows, v), (rows, v.where("chunk_id = 'a'")), (rows.unionByName(rows), v.where("chunk_id <> 'c'"))):
        with pytest.raises(Exception, match="no vector or row"):
            embedding.attach_vectors(a, b).collect()


def test_index_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = embedding.unit_rows(np.repeat(centres, 30, axis=0) + 0.3 * rng.normal(size=(360, 16)))
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cid int, embedding array<float>")
    q = c.where("cid % 10 = 0").withColumnRenamed("cid", "qid")
    exact = {(r.qid, r.cid) for r in search.exact_topk(q, c, 5).collect()}
    kind = search.parse_factory("OPQ4,IVF8_HNSW32,PQ4")
    assert kind["rotate"] and kind["lists"] == 8 and kind["parts"] == 4
    assert search.parse_factory("OPQ64_256,IVF65536_HNSW32,PQ64")["width"] == 256
    for parts, rotate, width in ((0, False, 0), (4, True, 0), (4, True, 12)):
        ix = search.train_index(c, 8, parts, 32, rotate, 360, width=width)
        found = {(r.qid, r.cid) for r in search.search_index(q, search.add_to_index(c, ix), ix, 5, 4, 8).collect()}
        assert len(found & exact) / len(exact) > 0.9
    with pytest.raises(ValueError):
        search.parse_factory("SQ8")


@pytest.mark.parametrize(("name", "rows"), [("ivf_search", 2000), ("ivf_search", 20_000), ("pq_search", 2000), ("pq_search", 20_000)])
def test_recall_of_the_registered_indexes(spark, tmp_path, name, rows):
    """Vectors without clusters, the hardest case for lists; the queries are one row of a hundred."""
    x = embedding.unit_rows(np.random.default_rng(3).normal(size=(rows, 64)))
    kind = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32()))])
    pq.write_table(pa.table({"vec_id": range(rows), "embedding": x.tolist()}, schema=kind), tmp_path / "embeddings.parquet")
    found = {(r.qid, r.cid) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    exact = {(r.qid, r.cid) for r in search.exact_topk(*_vector_sides(spark, str(tmp_path)), 10).collect()}
    assert len(exact) == rows // 10 and len(found & exact) / len(exact) > 0.9


def test_documents_of_any_kind_are_chunked(spark, tmp_path):
    prose, code = "The parser keeps the last token of each line. " * 3, "def f(a, b):\n    return a + b + g(a, b, a, b)\n"
    rows = [(1, prose, "s", "readme", None), (2, code, "s", "note", "PYTHON"), (3, code, "s", None, "python"), (4, prose * 100, "s", "page", None), (5, None, "s", "qa", None), (6, code, "s", "source", "Python")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string, doc_kind string, code_language string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in QUERIES["symbol_chunks"](spark, str(tmp_path)).collect():
        got.setdefault(r.path, set()).add(r.symbol_kind)
    assert got == {"doc-1": {"whole_file"}, "doc-2": {"function"}, "doc-3": {"function"}, "doc-4": {"window"}, "doc-6": {"function"}}


def test_metrics(spark):
    ranks = spark.createDataFrame([(0, 0), (1, 4), (2, 9), (3, 10), (4, None)], "qid int, rank int")
    got = metrics.metrics(ranks, [1, 5, 10]).first()
    assert (got.n_queries, got.recall_at_1, got.recall_at_5, got.recall_at_10) == (5, 0.2, 0.4, 0.6)
    assert got.mrr_at_10 == pytest.approx((1 + 1 / 5 + 1 / 10) / 5)
    assert got.ndcg_at_10 == pytest.approx((1 + 1 / np.log2(6) + 1 / np.log2(11)) / 5)
    assert metrics.metrics(ranks.limit(0), [1]).first().n_queries == 0


def test_engines():
    e = embedding.build("hashed_tf", "x", embed_dim=8, normalize=False)
    assert e.embed_documents(["a a b"]).sum() == 3
    assert embedding.HashedTf(embed_dim=4)._finish(np.ones((2, 9)), 2).shape == (2, 4)
    with pytest.raises(ValueError):
        embedding.build("nothing", "x")
    with pytest.raises(ValueError):
        embedding.build("vllm", "x", embed_dim=4, dtype="fp8")
    with pytest.raises(ValueError):
        e._finish(np.ones(3), 1)


def test_schema():
    assert schema.struct(schema.CHUNK_COLUMNS).fieldNames() == schema.CHUNK_COLUMNS and len(schema.CHUNK_COLUMNS) == 17
    assert len(schema.struct().fieldNames()) == 25 and schema.struct(inline_embedding=True)["embedding"].nullable
    with pytest.raises(ValueError):
        schema.spark_type("int8")
    assert len(schema.describe()) == 26


def test_defaults_and_canonical(spark):
    df = spark.createDataFrame([("a", None, "x")], "chunk_id string, text string, stray string")
    row = schema.with_defaults(df, "snap").first()
    assert (row.text, row.eval_split, row.normalized, row.corpus_snapshot) == ("", "index_only", True, "snap")
    assert schema.canonical(df).columns == ["chunk_id", "text"]


def test_config(tmp_path, monkeypatch):
    (tmp_path / "defaults.yaml").write_text("run: {seed: 7}\nchunk: {max_tokens: 100}\n")
    (tmp_path / "a.yaml").write_text("run: {name: r}\npaths: {scratch: '${SOME_DIR}'}\nengine: {name: tei}\n")
    with pytest.raises(KeyError):
        config.load(str(tmp_path / "a.yaml"))
    monkeypatch.setenv("SOME_DIR", "/x")
    cfg = config.load(str(tmp_path / "a.yaml"), {"eval": {"ks": [1]}})
    assert (cfg.run.seed, cfg.chunk.max_tokens, cfg.chunks_dir, cfg.model.dtype, cfg.eval.ks) == (7, 100, "/x/r/chunks", "float16", [1])
    assert config.value_of(cfg, "run.name") == "r" and config.value_of(cfg, "run.none", "d") == "d"
    with pytest.raises(ValueError):
        config.load(None, {"run": {"nmae": 1}})


def test_readers(spark, tmp_path):
    (tmp_path / "names.txt").write_text(" a/b \n\n c\na/b\n")
    assert sorted(r[0] for r in files.read_names(spark, str(tmp_path / "names.txt")).collect()) == ["a/b", "c"]
    assert files.read_names(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "log.txt").write_text("a\nb\ntor")
    assert sorted(r[0] for r in files.read_committed(spark, str(tmp_path / "log.txt")).collect()) == ["a", "b"]
    (tmp_path / "batches.txt").write_text("# x\nr1 python,go\n\nr2 java # y\n")
    assert files.read_batches(str(tmp_path / "batches.txt")) == [("r1", ["python", "go"]), ("r2", ["java"])]
    with pytest.raises(files.MissingInput):
        files.read_corpus(spark, str(tmp_path / "no"))
    raw = spark.createDataFrame([("", "x", None, "r", ["MIT", "ISC"]), (None, None, "n", "", [])], "content string, text string, max_stars_repo_name string, repo_name string, detected_licenses array<string>")
    got = [tuple(r) for r in files.project_raw(raw, "go").collect()]
    assert got == [("x", "r", "", "go", "MIT"), ("", "n", "", "go", "")]


def test_npy_source(spark, tmp_path):
    npy.register(spark)
    x = np.arange(30, dtype=np.float32).reshape(10, 3)
    df = spark.createDataFrame([(v.tolist(),) for v in x], "vector array<float>").coalesce(1)
    df.write.format("npy").option("path", str(tmp_path / "v")).mode("overwrite").save()
    got = spark.read.format("npy").option("path", str(tmp_path / "v")).option("rows", 4).load().orderBy("row").collect()
    assert [r.vector for r in got] == x.tolist()
    (tmp_path / "bad.npy").write_bytes(b"no")
    assert npy.shape_of(str(tmp_path / "bad.npy")) is None


def test_stream_resumes(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("b",), ("a",)], "chunk_id string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    args = (lambda b: b, str(tmp_path / "out"), str(tmp_path / "ck"))
    stream = ingest.read_stream(spark, str(tmp_path / "in"), rows.schema)
    assert ingest.embed_stream(stream, *args) == 2
    assert ingest.embed_stream(stream, *args) == 2
    spark.createDataFrame([("c",)], "chunk_id string").write.mode("append").parquet(str(tmp_path / "in"))
    assert ingest.embed_stream(stream, *args) == 3
    assert ingest.embed_stream(stream, *args, resume=False) == 3


def test_status_stream(spark, tmp_path):
    t = "timestamp_ntz'2024-01-01 10:05:00'"
    rows = spark.sql(f"select 1 as shard_id, 'done' as status, null as language, 5 as row_total, {t} as logged_at, {t} as received_at union all select 1, 'done', null, 5, {t}, {t}").select(F.col("shard_id").cast("int"), "status", F.col("language").cast("string"), F.col("row_total").cast("int"), "logged_at", "received_at")
    rows.coalesce(1).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "s"))
    q = ingest.status_counts(stream).writeStream.format("memory").queryName("sc").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r.messages, r.rows) for r in spark.table("sc").collect()] == [(1, 5)]


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    cfg = config.load(None, {"paths": {"scratch": str(tmp_path_factory.mktemp("scratch"))}, "model": {"embed_dim": 64, "query_instruction": ""}, "shard": {"target_chunks": 3}, "corpus": {"languages": ["python", "java"]}, "index": {"factory_full": "IVF2,Flat", "nprobe": 2}})
    body = 'def {n}(a, b):\n    """Adds the {n} values of two {n} lists."""\n    {n}_total = a + b\n    return {n}_total\n'
    raw = spark.createDataFrame([(body.format(n=n), f"o/{n}", f"{n}.py", lang, "MIT" if i % 2 else "GPL-3.0") for i, (n, lang) in enumerate([("alpha", "python"), ("beta", "python"), ("gamma", "python"), ("delta", "python"), ("alpha", "java"), ("x", "cobol")])], "content string, repo_name string, path string, language string, license string")
    pipeline.stage(spark, cfg, raw)
    pipeline.chunk(spark, cfg)
    pipeline.shard(spark, cfg)
    assert pipeline.embed(spark, cfg) == pipeline.embed(spark, cfg)
    return cfg


def test_pipeline(spark, finished):
    cfg = finished
    shards = pipeline.read_shards(spark, cfg)
    assert shards.count() == 5 and {r.language for r in shards.collect()} == {"python", "java"}
    m = files.read_manifest(spark, cfg.manifest_path)
    assert m.agg(F.sum("approx_chunks")).first()[0] == 5 and [r.shard_id for r in m.orderBy("shard_id").collect()] == [0, 1, 2]
    with pytest.raises(KeyError):
        files.get_shard(m, 99)
    assert pipeline.embedded(spark, cfg).columns == [f.name for f in schema.FIELDS]
    got = pipeline.publish(spark, cfg)
    assert got["corpus"] == 5 and not got["uploaded"]
    blank = spark.read.parquet(f"{cfg.publish_dir}/corpus").where("text = ''")
    assert {r.license for r in blank.collect()} == {"GPL-3.0"}
    assert pipeline.merge_index(spark, cfg) == cfg.index_dir and pipeline.merge_index(spark, cfg, "sharded")
    with pytest.raises(ValueError):
        pipeline.merge_index(spark, cfg, "other")


def test_pointers_lead_to_the_vectors(spark, finished, tmp_path):
    cfg = finished
    for r in files.read_manifest(spark, cfg.manifest_path).collect():  # the manifest names what is there
        assert spark.read.parquet(r.out_parquet).count() == r.approx_chunks == npy.shape_of(r.out_npy)[0]
    pipeline.publish(spark, cfg)
    rows = pipeline.embedded(spark, cfg).collect()
    for r in rows:
        assert np.array_equal(np.load(f"{cfg.publish_dir}/{r.vector_shard}")[r.row_in_shard], np.array(r.embedding, np.float32))
    view = spark.read.parquet(f"{cfg.publish_dir}/vectors/run={cfg.run.name}/*/*.parquet")
    assert view.columns == ["chunk_id", "language", "vector_shard", "row_in_shard"] and view.count() == len(rows) == 5
    cfg.publish.repo_id = str(tmp_path / "copy")
    assert pipeline.publish(spark, cfg, dry_run=False)["uploaded"] and (tmp_path / "copy" / rows[0].vector_shard).exists()
    cfg.publish.repo_id = "name/only"
    with pytest.raises(ValueError):
        pipeline.publish(spark, cfg, dry_run=False)


def test_embedding_resumes_by_status(spark, finished, monkeypatch):
    cfg = finished
    log = pipeline.status_log(spark, cfg)
    assert {r.status for r in sharding.latest_status(log).collect()} == {"done"}
    assert sharding.pending_shards(files.read_manifest(spark, cfg.manifest_path), log).count() == 0
    before = {r.chunk_id for r in pipeline.embedded(spark, cfg).collect()}
    monkeypatch.setattr(pipeline, "embed_stream", None)  # nothing is left to do
    assert pipeline.embed(spark, cfg) == 5
    monkeypatch.undo()
    assert pipeline.embed(spark, cfg, resume=False) == 5 and pipeline.embed(spark, cfg) == 5
    assert {r.chunk_id for r in pipeline.embedded(spark, cfg).collect()} == before
    with pytest.raises(ValueError):
        pipeline.log_status(spark, cfg, files.read_manifest(spark, cfg.manifest_path), "lost")
    with pytest.raises(ValueError):
        pipeline.embed(spark, cfg, False, 1)


def test_one_shard_then_the_rest(spark, finished, tmp_path):
    cfg = copy.deepcopy(finished)
    cfg.paths.scratch = str(tmp_path)
    files.write_partitioned(files.read_chunks(spark, finished.chunks_dir), cfg.chunks_dir, "language")
    pipeline.shard(spark, cfg)
    assert pipeline.embed(spark, cfg, shard_id=1) == files.get_shard(files.read_manifest(spark, cfg.manifest_path), 1).first().approx_chunks
    assert pipeline.index(spark, cfg, "Flat", 1) == cfg.batches_dir
    with pytest.raises(ValueError):
        pipeline.index(spark, cfg, "IVF2,Flat", 1)
    assert pipeline.embed(spark, cfg) == 5
    assert {r.shard_id: r.status for r in sharding.latest_status(pipeline.status_log(spark, cfg)).collect()} == {0: "done", 1: "done", 2: "done"}
    only = pipeline.shard(spark, cfg, languages=["java"])
    assert [r.language for r in only.collect()] == ["java"]
    cfg.model.embed_dim = 63
    with pytest.raises(ValueError):
        pipeline.index(spark, cfg, "Flat")


def test_run_is_evaluated_with_and_without_an_index(spark, finished, tmp_path):
    cfg = copy.deepcopy(finished)
    cfg.paths.scratch, cfg.corpus.languages = str(tmp_path), ["python", "java"]
    rows = files.read_chunks(spark, finished.chunks_dir)
    files.write_partitioned(rows, cfg.chunks_dir, "language")
    (tmp_path / "repos.txt").write_text("o/alpha\no/beta\no/gamma\no/delta\n")
    pipeline.shard(spark, cfg, eval_list=str(tmp_path / "repos.txt"))
    pipeline.embed(spark, cfg)
    flat = pipeline.evaluate(spark, cfg, "test", "both")
    assert flat["n_queries"] > 0 and flat["metrics"]["ann"]["recall_at_10"] == 1.0 and flat["metrics"]["exact"]["n_queries"] == flat["n_queries"]
    pipeline.index(spark, cfg, "IVF2,Flat")
    for metric in ("inner_product", "l2"):
        cfg.index.metric = metric
        assert pipeline.evaluate(spark, cfg, "test", "ann")["metrics"]["ann"]["recall_at_10"] == 1.0
    fs.write_bytes(spark, f"{cfg.index_dir}/model.npz", b"damaged")
    assert pipeline.evaluate(spark, cfg, "test", "both")["metrics"]["ann"] is None
    with pytest.raises(ValueError):
        pipeline.evaluate(spark, cfg, "valid")


def test_models_are_staged_from_folders(spark, tmp_path):
    cfg = config.load(None, {"paths": {"scratch": str(tmp_path / "s")}, "model": {"id": str(tmp_path / "m")}})
    with pytest.raises(FileNotFoundError):
        pipeline.stage_model(spark, cfg)
    (tmp_path / "m" / "sub").mkdir(parents=True)
    (tmp_path / "m" / "sub" / "w.bin").write_bytes(b"123")
    assert pipeline.staged_model(spark, cfg) == cfg.model.id
    folder = pipeline.stage_model(spark, cfg)
    assert pipeline.stage_model(spark, cfg) == folder == pipeline.staged_model(spark, cfg)
    assert fs.read_bytes(spark, f"{folder}/sub/w.bin") == b"123"


def test_files_are_renamed_over(spark, tmp_path):
    p = str(tmp_path / "a" / "x.json")
    fs.write_bytes(spark, p, b"1")
    fs.write_bytes(spark, p, b"22")
    assert fs.read_bytes(spark, p) == b"22" and fs.count_files(spark, str(tmp_path / "a")) in (1, 2)
    assert not [x for x in fs.glob(spark, str(tmp_path / "a" / "*")) if ".tmp" in x]
    assert fs.copy(spark, str(tmp_path / "a"), str(tmp_path / "b")) >= 1 and fs.read_bytes(spark, str(tmp_path / "b" / "x.json")) == b"22"
    fs.delete(spark, str(tmp_path / "a"))
    assert not fs.exists(spark, p)


def test_no_scratch_folder_is_assumed(monkeypatch):
    monkeypatch.delenv("CHUNKLOOM_SCRATCH", raising=False)
    with pytest.raises(ValueError, match="scratch"):
        config.load().under("chunks")


def test_tokenizers_are_plug_ins(spark, tmp_path):
    text = "alpha beta gamma delta " * 40
    assert tokenizers.load("regex")("ab, c") == [(0, 2), (2, 3), (4, 5)]
    tokenizers.register("letters", lambda: lambda t: [(i, i + 1) for i, c in enumerate(t) if c.isalpha()])
    with pytest.raises(ValueError):
        tokenizers.load("other")
    df = spark.createDataFrame([(text, "r", "p", "", "MIT")], "content string, repo_name string, path string, language string, license string")
    by_word = chunk_files(df, ["MIT"], limit=50, overlap=5, least=8).collect()
    by_letter = span_chunks_of(text, tokenizers.load("letters"))
    assert len(by_letter) > len(by_word) > 1 and all(len([c for c in t[6] if c.isalpha()]) <= 50 for t in by_letter)
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = Tokenizer(models.WordLevel({"alpha": 0, "[UNK]": 1}, unk_token="[UNK]"))
    model.pre_tokenizer = pre_tokenizers.Whitespace()
    model.save(str(tmp_path / "t.json"))
    got = chunk_files(df, ["MIT"], limit=50, overlap=5, least=8, tokenizer=str(tmp_path / "t.json")).collect()
    assert [r.n_tokens for r in got] == [r.n_tokens for r in by_word]


def span_chunks_of(text, tokenizer):
    return list(span_chunks(text, "whole_file", "", 1, 50, 5, 8, True, tokenizer))


def test_stream_after_beginning_anew(spark, tmp_path):
    """What follows a run that began anew goes on from that one, and ids that come again in later files add nothing."""
    rows = spark.createDataFrame([("a",), ("b",)], "chunk_id string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    args = (lambda b: b, str(tmp_path / "out"), str(tmp_path / "ck"))
    stream = ingest.read_stream(spark, str(tmp_path / "in"), rows.schema)
    assert ingest.embed_stream(stream, *args) == 2 and ingest.embed_stream(stream, *args, resume=False) == 2
    for new, want in (("c", 3), ("a", 3), ("d", 4)):
        spark.createDataFrame([(new,)], "chunk_id string").write.mode("append").parquet(str(tmp_path / "in"))
        assert ingest.embed_stream(stream, *args) == want
    assert sorted(r.chunk_id for r in ingest.read_sink(spark, str(tmp_path / "out")).collect()) == ["a", "b", "c", "d"]


def test_vector_files_are_whole(spark, tmp_path):
    x = np.arange(24, dtype=np.float32).reshape(8, 3)
    rows = [("a/one.npy", i, x[i].tolist()) for i in range(5)] + [("b/two.npy", i, x[5 + i].tolist()) for i in range(3)]
    df = spark.createDataFrame(rows, "file string, row int, vector array<float>").repartition(4)
    assert {(r.file, r.rows) for r in npy.write_files(df, str(tmp_path / "v")).collect()} == {("a/one.npy", 5), ("b/two.npy", 3)}
    assert np.array_equal(np.load(tmp_path / "v" / "a" / "one.npy"), x[:5]) and np.array_equal(np.load(tmp_path / "v" / "b" / "two.npy"), x[5:])
    half = npy.write_files(df, str(tmp_path / "h"), "float16").count()
    assert half == 2 and np.load(tmp_path / "h" / "b" / "two.npy").dtype == np.float16
    for bad in (("a/one.npy", 5, [1.0]), ("a/one.npy", 7, [1.0, 2.0, 3.0]), ("a/one.npy", 5, None)):
        with pytest.raises(Exception):
            npy.write_files(df.unionByName(spark.createDataFrame([bad], df.schema)), str(tmp_path / "w")).count()
    assert not (tmp_path / "w" / "a" / "one.npy").exists()
    assert npy.write_files(df.limit(0), str(tmp_path / "e")).count() == 0


def test_evaluate(spark, finished):
    rows = pipeline.read_shards(spark, finished).withColumn("eval_split", F.lit("eval_test"))
    got = evaluate.report(rows, "test", strip=False).first()
    assert got.n_queries == 4 and got.recall_at_10 == 1.0
    with pytest.raises(ValueError):
        evaluate.report(rows, "valid")
    with pytest.raises(NotImplementedError):
        evaluate.mteb_benchmark()
    assert publish.qrels_view(rows).columns == ["query_id", "corpus_id", "score", "split"]


def test_cli(spark, finished, tmp_path, capsys):
    (tmp_path / "c.yaml").write_text(json.dumps({"paths": {"scratch": str(tmp_path)}, "model": {"embed_dim": 64}}))
    c = ["--config", str(tmp_path / "c.yaml")]
    assert main(["index", *c], spark) == 2
    assert main(["chunk", *c], spark) == 2
    assert main(["stage", *c], spark) == 2
    with pytest.raises(SystemExit):
        parser().parse_args(["index", *c, "--shard-id", "1", "--all"])


def test_chunking_table_takes_nulls(spark):
    df = spark.createDataFrame([(None, None, None, None, None, 1), ("", "r", "p", "python", "MIT", 2), ("x = 1\n" * 20, None, None, None, "MIT", 3)], "content string, repo_name string, path string, language string, license string, text int")
    got = chunk_files(df, ["MIT"]).collect()
    assert len(got) == 1 and got[0].text_publishable and got[0].repo_name == "" and got[0].symbol_kind == "whole_file"
