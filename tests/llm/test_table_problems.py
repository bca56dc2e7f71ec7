"""Problems 2, 3, 4 and 5: operators on tables against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chunkloom.llm import grouped_split, hnsw, neighbours, overlap, splitting

# -- problem 2 -----------------------------------------------------------------------------------------------------


def _clustered(n, seed=1, d=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 40), d))
    return centres[rng.integers(0, len(centres), n)] + rng.uniform(0.3, 1.2, (n, 1)) * rng.normal(size=(n, d))


def _exact(ids, x, k=5):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(x @ x.T, 9)
    out = set()
    for i in range(len(ids)):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[i, j], ids[j]))[:k]
        out |= {tuple(sorted((ids[i], ids[j]))) for j in order}
    return out


def test_graph_recall():
    x = _clustered(3000)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    g = hnsw.Graph(x)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    true = np.argpartition(-s, 5, axis=1)[:, :5]
    nodes, sims = g.refine(5, 20)
    assert np.mean([np.isin(true[i], nodes[i]).mean() for i in range(len(x))]) > 0.95
    assert not (nodes == np.arange(len(x))[:, None]).any()
    found, _ = g.search(x[:200], 6)
    assert np.mean([np.isin(true[i], found[i]).mean() for i in range(200)]) > 0.95
    assert all(len(np.unique(r[r >= 0])) == (r >= 0).sum() for r in nodes)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 70])
def test_small_graphs_are_exact(n):
    x = _clustered(max(n, 2))[:n]
    x = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    nodes, _ = hnsw.Graph(x).refine(3) if n else (np.zeros((0, 3)), None)
    for i in range(n):
        want = sorted((j for j in range(n) if j != i), key=lambda j: -(x[i] @ x[j]))[:3]
        assert set(nodes[i][nodes[i] >= 0].tolist()) == set(want)


def _vectors(spark, ids, x, extra=()):
    rows = [(i, v.tolist(), "m") for i, v in zip(ids, x)] + list(extra)
    return spark.createDataFrame(rows, "chunk_id string, embedding array<float>, key string").repartition(5)


@pytest.mark.parametrize("shard_rows", [100_000, 400])
def test_neighbours_against_brute_force(spark, shard_rows):
    x = _clustered(1600, 3)
    x[1500:1560] = x[7]  # many equal ones
    x = x.astype(np.float32).astype(float)
    ids = [f"{i:05d}" for i in random.Random(2).sample(range(99_999), len(x))]
    got = {tuple(r) for r in neighbours.pairs(_vectors(spark, ids, x), shard_rows=shard_rows).collect()}
    want = _exact(ids, x)
    assert len(got & want) / len(want) > 0.93 and len(got & want) / len(got) > 0.93
    assert all(a < b for a, b in got)


@pytest.mark.parametrize("k", [1, 12])
def test_neighbours_of_any_number(spark, k):
    x = _clustered(700, 5).astype(np.float32).astype(float)
    x[600:640] = x[3]
    ids = [f"{i:04d}" for i in range(len(x))]
    got = {r.chunk_id: [n.id for n in r.neighbours] for r in neighbours.neighbours(_vectors(spark, ids, x), k).collect()}
    assert all(len(v) == k for v in got.values())
    want = _exact(ids, x, k)
    found = {tuple(sorted((a, b))) for a, bs in got.items() for b in bs}
    assert len(found & want) / len(want) > 0.93 and len(found & want) / len(found) > 0.93


def test_neighbours_edges(spark):
    zero, e = [0.0] * 64, [[float(i == j) for j in range(64)] for i in range(3)]
    extra = [("z", zero, "m"), ("n", None, "m"), ("s", [1.0] * 32, "m"), ("h", [None, *e[0][1:]], "m"), (None, e[0], "m"), ("a", e[0], "m"), ("b", e[0], "m"), ("a", e[0], "m")]
    got = {tuple(r) for r in neighbours.pairs(_vectors(spark, [], [], extra)).collect()}
    assert got == {("a", "b")}
    assert neighbours.pairs(_vectors(spark, [], [], extra[:4])).count() == 0
    # seven equal ones: each has the five smallest others
    same = [(c, e[1], "m") for c in "abcdefg"]
    got = {tuple(r) for r in neighbours.pairs(_vectors(spark, [], [], same)).collect()}
    assert got == _exact(list("abcdefg"), np.array([e[1]] * 7))


# -- problem 3 -----------------------------------------------------------------------------------------------------


@given(st.lists(st.sampled_from(["word", "x1", "(", ")", ";", "\n", "\n\n", "  ", "é", "中", "}"]), max_size=400), st.integers(12, 40), st.integers(0, 8))
@settings(max_examples=150, deadline=None)
def test_pieces_cover_the_text(parts, limit, overlap_):
    text = " ".join(parts)
    tk = splitting.tokens(text)
    pieces = splitting.split_text(text, limit, overlap_)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(tk)
    assert pieces[0][2] == 0 and pieces[-1][3] == len(text)
    for (s, e, a, b, p) in pieces:
        assert e - s <= limit and splitting.tokens(p) == tk[s:e] and text[a:b] == p
    for p, q in zip(pieces, pieces[1:]):
        assert q[0] == p[1] - overlap_ and q[1] > p[1]


def test_cuts_are_optimal():
    rng = random.Random(4)
    for _ in range(60):
        n, limit, over = rng.randint(11, 40), 10, 3
        penalty = np.array([0.0] + [rng.choice([0.0, 0.2, 0.5]) for _ in range(n - 1)] + [0.0])
        least = -(-(n - over) // (limit - over))
        even = over + (n - over) / least
        cost = lambda p: sum(1 + splitting.EVENNESS * ((e - s - even) / limit) ** 2 + (penalty[e] if e < n else 0) for s, e in p)

        best, work = None, [[(0, e)] for e in range(over + 1, min(limit, n) + 1)]
        while work:  # all ways to cut
            p = work.pop()
            if p[-1][1] == n:
                best = min(best, cost(p)) if best is not None else cost(p)
                continue
            s = p[-1][1] - over
            if len(p) < 7:
                work += [[*p, (s, e)] for e in range(p[-1][1] + 1, min(s + limit, n) + 1)]
        assert cost(splitting.cuts(n, penalty, limit, over)) == pytest.approx(best)


def test_split_table(spark):
    long = "def f():\n    return 1\n\n" * 200
    df = spark.createDataFrame([("a", long, 1, 5), ("a", long, 2, 5), ("b", "x " * 512, 1, 5), ("c", "x " * 513, 0, None), ("d", None, 999, 1), ("e", "", 999, 1), ("f", "z" * 100_000, 1, 1), (None, "x," * 300, 1, 1)], "chunk_id string, text string, n_tokens int, piece int")
    got = splitting.split_oversized(df).collect()
    assert {r.chunk_id for r in got} == {"a", "c", None}
    assert sum(r.chunk_id == "a" for r in got) == max(r.pieces for r in got if r.chunk_id == "a")
    assert splitting.split_oversized(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        splitting.cuts(100, np.zeros(101), 10, 9)


def test_cuts_prefer_natural_boundaries():
    text = ("a b c d e f g h\n" * 20 + "\n") * 6
    for s, e, a, b, p in splitting.split_text(text, 300, 10)[:-1]:
        assert text[b : b + 1] == "\n"


# -- problem 4 -----------------------------------------------------------------------------------------------------


def _canonical(spark, names):
    from pyspark.sql import functions as F

    return [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(grouped_split.canonical_or_self(F.col("n"))).collect()]


def test_spellings(spark):
    same = ["owner/na.me-1", "OWNER/Na.me-1", " owner/na.me-1 ", "owner/na.me-1/", "owner/na.me-1.git", "https://git.example/owner/na.me-1", "https://u:p@git.example:8080/owner/na.me-1.git", "git@git.example:owner/na.me-1.git", "ssh://git@git.example/owner/na.me-1", "git.example/owner/na.me-1", "owner/na.me-1/tree/main", "https://www.git.example/owner/na.me-1?x=1#y", "host:owner/na.me-1"]
    assert set(_canonical(spark, same)) == {"owner/na.me-1"}
    assert _canonical(spark, ["single", " ", None]) == ["single", None, None]


def test_components_of_long_chains(spark):
    rng = random.Random(7)
    pairs = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("z1", "z2"), ("z2", "z3")] + [(f"n{rng.randint(0, 60):03d}", f"n{rng.randint(0, 60):03d}") for _ in range(3)] + [("hub", f"s{i}") for i in range(200)]
    df = spark.createDataFrame([p for p in pairs if p[0] != p[1]], "a string, b string")
    got = {r.name: r.label for r in grouped_split.components(df).collect()}
    assert all(v == "n000" for k, v in got.items() if k.startswith("n0")) and got["z3"] == "z1" and got["s77"] == "hub"


def _chunks4(spark):
    rows = [("1", "A/x", "eval_test", "go"), ("2", "a/x.git", "index_only", "go"), ("3", "b/y", "eval_test", "go"), ("4", "c/z", "index_only", "go"), ("5", "d/w", "eval_valid", "java"), ("6", "e/v", "", "java"), ("7", "e/v", None, None), ("8", "e/v", "eval_test", ""), ("9", None, "eval_test", "go"), ("10", None, "index_only", "go"), ("1", "A/x", "eval_test", "go")]
    chunks = spark.createDataFrame([(*r, 1) for r in rows], "chunk_id string, repo_name string, eval_split string, language string, label int")
    links = spark.createDataFrame([("b/y", "gone/1", "renamed_to"), ("gone/1.git", "C/z", "moved_to"), ("c/z", "d/w", "mentions"), ("d/w", None, "mirror_of"), (None, None, None)], "src_repo string, dst_repo string, relation string")
    return chunks, links


def test_violations(spark):
    chunks, links = _chunks4(spark)
    got = {r.repo_name: r.splits for r in grouped_split.violations(chunks, links).collect()}
    assert got == {"A/x": ["eval_test", "index_only"], "b/y": ["eval_test", "index_only"]}
    assert grouped_split.violations(chunks.limit(0), links).count() == 0
    assert {r.repo_name for r in grouped_split.violations(chunks, links.limit(0)).collect()} == {"A/x"}


def test_assignment_keeps_entities_and_shares(spark):
    chunks, links = _chunks4(spark)
    got = grouped_split.assign(chunks, links).collect()
    assert len(got) == chunks.count()
    of = {r.chunk_id: r.new_split for r in got}
    assert of["1"] == of["2"] and of["3"] == of["4"] and of["6"] == of["7"] == of["8"]
    many = spark.range(6000).selectExpr("cast(id as string) chunk_id", "concat('o/r', cast(case when id % 3 = 0 then 0 else id % 900 end as string)) repo_name", "case when id % 2 = 0 then 'go' else 'java' end language")
    got = grouped_split.assign(many, links, {"index_only": 0.6, "eval_valid": 0.2, "eval_test": 0.2})
    assert got.count() == 6000 and got.groupBy("repo_name").agg({"new_split": "max"}).count() == got.select("repo_name", "new_split").distinct().count()
    n = {r.new_split: r["count"] for r in got.groupBy("new_split").count().collect()}
    assert abs(n["eval_valid"] / 6000 - 0.2) < 0.03 and abs(n["eval_test"] / 6000 - 0.2) < 0.03


# -- problem 5 -----------------------------------------------------------------------------------------------------


def _records(seed=8, n=220):
    rng = random.Random(seed)
    names = [f"v{i}" for i in range(30)]

    def text(n):
        return " ".join(rng.choice(names) + rng.choice(["(", ")", " +", "\n", ""]) for _ in range(n))

    bases = [text(rng.randint(10, 90)) for _ in range(12)]
    queries = [None, "too short to count", *[f"Where is the part number {i} kept, and who reads it?" for i in range(4)]]
    rows = []
    for i in range(n):
        ws = rng.choice(bases).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            ws[rng.randrange(len(ws))] = rng.choice(names)
        if rng.random() < 0.2:
            ws = ws + text(rng.randint(1, 20)).split(" ")
        rows.append((f"{i:04d}", " ".join(ws).upper() if i % 7 == 0 else " ".join(ws), rng.choice(["eval_test", "eval_valid", "index_only", "index_only", "", None]), rng.choice(queries), rng.choice("rs")))
    return rows


def _overlaps(rows):
    want = {}
    for a, ta, sa, qa, _ in rows:
        for b, tb, sb, qb, _ in rows:
            if sa in overlap.EVAL and sb in overlap.TRAIN:
                alike = min(len(overlap.tokens_of(ta)), len(overlap.tokens_of(tb))) >= 30 and overlap.similarity(ta, tb) >= 0.7
                if alike or qa and qa == qb and len(qa.split()) >= 8:
                    want[tuple(sorted((a, b)))] = a
    return want


@pytest.mark.parametrize(("hot", "counters"), [(64, None), (2, 1 << 18), (2, 64)])
def test_overlap_against_brute_force(spark, monkeypatch, hot, counters):
    """With few counters nearly all of them are shared; with a low limit most entries are hot."""
    monkeypatch.setattr(overlap, "HOT", hot)
    if counters:
        monkeypatch.setattr(overlap, "counters_for", lambda _: counters)
    rows = _records()
    df = spark.createDataFrame([(*r, 1.0) for r in rows] + [(*rows[0], 1.0), ("n", None, "eval_test", None, None, 1.0)], "chunk_id string, text string, eval_split string, query_text string, repo_name string, similarity double").repartition(4)
    want = _overlaps(rows)
    assert len(want) > 100
    assert {(r.chunk_id_a, r.chunk_id_b) for r in overlap.overlaps(df).collect()} == set(want)
    leaked = Counter(want.values())
    report = {}
    for c, _, s, _, repo in rows:
        if s in overlap.EVAL:
            a, b, n = report.get((s, repo), (0, 0, 0))
            report[s, repo] = (a + 1, b + (leaked[c] > 0), n + leaked[c])
    report["eval_test", None] = (1, 0, 0)
    assert {(r.eval_split, r.repo_name): (r.chunks, r.leaked, r["pairs"]) for r in overlap.report(df).collect()} == report


def test_sketch_follows_the_size_and_is_never_too_low(spark):
    assert overlap.counters_for(0) == overlap.LEAST_COUNTERS and overlap.counters_for(1 << 40) == overlap.MOST_COUNTERS
    assert overlap.counters_for(40_000_000) == 1 << 24
    text = " ".join(f"w{i}" for i in range(60))
    sketch = overlap.frequency_sketch(spark.createDataFrame([(text,)] * 70 + [("w1 w2",)], "text string").repartition(3), 1 << 18)
    h = overlap.shingle_hashes(overlap.tokens_of(text))
    assert (sketch[overlap._slots(h, len(sketch))] >= overlap._level(np.array(70))).all()


def test_sketch_parts_follow_the_texts_and_not_the_counters(spark, monkeypatch):
    """each task passed on whole blocks of counters, so the work grew with tasks times counters."""
    sent, folded = [], overlap.blocks_folded

    def spied(parts, *args, **kwargs):
        sent.append(parts.selectExpr("sum(length(data))").first()[0])
        return folded(parts, *args, **kwargs)

    monkeypatch.setattr(overlap, "blocks_folded", spied)
    texts = [" ".join(f"w{i}x{k % 4}" for i in range(60)) for k in range(8)]
    sketch = overlap.frequency_sketch(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4), 1 << 22)
    counts = Counter(h for t in texts for h in overlap._slots(overlap.shingle_hashes(overlap.tokens_of(t)), 1 << 22).tolist())
    assert {i: int(sketch[i]) for i in np.flatnonzero(sketch).tolist()} == {i: int(overlap._level(np.array(n))) for i, n in counts.items()}
    assert sent[0] <= 4 * sum(counts.values())


def test_overlap_of_sets_of_all_sizes_at_the_threshold(spark):
    """Pairs just above and below the threshold, of equal and of very different sizes, whatever their common entries' places."""
    rnd = np.random.default_rng(5)
    rows = []
    for k, n in enumerate([30, 31, 34, 40, 60, 100, 180] * 3):
        base = [f"w{x}" for x in rnd.integers(0, 4000 if k % 2 else 60, n)]
        rows.append((f"e{k}", " ".join(base), "eval_test"))
        for c in range(12):
            other = list(base)
            for at in rnd.integers(0, n, rnd.integers(0, max(2, n // 14))):
                other[at] = f"w{rnd.integers(0, 4000)}"
            cut = rnd.integers(0, n // 3)
            rows.append((f"t{k}_{c}", " ".join(other[cut:] if c % 3 else other + base[:cut] if c % 2 else [*other, *(f"v{i}" for i in range(cut))]), "index_only"))
    want = {tuple(sorted((a, b))) for a, x, s in rows for b, y, z in rows if s == "eval_test" and z == "index_only" and min(len(x.split()), len(y.split())) >= 30 and overlap.similarity(x, y) >= 0.7}
    df = spark.createDataFrame([(c, t, s, None) for c, t, s in rows], "chunk_id string, text string, eval_split string, query_text string")
    assert 40 < len(want) < 21 * 12
    assert {(r.chunk_id_a, r.chunk_id_b) for r in overlap.overlaps(df).collect()} == want


def test_query_overlap(spark):
    q = "How do I open, the file: and read it?"
    rows = [("a", q, "eval_test"), ("b", q.upper().replace(",", "\n"), "index_only"), ("c", q + " now", "index_only"), ("d", "only seven words are in this text", "eval_test"), ("e", "only seven words are in this text", "index_only"), ("f", None, "index_only"), ("a", q, "eval_test"), ("g", q, "eval_valid"), ("h", q, "")]
    df = spark.createDataFrame([(c, None, s, t, "r", 1) for c, t, s in rows], "chunk_id string, text string, eval_split string, query_text string, repo_name string, by_text int")
    assert {tuple(r) for r in overlap.overlaps(df).select("chunk_id_a", "chunk_id_b", "by_query").collect()} == {("a", "b", 1), ("b", "g", 1)}
    got = {(r.eval_split, r.repo_name): (r.chunks, r.leaked, r["pairs"]) for r in overlap.report(df).collect()}
    assert got == {("eval_test", "r"): (2, 1, 1), ("eval_valid", "r"): (1, 1, 1)}
    assert overlap.overlaps(df.limit(0)).count() == 0
