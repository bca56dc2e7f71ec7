"""Problem 4: splits that keep all records of one entity together.

Spellings of a repository are reduced to one owner/name.  Same-entity links make a graph of names; labels
spread over it by iterative minimum propagation over the two-sided graph of links and names (each link takes
the least label of its two names, each name the least label of its links), with the label's own label taken
at the end of a round, so chains shorten by half.  Groups are then dealt to the splits: large ones one by
one, small ones in hashed buckets per stratum, always where the label distribution deviates least.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import checkpointed

#: Relations that make two repositories one entity.
SAME_ENTITY = ("renamed_to", "moved_to", "forked_from", "mirror_of")
#: Splits and their default shares.
SHARES = {"index_only": 0.90, "eval_valid": 0.05, "eval_test": 0.05}
#: Hashed buckets per stratum, and the share of all rows from which a group is dealt by itself.
BUCKETS, LARGE = 200, 0.001

_LEAD = r"^(?:[a-z][a-z0-9+.\-]*://(?:[^/@\s]*@)?[^/\s]*/+|[^/@\s]*@[^/:\s]+[:/]+|(?:www\.)?[a-z0-9\-]+(?:\.[a-z0-9\-]+)+(?::\d+)?/+(?=[^/\s]+/[^/\s]+)|[a-z0-9.+\-]+:(?=[^/\s]))"


def canonical(name: Column) -> Column:
    """owner/name in lower case without what stands before or after it; null without such a pair."""
    bare = F.regexp_replace(F.lower(F.trim(F.regexp_replace(name, r"\s+", " "))), _LEAD, "")
    owner = F.regexp_extract(bare, r"^/*([^/\s?#]+)/+([^/\s?#@]+)", 1)
    repo = F.regexp_replace(F.regexp_extract(bare, r"^/*([^/\s?#]+)/+([^/\s?#@]+)", 2), r"(?:\.git)+$", "")
    return F.when((owner != "") & (repo != ""), F.concat_ws("/", owner, repo))


def canonical_or_self(name: Column) -> Column:
    """As canonical, but a name without a pair stands for itself (trimmed, lower case); null and blank stay null."""
    return F.coalesce(canonical(name), F.nullif(F.lower(F.trim(name)), F.lit("")))


def edges(links: DataFrame) -> DataFrame:
    """Distinct (a, b) of names that a same-entity link connects, a < b."""
    a, b = canonical_or_self(F.col("src_repo")), canonical_or_self(F.col("dst_repo"))
    same = links.where(F.lower(F.trim("relation")).isin(*SAME_ENTITY)).select(a.alias("a"), b.alias("b")).where("a <> b")
    return same.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(pairs: DataFrame, rounds: int = 64) -> DataFrame:
    """(name, label) for every name in the links; the label is the least name of its component.

    A round joins the labels twice to the links and once to themselves; each side of those joins has one row per
    name, and the links at a name of very many links are split by the adaptive skew join, for the minimum is
    taken before the exchange.  It ends when no label changes.
    """
    links = checkpointed(pairs)
    labels = checkpointed(links.select(F.explode(F.array("a", "b")).alias("name")).distinct().withColumn("label", F.col("name")))
    for _ in range(rounds):
        la = labels.select(F.col("name").alias("a"), F.col("label").alias("x"))
        lb = labels.select(F.col("name").alias("b"), F.col("label").alias("y"))
        least = links.join(la, "a").join(lb, "b").select("a", "b", F.least("x", "y").alias("m"))
        spread = least.select(F.explode(F.array("a", "b")).alias("name"), "m").groupBy("name").agg(F.min("m").alias("m"))
        near = labels.join(spread, "name").select("name", F.least("label", "m").alias("near"), F.col("label").alias("old"))
        far = labels.select(F.col("name").alias("near"), F.col("label").alias("far"))
        new = checkpointed(near.join(far, "near", "left").select("name", F.least("near", "far").alias("label"), "old"))
        changed = not new.where("label <> old").isEmpty()
        labels = new.select("name", "label")
        if not changed:
            return labels
    raise RuntimeError("the labels did not settle")


def entities(chunks: DataFrame, links: DataFrame) -> DataFrame:
    """(repo_name, entity) of each distinct spelling in chunks; null and blank names have no entity."""
    names = chunks.select("repo_name").where("repo_name is not null").distinct().withColumn("name", canonical_or_self(F.col("repo_name"))).where("name is not null")
    return names.join(components(edges(links)), "name", "left").select("repo_name", F.coalesce("label", "name").alias("entity"))


def violations(chunks: DataFrame, links: DataFrame) -> DataFrame:
    """(repo_name, splits, rows) of the entities whose chunks carry two or more different non-empty eval_split values.

    repo_name is the least spelling (byte order) in chunks.  Rows without repo_name belong to no entity; empty and
    null splits don't count; repeated rows change nothing but `rows`.  The rows are counted per spelling and split
    before anything is joined, so a repository with a third of all rows is a few rows.
    """
    per = chunks.where("repo_name is not null").groupBy("repo_name", F.nullif(F.trim("eval_split"), F.lit("")).alias("split")).agg(F.count("*").alias("n"))
    per = checkpointed(per)
    joined = per.join(entities(per, links), "repo_name")
    grouped = joined.groupBy("entity").agg(F.min("repo_name").alias("repo_name"), F.sort_array(F.collect_set("split")).alias("splits"), F.sum("n").alias("rows"))
    return grouped.where(F.size("splits") > 1).select("repo_name", "splits", "rows")


def deal(groups: list[tuple[str, np.ndarray]], shares: dict[str, float]) -> dict[str, str]:
    """Assigns groups (key, counts per label), the largest first, each to the split where the squared deviation grows least."""
    if not groups:
        return {}
    names = list(shares)
    total = np.sum([g for _, g in groups], axis=0).astype(float)
    want = np.array([[shares[s] * t for t in total] for s in names])
    scale = np.maximum(want.sum(axis=1, keepdims=True), 1.0)
    have = np.zeros_like(want)
    out = {}
    for key, counts in sorted(groups, key=lambda g: (-g[1].sum(), g[0])):
        before = (((have - want) / scale) ** 2).sum(axis=1)
        after = (((have + counts - want) / scale) ** 2).sum(axis=1)
        k = int(np.argmin(np.round(after - before, 12)))
        have[k] += counts
        out[key] = names[k]
    return out


def assign(chunks: DataFrame, links: DataFrame, shares: dict[str, float] | None = None, label_col: str = "language", seed: int = 42, buckets: int = BUCKETS, large: float = LARGE) -> DataFrame:
    """(chunk_id, repo_name, new_split) with every entity in one split and the labels' distribution kept.

    A stratum is an entity's most frequent label (the 20 most frequent labels, the rest in one).  What the driver
    gets is bounded: at most 1/large groups dealt by themselves and 21 x buckets sums of hashed small groups.
    Rows without repo_name are entities of their own by chunk_id.  Repeated rows give repeated results.
    """
    shares = shares or SHARES
    label = F.coalesce(F.nullif(F.lower(F.trim(F.col(label_col))), F.lit("")), F.lit("none"))
    base = chunks.select("chunk_id", "repo_name", label.alias("label"))
    own = F.coalesce("repo_name", F.concat(F.lit("chunk:"), "chunk_id"))
    top = [r[0] for r in base.groupBy("label").count().orderBy(F.desc("count"), "label").limit(20).collect()]
    place = {v: i for i, v in enumerate(top)}
    slots = len(top) + 1
    kind = F.coalesce(F.create_map(*[x for k, i in place.items() for x in (F.lit(k), F.lit(i))])[F.col("label")], F.lit(slots - 1)) if top else F.lit(0)
    per = checkpointed(base.groupBy(own.alias("own"), "repo_name", kind.alias("kind")).agg(F.count("*").alias("n")))
    named = entities(per, links)
    keyed = per.join(named, "repo_name", "left").select("own", F.coalesce("entity", "own").alias("entity"), "kind", "n")
    sums = keyed.groupBy("entity").agg(*[F.sum(F.when(F.col("kind") == i, F.col("n")).otherwise(0)).alias(f"c{i}") for i in range(slots)])
    counts = [F.col(f"c{i}") for i in range(slots)]
    size = sum(counts[1:], counts[0])
    groups = checkpointed(sums.withColumn("size", size))
    total = groups.agg(F.sum("size")).first()[0] or 0
    biggest = F.array_position(F.array(*counts), F.greatest(*counts) if slots > 1 else counts[0])
    bucket = F.when(F.col("size") >= F.lit(max(2.0, large * total)), F.concat(F.lit("e:"), "entity")).otherwise(
        F.concat(F.lit("b:"), biggest.cast("string"), F.lit(":"), F.pmod(F.xxhash64(F.lit(seed), "entity"), F.lit(buckets)).cast("string"))
    )
    groups = groups.withColumn("bucket", bucket)
    rows = groups.groupBy("bucket").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(slots)]).collect()
    dealt = deal([(r[0], np.array([float(x) for x in r[1:]])) for r in rows], shares)
    spark = chunks.sparkSession
    table = spark.createDataFrame(sorted(dealt.items()) or [("", "")], "bucket string, new_split string")
    split_of = keyed.select("own", "entity").distinct().join(groups.select("entity", "bucket"), "entity").join(F.broadcast(table), "bucket").select("own", "new_split")
    return chunks.select("chunk_id", "repo_name", own.alias("own")).join(split_of, "own").select("chunk_id", "repo_name", "new_split")
