"""Problem 9: passages of evaluation items inside training documents, by greedy string tiling.

The hashes of all runs of MIN_WORDS words of the items are the seeds.  A document's rolling (Karp-Rabin) hashes
are looked up in them, so that only documents that share a seed are tiled at all.  The tiling of a document and an
item takes the longest common run of words first, marks it in both, and goes on with what is left, until no run
of MIN_WORDS is left; so reordered passages are all counted.  A document leaks an item if at least one tile was
marked and the tiles cover the asked share of the item's words (none by default: one passage is a leak).

The corpus is read and cut into words once, whatever the size of the item table.  Items of up to MAX_ITEM_CHARACTERS
travel with the tasks, which tile at once.  Larger tables stay in the cluster: the tasks carry a bitmap of their
seeds (MAX_BITS at most; a full one only lets more through), the seeds that pass it are joined with the items' on
the hash, and each pair of a document and an item that this gives is tiled in a row of its own.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import MAX_BITS, WORD_RE, bitmap, checkpointed, in_bitmap, spread

MIN_WORDS = 10
#: Characters of items that may travel with the tasks (some 12 bytes of memory each).
MAX_ITEM_CHARACTERS = 8_000_000
#: Pairs of equal seeds of one document and item that are written down; beyond, matches are sought by their length.
MAX_PAIRS = 50_000
#: Word hashes that a worker remembers.
MEMO = 500_000

_P = np.uint64(0x9E3779B97F4A7C15)
_memo: dict[str, int] = {}
LEAK_COLUMNS = ("doc_id", "item_id", "tiles", "tile_words", "item_words", "longest")
LEAK_SCHEMA = "doc_id bigint, item_id bigint, tiles int, tile_words int, item_words int, longest int"


def rolling(seq: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of k numbers, modulo 2**64."""
    n = len(seq) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    s, h = seq.astype(np.uint64), np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            h = h * _P + s[j : j + n]
        return h ^ (h >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """The 64-bit hashes of a text's words, the same in every process."""
    if len(_memo) > MEMO:
        _memo.clear()
    out = []
    for w in WORD_RE.findall(text.lower()):
        h = _memo.get(w)
        if h is None:
            h = _memo[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little")
        out.append(h)
    return np.array(out, dtype=np.uint64)


class Seeds:
    """The items' words as numbers and their sorted seed hashes."""

    def __init__(self, items: list[tuple[int, str | None]], min_words: int = MIN_WORDS):
        self.k = min_words
        self.vocabulary: dict[str, int] = {}
        self.ids: list[int] = []
        self.seqs: list[np.ndarray] = []
        for item, text in items:
            ws = WORD_RE.findall((text or "").lower())
            if item is not None and len(ws) >= min_words:
                self.ids.append(item)
                self.seqs.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws], dtype=np.int64))
        hashes, at, where = [], [], []
        for n, seq in enumerate(self.seqs):
            h = rolling(seq, min_words)
            hashes.append(h)
            at.append(np.full(len(h), n))
            where.append(np.arange(len(h)))
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(self.hash, kind="stable")
        self.hash = self.hash[order]
        self.item = np.concatenate(at)[order] if at else np.zeros(0, np.int64)
        self.start = np.concatenate(where)[order] if where else np.zeros(0, np.int64)

    def words_of(self, text: str) -> np.ndarray:
        """The numbers of a text's words (0: in no item)."""
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in WORD_RE.findall(text.lower())], dtype=np.int64)

    def candidates(self, seq: np.ndarray) -> Iterator[tuple[int, np.ndarray | None, np.ndarray | None]]:
        """(item number, positions in the document, positions in the item) of the shared seeds of each item; without
        the positions where they would be more than MAX_PAIRS."""
        h = rolling(seq, self.k)
        if not len(self.hash) or not len(h):
            return
        lo = np.searchsorted(self.hash, h, "left")
        hit = np.flatnonzero(self.hash[np.minimum(lo, len(self.hash) - 1)] == h)
        if not len(hit):
            return
        # equal seeds of the document are one group, so an item's seed meets a group and not each of its places
        hit = hit[np.argsort(h[hit], kind="stable")]
        first = np.flatnonzero(np.concatenate(([True], h[hit][1:] != h[hit][:-1])))
        size = np.diff(np.append(first, len(hit)))
        begin = lo[hit[first]]
        many = np.searchsorted(self.hash, h[hit[first]], "right") - begin
        group = np.repeat(np.arange(len(first)), many)
        at = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
        item = self.item[at]
        order = np.argsort(item, kind="stable")
        group, at, item = group[order], at[order], item[order]
        edge = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
        for a, b in zip(edge, np.append(edge[1:], len(item))):
            g = group[a:b]
            n = size[g]
            if n.sum() > MAX_PAIRS:
                yield int(item[a]), None, None
                continue
            place = np.repeat(first[g] - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield int(item[a]), hit[place], np.repeat(self.start[at[a:b]], n)


def _runs(doc: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(-length, document position, item position) of the longest matches: seeds that follow each other on one diagonal.

    A seed is checked word by word, so equal hashes of other words make no match.
    """
    step = np.arange(k)
    same = (doc[i[:, None] + step] == item[j[:, None] + step]).all(axis=1)
    i, j = i[same], j[same]
    order = np.lexsort((i, i - j))
    i, j = i[order], j[order]
    if not len(i):
        return []
    d = i - j
    first = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (i[1:] != i[:-1] + 1))))
    n = np.diff(np.append(first, len(i))) - 1 + k
    return list(zip((-n).tolist(), i[first].tolist(), j[first].tolist()))


def tiling(doc: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy string tiles (document position, item position, length) from the places of equal seeds, the longest
    first; ties by position."""
    tiles: list[tuple[int, int, int]] = []
    used_doc, used_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    heap = _runs(doc, item, i, j, k)
    heapq.heapify(heap)
    while heap:
        less, a, b = heapq.heappop(heap)
        n = -less
        taken = used_doc[a : a + n] | used_item[b : b + n]
        if not taken.any():
            tiles.append((a, b, n))
            used_doc[a : a + n] = used_item[b : b + n] = True
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([1], taken.view(np.int8), [1]))))
        for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if y - x >= k:
                heapq.heappush(heap, (x - y, a + x, b + x))
    return tiles


class _Windows:
    """Hashes of the runs of any length of one sequence, from the hashes of its beginnings."""

    def __init__(self, seq: np.ndarray):
        self.used = np.zeros(len(seq), bool)
        self.seq, s = seq, seq.astype(np.uint64)
        self.power, self.begin = np.ones(len(seq) + 1, np.uint64), np.zeros(len(seq) + 1, np.uint64)
        with np.errstate(over="ignore"):
            self.power[1:] = np.multiply.accumulate(np.full(len(seq), _P, np.uint64)) if len(seq) else []
            # begin[n] = sum of s[m] * P**-(m + 1), so that runs compare after multiplication with P**start
            inverse = np.uint64(pow(int(_P), -1, 1 << 64))
            self.begin[1:] = np.cumsum((s + np.uint64(1)) * np.multiply.accumulate(np.full(len(seq), inverse, np.uint64))) if len(seq) else []

    def free(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start) of the runs of n without a marked place, by start."""
        taken = np.concatenate(([0], np.cumsum(self.used)))
        at = np.flatnonzero(taken[n:] == taken[:-n])
        with np.errstate(over="ignore"):
            return (self.begin[at + n] - self.begin[at]) * self.power[at], at


def tiling_by_length(doc: np.ndarray, item: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The tiles of tiling() without a list of equal seeds, for texts of few words that repeat very often.

    The greatest length that still has a match is found by halving; then all its matches are marked in order.
    """
    d, t = _Windows(doc), _Windows(item)
    tiles: list[tuple[int, int, int]] = []

    def shared(n: int) -> bool:
        return bool(len(np.intersect1d(d.free(n)[0], t.free(n)[0])))

    most = min(len(doc), len(item))
    while most >= k and shared(k):
        lo, hi = k, most
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if shared(mid) else (lo, mid - 1)
        places: dict[int, list[int]] = {}
        h, at = t.free(lo)
        for x, b in zip(h.tolist()[::-1], at.tolist()[::-1]):
            places.setdefault(x, []).append(b)  # the least last
        end = -1
        for x, a in zip(*(v.tolist() for v in d.free(lo))):
            if a < end:
                continue
            left = places.get(x)
            while left and t.used[left[-1] : left[-1] + lo].any():
                left.pop()
            if left and np.array_equal(doc[a : a + lo], item[left[-1] : left[-1] + lo]):
                b = left.pop()
                tiles.append((a, b, lo))
                d.used[a : a + lo] = t.used[b : b + lo] = True
                end = a + lo
        most = lo - 1
    return tiles


def _row(tiles: list[tuple[int, int, int]], item: np.ndarray) -> tuple[int, int, int, int]:
    """(tiles, words under tiles, words of the item, longest tile)."""
    return len(tiles), sum(t[2] for t in tiles), len(item), tiles[0][2]


def leaks_of(text: str | None, seeds: Seeds) -> list[tuple[int, int, int, int, int]]:
    """(item, tiles, words under tiles, words of the item, longest tile) of each item that a text leaks."""
    if not text:
        return []
    seq, out = seeds.words_of(text), []
    for n, i, j in seeds.candidates(seq):
        item = seeds.seqs[n]
        tiles = tiling_by_length(seq, item, seeds.k) if i is None else tiling(seq, item, i, j, seeds.k)
        if tiles:
            out.append((seeds.ids[n], *_row(tiles, item)))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), *[pa.int32()] * 4])], list(LEAK_COLUMNS))


def _with_small_items(docs: DataFrame, items: DataFrame, min_words: int) -> DataFrame:
    rows = sorted((r.item_id, r.text) for r in items.collect())  # MAX_ITEM_CHARACTERS at most, checked
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        seeds = Seeds(shared.value, min_words)
        for batch in batches:
            yield _batch([(d, *x) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in leaks_of(t, seeds)])

    return docs.mapInArrow(run, LEAK_SCHEMA)


def seed_table(items: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(item_id, h): the distinct seeds of each item."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = np.unique(rolling(word_hashes(text), min_words)).view(np.int64)
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(h), pa.int64()), pa.array(h)], ["item_id", "h"])

    return items.mapInArrow(run, "item_id bigint, h bigint")


def _with_large_items(docs: DataFrame, items: DataFrame, min_words: int, max_bits: int) -> DataFrame:
    seeds = checkpointed(seed_table(items, min_words))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(seeds.select("h"), seeds.count(), max_bits))

    def sift(batches):
        there = shared.value
        for batch in batches:
            keep, hits = [], []
            for n, text in enumerate(batch.column(2).to_pylist()):
                h = np.unique(rolling(word_hashes(text or ""), min_words))
                got = h[in_bitmap(there, h)]
                if len(got):
                    keep.append(n)
                    hits.append(got.view(np.int64))
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(hits, pa.list_(pa.int64()))], ["key", "doc_id", "text", "hits"])

    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    hit = checkpointed(keyed.mapInArrow(sift, "key bigint, doc_id bigint, text string, hits array<bigint>"))
    pairs = hit.select("key", "doc_id", F.explode("hits").alias("h")).join(seeds, "h").select("key", "doc_id", "item_id").distinct()
    told = pairs.join(items.withColumnRenamed("text", "item_text"), "item_id").alias("p").join(hit.select("key", "doc_id", "text").distinct().alias("d"), (F.col("p.key") == F.col("d.key")) & F.col("p.doc_id").eqNullSafe(F.col("d.doc_id")))

    def tile(batches):
        for batch in batches:
            rows = []
            for doc, item, text, item_text in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(doc, *x) for x in leaks_of(text, Seeds([(item, item_text)], min_words))]
            yield _batch(rows)

    return told.select("p.doc_id", "item_id", "d.text", "item_text").mapInArrow(tile, LEAK_SCHEMA)


def leaks(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, min_coverage: float = 0.0, max_item_characters: int = MAX_ITEM_CHARACTERS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per (document, item) that share at least one tile of min_words words and whose tiles cover at least
    min_coverage of the item's words.

    Null and empty texts leak nothing; an item shorter than min_words words can't be found; repeated document
    rows count once; items without an id are left out, of items that share an id each text is tiled on its own.
    """
    items = items.select(F.col("item_id").cast("bigint"), "text").where("item_id is not null and text is not null").distinct()
    characters = items.agg(F.sum(F.length("text"))).first()[0] or 0
    docs = spread(docs.select(F.col("doc_id").cast("bigint"), "text"))
    found = _with_small_items(docs, items, min_words) if characters <= max_item_characters else _with_large_items(docs, items, min_words, max_bits)
    return found.where(F.col("tile_words") >= min_coverage * F.col("item_words")).distinct()


def leak_report(found: DataFrame, items: DataFrame, most: float = 0.5) -> DataFrame:
    """Per item: in how many documents it leaks, in how many of them most of its words do, and the largest share of its
    words under tiles of one document."""
    share = F.col("tile_words") / F.col("item_words")
    per = found.groupBy("item_id").agg(
        F.countDistinct("doc_id").alias("documents"),
        F.countDistinct(F.when(share >= most, F.col("doc_id"))).alias("mostly"),
        F.max(F.round(share, 6)).alias("coverage"),
        F.max("longest").alias("longest"),
    )
    return items.select("item_id", "item_split", "task").distinct().join(per, "item_id", "left").na.fill(0, ["documents", "mostly", "longest"]).na.fill(0.0, ["coverage"])
