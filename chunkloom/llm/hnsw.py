"""Hierarchical navigable small-world graphs in flat numpy arrays, built and searched many queries at a time.

A layer is one int32 array of neighbours per node (padded with the number of a dummy node) with the matching
similarities.  Searches advance in lock-step: each step expands the best open candidates of all queries, so
the work is in numpy kernels and not in the interpreter.  A candidate is one int64: the ordered bits of its
similarity, its node number and whether it was expanded; sorting these keeps the beam, and equal ones are
neighbours after sorting, so they are dropped without a table of visited nodes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Links that a new node takes, room for links (a full list is pruned to half), beam widths, nodes expanded per step.
LINKS, ROOM, EF_BUILD, EF_SEARCH, STEP = 16, 32, 48, 40, 4
#: Queries that advance together, and nodes inserted together.
LANE, BATCH = 512, 1024

_OPEN = np.int64(1)


def _pack(sim: np.ndarray, node: np.ndarray, expanded: int) -> np.ndarray:
    """Sortable keys, the most similar first in ascending order."""
    bits = np.ascontiguousarray(sim, dtype=np.float32).view(np.int32).astype(np.int64)
    bits = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFF), bits)
    return (-bits << 32) + (node.astype(np.int64) << 1) + (1 - expanded)


def _sim(key: np.ndarray) -> np.ndarray:
    bits = -(key >> 32)
    bits = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFF), bits)
    return bits.astype(np.int32).view(np.float32)


def _node(key: np.ndarray) -> np.ndarray:
    return ((key & np.int64(0xFFFFFFFF)) >> 1).astype(np.int32)


_LAST = np.int64(1) << 62


def _unique(keys: np.ndarray) -> np.ndarray:
    """Sorted rows in which each node stands once, with its best key: the same pair's similarity may differ in its last
    bit by the kernel that computed it."""
    node = _node(keys)
    twice = np.tril(node[:, :, None] == node[:, None, :], -1).any(axis=2) & (keys < _LAST)
    if twice.any():
        keys = np.where(twice, _LAST, keys)
        keys.sort(axis=1)
    return keys


@dataclass
class Layer:
    """One layer: which nodes it holds, their links and the similarities of these."""

    size: int
    links: np.ndarray = field(init=False)
    sims: np.ndarray = field(init=False)
    count: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.links = np.full((self.size + 1, ROOM), self.size, dtype=np.int32)
        self.sims = np.full((self.size + 1, ROOM), -2.0, dtype=np.float32)
        self.count = np.zeros(self.size + 1, dtype=np.int32)


class Graph:
    """The graph of one shard; vectors are rows of unit length, and the nodes are inserted in the order given."""

    def __init__(self, vectors: np.ndarray, seed: int = 42):
        self.n, self.d = vectors.shape
        self.x = np.vstack([vectors.astype(np.float32), np.zeros((1, self.d), np.float32)])  # the last one is the dummy
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(np.maximum(rng.random(self.n), 1e-12)) / np.log(LINKS)).astype(np.int32), 6)
        if self.n:
            self.level[0] = self.level.max()
        self.layers = [Layer(self.n) for _ in range(int(self.level.max()) + 1)] if self.n else []
        self.near = np.full((self.n, EF_BUILD // 2), _LAST, dtype=np.int64)  # the best seen so far of each node
        self._build()

    # -- search ------------------------------------------------------------------------------------------------

    def _beam(self, layer: Layer, q: np.ndarray, keys: np.ndarray, ef: int) -> np.ndarray:
        """Advances beams (rows of keys, sorted) until no beam holds an open candidate."""
        if keys.shape[1] < ef:
            keys = np.concatenate([keys, np.full((len(keys), ef - keys.shape[1]), _LAST)], axis=1)
        out = keys.copy()
        alive = np.arange(len(q))
        while len(alive):
            open_ = ((keys & _OPEN) == 1) & (keys < _LAST)
            some = open_.any(axis=1)
            if not some.all():
                out[alive[~some]] = keys[~some]
                alive, keys, open_, q = alive[some], keys[some], open_[some], q[some]
                if not len(alive):
                    break
            step = min(STEP, ef)
            at = np.argsort(~open_, axis=1, kind="stable")[:, :step]
            rows = np.arange(len(keys))[:, None]
            chosen = keys[rows, at]
            valid = open_[rows, at]
            keys[rows, at] = np.where(valid, chosen & ~_OPEN, chosen)
            nodes = np.where(valid, _node(chosen), self.n)
            new = layer.links[nodes].reshape(len(keys), -1)
            sims = np.matmul(self.x[new], q[:, :, None])[:, :, 0]
            fresh = np.where(new == self.n, _LAST, _pack(sims, new, 0))
            worst = keys[:, -1:]
            fresh = np.where(fresh < worst, fresh, _LAST)
            fresh.sort(axis=1)
            both = np.concatenate([keys, fresh[:, : ef + step * 2]], axis=1)
            both.sort(axis=1)
            same = (both[:, 1:] | _OPEN) == (both[:, :-1] | _OPEN)
            same &= both[:, 1:] < _LAST
            if same.any():
                both[:, 1:][same] = _LAST
                both.sort(axis=1)
            keys = both[:, :ef]
        return out

    def _enter(self, q: np.ndarray, top: int, stop: int) -> np.ndarray:
        """Descends from the entry node through the layers above `stop`; gives beams of the nodes found."""
        sims = q @ self.x[0]
        keys = _pack(sims, np.zeros(len(q), np.int64), 0)[:, None]
        for lay in range(top, stop, -1):
            keys = self._beam(self.layers[lay], q, keys | _OPEN, 4)
        keys = keys[:, :4]
        return np.where(keys < _LAST, keys | _OPEN, keys)

    def search(self, q: np.ndarray, k: int, ef: int = EF_SEARCH) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of the k best found for each query; missing ones are -1."""
        nodes, sims = np.full((len(q), k), -1, np.int32), np.full((len(q), k), -2.0, np.float32)
        if not self.n:
            return nodes, sims
        for a in range(0, len(q), LANE):
            part = q[a : a + LANE].astype(np.float32)
            keys = _unique(self._beam(self.layers[0], part, self._enter(part, len(self.layers) - 1, 0), max(ef, k)))[:, :k]
            good = keys < _LAST
            nodes[a : a + len(part), : keys.shape[1]] = np.where(good, _node(keys), -1)
            sims[a : a + len(part), : keys.shape[1]] = np.where(good, _sim(keys), -2.0)
        return nodes, sims

    # -- construction --------------------------------------------------------------------------------------------

    def _select(self, centre: np.ndarray, keys: np.ndarray, want: int) -> np.ndarray:
        """Keeps of each row of sorted candidates those that are nearer to the centre than to any one kept before;
        rows that keep fewer are filled with the nearest of the rest."""
        nodes = np.where(keys < _LAST, _node(keys), self.n)
        v = self.x[nodes]
        gram = np.matmul(v, v.transpose(0, 2, 1))
        sims = np.where(keys < _LAST, _sim(keys), -2.0)
        kept = np.zeros(keys.shape, dtype=bool)
        kept[:, 0] = keys[:, 0] < _LAST
        closest = np.where(kept[:, :1], gram[:, 0, :], -2.0)  # similarity of each candidate to the nearest kept one
        number = kept[:, 0].astype(np.int32)
        for j in range(1, keys.shape[1]):
            take = (sims[:, j] > closest[:, j]) & (number < want) & (keys[:, j] < _LAST)
            kept[:, j] = take
            number += take
            closest = np.where(take[:, None], np.maximum(closest, gram[:, j, :]), closest)
        order = np.where(kept, keys, np.where(keys < _LAST, keys + (np.int64(1) << 61), _LAST))
        order = np.sort(order, axis=1)[:, :want]
        filled = (order >= (np.int64(1) << 60)) & (order < _LAST)
        order[filled] -= np.int64(1) << 61
        return order

    def _link(self, layer: Layer, new: np.ndarray, keys: np.ndarray) -> None:
        """Gives new nodes their links and enters the reverse ones; full lists are pruned to half."""
        width = keys.shape[1]
        good = keys < _LAST
        layer.links[new, :width] = np.where(good, _node(keys), self.n)
        layer.sims[new, :width] = np.where(good, _sim(keys), -2.0)
        layer.count[new] = good.sum(axis=1)
        src = np.repeat(new, width)[good.ravel()]
        dst, sim = _node(keys)[good], _sim(keys)[good]
        while len(src):
            order = np.lexsort((-sim, dst))
            src, dst, sim = src[order], dst[order], sim[order]
            first = np.concatenate(([True], dst[1:] != dst[:-1]))
            start = np.flatnonzero(first)
            rank = np.arange(len(dst)) - np.repeat(start, np.diff(np.concatenate((start, [len(dst)]))))
            slot = layer.count[dst] + rank
            fits = slot < ROOM
            layer.links[dst[fits], slot[fits]] = src[fits]
            layer.sims[dst[fits], slot[fits]] = sim[fits]
            touched = dst[first]
            layer.count += np.bincount(dst[fits], minlength=len(layer.count)).astype(np.int32)
            full = touched[layer.count[touched] >= ROOM]
            if len(full):
                held = np.where(layer.links[full] < self.n, _pack(layer.sims[full], layer.links[full], 0), _LAST)
                held.sort(axis=1)
                best = self._select(self.x[full], held, ROOM // 2)
                ok = best < _LAST
                layer.links[full], layer.sims[full] = self.n, -2.0
                layer.links[full, : ROOM // 2] = np.where(ok, _node(best), self.n)
                layer.sims[full, : ROOM // 2] = np.where(ok, _sim(best), -2.0)
                layer.count[full] = ok.sum(axis=1)
            src, dst, sim = src[~fits], dst[~fits], sim[~fits]

    def _remember(self, node: np.ndarray, keys: np.ndarray) -> None:
        """Enters candidates into the lists of the nearest seen, those of the nodes and of the candidates themselves."""
        width = self.near.shape[1]
        both = np.concatenate([self.near[node], keys[:, :width] | np.where(keys[:, :width] < _LAST, _OPEN, 0)], axis=1)
        both.sort(axis=1)
        self.near[node] = _unique(both)[:, :width]
        good = keys[:, :width] < _LAST
        other, sim = _node(keys[:, :width])[good], _sim(keys[:, :width])[good]
        own = np.repeat(node, good.sum(axis=1))
        worst = self.near[other, -1]
        entry = _pack(sim, own, 0)
        use = entry < worst
        other, entry = other[use], entry[use]
        order = np.lexsort((entry, other))
        other, entry = other[order], entry[order]
        first = np.concatenate(([True], other[1:] != other[:-1])) if len(other) else np.zeros(0, bool)
        start = np.flatnonzero(first)
        rank = np.arange(len(other)) - np.repeat(start, np.diff(np.concatenate((start, [len(other)]))))
        keep = rank < width
        rows = np.repeat(np.arange(len(start)), np.diff(np.concatenate((start, [len(other)]))))
        table = np.full((len(start), width), _LAST)
        table[rows[keep], rank[keep]] = entry[keep]
        merged = np.concatenate([self.near[other[start]], table], axis=1)
        merged.sort(axis=1)
        self.near[other[start]] = _unique(merged)[:, :width]

    def _build(self) -> None:
        done, top = 0, -1
        while done < self.n:
            size = min(self.n - done, BATCH, max(64, done // 2))
            self._insert(np.arange(done, done + size), top)
            top = max(top, int(self.level[done : done + size].max()))
            done += size

    def _insert(self, new: np.ndarray, top: int) -> None:
        q = self.x[new]
        inner = q @ q.T  # the batch among itself
        np.fill_diagonal(inner, -3.0)
        beams = None
        level = self.level[new]
        high = int(level.max())
        for lay in range(max(high, top), -1, -1):
            mine = np.flatnonzero(level >= lay)
            found = None
            if top >= lay:
                # beams come from above; nodes that are not of this layer only descend
                start = beams if beams is not None else _pack(q @ self.x[0], np.zeros(len(q), np.int64), 0)[:, None]
                start = np.where(start < _LAST, start | _OPEN, start)
                found = np.full((len(q), EF_BUILD), _LAST)
                descend = np.flatnonzero(level < lay)
                for rows, ef in ((mine, EF_BUILD), (descend, 4)):
                    for a in range(0, len(rows), LANE):
                        part = rows[a : a + LANE]
                        found[part, :ef] = self._beam(self.layers[lay], q[part], start[part, :4], ef)
                beams = found
            if len(mine):
                among = inner[np.ix_(mine, mine)]
                k = min(EF_BUILD // 2, len(mine))
                best = np.argpartition(-among, k - 1, axis=1)[:, :k] if k < len(mine) else np.tile(np.arange(len(mine)), (len(mine), 1))
                sims = np.take_along_axis(among, best, axis=1)
                own = np.where(sims > -3.0, _pack(sims, new[mine][best], 0), _LAST)
                keys = own if found is None else np.concatenate([found[mine] | np.where(found[mine] < _LAST, _OPEN, 0), own], axis=1)
                keys.sort(axis=1)
                keys = _unique(keys)[:, :EF_BUILD]
                if lay == 0:
                    self._remember(new, keys)
                for a in range(0, len(mine), LANE):
                    self._link(self.layers[lay], new[mine[a : a + LANE]], self._select(q[mine[a : a + LANE]], keys[a : a + LANE], LINKS))

    def refine(self, k: int, ef: int = 16, start: int = 6) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of the k nearest of every node but itself: a search of the finished graph that starts
        from the nearest seen during construction."""
        nodes, sims = np.full((self.n, k), -1, np.int32), np.full((self.n, k), -2.0, np.float32)
        for a in range(0, self.n, LANE):
            own = np.arange(a, min(a + LANE, self.n))
            keys = self.near[own, : max(start, ef)]
            keys = np.concatenate([np.where(keys[:, :start] < _LAST, keys[:, :start] | _OPEN, _LAST), np.where(keys[:, start:] < _LAST, keys[:, start:] & ~_OPEN, _LAST)], axis=1)
            keys.sort(axis=1)
            found = self._beam(self.layers[0], self.x[own], keys, max(ef, k + 1))
            found = np.where(_node(found) == own[:, None], _LAST, found)
            found.sort(axis=1)
            found = _unique(found)[:, :k]
            good = found < _LAST
            nodes[own, : found.shape[1]] = np.where(good, _node(found), -1)
            sims[own, : found.shape[1]] = np.where(good, _sim(found), -2.0)
        return nodes, sims

    def nearest(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of the k nearest seen of every node, gathered while it and later nodes were inserted."""
        keys = self.near[:, :k]
        good = keys < _LAST
        return np.where(good, _node(keys), -1), np.where(good, _sim(keys), -2.0)
