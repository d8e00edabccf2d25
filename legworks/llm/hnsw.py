"""A navigable small-world graph over unit vectors, built and searched many queries at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

DEGREE = 12                    # links that a new node takes in a layer
WIDTH = 24                     # links that a node holds
BEAM_BUILD = 48                # beam while building
BATCH = 512                    # nodes that are inserted together
EXPANDED = 4                   # nodes of a beam whose links are followed at a time
MATES = 16                     # candidates of a node among those inserted with it
BEAM_CELLS = 1 << 20           # places of the beams, and pairs compared, at a time
PAIR_CELLS = 1 << 22


def beam(x: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray,
         width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best nodes that each query reaches from its start, as ids (-1: none) and
    similarities.  All queries take their steps together; one is done when its whole beam has
    been followed."""
    n, m = len(queries), len(links)
    ids = np.full((n, width), -1, np.int32)
    sims = np.full((n, width), -np.inf, np.float32)
    done = np.ones((n, width), bool)
    # a query and a node as one number
    bits = (m - 1).bit_length()
    seen = np.zeros(n << bits, bool)
    ids[:, 0], done[:, 0] = start, False
    sims[:, 0] = np.einsum("ij,ij->i", x[start], queries)
    seen[(np.arange(n) << bits) + start] = True
    active, ways = np.arange(n), min(EXPANDED, width)
    while len(active):
        open_sims = np.where(done[active], -np.inf, sims[active])
        pick = np.argpartition(-open_sims, ways - 1, axis=1)[:, :ways]
        live = np.take_along_axis(open_sims, pick, axis=1) > -np.inf
        some = live.any(axis=1)
        active, pick, live = active[some], pick[some], live[some]
        if not len(active):
            break
        row, col = np.nonzero(live)
        at = pick[row, col]
        done[active[row], at] = True
        own = active[row]
        near = links.take(ids[own, at], axis=0)
        key = ((own << bits)[:, None] + near)[near >= 0]
        key = np.sort(key[~seen.take(key)])
        key = key[np.diff(key, prepend=-1) > 0]
        seen[key] = True
        who, what = key >> bits, key & ((1 << bits) - 1)
        s = np.einsum("ij,ij->i", x.take(what, axis=0), queries.take(who, axis=0))
        worst = np.zeros(n, np.float32)
        worst[active] = sims.take(active, axis=0).min(axis=1)
        better = s > worst.take(who)
        who, what, s = who[better], what[better], s[better]
        if not len(who):
            continue
        rows, first, count = np.unique(who, return_index=True, return_counts=True)
        place = np.arange(len(who)) - np.repeat(first, count)
        line = np.repeat(np.arange(len(rows)), count)
        most = int(count.max())
        new_s = np.full((len(rows), most), -np.inf, np.float32)
        new_i = np.full((len(rows), most), -1, np.int32)
        new_s[line, place], new_i[line, place] = s, what
        all_s = np.concatenate([sims[rows], new_s], axis=1)
        top = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
        sims[rows] = np.take_along_axis(all_s, top, axis=1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], new_i], axis=1), top, axis=1)
        done[rows] = np.take_along_axis(
            np.concatenate([done[rows], new_i < 0], axis=1), top, axis=1)
    return ids, sims


def chosen(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` candidates of each row to link to (-1: none): from the nearest on, those that are
    nearer to the row's node than to a candidate taken before; then the nearest of the rest.

    So a node keeps ways out of a dense group of near copies.
    """
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = (np.take_along_axis(a, order, axis=1) for a in (ids, sims))
    points = x[np.maximum(ids, 0)]
    between = points @ points.transpose(0, 2, 1)
    taken = np.zeros(ids.shape, bool)
    valid = ids >= 0
    for c in range(ids.shape[1]):
        hidden = (taken & (between[:, c] >= sims[:, c, None])).any(axis=1)
        taken[:, c] = valid[:, c] & ~hidden & (taken.sum(axis=1) < most)
    rank = np.where(taken, 0, np.where(valid, 1, 2))
    first = np.argsort(rank, axis=1, kind="stable")[:, :most]
    return np.where(np.take_along_axis(valid, first, axis=1),
                    np.take_along_axis(ids, first, axis=1), -1)


def _link_back(x: np.ndarray, links: np.ndarray, new: np.ndarray, near: np.ndarray) -> None:
    """Give the nodes that ``new`` links to a link back; a full node keeps the better choice."""
    at, col = np.nonzero(near >= 0)
    pair = np.unique(near[at, col].astype(np.int64) * len(links) + new[at])
    target, source = pair // len(links), pair % len(links)
    known = (links[target] == source[:, None]).any(axis=1)
    target, source = target[~known], source[~known]
    sim = np.einsum("ij,ij->i", x[target], x[source])
    order = np.lexsort((-sim, target))
    target, source = target[order], source[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, count)
    keep = place < WIDTH
    extra = np.full((len(nodes), WIDTH), -1, np.int32)
    extra[np.repeat(np.arange(len(nodes)), count)[keep], place[keep]] = source[keep]
    for lo in range(0, len(nodes), 1000):
        own = nodes[lo:lo + 1000]
        ids = np.concatenate([links[own], extra[lo:lo + 1000]], axis=1)
        free = np.argsort(ids < 0, axis=1, kind="stable")
        ids = np.take_along_axis(ids, free, axis=1)
        full = ids[:, WIDTH] >= 0
        links[own[~full]] = ids[~full, :WIDTH]
        if full.any():
            ids = ids[full]
            sims = np.einsum("ijk,ik->ij", x[np.maximum(ids, 0)], x[own[full]])
            links[own[full]] = chosen(x, ids, np.where(ids >= 0, sims, -np.inf), WIDTH)


class Graph:
    """Layers of links over the rows of ``x``; layer k holds the first ``len(layers[k])`` rows.

    The top layer is small; a search walks down to a start in the bottom one, which holds all rows.
    Rows are expected in an order that has nothing to do with their places (by hash).
    """

    def __init__(self, x: np.ndarray, layers: list[np.ndarray] | None = None):
        self.x = np.ascontiguousarray(x, np.float32)
        self.layers: list[np.ndarray] = layers or []
        if layers is None:
            sizes = [len(x)]
            while sizes[-1] > 4 * DEGREE:
                sizes.append(sizes[-1] // DEGREE)
            for size in reversed(sizes):
                self._grow(size)

    def _grow(self, size: int) -> None:
        """A further layer below the others, over the first ``size`` rows."""
        links = np.full((size, WIDTH), -1, np.int32)
        above = len(self.layers[0]) if self.layers else 0
        n = 0
        while n < size:
            new = np.arange(n, min(size, n + min(BATCH, max(2 * DEGREE, n // 2))))
            q = self.x[new]
            mates = (q @ q.T)
            np.fill_diagonal(mates, -np.inf)
            few = min(MATES, len(new))
            near = np.argpartition(-mates, few - 1, axis=1)[:, :few]
            sims = np.take_along_axis(mates, near, axis=1)
            ids = np.where(sims > -np.inf, new[near], -1).astype(np.int32)
            if n:
                # rows of the layer above are inserted first, from the first row
                start = self.start(q) if n >= above > 0 else np.zeros(len(q), np.int64)
                found, s = beam(self.x, links[:n], q, start, min(BEAM_BUILD, n))
                ids = np.concatenate([found, ids], axis=1)
                sims = np.concatenate([s, sims], axis=1)
            near = chosen(self.x, ids, sims, DEGREE)
            links[new, :near.shape[1]] = near
            _link_back(self.x, links, new, near)
            n += len(new)
        self.layers.insert(0, links)

    def start(self, queries: np.ndarray) -> np.ndarray:
        """A row of the lowest layer but one for each query: greedy steps down the layers."""
        at = np.zeros(len(queries), np.int64)
        for links in reversed(self.layers):
            at = beam(self.x, links, queries, at, 1)[0][:, 0].astype(np.int64)
        return at

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` rows found for each query, as ids (-1: none) and similarities."""
        queries = np.ascontiguousarray(queries, np.float32)
        upper = Graph(self.x, self.layers[1:]) if len(self.layers) > 1 else None
        start = upper.start(queries) if upper else np.zeros(len(queries), np.int64)
        return beam(self.x, self.layers[0], queries, start, width)

    def compared(self, queries: np.ndarray, least: float
                 ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) pairs of a similarity of ``least`` or more among all, some queries at a time."""
        step = max(1, PAIR_CELLS // max(1, len(self.x)))
        for lo in range(0, len(queries), step):
            who, row = np.nonzero(queries[lo:lo + step] @ self.x.T >= least)
            yield who + lo, row

    def pairs(self, queries: np.ndarray, least: float, width: int
              ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) pairs of a similarity of ``least`` or more, all of a query at a time.

        Queries whose beam ends full of such rows are in a dense group: they are compared with every
        row, as are all if the beam would hold a good part of the rows.  What is held at a time is
        bounded, however many pairs there are.
        """
        queries = np.ascontiguousarray(queries, np.float32)
        dense = np.arange(len(queries))
        if 4 * width < len(self.x):
            full = np.zeros(len(queries), bool)
            step = max(1, BEAM_CELLS // width)
            for lo in range(0, len(queries), step):
                ids, sims = self.search(queries[lo:lo + step], width)
                full[lo:lo + step] = sims.min(axis=1) >= least
                q, c = np.nonzero((sims >= least) & ~full[lo:lo + step, None])
                yield q + lo, ids[q, c]
            dense = np.flatnonzero(full)
        for q, r in self.compared(queries[dense], least):
            yield dense[q], r

    def within(self, queries: np.ndarray, least: float, width: int
               ) -> tuple[np.ndarray, np.ndarray]:
        """The ``pairs`` at once."""
        found = list(self.pairs(queries, least, width))
        return (np.concatenate([p[0] for p in found] or [np.zeros(0, np.int64)]),
                np.concatenate([p[1] for p in found] or [np.zeros(0, np.int64)]))

    def dumps(self) -> list[bytes]:
        """Each row's links, layer after layer from the lowest on."""
        return [b"".join(a[i].tobytes() for a in self.layers if i < len(a))
                for i in range(len(self.x))]

    @classmethod
    def loads(cls, x: np.ndarray, rows: list[bytes]) -> Graph:
        held = np.array([len(r) for r in rows], np.int64) // (4 * WIDTH)
        links = np.frombuffer(b"".join(rows), np.int32).reshape(-1, WIDTH)
        first = np.cumsum(held) - held
        return cls(x, [links[first[held > k] + k] for k in range(held.max(initial=0))])
