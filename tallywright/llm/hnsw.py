"""A navigable small-world graph with layers, built and searched many vectors at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LINKS, BATCH, BUILD_BEAM, AT_ONCE, EXPANDED = 24, 256, 32, 256, 3
#: Vectors that some queries are compared with at once.
COMPARED = 8_192
#: Arcs a node may get on top of its links for each reason to lead to nodes nothing leads to.
EXTRA = 8


class Graph:
    """Unit vectors in the order of their highest layer, so that each layer is a prefix.

    Layers are built from the top. Vectors enter a layer in batches: a beam search from
    what the layer above found gives candidates, batch members are candidates as well, and
    of these each vector keeps near ones that are nearer to it than to one another. Arcs
    are added at the end to every vector that cannot be reached from the first.
    """

    def __init__(self, vectors: np.ndarray, seed: int = 3):
        rng = np.random.RandomState(seed)
        level = np.floor(-np.log(1 - rng.rand(len(vectors))) / np.log(LINKS)).astype(int)
        self.order = np.argsort(-level, kind="stable")
        self.vectors = vectors[self.order]
        self.near = self.vectors.astype(np.float32)
        top = int(level.max(initial=0))
        self.sizes = [int((level >= i).sum()) for i in range(top, -1, -1)]
        self.layers: list[np.ndarray] = []
        for size in self.sizes:
            self._build(size)

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "near"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.near = self.vectors.astype(np.float32)

    def _build(self, size: int) -> None:
        links = np.full((size, LINKS), -1, dtype=np.int32)
        scores = np.full((size, LINKS), -2, dtype=np.float32)
        done = 0
        while done < size:
            end = min(size, done + (BATCH if done >= BATCH else max(1, done)))
            fresh = np.arange(done, end)
            within = self.near[fresh] @ self.near[fresh].T
            within[np.triu_indices(len(fresh))] = -2
            found, sims = fresh[None, :].repeat(len(fresh), 0), within
            if done:
                if done <= BATCH:
                    old, near = np.arange(done)[None, :].repeat(len(fresh), 0), self.near[fresh] @ self.near[:done].T
                else:
                    old, near = self._walk(self.near[fresh], self._entries(fresh, done), links[:done], BUILD_BEAM)
                found, sims = np.concatenate([old, found], axis=1), np.concatenate([near, sims], axis=1)
            width = min(BUILD_BEAM, found.shape[1])
            by = np.argsort(-sims, axis=1, kind="stable")[:, :width]
            found, sims = np.take_along_axis(found, by, 1), np.take_along_axis(sims, by, 1)
            self._link(links, scores, fresh, np.where(sims > -2, found, -1), sims)
            done = end
        self.layers.append(self._attach(links))

    def _attach(self, links: np.ndarray) -> np.ndarray:
        """``links`` with arcs in further columns, so that every vector is reached from the first.

        A lost vector is led to from the nearest reached one it links to itself, or, where it
        links to none, from the nearest of all. Those that share one hang below it as a tree.
        """
        reached = np.zeros(len(links), dtype=bool)
        fresh, arcs = np.zeros(1, np.int64), [np.zeros((0, 2), np.int64)]
        while True:
            while len(fresh):
                reached[fresh] = True
                fresh = np.unique(links[fresh])
                fresh = fresh[fresh >= 0]
                fresh = fresh[~reached[fresh]]
            lost = np.flatnonzero(~reached)
            if not len(lost):
                break
            out = links[lost]
            usable = (out >= 0) & reached[out]
            fresh = lost[usable.any(axis=1)]
            if len(fresh):
                out, usable = out[usable.any(axis=1)], usable[usable.any(axis=1)]
                sims = np.stack([np.einsum("kd,kd->k", self.near[fresh], self.near[column]) for column in out.T], axis=1)
                host = np.take_along_axis(out, np.where(usable, sims, -2).argmax(axis=1)[:, None], 1)[:, 0]
            else:
                fresh, known = lost[:1], np.flatnonzero(reached)
                host = known[(self.near[known] @ self.near[fresh[0]]).argmax()][None]
            by = np.argsort(host, kind="stable")
            fresh, host = fresh[by], host[by].astype(np.int64)
            first = np.searchsorted(host, host, side="left")
            turn = np.arange(len(host)) - first
            below = turn >= EXTRA
            host[below] = fresh[(first + turn // EXTRA - 1)[below]]
            arcs.append(np.stack([host, fresh], axis=1))
        arcs = np.concatenate(arcs)
        if not len(arcs):
            return links
        host, node = arcs[np.argsort(arcs[:, 0], kind="stable")].T
        turn = np.arange(len(host)) - np.searchsorted(host, host, side="left")
        more = np.full((len(links), int(turn.max()) + 1), -1, dtype=np.int32)
        more[host, turn] = node
        return np.concatenate([links, more], axis=1)

    def _entries(self, fresh: np.ndarray, done: int) -> np.ndarray:
        """Where a search starts among the first ``done`` of a layer that is being built."""
        if self.layers and len(self.layers[-1]) <= done:
            return self._descend(self.near[fresh], len(self.layers))
        # The layer above has vectors that have not entered this one yet.
        return np.argsort(-(self.near[fresh] @ self.near[:BATCH].T), axis=1)[:, :4]

    def _descend(self, queries: np.ndarray, layers: int) -> np.ndarray:
        """Where to start below the first ``layers``: the best found there, else the first vector."""
        start = np.zeros((len(queries), 1), np.int64)
        for links in self.layers[:layers]:
            if len(links) <= BATCH:
                sims = queries @ self.near[: len(links)].T
                start = np.argsort(-sims, axis=1)[:, :4]
            else:
                start = self._walk(queries, start, links, 8)[0][:, :4]
                start = np.where(start < 0, start[:, :1], start)
        return start

    def _link(self, links, scores, fresh, found, sims) -> None:
        chosen = np.full((len(fresh), LINKS), -1, dtype=np.int32)
        held = np.zeros(len(fresh), dtype=int)
        half = LINKS // 2
        best = np.full(found.shape, -2, dtype=np.float32)
        taken = np.zeros(found.shape, dtype=bool)
        for filling in (False, True):  # the slots that are left go to the nearest
            for at in range(found.shape[1]):
                fits = (found[:, at] >= 0) & (held < half) & ~taken[:, at]
                take = np.flatnonzero(fits if filling else fits & (sims[:, at] >= best[:, at]))
                if not len(take):
                    continue
                one = found[take, at]
                taken[take, at] = True
                chosen[take, held[take]] = one
                links[fresh[take], held[take]] = one
                scores[fresh[take], held[take]] = sims[take, at]
                held[take] += 1
                if not filling:
                    nearness = np.einsum("ikd,id->ik", self.near[np.maximum(found[take], 0)], self.near[one])
                    best[take] = np.maximum(best[take], nearness)
        # The other direction, one new neighbour for each vector at a time.
        source, slot = np.nonzero(chosen >= 0)
        target, origin = chosen[source, slot], fresh[source]
        score = scores[origin, slot]
        by = np.lexsort((-score, target))
        target, origin, score = target[by], origin[by], score[by]
        turn = np.arange(len(target)) - np.searchsorted(target, target, side="left")
        for round_ in range(int(turn.max(initial=-1)) + 1):
            now = turn == round_
            t, o, s = target[now], origin[now], score[now]
            worst = scores[t].argmin(axis=1)
            better = s > scores[t, worst]
            links[t[better], worst[better]] = o[better]
            scores[t[better], worst[better]] = s[better]

    def _walk(self, queries: np.ndarray, start: np.ndarray, links: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest found from ``start`` for each query, best first; -1 where fewer."""
        count, rows = len(queries), np.arange(len(queries))[:, None]
        seen = np.zeros((count, len(links) + 1), dtype=bool)
        seen[:, -1] = True
        start = np.sort(start, axis=1)
        start[:, 1:][start[:, 1:] == start[:, :-1]] = -1
        seen[rows, start] = True
        sims = np.einsum("ikd,id->ik", self.near[start], queries)
        sims[start < 0] = -2
        pad = max(0, beam - start.shape[1])
        ids = np.pad(start, ((0, 0), (0, pad)), constant_values=-1)
        sims = np.pad(sims, ((0, 0), (0, pad)), constant_values=-2)
        opened = ids < 0
        by = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        ids, sims, opened = (np.take_along_axis(x, by, 1) for x in (ids, sims, opened))
        live = np.arange(count)
        while len(live):
            r = np.arange(len(live))[:, None]
            pick = np.argsort(opened[live], axis=1, kind="stable")[:, :EXPANDED]
            closed = np.take_along_axis(opened[live], pick, 1)
            some = ~closed.all(axis=1)
            live, pick, closed = live[some], pick[some], closed[some]
            if not len(live):
                break
            r = np.arange(len(live))[:, None]
            opened[live[:, None], pick] = True
            node = np.where(closed, -1, ids[live[:, None], pick])
            fresh = np.where(node[:, :, None] >= 0, links[node], -1).reshape(len(live), -1)
            fresh = np.sort(fresh, axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            fresh[seen[live[:, None], fresh]] = -1
            wide = int((fresh >= 0).sum(axis=1).max())
            fresh = -np.sort(-fresh, axis=1)[:, :wide]
            seen[live[:, None], fresh] = True
            new = np.einsum("ikd,id->ik", self.near[fresh], queries[live])
            new[fresh < 0] = -2
            all_ids = np.concatenate([ids[live], fresh], axis=1)
            all_sims = np.concatenate([sims[live], new], axis=1)
            all_open = np.concatenate([opened[live], fresh < 0], axis=1)
            by = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[live], sims[live], opened[live] = all_ids[r, by], all_sims[r, by], all_open[r, by]
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """``(query, place)`` pairs in the graph's order, ``beam`` for each query."""
        narrow = queries.astype(np.float32)
        out = []
        for at in range(0, len(narrow), AT_ONCE):
            some = narrow[at : at + AT_ONCE]
            start = self._descend(some, len(self.layers) - 1)
            ids, _ = self._walk(some, start, self.layers[-1], beam)
            q, slot = np.nonzero(ids >= 0)
            out.append((q + at, ids[q, slot]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([q for q, _ in out]), np.concatenate([i for _, i in out])

    def compared(self, queries: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All ``(query, place)`` pairs whose cosine is at least ``least``, in parts."""
        for at in range(0, len(self.vectors), COMPARED):
            q, i = np.nonzero(queries @ self.vectors[at : at + COMPARED].T >= least)
            yield q, i + at

    def pairs(self, queries: np.ndarray, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(query, place)`` pairs found whose cosine in double precision is at least ``least``, in parts.

        The beam is doubled for queries that fill it with pairs; one that would look at as
        many vectors as there are is a comparison with everything.
        """
        for at in range(0, len(queries), AT_ONCE):
            left, width = np.arange(at, min(at + AT_ONCE, len(queries))), beam
            while len(left):
                if width * LINKS >= len(self.vectors):
                    for q, i in self.compared(queries[left], least):
                        yield left[q], i
                    break
                q, i = self.search(queries[left], width)
                good = np.einsum("kd,kd->k", queries[left[q]], self.vectors[i]) >= least
                q, i = q[good], i[good]
                full = np.bincount(q, minlength=len(left)) >= width
                yield left[q[~full[q]]], i[~full[q]]
                left = left[full]
                width *= 2

    def links(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """All :meth:`pairs`."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64)), *self.pairs(queries, least, beam)]
        return np.concatenate([q for q, _ in out]), np.concatenate([i for _, i in out])

    def audit(self, queries: np.ndarray, names: np.ndarray, nodes: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each query's pairs, counted against every vector, and how many of them a search misses.

        The misses are listed for ``beam``, twice ``beam`` and so on until there are none.
        Queries do not pair with the vector of their own name; ``nodes`` has those of the graph.
        """
        truth, steps = np.zeros(len(queries), np.int64), []
        for at in range(0, len(queries), AT_ONCE):
            for q, i in self.compared(queries[at : at + AT_ONCE], least):
                truth += np.bincount(q[names[at + q] != nodes[i]] + at, minlength=len(queries))
        short = np.flatnonzero(truth)
        while len(short) and beam * LINKS < len(self.vectors):
            missed = np.zeros(len(queries), np.int64)
            for at in range(0, len(short), AT_ONCE):
                some = short[at : at + AT_ONCE]
                found = np.zeros(len(some), np.int64)
                for q, i in self.pairs(queries[some], least, beam):
                    found += np.bincount(q[names[some[q]] != nodes[i]], minlength=len(some))
                missed[some] = np.maximum(0, truth[some] - found)
            steps.append(missed)
            short = np.flatnonzero(missed)
            beam *= 2
        return truth, steps

    def probed(self, least: float, beam: int, probes: int, recall: float, seed: int = 5) -> int:
        """The first of ``beam`` and its doubles that finds ``recall`` of planted links.

        Each of ``probes`` vectors, evenly chosen, is sought from a point whose cosine with it
        is just ``least``, in a random direction: links as weak as any, with no other to help,
        which are there whatever the data hold.
        """
        size, dims = self.vectors.shape
        if not size:
            return beam
        place = np.arange(0, size, max(1, size // max(1, probes)))[:probes]
        aside = np.random.RandomState(seed).randn(len(place), dims)
        own = self.vectors[place]
        aside -= np.einsum("kd,kd->k", aside, own)[:, None] * own
        norm = np.linalg.norm(aside, axis=1, keepdims=True)
        near = min(1.0, least + 1e-9)
        away = np.where(norm > 1e-6, aside / np.maximum(norm, 1e-6), 0)
        queries = near * own + np.sqrt(1 - near * near) * away
        queries /= np.linalg.norm(queries, axis=1, keepdims=True)
        left = np.arange(len(place))
        while beam * LINKS < size:
            q, i = self.search(queries[left], beam)
            left = np.delete(left, np.unique(q[i == place[left[q]]]))
            if len(left) <= (1 - recall) * len(place):
                break
            beam *= 2
        return beam

    def within(self, queries: np.ndarray, least: float, beam: int, audit: int, recall: float) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`links` of one graph by itself, with a beam that passes its own audit.

        ``audit`` queries are compared with every vector and as many planted links are
        sought. The beam is doubled until on average ``recall`` of a query's pairs are found.
        """
        beam = self.probed(least, beam, audit, recall)
        some = queries[:: max(1, len(queries) // audit)][:audit]
        truth, steps = self.audit(some, np.full(len(some), -1), np.zeros(len(self.vectors)), least, beam)
        for missed in steps:
            if (missed / np.maximum(1, truth)).sum() <= (1 - recall) * (truth > 0).sum():
                break
            beam *= 2
        return self.links(queries, least, beam)
