"""Hierarchical navigable small-world graphs over unit vectors, searched for many queries at once.

A plain numpy helper for one shard of vectors; the Spark side is in ``vector_dedup``.
"""

from __future__ import annotations

import numpy as np

LINKS = 12
BUILD_BEAM = 48
# Beam entries whose neighbours are looked at in one step.
_EXPAND = 4
_BATCH = 1024


class SmallWorld:
    """Levels of neighbour lists; -1 fills unused places.  Level 0 holds every vector."""

    def __init__(self, vectors: np.ndarray, seed: int = 7, links: int = LINKS, beam: int = BUILD_BEAM):
        self.x = vectors.astype(np.float32)
        n = len(vectors)
        draws = np.random.default_rng(seed).random(n)
        top = np.minimum(np.floor(-np.log(np.maximum(draws, 1e-12)) / np.log(links)), 6).astype(int)
        self.entry = int(np.argmax(top)) if n else 0
        self.levels = [np.full((n, 2 * links if level == 0 else links), -1, np.int32) for level in range(top.max(initial=0) + 1)]
        order = np.concatenate([[self.entry], np.delete(np.arange(n), self.entry)]) if n else np.zeros(0, int)
        done = 1
        while done < n:
            batch = order[done : done + min(max(done, 32), _BATCH)]
            self._insert(batch, order[:done], top, beam)
            done += len(batch)

    def _insert(self, batch: np.ndarray, placed: np.ndarray, top: np.ndarray, beam: int) -> None:
        at = np.full((len(batch), 1), self.entry)
        for level in range(len(self.levels) - 1, -1, -1):
            rows = np.flatnonzero(top[batch] >= level)
            found, _ = self._walk(self.x[batch], at, level, 1)
            if len(rows):
                near, sims = self._walk(self.x[batch[rows]], at[rows], level, beam)
                # Members of one batch see each other too.
                own = self.x[batch[rows]] @ self.x[batch[rows]].T
                np.fill_diagonal(own, -np.inf)
                k = min(beam, len(rows))
                peers = np.argpartition(-own, k - 1, axis=1)[:, :k]
                ids = np.concatenate([near, batch[rows][peers]], axis=1)
                sims = np.concatenate([sims, np.take_along_axis(own, peers, 1)], axis=1)
                ids = np.where(np.isfinite(sims), ids, -1)
                width = self.levels[level].shape[1]
                chosen = self._diverse(ids, sims, width // 2 if level == 0 else width)
                self.levels[level][batch[rows], : chosen.shape[1]] = chosen
                self._link_back(batch[rows], chosen, level)
            at = found

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, width: int, pool: int = 64) -> np.ndarray:
        """Up to ``width`` candidates per row, nearest first, skipping those nearer to a chosen one."""
        order = np.argsort(-np.where(ids >= 0, sims, -np.inf), axis=1, kind="stable")[:, :pool]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        out = np.full((len(ids), width), -1, np.int32)
        for first in range(0, len(ids), 256):
            part, sim = ids[first : first + 256], sims[first : first + 256]
            v = self.x[part]
            mutual = np.matmul(v, v.transpose(0, 2, 1))
            open_ = part >= 0
            count = np.zeros(len(part), int)
            rows = np.arange(len(part))
            skipped = np.zeros_like(open_)
            for column in range(part.shape[1]):
                take = open_[:, column] & (count < width)
                r = rows[take]
                out[first + r, count[r]] = part[r, column]
                count[r] += 1
                hidden = mutual[:, column, :] > sim
                open_ &= ~(hidden & take[:, None])
                skipped |= hidden & take[:, None]
            # Free places go to the nearest skipped ones.
            for column in range(part.shape[1]):
                new = skipped[:, column] & (count < width) & (part[:, column] >= 0)
                new &= ~(out[first : first + len(part)] == part[:, column, None]).any(axis=1)
                r = rows[new]
                out[first + r, count[r]] = part[r, column]
                count[r] += 1
        return out

    def _link_back(self, batch: np.ndarray, chosen: np.ndarray, level: int) -> None:
        lists = self.levels[level]
        target, source = chosen.ravel(), np.repeat(batch, chosen.shape[1])
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(nodes), 512):
            some, start, size = nodes[a : a + 512], first[a : a + 512], count[a : a + 512]
            new = np.full((len(some), size.max()), -1, np.int64)
            place = np.arange(size.max())[None, :] < size[:, None]
            new[place] = source[(start[:, None] + np.arange(size.max())[None, :])[place]]
            new[(new[:, :, None] == lists[some][:, None, :]).any(axis=2)] = -1
            ids = np.concatenate([lists[some], new], axis=1)
            sims = np.einsum("rcd,rd->rc", self.x[ids], self.x[some])
            lists[some] = self._diverse(ids, np.where(ids >= 0, sims, -np.inf), lists.shape[1])

    def _walk(self, queries: np.ndarray, at: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search on one level: ids and similarities, best ``beam`` per query in any order."""
        lists, n = self.levels[level], len(self.x)
        b = len(queries)
        seen = np.zeros((b, n + 1), bool)
        ids = np.full((b, beam), -1, np.int64)
        sims = np.full((b, beam), -np.inf, np.float32)
        fresh = np.zeros((b, beam), bool)
        k = min(beam, at.shape[1])
        ids[:, :k], fresh[:, :k] = at[:, :k], True
        sims[:, :k] = np.einsum("bkd,bd->bk", self.x[at[:, :k]], queries)
        np.put_along_axis(seen, at[:, :k], True, 1)
        expand = min(_EXPAND, beam)
        active = np.arange(b)
        while len(active):
            score = np.where(fresh[active], sims[active], -np.inf)
            pick = np.argpartition(-score, expand - 1, axis=1)[:, :expand]
            live = np.isfinite(np.take_along_axis(score, pick, 1))
            some = live.any(axis=1)
            active, pick, live = active[some], pick[some], live[some]
            if not len(active):
                break
            fresh[active[:, None], pick] = False
            near = lists[ids[active[:, None], pick]]
            near[~live] = -1
            near = np.sort(near.reshape(len(active), -1), axis=1).astype(np.int64)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[near < 0] = n
            near[seen[active[:, None], near]] = n
            seen[active[:, None], near] = True
            seen[:, n] = False
            valid = near < n
            new = np.einsum("bkd,bd->bk", self.x[np.where(valid, near, 0)], queries[active])
            new[~valid] = -np.inf
            all_ids = np.concatenate([ids[active], np.where(valid, near, -1)], axis=1)
            all_sims = np.concatenate([sims[active], new], axis=1)
            all_fresh = np.concatenate([fresh[active], valid], axis=1)
            best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[active] = np.take_along_axis(all_ids, best, 1)
            sims[active] = np.take_along_axis(all_sims, best, 1)
            fresh[active] = np.take_along_axis(all_fresh, best, 1) & np.isfinite(sims[active])
        if beam == 1:
            return np.where(ids >= 0, ids, self.entry), sims
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the best ``beam`` vectors found per query; -1 and -inf fill up."""
        q = queries.astype(np.float32)
        out_ids, out_sims = [], []
        for a in range(0, len(q), _BATCH):
            part = q[a : a + _BATCH]
            at = np.full((len(part), 1), self.entry)
            for level in range(len(self.levels) - 1, 0, -1):
                at, _ = self._walk(part, at, level, 1)
            ids, sims = self._walk(part, at, 0, beam)
            out_ids.append(ids)
            out_sims.append(sims)
        return np.concatenate(out_ids), np.concatenate(out_sims)
