"""Byte-pair merging of many short words at once, in numpy, and a memory of their ids.

Every word of a group has the same number of symbols. In each round every word merges its best
adjacent pair, the leftmost of equals, which is the order of the usual priority queue.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

NONE = np.int64(1) << 40


class Merges:
    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        """pairs: (left id, right id) -> (rank, merged id); lower ranks merge first."""
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        ranks, merged = np.array(list(pairs.values()), np.int64).T
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(ranks[order], NONE)
        self.merged = np.append(merged[order], 0)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and place of each pair as one number, so that the least is the best pair."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at] << 20 | at, NONE)

    def __call__(self, symbols: np.ndarray) -> list[np.ndarray]:
        """Final ids of each row of a matrix of initial ids."""
        out: list[np.ndarray] = [None] * len(symbols)
        rows, ids = np.arange(len(symbols)), symbols.astype(np.int64)
        best = self._look_up(ids[:, :-1], ids[:, 1:])
        while len(rows) and ids.shape[1] > 1:
            at = best.argmin(axis=1)
            each = np.arange(len(rows))
            least = best[each, at]
            done = least >= NONE
            if done.any():
                for row, final in zip(rows[done].tolist(), ids[done]):
                    out[row] = final
                rows, ids, best, at, least = rows[~done], ids[~done], best[~done], at[~done], least[~done]
                each = np.arange(len(rows))
                if not len(rows):
                    break
            width = ids.shape[1] - 1
            keep = np.arange(width) + (np.arange(width) > at[:, None])
            ids = np.take_along_axis(ids, keep, 1)
            ids[each, at] = self.merged[least & ((1 << 20) - 1)]
            if width > 1:
                best = np.take_along_axis(best, keep[:, : width - 1], 1)
                left = np.flatnonzero(at > 0)
                best[left, at[left] - 1] = self._look_up(ids[left, at[left] - 1], ids[left, at[left]])
                right = np.flatnonzero(at < width - 1)
                best[right, at[right]] = self._look_up(ids[right, at[right]], ids[right, at[right] + 1])
        for row, final in zip(rows.tolist(), ids):
            out[row] = final
        return out


class Memory:
    """Ids of words met before, by a 64-bit hash of their bytes; `learn` encodes the new ones.

    Holds at most `limit` words and starts anew when it is full, so a worker's memory is bounded.
    Texts become ids by gathering: Python sees a slice's distinct words only.
    """

    def __init__(self, learn: Callable[[list[bytes]], list[np.ndarray]], limit: int):
        self.learn, self.limit = learn, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int32)
        self.flat = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _add(self, keys: np.ndarray, words: list[bytes]) -> None:
        learnt = self.learn(words)
        used, first = int(self.starts[-1]), len(self.keys)
        sizes = np.array([len(x) for x in learnt], np.int64)
        need = used + int(sizes.sum())
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.zeros(need + need // 2 - used, np.int32)])
        self.flat[used:need] = np.concatenate(learnt)
        self.starts = np.concatenate([self.starts, used + np.cumsum(sizes)])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.places = np.insert(self.places, at, first + np.arange(len(keys), dtype=np.int32))

    def _known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return at, (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in order, and the number of ids of each word."""
        if not len(hashes):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        keys, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self.clear()
        at, known = self._known(keys)
        if not known.all():
            new = where[~known]
            raw = data.tobytes()
            self._add(keys[~known], [raw[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())])
            at, _ = self._known(keys)
        place = self.places[at][inverse]
        first = self.starts[place]
        sizes = self.starts[place + 1] - first
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(first - before, sizes) + np.arange(sizes.sum())], sizes
