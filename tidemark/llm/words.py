"""Ids of words remembered in arrays, and taken for all places of a batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def taken(flat: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs flat[start[k] : start[k] + size[k]] for each k of at, one after the other."""
    out = [np.zeros(0, flat.dtype)]
    for lo in range(0, len(at), 1 << 18):  # its numbers are many times the ids
        part = at[lo : lo + (1 << 18)]
        n = size[part]
        ends = np.cumsum(n)
        out.append(flat[np.repeat(start[part] - ends + n, n) + np.arange(ends[-1])])
    return np.concatenate(out)


def sliced(batch: pa.RecordBatch, at: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows of about so many bytes in the given column, one row at least."""
    run = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // size
    bounds = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(bounds, bounds[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


class WordMemory:
    """What words were encoded to, as arrays and not as Python's objects: some 30 bytes a word. A subclass encodes new words."""

    #: Words that are remembered before it starts afresh.
    REMEMBERED = 800_000

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.flat, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _asked(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, number of each) of words."""
        raise NotImplementedError

    def _rows(self, found: pa.Array) -> np.ndarray:
        """Where distinct words are kept; new ones are added."""
        at = pc.index_in(found, value_set=self.words)
        new = found.filter(pc.is_null(at))
        if len(self.words) + len(new) > self.REMEMBERED:
            self._forget()
            at, new = pa.nulls(len(found), pa.int32()), found
        ids, start, size = self._asked(new)
        row = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        row[row < 0] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, new])
        self.start, self.size = np.concatenate((self.start, start + len(self.flat))), np.concatenate((self.size, size))
        self.flat = np.concatenate((self.flat, ids))
        return row

    def _put(self, place: np.ndarray, cut: np.ndarray, more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's): place says which word, or which of `more` behind all words, stands where; cut, where texts begin and end."""
        size = np.concatenate((self.size, [len(x) for x in more])).astype(np.int64)
        flat = np.concatenate((self.flat, *more))
        start = np.concatenate((self.start, len(self.flat) + np.cumsum(size[len(self.size) :]) - size[len(self.size) :]))
        return taken(flat, start, size, place), np.cumsum(size[place])[cut[1:] - 1]
