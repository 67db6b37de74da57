"""Multikey three-way quicksort of pointers, all open slices of a level at once.

Pointers stand for strings of characters (bytes eight at a time, or whole words). A slice holds pointers that agree in
all characters so far. One round splits every open slice by a pivot of its own into less, equal and greater; the equal part is done
at this depth and becomes a slice of the next one, where the next character counts. Splitting keeps
the order of pointers in a part, so equal strings end in the order they began.
"""

from __future__ import annotations

import numpy as np


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all slices, one slice after the other; in 32 bits, as a shard has fewer."""
    ends = np.cumsum(sizes, dtype=np.int32)
    n = int(ends[-1]) if len(ends) else 0
    return np.arange(n, dtype=np.int32) + np.repeat((starts - (ends - sizes)).astype(np.int32), sizes)


def three_way(order: np.ndarray, key: np.ndarray, first: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Sort ``order`` (pointers) and ``key`` (their characters at this depth, by position) inside each slice, and
    mark in ``first`` where a run of equal characters begins. All three are changed in place."""
    first[starts] = True
    starts, sizes = starts.astype(np.int32), sizes.astype(np.int32)
    some = sizes > 1
    starts, sizes = starts[some], sizes[some]
    while len(starts):
        pivot = np.repeat(key[starts + sizes // 2], sizes)
        where = places(starts, sizes)
        mine, held = key[where], order[where]
        less, more = mine < pivot, mine > pivot
        before_less, before_more = np.cumsum(less, dtype=np.int32), np.cumsum(more, dtype=np.int32)
        ends = np.cumsum(sizes, dtype=np.int32)
        n_less = np.diff(before_less[ends - 1], prepend=np.int32(0))
        n_more = np.diff(before_more[ends - 1], prepend=np.int32(0))
        past_less, past_more = before_less[ends - 1] - n_less, before_more[ends - 1] - n_more  # of earlier slices
        n_equal = sizes - n_less - n_more
        # equal ones keep their place, moved by how many around them leave; the others go to the ends of their slice
        goal = where
        goal += np.repeat(n_less + past_less + past_more, sizes)
        goal -= before_less
        goal -= before_more
        at = np.flatnonzero(less)
        goal[at] = (np.repeat(starts - past_less, n_less) + before_less[at]) - 1
        at = np.flatnonzero(more)
        goal[at] = (np.repeat(starts + n_less + n_equal - past_more, n_more) + before_more[at]) - 1
        key[goal], order[goal] = mine, held
        first[starts + n_less] = True
        after = starts + n_less + n_equal
        first[after[n_more > 0]] = True
        starts, sizes = np.concatenate((starts[n_less > 0], after[n_more > 0])), np.concatenate((n_less[n_less > 0], n_more[n_more > 0]))
        some = sizes > 1
        starts, sizes = starts[some], sizes[some]


def slices(first: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs that ``first`` marks inside some slices: starts and sizes."""
    where = places(starts, sizes)
    begin = np.flatnonzero(first[where])
    return where[begin], np.diff(np.concatenate((begin, [len(where)]))).astype(np.int32)
