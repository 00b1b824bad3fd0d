"""Greedy relative Lempel-Ziv parsing of many runs of words against those with smaller ids, in numpy."""

from __future__ import annotations

import itertools

import numpy as np

from tickerloom.llm import words as W

#: Words that are compared at once.
COMPARED = 1 << 18

_SEED = 0x9E3779B97F4A7C15


def extend(codes: np.ndarray, at: np.ndarray, other: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many words from each place on are those from the other place on, up to its limit."""
    n = np.zeros(len(at), np.int64)
    live, step = np.arange(len(at)), 32
    while len(live):
        on = []
        for i in range(0, len(live), max(1, COMPARED // step)):
            own = live[i : i + max(1, COMPARED // step)]
            take = np.arange(step)
            inside = take < (limit[own] - n[own])[:, None]
            a, b = (at[own] + n[own])[:, None] + take, (other[own] + n[own])[:, None] + take
            same = inside & (codes[np.where(inside, a, 0)] == codes[np.where(inside, b, 0)])
            whole = same.all(1)
            n[own] += np.where(whole, step, same.argmin(1))
            on.append(own[whole])
        live = np.concatenate(on)
        step = min(step * 2, 4096)
    return n


class _Index:
    """The windows of all runs by their earliest occurrence: those that have one in a run of smaller id, and where."""

    def __init__(self, codes: np.ndarray, run: np.ndarray, ids: np.ndarray, size: int, seed: int):
        at = np.flatnonzero(W.whole_windows(run, size))
        h = W.rolled(W.mix(codes.astype(np.uint64) + np.uint64((seed + 1) * _SEED % (1 << 64))), size)[at]
        order = np.argsort(h)
        of = ids[run[at[order]]]
        begins = np.append(True, np.diff(h[order]) != 0)[: len(order)]
        heads = np.flatnonzero(begins)
        group = np.cumsum(begins) - 1
        least = np.minimum.reduceat(of, heads)[group] if len(heads) else of
        first = np.flatnonzero(of == least)
        first = first[np.append(True, np.diff(group[first]) != 0)[: len(first)]]  # one of the earliest of each group
        later = np.flatnonzero(of > least)
        place = at[order[later]]
        sort = np.argsort(place)
        self.at, self.source = place[sort], at[order[first[group[later]]]][sort]


def parse(codes: np.ndarray, first: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, length, source) of the factors of size words and more, as places in codes.

    codes: the words of all runs as numbers, equal only for equal words; first: where each run begins, with the end;
    ids: of each run. A run's cursor goes to its first window of size words with an occurrence in a run of smaller id.
    The factor is the longest match of what follows with the earliest occurrence, found by comparing the words.
    The cursor then stands at the first window that the factor doesn't cover, which lies across the factor's end, so
    windows at boundaries are tested like all others. Windows are indexed by hashes; where a comparison shows that
    two different windows share one, all are indexed anew with another seed.
    """
    run = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for seed in itertools.count():
        index = _Index(codes, run, ids, size, seed)
        active = np.unique(run[index.at])
        cursor = first[active]
        found, right = [], True
        while len(active) and right:
            k = np.searchsorted(index.at, cursor)
            k = np.minimum(k, len(index.at) - 1)
            there = (index.at[k] >= cursor) & (run[index.at[k]] == active)
            active, k = active[there], k[there]
            begin, source = index.at[k], index.source[k]
            length = extend(codes, begin, source, np.minimum(first[active + 1] - begin, first[run[source] + 1] - source))
            right = bool((length >= size).all())
            found.append((begin, length, source))
            cursor = begin + length - size + 1
        if right:
            none = np.zeros(0, np.int64)
            return tuple(np.concatenate(x) for x in zip((none, none, none), *found, strict=True))
