"""Viterbi decoding of many sequences at once in numpy.

Sequences are cut into segments of ``SEGMENT`` steps that advance together, so
the number of numpy calls depends on the segment length and on the longest
sequence's number of segments, not on the number of steps. First every
segment's best score from each entry state to each exit state is computed,
then the segments of a sequence are chained, then every segment is decoded
between its known entry and exit state. The result is the exact best path. The
work grows with the cube of the states, so this is for a few of them.

Where every change of state costs the same, ``decode_switching`` finds the best path
with work and memory linear in the states, step by step over all sequences: a
state is entered from itself or from the step's best state.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 32
NEVER = np.float32(-1e30)


def decode(emit: np.ndarray, change: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best state per step.

    ``emit[step, state]`` and ``change[from, to]`` are added up along a path;
    sequence s is the steps ``first[s] .. first[s + 1]``. Ties go to the lower
    state number. All entry states of a sequence cost nothing.
    """
    n, k = emit.shape
    if n == 0:
        return np.zeros(0, np.int64)
    emit, change = emit.astype(np.float32), change.astype(np.float32)
    size = np.diff(first)
    per = -(-size // SEGMENT)  # segments of each sequence
    of = np.repeat(np.arange(len(size)), per)
    seg_first = np.concatenate([[0], np.cumsum(per)])
    nth = np.arange(len(of)) - seg_first[of]
    begin = first[of] + nth * SEGMENT
    length = np.minimum(SEGMENT, first[of + 1] - begin)
    # longest segments in front, so that the active ones are a leading slice
    order = np.argsort(-length, kind="stable")
    sb, sl = begin[order], length[order]
    active = np.searchsorted(-sl, -np.arange(1, SEGMENT + 1), "right")
    score = np.broadcast_to(change[None], (len(of), k, k)) + emit[sb][:, None, :]
    opening = (nth == 0)[order]
    score[opening] = emit[sb[opening]][:, None, :]
    for t in range(1, int(sl[0])):
        m = active[t]
        now = score[:m]
        best = now[:, :, 0, None] + change[0]
        for j in range(1, k):
            np.maximum(best, now[:, :, j, None] + change[j], out=best)
        best += emit[sb[:m] + t][:, None, :]
        score[:m] = best
    whole = np.empty_like(score)
    whole[order] = score
    # chain the segments of each sequence
    entry = np.zeros((len(of), k), np.int64)  # best entry state for each exit state
    busy = np.argsort(-per, kind="stable")
    reach = np.full((len(size), k), NEVER)
    reach[:, 0] = 0
    for i in range(int(per.max(initial=0))):
        s = busy[: np.searchsorted(-per[busy], -i, "left")]
        g = seg_first[s] + i
        total = reach[s][:, :, None] + whole[g]
        entry[g] = total.argmax(1)
        top = total.max(1)
        reach[s] = top - top.max(1, keepdims=True)
    leave = np.zeros(len(of), np.int64)
    state = reach.argmax(1)
    for i in range(int(per.max(initial=0)) - 1, -1, -1):
        s = busy[: np.searchsorted(-per[busy], -i, "left")]
        g = seg_first[s] + i
        leave[g] = state[s]
        state[s] = entry[g, leave[g]]
    come = entry[np.arange(len(of)), leave][order]
    # decode inside the segments
    path = np.where(opening[:, None], np.float32(0), change[come]) + emit[sb]
    number = np.min_scalar_type(k)
    back = np.zeros((int(sl[0]), len(of), k), number)
    for t in range(1, int(sl[0])):
        m = active[t]
        now = path[:m]
        best, arg = now[:, 0, None] + change[0], np.zeros((m, k), number)
        for j in range(1, k):
            other = now[:, j, None] + change[j]
            better = other > best
            best[better] = other[better]
            arg[better] = j
        back[t, :m] = arg
        path[:m] = best + emit[sb[:m] + t]
    out = np.zeros(n, np.int64)
    at = leave[order].copy()
    for t in range(int(sl[0]) - 1, -1, -1):
        m = active[t]
        out[sb[:m] + t] = at[:m]
        at[:m] = back[t, np.arange(m), at[:m]]
    return out


def decode_switching(emit: np.ndarray, cost: float, first: np.ndarray) -> np.ndarray:
    """Best state per step where every change of state costs ``cost``; otherwise as ``decode``."""
    n, k = emit.shape
    out = np.zeros(n, np.int64)
    if n == 0:
        return out
    emit, cost = emit.astype(np.float32), np.float32(cost)
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")  # the active sequences are a leading slice
    begin, length = first[:-1][order], size[order]
    active = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), "right")
    entered = np.zeros((n, -(-k // 8)), np.uint8)  # a bit for each state: from the best state of the step before
    leader = np.zeros(n, np.min_scalar_type(k))
    score = np.zeros((len(size), k), np.float32)
    score[: active[0]] = emit[begin[: active[0]]]
    states = np.arange(k)
    for t, m in enumerate(active[1:], 1):
        at, now = begin[:m] + t, score[:m]
        lead = now.argmax(1)
        now -= now[np.arange(m), lead, None]
        entered[at] = np.packbits((now < -cost) | (now == -cost) & (lead[:, None] < states), axis=1)
        leader[at] = lead
        score[:m] = np.maximum(now, -cost) + emit[at]
    state = score.argmax(1)
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at, own = begin[:m] + t, state[:m]
        out[at] = own
        if t:
            bit = entered[at, own >> 3] >> (7 - (own & 7)).astype(np.uint8) & 1
            state[:m] = np.where(bit == 1, leader[at], own)
    return out
