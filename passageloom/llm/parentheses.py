"""Balanced parentheses: an ordered forest as bits, an open and a close for each node in depth-first order.

The excess after a bit is the number of nodes that are open there. A node closes at the first later bit with an excess
one below its own. Blocks of bits carry their smallest excess, and a tree of minima over the blocks leads from a node to
the block in which it closes, so nothing between is read.
"""

from __future__ import annotations

import numpy as np

BLOCK_BITS = 64


def _minima(excess: np.ndarray, block: int) -> list[np.ndarray]:
    """The smallest excess of each block, of each pair of blocks, and so on up to one."""
    full = np.full(-(-len(excess) // block) * block, np.iinfo(np.int64).max)
    full[: len(excess)] = excess
    levels = [full.reshape(-1, block).min(axis=1)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        if len(last) % 2:
            last = np.append(last, np.iinfo(np.int64).max)
        levels.append(last.reshape(-1, 2).min(axis=1))
    return levels


def _in_block(excess: np.ndarray, start: np.ndarray, wanted: np.ndarray, block: int) -> np.ndarray:
    """The first place from each start to the end of its block with the wanted excess, or -1."""
    found = np.full(len(start), -1, dtype=np.int64)
    open_ = np.arange(len(start))
    at = start.copy()
    stop = np.minimum((start // block + 1) * block, len(excess))
    while len(open_):
        open_ = open_[at[open_] < stop[open_]]
        hit = excess[at[open_]] == wanted[open_]
        found[open_[hit]] = at[open_[hit]]
        open_ = open_[~hit]
        at[open_] += 1
    return found


def find_close(bits: np.ndarray, block: int = BLOCK_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Where each node opens and where it closes, in depth-first order. The bits (1 open, 0 close) are balanced."""
    bits = np.asarray(bits, dtype=np.int64)
    opens = np.flatnonzero(bits)
    excess = np.cumsum(2 * bits - 1)
    wanted = excess[opens] - 1
    close = _in_block(excess, opens + 1, wanted, block) if len(opens) else opens.copy()
    # A node that opens at the last bit of its block looked into the block behind; that is where it has to look.
    far = np.flatnonzero(close < 0)
    if not len(far):
        return opens, close
    levels = _minima(excess, block)
    at, goal = (opens[far] + 1) // block, wanted[far]
    level_of, node_of = np.full(len(far), -1), np.zeros(len(far), dtype=np.int64)
    left = np.arange(len(far))
    for level, minima in enumerate(levels):
        beside = at[left] + 1
        hit = (at[left] % 2 == 0) & (beside < len(minima))
        hit[hit] = minima[beside[hit]] <= goal[left[hit]]
        level_of[left[hit]], node_of[left[hit]] = level, beside[hit]
        left = left[~hit]
        at[left] //= 2
    for level in range(len(levels) - 1, 0, -1):
        down = np.flatnonzero(level_of == level)
        child = 2 * node_of[down]
        node_of[down] = np.where(levels[level - 1][child] <= goal[down], child, child + 1)
        level_of[down] = level - 1
    close[far] = _in_block(excess, node_of * block, goal, block)
    return opens, close


def subtree_sums(bits: np.ndarray, *weights: np.ndarray) -> list[np.ndarray]:
    """For each node the sums of the weights (one for each node, in depth-first order) over its subtree, itself included."""
    opens, close = find_close(bits)
    before = np.concatenate([[0], np.cumsum(np.asarray(bits, dtype=np.int64))])  # rank: nodes opened before a bit
    first, last = before[opens], before[close]
    out = []
    for weight in weights:
        running = np.concatenate([[0], np.cumsum(weight, dtype=np.int64)])
        out.append(running[last] - running[first])
    return out


def leaf_pairs(bits: np.ndarray) -> np.ndarray:
    """For each node whether it closes right behind where it opens."""
    bits = np.asarray(bits, dtype=np.int64)
    opens = np.flatnonzero(bits)
    return bits[opens + 1] == 0
