"""Which candidate sets do baskets hold: a prefix tree in flat arrays, walked over batches of baskets.

Items are whole numbers, in rising order in every set and basket. Node 0 is the root; the tree is the
sorted list of its edges, an edge being parent * items + item, and edge e leads to node e + 1.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

# The functions that run in Python workers travel whole: these need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Steps that are tried at once.
SLAB = 1 << 20


@dataclass
class PrefixTree:
    edges: np.ndarray
    whole: np.ndarray  # per node, the set that ends there, or -1
    items: int


def build(flat: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, items: int) -> PrefixTree:
    """From distinct sets one after the other in `flat`, their sizes and their numbers."""
    starts = np.cumsum(sizes) - sizes
    node = np.zeros(len(sizes), dtype=np.int64)
    levels, ends, first = [], [np.array([-1])], 1
    for level in range(int(sizes.max(initial=0))):
        own = np.nonzero(sizes > level)[0]
        keys, place = np.unique(node[own] * items + flat[starts[own] + level], return_inverse=True)
        node[own] = first + place
        whole = np.full(len(keys), -1, dtype=np.int64)
        done = sizes[own] == level + 1
        whole[place[done]] = numbers[own[done]]
        # Parents of a level have larger numbers than those of the level before, so the edges stay sorted.
        levels.append(keys)
        ends.append(whole)
        first += len(keys)
    return PrefixTree(np.concatenate([np.zeros(0, np.int64), *levels]), np.concatenate(ends), items)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the keys are there, and where."""
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return (sorted_keys[at] == keys) if len(sorted_keys) else np.zeros(len(keys), dtype=bool), at


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(own, at): the numbers first .. first + count - 1 of each."""
    own = np.repeat(np.arange(len(count)), count)
    return own, np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) + first[own]


def walk(tree: PrefixTree, offsets: np.ndarray, items: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(baskets, sets): the sets of the tree that each basket holds, in portions.

    From a node a basket either tries its later items or the node's children, whichever are fewer. Portions that
    are left wait on a stack, so memory doesn't grow with the number of sets that baskets share.
    """
    offsets, items = offsets.astype(np.int64), items.astype(np.int64)
    ends, sizes = offsets[1:], np.diff(offsets)
    held = np.repeat(np.arange(len(sizes)), sizes) * tree.items + items
    full = np.nonzero(sizes)[0]
    # (baskets, positions of the next item, nodes)
    waiting = [(full, offsets[:-1][full], np.zeros(len(full), dtype=np.int64))]
    while waiting:
        basket, place, node = waiting.pop()
        if not len(basket):
            continue
        low = np.searchsorted(tree.edges, node * tree.items)
        children = np.searchsorted(tree.edges, (node + 1) * tree.items) - low
        rest = ends[basket] - place
        tries = np.minimum(children, rest)
        fits = max(1, int(np.searchsorted(np.cumsum(tries), SLAB, "right")))
        if fits < len(basket):
            waiting.append((basket[fits:], place[fits:], node[fits:]))
            basket, place, node = basket[:fits], place[:fits], node[:fits]
            low, children, rest = low[:fits], children[:fits], rest[:fits]
        by_child = children < rest
        grown = []
        some = np.nonzero(by_child)[0]
        own, edge = _spread(low[some], children[some])
        own = some[own]
        there, at = _find(held, basket[own] * tree.items + tree.edges[edge] % tree.items)
        grown.append((basket[own][there], at[there] + 1, edge[there] + 1))
        some = np.nonzero(~by_child)[0]
        own, at = _spread(place[some], rest[some])
        own = some[own]
        there, edge = _find(tree.edges, node[own] * tree.items + items[at])
        grown.append((basket[own][there], at[there] + 1, edge[there] + 1))
        basket, place, node = (np.concatenate(parts) for parts in zip(*grown, strict=True))
        found = tree.whole[node]
        if (found >= 0).any():
            yield basket[found >= 0], found[found >= 0]
        waiting.append((basket, place, node))
