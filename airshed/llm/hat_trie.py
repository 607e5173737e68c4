"""A HAT-trie that counts sequences of word ids: hash containers below a shallow trie, spilled a subtree at a time.

Sequences of at most `depth` ids (1 or more, 0 after the end) are held as columns of 64-bit numbers, two ids a number, so that the
columns' order is that of the ids. An inner node stands for the ids on the way to it and deals the next id out to its children, each for a range of
ids. A container takes what falls into its range, adds equal sequences up in an Arrow hash table, and bursts when it
holds too many distinct ones: a range of several ids is cut at the middle one, a single id becomes a node of its own. When all
containers together hold more than the budget, the largest subtrees below the root are emptied as sorted runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

ID_BITS = 32
LAST_ID = 1 << 31  # ids are below this
BURST = 1 << 16  # distinct sequences of a container that may be parted further
BUDGET = 1 << 20  # distinct sequences of all containers: some 60 MB

Run = tuple[list[np.ndarray], np.ndarray]  # sorted columns, counts


def columns_of(depth: int) -> int:
    return (depth + 1) // 2


def pack(ids: list[np.ndarray]) -> list[np.ndarray]:
    """Columns of sequences from one array for each place."""
    places = [*ids, np.zeros_like(ids[0])] if len(ids) % 2 else ids
    return [(places[i].astype(np.int64) << ID_BITS) | places[i + 1].astype(np.int64) for i in range(0, len(places), 2)]


def id_at(columns: list[np.ndarray], place: int) -> np.ndarray:
    """The id at a place of each sequence."""
    return (columns[place // 2] >> ID_BITS) if place % 2 == 0 else columns[place // 2] & ((1 << ID_BITS) - 1)


def add_up(columns: list[np.ndarray], counts: np.ndarray) -> Run:
    """Equal sequences added up by an Arrow hash table, in no order."""
    names = [f"k{i}" for i in range(len(columns))]
    t = pa.table([*map(pa.array, columns), pa.array(counts)], names=[*names, "n"])
    out = t.group_by(names, use_threads=False).aggregate([("n", "sum")])
    return [out[k].to_numpy() for k in names], out["n_sum"].to_numpy()


def in_order(columns: list[np.ndarray], counts: np.ndarray) -> Run:
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns], counts[order]


class Container:
    """Sequences whose id at `place` is in [low, high), and which agree before it."""

    def __init__(self, place: int, low: int, high: int):
        self.place, self.low, self.high = place, low, high
        self.parts: list[Run] = []
        self.size = self.sure = 0  # sequences held, and how many of them are known to be distinct

    def add(self, columns: list[np.ndarray], counts: np.ndarray) -> None:
        self.parts.append((columns, counts))
        self.size += len(counts)

    def settle(self) -> Run:
        """All parts as one, equal sequences added up."""
        if len(self.parts) > 1:
            joined = [np.concatenate(c) for c in zip(*(p[0] for p in self.parts))]
            self.parts = [add_up(joined, np.concatenate([p[1] for p in self.parts]))]
        self.size = self.sure = len(self.parts[0][1]) if self.parts else 0
        return self.parts[0]

    def burst(self, depth: int) -> "list[Container] | Node":
        """Two containers that share the range, or a node for the range's only id."""
        columns, counts = self.settle()
        ids = id_at(columns, self.place)
        middle = int(np.partition(ids, len(ids) // 2)[len(ids) // 2])
        cut = middle if middle > ids.min() else middle + 1
        if cut <= ids.max():
            halves = [Container(self.place, self.low, cut), Container(self.place, cut, self.high)]
            for half, mine in zip(halves, (ids < cut, ids >= cut)):
                half.add([c[mine] for c in columns], counts[mine])
                half.settle()
            return halves
        if self.place + 1 == depth:  # whole sequences that agree in all ids: at most one
            return [self]
        node = Node(self.place + 1)
        node.children[0].add(columns, counts)
        node.children[0].settle()
        one = Container(self.place, middle, middle + 1)
        one.node = node
        return [c for c in (Container(self.place, self.low, middle), one, Container(self.place, middle + 1, self.high)) if c.low < c.high]

    node: "Node | None" = None  # below a single id that was burst

    def emptied(self) -> Run | None:
        """Everything below as one sorted run; the container is empty afterwards."""
        runs = [c.emptied() for c in self.node.children] if self.node else []
        if self.parts:
            runs.append(self.settle())
        self.parts, self.size, self.sure, self.node = [], 0, 0, None
        runs = [r for r in runs if r is not None]
        if not runs:
            return None
        columns = [np.concatenate(c) for c in zip(*(r[0] for r in runs))]
        return in_order(*add_up(columns, np.concatenate([r[1] for r in runs])))


class Node:
    """Children in order of their ranges, which cover all ids."""

    def __init__(self, place: int):
        self.place = place
        self.children = [Container(place, 0, LAST_ID)]

    def add(self, columns: list[np.ndarray], counts: np.ndarray, trie: "HatTrie") -> None:
        """Deal out sequences that are sorted."""
        bounds = np.array([c.low for c in self.children[1:]], dtype=np.int64)
        cuts = [0, *np.searchsorted(id_at(columns, self.place), bounds, side="left").tolist(), len(counts)]
        grown: list[Container] = []
        for child, start, stop in zip(self.children, cuts, cuts[1:]):
            grown.append(child)
            if start == stop:
                continue
            part, n = [c[start:stop] for c in columns], counts[start:stop]
            if child.node is not None:
                child.node.add(part, n, trie)
                continue
            child.add(part, n)
            if child.size > 2 * max(child.sure, trie.burst // 2):
                child.settle()
            if child.size > trie.burst and len(child.parts) == 1:
                grown[-1:] = child.burst(trie.depth)
        self.children = grown

    def held(self, child: Container) -> int:
        return child.size + (sum(child.node.held(c) for c in child.node.children) if child.node else 0)


class HatTrie:
    def __init__(self, depth: int, burst: int = BURST, budget: int = BUDGET):
        self.depth, self.burst, self.budget = depth, burst, budget
        self.root = Node(0)

    def __len__(self) -> int:
        return sum(self.root.held(c) for c in self.root.children)

    def add(self, columns: list[np.ndarray], counts: np.ndarray | None = None) -> Iterator[Run]:
        """Count sequences (in any order); yields the runs that had to be spilled."""
        if not len(columns[0]):
            return
        run = in_order(*add_up(columns, np.ones(len(columns[0]), np.int64) if counts is None else counts))
        self.root.add(*run, self)
        if len(self) > self.budget:
            yield from self.spill(self.budget // 2)

    def spill(self, most: int = 0) -> Iterator[Run]:
        """Empty the largest subtrees below the root until at most `most` sequences are held."""
        left = len(self)
        for child in sorted(self.root.children, key=self.root.held, reverse=True):
            if left <= most:
                return
            left -= self.root.held(child)
            if (run := child.emptied()) is not None:
                yield run
