"""Deep-shallow sorting of byte strings of one length, group by group, with common-prefix lengths.

Shallow: multikey quicksort, eight bytes at a time. The ternary partitions that all open groups make
at one depth are made together; strings that stay equal are open at the next depth, and where no
open group has a difference there is nothing to sort. Deep: what still shares a prefix at the shallow
depth is ordered by blind tries, one for each group: a string finds its way by the bytes at branching
depths alone, is then compared once with the leaf it comes to, and enters the trie where it
first differs. Equal strings are one leaf. Groups of very many different strings take
another step of the quicksort first, so that no trie grows large.
"""

from __future__ import annotations

import numpy as np

WORD = 8
TRIE = 48


def as_words(strings: np.ndarray) -> np.ndarray:
    """Rows of bytes, of a length divisible by eight, as big-endian numbers that sort alike."""
    return np.ascontiguousarray(strings).view(">u8").astype(np.uint64)


def _first_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix of rows of words, in bytes."""
    differ = a != b
    at = differ.argmax(axis=1)
    some = differ.any(axis=1)
    rows = np.arange(len(a))
    x = a[rows, at] ^ b[rows, at]
    within = np.zeros(len(a), np.int64)
    for k in range(1, WORD):
        within += x < (np.uint64(1) << np.uint64(64 - 8 * k))
    return np.where(some, at * WORD + within, a.shape[1] * WORD)


class _Trie:
    """A blind trie: inner nodes are [depth, {byte: child}], leaves are places in ``strings``."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = 0
        for k in range(1, len(strings)):
            self._insert(k)

    def _insert(self, k: int) -> None:
        s, node = self.strings[k], self.root
        while isinstance(node, list):
            child = node[1].get(s[node[0]])
            node = next(iter(node[1].values())) if child is None else child
        leaf = self.strings[node]
        both = int.from_bytes(s) ^ int.from_bytes(leaf)
        depth = len(s) - (both.bit_length() + 7) // 8
        parent, node = None, self.root
        while isinstance(node, list) and node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        if isinstance(node, list) and node[0] == depth:
            node[1][s[depth]] = k
            return
        fork = [depth, {leaf[depth]: node, s[depth]: k}]
        if parent is None:
            self.root = fork
        else:
            parent[1][s[parent[0]]] = fork

    def in_order(self) -> tuple[list[int], list[int]]:
        """Places in order, and the common prefix of each with the one before (0 for the first)."""
        places, common = [], []
        todo = [(self.root, 0)]
        while todo:
            node, shared = todo.pop()
            if isinstance(node, list):
                children = sorted(node[1].items())
                todo.extend((child, node[0]) for _, child in reversed(children[1:]))
                todo.append((children[0][1], shared))
            else:
                places.append(node)
                common.append(shared)
        return places, common


def deep_shallow_sort(words: np.ndarray, group: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by (group, string), and the bytes each shares with the row before it.

    ``group`` is in ascending order. A row shares -1 bytes with one of another group.
    ``shallow`` is the number of words that the quicksort goes deep.
    """
    n, width = words.shape
    order = np.arange(n)
    new = np.append(True, group[1:] != group[:-1])[:n]
    sizes = None
    for depth in range(width):
        if depth >= shallow:
            begins = np.flatnonzero(new)
            sizes = np.diff(np.append(begins, n))
            if not (sizes > TRIE).any():
                break
            crowded = np.repeat(sizes > TRIE, sizes)
        else:
            crowded = np.ones(n, bool)
        value = words[order, depth]
        differs = ~new & crowded
        differs[1:] &= value[1:] != value[:-1]
        if not differs.any():
            continue
        cls = np.cumsum(new)
        touched = np.zeros(cls[-1] + 1, bool)
        touched[cls[differs]] = True
        at = np.flatnonzero(touched[cls])
        resorted = at[np.lexsort((value[at], cls[at]))]
        order[at], value[at] = order[resorted], value[resorted]
        new[at[1:]] |= value[at[1:]] != value[at[:-1]]
    # Equal strings are one leaf: in a group of one string there is nothing to order.
    begins = np.flatnonzero(new)
    leader = np.repeat(begins, np.diff(np.append(begins, n)))
    apart = (words[order] != words[order[leader]]).any(axis=1)
    common = np.full(n, -1, np.int64)
    cls = np.cumsum(new) - 1
    for k in np.unique(cls[apart]).tolist():
        begin = int(begins[k])
        end = int(begins[k + 1]) if k + 1 < len(begins) else n
        own = order[begin:end]
        places: dict[bytes, list[int]] = {}
        for row, text in zip(own.tolist(), words[own].astype(">u8"), strict=True):
            places.setdefault(text.tobytes(), []).append(row)
        strings = list(places)
        ranked, _ = _Trie(strings).in_order()
        order[begin:end] = [row for r in ranked for row in places[strings[r]]]
    # Neighbours are known now, and one comparison of each pair gives what they share.
    if n > 1:
        same = group[1:] == group[:-1]
        after = np.flatnonzero(same) + 1
        common[after] = _first_difference(words[order[after]], words[order[after - 1]])
    return order, common
