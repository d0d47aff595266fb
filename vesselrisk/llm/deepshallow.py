"""Deep-shallow suffix sorting: multikey quicksort to a shallow depth, then blind tries.

``suffix_order`` sorts byte strings that agree in a known prefix per group, and gives the
longest common prefix of neighbours. Eight bytes count as one character of the multikey
sort, so that its partitioning is a vectorised sort of whole words; groups that still
agree at the shallow depth have long common prefixes and go into a blind trie each.
"""

from __future__ import annotations

import numpy as np

SHALLOW_WORDS = 2


def lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Nodes keep only the depth of their branching and one branch per next byte (-1: the string ends there)."""

    def __init__(self, strings: list[bytes], first: int):
        self.strings = strings
        self.root: list | int = first  # a leaf is an index, a node is [depth, {byte: child}]

    def _byte(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int) -> None:
        node = self.root
        while isinstance(node, list):  # down to some leaf, without looking at the bytes between branchings
            node = node[1].get(self._byte(i, node[0])) if self._byte(i, node[0]) in node[1] else next(iter(node[1].values()))
        depth = lcp(self.strings[i], self.strings[node])  # the one comparison tells where the string leaves the trie
        if depth == len(self.strings[i]) == len(self.strings[node]):
            depth += 1  # equal strings: side by side under a branching below their ends
        parent, branch, at = None, None, self.root
        while isinstance(at, list) and at[0] < depth:
            parent, branch = at, self._byte(i, at[0])
            at = at[1][branch]
        if isinstance(at, list) and at[0] == depth:
            at[1][i if depth > len(self.strings[i]) else self._byte(i, depth)] = i
            return
        old = node if not isinstance(at, list) else at
        key = (lambda j: j if depth > len(self.strings[j]) else self._byte(j, depth)) if depth <= len(self.strings[i]) else (lambda j: j)
        some = old
        while isinstance(some, list):
            some = next(iter(some[1].values()))
        split = [depth, {key(some): old, key(i): i}]
        if parent is None:
            self.root = split
        else:
            parent[1][branch] = split

    def in_order(self) -> list[tuple[int, int]]:
        """(string, common prefix with the one before) from least to greatest."""
        out: list[tuple[int, int]] = []
        stack: list[tuple[list | int, int]] = [(self.root, 0)]
        while stack:
            node, common = stack.pop()
            if not isinstance(node, list):
                out.append((node, common))
                continue
            children = [node[1][k] for k in sorted(node[1])]
            stack.extend((c, node[0]) for c in reversed(children[1:]))
            stack.append((children[0], common))
        return out


def suffix_order(strings: list[bytes], group: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): indices sorted by (group, string), and the common prefix with the one before (0 at a group's start).

    Strings of one group agree in their first ``prefix`` bytes, or wholly if they are shorter.
    """
    n = len(strings)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    wide = 8 * SHALLOW_WORDS
    heads = np.frombuffer(b"".join(s[prefix : prefix + wide].ljust(wide, b"\x00") for s in strings), ">u8").reshape(n, SHALLOW_WORDS)
    short = np.fromiter((min(len(s), prefix + wide) for s in strings), np.int64, n)
    cls = np.array(group, np.int64)
    order = np.argsort(cls, kind="stable")
    for word in range(SHALLOW_WORDS):  # multikey: order within the classes that agree so far by the next word
        order = order[np.lexsort((heads[order, word], cls[order]))]
        new = np.concatenate(([False], (cls[order][1:] != cls[order][:-1]) | (heads[order, word][1:] != heads[order, word][:-1])))
        cls[order] = np.cumsum(new)
    order = order[np.lexsort((short[order], cls[order]))]  # zero padding against real zero bytes
    new = np.concatenate(([True], cls[order][1:] != cls[order][:-1]))
    common = np.zeros(n, np.int64)
    starts = np.append(np.nonzero(new)[0], n)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a > 1:
            members = order[a:b].tolist()
            trie = BlindTrie(strings, members[0])
            for i in members[1:]:
                trie.insert(i)
            walked = trie.in_order()
            order[a:b] = [i for i, _ in walked]
            common[a + 1 : b] = [min(c, len(strings[i]), len(strings[j])) for (j, _), (i, c) in zip(walked, walked[1:])]
    g = np.asarray(group)
    for k in starts[1:-1].tolist():  # between classes of one group the shallow part tells
        i, j = int(order[k - 1]), int(order[k])
        if g[i] == g[j]:
            common[k] = lcp(strings[i], strings[j])
    return order, common
