"""An adaptive radix tree over byte strings, for one portion of sorted keys.

An inner node keeps its children in the smallest of four layouts that holds them: two lists of up
to 4 or 16 entries in order of their byte, an index of 256 places into up to 48 children, or 256
children by byte. A node that is full is changed to the next layout. Bytes that all keys below a
node share are kept once, as its prefix (path compression), and a key alone in its part of the
tree is one leaf with all its remaining bytes.
"""

from __future__ import annotations

from collections.abc import Iterator


class SmallNode:
    """Up to ``most`` children, their bytes in order."""

    __slots__ = ("most", "letters", "below")
    kinds = (4, 16)

    def __init__(self, most: int) -> None:
        self.most, self.letters, self.below = most, bytearray(), []

    def get(self, letter: int):
        at = self.letters.find(letter)
        return None if at < 0 else self.below[at]

    def put(self, letter: int, child):
        """Add or replace a child; the layout that holds it."""
        at = self.letters.find(letter)
        if at >= 0:
            self.below[at] = child
            return self
        if len(self.below) == self.most:
            larger = SmallNode(16) if self.most == 4 else IndexedNode()
            for known, other in self.items():
                larger = larger.put(known, other)
            return larger.put(letter, child)
        at = sum(known < letter for known in self.letters)
        self.letters.insert(at, letter)
        self.below.insert(at, child)
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return zip(bytes(self.letters), list(self.below))


class IndexedNode:
    """Up to 48 children in any order, found by an index over all bytes."""

    __slots__ = ("index", "below")
    _NONE = 255

    def __init__(self) -> None:
        self.index, self.below = bytearray([self._NONE]) * 256, []

    def get(self, letter: int):
        at = self.index[letter]
        return None if at == self._NONE else self.below[at]

    def put(self, letter: int, child):
        at = self.index[letter]
        if at != self._NONE:
            self.below[at] = child
            return self
        if len(self.below) == 48:
            larger = FullNode()
            for known, other in self.items():
                larger.put(known, other)
            return larger.put(letter, child)
        self.index[letter] = len(self.below)
        self.below.append(child)
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, self.below[at]) for b, at in enumerate(self.index) if at != self._NONE)


class FullNode:
    """A place for a child of every byte."""

    __slots__ = ("below",)

    def __init__(self) -> None:
        self.below = [None] * 256

    def get(self, letter: int):
        return self.below[letter]

    def put(self, letter: int, child):
        self.below[letter] = child
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, child) for b, child in enumerate(self.below) if child is not None)


class Node:
    """A place in the tree: the bytes that lead to it from the one above, the values of the key
    that ends there, and its children (None for a leaf)."""

    __slots__ = ("prefix", "values", "children")

    def __init__(self, prefix: bytes, values: list, children=None) -> None:
        self.prefix, self.values, self.children = prefix, values, children


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning of two strings."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    def __init__(self) -> None:
        self.root = Node(b"", [])

    def add(self, key: bytes, value) -> None:
        """Put a value to a key."""
        node, at = self.root, 0
        while True:
            same = _shared(node.prefix, key[at : at + len(node.prefix)])
            if same < len(node.prefix):
                self._split(node, same)
            at += same
            if at == len(key):
                node.values.append(value)
                return
            child = None if node.children is None else node.children.get(key[at])
            if child is None:
                children = SmallNode(4) if node.children is None else node.children
                # The byte that selects a child is the first of the child's prefix.
                node.children = children.put(key[at], Node(key[at:], [value]))
                return
            node = child

    @staticmethod
    def _split(node: Node, at: int) -> None:
        """Cut the prefix of a node; what followed becomes its only child."""
        lower = Node(node.prefix[at:], node.values, node.children)
        node.prefix, node.values = node.prefix[:at], []
        node.children = SmallNode(4).put(lower.prefix[0], lower)

    def children(self, node: Node) -> list[Node]:
        """The children in order of their bytes."""
        return [] if node.children is None else [child for _, child in node.children.items()]
