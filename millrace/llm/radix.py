"""An adaptive radix tree over byte strings.

Inner nodes hold 4, 16, 48 or 256 children and grow into the next layout when they are full. Bytes that do not branch
are kept as the prefix of the node below them (path compression). A key may end inside another one, so inner nodes can
hold a value too.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

NONE = 255  # no slot, in a node of 48


def common(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low + 1 < high:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Node:
    """A node with the bytes before it, its value (-1 for none) and its children in one of four layouts."""

    __slots__ = ("children", "keys", "prefix", "room", "value")

    def __init__(self, prefix: bytes, value: int = -1):
        self.prefix, self.value = prefix, value
        self.room = 0
        self.keys: bytearray | None = None
        self.children: list[Node | None] = []

    def child(self, byte: int) -> Node | None:
        if self.room == 256:
            return self.children[byte]
        if self.room == 48:
            slot = self.keys[byte]
            return None if slot == NONE else self.children[slot]
        if self.room:
            at = self.keys.find(byte)
            return None if at < 0 else self.children[at]
        return None

    def put(self, byte: int, node: Node) -> None:
        """Add a child or replace it."""
        if self.room == 256:
            self.children[byte] = node
        elif self.room == 48:
            slot = self.keys[byte]
            if slot != NONE:
                self.children[slot] = node
            elif len(self.children) < 48:
                self.keys[byte] = len(self.children)
                self.children.append(node)
            else:
                self._grow()
                self.children[byte] = node
        else:
            if not self.room:
                self.room, self.keys = 4, bytearray()
            at = bisect_left(self.keys, byte)
            if at < len(self.keys) and self.keys[at] == byte:
                self.children[at] = node
            elif len(self.keys) < self.room:
                self.keys.insert(at, byte)
                self.children.insert(at, node)
            else:
                self._grow()
                self.put(byte, node)

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            slots = bytearray([NONE]) * 256
            for slot, byte in enumerate(self.keys):
                slots[byte] = slot
            self.room, self.keys = 48, slots
        else:
            wide: list[Node | None] = [None] * 256
            for byte, slot in enumerate(self.keys):
                if slot != NONE:
                    wide[byte] = self.children[slot]
            self.room, self.keys, self.children = 256, None, wide

    def in_order(self) -> list[Node]:
        """Children by their byte."""
        if self.room == 256:
            return [c for c in self.children if c is not None]
        if self.room == 48:
            return [self.children[slot] for slot in self.keys if slot != NONE]
        return self.children


class RadixTree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value: int) -> None:
        """Put a key in; of equal keys the last value stays."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, at, above, edge = self.root, 0, None, 0
        while True:
            same = common(node.prefix, key[at : at + len(node.prefix)])
            if same < len(node.prefix):
                inner = Node(node.prefix[:same])
                inner.put(node.prefix[same], node)
                node.prefix = node.prefix[same + 1 :]
                if above is None:
                    self.root = inner
                else:
                    above.put(edge, inner)
                node = inner
            at += same
            if at == len(key):
                node.value = value
                return
            byte = key[at]
            at += 1
            below = node.child(byte)
            if below is None:
                node.put(byte, Node(key[at:], value))
                return
            above, edge, node = node, byte, below

    def walk(self) -> Iterator[tuple[bool, Node, int, int, bool, bool]]:
        """Every node twice, before (``False``) and after (``True``) its children, which come in the order of keys.

        With it the number of bytes before its prefix, that is with the byte of its edge, the number of bytes to its
        end, and whether it lies on the way that always takes the first or the last child.
        """
        if self.root is None:
            return
        stack = [(False, self.root, 0, len(self.root.prefix), True, True)]
        while stack:
            entry = stack.pop()
            yield entry
            done, node, start, end, left, right = entry
            if not done:
                stack.append((True, node, start, end, left, right))
                children = node.in_order()
                for i in range(len(children) - 1, -1, -1):
                    c = children[i]
                    stack.append((False, c, end + 1, end + 1 + len(c.prefix), left and i == 0, right and i == len(children) - 1))
