"""An adaptive radix tree over byte keys, with path compression.

An inner node keeps its children in one of four layouts, taken by their number:
up to 4 or 16 in a sorted list of key bytes, up to 48 behind a 256-entry index,
beyond that one place for each byte.  Bytes that all keys below a node share are
kept once, in its prefix.  A key may be the beginning of another; its value then
stands at an inner node.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

LAYOUTS = (4, 16, 48, 256)


class Node:
    __slots__ = ("prefix", "value", "layout", "index", "kids")

    def __init__(self, prefix: bytes, value: Any = None):
        self.prefix = prefix
        self.value = value
        self.layout = LAYOUTS[0]
        self.index = bytearray()
        self.kids: list[Node | None] = []

    def find(self, byte: int) -> Node | None:
        if self.layout == 256:
            return self.kids[byte]
        if self.layout == 48:
            at = self.index[byte]
            return self.kids[at - 1] if at else None
        at = bisect_left(self.index, byte)
        return self.kids[at] if at < len(self.index) and self.index[at] == byte else None

    def add(self, byte: int, child: Node) -> None:
        if self.layout != 256 and len(self.kids) == self.layout:
            self._grow()
        if self.layout == 256:
            self.kids[byte] = child
        elif self.layout == 48:
            self.kids.append(child)
            self.index[byte] = len(self.kids)
        else:
            at = bisect_left(self.index, byte)
            self.index.insert(at, byte)
            self.kids.insert(at, child)

    def _grow(self) -> None:
        pairs = list(self.children())
        self.layout = LAYOUTS[LAYOUTS.index(self.layout) + 1]
        if self.layout == 48:
            self.index = bytearray(256)
            for k, (byte, _) in enumerate(pairs):
                self.index[byte] = k + 1
            self.kids = [kid for _, kid in pairs]
        elif self.layout == 256:
            self.index = bytearray()
            self.kids = [None] * 256
            for byte, kid in pairs:
                self.kids[byte] = kid

    def children(self) -> Iterator[tuple[int, Node]]:
        """The children by ascending byte."""
        if self.layout == 256:
            yield from ((b, k) for b, k in enumerate(self.kids) if k is not None)
        elif self.layout == 48:
            yield from ((b, self.kids[at - 1]) for b, at in enumerate(self.index) if at)
        else:
            yield from zip(self.index, self.kids, strict=True)

    def place(self, byte: int, child: Node) -> None:
        """Puts another child in the place of an existing one."""
        if self.layout == 256:
            self.kids[byte] = child
        elif self.layout == 48:
            self.kids[self.index[byte] - 1] = child
        else:
            self.kids[bisect_left(self.index, byte)] = child


def _shared(a: bytes, b: bytes) -> int:
    """How many first bytes are the same."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class RadixTree:
    """``insert`` distinct keys, then walk from ``top`` (whose prefix is empty)."""

    def __init__(self) -> None:
        self.top = Node(b"")

    def insert(self, key: bytes, value: Any) -> None:
        node, at, above, byte = self.top, 0, None, 0
        while True:
            prefix = node.prefix
            if prefix and not key.startswith(prefix, at):
                same = _shared(prefix, key[at:at + len(prefix)])
                split = Node(prefix[:same])
                node.prefix = prefix[same + 1:]
                split.add(prefix[same], node)
                above.place(byte, split)
                node = split
            at += len(node.prefix)
            if at == len(key):
                node.value = value
                return
            above, byte = node, key[at]
            at += 1
            node = above.find(byte)
            if node is None:
                above.add(byte, Node(key[at:], value))
                return
