"""Signature trees: entries with token bitmaps, joined by dual traversal.

A node holds the OR of the bitmaps below it, the range of the set sizes, and the most
tokens that share bits with others. Two nodes are followed only while some pair below
them could still overlap enough: shared tokens cannot outnumber the shared bits plus
the tokens that share bits on one side. Nodes whose entries all belong to one and the
same component are left alone, as no link between them could change anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

FAN_OUT = 8


#: Bits for each token of a wide bitmap.
WIDE = 4


def bitmap(tokens: np.ndarray, each: int = 1) -> bytes:
    """One bit for each token at its hash modulo a power of two of about ``each`` times the
    set's size."""
    width = width_of(len(tokens) * each)
    bits = np.zeros(width, bool)
    bits[(tokens % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def width_of(size: int) -> int:
    return max(64, 1 << max(0, size - 1).bit_length())


def folded(bits: int, width: int, to: int) -> int:
    """The bitmap at a smaller width, which is the OR of its halves."""
    while width > to:
        width >>= 1
        bits = bits >> width | bits & (1 << width) - 1
    return bits


class Entry(NamedTuple):
    name: int
    component: int
    size: int
    bits: int
    #: of the bitmap; 0: that of one bit for each token
    width: int = 0


class Node(NamedTuple):
    bits: int
    width: int
    low: int
    high: int
    clashes: int
    component: int | None
    children: list | None
    entry: Entry | None


def leaf(entry: Entry) -> Node:
    return Node(entry.bits, entry.width or width_of(entry.size), entry.size, entry.size,
                entry.size - entry.bits.bit_count(), entry.component, None, entry)


def parent(children: list[Node]) -> Node:
    width = min(c.width for c in children)
    bits = clashes = 0
    for child in children:
        own = folded(child.bits, child.width, width)
        bits |= own
        if child.width == width:
            most = child.clashes
        else:
            most = child.high - (own.bit_count() if child.entry is not None else 0)
        clashes = max(clashes, most)
    components = {c.component for c in children}
    return Node(bits, width, min(c.low for c in children), max(c.high for c in children), clashes,
                components.pop() if len(components) == 1 else None, children, None)


def build(entries: list[Entry]) -> Node:
    """Levels of up to ``FAN_OUT`` nodes over the entries in order of component, size and
    bitmap."""
    level = [leaf(e) for e in sorted(entries, key=lambda e: (e.component, e.size, e.bits))]
    while len(level) > 1:
        level = [parent(level[i:i + FAN_OUT]) for i in range(0, len(level), FAN_OUT)]
    return level[0]


def could_link(one: Node, two: Node, percent: int) -> bool:
    if one.component is not None and one.component == two.component:
        return False
    if 100 * one.high < percent * two.low or 100 * two.high < percent * one.low:
        return False
    if one.width > two.width:
        one, two = two, one
    shared = (one.bits & folded(two.bits, two.width, one.width)).bit_count()
    clashes = min(one.clashes, two.clashes) if one.width == two.width else one.clashes
    most = min(shared + clashes, one.high, two.high)
    return (100 + percent) * most >= percent * (one.low + two.low)


def reached(left: Node, right: Node | None, sizes: dict[int, int], percent: int
            ) -> Iterator[tuple[int, int]]:
    """(entry, component) for each entry of one tree, or of two, and each other component
    of which the bounds leave some entry. Of two components the smaller one's entries
    are given (by ``sizes``, then by name). The first entry found settles a component
    for the entry it is compared with, so a large component is not listed entry by
    entry."""
    rank = lambda component: (sizes[component], component)
    waiting, known = [(left, left if right is None else right)], set()
    while waiting:
        one, two = waiting.pop()
        if one is two:
            if one.children and one.component is None:
                children = one.children
                for i, child in enumerate(children):
                    waiting.append((child, child))
                    waiting.extend((child, children[j]) for j in range(i + 1, len(children)))
            continue
        if one.entry is not None and two.component is not None and (
                (one.entry.name, two.component) in known) or two.entry is not None and (
                one.component is not None and (two.entry.name, one.component) in known):
            continue
        if not could_link(one, two, percent):
            continue
        if one.entry is not None and two.entry is not None:
            small, large = (one, two) if rank(one.component) < rank(two.component) else (two, one)
            if (small.entry.name, large.component) not in known:
                known.add((small.entry.name, large.component))
                yield small.entry.name, large.component
        elif two.children and (not one.children or two.high >= one.high):
            waiting.extend((one, child) for child in two.children)
        else:
            waiting.extend((child, two) for child in one.children)
