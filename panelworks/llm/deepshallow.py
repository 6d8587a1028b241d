"""Deep-shallow sorting of byte strings.

Multikey quicksort orders the strings by their first bytes, eight at a time.  Strings that still
agree at the shallow depth have long common prefixes, over which quicksort would go again and
again; they go into a blind trie instead, which looks at one byte per branch on the way down
and compares each string just once with one other.
"""

from __future__ import annotations

# Depth to which multikey quicksort goes, and the bytes of one of its symbols.
SHALLOW = 16
SYMBOL = 8
ENDED = -1


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix, of which ``known`` bytes are known to agree."""
    size = min(len(a), len(b))
    x = int.from_bytes(a[known:size]) ^ int.from_bytes(b[known:size])
    return size if x == 0 else size - (x.bit_length() + 7) // 8


class _Branch:
    """A node of a blind trie: where its strings first differ, and who goes where."""

    __slots__ = ("depth", "ways")

    def __init__(self, depth: int, ways: dict):
        self.depth, self.ways = depth, ways


def _byte(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def blind_trie(strings: list[bytes], members: list[int], known: int) -> list[int]:
    """``members`` in the order of their strings, which share a prefix of ``known`` bytes.

    Leaves are lists of members with equal strings.
    """
    root: _Branch | list[int] = [members[0]]
    for m in members[1:]:
        s = strings[m]
        at = root
        while isinstance(at, _Branch):  # blind: any way will do where none fits
            at = at.ways.get(_byte(s, at.depth)) or next(iter(at.ways.values()))
        other = strings[at[0]]
        depth = common_prefix(s, other, known)
        if depth == len(s) == len(other):
            at.append(m)
            continue
        above, at = None, root
        while isinstance(at, _Branch) and at.depth < depth:
            above, at = at, at.ways[_byte(s, at.depth)]
        if isinstance(at, _Branch) and at.depth == depth:
            at.ways[_byte(s, depth)] = [m]
            continue
        branch = _Branch(depth, {_byte(other, depth): at, _byte(s, depth): [m]})
        if above is None:
            root = branch
        else:
            above.ways[_byte(s, above.depth)] = branch
    out, todo = [], [root]
    while todo:
        at = todo.pop()
        if isinstance(at, _Branch):
            todo += [at.ways[b] for b in sorted(at.ways, reverse=True)]
        else:
            out += at
    return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """The numbers of the strings in the order of the strings."""
    out: list[int] = []
    todo = [(list(range(len(strings))), 0)]
    while todo:
        members, depth = todo.pop()
        if len(members) < 2 or depth == ENDED:
            out += members
        elif depth >= shallow:
            out += blind_trie(strings, members, depth)
        else:
            keys = [strings[m][depth : depth + SYMBOL] for m in members]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less, same, more = [], [], []
            for m, key in zip(members, keys, strict=True):
                (less if key < pivot else more if key > pivot else same).append(m)
            # strings that end inside of the symbol are equal and need no more sorting
            onward = depth + SYMBOL if len(pivot) == SYMBOL else ENDED
            todo += [(more, depth), (same, onward), (less, depth)]
    return out
