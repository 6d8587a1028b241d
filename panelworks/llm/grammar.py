"""A small generalised LR parser over role symbols.

The tables come from the productions by the usual item sets.  Reductions are taken without
looking ahead, and every stack that can still shift or accept is kept: stacks are nodes linked
to their parents and shared, so equal stacks are one node.  The grammar of conversations is left
recursive; its stacks have a bounded depth, and the nodes are few and can be numbered.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

Production = tuple[str, tuple[str, ...]]

# An optional system turn, then pairs of a user's and an assistant's turn; or nothing at all.
CONVERSATION: tuple[Production, ...] = (
    ("whole", ("dialogue",)),
    ("dialogue", ()),
    ("dialogue", ("turns",)),
    ("turns", ("s", "pairs")),
    ("turns", ("pairs",)),
    ("pairs", ("pair",)),
    ("pairs", ("pairs", "pair")),
    ("pair", ("u", "a")),
)


@dataclass(frozen=True)
class Stack:
    """A node of the graph of stacks: an item set on top of a parent."""

    top: frozenset
    parent: Stack | None = None

    def popped(self, count: int) -> Stack:
        return self if count == 0 else self.parent.popped(count - 1)


class Automaton:
    """Numbered stacks of a grammar: which exist, where symbols lead, and which accept."""

    def __init__(self, productions: tuple[Production, ...] = CONVERSATION):
        self.productions = productions
        self.rules = {left for left, _ in productions}

    def _closure(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            right = self.productions[rule][1]
            if dot < len(right):
                for k, (left, _) in enumerate(self.productions):
                    if left == right[dot] and (k, 0) not in items:
                        items.add((k, 0))
                        todo.append((k, 0))
        return frozenset(items)

    def _goto(self, items: frozenset, symbol: str) -> frozenset | None:
        moved = {
            (rule, dot + 1)
            for rule, dot in items
            if self.productions[rule][1][dot : dot + 1] == (symbol,)
        }
        return self._closure(moved) if moved else None

    def _accepts(self, stack: Stack) -> bool:
        return (0, len(self.productions[0][1])) in stack.top

    def _reduced(self, stack: Stack) -> list[Stack]:
        """The stack and all that reductions make of it."""
        out, todo = {stack: None}, [stack]
        while todo:
            at = todo.pop()
            for rule, dot in at.top:
                left, right = self.productions[rule]
                if rule and dot == len(right):
                    below = at.popped(len(right))
                    nxt = self._goto(below.top, left)
                    new = Stack(nxt, below) if nxt else None
                    if new and new not in out:
                        out[new] = None
                        todo.append(new)
        return list(out)

    @cached_property
    def symbols(self) -> list[str]:
        return sorted({x for _, right in self.productions for x in right} - self.rules)

    @cached_property
    def _tables(self) -> tuple[list[dict[str, int]], list[bool]]:
        # a number stands for a stack that can shift, together with what reductions make of it
        start = Stack(self._closure({(0, 0)}))
        groups, moves, accepting = {}, [], []
        todo = []

        def number(stacks: list[Stack]) -> int:
            live = frozenset(
                x
                for s in stacks
                for x in self._reduced(s)
                if self._accepts(x) or any(self._goto(x.top, t) for t in self.symbols)
            )
            if live not in groups:
                groups[live] = len(groups)
                todo.append(live)
            return groups[live]

        number([start])
        while todo:
            live = todo.pop(0)
            onward = {}
            for symbol in self.symbols:
                shifted = [
                    Stack(nxt, x) for x in live if (nxt := self._goto(x.top, symbol)) is not None
                ]
                if shifted:
                    onward[symbol] = number(shifted)
            moves.append(onward)
            accepting.append(any(map(self._accepts, live)))
        return moves, accepting

    @property
    def moves(self) -> list[dict[str, int]]:
        """Per number, the number each symbol leads to; 0 is the empty stack."""
        return self._tables[0]

    @property
    def accepting(self) -> list[bool]:
        return self._tables[1]
