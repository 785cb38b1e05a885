"""Regular expressions to one minimal deterministic automaton over bytes.

Syntax: literals, escapes (\\xHH and punctuation), classes, groups, (?i:...), |, ?, *, +, {m}, {m,}, {m,n}.
All characters are ASCII.  Rules are compiled together by subset construction, states are merged by
partition refinement, and transitions are one flat array indexed by state * classes + class of byte.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Parser:
    """Recursive descent to nested tuples: ("set", bytes), ("cat", parts), ("alt", parts), ("rep", part, low, high)."""

    def __init__(self, text: str):
        self.text, self.at, self.fold = text, 0, False

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def parse(self):
        out = self.alternatives()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.peek()!r} at {self.at} in {self.text!r}")
        return out

    def alternatives(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        part = self.atom()
        while self.peek() and self.peek() in "?*+{":
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(mark := self.take(), (0, 0))
            if mark == "{":
                body = self.text[self.at : self.text.index("}", self.at)]
                self.at += len(body) + 1
                first, comma, last = body.partition(",")
                low, high = int(first), int(last) if last else None if comma else int(first)
            part = ("rep", part, low, high)
        return part

    def escaped(self) -> int:
        mark = self.take()
        if mark == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(mark)

    def cased(self, members: set[int]) -> tuple:
        if self.fold:
            members = members | {ord(chr(b).swapcase()) for b in members if chr(b).isalpha()}
        return ("set", frozenset(members))

    def atom(self):
        mark = self.take()
        if mark == "(":
            before = self.fold
            if self.text.startswith("?", self.at):
                flags, _, _ = self.text[self.at + 1 :].partition(":")
                self.fold = self.fold or flags == "i"
                self.at += len(flags) + 2
            part = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self.fold = before
            return part
        if mark == "[":
            return self.cased(self.members())
        return self.cased({self.escaped() if mark == "\\" else ord(mark)})

    def members(self) -> set[int]:
        out: set[int] = set()
        negated = self.peek() == "^"
        self.at += negated
        while (mark := self.take()) != "]":
            low = self.escaped() if mark == "\\" else ord(mark)
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.escaped() if (mark := self.take()) == "\\" else ord(mark)
            out |= set(range(low, high + 1))
        return set(range(256)) - out if negated else out


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.on: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.on.append(None)
        return len(self.on) - 1

    def build(self, tree, start: int, backward: bool) -> int:
        """Adds the tree after `start`; its last state."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            mid = self.state()
            self.empty[start].append(mid)
            self.on[mid] = (tree[1], end)
            return end
        if kind == "cat":
            for part in reversed(tree[1]) if backward else tree[1]:
                start = self.build(part, start, backward)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                own = self.state()
                self.empty[start].append(own)
                self.empty[self.build(part, own, backward)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.build(part, start, backward)
        if high is None:
            loop, end = self.state(), self.state()
            self.empty[start] += [loop]
            self.empty[self.build(part, loop, backward)] += [loop]
            self.empty[loop] += [end]
            return end
        end = self.state()
        self.empty[start].append(end)
        for _ in range(high - low):
            start = self.build(part, start, backward)
            self.empty[start].append(end)
        return end

    def closures(self) -> list[int]:
        """For every state, those that it reaches without a byte, itself included, as a bit set."""
        out = []
        for start in range(len(self.on)):
            seen, todo = {start}, [start]
            while todo:
                for x in self.empty[todo.pop()]:
                    if x not in seen:
                        seen.add(x)
                        todo.append(x)
            out.append(sum(1 << x for x in seen))
        return out


def _members(bits: int):
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


@dataclass
class Automaton:
    """`classes`: byte to class.  `table`: state * n_classes + class to next state * n_classes.  States that
    accept come last, from `accepts_from` on (times n_classes); `rules` has each state's bit mask of rules.
    State 0 starts; `dead` is the state that nothing leaves, or -1."""

    classes: np.ndarray
    table: np.ndarray
    rules: np.ndarray
    accepts_from: int
    dead: int
    n_classes: int

    def __post_init__(self):
        # the same as plain lists, for walks byte by byte
        self.plain = self.table.tolist(), self.classes.tolist(), self.accepts_from, self.dead

    @property
    def resets(self) -> np.ndarray:
        """Bytes after which a search is at its start, whatever came before."""
        grid = self.table.reshape(-1, self.n_classes)
        return (grid == 0).all(axis=0)[self.classes]


def compile_rules(patterns: list[str], search: bool = True, backward: bool = False) -> Automaton:
    """One automaton for all patterns: `search` lets matches begin anywhere, `backward` reads right to left."""
    nfa = _Nfa()
    root, accept = nfa.state(), {}
    if search:
        nfa.on[root] = (frozenset(range(256)), root)
    for bit, pattern in enumerate(patterns):
        own = nfa.state()
        nfa.empty[root].append(own)
        accept[nfa.build(_Parser(pattern).parse(), own, backward)] = 1 << bit
    # bytes that no transition tells apart form one class
    sets = {x[0] for x in nfa.on if x}
    keys: dict[tuple, int] = {}
    classes = np.array([keys.setdefault(tuple(b in s for s in sets), len(keys)) for b in range(256)], np.int64)
    sample = [int(np.flatnonzero(classes == k)[0]) for k in range(len(keys))]
    # sets of states are bit sets; `into` has what a state reaches on each class, closed
    closed = nfa.closures()
    into = [[closed[x[1]] if x and b in x[0] else 0 for b in sample] for x in nfa.on]
    start = closed[root]
    states, table, todo = {start: 0}, [], [start]
    for current in todo:
        row = [0] * len(sample)
        for x in _members(current):
            if nfa.on[x]:
                row = [a | b for a, b in zip(row, into[x], strict=True)]
        for reached in row:
            if reached not in states:
                states[reached] = len(states)
                todo.append(reached)
        table.append([states[x] for x in row])
    rules = [sum(mask for x, mask in accept.items() if s >> x & 1) for s in states]
    return _minimised(np.array(table), np.array(rules, np.int64), classes)


def _minimised(table: np.ndarray, rules: np.ndarray, classes: np.ndarray) -> Automaton:
    """Merges states of equal rules and equal successors until nothing splits; orders accepting states last."""
    block = np.unique(rules, return_inverse=True)[1].reshape(-1)
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    first = np.array([np.flatnonzero(finer == k)[0] for k in range(finer.max() + 1)])
    order = sorted(range(len(first)), key=lambda k: (rules[first[k]] != 0, k != finer[0], k))
    place = np.empty(len(first), np.int64)
    place[order] = np.arange(len(first))
    grid = place[finer[table[first[order]]]]
    own = rules[first[order]]
    n = table.shape[1]
    alone = np.flatnonzero((grid == np.arange(len(grid))[:, None]).all(axis=1) & (own == 0))
    return Automaton(classes, (grid * n).reshape(-1).astype(np.int64), own, int((own == 0).sum()) * n, int(alone[0]) * n if len(alone) else -1, n)
