"""Byte automata: regular expressions to minimal deterministic automata held in transition arrays.

The pattern language: literals, ``\\xNN`` and ``\\`` escapes, ``.``, classes ``[a-z]`` and ``[^...]``, groups, ``|``,
``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}``; all over bytes, with ASCII letters in either case on request.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_DOT = frozenset(range(256)) - {10}


class _Parser:
    """A pattern as a tree: ("set", bytes), ("cat", parts), ("alt", parts), ("rep", part, least, most or None)."""

    def __init__(self, pattern: str, any_case: bool) -> None:
        self.text, self.at, self.any_case = pattern, 0, any_case

    def parse(self):
        tree = self._alt()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} in {self.text!r}")
        return tree

    def _peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def _take(self) -> str:
        if not (c := self._peek()):
            raise ValueError(f"{self.text!r} ends too early")
        self.at += 1
        return c

    def _alt(self):
        parts = [self._cat()]
        while self._peek() == "|":
            self.at += 1
            parts.append(self._cat())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def _cat(self):
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeat())
        return ("cat", parts)

    def _repeat(self):
        part = self._atom()
        while (c := self._peek()) and c in "?*+{":
            self.at += 1
            if c == "{":
                end = self.text.index("}", self.at)
                least, comma, most = self.text[self.at:end].partition(",")
                self.at = end + 1
                part = ("rep", part, int(least), int(most) if most else None if comma else int(least))
            else:
                part = ("rep", part, int(c == "+"), 1 if c == "?" else None)
        return part

    def _atom(self):
        c = self._take()
        if c == "(":
            tree = self._alt()
            if self._take() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            return tree
        if c == "[":
            return ("set", self._class())
        if c == ".":
            return ("set", _DOT)
        return ("set", self._cased({self._escape() if c == "\\" else ord(c)}))

    def _escape(self) -> int:
        c = self._take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return {"n": 10, "r": 13, "t": 9}.get(c, ord(c))

    def _class(self) -> frozenset:
        negated = self._peek() == "^"
        self.at += negated
        found: set[int] = set()
        while (c := self._take()) != "]":
            low = self._escape() if c == "\\" else ord(c)
            if self._peek() == "-" and self.text[self.at + 1:self.at + 2] != "]":
                self.at += 1
                c = self._take()
                found |= set(range(low, (self._escape() if c == "\\" else ord(c)) + 1))
            else:
                found.add(low)
        found = self._cased(found)
        return frozenset(range(256)) - found if negated else frozenset(found)

    def _cased(self, found) -> frozenset:
        letters = {b for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(found) | ({b ^ 32 for b in letters} if self.any_case else set())


def parse(pattern: str, any_case: bool = False):
    return _Parser(pattern, any_case).parse()


def backwards(tree):
    """The tree of the reversed language."""
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", backwards(tree[1]), *tree[2:])
    parts = [backwards(x) for x in tree[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


class _Nfa:
    """Thompson's construction; state k has edges[k] (byte set, target) and empty moves[k]."""

    def __init__(self) -> None:
        self.edges: list[list] = []
        self.moves: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.moves.append([])
        return len(self.edges) - 1

    def add(self, tree, start: int) -> int:
        """The tree's end state, from ``start`` on."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.edges[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                first = self.state()
                self.moves[start].append(first)
                self.moves[self.add(part, first)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop, end = self.state(), self.state()
            self.moves[start].append(loop)
            self.moves[self.add(part, loop)].append(loop)
            self.moves[loop].append(end)
            return end
        end = self.state()
        self.moves[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start)
            self.moves[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for x in self.moves[todo.pop()]:
                if x not in found:
                    found.add(x)
                    todo.append(x)
        return frozenset(found)


@dataclass
class Automaton:
    """``step[state * 256 + byte]`` is the next state times 256; ``rules[state]`` the bits of the rules ending there.

    State 0 is dead; ``start`` is the first state and ``accepting`` the first of those where a rule ends, which are
    numbered last (both times 256).
    """

    step: np.ndarray
    rules: np.ndarray
    start: int
    accepting: int


def compile_tree(tree) -> Automaton:
    """The minimal automaton of one tree, matching from the first byte on."""
    nfa = _Nfa()
    start = nfa.state()
    return _minimal(*_subsets(nfa, start, {nfa.add(tree, start): 1}))


def combine_first_ends(automata: list[Automaton]) -> Automaton:
    """The minimal automaton that reports, for matches starting at any byte, every rule's first end after its start."""
    nfa = _Nfa()
    start = nfa.state()
    nfa.edges[start].append((frozenset(range(256)), start))
    ends = {}
    for rule, own in enumerate(automata):
        states = [nfa.state() for _ in own.rules]
        nfa.moves[start].append(states[own.start >> 8])
        step = own.step.reshape(-1, 256) >> 8
        for state, ended in enumerate(own.rules):
            if ended:
                ends[states[state]] = 1 << rule  # no way on: a longer match has the same start
                continue
            for target in np.unique(step[state]):
                if target:
                    nfa.edges[states[state]].append((frozenset(np.flatnonzero(step[state] == target).tolist()),
                                                     states[target]))
    return _minimal(*_subsets(nfa, start, ends))


def _subsets(nfa: _Nfa, start: int, ends: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Subset construction; state 0 is the empty set, 1 the start."""
    first = nfa.closure([start])
    number, order, rows = {frozenset(): 0, first: 1}, [frozenset(), first], []
    for states in order:  # grows as it goes
        targets: list[set[int]] = [set() for _ in range(256)]
        for x in states:
            for accepted, end in nfa.edges[x]:
                for b in accepted:
                    targets[b].add(end)
        row, known = [], {}
        for found in map(frozenset, targets):
            if found not in known:
                whole = nfa.closure(found)
                if whole not in number:
                    number[whole] = len(order)
                    order.append(whole)
                known[found] = number[whole]
            row.append(known[found])
        rows.append(row)
    rules = [sum(ends.get(x, 0) for x in states) for states in order]
    return np.array(rows, np.int32), np.array(rules, np.int64)


def _minimal(step: np.ndarray, rules: np.ndarray) -> Automaton:
    """Moore's refinement: states of one block agree on their rules and, block by block, on all next states."""
    block = np.unique(rules, return_inverse=True)[1].reshape(-1)
    while True:
        signature = np.column_stack([block, block[step]])
        finer = np.unique(signature, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # the dead state's block first, blocks where a rule ends last
    first = np.unique(block, return_index=True)[1]
    rank = np.lexsort((first, rules[first] > 0, first > 0))
    new = np.argsort(rank)[block]
    out, ended = np.zeros((len(rank), 256), np.int32), np.zeros(len(rank), np.int64)
    out[new] = new[step] * 256
    ended[new] = rules
    return Automaton(out.reshape(-1), ended, int(new[1]) * 256, int((ended == 0).sum()) * 256)
