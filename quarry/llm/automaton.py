"""Regular expressions over bytes to one minimal deterministic automaton for all rules.

The grammar is the common subset: literals, escapes \\xHH and \\c, classes [...], groups (...), alternation |,
and the repeats ? * + {n} {n,} {n,m}.
"""

from __future__ import annotations

import numpy as np

ANY = frozenset(range(256))


class _Parser:
    """Recursive descent into a tree of ('set', bytes), ('cat', [..]), ('alt', [..]), ('rep', node, low, high)."""

    def __init__(self, pattern: str, fold: bool):
        self.p, self.i, self.fold = pattern, 0, fold

    def parse(self):
        node = self.alt()
        if self.i != len(self.p):
            raise ValueError(f"unexpected {self.p[self.i]!r} at {self.i} of {self.p!r}")
        return node

    def alt(self):
        options = [self.cat()]
        while self.i < len(self.p) and self.p[self.i] == "|":
            self.i += 1
            options.append(self.cat())
        return options[0] if len(options) == 1 else ("alt", options)

    def cat(self):
        parts = []
        while self.i < len(self.p) and self.p[self.i] not in "|)":
            parts.append(self.repeat())
        return ("cat", parts)

    def repeat(self):
        node = self.atom()
        while self.i < len(self.p) and self.p[self.i] in "?*+{":
            c = self.p[self.i]
            self.i += 1
            if c == "{":
                body, _, rest = self.p[self.i :].partition("}")
                self.i = len(self.p) - len(rest)
                low, comma, high = body.partition(",")
                node = ("rep", node, int(low), int(high) if high else None if comma else int(low))
            else:
                node = ("rep", node, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[c])
        return node

    def char(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c != "\\":
            return ord(c)
        c = self.p[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return {"t": 9, "n": 10, "r": 13}.get(c, ord(c))

    def cased(self, found: set[int]) -> frozenset[int]:
        if self.fold:
            found |= {b ^ 32 for b in found if 65 <= b & ~32 <= 90}
        return frozenset(found)

    def atom(self):
        c = self.p[self.i]
        if c == "(":
            self.i += 1
            if self.p.startswith("?:", self.i):
                self.i += 2
            node = self.alt()
            self.i += 1
            return node
        if c == ".":
            self.i += 1
            return ("set", ANY - {10})
        if c == "[":
            self.i += 1
            negated = self.p[self.i] == "^"
            self.i += negated
            found: set[int] = set()
            while self.p[self.i] != "]":
                low = high = self.char()
                if self.p[self.i] == "-" and self.p[self.i + 1] != "]":
                    self.i += 1
                    high = self.char()
                found |= set(range(low, high + 1))
            self.i += 1
            return ("set", ANY - self.cased(found) if negated else self.cased(found))
        return ("set", self.cased({self.char()}))


def parse(pattern: str, fold: bool = False):
    return _Parser(pattern, fold).parse()


def fold_part(pattern_folded: str, rest: str):
    """A tree whose first part takes letters in either case, and whose rest does not."""
    return ("cat", [parse(pattern_folded, True), parse(rest)])


def reverse(node):
    kind = node[0]
    if kind == "cat":
        return ("cat", [reverse(x) for x in reversed(node[1])])
    if kind == "alt":
        return ("alt", [reverse(x) for x in node[1]])
    if kind == "rep":
        return ("rep", reverse(node[1]), *node[2:])
    return node


class _Nfa:
    """Thompson's construction: edges on byte sets and empty edges."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.edges: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.empty) - 1

    def add(self, node, a: int) -> int:
        """Builds `node` from state a; returns its end."""
        kind = node[0]
        if kind == "set":
            b = self.state()
            self.edges[a].append((node[1], b))
            return b
        if kind == "cat":
            for x in node[1]:
                a = self.add(x, a)
            return a
        if kind == "alt":
            end = self.state()
            for x in node[1]:
                s = self.state()
                self.empty[a].append(s)
                self.empty[self.add(x, s)].append(end)
            return end
        _, x, low, high = node
        for _ in range(low):
            a = self.add(x, a)
        if high is None:
            loop, end = self.state(), self.state()
            self.empty[a].append(loop)
            self.empty[self.add(x, loop)].append(loop)
            self.empty[loop].append(end)
            return end
        end = self.state()
        for _ in range(high - low):
            self.empty[a].append(end)
            a = self.add(x, a)
        self.empty[a].append(end)
        return end


class Automaton:
    """next[state, byte] and accepts[state] (bit k: rule k ends here), minimal; state 0 is the start.

    With `anywhere`, a match may begin at any byte; else it must begin at the first.
    """

    def __init__(self, trees: list, anywhere: bool = True):
        nfa = _Nfa()
        root = nfa.state()
        ends = {}
        for k, tree in enumerate(trees):
            s = nfa.state()
            nfa.empty[root].append(s)
            ends[nfa.add(tree, s)] = k
        if anywhere:
            nfa.edges[root].append((ANY, root))
        table, accepts = self._subsets(nfa, root, ends)
        self.next, self.accepts = self._minimal(table, accepts)

    @staticmethod
    def _subsets(nfa: _Nfa, root: int, ends: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        closures: dict[int, frozenset[int]] = {}

        def closure(s: int) -> frozenset[int]:
            if s not in closures:
                found, todo = {s}, [s]
                while todo:
                    for t in nfa.empty[todo.pop()]:
                        if t not in found:
                            found.add(t)
                            todo.append(t)
                closures[s] = frozenset(x for x in found if nfa.edges[x] or x in ends)
            return closures[s]

        signature = [tuple(k for k, (s, _) in enumerate(sorted_edges) if b in s) for sorted_edges in [[e for es in nfa.edges for e in es]] for b in range(256)]
        classes = {sig: k for k, sig in enumerate(dict.fromkeys(signature))}
        byte_class = np.array([classes[s] for s in signature])
        sample = [int(np.flatnonzero(byte_class == k)[0]) for k in range(len(classes))]
        first = closure(root)
        names, rows, accepts, at = {first: 0}, [], [], 0
        order = [first]
        while at < len(order):
            here = order[at]
            at += 1
            accepts.append(sum({1 << ends[s] for s in here if s in ends}))
            moves = [(s, t) for x in here for s, t in nfa.edges[x]]
            row = []
            for b in sample:
                there = frozenset().union(*(closure(t) for s, t in moves if b in s))
                if there not in names:
                    names[there] = len(order)
                    order.append(there)
                row.append(names[there])
            rows.append(row)
        return np.array(rows, np.int64)[:, byte_class], np.array(accepts, np.int64)

    @staticmethod
    def _minimal(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Moore's refinement: states stay together while their successors do."""
        _, group = np.unique(accepts, return_inverse=True)
        columns = np.unique(table, axis=1)
        while True:
            _, finer = np.unique(np.c_[group, group[columns]], axis=0, return_inverse=True)
            finer = finer.reshape(-1)
            if finer.max() == group.max():
                break
            group = finer
        order = np.full(group.max() + 1, -1)
        order[group[0]] = 0
        k = 1
        for g in group:
            if order[g] < 0:
                order[g], k = k, k + 1
        name = order[group]
        first = np.array([np.flatnonzero(name == s)[0] for s in range(k)])
        return name[table[first]].astype(np.int32), accepts[first]
