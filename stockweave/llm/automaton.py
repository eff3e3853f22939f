"""One deterministic automaton for many byte patterns.

Patterns are small regular expressions over bytes: literals, classes, groups, ``|``, ``?``, ``*``,
``+`` and ``{m,}``/``{m,n}``. All of them become one nondeterministic automaton; subset construction
makes it deterministic, partition refinement makes it minimal, and the result is one transition row
of 256 states per state.
"""

from __future__ import annotations

from stockweave.llm.common import by_value

by_value(__name__)

DIGITS = {"d": b"0123456789", "s": b" \t\n\r\x0b\x0c"}


class Pattern:
    """A pattern as a tree: ('set', bytes), ('cat', parts), ('alt', parts), ('rep', part, m, n)."""

    def __init__(self, text: str, fold: bool = False):
        self.text, self.at, self.fold = text, 0, fold
        self.tree = self.alternatives()
        if self.at != len(text):
            raise ValueError(f"unbalanced pattern {text!r}")

    def more(self, stop: str = "") -> bool:
        return self.at < len(self.text) and self.text[self.at] not in stop

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self):
        parts = [self.sequence()]
        while self.more() and self.text[self.at] == "|":
            self.at += 1
            parts.append(self.sequence())
        return ("alt", parts) if len(parts) > 1 else parts[0]

    def sequence(self):
        parts = []
        while self.more("|)"):
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, part):
        while self.more() and self.text[self.at] in "?*+{":
            sign = self.take()
            if sign == "{":
                end = self.text.index("}", self.at)
                low, _, high = self.text[self.at : end].partition(",")
                most = None if _ and not high else int(high or low)
                self.at = end + 1
                part = ("rep", part, int(low), most)
            else:
                part = ("rep", part, int(sign == "+"), 1 if sign == "?" else None)
        return part

    def atom(self):
        c = self.take()
        if c == "(":
            inner = self.alternatives()
            if not self.more() or self.take() != ")":
                raise ValueError(f"unbalanced pattern {self.text!r}")
            return inner
        if c == "[":
            return ("set", self.members())
        if c == "\\":
            return ("set", self.escaped())
        return ("set", self.cased(c.encode()))

    def escaped(self) -> frozenset:
        c = self.take()
        if c == "x":
            self.at += 2
            return frozenset([int(self.text[self.at - 2 : self.at], 16)])
        return frozenset(DIGITS.get(c) or c.encode())

    def cased(self, raw: bytes) -> frozenset:
        return frozenset(raw.lower() + raw.upper()) if self.fold else frozenset(raw)

    def members(self) -> frozenset:
        negated = self.text[self.at] == "^"
        self.at += negated
        found: set[int] = set()
        first = True
        while first or self.text[self.at] != "]":
            first = False
            c = self.take()
            low = self.escaped() if c == "\\" else frozenset(c.encode())
            if self.text[self.at] == "-" and self.text[self.at + 1] != "]" and len(low) == 1:
                self.at += 1
                c = self.take()
                high = self.escaped() if c == "\\" else frozenset(c.encode())
                low = frozenset(range(min(low), max(high) + 1))
            found |= low
        self.at += 1
        if self.fold:
            found |= {b for c in found for b in bytes([c]).lower() + bytes([c]).upper()}
        return frozenset(range(256)) - found if negated else frozenset(found)


class Graph:
    """Nondeterministic automaton: edges on byte sets and empty edges."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, tree, start: int, backwards: bool) -> int:
        """Add what ``tree`` matches from ``start``; the state reached."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.edges[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in reversed(tree[1]) if backwards else tree[1]:
                start = self.add(part, start, backwards)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                self.empty[self.add(part, start, backwards)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start, backwards)
        if most is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop, backwards)].append(loop)
            return loop
        end = self.state()
        self.empty[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start, backwards)
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def byte_classes(graph: Graph) -> list[list[int]]:
    """Bytes that every edge treats alike, together."""
    signature: dict[tuple, list[int]] = {}
    sets = list(dict.fromkeys(s for edges in graph.edges for s, _ in edges))
    for b in range(256):
        signature.setdefault(tuple(b in s for s in sets), []).append(b)
    return list(signature.values())


def subset_construction(graph: Graph, start: int, ends: dict[int, int]):
    """Deterministic states: next state per byte class, accept mask (bit r: rule r ends here)."""
    classes = byte_classes(graph)
    first = graph.closure([start])
    number, order = {first: 0}, [first]
    moves: list[list[int]] = []
    for subset in order:
        row = []
        for members in classes:
            b = members[0]
            reached = graph.closure({t for s in subset for on, t in graph.edges[s] if b in on})
            if reached not in number:
                number[reached] = len(order)
                order.append(reached)
            row.append(number[reached])
        moves.append(row)
    masks = [sum({1 << ends[s] for s in subset if s in ends}) for subset in order]
    return classes, moves, masks, number.get(frozenset())


def minimised(moves: list[list[int]], masks: list[int]) -> list[int]:
    """Block of every state in the coarsest partition that tells all accept masks apart."""
    block = [sorted(set(masks)).index(m) for m in masks]
    while True:
        keys = [(block[s], *(block[t] for t in row)) for s, row in enumerate(moves)]
        number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        finer = [number[k] for k in keys]
        if len(number) == len(set(block)):
            return finer
        block = finer


class Automaton:
    """Minimal deterministic automaton: ``rows[state][byte]``, states from ``accepting`` on accept."""

    def __init__(self, patterns: list[Pattern], search: bool, backwards: bool = False):
        graph = Graph()
        start = graph.state()
        if search:
            graph.edges[start].append((frozenset(range(256)), start))
        ends = {}
        for rule, pattern in enumerate(patterns):
            begin = graph.state()
            graph.empty[start].append(begin)
            ends[graph.add(pattern.tree, begin, backwards)] = rule
        classes, moves, masks, dead = subset_construction(graph, start, ends)
        block = minimised(moves, masks)
        member = {b: s for s, b in reversed(list(enumerate(block)))}
        order = sorted(member, key=lambda b: (masks[member[b]] != 0, b))
        rank = {b: i for i, b in enumerate(order)}
        self.rows = []
        for b in order:
            row = [0] * 256
            for members, target in zip(classes, moves[member[b]]):
                for byte in members:
                    row[byte] = rank[block[target]]
            self.rows.append(tuple(row))
        self.masks = [masks[member[b]] for b in order]
        self.accepting = sum(m == 0 for m in self.masks)
        self.start = rank[block[0]]
        self.dead = rank[block[dead]] if dead is not None else -1

    def longest(self, data: bytes, positions) -> int:
        """How many of the bytes at ``positions`` the longest match takes; -1 without a match."""
        state, taken, best = self.start, 0, 0 if self.start >= self.accepting else -1
        rows, accepting, dead = self.rows, self.accepting, self.dead
        for i in positions:
            state = rows[state][data[i]]
            if state == dead:
                break
            taken += 1
            if state >= accepting:
                best = taken
        return best


class RuleScanner:
    """All rules in one pass over the bytes, then exact spans where the pass saw a rule end.

    The pass runs the combined automaton, which accepts wherever some rule's match ends. From the
    first end beyond a rule's last match, the rule's reversed automaton finds the leftmost start and
    its forward automaton the longest match from there: leftmost, longest, non-overlapping spans per
    rule. A rule's match that starts further left must not first accept later than one that starts
    inside it; words followed by a run, and plain runs, have that property.
    """

    def __init__(self, patterns: list[tuple[str, bool]]):
        parsed = [Pattern(text, fold) for text, fold in patterns]
        self.all = Automaton(parsed, search=True)
        self.forward = [Automaton([p], search=False) for p in parsed]
        self.backward = [Automaton([p], search=False, backwards=True) for p in parsed]

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(position after the byte, state) wherever the combined automaton accepts."""
        state, rows, accepting = self.all.start, self.all.rows, self.all.accepting
        found = []
        for at, byte in enumerate(data, 1):
            state = rows[state][byte]
            if state >= accepting:
                found.append((at, state))
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes."""
        found, last = [], [0] * len(self.forward)
        for end, state in self.ends(data):
            mask = self.all.masks[state]
            for rule, done in enumerate(last):
                if mask >> rule & 1 and end > done:
                    back = self.backward[rule].longest(data, range(end - 1, done - 1, -1))
                    if back > 0:
                        start = end - back
                        stop = start + self.forward[rule].longest(data, range(start, len(data)))
                        found.append((rule, start, stop))
                        last[rule] = stop
        return found
