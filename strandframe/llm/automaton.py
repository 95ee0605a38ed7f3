"""Rules as one deterministic automaton over bytes.

Regular expressions (literals, escapes, classes, groups, ``|``, ``? * + {m,n}``, ``(?i:...)``)
become a nondeterministic automaton, the subset construction a deterministic one, and partition
refinement the smallest one, held in transition arrays over classes of bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .text import Texts

PIECE = 256


def _char(src: str, i: int) -> tuple[int, int]:
    if src[i] != "\\":
        return ord(src[i]), i + 1
    if src[i + 1] == "x":
        return int(src[i + 2 : i + 4], 16), i + 4
    return {"n": 10, "r": 13, "t": 9}.get(src[i + 1], ord(src[i + 1])), i + 2


def _set(src: str, i: int) -> tuple[frozenset, int]:
    negated = src[i] == "^"
    i += negated
    out: set[int] = set()
    while src[i] != "]":
        a, i = _char(src, i)
        b = a
        if src[i] == "-" and src[i + 1] != "]":
            b, i = _char(src, i + 1)
        out |= set(range(a, b + 1))
    return frozenset(set(range(256)) - out if negated else out), i + 1


def _either_case(chars: frozenset) -> frozenset:
    return frozenset({ord(f(chr(c))) for c in chars for f in (str.lower, str.upper) if c < 128} | {c for c in chars if c >= 128})


def parse(src: str):
    """Tree of ``("set", bytes)``, ``("cat", parts)``, ``("alt", parts)`` and ``("rep", part, least, most)``."""

    def alternatives(i: int, fold: bool):
        branches, parts = [], []
        while i < len(src) and src[i] != ")":
            if src[i] == "|":
                branches.append(("cat", parts))
                parts, i = [], i + 1
                continue
            if src[i] == "(":
                i, inner = i + 1, fold
                if src.startswith("?i:", i):
                    i, inner = i + 3, True
                elif src.startswith("?:", i):
                    i += 2
                part, i = alternatives(i, inner)
                i += 1
            else:
                if src[i] == "[":
                    chars, i = _set(src, i + 1)
                else:
                    c, i = _char(src, i)
                    chars = frozenset([c])
                part = ("set", _either_case(chars) if fold else chars)
            if i < len(src) and src[i] in "?*+":
                part = ("rep", part, int(src[i] == "+"), 1 if src[i] == "?" else None)
                i += 1
            elif i < len(src) and src[i] == "{":
                close = src.index("}", i)
                least, _, most = src[i + 1 : close].partition(",")
                part = ("rep", part, int(least), int(most) if most else None if "," in src[i:close] else int(least))
                i = close + 1
            parts.append(part)
        branches.append(("cat", parts))
        return ("alt", branches), i

    return alternatives(0, False)[0]


def backwards(tree):
    """The tree of the reversed language."""
    if tree[0] == "cat":
        return "cat", [backwards(x) for x in reversed(tree[1])]
    if tree[0] == "alt":
        return "alt", [backwards(x) for x in tree[1]]
    return ("rep", backwards(tree[1]), *tree[2:]) if tree[0] == "rep" else tree


class _Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.on: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.on.append(None)
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        if tree[0] == "set":
            end = self.state()
            self.on[start] = (tree[1], end)
            return end
        if tree[0] == "cat":
            for part in tree[1]:
                entry = self.state()
                self.free[start].append(entry)
                start = self.add(part, entry)
            return start
        if tree[0] == "alt":
            end = self.state()
            for part in tree[1]:
                entry = self.state()
                self.free[start].append(entry)
                self.free[self.add(part, entry)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            entry = self.state()
            self.free[start].append(entry)
            start = self.add(part, entry)
        end = self.state()
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            inner = self.state()
            self.free[loop] += [inner, end]
            self.free[self.add(part, inner)].append(loop)
            return end
        for _ in range(most - least):
            entry = self.state()
            self.free[start] += [entry, end]
            start = self.add(part, entry)
        self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


@dataclass
class Dfa:
    """``move[state, class_of[byte]]``; ``accepts[state]`` has bit r set where rule r ends; state 0 begins."""

    class_of: np.ndarray
    move: np.ndarray
    accepts: np.ndarray

    @classmethod
    def build(cls, trees: list, search: bool) -> Dfa:
        """``search``: a match may begin at any byte; else only at the first."""
        nfa = _Nfa()
        start, final = nfa.state(), {}
        for rule, tree in enumerate(trees):
            entry = nfa.state()
            nfa.free[start].append(entry)
            final[nfa.add(tree, entry)] = rule
        sets = sorted({x[0] for x in nfa.on if x}, key=sorted)
        kinds: dict[tuple, int] = {}
        class_of = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)], np.uint8)
        sample = [int(np.flatnonzero(class_of == k)[0]) for k in range(len(kinds))]
        first = nfa.closure([start])
        number, queue, rows = {first: 0}, [first], []
        for here in queue:
            row = []
            for byte in sample:
                to = {nfa.on[s][1] for s in here if nfa.on[s] and byte in nfa.on[s][0]}
                target = nfa.closure(to | ({start} if search else set()))
                if target not in number:
                    number[target] = len(queue)
                    queue.append(target)
                row.append(number[target])
            rows.append(row)
        move = np.array(rows, np.int64)
        accepts = np.array([sum({1 << final[s] for s in here if s in final}) for here in queue], np.int64)
        return cls(class_of, move, accepts).smallest()

    def smallest(self) -> Dfa:
        """Merge states that no continuation tells apart; accepting states get the highest numbers."""
        _, group = np.unique(self.accepts, return_inverse=True)
        while True:
            key = np.column_stack([group, group[self.move]])
            _, first, new = np.unique(key, axis=0, return_index=True, return_inverse=True)
            new = new.reshape(-1)
            if new.max() == group.max():
                break
            group = new
        order = sorted(range(len(first)), key=lambda g: (self.accepts[first[g]] != 0, new[0] != g, g))
        rank = np.empty(len(first), np.int64)
        rank[order] = np.arange(len(first))
        keep = first[order]
        return Dfa(self.class_of, rank[new[self.move[keep]]], self.accepts[keep])

    def prepare(self) -> None:
        """Arrays for ``scan``: flat moves, first accepting state, bytes after which the state is known."""
        self.width = self.move.shape[1]
        self.flat = (self.move * self.width).astype(np.int32).reshape(-1)
        at = np.flatnonzero(self.accepts)
        self.first_accept = int(at[0]) * self.width if len(at) else 1 << 30
        known = (self.move == self.move[:1]).all(0)
        self.resets = known[self.class_of]

    def scan(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """One pass over all bytes: positions just behind which some rule ends, and the rules' bits.

        Texts are cut behind bytes that lead every state to the same one, and all pieces advance
        together, one byte a step, so the pass is one array operation per step.
        """
        data = texts.data
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places = np.flatnonzero(self.resets[data]) + 1
        grid = np.arange(PIECE, len(data), PIECE)
        at = np.searchsorted(places, grid)
        cuts = places[np.unique(at[at < len(places)])]
        edges = np.unique(np.concatenate([texts.offsets, cuts]))
        starts, lengths = edges[:-1], np.diff(edges)
        starts, lengths = starts[lengths > 0], lengths[lengths > 0]
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        kinds = self.class_of[data].astype(np.int32)
        state = np.zeros(len(starts), np.int32)
        inner = ~np.isin(starts, texts.offsets)
        state[inner] = self.flat[kinds[starts[inner] - 1]]
        live = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right")
        found_at, found = [], []
        for t in range(int(lengths[0])):
            k = live[t]
            now = state[:k]
            now += kinds[starts[:k] + t]
            now = state[:k] = self.flat[now]
            if now.max() >= self.first_accept:
                hit = np.flatnonzero(now >= self.first_accept)
                found_at.append(starts[hit] + (t + 1))
                found.append(self.accepts[now[hit] // self.width])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found_at, found = np.concatenate(found_at), np.concatenate(found)
        order = np.argsort(found_at)
        return found_at[order], found[order]

    def longest(self, data: np.ndarray, start: int, stop: int, rule: int, step: int = 1) -> int:
        """Anchored run from ``start`` towards ``stop``: the last place where ``rule`` ends, or -1."""
        state, out = 0, -1
        dead = self.dead
        for p in range(start, stop, step):
            state = self.move[state, self.class_of[data[p if step > 0 else p - 1]]]
            if self.accepts[state] >> rule & 1:
                out = p + step
            if state == dead:
                break
        return out

    @property
    def dead(self) -> int:
        """The state that leads only to itself and accepts nothing, or -1."""
        stays = np.flatnonzero((self.move == np.arange(len(self.move))[:, None]).all(1) & (self.accepts == 0))
        return int(stays[0]) if len(stays) else -1
