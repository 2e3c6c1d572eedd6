"""Many regular expressions as one minimal deterministic automaton over bytes.

``compile_rules`` turns rule patterns into an NFA, determinises all of them
together by subset construction, and merges equivalent states. The result is a
transition array of 256 entries per state and, per state, the bits of the rules
that have matched up to here. One pass over the bytes finds every rule.

Patterns know literals, ``[...]`` classes, ``\\xNN``, groups, ``|``, ``?``,
``*``, ``+`` and ``{n,}``/``{n}``. A rule must end in a run: once it has matched,
the next byte either extends the match or ends it, so that the leftmost longest
matches of a rule are the maximal stretches of bytes after which it is matched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Pattern:
    """One pattern's NFA: byte edges ``edges[s] = [(mask, t)]``, empty edges, start and end."""

    def __init__(self, pattern: str, fold: bool) -> None:
        self.edges: list[list[tuple[int, int]]] = []
        self.empty: list[list[int]] = []
        self.fold = fold
        self.rest = list(pattern)
        self.start, self.end = self._choice()
        if self.rest:
            raise ValueError(f"unexpected {self.rest[0]!r} in {pattern!r}")

    def _state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def _choice(self) -> tuple[int, int]:
        start, end = self._state(), self._state()
        while True:
            a, b = self._sequence()
            self.empty[start].append(a)
            self.empty[b].append(end)
            if self.rest[:1] != ["|"]:
                return start, end
            self.rest.pop(0)

    def _sequence(self) -> tuple[int, int]:
        start = end = self._state()
        while self.rest and self.rest[0] not in "|)":
            atom = self._atom()
            low, high = self._repeat()
            for k in range(max(low, 1 if high else 0) if high else low):
                a, b = self._build(atom)
                self.empty[end].append(a)
                if k >= low:
                    self.empty[a].append(b)
                end = b
            if not high:
                a, b = self._build(atom)
                self.empty[end].append(a)
                self.empty[a].append(b)
                self.empty[b].append(a)
                end = b
        return start, end

    def _repeat(self) -> tuple[int, int | None]:
        sign = self.rest[0] if self.rest else ""
        if sign in ("?", "*", "+"):
            self.rest.pop(0)
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
        if sign == "{":
            close = self.rest.index("}")
            low, comma, _ = "".join(self.rest[1:close]).partition(",")
            del self.rest[: close + 1]
            return int(low), None if comma else int(low)
        return 1, 1

    def _atom(self) -> int | list[str]:
        """A mask of bytes, or the text of a group, which is built once per repetition."""
        sign = self.rest.pop(0)
        if sign == "(":
            depth, at = 1, 0
            in_class = False
            while depth:
                c = self.rest[at]
                in_class = (in_class or c == "[") and c != "]"
                depth += 0 if in_class else (c == "(") - (c == ")")
                at += 1
            group, self.rest = self.rest[: at - 1], self.rest[at:]
            return group
        if sign == "[":
            mask, last = 0, None
            while (c := self.rest.pop(0)) != "]":
                if c == "-" and last is not None and self.rest[0] != "]":
                    high = self._byte(self.rest.pop(0))
                    for byte in range(last, high + 1):
                        mask |= 1 << byte
                    last = None
                else:
                    last = self._byte(c)
                    mask |= 1 << last
            return self._folded(mask)
        return self._folded(1 << self._byte(sign))

    def _byte(self, c: str) -> int:
        if c != "\\":
            return ord(c)
        c = self.rest.pop(0)
        return int(self.rest.pop(0) + self.rest.pop(0), 16) if c == "x" else ord(c)

    def _folded(self, mask: int) -> int:
        if self.fold:
            for upper in range(0x41, 0x5B):
                if mask >> upper & 1 or mask >> (upper + 32) & 1:
                    mask |= 1 << upper | 1 << (upper + 32)
        return mask

    def _build(self, atom: int | list[str]) -> tuple[int, int]:
        if isinstance(atom, list):
            outer, self.rest = self.rest, list(atom)
            ends = self._choice()
            self.rest = outer
            return ends
        a, b = self._state(), self._state()
        self.edges[a].append((atom, b))
        return a, b

    def closure(self, states: set[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({t for s in states for mask, t in self.edges[s] if mask >> byte & 1})


def _minimal(table: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the states that no continuation tells apart; state 0 stays the start."""
    group = np.unique(marks, return_inverse=True)[1]
    while True:
        rows = np.column_stack([group, group[table]])
        finer = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    _, first = np.unique(group, return_index=True)
    order = np.argsort(first)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    group, first = rank[group], first[order]
    return group[table[first]], marks[first]


@dataclass(frozen=True)
class Automaton:
    """``table[state, byte]`` is the next state; bit r of ``matched[state]`` is rule r."""

    table: np.ndarray
    matched: np.ndarray
    resets: np.ndarray  # bytes that lead every state back to the start

    def match_ends(self, buf: np.ndarray, lane: int = 2048) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per rule: where its matched stretches begin (the first byte after which
        it is matched) and end (exclusive), over the whole of ``buf``.

        The buffer is cut behind reset bytes into lanes of about ``lane`` bytes
        which advance together, a byte of each at a time. Where no reset byte comes for
        longer, it is cut anywhere, and the states that such lanes begin in are found first.
        """
        rules = int(self.matched.max()).bit_length()
        if not len(buf):
            return [(np.zeros(0, np.int64),) * 2 for _ in range(rules)]
        cuts = np.flatnonzero(self.resets[buf]) + 1
        cuts = np.append(cuts[cuts < len(buf)], len(buf))
        keep = np.flatnonzero(np.diff(np.append(-1, cuts // lane)))
        hard = np.unique(np.append(0, cuts[keep]))
        hard = hard[hard < len(buf)]
        room = np.diff(np.append(hard, len(buf)))
        parts = np.maximum(1, room // lane)
        starts = np.repeat(hard, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * lane
        sizes = np.diff(np.append(starts, len(buf)))
        soft = np.ones(len(starts), bool)
        soft[np.cumsum(parts) - parts] = False
        flat = np.ascontiguousarray(self.table.astype(np.int32) * 256).ravel()
        begin = self._begins(buf, starts, sizes, soft, flat)
        states = np.empty(len(buf), np.int16)
        for at, now in _steps(buf, flat, starts, sizes, begin << 8):
            states[at] = now >> 8
        marks = self.matched[states]
        found = []
        for r in range(rules):
            on = np.zeros(len(buf) + 2, np.int8)
            on[1:-1] = marks >> r & 1
            edge = np.diff(on)
            found.append((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)))
        return found


    def _begins(self, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, soft: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """The state that each lane begins in; behind a reset byte that is the start.

        A lane that is followed by a soft cut is run from every state that it may begin in.
        All states are tried over its first bytes, after which only a few different ones
        are left; from those the lane is run to its end. Then lane after lane is looked up.
        """
        begin = np.zeros(len(starts), np.int32)
        todo = np.flatnonzero(np.append(soft[1:], False))  # whose last state is asked for
        count = len(self.table)
        for low in range(0, len(todo), _TOGETHER):
            own = todo[low : low + _TOGETHER]
            lanes = np.repeat(own, count)
            now = np.tile(np.arange(count, dtype=np.int32) << 8, len(own))
            for k in range(min(_FIRST, int(sizes[own].min()))):
                now = flat[now + buf[starts[lanes] + k]]
            k = min(_FIRST, int(sizes[own].min()))
            # The different states per lane, and which of them each first state led to.
            pairs, back = np.unique((lanes << 32) + now, return_inverse=True)
            rest = pairs >> 32
            last = np.zeros(len(pairs), np.int32)
            order = np.argsort(-sizes[rest], kind="stable")
            alive = 0
            for _, ends in _steps(buf, flat, starts[rest][order] + k, sizes[rest][order] - k, (pairs & 0xFFFFFFFF).astype(np.int32)[order]):
                alive = len(ends)
                last[order[:alive]] = ends
            if not alive:
                last = (pairs & 0xFFFFFFFF).astype(np.int32)
            ends_of = (last[back.ravel()] >> 8).reshape(len(own), count)
            for row, lane in enumerate(own.tolist()):
                begin[lane + 1] = ends_of[row, begin[lane]]
        return begin


#: Lanes whose states are found together, and bytes over which all states are tried.
_TOGETHER, _FIRST = 1024, 64


def _steps(buf: np.ndarray, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begin: np.ndarray):  # noqa: ANN202
    """Advance lanes together: yields, a byte of each at a time, the places and the states behind
    them (times 256) of the lanes that go on, the longest lanes first."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, now = starts[order], sizes[order], begin[order]
    alive = len(starts)
    for k in range(int(sizes[0]) if len(sizes) else 0):
        while sizes[alive - 1] <= k:
            alive -= 1
        at = starts[:alive] + k
        now = flat[now[:alive] + buf[at]]
        yield at, now


def compile_rules(patterns: list[tuple[str, bool]]) -> Automaton:
    """``patterns``: (pattern, whether letters match in either case), one per rule."""
    rules = [_Pattern(pattern, fold) for pattern, fold in patterns]
    starts = [p.closure({p.start}) for p in rules]
    # A state holds, per rule, the sets of NFA states of the attempts still open,
    # oldest first. A matched attempt drops the younger ones and starts no new one.
    root = tuple(() for _ in rules)
    ids, todo, rows, marks = {root: 0}, [root], [], []
    kinds = _byte_kinds(rules)
    while todo:
        state = todo.pop(0)
        marks.append(sum(1 << r for r, threads in enumerate(state) if threads and rules[r].end in threads[0]))
        by_kind = {}
        for kind, byte in kinds[1].items():
            after = []
            for p, start, threads in zip(rules, starts, state, strict=True):
                matched = bool(threads) and p.end in threads[0]
                going = [*threads] if matched else [*threads, start]
                moved = [t for t in (p.step(x, byte) for x in going) if t]
                if matched and (not moved or p.end not in moved[0]):
                    if moved:
                        raise ValueError("a matched rule may only be extended by matching bytes")
                    moved = [t for t in [p.step(start, byte)] if t]
                ends = next((k for k, t in enumerate(moved) if p.end in t), None)
                if ends is not None:
                    moved = [moved[ends]]
                after.append(tuple(dict.fromkeys(moved)))
            after = tuple(after)
            if after not in ids:
                ids[after] = len(ids)
                todo.append(after)
            by_kind[kind] = ids[after]
        rows.append([by_kind[k] for k in kinds[0]])
    table, matched = _minimal(np.array(rows), np.array(marks))
    if matched[table[0]].any():
        raise ValueError("a rule must take two bytes at least")
    if len(table) > 32_000:
        raise ValueError("too many states")
    return Automaton(table, matched, (table == 0).all(axis=0))


def _byte_kinds(rules: list[_Pattern]) -> tuple[list[int], dict[int, int]]:
    """The kind of each byte, and one byte of each kind; no rule tells bytes of a kind apart."""
    masks = {mask for p in rules for edges in p.edges for mask, _ in edges}
    seen: dict[tuple, int] = {}
    kinds = [seen.setdefault(tuple(m >> byte & 1 for m in masks), len(seen)) for byte in range(256)]
    return kinds, {kind: kinds.index(kind) for kind in seen.values()}
