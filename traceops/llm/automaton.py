"""Regular expressions as one minimal automaton over bytes, whose transitions lie in one array.

Each rule becomes a nondeterministic automaton. Subset construction keeps its threads by their starts, so the state says by
itself which match is the leftmost: where the match of the oldest thread can grow no more, the transition reports its end and
goes on as from the start. Minimised rules are joined into one automaton, which is minimised again. A transition that
ends matches leads to a state of its own (numbered from `first_end` on), so a scan needs a single look-up for a byte.

Rules are ASCII: literals, classes, groups, `|`, `? * + {n} {n,} {n,m}`, `\\xHH` and escaped signs. A rule whose leftmost match can
not be told while reading on (it could fail after it could have ended, or a later match ends before an earlier one) is refused.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np

#: one past the bytes: the end of a text
END = 256


class _Threads:
    """The nondeterministic automaton of an expression: `free` moves need no byte, `moves` need one of a set."""

    def __init__(self, pattern: str):
        self.free, self.moves, self.pattern, self.at = [], [], pattern, 0
        self.first, self.last = self._either()
        if self.at < len(pattern):
            raise ValueError(f"{pattern!r}: {pattern[self.at]!r} at {self.at} is not understood")

    def _state(self) -> int:
        self.free.append([])
        self.moves.append(None)
        return len(self.free) - 1

    def _peek(self) -> str:
        return self.pattern[self.at:self.at + 1]

    def _either(self):
        first, last = self._state(), self._state()
        while True:
            a, b = self._row()
            self.free[first].append(a)
            self.free[b].append(last)
            if self._peek() != "|":
                return first, last
            self.at += 1

    def _row(self):
        first = last = self._state()
        while self._peek() not in ("", "|", ")"):
            begin = self.at
            a, b = self._one()
            end = self.at
            least, most = self._times()
            # a copy of the piece is made by reading it again
            after, copies = self.at, max(least, most or 0, 1)
            for turn in range(copies):
                if turn:
                    self.at = begin
                    a, b = self._one()
                    assert self.at == end
                if turn >= least:
                    self.free[a].append(b)
                if most is None and turn == copies - 1:
                    self.free[b].append(a)
                self.free[last].append(a)
                last = b
            self.at = after
        return first, last

    def _times(self):
        found = re.compile(r"[?*+]|\{(\d+)(,?)(\d*)\}").match(self.pattern, self.at)
        if not found:
            return 1, 1
        self.at = found.end()
        if found[0] in ("?", "*", "+"):
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[found[0]]
        least = int(found[1])
        return least, least if not found[2] else int(found[3]) if found[3] else None

    def _one(self):
        if self._peek() == "(":
            self.at += 1
            inner = self._either()
            if self._peek() != ")":
                raise ValueError(f"{self.pattern!r}: a group is open")
            self.at += 1
            return inner
        if self._peek() == "[":
            signs = self._class()
        else:
            signs = {self._sign()}
        a, b = self._state(), self._state()
        self.moves[a] = (frozenset(signs), b)
        return a, b

    def _sign(self) -> int:
        sign = self._peek()
        self.at += 1
        if sign == "\\":
            found = re.compile(r"x([0-9A-Fa-f]{2})|([^0-9A-Za-z])").match(self.pattern, self.at)
            if not found:
                raise ValueError(f"{self.pattern!r}: escape at {self.at} is not understood")
            self.at = found.end()
            return int(found[1], 16) if found[1] else ord(found[2])
        if not sign or sign in "?*+{}.^$" or ord(sign) > 127:
            raise ValueError(f"{self.pattern!r}: {sign!r} at {self.at - 1} is not understood")
        return ord(sign)

    def _class(self) -> set[int]:
        self.at += 1
        signs, inverse = set(), self._peek() == "^"
        self.at += inverse
        while self._peek() != "]":
            low = ord(self._plain()) if self._peek() != "\\" else self._sign()
            high = low
            if self.pattern[self.at:self.at + 1] == "-" and self.pattern[self.at + 1:self.at + 2] != "]":
                self.at += 1
                high = ord(self._plain()) if self._peek() != "\\" else self._sign()
            signs.update(range(low, high + 1))
        self.at += 1
        return set(range(256)) - signs if inverse else signs

    def _plain(self) -> str:
        sign = self._peek()
        if not sign:
            raise ValueError(f"{self.pattern!r}: a class is open")
        self.at += 1
        return sign

    def closed(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for state in self.free[todo.pop()]:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
        return frozenset(s for s in seen if self.moves[s] or s == self.last)

    def step(self, states, byte: int) -> frozenset[int]:
        return self.closed({self.moves[s][1] for s in states if self.moves[s] and byte in self.moves[s][0]})


@dataclass(frozen=True)
class Table:
    """`to[state, sign]` and `ends[state, sign]`, the rules (as bits) whose match ends before the sign."""
    to: np.ndarray
    ends: np.ndarray


def byte_classes(threads: list[_Threads]) -> np.ndarray:
    """A class for each byte and for the end; bytes of one class are alike to all rules."""
    sets = sorted({tuple(sorted(move[0])) for t in threads for move in t.moves if move})
    held = np.zeros((len(sets) + 1, END + 1), dtype=bool)
    for row, signs in enumerate(sets):
        held[row, list(signs)] = True
    held[-1, END] = True
    return np.unique(held, axis=1, return_inverse=True)[1].reshape(-1).astype(np.uint8)


def _samples(classes: np.ndarray) -> list[int]:
    """A byte (or the end) of each class."""
    return [int(np.flatnonzero(classes == c)[0]) for c in range(classes.max() + 1)]


def search_table(threads: _Threads, classes: np.ndarray) -> Table:
    """Leftmost longest matches one after the other, by subset construction.

    A state holds the threads of each start still alive, the oldest first. Where a start has a match, younger ones are gone.
    """
    fresh = threads.closed([threads.first])
    if threads.last in fresh:
        raise ValueError(f"{threads.pattern!r} matches the empty text")

    def read(state, byte):
        groups, seen = [], set()
        for group in (*state, fresh):
            new = threads.step(group, byte) - seen if byte < END else frozenset()
            if new:
                groups.append(new)
                seen |= new
                if threads.last in new:
                    if len(groups) > 1:
                        raise ValueError(f"{threads.pattern!r}: a later match can end before an earlier one")
                    break
        return tuple(groups)

    def follow(state, byte):
        if state and threads.last in state[0]:  # a match that can only grow; the fresh start waits for its end
            new = threads.step(state[0], byte) if byte < END else frozenset()
            if not new:
                return read((), byte), 1
            if threads.last not in new:
                raise ValueError(f"{threads.pattern!r}: a match can fail after it could have ended")
            return (new,), 0
        return read(state, byte), 0

    samples = _samples(classes)
    return _table((), lambda state: [follow(state, sign) for sign in samples])


def _table(first, follow) -> Table:
    """Numbers the states that can be reached from `first`, in the order they are met; `follow` gives (next, ends) of each sign."""
    numbers, todo, to, ends = {first: 0}, [first], [], []
    for state in todo:
        states, ended = zip(*follow(state))
        for new in states:
            if new not in numbers:
                numbers[new] = len(numbers)
                todo.append(new)
        to.append([numbers[new] for new in states])
        ends.append(ended)
    return minimal(Table(np.array(to, dtype=np.int64), np.array(ends, dtype=np.int64)))


def minimal(table: Table) -> Table:
    """States that no text tells apart become one: their groups are split by what they lead to until nothing splits.

    The start keeps number 0.
    """
    group = np.unique(table.ends, axis=0, return_inverse=True)[1].reshape(-1)
    while True:
        split = np.unique(np.column_stack([group, group[table.to]]), axis=0, return_inverse=True)[1].reshape(-1)
        if split.max() == group.max():
            break
        group = split
    _, where, group = np.unique(group, return_index=True, return_inverse=True)
    order = np.argsort(where, kind="stable")  # in the order of their first states
    number = np.empty_like(order)
    number[order] = np.arange(len(order))
    return Table(number[group.reshape(-1)[table.to[where[order]]]], table.ends[where[order]])


def joined(tables: list[Table]) -> Table:
    """All rules side by side; rule i reports its ends in bit i."""
    to = [t.to.tolist() for t in tables]
    ends = [(t.ends << i).tolist() for i, t in enumerate(tables)]

    def follow(state):
        return zip(zip(*(t[s] for t, s in zip(to, state))), map(sum, zip(*(e[s] for e, s in zip(ends, state)))))

    return _table((0,) * len(tables), follow)


@dataclass(frozen=True)
class Scanner:
    """`to[state + class]` is the next state, states being numbered in steps of `width`.

    States from `first_end` on are those after which matches have ended, `ends[state / width]`; `home[state / width]` is the same without.
    """
    classes: np.ndarray
    width: int
    to: np.ndarray
    first_end: int
    ends: np.ndarray
    home: np.ndarray


def _scanner(table: Table, classes: np.ndarray) -> Scanner:
    states, width = table.to.shape
    pairs = sorted({(int(t), int(e)) for t, e in zip(table.to.ravel(), table.ends.ravel()) if e})
    number = {pair: states + i for i, pair in enumerate(pairs)}
    to = table.to.copy()
    for s, c in zip(*np.nonzero(table.ends)):
        to[s, c] = number[int(table.to[s, c]), int(table.ends[s, c])]
    to = np.vstack([to, to[[t for t, _ in pairs]]]) if pairs else to
    ends = np.concatenate([np.zeros(states, np.int64), np.array([e for _, e in pairs], np.int64)])
    home = np.concatenate([np.arange(states), np.array([t for t, _ in pairs], np.int64)]) * width
    return Scanner(classes, width, (to * width).ravel().astype(np.int32), states * width, ends, home)


@functools.lru_cache(maxsize=8)
def scanner(patterns: tuple[str, ...]) -> Scanner:
    threads = [_Threads(p) for p in patterns]
    classes = byte_classes(threads)
    return _scanner(joined([search_table(t, classes) for t in threads]), classes)


def _reversed(threads: _Threads) -> _Threads:
    """Reads the texts of the rule from their end."""
    back = _Threads("")
    back.pattern, back.free, back.moves = threads.pattern, [[] for _ in threads.free], [None] * len(threads.free)
    for a, targets in enumerate(threads.free):
        for b in targets:
            back.free[b].append(a)
    for a, move in enumerate(threads.moves):
        if move:  # a state of its own, as several moves may end in one
            back.free.append([])
            back.moves.append((move[0], a))
            back.free[move[1]].append(len(back.free) - 1)
    back.first, back.last = threads.last, threads.first
    return back


class Anchored:
    """The longest text of a rule from a given place on, or up to a given place when `backward`.

    States are made as they are met; used for the few places that the scan has found.
    """

    def __init__(self, pattern: str, backward: bool = False):
        threads = _Threads(pattern)
        self.threads, self.backward = _reversed(threads) if backward else threads, backward
        self.first = self.threads.closed([self.threads.first])
        self.known = {}

    def reach(self, data: bytes, at: int, limit: int) -> int:
        """The far end of the longest text between `at` and `limit`, -1 if there is none."""
        state, found, last = self.first, -1, self.threads.last
        if last in state:
            found = at
        for place in range(at - 1, limit - 1, -1) if self.backward else range(at, limit):
            key = state, data[place]
            state = self.known.get(key)
            if state is None:
                state = self.known[key] = self.threads.step(*key)
            if not state:
                break
            if last in state:
                found = place if self.backward else place + 1
        return found


#: bytes of a lane of the scan, twice that at most
LANE = 2048


def _lanes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where lanes begin, and the end of the last: at texts, and inside them about each LANE bytes, after a blank if one is near."""
    blanks = np.append(np.flatnonzero((data == 32) | (data == 10)) + 1, len(data))
    marks = np.arange(offsets[0] + LANE, offsets[-1], LANE)
    cuts = blanks[np.searchsorted(blanks, marks)]
    cuts = np.where(cuts - marks < LANE, cuts, marks)
    return np.unique(np.concatenate([offsets, cuts[(cuts > offsets[0]) & (cuts < offsets[-1])]]))


def _read(scanner: Scanner, signs: np.ndarray, start: np.ndarray, length: np.ndarray, state: np.ndarray):
    """Lanes read from their states on, a byte of all at a time: (lanes, places, states) of ended matches, and the last states."""
    order = np.argsort(-length, kind="stable")
    place, state = start[order], state[order].astype(np.int32)
    # lanes by falling length: so many of them have a byte at each place
    alive = np.searchsorted(-length[order], -np.arange(length.max(initial=0)), side="left").tolist()
    lanes, places, found = [], [], []
    for n in alive:
        now = state[:n]
        now += signs.take(place[:n], mode="clip")
        scanner.to.take(now, out=now, mode="clip")
        if np.maximum.reduce(now) >= scanner.first_end:
            hit = np.flatnonzero(now >= scanner.first_end)
            lanes.append(hit)
            places.append(place[hit])
            found.append(now[hit])
        place[:n] += 1
    last = np.empty_like(state)
    last[order] = state
    if not lanes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), last
    return order[np.concatenate(lanes)], np.concatenate(places), np.concatenate(found), last


def ends(scanner: Scanner, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, rules as bits) of the matches' ends in all texts; text i is data[offsets[i]:offsets[i + 1]].

    One pass over the bytes, cut into lanes of about equal length that read a byte at a time together, each from the start state.
    A lane inside a text after which the automaton was elsewhere is read again from there; that is rare, and repeated until every lane
    began where the one before it ended. A match that ends with its text is reported at the end of the text.
    """
    cuts = _lanes(data, offsets)
    start, length = cuts[:-1], np.diff(cuts)
    inside = ~np.isin(start, offsets)  # goes on with the text of the lane before
    signs = scanner.classes[data]
    begin = np.zeros(len(start), dtype=np.int32)
    lanes, places, found, last = _read(scanner, signs, start, length, begin)
    while True:
        right = np.where(inside, np.append(0, scanner.home[last[:-1] // scanner.width]), 0).astype(np.int32)
        wrong = np.flatnonzero(right != begin)
        if not len(wrong):
            break
        keep = ~np.isin(lanes, wrong)
        again = _read(scanner, signs, start[wrong], length[wrong], right[wrong])
        lanes = np.concatenate([lanes[keep], wrong[again[0]]])
        places, found = (np.concatenate([old[keep], new]) for old, new in ((places, again[1]), (found, again[2])))
        begin[wrong], last[wrong] = right[wrong], again[3]
    # the end of a text is a sign too
    closing = np.flatnonzero(np.append(~inside[1:], True))
    final = scanner.to[last[closing] + scanner.classes[END]]
    hit = final >= scanner.first_end
    places = np.concatenate([places, (start + length)[closing[hit]]])
    found = np.concatenate([found, final[hit]])
    order = np.argsort(places, kind="stable")
    return places[order], scanner.ends[found[order] // scanner.width]
