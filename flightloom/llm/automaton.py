"""A suffix automaton over sequences of integers, with the smallest owner of every substring."""

from __future__ import annotations

from collections.abc import Iterable

NOBODY = 1 << 63


class SuffixAutomaton:
    """Add sequences with their owners, ``finish``, then ``found`` tells which windows of a sequence some smaller owner has."""

    def __init__(self):
        self.after: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner = [NOBODY]

    def add(self, sequence: Iterable[int], owner: int) -> None:
        """Extend the automaton by one sequence. Starting each at the root keeps substrings within sequences."""
        after, link, length, owners = self.after, self.link, self.length, self.owner
        last = 0
        for symbol in sequence:
            known = after[last].get(symbol)
            if known is not None:
                # The extension exists already: reuse its state, splitting it where it stands for longer strings as well.
                last = known if length[known] == length[last] + 1 else self._split(last, known, symbol)
                owners[last] = min(owners[last], owner)
                continue
            new = len(link)
            after.append({})
            length.append(length[last] + 1)
            owners.append(owner)
            link.append(0)
            at = last
            while at >= 0 and symbol not in after[at]:
                after[at][symbol] = new
                at = link[at]
            if at >= 0:
                next_state = after[at][symbol]
                link[new] = next_state if length[next_state] == length[at] + 1 else self._split(at, next_state, symbol)
            last = new

    def _split(self, at: int, state: int, symbol: int) -> int:
        after, link, length = self.after, self.link, self.length
        copy = len(link)
        after.append(dict(after[state]))
        length.append(length[at] + 1)
        link.append(link[state])
        self.owner.append(NOBODY)
        link[state] = copy
        while at >= 0 and after[at].get(symbol) == state:
            after[at][symbol] = copy
            at = link[at]
        return copy

    def finish(self) -> None:
        """Hand owners down to all suffixes, longest strings first."""
        owner, link = self.owner, self.link
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if owner[state] < owner[link[state]]:
                owner[link[state]] = owner[state]

    def found(self, sequence: Iterable[int], window: int, owner: int) -> list[int]:
        """Starts of the windows of ``sequence`` that a smaller owner's sequence holds, by matching statistics."""
        after, link, length, owners = self.after, self.link, self.length, self.owner
        state, matched, starts = 0, 0, []
        for at, symbol in enumerate(sequence):
            step = after[state].get(symbol)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = after[state].get(symbol)
            if step is None:
                continue
            state, matched = step, matched + 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                if owners[state] < owner:
                    starts.append(at - window + 1)
        return starts
