"""A suffix automaton of a vocabulary: which tokens end at each place of a text.

States stand for the substrings of all tokens, grouped by where they occur; a token is
always the longest string of its state, so a state holds one token at most. Read along a
text the automaton knows the longest suffix that is a substring of some token. The tokens
that are suffixes of the text so far are that state's own, if it was matched in full
length, and those up its suffix links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class SuffixAutomaton:
    def __init__(self, tokens: Iterable[tuple[bytes, int]]):
        self.link, self.length = [-1], [0]
        edges: list[dict[int, int]] = [{}]
        ends = {}
        for data, token in sorted(tokens):
            state = 0
            for letter in data:
                state = self._extend(edges, state, letter)
            ends[state] = token
        #: (state, letter) as one number -> state
        self.edges = {state << 8 | letter: to for state, out in enumerate(edges) for letter, to in out.items()}
        self.token = [ends.get(state, -1) for state in range(len(edges))]
        #: next state up the suffix links that holds a token; 0 if there is none
        self.up = [0] * len(edges)
        for state in sorted(range(1, len(edges)), key=self.length.__getitem__):
            above = self.link[state]
            self.up[state] = above if self.token[above] >= 0 else self.up[above]

    def _extend(self, edges: list[dict[int, int]], last: int, letter: int) -> int:
        """The state of the string of ``last`` and the letter."""
        to = edges[last].get(letter)
        if to is not None:
            return to if self.length[to] == self.length[last] + 1 else self._split(edges, last, letter, to)
        made = len(edges)
        edges.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        at = last
        while at >= 0 and letter not in edges[at]:
            edges[at][letter] = made
            at = self.link[at]
        if at >= 0:
            to = edges[at][letter]
            self.link[made] = to if self.length[to] == self.length[at] + 1 else self._split(edges, at, letter, to)
        return made

    def _split(self, edges: list[dict[int, int]], at: int, letter: int, to: int) -> int:
        """Part the shorter strings of a state from it, those that also occur elsewhere."""
        made = len(edges)
        edges.append(dict(edges[to]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[to])
        self.link[to] = made
        while at >= 0 and edges[at].get(letter) == to:
            edges[at][letter] = made
            at = self.link[at]
        return made

    def ends(self, text: bytes) -> list[int]:
        """For every prefix the first state up the links that holds a token, or 0."""
        edge, link, length, token, up = self.edges.get, self.link, self.length, self.token, self.up
        state, matched, out = 0, 0, []
        for letter in text:
            to = edge(state << 8 | letter)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = edge(state << 8 | letter)
            if to is None:
                out.append(0)
                continue
            state = to
            matched += 1
            out.append(state if matched == length[state] and token[state] >= 0 else up[state])
        return out

    def suffixes(self, state: int) -> Iterator[tuple[int, int]]:
        """(token, length) of a state that `ends` gives and of all above it, longest first."""
        while state:
            yield self.token[state], self.length[state]
            state = self.up[state]
