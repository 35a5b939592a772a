"""Suffix automaton over word hashes, grown text by text."""

from __future__ import annotations


class SuffixAutomaton:
    """All substrings of the word sequences added so far.

    add() appends one sequence as a text of its own: no match runs from one
    added sequence into the next.  States are parallel lists; transitions are
    dictionaries keyed by word hash.
    """

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, at: int, word: int) -> int:
        """The state for the longest suffix at `at` + word, cloned off if need be."""
        target = self.step[at][word]
        if self.length[target] == self.length[at] + 1:
            return target
        clone = self._state(self.length[at] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = clone
        while at >= 0 and self.step[at].get(word) == target:
            self.step[at][word] = clone
            at = self.link[at]
        return clone

    def add(self, words) -> None:
        step, link = self.step, self.link
        last = 0
        for word in words:
            if word in step[last]:
                last = self._split(last, word)
                continue
            new = self._state(self.length[last] + 1, 0, {})
            at = last
            while at >= 0 and word not in step[at]:
                step[at][word] = new
                at = link[at]
            link[new] = self._split(at, word) if at >= 0 else 0
            last = new

    def windows(self, words, size: int) -> list[int]:
        """Matching statistics, cut at `size`: where windows of that many words
        that the automaton holds begin."""
        step, link, length = self.step, self.link, self.length
        at = matched = 0
        found = []
        for i, word in enumerate(words):
            while word not in step[at]:
                at = link[at]
                if at < 0:
                    break
                matched = length[at]
            if at < 0:
                at = matched = 0
                continue
            at = step[at][word]
            matched += 1
            if matched >= size:
                while length[link[at]] >= size:
                    at = link[at]
                matched = min(matched, length[at])
                found.append(i - size + 1)
        return found
