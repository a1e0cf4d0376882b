"""Many runs of words at once: an Aho-Corasick automaton whose letters are whole words, and a filter for more of them."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Sequence

import numpy as np


class WordAutomaton:
    """Which of many runs of words stand in a text, by one pass over its words.

    Built as arrays, which are what a task is sent: ``edges`` are state and word in one number, in order, ``targets`` the
    states that they lead to, ``fail`` the state of the longest suffix, ``ends`` the run that a state completes
    or -1, and ``above`` the nearest state up the suffixes that completes one, or 0.
    """

    def __init__(self, runs: Sequence[Sequence[str]]):
        self.words = sorted({w for run in runs for w in run})
        number = {w: i for i, w in enumerate(self.words)}
        self.width = max(1, len(self.words))
        steps: list[dict[int, int]] = [{}]
        ends = [-1]
        for i, run in enumerate(runs):
            state = 0
            for w in run:
                after = steps[state].get(number[w])
                if after is None:
                    after = steps[state][number[w]] = len(steps)
                    steps.append({})
                    ends.append(-1)
                state = after
            ends[state] = i
        fail, above = [0] * len(steps), [0] * len(steps)
        waiting = deque(steps[0].values())
        while waiting:
            state = waiting.popleft()
            shorter = fail[state]
            above[state] = shorter if ends[shorter] >= 0 else above[shorter]
            for w, after in steps[state].items():
                back = shorter
                while back and w not in steps[back]:
                    back = fail[back]
                fail[after] = steps[back].get(w, 0)
                waiting.append(after)
        pairs = sorted((s * self.width + w, after) for s, step in enumerate(steps) for w, after in step.items())
        self.edges = np.array([e for e, _ in pairs], np.int64)
        self.targets = np.array([t for _, t in pairs], np.int32)
        self.fail, self.ends, self.above = (np.array(x, np.int32) for x in (fail, ends, above))


class Matcher:
    """The automaton laid out for stepping, once per task."""

    def __init__(self, automaton: WordAutomaton):
        self.number = {w: i for i, w in enumerate(automaton.words)}
        self.width = automaton.width
        self.after = dict(zip(automaton.edges.tolist(), automaton.targets.tolist(), strict=True))
        self.fail, self.ends, self.above = automaton.fail.tolist(), automaton.ends.tolist(), automaton.above.tolist()
        # The root's own words: of most texts all others are passed over.
        self.first = {w for w, i in self.number.items() if i in self.after}

    def found(self, words: Iterable[str]) -> list[int]:
        """The runs that stand in a text, in order of their numbers."""
        number, width, after, fail, ends, above = self.number, self.width, self.after, self.fail, self.ends, self.above
        first, state, seen = self.first, 0, set()
        for word in words:
            if not state:
                if word not in first:
                    continue
                state = after[number[word]]
            else:
                i = number.get(word)
                if i is None:
                    state = 0
                    continue
                step = after.get(state * width + i)
                while step is None and state:
                    state = fail[state]
                    step = after.get(state * width + i)
                state = step or 0
            hit = state if ends[state] >= 0 else above[state]
            while hit:
                seen.add(ends[hit])
                hit = above[hit]
        return sorted(seen)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class RunHashes:
    """64-bit hashes of runs of words, from a hash of each word, by differences of one sum over all words."""

    def __init__(self, words: np.ndarray):
        powers = np.full(len(words) + 1, _BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words.view(np.uint64) * powers[:-1], out=self.total[1:])
        self.back = np.full(len(words) + 1, _INVERSE, np.uint64)
        self.back[0] = 1
        np.multiply.accumulate(self.back, out=self.back)

    def of(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """The hashes of the runs of ``n`` words from ``at`` on."""
        return _mixed((self.total[at + n] - self.total[at]) * self.back[at] + np.asarray(n).astype(np.uint64))


def run_keys(runs: RunHashes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What a filter holds of runs: each whole, and its beginning of as many words as the largest power of two has."""
    begin = 1 << (np.frexp(n.astype(np.float64))[1].astype(np.int64) - 1)
    return np.concatenate([runs.of(at, n), ~runs.of(at, begin)])


def filter_bits(keys: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each key, of a power of two of them, and its three bits of that cell."""
    one, six = np.uint64(1), np.uint64(63)
    cell = (keys >> np.uint64(40)).astype(np.int64) & (cells - 1)
    return cell, one << (keys & six) | one << (keys >> np.uint64(6) & six) | one << (keys >> np.uint64(12) & six)


def may_stand(cells: np.ndarray, lengths: Sequence[int], words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of words of all runs that the filter holds, and of a few that it does not.

    ``words`` are the hashes of the words of texts, ``ends`` says for each where its text ends, ``lengths`` how many words runs have.
    """
    runs, place = RunHashes(words), np.arange(len(words))

    def held(keys):
        cell, bits = filter_bits(keys, len(cells))
        return cells[cell] & bits == bits

    found = [(place[:0], place[:0])]
    for level in sorted({1 << (n.bit_length() - 1) for n in lengths}):
        at = place[place + level <= ends]
        at = at[held(~runs.of(at, level))]
        for n in lengths:
            if level <= n < 2 * level:
                own = at[at + n <= ends[at]]
                own = own[held(runs.of(own, n))]
                found.append((own, np.full(len(own), n)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
