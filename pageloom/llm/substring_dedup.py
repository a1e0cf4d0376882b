"""Removal of repeated runs of words, found by matching statistics over suffix automata.

A shard's passages are streamed through a suffix automaton of what was streamed before them. After
each word, the suffix link of the newest state gives the matching statistic: the length of the longest
run of words that ends here and also ends earlier. Where it reaches the threshold, the window is
covered. The automata are not sent to all documents, as that would take every document past every
shard: passages that can match go to the one shard of their anchor (``pageloom.llm.repeats``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from pageloom.llm.repeats import HOT, BLOCK_BYTES, Repeats, Shard

WINDOW = 20
GRAM = 8
AUTOMATON_WORDS = 40_000


class SuffixAutomaton:
    """Of a growing sequence; ``extend`` returns the length of the longest suffix that was there before."""

    def __init__(self):
        self.links, self.lengths, self.steps = [-1], [0], [{}]
        self.last = 0

    def extend(self, token) -> int:
        links, lengths, steps = self.links, self.lengths, self.steps
        new = len(links)
        at = self.last
        links.append(0)
        lengths.append(lengths[at] + 1)
        steps.append({})
        self.last = new
        while at >= 0 and token not in steps[at]:
            steps[at][token] = new
            at = links[at]
        if at < 0:
            return 0
        goal = steps[at][token]
        if lengths[goal] != lengths[at] + 1:
            twin = len(links)
            links.append(links[goal])
            lengths.append(lengths[at] + 1)
            steps.append(dict(steps[goal]))
            links[goal] = twin
            while at >= 0 and steps[at].get(token) == goal:
                steps[at][token] = twin
                at = links[at]
            goal = twin
        links[new] = goal
        return lengths[goal]


def earlier(window: int):
    """For each passage of a shard, its windows that stand earlier in the shard."""

    def found(shard: Shard) -> list[np.ndarray]:
        ends = np.append(np.flatnonzero(np.diff(shard.anchor)) + 1, len(shard.texts)) if len(shard.texts) else ()
        out, begin, automaton = [], 0, SuffixAutomaton()
        for end in ends:
            for i in range(begin, end):
                words = shard.texts[i].split(b" ")
                flags = np.zeros(len(words) - window + 1, bool)
                # A lone passage repeats a window only if that many of its words stand earlier in it.
                if end - begin > 1 or len(set(words)) <= len(words) - window:
                    automaton.extend(i)
                    for k, word in enumerate(words):
                        if automaton.extend(word) >= window:
                            flags[k - window + 1] = True
                out.append(flags)
            begin = end
            if len(automaton.links) > AUTOMATON_WORDS:
                automaton = SuffixAutomaton()
        return out

    return found


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, hot: int = HOT, block_bytes: int = BLOCK_BYTES,
    extra: str | None = None,
) -> DataFrame:
    """``key``, ``n_tokens``, ``n_removed``, ``n_spans`` and ``kept`` (words joined by a space) of every row.

    A word goes if a window of ``window`` words over it stands earlier: in a text of a smaller key, or
    earlier in the same text. Windows are judged on the input. A null text is empty; rows with a
    null key come after all others and are not told apart; rows that share a key and stand at
    the same place do not remove each other. Other columns are not read, but
    for one string column ``extra`` that is carried along.
    """
    return Repeats(window, min(GRAM, window), True, earlier(window), hot, block_bytes).kept(docs, key, text, extra)
