"""Language of a text by cross-parsing against suffix automata of labelled texts.

A text is parsed into phrases, each the longest piece from here on that stands anywhere in the
labelled text of a language, plus the character that broke it. The language whose text needs the
fewest phrases for the length wins: the fewer, the lower the cross entropy.

The automata are built from a bounded sample of labelled rows, ``SAMPLE_BYTES`` a language, sent to
tasks as transitions and laid out there as a table, so that many texts step through all
automata at once. Phrases do not go on over a cut of ``LANE`` characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.tables import chunks, give_back

SAMPLE_BYTES = 48 << 10
SAMPLE_ROW = 1024
LANE = 1024
UNKNOWN = "und"
HAS_LETTER = r"(?s).*\p{L}.*"


def reduced() -> np.ndarray:
    """Byte to what is compared: ASCII letters in lower case, bytes of other letters, else one class."""
    table = np.zeros(256, np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    table[128:] = np.arange(128, 256)
    return table


def squeezed(raw: bytes) -> np.ndarray:
    """Reduced bytes, with runs of other characters as one."""
    codes = reduced()[np.frombuffer(raw, np.uint8)]
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def automaton(codes: bytes) -> np.ndarray:
    """Transitions (state, code, next state) of the suffix automaton of a text; state 0 is the root."""
    links, lengths, steps, last = [-1], [0], [{}], 0
    for code in codes:
        new, at = len(links), last
        links.append(0)
        lengths.append(lengths[at] + 1)
        steps.append({})
        last = new
        while at >= 0 and code not in steps[at]:
            steps[at][code] = new
            at = links[at]
        if at < 0:
            continue
        goal = steps[at][code]
        if lengths[goal] != lengths[at] + 1:
            twin = len(links)
            links.append(links[goal])
            lengths.append(lengths[at] + 1)
            steps.append(dict(steps[goal]))
            links[goal] = twin
            while at >= 0 and steps[at].get(code) == goal:
                steps[at][code] = twin
                at = links[at]
            goal = twin
        links[new] = goal
    return np.array([(s, c, t) for s, step in enumerate(steps) for c, t in step.items()], np.int32).reshape(-1, 3)


class CrossParser:
    """Phrases that texts need against each of several automata, as one table of transitions."""

    def __init__(self, automata: list[np.ndarray]):
        used = sorted({int(c) for a in automata for c in np.unique(a[:, 1])} | {0})
        self.code = np.zeros(256, np.int32)
        self.code[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        sizes = [int(a[:, 2].max(initial=0)) + 1 for a in automata]
        base = np.cumsum([0, *sizes])
        self.table = np.zeros(int(base[-1]) * self.width, np.int32)
        for a, b in zip(automata, base.tolist(), strict=False):
            self.table[(a[:, 0] + b) * self.width + self.code[a[:, 1]]] = (a[:, 2] + b) * self.width
        self.roots = (base[:-1] * self.width).astype(np.int32)

    def phrases(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases by text and automaton, and the length of each text."""
        codes = [self.code[squeezed(t)] for t in texts]
        lanes = [c[i : i + LANE] for c in codes for i in range(0, len(c), LANE)]
        owner = np.repeat(np.arange(len(texts)), [-(-len(c) // LANE) for c in codes])
        total = np.zeros((len(texts), len(self.roots)), np.int64)
        lengths = np.array([len(c) for c in codes])
        if not lanes:
            return total, lengths
        size = np.array([len(x) for x in lanes])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        grid = np.zeros((LANE, len(lanes)), np.int32)
        for column, lane in enumerate(order.tolist()):
            grid[: len(lanes[lane]), column] = lanes[lane]
        # At step t the first lanes, the longest, still have characters.
        alive = np.searchsorted(-size, -np.arange(size[0]), side="left")
        count = np.zeros((len(self.roots), len(lanes)), np.int32)
        table = self.table
        for k, root in enumerate(self.roots.tolist()):
            state = np.full(len(lanes), root, np.int32)
            broken = count[k]
            for t, n in enumerate(alive.tolist()):
                step = table[state[:n] + grid[t, :n]]
                stop = step == 0
                broken[:n] += stop
                step[stop] = root
                state = step
        np.add.at(total, owner[order], count.T)
        return total + (lengths > 0)[:, None], lengths


def learned(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_bytes: int = SAMPLE_BYTES):
    """Names of the languages and the automaton of each, from ``sample_bytes`` of its text, or all if it has less.

    The sample takes different texts in the order of their hashes, of each at most ``SAMPLE_ROW``
    characters, so it is the same however the rows are dealt out and however often they repeat.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(HAS_LETTER)).select(
        F.col(lang).alias("lang"), F.substring(text, 1, SAMPLE_ROW).alias("text"), F.xxhash64(text).alias("h")
    )
    # As long as squeezed() makes it.
    size = F.octet_length(F.regexp_replace("text", r"[\x00-\x7F&&[^a-zA-Z]]+", " "))
    lengths = rows.groupBy("lang", "h").agg(F.min(size).alias("size")).groupBy("lang").agg(F.sum("size").alias("size")).collect()
    picked, total, factor = {}, {r.lang: r.size for r in lengths}, 4.0
    while total:
        # Hashes below this leave several times the text that is needed, whatever the size of the table.
        shares = {k: min(1.0, factor * sample_bytes / max(n, 1)) for k, n in total.items()}
        share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
        near = rows.where((F.col("h") / float(1 << 64) + 0.5) <= share[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text"))
        before = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
        for row in near.withColumn("before", F.coalesce(F.sum(size).over(before), F.lit(0))).where(F.col("before") < sample_bytes).collect():
            picked.setdefault(row.lang, []).append(row)
        # The rare language of which too little was below is asked again.
        have = {k: sum(len(squeezed(r.text.encode())) for r in v) for k, v in picked.items()}
        total = {k: n for k, n in total.items() if shares[k] < 1 and have.get(k, 0) < sample_bytes}
        factor *= 8
        for k in total:
            picked.pop(k, None)
    names = sorted(picked)
    texts = {k: [r.text.encode() for r in sorted(picked[k], key=lambda r: r.h)] for k in names}
    return names, [automaton(squeezed(b"\n".join(texts[n]))[:sample_bytes].tobytes()) for n in names]


def predict(
    docs: DataFrame, model: tuple[list[str], list[np.ndarray]], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every whole text.

    The language of the fewest phrases for the length wins, of equal ones the first by name; the
    score is one less the share of its phrases in the runner-up's (1 if there is no other). A text
    that is null or has no letter, and any text if nothing was learned, is ``und`` with score 0.
    """
    names = model[0]
    sent = docs.sparkSession.sparkContext.broadcast(model[1])

    def judged(batches):
        parser = CrossParser(sent.value) if names else None
        for keys, texts in chunks(batches, "key", "text"):
            langs, scores = [UNKNOWN] * len(keys), np.zeros(len(keys))
            if parser is not None:
                # A text without letters comes here as an empty one.
                count, length = parser.phrases(texts)
                langs = [names[b] if n else UNKNOWN for b, n in zip(count.argmin(axis=1).tolist(), length.tolist(), strict=True)]
                two = np.sort(count, axis=1)
                scores = np.where(length > 0, 1 - two[:, 0] / np.maximum(two[:, 1], 1) if len(names) > 1 else 1.0, 0.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["key", "lang_pred", "score"]
            )
        del parser
        give_back()

    readable = F.coalesce(F.col(text).rlike(HAS_LETTER), F.lit(False))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.when(readable, F.col(text)).cast("binary").alias("text"))
    out = rows.mapInArrow(judged, "key long, lang_pred string, score double")
    return out.withColumnRenamed("key", key)
