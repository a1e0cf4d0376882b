"""Token counts and the token budget as batches, without a single task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import token_estimate
from pageloom.operators.order import ROWS_PER_CHUNK, order_chunk


def token_count(
    text: Column, tokenizer: Callable[[], Callable[[list[str]], list[int]]] | None = None
) -> Column:
    """Tokens of a text: an estimate, or exact by a user's tokenizer built once per task."""
    if tokenizer is None:
        return token_estimate(text)

    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = tokenizer()
        for batch in batches:
            yield pd.Series(count(batch.fillna("").tolist()), dtype="int64")

    return F.pandas_udf(counts, "bigint")(text)


class _Fold:
    """The budget rule over the rows of one chunk.

    Before a row the counter restarts if the row's prompt would not fit; after it the
    counter restarts if prompt and answer went over. Each restart opens a batch.
    """

    def __init__(self, prompt, completion, budget):
        self.prompt, self.budget = prompt, budget
        self.rows = len(prompt)
        self.sums = np.concatenate(([0], np.cumsum(prompt + completion)))

    def next_restart(self, used, row):
        """The first row that restarts the counter from ``used`` tokens before ``row``.

        Returns ``(row, before)``, where ``before`` tells a restart before that row from
        one after it, or None. A restart before a row needs its sum to go over as well.
        """
        limit = self.budget - used + self.sums[row]
        found = int(np.searchsorted(self.sums[row + 1 :], limit, side="right")) + row
        if found >= self.rows:
            return None
        return found, bool(self.sums[found] + self.prompt[found] > limit)

    def after(self, row, before):
        """Follow a restart to the next one: ``(restart or None, used at the end)``."""
        start = row if before else row + 1
        following = self.next_restart(0, start) if start < self.rows else None
        if before and following == (row, True):
            # The prompt alone is over the budget: it has restarted already, so it can
            # only go over again after the row.
            following = (row, False)
        return following, int(self.sums[-1] - self.sums[start])

    def ends(self):
        """The chunk as a function of the tokens used before it.

        Returns rows ``(above, used_after, restarts)`` with ``above`` ascending: for more
        than ``above`` tokens the chunk ends with ``used_after`` and that many restarts.
        The first row, above -1, has no restart and adds the sum of the chunk.
        """
        known: dict = {}

        def end_of(restart):
            path = []
            while restart is not None and restart not in known:
                following, used = self.after(*restart)
                path.append((restart, used))
                restart = following
            used, count = known[restart] if restart is not None else (path[-1][1], 0)
            for step, _ in reversed(path):
                count += 1
                known[step] = (used, count)
            return used, count

        table = []
        for row in range(self.rows):
            if self.sums[row] > self.budget:
                break
            # After this row fewer tokens suffice than before it.
            for before, total in ((True, self.sums[row] + self.prompt[row]), (False, self.sums[row + 1])):
                above = max(int(self.budget - total), -1)
                if table and above >= table[-1][0]:
                    continue
                table.append((above, *end_of((row, before))))
                if above == -1:
                    break
            if table and table[-1][0] == -1:
                break
        if not table or table[-1][0] > -1:
            table.append((-1, int(self.sums[-1]), 0))
        merged = []
        for entry in reversed(table):
            if not merged or merged[-1][2] == 0 or merged[-1][1:] != entry[1:]:
                merged.append(entry)
        return merged

    def batches(self, used, batch):
        steps = np.zeros(self.rows + 1, dtype="int64")
        restart = self.next_restart(used, 0) if self.rows else None
        while restart is not None:
            row, before = restart
            steps[row if before else row + 1] += 1
            restart, _ = self.after(row, before)
        return batch + np.cumsum(steps)[: self.rows]


def _sorted_fold(rows: pd.DataFrame, budget: int) -> tuple[pd.DataFrame, _Fold]:
    rows = rows.sort_values("seq", kind="stable", ignore_index=True)
    return rows, _Fold(rows["prompt"].to_numpy("int64"), rows["completion"].to_numpy("int64"), budget)


def _chunk_starts(
    tagged: DataFrame, budget: int, start_tokens: int, start_batch: int, state: DataFrame | None
) -> DataFrame:
    """Per shard and chunk, tokens used and batch number at its start and its end.

    Chunks are summarised apart, each to a short table of its end by its start; those
    tables, not the rows, are then followed in order, one small group per shard.
    """

    def summarise(key, rows):
        rows, fold = _sorted_fold(rows, budget)
        above, used, restarts = zip(*fold.ends())
        return pd.DataFrame(
            {"shard": key[0], "chunk": key[1], "above": [list(above)],
             "used": [list(used)], "restarts": [list(restarts)]}
        )

    def follow(key, rows):
        used, batch, out = int(rows["start_tokens"].iloc[0]), int(rows["start_batch"].iloc[0]), []
        for row in rows.sort_values("chunk").itertuples():
            start = (used, batch)
            at = int(np.searchsorted(row.above, used, side="left")) - 1
            restarts = int(row.restarts[at])
            used = int(row.used[at]) + (used if at == 0 and restarts == 0 else 0)
            batch += restarts
            out.append((key[0], row.chunk, *start, used, batch))
        return pd.DataFrame(
            out, columns=["shard", "chunk", "used_in", "batch_in", "used_out", "batch_out"]
        )

    summaries = tagged.groupBy("shard", "chunk").applyInPandas(
        summarise,
        "shard string, chunk int, above array<bigint>, used array<bigint>, restarts array<bigint>",
    )
    first = [F.lit(start_tokens).alias("start_tokens"), F.lit(start_batch).alias("start_batch")]
    if state is None:
        summaries = summaries.select("*", *first)
    else:
        known = state.select(F.col("shard").alias("known"), "token_count", F.col("batch").alias("batch_count"))
        found = [F.coalesce("token_count", F.lit(start_tokens)).alias("start_tokens"), F.coalesce("batch_count", F.lit(start_batch)).alias("start_batch")]
        summaries = summaries.join(known, F.col("shard").eqNullSafe(F.col("known")), "left").select(*summaries.columns, *found)
    return summaries.groupBy("shard").applyInPandas(
        follow,
        "shard string, chunk int, used_in bigint, batch_in bigint, used_out bigint, batch_out bigint",
    )


def _tagged(df: DataFrame, seq, prompt, completion, shard, rows_per_chunk) -> DataFrame:
    narrow = df.select(
        F.col(seq).alias("seq"),
        F.col(prompt).cast("bigint").alias("prompt"),
        F.coalesce(F.col(completion).cast("bigint"), F.lit(0)).alias("completion"),
        (F.lit("") if shard is None else F.col(shard).cast("string")).alias("shard"),
    )
    return narrow.withColumn("chunk", order_chunk(narrow, "seq", rows_per_chunk))


def token_batches(
    df: DataFrame,
    budget: int,
    seq: str = "seq",
    prompt: str = "prompt_tokens",
    completion: str = "completion_tokens",
    shard: str | None = None,
    start_tokens: int = 0,
    start_batch: int = 0,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    state: DataFrame | None = None,
) -> DataFrame:
    """``(seq, batch)``: the batch every row falls in under a token budget.

    The result equals one pass over all rows in the order of ``seq``, but every task folds
    one ordered chunk from its own start. ``shard`` gives each of its values, null too, a budget of
    its own. ``state``, as ``load_state`` gives it, goes on from where a run stopped: its shards
    start from their own counters. The narrow columns are read three times: let them come from a table.
    """
    tagged = _tagged(df, seq, prompt, completion, shard, rows_per_chunk)
    # One row per shard and chunk.
    starts = _chunk_starts(tagged, budget, start_tokens, start_batch, state).withColumnsRenamed({"shard": "_shard", "chunk": "_chunk"})
    own = F.col("shard").eqNullSafe(F.col("_shard")) & (F.col("chunk") == F.col("_chunk"))

    def label(key, rows):
        rows, fold = _sorted_fold(rows, budget)
        batch = fold.batches(int(rows["used_in"].iloc[0]), int(rows["batch_in"].iloc[0]))
        return pd.DataFrame({"shard": key[0], "seq": rows["seq"], "batch": batch})

    labelled = (
        tagged.join(starts, own)
        .groupBy("shard", "chunk")
        .applyInPandas(label, "shard string, seq bigint, batch bigint")
    )
    out = labelled.withColumnRenamed("seq", seq)
    return out.drop("shard") if shard is None else out.withColumnRenamed("shard", shard)


def token_state(
    df: DataFrame,
    budget: int,
    seq: str = "seq",
    prompt: str = "prompt_tokens",
    completion: str = "completion_tokens",
    shard: str | None = None,
    start_tokens: int = 0,
    start_batch: int = 0,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    state: DataFrame | None = None,
) -> DataFrame:
    """Per shard, tokens in use and batch number after all rows: the start of the next run."""
    tagged = _tagged(df, seq, prompt, completion, shard, rows_per_chunk)
    last = _chunk_starts(tagged, budget, start_tokens, start_batch, state).groupBy("shard").agg(
        F.max_by("used_out", "chunk").alias("token_count"),
        F.max_by("batch_out", "chunk").alias("batch"),
    )
    return last.drop("shard") if shard is None else last.withColumnRenamed("shard", shard)
