"""Token sequences for training: packing, masks, batches, hold-out, schedules and metrics."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from corpusloom.operators import ranges

BLOCK = 384
MAX_LENGTH = 192
PART_ROWS = 200_000  # rows of a range that are summed in one task
HASH_DIGITS = 64  # of a key's and a row's digest
FEISTEL_ROUNDS = 6
IGNORED = -100  # label of a position that does not count


def offsets(sizes: DataFrame, order: str, size: str) -> DataFrame:
    """``sizes`` with ``offset``, the sum of the sizes before a row in ``order`` (of any orderable type;
    nulls first, rows of one value in any order).

    Rows are dealt into ranges of the order, those of one value into several if they are many; only the
    total of each range is summed in one place.
    """
    return ranges.running(ranges.ranged(sizes, [order], PART_ROWS), size).select("row.*", "offset")


def pack(docs: DataFrame, order: str, ids: str, end_id: int, block: int = BLOCK) -> DataFrame:
    """``block_id, input_ids, labels``: all ids in order, an end id after each document, cut into blocks
    of one length; the incomplete last block is left out.

    Each document is cut at the block borders, so whole pieces and not single ids are shuffled.
    """
    ended = docs.select(order, F.concat(ids, F.array(F.lit(end_id))).alias("__ids")).withColumn("__n", F.size("__ids").cast("bigint"))
    placed = offsets(ended, order, "__n")
    first, last = F.expr(f"offset div {block}"), F.expr(f"(offset + __n - 1) div {block}")
    each = placed.select("offset", "__ids", F.explode(F.sequence(first, last)).alias("block_id"))
    low = F.greatest(F.col("block_id") * block - F.col("offset"), F.lit(0))
    high = (F.col("block_id") + 1) * block - F.col("offset")
    pieces = each.select("block_id", "offset", F.slice("__ids", (low + 1).cast("int"), (high - low).cast("int")).alias("piece"))
    joined = pieces.groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("p"))
    whole = joined.select("block_id", F.flatten(F.transform("p", lambda x: x["piece"])).alias("input_ids")).filter(F.size("input_ids") == block)
    return whole.select("block_id", "input_ids", F.col("input_ids").alias("labels"))


def token_counts(docs: DataFrame, name: str, size: str) -> DataFrame:
    """Tokens of each document with its end id, and of all (null name)."""
    return docs.rollup(name).agg(F.sum(F.col(size) + 1).cast("bigint").alias("n_tokens"))


def mask_prompt(ids: Column, n_prompt: Column, limit: int = MAX_LENGTH) -> tuple[Column, Column]:
    """``input_ids`` cut to the limit, and ``labels`` that ignore the prompt."""
    cut = F.slice(ids, 1, limit)
    return cut, F.transform(cut, lambda t, i: F.when(i < F.least(n_prompt, F.lit(limit)), F.lit(IGNORED)).otherwise(t))


def trainable(labels: Column) -> Column:
    return F.exists(labels, lambda x: x != IGNORED)


def collate(samples: DataFrame, order: str, batch_size: int, pad_id: int) -> DataFrame:
    """``batch_id`` with rectangular ``input_ids, labels, attention_mask``; a short last batch stays.

    ``order`` must number the samples from 0.
    """
    row = F.struct(order, "input_ids", "labels")
    batches = samples.groupBy(F.expr(f"{order} div {batch_size}").alias("batch_id")).agg(F.array_sort(F.collect_list(row)).alias("b"), F.max(F.size("input_ids")).alias("w"))
    filled = lambda col, value: F.transform("b", lambda x: F.concat(x[col], F.array_repeat(F.lit(value), F.col("w") - F.size(x["input_ids"]))))
    mask = F.transform("b", lambda x: F.concat(F.array_repeat(F.lit(1), F.size(x["input_ids"])), F.array_repeat(F.lit(0), F.col("w") - F.size(x["input_ids"]))))
    return batches.select("batch_id", filled("input_ids", pad_id).alias("input_ids"), filled("labels", IGNORED).alias("labels"), mask.alias("attention_mask"))


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with ``rank`` from 1 in the order of a column."""
    return offsets(rows.withColumn("__one", F.lit(1)), order, "__one").withColumn("rank", F.col("offset") + 1).drop("__one", "offset")


def _shared_prefix(marked: DataFrame, take: int) -> str:
    """The least prefix of hashes at which ``take`` rows lie at or below it, two digits at a time: counts
    of 256 prefixes, then of those of the prefix in which the bound lies, while it holds many rows."""
    known, left = "", take
    while True:
        width = len(known) + 2
        inside = marked.filter(F.startswith("h", F.lit(known))) if known else marked
        counts = sorted((r[0], r[1]) for r in inside.groupBy(F.substring("h", 1, width)).count().collect())
        for prefix, n in counts:
            if n >= left:
                break
            left -= n
        if n <= PART_ROWS or width == HASH_DIGITS:
            return prefix
        known = prefix


def holdout(rows: DataFrame, key: str, fraction: float = 0.02, seed: int = 42) -> DataFrame:
    """``rows`` with ``split``: exactly max(1, n * fraction) rows are ``eval``, chosen by hash order of the
    key; among rows of one key a hash of where a row was read decides, so as many as are due go in.

    The prefix of the last chosen hash is found by counting prefixes; only its rows are sorted.
    """
    named = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))).cast("binary"))
    own = F.md5(F.concat(F.lit(f"{seed}:"), F.monotonically_increasing_id().cast("string")).cast("binary"))
    marked = ranges.stored(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.concat(named, own).alias("h")), "holdout")
    n = marked.count()
    take = max(1, int(n * fraction)) if fraction > 0 and n else 0
    if not take:
        return marked.select("row.*", F.lit("train").alias("split"))
    prefix = _shared_prefix(marked.select("h"), take)
    head = F.substring("h", 1, len(prefix))
    left = take - marked.filter(head < prefix).count()
    bound = marked.filter(head == prefix).select("h").orderBy("h").limit(left).agg(F.max("h")).first()[0]
    return marked.select("row.*", F.when(F.col("h") <= bound, "eval").otherwise("train").alias("split"))


class Permutation:
    """A permutation of 0 .. n - 1 for a seed and an epoch, without a table: a Feistel network.

    A number is a pair (l, r) of a grid of ``a`` by ``b`` cells, just larger than n.  In turns l and r are
    shifted by a hash of the other and a key, which permutes the grid; a number that falls on one of the few
    cells from n on walks on along its cycle until it is inside.
    """

    def __init__(self, n: int, seed: int, epoch: int):
        self.n, self.a = n, math.isqrt(max(n - 1, 0)) + 1
        self.b = -(-n // self.a) or 1
        self.keys = [int(hashlib.md5(f"{seed}:{epoch}:{k}".encode()).hexdigest()[:7], 16) for k in range(FEISTEL_ROUNDS)]

    @staticmethod
    def mixed(v: np.ndarray, key: int) -> np.ndarray:
        """A hash below 2 ** 31; no step passes 63 bits for v below 2 ** 31."""
        u = (v + key) % 2147483648 * 1103515245 % 2147483648
        return (u ^ (u >> 13)) * 69069 % 2147483647

    def _step(self, x: np.ndarray) -> np.ndarray:
        left, right = x // self.b, x % self.b
        for k, key in enumerate(self.keys):
            if k % 2:
                right = (right + self.mixed(left, key)) % self.b
            else:
                left = (left + self.mixed(right, key)) % self.a
        return left * self.b + right

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = self._step(x)
        while (far := np.flatnonzero(out >= self.n)).size:
            out[far] = self._step(out[far])
        return out


def epoch_order(rows: DataFrame, key: str, seed: int, epoch: int) -> DataFrame:
    """``rows`` with ``position``, their place (from 0) in the order of an epoch: one for each seed and
    epoch.  Row number i of the order of ``key`` goes to the place that :class:`Permutation` names.

    Places are dealt into stretches of ``PART_ROWS`` and ordered within them, so the partitions in turn hold
    the whole order; nothing is sorted as a whole.
    """
    ranked = numbered(rows, key)
    n = ranked.count()
    order = Permutation(n, seed, epoch)

    @F.pandas_udf(LongType())
    def place(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rank in parts:
            yield pd.Series(order(rank.to_numpy() - 1))

    placed = ranked.select(*[F.col(f"`{c}`") for c in rows.columns], place("rank").alias("position"))
    parts = max(1, -(-n // PART_ROWS))
    return placed.repartitionById(parts, F.expr(f"int(position div {PART_ROWS})")).sortWithinPartitions("position")


def optimizer_steps(batches: int, accumulate: int, epochs: int, most: int = 0) -> int:
    """Optimizer steps of a run; ``most`` of 0 is no bound."""
    steps = math.ceil(batches / accumulate) * epochs
    return min(steps, most) if most else steps


def learning_rates(spark: SparkSession, total: int, base: float, warmup_share: float = 0.03) -> DataFrame:
    """``step, lr``: linear warm-up, then half a cosine down to 0."""
    warmup = max(1, int(total * warmup_share))
    step = F.col("id").cast("double")
    progress = (step - warmup) / max(1, total - warmup)
    rate = F.when(step < warmup, step / warmup).otherwise(F.greatest(F.lit(0.0), 0.5 * (1 + F.cos(F.lit(math.pi) * progress))))
    return spark.range(total + 1).select(F.col("id").alias("step"), (rate * base).alias("lr"))


def loss_windows(losses: DataFrame, every: int = 10) -> DataFrame:
    """Mean loss of every ``every`` steps (from 1) and of the rest, named by its last step."""
    return losses.groupBy(F.expr(f"(step - 1) div {every}").alias("w")).agg(F.max("step").alias("step"), F.avg("loss").alias("loss")).drop("w")


def eval_loss(batch_losses: DataFrame, batch: str, loss: str) -> DataFrame:
    """Unweighted mean of batch means (0 without batches) and its perplexity, bounded at exp(20)."""
    means = batch_losses.groupBy(batch).agg(F.avg(loss).alias("m"))
    return means.agg(F.coalesce(F.avg("m"), F.lit(0.0)).alias("loss")).withColumn("perplexity", F.exp(F.least("loss", F.lit(20.0))))
