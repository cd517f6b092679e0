"""Temperature mixing of sources, realised as budgeted permutations of blocks.

A source with share p of the tokens gets a weight in proportion to p^t. The
exponent t (1: as found, 0: uniform) is found by bisection: the largest t
whose weights reach a wanted entropy, or the smallest whose rarest source
repeats no more than a limit. The weights become token budgets; every
source's documents are dealt to blocks by a hash, and each epoch walks the
blocks in its own order until the budget is used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policylens.llm.text import Scratch, small, text_key, words


@dataclass(frozen=True)
class Mixing:
    """entropy: wanted share of the uniform weights' entropy (0 to 1). repeats: most epochs of any source.
    The weights stop at whichever binds first. blocks: blocks of a source. seed: of the permutations."""

    entropy: float = 0.95
    repeats: float = 2.0
    blocks: int = 256
    seed: int = 17


def sources(docs: DataFrame, source: Column, tokens: Column) -> DataFrame:
    """(source, tokens): the tokens of every source; a null source is one of its own. Combined before the shuffle."""
    return docs.select(source.alias("source"), tokens.alias("tokens")).groupBy("source").agg(F.sum("tokens").alias("tokens"))


def exponent(shares: DataFrame, mix: Mixing) -> tuple[float, float]:
    """(t, total budget in tokens) from (source, tokens).

    Each step of the bisection is one aggregate over the table of sources; only
    sums come to the driver. The budget is the least in which the source with the lowest
    weight per token, the most common one, still has one whole epoch, so no document is lost.
    """
    live = shares.where("tokens > 0")
    n, total, low, high = live.agg(F.count(F.lit(1)), F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    if not n:
        return 1.0, 0.0
    log_p = F.log(F.col("tokens") / F.lit(float(total)))

    def entropy(ts: list[float]) -> list[float]:
        # -sum w log w with w = p^t / z is log z - t * sum(p^t log p) / z
        row = live.agg(*[F.sum(F.exp(log_p * t)) for t in ts], *[F.sum(F.exp(log_p * t) * log_p) for t in ts]).first()
        return [math.log(z) - t * s / z for t, z, s in zip(ts, row[:len(ts)], row[len(ts):], strict=True)]

    wanted = mix.entropy * math.log(n)
    a, b = 0.0, 1.0
    if n == 1 or entropy([1.0])[0] >= wanted:
        a = 1.0
    else:
        for _ in range(8):  # 15 inner points a pass divide the interval by 16
            ts = [a + (b - a) * k / 16 for k in range(1, 16)]
            ok = [t for t, h in zip(ts, entropy(ts), strict=True) if h >= wanted]
            a, b = (max(ok, default=a), min([t for t in ts if t not in ok], default=b))
    t = a
    if high > low:
        # epochs of the rarest source over those of the most common one: (low / high)^(t - 1)
        x, y = 0.0, 1.0
        for _ in range(60):
            mid = (x + y) / 2
            x, y = (x, mid) if (low / high) ** (mid - 1) <= mix.repeats else (mid, y)
        t = max(t, y)
    z = live.agg(F.sum(F.exp(log_p * t))).first()[0]
    return t, float(high) / (math.exp(t * math.log(high / total)) / z)


def plan(docs: DataFrame, source: Column, tokens: Column, key: Column, mix: Mixing) -> tuple[DataFrame, DataFrame]:
    """(rows with source, block and tokens' table of blocks) -> see ``blocks``; and the weights table.

    weights: source, tokens, weight, budget. blocks: source, block, tokens, epochs (array of
    (epoch, position), one for each time the block is read).
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    block = block_of(key, mix)
    per_block = scratch.keep(docs.select(source.alias("source"), block.alias("block"), tokens.alias("tokens"))
                             .groupBy("source", "block").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")))
    shares = per_block.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    t, budget = exponent(shares, mix)
    live = shares.where("tokens > 0")
    total = live.agg(F.sum("tokens")).first()[0] or 1
    power = F.when(F.col("tokens") > 0, F.exp(F.lit(t) * F.log(F.col("tokens") / F.lit(float(total))))).otherwise(F.lit(0.0))
    z = live.agg(F.sum(power)).first()[0] or 1.0
    weights = shares.select("source", "tokens", (power / F.lit(float(z))).alias("weight"))
    weights = weights.withColumn("budget", F.greatest(F.round(F.col("weight") * F.lit(budget)).cast("long"), F.col("tokens")))
    w = weights.select(F.col("source").alias("s"), F.col("tokens").alias("all"), "budget")
    of = per_block.join(small(w, w.count()), per_block["source"].eqNullSafe(F.col("s")))
    whole = F.when(F.col("all") > 0, F.floor(F.col("budget") / F.col("all"))).otherwise(F.lit(1)).cast("int")
    of = of.withColumn("whole", whole).withColumn("rest", F.when(F.col("all") > 0, F.col("budget") - F.col("whole") * F.col("all")).otherwise(F.lit(0)))
    each = of.select("source", "block", "tokens", "rest", "whole", F.explode(F.sequence(F.lit(0), F.col("whole"))).alias("epoch"))
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64("block", "epoch", "source", F.lit(mix.seed)), "block")
    each = each.withColumn("place", F.row_number().over(order)).withColumn("upto", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    size = F.count(F.lit(1)).over(Window.partitionBy("source", "epoch"))
    each = each.withColumn("position", F.col("epoch") + (F.col("place") - 1) / size).where((F.col("epoch") < F.col("whole")) | (F.col("upto") <= F.col("rest")))
    blocks = each.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("epoch", "position"))).alias("epochs"))
    return scratch.keep(blocks), scratch.keep(weights)


def block_of(key: Column, mix: Mixing) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(mix.seed)), F.lit(mix.blocks)).cast("int")


def mixed(docs: DataFrame, mix: Mixing = Mixing()) -> DataFrame:
    """Each row of ``docs`` (doc_id, text, source, ...) once for each epoch that reads its block, with epoch and position.

    position orders the mixture: every source advances through its epochs at an even pace, block by
    block. Every row is read at least once; blocks beyond a source's last whole epoch are read while the budget lasts.
    A null text has no tokens (words count as tokens), a null source is a source, repeated rows count each; clashing column
    names are kept apart; an empty table gives no rows. The table of blocks is joined by (source, block), so a source of a third of all rows is
    spread over ``blocks`` keys where that table outgrows a broadcast.
    """
    tokens = F.size(words(docs["text"])).cast("long")
    key = F.coalesce(docs["doc_id"].cast("long"), text_key(docs["text"]))
    blocks, _ = plan(docs, docs["source"], tokens, key, mix)
    blocks = blocks.select(F.col("source").alias("s"), F.col("block").alias("b"), "epochs")
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    rows = docs.select(row, docs["source"].alias("source"), block_of(key, mix).alias("block"))
    out = rows.join(small(blocks, blocks.count(), 100_000), rows["source"].eqNullSafe(F.col("s")) & (rows["block"] == F.col("b")))
    return out.select("row", F.explode("epochs").alias("e")).select("row", "e.epoch", "e.position")
