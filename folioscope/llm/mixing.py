"""Mixing sources to target weights: targets by capped shares, whole repeats, and the rest as a subset sum over lengths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import packed, ranked, unpacked, words

WEIGHTS, MOST = (1, 2, 3), 3
# Words of a source's budget that are left to the exact search; its table has that many bits per length at most.
EXACT_WORDS, SEED = 1 << 14, 17


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to (source, source_size): shares by weight of all sizes, none over ``most`` times its size.

    Sources take the weights in turn, by code point, NULL last. Sharing the excess again and again ends where every
    source below its cap gets the same amount per unit of weight, found here from running sums in the order in which
    the caps are met. The table has one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * most).cast("double")
    each = sources.withColumns({"w": w, "cap": cap}).withColumn("ratio", F.col("cap") / F.col("w"))
    everything, met = Window.partitionBy(), Window.orderBy("ratio", F.asc_nulls_last("source"))
    sums = each.withColumns({"all": F.sum("source_size").over(everything).cast("double"), "all_w": F.sum("w").over(everything),
                             "below": F.sum("cap").over(met) - F.col("cap"), "below_w": F.sum("w").over(met) - F.col("w")})
    rate = sums.withColumn("rate", (F.col("all") - F.col("below")) / (F.col("all_w") - F.col("below_w")))
    # The first source whose cap isn't under the rate of those from it on sets the rate of all of them.
    level = F.min(F.when(F.col("ratio") >= F.col("rate"), F.struct("ratio", "source", "rate"))).over(everything)["rate"]
    return rate.withColumn("level", level).select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def fill(sizes: np.ndarray, counts: np.ndarray, budget: int, exact: int = EXACT_WORDS) -> np.ndarray:
    """How many texts of each size to take so that their sizes come as near to ``budget`` from below as found.

    All but ``exact`` words are spread over the lengths in proportion, from long to short, what a length can't take
    going to the next. The remaining budget is a bounded knapsack over the texts left, solved on bit sets.
    """
    order = np.argsort(-sizes, kind="stable")
    take, total = np.zeros(len(sizes), np.int64), int((sizes * counts).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    spread, debt = max(0, budget - exact), 0.0
    for i in order:
        debt += counts[i] * sizes[i] * (spread / total)
        take[i] = min(counts[i], int(debt // sizes[i]))
        debt -= float(take[i] * sizes[i])
    left = budget - int((take * sizes).sum())
    for i in order:  # few or long texts may leave more than the exact search should hold
        if left <= exact:
            break
        more = min(int(counts[i] - take[i]), (left - exact) // int(sizes[i]))
        take[i] += more
        left -= more * int(sizes[i])
    reach, steps, mask = 1, [], (1 << (left + 1)) - 1
    for i in order:
        free, power = min(int(counts[i] - take[i]), left // int(sizes[i])), 1
        while free > 0 and not reach >> left & 1:
            n = min(power, free)
            steps.append((i, n, reach))
            reach = (reach | reach << (n * int(sizes[i]))) & mask
            free, power = free - n, 2 * power
    at = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            take[i] += n
            at -= n * int(sizes[i])
    return take


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED,
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row: key, source, size (words), source_size, target, copies (0 to ``most``), taken.

    A source takes all its texts as often as its target holds them, and of the rest as many texts of each length as
    ``fill`` says, those first in a seeded order of their keys. Lengths are counted in Spark; a task sees the lengths
    of a source, not its rows. NULL and blank texts have size 0 and take nothing; a NULL source is a source of its
    own; repeated rows count each; an empty table gives an empty result. Reruns agree.
    """
    sized = staged(docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.size(words(F.col(text).cast("string"))).cast("long").alias("size")), "sizes")
    totals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    totals = totals.withColumn("whole", F.least(F.lit(most), whole))
    totals = staged(totals.withColumn("budget", F.when(F.col("whole") < most, F.round(F.col("target") - F.col("whole") * F.col("source_size"))).otherwise(0).cast("long")), "targets")
    lengths = sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        chosen = fill(group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64), int(group["budget"].iloc[0]))
        return pd.DataFrame({"source": group["source"], "size": group["size"], "chosen": chosen})

    budgets = totals.select(F.col("source").alias("_s"), "budget")
    asked = lengths.join(budgets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    chosen = asked.groupBy("source").applyInPandas(plan, "source string, size long, chosen long")
    by_length = staged(chosen.where("chosen > 0").select(F.col("source").alias("_s"), F.col("size").alias("_n"), "chosen"), "chosen")
    placed = ranked(sized, ["source", "size"], F.xxhash64("key", F.lit(seed)), ["key"])
    placed = placed.join(by_length, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_n")), "left").drop("_s", "_n")
    placed = placed.join(totals.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    copies = F.col("whole") + F.when(F.col("rank") < F.coalesce("chosen", F.lit(0)), 1).otherwise(0)
    return placed.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows the mix takes, each as often as it says, with their columns unchanged.

    Rows are matched to their decisions by key, size and source. Rows that share all three, as those with NULL keys
    may, are taken in the order of a hash: all as often as the least of their decisions, and the first of them once more.
    NULL and blank texts have no words; they come as often as their source is repeated whole. An empty table gives an
    empty result.
    """
    same = ["k", "is_null", "size", "source"]
    ident = {"k": F.coalesce(F.col(key).cast("string"), F.lit("")), "is_null": F.col(key).isNull()}
    plan = mix(docs, key=key, text=text, source=source, **options)
    decided = plan.select(*[v.alias(k) for k, v in ident.items()], "size", F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("source"), "copies")
    decided = staged(decided.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min("copies").alias("least"), F.sum("copies").alias("total")), "decided")
    whole = packed(docs, **ident, size=F.size(words(F.col(text).cast("string"))).cast("long"), source=F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")))
    # One plan at every size: decisions grow with the rows.
    alone = whole.join(decided.where("n = 1 AND least > 0").select(*same, "least").hint("merge"), same).select("row", F.col("least").cast("int").alias("copies"))
    several = decided.where("n > 1 AND total > 0")
    if not several.isEmpty():
        alone = alone.unionByName(_shared(whole.join(several.hint("merge"), same), same))
    times = alone.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return unpacked(times, docs.columns)


def _shared(rows: DataFrame, same: list[str]) -> DataFrame:
    """(row, copies) of rows that share a decision: equal rows are one with a count, and running sums over slices of the
    hash of the rows say how many lie before it, so that no decision's rows meet in one task."""
    once = staged(rows.groupBy("row", *same, "n", "least", "total").agg(F.count(F.lit(1)).alias("c")).withColumn("order", F.xxhash64("row")), "shared")
    once = once.withColumn("slice", F.shiftrightunsigned("order", 54).cast("int"))
    sums = once.groupBy(*same, "slice").agg(F.sum("c").alias("s"))
    below = sums.select(*same, "slice", (F.sum("s").over(Window.partitionBy(*same).orderBy("slice")) - F.col("s")).alias("below"))
    inner = F.sum("c").over(Window.partitionBy(*same, "slice").orderBy("order", F.to_json("row")).rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")
    placed = once.withColumn("inner", inner).join(below, [*same, "slice"])
    more = F.least(F.col("c"), F.greatest(F.lit(0), F.col("total") - F.col("n") * F.col("least") - F.col("below") - F.col("inner")))
    return placed.select("row", (F.col("c") * F.col("least") + more).cast("int").alias("copies")).where("copies > 0")
