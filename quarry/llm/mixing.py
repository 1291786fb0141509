"""Mixing sources to target weights: whole repeats, proportional counts by length, and a knapsack for the rest."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

#: Most times that a document can stand in the mix; also bounds a target as a multiple of its source.
MOST_REPEATS = 3
#: Hash buckets that a (source, size) group is split into before ranks are taken in it, in stretches of STRETCH for their running sums.
BUCKETS, STRETCH = 4096, 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def default_weights(names: list[str | None]) -> list[float]:
    """1, 2, 3, repeating, over the sources by code point, null last."""
    return [1.0 + k % 3 for k in range(len(names))]


def targets(sizes: dict[str | None, int], weights: Callable[[list[str | None]], list[float]] = default_weights) -> dict[str | None, float]:
    """Each source's share of all sizes; what exceeds MOST_REPEATS times a source goes to the others by weight, until none exceeds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = dict(zip(names, weights(names), strict=True))
    left, total, out = set(names), float(sum(sizes.values())), {}
    while left:
        sum_w = sum(weight[s] for s in names if s in left)
        over = {s for s in left if total * weight[s] / sum_w > MOST_REPEATS * sizes[s]}
        if not over:
            return out | {s: total * weight[s] / sum_w for s in left}
        for s in sorted(over, key=names.index):
            out[s] = float(MOST_REPEATS * sizes[s])
            total -= out[s]
        left -= over
    return out


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their lengths sum to `budget` or just less.

    The bulk is taken in proportion, so that each length keeps its share; the remaining budget is then
    filled by the bounded-knapsack dynamic programme: bit s of a big integer says that the sum s can be made.
    """
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    budget = max(0, min(budget, total))
    if not total or not budget:
        return [0] * len(lengths)
    take = [budget * c // total for c in counts]
    rest = budget - sum(n * t for n, t in zip(lengths, take, strict=True))
    order = sorted(range(len(lengths)), key=lambda k: (-(budget * counts[k] % total), -lengths[k]))
    longest = max(lengths)
    for k in order:  # single documents by the largest remainder, until the knapsack's budget is small
        if rest <= 2 * longest:
            break
        if take[k] < counts[k] and lengths[k] <= rest:
            take[k] += 1
            rest -= lengths[k]
    rest_for_table = min(rest, 2 * longest)
    mask, reach, steps = (1 << (rest_for_table + 1)) - 1, 1, []
    for k in sorted(range(len(lengths)), key=lambda k: lengths[k]):
        spare = min(counts[k] - take[k], rest_for_table // lengths[k])
        size = 1
        while spare > 0 and not reach >> rest_for_table & 1:
            size = min(size, spare)
            steps.append((k, size, reach))
            reach |= reach << (size * lengths[k]) & mask
            spare -= size
            size *= 2
    at = reach.bit_length() - 1
    for k, size, before in reversed(steps):
        if not before >> at & 1:
            take[k] += size
            at -= size * lengths[k]
    return take


def _allot(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source's histogram to the documents of each length that get one repeat more."""
    pdf = pdf.sort_values("size")
    extra = fit([int(n) for n in pdf["size"]], [int(n) for n in pdf["n"]], int(pdf["rest"].iloc[0]))
    return pd.DataFrame({"key": pdf["key"], "size": pdf["size"], "extra": extra})


def _planned(docs: DataFrame, seed: int, weights: Callable[[list[str | None]], list[float]]) -> DataFrame:
    """Per row: doc_id, source, key (of the source), deal (a hash of doc_id and text), size, source_size, target, copies."""
    spark = docs.sparkSession
    deal = F.xxhash64(F.lit(seed), "doc_id", "text")
    sized = docs.select("doc_id", "source", _key("source").alias("key"), word_count(F.col("text")).alias("size"), deal.alias("deal"))
    sized = written(sized.withColumn("bucket", F.pmod("deal", F.lit(BUCKETS)).cast("int")), "mix-sizes")
    cells = written(sized.groupBy("key", "size", "bucket").agg(F.count("*").alias("n")), "mix-cells")
    histogram = cells.where("size > 0").groupBy("key", "size").agg(F.sum("n").alias("n"))
    totals = cells.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")).collect()
    sizes = {r["key"][1:] if r["key"][0] == "s" else None: r["source_size"] for r in totals}
    goal = targets(sizes, weights)
    rows = []
    for name, size in sizes.items():
        whole = min(MOST_REPEATS, int(goal[name] // size)) if size else 0
        rows.append(("n" if name is None else "s" + name, size, goal[name], whole, int(round(goal[name])) - whole * size if whole < MOST_REPEATS else 0))
    plan = spark.createDataFrame(rows, "key string, source_size long, target double, whole int, rest long")
    # one row for each source: as small as what the driver has just held
    fitted = histogram.join(F.broadcast(plan.select("key", "rest")), "key").groupBy("key").applyInPandas(_allot, "key string, size long, extra long")
    # documents before each bucket of one source and length: by stretches of buckets, then within the stretch
    cells = cells.withColumn("stretch", F.floor(F.col("bucket") / STRETCH).cast("int"))
    ahead = Window.partitionBy("key", "size").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("key", "size", "stretch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    stretches = cells.groupBy("key", "size", "stretch").agg(F.sum("n").alias("n")).join(fitted.where("extra > 0"), ["key", "size"])
    stretches = stretches.select("key", "size", "stretch", (F.col("extra") - F.coalesce(F.sum("n").over(ahead), F.lit(0))).alias("left")).where("left > 0")
    room = cells.join(stretches, ["key", "size", "stretch"]).select("key", "size", "bucket", (F.col("left") - F.coalesce(F.sum("n").over(within), F.lit(0))).alias("room")).where("room > 0")
    rank = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("order", "doc_id", "deal"))
    ranked = sized.withColumn("order", F.xxhash64(F.lit(seed + 1), F.col("deal"))).withColumn("rank", rank)
    extra = F.when(F.col("rank") <= F.coalesce(F.col("room"), F.lit(0)), 1).otherwise(0)
    return (
        ranked.join(room, ["key", "size", "bucket"], "left")
        .join(F.broadcast(plan.drop("rest")), "key", "left")
        .select("doc_id", "source", "key", "deal", "size", "source_size", "target", F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(0).cast("int").alias("copies"))
    )


def _key(source: str) -> Column:
    """A source as a string that is never null."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source)))


def mix_sources(docs: DataFrame, seed: int = 17, weights: Callable[[list[str | None]], list[float]] = default_weights) -> DataFrame:
    """Per row of `docs`: doc_id, source, size, source_size, target, taken.

    A document's size is its number of words; null texts have 0 and are never taken. The null source stands
    last. Sizes, targets and counts are those of all rows and of whole texts, whatever their length; rows that share a
    doc_id, or have none, are rows of their own. Their seeded order is that of a hash of doc_id and text, so that only rows
    with equal doc_id, text and source can change places. Further columns, whatever their names, are not read. An empty
    table gives none.

    One row for each source comes to the driver; the histogram of one source (a row for each length that
    occurs) goes through one task. Ranks are taken inside hash buckets, so that no group need be sorted whole.
    """
    return _planned(docs, seed, weights).select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, seed: int = 17, weights: Callable[[list[str | None]], list[float]] = default_weights) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with all their columns; see mix_sources. Documents without words are left out."""
    names, p = docs.columns, "_"
    while any(c.startswith(p) for c in names):  # names of its own beside any columns
        p += "_"
    keyed = docs.withColumns({p + "key": _key("source"), p + "deal": F.xxhash64(F.lit(seed), "doc_id", "text")})
    plan = _planned(docs, seed, weights).where("copies > 0").groupBy(F.col("doc_id").alias(p + "i"), F.col("key").alias(p + "k"), F.col("deal").alias(p + "d"))
    plan = plan.agg(F.sum("copies").cast("int").alias(p + "copies"), F.count("*").alias(p + "rows"))
    joined = keyed.join(plan, F.col("doc_id").eqNullSafe(F.col(p + "i")) & (F.col(p + "key") == F.col(p + "k")) & (F.col(p + "deal") == F.col(p + "d")))
    # equal rows share their copies: the first of them stands for all
    several = joined.where(F.col(p + "rows") > 1)
    several = several.withColumn(p + "first", F.row_number().over(Window.partitionBy(p + "i", p + "k", p + "d").orderBy(p + "rows"))).where(F.col(p + "first") == 1).drop(p + "first")
    every = joined.where(F.col(p + "rows") == 1).unionByName(several)
    return every.withColumn(p + "copy", F.explode(F.sequence(F.lit(1), F.col(p + "copies")))).select(*(F.col(f"`{c}`") for c in names))
