"""Suffix order of a distributed string by the difference cover modulo 3.

Sampled triples are sorted over all executors and named by their global rank; while names repeat, the string of names
is ordered by recursion; the remaining suffixes are merged by sorts of (symbol, rank behind it). Every sort is by range
with the place as its last key, so that equal symbols spread; a partition learns from the driver how many rows and names
lie before it: one row for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import cut

#: The symbol between pieces; beyond the end there is 0. Bytes are symbols from 2.
SEPARATOR = 1
SEPARATORS = 2


def by_range(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted over all partitions, in the shared folder, with the number of each row's partition as `part`."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()))


def _part(batch: pa.RecordBatch) -> int:
    return batch.column("part")[0].as_py()


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], axis=1)


def _changes(keys: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Which rows differ from the one before."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    if before is not None and len(keys):
        new[0] = bool((keys[0] != before).any())
    return new


def running(ordered: DataFrame, value: str, out: str) -> tuple[DataFrame, int]:
    """`ordered`, as by_range leaves it, with the sum of `value` over all rows before each; and the sum of all."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = int(batch.column(value).to_numpy(zero_copy_only=False).sum())
                yield pa.RecordBatch.from_arrays([pa.array([_part(batch)], pa.int32()), pa.array([total], pa.int64())], ["part", "total"])

    found = ordered.select("part", value).mapInArrow(totals, "part int, total long").groupBy("part").agg(F.sum("total").alias("total")).collect()
    before, total = {}, 0
    for part, own in sorted((r["part"], r["total"]) for r in found):
        before[part], total = total, total + own

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if batch.num_rows:
                values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = (before[_part(batch)] if at is None else at) + np.cumsum(values)
                at = int(ends[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - values)], [*batch.schema.names, out])

    return ordered.mapInArrow(place, T.StructType([*ordered.schema.fields, T.StructField(out, T.LongType())])), total


def named(ordered: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """`ordered` with `name`: the number, from 1, of its run of rows with equal `keys`; and how many runs there are."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, first, last = 0, 0, [], None
        for batch in batches:
            if batch.num_rows:
                held = _columns(batch, keys)
                first = first or held[0].tolist()
                total += int(_changes(held, last).sum())
                part, last = _part(batch), held[-1]
        if last is not None:
            edges = [pa.array([x], pa.list_(pa.int64())) for x in (first, last.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total], pa.int64()), *edges], ["part", "total", "first", "last"])

    before, total, last = {}, 0, None
    for r in sorted(ordered.select("part", *keys).mapInArrow(totals, "part int, total long, first array<long>, last array<long>").collect(), key=lambda r: r["part"]):
        total -= r["first"] == last  # a run that goes on from the partition before
        before[r["part"]], total, last = total, total + r["total"], r["last"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last = 0, None
        for batch in batches:
            if batch.num_rows:
                held = _columns(batch, keys)
                names = (before[_part(batch)] if last is None else at) + np.cumsum(_changes(held, last))
                at, last = int(names[-1]), held[-1]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names)], [*batch.schema.names, "name"])

    return ordered.mapInArrow(place, T.StructType([*ordered.schema.fields, T.StructField("name", T.LongType())])), total


def windows_of(symbols: DataFrame) -> DataFrame:
    """(pos, c0, c1, c2) of a string of rows (pos, c): each symbol with the two behind it, 0 beyond the end."""
    near = F.array(*(F.struct((F.col("pos") - k).alias("pos"), *(F.when(F.lit(j == k), F.col("c")).alias(f"c{j}") for j in range(3))) for k in range(3)))
    sent = symbols.select(F.explode(near).alias("x")).select("x.*").where("pos >= 0")
    return sent.groupBy("pos").agg(F.max("c0").alias("c0"), *(F.coalesce(F.max(f"c{j}"), F.lit(0)).alias(f"c{j}") for j in (1, 2)))


def windows_of_pieces(pieces: DataFrame) -> DataFrame:
    """The same of all pieces (base, held) one behind the other, each followed by SEPARATORS separators.

    Windows inside a piece and at its last bytes are exact; behind the last byte stand separators only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, held in zip(batch.column("base").to_pylist(), batch.column("held").to_pylist(), strict=True):
                s = np.r_[np.frombuffer(held, np.uint8).astype(np.int64) + SEPARATOR + 1, np.full(SEPARATORS + 2, SEPARATOR)]
                n = len(held) + SEPARATORS
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(base, base + n)), pa.array(s[:n]), pa.array(s[1 : n + 1]), pa.array(s[2 : n + 2])], ["pos", "c0", "c1", "c2"])

    return pieces.select("base", "held").mapInArrow(run, "pos long, c0 long, c1 long, c2 long")


def suffix_ranks(windows: DataFrame, n: int, need: int) -> DataFrame:
    """(pos, rank) for a string of n symbols given by its windows: ranks from 0 in the order of the first `need` symbols of each suffix at least."""
    windows = cut(windows)
    residue = F.col("pos") % 3
    sample = by_range(windows.where(residue != 0), ["c0", "c1", "c2", "pos"])
    names, different = named(sample, ["c0", "c1", "c2"])
    ones, twos = (n + 1) // 3, n // 3
    if need <= 3 or different == ones + twos:  # the triples decide, their order is that of the suffixes
        ranked = running(sample.select("pos", "part", F.lit(1).cast("long").alias("one")), "one", "k")[0].select("pos", "k")
    else:
        place = F.when(residue == 1, F.floor((F.col("pos") - 1) / 3)).otherwise(F.lit(ones + 1) + F.floor((F.col("pos") - 2) / 3)).cast("long")
        string = names.select(place.alias("pos"), (F.col("name") + 1).alias("c"))
        between = string.sparkSession.createDataFrame([(ones, SEPARATOR)], "pos long, c long")
        found = suffix_ranks(windows_of(string.unionByName(between)), ones + 1 + twos, -(-need // 3))
        back = F.when(F.col("pos") < ones, 3 * F.col("pos") + 1).otherwise(3 * (F.col("pos") - ones - 1) + 2)
        # the suffix of the separator is the least of all
        ranked = found.where(F.col("pos") != ones).select(back.alias("pos"), (F.col("rank") - 1).alias("k"))
    ranked = cut(ranked)
    # each place with its first two symbols and the ranks one and two places behind it
    none = F.lit(None).cast("long")
    rows = windows.select("pos", "c0", "c1", none.alias("r1"), none.alias("r2"))
    for d in (1, 2):
        rows = rows.unionByName(ranked.select((F.col("pos") - d).alias("pos"), (F.col("k") + 1).alias(f"r{d}")), allowMissingColumns=True)
    known = rows.groupBy("pos").agg(*(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("c0", "c1", "r1", "r2"))).where("pos >= 0")
    known = cut(known.withColumn("other", (residue != 0).cast("long")))
    # a suffix at 0 modulo 3 against those at 1 by the symbol and the rank behind it, against those at 2 by two symbols and the rank behind them
    first, _ = running(by_range(known.where(residue != 2).select("pos", "other", "c0", "r1"), ["c0", "r1", "pos"]), "other", "ahead")
    second, _ = running(by_range(known.where(residue != 1).select("pos", "other", "c0", "c1", "r2"), ["c0", "c1", "r2", "pos"]), "other", "ahead")
    zeros = first.where("other = 0").select("pos", "ahead").unionByName(second.where("other = 0").select("pos", "ahead")).groupBy("pos").agg(F.sum("ahead").alias("k"))
    own = known.where("other = 0").select("pos", "c0", "r1")
    zeros = zeros.join(own, "pos").select("pos", "k", F.lit(0).cast("long").alias("kind"), "c0", "r1")
    nothing = F.lit(0).cast("long")
    merged = zeros.unionByName(ranked.select("pos", "k", F.lit(1).cast("long").alias("kind"), nothing.alias("c0"), nothing.alias("r1")))
    merged = by_range(merged, ["k", "kind", "c0", "r1", "pos"])
    return running(merged.select("pos", "part", F.lit(1).cast("long").alias("one")), "one", "rank")[0].select("pos", "rank")


def repeated_in_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `rows` (rank, keys, ...) whose neighbour by rank, before or behind, has equal keys."""
    ordered = by_range(rows, ["rank"])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last = 0, [], None
        for batch in batches:
            if batch.num_rows:
                held = _columns(batch, keys)
                part, first, last = _part(batch), first or held[0].tolist(), held[-1].tolist()
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *(pa.array([x], pa.list_(pa.int64())) for x in (first, last))], ["part", "first", "last"])

    found = sorted(ordered.select("part", *keys).mapInArrow(edges, "part int, first array<long>, last array<long>").collect(), key=lambda r: r["part"])
    before = {r["part"]: p["last"] for p, r in zip(found[:-1], found[1:], strict=True)}
    behind = {p["part"]: r["first"] for p, r in zip(found[:-1], found[1:], strict=True)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None

        def hits(batch: pa.RecordBatch, following: list | None) -> pa.RecordBatch:
            held = _columns(batch, keys)
            same = ~_changes(held, None if last is None else np.array(last))
            after = np.r_[same[1:], following is not None and held[-1].tolist() == list(following)]
            return batch.filter(pa.array(same | after))

        for batch in batches:
            if batch.num_rows:
                if kept is None:
                    last = before.get(_part(batch))
                else:
                    yield hits(kept, _columns(batch.slice(0, 1), keys)[0].tolist())
                    last = _columns(kept.slice(kept.num_rows - 1, 1), keys)[0].tolist()
                kept = batch
        if kept is not None:
            yield hits(kept, behind.get(_part(kept)))

    return ordered.mapInArrow(run, ordered.schema)
