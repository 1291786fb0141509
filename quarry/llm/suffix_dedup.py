"""Repeated substrings: candidates by content-defined anchors, a difference-cover suffix sort, adjacent prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, text_pieces, written
from quarry.llm.suffix_array import LONGEST, repeated_starts
from quarry.llm.suffix_spark import SEPARATORS, by_range, repeated_in_order, running, suffix_ranks, windows_of_pieces
from quarry.llm.textnp import _power_tables, buffers, mix

#: Bytes of the strings whose hashes pick anchors.
GRAM = 32
#: Text of one anchor's strings that one task sorts; larger groups are dealt by the ends of their strings first, and what is larger still is sorted over all executors.
GROUP_BYTES = LONGEST
#: Classes of equal stretches that hold more than one in so many rows of a partition's share are joined apart.
_HOT_SHARE = 8
#: Text of several anchors that is sorted together.
BLOCK_BYTES = 1 << 19
ANCHOR = "doc_id long, row long, anchor long, d1 long, d2 long, first int, n int"
PIECE = "doc_id long, row long, anchor long, large boolean, first int, n int, count long, held binary"


def owned_starts(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Ranges of starts with one anchor: (text, first start in the text, number, anchor hash, digest of all their bytes as two integers).

    The anchor of a start is the string of GRAM bytes with the least hash among those inside the `length` bytes
    that begin there, the rightmost on ties: equal strings have equal anchors at equal places. So a string can
    repeat only where its anchor does, and each start belongs to one anchor. Hashes are compared without their lowest
    bits, as many as a place within a window takes: the same ones whatever the size of the texts.
    """
    n, window = len(raw), length - GRAM + 1
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64)) + (np.zeros((0, 2), np.int64),)
    if n < length:
        return none
    grams = _gram_hashes(raw)
    m = len(grams)
    low = (np.uint64(1) << np.uint64(window.bit_length())) - np.uint64(1)
    keyed = np.full(-(-m // window) * window, np.iinfo(np.uint64).max, np.uint64)
    keyed[:m] = (grams & ~low) | (low - (np.arange(m, dtype=np.uint64) % np.uint64(window)))  # the later place is the lesser
    blocks = keyed.reshape(-1, window)
    starts = n - length + 1
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()[window - 1 : window - 1 + starts]
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[:starts]
    place = np.arange(starts)
    block = place // window * window
    later = (ahead & ~low) <= (behind & ~low)  # in the block behind it, or in its own if the start begins it
    next_block = (place + window - 1) // window * window
    owner = np.where(later, next_block + (low - (ahead & low)).astype(np.int64), block + (low - (behind & low)).astype(np.int64))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:starts]
    owner[place + length > offsets[text + 1]] = -1
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    last = np.r_[first[1:], starts]
    real = owner[first] >= 0
    first, last = first[real], last[real]
    at, text = owner[first], text[first]
    return text, first - offsets[text], last - first, grams[at], _digests(raw, first, last - 1 + length)


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    n = len(raw)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    return mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])


def _digests(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128 bits of BLAKE2b of each range of bytes: equal digests count as equal bytes."""
    held = memoryview(raw.tobytes())
    found = b"".join([hashlib.blake2b(held[a:b], digest_size=16).digest() for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_pieces(batch, "text"):
                part = batch.slice(a, b - a)
                text, first, n, anchor, digest = owned_starts(*buffers(part.column("text")), length)
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("row").take(at), pa.array(anchor.view(np.int64)), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["doc_id", "row", "anchor", "d1", "d2", "first", "n"],
                )

    return run


def _cutter(length: int):
    """The bytes of each range of starts of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, row, anchor, large, first, n, count, held = [], [], [], [], [], [], [], []
            for d, r, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text", "ranges")), strict=True):
                data = text.encode()
                for x in ranges:
                    doc.append(d)
                    row.append(r)
                    anchor.append(x["anchor"])
                    large.append(x["large"])
                    first.append(x["first"])
                    n.append(x["n"])
                    count.append(x["count"])
                    held.append(data[x["first"] : x["first"] + x["n"] - 1 + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(row, pa.int64()), pa.array(anchor, pa.int64()), pa.array(large, pa.bool_()), pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(count, pa.int64()), pa.array(held, pa.binary())],
                ["doc_id", "row", "anchor", "large", "first", "n", "count", "held"],
            )

    return run


def _sorter(length: int):
    """Suffix-sorts the strings of whole anchors, many anchors at once, and reports the starts of single strings that repeat."""

    def sort(rows: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        text = np.frombuffer(b"".join(x[-1] for x in rows), np.uint8)
        sizes = np.array([len(x[-1]) for x in rows])
        n = np.array([x[4] for x in rows])
        begin = np.cumsum(sizes) - sizes
        ends = np.cumsum(n)
        starts = np.arange(int(ends[-1])) + np.repeat(begin - (ends - n), n)
        hit = repeated_starts(text, starts, length)
        for x, a, b in zip(rows, (ends - n).tolist(), ends.tolist(), strict=True):
            if x[5] == 1 and hit[a:b].any():
                own = np.r_[False, hit[a:b], False]
                edge = np.flatnonzero(own[1:] != own[:-1])
                for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    yield x[0], x[1], x[3] + s, e - s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, block, size, out = [], [], 0, []

        def close() -> None:
            nonlocal group, block, size
            new = sum(len(x[-1]) for x in group)
            if block and size + new > BLOCK_BYTES:
                out.extend(sort(block))
                block, size = [], 0
            block, size, group = block + group, size + new, []

        def taken() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["doc_id", "row", "first", "n"])

        for batch in batches:
            for x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "anchor", "first", "n", "count", "held")), strict=True):
                if group and group[0][2] != x[2]:
                    close()
                group.append(x)
            yield taken()
        if group:
            close()
        if block:
            out.extend(sort(block))
        yield taken()

    return run


def _ends(length: int):
    """The starts of pieces, each with a hash of the anchor and of the first and last GRAM bytes of its string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "n", "held")]
            sizes = np.array(columns[1], np.int64)
            keys = [np.zeros(0, np.uint64)]
            for anchor, n, held in zip(*columns, strict=True):
                g = _gram_hashes(np.frombuffer(held, np.uint8))
                keys.append(mix(g[:n] * np.uint64(0x9E3779B97F4A7C15) + g[length - GRAM : length - GRAM + n] + np.uint64(anchor % (1 << 64))))
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in ("doc_id", "row", "first")), pa.array(place.astype(np.int32)), pa.array(np.concatenate(keys).view(np.int64))], ["doc_id", "row", "first", "place", "key"]
            )

    return run


def _single(length: int):
    """The strings at given places of pieces, as pieces of one start whose anchor is the key of their ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "row", "first", "count", "held", "places")
        for batch in batches:
            rows = [
                (d, r, x["key"], x["large"], first + x["place"], 1, count, held[x["place"] : x["place"] + length])
                for d, r, first, count, held, places in zip(*(batch.column(c).to_pylist() for c in names), strict=True)
                for x in places
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 8
            types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "row", "anchor", "large", "first", "n", "count", "held"])

    return run


def dealt_by_ends(pieces: DataFrame, length: int, group_bytes: int, parts: int) -> DataFrame:
    """The strings of large anchors that agree in their first and last GRAM bytes with another, as pieces of their own: any two equal ones do."""
    starts = written(pieces.mapInArrow(_ends(length), "doc_id long, row long, first int, place int, key long"), "repeat-ends")
    keys = cut(starts.groupBy("key").agg(F.count("*").alias("places")).where("places > 1"))
    kept = _held_by(starts, keys, ["key"], "places", starts.count(), parts)
    large = cut(keys.where(F.col("places") * length > group_bytes).select("key", F.lit(True).alias("large")))  # one for each group_bytes of text at most
    marked = kept.join(large, "key", "left").groupBy("doc_id", "row", "first").agg(F.collect_list(F.struct("place", "key", F.coalesce("large", F.lit(False)).alias("large"))).alias("places"))
    same = F.col("p.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("p.row") == F.col("m.row")) & (F.col("p.first") == F.col("m.first"))
    joined = pieces.alias("p").join(marked.alias("m"), same).select("p.doc_id", "p.row", "p.first", "p.count", "p.held", "m.places")
    return written(joined.mapInArrow(_single(length), PIECE), "repeat-single")


def _starts(length: int):
    """The single strings of pieces (base, ...): their place and the digest of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, r, first, n, count, base, held in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "first", "n", "count", "base", "held")), strict=True):
                begin = np.arange(n)
                digest = _digests(np.frombuffer(held, np.uint8), begin, begin + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + begin), pa.array([d] * n, pa.int64()), pa.array([r] * n, pa.int64()), pa.array((first + begin).astype(np.int32)), pa.array([count] * n, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1])],
                    ["pos", "doc_id", "row", "first", "count", "d1", "d2"],
                )

    return run


def sorted_over_all(pieces: DataFrame, length: int) -> DataFrame:
    """doc_id, row, first, n of the single strings that repeat among `pieces`, by one suffix sort over all executors whose neighbours are compared."""
    sized = pieces.withColumn("size", F.length("held").cast("long") + SEPARATORS)
    based, total = running(by_range(sized, ["anchor", "doc_id", "row", "first"]), "size", "base")
    based = written(based, "repeat-based")
    ranks = suffix_ranks(windows_of_pieces(based), total, length)
    starts = based.mapInArrow(_starts(length), "pos long, doc_id long, row long, first int, count long, d1 long, d2 long")
    hits = repeated_in_order(starts.join(ranks, "pos").drop("pos"), ["d1", "d2"])
    return hits.where("count = 1").select("doc_id", "row", "first", F.lit(1).alias("n"))


def _remover(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digests, kept_texts = [], [], [], [], []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                data, out, at, gone, count = (text or "").encode(), [], 0, 0, 0
                reach = -1
                for x in sorted(ranges or (), key=lambda x: x["first"]):
                    a, b = x["first"], x["first"] + x["n"] - 1 + length
                    if a > reach:
                        out.append(data[max(at, 0) : a])
                        count += 1
                        gone -= a
                    else:
                        gone -= reach
                        b = max(b, reach)
                    gone += b
                    at = reach = b
                out.append(data[at:])
                kept = b"".join(out)
                sizes.append(len(data))
                removed.append(gone)
                spans.append(count)
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_texts, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def _held_by(rows: DataFrame, found: DataFrame, keys: list[str], places: str, total: int, parts: int) -> DataFrame:
    """The rows whose keys stand in `found` (keys, `places`: rows that have them).

    Keys with more than 1/_HOT_SHARE of a partition's share of all rows are so few (_HOT_SHARE * parts at most) that
    they are broadcast, and their rows are not shuffled by key; so no task gets more rows of one key than that.
    """
    most = max(1, total // (_HOT_SHARE * parts))
    hot = cut(found.where(F.col(places) > most).select(*keys))
    rest = rows.join(F.broadcast(hot), keys, "left_anti").join(found.where(F.col(places) <= most).select(*keys), keys, "left_semi")
    return rows.join(F.broadcast(hot), keys, "left_semi").unionByName(rest)


def repeated_ranges(docs: DataFrame, length: int = 200, group_bytes: int = GROUP_BYTES) -> dict[str, DataFrame]:
    """doc_id, row, first, n: ranges of starts in a row's bytes at which a string of `length` bytes begins that begins elsewhere too. `docs` has doc_id, row, text.

    By the route that found them: "equal" stretches; those "sorted" within tasks; of anchors with more than `group_bytes`
    of text, strings "sorted by ends" within tasks, and those "sorted over all" where equal ends still hold more than that.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchors = written(docs.mapInArrow(_anchors(length), ANCHOR), "repeat-anchors")
    shared = cut(anchors.groupBy("anchor").agg(F.count("*").alias("places")).where("places > 1"))
    anchors = written(_held_by(anchors, shared, ["anchor"], "places", anchors.count(), parts).repartition(parts), "repeat-shared")
    # equal digests are equal stretches of text: all their starts repeat, without a look at the text
    key, one = ["anchor", "d1", "d2"], F.struct("doc_id", "row", "first", "n")
    classes = written(anchors.groupBy(*key).agg(F.count("*").alias("count"), F.min(one).alias("one")), "repeat-classes")
    whole = _held_by(anchors, classes.where("count > 1"), key, "count", anchors.count(), parts).select("doc_id", "row", "first", "n")
    text = F.sum(F.col("one.n") + (length - 1)).alias("size")
    mixed = cut(classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("count").alias("least"), text).where("kinds > 1 and least = 1").select("anchor", (F.col("size") > group_bytes).alias("large")))
    todo = classes.join(mixed, "anchor").select("one.doc_id", "one.row", F.struct("anchor", "large", "one.first", "one.n", "count").alias("x"))
    todo = todo.groupBy("doc_id", "row").agg(F.collect_list("x").alias("ranges"))
    same = docs.alias("d").join(todo.alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("d.row") == F.col("t.row")))
    pieces = same.select("d.doc_id", "d.row", "d.text", "t.ranges").mapInArrow(_cutter(length), PIECE)
    pieces = written(pieces, "repeat-pieces")

    def in_tasks(rows: DataFrame) -> DataFrame:
        dealt = rows.where("not large").drop("large").repartition(parts, "anchor").sortWithinPartitions("anchor")
        return dealt.mapInArrow(_sorter(length), "doc_id long, row long, first int, n int")

    found = {"equal": whole, "sorted": in_tasks(pieces)}
    large = pieces.where("large")
    if not large.isEmpty():
        single = dealt_by_ends(large, length, group_bytes, parts)
        found["sorted by ends"] = in_tasks(single)
        if not single.where("large").isEmpty():
            found["sorted over all"] = sorted_over_all(single.where("large").drop("large"), length)
    return found


def remove_repeats(docs: DataFrame, length: int = 200, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    Every byte covered by a string of `length` bytes that begins anywhere else as well, in the same text or
    another, is removed; all copies go. Strings are judged on the input and never cross texts. Null and empty
    texts, and those shorter than `length`, lose nothing. Rows that repeat a doc_id are texts of their own; an
    empty table gives an empty result. Further columns, whatever their names, are not read; texts of any length count
    whole.

    Rows are shuffled by anchor, about one for each 85 bytes; texts meet by row twice. Only stretches whose anchor
    repeats with different surroundings are suffix-sorted: groups of up to `group_bytes` of text in tasks, those of
    more, which have equal ends as well, together over all executors.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("row"))
    found = reduce(DataFrame.unionByName, repeated_ranges(texts, length, group_bytes).values())
    ranges = found.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.collect_list(F.struct("first", "n")).alias("ranges"))
    joined = texts.join(ranges, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(_remover(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
