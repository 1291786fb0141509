"""Token ids as frequency-ranked, byte-aligned variable-length codes with separate control bytes."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.bpe import is_plain, plain_tokens, pre_tokens, token_hashes, vocabulary
from quarry.llm.common import id_and_text, shared_path, small_batches, text_pieces, written

REMEMBERED = 700_000
END_ID = 0
#: Pre-tokens of a space and letters that share a call of the library.
_JOINED = 2000
#: The format's schema: one row for each document, rows ascending by doc_id within a shard and over the shards; place: ids of the shard before it.
FILE_SCHEMA = "shard int, place long, doc_id long, n_tokens long, control binary, data binary"

#: For each control byte: the byte lengths of its four codes.
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def _control_places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each code its place among the control pairs, where each document begins a new byte; and the documents' byte offsets."""
    offsets = np.r_[0, np.cumsum(-(-counts // 4))]
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(4 * offsets[:-1] - (ends - counts), counts), offsets


def encode_codes(codes: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """(control, data) of each document: two bits of length for each code, four codes a control byte; data little-endian."""
    codes = codes.astype("<u4")
    size = (1 + (codes > 0xFF) + (codes > 0xFFFF) + (codes > 0xFFFFFF)).astype(np.uint8)
    place, offsets = _control_places(counts)
    padded = np.zeros(4 * int(offsets[-1]), np.uint8)
    padded[place] = size - 1
    p = padded.reshape(-1, 4)
    control = (p[:, 0] | p[:, 1] << 2 | p[:, 2] << 4 | p[:, 3] << 6).tobytes()
    data = codes.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) < size[:, None]].tobytes()
    stops = np.r_[0, np.cumsum(size, dtype=np.int64)][np.r_[0, np.cumsum(counts)]].tolist()
    at = offsets.tolist()
    return [control[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], [data[x:y] for x, y in zip(stops[:-1], stops[1:], strict=True)]


def decode_codes(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The codes of some documents again: lengths by table lookup of the control bytes, then a masked scatter of the data bytes."""
    place, _ = _control_places(counts)
    size = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[place]
    out = np.zeros((len(place), 4), np.uint8)
    out[np.arange(4, dtype=np.uint8) < size[:, None]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")


def _runs(counts: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of `most` codes at most, or of one row."""
    ends, a = np.cumsum(counts), 0
    while a < len(counts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


class _Places(dict):
    """Numbers of pre-tokens; a new one gets the next number and is noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


class _Encoder:
    """Ids of texts; a pre-token goes through the library once and is then looked up."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.vocab, self.tokenizer = vocabulary(path), Tokenizer.from_file(path)
        self._reset()

    def _reset(self) -> None:
        self.place, self.by_hash = _Places(), {}
        self.flat, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Encode the noted pre-tokens. Those of a space and letters stay apart when joined, so they share calls."""
        fresh, self.place.fresh = self.place.fresh, []
        joined = [k for k, w in enumerate(fresh) if w[0] == " " and w[1:].isalpha()]
        size = np.zeros(len(fresh), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        alone: list[int] = []
        for a in range(0, len(joined), _JOINED):
            own = np.array(joined[a : a + _JOINED])
            e = self.tokenizer.encode("".join([fresh[k] for k in own]), add_special_tokens=False)
            n = np.bincount(np.array(e.word_ids, np.int64), minlength=len(own))
            if len(n) != len(own) or not n.all():  # the library knows other letters: one by one
                alone += own.tolist()
                continue
            size[own] = n
            parts.append((own, np.array(e.ids, np.uint32)))
        rest = sorted((set(range(len(fresh))) - set(joined)) | set(alone))
        got = [e.ids for e in self.tokenizer.encode_batch([fresh[k] for k in rest], add_special_tokens=False)]
        size[rest] = [len(x) for x in got]
        parts.append((np.array(rest, np.int64), np.fromiter(chain.from_iterable(got), np.uint32)))
        order = np.concatenate([k for k, _ in parts])
        begin = np.zeros(len(fresh), np.int64)
        begin[order] = len(self.flat) + np.cumsum(size[order]) - size[order]
        self.begin, self.size = np.r_[self.begin, begin], np.r_[self.size, size]
        self.flat = np.concatenate([self.flat, *(x for _, x in parts)])

    def _numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pre-tokens of all texts, and how many each text has. Plain texts are split and looked up by hash, once for each distinct token of the call."""
        plain = [k for k, t in enumerate(texts) if is_plain(t) and not any(x in t for x in self.vocab.special)]
        joined, begin, end, counts = plain_tokens([texts[k] for k in plain])
        hashes, where, inverse = np.unique(token_hashes(joined, begin, end), return_index=True, return_inverse=True)
        numbers = np.fromiter((self.by_hash.get(h, -1) for h in hashes.tolist()), np.int64, len(hashes))
        for k in np.flatnonzero(numbers < 0).tolist():
            numbers[k] = self.by_hash[int(hashes[k])] = self.place[joined[begin[where[k]] : end[where[k]]]]
        found = numbers[inverse]
        if len(plain) == len(texts):
            return found, counts
        parts = dict(zip(plain, np.split(found, np.cumsum(counts)[:-1]), strict=True)) if plain else {}
        for k in sorted(set(range(len(texts))) - set(plain)):
            pieces = self.vocab.parts(texts[k])
            words = [w for j, p in enumerate(pieces) for w in ([p] if j % 2 else pre_tokens(p))]
            parts[k] = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        ordered = [parts[k] for k in range(len(texts))]
        return np.concatenate(ordered), np.array([len(x) for x in ordered], np.int64)

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the number of each text."""
        if len(self.place) > REMEMBERED:
            self._reset()
        at, counts = self._numbers([t or "" for t in texts])
        if self.place.fresh:
            self._learn()
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.begin[at] - (ends - size), size) + np.arange(total)]
        return ids, np.diff(np.r_[0, ends][np.r_[0, np.cumsum(counts)]])


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    """One encoder for all tasks of a Python worker: what one task has learnt serves the next."""
    return _Encoder(path)


def token_table(docs: DataFrame, vocab_path: str, end_id: int = END_ID) -> DataFrame:
    """Ids of all documents and how often each id occurs, in one table in the shared folder.

    kind 0: a document (id = doc_id, n = its ids, ids = them as little-endian 32- or 16-bit integers);
    kind 1: a count (id = token id, n = occurrences in one task).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = _encoder(vocab_path), np.zeros(0, np.int64)
        schema = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for a, b in text_pieces(batch, "text"):
                ids, sizes = encoder.ids(batch.column("text").slice(a, b - a).to_pylist())
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                counts = np.bincount(ids)
                if len(counts) > len(seen):
                    seen = np.r_[seen, np.zeros(len(counts) - len(seen), np.int64)]
                seen[: len(counts)] += counts
                stops = ends + np.arange(1, len(ends) + 1)
                narrow = ids.astype("<u2") if len(ids) and ids.max() < 1 << 16 else None
                held = (ids if narrow is None else narrow).tobytes()
                width = 4 if narrow is None else 2
                rows = [held[s * width : e * width] for s, e in zip(np.r_[0, stops[:-1]].tolist(), stops.tolist(), strict=True)]
                n = b - a
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), batch.column("doc_id").slice(a, n), pa.array(sizes + 1), pa.array(rows, pa.binary())], schema=schema)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(used), np.int32)), pa.array(used), pa.array(seen[used]), pa.nulls(len(used), pa.binary())], schema=schema)

    with small_batches(docs.sparkSession):
        return written(id_and_text(docs).mapInArrow(run, "kind int, id long, n long, ids binary"), "token-ids")


def rank_table(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(rank_of[id], id_of[rank]): rank 0 for the most frequent id, ties to the smaller id. At most one row for each id of the vocabulary comes to the driver."""
    rows = tokens.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).collect()
    id_of = np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], np.uint32)
    rank_of = np.zeros(int(id_of.max(initial=0)) + 1, np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    return rank_of, id_of


def write_token_files(docs: DataFrame, path: str, vocab_path: str, shards: int | None = None) -> np.ndarray:
    """Encode all documents into `path`; returns id_of[rank], which a reader needs.

    Rows stand in ascending doc_id order within each shard and from shard to shard; equal doc_ids keep
    all their rows, by length and ids. A null text holds the end id alone; null doc_ids come first. Texts of any length
    are encoded whole; further columns, whatever their names, are not read. An empty table writes no row.
    """
    tokens = token_table(docs, vocab_path)
    rank, id_of = rank_table(tokens)
    parts = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            counts = batch.column("n").to_numpy(zero_copy_only=False)
            for a, b in _runs(counts):
                n, held = counts[a:b], batch.column("ids").slice(a, b - a).to_pylist()
                ids = np.concatenate([np.frombuffer(x, "<u2" if len(x) == 2 * k else "<u4") for x, k in zip(held, n.tolist(), strict=True)])
                control, data = encode_codes(rank[ids], n)
                ends = place + np.cumsum(n)
                place = int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b - a, shard, np.int32)), pa.array(ends - n), batch.column("id").slice(a, b - a), pa.array(n), pa.array(control, pa.binary()), pa.array(data, pa.binary())],
                    ["shard", "place", "doc_id", "n_tokens", "control", "data"],
                )

    rows = tokens.where("kind = 0").select("id", "n", "ids").repartitionByRange(parts, "id").sortWithinPartitions("id", "n", "ids")
    rows.mapInArrow(encode, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)
    return id_of


def read_token_files(spark: SparkSession, path: str, id_of: np.ndarray) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it, in the files' own order), n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sums = batch.column("n_tokens").to_numpy(zero_copy_only=False), []
            for a, b in _runs(counts):
                n = counts[a:b]
                codes = decode_codes(*(b"".join(batch.column(c).slice(a, b - a).to_pylist()) for c in ("control", "data")), n)
                held = id_of[codes].astype("<u4").tobytes()
                stops = np.r_[0, 4 * np.cumsum(n)].tolist()
                sums += [zlib.crc32(held[x:y]) for x, y in zip(stops[:-1], stops[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("shard", "place", "doc_id", "n_tokens")), pa.array(sums, pa.int64())], ["shard", "place", "doc_id", "n_tokens", "ids_crc32"])

    read = spark.read.schema(FILE_SCHEMA).parquet(path).mapInArrow(decode, "shard int, place long, doc_id long, n_tokens long, ids_crc32 long")
    totals = spark.read.schema(FILE_SCHEMA).parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    before = totals.select("shard", (F.sum("held").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("held")).alias("before"))
    # one row for each shard: a bounded table
    return read.join(F.broadcast(before), "shard").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Write the token files of `docs` to the shared folder and read them back; see read_token_files."""
    path = shared_path(docs.sparkSession, "token-files")
    id_of = write_token_files(docs, path, vocab_path)
    return read_token_files(docs.sparkSession, path, id_of)
