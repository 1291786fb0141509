"""Token counts of whole texts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quarry.llm.bpe import vocabulary
from quarry.llm.common import id_and_text, text_pieces

#: Pre-tokens whose counts a task remembers; beyond that it starts anew.
REMEMBERED = 400_000


def count_tokens(docs: DataFrame, vocab_path: str, limit: int = 1024) -> DataFrame:
    """Columns doc_id, n_bytes, n_tokens, over_limit, one row for each row of `docs`.

    A null text is empty and has 0 bytes and tokens. Special strings count as one token each, as the
    vocabulary's library has it by default. Rows are independent: repeated rows give repeated results,
    further columns are ignored, an empty table gives an empty one. There is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, known = vocabulary(vocab_path), {}
        for batch in batches:
            totals: list[int] = []
            for a, b in text_pieces(batch, "text"):
                split = [vocab.pieces(t or "") for t in batch.column("text").slice(a, b - a).to_pylist()]
                fresh = list({w for words, _ in split for w in words if w not in known})
                if len(known) + len(fresh) > REMEMBERED:
                    known.clear()
                    fresh = list({w for words, _ in split for w in words})
                if fresh:
                    known.update(zip(fresh, vocab.merger.counts([w.encode() for w in fresh]).tolist(), strict=True))
                totals += [sum(map(known.__getitem__, words)) + special for words, special in split]
            n = pa.array(totals, pa.int64())
            size = pc.cast(pc.fill_null(pc.binary_length(batch.column("text")), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
