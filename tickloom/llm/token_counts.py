"""Token counts by a tokenizer compiled to finite-state transducers (see ``bpe_fst``)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.bpe_fst import BLOCK, Transducer
from tickloom.llm.common import blocks_of, text_bytes, valid_utf8


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    Counts equal those of the library for byte-level BPE files, without begin or
    end tokens and with special strings in the text as special tokens. One
    output row per input row: rows with a repeated or null key keep their own
    counts. A null text counts as empty (0 tokens). Bytes that are not UTF-8
    count as U+FFFD for tokens. Other columns are ignored, whatever their names.
    Nothing is shuffled.
    """
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.of(vocabulary)
        for part in parts:
            for rows in blocks_of(part, BLOCK):
                texts = [data for _, data in rows]
                counts = machine.count(valid_utf8(texts))
                yield pa.record_batch([pa.array([k for k, _ in rows], part.column(0).type), pa.array(list(map(len, texts)), pa.int64()), pa.array(counts, pa.int64())], names=[key, "n_bytes", "n_tokens"])

    counted = docs.select(F.col(key), text_bytes(text).alias("text")).mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
