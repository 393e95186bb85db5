"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two of at most
``capacity``: full pieces first, then the binary digits of the rest from large to small.
Every piece is one sequence, so no sequence crosses documents and none needs padding;
sequences of one length form a bucket, and a batch is drawn from one bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import binary_column, binary_parts, slices, text_bytes, tidied
from tierline.llm.tokens import default_tokenizer, encoder

CAPACITY = 2048
END_ID = 1


def piece_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of n tokens, in order."""
    out, rest = [capacity] * (n // capacity), n % capacity
    while rest:
        out.append(1 << (rest.bit_length() - 1))
        rest -= out[-1]
    return out


def _pack(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = encoder(path).encode(*binary_parts(part.column("text")))
                cuts = [piece_lengths(int(n) + 1, capacity) for n in np.diff(at)]
                row, start, length, tokens, total = [], [], [], [], []
                for i, cut in enumerate(cuts):
                    packed = ids[at[i]:at[i + 1]].astype("<u4").tobytes() + tail
                    here = 0
                    for n in cut:
                        row.append(i)
                        start.append(here)
                        length.append(n)
                        tokens.append(packed[4 * here:4 * (here + n)])
                        here += n
                    total.extend([here] * len(cut))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), binary_column(tokens),
                     pa.array([zlib.crc32(t) for t in tokens], pa.int64()), pa.array(total, pa.int64())],
                    names=["doc_id", "start", "length", "token_bytes", "ids_crc32", "doc_tokens"])

    return tidied(run)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, token_bytes, ids_crc32, doc_tokens,
    bucket, sequence_id, offset``.

    ``token_bytes`` holds the ids as little-endian 32-bit integers; ``bucket`` is the
    power of two.  ``tokenizer`` is the path of a word_bpe_49k file.  NULL text counts as
    empty: one piece with the end id alone.  Ids may be NULL or repeat, each row is packed
    by itself.  Sequence ids are unique and depend only on the input's partitions and
    their row order, so a task that runs again gives the same ones.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path = tokenizer or default_tokenizer()
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    pieces = base.mapInArrow(_pack(path, capacity, end_id), "doc_id long, start long, length long, "
                             "token_bytes binary, ids_crc32 long, doc_tokens long")
    return (pieces.withColumn("bucket", F.log2(F.col("length").cast("double")).cast("int"))
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(packed: DataFrame, path: str) -> None:
    """The sequences themselves, one folder per length."""
    (packed.select("bucket", "sequence_id", "doc_id", "start", "length", "token_bytes")
     .write.partitionBy("bucket").parquet(path))
