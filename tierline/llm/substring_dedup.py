"""Substring deduplication by seed and extend.

A window is ``window`` consecutive words.  A word goes when a window over it also starts
in a document with a smaller id; the first document keeps its text.

1. Seeds.  Winnowing picks, in every window, the ``gram``-word run with the smallest
   fingerprint.  The choice depends on the window's words alone, so equal windows have
   equal anchors, and neighbouring windows mostly share one: some 2 anchors per
   ``window - gram + 2`` words.
2. Anchors in one document only are dropped by a grouped minimum and maximum of the ids.
   This is the join on anchors, taken against the earliest document in place of all pairs.
3. Extension.  An anchor is extended both ways over the windows it stands for, and the
   whole extent is one fingerprint.  If all occurrences of an anchor have the same extent,
   the match runs through them all, and every later document's extent goes.  Only where
   extents differ (at the ends of a passage) are the windows compared one by one, against
   the earliest document that has the same one.
4. Overlapping and touching extents of a document merge into its maximal repeats.

All grouping is by partial minima and maxima and by joins that split, so a passage in a
third of all documents is no hot spot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import words as W
from tierline.llm.common import binary_column, binary_parts, drop_staged, slices, stage, text_bytes, tidied

WINDOW = 13
GRAM = 6
_SEED = 29
_SPAN = "array<struct<at:long,n:long>>"


def window_hashes(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(word fingerprints, first word of each text, window fingerprints, text of each
    window, index of each window's first word), texts in turn."""
    hashes, first = W.word_hashes(data, offsets, lower=False)
    of = W.owner(first)
    count = max(0, len(hashes) - window + 1)
    inside = np.flatnonzero(of[:count] == of[window - 1:window - 1 + count])
    return hashes, first, W.ngrams(hashes, window, _SEED)[inside], of[inside], inside


def anchor_runs(hashes: np.ndarray, inside: np.ndarray, of: np.ndarray, gram: int,
                window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with the same anchor: index of the first window (into
    ``inside``), number of windows, anchor fingerprint."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, W.U64)
    grams = W.ngrams(hashes, gram, _SEED + 1)
    best, place = grams[inside].copy(), inside.copy()
    for j in range(1, window - gram + 1):
        other = grams[inside + j]
        less = other < best
        best[less] = other[less]
        place[less] = inside[less] + j
    new = np.ones(len(inside), bool)
    new[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1])
    begin = np.flatnonzero(new)
    return begin, np.diff(np.append(begin, len(inside))), best[begin]


def _anchors(window: int, gram: int):
    """Rows (gram, extent, doc_id, at, n): an anchor, the fingerprint of the windows it
    stands for, the first of them in its document and how many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, first, prints, of, inside = window_hashes(*binary_parts(part.column("text")), window)
                begin, n, key = anchor_runs(hashes, inside, of, gram, window)
                total = np.zeros(len(prints) + 1, W.U64)
                np.cumsum(prints, out=total[1:])
                extent = W.mix(total[begin + n] - total[begin] + n.astype(W.U64))
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(extent.view(np.int64)), pa.array(ids[of[begin]]),
                     pa.array(inside[begin] - first[of[begin]]), pa.array(n)],
                    names=["gram", "extent", "doc_id", "at", "n"])

    return tidied(run)


def _windows(window: int):
    """Rows (print, doc_id, at) of the windows in a document's listed spans: one per
    distinct window, with all its places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, first, prints, of, inside = window_hashes(*binary_parts(part.column("text")), window)
                begin = np.searchsorted(of, np.arange(part.num_rows + 1))
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                doc, want = [], []
                for i, (start, n) in enumerate(_spans(part.column("spans"))):
                    at = np.unique(np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum()))
                    want.append(at[at < begin[i + 1] - begin[i]])
                    doc.append(np.full(len(want[-1]), i))
                doc, want = np.concatenate(doc), np.concatenate(want).astype(np.int64)
                key = prints[begin[doc] + want]
                order = np.lexsort((key, doc))
                doc, want, key = doc[order], want[order], key[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                cuts = np.flatnonzero(new)
                places = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(key)), pa.int32()), pa.array(want))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[cuts].view(np.int64)), pa.array(ids[doc[cuts]].astype(np.int64)), places],
                    names=["print", "doc_id", "at"])

    return tidied(run)


def _spans(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(at, n) arrays of each row of an array<struct<at, n>> column."""
    none = np.zeros(0, np.int64)
    for v in column:
        yield (v.values.field("at").to_numpy(), v.values.field("n").to_numpy()) if v.is_valid else (none, none)


def _cut(window: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in slices(b, "text")):
            total, gone, sha, kept, spans = [], [], [], [], []
            for text, (at, n) in zip(batch.column("text"), _spans(batch.column("spans"))):
                pieces = text.as_py().split()
                edge = np.zeros(len(pieces) + 1, np.int64)
                at = np.minimum(at, len(pieces))
                np.add.at(edge, at, 1)
                np.add.at(edge, np.minimum(at + n + window - 1, len(pieces)), -1)
                hit = np.cumsum(edge[:-1]) > 0
                flips = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                total.append(len(pieces))
                gone.append(int(hit.sum()))
                rest = b" ".join([p for p, h in zip(pieces, hit.tolist()) if not h]) if gone[-1] else b" ".join(pieces)
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode("utf-8", "replace") if keep_text else None)
                spans.append([{"at": int(a), "n": int(b - a)} for a, b in zip(flips[::2], flips[1::2])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha),
                 pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())])))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "repeats"])

    return tidied(run)


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                    id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256, kept_text,
    repeats`` (maximal runs of removed words, as word index and length).

    Words are runs of bytes other than ASCII white space, unchanged.  NULL and empty texts
    have none.  Passages repeated within one document stay.  Ids are integers; rows that
    repeat an id count as one document (their spans are pooled).  A row with a NULL id
    keeps all its words and is no source.  Other columns are ignored.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    known = base.where(F.col("doc_id").isNotNull())
    anchors = known.mapInArrow(_anchors(window, gram), "gram long, extent long, doc_id long, at long, n long")
    shared = stage(spark, anchors.groupBy("gram").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
        F.min("extent").alias("low"), F.max("extent").alias("high"))
        .where("first < last").select("gram", "first", (F.col("low") != F.col("high")).alias("differ")), "op6-shared")
    hits = stage(spark, anchors.select("gram", "doc_id", "at", "n").join(shared, "gram")
                 .where("differ OR doc_id > first").select("doc_id", "at", "n", "differ"), "op6-hits")
    drop_staged(spark, shared)

    def spans_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).cast(_SPAN).alias("spans"))

    windows = stage(spark, known.join(spans_of(hits.where("differ")), "doc_id")
                    .mapInArrow(_windows(window), "print long, doc_id long, at array<long>"), "op6-windows")
    earliest = stage(spark, windows.groupBy("print").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                     .where("first < last").select("print", "first"), "op6-earliest")   # written: the join can split
    ends = (windows.join(earliest, "print").where("doc_id > first")
            .select("doc_id", F.explode("at").alias("at"), F.lit(1).cast("long").alias("n")))
    spans = stage(spark, spans_of(hits.where("NOT differ").select("doc_id", "at", "n").union(ends)), "op6-spans")
    drop_staged(spark, hits, windows, earliest)
    return base.join(spans, "doc_id", "left").mapInArrow(
        _cut(window, keep_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, "
        f"kept_text string, repeats {_SPAN}")
