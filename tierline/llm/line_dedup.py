"""Line deduplication by pairwise alignment.

1. A document is its sequence of line fingerprints (lines stripped; blank lines are no
   evidence).  Lines of at least ``least_words`` words nominate pairs, and so does each
   shortest run of lines up to or down from a shorter line that reaches as many words
   (blank lines within count as part of the run), so each line of a block that step 4
   deletes lies in a nominating unit of that block.
2. Overlapping documents.  A document meets, for each unit, the unit's first holder and a
   near earlier one, and aligns with both.  Units that are left over in a document (a line
   of them is in no common block yet) then meet more of their earlier holders, round by
   round several times as many as before, until the document has lost those lines or has
   met every earlier holder.  So a document loses what alignment with all earlier holders
   of its units would take, while a stock line that the first partner takes costs one or
   two pairs a document.  With ``rare_df`` given, a unit that at most so many documents
   share pairs each with the nearest earlier holder, any other with the first, and no
   more pairs are made.
3. Each pair is aligned by patience diff over the fingerprints: lines that are unique in
   both documents, their longest common order, growth of each such anchor both ways over
   equal lines, and the same again in the gaps.  A range without such lines matches its
   common head and tail, else the k-th with the k-th copy of each line.
4. Runs of aligned lines that are contiguous in both documents are common blocks; blocks
   of at least ``least_words`` words go from the later document.  A document's pairs pool
   their blocks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.common import binary_column, drop_staged, slices, stage, text_bytes, tidied

LEAST_WORDS = 4
NEAR = 256     # holders of a unit among which a near earlier one is looked for
GROWTH = 16    # the holders that a left-over unit meets grow by this factor a round
_BUCKETS = 1 << 30


def line_prints(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, number of words) of each line; blank lines have 0 and 0."""
    lines = text.split(b"\n")
    words = np.fromiter((len(x.split()) for x in lines), np.int32, len(lines))
    prints = np.fromiter((xxhash.xxh3_64_intdigest(s) if (s := x.strip()) else 0 for x in lines), np.uint64, len(lines))
    return prints, words


def _in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of ``pairs`` (rising in j) that rises in i too."""
    tails, ends, back = [], [], []
    for n, (i, _) in enumerate(pairs):
        k = bisect_left(tails, i)
        tails[k:k + 1], ends[k:k + 1] = [i], [n]
        back.append(ends[k - 1] if k else -1)
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def _anchors(a: list[int], b: list[int], lo_a: int, hi_a: int, lo_b: int, hi_b: int) -> list[tuple[int, int]]:
    """Longest common order of the lines that are unique in both ranges."""
    in_a, in_b = Counter(a[lo_a:hi_a]), Counter(b[lo_b:hi_b])
    place = {a[i]: i for i in range(lo_a, hi_a) if in_a[a[i]] == 1 and a[i]}
    return _in_order([(place[b[j]], j) for j in range(lo_b, hi_b) if in_b[b[j]] == 1 and b[j] in place])


def _common_ends(a: list[int], b: list[int], lo_a: int, hi_a: int, lo_b: int, hi_b: int) -> tuple[int, int]:
    """Number of equal lines at the head and at the tail of the ranges; the longer of the
    two takes its lines first."""
    most, head, tail = min(hi_a - lo_a, hi_b - lo_b), 0, 0
    while head < most and a[lo_a + head] == b[lo_b + head]:
        head += 1
    while tail < most and a[hi_a - 1 - tail] == b[hi_b - 1 - tail]:
        tail += 1
    return (min(head, most - tail), tail) if tail > head else (head, min(tail, most - head))


def _copies(a: list[int], b: list[int], lo_a: int, hi_a: int, lo_b: int, hi_b: int) -> list[tuple[int, int]]:
    """Longest common order of the k-th copies of each line."""
    places: dict[int, list[int]] = {}
    for i in range(lo_a, hi_a):
        if a[i]:
            places.setdefault(a[i], []).append(i)
    pairs, seen = [], Counter()
    for j in range(lo_b, hi_b):
        at = places.get(b[j], [])
        if seen[b[j]] < len(at):
            pairs.append((at[seen[b[j]]], j))
            seen[b[j]] += 1
    return _in_order(pairs)


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: matched line pairs (i in a, j in b), rising in both.  0 is a blank
    line: it never anchors, but a growing match runs over it.  Equal sequences match here
    by unique lines only; ``common_blocks`` settles them before."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    equal = a == b
    while todo:
        lo_a, hi_a, lo_b, hi_b = todo.pop()
        at_a, at_b = lo_a, lo_b
        found = _anchors(a, b, lo_a, hi_a, lo_b, hi_b)
        if not found and not equal:
            head, tail = _common_ends(a, b, lo_a, hi_a, lo_b, hi_b)
            if head or tail:
                matched.extend(zip(range(lo_a, lo_a + head), range(lo_b, lo_b + head)))
                matched.extend(zip(range(hi_a - tail, hi_a), range(hi_b - tail, hi_b)))
                if lo_a + head < hi_a - tail and lo_b + head < hi_b - tail:
                    todo.append((lo_a + head, hi_a - tail, lo_b + head, hi_b - tail))
                continue
            found = _copies(a, b, lo_a, hi_a, lo_b, hi_b)
        for i, j in found:
            if i < at_a or j < at_b:
                continue   # the match before has grown over it
            up_i, up_j = i, j
            while up_i > at_a and up_j > at_b and a[up_i - 1] == b[up_j - 1]:
                up_i, up_j = up_i - 1, up_j - 1
            if up_i > at_a and up_j > at_b:
                todo.append((at_a, up_i, at_b, up_j))
            end_i, end_j = i + 1, j + 1
            while end_i < hi_a and end_j < hi_b and a[end_i] == b[end_j]:
                end_i, end_j = end_i + 1, end_j + 1
            matched.extend(zip(range(up_i, end_i), range(up_j, end_j)))
            at_a, at_b = end_i, end_j
        if found and at_a < hi_a and at_b < hi_b:
            todo.append((at_a, hi_a, at_b, hi_b))
    return sorted(matched)


def common_blocks(a: list[int], b: list[int], words_b: list[int], least_words: int) -> list[tuple[int, int]]:
    """(start, end) lines of b in common blocks of at least ``least_words`` words.  Equal
    documents are one block."""
    if a == b:
        return [(0, len(b))] if sum(words_b) >= least_words else []
    out, matched, n = [], align(a, b), 0
    while n < len(matched):
        m = n + 1
        while m < len(matched) and matched[m][0] == matched[m - 1][0] + 1 and matched[m][1] == matched[m - 1][1] + 1:
            m += 1
        start, end = matched[n][1], matched[m - 1][1] + 1
        if sum(words_b[start:end]) >= least_words:
            out.append((start, end))
        n = m
    return out


def _units(prints: np.ndarray, words: np.ndarray, least_words: int, mixed: bool) -> list[tuple[int, int, int]]:
    """What nominates pairs, as (fingerprint, start, end): the lines of at least
    ``least_words`` words, and from each shorter line on the shortest run of such lines
    with as many; if ``mixed``, from each other line, blank ones included, the shortest run
    up and down, whatever lines it holds."""
    is_long = words >= least_words
    out = [(p, i, i + 1) for p, i in zip(prints[is_long].view(np.int64).tolist(), np.flatnonzero(is_long).tolist())]
    at = np.flatnonzero(~is_long & (mixed | (words > 0)))
    if not len(at):
        return out
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    ends = np.searchsorted(total, total[at] + least_words, "left")
    fits = ends <= len(words)
    runs = set(zip(at[fits].tolist(), ends[fits].tolist()))
    if mixed:
        starts = np.searchsorted(total, total[at + 1] - least_words, "right") - 1
        runs |= set(zip(starts[starts >= 0].tolist(), (at[starts >= 0] + 1).tolist()))
    else:
        runs = {(i, j) for i, j in runs if not is_long[i:j].any()}
    worded, cores = np.flatnonzero(words > 0), {}
    for i, j in sorted(runs):    # blank lines at the ends count by number: no long run of them is hashed twice
        lo, hi = (int(worded[np.searchsorted(worded, i)]), int(worded[np.searchsorted(worded, j) - 1]) + 1)
        if (lo, hi) not in cores:
            cores[lo, hi] = xxhash.xxh3_64_intdigest(prints[lo:hi].tobytes())
        ends_too = np.array([cores[lo, hi], lo - i, j - hi], np.uint64)
        out.append((int(np.uint64(xxhash.xxh3_64_intdigest(ends_too.tobytes())).view(np.int64)), i, j))
    return out


def _sequences(least_words: int, mixed: bool):
    """Rows (doc_id, prints, words, units): a document's lines and its distinct units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in slices(b, "text")):
            prints, words, distinct = [], [], []
            for text in batch.column("text"):
                p, w = line_prints(text.as_py())
                prints.append(p.tobytes())
                words.append(w.tobytes())
                distinct.append(sorted({u for u, _, _ in _units(p, w, least_words, mixed)}))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), binary_column(prints), binary_column(words),
                 pa.array(distinct, pa.list_(pa.int64()))], names=["doc_id", "prints", "words", "units"])

    return tidied(run)


def _blocks(least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "prints_b")):
            docs, starts, ends, partners = [], [], [], []
            for a, b, pa_, pb, wb in zip(*(part.column(c).to_pylist() for c in
                                           ("a", "b", "prints_a", "prints_b", "words_b"))):
                x, y = np.frombuffer(pa_, np.uint64).tolist(), np.frombuffer(pb, np.uint64).tolist()
                for s, e in common_blocks(x, y, np.frombuffer(wb, np.int32).tolist(), least_words):
                    docs.append(b)
                    starts.append(s)
                    ends.append(e)
                    partners.append(a)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (docs, starts, ends, partners)],
                                             names=["doc_id", "start", "end", "partner"])

    return tidied(run)


def _left_over(least_words: int):
    """Of each document's open units (unit, df) those of which a line is in no block yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "prints")):
            docs, units, dfs = [], [], []
            for doc, p, w, open_, blocks in zip(*(part.column(c).to_pylist() for c in
                                                  ("doc_id", "prints", "words", "open", "blocks"))):
                p, w = np.frombuffer(p, np.uint64), np.frombuffer(w, np.int32)
                kept = np.concatenate([[0], np.cumsum(~_removed(blocks, len(w)))])
                left = {u for u, i, j in _units(p, w, least_words, True) if kept[j] > kept[i]}
                for x in open_:
                    if x["unit"] in left:
                        docs.append(doc)
                        units.append(x["unit"])
                        dfs.append(x["df"])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (docs, units, dfs)],
                                             names=["doc_id", "unit", "df"])

    return tidied(run)


def _aligned(spark: SparkSession, lines: DataFrame, pairs: DataFrame, least_words: int) -> DataFrame:
    """The common blocks of each pair (a, b)."""
    late = lines.select(F.col("doc_id").alias("b"), F.col("prints").alias("prints_b"), F.col("words").alias("words_b"))
    early = lines.select(F.col("doc_id").alias("a"), F.col("prints").alias("prints_a"))
    return stage(spark, pairs.join(late, "b").join(early, "a")
                 .mapInArrow(_blocks(least_words), "doc_id long, start long, end long, partner long"), "op5-blocks")


def _all_blocks(spark: SparkSession, lines: DataFrame, found: DataFrame, least_words: int) -> list[DataFrame]:
    """Blocks with every earlier holder that can add one, round by round."""
    late = found.where(F.col("doc_id") > F.col("first"))
    some = F.when(F.col("df") > NEAR, F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("df") / NEAR))).otherwise(F.lit(0))
    near = (found.withColumn("some", some)
            .withColumn("a", F.lag("doc_id").over(Window.partitionBy("unit", "some").orderBy("doc_id")))
            .where("a < doc_id"))    # a row that repeats an id is no partner
    pairs = late.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).union(
        near.select("a", F.col("doc_id").alias("b"))).distinct()
    blocks = [_aligned(spark, lines, pairs, least_words)]
    # A holder's turn: a number below df, so about ``hi - lo`` holders of a unit have theirs within [lo, hi).
    turn = F.floor(F.pmod(F.xxhash64("unit", "doc_id"), F.lit(_BUCKETS)) * F.col("df") / F.lit(_BUCKETS))
    holders = found.withColumn("turn", turn).select("unit", F.col("doc_id").alias("a"), "turn")
    opened, lo, hi = late.select("doc_id", "unit", "df").distinct(), 0, GROWTH
    spent: list[DataFrame] = []
    while True:
        cut = blocks[0]
        for x in blocks[1:]:
            cut = cut.union(x)
        cut = cut.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("blocks"))
        todo = opened.groupBy("doc_id").agg(F.collect_list(F.struct("unit", "df")).alias("open"))
        after = stage(spark, todo.join(lines.select("doc_id", "prints", "words"), "doc_id").join(cut, "doc_id", "left")
                      .mapInArrow(_left_over(least_words), "doc_id long, unit long, df long").distinct(), "op5-open")
        drop_staged(spark, *spent)
        spent, opened = [after], after
        if opened.isEmpty():
            break
        meet = holders.where((F.col("turn") >= lo) & (F.col("turn") < hi))
        pairs = (opened.join(meet, "unit").where(F.col("a") < F.col("doc_id"))
                 .select("a", F.col("doc_id").alias("b")).distinct())
        blocks.append(_aligned(spark, lines, pairs, least_words))
        opened, lo, hi = opened.where(F.col("df") > hi), hi, hi * GROWTH    # the others have met all their holders
    drop_staged(spark, *spent)
    return blocks


def line_blocks(spark: SparkSession, docs: DataFrame, least_words: int = LEAST_WORDS, rare_df: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, blocks``: for each later document of an aligned pair its common blocks, as
    line ranges (start, end) with the earlier document's id."""
    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"),
                                                        text_bytes(text_col).alias("text"))
    lines = stage(spark, base.mapInArrow(_sequences(least_words, rare_df is None),
                                         "doc_id long, prints binary, words binary, units array<long>"), "op5-lines")
    held = lines.select("doc_id", F.explode("units").alias("unit"))
    shared = stage(spark, held.groupBy("unit").agg(F.count(F.lit(1)).alias("df"), F.min("doc_id").alias("first"),
                                                   F.max("doc_id").alias("last"))
                   .where("first < last").select("unit", "df", "first"), "op5-lines-held")
    found = stage(spark, held.join(shared, "unit"), "op5-shared")    # both sides shuffle anew, so Spark can split
    if rare_df is None:
        blocks = _all_blocks(spark, lines, found, least_words)
    else:
        nearest = Window.partitionBy("unit").orderBy("doc_id")
        rare = (found.where(F.col("df") <= rare_df).select("unit", "doc_id").distinct()
                .withColumn("a", F.lag("doc_id").over(nearest)).where("a IS NOT NULL"))
        stock = found.where((F.col("df") > rare_df) & (F.col("doc_id") > F.col("first"))).withColumnRenamed("first", "a")
        blocks = [_aligned(spark, lines, rare.select("a", F.col("doc_id").alias("b")).union(
            stock.select("a", F.col("doc_id").alias("b"))).distinct(), least_words)]
    every = blocks[0]
    for x in blocks[1:]:
        every = every.union(x)
    out = stage(spark, every.distinct().groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "end", "partner")).alias("blocks")), "op5-result")
    drop_staged(spark, lines, shared, found, *blocks)
    return out


def _removed(blocks: list[dict] | None, n_lines: int) -> np.ndarray:
    gone = np.zeros(n_lines, bool)
    for x in blocks or []:
        gone[x["start"]:x["end"]] = True
    return gone


def _delete(schema_names: list[str], text_col: str, blocks_col: str, keep_columns: bool):
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in slices(b, text_col)):
            texts, total, gone, partners, sha = [], [], [], [], []
            for text, blocks in zip(batch.column(text_col), batch.column(blocks_col).to_pylist()):
                lines = (text.as_py() or "").split("\n")
                hit = _removed(blocks, len(lines))
                n = int(hit.sum())
                kept = "\n".join([x for x, h in zip(lines, hit.tolist()) if not h]) if n else text.as_py()
                texts.append(kept)
                total.append(len(lines))
                gone.append(n)
                partners.append(len({x["partner"] for x in blocks or []}))
                if not keep_columns:
                    sha.append(hashlib.sha256((kept or "").encode()).hexdigest())
            if keep_columns:
                full = [t is None or not g or bool(t.strip()) for t, g in zip(texts, gone)]
                out = pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in schema_names],
                    names=schema_names)
                yield out.filter(pa.array(full, pa.bool_()))
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(partners, pa.int64()), pa.array(sha), pa.array(texts, pa.string())],
                    names=["doc_id", "n_lines", "n_removed", "n_partners", "kept_sha256", "kept_text"])

    return tidied(run)


def _with_blocks(spark, docs, least_words, rare_df, id_col, text_col) -> tuple[DataFrame, str]:
    """``docs`` and one more column with each row's blocks; that column's name."""
    taken = {c.lower() for c in docs.columns}
    key, name = (next(f"{p}{i}" for i in range(len(taken) + 1) if f"{p}{i}" not in taken) for p in ("of_", "blocks_"))
    blocks = line_blocks(spark, docs, least_words, rare_df, id_col, text_col).select(
        F.col("doc_id").alias(key), F.col("blocks").alias(name))
    return docs.join(blocks, F.col(id_col).cast("long") == F.col(key), "left").select(*docs.columns, name), name


def line_dedup(spark: SparkSession, docs: DataFrame, least_words: int = LEAST_WORDS, rare_df: int | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_removed, n_partners, kept_sha256,
    kept_text``.

    Lines end at line feeds and count without outer white space.  NULL and empty texts
    have one empty line (kept_text NULL stays NULL).  Lines repeated within a document
    stay.  Ids are integers; rows that repeat an id count as one document whose row with
    any text may be aligned, and lose the same line ranges; NULL ids take no part.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    joined, name = _with_blocks(spark, base, least_words, rare_df, "doc_id", "text")
    return joined.mapInArrow(_delete([], "text", name, False), "doc_id long, n_lines long, n_removed long, "
                             "n_partners long, kept_sha256 string, kept_text string")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, least_words: int = LEAST_WORDS,
                        rare_df: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the common blocks deleted from ``text_col``, all columns kept.  A row
    that lost lines and has no words left goes; rows that were empty before stay."""
    joined, name = _with_blocks(spark, docs, least_words, rare_df, id_col, text_col)
    return joined.mapInArrow(_delete(docs.columns, text_col, name, True), docs.schema)
