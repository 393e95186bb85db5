"""Near-duplicate documents: MinHash bands, signature check, exact confirmation, components.

1. One pass fingerprints every document's set of word shingles and takes ``bands x rows``
   minima of universal (multiply-shift) hashes.
2. Documents with the same set form a class and go on as one row, however many they are.
3. Classes that share a band bucket are candidates.  Every member of a bucket is compared
   with its smallest member, by signature and then on the full sets, and connected
   components contract what is linked.  That settles groups of copies of any size with one
   pair per member.
4. Candidates whose bucket still holds several components go by their rarest shingles
   instead: two linked sets must share one of the first few in the order by rarity, at
   places that leave room for the overlap.  A near copy with too many edits of its own
   thus meets nobody.  Inside such a bucket, members are compared with pivots: one, then
   32, 1024, ..., each the smallest member of a hash group, out of those whose place is as
   early as a smaller set's must be.  After each round components
   contract, the pivots, having met their whole bucket, leave it, and buckets with one
   component or without a possible pivot are done.  So no candidate pair that could still join two components stays
   unchecked, and no group emits all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm import words as W
from tierline.llm.common import binary_column, binary_parts, drop_staged, slices, stage, text_bytes, tidied
from tierline.llm.components import connected_components

WORDS = 5
BANDS, ROWS = 24, 4     # a pair at similarity 0.8 shares no band with probability 3e-6
_SEED = 71


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text.  Lower-cases A-Z; a text with
    fewer than n words has its whole word sequence as the one shingle, without words none."""
    hashes, first = W.word_hashes(data, offsets, lower=True)
    grams = W.ngrams(hashes, n, _SEED)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            out.append(W.ngrams(hashes[a:b], b - a, _SEED + b - a))
        else:
            out.append(hashes[:0])
    return out


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """``size`` minima of each non-empty set, as uint32 rows."""
    flat = np.concatenate(sets)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), size), np.uint32)
    a, b = W.odd_constants(size, _SEED + 100), W.odd_constants(size, _SEED + 200)
    for k in range(size):
        out[:, k] = np.minimum.reduceat((flat * a[k] + b[k]) >> W.U64(32), begin)
    return out


def _fingerprints(n: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*binary_parts(part.column("text")), n)
                full = [i for i, s in enumerate(sets) if len(s)]
                low, high = np.zeros(len(sets), W.U64), np.zeros(len(sets), W.U64)
                sigs = [b""] * len(sets)
                if full:
                    held = [sets[i] for i in full]
                    begin = np.concatenate([[0], np.cumsum([len(s) for s in held])[:-1]])
                    flat = np.concatenate(held)
                    low[full] = np.add.reduceat(W.mix(flat), begin)
                    high[full] = np.add.reduceat(W.mix(flat ^ W.U64(0x5851F42D4C957F2D)), begin)
                    for i, row in zip(full, signatures(held, size)):
                        sigs[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), binary_column(sigs)],
                    names=["doc_id", "n_shingles", "low", "high", "sig"])

    return tidied(run)


def _buckets(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = W.odd_constants(rows, _SEED + 300)
        band = np.arange(bands, dtype=W.U64)
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32)
            sig = sig.reshape(batch.num_rows, bands, rows).astype(W.U64)
            key = W.mix((W.mix(sig) * m).sum(axis=2, dtype=W.U64) + band * W.U64(0x9E3779B97F4A7C15))
            ids = batch.column("class_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(ids, bands))],
                                             names=["bucket", "class_id"])

    return tidied(run)


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*binary_parts(part.column("text")), n)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), binary_column([s.tobytes() for s in sets])],
                                                 names=["class_id", "shingles"])

    return tidied(run)


def _linked(least: float, size: int, percent: int):
    """Pairs whose signatures agree in a share of at least ``least`` and whose full sets
    then reach the similarity, in whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for q in slices(b, "set_a") for p in slices(q, "set_b")):
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, size)
                    for c in ("sig_a", "sig_b"))
            yes = (x == y).sum(axis=1) >= least * size
            for i in np.flatnonzero(yes).tolist():
                s, t = (np.frombuffer(batch.column(c)[i].as_buffer(), W.U64) for c in ("set_a", "set_b"))
                both = len(np.intersect1d(s, t, assume_unique=True))
                yes[i] = 100 * both >= percent * (len(s) + len(t) - both)
            yield batch.select(["u", "v"]).filter(pa.array(yes))

    return tidied(run)


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 80, words: int = WORDS,
                    bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when 100 * |intersection| >= percent * |union| of their
    shingle sets; a component's id is the smallest id in it, and that document is kept.
    NULL and empty texts and texts without words have no shingles and no links.  Ids are
    integers; rows that repeat an id with another text are tied together by it.  A NULL id
    takes no part (component NULL, kept).  Other columns are ignored.
    """
    size = bands * rows
    # Standard error of the signatures' agreement at the threshold, five times.
    least = max(0.0, percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / size) ** 0.5)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    prints = stage(spark, base.mapInArrow(
        _fingerprints(words, size), "doc_id long, n_shingles long, low long, high long, sig binary"), "op3-prints")

    alike = ["low", "high", "n_shingles"]
    classes = stage(spark, prints.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*alike)
                    .agg(F.min("doc_id").alias("class_id"), F.max("sig").alias("sig")), "op3-classes")
    sigs = classes.select("class_id", "sig")
    entries = sigs.mapInArrow(_buckets(bands, rows), "bucket long, class_id long")
    shared = stage(spark, entries.groupBy("bucket").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi"))
                   .where("lo < hi").select("bucket"), "op3-buckets")    # written, so the join below can split
    members = stage(spark, entries.join(shared, "bucket")
                    .select("bucket", "class_id", F.col("class_id").alias("component")), "op3-members")
    wanted = members.select(F.col("class_id").alias("doc_id")).distinct()
    sets = stage(spark, base.join(wanted, "doc_id").mapInArrow(_sets(words), "class_id long, shingles binary")
                 .join(sigs, "class_id"), "op3-sets")
    drop_staged(spark, shared)

    pivots = _pivots(members, 1)
    links = stage(spark, _links(members, pivots, F.lit(True), sets, least, size, percent), "op3-links")
    stars = connected_components(spark, links)
    open_now, behind = _open_buckets(spark, _moved(_without(members, pivots), stars))
    left = stage(spark, open_now.select("class_id", "component").distinct(), "op3-left")
    drop_staged(spark, members, links, *behind)

    prefixes, counts = _prefixes(spark, sets.join(left, "class_id"), percent)
    members, behind = _open_buckets(spark, prefixes)
    drop_staged(spark, left, counts)
    reach = ((100 + percent) * F.least(F.col("n") - F.col("place"), F.col("pivot_n") - F.col("pivot_place"))
             >= percent * (F.col("n") + F.col("pivot_n")))
    pivots_per_bucket = 1
    while not members.isEmpty():
        pivots = _pivots(members, pivots_per_bucket)
        links = stage(spark, _links(members, pivots, reach, sets, least, size, percent), "op3-links")
        rest = _without(members, pivots)
        if not links.isEmpty():
            moved = connected_components(spark, links)
            stars, rest = stars.union(moved), _moved(rest, moved)
        members, used = _open_buckets(spark, rest)
        drop_staged(spark, links, *behind)
        behind = used
        pivots_per_bucket *= 32
    drop_staged(spark, sets, *behind)
    labels = connected_components(spark, stars.select(F.col("node").alias("u"), F.col("component").alias("v")))

    of_class = (classes.select(*alike, F.col("class_id").alias("node")).join(labels, "node", "left")
                .select(*alike, F.coalesce("component", "node").alias("component_id")))
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (prints.drop("sig").join(of_class, alike, "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shingle, class_id) of the sets."""
    for batch in batches:
        for part in slices(batch, "shingles"):
            data, offsets = binary_parts(part.column("shingles"))
            ids = part.column("class_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(data[offsets[0]:offsets[-1]].view(np.int64)), pa.array(np.repeat(ids, np.diff(offsets) // 8))],
                names=["shingle", "class_id"])


def _prefixes(spark: SparkSession, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members of prefix buckets: each class's rarest shingles, as many as it takes for two
    linked classes to share one (n - least overlap + 1), with the set's size and the
    shingle's place in the order by rarity, which is by the number of classes.  ``short``
    marks the places that the first shared shingle can have in the smaller of two linked
    sets; only these make pivots, so texts of one template, which share no shingle that
    early, never meet.  Also the staged table of those numbers (written, so that the join
    on a hot shingle can split)."""
    held = sets.select("class_id", "shingles").mapInArrow(tidied(_entries), "shingle long, class_id long")
    shared = stage(spark, held.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")), "op3-df")
    of = sets.select("class_id", "component", F.expr("length(shingles) div 8").alias("n"))
    rarest = Window.partitionBy("class_id").orderBy("df", "shingle")
    return (held.join(shared, "shingle").withColumn("place", F.row_number().over(rarest) - 1).join(of, "class_id")
            .where(100 * F.col("place") <= (100 - percent) * F.col("n"))
            .select(F.col("shingle").alias("bucket"), "class_id", "component", "n", "place",
                    ((100 + percent) * F.col("place") <= (100 - percent) * F.col("n")).alias("short"))), shared


def _part(per_bucket: int):
    return F.pmod(F.xxhash64("class_id", F.lit(per_bucket)), F.lit(per_bucket))


def _pivots(members: DataFrame, per_bucket: int) -> DataFrame:
    """The smallest member of each of ``per_bucket`` hash groups of a bucket (of prefix
    buckets: the smallest that a smaller set's prefix reaches)."""
    more = [c for c in members.columns if c not in ("bucket", "class_id", "short")]
    able = members.where("short") if "short" in members.columns else members
    return (able.groupBy("bucket", _part(per_bucket).alias("part"))
            .agg(F.min(F.struct("class_id", *more)).alias("p"))
            .select(F.col("bucket").alias("of"), F.col("p.class_id").alias("pivot"),
                    *[F.col(f"p.{c}").alias(f"pivot_{c}") for c in more]))


def _links(members: DataFrame, pivots: DataFrame, possible, sets: DataFrame, least: float, size: int,
           percent: int) -> DataFrame:
    """New links between members and pivots of other components, as the components (u, v)."""
    swap = F.col("class_id") > F.col("pivot")
    meet = (F.col("bucket") == F.col("of")) & (F.col("component") != F.col("pivot_component")) & possible
    pairs = members.join(pivots, meet).select(
        F.least("class_id", "pivot").alias("a"), F.greatest("class_id", "pivot").alias("b"),
        F.when(swap, F.col("pivot_component")).otherwise(F.col("component")).alias("u"),
        F.when(swap, F.col("component")).otherwise(F.col("pivot_component")).alias("v")).distinct()

    def side(name: str) -> DataFrame:
        return sets.select(F.col("class_id").alias(name), F.col("sig").alias(f"sig_{name}"),
                           F.col("shingles").alias(f"set_{name}"))

    return (pairs.join(side("b"), "b").join(side("a"), "a")
            .mapInArrow(_linked(least, size, percent), "u long, v long"))


def _without(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Members without the pivots, which have met their whole bucket."""
    used = pivots.select(F.col("of").alias("bucket"), F.col("pivot").alias("class_id"))
    return members.join(used, ["bucket", "class_id"], "left_anti")


def _moved(members: DataFrame, stars: DataFrame) -> DataFrame:
    """Members with their components' new components."""
    to = stars.select(F.col("node").alias("component"), F.col("component").alias("root"))
    return members.join(to, "component", "left").select(
        *[F.coalesce("root", "component").alias("component") if c == "component" else F.col(c) for c in members.columns])


def _open_buckets(spark: SparkSession, members: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Members of the buckets that hold several components and a possible pivot, and the
    staged tables behind them.  Written first, so that the join on a hot bucket is a broadcast of its few open
    buckets or one that Spark can split."""
    rest = stage(spark, members, "op3-members")
    able = F.max("short") if "short" in members.columns else F.lit(True)
    several = stage(spark, rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                      able.alias("able"))
                    .where("lo < hi AND able").select("bucket"), "op3-open")
    return rest.join(several, "bucket", "left_semi").select(*members.columns), [rest, several]
