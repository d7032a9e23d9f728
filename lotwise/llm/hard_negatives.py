"""Hard negatives by a vertical scan of vector dimensions with shrinking candidates.

Vectors become whole numbers, floor(`SCALE` * x) for each component x. An anchor's
positives are its first `POSITIVES` other rows of its label by inner product,
largest first, ties by smaller id. The negatives of an anchor and a positive are
the first `NEGATIVES` rows of other labels whose score lies between `LOW` percent
of the positive's score and that score.

Method. A task keeps a block of rows as columns, one per dimension, ordered by
label. For each anchor it reads dimensions in the order of the anchor's
descending magnitude, a few at a time, and adds their products to the partial
scores of the candidates. The largest and least that the remaining dimensions can
add, from each dimension's maximum and minimum in the block, decide which
candidates can still reach the window of scores wanted; the others leave the
candidate bitmap, until exact scores are left. The window narrows as better rows
are found: first the best same-label scores, then, in a second scan with the
positives known, the scores that each positive admits.

Scale. Rows are never shuffled: each scan is one pass over the table, and a task
passes on the best few rows per anchor. Anchors are taken in blocks of about
`ANCHORS` rows, dealt by a hash of their row, which alone bounds what the driver
and a broadcast hold at a time, together with their `POSITIVES` scores each; the
number of passes over the table grows with the number of anchors. No label, id
or vector is gathered anywhere, however many rows share it.

Defined cases. Rows with a null label, a null vector, or any null or non-finite
component take no part, nor do rows whose squared length needs more than 62 bits,
as their scores would not fit a bigint. Shorter vectors, empty ones too, are
filled with zeros. Rows that bear the anchor's id are not others. Rows with the
same id and score for an anchor count once, equal anchors once; an id's different
anchor rows are anchors each. Rows without an id take no part. Fewer rows than
wanted are all returned; without positives there is no result. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.operators.staging import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW = 80
ANCHORS = 1 << 15
BLOCK = 1 << 15
STEP = 16
FEW = 64
NO_SCORE = np.iinfo(np.int64).min


def whole_vectors(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The usable rows of a list column, and their components as whole numbers (float64), short ones filled with zeros."""
    lengths = np.asarray(values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = values.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    held = np.arange(width) < lengths[:, None]
    out = np.zeros((len(values), width))
    out[held] = np.floor(SCALE * flat)
    squares = (out * out).sum(axis=1)
    usable = np.asarray(values.is_valid()) & np.isfinite(out).all(axis=1) & (squares < 2.0**62)
    rows = np.flatnonzero(usable)
    return rows, out[rows]


def exact_type(longest: float) -> type:
    """The cheapest type in which sums up to `longest` are exact."""
    return np.float32 if longest < 2**24 else np.float64 if longest < 2**53 else np.int64


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The first k different (-score, id), in order."""
    if len(scores) > FEW:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, tied = scores > least, np.unique(ids[scores == least])[:k]
        if above.sum() < k and len(np.unique(np.stack([scores[above], ids[above]]), axis=1).T) + len(tied) >= k:
            scores = np.append(scores[above], np.full(len(tied), least, scores.dtype))
            ids = np.append(ids[above], tied)
    return sorted(set(zip((-scores.astype(np.int64)).tolist(), ids.tolist())))[:k]


class Columns:
    """A block of rows by dimension, rows ordered by label and id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, longest: float, width: int):
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        length = np.sqrt((vectors * vectors).sum(axis=1).max(initial=0.0))
        self.type = exact_type(length * longest + 1)
        self.width = max(width, vectors.shape[1])
        self.dims = np.zeros((self.width, len(ids)), self.type)
        self.dims[: vectors.shape[1]] = vectors[order].T
        self.least = self.dims.min(axis=1, initial=0).astype(np.float64)
        self.most = self.dims.max(axis=1, initial=0).astype(np.float64)

    def of_label(self, label) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))

    def scan(self, anchor: np.ndarray, first: int, last: int, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the rows first .. last whose score lies in low .. high."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        weights = anchor[order]
        ends = np.stack([weights * self.least[order], weights * self.most[order]])
        # what the dimensions after each can add, a little more for rounding
        rest = np.zeros((2, len(order) + 1))
        rest[:, :-1] = np.cumsum(np.sort(ends, axis=0)[:, ::-1], axis=1)[:, ::-1]
        rest += np.array([[-1.0], [1.0]]) * (1 + np.abs(rest) * 1e-9)
        weights = weights.astype(self.type)
        alive, scores = None, np.zeros(last - first, self.type)
        for at in range(0, len(order), STEP):
            dims = order[at : at + STEP]
            block = self.dims[dims, first:last] if alive is None else self.dims[dims[:, None], alive]
            scores = scores + weights[at : at + STEP] @ block
            keep = (scores + rest[1, min(at + STEP, len(order))] >= low) & (scores + rest[0, min(at + STEP, len(order))] <= high)
            n = np.count_nonzero(keep)
            if n < 0.8 * len(keep):
                alive = first + np.flatnonzero(keep) if alive is None else alive[keep]
                scores = scores[keep]
            if not n:
                break
        places = np.arange(first, last) if alive is None else alive
        exact = (scores >= low) & (scores <= high)
        return places[exact], scores[exact].astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], longest: float, width: int) -> Iterator[Columns]:
    """Rows (id, label, vector) as column blocks of about `BLOCK` rows."""
    ids, labels, vectors, n = [], [], [], 0

    def block() -> Columns:
        wide = max(v.shape[1] for v in vectors)
        rows = np.concatenate([np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for v in vectors])
        made = Columns(np.concatenate(ids), np.concatenate(labels), rows, longest, width)
        ids.clear(), labels.clear(), vectors.clear()
        return made

    for batch in batches:
        rows, own = whole_vectors(batch.column(2))
        if len(rows):
            ids.append(batch.column(0).to_numpy(zero_copy_only=False)[rows])
            labels.append(batch.column(1).to_numpy(zero_copy_only=False)[rows])
            vectors.append(own)
            n += len(rows)
        if n >= BLOCK:
            yield block()
            n = 0
    if n:
        yield block()


class Anchors:
    """A bounded block of anchors, as it is broadcast."""

    def __init__(self, table: pa.Table):
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        rows, vectors = whole_vectors(table.column("vector").combine_chunks())
        self.ids, self.labels, self.vectors = ids[rows], labels[rows], vectors
        self.longest = float(np.sqrt((vectors * vectors).sum(axis=1).max(initial=0.0)))
        self.positives: list[list[tuple[int, int]]] = []

    def wide(self, width: int) -> np.ndarray:
        return np.pad(self.vectors, ((0, 0), (0, width - self.vectors.shape[1])))


FOUND = "anchor int, place int, id bigint, score bigint"


def _found(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "place", "id", "score"])


def _positives(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        top: list[list[tuple[int, int]]] = [[] for _ in own.ids]
        for block in _blocks(batches, own.longest, own.vectors.shape[1]):
            wide = own.wide(block.width)
            for a in range(len(top)):
                first, last = block.of_label(own.labels[a])
                if first == last:
                    continue
                low = -top[a][-1][0] if len(top[a]) == k else -np.inf
                places, scores = block.scan(wide[a], first, last, low, np.inf)
                other = block.ids[places] != own.ids[a]
                if other.any():
                    top[a] = sorted({*top[a], *best(scores[other], block.ids[places][other], k)})[:k]
        yield _found([(a, 0, i, -s) for a, found in enumerate(top) for s, i in found])

    return run


def least_score(positive: int, low: int) -> int:
    """The least whole score that is at least `low` percent of the positive's."""
    return -(-low * positive // 100)


def _negatives(shared, k: int, low: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        top = [[[] for _ in found] for found in own.positives]
        for block in _blocks(batches, own.longest, own.vectors.shape[1]):
            wide = own.wide(block.width)
            for a, found in enumerate(own.positives):
                open_ends = [
                    max(least_score(p, low), -top[a][i][-1][0] if len(top[a][i]) == k else NO_SCORE) for i, (_, p) in enumerate(found)
                ]
                windows = [(i, e, p) for i, (e, (_, p)) in enumerate(zip(open_ends, found)) if e <= p]
                if not windows:
                    continue
                first, last = block.of_label(own.labels[a])
                for start, stop in ((0, first), (last, len(block.ids))):
                    if start == stop:
                        continue
                    places, scores = block.scan(wide[a], start, stop, min(e for _, e, _ in windows), max(p for *_, p in windows))
                    for i, e, p in windows if len(places) else ():
                        held = (scores >= e) & (scores <= p)
                        if held.any():
                            top[a][i] = sorted({*top[a][i], *best(scores[held], block.ids[places][held], k)})[:k]
        yield _found([(a, i, n, -s) for a, per in enumerate(top) for i, rows in enumerate(per) for s, n in rows])

    return run


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    named = [F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("vector")]
    known = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
    valid = rows.where(known).select(*named)
    asked = rows.where(known & is_anchor).select(*named).distinct()
    n_blocks = max(1, -(-asked.count() // ANCHORS))
    deal = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(n_blocks)).cast("int")
    anchors = stage(asked.withColumn("deal", deal), "anchors")
    results = []
    for number in range(n_blocks):
        own = Anchors(anchors.where(F.col("deal") == number).drop("deal").toArrow())
        shared = spark.sparkContext.broadcast(own)
        found = _first(valid.mapInArrow(_positives(shared, positives), FOUND), ["anchor"], positives)
        own.positives = [[] for _ in own.ids]
        for a, i, s in zip(*(c.to_pylist() for c in found.select("anchor", "id", "score").orderBy("anchor", "rank").toArrow().columns)):
            own.positives[a].append((i, s))
        shared.destroy()
        shared = spark.sparkContext.broadcast(own)
        pairs = [(a, p, int(own.ids[a]), i, s) for a, per in enumerate(own.positives) for p, (i, s) in enumerate(per)]
        scored = spark.createDataFrame(pairs, "anchor int, place int, anchor_id bigint, positive_id bigint, positive_score bigint")
        held = _first(valid.mapInArrow(_negatives(shared, negatives, low), FOUND), ["anchor", "place"], negatives)
        chosen = held.join(scored, ["anchor", "place"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
        results.append(stage(chosen, "negatives"))
        shared.destroy()
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
