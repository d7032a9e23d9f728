"""Removal of long repeated substrings with a run-length index.

A byte goes if a string of `length` bytes that covers it also starts anywhere
else in the corpus. Every window of that length is assigned to an anchor, the
smallest hash among the `GRAM`-byte strings in it (the leftmost of equal ones):
equal windows have the same anchor at the same offset. The windows of a text
that share an anchor form a segment, so windows need comparison only between
segments of one anchor:

- an anchor with one segment in the corpus has nothing to remove;
- segments that are equal as a whole, by hash, are repeats from end to end;
- other segments of one anchor are indexed together. The index holds the
  Burrows-Wheeler transform as runs, with the suffix position at both ends of
  each run and the length of its common prefix with the neighbour across the
  run's border. Away from run ends the common prefix of a position with its
  neighbour in suffix order is that of the position before it less one, so
  matching statistics are streamed from the run ends alone, forwards and
  backwards in suffix order; positions with at least `length` are marked.

Scale. The first pass sends about one small row per 170 bytes onward. Text is
moved once by document id, for cutting segments and again for cutting spans
(the exchange is shared where the planner can), and only segments of anchors
that differ are shipped, one of each kind. Anchors with more than `KINDS`
different segments are not indexed in one task: their windows are hashed one by
one and counted, which deals them out evenly.

Defined cases. A null text is empty. Texts shorter than `length` lose nothing.
A row repeated with id and text is a copy like any other, and loses all that a copy does. Rows without an id take part. Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import whole_text
from lotwise.operators.staging import stage

LENGTH = 400
GRAM = 64
PIECE = 1 << 20
KINDS = 4096
#: Bytes of segments that are indexed together, if one anchor has not more.
INDEX = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)
_UP_BLOCK = [pow(_BASE, i << 16, 1 << 64) for i in range(64)]
_DOWN_BLOCK = [pow(_INVERSE, i << 16, 1 << 64) for i in range(64)]


def _scaled(table: np.ndarray, blocks: list[int], count: int) -> np.ndarray:
    return np.concatenate([table * np.uint64(b) for b in blocks[: (count >> 16) + 1]])[:count]


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """A mixed polynomial hash of every run of that many bytes."""
    up = _scaled(_UP, _UP_BLOCK, len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up)])
    out = (sums[gram:] - sums[:-gram]) * _scaled(_DOWN, _DOWN_BLOCK, len(sums) - gram)
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xC2B2AE3D27D4EB4F)
    return out ^ (out >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of that many values: a suffix of one block and a prefix of the next."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    table = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    table[: len(values)] = values
    table = table.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def segments(data: bytes, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """anchor, start and end of the segments of the pieces that lie between bounds."""
    codes = np.frombuffer(data, np.uint8)
    gram = min(GRAM, length)
    hashes = gram_hashes(codes, gram)
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    place = (sliding_min(keys, length - gram + 1) & _PLACE).astype(np.int64)
    piece = np.searchsorted(bounds, np.arange(len(place)), "right")
    whole = np.arange(len(place)) + length <= bounds[piece]
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | (piece[1:] != piece[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(place))
    real = whole[first]
    return hashes[place[first[real]]].view(np.int64), first[real], last[real] + length - 1


SEGMENT = "doc bigint, code bigint, anchor bigint, digest bigint, start bigint, length bigint, n bigint"


def _segment_rows(length: int) -> callable:
    def rows_of(group: list[tuple]) -> pa.RecordBatch:
        """Of pieces doc, code, offset, bytes. Segments a document repeats are given once, and as spans without anchor."""
        data = b"".join(p[3] for p in group)
        bounds = np.cumsum([len(p[3]) for p in group])
        anchors, starts, ends = segments(data, bounds, length)
        owner = np.searchsorted(bounds, starts, "right")
        shift = np.array([p[2] for p in group]) - (bounds - [len(p[3]) for p in group])
        seen: dict[tuple, list] = {}
        for anchor, start, end, at in zip(anchors.tolist(), starts.tolist(), ends.tolist(), owner.tolist()):
            digest = int.from_bytes(hashlib.blake2b(data[start:end], digest_size=8).digest(), "little", signed=True)
            row = seen.setdefault((group[at][0], group[at][1], anchor, digest), [start + int(shift[at]), end - start, []])
            row[2].append(start + int(shift[at]))
        out = [(*k, first, size, len(at)) for k, (first, size, at) in seen.items()]
        for (doc, code, _, _), (_, size, at) in seen.items():
            if len(at) > 1:
                for low, high in merged([(s, s + size) for s in at]):
                    out.append((doc, code, None, None, low, high - low, 0))
        return _batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size = [], 0
        for batch in batches:
            for doc, code, text in zip(*(batch.column(i) for i in range(3))):
                data = text.as_py()
                for low in range(0, max(0, len(data) - length + 1), PIECE):
                    part = data[low : low + PIECE + length - 1]
                    if size + len(part) > 2 * PIECE:
                        yield rows_of(group)
                        group, size = [], 0
                    group.append((doc.as_py(), code.as_py(), low, part))
                    size += len(part)
        if group:
            yield rows_of(group)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc", "code", "anchor", "digest", "start", "length", "n")
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(names))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


class RunLengthIndex:
    """Texts in suffix order, kept as the runs of their Burrows-Wheeler transform.

    heads, tails: for each run the text position of its first and last suffix;
    up, down: the common prefix of that suffix with the one before, after it.
    A text ends where it ends: ends are smaller than any byte, and earlier texts' smaller.
    """

    def __init__(self, texts: list[bytes]):
        self.ends = np.cumsum([len(t) for t in texts])
        self.codes = np.frombuffer(b"".join(texts), np.uint8)
        self.end_of = np.repeat(self.ends, [len(t) for t in texts])
        order = self._suffix_order(np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
        n = len(order)
        starts = np.zeros(n, bool)
        starts[0] = True
        starts[self.ends[:-1]] = True
        before = np.where(starts[order], 256 + np.arange(n), self.codes[order - 1])  # no two text starts are alike
        border = np.ones(n + 1, bool)
        border[1:-1] = before[1:] != before[:-1]
        first, last = np.flatnonzero(border[:-1]), np.flatnonzero(border[1:])
        self.heads, self.tails = order[first], order[last]
        self.up = np.zeros(len(first), np.int64)
        self.up[1:] = self._common(order[first[1:]], order[first[1:] - 1])
        self.down = np.zeros(len(last), np.int64)
        self.down[:-1] = self.up[1:]  # the same border, seen from the other side

    def _suffix_order(self, text: np.ndarray) -> np.ndarray:
        """Prefix doubling from seven bytes on."""
        n = len(self.codes)
        at = np.arange(n)
        key = np.zeros(n, np.int64)
        for i in range(7):
            inside = at + i < self.end_of
            key = (key << 9) | np.where(inside, self.codes[np.minimum(at + i, n - 1)].astype(np.int64) + 1, 0)
        texts, width = len(self.ends), 7
        while True:
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))
            if rank[order[-1]] == n - 1:
                return order
            follow = np.where(at + width < self.end_of, rank[np.minimum(at + width, n - 1)] + texts, text)
            key = rank * (n + texts) + follow
            width *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and at b."""
        most = np.minimum(self.end_of[a] - a, self.end_of[b] - b)
        out = np.zeros(len(a), np.int64)
        todo = np.arange(len(a))
        step = 16
        while len(todo):
            at = out[todo][:, None] + np.arange(step)
            inside = at < most[todo][:, None]
            last = len(self.codes) - 1
            same = inside & (
                self.codes[np.minimum(a[todo][:, None] + at, last)] == self.codes[np.minimum(b[todo][:, None] + at, last)]
            )
            run = np.where(same.all(1), step, same.argmin(1))
            out[todo] += run
            todo = todo[run == step]
            step = min(step * 2, 256)
        return out

    def matching_statistics(self) -> np.ndarray:
        """For each position the longest match of what starts there with what starts elsewhere."""
        at = np.arange(len(self.codes))
        out = np.zeros(len(at), np.int64)
        for places, lengths in ((self.heads, self.up), (self.tails, self.down)):
            sample = np.full(len(at), -1)
            sample[places] = np.arange(len(places))
            held = np.maximum.accumulate(np.where(sample >= 0, at, 0))
            out = np.maximum(out, lengths[sample[held]] - (at - held))
        return np.minimum(np.maximum(out, 0), self.end_of - at)


def repeats(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each text the spans covered by strings of that length that occur twice among all."""
    index = RunLengthIndex(texts)
    hits = np.flatnonzero(index.matching_statistics() >= length)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if len(hits):
        cut = np.flatnonzero(np.append(True, np.diff(hits) > 1))
        lows, highs = hits[cut], hits[np.append(cut[1:], len(hits)) - 1]
        begins = index.ends - [len(t) for t in texts]
        for low, high, at in zip(lows.tolist(), highs.tolist(), np.searchsorted(index.ends, lows, "right").tolist()):
            # a run of hits ends with the text that it started in, as no string of that length starts near its end
            out[at].append((low - int(begins[at]), high - int(begins[at]) + length))
    return out


def _index_rows(length: int) -> callable:
    def rows_of(group: list[tuple]) -> pa.RecordBatch:
        out = []
        for (doc, code, start, _), spans in zip(group, repeats([g[3] for g in group], length)):
            out += [(doc, code, None, None, start + low, high - low, 0) for low, high in spans]
        return _batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size, last = [], 0, None
        for batch in batches:
            for anchor, *rest in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size > INDEX and anchor != last:
                    yield rows_of(group)
                    group, size = [], 0
                group.append(tuple(rest))
                size += len(rest[3])
                last = anchor
        if group:
            yield rows_of(group)

    return run


WINDOW = "first bigint, second bigint, doc bigint, code bigint, start bigint"


def _window_rows(length: int) -> callable:
    """A hash for every window of the segments of anchors that are too many for one index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, doc, code, start, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                hashed = [
                    hashlib.blake2b(data[i : i + length], digest_size=16).digest() for i in range(len(data) - length + 1)
                ]
                pair = np.frombuffer(b"".join(hashed), np.int64).reshape(-1, 2)
                n = len(pair)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array([doc] * n, pa.int64()),
                        pa.array([code] * n, pa.int64()), pa.array(np.arange(start, start + n)),
                    ],
                    ["first", "second", "doc", "code", "start"],
                )

    return run


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, code and text as bytes; the code tells texts under one id apart."""
    whole = whole_text(text)
    return docs.select(F.col(key).cast("bigint").alias("doc"), F.xxhash64(whole).alias("code"), whole.cast("binary").alias("text"))


def _same_doc(left: DataFrame, right: DataFrame):
    return left["doc"].eqNullSafe(right["doc"]) & (left["code"] == right["code"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, code, start, length: spans to remove; they may overlap."""
    texts = _keyed(docs, key, text)
    long = texts.where(F.octet_length("text") >= length)
    found = stage(long.mapInArrow(_segment_rows(length), SEGMENT), "segments")
    rows = found.where("anchor is not null")
    kinds = (
        rows.groupBy("anchor")
        .agg(F.sum("n").alias("total"), F.min("digest").alias("low"), F.max("digest").alias("high"))
        .where("total > 1")
        .select("anchor", (F.col("low") != F.col("high")).alias("mixed"))
    )
    shared = stage(rows.join(kinds, "anchor"), "shared-segments")
    same = (
        shared.groupBy("anchor", "digest")
        .agg(F.sum("n").alias("times"), F.min(F.struct("doc", "code", "start", "length")).alias("one"), F.first("mixed").alias("mixed"))
    )
    same = stage(same, "segment-kinds")
    copied = shared.join(same.where("times > 1").select("anchor", "digest"), ["anchor", "digest"], "left_semi")
    mixed = same.where("mixed")
    wide = mixed.groupBy("anchor").agg(F.count("*").alias("kinds")).select("anchor", (F.col("kinds") > KINDS).alias("wide"))
    wanted = (
        mixed.join(wide, "anchor")
        .select("one.*", "anchor", "wide")
        .groupBy("doc", "code")
        .agg(F.collect_set(F.struct("anchor", "wide", "start", "length")).alias("cuts"))
    )
    cut = texts.join(wanted, _same_doc(texts, wanted)).select(
        texts["doc"], texts["code"], "text", F.explode("cuts").alias("c")
    )
    # rows that repeat an id and a text give the same cut
    cut = cut.select(
        "c.anchor", "doc", "code", "c.start", F.expr("substring(text, cast(c.start as int) + 1, cast(c.length as int))").alias("data"), "c.wide"
    ).dropDuplicates(["anchor", "doc", "code", "start"])
    cut = stage(cut, "cut-segments")
    indexed = (
        cut.where("not wide")
        .drop("wide")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_index_rows(length), SEGMENT)
    )
    windows = cut.where("wide").drop("wide").mapInArrow(_window_rows(length), WINDOW)
    twice = windows.groupBy("first", "second").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    counted = windows.join(twice, ["first", "second"], "left_semi").select("doc", "code", "start", F.lit(length).cast("bigint").alias("length"))
    spans = found.where("anchor is null").select("doc", "code", "start", "length")
    for more in (copied, indexed, counted):
        spans = spans.unionByName(more.select("doc", "code", "start", "length"))
    return spans


CUT = "n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"


def without_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, n_bytes, n_removed, spans (maximal, in bytes), kept (the other bytes)."""
    texts = _keyed(docs, key, text)
    spans = (
        repeated_spans(docs, length, key, text)
        .groupBy("doc", "code")
        .agg(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("marks"))
    )

    @F.arrow_udf(CUT)
    def cut(data: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for whole, marks in data:
            rows = []
            for t, m in zip(whole, marks):
                content = t.as_py()
                runs = merged([(s["start"], s["end"]) for s in m.as_py() or ()])
                edges = [0, *(e for run in runs for e in run), len(content)]
                kept = b"".join(content[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append(
                    {
                        "n_bytes": len(content),
                        "n_removed": len(content) - len(kept),
                        "spans": [{"start": a, "end": b} for a, b in runs],
                        "kept": kept,
                    }
                )
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            kinds = pa.struct(
                [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())]
            )
            yield pa.array(rows, kinds)

    joined = texts.join(spans, _same_doc(texts, spans), "left")
    return joined.select(texts["doc"].alias(key), cut("text", "marks").alias("cut")).select(key, "cut.*")
