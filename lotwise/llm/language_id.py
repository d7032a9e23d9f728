"""Language identification by prediction by partial matching.

Every label that has a text with content is a language. Each has a tree of byte
contexts up to `ORDER` bytes, learned by counting in Spark on a sample of
distinct whole texts: `SAMPLE_DOCS` shared equally among the languages, from
`LEAST_DOCS` to `MOST_DOCS` for each, taken by the order of their hash.
Statistics are then frozen: a byte seen n times in a context with t distinct
followers and m bytes costs -log2(n / (m + t)) bits, one not seen costs the
escape -log2(t / (m + t)) and is looked for in the next shorter context; after
the empty one a byte costs 8 bits. The language with the shortest exact code for
the whole text is predicted.

Scale. One pass over the texts with the model as broadcast; nothing is shuffled
but hashes of the labelled texts and the sample. `MOST_DOCS` is what Spark still
limits before a shuffle, so a language that holds most rows sends that many
hashes from each task. Tables of `GROUP` languages are built in one task each, as
float32, and only they reach the driver: their size grows with the sample and not
with the square of the number of languages. Search tables are made where texts
are read. Texts are worked on in blocks, so long ones need no more memory than
their bytes.

Defined cases. Null texts and texts without a letter are `und` with score 0;
so is everything if no labelled text was given, and `keep_explained` then keeps
every text that has a letter. All rows stay, repeated ones too; other columns
pass through untouched.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import free_name
from lotwise.operators.staging import stage

ORDER = 4
SAMPLE_DOCS = 2400
LEAST_DOCS = 16
#: spark.sql.optimizer.windowGroupLimitThreshold
MOST_DOCS = 1000
GROUP = 16
BLOCK = 1 << 18
UNKNOWN = "und"
LETTER = r"\p{L}"
PREDICTED = "lang string, score double, bits_per_byte double"


class KeyTable:
    """Integer keys to row numbers, by open addressing in arrays; -1 if absent."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rows = np.full(1 << bits, -1, np.int32)
        todo, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(todo):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[todo[free]]  # of keys with one home, the last one gets it
            placed = self.keys[at] == keys[todo]
            self.rows[at[placed]] = todo[placed]
            todo, at = todo[~placed], (at[~placed] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        found = self.keys[at]
        rows = np.where(found == keys, self.rows[at], np.int32(-1))
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            rows[todo[hit]] = self.rows[at[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return rows


def window_keys(codes: np.ndarray, length: int) -> np.ndarray:
    """For each position from length - 1 on, its byte and those before it as one number."""
    out = np.zeros(max(0, len(codes) - length + 1), np.int64)
    for i in range(length):
        out = (out << 8) | codes[i : len(codes) - length + 1 + i]
    return out


COUNTS = "label int, length int, window bigint, n bigint"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            codes = np.frombuffer(text.as_buffer(), np.uint8)
            for low in range(0, len(codes), BLOCK):
                found = []
                for length in range(1, ORDER + 2):
                    # windows that end in this block
                    block = codes[max(0, low - length + 1) : low + BLOCK].astype(np.int64)
                    keys, n = np.unique(window_keys(block, length), return_counts=True)
                    found.append((np.full(len(keys), length, np.int32), keys, n))
                lengths, keys, n = (np.concatenate(part) for part in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), label, np.int32)), pa.array(lengths), pa.array(keys), pa.array(n, pa.int64())],
                    ["label", "length", "window", "n"],
                )


def sample(labelled: DataFrame) -> DataFrame:
    """lang, text: the distinct texts of labelled (lang, text) that are learned."""
    known = labelled.where("lang is not null and octet_length(text) > 0").withColumn("hash", F.xxhash64("text"))
    hashes = known.select("lang", "hash").distinct()
    share = SAMPLE_DOCS // max(1, hashes.select("lang").distinct().count())
    first = Window.partitionBy("lang").orderBy("hash")
    most = min(MOST_DOCS, max(LEAST_DOCS, share))
    wanted = hashes.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most).drop("rank")
    taken = known.join(stage(wanted, "language-sample"), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min("text").alias("text"))
    return taken.select("lang", "text")


def window_counts(texts: DataFrame, langs: list[str]) -> DataFrame:
    """label (place in langs), length, window, n over texts: lang, text."""
    label = (F.array_position(F.lit(langs), F.col("lang")) - 1).cast("int")
    rows = texts.select(label.alias("label"), F.col("text").cast("binary").alias("text")).where("label >= 0")
    return rows.mapInArrow(_count, COUNTS).groupBy("label", "length", "window").agg(F.sum("n").alias("n"))


class Tables:
    """Code lengths in bits, one column per language, for windows of 1 .. ORDER + 1 bytes."""

    def __init__(self, langs: list[str], counts: pa.Table, first: int = 0):
        """`counts` has the labels from `first` on."""
        self.langs = langs
        self.sorted: list[tuple[np.ndarray, ...]] = []
        self.found: list[tuple[KeyTable, KeyTable]] = []
        by_length = counts.column("length").to_numpy()
        for length in range(1, ORDER + 2):
            own = by_length == length
            window, label, n = (counts.column(c).to_numpy()[own] for c in ("window", "label", "n"))
            keys, row = np.unique(window, return_inverse=True)
            seen = np.zeros((len(keys), len(langs)), np.float32)
            seen[row, label - first] = n
            contexts, home = np.unique(keys >> 8, return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), len(langs)), np.float32)
            np.add.at(total, home, seen)
            np.add.at(kinds, home, (seen > 0).astype(np.float32))
            weight = np.maximum(total + kinds, 1)
            escape = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / weight), 0).astype(np.float32)
            shorter = self.lengths(keys & ((1 << 8 * (length - 1)) - 1), length - 1)
            direct = -np.log2(np.maximum(seen, 1) / weight[home])
            self.sorted.append((keys, np.where(seen > 0, direct, escape[home] + shorter).astype(np.float32), contexts, escape))
            self._index()

    def _index(self) -> None:
        self.found += [(KeyTable(keys), KeyTable(contexts)) for keys, _, contexts, _ in self.sorted[len(self.found) :]]

    def __getstate__(self):
        return self.langs, self.sorted

    def __setstate__(self, state):
        self.langs, self.sorted = state
        self.found = []

    def lengths(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Bits of the last byte of each window of that length, for each language."""
        out = np.zeros((len(keys), len(self.langs)), np.float32)
        todo = np.arange(len(keys))
        while length and len(todo):
            windows, contexts = self.found[length - 1]
            _, bits, _, escape = self.sorted[length - 1]
            rows = windows.find(keys)
            hit = rows >= 0
            out[todo[hit]] += bits[rows[hit]]
            todo, keys = todo[~hit], keys[~hit]
            rows = contexts.find(keys >> 8)
            seen = rows >= 0
            out[todo[seen]] += escape[rows[seen]]
            length -= 1
            keys = keys & ((1 << 8 * length) - 1)
        out[todo] += 8
        return out

    def text_bits(self, texts: list[bytes]) -> np.ndarray:
        """Exact code length of each text in each language; empty texts have 0."""
        self._index()
        starts = np.cumsum([0, *map(len, texts)])
        codes = np.frombuffer(b"".join(texts), np.uint8)
        total = np.zeros((len(texts), len(self.langs)))
        for low in range(0, len(codes), BLOCK):
            high = min(low + BLOCK, len(codes))
            first, last = np.searchsorted(starts, [low, high - 1], "right") - 1
            inner = np.maximum(starts[first : last + 1], low)
            lead = max(0, low - ORDER)
            block = codes[lead:high].astype(np.int64)
            bits = np.zeros((high - low, len(self.langs)), np.float32)
            if len(block) > ORDER:
                bits[ORDER - (low - lead) :] = self.lengths(window_keys(block, ORDER + 1), ORDER + 1)
            for offset in range(ORDER):  # the first bytes of a text have a shorter context
                at = starts[first : last + 1] + offset
                at = at[(at >= low) & (at < np.minimum(starts[first + 1 : last + 2], high))]
                keys = np.zeros(len(at), np.int64)
                for back in range(offset, -1, -1):
                    keys = (keys << 8) | codes[at - back]
                bits[at - low] = self.lengths(keys, offset + 1)
            filled = np.flatnonzero(np.append(inner[1:], high) > inner)
            total[first + filled] += np.add.reduceat(bits, inner[filled] - low, axis=0, dtype=np.float64)
        return total


class Model:
    """All languages, in tables of `GROUP` languages; their code lengths do not depend on one another."""

    def __init__(self, groups: list[Tables]):
        self.groups = groups
        self.langs = [lang for g in groups for lang in g.langs]

    def text_bits(self, texts: list[bytes]) -> np.ndarray:
        """Exact code length of each text in each language; empty texts have 0."""
        return np.hstack([np.zeros((len(texts), 0)), *(g.text_bits(texts) for g in self.groups)])


def train(labelled: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Learn from the rows of `labelled`; the model's size is that of the sample's windows."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    texts = stage(sample(rows), "language-texts")
    langs = [r["lang"] for r in texts.select("lang").distinct().orderBy("lang").collect()]
    if not langs:
        return Model([])
    parts = [langs[i : i + GROUP] for i in range(0, len(langs), GROUP)]

    def build(key: tuple, counts: pa.Table) -> pa.Table:
        group = key[0].as_py()
        tables = Tables(parts[group], counts, group * GROUP)
        return pa.table({"group": pa.array([group], pa.int32()), "tables": [pickle.dumps(tables, pickle.HIGHEST_PROTOCOL)]})

    counts = window_counts(texts, langs).withColumn("group", F.floor(F.col("label") / GROUP).cast("int"))
    built = counts.groupBy("group").applyInArrow(build, "group int, tables binary")
    return Model([pickle.loads(r["tables"]) for r in built.orderBy("group").collect()])


def predicted(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct of lang, score (share of the best language among all codes) and bits_per_byte."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTED)
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in texts:
            langs, scores, rates = [], [], []
            for low, high in _groups(batch):
                data = [(t.as_py() or "").encode() for t in batch[low:high]]
                bits = own.text_bits(data) if own.langs else np.zeros((len(data), 1))
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(data)), best]
                scores += (1 / np.exp2(least[:, None] - bits).sum(axis=1)).tolist()
                rates += (least / np.maximum(1, [len(d) for d in data])).tolist()
                langs += [own.langs[b] if own.langs else UNKNOWN for b in best]
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
                ["lang", "score", "bits_per_byte"],
            )

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    guess = predict(whole)
    nothing = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_byte"))
    lettered = whole.rlike(LETTER) if model.langs else F.lit(False)
    return F.when(lettered, guess).otherwise(nothing)


def _groups(batch: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about BLOCK bytes."""
    low = size = 0
    for i in range(len(batch)):
        size += len(batch[i].as_buffer() or b"") if batch[i].is_valid else 0
        if size >= BLOCK:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(batch):
        yield low, len(batch)


def with_language(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """docs with the struct of `predicted` as one more column, which replaces one of that name."""
    return docs.withColumn(into, predicted(docs, model, text))


def keep_explained(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs without texts that are `und` or cost as much in every language as bytes at random.

    Without a language only texts without a letter go.
    """
    if not model.langs:
        return docs.where(F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(LETTER))
    column = free_name(docs, "language")
    found = with_language(docs, model, text, column)
    return found.where((F.col(column)["lang"] != UNKNOWN) & (F.col(column)["bits_per_byte"] < 8)).drop(column)
