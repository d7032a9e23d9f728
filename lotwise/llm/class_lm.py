"""Class-based bigram model: words in classes found by exchange.

P(text) is the product over its tokens, an end token included, of
P(class | class before) * P(word | class); the first class follows the end
class. The `CLASS_WORDS` most frequent words are put in `CLASSES` classes by
the exchange algorithm: word after word moves to the class that raises the
likelihood of the class bigrams most. Every other word of the training texts,
however rare, then goes to the class under which its own neighbours, counted
by class, are likeliest. Only words that training never saw belong to a class
by their shape. Transitions and emissions are smoothed by adding `ADD`, each
class keeping room for one unseen word.

Scale. Texts are tokenized for the word counts and once more to be numbered;
all later passes read the numbers. Counts of words and of word pairs are summed
in Spark after a sum per task. An exchange pass takes each class word's counts
of neighbouring classes, a matrix bounded by CLASS_WORDS times the number of
classes, from a Spark sum over the pair table. Words above a count that at most
`KNOWN` words reach are numbered by a broadcast; all others travel with their
neighbours' classes and are joined with the table of all words, so that counts
and classes are exact at any size of the vocabulary. What is gathered by word is
a stream in word order, of which one word's counts are held at a time.

Defined cases. A null or empty text has the end token only. With no training
text all counts are 0. All rows are scored, repeated ones too and those without
a key; a row whose `learn` is null is not learned from. Keys are whole numbers
or texts of such; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lotwise.operators.staging import stage

ADD = 0.1
CLASSES = 48
CLASS_WORDS = 4096
PASSES = 3
KNOWN = 1 << 18
FLUSH = 1 << 19
ROWS = 512  # texts of a batch that are worked on at a time
SHAPES = 6
KINDS = CLASSES + SHAPES + 1  # classes of words, of shapes, and of the end
RARE = -1  # the class of a word that is only known after a join


def tokens(text: str | None) -> list[bytes]:
    """A-Z lowered; split at blanks and the characters from tab to return, as bytes.split does."""
    return (text or "").encode().lower().split()


def shape(word: bytes) -> int:
    """Of a word outside the class words: its kind of characters."""
    if word.isdigit():
        return 0
    if word.isalpha():
        return 1 if len(word) < 8 else 2
    if word[-1:] in b".,;:!?":
        return 3
    return 4 if max(word) > 127 else 5


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for text in batch.column(0):
            seen.update(tokens(text.as_py()))
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
    yield out()


class Sums:
    """Counts by key, kept until there are too many keys. New keys wait until they are as many as those counted."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.more = 0

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.more += len(keys)
        if self.more > max(FLUSH, len(self.keys)):
            self._count()

    def _count(self) -> None:
        new, m = np.unique(np.concatenate([np.zeros(0, np.int64), *self.waiting]), return_counts=True)
        self.waiting, self.more = [], 0
        keys, n = np.concatenate([self.keys, new]), np.concatenate([self.n, m])
        order = np.argsort(keys, kind="stable")  # a merge of two sorted runs
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
        self.keys, self.n = keys[first], np.add.reduceat(n, first) if len(keys) else n

    def full(self) -> bool:
        return len(self.keys) > 4 * FLUSH

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        self._count()
        out = self.keys, self.n
        self.__init__()
        return out


@dataclass
class Vocabulary:
    """Token numbers: class words by frequency, other known words, one per shape of the rest, the end."""

    numbers: dict[bytes, int]
    class_words: int
    shapes: np.ndarray

    @property
    def end(self) -> int:
        return len(self.numbers) + SHAPES

    @property
    def coarse_end(self) -> int:
        return self.class_words + SHAPES

    def coarse(self) -> np.ndarray:
        """Token number to the exchange's: class words, then shapes, then the end."""
        c = self.class_words
        return np.concatenate([np.arange(c), c + self.shapes[c:], c + np.arange(SHAPES + 1)]).astype(np.int64)


NUMBERED = "row bigint, key bigint, learn boolean, tokens binary, rare array<binary>"


def _number(shared) -> callable:
    """Texts as token numbers, the end last; the words that have none of their own are listed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        known, last = vocabulary.numbers, np.int32(vocabulary.end).tobytes()
        row = TaskContext.get().partitionId() << 33
        for batch in _sliced(batches):
            numbered, rare = [], []
            for text in batch.column("text"):
                words = tokens(text.as_py())
                row_of = np.fromiter(map(known.get, words, repeat(-1)), np.int32, len(words))
                unknown = np.flatnonzero(row_of < 0)
                others = [words[i] for i in unknown.tolist()]
                row_of[unknown] = [len(known) + shape(w) for w in others]
                numbered.append(row_of.tobytes() + last)
                rare.append(others)
            rows = pa.array(np.arange(row, row + batch.num_rows), pa.int64())
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [rows, batch.column("key"), batch.column("learn"), pa.array(numbered, pa.binary()),
                 pa.array(rare, pa.list_(pa.binary()))],
                ["row", "key", "learn", "tokens", "rare"],
            )

    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The token numbers of all texts in a row, and how many each text has."""
    column = batch.column("tokens")
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False) // 4
    return np.frombuffer(b"".join(column.to_pylist()), np.int32), lengths


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _before(t: np.ndarray, end: int) -> np.ndarray:
    """The token before each; every text ends with an end, so the first of a text follows one."""
    return np.concatenate([[end], t[:-1]]).astype(t.dtype) if len(t) else t


def _blocks(t: np.ndarray, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of neighbours in blocks of bounded size: left tokens, right tokens."""
    left = _before(t, end)
    for at in range(0, len(t), FLUSH):
        yield left[at : at + FLUSH], t[at : at + FLUSH]


def _count_pairs(shared) -> callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coarse, end = shared.value.coarse(), shared.value.coarse_end
        size, sums = end + 1, Sums()

        def out() -> pa.RecordBatch:
            keys, n = sums.taken()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys // size, pa.int32()), pa.array(keys % size, pa.int32()), pa.array(n)],
                ["left", "right", "n"],
            )

        for batch in _sliced(batches):
            for left, right in _blocks(coarse[_flat(batch)[0]], end):
                sums.add(left * size + right)
                if sums.full():
                    yield out()
        yield out()

    return count


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(classes: np.ndarray, right: np.ndarray, left: np.ndarray, words: int) -> np.ndarray:
    """One pass over the words. right[w, c], left[w, c]: how often class c follows and precedes token w."""
    classes, kinds = classes.copy(), right.shape[1]
    between = np.zeros((kinds, kinds))
    np.add.at(between, classes, right)
    out, into = between.sum(1), between.sum(0)
    for w in np.argsort(-right[:words].sum(1), kind="stable"):
        r, l, own = right[w], left[w], classes[w]
        between[own] -= r
        between[:, own] -= l
        out[own] -= r.sum()
        into[own] -= l.sum()
        rows, columns = between[:CLASSES], between[:, :CLASSES]
        gain = (_xlogx(rows + r) - _xlogx(rows)).sum(1) + (_xlogx(columns + l[:, None]) - _xlogx(columns)).sum(0)
        gain -= _xlogx(out[:CLASSES] + r.sum()) - _xlogx(out[:CLASSES])
        gain -= _xlogx(into[:CLASSES] + l.sum()) - _xlogx(into[:CLASSES])
        own = classes[w] = int(gain.argmax())
        between[own] += r
        between[:, own] += l
        out[own] += r.sum()
        into[own] += l.sum()
    return classes


def _neighbours(pairs: DataFrame, classes: np.ndarray, token: str, other: str) -> np.ndarray:
    """How often each token has each class on its other side; tokens by the number of classes."""
    # one row per token number of the exchange, which are bounded
    of = pairs.sparkSession.createDataFrame([(i, int(c)) for i, c in enumerate(classes)], "other int, class int")
    got = (
        pairs.join(F.broadcast(of), pairs[other] == of["other"])
        .groupBy(F.col(token).alias("token"), "class")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    out = np.zeros((len(classes), KINDS))
    out[got["token"].to_numpy(np.int64), got["class"].to_numpy(np.int64)] = got["n"]
    return out


CONTEXTS = "number int, word binary, codes binary, ns binary"


def _binaries(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    """Values cut at the bounds (the first is 0), each piece as bytes."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]
    )


def _count_contexts(shared) -> callable:
    """Of each word outside the class words: codes of neighbouring classes (those that follow after KINDS), and counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, classes = shared.value
        first, known, end = vocabulary.class_words, len(vocabulary.numbers), vocabulary.end
        class_of, sums = classes[vocabulary.coarse()].astype(np.int64), Sums()

        def rows(number, word, bounds, codes, ns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), word, _binaries(bounds, codes.astype(np.uint8)), _binaries(bounds, ns.astype(np.uint32))],
                ["number", "word", "codes", "ns"],
            )

        def out() -> pa.RecordBatch:
            keys, n = sums.taken()
            number, starts = np.unique(keys // (2 * KINDS), return_index=True)
            word = pa.array([b""] * len(number), pa.binary())
            return rows(number, word, np.append(starts, len(keys)), keys % (2 * KINDS), n)

        for batch in _sliced(batches):
            t = _flat(batch)[0]
            left, right = class_of[_before(t, end)], class_of[np.append(t[1:], end).astype(t.dtype)]
            own = np.flatnonzero((t >= first) & (t < known))
            for at in range(0, len(own), FLUSH):
                some = own[at : at + FLUSH]
                key = t[some].astype(np.int64) * (2 * KINDS)
                sums.add(np.concatenate([key + left[some], key + KINDS + right[some]]))
                if sums.full():
                    yield out()
            rare = np.flatnonzero((t >= known) & (t < end))
            words = batch.column("rare").flatten()
            codes = np.stack([left[rare], KINDS + right[rare]], 1).ravel()
            yield rows(np.full(len(rare), -1), words, 2 * np.arange(len(rare) + 1), codes, np.ones(len(codes)))
        yield out()

    return count


def _best_classes(shared) -> callable:
    """Contexts in order of number and word to one class per word; one word's counts go over to the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains, sizes = shared.value
        held: tuple[int, bytes, np.ndarray] | None = None

        def out(number, word, counts) -> pa.RecordBatch:
            score = counts @ gains - counts[:, :KINDS].sum(1, keepdims=True) * sizes
            return pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), pa.array(word, pa.binary()), pa.array(score.argmax(1), pa.int32())],
                ["number", "word", "class"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            number, word = batch.column("number").to_numpy(), batch.column("word")
            new = np.append(True, number[1:] != number[:-1])
            new[1:] |= pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            lengths = pc.binary_length(batch.column("codes")).to_numpy(zero_copy_only=False)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8)
            ns = np.frombuffer(b"".join(batch.column("ns").to_pylist()), np.uint32)
            home = np.repeat(np.cumsum(new) - 1, lengths)
            counts = np.bincount(home * (2 * KINDS) + codes, ns, len(starts) * 2 * KINDS).reshape(-1, 2 * KINDS)
            numbers, words = number[starts].tolist(), word.take(pa.array(starts)).to_pylist()
            if held and held[:2] == (numbers[0], words[0]):
                counts[0] += held[2]
            elif held:
                yield out([held[0]], [held[1]], held[2][None])
            held = numbers[-1], words[-1], counts[-1].copy()
            yield out(numbers[:-1], words[:-1], counts[:-1])
        if held:
            yield out([held[0]], [held[1]], held[2][None])

    return run


def _count_transitions(shared) -> callable:
    """Pairs of classes where both are known without a join."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, end = shared.value
        total = np.zeros(KINDS * KINDS, np.int64)
        for batch in _sliced(batches):
            for left, right in _blocks(_flat(batch)[0], end):
                a, b = class_of[left], class_of[right]
                both = (a != RARE) & (b != RARE)
                total += np.bincount(a[both] * KINDS + b[both], minlength=KINDS * KINDS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some // KINDS, pa.int32()), pa.array(some % KINDS, pa.int32()), pa.array(total[some])],
            ["left", "right", "n"],
        )

    return count


RARE_TOKENS = "row bigint, learn boolean, at int, word binary, left int, shape int, right int"


def _rare_tokens(shared) -> callable:
    """Each token that needs a join, with its place among those of its text and its neighbours' classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, end = shared.value
        known = end - SHAPES
        for batch in _sliced(batches):
            t, lengths = _flat(batch)
            rare = np.flatnonzero((t >= known) & (t < end))
            text = np.repeat(np.arange(len(lengths)), lengths)[rare]
            firsts = np.searchsorted(text, text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(text)),
                    batch.column("learn").take(pa.array(text)),
                    pa.array(np.arange(len(rare)) - firsts, pa.int32()),
                    batch.column("rare").flatten(),
                    pa.array(class_of[_before(t, end)[rare]], pa.int32()),
                    pa.array(CLASSES + t[rare] - known, pa.int32()),
                    pa.array(class_of[t[rare + 1]], pa.int32()),
                ],
                ["row", "learn", "at", "word", "left", "shape", "right"],
            )

    return run


@dataclass
class ClassModel:
    """Transitions and emissions by class; the counts and classes of all words are the table `words`."""

    words: DataFrame
    rare: DataFrame
    vocabulary: Vocabulary
    class_of: np.ndarray
    logs: np.ndarray
    transitions: np.ndarray
    emission: np.ndarray
    ends: int
    total: int
    distinct: int


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n over all rows of texts: text."""
    return texts.select("text").mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _above(counts: DataFrame, most: int) -> int:
    """The smallest of a ladder of counts that at most `most` words reach."""
    step = F.floor(F.log2("n") * 8).cast("int")
    rungs = counts.groupBy(step.alias("rung")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    least, words = 1 << 62, 0
    for rung in sorted(rungs, key=lambda r: -r["rung"]):
        words += rung["words"]
        if words > most:
            break
        least = rung["least"]
    return least


def vocabulary(counts: DataFrame, class_words: int = CLASS_WORDS, known: int = KNOWN) -> tuple[Vocabulary, np.ndarray]:
    """The words numbered by frequency, at most `known`, and their counts."""
    frequent = counts.where(F.col("n") >= _above(counts, known)).select("word", "n").toPandas()
    pairs = sorted(zip(map(bytes, frequent["word"]), frequent["n"]), key=lambda x: (-x[1], x[0]))
    numbers = {w: i for i, (w, _) in enumerate(pairs)}
    shapes = np.array([shape(w) for w in numbers], np.int64)
    return Vocabulary(numbers, min(class_words, len(numbers)), shapes), np.array([n for _, n in pairs], np.int64)


def _table(shares: DataFrame) -> np.ndarray:
    """left, right, n to a matrix of classes."""
    got = shares.groupBy("left", "right").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((KINDS, KINDS))
    out[got["left"].to_numpy(np.int64), got["right"].to_numpy(np.int64)] = got["n"]
    return out


def _logs(between: np.ndarray) -> np.ndarray:
    return np.log10((between + ADD) / (between.sum(1, keepdims=True) + ADD * KINDS))


def exchanged(pairs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the exchange's tokens, and how often class follows class."""
    words = vocabulary.class_words
    classes = np.concatenate([np.arange(words) % CLASSES, CLASSES + np.arange(SHAPES + 1)])
    for _ in range(PASSES):
        right = _neighbours(pairs, classes, "left", "right")
        left = _neighbours(pairs, classes, "right", "left")
        classes = exchange(classes, right, left, words)
    between = np.zeros((KINDS, KINDS))
    np.add.at(between, classes, _neighbours(pairs, classes, "left", "right"))
    return classes, between


def train(
    docs: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    class_words: int = CLASS_WORDS,
    known: int = KNOWN,
) -> tuple[DataFrame, ClassModel]:
    """All texts numbered, and the model of those where `learn` holds."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    texts = docs.select(
        F.col(key).cast("bigint").alias("key"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.col(text).cast("string").alias("text"),
    )
    counts = stage(word_counts(texts.where("learn")), "word-counts")
    vocab, known_n = vocabulary(counts, class_words, known)
    shared = share(vocab)
    numbered = stage(texts.mapInArrow(_number(shared), NUMBERED), "numbered-texts")
    learned = numbered.where("learn")

    pairs = stage(
        learned.select("tokens").mapInArrow(_count_pairs(shared), "left int, right int, n bigint")
        .groupBy("left", "right")
        .agg(F.sum("n").alias("n")),
        "word-pairs",
    )
    classes, between = exchanged(pairs, vocab)

    # what a neighbour adds to each class, and what a token of a class of that size loses
    follows = _logs(between)
    gains = np.concatenate([follows[:, :CLASSES], follows[:CLASSES].T])
    sizes = np.log10(between.sum(0)[:CLASSES] + 1)
    placed = stage(
        learned.select("tokens", "rare")
        .mapInArrow(_count_contexts(share((vocab, classes))), CONTEXTS)
        .repartition("number", "word")
        .sortWithinPartitions("number", "word")
        .mapInArrow(_best_classes(share((gains, sizes))), "number int, word binary, class int"),
        "word-classes",
    )
    class_of = np.concatenate([classes[vocab.coarse()[: vocab.end - SHAPES]], np.full(SHAPES, RARE), [KINDS - 1]])
    numbers = placed.where("number >= 0").select("number", "class").toPandas()  # at most `known` rows
    class_of[numbers["number"].to_numpy(np.int64)] = numbers["class"]

    lookup = share((class_of, vocab.end))
    rare = rare_tokens(numbered, counts, placed, lookup)
    steps = learned.select("tokens").mapInArrow(_count_transitions(lookup), "left int, right int, n bigint")
    more = rare.where("learn")
    one = F.lit(1).cast("bigint").alias("n")
    between = _table(
        steps.union(more.where(F.col("left") != RARE).select("left", "own", one)).union(more.select("own", "right", one))
    )

    rest = counts.join(placed.where("number < 0").select("word", "class"), "word")
    tokens_in, distinct_in = np.zeros(KINDS), np.zeros(KINDS)
    own = class_of[: len(known_n)]
    np.add.at(tokens_in, own, known_n)
    np.add.at(distinct_in, own, 1)
    for r in rest.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        tokens_in[r["class"]] += r["n"]
        distinct_in[r["class"]] += r["words"]
    ends = int(between[:, -1].sum())
    tokens_in[-1], distinct_in[-1] = ends, min(ends, 1)
    logs = np.log10(np.concatenate([known_n, np.full(SHAPES, 1 - ADD), [ends]]) + ADD)  # 0 for what a join adds
    return numbered, ClassModel(
        rest.select("word", "n", "class"), rare, vocab, class_of, logs, _logs(between),
        np.log10(tokens_in + ADD * (distinct_in + 1)), ends, int(tokens_in.sum()), int(distinct_in.sum()),
    )


def rare_tokens(numbered: DataFrame, counts: DataFrame, placed: DataFrame, lookup) -> DataFrame:
    """row, learn, left, own, right, n: tokens that need a join, their neighbours' classes and their count.

    `left` is RARE where the token before is in the table too; its `right` has that pair.
    """
    found = numbered.select("row", "learn", "tokens", "rare").mapInArrow(_rare_tokens(lookup), RARE_TOKENS)
    of = counts.select("word", "n").join(placed.where("number < 0").select("word", "class"), "word")
    own = found.join(of, "word", "left").select(
        "row", "learn", "at", "left", F.coalesce("class", "shape").alias("own"), "right", F.coalesce("n", F.lit(0)).alias("n")
    )
    after = F.lead("own").over(Window.partitionBy("row").orderBy("at"))
    return stage(
        own.withColumn("right", F.when(F.col("right") == RARE, after).otherwise(F.col("right"))).drop("at"), "rare-tokens"
    )


def _sum_texts(shared) -> callable:
    """Both scores of each text without what its rare tokens add."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, logs, transitions, emission, ends, floor = shared.value
        # one more row and column, for RARE, of zeros
        steps, weights = np.pad(transitions, (0, 1)), np.append(emission, 0.0)
        end = len(logs) - 1
        for batch in _sliced(batches):
            t, lengths = _flat(batch)
            starts = np.cumsum(lengths) - lengths
            own = class_of[t]
            counted = np.add.reduceat(logs[t], starts)
            moved = np.add.reduceat(steps[class_of[_before(t, end)], own] - weights[own], starts)
            rare = np.add.reduceat((own == RARE).astype(np.int64), starts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("key"), pa.array(lengths, pa.int64()),
                    pa.array(lengths - rare - (ends == 0), pa.int64()),
                    pa.array(counted - lengths * floor), pa.array(counted + moved),
                ],
                ["row", "key", "n_tokens", "n_known", "base", "score"],
            )

    return run


def scores(numbered: DataFrame, model: ClassModel, key: str = "doc_id") -> DataFrame:
    """One row per text that `train` numbered: key, n_tokens, n_known, train_tokens, base_score, score."""
    floor = float(np.log10(model.total + ADD * (model.distinct + 1)))
    shared = numbered.sparkSession.sparkContext.broadcast(
        (model.class_of, model.logs, model.transitions, model.emission, model.ends, floor)
    )
    texts = numbered.select("row", "key", "tokens").mapInArrow(
        _sum_texts(shared), "row bigint, key bigint, n_tokens bigint, n_known bigint, base double, score double"
    )
    steps, emission = np.pad(model.transitions, (0, 1)), model.emission

    @F.arrow_udf(DoubleType())
    def moved(left: pa.Array, own: pa.Array, right: pa.Array) -> pa.Array:
        a, b, c = (x.to_numpy(zero_copy_only=False) for x in (left, own, right))
        return pa.array(steps[a, b] + steps[b, c] - emission[b])

    rare = (
        model.rare.withColumn("moved", moved("left", "own", "right"))
        .groupBy("row")
        .agg(
            F.sum(F.log10(F.col("n") + ADD)).alias("logs"),
            F.sum("moved").alias("moved"),
            F.count(F.when(F.col("n") > 0, 1)).alias("seen"),
        )
    )
    return texts.join(rare, "row", "left").select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce(F.col("logs") + F.col("moved"), F.lit(0.0))).alias("score"),
    )
