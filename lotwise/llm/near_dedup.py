"""Near duplicates by a multi-index Hamming join on b-bit MinHash signatures.

A document's set of word shingles is summarised by `SLOTS` minima of 16 bits.
The signature is split into `CHUNKS` chunks of `WIDTH` slots. Two signatures
that differ in at most `DISTANCE` slots agree, by the pigeonhole principle, in
all but one slot of some chunk; so every chunk is entered once for each slot
left out, and all pairs within that distance meet under some key. Pairs beyond
it may meet too; those that differ in more than `SCREEN` slots are not compared
(at a similarity of 0.8 that happens once in about 100,000 pairs). What is left
is confirmed on the full shingle sets.

Links are wanted as components, so a group of copies is not expanded to its
pairs. Documents with equal sets become one class first. Each key has a centre,
the first of its classes in one fixed random order; every class is confirmed
against the nearest of its centres, and confirmed links merge components. What
shares a key across components is then compared in blocks: classes with the same
first centre share a home of bounded size, and two homes (or one with itself)
meet once with those of their classes that share such a key, however many keys
those are. Inside a block signatures are compared first, then full sets, and only
links that join two components leave it. So no link between components is missed
among pairs that meet, and no pair leaves a block unconfirmed.

Scale. One pass over the texts makes sketches; entries shuffle as (key, class),
and only keys with two classes go on. Texts are read a second time for classes
that have a partner, joined on their id; their sets are computed after that join. Full sets go to blocks, not to pairs or
keys. Homes hold about `BLOCK` shingles, so a group that has more is split over
as many tasks as it has pairs of homes; homes that are in one component do not
meet. Hot keys are minima per key and joins that adaptive execution can split;
intermediate tables are written to the shared folder.

Defined cases. Texts without words, and null texts, have no shingle and are
linked with nothing. A text with fewer words than a shingle has the whole
sequence as its only shingle. Rows that repeat a doc_id with the same set are
one document; with another set they are one more row of that document, linked
with what any of its sets is. Rows without a doc_id have no row in the result. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import free_name, whole_text
from lotwise.llm.components import components
from lotwise.operators.staging import stage

CHUNKS, WIDTH = 10, 5
SLOTS = CHUNKS * WIDTH
DISTANCE = 2 * CHUNKS - 1
SCREEN = 24
#: Shingles of the classes that make one home.
BLOCK = 1 << 18
TABLE = 1 << 18
BYTES = 1 << 24
PART = 1 << 15
_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(1, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    """Hashes of words; emptied at `TABLE` words or `BYTES` bytes of them."""

    held = 0

    def __missing__(self, word: bytes) -> int:
        self.held += len(word)
        if len(self) > TABLE or self.held > BYTES:
            self.clear()
            self.held = len(word)
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def shingle_hashes(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """Distinct hashes, sorted, of the runs of that many words; A-Z lowered."""
    parts = text.encode().lower().split()
    row = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    words = min(words, len(row))
    if not words:
        return row
    out = np.full(len(row) - words + 1, words, np.uint64)
    for i in range(words):
        out = out * _STEP + row[i : len(row) - words + 1 + i]
        out ^= out >> np.uint64(29)
    out *= _MIX
    return np.unique(out ^ (out >> np.uint64(32)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the smallest value of each of SLOTS hash functions."""
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), PART):
        part = shingles[low : low + PART, None] * _FACTORS + _SHIFTS
        least = np.minimum(least, part.min(axis=0))
    return ((least >> np.uint64(20)) & np.uint64(0xFFFF)).astype(np.int32)


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


SKETCH = "n bigint, digest binary, slots array<int>"


def sketched(text: str, words: int) -> Column:
    @F.arrow_udf(SKETCH)
    def sketch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for batch in texts:
            n, digests, slots = [], [], []
            for t in batch:
                found = shingle_hashes(t.as_py() or "", words, hashes)
                n.append(len(found))
                digests.append(digest(found))
                slots.append(signature(found) if len(found) else None)
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(slots, pa.list_(pa.int32()))],
                ["n", "digest", "slots"],
            )

    return sketch(whole_text(text))


def full_set(text: str, words: int) -> Column:
    """The digest and the sorted hashes of a text's set."""

    @F.arrow_udf("digest binary, hashes array<bigint>")
    def hashes_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for batch in texts:
            found = [shingle_hashes(t.as_py() or "", words, hashes) for t in batch]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([digest(f) for f in found], pa.binary()),
                    pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64())),
                ],
                ["digest", "hashes"],
            )

    # not deterministic to the optimizer, which would else compute the sets of all texts below the join
    return hashes_of.asNondeterministic()(whole_text(text))


def entries(classes: DataFrame) -> DataFrame:
    """key, node: every chunk of a signature with each of its slots left out."""
    keys = [
        F.xxhash64(F.lit(i), *[F.col("slots")[c * WIDTH + s] for s in range(WIDTH) if s != i % WIDTH])
        for i, c in ((c * WIDTH + s, c) for c in range(CHUNKS) for s in range(WIDTH))
    ]
    every = classes.select("node", F.explode(F.array(*keys)).alias("key")).repartition("key")
    shared = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return every.join(shared.hint("merge"), "key")


def differing(left: str, right: str) -> Column:
    """The number of slots in which two signatures differ."""
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: (a != b).cast("int")), F.lit(0), lambda total, one: total + one
    )


def _screened(left: str, right: str) -> Column:
    """Sizes alone allow the similarity, and the signatures are near enough."""
    sizes = 5 * F.least(f"{left}_n", f"{right}_n") >= 4 * F.greatest(f"{left}_n", f"{right}_n")
    return sizes & (differing(f"{left}_slots", f"{right}_slots") <= SCREEN)


def _side(classes: DataFrame, name: str) -> DataFrame:
    return classes.select(
        F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("slots").alias(f"{name}_slots")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs a, b those whose full sets have 100 * shared >= 80 * all."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    right = right.join(pairs.select("b").distinct().hint("merge"), "b", "left_semi")
    both = F.size(F.array_intersect("ha", "hb"))
    return (
        pairs.join(left.hint("merge"), "a")
        .join(right.hint("merge"), "b")
        .where(100 * both >= 80 * (F.size("ha") + F.size("hb") - both))
        .select("a", "b")
    )


def class_links(docs: DataFrame, classes: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """node, root for every class that shares a key with another."""
    shared = stage(entries(classes), "near-entries")
    classes = stage(classes.join(shared.select("node").distinct().hint("merge"), "node", "left_semi"), "near-classes")
    # the digest tells texts under one doc_id apart; a text is shuffled, not its set, and only where it has a partner
    texts = docs.select(F.col(key).alias("node"), whole_text(text).alias("text")).join(
        classes.select("node", "digest", "slots"), "node"
    )
    made = texts.distinct().select("node", "digest", "slots", full_set("text", words).alias("s"))
    sets = stage(made.where("s.digest = digest").select("node", "slots", "s.hashes"), "near-sets")
    centres = shared.groupBy("key").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("centre"))
    near = stage(shared.join(centres.hint("merge"), "key").select("node", "centre").distinct(), "near-centres")
    met = (
        near.select(F.col("node").alias("a"), F.col("centre.node").alias("b"))
        .where("a <> b")
        .join(_side(classes, "a").hint("merge"), "a")
        .join(_side(classes, "b").hint("merge"), "b")
        .where(_screened("a", "b"))
        .groupBy("a")
        .agg(F.min_by("b", differing("a_slots", "b_slots")).alias("b"))
    )
    roots = classes.select("node", F.col("node").alias("root")).distinct()
    roots = _merged(roots, stage(_confirmed(stage(met, "near-met"), sets), "near-links"))
    seats = needed_seats(shared.join(roots.hint("merge"), "node"), homes(near, classes))
    blocks = seats.join(sets.hint("merge"), "node").groupBy("low", "high")
    return _merged(roots, stage(blocks.applyInArrow(links_of_block, "a bigint, b bigint"), "near-links"))


def homes(near: DataFrame, classes: DataFrame) -> DataFrame:
    """node, home: classes around one centre share a home, of BLOCK shingles or so; more of them are split."""
    families = near.groupBy("node").agg(F.min("centre").alias("family")).join(classes.select("node", "n").hint("merge"), "node")
    parts = families.groupBy("family").agg(F.ceil(F.sum("n") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), "parts")
    return stage(
        families.join(parts.hint("merge"), "family").select("node", F.xxhash64("family.node", part).alias("home")), "near-homes"
    )


def meetings(at_key: DataFrame) -> DataFrame:
    """key, meeting: of keys with several components, one of those at which the same homes have the same. at_key: key, home, of."""
    keys = at_key.groupBy("key").agg(
        *[F.bit_xor(F.xxhash64(F.lit(i), "home", F.col("of").isNull(), "of")).alias(f"mark{i}") for i in range(2)],
        F.count("*").alias("homes"),
        (F.bool_or(F.col("of").isNull()) | (F.min("of") != F.max("of"))).alias("open"),
    ).where("open")
    marks = ["mark0", "mark1", "homes"]
    firsts = keys.groupBy(*marks).agg(F.min("key").alias("meeting"))
    return keys.join(firsts.hint("merge"), marks).select("key", "meeting")


def needed_seats(found: DataFrame, home: DataFrame) -> DataFrame:
    """low, high, node, root, home: the classes that two homes must compare, as they share a key across components.

    Keys at which the same homes meet, with the same components, ask for the same pairs of homes. They are
    one meeting, which a class attends once, however many of its keys lead there.
    """
    held = stage(found.join(home.hint("merge"), "node"), "near-held")
    at_key = held.groupBy("key", "home").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    # the component of what a home has at a key; null if there are more
    at_key = stage(at_key.select("key", "home", F.when(F.col("least") == F.col("most"), F.col("least")).alias("of")), "near-at-key")
    meeting = stage(meetings(at_key), "near-meetings")
    there = at_key.join(meeting.where("key = meeting").hint("merge"), "key").select("meeting", "home", "of")
    other = there.select("meeting", *[F.col(c).alias(f"other_{c}") for c in ("home", "of")])
    pairs = there.join(other.hint("merge"), "meeting").where("of is null or other_of is null or of <> other_of")
    attends = held.join(meeting.hint("merge"), "key").select("meeting", "home", "node", "root").distinct()
    seats = attends.join(pairs.select("meeting", "home", "other_home").hint("merge"), ["meeting", "home"])
    return seats.select(
        F.least("home", "other_home").alias("low"), F.greatest("home", "other_home").alias("high"), "node", "root", "home"
    ).distinct()


def links_of_block(rows: pa.Table) -> pa.Table:
    """Confirmed links between components of two homes' classes; enough of them to join what is joined."""
    rows = rows.sort_by("node").combine_chunks()
    slots = _flat(rows, "slots").astype(np.uint16).reshape(len(rows), SLOTS)
    sizes = rows["hashes"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.unique(_flat(rows, "hashes"), return_inverse=True)[1]
    own, present = np.unique(rows["root"].to_numpy(), return_inverse=True)[1], np.zeros(ids.max() + 1, bool)
    low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
    far = rows["home"].to_numpy() != low if low != high else None
    links = []
    for a in range(1, len(rows)):
        able = (own[:a] != own[a]) & (5 * np.minimum(sizes[:a], sizes[a]) >= 4 * np.maximum(sizes[:a], sizes[a]))
        if far is not None:
            able &= far[:a] != far[a]
        others = np.flatnonzero(able)
        others = others[(slots[others] != slots[a]).sum(axis=1) <= SCREEN]
        mine = ids[starts[a] : starts[a + 1]]
        present[mine] = True
        for b in others:
            if own[a] != own[b]:
                both = np.count_nonzero(present[ids[starts[b] : starts[b + 1]]])
                if 100 * both >= 80 * (sizes[a] + sizes[b] - both):
                    links.append((a, b))
                    own[own == own[b]] = own[a]
        present[mine] = False
    ends = np.array(links, np.int64).reshape(-1, 2)
    nodes = rows["node"].to_numpy()
    return pa.table({"a": nodes[ends[:, 0]], "b": nodes[ends[:, 1]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def _flat(rows: pa.Table, column: str) -> np.ndarray:
    """The elements of a list column, one row after the other."""
    return rows[column].combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots after the links' components are joined."""
    ends = links.join(roots.withColumnRenamed("node", "a").withColumnRenamed("root", "ra").hint("merge"), "a")
    ends = ends.join(roots.withColumnRenamed("node", "b").withColumnRenamed("root", "rb").hint("merge"), "b")
    moved = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b"))).toDF("root", "to")
    return stage(
        roots.join(moved.hint("merge"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "near-roots"
    )


def near_groups(docs: DataFrame, words: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept (one document of each component)."""
    made = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), sketched(text, words).alias("s"))
    sketches = stage(made.select("doc", "s.*").groupBy("doc", "digest").agg(F.first("n").alias("n"), F.first("slots").alias("slots")), "sketches")
    classes = stage(
        sketches.where("n > 0")
        .groupBy("digest")
        .agg(F.min("doc").alias("node"), F.first("n").alias("n"), F.first("slots").alias("slots")),
        "set-classes",
    )
    roots = class_links(docs, classes, words, key, text)
    named = classes.select("digest", "node")
    named = named.join(roots.hint("merge"), "node", "left").select("digest", F.coalesce("root", "node").alias("component_id"))
    return (
        sketches.select("doc", "digest", "n")
        .join(named.hint("merge"), "digest", "left")
        .select(
            F.col("doc").alias(key),
            F.col("n").alias("n_shingles"),
            F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), "doc").alias("component_id"),
            (F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), "doc") == F.col("doc")).alias("kept"),
        )
    )


def keep_one(docs: DataFrame, words: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each component; rows without a key stay."""
    doc = free_name(docs, "doc")
    gone = near_groups(docs, words, key, text).where("not kept").select(F.col(key).alias(doc))
    return docs.join(gone, F.col(key) == F.col(doc), "left_anti")
