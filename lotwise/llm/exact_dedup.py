"""Exact duplicates by composable polynomial fingerprints.

A text is cut into chunks, every chunk gets a polynomial hash modulo four
primes, and chunk hashes combine by shifting with the length of what follows:
H(ab) = H(a) * x^len(b) + H(b). Equal fingerprints only propose equality: the
texts behind them are streamed past one another, chunk by chunk.

Scale. The scan sends one small row per document onward. Texts move once, and
only to the documents' own ids; of them only those that share a fingerprint go
on to the comparison. A fingerprint's documents are dealt to sub-groups of
about `SUBGROUP` rows, each compared in one sorted pass that holds one text per
distinct text, then the sub-groups' first documents are compared alike, so that
copies may make up any share of all rows.

Defined cases. A null text is empty, and empty texts are equal. Rows that
repeat a doc_id with the same text are one document; with different texts they
are one document per text, each in the group of its own text. Rows without a doc_id
cannot be named in the result and have no row in it. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from lotwise.llm.common import free_name, whole_text
from lotwise.operators.staging import stage

CHUNK = 1 << 14
SUBGROUP = 4096
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1664525007, 1597334677, 1812433253)


def _powers(base: int, prime: int, count: int) -> np.ndarray:
    """base^(count-1) .. base^0 modulo prime."""
    out = [1]
    for _ in range(count - 1):
        out.append(out[-1] * base % prime)
    return np.array(out[::-1], dtype=np.uint64)


_POWERS = np.stack([_powers(b, p, CHUNK) for b, p in zip(BASES, PRIMES)], axis=1)
_PRIMES = np.array(PRIMES, dtype=np.uint64)

#: A fingerprint: length in bytes, and a hash for each prime.
Fingerprint = tuple[int, tuple[int, ...]]
EMPTY: Fingerprint = (0, (0,) * len(PRIMES))


def combine(left: Fingerprint, right: Fingerprint) -> Fingerprint:
    """The fingerprint of two texts in a row, from theirs."""
    hashes = tuple(
        (a * pow(base, right[0], prime) + b) % prime
        for a, b, base, prime in zip(left[1], right[1], BASES, PRIMES)
    )
    return left[0] + right[0], hashes


def fingerprint(data: bytes) -> Fingerprint:
    """All whole chunks are hashed at once; the chunk hashes then combine."""
    codes = np.frombuffer(data, dtype=np.uint8)
    whole = len(codes) // CHUNK
    # a sum of CHUNK products of 8 and 31 bits stays below 2^53
    heads = (codes[: whole * CHUNK].reshape(whole, CHUNK).astype(np.uint64) @ _POWERS) % _PRIMES if whole else []
    rest = codes[whole * CHUNK :].astype(np.uint64)
    tail = (rest @ _POWERS[CHUNK - len(rest) :]) % _PRIMES
    out = EMPTY
    for head in heads:
        out = combine(out, (CHUNK, tuple(int(h) for h in head)))
    return combine(out, (len(rest), tuple(int(h) for h in tail)))


def packed(data: bytes) -> bytes:
    length, hashes = fingerprint(data)
    return struct.pack(">Q4I", length, *hashes)


@F.arrow_udf(BinaryType())
def text_fingerprint(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array((packed((t.as_py() or "").encode()) for t in batch), pa.binary())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, sha (of the text, hex), print."""
    whole = whole_text(text)
    return (
        docs.where(F.col(key).isNotNull())
        .select(F.col(key).alias("doc"), F.sha2(whole, 256).alias("sha"), text_fingerprint(whole).alias("print"))
        .groupBy("doc", "sha")
        .agg(F.first("print").alias("print"))
    )


def same(left: bytes, right: bytes) -> bool:
    """Chunkwise comparison that ends at the first chunk that differs."""
    a, b = memoryview(left), memoryview(right)
    return len(a) == len(b) and all(a[i : i + CHUNK] == b[i : i + CHUNK] for i in range(0, len(a), CHUNK))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (group, doc): each document's first equal one, and that one's text."""
    group, firsts = None, []
    for batch in batches:
        firsts_out, texts = [], []
        for i in range(batch.num_rows):
            own = batch.column(0)[i].as_py()
            doc, text = batch.column(2)[i].as_py(), batch.column(4)[i].as_py()
            if own != group:
                group, firsts = own, []
            first = next((d for d, t in firsts if same(t, text)), None)
            if first is None:
                first = doc
                firsts.append((doc, text))
                texts.append(text)
            else:
                texts.append(None)
            firsts_out.append(first)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:4], pa.array(firsts_out, pa.int64()), pa.array(texts, pa.binary())],
            ["print", "doc", "sha", "first", "text"],
        )


def _compared(rows: DataFrame) -> DataFrame:
    """rows: group, print, doc, sha, text as bytes."""
    return (
        rows.select("group", "print", "doc", "sha", "text")
        .repartition("group")
        .sortWithinPartitions("group", "doc")
        .mapInArrow(_stream, "print binary, doc bigint, sha string, first bigint, text binary")
    )


def equal_classes(docs: DataFrame, prints: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, sha, same_as: for documents that share a fingerprint, the first document with the same text."""
    shared = prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1")
    members = (
        prints.join(shared.hint("merge"), "print")
        .withColumn("part", F.pmod(F.xxhash64("doc"), F.ceil(F.col("n") / SUBGROUP)))
        .select("doc", "sha", "print", F.concat("print", F.col("part").cast("string").cast("binary")).alias("group"))
    )
    whole = docs.select(F.col(key).alias("doc"), whole_text(text).alias("text"))
    texts = (
        whole.join(members, "doc")
        .where(F.sha2("text", 256) == F.col("sha"))
        .withColumn("text", F.col("text").cast("binary"))
    )
    inner = stage(_compared(texts), "equal-texts")
    outer = _compared(inner.where("text is not null").withColumn("group", F.col("print")))
    # an id has a row per text, and texts of one class have one digest
    return (
        inner.select("doc", "sha", "first")
        .join(outer.select(F.col("doc").alias("first"), "sha", F.col("first").alias("same_as")).hint("merge"), ["first", "sha"])
        .select("doc", "sha", "same_as")
        .distinct()
    )


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, keep_id (largest key among equal texts), group_size, kept, text_sha256."""
    prints = stage(fingerprints(docs, key, text), "fingerprints")
    classes = stage(equal_classes(docs, prints, key, text), "equal-classes")
    kept = classes.groupBy("same_as", "sha").agg(F.max("doc").alias("keep"), F.count("*").alias("size"))
    found = classes.join(kept.hint("merge"), ["same_as", "sha"]).select("doc", "sha", "keep", "size")
    return prints.join(found.hint("merge"), ["doc", "sha"], "left").select(
        F.col("doc").alias(key),
        F.coalesce("keep", "doc").alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.coalesce("keep", "doc") == F.col("doc")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows whose text stays under a larger key; rows without a key stay."""
    doc, of = free_name(docs, "doc"), free_name(docs, "of")
    gone = exact_groups(docs, key, text).where("not kept").select(F.col(key).alias(doc), F.col("text_sha256").alias(of))
    same_row = (F.col(key) == F.col(doc)) & (F.sha2(whole_text(text), 256) == F.col(of))
    return docs.join(gone, same_row, "left_anti")
