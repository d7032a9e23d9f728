"""Line dedup by range-partitioned hashes and keep bitmaps.

A line's key is the line without blanks at both ends, A-Z in lower case. A key of
at least `LEAST_CHARS` code points that stands in at least `LEAST_DOCS` documents
is repeated: its lines go everywhere but in the document with the largest id that
holds it, where all of them stay.

Method. Every long enough line is a row of two 64-bit hashes of its key, its
document and its position. These rows, without any text, are dealt by range over
(hash, document), sorted by hash and then document, largest first, and each
sorted run is streamed for its first occurrences: the first `LEAST_DOCS`
documents of a hash say whether the key is repeated and which document keeps it.
Lines of repeated keys then come back as one compressed bitmap per document: the
lengths of the runs of kept and dropped lines in turn, a kept run (maybe of 0
lines) first; lines after the last run are kept. `with_kept_lines` applies the
bitmaps to the texts.

DataFrame functions only. Scale: what moves is some 24 bytes a line, twice, and
the hits. As the document is part of the range key, a line that a third of all
documents hold is spread over many tasks, each of which passes on at most
`LEAST_DOCS` rows of it. Lines meet the repeated keys as a broadcast while the
planner finds these small by their written size, else in a sort-merge join whose
skewed partitions adaptive execution splits. Only `with_kept_lines` moves texts,
once, by document: a merge join at any size, so that its cost stays in proportion.

Defined cases. A null or empty text is one empty line. Rows that repeat an id are
one document when documents are counted and when the largest is chosen, and each
row is returned with its own lines; equal rows have equal results. Rows without
an id count for no key and keep all their lines. Ids may be of any type that has
an order. Other columns pass through `with_kept_lines` untouched unless they bear
the name of a result column, which replaces them; private names avoid all others.
Two different keys count as one if both 64-bit hashes agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.cleaning import once
from lotwise.llm.common import ascii_lower, free_name, whole_text
from lotwise.operators.staging import stage

LEAST_CHARS = 20
LEAST_DOCS = 3
BLANKS = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc, print (a hash of the whole text), at (the position), h1, h2: one row per line that is long enough."""
    whole = whole_text(text)
    lines = docs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("doc"), F.xxhash64(whole).alias("print"), F.posexplode(split_lines(ascii_lower(whole))).alias("at", "line")
    )
    keys = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.length("line") >= least_chars)
    return keys.select("doc", "print", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))


def repeated_keys(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """h1, h2, keeper (largest document) of the keys that stand in at least `least_docs` documents."""
    dealt = lines.select(*HASH, "doc").repartitionByRange(*HASH, F.col("doc").desc()).distinct()
    ordered = dealt.sortWithinPartitions(*HASH, F.col("doc").desc())
    first = Window.partitionBy(*HASH).orderBy(F.col("doc").desc())
    seen = ordered.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= least_docs)
    held = seen.groupBy(*HASH).agg(F.max("doc").alias("keeper"), F.count("*").alias("n"))
    return held.where(F.col("n") == least_docs).drop("n")


def keep_runs(dropped: Column) -> Column:
    """The bitmap of a document whose lines at the sorted positions `dropped` go."""

    def runs(at: Column) -> Column:
        first = F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) < p - 1))
        last = F.filter(at, lambda p, i: (i == F.size(at) - 1) | (F.get(at, i + 1) > p + 1))

        def lengths(ends: Column) -> Column:
            kept = lambda p, i: p - F.when(i == 0, F.lit(0)).otherwise(F.get(ends["last"], i - 1) + 1)
            return F.flatten(F.transform(ends["first"], lambda p, i: F.array(kept(p, i), F.get(ends["last"], i) - p + 1)))

        return once(F.struct(first.alias("first"), last.alias("last")), lengths)

    return once(dropped, runs)


def kept_lines(lines: Column, runs: Column) -> Column:
    """The lines that the bitmap `runs` keeps."""
    flags = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    return once(flags, lambda own: F.filter(lines, lambda _, i: F.coalesce(F.get(own, i), F.lit(True))))


def keep_bitmaps(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """doc, print, n_dropped, keep_runs: one row per document (id and text) that loses a line."""
    lines = stage(line_hashes(docs, key, text, least_chars), "line-hashes")
    repeated = stage(repeated_keys(lines, least_docs), "repeated-lines")
    gone = lines.join(repeated, HASH).where(F.col("doc") < F.col("keeper"))
    places = gone.groupBy("doc", "print").agg(F.sort_array(F.collect_set("at")).alias("places"))
    return places.select("doc", "print", F.size("places").cast("bigint").alias("n_dropped"), keep_runs(F.col("places")).alias("keep_runs"))


def with_kept_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """docs with n_lines, n_dropped, keep_runs (empty if all lines stay) and kept (the text of the lines that stay)."""
    bitmaps = keep_bitmaps(docs, key, text, least_chars, least_docs)
    doc, mark, n, runs, body = (free_name(docs, c) for c in ("doc", "print", "n", "runs", "body"))
    side = bitmaps.toDF(doc, mark, n, runs).hint("merge")
    texts = docs.withColumn(body, whole_text(text))
    same = (F.col(key) == F.col(doc)) & (F.xxhash64(body) == F.col(mark))
    lines = split_lines(F.col(body))
    kept = F.when(F.col(runs).isNull(), F.col(body)).otherwise(F.array_join(kept_lines(lines, F.col(runs)), "\n"))
    return (
        texts.join(side, same, "left")
        .withColumns(
            {
                "n_lines": F.size(lines).cast("bigint"),
                "n_dropped": F.coalesce(F.col(n), F.lit(0).cast("bigint")),
                "keep_runs": F.coalesce(F.col(runs), F.array().cast("array<int>")),
                "kept": kept,
            }
        )
        .drop(doc, mark, n, runs, body)
    )
