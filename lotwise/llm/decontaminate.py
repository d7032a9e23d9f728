"""Benchmark passages in documents by template canonicalisation.

A text becomes a row of tokens, and these a row of template tokens: numbers,
units after numbers, and names (words with a capital inside a sentence) turn into
typed placeholders, all else into lower case. The first token of a window has no
token before it, wherever the window stands, so that a window means the same in an
item and in a document.

An item is known by its windows of `WINDOW` template tokens (by its one window, if
it is shorter) that are at least half literal words; an item without such a
window by its windows of plain lower-case tokens. Documents form windows of the
same kinds and lengths, joined with the items' by hash. Matches are judged per
occurrence: matches of a document and an item belong to one run while document
position minus item position changes by at most `SLACK` from one to the next, so
that a name of two words for one of one word does not break a run, but two copies
in one document are two runs. A document holds an item if one of its runs has at
least `COVERAGE` of the item's windows, or `PASSAGE` windows, and is consistent:
of the slots (placeholders) of the run's windows, at least `CONSISTENT` have the
document value that goes with their benchmark value most often. So a question
with other numbers and names is caught, also beside its original, and a chance
match of templates with values at odds is not.

DataFrame functions only. Scale: one pass over the texts makes the windows' hashes
and meets the items' as a broadcast of at most `HASHES` distinct numbers (more of
them are dealt into blocks of that size, with a pass each), so that no text is
shuffled and none is read again for a hit: a hit leaves the pass with the hashes
of its own tokens. Hits are few rows; runs are made and judged per document and
item, so an item that many documents hold is spread over tasks.

Defined cases. An empty or null text, or one without letters and digits, has no
window and holds and is nothing. Repeated benchmark texts count for each item;
of rows that repeat an item_id each text is judged by itself, as is each text of
rows that repeat a doc_id, and the best run is returned; rows without an id are
not looked at. Other columns are ignored. Two windows are equal if their
64-bit hashes are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import free_name, whole_text
from lotwise.operators.staging import stage

WINDOW = 8
COVERAGE = 0.5
PASSAGE = 20
CONSISTENT = 0.8
SLACK = 2
HASHES = 1 << 21
PIECE = 512
#: A run of letters and digits, decimals, and the mark that may end a sentence.
TOKEN = r"[\p{L}\p{N}]+(?:[.,][0-9]+)*[.!?]?"
#: Units that follow a number.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "mile", "miles", "mg", "g", "kg", "ton", "tons",
    "ml", "l", "ms", "s", "sec", "seconds", "min", "minutes", "h", "hours", "days", "weeks", "months", "years",
    "percent", "dollars", "euros", "cents",
)
#: Codes of the placeholders; other tokens have the hash of their letters.
NUMBER, NAME, UNIT = 1, 2, 3


def _is_number(token: Column) -> Column:
    return F.ascii(token).between(48, 57)


def _template(token: Column, low: Column, before: Column, plain: Column) -> Column:
    """The code of a template token that has a token before it: a placeholder's, else that of the plain token."""
    name = ~F.startswith(token, low) & ~F.right(before, F.lit(1)).isin(".", "!", "?")
    long = lambda n: F.lit(n).cast("bigint")
    code = F.when(_is_number(token), long(NUMBER)).when(name, long(NAME)).when(_is_number(before) & low.isin(*UNITS), long(UNIT))
    return code.otherwise(plain)


def tokens(texts: DataFrame) -> DataFrame:
    """texts: id, text. id, print (a hash of the text), and per token plain and inner: its code, and as a template token."""
    raw = texts.select("id", F.xxhash64("text").alias("print"), F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)).alias("raw"))
    low = raw.where(F.size("raw") > 0).withColumn("low", F.transform("raw", lambda t: F.lower(F.rtrim(t, F.lit(".!?")))))
    plain = low.withColumn("plain", F.transform("low", lambda t: F.xxhash64(t)))
    inner = F.transform("raw", lambda t, i: _template(t, F.get("low", i), F.get("raw", i - 1), F.get("plain", i)))
    return plain.select("id", "print", "plain", inner.alias("inner"))


def _first(at: Column) -> Column:
    """The code of a template token at the start of a window."""
    return F.when(F.get("inner", at) == NUMBER, F.lit(NUMBER).cast("bigint")).otherwise(F.get("plain", at))


def _window(at: Column, length: int, literal: bool) -> Column:
    """The hash of the window there, of plain tokens if `literal`."""
    rest = [F.get("plain" if literal else "inner", at + i) for i in range(1, length)]
    return F.xxhash64(F.lit(length + WINDOW * literal), F.get("plain", at) if literal else _first(at), *rest)


def window_hashes(texts: DataFrame, shapes: list[tuple[int, bool]]) -> DataFrame:
    """id, print, at, hash, codes (of its plain tokens): one row per window.

    Texts are cut into pieces first, so that no row grows with its text. From there on generated code reads a
    piece's arrays in place, and only windows that a join lets through take codes along.
    """
    starts = F.sequence(F.lit(0), F.size("plain") - 1, F.lit(PIECE))
    pieces = F.transform(starts, lambda base: F.struct(base.alias("base"), *[
        F.slice(c, base + 1, PIECE + WINDOW - 1).alias(c) for c in ("plain", "inner")
    ]))
    rows = tokens(texts).select("id", "print", F.explode(pieces).alias("p")).select("id", "print", "p.*")
    last = F.least(F.size("plain"), F.lit(PIECE)) - 1
    places = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("place"))
    fits = [(F.col("place") + n <= F.size("plain"), n, x) for n, x in shapes]
    hashes = [F.when(fit, _window(F.col("place"), n, x)) for fit, n, x in fits]
    made = places.withColumn("hash", hashes[0] if len(shapes) == 1 else F.explode(F.array(*hashes)))
    codes = F.slice("plain", F.col("place") + 1, WINDOW)
    return made.where("hash IS NOT NULL").select("id", "print", (F.col("base") + F.col("place")).alias("at"), "hash", codes.alias("codes"))


def item_windows(items: DataFrame) -> DataFrame:
    """item, own (a hash of its text), place, hash, length, literal, codes (of the plain tokens), slots (of each token:
    the placeholder's code, or NULL), windows (how many the text has)."""
    found = tokens(items).withColumn("length", F.least(F.size("plain"), F.lit(WINDOW)))
    at = found.select("*", F.explode(F.sequence(F.lit(0), F.size("plain") - F.col("length"))).alias("at"))
    template = F.concat(F.array(_first(F.col("at"))), F.slice("inner", F.col("at") + 2, F.col("length") - 1))
    cut = at.withColumn("codes", F.slice("plain", F.col("at") + 1, F.col("length")))
    cut = cut.withColumn("slots", F.transform(template, lambda t: F.when(t.isin(NUMBER, NAME, UNIT), t)))
    usable = F.size(F.filter("slots", lambda t: t.isNull())) * 2 >= F.col("length")
    text = Window.partitionBy("id", "print")
    cut = cut.withColumn("usable", usable).withColumn("literal", ~F.max("usable").over(text)).where("usable OR literal")
    shapes = [(n, literal) for n in range(1, WINDOW + 1) for literal in (False, True)]
    hashes = [F.when((F.col("length") == n) & (F.col("literal") == x), _window(F.col("at"), n, x)) for n, x in shapes]
    slots = F.when(F.col("literal"), F.transform("slots", lambda t: F.lit(None).cast("bigint"))).otherwise(F.col("slots"))
    return cut.select(
        F.col("id").alias("item"), F.col("print").alias("own"), F.col("at").alias("place"), F.coalesce(*hashes).alias("hash"),
        "length", "literal", "codes", slots.alias("slots"), F.count("*").over(text).alias("windows"),
    )


def _hits(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, print, at, hash, theirs (the codes of the window's tokens): the windows that are an item's too."""
    # at most two kinds of each length
    shapes = [tuple(r) for r in wanted.select("length", "literal").distinct().orderBy("length", "literal").collect()]
    hashes = wanted.select("hash").distinct()
    blocks = -(-hashes.count() // HASHES)
    found = []
    for block in range(blocks):
        own = hashes.where(F.pmod("hash", F.lit(blocks)) == block)
        met = window_hashes(texts, shapes).join(F.broadcast(own), "hash")
        cut = met.select("id", "print", "at", "hash", F.col("codes").alias("theirs"))
        found.append(stage(cut, "window-hits"))
    if not found:
        return texts.selectExpr("id", "0L AS print", "0 AS at", "0L AS hash", "array(0L) AS theirs").where("false")
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    return hits.distinct()


def _runs(hits: DataFrame) -> DataFrame:
    """Adds run: matches of a document and item whose offset changes little from one to the next."""
    by_offset = Window.partitionBy("id", "print", "item", "own").orderBy("offset")
    step = F.col("offset") - F.lag("offset").over(by_offset)
    runs = hits.withColumn("new", F.coalesce((step > SLACK).cast("int"), F.lit(0)))
    return runs.withColumn("run", F.sum("new").over(by_offset)).drop("new")


def passages(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """key, item_key, matched, windows, slots, consistent: the best run of each document and item it holds."""
    own = items.where(F.col(item_key).isNotNull()).select(F.col(item_key).alias("id"), whole_text(item_text).alias("text"))
    wanted = stage(item_windows(own.distinct()), "item-windows")
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), whole_text(text).alias("text"))
    found = _hits(texts, wanted).join(wanted, "hash").select(
        "id", "print", "item", "own", "windows", "place", (F.col("at") - F.col("place")).alias("offset"),
        F.arrays_zip(F.col("slots").alias("kind"), F.col("codes").alias("ours"), "theirs").alias("slots"),
    )
    hits = stage(_runs(found), "matched-windows")
    run = ["id", "print", "item", "own", "run"]
    covered = hits.groupBy(*run, "windows").agg(F.countDistinct("place").alias("matched"))
    slots = (
        hits.select(*run, F.explode("slots").alias("s"))
        .where(F.col("s.kind").isNotNull())
        .groupBy(*run, "s.kind", "s.ours", "s.theirs")
        .agg(F.count("*").alias("n"))
        .groupBy(*run, "kind", "ours")
        .agg(F.max("n").alias("most"), F.sum("n").alias("n"))
        .groupBy(*run)
        .agg(F.sum("n").alias("slots"), F.sum("most").alias("consistent"))
    )
    none = F.lit(0).cast("bigint")
    judged = covered.join(slots, run, "left").withColumns({"slots": F.coalesce("slots", none), "consistent": F.coalesce("consistent", none)})
    long_enough = (F.col("matched") >= COVERAGE * F.col("windows")) | (F.col("matched") >= PASSAGE)
    held = judged.where(long_enough & (F.col("consistent") >= CONSISTENT * F.col("slots")))
    best = held.groupBy("id", "item", "windows").agg(F.max(F.struct("matched", "consistent", "slots")).alias("best"))
    return best.select(
        F.col("id").alias(key), F.col("item").alias(item_key), "best.matched", "windows", "best.slots", "best.consistent"
    )


def without_passages(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the documents that hold an item; rows without a key stay."""
    gone = free_name(docs, "gone")
    held = passages(docs, items, key, text).select(F.col(key).alias(gone)).distinct()
    return docs.join(held, F.col(key) == F.col(gone), "left_anti")
