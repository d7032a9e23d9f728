"""Secrets in texts: patterns, and a battery of randomness tests on what else looks like a key.

Patterns give base spans. Further candidates are unbroken runs of key
characters, slashes among them, of at least 20, with the `=` that pad them. A
run with slashes that fails as a whole, as paths do, or touches a base span is
cut at them, and its parts of at least 20 are candidates. Each is read in the narrowest encoding that
its characters allow, and three statistics ask whether it could be uniform
noise of that encoding: chi-squared over equal bins of the alphabet, the number
of runs above and below its middle, and the serial correlation of neighbours.
Each becomes a normal deviate, and their sum a p-value under the hypothesis of noise.

Noise has p-values spread evenly, words and identifiers have them near 0. So
the number of noise candidates of an encoding and length class is about the
number with p above one half, doubled (`STEPS` classes of p over all documents), and a p-value threshold
lets through a known number of them; the lowest threshold is taken at which the
others are at most `FALSE` of what passes. Short candidates, whose tests are
weak, thereby need a higher p-value than long ones. Whole runs have thresholds of
their own; those of parts come from the runs and the parts of failed runs together.

DataFrame functions only. Scale: one pass over the texts writes the spans per
document; the classes of p, length and encoding are a table of fixed size.

Defined cases. A null text is empty and has no span. Spans count code points,
the end is exclusive. All rows stay, repeated ones too and those without an id;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import whole_text
from lotwise.operators.staging import stage

#: Keyword, separator and value; the keyword's letters in either case.
ASSIGN = (
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run that starts with the mark, all of it
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
#: What a run with slashes is cut into.
PART = r"(?<![A-Za-z0-9+_-])[A-Za-z0-9+_-]{20,}(?:={1,2}$)?"
STEPS = 20
FALSE = 0.1
#: Characters in the order of their code; bins and middles follow from it.
ENCODINGS = {
    "hex": ("0123456789abcdef", r"^[0-9a-f]+$"),
    "HEX": ("0123456789ABCDEF", r"^[0-9A-F]+$"),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r"^[A-Z2-7]+$"),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", r"^[0-9a-z]+$"),
    "BASE36": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"^[0-9A-Z]+$"),
    "base62": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", r"^[0-9A-Za-z]+$"),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_", r"."),
}
BINS = 4
SPAN = "array<struct<start: int, kind: int, end: int, found: string>>"


def spans(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches: start, kind, end, found.

    The text between matches comes from a split, so starts are sums of lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    first = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("out"))
    walked = F.aggregate(
        F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, f: F.struct(F.length(g).alias("gap"), f.alias("found"))),
        first,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["found"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + x["gap"]).alias("start"),
                        F.lit(kind).alias("kind"),
                        (acc["at"] + x["gap"] + F.length(x["found"])).alias("end"),
                        x["found"].alias("found"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    none = F.expr(f"cast(array() as {SPAN})")
    return F.when(text.rlike(pattern), walked).otherwise(none)


KINDS = ("assign", "access", "hex", "random")


def base_spans(text: Column) -> Column:
    assign = F.filter(
        spans(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= ASSIGN_VALUE
    )
    return F.concat(assign, spans(text, ACCESS, 1), spans(text, HEX, 2))


def _encoding(token: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, (_, pattern) in reversed(ENCODINGS.items()):
        out = F.when(token.rlike(pattern), name).otherwise(out)
    return out


def _codes(token: Column, encoding: Column) -> Column:
    """Positions of the characters in their alphabet, from 0."""
    alphabet = F.element_at(
        F.create_map(*[F.lit(x) for name, (a, _) in ENCODINGS.items() for x in (name, a)]), encoding
    )
    return F.transform(F.split(token, ""), lambda c: F.instr(alphabet, c) - 1)


def _mean_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda t, x: t + x)


def randomness(codes: Column, size: Column) -> Column:
    """p-value of the hypothesis that the codes are independent and even on 0 .. size - 1."""
    n = F.size(codes).cast("double")

    def in_bin(b: int) -> Column:
        return F.size(F.filter(codes, lambda c: F.floor(c * BINS / size) == b)).cast("double")

    bins = [in_bin(b) for b in range(BINS)]
    # how many codes of the alphabet a bin holds
    held = [F.ceil((b + 1) * size / BINS) - F.ceil(b * size / BINS) for b in range(BINS)]
    chi = sum(((o - n * h / size) * (o - n * h / size) / (n * h / size) for o, h in zip(bins, held)), F.lit(0.0))
    # Wilson and Hilferty: the cube root is near normal
    third = 2.0 / (9 * (BINS - 1))
    uniform = (F.pow(chi / (BINS - 1), F.lit(1 / 3)) - (1 - third)) / third**0.5
    high = F.transform(codes, lambda c: (2 * c >= size).cast("double"))
    changes = _mean_sum(F.zip_with(F.slice(high, 1, F.size(high) - 1), F.slice(high, 2, F.size(high) - 1), lambda a, b: F.abs(a - b)))
    runs = F.abs(changes - (n - 1) / 2) / (F.sqrt(n - 1) / 2)
    middle = F.transform(codes, lambda c: (c - (size - 1) / 2).cast("double"))
    squares = _mean_sum(F.transform(middle, lambda c: c * c))
    products = _mean_sum(F.zip_with(F.slice(middle, 1, F.size(middle) - 1), F.slice(middle, 2, F.size(middle) - 1), lambda a, b: a * b))
    serial = F.abs(products / F.greatest(squares, F.lit(1e-9))) * F.sqrt(n)
    # two-sided deviates of mean sqrt(2/pi) and variance 1 - 2/pi; their sum with the first is near normal
    mean, variance = 0.7978845608, 0.3633802276
    z = (uniform + (runs - mean) + (serial - mean)) / (1 + 2 * variance) ** 0.5
    return 1 / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(500.0))))


def _overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def _coded(found: Column, at: Column, base: Column) -> Column:
    """Of spans found from `at` on, those with a digit and a letter that touch no base span: start, end, encoding, found without `=`."""
    placed = F.transform(
        found,
        lambda s: F.struct(
            (at + s["start"]).alias("start"), (at + s["end"]).alias("end"), F.rtrim(s["found"], F.lit("=")).alias("found")
        ),
    )
    right = F.filter(
        placed, lambda s: s["found"].rlike("[0-9]") & s["found"].rlike("[A-Za-z]") & ~_overlaps(s, base)
    )
    return F.transform(
        right,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), _encoding(s["found"]).alias("encoding"), s["found"].alias("found")
        ),
    )


def _tested(coded: Column) -> Column:
    sizes = F.create_map(*[x for name, (a, _) in ENCODINGS.items() for x in (F.lit(name), F.lit(len(a)))])
    return F.transform(
        coded,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["encoding"].alias("encoding"),
            F.least(F.floor(F.log2(F.length(s["found"]).cast("double")) * 2), F.lit(24)).cast("int").alias("length_class"),
            F.least(
                F.floor(randomness(_codes(s["found"], s["encoding"]), F.element_at(sizes, s["encoding"]).cast("double")) * STEPS),
                F.lit(STEPS - 1),
            ).cast("int").alias("step"),
        ),
    )


def candidates(text: Column, base: Column) -> Column:
    """Per run of key characters: whole, the run as a candidate, or empty; parts, of runs with slashes."""
    coded = F.transform(
        spans(text, CANDIDATE, 3),
        lambda r: F.struct(
            _coded(F.array(r), F.lit(0), base).alias("whole"),
            _coded(
                F.when(r["found"].contains("/"), spans(r["found"], PART, 3)).otherwise(F.expr(f"cast(array() as {SPAN})")),
                r["start"],
                base,
            ).alias("parts"),
        ),
    )
    some = F.filter(coded, lambda r: F.size(F.concat(r["whole"], r["parts"])) > 0)
    return F.transform(some, lambda r: F.struct(_tested(r["whole"]).alias("whole"), _tested(r["parts"]).alias("parts")))


def thresholds(found: DataFrame) -> dict[tuple[str, int], int]:
    """found: encoding, length_class, step. The lowest step that passes, for classes where one does.

    At most encodings x length classes x STEPS rows reach the driver.
    """
    counts: dict[tuple[str, int], list[int]] = {}
    for r in found.groupBy("encoding", "length_class", "step").agg(F.count("*").alias("n")).collect():
        counts.setdefault((r["encoding"], r["length_class"]), [0] * STEPS)[r["step"]] = r["n"]
    out = {}
    for of, n in counts.items():
        noise = 2 * sum(n[STEPS // 2 :])  # of even p-values half are above one half
        for step in range(STEPS):
            passed, expected = sum(n[step:]), noise * (STEPS - step) / STEPS
            if passed and passed - min(passed, expected) <= FALSE * passed:
                out[of] = step
                break
    return out


def _joined(parts: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.sort_array(parts), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, base and added spans (start, kind, end), and both joined as text."""
    bare = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    texts = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    based = texts.withColumn("base", base_spans(F.col("text")))
    scanned = stage(
        based.select("key", bare.alias("base"), candidates(F.col("text"), F.col("base")).alias("more")),
        "secret-spans",
    )

    def passes(m: Column, least: dict[tuple[str, int], int]) -> Column:
        out = F.lit(False)
        for (encoding, length_class), step in sorted(least.items()):
            out = out | ((m["encoding"] == encoding) & (m["length_class"] == length_class) & (m["step"] >= step))
        return out

    runs = scanned.select(F.explode("more").alias("run"))
    whole = runs.select(F.explode("run.whole").alias("whole")).select("whole.*")
    least = thresholds(whole)
    failed = runs.where(~F.exists("run.whole", lambda m: passes(m, least)))
    least_parts = thresholds(whole.union(failed.select(F.explode("run.parts").alias("part")).select("part.*")))

    passed = F.flatten(
        F.transform(
            "more",
            lambda r: F.when(F.exists(r["whole"], lambda m: passes(m, least)), r["whole"]).otherwise(
                F.filter(r["parts"], lambda p: passes(p, least_parts))
            ),
        )
    )
    added = F.transform(
        passed, lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end"))
    )
    out = scanned.select("key", "base", added.alias("added"))
    return out.select(
        F.col("key").alias(key),
        "base",
        "added",
        _joined(F.col("base")).alias("base_text"),
        _joined(F.concat("base", "added")).alias("spans"),
    )
