"""Benchmark passages against brute force, and the cases a whole-document rule misses."""

import collections
import itertools
import random

import pytest
import regex

from lotwise.llm import decontaminate as d

TOKEN = regex.compile(r"[\p{L}\p{N}]+(?:[.,][0-9]+)*[.!?]?")


def slow_tokens(text):
    raw = TOKEN.findall(text or "")
    low = [t.rstrip(".!?").lower() for t in raw]
    inner = []
    for i, t in enumerate(raw):
        before = raw[i - 1] if i else ""
        if t[0] in "0123456789":
            inner.append(("num",))
        elif before and not t.startswith(low[i]) and before[-1] not in ".!?":
            inner.append(("name",))
        elif before[:1] and before[0] in "0123456789" and low[i] in d.UNITS:
            inner.append(("unit",))
        else:
            inner.append(low[i])
    return low, inner


def slow_windows(text, n, literal):
    low, inner = slow_tokens(text)
    for p in range(len(low) - n + 1):
        first = ("num",) if inner[p] == ("num",) else low[p]
        yield p, tuple(low[p : p + n]) if literal else (first, *inner[p + 1 : p + n]), low[p : p + n]


def slow_passages(docs, items):
    """The best run of each document and item, by loops over offsets."""
    known = []
    for item, text in {(i, t or "") for i, t in items if i is not None}:
        n = min(len(slow_tokens(text)[0]), d.WINDOW)
        if not n:
            continue
        own = [w for w in slow_windows(text, n, False) if 2 * sum(isinstance(t, str) for t in w[1]) >= n]
        known.append((item, n, not own, own or list(slow_windows(text, n, True))))
    best = {}
    for doc, text in {(i, t or "") for i, t in docs if i is not None}:
        for item, n, literal, own in known:
            at = collections.defaultdict(list)
            for p, key, codes in slow_windows(text, n, literal):
                at[key].append((p, codes))
            met = sorted((p - q, q, key, ours, theirs) for q, key, ours in own for p, theirs in at[key])
            runs = [[]]
            for a, b in itertools.zip_longest(met, met[1:]):
                if a:
                    runs[-1].append(a)
                if b and b[0] - a[0] > d.SLACK:
                    runs.append([])
            for run in runs:
                slots = collections.Counter()
                for _, _, key, ours, theirs in run:
                    slots.update((k, x, y) for k, x, y in zip(key, ours, theirs) if not literal and not isinstance(k, str))
                most = collections.defaultdict(int)
                for (k, x, _), c in slots.items():
                    most[k, x] = max(most[k, x], c)
                matched = len({q for _, q, *_ in run})
                judged = (matched, sum(most.values()), sum(slots.values()))
                enough = matched >= d.COVERAGE * len(own) or matched >= d.PASSAGE
                if run and enough and judged[1] >= d.CONSISTENT * judged[2]:
                    best[doc, item, len(own)] = max(best.get((doc, item, len(own)), judged), judged)
    return {(doc, item, m, n, slots, same) for (doc, item, n), (m, same, slots) in best.items()}


def found(spark, docs, items):
    schema = "doc_id bigint, text string, gone int, _gone int, hash int, plain string, item_id string, at int"
    rows = spark.createDataFrame([(i, t, 1, 2, 3, "x", "y", 4) for i, t in docs], schema)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in d.passages(rows, asked).collect()}
    left = d.without_passages(rows, asked)
    assert left.columns == rows.columns
    held = {r[0] for r in got}
    assert sorted(left.select("doc_id").toPandas()["doc_id"].dropna()) == sorted(i for i, _ in docs if i is not None and i not in held)
    return got


ITEM = "Alice bought 12 apples and 30 pears for 5 dollars from the market in Dublin on a cold day last year."
LONG = " ".join(f"word{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(120))


def test_each_occurrence_is_judged_by_itself(spark):
    variant = ITEM.replace("Alice", "Bob").replace("12", "44").replace("30", "9").replace("Dublin", "New York")
    odd = "Alice paid 12 pounds of 12 pence to 12 men at 12 gates near 12 towns with 12 carts in 12 days."
    docs = [
        (0, ITEM), (1, f"Before it. {variant} After it."), (2, f"{ITEM} And then: {variant}"), (3, f"{variant} {variant.replace('9', '8')}"),
        (4, "Ask: what is the capital of France? Nobody knew."), (5, "We had What is 12 + 30 * 4? on the sheet."),
        (6, " ".join(["so it goes on"] * 50 + LONG.split()[40:70] + ["and on and on"] * 50)), (7, " ".join(LONG.split()[:20]) + " end"),
        (8, odd.replace("12", "{}").format(*range(20, 27))), (9, odd.replace("12", "77")), (10, None), (11, ""), (None, ITEM),
        (12, "clean text about apples and pears"), (13, "Here it is. One two three four five six seven eight. Done."),
    ]
    items = [(1, ITEM), (2, "What is the capital of France?"), (3, "What is 12 + 30 * 4?"), (4, LONG), (5, odd), (6, None), (7, "..."),
             (8, "one two three four five six seven eight"), (None, "clean text about apples and pears")]
    got = found(spark, docs, items)
    assert {r[:2] for r in got} == {(0, 1), (1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (6, 4), (9, 5), (13, 8)}
    assert got == slow_passages(docs, items)


@pytest.mark.parametrize("hashes", [d.HASHES, 20])
def test_passages_are_what_brute_force_finds(spark, monkeypatch, hashes):
    monkeypatch.setattr(d, "HASHES", hashes)
    monkeypatch.setattr(d, "PIECE", 16)
    rng = random.Random(5)
    words = "the a of cost Anna Bert 12 7 kg km. and is Paris in 3.5 was! ok".split()
    items = [(i % 25, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 4, 8, 9, 20, 60])))) for i in range(30)]
    docs = []
    for i in range(40):
        parts = [rng.choice(words) for _ in range(rng.choice([0, 5, 40]))]
        for _ in range(rng.choice([0, 1, 3])):
            copy = rng.choice(items)[1].split()
            copy = [rng.choice(words) if rng.random() < 0.1 else w for w in copy]
            parts[len(parts) // 2 : len(parts) // 2] = copy
        docs.append((i % 36, " ".join(parts)))
    docs.append(docs[0])
    got, want = found(spark, docs, items), slow_passages(docs, items)
    assert got == want and len(want) > 40
    none = spark.createDataFrame([], "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert d.passages(none, asked).count() == d.passages(none, none.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_texts_are_read_once_and_not_shuffled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS id", "text")
    asked = d.item_windows(spark.createDataFrame([(1, ITEM)], "id bigint, text string"))
    windows = d.window_hashes(docs, [(8, False)])
    joined = windows.join(d.F.broadcast(asked.select("hash").distinct()), "hash")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("documents.parquet") == 1 and "SortMergeJoin" not in plan and "Python" not in plan
