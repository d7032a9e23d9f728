"""Conversation repair, line dedup and hard negatives against brute force, and on odd input."""

import collections
import hashlib
import random

import numpy as np
import pytest

from lotwise.llm import conversation_repair, hard_negatives, line_dedup

# --- conversation repair ------------------------------------------------------

FOLLOW = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def slow_repair(rows):
    """From the cost of what remains, the least letter at each step. rows: role, text, gone, cut."""
    write, far = "uuau", 10**9
    left = [[far] * 4 for _ in rows] + [[0, 6, 3, 0]]

    def edits(i, s):
        out = [("I", 3, i, FOLLOW[s, write[s]], write[s])]
        if i < len(rows):
            role, _, gone, cut = rows[i]
            out.append(("D", 4, i + 1, s, None))
            if not gone:
                out.append(("R", 3 + 3 * cut, i + 1, FOLLOW[s, write[s]], write[s]))
                if (s, role[:1]) in FOLLOW:
                    out.append(("K", 3 * cut, i + 1, FOLLOW[s, role[:1]], role))
        return out

    for i in range(len(rows) - 1, -1, -1):
        for _ in range(4):
            left[i] = [min(left[i][s], *(c + left[j][t] for _, c, j, t, _ in edits(i, s))) for s in range(4)]
    i = s = 0
    audit, out = "", []
    while i < len(rows) or left[i][s]:
        letter, _, j, t, role = min(e for e in edits(i, s) if e[1] + left[e[2]][e[3]] == left[i][s])
        if letter != "D":
            out.append(f"{dict(u='user', a='assistant').get(role, role)}:{'' if letter == 'I' else rows[i][1]}")
        audit, i, s = audit + letter, j, t
    return left[0][0], audit, hashlib.sha256("\n".join(out).encode()).hexdigest(), out


def random_rows(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", ""]
    return [(rng.choice(roles), f"t{i}", rng.random() < 0.2, rng.random() < 0.3) for i in range(n)]


@pytest.mark.parametrize("base", [conversation_repair.BASE, 0])  # with 0 all prefixes that end alike collide
def test_cheapest_edits_and_least_audit(monkeypatch, base):
    monkeypatch.setattr(conversation_repair, "BASE", base)
    rng = random.Random(3)
    for _ in range(800):
        rows = random_rows(rng, rng.choice([0, 1, 2, 3, 5, 9, 30]))
        repair = conversation_repair.Repair(settle=rng.choice([1, 4, 1024]))
        for row in rows:
            repair.row(*row)
        assert repair.result() == slow_repair(rows)[:3]


def test_long_conversations_keep_few_nodes():
    rng = random.Random(5)
    repair = conversation_repair.Repair(settle=64)
    rows = random_rows(rng, 5000)
    for row in rows:
        repair.row(*row)
        assert max(node.depth for _, node, _ in repair.states.values()) < 256
    assert len(repair.done) > 4500
    assert repair.result()[:2] == slow_repair(rows)[:2]


def test_nodes_find_their_ancestors():
    node, chain = conversation_repair.Node(None, 0), []
    for i in range(70):
        node = conversation_repair.Node(node, 65 + i % 7)
        chain.append(node)
    assert all(node.at_depth(d) is chain[d - 1] for d in range(1, 71))
    assert node.letters(60) == bytes(65 + i % 7 for i in range(60, 70))
    one, two = conversation_repair.Node(chain[9], 66), conversation_repair.Node(chain[9], 67)
    assert conversation_repair.before(one, two) and not conversation_repair.before(two, one)
    assert conversation_repair.before(chain[3], chain[5])


def slow_report(rows):
    """rows: (turn, role, text) of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, counts, judged = set(), collections.Counter(), []
    for turn, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        counts[fault] += 1
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, digest, out = slow_repair(judged)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest), out


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, mark string, audit int, conv string"


@pytest.fixture(scope="module")
def conversations(spark):
    rng = random.Random(11)
    rows = []
    for conv in [None, *range(1, 40)]:
        for _ in range(rng.choice([1, 2, 5, 12])):
            turn = rng.choice([None, *range(8)])
            text = rng.choice([None, "", " \n", "Yes.", "No", "Why? ", "ü! ", "x" * 50000 + "."])
            rows.append((conv, turn, rng.choice([None, "", "user", "assistant", "system", "tool"]), text))
    rows += [(100, t, "user" if t % 2 else "assistant", f"same {t % 3}.") for t in range(3000)]  # one holds most rows
    rows += [rows[0]] * 5
    return rows, spark.createDataFrame([(*r, "m", 1, "c") for r in rows], CONVERSATIONS)


def test_repair_is_what_brute_force_gives(spark, conversations):
    rows, table = conversations
    own = collections.defaultdict(list)
    for conv, *row in rows:
        own[conv].append(tuple(row))
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.repair(table).collect()}
    assert got == {conv: slow_report(r)[0] for conv, r in own.items()}
    repaired = collections.defaultdict(list)
    for r in conversation_repair.repaired_rows(table).orderBy("conv_id", "at").collect():
        repaired[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert repaired == {conv: out for conv, r in own.items() if (out := slow_report(r)[1])}
    none = table.where("false")
    assert conversation_repair.repair(none).count() == conversation_repair.repaired_rows(none).count() == 0


# --- line dedup ---------------------------------------------------------------


def slow_lines(rows):
    """rows: id, text. Per row: n_lines, n_dropped, kept."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(low)
    holders = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 20:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = [ln for ln in lines if doc is None or len(held := holders.get(key(ln), ())) < 3 or doc == max(held)]
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


LINES = "doc_id bigint, text string, n int, keep_runs string, _doc int, _body string, N_LINES string, h1 int, at int, line int"


@pytest.fixture(scope="module")
def lined():
    rng = random.Random(2)
    common = [f"This is a common line number {i}" for i in range(6)] + ["Ünïcode line of twenty", "short line", "", "   "]
    rows = []
    for doc in range(60):
        lines = [rng.choice([rng.choice(common), f"  {rng.choice(common).upper()}\t\r", f"own line of this document {doc} {rng.random()}"])
                 for _ in range(rng.choice([1, 3, 20]))]
        rows.append((doc, "\n".join(lines) + rng.choice(["", "\n"])))
    rows += [(70, None), (71, ""), (72, common[0]), (73, common[0] + "\n" + common[0]), (None, common[0]), (None, None)]
    rows += [(74, "a\n" * 40000 + common[1]), (5, "another text of this id\n" + common[0]), rows[3], rows[3]]
    rows += [(200 + i, f"{common[2]}\nalone {i}") for i in range(300)]  # a line that most documents hold
    return rows


def test_lines_are_what_brute_force_keeps(spark, lined):
    table = spark.createDataFrame([(*r, 1, "x", 2, "y", "z", 3, 4, 5) for r in lined], LINES)
    got = line_dedup.with_kept_lines(table)
    mine = sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr)
    assert mine == sorted(slow_lines(lined), key=repr)
    assert {"n", "_doc", "_body", "h1", "at", "line"} < set(got.columns) and got.columns.count("keep_runs") == 1
    text_ids = table.withColumn("doc_id", line_dedup.F.format_string("%05d", "doc_id")).where("doc_id is not null")
    assert line_dedup.with_kept_lines(text_ids).agg({"n_dropped": "sum"}).first()[0] > 0
    assert line_dedup.with_kept_lines(table.where("false")).count() == 0


def test_bitmaps_are_runs_of_kept_and_dropped_lines(spark):
    places = [[0], [0, 1, 2], [3], [1, 2, 5, 6, 7, 9], list(range(0, 40, 2))]
    table = spark.createDataFrame([(p, [str(i) for i in range(40)]) for p in places], "p array<int>, lines array<string>")
    runs = table.select("p", "lines", line_dedup.keep_runs(line_dedup.F.col("p")).alias("runs"))
    rows = runs.select("*", line_dedup.kept_lines(line_dedup.F.col("lines"), line_dedup.F.col("runs")).alias("kept")).collect()
    assert rows[0]["runs"] == [0, 1] and rows[3]["runs"] == [1, 2, 2, 3, 1, 1]
    for r in rows:
        assert r["kept"] == [str(i) for i in range(40) if i not in r["p"]]


def test_a_common_line_is_limited_before_it_is_shuffled(spark, lined):
    table = spark.createDataFrame(lined, "doc_id bigint, text string")
    plan = line_dedup.repeated_keys(line_dedup.line_hashes(table))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(h1") < plan.index("Partial") < plan.index("Exchange rangepartitioning")
    assert plan.count("Exchange") == 2 and "Python" not in plan


# --- hard negatives -----------------------------------------------------------


def slow_negatives(rows, asked):
    own = {(i, label, tuple(int(np.floor(256.0 * x)) for x in v)) for i, label, v in rows
           if None not in (i, label, v) and all(x is not None and np.isfinite(x) for x in v)}
    own = {r for r in own if sum(x * x for x in r[2]) < 2**62}
    out = []
    for anchor, label, v in own:
        if not asked(anchor):
            continue
        scored = sorted({(-sum(a * b for a, b in zip(v, w)), i, lab == label) for i, lab, w in own if i != anchor})
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            held = [s for s in scored if not s[2] and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(held, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    unit = lambda: (lambda v: (v / np.linalg.norm(v)).astype(np.float32).tolist())(rng.normal(size=24) + 0.4)
    rows = [(i, int(rng.integers(3)), unit()) for i in range(600)]
    rows += [(1000 + i, int(rng.integers(3)), rows[0][2]) for i in range(300)]  # one vector a third of all rows share
    rows += [(2000, None, rows[0][2]), (2010, 1, None), (2020, 1, [None, 1.0]), (2030, 1, [float("nan")]), (2040, 1, [float("inf")]),
             (2050, 1, []), (2060, 2, [0.5, 0.25]), (2070, 1, unit() + [9.0]), (None, 1, unit()), (2080, 1, [3e7] * 24),
             (2090, 1, [3e4] * 24), (2100, 2, [-0.5] * 24), rows[10], rows[10], (20, 2, unit())]
    return rows


def test_negatives_are_what_brute_force_gives(spark, monkeypatch, vectors):
    schema = "vec_id bigint, label int, embedding array<float>, id string, vector int, anchor int, place int"
    table = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in vectors], schema)
    want = slow_negatives(vectors, lambda i: i % 10 == 0)
    asked = hard_negatives.F.col("vec_id") % 10 == 0
    got = sorted(tuple(r) for r in hard_negatives.mine(table, asked).collect())
    assert got == want and len(want) > 200
    monkeypatch.setattr(hard_negatives, "ANCHORS", 40)  # several blocks of anchors
    assert sorted(tuple(r) for r in hard_negatives.mine(table, asked).collect()) == want
    assert hard_negatives.mine(table.where("false"), asked).count() == 0
    assert hard_negatives.mine(table, hard_negatives.F.lit(False)).count() == 0


def test_scan_drops_no_row_of_its_window():
    rng = np.random.default_rng(4)
    for scale in (1, 300, 10**7):
        rows = np.floor(rng.normal(size=(700, 40)) * 60) * scale
        anchor = np.floor(rng.normal(size=40) * 60) * scale
        length = float(np.linalg.norm(anchor))
        block = hard_negatives.Columns(np.arange(700), np.zeros(700), rows, length, 40)
        exact = np.array([sum(int(a) * int(b) for a, b in zip(anchor, r)) for r in rows])
        for low, high in ((-np.inf, np.inf), *[tuple(sorted(rng.choice(exact, 2).tolist())) for _ in range(20)]):
            places, scores = block.scan(anchor, 0, 700, low, high)
            held = np.flatnonzero((exact >= low) & (exact <= high))
            assert places.tolist() == held.tolist() and scores.tolist() == exact[held].tolist()
