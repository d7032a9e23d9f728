"""The randomness battery and its spans, computed a second time in plain Python."""

import base64
import collections
import math
import random
import re

import pytest

from lotwise.llm import secrets


def p_value(codes, size):
    n, bins = len(codes), secrets.BINS
    chi = 0.0
    for b in range(bins):
        held = sum(1 for c in range(size) if c * bins // size == b)
        expected = n * held / size
        chi += (sum(c * bins // size == b for c in codes) - expected) ** 2 / expected
    spread = 2 / (9 * (bins - 1))
    uniform = ((chi / (bins - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)
    high = [2 * c >= size for c in codes]
    changes = sum(a != b for a, b in zip(high, high[1:]))
    runs = abs(changes - (n - 1) / 2) / (math.sqrt(n - 1) / 2)
    around = [c - (size - 1) / 2 for c in codes]
    serial = abs(sum(a * b for a, b in zip(around, around[1:])) / max(sum(a * a for a in around), 1e-9)) * math.sqrt(n)
    mean, variance = math.sqrt(2 / math.pi), 1 - 2 / math.pi
    z = (uniform + runs - mean + serial - mean) / math.sqrt(1 + 2 * variance)
    return 1 / (1 + math.exp(min(1.5976 * z + 0.07056 * z**3, 500)))


def judged(start, found, base):
    """start, end, class of a candidate; None if it is none."""
    end, bare = start + len(found), found.rstrip("=")
    if not (re.search("[0-9]", bare) and re.search("[A-Za-z]", bare)) or any(s < end and start < e for s, e in base):
        return None
    name, alphabet = next((k, a) for k, (a, pattern) in secrets.ENCODINGS.items() if re.search(pattern, bare))
    p = p_value([alphabet.index(c) for c in bare], len(alphabet))
    return start, end, (name, min(int(math.log2(len(bare)) * 2), 24)), min(int(p * secrets.STEPS), secrets.STEPS - 1)


def least_steps(found):
    counts = collections.defaultdict(collections.Counter)
    for _, _, of, step in found:
        counts[of][step] += 1
    out = {}
    for of, n in counts.items():
        noise = 2 * sum(n[s] for s in range(secrets.STEPS // 2, secrets.STEPS))
        for step in range(secrets.STEPS):
            passed = sum(n[s] for s in range(step, secrets.STEPS))
            wrong = passed - min(passed, noise * (secrets.STEPS - step) / secrets.STEPS)
            if passed and wrong <= secrets.FALSE * passed:
                out[of] = step
                break
    return out


def brute(texts):
    runs = []  # text, whole, parts
    for i, text in enumerate(texts):
        text = text or ""
        base = [m.span() for m in re.finditer(secrets.ASSIGN, text) if len(m[2]) >= secrets.ASSIGN_VALUE]
        base += [m.span() for pattern in (secrets.ACCESS, secrets.HEX) for m in re.finditer(pattern, text)]
        for run in re.finditer(secrets.CANDIDATE, text):
            pieces = re.finditer(secrets.PART, run[0]) if "/" in run[0] else ()
            parts = [judged(run.start() + m.start(), m[0], base) for m in pieces]
            runs.append((i, judged(run.start(), run[0], base), [p for p in parts if p]))
    least = least_steps(w for _, w, _ in runs if w)

    def passes(found, steps):
        return found is not None and found[2] in steps and found[3] >= steps[found[2]]

    failed = [p for _, w, parts in runs if not passes(w, least) for p in parts]
    least_parts = least_steps([w for _, w, _ in runs if w] + failed)
    out = collections.defaultdict(set)
    for i, whole, parts in runs:
        kept = [whole] if passes(whole, least) else [p for p in parts if passes(p, least_parts)]
        out[i] |= {(s, e) for s, e, _, _ in kept}
    return out


def test_battery_equals_a_second_computation(spark):
    r = random.Random(11)
    cases = [([r.randrange(size) for _ in range(n)], size) for size in (16, 32, 36, 62, 65) for n in (20, 33, 64, 400)]
    cases += [([0] * 30, 16), (list(range(62)), 62), ([1, 61] * 20, 62)]
    df = spark.createDataFrame([(i, c, float(s)) for i, (c, s) in enumerate(cases)], "i int, codes array<int>, size double")
    got = dict(df.select("i", secrets.randomness(df["codes"], df["size"])).collect())
    for i, (codes, size) in enumerate(cases):
        assert got[i] == pytest.approx(p_value(codes, size), rel=1e-6, abs=1e-9)


def test_spans_equal_a_second_computation(spark):
    r = random.Random(5)
    letters = secrets.ENCODINGS["base62"][0]
    words = ["alpha", "Beta", "gamma2", "delta", "error", "handler", "v1", "config", "2024", "module"]

    def piece():
        kind = r.randrange(8)
        if kind == 0:
            return "".join(r.choice(letters) for _ in range(r.choice([20, 24, 32, 40])))
        if kind == 1:
            return base64.b64encode(r.randbytes(r.choice([16, 25, 32]))).decode()
        if kind == 2:
            return "_".join(r.choice(words) for _ in range(6))
        if kind == 3:
            return "/" + "/".join(r.choice(words) for _ in range(5)) + "/" + "".join(r.choice(letters) for _ in range(32))
        if kind == 4:
            return "token: " + "".join(r.choice(letters) for _ in range(r.choice([4, 12])))
        if kind == 5:
            return "".join(r.choice("0123456789abcdef") for _ in range(r.choice([23, 32])))
        return r.choice([*words, "é😀", "AKIA" + "A1" * 9])

    texts = [None, "", *(" ".join(piece() for _ in range(r.randrange(1, 30))) for _ in range(300))]
    texts += texts[-5:]  # repeated rows
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = brute(texts)
    rows = secrets.find_secrets(docs).select("doc_id", "added").collect()
    assert len(rows) == len(texts) and sum(map(len, want.values())) > 300
    for row in rows:
        assert {(s["start"], s["end"]) for s in row["added"]} == want[row["doc_id"]], texts[row["doc_id"]]
