"""The text operators against brute force, and on nulls, repeats, empty and clashing input."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
import oracle
from lotwise.llm import (
    class_lm, components, decontaminate, exact_dedup, language_id, near_dedup, quality, secrets, sentencepiece,
    substring_dedup, url_filter,
)
from lotwise.llm.queries import QUERIES, RULES, piece_model
from lotwise.llm.sql import SQL

WORDS = "of the and to in it was that on are with as for be is at by this have from tion ing er".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n int, doc string, word string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "ed", "ly", "s."]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    passage = prose(rng, 90)
    return {
        1: base, 2: base, 3: " ".join(near), 4: None, 5: "", 6: " \n\t ", 7: "word", 8: "word", 9: "Two words",
        10: prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 30), 11: prose(rng, 25) + " " + passage,
        12: "aé▁b  c " * 3, 13: prose(rng, 20000), 14: "a" * 3000, 15: "1234 5678 ???", 16: "TWO words", 17: prose(rng, 60),
    }


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", 0, 1, "x", "y") for i, t in texts.items()]
    return spark.createDataFrame(rows + [rows[0], (None, "no id", None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_gives_what_its_sql_gives(spark, sf_dir, name):
    with oracle.connect(sf_dir) as con:
        assert oracle.differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_url_rules_and_templates(spark):
    urls = ["https://A.Example.org/es/1?x", "http://example.org/en/15", "http://x.com/de/9", "http://x.com/fr/9#a/b",
            "http://org", "nothing", None, "http://net/a/b/c/d/e/f", "http://x.com/en/7"] + ["http://x.com/de/9"] * 30
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id bigint, url string, host int")
    got = {r["page_id"]: r for r in url_filter.judge(pages, RULES).collect()}
    assert len(got) == len(urls)
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(7)] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/15", "example.org/en/1", "block"),
        ("x.com", "/de/9", "com/de/", "block"), ("x.com", "/fr/9", "com/fr/", "allow"),
        ("org", "", None, got[4]["verdict"]), ("", "", None, got[5]["verdict"]), ("", "", None, got[6]["verdict"]),
    ]
    assert got[7]["template"].endswith("/**") and got[8]["rule"] is None
    assert url_filter.judge(pages.where("page_id < 0"), RULES).count() == 0


def test_pieces_are_the_librarys(docs, texts, empty):
    lib = sentencepiece.processor(piece_model())
    got = sentencepiece.with_pieces(docs, piece_model()).select("doc_id", "pieces.*").collect()
    assert len(got) == len(texts) + 2
    for r in got:
        ids = lib.encode(texts.get(r["doc_id"], "no id") or "", add_bos=True, add_eos=True)
        assert sentencepiece.id_list(r["ids"]) == ids and r["n_tokens"] == len(ids) and r["decoded"] == lib.decode(ids)
    assert sentencepiece.with_pieces(empty, piece_model()).count() == 0


def test_pieces_of_odd_texts():
    rng, lib = random.Random(1), sentencepiece.processor(piece_model())
    parts = ["a", "the", "é", " ", "   ", "▁", "\n", "中", "🙂", "<s>", "\x00", " " * 20, "x" * 30, "<0x0A>"]
    table = sentencepiece.ChunkTable(piece_model(), size=50, room=200)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(2000)]
    for text, (ids, decoded) in zip(texts, table.encode(texts), strict=True):
        want = lib.encode(text, add_bos=True, add_eos=True)
        assert sentencepiece.id_list(ids) == want and decoded == lib.decode(want)


def slow_bits(counts, lang, data):
    """Code length by the definition, byte after byte."""
    n = {(l, w): c for l, length, w, c in counts.itertuples(index=False) for l in [(l, length)]}
    kinds, total = collections.Counter(), collections.Counter()
    for ((l, length), w), c in n.items():
        kinds[l, length, w >> 8] += 1
        total[l, length, w >> 8] += c
    bits = 0.0
    for i in range(len(data)):
        for order in range(min(i, language_id.ORDER), -2, -1):
            if order < 0:
                bits += 8
                break
            w = int.from_bytes(data[i - order : i + 1], "big")
            of = (lang, order + 1, w >> 8)
            if n.get(((lang, order + 1), w)):
                bits -= math.log2(n[(lang, order + 1), w] / (total[of] + kinds[of]))
                break
            if kinds[of]:
                bits -= math.log2(kinds[of] / (total[of] + kinds[of]))
    return bits


def test_code_lengths_and_languages(spark, monkeypatch, sf_dir, docs, empty):
    held = QUERIES["op3_language_id"](spark, sf_dir).where("held_out")
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = held.join(truth, "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)
    some = spark.createDataFrame([("en", "the cat is on the mat"), ("de", "der und die das"), (None, "x")], "lang string, text string")
    counts = language_id.window_counts(language_id.sample(some), ["de", "en"]).toPandas()
    counts["label"] = counts["label"].map(["de", "en"].__getitem__)
    model = language_id.train(some)
    data = [b"", b"the", b"der \xff zzz the mat", b"q", b"the cat is" * 30]
    got = model.text_bits(data)
    for i, d in enumerate(data):
        for j, lang in enumerate(model.langs):
            assert got[i, j] == pytest.approx(slow_bits(counts, lang, d), rel=1e-4, abs=1e-3)
    found = {r["doc_id"]: r["language"] for r in language_id.with_language(docs, model).collect()}
    assert {i for i in found if found[i]["lang"] == "und"} == {4, 5, 6, 15}
    assert all(0 <= f["score"] <= 1 for f in found.values())
    nothing = language_id.train(empty)
    assert {r["language"]["lang"] for r in language_id.with_language(docs, nothing).collect()} == {"und"}
    assert {r[0] for r in docs.join(language_id.keep_explained(docs, nothing), "doc_id", "left_anti").select("doc_id").collect()} == {4, 5, 6, 15, None}
    monkeypatch.setattr(language_id, "BLOCK", 7)
    text = b"one text that is longer than a block " * 3
    batch = language_id.pa.RecordBatch.from_arrays([language_id.pa.array([0]), language_id.pa.array([text])], ["label", "text"])
    blocks = collections.Counter()
    for counted in language_id._count(iter([batch])):
        for row in counted.to_pylist():
            blocks[row["length"], row["window"]] += row["n"]
    windows = [(n, int.from_bytes(text[i : i + n], "big")) for n in range(1, language_id.ORDER + 2) for i in range(len(text) - n + 1)]
    assert blocks == collections.Counter(windows)


def test_every_label_is_learned_from_texts_of_any_length(spark, monkeypatch):
    rng = random.Random(4)
    alphabets = {f"l{i:03}": "".join(chr(0x4E00 + 40 * i + j) for j in range(30)) for i in range(131)}

    def text(lang, n):
        return " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(n))

    long = {lang: text(lang, 700) for lang in alphabets}
    rows = [(lang, t) for lang, t in long.items()] + [("l000", long["l000"])] * 50 + [("none", ""), (None, "x")]
    model = language_id.train(spark.createDataFrame(rows, "lang string, text string"))
    assert min(len(t.encode()) for t in long.values()) > 8000 and model.langs == sorted(alphabets)
    asked = spark.createDataFrame([(lang, text(lang, 40)) for lang in alphabets], "lang string, text string")
    found = language_id.with_language(asked, model).collect()
    assert all(r["language"]["lang"] == r["lang"] for r in found)
    assert language_id.keep_explained(asked, model).count() == len(alphabets)
    # copies do not take the places of other texts, and the end of a long text counts
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 2)
    monkeypatch.setattr(language_id, "LEAST_DOCS", 2)
    some = spark.createDataFrame([("en", "aaaa")] * 9 + [("en", "b" * 20000 + "c")] * 9, "lang string, text string")
    seen = {r["window"] for r in language_id.window_counts(language_id.sample(some), ["en"]).where("length = 1").collect()}
    assert seen == {ord("a"), ord("b"), ord("c")}


def slow_near(texts, words):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        k = min(words, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    root[a] = root[b] = min(root[a], root[b])
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def test_word_hashes_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(near_dedup, "BYTES", 1000)
    hashes = near_dedup.WordHashes()
    for i in range(500):
        hashes[b"%d" % i * 30]
        assert sum(map(len, hashes)) <= 1100


def test_near_groups(docs, texts, empty):
    got = {r[0]: tuple(r)[1:] for r in near_dedup.near_groups(docs, 2).collect()}
    assert got == slow_near(texts, 2)
    assert near_dedup.near_groups(empty, 2).count() == 0
    assert near_dedup.keep_one(docs.where("doc_id is null or doc_id > 12")).count() == 6


def test_near_groups_of_a_repeated_id(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = spark.createDataFrame([(5, one), (5, two), (5, two), (3, one + " x"), (7, two + " y"), (9, "z")], ["doc_id", "text"])
    found = near_dedup.near_groups(docs, words=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(3, 3), (5, 3), (5, 3), (7, 3), (9, 9)]


def test_keys_of_the_same_homes_are_one_meeting(spark):
    """Forty keys that lead all classes of two homes together ask for one pair of homes, once."""
    rows = [(key, home, None) for key in range(40) for home in (1, 2)]
    rows += [(50, 1, 7), (50, 2, 7), (51, 1, 7), (51, 2, 8), (52, 1, 7), (52, 2, 8), (53, 1, 8), (53, 2, 7), (54, 3, None)]
    got = near_dedup.meetings(spark.createDataFrame(rows, "key bigint, home bigint, of bigint")).collect()
    assert dict(map(tuple, got)) == {key: 0 for key in range(40)} | {51: 51, 52: 51, 53: 53, 54: 54}


def test_seats_are_those_of_every_pair_that_shares_a_key(spark):
    rng = random.Random(4)
    home, root = ({n: rng.randrange(k) for n in range(60)} for k in (6, 20))
    found = sorted({(rng.randrange(25), rng.randrange(60)) for _ in range(180)})
    want = set()
    for key, a in found:
        for other, b in found:
            if key == other and root[a] != root[b]:
                low, high = sorted((home[a], home[b]))
                at = [n for k, n in found if k == key and home[n] in (low, high)]
                want |= {(low, high, n, root[n], home[n]) for n in at}
    got = near_dedup.needed_seats(
        spark.createDataFrame([(k, n, root[n]) for k, n in found], "key bigint, node bigint, root bigint"),
        spark.createDataFrame(list(home.items()), "node bigint, home bigint"),
    ).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}


def slow_repeats(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("kinds", [substring_dedup.KINDS, 1])
def test_repeated_substrings(docs, empty, monkeypatch, kinds):
    monkeypatch.setattr(substring_dedup, "KINDS", kinds)
    some = docs.where("doc_id is null or doc_id <> 13")
    got = [
        (r["doc_id"], r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))
        for r in substring_dedup.without_repeats(some).collect()
    ]
    assert sorted(got, key=str) == slow_repeats([(r["doc_id"], r["text"]) for r in some.collect()], 400)
    assert substring_dedup.without_repeats(empty).count() == 0


def test_run_length_index():
    rng = random.Random(5)
    for _ in range(200):
        letters = rng.choice([b"ab", b"abc", b"abcdefgh"])
        base = bytes(rng.choice(letters) for _ in range(60))
        texts = [base[rng.randrange(30) : rng.randrange(31, 60)] for _ in range(rng.randrange(1, 9))]
        length = rng.choice([3, 5, 9])
        seen = collections.Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
        want = [
            substring_dedup.merged([(p, p + length) for p in range(len(t) - length + 1) if seen[t[p : p + length]] > 1])
            for t in texts
        ]
        assert [substring_dedup.merged(s) for s in substring_dedup.repeats(texts, length)] == want


def test_secrets(spark):
    rng = random.Random(3)
    noise = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40)) for _ in range(60)]
    texts = [None, "", "é token=secret=abcdefg PassWord : 'x1y2z3' secret=token:abcdefgh", "AKIA" + "A1" * 8 + " AKIA123",
             "deadbeef" * 3 + "-" + "ab" * 11, "api_key='" + "f" * 30 + "'"] + noise
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kinds = [
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"),
    ]
    got = {r["doc_id"]: r for r in secrets.find_secrets(docs).collect()}
    for i, text in enumerate(texts):
        want = sorted(
            (m.start(), k, f"{name}:{m.start()}:{m.end()}")
            for k, (name, pattern) in enumerate(kinds)
            for m in re.finditer(pattern, text or "", re.A)
            if len(m[2] if k == 0 else m[0]) >= (6, 20, 24)[k]
        )
        assert got[i]["base_text"] == ",".join(w[2] for w in want)
    assert sum(got[i]["spans"] == "random:0:40" for i in range(6, len(texts))) >= 50
    words = spark.createDataFrame([(i, f"{w}-is-not-{w}-noise-{i % 7}") for i, w in enumerate(WORDS * 3)], "doc_id bigint, text string")
    assert {r["spans"] for r in secrets.find_secrets(words).collect()} == {""}
    assert secrets.find_secrets(docs.where("doc_id < 0")).count() == 0


def test_secrets_with_slashes(spark):
    rng = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(letters) for _ in range(40)) + "=" * (i % 3) for i in range(300)]
    paths = [f"see https://example.org/{w}/listings/archive/{i % 7}/{w}/page-of-the-archive/index" for i, w in enumerate(WORDS * 4)]
    inside = "/listings/archive/of-the-page/" + "".join(rng.choice(letters[:62]) for _ in range(43)) + "/index/of/the/archive"
    base = "deadbeef" * 3 + "/" + keys[0].replace("/", "x").rstrip("=")
    texts = [f"k {k} ." for k in keys] + paths + [inside, base]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(docs).collect()}
    slashed = [i for i, k in enumerate(keys) if "/" in k and re.search("[0-9]", k)]
    assert len(slashed) > 100
    assert sum(got[i] == f"random:2:{2 + len(keys[i])}" for i in slashed) >= 0.8 * len(slashed)
    assert {got[len(keys) + i] for i in range(len(paths))} == {""}
    assert got[len(texts) - 1].startswith("hex:0:24")


@pytest.mark.parametrize("class_words, known", [(4096, 1 << 18), (6, 1 << 18), (6, 20), (0, 0)])
def test_class_model(docs, empty, class_words, known):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    learn = F.expr("doc_id <> 17")
    numbered, model = class_lm.train(docs, learn, class_words=class_words, known=known)
    split = {i: (t or "").encode().lower().split() for i, t in rows}
    learned = [split[i] for i, _ in rows if i not in (17, None)]
    c = collections.Counter(w for words in learned for w in [*words, None])
    total, distinct = sum(c.values()), len(c)
    # every word that was learned has one class of words; the others have one by their shape
    numbers = model.vocabulary.numbers
    rest = {bytes(r["word"]): r["class"] for r in model.words.collect()}
    assert len(numbers) <= known and numbers.keys() | rest.keys() == c.keys() - {None}
    of = {w: int(model.class_of[i]) for w, i in numbers.items()} | rest
    assert set(of.values()) <= set(range(class_lm.CLASSES))
    end = class_lm.KINDS - 1

    def kinds(words):
        return [end, *(of.get(w, class_lm.CLASSES + class_lm.shape(w)) for w in words), end]

    steps = collections.Counter(p for words in learned for p in zip(kinds(words), kinds(words)[1:]))
    leaving = collections.Counter()
    for (a, _), n in steps.items():
        leaving[a] += n
    inside, members = collections.Counter(), collections.Counter()
    for w, n in c.items():
        inside[end if w is None else of[w]] += n
        members[end if w is None else of[w]] += 1
    got = class_lm.scores(numbered, model).collect()
    assert len(got) == len(rows)
    for r in got:
        words = [*split[r["doc_id"]], None]
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(c[w] > 0 for w in words), total)
        assert r["base_score"] == pytest.approx(base)
        path = kinds(words[:-1])
        score = sum(math.log10((steps[p] + 0.1) / (leaving[p[0]] + 0.1 * class_lm.KINDS)) for p in zip(path, path[1:]))
        score += sum(
            math.log10((c[w] + 0.1) / (inside[k] + 0.1 * (members[k] + 1))) for w, k in zip(words, path[1:])
        )
        assert r["score"] == pytest.approx(score)
    if class_words == 6 and known == 20:
        numbered, model = class_lm.train(empty, learn)
        assert class_lm.scores(numbered, model).count() == 0
        numbered, model = class_lm.train(docs, F.lit(None).cast("boolean"))
        assert {r["n_known"] for r in class_lm.scores(numbered, model).collect()} == {0}


def test_sums_sort_what_is_new_not_every_batch(monkeypatch):
    monkeypatch.setattr(class_lm, "FLUSH", 1000)
    calls, unique, rng = [], np.unique, np.random.default_rng(6)
    monkeypatch.setattr(np, "unique", lambda *a, **b: calls.append(len(a[0])) or unique(*a, **b))
    added, sums = [rng.integers(0, 5000, 50) for _ in range(400)], class_lm.Sums()
    for keys in added:
        sums.add(keys)
    keys, n = sums.taken()
    monkeypatch.undo()
    want, m = np.unique(np.concatenate(added), return_counts=True)
    assert (keys == want).all() and (n == m).all()
    assert len(calls) < 20 and sum(calls) == 400 * 50
    assert [len(x) for x in sums.taken()] == [0, 0]


def test_words_join_the_classes_of_their_neighbours(spark):
    """Two alternating classes of words: a rare word between those of one is in the class of the other."""
    pattern = [["a0", "a1", "a2"], ["b0", "b1", "b2"]]
    texts = [" ".join(pattern[i % 2][(i * k) % 3] for i in range(60)) for k in range(1, 12)]
    texts += ["a0 rareb a1 b1", "b0 rarea b2 a1"] * 2
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for known in (8, 1000):  # 8: all but the two
        _, model = class_lm.train(docs, F.lit(True), class_words=6, known=known)
        of = {bytes(r["word"]): r["class"] for r in model.words.collect()}
        of |= {w: int(model.class_of[i]) for w, i in model.vocabulary.numbers.items()}
        assert of[b"rarea"] in {of[b"a0"], of[b"a1"], of[b"a2"]}
        assert of[b"rareb"] in {of[b"b0"], of[b"b1"], of[b"b2"]}


def test_class_model_beats_unigrams(spark, sf_dir):
    r = QUERIES["op7_class_lm"](spark, sf_dir).where("held_out").selectExpr("sum(score) > sum(base_score) as better").first()
    assert r["better"]


def test_small_rows_of_exact_dedup_are_not_broadcast(docs, capsys):
    """Each broadcast takes pages of the driver's memory, however small its table is."""
    exact_dedup.exact_groups(docs).explain("simple")
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_exact_groups(docs, texts, empty):
    of = collections.defaultdict(list)
    for i, t in texts.items():
        of[t or ""].append(i)
    want = {
        i: (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in of.items() for i in ids
    }
    assert {r[0]: tuple(r)[1:] for r in exact_dedup.exact_groups(docs).collect()} == want
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_groups_of_a_repeated_id(spark):
    rows = [(5, "A"), (5, "B"), (9, "B"), (9, "C"), (2, "C"), (2, "A2"), (5, "B"), (None, "B")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sha = {t: hashlib.sha256(t.encode()).hexdigest() for _, t in rows}
    got = sorted(map(tuple, exact_dedup.exact_groups(docs).collect()))
    assert got == sorted([
        (5, 5, 1, True, sha["A"]), (5, 9, 2, False, sha["B"]), (9, 9, 2, True, sha["B"]),
        (9, 9, 2, True, sha["C"]), (2, 9, 2, False, sha["C"]), (2, 2, 1, True, sha["A2"]),
    ])
    kept = sorted(map(tuple, exact_dedup.keep_one(docs).collect()), key=str)
    assert kept == [(2, "A2"), (5, "A"), (9, "B"), (9, "C"), (None, "B")]


def test_fingerprints_combine_and_collisions_are_told_apart(docs, texts, monkeypatch):
    data = np.random.default_rng(0).integers(0, 256, 70000, np.uint8).tobytes()
    for cut in (0, 1, exact_dedup.CHUNK, 50000, 70000):
        parts = exact_dedup.fingerprint(data[:cut]), exact_dedup.fingerprint(data[cut:])
        assert exact_dedup.combine(*parts) == exact_dedup.fingerprint(data)
    prints = exact_dedup.fingerprints(docs).withColumn("print", exact_dedup.F.lit(b"same").cast("binary"))
    monkeypatch.setattr(exact_dedup, "SUBGROUP", 3)
    got = exact_dedup.equal_classes(docs, prints).collect()
    classes = {r["doc"]: r["same_as"] for r in got}
    assert all((classes[a] == classes[b]) == ((texts[a] or "") == (texts[b] or "")) for a in texts for b in texts)


def test_decontamination(spark, empty):
    item = "Alice bought 12 apples and 30 pears for 5 dollars from the market in Dublin on a cold day last year."
    other = item.replace("Alice", "Bob").replace("12", "44").replace("30", "9")
    odd = "Alice paid 12 pounds of 12 pence to 12 men at 12 gates near 12 towns with 12 carts in 12 days."
    texts = [item, "Before it. " + other + " After it.", "clean text about apples and pears", None, "", "12 30 5",
             odd.replace("12", "{}").format(*range(20, 27)), odd.replace("12", "77")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(1, item), (2, None), (3, "12 30"), (4, odd)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.passages(docs, items).collect()}
    assert got == {(0, 1), (1, 1), (5, 3), (7, 4)}
    assert decontaminate.without_passages(docs, items).count() == 4
    assert decontaminate.passages(docs, empty.selectExpr("doc_id as item_id", "text")).count() == 0
    assert decontaminate.passages(empty, items).count() == 0


def test_quality(spark, sf_dir, docs, empty):
    got = QUERIES["op10_quality"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.8 * len(rows)
    none = labels.where("doc_id < 0").withColumnRenamed("quality", "label")
    model = quality.train(docs, none)
    assert {r[0] for r in docs.select(quality.scored(docs, model)).collect()} == {0.5}
    assert empty.select(quality.scored(empty, model)).count() == 0


def slow_learn(samples, prior):
    """The same steps, feature by feature, in double precision."""
    rng = np.random.default_rng(1)
    vectors = (rng.uniform(-1, 1, (quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32) / quality.DIMENSIONS).astype(float)
    weights, biases = np.zeros((2, quality.DIMENSIONS)), np.zeros(2)
    n, steps = np.bincount([s[0] for s in samples], minlength=2), quality.EPOCHS * len(samples)
    for step in range(steps):
        if step % len(samples) == 0:
            order = rng.permutation(len(samples))
        label, buckets, shares = samples[order[step % len(samples)]]
        mean = sum(s * vectors[b] for b, s in zip(buckets, shares))
        share = np.exp([w @ mean + c for w, c in zip(weights, biases)])
        slope = quality.RATE * (1 - step / steps) * len(samples) / (2 * n[label]) * (share / share.sum() - np.eye(2)[label])
        back = weights.T @ slope
        for k in (0, 1):
            weights[k] -= slope[k] * mean
            biases[k] -= slope[k]
        for b, s in zip(buckets, shares):
            vectors[b] -= s * len(buckets) ** 0.5 * back
    return vectors @ (weights[1] - weights[0]), biases[1] - biases[0] + np.log(prior / (1 - prior))


def test_quality_learns_and_scores_by_its_definition(spark):
    rng = random.Random(9)
    texts = [prose(rng, 30) if i % 3 else "".join(chr(97 + rng.randrange(6)) for _ in range(90)) for i in range(24)]
    rows = [(i, t, int(i % 3 > 0)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    model = quality.train(docs, docs.select("doc_id", "label"))
    grams = [[f for w in t.encode().split() for f in quality.word_features(w)] for t in texts]
    samples = []
    for (_, _, label), found in zip(rows, grams):
        counts = collections.Counter(found)
        buckets = np.array(sorted(counts), np.int32)
        shares = np.array([counts[b] / len(found) for b in sorted(counts)], np.float32)
        samples.append((label, buckets, shares))
    samples.sort(key=lambda s: (s[0], len(s[1]), s[1].tobytes(), s[2].tobytes()))
    per_bucket, bias = slow_learn(samples, 16 / 24)
    got = {r["doc_id"]: r["score"] for r in docs.select("doc_id", quality.scored(docs, model).alias("score")).collect()}
    for i, found in enumerate(grams):
        want = 1 / (1 + math.exp(-(sum(per_bucket[f] for f in found) / len(found) + bias)))
        assert got[i] == pytest.approx(want, abs=1e-3)


def test_quality_reads_unspaced_texts_to_their_end(spark, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(quality, "BLOCK", 50)
    for length in (65, 98, 99, 100, 101, 333):
        word = bytes(rng.randrange(33, 256) for _ in range(length))
        blocks = [int(b) for block in quality.long_features(word) for b in block]
        assert sorted(blocks) == sorted(quality.word_features(word)) and len(blocks) == 3 * length + 1
    same = "".join(chr(0x4E00 + rng.randrange(900)) for _ in range(30))

    def text(label):
        return same + "".join(chr(0x3041 + 40 * label + rng.randrange(40)) for _ in range(200))

    rows = [(i, text(i % 2), i % 2) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    model = quality.train(docs.where("doc_id < 80"), docs.select("doc_id", "label"))
    found = docs.where("doc_id >= 80").select("label", quality.scored(docs, model).alias("score")).collect()
    assert all((r["score"] > 0.5) == r["label"] for r in found)


def test_pipeline_by_hand(spark, sf_dir):
    """Each stage against its definition over the rows that the one before kept."""
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = corpus_pipeline.run(spark, sf_dir)
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    last = {t: i for i, t in sorted(rows.items()) if re.search(r"[^\W\d_]", t)}
    unique = {i: t for t, i in last.items()}
    groups = slow_near_fast(unique, 5)
    firsts = {i for i in unique if groups[i] == i}
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {i for i in firsts if not any(item in unique[i] for item in items)}
    assert set(kept) == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "benchmark", "pieces"]


def slow_near_fast(texts, words):
    sets, holders = {}, collections.defaultdict(list)
    for i, t in texts.items():
        w = t.encode().lower().split()
        k = min(words, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
        for s in sets[i]:
            holders[s].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in sets.items():
        for j, both in collections.Counter(j for s in own for j in holders[s] if j < i).items():
            if 100 * both >= 80 * (len(own) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}
