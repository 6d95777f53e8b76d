"""Language, toxicity and secrets against brute force."""

import itertools
import math
import random
import re
import string

import numpy as np
from pyspark.sql import functions as F

from sensorflow.llm import language, toxicity
from sensorflow.llm.common import in_bucket
from sensorflow.llm.secrets import EntropyParams, listed, running, scan_secrets

from .helpers import documents, words

PARTS = {"aa": ["ka", "ro", "mi", "tel"], "bb": ["sch", "ung", "ein", "wer"], "cc": ["oux", "eau", "illé", "que"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_id_and_cases(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, lang, 40), lang) for i, lang in enumerate(list(PARTS) * 40)]
    odd = [(900, None, "aa"), (901, "", None), (902, "123 --- !!", None), (903, "Ж漢 kalimera", None),
           (904, sentence(rng, "bb", 30_000), None), (None, sentence(rng, "cc", 20), None),
           (3, rows[3][1], "aa"), (905, "KARO MITEL", None)]
    docs = documents(spark, rows + odd, clashing=True)
    got = language.identify_language(docs, ~in_bucket("doc_id", 4, 2)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == lang for i, _, lang in rows)
    assert [by[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert by[903]["lang_pred"] in PARTS and by[904]["lang_pred"] == "bb" and by[None]["lang_pred"] == "cc"
    assert by[905]["lang_pred"] == "aa" and all(0 <= r["score"] <= 1 for r in got)


def test_language_without_labels_and_empty_table(spark):
    got = language.identify_language(documents(spark, [(1, "abc")]), F.lit(True)).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]
    assert language.identify_language(documents(spark, []), F.lit(True)).count() == 0


def test_cross_parsing_counts_longest_phrases():
    train = {"x": ["abracadabra kadabra"], "y": ["zoo keeper"]}
    model = language.train(train)
    rng = random.Random(4)
    for _ in range(50):
        text = "".join(rng.choice("abrcdkzoe ") for _ in range(rng.randint(1, 60)))
        folded = language.fold(text)
        if not folded.any():
            continue
        got = model.phrases([model.symbols(folded)])[0].tolist()
        for lang, n in zip(model.languages, got):
            source = "".join(chr(c) if c else " " for c in language.fold(train[lang][0])) + " "
            s = "".join(chr(c) if c else " " for c in folded)
            at = count = 0
            while at < len(s):
                end = at + 1
                while end <= len(s) and s[at:end] in source:
                    end += 1
                at, count = max(end - 1, at + 1), count + 1
            assert n == count, (text, lang)


def greedy(text, source):
    """Phrases of a text: the longest that the source holds, from left to right."""
    at = count = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in source:
            end += 1
        at, count = max(end - 1, at + 1), count + 1
    return count


def test_phrases_cross_the_borders_of_pieces():
    rng = random.Random(14)
    train = {lang: [sentence(rng, lang, 60)] for lang in PARTS}
    train["aa"][0] += " " + "a" * 9 + " abcabcabca"
    model = language.train(train)
    texts = ["a" * 9_001, "abc" * 5_000, sentence(rng, "bb", 4_000), "ka" * 1_024 + "b" * 2_048 + "ro" * 1_500, "k",
             *(sentence(rng, lang, n) for lang in PARTS for n in (1, 150, 260, 270, 700)),
             "".join(rng.choice("karomitel ") for _ in range(12_000))]
    folded = [language.fold(t) for t in texts]
    got = model.phrases([model.symbols(x) for x in folded])
    for i, lang in enumerate(model.languages):
        source = "".join(chr(c) if c else " " for c in language.fold(train[lang][0])) + " "
        assert got[:, i].tolist() == [greedy("".join(chr(c) if c else " " for c in x), source) for x in folded]


def test_the_sample_is_from_drawn_places(spark):
    rng = random.Random(15)
    header = "the same header of every text " * 100
    rows = [(i, header + sentence(rng, "bb", 3_000), "bb") for i in range(30)]
    found = language.labelled_sample(documents(spark, rows), F.lit(True), "text", "lang", "doc_id", 64, 500)["bb"]
    assert len(found) == 30 and {len(t) for t in found} == {500}
    assert sum("header" in t for t in found) < 12


def brute_base(t):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                        re.I | re.A)
    s = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 12]
    s += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    s += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(s))


def brute_entropy(string_, bits, window):
    """First start and last end of the windows with enough bits."""
    hits = []
    for i in range(len(string_) - window + 1):
        w = string_[i:i + window]
        h = -sum(w.count(c) / window * math.log2(w.count(c) / window) for c in set(w))
        if h >= bits - 1e-9:
            hits.append(i)
    return (hits[0], hits[-1] + window) if hits else None


def test_secrets_equal_brute_force(spark):
    rng = random.Random(5)
    pieces = ["password", "PassWd", "secret", "token", "API_KEY", "apikey", ":", "=", " ", '"', "'", "AKIA", "\U0001f600",
              "é", "\n", "-", "."]
    rows = []
    for i in range(150):
        t = "".join(rng.choice(pieces) if rng.random() < 0.7 else
                    "".join(rng.choice("0123456789abcdefXYZ") for _ in range(rng.randint(1, 22))) for _ in range(30))
        rows.append((i, t))
    rows += [(500, None), (501, ""), (502, "x" * 200_000), (503, "token: token : abcdefghijklmnop"),
             (None, "AKIA" + "A" * 14), (504, "AKIAAKIA" + "B" * 10), (505, "é" * 3 + "0123456789abcdef"),
             (506, "ſecret=abcdefghijklmnop")]
    got = scan_secrets(documents(spark, rows, clashing=True)).select("doc_id", listed(F.col("base")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in got} == {i: brute_base(t or "") for i, t in rows}
    assert scan_secrets(documents(spark, [])).count() == 0


def test_entropy_adds_random_strings_only(spark):
    rng = random.Random(6)
    p = EntropyParams()
    mixed = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(8)]
    low = ["a1" * 20, "donaudampfschifffahrtsgesellschaft1", "1" * 40, "A" * 24 + "b2"]
    partly = "k9" * 15 + mixed[0][:26] + "9k" * 15
    allowed = "123e4567-e89b-12d3-a456-426614174000"
    mixed.append("".join(rng.choice(string.ascii_letters + string.digits) for _ in range(8_000)))
    rows = [(i, f"ré {s} end") for i, s in enumerate([*mixed, *low, partly, allowed])]
    rows.append((99, "secret = " + mixed[1]))  # the base span stays, and no other covers it
    got = {r["doc_id"]: (r["a"], r["b"]) for r in scan_secrets(documents(spark, rows)).select(
        "doc_id", listed(F.col("added")).alias("a"), listed(F.col("base")).alias("b")).collect()}
    for i, s in enumerate([*mixed, *low, partly]):
        found = brute_entropy(s, p.mixed_bits, p.window)
        assert got[i][0] == (f"entropy:{found[0] + 3}:{found[1] + 3}" if found else ""), s
    assert all(got[i][0] for i in range(len(mixed))) and got[len(mixed) + len(low)][0]
    assert got[len(mixed) + len(low) + 1][0] == ""
    assert got[99][0] == "" and got[99][1] == "assign:0:49"


def test_running_results_over_several_blocks(spark):
    rng = random.Random(3)
    rows = [(n, [rng.randint(0, 50) for _ in range(n)]) for n in (0, 1, 31, 32, 33, 64, 1023, 1024, 1025, 3_000, 40_000)]
    df = spark.createDataFrame(rows, "n int, v array<int>").select(
        "n", running(F.col("v"), lambda a, x: a + x).alias("sums"), running(F.col("v"), F.greatest).alias("tops"))
    got = {r["n"]: (r["sums"], r["tops"]) for r in df.collect()}
    for n, values in rows:
        assert got[n] == (list(itertools.accumulate(values)), list(itertools.accumulate(values, max)))


def test_many_secrets_in_one_text(spark):
    upper = "9F3A7C2E1B4D8F60A5C3E7D9"
    text = "".join(f"{i:016x} \U0001f600 {upper} " for i in range(5_000))
    row = scan_secrets(documents(spark, [(1, text)])).select(listed(F.col("base")).alias("b"), listed(F.col("added")).alias("a")).first()
    step = 16 + 3 + len(upper) + 1
    assert row["b"] == ",".join(f"hex:{i * step}:{i * step + 16}" for i in range(5_000))
    assert row["a"] == ",".join(f"entropy:{i * step + 19}:{(i + 1) * step - 1}" for i in range(5_000))


def found_secrets(spark, texts):
    got = scan_secrets(documents(spark, list(enumerate(texts)))).select("doc_id", listed(F.col("added")).alias("a")).collect()
    return [a for _, a in sorted((r["doc_id"], r["a"]) for r in got)]


def test_classes_are_judged_by_run_and_short_keys_are_found(spark):
    rng = random.Random(8)

    def key(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    hexes = [f"{glue}{key('0123456789ABCDEF', n)}" for glue in ("k=", "/v1/", "id=", "SIGNING_KEY=", "")
             for n in (20, 40, 40) for _ in range(4)]
    short = [f"{glue}{key(string.ascii_letters + string.digits, n)}" for glue in ("", "k=") for n in (18, 20, 22) for _ in range(8)]
    only = [key(string.ascii_letters, 40) for _ in range(8)]
    words_ = ["acknowledgements", "donaudampfschifffahrtsgesellschaft", "addEventListener", "aaaaaaaabbbbbbbb12", "1234567890123456789012"]
    got = found_secrets(spark, [*hexes, *short, *only, *words_])
    a, b, c = len(hexes), len(hexes) + len(short), len(hexes) + len(short) + len(only)
    assert sum(map(bool, got[:a])) >= 0.95 * a
    assert sum(map(bool, got[a:b])) >= 0.85 * len(short)
    assert all(got[b:c]) and not any(got[c:])


def test_dates_and_base_spans_are_cut_out_of_candidates(spark):
    rng = random.Random(9)
    key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40))
    texts = [f"2024-01-15_{key}", f"2024-01-15T10-30-00Z-{key}", f"api_key=abcdefghijklm.{key}", f"{'0' * 20}/Z_{key}",
             f"123e4567-e89b-12d3-a456-426614174000/{key}", "2024-01-15T103000+0100", "2024-01-15_10-30-00-2024-01-16",
             f"é {key}"]
    got = found_secrets(spark, texts)
    for t, spans in zip(texts[:2] + texts[3:5] + texts[7:], got[:2] + got[3:5] + got[7:]):
        kind, start, end = spans.split(":")
        assert abs(int(start) - t.index(key)) <= 4 and int(end) >= len(t) - 2, (t, spans)
    assert got[2] == "" and got[5:7] == ["", ""]  # the base span covers the key; nothing but times


def labelled_docs(rng):
    rows, labels = [], []
    for i in range(300):
        w = sentence(rng, "aa", 40).split()
        toxic = int(i % 5 == 0)
        if toxic:
            w[3], w[17], w[30] = "zugwort", "zugworter", "blafasel"
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_toxicity_learns_folds_and_spares(spark):
    rng = random.Random(7)
    rows, labels = labelled_docs(rng)
    table = spark.createDataFrame(labels + [(None, 1, 1), (7, 0, None), (5, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(documents(spark, rows, clashing=True), table, ~in_bucket("doc_id", 4, 2))
    plain = " ".join(sentence(rng, "aa", 30).split())
    odd = [(1000, plain + " zugwort zugwort"), (1001, plain + " ZUGW0RT зugwоrt z​ugwort"), (1002, plain),
           (1003, None), (1004, ""), (1005, plain * 400), (None, plain + " blafasel zugwort"), (1002, plain)]
    got = toxicity.score_toxicity(documents(spark, rows + odd, clashing=True), model).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["predicted"] == y for i, _, y in labels)
    assert by[1000]["predicted"] == by[1001]["predicted"] == by[None]["predicted"] == 1
    assert [by[i]["predicted"] for i in (1002, 1003, 1004, 1005)] == [0] * 4
    assert toxicity.score_toxicity(documents(spark, []), model).count() == 0


def test_toxicity_exceptions_and_missing_labels(spark):
    model = toxicity.ToxicityModel({" clown ": 3.0, " trash ": 3.0, " tras": 1.0})
    a = model.automaton()
    assert model.density("a clown", a) == 3.0 / 20 and model.density("the clown fish swims", a) == 0
    assert model.density("trash can, trash", a) == 3.0 / 20 and model.density("traskan", a) == 1.0 / 20
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    m = toxicity.learn(documents(spark, [(1, "x")]), none, F.lit(True))
    assert [r["predicted"] for r in toxicity.score_toxicity(documents(spark, [(1, "x")]), m).collect()] == [0]


def test_calibration_is_monotone():
    d = np.array([0.0, 0.01, 0.02, 0.2, 0.3, 0.25])
    slope, _ = toxicity.calibrate(d, np.array([0, 0, 1, 1, 1, 0.0]))
    assert slope > 0


def test_seeds_that_the_sample_shows_harmless_do_not_count(spark):
    rng = random.Random(31)
    rows, labels = [], []
    for i in range(300):
        toxic = int(i % 5 == 0)
        rows.append((i, " ".join([*words(rng, 20), "garbage", "pig", "clown fish", *(["zorblax", "quimpt"] if toxic else [])])))
        labels.append((i, 1, toxic))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn(documents(spark, rows), table, F.lit(True))
    assert not {" garbage ", " pig "} & set(model.weights) and " clown " in model.weights
    odd = [(1, "zorblax quimpt"), (2, "garbage and pig in the yard"), (3, "you clown")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(documents(spark, odd), model).collect()}
    assert got[1] > 0.5 > got[2]


def test_many_exception_phrases_are_linear():
    import time
    model = toxicity.ToxicityModel({" idiot ": 3.0, " can ": 1.0, " trash ": 2.0})
    automaton = model.automaton()
    n = 40_000
    began = time.perf_counter()
    density = model.density("trash can idiot " * n, automaton)
    assert time.perf_counter() - began < 5
    assert density == 3.0 * n / (3 * n)
