"""Classifiers, searches, url rules, mixing, and the pipeline."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import language, mixing, quality, queries, topk, toxicity, urls  # noqa: F401
from tidemill.llm.registry import ORACLES, QUERIES

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "?! 12"), (5, "one"), (5, "one"), (None, "one two"), (6, "x " * 3000), (7, "y" * 50_000)]
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    from compare import differences

    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) is None


def test_all_segmentations_are_summed():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "aba"]
    lattice = language.Lattice(pieces)
    chances = np.random.default_rng(1).random((lattice.size, 2))
    place = {p: i + 1 for i, p in enumerate(pieces)}

    def total(word, k):
        def rest(i):
            if i == len(word):
                return 1.0
            ends = range(i + 1, len(word) + 1)
            known = [(j, place.get(word[i:j], 0 if j == i + 1 else None)) for j in ends]
            return sum(chances[p, k] * rest(j) for j, p in known if p is not None)

        return rest(0)

    words = ["aba", "ab", "x", "", "ababab", "bxba"]
    want = np.log([[total("▁" + w, k) for k in (0, 1)] for w in words])
    assert np.abs(language.word_scores(lattice, chances, words) - want).max() < 1e-12
    # Expected uses: each piece's share of the sum, summed over its places; their lengths add up to the characters.
    used = language.expected_counts(lattice, chances, ["aba"], np.array([0]), np.array([3]))
    sizes = np.array([1] + [len(p) for p in pieces])
    assert abs((used[:, 0] * sizes).sum() - 3 * len("▁aba")) < 1e-9 and not used[:, 1].any()


def test_long_words_are_summed_whole():
    """Sums far below what a float holds, against logarithms kept at every place; unknown characters among them."""
    rand = random.Random(3)
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "aba", "abab" * 4]
    lattice = language.Lattice(pieces)
    chances = np.random.default_rng(1).random((lattice.size, 2)) * 1e-3
    chances[0] = 1e-9
    place = {p: i + 1 for i, p in enumerate(pieces)}

    def sums(word, k):
        logs = [0.0]
        for end in range(1, len(word) + 1):
            parts = []
            for start in range(max(0, end - 16), end):
                piece = place.get(word[start:end], 0 if start == end - 1 else None)
                if piece is not None:
                    parts.append(logs[start] + np.log(chances[piece, k]))
            logs.append(np.logaddexp.reduce(parts))
        return logs[-1]

    words = ["".join(rand.choice("abx") for _ in range(n)) for n in (1, 15, 16, 17, 31, 32, 33, 40, 40, 500, 3000)] + ["x" * 200, "ab" * 400]
    want = np.array([[sums("▁" + w, k) for k in (0, 1)] for w in words])
    assert want.min() < -10_000
    assert np.abs(language.word_scores(lattice, chances, words) / want - 1).max() < 1e-9
    used = language.expected_counts(lattice, chances, words, np.zeros(len(words), int), np.ones(len(words)))
    sizes = np.array([1] + [len(p) for p in pieces])
    assert abs((used[:, 0] * sizes).sum() / sum(len(w) + 1 for w in words) - 1) < 1e-9


def test_language_on_held_out_rows_and_odd_ones(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == docs.count() and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    model = language.fit(docs.filter("doc_id < 100"))
    odd = language.identify(docs_of(ODD), model).collect()
    assert len(odd) == len(ODD)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in odd if r.doc_id in (1, 2, 3, 4))
    assert all(r.lang_pred in model.languages and 0 <= r.score <= 1 for r in odd if r.doc_id not in (1, 2, 3, 4))
    assert language.predict(docs_of(ODD)).filter("lang_pred <> 'und'").count() == 0  # nothing to learn from
    assert language.identify(docs_of(ODD).limit(0), model).count() == 0


def test_quality_on_held_out_rows_and_odd_ones(spark, docs_of, labels_of):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    out = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in out) >= 0.9 * len(out)
    none = quality.classify(docs_of(ODD), labels_of([(5, None, 1)])).collect()
    assert len(none) == len(ODD) and {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    net = quality._train(np.zeros((2, quality.CHUNK), np.int16), np.array([0, 1]), np.array([0.0, 1.0]))
    odd = quality.score(docs_of(ODD), net).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert quality.score(docs_of(ODD).limit(0), net).count() == 0


def test_every_byte_is_in_a_chunk():
    for size in (0, 1, quality.CHUNK, quality.CHUNK + 1, 5000):
        owner, starts = quality.cut(np.zeros(size + 7, np.uint8), np.array([7, 7 + size]))
        covered = set()
        for s in starts:
            covered.update(range(s, s + quality.CHUNK))
        assert set(range(7, 7 + size)) <= covered and set(owner) == {0}


@pytest.fixture(scope="module")
def insults():
    """Clean texts of invented words; toxic ones hold a word of a list."""
    rand = random.Random(5)
    syllables = ["ba", "de", "ki", "lo", "mu", "ra", "sen", "ti"]
    word = lambda: "".join(rand.choice(syllables) for _ in range(rand.randint(1, 3)))
    rows, labels = [], []
    for i in range(600):
        words, toxic = [word() for _ in range(rand.randint(5, 40))], int(rand.random() < 0.3)
        if toxic:
            words[rand.randrange(len(words))] = rand.choice(["idiot", "moron", "scum"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_disguised_words_are_restored_and_scored(docs_of, labels_of, insults):
    rows, labels = insults
    docs, known = docs_of(rows), labels_of(labels)
    out = toxicity.classify(docs, known).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    model = toxicity.fit(docs, known)
    for token in ("1d10t", "id!ot", "i.d.i.o.t", "idiooot", "iiidiot", "m0r0n", "mo-ron", "$cum"):
        assert toxicity.restore(token, model.trigrams) in ("idiot", "moron", "scum"), token
    told = [(1000, "bade kilo 1d10t mura"), (1001, "bade i d i o t mura"), (1002, "bade M0R0N! kilo"), (1003, "bade kilo mura " * 900 + "sc.um"), (1004, "a1" * 100_000 + " m0r0n " + "z z " * 50_000)]
    scores = {r.doc_id: r.score for r in toxicity.score(docs_of(told + ODD), model).collect()}
    assert all(scores[n] >= 0.5 for n, _ in told)
    assert all(scores[n] < 0.5 for n, _ in ODD)
    none = toxicity.classify(docs_of(ODD), labels_of([])).collect()
    assert len(none) == len(ODD) and max(r.score for r in none) < 1e-6
    assert toxicity.score(docs_of(ODD).limit(0), model).count() == 0


def test_words_set_apart_are_restored_behind_other_words(docs_of, labels_of, insults):
    rows, labels = insults
    model = toxicity.fit(docs_of(rows), labels_of(labels))
    told = ["bade a m o r o n kilo", "bade y o u i d i o t", "i d 1 o t mura", "kilo 1 d 1 0 t", "bade i! d! i! o! t!", "a " * 300 + "m o r o n"]
    told += ["k i l o " * n + "i d i o t " + "m u r a " * 20 for n in range(13, 18)]  # across each 64th character
    clean = ["bade a k i l o mura", "m u r a k i l o " * 20, "1 0 1 0 1 1 0", "* * * * *", "a b"]
    scores = {r.doc_id: r.score for r in toxicity.score(docs_of(list(enumerate(told + clean))), model).collect()}
    assert [t for n, t in enumerate(told) if scores[n] < 0.5] == []
    assert [t for n, t in enumerate(clean, len(told)) if scores[n] >= 0.5] == []
    # What all paths share is written out on the way, with the same result.
    long = "k i l o m u r a x y " * 400
    whole, toxicity.SETTLE = toxicity.SETTLE, 10**9
    want = toxicity.restore(long.strip(), model.trigrams)
    toxicity.SETTLE = whole
    assert toxicity.restore(long.strip(), model.trigrams) == want


def test_signs_at_the_end_and_beside_each_other_are_read(docs_of, labels_of, insults):
    rows, labels = insults
    model = toxicity.fit(docs_of(rows), labels_of(labels))
    tokens = ["id10+", "idi07", "1d107", "m0r0n", "5(um", "1d10+"]
    found = toxicity.disguised(pa.array(tokens + ["ki11", "ha73", "tr4$#", "a$$", "5h17", "kilo.", "2026", "a-"]))
    assert [t for t in found[1] if " " not in t] == tokens + ["ki11", "ha73", "tr4$", "a$$", "5h17"]
    scores = {r.doc_id: r.score for r in toxicity.score(docs_of([(n, f"bade {t} kilo") for n, t in enumerate(tokens)]), model).collect()}
    assert [t for n, t in enumerate(tokens) if scores[n] < 0.5] == []


def test_viterbi_equals_all_paths():
    model = np.log(np.random.default_rng(3).dirichlet(np.ones(40), (40, 40))).astype(np.float32)
    for token in ("a1b", "00a", "x*yy", "aaa4", "$t"):
        def paths(stretches):
            if not stretches:
                yield 0.0, ""
                return
            for letters, cost in stretches[0]:
                for value, text in paths(stretches[1:]):
                    yield cost + value, letters + text

        def value(cost, text):
            a, b = 0, 0
            for s in [*(toxicity._symbol(c) for c in text), 0]:
                cost += float(model[a, b, s])
                a, b = b, s
            return cost

        best = max(value(c, t) for c, t in paths(toxicity.lattice(token)))
        found = toxicity.restore(token, model)
        assert abs(max(value(c, t) for c, t in paths(toxicity.lattice(token)) if t == found) - best) < 1e-4


def test_top_k_equals_brute_force(spark):
    rand = np.random.default_rng(7)
    rows = [(i, rand.normal(0, 0.2, 8).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(100)]  # a third of the rows share a vector
    rows += [(400, None), (401, [1.0, None] * 4), (402, [math.nan] * 8), (403, [math.inf] * 8), (404, [1.0, 2.0]), (450, [2.0, 1.0]), (500, []), (None, [0.1] * 8), (550, [1e300] * 8)]
    vectors = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id bigint, embedding array<double>, label int, score double").repartition(4)
    for bits in (1, 6):
        got = {}
        for r in topk.exact_top_k(vectors, F.col("vec_id") % 50 == 0, bits=bits).collect():
            got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
        good = {i: [math.floor(256 * x) for x in v] for i, v in rows if i is not None and i != 550 and v is not None and all(x is not None and math.isfinite(x) for x in v)}
        for q, v in good.items():
            if q % 50 == 0:
                others = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q and len(w) == len(v)]
                want = [(i, -s) for s, i in sorted(others)[:5]]
                assert [got.get(q, {}).get(k + 1) for k in range(len(want))] == want and len(got.get(q, {})) == len(want), (bits, q)
    assert topk.exact_top_k(vectors.limit(0), F.lit(True)).count() == 0


def test_every_row_is_a_candidate(spark):
    """Repeated ids, large entries, repeated queries, and scores that don't fit a long."""
    rows = [(0, [1.0, 1.0]), (1, [1.0, 0.0]), (1, [0.0, 3.0]), (1, [0.0, 3.0]), (2, [2.0**45, 0.0]), (3, [0.5, 0.5]), (50, [2.0**50, 2.0**50]), (100, [1.0, 0.0]), (100, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    out = topk.exact_top_k(vectors, F.col("vec_id") % 50 == 0)
    got = {q: sorted((r["rank"], r.vec_id, r.score) for r in out.collect() if r.query_id == q) for q in (0, 50, 100)}
    # The score of row 50 would take 68 bits.
    assert [(v, s) for _, v, s in got[0][:4]] == [(2, 256 * 2**53), (1, 256 * 768), (1, 256 * 768), (1, 256 * 256)]
    assert len(got[100]) == 10 and [v for _, v, _ in got[100]].count(100) == 2
    assert 2 not in [v for _, v, _ in got[50]]


def test_automaton_equals_regular_expressions():
    globs = ["*.net/**", "*.a*/en/**", "**x", "a*b**c", "*", "**", "*casino*/**", "q" * 70 + "*z"]
    rand = random.Random(6)
    texts = ["".join(rand.choice("abcx/.net") for _ in range(rand.randint(0, 14))) for _ in range(400)]
    texts += [".net/", ".example.net/en/1", ".casino-x.com/", "", "q" * 70 + "z", "q" * 70 + "/z", "x" * 5000]
    found = urls.matches(urls.compile_globs(globs), [t.encode() for t in texts])
    for g, glob in enumerate(globs):
        parts = re.split(r"(\*\*|\*)", glob)
        pattern = re.compile("".join({"**": "(?s:.*)", "*": "[^/]*"}.get(p, re.escape(p)) for p in parts))
        assert found[:, g].tolist() == [bool(pattern.fullmatch(t)) for t in texts], glob


def test_url_verdicts(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme.net/"), (4, "http://Example.NET/en/x?y#z"), (5, "http://example.net"), (6, "https://a.b.org/fr/"),
        (7, "ftp://x.com://y.net/"), (8, "http://www.example.com/de/a"), (9, "http://my-casino.com/x"), (9, "http://my-casino.com/x"),
        (10, "http://notexample.net/en/"), (11, "http://a.org/FR/"), (12, "http://a.com/" + "b" * 5000), (13, "http://a.com?x://b.net/"), (14, "http://é.net/ü\nx"),
    ]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in rows], "page_id bigint, url string, host string, rule string")
    out = {r.page_id: tuple(r)[1:] for r in urls.judge_urls(pages).collect()}
    assert out[1] == out[2] == out[3] == ("", "", None, "allow")
    assert out[4] == ("example.net", "/en/x", "example.net/en/", "allow")
    assert out[5] == ("example.net", "", None, "allow")
    assert out[6][2:] == ("org/fr/", "allow") and out[7] == ("x.com:", "//y.net/", None, "allow")
    assert out[8][2:] == ("example.com/de/", "block") and out[9][2:] == (None, "block")
    assert out[10][2:] == ("net/", "block") and out[11][2:] == (None, "allow") and len(out[12][1]) == 5001
    assert out[13] == ("a.com", "", None, "allow") and out[14] == ("é.net", "/ü\nx", "net/", "block")
    bare = [(1, "http://my-casino.com"), (2, "http://my-casino.com?x=1"), (3, "http://my-casino.com#/a"), (4, "http://a.com/casino"), (5, "http://a.com?casino")]
    bare = spark.createDataFrame(bare, "page_id bigint, url string")
    assert {r.page_id: r.verdict for r in urls.judge_urls(bare).collect()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow"}
    assert urls.judge_urls(pages).count() == len(rows) and urls.judge_urls(pages.limit(0)).count() == 0


def plain_rates(tokens, p, wanted, pull=mixing.PULL, rounds=200_000):
    """Projected gradient on every document's rate, without momentum, run to its end."""
    mass, c, rate = tokens / tokens.sum(), 1 / wanted, np.ones(len(p))
    step = 1 / ((p * mass[:, None]).T @ p @ np.diag(c)).trace()
    for _ in range(rounds):
        then = np.maximum(mixing.LEAST_RATE, rate - step * (p @ (c * ((mass * rate) @ p - wanted)) + pull * (rate - 1)))
        if np.abs(then - rate).max() < 1e-10:
            break
        rate = then
    return rate


def posteriors_of(kind, n=400):
    rand = np.random.default_rng(8)
    if kind == "sharp":
        p = np.full((n, 3), 0.005)
        p[np.arange(n), rand.choice(3, n, p=[0.85, 0.1, 0.05])] = 0.99
    elif kind == "soft":
        p = np.abs(np.array([0.9, 0.05, 0.05]) + rand.normal(0, 0.02, (n, 3)))
    elif kind == "one domain":
        p = np.tile([1.0, 0.0, 0.0], (n, 1))
    else:
        p = rand.random((n, 3)) ** [4, 6, 6]
    return rand.integers(0, 400, n), p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("kind, met, same", [("sharp", 1e-3, 1e-3), ("mixed", 5e-3, 1e-2), ("soft", 0.1, 0.5), ("one domain", 0.13, 1e-3)])
def test_rates_equal_plain_projected_gradient(spark, kind, met, same):
    tokens, p = posteriors_of(kind)
    wanted = np.array([0.82, 0.12, 0.06])
    table = spark.createDataFrame(list(zip(tokens.tolist(), p.tolist())), "n_tokens bigint, p array<double>").repartition(3)
    fitted = mixing.fit_rates(table, wanted)
    assert len(fitted.steps) <= mixing.ROUNDS
    rates, plain = fitted.of(p), plain_rates(tokens, p, wanted)
    cost = lambda r: ((((r * tokens) @ p / tokens.sum() - wanted) ** 2) / wanted).sum() + mixing.PULL * (tokens @ (r - 1) ** 2) / tokens.sum()
    assert (rates >= 0).all() and np.abs(rates - plain).max() < same * max(1, plain.max())
    assert cost(plain) <= cost(rates) + 1e-9 <= cost(np.ones(len(p))) + 1e-9
    shares = (rates * tokens) @ p / tokens.sum()
    assert np.abs(shares - fitted.shares).max() < 1e-9 and abs(np.abs(shares - wanted).max() - fitted.misfit) < 1e-9
    assert fitted.misfit < met
    # Rows don't go because targets can't be met.
    assert kind != "one domain" or (rates > 0.8).all()


def test_mixing_of_odd_rows(docs_of, labels_of):
    out = mixing.mix_rates(docs_of(ODD), labels_of([])).collect()
    assert len(out) == len(ODD) and all(r.p_clean > 0.999 and r.rate > 0 and r.misfit > 0.1 for r in out)
    assert mixing.mix_rates(docs_of(ODD).limit(0), labels_of([])).count() == 0
    kept = mixing.mixed(docs_of(ODD), labels_of([]))
    assert kept.count() == len(ODD) and kept.columns[-3:] == ["rate", "copies", "misfit"]


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert out.columns[:5] == docs.columns and 0 < len(rows) <= docs.count()
    assert len({r.doc_id for r in rows}) == len(rows) and all(r.rate > 0 and r.text for r in rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(set(r.text.split()) <= set(texts[r.doc_id].split()) for r in rows)


def test_registered_names():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{n}" for n in range(1, 14)} and "pipeline" in names
