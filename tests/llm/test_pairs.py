"""Operators on repeated content: near-duplicates, repeated passages, benchmark leaks, licences."""

import collections
import glob
import hashlib
import os
import random
import re
import tempfile
import textwrap

import numpy as np
import pyarrow as pa

from tidemill.llm import components as component_steps
from tidemill.llm import decontaminate, licenses, neardup, substring
from tidemill.llm.components import components
from tidemill.llm.text import U64, Words, complete, grams, sliding_min
from tidemill.llm.toxicity import trigram_model
from tidemill.session import shared_dir

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "?!"), (5, "one"), (5, "one"), (None, "one two"), (6, "x " * 3000), (7, "y" * 50_000)]


def test_words_and_grams():
    texts = ["a bb  a", "", None, "bb a", "x" * 3, "éa bb\x0ba \n", "a"]
    words = Words(pa.array(texts))
    assert words.counts.tolist() == [len((t or "").encode().split()) for t in texts]
    hashes = words.hashes()
    assert hashes[0] == hashes[2] == hashes[-1] and len(set(hashes.tolist())) == 4
    assert complete(words, 2).tolist() == [True, True, False, True, False, False, True, True, False]
    values = np.random.default_rng(1).integers(0, 4, 150).astype(U64)
    for n in (1, 2, 3, 5, 20, 35):
        runs = collections.defaultdict(set)
        for i, h in enumerate(grams(values, n).tolist()):
            runs[tuple(values[i : i + n])].add(h)
        assert all(len(h) == 1 for h in runs.values()) and len(set.union(*runs.values())) == len(runs)
        assert sliding_min(values, n).tolist() == [values[i : i + n].min() for i in range(len(values) - n + 1)]


def test_repeated_passages_equal_brute_force(docs_of):
    rand = random.Random(1)
    rows = [(i, " ".join(rand.choice("abc") for _ in range(rand.randint(0, 120)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "x " * 500), (1004, "x y z " * 300), (1005, "q" * 9000)]
    shared = " ".join(str(rand.random()) for _ in range(60))
    fresh = lambda n: " ".join(str(rand.random()) for _ in range(n))
    rows += [(2000 + i, f"{fresh(40)} {shared if i % 3 == 0 else ''} {fresh(9)}") for i in range(40)]
    for window, bits in ((5, 8), (35, 20)):  # a full sketch lets all windows through and loses none
        out = substring.digest(substring.remove_repeats(docs_of(rows, 5), window=window, cell_bits=bits)).collect()
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out}
        assert got == substring.brute_force(dict(rows), window)


def test_windows_across_the_edges_of_a_common_line_are_spread(docs_of):
    rand = random.Random(6)
    own = lambda: " ".join(str(rand.random()) for _ in range(30))
    line, passage = (" ".join(f"w{k}{i}" for i in range(n)) for k, n in (("a", 25), ("b", 50)))
    rows = [(i, f"{own()} {line if i % 2 else passage} {own()}") for i in range(600)]
    rows += [(600 + i, rows[i][1][40:]) for i in range(20)]
    docs = docs_of(rows, 5)
    sizes = {n: max(r["count"] for r in substring.candidates(docs, cell_bits=16, hot_rows=n).groupBy("anchor").count().collect()) for n in (100, 10**9)}
    assert sizes[10**9] > 100 and sizes[100] < 100
    out = substring.digest(substring.remove_repeats(docs, cell_bits=16, hot_rows=100)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == substring.brute_force(dict(rows))


def test_each_pass_over_the_texts_runs_once(docs_of, tmp_path):
    docs, folder = docs_of([(i, f"{'a b c ' * 30} {i}") for i in range(30)], 3), str(tmp_path)

    def noted(batches):
        with tempfile.NamedTemporaryFile(dir=folder, delete=False):
            yield from batches

    seen = docs.mapInArrow(noted, docs.schema)
    substring.candidates(seen, cell_bits=16)  # reads for the sketch and for the counts of anchors
    assert len(os.listdir(folder)) == 2 * 3
    trigram_model(seen)
    assert len(os.listdir(folder)) == 3 * 3


def test_repeated_passages_of_odd_rows(docs_of):
    out = substring.remove_repeats(docs_of(ODD), cell_bits=16).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed) for r in out) == collections.Counter(
        [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (5, 1, 0), (5, 1, 0), (None, 2, 0), (6, 3000, 3000), (7, 1, 0)]
    )
    assert substring.remove_repeats(docs_of([(1, "a")]).limit(0), cell_bits=16).count() == 0


def bag(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    if len(words) < 5:
        return collections.Counter([tuple(words)] if words else [])
    return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def classes_by_brute_force(rows):
    bags = [bag(t) for _, t in rows]
    above = list(range(len(rows)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = sum((bags[i] & bags[j]).values())
            total = sum(bags[i].values()) + sum(bags[j].values()) - shared
            if shared and shared >= 0.8 * total - 1e-12:
                above[top(j)] = top(i)
    groups = collections.defaultdict(list)
    for i, (number, _) in enumerate(rows):
        groups[top(i)].append(number)
    return {n: min(g) for g in groups.values() for n in g}


def test_signatures_estimate_weighted_similarity():
    rand = random.Random(2)
    base = [str(rand.randint(0, 10**9)) for _ in range(200)]
    texts = [" ".join(base), " ".join(base[:150] + [str(rand.random()) for _ in range(50)]), " ".join(["a"] * 40 + base), " ".join(["a"] * 100 + base), "", "x y"]
    row, value, count = neardup.bags(pa.array(texts))
    times = neardup.signatures(row, value, count, len(texts), 2000)
    assert np.isinf(times[4]).all() and np.isfinite(times[5]).all()
    for i, j in ((0, 1), (0, 2), (2, 3), (0, 3)):
        a, b = bag(texts[i]), bag(texts[j])
        true = sum((a & b).values()) / sum((a | b).values())
        assert abs((times[i] == times[j]).mean() - true) < 0.05


def test_near_duplicates_equal_brute_force(docs_of):
    """A hub whose copies are mostly less alike than the threshold to each other, and odd rows."""
    rand = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    hub = [rand.choice(vocabulary) for _ in range(120)]
    rows, pool = [], [hub]
    for i in range(120):
        words = list(hub if rand.random() < 0.8 else rand.choice(pool))
        for _ in range(rand.randint(1, 9)):
            words[rand.randrange(len(words))] = rand.choice(vocabulary)
        pool.append(words)
        rows.append((i, " ".join(words)))
    rows += [(500 + i, " ".join(hub[: rand.randint(3, 110)])) for i in range(15)]
    rows += [(900, None), (901, ""), (902, "a b"), (903, "A, b!"), (904, "a b"), (905, "z " * 4000), (906, "z " * 4100)]
    out = neardup.near_duplicates(docs_of(rows)).collect()
    want = classes_by_brute_force(rows)
    assert {r.doc_id: r.class_id for r in out} == want
    assert {r.doc_id for r in out if r.keep} == set(want.values())


def test_copies_that_are_apart_equal_brute_force(docs_of):
    """Hundreds of copies of one text, each edited on its own, mostly not linked to it or to each other; some edits are
    shared, so there are links far from the text, and chains of them."""
    rand = random.Random(7)
    hub = [f"w{rand.randrange(10**6)}" for _ in range(130)]
    rows, pool = [], [hub]
    for i in range(260):
        words = list(rand.choice(pool[-40:]) if rand.random() < 0.35 else hub)
        for _ in range(rand.choice((1, 2, 3, 4, 5, 6))):
            words[rand.randrange(len(words))] = f"e{rand.randrange(10**6)}"
        if rand.random() < 0.1:
            words += words[:10] * 2
        pool.append(words)
        rows.append((i, " ".join(words)))
    out = neardup.near_duplicates(docs_of(rows)).collect()
    want = classes_by_brute_force(rows)
    assert {r.doc_id: r.class_id for r in out} == want
    assert 20 < len(set(want.values())) < 240


def test_copies_that_are_apart_make_few_pairs(docs_of, monkeypatch):
    rand = random.Random(8)
    hub = [f"w{rand.randrange(10**6)}" for _ in range(130)]
    rows = []
    for i in range(400):
        words = list(hub)
        for _ in range(rand.choice((3, 4, 5))):
            words[rand.randrange(len(words))] = f"e{rand.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    seen, real = [], neardup._pairs_by_differences
    monkeypatch.setattr(neardup, "_pairs_by_differences", lambda *a: seen.append(real(*a).count()) or real(*a))  # pairs of all buckets
    out = neardup.near_duplicates(docs_of(rows)).collect()
    assert {r.doc_id: r.class_id for r in out} == classes_by_brute_force(rows)
    assert seen and seen[0] < 400 * 399 / 2 / 20


def test_copies_that_share_edits_meet_the_one_nearest_to_the_pivot(spark):
    """The nearest has the largest key; what its sketch of differences rules out is no pair."""
    member = lambda c, over, words: (b"p", 1, c, 100, 5, over, *words)
    near, far, other = [1] + [0] * 7, [3] + [0] * 7, [-1] * 8
    rows = [member(b"a", 4.0, far), member(b"b", 3.0, far), member(b"c", 2.0, other), member(b"d", 1.0, near)]
    words = ", ".join(f"w{i} bigint" for i in range(8))
    found = spark.createDataFrame(rows, f"p binary, token bigint, c binary, n bigint, d bigint, over double, {words}")
    pairs = {(bytes(r.c), bytes(r.d)) for r in neardup._pairs_with_nearest(found, 0.8).collect()}
    assert pairs == {(b"a", b"d"), (b"b", b"d")}


def test_one_row_of_each_class_stays(docs_of):
    kept = neardup.keep_one(docs_of([*ODD, (8, "one"), (9, "one two")]))
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6, 7, 9]
    assert neardup.near_duplicates(docs_of([(1, "a")]).limit(0)).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 1), (20, 21), (22, 23), (23, 20), (30, 30)] + [(100, i) for i in range(101, 140)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({found[n] for n in (1, 2, 3, 7, 8, 9)}) == 1 and len({found[n] for n in (20, 21, 22, 23)}) == 1
    assert len(set(found.values())) == 3 and 30 not in found


def test_components_of_more_edges(spark, monkeypatch):
    frame = lambda edges: spark.createDataFrame(edges, "a bigint, b bigint")
    known = components(frame([(1, 2), (2, 3), (20, 21), (22, 23), (40, 41)]))
    seen, real = [], component_steps._found
    monkeypatch.setattr(component_steps, "_found", lambda edges, folder: seen.append(edges.filter("a <> b").count()) or real(edges, folder))
    found = {r.node: r.root for r in components(frame([(3, 1), (3, 21), (50, 51), (51, 41), (60, 61), (70, 70)]), known).collect()}
    assert seen == [4]  # what is linked already is no work again
    groups = collections.defaultdict(set)
    for node, root in found.items():
        groups[root].add(node)
    assert sorted(map(sorted, groups.values())) == [[1, 2, 3, 20, 21], [22, 23], [40, 41, 50, 51], [60, 61]]
    none = components(frame([]), known)
    assert {tuple(r) for r in none.collect()} == {tuple(r) for r in known.collect()}


def test_tables_of_the_steps_do_not_stay(spark, docs_of):
    folders = lambda: set(glob.glob(f"{shared_dir(spark)}/tidemill/*"))
    before = folders()
    rows = [(i, f"one two three four five six seven eight nine {i // 3}") for i in range(30)]
    out = neardup.near_duplicates(docs_of(rows))
    left = {f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in folders() - before}
    assert left <= {"neardup-signatures", "neardup-rooted", "component-roots"} and out.count() == 30


def leaks_by_brute_force(rows, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = collections.defaultdict(set)
    for number, text in items:
        words = split(text)
        for i in range(max(0, len(words) - window) + 1 if words else 0):
            windows[tuple(words[i : i + window])].add(str(number))
    out = []
    for number, text in rows:
        words, hit, found = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (ids := windows.get(tuple(words[i : i + size]))) :
                    hit.update(range(i, i + size))
                    found |= ids
        out.append((number, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return collections.Counter(out)


def test_leaks_equal_brute_force(spark, docs_of):
    rand = random.Random(4)
    text = lambda n, letters="abc": " ".join(rand.choice(letters) for _ in range(n))
    items = [(i, text(rand.randint(9, 14))) for i in range(40)]
    items += [(100, "one two"), (101, "seven"), (102, None), (103, ""), (104, "p q r s t u v w x"), (105, "k " * 30), (106, items[0][1].upper()), (100, "one two")]
    rows = [(i, text(rand.randint(0, 200))) for i in range(60)]
    rows += [(200, "k " * 300), (201, "One, two; seven"), (202, "p q r s t u v w x y"), (203, "p q r s t u v w"), *ODD]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontaminate.digest(decontaminate.decontaminate(docs_of(rows), benchmark)).collect()
    assert collections.Counter(tuple(r) for r in out) == leaks_by_brute_force(rows, items)
    none = decontaminate.decontaminate(docs_of(rows), benchmark.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)
    assert decontaminate.decontaminate(docs_of(rows).limit(0), benchmark).count() == 0


def test_whole_licences_however_they_are_wrapped(spark, docs_of):
    bodies = [(n, t) for n, t in licenses.KNOWN if len(t) > 500]
    rows, want = [], {}
    for name, text in bodies:
        for width in range(40, 121):
            wrapped = "\n\n".join(textwrap.fill(part, width) for part in text.split("\n\n"))
            rows.append((len(rows), "Copyright (c) 2021 A. Name\n\n" + wrapped))
            want[len(rows) - 1] = name
    out = {r.doc_id: r.license for r in licenses.scan(docs_of(rows), licenses.known_digests(spark)).collect()}
    assert out == want


def test_what_is_a_copyright_line(spark, docs_of):
    body = dict(licenses.KNOWN)["ISC"]
    heads = ["Copyright 1999 X", "(c) 2001-2004, Y", "© 2020 Z", "COPYRIGHT (C) The Authors", "* All rights reserved. *", "Copyright © 2011 by W. All rights reserved"]
    tails = ["(c) you may not sell it", "copyright holders", "All rights reserved by none"]
    rows = [(i, f"{h}\n{body}") for i, h in enumerate(heads)] + [(50 + i, f"{body}\n{t}") for i, t in enumerate(tails)]
    out = {r.doc_id: r.license for r in licenses.scan(docs_of(rows), licenses.known_digests(spark)).collect()}
    assert out == {**{i: "ISC" for i in range(len(heads))}, **{50 + i: None for i in range(len(tails))}}
    assert licenses.scan(docs_of(rows).limit(0), licenses.known_digests(spark)).count() == 0
    table = licenses.known_digests(spark)
    assert table.count() == table.select("digest").distinct().count() and table.filter("length(digest) <> 64").isEmpty()


def test_published_texts_have_the_listed_digests(spark, docs_of):
    folder = "/usr/share/common-licenses"
    names = [n for n in ("Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "MPL-2.0") if os.path.exists(f"{folder}/{n}")]
    rows = [(i, open(f"{folder}/{n}", encoding="utf-8").read().replace("\n", "\r\n")) for i, n in enumerate(names)]
    out = licenses.scan(docs_of([*rows, (99, "none")]), licenses.known_digests(spark)).collect()
    full = lambda n: n if "." in n else f"{n}.0"
    assert {r.doc_id: r.license for r in out} == {**{i: full(n) for i, n in enumerate(names)}, 99: None}


def test_licences(spark, docs_of):
    mit = dict((n, t) for n, t in licenses.KNOWN)["MIT"]
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 Some One\nAll rights reserved.\n\n" + mit.upper().replace('"', "``")),
        (2, "Some text.\r\nReleased under the MIT LICENCE\r\nLicensed under CC BY-NC 4.0."),
        (3, "Released under the MIT License, and more."),
        *((100 + n, t) for n, (_, t) in enumerate(ODD)),
    ]
    out = {r.doc_id: (r.license, r.line_licenses) for r in licenses.scan(docs_of(rows), licenses.known_digests(spark)).collect()}
    assert out[1][0] == "MIT" and out[2] == (None, "CC-BY-NC-4.0,MIT")
    assert all(out[n] == (None, "") for n in out if n > 2) and len(out) == len(rows)
