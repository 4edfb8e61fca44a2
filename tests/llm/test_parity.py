"""The Jaccard join against all pairs, and the bounds it rests on."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemill.llm import parity
from tidemill.llm.buckets import bucket_links


def shingle_set(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def plainly(rows, p=90, q=100):
    sets = [shingle_set(t) for _, t in rows]
    above = list(range(len(rows)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and q * both >= p * len(x | sets[j]):
                above[top(i)] = top(j)
    least = collections.defaultdict(list)
    for i, (number, _) in enumerate(rows):
        least[top(i)].append(number)
    known = lambda ids: min((n for n in ids if n is not None), default=None)
    return collections.Counter((n, len(sets[i]), known(least[top(i)])) for i, (n, _) in enumerate(rows))


def found(df):
    return collections.Counter(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def edited(rand, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rand.randrange(len(words))
        words[at : at + rand.choice((0, 1, 1, 2))] = [str(rand.random())] if rand.random() < 0.8 else []
    return words


def corpus(seed):
    rand = random.Random(seed)
    rows, bases = [], [[f"w{rand.randint(0, 3000)}" for _ in range(n)] for n in (9, 11, 20, 33, 64, 70, 130, 260, 700)]
    for i in range(260):
        base = rand.choice(bases)
        rows.append((i, " ".join(edited(rand, base, rand.choice((0, 1, 1, 2, 3, len(base) // 60, len(base) // 45))))))
    rows += [(300 + i, " ".join(rand.choice("ab") for _ in range(rand.randint(0, 14)))) for i in range(60)]
    rows += [(400, None), (401, ""), (402, " \n"), (403, "One"), (404, "one"), (405, "a b"), (406, "b a"), (407, "x " * 5000), (408, "x x x")]
    rows += [(None, "one"), (None, "no id at all"), (409, "no id at all"), (409, "no id at all"), (None, None), (410, "y" * 90_000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(docs_of, seed):
    rows = corpus(seed)
    want = plainly(rows)
    assert len({c for _, _, c in want}) < len(rows) - 100
    assert found(parity.jaccard_components(docs_of(rows))) == want


def test_another_similarity(docs_of):
    rows = corpus(3)
    assert found(parity.jaccard_components(docs_of(rows), similarity=(3, 4))) == plainly(rows, 3, 4)
    with pytest.raises(ValueError):
        parity.Bands(1, 2)


def test_groups_of_copies_and_of_copies_apart(docs_of):
    """Hundreds of linked copies, and hundreds alike by some 0.6 that aren't linked, around one text each."""
    rand = random.Random(4)
    one, two = ([f"{k}{rand.randint(0, 10**6)}" for _ in range(120)] for k in "ab")
    rows = [(i, " ".join(edited(rand, one, 1))) for i in range(250)]
    rows += [(i + 1000, " ".join(edited(rand, two, 10))) for i in range(250)] + [(5000, " ".join(two)), (5001, " ".join(one))]
    assert found(parity.jaccard_components(docs_of(rows))) == plainly(rows)


def test_copies_apart_make_few_candidates(docs_of):
    rand = random.Random(5)
    base = [f"b{rand.randint(0, 10**6)}" for _ in range(120)]
    rows = [(i, " ".join(edited(rand, base, 10))) for i in range(300)]
    bands = parity.Bands(90, 100)
    keyed = docs_of(rows).selectExpr("doc_id", "cast(md5(text) as binary) t", "text")
    signed = keyed.mapInArrow(parity._signed(3, bands), parity._SIGNED_DDL)
    classes = signed.select("c", "h", "size", *parity.part_counts())
    met = parity.kept_parts(signed, classes, bands).groupBy("key").count().collect()
    assert sum(r["count"] ** 2 for r in met) < len(rows) ** 2 / 50


def test_linked_sets_keep_a_part_in_common(docs_of):
    """The promise of the join, on sizes around the edges of bands."""
    rand = random.Random(6)
    bands = parity.Bands(90, 100)
    for n in [9, 10, 12, 15, 16, 17, 31, 32, 35, 63, 64, 65, 70, 127, 128, 140, 500]:
        base = [str(rand.random()) for _ in range(n + 2)]
        for drop in range(0, n // 9 + 1):
            texts = [" ".join(base), " ".join(base[drop:])]
            row, value = parity.shingles(pa.array(texts))
            size = np.bincount(row, minlength=2)
            differ = size.sum() - 2 * len(np.intersect1d(value[row == 0], value[row == 1]))
            if differ > bands.differ(*size) or not differ:
                continue
            low = parity._low(size)
            sides = [low, np.where(size <= bands.largest(low - 1), low // 2, 0)]
            keys = [set(), set()]
            for side in sides:
                for r, k in zip(*parity.part_keys(row, value, side, size, bands)):
                    keys[r].add(int(k))
            assert keys[0] & keys[1], (n, drop)


def test_short_sketches_bound_the_difference(spark):
    rand = np.random.default_rng(7)
    shared, one, two = rand.integers(0, 2**63, 60).astype(np.uint64), rand.integers(0, 2**63, 5).astype(np.uint64), rand.integers(0, 2**63, 9).astype(np.uint64)
    row, value = np.r_[np.zeros(65, np.int64), np.ones(69, np.int64)], np.r_[shared, one, shared, two]
    low = np.array([32, 64])
    words, first = parity.short_sketches(row, value, low)
    df = spark.createDataFrame([(words[: first[1]].tolist(), words[first[1] :].tolist())], "x array<bigint>, y array<bigint>")
    ways = [df.select(parity.hamming(df[a], df[b]).alias("h")).first().h for a, b in (("x", "y"), ("y", "x"))]
    assert 0 < ways[0] <= 14 and ways[0] == ways[1]
    assert df.select(parity.hamming(df.x, df.x).alias("h")).first().h == 0


def test_no_rows(docs_of):
    assert parity.jaccard_components(docs_of([(1, "a")]).limit(0)).count() == 0
    assert found(parity.jaccard_components(docs_of([(1, None), (2, "a")]))) == collections.Counter([(1, 0, 1), (2, 1, 2)])


def test_buckets_link_through_pivots(spark):
    """Members apart from the pivots still meet."""
    groups = {i: i % 3 for i in range(30)}
    members = spark.createDataFrame([("k", str(i), 1) for i in groups] + [("alone", "0", 1)], "key string, c string, size int")
    same = lambda pairs: pairs.selectExpr("a", "b", "cast(a as int) % 3 = cast(b as int) % 3 as linked")
    for rounds in (1, 2):
        roots, _ = bucket_links(members, same, lambda x, y: x == y, "test", rounds)
        found = collections.defaultdict(set)
        for r in roots.collect():
            found[r.root].add(int(r.node) % 3)
        assert len(found) == 3 and all(len(v) == 1 for v in found.values())


def test_oracle(spark, folder, duck):
    out = found(parity.jaccard_components(spark.read.parquet(f"{folder}/documents.parquet")))
    assert out == collections.Counter(duck(folder).execute(parity.ORACLE).fetchall())
