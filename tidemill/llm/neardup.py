"""Near-duplicate documents by BagMinHash.

A text is a bag of 5-word shingles with their counts as weights. The weight axis of each shingle is cut into octaves
(0, 1], (1, 2], (2, 4], ...; each octave holds a Poisson process in time whose points carry a signature place and a level
inside the octave. A bag takes the points up to its weight; the earliest point of each place is the signature, so two
bags agree in a place with the probability of their weighted Jaccard similarity. Points are drawn in the order of time
and stop at the slowest place's time so far, so a bag needs few points a shingle, and a shingle that occurs n times
costs log n processes.

Signatures are cut into bands; texts that share a band are candidates. In a bucket of candidates all are compared with
one pivot, by the exact overlap of their bags, and what is in another component after that with the member of most
links. Links make components. Equal texts are one class from the start, in all of this.

What is still apart is compared by differences from that second pivot. With t the similarity and f = (1 - t) / (1 + t),
bags of n and m shingles link if they differ in no more than f * (n + m). They differ where their differences from the
pivot do; members in several components differ more than that from the pivot, taken together, so a pair that links has
differences in common, at least half of what is over. A prefix of each member's differences is enough to meet, rarest
first: edits of one copy alone are shared with nobody and fill the prefix, so a large group of copies that differ from
a common text but aren't linked makes few pairs, though each is near the others. Members that share a kept difference first meet the
one of them nearest to the pivot; those still apart after that become a pair. Parity sketches of the differences must
allow both kinds of pair, and every one is verified.

Defined results: texts of fewer than five words are one shingle. A null text or one without words is a class by itself.
Words are letters and digits, in lower case. The class of a document is the smallest doc_id among its component.
Repeated rows are in one class; of rows equal in id and text one is kept. Null ids sort last. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.components import components
from tidemill.llm.parity import FIXED_WORDS, fixed_hamming, fixed_sketches
from tidemill.llm.tables import scratch, stage
from tidemill.llm.text import ALPHANUMERIC, U64, Words, complete, grams, mix, pieces

SHINGLE = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares none of 24 bands of 5 places with a chance of 7 in 100,000; one of 0.9, 5 in 10**10.
BANDS, PLACES = 24, 5


def bags(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shingle hash and count, sorted by row and hash."""
    words = Words(column, ALPHANUMERIC, lower=True)
    hashes, counts = words.hashes(), words.counts
    starts = np.flatnonzero(complete(words, shingle))
    row, value = words.document[starts], grams(hashes, shingle)[starts] if len(starts) else np.zeros(0, U64)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    if len(short):
        whole = [grams(hashes[words.first[i] : words.first[i + 1]], int(counts[i]), seed=0x9E6C63D0876A9A99 + 2 * int(counts[i]))[0] for i in short]
        row, value = np.r_[row, short], np.r_[value, np.array(whole, U64)]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.r_[True, (np.diff(row) != 0) | (np.diff(value) != 0)][: len(row)]
    at = np.flatnonzero(new)
    return row[at], value[at], np.diff(np.r_[at, len(row)])


def signatures(row: np.ndarray, value: np.ndarray, count: np.ndarray, rows: int, places: int) -> np.ndarray:
    """(rows, places) times of the earliest points; infinite for a row without shingles."""
    first = np.full((rows, places), np.inf)
    if not len(row):
        return first
    # A shingle of count n takes part in the octaves whose lower end is below n.
    octaves = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 1)
    unit = np.repeat(np.arange(len(row)), octaves)
    octave = np.arange(len(unit)) - np.repeat(np.cumsum(octaves) - octaves, octaves)
    low = np.where(octave > 0, 1 << np.maximum(octave - 1, 0), 0)
    rate = np.maximum(low, 1)
    owner, top = row[unit], count[unit]
    seed = mix(value[unit] + octave.astype(U64) * U64(0xA0761D6478BD642F))
    time, turn, slowest = np.zeros(len(unit)), 0, first.max(axis=1)
    flat = first.reshape(-1)
    while len(unit):
        turn += 1
        draw = mix(seed + U64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((draw >> U64(11)).astype(np.float64) + 0.5) / 9007199254740992.0) / (places * rate)
        more = mix(draw ^ U64(0xE7037ED1A0B428DB))
        live = time < slowest[owner]
        if not live.all():
            owner, top, seed, time, low, rate, more = (x[live] for x in (owner, top, seed, time, low, rate, more))
        unit = owner
        level = low + 1 + ((more >> U64(32)).astype(np.int64) * rate >> 32)
        taken = level <= top
        place = (more & U64(0xFFFFFFFF)).astype(np.int64) * places >> 32
        np.minimum.at(flat, (owner * places + place)[taken], time[taken])
        slowest = first.max(axis=1)
    return first


def _band_keys(times: np.ndarray, bands: int, places: int) -> np.ndarray:
    bits = times.view(U64).reshape(len(times), bands, places)
    key = np.repeat(np.arange(1, bands + 1, dtype=U64)[None, :] * U64(0xD1B54A32D192ED03), len(times), axis=0)
    for i in range(places):
        key = mix(key ^ bits[:, :, i]) + U64(i)
    return key.astype(np.int64)


def _signed(bands: int, places: int, shingle: int):
    schema = pa.schema([("doc_id", pa.int64()), ("c", pa.binary()), ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            row, value, count = bags(piece.column("text"), shingle)
            size = np.bincount(row, count, minlength=piece.num_rows).astype(np.int64)
            keys = _band_keys(signatures(row, value, count, piece.num_rows, bands * places), bands, places)
            full = size > 0
            offsets = np.r_[0, np.cumsum(np.where(full, bands, 0))].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].reshape(-1)), mask=pa.array(~full))
            yield pa.record_batch([piece.column("doc_id"), piece.column("c"), pa.array(size), lists], schema=schema)

    return run


def _overlaps(shingle: int):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text_a", "text_b"):
            left, right = bags(piece.column("text_a"), shingle), bags(piece.column("text_b"), shingle)
            row, value, count = (np.concatenate(x) for x in zip(left, right))
            order = np.lexsort((value, row))
            row, value, count = row[order], value[order], count[order]
            both = np.flatnonzero((np.diff(row) == 0) & (np.diff(value) == 0))
            shared = np.bincount(row[both], np.minimum(count[both], count[both + 1]), minlength=piece.num_rows)
            total = np.bincount(row, count, minlength=piece.num_rows) - shared
            similarity = np.divide(shared, total, out=np.zeros(len(total)), where=total > 0)
            yield pa.record_batch([piece.column("a"), piece.column("b"), pa.array(similarity)], schema=schema)

    return run


def _class_key(text: str = "text") -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """Pairs (a, b) with whether their bags overlap enough."""
    side = lambda x: texts.select(F.col("c").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return (
        both.mapInArrow(_overlaps(shingle), "a binary, b binary, similarity double")
        .select("a", "b", (F.col("similarity") >= similarity).alias("linked"))
        .distinct()
    )


def _differences(shingle: int):
    """Where the bags of two texts differ: a token for each copy of a shingle that one has and the other lacks."""
    words = [(f"w{i}", pa.int64()) for i in range(FIXED_WORDS)]
    schema = pa.schema([("p", pa.binary()), ("c", pa.binary()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64())), *words])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text_a", "text_b"):
            rows = piece.num_rows
            (row_p, value_p, count_p), (row_c, value_c, count_c) = bags(piece.column("text_a"), shingle), bags(piece.column("text_b"), shingle)
            row, value = np.r_[row_p, row_c], np.r_[value_p, value_c]
            sides = np.r_[count_p, np.zeros(len(row_c), np.int64)], np.r_[np.zeros(len(row_p), np.int64), count_c]
            order = np.lexsort((value, row))
            row, value = row[order], value[order]
            at = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])][: len(row)])
            in_p, in_c = (np.add.reduceat(x[order], at) if len(at) else x for x in sides)
            row, value, extra = row[at], value[at], np.abs(in_c - in_p)
            which = np.repeat(np.arange(len(at)), extra)
            copy = np.arange(len(which)) - np.repeat(np.cumsum(extra) - extra, extra) + np.minimum(in_p, in_c)[which]
            token = mix(value[which] ^ mix(copy.astype(U64) * U64(2) + (in_c > in_p)[which].astype(U64)))
            first = np.r_[0, np.cumsum(np.bincount(row, extra, minlength=rows).astype(np.int64))].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(first), pa.array(token.astype(np.int64)))
            size = np.bincount(row_c, count_c, minlength=rows).astype(np.int64)
            sketch = fixed_sketches(np.repeat(np.arange(rows), np.diff(first)), token, rows)
            columns = [piece.column("a"), piece.column("b"), pa.array(size), lists, *(pa.array(w) for w in sketch.T)]
            yield pa.record_batch(columns, schema=schema)

    return run


def _kept_differences(
    placed: DataFrame, pivots: DataFrame, texts: DataFrame, similarity: float, shingle: int, folder: str
) -> DataFrame:
    """A row for each member of a bucket and each difference from its pivot that is in its prefix.

    `placed` has key, c, root of the buckets that hold several components; `pivots` has key, p: a member that was
    compared with all members of other components than its own.
    """
    f = (1 - similarity) / (1 + similarity)
    named = placed.select("key", "c", "root").join(pivots, "key").select("p", "c", "root").distinct()
    side = lambda x, name: texts.select(F.col("c").alias(x), F.col("text").alias(name))
    both = named.select(F.col("p").alias("a"), F.col("c").alias("b")).join(side("a", "text_a"), "a").join(side("b", "text_b"), "b")
    words = [f"w{i}" for i in range(FIXED_WORDS)]
    ddl = "p binary, c binary, n bigint, tokens array<bigint>, " + ", ".join(f"{w} bigint" for w in words)
    differ = both.select("a", "b", "text_a", "text_b").mapInArrow(_differences(shingle), ddl)
    differ = differ.dropDuplicates(["p", "c"]).join(named, ["p", "c"]).withColumn("d", F.size("tokens").cast("long"))
    differ = stage(differ.withColumn("over", F.col("d") - f * F.col("n")), "neardup-differences", folder)
    # What is over the bound in the nearest member of the pivot's component, and of the others.
    own = differ.filter(F.col("c") == F.col("p")).select("p", F.col("root").alias("own_root"))
    nearest = differ.join(own, "p").groupBy("p", "own_root").agg(
        F.min(F.when(F.col("root") == F.col("own_root"), F.col("over"))).alias("inside"),
        F.min(F.when(F.col("root") != F.col("own_root"), F.col("over"))).alias("outside"),
    )
    partner = F.when(F.col("root") == F.col("own_root"), F.col("outside")).otherwise(F.least("inside", "outside"))
    common = F.ceil((F.col("over") + partner) / 2 - 1e-9)
    # Told once a member, not once a difference: rows of differences are many, so they carry and move as little as may be.
    told = differ.join(stage(nearest, "neardup-nearest", folder), "p").withColumn("common", common)
    tokens = told.select("p", "c", "root", "common", F.explode("tokens").alias("token"))
    # A token is of use if two components have it.
    shared = tokens.groupBy("p", "token").agg(F.count("*").alias("members"), F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    found = tokens.join(shared.select("p", "token", "members"), ["p", "token"])
    of_member = Window.partitionBy("p", "c")
    found = found.withColumn("rest", F.count("*").over(of_member) - F.row_number().over(of_member.orderBy("members", "token")) + 1)
    found = found.filter(F.col("common") <= F.col("rest")).select("p", "token", "c", "root", "rest")
    found = found.join(differ.select("p", "c", "n", "d", "over", *words), ["p", "c"])
    return stage(found.withColumn("place", F.col("d") - F.col("rest")).drop("rest"), "neardup-prefixes", folder)


def _may_link(similarity: float) -> Column:
    """Sizes of sides l and r allow a link, and sketches of their differences from one pivot don't rule it out."""
    f = (1 - similarity) / (1 + similarity)
    sizes = F.least("l.n", "r.n") >= similarity * F.greatest("l.n", "r.n")
    # Sketches of the differences differ in no more bits than the bags do in shingles.
    return sizes & (fixed_hamming("l", "r") <= F.floor(f * (F.col("l.n") + F.col("r.n")) + 1e-9))


def _pairs_with_nearest(found: DataFrame, similarity: float) -> DataFrame:
    """Pairs (c, d) of a member and, of those it has a kept difference in common with, the one nearest to the pivot.

    What is near the pivot is near most others, so few components are left for the pairs of all members.
    """
    words = [f"w{i}" for i in range(FIXED_WORDS)]
    nearest = found.groupBy("p", "token").agg(F.min(F.struct("over", "c", "n", *words)).alias("r"))
    met = found.alias("l").join(nearest, ["p", "token"]).filter((F.col("l.c") != F.col("r.c")) & _may_link(similarity))
    return met.select(F.col("l.c").alias("c"), F.col("r.c").alias("d")).distinct()


def _pairs_by_differences(found: DataFrame, similarity: float) -> DataFrame:
    """Pairs (c, d) of members of different components that may link: they have a kept difference in common."""
    left, right = found.alias("l"), found.alias("r")
    same = [F.col(f"l.{x}") == F.col(f"r.{x}") for x in ("p", "token")]
    apart = (F.col("l.c") < F.col("r.c")) & (F.col("l.root") != F.col("r.root"))
    need = F.ceil((F.col("l.over") + F.col("r.over")) / 2 - 1e-9)
    near = (F.col("l.place") + need <= F.col("l.d")) & (F.col("r.place") + need <= F.col("r.d"))
    met = left.join(right, [*same, apart & near & _may_link(similarity)])
    return met.select(F.col("l.c").alias("c"), F.col("r.c").alias("d")).distinct()


def _apart(members: DataFrame, roots: DataFrame, folder: str) -> DataFrame | None:
    """key, c, size, root of the members of buckets that hold several components; none if there are none."""
    placed = members.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    apart = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("key")
    placed = stage(placed.join(apart, "key").select("key", "c", "size", "root"), "neardup-apart", folder)
    return None if placed.isEmpty() else placed


def _more_links(tested: DataFrame, pairs: DataFrame, texts: DataFrame, similarity: float, shingle: int, folder: str) -> DataFrame:
    """Those of `pairs` (c, size, d, other) that are not yet tested and whose sizes allow a link, tested."""
    pairs = pairs.filter(F.least("size", "other") >= similarity * F.greatest("size", "other"))
    pairs = pairs.select(F.greatest("c", "d").alias("a"), F.least("c", "d").alias("b")).distinct()
    pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    return stage(_verified(pairs, texts, similarity, shingle), "neardup-links", folder)


def _links(tested: DataFrame) -> DataFrame:
    return tested.filter("linked").select("a", "b")


def _rooted(keyed: DataFrame, signed: DataFrame, similarity: float, shingle: int, folder: str) -> DataFrame:
    """c, first_id, n, root: the classes of equal texts with their components, from tables of the folder."""
    # Equal texts become one class; their signatures are equal.
    classes = stage(
        signed.filter(F.col("size") > 0)
        .groupBy("c")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("bands").alias("bands")),
        "neardup-classes",
        folder,
    )
    banded = classes.select("c", "size", F.explode("bands").alias("key"))
    buckets = stage(
        banded.groupBy("key").agg(F.min("c").alias("pivot"), F.count("*").alias("n")).filter("n > 1").select("key", "pivot"),
        "neardup-buckets",
        folder,
    )
    members = stage(banded.join(buckets, "key"), "neardup-members", folder)
    wanted = members.select("c").distinct().join(classes.select("c", "first_id"), "c")
    texts = stage(
        keyed.join(wanted, "c").filter(F.col("doc_id").eqNullSafe(F.col("first_id"))).select("c", "text"),
        "neardup-texts",
        folder,
    )
    tested = stage(
        _verified(members.filter("c <> pivot").select(F.col("c").alias("a"), F.col("pivot").alias("b")).distinct(), texts, similarity, shingle),
        "neardup-links",
        folder,
    )
    roots = components(_links(tested))
    apart = _apart(members, roots, folder)
    if apart is not None:
        # The member of most links speaks for its component.
        degree = _links(tested).select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count("*").alias("links"))
        ranked = apart.join(degree, "c", "left").withColumn("links", F.coalesce("links", F.lit(0)))
        pivots = ranked.groupBy("key").agg(F.max(F.struct("links", "c", "root", "size")).alias("p"))
        pivots = stage(pivots, "neardup-pivots", folder)
        pairs = apart.join(pivots, "key").filter(F.col("root") != F.col("p.root"))
        pairs = pairs.select("c", "size", F.col("p.c").alias("d"), F.col("p.size").alias("other"))
        more = _more_links(tested, pairs, texts, similarity, shingle, folder)
        tested, roots = tested.unionByName(more), components(_links(more), roots)
        apart = _apart(members, roots, folder)
    if apart is not None:
        sizes = members.select("c", "size").distinct()
        sized = lambda pairs: pairs.join(sizes, "c").join(sizes.select(F.col("c").alias("d"), F.col("size").alias("other")), "d")
        found = _kept_differences(apart, pivots.select("key", F.col("p.c").alias("p")), texts, similarity, shingle, folder)
        # Edits that copies share link them: those that have one in common meet one of them first.
        more = _more_links(tested, sized(_pairs_with_nearest(found, similarity)), texts, similarity, shingle, folder)
        tested, roots = tested.unionByName(more), components(_links(more), roots)
        found = found.drop("root").join(roots.withColumnRenamed("node", "c"), "c", "left")
        found = stage(found.withColumn("root", F.coalesce("root", "c")), "neardup-prefixes", folder)
        more = _more_links(tested, sized(_pairs_by_differences(found, similarity)), texts, similarity, shingle, folder)
        roots = components(_links(more), roots)
    return classes.select("c", "first_id", "n").join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, bands: int = BANDS, places: int = PLACES
) -> DataFrame:
    """A row for each document row: doc_id, c (key of the text), class_id, class_size, keep (first of its class)."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _class_key().alias("c"), "text")
    signed = stage(
        keyed.mapInArrow(_signed(bands, places, shingle), "doc_id bigint, c binary, size bigint, bands array<bigint>"),
        "neardup-signatures",
    )
    with scratch(docs.sparkSession, "neardup") as folder:
        rooted = stage(_rooted(keyed, signed, similarity, shingle, folder), "neardup-rooted")
    groups = rooted.groupBy("root").agg(
        F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "c")).alias("head"), F.sum("n").alias("class_size")
    )
    placed = rooted.join(groups, "root").select("c", "head", "class_size")
    alone = F.col("size") == 0
    return signed.select("doc_id", "c", "size").join(placed, "c", "left").select(
        "doc_id",
        "c",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.first_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("bigint").alias("class_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("head.first_id")) & (F.col("c") == F.col("head.c")))).alias("keep"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """`docs` without all but one document of each class."""
    kept = near_duplicates(docs, **options).filter("keep").select("doc_id", "c").distinct()
    keyed = docs.withColumn("_c", _class_key()).withColumn("_d", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 62))))
    kept = kept.select(F.col("c").alias("_c"), F.coalesce("doc_id", F.lit(-(1 << 62))).alias("_d"))
    return keyed.join(kept, ["_d", "_c"], "left_semi").dropDuplicates(["_d", "_c"]).drop("_d", "_c")
