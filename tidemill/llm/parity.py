"""Exact Jaccard join of word shingles by parity sketches.

A text is the set of its distinct 3-word shingles. In a parity sketch every shingle flips one bit, chosen by its hash,
so two sketches differ in no more bits than the sets do: the Hamming distance is a lower bound of the symmetric
difference. Sets of sizes s and t with a Jaccard similarity of p/q differ in at most (s + t) * (q - p) / (q + p)
shingles.

Sizes are dealt into bands [L, 2L). A band's sketch is cut into more parts than shingles may differ (of a set in the
band or of a larger partner), so linked sets agree in some: the pigeonhole. A part is
a sketch of 2**64 bits of which only the exclusive or of the flipped places is kept, so unlike parts don't agree by
chance. Sets near the upper edge of a band below also take part in that band, since a partner may be there. Each set
keeps the parts that fewest sets share, one more than may differ: two linked sets keep a part in common, since both
keep the first of one common order. Parts nobody shares use up their places without a row, so edited copies that
aren't linked rarely meet. Sets that share a kept part are candidates; the Hamming distance of a second, short sketch
(a few bits a shingle) rules out most that aren't links, and what is left is verified on the sets themselves.

Buckets of candidates are compared through pivots (see `buckets`): links within a component are not all listed. Members
that no pivot has brought together meet in one join, whose condition has the Hamming distance of sketches of 512 bits in
it: unlinked copies of one text are many pairs there, but few rows. Equal sets are one class from the start.

Defined results: words are runs of anything but white space, A-Z in lower case. A text of fewer words than a shingle has
is one shingle. A null text or one without words has an empty set and is a component by itself. The component id is the
smallest doc_id of a component; rows without id have that of the others in theirs, or none. Repeated rows are in one
component. An empty table gives an empty result. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.buckets import bucket_links
from tidemill.llm.tables import stage
from tidemill.llm.text import NOT_SPACE, U64, Words, complete, grams, mix, pieces

SHINGLE = 3
#: Sets link where q * intersection >= p * union.
SIMILARITY = (90, 100)


def shingles(column: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, sorted by both."""
    words = Words(column, NOT_SPACE, lower=True)
    hashes, counts = words.hashes(), words.counts
    starts = np.flatnonzero(complete(words, n))
    row, value = words.document[starts], grams(hashes, n)[starts] if len(starts) else np.zeros(0, U64)
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            whole = grams(hashes, size, seed=0x9E6C63D0876A9A99 + 2 * size)[words.first[short]]
            row, value = np.r_[row, short], np.r_[value, whole]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])][: len(row)]
    return row[new], value[new]


class Bands:
    """What the size of a set says about its partners, for a similarity of p/q over one half."""

    def __init__(self, p: int, q: int):
        if not q < 2 * p <= 2 * q:
            raise ValueError("similarity must be over one half and at most one")
        self.p, self.q = p, q

    def largest(self, s):
        """Size of the largest partner."""
        return s * self.q // self.p

    def differ(self, s, t):
        """In how many shingles linked sets of these sizes may differ."""
        return (s + t) * (self.q - self.p) // (self.q + self.p)

    def most(self, s):
        return self.differ(s, self.largest(s))

    def parts(self, low):
        """Parts of the sketches of the band [low, 2 * low): an eighth more than the largest partner's sketch may miss."""
        return (self.most(self.largest(2 * low - 1)) + 1) * 9 // 8 + 1

    def alike(self, s: Column, t: Column) -> Column:
        return F.least(s, t) * self.q >= F.greatest(s, t) * self.p


def _low(size: np.ndarray) -> np.ndarray:
    """The lower end of each size's band, a power of two."""
    return 1 << (np.frexp(np.maximum(size, 1).astype(float))[1] - 1).astype(np.int64)


def part_keys(row: np.ndarray, value: np.ndarray, low: np.ndarray, size: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the parts of each row with low > 0, in that band's sketch.

    Parts that no shingle is in come last in the common order of parts, so they are listed (as odd keys) only by sets
    with fewer others than they keep.
    """
    here = low[row] > 0
    row, value = row[here], value[here]
    parts = np.where(low > 0, bands.parts(low), 1)
    part = ((value >> U64(32)) * parts[row].astype(U64) >> U64(32)).astype(np.int64)
    at = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (part[1:] != part[:-1])][: len(row)])
    fold = np.bitwise_xor.reduceat(mix(value ^ U64(0x6A09E667F3BCC909)), at) if len(at) else value
    row, part = row[at], part[at]
    filled = np.bincount(row, minlength=len(low))
    bare_rows = np.flatnonzero((low > 0) & (filled <= bands.most(size)))
    if len(bare_rows):
        every = np.repeat(bare_rows, parts[bare_rows]), np.concatenate([np.arange(parts[r]) for r in bare_rows])
        width = int(parts.max()) + 1
        empty = ~np.isin(every[0] * width + every[1], row * width + part)
        row, part = np.r_[row, every[0][empty]], np.r_[part, every[1][empty]]
        fold = np.r_[fold, np.zeros(empty.sum(), U64)]
    bare = (np.arange(len(row)) >= len(at)).astype(U64)
    key = mix(fold ^ mix(low[row].astype(U64) * U64(0xD6E8FEB86659FD93) + part.astype(U64)))
    return row, ((key & ~U64(1)) | bare).astype(np.int64)


def short_sketches(row: np.ndarray, value: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of a sketch of four bits a shingle of the band's lower end, and where each row's begin."""
    words = np.where(low > 0, np.maximum(low // 16, 1), 0)
    first = np.r_[0, np.cumsum(words)]
    here = low[row] > 0
    row, value = row[here], value[here]
    bit = value & (words[row] * 64 - 1).astype(U64)
    out = np.zeros(first[-1], U64)
    np.bitwise_xor.at(out, first[row] + (bit >> U64(6)).astype(np.int64), U64(1) << (bit & U64(63)))
    return out.astype(np.int64), first


#: 64-bit words of the sketch that all sets have alike.
FIXED_WORDS = 8


def fixed_sketches(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """(rows, words): a parity sketch of the same width for sets of any size, from other bits of the hash."""
    out = np.zeros(rows * FIXED_WORDS, U64)
    bit = (value >> U64(20)) & U64(FIXED_WORDS * 64 - 1)
    np.bitwise_xor.at(out, row * FIXED_WORDS + (bit >> U64(6)).astype(np.int64), U64(1) << (bit & U64(63)))
    return out.reshape(rows, FIXED_WORDS).astype(np.int64)


def fixed_hamming(a: str, b: str) -> Column:
    """Bits in which the fixed sketches of two sides differ, in columns w0, w1, ..."""
    total = F.lit(0)
    for i in range(FIXED_WORDS):
        total = total + F.bit_count(F.col(f"{a}.w{i}").bitwiseXOR(F.col(f"{b}.w{i}")))
    return total


def hamming(a: Column, b: Column) -> Column:
    """Bits in which two short sketches differ; the longer is first folded onto the other, bit over bit."""
    half = lambda x: F.zip_with(
        F.slice(x, F.lit(1), F.floor(F.size(x) / 2).cast("int")),
        F.slice(x, F.floor(F.size(x) / 2).cast("int") + 1, F.floor(F.size(x) / 2).cast("int")),
        lambda u, v: u.bitwiseXOR(v),
    )
    onto = lambda x, y: F.when(F.size(x) > F.size(y), half(x)).otherwise(x)
    bits = F.zip_with(onto(a, b), onto(b, a), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(bits, F.lit(0), lambda s, x: s + x)


_SIGNED_DDL = "doc_id bigint, c binary, h bigint, t binary, size bigint, own array<bigint>, below array<bigint>"


def _signed(n: int, bands: Bands):
    lists = pa.list_(pa.int64())
    schema = pa.schema(
        [("doc_id", pa.int64()), ("c", pa.binary()), ("h", pa.int64()), ("t", pa.binary()), ("size", pa.int64()), ("own", lists), ("below", lists)]
    )

    def listed(rows: int, row: np.ndarray, key: np.ndarray) -> pa.Array:
        order = np.argsort(row, kind="stable")
        first = np.r_[0, np.cumsum(np.bincount(row, minlength=rows))].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(first), pa.array(key[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            rows = piece.num_rows
            row, value = shingles(piece.column("text"), n)
            size = np.bincount(row, minlength=rows).astype(np.int64)
            # Sets that may differ in nothing are linked only to equal ones, and those are one class.
            low = np.where(bands.most(size) > 0, _low(size), 0)
            lower = np.where((low > 0) & (size <= bands.largest(low - 1)), low // 2, 0)
            sums = [np.zeros(rows, U64) for _ in range(2)]
            for k, seed in enumerate((0x452821E638D01377, 0xBE5466CF34E90C6C)):
                np.add.at(sums[k], row, mix(value + U64(seed)))
            both = np.stack([*sums, size.astype(U64)], axis=1)
            key = [x.tobytes() if x[2] else None for x in both]
            columns = [
                piece.column("doc_id"), pa.array(key, pa.binary()), pa.array(sums[0].astype(np.int64)), piece.column("t"), pa.array(size),
                listed(rows, *part_keys(row, value, low, size, bands)), listed(rows, *part_keys(row, value, lower, size, bands)),
            ]
            yield pa.record_batch(columns, schema=schema)

    return run


def _linked(n: int, bands: Bands):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("linked", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text_a", "text_b"):
            (row_a, value_a), (row_b, value_b) = (shingles(piece.column(c), n) for c in ("text_a", "text_b"))
            row, value = np.r_[row_a, row_b], np.r_[value_a, value_b]
            order = np.lexsort((value, row))
            row, value = row[order], value[order]
            twice = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
            shared = np.bincount(row[1:][twice], minlength=piece.num_rows)
            union = np.bincount(row, minlength=piece.num_rows) - shared
            linked = (shared > 0) & (bands.q * shared >= bands.p * union)
            yield pa.record_batch([piece.column("a"), piece.column("b"), pa.array(linked)], schema=schema)

    return run


def _sketched(n: int, bands: Bands):
    fixed = [(f"w{i}", pa.int64()) for i in range(FIXED_WORDS)]
    schema = pa.schema([("c", pa.binary()), ("size", pa.int64()), ("sketch", pa.list_(pa.int64())), *fixed])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            row, value = shingles(piece.column("text"), n)
            size = np.bincount(row, minlength=piece.num_rows).astype(np.int64)
            words, first = short_sketches(row, value, _low(size))
            sketch = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(words))
            fixed = fixed_sketches(row, value, piece.num_rows)
            yield pa.record_batch([piece.column("c"), pa.array(size), sketch, *(pa.array(w) for w in fixed.T)], schema=schema)

    return run


def part_counts() -> list[Column]:
    """own, below: how many parts of a set can use up its places; none if some are empty, as those come last in order."""
    counted = lambda name: F.when(F.exists(name, lambda x: x.bitwiseAND(F.lit(1)) == 1), 0).otherwise(F.size(name))
    return [counted("own").alias("own"), counted("below").alias("below")]


def kept_parts(signed: DataFrame, classes: DataFrame, bands: Bands) -> DataFrame:
    """key, c, size of the parts that each set keeps and another one may have as well.

    Rows of parts carry eight bytes of the set's key (h), which stand for all sets that begin so; `classes` has c, h,
    size and the numbers of parts (see `part_counts`). Copies of a set make its parts look shared, which keeps more of
    them.
    """
    spread = lambda name: signed.select("h", F.lit(name == "below").alias("lower"), F.explode(name).alias("key"))
    parts = spread("own").unionByName(spread("below"))
    shared = parts.groupBy("key").agg(F.count("*").alias("sets")).filter("sets > 1")
    found = parts.join(shared, "key").groupBy("h", "lower", "key").agg(F.max("sets").alias("sets"))
    found = found.join(classes.select("h", "c", "size", "own", "below"), "h")
    of_set = Window.partitionBy("c", "lower")
    may_differ = F.floor((F.col("size") + F.floor(F.col("size") * bands.q / bands.p)) * (bands.q - bands.p) / (bands.q + bands.p))
    places = may_differ + 1 - (F.when(F.col("lower"), F.col("below")).otherwise(F.col("own")) - F.count("*").over(of_set))
    rank = F.row_number().over(of_set.orderBy(F.col("key").bitwiseAND(F.lit(1)), "sets", "key"))
    return found.withColumn("kept", rank <= places).filter("kept").select("key", "c", "size")


def jaccard_components(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """A row for each row of `docs`: doc_id, n_shingles, component_id."""
    bands = Bands(*similarity)
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("t"), "text"
    )
    signed = stage(keyed.mapInArrow(_signed(shingle, bands), _SIGNED_DDL), "parity-signed")
    classes = stage(
        signed.filter("c is not null")
        .select("doc_id", "c", "h", "t", "size", *part_counts())
        .groupBy("c")
        .agg(
            F.min("doc_id").alias("first_id"), F.min(F.struct("t", "doc_id")).alias("text_of"), F.first("h").alias("h"),
            F.first("size").alias("size"), F.first("own").alias("own"), F.first("below").alias("below"),
        ),
        "parity-classes",
    )
    members = stage(kept_parts(signed, classes, bands), "parity-members")
    wanted = classes.join(members.select("c").distinct(), "c", "left_semi")
    texts = keyed.join(wanted.select("c", F.col("text_of.t").alias("t"), F.col("text_of.doc_id").alias("d")), "t")
    texts = stage(texts.filter(F.col("doc_id").eqNullSafe(F.col("d"))).select("c", "text"), "parity-texts")
    words = [f"w{i}" for i in range(FIXED_WORDS)]
    ddl = "c binary, size bigint, sketch array<bigint>, " + ", ".join(f"{w} bigint" for w in words)
    sketches = stage(texts.mapInArrow(_sketched(shingle, bands), ddl), "parity-sketches")
    may_differ = lambda s, t: F.floor((s + t) * (bands.q - bands.p) / (bands.q + bands.p))

    def verified(pairs: DataFrame) -> DataFrame:
        side = lambda x: sketches.select(F.col("c").alias(x), F.col("size").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
        text = lambda x: texts.select(F.col("c").alias(x), F.col("text").alias(f"text_{x}"))
        apart = hamming(F.col("s_a"), F.col("s_b"))
        near = pairs.join(side("a"), "a").join(side("b"), "b").filter(apart <= may_differ(F.col("n_a"), F.col("n_b"))).select("a", "b")
        both = stage(near, "parity-near").join(text("a"), "a").join(text("b"), "b").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(_linked(shingle, bands), "a binary, b binary, linked boolean").distinct()

    near = lambda a, b: fixed_hamming(a, b) <= may_differ(F.col(f"{a}.size"), F.col(f"{b}.size"))
    roots, _ = bucket_links(members, verified, bands.alike, "parity", sketches=sketches.select("c", *words), near=near)
    rooted = classes.select("c", "first_id").join(roots.withColumnRenamed("node", "c"), "c", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "c")), "parity-rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    placed = rooted.join(least, "root").select("c", "component_id")
    return signed.select("doc_id", "c", "size").join(placed, "c", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT r, array_to_string(w[i : i + 2], ' ') AS g
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
  n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
  f AS (SELECT s.r, s.g, n.n, row_number() OVER (PARTITION BY s.r ORDER BY c.c, s.g) AS k
    FROM s JOIN n USING (r) JOIN (SELECT g, count(*) AS c FROM s GROUP BY g) c USING (g)),
  p AS (SELECT DISTINCT a.r AS x, b.r AS y FROM f a JOIN f b ON a.g = b.g AND a.r < b.r
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) AND a.k <= a.n - ceil(0.9 * a.n) + 1 AND b.k <= b.n - ceil(0.9 * b.n) + 1),
  o AS (SELECT p.x, p.y, count(*) AS i FROM p JOIN s a ON a.r = p.x JOIN s b ON b.r = p.y AND b.g = a.g GROUP BY ALL),
  l AS (SELECT x, y FROM o JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * i >= 90 * (a.n + b.n - i)),
  e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
  t AS (SELECT r AS x, r AS y FROM d UNION SELECT t.x, e.y FROM t JOIN e ON e.x = t.y)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(c.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN t ON t.x = d.r JOIN d c ON c.r = t.y GROUP BY d.r, d.doc_id, n.n
"""
