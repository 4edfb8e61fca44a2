"""Benchmark decontamination by winnowing, in DataFrame functions only.

Items and documents keep the smallest `gram`-word hash of every `window - gram + 1` consecutive ones (all places that
attain it). So every run of `window` words that a document shares with an item holds a kept fingerprint, at the same
place in both. Fingerprints meet in an equi-join with the word hashes around them, and each hit is extended to both
sides: at least `window` equal words make the run a leak. An item shorter than a window is one window by itself; its
fingerprint is its smallest word hash, and documents keep those for each such length that occurs (ten at most).

The item side is written first, so the join knows its true size: Catalyst broadcasts it below the session's threshold
and shuffles both sides beyond it. A document sends one row for each kept fingerprint, three for ten words.

Defined results: a null or empty text, or one without words, has no words and no hit. Items without words are left out;
items with equal words count each. Repeated document rows are judged each. Very long texts are read whole. Without
items, or for an empty table, all counts are 0 or the result is empty. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.tables import stage

WINDOW = 10
GRAM = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str | Column) -> Column:
    """Words of letters, digits and all characters over 0x7F, A-Z in lower case."""
    lower = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _BETWEEN, -1), "")


def _upto(n: Column) -> Column:
    """0 .. n - 1; empty if n is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _fold(f, values: list[Column]) -> Column:
    return f(*values) if len(values) > 1 else values[0]


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once for a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fingerprints(h: Column, window: int, gram: int) -> Column:
    """(f, pos, lo, around) of each kept place of the word hashes `h`; `around` are the word hashes from `lo` on."""
    span, reach, n = window - gram + 1, window - gram, F.size(h)
    hashed = lambda i: F.xxhash64(F.lit(window), *(F.get(h, i + j) for j in range(gram)))
    low = lambda p: F.greatest(p - reach, F.lit(0))

    def kept(g: Column) -> Column:
        lowest = F.transform(_upto(n - (window - 1)), lambda i: _fold(F.least, [F.get(g, i + j) for j in range(span)]))
        entry = lambda p: F.struct(
            F.get(g, p).alias("f"),
            p.alias("pos"),
            low(p).alias("lo"),
            F.slice(h, low(p) + 1, F.lit(2 * window - gram)).alias("around"),
        )
        # A place is kept if it equals the minimum of some window of grams around it: the largest of those minima.
        chosen = lambda m: F.filter(
            _upto(n - (gram - 1)), lambda p: _fold(F.greatest, [F.get(m, p - j) for j in range(span)]) == F.get(g, p)
        )
        return F.transform(_let(lowest, chosen), entry)

    return _let(F.transform(_upto(n - (gram - 1)), hashed), kept)


def _kind(window: int, gram: int):
    return lambda h: fingerprints(h, window, gram)


def _word_hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _matched(reach: int, here, there) -> Column:
    """How many of the next `reach` words are equal on both sides, counted outwards."""
    out = F.lit(reach)
    for j in range(reach, 0, -1):
        out = F.when(F.coalesce(here(j) == there(j), F.lit(False)), out).otherwise(j - 1)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Runs of leaked words, and item classes.

    First: row (a number of the document row), doc_id, n_words, and for each hit its class, first and last word; one row
    of each document has a null class. Second: class_id and item_id.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words("text").alias("w"))
    items = items.filter(F.size("w") > 0).withColumn("class_id", F.xxhash64("w", F.lit(1)))
    classes = stage(items.select("class_id", "item_id").distinct(), "leak-classes")
    distinct = items.dropDuplicates(["class_id"]).withColumn("n", F.size("w"))
    shorts = [r.n for r in distinct.filter(F.col("n") < window).select("n").distinct().orderBy("n").collect()]
    kinds = [(window, gram), *((n, 1) for n in shorts)]

    sides = []
    for size, part in kinds:
        own = distinct.filter(F.col("n") >= size) if size == window else distinct.filter(F.col("n") == size)
        marks = _let(_word_hashes(F.col("w")), _kind(size, part))
        sides.append(
            own.select("class_id", F.explode(marks).alias("i")).select(
                "class_id",
                F.lit(size).alias("size"),
                F.lit(part).alias("part"),
                F.col("i.f").alias("f"),
                (F.col("i.pos") - F.col("i.lo")).alias("seed"),
                F.col("i.around").alias("item_around"),
            )
        )
    known = stage(reduce(DataFrame.unionByName, sides), "leak-fingerprints")

    # One entry stands for the document itself and holds its number of words; it fits no fingerprint.
    itself = lambda h: F.array(
        F.struct(
            F.xxhash64("row", F.lit("itself")).alias("f"),
            F.lit(-1).alias("pos"),
            F.size(h).alias("lo"),
            F.array().cast("array<bigint>").alias("around"),
        )
    )
    entries = _let(
        _word_hashes(words("text")), lambda h: F.concat(itself(h), *(_kind(size, part)(h) for size, part in kinds))
    )
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    marks = numbered.select("row", "doc_id", F.explode(entries).alias("d")).select("row", "doc_id", "d.*")
    met = marks.join(known, "f", "left")

    place = F.col("pos") - F.col("lo")
    before = lambda j: (F.get("around", place - j), F.get("item_around", F.col("seed") - j))
    after = lambda j: (
        F.get("around", place + F.col("part") - 1 + j), F.get("item_around", F.col("seed") + F.col("part") - 1 + j)
    )
    reach = window - 1
    left = _matched(reach, lambda j: before(j)[0], lambda j: before(j)[1])
    right = _matched(reach, lambda j: after(j)[0], lambda j: after(j)[1])
    met = met.withColumn("left", left).withColumn("right", right)
    itself_row = F.col("pos") < 0
    hit = F.col("class_id").isNotNull() & (F.col("left") + F.col("right") + F.col("part") >= F.col("size"))
    found = met.filter(itself_row | hit).select(
        "row",
        "doc_id",
        F.when(itself_row, F.col("lo").cast("bigint")).alias("n_words"),
        F.when(~itself_row, F.col("class_id")).alias("class_id"),
        (F.col("pos") - F.col("left")).alias("first"),
        (F.col("pos") + F.col("part") - 1 + F.col("right")).alias("last"),
    )
    return found, classes


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items (ids as sorted strings) and contaminated."""
    found, classes = leaks(docs, benchmark, window, gram)
    found = stage(found, "leak-hits")
    base = found.filter(F.col("class_id").isNull()).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words")
    )
    hits = found.filter(F.col("class_id").isNotNull())
    covered = (
        hits.select("row", F.explode(F.sequence("first", "last")).alias("word"))
        .distinct()
        .groupBy("row")
        .agg(F.count("*").alias("n_hit"))
    )
    items = (
        hits.select("row", "class_id").distinct().join(classes, "class_id").groupBy("row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return base.join(covered, "row", "left").join(items, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def digest(df: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    return df.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % (_UPPER, _LOWER)

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS_SQL} AS w FROM documents),
i AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, k, w[s : s + k - 1] AS win FROM (SELECT item_id, w, least(10, len(w)) AS k,
    unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT row, k, s, w[s : s + k - 1] AS win FROM (SELECT row, w, k, unnest(range(1, len(w) - k + 2)) AS s
    FROM d JOIN ks ON len(w) >= k)),
hit AS (SELECT row, dw.k, s, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
words AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(s, s + k)) AS p FROM hit) GROUP BY row),
items AS (SELECT row, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ','
    ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (row) LEFT JOIN items USING (row)
"""
