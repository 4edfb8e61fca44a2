"""Language identification by unigram pieces, with all segmentations summed.

A language is a probability of each piece of a fixed public vocabulary. The probability of a word is the sum over all
ways to cut it into pieces, by the forward algorithm; a text's score is the sum of its words' log probabilities. The
piece probabilities are learned by expectation maximisation over word counts of labelled texts: forward and backward
sums give the expected count of each piece. Both passes run as Spark jobs; the driver gets one number for each piece
and language.

Words are runs of letters (all characters over 0x7F count here), in lower case, with the vocabulary's mark of a word's
beginning in front. A character that the vocabulary lacks is the unknown piece. Words are never cut, however long (a
script without spaces has sentences for words): sums are rescaled along the word, so that they stay in range.

Defined results: a text that is null or has no letter is `und` with score 0. The score is the posterior of the predicted
language under equal priors. Ties go to the language that sorts first. Rows without lang, or whose id is null, are not
learned from. Without any labelled text every document is `und` with score 0. Repeated rows count each. Empty tables give
empty results. Columns beside doc_id, text and lang are not read.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.tables import held_out, stage
from tidemill.llm.text import U64, Words, mix, pieces

#: Documents learned from for each language, as an expected number (chosen by a hash of the id).
SAMPLE_ROWS = 1500
ROUNDS = 4
#: Weight of the pooled counts in each language's, and the share every piece keeps.
POOLED, FLOOR = 0.05, 1e-9
#: Pieces longer than this are not used; places between two rescalings; cells of words handled at once.
PIECE_MAX, RESCALE, CELLS = 32, 16, 1 << 17
LETTERS = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b > 0x7F for b in range(256)])
_BASE = U64(0x9E3779B97F4A7C15)
_MARK = "▁"
_TABLE_BITS = 18


def vocabulary(path: str | None = None) -> list[str]:
    """Pieces of a sentencepiece model; the default is the public 32,000-piece one that is installed."""
    import sentencepiece

    path = path or importlib.import_module("public_tokenizers").path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=str(path))
    usual = (i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
    return sorted({model.id_to_piece(i).lower() for i in usual})


@dataclass
class Lattice:
    """Finds the pieces that lie at each place of many words at once. Piece 0 is the unknown character."""

    pieces: list[str]

    def __post_init__(self):
        known = [p for p in self.pieces if 0 < len(p) <= PIECE_MAX]
        self.size = len(known) + 1
        self.longest = max(map(len, known), default=1)
        hashes = np.zeros(len(known), U64)
        for i, piece in enumerate(known):
            value = 0
            for c in piece:
                value = (value * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            hashes[i] = value
        hashes = mix(hashes)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.ids = (order + 1).astype(np.int32)
        # The first place in the sorted hashes for each leading bits: a lookup looks at few places from there.
        self.starts = np.searchsorted(self.hashes >> U64(64 - _TABLE_BITS), np.arange(1 << _TABLE_BITS, dtype=U64)).astype(np.int32)
        fill = np.bincount((self.hashes >> U64(64 - _TABLE_BITS)).astype(np.int64), minlength=1 << _TABLE_BITS)
        self.crowd = int(fill.max(initial=1))

    def find(self, value: np.ndarray) -> np.ndarray:
        """The piece with each hash, or -1."""
        at = self.starts[(value >> U64(64 - _TABLE_BITS)).astype(np.int64)]
        found = np.full(len(value), -1, np.int32)
        for j in range(self.crowd):
            place = np.minimum(at + j, len(self.hashes) - 1)
            hit = self.hashes[place] == value if len(self.hashes) else np.zeros(len(value), bool)
            found[hit] = self.ids[place[hit]]
        return found

    def arcs(self, codes: np.ndarray, lengths: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end place: (start, rows, piece) of the pieces that end there. codes: (words, places), zero beyond."""
        out: list[list] = [[] for _ in range(codes.shape[1] + 1)]
        value = np.zeros(codes.shape, U64)
        single = None
        for size in range(1, min(self.longest, codes.shape[1]) + 1):
            wide = codes.shape[1] - size + 1
            value = value[:, :wide] * _BASE + codes[:, size - 1 : size - 1 + wide].astype(U64) + U64(1)
            inside = lengths[:, None] >= np.arange(size, size + wide)[None, :]
            rows, starts = np.nonzero(inside)
            piece = self.find(mix(value[rows, starts]))
            if size == 1:
                piece = np.maximum(piece, 0)
            good = piece >= 0
            rows, starts, piece = rows[good], starts[good], piece[good]
            order = np.argsort(starts, kind="stable")
            rows, starts, piece = rows[order], starts[order], piece[order]
            cuts = np.searchsorted(starts, np.arange(wide + 1))
            for start in range(wide):
                a, b = cuts[start], cuts[start + 1]
                if b > a:
                    out[start + size].append((start, rows[a:b], piece[a:b]))
        return out


def _chunks(words: list[str]):
    """Words with their mark, shortest first: (places of the words, codes, lengths)."""
    parts = [_MARK + word for word in words]
    lengths = np.array([len(p) for p in parts], np.int64)
    order, begin = np.argsort(lengths, kind="stable"), 0
    while begin < len(order):
        # As many words as fill the cells, all as wide as the longest of them; at least one.
        room = np.arange(1, len(order) - begin + 1) * lengths[order[begin:]] <= CELLS
        chosen = order[begin : begin + max(1, int(room.argmin()) if not room.all() else len(room))]
        begin += len(chosen)
        width = int(lengths[chosen].max())
        codes = np.zeros((len(chosen), width), np.uint32)
        flat = np.frombuffer("".join(parts[i] for i in chosen).encode("utf-32-le"), np.uint32)
        codes[np.arange(width)[None, :] < lengths[chosen][:, None]] = flat
        yield chosen, codes, lengths[chosen]


def _rescale(sums: np.ndarray, logs: np.ndarray, window: slice, now: np.ndarray) -> None:
    """Bring the sums of a window of places near one; `logs` has the logarithm each place is scaled by, `now` the latest."""
    top = sums[window].max(axis=0)
    top[top <= 0] = 1.0
    sums[window] /= top
    now += np.log(top)
    logs[window] = now


def _forward(lattice: Lattice, arcs: list, shape: tuple, chance) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all segmentations up to each place, and the logarithms they are scaled by."""
    sums, logs, now = np.zeros(shape), np.zeros(shape), np.zeros(shape[1:])
    sums[0] = 1.0
    for end in range(1, shape[0]):
        for start, rows, piece in arcs[end]:
            sums[end, rows] += sums[start, rows] * chance(rows, piece)
        logs[end] = now
        if end % RESCALE == 0:
            _rescale(sums, logs, slice(max(0, end - lattice.longest), end + 1), now)
    return sums, logs


def word_scores(lattice: Lattice, chances: np.ndarray, words: list[str]) -> np.ndarray:
    """(word, language): log of the sum over all segmentations. chances: (piece, language)."""
    out = np.zeros((len(words), chances.shape[1]))
    for owner, codes, lengths in _chunks(words):
        shape = (codes.shape[1] + 1, len(owner), chances.shape[1])
        sums, logs = _forward(lattice, lattice.arcs(codes, lengths), shape, lambda rows, piece: chances[piece])
        ends = lengths, np.arange(len(owner))
        out[owner] = np.log(sums[ends]) + logs[ends]
    return out


def expected_counts(lattice: Lattice, chances: np.ndarray, words: list[str], language: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(piece, language): expected uses of each piece, each word under its own language."""
    out = np.zeros_like(chances)
    for owner, codes, lengths in _chunks(words):
        tongue, weight = language[owner], count[owner].astype(np.float64)
        wide, many = codes.shape[1], len(owner)
        arcs = lattice.arcs(codes, lengths)
        chance = lambda rows, piece: chances[piece, tongue[rows]]  # noqa: B023, E731
        forward, ahead = _forward(lattice, arcs, (wide + 1, many), chance)
        backward, behind, now = np.zeros((wide + 1, many)), np.zeros((wide + 1, many)), np.zeros(many)
        backward[lengths, np.arange(many)] = 1.0
        ends = lengths, np.arange(many)
        total = np.log(forward[ends]) + ahead[ends]
        # A place gets its sums from later ones, so a window that is rescaled reaches as far on as a piece can.
        for end in range(wide, 0, -1):
            for start, rows, piece in arcs[end]:
                backward[start, rows] += backward[end, rows] * chance(rows, piece)
            if (wide - end) % RESCALE == RESCALE - 1:
                _rescale(backward, behind, slice(max(0, end - lattice.longest), end + 1), now)
            else:
                behind[max(0, end - lattice.longest) : end + 1] = now
        for end in range(1, wide + 1):
            for start, rows, piece in arcs[end]:
                scale = np.exp(ahead[start, rows] + behind[end, rows] - total[rows])
                np.add.at(out, (piece, tongue[rows]), forward[start, rows] * chance(rows, piece) * backward[end, rows] * scale * weight[rows])
    return out


def _spelled(words: Words, chosen: np.ndarray) -> list[str]:
    raw = words.raw.tobytes()
    return [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(words.starts[chosen].tolist(), words.ends[chosen].tolist())]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word and count of each piece of text."""
    for piece in pieces(batches, "text"):
        langs, code = np.unique(np.array(piece.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
        words = Words(piece.column("text"), LETTERS)
        if not len(words):
            continue
        value, tongue = words.hashes(), code[words.document]
        order = np.lexsort((value, tongue))
        new = np.r_[True, (np.diff(tongue[order]) != 0) | (np.diff(value[order]) != 0)]
        first = np.flatnonzero(new)
        yield pa.record_batch(
            [
                pa.array(langs[tongue[order[first]]].tolist(), pa.string()),
                pa.array(_spelled(words, order[first]), pa.string()),
                pa.array(np.diff(np.r_[first, len(order)])),
            ],
            names=["lang", "word", "n"],
        )


@dataclass
class Model:
    languages: list[str]
    lattice: Lattice
    chances: np.ndarray


def fit(labelled: DataFrame, vocabulary_path: str | None = None, sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> Model:
    """Learn from doc_id, text and lang, by `rounds` passes over the word counts of about `sample_rows` texts a language."""
    spark = labelled.sparkSession
    labelled = labelled.filter("doc_id is not null and lang is not null and text is not null")
    sizes = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    lattice = Lattice(vocabulary(vocabulary_path))
    chances = np.full((lattice.size, max(1, len(languages))), 1.0 / lattice.size)
    if not languages:
        return Model([], lattice, chances)
    share = F.create_map(*(F.lit(x) for n in languages for x in (n, min(1.0, sample_rows / sizes[n]))))
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    counted = chosen.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n bigint")
    # The sample is bounded, so a few files for each core are enough for any corpus.
    files = min(64, 2 * spark.sparkContext.defaultParallelism)
    counted = stage(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).repartition(files, "word"), "language-words")
    shared_lattice = spark.sparkContext.broadcast(lattice)
    place = {n: i for i, n in enumerate(languages)}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(chances)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(shared.value)
            for batch in batches:
                tongue = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
                total += expected_counts(shared_lattice.value, shared.value, batch.column("word").to_pylist(), tongue, batch.column("n").to_numpy())
            piece, tongue = np.nonzero(total)
            yield pa.record_batch([pa.array(piece), pa.array(tongue), pa.array(total[piece, tongue])], names=["piece", "tongue", "n"])

        sums = counted.mapInArrow(expect, "piece bigint, tongue bigint, n double").groupBy("piece", "tongue").agg(F.sum("n").alias("n"))
        totals = np.zeros_like(chances)
        found = sums.toArrow()
        totals[found["piece"].to_numpy(), found["tongue"].to_numpy()] = found["n"].to_numpy()
        pooled = totals.sum(axis=1, keepdims=True)
        own = totals / np.maximum(totals.sum(axis=0), 1e-12)
        chances = (1 - POOLED) * own + POOLED * pooled / max(pooled.sum(), 1e-12) + FLOOR
        chances /= chances.sum(axis=0)
    return Model(languages, lattice, chances)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns of each row with lang_pred and score."""
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [docs.schema[c].dataType for c in keep]
    fields = [(f"_{i}", to_arrow_type(kind)) for i, kind in enumerate(kinds)]
    schema = pa.schema([*fields, ("lang_pred", pa.string()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in pieces(batches, "_text"):
            words = Words(piece.column("_text"), LETTERS)
            _, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
            scores = word_scores(model.lattice, model.chances, _spelled(words, first))
            total = np.zeros((piece.num_rows, model.chances.shape[1]))
            for k in range(total.shape[1]):
                total[:, k] = np.bincount(words.document, scores[inverse, k], minlength=piece.num_rows)
            total -= total.max(axis=1, keepdims=True)
            posterior = np.exp(total)
            posterior /= posterior.sum(axis=1, keepdims=True)
            best = posterior.argmax(axis=1)
            known = np.array(piece.column("_letters").to_pylist(), bool) & bool(model.languages)
            names = [model.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
            score = np.where(known, posterior[np.arange(len(best)), best], 0.0)
            yield pa.record_batch([*(piece.column(c) for c, _ in fields), pa.array(names, pa.string()), pa.array(score)], schema=schema)

    ready = docs.select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)),
        F.col("text").alias("_text"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
    )
    ddl = "".join(f"_{i} {kind.simpleString()}, " for i, kind in enumerate(kinds))
    out = ready.mapInArrow(run, ddl + "lang_pred string, score double")
    return out.withColumnsRenamed({f"_{i}": c for i, c in enumerate(keep)})


def predict(docs: DataFrame, **options) -> DataFrame:
    """Learn from the rows that are not held out, and predict all: doc_id, held_out, lang_pred, score."""
    model = fit(docs.filter(~held_out()), **options)
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
