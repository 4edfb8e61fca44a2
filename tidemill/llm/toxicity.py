"""Toxicity by noisy-channel deobfuscation.

Tokens that look disguised (a sign or digit beside a letter or another such sign, letters three times in a row, letters
or signs set apart) become a lattice of the letters each character may stand for, with the cost of the disguise on its
arcs; a gap between characters set apart may be a word break. A Viterbi search under a character trigram model finds the
likeliest spelling. Where characters are set apart, the ten letters from each on are read too, as a break may be missed. The trigram model is counted over all documents. The restored
words, with those that need no restoring, are scored: words and beginnings of words that mark toxic texts were learned
from labelled rows, and the three strongest marks of a text go into one logistic unit.

Defined results: a null or empty text has no marks and gets the score of that. Scores don't depend on other rows, so
repeated rows have equal scores. A document with several labels has the largest. Without labels, or with one class only,
every score is the share of toxic labels (0 without any). Ties between spellings go to the one that sorts first. Empty
tables give empty results. Columns beside doc_id and text (and doc_id and the label) are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.language import LETTERS
from tidemill.llm.tables import held_out, labelled_sample
from tidemill.llm.text import LOWER, NOT_SPACE, U64, Words, mix, pieces, random_row, text_buffer

#: Labelled rows of each class learned from (expected), and marks kept of all that are significant.
SAMPLE_ROWS, MARKS = 6000, 50_000
#: Least likelihood ratio statistic of a mark.
SIGNIFICANT = 12.0
PREFIXES = range(3, 11)
#: Characters after which the shared beginning of all paths is written out for the first time.
SETTLE = 256
TOP = 3
#: Restored spellings a Python worker remembers before it starts anew; it bounds memory, not results.
REMEMBERED = 200_000
#: Longer tokens are restored each time they come; it bounds memory, not results.
REMEMBERED_CHARS = 64

# What a sign or digit may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou",
}
DROPPED = "*._-~'`^"

_STANDS, _DROPPED = np.zeros(256, bool), np.zeros(256, bool)
_STANDS[[ord(c) for c in STANDS_FOR]] = True
_DROPPED[[ord(c) for c in DROPPED if c not in STANDS_FOR]] = True
_LEET = _STANDS | _DROPPED
_SYMBOLS = 40
#: Symbol of a byte in the trigram model: letters, twelve classes of others by their last byte, 0 between words, -1 skipped.
_SYMBOL = np.zeros(256, np.int16)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:192] = 27 + np.arange(64) % 12
_SYMBOL[192:] = -1


def _symbol(c: str) -> int:
    if c == " ":
        return 0
    return ord(c) - 96 if "a" <= c <= "z" else 27 + (ord(c) & 0x3F) % 12


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SYMBOLS**3, np.int64)
    for piece in pieces(batches, "text"):
        raw, offsets = text_buffer(piece.column("text"))
        stream = np.insert(_SYMBOL[LOWER[raw]], offsets[:-1], 0)
        stream = stream[stream >= 0].astype(np.int64)
        if len(stream) < 2:
            continue
        before = np.r_[0, stream[:-1]]
        second = np.where(before == 0, 0, np.r_[0, 0, stream[:-2]])
        cells = (second * _SYMBOLS + before) * _SYMBOLS + stream
        total += np.bincount(cells[(stream > 0) | (before > 0)], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["cell", "n"])


def trigram_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities (second last, last, next) counted over all documents; the driver gets 64,000 numbers at most."""
    sums = docs.select("text").mapInArrow(_count_trigrams, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    count = np.zeros(_SYMBOLS**3)
    found = sums.toArrow()
    count[found["cell"].to_numpy()] = found["n"].to_numpy()
    three = count.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    single = (one + 0.5) / (one.sum() + 0.5 * _SYMBOLS)
    pair = (two + 5 * single) / (two.sum(axis=1, keepdims=True) + 5)
    return np.log((three + 5 * pair[None, :, :]) / (three.sum(axis=2, keepdims=True) + 5)).astype(np.float32)


def _lattice(token: str) -> Iterator[list[tuple[str, float]]]:
    i, length = 0, len(token)
    while i < length:
        c = token[i]
        if c == " ":
            i += 1
            yield [("", 0.0), (" ", 0.0)]
            continue
        j = i + 1
        while j < length and token[j] == c:
            j += 1
        run, apart = j - i, False
        if run == 1:
            # The same character set apart three times and more is a run as well, of one word or of two.
            while j + 1 < length and token[j] == " " and token[j + 1] == c:
                j += 2
            apart = j - i > 3
            run, j = ((j - i) // 2 + 1, j) if apart else (1, i + 1)
        i = j
        if c.isalpha():
            once, twice = (c, -3.0 if run == 2 else -0.5), (c + c, -0.05 if run == 2 else -1.0)
            options = [(c, 0.0)] if run == 1 else [once, twice]
            yield [*options, (c + " " + c, -1.0)] if apart else options
            continue
        options = []
        for letter in STANDS_FOR.get(c, ""):
            cost = -0.3 - np.log(len(STANDS_FOR[c]))
            options.append((letter, cost))
            if run > 1:
                options.append((letter * 2, cost - 0.7))
            if apart:
                options.append((letter + " " + letter, cost - 0.7))
        if c in DROPPED or not options or run > 2:
            options.append(("", -0.3))
        else:
            options.append(("", -3.0))
        yield options


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each stretch of the token: the letters it may stand for, and the log cost of it.

    A space in the token is a gap between characters set apart: nothing, or a word break.
    """
    return list(_lattice(token))


def _spell(node: list | None) -> str:
    parts = []
    while node is not None:
        parts.append(node[1])
        node = node[0]
    return "".join(reversed(parts))


def _common(nodes: list) -> tuple[list | None, int]:
    """The last node that all paths share, and the length of the longest path seen behind it."""
    chain, node = [], nodes[0]
    while node is not None:
        chain.append(node)
        node = node[0]
    place = {id(n): k for k, n in enumerate(chain)}
    deepest = 0
    for node in nodes:
        while node is not None and id(node) not in place:
            node = node[0]
        if node is None:
            return None, len(chain)
        deepest = max(deepest, place[id(node)])
    return chain[deepest], deepest


def restore(token: str, model: np.ndarray | list[float]) -> str:
    """The likeliest spelling of a token, by Viterbi over the last two letters.

    A long token is read whole; what all surviving paths share is written out on the way, so memory stays small.
    """
    flat = model if isinstance(model, list) else model.ravel().tolist()
    # State: second last and last symbol. Node: [node before, letters].
    best: dict[int, tuple[float, list | None]] = {0: (0.0, None)}
    done, read, limit = [], 0, SETTLE
    for options in _lattice(token):
        choices = [(letters, [_symbol(c) for c in letters], cost) for letters, cost in options]
        reached: dict = {}
        for state, (value, node) in best.items():
            for letters, symbols, cost in choices:
                total, at = value + cost, state
                for s in symbols:
                    if s:
                        total += flat[at * _SYMBOLS + s]
                        at = at % _SYMBOLS * _SYMBOLS + s
                    elif at:  # a break after a break is none
                        total += flat[at * _SYMBOLS]
                        at = 0
                old = reached.get(at)
                if old is None or total >= old[0]:
                    new = [node, letters] if letters else node
                    if old is None or total > old[0] or _spell(new) < _spell(old[1]):
                        reached[at] = (total, new)
        best = reached
        read += 1
        if read >= limit:
            shared, behind = _common([node for _, node in best.values()])
            if shared is not None:
                done.append(_spell(shared))
                shared[0], shared[1] = None, ""
            read, limit = 0, max(SETTLE, behind)
    ends = [(-(value + flat[at * _SYMBOLS]), _spell(node)) for at, (value, node) in best.items()]
    return "".join(done) + min(ends)[1]


def disguised(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Row and lower-case form of every token that may be a disguised word; characters set apart keep one space between."""
    tokens = Words(column, NOT_SPACE, lower=True)
    raw = tokens.bytes
    rows, texts = [], []
    if len(raw) > 1 and len(tokens):
        letter, sign, any_sign = LETTERS[raw], _STANDS[raw], _LEET[raw]
        core = letter | sign
        marked = np.zeros(len(raw), bool)
        marked[:-1] = any_sign[:-1] & letter[1:] | sign[:-1] & core[1:]
        marked[1:] |= sign[1:] & core[:-1]
        marked[:-2] |= letter[:-2] & (raw[:-2] == raw[1:-1]) & (raw[1:-1] == raw[2:])
        at = np.flatnonzero(marked)
        owner = np.unique(np.searchsorted(tokens.starts, at, side="right") - 1)
        letters, cores = np.r_[0, np.cumsum(letter)], np.r_[0, np.cumsum(core)]
        a, b = tokens.starts[owner], tokens.ends[owner]
        owner = owner[(letters[b] - letters[a] >= 2) | (cores[b] - cores[a] >= 3)]
        data, row_of = raw.tobytes(), np.searchsorted(tokens.first, owner, side="right") - 1
        for row, a, b in zip(row_of.tolist(), tokens.starts[owner].tolist(), tokens.ends[owner].tolist()):
            token = data[a:b].decode("utf-8", "replace").lower()
            # A long token is read in parts between signs that no word holds; nothing of it is left out.
            for part in _parts(token):
                rows.append(row)
                texts.append(part)
        dropped = np.r_[0, np.cumsum(_DROPPED[raw])]
        for kind in (LETTERS, LETTERS | _STANDS):
            for row, a, b in _set_apart(Words(column, kind, lower=True), dropped):
                span = data[a:b].decode("utf-8", "replace").lower()
                signs = "" if kind is LETTERS else STANDS_FOR
                if kind is LETTERS or any(c in STANDS_FOR for c in span):
                    rows.append(row)
                    texts.append(" ".join("".join(c if c.isalpha() or c in signs else " " for c in span).split()))
    return np.array(rows, np.int64), texts


def _set_apart(words: Words, dropped: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Row, start and end of three words of one character and more, close to each other.

    A letter may have two signs beside it; signs that no letter is meant by don't count in a gap.
    """
    if len(words) < 3:
        return
    size, document = words.ends - words.starts, words.document
    letter = LETTERS[words.bytes]
    bytes_before, signs_before = np.r_[0, np.cumsum(letter)], np.r_[0, np.cumsum(~letter)]
    letters_before = np.r_[0, np.cumsum(letter & ((words.bytes < 0x80) | (words.bytes >= 0xC0)))]
    count = lambda before: before[words.ends] - before[words.starts]
    one = (count(letters_before) == 1) & (count(bytes_before) <= 2) & (count(signs_before) <= 2) | (size == 1)
    gap = words.starts[1:] - words.ends[:-1] - (dropped[words.starts[1:]] - dropped[words.ends[:-1]])
    near = one[1:] & one[:-1] & (document[1:] == document[:-1]) & (gap <= 3)
    edges = np.diff(np.r_[False, near, False].astype(np.int8))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    begin, end = begin[end - begin >= 2], end[end - begin >= 2]
    yield from zip(document[begin].tolist(), words.starts[begin].tolist(), words.ends[end].tolist())


def _parts(token: str) -> list[str]:
    parts, now = [], []
    for c in token:
        if c.isalpha() or c in STANDS_FOR or c in DROPPED:
            now.append(c)
        elif now:
            parts.append("".join(now))
            now = []
    parts.append("".join(now))
    return [p for p in parts if any(c.isalpha() for c in p) or sum(c in STANDS_FOR for c in p) >= 3]


def _marks_of(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word number and hash of each mark (the word, its beginnings) of the chosen words."""
    whole = words.hashes()[chosen]
    size, start = (words.ends - words.starts)[chosen], words.starts[chosen]
    numbers, values = [np.arange(len(chosen))], [whole]
    total, row = np.zeros(len(chosen), U64), random_row(max(PREFIXES), 77)
    for j in range(max(PREFIXES)):
        inside = size > j
        part = words.bytes[np.minimum(start + j, max(0, len(words.bytes) - 1))].astype(U64) if len(words.bytes) else total
        total = total + np.where(inside, (part + U64(1)) * row[j], U64(0))
        if j + 1 in PREFIXES:
            at = np.flatnonzero(inside)
            numbers.append(at)
            values.append(mix(total[at] + U64(j + 1)))
    return np.concatenate(numbers), np.concatenate(values)


class _Reader:
    """Distinct words of each row of a piece, restored ones among them."""

    def __init__(self, model: np.ndarray):
        self.model, self.memory = model.ravel().tolist(), {}

    def restored(self, token: str) -> str:
        if len(token) > REMEMBERED_CHARS:
            return restore(token, self.model)
        found = self.memory.get(token)
        if found is None:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            found = self.memory[token] = restore(token, self.model)
        return found

    def readings(self, token: str) -> str:
        """The restored words of a token. Of characters set apart also those that no word break is found before."""
        if " " not in token:
            return self.restored(token)
        joined = self.restored(token.replace(" ", ""))
        inner = [joined[k : k + max(PREFIXES)] for k in range(1, len(joined) - min(PREFIXES) + 1)]
        return " ".join([self.restored(token), joined, *inner])

    def read(self, column: pa.Array) -> list[tuple[np.ndarray, Words]]:
        rows, tokens = disguised(column)
        plain = Words(column, LETTERS, lower=True)
        again = Words(pa.array([self.readings(t) for t in tokens], pa.large_string()), LETTERS, lower=True)
        return [(plain.document, plain), (rows[again.document] if len(rows) else np.zeros(0, np.int64), again)]


def _learn_marks(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model.value)
        for piece in pieces(batches, "text"):
            label = piece.column("label").to_numpy()
            rows, values = [], []
            for row, words in reader.read(piece.column("text")):
                _, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
                number, value = _marks_of(words, first)
                order = np.argsort(number, kind="stable")
                number, value = number[order], value[order]
                begin = np.searchsorted(number, np.arange(len(first) + 1))
                pairs = np.unique(np.stack([row, inverse], axis=1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
                size = (begin[1:] - begin[:-1])[pairs[:, 1]]
                at = np.repeat(begin[pairs[:, 1]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                rows.append(np.repeat(pairs[:, 0], size))
                values.append(value[at])
            row, value = np.concatenate(rows), np.concatenate(values)
            order = np.lexsort((row, value))
            row, value = row[order], value[order]
            new = np.r_[True, (np.diff(row) != 0) | (np.diff(value) != 0)][: len(row)]
            row, value = row[new], value[new]
            marks, inverse = np.unique(value, return_inverse=True)
            n = np.bincount(inverse, minlength=len(marks))
            t = np.bincount(inverse, label[row], minlength=len(marks)).astype(np.int64)
            yield pa.record_batch([pa.array(marks.astype(np.int64)), pa.array(t), pa.array(n)], names=["mark", "t", "n"])

    return run


@dataclass
class Model:
    trigrams: np.ndarray
    marks: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    unit: np.ndarray = field(default_factory=lambda: np.r_[np.zeros(TOP), -30.0])

    def weigh(self, value: np.ndarray) -> np.ndarray:
        if not len(self.marks):
            return np.zeros(len(value))
        at = np.minimum(np.searchsorted(self.marks, value), len(self.marks) - 1)
        return np.where(self.marks[at] == value, self.weights[at], 0.0)

    def features(self, reader: _Reader, column: pa.Array) -> np.ndarray:
        """(row, feature): the strongest marks of distinct words, and one. Clean words of a long text dilute nothing."""
        rows, hashes, values = [], [], []
        out = np.zeros((len(column), TOP + 1))
        out[:, -1] = 1.0
        for row, words in reader.read(column):
            whole = words.hashes()
            known, first, inverse = np.unique(whole, return_index=True, return_inverse=True)
            number, value = _marks_of(words, first)
            weight = np.zeros(len(first))
            np.maximum.at(weight, number, self.weigh(value))
            weight = weight[inverse] if len(first) else np.zeros(0)
            at = np.flatnonzero(weight > 0)
            rows.append(row[at])
            hashes.append(whole[at])
            values.append(weight[at])
        row, value, hashed = np.concatenate(rows), np.concatenate(values), np.concatenate(hashes)
        order = np.lexsort((hashed, -value, row))
        row, value, hashed = row[order], value[order], hashed[order]
        new = np.r_[True, (np.diff(row) != 0) | (np.diff(hashed) != 0)][: len(row)]
        row, value = row[new], value[new]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        good = place < TOP
        out[row[good], place[good]] = value[good]
        return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic unit by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn marks from one half of the sample, the unit from the other; labels of held-out rows aren't used."""
    context = docs.sparkSession.sparkContext
    model = Model(trigram_model(docs))
    sample = labelled_sample(labels.select("doc_id", column), column, sample_rows)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sample, "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    shared = context.broadcast(model.trigrams)
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        share = toxic / max(1, toxic + clean)
        model.unit[-1] = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return model
    halves = {r.label: r["count"] for r in sample.filter(half).groupBy("label").count().collect()}
    toxic, clean = F.lit(float(halves.get(1, 0))), F.lit(float(halves.get(0, 0)))
    counted = texts.filter(half).select("label", "text").mapInArrow(_learn_marks(shared), "mark bigint, t bigint, n bigint")
    counted = counted.groupBy("mark").agg(F.sum("t").cast("double").alias("t"), F.sum("n").cast("double").alias("n"))
    share = toxic / (toxic + clean)
    term = lambda seen, wanted: F.when(seen > 0, seen * F.log(seen / wanted)).otherwise(0.0)
    statistic = 2 * (term(F.col("t"), F.col("n") * share) + term(F.col("n") - F.col("t"), F.col("n") * (1 - share)))
    weight = F.log(((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("n") - F.col("t") + 0.5) / (clean + 1)))
    marks = (
        counted.select("mark", statistic.alias("g"), weight.alias("w"))
        .filter((F.col("g") >= SIGNIFICANT) & (F.col("w") > 0))
        .orderBy(F.desc("g"), "mark")
        .limit(MARKS)
        .collect()
    )
    found = sorted((r.mark & 0xFFFFFFFFFFFFFFFF, r.w) for r in marks)
    model.marks = np.array([m for m, _ in found], U64)
    model.weights = np.array([w for _, w in found])
    learned = context.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(learned.value.trigrams)
        for piece in pieces(batches, "text"):
            x = learned.value.features(reader, piece.column("text"))
            yield pa.record_batch([piece.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["label", "x"])

    rows = texts.filter(~half).select("label", "text").mapInArrow(features, "label int, x array<double>").collect()
    rows.sort(key=lambda r: (r.label, r.x))
    if rows:
        x, y = np.array([r.x for r in rows]), np.array([float(r.label > 0) for r in rows])
        model.unit = _logistic(x, y)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader = _Reader(model.trigrams)
        for piece in pieces(batches, "text"):
            logit = model.features(reader, piece.column("text")) @ model.unit
            value = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
            yield pa.record_batch([piece.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = score(docs, fit(docs, labels, **options))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
