"""Alignment of two tokenizers over the same texts by products of incidence matrices.

Both tokenizers cut the bytes of a text into tokens. A is the incidence of the first one's tokens with the bytes, B that
of the second's; both are CSR matrices built by hand. The rows of A * B-transposed, by Gustavson's row product, hold the
overlap links: pairs of tokens that share bytes, with their number. Offsets at which tokens of both end cut the text
into groups; the same product of the two incidences with groups holds the shared-group links. The tokens of many
documents are laid end to end and multiplied at once, since the end of a document is a cut; products are expanded in
rows of bounded size.

How many documents of the corpus hold a pair of ids linked is counted in two steps: a block of about 2 MiB of text
(a longer document is a block alone) counts its own pairs, one row a pair, and Spark adds the blocks up. The counts go
back the same way, a row for each block and pair, and a block's documents meet them in one co-group, whose size is
bounded by the block. A document keeps its pairs as places in its block's list, so neither texts nor tokens are
shuffled. Vocabularies are sent to the executors, of fixed size. The byte-level one is run by tiktoken on the entries of
the given file, whose ids are also the ranks of its merges: the same tokens in a quarter of the time.

Defined results: a text that is null or empty, or whose tokens' bytes don't give back space+text for either tokenizer,
has no tokens: zeros and an empty digest. Repeated rows are documents of their own. Special tokens' strings in a text
are plain text. Rows without id come back without id. An empty table gives an empty result. Columns beside doc_id and
text are not read.
"""

from __future__ import annotations

import hashlib
import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.tables import stage
from tidemill.llm.text import pieces

BLOCK_BYTES = 2 << 20
#: Fixed value: how the byte-level vocabulary's public pattern cuts a text before merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of a product that are expanded at once; a longer row is expanded alone.
PRODUCT_ENTRIES = 1 << 21


class CSR(NamedTuple):
    """A 0/1 matrix: the columns of row r are col[ptr[r] : ptr[r + 1]]."""

    ptr: np.ndarray
    col: np.ndarray

    def transposed(self, columns: int) -> CSR:
        order = np.argsort(self.col, kind="stable")
        rows = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        return CSR(np.r_[0, np.cumsum(np.bincount(self.col, minlength=columns))], rows[order])


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of sizes[0] numbers, then those from starts[1], and so on."""
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - total + sizes, sizes)


def row_products(left: CSR, right: CSR, columns: int, limit: int = PRODUCT_ENTRIES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """left * right by Gustavson: (row, column, value) of the entries that are not zero, some rows at a time.

    Row i of the product is the sum of the rows of `right` that row i of `left` names.
    """
    widths = np.diff(right.ptr)
    work = np.r_[0, np.cumsum(widths[left.col])][left.ptr]
    rows, start = len(left.ptr) - 1, 0
    while start < rows:
        stop = max(start + 1, int(np.searchsorted(work, work[start] + limit, side="right")) - 1)
        named = left.col[left.ptr[start] : left.ptr[stop]]
        row = np.repeat(np.arange(start, stop), np.diff(left.ptr[start : stop + 1]))
        keys = np.repeat(row, widths[named]) * columns + right.col[ranges(right.ptr[named], widths[named])]
        if (keys[1:] < keys[:-1]).any():
            keys.sort()
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        yield keys[at] // columns, keys[at] % columns, np.diff(np.r_[at, len(keys)])
        start = stop


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes themselves, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


@dataclass(frozen=True)
class Vocabularies:
    """The contents of both tokenizers' files; what is built of them stays in each worker."""

    a_json: str
    b_model: bytes

    @classmethod
    def read(cls, a_path: str | None = None, b_path: str | None = None) -> Vocabularies:
        known = importlib.import_module("public_tokenizers").path if not (a_path and b_path) else None
        a, b = a_path or known("byte_bpe_50k.json"), b_path or known("piece_bpe_32k.model")
        return cls(Path(a).read_text(encoding="utf-8"), Path(b).read_bytes())

    def built(self) -> _Built:
        return _built(self)


class _Built:
    def __init__(self, files: Vocabularies):
        import sentencepiece
        import tiktoken

        byte = _byte_of()
        entries = json.loads(files.a_json)["model"]["vocab"]
        ranks = {bytes(byte[c] for c in entry): i for entry, i in entries.items()}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b_model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for word, i in ranks.items():
            self.a_bytes[i] = word
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    @cached_property
    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))

    @cached_property
    def written(self) -> list[str]:
        """Each id in decimals with what follows it: comma or bar for A, comma or semicolon for B."""
        ends = ((len(self.a_bytes), ","), (len(self.a_bytes), "|"), (len(self.b_bytes), ","), (len(self.b_bytes), ";"))
        return [f"{i}{end}" for size, end in ends for i in range(size)]

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids by A and by B of each text; none where the bytes of either are not those of space+text."""
        none = np.zeros(0, np.int32)
        a, b = [none] * len(texts), [none] * len(texts)
        for i, text in enumerate(texts):
            if not text:
                continue
            x, y, raw = self.a.encode_ordinary(" " + text), self.b.encode(text), (" " + text).encode()
            if b"".join(map(self.a_bytes.__getitem__, x)) == raw == b"".join(map(self.b_bytes.__getitem__, y)):
                a[i], b[i] = np.array(x, np.int32), np.array(y, np.int32)
        return a, b


@lru_cache(maxsize=2)
def _built(files: Vocabularies) -> _Built:
    return _Built(files)


class Aligned:
    """The tokens of some texts laid end to end, and their groups."""

    def __init__(self, built: _Built, texts: list[str | None]):
        a, b = built.encode(texts)
        self.built, self.rows = built, len(texts)
        self.a, self.b = (np.concatenate([*x, np.zeros(0, np.int32)]).astype(np.int64) for x in (a, b))
        self.a_first, self.b_first = (np.r_[0, np.cumsum([len(x) for x in side], dtype=np.int64)] for side in (a, b))
        self.a_ends, self.b_ends = np.cumsum(built.lengths[0][self.a]), np.cumsum(built.lengths[1][self.b])
        self.a_cuts, self.b_cuts = np.isin(self.a_ends, self.b_ends), np.isin(self.b_ends, self.a_ends)
        self.a_group, self.b_group = (np.cumsum(cut) - cut for cut in (self.a_cuts, self.b_cuts))

    @property
    def bytes(self) -> int:
        return int(self.a_ends[-1]) if len(self.a_ends) else 0

    @cached_property
    def groups(self) -> int:
        return int(self.a_cuts.sum())

    def _per_row(self, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(values, dtype=np.int64)][first])

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, shared bytes): the products of the token-byte incidences."""
        a = CSR(np.r_[0, self.a_ends], np.arange(self.bytes))
        b = CSR(np.r_[0, self.b_ends], np.arange(self.bytes))
        return row_products(a, b.transposed(self.bytes), max(1, len(self.b)))

    def group_products(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, 1) of all that share a group: the products of the group incidences."""
        a = CSR(np.arange(len(self.a) + 1), self.a_group)
        b = CSR(np.arange(len(self.b) + 1), self.b_group)
        return row_products(a, b.transposed(self.groups), max(1, len(self.b)))

    @cached_property
    def partners(self) -> np.ndarray:
        """How many B tokens share the group of each A token."""
        return np.bincount(self.b_group, minlength=self.groups)[self.a_group]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, id pair, links) for the distinct linked id pairs of each text; a pair is a_id * size of B + b_id."""
        size = len(self.built.b_bytes)
        every = len(self.built.a_bytes) * size
        row = np.repeat(np.arange(self.rows), np.diff(self.a_first))
        keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j, _ in self.group_products():
            key, n = np.unique(row[i] * every + self.a[i] * size + self.b[j], return_counts=True)
            keys.append(key)
            times.append(n)
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        links = np.bincount(back, np.concatenate(times), minlength=len(key)).astype(np.int64)
        return key // every, key % every, links

    def digests(self) -> list[str]:
        """The SHA-256 of `a1,a2|b1;a3|b2,b3` of each text; without tokens an empty string."""
        size_a, size_b = len(self.built.a_bytes), len(self.built.b_bytes)
        code = np.zeros(len(self.a) + len(self.b), np.int64)
        # A token comes after the A tokens before it and the B tokens of earlier groups, and so on.
        b_before = np.searchsorted(self.b_group, self.a_group, side="left")
        a_until = np.searchsorted(self.a_group, self.b_group, side="right")
        code[np.arange(len(self.a)) + b_before] = self.a + self.a_cuts * size_a
        code[np.arange(len(self.b)) + a_until] = 2 * size_a + self.b + self.b_cuts * size_b
        first, written = self.a_first + self.b_first, self.built.written
        out = []
        for start, stop in zip(first[:-1], first[1:]):
            whole = "".join(map(written.__getitem__, code[start:stop].tolist()))[:-1]
            out.append(hashlib.sha256(whole.encode()).hexdigest() if whole else "")
        return out

    def counts(self) -> dict[str, np.ndarray]:
        overlapping = np.zeros(self.rows, np.int64)
        for i, _, _ in self.overlaps():
            overlapping += np.bincount(np.searchsorted(self.a_first, i, side="right") - 1, minlength=self.rows)
        return {
            "n_a": np.diff(self.a_first),
            "n_b": np.diff(self.b_first),
            "n_groups": self._per_row(self.a_cuts, self.a_first),
            "n_links": self._per_row(self.partners, self.a_first),
            "n_overlaps": overlapping,
        }


def _lists(values: np.ndarray, first: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))


def align(docs: DataFrame, files: Vocabularies | None = None) -> DataFrame:
    """A row for each row of `docs`: its tokens by both, their ends in bytes of space+text, and their links.

    a_ids, a_ends, b_ids, b_ends, group_ends; overlap_a, overlap_b, overlap_bytes name the places of tokens that share
    bytes. Tokens of one group are all linked, so the groups stand for the shared-group links.
    """
    names = ("a_ids", "a_ends", "b_ids", "b_ends", "group_ends", "overlap_a", "overlap_b", "overlap_bytes")
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.list_(pa.int32())) for n in names)])
    shared = docs.sparkSession.sparkContext.broadcast(files or Vocabularies.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = shared.value.built()
        for piece in pieces(batches, "text"):
            one = Aligned(built, piece.column("text").to_pylist())
            i, j, n = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 3, *one.overlaps()))
            begin = np.r_[0, one.a_ends][one.a_first][:-1]  # of each text, where all are laid end to end
            in_a, in_b = np.repeat(np.arange(one.rows), np.diff(one.a_first)), np.repeat(np.arange(one.rows), np.diff(one.b_first))
            links = np.searchsorted(i, one.a_first)
            cuts = np.flatnonzero(one.a_cuts)
            columns = [
                (one.a, one.a_first), (one.a_ends - begin[in_a], one.a_first),
                (one.b, one.b_first), (one.b_ends - begin[in_b], one.b_first),
                ((one.a_ends - begin[in_a])[cuts], np.searchsorted(cuts, one.a_first)),
                (i - one.a_first[in_a[i]], links), (j - one.b_first[in_a[i]], links), (n, links),
            ]
            yield pa.record_batch([piece.column("doc_id"), *(_lists(v, f, pa.int32()) for v, f in columns)], schema=schema)

    ddl = "doc_id bigint, " + ", ".join(f"{n} array<int>" for n in names)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, ddl)


#: What a block writes: a row for each document, with its pairs as places in the block's list, and one with that list.
_BLOCK = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps"))]
    + [("groups_sha256", pa.string()), ("place", pa.list_(pa.int32())), ("links", pa.list_(pa.int32()))]
    + [("pairs", pa.list_(pa.int64())), ("documents", pa.list_(pa.int32()))]
)
_BLOCK_DDL = (
    "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_overlaps bigint, "
    "groups_sha256 string, place array<int>, links array<int>, pairs array<bigint>, documents array<int>"
)


def _blocks(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = shared.value.built()
        block = TaskContext.get().partitionId() << 32
        for piece in pieces(batches, "text", limit=BLOCK_BYTES):
            one = Aligned(built, piece.column("text").to_pylist())
            row, pair, links = one.pairs()
            known, place, documents = np.unique(pair, return_inverse=True, return_counts=True)
            first, rows = np.searchsorted(row, np.arange(one.rows + 1)), one.rows
            none = pa.nulls(rows, pa.list_(pa.int64())), pa.nulls(rows, pa.list_(pa.int32()))
            counts = [pa.array(v) for v in one.counts().values()]
            # Places are kept as differences: small numbers, which files and shuffles compress.
            step = np.diff(place, prepend=0)
            step[first[:-1][first[:-1] < len(place)]] = place[first[:-1][first[:-1] < len(place)]]
            yield pa.record_batch(
                [
                    pa.array(np.full(rows, block)), piece.column("doc_id"), *counts, pa.array(one.digests(), pa.string()),
                    _lists(step, first, pa.int32()), _lists(links, first, pa.int32()), *none,
                ],
                schema=_BLOCK,
            )
            blank = [pa.nulls(1, field.type) for field in _BLOCK][1:10]
            one_list = lambda v, kind: _lists(v, np.array([0, len(v)]), kind)
            yield pa.record_batch([pa.array([block]), *blank, one_list(known, pa.int64()), one_list(documents, pa.int32())], schema=_BLOCK)
            block += 1

    return run


_DIGEST = pa.schema(
    [("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))]
    + [("groups_sha256", pa.string()), ("n_overlaps", pa.int64())]
)
_DIGEST_DDL = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string, n_overlaps bigint"
)


def _resolve(documents: pa.Table, counted: pa.Table) -> pa.Table:
    """The documents of a block with the counts of its pairs, which come in any order."""
    documents = documents.combine_chunks()
    order = np.argsort(counted.column("place").to_numpy())
    count = counted.column("count").to_numpy()[order]
    best = counted.column("best").to_numpy().astype(np.int64)[order]
    column = lambda name: documents.column(name).combine_chunks()
    sizes = np.diff(column("place").offsets.to_numpy())
    step, links = column("place").flatten().to_numpy().astype(np.int64), column("links").flatten().to_numpy().astype(np.int64)
    first = np.r_[0, np.cumsum(sizes)]
    total = np.cumsum(step)
    place = total - np.repeat(np.r_[0, total][first[:-1]], sizes)
    added = lambda v: np.diff(np.r_[0, np.cumsum(v * links)][first])
    made = {"n_best": pa.array(added(best[place])), "count_sum": pa.array(added(count[place]))}
    return pa.table([made[n] if n in made else documents.column(n) for n in _DIGEST.names], schema=_DIGEST)


def pair_counts(pairs: DataFrame, b_size: int) -> DataFrame:
    """pair, count (documents that hold it linked), best (no pair of the same A id has more); `pairs` has pair, documents.

    The pairs of one A id are at most as many as B has ids, which bounds a window.
    """
    counts = pairs.groupBy("pair").agg(F.sum("documents").alias("count"))
    of_a = Window.partitionBy(F.expr(f"pair div {b_size}"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_a))


def digest(docs: DataFrame, files: Vocabularies | None = None) -> DataFrame:
    """A row for each row of `docs`: counts of tokens, groups and links, the links' counts in the corpus, the groups' digest."""
    files = files or Vocabularies.read()
    shared = docs.sparkSession.sparkContext.broadcast(files)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = stage(rows.mapInArrow(_blocks(shared), _BLOCK_DDL), "alignment-blocks")
    listed = blocks.filter("pairs is not null")
    pairs = listed.select("block", F.posexplode(F.arrays_zip("pairs", "documents")).alias("place", "p")).select(
        "block", "place", F.col("p.pairs").alias("pair"), F.col("p.documents").cast("bigint").alias("documents")
    )
    counts = pair_counts(pairs, len(files.built().b_bytes))
    back = pairs.select(F.col("block").alias("of"), "place", "pair").join(counts, "pair").select("of", "place", "count", "best")
    documents = blocks.filter("pairs is null").drop("pairs", "documents")
    return documents.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_resolve, _DIGEST_DDL)
