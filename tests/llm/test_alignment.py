"""Tokenizer alignment against plain loops over spans."""

import collections
import hashlib
import importlib
import random

import numpy as np
import pytest

from tidemill.llm import alignment
from tidemill.llm.alignment import CSR


def test_row_products_equal_dense_products():
    rand = np.random.default_rng(1)
    for _ in range(20):
        a, b = (rand.random((7, 9)) < 0.3).astype(int), (rand.random((9, 6)) < 0.4).astype(int)
        left, right = (CSR(np.r_[0, np.cumsum(m.sum(axis=1))], np.nonzero(m)[1]) for m in (a, b))
        back = right.transposed(6)
        for limit in (1, 5, 1000):
            got = np.zeros((7, 6), int)
            for i, j, n in alignment.row_products(left, right, 6, limit):
                got[i, j] += n
            assert (got == a @ b).all()
        dense = np.zeros((6, 9), int)
        dense[np.repeat(np.arange(6), np.diff(back.ptr)), back.col] = 1
        assert (dense == b.T).all()


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    import tokenizers

    path = importlib.import_module("public_tokenizers").path
    a = tokenizers.Tokenizer.from_file(path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))


def spans(tools, text):
    """Token (id, start, end) lists in bytes of space+text by offsets, or None."""
    if not text:
        return None
    a, b = tools
    raw, out = (" " + text).encode(), []
    plain = {}
    for c in range(256):
        plain[c] = chr(c)
    others = [c for c in range(256) if not (33 <= c <= 126 or 161 <= c <= 172 or c >= 174)]
    plain.update({c: chr(256 + i) for i, c in enumerate(others)})
    byte = {s: c for c, s in plain.items()}
    names = {i: s for s, i in a.get_vocab().items()}
    sides = (
        [(i, bytes(byte[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids],
        [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)],
    )
    for side in sides:
        at, tokens = 0, []
        for i, word in side:
            tokens.append((i, at, at + len(word)))
            at += len(word)
        if b"".join(w for _, w in side) != raw:
            return None
        out.append(tokens)
    return out


def grouped(sides):
    cuts = sorted({e for _, _, e in sides[0]} & {e for _, _, e in sides[1]})
    groups, last = [], 0
    for cut in cuts:
        groups.append([[i for i, s, e in side if last <= s and e <= cut] for side in sides])
        last = cut
    return groups


def plainly(tools, rows):
    found = [(n, spans(tools, t)) for n, t in rows]
    held = collections.Counter()
    linked = []
    for _, sides in found:
        links = [(x, y) for a, b in grouped(sides) for x in a for y in b] if sides else []
        linked.append(links)
        held.update(set(links))
    best = collections.defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for (n, sides), links in zip(found, linked):
        if not sides:
            out.append((n, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        groups = grouped(sides)
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        overlaps = sum(1 for _, s, e in sides[0] for _, u, v in sides[1] if s < v and u < e)
        out.append(
            (n, len(sides[0]), len(sides[1]), len(groups), len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links),
             hashlib.sha256(text.encode()).hexdigest(), overlaps)
        )
    return collections.Counter(out)


def texts():
    rand = random.Random(5)
    words = ["the", "alignment", "Überraschung", "naïve", "日本語", "🙂🙃", "x1y2", "tokens", "don't", "C++", "é"]
    rows = [(i, " ".join(rand.choice(words) for _ in range(rand.randint(1, 60)))) for i in range(40)]
    rows += [(i + 50, "".join(rand.choice("ab \n\té日🙂_0") for _ in range(rand.randint(1, 200)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, " "), (103, "▁ marked"), (104, "<s> <|endoftext|> </s> <0x41> <unk>"), (105, "a\x00b")]
    rows += [(106, "word " * 3000), (107, "y" * 20000), (None, "no id"), (108, "same"), (108, "same"), (109, "  two  spaces  "), (110, "﻿bom   nb")]
    return rows


def test_digests_equal_plain_loops(tools, docs_of, monkeypatch):
    rows = texts()
    want = plainly(tools, rows)
    out = alignment.digest(docs_of(rows)).collect()
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
    assert collections.Counter(tuple(r[n] for n in names) for r in out) == want
    assert any(w[1] and w[3] < min(w[1], w[2]) for w in want)  # some groups hold several tokens of both


def test_small_blocks_give_the_same(tools, docs_of, monkeypatch):
    built = alignment.Vocabularies.read().built()
    rows = [(n, t) for n, t in texts() if t and len(t) < 500]
    one = alignment.Aligned(built, [t for _, t in rows])
    row, pair, links = one.pairs()
    monkeypatch.setattr(alignment, "PRODUCT_ENTRIES", 3)
    monkeypatch.setattr(alignment.row_products, "__defaults__", (3,))
    again = alignment.Aligned(built, [t for _, t in rows]).pairs()
    assert all((x == y).all() for x, y in zip((row, pair, links), again))
    assert int(links.sum()) == int(one.counts()["n_links"].sum())


def test_spans_and_links_of_each_text(tools, docs_of):
    rows = [(n, t) for n, t in texts() if t is None or len(t) < 3000]
    for r, (_, text) in zip(alignment.align(docs_of(rows, 1)).collect(), rows):
        sides = spans(tools, text)
        if sides is None:
            assert not r.a_ids and not r.b_ids and not r.group_ends and not r.overlap_a
            continue
        assert [r.a_ids, r.a_ends, r.b_ids, r.b_ends] == [[x[k] for x in side] for side in sides for k in (0, 2)]
        cuts = sorted({e for _, _, e in sides[0]} & {e for _, _, e in sides[1]})
        assert r.group_ends == cuts
        want = [
            (i, j, min(e, v) - max(s, u)) for i, (_, s, e) in enumerate(sides[0]) for j, (_, u, v) in enumerate(sides[1]) if s < v and u < e
        ]
        assert list(zip(r.overlap_a, r.overlap_b, r.overlap_bytes)) == want


def test_no_rows(docs_of):
    assert alignment.digest(docs_of([(1, "a")]).limit(0)).count() == 0
    out = alignment.digest(docs_of([(1, None), (2, "")])).collect()
    assert sorted((r.doc_id, r.n_links, r.groups_sha256) for r in out) == [(1, 0, ""), (2, 0, "")]
