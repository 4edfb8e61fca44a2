"""URL filter: a bit-parallel wildcard automaton over canonical URLs.

All glob rules are packed into one Shift-And automaton: a bit for each place of each rule, 64 bits to a word. One pass
over a URL moves all rules at once. In a glob `*` stands for any run of characters but `/`, `**` for any run. The
canonical URL is a dot, the host in lower case, and the path; so `*.net/**` holds for net and all its subdomains.

Defined results: a null url or one without `://` has an empty host and an empty path, fits no rule and is allowed.
Repeated rows are judged each. Of several fitting rules the longest wins, of equally long ones the first by name.
Very long urls are read whole. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (verdict, rule as host and path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: The method's own globs, for urls that no rule fits: hosts that name betting, drugs or trackers. Like the path of a
#: rule, `/**` asks for a path; the same glob without it is for urls that have none.
OWN_HOSTS = ("*casino*", "*.free-*", "*.cheap-*", "*pills*", "*-bets.*", "*.ads-*", "*-track.*")
OWN_GLOBS = tuple(host + path for host in OWN_HOSTS for path in ("/**", ""))
#: Characters of all urls stepped through at once.
CELLS = 1 << 22


def rule_glob(rule: str) -> str:
    """The glob of a host-and-path rule: the host and its subdomains, paths that start like the rule's."""
    return f"*.{rule}**"


@dataclass(frozen=True)
class Automaton:
    """Bit masks of all globs: `steps[byte]` moves on, `stays[byte]` remains on a wildcard."""

    steps: np.ndarray
    stays: np.ndarray
    first: np.ndarray
    last: np.ndarray  # (glob, word): its accepting bit


def compile_globs(globs: list[str]) -> Automaton:
    """Each glob takes a start bit and a bit for each literal byte; wildcards are loops on the bit before them."""
    places, starts, ends, loops = [], [], [], {}
    for glob in globs:
        starts.append(len(places))
        places.append(None)
        for token in re.findall(r"\*\*|\*|[^*]+", glob):
            if token[0] == "*":
                at = len(places) - 1
                loops[at] = max(loops.get(at, 0), len(token))
            else:
                places.extend(token.encode())
        ends.append(len(places) - 1)
    words = max(1, -(-len(places) // 64))
    steps, stays = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
    bit = lambda i: (i // 64, np.uint64(1) << np.uint64(i % 64))
    for i, byte in enumerate(places):
        if byte is not None:
            word, mask = bit(i)
            steps[byte, word] |= mask
    for i, kind in loops.items():
        word, mask = bit(i)
        stays[:, word] |= mask
        if kind == 1:
            stays[ord("/"), word] &= ~mask
    first, last = np.zeros(words, np.uint64), np.zeros((len(globs), words), np.uint64)
    for n, (i, j) in enumerate(zip(starts, ends)):
        word, mask = bit(i)
        first[word] |= mask
        word, mask = bit(j)
        last[n, word] |= mask
    return Automaton(steps, stays, first, last)


def matches(automaton: Automaton, texts: list[bytes]) -> np.ndarray:
    """(text, glob): whether the glob fits the whole text."""
    count, words = len(texts), automaton.first.shape[0]
    out = np.zeros((count, automaton.last.shape[0]), bool)
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    begin = 0
    while begin < count:
        # Urls of similar length side by side, longest first, so that a long one doesn't widen all.
        stop = min(count, begin + max(1, CELLS // max(1, int(lengths[order[begin]]))))
        rows = order[begin:stop]
        size = lengths[rows]
        grid = np.zeros((len(rows), int(size[0])), np.uint8)
        grid[np.arange(grid.shape[1]) < size[:, None]] = np.frombuffer(b"".join(texts[r] for r in rows), np.uint8)
        state = np.repeat(automaton.first[None, :], len(rows), axis=0)
        for at in range(grid.shape[1]):
            live = int(np.searchsorted(-size, -at, side="left"))  # texts longer than `at`
            byte, now = grid[:live, at], state[:live]
            moved = now << np.uint64(1)
            if words > 1:
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & automaton.steps[byte]) | (now & automaton.stays[byte])
        out[rows] = (state[:, None, :] & automaton.last[None, :, :]).any(axis=2)
        begin = stop
    return out


def _judge(rules: list[tuple[str, str]], own: list[str]):
    ranked = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    automaton = compile_globs([rule_glob(r) for _, r in ranked] + own)
    schema = pa.schema(
        [("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            fits = matches(automaton, [f".{h}{p}".encode() for h, p in zip(hosts, paths)])
            by_rule = fits[:, : len(ranked)]
            chosen = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1), -1).tolist()
            spam = fits[:, len(ranked) :].any(axis=1).tolist()
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("host"),
                    batch.column("path"),
                    pa.array([ranked[i][1] if i >= 0 else None for i in chosen], pa.string()),
                    pa.array([ranked[i][0] if i >= 0 else "block" if s else "allow" for i, s in zip(chosen, spam)], pa.string()),
                ],
                schema=schema,
            )

    return run


def judge_urls(pages: DataFrame, rules=RULES, own_globs=OWN_GLOBS) -> DataFrame:
    """page_id, host, path, the rule that fits best (or null) and the verdict."""
    after = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(
        F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    canonical = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        host.alias("host"),
        F.regexp_extract(after, r"(?s)^[^/?#]*(/[^?#]*)", 1).alias("path"),
    )
    return canonical.mapInArrow(
        _judge(list(rules), list(own_globs)), "page_id bigint, host string, path string, rule string, verdict string"
    )


#: The same verdicts in SQL; the own globs are written as patterns on ".host/".
ORACLE = r"""
SELECT page_id, host, path, rule,
  CASE rule WHEN 'net/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'example.com/de/' THEN 'block'
    WHEN 'org/fr/' THEN 'allow' ELSE CASE WHEN regexp_matches('.' || host,
    'casino|^.*\.free-|^.*\.cheap-|pills|-bets\.|\.ads-|-track\.') THEN 'block' ELSE 'allow' END END AS verdict
FROM (SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
    FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages)))
"""
