"""Mixing to target weights by soft membership.

A classifier learned from the labelled table gives each document a posterior over domains. Nonnegative rates of documents
are fitted so that the expected tokens of each domain, sum(rate * tokens * posterior), match the targets: least squares
on the relative misfits by projected gradient, with a weak pull of every rate towards one that decides among the many
solutions. The gradient is taken in the token-weighted inner product, so a step is one number for each domain, the same
for all documents; steps have momentum, which is dropped whenever the objective would rise, so it never does. Each round
is one aggregate over a narrow staged table. The driver holds the steps, a few numbers each; tasks replay them on their
rows, so no rates are kept between rounds.

Where posteriors are soft or a domain is missing, no nonnegative rates reach the targets, or only extreme ones do. Rounds
end after ROUNDS all the same, and `misfit`, the largest difference between a domain's share of tokens and its target,
tells what was reached. Rates are projected onto LEAST_RATE and more, so no document is lost to a target.

Defined results: null and empty texts have no tokens, the posterior of the priors, and a rate like any other. Repeated
rows count each. Labels are clean (good and not toxic), low (not good) and toxic; without labelled text all documents
are in the first domain. Empty tables give empty results. Columns beside doc_id and text (and doc_id and the labels) are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.tables import held_out, labelled_sample, stage
from tidemill.llm.text import NOT_SPACE, U64, Words, pieces

DOMAINS = ("clean", "low", "toxic")
#: Share of all tokens that each domain should have.
TARGETS = (0.82, 0.12, 0.06)
SAMPLE_ROWS = 6000
BUCKET_BITS = 16
#: Most rounds; the largest change of a rate that ends them sooner; weight of the pull towards one.
ROUNDS, TOLERANCE, PULL = 50, 1e-4, 1e-3
#: The smallest rate: no document leaves the mix because its domain is too common.
LEAST_RATE = 0.02


def domains(labels: DataFrame) -> DataFrame:
    """doc_id and the number of its domain."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    return labels.filter("quality is not null or toxic is not null").select("doc_id", domain.alias("domain"))


def _buckets(words: Words) -> np.ndarray:
    return (words.hashes() >> U64(64 - BUCKET_BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        words = Words(piece.column("text"), NOT_SPACE, lower=True)
        label = piece.column("label").to_numpy().astype(np.int64)
        cells, n = np.unique((label[words.document] << BUCKET_BITS) + _buckets(words), return_counts=True)
        yield pa.record_batch([pa.array(cells), pa.array(n)], names=["cell", "n"])


@dataclass
class Model:
    """Log evidence of each word bucket for each domain, log priors, and the weight of the mean evidence of a text."""

    evidence: np.ndarray
    prior: np.ndarray
    warmth: float

    def means(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each text and the mean evidence of them."""
        words = Words(column, NOT_SPACE, lower=True)
        bucket, row = _buckets(words), words.document
        total = np.stack([np.bincount(row, self.evidence[bucket, k], minlength=len(column)) for k in range(self.evidence.shape[1])], axis=1)
        return words.counts, total / np.maximum(words.counts, 1)[:, None]

    def posterior(self, means: np.ndarray) -> np.ndarray:
        logit = self.warmth * means + self.prior
        out = np.exp(logit - logit.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


@dataclass
class Rates:
    """Steps of the projected gradient, from which the rate of any posterior follows.

    A step is whether momentum is dropped before it, the gradient by domain, and the momentum after it.
    """

    steps: list[tuple[bool, list[float], float]] = field(default_factory=list)
    pull: float = PULL
    weights: np.ndarray | None = None
    smooth: float = 1.0
    shares: np.ndarray | None = None
    misfit: float = 0.0

    def of(self, p: np.ndarray, last: bool = False):
        """The rates of rows of posteriors; with `last` also those before the last step."""
        rate = ahead = before = np.ones(len(p))
        for reset, gradient, momentum in self.steps:
            start = rate if reset else ahead
            before, rate = rate, np.maximum(start - (p @ np.array(gradient) + self.pull * (start - 1)) / self.smooth, LEAST_RATE)
            ahead = rate + momentum * (rate - before)
        return (rate, before) if last else rate

    def measure(self, spark, table: DataFrame, mass: float) -> tuple[np.ndarray, float, float]:
        """Shares of the domains, token-weighted square distance of the rates from one, and their largest change."""
        steps = spark.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    p = batch.column("p").flatten().to_numpy().reshape(batch.num_rows, -1)
                    tokens = batch.column("n_tokens").to_numpy().astype(float)
                    rate, before = steps.value.of(p, last=True)
                    sums = np.r_[(tokens * rate) @ p, tokens @ (rate - 1) ** 2]
                    yield pa.record_batch([pa.array([sums.tolist()]), pa.array([float(np.abs(rate - before).max())])], names=["s", "m"])

        parts = table.mapInArrow(run, "s array<double>, m double")
        kinds = range(len(self.weights) + 1)
        row = parts.agg(*(F.sum(F.get("s", F.lit(k))) for k in kinds), F.max("m")).head()
        steps.unpersist()
        values = np.array([x or 0.0 for x in row], float)
        return values[: len(self.weights)] / mass, values[-2] / mass, values[-1]


def fit_domains(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, count: int = len(DOMAINS)) -> Model:
    """Learn from doc_id and domain; the driver gets a number for each bucket and domain, and some for each sampled row."""
    sample = labelled_sample(labels, "domain", sample_rows)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sample, "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    sums = texts.filter(half).select("label", "text").mapInArrow(_count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    seen = np.zeros((count << BUCKET_BITS,))
    found = sums.toArrow()
    seen[found["cell"].to_numpy()] = found["n"].to_numpy()
    seen = seen.reshape(count, -1).T
    pooled = (seen.sum(axis=1, keepdims=True) + 0.1) / (seen.sum() + 0.1 * len(seen))
    chance = (seen + 20 * pooled) / (seen.sum(axis=0) + 20)
    model = Model(np.log(chance / pooled), np.where(seen.sum(axis=0) > 0, 0.0, -50.0), 1.0)
    if not seen.sum():
        model.prior = np.r_[0.0, np.full(count - 1, -50.0)]
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            x = shared.value.means(piece.column("text"))[1]
            yield pa.record_batch([piece.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["label", "x"])

    rows = texts.filter(~half).select("label", "text").mapInArrow(means, "label int, x array<double>").collect()
    if rows:
        x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows])
        choices = [2.0**i for i in range(-1, 11)]
        losses = []
        for choice in choices:
            model.warmth = choice
            losses.append(-np.log(model.posterior(x)[np.arange(len(y)), y] + 1e-12).mean())
        model.warmth = choices[int(np.argmin(losses))]
    # The sample holds as many rows of each domain; the corpus doesn't.
    known = labels.filter(~held_out()).groupBy("domain").count().collect()
    shares = np.full(count, 1e-9)
    for row in known:
        shares[row.domain] += row["count"]
    model.prior = model.prior + np.log(shares / shares.sum())
    return model


def posteriors(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), rates: Rates | None = None) -> DataFrame:
    """`keep` columns of each row with n_tokens and p, the posterior over domains, and the rate if `rates` is given."""
    from pyspark.sql.pandas.types import to_arrow_type

    shared = docs.sparkSession.sparkContext.broadcast((model, rates))
    kinds = [docs.schema[c].dataType for c in keep]
    fields = [(f"_{i}", to_arrow_type(kind)) for i, kind in enumerate(kinds)]
    schema = pa.schema([*fields, ("n_tokens", pa.int64()), ("p", pa.list_(pa.float64())), ("rate", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text"):
            model, rates = shared.value
            tokens, means = model.means(piece.column("_text"))
            p = model.posterior(means)
            rate = pa.array(rates.of(p)) if rates else pa.nulls(len(p), pa.float64())
            lists = pa.FixedSizeListArray.from_arrays(pa.array(p.reshape(-1)), p.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.record_batch([*(piece.column(c) for c, _ in fields), pa.array(tokens.astype(np.int64)), lists, rate], schema=schema)

    ready = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col("text").alias("_text"))
    ddl = "".join(f"_{i} {kind.simpleString()}, " for i, kind in enumerate(kinds))
    out = ready.mapInArrow(run, ddl + "n_tokens bigint, p array<double>, rate double")
    out = out.withColumnsRenamed({f"_{i}": c for i, c in enumerate(keep)})
    return out if rates else out.drop("rate")


def fit_rates(table: DataFrame, targets=TARGETS, rounds: int = ROUNDS, tolerance: float = TOLERANCE, pull: float = PULL) -> Rates:
    """Projected gradient over a staged table of n_tokens and p; targets are shares of all tokens."""
    wanted = np.array(targets, float) / sum(targets)
    kinds = range(len(wanted))
    p = [F.get("p", F.lit(k)) for k in kinds]
    total = lambda x: F.coalesce(F.sum(x * F.col("n_tokens")), F.lit(0.0))
    first = np.array(table.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("double"), *(total(x) for x in p), *(total(x * y) for x in p for y in p)).head(), float)
    mass, out = first[0], Rates(pull=pull, weights=1 / wanted)
    if not mass:
        return out
    shares, gram = first[1 : len(wanted) + 1] / mass, first[len(wanted) + 1 :].reshape(len(wanted), -1) / mass
    root = np.sqrt(out.weights)
    out.smooth = float(np.linalg.eigvalsh(gram * np.outer(root, root)).max()) + pull
    spark, moment, ahead, reset = table.sparkSession, 1.0, shares, False
    cost = lambda shares, strain: float((out.weights * (shares - wanted) ** 2).sum() + pull * strain)
    best = cost(shares, 0.0)
    for _ in range(rounds):
        following = (1 + np.sqrt(1 + 4 * moment**2)) / 2
        step = (reset, (out.weights * (ahead - wanted)).tolist(), (moment - 1) / following)
        tried = Rates([*out.steps, step], pull, out.weights, out.smooth)
        then, strain, moved = tried.measure(spark, table, mass)
        if cost(then, strain) > best and moment > 1:
            # Momentum has carried too far: the next step starts from the rates themselves.
            moment, ahead, reset = 1.0, shares, True
            continue
        out.steps, best = tried.steps, cost(then, strain)
        ahead, shares, moment, reset = then + step[2] * (then - shares), then, following, False
        if moved < tolerance:
            break
    out.shares, out.misfit = shares, float(np.abs(shares - wanted).max())
    return out


def _rated(table: DataFrame, rates: Rates, key: Column) -> DataFrame:
    """Adds copies, the rate rounded up or down by a hash of the key, so that it holds on average, and the misfit."""
    chance = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1_000_000)) / 1_000_000.0
    copies = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("bigint")
    return table.withColumns({"copies": copies, "misfit": F.lit(rates.misfit)})


def mix_rates(docs: DataFrame, labels: DataFrame, targets=TARGETS, **options) -> DataFrame:
    """doc_id, n_tokens, the posterior of each domain, rate, copies and the misfit of every row."""
    model = fit_domains(docs, domains(labels), **options)
    rates = fit_rates(stage(posteriors(docs, model, keep=()), "mixing-posteriors"), targets)
    rated = _rated(posteriors(docs, model, rates=rates), rates, F.col("doc_id"))
    return rated.select(
        "doc_id", "n_tokens", *(F.get("p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(DOMAINS)), "rate", "copies", "misfit"
    )


def mixed(docs: DataFrame, labels: DataFrame, targets=TARGETS, **options) -> DataFrame:
    """The rows of `docs` with rate, copies and misfit; no row is joined or shuffled."""
    model = fit_domains(docs, domains(labels), **options)
    rates = fit_rates(stage(posteriors(docs, model, keep=()), "mixing-posteriors"), targets)
    rated = _rated(posteriors(docs, model, keep=tuple(docs.columns), rates=rates), rates, F.col("doc_id"))
    return rated.select(*docs.columns, "rate", "copies", "misfit")
