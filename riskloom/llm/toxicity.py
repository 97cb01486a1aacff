"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are lower-case words without outer punctuation.  Their document counts in
toxic and other training texts give log-odds under Dirichlet priors: the prior
of a token is what its beginning (PREFIX letters, counted by distinct tokens)
says of it, and the prior of a beginning is the share of the classes.  An
estimate is drawn towards zero by its standard error, so rare tokens say little.
A constant drift makes the expected score negative.

A linear scan finds every maximal scoring segment of a text.  With the scores'
distribution in other texts as background, segments follow the extreme-value
law: E = K n exp(-lambda S) segments of score S are expected by chance in n
tokens, where K is how often a token starts a segment, a score above zero.
The best sum over a text's segments (sum statistics) is turned into a
probability on a part of the training rows (one in FOLDS), scanned with a model
that was learned from the others.

Labels come from at most about TRAIN_ROWS labelled rows, chosen by hash; their
ids go to all tasks, and so do the scores of all their tokens, as 16 bytes each,
but for those that score zero as their beginnings do; TRAIN_ROWS bounds them.  Equal words count once in a
candidate passage, that is until the sum of scores is used up or has fallen by ENDS.

Null and empty texts have no tokens and the score of no evidence.  Rows that
repeat a doc_id are scored each; labels that repeat one count as toxic if any
is.  Rows with a null id are not learned from and not held out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored

TRAIN_ROWS = 200_000
PREFIX = 4
# Weight of the beginning's verdict, and of the classes' shares, in documents.
TOKEN_PRIOR, SHARE_PRIOR = 20.0, 2.0
CAUTION = 1.0
DRIFT = 0.7
# A candidate passage ends where its sum has fallen by this much, ten words of no meaning.
ENDS = 10 * DRIFT
EXPECTED = 0.01
# Sums below this many times their number of segments are not large.
LARGE = 3.0
REMEMBERED = 1 << 18
HASH_SEED = 42
# One of this many training rows is kept from the model that the probability is fitted on.
FOLDS = 5
BIN = 0.5
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‘’…¿¡"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, toxic, kept) of the labelled rows to learn from, about ``most`` of them;
    ``kept`` marks those that the probability is fitted on."""
    rows = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = min(1.0, most / max(1, rows.count()))
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    return rows.withColumn("kept", F.pmod(F.xxhash64("doc_id", F.lit("kept")), F.lit(FOLDS)) == 0)


def token_of(word: str) -> str:
    return word.strip(PUNCTUATION)


COUNTS = ("toxic", "other", "kept_toxic", "kept_other")


def token_counts(docs: DataFrame, train: DataFrame) -> DataFrame:
    """(token, toxic, other, kept_toxic, kept_other): documents of each class that have
    the token, and how many of them are kept for the probability."""
    def run(batches):
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic, kept in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "kept"))):
                for token in {token_of(w) for w in set((text or "").lower().split())}:
                    if token:
                        counts = seen.setdefault(token, [0, 0, 0, 0])
                        counts[0 if toxic else 1] += 1
                        if kept:
                            counts[2 if toxic else 3] += 1
                if len(seen) > REMEMBERED:
                    yield from told(seen)
        yield from told(seen)

    def told(seen):
        tokens, counts = list(seen), np.array(list(seen.values()), dtype=np.int64).reshape(-1, 4)
        seen.clear()
        for at in range(0, len(tokens), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[part]), *(pa.array(counts[part, k]) for k in range(4))], ["token", *COUNTS]
            )

    return (
        docs.select("doc_id", "text").join(F.broadcast(train), "doc_id").select("text", "toxic", "kept")
        .mapInArrow(run, ", ".join(["token string", *(f"{c} long" for c in COUNTS)]))
        .groupBy("token").agg(*[F.sum(c).alias(c) for c in COUNTS])
    )


def _cautious(toxic: Column, other: Column, odds: Column) -> Column:
    """Log-odds against the classes' odds, drawn to zero by the standard error."""
    log_odds = F.log(toxic / other) - F.log(odds)
    error = CAUTION * F.sqrt(1 / toxic + 1 / other)
    return F.signum(log_odds) * F.greatest(F.lit(0.0), F.abs(log_odds) - error)


def token_scores(counts: DataFrame, n_toxic: int, n_other: int) -> tuple[DataFrame, DataFrame]:
    """(token, score, begins, other) and (prefix, score, types); ``begins`` is the score
    that the token's beginning gives to tokens without one of their own."""
    begin = F.substring("token", 1, PREFIX)
    share = n_toxic / (n_toxic + n_other)
    types = counts.where(F.length("token") > PREFIX).groupBy(begin.alias("prefix")).agg(
        F.sum((F.col("toxic") > 0).cast("double")).alias("a"), F.sum((F.col("other") > 0).cast("double")).alias("b")
    )
    both = types.agg(F.sum("a").alias("all_a"), F.sum("b").alias("all_b")).first()
    all_a, all_b = (both.all_a or 0) + 1.0, (both.all_b or 0) + 1.0
    type_share = all_a / (all_a + all_b)
    pa_, pb_ = F.col("a") + SHARE_PRIOR * type_share, F.col("b") + SHARE_PRIOR * (1 - type_share)
    prefixes = types.select(
        "prefix", _cautious(pa_, pb_, F.lit(all_a / all_b)).alias("score"),
        # The class share among documents that the beginning's odds stand for.
        (1 / (1 + (pb_ / pa_) * (all_a / all_b) * ((1 - share) / share))).alias("q"),
        (F.col("a") + F.col("b")).alias("types"),
    )
    weight = F.when(F.col("q").isNull(), 0.0).otherwise(F.least(F.lit(TOKEN_PRIOR), F.col("types")))
    q = F.coalesce("q", F.lit(0.0))
    toxic = F.col("toxic") + weight * q + SHARE_PRIOR * share
    other = F.col("other") + weight * (1 - q) + SHARE_PRIOR * (1 - share)
    tokens = (
        counts.withColumn("prefix", F.when(F.length("token") > PREFIX, begin))
        .join(prefixes.select("prefix", "q", "types", F.col("score").alias("begins")), "prefix", "left")
        .select(
            "token", _cautious(toxic, other, F.lit(n_toxic / n_other)).alias("score"),
            F.coalesce("begins", F.lit(0.0)).alias("begins"), "other",
        )
    )
    return tokens, prefixes.select("prefix", "score", "types")


class Table:
    """Scores by hash, as two arrays in the order of the hashes."""

    def __init__(self, tags: np.ndarray, scores: np.ndarray):
        order = np.argsort(tags)
        self.tags, self.scores = tags[order], scores[order]

    def get(self, tag: int) -> float | None:
        at = int(np.searchsorted(self.tags, tag))
        return float(self.scores[at]) if at < len(self.tags) and self.tags[at] == tag else None


def _table(scores: DataFrame, name: str) -> Table:
    """All scores but those zeros that a look-up without result gives as well."""
    rows = scores.where("score <> 0 OR begins <> 0").select(F.xxhash64(name).alias("tag"), "score").toArrow()
    return Table(rows.column("tag").to_numpy(), rows.column("score").to_numpy())


@dataclass(frozen=True)
class Model:
    tokens: Table
    prefixes: Table
    scale: float
    rate: float


def _tag(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), HASH_SEED)
    return value - (1 << 64) if value >> 63 else value


class Scores(dict):
    """Score of a word as it stands in a lower-case text."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        token, score = token_of(word), 0.0
        if token:
            score = self.model.tokens.get(_tag(token))
            if score is None and len(token) > PREFIX:
                score = self.model.prefixes.get(_tag(token[:PREFIX]))
            score = score or 0.0
        self[word] = score = score - DRIFT
        return score

    def of(self, text: str | None) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        words = (text or "").lower().split()
        scores = np.fromiter(map(self.__getitem__, words), dtype=np.float64, count=len(words))
        # A passage repeats its words: in it only the first one of a kind is evidence.
        below = np.concatenate([[0.0], np.cumsum(np.minimum(scores, 0.0))])
        seen: set[str] = set()
        run, top, after = 0.0, 0.0, 0
        for at in np.flatnonzero(scores > 0).tolist():
            run += below[at] - below[after]
            if run <= 0 or run < top - ENDS:
                seen.clear()
                run = top = 0.0
            if words[at] in seen:
                scores[at] = -DRIFT
            seen.add(words[at])
            run += scores[at]
            top, after = max(top, run), at + 1
        return scores


def scale_of(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive lambda with a mean of exp(lambda s) of one under the background."""
    weights = weights / weights.sum()
    low, high = 0.0, 1.0
    mean = lambda x: float((weights * np.exp(x * values)).sum())
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [start, stop) with their scores, in linear time."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    out: list[tuple[int, int, float, float]] = []  # start, stop, sum before, sum after
    links: list[int] = []  # the nearest candidate before with a smaller sum before it
    for at in np.flatnonzero(scores > 0).tolist():
        start, stop, left, right = at, at + 1, total[at], total[at + 1]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= left:
                j = links[j]
            if j < 0 or out[j][3] >= right:
                break
            start, left = out[j][0], out[j][2]
            del out[j:], links[j:]
        out.append((start, stop, left, right))
        links.append(j)
    return [(s, e, r - b) for s, e, b, r in out]


def evidence(segments: list[tuple[int, int, float]], n: int, scale: float, rate: float) -> float:
    """Minus the logarithm of the chance of the best sum of a text's r highest segments.

    The law of the sum T of r segments, T**(r - 1) exp(-T) / (r! (r - 1)!), holds
    for sums that are large for r; others are left out.
    """
    best, total = 0.0, 0.0
    parts = sorted((scale * s - math.log(rate * n) for _, _, s in segments), reverse=True)
    for r, part in enumerate(parts, 1):
        total += part
        if part <= 0 or total < LARGE * r:
            break
        value = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2)
        best = max(best, min(value, total))
    return best


def fit_logistic(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the chance of ``bad`` at x, with a weak ridge on the slope."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    n = good + bad
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        gradient = design.T @ (bad - n * p) - np.array([0.01, 0.001]) * w
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([0.01, 0.001])
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 1e-6), float(w[1])


PASSAGE = "struct<start:int,stop:int,score:double,expected:double>"


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, evidence, passages) of every row; passages are the token
    ranges of the segments that chance would hardly give."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scores = Scores(shared.value)
        scale, rate = shared.value.scale, shared.value.rate
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                values = scores.of(text)
                n = len(values)
                segments = maximal_segments(values) if n and values.max() > 0 else []
                expected = [rate * n * math.exp(-scale * s) for _, _, s in segments]
                passages = [
                    {"start": s, "stop": e, "score": float(v), "expected": x}
                    for (s, e, v), x in zip(segments, expected) if x < EXPECTED
                ]
                rows.append((n, evidence(segments, n, scale, rate), passages))
            n, found, passages = zip(*rows) if rows else ((),) * 3
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(found, pa.float64()), pa.array(passages, kind)],
                ["doc_id", "n_tokens", "evidence", "passages"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, evidence double, passages array<{PASSAGE}>"
    )


def learn(counts: DataFrame, n_toxic: int, n_other: int) -> Model:
    """The model of token counts among so many documents of either class."""
    tokens, prefixes = token_scores(counts, n_toxic + 1, n_other + 1)
    tokens = stored(tokens, "token-scores")
    grid = tokens.groupBy(F.round("score", 1).alias("score")).agg(F.sum("other").alias("n")).collect()
    values = np.array([r.score for r in grid] + [8.0]) - DRIFT
    weights = np.array([float(r.n) for r in grid] + [0.5])
    weights[-1:] += 0.5
    return Model(
        _table(tokens, "token"),
        _table(prefixes.withColumn("begins", F.lit(0.0)), "prefix"),
        scale_of(values, weights),
        float(weights[values > 0].sum() / weights.sum()),
    )


def chance_of(docs: DataFrame, train: DataFrame, model: Model) -> Column:
    """The probability by the evidence, fitted on training rows that ``model`` does not know."""
    kept = train.where("kept").select("doc_id", "toxic")
    # Rows of TRAIN_ROWS / FOLDS ids.
    scanned = scan(docs.select("doc_id", "text").join(F.broadcast(kept.select("doc_id")), "doc_id"), model)
    bins = (
        scanned.join(F.broadcast(kept), "doc_id")
        .groupBy(F.floor(F.col("evidence") / BIN).alias("bin"))
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other")).collect()
    )
    x = np.array([r.bin * BIN for r in bins] or [0.0])
    slope, offset = fit_logistic(
        np.log1p(x), np.array([float(r.other) for r in bins] or [1.0]), np.array([float(r.toxic) for r in bins] or [0.0])
    )
    return 1 / (1 + F.exp(-(F.lit(slope) * F.log1p("evidence") + F.lit(offset))))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_tokens, passages) for every row."""
    train = stored(training_rows(labels), "training-rows")
    sizes = {(r.toxic, r.kept): r["count"] for r in train.groupBy("toxic", "kept").count().collect()}
    toxic, other = (sizes.get((k, False), 0) for k in (1, 0))
    counts = stored(token_counts(docs, train), "token-counts")
    others = counts.select(
        "token", (F.col("toxic") - F.col("kept_toxic")).alias("toxic"), (F.col("other") - F.col("kept_other")).alias("other")
    ).where("toxic + other > 0")
    chance = chance_of(docs, train, learn(others, toxic, other))
    model = learn(counts, toxic + sizes.get((1, True), 0), other + sizes.get((0, True), 0))
    return scan(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), chance.alias("score"),
        (chance >= 0.5).cast("int").alias("predicted"), "n_tokens", "passages",
    )
