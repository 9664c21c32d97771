"""Toxicity by a convolutional text classifier, trained in numpy.

Words (small letters, no punctuation at the ends) are hashed to embeddings; filters of several widths run over the
whole text, each keeps its largest response (max pooling), and a logistic layer reads those. Trained by
gradient steps on a bounded sample of labelled rows; a part of the sample calibrates the scores (a logistic
map onto the share of toxic rows). Thresholds are picked on all labelled rows that are not held out, from counts
by language, score bin and label: one for all languages, and one for each language with both labels and
``least_language_rows`` rows.

A filter's response is a sum over its words, and a word's share does not depend on its neighbours. So each word's
shares are computed once per word of the vocabulary, and a text is scored by look-ups, sums and maxima, in
blocks, however long it is. Only these tables (``BUCKETS`` x 6 x filters) are broadcast.

Scores depend on the text alone. Language thresholds decide the extra column ``flagged`` only.

Defined results: a NULL or empty text gets the score of a text without words. Labels of 0 and 1 count, others
and NULL do not. Without labels of both kinds every score is the share of toxic labels (0.5 without labels).
A row without doc_id is not held out and not learned from. Repeated rows are scored each.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import hold, map_arrow, stored, table

BUCKETS = 1 << 16
DIM, FILTERS, WIDTHS = 16, 12, (1, 2, 3)  # FILTERS of each width, at most DIM
CACHED = 400_000
BINS = 1000  # of the scores, for the thresholds
_PUNCTUATION = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum()) + "…“”‘’«»¿¡–—"


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample and of the training.

    most_toxic, most_clean: rows of either label, those with the smallest hash of their id. most_words: longest
    text that is learned from. least_texts: words of fewer sample texts count as unknown.
    """

    most_toxic: int = 2500
    most_clean: int = 5000
    most_words: int = 5000
    least_texts: int = 5
    epochs: int = 12
    batch: int = 32
    rate: float = 0.3
    decay: float = 3e-3
    seed: int = 17
    calibration_share: float = 0.25
    least_language_rows: int = 40


class WordBuckets(dict):
    """Bucket of a chunk of text, 0 if no word is left of it; bounded."""

    def __missing__(self, chunk: str) -> int:
        word = chunk.lower().strip(_PUNCTUATION)
        bucket = zlib.crc32(word.encode()) % (BUCKETS - 1) + 1 if word else 0
        if len(self) >= CACHED:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = bucket
        return bucket


_buckets = WordBuckets()


def buckets(text: str | None) -> np.ndarray:
    """Buckets of a text's words, with as many unknown ones at the end as the widest filter needs."""
    chunks = (text or "").split()
    found = np.fromiter(map(_buckets.__getitem__, chunks), np.int64, len(chunks))
    return np.concatenate([found[found > 0], np.zeros(max(WIDTHS) - 1, np.int64)])


@dataclass
class Model:
    """Tables of the words' shares, per width and place, and the logistic layer with its calibration."""

    shares: dict[tuple[int, int], np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def pooled(self, words: np.ndarray, block: int = 8192) -> np.ndarray:
        """Largest response of each filter over the whole text."""
        best = np.full(len(self.bias), -np.inf, np.float32)
        for at in range(0, len(words) - max(WIDTHS) + 1, block):
            part = words[at:at + block + max(WIDTHS) - 1]
            n = len(part) - max(WIDTHS) + 1
            for k, width in enumerate(WIDTHS):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                total = self.shares[width, 0][part[:n]]
                for j in range(1, width):
                    total = total + self.shares[width, j][part[j:n + j]]
                np.maximum(best[own], total.max(axis=0), out=best[own])
        return np.maximum(np.where(np.isfinite(best), best, 0) + self.bias, 0)

    def raw(self, text: str | None) -> float:
        return float(self.pooled(buckets(text)) @ self.weights + self.intercept)

    def score(self, text: str | None) -> float:
        value = self.slope * self.raw(text) + self.shift
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def _step(model: dict, texts: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, rate: float,
          decay: float) -> None:
    """One gradient step on a batch; only the words that win a maximum get a gradient."""
    emb, kernels, bias, out = model["emb"], model["kernels"], model["bias"], model["out"]
    rows = []
    for words in texts:
        vectors = emb[words]
        pooled, places = [], []
        for width, kernel in zip(WIDTHS, kernels):
            n = len(words) - max(WIDTHS) + 1
            response = sum(vectors[j:n + j] @ kernel[j] for j in range(width))
            place = response.argmax(axis=0)
            places.append(place)
            pooled.append(response[place, np.arange(FILTERS)])
        rows.append((words, places, np.concatenate(pooled) + bias))
    hidden = np.maximum(np.stack([r[2] for r in rows]), 0)
    chance = 1 / (1 + np.exp(-np.clip(hidden @ out + model["intercept"], -30, 30)))
    error = (chance - toxic) * weight / len(texts)
    to_hidden = error[:, None] * out * (hidden > 0)
    grads = [np.zeros_like(k) for k in kernels]
    moved: dict[int, np.ndarray] = {}
    for (words, places, _), back in zip(rows, to_hidden):
        for k, (width, kernel) in enumerate(zip(WIDTHS, kernels)):
            own = back[k * FILTERS:(k + 1) * FILTERS]
            for f in np.flatnonzero(own):
                for j in range(width):
                    word = int(words[places[k][f] + j])
                    grads[k][j, :, f] += own[f] * emb[word]
                    if word:
                        moved[word] = moved.get(word, 0) + own[f] * kernel[j, :, f]
    for word, grad in moved.items():
        emb[word] -= rate * grad + rate * decay * emb[word]
    for kernel, grad in zip(kernels, grads):
        kernel -= rate * (grad + decay * kernel)
    bias -= rate * to_hidden.sum(axis=0)
    model["out"] = out - rate * (hidden.T @ error + decay * out)
    model["intercept"] -= rate * error.sum()


def _word_odds(texts: list[np.ndarray], toxic: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of at least ``least`` texts, and how surely each speaks for a toxic text: its smoothed log odds in
    units of their standard error. The embeddings begin there: a word's odds stand in the dimension that its bucket
    names, so that words that speak for a toxic text meet in different filters and add up after the pooling."""
    seen = np.zeros((2, BUCKETS))
    for words, label in zip(texts, toxic):
        seen[int(label), np.unique(words)] += 1
    total = np.array([(toxic == 0).sum(), (toxic == 1).sum()], np.float64)[:, None]
    logit = np.log((seen + 0.5) / (total - seen + 0.5))
    odds = (logit[1] - logit[0]) / np.sqrt(1 / (seen[0] + 0.5) + 1 / (seen[1] + 0.5))
    known = seen.sum(axis=0) >= least
    known[0] = False
    return known, odds / 2


def _calibrated(raw: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic map of the raw scores, by damped Newton steps with a weak prior."""
    scale = raw.std() or 1.0
    x = np.stack([(raw - raw.mean()) / scale, np.ones_like(raw)], axis=1)
    beta, prior = np.array([1.0, 0.0]), np.diag([0.05, 0.05])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ ((chance - toxic) * weight) + prior @ (beta - np.array([1.0, 0.0]))
        hess = (x * (chance * (1 - chance) * weight)[:, None]).T @ x + prior
        beta = beta - np.linalg.solve(hess, grad)
    slope = max(beta[0], 0.0) / scale
    return float(slope), float(beta[1] - slope * raw.mean())


def _best_threshold(score: np.ndarray, toxic: np.ndarray) -> float:
    """Threshold with the best F1; between two scores, nearest to 0.5 among equals."""
    order = np.argsort(-score, kind="stable")
    hit = np.cumsum(toxic[order])
    f1 = 2 * hit / (np.arange(1, len(hit) + 1) + toxic.sum())
    f1[:-1][score[order][:-1] == score[order][1:]] = -1  # no cut between equal scores
    cuts = np.append((score[order][:-1] + score[order][1:]) / 2, score[order][-1])
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(cuts[best[np.argmin(abs(cuts[best] - 0.5))]])


def _best_cut(counts: np.ndarray) -> float:
    """Threshold with the best F1 at an edge of a bin, nearest to 0.5 among equals. counts: clean and toxic rows by bin."""
    clean, toxic = counts[:, ::-1].cumsum(axis=1)[:, ::-1]  # rows from the bin on
    f1 = 2 * toxic / np.maximum(clean + toxic + counts[1].sum(), 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    cuts = best / BINS
    return float(cuts[np.argmin(abs(cuts - 0.5))])


def train(rows: list[tuple[str, int, str | None]], shares: tuple[float, float],
          how: Training = Training()) -> Model:
    """Model from (text, label, language) rows; ``shares``: how many table rows a clean and a toxic sample row
    stand for."""
    rng = np.random.default_rng(how.seed)
    words = [buckets(t) for t, _, _ in rows]
    toxic = np.array([y for _, y, _ in rows], np.float64)
    n_filters = FILTERS * len(WIDTHS)
    if len(set(toxic)) < 2:
        share = toxic.mean() if len(toxic) else 0.5
        logit = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        empty = {(w, j): np.zeros((BUCKETS, FILTERS), np.float32) for w in WIDTHS for j in range(w)}
        return Model(empty, np.zeros(n_filters), np.zeros(n_filters), logit)
    held = rng.random(len(rows)) < how.calibration_share
    if len(set(toxic[held])) < 2 or len(set(toxic[~held])) < 2:
        held = np.zeros(len(rows), bool)
    fit = np.flatnonzero(~held)
    known, odds = _word_odds([words[i] for i in fit], toxic[fit], how.least_texts)
    words = [np.where(known[w], w, 0) for w in words]
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)) * known[:, None]
    every = np.arange(BUCKETS)
    emb[every, every % FILTERS] = odds * known
    kernels = [rng.normal(0, 0.2 / np.sqrt(w), (w, DIM, FILTERS)) for w in WIDTHS]
    kernels[0][0, :FILTERS] = np.eye(FILTERS)  # each reads the odds of its share of the words
    model = {"emb": emb, "kernels": kernels, "bias": np.zeros(n_filters),
             "out": np.where(np.arange(n_filters) < FILTERS, 0.5, rng.normal(0, 0.2, n_filters)),
             "intercept": -1.0}
    balance = np.where(toxic == 1, 0.5 / max(toxic[fit].mean(), 1e-9), 0.5 / max(1 - toxic[fit].mean(), 1e-9))
    steps = max(how.epochs, -(-how.epochs * 1500 // len(fit)))  # small samples need more rounds
    for epoch in range(min(steps, 10 * how.epochs)):
        order = rng.permutation(fit)
        rate = how.rate * (1 - 0.9 * epoch / min(steps, 10 * how.epochs))
        for at in range(0, len(order), how.batch):
            pick = order[at:at + how.batch]
            _step(model, [words[i] for i in pick], toxic[pick], balance[pick], rate, how.decay)
    tables = {(w, j): (model["emb"] @ k[j]).astype(np.float32)
              for w, k in zip(WIDTHS, model["kernels"]) for j in range(w)}
    result = Model(tables, model["bias"], model["out"], float(model["intercept"]))
    judge = np.flatnonzero(held) if held.any() else fit
    raw = np.array([result.pooled(words[i]) @ result.weights + result.intercept for i in judge])
    weight = np.where(toxic[judge] == 1, shares[1], shares[0])
    result.slope, result.shift = _calibrated(raw, toxic[judge], weight / weight.mean())
    return result


def held_out(doc_id="doc_id"):
    """Whether a row is kept from the learning: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, how: Training = Training()):
    """Labelled rows to learn from, at most ``most_toxic + most_clean``, and how many labels each stands for.

    The rows are chosen from the labels alone; their ids are few by that bound and are broadcast, so texts are
    neither shuffled nor gathered beyond the sample. Chosen texts over ``most_words`` are left out. Of several rows with
    one id, however many, the first text (then language) is taken.
    """
    marked = marked_labels(labels)
    chosen = [marked.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
              for label, most in ((0, how.most_clean), (1, how.most_toxic))]
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    rows = (docs.select("doc_id", "text", "lang").filter("text is not null")
            .join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
            .filter(F.size(F.split("text", " ")) <= how.most_words)
            .groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("row"), F.min("toxic").alias("toxic"))
            .select("doc_id", "row.text", "toxic", "row.lang").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    share = tuple(counts.get(y, 0) / max(1, sum(r["toxic"] == y for r in rows)) for y in (0, 1))
    return [(r["text"], int(r["toxic"]), r["lang"]) for r in rows], share


def marked_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of each document that may be learned from, one row each."""
    return (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
            .groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic")))


def set_thresholds(model: Model, scores: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """Thresholds from all labelled rows of ``scores`` (``doc_id, lang, score``) that are not held out."""
    rows = (scores.filter("doc_id is not null").join(marked_labels(labels), "doc_id")
            .groupBy(F.coalesce("lang", F.lit("")).alias("lang"),
                     F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"), "toxic")
            .count().collect())  # at most 2 x BINS a language
    by: dict[str, np.ndarray] = {}
    for r in rows:
        by.setdefault(r["lang"], np.zeros((2, BINS)))[r["toxic"], r["bin"]] += r["count"]
    total = sum(by.values(), np.zeros((2, BINS)))
    if total.sum(axis=1).all():
        model.threshold = _best_cut(total)
    model.thresholds = {lang: _best_cut(n) for lang, n in sorted(by.items())
                        if n.sum() >= how.least_language_rows and n.sum(axis=1).all()}
    return model


SCORED = "doc_id bigint, lang string, held_out boolean, score double"


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang, held_out, score`` of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        hold(_buckets)
        for batch in batches:
            score = np.array([model.score(t.as_py()) for t in batch.column("text")], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("lang").cast(pa.string()),
                 batch.column("held_out"), pa.array(score)], names=["doc_id", "lang", "held_out", "score"])

    return map_arrow(docs.select("doc_id", "text", "lang", held_out().alias("held_out")), run, SCORED)


def judged(scores: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, threshold, flagged`` of every scored document."""
    cut = F.lit(model.threshold)
    if model.thresholds:
        known = F.create_map(*[F.lit(x) for pair in model.thresholds.items() for x in pair])
        cut = F.coalesce(known[F.coalesce("lang", F.lit(""))], cut)
    return scores.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         cut.alias("threshold"), (F.col("score") >= cut).alias("flagged"))


def classify(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> DataFrame:
    """Train on a sample of the labelled rows that are not held out, pick thresholds on all of them, score all."""
    rows, share = sample(docs, labels, how)
    model = train(rows, share, how)
    scores = stored(scored(docs, model), "toxicity-scores")
    return judged(scores, set_thresholds(model, scores, labels, how))


# ---------------------------------------------------------------- query

def op6_toxicity_cnn(spark, sf_dir) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
