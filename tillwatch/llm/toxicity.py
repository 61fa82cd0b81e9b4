"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of three rows of one hashed table: those of the word, its beginning and its ending. Filters one,
two and three words wide run over the text, each keeps its largest answer, and a logistic layer weighs these. Training
takes a bounded sample of labelled documents (TRAIN_ROWS of each label, of TRAIN_WORDS words at most) to the driver; scoring
runs over whole texts in tasks, and keeps a filter's answers only until the text ends.

Where a score counts as toxic is calibrated by language, on documents kept out of the fit: scores are shifted so that each
language's threshold comes to lie at THRESHOLD. The language is guessed from the text's own function words; no column but
the text is an input.

Null text counts as empty. An empty text gets the score of a text in which no filter finds anything. Only labels of 0 or 1
teach; a document with both teaches as 1; documents without an id, and those held out, never teach. Without a single label
of either kind every score is 0. Repeated rows get equal scores, an empty table an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import map_texts, words

#: Bounds of the labelled sample that is fitted in the driver: documents of each label, and words of a document.
TRAIN_ROWS = 2_000
TRAIN_WORDS = 2_000
THRESHOLD = 0.7
BUCKETS = 1 << 18
#: Documents of the sample that a row of the table must occur in; rarer ones teach nothing and stay zero.
LEAST_DOCS = 4
SIZE = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 20
#: Share of words left out of each step at random.
DROPPED = 0.5
BATCH = 64
#: Words whose answers a task remembers.
_REMEMBERED = 200_000
_WORDS = re.compile(r"[^\W\d_]+")

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is was that for with are this be by on at from or not",
    "fr": "le la les des du un une et est en que qui dans pour par sur pas au",
    "de": "der die das und den von mit ist im dem nicht ein eine als auch auf für sich",
    "es": "el los las del y que en un una por con para se al su es no",
}
_LANGUAGES = (*FUNCTION_WORDS, "other")


def text_words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def features(word: str) -> tuple[int, int, int]:
    """Rows of the table: of the word, of its beginning, of its ending."""
    mask = BUCKETS - 1
    return (
        zlib.crc32(word.encode()) & mask, zlib.crc32(f"<{word[:4]}".encode()) & mask, zlib.crc32(f"{word[-4:]}>".encode()) & mask,
    )


_SPOKEN = {word: [lang for lang, own in FUNCTION_WORDS.items() if word in own.split()] for word in
           {word for own in FUNCTION_WORDS.values() for word in own.split()}}


def language(found: Iterable[str]) -> str:
    """The language most of whose function words stand in the text; `other` if none does."""
    votes = dict.fromkeys(_LANGUAGES, 0)
    for word in found:
        for lang in _SPOKEN.get(word, ()):
            votes[lang] += 1
    return max(votes, key=votes.get) if any(votes.values()) else "other"


def _logit(p: float) -> float:
    return float(np.log(p) - np.log1p(-p))


@dataclass
class Model:
    table: np.ndarray           # BUCKETS x SIZE
    filters: np.ndarray         # SIZE x sum(WIDTHS) * FILTERS: for each width and each place in it, FILTERS columns
    filter_bias: np.ndarray     # len(WIDTHS) * FILTERS
    weights: np.ndarray         # len(WIDTHS) * FILTERS
    bias: float
    thresholds: dict[str, float]  # raw answers (logits) at which a text of a language counts as toxic

    def score(self, raw: float, lang: str) -> float:
        shifted = raw - self.thresholds.get(lang, 0.0) + _logit(THRESHOLD)
        return float(1 / (1 + np.exp(-np.clip(shifted, -50, 50))))


def _answers(projected: np.ndarray, rows: int) -> list[np.ndarray]:
    """Per width: each filter's answer at each of the first `rows` places; `projected` has max(WIDTHS) - 1 rows more."""
    found, at = [], 0
    for width in WIDTHS:
        own = projected[:rows, at:at + FILTERS].copy()
        for step in range(1, width):
            first = at + step * FILTERS
            own += projected[step:rows + step, first:first + FILTERS]
        at += width * FILTERS
        found.append(own)
    return found


class Scorer:
    """Raw answers of a model to texts; remembers the answers to the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.width = model.filters.shape[1]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.answers = np.zeros((1024, self.width), np.float32)  # the first row is that of no word
        self.used = 1

    def __call__(self, found: Sequence[str]) -> float:
        known = self.known
        try:
            rows = [known[word] for word in found]
        except KeyError:
            self._learn({word for word in found if word not in known})
            rows = [self.known[word] for word in found]
        peaks = np.full(len(self.model.weights), -np.inf, np.float32)
        pad = max(WIDTHS) - 1
        for start in range(0, max(1, len(rows)), 1 << 16):  # long texts in pieces that overlap by the widest filter
            piece = rows[start:start + (1 << 16) + pad]
            last = start + (1 << 16) >= len(rows)
            projected = self.answers[np.array(piece + [0] * pad if last else piece, np.int64)]
            places = len(projected) - pad
            if places > 0:
                peaks = np.maximum(peaks, np.concatenate([own.max(0) for own in _answers(projected, places)]))
        return float(np.maximum(np.where(np.isfinite(peaks), peaks, 0) + self.model.filter_bias, 0) @ self.model.weights + self.model.bias)

    def _learn(self, new: set[str]) -> None:
        if len(self.known) + len(new) > _REMEMBERED and self.known:
            self._forget()
            # The words of the text at hand are asked for again, all of them.
            raise _Again
        buckets = np.array([features(word) for word in new])
        rows = self.model.table[buckets].sum(1) @ self.model.filters
        until = self.used + len(new)
        if until > len(self.answers):
            grown = np.zeros((max(until, 2 * len(self.answers)), self.width), np.float32)
            grown[:self.used] = self.answers[:self.used]
            self.answers = grown
        self.answers[self.used:until] = rows
        self.known.update(zip(new, range(self.used, until)))
        self.used = until


class _Again(Exception):
    """The memory was emptied; the text has to be answered from the start."""


def raw_answer(scorer: Scorer, found: Sequence[str]) -> float:
    try:
        return scorer(found)
    except _Again:
        return scorer(found)


# Training.

def fit(texts: Sequence[Sequence[str]], labels: Sequence[int], seed: int = 11, epochs: int = EPOCHS) -> Model:
    """A model of labelled word lists; every fifth is left out of the fit and calibrates, with the others, the thresholds."""
    random = np.random.default_rng(seed)
    model = Model(
        random.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32),
        random.normal(0, 0.3, (SIZE, sum(WIDTHS) * FILTERS)).astype(np.float32),
        np.zeros(len(WIDTHS) * FILTERS, np.float32), random.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0, {},
    )
    coded = [np.array([features(word) for word in own], np.int64).reshape(-1, 3) for own in texts]
    labels = np.asarray(labels, np.float32)
    fitted = np.array([at for at in range(len(coded)) if at % 5], np.int64)
    seen = np.zeros(BUCKETS, np.int64)
    for at in fitted:
        seen[np.unique(coded[at])] += 1
    model.table[seen < LEAST_DOCS] = 0
    open_rows = seen >= LEAST_DOCS
    state = [np.zeros_like(own) for own in (model.table, model.filters, model.filter_bias, model.weights)] + [np.zeros(1, np.float32)]
    for epoch in range(epochs):
        random.shuffle(fitted)
        for start in range(0, len(fitted), BATCH):
            batch = fitted[start:start + BATCH]
            # Words left out at random keep single ones from standing for a document.
            shown = [own[random.random(len(own)) >= DROPPED] for own in (coded[at] for at in batch)]
            _step(model, shown, labels[batch], open_rows, state, 0.1 * (1 - epoch / epochs) + 0.01)
    calibrate(model, texts, labels)
    return model


def _step(
    model: Model, batch: list[np.ndarray], labels: np.ndarray, open_rows: np.ndarray, state: list[np.ndarray], rate: float,
) -> None:
    """One step of adaptive gradients on the logistic loss; gradients flow through each filter's largest answer only."""
    pad = max(WIDTHS) - 1
    sizes = np.array([len(own) for own in batch])
    room = np.maximum(sizes, 1) + pad  # an empty text has one place, with no word in reach
    starts = np.cumsum(room) - room
    rows = np.concatenate([np.arange(first, first + n) for first, n in zip(starts, sizes)]) if sizes.sum() else np.zeros(0, int)
    codes = np.concatenate(batch)
    vectors = np.zeros((int(room.sum()) + pad, SIZE), np.float32)
    vectors[rows] = model.table[codes].sum(1)
    answers = np.concatenate(_answers(vectors @ model.filters, len(vectors) - pad), axis=1)
    peak_at = np.stack([first + answers[first:first + max(n, 1)].argmax(0) for first, n in zip(starts, sizes)])
    columns = np.arange(answers.shape[1])
    peaks = answers[peak_at, columns] + model.filter_bias
    active = np.maximum(peaks, 0)
    error = 1 / (1 + np.exp(-np.clip(active @ model.weights + model.bias, -50, 50))) - labels
    error /= len(labels)
    down = (error[:, None] * model.weights) * (peaks > 0)
    d_filters, d_vectors = np.zeros_like(model.filters), np.zeros_like(vectors)
    at = 0
    for nth, width in enumerate(WIDTHS):
        own = slice(nth * FILTERS, (nth + 1) * FILTERS)
        for step in range(width):
            place = slice(at + step * FILTERS, at + (step + 1) * FILTERS)
            where = peak_at[:, own] + step
            d_filters[:, place] = np.einsum("bf,bfd->df", down[:, own], vectors[where])
            np.add.at(d_vectors, where, down[:, own, None] * model.filters[:, place].T[None])
        at += width * FILTERS
    touched = np.flatnonzero(d_vectors[rows].any(1))
    buckets, index = np.unique(codes[touched], return_inverse=True)
    d_table = np.zeros((len(buckets), SIZE), np.float32)
    np.add.at(d_table, index.reshape(-1, 3), d_vectors[rows[touched]][:, None, :])
    d_table *= open_rows[buckets, None]
    state[0][buckets] += d_table * d_table
    model.table[buckets] -= rate * d_table / (np.sqrt(state[0][buckets]) + 1e-6)
    for value, memory, gradient in (
        (model.filters, state[1], d_filters), (model.filter_bias, state[2], down.sum(0)), (model.weights, state[3], active.T @ error),
    ):
        memory += gradient * gradient
        value -= rate * gradient / (np.sqrt(memory) + 1e-6)
    state[4] += error.sum() ** 2
    model.bias -= float(rate * error.sum() / (np.sqrt(state[4][0]) + 1e-6))


def calibrate(model: Model, texts: Sequence[Sequence[str]], labels: np.ndarray, least: int = 10) -> None:
    """Per language, the raw answer with the fewest errors: in the middle of the gap it lies in, all languages' for rare ones."""
    scorer = Scorer(model)
    raw = np.array([raw_answer(scorer, own) for own in texts])
    langs = np.array([language(own) for own in texts])
    # What the fit has not seen counts as much as what it has.
    weight = np.array([4.0 if at % 5 == 0 else 1.0 for at in range(len(texts))])
    whole = _best_cut(raw, labels, weight)
    for lang in _LANGUAGES:
        own = langs == lang
        enough = min((labels[own] == 1).sum(), (labels[own] == 0).sum()) >= least
        model.thresholds[lang] = _best_cut(raw[own], labels[own], weight[own]) if enough else whole


def _best_cut(raw: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    order = np.argsort(raw, kind="stable")
    raw, labels, weight = raw[order], labels[order], weight[order]
    share = weight / np.where(labels == 1, weight[labels == 1].sum() or 1, weight[labels == 0].sum() or 1)
    # Errors of a cut before place i: toxic ones below it, clean ones from it on.
    below = np.concatenate([[0], np.cumsum(np.where(labels == 1, share, 0))])
    above = np.concatenate([np.cumsum(np.where(labels == 0, share, 0)[::-1])[::-1], [0]])
    errors = below + above
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    inner = best[(best > 0) & (best < len(raw))]
    if not len(inner):
        return 0.0
    gaps = raw[inner] - raw[inner - 1]
    at = inner[gaps.argmax()]
    return float((raw[at] + raw[at - 1]) / 2)


# On Spark.

def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept for judging: the checksum of its id leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_words: int = TRAIN_WORDS) -> Model | None:
    """A model of the sample; None if the labels that may teach are all of one kind."""
    known = (
        labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    short = docs.select("doc_id", F.size(words(F.col("text"))).alias("n_words")).filter(F.col("n_words") <= most_words)
    candidates = known.join(short.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = None
    for toxic in (0, 1):
        own = candidates.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = own if chosen is None else chosen.union(own)
    # Two times `rows` ids at most: a broadcast of bounded size spares the texts a shuffle.
    sample = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .filter(F.size(words(F.col("text"))) <= most_words)
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows).collect()
    )
    if len({row["toxic"] for row in sample}) < 2:
        return None
    return fit([text_words(row["text"]) for row in sample], [row["toxic"] for row in sample])


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: doc_id and score, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        scorer = model and Scorer(model)

        def score(text: str | None) -> tuple[float]:
            if model is None:
                return (0.0,)
            found = text_words(text)
            return (model.score(raw_answer(scorer, found), language(found)),)

        return score

    return map_texts(docs, ["doc_id"], "score double", start)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether its label is held out, its score, and whether that counts as toxic."""
    return scored(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
