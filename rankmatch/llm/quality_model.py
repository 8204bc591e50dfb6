"""Quality classifier: supervised subword embeddings.

Every word, pair of neighbouring words and character n-gram of a document is hashed to a row of
one table of learned vectors.  The mean of these vectors goes through a linear layer and a
softmax.  The table and the layer are trained together by stochastic gradient descent in numpy.

The label only ever comes from the rows given for training, and a score depends on the text
alone.  Prediction is the mean of one number per n-gram (its vector times the layer), so it
needs a single look-up per n-gram and runs over whole texts in Arrow batches.

Defined results: a null or empty text has no n-grams and gets the score of the class shares; a
null id, a repeated row and a tie are scored like any other; an empty table gives an empty
result; without a labelled row of each class every score is the share of class 1, or 0.5; a text of
any length is scored whole, in pieces that overlap, so that only a word over a mebibyte counts as several.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmatch.llm.common import (
    Shared,
    WordHashes,
    by_texts,
    column,
    free_name,
    mixed,
    overlapping,
    plain,
    small_batches,
    strings,
    training_rows,
    word_bounds,
)


@dataclass(frozen=True)
class Settings:
    """Parameters of the classifier.

    ``per_class`` and ``max_chars`` bound the training sample: one row each of so many labelled ids of
    either class, chosen by a seeded hash of the id, of at most so many code points.  The shares
    of the classes are counted over all labelled rows.
    """

    bits: int = 16
    dim: int = 8
    char_ngrams: tuple[int, ...] = (3, 4)
    per_class: int = 1500
    max_chars: int = 20_000
    epochs: int = 6
    rate: float = 40.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """What prediction needs: a number per hashed n-gram, and the log-odds of an empty text."""

    settings: Settings
    table: np.ndarray
    bias: float


def features(
    block: np.ndarray, starts: np.ndarray, settings: Settings, hashes: WordHashes, seen: int = 0
) -> Iterator[tuple]:
    """(rows of the table, piece of each) for every kind of n-gram of a block of text.

    N-grams that end within the first ``seen`` bytes are left out: the block before had them.
    """
    shift = np.uint64(64 - settings.bits)
    bounds = np.append(starts, len(block))
    piece = np.repeat(np.arange(len(starts)), np.diff(bounds))
    wide = block.astype(np.uint32)
    for n in settings.char_ngrams:
        if len(block) < n:
            continue
        code = wide[: len(block) - n + 1].copy()
        for i in range(1, n):
            code *= np.uint32(0x01000193)
            code += wide[i : len(block) - n + 1 + i]
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA77 + 2 * n)
        own = piece[: len(code)]
        inside = own == piece[n - 1 :]
        inside[: max(seen - n + 1, 0)] = False
        yield (code >> np.uint32(32 - settings.bits))[inside], own[inside]
    begin, end = word_bounds(block, starts)
    if not len(begin):
        return
    word, own, new = hashes(block, begin, end), piece[begin], end > seen
    yield (mixed(word) >> shift)[new], own[new]
    inside = (own[1:] == own[:-1]) & new[1:]
    pair = mixed(word[1:] + mixed(word[:-1]))[inside]
    yield pair >> shift, own[1:][inside]
    # A word that follows itself is one n-gram whatever the word is.
    same = (word[1:] == word[:-1])[inside]
    yield np.full(int(same.sum()), 1, np.uint64), own[1:][inside][same]


def _reach(settings: Settings) -> int:
    return max([1, *settings.char_ngrams]) - 1


def log_odds(values: pa.Array, model: Model, hashes: WordHashes) -> np.ndarray:
    data, ends = strings(values)
    total, count = np.zeros(len(values)), np.zeros(len(values))
    for block, starts, owners, seen in overlapping(data, ends, reach=_reach(model.settings)):
        for rows, piece in features(block, starts, model.settings, hashes, seen):
            k = len(starts)
            np.add.at(total, owners, np.bincount(piece, model.table[rows], k))
            np.add.at(count, owners, np.bincount(piece, minlength=k))
    return model.bias + total / np.maximum(count, 1)


def _document(text: str, settings: Settings, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of the table that a training text uses, and the share of each."""
    data, ends = strings(pa.array([text]))
    parts = overlapping(data, ends, reach=_reach(settings))
    found = [r for b, s, _, seen in parts for r, _ in features(b, s, settings, hashes, seen)]
    rows, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
    return rows.astype(np.int64), counts / max(counts.sum(), 1)


def fit(texts: list[str], labels: np.ndarray, share: float, settings: Settings) -> Model:
    """Train on a bounded list of texts; ``share`` is the share of class 1 among all labelled rows."""
    size = 1 << settings.bits
    share = min(max(share, 1e-6), 1 - 1e-6)
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return Model(settings, np.zeros(size, np.float32), prior)
    random = np.random.default_rng(settings.seed)
    vectors = random.normal(0, 0.05, (size, settings.dim)).astype(np.float32)
    layer = random.normal(0, 1, (settings.dim, 2)).astype(np.float32)
    offset = np.zeros(2)
    hashes = WordHashes(1 << 16)
    documents = [_document(t, settings, hashes) for t in texts]
    steps, step = settings.epochs * len(documents), 0
    for _ in range(settings.epochs):
        for i in random.permutation(len(documents)):
            rows, weights = documents[i]
            rate = settings.rate * (1 - step / steps)
            step += 1
            mean = weights @ vectors[rows]
            out = mean @ layer + offset
            error = np.exp(out - out.max())
            error = error / error.sum()
            error[int(labels[i])] -= 1
            back = layer @ error
            layer -= (0.001 * rate) * np.outer(mean, error).astype(np.float32)
            offset -= 0.001 * rate * error
            vectors[rows] -= (rate * weights[:, None] * back).astype(np.float32)
    # The sample holds the classes in other shares than the table does.
    taken = labels.mean()
    bias = float(offset[1] - offset[0]) + prior - float(np.log(taken / (1 - taken)))
    return Model(settings, (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), bias)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Fit to the documents that ``labels`` (id, ``label`` 0 or 1) names; see :class:`Settings`."""
    most = (settings.per_class, settings.max_chars, settings.seed)
    return fit(*training_rows(docs, labels, label, *most, id_col, text_col), settings)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``score``: how likely class 1 is, between 0 and 1, for every row of ``docs``."""
    texts = plain(docs, id_col, text_col)
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        hashes = WordHashes(1 << 16)
        for batch in batches:
            odds = log_odds(batch.column(1), shared.value, hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.round(1 / (1 + np.exp(-odds)), 9))], names=["doc_id", "score"]
            )

    return by_texts(texts, run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double")


def keep(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``threshold`` or more."""
    shared = Shared(docs.sparkSession, model)
    helper = free_name(docs.columns, "__text")
    tagged = docs.withColumn(helper, F.coalesce(column(text_col).cast("string"), F.lit("")))

    def run(batches):
        hashes = WordHashes(1 << 16)
        for batch in batches:
            odds = log_odds(batch.column(batch.num_columns - 1), shared.value, hashes)
            good = np.round(1 / (1 + np.exp(-odds)), 9) >= threshold
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(good))

    small_batches(docs.sparkSession)
    return tagged.mapInArrow(run, docs.schema)
