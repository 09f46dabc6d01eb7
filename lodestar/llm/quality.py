"""Quality classifier: supervised subword embeddings.

Each word is a set of hashed features: the word itself and its character
n-grams between word marks; a word that repeats the word before it adds the
features of a marker word. A feature has a learned vector; a document is the
average of its features' vectors, and a softmax over it gives the label. The
vectors and the output layer are trained by stochastic gradient descent in
numpy on a sample of labelled documents of documented size (``SAMPLE``), with
whole texts.

Scoring runs over all documents in Arrow batches. As the output is linear in
the average, each feature's contribution to the two classes' difference is
worked out once (vectors times output layer); a block of texts is hashed and
summed in numpy arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.token_count import in_blocks

SAMPLE = 6000       # labelled documents used for training, at most
BUCKETS = 1 << 17
WIDTH = 16
GRAMS = (2, 3, 4)
STEPS = 12_000      # training steps; a smaller sample is gone through more often
RATE = 0.5
FOLDS, HELD_OUT = 5, 0
CUT = 0.3
BLOCK = 1 << 17     # characters worked on together; each takes about 200 bytes of arrays


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo ``folds`` (null: of the empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds).cast("int")


_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread over the whole value."""
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: the marker word, with as many features of its own as a word of middling length
REPEAT = (_mixed(np.arange(1, 13, dtype=np.uint64) << np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed feature, its text) of all texts, and each text's number of repeated words.

    One entry per word and per character n-gram of a word between its marks;
    words are separated by blanks. All texts are worked on together.
    """
    lined = [" ".join(t.split()) if isinstance(t, str) else "" for t in texts]
    joined = " " + " ".join(lined) + "    "
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    mark = codes == 32
    n = len(codes) - 4
    ends = np.cumsum([len(t) + 1 for t in lined])
    owner = np.searchsorted(ends, np.arange(len(codes)) - 1, side="right")
    at = np.flatnonzero(mark[:n] & ~mark[1:n + 1]) + 1  # first characters of the words
    repeated = np.zeros(len(texts), np.int64)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), repeated
    ids, owners = [], []
    hashed = codes[:n]
    for size in range(2, max(GRAMS) + 1):
        hashed = hashed * np.uint64(0x100000001B3) + codes[size - 1:size - 1 + n]
        if size in GRAMS:  # no mark inside; two marks side by side hold no word
            good = ~mark[:n] | ~mark[1:n + 1] if size == 2 else ~mark[1:n + 1]
            for k in range(2, size - 1):
                good &= ~mark[k:k + n]
            start = np.flatnonzero(good)
            ids.append(_mixed(hashed[start] + np.uint64(size << 58)) % np.uint64(BUCKETS))
            owners.append(owner[start + (mark[start] if size == 2 else 1)])
    inside = np.flatnonzero(~mark)
    first = np.searchsorted(inside, at)
    place = (np.arange(len(inside)) - np.repeat(first, np.diff(np.append(first, len(inside))))).astype(np.uint64)
    words = np.add.reduceat(_mixed(codes[inside] + (place << np.uint64(21))), first)
    ids.append(_mixed(words) % np.uint64(BUCKETS))
    owners.append(owner[at])
    same = (words[1:] == words[:-1]) & (owner[at[1:]] == owner[at[:-1]])
    repeated += np.bincount(owner[at[1:]][same], minlength=len(texts))[:len(texts)]
    return np.concatenate(ids).astype(np.int64), np.concatenate(owners), repeated


class SubwordModel:
    """Feature vectors and output layer, trained on (text, label) pairs."""

    def __init__(self, texts: list[str], labels: list[int], seed: int = 1, steps: int = STEPS):
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
        self.output = np.zeros((2, WIDTH), np.float32)
        self.bias = np.zeros(2, np.float32)
        documents = []
        for text in texts:
            ids, _, repeated = features([text])
            ids, counts = np.unique(np.concatenate([ids, np.repeat(REPEAT, repeated[0])]).astype(np.int32),
                                    return_counts=True)
            documents.append((ids, (counts / max(1, counts.sum())).astype(np.float32)))
        epochs = -(-steps // max(1, len(texts)))
        steps, done = max(1, epochs * len(texts)), 0
        for _ in range(epochs):
            for i in rng.permutation(len(texts)):
                ids, share = documents[i]
                rate = RATE * (1 - done / steps)
                done += 1
                hidden = share @ self.vectors[ids] if len(ids) else np.zeros(WIDTH, np.float32)
                wrong = self._softmax(hidden)
                wrong[labels[i]] -= 1
                back = self.output.T @ wrong
                self.output -= rate * np.outer(wrong, hidden)
                self.bias -= 0.1 * rate * wrong
                if len(ids):
                    # the average's gradient, scaled up as only a few features carry each share
                    self.vectors[ids] -= (rate * np.minimum(1.0, share * len(ids)))[:, None] * back[None, :]

    def _softmax(self, hidden: np.ndarray) -> np.ndarray:
        z = self.output @ hidden + self.bias
        e = np.exp(z - z.max())
        return e / e.sum()

    def weights(self) -> tuple[np.ndarray, float]:
        """Each feature's part in (class 1 - class 0), and the bias' part."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def logits(texts: list[str | None], weights: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds of label 1 for each text: the features' mean weight, and the bias."""
    out = []
    for block in in_blocks(texts, BLOCK):
        ids, owner, repeated = features(block)
        total = np.bincount(owner, weights[ids], minlength=len(block)) + repeated * weights[REPEAT].sum(dtype=np.float64)
        count = np.bincount(owner, minlength=len(block)) + repeated * len(REPEAT)
        out.append(total / np.maximum(count, 1) + bias)
    return np.concatenate(out) if out else np.zeros(0)


def quality_score(text: Column, weights: np.ndarray, bias: float) -> Column:
    """Probability of label 1 for each whole text (null and wordless texts: that of the bias)."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            z = logits([t if isinstance(t, str) else None for t in batch], weights, bias)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return score(text)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id",
          text: str = "text", label: str = "quality") -> tuple[np.ndarray, float]:
    """Model weights from at most ``sample`` labelled documents of the learning folds.

    The sample is the labelled doc_ids with the least hashes. Rows without a
    label, doc_id or text are not learned from; a doc_id with several rows
    counts each. Without any labelled document the model scores 0.5.
    """
    chosen = (labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
              .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & (fold(F.col("_id"), FOLDS) != HELD_OUT))
              .orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample))
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text is not null")
            .join(F.broadcast(chosen), F.col("id") == F.col("_id"))  # at most ``sample`` narrow rows
            .orderBy(F.xxhash64("_id"), "_id", "_label", "text").limit(sample).collect())
    if not rows:
        return np.zeros(BUCKETS, np.float32), 0.0
    return SubwordModel([r["text"] for r in rows], [r["_label"] for r in rows]).weights()


def scored(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the score; row for row, other columns pass through."""
    return docs.withColumn(score, quality_score(F.col(text), *model))
