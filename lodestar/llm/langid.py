"""Language identification by mixture inference over n-gram likelihoods.

*Model.* Every letter of every word, with its two neighbours (or the word's
ends), is a character trigram, hashed into ``BUCKETS``. Trigram counts per
language are taken over all learning documents: each task adds up its
documents' counts, and the counts meet in one aggregation. Smoothed
logarithms of the shares are the model: languages x buckets.

*Inference.* A word's likelihood in a language is the product over its
trigrams (words of over 12 letters are cut into runs of 12). Each word of a
document stems from one of the languages, in unknown proportions;
expectation-maximisation estimates these. Then the languages are taken in the
order of their proportions, the mixture is estimated anew for the first one,
two, ... up to all learned languages, and the set with the best penalised
log-likelihood (half the logarithm of the number of words for each further
proportion) is chosen. A document leaves the search when no larger set can
win: no mixture's log-likelihood exceeds that of the shares at hand by more
than the number of words times the logarithm of the largest average of
likelihood over mixed likelihood (Jensen), and the penalty only grows. The
document's language is the one with the largest proportion in the chosen set,
and that proportion is the score; the set comes with its proportions.

All documents of a block are worked on together in numpy arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.quality import fold
from lodestar.llm.token_count import in_blocks

FOLDS, HELD_OUT = 4, 2
BUCKETS = 1 << 16
RUN = 12
ROUNDS = 12
SMOOTH = 0.5
UNKNOWN = "und"
BLOCK = 1 << 17  # characters worked on together; each takes about 200 bytes of arrays


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Is the code point a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram bucket of each letter, start of a word or run, text) over all texts, one entry per letter."""
    lowered = [(t or "").lower() for t in texts]
    joined = " " + " ".join(lowered) + "  "
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0).astype(np.uint64)
    at = np.flatnonzero(codes)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty, np.zeros(0, bool), empty
    before, here, after = codes[at - 1], codes[at], codes[at + 1]
    mixed = (before * np.uint64(0x9E3779B97F4A7C15) ^ here * np.uint64(0xC2B2AE3D27D4EB4F)
             ^ after * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (mixed >> np.uint64(64 - 16)).astype(np.int64)
    word = before == 0
    first = np.maximum.accumulate(np.where(word, np.arange(len(at)), 0))
    start = (np.arange(len(at)) - first) % RUN == 0
    ends = np.cumsum([len(t) + 1 for t in lowered])
    return bucket, start, np.searchsorted(ends, at - 1, side="right")


def trigram_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all learning documents with a language."""
    learned = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()
                         & (fold(F.col(doc_id), FOLDS) != HELD_OUT))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, part in batch.groupby("lang", sort=False)["text"]:
                total = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                for block in in_blocks(part.tolist(), BLOCK):
                    total += np.bincount(_trigrams(block)[0], minlength=BUCKETS)
        for name, total in sums.items():
            seen = np.flatnonzero(total)
            yield pd.DataFrame({"lang": name, "bucket": seen, "n": total[seen]})

    return (learned.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
            .mapInPandas(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihoods languages x BUCKETS); no language if nothing can be learned."""
    packed = (trigram_counts(docs, doc_id, text, lang).groupBy("lang")
              .agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("found")))  # at most BUCKETS each
    rows = sorted((r["lang"], r["found"]) for r in packed.collect())
    counts = np.zeros((len(rows), BUCKETS))
    for i, (_, found) in enumerate(rows):
        if found:
            buckets, n = zip(*found)
            counts[i, list(buckets)] = n
    logs = np.log(counts + SMOOTH) - np.log(counts.sum(axis=1, keepdims=True) + SMOOTH * BUCKETS)
    return [name for name, _ in rows], logs.astype(np.float32)


def _mix(like: np.ndarray, first: np.ndarray, words: np.ndarray, shares: np.ndarray,
         rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of each document's shares: (shares, log-likelihood).

    like: words x languages, scaled to a largest value of 1 per word; first:
    each document's first word; words: words per document.
    """
    owner = np.repeat(np.arange(len(words)), words)
    for _ in range(rounds):
        each = like * shares[owner]
        total = each.sum(axis=1, keepdims=True)
        each /= np.maximum(total, 1e-300)
        shares = np.add.reduceat(each, first, axis=0) / words[:, None]
    fit = np.log(np.maximum((like * shares[owner]).sum(axis=1), 1e-300))
    return shares, np.add.reduceat(fit, first)


def mixtures(texts: list[str | None], logs: np.ndarray) -> np.ndarray:
    """Proportions of the chosen languages, texts x languages; none for a text without a letter."""
    n = len(logs)
    mixture = np.zeros((len(texts), n))
    bucket, start, owner = _trigrams(texts)
    if not len(bucket) or not n:
        return mixture
    starts = np.flatnonzero(start)
    word = np.add.reduceat(logs.T[bucket], starts, axis=0).astype(np.float64)
    like = np.exp(word - word.max(axis=1, keepdims=True))
    docs, first, words = np.unique(owner[starts], return_index=True, return_counts=True)
    even = np.full((len(docs), n), 1.0 / n)
    whole, whole_fit = _mix(like, first, words, even)
    order = np.argsort(-whole, axis=1, kind="stable")
    # no mixture of any languages fits better than this
    mixed = np.maximum((like * np.repeat(whole, words, axis=0)).sum(axis=1, keepdims=True), 1e-300)
    gain = np.add.reduceat(like / mixed, first, axis=0).max(axis=1) / words
    bound = whole_fit + words * (np.log(np.maximum(gain, 1.0)) + 1e-9)
    chosen, chosen_fit = whole.copy(), np.full(len(docs), -np.inf)
    left = np.arange(len(docs))  # documents for which a larger set can still win
    for k in range(1, n + 1):
        more = bound[left] - 0.5 * (k - 1) * np.log(words[left] + 1) > chosen_fit[left]
        if not more.all():
            like, left = like[np.repeat(more, words[left])], left[more]
        if not len(left):
            break
        some = words[left]
        allowed = np.zeros((len(left), n))
        np.put_along_axis(allowed, order[left, :k], 1.0, axis=1)
        begin = np.maximum(whole[left], 1e-6) * allowed
        shares, fit = _mix(like, np.cumsum(some) - some, some, begin / begin.sum(axis=1, keepdims=True),
                           0 if k == 1 else ROUNDS)
        fit = fit - 0.5 * (k - 1) * np.log(some + 1)
        better = fit > chosen_fit[left]
        chosen[left[better]] = shares[better]
        chosen_fit[left[better]] = fit[better]
    mixture[docs] = chosen
    return mixture


def blockwise(texts: list[str | None], logs: np.ndarray) -> Iterator[np.ndarray]:
    """``mixtures`` of runs of the texts, each of about BLOCK characters."""
    for block in in_blocks(texts, BLOCK):
        yield mixtures(block, logs)


def _main(mixture: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the largest proportion or -1, that proportion) of each row."""
    score = mixture.max(axis=1, initial=0.0)
    return np.where(score > 0, mixture.argmax(axis=1) if mixture.shape[1] else -1, -1), score


def infer(texts: list[str | None], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the language or -1, score) of each text."""
    return _main(mixtures(texts, logs))


def language(text: Column, model: tuple[list[str], np.ndarray]) -> Column:
    """Struct (lang, score, languages) of each whole text.

    ``languages`` lists the chosen set as (lang, share), largest share first.
    ``und``, 0 and no languages if null, without a letter, or nothing was
    learned.
    """
    names, logs = model

    @F.pandas_udf("lang string, score double, languages array<struct<lang string, share double>>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, scores, sets = [], [], []
            for mixture in blockwise([t if isinstance(t, str) else None for t in batch], logs):
                best, score = _main(mixture)
                langs += [names[b] if b >= 0 else UNKNOWN for b in best]
                scores += score.tolist()
                sets += [[{"lang": names[i], "share": float(row[i])} for i in np.argsort(-row, kind="stable") if row[i] > 0]
                         for row in mixture]
            yield pd.DataFrame({"lang": langs, "score": scores, "languages": sets})

    return predict(text)
