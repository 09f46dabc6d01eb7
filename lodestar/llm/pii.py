"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns (``base_spans``) give e-mail addresses, IP addresses, card and
phone numbers. They also label the windows of text that the network learns
from; some of these windows are rewritten first (``disguised``), as people
write such data to escape patterns: ``name (at) host dot org``, ``10[.]0[.]0[.]1``,
a phone number without ``+``, a card number with odd separators.

The network reads one class per character in both directions and scores a
tag per character: outside, or one of the kinds. The CRF's transitions tie
neighbouring tags; it is trained by its likelihood (forward-backward) with
Adam, all in numpy.

A text of any length is cut into overlapping windows; those that cannot bear
on a valid span are not read (``learned_spans``). Each is decoded
(Viterbi) on its own and proposes spans with the margin by which the span
beats leaving its characters outside. Pieces of one span that windows cut are
joined, and the set of non-overlapping spans with the greatest total margin is
chosen over the whole text. A span is kept if it is valid for its kind
(digits, Luhn sum, parts) and touches no span of the patterns.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
HIDDEN = 8
WINDOW = 384          # characters of a window
OVERLAP = 64          # shared with the next one; spans cut by a window's edge are joined
BATCH = 512           # windows decoded at once: their gates fit a processor's cache
MARGIN = 4.0          # log odds that a learned span needs
SAMPLE = 20_000       # documents (about, by hash of the id) that training windows are cut from
EXAMPLES = 3_000      # windows with spans, and as many without, that training takes at most
CONTEXT = 40          # characters around a span in a training window
TRAIN_LENGTH, TRAIN_BATCH, STEPS, RATE = 112, 64, 300, 0.02
SLICE = 1 << 20

# A digit run never starts inside another; the rest is as the contract writes it.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = re.compile(r"[0-9]")
AT_WORD, DOT_WORD = re.compile(r"@|\bat\b", re.I), re.compile(r"\.|\bdot\b", re.I)

PAD = 0
SIGNS = "@.-+()[]_%:/,=\"'"


def _class_table() -> np.ndarray:
    """Class of each ASCII character: pad 0, letters a to z, digit, blank, line break, signs, other sign; last: non-ASCII."""
    table = np.full(129, 28 + 2 + len(SIGNS), np.uint8)
    for k in range(26):
        table[97 + k] = table[65 + k] = 1 + k
    table[48:58] = 27
    table[32] = table[9] = 28
    table[10:14] = 29
    for k, sign in enumerate(SIGNS):
        table[ord(sign)] = 30 + k
    table[128] = 28 + 2 + len(SIGNS) + 1
    return table


CLASSES = _class_table()
N_CLASSES = int(CLASSES.max()) + 1
N_TAGS = 1 + len(KINDS)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if k % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[local]+@domain``, in linear time: from each domain back over its local part."""
    out, end = [], 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            end = m.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the pattern matches, by kind, then start; failing matches are dropped."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p) < 4 and int(p) <= 255 or int(p.lstrip("0")[:4] or "0") <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = "".join(DIGITS.findall(m.group()))
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGITS.findall(m.group())) <= 15:
                out.append((3, *m.span()))
    return out


def valid(kind: int, text: str) -> bool:
    """Is a learned span's text of its kind, whatever its separators."""
    digits = "".join(DIGITS.findall(text))
    if kind == 0:
        return bool(AT_WORD.search(text[1:-1]) and DOT_WORD.search(text[1:-1]))
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def classes_of(text: str) -> np.ndarray:
    """Character classes of a whole text (one byte a character)."""
    out = np.empty(len(text), np.uint8)
    for k in range(0, len(text), SLICE):
        points = np.frombuffer(text[k:k + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        out[k:k + SLICE] = CLASSES[np.minimum(points, 128)]
    return out


# ---- training examples ------------------------------------------------------

def disguised(kind: int, text: str, rng: np.random.Generator) -> str:
    """The span's text, written as people write it to escape patterns."""
    def one(*of: str) -> str:
        return of[int(rng.integers(len(of)))]

    def word() -> str:
        return "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(3, 9))))

    if kind == 0:
        name, _, host = text.rpartition("@")
        if rng.random() < 0.7:  # names and hosts unlike those of the sample
            name, host = one(word(), word() + "." + word(), word() + "_" + word()), word() + one(".com", ".org", ".net", ".de")
        return name + one(" @ ", " at ", " (at) ", "[at]", "(at)") + host.replace(".", one(".", " dot ", "[dot]", " . "))
    if kind == 1:
        return text.replace(".", one("[.]", " . ", "(.)"))
    if kind == 2:
        digits, gap = "".join(DIGITS.findall(text)), one(".", "/", " - ", "_")
        return gap.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    bare = re.sub(r"^\+[0-9]{1,2}[\x20.-]*", "", text)
    return one(bare, bare.replace(" ", "-"), "00" + text[1:], re.sub(r"[()]", "", bare))


def windows_of(text: str, seed: int) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled windows of a text: one around each span, and one anywhere without spans if there is such."""
    spans = sorted(base_spans(text), key=lambda s: s[1])
    rng = np.random.default_rng(seed)
    for kind, start, end in spans:
        if end - start <= TRAIN_LENGTH - 10:
            left = max(0, start - int(rng.integers(5, CONTEXT)))
            part = text[left:end + int(rng.integers(5, CONTEXT))]
            inside = [(k, s - left, e - left) for k, s, e in spans if s >= left and e <= left + len(part)]
            if len(inside) == sum(s < left + len(part) and e > left for _, s, e in spans):
                yield part, inside
    at = int(rng.integers(0, max(1, len(text) - TRAIN_LENGTH)))
    for left in [at, *[max(0, m.start() - 30) for m, _ in zip(re.finditer("[0-9]{2}", text), range(2))]]:
        if not any(s < left + TRAIN_LENGTH and e > left for _, s, e in spans):
            yield text[left:left + TRAIN_LENGTH], []


def training_windows(docs: DataFrame, doc_id: str, text: str, seed: int) -> pd.DataFrame:
    """Bounded sample of labelled windows: columns window, spans (flat list of kind, start, end)."""
    n = max(1, docs.count())
    chosen = docs.select(F.xxhash64(F.col(doc_id), F.lit(seed)).alias("h"), F.col(text).alias("t")).where(
        F.col("t").isNotNull() & (F.pmod(F.col("h"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / n) * (1 << 30))))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(h, k, window, [x for s in spans for x in s])
                    for h, t in zip(batch["h"], batch["t"]) for k, (window, spans) in enumerate(windows_of(t, h & 0xFFFFFFFF))]
            yield pd.DataFrame(rows, columns=["h", "k", "window", "spans"])

    rows = chosen.mapInPandas(cut, "h long, k int, window string, spans array<int>")
    rows = staged(rows.withColumn("place", F.xxhash64("h", "k")), "pii-windows")
    hits, misses = (rows.where(hit).orderBy("place", "window").limit(EXAMPLES)
                    for hit in (F.size("spans") > 0, F.size("spans") == 0))
    return hits.unionByName(misses).select("window", "spans").toPandas()


def encoded(examples: pd.DataFrame, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(classes, tags), both (examples, TRAIN_LENGTH); half of the windows with spans are disguised."""
    x = np.zeros((len(examples), TRAIN_LENGTH), np.uint8)
    y = np.zeros((len(examples), TRAIN_LENGTH), np.int64)
    for row, (text, flat) in enumerate(zip(examples["window"], examples["spans"])):
        spans = [tuple(int(v) for v in flat[k:k + 3]) for k in range(0, len(flat), 3)]
        change, parts, at = rng.random() < 0.5, [], 0
        tags: list[int] = []
        for kind, start, end in sorted(spans, key=lambda s: s[1]):
            if start < at:
                continue
            new = disguised(kind, text[start:end], rng) if change else text[start:end]
            parts += [text[at:start], new]
            tags += [0] * (start - at) + [kind + 1] * len(new)
            at = end
        whole = "".join([*parts, text[at:]])[:TRAIN_LENGTH]
        tags = (tags + [0] * (len(text) - at))[:TRAIN_LENGTH]
        x[row, :len(whole)] = classes_of(whole)
        y[row, :len(tags)] = tags
    return x, y


# ---- the network ------------------------------------------------------------

@dataclass
class Tagger:
    """Weights: per direction input table (classes x 4H) and recurrence (H x 4H); output, its bias, CRF transitions.

    The gates are in the order input, forget, output, candidate. The pad's
    gates stay shut, so that a padded window's backward pass starts at its text.
    """
    tables: list[np.ndarray]
    loops: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray


def new_tagger(hidden: int, rng: np.random.Generator) -> Tagger:
    def normal(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.25, shape).astype(np.float32)

    tables = [normal(N_CLASSES, 4 * hidden) for _ in range(2)]
    for t in tables:
        t[:, hidden:2 * hidden] += 1.0
        t[PAD, :3 * hidden] = -30.0
    return Tagger(tables, [normal(hidden, 4 * hidden) for _ in range(2)], normal(2 * hidden, N_TAGS),
                  np.zeros(N_TAGS, np.float32), np.zeros((N_TAGS, N_TAGS), np.float32))


def _squash(u: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """In place u (27 + u^2) / (27 + 9 u^2) on [-3, 3], -1 and 1 beyond: the network's sigmoid curve.

    A rational function costs a third of numpy's tanh. ``a`` and ``b`` are scratch.
    """
    np.minimum(u, 3, out=u)
    np.maximum(u, -3, out=u)
    np.multiply(u, u, out=a)
    np.multiply(a, 9, out=b)
    a += 27
    b += 27
    u *= a
    u /= b


def _slope(u: np.ndarray) -> np.ndarray:
    """Derivative of the curve at ``u``; 0 beyond [-3, 3]."""
    square = np.minimum(u * u, 9)
    return ((9 - square) / (9 + 3 * square)) ** 2


def _halves(hidden: int) -> np.ndarray:
    # a gate is half the curve of half its argument, plus one half; the candidate is the curve itself
    return np.repeat(np.array([0.5, 1.0], np.float32), [3 * hidden, hidden])


def _pass(x: np.ndarray, table: np.ndarray, loop: np.ndarray, backward: bool, keep: list | None = None) -> np.ndarray:
    """Hidden states (length, H, rows) of one direction; ``keep`` collects what the gradient needs."""
    length, rows, hidden = x.shape[0], x.shape[1], loop.shape[0]
    half = _halves(hidden)
    table, loop = np.ascontiguousarray((table * half).T), np.ascontiguousarray((loop * half).T)
    states = np.empty((length, hidden, rows), np.float32)
    h, c = np.zeros((hidden, rows), np.float32), np.zeros((hidden, rows), np.float32)
    z, a, b, last = *(np.empty((4 * hidden, rows), np.float32) for _ in range(3)), np.empty((hidden, rows), np.float32)
    for t in (range(length - 1, -1, -1) if backward else range(length)):
        np.matmul(loop, h, out=z)
        np.take(table, x[t], axis=1, out=a, mode="clip")
        z += a
        raw = z.copy() if keep is not None else None
        _squash(z, a, b)
        gates = z[:3 * hidden]
        gates *= 0.5
        gates += 0.5
        before = (h, c.copy()) if keep is not None else None
        c *= z[hidden:2 * hidden]
        np.multiply(z[:hidden], z[3 * hidden:], out=last)
        c += last
        np.copyto(last, c)
        _squash(last, a[:hidden], b[:hidden])
        h = states[t]
        np.multiply(z[2 * hidden:3 * hidden], last, out=h)
        if keep is not None:
            keep.append((t, raw, z.copy(), *before, c.copy(), last.copy()))
    return states


def emissions(model: Tagger, x: np.ndarray) -> np.ndarray:
    """Tag scores (length, tags, rows) of classes (length, rows); a pad is outside."""
    states = np.concatenate([_pass(x, model.tables[d], model.loops[d], d == 1) for d in range(2)], axis=1)
    return _scores(model, states, x)


def _scores(model: Tagger, states: np.ndarray, x: np.ndarray) -> np.ndarray:
    e = np.matmul(model.out.T, states) + model.bias[:, None]
    pad = x == PAD
    if pad.any():
        e[:, 0][pad] = 0.0
        for k in range(1, N_TAGS):
            e[:, k][pad] = -1e4
    return e


def _gradient(model: Tagger, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss and gradients of the CRF's negative log likelihood; x, y are (length, rows)."""
    length, rows = x.shape
    hidden = model.loops[0].shape[0]
    kept: list[list] = [[], []]
    states = np.concatenate([_pass(x, model.tables[d], model.loops[d], d == 1, kept[d]) for d in range(2)], axis=1)
    e = _scores(model, states, x).transpose(0, 2, 1).astype(np.float64)
    moves = model.moves.astype(np.float64)
    alpha, beta = np.empty_like(e), np.zeros_like(e)

    def total(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))

    alpha[0] = e[0]
    for t in range(1, length):
        alpha[t] = e[t] + total(alpha[t - 1][:, :, None] + moves, 1)
    for t in range(length - 2, -1, -1):
        beta[t] = total(moves + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    log_z = total(alpha[-1], 1)
    d_e = np.exp(alpha + beta - log_z[:, None])
    pairs = np.exp(alpha[:-1][..., :, None] + moves + (e + beta)[1:][..., None, :] - log_z[None, :, None, None])
    d_moves = pairs.sum(axis=(0, 1))
    step, row = np.arange(length)[:, None], np.arange(rows)[None, :]
    gold = e[step, row, y].sum() + moves[y[:-1], y[1:]].sum()
    d_e[step, row, y] -= 1
    np.add.at(d_moves, (y[:-1].ravel(), y[1:].ravel()), -1)
    d_e[x == PAD] = 0
    d_e = np.ascontiguousarray((d_e / rows).astype(np.float32).transpose(0, 2, 1))
    d_states = np.matmul(model.out, d_e)
    half = _halves(hidden)[:, None]
    d_tables, d_loops = [], []
    for d in range(2):
        loop, d_loop = np.ascontiguousarray(model.loops[d]), np.zeros_like(model.loops[d])
        d_table = np.zeros_like(model.tables[d])
        d_h, d_c = np.zeros((hidden, rows), np.float32), np.zeros((hidden, rows), np.float32)
        for t, raw, z, before_h, before_c, c, last in reversed(kept[d]):
            i, f, o, g = (z[k * hidden:(k + 1) * hidden] for k in range(4))
            d_h = d_h + d_states[t, d * hidden:(d + 1) * hidden]
            d_c = d_c + d_h * o * _slope(c)
            d_z = np.concatenate([d_c * g, d_c * before_c, d_h * last, d_c * i])
            d_z *= _slope(raw) * half * half  # gates: half the curve, at half the argument
            d_loop += before_h @ d_z.T
            one_hot = np.zeros((rows, N_CLASSES), np.float32)
            one_hot[np.arange(rows), x[t]] = 1
            d_table += (d_z @ one_hot).T
            d_h, d_c = loop @ d_z, d_c * f
        d_table[PAD] = 0
        d_tables.append(d_table)
        d_loops.append(d_loop)
    d_out = np.matmul(states, d_e.transpose(0, 2, 1)).sum(axis=0)
    return float((log_z.sum() - gold) / rows), [*d_tables, *d_loops, d_out, d_e.sum(axis=(0, 2)), (d_moves / rows).astype(np.float32)]


def fit_tagger(examples: pd.DataFrame, hidden: int = HIDDEN, steps: int = STEPS, seed: int = 3) -> Tagger | None:
    """Train on labelled windows; None if no window has a span."""
    if not len(examples) or not any(len(s) for s in examples["spans"]):
        return None
    rng = np.random.default_rng(seed)
    # as many windows with spans as without in each step
    hit = np.array([len(s) > 0 for s in examples["spans"]])
    weight = np.where(hit, 0.5 / hit.sum(), 0.5 / max(1, (~hit).sum()))
    weight /= weight.sum()
    model = new_tagger(hidden, rng)
    values = [*model.tables, *model.loops, model.out, model.bias, model.moves]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        chosen = examples.iloc[rng.choice(len(examples), TRAIN_BATCH, p=weight)]
        x, y = encoded(chosen, rng)
        _, grads = _gradient(model, x.T, y.T)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for v, g, a, b in zip(values, grads, first, second):
            g = g * min(1.0, 5.0 / (size + 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            v -= (rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return model


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 5) -> Tagger | None:
    """Train on the pattern spans of a bounded sample of the documents; None if it holds no span."""
    return fit_tagger(training_windows(docs, doc_id, text, seed))


# ---- decoding ---------------------------------------------------------------

def viterbi(e: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags (length, rows) for tag scores (length, tags, rows)."""
    length, _, rows = e.shape
    back = np.zeros((length, N_TAGS, rows), np.uint8)
    best = e[0]
    for t in range(1, length):
        top = best[0] + moves[0][:, None]
        for k in range(1, N_TAGS):
            other = best[k] + moves[k][:, None]
            back[t][other > top] = k
            np.maximum(top, other, out=top)
        best = top + e[t]
    tags = np.empty((length, rows), np.uint8)
    tags[-1] = best.argmax(axis=0)
    at = np.arange(rows)
    for t in range(length - 1, 0, -1):
        tags[t - 1] = back[t, tags[t], at]
    return tags


def undecided(e: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Rows in which some path may beat staying outside.

    A step with a tag gains over staying outside at most its score's lead, the
    best move into the tag and, if it pays, the move out of it. A row in which
    no step could gain has no better path: it is outside throughout.
    """
    stay = moves[0, 0]
    most = [float(moves[:, k].max() - stay + max(0.0, float(moves[k, 0] - stay))) for k in range(1, N_TAGS)]
    lead = e[:, 1:] - e[:, :1] + np.array(most, np.float32)[None, :, None]
    return np.flatnonzero(lead.max(axis=(0, 1)) >= 0)


def proposals(model: Tagger, x: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """(row, kind, start, end, margin) of the spans that the windows (length, rows) propose."""
    e = emissions(model, x)
    m = model.moves.astype(np.float64)
    open_rows = undecided(e, model.moves)
    e = np.ascontiguousarray(e[:, :, open_rows])
    if not len(open_rows):
        return
    tags = viterbi(e, model.moves)
    for row in np.flatnonzero(tags.any(axis=0)).tolist():
        line = tags[:, row]
        edges = np.flatnonzero(np.diff(line, prepend=0, append=0))
        for start, end in zip(edges.tolist(), [*edges[1:].tolist(), len(line)]):
            tag = int(line[start]) if start < len(line) else 0
            if tag:
                gain = float((e[start:end, tag, row].astype(np.float64) - e[start:end, 0, row]).sum())
                gain += (end - start - 1) * (m[tag, tag] - m[0, 0])
                gain += (m[0, tag] - m[0, 0]) * (start > 0) + (m[tag, 0] - m[0, 0]) * (end < len(line))
                yield int(open_rows[row]), tag - 1, start, end, gain


def reconciled(found: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int, float]]:
    """Non-overlapping (kind, start, end, margin) of greatest total margin over a whole text.

    ``found``: (kind, start, end, margin, cut at its start, cut at its end) of
    all windows. Pieces of one kind that overlap are joined if a window's edge
    cut one of them; the same span from two windows keeps its greater margin.
    """
    joined: list[list] = []
    for kind, start, end, margin, left, right in sorted(found, key=lambda s: (s[0], s[1], s[2])):
        last = joined[-1] if joined and joined[-1][0] == kind else None
        if last and start < last[2] and (left or last[5]):
            if end > last[2]:
                last[2], last[5] = end, right
            last[3] = max(last[3], margin)
        else:
            joined.append([kind, start, end, margin, left, right])
    spans = sorted((s for s in joined if s[3] > 0), key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in spans]
    best, take = [0.0], []
    for k, (kind, start, end, margin, *_) in enumerate(spans):
        before = bisect_right(ends, start, 0, k)
        take.append((best[before] + margin > best[k], before))
        best.append(max(best[k], best[before] + margin))
    out, k = [], len(spans)
    while k:
        chosen, before = take[k - 1]
        if chosen:
            out.append(tuple(spans[k - 1][:4]))
        k = before if chosen else k - 1
    return out[::-1]


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in " \t\r\n,;:\"'":
        start += 1
    while end > start and text[end - 1] in " \t\r\n,;:\"'.":
        end -= 1
    return start, end


def window_starts(length: int) -> range:
    """Where the windows of a text of this length start; they cover all of it."""
    return range(0, max(1, length - OVERLAP) if length else 0, WINDOW - OVERLAP)


def hinted_windows(codes: np.ndarray) -> list[int]:
    """Starts of the windows in which a span may show that it is ``valid``: an ``@``, a digit, or ``at`` at a word's edge.

    No span is valid without one of them. (A span's own edge can cut a word,
    but not on both sides of ``at``: a span of nothing else has no dot.)
    """
    letter_a, letter_t, digit, under = (CLASSES[ord(c)] for c in "at0_")
    hint = (codes == digit) | (codes == CLASSES[ord("@")])
    edge = np.ones(len(codes) + 2, bool)  # beside each character, the text's ends too; non-ASCII ones count as edges
    edge[1:-1] = ((codes > digit) & (codes != under)) | (codes == PAD)
    pair = (codes[:-1] == letter_a) & (codes[1:] == letter_t) & (edge[:-3] | edge[3:])
    hint[:-1] |= pair
    at = np.flatnonzero(hint)
    starts = np.array(window_starts(len(codes)), np.int64)
    return starts[np.searchsorted(at, starts + WINDOW) > np.searchsorted(at, starts)].tolist()


def read_windows(model: Tagger, texts: list[str], wanted: dict[int, list[int]]) -> Iterator[tuple[int, int, tuple]]:
    """(text, window's start, proposed span) of the wanted windows of some texts.

    A span is (kind, start, end, margin, cut at its start, cut at its end).
    """
    block, places = np.zeros((BATCH, WINDOW), np.uint8), []

    def flush() -> Iterator[tuple[int, int, tuple]]:
        rows = block[:len(places)]
        used = max((min(n - at, WINDOW) for _, at, n in places), default=0)
        for row, kind, start, end, margin in proposals(model, np.ascontiguousarray(rows[:, :used].T)):
            k, at, n = places[row]
            cut_left, cut_right = start == 0 and at > 0, end == WINDOW and at + WINDOW < n
            yield k, at, (kind, at + start, at + end, margin, cut_left, cut_right)
        block[:] = PAD
        places.clear()

    # short texts after one another: windows of like length share a batch
    for k in sorted(wanted, key=lambda i: len(texts[i])):
        codes, n = classes_of(texts[k]), len(texts[k])
        for at in wanted[k]:
            part = codes[at:at + WINDOW]
            block[len(places), :len(part)] = part
            places.append((k, at, n))
            if len(places) == BATCH:
                yield from flush()
    if places:
        yield from flush()


def learned_spans(model: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) that the network finds in each text, whatever the patterns find.

    The network reads the windows in which a span can be valid, and each
    window beside them that a proposed span reaches into, until none is left.
    What it would propose elsewhere is not valid and overlaps nothing that is
    proposed here, so the spans are those of reading all windows.
    """
    found: list[list] = [[] for _ in texts]
    read: list[set[int]] = [set() for _ in texts]
    todo = {k: hinted_windows(classes_of(text)) for k, text in enumerate(texts)}
    while todo := {k: sorted(starts) for k, starts in todo.items() if starts}:
        for k, starts in todo.items():
            read[k].update(starts)
        beside: dict[int, set[int]] = {}
        for k, at, span in read_windows(model, texts, todo):
            found[k].append((at, span))
            for other in (at - WINDOW + OVERLAP, at + WINDOW - OVERLAP):
                if (span[1] < other + WINDOW and span[2] > other and other not in read[k]
                        and other in window_starts(len(texts[k]))):
                    beside.setdefault(k, set()).add(other)
        todo = beside
    out = []
    for text, spans in zip(texts, found):
        kept = []
        for kind, start, end, margin in reconciled([span for _, span in sorted(spans, key=lambda s: s[0])]):
            start, end = _trimmed(text, start, end)
            if margin > MARGIN and valid(kind, text[start:end]):
                kept.append((kind, start, end))
        out.append(kept)
    return out


def all_spans(model: Tagger | None, texts: list[str]) -> list[list[dict]]:
    """Spans of each text, by kind, then start: those of the patterns, and learned ones that touch none of them."""
    out = []
    for text, more in zip(texts, learned_spans(model, texts) if model else [[]] * len(texts)):
        base = base_spans(text)
        spans = [(k, s, e, False) for k, s, e in base]
        taken = sorted((s, e) for _, s, e in base)
        starts = [s for s, _ in taken]
        reach = np.maximum.accumulate([e for _, e in taken]).tolist() if taken else []
        for kind, start, end in more:
            k = bisect_right(starts, end - 1)
            if not k or reach[k - 1] <= start:
                spans.append((kind, start, end, True))
        out.append([{"kind": KINDS[k], "start": s, "end": e, "learned": l} for k, s, e, l in sorted(spans)])
    return out


def personal_data(text: Column, model: Tagger | None) -> Column:
    """Spans of each text: array of (kind, start, end, learned), by kind as in KINDS, then start.

    Places are code points, the end exclusive. ``learned`` spans are the
    network's; without a model there are none. Null texts count as empty and
    have no spans. Learned spans overlap no other span; pattern spans of
    different kinds may overlap each other.
    """
    @F.pandas_udf("array<struct<kind:string,start:long,end:long,learned:boolean>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(all_spans(model, [t if isinstance(t, str) else "" for t in batch]), dtype=object)

    return spans(text)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
