"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer.

Two deterministic transducers are compiled from the tokenizer file.

*Splitter.* Reads classes of characters and marks where the pieces of the text
begin (the byte-level pattern: contractions, letters, digits, other marks,
white space). Each transition is annotated with the piece starts it emits; a
start can lie one character back, which stands for the pattern's look-ahead.
A text is cut into chunks; for every chunk the map "state before -> state
after" is worked out for all states at once, the maps are composed with a
parallel prefix scan, and then each chunk is replayed from its now known state.

*Merger.* Reads the bytes of one piece. Its state holds, for each place where
a vocabulary token could still be growing, the trie node reached, the last
token before that place and the token count there relative to the present.
Every prefix of a piece has exactly one encoding, whose last token is the one
that fits the token before it (the pair stays unmerged), so a transition is
determined and emits the change of the token count. States and transitions
are compiled on demand, shared by all pieces with the same future, and their
number is bounded: a full table is emptied and compiled anew, which changes
no result.

Text passes through Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# classes of characters (S: one of s t m d; R: r or v; PAD leaves every state as it is)
LETTER, S, R, L, E, DIGIT, BLANK, SPACE, MARK, QUOTE, END, PAD = range(12)
N_CLASSES = 12
LETTERS = (LETTER, S, R, L, E)
# states of the splitter
(START, IN_LETTERS, IN_DIGITS, IN_MARKS, AT_QUOTE, QUOTE_R, QUOTE_L,
 ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE) = range(11)
N_STATES = 11
HERE, BACK = 1, 2  # a piece starts at this character / at the one before
CHUNK = 64
SETTLE = 8
BLOCK = 1 << 20
SEPARATOR = "\n"


def _splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next states and emitted starts, both indexed by state * N_CLASSES + class."""
    opens = {**{c: IN_LETTERS for c in LETTERS}, DIGIT: IN_DIGITS, BLANK: ONE_BLANK,
             SPACE: ONE_SPACE, MARK: IN_MARKS, QUOTE: AT_QUOTE, END: START}
    # after a blank that belongs to the piece; a quote opens no contraction there
    joins = {**{c: IN_LETTERS for c in LETTERS}, DIGIT: IN_DIGITS, MARK: IN_MARKS, QUOTE: IN_MARKS}

    def step(state: int, c: int) -> tuple[int, int]:
        if c == PAD:
            return state, 0
        if state == IN_LETTERS and c in LETTERS or state == IN_DIGITS and c == DIGIT:
            return state, 0
        if state in (IN_MARKS, AT_QUOTE) and c in (MARK, QUOTE):
            return IN_MARKS, 0
        if state == AT_QUOTE and c in (S, R, L):
            return {S: START, R: QUOTE_R, L: QUOTE_L}[c], 0
        if (state, c) in ((QUOTE_R, E), (QUOTE_L, L)):
            return START, 0
        if state in (QUOTE_R, QUOTE_L):  # no contraction: the letter after the quote opened a piece
            return (IN_LETTERS, BACK) if c in LETTERS else (opens[c], BACK | HERE)
        if state in (ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE):
            if c in (BLANK, SPACE):
                return (RUN_BLANK if c == BLANK else RUN_SPACE), 0
            if c == END:
                return START, HERE
            back = BACK if state in (RUN_BLANK, RUN_SPACE) else 0
            if state in (ONE_BLANK, RUN_BLANK):
                return joins[c], back
            return opens[c], back | HERE
        return opens[c], HERE

    nxt = np.zeros(N_STATES * N_CLASSES, np.uint8)
    out = np.zeros(N_STATES * N_CLASSES, np.uint8)
    for s in range(N_STATES):
        for c in range(N_CLASSES):
            nxt[s * N_CLASSES + c], out[s * N_CLASSES + c] = step(s, c)
    return nxt, out


NEXT, EMIT = _splitter_tables()


def _compose_scan(maps: np.ndarray) -> np.ndarray:
    """State before each chunk, when the first chunk starts in START.

    ``maps`` is (chunks, states). Work-efficient prefix scan: neighbours are
    composed pairwise, the half-length sequence is scanned, and the result is
    spread back to the odd places.
    """
    n = len(maps)
    if n == 1:
        return np.zeros(1, np.uint8)
    pairs = n // 2
    merged = np.take_along_axis(maps[1:2 * pairs:2], maps[0:2 * pairs:2].astype(np.intp), axis=1)
    if n % 2:
        merged = np.concatenate([merged, maps[-1:]])
    before = _compose_scan(merged)
    out = np.empty(n, np.uint8)
    out[0::2] = before[:(n + 1) // 2]
    out[1::2] = maps[np.arange(0, 2 * pairs, 2), before[:pairs]]
    return out


def piece_starts(classes: np.ndarray) -> np.ndarray:
    """Boolean array: a piece starts at this character (``classes`` begins in START)."""
    n = len(classes)
    rows = -(-n // CHUNK)
    padded = np.full(rows * CHUNK, PAD, np.uint8)
    padded[:n] = classes
    grid = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
    maps = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], rows, axis=1)
    for column in grid[:SETTLE]:
        maps = NEXT[maps * np.uint8(N_CLASSES) + column]
    # by now nearly every chunk's map is constant: one state stands for all from here on
    open_ = np.flatnonzero((maps != maps[0]).any(axis=0))
    constant, varied = maps[0], maps[:, open_]
    for column in grid[SETTLE:]:
        constant = NEXT[constant * np.uint8(N_CLASSES) + column]
        if len(open_):
            varied = NEXT[varied * np.uint8(N_CLASSES) + column[open_]]
    maps = np.repeat(constant[None, :], N_STATES, axis=0)
    maps[:, open_] = varied
    state = _compose_scan(np.ascontiguousarray(maps.T))
    marks = np.empty((CHUNK, rows), np.uint8)
    for j, column in enumerate(grid):
        at = state * np.uint8(N_CLASSES) + column
        marks[j] = EMIT[at]
        state = NEXT[at]
    marks = marks.T.reshape(-1)[:n]
    starts = (marks & HERE) != 0
    starts[:-1] |= (marks[1:] & BACK) != 0
    return starts


def probe_classes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all code points as runs (first code point, class), asked of the library itself.

    The library's own splitter is given each code point beside a letter, a
    digit and a mark: what stays together has the same class.
    """
    return _probed(path)


@lru_cache(maxsize=4)
def _probed(path: str) -> tuple[np.ndarray, np.ndarray]:
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer
    # the planes in which letters, digits or spaces are assigned; the rest are marks
    points = [c for c in range(1, 0x35000) if not 0xD800 <= c < 0xE000] + list(range(0xE0000, 0xE1000))
    lut = np.full(0x110000, MARK, np.uint8)

    def together(side: str, these: list[int]) -> list[int]:
        text = "".join(f"{side}{chr(c)}\n" for c in these)
        whole = {span[0] for _, span in split.pre_tokenize_str(text) if span[1] - span[0] == 2}
        return [c for i, c in enumerate(these) if 3 * i in whole]

    for lo in range(0, len(points), 20_000):
        these = points[lo:lo + 20_000]
        letters, digits = together("a", these), together("1", these)
        rest = sorted(set(these) - set(letters) - set(digits))
        marks = set(together("!", rest))
        lut[letters], lut[digits] = LETTER, DIGIT
        lut[[c for c in rest if c not in marks]] = SPACE
    lut[0x20], lut[ord("'")] = BLANK, QUOTE
    for chars, c in (("stmd", S), ("rv", R), ("l", L), ("e", E)):
        lut[[ord(x) for x in chars]] = c
    first = np.flatnonzero(np.diff(lut, prepend=lut[:1] + 1))
    return first.astype(np.int32), lut[first]


class Splitter:
    """Cuts texts into the pieces that the tokenizer merges separately."""

    def __init__(self, runs: tuple[np.ndarray, np.ndarray]):
        first, cls = runs
        self.lut = np.repeat(cls, np.diff(np.append(first, 0x110000)))

    def bounds(self, segments: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of (text, first character and end of each piece in it, the segment that each belongs to)."""
        joined = SEPARATOR.join(segments) + SEPARATOR
        ends = np.cumsum([len(s) + 1 for s in segments]) - 1
        pos, size, n = 0, BLOCK, len(joined)
        while pos < n:
            block = joined[pos:pos + size]
            classes = self.lut[np.frombuffer(block.encode("utf-32-le"), np.uint32)]
            lo, hi = np.searchsorted(ends, [pos, pos + len(block)])
            classes[ends[lo:hi] - pos] = END
            at = np.flatnonzero(piece_starts(classes))
            if pos + len(block) < n:  # the last piece is still open: it starts the next block
                if len(at) < 2:
                    size *= 2
                    continue
                stop, at = int(at[-1]), at[:-1]
            else:
                stop = len(block)
            real = classes[at] != END
            cuts = np.append(at, stop)
            yield block, cuts[:-1][real], cuts[1:][real], np.searchsorted(ends, at[real] + pos)
            pos, size = pos + stop, BLOCK

    def pieces(self, segments: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """Blocks of (pieces, index of the segment that each belongs to)."""
        for block, a, b, owner in self.bounds(segments):
            yield [block[i:j] for i, j in zip(a.tolist(), b.tolist())], owner


def _byte_of_char() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    return table | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Merger(dict):
    """Token count of each piece: a bounded table filled by the compiled transducer."""

    def __init__(self, path: str, max_pieces: int = 150_000, max_states: int = 100_000):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, chars = spec["model"], _byte_of_char()
        vocab = model["vocab"]
        self.bytes_of = {i: bytes(chars[c] for c in t) for t, i in vocab.items()}
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.single = {b[0]: i for i, b in self.bytes_of.items() if len(b) == 1}
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.max_pieces, self.max_states = max_pieces, max_states
        self.child: dict[int, int] = {}  # node * 256 + byte -> node
        self.token = [-1]
        self.grows = [True]
        for i, b in self.bytes_of.items():
            node = 0
            for x in b:
                self.grows[node] = True
                key = node << 8 | x
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.grows.append(False)
                node = self.child[key]
            self.token[node] = i
        self.made = {new: (rank, pair) for pair, (rank, new) in reversed(self.merges.items())}
        self._whole: dict[int, bool] = {}
        self.older: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        start = ((0, -1, 0),)
        self.states = [start]
        self.number = {start: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Plain byte-pair merging: the lowest rank first, leftmost among equals."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            best = min((self.merges.get(p, (1 << 30, -1)) + (i,) for i, p in enumerate(zip(ids, ids[1:]))))
            if best[0] == 1 << 30:
                break
            ids[best[2]:best[2] + 2] = [best[1]]
        return ids

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` stays a token of its own right after ``before`` (-1: piece start).

        The two are unmerged step by step, the latest merge first, along the
        edge where they meet. They stay apart unless, at some time, the two
        symbols at the edge would have merged before either was merged into
        its own token; among equal ranks the leftmost pair merges first.
        """
        if before < 0:
            got = self._whole.get(token)
            if got is None:
                got = self._whole[token] = self.merge(self.bytes_of[token]) == [token]
            return got
        if not self.fits(-1, token):
            return False
        x, y, x_until, y_until = before, token, 1 << 30, 1 << 30
        merges, made = self.merges, self.made
        while True:
            crossing = merges.get((x, y))
            if crossing is not None and crossing[0] < x_until and crossing[0] <= y_until:
                return False
            x_rank, x_part = made.get(x, (-1, None))
            y_rank, y_part = made.get(y, (-1, None))
            if x_rank < 0 and y_rank < 0:
                return True
            if x_rank > y_rank:
                x, x_until = x_part[1], x_rank
            else:
                y, y_until = y_part[0], y_rank

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        last = emitted = None
        growing = []
        for node, before, count in self.states[state]:
            child = self.child.get(node << 8 | byte)
            if child is None:
                continue
            if last is None and self.token[child] >= 0 and self.fits(before, self.token[child]):
                last, emitted = self.token[child], count + 1
            if self.grows[child]:
                growing.append((child, before, count))
        if last is None:
            raise ValueError("the vocabulary lacks a byte or its merges are out of order")
        entries = (*((n, t, c - emitted) for n, t, c in growing), (0, last, 0))
        number = self.number.get(entries)
        if number is None:
            number = len(self.states)
            self.number[entries] = number
            self.states.append(entries)
        self.moves[state << 8 | byte] = number, emitted
        return number, emitted

    def count(self, piece: bytes) -> int:
        if len(self.states) > self.max_states:
            self._reset()
        state = total = 0
        for byte in piece:
            move = self.moves.get(state << 8 | byte)
            state, emitted = move if move is not None else self._compile(state, byte)
            total += emitted
        return total

    def __missing__(self, piece: str) -> int:
        n = self.older.get(piece)
        if n is None:
            n = self.count(piece.encode("utf-8"))
        if len(piece) <= 64:
            if len(self) >= self.max_pieces:  # two generations: what is still in use moves on
                self.older = dict(self)
                self.clear()
            self[piece] = n
        return n


def segments_of(texts: list[str | None], specials: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Parts of the texts between special strings, the text of each part, specials per text."""
    parts, owner, found = [], [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        cut = [text or ""]
        for s in specials:
            cut = [p for c in cut for p in c.split(s)]
        found[i] = len(cut) - 1
        parts += cut
        owner += [i] * len(cut)
    return parts, np.asarray(owner, np.int64), found


def in_blocks(texts: list[str | None], block: int = BLOCK) -> Iterator[list[str | None]]:
    """Runs of texts of about ``block`` characters together (a longer one alone)."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "") + 1
        if size >= block:
            yield held
            held, size = [], 0
    if held:
        yield held


class TokenCounter:
    """Counts the tokens of whole texts with the two transducers."""

    def __init__(self, path: str, runs: tuple[np.ndarray, np.ndarray]):
        self.splitter, self.merger = Splitter(runs), Merger(path)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        out = []
        for block in in_blocks(texts):
            parts, owner, total = segments_of(block, self.merger.specials)
            for pieces, part in self.splitter.pieces(parts):
                n = np.fromiter(map(self.merger.__getitem__, pieces), np.int64, len(pieces))
                total += np.bincount(owner[part], n, minlength=len(block)).astype(np.int64)
            out.append(total)
        return np.concatenate(out) if out else np.zeros(0, np.int64)


@lru_cache(maxsize=2)
def _counter(path: str, runs_key: bytes, n: int) -> TokenCounter:
    first = np.frombuffer(runs_key[:4 * n], np.int32)
    return TokenCounter(path, (first, np.frombuffer(runs_key[4 * n:], np.uint8)))


def token_count(text: Column, tokenizer_path: str) -> Column:
    """Number of tokens (long) of each text as the tokenizers library counts them.

    No begin, end or added special tokens; special strings in a text count as
    the library's default has it (one token each). Null and empty texts count
    0. Texts of any length are read whole, in blocks. ``tokenizer_path`` is a
    byte-level BPE .json that every executor can open.
    """
    first, cls = probe_classes(tokenizer_path)
    key, n = first.tobytes() + cls.tobytes(), len(first)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(tokenizer_path, key, n)
        for batch in batches:
            yield pd.Series(counter.counts([t if isinstance(t, str) else None for t in batch]))

    return count(text)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024,
                 text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > limit).

    Row for row: repeated rows stay, nulls in other columns pass through,
    columns of these three names are replaced, an empty table stays empty.
    """
    return (docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
            .withColumn("n_tokens", token_count(F.col(text), tokenizer_path))
            .withColumn("over_limit", F.col("n_tokens") > limit))
