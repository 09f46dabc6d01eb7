import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodestar.llm import packing
from lodestar.llm.packing import PackingPlan, TokenIds, pack_documents
from lodestar.llm.token_count import (CHUNK, N_STATES, NEXT, N_CLASSES, TokenCounter, _compose_scan, probe_classes,
                                      token_counts)

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(PATH, probe_classes(PATH))


def random_texts(n, seed):
    rng = random.Random(seed)
    marks = "ab'srevltmd  \n\t1２é日!🙂　\xa0\x00$"
    return ["".join(rng.choice(marks) for _ in range(rng.randint(0, 80))) for _ in range(n)]


TRICKY = ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "a" * 5000, " " * 3000 + "x", "'" * 99,
          "'re're'lx'r", " 's 'll", "\n\n a", "\ta", "x \n", "ȩ́", "\U0001F469‍\U0001F4BB"]


def test_counts_equal_the_library(counter, library, documents):
    texts = [r.text for r in documents.collect()] + random_texts(2000, 3) + TRICKY
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.counts(texts).tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_counts_of_any_text(counter, library, text):
    assert counter.counts([text])[0] == len(library.encode(text, add_special_tokens=False).ids)


def test_full_tables_change_nothing(library, documents):
    small = TokenCounter(PATH, probe_classes(PATH))
    small.merger.max_pieces, small.merger.max_states = 50, 200
    texts = [r.text for r in documents.limit(20).collect()]
    assert small.counts(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_prefix_scan_equals_one_pass():
    rng = np.random.default_rng(0)
    classes = rng.integers(0, N_CLASSES, 10_007)
    maps, state, before = [], 0, []
    for lo in range(0, len(classes), CHUNK):
        row = np.arange(N_STATES)
        for c in classes[lo:lo + CHUNK]:
            row = NEXT[row * N_CLASSES + c].astype(int)
        maps.append(row)
        before.append(state)
        state = row[state]
    assert _compose_scan(np.array(maps, np.uint8)).tolist() == before


def test_counts_of_awkward_rows(awkward, nothing, library):
    out = token_counts(awkward, PATH).collect()
    assert len(out) == awkward.count()
    for r in out:
        text = r.text or ""
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert r.n_bytes == len(text.encode()) and r.over_limit == (r.n_tokens > 1024)
    assert token_counts(nothing, PATH).count() == 0


def check_packing(rows, texts, library, capacity=2048):
    """Gapless sequences; pieces that hold every document's ids."""
    left = Counter()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        left[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in texts:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            left[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] -= 1
    assert not any(left.values())
    total = sum(r.length for r in rows)
    return len(by_sequence), -(-total // capacity)


def test_packing_is_whole_and_tight(documents, library):
    rows = pack_documents(documents, PATH).collect()
    used, least = check_packing(rows, [(r.doc_id, r.text) for r in documents.collect()], library)
    assert used <= least + 2


def test_packing_of_awkward_rows(awkward, nothing, library):
    rows = pack_documents(awkward, PATH).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in awkward.collect()], library)
    assert pack_documents(nothing, PATH).count() == 0


def test_ids_of_random_texts(library):
    texts = random_texts(500, 5) + TRICKY
    got = TokenIds(PATH, probe_classes(PATH), max_pieces=100).ids(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_plan_uses_every_piece_once(counts):
    plan = PackingPlan(counts, 64)
    used = Counter()
    for n, lengths in plan.groups:
        assert n > 0 and sum(lengths) <= 64
        for x in lengths:
            used[x] += n
    assert used == Counter(counts)


def test_plan_finds_exact_complements():
    # each list fills 64 in one way only (no other pair or triple of them does)
    for lengths in ([60, 4], [30, 20, 14], [40, 13, 6, 5]):
        plan = PackingPlan({x: 9 for x in lengths}, 64)
        assert sum(n for n, _ in plan.groups) == 9
    assert len(PackingPlan({1: 10**12}, 64).groups) <= 2


def test_known_short_pieces_are_looked_up_together(library, documents, monkeypatch):
    texts = [r.text for r in documents.limit(200).collect()] + random_texts(500, 23) + TRICKY
    texts += ["x" * n + " " + "é" * n for n in range(1, 20)] + ["\x00", "\x00\x00", "a\x00"]
    encoder = TokenIds(PATH, probe_classes(PATH))
    ids = lambda t: [b.tolist() for b in (np.frombuffer(x, "<u4") for x in encoder.ids(t))]
    truth = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert ids(texts) == truth
    seen, plain = [], encoder._look_up
    monkeypatch.setattr(encoder, "_look_up", lambda pieces: seen.extend(pieces) or plain(pieces))
    assert ids(texts) == truth
    n_pieces = sum(len(p) for p, _ in encoder.splitter.pieces([t or "" for t in texts]))
    assert len(seen) < n_pieces / 20  # one by one: the long pieces, and the few that share a slot


def test_full_slots_change_nothing(library, documents, monkeypatch):
    monkeypatch.setattr(packing, "SLOT_BITS", 4)
    monkeypatch.setattr(packing, "MAX_IDS", 30)
    texts = [r.text for r in documents.limit(50).collect()] + random_texts(300, 29)
    encoder = TokenIds(PATH, probe_classes(PATH), max_pieces=50)
    for some in (texts, texts[::-1]):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(some)]
        assert got == [e.ids for e in library.encode_batch([t or "" for t in some], add_special_tokens=False)]
