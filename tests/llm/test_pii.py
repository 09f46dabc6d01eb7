"""Personal data: patterns against plain regular expressions, the network on held-out forms, whole long texts."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestar.llm import pii
from lodestar.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == 2 and 13 <= len(digits) <= 19 and plain_luhn(digits) or kind == 3 and 9 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 3000"))


@pytest.mark.parametrize("text", [
    "a@b.c@d.e x@y.z_w@q.r.s @a.b a@ a@b. a.@-.-", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.255 1.2.3.00000000256 1..2.3.4 12.13.14.15",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111114111 1  2", "+1 (555) 010-9999 +1+2 345 678 901 + 1 2 +49.30.123456.",
    "über@example.com é1.2.3.4 ４111111111111111", "", "++++1 2 3 4 5 6 7 8 9-", "a" * 300 + "@" + "b" * 300 + ".c"])
def test_patterns_equal_plain_regular_expressions(text):
    assert pii.base_spans(text) == plain_base(text)


def test_patterns_on_random_texts():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        text = "".join(rng.choice(list("0019+ .-@()ab_%é"), int(rng.integers(0, 60))))
        assert pii.base_spans(text) == plain_base(text), text


def test_patterns_are_linear_on_long_runs():
    for part in ("a", "1", "1.", "+1 ", "a@", "1 ", "+"):
        pii.base_spans(part * (400_000 // len(part)))


def test_query_keeps_the_contract(spark):
    rows = QUERIES["op13_personal_data"](spark, SF).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    from hashlib import sha256
    for r in rows:
        base = plain_base(docs[r.doc_id])
        assert [sum(k == i for k, *_ in base) for i in range(4)] == [r.n_email, r.n_ip, r.n_card, r.n_phone]
        text = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == sha256(",".join(text).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(text) <= set(spans) and len(spans) == len(text) + r.n_learned
        order = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)
    assert sum(r.n_learned for r in rows) <= 5  # clean text is left alone


def test_disguised_data_are_found_in_documents_not_learned_from(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 3000").collect()
    rng, hit, all_ = np.random.default_rng(1), 0, 0
    for r in docs:
        for window, spans in pii.windows_of(r.text or "", r.doc_id):
            if len(spans) == 1:
                kind, s, e = spans[0]
                new = pii.disguised(kind, window[s:e], rng)
                got = pii.all_spans(model, [window[:s] + new + window[e:]])[0]
                hit += any(g["kind"] == pii.KINDS[kind] and g["start"] < s + len(new) and g["end"] > s for g in got)
                all_ += 1
    assert all_ > 100 and hit / all_ >= 0.85, (hit, all_)


def test_spans_across_windows_are_found_once(model):
    filler = "the quick brown fox jumps over some lazy dogs "
    for shift in range(0, 200, 13):
        text = (filler * 6)[:150 + shift] + " 10[.]20[.]30[.]40 " + filler * 8
        got = [g for g in pii.all_spans(model, [text])[0] if g["learned"]]
        assert len(got) <= 1
        assert all(text[g["start"]:g["end"]].startswith("10") and text[g["start"]:g["end"]].endswith("40") for g in got)


def test_long_texts_are_read_whole(model):
    text = "word " * 60_000 + "call (555) 010-9999 now or write to ab@example.com " + "word " * 1000
    got = pii.all_spans(model, [text])[0]
    assert ("email", text.index("ab@"), text.index("ab@") + 14) in [(g["kind"], g["start"], g["end"]) for g in got]


def test_reconciled_spans_do_not_overlap_and_weigh_most():
    spans = [(0, 0, 10, 5.0, False, False), (1, 8, 20, 6.0, False, False), (0, 18, 30, 5.0, False, False), (2, 40, 50, -1.0, False, False)]
    assert pii.reconciled(spans) == [(0, 0, 10, 5.0), (0, 18, 30, 5.0)]
    assert pii.reconciled([(3, 200, 256, 2.0, False, True), (3, 200, 300, 7.0, False, False)]) == [(3, 200, 300, 7.0)]
    assert pii.reconciled([(3, 100, 256, 2.0, False, True), (3, 192, 320, 3.0, True, False)]) == [(3, 100, 320, 3.0)]
    assert pii.reconciled([]) == []


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    model = pii.new_tagger(3, rng)
    x, y = rng.integers(1, pii.N_CLASSES, (7, 4)).astype(np.uint8), rng.integers(0, pii.N_TAGS, (7, 4))
    x[5:, 1], y[5:, 1] = pii.PAD, 0
    _, grads = pii._gradient(model, x, y)
    values = [*model.tables, *model.loops, model.out, model.bias, model.moves]
    for v, g in zip(values, grads):
        for at in {tuple(rng.integers(0, n) for n in v.shape) for _ in range(6)} | {tuple([int(x[0, 0])] + [0] * (v.ndim - 1))} if v.shape[0] > 20 else {tuple(rng.integers(0, n) for n in v.shape) for _ in range(6)}:
            if v.shape[0] == pii.N_CLASSES and at[0] == pii.PAD:
                continue
            old = v[at]
            v[at] = old + 1e-2
            up = pii._gradient(model, x, y)[0]
            v[at] = old - 1e-2
            down = pii._gradient(model, x, y)[0]
            v[at] = old
            assert abs((up - down) / 2e-2 - g[at]) < 2e-3 + 0.02 * abs(g[at])


def test_awkward_rows(spark, awkward, nothing, model):
    out = awkward.withColumn("spans", pii.personal_data(F.col("text"), model)).collect()
    assert len(out) == awkward.count() and all(r.spans == [] for r in out if not r.text)
    assert nothing.select(pii.personal_data(F.col("text"), model).alias("s")).count() == 0
    assert pii.train(nothing) is None  # nothing to learn from: the patterns alone
    bare = spark.createDataFrame([("x a@b.cd +1 234 567 890",)], "text string")
    (row,) = bare.select(pii.span_text(pii.personal_data(F.col("text"), None)).alias("s")).collect()
    assert row.s == "email:2:8,phone:9:23"


def test_examples_without_spans_train_nothing():
    assert pii.fit_tagger(pd.DataFrame({"window": ["abc"], "spans": [[]]})) is None


def stirred_texts(n, seed):
    rng = np.random.default_rng(seed)
    parts = ["words ", "that ", "an ", "nothing here, ", "at ", "é", "hat", "AT", "dot ", ". ", "12", "4.5 ", "x@y.z ", "_at_", "\n", "(at) "]
    weight = np.array([40, 3, 30, 30, 1, 3, 1, 1, 5, 8, 1, 1, 1, 1, 5, 1], float)
    return ["".join(rng.choice(parts, int(rng.integers(0, 700)), p=weight / weight.sum())) for _ in range(n)]


def test_reading_some_windows_finds_what_all_windows_hold(monkeypatch):
    monkeypatch.setattr(pii, "MARGIN", 0.0)
    n = 0
    for seed in range(6):
        eager = pii.new_tagger(pii.HIDDEN, np.random.default_rng(seed))  # untrained: it proposes short and long spans
        eager.bias[:] = np.random.default_rng(seed).uniform(0, 1, pii.N_TAGS)
        eager.moves[:] = np.eye(pii.N_TAGS, dtype=np.float32) * 0.3 * seed
        texts = [*stirred_texts(40, seed), "", "at", "a", "hat. dot", "a" * 383 + "t ." + "b" * 400]
        some = pii.learned_spans(eager, texts)
        with monkeypatch.context() as every:
            every.setattr(pii, "hinted_windows", lambda codes: list(pii.window_starts(len(codes))))
            assert some == pii.learned_spans(eager, texts)
        n += sum(map(len, some))
    assert n > 10


def test_hints_are_in_every_valid_span():
    for text in stirred_texts(40, 9):
        rng = np.random.default_rng(len(text))
        for _ in range(60):
            start = int(rng.integers(0, max(1, len(text))))
            part = text[start:start + int(rng.integers(1, 40))]
            if any(pii.valid(kind, part) for kind in range(4)):
                windows = pii.hinted_windows(pii.classes_of(text))
                assert any(at < start + len(part) and at + pii.WINDOW > start for at in windows)


def test_windows_without_a_possible_span_are_not_read(model, monkeypatch):
    rows, plain = [], pii.emissions
    monkeypatch.setattr(pii, "emissions", lambda m, x: rows.append(x.shape[1]) or plain(m, x))
    text = "some words of no such kind, one after the other. " * 2000
    data = " write to jim.doe (at) example dot org please "
    pii.learned_spans(model, [text, text[:50_000] + data + text[50_000:]])
    assert 0 < sum(rows) < 12  # of 612 windows
