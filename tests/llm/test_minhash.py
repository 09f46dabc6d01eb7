import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from lodestar.llm import minhash


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, following):
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def check(rows, docs):
    """docs in the expected order; rows by doc_id."""
    errors = []
    texts = [d.text or "" for d in docs]
    for i, d in enumerate(docs):
        r, following = rows[d.doc_id], texts[(i + 1) % len(texts)]
        e = edited(texts[i], following)
        assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        errors += [r.near_edited - jaccard(texts[i], e), r.near_next - jaccard(texts[i], following)]
    return np.array(errors)


def test_report_equals_brute_force(documents):
    docs = documents.orderBy("doc_id").collect()
    rows = {r.doc_id: r for r in minhash.fingerprint_report(documents.repartition(7)).collect()}
    errors = check(rows, docs)
    assert len(rows) == len(docs)
    assert np.abs(errors).mean() < 0.03 and np.abs(errors).max() < 0.2 and abs(errors.mean()) < 0.01
    assert {len(r.fingerprint) for r in rows.values()} == {256}


def test_main_path_is_native(documents):
    plan = minhash.fingerprint_report(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_equal_texts_and_empty_bins(spark):
    texts = ["a b c d e f g", "a b c d e f g", "p q", "p q", "r s", "", None, "  \n", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in minhash.fingerprint_report(df).collect()}
    assert rows[0].fingerprint == rows[1].fingerprint and rows[0].near_next == 1
    assert rows[2].fingerprint == rows[3].fingerprint and rows[3].near_next < 0.2
    assert rows[5].fingerprint == rows[6].fingerprint == rows[7].fingerprint == "0" * 256
    assert rows[5].near_next == rows[6].near_next == 1 and rows[7].near_next == 0


def test_awkward_rows(awkward, nothing):
    out = minhash.fingerprint_report(awkward).collect()
    assert len(out) == awkward.count()
    docs = sorted(awkward.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    rows = {}
    for r in out:
        rows.setdefault(r.doc_id, []).append(r)
    for i, d in enumerate(docs):
        e = edited(d.text or "", docs[(i + 1) % len(docs)].text or "")
        assert hashlib.sha256(e.encode()).hexdigest() in {r.edited_sha256 for r in rows[d.doc_id]}
    assert minhash.fingerprint_report(nothing).count() == 0


def test_one_row_follows_itself(spark):
    df = spark.createDataFrame([(3, "abcdef gh")], "doc_id long, text string")
    r = minhash.fingerprint_report(df).first()
    assert r.edited_sha256 == hashlib.sha256(edited("abcdef gh", "abcdef gh").encode()).hexdigest() and r.near_next == 1


def test_likeness_of_pairs_with_known_overlap(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(40):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 400)]
        cut = int(400 * rng.random())
        rows.append((i, " ".join(words), " ".join(words[:cut] + [f"v{x}" for x in rng.integers(0, 10**6, 400 - cut)])))
    df = spark.createDataFrame(rows, "i long, a string, b string")
    both = minhash.fingerprints(minhash.fingerprints(df, "a", "da"), "b", "db")
    got = {r.i: r.n for r in both.select("i", minhash.likeness(F.col("da"), F.col("db")).alias("n")).collect()}
    errors = [got[i] - jaccard(a, b) for i, a, b in rows]
    assert np.abs(errors).max() < 0.13 and abs(np.mean(errors)) < 0.02
