"""The Merkle manifest against a plain tree, its layout, and awkward rows."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        other = i ^ 1
        out.append((other > i, level[other]) if other < len(level) else None)
        i >>= 1
    return out


def plain_audit(rows, tampered):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    def leaf(r, n_chars):
        return h(field(r[0]), field(r[1]), field(r[2]), field(n_chars), field(r[4]))

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[3])))
        trees[g] = plain_tree([leaf(r, r[3]) for r in groups[g]])
    top = plain_tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, k)
            n = r[3] + 1 if r[3] is not None and tampered(r) else r[3]
            folded = leaf(r, n)
            for s in steps:
                folded = h(folded) if s is None else h(folded, s[1]) if s[0] else h(s[1], folded)
            out.append((r[0], leaf(r, r[3]), trees[g][-1][0], top[-1][0], h(*[s[1] for s in steps if s]), folded,
                        folded == top[-1][0]))
    return out


def odd(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0


def audited(df, height=merkle.HEIGHT):
    out = merkle.audit(df, {"n_chars": F.col("n_chars") + 1}, F.crc32(F.col("doc_id").cast("string")) % 7 == 0, height=height)
    return [tuple(r) for r in out.collect()]


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def by_text(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("height", [1, 3, 10])
def test_audit_equals_a_plain_tree(documents, height):
    want = plain_audit(rows_of(documents), odd)
    got = audited(documents, height)
    assert by_text(got) == by_text(want)
    assert sum(not r[-1] for r in got) == sum(odd(r) and r[3] is not None for r in rows_of(documents)) > 0


def test_many_groups_make_a_tree_of_several_stages(documents):
    many = documents.withColumn("lang", F.concat(F.lit("l"), F.pmod(F.col("doc_id"), F.lit(37)).cast("string")))
    assert by_text(audited(many, 2)) == by_text(plain_audit(rows_of(many), odd))


def test_awkward_rows(awkward, nothing):
    assert by_text(audited(awkward)) == by_text(plain_audit(rows_of(awkward), odd))
    out = merkle.audit(nothing)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert out.count() == 0


def test_a_single_document_is_its_own_root(awkward):
    (row,) = merkle.audit(awkward.where("doc_id = 4")).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == h()


@pytest.mark.parametrize("levels", range(1, 12))
def test_layout_places_each_node_once_and_keeps_subtrees_together(levels):
    places = [merkle.addresses(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places)) == list(range((1 << levels) - 1))
    top = levels // 2
    if top:
        upper = np.concatenate(places[:top])
        assert sorted(upper) == list(range((1 << top) - 1))  # the upper half comes first
        size = (1 << (levels - top)) - 1
        for tree in range(1 << top):  # each lower subtree is one run
            below = np.concatenate([places[d][tree << (d - top):(tree + 1) << (d - top)] for d in range(top, levels)])
            assert below.max() - below.min() + 1 == size == len(below)


def test_manifest_keeps_the_roots(documents):
    rows = documents.select(merkle.group_key(F.col("lang")).alias("g"), F.col("doc_id").alias("id"),
                            merkle.leaf_digest([F.col(c) for c in merkle.COLUMNS]).alias("digest"))
    m = merkle.manifest(rows)
    want = plain_audit(rows_of(documents), lambda r: False)
    assert m.root().first()[0].hex() == want[0][3]
    assert {r.root.hex() for r in m.subroots().collect()} == {w[2] for w in want}
