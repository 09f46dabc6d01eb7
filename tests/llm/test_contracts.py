"""Every registered corpus query: its columns, their types, one row per input row where the contract says so."""

import zlib

import pytest

from lodestar.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op2_balanced_shards": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op3_pack": "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint",
    "op4_token_count": "doc_id:bigint n_bytes:bigint n_tokens:bigint over_limit:boolean",
    "op5_embedding_dedup": "vec_id:bigint n_links:bigint component_id:bigint kept:boolean",
    "op6_quality": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op7_language": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op8_simhash_dedup": "doc_id:bigint fingerprint:string component_id:bigint",
    "op9_mix": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    "op10_minhash": "doc_id:bigint n_chars:bigint edited_sha256:string fingerprint:string edited_fingerprint:string "
                    "near_edited:double near_next:double",
    "op11_hard_negatives": "anchor_id:bigint positive_id:bigint rank:int negative_id:bigint positive_score:bigint negative_score:bigint",
    "op12_merkle_manifest": "doc_id:bigint leaf:string subroot:string root:string proof_sha256:string folded_root:string verified:boolean",
    "op13_personal_data": "doc_id:bigint n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
}
PER_ROW = ["op2", "op4", "op6", "op7", "op8", "op9", "op10", "op12", "op13"]


@pytest.fixture(scope="module")
def results(spark):
    return {name: (dict(df.dtypes), df.collect()) for name in COLUMNS for df in [QUERIES[name](spark, SF)]}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_types(results, name):
    types, rows = results[name]
    want = dict(c.split(":") for c in COLUMNS[name].split())
    assert {c: types.get(c) for c in want} == want and rows


@pytest.mark.parametrize("op", PER_ROW)
def test_one_row_per_document(results, documents, op):
    name = next(n for n in COLUMNS if n.startswith(op + "_"))
    assert sorted(r.doc_id for r in results[name][1]) == sorted(r.doc_id for r in documents.collect())


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_folds_and_cuts(results):
    for r in results["op6_quality"][1]:
        assert r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    for r in results["op7_language"][1]:
        assert r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1
    for r in results["op4_token_count"][1]:
        assert r.over_limit == (r.n_tokens > 1024)


def test_shards_sizes_and_slots(results, documents):
    text = {r.doc_id: r.text for r in documents.collect()}
    slots, loads = {}, {}
    for r in results["op2_balanced_shards"][1]:
        raw = (text[r.doc_id] or "").encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw) and r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
        loads[r.shard] = loads.get(r.shard, 0) + r.size
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_fingerprints_are_hex_and_equal_for_equal_texts(results, documents):
    text = {r.doc_id: r.text for r in documents.collect()}
    for name, pattern in (("op8_simhash_dedup", 16), ("op10_minhash", None)):
        by = {}
        for r in results[name][1]:
            if pattern:
                assert len(r.fingerprint) == pattern and r.fingerprint == format(int(r.fingerprint, 16), "016x")
            assert by.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in results["op10_minhash"][1])


def test_sequences_hold_at_most_2048_tokens_without_gaps(results):
    places = {}
    for r in results["op3_pack"][1]:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048


def test_mix_takes_at_most_three_copies(results):
    for r in results["op9_mix"][1]:
        assert 0 <= r.taken <= 3 * r.size and r.target <= 3 * r.source_size + 1e-6


def test_license_query(spark):
    df = QUERIES["op1_license_scan"](spark, SF)
    assert df.columns == ["doc_id", "license", "coverage", "matched_words", "first_word", "end_word"]
    assert all(0.8 <= r.coverage <= 1 and r.first_word < r.end_word for r in df.collect())
