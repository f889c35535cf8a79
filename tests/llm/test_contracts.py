"""Every opN_ query on the smallest tables: its columns and types, and what its contract says of them."""

from __future__ import annotations

import hashlib
import re
import zlib

import pytest

from marlstone.llm.queries import QUERIES

D = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op2": "conv_id bigint, chunk bigint, n_lines bigint, n_turns bigint, n_turns_written bigint, n_roles_right bigint, rendered_sha256 string",
    "op3": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op5": "doc_id bigint, families string, n_licence_lines bigint, n_candidate_lines bigint, best_probability double",
    "op6": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op7": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op9": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10": "doc_id bigint, item_id bigint, score int, first_word int, last_word int",
}


@pytest.fixture(scope="module")
def results(spark):
    return {n.split("_")[0]: q(spark, D).cache() for n, (q, _) in QUERIES.items()}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{D}/documents.parquet").collect()}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(results, name):
    have = {f.name: f.dataType.simpleString() for f in results[name].schema}
    assert {c.split()[0]: c.split()[1] for c in COLUMNS[name].split(", ")}.items() <= have.items()


def test_one_row_a_document(results, texts):
    for name in ("op1", "op3", "op5", "op6", "op7", "op8", "op9"):
        assert sorted(r.doc_id for r in results[name].select("doc_id").collect()) == sorted(texts)


def test_media_digests(results, texts):
    for r in results["op1"].collect():
        raw = (texts[r.doc_id] or "").encode()
        pad = raw + bytes(-len(raw) % 64 or (64 if not raw else 0))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]))


def test_folds_and_scores(results, texts):
    for name, k, held, least in (("op3", 3, 1, 0.7), ("op7", 5, 0, 0.3)):
        for r in results[name].collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % k == held)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= least)
    for r in results["op6"].collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.n_tokens == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")) + 1
    held = [r for r in results["op6"].collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_roles_of_all_conversations(results, spark):
    got = results["op2"].groupBy().sum("n_turns_written", "n_roles_right").first()
    assert got[0] == spark.read.parquet(f"{D}/conversations.parquet").count() and got[1] >= 0.98 * got[0]


def test_components(results, texts):
    from test_pipeline import components, shingles

    root = components({i: shingles(t, 3) for i, t in texts.items()}, 85)
    for r in results["op8"].collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(shingles(texts[r.doc_id], 3)), root[r.doc_id], root[r.doc_id] == r.doc_id)
