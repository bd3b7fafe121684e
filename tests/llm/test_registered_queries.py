"""The registered queries on the smallest tables: SQL where there is some, else what their contracts say."""

from __future__ import annotations

import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tidegrid.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def tokens(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in texts.items()}


def test_all_operators_and_the_pipeline_are_registered():
    names = [n.split("_")[0] for n in QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    from check_queries import compare, connect

    assert compare(QUERIES[name](spark, SF).toPandas(), connect(SF).execute(ORACLES[name]).df()) == ""


def test_packed_pieces(spark, tokens):
    rows = QUERIES["op1_packing"](spark, SF).collect()
    got, fill = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append(r)
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, ids in tokens.items():
        whole, at = np.array([*ids, 2], "<u4"), 0
        for r in sorted(got[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(whole)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(whole[r["start"]:at].tobytes())
        assert at == len(whole)
    sizes = []
    for own in fill.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(s <= 4096 and s & (s - 1) == 0 for s in sizes) and np.mean(np.array(sizes) == 4096) > 0.8


def test_counted_tokens(spark, texts, tokens):
    rows = {r["doc_id"]: r for r in QUERIES["op9_token_counts"](spark, SF).collect()}
    assert {d: r["n_tokens"] for d, r in rows.items()} == {d: len(i) for d, i in tokens.items()}
    assert all(r["n_bytes"] == len(texts[d].encode()) and r["over_limit"] == (len(tokens[d]) > 2048) for d, r in rows.items())


def test_quality_verdicts_follow_the_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    scored = {r["doc_id"]: r for r in QUERIES["op8_quality_model"](spark, SF).collect()}
    judged = {r["doc_id"]: r for r in QUERIES["op2_quality_rules"](spark, SF).collect()}
    unseen = [d for d in labels if scored[d]["held_out"]]
    assert np.mean([scored[d]["predicted"] == labels[d] for d in unseen]) > 0.9
    assert all(judged[d]["kept"] for d in labels if labels[d] and not judged[d]["base_failed"])


def test_leaks_and_licences_are_found(spark, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_decontamination"](spark, SF).collect()}
    assert {(d, i) for d, t in texts.items() for i, x in items.items() if x in t} <= found
    licensed = {r["doc_id"]: r["families"] for r in QUERIES["op10_license_scan"](spark, SF).collect()}
    assert set(licensed) == set(texts)
    assert all(("MIT" in licensed[d]) == ("MIT License" in t) for d, t in texts.items())
