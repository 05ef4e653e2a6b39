"""Registered queries without SQL, over a whole sample table, against brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickloom.llm import queries
from clickloom.llm.common import documents
from tests.llm.test_native import edits
from tests.llm.test_near_duplicates import brute_fingerprint, roots


@pytest.fixture(scope="module")
def rows(spark, samples_folder):
    return documents(spark, samples_folder).collect()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_fingerprint_query(spark, samples_folder, rows):
    found = queries.op1_minhash_fingerprints(spark, samples_folder).collect()
    wanted = [(doc_id, len(text), sha(edited.encode())) for doc_id, text, edited, _ in edits(rows)]
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(wanted)


def test_simhash_query(spark, samples_folder, rows):
    prints = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    group = roots(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    found = queries.op6_simhash_anchors(spark, samples_folder).collect()
    wanted = [(doc_id, f"{value:016x}", group[doc_id]) for doc_id, value in prints.items()]
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == sorted(wanted)


def test_encoding_query(spark, samples_folder, rows):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    wanted = []
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        wanted.append((r.doc_id, len(ids), sha(np.asarray(ids, "<u4").tobytes()), sha(decoded.encode())))
    found = queries.op9_bpe_chunk_reuse(spark, samples_folder).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(wanted)
