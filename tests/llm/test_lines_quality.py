"""Line dedup and quality."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import line_dedup, quality
from tests.llm import cases


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def often(texts, least):
    counts = Counter(k for text in texts for k in {key(line) for line in (text or "").split("\n")} if k)
    return {k for k, n in counts.items() if n >= least}


def without(text, gone):
    lines = (text or "").split("\n")
    return "\n".join(line for line in lines if key(line) not in gone)


def line_texts(n=120, seed=1):
    rng = random.Random(seed)
    lines = ["All rights reserved.", " all RIGHTS reserved.\t", "É one", "é one", "", "  ", "x", "中文", "\x85 x", "only\rhere"]
    texts = ["\n".join(rng.choice(lines) + rng.choice(["", "", str(rng.randrange(40))]) for _ in range(rng.randrange(9))) for _ in range(n)]
    return [*texts, None, "", "\n\n", "x\n" * 5000]


@pytest.mark.parametrize("least", [1, 10])
def test_repeated_lines_go(spark, least):
    rows = cases.odd_rows(spark, line_texts())
    all_rows = rows.collect()
    gone = often([r.text for r in all_rows], least)
    want = Counter()
    for r in all_rows:
        text = without(r.text, gone)
        lines = (r.text or "").split("\n")
        want[(r.doc_id, text, len(text), len(lines), sum(key(line) in gone for line in lines), r["count"])] += 1
    got = line_dedup.dedup_lines(rows, least)
    assert got.columns == [*rows.columns, "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text, r.n_chars, r.n_lines, r.n_dropped, r["count"]) for r in got.collect()) == want
    assert line_dedup.dedup_lines(rows.limit(0)).count() == 0


def contents(index):
    return {bytes(r.line): r.documents for r in index.counts.collect()}


@pytest.mark.parametrize("block_bytes", [line_dedup.BLOCK_BYTES, 1])
def test_index_is_reversible(spark, block_bytes):
    first, second = cases.documents(spark, line_texts(60, 2)), cases.documents(spark, line_texts(60, 3))
    index = line_dedup.LineIndex(spark, 5, shard_keys=4, block_bytes=block_bytes)
    assert [r.n_dropped for r in index.apply(second).collect()] == [0] * 64
    index.add(first)
    before, dropped = contents(index), sorted(index.apply(second).select("doc_id", "text").collect())
    index.add(second)
    both = [r.text for part in (first, second) for r in part.collect()]
    gone = often(both, 5)
    assert {r.doc_id: r.text for r in index.apply(second).collect()} == {
        r.doc_id: without(r.text, gone) for r in second.collect()
    }
    index.remove(second)
    assert contents(index) == before
    assert sorted(index.apply(second).select("doc_id", "text").collect()) == dropped
    index.remove(first)
    assert contents(index) == {} and index.apply(first).where("n_dropped > 0").isEmpty()
    index.remove(first)
    assert contents(index) == {}


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400))
def test_cuckoo_filter(seed, n):
    rng = random.Random(seed)
    keys = [rng.randbytes(16) for _ in range(n)]
    made = line_dedup.CuckooFilter.of(keys)
    assert all(k in made for k in keys)
    for k in keys[::2]:
        made.remove(k)
    assert all(k in made for k in keys[1::2])
    again = line_dedup.CuckooFilter(made.marks.tobytes())
    assert all(k in again for k in keys[1::2])
    assert sum(rng.randbytes(16) in made for _ in range(2000)) < 20
    for k in keys[1::2]:
        made.remove(k)
    assert not made.marks.any()


def test_full_filter_stays_as_it_was():
    rng = random.Random(1)
    small, held = line_dedup.CuckooFilter(bytes(2 * 4 * 4)), []
    while True:
        before, k = small.marks.copy(), rng.randbytes(16)
        if not small.add(k):
            break
        held.append(k)
    assert (small.marks == before).all() and all(k in small for k in held) and len(held) >= 8


def brute_marginals(evidence, chain):
    """All labelings of a document, one by one."""
    total, good, pairs = 0.0, np.zeros(len(evidence)), np.zeros((len(evidence), 2, 2))
    for labels in product((0, 1), repeat=len(evidence)):
        score = sum(e for e, label in zip(evidence, labels) if label)
        score += sum(chain[a, b] for a, b in zip(labels, labels[1:]))
        weight = np.exp(score)
        total += weight
        good += weight * np.asarray(labels)
        for n in range(1, len(labels)):
            pairs[n, labels[n - 1], labels[n]] += weight
    return good / total, pairs / total


def test_marginals_are_those_of_all_labelings():
    rng = np.random.default_rng(1)
    sizes = [1, 4, 2, 7, 1, 3]
    document = np.repeat(np.arange(len(sizes)), sizes)
    evidence, chain = rng.normal(size=len(document)) * 2, rng.normal(size=(2, 2))
    good, pairs = quality.marginals(evidence, document, chain)
    for n in range(len(sizes)):
        want, want_pairs = brute_marginals(evidence[document == n], chain)
        assert np.allclose(good[document == n], want) and np.allclose(pairs[document == n], want_pairs)


def test_measures():
    document, length, values = quality.measures([b"", "Éa b b!\n\nÉa b b!".encode(), b"| HI HI | 12,"])
    assert document.tolist() == [0, 1, 1, 1, 2] and length.tolist() == [0, 8, 0, 8, 13]
    assert np.isfinite(values).all() and values.shape == (5, quality.MEASURES)
    assert values[:, -2].tolist() == [0, 0, 0, 1, 0] and values[:, -1].tolist() == [1, 0, 1, 0, 0]
    again, loud, marked, lone = values[:, 9], values[:, 10], values[:, 11], values[:, 12]
    assert np.allclose(again, [0, 0, 0, 0, 1 / 5]) and np.allclose(loud, [0, 0, 0, 0, 2 / 5])
    assert np.allclose(lone, [0, 0, 0, 0, 2 / 5]) and np.allclose(marked, [0, 1 / 3, 0, 1 / 3, 2 / 5])


def labelled(spark, n=400):
    rng = random.Random(8)
    texts, marks = [], []
    for doc in range(n):
        good = doc % 3 > 0
        lines = [cases.sentence(rng, rng.randrange(3, 25)) for _ in range(rng.randrange(1, 9))]
        if not good:
            lines[1:] = [" ".join(w.upper() + "!!" for w in line.split()) for line in lines[1:]] + ["BUY!! NOW!! " * 20]
        texts.append("\n".join(lines))
        marks.append((doc, int(good), 0))
    return cases.documents(spark, texts), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def test_quality_of_held_out_documents(spark):
    rows, labels = labelled(spark)
    field = quality.learn(rows, labels)
    known = {r.doc_id: r.quality for r in labels.collect()}
    scores = quality.score(rows, field).select("doc_id", "score", quality.held_out().alias("held_out")).collect()
    held = [r for r in scores if r.held_out]
    assert {r.doc_id for r in held} == {d for d in known if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum((r.score >= quality.GOOD_FROM) == known[r.doc_id] for r in held) >= 0.97 * len(held)
    # Labels of held-out documents change nothing; neither does what the rows hold besides the text.
    turned = labels.withColumn("quality", (labels.quality + quality.held_out().cast("int")) % 2)
    again = quality.learn(rows.drop("lang", "source").withColumnRenamed("label", "quality"), turned)
    assert np.allclose(again.weights, field.weights) and np.allclose(again.chain, field.chain)


def test_long_documents_are_learned_from(spark, monkeypatch):
    rng = random.Random(9)
    dump = ["\n".join(" ".join("#" * rng.randrange(1, 9) for _ in range(9)) for _ in range(450)) for _ in range(20)]
    rows = cases.documents(spark, [*[cases.sentence(rng, 60) for _ in range(20)], *dump])
    labels = spark.createDataFrame([(n, int(n < 20), 0) for n in range(40)], "doc_id bigint, quality int, toxic int")
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda document, values, good: seen.append((document, good)) or fit(document, values, good))
    field = quality.learn(rows, labels)
    got = {r.doc_id: r.score for r in quality.score(rows, field).collect()}
    assert all((score >= quality.GOOD_FROM) == (n < 20) for n, score in got.items())
    document, good = seen[0]
    assert set(np.bincount(document)[good[np.searchsorted(document, range(document.max() + 1))] == 0]) == {quality.FIT_LINES}
    monkeypatch.setattr(quality, "FIT_TOTAL", 900)
    quality.learn(rows, labels)
    document, good = seen[1]
    assert (good == 0).sum() == 3 * quality.FIT_LINES


def test_scores_of_awkward_documents(spark):
    rows, labels = labelled(spark)
    field = quality.learn(rows, labels)
    odd = cases.odd_rows(spark, [*cases.awkward_texts(), "\n" * 30_000, "x " * 400_000])
    for used in (field, None):
        scored = quality.score(odd.withColumn("score", odd["doc_id"]), used)
        assert scored.columns == [*odd.columns, "score"]
        got = scored.collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
        by_text = {}
        for r in got:
            assert by_text.setdefault(r.text, r.score) == pytest.approx(r.score, abs=1e-9)
    assert quality.score(odd.limit(0), field).count() == 0
    assert quality.learn(rows, labels.limit(0)) is None
    clash = labels.unionByName(labels.selectExpr("doc_id", "1 - quality AS quality", "toxic"))
    assert quality.learn(rows, clash) is None


def any_field(seed=2):
    rng = np.random.default_rng(seed)
    width = quality.WIDTH
    return quality.Field(rng.normal(0, 0.3, width), rng.normal(0, 1, (2, 2)), rng.normal(0, 0.1, width), np.full(width, 0.7))


@settings(max_examples=60, deadline=None)
@given(lines=st.lists(st.sampled_from(["", "Éa b b!", "| HI |", "plain words here", "1 2 3", "x" * 30]), max_size=30), size=st.integers(1, 60))
def test_pieces_of_a_document_score_like_the_whole(lines, size):
    data, field = "\n".join(lines).encode(), any_field()
    document, length, values = quality.measures([data])
    good, _ = quality.marginals(field.evidence(quality.with_neighbours(document, values)), document, field.chain)
    want = (good * (length + 1)).sum() / (length + 1).sum()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "MEASURED_BYTES", size)
        pieces = list(quality.line_pieces(data))
        assert np.concatenate([p[0] for p in pieces]).tolist() == length.tolist()
        assert np.allclose(np.concatenate([p[1] for p in pieces]), values, rtol=0, atol=0)
        assert quality.long_score(data, field) == pytest.approx(want, abs=1e-9)
        assert quality.document_scores([data], field)[0] == pytest.approx(want, abs=1e-9)


def test_document_scores_by_all_labelings():
    texts, field = ["", "Éa b b!\nplain words here\n\n| HI |", "one line"], any_field()
    for text in texts:
        data = text.encode()
        document, _, values = quality.measures([data])
        evidence = field.evidence(quality.with_neighbours(document, values))
        weights = [len(line) + 1 for line in data.split(b"\n")]
        total = found = 0.0
        for labels in product((0, 1), repeat=len(weights)):
            power = sum(e for e, label in zip(evidence, labels, strict=True) if label)
            mass = np.exp(power + sum(field.chain[a, b] for a, b in zip(labels, labels[1:])))
            total += mass
            found += mass * sum(w for w, label in zip(weights, labels, strict=True) if label) / sum(weights)
        assert quality.document_scores([data], field)[0] == pytest.approx(found / total, abs=1e-9)


def test_one_text_of_each_repeated_id_is_learned_from(spark):
    rows, labels = labelled(spark)
    more = rows.unionByName(rows.withColumn("text", rows.text.substr(3, 40)))
    one, other = (quality.learn(more.repartition(n), labels) for n in (1, 7))
    assert np.array_equal(one.weights, other.weights) and np.array_equal(one.chain, other.chain)
