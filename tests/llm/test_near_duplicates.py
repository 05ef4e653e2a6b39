from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom import session
from clickloom.llm import common, components, embedding_dedup, simhash
from tests.llm import cases


def roots(nodes, pairs):
    """The smallest reachable node of each."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(n, n + 1) for n in range(1000, 1060)] + [(2000, 2000 + n) for n in range(1, 90)]
    pairs += [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    pairs += [(5000, 5000), pairs[0], pairs[0][::-1]]
    want = {n: r for n, r in roots({n for p in pairs for n in p}, pairs).items() if n != 5000}
    rows = spark.createDataFrame([*pairs, (None, 7)], "a bigint, b bigint").repartition(5)
    got = components.components(rows)
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    found = {r.node: r.component for r in got.collect()}
    assert found == {n: want[n] for n in linked} and got.count() == len(found)
    assert components.components(rows.limit(0)).count() == 0


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for mark in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(mark, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "É", " ", "\n", "\x1c", " ", "中", "\t"]), max_size=25).map("".join))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_golay_words_cover_all():
    words, nearest = simhash.golay()
    assert (nearest >= 0).all() and len(set(words.tolist())) == 4096
    every = np.arange(1 << 23)
    assert (np.bitwise_count(every ^ words[nearest]) <= 3).all()


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_near_points_meet_at_an_anchor(parts):
    rng = np.random.default_rng(parts)
    points = rng.integers(-(2**63), 2**63 - 1, 400, np.int64)
    flipped = points.copy()
    for n in range(len(points)):
        for bit in rng.choice(64, rng.integers(0, 3), replace=False).tolist():
            flipped[n] ^= np.array([1 << bit], np.uint64).view(np.int64)[0]
    which, anchor, home = simhash.anchors(points, 2, parts)
    own = dict(zip(which[home].tolist(), anchor[home].tolist()))
    which, anchor, _ = simhash.anchors(flipped, 2, parts)
    near = set(zip(which.tolist(), anchor.tolist()))
    assert all((n, own[n]) in near for n in range(len(points)))


def clusters(rng, n):
    """Points of which many are within a few bits of each other."""
    centres = [rng.getrandbits(64) for _ in range(5)] + [0]
    points = set()
    for _ in range(n):
        point = rng.choice(centres)
        for _ in range(rng.randrange(5)):
            point ^= 1 << rng.randrange(64)
        points.add(point)
    return sorted(points)


@pytest.mark.parametrize("n", [30, 700])
def test_point_links(spark, n):
    points = clusters(random.Random(n), n)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    pairs = [(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 2]
    rows = spark.createDataFrame([(s,) for s in signed], "point bigint")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.point_links(rows).collect()]
    assert set(map(frozenset, found)) <= set(map(frozenset, pairs))
    assert roots(points, found) == roots(points, pairs)


def test_anchors_are_dealt_by_the_bytes_of_the_points(spark, tmp_path, monkeypatch):
    points = clusters(random.Random(3), 300)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    spark.createDataFrame([(s,) for s in signed], "point bigint").write.parquet(str(tmp_path / "points"))
    rows = spark.read.parquet(str(tmp_path / "points"))
    monkeypatch.setattr(common, "SHUFFLE_PARTITION_BYTES", session.bytes_read(rows))
    plan = simhash.point_links(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"anchor#\d+L\], 12\d\b", plan)
    pairs = [(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 2]
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.point_links(rows).collect()]
    assert roots(points, found) == roots(points, pairs)


def test_crowded_anchor_without_all_pairs():
    points = clusters(random.Random(9), 500)
    assert len(points) > simhash.CROWDED
    signed = np.asarray(points, np.uint64).view(np.int64)
    found = simhash.anchor_links(signed, np.ones(len(points), bool), 2)
    pairs = [(i, j) for i, a in enumerate(points) for j, b in enumerate(points[:i]) if (a ^ b).bit_count() <= 2]
    assert roots(range(len(points)), found) == roots(range(len(points)), pairs)


def test_near_duplicate_documents(spark):
    texts = cases.awkward_texts()
    texts += [texts[12] + " one more", texts[12].replace("alpha1 ", "alpha2 ", 1), texts[20], texts[20]]
    rows = cases.odd_rows(spark, texts)
    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in rows.collect()]
    prints = {p for _, p in docs}
    group = roots(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2])
    smallest = {}
    for doc_id, p in docs:
        if doc_id is not None:
            smallest[group[p]] = min(doc_id, smallest.get(group[p], doc_id))
    want = sorted((str(d), f"{p:016x}", smallest.get(group[p])) for d, p in docs)
    got = simhash.near_duplicates(rows).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(rows.limit(0)).count() == 0


def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for label in (0, 1):
        centre = rng.normal(size=24)
        for n in range(60):
            close = n % 3 == 0
            vector = centre + rng.normal(size=24) * 0.12 if close else rng.normal(size=24)
            rows.append((vector * (1 + n), label))
    rows += [(rows[0][0], 0)] * 4 + [(rows[0][0], 1), (rows[0][0] * 2, 0)]
    as_lists = [(v.astype("f4").tolist(), label) for v, label in rows]
    as_lists += [([0.0] * 24, 0), (None, 0), ([], 0), ([float("nan")] * 24, 0), ([float("inf")] * 24, 0)]
    as_lists += [([None] * 24, 0), (as_lists[0][0], None), (as_lists[0][0][:5], 0), ([1e-30] * 5, 0), ([1e30] * 5, 0)]
    return [(n, v, label, 1) for n, (v, label) in enumerate(as_lists)]


def usable(vector, label):
    return label is not None and bool(vector) and None not in vector and np.isfinite(vector).all() and any(vector)


@pytest.mark.parametrize("tile", [2048, 7])
def test_embeddings(spark, tile):
    rows = vectors()
    pairs = []
    for i, v, a, _ in rows:
        for j, w, b, _ in rows:
            if i < j and a == b and usable(v, a) and usable(w, b) and len(v) == len(w):
                x, y = np.asarray(v, float), np.asarray(w, float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    pairs.append((i, j))
    assert 100 < len(pairs) < 2000
    group = roots(range(len(rows)), pairs)
    want = [(n, sum(n in p for p in pairs), group[n], group[n] == n) for n in range(len(rows))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, key int").repartition(4)
    got = embedding_dedup.near_duplicates(frame, tile_vectors=tile)
    assert sorted(map(tuple, got.collect())) == want
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_repeated_vector_rows(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (4, [2.0, -1.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted(map(str, map(tuple, embedding_dedup.near_duplicates(frame).collect())))
    assert got == sorted(["(1, 2, 1, True)"] * 2 + ["(None, 2, 1, False)", "(4, 0, 4, True)"])


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10**6))
def test_error_bound_holds(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(40, 9)) ** 3
    vectors[20:] = vectors[:20] + rng.normal(size=(20, 9)) * 0.05
    table = [rng.bytes(16) for _ in vectors]
    import pyarrow as pa

    rows = pa.table({
        "key": table, "copies": [1] * 40, "data": [v.astype("<f8").tobytes() for v in vectors],
        "label": ["a"] * 40, "width": [9] * 40, "tile": [0] * 40, "tiles": [1] * 40,
    })
    tile = embedding_dedup.make_tile(rows).to_pylist()[0]
    quantised = (tile["steps"], tile["scales"], tile["errors"])
    maybe = embedding_dedup.possible(quantised, quantised, 9, 0.98)
    units = embedding_dedup.unit(np.frombuffer(tile["data"], "<f8").reshape(40, 9))
    assert (maybe | (units @ units.T < 0.98)).all()
    assert maybe.mean() < 0.5
