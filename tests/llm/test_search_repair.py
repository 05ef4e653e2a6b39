"""Ranked lexical search, exact top-k search and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from clickloom.llm import ball_trees, conversation_repair, norm_buckets
from tests.llm.cases import awkward_texts, odd_rows, sentence

# Ranked lexical search


def terms_of(text: str | None) -> list[str]:
    small = (text or "").translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small)


def brute_rank(documents: list[tuple], items: list[tuple], best: int = 10) -> Counter:
    bags = [(doc_id, Counter(terms_of(text))) for doc_id, text in documents]
    n_docs, total = sum(1 for _, bag in bags if bag), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            score, n = 0, sum(bag.values())
            for term in set(terms_of(text)) & set(bag):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 100 - 90 + (90 * n * n_docs) // total
                score += weight * ((10**9 * bag[term]) // (1000 * bag[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scored)[:best], 1):
            found.append((item_id, rank, None if none else doc_id, -score))
    return Counter(found)


def ranked(spark, documents, items: list[tuple], **settings) -> Counter:
    asked = spark.createDataFrame([(*item, 1, "x") for item in items], "item_id bigint, text string, rank int, score string")
    return Counter(map(tuple, norm_buckets.rank(documents, asked, **settings).collect()))


ITEMS = [
    (1, "alpha12 Gamma3 the7, unknownword THE7 épée5"), (2, None), (3, ""), (None, "beta4 of9 the1"), (5, "no such terms"),
    (1, "alpha12 Gamma3 the7, unknownword THE7 épée5"), (7, "中文 text mixed ıi"), (8, " ".join(f"{w}{n}" for w in ("alpha", "of", "the") for n in range(60))),
]


@pytest.mark.parametrize("settings", [{}, {"bucket_documents": 3, "seed_every": 2, "block_bytes": 100}])
def test_ranks_equal_brute_force(spark, settings):
    documents = odd_rows(spark, awkward_texts())
    rows = [(row.doc_id, row.text) for row in documents.collect()]
    assert ranked(spark, documents, ITEMS, **settings) == brute_rank(rows, ITEMS)


def test_a_third_of_equal_documents_ranks_by_id(spark):
    rng = random.Random(3)
    texts = ["alpha1 beta2 the3"] * 60 + [sentence(rng, rng.randrange(1, 60)) for _ in range(120)]
    rows = list(enumerate(texts))
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    items = [(1, "alpha1 beta2"), (2, "the3 of4 of5")]
    assert ranked(spark, documents, items, bucket_documents=16) == brute_rank(rows, items)


def test_rank_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    blank = spark.createDataFrame([(1, " .;"), (2, None)], "doc_id bigint, text string")
    assert not ranked(spark, none, ITEMS) and not ranked(spark, blank, ITEMS)
    assert norm_buckets.rank(blank, none.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_long_texts_are_cut_into_terms_in_pieces(monkeypatch):
    text = sentence(random.Random(1), 3000)
    whole = norm_buckets.term_counts(text)
    monkeypatch.setattr(norm_buckets, "PIECE_BYTES", 7)
    assert norm_buckets.term_counts(text) == whole == (len(terms_of(text)), Counter(t.encode() for t in terms_of(text)))


def random_bucket(rng: np.random.Generator, n: int, terms: int) -> dict:
    vectors = [np.sort(rng.choice(terms, rng.integers(1, 12), replace=False)) for _ in range(n)]
    impacts = [rng.integers(1, 10**9, len(v)) for v in vectors]
    lengths = np.array([math.sqrt(float((i.astype(float) ** 2).sum())) for i in impacts])
    return {
        "greatest": lengths.max(), "doc_ids": np.arange(n, dtype="<i8").tobytes(), "no_ids": np.zeros(n, "u1").tobytes(),
        "lengths": lengths.tobytes(), "starts": np.cumsum([0, *map(len, vectors)]).astype("<i8").tobytes(),
        "terms": np.concatenate(vectors).astype("<i4").tobytes(), "impacts": np.concatenate(impacts).astype("<i8").tobytes(),
    }


def test_coordinate_bounds_leave_out_documents_but_never_one_that_reaches(monkeypatch):
    monkeypatch.setattr(norm_buckets, "FEW", 0)
    rng = np.random.default_rng(4)
    bucket = norm_buckets.Bucket(random_bucket(rng, 400, 50))
    left = 0
    for _ in range(40):
        terms = np.sort(rng.choice(60, 8, replace=False))
        asked = np.isin(np.arange(60), terms)
        scores = bucket.scores(np.arange(400), asked)
        least = int(np.sort(scores)[-10])
        kept = bucket.may_reach(terms, least)
        assert set(np.flatnonzero(scores >= least)) <= set(kept.tolist())
        left += len(kept)
    assert left < 40 * 400 / 4


def test_buckets_too_short_are_not_opened(spark, monkeypatch):
    rng = np.random.default_rng(4)
    row, opened = random_bucket(rng, 50, 20), []
    row |= {"bucket": 1}
    batch = norm_buckets.pa.RecordBatch.from_pylist([row])

    class Sent:
        value = [np.arange(4)]

    monkeypatch.setattr(norm_buckets, "Bucket", lambda row: opened.append(row))
    least = [int(row["greatest"] * 2 * 1.01)]
    (found,) = norm_buckets.search(iter([batch]), Sent, 20, least, 10)
    assert not opened and found.num_rows == 0


# Exact top-k search


def brute_products(rows: list[tuple], every: int, best: int = 10) -> Counter:
    usable = []
    for place, (vec_id, vector) in enumerate(rows):
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((place, vec_id, [math.floor(1024 * x) for x in vector]))
    found = []
    for place, vec_id, vector in usable:
        if vec_id % every == 0:
            scored = []
            for other, other_id, values in usable:
                if other != place and len(values) == len(vector):
                    score = sum(a * b for a, b in zip(vector, values))
                    scored.append((-max(min(score, 2**63 - 1), 1 - 2**63), other_id))
            found += [(vec_id, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:best], 1)]
    return Counter(found)


def product_rows() -> list[tuple]:
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((4, 6))
    rows = [(n, (centres[n % 4] + 0.1 * rng.standard_normal(6)).tolist()) for n in range(150)]
    rows += [(150 + n, [0.5, -0.25, 0.125, 0.0, 0.0, 1.0]) for n in range(60)]  # copies: ties
    rows += [(10, rows[10][1]), (10, rows[10][1]), (11, rows[11][1]), (None, rows[3][1]), (300, None), (301, [])]
    rows += [(310, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (320, [float("nan")] * 6), (330, [float("inf")] * 6), (340, []), (350, [0.0] * 6)]
    rows += [(360 + n, [float(n), 2.0, -1.0]) for n in range(20)]  # another length
    return rows


def top(spark, rows: list[tuple], every: int = 10, **settings) -> Counter:
    schema = "vec_id bigint, embedding array<double>, label int, rank int, score string, code string"
    frame = spark.createDataFrame([(*row, 1, 2, "s", "c") for row in rows], schema).repartition(4)
    return Counter(map(tuple, ball_trees.top_products(frame, every, **settings).collect()))


@pytest.mark.parametrize("settings", [{}, {"shard_vectors": 16, "leaf_vectors": 4, "block_queries": 3}])
def test_products_equal_brute_force(spark, settings):
    rows = product_rows()
    assert top(spark, rows, **settings) == brute_products(rows, 10)


def test_products_beyond_double_precision(spark):
    rng = np.random.default_rng(8)
    rows = [(n, (rng.standard_normal(3) * 10 ** rng.choice([0, 8, 13, 100, 300])).tolist()) for n in range(60)]
    assert top(spark, rows, 5, shard_vectors=16, leaf_vectors=4) == brute_products(rows, 5)


def test_products_of_nothing(spark):
    assert not top(spark, [(1, None)]) and not top(spark, [(1, [1.0]), (2, [2.0])])
    assert top(spark, [(10, [1.0])]) == Counter()
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert ball_trees.top_products(none, 10).count() == 0


def test_balls_below_the_current_score_are_left_out():
    rng = np.random.default_rng(1)
    centres = 1000 * rng.standard_normal((16, 8))
    vectors = np.floor(np.repeat(centres, 64, axis=0) + 10 * rng.standard_normal((1024, 8)))
    ids = np.arange(1024)
    tree = ball_trees.BallTree.build(vectors, ids, ids, leaf=16)
    asked = ball_trees.asked_of(vectors[::64].copy(), ids[::64], 5)
    made = ball_trees.search(tree, asked, np.arange(16), leaf=16)
    assert made < 16 * 1024 / 4
    for n in range(16):
        scores = vectors @ vectors[64 * n]
        order = [i for i in np.lexsort((ids, -scores)) if i != 64 * n][:5]
        assert asked.ids[n].tolist() == order


# Conversation repair

COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}


@lru_cache(maxsize=None)
def brute_edits(rows: tuple, state: int = 0) -> tuple[int, str]:
    """Cheapest edits, then least initials, by trying all of them. rows: (initial, gone, truncated)."""
    follows = {0: "su", 1: "u", 2: "a", 3: "u"}
    goes = {"s": 1, "u": 2, "a": 3}
    if not rows:
        return [(0, ""), (10, "II"), (5, "I"), (0, "")][state]

    def row_edits(state: int):
        (initial, gone, cut), rest = rows[0], rows[1:]
        yield 2, "D", state
        if not gone:
            if initial in follows[state]:
                yield 5 * cut, "K", goes[initial]
            yield 1 + 5 * cut, "R", goes[follows[state][-1]]

    found = []
    for inserted in range(3):
        for cost, edit, then in row_edits(state):
            rest = brute_edits(rows[1:], then)
            found.append((5 * inserted + cost + rest[0], "I" * inserted + edit + rest[1]))
        state = goes[follows[state][-1]]
    return min(found)


KINDS = [*itertools.product("sua?", [False], [False, True]), ("u", True, False)]


def test_tables_give_the_cheapest_and_least_edits():
    tables = conversation_repair.tables()
    rng = random.Random(1)
    cases = [case for n in range(4) for case in itertools.product(KINDS, repeat=n)]
    cases += [tuple(rng.choices(KINDS, k=rng.randrange(4, 60))) for _ in range(1500)]
    for case in cases:
        symbols = bytes(conversation_repair.symbol_of(initial, gone, cut) for initial, gone, cut in case)
        assert tables.repair(symbols) == brute_edits(case), case


def test_blocks_of_any_length_agree():
    rng = random.Random(2)
    other = conversation_repair.Tables(block_rows=3)
    for _ in range(200):
        symbols = bytes(rng.randrange(conversation_repair.SYMBOLS) for _ in range(rng.randrange(50)))
        assert conversation_repair.tables().repair(symbols) == other.repair(symbols)
    assert len(other.vectors) < 200


def brute_repair(rows: list[tuple]) -> list[tuple]:
    found: dict = defaultdict(list)
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        order = (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest())
        found[conv_id] += [(order, turn, role, text)] * {0: 0, 3: 2}.get(code, 1)
    out = []
    for conv_id, own in found.items():
        seen, kinds, counts, illegal, last = set(), [], Counter(), 0, None
        for _, _, role, text in sorted(own, key=lambda row: row[0]):
            stripped = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not stripped else "again" if (role, text) in seen else "" if stripped[-1] in ".!?" else "cut"
            seen.add((role, text))
            counts[fault] += 1
            illegal += last is not None and last + role[:1] not in ("su", "ua", "au")
            last = role[:1]
            kinds.append((role[:1] or "?", fault in ("blank", "again"), fault == "cut"))
        cost, audit = brute_edits(tuple(kinds))
        lines, state, left = [], "", [(role, text) for _, _, role, text in sorted(own, key=lambda row: row[0])]
        for edit in audit:
            role, text = ("", "") if edit == "I" else left.pop(0)
            if edit != "D":
                state = role[:1] if edit == "K" else "a" if state == "u" else "u"
                lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
        turns = [turn for _, turn, _, _ in own if turn is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        faults = (counts["blank"], counts["again"], counts["cut"])
        out.append((conv_id, min(gaps, 2**63 - 1), *faults, illegal, cost, audit, digest))
    return out


def conversation_rows() -> list[tuple]:
    rng = random.Random(7)
    texts = ["Yes.", "Why?", "no end", "", " \t\n", None, "Ok! \n", "…", "x" * 200_000 + ".", "中文。", "a.b"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "umpire"]
    rows = []
    for conv_id in [None, *range(60)]:
        for turn in range(rng.choice([1, 2, 5, 8, 30])):
            rows.append((conv_id, rng.choice([turn, turn, turn, 2 * turn, None]), rng.choice(roles), rng.choice(texts)))
    rows += [rows[5], rows[5], rows[80], (70, None, None, None), (71, -(2**63), "user", "a."), (71, 2**63 - 1, "assistant", "b.")]
    rows += [(72, n, "ua"[n % 2] + "x", f"{n}.") for n in range(300)]  # one conversation with a third of all rows
    return rows


def test_repair_equals_brute_force(spark):
    rows = conversation_rows()
    schema = "conv_id bigint, turn bigint, role string, text string, audit string, plan int, dropped string, text_key string"
    frame = spark.createDataFrame([(*row, "a", 1, "d", "k") for row in rows], schema).repartition(5)
    result = conversation_repair.repair(conversation_repair.damaged(frame))
    assert result.columns == conversation_repair.names_of(conversation_repair.RESULT)
    assert Counter(map(tuple, result.collect())) == Counter(brute_repair(rows))


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert conversation_repair.repair(conversation_repair.damaged(none)).count() == 0


def test_a_conversation_without_rows_after_damage(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(5, turn, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    (row,) = conversation_repair.repair(conversation_repair.damaged(frame)).collect()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
