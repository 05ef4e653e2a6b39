"""SimHash near-duplicates by anchor-point covering.

A fingerprint's 64 bits, and five fixed zeros, are three words of the binary Golay code's length. Every 23-bit word
is within 3 bits of exactly one code word, so the code words of the parts are anchors that cover all fingerprints. If
fingerprints x and y differ in at most t bits, and a is x's anchor, then y's part i is within 3 + t_i bits of a's part
i, with the t_i adding up to at most t. So each fingerprint goes to its own anchor and to all anchors within the
covering radius plus the threshold, shared out over the parts in every way; fingerprints are compared at each anchor,
and no link can be missed. At a crowded anchor candidates are found by equal bands instead of all against all: of
t + 1 bands two fingerprints that link have one in common.

Equal fingerprints are one point before all that. A task gives the links of an anchor as a forest, never all pairs.

Null and empty texts have fingerprint zero and link like any other. Repeated rows and ids are kept; rows with null
``doc_id`` get a fingerprint, but no component id of their own. An empty table gives no rows. Input columns other than
``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import SLICE_ROWS, batch_of, map_rows, partitions, stored, whole_text
from clickloom.llm.components import components
from clickloom.session import bytes_read

SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
#: The generator polynomial of the binary Golay code of length 23, dimension 12, covering radius 3.
GOLAY, LENGTH, DIMENSION, RADIUS = 0b101011100011, 23, 12, 3
#: Parts of the padded fingerprint that are coded; any number finds all links, more parts make anchors less crowded.
PARTS = 3
#: Points of an anchor that are compared all against all.
CROWDED = 64


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text: a bit is 1 if more than half of the shingles' hashes have it."""
    words = text.encode().lower().split()  # bytes: A-Z and the white space of ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(shingle_words, len(words))
    starts, stops = (ends - lengths)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    hash_of = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(starts)
    for first in range(0, total, 1 << 16):
        spans = zip(starts[first : first + (1 << 16)], stops[first : first + (1 << 16)])
        hashes = np.asarray([hash_of(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


POINT = "simhash_point"


def fingerprint_rows(batches: Iterator[pa.RecordBatch], shingle_words: int, passed: list[str]) -> Iterator[pa.RecordBatch]:
    """The passed columns with the fingerprint of the text, as a signed number."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            values = [fingerprint(text or "", shingle_words) for text in part["text"].to_pylist()]
            points = pa.array(np.asarray(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(part[name] for name in passed), points], [*passed, POINT])


def with_points(documents: DataFrame, passed: list[str], shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The passed columns and each document's fingerprint."""
    fields = [documents.schema[name] for name in passed]
    schema = T.StructType([*fields, T.StructField(POINT, T.LongType())])
    rows = documents.select(*dict.fromkeys([*passed, "text"]))
    return map_rows(rows, partial(fingerprint_rows, shingle_words=shingle_words, passed=passed), schema)


@lru_cache(maxsize=1)
def errors() -> np.ndarray:
    """All 23-bit words of at most RADIUS bits."""
    flips = [bits for size in range(RADIUS + 1) for bits in combinations(range(LENGTH), size)]
    return np.asarray([sum(1 << bit for bit in bits) for bits in flips], np.int64)


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """The code words by number, and the nearest code word's number for each 23-bit word."""
    words = np.zeros(1 << DIMENSION, np.int64)
    for bit in range(DIMENSION):
        words[1 << bit : 2 << bit] = words[: 1 << bit] ^ (GOLAY << bit)
    nearest = np.full(1 << LENGTH, -1, np.int16)
    for number, word in enumerate(words.tolist()):
        nearest[errors() ^ word] = number
    return words, nearest


@lru_cache(maxsize=1)
def near_words(extra: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each e from 1: for a word, how to reach the code words at distance RADIUS + e, by its error's number.

    The distances from a word to all code words depend on its error alone (the code is linear): code word c is as far
    from word w = n ^ error as c ^ n from the error. Gives, for each error, the numbers of the code words at that
    distance, as one array and the bounds of each error's share.
    """
    words, _ = golay()
    tables = []
    for distance in range(RADIUS + 1, RADIUS + extra + 1):
        found = [np.flatnonzero(np.bitwise_count(words ^ error) == distance) for error in errors()]
        tables.append((np.concatenate(found), np.cumsum([0, *map(len, found)])))
    return tables


@lru_cache(maxsize=1)
def error_numbers() -> np.ndarray:
    """The place of each error among all errors within the radius, by its bits."""
    numbers = np.full(1 << LENGTH, -1, np.int16)
    numbers[errors()] = np.arange(len(errors()))
    return numbers


def part_anchors(words: np.ndarray, extra: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each e to ``extra``: which word, and the number of each of its code words at distance RADIUS + e (at e = 0:
    the nearest one)."""
    code, nearest = golay()
    home = nearest[words].astype(np.int64)
    error = error_numbers()[words ^ code[home]]
    found = [(np.arange(len(words)), home)]
    for numbers, bounds in near_words(extra):
        share = bounds[error + 1] - bounds[error]
        which = np.repeat(np.arange(len(words)), share)
        at = np.arange(share.sum()) - np.repeat(np.cumsum(share) - share, share) + np.repeat(bounds[error], share)
        # Numbers add like words: the code is linear.
        found.append((which, numbers[at] ^ home[which]))
    return found


def pair_up(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n: int):
    """All combinations of anchors of the same word, from two lists sorted by word."""
    counts = np.bincount(right[0], minlength=n)
    starts = np.cumsum(counts) - counts
    share = counts[left[0]]
    which = np.repeat(left[0], share)
    at = np.arange(share.sum()) - np.repeat(np.cumsum(share) - share, share) + np.repeat(starts[left[0]], share)
    return which, (np.repeat(left[1], share) << DIMENSION) | right[1][at]


def anchors(points: np.ndarray, max_bits: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which point, anchor, and whether the anchor is the point's own."""
    values, mask, n = points.view(np.uint64), np.uint64((1 << LENGTH) - 1), len(points)
    by_part = [part_anchors(((values >> np.uint64(LENGTH * p)) & mask).astype(np.int64), max_bits) for p in range(parts)]
    which, anchor, home = [], [], []
    for shares in product(range(max_bits + 1), repeat=parts):
        if sum(shares) <= max_bits:
            found = by_part[0][shares[0]]
            for p in range(1, parts):
                found = pair_up(found, by_part[p][shares[p]], n)
            which.append(found[0])
            anchor.append(found[1])
            home.append(np.full(len(found[0]), not any(shares)))
    return tuple(map(np.concatenate, (which, anchor, home)))


@lru_cache(maxsize=4)
def anchors_of_one(max_bits: int, parts: int) -> float:
    """Anchors that a point goes to, on average."""
    some = np.random.default_rng(SEED).integers(-(1 << 63), (1 << 63) - 1, 256)
    return len(anchors(some, max_bits, parts)[0]) / len(some)


#: Points that are dealt to their anchors at a time.
DEALT_POINTS = 2048


def deal(batches: Iterator[pa.RecordBatch], max_bits: int, parts: int) -> Iterator[pa.RecordBatch]:
    names, types = ["anchor", "home", "point"], [pa.int64(), pa.bool_(), pa.int64()]
    for batch in batches:
        every = batch.column(0).to_numpy()
        for start in range(0, len(every), DEALT_POINTS):
            points = every[start : start + DEALT_POINTS]
            which, anchor, home = anchors(points, max_bits, parts)
            yield batch_of([anchor, home, points[which]], types, names)


class Forest:
    """Union-find over numbered points."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, node: int) -> int:
        while self.parent[node] != node:
            self.parent[node] = self.parent[self.parent[node]]
            node = self.parent[node]
        return node

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart until now."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def close_pairs(values: np.ndarray, home: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of points that differ in few bits, one of the two being at home; a block at a time."""
    n = len(values)
    if n <= CROWDED:
        i, j = np.triu_indices(n, 1)
        near = (np.bitwise_count(values[i] ^ values[j]) <= max_bits) & (home[i] | home[j])
        yield i[near], j[near]
        return
    bounds = np.linspace(0, 64, max_bits + 2).astype(int).tolist()
    for low, high in zip(bounds, bounds[1:]):
        band = (values >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
        order = np.argsort(band, kind="stable")
        band, held, own = band[order], values[order], home[order]
        for lag in range(1, n):
            same = np.flatnonzero(band[lag:] == band[:-lag])
            if not len(same):
                break
            near = np.bitwise_count(held[same] ^ held[same + lag]) <= max_bits
            same = same[near & (own[same] | own[same + lag])]
            yield order[same], order[same + lag]


def anchor_links(points: np.ndarray, home: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A forest of the links among the points of one anchor, as places in ``points``.

    A pair is looked at where one of the two is at home, which is once or twice, not at each anchor that both are near.
    """
    forest = Forest(len(points))
    pairs = close_pairs(points.view(np.uint64), home, max_bits)
    return [(a, b) for i, j in pairs for a, b in zip(i.tolist(), j.tolist()) if forest.join(a, b)]


def compare(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links at each anchor; the rows come sorted by anchor, and an anchor may run over several batches."""
    held = [np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        held = [np.concatenate(pair) for pair in zip(held, columns)]
        last = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        yield found_links([column[:last] for column in held], max_bits)
        held = [column[last:] for column in held]
    yield found_links(held, max_bits)


def found_links(held: list[np.ndarray], max_bits: int) -> pa.RecordBatch:
    anchor, home, points = held
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(anchor)])
    # Anchors with two or more points, one of them at home.
    at_home = np.add.reduceat(home, starts, dtype=np.int64) if len(starts) else sizes
    links: list[list[int]] = [[], []]
    few = (sizes == 2) & (at_home > 0)
    first = starts[few]
    near = first[np.bitwise_count((points[first] ^ points[first + 1]).view(np.uint64)) <= max_bits]
    links[0] += points[near].tolist()
    links[1] += points[near + 1].tolist()
    for start, size in zip(*(v[(sizes > 2) & (at_home > 0)].tolist() for v in (starts, sizes))):
        own = points[start : start + size]
        for a, b in anchor_links(own, home[start : start + size], max_bits):
            links[0].append(int(own[a]))
            links[1].append(int(own[b]))
    return batch_of(links, [pa.int64(), pa.int64()], ["a", "b"])


def point_links(points: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct points that differ in at most ``max_bits`` bits."""
    spark, stored_bytes = points.sparkSession, bytes_read(points)
    spread = points.repartition(partitions(spark, stored_bytes), "point")
    dealt = map_rows(spread, partial(deal, max_bits=max_bits, parts=parts), "anchor bigint, home boolean, point bigint")
    moved = int(stored_bytes * anchors_of_one(max_bits, parts))
    by_anchor = dealt.repartition(partitions(spark, moved), "anchor").sortWithinPartitions("anchor")
    return map_rows(by_anchor, partial(compare, max_bits=max_bits), "a bigint, b bigint").distinct()


def point_groups(points: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS) -> DataFrame:
    """``simhash_point, component`` of distinct points; the component is one of its points."""
    found = components(point_links(points.select(F.col(POINT).alias("point")), max_bits, parts))
    joined = points.join(found, points[POINT] == found["node"], "left")
    return joined.select(points["*"], F.coalesce("component", POINT).alias("component"))


def near_duplicates(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, parts: int = PARTS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each document; the component is the smallest id reachable by links."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    prints = stored(spark, "fingerprints", with_points(rows, ["doc_id"], shingle_words))
    points = stored(spark, "points", prints.groupBy(POINT).agg(F.min("doc_id").alias("first_id")))
    groups = point_groups(points, max_bits, parts)
    # A table of its own: the join's two sides come straight from their shuffles, so a large component can be split.
    smallest = stored(spark, "smallest", groups.groupBy("component").agg(F.min("first_id").alias("component_id")))
    named = groups.join(smallest, "component").select(POINT, "component_id")
    return prints.join(named, POINT).select(
        "doc_id", F.lower(F.lpad(F.hex(POINT), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, parts: int = PARTS
) -> DataFrame:
    """One document of each component: that of the smallest ``doc_id``, null last; of repeated rows, one.

    All columns are passed through. The documents are stored once with a row id, which tells repeated rows apart.
    """
    spark, row_id = documents.sparkSession, "simhash_row_id"
    pointed = with_points(documents, documents.columns, shingle_words)
    rows = stored(spark, "rows", pointed.withColumn(row_id, F.monotonically_increasing_id()))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col(row_id))
    points = stored(spark, "points", rows.groupBy(POINT).agg(F.min(order).alias("first")))
    kept = point_groups(points, max_bits, parts).groupBy("component").agg(F.min("first").alias("first"))
    return rows.join(kept.select(f"first.{row_id}"), row_id, "left_semi").select(*documents.columns)
