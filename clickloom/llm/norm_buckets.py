"""Ranked lexical search over impact vectors in buckets by length.

A document's vector holds, for each term that any item asks for, the term's impact: its weight times the saturated number
of its occurrences, in whole numbers. An item's vector is 1 for each of its terms, so a score is an inner product. The
vectors are ordered by length and cut into buckets. For each item, a bucket is left out if by Cauchy and Schwarz no vector
of its length can reach the item's current k-th score. Inside a bucket, lists by term are added up from the largest
impacts down, and a document stays as long as what it has plus a bound on the rest (the largest impacts of the terms left
in this bucket, and the length that the document has left) can reach that score. What stays is scored again, exactly, in
whole numbers. The k-th scores are shared: some buckets are searched first, and all others start from what these gave; a
task goes on from bucket to bucket with what it has found.

Items are worked off in blocks of bounded size, which are sent to all tasks; a block costs one pass over the texts, each
of which is read whole, a bounded part at a time. Only terms of the block's items are ever shuffled, as numbers.

Null texts have no terms. A row is a document or an item of its own, so repeated rows rank next to each other, and repeated
items give their rows again. Null ids stay null; among equal scores documents without an id come last. Items without
terms, or without a document of theirs, give no rows; an empty table gives none. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import batch_of, map_rows, slices, stored, whole_text

BEST = 10
#: Documents of a bucket, and entries at which it is full earlier.
BUCKET_DOCUMENTS, BUCKET_ENTRIES = 4096, 1 << 20
#: One bucket in so many is searched before all others.
SEED_EVERY = 16
#: Bytes of the terms of a block of items.
BLOCK_BYTES = 4 * 1024 * 1024
#: Bytes of a text that are cut into terms at a time.
PIECE_BYTES = 1 << 20
#: Documents so few that they are scored again without looking further.
FEW = 32
#: Slack for the rounding of bounds, which are in double precision.
ROUNDING = 1e-9

#: Bytes of terms: digits, letters, all beyond ASCII; A-Z count as a-z, other bytes end a term.
TERM_BYTES = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else ord(" ") for b in range(256)
)

ITEM = "item_row bigint, item_id bigint, terms array<binary>"
BAG = "row_id bigint, doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
IMPACTS = "length double, row_id bigint, doc_id bigint, terms binary, impacts binary"
BUCKET = (
    "bucket bigint, greatest double, doc_ids binary, no_ids binary, lengths binary, starts binary, terms binary,"
    " impacts binary"
)
FOUND = "item int, doc_id bigint, score bigint"


def names_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def term_counts(text: str) -> tuple[int, Counter]:
    """How many terms a text has, and how often each."""
    data, counts, n, start = text.encode().translate(TERM_BYTES), Counter(), 0, 0
    while start < len(data):
        end = data.find(b" ", start + PIECE_BYTES)
        words = data[start : end if end >= 0 else len(data)].split()
        counts.update(words)
        n += len(words)
        start = end if end >= 0 else len(data)
    return n, counts


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item."""
    types = [pa.int64(), pa.int64(), pa.list_(pa.binary())]
    for item_rows, item_ids, texts in slices(batches):
        yield batch_of([item_rows, item_ids, [sorted(term_counts(t)[1]) for t in texts]], types, names_of(ITEM))


def bags(batches: Iterator[pa.RecordBatch], numbers: Broadcast[dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
    """Each document's number of terms, and its counts of the terms asked for."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
    known = numbers.value
    for row_ids, doc_ids, texts in slices(batches):
        ns, terms, counts = [], [], []
        for text in texts:
            n, found = term_counts(text)
            own = [(known[term], count) for term, count in found.items() if term in known]
            ns.append(n)
            terms.append([term for term, _ in own])
            counts.append([count for _, count in own])
        yield batch_of([row_ids, doc_ids, ns, terms, counts], types, names_of(BAG))


def weight(documents: int, holding: int) -> int:
    """A term's weight, by the documents there are and those that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts_of(counts: list[int], weights: list[int], n: int, documents: int, all_terms: int) -> list[int]:
    """The impacts of terms with these counts and weights in a document of ``n`` terms."""
    m = 100 - 90 + (90 * n * documents) // all_terms
    return [w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m)) for tf, w in zip(counts, weights)]


def impact_rows(
    batches: Iterator[pa.RecordBatch], weights: Broadcast[list[int]], documents: int, all_terms: int
) -> Iterator[pa.RecordBatch]:
    """Documents with any impact as vectors, and their lengths."""
    types = [pa.float64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    for columns in slices(batches):
        out = []
        for row_id, doc_id, n, terms, counts in zip(*columns, strict=True):
            own = impacts_of(counts, [weights.value[t] for t in terms], n, documents, all_terms)
            values, places = np.array(own, "<i8"), np.array(terms, "<i4")
            some = values > 0
            if some.any():
                length = float(np.sqrt(np.square(values[some], dtype=np.float64).sum()))
                out.append((length, row_id, doc_id, places[some].tobytes(), values[some].tobytes()))
        yield batch_of(list(zip(*out)) or [[]] * 5, types, names_of(IMPACTS))


def bucket_rows(batches: Iterator[pa.RecordBatch], documents: int, entries: int) -> Iterator[pa.RecordBatch]:
    """Buckets of vectors that come longest first."""
    types = [pa.int64(), pa.float64(), *[pa.binary()] * 6]
    number = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    size = 0

    def bucket() -> pa.RecordBatch:
        lengths, _, doc_ids, terms, impacts = zip(*held)
        starts = np.cumsum([0, *(len(t) // 4 for t in terms)])
        arrays = [
            np.array([d or 0 for d in doc_ids], "<i8"),
            np.array([d is None for d in doc_ids], "u1"),
            np.array(lengths, "<f8"),
            starts.astype("<i8"),
        ]
        out = [number, max(lengths), *[a.tobytes() for a in arrays], b"".join(terms), b"".join(impacts)]
        return batch_of([[v] for v in out], types, names_of(BUCKET))

    for columns in slices(batches):
        for row in zip(*columns, strict=True):
            held.append(row)
            size += len(row[3]) // 4
            if len(held) >= documents or size >= entries:
                yield bucket()
                held, size, number = [], 0, number + 1
    if held:
        yield bucket()


class Bucket:
    """A bucket's vectors, by document and by term."""

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.greatest = row["greatest"]
        self.doc_ids, self.no_ids = read("doc_ids", "<i8"), read("no_ids", "u1")
        self.lengths, self.starts = read("lengths", "<f8"), read("starts", "<i8")
        self.terms, self.impacts = read("terms", "<i4"), read("impacts", "<i8")
        order = np.argsort(self.terms, kind="stable")
        owner = np.repeat(np.arange(len(self.doc_ids)), np.diff(self.starts))
        self.list_documents, self.list_impacts = owner[order], self.impacts[order]
        self.list_terms, first = np.unique(self.terms[order], return_index=True)
        self.list_starts = np.r_[first, len(order)]
        self.list_greatest = np.maximum.reduceat(self.list_impacts, first)

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """The places of the lists of those terms that the bucket has, largest impact first."""
        at = np.searchsorted(self.list_terms, terms)
        at = at[at < len(self.list_terms)]
        at = at[np.isin(self.list_terms[at], terms)]
        return at[np.argsort(-self.list_greatest[at], kind="stable")]

    def may_reach(self, terms: np.ndarray, least: int) -> np.ndarray:
        """Documents that the coordinate bounds leave for an item that wants a score of ``least`` at least."""
        lists = self.lists(terms)
        if not len(lists):
            return lists
        rest = np.cumsum(self.list_greatest[lists][::-1])[::-1].astype(np.float64)
        rest = np.r_[rest, 0.0]
        n = len(self.doc_ids)
        have, left = np.zeros(n, np.int64), np.square(self.lengths)
        open_ = np.arange(n)
        for place, at in enumerate(lists.tolist()):
            part = slice(self.list_starts[at], self.list_starts[at + 1])
            documents, impacts = self.list_documents[part], self.list_impacts[part]
            have[documents] += impacts
            left[documents] -= np.square(impacts, dtype=np.float64)
            by_length = np.sqrt(np.maximum(left[open_], 0) * (len(lists) - place - 1))
            slack = ROUNDING * self.greatest * math.sqrt(len(lists))
            bound = have[open_] + np.minimum(rest[place + 1], by_length + slack) + slack
            open_ = open_[bound >= least]
            if len(open_) <= FEW:
                break
        return open_

    def scores(self, documents: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; ``asked`` tells for each term whether the item has it."""
        starts, ends = self.starts[documents], self.starts[documents + 1]
        lengths = ends - starts  # never 0: a bucket has no empty vectors
        firsts = np.cumsum(lengths) - lengths
        inside = np.repeat(starts - firsts, lengths) + np.arange(lengths.sum())
        return np.add.reduceat(np.where(asked[self.terms[inside]], self.impacts[inside], 0), firsts)


class Best:
    """The best documents of one item so far."""

    def __init__(self, best: int, least: int):
        self.best, self.least = best, least
        self.scores, self.ids, self.no_ids = (np.zeros(0, np.int64) for _ in range(3))

    def take(self, scores: np.ndarray, ids: np.ndarray, no_ids: np.ndarray) -> None:
        enough = scores >= self.least
        self.scores = np.concatenate([self.scores, scores[enough]])
        self.ids = np.concatenate([self.ids, ids[enough]])
        self.no_ids = np.concatenate([self.no_ids, no_ids[enough]])
        order = np.lexsort((self.ids, self.no_ids, -self.scores))[: self.best]
        self.scores, self.ids, self.no_ids = self.scores[order], self.ids[order], self.no_ids[order]
        if len(order) == self.best:
            self.least = max(self.least, int(self.scores[-1]))


def search(
    batches: Iterator[pa.RecordBatch], items: Broadcast[list[np.ndarray]], n_terms: int, least: list[int], best: int
) -> Iterator[pa.RecordBatch]:
    """The best documents of each item among some buckets; ``least`` has the scores that others have reached already."""
    found = [Best(best, score) for score in least]
    asked = np.zeros(n_terms, bool)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            bucket = None
            for item, terms in enumerate(items.value):
                own = found[item]
                if row["greatest"] * math.sqrt(len(terms)) * (1 + ROUNDING) < own.least:
                    continue
                bucket = bucket or Bucket(row)
                documents = bucket.may_reach(terms, own.least)
                if len(documents):
                    asked[terms] = True
                    own.take(bucket.scores(documents, asked), bucket.doc_ids[documents], bucket.no_ids[documents])
                    asked[terms] = False
    for item, own in enumerate(found):
        ids = [None if none else i for i, none in zip(own.ids.tolist(), own.no_ids.tolist())]
        types = [pa.int32(), pa.int64(), pa.int64()]
        yield batch_of([[item] * len(ids), ids, own.scores.tolist()], types, names_of(FOUND))


def rank_block(texts: DataFrame, items: DataFrame, best: int, bucket_documents: int, seed_every: int) -> DataFrame:
    """The best documents of some items, few enough to be sent to all tasks."""
    spark = texts.sparkSession
    send = spark.sparkContext.broadcast
    rows = sorted((row for row in items.collect()), key=lambda row: row.item_row)
    numbers = {term: n for n, term in enumerate(sorted({bytes(t) for row in rows for t in row.terms}))}
    vectors = [np.array(sorted(numbers[bytes(t)] for t in row.terms), np.int64) for row in rows]
    bag = stored(spark, "term-bags", map_rows(texts, partial(bags, numbers=send(numbers)), BAG))
    documents, all_terms = bag.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = dict(bag.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = [weight(documents, holding.get(n, 0)) for n in range(len(numbers))]
    task = partial(impact_rows, weights=send(weights), documents=documents, all_terms=all_terms)
    held = bag.where(F.size("terms") > 0)
    impacts = stored(spark, "impacts", map_rows(held, task, IMPACTS))
    wanted = max(1, -(-impacts.count() // bucket_documents))
    ordered = impacts.repartitionByRange(wanted, F.desc("length"), "row_id")
    ordered = ordered.sortWithinPartitions(F.desc("length"), "row_id")
    make = partial(bucket_rows, documents=bucket_documents, entries=BUCKET_ENTRIES)
    buckets = stored(spark, "norm-buckets", map_rows(ordered, make, BUCKET))

    look = partial(search, items=send(vectors), n_terms=len(numbers), best=best)
    first = F.pmod(F.xxhash64("bucket"), F.lit(seed_every)) == 0
    seeds = stored(spark, "first-found", map_rows(buckets.where(first), partial(look, least=[1] * len(rows)), FOUND))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = seeds.withColumn("rank", F.row_number().over(order))
    reached = dict(ranked.where(F.col("rank") == best).select("item", "score").collect())
    least = [reached.get(item, 1) for item in range(len(rows))]
    others = map_rows(buckets.where(~first), partial(look, least=least), FOUND)
    ranked = seeds.unionByName(others).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    named = spark.createDataFrame([(n, row.item_id) for n, row in enumerate(rows)], "item int, item_id bigint")
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def rank(
    documents: DataFrame,
    items: DataFrame,
    best: int = BEST,
    bucket_documents: int = BUCKET_DOCUMENTS,
    seed_every: int = SEED_EVERY,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents with a score above 0 for each item.

    Takes ``doc_id, text`` of the documents and ``item_id, text`` of the items.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        whole_text().alias("text"),
    )
    asked = items.select(
        F.monotonically_increasing_id().alias("item_row"),
        F.col("item_id").cast("bigint").alias("item_id"),
        whole_text().alias("text"),
    )
    asked = stored(spark, "items", map_rows(asked, item_terms, ITEM)).where(F.size("terms") > 0)
    size = F.aggregate("terms", F.lit(0).cast("bigint"), lambda n, term: n + F.length(term) + 8)
    blocks = -(-(asked.agg(F.sum(size)).first()[0] or 0) // block_bytes)
    found = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_row"), F.lit(blocks)) == block)
        if not own.isEmpty():
            found = found.unionByName(rank_block(texts, own, best, bucket_documents, seed_every))
    return found
