"""Exact top-k search by inner product: ball trees per shard, searched by branch and bound.

Vectors are dealt to shards of bounded size along a spatial code (the signs of random projections), so that a shard holds
neighbours, and each shard gets a ball tree. For a query q no vector in a ball of centre c and radius r has a product
above q.c + |q| r. A search goes down to the child with the higher bound first and leaves out every ball whose bound is
below the query's current k-th score. That score is shared: each query first searches its own shard; the k-th score it
found there goes with it to all others, where a task hands on what it learns from shard to shard, and pairs of a block of
queries and a shard that cannot hold anything for any of them are never joined with their vectors.

Components are whole numbers, floor(1024 * x) unless ``scale`` says otherwise, and products are exact: in double precision
where no sum can pass 2^53, else in whole numbers of any size. Scores beyond 64 bits count as the largest or smallest
long. Equal scores rank by ascending id.

Vectors that are null, or hold null or non-finite components (also after scaling), take no part, nor do rows without an
id. Each row is a vector of its own: repeated rows of one id are queries and candidates each, and a query leaves out its
own row alone. Vectors of different lengths have no product. An empty table, or one without queries, gives no rows.
Columns other than ``vec_id`` and ``embedding`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import batch_of, map_rows, slices, stored

SCALE = 1024
BEST = 10
#: Vectors of a shard, of a leaf of its tree, and of a block of queries.
SHARD_VECTORS, LEAF_VECTORS, BLOCK_QUERIES = 8192, 256, 1024
#: Random projections whose signs are a vector's spatial code.
CODE_BITS = 16
#: Slack for the rounding of bounds, as a share of the greatest product that two lengths allow.
ROUNDING = 1e-9
#: Sums of products up to this are exact in double precision.
EXACT_BELOW = float(1 << 53)
#: Blocks of queries whose current scores a task remembers from shard to shard.
REMEMBERED_BLOCKS = 64
NO_SCORE, NO_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max

VECTOR = "row_id bigint, vec_id bigint, width int, code int, vector binary"
SHARD = (
    "shard bigint, width int, row_ids binary, vec_ids binary, vectors binary, centres binary, radii binary,"
    " middle array<double>, radius double"
)
ASKED = (
    "width int, home bigint, row_id bigint, query_id bigint, vector binary, scores array<bigint>, vec_ids array<bigint>"
)
BLOCK = (
    "block bigint, width int, row_ids binary, query_ids binary, homes binary, vectors binary, best binary,"
    " best_ids binary, middle array<double>, radius double, least double"
)
FOUND = "row_id bigint, query_id bigint, vec_id bigint, score bigint"


def names_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def scaled_rows(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Vectors in whole numbers, as bytes, and their spatial codes."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    directions: dict[int, np.ndarray] = {}
    for row_ids, vec_ids, vectors in slices(batches):
        out = []
        for row_id, vec_id, vector in zip(row_ids, vec_ids, vectors, strict=True):
            with np.errstate(over="ignore"):
                values = np.floor(scale * np.asarray(vector, np.float64)) + 0.0  # + 0.0: one zero only
            if not np.isfinite(values).all():
                continue
            width = len(values)
            if width not in directions:
                directions[width] = np.random.default_rng(width).standard_normal((width, CODE_BITS))
            length = np.abs(values).max(initial=1.0)
            code = int(((values / length) @ directions[width] > 0) @ (1 << np.arange(CODE_BITS)))
            out.append((row_id, vec_id, width, code, values.astype("<f8").tobytes()))
        yield batch_of(list(zip(*out)) or [[]] * 5, types, names_of(VECTOR))


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    """Lengths; infinite where a square is too large, which only makes bounds useless."""
    with np.errstate(over="ignore"):
        return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def products(queries: np.ndarray, vectors: np.ndarray, greatest: float) -> np.ndarray:
    """Exact inner products as longs; ``greatest`` bounds their sums."""
    if greatest < EXACT_BELOW:
        return (queries @ vectors.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in side], object).reshape(side.shape) for side in (queries, vectors)]
    exact = whole[0] @ whole[1].T if whole[0].shape[1] else np.zeros((len(queries), len(vectors)), object)
    return np.clip(exact, NO_SCORE + 1, NO_ID).astype(np.int64)


class BallTree:
    """Vectors in an order where each node is a run of them; a node's halves are its children. Nodes are listed parents
    first, left before right."""

    def __init__(self, vectors: np.ndarray, row_ids: np.ndarray, vec_ids: np.ndarray, centres: np.ndarray, radii: np.ndarray):
        self.vectors, self.row_ids, self.vec_ids = vectors, row_ids, vec_ids
        self.centres, self.radii = centres, radii
        self.farthest = lengths_of(centres) + radii
        self.greatest = float(lengths_of(vectors).max(initial=0.0))

    @classmethod
    def build(cls, vectors: np.ndarray, row_ids: np.ndarray, vec_ids: np.ndarray, leaf: int = LEAF_VECTORS) -> BallTree:
        order, centres, radii = np.arange(len(vectors)), [], []

        def split(low: int, high: int) -> None:
            own = vectors[order[low:high]]
            centre = own.mean(axis=0)
            from_centre = lengths_of(own - centre)
            centres.append(centre)
            radii.append(from_centre.max(initial=0.0))
            if high - low > leaf:
                # Along the line through the vector farthest from the centre and the one farthest from that.
                far = own[from_centre.argmax()]
                other = own[lengths_of(own - far).argmax()]
                along = np.nan_to_num((own / self_scale) @ ((other - far) / self_scale))
                middle = (high - low) // 2
                order[low:high] = order[low:high][np.argpartition(along, middle)]
                split(low, low + middle)
                split(low + middle, high)

        self_scale = max(float(np.abs(vectors).max(initial=1.0)), 1.0)
        split(0, len(vectors))
        return cls(vectors[order], row_ids[order], vec_ids[order], np.array(centres), np.array(radii))

    @classmethod
    def of(cls, row: dict) -> BallTree:
        row_ids, vec_ids = (np.frombuffer(row[name], "<i8") for name in ("row_ids", "vec_ids"))
        vectors, centres, radii = (np.frombuffer(row[name], "<f8") for name in ("vectors", "centres", "radii"))
        width = row["width"]
        return cls(vectors.reshape(len(row_ids), width), row_ids, vec_ids, centres.reshape(len(radii), width), radii)


def nodes_below(size: int, leaf: int) -> int:
    """Nodes of a tree over so many vectors."""
    return 1 if size <= leaf else 1 + nodes_below(size // 2, leaf) + nodes_below(size - size // 2, leaf)


@dataclass
class Asked:
    """Queries and the best they have found so far: scores, highest first, and ids."""

    vectors: np.ndarray
    row_ids: np.ndarray
    scores: np.ndarray
    ids: np.ndarray

    def __post_init__(self) -> None:
        self.lengths = lengths_of(self.vectors)

    def bounds(self, chosen: np.ndarray, tree: BallTree, node: int) -> np.ndarray:
        """What no product of the chosen queries with a vector of the node can pass."""
        with np.errstate(over="ignore", invalid="ignore"):
            length = self.lengths[chosen]
            bound = self.vectors[chosen] @ tree.centres[node] + length * tree.radii[node]
            return bound + ROUNDING * length * tree.farthest[node] + ROUNDING

    def take(self, chosen: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Let the chosen queries see scores of some vectors, a row for each query."""
        better = (scores >= self.scores[chosen, -1][:, None]).any(axis=1)
        chosen, scores = chosen[better], scores[better]
        if not len(chosen):
            return
        best = self.scores.shape[1]
        if scores.shape[1] > 4 * best:  # all scores from the best-th highest on, ties too, then the smallest ids
            least = np.partition(scores, -best, axis=1)[:, -best][:, None]
            keep = np.flatnonzero((scores >= np.maximum(least, self.scores[chosen, -1][:, None])).any(axis=0))
            scores, ids = scores[:, keep], ids[keep]
        scores = np.concatenate([self.scores[chosen], scores], axis=1)
        ids = np.concatenate([self.ids[chosen], np.broadcast_to(ids, (len(chosen), len(ids)))], axis=1)
        ids = np.where(scores == NO_SCORE, NO_ID, ids)
        order = np.lexsort((ids, ~scores), axis=1)[:, :best]
        self.scores[chosen] = np.take_along_axis(scores, order, axis=1)
        self.ids[chosen] = np.take_along_axis(ids, order, axis=1)


def search(tree: BallTree, asked: Asked, chosen: np.ndarray, leaf: int = LEAF_VECTORS) -> int:
    """Branch and bound for the chosen queries; returns how many products were made."""
    made = 0

    def visit(node: int, low: int, high: int, chosen: np.ndarray, bounds: np.ndarray) -> None:
        nonlocal made
        # An equal score may still win by its id.
        open_ = ~(bounds < asked.scores[chosen, -1].astype(np.float64))
        chosen = chosen[open_]
        if not len(chosen):
            return
        if high - low <= leaf:
            made += len(chosen) * (high - low)
            with np.errstate(over="ignore"):
                greatest = float(asked.lengths[chosen].max(initial=0.0) * tree.greatest)
            scores = products(asked.vectors[chosen], tree.vectors[low:high], greatest)
            own = asked.row_ids[chosen][:, None] == tree.row_ids[low:high]
            asked.take(chosen, np.where(own, NO_SCORE, scores), tree.vec_ids[low:high])
            return
        middle = (high - low) // 2
        left, right = node + 1, node + 1 + nodes_below(middle, leaf)
        to_left, to_right = (asked.bounds(chosen, tree, child) for child in (left, right))
        first = ~(to_left < to_right)
        visit(left, low, low + middle, chosen[first], to_left[first])
        visit(right, low + middle, high, chosen, to_right)
        visit(left, low, low + middle, chosen[~first], to_left[~first])

    if len(chosen) and len(tree.vectors):
        visit(0, 0, len(tree.vectors), chosen, asked.bounds(chosen, tree, 0))
    return made


def runs(batches: Iterator[pa.RecordBatch], names: list[str], most: int) -> Iterator[list[tuple]]:
    """Rows in order, at most so many of one width at a time."""
    held: list[tuple] = []
    width_at = names.index("width")
    for batch in batches:
        for row in zip(*(batch[name].to_pylist() for name in names), strict=True):
            if held and (len(held) == most or held[0][width_at] != row[width_at]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def numbered() -> Iterator[int]:
    """Numbers that no other task gives."""
    first = TaskContext.get().partitionId() << 32
    return iter(range(first, first + (1 << 32)))


def shard_rows(batches: Iterator[pa.RecordBatch], most: int, leaf: int) -> Iterator[pa.RecordBatch]:
    """Shards of vectors that come in the order of their codes."""
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.float64()), pa.float64()]
    numbers = numbered()
    for rows in runs(batches, names_of(VECTOR), most):
        row_ids, vec_ids, widths, _, vectors = zip(*rows)
        values = np.frombuffer(b"".join(vectors), "<f8").reshape(len(rows), widths[0])
        tree = BallTree.build(values, np.array(row_ids, "<i8"), np.array(vec_ids, "<i8"), leaf)
        packed = [a.tobytes() for a in (tree.row_ids, tree.vec_ids, tree.vectors, tree.centres, tree.radii)]
        out = [next(numbers), widths[0], *packed, tree.centres[0].tolist(), float(tree.radii[0])]
        yield batch_of([[v] for v in out], types, names_of(SHARD))


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def at_home(batches: Iterator[pa.RecordBatch], every: int, best: int, leaf: int) -> Iterator[pa.RecordBatch]:
    """The queries of each shard with the best of their own shard."""
    lists = pa.list_(pa.int64())
    types = [pa.int32(), *[pa.int64()] * 3, pa.binary(), lists, lists]
    for row in each_row(batches):
        tree = BallTree.of(row)
        queries = np.flatnonzero(tree.vec_ids % every == 0)
        for start in range(0, len(queries), BLOCK_QUERIES):
            at = queries[start : start + BLOCK_QUERIES]
            asked = asked_of(tree.vectors[at], tree.row_ids[at], best)
            search(tree, asked, np.arange(len(at)), leaf)
            some = [scores > NO_SCORE for scores in asked.scores]
            yield batch_of(
                [
                    [row["width"]] * len(at),
                    [row["shard"]] * len(at),
                    asked.row_ids.tolist(),
                    tree.vec_ids[at].tolist(),
                    [v.astype("<f8").tobytes() for v in asked.vectors],
                    [scores[one].tolist() for scores, one in zip(asked.scores, some)],
                    [ids[one].tolist() for ids, one in zip(asked.ids, some)],
                ],
                types,
                names_of(ASKED),
            )


def asked_of(vectors: np.ndarray, row_ids: np.ndarray, best: int) -> Asked:
    """Queries that have found nothing yet."""
    n = len(vectors)
    return Asked(vectors, row_ids, np.full((n, best), NO_SCORE), np.full((n, best), NO_ID))


def block_rows(batches: Iterator[pa.RecordBatch], most: int, best: int) -> Iterator[pa.RecordBatch]:
    """Blocks of queries that come in the order of their homes."""
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 6, pa.list_(pa.float64()), pa.float64(), pa.float64()]
    numbers = numbered()
    for rows in runs(batches, names_of(ASKED), most):
        widths, homes, row_ids, query_ids, vectors, scores, ids = zip(*rows)
        values = np.frombuffer(b"".join(vectors), "<f8").reshape(len(rows), widths[0])
        asked = asked_of(values, np.array(row_ids, "<i8"), best)
        for n, (own, own_ids) in enumerate(zip(scores, ids)):
            asked.scores[n, : len(own)], asked.ids[n, : len(own)] = own, own_ids
        middle = values.mean(axis=0)
        radius = float(lengths_of(values - middle).max(initial=0.0))
        packed = [asked.row_ids, np.array(query_ids, "<i8"), np.array(homes, "<i8"), values, asked.scores, asked.ids]
        summary = [middle.tolist(), radius, float(asked.scores[:, -1].min())]
        out = [next(numbers), widths[0], *[a.tobytes() for a in packed], *summary]
        yield batch_of([[v] for v in out], types, names_of(BLOCK))


def elsewhere(batches: Iterator[pa.RecordBatch], best: int, leaf: int) -> Iterator[pa.RecordBatch]:
    """What queries find outside of their own shards: candidates that beat all they knew before."""
    types = [pa.int64()] * 4
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for row in each_row(batches):
        tree = BallTree.of(row)
        read = lambda name, kind="<i8": np.frombuffer(row[f"query_{name}"], kind)
        vectors = read("vectors", "<f8").reshape(len(read("row_ids")), row["width"])
        if row["block"] in known:
            scores, ids = known.pop(row["block"])
        else:
            scores, ids = (read(name).reshape(-1, best).copy() for name in ("best", "best_ids"))
        asked = Asked(vectors, read("row_ids"), scores, ids)
        before = asked.scores.copy(), asked.ids.copy()
        search(tree, asked, np.flatnonzero(read("homes") != row["shard"]), leaf)
        known[row["block"]] = asked.scores, asked.ids
        if len(known) > REMEMBERED_BLOCKS:
            del known[next(iter(known))]
        out = []
        for n in np.flatnonzero((before[0] != asked.scores).any(axis=1) | (before[1] != asked.ids).any(axis=1)).tolist():
            out += new_of(asked, before, n, int(read("row_ids")[n]), int(read("query_ids")[n]))
        if out:
            yield batch_of(list(zip(*out)), types, names_of(FOUND))


def new_of(asked: Asked, before: tuple[np.ndarray, np.ndarray], n: int, row_id: int, query_id: int) -> list[tuple]:
    """The candidates of one query that it did not have before, each as often as it is new."""
    had: dict[tuple, int] = {}
    for pair in zip(before[0][n].tolist(), before[1][n].tolist()):
        had[pair] = had.get(pair, 0) + 1
    new = []
    for score, vec_id in zip(asked.scores[n].tolist(), asked.ids[n].tolist()):
        if had.get((score, vec_id), 0):
            had[(score, vec_id)] -= 1
        elif score > NO_SCORE:
            new.append((row_id, query_id, vec_id, score))
    return new


def may_reach(query: str, other: str) -> Column:
    """Whether a query in one ball can have a product of at least ``least`` with a vector in another ball."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    p, c = F.col(f"{query}middle"), F.col(f"{other}middle")
    r, s = F.col(f"{query}radius"), F.col(f"{other}radius")
    lengths = F.sqrt(dot(p, p)) + r, F.sqrt(dot(c, c)) + s
    bound = dot(p, c) + s * F.sqrt(dot(p, p)) + r * lengths[1] + lengths[0] * lengths[1] * ROUNDING + ROUNDING
    return F.coalesce(F.isnan(bound) | (bound >= F.col("least")), F.lit(True))


def top_products(
    embeddings: DataFrame,
    query_every: int,
    best: int = BEST,
    scale: float = SCALE,
    shard_vectors: int = SHARD_VECTORS,
    leaf_vectors: int = LEAF_VECTORS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``best`` highest products of each query with all other rows.

    Queries are the rows whose ``vec_id`` is divisible by ``query_every``.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where(F.col("vec_id").isNotNull() & finite)
    vectors = stored(spark, "search-vectors", map_rows(usable, partial(scaled_rows, scale=scale), VECTOR))
    wanted = max(1, -(-vectors.count() // shard_vectors))
    ordered = vectors.repartitionByRange(wanted, "width", "code", "row_id").sortWithinPartitions("width", "code", "row_id")
    make = partial(shard_rows, most=shard_vectors, leaf=leaf_vectors)
    shards = stored(spark, "search-shards", map_rows(ordered, make, SHARD))

    home = partial(at_home, every=query_every, best=best, leaf=leaf_vectors)
    asked = stored(spark, "search-home", map_rows(shards, home, ASKED))
    n_asked = max(1, -(-asked.count() // block_queries))
    by_home = asked.repartitionByRange(n_asked, "width", "home", "row_id").sortWithinPartitions("width", "home", "row_id")
    blocks = stored(
        spark, "search-blocks", map_rows(by_home, partial(block_rows, most=block_queries, best=best), BLOCK)
    )

    # Which blocks may find something in which shards, from their balls alone; a bucket holds about one shard.
    buckets = F.lit(max(1, shards.count()))
    balls = shards.select("shard", "width", F.col("middle").alias("s_middle"), F.col("radius").alias("s_radius"))
    balls = balls.withColumn("bucket", F.pmod(F.xxhash64("shard"), buckets))
    asking = blocks.select("block", "width", F.col("middle").alias("q_middle"), F.col("radius").alias("q_radius"), "least")
    asking = asking.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), buckets.cast("bigint") - 1)))
    pairs = asking.join(balls, ["width", "bucket"]).where(may_reach("q_", "s_")).select("block", "shard")

    queries = blocks.drop("middle", "radius", "least", "width").withColumnsRenamed(
        {name: f"query_{name}" for name in ("row_ids", "homes", "vectors", "best", "best_ids")}
        | {"query_ids": "query_query_ids"}
    )
    trees = shards.drop("middle", "radius")
    met = pairs.join(queries, "block").join(trees, "shard")
    others = map_rows(met, partial(elsewhere, best=best, leaf=leaf_vectors), FOUND)
    own = asked.select("row_id", "query_id", F.explode(F.arrays_zip("vec_ids", "scores")).alias("c"))
    own = own.select("row_id", "query_id", F.col("c.vec_ids").alias("vec_id"), F.col("c.scores").alias("score"))
    order = Window.partitionBy("row_id").orderBy(F.desc("score"), "vec_id")
    ranked = own.unionByName(others).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("query_id", "rank", "vec_id", "score")
