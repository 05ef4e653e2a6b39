"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Vectors of a label are dealt to tiles of bounded size. A vector u of length 1 is kept as int8 steps q with its own scale
s, and with e = |u - s q|. For two vectors |u.v - s t q.r| <= e (1 + f) + f, so the exact product of the int8 tiles (float
arithmetic on small whole numbers does not round) tells which pairs can reach the threshold. Only tiles that hold such
vectors are looked at again, and only these vectors, in double precision. What a pair of tiles gives is a count for each
vector and a forest of its links, never the pairs, so a group of near copies costs its size.

Equal vectors of a label are one point before all that, with its number of copies. Vectors that are null, zero, or hold
null or non-finite components, and those without a label, link with nothing; neither do vectors of different lengths.
Repeated rows, also of one ``vec_id``, are vectors of their own. A null ``vec_id`` never names a component and is not
kept. An empty table gives no rows. Columns other than ``vec_id, embedding, label`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import batch_of, map_rows, slices, stored
from clickloom.llm.components import components
from clickloom.llm.simhash import Forest

MIN_COSINE = 0.98
TILE_VECTORS = 2048
#: Slack for the rounding of lengths, scales and error bounds in double precision.
ROUNDING = 1e-9
KEY_BYTES = 16
#: Whole numbers up to 2^24 are exact in single precision, so as many dimensions can be multiplied at a time.
EXACT_DIMENSIONS = (1 << 24) // (127 * 127)


def point_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, and the key that equal vectors of a label share."""
    names, types = ["vec_id", "label", "key", "data"], [pa.int64(), pa.string(), pa.binary(), pa.binary()]
    for vec_ids, vectors, labels in slices(batches):
        data = [(np.asarray(v, "<f8") + 0.0).tobytes() for v in vectors]  # + 0.0: one zero only
        keys = [xxhash.xxh3_128_digest(d + label.encode()) for d, label in zip(data, labels)]
        yield batch_of([vec_ids, labels, keys, data], types, names)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that no square is too large or too small."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


TILE = (
    "label string, width int, tile int, tiles int, keys binary, copies binary, data binary, steps binary,"
    " scales binary, errors binary"
)
TILE_NAMES = [part.split()[0] for part in TILE.split(", ")]


def make_tile(rows: pa.Table) -> pa.Table:
    """One tile: its points in the order of their keys, quantised."""
    rows = rows.sort_by("key")
    label, width, tile, tiles = (rows[name][0].as_py() for name in ("label", "width", "tile", "tiles"))
    data = b"".join(rows["data"].to_pylist())
    units = unit(np.frombuffer(data, "<f8").reshape(len(rows), width))
    scales = np.abs(units).max(axis=1) / 127
    steps = np.rint(units / scales[:, None]).astype(np.int8)
    rest = units - steps * scales[:, None]
    errors = np.sqrt(np.einsum("ij,ij->i", rest, rest)) + ROUNDING
    parts = [b"".join(rows["key"].to_pylist()), rows["copies"].to_numpy().astype("<i8").tobytes(), data]
    parts += [steps.tobytes(), scales.astype("<f8").tobytes(), errors.astype("<f8").tobytes()]
    values = [label, width, tile, tiles, *parts]
    types = [pa.string(), *[pa.int32()] * 3, *[pa.binary()] * 6]
    return pa.table([pa.array([v], t) for v, t in zip(values, types)], names=TILE_NAMES)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows."""
    total = np.zeros((len(left), len(right)))
    for start in range(0, left.shape[1], EXACT_DIMENSIONS):
        part = slice(start, start + EXACT_DIMENSIONS)
        total += left[:, part].astype(np.float32) @ right[:, part].astype(np.float32).T
    return total


def possible(left: tuple, right: tuple, width: int, least: float) -> np.ndarray:
    """Which pairs of two quantised tiles may reach the threshold."""
    (q, s, e), (r, t, f) = (
        (np.frombuffer(a, np.int8).reshape(-1, width), np.frombuffer(b, "<f8"), np.frombuffer(c, "<f8"))
        for a, b, c in (left, right)
    )
    bound = e[:, None] * (1 + f) + f
    return products(q, r) * s[:, None] * t + bound + ROUNDING >= least


MAYBE = "label string, width int, tile int, other int, rows binary, others binary"


def possible_tiles(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """For pairs of tiles, the vectors of each that may have a link in the other; none for tiles without."""
    names = [part.split()[0] for part in MAYBE.split(", ")]
    types = [pa.string(), *[pa.int32()] * 3, *[pa.binary()] * 2]
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            left, right = ([row[side + n] for n in ("steps", "scales", "errors")] for side in ("", "other_"))
            maybe = possible(left, right, row["width"], least)
            if row["tile"] == row["other"]:
                maybe = np.triu(maybe, 1)
            if maybe.any():
                found = [np.flatnonzero(maybe.any(axis=axis)).astype("<i4").tobytes() for axis in (1, 0)]
                values = [row["label"], row["width"], row["tile"], row["other"], *found]
                yield batch_of([[v] for v in values], types, names)


#: A vector's links (one more row for each pair of tiles), or a link of the forest.
FOUND = "a binary, b binary, links bigint"


def confirmed(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """The links among the vectors in question, in double precision."""
    names, types = ["a", "b", "links"], [pa.binary(), pa.binary(), pa.int64()]
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            sides = []
            for side, chosen in (("", row["rows"]), ("other_", row["others"])):
                at = np.frombuffer(chosen, "<i4")
                vectors = np.frombuffer(row[side + "data"], "<f8").reshape(-1, row["width"])[at]
                copies = np.frombuffer(row[side + "copies"], "<i8")[at]
                keys = [row[side + "keys"][KEY_BYTES * i : KEY_BYTES * (i + 1)] for i in at.tolist()]
                sides.append((at, unit(vectors), copies, keys))
            (at, u, copies, keys), (other_at, v, other_copies, other_keys) = sides
            linked = u @ v.T >= least
            if row["tile"] == row["other"]:
                linked &= at[:, None] < other_at
            counts = [*zip(keys, (linked @ other_copies).tolist()), *zip(other_keys, (copies @ linked).tolist())]
            numbers = {key: n for n, key in enumerate(dict.fromkeys([*keys, *other_keys]))}
            forest, out = Forest(len(numbers)), [(key, None, n) for key, n in counts if n]
            for i in np.flatnonzero(linked.any(axis=1)).tolist():
                for j in np.flatnonzero(linked[i]).tolist():
                    if forest.join(numbers[keys[i]], numbers[other_keys[j]]):
                        out.append((keys[i], other_keys[j], None))
            if out:
                yield batch_of(list(zip(*out)), types, names)


def near_duplicates(
    embeddings: DataFrame, min_cosine: float = MIN_COSINE, tile_vectors: int = TILE_VECTORS
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each vector; the component is the smallest id reachable by links."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("string").alias("label"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull()
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    schema = "vec_id bigint, label string, key binary, data binary"
    inputs = rows.where("usable").select("vec_id", "embedding", "label")
    vectors = stored(spark, "vectors", map_rows(inputs, point_rows, schema))
    points = vectors.groupBy("key").agg(
        F.min("vec_id").alias("first_id"),
        F.count("*").alias("copies"),
        F.first("label").alias("label"),
        F.first("data").alias("data"),
    )
    points = stored(spark, "points", points.withColumn("width", (F.length("data") / 8).cast("int")))
    sizes = points.groupBy("label", "width").agg(F.count("*").alias("size"))
    tiles = F.ceil(F.col("size") / F.lit(tile_vectors)).cast("int")
    dealt = points.join(sizes.withColumn("tiles", tiles).drop("size"), ["label", "width"])
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("key"), "tiles").cast("int")).drop("first_id")
    packed = stored(spark, "tiles", dealt.groupBy("label", "width", "tile").applyInArrow(make_tile, TILE))

    quantised = packed.select("label", "width", "tile", "tiles", "steps", "scales", "errors")
    partners = quantised.withColumn("other", F.explode(F.sequence("tile", F.col("tiles") - 1))).drop("tiles")
    others = quantised.drop("tiles").withColumnsRenamed(
        {"tile": "other", "steps": "other_steps", "scales": "other_scales", "errors": "other_errors"}
    )
    pairs = partners.join(others, ["label", "width", "other"])
    maybe = stored(spark, "maybe", map_rows(pairs, partial(possible_tiles, least=min_cosine), MAYBE))
    full = packed.select("label", "width", "tile", "keys", "copies", "data")
    other_full = full.withColumnsRenamed(
        {"tile": "other", "keys": "other_keys", "copies": "other_copies", "data": "other_data"}
    )
    exact = maybe.join(full, ["label", "width", "tile"]).join(other_full, ["label", "width", "other"])
    found = stored(spark, "links", map_rows(exact, partial(confirmed, least=min_cosine), FOUND))

    links = found.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    groups = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "key")
    grouped = points.select("key", "first_id", "copies").join(groups, "key", "left").join(links, "key", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "key"))
    # A table of its own: the join's two sides come straight from their shuffles, so a large component can be split.
    smallest = stored(spark, "smallest", grouped.groupBy("component").agg(F.min("first_id").alias("component_id")))
    n_links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links")
    named = grouped.join(smallest, "component").select("key", n_links, "component_id")
    linked = vectors.select("vec_id", "key").join(named, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)
