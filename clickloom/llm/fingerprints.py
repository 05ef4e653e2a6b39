"""Document fingerprints: one-permutation MinHash, densified, packed to low-order bits.

Every five-word shingle is hashed once. The high bits of a hash choose its bin, and a bin keeps its smallest hash. Empty
bins are filled by optimal densification: an empty bin asks bins in an order that depends on its number alone, until one
is filled. Only the low-order bits of each bin are stored, packed into whole numbers; the likeness of two fingerprints is
the share of equal bins less what equal bits give by chance.

Words are what white space of ASCII parts, in small letters. A text of one to four words has one shingle, all of it; a
text without words, also null, has the fingerprint of zeros, like only to its own kind. All of it is built-in functions.
Documents follow each other by ``doc_id``, null first; rows of one id follow by text, and equal rows by chance, which
changes nothing. The last is followed by the first, a lone document by itself. An empty table gives no rows. Columns
other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import partitions, whole_text
from clickloom.llm.expressions import let, numbers
from clickloom.session import SHUFFLED_PER_STORED, bytes_read

SHINGLE_WORDS = 5
#: Bins and stored bits of each; a hash's high bits are its bin.
BIN_BITS, STORED_BITS = 8, 8
BINS, PER_NUMBER = 1 << BIN_BITS, 64 // STORED_BITS
#: Bins that an empty bin asks one by one; after these it takes the first filled one of an order of all.
PROBES = 24
#: Ids are cut into ranges at this many known quantiles at most; a range is cut further evenly.
MAX_QUANTILES = 1024
#: Ranges of ids for each shuffle partition, so that they can be spread evenly.
RANGES_PER_PARTITION = 4


def shingle_hashes(text: Column, width: int) -> Column:
    """A 64-bit hash of each shingle."""
    white = " \t\n\x0b\x0c\r"
    words = F.split(F.btrim(F.lower(text), F.lit(white)), r"[ \t\n\x0B\f\r]+")

    def hashes(words: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(words) - width),
            lambda i: F.xxhash64(*[F.get(words, i + n) for n in range(width)]),
        )
        whole = F.array(F.xxhash64(F.array_join(words, " ")))
        none = F.array().cast("array<bigint>")
        enough = F.size(words) >= width
        return F.when(enough, each).when(F.get(words, F.lit(0)) != "", whole).otherwise(none)

    return let(words, hashes)


def smallest_by_bin(hashes: Column) -> Column:
    """For each bin in order its smallest hash, null if it is empty.

    The largest hash that a bin can have is put in for every bin, so each bin is there once sorted.
    """
    free = 64 - BIN_BITS
    largest = (1 << free) - 1
    ends = numbers([((b - BINS // 2) << free) | largest for b in range(BINS)], "bigint")

    def firsts(ordered: Column) -> Column:
        bins = lambda at: F.shiftright(at, free)
        is_first = lambda x, i: (i == 0) | (bins(x) != bins(F.get(ordered, i - 1)))
        return F.transform(F.filter(ordered, is_first), lambda x: F.when(x.bitwiseAND(F.lit(largest)) != largest, x))

    return let(F.sort_array(F.concat(hashes, ends)), firsts)


def probe_order() -> tuple[list[list[int]], list[int], list[int]]:
    """For each bin: the bins it asks, and the start and the odd step of its order of all bins."""
    rng = random.Random(20)
    probes = [[rng.randrange(BINS) for _ in range(BINS)] for _ in range(PROBES)]
    return probes, [rng.randrange(BINS) for _ in range(BINS)], [rng.randrange(1, BINS, 2) for _ in range(BINS)]


def densified(bins: Column) -> Column:
    """The stored bits of all bins, empty ones filled; all 0 if all are empty.

    Stored are the low-order bits of the bin's value hashed with the bin's number. So bins that borrowed one value do
    not all agree with those of another value whose bits happen to be the same.
    """
    probes, starts, steps = probe_order()

    def fill(bins: Column) -> Column:
        def value(own: Column, at: Column) -> Column:
            asked = [F.get(bins, F.get(numbers(order), at)) for order in probes]
            every = F.transform(
                F.sequence(F.lit(0), F.lit(BINS - 1)),
                lambda n: F.get(bins, (F.get(numbers(starts), at) + n * F.get(numbers(steps), at)) % BINS),
            )
            first = F.get(F.filter(every, lambda x: x.isNotNull()), F.lit(0))
            filled = F.coalesce(own, *asked, first)
            bits = F.lit((1 << STORED_BITS) - 1).cast("bigint")
            return let(filled, lambda v: F.when(v.isNotNull(), F.xxhash64(v, at).bitwiseAND(bits)).otherwise(0))

        return F.transform(bins, value)

    return let(bins, fill)


def fingerprint(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """The packed bins of a text, an array of whole numbers."""

    def pack(bins: Column) -> Column:
        def number(n: Column) -> Column:
            share = F.slice(bins, n * PER_NUMBER + 1, F.lit(PER_NUMBER))
            return F.aggregate(
                share, F.lit(0).cast("bigint"), lambda total, x: F.shiftleft(total, STORED_BITS).bitwiseOR(x)
            )

        return F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_NUMBER - 1)), number)

    return let(densified(smallest_by_bin(shingle_hashes(text, width))), pack)


def likeness(left: Column, right: Column) -> Column:
    """The estimated share of common shingles of two fingerprints, 0 to 1.

    Bins that differ agree in their stored bits with a chance of 2^-bits; the estimate takes that off.
    """
    ones = sum(1 << (STORED_BITS * n) for n in range(PER_NUMBER))

    def unlike(a: Column, b: Column) -> Column:
        mixed = a.bitwiseXOR(b)
        shift = STORED_BITS // 2
        while shift:  # any bit of a group ends up in its lowest
            mixed = mixed.bitwiseOR(F.shiftrightunsigned(mixed, shift))
            shift //= 2
        return F.bit_count(mixed.bitwiseAND(F.lit(ones)))

    different = F.aggregate(F.zip_with(left, right, unlike), F.lit(0), lambda total, n: total + n)
    chance = 2.0**-STORED_BITS
    equal = 1 - different / F.lit(float(BINS))
    return F.greatest((equal - chance) / (1 - chance), F.lit(0.0))


def as_text(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda n: F.lower(F.lpad(F.hex(n), 16, "0"))), "")


def id_ranges(ids: DataFrame, key: str, wanted: int) -> Column:
    """A number for the range of ids that an id is in, in the order of ids; about as many ids to each."""
    cuts = min(wanted, MAX_QUANTILES)
    shares = [n / cuts for n in range(cuts + 1)]
    found = ids.agg(F.percentile_approx(key, shares, 50 * cuts)).first()[0] or []
    bounds = sorted(set(found))
    if len(bounds) < 2:
        return F.lit(0).cast("bigint")
    finer = -(-wanted // cuts)
    # Bounds are looked up in two steps: the group of bounds, then the bound in it.
    group = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[n : n + group] for n in range(0, len(bounds), group)]
    table = F.array(*[numbers(g, "bigint") for g in groups])
    heads = numbers([g[0] for g in groups], "bigint")
    id_ = F.col(key)
    upto = lambda values: F.size(F.filter(values, lambda bound: bound <= id_))
    place = let(
        F.greatest(upto(heads) - 1, F.lit(0)),
        lambda g: g * group + F.greatest(upto(F.get(table, g)) - 1, F.lit(0)),
    ).cast("bigint")
    if finer == 1:
        return place
    every = numbers(bounds, "bigint")

    def cut_evenly(place: Column) -> Column:
        low, high = F.get(every, place), F.coalesce(F.get(every, place + 1), F.get(every, place))
        size = high.cast("double") - low.cast("double")
        share = (id_.cast("double") - low.cast("double")) / F.greatest(size, F.lit(1.0))
        return place * finer + F.least(F.greatest(F.floor(share * finer), F.lit(0)), F.lit(finer - 1))

    return let(place, cut_evenly)


def with_next(rows: DataFrame, derived: dict[str, Column]) -> DataFrame:
    """The rows ``doc_id, text`` with derived columns, and ``next_<name>`` of the text and these columns: what the row
    that follows by ``doc_id, text`` has.

    Ids are cut into many ranges, dealt to the tasks in turn, so that each task has as many; how many there are goes by
    the bytes of the table. The first row of a range also goes to the range before it, to be the last one's successor
    there; so no task sees all rows.
    """
    smallest = -(1 << 63)
    tasks = partitions(rows.sparkSession, SHUFFLED_PER_STORED * bytes_read(rows))
    keyed = rows.select("doc_id", "text", F.coalesce("doc_id", F.lit(smallest)).alias("id_key"))
    ranged = keyed.withColumn("range", id_ranges(keyed, "id_key", RANGES_PER_PARTITION * tasks))
    # The first ids of the ranges: as many rows as ranges, some for each task.
    firsts = ranged.groupBy("range").agg(F.min("id_key").alias("id_key"))
    last_range = firsts.agg(F.max("range")).first()[0]
    before = F.coalesce(F.lag("range").over(Window.orderBy("range")), F.lit(last_range)).alias("range")
    firsts = firsts.select("id_key", before)
    leading = ranged.drop("range").join(F.broadcast(firsts), "id_key").groupBy("range", "id_key")
    no_id = F.lit(None).cast("bigint").alias("doc_id")
    guards = leading.agg(F.min("text").alias("text")).select(no_id, "text", "id_key", "range")
    both = ranged.withColumn("guard", F.lit(False)).unionByName(guards.withColumn("guard", F.lit(True)))
    order = Window.partitionBy("task", "range").orderBy("guard", "id_key", "text")
    dealt = both.withColumns(derived).withColumn("task", (F.col("range") % tasks).cast("int")).repartitionById(tasks, "task")
    followed = dealt.withColumns({f"next_{v}": F.lead(v).over(order) for v in ("text", *derived)})
    return followed.where("not guard").drop("guard", "task", "range", "id_key")


def edited_fingerprints(documents: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likenesses.

    The edited text has the last quarter (rounded down) of the code points replaced by the first as many, or all, of the
    next document. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    printed = with_next(rows, {"packed": fingerprint(F.col("text"), width)})
    n_chars = F.length("text")
    quarter = F.floor(n_chars / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - quarter), F.substring("next_text", F.lit(1), quarter))
    n_chars = n_chars.cast("bigint").alias("n_chars")
    texts = printed.select("doc_id", n_chars, "packed", "next_packed", edited.alias("edited"))
    twice = texts.select(
        "doc_id", "n_chars", "packed", "next_packed",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("edited"), width).alias("edited_packed"),
    )
    return twice.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("packed")).alias("fingerprint"),
        as_text(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"),
        likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )
