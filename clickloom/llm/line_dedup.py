"""Line dedup that can be taken back: sharded cuckoo filters before exact reference counts.

An index counts in how many documents each line stands. Documents can be added and removed; the counts are exact, so
removing what was added gives the former state again. Lines that reach the limit go into the cuckoo filter of their
shard and leave it when they fall below. There are as many shards as keep one below ``SHARD_KEYS`` keys; their number is
stored with each version.

Documents are cut in place. A first scan asks the filters for the lines that they know; those that the exact counts do not
confirm, a few in ten thousand, are the filters' mistakes. A second scan drops the lines that the filters know and that
are no mistake. So no text is shuffled. The filters and their mistakes are sent to all tasks only if both are below
``block_bytes``. Beyond that they are sent in blocks of that size, and the texts meet their confirmed lines in a join.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased; lines whose key is empty never count
and always stay. A row is a document, so repeated rows count as often as they are there. Null texts are one empty line.
An empty table gives no rows; removing documents that were never added leaves no count below zero. Columns other than
``text`` are passed through, but for ``n_lines`` and ``n_dropped``, which are replaced, and ``n_chars``, if there is one,
which becomes that of the new text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import KEPT, batch_of, map_rows, slices, stored, whole_text
from clickloom.session import work_folder

MIN_DOCUMENTS = 10
#: Keys of a shard, about; its task holds them all.
SHARD_KEYS = 1 << 18
#: Filters that are sent to all tasks at a time; if there are more, documents are scanned once for each such block.
BLOCK_BYTES = 64 * 1024 * 1024
KEY_BYTES = 16
WHITE_SPACE = b" \t\n\x0b\x0c\r"
#: Copies of a counted line, so that the texts that hold one line do not all meet in one task.
SALTS = 16
SLOTS, MAX_MOVES = 4, 500
#: Documents that are cut at a time.
CUT_ROWS = 64


#: Columns beside the documents' own while these are joined.
TEXT_KEY, DROPPED = "line_dedup_text_key", "line_dedup_dropped"


def line_key(line: bytes) -> bytes | None:
    """128 bits that stand for a line's key; none for a blank line."""
    key = line.strip(WHITE_SPACE).lower()
    return xxhash.xxh3_128_digest(key) if key else None


def shard_column(key: str, shards: int) -> F.Column:
    """A key's shard, by its first four bytes."""
    return F.pmod(F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


class CuckooFilter:
    """A set of keys by 16-bit marks in buckets of four; keys can be taken out again. It grows as needed."""

    def __init__(self, slots: bytes = b""):
        self.marks = np.frombuffer(slots, "<u2").reshape(-1, SLOTS).copy() if slots else np.zeros((1, SLOTS), "<u2")

    def places(self, key: bytes) -> tuple[int, int, int]:
        """The mark, which is never 0, and the two buckets where it may be."""
        mark = int.from_bytes(key[4:6], "big") or 1
        first = int.from_bytes(key[8:16], "big") % len(self.marks)
        return mark, first, self.other(first, mark)

    def other(self, bucket: int, mark: int) -> int:
        # len is a power of two, so the same step leads back.
        return (bucket ^ (mark * 0x5BD1E995)) % len(self.marks)

    def __contains__(self, key: bytes) -> bool:
        return bool(self.known(np.frombuffer(key, np.uint8).reshape(1, KEY_BYTES))[0])

    def known(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys, a row of bytes each, may be in the filter."""
        mark = np.maximum(keys[:, 4:6].copy().view(">u2")[:, 0].astype(np.uint64), 1)
        last = np.uint64(len(self.marks) - 1)  # len is a power of two
        first = keys[:, 8:16].copy().view(">u8")[:, 0].astype(np.uint64) & last
        second = (first ^ (mark * np.uint64(0x5BD1E995))) & last
        marks = mark.astype("<u2")[:, None]
        return (self.marks[first] == marks).any(axis=1) | (self.marks[second] == marks).any(axis=1)

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.marks[bucket] == 0)
        if len(free):
            self.marks[bucket, free[0]] = mark
        return bool(len(free))

    def add(self, key: bytes) -> bool:
        """Whether there was room; if not, the filter is as before and has to be built anew with more buckets."""
        mark, first, second = self.places(key)
        if self._put(first, mark) or self._put(second, mark):
            return True
        moved, bucket = [], second
        for move in range(MAX_MOVES):
            slot = (mark + move) % SLOTS
            moved.append((bucket, slot, int(self.marks[bucket, slot])))
            self.marks[bucket, slot], mark = mark, int(self.marks[bucket, slot])
            bucket = self.other(bucket, mark)
            if self._put(bucket, mark):
                return True
        for bucket, slot, mark in reversed(moved):
            self.marks[bucket, slot] = mark
        return False

    def remove(self, key: bytes) -> None:
        """Take out a key that was added."""
        mark, first, second = self.places(key)
        for bucket in (first, second):
            found = np.flatnonzero(self.marks[bucket] == mark)
            if len(found):
                self.marks[bucket, found[0]] = 0
                return

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        """A filter of all these keys, at most 90 % full."""
        buckets = 1 << max(0, (int(len(keys) / SLOTS / 0.9)).bit_length())
        while True:
            made = cls(bytes(2 * SLOTS * buckets))
            if all(made.add(key) for key in keys):
                return made
            buckets *= 2


FILTER = "shard int, slots binary, shards int"


def changed_filter(old: pa.Table, keys: pa.Table, shards: int) -> pa.Table:
    """One shard's filter after its changes; built anew from all its keys if it has no room for the new ones.

    ``keys`` has all keys of the shard that are or were in the filter; ``was`` and ``now`` tell which.
    """
    shard = (old if len(old) else keys)["shard"][0].as_py()
    changed = CuckooFilter(old["slots"][0].as_py() if len(old) else b"")
    rows = list(zip(*(keys[name].to_pylist() for name in ("line", "was", "now")), strict=True))
    for key, was, now in rows:
        if was and not now:
            changed.remove(key)
    if not all(changed.add(key) for key, was, now in rows if now and not was):
        changed = CuckooFilter.of([key for key, _, now in rows if now])
    columns = [([shard], pa.int32()), ([changed.marks.tobytes()], pa.binary()), ([shards], pa.int32())]
    return pa.table([pa.array(*column) for column in columns], names=["shard", "slots", "shards"])


def filter_task(shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda old, keys: changed_filter(old, keys, shards)


def text_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's distinct line keys."""
    for (texts,) in slices(batches):
        keys = [key for text in texts for key in {line_key(line) for line in text.encode().split(b"\n")} if key]
        yield batch_of([keys], [pa.binary()], ["line"])


class Known:
    """The lines that some shards' filters know, without their mistakes."""

    def __init__(self, filters: dict[int, bytes], shards: int, mistakes: bytes = b""):
        self.filters = {shard: CuckooFilter(slots) for shard, slots in filters.items()}
        self.shards = shards
        self.mistakes = {mistakes[i : i + KEY_BYTES] for i in range(0, len(mistakes), KEY_BYTES)}

    def among(self, keys: Collection[bytes]) -> set[bytes]:
        """Those of the keys that the filters know."""
        keys = list(keys)
        data = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY_BYTES)
        shard = data[:, :4].copy().view(">u4")[:, 0] % self.shards
        found = set()
        for number, known in self.filters.items():
            at = np.flatnonzero(shard == number)
            if len(at):
                found.update(keys[i] for i in at[known.known(data[at])].tolist())
        return found - self.mistakes


def keys_of(text: str) -> set[bytes]:
    return {key for line in text.encode().split(b"\n") if (key := line_key(line))}


def known_lines(
    batches: Iterator[pa.RecordBatch], filters: Broadcast[dict[int, bytes]], shards: int
) -> Iterator[pa.RecordBatch]:
    """The line keys that the filters know, for each distinct text of a batch."""
    known = Known(filters.value, shards)
    for (texts,) in slices(batches):
        rows = []
        for text in set(texts):
            found = known.among(keys_of(text))
            if found:
                name = hashlib.md5(text.encode(), usedforsecurity=False).digest()
                rows += [(name, key) for key in found]
        yield batch_of(list(zip(*rows)) or [[], []], [pa.binary(), pa.binary()], ["text_key", "line"])


def known_keys(
    batches: Iterator[pa.RecordBatch], filters: Broadcast[dict[int, bytes]], shards: int
) -> Iterator[pa.RecordBatch]:
    """The line keys that the filters know, once for some texts."""
    known = Known(filters.value, shards)
    for (texts,) in slices(batches):
        found = known.among(set().union(*map(keys_of, texts)))
        yield batch_of([sorted(found)], [pa.binary()], ["line"])


def cut_lines(
    batches: Iterator[pa.RecordBatch], filters: Broadcast[dict[int, bytes]], shards: int, mistakes: Broadcast[bytes]
) -> Iterator[pa.RecordBatch]:
    """Documents without the lines that the filters know, but for their mistakes."""
    known = Known(filters.value, shards, mistakes.value)
    for batch in batches:
        for start in range(0, batch.num_rows, CUT_ROWS):
            part = batch.slice(start, CUT_ROWS)
            texts = part["text"].to_pylist()
            gone = known.among(set().union(*map(keys_of, texts)))
            yield cut_rows(part, texts, [gone] * len(texts))


def cut_rows(part: pa.RecordBatch, texts: list[str], gone: list[Collection[bytes]]) -> pa.RecordBatch:
    """The rows with their texts less some lines, and how many lines they had and lost."""
    kept_texts, n_lines, n_dropped = [], [], []
    for text, own in zip(texts, gone, strict=True):
        lines = text.encode().split(b"\n")
        kept = [line for line in lines if line_key(line) not in own] if own else lines
        kept_texts.append(b"\n".join(kept) if len(kept) < len(lines) else text)
        n_lines.append(len(lines))
        n_dropped.append(len(lines) - len(kept))
    columns = {name: part[name] for name in part.schema.names if name not in (DROPPED, TEXT_KEY)}
    columns["text"] = pa.array([t if isinstance(t, str) else t.decode() for t in kept_texts], pa.string())
    columns |= {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without the lines whose keys are in ``dropped``."""
    for batch in batches:
        for start in range(0, batch.num_rows, CUT_ROWS):
            part = batch.slice(start, CUT_ROWS)
            yield cut_rows(part, part["text"].to_pylist(), [set(keys or ()) for keys in part[DROPPED].to_pylist()])


@dataclass
class LineIndex:
    """Counts and filters of the lines of the documents added so far, in the shared folder; a new version each time.

    A filter takes two to four bytes for each line that has reached the limit. A task holds the keys of one shard,
    ``shard_keys`` about, and a block the filter of one shard at least.
    """

    spark: SparkSession
    min_documents: int = MIN_DOCUMENTS
    shard_keys: int = SHARD_KEYS
    block_bytes: int = BLOCK_BYTES

    def __post_init__(self) -> None:
        self.folder = work_folder(self.spark, "llm-line-index")
        self.version = 0
        KEPT.append(self.folder)

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{self.version}/{name}")

    @property
    def counts(self) -> DataFrame:
        """``line, documents``: in how many documents each line is."""
        return self._read("counts", "line binary, before bigint, documents bigint").drop("before").where("documents > 0")

    @property
    def filters(self) -> DataFrame:
        return self._read("filters", FILTER)

    @property
    def shards(self) -> int:
        """How many shards the filters of this version have; 0 without filters."""
        row = self.filters.select("shards").first()
        return row["shards"] if row else 0

    def add(self, documents: DataFrame) -> None:
        self._change(documents, 1)

    def remove(self, documents: DataFrame) -> None:
        """Take documents out that were added, by their texts."""
        self._change(documents, -1)

    def _change(self, documents: DataFrame, by: int) -> None:
        lines = map_rows(documents.select(whole_text().alias("text")), text_lines, "line binary")
        delta = lines.groupBy("line").agg((F.count("*") * by).alias("change"))
        both = self.counts.join(delta, "line", "full")
        before = F.coalesce("documents", F.lit(0))
        after = F.greatest(before + F.coalesce("change", F.lit(0)), F.lit(0))
        new = f"{self.folder}/{self.version + 1}"
        both.select("line", before.alias("before"), after.alias("documents")).write.parquet(f"{new}/counts")
        changes = self.spark.read.parquet(f"{new}/counts")
        limit = F.lit(self.min_documents)
        concerned = changes.where((F.col("before") >= limit) | (F.col("documents") >= limit))
        shards = -(-max(concerned.count(), 1) // self.shard_keys)
        same = shards <= self.shards <= 4 * shards  # else all filters are made anew
        shards = self.shards if same else 2 * shards
        keys = concerned.select(
            shard_column("line", shards).alias("shard"),
            "line",
            ((F.col("before") >= limit) & F.lit(same)).alias("was"),
            (F.col("documents") >= limit).alias("now"),
        )
        old = self.filters if same else self.filters.limit(0)
        changed = old.groupBy("shard").cogroup(keys.groupBy("shard"))
        changed.applyInArrow(filter_task(shards), FILTER).write.parquet(f"{new}/filters")
        self.version += 1

    def _blocks(self) -> Iterator[dict[int, bytes]]:
        """The filters, as many at a time as a block holds."""
        sizes = self.filters.select("shard", F.length("slots").alias("size")).orderBy("shard").collect()
        block: list[int] = []
        held = 0
        for row in sizes:
            if block and held + row["size"] > self.block_bytes:
                yield self._filters_of(block)
                block, held = [], 0
            block.append(row["shard"])
            held += row["size"]
        if block:
            yield self._filters_of(block)

    def _filters_of(self, shards: list[int]) -> dict[int, bytes]:
        return {row.shard: bytes(row.slots) for row in self.filters.where(F.col("shard").isin(shards)).collect()}

    def _found(self, documents: DataFrame, task: Callable, schema: str) -> DataFrame:
        """What a task finds in all texts, for each block of filters."""
        texts = documents.select(whole_text().alias("text"))
        found, shards = self.spark.createDataFrame([], schema), self.shards
        for block in self._blocks():
            own = partial(task, filters=self.spark.sparkContext.broadcast(block), shards=shards)
            found = found.unionByName(map_rows(texts, own, schema))
        return found.distinct()

    def dropped_lines(self, documents: DataFrame) -> DataFrame:
        """``text_key, dropped``: the line keys that each text loses; texts without any are not there."""
        found = self._found(documents, known_lines, "text_key binary, line binary")
        found = found.withColumn("salt", F.pmod(F.xxhash64("text_key"), F.lit(SALTS)).cast("int"))
        often = self.counts.where(F.col("documents") >= self.min_documents).select("line")
        often = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        exact = found.join(often, ["line", "salt"], "left_semi")
        return exact.groupBy("text_key").agg(F.collect_list("line").alias("dropped"))

    def mistakes(self, documents: DataFrame) -> DataFrame:
        """``line``: what the filters know among the documents' lines, but the counts do not confirm."""
        often = self.counts.where(F.col("documents") >= self.min_documents).select("line")
        return self._found(documents, known_keys, "line binary").join(often, "line", "left_anti")

    def apply(self, documents: DataFrame) -> DataFrame:
        """The documents without the lines that are in at least ``min_documents`` of the documents added."""
        names = [name for name in documents.columns if name not in ("n_lines", "n_dropped")]
        rows = documents.select(*[whole_text().alias("text") if name == "text" else F.col(name) for name in names])
        counts = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
        schema = T.StructType([*rows.schema.fields, *counts])
        kept = self._cut(documents, rows, schema)
        if "n_chars" in names:
            kept = kept.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))
        return kept

    def _cut(self, documents: DataFrame, rows: DataFrame, schema: T.StructType) -> DataFrame:
        size = self.filters.agg(F.coalesce(F.sum(F.length("slots")), F.lit(0))).first()[0]
        if size <= self.block_bytes:
            mistakes = stored(self.spark, "filter-mistakes", self.mistakes(documents))
            if mistakes.count() * KEY_BYTES <= self.block_bytes:
                send = self.spark.sparkContext.broadcast
                wrong = b"".join(bytes(row.line) for row in mistakes.collect())
                filters = {row.shard: bytes(row.slots) for row in self.filters.collect()}
                task = partial(cut_lines, filters=send(filters), shards=max(self.shards, 1), mistakes=send(wrong))
                return map_rows(rows, task, schema)
        keyed = rows.withColumn(TEXT_KEY, F.unhex(F.md5("text")))
        # A table of its own, so that the join's two sides come straight from their shuffles and copies of one text,
        # however many, can be split over tasks.
        dropped = self.dropped_lines(documents).withColumnsRenamed({"text_key": TEXT_KEY, "dropped": DROPPED})
        joined = keyed.join(stored(self.spark, "dropped-lines", dropped), TEXT_KEY, "left")
        return map_rows(joined, without_lines, schema)


def dedup_lines(documents: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents without the lines that at least ``min_documents`` of them have; ``n_lines, n_dropped`` besides."""
    index = LineIndex(documents.sparkSession, min_documents)
    index.add(documents)
    return index.apply(documents)
