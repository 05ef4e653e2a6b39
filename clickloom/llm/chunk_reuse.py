"""Byte-level BPE ids and their text, with chunks that documents share encoded once.

A rolling hash over the last bytes cuts each text where its content says so, so equal passages give equal chunks
wherever they stand. Chunks found in several texts are encoded by one of them, the owner; the others refer to its ids.
Chunks that come again inside one text are encoded once there, too.

Where chunks meet, tokens may run across the join. It is repaired by encoding the text around it anew, from the left
chunk's last sync point to the right chunk's first, and through every chunk between them that has no two sync points, until
both ends are such points. A sync point is a place where a word of the vocabulary's pattern ends whatever stands
around: white space behind any other character, or a mark of a sentence behind a letter. From there on the ids agree
exactly with those stored. Texts of any script have such places where they have spaces, line breaks or these marks.

The work goes by distinct text: rows with equal texts share one result. Null texts are empty, with no tokens. Repeated
rows each get a row. An empty table gives no rows. Input columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import batch_of, map_rows, slices, stored, whole_text
from clickloom.llm.tokens import decode, encoder, id_bytes

#: A chunk ends where the low bits of the hash over the last WINDOW bytes are 0, every 2^CUT_BITS bytes on average. Shorter
#: chunks find more of what texts share, at 16 bytes of hash for each.
WINDOW, CUT_BITS = 32, 9
#: Bytes that the rolling hash takes on at a time.
SCAN_BYTES = 1 << 22

#: What no engine takes for white space, and white space for all of them.
SOLID, WHITE = r"[^\s\x1c-\x1f\x85\u180e\u200b-\u200f\u2028-\u202f\u205f-\u206f\ufeff]", r"[ \n\t]"
#: Letters in all engines (Latin, Greek, Cyrillic, Arabic, Japanese, Chinese, Korean), and marks of a sentence.
LETTER, STOP = "[A-Za-zα-ωА-яء-غぁ-ゖァ-ヺ一-龥가-힣]", "[.,;:!?)،؛؟。、，．：；！？）」』]"
SYNC = re.compile(f"(?<={SOLID})(?={WHITE})|(?<={LETTER})(?={STOP})")


@lru_cache(maxsize=1)
def byte_weights() -> np.ndarray:
    """A fixed pseudo-random number for each byte."""
    return np.asarray([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], np.uint32)


def cuts(data: bytes) -> list[int]:
    """Where chunks of a text's UTF-8 bytes end; always between characters. The last is the text's end."""
    found: list[np.ndarray] = []
    for start in range(0, len(data), SCAN_BYTES):
        first = max(0, start - WINDOW)
        part = np.frombuffer(data, np.uint8, min(len(data), start + SCAN_BYTES) - first, first)
        # The hash of a window of twice the length is that of its later half plus that of its shifted earlier half.
        rolling, length = byte_weights()[part], 1
        while length < WINDOW:
            longer = rolling.copy()
            longer[length:] += rolling[:-length] << np.uint32(length % 32)
            rolling, length = longer, 2 * length
        ends = np.flatnonzero((rolling >> np.uint32(32 - CUT_BITS)) == 0) + 1 + first
        found.append(ends[(ends > start) & (ends >= WINDOW)])
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    places = []
    for end in ends.tolist():
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if end < len(data) and (not places or end > places[-1]):
            places.append(end)
    return [*places, len(data)] if data else []


def chunks(text: str) -> list[bytes]:
    data, start, found = text.encode(), 0, []
    for end in cuts(data):
        found.append(data[start:end])
        start = end
    return found


def digest(data: bytes) -> bytes:
    """128 bits that stand for a text or chunk."""
    return xxhash.xxh3_128_digest(data)


def list_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of each distinct text of a batch by their hashes."""
    for (texts,) in slices(batches):
        rows = []
        for text in set(texts):
            parts = chunks(text)
            if len(parts) > 1:
                key = digest(text.encode())
                rows += [(key, part) for part in {digest(part) for part in parts}]
        yield batch_of(list(zip(*rows)) or [[], []], [pa.binary(), pa.binary()], ["text_key", "chunk"])


def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct text of a batch, compressed, so that little goes through the shuffle."""
    pressed = zstandard.ZstdCompressor(level=3)
    for (texts,) in slices(batches):
        rows = [(digest(data), pressed.compress(data)) for data in (text.encode() for text in set(texts))]
        yield batch_of(list(zip(*rows)) or [[], []], [pa.binary(), pa.binary()], ["text_key", "pressed"])


def text_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_ids, texts in slices(batches):
        keys = [digest(text.encode()) for text in texts]
        yield batch_of([doc_ids, keys], [pa.int64(), pa.binary()], ["doc_id", "text_key"])


def synced(part: str) -> tuple[int, int] | None:
    """The first and the last sync point of a chunk, if it has two."""
    first = SYNC.search(part)
    if first is None:
        return None
    # The last one is near the end; look at more of the chunk only if it is not.
    reach = 64
    while True:
        tail = max(first.start(), len(part) - reach)
        last = None
        for last in SYNC.finditer(part, tail):
            pass
        if last is not None and (last.start() > tail or tail == first.start()):
            return (first.start(), last.start()) if last.start() > first.start() else None
        if tail == first.start():
            return None
        reach *= 4


FOUND = (
    "kind int, key binary, place int, ids binary, chunk binary, n_tokens bigint, ids_sha256 string,"
    " decoded_sha256 string"
)
FOUND_NAMES = [part.split()[0] for part in FOUND.split(", ")]
FOUND_TYPES = [pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.string()]
#: Kinds of rows: a text's whole result, an owner's chunk, a part of a text that refers to chunks: ids of its own, then
#: those of the chunk (in the last part: none).
WHOLE, OWNED, PART = 0, 1, 2


def summary(ids: bytes, path: str) -> tuple[int, str, str]:
    """Number of ids, and the SHA-256 of the ids and of the text that they decode to."""
    text = decode(ids, path).encode()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()


def narrow(ids: bytes, path: str) -> bytes:
    """Ids in as few bytes as the vocabulary needs, for the way through a shuffle."""
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if len(id_bytes(path)) <= 1 << 16 else ids


def widened(ids: bytes, path: str) -> bytes:
    """What :func:`narrow` was given."""
    return np.frombuffer(ids, "<u2").astype("<u4").tobytes() if len(id_bytes(path)) <= 1 << 16 else ids


def parts_of(
    text: str, owned: set[bytes], others: set[bytes], encode: Callable[[str], bytes]
) -> tuple[list[tuple[bytes, bytes | None]], dict[bytes, bytes]]:
    """The text's ids in parts, each its own ids and the chunk of another text that follows them (in the last: none), and
    the ids of the chunks that it owns.

    A chunk's ids run from its first sync point to its last one; what lies between two chunks is a join.
    """
    found = chunks(text)
    names = [digest(chunk) for chunk in found]
    again = {name for name, times in Counter(names).items() if times > 1}
    parts: list[tuple[bytes, bytes | None]] = []
    known: dict[bytes, bytes] = {}
    own: list[bytes] = []
    join: list[str] = []
    for chunk, name in zip(found, names, strict=True):
        part = chunk.decode()
        bounds = synced(part) if name in owned or name in others or name in again else None
        if bounds is None:
            join.append(part)
            continue
        first, last = bounds
        own.append(encode("".join([*join, part[:first]])))
        join = [part[last:]]
        if name in others:
            parts.append((b"".join(own), name))
            own = []
            continue
        if name not in known:
            known[name] = encode(part[first:last])
        own.append(known[name])
    own.append(encode("".join(join)))
    return [*parts, (b"".join(own), None)], {name: ids for name, ids in known.items() if name in owned}


def encode_texts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Encode what each text owns; texts that refer to chunks of others come out in parts."""
    encode = encoder(path).encode
    unpress = zstandard.ZstdDecompressor()
    for keys, texts, owned_chunks, other_chunks in slices(batches):
        rows: list[tuple] = []
        for key, pressed, owned, others in zip(keys, texts, owned_chunks, other_chunks, strict=True):
            parts, stored_chunks = parts_of(unpress.decompress(pressed).decode(), set(owned or ()), set(others or ()), encode)
            rows += [(OWNED, name, None, narrow(ids, path), None, None, None, None) for name, ids in stored_chunks.items()]
            if len(parts) > 1:
                rows += [(PART, key, n, narrow(ids, path), name, None, None, None) for n, (ids, name) in enumerate(parts)]
            else:
                rows.append((WHOLE, key, None, None, None, *summary(parts[0][0], path)))
            if len(rows) >= 512:
                yield batch_of(list(zip(*rows)), FOUND_TYPES, FOUND_NAMES)
                rows = []
        yield batch_of(list(zip(*rows)) or [[]] * len(FOUND_NAMES), FOUND_TYPES, FOUND_NAMES)


def join_parts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """The results of texts whose parts have come together."""
    types = [pa.binary(), *FOUND_TYPES[-3:]]
    for batch in batches:
        for at in range(batch.num_rows):
            key, parts = (batch.column(i)[at].as_py() for i in range(2))
            ids = b"".join(part["ids"] + (part["chunk_ids"] or b"") for part in parts)
            found = (key, *summary(widened(ids, path), path))
            yield batch_of([[value] for value in found], types, ["key", *FOUND_NAMES[-3:]])


#: Copies of the owners' chunks, so that the texts that refer to one chunk do not all meet in one task.
SALTS = 16


def chunk_uses(texts: DataFrame) -> DataFrame:
    """``text_key, owned, others``: of each distinct text with shared chunks, those that it is to encode for all, and
    those that others encode. The owner of a chunk is the text with the smallest key."""
    # Copies of a text have one key, so they share no chunk by themselves.
    listed = stored(texts.sparkSession, "chunks", map_rows(texts, list_chunks, "text_key binary, chunk binary"))
    ends = listed.groupBy("chunk").agg(F.min("text_key").alias("owner"), F.max("text_key").alias("last"))
    shared = ends.where("owner < last").drop("last")
    salt = F.pmod(F.xxhash64("text_key"), F.lit(SALTS)).cast("int")
    copies = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    uses = listed.withColumn("salt", salt).join(copies, ["chunk", "salt"])
    is_owner = F.col("text_key") == F.col("owner")
    return uses.groupBy("text_key").agg(
        F.collect_set(F.when(is_owner, F.col("chunk"))).alias("owned"),
        F.collect_set(F.when(~is_owner, F.col("chunk"))).alias("others"),
    )


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each whole text, by the vocabulary file at ``path``.

    The ids are those of ``encode(text, add_special_tokens=False)``; they are decoded with special tokens kept.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    texts = rows.select("text")
    distinct = map_rows(texts, press, "text_key binary, pressed binary").groupBy("text_key")
    with_uses = distinct.agg(F.first("pressed").alias("pressed")).join(chunk_uses(texts), "text_key", "left")
    found = stored(spark, "encoded", map_rows(with_uses, partial(encode_texts, path=path), FOUND))

    parts = found.where(F.col("kind") == PART).select("key", "place", "ids", "chunk")
    owned = found.where(F.col("kind") == OWNED).select(F.col("key").alias("chunk"), F.col("ids").alias("chunk_ids"))
    owned = owned.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    by_name = parts.where(F.col("chunk").isNotNull())
    by_name = by_name.withColumn("salt", F.pmod(F.xxhash64("key", "place"), F.lit(SALTS)).cast("int"))
    looked_up = by_name.join(owned, ["chunk", "salt"]).select("key", "place", "ids", "chunk_ids")
    last = parts.where(F.col("chunk").isNull()).select("key", "place", "ids", F.lit(None).cast("binary").alias("chunk_ids"))
    in_order = last.unionByName(looked_up).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("place", "ids", "chunk_ids"))).alias("parts")
    )
    result = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    joined = map_rows(in_order, partial(join_parts, path=path), f"key binary, {result}")
    whole = found.where(F.col("kind") == WHOLE).select("key", *FOUND_NAMES[-3:])
    results = whole.unionByName(joined).withColumnRenamed("key", "text_key")
    keys = map_rows(rows, text_keys, "doc_id bigint, text_key binary")
    return keys.join(results, "text_key").drop("text_key")
