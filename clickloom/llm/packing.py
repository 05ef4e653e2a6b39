"""Packing of tokenized documents into sequences by swap-based local search.

A document's ids and the end id are cut into pieces only if they are more than a sequence holds. Pieces are dealt to
blocks of bounded size. In each block they are packed best fit, longest first; then pieces are moved and swapped between
underfull sequences (one, one for one, two for one), as long as that increases the sum of squared fills, until sequences
are empty and there are as few as the pieces must have, or no exchange is left. If none is left too early, the block
starts once more from best fit in the order of its keys, and the better packing stays. The emptiest sequences of all
blocks are taken apart and go to a quarter as many blocks, until one block has searched what is left. So underfull
sequences of different blocks meet at every size, only lengths are shuffled, never texts or ids, and no task packs more
than a block.

Null texts are empty: their sequence is the end id alone. Repeated rows and equal ids are pieces of their own. An empty
table gives no rows. Input columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import batch_of, map_rows, slices, stored, whole_text
from clickloom.llm.tokens import as_bytes, encoder

SEQUENCE_TOKENS = 4096
END_ID = 1
#: Pieces that a task packs at a time.
BLOCK_PIECES = 8192
#: Blocks whose emptiest sequences go to one block of the next turn.
MERGED_BLOCKS = 4

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
PLACED = f"{PIECES}, piece_key bigint, sequence_id bigint, offset bigint, open boolean"


def cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Encode documents; one row per piece."""
    encode, end = encoder(path).encode, as_bytes([end_id])
    for doc_ids, texts in slices(batches):
        out: list[list] = [[] for _ in PIECE_NAMES]
        for doc_id, text in zip(doc_ids, texts, strict=True):
            ids = encode(text) + end
            for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                part = ids[4 * start : 4 * (start + capacity)]
                row = (doc_id, piece, start, len(part) // 4, zlib.crc32(part))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        yield batch_of(out, PIECE_TYPES, PIECE_NAMES)


def pieces(documents: DataFrame, path: str, capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """A row per piece of each document: its place in the document, length, and the CRC-32 of its ids."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return map_rows(rows, partial(cut, path=path, capacity=capacity, end_id=end_id), PIECES)


class Sequences:
    """A block's sequences: the piece numbers of each, and how full it is."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.members: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self, order: np.ndarray | None = None) -> None:
        """Each piece, longest first or in the given order, into the fullest sequence that has room, found by its free
        tokens."""
        order = np.argsort(-self.lengths, kind="stable") if order is None else order
        with_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        free_sizes = np.zeros(self.capacity + 1, bool)
        for piece in order.tolist():
            length = int(self.lengths[piece])
            found = int(free_sizes[length:].argmax()) + length
            if free_sizes[found]:
                sequence = with_room[found].pop()
                free_sizes[found] = bool(with_room[found])
                self.members[sequence].append(piece)
                self.fill[sequence] += length
            else:
                sequence = len(self.members)
                self.members.append([piece])
                self.fill.append(length)
            free = self.capacity - self.fill[sequence]
            if free:
                with_room[free].append(sequence)
                free_sizes[free] = True

    def exchange(self, source: int, target: int, given: list[int], taken: list[int]) -> None:
        """Move pieces from ``source`` to ``target`` and others back."""
        for sequence, out, into in ((source, given, taken), (target, taken, given)):
            kept = [piece for piece in self.members[sequence] if piece not in out]
            self.members[sequence] = kept + into
            self.fill[sequence] = int(self.lengths[self.members[sequence]].sum())

    def units(self, sequences: list[int]) -> tuple[np.ndarray, ...]:
        """What each of these sequences can give: length, sequence, pieces (-1: no second piece).

        Pieces of one length are alike, so a unit for each length and each two lengths does; as the lengths in a sequence
        add up to its fill at most, there are never more of these than it holds tokens, about.
        """
        first, second, owner = [], [], []
        for sequence in sequences:
            pieces = np.asarray(self.members[sequence])
            _, at, many = np.unique(self.lengths[pieces], return_index=True, return_counts=True)
            i, j = np.triu_indices(len(at), 1)
            alike = at[many > 1]
            # Another piece of the same length, by looking from the other end.
            _, behind = np.unique(self.lengths[pieces[::-1]], return_index=True)
            other = (len(pieces) - 1 - behind)[many > 1]
            first += [pieces[at], pieces[at[i]], pieces[alike]]
            second += [np.full(len(at), -1), pieces[at[j]], pieces[other]]
            owner.append(np.full(len(at) + len(i) + len(alike), sequence))
        one, two, owner = map(np.concatenate, (first, second, owner))
        length = self.lengths[one] + np.where(two >= 0, self.lengths[two], 0)
        return length, owner, one, two

    def exchanges(self) -> list[tuple[int, int, list[int], list[int]]]:
        """Exchanges that increase the sum of squared fills, best first, no sequence in two of them.

        A sequence gives one or two pieces for none, one or two of another, two for two excepted. What is given is the
        largest that the other has room for; d tokens more in a sequence of fill f, taken from one of fill g, add
        2 d (f - g + d) to the sum.
        """
        sequences = [s for s, fill in enumerate(self.fill) if 0 < fill < self.capacity]
        if len(sequences) < 2:
            return []
        fill = np.asarray(self.fill)
        length, owner, one, two = self.units(sequences)
        # Targets take for a unit of theirs, or for nothing.
        targets = np.r_[owner, sequences]
        back = np.r_[length, np.zeros(len(sequences), np.int64)]
        paired = np.r_[two >= 0, np.zeros(len(sequences), bool)]
        found = []
        for of_two in (False, True):
            given = np.flatnonzero((two >= 0) == of_two)
            if not len(given):
                continue
            given = given[np.argsort(length[given], kind="stable")]
            asking = np.flatnonzero(~paired) if of_two else np.arange(len(targets))
            at = np.searchsorted(length[given], back[asking] + self.capacity - fill[targets[asking]], side="right") - 1
            while len(asking):
                more = (at >= 0) & (length[given[at]] > back[asking])
                asking, at = asking[more], at[more]
                d = length[given[at]] - back[asking]
                f, g = fill[targets[asking]], fill[owner[given[at]]]
                good = (owner[given[at]] != targets[asking]) & (f - g + d > 0)
                found.append(np.stack([(d * (f - g + d))[good], asking[good], given[at][good]]))
                asking, at = asking[~good], at[~good] - 1
        gain, asked, giving = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        chosen, touched = [], set()
        for n in np.argsort(-gain, kind="stable").tolist():
            unit, taken = int(giving[n]), int(asked[n])
            source, target = int(owner[unit]), int(targets[taken])
            if source not in touched and target not in touched:
                touched |= {source, target}
                own = [int(p) for p in (one[unit], two[unit]) if p >= 0]
                other = [int(p) for p in (one[taken], two[taken]) if p >= 0] if taken < len(one) else []
                chosen.append((source, target, own, other))
        return chosen

    def count(self) -> int:
        return sum(1 for members in self.members if members)

    def needed(self) -> int:
        """As few sequences as the pieces must have."""
        large = int((self.lengths > self.capacity // 2).sum())
        return max(-(-int(self.lengths.sum()) // self.capacity), large)

    def search(self) -> None:
        """Exchange as long as there are more sequences than the pieces must have and an exchange is left."""
        needed = self.needed()
        while self.count() > needed:
            chosen = self.exchanges()
            if not chosen:
                return
            for exchange in chosen:
                self.exchange(*exchange)


def packed_by_search(lengths: np.ndarray, order: np.ndarray, capacity: int) -> Sequences:
    """The best of two searches: from best fit by length and, if that stops early, by the given order."""
    best = Sequences(lengths, capacity)
    best.best_fit()
    best.search()
    if best.count() > best.needed():
        again = Sequences(lengths, capacity)
        again.best_fit(order)
        again.search()
        best = min(best, again, key=Sequences.count)
    return best


def handed_on(packed: Sequences, quota: int) -> list[int]:
    """The emptiest sequences that are not full, with ``quota`` pieces together, but at least one sequence."""
    chosen, held = [], 0
    is_open = [n for n, members in enumerate(packed.members) if members and packed.fill[n] < packed.capacity]
    for number in sorted(is_open, key=lambda n: packed.fill[n]):
        held += len(packed.members[number])
        if chosen and held > quota:
            break
        chosen.append(number)
    return chosen


def pack_block(rows: pa.Table, capacity: int, base: int, quota: int) -> pa.Table:
    """Place the pieces of one block; its sequences are numbered from ``base`` + block * 2^20. Those to be taken apart
    again, of ``quota`` pieces, are marked open."""
    rows = rows.sort_by([("length", "descending"), ("piece_key", "ascending")])
    lengths = rows["length"].to_numpy()
    keys = rows["piece_key"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    packed = packed_by_search(lengths, np.argsort(keys, kind="stable"), capacity)
    sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    is_open = np.zeros(len(rows), bool)
    for number, members in enumerate(packed.members):
        sequence[members] = number
        offset[members] = np.cumsum(lengths[members]) - lengths[members]
    for number in handed_on(packed, quota) if quota else ():
        is_open[packed.members[number]] = True
    sequence += base + (rows["block"][0].as_py() << 20)
    placed = rows.drop_columns("block").append_column("sequence_id", pa.array(sequence))
    return placed.append_column("offset", pa.array(offset)).append_column("open", pa.array(is_open))


def block_task(capacity: int, base: int, quota: int) -> Callable[[pa.Table], pa.Table]:
    return lambda block: pack_block(block, capacity, base, quota)


def pack(cut_pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Give each piece a sequence and a place in it: ``sequence_id``, ``offset``.

    Takes the columns of :func:`pieces`. Sequence numbers only tell sequences apart. Every turn has at most a quarter of
    the blocks of the one before, so the number of turns grows with the logarithm of the pieces.
    """
    spark = cut_pieces.sparkSession
    rows = stored(spark, "pieces", cut_pieces.withColumn("piece_key", F.monotonically_increasing_id()))
    whole = rows.where(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - F.col("piece_key"), "offset": F.lit(0).cast("bigint")}
    )
    done, loose = [whole], rows.where(F.col("length") < capacity)
    count, turn = loose.count(), 0
    blocks = -(-count // block_pieces)
    while count:
        fewer = -(-blocks // MERGED_BLOCKS) if blocks > 1 else 0
        dealt = loose.withColumn("block", F.pmod(F.xxhash64("piece_key", F.lit(turn)), F.lit(blocks)))
        task = block_task(capacity, turn << 50, quota=block_pieces * fewer // blocks)
        placed = stored(spark, "packed", dealt.groupBy("block").applyInArrow(task, PLACED))
        done.append(placed.where("not open").drop("open"))
        loose = placed.where("open").drop("sequence_id", "offset", "open")
        count = loose.count() if fewer else 0
        blocks, turn = min(fewer, -(-count // block_pieces)), turn + 1
    packed = done[0]
    for part in done[1:]:
        packed = packed.unionByName(part)
    return packed.drop("piece_key")
