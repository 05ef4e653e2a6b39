"""Conversation structure repair with Four-Russians block tables.

The cheapest edits that give a conversation the roles ``(s?(ua)+)?`` (initials of system, user, assistant) are found from
its end to its start: for each of four states of the roles so far, what the rest costs. Less their smallest, these cost
vectors are few, so for each vector and each block of ``BLOCK_ROWS`` symbols the vector before the block, and what it adds,
stand in tables that are made once. A conversation is worked off by one lookup a block. Then each block is expanded
backward from the vector behind it, and the edits are traced forward: of the edits that keep the cost least, the one whose
initial is least in ASCII. A traced block is remembered by its symbols, vector and state.

Edits: Keep (0), Rerole to user or assistant (1), Delete (2, required for blank and duplicate rows), Insert a row of user
or assistant with an empty text (5); a truncated row that is not deleted costs 5 more.

Rows of a conversation are taken by turn, nulls first; rows of one turn by role and the SHA-256 of the text. Only numbers
and hashes are shuffled for the search, texts once for the digest. Both passes stream: what a task holds of a conversation
is a few bytes a row, as much as the audit it returns, never its texts.

Null ids are one conversation of their own. Null roles and texts are one space, in the key of the damage also null ids and
turns. Repeated rows are rows of their own, the later ones duplicates. An empty table gives no rows. Other columns are not
looked at. Gaps beyond 64 bits count as the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clickloom.llm.common import SLICE_ROWS, batch_of, map_rows, stored

WHITE_SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States of the roles so far: nothing, a system row, a user row last, an assistant row last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row of user or assistant, whichever can follow.
FOLLOWING = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The initials that can follow a state, and the state then.
KEPT_STATE = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT
}
LEGAL_PAIRS = ("su", "ua", "au")
#: Symbols of a row: its initial, twice; the second four are truncated; the last has to go.
INITIALS = "sua"
OTHER, GONE = len(INITIALS), 2 * (len(INITIALS) + 1)
SYMBOLS = GONE + 1
BLOCK_ROWS = 4
#: What the rest costs behind the last row.
END = (0, 2 * INSERT, INSERT, 0)
LARGEST = (1 << 63) - 1

Vector = tuple[int, ...]


def symbol_of(role: str, gone: bool, truncated: bool) -> int:
    if gone:
        return GONE
    initial = INITIALS.find(role[:1]) if role else -1
    return (initial if initial >= 0 else OTHER) + (OTHER + 1) * truncated


def edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """The edits of a row in a state: initial, cost, state then; least initial first."""
    found = [("D", DELETE, state)]
    if symbol != GONE:
        initial, more = (INITIALS + "?")[symbol % (OTHER + 1)], TRUNCATED * (symbol > OTHER)
        if (state, initial) in KEPT_STATE:
            found.append(("K", more, KEPT_STATE[state, initial]))
        found.append(("R", REROLE + more, FOLLOWING[state]))
    return found


def before(vector: Vector, symbol: int) -> tuple[Vector, int]:
    """The cost vector before a row, less its smallest, and that smallest."""
    plain = [min(cost + vector[then] for _, cost, then in edits(symbol, state)) for state in range(4)]
    costs = []
    for state in range(4):
        once = FOLLOWING[state]
        costs.append(min(plain[state], INSERT + plain[once], 2 * INSERT + plain[FOLLOWING[once]]))
    least = min(costs)
    return tuple(cost - least for cost in costs), least


class Tables:
    """All cost vectors there are, and the vector before each symbol and each block, with what it adds."""

    def __init__(self, block_rows: int = BLOCK_ROWS):
        self.block_rows = block_rows
        self.vectors: list[Vector] = [END]
        number = {END: 0}
        steps, adds = [], []
        for vector in self.vectors:  # grows as vectors are found
            row = []
            for symbol in range(SYMBOLS):
                then, least = before(vector, symbol)
                if then not in number:
                    number[then] = len(self.vectors)
                    self.vectors.append(then)
                row.append((number[then], least))
            steps.append([n for n, _ in row])
            adds.append([least for _, least in row])
        self.step, self.add = np.array(steps, np.int16), np.array(adds, np.int32)
        # A block is a number whose digits are its symbols, the first one leading; the last row is worked off first.
        size = SYMBOLS**block_rows
        self.block_step = np.repeat(np.arange(len(self.vectors), dtype=np.int16)[:, None], size, axis=1)
        self.block_add = np.zeros((len(self.vectors), size), np.int32)
        for place in range(block_rows):
            symbol = np.arange(size) // SYMBOLS**place % SYMBOLS
            self.block_add += self.add[self.block_step, symbol]
            self.block_step = self.step[self.block_step, symbol]
        self.traced = lru_cache(maxsize=1 << 16)(self.trace_block)

    def blocks(self, symbols: bytes) -> tuple[np.ndarray, int]:
        """The symbols as block numbers, and how many symbols are left at the end."""
        left = len(symbols) % self.block_rows
        whole = np.frombuffer(symbols, np.uint8)[: len(symbols) - left].reshape(-1, self.block_rows).astype(np.int32)
        return whole @ (SYMBOLS ** np.arange(self.block_rows - 1, -1, -1, dtype=np.int32)), left

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """The least cost of a conversation, and the initials of its edits."""
        blocks, left = self.blocks(symbols)
        tail = symbols[len(symbols) - left :]
        at, cost = 0, 0
        for symbol in reversed(tail):
            cost += int(self.add[at, symbol])
            at = int(self.step[at, symbol])
        behind = np.zeros(len(blocks), np.int16)  # the vector behind each block
        for n in range(len(blocks) - 1, -1, -1):
            behind[n] = at
            cost += int(self.block_add[at, blocks[n]])
            at = int(self.block_step[at, blocks[n]])
        cost += self.vectors[at][NOTHING]
        audit, state = [], NOTHING
        for n, block in enumerate(blocks.tolist()):
            letters, state = self.traced(int(behind[n]), state, block)
            audit.append(letters)
        letters, state = self.trace(tail, 0, state)
        audit.append(letters)
        # Behind the last row only inserted ones are left.
        while END[state]:
            audit.append("I")
            state = FOLLOWING[state]
        return cost, "".join(audit)

    def trace_block(self, behind: int, state: int, block: int) -> tuple[str, int]:
        digits = [block // SYMBOLS**place % SYMBOLS for place in range(self.block_rows - 1, -1, -1)]
        return self.trace(bytes(digits), behind, state)

    def trace(self, symbols: bytes, behind: int, state: int) -> tuple[str, int]:
        """The edits of some rows from a state on, given the vector behind them, and the state then."""
        at = [behind]
        for symbol in reversed(symbols):
            at.append(int(self.step[at[-1], symbol]))
        at.reverse()
        audit = []
        for place, symbol in enumerate(symbols):
            now, after = self.vectors[at[place]], self.vectors[at[place + 1]]
            added = int(self.add[at[place + 1], symbol])
            done = False
            while not done:
                cheapest = {e: then for e, cost, then in edits(symbol, state) if now[state] + added == cost + after[then]}
                inserted = FOLLOWING[state]
                if "D" not in cheapest and now[state] == INSERT + now[inserted]:
                    audit.append("I")
                    state = inserted
                else:
                    edit = min(cheapest)
                    audit.append(edit)
                    state, done = cheapest[edit], True
        return "".join(audit), state


@lru_cache(maxsize=1)
def tables() -> Tables:
    """The worker's tables."""
    return Tables()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults, by a checksum of conversation and turn; dropped rows stay, marked ``dropped``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        space("role").alias("role"),
        space("text").alias("text"),
        code.alias("code"),
    )
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("code") == 0).alias("dropped"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


#: What a pass over the rows without their texts tells of each conversation.
PLAN = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
    " audit string"
)
RESULT = f"{PLAN}, repaired_sha256 string"
TYPES = [*[pa.int64()] * 7, pa.string(), pa.string()]


def names_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


class Conversation:
    """What is known of a conversation whose rows come one by one."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.symbols = bytearray()
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None

    def add(self, turn: int | None, role: str, blank: bool, again: bool, cut: bool) -> None:
        if turn is not None:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        again, cut = again and not blank, cut and not blank and not again
        self.blank += blank
        self.duplicate += again
        self.truncated += cut
        self.illegal += self.initial is not None and self.initial + role[:1] not in LEGAL_PAIRS
        self.initial = role[:1]
        self.symbols.append(symbol_of(role, blank or again, cut))

    def plan(self) -> tuple:
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, LARGEST)
        cost, audit = tables().repair(bytes(self.symbols))
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield from zip(*(part.column(i).to_pylist() for i in range(part.num_columns)))


def in_batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows a few at a time; earlier if their audits are long."""
    names = names_of(schema)
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[7])
        if len(held) == SLICE_ROWS or size >= 1 << 20:
            yield batch_of(list(zip(*held)), TYPES[: len(names)], names)
            held, size = [], 0
    if held:
        yield batch_of(list(zip(*held)), TYPES[: len(names)], names)


def plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A plan for each conversation; rows come by conversation and in order."""

    def each() -> Iterator[tuple]:
        now = None
        for conv_id, turn, role, blank, again, cut, dropped in rows_of(batches):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now.plan()
                now = Conversation(conv_id)
            if not dropped:
                now.add(turn, role, blank, again, cut)
        if now is not None:
            yield now.plan()

    return in_batches(each(), PLAN)


class Repaired:
    """The digest of a repaired conversation whose rows come one by one, as its audit tells."""

    def __init__(self, plan: tuple):
        self.plan, self.audit = plan, plan[-1]
        self.at, self.state, self.some = 0, NOTHING, False
        self.digest = hashlib.sha256()

    def line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.some else ''}{role}:".encode())
        self.digest.update(text.encode())
        self.some = True

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = FOLLOWING[self.state]
            self.line(NAMES[self.state], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT_STATE[self.state, role[:1]]
            self.line(role, text)
        elif edit == "R":
            self.state = FOLLOWING[self.state]
            self.line(NAMES[self.state], text)

    def result(self) -> tuple:
        self.inserted()
        return (*self.plan, self.digest.hexdigest())


def repaired(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The results; each conversation's plan comes before its rows."""

    def each() -> Iterator[tuple]:
        now = None
        for row in rows_of(batches):
            if row[width]:  # a plan
                if now is not None:
                    yield now.result()
                now = Repaired(row[:width])
            else:
                now.add(row[width + 1], row[width + 2])
        if now is not None:
            yield now.result()

    return in_batches(each(), RESULT)


def in_order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text_key")]


def repair(rows: DataFrame) -> DataFrame:
    """A row per conversation: its faults, the cheapest edits, and a digest of what they make of it.

    Takes ``conv_id, turn, role, text, dropped``; of conversations whose rows are all dropped there is a result too.
    """
    spark = rows.sparkSession
    stripped = F.rtrim(F.col("text"), F.lit(WHITE_SPACE))
    keyed = rows.withColumn("text_key", F.unhex(F.sha2("text", 256)))
    bare = keyed.select(
        "conv_id",
        "turn",
        "role",
        "text_key",
        "dropped",
        (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(*STOPS)).alias("cut"),
    ).repartition("conv_id")
    seen = Window.partitionBy("conv_id", "role", "text_key", "dropped").orderBy(F.asc_nulls_first("turn"))
    marked = bare.withColumn("again", F.row_number().over(seen) > 1)
    marked = marked.sortWithinPartitions("conv_id", *in_order())
    columns = ["conv_id", "turn", "role", "blank", "again", "cut", "dropped"]
    planned = stored(spark, "repair-plans", map_rows(marked.select(*columns), plans, PLAN))

    names = names_of(PLAN)
    nothing = {"turn": "bigint", "role": "string", "text": "string", "text_key": "binary"}
    heads = planned.select(*names, F.lit(True).alias("plan"), *[F.lit(None).cast(k).alias(n) for n, k in nothing.items()])
    empty = [F.lit(None).cast(planned.schema[name].dataType).alias(name) for name in names[1:]]
    texts = keyed.where("not dropped").select("conv_id", *empty, F.lit(False).alias("plan"), *nothing)
    both = heads.unionByName(texts).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", F.desc("plan"), *in_order()).select(*names, "plan", "role", "text")
    return map_rows(both, partial(repaired, width=len(names)), RESULT)
