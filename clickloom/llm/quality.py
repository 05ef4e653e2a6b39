"""Document quality by a linear-chain conditional random field over lines.

Every line gets a vector of measures (length, kinds of characters, repeated words and lines), next to which stand those
of the line before and after. The field labels lines good or bad; neighbouring labels hold together by learned weights.
Forward and backward passes give each line's probability of being good, and a document's score is their mean, weighted
by length. A long document is measured in pieces of whole lines, which hand on their edges and the hashes of their lines, so
memory goes by its longest line and a few numbers for each line. Lines are labelled through their documents: a line of a good document counts as good.

The field is fitted on a bounded sample of labelled documents of any length, the one with the smallest hashes, on the
driver; of a long document a run of lines is taken, measured in the whole document. Scoring reads every whole text once, a
batch of lines at a time, without a shuffle. Nothing but the text goes into a score.

Null texts are empty: one empty line. Repeated rows get the same score; of different texts with one id the fit takes the
one with the smallest hash. An empty table gives no rows. Documents with
contradicting labels are not learned from; without two classes to learn from, all scores are 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import SLICE_ROWS, batch_of, map_rows, stored, whole_text

#: Labelled documents of each class that the field is fitted on, and the most lines that are taken of one of them.
FIT_DOCUMENTS, FIT_LINES = 2000, 400
#: Lines of each class at which no more documents are taken.
FIT_TOTAL = 200_000
FIT_STEPS, RATE, DECAY = 400, 0.08, 1e-3
#: Bytes of text that are measured at a time, up to the end of a line.
MEASURED_BYTES = 1 << 18
GOOD_FROM = 0.3

#: Kinds of bytes: other, small letter, capital, digit, space, mark of a sentence, other mark; bytes of characters beyond
#: ASCII count as letters of their own kind.
SMALL, CAPITAL, DIGIT, SPACE, STOP, MARK, BEYOND = range(1, 8)


def byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    for byte in range(33, 127):
        char = chr(byte)
        kinds[byte] = SMALL if char.islower() else CAPITAL if char.isupper() else DIGIT if char.isdigit() else MARK
    kinds[list(b".,;:?'\"-()")] = STOP
    kinds[list(b" \t\r\x0b\x0c")] = SPACE
    kinds[128:] = BEYOND
    return kinds


KINDS = byte_kinds()
#: Weights of the places of a byte in a word, for word hashes.
PLACES = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
BYTES = np.cumsum(np.full(256, 0xC2B2AE3D27D4EB4F, np.uint64))
MEASURES = 16
#: The measure that looks at all earlier lines: whether one of them is the same.
REPEATED = 14


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the given places."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for the bytes between each two places."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    inside = np.repeat(starts, lengths)
    place = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weighted = BYTES[data[inside + place]] * PLACES[place % 64]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)])
    stops = np.cumsum(lengths)
    return total[stops] - total[stops - lengths] + lengths.astype(np.uint64)


def measures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lines of some documents: which document, length in bytes, and measures of each."""
    joined = b"\n".join(texts)
    data = np.frombuffer(joined + b"\n", np.uint8)
    breaks = np.flatnonzero(data == 10)
    starts, ends = np.concatenate([[0], breaks[:-1] + 1]), breaks
    document = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    kinds = KINDS[data]
    length = ends - starts
    share = {kind: sums(kinds == kind, starts, ends) / np.maximum(length, 1) for kind in range(1, 8)}
    # Words: runs between white space.
    blank = (kinds == SPACE) | (data == 10)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
    word_starts, word_ends = edge[::2], edge[1::2]
    line_of = np.searchsorted(breaks, word_starts)
    words = np.bincount(line_of, minlength=len(starts))
    some = np.maximum(words, 1)
    names = hashes(data, word_starts, word_ends)
    same_line = line_of[1:] == line_of[:-1] if len(line_of) else np.zeros(0, bool)
    again = np.zeros(len(names), bool)
    again[1:] = same_line & (names[1:] == names[:-1])
    order = np.lexsort((names, line_of))
    first = np.ones(len(names), bool)
    if len(names):
        first[1:] = (names[order][1:] != names[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][first], minlength=len(starts))
    capitals = np.concatenate([[0], np.cumsum(kinds == CAPITAL)])
    loud = (capitals[word_ends] - capitals[word_starts]) * 2 > word_ends - word_starts
    marked = np.isin(kinds[word_ends - 1], [MARK]) if len(names) else np.zeros(0, bool)
    lone = (word_ends - word_starts == 1) & (kinds[word_starts] == MARK) if len(names) else np.zeros(0, bool)
    # Lines that the document has already had.
    line_names = hashes(data, starts, ends)
    order = np.lexsort((np.arange(len(starts)), line_names, document))
    repeated = np.zeros(len(starts), bool)
    repeated[order[1:]] = (line_names[order][1:] == line_names[order][:-1]) & (document[order][1:] == document[order][:-1])
    per_word = [np.bincount(line_of[flag], minlength=len(starts)) / some for flag in (again, loud, marked, lone)]
    found = [
        np.log1p(length) / 8,
        np.log1p(words) / 6,
        np.minimum(sums(~blank, starts, ends) / some, 30) / 10,
        *[share[kind] for kind in (SMALL, CAPITAL, DIGIT, STOP, MARK, BEYOND)],
        *per_word,
        1 - distinct / some,
        repeated,
        length == 0,
    ]
    return document, length, np.stack(found, axis=1).astype(np.float64)


def line_pieces(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lengths and measures of a document's lines, a bounded number of bytes and one line at a time."""
    seen, start = np.zeros(0, np.uint64), 0
    while start <= len(data):
        end = data.find(b"\n", start + MEASURED_BYTES)
        end = len(data) if end < 0 else end
        _, length, values = measures([data[start:end]])
        if start or end < len(data):
            part = np.frombuffer(data[start:end] + b"\n", np.uint8)
            ends = np.flatnonzero(part == 10)
            names = hashes(part, np.r_[0, ends[:-1] + 1], ends)
            values[:, REPEATED] = np.maximum(values[:, REPEATED], np.isin(names, seen))
            seen = np.union1d(seen, names)
        yield length, values
        start = end + 1


def with_neighbours(document: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The measures of each line, of the line before and after (zeros at a document's ends), and a constant."""
    n = len(values)
    before, after = np.zeros_like(values), np.zeros_like(values)
    same = (document[1:] == document[:-1])[:, None]
    before[1:], after[:-1] = values[:-1] * same, values[1:] * same
    return np.concatenate([values, before, after, np.ones((n, 1))], axis=1)


WIDTH = 3 * MEASURES + 1


@dataclass
class Field:
    """The field's weights: of a line's measures for the label good, and of two labels in a row (bad 0, good 1)."""

    weights: np.ndarray
    chain: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    def evidence(self, values: np.ndarray) -> np.ndarray:
        return ((values - self.centre) / self.spread) @ self.weights


def by_place(document: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Each document's first line and number of lines, and the documents that have a line at each place."""
    first = np.flatnonzero(np.r_[True, document[1:] != document[:-1]]) if len(document) else np.zeros(0, np.int64)
    lines = np.diff(np.r_[first, len(document)])
    order = np.argsort(-lines, kind="stable")
    # Documents by number of lines: those with a line at a place are the first so many.
    many = np.searchsorted(-lines[order], -np.arange(1, lines.max(initial=0) + 1), side="right")
    return first, lines, [order[:n] for n in many]


def marginals(evidence: np.ndarray, document: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward over all documents side by side: each line's probability of good, and those of the four
    pairs of labels with the line before (zeros on a document's first line)."""
    n = len(evidence)
    first, _, places = by_place(document)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    # exp of evidence and chain weights, rescaled on each line so that nothing overflows.
    local = np.stack([np.zeros(n), np.clip(evidence, -40, 40)], axis=1)
    local = np.exp(local - local.max(axis=1, keepdims=True))
    step = np.exp(chain - chain.max())
    for place, docs in enumerate(places):
        at = first[docs] + place
        alpha = local[at] * (forward[at - 1] @ step if place else 1)
        forward[at] = alpha / alpha.sum(axis=1, keepdims=True)
    if n:
        last = np.r_[document[1:] != document[:-1], True]
        backward[last] = 0.5
    for place in range(len(places) - 1, 0, -1):
        at = first[places[place]] + place
        beta = (local[at] * backward[at]) @ step.T
        backward[at - 1] = beta / beta.sum(axis=1, keepdims=True)
    both = forward * backward
    good = both[:, 1] / both.sum(axis=1)
    pairs = np.zeros((n, 2, 2))
    later = np.flatnonzero(np.r_[False, document[1:] == document[:-1]]) if n else np.zeros(0, np.int64)
    joint = forward[later - 1][:, :, None] * step * (local[later] * backward[later])[:, None, :]
    pairs[later] = joint / joint.sum(axis=(1, 2), keepdims=True)
    return good, pairs


def fit(document: np.ndarray, values: np.ndarray, good: np.ndarray) -> Field:
    """Maximum likelihood of the lines' labels, each document counting alike, by gradient ascent with momentum."""
    values = with_neighbours(document, values)
    centre, spread = values.mean(axis=0), values.std(axis=0) + 1e-6
    centre[-1], spread[-1] = 0, 1
    scaled = (values - centre) / spread
    _, lines, _ = by_place(document)
    weight = np.repeat(1 / lines, lines) / len(lines)
    later = np.r_[False, document[1:] == document[:-1]]
    labels = good.astype(np.int64)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:-1][later[1:]], labels[1:][later[1:]]), weight[later])
    theta = np.zeros(WIDTH + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, FIT_STEPS + 1):
        chain = theta[WIDTH:].reshape(2, 2)
        probability, pairs = marginals(scaled @ theta[:WIDTH], document, chain)
        expected = (pairs * weight[:, None, None]).sum(axis=0)
        slope = np.r_[((labels - probability) * weight) @ scaled, (seen - expected).ravel()]
        slope -= DECAY * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        theta = theta + RATE * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    return Field(theta[:WIDTH], theta[WIDTH:].reshape(2, 2), centre, spread)


def good_lines(evidence: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """The probabilities of :func:`marginals` for one document of many lines, a number for each line at a time."""
    (s00, s01), (s10, s11) = np.exp(chain - chain.max()).tolist()
    odds = np.exp(np.clip(evidence, -40, 40))
    forward, backward = np.empty(len(odds)), np.empty(len(odds))
    good = None
    for at, odd in enumerate(odds):
        good, bad = (odd, 1.0) if good is None else (odd * (bad * s01 + good * s11), bad * s00 + good * s10)
        good = forward[at] = good / (good + bad)
        bad = 1 - good
    good = backward[-1] = 0.5
    for at in range(len(odds) - 1, 0, -1):
        good, bad = odds[at] * good, 1 - good
        good, bad = s10 * bad + s11 * good, s00 * bad + s01 * good
        good = backward[at - 1] = good / (good + bad)
    both = forward * backward
    return both / (both + (1 - forward) * (1 - backward))


def long_score(data: bytes, field: Field) -> float:
    """The score of one document, measured in pieces."""
    lengths, evidence = [], []
    edge = held = None
    for length, values in line_pieces(data):
        lengths.append(length)
        if held is not None:
            evidence.append(piece_evidence(edge, held, values[:1], field))
            edge = held[-1:]
        held = values
    evidence.append(piece_evidence(edge, held, None, field))
    good = good_lines(np.concatenate(evidence), field.chain)
    return float(np.clip(np.average(good, weights=np.concatenate(lengths) + 1.0), 0, 1))


def piece_evidence(before: np.ndarray | None, values: np.ndarray, after: np.ndarray | None, field: Field) -> np.ndarray:
    """The evidence of a piece's lines, given the line before and the line after it, if there are."""
    rows = np.concatenate([part for part in (before, values, after) if part is not None])
    first = 0 if before is None else 1
    around = with_neighbours(np.zeros(len(rows)), rows)[first : first + len(values)]
    return field.evidence(around)


def document_scores(texts: list[bytes], field: Field | None) -> np.ndarray:
    """Each document's probability of good lines, weighted by their lengths."""
    if field is None:
        return np.full(len(texts), 0.5)
    if len(texts) == 1 and len(texts[0]) > MEASURED_BYTES:
        return np.asarray([long_score(texts[0], field)])
    document, length, values = measures(texts)
    good, _ = marginals(field.evidence(with_neighbours(document, values)), document, field.chain)
    weight = length + 1.0
    totals = np.bincount(document, weight, len(texts))
    return np.clip(np.bincount(document, weight * good, len(texts)) / totals, 0, 1)


def groups(texts: list[str]) -> Iterator[list[bytes]]:
    """Documents, a bounded number of bytes at a time; one that is more stands alone."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = text.encode()
        if held and size + len(data) > MEASURED_BYTES:
            yield held
            held, size = [], 0
        held.append(data)
        size += len(data)
    if held:
        yield held


def score_task(field: Field | None):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                scores = [document_scores(group, field) for group in groups(part["text"].to_pylist())]
                columns = {name: part[name] for name in part.schema.names}
                columns["score"] = pa.array(np.concatenate(scores), pa.float64())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return task


def measure_lines(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The measured lines of documents, a row per document; of one with too many lines a run that its hash chooses."""
    for batch in batches:
        for text, label in zip(batch["text"].to_pylist(), batch["quality"].to_pylist(), strict=True):
            data = text.encode()
            start = zlib.crc32(data) % (max(data.count(b"\n") + 1 - most, 0) + 1)
            taken, at = [], 0
            for _, values in line_pieces(data):
                taken.append(values[max(start - at, 0) : max(start + most - at, 0)])
                at += len(values)
            values = np.concatenate(taken)
            yield batch_of([[label], [values.tobytes()]], [pa.int32(), pa.binary()], ["quality", "lines"])


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents that are never learned from: CRC-32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(
    documents: DataFrame, labels: DataFrame, fit_documents: int = FIT_DOCUMENTS, fit_lines: int = FIT_LINES
) -> Field | None:
    """Fit the field on at most ``fit_documents`` labelled documents of each class, none of them held out, and at most
    ``fit_lines`` lines in a row of each, until a class has ``FIT_TOTAL`` lines. The documents are those whose ids have the
    smallest hashes, whatever their length."""
    spark = documents.sparkSession
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").dropna()
    known = known.where(F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id")
    known = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    known = known.where("quality = other").select("doc_id", F.col("quality").cast("int").alias("quality"))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    # Only lengths are looked at before the choice, so that no text is shuffled but the chosen ones.
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    sized = rows.groupBy("doc_id").agg(F.max(F.least(n_lines, F.lit(fit_lines))).alias("n_lines"))
    candidates = stored(spark, "labelled", sized.join(known, "doc_id"))
    parts = [
        candidates.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_documents)
        for label in (0, 1)
    ]
    chosen = {}
    for part in parts:
        taken = 0
        for row in part.collect():
            if taken < FIT_TOTAL:
                chosen[row.doc_id] = row.quality
                taken += row.n_lines
    if len(set(chosen.values())) < 2:
        return None
    # A bounded list: at most fit_documents ids of each class.
    few = spark.createDataFrame(list(chosen.items()), "doc_id bigint, quality int")
    texts = rows.join(F.broadcast(few), "doc_id").groupBy("doc_id", "quality")
    texts = texts.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("text", "quality")
    found = map_rows(texts, partial(measure_lines, most=fit_lines), "quality int, lines binary").collect()
    found.sort(key=lambda row: (row.quality, bytes(row.lines)))  # whatever the order of the tasks
    values = [np.frombuffer(row.lines, np.float64).reshape(-1, MEASURES) for row in found]
    document = np.repeat(np.arange(len(found)), list(map(len, values)))
    return fit(document, np.concatenate(values), np.asarray([row.quality for row in found])[document])


def score(documents: DataFrame, field: Field | None) -> DataFrame:
    """The documents with a column ``score``: 0 to 1, higher if good is likelier. One of that name is replaced."""
    names = [name for name in documents.columns if name != "score"]
    rows = documents.select(*[whole_text().alias("text") if name == "text" else F.col(name) for name in names])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    return map_rows(rows, score_task(field), schema)
