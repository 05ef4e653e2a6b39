from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickloom.llm import chunk_reuse, packing, token_output, tokens
from tests.llm import cases

BYTES, WORDS = Tokenizer.from_file(cases.BYTE_FILE), Tokenizer.from_file(cases.WORD_FILE)
PARTS = [*"aB 's\n\t.,1é½İıſ中。жع؟한\x85\xa0\u2028Σ<|", "<|endoftext|>", "'ll", "  ", "\u200d", "😀"]
AWKWARD = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


def ids_of(library: Tokenizer, text: str | None) -> list[int]:
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [cases.WORD_FILE, cases.BYTE_FILE])
@settings(max_examples=300, deadline=None)
@given(text=st.one_of(AWKWARD, st.text(max_size=30)))
def test_encoder_equals_the_library(path, text):
    library = BYTES if path == cases.BYTE_FILE else WORDS
    ids = tokens.encoder(path).encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(library, text)
    if library is BYTES:
        assert tokens.decode(ids, path) == library.decode(ids_of(library, text), skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(text=AWKWARD)
def test_text_can_be_cut_at_sync_points(text):
    encode = tokens.encoder(cases.BYTE_FILE).encode
    for found in chunk_reuse.SYNC.finditer(text):
        assert encode(text[: found.start()]) + encode(text[found.start() :]) == encode(text)


@given(part=AWKWARD)
def test_synced_gives_first_and_last(part):
    places = [m.start() for m in chunk_reuse.SYNC.finditer(part)]
    assert chunk_reuse.synced(part) == ((places[0], places[-1]) if len(places) > 1 else None)


def test_cuts_depend_on_content_only():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 40_000, np.uint8).tobytes()
    plain = chunk_reuse.chunks(body.decode())
    shifted = chunk_reuse.chunks("é" * 501 + body.decode())
    assert b"".join(plain) == body and len(plain) > 20
    assert plain[1:] == shifted[-len(plain) + 1 :]


def test_encode_documents_equals_the_library(spark):
    rows = cases.odd_rows(spark, cases.awkward_texts())
    want = Counter()
    for row in rows.collect():
        ids = ids_of(BYTES, row.text)
        text = BYTES.decode(ids, skip_special_tokens=False)
        packed = np.asarray(ids, "<u4").tobytes()
        want[(row.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    got = chunk_reuse.encode_documents(rows, cases.BYTE_FILE)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(tuple(row) for row in got.collect()) == want


SCRIPTS = {
    "latin": ("abcdefghijklmnopqrstuvwxyz", " ", ". "),
    "cyrillic": ("абвгдежзийклмнопрстуфхцчшщъыьэюя", " ", ". "),
    "chinese": ("的一是不了人我在有他这中大来上国", "", "。"),  # sentences end, words do not
}


def written(rng: random.Random, script: str, words: int) -> str:
    letters, space, stop = SCRIPTS[script]
    found = ["".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(words)]
    return "".join(word + (stop if n % 6 == 5 else space) for n, word in enumerate(found))


@pytest.mark.parametrize("script", SCRIPTS)
def test_shared_passages_are_encoded_once(spark, script):
    rng = random.Random(3)
    passage = written(rng, script, 900)
    texts = [written(rng, script, rng.randrange(5, 60)) + passage + written(rng, script, 40) for _ in range(8)]
    rows = cases.documents(spark, [*texts, texts[0]])
    encode, bytes_encoded = tokens.encoder(cases.BYTE_FILE).encode, Counter()
    uses = {bytes(row.text_key): row for row in chunk_reuse.chunk_uses(rows.select("text")).collect()}
    owners = Counter()
    for text in texts:
        key = chunk_reuse.digest(text.encode())

        def counted(part: str) -> bytes:
            bytes_encoded[key] += len(part.encode())
            return encode(part)

        parts, chunks = chunk_reuse.parts_of(text, set(uses[key].owned), set(uses[key].others), counted)
        owners.update(list(chunks))
        assert len(parts) > 1 or not uses[key].others
    assert owners and set(owners.values()) == {1}
    # All texts but the owner of the passage encode little but what they have alone and the joins.
    joins = 0.3 if SCRIPTS[script][1] else 0.7
    alone = {chunk_reuse.digest(t.encode()): len(t.encode()) - len(passage.encode()) for t in texts}
    spared = [key for key in alone if bytes_encoded[key] - alone[key] < joins * len(passage.encode())]
    assert len(spared) == 7
    got = chunk_reuse.encode_documents(rows, cases.BYTE_FILE).collect()
    want = {(n, hashlib.sha256(np.asarray(ids_of(BYTES, t), "<u4").tobytes()).hexdigest()) for n, t in enumerate([*texts, texts[0]])}
    assert {(row.doc_id, row.ids_sha256) for row in got} == want


def test_passages_that_come_again_in_one_text_are_encoded_once():
    rng = random.Random(4)
    passage = written(rng, "latin", 900)
    text = "\n".join([passage, written(rng, "latin", 30), passage, passage])
    sizes: list[int] = []

    def counted(part: str) -> bytes:
        sizes.append(len(part))
        return tokens.encoder(cases.BYTE_FILE).encode(part)

    parts, owned = chunk_reuse.parts_of(text, set(), set(), counted)
    assert len(parts) == 1 and not owned and sum(sizes) < 1.7 * len(passage)
    assert np.frombuffer(parts[0][0], "<u4").tolist() == ids_of(BYTES, text)


def test_encode_documents_of_nothing(spark):
    assert chunk_reuse.encode_documents(cases.documents(spark, ["a"]).limit(0), cases.BYTE_FILE).count() == 0


def check_packing(placed, rows, capacity):
    """Every piece is there once, and sequences have no gap, no overlap and no more than they hold."""
    want = Counter()
    for row in rows:
        ids = [*ids_of(WORDS, row.text), packing.END_ID]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want[(row.doc_id, piece, start, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed) == want
    sequences = defaultdict(list)
    for r in placed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for r in placed)


def test_packing(spark):
    rows = cases.odd_rows(spark, cases.awkward_texts())
    for block in (8192, 16):
        placed = packing.pack(packing.pieces(rows, cases.WORD_FILE, capacity=700), 700, block).collect()
        n, total = check_packing(placed, rows.collect(), 700)
        assert n <= -(-total // 700) + 1
    assert packing.pack(packing.pieces(rows.limit(0), cases.WORD_FILE)).count() == 0


def test_exchanges_empty_a_sequence():
    # Best fit gives [6 3] [5 4] ... and one too many; a swap mends it.
    lengths = np.asarray([6, 5, 4, 3, 3, 3])
    packed = packing.Sequences(lengths, 12)
    packed.best_fit()
    assert len(packed.members) == 3
    packed.search()
    filled = [m for m in packed.members if m]
    assert len(filled) == 2 and sorted(sum(filled, [])) == list(range(6))
    assert all(lengths[m].sum() == 12 for m in filled)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=40))
def test_search_keeps_pieces_and_never_needs_more(lengths):
    packed = packing.Sequences(np.asarray(lengths), 40)
    packed.best_fit()
    before = len(packed.members)
    packed.search()
    filled = [m for m in packed.members if m]
    assert sorted(sum(filled, [])) == list(range(len(lengths))) and len(filled) <= before
    assert all(sum(lengths[i] for i in m) <= 40 for m in filled)


def coarse_pieces(spark, n):
    """Pieces of 900 to 1900 tokens: three or so to a sequence, so best fit alone does badly."""
    lengths = np.random.default_rng(1).integers(900, 1901, n).tolist()
    rows = [(i, 0, 0, length, 0) for i, length in enumerate(lengths)]
    return lengths, spark.createDataFrame(rows, packing.PIECES)


def test_block_size_hardly_matters(spark):
    lengths, pieces = coarse_pieces(spark, 4000)
    bound = -(-sum(lengths) // 4096)
    best_fit = packing.Sequences(np.asarray(lengths), 4096)
    best_fit.best_fit()
    for block in (8192, 1000, 300):
        placed = packing.pack(pieces, block_pieces=block).collect()
        fills = Counter()
        for row in placed:
            fills[row.sequence_id] += row.length
        assert sorted(row.doc_id for row in placed) == list(range(4000)) and max(fills.values()) <= 4096
        assert len(fills) <= 1.035 * bound < 0.95 * best_fit.count()


def test_crowded_sequences_exchange_two_for_one():
    # 60 pieces of one token each crowd two sequences; only two of them for one of length 2 fill both.
    lengths = np.asarray([2] + [1] * 60 + [38])
    packed = packing.Sequences(lengths, 101)
    packed.members, packed.fill = [[0, *range(1, 60)], [60, 61]], [61, 39]
    gives = set(zip(*(column.tolist() for column in packed.units([0])[:2])))
    assert gives == {(2, 0), (1, 0), (3, 0)} | {(2, 0)}
    packed.search()
    assert packed.count() == packed.needed() == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_decreasing_by_segment_tree(lengths):
    want: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = [(50 - sum(lengths[i] for i in b), n) for n, b in enumerate(want)]
        fits = [r for r in room if r[0] >= lengths[item]]
        if fits:
            want[min(fits)[1]].append(item)
        else:
            want.append([item])
    got = token_output.best_fit_decreasing(lengths, 50)
    assert sorted(sum(lengths[i] for i in b) for b in got) == sorted(sum(lengths[i] for i in b) for b in want)
    assert sorted(sum(got, [])) == list(range(len(lengths)))


def test_packed_rows_and_back(spark):
    rows = cases.odd_rows(spark, cases.awkward_texts()).where("doc_id is not null").dropDuplicates(["doc_id"])
    packed = token_output.packed_rows(rows, cases.BYTE_FILE, width=512, gathered_tokens=8000).cache()
    for row in packed.collect():
        assert len(row.ids) == 2 * 512 and row.cu_seqlens[0] == 0 and row.cu_seqlens[-1] == row.n_tokens <= 512
        assert row.position_resets == row.cu_seqlens[:-1] and len(row.doc_ids) == row.n_segments
        assert set(np.frombuffer(row.ids, "<u2")[row.n_tokens :].tolist()) <= {token_output.PAD_ID}
    found = defaultdict(list)
    for row in token_output.unpack(packed).collect():
        found[row.doc_id].append((row.piece, row.start, np.frombuffer(row.ids, "<u2").tolist()))
    for row in rows.collect():
        pieces = sorted(found.pop(row.doc_id))
        assert [p[0] for p in pieces] == list(range(len(pieces)))
        assert [p[1] for p in pieces] == [512 * n for n in range(len(pieces))]
        assert sum((p[2] for p in pieces), []) == [*ids_of(BYTES, row.text), token_output.END_ID]
    assert not found
    assert packed.select("row_id").distinct().count() == packed.count()
    assert token_output.packed_rows(rows.limit(0), cases.BYTE_FILE).count() == 0


def test_ids_that_do_not_fit_fail():
    segments = [(1, 0, 0, np.asarray([5, 70_000], "<u4").tobytes())]
    with pytest.raises(ValueError, match="70000"):
        list(token_output.rows_of(segments, 0, 4, "<u2", 0))
    (batch,) = token_output.rows_of(segments, 0, 4, "<u4", 0)
    assert np.frombuffer(batch["ids"][0].as_py(), "<u4").tolist() == [5, 70_000, 0, 0]
