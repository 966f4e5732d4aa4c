"""Tokens, token files and packing: exact round trips and bounds."""

from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from limnos.llm import packing, token_files, tokens
from limnos.llm.queries import TOKENIZER
from limnos.llm.shared import map_slices
from limnos.llm.tokens import encoder
from limnos.session import new_path


LIBRARY = Tokenizer.from_file(TOKENIZER)


def whole(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t\r\x1c\x1f\x85\xa0\u1680\u3000\u200b'sdrelm aA1²٣é中😀,.!<|endoftext|>")))
def test_pieces_give_the_ids_of_the_whole(text):
    assert ids_of(encoder(TOKENIZER).encode([text], 7)[0]) == [*whole(text), 7]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", "the", "don't", "<|endoftext", "x\n", "\ny", "é.", "a,b", " ?!", "it's,"])).map("".join))
def test_special_strings_are_the_librarys(text):
    assert ids_of(encoder(TOKENIZER).encode([text], 7)[0]) == [*whole(text), 7]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "GENERATION", 3)
    small = tokens.Encoder(TOKENIZER)
    for text in ["unheardof wordings here", "and more of unheardof wordings", "a b c d e f g", "unheardof b, c"] * 3:
        assert ids_of(small.encode([text], 0)[0])[:-1] == whole(text)
        assert len(small.after_blank) <= 3 + 2 * len(text.split())


def test_workers_give_up_pieces_when_another_operator_begins(spark):
    """Spark uses a worker process for all stages; what one has remembered must not weigh on the next."""
    one = spark.range(1).coalesce(1)

    def encode(batches):
        for batch in batches:
            encoder(TOKENIZER).encode(["some words"], 0)
            yield pa.RecordBatch.from_arrays([pa.array([len(tokens._ENCODERS)] * batch.num_rows, pa.int64())], ["n"])

    def left(batch):
        return pa.RecordBatch.from_arrays([pa.array([len(tokens._ENCODERS)] * batch.num_rows, pa.int64())], ["n"])

    assert one.mapInArrow(encode, "n bigint").first()["n"] == 1
    assert map_slices(one, left, "n bigint").first()["n"] == 0


def test_whole_documents(documents):
    for r in documents.collect():
        assert ids_of(encoder(TOKENIZER).encode([r.text], 0)[0])[:-1] == whole(r.text)


@pytest.mark.parametrize("which", ["documents", "edges", "nothing"])
def test_token_files_round_trip(request, which):
    docs = request.getfixturevalue(which)
    rows = token_files.digest(token_files.round_trip(docs, TOKENIZER)).collect()
    rows.sort(key=lambda r: r.start)
    key = lambda x: (x is not None, x or 0)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in docs.collect()), key=key)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    want = sorted((key(r.doc_id), crc32(np.array([*whole(r.text), 0], "<u4").tobytes())) for r in docs.collect())
    assert sorted((key(r.doc_id), r.ids_crc32) for r in rows) == want


def test_files_hold_indexes_and_bloom_filters(spark, documents):
    path = new_path(spark, "tokens")
    token_files.write_tokens(documents, path, TOKENIZER)
    files = [f for f in spark.read.orc(path).inputFiles()]
    assert files and all(b"orc" in open(f.removeprefix("file:"), "rb").read()[-60:].lower() for f in files)
    one = token_files.read_tokens(spark, path).where("doc_id = 17")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)]" in one._jdf.queryExecution().toString() or "EqualTo(doc_id,17)" in one._jdf.queryExecution().toString()
    assert one.count() == 1


def check_packing(rows, texts, capacity):
    """Every document whole, in order, in pieces; every sequence gapless and within its capacity."""
    for r in rows:
        assert 1 <= r.length <= capacity
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for doc_id, text in texts:
        ids = [*whole(text), 2]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(doc_id is not None, doc_id or 0, k, a, b - a, crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    return len(by_sequence)


@pytest.mark.parametrize("which", ["documents", "edges", "nothing"])
def test_packing_holds_all_documents(request, which):
    docs = request.getfixturevalue(which)
    rows = packing.pack(docs, TOKENIZER).collect()
    used = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 1024)
    assert used <= -(-sum(r.length for r in rows) // 1024) * 1.02 + 1


def test_sequences_hold_the_ids(edges):
    pieces = packing.cut_pieces(edges, TOKENIZER)
    places = packing.placed(pieces)
    made = {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces, places).collect()}
    for r in places.collect():
        assert crc32(made[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]) == r.ids_crc32


def optimal(lengths, capacity):
    """Least number of bins, by search."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def search(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for room in {b for b in bins if b >= lengths[i]}:
            rest = list(bins)
            rest.remove(room)
            search(i + 1, [*rest, room - lengths[i]])
        search(i + 1, [*bins, capacity - lengths[i]])

    search(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_keeps_the_optimum(lengths):
    counts = np.bincount(lengths, minlength=21)
    rest = counts.copy()
    fixed = packing._reduce(rest, 20)
    assert (rest >= 0).all()
    assert sum(f.times for f in fixed) + optimal([n for n in range(21) for _ in range(rest[n])], 20) == optimal(lengths, 20)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=400))
def test_fillings_hold_exactly_the_pieces(lengths):
    counts = np.bincount(lengths, minlength=51) if lengths else np.zeros(51, np.int64)
    packed, held = packing.fillings(counts, 50), np.zeros(51, np.int64)
    for f in packed:
        assert sum(f.lengths) <= 50 and f.times > 0
        np.add.at(held, list(f.lengths), f.times)
    assert (held == counts).all()
    assert sum(f.times for f in packed) <= -(-11 * sum(lengths) // (9 * 50)) + len(lengths) / 3 + 1
