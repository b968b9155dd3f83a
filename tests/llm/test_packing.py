"""Ids against the tokenizer library; plans and sequences by their properties."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from farelake.llm import packing
from farelake.llm.byte_bpe import ByteBpe
from farelake.llm.common import table
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import awkward, empty
from tokenizers import Tokenizer

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
#: Freshly opened, with nothing set.
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t\x1c　ab'st1é.日\U0001f600<|endoftext|>")))
def test_ids(bpe, text):
    assert np.frombuffer(bpe.encode(text), dtype="<u4").tolist() == bpe.slow_ids(text)


MARKED = st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "a", "it's", "é"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(MARKED.map("".join))
def test_ids_of_texts_with_added_tokens(bpe, text):
    assert np.frombuffer(bpe.encode(text), dtype="<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_added_token_is_one_id(bpe):
    assert np.frombuffer(bpe.encode("a <|endoftext|> b"), dtype="<u4").tolist() == [64, 220, 50256, 275]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan(lengths):
    histogram = np.bincount(np.array(lengths, dtype=np.int64), minlength=65)
    plan = packing.plan(histogram, 64)
    fill = np.zeros(plan.sequences, dtype=np.int64)
    seen = set()
    for length in range(1, 65):
        for number in range(histogram[length]):
            key = length * packing.SPAN + number
            slot = np.searchsorted(plan.keys, key, side="right") - 1
            sequence = plan.first_sequence[slot] + key - plan.keys[slot]
            place = set(range(plan.offset[slot], plan.offset[slot] + length))
            assert not {(sequence, p) for p in place} & seen
            seen |= {(sequence, p) for p in place}
            fill[sequence] += length
    assert (fill <= 64).all() and (fill > 0).all() and fill.sum() == sum(lengths)
    # Best-fit leaves at most one sequence half empty.
    assert (fill <= 32).sum() <= 1


def test_fits_nearly_full_sequences():
    rng = np.random.default_rng(0)
    histogram = np.bincount(np.minimum(rng.exponential(700, 50_000).astype(int) + 1, 2048), minlength=2049)
    plan = packing.plan(histogram, 2048)
    assert plan.sequences <= 1.005 * (histogram * np.arange(2049)).sum() / 2048


def check(pieces, docs, bpe, limit):
    tokens = {}
    for row in docs:
        ids = np.frombuffer(bpe.encode(row.text or ""), dtype="<u4").tolist() + [0]
        tokens.setdefault(row.doc_id, ids)
    by_sequence = {}
    for p in pieces:
        part = np.array(tokens[p.doc_id][p.start : p.start + p.length], dtype="<u4")
        assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
        assert list(p.ids) == part.tolist()
        assert p.length == limit or p.piece == 0
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for slots in by_sequence.values():
        ends = [0]
        for offset, length in sorted(slots):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= limit
    assert sum(p.length for p in pieces) == sum(len(tokens[row.doc_id]) for row in docs)


def test_documents(spark, bpe):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    check(packing.pack_documents(docs, PATH, limit=512).collect(), docs.collect(), bpe, 512)


def test_awkward_rows_and_empty(spark, bpe):
    docs = awkward(spark, "length piece number slot").where("doc_id IS NOT NULL")
    check(packing.pack_documents(docs, PATH, limit=256).collect(), docs.collect(), bpe, 256)
    assert packing.pack_documents(awkward(spark), PATH).where("doc_id IS NULL").count() == 2
    assert packing.pack_documents(empty(spark), PATH).count() == 0
