from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airshed.llm import packing as K
from airshed.llm.subword import default_path, subwords

from .conftest import texts


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab '.é中\n\t \x1c7<|endoftext|>"), max_size=30), max_size=5))
def test_ids_are_the_tokenizers_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    t.encode_special_tokens = True
    got = [np.frombuffer(b, "<u4").tolist() for b in subwords(default_path()).encode(texts)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_every_code_point_and_long_runs_give_the_tokenizers_ids(tokenizer):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{chr(c)}1{chr(c)}." for c in points[i:i + 32]) for i in range(0, len(points), 32)]
    texts += ["x" + " " * 300_000 + "y", " " * 300_000, "a" * 300_000, "\n" * 2000 + "z" + "\t" * 1999, "#" * 200_000]
    got = subwords(default_path()).encode(texts)
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert got == want


def test_other_vocabulary_falls_back():
    import os

    path = os.path.join(os.path.dirname(default_path()), "word_bpe_49k.json")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    assert np.frombuffer(subwords(path).encode(["Two small Words"])[0], "<u4").tolist() == t.encode("Two small Words", add_special_tokens=False).ids


def check(rows, docs, tokenizer, window=K.WINDOW):
    want = sorted((str(r.doc_id), [*ids_of(tokenizer, r.text), 0]) for r in docs)
    sequences, pieces = {}, {}
    for r in rows:
        pieces.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    whole = sorted((d, n) for d, ids in want for n in [len(ids)])
    assert sorted(k for k, v in pieces.items() for _ in range(sum(s == 0 for s, _, _ in v))) == whole
    for d, ids in want:
        for start in range(0, len(ids), window):
            part = np.array(ids[start:start + window], "<u4")
            assert (start, len(part), zlib.crc32(part.tobytes())) in pieces[d, len(ids)]
    return sequences


def test_pieces_against_brute_force(odd_docs, tokenizer):
    docs = odd_docs.repartition(5)
    rows = K.pack(docs).collect()
    sequences = check(rows, odd_docs.collect(), tokenizer)
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // K.WINDOW) * 1.15 + 1  # leftovers of all partitions are merged
    assert len(rows) >= len(texts())


def test_ids_round_trip(odd_docs, tokenizer):
    rows = K.pack(odd_docs.where("doc_id = 6"), with_ids=True).collect()
    ids = np.frombuffer(b"".join(r.ids for r in sorted(rows, key=lambda r: r.start)), "<u4").tolist()
    assert ids == [*ids_of(tokenizer, texts()[6]), 0]


def test_best_fit_keeps_few_windows_open():
    packer = K.OpenWindows(10, 2)
    assert packer.place(6) == (0, 0, None) and packer.place(7) == (1, 0, None)
    assert packer.place(3) == (1, 7, None)  # best fit, and full now
    assert packer.place(8) == (2, 0, None)
    assert packer.place(9) == (3, 0, 2)  # none fits: the fullest is emitted
    assert set(packer.used) == {0, 3}


def test_empty_table(no_docs):
    assert K.pack(no_docs).count() == 0
