"""Packing (operator 11): the library's ids, whole coverage, least squares."""

import itertools
import random
import zlib

import numpy as np
import pytest

from lampwatch.llm import packing as K
from lampwatch.llm.common import vocabulary
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_words_encode_as_the_library(library):
    rnd = random.Random(5)
    signs = ["a", "É", "ß", "İ", "ǅ", "'s", "'", "n't", ".", ",", "…", "1", "中", " ", "  ", "\n", "\t", "\x0b",
             " ", "é", "̇", "<|endoftext|>", "-", "\U0001f600", "^", "`", "\x00", "Σ", "\x1c"]
    encoder = K.WordEncoder(vocabulary("word_bpe_49k.json"))
    for _ in range(3000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == library(text), repr(text)


def test_long_text_is_cut_between_words(library, monkeypatch):
    monkeypatch.setattr(K, "RUN_CHARS", 50)
    monkeypatch.setattr(K, "CACHE_WORDS", 20)
    encoder = K.WordEncoder(vocabulary("word_bpe_49k.json"))
    text = " ".join(f"Word{i}, it's x{i % 7}." for i in range(500)) + "y" * 300
    assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == library(text)


def test_combinations_are_all_pairs_and_triples():
    lengths = np.array([1, 2, 5, 6, 7, 8, 11])
    want = {tuple(sorted(c)) for k in (2, 3) for c in itertools.combinations_with_replacement(lengths.tolist(), k)
            if sum(c) == 13}
    got = [tuple(p for p in row if p) for row in K.combinations(lengths, 13).tolist()]
    assert len(got) == len(set(got)) and set(got) == want


def test_repeat_counts_solve_the_least_squares():
    """The conditions that mark the minimum: no gradient where x > 0, none
    negative where x = 0."""
    rnd = np.random.default_rng(3)
    hist = np.zeros(65)
    hist[1:64] = rnd.integers(0, 200, 63)
    parts = K.combinations(np.flatnonzero(hist), 64)
    x = K.repeat_counts(parts, hist, steps=20_000)
    a = np.zeros((65, len(parts)))
    for j, row in enumerate(parts):
        np.add.at(a[:, j], row[row > 0], 1)
    gradient = a.T @ (a @ x - hist)
    assert (x >= 0).all() and gradient.min() > -0.05
    assert np.abs(gradient[x > 1e-3]).max() < 0.05
    few = K.repeat_counts(parts, hist)
    assert np.linalg.norm(a @ few - hist) < np.linalg.norm(a @ x - hist) * 1.05 + 0.05 * hist.sum() ** 0.5


@pytest.mark.parametrize("tokens", [[], [1], [2048], [4096, 1], [2047] * 7, [1] * 5000, [700, 700, 648],
                                    [random.Random(1).randint(1, 5000) for _ in range(2000)]])
def test_every_id_once_without_padding(tokens):
    seen = [np.zeros(n, int) for n in tokens]
    rows = K.packed_documents(tokens)
    for row in rows:
        total = sum(n for _, _, n in row)
        assert total == K.WINDOW or total & (total - 1) == 0
        for d, start, n in row:
            assert n > 0
            seen[d][start:start + n] += 1
    assert all((s == 1).all() for s in seen)
    assert sum(sum(n for _, _, n in r) < K.WINDOW for r in rows) <= 11


def test_combinations_beat_plain_cutting():
    """Planned combinations leave most documents whole."""
    rnd = random.Random(2)
    rest = [rnd.randint(1, 2047) for _ in range(20_000)]
    cuts = sum(map(len, K.packed_lengths(rest))) - len(rest)
    assert cuts < sum(rest) / K.WINDOW / 3  # cutting a stream of ids cuts once a window


def check(rows, docs, library, window=2048):
    want = sorted(((i, library(t) + [1]) for i, t in docs), key=str)
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for pieces in by_seq.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at <= window and (at == window or at & (at - 1) == 0)
    for i in by_doc:
        texts = [ids for k, ids in want if k == i]
        if len(texts) > 1:
            assert sum(r.length for r in by_doc[i]) == sum(map(len, texts))
            continue
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(texts[0])
            piece = np.array(texts[0][at:at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(piece.tobytes())
            at += r.length
        assert at == len(texts[0])
    assert set(by_doc) == {i for i, _ in docs}


def test_query_equals_brute_force(llm, library):
    from lampwatch.llm.queries import op11_packing

    docs = llm.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    check(op11_packing(llm, SF_SMALL).collect(), [tuple(r) for r in docs], library)


def test_odd_rows(odd_docs, no_docs, library):
    path = vocabulary("word_bpe_49k.json")
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    check(K.packed(odd_docs, path, 1).collect(), docs, library)
    assert K.packed(no_docs, path, 1).collect() == []


def test_windows_hold_the_ids(llm, odd_docs, library):
    path = vocabulary("word_bpe_49k.json")
    some = odd_docs.where("doc_id in (1, 8, 10)")
    rows = K.sequences(K.packed(some, path, 1, ids=True)).collect()
    texts = {r.doc_id: library(r.text) + [1] for r in some.select("doc_id", "text").collect()}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        held = sum(p.length for p in r.pieces)
        assert len(ids) == 2048 or (len(ids) == held and held & (held - 1) == 0)
        for p in r.pieces:
            assert ids[p.offset:p.offset + p.length].tolist() == texts[p.doc_id][p.start:p.start + p.length]
    assert sum(p.length for r in rows for p in r.pieces) == sum(map(len, texts.values()))
