"""Operators on documents against brute force: odd rows, empty tables, and
the whole small fixture."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from lampwatch.llm import copies, mixing, pieces, quality, repeats, simhash, wavelet
from lampwatch.llm.common import connected
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD_TEXTS

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def small_docs():
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"]))


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- 1 ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_agenda_equals_library(library):
    model = pieces.PieceModel(PIECES)
    pick = random.Random(5)
    signs = list("abcde  \n\t▁éßñ中\U0001f600\x00<>s/'.,()01") + ["<s>", "<0x0A>", "  ", "the", "ing", "."]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 40))) for _ in range(4000)]
    got = model.encode(texts)
    assert [ids for ids, _ in got] == library.encode(texts)
    assert [model.decode(ids).decode() for ids, _ in got] == library.decode([ids for ids, _ in got])


def test_encoded_odd(odd_docs, no_docs, library):
    got = rows(pieces.encoded(odd_docs, PIECES))
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in ODD_TEXTS]
    assert Counter(map(repr, got)) == Counter(map(repr, want))
    sums = rows(pieces.encoded(odd_docs, PIECES, digests=True))
    want = [(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(t.encode()).hexdigest()) for i, ids, t in want]
    assert Counter(sums) == Counter(want)
    assert rows(pieces.encoded(no_docs, PIECES)) == []


def test_cache_generations():
    model = pieces.PieceModel(PIECES)
    before = pieces.CACHE_SEGMENTS
    pieces.CACHE_SEGMENTS = 3
    try:
        for text in ("one two three four five", "one six", "two one nine ten eleven", "one"):
            (ids, _), = model.encode([text])
            assert ids == model.library.encode(text)
        assert len(model.young) + len(model.old) < 12
    finally:
        pieces.CACHE_SEGMENTS = before


# ---- 3 ---------------------------------------------------------------------

def struck(docs):
    """Brute force: (id, words, removed, kept text) per row."""
    last = float("inf")
    split = [(last if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    least = {}
    for i, w in split:
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            least[key] = min(i, least.get(key, last))
    out = []
    for (i, w), (doc_id, _) in zip(split, docs):
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if least[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(),
                    " ".join(kept)))
    return out


def test_repeats_small(llm):
    docs = small_docs()
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert Counter(rows(repeats.without_repeats(df, texts=True))) == Counter(struck(docs))


def test_repeats_odd(odd_docs, no_docs):
    assert Counter(rows(repeats.without_repeats(odd_docs, texts=True))) == Counter(struck(ODD_TEXTS))
    assert rows(repeats.without_repeats(no_docs)) == []


def test_repeats_saturated_sketch(llm, monkeypatch):
    """With far too few cells every window passes; results stay exact."""
    monkeypatch.setattr(repeats, "MAX_CELLS", 256)
    docs = small_docs()[:60]
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert Counter(rows(repeats.without_repeats(df, texts=True))) == Counter(struck(docs))


def test_sketch_loses_no_repeat():
    pick = np.random.default_rng(3)
    hashes = pick.integers(0, 1 << 63, 5000, dtype=np.uint64)
    hashes = np.concatenate([hashes, hashes[:500]])
    cells = 1 << 16
    seen = np.zeros((2, cells), int)
    for row, stripe, once, twice in repeats.partial_sketch([hashes], cells):
        seen[row, repeats.unpacked(once)] += 1
        seen[row, repeats.unpacked(twice)] += 1
    a, b = repeats.cells_of(hashes[:500], cells)
    assert (seen[0, a] == 2).all() and (seen[1, b] == 2).all()


# ---- 5 ---------------------------------------------------------------------

def bare(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_exact_copies_odd(odd_docs, no_docs):
    got = copies.exact_copies(odd_docs).collect()
    groups = {}
    for i, t in ODD_TEXTS:
        groups.setdefault(bare(t), []).append((-len(t or ""), -1 if i is None else i))
    assert len(got) == len(ODD_TEXTS)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    kept = Counter()
    for r in got:
        g = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(g)
        assert (-1 if r["keep_id"] is None else r["keep_id"]) == min(g)[1]
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert rows(copies.exact_copies(no_docs)) == []


def test_exact_copies_hot(llm):
    """A digest of a third of the rows goes the broadcast way, with the same answer."""
    docs = [(i, "hot text" if i % 3 == 0 else f"text {i % 700}") for i in range(6000)]
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(5)
    slim = copies.slim_rows(df, "doc_id", "text")
    hot = {bytes(r["digest"]) for r in copies.frequent_digests(slim).collect()}
    assert hashlib.sha256(b"hottext").digest() in hot and len(hot) <= copies.COUNTERS
    twins = {}
    for i, t in docs:
        twins.setdefault(t, []).append(i)
    for r in copies.exact_copies(df).collect():
        own = twins[docs[r["doc_id"]][1]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (own[0], len(own), r["doc_id"] == own[0])


# ---- 6 ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def byte_library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BYTES)


def test_byte_encoder(byte_library):
    own = wavelet.ByteEncoder(BYTES)
    pick = random.Random(1)
    signs = list("abcde  \n\t▁éßñ中\U0001f600\x00\x1c\xa0 '.,()01²½жЖ_") + ["<|endoftext|>", "'s", "'ll", "  ", "\r\n", " the"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 30))) for _ in range(6000)]
    want = [e.ids for e in byte_library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, own.kind).tolist() for x in own.encode(texts)] == want


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_wavelet_matrix(n):
    pick = np.random.default_rng(n)
    ids = pick.integers(0, 50257, n)
    ids[:n // 2] = pick.integers(0, 7, n // 2)
    data = wavelet.WaveletMatrix.build(ids, 16).to_bytes([7, None], [n, 0], part=0, shard=0, base=0)
    m = wavelet.WaveletMatrix.from_bytes(data)
    assert (m.tokens() == ids).all()
    assert m.documents()[0] == [7, None]
    for i in range(0, n, 29):
        assert m.access(i) == ids[i]
    for t in (0, 3, 6, 99, 50256, 65536, -1):
        assert m.positions(t) == np.flatnonzero(ids == t).tolist()
        assert m.rank(t, n // 3) == (ids[:n // 3] == t).sum()


def stored(docs, library):
    key = {None: -1}
    lists = sorted(((key.get(i, i), len(x), x, i) for i, x in
                    ((i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in docs)),
                   key=lambda r: (r[0], r[1], np.array(r[2], "<u2").tobytes()))
    out, at = [], 0
    for _, n, ids, i in lists:
        out.append((i, at, n, zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += n
    return out


def test_wavelet_files(odd_docs, no_docs, byte_library, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_TOKENS", 40)
    got = rows(wavelet.read_back(wavelet.written(odd_docs, BYTES, 2)))
    assert Counter(got) == Counter(stored(ODD_TEXTS, byte_library))
    assert rows(wavelet.read_back(wavelet.written(no_docs, BYTES, 2))) == []


def test_wavelet_small(llm, byte_library):
    docs = small_docs()
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = rows(wavelet.read_back(wavelet.written(df, BYTES, 2)))
    assert sorted(got) == stored(docs, byte_library)


# ---- 7 ---------------------------------------------------------------------

def near(docs, bits=2):
    from xxhash import xxh64_intdigest
    prints = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
        h = [xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)))
    return prints, components(prints, bits)


def components(prints, bits):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                root[find(a)] = find(b)
    return [find(x) for x in range(len(prints))]


@pytest.mark.parametrize("which", ["odd", "small"])
def test_near_copies(llm, odd_docs, which):
    docs = small_docs() if which == "small" else ODD_TEXTS
    df = odd_docs if which == "odd" else llm.createDataFrame(docs, "doc_id long, text string")
    prints, comp = near(docs)
    least = {}
    for (i, _), c in zip(docs, comp):
        least[c] = min(x for x in (i, least.get(c)) if x is not None) if (i is not None or c in least) \
            and (i is not None or least.get(c) is not None) else None
    want = [(i, f"{p:016x}", least[c]) for (i, _), p, c in zip(docs, prints, comp)]
    assert Counter(rows(simhash.near_copies(df))) == Counter(want)


def test_near_copies_empty(no_docs):
    assert rows(simhash.near_copies(no_docs)) == []


def test_links_are_whole(llm, monkeypatch):
    """Random fingerprints with dense neighbourhoods, in small and large postings."""
    pick = random.Random(2)
    prints = set()
    for _ in range(12):
        base = pick.getrandbits(64)
        for _ in range(40):
            x = base
            for _ in range(pick.randint(0, 6)):
                x ^= 1 << pick.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = llm.createDataFrame([(p,) for p in signed], "fp long")
    want = Counter(Counter(components(prints, 2)).values())
    for paired in (2, 32, 1000):
        monkeypatch.setattr(simhash, "PAIRED", paired)
        edges = simhash.links(df).selectExpr("a as u", "b as v")
        got = Counter(r["count"] for r in connected(edges).groupBy("root").count().collect())
        assert got == Counter({k: n for k, n in want.items() if k > 1})


def test_connected_chain(llm):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5), (None, 3)]
    got = dict(rows(connected(llm.createDataFrame(chain, "u long, v long"))))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# ---- 8 ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def mid(llm):
    from tests.conftest import SF_MID
    return (llm.read.parquet(f"{SF_MID}/documents.parquet"), llm.read.parquet(f"{SF_MID}/labels.parquet"))


def test_quality_held_out(mid):
    docs, labels = mid
    got = {r["doc_id"]: r for r in quality.scored(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(got[r["doc_id"]], r["quality"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    right = sum(r["predicted"] == q for r, q in held)
    assert right / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_quality_ignores_held_out_labels(mid, llm):
    docs, labels = mid
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 "
                                "then 1 - quality else quality end as quality")
    a = {r["doc_id"]: r["score"] for r in quality.scored(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in quality.scored(docs, flipped).collect()}
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_quality_odd(odd_docs, no_docs, mid, llm):
    _, labels = mid
    assert len(rows(quality.scored(odd_docs, labels))) == len(ODD_TEXTS)
    assert rows(quality.scored(no_docs, labels)) == []
    none = llm.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    assert {r["score"] for r in quality.scored(odd_docs, none).collect()} == {0.5}
    assert quality.kept(odd_docs, none).columns == odd_docs.columns


# ---- 9 ---------------------------------------------------------------------

def labelled(mid):
    docs, labels = mid
    return labels.select("doc_id").join(docs.selectExpr("doc_id", "lang as domain"), "doc_id")


def test_mixing_meets_targets(mid):
    targets = {"en": 0.4, "de": 0.25, "fr": 0.2, "es": 0.15}
    out = mixing.mixed_rates(mid[0], labelled(mid), targets).toPandas()
    total = out.n_tokens.sum()
    for d, w in targets.items():
        assert abs((out.n_tokens * out.rate * out[f"p_{d}"]).sum() / total - w) < 2e-3
    assert (out.rate >= 0).all()
    best = out.set_index("doc_id")[[f"p_{d}" for d in targets]].idxmax(axis=1).str[2:]
    truth = mid[0].select("doc_id", "lang").toPandas().set_index("doc_id").lang
    assert (best == truth.loc[best.index]).mean() > 0.95


def test_mixing_once(mid):
    got = mixing.mixed_once(mid[0], labelled(mid), {"en": 0.58, "de": 0.16, "fr": 0.16, "es": 0.10})
    assert got.columns == mid[0].columns
    assert got.count() == got.select("doc_id").distinct().count() > 0.6 * mid[0].count()


def test_mixing_once_unlabelled(mid):
    targets, n = {"en": 0.58, "de": 0.16, "fr": 0.16, "es": 0.10}, mid[0].count()
    with pytest.warns(UserWarning, match="'es'"):
        got = mixing.mixed_once(mid[0], labelled(mid).where("domain <> 'es'"), targets)
    assert got.count() > 0.7 * n
    with pytest.warns(UserWarning, match="'en'"):
        got = mixing.mixed_once(mid[0], labelled(mid).where("false"), targets)
    assert got.count() == n


def test_mixing_fits_rare(mid, monkeypatch):
    monkeypatch.setattr(mixing, "FIT_ROWS", 60)
    es = labelled(mid).where("domain = 'es'").orderBy(F.xxhash64("doc_id").desc()).limit(2)
    model = mixing.fitted(mid[0], labelled(mid).where("domain <> 'es'").unionByName(es), ["de", "en", "es", "fr"])
    assert model.seen.tolist() == [labelled(mid).where(F.col("domain") == d).count() if d != "es" else 2
                                   for d in model.names]
    docs = mid[0].select("lang", "text").toPandas()
    best = np.array(model.names)[model.posteriors(list(docs.text)).argmax(1)]
    assert (best == docs.lang)[docs.lang == "es"].mean() > 0.8
    assert mixing.quotas({"a": 5, "b": 100, "c": 100}, 60) == {"a": 5, "b": 27, "c": 28}


@pytest.mark.parametrize("budget", ["all", "once"])
def test_mixing_rare_targets(llm, budget):
    pick = np.random.default_rng(0)
    own = pick.choice(4, 40_000, p=[0.2, 0.599, 0.001, 0.2])
    p = np.full((len(own), 4), 1e-4)
    p[np.arange(len(own)), own] = 1
    soft = pick.random(len(own)) < 0.02
    p[soft] = pick.dirichlet(np.ones(3), soft.sum()) @ np.eye(4)[[0, 1, 3]]
    p /= p.sum(1, keepdims=True)
    n = pick.integers(20, 400, len(own))
    members = llm.createDataFrame(list(zip(n.tolist(), p.tolist())), "n_tokens long, p array<double>").cache()
    share = np.array([0.16, 0.58, 0.10, 0.16])
    rate = mixing.solved(members, share.tolist(), budget).of(p)
    got = (n * rate) @ p
    if budget == "all":
        assert abs(got / n.sum() / share - 1).max() < 1e-3
    else:
        assert abs(got / got.sum() / share - 1).max() < 1e-3 and rate.max() <= 1
        assert got.sum() > 0.8 * (n @ p / share).min()
    assert rate.min() >= 0


def test_mixing_odd(odd_docs, no_docs, llm):
    none = llm.createDataFrame([(1, None), (None, "en"), (99, "en"), (6, "xx")], "doc_id long, domain string")
    out = rows(mixing.mixed_rates(odd_docs, none, {"en": 1.0, "de": 1.0}))
    assert len(out) == len(ODD_TEXTS)
    some = llm.createDataFrame([(1, "en"), (1, "de"), (8, "en")], "doc_id long, domain string")
    assert len(rows(mixing.mixed_rates(odd_docs, some, {"en": 1.0, "de": 1.0}))) == len(ODD_TEXTS)
    assert rows(mixing.mixed_rates(no_docs, some, {"en": 1.0, "de": 1.0})) == []


def test_byte_words_encode_as_the_library(byte_library):
    """Words, blanks, signs and contractions in any order, through small caches."""
    import random

    import numpy as np

    from lampwatch.llm import wavelet as W
    from lampwatch.llm.common import vocabulary

    rnd = random.Random(9)
    signs = ["a", "É", "È. ", "Éa", "è. ", "è.\nÉ", "a,É", "ß", " ", "  ", " \n", "\n", "\t", "'s", "'", "n't", ".",
             ",", "…", "1", "12", "中", " .", "(", "don't", "x@y.z", "'ll", "'S", "\x01", "\x00", "\x0b", " ",
             "<|endoftext|>", "\U0001f600", "é", "İ", "\r\n"]
    encoder = W.ByteEncoder(vocabulary("byte_bpe_50k.json"))
    for _ in range(4000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 9)))
        want = encoder.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], encoder.kind).tolist() == want, repr(text)
