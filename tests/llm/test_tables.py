"""Operators on embeddings, conversations and pages, the pipeline, and the
registered queries with SQL."""

import base64
import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lampwatch.llm import chatlog, hamming_index, oracle, queries, warc
from tests.conftest import SF_MID, SF_SMALL


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- 2 ---------------------------------------------------------------------

def brute(vectors, queries_, k):
    out = {}
    for q in queries_:
        d = np.sqrt(((np.array([v for _, v in vectors]) - dict(vectors)[q]) ** 2).sum(1))
        out[q] = sorted((x, i) for x, (i, _) in zip(d.tolist(), vectors) if i != q)[:k]
    return out


def test_neighbours_recall(llm):
    pick = np.random.default_rng(0)
    x = pick.normal(size=(12_000, 64))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(float)
    x[3000:5000] = x[77]  # one very common vector
    vectors = [(i, v) for i, v in enumerate(x)]
    df = llm.createDataFrame([(i, v.tolist(), 0) for i, v in vectors],
                             "vec_id long, embedding array<float>, score int")
    got = {}
    for q, rank, i, s in sorted(rows(hamming_index.neighbours(df, F.col("vec_id") % 500 == 0))):
        got.setdefault(q, []).append((s, i))
        assert rank == len(got[q])
    want = brute(vectors, got, 10)
    assert len(got) == 24
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hit >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert found == sorted(found)
        for s, i in found:
            assert abs(s - np.sqrt(((x[q] - x[i]) ** 2).sum())) < 1e-12


def test_neighbours_repeated_query(llm):
    data = [(0, [0.0, 1.0]), (0, [1.0, 0.0]), (0, [0.5, 0.5]), (1, [0.9, 0.1]), (2, [0.1, 0.9])]
    for rows_ in (data, data[::-1], [data[1], data[0], *data[2:]], [data[2], *data[:2], *data[3:]]):
        df = llm.createDataFrame(rows_, "vec_id long, embedding array<double>").coalesce(1)
        got = rows(hamming_index.neighbours(df, F.col("vec_id") == 0, k=1))
        assert [r[:3] for r in got] == [(0, 1, 2)]  # of [0, 1], the smallest


def test_retrieves_every_code_in_radius():
    pick = np.random.default_rng(1)
    x = pick.normal(size=(2000, 64))
    shard = hamming_index.HammingShard(np.arange(2000), x, *hamming_index.learned(x))
    for radius in (0, 3, 9, 17, 28, 40, 64):
        code = shard.codes[radius]
        want = np.flatnonzero(np.bitwise_count(shard.codes ^ code).sum(1) <= radius)
        assert (shard.retrieve(code, radius) == want).all()


def test_neighbours_odd(llm):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [0.9, 0.1]), (0, [1.0, 0.0])]
    df = llm.createDataFrame(data, "vec_id long, embedding array<double>")
    got = rows(hamming_index.neighbours(df, F.col("vec_id") % 2 == 0, k=2))
    assert sorted((q, r, i) for q, r, i, _ in got) == [(0, 1, 1), (0, 2, 9), (2, 1, 9), (2, 2, 0)]
    assert rows(hamming_index.neighbours(df.where("false"), F.col("vec_id") % 2 == 0)) == []
    assert rows(hamming_index.neighbours(df, F.col("vec_id") > 99)) == []


# ---- 4 ---------------------------------------------------------------------

def event_log(llm, events):
    return llm.createDataFrame(events, "conv_id long, seq long, kind string, message long, role string, "
                                       "text string, opened string").repartition(3)


def test_fold(llm):
    e = [
        (1, 1, "message", 1, "user", "Hi", None), (1, 2, "message", 2, "assistant", None, None),
        (1, 3, "delta", 2, None, "Hel", None), (1, 4, "delta", 2, None, "lo", None),
        (1, 4, "delta", 2, None, "lo", None),  # delivered twice
        (1, 5, "message", 3, "user", "withdrawn", None),
        (1, 6, "edit", 1, None, "Hi there", None),
        (1, 7, "regenerate", 2, None, None, None), (1, 8, "delta", 2, None, "Good ", None),
        (1, 9, "delta", 2, None, "day <|im_end|> \\", None), (1, 10, "message", 4, "user", "Bye", None),
        (1, 11, "nonsense", 4, None, "ignored", None),
        (None, 1, "message", 1, "sys\ntem", "", None), (2, None, "delta", None, None, "lost", None),
    ]
    got = rows(chatlog.formatted(event_log(llm, e)))
    by = {}
    for conv, turn, role, piece, start, lo, hi in sorted(got, key=lambda r: (r[0] or 0, r[1])):
        by.setdefault(conv, []).append((role, piece))
        assert start == sum(len(p) for _, p in by[conv][:-1])
        assert (lo is None) == (role != "assistant")
    texts = {c: chatlog.parsed("".join(p for _, p in v)) for c, v in by.items()}
    assert texts == {
        1: [("user", "Hi there"), ("assistant", "Good day <|im_end|> \\"), ("user", "Bye")],
        None: [("sys\ntem", "")], 2: [("", "lost")]}
    assert rows(chatlog.formatted(event_log(llm, e).where("false"))) == []


def test_escape_round_trip():
    pick = random.Random(0)
    for _ in range(3000):
        turns = [("".join(pick.choice("ab\\\n<|>n") for _ in range(5)),
                  "".join(pick.choice(["<|im_end|>", "<|", "|>", "\\", "n", "\n", "<", "|", "é"])
                          for _ in range(pick.randint(0, 9)))) for _ in range(3)]
        text = "".join(f"<|im_start|>{chatlog.escaped(r, True)}\n{chatlog.escaped(t)}<|im_end|>\n" for r, t in turns)
        assert chatlog.parsed(text) == turns


def test_chat_odd(llm):
    data = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, None, None, "first"),
            (None, 0, "user", "x" * 3000), (2, 5, "assistant", "a" * 513 + "é"), (2, 5, "assistant", "A")]
    df = llm.createDataFrame([(*r, 9) for r in data], "conv_id long, turn long, role string, text string, seq int")
    got = {r["conv_id"]: r for r in chatlog.read_back(chatlog.formatted(chatlog.as_log(df))).collect()}

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("\nfirst\nuser\n\nassistant\n\nassistant\n\n")
    assert got[2]["loss_sha256"] == sha("A" + "a" * 513 + "é") and got[2]["loss_chars"] == 515
    assert got[None]["n_turns"] == 1 and got[None]["loss_chars"] == 0
    assert got[None]["formatted_chars"] == len("<|im_start|>user\n<|im_end|>\n") + 3000


# ---- 10 --------------------------------------------------------------------

def test_warc_odd(llm, monkeypatch):
    data = [(3, "http://a/", "<p>one</p>"), (1, "http://b/", "<p>one</p>"), (2, None, ""), (5, "x\r\ny", None),
            (4, "http://c/", "é" * 9000), (None, "http://d/", "<p>one</p>"), (None, "u", "alone"), (6, "u", "twice"),
            (6, "u", "twice"), (7, "http://c/", "\r\n\r\nWARC/1.1\r\n\r\n")]
    df = llm.createDataFrame([(*r, "x") for r in data], "page_id long, url string, html string, sha1 string")
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    got = rows(warc.read_back(warc.written(df)))
    want = []
    for i, _, h in data:
        b = (h or "").encode()
        first = min((j for j, _, x in data if (x or "") == (h or "") and j is not None), default=None)
        twin = first is not None and first != i
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                     "revisit" if twin else "response", first if twin else None))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert rows(warc.read_back(warc.written(df.where("false")))) == []
    kinds = {r[3] for r in rows(warc.read_back(warc.written(df, least_bytes=10 ** 6)))}
    assert kinds == {"response"}


def test_archive_layout():
    import zstandard
    records = [warc.page_record(i, f"http://h/{i}", b"<html>%d</html>" % i * 50,
                                hashlib.sha1(b"<html>%d</html>" % i * 50).digest(), None, "2024-01-01T00:00:00Z")
               for i in range(300)]
    data, places = warc.archive(records, "2024-01-01T00:00:00Z")
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(data[4:8], "little")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    for (at, n), r in list(zip(places, records))[::37]:  # one record from its own frame
        assert unpack.decompress(data[at:at + n]) == r
    assert [r[0] for r in warc.parse(data)] == list(range(300))


# ---- queries and pipeline --------------------------------------------------

def connect(sf_dir):
    c = duckdb.connect()
    for t in ("documents", "conversations", "pages", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(llm, name):
    want = connect(SF_SMALL).execute(oracle.SQL[name]).df()
    got = queries.QUERIES[name](llm, SF_SMALL).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    a, b = (x[cols].astype(str).sort_values(cols).reset_index(drop=True) for x in (want, got))
    assert a.equals(b)


def test_pipeline_stages(llm):
    import corpus_pipeline as p

    docs = llm.read.parquet(f"{SF_MID}/documents.parquet")
    cols, left = docs.columns, {}
    for name, f in p.STAGES[:-1]:
        docs = p.stage(f(llm, docs, SF_MID), "test")
        assert docs.columns == cols, name
        left[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        assert len(left[name]) == docs.count()
    sizes = [len(v) for v in left.values()]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] < 1000 and sizes[-1] > 500
    exact = ["".join(t.split()) for t in left["exact dedup"].values()]
    assert len(exact) == len(set(exact))
    out = p.STAGES[-1][1](llm, docs, SF_MID)
    assert out.count() == sizes[-1]


def test_pipeline_odd_rows(llm, odd_docs):
    import corpus_pipeline as p

    for docs in (odd_docs, odd_docs.where("false")):
        cur = docs.select("doc_id", "text", "lang", "source", "row")
        for _, f in p.STAGES[:-1]:
            cur = p.stage(f(llm, cur, SF_SMALL), "test")
            assert cur.columns == ["doc_id", "text", "lang", "source", "row"]
        p.STAGES[-1][1](llm, cur, SF_SMALL).collect()
    twice = odd_docs.where("doc_id = 14")
    assert sorted(r["text"] for r in p.exact_dedup(llm, twice, SF_SMALL).collect()) == [
        "other text under one id", "same same"]
