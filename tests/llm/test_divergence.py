"""Source divergence (operator 12) against plain Python on whole numbers."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lampwatch.llm import divergence as D
from tests.conftest import SF_SMALL

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_force(rows):
    df, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [lower(t) for t in TERM.findall(text or "")]
        count[lang, source].update(words)
        df[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= 3]
        mine = sorted(s for g, s in groups if g == lang)

        def weights(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counter[t] + 1) // (total + len(kept)) for t in kept}

        whole = Counter()
        for s in mine:
            whole.update(count[lang, s])
        q, p = weights(whole), {s: weights(count[lang, s]) for s in mine}
        for s in mine:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in mine if o != s]
            words = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept
                     if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, top in (("pair", pairs, None), ("term", words, 200)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, o, v, i + 1) for i, (v, o) in enumerate(items[:top])]
    return sorted(out)


def found(docs):
    return sorted(map(tuple, D.audited(docs).select(*COLUMNS).collect()))


def test_query_equals_brute_force(llm):
    from lampwatch.llm.queries import op12_divergence

    rows = llm.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "source", "text").collect()
    got = sorted(map(tuple, op12_divergence(llm, SF_SMALL).select(*COLUMNS).collect()))
    assert got == brute_force(rows) and {r[2] for r in got} == {"pair", "term"}


def test_copies_count_as_often_as_they_are(llm, monkeypatch):
    """Multiplicities by source, groups split over tasks, and flushes in between."""
    monkeypatch.setattr(D, "HELD_TERMS", 3)
    monkeypatch.setattr(D, "HELD_CHARS", 40)
    texts = ["alpha beta beta", "alpha gamma", "Beta BETA delta", "", "alpha", "zeta alpha-beta", "éa É ß"]
    rows = [("en" if i % 3 else "de", f"s{i % 5}", texts[i * i % 7], i) for i in range(400)]
    rows += [("en", "hot", "alpha beta beta", 1)] * 500
    docs = llm.createDataFrame(rows, "lang string, source string, text string, doc_id long").repartition(7)
    assert found(docs) == brute_force([r[:3] for r in rows])


def test_odd_rows(llm, odd_docs, no_docs):
    rows = [(None, None, None), ("", "a", "x\x7fy"), (None, "", "one two"), ("", None, "one two"), ("", "a", "ONE"),
            ("xx", "only", "never kept"), ("yy", "a", ""), ("yy", "b", None), ("yy", "c", "1 2 3"),
            ("zz", "a", "w " * 50_000), ("zz", "b", "w v w"), ("zz", "c", "v w ퟿\U0001f600"), ("zz", "b", "v")]
    docs = llm.createDataFrame([(*r, "z", 1, 2) for r in rows],
                               "lang string, source string, text string, term string, n long, value long")
    assert found(docs) == brute_force(rows)
    assert found(no_docs) == []
    odd = [tuple(r) for r in odd_docs.select("lang", "source", "text").collect()]
    assert found(odd_docs) == brute_force(odd)


@pytest.mark.parametrize("count, total, kept", [(0, 0, 1), (0, 10 ** 13, 10 ** 7), (10 ** 12, 10 ** 13, 10 ** 7),
                                                (9 * 10 ** 9, 9 * 10 ** 9, 1), (3, 17, 5)])
def test_weights_are_exact(llm, count, total, kept):
    row = llm.range(1).select(F.lit(count).alias("n"), F.lit(total).alias("t"), F.lit(kept).alias("v"))
    got = row.select(D.weight("CAST(n AS BIGINT)", "CAST(t AS BIGINT)", "v").alias("p")).first()["p"]
    assert got == 1 + 10 ** 9 * (count + 1) // (total + kept)


def test_terms_like_the_pattern():
    import random
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice("aZ@[`{\x7f\x00 é中\x80\n9") for _ in range(30))
        assert [t.decode() for t in D.terms(text.encode())] == [lower(t) for t in TERM.findall(text)]
