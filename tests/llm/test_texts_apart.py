"""Rows that share or lack an id (operator 3); very long turns (operator 4)."""

import hashlib
import time
import zlib
from collections import Counter

import pytest

from lampwatch.llm import chatlog, repeats
from tests.llm.test_documents import rows, struck


def of_one_crc(a: str, b: str) -> tuple[str, str]:
    """``a`` and ``b`` with a last word each, at which their CRC-32 agree but for the top bit."""
    def tail(name):
        return hashlib.md5(name.encode()).hexdigest()[:12]

    seen = {}
    start = zlib.crc32((a + " ").encode()), zlib.crc32((b + " ").encode())
    for i in range(300_000):
        seen[zlib.crc32(tail(f"x{i}").encode(), start[0]) & 0x7FFFFFFF] = i
    for j in range(300_000):
        i = seen.get(zlib.crc32(tail(f"y{j}").encode(), start[1]) & 0x7FFFFFFF)
        if i is not None:
            return f"{a} {tail(f'x{i}')}", f"{b} {tail(f'y{j}')}"
    raise AssertionError("no pair found")


@pytest.mark.parametrize("key", [None, 7])
def test_equal_crc_under_one_id(llm, key):
    passage = " ".join(f"p{i}" for i in range(20))
    own = " ".join(f"q{i}" for i in range(20))
    one, other = of_one_crc(passage, own)
    assert (zlib.crc32(one.encode()) ^ zlib.crc32(other.encode())) & 0x7FFFFFFF == 0
    docs = [(1, passage), (key, one), (key, other)]
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = rows(repeats.without_repeats(df, texts=True))
    assert Counter(got) == Counter(struck(docs))
    removed = {r[1]: r[2] for r in got if r[0] == key}
    assert sorted(r[2] for r in got if r[0] == key) == [0, 20], removed


def test_long_turn_takes_time_in_proportion(llm):
    """20 million characters: one pass, not one per delta."""
    said = "é\U0001f600 word\n" * 2_500_000
    turns = llm.createDataFrame([(1, 0, "user", "short"), (1, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    began = time.time()
    row = chatlog.read_back(chatlog.formatted(chatlog.as_log(turns))).first()
    assert time.time() - began < 60
    assert row["n_turns"] == 2 and row["loss_chars"] == len(said)
    log = chatlog.as_log(turns.where("turn = 1")).where("kind = 'delta'")
    assert log.count() == -(-len(said) // 512)
    assert {r.n for r in log.selectExpr("length(text) AS n").distinct().collect()} == {512, len(said) % 512 or 512}


def test_edits_and_regenerations_over_tasks(llm):
    """A log with every kind of event, replayed one event at a time."""
    import random

    rnd = random.Random(11)
    events, want = [], {}
    for conv in range(60):
        seq, messages = 0, {}
        for _ in range(rnd.randint(1, 40)):
            seq += 1
            kind = rnd.choice(["message", "delta", "delta", "edit", "regenerate"])
            if kind == "message" or not messages:
                m = len(messages)
                messages[m] = {"role": rnd.choice(["user", "assistant"]), "text": "", "opened": seq, "gone": False}
                events.append((conv, seq, "message", m, messages[m]["role"], None))
                continue
            m = rnd.choice([k for k, v in messages.items() if not v["gone"]] or [0])
            if messages[m]["gone"]:
                continue
            text = rnd.choice(["a", "b<|im_end|>", "c\\", "é\n"])
            events.append((conv, seq, kind, m, None, text))
            if kind == "delta":
                messages[m]["text"] += text
            else:
                messages[m]["text"] = text
            if kind == "regenerate":
                for v in messages.values():
                    if messages[m]["opened"] < v["opened"] < seq:
                        v["gone"] = True
        want[conv] = [(v["role"], v["text"]) for v in sorted(messages.values(), key=lambda v: v["opened"])
                      if not v["gone"]]
    rnd.shuffle(events)
    log = llm.createDataFrame(events + events[:50], "conv_id long, seq long, kind string, message long, "
                                                    "role string, text string").repartition(7)
    got = {}
    for r in sorted(chatlog.formatted(log).collect(), key=lambda r: (r.conv_id, r.turn)):
        got.setdefault(r.conv_id, []).extend(chatlog.parsed(r.piece))
    assert got == {k: v for k, v in want.items() if v}
