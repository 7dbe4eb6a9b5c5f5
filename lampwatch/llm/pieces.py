"""SentencePiece encoding and decoding by a merge agenda (operator 1).

A merge-type vocabulary is applied as its definition says: a text starts as
single characters; an agenda (heap) holds every adjacent pair that forms a
piece, best score first, leftmost first among equals; the best pair is
merged, its new neighbours enter the agenda, stale entries are skipped.
Characters that are no piece become their UTF-8 byte pieces.

The agenda runs on *segments*, not whole texts.  A cut between two
characters is safe when no piece holds them side by side.  Three such cuts
are derived from the vocabulary when it is loaded: before a space mark that
follows another character, on both sides of a character that is part of no
longer piece (a line feed, say), and between a letter and a character that
follows a letter in no piece (a full stop, say).  Segments repeat, so their ids are kept
in a bounded two-generation cache per worker process.

Every segment that is new to a worker is checked, one library call per Arrow
batch, against the sentencepiece library's own encoding of it; a difference
stops the job.  Whole texts therefore consist of checked segments only.
Models whose normaliser changes characters, or whose pieces hold a space
mark after another character, are refused.

Null texts count as empty and give no ids; ids may repeat or be null; other
columns are ignored; an empty table gives no rows.  Long texts are handled
whole; a batch is cut into runs of about ``RUN_CHARS`` characters.
"""

from __future__ import annotations

import hashlib
import re
from heapq import heapify, heappop, heappush
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: segments per cache generation (two are held), and characters worked on at a time
CACHE_SEGMENTS = 300_000
RUN_CHARS = 2_000_000


class PieceModel:
    """A merge-type vocabulary with its agenda encoder and its decoder."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = lib.get_piece_size()
        text = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i)
                                             or lib.is_unknown(i) or lib.is_unused(i))]
        self.id_of = {text[i]: i for i in plain}
        self.score_of = {text[i]: -lib.get_score(i) for i in plain if len(text[i]) > 1}
        self.byte_id = {int(text[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.is_byte = [lib.is_byte(i) for i in range(n)]
        self.unknown = lib.unk_id()
        self.out = [b"" if lib.is_control(i) else b" \xe2\x81\x87 " if lib.is_unknown(i)
                    else bytes([int(text[i][3:5], 16)]) if lib.is_byte(i)
                    else text[i].replace(MARK, " ").encode("utf-8") for i in range(n)]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.score_of):
            raise ValueError("a piece holds a space mark after another character")
        if lib.encode("ﬁ Ａ  é ", out_type=str) and \
                lib.decode(lib.encode("ﬁ Ａ  é ")) != "ﬁ Ａ  é ":
            raise ValueError("the model's normaliser changes characters")
        self.segments = self._cuts()
        # what the library gives for the line feeds that frame a checked segment
        self.after = lib.encode("a\n")[len(lib.encode("a")):]
        self.before = lib.encode("\n")
        self.young: dict[str, tuple[tuple[int, ...], str]] = {}
        self.old: dict[str, tuple[tuple[int, ...], str]] = {}

    def _cuts(self):
        """The pattern that takes a marked text apart at safe cuts."""
        inner = set(chain.from_iterable(self.score_of)) - {MARK}
        if "\n" in inner:
            raise ValueError("the line feed is part of longer pieces")
        follows = {b for p in self.score_of for a, b in zip(p, p[1:]) if a.isalpha()}
        letters = {c for c in inner if c.isalpha()}
        group = {"l": letters, "n": inner - letters, "m": (inner - letters) & follows,
                 "i": inner | {MARK}}
        l, n, m, i = (re.escape("".join(sorted(group[k]))) for k in "lnmi")  # noqa: E741
        # letters, then other characters only if the first of them may follow a letter
        words = f"(?:[{l}]+(?:[{m}][{n}]*)?)"
        return re.compile(f"{MARK}+[{n}]*{words}*|[{n}]+{words}*|{words}+|[^{i}]").findall

    def agenda(self, segment: str) -> tuple[int, ...]:
        """Ids of one segment."""
        score = self.score_of
        sym = list(segment)
        n = len(sym)
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            pair = sym[i] + sym[i + 1]
            if pair in score:
                heap.append((score[pair], i, pair))
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = nxt[i]
            if not sym[i] or j >= n or sym[i] + sym[j] != pair:
                continue  # one side has been merged since
            sym[i], sym[j] = pair, ""
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                longer = pair + sym[k]
                if longer in score:
                    heappush(heap, (score[longer], i, longer))
            h = prv[i]
            if h >= 0:
                longer = sym[h] + pair
                if longer in score:
                    heappush(heap, (score[longer], h, longer))
        ids: list[int] = []
        for s in sym:
            if not s:
                continue
            i = self.id_of.get(s)
            if i is not None:
                ids.append(i)
            elif self.byte_id:
                ids.extend(self.byte_id[b] for b in s.encode("utf-8"))
            else:
                ids.append(self.unknown)
        return tuple(ids)

    def learn(self, segments: set[str]) -> None:
        """Encode what is not in the cache and check it with the library."""
        young, old = self.young, self.old
        new = []
        for s in segments:
            if s not in young:
                known = old.get(s)
                if known is None:
                    new.append(s)
                else:
                    young[s] = known
        ids = [self.agenda(s) for s in new]
        framed = [(s[1:] if s[0] == MARK else "\n" + s) + "\n" for s in new]
        for s, own, lib in zip(new, ids, self.library.encode(framed, num_threads=1)):
            head = [] if s[0] == MARK else self.before
            if [*head, *own, *self.after] != lib:
                raise ValueError(f"agenda and library differ on {s!r}: {own} and {lib}")
            young[s] = own, ",".join(map(str, own))

    def encode(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """Ids of each text, as a list and as decimals joined by commas."""
        cut = [self.segments(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(cut)))
        known = self.young
        out = []
        for segs in cut:
            got = [known[s] for s in segs]
            out.append((list(chain.from_iterable([g[0] for g in got])),
                        ",".join([g[1] for g in got])))
        if len(known) > CACHE_SEGMENTS:
            self.old, self.young = known, {}
        return out

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the text; a byte that belongs to no character becomes U+FFFD."""
        if not ids:
            return b""
        raw = b"".join(map(self.out.__getitem__, ids))
        if raw[:1] == b" " and not self.is_byte[ids[0]]:
            raw = raw[1:]
        try:
            raw.decode("utf-8")
        except UnicodeDecodeError:
            lone = raw.decode("utf-8", "surrogateescape")
            raw = re.sub("[\udc80-\udcff]", "�", lone).encode("utf-8")
        return raw


_MODELS: dict[str, PieceModel] = {}


def loaded(model_file: str) -> PieceModel:
    """The model of this worker process, with its cache."""
    if model_file not in _MODELS:
        _MODELS[model_file] = PieceModel(model_file)
    return _MODELS[model_file]


def runs(texts: list[str], chars: int = RUN_CHARS):
    """Index ranges of about ``chars`` characters, one text at least."""
    a = n = 0
    for i, t in enumerate(texts):
        if n and n + len(t) > chars:
            yield a, i
            a, n = i, 0
        n += len(t)
    if texts:
        yield a, len(texts)


def encoded(docs: DataFrame, model_file: str, id_col: str = "doc_id",
            text_col: str = "text", digests: bool = False) -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` per row; with ``digests``
    instead ``doc_id, n_tokens, ids_sha256, decoded_sha256``, so that only
    digests leave the Python workers."""
    def run(batches):
        import pyarrow as pa

        from lampwatch.llm.pieces import loaded, runs  # the worker's own module keeps the cache
        model = loaded(model_file)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in runs(texts):
                got = model.encode(texts[lo:hi])
                key = b.column(0).slice(lo, hi - lo)
                plain = [model.decode(ids) for ids, _ in got]
                if digests:
                    cols = [pa.array([len(ids) for ids, _ in got], pa.int64()),
                            pa.array([hashlib.sha256(s.encode()).hexdigest() for _, s in got], pa.string()),
                            pa.array([hashlib.sha256(p).hexdigest() for p in plain], pa.string())]
                    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    cols = [pa.array([ids for ids, _ in got], pa.list_(pa.int32())),
                            pa.array([p.decode("utf-8") for p in plain], pa.string())]
                    names = ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([key, *cols], names=["doc_id", *names])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    rest = ("n_tokens long, ids_sha256 string, decoded_sha256 string" if digests
            else "ids array<int>, decoded string")
    return slim.mapInArrow(run, f"doc_id long, {rest}")
