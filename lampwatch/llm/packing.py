"""Packing documents into token windows (operator 11).

Texts are encoded with a lower-casing word BPE vocabulary of the tokenizers
library and get an end id.  A document longer than the window gives whole
windows first; what is left of each (1 to window - 1 ids) is packed:

1. *Combinations.*  Every pair and triple of occurring lengths that fills the
   window exactly.
2. *Repeat counts.*  The counts solve the non-negative least-squares problem
   ``min |A x - h|``, ``x >= 0``: ``h`` is the histogram of lengths, a column
   of ``A`` the lengths of one combination.  An accelerated projected
   gradient solves it; a step costs three additions per combination.
3. *Rounding.*  Largest counts first, each rounded to the nearest whole number
   and held to what is left of its lengths; then once more, rounded up.
4. *Residuals* are packed greedily, longest fitting piece first.  Where
   nothing fits the gap, the longest piece is cut to fill it.  What cannot
   fill a window at the very end is laid out as powers of two.

So no sequence needs padding: each has the window's length, or a power of two.

A task packs its own documents, ``GROUP_TOKENS`` ids at a time, so the
histogram (bounded by the window) and the ids held (2 bytes each) are bounded
and nothing is shuffled; a group is a function of its input split, so a
repeated attempt gives the same sequences.  ``sequence_id`` is the task's
number times 2^40 plus a running number.

The vocabulary's pre-tokenizer drops white space, so a text's ids are those of
its words, and splits letters from the signs after them.  A text of usual
letters is lower-cased, and its full stops and commas split off, as a whole.
A worker keeps the ids of words, and of their lower-cased pre-tokens, in
bounded two-generation caches.  Texts with white space other than blank, tab and line ends, or
with the text of an added token, are given to the library whole.

Null texts count as empty and hold the end id alone; ids may repeat or be
null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lampwatch.llm.wavelet import LETTERS, ODD_SPACE, SIGNS

WINDOW = 2048
GROUP_TOKENS = 1 << 22
CACHE_WORDS = 400_000
#: characters of a text whose words are held at a time
RUN_CHARS = 2_000_000
#: gradient steps of the least-squares solution
STEPS = 60
#: places of a sequence number below the task's number
TASK_SHIFT = 40


class _Words(dict):
    """Packed ids of words; what is missing comes from the generation before,
    or is encoded."""

    def __init__(self, encode, old):
        super().__init__()
        self.encode, self.old = encode, old

    def __missing__(self, word):
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        self[word] = ids
        return ids

    def next(self) -> "_Words":
        """An empty generation that falls back on this one."""
        self.old = {}
        return _Words(self.encode, self)


class WordEncoder:
    """Ids of texts under a tokenizers file that lower-cases and drops white
    space, through a cache of words."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_file)
        model = self.whole.model
        if hasattr(model, "_resize_cache"):
            model._resize_cache(0)  # the words are cached here
        self.model = model.tokenize
        size = self.whole.get_vocab_size()
        self.kind, width = ("<u2", 2) if size <= 1 << 16 else ("<u4", 4)
        self.packed = [i.to_bytes(width, "little") for i in range(size)]  # the bytes of each id
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.odd_space = re.compile(ODD_SPACE).search
        signs = r"!-&(-/:-@\[-`{-~"  # ASCII signs but the apostrophe, which binds letters
        self.parts = re.compile(f"([{LETTERS}]+)([{signs}]*)").fullmatch
        if self._library("Aé b\n c") != self._ids("aé") + self._ids("b") + self._ids("c"):
            raise ValueError("the vocabulary does not encode word by word")
        # pre-tokens of lower-cased ASCII words
        self.pieces = re.compile(r"'(?:[stmd]|re|ve|ll)|[a-z]+|[0-9]|[!-/:-@\[-`{-~]+").findall
        # what keeps a text from being lower-cased and split as a whole: odd white space and
        # letters beyond the usual, or a full stop or comma that is not the first sign after a word
        self.unusual = re.compile(f"[{ODD_SPACE[1:-1]}\u0130\u0250-\U0010ffff]").search
        self.unclear = re.compile(rf"[.,](?<![{LETTERS}0-9][.,])").search
        self.words = _Words(self._packed, {})
        self.stems = _Words(self._stem, {})
        self.signs = _Words(lambda w: self._pack(self._library(w)), {})

    def _library(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _pack(self, ids: list[int]) -> bytes:
        one = self.packed
        return b"".join([one[i] for i in ids])

    def _ids(self, stem: str) -> list[int]:
        """Ids of lower-cased letters, which are one pre-token."""
        if not stem.isascii():
            stem = "".join([SIGNS[b] for b in stem.encode("utf-8")])
        return [t.id for t in self.model(stem)]

    def _stem(self, stem: str) -> bytes:
        return self._pack(self._ids(stem))

    def _packed(self, word: str) -> bytes:
        if word.isascii():
            small = word.lower()
            if small.isalpha():
                return self.stems[small]
            pieces = self.pieces(small)
            if sum(map(len, pieces)) == len(small):  # printable throughout
                return b"".join([self.stems[p] for p in pieces])
        parts = self.parts(word)
        if not parts:
            return self._pack(self._library(word))
        stem, signs = parts.groups()
        small = stem.lower()
        if len(small) != len(stem):  # a letter that becomes a letter and a mark
            return self._pack(self._library(word))
        ids = self.stems[small]
        return ids + self.signs[signs] if signs else ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, packed as ``kind``."""
        unusual = self.unusual(text)
        if unusual and self.odd_space(text) or any(a in text for a in self.added):
            return np.array(self._library(text), dtype=self.kind).tobytes()
        known = self.words.__getitem__
        if not unusual and not self.unclear(text):
            text = text.lower().replace(".", " .").replace(",", " ,")
        if len(text) <= RUN_CHARS:
            out = b"".join(map(known, text.split()))
        else:
            cuts = [0]
            while 0 <= (at := text.find(" ", cuts[-1] + RUN_CHARS)):
                cuts.append(at)
            out = b"".join([b"".join(map(known, text[a:b].split()))
                            for a, b in zip(cuts, [*cuts[1:], len(text)])])
        for name in ("words", "stems", "signs"):
            cache = getattr(self, name)
            if len(cache) > CACHE_WORDS:
                setattr(self, name, cache.next())
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def loaded(tokenizer_file: str) -> WordEncoder:
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of the rising ``lengths`` that add up to the
    window, a row each; a pair's first place is 0."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    there[0] = True  # the empty place of a pair
    out = []
    for a in np.flatnonzero(there[:window // 3 + 1]):
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        b = b[there[b] & there[window - a - b]]
        out.append(np.stack([np.full(len(b), a), b, window - a - b], axis=1))
    return np.concatenate(out).astype(np.int64)


def repeat_counts(parts: np.ndarray, hist: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: how often each combination is to be used
    so that the lengths used come closest to the histogram."""
    def used(x):
        got = np.bincount(parts.ravel(), weights=np.repeat(x, parts.shape[1]), minlength=len(hist))
        got[0] = 0  # the empty place is no length
        return got

    x = np.zeros(len(parts))
    if not len(parts):
        return x
    v = np.ones(len(parts))
    for _ in range(12):  # the largest eigenvalue of A'A bounds the step
        v = used(v)[parts].sum(1)
        size = (v * v).sum() ** 0.5
        v /= size
    step = 1 / (1.1 * size)
    y, momentum = x, 1.0
    goal = np.where(np.arange(len(hist)) > 0, hist, 0.0)
    for _ in range(steps):
        new = np.maximum(0.0, y - step * (used(y) - goal)[parts].sum(1))
        grown = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        y = new + (momentum - 1) / grown * (new - x)
        if ((new - x) * (y - new)).sum() < 0:  # overshot: restart the momentum
            y, grown = new, 1.0
        x, momentum = new, grown
    return x


def rounded(parts: np.ndarray, x: np.ndarray, hist: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeat counts that the histogram can pay for, and what was used
    is taken from ``hist``."""
    plan = []
    order = np.argsort(-x, kind="stable")
    order = order[x[order] > 1e-6]
    for up in (0.5, 1 - 1e-9):
        for lo in range(0, len(order), 4096):
            block = order[lo:lo + 4096]
            block = block[(hist[parts[block]] > 0).sum(1) + (parts[block] == 0).sum(1) >= parts.shape[1]]
            for c in block.tolist():
                want = int(x[c] + up)
                if not want:
                    continue
                lengths = tuple(p for p in parts[c].tolist() if p)
                k = min(want, *(int(hist[p]) // lengths.count(p) for p in lengths))
                if k:
                    plan.append((lengths, k))
                    for p in lengths:
                        hist[p] -= k
    return plan


def packed_lengths(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(index, start, length)`` that hold all of every length
    (each from 1 to window - 1)."""
    hist = np.bincount(np.array(lengths, dtype=np.int64), minlength=window + 1)
    hist[0] = 0
    parts = combinations(np.flatnonzero(hist), window)
    plan = rounded(parts, repeat_counts(parts, hist), hist)

    stacks: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        stacks[lengths[i]].append((i, 0))
    out = []
    for pattern, k in plan:
        for _ in range(k):
            out.append([(*stacks[n].pop(), n) for n in pattern])

    left = 0  # bit n: there is a piece of length n
    for n in range(1, window + 1):
        if stacks[n]:
            left |= 1 << n

    def take(n):
        nonlocal left
        piece = stacks[n].pop()
        if not stacks[n]:
            left &= ~(1 << n)
        return piece

    while left:
        row, space = [], window
        while space and left:
            fitting = left & ((2 << space) - 1)
            if fitting:
                n = fitting.bit_length() - 1
                row.append((*take(n), n))
                space -= n
            else:
                n = left.bit_length() - 1
                i, start = take(n)
                row.append((i, start, space))
                stacks[n - space].append((i, start + space))
                left |= 1 << (n - space)
                space = 0
        if space:
            out.extend(powers(row, window - space))
        else:
            out.append(row)
    return out


def powers(row: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """Pieces of ``total`` ids, cut into sequences whose lengths are powers of two."""
    out, row = [], row[::-1]
    while total:
        size = space = 1 << (total.bit_length() - 1)
        one = []
        while space:
            i, start, n = row.pop()
            m = min(n, space)
            one.append((i, start, m))
            if m < n:
                row.append((i, start + m, n - m))
            space -= m
        out.append(one)
        total -= size
    return out


def packed_documents(tokens: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(document, start, length)`` over documents of so many ids."""
    out = [[(d, at, window)] for d, n in enumerate(tokens) for at in range(0, n - window + 1, window)]
    rest = [(d, n % window) for d, n in enumerate(tokens) if n % window]
    for row in packed_lengths([n for _, n in rest], window) if rest else []:
        out.append([(rest[i][0], tokens[rest[i][0]] - rest[i][1] + start, n) for i, start, n in row])
    return out


def packed(docs: DataFrame, tokenizer_file: str, end_id: int, window: int = WINDOW,
           id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``, and with ``ids`` the piece's ids as little-endian
    unsigned 32-bit integers."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from lampwatch.llm.packing import GROUP_TOKENS, TASK_SHIFT, loaded, packed_documents
        encoder = loaded(tokenizer_file)
        width = np.dtype(encoder.kind).itemsize
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        number = TaskContext.get().partitionId() << TASK_SHIFT
        keys, held, size = [], [], 0

        def rows():
            nonlocal number
            tokens = [len(h) // width for h in held]
            cols = [[] for _ in range(8)]
            whole, last = None, -1
            for row in packed_documents(tokens, window):
                offset = 0
                for d, start, n in row:
                    if d != last:
                        whole, last = np.frombuffer(held[d], encoder.kind).astype("<u4"), d
                    piece = whole[start:start + n]
                    for c, v in zip(cols, (keys[d], start, n, zlib.crc32(piece), tokens[d], number, offset)):
                        c.append(v)
                    if ids:
                        cols[7].append(piece.tobytes())
                    offset += n
                number += 1
                if len(cols[0]) >= 20_000:
                    yield batch(cols)
                    cols = [[] for _ in range(8)]
            if cols[0]:
                yield batch(cols)

        def batch(cols):
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if ids:
                arrays.append(pa.array(cols[7], pa.binary()))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                keys.append(key)
                held.append(encoder.encode(text.as_py() or "") + end)
                size += len(held[-1]) // width
                if size >= GROUP_TOKENS:
                    yield from rows()
                    keys, held, size = [], [], 0
        if held:
            yield from rows()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                "sequence_id long, offset long" + (", ids binary" if ids else ""))


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The windows themselves, from ``packed(..., ids=True)``: ``sequence_id,
    ids binary`` (32-bit, padded to the window unless the length is a power of
    two) and ``pieces``, their ``(doc_id, start, length, offset)``.  A group
    is one window, so it is bounded."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    out = pieces.groupBy("sequence_id").agg(rows.alias("r"))
    joined = F.aggregate("r", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    n = (F.length(joined) / 4).cast("int")
    pad = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(F.greatest(F.lit(window) - n, F.lit(0)))
    filler = F.unhex(F.expr(f"repeat('{pad_id.to_bytes(4, 'little').hex()}', {window})"))
    return out.select("sequence_id", F.concat(joined, F.substring(filler, F.lit(1), pad * 4)).alias("ids"),
                      F.transform("r", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"),
                                                          p["length"].alias("length"),
                                                          p["offset"].alias("offset"))).alias("pieces"))
