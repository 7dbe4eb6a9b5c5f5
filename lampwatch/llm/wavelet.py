"""Token ids in one wavelet-matrix file per shard (operator 6).

Texts are encoded with a byte-level BPE vocabulary of the tokenizers library
and get an end id.  The ids are range-partitioned by document id (bounds are
quantiles of the id column alone, so no text is read for them), each
partition is sorted, cut into shards of about ``SHARD_TOKENS`` ids, never
within a document, and each shard is written as one compressed file.

File layout (little-endian): magic ``WMX1``; a 4-byte header length; a JSON
header (ids, bit width, zeros per plane, partition, shard number, ids of the
partition before this shard, lengths of the blobs); then Zstandard blobs:
document ids, null flags, document lengths, and per bit-plane, from the
highest bit, its packed bits and its rank directory (ones before each block
of 512 bits).  A plane holds one bit of every id in the order that the planes
above have stably partitioned, zeros first.  From one file
:class:`WaveletMatrix` answers ``access``, ``rank``, ``count``, ``select``
and ``positions`` with one rank or select per plane; ``tokens`` restores all.

Encoding works on chunks that the vocabulary's pre-tokenizer never joins.  In
a text without two blanks in a row these are its words, split at blanks, each
with the blank before it, and the full stops and commas after words with what
follows them; in other texts, white space and the letters after it
when a sign or white space follows these, else all up to the next white space.
Chunks repeat, so a bounded two-generation cache per worker holds their ids;
a new word of several pre-tokens is put together from theirs.  The ids come
from the library's model.  Texts with white space other
than blank, tab and line ends, or with the text of an added token, are given
to the library whole.

Null texts count as empty and hold the end id alone; null ids sort first;
rows that repeat an id are stored one after the other, shorter first; other
columns are ignored; an empty table writes no file.  A document longer than
a shard gets a shard of its own.
"""

from __future__ import annotations

import json
import re
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lampwatch.llm.common import as_uri, n_tasks, write_atomic
from lampwatch.session import scratch_path

MAGIC = b"WMX1"
SHARD_TOKENS = 1 << 22
BLOCK_BITS = 512
CACHE_CHUNKS = 400_000
RUN_CHARS = 2_000_000


#: letters of the cached one-word chunks
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"


#: white space, or control characters near it, that the cached chunks leave out
ODD_SPACE = "[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _byte_signs() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others in order for the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_SIGNS = _byte_signs()
#: the sign of each byte
SIGNS = [BYTE_SIGNS.get(b, chr(b)) for b in range(256)]


class _Chunks(dict):
    """Packed ids of chunks; what is missing comes from the generation before,
    or is encoded."""

    def __init__(self, encode, old):
        super().__init__()
        self.encode, self.old = encode, old

    def __missing__(self, chunk):
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        self[chunk] = ids
        return ids

    def next(self) -> "_Chunks":
        """An empty generation that falls back on this one."""
        self.old = {}
        return _Chunks(self.encode, self)


class ByteEncoder:
    """Ids of texts under a tokenizers file, through a cache of chunks."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_file)
        if self.whole.normalizer is not None:
            raise ValueError("the tokenizer's normaliser may change texts")
        model = self.whole.model
        if hasattr(model, "_resize_cache"):
            model._resize_cache(0)  # the chunks are cached here
        self.model = model.tokenize
        self.bits = max(1, (self.whole.get_vocab_size() - 1).bit_length())
        self.kind = "<u2" if self.bits <= 16 else "<u4"
        # the bytes of each id
        self.packed = [i.to_bytes(int(self.kind[2]), "little") for i in range(1 << self.bits)]
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.odd_space = re.compile(ODD_SPACE).search
        sign = r"!-@\[-`{-~"  # ASCII characters that are neither letters nor white space
        self.chunks = re.compile(
            rf"[ \n\t\r]*[{LETTERS}]++(?=[{sign} \n\t\r]|\Z)|[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+").findall
        self.one_word = re.compile(f" ?[{LETTERS}]+").fullmatch
        # letters and then signs; the apostrophe binds the letters after it
        self.signed = re.compile(rf"([{LETTERS}]+)([!-&(-/:-@\[-`{{-~]+)").fullmatch
        self.young = _Chunks(self._chunk, {})
        self.words = _Chunks(self._word, {})
        # pre-tokens of ASCII words: the first takes the blank, later ones may be contractions
        runs = r"[A-Za-z]+|[0-9]+|[!-/:-@\[-`{-~]+"
        self.first = re.compile(runs).match
        self.rest = re.compile(f"'(?:[stmd]|re|ve|ll)|{runs}").findall
        self.bare = _Chunks(self._bare, {})
        # a full stop or comma that is not the first sign after a word
        self.unclear = re.compile(rf"[.,](?<![{LETTERS}0-9][.,])").search

    def _pack(self, ids: list[int]) -> bytes:
        one = self.packed
        return b"".join([one[i] for i in ids])

    def _letters(self, word: str, blank: str) -> bytes:
        """Letters alone are one pre-token, with the blank before them."""
        if not word.isascii():
            word = "".join([SIGNS[b] for b in word.encode("utf-8")])
        return self._pack([t.id for t in self.model(blank + word)])

    def _chunk(self, chunk: str) -> bytes:
        if self.one_word(chunk):
            blank = BYTE_SIGNS[32] if chunk[0] == " " else ""
            return self._letters(chunk.lstrip(" "), blank)
        return self._pack(self.whole.encode(chunk, add_special_tokens=False).ids)

    def _bare(self, piece: str) -> bytes:
        """One pre-token of printable ASCII characters."""
        return self._pack([t.id for t in self.model(piece)])

    def _word(self, word: str) -> bytes:
        """A word and the blank before it."""
        if word[:1] == "\x00":  # split off a word: no blank before it
            return self._chunk(word[1:])
        if word.isascii():
            if word.isalpha():
                return self._letters(word, BYTE_SIGNS[32])
            first = self.first(word)
            if first:
                if first.end() == len(word):
                    return self._bare(BYTE_SIGNS[32] + word)
                rest = self.rest(word, first.end())
                if sum(map(len, rest)) == len(word) - first.end():  # printable throughout
                    return self.words[first[0]] + b"".join([self.bare[p] for p in rest])
        else:
            parts = self.signed(word)
            if parts:
                return self.words[parts[1]] + self.bare[parts[2]]
        return self._chunk(" " + word)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as ``kind``."""
        known, spaced, out = self.young, self.words.__getitem__, []
        for t in texts:
            if self.odd_space(t) or any(a in t for a in self.added):
                ids = self.whole.encode(t, add_special_tokens=False).ids
                out.append(np.array(ids, dtype=self.kind).tobytes())
            elif "  " in t or "\x00" in t or len(t) > RUN_CHARS:
                out.append(b"".join([known[c] for c in self.chunks(t)]))
            elif t:
                if not self.unclear(t):
                    t = t.replace(".", " \x00.").replace(",", " \x00,")
                words = t.split(" ")
                first = words.pop(0)
                tail = " " if words and not words[-1] else ""  # a blank at the end stands alone
                if tail:
                    words.pop()
                out.append(b"".join([known[first] if first else b"", *map(spaced, words),
                                     known[tail] if tail else b""]))
            else:
                out.append(b"")
        for name in ("young", "words", "bare"):
            cache = getattr(self, name)
            if len(cache) > CACHE_CHUNKS:
                setattr(self, name, cache.next())
        return out


_ENCODERS: dict[str, ByteEncoder] = {}


def loaded(tokenizer_file: str) -> ByteEncoder:
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = ByteEncoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


class WaveletMatrix:
    """A sequence of ids as bit-planes with rank directories."""

    def __init__(self, n: int, bits: int, zeros: list[int], planes: list[np.ndarray],
                 ranks: list[np.ndarray], header: dict | None = None, blobs: list[bytes] = ()):
        self.n, self.bits, self.zeros, self.planes, self.ranks = n, bits, zeros, planes, ranks
        self.header, self._blobs = header or {}, blobs

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> "WaveletMatrix":
        cur = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        zeros, planes, ranks = [], [], []
        for level in range(bits - 1, -1, -1):
            one = cur & cur.dtype.type(1 << level) != 0
            packed = np.packbits(one)
            planes.append(packed)
            ranks.append(_directory(packed))
            low = cur[~one]
            zeros.append(len(low))
            cur = np.concatenate([low, cur[one]])
        return cls(len(ids), bits, zeros, planes, ranks)

    def to_bytes(self, doc_ids: list[int | None], lengths: list[int], **extra) -> bytes:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        blobs = [pack(np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()),
                 pack(np.packbits([d is None for d in doc_ids]).tobytes()),
                 pack(np.array(lengths, dtype="<i8").tobytes())]
        for plane, rank in zip(self.planes, self.ranks):
            blobs += [pack(plane.tobytes()), pack(rank.astype("<u4").tobytes())]
        head = json.dumps({"n": self.n, "bits": self.bits, "zeros": self.zeros, "docs": len(doc_ids),
                           "blobs": [len(b) for b in blobs], **extra}).encode()
        return b"".join([MAGIC, struct.pack("<I", len(head)), head, *blobs])

    @classmethod
    def from_bytes(cls, data: bytes) -> "WaveletMatrix":
        import zstandard

        if data[:4] != MAGIC:
            raise ValueError("not a wavelet-matrix file")
        size, = struct.unpack_from("<I", data, 4)
        head = json.loads(data[8:8 + size])
        at, blobs = 8 + size, []
        unpack = zstandard.ZstdDecompressor().decompress
        for length in head["blobs"]:
            blobs.append(unpack(data[at:at + length]))
            at += length
        return cls(head["n"], head["bits"], head["zeros"],
                   [np.frombuffer(b, np.uint8) for b in blobs[3::2]],
                   [np.frombuffer(b, "<u4") for b in blobs[4::2]], head, blobs[:3])

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Document ids and lengths in file order."""
        ids = np.frombuffer(self._blobs[0], "<i8")
        null = np.unpackbits(np.frombuffer(self._blobs[1], np.uint8))[:len(ids)]
        return ([None if z else int(d) for d, z in zip(ids, null)],
                np.frombuffer(self._blobs[2], "<i8"))

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i >> 3]) >> (7 - (i & 7)) & 1

    def _ones(self, k: int, i: int) -> int:
        """Ones of plane k before position i."""
        block = i // BLOCK_BITS
        raw = self.planes[k][block * BLOCK_BITS // 8:(i + 7) // 8]
        bits = np.unpackbits(raw)[:i - block * BLOCK_BITS]
        return int(self.ranks[k][block]) + int(bits.sum())

    def _find(self, k: int, bit: int, j: int) -> int:
        """Position of the j-th (from 0) ``bit`` of plane k."""
        before = self.ranks[k].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = int(np.searchsorted(before, j, side="right")) - 1
        raw = self.planes[k][block * BLOCK_BITS // 8:(block + 1) * BLOCK_BITS // 8]
        at = np.flatnonzero(np.unpackbits(raw) == bit)
        return block * BLOCK_BITS + int(at[j - int(before[block])])

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k in range(self.bits):
            bit = self._bit(k, i)
            out = out << 1 | bit
            ones = self._ones(k, i)
            i = self.zeros[k] + ones if bit else i - ones
        return out

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the occurrences of token before position i lie below the last plane."""
        a, b = 0, min(max(i, 0), self.n)
        if token < 0 or token >> self.bits:
            return 0, 0
        for k in range(self.bits):
            one_a, one_b = self._ones(k, a), self._ones(k, b)
            if token >> (self.bits - 1 - k) & 1:
                a, b = self.zeros[k] + one_a, self.zeros[k] + one_b
            else:
                a, b = a - one_a, b - one_b
        return a, b

    def rank(self, token: int, i: int) -> int:
        """Occurrences of token before position i."""
        a, b = self._range(token, i)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, j: int) -> int:
        """Position of the j-th (from 0) occurrence of token."""
        a, b = self._range(token, self.n)
        if not 0 <= j < b - a:
            raise IndexError(j)
        i = a + j
        for k in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - k) & 1
            i = self._find(k, bit, i - self.zeros[k] if bit else i)
        return i

    def positions(self, token: int) -> list[int]:
        return [self.select(token, j) for j in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All ids, the planes undone from the last to the first."""
        cur = np.zeros(self.n, dtype=np.uint16 if self.bits <= 16 else np.uint32)
        for k in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[k])[:self.n].view(bool)
            up = np.empty_like(cur)
            up[~one] = cur[:self.zeros[k]]
            up[one] = cur[self.zeros[k]:] | up.dtype.type(1 << (self.bits - 1 - k))
            cur = up
        return cur


def _directory(packed: np.ndarray) -> np.ndarray:
    """Ones before each block, and before the end."""
    step = BLOCK_BITS // 8
    ones = np.bitwise_count(packed).astype(np.uint32)
    ones = np.pad(ones, (0, -len(ones) % step + step)).reshape(-1, step).sum(1, dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(ones, dtype=np.uint32)[:-1]]).astype(np.uint32)


def written(docs: DataFrame, tokenizer_file: str, end_id: int, id_col: str = "doc_id",
            text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Write the shard files below ``folder`` (default: a fresh one in the
    shared folder) and return their manifest, ``part, shard, path, docs,
    tokens``.  The files are written once, here."""
    spark = docs.sparkSession
    folder = as_uri(folder or scratch_path(spark, "llm-wavelet"))
    parts = n_tasks(docs)
    cuts = docs.select(F.percentile_approx(
        F.col(id_col).cast("long"), [i / parts for i in range(1, parts)] or [0.5], 20 * parts)
        .alias("c")).first()["c"]
    bounds = np.array(sorted(set(cuts or [])), dtype=np.int64)

    def encode(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        from lampwatch.llm.pieces import runs
        from lampwatch.llm.wavelet import RUN_CHARS, loaded
        encoder = loaded(tokenizer_file)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in runs(texts, RUN_CHARS):
                key = b.column(0).slice(lo, hi - lo)
                ids = encoder.encode(texts[lo:hi])
                end = np.array([end_id], dtype=encoder.kind).tobytes()
                part = np.searchsorted(bounds, pc.fill_null(key, np.iinfo(np.int64).min).to_numpy(), side="left")
                yield pa.RecordBatch.from_arrays(
                    [key, pa.array(part.astype(np.int32)),
                     pa.array([x + end for x in ids], pa.binary())],
                    names=["doc_id", "part", "ids"])

    def write(batches):
        import numpy as np
        import pyarrow as pa

        from lampwatch.llm.wavelet import SHARD_TOKENS, WaveletMatrix, loaded
        encoder = loaded(tokenizer_file)
        bits, kind = encoder.bits, encoder.kind
        part, shard, base, docs_, arrays, held = None, 0, 0, [], [], 0

        def flush():
            nonlocal shard, base, docs_, arrays, held
            ids = np.concatenate(arrays)
            data = WaveletMatrix.build(ids, bits).to_bytes(
                docs_, [len(a) for a in arrays], part=part, shard=shard, base=base)
            path = write_atomic(folder, f"part-{part:06d}-{shard:06d}.wmx", data)
            row = [[part], [shard], [path], [len(docs_)], [held]]
            shard, base, docs_, arrays, held = shard + 1, base + held, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()])],
                names=["part", "shard", "path", "docs", "tokens"])

        for b in batches:
            for d, p, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if p != part:
                    if docs_:
                        yield flush()
                    part, shard, base = p, 0, 0
                ids = np.frombuffer(raw.as_buffer(), kind)
                if docs_ and held + len(ids) > SHARD_TOKENS:
                    yield flush()
                docs_.append(d)
                arrays.append(ids)
                held += len(ids)
        if docs_:
            yield flush()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    ids = slim.mapInArrow(encode, "doc_id long, part int, ids binary")
    placed = (ids.repartitionById(parts, F.col("part"))
              .sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), F.length("ids"), "ids"))
    manifest = placed.mapInArrow(write, "part int, shard int, path string, docs long, tokens long")
    out = scratch_path(spark, "llm-wavelet-manifest")
    manifest.write.parquet(out)
    return spark.read.schema(manifest.schema).parquet(out)


def read_back(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per stored document, from the
    files alone; ``start`` counts the ids of all documents before it."""
    spark = manifest.sparkSession
    head = manifest.select("path").first()
    if head is None:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def read(batches):
        import numpy as np
        import pyarrow as pa

        from lampwatch.llm.wavelet import WaveletMatrix
        for b in batches:
            for raw in b.column(0):
                m = WaveletMatrix.from_bytes(raw.as_buffer().to_pybytes())
                ids, lengths = m.documents()
                tokens = m.tokens().astype("<u4")
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(tokens[e - n:e].data) for e, n in zip(ends, lengths)]
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([m.header["part"]] * n, pa.int32()),
                     pa.array(m.header["base"] + ends - lengths, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "part", "within", "n_tokens", "ids_crc32"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.wmx")
             .load(head["path"].rpartition("/")[0]).select("content"))
    docs = files.mapInArrow(read, "doc_id long, part int, within long, n_tokens long, ids_crc32 long")
    # one row per range partition: as many as reduce tasks, whatever the input's size
    totals = {r["part"]: r["t"] for r in manifest.groupBy("part").agg(F.sum("tokens").alias("t")).collect()}
    before, run = {}, 0
    for p in sorted(totals):
        before[p] = run
        run += totals[p]
    start = spark.createDataFrame(list(before.items()), "part int, before long")
    return docs.join(F.broadcast(start), "part").select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
