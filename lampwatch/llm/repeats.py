"""Removal of repeated passages behind a count-min prefilter (operator 3).

A window is ``WINDOW`` consecutive words of one document; every word covered
by a window whose word sequence also starts in a document with a smaller id
is removed.  Windows are judged on the input.

1. *Sketch.*  Each task hashes the windows of its documents and keeps partial
   count-min sketches of two rows.  Counters saturate at two, which is all
   the question "more than once?" needs, and travel as gap-coded, compressed
   cell lists per stripe of the sketch.  Stripes are merged one at a time
   from sorted partials, so a merging task holds one stripe; the result is
   one bit per cell, "estimated repeated".
2. *Exact pass.*  The merged bits are broadcast: at most ``MAX_CELLS`` cells a
   row, 128 MB for both rows, whatever the input's size.  A window whose two
   cells are not both set occurs once and is dropped where it is read; the
   sketch only overestimates, so no repeated window is lost.  The others get
   a 96-bit digest of their words and are grouped exactly.  Each task first
   combines: of the documents it holds with a window, only the smallest goes
   on, the others are already decided.  A passage in a third of all
   documents so reaches its group once per task.
3. The decided positions meet the texts in one join by document, where words
   are struck out.

The sketch has four cells per expected window up to ``MAX_CELLS``: about one
window in twenty that occurs once then passes.  With more windows per cell
more pass (all, in the end); the exact pass then shuffles them, in proportion
to the input, and results stay exact.  ``MAX_CELLS`` may grow with executor
memory.

Null texts have no words.  Ids: null sorts after all ids and is never a
smaller id; rows that share an id are told apart by their text, and are no
smaller documents for each other.  Documents shorter than a window keep all
words.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lampwatch.llm.common import n_tasks, stage

WINDOW = 13
CELLS_PER_WINDOW = 4
#: most cells of a sketch row (two rows, one broadcast bit each)
MAX_CELLS = 1 << 29
STRIPE_CELLS = 1 << 22
#: windows per partial sketch, and candidate windows combined at a time
PARTIAL_WINDOWS = 1 << 21
COMBINED_WINDOWS = 1 << 19
RUN_CHARS = 1_500_000
#: bits kept of a digest's second half: 96 in all, at which 10^13 different
#: windows are expected to hold 0.001 pairs that share one
DIGEST_LOW = (1 << 32) - 1
#: stands for a null id
LAST_ID = (1 << 63) - 1


def window_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of every window of ``words``."""
    from xxhash import xxh64_intdigest

    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.array(list(map(xxh64_intdigest, words)), dtype=np.uint64)
    out = np.zeros(n, np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)  # odd: each place weighs a word differently
    for k in range(WINDOW):
        out *= step
        out += h[k:k + n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def cells_of(hashes: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each hash in the two rows (``cells``: a power of two)."""
    high = hashes >> np.uint64(64 - cells.bit_length() + 1)
    low = hashes & np.uint64(cells - 1)
    return high.astype(np.uint32), low.astype(np.uint32)


def packed(cells: np.ndarray) -> bytes:
    """Rising cells as compressed gaps."""
    import zstandard

    gaps = np.diff(cells, prepend=np.uint32(0))
    kind = np.uint16 if not len(gaps) or gaps.max() < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(
        gaps.astype(kind).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data[1:])
    return np.cumsum(np.frombuffer(raw, np.uint16 if data[0] == 2 else np.uint32), dtype=np.int64)


def partial_sketch(hashes: list[np.ndarray], cells: int):
    """``row, stripe, once, twice`` of a partial sketch: the cells met, and
    those met more than once."""
    span = min(cells, STRIPE_CELLS)
    for row, cell in enumerate(cells_of(np.concatenate(hashes), cells)):
        cell.sort()
        first = np.concatenate([[True], cell[1:] != cell[:-1]])
        once = cell[first]
        twice = np.unique(cell[~first])
        edge = np.arange(0, cells + 1, span)
        a, b = np.searchsorted(once, edge), np.searchsorted(twice, edge)
        for s in range(len(edge) - 1):
            if a[s] < a[s + 1]:
                base = np.uint32(edge[s])
                yield (row, s, packed(once[a[s]:a[s + 1]] - base), packed(twice[b[s]:b[s + 1]] - base))


def repeated_bits(docs: DataFrame, cells: int) -> np.ndarray:
    """The merged sketch: two rows of ``cells`` bits, packed."""
    span = min(cells, STRIPE_CELLS)

    def sketch(batches):
        import pyarrow as pa

        from lampwatch.llm.pieces import runs
        from lampwatch.llm.repeats import PARTIAL_WINDOWS, RUN_CHARS, WINDOW, partial_sketch, window_hashes
        held, n = [], 0

        def rows():
            cols = list(zip(*partial_sketch(held, cells)))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.int32(), pa.binary(), pa.binary()])],
                names=["row", "stripe", "once", "twice"])

        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in runs(texts, RUN_CHARS):
                for t in texts[lo:hi]:
                    words = t.encode("utf-8", "surrogatepass").split()
                    if len(words) >= WINDOW:
                        held.append(window_hashes(words))
                        n += len(held[-1])
                if n >= PARTIAL_WINDOWS:
                    yield rows()
                    held, n = [], 0
        if n:
            yield rows()

    def merge(batches):
        import numpy as np
        import pyarrow as pa

        from lampwatch.llm.repeats import unpacked
        key, once, twice = None, None, None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                 pa.array([np.packbits(twice).tobytes()], pa.binary())], names=["row", "stripe", "bits"])

        for b in batches:
            for r, s, o, t in zip(*(b.column(i) for i in range(4))):
                if (r.as_py(), s.as_py()) != key:
                    if key:
                        yield row()
                    key = r.as_py(), s.as_py()
                    once, twice = np.zeros(span, bool), np.zeros(span, bool)
                cell = unpacked(o.as_py())
                twice[cell[once[cell]]] = True
                once[cell] = True
                twice[unpacked(t.as_py())] = True
        if key:
            yield row()

    part = docs.mapInArrow(sketch, "row int, stripe int, once binary, twice binary")
    merged = stage(part.repartition(n_tasks(docs), "row", "stripe").sortWithinPartitions("row", "stripe")
                   .mapInArrow(merge, "row int, stripe int, bits binary"), "repeats-sketch")
    bits = np.zeros((2, max(1, cells // 8)), np.uint8)
    for r in merged.toLocalIterator():
        at = r["stripe"] * span // 8
        bits[r["row"], at:at + span // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def combined(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, tag: np.ndarray, place: np.ndarray):
    """Rows to group: one per window of the smallest document that this task
    holds with it, and one per run of consecutive windows that are already
    decided, because a smaller document here holds them.  A run has its
    length for ``h2``, scattered bits for ``h1`` and its place inverted
    (negative).  Rows keep the order of the documents, whose ids and places
    then compress well in the shuffle."""
    order = np.lexsort((doc, h2, h1))
    new = np.concatenate([[True], (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)])
    least = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
    decided = np.empty(len(doc), bool)
    decided[order] = doc[order] > least
    d, t, at = doc[decided], tag[decided], place[decided]
    order = np.lexsort((at, t, d))
    d, t, at = d[order], t[order], at[order]
    first = np.flatnonzero(np.concatenate(
        [np.ones(min(1, len(d)), bool),
         (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (at[1:] != at[:-1] + 1)]))
    length = np.diff(np.append(first, len(d)))
    d, t, at = d[first], t[first], at[first]
    scatter = (d * np.int64(-7046029254386353131)) ^ (at * np.int64(0x2545F4914F6CDD1D))
    rest = ~decided
    return (np.concatenate([h1[rest], scatter]), np.concatenate([h2[rest], length]),
            np.concatenate([doc[rest], d]), np.concatenate([tag[rest], t]),
            np.concatenate([place[rest], ~at]))


def candidates(docs: DataFrame, bits: np.ndarray, cells: int) -> DataFrame:
    """Windows estimated repeated, as ``combined`` leaves them.  A place is the
    text's CRC-32 but its top bit (upper half) and the window's first word;
    with the 64-bit ``tag`` it tells texts of one id apart by 95 bits."""
    import zstandard

    # few bits are set: the broadcast is a fraction of the sketch
    shared = docs.sparkSession.sparkContext.broadcast(
        zstandard.ZstdCompressor(level=1).compress(bits.reshape(-1).data))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import zstandard
        from xxhash import xxh3_64_intdigest, xxh3_128_digest

        from lampwatch.llm.repeats import (COMBINED_WINDOWS, DIGEST_LOW, LAST_ID, WINDOW, cells_of,
                                           combined, window_hashes)
        table = np.frombuffer(zstandard.ZstdDecompressor().decompress(shared.value),
                              np.uint8).reshape(2, -1)
        digests, docs_, tags, places = [], [], [], []
        held = 0

        def rows():
            raw = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            cols = combined(raw[:, 0], raw[:, 1] & DIGEST_LOW, np.concatenate(docs_), np.concatenate(tags),
                            np.concatenate(places))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                              names=["h1", "h2", "doc_id", "tag", "place"])

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                words = raw.split()
                if len(words) < WINDOW:
                    continue
                a, c = cells_of(window_hashes(words), cells)
                hit = ((table[0][a >> 3] >> (7 - (a & 7)).astype(np.uint8))
                       & (table[1][c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1)
                at = np.flatnonzero(hit)
                if not len(at):
                    continue
                digests.append(b"".join([xxh3_128_digest(b" ".join(words[i:i + WINDOW]))
                                         for i in at.tolist()]))
                docs_.append(np.full(len(at), LAST_ID if key is None else key, np.int64))
                tags.append(np.full(len(at), xxh3_64_intdigest(raw), np.uint64).view(np.int64))
                places.append(at + ((zlib.crc32(raw) & 0x7FFFFFFF) << 32))
                held += len(at)
                if held >= COMBINED_WINDOWS:
                    yield rows()
                    digests, docs_, tags, places, held = [], [], [], [], 0
        if held:
            yield rows()

    return docs.mapInArrow(run, "h1 long, h2 long, doc_id long, tag long, place long")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    texts: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256``, and
    with ``texts`` the ``kept`` words joined by blanks."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chars = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    expected = max(1, chars // 6)
    cells = min(MAX_CELLS, max(1 << 16, 1 << (CELLS_PER_WINDOW * expected - 1).bit_length()))
    found = candidates(slim, repeated_bits(slim, cells), cells)
    least = F.min("doc_id").over(Window.partitionBy("h1", "h2"))
    run = F.col("place") < 0
    place = F.when(run, F.bitwise_not("place")).otherwise(F.col("place"))
    struck = (found.withColumn("least", least).where(run | (F.col("doc_id") > F.col("least")))
              .select(F.col("doc_id").alias("key"), "tag", F.shiftright(place, 32).alias("crc"),
                      (F.shiftleft(place.bitwiseAND(F.lit(0x7FFFFFFF)), 31)
                       + F.when(run, F.col("h2")).otherwise(F.lit(1))).alias("place"))
              .groupBy("key", "tag", "crc").agg(F.collect_list("place").alias("places")))

    def pack(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import zstandard
        from xxhash import xxh3_64_intdigest
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            raw = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in b.column(1)]
            tags = np.array([xxh3_64_intdigest(r) for r in raw], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pc.fill_null(b.column(0), LAST_ID), pa.array(tags),
                 pa.array([zlib.crc32(r) & 0x7FFFFFFF for r in raw], pa.int64()),
                 b.column(0), pa.array([squeeze(r) for r in raw], pa.binary())],
                names=["key", "tag", "crc", "doc_id", "text"])

    # texts travel compressed: they are the largest part of what the join shuffles
    whole = slim.mapInArrow(pack, "key long, tag long, crc long, doc_id long, text binary")
    joined = whole.join(struck, ["key", "tag", "crc"], "left")

    def strike(batches):
        import numpy as np
        import pyarrow as pa
        import zstandard

        from lampwatch.llm.repeats import WINDOW
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for text, places in zip(b.column(1), b.column(2)):
                words = unpack(text.as_py()).split()
                kept = words
                if places.is_valid:
                    at = places.values.to_numpy(zero_copy_only=False)
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, at >> 31, 1)
                    np.add.at(edge, (at >> 31) + (at & 0x7FFFFFFF) - 1 + WINDOW, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                joined = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(),
                            joined.decode("utf-8", "surrogatepass") if texts else None))
            cols = list(zip(*out)) or [()] * 4
            arrays = [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                      pa.array(cols[2], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                arrays.append(pa.array(cols[3], pa.string()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.select("doc_id", "text", "places").mapInArrow(
        strike, "doc_id long, n_words long, n_removed long, kept_sha256 string"
                + (", kept string" if texts else ""))
