"""Removal of repeated substrings by a column-wise multi-document suffix order.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with
a smaller id.  Every window of that length holds one minimizer (the leftmost smallest
hashed k-mer inside it), equal windows hold equal ones at equal places, so windows can be
dealt out by minimizer and never miss each other:

1. documents send the hashes of their minimizers, packed by bucket of hash; a bucket
   answers which of them occur in more than one document;
2. documents cut out the runs of windows of those minimizers, as pieces of at most
   2 * LENGTH bytes aligned at the minimizer; of equal pieces in a batch only the smallest
   document's travel, for the others' windows all repeat.  Windows of a minimizer that very
   many documents share are pieces of their own, dealt by all their bytes;
3. each bucket of pieces builds its collection's Burrows-Wheeler transform and common
   prefixes column by column from the right: every round inserts one symbol of each
   piece.  The symbols before the sorted suffixes are the transform of the round; sorting
   the suffixes stably by it gives the order of the next, and common prefixes follow from
   those between the places of equal symbols.  Columns, order and common prefixes are
   files (in memory while small), read and written once a round, in blocks and in order.
   Neighbours that share ``LENGTH`` symbols hold the same window; the smallest document
   id of each such group decides.

Rounds are bounded by the piece length, not by the longest document, because suffixes
are only ever compared over one window.
"""

from __future__ import annotations

import contextlib
import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import lean, materialise, small_batches

#: Bytes of a string that counts as repeated, and of a minimizer.
LENGTH, K = 50, 16
#: A byte that UTF-8 never holds; it parts documents and fills short pieces.
GAP = 0xFF
#: Bytes of text handled at once.
BLOCK = 1 << 19
#: Bytes of all texts for each bucket of hashes, and of pieces.
HASHES, PIECES = 16 << 20, 1 << 20
#: Windows that can share a minimizer, and columns of a piece around it.
SPAN = LENGTH - K + 1
COLUMNS = 2 * LENGTH - K
#: Documents that share a minimizer before its windows are dealt one by one; pieces handled at once.
HOT, CHUNK = 1 << 15, 1 << 14
#: Suffixes of a block of the column files, and bytes of a file that stay in memory.
ROWS, SPOOL = 1 << 16, 4 << 20
#: Bits of a place in a text; above them the number of the text among those of its id.
PLACE = 40

_BASE = 0x100000001B3


def kmer_hashes(block: np.ndarray, k: int = K) -> np.ndarray:
    """A 64-bit hash of the ``k`` bytes that start at each place; ``k`` a power of two."""
    h, size = block.astype(np.uint64) + np.uint64(1), 1
    while size < k:
        h = h[: len(h) - size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_minima(v: np.ndarray, width: int, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """The smallest value of each ``width`` neighbours, and the leftmost place that holds it."""
    m, at, size = v, np.arange(len(v), dtype=np.int32) if places else None, 1
    while size < width:
        step = min(size, width - size)
        left, right = m[: len(m) - step], m[step:]
        if places:
            at = np.where(right < left, at[step:], at[: len(at) - step])
        m = np.minimum(left, right)
        size += step
    return m, at


def blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined into blocks: (bytes, row of each segment, its start in the block, its start in its text).

    A long text is cut into segments that overlap by ``LENGTH`` - 1 bytes, so each of
    its windows is in exactly one of them.
    """
    part: list[bytes] = []
    row: list[int] = []
    start: list[int] = []
    origin: list[int] = []
    size = 0

    def made():
        return np.frombuffer(bytes([GAP]).join(part), np.uint8), np.array(row), np.array(start), np.array(origin)

    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), BLOCK):
            piece = text[at : at + BLOCK + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            if size and size + len(piece) > BLOCK + LENGTH:
                yield made()
                part, row, start, origin, size = [], [], [], [], 0
            row.append(i), start.append(size), origin.append(at), part.append(piece)
            size += len(piece) + 1
    if part:
        yield made()


def windows(block: np.ndarray, start: np.ndarray, places: bool = False, hashes: np.ndarray | None = None):
    """Start of each whole window, its segment, its minimizer's hash and place."""
    m, at = window_minima(kmer_hashes(block) if hashes is None else hashes, SPAN, places)
    ends = np.append(start[1:] - 1, len(block))
    count = ends - start - LENGTH + 1
    segment = np.repeat(np.arange(len(start)), count)
    w = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count) + start[segment]
    return w, segment, m[w], at[w] if places else None


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.diff(values, prepend=0).astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(raw).view(np.int64).ravel())


def zipped(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their text compressed, for a shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield batch.assign(**{text: pd.Series([None if t is None else packer.compress(t.encode("utf-8")) for t in batch[text]], index=batch.index, dtype=object)})

    schema = T.StructType([T.StructField(text, T.BinaryType()) if f.name == text else f for f in docs.schema])
    return docs.mapInPandas(lean(run), schema)


def _unzip(data: bytes | None) -> bytes:
    return b"" if data is None else zstandard.ZstdDecompressor().decompress(data)


def _encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8")


def _shared_minimizers(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, hash) of minimizers that occur in more than one document; ~hash if in more than ``HOT``."""
    hot = HOT

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.sort_values("doc_id").drop_duplicates("text")  # of equal texts the smallest id can have something kept
            ids = batch["doc_id"].to_numpy(np.int64)
            hashes, owners = [], []
            for block, row, start, _ in blocks([_encode(t) for t in batch["text"]]):
                _, segment, m, _ = windows(block, start)
                new = np.concatenate([[True], (m[1:] != m[:-1]) | (segment[1:] != segment[:-1])])
                hashes.append(m[new])
                owners.append(ids[row[segment[new]]])
            if not hashes:
                continue
            h, d = np.concatenate(hashes), np.concatenate(owners)
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            h, d, bucket = h[order] // np.uint64(buckets), d[order], bucket[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(first[1:], len(bucket))
            low = h.view(np.uint8).reshape(-1, 8)[:, :5]  # 40 bits beside the bucket's
            yield pd.DataFrame({"bucket": bucket[first], "hashes": [low[a:b].tobytes() for a, b in zip(first, ends, strict=True)], "owners": [_pack(d[a:b]) for a, b in zip(first, ends, strict=True)]})

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        raw = np.frombuffer(b"".join(group["hashes"]), np.uint8).reshape(-1, 5)
        h = np.zeros((len(raw), 8), np.uint8)
        h[:, :5] = raw
        h = h.view(np.int64).ravel()
        d = np.concatenate([_unpack(x) for x in group["owners"]])
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        last = np.append(first[1:], len(h)) - 1
        shared = np.repeat(d[first] != d[last], last - first + 1)
        fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
        keep = shared & fresh
        many = np.repeat(np.add.reduceat(fresh.astype(np.int64), first) > hot, last - first + 1)
        folded = h * buckets + group["bucket"].iloc[0]
        return pd.DataFrame({"doc_id": d[keep], "hash": np.where(many, ~folded, folded)[keep]})

    sent = docs.select("doc_id", "text").mapInPandas(lean(send), "bucket long, hashes binary, owners binary")
    return sent.groupBy("bucket").applyInPandas(answer, "doc_id long, hash long")


def _folded(h: np.ndarray, buckets: int) -> np.ndarray:
    """The part of a hash that buckets know: its bucket and 40 bits."""
    n = np.uint64(buckets)
    return ((h // n) & np.uint64((1 << 40) - 1)).astype(np.int64) * buckets + (h % n).astype(np.int64)


def _cut(docs: DataFrame, shared: DataFrame, buckets: int, deals: int) -> DataFrame:
    """Pieces for runs of windows of shared minimizers, packed by ``deal``, a hash of the minimizer.

    Each row holds many pieces: owners, starts, sizes, leads (bytes before the minimizer),
    and their joined bytes, compressed.  A negative ``deal`` has pieces without bytes, all of
    whose windows start in a smaller document of the same batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids = batch["doc_id"].to_numpy(np.int64)
            shift = batch["nth"].to_numpy(np.int64) << PLACE
            wanted = [np.asarray(x, np.int64) for x in batch["hashes"]]
            hot = [~x[x < 0] for x in wanted]
            wanted = [np.where(x < 0, ~x, x) for x in wanted]
            held: list[tuple[np.ndarray, ...]] = []
            for block, row, start, origin in blocks([_unzip(t) for t in batch["text"]]):
                v = kmer_hashes(block)
                w, segment, m, at = windows(block, start, places=True, hashes=v)
                first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (segment[1:] != segment[:-1])]))
                last = np.append(first[1:], len(w)) - 1
                seg, folded = segment[first], _folded(m[first], buckets)
                # look each run up among the hashes of its own document
                edge = np.searchsorted(seg, np.arange(len(row) + 1))
                keep = np.concatenate([np.isin(folded[edge[s] : edge[s + 1]], wanted[r]) for s, r in enumerate(row)])
                first, last, seg, folded = first[keep], last[keep], seg[keep], folded[keep]
                many = np.zeros(len(first), bool)
                if any(map(len, hot)):
                    edge = np.searchsorted(seg, np.arange(len(row) + 1))
                    many = np.concatenate([np.isin(folded[edge[s] : edge[s + 1]], hot[r]) for s, r in enumerate(row)])
                    count = np.where(many, last - first + 1, 1)  # a piece for each window
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    first, last, seg, folded, many = (np.repeat(x, count) for x in (first, last, seg, folded, many))
                    first = first + step
                    last = np.where(many, first, last)
                a, b = w[first], w[last] + LENGTH
                whole = _piece_hashes(v, a, b)
                deal = ((np.where(many, whole, folded.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)) % np.uint64(deals)
                held.append((deal.astype(np.int64), ids[row[seg]], a - start[seg] + origin[seg] + shift[row[seg]], (b - a).astype(np.uint8), (at[first] - a).astype(np.uint8), _gather(block, a, b - a), whole))
            if not held:
                continue
            deal, owner, begin, size, lead = (np.concatenate([h[k] for h in held]) for k in range(5))
            raw, offset = np.concatenate([h[5] for h in held]), np.cumsum(size, dtype=np.int64) - size
            known = _later_copies(np.concatenate([h[6] for h in held]), deal, owner, size, lead, raw, offset)
            if known.any():
                yield pd.DataFrame(
                    {
                        "deal": [-1 - int(owner[known][0]) % deals],
                        "owners": [_pack(owner[known])],
                        "starts": [_pack(begin[known])],
                        "shape": [packer.compress(size[known].tobytes() + lead[known].tobytes())],
                        "bytes": [packer.compress(b"")],
                    }
                )
            order = np.argsort(deal, kind="stable")
            order = order[~known[order]]
            edges = np.flatnonzero(np.concatenate([[True], np.diff(deal[order]) != 0, [True]])) if len(order) else np.zeros(1, int)
            parts = [order[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)]
            yield pd.DataFrame(
                {
                    "deal": [int(deal[p[0]]) for p in parts],
                    "owners": [_pack(owner[p]) for p in parts],
                    "starts": [_pack(begin[p]) for p in parts],
                    "shape": [packer.compress(size[p].tobytes() + lead[p].tobytes()) for p in parts],
                    "bytes": [packer.compress(_gather(raw, offset[p], size[p].astype(np.int64)).tobytes()) for p in parts],
                }
            )

    asked = shared.groupBy("doc_id").agg(F.collect_list("hash").alias("hashes"))
    joined = zipped(docs).join(asked, "doc_id").select("doc_id", "nth", "text", "hashes")
    return joined.mapInPandas(lean(run), "deal long, owners binary, starts binary, shape binary, bytes binary")


def _piece_hashes(v: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of all bytes of each piece [a, b), from the hashes ``v`` of k-mers that cover it."""
    h = (b - a).astype(np.uint64)
    for k in range(0, COLUMNS, K):
        h = h * np.uint64(_BASE) + v[np.minimum(a + k, b - K)]
        h ^= h >> np.uint64(29)
    return h


def _later_copies(whole: np.ndarray, deal: np.ndarray, owner: np.ndarray, size: np.ndarray, lead: np.ndarray, raw: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Which pieces equal one of a smaller document, byte by byte and at the same minimizer."""
    order = np.lexsort((owner, whole))
    h = whole[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    head = order[np.repeat(first, np.diff(np.append(first, len(h))))]
    likely = (owner[head] < owner[order]) & (deal[head] == deal[order]) & (size[head] == size[order]) & (lead[head] == lead[order])
    x, y = order[likely], head[likely]
    found = np.zeros(len(whole), bool)
    for k in range(0, len(x), CHUNK):
        p, q = x[k : k + CHUNK], y[k : k + CHUNK]
        n = size[p].astype(np.int64)
        same = _gather(raw, offset[p], n) == _gather(raw, offset[q], n)
        found[p] = np.logical_and.reduceat(same, np.cumsum(n) - n)
    return found


def _gather(source: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The joined bytes of many slices."""
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)
    return source[at]


def _between(common: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The least value of ``common`` over each [start, stop], from a table of powers of two."""
    level = np.log2(stop - start + 1).astype(np.int64)  # exact below 2 ** 48
    table = [common]
    for k in range(int(level.max(initial=0))):
        last = table[-1]
        table.append(np.minimum(last, np.append(last[1 << k :], last[: 1 << k])))  # what wraps around is not read
    flat, n = np.concatenate(table), len(common)
    return np.minimum(flat[level * n + start], flat[level * n + stop + 1 - (1 << level)])


def insert_columns(matrix: np.ndarray, rows: int = ROWS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sort all pieces by their suffixes, one column a round from the right.

    Yields (column, order, common) from the first column at which a whole window fits:
    the pieces in the order of their suffixes from that column on, and how many symbols
    each shares with the one before it, at most ``LENGTH`` being told apart.
    """
    n, width = matrix.shape
    with contextlib.ExitStack() as stack:
        symbols, *files = (stack.enter_context(tempfile.SpooledTemporaryFile(max_size=SPOOL)) for _ in range(5))
        for c in reversed(range(width)):
            symbols.write(matrix[:, c].tobytes())
        del matrix
        symbols.seek(0)
        now, then = files[:2], files[2:]
        now[0].write(np.arange(n, dtype=np.int32).tobytes()), now[1].write(bytes(n))
        for c in reversed(range(width)):
            column = np.frombuffer(symbols.read(n), np.uint8)
            place = np.concatenate([[0], np.cumsum(np.bincount(column, minlength=256))])  # where each symbol's suffixes go
            since = np.full(256, -1, np.int16)  # least common prefix since a symbol was seen; -1: not yet
            for f in now:
                f.seek(0)
            for at in range(0, n, rows):
                order, common = np.frombuffer(now[0].read(4 * rows), np.int32), np.frombuffer(now[1].read(rows), np.uint8)
                transform = column[order]
                to = np.argsort(transform, kind="stable")
                ranked = transform[to]
                first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
                kinds, ends = ranked[first], np.append(first[1:], len(to))
                until, after = np.minimum.accumulate(common), np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(LENGTH))
                shared = np.empty(len(to), np.int16)
                again = np.ones(len(to), bool)
                again[first] = False
                again = np.flatnonzero(again)
                shared[again] = _between(common, to[again - 1] + 1, to[again])
                shared[first] = np.minimum(since[kinds], until[to[first]])  # -1 stays, and becomes 0
                fresh = np.minimum(shared + 1, LENGTH).astype(np.uint8)
                since = np.minimum(since, until[-1])
                since[kinds] = after[to[ends - 1] + 1]
                sorted_ = order[to]
                if n <= rows:
                    runs = [(0, n, 0)]
                else:
                    runs = zip(first.tolist(), ends.tolist(), place[kinds].tolist(), strict=True)
                for a, b, x in runs:
                    then[0].seek(4 * x), then[0].write(sorted_[a:b].tobytes())
                    then[1].seek(x), then[1].write(fresh[a:b].tobytes())
                place[kinds] += ends - first
            now, then = then, now
            if c + LENGTH <= width:
                for f in now:
                    f.seek(0)
                yield c, np.frombuffer(now[0].read(), np.int32), np.frombuffer(now[1].read(), np.uint8)


def _decide(group: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, start, windows): which windows of a piece start in a smaller document too, as bits.

    Only distinct pieces are sorted, each for the smallest of its documents.
    """
    ids, starts = (np.concatenate([_unpack(x) for x in group[c]]) for c in ("owners", "starts"))
    shape = [np.frombuffer(_unzip(x), np.uint8).reshape(2, -1) for x in group["shape"]]
    sizes, lead = np.concatenate(shape, axis=1).astype(np.int64)
    every = (np.int64(1) << (sizes - LENGTH + 1)) - 1
    if group["deal"].iloc[0] < 0:
        return pd.DataFrame({"doc_id": ids, "start": starts, "windows": every})
    raw = np.frombuffer(b"".join(map(_unzip, group["bytes"])), np.uint8)
    matrix = np.full((len(ids), COLUMNS), GAP, np.uint8)
    offset = np.cumsum(sizes) - sizes
    left = SPAN - 1 - lead  # the minimizer stands at column SPAN - 1
    for k in range(0, len(ids), CHUNK):
        n = sizes[k : k + CHUNK]
        at = np.repeat(np.arange(len(n)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        matrix[k + at, place + left[k + at]] = raw[offset[k] : offset[k] + n.sum()]
    del raw
    _, one, of = np.unique(matrix.view(np.dtype((np.void, COLUMNS))).ravel(), return_index=True, return_inverse=True)
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, of, ids)
    matrix = matrix[one]
    bits = np.where(ids > least[of], every, _repeats(matrix, least, left[one], sizes[one])[of])
    found = bits != 0
    return pd.DataFrame({"doc_id": ids[found], "start": starts[found], "windows": bits[found]})


def _repeats(matrix: np.ndarray, ids: np.ndarray, left: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each piece, the windows that a piece of a smaller document holds too, as bits."""
    bits = np.zeros(len(ids), np.int64)
    far = np.iinfo(np.int64).max
    for c, order, common in insert_columns(matrix):
        fits = (left <= c) & (c + LENGTH <= left + sizes)
        first = np.flatnonzero(np.concatenate([[True], common[1:] < LENGTH]))
        own = np.where(fits[order], ids[order], far)
        least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.append(first, len(order))))
        hit = order[least < own]
        bits[hit] |= np.int64(1) << (c - left[hit])
    return bits


def spans(starts: list[int], bits: list[int], size: int) -> np.ndarray:
    """Maximal runs [from, to) that the flagged windows cover, in order."""
    edge = np.zeros(size + 1, np.int32)
    s, b = np.asarray(starts, np.int64), np.asarray(bits, np.int64)
    for k in range(SPAN):
        at = s[(b >> k) & 1 == 1] + k
        at = at[at + LENGTH <= size]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + LENGTH, -1)
    cover = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
    turn = np.flatnonzero(np.diff(cover))
    return turn.reshape(-1, 2)


def _numbered(docs: DataFrame, keep: tuple[str, ...], doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows (keep, __id, __text, __nth), and (doc_id, nth, print, size) of those that can hold a repeat.

    ``nth`` numbers the different texts of an id that repeats, in order of their hashes; it
    is 0 for all others.
    """
    rows = docs.select(*keep, docs[doc_id].cast("long").alias("__id"), docs[text].alias("__text"))
    prints = rows.select(F.col("__id").alias("doc_id"), F.sha2("__text", 256).alias("print"), F.octet_length("__text").cast("long").alias("size"))
    prints = materialise(prints.where(F.col("doc_id").isNotNull() & (F.col("size") >= LENGTH)))
    several = prints.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high").select("doc_id")
    several = materialise(several)
    if several.isEmpty():
        return rows.withColumn("__nth", F.lit(0).cast("long")), prints.withColumn("nth", F.lit(0).cast("long"))
    among = prints.join(several, "doc_id", "left_semi").groupBy("doc_id", "print").agg(F.first("size").alias("size"))
    among = materialise(among.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id").orderBy("print")).cast("long") - 1).drop("size"))
    number = F.coalesce("nth", F.lit(0)).cast("long")
    own = among.select(F.col("doc_id").alias("__id"), F.col("print").alias("__print"), "nth")
    numbered = rows.withColumn("__print", F.sha2("__text", 256)).join(own, ["__id", "__print"], "left").select(*keep, "__id", "__text", number.alias("__nth"))
    return numbered, prints.join(among, ["doc_id", "print"], "left").select("doc_id", "print", "size", number.alias("nth"))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, nth, whole, starts, windows) of documents that hold a repeated string.

    ``whole``: the text equals that of a smaller id.  Else ``windows`` has the flagged
    windows from each of ``starts`` on, as bits; ``spans`` turns them into runs of bytes.
    ``nth`` tells the texts of one id apart (see ``strip_repeats`` for all other cases).
    """
    return _spans_of(*_numbered(docs, (), doc_id, text))


def _spans_of(rows: DataFrame, prints: DataFrame) -> DataFrame:
    named = rows.select(F.col("__id").alias("doc_id"), F.col("__text").alias("text"), F.col("__nth").alias("nth")).where(F.col("__id").isNotNull() & (F.octet_length("__text") >= LENGTH))
    total = prints.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("print", "least")
    copies = materialise(prints.join(materialise(least), "print").where("doc_id > least").select("doc_id", "nth").distinct())
    alone = copies.join(prints.where("nth > 0").select("doc_id").distinct(), "doc_id", "left_anti")  # no other text of that id is lost
    buckets = max(16, total // HASHES)
    shared = _shared_minimizers(named, buckets).join(alone.select("doc_id"), "doc_id", "left_anti")
    pieces = _cut(named, shared, buckets, max(16, total // PIECES))
    marks = pieces.groupBy("deal").applyInPandas(_decide, "doc_id long, start long, windows long")
    marks = marks.select("doc_id", F.shiftright("start", PLACE).alias("nth"), F.col("start").bitwiseAND(F.lit((1 << PLACE) - 1)).alias("start"), "windows")
    parts = marks.groupBy("doc_id", "nth").agg(F.collect_list("start").alias("starts"), F.collect_list("windows").alias("windows"))
    parts = parts.join(copies, ["doc_id", "nth"], "left_anti")
    none = F.array().cast("array<long>")
    return parts.select("doc_id", "nth", F.lit(False).alias("whole"), "starts", "windows").unionByName(copies.select("doc_id", "nth", F.lit(True).alias("whole"), none.alias("starts"), none.alias("windows")))


def strip_repeats(docs: DataFrame, outputs: tuple[str, ...] = ("kept",), doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Remove from every whole text the bytes that a repeated string covers.

    Returns ``keep`` and any of: kept (binary), kept_text (the kept bytes as text; a
    character that lost some of its bytes goes), kept_sha256, n_bytes, n_removed, n_spans.
    Strings are judged on the input.  Null texts count as empty; texts shorter than
    ``LENGTH`` bytes and rows with a null id stay whole.  Repeated rows, and rows that
    repeat an id with another text, do not shorten each other, for neither id is smaller.
    An empty table gives no rows; columns outside ``keep`` are not read.
    """
    small_batches(docs.sparkSession)
    kinds = {"kept": T.BinaryType(), "kept_text": T.StringType(), "kept_sha256": T.StringType(), "n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType()}
    schema = T.StructType([*[docs.schema[c] for c in keep], *[T.StructField(o, kinds[o]) for o in outputs]])
    numbered, prints = _numbered(docs, keep, doc_id, text)
    found = _spans_of(numbered, prints).withColumnsRenamed({"doc_id": "__id", "nth": "__nth", "whole": "__whole", "starts": "__starts", "windows": "__windows"})
    rows = zipped(numbered, "__text")
    both = rows.join(found, ["__id", "__nth"], "left").drop("__id", "__nth")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made: dict[str, list] = {o: [] for o in outputs}
            for value, whole, starts, bits in zip(batch["__text"], batch["__whole"], batch["__starts"], batch["__windows"], strict=True):
                raw = _unzip(value)
                if whole is True or whole == True:  # noqa: E712  numpy's own booleans too
                    cut = np.array([[0, len(raw)]])
                elif starts is None or not len(starts):
                    cut = np.zeros((0, 2), np.int64)
                else:
                    cut = spans(starts, bits, len(raw))
                edges = [0, *cut.ravel().tolist(), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                row = {"kept": kept, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(cut)}
                if "kept_text" in made:
                    row["kept_text"] = kept.decode("utf-8", "ignore")
                if "kept_sha256" in made:
                    row["kept_sha256"] = hashlib.sha256(kept).hexdigest()
                for o in outputs:
                    made[o].append(row[o])
            yield pd.DataFrame({c: batch[c] for c in keep} | {o: pd.Series(v, index=batch.index, dtype=object if isinstance(kinds[o], (T.StringType, T.BinaryType)) else "int64") for o, v in made.items()})

    return both.mapInPandas(lean(run), schema)
