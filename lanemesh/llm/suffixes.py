"""Exact removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if it lies in a string of `length` bytes that also starts earlier: in a document of a
smaller id, or before in the same one. Suffixes are brought together by anchors. Among the `K`-byte
strings inside a window of `length` bytes the one of least hash is its anchor, so equal windows have
equal anchors at equal places, and consecutive windows mostly share one. That gives three steps:

1. Hash all anchors (about one in 33 bytes) and find those that occur twice. Within a block of text
   equal anchors are combined first, so a frequent one costs one entry a block.
2. For these, gather the bytes of the windows around the anchor (a snippet). Equal snippets of a
   block are combined first. Anchors in very frequent cells are split by the bytes around them.
3. Sort the windows' suffixes of each anchor by mergesort. Two suffixes are compared by binary search
   for their common extension over prefix polynomial hashes. Neighbours that agree on all bytes are a
   class, whose bytes are compared as well; all but its first member are removed. Where bytes
   differ, the anchor's suffixes are sorted by their bytes instead.

Documents that are copies of an earlier one are recognised by length and SHA-256 and aren't sorted.

Defined cases: there is a row for each input row; a null text counts as empty; shorter texts than
`length` lose nothing; texts of any length are handled whole, in overlapping segments; rows that repeat
a doc_id and text are one document and come out alike; different texts of one doc_id follow each other
by their SHA-256, as if parts of one document that no window crosses; a row with a null doc_id counts as
one of the negative id -1 - x, with x the first 15 hexadecimal digits of its text's SHA-256, and keeps
its null; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import dropped, give_back, lean, materialized, small_batches, spread_join, text_or_empty

K = 36
#: Text handled at a time by a task of step 1; bytes hashed at a time; text bytes a task of steps 1 and 3.
BLOCK, SEGMENT, SHARE = 24 << 20, 1 << 16, 24 << 20
#: Cells that anchors are counted in, rows above which a cell is split by content, and windows a part.
CELLS, HOT_ROWS, STEP = 1 << 22, 100_000, 4
#: Positions of the k-th text of a doc_id begin at k << SLOT; a text has less than 2 ** 31 bytes.
SLOT = 32

_random = np.random.default_rng(77)
TABLE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SINGLE = np.dtype([("h", "<u8"), ("p", "<i8"), ("d", "<i8"), ("a", "u1"), ("b", "u1")])
HASH = np.dtype([("h", "<u8")])


class Powers:
    """Powers of the base and its inverse modulo 2**64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            ones = np.full(n, BASE), np.full(n, INVERSE)
            for x in ones:
                x[0] = 1
            self.up, self.down = (np.multiply.accumulate(x) for x in ones)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Entry i: sum of the codes of data[:i] times powers of the base."""
    up, _ = POWERS.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    out[1:] = TABLE[data]
    out[1:] *= up[: len(data)]
    return np.cumsum(out, out=out)


def window_anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start of `length` bytes, where its anchor begins; and the hashes of all K-byte strings."""
    prefix = prefix_hashes(data)
    _, down = POWERS.upto(len(data) + 1)
    h = mix((prefix[K:] - prefix[:-K]) * down[: len(data) - K + 1])
    width, least, at, have = length - K + 1, h, np.arange(len(h), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        right = least[step:] < least[:-step]
        at = np.where(right, at[step:], at[:-step])
        least = np.where(right, least[step:], least[:-step])
        have += step
    return at, h


def segments(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of about SEGMENT bytes of (document, offset, bytes); a window start is in exactly one."""
    group, held = [], 0
    for doc, text in enumerate(texts):
        for offset in range(0, max(len(text) - length + 1, 0), SEGMENT):
            part = text[offset : offset + SEGMENT + length - 1]
            group.append((doc, offset, part))
            held += len(part)
            if held >= SEGMENT:
                yield group
                group, held = [], 0
    if group:
        yield group


def anchors(texts: list[bytes], ids: np.ndarray, slots: np.ndarray, length: int) -> np.ndarray:
    """All anchors of `texts`: hash, place, document, and its windows' starts p - a to p - b."""
    found = []
    for group in segments(texts, length):
        data = np.frombuffer(b"".join(g[2] for g in group), np.uint8)
        sizes = np.array([len(g[2]) for g in group])
        begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        at, h = window_anchors(data, length)
        which = np.repeat(np.arange(len(group)), sizes)[: len(at)]
        starts = np.flatnonzero(np.arange(len(at)) + length <= (begin + sizes)[which])
        first = np.r_[True, (at[starts[1:]] != at[starts[:-1]]) | (which[starts[1:]] != which[starts[:-1]])]
        lo = starts[first]
        hi = starts[np.r_[np.flatnonzero(first)[1:] - 1, len(starts) - 1]]
        place, seg = at[lo].astype(np.int64), which[lo]
        out = np.empty(len(lo), SINGLE)
        out["h"], out["a"], out["b"] = h[place], place - lo, place - hi
        out["p"] = place - begin[seg] + np.array([g[1] for g in group])[seg]
        doc = np.array([g[0] for g in group])[seg]
        out["p"] += slots[doc]
        out["d"] = ids[doc]
        found.append(out)
    return np.concatenate(found) if found else np.empty(0, SINGLE)


def _packed(x: np.ndarray) -> bytes:
    """Field after field, which packs better than row after row."""
    return pa.compress(b"".join(np.ascontiguousarray(x[n]).tobytes() for n in x.dtype.names), codec="zstd", asbytes=True) if len(x) else b""


def _unpacked(data: bytes, n: int, kind: np.dtype) -> np.ndarray:
    out = np.empty(n, kind)
    if n:
        raw, at = pa.decompress(data, n * kind.itemsize, codec="zstd", asbytes=True), 0
        for name in kind.names:
            size = kind[name].itemsize * n
            out[name] = np.frombuffer(raw[at : at + size], kind[name])
            at += size
    return out


def _utf8(column: pa.Array) -> list[bytes]:
    return [x.as_py() or b"" for x in column.cast(pa.binary())]


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    return (x["d"] % buckets + (x["p"] >> SLOT) % buckets) % buckets


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Ids, slots and texts of documents, BLOCK bytes at a time."""
    ids, slots, texts, held = [], [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            more = _utf8(part.column("text"))
            ids.append(part.column("doc_id").to_numpy())
            slots.append(part.column("slot").to_numpy())
            texts += more
            held += sum(map(len, more))
            if held >= BLOCK:
                yield np.concatenate(ids), np.concatenate(slots), texts
                ids, slots, texts, held = [], [], [], 0
    if texts:
        yield np.concatenate(ids), np.concatenate(slots), texts


def shared_anchors(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """bucket (of the document), n, data (n packed SINGLE rows): anchors whose hash occurs twice or more anywhere."""
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, slots, texts in _blocks(batches):
            all_ = anchors(texts, ids, slots, length)
            texts.clear()
            give_back()
            all_ = all_[np.argsort(all_["h"], kind="stable")]
            new = np.r_[True, all_["h"][1:] != all_["h"][:-1]] if len(all_) else np.empty(0, bool)
            alone = new & np.r_[new[1:], True][: len(new)]
            # Kind 0: asks whether it is shared. 1: shared here, tells the others. 2: shared here, passes on.
            for kind, x in ((0, all_[alone]), (1, all_[new & ~alone]), (2, all_[~alone])):
                rows, to = [], (x["h"] % np.uint64(buckets)).astype(np.int64) if kind < 2 else _bucket(x, buckets)
                order = np.lexsort((x["p"], x["d"], to))
                x, to = x[order], to[order]
                cut = np.searchsorted(to, np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(cut)):
                    part = x[cut[b] : cut[b + 1]]
                    if kind == 1:
                        part = part[["h"]].astype(HASH)
                    rows.append((int(b), kind, len(part), _packed(part)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, tell, ready = {}, {}, []
        for batch in batches:
            for b, kind, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 1:
                    tell.setdefault(b, []).append((data, n))
                elif kind == 0:
                    ask.setdefault(b, []).append((data, n))
                else:
                    ready.append(_unpacked(data, n, SINGLE))
            if sum(map(len, ready)) > 1_000_000:
                yield from by_document(np.concatenate(ready))
                ready = []
        while ask:  # a task may have several buckets, of which one at a time is unpacked
            b, parts = ask.popitem()
            x = np.concatenate([_unpacked(data, n, SINGLE) for data, n in parts])
            order = np.argsort(x["h"], kind="stable")
            h = x["h"][order]
            twice = np.zeros(len(h), bool)
            twice[1:] = h[1:] == h[:-1]
            twice[:-1] |= twice[1:]
            if b in tell:
                twice |= np.isin(h, np.unique(np.concatenate([_unpacked(data, n, HASH)["h"] for data, n in tell.pop(b)])))
            ready.append(x[order[twice]])
            if sum(map(len, ready)) > 1_000_000:
                yield from by_document(np.concatenate(ready))
                ready = []
        if ready:
            yield from by_document(np.concatenate(ready))

    def by_document(x: np.ndarray) -> Iterator[pa.RecordBatch]:
        to = _bucket(x, buckets)
        order = np.lexsort((x["p"], x["d"], to))
        x, to = x[order], to[order]
        cut = np.searchsorted(to, np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cut))
        if len(full):
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array(np.diff(cut)[full], pa.int64()),
                pa.array([_packed(x[cut[b] : cut[b + 1]]) for b in full], pa.binary()),
            ], names=["bucket", "n", "data"])

    blobs = docs.mapInArrow(lean(deal), "bucket int, kind int, n long, data binary").repartition(buckets, "bucket")
    return blobs.mapInArrow(lean(meet), "bucket int, n long, data binary")


def hot_cells(shared: DataFrame, hot_rows: int) -> np.ndarray:
    """One bit a cell (CELLS bits whatever the input): does it hold more than hot_rows anchors?"""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for n, data in zip(batch.column("n"), batch.column("data")):
                np.add.at(total, (_unpacked(data.as_py(), n.as_py(), SINGLE)["h"] % np.uint64(CELLS)).astype(np.int64), 1)
        cell = np.flatnonzero(total)
        for at in range(0, len(cell), 100_000):
            c = cell[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(total[c])], names=["cell", "n"])

    hot = shared.select("n", "data").mapInArrow(lean(count), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > hot_rows).select("cell")
    bits = np.zeros(CELLS, bool)
    for row in hot.toLocalIterator():
        bits[row[0]] = True
    return np.packbits(bits)


SNIPPETS = "key long, doc long, lo long, n int, a int, data binary"
SNIPPET_SCHEMA = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("lo", pa.int64()), ("n", pa.int32()), ("a", pa.int32()), ("data", pa.binary())])


def compressed(rows: DataFrame) -> DataFrame:
    """doc_id, slot, n (bytes of the text), data: texts as they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _utf8(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("slot"), pa.array(list(map(len, texts)), pa.int64()), pa.array([pa.compress(t, codec="zstd", asbytes=True) for t in texts], pa.binary())], names=["doc_id", "slot", "n", "data"])

    return rows.select("doc_id", "slot", "text").mapInArrow(lean(run), "doc_id long, slot long, n long, data binary")


def text_of(data: pa.Scalar, n: pa.Scalar) -> bytes:
    return pa.decompress(data.as_py(), n.as_py(), codec="zstd", asbytes=True)


def combined(key: np.ndarray, doc: np.ndarray, lo: np.ndarray, n: np.ndarray, data: pa.Array) -> np.ndarray:
    """For each row, the first row in document order with the same key and bytes (itself, if none is before)."""
    code = data.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((lo, doc, code, key))
    new = np.r_[True, (key[order][1:] != key[order][:-1]) | (code[order][1:] != code[order][:-1])]
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    out = np.empty(len(key), np.int64)
    out[order] = head
    return out


def snippets(texts: DataFrame, shared: DataFrame, copies: DataFrame, length: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """The bytes around the shared anchors of all texts but copies. Rows without data are runs of starts already known to repeat."""
    shipped = texts.sparkSession.sparkContext.broadcast(hot.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_hot = np.unpackbits(np.frombuffer(shipped.value, np.uint8)).astype(bool)
        any_hot = bool(is_hot.any())

        def flush(rows: list) -> Iterator[pa.RecordBatch]:
            key, doc, lo, n, top = (np.concatenate([r[k] for r in rows]) for k in range(5))
            data = pa.array([d for r in rows for d in r[5]], pa.binary())
            rows.clear()
            give_back()
            head = combined(key, doc, lo, n, data)
            keep = head == np.arange(len(head))
            known = ~keep & ((doc[head] != doc) | (lo[head] != lo))
            key = np.where(known, doc * 1_000_003 + lo, key)  # what is known needn't meet others
            use = pa.array(keep | known)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep | known]) for x in (key, doc, lo, n, top)] + [pc.if_else(pa.array(keep), data, pa.scalar(None, pa.binary())).filter(use)], schema=SNIPPET_SCHEMA)

        def cut(doc_id: int, slot: int, text: bytes, x: np.ndarray) -> tuple:
            key, top, low, p = x["h"].view(np.int64), x["a"].astype(np.int64), x["b"].astype(np.int64), x["p"] - slot
            split = is_hot[(x["h"] % np.uint64(CELLS)).astype(np.int64)] if any_hot else np.zeros(len(x), bool)
            if split.any():
                parts = [(key[~split], top[~split], low[~split], p[~split])]
                for q in range((length - K) // STEP + 1):
                    a, b = np.minimum(top, q * STEP + STEP - 1), np.maximum(low, q * STEP)
                    on = split & (a >= b)
                    core = [hashlib.blake2b(text[s - q * STEP : s - q * STEP - STEP + 1 + length], digest_size=8).digest() for s in p[on]]
                    parts.append((np.frombuffer(b"".join(core), np.int64) + q, a[on], b[on], p[on]))
                key, top, low, p = (np.concatenate(c) for c in zip(*parts))
            lo, n = p - top, (top - low + 1).astype(np.int32)
            return key, np.full(len(p), doc_id), lo + slot, n, top.astype(np.int32), [text[s : s + w] for s, w in zip(lo.tolist(), (n + (length - 1)).tolist())]

        rows, held, bucket, marks, without, own, owners, places = [], 0, None, [], set(), None, None, None
        for batch in batches:
            for b, kind, doc_id, slot, n, data in zip(*(batch.column(c) for c in ("bucket", "kind", "doc_id", "slot", "n", "data"))):
                kind, doc_id, slot = kind.as_py(), doc_id.as_py(), slot.as_py()
                if b.as_py() != bucket:
                    bucket, marks, without, own = b.as_py(), [], set(), None
                if kind == 0:
                    marks.append(_unpacked(data.as_py(), n.as_py(), SINGLE))
                elif kind == 1:
                    without.add((doc_id, slot))
                elif (doc_id, slot) not in without and marks:
                    if own is None:
                        own = np.concatenate(marks)
                        own = own[np.lexsort((own["p"], own["d"]))]
                        marks = [own]
                        owners, places = np.ascontiguousarray(own["d"]), np.ascontiguousarray(own["p"])
                    lo, hi = np.searchsorted(owners, doc_id), np.searchsorted(owners, doc_id, side="right")
                    lo, hi = lo + np.searchsorted(places[lo:hi], [slot, slot + (1 << SLOT)])
                    if hi > lo:
                        rows.append(cut(doc_id, slot, text_of(data, n), own[lo:hi]))
                        held += len(rows[-1][5])
                if held > 150_000:
                    yield from flush(rows)
                    rows, held = [], 0
        if rows:
            yield from flush(rows)

    mod = lambda c: F.pmod(c, F.lit(buckets))
    to = mod(mod(F.col("doc_id")) + mod(F.shiftright("slot", SLOT))).cast("int").alias("bucket")
    none = F.lit(None).cast("long")
    row = lambda df, kind: df.select(to if "doc_id" in df.columns else "bucket", F.lit(kind).alias("kind"), F.col("doc_id") if "doc_id" in df.columns else none.alias("doc_id"), F.col("slot") if "slot" in df.columns else none.alias("slot"), F.col("n") if "n" in df.columns else F.lit(0).cast("long").alias("n"), F.col("data") if "data" in df.columns else F.lit(None).cast("binary").alias("data"))
    dealt = row(shared, 0).unionByName(row(copies, 1)).unionByName(row(texts, 2))
    return dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(lean(run), SNIPPETS)


class Suffixes:
    """Suffixes of a buffer, compared on up to `length` bytes by prefix hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.prefix = data, length, prefix_hashes(data)
        _, self.down = POWERS.upto(len(data) + 1)

    def equal(self, i: np.ndarray, j: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Do n bytes of suffixes i and j have the same hash?"""
        return (self.prefix[i + n] - self.prefix[i]) * self.down[i] == (self.prefix[j + n] - self.prefix[j]) * self.down[j]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many bytes suffixes i and j have in common, `length` at most. Whole matches need no search."""
        out = np.full(len(i), self.length)
        rest = np.flatnonzero(~self.equal(i, j, self.length))
        i, j = i[rest], j[rest]
        lo, hi = np.zeros(len(i), np.int64), np.full(len(i), self.length - 1)
        pi, pj, di, dj = self.prefix[i], self.prefix[j], self.down[i], self.down[j]
        for _ in range(math.ceil(math.log2(self.length))):
            mid = (lo + hi + 1) >> 1
            same = (self.prefix[i + mid] - pi) * di == (self.prefix[j + mid] - pj) * dj
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        out[rest] = lo
        return out

    def before(self, i: np.ndarray, j: np.ndarray, ties: bool) -> np.ndarray:
        """Is suffix i before suffix j? `ties`: the answer for equal ones."""
        n = self.common(i, j)
        end = n == self.length
        n = np.where(end, 0, n)
        return np.where(end, ties, self.data[i + n] < self.data[j + n])

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """`at` sorted within groups (consecutive equal values of `group`) by a mergesort of all groups at once."""
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[first, len(at)])
        begin, end = np.repeat(first, size), np.repeat(first + size, size)
        width = 1
        while width < size.max(initial=1):
            index = np.flatnonzero(end - begin > width)
            run = begin[index] + (index - begin[index]) // (2 * width) * (2 * width)
            middle, stop = np.minimum(run + width, end[index]), np.minimum(run + 2 * width, end[index])
            left = index < middle
            lo, hi = np.where(left, middle, run), np.where(left, stop, middle)
            base, x = lo.copy(), at[index]
            while (open_ := np.flatnonzero(lo < hi)).size:
                mid = (lo[open_] + hi[open_]) >> 1
                # Left ones come before equal right ones, so that the sort is stable.
                less = np.empty(len(open_), bool)
                for side in (True, False):
                    on = left[open_] == side
                    less[on] = self.before(at[mid[on]], x[open_[on]], not side)
                lo[open_], hi[open_] = np.where(less, mid + 1, lo[open_]), np.where(less, hi[open_], mid)
            out = at.copy()
            out[np.where(left, index, index - (middle - run)) + (lo - base)] = x
            at = out
            width *= 2
        return at


def repeated_starts(key: np.ndarray, doc: np.ndarray, lo: np.ndarray, n: np.ndarray, top: np.ndarray, data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and starts of windows with an earlier equal window under the same key. Rows are distinct.

    top: how far a row's anchor lies behind its first start. Equal windows have it at the same place.
    """
    order = np.argsort(key, kind="stable")
    begin = np.concatenate(([0], np.cumsum([len(data[i]) for i in order])))[:-1]
    text = np.frombuffer(b"".join(data[i] for i in order), np.uint8)
    key, doc, lo, n, top = key[order], doc[order], lo[order], n[order].astype(np.int64), top[order].astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    fresh = np.cumsum(np.r_[True, key[1:] != key[:-1]])
    group = fresh[row] * (length + 1) + top[row] - step
    together = np.argsort(group, kind="stable")
    group = group[together]
    new = np.r_[True, group[1:] != group[:-1]]
    several = ~(new & np.r_[new[1:], True])
    row, step, group = row[together][several], step[together][several], group[several]
    if not len(row):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, start = begin[row] + step, lo[row] + step
    suffixes = Suffixes(text, length)
    sorted_at = suffixes.sort(at, group)
    owner = np.empty(len(text) + 1, np.int64)
    owner[at] = np.arange(len(at))
    own = owner[sorted_at]
    same = np.zeros(len(own), bool)
    if len(own) > 1:
        near = np.flatnonzero(group[1:] == group[:-1])
        same[near + 1] = suffixes.equal(sorted_at[near + 1], sorted_at[near], length)
    # Collisions are told by the bytes themselves, against the neighbour, which takes in the whole class.
    check = np.flatnonzero(same)
    for c in range(0, len(check), 50_000):
        i = check[c : c + 50_000]
        span = np.arange(length)
        same[i] = (text[sorted_at[i][:, None] + span] == text[sorted_at[i - 1][:, None] + span]).all(1)
    for g in np.unique(group[check[~same[check]]]):
        at_g = np.flatnonzero(group == g)
        windows = [text[a : a + length].tobytes() for a in sorted_at[at_g]]
        by_bytes = np.array(sorted(range(len(at_g)), key=windows.__getitem__))
        sorted_at[at_g], own[at_g] = sorted_at[at_g][by_bytes], own[at_g][by_bytes]
        same[at_g] = [k > 0 and windows[by_bytes[k]] == windows[by_bytes[k - 1]] for k in range(len(at_g))]
    rank = np.empty(len(own), np.int64)
    rank[np.lexsort((start, doc[row]))] = np.arange(len(own))
    heads = np.flatnonzero(~same)
    best = np.minimum.reduceat(rank[own], heads)
    first = best[np.cumsum(~same) - 1]
    place = np.empty(len(own), np.int64)
    place[rank] = np.arange(len(own))
    head = place[first]
    late = own[(doc[row[own]] != doc[row[head]]) | (start[own] != start[head])]
    return doc[row[late]], start[late]


def repeats(found: DataFrame, length: int, parts: int) -> DataFrame:
    """doc_id, lo, hi: runs of window starts that repeat an earlier one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            known = pc.is_null(batch.column("data"))
            if pc.any(known).as_py():
                x = batch.filter(known)
                yield runs(x.column("doc").to_numpy(), x.column("lo").to_numpy(), x.column("n").to_numpy())
            held.append(batch.filter(pc.invert(known)))
        if not held:
            return
        x = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        if not x.num_rows:
            return
        key, doc, lo, n, top = (x.column(c).to_numpy() for c in ("key", "doc", "lo", "n", "a"))
        data = x.column("data").combine_chunks()
        data = data.chunk(0) if isinstance(data, pa.ChunkedArray) else data
        head = combined(key, doc, lo, n, data)
        late = (doc[head] != doc) | (lo[head] != lo)
        if late.any():
            yield runs(doc[late], lo[late], n[late])
        keep = np.flatnonzero(head == np.arange(len(head)))
        values, counts = np.unique(key[keep], return_counts=True)
        keep = keep[np.isin(key[keep], values[counts > 1])]
        # Whole keys at a time, about 50,000 suffixes, which stay in cache.
        keep = keep[np.argsort(key[keep], kind="stable")]
        if not len(keep):
            return
        total = np.cumsum(n[keep])
        ends = np.flatnonzero(np.r_[key[keep][1:] != key[keep][:-1], True]) + 1
        begin = 0
        for end in ends:
            if total[end - 1] - (total[begin - 1] if begin else 0) >= 50_000 or end == len(keep):
                i = keep[begin:end]
                d, s = repeated_starts(key[i], doc[i], lo[i], n[i], top[i], data.take(pa.array(i)).to_pylist(), length)
                if len(d):
                    o = np.lexsort((s, d))
                    yield runs(d[o], s[o], np.ones(len(o), np.int64))
                begin = end

    def runs(doc: np.ndarray, lo: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        new = np.r_[True, (doc[1:] != doc[:-1]) | (lo[1:] != lo[:-1] + n[:-1])]
        last = np.r_[np.flatnonzero(new)[1:] - 1, len(doc) - 1]
        return pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(lo[new]), pa.array(lo[last] + n[last] - 1)], names=["doc_id", "lo", "hi"])

    return found.repartition(parts, "key").mapInArrow(lean(run), "doc_id long, lo long, hi long")


def merged(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows of `runs`."""
    out: list[list[int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + length)
        else:
            out.append([lo, hi + length])
    return [(a, b) for a, b in out]


def deduplicated(docs: DataFrame, length: int = 100, hot_rows: int = HOT_ROWS, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left, with `texts`; null where nothing went)."""
    spark = docs.sparkSession
    small_batches(spark)
    made_up = -1 - F.conv(F.substring(F.sha2(text_or_empty(), 256), 1, 15), 16, 10).cast("long")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), made_up).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), text_or_empty().alias("text"))
    described = materialized(rows.select("doc_id", "no_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "suffix-docs")
    several = described.groupBy("doc_id").agg(F.min("sha").alias("a"), F.max("sha").alias("b")).where("a <> b").select(F.col("doc_id").alias("s_doc"))
    slots = described.join(several, F.col("doc_id") == F.col("s_doc")).select("s_doc", F.col("sha").alias("s_sha")).distinct()
    slots = materialized(slots.withColumn("s_slot", F.shiftleft((F.row_number().over(W.partitionBy("s_doc").orderBy("s_sha")) - 1).cast("long"), SLOT)).where("s_slot > 0"), "suffix-slots")
    if slots.isEmpty():  # hardly any table has two texts of one id, and then no join has to carry texts
        rows, status = (df.withColumn("slot", F.lit(0).cast("long")) for df in (rows, described))
    else:
        own = lambda df, sha: df.join(slots, (F.col("doc_id") == F.col("s_doc")) & (sha == F.col("s_sha")), "left").select(*df.columns, F.coalesce("s_slot", F.lit(0)).alias("slot"))
        rows, status = own(rows, F.sha2("text", 256)), own(described, F.col("sha"))
    total = status.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / SHARE))
    buckets = max(1, math.ceil(total / SHARE))

    first = status.groupBy("sha", "n_bytes").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("copies")).where("first <> last")
    first = first.select(F.col("sha").alias("f_sha"), F.col("n_bytes").alias("f_n"), "first", "copies")
    status = spread_join(status, first, {"sha": "f_sha", "n_bytes": "f_n"}, "first", "copies", described.count(), F.col("doc_id"))
    status = materialized(status.select("doc_id", "no_id", "slot", "n_bytes", "sha", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("copy")), "suffix-status")
    dropped(described)

    shared = materialized(shared_anchors(rows, length, buckets), "suffix-anchors")
    texts_ = compressed(rows.where(F.octet_length("text") >= length))
    found = snippets(texts_, shared, status.where("copy").select("doc_id", "slot"), length, hot_cells(shared, hot_rows), buckets)
    runs = materialized(repeats(found, length, parts), "suffix-runs")
    dropped(shared)
    begin = F.shiftleft(F.shiftright("lo", SLOT), SLOT)
    cuts = runs.groupBy("doc_id", begin.alias("slot")).agg(F.collect_list(F.struct((F.col("lo") - begin).alias("lo"), (F.col("hi") - begin).alias("hi"))).alias("runs"))

    schema = pa.schema([("doc_id", pa.int64()), ("slot", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("own_sha", pa.string()), *([("kept", pa.binary())] if texts else [])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, slot, n, data, own in zip(*(batch.column(c) for c in ("doc_id", "slot", "n", "data", "runs"))):
                text, at, kept = text_of(data, n), 0, []
                gone = merged([(r["lo"], r["hi"]) for r in own.as_py()], length)
                for a, b in gone:
                    kept.append(text[at:a])
                    at = b
                left = b"".join([*kept, text[at:]])
                out.append((doc_id.as_py(), slot.as_py(), len(text) - len(left), len(gone), hashlib.sha256(left).hexdigest(), *([left] if texts else [])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    changed = texts_.join(cuts, ["doc_id", "slot"]).mapInArrow(lean(cut), "doc_id long, slot long, n_removed long, n_spans long, own_sha string" + ", kept binary" * texts).dropDuplicates(["doc_id", "slot"])
    whole = F.col("copy") & (F.col("n_bytes") >= length)
    result = status.join(changed, ["doc_id", "slot"], "left").select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("own_sha", "sha")).alias("kept_sha256"),
        *([F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if texts else []),
    )
    return result


#: The same over every window of every text, as hexadecimal digits, in DuckDB SQL.
ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 200)) AS s FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh FROM r),
n AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
c AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM n GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM c),
t AS (SELECT k.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept
      FROM k JOIN d ON d.doc_id = k.doc_id GROUP BY k.doc_id)
SELECT d.doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN t ON d.doc_id = t.doc_id
"""
