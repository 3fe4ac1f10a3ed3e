"""Exact n-gram Jaccard join that skips by relations between sets.

A document is the set of its distinct `N`-word shingles (64-bit hashes). Equal sets are one class.
Tokens are ordered from rare to frequent by counts in a fixed number of cells, and sets meet in the
inverted lists of their prefixes, as two sets over the threshold share a token there.

Index level: a list is sorted by size and read in blocks of four members. A link is found at the first
token that two sets have in common, so all they share lies behind it; that bounds the size a set can be
linked to by its own size and the token's position (`reach`). A block whose least size and largest reach
leave no member of another block possible is skipped whole, and so are all blocks of larger sizes.
Answer level: a list that stays above `SMALL` possible pairs a member, or is too long to be read in
place, is not paired up. All its members that size leaves possible are compared with one pivot. Two members linked to the
pivot are connected already. For all others near the pivot, their overlap follows from the pivot's
answers: with A what a set lacks of the pivot and B what it has beyond it, |y & z| = |p| - |Ay| - |Az|
+ |Ay & Az| + |By & Bz|, so only differences are compared, through an index of the differences. If y is
linked to the pivot and z is not even near it (twice the distance), they can't be linked. Lists that
share members mostly get one pivot, as it is the least of the members of their members' lists. Members
that are left go through further pivots and in the end through those pairs of their lists that size and
position leave possible, so no link is lost.

Tokens of frequent cells never meet in one task: their members go by set to the answer level, whose
joins Spark splits where a token is skewed.

Before sets are sent to be compared, bitmaps of the parity of a set's hashes (two bits a token) give a
lower bound of how many tokens two sets differ in; pairs that it rules out go no further.

Defined cases: texts without words, null and empty ones are empty sets, linked with nothing; with fewer
than N words the whole sequence is the only shingle; ties don't matter, as links are exact; rows that
repeat a doc_id and text come out alike; rows with a null doc_id link with nothing and have a null
component; texts of any length are taken whole, several at a time only up to `BLOCK` bytes; an empty
table gives an empty one; other columns are ignored. Equal sets are told by size and a 64-bit hash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, grouped, lean, materialized, small_batches, spread_join, text_or_empty
from .graph import components
from .suffixes import POWERS, TABLE, _packed, _unpacked, mix

#: Possible pairs a member above which a list gets a pivot, rounds of pivots, members of a list that is read in place, and of a block.
SMALL, PIVOT_ROUNDS, LONGEST, MEMBERS = 8, 4, 64, 4
CELLS, CHUNKS = 1 << 21, 64
PART_BYTES, BLOCK, SHARE = 1 << 19, 4 << 20, 32 << 20
ENTRY = np.dtype([("t", "<i8"), ("s", "<i8"), ("n", "<u4"), ("p", "<u4")])
TOKEN = np.dtype([("t", "<i8")])
_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A") : ord("Z") + 1] += 32
_lower[[9, 10, 11, 12, 13]] = 32


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, text after text, and how many each text has."""
    flat, counts = [], []
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end]) <= PART_BYTES):
            held += len(texts[end])
            end += 1
        h, c = _part_sets(texts[at:end], n)
        flat.append(h)
        counts.append(c)
        at = end
    return (np.concatenate(flat), np.concatenate(counts)) if flat else (np.empty(0, np.int64), np.empty(0, np.int64))


def _part_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    data = _lower[np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)]
    inside = data != 32
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(~inside[1:] & inside[:-1]) + 1
    bounds = np.cumsum([1] + [len(t) + 1 for t in texts])
    doc = np.searchsorted(bounds, start, side="right") - 1
    up, down = POWERS.upto(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(TABLE[data] * up[: len(data)], out=prefix[1:])
    word = mix((prefix[end] - prefix[start]) * down[start])
    words = np.bincount(doc, minlength=len(texts))
    odd = np.uint64(0xD6E8FEB86659FD93)
    if len(word) >= n:
        h = np.zeros(len(word) - n + 1, np.uint64)
        for k in range(n):
            h = mix(h * odd + word[k : len(h) + k])
        whole = doc[n - 1 :] == doc[: len(h)]
        h, d = h[whole], doc[: len(h)][whole]
    else:
        h, d = np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.cumsum(words) - words
    short_h, short_d = [], []
    for i in np.flatnonzero((words > 0) & (words < n)):
        x = np.full(1, words[i], np.uint64)
        for k in range(words[i]):
            x = mix(x * odd + word[first[i] + k] + np.uint64(1))
        short_h.append(x[0])
        short_d.append(i)
    if short_h:
        h, d = np.concatenate([h, np.array(short_h, np.uint64)]), np.concatenate([d, np.array(short_d, d.dtype)])
    h = h.view(np.int64)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])] if len(h) else np.empty(0, bool)
    return h[new], np.bincount(d[new], minlength=len(texts))


def set_id(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def cell_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens.view(np.uint64) >> np.uint64(20)).astype(np.int64) % CELLS


def needed_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of sets of sizes a and b over the threshold."""
    return -(-(percent * (a + b)) // (100 + percent))


def _text_blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[list, list[bytes]]]:
    keys, texts, held = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            more = [x.as_py() or b"" for x in part.column("text").cast(pa.binary())]
            keys += part.column(column).to_pylist()
            texts += more
            held += sum(map(len, more))
            if held >= BLOCK:
                yield keys, texts
                keys, texts, held = [], [], 0
    if texts:
        yield keys, texts


def described(rows: DataFrame, n: int) -> DataFrame:
    """doc_id, n, sid of every row; and rows with a chunk: counts of the shingles in its cells, one for each task."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sid", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        for ids, texts in _text_blocks(batches, "doc_id"):
            flat, counts = shingle_sets(texts, n)
            ends = np.cumsum(counts)
            sids = [set_id(flat[b - c : b]) for b, c in zip(ends.tolist(), counts.tolist())]
            np.add.at(cells, cell_of(flat), 1)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(sids, pa.int64()), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())], schema=schema)
        if cells.any():
            parts = [pa.compress(c.tobytes(), codec="zstd", asbytes=True) for c in cells.reshape(CHUNKS, -1)]
            none = pa.nulls(CHUNKS, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())], schema=schema)

    return rows.mapInArrow(lean(run), "doc_id long, n long, sid long, chunk int, counts binary")


def levels(found: DataFrame) -> np.ndarray:
    """How frequent each cell is, in 256 steps: CELLS bytes, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
                part = np.frombuffer(pa.decompress(data.as_py(), CELLS // CHUNKS * 4, codec="zstd", asbytes=True), np.uint32)
                sums[chunk] = sums.get(chunk, 0) + part.astype(np.uint64)
        for chunk, total in sums.items():
            level = np.minimum(6 * np.log2(total + 1.0), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["chunk", "level"])

    out = np.zeros((CHUNKS, CELLS // CHUNKS), np.uint8)
    for row in found.where("chunk is not null").select("chunk", "counts").repartition(CHUNKS, "chunk").mapInArrow(lean(run), "chunk int, level binary").collect():
        out[row["chunk"]] = np.frombuffer(row["level"], np.uint8)
    return out.ravel()


LISTED = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("token", pa.int64()), ("n", pa.int64()), ("p", pa.int64())])


def reach(n: np.ndarray, p: np.ndarray, percent: int) -> np.ndarray:
    """The largest set that one of n tokens can be linked to if its token p is the first they have in common."""
    return (100 + percent) * (n - p) // percent - n


def frequent(level: np.ndarray) -> int:
    """The level from which a cell's tokens don't meet in one task: 4096 occurrences, and 16 times the mean cell's."""
    return math.ceil(6 * math.log2(max(4096, 16 * float(np.exp2(level / 6).mean())) + 1))


def list_pairs(e: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """e: lists of LONGEST members at most, sorted by token and size. Members i < j that size and position leave possible.

    Blocks are compared at growing distances; a block that rules a later one out by size is done with it and all behind.
    """
    n, p = e["n"].astype(np.int64), e["p"].astype(np.int64)
    far = reach(n, p, percent)
    start = np.flatnonzero(np.r_[True, e["t"][1:] != e["t"][:-1]])
    which = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(e)]))
    head = np.flatnonzero((np.arange(len(e)) - start[which]) % MEMBERS == 0)
    end, of, least, most = np.r_[head[1:], len(e)], which[head], n[head], np.maximum.reduceat(far, head)
    left, gap, found = np.arange(len(head)), 0, []
    step = np.arange(MEMBERS)
    while len(left):
        left = left[left + gap < len(head)]
        left = left[(of[left + gap] == of[left]) & (least[left + gap] <= most[left])]
        a = left[least[left] <= most[left + gap]]
        i, j = (x.ravel() for x in np.broadcast_arrays(head[a][:, None, None] + step[:, None], head[a + gap][:, None, None] + step))
        ok = (i < np.repeat(end[a], MEMBERS**2)) & (j < np.repeat(end[a + gap], MEMBERS**2)) & (i < j)
        i, j = i[ok], j[ok]
        ok = (n[j] <= far[i]) & (n[i] <= far[j])
        found.append((i[ok], j[ok]))
        gap += 1
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def prefix_lists(rows: DataFrame, n: int, percent: int, level: np.ndarray, buckets: int) -> DataFrame:
    """Rows x, y: pairs from lists read in place. Rows token, x, n, p: members of all other lists, with the token's place."""
    shipped, often = rows.sparkSession.sparkContext.broadcast(level), frequent(level)
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shipped.value
        for _, texts in _text_blocks(batches, "doc_id"):
            flat, counts = shingle_sets(texts, n)
            ends = np.cumsum(counts)
            sids = np.array([set_id(flat[b - c : b]) for b, c in zip(ends.tolist(), counts.tolist())], np.int64)
            doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
            rank_of = rank[cell_of(flat)]
            order = np.lexsort((flat, rank_of, doc))
            flat, rank_of = flat[order], rank_of[order]
            place = np.arange(len(flat)) - np.repeat(ends - counts, counts)
            own = np.zeros(len(counts), bool)
            own[np.unique(sids, return_index=True)[1]] = True
            prefix = counts - -(-percent * counts // 100) + 1
            use = np.flatnonzero((place < prefix[doc]) & own[doc])
            e = np.empty(len(use), ENTRY)
            e["t"], e["s"], e["n"], e["p"] = flat[use], sids[doc[use]], counts[doc[use]], place[use]
            order = np.argsort(e["t"], kind="stable")
            e, hot = e[order], rank_of[use][order] >= often
            del flat, doc, place, rank_of, use
            first = np.flatnonzero(np.r_[True, e["t"][1:] != e["t"][:-1]]) if len(e) else np.empty(0, np.int64)
            size = np.diff(np.r_[first, len(e)])
            large = np.repeat(size > SMALL, size)
            # Kind 0: entries to be matched. 1: tokens whose lists are long already here. 2: their entries, and those of frequent cells.
            for kind, x in ((0, e[~large & ~hot]), (1, e[first][(size > SMALL) & ~hot[first]]), (2, e[large | hot])):
                to = (x["t"].view(np.uint64) if kind < 2 else x["s"].view(np.uint64)) % np.uint64(buckets)
                order = np.lexsort((x["p"], x["s"], to))
                x, to = x[order], to[order].astype(np.int64)
                cut = np.searchsorted(to, np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cut))
                for at in range(0, len(full), 256):
                    part = [x[cut[b] : cut[b + 1]] for b in full[at : at + 256]]
                    data = [_packed(y[["t"]].astype(TOKEN) if kind == 1 else y) for y in part]
                    yield pa.RecordBatch.from_arrays([pa.array(full[at : at + 256].astype(np.int32)), pa.array(np.full(len(part), kind, np.int32)), pa.array(list(map(len, part)), pa.int64()), pa.array(data, pa.binary())], schema=schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask: dict[int, list] = {}
        tell: dict[int, list] = {}
        for batch in batches:
            for b, kind, size, data in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 2:
                    yield long_rows(_unpacked(data, size, ENTRY))
                else:
                    (tell if kind else ask).setdefault(b, []).append(_unpacked(data, size, TOKEN if kind else ENTRY))
        while ask:
            b, parts = ask.popitem()
            e = np.concatenate(parts)
            e = e[np.lexsort((e["s"], e["n"], e["t"]))]
            e = e[np.r_[True, (e["t"][1:] != e["t"][:-1]) | (e["s"][1:] != e["s"][:-1])]]
            first = np.flatnonzero(np.r_[True, e["t"][1:] != e["t"][:-1]])
            size = np.diff(np.r_[first, len(e)])
            long_ = size > LONGEST
            if b in tell:
                long_ |= np.isin(e["t"][first], np.unique(np.concatenate(tell.pop(b))["t"]))
            if long_.any():
                yield long_rows(e[np.repeat(long_, size)])
            x, size = e[np.repeat(~long_ & (size > 1), size)], size[~long_ & (size > 1)]
            # Whole lists at a time, about 50,000 members.
            end = np.cumsum(size)
            for part in np.split(np.arange(len(size)), np.flatnonzero(np.diff(end // 50_000)) + 1):
                if not len(part):
                    continue
                y = x[end[part[0]] - size[part[0]] : end[part[-1]]]
                which = np.repeat(np.arange(len(part)), size[part])
                i, j = list_pairs(y, percent)
                many = np.bincount(which[i], minlength=len(part)) > SMALL * size[part]
                if many.any():
                    yield long_rows(y[many[which]])
                i, j = i[~many[which[i]]], j[~many[which[i]]]
                pairs = np.unique(np.sort(np.stack([y["s"][i], y["s"][j]], 1), 1), axis=0)
                if len(pairs):
                    none = pa.nulls(len(pairs), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none, none], schema=LISTED)

    def long_rows(e: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(e["s"]), pa.nulls(len(e), pa.int64()), pa.array(e["t"]), pa.array(e["n"].astype(np.int64)), pa.array(e["p"].astype(np.int64))], schema=LISTED)

    blobs = rows.mapInArrow(lean(deal), "bucket int, kind int, n long, data binary").repartition(buckets, "bucket")
    return blobs.mapInArrow(lean(meet), "x long, y long, token long, n long, p long")


def sets_of(rows: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """sid, n, tokens (sorted 64-bit hashes) and bits (parities) of the sets in `wanted` (doc_id, sid)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sids, texts in _text_blocks(batches, "sid"):
            flat, counts = shingle_sets(texts, n)
            own = [flat[b - c : b] for b, c in zip(np.cumsum(counts).tolist(), counts.tolist())]
            for at in range(0, len(own), 2000):
                part = own[at : at + 2000]
                yield pa.RecordBatch.from_arrays([
                    pa.array(sids[at : at + 2000], pa.int64()), pa.array(list(map(len, part)), pa.int64()),
                    pa.array([x.tobytes() for x in part], pa.binary()), pa.array([parities(x) for x in part], pa.binary()),
                ], names=["sid", "n", "tokens", "bits"])

    return rows.join(wanted, "doc_id").select("sid", "text").mapInArrow(lean(run), "sid long, n long, tokens binary, bits binary")


def parities(tokens: np.ndarray) -> bytes:
    """Bit i: is the number of tokens that hash to i odd? A power of two bits, two a token at least."""
    size = 1 << max(6, int(2 * len(tokens) - 1).bit_length())
    return np.packbits(np.bincount((tokens.view(np.uint64) >> np.uint64(7)).astype(np.int64) & (size - 1), minlength=size) & 1, bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """A lower bound of the number of tokens in one of two sets only. The larger bitmap folds to the smaller one's size."""
    a, b = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    la, lb = len(x), len(y)
    while la != lb:
        if la > lb:
            la //= 2
            a = (a >> (8 * la)) ^ (a & ((1 << (8 * la)) - 1))
        else:
            lb //= 2
            b = (b >> (8 * lb)) ^ (b & ((1 << (8 * lb)) - 1))
    return (a ^ b).bit_count()


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that sizes and parities leave possible."""
    side = lambda c: sets.select(F.col("sid").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    both = pairs.select("x", "y").join(side("x"), "x").join(side("y"), "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nx, ny = batch.column("n_x").to_numpy(), batch.column("n_y").to_numpy()
            need = needed_overlap(nx, ny, percent)
            far = np.fromiter((apart(a.as_py(), b.as_py()) for a, b in zip(batch.column("bits_x"), batch.column("bits_y"))), np.int64, batch.num_rows)
            ok = pa.array((far <= nx + ny - 2 * need) & (need <= np.minimum(nx, ny)))
            yield pa.RecordBatch.from_arrays([batch.column("x").filter(ok), batch.column("y").filter(ok)], names=["x", "y"])

    return both.mapInArrow(lean(run), "x long, y long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int, near: int, differences: bool, parts: int, label: str, load: int = 256) -> DataFrame:
    """Written under `label`: x, y, nx, ny, linked, near of linked pairs; with `differences` of near pairs, and lack (x - y) and more (y - x).

    A set travels once for each pair it is the y of; x's with more than `load` pairs are spread over
    several tasks.
    """
    bound = near if differences else percent
    pairs = materialized(possible(pairs, sets, bound), "jaccard-pairs")
    sets = sets.select("sid", "tokens")
    degree = pairs.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / load).cast("int").alias("g"))
    left = pairs.join(degree, "x").withColumn("part", F.pmod(F.xxhash64("y"), F.col("g")).cast("int")).join(sets.withColumnRenamed("sid", "y"), "y").select("x", "part", "y", "tokens")
    own = degree.join(sets.withColumnRenamed("sid", "x"), "x").select("x", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("part"), F.lit(None).cast("long").alias("y"), "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x_id = part_id = tokens = None
        for batch in batches:
            out = []
            for x, part, y, data in zip(*(batch.column(c) for c in ("x", "part", "y", "tokens"))):
                x, part, y, own_ = x.as_py(), part.as_py(), y.as_py(), np.frombuffer(data.as_py(), np.int64)
                if y is None:
                    x_id, part_id, tokens = x, part, own_
                    continue
                assert (x, part) == (x_id, part_id)
                at = np.searchsorted(tokens, own_)
                hit = tokens[np.minimum(at, len(tokens) - 1)] == own_
                both = int(hit.sum())
                union = len(tokens) + len(own_) - both
                linked, close = 100 * both >= percent * union, 100 * both >= near * union
                row = [x, y, len(tokens), len(own_), linked, close]
                if differences:
                    lack = np.delete(tokens, at[hit]).tobytes() if close else None
                    row += [lack, own_[~hit].tobytes() if close else None]
                if close or linked:
                    out.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("nx", pa.int64()), ("ny", pa.int64()), ("linked", pa.bool_()), ("near", pa.bool_()), *([("lack", pa.binary()), ("more", pa.binary())] if differences else [])])
    dealt = own.unionByName(left).repartition(parts, "x", "part").sortWithinPartitions("x", "part", F.col("y").asc_nulls_first())
    out = materialized(dealt.mapInArrow(lean(run), "x long, y long, nx long, ny long, linked boolean, near boolean" + ", lack binary, more binary" * differences), label)
    dropped(pairs)
    return out


def derived(star: DataFrame, percent: int, parts: int, block: int = 256) -> DataFrame:
    """a, b: links between sets near a pivot of which one or none is linked to it, from their differences.

    A set that reaches one linked to the pivot is joined to the pivot, which connects the same sets.
    A task takes a block of those not linked and one of all: what is linked travels as often as there
    are blocks that aren't.
    """
    near = star.where("near")
    size = near.groupBy("x").agg(F.count(F.lit(1)).alias("m"), F.count(F.when(~F.col("linked"), 1)).alias("open")).where("open > 0").select("x", F.ceil(F.col("open") / block).cast("int").alias("gz"), F.ceil(F.col("m") / block).cast("int").alias("gy"))
    rows = near.join(size, "x")
    mine = lambda g: F.pmod(F.xxhash64("y"), F.col(g)).cast("int")
    each = lambda g: F.explode(F.sequence(F.lit(0), F.col(g) - 1))
    common = ["y", "nx", "ny", "linked", "lack", "more"]
    z = rows.where("not linked").select("x", mine("gz").alias("zb"), each("gy").alias("yb"), F.lit(True).alias("is_z"), *common)
    y = rows.select("x", each("gz").alias("zb"), mine("gy").alias("yb"), F.lit(False).alias("is_z"), *common)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in grouped(frames, ["x", "zb", "yb"]):
            found = difference_links(g[g["is_z"]], g[~g["is_z"]], percent)
            if len(found):
                yield found

    keys = ["x", "zb", "yb"]
    return z.unionByName(y).repartition(parts, *keys).sortWithinPartitions(*keys).mapInPandas(lean(run), "a long, b long")


def difference_links(z: pd.DataFrame, y: pd.DataFrame, percent: int, most: int = 4_000_000) -> pd.DataFrame:
    """z, y: sets near one pivot, with their differences from it. Links of z's to y's."""
    none = pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    if not len(z) or not len(y):
        return none

    def flat(g: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        parts = [np.r_[np.frombuffer(a, np.int64), ~np.frombuffer(b, np.int64) ^ 0x5555] for a, b in zip(g["lack"], g["more"])]
        return np.concatenate(parts), np.repeat(np.arange(len(g)), [len(p) for p in parts])

    (zt, zi), (yt, yi) = flat(z), flat(y)
    order = np.argsort(yt, kind="stable")
    yt, yi = yt[order], yi[order]
    lo, hi = np.searchsorted(yt, zt), np.searchsorted(yt, zt, side="right")
    ahead = np.cumsum(hi - lo)
    nz, ny, p = z["ny"].to_numpy(), y["ny"].to_numpy(), int(z["nx"].iloc[0])
    lack_z, lack_y = (g["lack"].map(len).to_numpy() // 8 for g in (z, y))
    z_id, y_id, y_linked = z["y"].to_numpy(), y["y"].to_numpy(), y["linked"].to_numpy()
    out, begin = [], 0
    ends = np.r_[np.flatnonzero(zi[1:] != zi[:-1]) + 1, len(zi)]
    for k, end in enumerate(ends):
        if ahead[end - 1] - (ahead[begin - 1] if begin else 0) < most and end != len(zi):
            continue
        n = (hi - lo)[begin:end]
        take = np.repeat(lo[begin:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pair, shared = np.unique(np.repeat(zi[begin:end], n) * len(y) + yi[take], return_counts=True)
        i, j = pair // len(y), pair % len(y)
        both = p - lack_z[i] - lack_y[j] + shared
        ok = (100 * both >= percent * (nz[i] + ny[j] - both)) & (z_id[i] != y_id[j])
        i, j = i[ok], j[ok]
        out.append(np.stack([z_id[i], np.where(y_linked[j], int(z["x"].iloc[0]), y_id[j])], 1))
        begin = end
    links = np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), np.int64)
    if not len(links):
        return none
    # Only which sets hang together matters: one row a set.
    ids, flat_links = np.unique(links, return_inverse=True)
    a, b = flat_links.reshape(-1, 2).T
    least = np.arange(len(ids))
    while True:
        low = np.minimum(least[a], least[b])
        step = least.copy()
        np.minimum.at(step, a, low)
        np.minimum.at(step, b, low)
        step = step[step]
        if (step == least).all():
            break
        least = step
    child = np.flatnonzero(least != np.arange(len(ids)))
    return pd.DataFrame({"a": ids[child], "b": ids[least[child]]})


def pivots_of(members: DataFrame, turn: int) -> DataFrame:
    """token, pivot, pivot_n. Few tokens before the list's own mark a set in the midst of others, so that is the first to be taken.

    In even turns a list takes the first one of all its members' lists, which gives lists that share
    members one pivot; in odd turns its own.
    """
    mark = F.struct("p", F.xxhash64("sid", F.lit(turn)).alias("h"), "sid", "n")
    lists = members.groupBy("token").agg(F.min(F.when(F.col("far"), mark)).alias("m"))
    if turn % 2 == 0:
        sets = members.select("token", "sid").join(lists, "token").groupBy("sid").agg(F.min("m").alias("m"))
        lists = members.select("token", "sid").join(sets, "sid").groupBy("token").agg(F.min("m").alias("m"))
    return lists.select("token", F.col("m.sid").alias("pivot"), F.col("m.n").alias("pivot_n"))


def near_enough(percent: int) -> Column:
    """Does the size of a member leave it possible that it is near its pivot?"""
    return F.lit(percent) * F.greatest("n", "pivot_n") <= 100 * F.least("n", "pivot_n")


def joined(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs`."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    found = materialized(described(rows, n), "jaccard-sets")
    sets = found.where("chunk is null").select("doc_id", "n", "sid")
    reps = materialized(sets.where("doc_id is not null and n > 0").groupBy("sid", "n").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("copies")), "jaccard-reps")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / SHARE))
    lists = materialized(prefix_lists(rows, n, percent, levels(found), max(1, math.ceil(total / SHARE))), "jaccard-lists")

    pairs = lists.where("token is null").select("x", "y").distinct()
    members = lists.where("token is not null").select("token", F.col("x").alias("sid"), "n", "p").distinct()
    wanted = lists.select(F.explode(F.array("x", "y")).alias("sid")).where("sid is not null").distinct()
    tokens = materialized(sets_of(rows.where("doc_id is not null"), wanted.join(reps, "sid").select(F.col("rep").alias("doc_id"), "sid"), n), "jaccard-tokens")
    ends = lambda df: df.where("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))
    first = verified(pairs, tokens, percent, percent, False, parts, "jaccard-links")
    written, links = [first], [ends(first)]

    near = max(0, 2 * percent - 100)
    left = materialized(members.withColumn("far", F.lit(True)), "jaccard-members")
    dropped(lists)
    for turn in range(PIVOT_ROUNDS + 1):
        if left.isEmpty():
            break
        if turn == PIVOT_ROUNDS:
            reaches = F.expr(f"{100 + percent} * (n - p) div {percent} - n")
            a, b = (left.withColumn("reach", reaches).select(F.col("token").alias(f"token_{k}"), *(F.col(c).alias(f"{c}_{k}") for c in ("sid", "n", "far", "reach"))) for k in "ab")
            on = (F.col("token_a") == F.col("token_b")) & (F.col("sid_a") < F.col("sid_b")) & (F.col("far_a") | F.col("far_b")) & (F.col("n_a") <= F.col("reach_b")) & (F.col("n_b") <= F.col("reach_a"))
            rest = verified(a.join(b, on).select(F.col("sid_a").alias("x"), F.col("sid_b").alias("y")).distinct(), tokens, percent, percent, False, parts, "jaccard-rest")
            written.append(rest)
            links.append(ends(rest))
            break
        spokes = materialized(left.join(pivots_of(left, turn), "token").where("sid <> pivot"), "jaccard-spokes")
        star = verified(spokes.where(near_enough(near)).select(F.col("pivot").alias("x"), F.col("sid").alias("y")).distinct(), tokens, percent, near, True, parts, "jaccard-star")
        new = materialized(ends(star).unionByName(derived(star, percent, parts)), "jaccard-derived")
        written.append(new)
        links.append(new)
        status = star.select(F.col("x").alias("pivot"), F.col("y").alias("sid"), "linked")
        open_ = spokes.join(status, ["pivot", "sid"], "left").where("linked is null or not linked").select("token", "sid", "n", "p", F.col("linked").isNull().alias("far"))
        some = open_.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.count(F.when(F.col("far"), 1)).alias("f")).where("f > 0 and m > 1").select("token")
        later = materialized(open_.join(some, "token"), "jaccard-members")
        dropped(left, spokes, star)
        left = later
    dropped(left, tokens)

    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    to_rep = lambda c: reps.select(F.col("sid").alias(c), F.col("rep").alias(f"rep_{c}"))
    edges = edges.distinct().join(to_rep("a"), "a").join(to_rep("b"), "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    comps = components(edges, "jaccard-components").select(F.col("node").alias("c_node"), "component")
    dropped(*written)

    # Members of sets that several documents have find their representative.
    shared = reps.where("rep <> last").select(F.col("sid").alias("s_sid"), F.col("n").alias("s_n"), F.col("rep").alias("s_rep"), "copies")
    own = spread_join(sets, shared, {"sid": "s_sid", "n": "s_n"}, "s_rep", "copies", sets.count(), F.col("doc_id"))
    own = own.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("s_rep", "doc_id")).alias("rep"))
    return own.join(comps, F.col("rep") == F.col("c_node"), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


#: The same by counting common shingles of all pairs that have one, in DuckDB SQL.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
      UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 2),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.seen) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.node = d.doc_id GROUP BY d.doc_id, n.n
"""
