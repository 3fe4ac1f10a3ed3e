"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that ends its encoding. A table of
these last tokens is the whole state: appending bytes only adds entries, an edit only recomputes
entries until they agree with the old ones again, and the encoding is read off backwards.

A token `t` that covers `data[i:j]` is the last token of prefix `j` if and only if merging
`last[i] + t` on its own gives these two tokens back.

Defined cases: a null text counts as empty (0 tokens, hash of no bytes); texts of any length are
encoded whole; repeated rows give repeated results; an empty table gives an empty table; columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches

#: Pieces kept with their ids by each worker, as many again of older ones, and the longest piece kept.
CACHED_PIECES, CACHED_LENGTH = 100_000, 48
#: Texts above this many characters are cut into pieces a block at a time.
BLOCK_TEXT, BLOCK_PIECES = 2_000_000, 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of `base64 rank` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PrefixEncoder:
    """Encodes byte strings under fixed ranks; all methods are exact."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        self.bytes_of = dict(zip(ranks.values(), ranks))
        self._joins: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.finder = ahocorasick.Automaton()
        for data, token in ranks.items():
            self.finder.add_word(data.decode("latin-1"), (token, len(data)))
        self.finder.make_automaton()

    def merged(self, data: bytes, least: int = 1) -> list[bytes]:
        """Plain rank-ordered merging, down to `least` parts."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            best, at = min((self.ranks.get(a + b, sys.maxsize), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == sys.maxsize:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes `token`; None if merging its bytes doesn't lead there."""
        if token not in self._halves:
            parts = self.merged(self.bytes_of[token], 2)
            self._halves[token] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None
        return self._halves[token]

    def may_meet(self, left: int, right: int) -> bool:
        """Does merging the bytes of both give these two tokens? left -1: is `right` what its own bytes give?

        Merges are undone from the latest on. Of each two parts that lie side by side across the
        border at some time, it is asked whether they would have merged before what was undone last.
        """
        key = (left + 1 << 32) + right
        known = self._joins.get(key)
        if known is None:
            if len(self._joins) > 1_000_000:
                self._joins.clear()
            known = self._joins[key] = self._meet(left, right)
        return known

    def _meet(self, left: int, right: int) -> bool:
        single = lambda t: len(self.bytes_of[t]) == 1
        for token in (left, right):
            if token >= 0 and not single(token) and self.halves(token) is None:
                return False
        bound, own = sys.maxsize, True  # own: a merge of equal rank across the border comes first
        while left >= 0:
            across = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if across is not None and (across < bound or (across == bound and own)):
                return False
            if single(right) and single(left):
                return True
            if single(right) or (not single(left) and left > right):
                bound, own, left = left, False, self.halves(left)[1]
            else:
                bound, own, right = right, True, self.halves(right)[0]
        return True

    def last_token(self, data: bytes, last: list[int], end: int) -> int:
        for begin in range(max(0, end - self.longest), end):
            token = self.ranks.get(data[begin:end])
            if token is not None and self.may_meet(last[begin], token):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def table(self, data: bytes) -> list[int]:
        """Entry j: the last token of the encoding of data[:j]; entry 0 is -1."""
        last, joins = [-1] + [-2] * len(data), self._joins
        for at, (token, size) in self.finder.iter(data.decode("latin-1")):
            if last[at + 1] == -2:
                left = last[at + 1 - size]
                known = joins.get((left + 1 << 32) + token)
                if known or (known is None and self.may_meet(left, token)):
                    last[at + 1] = token
        if -2 in last:
            raise ValueError("the vocabulary lacks a byte")
        return last

    def read_off(self, last: list[int]) -> list[int]:
        out, at = [], len(last) - 1
        while at:
            out.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.read_off(self.table(data))


class EditableEncoding:
    """An encoding that follows appends and edits of its bytes without starting over."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        start = len(self.data)
        self.data += data
        for end in range(start + 1, len(self.data) + 1):
            self.last.append(self.encoder.last_token(self.data, self.last, end))

    def replace(self, begin: int, end: int, data: bytes) -> int:
        """Put `data` in place of data[begin:end]; returns how many entries were computed anew.

        Once as many entries in a row as the longest token has bytes agree with the old ones, all
        later entries do, as an entry depends on no more than those and the bytes between.
        """
        old, tail = self.last, self.data[end:]
        shift = begin + len(data) - end
        self.data = self.data[:begin] + data + tail
        self.last = old[: begin + 1]
        agree, first_old = 0, begin + len(data)
        for at in range(begin + 1, len(self.data) + 1):
            self.last.append(self.encoder.last_token(self.data, self.last, at))
            agree = agree + 1 if at > first_old and self.last[at] == old[at - shift] else 0
            if agree >= self.encoder.longest:
                self.last += old[at - shift + 1 :]
                return at - begin
        return len(self.data) - begin

    def ids(self) -> list[int]:
        return self.encoder.read_off(self.last)


class _Pieces(dict):
    """Piece of text to ids; bounded. When it is full, pieces that are met again come over from the older half."""

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.pop(piece, None) or tuple(self.encoder.encode_piece(piece.encode("utf-8", "surrogatepass")))
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class TextEncoder:
    """Whole texts: each match of `pattern` is encoded on its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces = _Pieces(PrefixEncoder(ranks))
        self.pattern = regex.compile(pattern)
        self.bytes_of = self.pieces.encoder.bytes_of

    def encode(self, text: str) -> array:
        if len(text) <= BLOCK_TEXT:
            return array("I", chain.from_iterable(map(self.pieces.__getitem__, self.pattern.findall(text))))
        out, found = array("I"), self.pattern.finditer(text)
        while block := [m.group() for m in islice(found, BLOCK_PIECES)]:
            out.extend(chain.from_iterable(map(self.pieces.__getitem__, block)))
        return out

    def decode(self, ids: array) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


_encoders: dict[tuple[str, str], TextEncoder] = {}


def digest_of(ranks: dict[bytes, int]) -> str:
    found = hashlib.sha256()
    for token, rank in sorted(ranks.items()):
        found.update(b"%d,%d:" % (rank, len(token)) + token)
    return found.hexdigest()


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep_ids: bool = False, round_trip: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with keep_ids also lang, source, ids.

    One pass without a shuffle. The ranks are the only broadcast: their number is that of the
    vocabulary, whatever the input.
    """
    small_batches(docs.sparkSession)
    shipped, key = docs.sparkSession.sparkContext.broadcast(ranks), (digest_of(ranks), pattern)
    kept = ["lang", "source"] if keep_ids else []
    schema = pa.schema([("doc_id", pa.int64()), *((k, pa.string()) for k in kept), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), *([("ids", pa.list_(pa.int32()))] if keep_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _encoders:
            _encoders[key] = TextEncoder(shipped.value, pattern)
        coder = _encoders[key]
        for batch in batches:
            texts = batch.column("text")
            for at in range(0, batch.num_rows, 256):
                counts, ids_hashes, text_hashes, all_ids = [], [], [], []
                for text in texts.slice(at, 256):
                    ids = coder.encode(text.as_py() or "")
                    counts.append(len(ids))
                    ids_hashes.append(hashlib.sha256(little_endian(ids)).hexdigest())
                    text_hashes.append(hashlib.sha256(coder.decode(ids)).hexdigest() if round_trip else None)
                    if keep_ids:
                        all_ids.append(ids)
                part = [batch.column(c).slice(at, 256) for c in ("doc_id", *kept)]
                part += [pa.array(counts, pa.int64()), pa.array(ids_hashes, pa.string()), pa.array(text_hashes, pa.string())]
                if keep_ids:
                    part.append(pa.array(all_ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(part, schema=schema)

    ddl = "doc_id long, " + "".join(f"{k} string, " for k in kept) + "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(k).cast("string").alias(k) for k in kept), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(lean(run), ddl)
