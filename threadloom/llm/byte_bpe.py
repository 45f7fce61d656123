"""Byte-level BPE: texts to token ids and back.

Each match of the pattern is encoded on its own. Its pairs of neighbours wait in a queue with one bucket per
merge rank; the buckets hold places in a linked list of the parts, and a hierarchical bitmap of the buckets in
use gives the lowest rank by two find-first-set steps. Entries whose pair is no longer there are skipped when
they come up. Each merge costs the same however long the pre-token is. The many short pre-tokens of a batch that were not
seen before share one queue, in which all pairs of a rank are merged at once.

Letters and numbers are those of the tiktoken library, whose Unicode version may differ from that of the
regular expressions here: a character that the two see differently is split as if it were one that both see alike.

A null or empty text has no tokens. Special tokens are ordinary text. Other columns are carried along, a column
of the output's name is replaced; rows are independent, so repeated rows and an empty table need no rule. Ids
without a token raise; a null list of ids decodes to no bytes.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import cache, partial
from heapq import heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame

from threadloom.llm.work import importable, tidy

CACHED = 150_000  # different pre-tokens a worker remembers, and as many used before them
LEARNT = 2000  # rows learnt at once
CACHED_BOTH, LEARNT_BOTH = 50_000, 500  # the same where it decodes too
_ROWS = 128  # of one output batch
_AT_ONCE = 200_000  # pre-tokens that share a queue
_SHORT = 4096  # bytes of a pre-token whose lists need not be packed
_HIGH, _BIT = [b << 8 for b in range(256)], [1 << b for b in range(256)]
_LONG = 1 << 16  # characters; longer texts are split lazily
_RUN = 1 << 23  # characters whose pre-tokens are held at once


@cache
def stand_ins() -> dict[int, str]:
    """Characters that tiktoken puts in another class than `regex` does, with one that both put where tiktoken
    has it; none of these is in the text of a pattern."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    classes = []
    for name in (r"\p{L}", r"\p{N}"):
        only = tiktoken.Encoding("bytes", pat_str=name, special_tokens={},
                                 mergeable_ranks={bytes([b]): b for b in range(256)})
        classes.append((set(bytes(only.encode_ordinary(every)).decode()), set(regex.findall(name, every))))
    (letters, own_letters), (numbers, own_numbers) = classes
    odd = (letters ^ own_letters) | (numbers ^ own_numbers)
    return {ord(c): "é" if c in letters else "²" if c in numbers else "¤" for c in odd}


def tokens(ranks: bytes) -> dict[int, bytes]:
    return {int(r): base64.b64decode(t) for t, r in map(bytes.split, ranks.splitlines())}


class Decoder:
    def __init__(self, ranks: bytes):
        self.token = tokens(ranks)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Seen(dict):
    """Packed ids of pre-tokens. When it is full, what was used since it last was stays."""

    def __init__(self, encode, cached: int = CACHED):
        super().__init__()
        self.encode, self.older, self.cached = encode, {}, cached

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece) or self.encode(piece.encode("utf-8", "replace"))
        if len(piece) < 64:
            if len(self) >= 2 * self.cached:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


    def add(self, ids: dict[str, bytes]) -> None:
        if len(self) + len(ids) > self.cached:
            self.older = dict(self)
            self.clear()
        self.update(ids)


class Encoder:
    """`ranks`: lines of a base64 token and its rank. `pattern` cuts a text into pre-tokens. `odd`: see
    `stand_ins`."""

    def __init__(self, ranks: bytes, pattern: str, odd: dict[int, str] | None = None, cached: int = CACHED):
        self.rank = {t: r for r, t in tokens(ranks).items()}
        self.longest = max(map(len, self.rank))
        self.split = regex.compile(pattern)
        self.odd = stand_ins() if odd is None else odd
        self.odd_characters = frozenset(map(chr, self.odd))
        self.byte = [self.rank[bytes([b])] for b in range(256)]
        # All pairs of tokens that make a token, and those of two bytes by their value.
        self.merge = {self.rank[t[:i]] << 20 | self.rank[t[i:]]: r for t, r in self.rank.items()
                      for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank}
        order = sorted(self.merge)
        self.merge_table = np.array(order, np.int64), np.array([self.merge[k] for k in order], np.int32)
        self.first = [self.rank.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.low = [0] * ((max(self.rank.values()) >> 8) + 1)  # all zero between pre-tokens
        self.seen = _Seen(self.encode_piece, cached)

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids as packed 32-bit numbers."""
        n = len(piece)
        whole = self.rank.get(piece) if n <= self.longest else None
        if whole is not None:
            return whole.to_bytes(4, sys.byteorder)
        numbers = list if n < _SHORT else partial(array, "q")
        merge, first, low, top = self.merge.get, self.first, self.low, 0
        token = numbers(map(self.byte.__getitem__, piece))
        after = numbers(range(1, n + 1))  # the part at i ends where the next begins
        before = numbers(range(-1, n - 1))
        # Rank of the part at i and the next one.
        pair = numbers(map(first.__getitem__, map(int.__add__, map(_HIGH.__getitem__, piece), piece[1:])))
        pair.append(-1)
        # The queue: places by rank, a word of bits for each 256 ranks, and a bit for each word in use.
        buckets: dict[int, list[int]] = {}
        for i, rank in enumerate(pair):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)  # in order, so a heap
                else:
                    buckets[rank] = [i]
                    group = rank >> 8
                    low[group] |= _BIT[rank & 255]
                    top |= _BIT[group] if group < 256 else 1 << group
        while top:
            group = (top & -top).bit_length() - 1
            bits = low[group]
            rank = (group << 8) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[group] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            if pair[i] != rank:
                continue  # stale
            gone = after[i]
            after[i] = end = after[gone]
            pair[gone] = pair[i] = -1
            token[i] = rank
            left = before[i]
            if end < n:
                before[end] = i
                merged = merge(rank << 20 | token[end])
                if merged is not None:
                    pair[i] = merged
                    if merged in buckets:
                        heappush(buckets[merged], i)
                    else:
                        buckets[merged] = [i]
                        group = merged >> 8
                        low[group] |= _BIT[merged & 255]
                        top |= _BIT[group] if group < 256 else 1 << group
            if left >= 0:
                merged = merge(token[left] << 20 | rank)
                if merged is None:
                    pair[left] = -1
                elif merged != pair[left]:
                    pair[left] = merged
                    if merged in buckets:
                        heappush(buckets[merged], left)
                    else:
                        buckets[merged] = [left]
                        group = merged >> 8
                        low[group] |= _BIT[merged & 255]
                        top |= _BIT[group] if group < 256 else 1 << group
        out, i = array("i"), 0
        while i < n:
            out.append(token[i])
            i = after[i]
        return out.tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The same for many pre-tokens, none of them a token, with one queue for all: the pairs of one rank are
        merged at once wherever they are, as pre-tokens do not touch each other."""
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        n, starts = int(ends[-1]), ends - sizes
        data = np.frombuffer(b"".join(pieces), np.uint8)
        token = np.array(self.byte, np.int32)[data]
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1], before[starts] = n, -1
        pair = np.full(n + 1, -1, np.int32)
        pair[:n - 1] = np.array(self.first, np.int32)[(data[:-1].astype(np.int32) << 8) | data[1:]]
        pair[ends - 1] = -1
        merging, swallowed = np.zeros(n + 1, bool), np.zeros(n, bool)
        keys, values = self.merge_table
        buckets: dict[int, list[np.ndarray]] = {}
        low, top, early = self.low, 0, []

        def push(places: np.ndarray) -> int:
            added = 0
            ranks = pair[places]
            by = np.argsort(ranks, kind="stable")
            ranks, places = ranks[by], places[by]
            edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, own in zip(ranks[np.concatenate([[0], edges])].tolist(), np.split(places, edges)):
                if rank in buckets:
                    buckets[rank].append(own)
                else:
                    buckets[rank] = [own]
                    low[rank >> 8] |= 1 << (rank & 255)
                    added |= 1 << (rank >> 8)
            return added

        first = np.flatnonzero(pair >= 0)
        if len(first):
            top = push(first)
        while top:
            group = (top & -top).bit_length() - 1
            bits = low[group]
            rank = (group << 8) + (bits & -bits).bit_length() - 1
            low[group] = bits = bits & (bits - 1)
            if not bits:
                top &= top - 1
            held = buckets.pop(rank)
            at = held[0] if len(held) == 1 else np.concatenate(held)
            at = at[pair[at] == rank]  # the others are stale
            if not len(at):
                continue
            gone = after[at]
            merging[at] = True
            if merging[gone].any():  # pairs that share a part: from the left, every second one
                merging[at] = False
                at.sort()
                run = np.concatenate([[True], after[at[:-1]] != at[1:]])
                begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - begin) % 2 == 0]
                gone = after[at]
                merging[at] = True
            end = after[gone]
            pair[gone], pair[at] = -1, -1
            swallowed[gone] = True
            after[at], token[at] = end, rank
            inner = end < n
            right = at[inner]
            before[end[inner]] = right
            left = before[at]
            left = left[left >= 0]
            left = left[~merging[left]]  # else the right side of another
            merging[at] = False
            places = np.concatenate([right, left])
            if not len(places):
                continue
            wanted = (token[places].astype(np.int64) << 20) | token[after[places]]
            found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            new = np.where(keys[found] == wanted, values[found], -1)
            pair[places] = new
            if (sooner := (new >= 0) & (new < rank)).any():
                early.append(places[sooner])  # came up after merges that it should have been before
            places = places[new >= 0]
            if len(places):
                top |= push(places)
        alive = ~swallowed
        flat = token[alive]
        upto = np.cumsum(alive)[ends - 1]
        out = [flat[b:e].tobytes() for b, e in zip([0, *upto[:-1].tolist()], upto.tolist())]
        for i in set(np.searchsorted(ends, np.concatenate(early), "right").tolist()) if early else ():
            out[i] = self.encode_piece(pieces[i])
        return out

    def learn(self, texts: pa.Array) -> None:
        """Encodes the short pre-tokens of the texts that were not seen, all at once."""
        seen = self.seen
        self._learn({p for t in texts if len(s := t.as_py() or "") <= _LONG for p in self._pieces(s) if p not in seen and len(p) < 64})

    def _learn(self, new: set[str]) -> None:
        older = self.seen.older
        ids = {p: older[p] for p in new if p in older}
        pieces = {p: p.encode("utf-8", "replace") for p in new if p not in ids}
        ids |= {p: self.rank[b].to_bytes(4, sys.byteorder) for p, b in pieces.items() if b in self.rank}
        several = [p for p, b in pieces.items() if b not in self.rank]
        for i in range(0, len(several), _AT_ONCE):
            part = several[i:i + _AT_ONCE]
            ids.update(zip(part, self.encode_pieces([pieces[p] for p in part])))
        self.seen.add(ids)

    def encode_all(self, texts: pa.Array, at_once: int) -> Iterator[array]:
        """Ids of each text. Texts are split once, in runs of at most `at_once` rows and about _RUN characters; the
        pre-tokens of a run that were not seen are learnt together and filled in."""
        run: list[tuple[str | list[bytes | str], list[int]]] = []
        new: dict[str, str] = {}
        held = 0
        for t in texts:
            text = t.as_py() or ""
            if len(text) > _LONG:
                run.append((text, []))
            else:
                pieces = list(self._pieces(text))
                row = list(map(self.seen.get, pieces, pieces))  # its ids, or the pre-token itself
                unknown = [i for i, p in enumerate(row) if p.__class__ is str]
                for i in unknown:
                    row[i] = new.setdefault(row[i], row[i])  # one object for all that are equal
                run.append((row, unknown))
            held += len(text)
            if len(run) >= at_once or held >= _RUN:
                yield from self._filled(run, new)
                run, new, held = [], {}, 0
        yield from self._filled(run, new)

    def _filled(self, run: list[tuple[str | list[bytes | str], list[int]]], new: dict[str, str]) -> Iterator[array]:
        self._learn({p for p in new if len(p) < 64})
        for row, unknown in run:
            if row.__class__ is str:
                yield self.encode(row)
                continue
            for i in unknown:
                row[i] = self.seen[row[i]]
            out = array("i")
            out.frombytes(b"".join(row))
            yield out

    def _pieces(self, text: str) -> Iterable[str]:
        if not text.isascii() and not self.odd_characters.isdisjoint(text):
            return (text[m.start():m.end()] for m in self.split.finditer(text.translate(self.odd)))
        if len(text) <= _LONG:
            return self.split.findall(text)
        return (m[0] for m in self.split.finditer(text))

    def encode(self, text: str) -> array:
        out = array("i")
        out.frombytes(b"".join(map(self.seen.__getitem__, self._pieces(text))))
        return out

def _with_column(df: DataFrame, out: str, type_: str, source: str, ranks_file: str, make, kind: type, *more) -> DataFrame:
    spark = df.sparkSession
    importable(spark)
    with open(ranks_file, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())  # a vocabulary's size
    carried = [c for c in df.columns if c != out]
    fields = ", ".join(f"`{c.replace('`', '``')}` {t}" for c, t in df.dtypes if c != out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = kind(ranks.value, *more)
        for batch in batches:
            start = 0
            for made in make(tool, batch.column(source)):
                rows = batch.slice(start, len(made))
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in carried], made], names=[*carried, out])
                start += len(made)

    return df.mapInArrow(tidy(run), f"{fields}, `{out}` {type_}" if fields else f"`{out}` {type_}")


def _lists(ids: list[array]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode_texts(df: DataFrame, ranks_file: str, pattern: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """Adds the token ids of each whole text, an array of int."""
    def ids(encoder: Encoder, texts: pa.Array) -> Iterator[pa.Array]:
        encoded = encoder.encode_all(texts, LEARNT)
        while part := list(islice(encoded, _ROWS)):
            yield _lists(part)

    return _with_column(df, out, "array<int>", text, ranks_file, ids, Encoder, pattern, stand_ins())


def encode_and_decode(df: DataFrame, ranks_file: str, pattern: str, text: str = "text", tokens: str = "tokens",
                      out: str = "decoded") -> DataFrame:
    """Adds the token ids of each whole text and the bytes they stand for, in one worker."""
    spark = df.sparkSession
    importable(spark)
    with open(ranks_file, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())  # a vocabulary's size
    odd = stand_ins()
    carried = [c for c in df.columns if c not in (tokens, out)]
    fields = "".join(f"`{c.replace('`', '``')}` {t}, " for c, t in df.dtypes if c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(ranks.value, pattern, odd, CACHED_BOTH), Decoder(ranks.value)
        for batch in batches:
            encoded = encoder.encode_all(batch.column(text), LEARNT_BOTH)
            for start in range(0, batch.num_rows, _ROWS):
                rows, part = batch.slice(start, _ROWS), list(islice(encoded, _ROWS))
                decoded = pa.array([decoder.decode(ids.tolist()) for ids in part], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in carried], _lists(part), decoded], names=[*carried, tokens, out])

    return df.mapInArrow(tidy(run), f"{fields}`{tokens}` array<int>, `{out}` binary")


def decode_tokens(df: DataFrame, ranks_file: str, tokens: str = "tokens", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for."""
    def texts(decoder: Decoder, ids: pa.Array) -> Iterator[pa.Array]:
        for start in range(0, len(ids), _ROWS):
            part = ids.slice(start, _ROWS)
            flat, ends = part.flatten().to_numpy().tolist(), [0, *np.cumsum(pc.list_value_length(part).fill_null(0)).tolist()]
            yield pa.array([decoder.decode(flat[b:e]) for b, e in zip(ends, ends[1:])], pa.binary())

    return _with_column(df, out, "binary", tokens, ranks_file, texts, Decoder)
