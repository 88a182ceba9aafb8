"""Byte-level BPE: exact encoding by backtracking over longest matches, and decoding.

A pre-token's bytes, mapped to Latin-1, go through an Aho-Corasick automaton of
the vocabulary.  The longest matches from the left are the encoding if every two
neighbours are compatible, that is, if merging their joined bytes gives the two
back; compatibility is memoised by pair.  Where a pair fails, the search steps
to the next shorter token, marks dead positions and backs up; each position dies
once, so the work is linear in the pre-token.  Sequences whose neighbours are
all compatible are exactly the result of the merges.

Defined results: null and empty texts have no ids and decode to nothing;
special tokens are ordinary text; all other columns pass through, but for one that
has a new column's name (in any case): it is replaced; a row is
encoded alone, so ties and repeated rows need no rule.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from palaver.llm.blocks import numbered, release, texts_of

#: Distinct pre-tokens in each of the two generations that a worker remembers.
REMEMBERED = 150_000
#: Texts go on in slices of about so many characters.
SLICE = 1 << 21


def slices(lengths: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` units together, or one row."""
    at, n = 0, len(lengths)
    ends = np.cumsum(lengths)
    while at < n:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, to
        at = to


class Bpe(dict):
    """Pre-token -> its ids as little-endian uint32 bytes, filled on demand."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        # White space as Unicode defines it; the engine's own \s has four control characters more.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.older: dict[str, bytes] = {}
        self.compatible: dict[int, bool] = {}  # both tokens in one number -> whether they fit
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.edges: dict[int, list[tuple[bytes, int]]] = {}
        self.shorter: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for b, i in ranks.items():
            if len(b) == 1 or self.merged(b) == [i]:
                self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()

    @classmethod
    def load(cls, path: str, pattern: str) -> Bpe:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def merged(self, piece: bytes) -> list[int]:
        """The merges by rank, one after another: only for short pieces and for tests."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1)]
            rank, i = min(ranked)
            if rank == 1 << 40:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def parts(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes token t; None for a single byte."""
        if t not in self.halves:
            b = self.token[t]
            parts = [b[i : i + 1] for i in range(len(b))]
            while len(parts) > 2:
                _, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.halves[t] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[t]

    def _edge(self, t: int, side: int) -> list[tuple[bytes, int]]:
        """The tokens on one edge of t's merge tree, each with the rank of the merge that ends it."""
        key = 2 * t + side
        if key not in self.edges:
            out, until = [], 1 << 40
            while True:
                out.append((self.token[t], until))
                halves = self.parts(t)
                if halves is None:
                    break
                t, until = halves[side], t
            self.edges[key] = out
        return self.edges[key]

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both tokens gives the two back.

        It does not if an edge token of each would merge across the boundary
        while both exist; of two equal merges the left one comes first.
        """
        rank = self.ranks.get
        for y, y_until in self._edge(b, 0):
            for x, x_until in self._edge(a, 1):
                r = rank(x + y)
                if r is not None and r < x_until and r <= y_until:
                    return False
        return True

    def next_shorter(self, t: int) -> int:
        """The longest token that is a proper prefix of token t; -1 if there is none."""
        known = self.shorter.get(t)
        if known is None:
            b = self.token[t]
            known = next((self.ranks[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in self.ranks and self.automaton.exists(b[:k].decode("latin-1"))), -1)
            self.shorter[t] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        mapped, n = piece.decode("latin-1"), len(piece)
        longest, token, known = self.automaton.iter_long, self.token, self.compatible
        ids: list[int] = []
        dead: set[int] = set()
        at = 0
        while True:
            # Longest matches from here on, as far as neighbours fit and no dead end is met.
            for _, t in longest(mapped, at):
                if ids:
                    fits = known.get(ids[-1] << 20 | t)
                    if fits is None:
                        fits = known[ids[-1] << 20 | t] = self.fits(ids[-1], t)
                    if not fits:
                        break
                if dead and at + len(token[t]) in dead:
                    break
                ids.append(t)
                at += len(token[t])
            if at == n:
                return ids
            # Shorter tokens at this place; without any it is dead, and the last token goes.
            while True:
                t = self.next_shorter(t)
                if t < 0:
                    dead.add(at)
                    t = ids.pop()
                    at -= len(token[t])
                elif at + len(token[t]) not in dead and (not ids or self._known(ids[-1], t)):
                    ids.append(t)
                    at += len(token[t])
                    break

    def _known(self, a: int, b: int) -> bool:
        fits = self.compatible.get(a << 20 | b)
        if fits is None:
            fits = self.compatible[a << 20 | b] = self.fits(a, b)
        return fits

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
            if len(self.compatible) > 2 * REMEMBERED:
                self.compatible.clear()
        ids = self.older.get(piece)
        if ids is None:
            found = self.encode_piece(piece.encode("utf-8", "replace"))
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian uint32."""
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_loaded: dict[tuple[str, str], Bpe] = {}


def loaded(path: str, pattern: str) -> Bpe:
    """One encoder a worker process."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Bpe.load(path, pattern)
    return _loaded[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, column: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """The frame with a binary column of ids (little-endian uint32) in the text column's place.

    ``decoded`` names a further column for what the ids decode to, made by the same
    task: a chained ``decode`` would hold a second worker with a vocabulary.  All
    other columns pass through, but for one that has a new column's name: it is replaced.
    """
    new = {ids.lower(), (decoded or ids).lower()}
    kept = [i for i, f in enumerate(docs.schema) if f.name == column or f.name.lower() not in new]
    fields = [T.StructField(ids, T.BinaryType(), False) if docs.schema[i].name == column else docs.schema[i] for i in kept]
    if decoded:
        fields.append(T.StructField(decoded, T.BinaryType(), False))
    names = [f.name for f in fields]
    k = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(path, pattern)
        for batch in batches:
            texts = texts_of(batch.column(k).cast(pa.string()))
            lengths = np.diff(np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0, int)
            for a, b in slices(lengths):
                done = [own.encode(t) for t in texts.slice(a, b - a).to_pylist()]
                columns = [pa.array(done, pa.binary()) if i == k else batch.column(i).slice(a, b - a) for i in kept]
                if decoded:
                    columns.append(pa.array([own.decode(np.frombuffer(x, dtype="<u4").tolist()) for x in done], pa.binary()))
                yield pa.record_batch(columns, names=names)
            release()

    return numbered(docs).mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """The frame with a further binary column: the bytes that the ids stand for."""
    kept = [i for i, f in enumerate(encoded.schema) if f.name.lower() != column.lower()]
    fields = [*(encoded.schema[i] for i in kept), T.StructField(column, T.BinaryType(), False)]
    names = [f.name for f in fields]
    k = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(path, pattern)
        for batch in batches:
            packed = batch.column(k)
            lengths = np.diff(np.frombuffer(packed.buffers()[1], dtype=np.int32)[packed.offset : packed.offset + len(packed) + 1]) if len(packed) else np.zeros(0, int)
            for a, b in slices(lengths):
                done = [own.decode(np.frombuffer(x, dtype="<u4").tolist()) for x in packed.slice(a, b - a).to_pylist()]
                yield pa.record_batch([*(batch.column(i).slice(a, b - a) for i in kept), pa.array(done, pa.binary())], names=names)

    return numbered(encoded).mapInArrow(run, T.StructType(fields))
