"""Edit-aware token counts: pre-token segment trees, re-encoding only what edits touch.

``build`` turns every text into leaves, one a pre-token: its length in code
points and its number of BPE tokens.  ``apply_edits`` puts the leaves of a
document in runs under a segment tree of sums, finds an edit's place by
descending the tree, lexes again from three code points before the edit until
the lexer meets an old boundary beyond it, encodes only those pre-tokens and
updates the sums on the way to the root.  The root is the document's count.

Defined results: null and empty texts have no leaves and count 0; edit bounds
are clipped to the text as it is when the edit's turn comes, a stop before the
start is an insertion, a null replacement deletes; null edits are skipped; rows
are independent, so ties, repeated rows and empty tables need no rule; further
columns pass through, but for those that have a new column's name (in any case):
they are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.blocks import closed, numbered, opened, texts_of
from palaver.llm.bpe import Bpe, loaded, slices

RUN = 64  # leaves in a run when a tree is built
REACH = 3  # code points beyond its end that a pre-token's match may look at


class TokenTree:
    """Runs of leaves under two segment trees, of code points and of tokens."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, bpe: Bpe):
        self.bpe = bpe
        self._set(text, chars, tokens)

    @classmethod
    def of(cls, text: str, bpe: Bpe) -> TokenTree:
        pieces = bpe.split(text)
        return cls(text, [len(p) for p in pieces], [len(bpe[p]) // 4 for p in pieces], bpe)

    def _set(self, text: str, chars, tokens) -> None:
        """Runs as [text, leaf lengths, leaf tokens]; arrays until an edit touches the run."""
        chars, tokens = np.asarray(chars, dtype=np.int32), np.asarray(tokens, dtype=np.int32)
        first = range(0, max(1, len(chars)), RUN)
        if len(chars):
            sizes = np.add.reduceat(chars, first, dtype=np.int64).tolist(), np.add.reduceat(tokens, first, dtype=np.int64).tolist()
        else:
            sizes = [0], [0]
        self.runs: list[list] = []
        at = 0
        for i, n in zip(first, sizes[0], strict=True):
            self.runs.append([text[at : at + n], chars[i : i + RUN], tokens[i : i + RUN]])
            at += n
        self.width = 1 << (len(self.runs) - 1).bit_length()
        self.sums = []
        for own in sizes:
            s = [0] * self.width + own + [0] * (self.width - len(own))
            for i in range(self.width - 1, 0, -1):
                s[i] = s[2 * i] + s[2 * i + 1]
            self.sums.append(s)

    @property
    def length(self) -> int:
        return self.sums[0][1]

    @property
    def count(self) -> int:
        return self.sums[1][1]

    def text(self) -> str:
        return "".join(r[0] for r in self.runs)

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([r[1] for r in self.runs]).astype(np.int32), np.concatenate([r[2] for r in self.runs]).astype(np.int32)

    def _open(self, run: int) -> list:
        """A run with plain lists, to be walked or changed."""
        r = self.runs[run]
        if isinstance(r[1], np.ndarray):
            r[1], r[2] = r[1].tolist(), r[2].tolist()
        return r

    def _find(self, at: int) -> tuple[int, int]:
        """The run that holds code point ``at``, and where the run begins."""
        chars, node, before = self.sums[0], 1, 0
        while node < self.width:
            node *= 2
            if at >= before + chars[node] and chars[node + 1]:
                before += chars[node]
                node += 1
        return node - self.width, before

    def _put(self, run: int, text: str, chars: list[int], tokens: list[int]) -> None:
        self.runs[run] = [text, chars, tokens]
        for s, value in zip(self.sums, (len(text), sum(tokens)), strict=True):
            i = run + self.width
            s[i] = value
            while i > 1:
                i //= 2
                s[i] = s[2 * i] + s[2 * i + 1]

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replace code points [start, stop) by ``new``; the number of pre-tokens encoded again."""
        start = min(max(start, 0), self.length)
        stop = min(max(stop, start), self.length)
        first, begin = self._find(max(0, start - REACH))
        # The last boundary that no match before the edit can have looked past.
        at, keep = begin, 0
        for c in self._open(first)[1]:
            if at + c > start - REACH:
                break
            at += c
            keep += 1
        head = self.runs[first][0][: at - begin]
        # Text and old boundaries from ``at`` on, taken run by run.
        last, old, bounds, place = first, self.runs[first][0][at - begin :], {at}, at
        for c in self.runs[first][1][keep:]:
            place += c
            bounds.add(place)
        step = 1
        while True:
            while last + 1 < len(self.runs) and (at + len(old) < stop + 64 * step):
                last += 1
                old += self.runs[last][0]
                for c in self._open(last)[1]:
                    place += c
                    bounds.add(place)
            ended = last + 1 == len(self.runs)
            fresh = old[: start - at] + new + old[stop - at :]
            shift = len(new) - (stop - start)
            pieces, here, done = self.bpe.split(fresh), at, None
            for i, p in enumerate(pieces):
                if here - shift >= stop and here >= start + len(new) and (here - shift) in bounds and (here - at) <= len(fresh) - (0 if ended else REACH):
                    done = i
                    break
                here += len(p)
            if done is not None or ended:
                break
            step *= 4
        pieces = pieces[:done]
        chars, tokens = [len(p) for p in pieces], [len(self.bpe[p]) // 4 for p in pieces]
        # Old leaves behind the meeting point stay as they are.
        rest_chars, rest_tokens, place = [], [], at
        meet = here - shift
        for r in range(first, last + 1):
            for c, t in zip(self.runs[r][1][keep if r == first else 0 :], self.runs[r][2][keep if r == first else 0 :], strict=True):
                if place >= meet:
                    rest_chars.append(c)
                    rest_tokens.append(t)
                place += c
        text = head + fresh
        all_chars = self.runs[first][1][:keep] + chars + rest_chars
        all_tokens = self.runs[first][2][:keep] + tokens + rest_tokens
        self._put(first, text, all_chars, all_tokens)
        for r in range(first + 1, last + 1):
            self._put(r, "", [], [])
        if len(all_chars) > 8 * RUN:  # a run that grew too long: deal the leaves anew
            self._set(self.text(), *self.leaves())
        return len(pieces)


def build(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The frame with ``leaf_chars`` and ``leaf_tokens``: the leaves of each text's tree."""
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("leaf_chars", "leaf_tokens")]
    many = T.ArrayType(T.IntegerType(), False)
    fields = [*kept, T.StructField("leaf_chars", many, False), T.StructField("leaf_tokens", many, False)]
    names, given = [f.name for f in fields], docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        kind = pa.list_(pa.int32())
        for batch in batches:
            batch = batch.rename_columns(given)
            texts = texts_of(batch["text"])
            lengths = np.diff(np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0, int)
            for a, b in slices(lengths):
                chars, tokens, ends = [], [], [0]
                for text in texts.slice(a, b - a).to_pylist():
                    pieces = bpe.split(text)
                    chars += map(len, pieces)
                    tokens += map(len, map(bpe.__getitem__, pieces))
                    ends.append(len(chars))
                tokens = np.array(tokens, dtype=np.int32) // 4
                made = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())).cast(kind) for x in (chars, tokens)]
                yield pa.record_batch([*(batch[f.name].slice(a, b - a) for f in kept), *made], names=names)

    return numbered(docs).mapInArrow(run, T.StructType(fields))


def apply_edits(trees: DataFrame, path: str, pattern: str) -> DataFrame:
    """Apply each row's ``edits`` (array of start, stop, replacement) in turn.

    text and leaves become those after the edits; further columns: ``n_before``,
    ``n_after`` (token counts) and ``n_encoded`` (pre-tokens encoded again).
    """
    made = ("n_before", "n_after", "n_encoded")
    kept = [f for f in trees.schema.fields if f.name.lower() not in (*made, "edits")]
    fields = [*kept, *(T.StructField(n, T.LongType(), False) for n in made)]
    names, given = [f.name for f in fields], trees.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        kind = pa.list_(pa.int32())
        for batch in batches:
            batch = batch.rename_columns(given)
            texts = texts_of(batch["text"])
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                n = part.num_rows
                made_here = {k: np.zeros(n, dtype=np.int64) for k in made}
                new_texts, leaves, ends = [], ([], []), [0]
                stored = part["leaf_chars"], part["leaf_tokens"]
                flat = [x.values.to_numpy() for x in stored]
                at = np.asarray(stored[0].offsets)
                if not np.array_equal(at, np.asarray(stored[1].offsets)):
                    raise ValueError("leaf_chars and leaf_tokens do not belong together")
                for i, (text, edits) in enumerate(zip(texts.slice(a, 500).to_pylist(), part["edits"].to_pylist(), strict=True)):
                    tree = TokenTree(text, flat[0][at[i] : at[i + 1]], flat[1][at[i] : at[i + 1]], bpe)
                    made_here["n_before"][i] = tree.count
                    for e in edits or ():
                        if e is not None:
                            made_here["n_encoded"][i] += tree.edit(e["start"] or 0, e["stop"] or 0, e["replacement"] or "")
                    made_here["n_after"][i] = tree.count
                    new_texts.append(tree.text())
                    for own, x in zip(leaves, tree.leaves(), strict=True):
                        own.append(x)
                    ends.append(ends[-1] + len(leaves[0][-1]))
                out = {k: pa.array(x) for k, x in made_here.items()} | {"text": pa.array(new_texts, pa.string())}
                for k, own in zip(("leaf_chars", "leaf_tokens"), leaves, strict=True):
                    out[k] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(own))).cast(kind)
                yield pa.record_batch([out[k] if k in out else part[k] for k in names], names=names)

    return numbered(trees).mapInArrow(run, T.StructType(fields))


def three_edits(docs: DataFrame) -> DataFrame:
    """Documents with three edits each: a replacement, an insertion and a deletion."""
    docs, names = opened(docs.drop("edits"), "text")
    n = F.char_length(F.coalesce(F.col("text"), F.lit("")))

    def edit(at, cut: int, new: str):
        return F.struct(at.cast("int").alias("start"), (at + cut).cast("int").alias("stop"), F.lit(new).alias("replacement"))

    return closed(docs.withColumn("edits", F.array(edit(F.floor(n / 4), 8, " re-worded it's"), edit(F.floor(n / 2), 0, "\n\n  42 new words,"), edit(F.floor(n * 3 / 4), 16, ""))), [*names, "edits"])
