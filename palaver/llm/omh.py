"""Order MinHash over sequences of hashed k-mers, for whole blocks of documents.

Each k-mer is paired with its occurrence number in its document; a hash ranks
the pairs.  The leading bits of the hash deal the pairs into ``m`` classes; of
each class the ``ell`` minimal pairs are selected, put back into text order, and
the tuple is hashed.  Two documents agree in a class if they share these pairs
in the same order, so that moved text costs agreement as edits do.
"""

from __future__ import annotations

import numpy as np

from palaver.llm.blocks import Block, mix

_OCC = np.uint64(0xA0761D6478BD642F)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def occurrences(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How often each hash has appeared before in its document."""
    n = len(h)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    key = mix(h ^ mix(doc.astype(np.uint64) + _STEP))
    if n <= 1 << 20:
        # Sorting key bits and position together is faster than a stable argsort.
        packed = np.sort((key & ~np.uint64(0xFFFFF)) | np.arange(n, dtype=np.uint64))
        order = (packed & np.uint64(0xFFFFF)).astype(np.int64)
        same = (packed[1:] >> np.uint64(20)) == (packed[:-1] >> np.uint64(20))
        exact = key[order[1:]] == key[order[:-1]]
        if not np.array_equal(same, exact):  # two keys share their leading bits
            order = np.argsort(key, kind="stable")
            exact = key[order[1:]] == key[order[:-1]]
    else:
        order = np.argsort(key, kind="stable")
        exact = key[order[1:]] == key[order[:-1]]
    at = np.arange(n)
    first = np.concatenate([[True], ~exact])
    number = at - np.maximum.accumulate(np.where(first, at, 0))
    out = np.empty(n, dtype=np.uint64)
    out[order] = number
    return out


def sketch(h: np.ndarray, doc: np.ndarray, n_docs: int, m: int = 64, ell: int = 2, spare: int = 4) -> np.ndarray:
    """(n_docs, m) uint64 tuple hashes; 0 marks a class without any k-mer.

    ``h`` and ``doc`` list the k-mer hashes in text order, documents ascending.
    """
    bits = np.uint64(m.bit_length() - 1)
    value = mix(h + (occurrences(h, doc) + np.uint64(1)) * _OCC)
    inside = value << bits  # the rank within a class
    size = np.bincount(doc, minlength=n_docs)
    # Long documents only need their small ranks; where these are too few, all count.
    limit = np.full(n_docs, np.iinfo(np.uint64).max, dtype=np.uint64)
    long = size > spare * ell * m
    limit[long] = (2.0**64 * (spare * ell * m) / size[long]).astype(np.uint64)
    out, count = _select(value, inside <= limit[doc], doc, n_docs, m, ell, bits)
    short = np.flatnonzero(long & (count.min(axis=1, initial=ell) < ell)) if n_docs else []
    if len(short):
        wanted = np.zeros(n_docs, dtype=bool)
        wanted[short] = True
        again, _ = _select(value, wanted[doc], doc, n_docs, m, ell, bits)
        out[short] = again[short]
    return out


def _select(value, keep, doc, n_docs, m, ell, bits):
    at = np.flatnonzero(keep)  # ascending: text order
    v, d = value[at], doc[at]
    if n_docs <= 1 << 16:
        # Document and the leading bits of the rank in one key; later bits only break ties.
        order = np.argsort((d.astype(np.uint64) << np.uint64(48)) | (v >> np.uint64(16)), kind="stable")
    else:
        order = np.lexsort((v, d))
    v, d, at = v[order], d[order], at[order]
    group = d * m + (v >> (np.uint64(64) - bits)).astype(np.int64)
    n = len(group)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(first, n))
    out = np.zeros(n_docs * m, dtype=np.uint64)
    count = np.zeros(n_docs * m, dtype=np.int64)
    count[group[first]] = np.minimum(size, ell)
    places = np.full((len(first), ell), np.iinfo(np.int64).max)
    picked = np.zeros((len(first), ell), dtype=np.uint64)
    for j in range(ell):
        has = size > j
        places[has, j] = at[first[has] + j]
        picked[has, j] = v[first[has] + j]
    text_order = np.argsort(places, axis=1, kind="stable")
    picked = np.take_along_axis(picked, text_order, axis=1)
    tuple_hash = np.full(len(first), _STEP)
    for j in range(ell):
        tuple_hash = mix(tuple_hash * _STEP + picked[:, j])
    out[group[first]] = np.maximum(tuple_hash, np.uint64(1))
    return out.reshape(n_docs, m), count.reshape(n_docs, m)


def ordered_samples(h: np.ndarray, doc: np.ndarray, n_docs: int, m: int, ell: np.ndarray, spare: int = 4) -> np.ndarray:
    """(n_docs, m) tuple hashes of ``m`` orders of their own, each over all k-mers of a text; 0 where a text has none.

    ``ell`` is the tuple's length for each text.  Where an order ranks fewer than
    that among the small ranks looked at first, all count.
    """
    base = h + (occurrences(h, doc) + np.uint64(1)) * _OCC
    size = np.bincount(doc, minlength=n_docs)
    ell = np.minimum(ell, size)
    limit = np.full(n_docs, np.iinfo(np.uint64).max, dtype=np.uint64)
    long = size > 2 * spare * ell
    limit[long] = (2.0**64 * (spare * ell[long]) / size[long]).astype(np.uint64)
    most = limit[doc]
    out = np.zeros((n_docs, m), dtype=np.uint64)
    for j in range(m):
        value = mix(base ^ mix(np.array([j + 1], dtype=np.uint64) * _STEP)[0])
        keep = value <= most
        if long.any():
            few = long & (np.bincount(doc[keep], minlength=n_docs) < ell)
            if few.any():
                keep |= few[doc]
        at = np.flatnonzero(keep)
        v, d = value[at], doc[at]
        order = np.lexsort((v, d))
        v, d, at = v[order], d[order], at[order]
        begin = np.searchsorted(d, np.arange(n_docs))
        least = np.arange(len(d)) - begin[d] < ell[d]
        v, d, at = v[least], d[least], at[least]
        order = np.argsort(at, kind="stable")  # text order
        v, d = v[order], d[order]
        place = np.arange(len(d)) - np.searchsorted(d, np.arange(n_docs))[d]
        made = np.full(n_docs, _STEP ^ np.uint64(j))
        for r in range(int(ell.max(initial=0))):
            some = place == r
            made[d[some]] = mix(made[d[some]] * _STEP + v[some])
        out[:, j] = np.where(size > 0, np.maximum(made, np.uint64(1)), np.uint64(0))
    return out


def byte_kmers(b: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k-byte k-mers of each text; a shorter text is one k-mer itself."""
    n = b.lengths
    whole = np.flatnonzero((n > 0) & (n < k))
    size = np.where(n >= k, n - k + 1, 0)
    doc = np.repeat(np.arange(b.n), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(b.starts[:-1], size)
    h = b.windows(k)[at] if len(at) else np.zeros(0, dtype=np.uint64)
    if len(whole):
        h = np.concatenate([h, b.hashes(b.starts[whole], b.starts[whole + 1])])
        doc = np.concatenate([doc, whole])
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    return h, doc


def word_shingles(b: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k-word shingles of each text; a text of fewer words is one shingle itself."""
    begin, end, owner = b.words()
    w = b.hashes(begin, end)
    n = np.bincount(owner, minlength=b.n)
    first = np.cumsum(n) - n
    size = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(b.n), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    h = np.full(len(at), np.uint64(k))
    for j in range(k):
        inside = at + j < np.repeat(first + n, size)
        word = w[np.minimum(at + j, max(len(w) - 1, 0))] if len(w) else np.zeros(0, np.uint64)
        h = np.where(inside, mix(h * _STEP + word), h)
    return h, doc


def likeness(a: np.ndarray, b: np.ndarray, ell: int) -> np.ndarray:
    """Row-wise likeness of two sketches, 0 to 1: the ell-th root of the share of equal classes."""
    some = (a != 0) | (b != 0)
    n = some.sum(axis=1)
    same = ((a == b) & some).sum(axis=1)
    return np.where(n == 0, 1.0, (same / np.maximum(n, 1)) ** (1.0 / ell))
