"""Environments, on-bits and neighbour pairs of the tokens of a text, many texts at once.

The ids are those of ``columns.feature_id``; every distinct token of a batch is hashed once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# Bytes of text that are taken at once; a longer text is taken alone.
BLOCK_BYTES = 4_000_000


def _ids(texts: list[bytes]) -> np.ndarray:
    """Unsigned 32-bit ids of feature texts."""
    digests = b"".join([hashlib.md5(t, usedforsecurity=False).digest() for t in texts])
    return np.frombuffer(digests, dtype=">u4")[::4].astype(np.int64)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text, word) numbers of all tokens in order, and the distinct words."""
    pieces = pc.ascii_split_whitespace(texts)
    lens = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    doc, flat = np.repeat(np.arange(len(lens)), lens), pieces.flatten()
    full = pc.not_equal(flat, "")  # before leading and after trailing blanks
    words = flat.filter(full).dictionary_encode()
    return doc[full.to_numpy(zero_copy_only=False)], words.indices.to_numpy(), words.dictionary


def _offsets(doc: np.ndarray, texts: pa.Array, each: int = 1) -> pa.Array:
    return pa.array(np.r_[0, np.cumsum(each * np.bincount(doc, minlength=len(texts)))], pa.int32())


def environments(texts: pa.Array) -> pa.Array:
    """Lists of (env, element): of every token its own id and that of its first letter behind the one before; the
    element tells short, medium and long tokens."""
    doc, at, names = _words(texts)
    size = pc.utf8_length(names).to_numpy()
    initials = pc.utf8_slice_codeunits(names, 0, 1).dictionary_encode()
    letters = initials.dictionary.to_pylist()
    own = initials.indices.to_numpy()[at].astype(np.int64)
    before = np.full(len(own), len(letters))  # the first token has none before it
    if len(own):
        before[1:] = np.where(doc[1:] == doc[:-1], own[:-1], len(letters))
    keys = pa.array(before * len(letters) + own).dictionary_encode()
    pairs, pair_at = keys.dictionary.to_pylist(), keys.indices.to_numpy()
    two = [f"#{[*letters, ''][p // len(letters)]}{letters[p % len(letters)]}".encode() for p in pairs]
    env = np.empty(2 * len(at), dtype=np.int64)
    env[0::2], env[1::2] = _ids(names.cast(pa.binary()).to_pylist())[at], _ids(two)[pair_at]
    kind = np.where(size < 4, 0, np.where(size < 8, 1, 2))[at]
    element = pa.array(["S", "M", "L"]).take(pa.array(np.repeat(kind, 2)))
    mask = texts.is_null() if texts.null_count else None
    return pa.ListArray.from_arrays(
        _offsets(doc, texts, 2), pa.StructArray.from_arrays([pa.array(env), element], names=["env", "element"]), mask=mask)


def bits(texts: pa.Array, nbits: int = 2048) -> pa.Array:
    """Lists of ``columns.on_bits`` of the tokens."""
    doc, at, names = _words(texts)
    on = np.zeros((len(texts), nbits), dtype=bool)
    on[doc, (_ids(names.cast(pa.binary()).to_pylist()) % nbits)[at]] = True
    doc, bit = np.nonzero(on)
    offsets = pa.array(np.r_[0, np.cumsum(on.sum(axis=1))], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(bit, pa.int32()), mask=texts.is_null() if texts.null_count else None)


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Runs of texts of about ``most`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield texts.slice(lo, hi - lo)
        lo = hi


def on_bits(text: Column | str) -> Column:
    """``columns.on_bits`` of the words of a text column."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([bits(b) for b in blocks(texts)]) if len(texts) else bits(texts)

    return run(F.col(text) if isinstance(text, str) else text)


def pairs(texts: pa.Array) -> pa.Array:
    """Lists of ``columns.neighbour_pairs``, as numbers of distinct pairs and these: a pair is written once."""
    doc, at, names = _words(texts)
    order = pc.array_sort_indices(names)
    rank = np.empty(len(names), np.int64)
    rank[order.to_numpy()] = np.arange(len(names))
    by_name = names.take(order)
    same = doc[1:] == doc[:-1]
    a, b = rank[at[:-1][same]], rank[at[1:][same]]
    keys = pa.array(np.minimum(a, b) * max(1, len(names)) + np.maximum(a, b)).dictionary_encode()
    low, high = np.divmod(keys.dictionary.to_numpy(), max(1, len(names)))
    written = pc.binary_join_element_wise(by_name.take(pa.array(low)), by_name.take(pa.array(high)), "-")
    return pa.ListArray.from_arrays(_offsets(doc[1:][same], texts), pa.DictionaryArray.from_arrays(keys.indices, written))
