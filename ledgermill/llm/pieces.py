"""Cutting texts where no token of a tokenizer crosses, so that equal pieces are encoded once.

Byte-level and sentence-piece vocabularies begin a token at a single space that
stands between two characters which are not white space. A text is cut there,
and the pieces of a batch are reduced to the distinct ones by Arrow.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


@dataclass
class Pieces:
    """Texts as indices into pieces, of which inner ones are distinct; `first` is where each text begins."""

    distinct: list[str]  # each as it is encoded: inner pieces keep their space in front
    index: np.ndarray
    first: np.ndarray  # where each text begins in `index`, with the end


def cut(texts: pa.Array) -> Pieces:
    """The pieces of `texts` (no nulls). A text in which a cut would not be safe stays whole."""
    lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
    bounds = np.asarray(lists.offsets)
    first = bounds - bounds[0]
    coded = lists.flatten().dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    words = coded.dictionary.to_pylist()
    risky = np.array([not w or w != w.strip() for w in words], bool)
    distinct = [" " + w for w in words]
    starts, lengths = first[:-1], np.diff(first)
    if not len(starts):
        return Pieces(distinct, index, first)
    # A text of one piece is not cut at all, whatever that piece holds.
    whole = np.logical_or.reduceat(risky[index], starts) & (lengths > 1)
    leads = np.flatnonzero(~whole)
    heads = [words[i] for i in index[starts[leads]].tolist()]
    index[starts[leads]] = len(distinct) + np.arange(len(heads))
    distinct += heads
    if not whole.any():
        return Pieces(distinct, index, first)
    rows = np.flatnonzero(whole)
    ends = np.concatenate([[0], np.cumsum(np.where(whole, 1, lengths))])
    out = np.empty(ends[-1], np.int64)
    places = np.ones(ends[-1], bool)
    places[ends[rows]] = False
    out[places] = index[~np.repeat(whole, lengths)]
    out[ends[rows]] = len(distinct) + np.arange(len(rows))
    return Pieces(distinct + texts.take(pa.array(rows)).to_pylist(), out, ends)
