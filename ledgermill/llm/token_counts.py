"""Token counts by the library of a tokenizer, in Arrow batches that return lengths only.

Each Arrow batch is worked on in runs of about the same number of bytes, texts
are cut at safe boundaries (see `pieces`), and the distinct pieces of a run that
were not counted before go to the library in one batch. Counts of short pieces
are remembered by the worker up to `CACHE_PIECES`, which bounds memory and
changes no result.

Null and empty texts have no bytes and no tokens. A text without a safe boundary
is encoded whole, however long. Other columns are not read, so their names
cannot clash; repeated rows are counted each.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgermill.llm.arrays import slices
from ledgermill.llm.pieces import cut

CACHE_PIECES = 600_000
PIECE_CHARS = 64  # longer pieces are rare and are not remembered
RUN_BYTES = 8 << 20

_LOADED: dict[tuple[str, int], tuple[Callable[[list[str]], list[int]], bool]] = {}
_COUNTS: dict[str, int] = {}


def _counter(kind: str, model: bytes) -> tuple[Callable[[list[str]], list[int]], bool]:
    """A function from texts to counts, and whether texts may be cut into pieces for it."""
    if kind == ".json":
        import json

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        config = json.loads(model)
        tokenizer = Tokenizer.from_str(model.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        splitter = config.get("pre_tokenizer") or {}
        safe = (
            config.get("normalizer") is None
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space")
            and not any(
                t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]
                for t in config.get("added_tokens", [])
            )
        )
        encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        return lambda texts: [len(e.ids) for e in encode(texts, add_special_tokens=False)], safe
    if kind == ".model":
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        # Normalisation of this kind looks at neighbouring spaces, so texts stay whole.
        return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)], False
    raise ValueError(f"a tokenizer is a .json or a .model file, not {kind}")


def _batches(kind: str, model, column: str, key: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = model.value
        loaded = _LOADED.get((kind, hash(data)))
        if loaded is None:
            _LOADED.clear()
            _COUNTS.clear()
            loaded = _LOADED[kind, hash(data)] = _counter(kind, data)
        count, safe = loaded
        for batch in batches:
            for part in slices(batch, column, RUN_BYTES):
                texts = pc.fill_null(part.column(column), "")
                n_bytes = pc.binary_length(texts).cast(pa.int64())
                n_tokens = _tokens(count, texts) if safe else np.array(count(texts.to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key).cast(pa.int64()), n_bytes, pa.array(n_tokens), pa.array(n_tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return run


def _tokens(count: Callable[[list[str]], list[int]], texts: pa.Array) -> np.ndarray:
    pieces = cut(texts)
    known = list(map(_COUNTS.get, pieces.distinct))
    new = [i for i, n in enumerate(known) if n is None]
    if new:
        if len(_COUNTS) + len(new) > CACHE_PIECES:
            _COUNTS.clear()
        for i, n in zip(new, count([pieces.distinct[i] for i in new])):
            known[i] = n
            if len(pieces.distinct[i]) <= PIECE_CHARS:
                _COUNTS[pieces.distinct[i]] = n
    sums = np.zeros(len(pieces.index) + 1, np.int64)
    np.cumsum(np.array(known, np.int64)[pieces.index], out=sums[1:])
    return sums[pieces.first[1:]] - sums[pieces.first[:-1]]


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > `limit`) of every row of `docs`.

    `tokenizer` is the path of a vocabulary file on the driver; its bytes, a few
    megabytes, are broadcast, so that executors need no file of their own.
    """
    with open(tokenizer, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    return docs.select(key, text).mapInArrow(
        _batches(os.path.splitext(tokenizer)[1], model, text, key, limit),
        "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    )
