"""Sub-word ids of whole texts and back, by a table of distinct chunks."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabloom.llm.common import ChunkTable, append_columns, kept_in_worker

_MARK = "▁"
_CHUNK = re.compile(" +[^ ]*")


def _load(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def check_model(processor) -> None:
    """Raise unless no piece crosses a whitespace marker, which the method rests on."""
    for i in range(processor.get_piece_size()):
        if _MARK in processor.id_to_piece(i).lstrip(_MARK):
            raise ValueError("a piece crosses a whitespace marker; chunks would not be independent")


def split_chunks(text: str) -> list[str]:
    """Cut a text in front of each run of spaces that follows another character.

    The space in front of each chunk (for the first the one that the library adds) is left out; a
    literal marker counts as a space, as in the library.
    """
    text = text.replace(_MARK, " ")
    if not text:
        return []
    words = text.split(" ")
    if "" in words and "" in words[:-1]:
        return [c[1:] for c in _CHUNK.findall(" " + text)]
    return words


def _table(model: str) -> ChunkTable:
    processor = _load(model)
    check_model(processor)
    lone = processor.piece_to_id(_MARK)

    def segment(chunks: list[str]) -> list[list[int]]:
        # The library adds the marker in front of a text, but not in front of an empty one.
        coded = processor.encode(chunks, num_threads=1)
        return [c if chunk else [lone] for chunk, c in zip(chunks, coded, strict=True)]

    return ChunkTable(segment)


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each whole text as an array column.

    `model` is the path of a sentencepiece model on every machine. Same ids as the library's encode()
    without begin and end ids. NULL and empty texts give an empty array. Each task segments every
    distinct chunk once and gathers ids by position; nothing is shuffled. An existing column of the
    name in `ids` is replaced.
    """

    def start():
        table = kept_in_worker(("pieces", model), lambda: _table(model))

        def work(column: pa.Array) -> list[pa.Array]:
            flat, bounds = table.ids([split_chunks(t or "") for t in column.to_pylist()])
            return [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))]

        return work

    return append_columns(df, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], start)


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that the library's decode() gives for each array of ids; NULL gives an empty text."""

    def start():
        processor = _load(model)

        def work(column: pa.Array) -> list[pa.Array]:
            out = [processor.decode(x) if x else "" for x in column.to_pylist()]
            return [pa.array(out, pa.string())]

        return work

    return append_columns(df, ids, [T.StructField(text, T.StringType())], start)
