"""Byte-level BPE over overlapping chunks, and its inverse.

A text longer than ``CHUNK_CHARS`` is cut into chunks that overlap. Chunks are dealt to
tasks and pre-tokenised in parallel. A chunk may begin inside a pre-token, so its first
boundaries can be wrong; but once it shares a boundary with the scan of the chunk before,
both go on alike. The first boundary that both have in the overlap is where the two are
stitched; each piece between stitches is encoded on its own and a document's ids are the
pieces' ids in order. Where an overlap has no common boundary (one pre-token spans it) the
two chunks make one piece, so nothing depends on luck. Shorter texts are one piece and
never leave their task.

A stitch must follow a character that is not white space: a run of white space at the end
of a piece would be split differently. The last few characters of a chunk are not trusted,
as what follows could change their boundaries.

Decoding concatenates the tokens' bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 10
_CHUNKS = 64  # of a long text that are handed on at once
_ROWS = 256  # encoded before they are handed on
_UNSURE = 4  # characters at the end of a chunk whose boundaries are not trusted


class Codec:
    """A rank file's contents and its pattern; travels to tasks, opens no file there."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as file:
            return cls(file.read(), pattern)

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "pattern": self.pattern}

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=table, special_tokens={})

    @cached_property
    def pre_tokens(self) -> regex.Pattern:
        return regex.compile(self.pattern)

    def encode(self, text: str | None) -> list[int]:
        return self.encoding.encode_ordinary(text) if text else []

    def decode(self, ids) -> bytes:
        return self.encoding.decode_bytes(ids)

    def boundaries(self, text: str) -> list[int]:
        """Starts of pre-tokens, except at white space's end."""
        starts = (m.start() for m in self.pre_tokens.finditer(text))
        return [p for p in starts if p and not text[p - 1].isspace()]


def _is_long(text: Column, chunk_chars: int) -> Column:
    return F.coalesce(F.length(text) > chunk_chars, F.lit(False))


def long_pieces(
    docs: DataFrame, key_col: str, text_col: str, codec: Codec,
    chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """(key, piece number, piece text) of texts that are longer than a chunk.

    The pieces of a text, in order, make up the text; encoded one by one they give the
    ids of the whole.
    """
    kind = docs.schema[key_col].dataType.simpleString()
    texts = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One pass over a text, a few chunks handed on at a time: a substring expression would
        # walk from the text's start to every chunk.
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                starts = range(0, len(text), chunk_chars)
                for first in range(0, len(starts), _CHUNKS):
                    some = starts[first : first + _CHUNKS]
                    parts = [text[at : at + chunk_chars + overlap_chars] for at in some]
                    yield pd.DataFrame({"key": key, "k": range(first, first + len(some)), "chunk": parts})

    chunks = texts.mapInPandas(cut, f"key {kind}, k int, chunk string")

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            head, tail = [], []
            for t in texts:
                found = codec.boundaries(t)
                head.append([p for p in found if p <= overlap_chars])
                tail.append([p - chunk_chars for p in found if chunk_chars <= p <= len(t) - _UNSURE])
            yield pd.DataFrame({"head": head, "tail": tail})

    scanned = chunks.repartition("key", "k").withColumn(
        "scan", F.pandas_udf(scan, "head array<int>, tail array<int>")("chunk")
    )
    in_text = Window.partitionBy("key").orderBy("k")
    stitch = F.array_min(F.array_intersect("scan.head", F.lag("scan.tail").over(in_text)))
    # At the start of chunk 0 there is nothing to stitch to; null elsewhere: no common boundary.
    stitched = scanned.withColumn("stitch", F.when(F.col("k") == 0, F.lit(0)).otherwise(stitch))
    begin = F.coalesce("stitch", F.lit(0))
    more = F.lead("stitch").over(in_text)
    end = F.when(F.lead("k").over(in_text).isNull(), F.length("chunk")).otherwise(
        F.lit(chunk_chars) + F.coalesce(more, F.lit(0))
    )
    parts = stitched.select(
        "key", "k",
        F.count("stitch").over(in_text).alias("piece"),
        F.substring("chunk", begin + 1, F.greatest(end - begin, F.lit(0))).alias("part"),
    )
    return parts.groupBy("key", "piece").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda x: x["part"]), ""
        ).alias("text")
    )


@dataclass(frozen=True)
class Outcome:
    """What is handed on of a text's ids: columns, and their values for a list of ids."""

    ddl: str
    values: Callable[[Codec, list[int]], tuple]


#: Four bytes an id: lists of a whole batch would take ten times as much.
IDS = Outcome("ids array<int>", lambda codec, ids: (np.array(ids, np.int32),))


def _of_texts(texts: DataFrame, codec: Codec, outcome: Outcome) -> DataFrame:
    """Replace column text by the outcome of its ids.

    Not a column function: Spark would encode once per use of such a column.
    """
    return _mapped(texts, "text", lambda text: outcome.values(codec, codec.encode(text)), outcome.ddl)


def _of_ids(encoded: DataFrame, codec: Codec, outcome: Outcome) -> DataFrame:
    return _mapped(encoded, "ids", lambda ids: outcome.values(codec, ids.tolist()), outcome.ddl)


def _mapped(df: DataFrame, column: str, values: Callable, ddl: str) -> DataFrame:
    """Replace a column by others, a few rows at a time."""
    others = [f for f in df.schema.fields if f.name != column]
    names = [part.split()[0] for part in ddl.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                part = batch.iloc[start : start + _ROWS]
                made = zip(*map(values, part[column]))
                more = {n: pd.Series(list(v), part.index, dtype=object) for n, v in zip(names, made)}
                yield part.drop(columns=column).assign(**more)

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in others]
    return df.mapInPandas(rows, ", ".join([*kept, ddl]))


def encode(
    docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS, outcome: Outcome = IDS,
) -> DataFrame:
    """One row per row of ``docs``: the id and ``ids`` (array of int, empty for null or empty text).

    Another ``outcome`` gives its columns instead, without the ids ever leaving their task
    unless the text is a long one. Repeated rows get equal answers; other columns are not
    looked at.
    """
    # Ids are text on their way through pandas, which has no integers beside nulls.
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = _of_texts(rows.where(~_is_long(F.col("text"), chunk_chars)), codec, outcome)
    long = rows.where(_is_long(F.col("text"), chunk_chars))
    keyed = long.select("text", "id", F.sha2("text", 256).alias("key"))
    texts = keyed.dropDuplicates(["key"])
    pieces = long_pieces(texts, "key", "text", codec, chunk_chars, overlap_chars)
    encoded = _of_texts(pieces.select("key", "piece", "text"), codec, IDS)
    whole = encoded.groupBy("key").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"])
        ).alias("ids")
    )
    found = whole if outcome is IDS else _of_ids(whole, codec, outcome)
    every = short.unionByName(keyed.select("id", "key").join(found, "key").drop("key"))
    return every.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, codec: Codec, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for; null ids give null."""

    def joined(ids: pd.Series) -> pd.Series:
        return pd.Series([None if i is None else codec.decode(i.tolist()) for i in ids])

    return encoded.withColumn(to, F.pandas_udf(joined, "binary")(ids_col))
