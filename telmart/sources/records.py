"""Cutting raw text into JSON records, whatever the layout, without losing any.

Lines that are one object each, one array of items and one single object are told apart and
cut by column expressions. Any other text (objects in a row, several on a line, arrays
with a broken item, cut lines, anything that is no JSON) goes through a scanner of
top-level values. It takes time in proportion to the text, however long a line is, and works
in Arrow batches, which clean texts reach as nulls.

``texts_of`` reads whole only the files that need it, unless told to read every file so: where every line ends
with its values, a file is read, and split, line by line, whatever its size. Large files that need it, and lines
that are large themselves, go through the scanner piece by piece: a task holds one value of them.

The scanner returns every top-level object, and every item of a top-level array, as a
record. A value that is no JSON becomes a record of its own, so its text is kept: up to
where its brackets close, else up to the next line that starts a value and is indented
no further. What is not part of a value runs to the end of its line.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from functools import reduce
from json import JSONDecoder

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmart.session import split_wide_code

# The scanner travels with its code, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MALFORMED = "malformed_text"
RESCUED = "rescued_fields"
PLAIN = "__plain"

# After a closing bracket: something other than a separator, or a comma and no key. Only
# such a text can hold more than one value (one with brackets in its strings may not).
_MORE_THAN_ONE = r'[}\]]\s*(?:[^\s,}\]]|,\s*[^\s"])'
_MORE_THAN_AN_ARRAY = r"\]\s*(?:[^\s,}\]]|,\s*[\[{])"
_BLANK = " \t\r\n﻿"
_BLANK_SQL = r"' \t\r\n\uFEFF'"


def _cutter() -> Callable[[str, str, bool], tuple[list[str], int]]:
    """A function that cuts a text, or the beginning of one, into records.

    It takes the text, what came before it in its first line (see ``_line_start``) and whether it is
    complete. It returns the records and where the first value starts, if any, whose end takes more text to find.
    """
    decode = JSONDecoder().raw_decode
    between = re.compile("[\\s,\\[\\]﻿]*")
    after_scalar = re.compile(r"[ \t\r]*(?:[,\]\n]|$)")
    # A string that the text's end cuts off has a group: it may go on.
    bracket = re.compile(r'"(?:[^"\\\n]|\\.)*(?:"|(\\?\Z))|[{}\[\]]')
    closed_bracket = re.compile(r'"(?:[^"\\\n]|\\.)*"|[{}\[\]]')

    def end_of_broken(text: str, at: int, head: str, complete: bool) -> int:
        """Where an object that is no JSON ends; -1 if that takes more text."""
        line = text.rfind("\n", 0, at) + 1
        before = text[line:at] if line else head + text[:at]
        indent = len(before) - len(before.lstrip(" \t"))
        following = re.compile(r"\n[ \t]{0,%d}(?=[\[{\]])" % min(indent, 60_000)).search(text, at)
        end, depth = following.start() if following else len(text), 0
        known = complete or following
        for found in (closed_bracket if known else bracket).finditer(text, at, end):
            if found[0][0] == '"':
                if not known and found[1] is not None:
                    return -1
                continue
            depth += {"{": 1, "[": 1}.get(found[0], -1)
            if depth <= 0:
                return found.end()
        return end if known else -1

    def end_of_value(text: str, at: int, head: str, complete: bool) -> int:
        """Where the value that starts here ends; -1 if that takes more text."""
        try:
            _, end = decode(text, at)
        except (ValueError, RecursionError) as error:
            end = -1
            # An error at the end of the text, or a string without one, may be due to what is missing.
            cut_off = getattr(error, "pos", 0) >= len(text) - 16 or "Unterminated" in str(error)
            if text[at] == "{" and cut_off and not complete:
                return -1
        if text[at] == "{":
            return end if end > 0 else end_of_broken(text, at, head, complete)
        after = after_scalar.match(text, end) if end > 0 and text[at] != '"' else None
        if after and (complete or after[0][-1:] in (",", "]", "\n")):
            return end
        newline = text.find("\n", at)
        return newline if newline >= 0 else len(text) if complete else -1

    def cut(text: str, head: str, complete: bool) -> tuple[list[str], int]:
        records, at = [], 0
        while True:
            at = between.match(text, at).end()
            end = end_of_value(text, at, head, complete) if at < len(text) else -1
            if end < 0:
                return records, at
            records.append(text[at:end].rstrip())
            at = end

    return cut


def scanner() -> Callable[[str], list[str]]:
    """A function that cuts one text into records."""
    cut = _cutter()
    return lambda text: cut(text, "", True)[0]


def _line_start(text: str, head: str) -> str:
    """What tells how far the last line of a text is indented: its blanks, and a letter if something follows them."""
    newline = text.rfind("\n") + 1
    line = text[newline:] if newline else head + text
    bare = line.lstrip(" \t")
    return line[: len(line) - len(bare)] + bare[:1]


def piecewise_cutter(whole: bool) -> Callable[[str, bool], list[str]]:
    """A function that takes a text piece by piece, and whether a piece is the last, and returns the records that end in it.

    They are those of ``scanner``, of the text or, unless ``whole``, of its lines. No more is held than a
    value and a piece.
    """
    cut, line_end = _cutter(), re.compile("\r\n?|\n")
    left, head, enough = "", "", 0

    def feed(piece: str, last: bool = False) -> list[str]:
        nonlocal left, head, enough
        left += piece
        # A value that needs more text is not tried again before the text is twice as long, so time stays in proportion.
        if len(left) < enough and not last:
            return []
        *lines, rest = [left] if whole else line_end.split(left)
        found = []
        for line in lines:
            found += cut(line, head, True)[0]
            head = ""
        records, at = cut(rest, head, last)
        head, left = _line_start(rest[:at], head), rest[at:]
        enough = 2 * len(left)
        return found + records

    return feed


def cut_records(text: Column) -> Column:
    """Records of a text through the scanner; null stays null."""

    def of(texts: pd.Series) -> pd.Series:
        cut = scanner()
        return pd.Series([None if t is None else cut(t) for t in texts], dtype=object)

    return F.pandas_udf(of, T.ArrayType(T.StringType()))(text)


def _is_plain(text: Column) -> Column:
    """Whether a text has at most one value, and that an object."""
    return text.startswith("{") & text.endswith("}") & ~text.rlike(_MORE_THAN_ONE)


def _items(text: Column) -> Column:
    """Items of a JSON array as texts; null if it is none."""
    items = F.from_json(text, T.ArrayType(T.StringType()))
    return F.transform(items, lambda item: F.coalesce(item, F.lit("null")))


def with_plain(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines with a flag for those that ``line_records`` need not cut, so it is worked out once a line."""
    return lines.withColumn(PLAIN, _is_plain(F.col(text)))


def line_records(text: str = "value", plain: Column | None = None) -> Column:
    """JSON texts of the records in one line; the scanner gets only what is no clean line.

    ``plain`` is the flag of ``with_plain``, where the lines have it.
    """
    line = F.col(text)
    bare = F.trim(line, F.lit(_BLANK))
    plain = _is_plain(line) if plain is None else plain
    items = F.when(bare.startswith("{"), _items(F.concat(F.lit("["), bare, F.lit("]")))).when(
        bare.startswith("[") & bare.endswith("]") & ~bare.rlike(_MORE_THAN_AN_ARRAY), _items(bare)
    )
    # Most lines are plain, and for them no other branch is worked out. A branch of its own and not one
    # condition, as Spark works out ahead what occurs twice in that.
    scanned = cut_records(F.when(~plain, F.when((bare != "") & items.isNull(), bare)))
    return F.when(plain, F.array(line)).otherwise(F.coalesce(items, scanned))


# A string, complete; and what is nothing but the brackets of arrays.
_A_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_BRACKETS = r"^[\[\]][\s,\[\]]*$"


def ends_with_line(text: str = "value") -> Column:
    """Whether no value of a line goes on in the next one, if that, too, is such a line.

    Such a line starts with an object or is nothing but brackets. An object that is open at the
    end of its line could go on with one only after a colon or in an array, and not in the middle of a string.
    So a text of such lines has the same records line by line as read whole.
    """
    line = F.rtrim(F.col(text), F.lit(_BLANK))
    outside = F.regexp_replace(line, _A_STRING, "s")
    closed = outside.contains('"') | ~(outside.endswith(":") | outside.contains("["))
    return (line == "") | _is_plain(line) | (line.startswith("{") & closed) | line.rlike(_BRACKETS)


def file_records(text: str = "value") -> Column:
    """JSON texts of the records in a whole file."""
    body = F.trim(F.col(text), F.lit(_BLANK))
    lines = F.filter(F.transform(F.split(body, "\n"), lambda line: F.trim(line, F.lit(_BLANK))), lambda line: line != "")
    items = _items(body)
    is_lines = (body != "") & F.forall(lines, _is_plain)
    is_array = (
        body.startswith("[") & body.endswith("]") & ~body.rlike(_MORE_THAN_AN_ARRAY) & items.isNotNull()
    )
    is_object = _is_plain(body) & F.json_object_keys(body).isNotNull()
    known = is_lines | is_array | is_object
    return (
        F.when(is_lines, lines)
        .when(is_array, items)
        .when(is_object, F.array(body))
        .otherwise(cut_records(F.when(~known, body)))
    )


# Up to this many file names are written into a plan.
MAX_WHOLE_FILES = 10_000

# Texts above this many bytes, lines or files, are not held whole.
LONGEST_TEXT = 8 * 1024 * 1024
_LONGEST_LINE = "mapreduce.input.linerecordreader.line.maxlength"

_PATH, _SIZE = "_metadata.file_path", "_metadata.file_size"
# The size of a packed file does not tell how much text it has, so these are read as if they had little.
_PACKED = r"\.(?:gz|bz2|deflate|lz4|snappy|zst|zstd)$"

Scan = Callable[[dict], DataFrame]


def _is_large() -> Column:
    return (F.col(_SIZE) > LONGEST_TEXT) & ~F.col(_PATH).rlike(_PACKED)


def _judged(scan: Scan, whole_files: bool) -> DataFrame:
    """Files, whether they are large and whether all of their lines can be read one by one.

    Without ``whole_files`` only large ones are looked at. Lines above the limit are skipped by the
    reader, or cut, which the sum of what it did read tells; so none is held here.
    """

    def looked_at(lines: DataFrame) -> DataFrame:
        size = F.octet_length("value")
        # A line that the reader cut counts as long and is not judged.
        ends = F.when(size < LONGEST_TEXT - 1, ends_with_line()).otherwise(False)
        return lines.groupBy(F.col(_PATH).alias("path"), F.col(_SIZE).alias("size")).agg(
            F.every(ends).alias("by_line"), F.max(size).alias("longest"), F.sum(size + 1).alias("read")
        )

    short = (F.col("longest") < LONGEST_TEXT - 1) & (F.col("read") - F.col("size")).isin(0, 1)
    large = scan({"lineSep": "\n", _LONGEST_LINE: LONGEST_TEXT}).filter(_is_large())
    # One row for each of them, also if the reader has skipped all there is.
    listed = scan({"format": "binaryFile"}).filter(_is_large()).select(F.col(_PATH).alias("path"))
    ends = F.col("by_line") if whole_files else F.lit(True)
    found = listed.join(looked_at(large), "path", "left").select(
        "path", F.lit(True).alias("large"), F.coalesce(short & ends, F.lit(False)).alias("by_line")
    )
    if not whole_files:
        return found
    small = looked_at(scan({"lineSep": "\n"}).filter(~_is_large()))
    return found.unionByName(small.select("path", F.lit(False).alias("large"), "by_line"))


def texts_of(
    scan: Scan, whole_files: bool, lineage: Callable[[DataFrame], DataFrame], every_file: bool = False
) -> list[tuple[DataFrame, Column]]:
    """Texts of files and how to cut them into records: by lines, or file by file where that is needed.

    ``scan(options)`` reads the files as text, ``lineage`` adds columns of each file. With
    ``whole_files``, a pass over the lines finds the files with values that go on over lines,
    and only those are read whole (all of them, if there are more than a plan can name, or with ``every_file``).
    Where that is much text, or a line is, it is cut piece by piece, see ``_cut_in_pieces``.
    """
    lines, by_line = scan({"lineSep": "\n"} if whole_files else {}), line_records(plain=F.col(PLAIN))
    texts = scan({"wholetext": True})
    if every_file and whole_files:
        return [(lineage(texts.filter(~_is_large())), file_records()), _cut_in_pieces(scan, _is_large(), True, lineage)]
    others = _judged(scan, whole_files).filter("not by_line").select("path", "large").limit(MAX_WHOLE_FILES + 1).collect()
    if not others:
        return [(with_plain(lineage(lines)), by_line)]
    if len(others) > MAX_WHOLE_FILES:
        rest = (lineage(texts.filter(~_is_large())), file_records()) if whole_files else (
            with_plain(lineage(lines.filter(~_is_large()))), by_line)
        return [rest, _cut_in_pieces(scan, _is_large(), whole_files, lineage)]
    # Spark prunes files by their names before it reads any.
    parts = [(with_plain(lineage(lines.filter(~F.col(_PATH).isin([r["path"] for r in others])))), by_line)]
    whole, large = ([r["path"] for r in others if r["large"] == wanted] for wanted in (False, True))
    if whole:
        parts.append((lineage(texts.filter(F.col(_PATH).isin(whole))), file_records()))
    if large:
        parts.append(_cut_in_pieces(scan, F.col(_PATH).isin(large), whole_files, lineage))
    return parts


def _cut_in_pieces(
    scan: Scan, chosen: Column, whole: bool, lineage: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, Column]:
    """Records of the chosen files, cut while they are read, so a task holds a value and not a file or line.

    The files are split, and read up to each closing brace; the pieces are sorted into their order, a file a task.
    """
    pieces = lineage(scan({"lineSep": "}"}).filter(chosen).select("*", "_metadata"))
    others = [c for c in pieces.columns if c not in ("value", "_metadata")]
    place = ["__file", "__block", "__at"]
    ordered = (
        pieces.select(
            F.col("value").cast("binary").alias("value"), *[F.col(f"`{c}`") for c in others],
            F.col(_PATH).alias("__file"), F.col(_SIZE).alias("__size"),
            F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"),
        )
        .repartition("__file")
        .sortWithinPartitions(*place)
    )

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file = None

        def frame(records: list[str]) -> Iterator[pd.DataFrame]:
            for at in range(0, len(records), 4_096):
                yield pd.DataFrame({"value": records[at : at + 4_096]}, dtype=object).assign(**lineage_of)

        def rest() -> list[str]:
            # The last piece ends with a brace if its file is as long as all of them with theirs, less a byte order mark.
            return feed("}" if size - read in (0, 3) else "", True)

        for rows in frames:
            for name, run in rows.groupby("__file", sort=False):
                if name != file:
                    if file is not None:
                        yield from frame(rest())
                    file, size, read, feed = name, run["__size"].iloc[0], 0, piecewise_cutter(whole)
                    lineage_of = {c: run[c].iloc[0] for c in others}
                else:
                    yield from frame(feed("}"))
                texts = list(run["value"])
                read += sum(map(len, texts)) + len(texts)
                yield from frame(feed(b"}".join(texts).decode("utf-8", "replace")))
        if file is not None:
            yield from frame(rest())

    records = T.StructType([T.StructField("value", T.StringType()), *[pieces.schema[c] for c in others]])
    return ordered.mapInPandas(cut, records), F.array("value")


def _fields(text: Column) -> Column:
    """The fields of a JSON object and their texts."""
    return F.from_json(text, T.MapType(T.StringType(), T.StringType()))


def _not_named(fields: Column, names: list[str]) -> Column:
    known = F.array(*[F.lit(n) for n in names])
    return F.map_filter(fields, lambda name, text: ~F.array_contains(known, name))


def _below(path: str, fields: Column) -> Column:
    return F.transform_keys(fields, lambda name, text: F.concat(F.lit(f"{path}."), name))


_KEYS, _INNER = "__keys", "__inner"


def _structs(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if isinstance(f.dataType, T.StructType)]


def _with_names(read: DataFrame, schema: T.StructType) -> DataFrame:
    """Records with the names of their fields and their structs as maps, each read once a record."""
    named = read.withColumn(_KEYS, F.json_object_keys("value"))
    maps = T.StructType([T.StructField(f.name, T.MapType(T.StringType(), T.StringType())) for f in _structs(schema)])
    return named.withColumn(_INNER, F.from_json("value", maps)) if len(maps) else named


def _unknown_fields(value: Column, record: Column, schema: T.StructType) -> Column:
    """Fields, as text, that the schema lacks or that are no struct where it has one; for ``_with_names``."""
    found = _fields(value)
    parts = [_not_named(found, schema.names)]
    for field in _structs(schema):
        text = F.element_at(found, F.lit(field.name))
        parts.append(_below(field.name, _not_named(_fields(text), field.dataType.names)))
        no_struct = text.isNotNull() & record.getField(field.name).isNull()
        parts.append(F.when(no_struct, F.create_map(F.lit(field.name), text)))
    none = F.create_map().cast("map<string,string>")
    together = F.map_concat(*[F.coalesce(p, none) for p in parts])
    unknown = F.when(F.cardinality(together) > 0, together)
    # Mostly names tell that there are none, and reading them takes a fraction of the time of reading all fields' texts.
    return F.when(F.coalesce(~_all_known(value, record, schema), F.lit(True)), unknown)


def _all_known(value: Column, record: Column, schema: T.StructType) -> Column:
    """Whether the schema has all fields of an object, those of its structs, too, and all its structs are some."""

    def named(keys: Column, names: list[str]) -> Column:
        return F.forall(keys, lambda name: name.isin(*names))

    keys, known = F.col(_KEYS), named(F.col(_KEYS), schema.names)
    if _structs(schema):
        # Of a name that comes twice the record has the last field, the map of texts above the first one.
        known = known & (F.size(F.array_distinct(keys)) == F.size(keys))
    for field in _structs(schema):
        inner = F.col(_INNER).getField(field.name)
        none = ~F.array_contains(keys, field.name) | F.get_json_object(value, f"$['{field.name}']").isNull()
        inside = record.getField(field.name).isNotNull() & named(F.map_keys(inner), field.dataType.names)
        known = known & F.when(inner.isNull(), none).otherwise(inside)
    return known


def read_records(
    scan: Scan,
    whole_files: bool,
    schema: T.StructType,
    keep_malformed: bool = False,
    keep_rescued: bool = False,
    lineage: Callable[[DataFrame], DataFrame] = lambda texts: texts,
    every_file: bool = False,
) -> DataFrame:
    """All records of files, see ``texts_of`` and ``parsed``."""
    parts = [
        parsed(texts, records, schema, keep_malformed, keep_rescued)
        for texts, records in texts_of(scan, whole_files, lineage, every_file)
    ]
    return reduce(DataFrame.unionByName, parts)


def parsed(
    texts: DataFrame,
    records: Column,
    schema: T.StructType,
    keep_malformed: bool = False,
    keep_rescued: bool = False,
) -> DataFrame:
    """The records of column ``value`` as columns of ``schema``, with all other columns.

    A record that is no JSON object of the schema becomes a row of nulls, also in part where
    only part of it is wrong. ``keep_malformed`` adds its text as ``malformed_text``.
    ``keep_rescued`` adds ``rescued_fields``, a map of the fields that the schema does not
    know (those inside structs by their path), and of structs that are none, to their text.
    """
    split_wide_code(texts.sparkSession)
    others = [c for c in texts.columns if c not in ("value", PLAIN)]
    marked = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    one = texts.select(F.explode(records).alias("value"), *[F.col(f"`{c}`") for c in others])
    read = one.withColumn(
        "record", F.from_json("value", marked if keep_malformed else schema, {"columnNameOfCorruptRecord": MALFORMED})
    )
    read = _with_names(read, schema) if keep_rescued else read
    columns = [F.col(f"record.`{f.name}`").alias(f.name) for f in schema.fields]
    if keep_malformed:
        none = F.when(F.col("record").isNull(), F.col("value"))
        columns.append(F.coalesce(F.col(f"record.`{MALFORMED}`"), none).alias(MALFORMED))
    if keep_rescued:
        columns.append(_unknown_fields(F.col("value"), F.col("record"), schema).alias(RESCUED))
    return read.select(*columns, *[F.col(f"`{c}`") for c in others])
