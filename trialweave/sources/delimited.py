"""Pipe-delimited text with a header row: every column a string, empty fields null.

Quoted fields may hold delimiters, newlines and doubled quotes; other fields may hold quotes anywhere
but at their beginning.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_DIALECT = {"sep": "|", "nullValue": "", "escape": '"'}

_INSIDE = '[^"]*+(?:""[^"]*+)*+'
_FIELD = f'(?:"{_INSIDE}"|[^"|][^|]*+|)'
# How a line can go on, by whether it begins between records or inside a quoted field.
_BETWEEN_TO_BETWEEN = f"^{_FIELD}(?:[|]{_FIELD})*+$"
_BETWEEN_TO_INSIDE = f'^(?:{_FIELD}[|])*+"{_INSIDE}$'
_INSIDE_TO_BETWEEN = f'^{_INSIDE}"(?:[|]{_FIELD})*+$'
_INSIDE_TO_INSIDE = f'^{_INSIDE}(?:"[|](?:{_FIELD}[|])*+"{_INSIDE})?+$'


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """Spark's own reader. Columns are bound by header name and only those selected are parsed.

    Because fields may hold newlines it cannot split a file, so each file is one task.
    """
    return spark.read.options(header=True, multiLine=True, **_DIALECT).csv(path)


def read_delimited_split(spark: SparkSession, path: str, max_record_chars: int | None = None) -> DataFrame:
    """The same rows, with every file read in many tasks.

    Every line is checked by itself: from either state (between records, inside a quoted field) it is
    sound or not, and leads to one of them. A first pass follows the lines of each split from both states
    and reports one row per split: where either state leads, and between which lines its first and last
    record end. Put together in order, these rows settle the state every split begins in. The second pass
    then joins the lines of a record where they stand; lines cross a shuffle only if their record
    spans splits. The driver holds the one row per split. Where the first pass saw every line turn the
    state if and only if it holds an odd number of quotes, the second one counts quotes and checks no
    line again.

    Refused are a line that is not sound from its state, a file that ends inside a field and a carriage
    return anywhere but at the end of a record. A lost quote can also make one long record of many;
    ``max_record_chars`` refuses records that are longer. The length of every record is known from the first
    pass, so none is put together before. Without it records may have any length, as in
    :func:`read_delimited`.

    Where every line is a sound record by itself, none can begin inside a field. Spark's reader then
    splits files by itself and gives the same rows, so it is used. That look stops at the first other
    line.
    """
    text = spark.read.text(path, lineSep="\n")
    alone = ~F.col("value").contains("\r") & (
        ~F.col("value").contains('"') | F.col("value").rlike(_BETWEEN_TO_BETWEEN)
    )
    if max_record_chars is not None:
        alone &= F.length("value") < max_record_chars
    if text.filter(~alone).isEmpty():
        return spark.read.options(header=True, **_DIALECT).csv(path)

    header = read_delimited(spark, path).columns
    lines = _lines(text)
    summaries = lines.drop("line").mapInArrow(_summaries, _SUMMARY).collect()
    splits = _settled(summaries, max_record_chars)
    lines = _lines(text, all(split.plain for split in splits.values()))

    def whole(batches):
        return _whole_records(batches, splits)

    def pieces(batches):
        return _pieces(batches, splits)

    records = lines.drop("chars", "odd").mapInArrow(whole, "text string")
    if any(split.head or split.tail for split in splits.values()):
        parts = lines.select("file", "start", "line").mapInArrow(
            pieces, "file long, opener long, start long, n long, line string"
        )
        joined = parts.groupBy("file", "opener").agg(
            F.array_join(F.array_sort(F.collect_list(F.struct("start", "n", "line")))["line"], "\n").alias("text")
        )
        records = records.unionByName(joined.select("text"))
    names = ", ".join("`" + name.replace("`", "``") + "` string" for name in header)
    parsed = F.from_csv("text", names, {**_DIALECT, "multiLine": "true"})
    return records.filter(F.col("text") != "").select(parsed.alias("record")).select("record.*")


def _lines(text: DataFrame, plain: bool = False) -> DataFrame:
    """(file, start, line, chars, odd, between, inside): each line with whether its quotes are odd in number
    and where it leads from either state, -1 if it is not sound from there. Rows of a split stand together,
    in order.

    Patterns are dear, so each is tried only on lines that hold what it needs; with ``plain`` none is, and
    odd quotes alone turn the state.
    """
    line = F.col("line")
    odd = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))) % 2
    # A carriage return may only end a record, so a line with one cannot lead into a field.
    clean, stays = ~line.contains("\r"), ~F.col("returns")
    # A quoted field begins at the line's beginning or behind a delimiter. Without one all fields are sound.
    begins_behind = line.contains('|"')
    begins = line.startswith('"') | begins_behind
    # It ends before a delimiter or at the end, where a pattern lets one more separator of lines follow.
    ends_before = line.contains('"|')
    ends = ends_before | F.right(line, F.lit(2)).contains('"')
    # Inside a field every quote is doubled, else the field ends here.
    doubled = ~F.replace(line, F.lit('""'), F.lit("")).contains('"')
    between = (
        F.when(clean & (~begins | (ends & line.rlike(_BETWEEN_TO_BETWEEN))), 0)
        .when(clean & stays & begins & line.rlike(_BETWEEN_TO_INSIDE), 1)
        .otherwise(-1)
    )
    inside = (
        F.when(clean & stays & (doubled | (ends_before & begins_behind & line.rlike(_INSIDE_TO_INSIDE))), 1)
        .when(clean & ends & ~doubled & line.rlike(_INSIDE_TO_BETWEEN), 0)
        .otherwise(-1)
    )
    if plain:
        between, inside = odd, 1 - odd
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.when(F.col("value").contains("\r"), F.regexp_replace("value", "\r$", ""))
        .otherwise(F.col("value")).alias("line"),
        F.col("value").endswith("\r").alias("returns"),
    ).select(
        "file", "start", "line", (F.length("line") + 1).alias("chars"), odd.cast("byte").alias("odd"),
        between.cast("byte").alias("between"), inside.cast("byte").alias("inside"),
    )


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Batches cut where a split begins: (file, start, rows)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch.column(name).to_numpy() for name in ("file", "start"))
        borders = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for low, high in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows]):
            yield int(file[low]), int(start[low]), batch.slice(low, high - low)


def _states_after(between: np.ndarray, inside: np.ndarray, state: int) -> np.ndarray:
    """The state behind every line if ``state`` stands before the first; -1 where a line is not sound.

    A line keeps the state before it, turns it round, or settles it: the state behind a line is the last
    settled one, turned as often as there were turns since. What follows an unsound line counts for nothing.
    """
    turn = (between == 1) & (inside == 0)
    settles = ~turn & ~((between == 0) & (inside == 1))
    value = np.where(between >= 0, between, np.maximum(inside, 0)).astype(np.int64)
    turned = np.cumsum(turn)
    last = np.maximum.accumulate(np.where(settles, np.arange(len(turn)), -1))
    behind = np.where(last >= 0, value[last] + turned - turned[last], state + turned) % 2
    before = np.r_[state, behind[:-1]]
    return np.where(before == 0, between, inside)


_SIDE = ("end", "first", "last", "head", "rest", "longest", "plain")
_SUMMARY = "file long, start long, lines long, " + ", ".join(
    f"{name}{state} long" for state in (0, 1) for name in _SIDE
)


@dataclass
class _Side:
    """What is known of a split that begins in a given state, line by line."""

    end: int  # the state behind the last line, -1 once a line was not sound
    first: int = 0  # number of the first line that ends a record, 0 if none does
    last: int = 0
    head: int = 0  # characters up to the first end of a record
    rest: int = 0  # characters since the last end
    longest: int = 0  # of the records between
    plain: int = 1  # whether lines turned the state just where their quotes are odd in number

    def follow(
        self, between: np.ndarray, inside: np.ndarray, odd: np.ndarray, chars: np.ndarray, n: int
    ) -> None:
        if self.end < 0:
            return
        after = _states_after(between, inside, self.end)
        self.plain &= int(np.array_equal(after, (self.end + np.cumsum(odd)) % 2))
        ends = np.flatnonzero(after == 0)
        read = np.cumsum(chars)
        if len(ends):
            lengths = np.diff(read[ends], prepend=-self.rest)
            if not self.first:
                self.first, self.head = n + int(ends[0]) + 1, int(lengths[0])
                lengths = lengths[1:]
            self.longest = max(self.longest, int(lengths.max(initial=0)))
            self.last, self.rest = n + int(ends[-1]) + 1, int(read[-1] - read[ends[-1]])
        else:
            self.rest += int(read[-1])
        self.end = -1 if (after < 0).any() else int(after[-1])


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split, under either beginning."""

    def row(split, n, sides):
        values = [*split, n, *(getattr(side, name) for side in sides for name in _SIDE)]
        names = ["file", "start", "lines", *(f"{name}{state}" for state in (0, 1) for name in _SIDE)]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], names)

    split, n, sides = None, 0, []
    for file, start, part in _parts(batches):
        if split != (file, start):
            if split:
                yield row(split, n, sides)
            split, n, sides = (file, start), 0, [_Side(0), _Side(1)]
        columns = [part.column(name).to_numpy() for name in ("between", "inside", "odd", "chars")]
        for side in sides:
            side.follow(*columns, n)
        n += part.num_rows
    if split:
        yield row(split, n, sides)


@dataclass
class _Split:
    """A split whose beginning is settled; lines are numbered from 1."""

    state: int  # at its beginning, -1 behind an unsound line
    begin: int = 0  # the last line before its own records (a record begun earlier, the header)
    last: int = 0  # the last line of its own records
    head: int = 0  # lines that belong to a record begun earlier, and the split where that begins
    opener: int = 0
    tail: int = 0  # the first line of a record that ends in a later split, 0 if there is none
    plain: int = 0  # whether counting quotes gives the state behind each of its lines


def _settled(summaries: list[Row], most: int | None) -> dict[tuple[int, int], _Split]:
    """The state every split begins in, file by file, from where either state leads."""

    def checked(length: int) -> None:
        if most is not None and length > most:
            raise ValueError("record too long, a quote may be missing, read whole files")

    splits = {}
    for file, rows in groupby(sorted(summaries, key=lambda r: (r["file"], r["start"])), lambda r: r["file"]):
        state, opener, length, headed = 0, 0, 0, False
        for row in rows:
            split = splits[file, row["start"]] = _Split(state)
            if state < 0:
                continue
            side = _Side(*(row[f"{name}{state}"] for name in _SIDE))
            split.plain = side.plain
            if state == 1 and headed:
                split.opener, split.head = opener, side.first or row["lines"]
            if side.first:
                checked(length + side.head)
                checked(side.longest)
                # The first record of a file is its header.
                split.begin = side.first if state == 1 or not headed else 0
                split.last = side.last
                headed, length = True, 0
            if side.end == 1 and headed and (side.first or state == 0):
                opener, split.tail = row["start"], side.last + 1
            length += side.rest
            state = side.end
        if state == 1:
            raise ValueError("file ends inside a field, read whole files")
    return splits


def _numbered(batches, splits):
    """(file, start, split, number of lines before, rows) of every part."""
    at, n = None, 0
    for file, start, part in _parts(batches):
        if at != (file, start):
            at, n = (file, start), 0
        if at not in splits:
            raise RuntimeError("the splits have changed since they were looked at, read the text again")
        yield file, start, splits[at], n, part
        n += part.num_rows


def _whole_records(batches, splits):
    """The records that lie in one split, the lines of each joined."""
    held: list[pa.Array] = []  # lines of a record that goes on behind the batch
    state = 0
    for _, _, split, n, part in _numbered(batches, splits):
        state = state if n else split.state
        line = part.column("line")
        after = (
            _states_after(part.column("between").to_numpy(), part.column("inside").to_numpy(), state)
            if state >= 0 else np.array([-1])
        )
        if (after < 0).any():
            shown = line[int(np.argmax(after < 0))].as_py()[:200]
            raise ValueError(f"quote or carriage return inside a field, read whole files: {shown}")
        state = int(after[-1])
        low, high = (min(max(border - n, 0), part.num_rows) for border in (split.begin, split.last))
        if low >= high:
            continue
        ends = np.flatnonzero(after[low:high] == 0) + 1
        lines = pa.concat_arrays([*held, line.slice(low, high - low)])
        ends += len(lines) - (high - low)
        done = int(ends[-1]) if len(ends) else 0
        held = [lines.slice(done)] if done < len(lines) else []
        if len(ends):
            offsets = pa.array(np.r_[0, ends], pa.int32())
            kind = pa.string() if pa.types.is_string(lines.type) else pa.large_string()
            texts = lines.slice(0, done)
            if len(ends) < done:
                texts = pc.binary_join(pa.ListArray.from_arrays(offsets, texts), pa.scalar("\n", kind))
            yield pa.RecordBatch.from_arrays([texts.cast(pa.string())], ["text"])


def _pieces(batches, splits):
    """The lines of records that span splits, with the split each record begins in."""
    names = ["file", "opener", "start", "n", "line"]
    for file, start, split, n, part in _numbered(batches, splits):
        first_of_tail = split.tail or n + part.num_rows + 1
        for low, high, opener in ((0, split.head - n, split.opener), (first_of_tail - 1 - n, part.num_rows, start)):
            low, high = max(low, 0), min(high, part.num_rows)
            if low < high:
                count = high - low
                numbers = [np.full(count, v) for v in (file, opener, start)]
                numbers.append(np.arange(n + low + 1, n + high + 1))
                line = part.column("line").slice(low, count).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in numbers), line], names)
