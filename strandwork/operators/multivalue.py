"""Several values packed in one field.

The bytes of a whole Arrow string column are looked at together: delimiter
masks and running quote parity give the child offsets, the trimmed children are
gathered into one list array and flattened with their parents' ordinals. No
shuffle; a row that holds a third of all bytes is still one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import NO_VALUE

DELIMITERS = ";,/|&+\n\r"
QUOTE = 34
# Commas between the locants of a chemical name, as in 2,4- or N,N-.
LOCANTS = re.compile(rb"(?<![0-9A-Za-z])(?:[0-9]+'*|[NOS])(?:,(?:[0-9]+'*|[NOS]))+(?=-)")
EMPTY = re.compile(r"[\W_]*")


def _sequential(text: str, delimiters: str) -> list[str]:
    """Reference parser for rows whose quotes do not pair up as values."""
    locant = {m.start() + i for m in LOCANTS.finditer(text.encode()) for i, b in enumerate(m.group()) if b == 44}
    at, k = {}, 0
    for i, ch in enumerate(text):
        at[i] = k
        k += len(ch.encode())
    out, i, n = [], 0, len(text)
    while i <= n:
        while i < n and text[i].isspace() and text[i] not in delimiters:
            i += 1
        item = None
        if i < n and text[i] == '"':
            closed = re.compile(r'"((?:[^"]|"")*)"\s*(?=$|[' + re.escape(delimiters) + "])").match(text, i)
            if closed:
                item, i = closed.group(1).replace('""', '"').strip(), closed.end()
        if item is None:
            j = i
            while j < n and (text[j] not in delimiters or at[j] in locant):
                j += 1
            item, i = text[i:j].strip(), j
        out.append(item)
        i += 1
    return out


def split_column(column: pa.Array, delimiters: str = DELIMITERS) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(parent ordinal, position from 1, item) of all values in a string column.

    Null, blank and "no value" texts have no values, empty places do not count.
    """
    column = column.cast(pa.string())
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), column
    whole = pc.utf8_lower(pc.utf8_trim_whitespace(column))
    gone = pc.or_kleene(pc.is_in(whole, pa.array(NO_VALUE)), pc.equal(whole, ""))
    column = pc.fill_null(pc.if_else(gone, pa.scalar(None, pa.string()), column), "")
    n = len(column)
    # a line break after every row, so that no mark of one row borders on the next
    ended = pc.binary_join_element_wise(column, "", "\n")
    _, offsets, data = ended.buffers()
    off = np.frombuffer(offsets, np.int32)[ended.offset : ended.offset + n + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    off = off - off[0]
    row = np.repeat(np.arange(n), np.diff(off))

    quote = d == QUOTE
    running = np.cumsum(quote)
    start = np.concatenate([[0], running])[off[:-1]]
    ordinal = running - start[row]  # quotes of the row up to and with this byte
    inside = (ordinal - quote) & 1 == 1
    lut = np.zeros(256, bool)
    lut[list(delimiters.encode())] = True
    cut = lut[d] & ~inside
    cut[off[1:] - 1] = True
    if (d == 44).any():
        for m in LOCANTS.finditer(d.tobytes()):
            span = np.arange(m.start(), m.end())
            cut[span[d[span] == 44]] = False

    blank_lut = np.zeros(256, bool)
    blank_lut[[9, 10, 11, 12, 13, 32]] = True
    blank = blank_lut[d]
    odd = _odd_rows(d, row, off, quote, ordinal, cut, blank, n)

    # child offsets: a child starts with its row or after a delimiter
    cuts = np.flatnonzero(cut)
    begin = np.concatenate([off[:-1], cuts + 1])
    end_parent = np.concatenate([np.arange(n), row[cuts]])
    order = np.lexsort((begin, end_parent))
    begin, parent = begin[order], end_parent[order]
    end = np.empty_like(begin)
    end[:-1] = np.where(parent[1:] == parent[:-1], begin[1:] - 1, off[1:][parent[:-1]])
    if len(end):
        end[-1] = off[-1]
    # outer blanks: first and last byte of the child that is not blank
    ink = np.flatnonzero(~blank)
    lo = np.searchsorted(ink, begin)
    hi = np.searchsorted(ink, end) - 1
    some = hi >= lo
    begin, end, parent = ink[lo[some]], ink[hi[some]] + 1, parent[some]
    # unquote: of the quotes of a quoted child the even ones stay, but for the last
    keep = np.zeros(len(d) + 1, np.int64)
    np.add.at(keep, begin, 1)
    np.add.at(keep, end, -1)
    keep = np.cumsum(keep[:-1]).astype(bool)
    quoted = (end - begin >= 2) & (d[begin] == QUOTE) & (d[end - 1] == QUOTE) if len(begin) else np.zeros(0, bool)
    if quoted.any():
        within = np.zeros(len(d) + 1, np.int64)
        np.add.at(within, begin[quoted], 1)
        np.add.at(within, end[quoted], -1)
        within = np.cumsum(within[:-1]).astype(bool)
        first = np.zeros(len(d), np.int64)
        first[begin[quoted]] = ordinal[begin[quoted]]
        first = np.maximum.accumulate(np.where(first > 0, row * (len(d) + 1) + first, 0)) % (len(d) + 1)
        keep &= ~(within & quote & ((ordinal - first) & 1 == 0))
        keep[end[quoted] - 1] = False
    kept = np.concatenate([[0], np.cumsum(keep)])
    child = np.concatenate([kept[begin], kept[end[-1:]]]).astype(np.int32) if len(begin) else np.zeros(1, np.int32)
    items = pa.StringArray.from_buffers(len(begin), pa.py_buffer(child), pa.py_buffer(np.ascontiguousarray(d[keep[: len(d)]])))
    if len(odd):
        items, parent = _merge(items, parent, odd, column, delimiters)
    items = pc.utf8_trim_whitespace(items)
    low = pc.utf8_lower(items)
    void = pc.or_(pc.is_in(low, pa.array(NO_VALUE)), pc.match_substring_regex(low, r"^[\pP\pS\s]*$"))
    stay = ~np.asarray(void)
    parent, items = parent[stay], items.filter(pa.array(stay))
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(parent, np.arange(n + 1)), pa.int32()), items)
    ordinals = np.asarray(pc.list_parent_indices(lists))
    position = np.arange(len(parent)) - np.asarray(lists.offsets)[ordinals] + 1 if len(parent) else np.zeros(0, np.int64)
    return ordinals, position, lists.flatten()


def _odd_rows(d, row, off, quote, ordinal, cut, blank, n) -> np.ndarray:
    """Rows in which parity cannot be trusted: a quote left open, opening within a value or closing before its end."""
    total = np.zeros(n, np.int64)
    np.add.at(total, row[quote], 1)
    bad = total % 2 == 1
    at = np.flatnonzero(quote)
    if len(at):
        ink = np.flatnonzero(~blank | cut)
        edge = np.concatenate([[True], row[1:] != row[:-1]])
        before = np.searchsorted(ink, at) - 1
        b = ink[np.maximum(before, 0)]
        opens_ok = (before < 0) | (row[b] != row[at]) | cut[b] | (d[b] == QUOTE) & (b == at - 1) & (ordinal[b] % 2 == 0)
        after = np.searchsorted(ink, at) + 1
        a = ink[np.minimum(after, len(ink) - 1)]
        closes_ok = (after >= len(ink)) | (row[a] != row[at]) | cut[a] | (d[a] == QUOTE) & (a == at + 1)
        opening = ordinal[at] % 2 == 1
        bad[row[at[opening & ~opens_ok]]] = True
        bad[row[at[~opening & ~closes_ok]]] = True
    return np.flatnonzero(bad)


def _merge(items: pa.Array, parent: np.ndarray, odd: np.ndarray, column: pa.Array, delimiters: str):
    stay = ~np.isin(parent, odd)
    extra = [(i, x) for i in odd.tolist() for x in _sequential(column[i].as_py(), delimiters)]
    parents = np.concatenate([parent[stay], np.array([i for i, _ in extra], np.int64)])
    every = pa.concat_arrays([items.filter(pa.array(stay)), pa.array([x for _, x in extra], pa.string())])
    order = np.argsort(parents, kind="stable")
    return every.take(pa.array(order)), parents[order]


def explode_packed(df: DataFrame, table_name: str, row_key: str, fields: list[str], least: int = 2, delimiters: str = DELIMITERS) -> DataFrame:
    """One row (table_name, row_key, field_name, pos, item) per value.

    Only fields that hold ``least`` values or more. Values are separated by any
    of the delimiters; a value in double quotes is one value whatever it holds,
    doubled quotes inside are made single; a comma between locants of a
    chemical name does not separate. A quote that does not open or close a
    value is an ordinary character. Null, blank and "no value" fields and empty
    places give nothing; repeated rows are repeated; a null row_key stays null.
    """
    source = df.select(F.col(row_key).cast("string").alias("row_key"), *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)])
    anything = None
    for i in range(len(fields)):
        has = F.col(f"f{i}").rlike("[" + re.escape(delimiters).replace("/", "\\/") + "]")
        anything = has if anything is None else anything | has
    if least > 1:
        source = source.filter(anything)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).cast(pa.string())
            for i, field in enumerate(fields):
                parent, pos, items = split_column(batch.column(i + 1), delimiters)
                stay = np.bincount(parent, minlength=len(keys))[parent] >= least if len(parent) else np.zeros(0, bool)
                parent, pos, items = parent[stay], pos[stay], items.filter(pa.array(stay))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([table_name] * len(parent), pa.string()), keys.take(pa.array(parent)), pa.array([field] * len(parent), pa.string()), pa.array(pos, pa.int32()), items],
                    names=["table_name", "row_key", "field_name", "pos", "item"],
                )

    return source.mapInArrow(run, "table_name string, row_key string, field_name string, pos int, item string")
