"""Rows that fail to parse, set apart with the reason while the others load.

Records are parsed with Python's strict csv reader, partition by partition;
what it refuses is a structural failure, found before any field is typed. No
shuffle. Text files are first assembled quote-aware into records.
"""

from __future__ import annotations

import csv
import datetime
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import NO_VALUE

csv.field_size_limit(1 << 31)
ACCESSION = re.compile(r"(?:[A-Z]{1,6}|[A-Z]{2}_[A-Z]{0,6})[0-9]{5,9}(?:\.[0-9]+)?")
SOURCES = ("CARD", "NCBI", "RESFINDER")
FIELDS = ("source", "original_header", "source_acc", "gene_name", "sequence_length", "loaded_on")
BREAKS = {"\r": "", "\n": ""}  # the reader would end a record there


def _is_void(text: str | None) -> bool:
    t = (text or "").strip().lower()
    return t in NO_VALUE or not any(ch.isalnum() for ch in t)


def strict_fields(line: str, delimiter: str = "\t") -> list[str]:
    """Fields of one record; ``csv.Error`` if a quoted field is not closed at its end."""
    for ch, mark in BREAKS.items():
        line = line.replace(ch, mark)
    rows = list(csv.reader([line], delimiter=delimiter, quotechar='"', doublequote=True, strict=True))
    out = rows[0] if rows else []
    for ch, mark in BREAKS.items():
        out = [x.replace(mark, ch) for x in out]
    return out


def _length(text: str) -> int:
    if not re.fullmatch(r"[0-9]+", text) or int(text) < 1:
        raise ValueError(text)
    return int(text)


def _day(text: str) -> datetime.date:
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", text):
        raise ValueError(text)
    return datetime.date.fromisoformat(text)


def _one_of_sources(text: str) -> str:
    if text not in SOURCES:
        raise ValueError(text)
    return text


def _accession(text: str) -> str | None:
    if text and not ACCESSION.fullmatch(text):
        raise ValueError(text)
    return text or None


CONSTRUCTORS: tuple[Callable, ...] = (_one_of_sources, str, _accession, str, _length, _day)


def parse_record(line: str | None) -> tuple[str | None, tuple | None]:
    """(reason, fields): one of the two is None. No text at all lacks its columns."""
    try:
        fields = strict_fields(line or "")
    except csv.Error:
        return "quoting", None
    if len(fields) != len(CONSTRUCTORS):
        return "columns", None
    try:
        return None, tuple(make(x) for make, x in zip(CONSTRUCTORS, fields))
    except ValueError:
        return "value", None


RANGE = re.compile(r"[0-9]+-[0-9]+")


def _card(header: str) -> str | None:
    parts = header.split("|")
    if len(parts) != 6:
        return "columns"
    tag, acc, strand, span, term, name = parts
    good = tag == "gb" and ACCESSION.fullmatch(acc) and strand in ("+", "-") and RANGE.fullmatch(span)
    return None if good and re.fullmatch(r"ARO:[0-9]+", term) and name.strip() else "value"


def _ncbi(header: str) -> str | None:
    first, _, rest = header.partition(" ")
    acc, colon, span = first.partition(":")
    if not colon:
        return "columns"
    return None if ACCESSION.fullmatch(acc) and re.fullmatch(r"c?[0-9]+-[0-9]+", span) and rest.strip() else "value"


def _resfinder(header: str) -> str | None:
    parts = header.split("_")
    if len(parts) > 2 and re.fullmatch(r"[A-Z]{2}", parts[-2]):  # the accession's own underscore
        parts[-2:] = ["_".join(parts[-2:])]
    if len(parts) != 3:
        return "columns"
    name, number, acc = parts
    return None if name.strip() and re.fullmatch(r"[0-9]+", number) and ACCESSION.fullmatch(acc) else "value"


HEADERS = {"CARD": _card, "NCBI": _ncbi, "RESFINDER": _resfinder}


def header_reason(source: str | None, header: str | None, source_acc: str | None) -> str | None:
    """First reason for which a gene row can't be parsed, or None.

    A header without value has no parts (``columns``); a row whose source is
    none of the three has an invalid part (``value``); a source_acc without
    value is no failure.
    """
    text = (header or "").strip()
    if text.startswith('"'):
        try:
            fields = strict_fields(text, "\0")
        except csv.Error:
            return "quoting"
        text = (fields[0] if fields else "").strip()
    if _is_void(text):
        return "columns"
    parse = HEADERS.get((source or "").strip().upper())
    reason = parse(text) if parse else "value"
    if reason is None and not _is_void_acc(source_acc) and not ACCESSION.fullmatch(source_acc.strip()):
        reason = "value"
    return reason


def _is_void_acc(acc: str | None) -> bool:
    return acc is None or _is_void(acc)


RECORD_SCHEMA = "raw_id long, source string, original_header string, source_acc string, gene_name string, sequence_length int, loaded_on date, reason string, raw_line string"
RECORD_TYPES = pa.schema(
    [("raw_id", pa.int64()), ("source", pa.string()), ("original_header", pa.string()), ("source_acc", pa.string()), ("gene_name", pa.string()),
     ("sequence_length", pa.int64()), ("loaded_on", pa.date32()), ("reason", pa.string()), ("raw_line", pa.string())]
)


def parse_records(df: DataFrame) -> DataFrame:
    """All rows of raw_record: the typed fields of good ones, reason and raw_line of the others.

    reason is the first that applies of ``quoting``, ``columns`` and ``value``;
    it is null for good rows, of which raw_line is null. A null or empty line
    lacks its columns. Repeated lines are parsed each; a length beyond 63 bits
    is no length (``value``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for raw_id, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reason, fields = parse_record(line)
                if fields and fields[4] >= 1 << 63:
                    reason, fields = "value", None
                out.append((raw_id, *(fields or (None,) * 6), reason, line if reason else None))
            columns = list(zip(*out)) if out else [()] * len(RECORD_TYPES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, RECORD_TYPES.types)], schema=RECORD_TYPES)

    schema = RECORD_SCHEMA.replace("sequence_length int", "sequence_length long")
    return df.select(F.col("raw_id").cast("long"), F.col("raw_line").cast("string")).mapInArrow(run, schema)


def bad_headers(df: DataFrame) -> DataFrame:
    """(gene_id, reason) of the gene rows whose header or accession can't be parsed."""
    schema = pa.schema([("gene_id", pa.int64()), ("reason", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, *columns = [c.to_pylist() for c in batch.columns]
            hits = [(i, r) for i, *row in zip(ids, *columns) if (r := header_reason(*row))]
            yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in hits], t) for k, t in enumerate(schema.types)], schema=schema)

    wanted = df.select(F.col("gene_id").cast("long"), *[F.col(c).cast("string") for c in ("source", "original_header", "source_acc")])
    return wanted.mapInArrow(run, "gene_id long, reason string")


def good_rows(df: DataFrame) -> DataFrame:
    """The gene rows that parse, with all their columns, in one pass."""
    wanted = ("source", "original_header", "source_acc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [batch.column(c).cast(pa.string()).to_pylist() for c in wanted]
            yield batch.filter(pa.array([not header_reason(*row) for row in zip(*texts)], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def assemble_records(lines: Iterator[str], delimiter: str = "\t") -> Iterator[str]:
    """Physical lines to records: a line goes on while a field that opened with a quote is not closed.

    Every line is looked at once. Where a quote is never closed, each of the
    lines it would hold is a record of its own.
    """
    held: list[str] = []
    open_field = False
    inside = re.compile(r'(?:[^"]|"")*')
    for line in lines:
        held.append(line)
        at = 0
        while True:
            if open_field:
                at = inside.match(line, at).end()
                if at >= len(line):
                    break  # still open
                at, open_field = at + 1, False  # the quote that closes it, or that makes it a broken field
            elif line.startswith('"', at):
                at, open_field = at + 1, True
                continue
            at = line.find(delimiter, at) + 1
            if not at:
                break
        if not open_field:
            yield "\n".join(held)
            held = []
    yield from held


def read_delimited(spark, path: str) -> DataFrame:
    """Reads a tab-separated text file into records like ``parse_records``.

    A file is one task, as a quoted field may span lines; raw_id is the number
    of the record's first line, from 1 on, within its file.
    """
    whole = spark.read.text(path, wholetext=True).select("value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ids, rows, at = [], [], 1
                for record in assemble_records(iter(text.split("\n")[: -1 if text.endswith("\n") else None])):
                    ids.append(at)
                    rows.append(record)
                    at += record.count("\n") + 1
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.string())], names=["raw_id", "raw_line"])

    return parse_records(whole.mapInArrow(run, "raw_id long, raw_line string"))
