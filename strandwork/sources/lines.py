"""Text files as numbered records."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Places within one file; the bits above number the files, in the order of their names.
PLACE_BITS = 44


def _name(uri: str) -> str:
    """A file's name, which Spark writes in more than one way."""
    return re.sub(r"^file:/+", "/", unquote(uri))


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The files a path, folder or pattern names, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(spark.read.text(path).inputFiles()) if found else []


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of the first file. Only its first bytes are read."""
    files = files_of(spark, path)
    if not files:
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(files[0]))
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(place)
        stream = codec.createInputStream(stream) if codec is not None else stream
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def numbered(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """(file, line_no, head, value): the records of text files, split at ``sep``.

    line_no grows with the place of the record, first by the name of its file,
    then within it; it is the same whatever the partitioning, but not dense: it
    is the start of the block that holds the record plus the number of records
    before it in that block, which is less than the block has bytes. head marks
    the first record of a file.
    """
    rank = {_name(f): i for i, f in enumerate(files_of(spark, path))}
    reader = spark.read.option("lineSep", sep) if sep else spark.read
    rows = reader.text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen = None, 0  # a block is read from its start to its end by one task
        for batch in batches:
            if not len(batch):
                continue
            paths, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy(zero_copy_only=False)
            code = paths.indices.to_numpy(zero_copy_only=False)
            new = np.ones(len(batch), bool)
            new[1:] = (code[1:] != code[:-1]) | (blocks[1:] != blocks[:-1])
            names = paths.dictionary.to_pylist()
            new[0] = (names[code[0]], blocks[0]) != at
            starts = np.where(new, np.arange(len(batch)), 0)
            row = np.arange(len(batch)) - np.maximum.accumulate(starts)
            if not new[0]:
                first = int(new.argmax()) if new.any() else len(batch)
                row[:first] += seen
            at, seen = (names[code[-1]], blocks[-1]), int(row[-1]) + 1
            files = np.array([rank[_name(n)] for n in names], np.int64)[code]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(files << PLACE_BITS | (blocks + row)), pa.array((blocks == 0) & (row == 0)), batch.column(2)], names=["file", "line_no", "head", "value"]
            )

    return rows.mapInArrow(run, "file string, line_no long, head boolean, value string")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file and moves it into place at once, over one that is there."""
    jvm = spark._jvm
    final = jvm.org.apache.hadoop.fs.Path(path)
    staged = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    stream = final.getFileSystem(conf).create(staged, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.getFileSystem(conf).getUri(), conf)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(context.makeQualified(staged), context.makeQualified(final), options)


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file as a whole, or None if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()
