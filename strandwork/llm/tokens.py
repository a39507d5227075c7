"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files on every worker, and the file to use.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Fixed value: how byte-level BPE of this family cuts text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, keys: dict[str, Column], text: str, path: str | None = None) -> DataFrame:
    """The key columns and n_tokens, one row per text that is not blank; whole texts are encoded."""
    path = path or f"{TOKENIZER_DIR}/{VOCABULARY}"
    rows = df.select(*[c.alias(k) for k, c in keys.items()], F.col(text).cast("string").alias("__text")).filter(F.col("__text").rlike(r"\S"))
    fields = ", ".join(f"`{k}` {t}" for k, t in rows.dtypes if k != "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            sizes = pa.array([len(encode(t)) for t in batch.column("__text").to_pylist()], pa.int64())
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], sizes], names=[*names, "n_tokens"])

    return rows.mapInArrow(run, f"{fields}, n_tokens long")
