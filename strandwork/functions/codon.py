"""Codon translation, vectorised over Arrow batches.

All sequences of a batch are translated by table look-up on their joined bytes;
the code is the standard one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Amino acids of the 64 codons, bases in the order T, C, A, G.
BASES = "TCAG"
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
STARTS = ("GTG", "TTG", "CTG", "ATT", "ATC", "ATA")
STOPS = ("TAA", "TAG", "TGA")

_BASE = np.full(256, 255, np.uint8)
_BASE[list(BASES.encode())] = range(4)
_BASE[list(BASES.lower().encode())] = range(4)
_AMINO = np.frombuffer(AMINO.encode(), np.uint8)
_CODON = {a + b + c: i * 16 + j * 4 + k for i, a in enumerate(BASES) for j, b in enumerate(BASES) for k, c in enumerate(BASES)}
_IS_START = np.isin(np.arange(64), [_CODON[x] for x in STARTS])


def translate_batch(sequences: pd.Series) -> pd.Series:
    """Proteins of coding sequences, null where there is none.

    One stop at the end is cut off, also off frame; what is left must be a
    whole, positive number of codons without stops or letters other than ACGT.
    An alternative start codon in first place reads as M.
    """
    texts = [s[:-3] if s[-3:].upper() in STOPS else s for s in sequences.fillna("")]
    raw = [t.encode("utf-8", "replace") for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    fit = (size > 0) & (size % 3 == 0)
    joined = np.frombuffer(b"".join(r for r, ok in zip(raw, fit) if ok), np.uint8)
    code = _BASE[joined].reshape(-1, 3).astype(np.int64)
    wrong = (code == 255).any(1)
    index = np.where(wrong, 0, code[:, 0] * 16 + code[:, 1] * 4 + code[:, 2])
    amino = _AMINO[index].copy()
    ends = np.cumsum(size[fit] // 3)
    begins = ends - size[fit] // 3
    first = begins[_IS_START[index[begins]] & ~wrong[begins]] if len(begins) else begins
    wrong |= amino == ord("*")
    amino[first] = ord("M")
    bad = np.concatenate([[0], np.cumsum(wrong)])
    out: list[str | None] = [None] * len(texts)
    for i, b, e in zip(np.flatnonzero(fit).tolist(), begins.tolist(), ends.tolist()):
        if bad[b] == bad[e]:
            out[i] = amino[b:e].tobytes().decode()
    return pd.Series(out, dtype=object)


def translate(c: Column) -> Column:
    return F.pandas_udf(translate_batch, "string")(c)
