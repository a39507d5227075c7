"""Mapping free-entered values to the entries of a canonical list.

A symmetric-delete dictionary of the names of the list is sent to the workers
and looked up there; candidates are ranked by weighted Damerau–Levenshtein
distance, then by how often the reference names their entry. No shuffle.

What is broadcast is bounded by ``MAX_KEYS`` deletes. A longer list is cut into
blocks of whole entries, each within the bound; every distinct value is looked
up in all blocks and the best of them counts, as if they were one.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import NO_VALUE, filled
from ..operators.multivalue import split_column
from ..session import materialise

UNMATCHED = "UNMATCHED"
MAX_KEYS = 1_000_000  # deletes of the names in one block; some 100 bytes each on a worker
MAX_EDITS = 3
CACHE = 1_000_000  # values a worker remembers
#: Words that say what kind of thing a name is or only go along with it.
KINDS = (
    "antibiotic", "antibiotics", "antib", "abx", "ab", "inhibitor", "inhibitors", "inhib", "agent", "agents",
    "efflux", "group", "groups", "pathway", "blocker", "blockers", "analogue", "analogues", "class", "classes",
    "type", "types", "drug", "drugs", "compound", "compounds", "resistance", "resistant", "anti", "infective",
    "antibacterial", "antimicrobial", "the",
)
#: Digits typed or read for letters.
LOOKALIKE = str.maketrans("01358", "olesb")


def fold(text: str) -> str:
    """Letters without accents, in lower case."""
    flat = unicodedata.normalize("NFKD", text.lower())
    return "".join(ch for ch in flat if not unicodedata.combining(ch))


def words(text: str) -> tuple[list[str], bool]:
    """The words of a typed name in order, and whether it was cut short.

    Accents, case, blanks, words broken by a hyphen and a blank, marks around
    the name and the order turned round by a comma make no difference.
    """
    t = fold(text)
    t = re.sub(r"([a-z])-\s+([a-z])", r"\1\2", t)
    cut = bool(re.search(r"[a-z0-9](?:~|\.|…)\s*$", t))
    if "," in t:
        head, _, tail = t.partition(",")
        t = f"{tail} {head}"
    t = re.sub(r"(?<=[a-z])[01358](?=[a-z])|(?<=[a-z]{2})[01358]\b", lambda m: m.group().translate(LOOKALIKE), t)
    return re.findall(r"[a-z0-9]+", t), cut


def distance(a: str, b: str, most: float) -> float:
    """Weighted Damerau–Levenshtein distance, or ``most`` + 1 once it is beyond.

    Swapped neighbours, doubled letters and vowels taken for one another weigh
    less than other edits; the first letter weighs more.
    """
    if abs(len(a) - len(b)) > most + 1:
        return most + 1
    before2: list[float] = []
    before = [j * 1.0 for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [i * 1.0]
        for j, y in enumerate(b, 1):
            edge = 1.25 if i == 1 or j == 1 else 1.0
            swap = 0.0 if x == y else (0.8 if x in "aeiouy" and y in "aeiouy" else edge)
            drop = 0.7 if i > 1 and a[i - 2] == x else edge
            add = 0.7 if j > 1 and b[j - 2] == y else edge
            best = min(before[j - 1] + swap, before[j] + drop, row[j - 1] + add)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                best = min(best, before2[j - 2] + 0.7)
            row.append(best)
        if min(row) > most + 1:
            return most + 1
        before2, before = before, row
    return before[-1]


def deletes(text: str, most: int) -> set[str]:
    out = level = {text}
    for _ in range(most):
        level = {s[:i] + s[i + 1 :] for s in level for i in range(len(s))}
        out = out | level
    return out


def plain(stem: str) -> str:
    """A stem without the ending of a plural."""
    return stem[:-1] if len(stem) > 4 and stem.endswith("s") and not stem.endswith("ss") else stem


def _closed(parts: list[str]) -> str:
    """A name's letters without the words for kinds of things, unless it has no others; blanks make no difference."""
    return plain("".join(p for p in parts if p not in KINDS)) or "".join(parts)


def decide(answers: list[tuple[tuple | None, list[str], list[tuple]]]) -> str:
    """The entry meant, from what each list has found.

    An entry of that very name counts first, the one named most if there are
    several; then the only entry that the value is a cut name of; then the
    nearest, and of equally near ones the one that the reference names most.
    Equally near entries named equally often leave the value ``UNMATCHED``.
    """
    own = [a[0] for a in answers if a[0] is not None]
    if own:
        return min(own)[-1]
    begun = {c for a in answers for c in a[1]}
    if len(begun) == 1:
        return begun.pop()
    near = sorted(n for a in answers for n in a[2])
    best = {n[2] for n in near if tuple(n[:2]) == tuple(near[0][:2])}
    return best.pop() if len(best) == 1 else UNMATCHED


@dataclass
class Dictionary:
    """Symmetric-delete index over the names of a canonical list."""

    edits: int = MAX_EDITS
    exact: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))
    stems: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))
    short: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))
    near: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))
    weight: dict[str, int] = field(default_factory=dict)
    longest: int = 0

    def add(self, canonical: str, name: str | None, short: bool = False) -> None:
        if not name or not name.strip() or name.strip().lower() in NO_VALUE:
            return
        parts, _ = words(name)
        if not parts:
            return
        self.weight[canonical] = self.weight.get(canonical, 0) + 1
        if short:
            self.short["".join(parts)].add(canonical)
            return
        self.exact[" ".join(parts)].add(canonical)
        stem = _closed(parts)
        self.stems[stem].add(canonical)
        self.longest = max(self.longest, len(stem))
        for d in deletes(stem, self.edits):
            self.near[d].add(stem)

    def _limit(self, stem: str) -> float:
        return min(self.edits, 0 if len(stem) < 5 else 1 if len(stem) < 8 else 2 if len(stem) < 10 else 3)

    def _heaviest(self, names: set[str]) -> tuple[int, str]:
        """(minus its weight, entry) of the entry that the reference names most, of equals the first."""
        return min((-self.weight.get(c, 0), c) for c in names)

    def find(self, value: str) -> tuple[tuple | None, list[str], list[tuple]]:
        """What this list has for a value: (the entry of that very name), [entries it is a cut name of], [nearest entries].

        The first is (step, minus weight, entry), the last hold (distance, minus
        weight, entry), all at the least distance. ``decide`` puts the answers
        of several lists together.
        """
        parts, cut = words(value)
        whole = " ".join(parts)
        if whole in self.exact:
            return (0, *self._heaviest(self.exact[whole])), [], []
        if len(parts) == 1 and whole in self.short and len(value.strip()) <= 2 * len(whole) + 4:
            return (1, *self._heaviest(self.short[whole])), [], []
        kept = [p for p in parts if p not in KINDS and not (len(p) > 5 and self._is_kind(p))]
        stem = plain("".join(kept))
        if not stem:
            return None, [], []
        if stem in self.stems:
            return (2, *self._heaviest(self.stems[stem])), [], []
        begun = set().union(*[c for s, c in self.stems.items() if s.startswith(stem)]) if len(stem) >= (4 if cut else 5) else set()
        most = self._limit(stem)
        if not most or len(stem) > self.longest + most:  # too long for any name, however it is edited
            return None, sorted(begun)[:2], []
        pool = set().union(*[self.near.get(d, set()) for d in deletes(stem, int(most))])
        ranked = sorted((round(distance(stem, s, most + 0.25), 6), *self._heaviest(self.stems[s])) for s in pool)
        return None, sorted(begun)[:2], [r for r in ranked if r[0] <= most + 0.25 and r[:1] == ranked[0][:1]]

    def look_up(self, value: str) -> str:
        return decide([self.find(value)])

    def _is_kind(self, part: str) -> bool:
        """A word for the kind of thing, misspelt or cut short."""
        return any(distance(part, k, 2) <= 2 or len(part) >= 4 and k.startswith(part) for k in ("antibiotic", "inhibitor", "blocker", "analogue", "compound", "resistance"))


NAMES = ("canonical_name", "resfinder_alias", "ncbi_alias", "card_class_abbrev")


def _n_deletes(letters: int, edits: int) -> int:
    return sum(math.comb(letters, k) for k in range(edits + 1))


def build_dictionaries(mapping: DataFrame, edits: int = MAX_EDITS, max_keys: int = MAX_KEYS) -> Iterator[Dictionary]:
    """The dictionary of class_mapping (canonical names, aliases and abbreviations), in blocks of at most ``max_keys`` deletes.

    The rows of an entry are never parted. The list is read entry by entry, so
    the driver holds one block at a time. A single entry of more deletes than
    that is a block of its own.
    """
    rows = mapping.select(*NAMES).filter("canonical_name IS NOT NULL").distinct().orderBy(*NAMES)
    block, keys, entry = Dictionary(edits), 0, None
    for r in rows.toLocalIterator():
        size = sum(_n_deletes(len(n), edits) for n in r[:3] if n)
        if entry is not None and r.canonical_name != entry and keys + size > max_keys:
            yield block
            block, keys = Dictionary(edits), 0
        entry, keys = r.canonical_name, keys + size
        for name in r[:3]:
            block.add(r.canonical_name, name)
        block.add(r.canonical_name, r[3], short=True)
    yield block


def build_dictionary(mapping: DataFrame, edits: int = MAX_EDITS) -> Dictionary:
    """The whole of a short list as one dictionary."""
    return next(build_dictionaries(mapping, edits, 1 << 62))


def canonicalise(df: DataFrame, key: str, fields: list[str], dictionary: Dictionary | Iterable[Dictionary], single: Sequence[str] = ()) -> DataFrame:
    """(key, field_name, value, canonical_name) of each filled field.

    Fields named in ``single`` count only where they hold one value, which is
    taken without its quotes. canonical_name is ``UNMATCHED`` where no entry of
    the list is meant, or two are equally near and equally often named. Null,
    blank and "no value" fields give no row; repeated rows are repeated; an
    empty list matches nothing. Other columns are not read.
    """
    blocks = iter([dictionary] if isinstance(dictionary, Dictionary) else dictionary)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return _values(df, key, fields, single, first.look_up)
    values = materialise(_values(df, key, fields, single), "values")
    distinct = materialise(values.select("value").distinct(), "distinct")
    answers = None
    for block in chain([first, second], blocks):
        found = materialise(_answers(distinct, block), "answers")
        answers = found if answers is None else answers.unionByName(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [decide([json.loads(a) for a in answers]) for answers in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string())], names=["value", "canonical_name"])

    decided = answers.groupBy("value").agg(F.collect_list("answer").alias("answers")).mapInArrow(run, "value string, canonical_name string")  # one answer a block
    return values.drop("canonical_name").join(decided, "value", "left").select(key, "field_name", "value", F.coalesce("canonical_name", F.lit(UNMATCHED)).alias("canonical_name"))


def _answers(values: DataFrame, block: Dictionary) -> DataFrame:
    """(value, answer): what a block of the list has for each value; values it has nothing for are left out."""
    sent = values.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_pylist()
            found = [sent.value.find(v) for v in values]
            rows = [(v, json.dumps(a)) for v, a in zip(values, found) if a != (None, [], [])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["value", "answer"])

    return values.mapInArrow(run, "value string, answer string")


def _values(df: DataFrame, key: str, fields: list[str], single: Sequence[str], look_up: Callable[[str], str] | None = None) -> DataFrame:
    """(key, field_name, value, canonical_name) of the filled fields; canonical_name is what look_up gives, null without it."""
    sent = df.sparkSession.sparkContext.broadcast(look_up)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str | None] = {}
        ask = sent.value or (lambda value: None)
        for batch in batches:
            for i, field_name in enumerate(fields):
                values = batch.column(i + 1).cast(pa.string())
                if field_name in single:
                    parent, _, items = split_column(values)
                    n = np.bincount(parent, minlength=len(values))[parent] if len(parent) else np.zeros(0, np.int64)
                    rows, values = parent[n == 1], items.filter(pa.array(n == 1))
                else:
                    rows = np.flatnonzero(np.array(values.is_valid()))
                    values = values.take(pa.array(rows, pa.int64()))
                coded = values.dictionary_encode()
                names = []
                for value in coded.dictionary.to_pylist():
                    if value not in known:
                        if len(known) > CACHE:
                            known.clear()
                        known[value] = ask(value)
                    names.append(known[value])
                found = pa.array(names, pa.string()).take(coded.indices)
                key_column = batch.column(0).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [key_column, pa.array([field_name] * len(rows), pa.string()), values, found], names=[key, "field_name", "value", "canonical_name"]
                )

    source = df.select(F.col(key), *[filled(F.col(f).cast("string")).alias(f"f{i}") for i, f in enumerate(fields)])
    return source.mapInArrow(run, f"`{key}` {dict(source.dtypes)[key]}, field_name string, value string, canonical_name string")


def report(mapped: DataFrame) -> DataFrame:
    """(field_name, value, n_rows) of the values that matched nothing."""
    return mapped.filter(F.col("canonical_name") == UNMATCHED).groupBy("field_name", "value").agg(F.count("*").alias("n_rows"))
