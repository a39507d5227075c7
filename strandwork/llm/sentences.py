"""Sentence boundaries across languages and scripts.

Blank lines and list items are certain boundaries. Between words a hidden-event
n-gram model decides: it scores the text with and without a boundary token,
given what stands before and after the place, and forward-backward posteriors
over all places of a unit decide. After a mark that can close a sentence the
words on both sides count; at a blank without a mark, in any script, the shapes
of the words do. Where sentences of a script close with marks, a blank is hardly
ever a boundary, and the model finds so; in scripts without such marks it is.

The model is trained on the corpus itself, without labels. Every certain unit
shows how sentences begin and end; how often a context occurs at certain ends,
against how often it occurs inside units, tells how often it ends a sentence;
expectation-maximisation settles the rest. The counts cover all texts: they
are summed on the workers and by one aggregation, and every round sums over all
pairs of contexts on the workers. Only sums by context are collected. Contexts
rarer than ``RARE`` of all events are known by their shape, so there are at most
2 / ``RARE`` of them; pairs of contexts are not limited.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise

RARE = 2e-6
LEAST = 12
ROUNDS = 12
POINT = 2**20  # expected counts are summed in whole parts of 1 / POINT, so that their order makes no difference
LEAST_TEXT = 80  # letters from which a unit without a closing mark is text and no heading
LEAST_ODDS = 1e-3  # places less likely than this are left out of the lattice, where they could change no posterior by more
SHORT = 0.05  # weight of two boundaries with less than two words between them
HAN = "々-〇぀-ヿ㐀-䶿一-鿿豈-﫿"
THAI = "฀-๿"
STRONG = "。！？｡．।॥؟۔"
TERMINALS = "." + "!?…‥" + STRONG
OPENERS = {"(": ")", "[": "]", "{": "}", "«": "»", "„": "“”", "“": "”", "‘": "’", "「": "」", "『": "』", "（": "）", "【": "】", "《": "》", "〈": "〉", "‹": "›", "‚": "‘’"}
CLOSERS = set("".join(OPENERS.values())) - {"“", "‘"}
# Abbreviations that seldom end a sentence, in lower case.
ABBREVIATIONS = frozenset("""
    approx ca cf vs e.g i.e eg ie fig figs tab sect sec eq no nos nr vol ed eds al resp spp sp subsp var dr mr mrs ms prof st min max
    bzw abb std d.h z.b z h vgl usf inkl evtl ggf bspw nr tabl env p ex ej pag pág núm art aprox depto dpto sr sra vid véase
    рис табл см стр ок т.е т.д т.п т е п г гг им π.χ π χ βλ εικ πιν πίν περ σελ क्र डॉ श्री मि.ग्रा मि ग्रा
""".split())  # fmt: skip

TOKEN = re.compile(
    rf"(?P<han>[{HAN}])|(?P<thai>[{THAI}]+)|(?P<num>\d+(?:[.,:/\-]\d+)*)"
    rf"|(?P<word>°?[^\W\d_](?:(?:(?![{HAN}{THAI}])[\ẁ-ͯऀ-ःऺ-ॏॢॣً-ْ'’])|[-/](?=\w)|\(\w{{1,3}}'*\)(?=-))*)"
    rf"|(?P<end>[{re.escape(TERMINALS)}]+)|(?P<mark>\S)"
)
BREAK = re.compile(r"\r\n|[\n\r\x0b\x0c\x85  ]")
ITEM = re.compile(r"[ \t]*(?:(?P<dot>[-*•‣▪◦])|\(?(?P<no>\d{1,3})[.)])[ \t]+\S")
ENDED = re.compile(rf"[{re.escape(TERMINALS)};:：»”“\"'’」』）)]\s*$")
GREEK = re.compile(r"[Ͱ-Ͽἀ-῿]{3}")
START, STOP = "<s>", "</s>"
LETTERED = frozenset(("word", "num", "han", "thai"))
GAP = "\x01"  # begins the contexts of places without a mark


def units(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whole) of the certain units: paragraphs, and list items, which are never divided."""
    out: list[tuple[int, int, bool]] = []
    lines, at = [], 0
    for m in [*BREAK.finditer(text), None]:
        stop = m.start() if m else len(text)
        lines.append((at, stop))
        at = m.end() if m else stop
    begin, item, number = None, False, 0
    end = 0
    for k, (s, e) in enumerate(lines):
        line = text[s:e]
        if not line.strip():
            if begin is not None:
                out.append((begin, end, item))
            begin, item, number = None, False, 0
            continue
        m = ITEM.match(line)
        if m and m["no"]:
            n = int(m["no"])
            following = ITEM.match(text, lines[k + 1][0]) if k + 1 < len(lines) else None
            first = n == 1 and (begin is None or ENDED.search(text[begin:end]) or following is not None and following["no"] == "2")
            if not (first or item and n == number + 1):
                m = None
        if m:
            if begin is not None:
                out.append((begin, end, item))
            begin, item, number = s, True, int(m["no"] or 0)
        elif begin is None:
            begin = s
        end = e
    if begin is not None:
        out.append((begin, end, item))
    return out


def shape(kind: str, token: str) -> str:
    """The kind of a token, known also where the token itself is rare."""
    if kind == "num":
        return "0"
    if kind != "word":
        return f"<{kind}>"
    if any(c.isdigit() for c in token) or "-" in token[1:-1] and any(c.isupper() for c in token):
        return "<id>"
    script = "L" if token[0] < "ɐ" else hex(ord(token[0]) >> 7)
    if len(token) == 1:
        return f"<{script}1{'U' if token.isupper() else 'l'}>"
    return f"<{script}{'U' if token.isupper() else 'C' if token[0].isupper() else 'l'}>"


def _script(kind: str, token: str, rough: str) -> str | None:
    """The script a token is written in; figures and identifiers tell none."""
    if kind != "word":
        return kind if kind != "num" else None
    return None if rough == "<id>" else "L" if token[0] < "ɐ" else hex(ord(token[0]) >> 7)


class Unit:
    """Tokens of a unit, and the places at which a sentence may end in it."""

    __slots__ = ("spots", "first", "last", "n_words", "gaps", "opening", "closing")

    def __init__(self, text: str, base: int, stop: int):
        toks = [(m.lastgroup, m.group(), m.start(), m.end()) for m in TOKEN.finditer(text, base, stop)]
        partner = _pairs(toks, text)
        #: (end of the sentence, start of the next, context before, its shape, token after, its shape, words since the last spot), after marks
        self.spots: list[tuple] = []
        #: (end of the sentence, start of the next, script and shape before, shape after), at blanks without a mark
        self.gaps: list[tuple] = []
        script, last_shape = "", ""
        self.opening: tuple[str, str] | None = None
        depth_end, words, last_spot_words, n = -1, 0, 0, len(toks)
        since = base
        i = 0
        prev: tuple[str, str] = (START, START)
        while i < n:
            kind, tok, s, e = toks[i]
            if i in partner and partner[i] > i and s >= depth_end:
                depth_end = toks[partner[i]][3]
            ends = kind == "end" or tok in ";;" and GREEK.search(text, since, s) is not None
            if ends and kind == "end" and tok == "." and i + 1 < n and toks[i + 1][2] == e and toks[i + 1][0] == "num":
                ends = False
            if ends:
                j, close = i + 1, ""
                while j < n and j in partner and partner[j] < j:
                    close += toks[j][1]
                    j += 1
                stop_at = toks[j - 1][3]
                mark = "." if tok == "." else "…" if tok[0] in "…‥" or tok.startswith("..") else next((c for c in tok if c in "!?" + STRONG), tok[0])
                before = (f"{prev[0]} {mark}{close}", f"{prev[1]} {mark}{close}")
                if mark == "…" and text[s - 1 : s].isspace():
                    before = (f"{prev[0]} _…{close}", f"{prev[1]} _…{close}")
                if j >= n:
                    i = j
                    prev = before
                    continue
                after, glued = self._after(toks, j), toks[j][2] == stop_at
                if stop_at >= depth_end and (not glued or self._may_join(mark, close, toks, i, j)):
                    self.spots.append((stop_at, toks[j][2], *before, *after, words - last_spot_words))
                    last_spot_words, since = words, stop_at
                for k in range(i + 1, j):
                    if toks[k][3] >= depth_end:
                        depth_end = -1
                prev = (before[0].rsplit(" ", 1)[-1], before[1].rsplit(" ", 1)[-1])
                i = j
                continue
            if kind in LETTERED:
                here = shape(kind, tok)
                if i and toks[i - 1][0] in LETTERED:
                    stop_at = toks[i - 1][3]
                    if s > stop_at and s >= depth_end and script and not BREAK.search(text, stop_at, s):
                        self.gaps.append((stop_at, s, f"{script} {last_shape}", here))
                script = _script(kind, tok, here) or script
                last_shape = here
                if self.opening is None and script:
                    self.opening = (script, shape(toks[0][0], toks[0][1]))
            if kind in ("word", "num", "han", "thai"):
                words += 1
            if kind == "num" and i and toks[i - 1][0] == "word":  # an ordinal or the like depends on the word before
                prev = (toks[i - 1][1] + " 0", "0")
            elif kind == "han" and i and toks[i - 1][0] == "han":
                prev = (toks[i - 1][1] + tok, "<han>")
            else:
                rough = here if kind in LETTERED else tok if kind == "mark" else shape(kind, tok)
                prev = (tok if kind == "word" and tok != "I" and not (len(tok) == 1 and tok.isupper()) else rough, rough)
            i += 1
        self.n_words = words
        self.first = self._after(toks, 0) if toks else None
        self.last = prev if toks and " " in prev[0] else None
        self.closing = f"{script} {last_shape}" if toks and toks[-1][0] in LETTERED and script else None

    @staticmethod
    def _after(toks: list, j: int) -> tuple[str, str]:
        lead = ""
        while j < len(toks) and toks[j][0] == "mark" and len(lead) < 2:
            lead += toks[j][1]
            j += 1
        if j >= len(toks):
            return lead, lead
        kind, tok, _, _ = toks[j]
        if kind == "han":
            both = tok + (toks[j + 1][1] if j + 1 < len(toks) and toks[j + 1][0] == "han" else "")
            return lead + both, lead + "<han>"
        s = shape(kind, tok)
        if len(tok) == 1 and tok.isupper() and kind == "word":
            return lead + s, lead + s
        return lead + (tok if kind == "word" else s), lead + s

    @staticmethod
    def _may_join(mark: str, close: str, toks: list, i: int, j: int) -> bool:
        """Whether a sentence can end where no blank follows."""
        if mark in STRONG or close and mark in "!?…":
            return True
        kind, tok, _, _ = toks[j]
        if kind in ("han", "thai"):
            return True
        before = toks[i - 1] if i else None
        if kind == "mark":
            return tok in OPENERS or tok in '"¿¡'
        long = kind == "word" and len(tok) > 2
        if mark in "!?…":
            return long
        return long and before is not None and before[0] == "word" and len(before[1]) > 2 and before[3] == toks[i][2]


def _pairs(toks: list, text: str) -> dict[int, int]:
    """Brackets and quotes that belong together."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    for i, (kind, tok, s, e) in enumerate(toks):
        if kind != "mark":
            continue
        want = next((k for k in range(len(stack) - 1, -1, -1) if tok in stack[k][0]), None)
        if want is not None and not (tok == "’" and e < len(text) and text[e].isalpha()):
            out[i] = stack[want][1]
            out[stack[want][1]] = i
            del stack[want:]
        elif tok in OPENERS:
            stack.append((OPENERS[tok], i))
        elif tok == '"':
            stack.append(('"', i))
    return out


class BoundaryModel:
    """A bigram model with a hidden boundary token.

    ends[b] is P(boundary | context b before). starts[a] is P(boundary | token a
    after), from which P(a | boundary) / P(a) = starts[a] / share follows by
    Bayes' rule, alike for frequent and rare languages of the corpus.
    """

    def __init__(self) -> None:
        self.ends: dict[str, float] = {}
        self.starts: dict[str, float] = {}
        self.mark: dict[str, float] = {}
        self.share = self.rate = 0.6
        #: Log odds of a boundary at a blank, by what stands before and after, where they are not negligible.
        self.gaps: dict[tuple[str, str], float] = {}
        self.words_before: set[str] = set()
        self.words_after: set[str] = set()

    @staticmethod
    def fit(before: pd.DataFrame, after: pd.DataFrame, known_before: dict[str, str], known_after: dict[str, str], expected: Callable) -> "BoundaryModel":
        """before, after: name, n (how often inside units), sure (how often at certain ends or starts), of each context.

        known_before and known_after lead from the frequent contexts to their
        shapes; all other contexts are shapes. expected(end, start, share) has
        the expected boundaries of each context before and after.
        """
        out = BoundaryModel()
        out.words_before, out.words_after = set(known_before), set(known_after)
        if not len(before):
            return out
        b_names, a_names = before.name.to_numpy(), after.name.to_numpy()
        n_before, n_after = before.n.to_numpy(np.float64), after.n.to_numpy(np.float64)
        at_end, at_start = before.sure.to_numpy(np.float64), after.sure.to_numpy(np.float64)
        total = n_before.sum()
        marks = np.array([_mark(x) for x in b_names])
        # certain ends per boundary inside units, from marks that hardly have another use
        sure = np.array([m in "!?" + STRONG and x[-2:-1] == " " for m, x in zip(marks, b_names)])
        rate = (at_end[sure].sum() + 1) / (n_before[sure].sum() + 2) if sure.any() else (at_end.sum() + 1) / (total * 0.6 + 2)
        out.rate = rate = max(rate, 1e-3)
        base_end = np.where([_is_abbreviation(x) for x in b_names], 0.03, np.where(marks == "…", 0.5, np.where(marks == ".", 0.7, 0.9)))
        base_start = np.array([_start_guess(x) for x in a_names])

        def direct(at: np.ndarray, count: np.ndarray, base: np.ndarray, names, shapes: dict[str, str]) -> np.ndarray:
            """Boundaries per occurrence, as certain ones tell; where these are few, as for the shape."""
            trust = 4.0
            first = dict(zip(names, (at + trust * base) / (count * rate + trust)))
            better = np.array([first.get(shapes.get(x, x), b) if b > 0.1 else b for x, b in zip(names, base)])
            return (at + trust * np.clip(better, 0, 0.98)) / (count * rate + trust)

        end0 = np.clip(direct(at_end, n_before, base_end, b_names, known_before), 0.002, 0.99)
        start0 = np.clip(direct(at_start, n_after, base_start, a_names, known_after), 0.005, 0.99)
        firm = lambda c: 1 + c * (1 + 20 * c * rate / (c * rate + 5))
        end, start = end0, start0
        share = float((end0 * n_before).sum() / total)
        for _ in range(ROUNDS):
            stay_before, stay_after = expected(end, start, share)
            end = np.clip((stay_before + firm(n_before) * end0) / (n_before + firm(n_before)), 0.002, 0.995)
            start = np.clip((stay_after + firm(n_after) * start0) / (n_after + firm(n_after)), 0.005, 0.995)
            share = float(stay_before.sum() / total)
        out.ends, out.starts, out.share = dict(zip(b_names, end.tolist())), dict(zip(a_names, start.tolist())), share
        for m in set(marks.tolist()):
            mine = marks == m
            out.mark[m] = float((end[mine] * n_before[mine]).sum() / n_before[mine].sum())
        return out

    def fit_gaps(self, events: Iterable[tuple[str, str, int]]) -> None:
        """Places without a mark, from (before, after, n): inside units, and at certain starts and ends of text.

        By Bayes' rule P(boundary | b, a) = P(boundary | b) P(a | boundary) / P(a | b).
        How often b stands at certain ends, against how often before a blank
        inside units, tells the first; certain starts in the same script tell the
        second, and the counts inside units the third.
        """
        inside, ends, starts = defaultdict(Counter), Counter(), defaultdict(Counter)
        for before, after, n in events:
            before, after = before.lstrip(GAP), after.lstrip(GAP)
            if after == STOP:
                ends[before] += n
            elif before == START:
                script, _, first = after.partition(" ")
                starts[script][first] += n
            else:
                inside[before][after] += n
        for before, found in inside.items():
            total, begun = found.total(), starts[before.partition(" ")[0]]
            end = min(0.99, (ends[before] + 4 * 0.01) / (total * self.rate + 4))
            for after, n in found.items():
                first = (begun[after] + 0.5) / (begun.total() + 0.5 * (len(begun) + 1))
                p = min(0.99, end * first * total / n)
                if p >= LEAST_ODDS:
                    self.gaps[before, after] = _logit(p)

    def places(self, unit: "Unit") -> list[tuple[int, int, float, bool]]:
        """(end of the sentence, start of the next, log odds, close to the place before) of the places of a unit, in order."""
        out = [(x[0], x[1], self.odds(x[2], x[3], x[4], x[5]), x[6] < 2) for x in unit.spots]
        more = [(g[0], g[1], score, False) for g in unit.gaps if (score := self.gaps.get(g[2:])) is not None]
        return sorted(out + more) if more else out

    def odds(self, before: str, before_shape: str, after: str, after_shape: str) -> float:
        """Log odds of a boundary between the context before and the token after."""
        known = before in self.words_before
        end = self.ends.get(before if known else before_shape)
        if not known and before != before_shape and _is_abbreviation(before):  # too rare to be counted by itself
            end = 0.03
        elif end is None:
            mark = _mark(before)
            end = 0.03 if _is_abbreviation(before) else self.mark.get(mark, 0.7 if mark == "." else 0.4 if mark == "…" else 0.95)
        start = self.starts.get(after if after in self.words_after else after_shape)
        if start is None:
            start = _start_guess(after)
        return float(_logit(end) + _logit(start) - _logit(self.share))


def _logit(p):
    return np.log(p) - np.log1p(-p) if isinstance(p, np.ndarray) else math.log(p) - math.log1p(-p)


def _start_guess(after: str) -> float:
    """How likely an unknown token begins a sentence where it follows a mark."""
    first = after.lstrip("<\"“«„(「『（¿¡‘'")[:2]
    if after[:1] in "<" and len(after) > 2:
        return 0.4 if after.endswith(("l>", "l1l>")) or after.startswith("<L1") else 0.6
    return 0.7 if first[:1].isupper() else 0.3 if first[:1].isdigit() else 0.4 if first[:1].islower() else 0.6


def _mark(before: str) -> str:
    tail = before.rsplit(" ", 1)[-1]
    return "…" if tail.startswith("_") else tail[:1]


def _is_abbreviation(before: str) -> bool:
    word, _, tail = before.rpartition(" ")
    return tail == "." and (word.lower() in ABBREVIATIONS and word != word.upper() or bool(re.fullmatch(r"<\w+1U>", word)))


def posteriors(places: list[tuple[int, int, float, bool]]) -> list[float]:
    """P(boundary) at each place, by forward-backward over the unit."""
    m = len(places)
    p = [1 / (1 + math.exp(-max(-60.0, min(60.0, x[2])))) for x in places]
    near = [SHORT if k and places[k][3] else 1.0 for k in range(m)]
    fore = [(1 - p[0], p[0])] if m else []
    for k in range(1, m):
        n0, n1 = fore[-1]
        f0, f1 = (1 - p[k]) * (n0 + n1), p[k] * (n0 + n1 * near[k])
        fore.append((f0 / (f0 + f1), f1 / (f0 + f1)))
    back = (1.0, 1.0)
    out = [0.0] * m
    for k in range(m - 1, -1, -1):
        y0, y1 = fore[k][0] * back[0], fore[k][1] * back[1]
        out[k] = y1 / (y0 + y1)
        stay0, stay1 = (1 - p[k]) * back[0], p[k] * back[1]
        b0, b1 = stay0 + stay1, stay0 + stay1 * near[k]
        back = (b0 / (b0 + b1), b1 / (b0 + b1))
    return out


def split_text(text: str, model: BoundaryModel) -> list[tuple[int, int]]:
    """(start, end) of each sentence, as Python counts (from 0, end exclusive)."""
    out = []
    for s, e, whole in units(text):
        cuts = []
        if not whole:
            places = model.places(Unit(text, s, e))
            cuts = [x[:2] for x, p in zip(places, posteriors(places)) if p > 0.5]
        at = s
        for stop, start in [*cuts, (e, e)]:
            piece = text[at:stop]
            lead = len(piece) - len(piece.lstrip())
            body = piece.strip()
            if body:
                out.append((at + lead, at + lead + len(body)))
            at = start
    return out


EVENTS = "before string, before_shape string, after string, after_shape string, n long"


def _events(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter = Counter()

    def flush() -> pd.DataFrame:
        out = pd.DataFrame([(*k, v) for k, v in held.items()], columns=["before", "before_shape", "after", "after_shape", "n"])
        held.clear()
        return out

    for frame in frames:
        for text in frame["text"]:
            for s, e, whole in units(text):
                if whole:
                    continue
                u = Unit(text, s, e)
                held.update(x[2:6] for x in u.spots)
                held.update((GAP + g[2], GAP, GAP + g[3], GAP) for g in u.gaps)
                if e - s >= LEAST_TEXT:
                    if u.closing is not None:
                        held[(GAP + u.closing, GAP, STOP, STOP)] += 1
                    if u.opening is not None:
                        held[(START, START, GAP + " ".join(u.opening), GAP)] += 1
                if u.last is not None:  # a unit that closes with a mark is text, others are headings
                    held[(u.last[0], u.last[1], STOP, STOP)] += 1
                    if u.first is not None:
                        held[(START, START, *u.first)] += 1
        if len(held) > 200_000:
            yield flush()
    if held:
        yield flush()


def train(df: DataFrame, text: str = "text") -> BoundaryModel:
    """Counts all texts once and fits the model to the counts."""
    rows = df.select(F.col(text).cast("string").alias("text")).filter(F.col("text").rlike(r"\S"))
    every = materialise(rows.mapInPandas(_events, EVENTS).groupBy("before", "before_shape", "after", "after_shape").agg(F.sum("n").alias("n")), "events")
    blank = F.col("before").startswith(GAP) | F.col("after").startswith(GAP)
    events = every.filter(~blank)
    total = events.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, math.ceil(total * RARE))

    def frequent(column: str) -> DataFrame:
        m = events.groupBy(column).agg(F.sum("n").alias("m"), F.min(f"{column}_shape").alias(f"keep_{column}"))
        return m.filter(F.col("m") >= least).drop("m")

    before, after = frequent("before"), frequent("after")
    mapped = events.join(before, "before", "left").join(after, "after", "left").select(
        F.when(F.col("keep_before").isNotNull(), F.col("before")).otherwise(F.col("before_shape")).alias("before"),
        F.when(F.col("keep_after").isNotNull(), F.col("after")).otherwise(F.col("after_shape")).alias("after"),
        "n",
    )
    cells = materialise(mapped.groupBy("before", "after").agg(F.sum("n").alias("n")), "cells")
    names_before, names_after = _sums(cells, "before", F.col("after") == STOP), _sums(cells, "after", F.col("before") == START)
    model = BoundaryModel.fit(names_before, names_after, dict(map(tuple, before.collect())), dict(map(tuple, after.collect())), _expectation(cells, names_before, names_after))
    model.fit_gaps(every.filter(blank).select("before", "after", "n").collect())  # pairs of shapes, of which there are some dozens a script
    discard(every)
    discard(cells)
    return model


def _sums(cells: DataFrame, column: str, certain) -> pd.DataFrame:
    """name, n, sure: how often each context is found inside units, and at certain ends or starts."""
    inside = (F.col("before") != START) & (F.col("after") != STOP)
    out = cells.groupBy(F.col(column).alias("name")).agg(F.sum(F.when(inside, F.col("n")).otherwise(0)).alias("n"), F.sum(F.when(certain, F.col("n")).otherwise(0)).alias("sure"))
    return out.filter("n > 0").toPandas().sort_values("name", ignore_index=True)


def _expectation(cells: DataFrame, names_before: pd.DataFrame, names_after: pd.DataFrame) -> Callable:
    """The expected boundaries of each context, summed over all cells on the workers."""
    spark = cells.sparkSession
    sizes = len(names_before), len(names_after)
    if not all(sizes):
        return lambda *_: (np.zeros(0), np.zeros(0))

    def codes(names: pd.DataFrame, column: str, code: str) -> DataFrame:
        return spark.createDataFrame(pd.DataFrame({column: names.name, code: np.arange(len(names))}), f"{column} string, {code} long")

    coded = cells.join(codes(names_before, "before", "b"), "before").join(codes(names_after, "after", "a"), "after").select("b", "a", "n")
    coded = materialise(coded, "coded")

    def expected(end: np.ndarray, start: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
        sent = spark.sparkContext.broadcast((_logit(end), _logit(start), _logit(share)))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            e, s, t = sent.value
            sums = [np.zeros(k, np.int64) for k in sizes]
            for f in frames:
                b, a = f.b.to_numpy(), f.a.to_numpy()
                stay = np.rint(f.n.to_numpy() * POINT / (1 + np.exp(-(e[b] + s[a] - t)))).astype(np.int64)
                np.add.at(sums[0], b, stay)
                np.add.at(sums[1], a, stay)
            for side, x in enumerate(sums):
                at = np.flatnonzero(x)
                yield pd.DataFrame({"side": side, "code": at, "stay": x[at]})

        found = coded.mapInPandas(run, "side int, code long, stay long").groupBy("side", "code").agg(F.sum("stay").alias("stay")).toPandas()
        sent.unpersist()
        out = [np.zeros(k) for k in sizes]
        for side, x in enumerate(out):
            mine = found[found.side == side]
            x[mine.code.to_numpy()] = mine.stay.to_numpy() / POINT
        return out[0], out[1]

    return expected


def split_sentences(df: DataFrame, key: str, text: str, model: BoundaryModel) -> DataFrame:
    """(key, start_pos, end_pos): one row per sentence, positions in characters from 1, both inclusive.

    Null and blank texts have no sentences; a text without any mark is one per
    unit; repeated rows give repeated sentences. Other columns are not read.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).filter(F.col("__text").rlike(r"\S"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            spans = [split_text(t, sent.value) for t in f["__text"]]
            n = [len(x) for x in spans]
            flat = np.array([p for x in spans for p in x], np.int32).reshape(-1, 2)
            yield pd.DataFrame({key: np.repeat(f["__key"].to_numpy(), n), "start_pos": flat[:, 0] + 1, "end_pos": flat[:, 1]})

    return rows.mapInPandas(run, f"`{key}` {dict(rows.dtypes)['__key']}, start_pos int, end_pos int")
