"""Near-duplicate sequences with small edits and moved blocks.

All texts are sorted by length and cut into tiles, and every pair of tiles whose
lengths lie within the radius is compared. The longer text of a pair is cut into
disjoint pieces; an edit destroys one of them at most and a moved block three, so
a pair within reach has at least so many pieces in common as are left. An index
of the pieces of a tile counts them for all texts of another, which rejects
exactly. The pieces are the longest of which enough are left, of two lengths.
Where texts are too short for pieces, and for what the pieces leave,
signatures do the same: bit sets of the words of 6 letters or, where these no
longer tell long sequences apart, of 7 or 8. One edit changes at most 2 * 6 bits,
so bit counts of an exclusive-or bound the edits from below. An alignment decides
the rest. No pair is left to chance; the work still grows with the square of the
collection, at a few nanoseconds a pair.

A task compares a pair of tiles, which it reads from the shared folder, so no
text is written more than twice: once to drop equal texts and once in its tile.
Equal texts are one entry and are led back to their representative at the end.
Texts are known by 128 bits of their hash.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import location, materialise

EDITS = 0.08  # edits per letter of the longer text
WORD = 6
TILE = 32768  # texts in a tile
CLASS = 32768  # texts of similar lengths that share an index, at most
CLASS_LETTERS = 2**24  # letters of such texts, about
PROBES = 64  # texts whose words are looked up together, at most; must fit beside a word of 11 letters in 32 bits
MOST_TASKS = 4096  # tasks that compare tiles
HITS = 2**16  # common pieces counted at once, about
SIGNATURE = 120  # nanoseconds, about, to reject a text by signatures
HELD = 4096  # pairs decided together, at least
BREAK_CELLS = 2**13  # words of 64 places held at once where breaks are counted
LETTERS_UP_TO = ((1200, 6), (3500, 7))  # longest text that words of so many letters tell apart; 8 beyond
CELLS = 2**23  # signature bits held at once
MOVES = 8  # moved blocks that the radius allows for
CODE = np.zeros(256, np.uint8)
CODE[list(b"ACGT")] = [0, 1, 2, 3]
PURE = np.zeros(256, bool)
PURE[list(b"ACGT")] = True


def _words(codes: np.ndarray, k: int, kind: type = np.uint64) -> np.ndarray:
    """2-bit codes of all k-letter words, by doubling; word i starts at letter i."""
    out, have, size = None, 0, 1
    power = codes.astype(kind)
    while True:
        if k & size:
            out = power if out is None else (out[: len(power) - have] << kind(2 * size)) | power[have : have + len(out)][: len(power) - have]
            have += size
        if have == k:
            return out[: max(0, len(codes) - k + 1)]
        power = (power[: max(0, len(power) - size)] << kind(2 * size)) | power[size:]
        size *= 2


def _in_reach(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return np.abs(n - m) <= EDITS * np.maximum(n, m) + 1e-9


def signatures(texts: list[bytes]) -> np.ndarray:
    """Bit sets of the 6-letter words, 64 words of 64 bits each."""
    out = np.zeros((len(texts), 4**WORD // 64), np.uint64)
    for i, t in enumerate(texts):
        flags = np.zeros(4**WORD, np.uint8)
        flags[_words(CODE[np.frombuffer(t, np.uint8)], WORD).astype(np.int64)] = 1
        out[i] = np.packbits(flags).view(np.uint64)
    return out


def radius(longest: np.ndarray, word: int = WORD) -> np.ndarray:
    """Most bits by which two signatures within reach can differ.

    An edit touches as many words as a word has letters, in either text; a
    moved block those over three junctions, one less over each.
    """
    most = np.floor(EDITS * longest + 1e-9)
    moved = np.minimum(most, MOVES)
    return 2 * word * (most - moved) + 6 * (word - 1) * moved


def _flags(texts: list[bytes], word: int, side: int) -> np.ndarray:
    """Signatures as rows of 0 and 1, and two columns by which the product of both sides is minus half the bits that differ."""
    size = np.array([len(t) for t in texts])
    out = np.zeros((len(texts), 4**word + 2), np.float32)
    if size.sum() >= word:
        w = _words(CODE[np.frombuffer(b"".join(texts), np.uint8)], word).astype(np.int64)
        row = np.repeat(np.arange(len(texts)), size)
        inside = row[: len(w)] == row[word - 1 :]
        out[row[: len(w)][inside], w[inside]] = 1
    out[:, 4**word + side] = out.sum(1) / -2
    out[:, 4**word + 1 - side] = 1
    return out


def _near_cells(x: list[bytes], y: list[bytes], same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the texts, sorted by length, whose signatures differ within the radius; i < j where x and y are the same."""
    nx, ny = (np.array([len(t) for t in s]) for s in (x, y))
    word = next((k for n, k in LETTERS_UP_TO if max(nx.max(), ny.max()) <= n), 8)
    wide = CELLS // 4**word
    high = max(1, wide // 2)
    for q in range(0, len(y), wide):
        right, m = None, ny[q : q + wide]
        for p in range(0, min(len(x), q + wide) if same else len(x), high):
            n = nx[p : p + high]
            if not (_in_reach(n.max(), m.min()) or _in_reach(n.min(), m.max()) or n.min() <= m.max() and m.min() <= n.max()):
                continue
            if right is None:
                right = _flags(y[q : q + wide], word, 1).T
            alike = _flags(x[p : p + high], word, 0) @ right
            i, j = np.nonzero(alike >= radius(max(n.max(), m.max()), word) / -2)
            near = (-2 * alike[i, j] <= radius(np.maximum(n[i], m[j]), word)) & _in_reach(n[i], m[j])
            if same:
                near &= i + p < j + q
            yield i[near] + p, j[near] + q


def _pack(t: bytes) -> bytes:
    """Four letters a byte where all are ACGT, else the letters themselves."""
    d = np.frombuffer(t, np.uint8)
    if not PURE[d].all():
        return b"\1" + t
    c = np.zeros((len(d) + 3) // 4 * 4, np.uint8)
    c[: len(d)] = CODE[d]
    c = c.reshape(-1, 4)
    return bytes([2 + len(d) % 4]) + (c[:, 0] << 6 | c[:, 1] << 4 | c[:, 2] << 2 | c[:, 3]).tobytes()


LETTERS = np.frombuffer(b"ACGT", np.uint8)


def _unpack(p: bytes) -> bytes:
    if p[0] == 1:
        return p[1:]
    b = np.frombuffer(p, np.uint8)[1:]
    t = LETTERS[np.stack([b >> 6, b >> 4 & 3, b >> 2 & 3, b & 3], 1).ravel()].tobytes()
    over = (p[0] - 2) % 4
    return t[: len(t) - (4 - over)] if over else t


def edit_distance(a: bytes, b: bytes, most: int | None = None) -> int:
    """Levenshtein distance by bit vectors held in integers, or a number above most where it is above."""
    if not a or not b:
        return len(a) + len(b)
    peq: dict[int, int] = {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << i
    m, top, mask = len(a), 1 << (len(a) - 1), (1 << len(a)) - 1
    up, down, score = mask, 0, m
    for left, c in zip(range(len(b) - 1, -1, -1), b):
        eq = peq.get(c, 0)
        diag = ((eq & up) + up ^ up) | eq | down
        plus, minus = down | ~(diag | up), up & diag
        score += bool(plus & top) - bool(minus & top)
        if most is not None and score - left > most:
            return score - left
        plus, minus = plus << 1 | 1, minus << 1
        up, down = (minus | ~(diag | plus)) & mask, plus & diag & mask
    return score


ANCHOR, STRIDE, BLOCK = 12, 4, 20
DROP = 8


def _run(x: bytes, y: bytes) -> int:
    """Letters from the start of x and y that mostly agree: up to the best score before it drops by 8."""
    score = best = size = 0
    for i, (c, d) in enumerate(zip(x, y), 1):
        score += 1 if c == d else -2
        if score > best:
            best, size = score, i
        elif score < best - DROP:
            break
    return size


def moved_distance(a: bytes, b: bytes, most: int, loose: bool = False, anchor: int = ANCHOR) -> int:
    """Upper bound of the edits from a to b where a moved block counts as one.

    Blocks of b are found in a by short anchors. The heaviest chain in
    order stays in place; other blocks of 20 letters or more count as moved and
    are taken out of both texts, with ``loose`` together with what lies between
    them and their neighbours. What is left between the blocks is aligned.
    """
    where: dict[bytes, int] = {}
    for i in range(len(a) - anchor, -1, -1):
        where[a[i : i + anchor]] = i
    blocks: list[list[int]] = []  # start in b, end in b, start in a
    j, end = 0, len(b) - anchor
    while j <= end:
        piece = b[j : j + anchor]
        if blocks:
            s, e, at = blocks[-1]
            if a[at + j - s : at + j - s + anchor] == piece:
                if j <= e + 4 * anchor:
                    blocks[-1][1] = j + anchor
                    j += (STRIDE if anchor == ANCHOR else 1)
                    continue
                blocks.append([j, j + anchor, at + j - s])
                j += (STRIDE if anchor == ANCHOR else 1)
                continue
        i = where.get(piece)
        if i is not None:
            blocks.append([j, j + anchor, i])
            j += (STRIDE if anchor == ANCHOR else 1)
        else:
            j += 1
    grown: list[list[int]] = []
    starts = [x[0] for x in blocks]
    for x, (s, e, at) in enumerate(blocks):  # both ways as far as most letters agree
        low = grown[-1][1] if grown else 0
        back_by = _run(b[low:s][::-1], a[:at][::-1])
        s, at = s - back_by, at - back_by
        if grown and s < low:
            at += low - s
            s = low
        e += _run(b[e : starts[x + 1] if x + 1 < len(starts) and starts[x + 1] >= e else len(b)], a[at + e - s :])
        if e > s:
            grown.append([s, e, at])
    # heaviest chain of blocks in order in a as well
    n = len(grown)
    best = [e - s for s, e, _ in grown]
    back = [-1] * n
    for y in range(n):
        for x in range(y):
            if grown[x][2] + grown[x][1] - grown[x][0] <= grown[y][2] + anchor and grown[x][2] < grown[y][2]:
                w = best[x] + grown[y][1] - grown[y][0]
                if w > best[y]:
                    best[y], back[y] = w, x
    chain, y = set(), max(range(n), key=best.__getitem__) if n else -1
    while y >= 0:
        chain.add(y)
        y = back[y]
    kept = sorted((at, s, e - s, x in chain) for x, (s, e, at) in enumerate(grown) if x in chain or e - s >= BLOCK)
    blocks_, free = [], 0
    for at, s, size, stays in kept:  # no letter of a is used twice
        over = max(0, free - at)
        if size > over:
            blocks_.append((at + over, s + over, size - over, stays))
            free = at + size
    cost = 0
    for at, s, size, _ in blocks_:
        if a[at : at + size] != b[s : s + size]:
            cost += int(np.count_nonzero(np.frombuffer(a[at : at + size], np.uint8) != np.frombuffer(b[s : s + size], np.uint8)))
    # blocks that moved side by side, apart from edits between them, moved as one
    in_b = {x[1]: i for i, x in enumerate(sorted(blocks_, key=lambda x: x[1]))}
    moved: list[list[int]] = []
    for x, (at, s, size, stays) in enumerate(blocks_):
        if stays:
            continue
        if x and not blocks_[x - 1][3] and in_b[s] == in_b[blocks_[x - 1][1]] + 1:
            cost += edit_distance(a[moved[-1][1] : at], b[moved[-1][3] : s])
            moved[-1][1], moved[-1][3] = at + size, s + size
        else:
            moved.append([at, at + size, s, s + size])
    cost += len(moved)
    gone_a, gone_b = [], []
    ends_a = sorted([0] + [x[0] + x[2] for x in blocks_]), sorted([x[0] for x in blocks_] + [len(a)])
    ends_b = sorted([0] + [x[1] + x[2] for x in blocks_]), sorted([x[1] for x in blocks_] + [len(b)])
    for lo_a, hi_a, lo_b, hi_b in moved:
        at, s = lo_a, lo_b
        if loose:  # what the block drags along on either side
            ga, gb = a[ends_a[0][bisect_right(ends_a[0], at) - 1] : at], b[ends_b[0][bisect_right(ends_b[0], s) - 1] : s]
            if ga and gb and (d := edit_distance(ga, gb)) < min(len(ga), len(gb)):
                cost, lo_a, lo_b = cost + d, at - len(ga), s - len(gb)
            ga, gb = a[hi_a : ends_a[1][bisect_left(ends_a[1], hi_a)]], b[hi_b : ends_b[1][bisect_left(ends_b[1], hi_b)]]
            if ga and gb and (d := edit_distance(ga, gb)) < min(len(ga), len(gb)):
                cost, hi_a, hi_b = cost + d, hi_a + len(ga), hi_b + len(gb)
        gone_a.append((lo_a, hi_a))
        gone_b.append((lo_b, hi_b))
    gone_a.sort()
    gone_b.sort()
    last_a = last_b = 0
    for at, s, size, _ in [x for x in blocks_ if x[3]] + [(len(a), len(b), 0, True)]:
        cost += edit_distance(_without(a, last_a, at, gone_a), _without(b, last_b, s, gone_b))
        last_a, last_b = at + size, s + size
        if cost > 3 * most + 20:
            break
    return cost


def parse_distance(a: bytes, b: bytes, most: int, jump: int = 2) -> int:
    """Upper bound of the edits from a to b where a moved block counts as one, for any number and size of moved blocks.

    b is read from left to right as pieces of a, letters edited at a price of
    one each; going on at another place of a costs ``jump`` edits. Of the pieces
    found, those that the longest rising chain of their places leaves out were
    moved; letters of a that no piece uses were deleted, those used more than
    once were inserted. Gives up, with ``most`` + 1, where more is spent than
    ``most`` edits and the jumps of ``MOVES`` moved blocks.
    """
    x, n, m = np.frombuffer(a, np.uint8), len(a), len(b)
    kind = np.int16 if 2 * max(n, m) + 99 < 2**15 else np.int32
    place = np.arange(n + 1, dtype=kind)
    cost = np.empty((m + 1, n + 1), kind)
    cost[0] = 0
    differs_at = {c: (x != c).astype(kind) for c in set(b)}
    best = np.empty(m, np.int64)  # where it is cheapest to jump from
    for j in range(m):
        d = cost[j]
        best[j] = d.argmin()
        ready = np.minimum(d, kind(d[best[j]] + jump))
        step = ready + kind(1)
        np.minimum(step[1:], ready[:-1] + differs_at[b[j]], out=step[1:])
        step -= place
        np.add(np.minimum.accumulate(step, out=step), place, out=cost[j + 1])
        if j % 64 == 63 and cost[j + 1].min() > most + 3 * jump * MOVES:
            return most + 1
    i, j, spent = int(cost[m].argmin()), m, 0
    pieces, high = [], i
    while j > 0:
        d, now = cost[j - 1], cost[j, i]
        if i and cost[j, i - 1] + 1 == now:
            i, spent = i - 1, spent + 1
            continue
        differs = i and a[i - 1] != b[j - 1]
        if i and min(d[i - 1], d[best[j - 1]] + jump) + differs == now:
            i, spent = i - 1, spent + int(differs)
        else:
            spent += 1
        j -= 1
        if j and cost[j, best[j]] + jump < cost[j, i]:
            pieces.append((i, high))
            i = high = int(best[j])
    pieces.append((i, high))
    chain: list[int] = []
    times = np.zeros(n + 1, np.int64)
    real = [p for p in reversed(pieces) if p[1] > p[0]]
    for low, high in real:
        times[low] += 1
        times[high] -= 1
        at = bisect_left(chain, low)
        chain[at : at + 1] = [low]
    used = np.cumsum(times)[:n]
    return spent + int((used == 0).sum() + np.maximum(used - 1, 0).sum()) + len(real) - len(chain)


def _without(text: bytes, low: int, high: int, gone: list[tuple[int, int]]) -> bytes:
    """text[low:high] without the blocks that were moved."""
    out = []
    for s, e in gone:
        if s >= low and e <= high and e > low:
            out.append(text[low:s])
            low = e
    return b"".join(out) + text[low:high]


def within_reach(a: bytes, b: bytes, near: bool = False) -> bool:
    """near: the signatures are known to lie within the radius."""
    most = int(EDITS * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    if len(a) == len(b) and np.count_nonzero(np.frombuffer(a, np.uint8) != np.frombuffer(b, np.uint8)) <= most:
        return True
    if not near:
        one, two = signatures([a, b])
        if np.bitwise_count(one ^ two).sum() > radius(np.array([max(len(a), len(b))]))[0]:
            return False
    if greedy_distance(a, b, most) <= most:
        return True
    least = damage(max(len(a), len(b)))
    return breaks(a, b) <= least and breaks(b, a) <= least and _reached(a, b, most)


def all_within_reach(pairs: list[tuple[bytes, bytes]]) -> np.ndarray:
    """within_reach, near, of many pairs whose lengths are in reach; breaks are counted for all of them together."""
    out = np.zeros(len(pairs), bool)
    for x, (a, b) in enumerate(pairs):
        most = int(EDITS * max(len(a), len(b)) + 1e-9)
        out[x] = len(a) == len(b) and np.count_nonzero(np.frombuffer(a, np.uint8) != np.frombuffer(b, np.uint8)) <= most or greedy_distance(a, b, most) <= most
    left = np.flatnonzero(~out)
    for turned in (1, -1):
        left = left[few_breaks([pairs[x][::turned] for x in left])]
    for x in left:
        a, b = pairs[x]
        out[x] = _reached(a, b, int(EDITS * max(len(a), len(b)) + 1e-9))
    return out


def greedy_distance(a: bytes, b: bytes, most: int) -> int:
    """Upper bound of the edits from a to b without moved blocks: after a difference the nearest places from which letters agree again.

    Gives up with more than ``most`` where there are none near.
    """
    i = j = cost = 0
    while cost <= most:
        size = 64
        while size:
            if max(i + size - len(a), j + size - len(b)) <= 0 and a[i : i + size] == b[j : j + size]:
                i, j = i + size, j + size
            else:
                size //= 2
        rest = max(len(a) - i, len(b) - j)
        if rest <= AGREE:
            return cost + rest
        for e, x, y in RESUME:
            if a[i + x : i + x + AGREE] == b[j + y : j + y + AGREE]:
                i, j, cost = i + x, j + y, cost + e
                break
        else:
            return cost + rest
    return cost


AGREE = 8
RESUME = [(e, x, y) for e in range(1, 7) for x, y in [(e, e)] + [p for k in range(e - 1, -1, -1) for p in ((e, k), (k, e))]]


def breaks(a: bytes, b: bytes) -> int:
    """Fewest places at which b, read as pieces from anywhere in a, breaks: a letter replaced or inserted or a jump.

    An edit makes one break at most and a moved block three, so it is a lower
    bound for ``damage``. Places of a at the lowest number of breaks are bits of
    an integer; all others take one more, by a jump.
    """
    where: dict[int, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 2 << i
    every = (2 << len(a)) - 1
    at, count = every, 0
    for c in b:
        after = where.get(c, 0)
        on = at << 1 & after
        if not on:
            count += 1
            on = (at << 1 | at | after) & every
        at = on
    return count


def few_breaks(pairs: list[tuple[bytes, bytes]]) -> np.ndarray:
    """Of each pair (a, b), whether ``breaks(a, b)`` is no more than edits within reach can make."""
    out = np.zeros(len(pairs), bool)
    order = sorted(range(len(pairs)), key=lambda x: len(pairs[x][0]))
    while order:
        wide = len(pairs[order[-1]][0]) // 64 + 1
        some = order[-max(1, BREAK_CELLS // wide) :]
        del order[-len(some) :]
        out[some] = _few_breaks([pairs[x] for x in some], wide)
    return out


def _few_breaks(pairs: list[tuple[bytes, bytes]], wide: int) -> np.ndarray:
    """The same, with the places of each a as bits of ``wide`` words of 64, a column for each pair.

    Neighbouring places lie in neighbouring words, so going on by a place moves words and shifts only the last.
    """
    letters = np.zeros(256, np.int64)
    kinds = np.flatnonzero(np.bincount(np.frombuffer(b"".join(t for p in pairs for t in p), np.uint8), minlength=256))
    letters[kinds] = np.arange(len(kinds))
    size = np.array([len(b) for _, b in pairs])
    text = np.zeros((len(pairs), -(-size.max() // 32) * 32), np.int64)
    where = np.zeros((len(pairs), len(kinds), 8 * wide), np.uint8)
    every = np.zeros((wide, len(pairs)), np.uint64)
    place = np.arange(64 * wide).reshape(wide, 64).T.ravel()
    for x, (a, b) in enumerate(pairs):
        flags = np.zeros((len(kinds) + 1, 64 * wide), np.uint8)
        flags[letters[np.frombuffer(a, np.uint8)], place[1 : len(a) + 1]] = 1
        flags[-1, place[: len(a) + 1]] = 1
        bits = np.packbits(flags, axis=1, bitorder="little")
        where[x], every[:, x] = bits[:-1], bits[-1].view(np.uint64)
        text[x, : len(b)] = letters[np.frombuffer(b, np.uint8)]
    where = where.reshape(-1, 8 * wide).view(np.uint64)
    least = np.array([damage(max(len(a), len(b))) for a, b in pairs])
    count, out, left = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool), np.arange(len(pairs))
    at = every.copy()
    for q in range(0, text.shape[1], 32):
        some = where[(len(kinds) * left[:, None] + text[left, q : q + 32]).T]  # letter of b, pair, word
        some = np.ascontiguousarray(some.transpose(0, 2, 1))
        moved, on = np.empty_like(at), np.empty_like(at)
        for j, after in enumerate(some, q):
            np.add(at[-1], at[-1], out=moved[0])
            moved[1:] = at[:-1]
            np.bitwise_and(moved, after, out=on)
            broken = np.bitwise_or.reduce(on, axis=0) == 0
            moved |= at
            moved |= after
            moved &= every & (np.uint64(0) - broken.astype(np.uint64))
            np.bitwise_or(on, moved, out=at)
            count += broken & (size > j)
        ended = size <= q + 32
        out[left[ended & (count <= least)]] = True
        stay = ~ended & (count <= least)
        left, count, least, size, at, every = left[stay], count[stay], least[stay], size[stay], np.ascontiguousarray(at[:, stay]), np.ascontiguousarray(every[:, stay])
        if not len(left):
            break
    return out


def _reached(a: bytes, b: bytes, most: int) -> bool:
    """Whether one of the dearer upper bounds is within reach, the cheapest first."""
    return any(moved_distance(x, y, most, loose, anchor) <= most for anchor in (ANCHOR, 8) for loose in (False, True) for x, y in ((a, b), (b, a))) or edit_distance(a, b, most) <= most or parse_distance(a, b, most) <= most or parse_distance(b, a, most) <= most


def damage(n: int) -> int:
    """Most disjoint pieces of a text of n letters, the longer of two, that edits within reach can destroy: each one, a moved block three."""
    most = int(EDITS * n + 1e-9)
    return most + 2 * min(most, MOVES)


@cache
def _cut(n: int, k: int) -> tuple[float, int, int, int]:
    """(nanoseconds, about, pieces of k letters, pieces of k - 1 letters, pieces in common at least): the cheapest way to reject a text of n letters by disjoint pieces.

    With more pieces more must be left, but the pieces are shorter: the fewest
    that leave enough to tell texts apart are best, not the most of one length.
    """
    best = (math.inf, 0, 0, 0)
    for need in range(1, n):
        pieces = damage(n) + need
        long = min(pieces, n - pieces * (k - 1))
        chance = (long + 4 * (pieces - long)) * min(1, n / 4**k)  # pieces that texts have in common by chance
        if long < 0 or 9 * chance >= min(best[0], SIGNATURE):
            break
        below = sum(math.exp(i * math.log(chance) - chance - math.lgamma(i + 1)) for i in range(need))
        best = min(best, (9 * chance + 150 * max(0.0, 1 - below), long, pieces - long, need))
    return best


def _price(n: int, k: int) -> float:
    """Nanoseconds, about, to reject a text of n letters by pieces of k and k - 1 letters, or by signatures where k is 0."""
    return _cut(n, k)[0] if k else SIGNATURE


@cache
def piece(n: int) -> int:
    """Letters of the longer pieces that reject texts of n letters at the lowest price."""
    return min((0, *range(5, 12)), key=lambda k: _price(n, k))


class Tile:
    """Texts sorted by length, as codes of their letters; text i starts at letter start[i]."""

    def __init__(self, keys: pa.Array, n: np.ndarray, texts: pa.Array):
        order = np.argsort(n, kind="stable")
        self.keys, self.n, texts = keys.take(pa.array(order)).to_pylist(), n[order], texts.take(pa.array(order))
        at, data = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1].astype(np.int64), np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        self.start = 4 * (at[:-1] + 1)
        self.other = {int(i): data[at[i] + 1 : at[i + 1]].tobytes() for i in np.flatnonzero(data[at[:-1]] == 1)}
        codes, size = [np.stack([data >> 6, data >> 4 & 3, data >> 2 & 3, data & 3], 1).ravel()], 4 * len(data)
        for i, t in self.other.items():
            self.start[i] = size
            size += len(t)
            codes.append(CODE[np.frombuffer(t, np.uint8)])
        self.codes = np.concatenate(codes)
        self.bits, self.known = np.zeros((len(n), 4**WORD // 64), np.uint64), np.zeros(len(n), bool)

    def text(self, i: int) -> bytes:
        return self.other[i] if i in self.other else LETTERS[self.codes[self.start[i] : self.start[i] + self.n[i]]].tobytes()

    def words(self, which: np.ndarray, k: int, over: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(row of which, word) of all words of k letters, also of those that reach ``over`` letters beyond their text, where any letters stand."""
        n = self.n[which]
        codes = np.concatenate([*(self.codes[s : s + m] for s, m in zip(self.start[which].tolist(), n.tolist())), np.zeros(over, np.uint8)])
        row = np.repeat(np.arange(len(which), dtype=np.uint32), n)
        w = _words(codes, k, np.uint32) if len(codes) >= k else np.zeros(0, np.uint32)
        inside = row[: len(w)] == row[len(row) - len(w) :]
        return row[: len(w)][inside], w[inside]

    def different_words(self, first: int, last: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, word), by words, of the different words of k letters of texts first to last, up to PROBES; the last word of a text has any letter added."""
        row, word = self.words(np.arange(first, last), k, 1)
        seen = word * np.uint32(PROBES) + row
        seen.sort()
        if len(seen):
            seen = seen[np.concatenate([[True], seen[1:] != seen[:-1]])]
        return (seen % np.uint32(PROBES)).astype(np.int32), (seen // np.uint32(PROBES)).astype(np.int64)

    def signatures(self, which: np.ndarray) -> np.ndarray:
        new = np.unique(which[~self.known[which]])
        for q in range(0, len(new), 256):
            some = new[q : q + 256]
            flags = np.zeros((len(some), 4**WORD), np.uint8)
            flags[self.words(some, WORD)] = 1
            self.bits[some] = np.packbits(flags, axis=1).view(np.uint64)
        self.known[new] = True
        return self.bits[which]

    def classes(self) -> Iterator[tuple[int, int, int]]:
        """(from, to, letters of pieces): neighbours that are indexed together."""
        lengths, first = np.unique(self.n, return_index=True)
        low, k = 0, piece(int(lengths[0])) if len(lengths) else 0
        for n, at in zip(lengths.tolist(), first.tolist()):
            size = at - low
            if size and (_price(n, k) > 1.3 * _price(n, piece(n)) + 0.5 or size >= CLASS or k and size * n >= CLASS_LETTERS or not k and size >= CLASS // 8 and n > 1.05 * self.n[low]):
                yield low, at, k
                low = at
            if low == at:
                k = piece(n)
        if len(self.n):
            yield low, len(self.n), k


class _Pieces:
    """Index of the pieces of texts low to high of a tile, open for the texts of a range that moves on.

    A piece of k - 1 letters is entered with each letter that can follow it.
    """

    def __init__(self, tile: Tile, low: int, high: int, k: int):
        n = tile.n[low:high].astype(np.int64)
        lengths, which = np.unique(n, return_inverse=True)
        _, long, short, need = (np.array(x)[which] for x in zip(*(_cut(int(m), k) for m in lengths)))
        pieces = long + short
        text = np.repeat(np.arange(high - low, dtype=np.int32), pieces)
        number = np.arange(len(text), dtype=np.int32) - np.repeat((np.cumsum(pieces) - pieces).astype(np.int32), pieces)
        beyond = number - np.repeat(long.astype(np.int32), pieces)  # those of k - 1 letters come last
        at = np.repeat(tile.start[low:high], pieces) + k * number - np.maximum(beyond, 0)
        word = np.zeros(len(text), np.int32)
        for letter in range(k - 1):
            word = word << 2 | tile.codes[at + letter]
        times = np.where(beyond < 0, 1, 4)
        word = word << 2 | np.where(beyond < 0, tile.codes[np.minimum(at + k - 1, len(tile.codes) - 1)], 0)
        self.ends = np.concatenate([[0], np.cumsum(long + 4 * short)])
        first = (np.cumsum(times) - times).astype(np.int32)
        self.words = np.repeat(word - first, times)
        self.words += np.arange(len(self.words), dtype=np.int32)
        entries = self.words.astype(np.int64)
        entries <<= 32
        entries |= np.repeat(text, times)
        entries.sort()
        self.texts = entries.astype(np.int32)  # the lower half
        self.begin = np.zeros(4**k, np.int32)
        np.cumsum(np.bincount(self.words, minlength=4**k)[:-1], out=self.begin[1:])
        self.stop, self.first, self.last, self.need = self.begin.copy(), 0, 0, need

    def move(self, first: int, last: int) -> None:
        """Texts first to last of the index, or more, count from here on; first may not fall."""
        last = max(last, self.last)
        np.add.at(self.begin, self.words[self.ends[self.first] : self.ends[first]], np.int32(1))
        np.add.at(self.stop, self.words[self.ends[self.last] : self.ends[last]], np.int32(1))
        self.first, self.last = first, last


def _common_pieces(index: Tile, low: int, high: int, k: int, probe: Tile, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): texts low to high of index and first to last of probe, whose lengths are in reach, with so many pieces of i in j that they can be within reach."""
    size, n = high - low, index.n[low:high]
    pieces = _Pieces(index, low, high, k)
    least, numbers, one, step = int(pieces.need.min()), np.arange(4 * HITS), first, PROBES // 4
    while one < last:
        end = min(one + step, last)
        top = int(np.searchsorted(n, probe.n[end - 1] / (1 - EDITS) + 1e-6, side="right"))
        pieces.move(max(0, min(one - low, top)) if index is probe else 0, top)
        row, word = probe.different_words(one, end, k)
        start = pieces.begin.take(word, mode="clip").astype(np.int64)
        hits = pieces.stop.take(word, mode="clip") - start
        past = np.cumsum(hits)
        total = int(past[-1]) if len(past) else 0
        step = max(1, min(PROBES, (end - one) * HITS // max(1, total)))
        if total > len(numbers):
            if end - one > 1:
                continue
            numbers = np.arange(total)
        if total >= least:
            entry = np.repeat(start - (past - hits), hits)
            entry += numbers[:total]
            both = pieces.texts.take(entry, mode="clip")
            both += np.repeat(row * np.int32(size), hits)
            both.sort()
            found, count = np.unique(both[np.flatnonzero(both[least - 1 :] == both[: total - least + 1])], return_counts=True)
            j, i = np.divmod(found, size)
            enough = count + least - 1 >= pieces.need[i]
            yield i[enough].astype(np.int64) + low, j[enough].astype(np.int64) + one
        one = end


def _candidates(index: Tile, probe: Tile) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): all texts of index and shorter ones of probe, or the ones before them in the same tile, whose lengths, pieces and signatures lie within the radius."""
    same = index is probe
    for low, high, k in index.classes():
        first = int(np.searchsorted(probe.n, index.n[low] * (1 - EDITS) - 1e-6))
        last = high if same else len(probe.n)
        if first >= last:
            continue
        if k:
            found = _common_pieces(index, low, high, k, probe, first, last)
        else:
            found = _short(index, low, high, probe, first, last)
        for i, j in found:
            near = _in_reach(index.n[i], probe.n[j])
            if same:
                near &= j < i
            i, j = i[near], j[near]
            for q in range(0, len(i), 8192):
                one, two = i[q : q + 8192], j[q : q + 8192]
                far = np.bitwise_count(index.signatures(one) ^ probe.signatures(two)).sum(1)
                near = far <= radius(np.maximum(index.n[one], probe.n[two]))
                yield one[near], two[near]


def _short(index: Tile, low: int, high: int, probe: Tile, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same for texts too short for pieces."""
    y = [index.text(i) for i in range(low, high)]
    if index is probe:
        for j, i in _near_cells(y, y, True):
            yield i + low, j + low
        last = min(last, low)
    if first < last:
        for j, i in _near_cells([probe.text(j) for j in range(first, last)], y, False):
            yield i + low, j + first


def _compare(index: Tile, probe: Tile) -> Iterator[pd.DataFrame]:
    held: list[tuple[int, int]] = []

    def decided() -> pd.DataFrame:
        reached = all_within_reach([(index.text(x), probe.text(y)) for x, y in held])
        out = pd.DataFrame([(index.keys[x], probe.keys[y]) for (x, y), r in zip(held, reached) if r], columns=["key_a", "key_b"], dtype=object)
        held.clear()
        return out

    for i, j in _candidates(index, probe):
        held += zip(i.tolist(), j.tolist())
        if len(held) >= HELD:
            yield decided()
    if held:
        yield decided()


def _read_tile(folder: str, tile: int) -> Tile:
    files, path = FileSystem.from_uri(folder)
    t = pq.read_table(f"{path}/tile={tile}", columns=["key", "n", "text"], filesystem=files, partitioning=None).combine_chunks()
    key, n, text = (t.column(c).combine_chunks() for c in ("key", "n", "text"))
    return Tile(key, n.to_numpy(), text.cast(pa.binary()))


def _compare_tiles(folder: str, work: list[tuple[int, int]]):
    """Compares the pairs of tiles (longer, shorter) of which it gets the numbers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, index = None, None
        for f in frames:
            for number in f.id.tolist():
                longer, shorter = work[number]
                if longer != held:
                    held, index = longer, _read_tile(folder, longer)
                yield from _compare(index, index if shorter == longer else _read_tile(folder, shorter))

    return run


def _number_tiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of ranges of lengths, sorted: the tile of each."""
    last, seen = -1, 0
    for f in frames:
        part = f.part.to_numpy().astype(np.int64)
        begins = np.flatnonzero(np.diff(part, prepend=-1))
        place = np.arange(len(f)) - np.repeat(begins, np.diff(begins, append=len(f)))
        if len(f):
            place[part == last] += seen
            last, seen = part[-1], place[-1] + 1
        yield f.drop(columns="part").assign(tile=part << 32 | place // TILE)


def _packed(lengths: np.ndarray, counts: np.ndarray, parts: int):
    """Cuts the texts, by length and hash, into so many parts of about the same number, given how many there are of each length."""
    below = np.cumsum(counts) - counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(part, n, h, key, text) with the text packed, only once for each that a task meets more than once."""
        seen: set[bytes] = set()
        for batch in batches:
            hashes = batch.column(0).to_pylist()
            letters = [t.encode() for t in batch.column(2).to_pylist()]
            texts = [_pack(t) if h not in seen and not seen.add(h) else None for h, t in zip(hashes, letters)]
            n = np.array([len(t) for t in letters], np.int32)
            at = np.minimum(np.searchsorted(lengths, n), len(lengths) - 1)
            place = below[at] + counts[at] * (np.frombuffer(b"".join(h[:4] for h in hashes), ">u4") / 2**32)
            part = np.minimum(place * parts / counts.sum(), parts - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(n), batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["part", "n", "h", "key", "text"])

    return run


class NearDuplicates:
    """Near-duplicate relation of a table of sequences.

    df: any table with a key and a text column, no other is read. Null and
    empty texts, and rows of a null key, belong to no pair; letter case makes
    no difference; equal texts are copies of the one with the smallest key.
    """

    def __init__(self, df: DataFrame, key: str, text: str):
        rows = df.select(F.col(key).cast("string").alias("key"), F.upper(F.col(text)).alias("seq")).filter("key IS NOT NULL AND seq <> ''")
        self.rows = rows.withColumn("h", F.unhex(F.md5("seq")))
        self._tiles: DataFrame | None = None

    def tiles(self) -> DataFrame:
        """(key, n, text, tile): one row per different text, its smallest key, length and packed letters, in tiles sorted by length."""
        if self._tiles is None:
            # the range of a text follows from the numbers of each length; a range partitioning would pack all texts once more for its sample
            spark = self.rows.sparkSession
            lengths = sorted(map(tuple, self.rows.groupBy(F.octet_length("seq")).count().collect())) or [(1, 1)]
            n, counts = (np.array(x, np.int64) for x in zip(*lengths))
            parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(1.1 * counts.sum() / TILE) + 1)
            packed = self.rows.select("h", "key", "seq").mapInArrow(_packed(n, counts, parts), "part int, n int, h binary, key string, text binary")
            one = packed.repartition("part").groupBy("part", "n", "h").agg(F.min("key").alias("key"), F.max("text").alias("text"))
            ranges = one.select("part", "key", "n", "text", "h").sortWithinPartitions("part", "n", "h").drop("h")
            self._tiles = materialise(ranges.mapInPandas(_number_tiles, "key string, n int, text binary, tile long"), "tiles", by="tile")
        return self._tiles

    def representatives(self) -> DataFrame:
        """(key_a, key_b), the smaller first: pairs of different texts within reach."""
        tiles = self.tiles()
        spark = tiles.sparkSession
        span = sorted(map(tuple, tiles.groupBy("tile").agg(F.min("n"), F.max("n")).collect()), reverse=True)
        work = [(t, u) for x, (t, low, _) in enumerate(span) for u, _, high in span[x:] if high >= low * (1 - EDITS) - 1e-6]
        found = spark.range(0, len(work), 1, max(1, min(len(work), MOST_TASKS))).mapInPandas(_compare_tiles(location(tiles), work), "key_a string, key_b string")
        return found.select(F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b"))

    def copies(self) -> DataFrame:
        """(key_a, key_b): each copy of a text with its representative."""
        groups = self.rows.groupBy("h").agg(F.min("key").alias("key_a"), F.count("*").alias("n")).filter("n > 1")
        return self.rows.select("h", F.col("key").alias("key_b")).join(groups, "h").filter("key_a <> key_b").select("key_a", "key_b").distinct()

    def pairs(self) -> DataFrame:
        return self.representatives().unionByName(self.copies())
