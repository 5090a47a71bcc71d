"""Near-duplicate passages by compact windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from orrery.llm import groups, words as T
from orrery.llm.graph import components
from orrery.llm.segments import spread
from orrery.sources.storage import written

K = 5  # words of a shingle
LEAST = 50  # words of a passage
HASHES, ENOUGH = 4, 2  # of 4 minima 2 agree: always for equal passages, 95 times in 100 at similarity 0.75
SLANT = 24  # places by which the offset of two passages may drift
GAPS = [12, 6, 1]  # shingles from one with a counterpart to the next inside a run, tried in turn where no joined span is similar; 1: none left out
CHUNK = 4 << 20  # bytes of text in which equal windows meet before the shuffle
RUNS = 256  # runs of equal shingles of two texts of which all pairs are counted at once
OFTEN = 64  # windows of a part from which a shingle is counted by a matrix product
OVERLAP = 25  # words that two spans of a document share if they are one passage
STEPS, STRIDE, BITS = 12, 4, 5  # of a window's context: shingles read beside its centre, places from one to the next, bits of each
BLOCK = 1 << 18  # windows whose contexts are compared at once; a key that has more is cut
PAIRS = 16  # windows of a key of which all are linked at once; in larger keys those that no passage connects are compared by shingles
LARGE = 8  # no hash: a window of a larger key
PART = 1024  # windows of a larger key compared with as many others in a task
BUCKET = 1 << 14  # windows of a key whose shingles are looked up in each other's at once; of more by ranges of shingles
TRIES = 2  # window pairs of two texts tried in a task; those left over are verified on the texts

_MULTIPLY = np.random.default_rng(31).integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64(0xFFFF)
_NEVER, _BEYOND = 1 << 28, 1 << 20  # larger than any sum over a window's shingles; a place outside the window
_WINDOW = pa.struct([("uid", pa.int64()), ("left", pa.int64()), ("right", pa.int64())])
WINDOW = "struct<uid:bigint,left:bigint,right:bigint>"


def compact_windows(values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """`(first, centre, last)`: all subsequences of at least `least` values that start in first..centre and end in
    centre..last have their minimum at the centre. These are the nodes of the Cartesian tree over at least `least` values;
    equal minima are told apart at random so that the tree stays flat in repetitive texts."""
    return list(zip(*(x.tolist() for x in _all_windows(values, np.zeros(1, np.int64), np.array([len(values)]), least)[1:])))


def _all_windows(values: np.ndarray, low: np.ndarray, size: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """The text, first, centre and last place in it of each compact window of the texts `values[low[i] : low[i] + size[i]]`."""
    begin = np.cumsum(size + 1) - size  # the least number of all stands before, between and behind the texts
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(text)) - (np.cumsum(size) - size)[text]
    order = np.zeros(len(text) + len(size) + 1, np.uint64)
    order[begin[text] + place] = np.maximum(values[low[text] + place] & ~_LOW | T.mix(place.astype(np.uint64)) & _LOW, np.uint64(1))
    # A centre is the minimum of a run of `least` values, and so is each smaller value that ends its window: others need no look.
    peak = np.zeros(len(order), bool)
    if len(order) > least:
        lowest = _of_runs(np.minimum, order, least)
        peak = order == _of_runs(np.maximum, np.concatenate([lowest[:1].repeat(least - 1), lowest, lowest[-1:].repeat(least - 1)]), least)
    peak[0] = peak[-1] = True
    peak[begin - 1] = True
    at = np.flatnonzero(peak)
    value = order[at]
    before, after = np.arange(len(at)) - 1, np.arange(len(at)) + 1
    inner = np.flatnonzero(value > 0)
    todo = inner
    while len(todo := todo[value[before[todo]] > value[todo]]):
        before[todo] = before[before[todo]]
    todo = inner
    while len(todo := todo[value[after[todo]] >= value[todo]]):
        after[todo] = after[after[todo]]
    inner = inner[at[after[inner]] - at[before[inner]] > least]
    text = np.searchsorted(begin, at[inner], side="right") - 1
    return text, *(x - begin[text] for x in (at[before[inner]] + 1, at[inner], at[after[inner]] - 1))


def _of_runs(pick: np.ufunc, values: np.ndarray, length: int) -> np.ndarray:
    """The smallest or largest of each run of `length` neighbours."""
    width = 1
    while width < length:
        step = min(width, length - width)
        values = pick(values[:-step], values[step:])
        width += step
    return values


def _contexts(shingles: np.ndarray, low: np.ndarray, high: np.ndarray, centres: np.ndarray, side: int) -> np.ndarray:
    """The shingles on one side (1: right, -1: left) of each centre as digits, the nearest first: the longer two texts agree
    beside their centres, the more leading digits are equal. Beyond the text (`low` up to `high`) the digit is 0."""
    out = np.zeros(len(centres), np.int64)
    for k in range(1, STEPS + 1):
        at = centres + side * STRIDE * k
        inside = (at >= low) & (at < high)
        out = out << BITS | np.where(inside, (shingles[np.where(inside, at, 0)] >> np.uint64(64 - BITS)).astype(np.int64), 0)
    return out


def _windows(least: int):
    """Windows of each text, each text of a chunk once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches, "text", CHUNK):
            part = part.take(pa.array(np.sort(np.unique(part.column("uid").to_numpy(), return_index=True)[1])))  # copies are one text
            for sub in T.slices([part], "text"):
                w = T.words(sub.column("text"), T.SPACES)
                all_ = T.grams(w.hash, K)
                size = np.maximum(w.counts() - K + 1, 0)
                long = np.flatnonzero(size >= least)
                if not len(long):
                    continue
                own, low, size = sub.column("uid").to_numpy()[long], w.first[long], size[long]
                mixed = T.mix(all_)
                for j, m in enumerate(_MULTIPLY):
                    value = T.mix(all_ * m)
                    text, first, centre, last = _all_windows(value, low, size, least)
                    at = low[text] + centre
                    key = T.mix(value[at]) & ~np.uint64(7) | np.uint64(j)
                    context = _contexts(mixed, low[text], low[text] + size[text], at, 1 if j % 2 else -1)
                    cols = [pa.array(key.view(np.int64)), pa.array(context), _packed(np.column_stack([own[text], first, centre, last]))]
                    yield pa.RecordBatch.from_arrays(cols, ["key", "context", "own"])

    return run


def _stars_of(keys: Sequence[np.ndarray], rows: Sequence[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of rows sorted by keys, text and place: whether a row is the first of its keys (the head), the row of its head,
    whether it is another window of the head's text, and the row of the first other text, or -1."""
    here = np.arange(len(keys[0]))
    new = np.ones(len(here), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    head = np.maximum.accumulate(np.where(new, here, 0))
    other = rows[0] != rows[0][head]
    starts = np.flatnonzero(new)
    second = np.minimum.reduceat(np.where(other, here, len(here)), starts) if len(here) else here
    second = np.repeat(np.where(second < len(here), second, -1), np.diff(np.append(starts, len(here))))
    return new, head, ~new & ~other, second


def _closest(key: np.ndarray, uid: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and their partners by context. Windows of a key form a tree by the leading digits of their contexts; each is linked to the first
    text of the smallest subtree with another text, unless it is that first one: it then goes up to the next larger subtree.
    So texts that agree longest beside the centre meet, however many texts agree for less. Rows are sorted by key and text."""
    _, at, count = np.unique(key, return_inverse=True, return_counts=True)
    row = np.flatnonzero(count[at] > 2)
    row = row[np.lexsort((row, context[row], key[row]))]
    key, uid_, context = key[row], uid[row], context[row]
    free = np.ones(len(row), bool)
    out: list[tuple[np.ndarray, np.ndarray]] = [(row[:0], row[:0])]
    for level in range(STEPS):
        lead = context >> (BITS * level)
        new = np.append(True, (key[1:] != key[:-1]) | (lead[1:] != lead[:-1]))[: len(row)]
        starts = np.flatnonzero(new)
        if len(starts) == len(row):
            continue
        sizes = np.diff(np.append(starts, len(row)))
        head = np.repeat(np.minimum.reduceat(row, starts), sizes)
        other = uid_ != uid[head]
        second = np.repeat(np.minimum.reduceat(np.where(other, row, len(uid)), starts), sizes)
        far, own = free & other, free & ~other & (row != head) & (second < len(uid))
        out += [(row[far], head[far]), (row[own], second[own])]
        free &= ~(far | own)
    return tuple(np.concatenate(x) for x in zip(*out))


def _packed(row: np.ndarray) -> pa.Array:
    """uid and two numbers that hold first and centre, centre and last."""
    fields = [pa.array(row[:, 0]), pa.array(row[:, 1] << 32 | row[:, 2]), pa.array(row[:, 2] << 32 | row[:, 3])]
    return pa.StructArray.from_arrays(fields, fields=list(_WINDOW))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key in blocks of at least `BLOCK` rows that end where a key ends, if a key ends in them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < BLOCK:
            continue
        block = pa.concat_batches(held)
        ends = np.flatnonzero(np.diff(block.column("key").to_numpy()))
        cut = int(ends[-1]) + 1 if len(ends) else block.num_rows
        yield block.slice(0, cut)
        held = [block.slice(cut)]
    if sum(b.num_rows for b in held):
        yield pa.concat_batches(held)


def _stars(batches: Iterator[pa.RecordBatch], large: bool = False) -> Iterator[pa.RecordBatch]:
    """Link all windows of a key of at most `PAIRS` windows that are of different texts. In a larger key link each to the first and to one with
    the closest context, and the first text's other windows to another text; `large` gives the windows of larger keys as well, with `LARGE` for the hash
    and the key for b, so that `_open_pairs` can compare them all. Rows come sorted by key, text and place; repeated rows count once. Held are a
    key's first row and, until another text comes, the other rows of its text, or all rows of a key that has been small."""
    names = ["hash", "a", "a_left", "a_right", "b", "b_left", "b_right"]
    carried_key, carried, waiting = np.zeros(0, np.int64), [np.zeros(0, np.int64)] * 3, 0  # waiting: rows held of a small key
    past = None
    for block in _blocks(batches):
        key, context = (block.column(c).to_numpy() for c in ("key", "context"))
        own = [pc.struct_field(block.column("own"), i).to_numpy() for i in range(3)]
        known = [key, *own]
        again = np.zeros(len(key), bool)
        again[1:] = np.logical_and.reduce([x[1:] == x[:-1] for x in known])
        again[0] = past is not None and past == [x[0] for x in known]
        past = [x[-1] for x in known]
        heads = np.flatnonzero(~again)
        if not len(heads):
            continue
        key, context, own = key[heads], context[heads], [x[heads] for x in own]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        many = np.repeat((sizes > PAIRS) | np.isin(key[starts], carried_key[:1]), sizes)  # what goes on from the last block is large
        out: list[list[np.ndarray]] = []

        def link(i: np.ndarray, j: np.ndarray, k: np.ndarray, rows: Sequence[np.ndarray]) -> None:
            swap = rows[0][i] < rows[0][j]  # the smaller uid first: a pair of texts is one group
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            out.append([k[i], *(x[j] for x in rows), *(x[i] for x in rows)])

        at = np.flatnonzero(np.repeat(sizes > 1, sizes) & ~many)
        for step in range(1, PAIRS):
            i, j = at[: max(0, len(at) - step)], at[step:]
            same = key[i] == key[j]
            if not same.any():
                break
            same &= own[0][i] != own[0][j]
            link(i[same], j[same], key, own)
        if many.any():
            k = np.concatenate([carried_key, key[many]])
            rows = [np.concatenate([x, y[many]]) for x, y in zip(carried, own)]
            new, head, more, second = _stars_of([k], rows)
            far = np.flatnonzero((rows[0] != rows[0][head]) & (np.arange(len(k)) >= len(carried_key)))
            more = np.flatnonzero(more & (second >= 0))
            p, q = _closest(key[many], own[0][many], context[many])
            p, q = p + len(carried_key), q + len(carried_key)
            p, q = p[q != head[p]], q[q != head[p]]
            for i, j in ((far, head[far]), (more, second[more]), (p, q)):
                link(i, j, k, rows)
            if large:
                before = waiting if many[0] and key[0] == carried_key[:1] else 0  # a key that has been small goes on
                cols = [np.concatenate([x[:before], y[many]]) for x, y in zip([carried_key, *carried], [key, *own])]
                none = pa.array(np.zeros(len(cols[0]), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cols[0]), LARGE)), *(pa.array(x) for x in cols[1:]), pa.array(cols[0]), none, none], names)
        if many[-1]:
            first = head[-1]
            hold = [first, second[-1]] if second[-1] >= 0 else [first, *range(first + 1, len(k))]
            carried_key, carried, waiting = k[hold], [x[hold] for x in rows], 0
        else:
            carried_key, carried, waiting = key[starts[-1] :], [x[starts[-1] :] for x in own], sizes[-1]
        for cols in out:
            if len(cols[0]):
                arrays = [pa.array(cols[0] & 7), *(pa.array(x) for x in cols[1:])]
                yield pa.RecordBatch.from_arrays(arrays, names)


def _changes(cols: Sequence[np.ndarray]) -> np.ndarray:
    """Where rows begin that differ from the row before."""
    return np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in cols]))[: len(cols[0])]


def _whole(batches: Iterator[pa.RecordBatch], names: Sequence[str], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by `names` in blocks of at least so many rows that end where a group ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        block = pa.concat_batches(held)
        ends = np.flatnonzero(_changes([block.column(c).to_numpy() for c in names])[1:])
        cut = int(ends[-1]) + 1 if len(ends) else 0
        if cut:
            yield block.slice(0, cut)
        held = [block.slice(cut)]
    if sum(b.num_rows for b in held):
        yield pa.concat_batches(held)


def _join_intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each pair of documents, chains of matching windows along similar offsets that overlap in both texts and come from enough
    hashes: where in either text a near-duplicate passage can lie."""
    for block in _whole(batches, ["a", "b"], BLOCK // 4):
        a, b, hash_, al, ar, bl, br = (block.column(c).to_numpy() for c in ("a", "b", "hash", "a_left", "a_right", "b_left", "b_right"))
        starts = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        pair = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(a))))
        hashes = np.bitwise_or.reduceat(np.int64(1) << hash_, starts)
        use = np.flatnonzero((np.bitwise_count(hashes) >= ENOUGH)[pair])
        if not len(use):
            continue
        a, b, pair, hash_, al, ar, bl, br = (x[use] for x in (a, b, pair, hash_, al, ar, bl, br))
        low, mask = np.int64(32), np.int64(0xFFFFFFFF)
        drift = (al & mask) - (bl & mask)
        by_drift = np.lexsort((drift, pair))
        band = np.empty(len(drift), np.int64)
        band[by_drift] = np.concatenate([[0], np.cumsum((np.diff(drift[by_drift]) > SLANT) | (np.diff(pair[by_drift]) > 0))])
        order = np.lexsort((al >> low, band))
        rows = zip(*(x[order].tolist() for x in (pair, band, hash_, al >> low, ar & mask, bl >> low, br & mask)))
        found: dict[int, list[list[int]]] = {}
        now = last = -1
        seen, place = 0, [0, -1, 0, -1]
        for of, band_, h, a_low, a_high, b_low, b_high in rows:
            if band_ == last and a_low <= place[1] and b_low <= place[3]:
                seen |= 1 << h
                place = [min(place[0], a_low), max(place[1], a_high), min(place[2], b_low), max(place[3], b_high)]
                continue
            if seen.bit_count() >= ENOUGH:
                found.setdefault(now, []).append(place)
            now, last, seen, place = of, band_, 1 << h, [a_low, a_high, b_low, b_high]
        if seen.bit_count() >= ENOUGH:
            found.setdefault(now, []).append(place)
        if found:
            merged = [_merged(x) if len(x) > 1 else x for x in found.values()]
            at = np.repeat(np.searchsorted(pair, list(found)), [len(x) for x in merged])
            cols = np.array([x for places in merged for x in places], np.int64)
            arrays = [pa.array(a[at]), pa.array(b[at]), *(pa.array(cols[:, i]) for i in range(4))]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "a_low", "a_high", "b_low", "b_high"])


def _merged(places: list[list[int]]) -> list[list[int]]:
    """Places `(low in a, high in a, low in b, high in b)` with those put together that share at least half of the smaller one on both
    sides. A text of repeated lines has chains at very many offsets, all over the same ranges."""
    while True:
        out = np.empty((len(places), 4), np.int64)
        n = 0
        for place in sorted(places, key=lambda p: (p[0] - p[1], p)):  # the longest first
            now = np.array(place, np.int64)
            near = np.ones(n, bool)
            for low, high in ((0, 1), (2, 3)):
                shared = np.minimum(out[:n, high], now[high]) - np.maximum(out[:n, low], now[low]) + 1
                near &= 2 * shared >= np.minimum(out[:n, high] - out[:n, low], now[high] - now[low]) + 1
            at = int(near.argmax()) if near.any() else n
            if at < n:
                out[at, ::2], out[at, 1::2] = np.minimum(out[at, ::2], now[::2]), np.maximum(out[at, 1::2], now[1::2])
            else:
                out[n] = now
                n += 1
        if n == len(places):
            return out[:n].tolist()
        places = out[:n].tolist()


def common_passages(x: np.ndarray, y: np.ndarray, least: int, percent: int) -> list[tuple[int, int, int, int, float]]:
    """`(first in x, last in x, first in y, last in y, similarity)` of passages of shingles that are similar enough.

    Neighbouring runs of x with counterparts are joined, whatever lies between them, as long as the joined span and the
    span of its counterparts still reach `percent`; what no such span covers is searched by runs. Each place of x meets one
    place of y, so where shingles of x stand several times in y the places of y are searched as well."""
    xs, order = np.sort(x), np.argsort(y)
    ys = y[order]
    again = ys[1:][ys[1:] == ys[:-1]]
    if not len(again) and not (xs[1:] == xs[:-1]).any():
        found = _once_passages(x, ys, order, least, percent)
        if found is not None:
            return found
    out = _one_way(x, y, least, percent)
    if len(again) and np.isin(again, x).any():
        out += sorted({(a, b, c, d, near) for c, d, a, b, near in _one_way(y, x, least, percent)} - set(out))
    return out


def _once_passages(x: np.ndarray, ys: np.ndarray, order: np.ndarray, least: int, percent: int) -> list[tuple[int, int, int, int, float]] | None:
    """`_one_way` of shingles that stand once in x and once in y: all pairs of a first and a last run are counted at once. None if there are too many runs."""
    if min(len(x), len(ys)) < least:
        return []
    to = np.minimum(np.searchsorted(ys, x), len(ys) - 1)
    at = np.flatnonzero(ys[to] == x)
    if not len(at):
        return []
    place = order[to[at]]
    cut = np.flatnonzero((at[1:] - at[:-1] != 1) | (place[1:] - place[:-1] != 1)) + 1
    if not len(cut):
        return [(int(at[0]), int(at[-1]), int(place[0]), int(place[-1]), 1.0)] if len(at) >= least else []
    if len(cut) >= RUNS:
        return None
    first, last = np.append(0, cut), np.append(cut, len(at)) - 1
    wide = at[last] - at[first][:, None] + 1  # from the start of run i to the end of run j
    both = last - first[:, None] + 1
    able = (wide >= least) & (100 * both >= percent * wide)
    starts = np.flatnonzero(able.any(axis=1))
    if not len(starts):
        return []
    upper = np.arange(len(first)) >= starts[:, None]
    c = np.minimum.accumulate(np.where(upper, place[first], len(ys)), axis=1)
    d = np.maximum.accumulate(np.where(upper, place[last], -1), axis=1)
    other = d - c + 1
    held = both[starts]
    fit = able[starts] & (other >= least) & (100 * held >= percent * (wide[starts] + other - held))
    out, reached = [], -1
    ends = np.where(fit.any(axis=1), fit.shape[1] - 1 - fit[:, ::-1].argmax(axis=1), -1).tolist()
    for i, (start, j) in enumerate(zip(starts.tolist(), ends)):
        if j > reached:
            n = int(held[i, j])
            out.append((int(at[first[start]]), int(at[last[j]]), int(c[i, j]), int(d[i, j]), n / int(wide[start, j] + other[i, j] - n)))
            reached = j
    covered = np.zeros(len(x) + 1, np.int64)
    for a, b, *_ in out:
        covered[a + 1 : b + 2] = 1
    upto = np.cumsum(covered)
    if not (able & (upto[at[last] + 1] - upto[at[first]][:, None] < wide)).any():
        return out
    return out + _once_runs(at, place, upto, least, percent, GAPS)


def _once_runs(at: np.ndarray, place: np.ndarray, upto: np.ndarray, least: int, percent: int, gaps: list[int]) -> list[tuple[int, int, int, int, float]]:
    """`_run_passages` of shingles that stand once in x and once in y. `upto`: how many places of x before each are covered."""
    cut = np.flatnonzero(at[1:] - at[:-1] > gaps[0]) + 1
    ends = [(i, j) for i, j in _between(cut, len(at)) if at[j] - at[i] + 1 >= least and upto[at[j] + 1] - upto[at[i]] < at[j] - at[i] + 1]
    if not ends:
        return []
    ys = np.sort(place)
    y_cut = np.flatnonzero(ys[1:] - ys[:-1] > gaps[0]) + 1
    y_first, y_last = ys[np.append(0, y_cut)], ys[np.append(y_cut, len(ys)) - 1]
    out = []
    for i, j in ends:
        a, b = int(at[i]), int(at[j])
        here = np.sort(place[i : j + 1])
        n = len(here)
        if 100 * n >= percent * (b - a + 1):
            k = int(np.searchsorted(y_first, (here[(n - 1) // 2] + here[n // 2]) / 2, side="right")) - 1
            c, d = int(y_first[k]), int(y_last[k])
            both = int(np.searchsorted(here, d, side="right") - np.searchsorted(here, c))
            all_ = b - a + 1 + d - c + 1 - both
            if d - c + 1 >= least and 100 * both >= percent * all_:
                out.append((a, b, c, d, both / all_))
                continue
        if len(gaps) > 1:
            out += _once_runs(at[i : j + 1], place[i : j + 1], upto, least, percent, gaps[1:])
    return out


def _one_way(x: np.ndarray, y: np.ndarray, least: int, percent: int) -> list[tuple[int, int, int, int, float]]:
    if min(len(x), len(y)) < least:
        return []
    out, at = _joined_passages(x, y, least, percent)
    if not len(at):
        return out
    covered = np.zeros(len(x), bool)
    for a, b, *_ in out:
        covered[a : b + 1] = True
    if covered[at[0] : at[-1] + 1].all():
        return out
    return out + [r for r in _run_passages(x, y, least, percent, GAPS, covered) if not covered[r[0] : r[1] + 1].all()]


def _similarity(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Shingles in both and in either."""
    p, q = np.unique(x), np.unique(y)
    both = len(np.intersect1d(p, q, assume_unique=True))
    return both, len(p) + len(q) - both


def _joined_passages(x: np.ndarray, y: np.ndarray, least: int, percent: int) -> tuple[list[tuple[int, int, int, int, float]], np.ndarray]:
    """Places of x with a counterpart, and the longest similar span from each run of x on that ends after those before it. Of several counterparts the one along
    the usual offset is taken, so that a frequent shingle does not stretch the span of y."""
    order = np.argsort(y, kind="stable")
    ys = y[order]
    low, high = np.searchsorted(ys, x), np.searchsorted(ys, x, side="right")
    at = np.flatnonzero(high > low)
    if not len(at):
        return [], at
    once = at[high[at] - low[at] == 1]
    usual = once if len(once) else at
    shift = int(np.median(order[low[usual]] - usual))
    # Places in y in order of value and place as one number each: the nearest to a wanted place is next to it.
    wide = len(y) + 1
    wanted = np.clip(at + shift, 0, len(y))
    next_ = np.searchsorted(np.searchsorted(ys, ys) * wide + order, low[at] * wide + wanted)
    before, after = order[np.clip(next_ - 1, low[at], high[at] - 1)], order[np.clip(next_, low[at], high[at] - 1)]
    place = np.where(np.abs(before - at - shift) <= np.abs(after - at - shift), before, after)
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(place) != 1)) + 1
    if not len(cut):  # one run of equal shingles
        return ([(int(at[0]), int(at[-1]), int(place[0]), int(place[-1]), 1.0)] if len(at) >= least else []), at
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]]) - 1
    held = last - first + 1
    # A start from which no later end reaches the percentage in x alone can have no similar span.
    before, upto = np.cumsum(held) - held, np.cumsum(held)
    ahead = np.maximum.accumulate((100 * upto - percent * (at[last] + 1))[::-1])[::-1]
    at_last, first_place, last_place, fallen = at[last], place[first], place[last], -ahead
    out: list[tuple[int, int, int, int, float]] = []
    reached = -1
    starts = np.flatnonzero(ahead >= 100 * before - percent * at[first])
    ends = np.searchsorted(fallen, percent * at[first[starts]] - 100 * before[starts], side="right")  # no later end reaches it

    def able() -> Iterator[tuple[int, int]]:
        """Starts and ends between which some span beyond what is reached has the counts, looked for from many starts at once."""
        done, some = 0, 1
        while done < len(starts) and reached < len(first) - 1:
            i, end = starts[done : done + some], ends[done : done + some]
            cols = np.arange(i[0], max(end.max(), i[0] + 1))
            ahead_ = cols >= i[:, None]
            c = np.minimum.accumulate(np.where(ahead_, first_place[cols], len(y)), axis=1)
            other = np.maximum.accumulate(np.where(ahead_, last_place[cols], -1), axis=1) - c + 1
            wide, both = at_last[cols] - at[first[i]][:, None] + 1, upto[cols] - before[i][:, None]
            fit = ahead_ & (cols < end[:, None]) & (wide >= least) & (other >= least) & (100 * both >= percent * (wide + other - both))
            top = np.where(fit.any(axis=1), cols[-1] - fit[:, ::-1].argmax(axis=1), -1)
            for k in np.flatnonzero(top >= 0).tolist():
                if top[k] > reached:
                    yield int(i[k]), int(end[k])
            done, some = done + some, min(4 * some, max(1, (1 << 16) // len(first)))

    for i, end in able():
        low = max(reached + 1 - i, int(np.searchsorted(at_last[i:end], at[first[i]] + least - 1)))  # earlier ends are known or too near
        c = np.minimum.accumulate(first_place[i:end])
        d = np.maximum.accumulate(last_place[i:end])
        wide, other, both = at_last[i + low : end] - at[first[i]] + 1, d[low:] - c[low:] + 1, upto[i + low : end] - before[i]
        fit = np.flatnonzero((other >= least) & (100 * both >= percent * (wide + other - both))) + low
        if not len(fit):
            continue
        a, top = int(at[first[i]]), int(fit[-1]) + 1
        wide, other = at_last[i : i + top] - a + 1, d[:top] - c[:top] + 1
        straight = int(np.searchsorted(-c[:top], -c[0], side="right"))  # ends up to which the span of y starts at one place
        if (fit >= straight).sum() > 1:
            fit = fit[_possible(x[a : a + int(wide[top - 1])], wide[fit], y[c[top - 1] : d[top - 1] + 1], percent)]
        same, all_ = _growing(x[a : a + int(wide[straight - 1])], wide[:straight], y[c[0] : d[straight - 1] + 1], other[:straight])
        near = fit[fit < straight]
        near = near[100 * same[near] >= percent * all_[near]]
        for j in [*fit[fit >= straight][::-1].tolist(), *near[-1:].tolist()]:
            b = int(at[last[i + j]])
            n, m = (int(same[j]), int(all_[j])) if j < straight else _similarity(x[a : b + 1], y[c[j] : d[j] + 1])
            if 100 * n >= percent * m:
                out.append((a, b, int(c[j]), int(d[j]), n / m))
                reached = i + j
                break
    return out, at


def _possible(x: np.ndarray, x_ends: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether so many of the distinct shingles of x[:end] stand anywhere in y that the two can be similar."""
    values, first = np.unique(x, return_index=True)
    held = np.sort(first[np.isin(values, y)])
    return 100 * np.searchsorted(held, x_ends) >= percent * np.searchsorted(np.sort(first), x_ends)


def _growing(x: np.ndarray, x_ends: np.ndarray, y: np.ndarray, y_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`_similarity` of x[:x_ends[j]] and y[:y_ends[j]] for each j; the ends do not fall."""
    n = len(x_ends)
    (p, p_at), (q, q_at) = np.unique(x, return_index=True), np.unique(y, return_index=True)
    p_in, q_in = np.searchsorted(x_ends, p_at, side="right"), np.searchsorted(y_ends, q_at, side="right")
    _, i, j = np.intersect1d(p, q, assume_unique=True, return_indices=True)
    upto = lambda k: np.cumsum(np.bincount(k, minlength=n)[:n])
    both = upto(np.maximum(p_in[i], q_in[j]))
    return both, upto(p_in) + upto(q_in) - both


def _run_passages(
    x: np.ndarray, y: np.ndarray, least: int, percent: int, gaps: list[int], covered: np.ndarray
) -> list[tuple[int, int, int, int, float]]:
    """Shingles with a counterpart, at most `gaps[0]` apart, make a run on either side; a run of x meets the run of y that
    holds the middle counterpart of its shingles. A run that is not similar enough as a whole is tried again with the next gap,
    one that is covered is left out."""
    if not len(x) or not len(y):
        return []
    order = np.argsort(y, kind="stable")
    ys = y[order]
    place = order[np.minimum(np.searchsorted(ys, x), len(y) - 1)]
    in_x = np.flatnonzero(y[place] == x)
    if not len(in_x):
        return []
    runs = lambda p, gap: [(int(p[i]), int(p[j])) for i, j in _between(np.flatnonzero(np.diff(p) > gap) + 1, len(p))]
    upto = np.concatenate([[0], np.cumsum(covered)])
    open_ = [(a, b) for a, b in runs(in_x, gaps[0]) if b - a + 1 >= least and upto[b + 1] - upto[a] < b - a + 1]
    if not open_:
        return []
    xs = np.sort(x)
    y_runs = runs(np.flatnonzero(xs[np.minimum(np.searchsorted(xs, y), len(x) - 1)] == y), gaps[0])
    starts = np.array([r[0] for r in y_runs])
    out = []
    for a, b in open_:
        here = in_x[np.searchsorted(in_x, a) : np.searchsorted(in_x, b, side="right")]
        c, d = y_runs[int(np.searchsorted(starts, np.median(place[here]), side="right")) - 1]
        if d - c + 1 >= least:
            both, all_ = _similarity(x[a : b + 1], y[c : d + 1])
            if 100 * both >= percent * all_:
                out.append((a, b, c, d, both / all_))
                continue
        if len(gaps) > 1:
            inner = _run_passages(x[a : b + 1], y, least, percent, gaps[1:], covered[a : b + 1])
            out += [(a + i, a + j, *rest) for i, j, *rest in inner]
    return out


def _between(cuts: np.ndarray, n: int) -> list[tuple[int, int]]:
    """First and last place of each part of 0..n - 1 that starts at 0 or a cut."""
    return list(zip([0, *cuts.tolist()], [*(cuts - 1).tolist(), n - 1]))


def _hashed(rows: pa.RecordBatch, side: str) -> Iterator[np.ndarray]:
    """The shingles of each row's range in its text; neighbours that are one text are hashed once."""
    uid, low, high = (rows.column(c).to_numpy() for c in (side, f"{side}_low", f"{side}_high"))
    new = np.append(True, uid[1:] != uid[:-1])
    w = T.words(rows.column("text").filter(pa.array(new)), T.SPACES)
    shingles, start = T.grams(w.hash, K), w.first[np.cumsum(new) - 1]
    return (shingles[f + p : f + q + 1] for f, p, q in zip(start, low, high))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places with the shingles of the first text's range in place of the text."""
    names = ["a", "b", "a_low", "a_high", "b_low", "b_high"]
    for sub in T.slices(batches, "text"):
        shingles = pa.array([x.tobytes() for x in _hashed(sub, "a")], pa.binary())
        yield pa.RecordBatch.from_arrays([*(sub.column(c) for c in names), shingles], [*names, "shingles"])


def _verify(least: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "a_first", "a_last", "b", "b_first", "b_last", "similarity"]
        for sub in T.slices(batches, "text"):
            rows = []
            a, b, shift, other = (sub.column(c).to_pylist() for c in ("a", "b", "a_low", "b_low"))
            for i, (x, y) in enumerate(zip(sub.column("shingles"), _hashed(sub, "b"))):
                for p, q, r, s, near in common_passages(np.frombuffer(x.as_buffer(), np.uint64), y, least, percent):
                    rows.append((a[i], p + shift[i], q + shift[i] + K - 1, b[i], r + other[i], s + other[i] + K - 1, near))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names)

    return run


def _spans_of(pairs: DataFrame) -> DataFrame:
    side = lambda s: F.struct(F.col(s).alias("uid"), F.col(f"{s}_first").alias("first"), F.col(f"{s}_last").alias("last"))
    return pairs.select(F.explode(F.array(side("a"), side("b"))).alias("s")).select("s.*")


def _classes(pairs: DataFrame, spans: DataFrame) -> DataFrame:
    """`(uid, first_word, last_word, component)`: spans of a text that overlap are one passage, passages of a pair are one component."""
    along = W.partitionBy("uid").orderBy("first", "last")
    before = F.max("last").over(along.rowsBetween(W.unboundedPreceding, -1))
    apart = F.coalesce((F.col("first") > before - OVERLAP + 1).cast("int"), F.lit(0))
    marked = spans.withColumn("new", apart).withColumn("at", F.sum("new").over(along))
    whole = W.partitionBy("uid", "at")
    merged = written(
        marked.select(
            "uid", "first", "last", "at", F.min("first").over(whole).alias("first_word"), F.max("last").over(whole).alias("last_word")
        ),
        "spans",
    )
    passages = written(
        merged.select("uid", "at", "first_word", "last_word").distinct().withColumn("passage", F.monotonically_increasing_id()),
        "passages",
    )
    known = written(merged.join(passages.select("uid", "at", "passage"), ["uid", "at"]).select("uid", "first", "last", "passage"), "known")
    end = lambda s, n: known.select(
        F.col("uid").alias(s), F.col("first").alias(f"{s}_first"), F.col("last").alias(f"{s}_last"), F.col("passage").alias(n)
    )
    edges = pairs.join(end("b", "q"), ["b", "b_first", "b_last"]).join(end("a", "p"), ["a", "a_first", "a_last"])
    classes = components(edges.select(F.col("p").alias("a"), F.col("q").alias("b")))
    component = F.coalesce("component", "passage").alias("component")  # copies of a text that no other text shares
    return passages.join(classes, passages["passage"] == classes["node"], "left").select("uid", "first_word", "last_word", component)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for sub in T.slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([sub.column("uid"), sub.column("doc_id"), pa.array(T.counts(sub.column("text"), T.SPACES, lower=False))], ["uid", "doc_id", "words"])


def _ends(places: DataFrame) -> DataFrame:
    return places.select(F.col("a").alias("uid")).union(places.select(F.col("b").alias("uid"))).distinct()


def _verified(places: DataFrame, rows: DataFrame, least: int, percent: int) -> DataFrame:
    """Pairs of passages of at least `least` shingles in candidate places."""
    texts = written(rows.join(_ends(places), "uid", "left_semi").dropDuplicates(["uid"]).select("uid", "text"), "texts")
    side = lambda c: texts.select(F.col("uid").alias(c), "text")
    ranges = places.join(side("a"), "a").sortWithinPartitions("a").mapInArrow(
        _ranges, "a long, b long, a_low long, a_high long, b_low long, b_high long, shingles binary"
    )
    both = ranges.join(side("b"), "b").sortWithinPartitions("b")
    schema = "a long, a_first long, a_last long, b long, b_first long, b_last long, similarity double"
    return written(both.mapInArrow(_verify(least, percent), schema), "pairs")


def _fewest(shingles: np.ndarray, text: np.ndarray, low: np.ndarray, centre: np.ndarray, high: np.ndarray, least: int) -> np.ndarray:
    """For each centre the fewest distinct shingles of a run of `least` in low..high - 1 that holds it. `text`: that of each shingle; runs lie in one text."""
    order = np.argsort(shingles, kind="stable")
    again = np.flatnonzero((shingles[order][1:] == shingles[order][:-1]) & (text[order][1:] == text[order][:-1]))
    past, here = order[again], order[again + 1]
    begin = np.maximum(here - least + 1, 0)  # runs from `begin` to `past` hold the shingle twice
    past, begin = past[begin <= past], begin[begin <= past]
    if not len(past):
        return np.full(len(centre), least)
    n = len(shingles)
    twice = np.cumsum(np.bincount(begin, minlength=n + 1) - np.bincount(past + 1, minlength=n + 1))[:n]
    first, last = np.maximum(low, centre - least + 1), np.minimum(centre, high - least)
    out = np.zeros(len(centre), np.int64)
    level = np.frexp(last - first + 1)[1] - 1
    for k in np.unique(level).tolist():
        most, of = _of_runs(np.maximum, twice, 1 << k), np.flatnonzero(level == k)
        out[of] = least - np.maximum(most[first[of]], most[last[of] - (1 << k) + 1])
    return out


def _beside(batches: Iterator[pa.RecordBatch], far: int) -> Iterator[tuple]:
    """Of each slice of texts: the uid of each window, the windows, and of the shingles of all texts in 32 bits (equal digits of others only add candidates) those at
    most `far` from each centre, one window after another, and their numbers; then the whole shingles, the text of each, and the places where each
    window's begin, have the centre and end."""
    for sub in T.slices(batches, "text"):
        w = T.words(sub.column("text"), T.SPACES)
        grams = T.grams(w.hash, K)
        of = pc.list_parent_indices(sub.column("windows")).to_numpy()
        x = sub.column("windows").flatten()
        left, centre, right = (x.field(c).to_numpy() for c in ("left", "centre", "right"))
        low, high = np.maximum(left, centre - far), np.minimum(right, centre + far) + 1
        low, centre, high = (w.first[of] + c for c in (low, centre, high))
        near, sizes = spread(grams.astype(np.uint32), low, high - low)
        text = np.repeat(np.arange(sub.num_rows), w.counts())[: len(grams)]
        yield sub.column("uid").take(pa.array(of)), x, near, sizes, grams, text, low, centre, high


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Values in pieces of so many each."""
    at = np.concatenate([[0], np.cumsum(values.itemsize * sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([np.frombuffer(T.text_bytes(c.cast(pa.large_binary()))[0].tobytes(), kind) for c in chunks])


def _surroundings(least: int, percent: int):
    """A row for each window of a text: its shingles so near the centre that a shortest passage can hold them, and how many of them another text must have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "class", "parts", "more", "open", "left", "centre", "right"]
        for uid, x, near, sizes, *around in _beside(batches, -(-100 * least // percent)):
            need = -(-percent * _fewest(*around, least) // 100)
            cols = [uid, *(x.field(c) for c in names), pa.array(need), _binary(near, sizes)]
            yield pa.RecordBatch.from_arrays(cols, ["uid", *names, "need", "shingles"])

    return run


def _scattered(least: int, percent: int):
    """A row for each window of a text and bucket of its key: the shingles beside the centre whose values are of that bucket, and where they stand there."""
    far = -(-100 * least // percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "class", "left", "centre", "right"]
        for uid, x, near, sizes, _, _, low, centre, _ in _beside(batches, far):
            window = np.repeat(np.arange(len(sizes)), sizes)
            spot = (np.arange(len(near)) + (low - centre + far - np.cumsum(sizes) + sizes)[window]).astype(np.uint16)
            bucket = near % x.field("parts").to_numpy()[window]
            order = np.lexsort((bucket, window))
            near, spot, window, bucket = (c[order] for c in (near, spot, window, bucket))
            starts = np.flatnonzero(_changes([window, bucket]))
            sizes, of = np.diff(np.append(starts, len(near))), pa.array(window[starts])
            cols = [uid.take(of), *(x.field(c).take(of) for c in names), pa.array(bucket[starts]), _binary(near, sizes), _binary(spot, sizes)]
            yield pa.RecordBatch.from_arrays(cols, ["uid", *names, "bucket", "shingles", "spots"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the windows of a key and bucket the places of those shingles that stand in the key's windows more than once."""
    names = ["key", "uid", "class", "left", "centre", "right"]
    for group in groups.in_order(batches, ["key", "bucket"]):
        data, spots = _values(group.column("shingles"), np.uint32), _values(group.column("spots"), np.uint16)
        window = np.repeat(np.arange(group.num_rows), pc.binary_length(group.column("shingles")).to_numpy() // 4)
        values, code, count = np.unique(data, return_inverse=True, return_counts=True)
        held = count[code] > 1
        found = _binary(spots[held], np.bincount(window[held], minlength=group.num_rows))
        yield pa.RecordBatch.from_arrays([*(group.column(c).combine_chunks() for c in names), found], [*names, "spots"])


def _best(value: np.ndarray, may: np.ndarray, least: int) -> np.ndarray:
    """The largest sum of values of a run of at least `least` places over the middle one, from a place to a place that `may` begin and end it; a column for each window."""
    half, n = len(value) // 2, value.shape[1]
    upto = np.zeros((len(value) + 1, n), np.int32)
    for i in range(len(value)):  # along the windows: many at once
        np.add(upto[i], value[i], out=upto[i + 1])
    low = np.where(may[: half + 1], upto[: half + 1], _NEVER)
    for i in range(half):
        np.minimum(low[i], low[i + 1], out=low[i + 1])
    end = np.arange(max(half, least - 1), len(value))
    return (np.where(may[end], upto[end + 1], -_NEVER) - low[np.minimum(half, end - least + 1)]).max(axis=0)


def _edges(left: np.ndarray, centre: np.ndarray, right: np.ndarray, far: int) -> np.ndarray:
    """The first and last place beside a centre, where the window goes on: passages that hold the centre may do so too."""
    out = np.zeros((len(centre), 2 * far + 1), bool)
    out[:, 0], out[:, -1] = centre - left > far, right - centre > far
    return out


def _able(least: int, percent: int):
    """Windows of which a run that holds the centre can be a similar passage by what the key's other windows have: a run of n distinct shingles with s in another's
    needs s >= percent of all in either, so (100 - percent) * s >= percent * (n - s), and begins and ends with one of them."""
    far = -(-100 * least // percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, centre, right = (batch.column(c).to_numpy() for c in ("left", "centre", "right"))
            spots = batch.column("spots").flatten()
            row = np.repeat(pc.list_parent_indices(batch.column("spots")).to_numpy(), pc.binary_length(spots).to_numpy() // 2)
            value = np.full((batch.num_rows, 2 * far + 1), -percent, np.int32)
            value[row, _values(spots, np.uint16)] = 100 - percent
            place = np.arange(-far, far + 1)
            value[(place < (left - centre)[:, None]) | (place > (right - centre)[:, None])] = -_BEYOND
            keep = _best(value.T.copy(), ((value > 0) | _edges(left, centre, right, far)).T, least) >= 0
            yield batch.select(["key", "uid", "class", "left", "centre", "right"]).filter(pa.array(keep))

    return run


def _alike(least: int, percent: int):
    """Pairs of windows of a key in two of its parts that no class connects, that have enough shingles in common and whose centres similar
    passages can hold. `tree`: pairs with a passage beside the centres, so many as connect all that have one, those with the most in common first. Others are given for
    texts that these do not connect, if their windows go on beyond the shingles or have not been tried: as places, put together by texts."""
    far = -(-100 * least // percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "a_low", "a_high", "b_low", "b_high", "tree", "a_from", "a_to", "b_from", "b_to"]
        for block in _whole(batches, ["key", "i", "j"], PART):
            starts = np.flatnonzero(_changes([block.column(c).to_numpy() for c in ("key", "i", "j")]))
            for low, high in _together(starts.tolist(), block.num_rows, PART // 2):
                rows = _connecting(block.slice(low, high - low), least, percent, far)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if x == "tree" else pa.int64()) for x, c in zip(names, zip(*rows))], names)

    return run


def _together(starts: list[int], n: int, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of groups of at most `most` rows together, or of one group. So many small groups need no more calls than a large one."""
    low = before = 0
    for end in [*starts[1:], n]:
        if end - low > most and before > low:
            yield low, before
            low = before
        before = end
    yield low, n


def _connecting(rows: pa.RecordBatch, least: int, percent: int, far: int) -> list[tuple]:
    get = lambda c: rows.column(c).to_numpy()
    uid, left, centre, right, need, part = (get(c) for c in ("uid", "left", "centre", "right", "need", "part"))
    class_, alone = rows.column("class").fill_null(-1).to_numpy(), get("i") == get("j")
    group = np.cumsum(_changes([get(c) for c in ("key", "i", "j")])) - 1
    sizes = pc.binary_length(rows.column("shingles")).to_numpy() // 4
    data = _values(rows.column("shingles"), np.uint32)
    window = np.repeat(np.arange(len(uid)), sizes)
    value = group[window] << 32 | data.astype(np.int64)
    order = np.argsort(value, kind="stable")
    all_ = np.cumsum(_changes([value[order]])) - 1
    own = _changes([all_, window[order]])  # the first of its kind in the window
    code, held = all_[own], window[order][own]
    while len(code):  # shingles of one window, and windows with too few others, have no part in a pair
        use = np.bincount(code)[code] > 1
        use &= (np.bincount(held[use], minlength=len(uid)) >= need)[held]
        if use.all():
            break
        code, held = code[use], held[use]
    if not len(code):
        return []
    at, held = np.unique(held, return_inverse=True)
    known, code = np.unique(code, return_inverse=True)
    group, alone, uid, left, centre, right, need, part, class_ = (x[at] for x in (group, alone, uid, left, centre, right, need, part, class_))
    p, q, count = _common(code, held, need, class_, np.flatnonzero(~_most(group, class_)), percent)
    keep = (uid[p] != uid[q]) & ((part[p] != part[q]) | alone[p])
    if not keep.any():
        return []
    row = np.full(len(sizes), -1)
    row[at] = np.arange(len(at))
    number = np.full(all_[-1] + 1, len(known))  # of the shingles that no other window has
    number[known] = np.arange(len(known))
    spot = (np.arange(len(data)) - (np.cumsum(sizes) - sizes)[window])[order] + (far - np.minimum(get("centre") - get("left"), far))[window[order]]
    inside = row[window[order]] >= 0
    to = row[window[order]][inside], spot[inside]
    shingles, again = np.full((len(at), 2 * far + 1), len(known)), np.zeros((len(at), 2 * far + 1), np.int64)  # outside the window: none
    shingles[to] = number[all_][inside]
    again[to] = np.bincount(np.cumsum(own) - 1)[np.cumsum(own) - 1][inside]
    edges = _edges(left, centre, right, far)
    shingles, again, may = (np.ascontiguousarray(x.T) for x in (shingles, again, edges))
    cost, both = _cost(again, 2 * percent), shingles < len(known)  # with all other windows for one
    look = (shingles, cost, may, _marks(code, held, len(at), len(known) + 1))
    able, most = (_best(np.where(both, 100 - percent, x), both | may, least) for x in (_cost(again, percent), cost))
    keep &= (able >= 0)[p] & (able >= 0)[q] & (most[p] + most[q] >= 0)
    todo = np.flatnonzero(keep)[np.argsort(-count[keep], kind="stable")]
    begin = (np.cumsum(sizes) - sizes)[at]
    beside = lambda i: data[begin[i] : begin[i] + sizes[at[i]]]
    goes_on = edges.any(axis=1)
    # Windows of a class are one node.
    classes, of = np.unique(class_, return_inverse=True)
    node = np.where(class_ < 0, np.arange(len(at)), len(at) + of)
    up = np.arange(len(at) + len(classes))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = int(up[x])
        return x

    out: list[tuple] = []
    tries: dict[tuple[int, int], int] = {}
    left_over: list[int] = []
    step = 1
    while True:  # of each window the pairs with the most in common first; what these connect needs no more
        while not (up[up] == up).all():
            up[:] = up[up]
        todo = todo[up[node[p[todo]]] != up[node[q[todo]]]]
        if not len(todo):
            break
        by = np.argsort(p[todo], kind="stable")
        new = _changes([p[todo][by]])
        now = np.zeros(len(todo), bool)
        now[by] = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0)) < step
        todo, now = todo[~now], todo[now]
        step *= 8
        now = now[_can_be_similar(p[now], q[now], *look, least, percent)]
        for k, i, j in zip(now.tolist(), p[now].tolist(), q[now].tolist()):
            x, y = root(int(node[i])), root(int(node[j]))
            if x == y:
                continue
            if uid[i] > uid[j]:
                i, j = j, i
            texts = int(uid[i]), int(uid[j])
            tries[texts] = tries.get(texts, 0) + 1
            if tries[texts] > TRIES:
                left_over.append(k)
            elif common_passages(beside(i), beside(j), least, percent):
                up[max(x, y)] = min(x, y)
                ends = (int(c) for w in (i, j) for c in (max(left[w], centre[w] - far), min(right[w], centre[w] + far)))
                out.append((*texts, int(left[i]), int(right[i]), int(left[j]), int(right[j]), True, *ends))
            elif goes_on[i] or goes_on[j]:
                left_over.append(k)
    apart: dict[tuple[int, int], set[tuple[int, int, int, int]]] = {}
    for i, j in zip(p[left_over].tolist(), q[left_over].tolist()):
        if up[node[i]] != up[node[j]]:
            if uid[i] > uid[j]:
                i, j = j, i
            apart.setdefault((int(uid[i]), int(uid[j])), set()).add((int(left[i]), int(right[i]), int(left[j]), int(right[j])))
    for texts, places in apart.items():
        out += [(*texts, *place, False, None, None, None, None) for place in _merged(_outer(np.array(list(places))).tolist())]
    return out


def _outer(places: np.ndarray) -> np.ndarray:
    """Places that do not lie within another: windows of a text under one hash lie within each other or apart."""
    places = places[np.lexsort((places[:, 2] - places[:, 3], places[:, 0] - places[:, 1]))]
    out = []
    while len(places):
        low_a, high_a, low_b, high_b = out_ = places[0]
        out.append(out_)
        places = places[(places[:, 0] < low_a) | (places[:, 1] > high_a) | (places[:, 2] < low_b) | (places[:, 3] > high_b)]
    return np.array(out)


def _most(group: np.ndarray, class_: np.ndarray) -> np.ndarray:
    """Whether each row is of the class that most rows of its group are of (-1: of none)."""
    order = np.lexsort((class_, group))
    new = _changes([group[order], class_[order]])
    count = np.where(class_[order][new] < 0, 0, np.diff(np.append(np.flatnonzero(new), len(order))))
    by = np.lexsort((-count, group[order][new]))
    top = np.zeros(len(count), bool)
    top[by[_changes([group[order][new][by]])]] = True
    out = np.empty(len(group), bool)
    out[order] = (top & (count > 0))[np.cumsum(new) - 1]
    return out


def _marks(code: np.ndarray, window: np.ndarray, windows: int, codes: int) -> np.ndarray:
    """A bit for each window and code: whether the window has it."""
    out = np.zeros((windows, -(-codes // 8)), np.uint8)
    order = np.argsort(window, kind="stable")
    code, window = code[order], window[order]
    for low in range(0, windows, 128):
        here = slice(*np.searchsorted(window, [low, low + 128]))
        held = np.zeros((min(128, windows - low), codes), bool)
        held[window[here] - low, code[here]] = True
        out[low : low + 128] = np.packbits(held, axis=1, bitorder="little")
    return out


def _cost(again: np.ndarray, each: int) -> np.ndarray:
    """What shingles take that another window does not have, shared out if they stand in their window more than once (0: outside)."""
    return np.where(again > 0, -(each // np.maximum(again, 1)), -_BEYOND).astype(np.int32)


def _can_be_similar(
    p: np.ndarray, q: np.ndarray, shingles: np.ndarray, cost: np.ndarray, edges: np.ndarray, marks: np.ndarray, least: int, percent: int
) -> np.ndarray:
    """Whether runs of at least `least` shingles that hold the centres of windows p and q can be similar. With n and m distinct shingles and s in both,
    s / (n + m - s) reaches the percentage if (100 + percent) * 2s >= 2 * percent * (n + m): a shingle of either run that the other window has
    adds 100 - percent, another takes 2 * percent, shared out if it stands there more than once. The best runs of both windows must not sum up to less than 0.
    A passage begins and ends with a shingle of both, or goes on beyond the known ones. `shingles`, `cost` (of `_cost`) and `edges`: a column for each window."""
    byte, bit = (shingles >> 3).astype(np.int64), np.left_shift(1, shingles & 7).astype(np.uint8)
    flat, gain = marks.ravel(), np.int32(100 - percent)
    total = np.zeros(len(p), np.int64)
    for at in range(0, len(p), 1 << 9):
        here = slice(at, at + (1 << 9))
        for x, y in ((p[here], q[here]), (q[here], p[here])):
            both = (flat[byte[:, x] + y * marks.shape[1]] & bit[:, x]) > 0
            total[here] += _best(np.where(both, gain, cost[:, x]), both | edges[:, x], least)
    return total >= 0


def _common(
    code: np.ndarray, window: np.ndarray, need: np.ndarray, class_: np.ndarray, open_: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of windows, one of them in `open_`, of no or different classes (-1: none) that have so many shingles in common as two shortest passages must, and how
    many. Sorted by code and window."""
    n = len(need)
    row = np.full(n, -1)
    row[open_] = np.arange(len(open_))
    use = (np.bincount(code, weights=row[window] >= 0) > 0)[code]
    code, window = np.cumsum(_changes([code[use]])) - 1, window[use]
    often = np.bincount(code)[code] > OFTEN if len(code) else np.zeros(0, bool)
    count = np.zeros((len(open_), n), np.float32)
    which = np.cumsum(_changes([code[often]])) - 1
    for low in range(0, int(which.max()) + 1 if len(which) else 0, 1024):
        here = (which >= low) & (which < low + 1024)
        held = np.zeros((n, 1024), np.float32)
        held[window[often][here], which[here] - low] = 1
        count += held[open_] @ held.T
    code, window = code[~often], window[~often]
    found = [np.zeros(0, np.int64)]
    for step in range(1, OFTEN):
        same = code[: max(0, len(code) - step)] == code[step:]
        if not same.any():
            break
        p, q = window[: len(same)][same], window[step:][same]
        for i, j in ((row[p], q), (row[q], p)):
            found.append((i * n + j)[i >= 0])
    count += np.bincount(np.concatenate(found), minlength=count.size).reshape(count.shape)
    fewest = (need - 1) * 100 // percent + 1  # shingles of a passage
    p, q = np.nonzero(count >= np.maximum(need[open_][:, None], need))
    keep = (100 + percent) * count[p, q] >= percent * (fewest[open_][p] + fewest[q])
    p, q = p[keep], q[keep]
    shared, p = count[p, q], open_[p]
    once = ((row[q] < 0) | (p < q)) & ((class_[p] != class_[q]) | (class_[p] < 0))
    return p[once], q[once], shared[once]


def _merged_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["a", "b", "a_low", "a_high", "b_low", "b_high"]
    for group in groups.in_order(batches, ["a", "b"]):
        found = _merged(list(set(zip(*(group.column(c).to_pylist() for c in names[2:])))))
        ends = [[group.column(c)[0].as_py()] * len(found) for c in names[:2]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*ends, *zip(*found))], names)


def _in_class(rows: DataFrame, passages: DataFrame, uid: str, at: str, name: str) -> DataFrame:
    """The class of the passage that holds the shingle at place `at` of text `uid`; null without one."""
    own = passages.select(F.col("uid").alias("_uid"), "first_word", "last_word", F.col("component").alias(name))
    inside = (F.col(uid) == F.col("_uid")) & (F.col("first_word") <= F.col(at)) & (F.col("last_word") >= F.col(at) + K - 1)
    return rows.join(own, inside, "left").drop("_uid", "first_word", "last_word")


def _open_pairs(windows: DataFrame, rows: DataFrame, pairs: DataFrame, least: int, percent: int) -> DataFrame:
    """`pairs` and those of windows of large keys whose centres `pairs` do not put into one class of passages: compared are the shingles beside the centre.

    Of a key with more than `PART` windows those go first that have no run of a passage's length around the centre that other windows of the key have, too. Then
    the windows of the key's largest class are dealt to parts of `PART`, and so are the others; each part of others is compared with all parts. Texts travel
    once, with the list of their windows. Verified are pairs that connect all which have a passage there, and places where there may be a longer one."""
    passages = _classes(pairs, _spans_of(pairs).distinct())
    names = ["key", "uid", "class", "left", "centre", "right"]
    classed = _in_class(windows, passages, "uid", "centre", "class").groupBy("key", "uid", "left", "centre", "right").agg(F.min("class").alias("class"))
    classed = written(classed.select(names), "classed")

    def sized(held: DataFrame) -> DataFrame:
        """Windows of keys of which not all are in one class, with the number of the key's windows, its largest class, and how many are not in that."""
        most = F.max(F.when(F.col("class").isNotNull(), F.struct("n", "class")))
        of_class = held.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"))
        of_key = of_class.groupBy("key").agg(F.sum("n").alias("size"), most.alias("most")).select(
            "key", "size", F.col("most.class").alias("largest"), (F.col("size") - F.coalesce("most.n", F.lit(0))).alias("others")
        )
        return held.join(of_key.where("others > 0"), "key")

    def beside(held: DataFrame, run, schema: str) -> DataFrame:
        lists = written(held.groupBy("uid").agg(F.collect_list(F.struct(*(c for c in held.columns if c != "uid"))).alias("windows")), "lists")
        texts = rows.join(lists.select("uid"), "uid", "left_semi").dropDuplicates(["uid"]).select("uid", "text")
        return lists.join(texts, "uid").mapInArrow(run(least, percent), schema)

    all_ = sized(classed)
    large = all_.where(F.col("size") > PART).select(*names, F.ceil(F.col("size") / BUCKET).alias("parts"))
    own = "key long, class long, left long, centre long, right long"
    scattered = beside(large, _scattered, f"uid long, {own}, bucket long, shingles binary, spots binary")
    shared = scattered.repartition("key", "bucket").sortWithinPartitions("key", "bucket").mapInArrow(
        _shared, "key long, uid long, class long, left long, centre long, right long, spots binary"
    )
    shared = shared.groupBy(names).agg(F.collect_list("spots").alias("spots")).mapInArrow(
        _able(least, percent), "key long, uid long, class long, left long, centre long, right long"
    )
    kept = all_.where(F.col("size") <= PART).union(sized(written(shared, "shared")).select(all_.columns))
    small = F.col("size") <= PART
    dealt = kept.withColumns({
        "open": small | F.col("class").isNull() | (F.col("class") != F.col("largest")),
        "parts": F.when(small, 1).otherwise(F.ceil(F.col("others") / PART)),
        "more": F.when(small, 0).otherwise(F.ceil((F.col("size") - F.col("others")) / PART)),
    })
    near = beside(
        dealt.select(*names, "parts", "more", "open"), _surroundings,
        "uid long, key long, class long, parts long, more long, open boolean, left long, centre long, right long, need long, shingles binary",
    )
    at = F.xxhash64("uid", "left")
    part = F.when(F.col("open"), F.pmod(at, "parts")).otherwise(F.col("parts") + F.pmod(at, F.greatest("more", F.lit(1))))
    others = F.when(F.col("open"), F.col("parts") + F.col("more")).otherwise(F.col("parts"))
    dealt = near.withColumn("part", part).select("*", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias("other"))
    dealt = dealt.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")).drop("parts", "more", "open", "other")
    schema = "a long, b long, a_low long, a_high long, b_low long, b_high long"
    alike = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        _alike(least, percent), f"{schema}, tree boolean, a_from long, a_to long, b_from long, b_to long"
    )
    alike = written(alike, "alike")
    whole = alike.select("a", "b", "a_low", "a_high", "b_low", "b_high").repartition("a", "b").sortWithinPartitions("a", "b")
    places = whole.mapInArrow(_merged_places, schema).union(alike.where("tree").select("a", "b", "a_from", "a_to", "b_from", "b_to")).distinct()
    places = written(places, "places")
    few = rows.join(written(_ends(places), "ends"), "uid", "left_semi")  # small enough to be sent to all, mostly
    return pairs.union(_verified(places, few, least, percent)).distinct()


def passage_pairs(docs: DataFrame, least: int = LEAST, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Verified pairs of passages `(a, a_first, a_last, b, b_first, b_last, similarity)` of different texts, and all documents `(uid, doc_id, words)`.

    Places are words from 0, both ends included; `a`, `b` and `uid` are hashes of texts. Of windows of a large key the pairs that connect them."""
    shingles = least - K + 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select(
        F.xxhash64("text").alias("uid"), "doc_id", "text"
    )
    names = written(rows.mapInArrow(_counted, "uid long, doc_id long, words long").distinct(), "names")
    windows = rows.select("uid", "text").mapInArrow(_windows(shingles), f"key long, context long, own {WINDOW}")
    links = written(
        windows.repartition("key")
        .sortWithinPartitions("key", "own.uid", "own.right", "own.left")
        .mapInArrow(partial(_stars, large=True), "hash long, a long, a_left long, a_right long, b long, b_left long, b_right long"),
        "links",
    )
    places = written(
        links.where(F.col("hash") != LARGE).repartition("a", "b")
        .sortWithinPartitions("a", "b")
        .mapInArrow(_join_intervals, "a long, b long, a_low long, a_high long, b_low long, b_high long"),
        "places",
    )
    pairs = _verified(places, rows, shingles, percent)
    low = F.lit(0xFFFFFFFF)
    large = links.where(F.col("hash") == LARGE).select(
        F.col("b").alias("key"), F.col("a").alias("uid"), F.shiftright("a_left", 32).alias("left"),
        F.col("a_left").bitwiseAND(low).alias("centre"), F.col("a_right").bitwiseAND(low).alias("right"),
    )
    if large.isEmpty():
        return pairs, names
    return _open_pairs(large, rows, pairs, shingles, percent), names


def _copied_texts(names: DataFrame, least: int) -> DataFrame:
    """`(uid, first, last)`: the whole text, for texts of at least `least` words that several documents have."""
    counted = names.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.max("words").alias("words")).where(f"n > 1 and words >= {least}")
    return counted.select("uid", F.lit(0).cast("long").alias("first"), (F.col("words") - 1).alias("last"))


def repeated_passages(docs: DataFrame, least: int = LEAST, percent: int = 75) -> DataFrame:
    """Passages of at least `least` words that stand, with a similarity of `percent` in 5-word shingles, in other
    documents too: `doc_id, first_word, last_word, class_id, class_docs`, a row per document and passage.

    Words are lower-cased (A-Z) runs without white space; places are words from 0, both included. Passages connected by verified pairs form a class,
    named by its smallest doc_id and given with its number of documents. Null, empty and short texts have no
    passages; rows equal in doc_id and text are one document; a null doc_id comes last in a class.

    1. Compact windows of each whole text under `HASHES` hashes of its shingles; documents with equal texts are one text. All windows of a
       key of at most `PAIRS` are linked. In a larger key each is linked to the first and to the first of those whose shingles beside the centre
       agree longest with its own; once these are verified, those that no class connects are compared by their shingles.
    2. Interval join: per pair of documents, chains of matching windows from `ENOUGH` hashes. Candidates are verified on
       the shingles of both ranges; each text is hashed once a side.
    3. Spans of a document that overlap become one passage; classes are connected components."""
    pairs, names = passage_pairs(docs, least, percent)
    whole = _classes(pairs, _spans_of(pairs).union(_copied_texts(names, least)).distinct())
    placed = written(whole.join(names, "uid").select("doc_id", "first_word", "last_word", "component"), "placed")
    named = placed.select("component", "doc_id").distinct().groupBy("component").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_docs")
    )
    return placed.join(written(named, "classes"), "component").drop("component")
