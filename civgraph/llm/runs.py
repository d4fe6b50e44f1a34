"""Periodic runs of words by grammar compression.

The word ids of every text become a Re-Pair grammar.  It is built in rounds:
a round replaces all adjacent pairs of symbols that occur more than once and
outrank the pairs that overlap them, by frequency.  A pair that occurs once
stays; the symbols that are left over in the end are the start rule.

A run lies across the boundary within some nonterminal (the lowest one of the
derivation that spans it) or across a boundary within the start rule.  So
each nonterminal is searched once, across its one boundary and no further than
its expansion; what is found there holds at all its derivation positions,
where parts of one run are merged into the maximal interval.  Long periodic
stretches shrink to a number of symbols that grows with their logarithm.

Common extensions are looked up in names of the 2^j-word sequences that occur
more than once in a text, which are exact (no hashes).  A period q across a
boundary shows there as an equal sequence of q/2 words or more at distance q,
which gives the few periods to try.

Texts are independent, so no row is shuffled; a task holds a few texts, and a
text takes memory in proportion to its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civgraph.llm.common import WORD

#: Fixed value: the least length of a run.
LEAST = 12
#: Bytes of text that a task compresses at a time (a longer text goes alone).
SLICE_BYTES = 1 << 21
#: Candidates of one lookup.
PIECE = 1 << 20


def names_of(ids: np.ndarray) -> list[np.ndarray]:
    """For j = 0, 1, ...: per position the name of the 2^j-word sequence that
    starts there, equal names for equal sequences, 0 where it occurs once."""
    n = len(ids)
    repeated = np.bincount(ids, minlength=1)[ids] > 1 if n else np.zeros(0, bool)
    names = [np.append(np.where(repeated, ids + 1, 0), 0)]
    step = 1
    while step < n:
        last = names[-1]
        at = np.flatnonzero((last[:n - step] > 0) & (last[step:n] > 0))
        if not len(at):
            break
        key = last[at] * (last.max() + 1) + last[at + step]
        order = np.argsort(key)
        key = key[order]
        first = np.append(True, key[1:] != key[:-1])
        many = np.diff(np.append(np.flatnonzero(first), len(key))) > 1
        if not many.any():
            break
        group = np.cumsum(first) - 1
        name = np.zeros(n + 1, np.int64)
        name[at[order]] = np.where(many, np.cumsum(many), 0)[group]
        names.append(name)
        step *= 2
    return names


class Grammar:
    """Nonterminals of at least ``LEAST`` words: ``place`` of the first
    derivation, words of the ``left`` part and of the whole (``size``); the
    derivation positions ``spots`` of nonterminal i are those from
    ``spot_from[i]`` to ``spot_from[i + 1]``.  ``inner`` marks the word
    boundaries that lie within a symbol of the start rule."""

    def __init__(self, ids: np.ndarray, pairs: np.ndarray | None):
        n = len(ids)
        self.inner = np.zeros(n + 1, bool)
        place, left, size, spots, counts = [], [], [], [], []
        live = np.zeros(n, bool)
        if pairs is not None:
            live = pairs[:n] > 0
            live[1:] |= pairs[:n - 1] > 0
        pos = np.flatnonzero(live)
        sym, length = ids[pos], np.ones(len(pos), np.int64)
        link = np.append(pairs[pos[:-1]] > 0, False) if len(pos) else np.zeros(0, bool)
        symbols = int(ids.max()) + 1 if n else 0
        while True:
            at = np.flatnonzero(link)
            if not len(at):
                break
            key = sym[at] * symbols + sym[at + 1]
            kinds, kind, count = np.unique(key, return_inverse=True, return_counts=True)
            # by frequency (its power of two), then by a fixed mixing of the kind
            rank = (np.frexp(count.astype(float))[1].astype(np.int64) << 32) + (
                np.arange(len(kinds)) * 0x9E3779B1 & 0xFFFFFFFF)
            link[at[count[kind] < 2]] = False
            prior = np.full(len(sym) + 2, -1, np.int64)  # one before, one after
            prior[at + 1] = np.where(count[kind] > 1, rank[kind], -1)
            here, before, after = prior[1:-1], prior[:-2], prior[2:]
            same_before, same_after = link & (here == before), link & (here == after)
            index = np.arange(len(sym))
            start = np.maximum.accumulate(np.where(same_before, 0, index))
            take = link & ((index - start) % 2 == 0) & (same_before | (here > before)) & (same_after | (here > after))
            one = np.flatnonzero(take)
            if not len(one):
                break
            made = key[np.searchsorted(at, one)]
            rules, which, uses = np.unique(made, return_inverse=True, return_counts=True)
            self.inner[pos[one + 1]] = True
            whole = length[one] + length[one + 1]
            if whole.max() >= LEAST:
                order = np.lexsort((pos[one], which))
                firsts = one[order[np.cumsum(uses) - uses]]
                total = length[firsts] + length[firsts + 1]
                long = total >= LEAST
                place.append(pos[firsts[long]])
                left.append(length[firsts[long]])
                size.append(total[long])
                spots.append(pos[one[order]][long[which[order]]])
                counts.append(uses[long])
            sym[one], length[one], link[one] = symbols + which, whole, link[one + 1]
            symbols += len(rules)
            keep = np.ones(len(sym), bool)
            keep[one + 1] = False
            sym, length, pos, link = sym[keep], length[keep], pos[keep], link[keep]
            near = link.copy()
            near[1:] |= link[:-1]
            sym, length, pos, link = sym[near], length[near], pos[near], link[near]

        def joined(parts):
            return np.concatenate(parts) if parts else np.zeros(0, np.int64)

        self.place, self.left, self.size, self.spots = map(joined, (place, left, size, spots))
        self.spot_from = np.append(0, np.cumsum(joined(counts)))


def _ahead(names, x, y):
    """Length of the longest common sequence that starts at x and at y (> x)."""
    out = np.zeros(len(x), np.int64)
    for j in range(len(names) - 1, -1, -1):
        one = names[j][x + out]
        out += ((one > 0) & (one == names[j][y + out])).astype(np.int64) << j
    return out


def _behind(names, x, y):
    """Length of the longest common sequence that ends before x and before y."""
    out = np.zeros(len(x), np.int64)
    for j in range(len(names) - 1, -1, -1):
        at = x - out - (1 << j)
        one = np.where(at >= 0, names[j][np.maximum(at, 0)], 0)
        out += ((one > 0) & (one == names[j][np.maximum(y - out - (1 << j), 0)])).astype(np.int64) << j
    return out


def _expand(low, high):
    """(i, value) for every value of the ranges low[i] <= value < high[i], in pieces."""
    count = np.maximum(high - low, 0)
    ends = np.cumsum(count)
    at = 0
    while at < len(count):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PIECE, "right")))
        part = count[at:to]
        i = np.repeat(np.arange(at, to), part)
        yield i, low[i] + np.arange(len(i)) - np.repeat(np.cumsum(part) - part, part)
        at = to


def _candidates(names, n, m, low, high) -> Iterator[tuple]:
    """(boundary, q, to the right?): periods that may cross the boundaries m."""
    if len(names) < 2:
        return
    pair = np.pad(names[1], (20, 20))
    at = m + 20
    # short periods: three equal words at distance q, after or before the boundary
    some = np.flatnonzero(((pair[at] > 0) & (pair[at + 1] > 0)) | ((pair[at - 3] > 0) & (pair[at - 2] > 0)))
    for q in range(1, 16):
        for d in (q, -q):
            here = at[some]
            there = here + d

            def equal(k):
                return (pair[here + k] > 0) & (pair[here + k] == pair[there + k])

            hit = some[(equal(0) & equal(1)) | (equal(-3) & equal(-2))]
            yield hit, np.full(len(hit), q), d > 0
    # 2^k <= q < 2^(k+1): 2^(k-1) equal words at distance q
    for k in range(4, len(names) + 1):
        name, step = names[k - 1], 1 << (k - 1)
        spots = np.flatnonzero(name)
        keys = np.sort(name[spots] * (n + 1) + spots)
        wide = np.flatnonzero(high - low >= 4 * step)
        for x in (m[wide], m[wide] - step):
            inside = (x >= low[wide]) & (name[np.maximum(x, 0)] > 0)
            which, x1 = wide[inside], x[inside]
            base = name[x1] * (n + 1)
            for right in (True, False):
                a, b = (x1 + 2 * step, x1 + 4 * step) if right else (x1 - 4 * step + 1, x1 - 2 * step + 1)
                a, b = np.clip(a, 0, n), np.clip(b, 0, n)
                for i, at_key in _expand(np.searchsorted(keys, base + a), np.searchsorted(keys, base + b)):
                    yield which[i], np.abs(keys[at_key] - base[i] - x1[i]), right


def find_runs(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of all runs, by start, then period.

    ``ids`` are the word ids of several texts one after another, no id in two
    texts; ``starts`` are the places where texts begin, and the end.
    """
    n = len(ids)
    names = names_of(ids)
    grammar = Grammar(ids, names[1] if len(names) > 1 else None)
    top = ~grammar.inner
    top[starts] = False
    cut = np.flatnonzero(top)
    text = np.searchsorted(starts, cut, "right")
    m = np.concatenate([grammar.place + grammar.left, cut])
    low = np.concatenate([grammar.place, starts[text - 1] if len(cut) else cut])
    high = np.concatenate([grammar.place + grammar.size, starts[text] if len(cut) else cut])
    owner = np.concatenate([np.arange(len(grammar.place)), np.full(len(cut), -1)])
    found = [np.zeros((0, 4), np.int64)]
    for i, q, right in _candidates(names, n, m, low, high):
        inside = (m[i] + q <= high[i]) if right else (m[i] - q >= low[i])
        i, q = i[inside], q[inside]
        if not len(i):
            continue
        x = m[i] if right else m[i] - q
        after = np.minimum(_ahead(names, x, x + q), high[i] - x - q)
        before = np.minimum(_behind(names, x, x + q), x - low[i])
        good = after + before >= np.maximum(q, LEAST - q)
        found.append(np.stack([owner[i], q, x - before, x + q + after], axis=1)[good])
    runs = np.unique(np.concatenate(found), axis=0)
    own, q, start, stop = runs.T
    # to all derivation positions of the nonterminal
    of = np.flatnonzero(own >= 0)
    rules = own[of]
    parts = [np.stack([q, start, stop], axis=1)[own < 0]]
    for i, spot in _expand(grammar.spot_from[rules], grammar.spot_from[rules + 1]):
        shift = grammar.spots[spot] - grammar.place[rules[i]]
        parts.append(np.stack([q[of[i]], start[of[i]] + shift, stop[of[i]] + shift], axis=1))
    q, start, stop = np.unique(np.concatenate(parts), axis=0).T  # by period, then start
    if not len(q):
        return start, stop, q
    # parts of one period that share a period or more are one interval
    base = np.searchsorted(q, q, "left") * (n + 1)  # grows with the period
    reach = np.maximum.accumulate(base + stop)
    fresh = np.append(True, (q[1:] != q[:-1]) | (base[1:] + start[1:] > reach[:-1] - q[1:]))
    heads = np.flatnonzero(fresh)
    stop = np.maximum.reduceat(stop, heads)
    q, start = q[heads], start[heads]
    # a multiple of the smallest period has the same interval
    order = np.lexsort((q, stop, start))
    q, start, stop = q[order], start[order], stop[order]
    small = np.append(True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1]))
    q, start, stop = q[small], start[small], stop[small]
    order = np.lexsort((q, start))
    return start[order], stop[order], q[order]


def word_ids(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of every text, their ids (no id in two texts) and the places
    where the texts begin, and the end."""
    words, ids, starts, used = [], [np.zeros(0, np.int64)], [0], 0
    for text in texts:
        split = (text or "").encode().split()  # bytes: at ASCII white space only
        known = {w: i for i, w in enumerate(dict.fromkeys(split), used)}
        used += len(known)
        words.append(split)
        ids.append(np.fromiter(map(known.__getitem__, split), np.int64, len(split)))
        starts.append(starts[-1] + len(split))
    return words, np.concatenate(ids), np.array(starts)


def _texts_with_runs(texts: list[str | None]) -> list[dict]:
    words, ids, starts = word_ids(texts)
    start, stop, period = find_runs(ids, starts)
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, stop, -1)
    dropped = np.cumsum(cover) > 0
    bounds = np.searchsorted(start, starts)
    out = []
    for i, split in enumerate(words):
        a, b, at = bounds[i], bounds[i + 1], starts[i]
        kept = split
        if a < b:
            kept = [w for w, gone in zip(split, dropped[at:at + len(split)].tolist()) if not gone]
        out.append({"runs": [{"start": s, "length": e - s - at, "period": p} for s, e, p in zip(
            (start[a:b] - at).tolist(), stop[a:b].tolist(), period[a:b].tolist())],
            "collapsed": b" ".join(kept).decode()})
    return out


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most SLICE_BYTES, or of one text."""
    at = size = 0
    for i, text in enumerate(texts):
        more = len(text or "")
        if i > at and size + more > SLICE_BYTES:
            yield at, i
            at, size = i, 0
        size += more
    if at < len(texts):
        yield at, len(texts)


RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def with_runs(docs: DataFrame) -> DataFrame:
    """doc_id, ``runs`` (by start, then period) and ``collapsed``, the text
    without the words that repeat a run's first period, of every row.

    A run is a stretch of words with smallest period q and LEAST and 2q words
    or more that no neighbouring word extends.  Null, empty and blank texts have no
    runs and an empty ``collapsed``.  Rows are independent: null and repeated
    ids and repeated rows stay, other columns are not read, and no rows give
    no rows.  Texts are searched whole.
    """
    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                rows = _texts_with_runs(texts[a:b])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array([r["runs"] for r in rows], RUN),
                    pa.array([r["collapsed"] for r in rows], pa.string())], ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def looped(doc_id: Column, text: Column) -> Column:
    """The text with a periodic tail, where 10 divides the crc32 of the id."""
    h = F.crc32(doc_id.cast("string"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def tail(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        again = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(w, a + i % p))
        return F.when(n > 0, F.concat_ws(" ", F.slice(w, F.lit(1), a), again)).otherwise(text)

    # the words are split once: an array of one element binds them
    changed = F.get(F.transform(F.array(words), tail), F.lit(0))
    return F.when((h % 10 == 0) & text.isNotNull(), changed).otherwise(text)


def run_digest(docs: DataFrame) -> DataFrame:
    """Number, longest run and digests of the runs of every text, some of
    which ``looped`` has changed."""
    found = with_runs(docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text")))
    order = F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    first = F.get(order, F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), first["start"].alias("start"), (-first["l"]).alias("length"),
        first["period"].alias("period"), F.expr("CAST(NULL AS long)").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).withColumn("exponent_milli", F.expr("(1000 * length) div period"))
