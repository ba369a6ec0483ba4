"""Documents that hold passages of a benchmark, found by the q-gram lemma.

The windows of a benchmark item are all its parts of ``run`` and of ``window`` characters, at every
offset; a document is contaminated if some window occurs in it with at most ``k = rate * length``
edits, letter case and punctuation aside. So every verbatim part of an item of ``run`` folded
characters (64, about 11 words) is found wherever it is cut, and every part of ``window`` characters
with up to 6 edits in 100. By the q-gram lemma such a place shares at least ``m + 1 - q (k + 1)`` of
the window's q-grams, and its alignment stays within ``k + 1`` neighbouring diagonals, so it lies
whole in one of the bands of ``2 (k + 1)`` diagonals that overlap by half. Shared q-grams are counted
per item and band; windows that reach the bound are verified by an alignment confined to the band.
The count is a filter without losses: what the alignment would accept is never dropped before it.

The corpus is read once and nothing is shuffled: each document is compared with an index of the
q-grams. The index travels to the executors, so it is cut into blocks of at most ``block_chars``
characters of benchmark text, and the documents pass block after block in the same job.

Defined results: null, empty or word-free texts are clean; null and word-free items match nothing;
items shorter than q are looked for as whole words, without edits; repeated rows are judged alike;
without items all documents are clean. Columns of the documents are kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from .common import folded, text_function, whole

Q = 10
WINDOW = 100
RUN = 64  # every copied run of so many characters is found
RATE = 0.06
BLOCK_CHARS = 4_000_000
AT_ONCE = 4_096  # windows aligned together; bounds memory only
MULTIPLIER = 0x9E3779B97F4A7C15
TABLE_BITS = 22

MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
                            ("edits", pa.int32())]))
MATCH_DDL = "array<struct<item_id:long,start:long,stop:long,edits:int>>"


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit polynomial code of every q characters in a row, put together by doubling."""
    if len(chars) < q:
        return np.zeros(0, np.uint64)
    codes, length = {1: chars}, 1
    while length * 2 <= q:
        power = np.uint64(pow(MULTIPLIER, length, 1 << 64))
        half = codes[length]
        codes[length * 2] = half[:-length] * power + half[length:]
        length *= 2
    out, have = codes[length], length
    while have < q:
        length = max(n for n in codes if n <= q - have)
        power = np.uint64(pow(MULTIPLIER, length, 1 << 64))
        tail = codes[length][have:]
        out, have = out[:len(tail)] * power + tail, have + length
    out = out ^ (out >> np.uint64(29))
    return out * np.uint64(MULTIPLIER)


def aligned(window: np.ndarray, text: np.ndarray, first: int, width: int, k: int) -> tuple[int, int, int] | None:
    """The cheapest place of the whole window in the text within a band of diagonals.

    Diagonal ``d`` pairs ``window[i]`` with ``text[i + d]``; the band holds ``first`` to
    ``first + width - 1``. Returns start, stop and edits, or None if more than ``k`` are needed.
    """
    return aligned_windows(window, text, first, width, np.zeros(1, np.int64), len(window), k)[0]


def aligned_windows(item: np.ndarray, text: np.ndarray, first: int, width: int, starts: np.ndarray, size: int,
                    k: int) -> list[tuple[int, int, int] | None]:
    """``aligned`` for the windows of an item that begin at ``starts``, all in one band of the item's diagonals."""
    far = 1 << 20
    lanes = np.arange(width)
    low = int(starts.min())
    rows = np.arange(low, int(starts.max()) + size)
    at = rows[:, None] + first + lanes  # lane j stands before text position first + j + row
    inside = (at >= 0) & (at < len(text))
    same = inside & (np.append(text, text.dtype.type(0))[np.where(inside, at, len(text))] == item[rows][:, None])
    # A copy without edits needs no table.
    runs = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(same, axis=0)])
    exact = runs[starts - low + size] - runs[starts - low] == size
    found: list[tuple[int, int, int] | None] = [None] * len(starts)
    for n in np.flatnonzero(exact.any(axis=1)).tolist():
        begin = int(starts[n]) + first + int(np.argmax(exact[n]))
        found[n] = (begin, begin + size, 0)
    live = np.flatnonzero(~exact.any(axis=1))
    begin = (starts[live] + first)[:, None] + lanes
    cost = np.where((begin >= 0) & (begin <= len(text)), 0, far)
    edge = np.full((len(live), 1), far)
    for i in range(size):
        if not len(live):
            return found
        row = starts[live] - low + i
        # In lane j: pair the two characters, or skip the item's (it comes from lane j + 1).
        pair = np.where(inside[row], cost + ~same[row], far)
        skip = np.concatenate([cost[:, 1:], edge[:len(live)]], axis=1) + 1
        take = skip < pair
        step = np.where(take, skip, pair) - lanes
        origin = np.where(take, np.concatenate([begin[:, 1:], edge[:len(live)]], axis=1), begin)
        # Skipping text moves right within the row: the least of step[j'] + (j - j').
        best = np.minimum.accumulate(step, axis=1)
        source = np.maximum.accumulate(np.where(step == best, lanes, 0), axis=1)
        after = at[row] + 1
        cost = np.where((after >= 0) & (after <= len(text)), best + lanes, far)
        begin = np.take_along_axis(origin, source, axis=1)
        hope = cost.min(axis=1) <= k
        if not hope.all():
            live, cost, begin = live[hope], cost[hope], begin[hope]
    for n, c, b in zip(live.tolist(), cost, begin):
        j = int(np.argmin(c))
        found[n] = (int(b[j]), first + j + int(starts[n]) + size, int(c[j]))
    return found


def cut(length: int, q: int, window: int, rate: float, run: int = RUN) -> list[tuple[int, int, int]]:
    """Windows of an item, of the lengths ``run`` and ``window``, one at every offset.

    So any part of the item of such a length is a window. An item that is shorter is one window. The
    edits are few enough that one shared q-gram is asked for.
    """
    out = []
    for size in sorted({min(length, run), min(length, window)}):
        k = min(int(rate * size), (size + 1) // q - 1)
        out += [(s, size, k) for s in range(length - size + 1)]
    return out


def by_length(windows: list[tuple[int, int, int]]) -> list[tuple[np.ndarray, int, int]]:
    """The starts of an item's windows of each length."""
    out: dict[tuple[int, int], list[int]] = {}
    for start, size, k in windows:
        out.setdefault((size, k), []).append(start)
    return [(np.array(starts), size, k) for (size, k), starts in out.items()]


@dataclass
class Index:
    """The q-grams of a block of items: sorted codes with the item and offset of each."""

    q: int
    rate: float
    window: int
    run: int
    ids: list[int | None]
    texts: list[np.ndarray]
    codes: np.ndarray
    first: np.ndarray  # of each code's postings
    item: np.ndarray
    offset: np.ndarray
    table: np.ndarray
    short: list[tuple[int | None, str]]
    windows: list[list[tuple[np.ndarray, int, int]]]  # starts, length and edits allowed
    least: np.ndarray  # q-grams that any window of the item must share
    longest: int

    @staticmethod
    def build(items: list[tuple[int | None, str | None]], q: int, window: int, rate: float,
              run: int = RUN) -> Index:
        ids, texts, short = [], [], []
        for item_id, text in items:
            chars, _ = folded(text or "")
            if len(chars) >= q:
                ids.append(item_id)
                texts.append(chars)
            elif len(chars):
                short.append((item_id, f" {as_text(chars)} "))
        codes = [grams(t, q) for t in texts]
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(texts), dtype=np.int64), [len(c) for c in codes])
        offset = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        unique, first = np.unique(flat[order], return_index=True)
        table = np.zeros(1 << TABLE_BITS, bool)
        table[(unique >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        windows = [by_length(cut(len(t), q, window, rate, run)) for t in texts]
        least = np.array([min(size + 1 - q * (k + 1) for _, size, k in w) for w in windows], np.int64)
        return Index(q, rate, window, run, ids, texts, unique, np.append(first, len(flat)), item[order], offset[order],
                     table, short, windows, least, max(map(len, texts), default=0))

    def search(self, text: str) -> list[tuple[int | None, int, int, int]]:
        chars, places = folded(text)
        found = []
        if self.short:
            line = f" {as_text(chars)} "
            for item_id, word in self.short:
                at = line.find(word)
                if at >= 0:
                    found.append((item_id, int(places[at]), int(places[at + len(word) - 3]) + 1, 0))
        codes = grams(chars, self.q)
        at = np.flatnonzero(self.table[(codes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        if len(at) and len(self.codes):
            rank = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
            real = self.codes[rank] == codes[at]
            at, rank = at[real], rank[real]
        if not len(at) or not len(self.codes):
            return found
        n = self.first[rank + 1] - self.first[rank]
        place = np.repeat(at, n)
        posting = np.repeat(self.first[rank], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item, offset = self.item[posting], self.offset[posting]
        step = int(self.rate * max(self.window, self.run)) + 1  # diagonals a band moves on; it is twice as wide
        band = (place - offset) // step
        shift = self.longest // step + 2
        lanes = len(codes) // step + shift + 2
        key = item * lanes + band + shift
        key = np.concatenate([key, key - 1])  # the band, and the one before that overlaps it
        offset = np.concatenate([offset, offset])
        # Fewer shared q-grams than any window of the item asks for: no region.
        order = np.argsort(key, kind="stable")
        key, offset = key[order], offset[order]
        regions, first = np.unique(key, return_index=True)
        ends = np.append(first[1:], len(key))
        rich = np.flatnonzero(ends - first >= self.least[regions // lanes])
        best: dict[int, list[int]] = {}
        for r in rich.tolist():
            i, b = divmod(int(regions[r]), lanes)
            shared = np.unique(offset[first[r]:ends[r]])
            for starts, size, k in self.windows[i]:
                n = np.searchsorted(shared, starts + (size - self.q + 1)) - np.searchsorted(shared, starts)
                starts = starts[n >= size + 1 - self.q * (k + 1)]
                for at in range(0, len(starts), AT_ONCE):
                    hits = aligned_windows(self.texts[i], chars, (b - shift) * step, 2 * step, starts[at:at + AT_ONCE],
                                           size, k)
                    for a, z, edits in filter(None, hits):
                        kept = best.setdefault(i, [a, z, edits])
                        kept[:] = [min(kept[0], a), max(kept[1], z), min(kept[2], edits)]
        for i, (a, z, edits) in best.items():
            found.append((self.ids[i], int(places[a]), int(places[z - 1]) + 1, edits))
        return found


def as_text(chars: np.ndarray) -> str:
    return chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def find_passages(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", q: int = Q, window: int = WINDOW, rate: float = RATE,
                  run: int = RUN, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``row`` (all columns of the document) and ``matches``: one entry per item found in it.

    An entry has the item's id, where the passages start and stop in the text (code points), and
    the fewest edits of a window. If an item occurs at several places, the entry spans them all.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("i"),
                             F.col(f"`{item_text_col}`").cast("string").alias("t"))
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = total // block_chars + 1
    text = F.col(f"`{text_col}`").cast("string")
    out = docs.select(whole(docs).alias("row"), text.alias("text"),
                      F.array().cast(MATCH_DDL).alias("matches"))
    for block in range(blocks):
        part: list[Row] = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).collect()
        ordered = sorted(((r["i"], r["t"]) for r in part), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        index = spark.sparkContext.broadcast(Index.build(ordered, q, window, rate, run))

        def search(texts: list[str | None], index=index) -> list[list]:
            return [[dict(zip(("item_id", "start", "stop", "edits"), m)) for m in index.value.search(t)] if t else []
                    for t in texts]

        scan = text_function(search, MATCH_DDL, MATCH)
        out = out.withColumn("matches", F.concat("matches", scan("text")))
    return out.select("row", "matches")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a benchmark passage, with their own columns."""
    found = find_passages(docs, benchmark, **options)
    return found.where(F.size("matches") == 0).select("row.*")
