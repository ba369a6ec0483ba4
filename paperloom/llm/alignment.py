"""Alignment of two tokenizers over a corpus, counted by inverted pair bitmaps.

A byte-level vocabulary (A) and a piece vocabulary (B) cut the same bytes. Where tokens of both end,
a group ends; an occurrence of A and one of B are linked if their byte ranges overlap. For each pair
of ids the corpus keeps postings: the documents of a block of ``BLOCK_DOCS`` as a compressed bitmap (OR-merged
over the words that hold the pair), and, where a document links the pair more than once, planes for the
bits of that number. Their popcounts, summed over the blocks, give a pair's documents and links. The
counts then go back along the postings: every block adds up the scores of its own documents.

Neither vocabulary joins characters across a single space or line end between words, nor a letter and the mark
after it (checked for B when it is loaded), so words are aligned once per worker and a document is a list of
words. Texts for which that is not certain, for instance runs of blanks, are aligned in longer pieces, at the
utmost whole.

No task holds more than a block and one document. Pairs are counted by an aggregate, which is combined
before the shuffle; a pair has one posting per block, however many documents hold it. Numbers of blocks
and places are fixed by the written table, so a repeated task changes nothing.

Defined results: a null or empty text, or one whose tokens of either side do not spell a space and the
text, has no tokens: all numbers are 0 and ``groups`` is empty; strings of special tokens are plain text;
repeated rows count each; null ids stay; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .token_files import byte_letters

BLOCK_DOCS = 4096
BITMAP = BLOCK_DOCS // 8
BLOCK_UNITS = 1_000_000
SLICE = 64  # documents cut at a time
CACHE_LINKS = 2_000_000
# Letters that every splitting rule takes for letters, and marks that pieces never join to them.
LETTER, STOP = "[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]", "[.,;:!?]"
# A single space or line end with other characters on both sides, or a mark after a letter.
SPLIT = re.compile(rf"(?<=\S)(?=[ \n]\S)|(?<={LETTER})(?={STOP})")
PIECE_SPACE = "▁"


def aligned(a: list[int], b: list[int], a_sizes: list[int], b_sizes: list[int]) -> tuple[list[str], list[int]]:
    """Groups and links of two token lists that spell the same bytes; within a group ends never meet.

    A link is a pair of tokens that overlap, written as one number.
    """
    groups, links, i, j = [], [], 0, 0
    a_end, b_end = a_sizes[a[0]], b_sizes[b[0]]
    left, right = str(a[0]), str(b[0])
    while True:
        links.append(a[i] << 16 | b[j])
        if a_end == b_end:
            groups.append(f"{left}|{right}")
            i, j = i + 1, j + 1
            if i == len(a):
                return groups, links
            left, right = str(a[i]), str(b[j])
            a_end, b_end = a_end + a_sizes[a[i]], b_end + b_sizes[b[j]]
        elif a_end < b_end:
            i += 1
            left += f",{a[i]}"
            a_end += a_sizes[a[i]]
        else:
            j += 1
            right += f",{b[j]}"
            b_end += b_sizes[b[j]]


class Aligner:
    """Aligned words of a worker: each has a number, its counts, its groups and its pairs with repeats."""

    def __init__(self, bpe_path: str, piece_path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.bpe = Tokenizer.from_file(bpe_path)
        self.bpe.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = {c: b for b, c in byte_letters().items()}
        self.a_bytes = [b""] * self.bpe.get_vocab_size()
        for token, i in self.bpe.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token)
        self.pieces = SentencePieceProcessor(model_file=piece_path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.pieces.is_byte(i) else n.replace(PIECE_SPACE, " ").encode()
                        for i, n in enumerate(names)]
        self.a_sizes, self.b_sizes = ([len(x) for x in side] for side in (self.a_bytes, self.b_bytes))
        self.line_start = self.pieces.encode("\n")  # the space that the vocabulary adds, and the line end
        if len(names) >= 1 << 16:
            raise ValueError("more than 65,536 pieces")
        joined = re.compile(LETTER + STOP)
        self.by_words = len(self.line_start) == 2 and not any(
            PIECE_SPACE in n.lstrip(PIECE_SPACE) or "\n" in n or joined.search(n) for n in names)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.counts: list[tuple[int, int, int, int]] = []
        self.groups: list[str] = []
        self.starts = array("q", [0])
        self.codes, self.times = array("q"), array("q")

    def _piece_ids(self, units: list[str]) -> list[list[int]]:
        """Ids of units that begin with a space, which the vocabulary adds itself, or follow a line end put before them."""
        out = []
        encoded = self.pieces.encode([u[1:] if u[0] == " " else u if u[0] == "\n" else "\n" + u for u in units], num_threads=1)
        for unit, ids in zip(units, encoded):
            if unit[0] != " ":
                begins = ids[:2] == self.line_start
                ids = ids[1 if unit[0] == "\n" else 2:] if begins else []
            out.append(ids)
        return out

    def learn(self, units: list[str]) -> None:
        a_all = [e.ids for e in self.bpe.encode_batch_fast(units, add_special_tokens=False)]
        for unit, a, b in zip(units, a_all, self._piece_ids(units)):
            spelled = unit.encode("utf-8", "surrogatepass")
            if (b"".join(map(self.a_bytes.__getitem__, a)) != spelled
                    or b"".join(map(self.b_bytes.__getitem__, b)) != spelled):
                self.number[unit] = -1
                continue
            groups, links = aligned(a, b, self.a_sizes, self.b_sizes)
            self.number[unit] = len(self.counts)
            self.counts.append((len(a), len(b), len(groups), len(links)))
            self.groups.append(";".join(groups))
            if len(set(links)) < len(links):
                count = Counter(links)
                self.codes.extend(count.keys())
                self.times.extend(count.values())
            else:
                self.codes.extend(links)
                self.times.extend([1] * len(links))
            self.starts.append(len(self.codes))

    def units(self, texts: list[str | None]) -> list[list[int]]:
        """For each text the numbers of its words; none if the text has no tokens."""
        cut = [(SPLIT.split(" " + t) if self.by_words else [" " + t]) if t else [] for t in texts]
        new = {u for units in cut for u in units if u not in self.number}
        if new:
            self.learn(sorted(new))
        numbers = [list(map(self.number.__getitem__, units)) for units in cut]
        return [[] if -1 in n else n for n in numbers]


ALIGNERS: dict[tuple[str, str], Aligner] = {}  # one for each pair of vocabularies in a worker


def aligner(bpe_path: str, piece_path: str) -> Aligner:
    key = (bpe_path, piece_path)
    if key not in ALIGNERS:
        ALIGNERS[key] = Aligner(*key)
    return ALIGNERS[key]


def containers(group: np.ndarray, docs: np.ndarray, n: int) -> list[bytes | None]:
    """For each of ``n`` groups its documents: two bytes for each, or a bitmap where that is shorter."""
    edges = np.searchsorted(group, np.arange(n + 1))
    raw = docs.astype("<u2").tobytes()
    out: list[bytes | None] = []
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if 2 * (end - start) < BITMAP:
            out.append(raw[2 * start:2 * end] or None)
        else:
            bits = np.zeros(BLOCK_DOCS, np.uint8)
            bits[docs[start:end]] = 1
            out.append(np.packbits(bits, bitorder="little").tobytes())
    return out


def places(container: bytes) -> np.ndarray:
    if len(container) < BITMAP:
        return np.frombuffer(container, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8), bitorder="little"))


def popcount(container: Column) -> Column:
    return F.when(F.length(container) < BITMAP, F.length(container) / 2).otherwise(F.bitmap_count(container)).cast("long")


def postings(known: Aligner, texts: list[list[int]]) -> tuple[np.ndarray, list[bytes], list[list[bytes | None]]]:
    """Pairs of a block in order, their document bitmaps, and the planes of repeats (bits of the number less one)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n_units = max(1, len(known.counts))
    flat = np.fromiter((u for t in texts for u in t), np.int64, int(sizes.sum()))
    held, repeats = np.unique(np.repeat(np.arange(len(texts)), sizes) * n_units + flat, return_counts=True)
    doc, unit = held // n_units, held % n_units
    starts, codes, times = (np.array(x, np.int64) for x in (known.starts, known.codes, known.times))
    lengths = starts[unit + 1] - starts[unit]
    at = np.repeat(starts[unit] - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
    key = codes[at] * BLOCK_DOCS + np.repeat(doc, lengths)
    amount = times[at] * np.repeat(repeats, lengths)
    order = np.argsort(key, kind="stable")
    key, amount = key[order], amount[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    amount = np.add.reduceat(amount, first) if len(key) else amount
    key = key[first]
    pairs, group = np.unique(key // BLOCK_DOCS, return_inverse=True)
    docs = key % BLOCK_DOCS
    planes: list[list[bytes | None]] = [[] for _ in pairs]
    more, k = amount - 1, 0
    while (more >> k).any():
        chosen = (more >> k & 1).astype(bool)
        for place, packed in zip(planes, containers(group[chosen], docs[chosen], len(pairs))):
            place.append(packed)
        k += 1
    return pairs, containers(group, docs, len(pairs)), planes


TABLE = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                   ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
                   ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.binary()), ("planes", pa.list_(pa.binary()))])
TABLE_DDL = ("block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
             "a int, b int, docs binary, planes array<binary>")


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in TABLE], schema=TABLE)


def build(docs: DataFrame, bpe_path: str, piece_path: str, *, id_col: str = "doc_id", text_col: str = "text",
          block_units: int = BLOCK_UNITS) -> DataFrame:
    """The written table of documents (``a`` is null) and of postings, by blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seq = aligner(bpe_path, piece_path), 0
        ids: list[int | None] = []
        texts: list[list[int]] = []
        digests: list[str] = []
        size = 0

        def closed() -> Iterator[pa.RecordBatch]:
            block = TaskContext.get().partitionId() << 32 | seq
            counts = np.array(known.counts, np.int64).reshape(-1, 4)
            sums = np.array([counts[t].sum(axis=0) if t else (0, 0, 0, 0) for t in texts], np.int64)
            yield _batch(block=[block] * len(ids), place=range(len(ids)), doc_id=ids, n_a=sums[:, 0], n_b=sums[:, 1],
                         n_groups=sums[:, 2], n_links=sums[:, 3], groups=digests)
            pairs, held, planes = postings(known, texts)
            for at in range(0, len(pairs), 10_000):
                part = slice(at, at + 10_000)
                yield _batch(block=[block] * len(pairs[part]), a=(pairs[part] >> 16).astype(np.int32),
                             b=(pairs[part] & 0xFFFF).astype(np.int32), docs=held[part], planes=[p or None for p in planes[part]])
            if len(known.codes) > CACHE_LINKS:
                known.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                piece = batch.slice(at, SLICE)
                for doc_id, numbers in zip(piece.column(0).to_pylist(), known.units(piece.column(1).to_pylist())):
                    ids.append(doc_id)
                    texts.append(numbers)
                    digests.append(hashlib.sha256(";".join(map(known.groups.__getitem__, numbers)).encode()).hexdigest() if numbers else "")
                    size += len(numbers)
                if len(ids) + SLICE > BLOCK_DOCS or size >= block_units:
                    yield from closed()
                    ids, texts, digests, size, seq = [], [], [], 0, seq + 1
        if ids:
            yield from closed()

    source = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    return materialize(source.mapInArrow(run, TABLE_DDL), "pair-postings")


def pair_counts(table: DataFrame) -> DataFrame:
    """``a, b, n_docs, n_links, best`` of every pair: whether none of its B id has more links."""
    repeats = F.aggregate(F.transform("planes", lambda p, k: F.pow(F.lit(2), k).cast("long") * F.coalesce(popcount(p), F.lit(0))),
                          F.lit(0).cast("long"), lambda x, y: x + y)
    held = table.where(F.col("a").isNotNull()).select("a", "b", popcount(F.col("docs")).alias("n"), F.coalesce(repeats, F.lit(0)).alias("more"))
    pairs = materialize(held.groupBy("a", "b").agg(F.sum("n").alias("n_docs"), F.sum(F.col("n") + F.col("more")).alias("n_links")), "pairs")
    most = pairs.groupBy("b").agg(F.max("n_links").alias("most"))
    return pairs.join(most, "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def scores(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """``block, place, n_best, count_sum``: what the postings give back to their documents."""
    kind = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best, total = None, np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)

        def finished() -> pa.RecordBatch:
            used = np.flatnonzero(total)
            arrays = ([current] * len(used), used.astype(np.int32), best[used], total[used])
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(arrays, kind)], schema=kind)
            best[:], total[:] = 0, 0
            return out

        for batch in batches:
            for block, held, planes, n, top in zip(*(c.to_pylist() for c in batch.columns)):
                if block != current:
                    if current is not None:
                        yield finished()
                    current = block
                for k, packed in enumerate([held, *(planes or ())]):
                    if packed:
                        at = places(packed)
                        weight = 1 << max(0, k - 1)
                        total[at] += weight * n
                        if top:
                            best[at] += weight
        if current is not None:
            yield finished()

    held = table.where(F.col("a").isNotNull()).select("block", "a", "b", "docs", "planes")
    # Both tables grow with the corpus.
    back = held.join(pairs.hint("merge"), ["a", "b"]).select("block", "docs", "planes", "n_links", "best")
    back = back.repartition("block").sortWithinPartitions("block")
    return back.mapInArrow(run, "block long, place int, n_best long, count_sum long")


def align(docs: DataFrame, bpe_path: str, piece_path: str, **options) -> tuple[DataFrame, DataFrame]:
    """One row per document with its counts and scores, and the table of pairs."""
    table = build(docs, bpe_path, piece_path, **options)
    pairs = materialize(pair_counts(table), "pair-counts")
    rows = table.where(F.col("a").isNull()).drop("a", "b", "docs", "planes")
    given = scores(table, pairs).hint("merge")
    out = rows.join(given, ["block", "place"], "left").drop("block", "place")
    return out.fillna(0, ["n_best", "count_sum"]), pairs
