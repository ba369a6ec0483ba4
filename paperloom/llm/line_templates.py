"""Line deduplication with a log-template tree of fixed depth.

A line's path in the tree is its number of words and its first ``DEPTH`` words; a word with a digit
is a variable field there and everywhere. In a leaf, a word stays part of the template where it
stands at the same place often enough, counting each line once per document that holds it (a document
with two such lines counts twice), and is generalised to a variable field elsewhere. Lines with the same
template are the same line, unless less than ``CONSTANT`` of its words are constant; then the line stands
for itself. A template found in enough different documents is recurring, and its lines are dropped from
all documents. Copies of a text count as one. Enough are ``LONG_DOCS`` for lines of more than
``LONG_WORDS`` words, which do not recur by chance, and ``MIN_DOCS`` for shorter ones.

Only hashes of lines are counted. The words are read again for lines of leaves that can hold a recurring
template not found by equal lines alone, each from one text that holds it. Counting is by aggregations
over (leaf, place, word), which are combined before the shuffle, so a leaf may hold any number of
lines. Joins by text, line, leaf or word spread the keys that occur most.

Defined results: a null text has no lines and stays null; blank lines are neither counted nor
dropped; a line of exactly ``LONG_WORDS`` words is a short one; lines are cut at line feeds only and may be of any length; repeated rows are treated
alike; an empty table gives no rows. Columns are kept, whatever their names.
"""

from __future__ import annotations

import re
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators import skew
from ..session import materialize
from .common import columns_function, text_function, whole

DEPTH = 3
MIN_DOCS = 5
LONG_WORDS = 50
LONG_DOCS = 2
CONSTANT = 0.6
FIELD = b"<*>"
DIGIT = re.compile(rb"[0-9]")


def fields(line: bytes) -> list[bytes]:
    """The words of a line, those with a digit as variable fields."""
    words = line.split()  # bytes: at ASCII space only
    if DIGIT.search(line):
        words = [FIELD if DIGIT.search(w) else w for w in words]
    return words


def number(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def leaf_number(words: list[bytes], depth: int) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words[:depth]), seed=len(words)) - (1 << 63)


def lines_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def parsed(text: str | None, depth: int) -> list[tuple[int, int, list[bytes]]]:
    """``leaf, line, words`` of every different line that holds a word."""
    out = {}
    for raw in lines_of(text):
        words = fields(raw)
        if words:
            line = number(words)
            if line not in out:
                out[line] = (leaf_number(words, depth), line, words)
    return list(out.values())


# The tables of lines and texts grow with the corpus, so they are never broadcast, however small they are in a run.
lookup_join = partial(skew.lookup_join, strategy="merge")


def _by_text(docs: DataFrame, text_col: str, *extra: Column) -> DataFrame:
    """Rows with the hash of their text; texts without a word have none, for they match nothing."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(*extra, text.alias("text"), F.monotonically_increasing_id().alias("spread"), F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(text)).alias("whole"))


def recurring_lines(docs: DataFrame, *, text_col: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS,
                    constant: float = CONSTANT, long_words: int = LONG_WORDS,
                    long_docs: int = LONG_DOCS) -> tuple[DataFrame, DataFrame]:
    """``found``: ``whole, leaf, line, long, copies`` of every text and line; ``lines``: the recurring ones, with ``docs``."""
    both = pa.list_(pa.struct([("leaf", pa.int64()), ("line", pa.int64()), ("long", pa.bool_())]))
    numbers = text_function(
        lambda texts: [[{"leaf": a, "line": b, "long": len(words) > long_words} for a, b, words in parsed(t, depth)]
                       for t in texts],
        "array<struct<leaf:long,line:long,long:boolean>>", both)
    enough = F.when(F.col("long"), long_docs).otherwise(min_docs)
    source = _by_text(docs, text_col)
    found = source.select("whole", F.explode(numbers("text")).alias("l")).select("whole", "l.leaf", "l.line", "l.long")
    found = materialize(found.groupBy("whole", "leaf", "line", "long").agg(F.count("*").alias("copies")), "lines")
    counts = found.groupBy("leaf", "line", "long").agg(
        F.count("*").alias("docs"), F.min(F.struct("whole", "copies")).alias("home"))
    counts = materialize(counts, "line-counts")
    equal = counts.where(F.col("docs") >= enough).select("line", "docs")

    # Leaves where rare lines together stand in enough documents.
    rare = F.sum(F.when(F.col("docs") < enough, F.col("docs")).otherwise(0))
    leaves = counts.groupBy("leaf", "long").agg(F.count("*").alias("n"), F.sum("docs").alias("total"), rare.alias("rare"))
    leaves = leaves.where((F.col("n") > 1) & (F.col("total") >= enough) & (F.col("rare") > 0)).select("leaf", "n")
    open_lines = materialize(lookup_join(counts, materialize(leaves, "leaves"), "leaf", "n", "line", "inner").drop("n"), "open-lines")
    worded = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.list_(pa.int64()))]))

    def words_of(texts: list[str], wanted: list[list[int]]) -> list[list[dict]]:
        return [[{"line": line, "words": [number([w]) for w in words]} for _, line, words in parsed(t, depth)
                 if len(words) > depth and line in chosen] for t, chosen in zip(texts, map(set, wanted))]

    spell = columns_function(words_of, "array<struct<line:long,words:array<long>>>", worded)
    homes = open_lines.groupBy(F.col("home.whole").alias("whole")).agg(
        F.collect_list("line").alias("wanted"), F.max("home.copies").alias("copies"))
    held = lookup_join(source, materialize(homes, "homes"), "whole", "copies", "spread", "inner")
    spelled = held.select(F.explode(spell("text", "wanted")).alias("l")).select("l.line", "l.words").dropDuplicates(["line"])
    spelled = materialize(spelled.join(open_lines.hint("merge"), "line"), "open-words")
    places = spelled.select("leaf", "line", "long", "docs", F.posexplode("words").alias("place", "word"))
    places = places.withColumn("at", F.struct("leaf", "place", "word"))
    common = places.where(F.col("place") >= depth).groupBy("at", "long").agg(F.sum("docs").alias("n"), F.count("*").alias("lines"))
    common = common.where(F.col("n") >= enough).select("at", "lines", F.lit(True).alias("stays"))
    # Each place of a line, with a null word where it is generalised; the leading words always stay.
    shaped = lookup_join(places, materialize(common, "common-words"), "at", "lines", "line")
    stays = F.coalesce("stays", F.lit(False)) | (F.col("place") < depth)
    shaped = shaped.groupBy("leaf", "line", "long", "docs").agg(
        F.count("*").alias("n"), F.sum(stays.cast("int")).alias("kept"),
        F.sum(F.when(stays, F.xxhash64("place", "word")).otherwise(F.xxhash64("place")).cast("decimal(38,0)")).alias("shape"))
    shaped = materialize(shaped.where(F.col("kept") >= constant * F.col("n")).drop("kept"), "shapes")
    texts = lookup_join(found.select("line", "whole"), shaped, "line", "docs", "whole", "inner")
    recurring = (
        texts.select("leaf", "long", "n", "shape", "whole").distinct()
        .groupBy("leaf", "long", "n", "shape").agg(F.count("*").alias("texts")).where(F.col("texts") >= enough)
    )
    alike = shaped.join(recurring.drop("long"), ["leaf", "n", "shape"], "left_semi").select("line", "docs")
    return found, materialize(equal.union(alike).distinct(), "recurring")


def without_recurring(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """``row`` (all columns, the text without recurring lines), ``n_lines`` and ``n_dropped``."""
    found, lines = recurring_lines(docs, text_col=text_col, **options)
    gone = lookup_join(found.select("whole", "line", "copies"), lines, "line", "docs", "whole")
    # Every text has a row here, so that one with very many copies is spread whether it loses a line or not.
    drops = materialize(gone.groupBy("whole").agg(
        F.max("copies").alias("copies"), F.collect_list(F.when(F.col("docs").isNotNull(), F.col("line"))).alias("drop")), "drops")
    source = _by_text(docs, text_col, whole(docs).alias("row"))
    source = lookup_join(source, drops, "whole", "copies", "spread").select("row", "drop")
    kind = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])

    def cut(texts: list[str | None], dropped: list[list[int] | None]) -> list[dict]:
        out = []
        for t, d in zip(texts, dropped):
            lines, gone, n, n_gone = [], set(d or ()), 0, 0
            for raw in lines_of(t):
                words = fields(raw)
                n += bool(words)
                if words and gone and number(words) in gone:
                    n_gone += 1
                else:
                    lines.append(raw)
            kept = None if t is None else t if not n_gone else b"\n".join(lines).decode("utf-8", "surrogatepass")
            out.append({"text": kept, "n_lines": n, "n_dropped": n_gone})
        return out

    cutter = columns_function(cut, "struct<text:string,n_lines:long,n_dropped:long>", kind)
    out = source.select("row", cutter(F.col("row")[text_col].cast("string"), F.col("drop")).alias("c"))
    return out.select(F.col("row").withField(f"`{text_col}`", F.col("c.text")).alias("row"), "c.n_lines", "c.n_dropped")
