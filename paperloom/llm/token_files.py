"""Token ids in files of independent zstandard frames with a seek table.

One document is one frame. After the frames stand two skippable frames that any zstandard
reader passes over: the document ids with their token counts, and the seek table of the public
seekable format, which holds for each frame its two sizes and the low 32 bits of the XXH64 of
its content. A reader loads the two tables from the end of the file and then only the frames
it was asked for.

Rows are put in order of document id by range partitioning; each task streams its range into
files of bounded size, so no task holds more than one document and one batch. Files are written
under a name of the attempt's own and then renamed, so that a repeated task leaves one copy.

Defined results: a null text is empty and yields the end id alone; null ids come first; equal
ids are ordered by the hash of the text, then the text, and repeated rows stay repeated; an empty
table yields no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialize, scratch_path

# Fixed values of the public format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_DOCUMENTS = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

END_ID = 2
FILE_BYTES = 64 << 20  # of token ids before compression; a longer document fills one file
CACHE_UNITS = 500_000

# What counts as white space for the tokenizer.
BLANK = ("\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
         + "\u2028\u2029\u202f\u205f\u3000")
UNIT = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
TAIL = ".,;:!?|#*$%&"


def byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 stays, other bytes follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class CachedTokenizer:
    """Ids of whole texts from a byte-level vocabulary, looked up by words.

    The vocabulary's own splitting rule never joins characters across single spaces and line ends
    between words, so the ids of a text are those of its words in a row. The library encodes
    each word once; two generations of a dictionary bound what is remembered. A key is a word that
    follows a space, or a line end and the word that follows it. A text that holds the string of an
    added token goes to the library whole, with the library's own settings.
    """

    def __init__(self, path: str, limit: int = CACHE_UNITS) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.limit = limit
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        letters = byte_letters()
        self.letters = str.maketrans({chr(b): c for b, c in letters.items()})
        self.space = letters[32]
        self.line_end = self._library("\n")

    def _library(self, text: str) -> bytes:
        ids = self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, keys: Iterable[str]) -> None:
        """Look up keys, or encode them, each word once."""
        tokenize, space, letters = self.model.tokenize, self.space, self.letters
        for key in keys:
            found = self.old.get(key)
            if found is not None:
                self.new[key] = found
                continue
            base = key.rstrip(TAIL)
            stem = base[1:] if base[:1] == "\n" else base
            if not stem.isalpha() or not stem.isascii() and max(stem) >= "\u0250":
                self.new[key] = self._library(key if key[0] == "\n" else " " + key)
                continue
            # Latin letters are one piece for the splitting rule, and the punctuation after them another.
            known = self.new.get(base) or self.old.get(base)
            if known is None:
                piece = stem if stem.isascii() else stem.encode().decode("latin-1").translate(letters)
                if base is stem:
                    known = array("I", [t.id for t in tokenize(space + piece)]).tobytes()
                else:
                    known = self.line_end + array("I", [t.id for t in tokenize(piece)]).tobytes()
                self.new[base] = known
            if len(base) < len(key):
                tail = key[len(base):]
                if tail not in self.tails:
                    if len(self.tails) > 10_000:
                        self.tails.clear()
                    self.tails[tail] = self._library(tail)
                self.new[key] = known + self.tails[tail]

    def _known(self, key: str) -> bytes:
        if key not in self.new:
            self._learn([key])
        return self.new[key]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        cut = [self._keys(t) if t else None for t in texts]
        missing = set().union(*(keys for keys in cut if keys)).difference(self.new)
        if missing:
            self._learn(missing)
        # The first word was given a line end that the text does not hold.
        return [b"".join(map(self.new.__getitem__, keys))[4:] if keys else self._text(t) if t else b"" for t, keys in zip(texts, cut)]

    def _keys(self, text: str) -> list[str] | None:
        """The words of a text that has nothing but single spaces and line ends between them."""
        if any(map(text.__contains__, self.added)):
            return None
        words = text.split()
        gaps = text.count(" ") + text.count("\n")
        if len(words) != gaps + 1 or sum(map(len, words)) + gaps != len(text):
            return None
        keys = text.replace("\n", " \n").split(" ")
        keys[0] = "\n" + keys[0]
        return keys

    def _text(self, text: str) -> bytes:
        """Any text, by units of the general rule."""
        if any(map(text.__contains__, self.added)):
            return self._library(text)
        out = []
        for unit in UNIT.findall(text):
            word = unit[1:] if unit[0] == " " else unit
            if not word or not word.isprintable():
                out.append(self._library(unit))
            elif len(word) < len(unit):
                out.append(self._known(word))
            else:
                out.append(self._known("\n" + word)[4:])
        return b"".join(out)


TOKENIZERS: dict[str, CachedTokenizer] = {}  # one for each vocabulary in a worker


def tokenizer(path: str) -> CachedTokenizer:
    if path not in TOKENIZERS:
        TOKENIZERS[path] = CachedTokenizer(path)
    return TOKENIZERS[path]


class FrameWriter:
    """One file: frames, document table, seek table."""

    def __init__(self, sink) -> None:
        self.sink = sink
        self.compressor = zstandard.ZstdCompressor(level=1)
        self.entries: list[tuple[int, int, int]] = []
        self.documents: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        self.sink.write(frame)
        self.entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.documents.append((doc_id is not None, doc_id or 0, len(ids) // 4))

    def close(self) -> None:
        table = b"".join(struct.pack("<BqQ", *d) for d in self.documents)
        self.sink.write(struct.pack("<II", SKIPPABLE_DOCUMENTS, len(table)) + table)
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)
        self.sink.close()


class FrameReader:
    """Reads the tables from the end of a file, then single frames on demand."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a seekable token file")
        start = size - 9 - 12 * n
        self.entries = list(struct.iter_unpack("<III", self._at(start, 12 * n)))
        start -= 8 + 17 * n
        self.documents = [(i if there else None, count)
                          for there, i, count in struct.iter_unpack("<BqQ", self._at(start, 17 * n))]
        self.offsets = np.concatenate([[0], np.cumsum([e[0] for e in self.entries], dtype=np.int64)]).tolist()
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, k: int) -> bytes:
        packed, length, checksum = self.entries[k]
        ids = self.decompressor.decompress(self._at(self.offsets[k], packed), max_output_size=length)
        if len(ids) != length or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return ids


def shared_uri(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, by the file system that Spark itself would use for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return full.replace("file:/", "file:///", 1) if re.match("file:/(?!/)", full) else full


MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()),
                      ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64())])


def write_token_files(docs: DataFrame, vocabulary: str, folder: str, *, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all documents below ``folder`` in order of id; returns the written table of files.

    ``folder`` is in a store that pyarrow can write on every executor (file:, hdfs:, s3:, ...); without
    a scheme it is on the session's default file system. ``vocabulary`` names a tokenizer file that exists on every executor.
    """
    end = struct.pack("<I", end_id)
    folder = shared_uri(docs.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part, seq, writer, done = TaskContext.get().partitionId(), 0, None, 0
        cached = tokenizer(vocabulary)
        rows: list[tuple] = []

        def finish() -> None:
            writer.close()
            path = f"{base}/tokens-{part:06d}-{seq:05d}.zst"
            store.move(f"{path}.{attempt}", path)
            rows.append((part, seq, path, len(writer.entries), sum(d[2] for d in writer.documents)))

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                piece = batch.slice(at, 64)
                ids = cached.encode([t or "" for t in piece.column(1).to_pylist()])
                for doc_id, tokens in zip(piece.column(0).to_pylist(), ids):
                    if writer is None:
                        attempt = uuid.uuid4().hex
                        writer = FrameWriter(store.open_output_stream(f"{base}/tokens-{part:06d}-{seq:05d}.zst.{attempt}"))
                    writer.add(doc_id, tokens + end)
                    done += len(tokens) + 4
                    if done >= file_bytes:
                        finish()
                        seq, writer, done = seq + 1, None, 0
        if writer is not None:
            finish()
        columns = list(zip(*rows)) if rows else [[]] * len(MANIFEST)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MANIFEST)], schema=MANIFEST)

    text = F.col(f"`{text_col}`").cast("string")
    ordered = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"),
                          F.xxhash64(text).alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    files = ordered.select("doc_id", "text").mapInArrow(
        write, "part int, seq int, path string, n_docs long, n_tokens long")
    return materialize(files, "token-files")


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    The running total goes over one row per file. Each file is read by one task, a frame at a time.
    """
    folder = shared_uri(files.sparkSession, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(path) as source:
                    reader = FrameReader(source)
                    rows = []
                    for k, (doc_id, n) in enumerate(reader.documents):
                        ids = reader.frame(k)
                        rows.append((doc_id, start, n, zlib.crc32(ids)))
                        start += n
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, READ)], schema=READ)

    earlier = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("start"))
    return placed.repartition(max(1, files.count())).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(uri: str, wanted: set[int | None]) -> Iterator[tuple[int | None, np.ndarray]]:
    """The token ids of the wanted documents of one file; other frames are not read."""
    store, place = fs.FileSystem.from_uri(uri)
    with store.open_input_file(place) as source:
        reader = FrameReader(source)
        for k, (doc_id, _) in enumerate(reader.documents):
            if doc_id in wanted:
                yield doc_id, np.frombuffer(reader.frame(k), "<u4")


def token_table(spark: SparkSession, docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write the documents to a fresh folder of the session's shared storage and read them back."""
    folder = scratch_path(spark, "tokens")
    return read_token_files(write_token_files(docs, vocabulary, folder, **options), folder)
