from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from paperloom.llm import token_files
from paperloom.llm.queries import QUERIES, vocabulary
from paperloom.session import scratch_path

PIECES = ["a", "The", " ", "  ", "\n", "\n\n", "\t", "don't", "re:", "é", "日本", "123", "!!", ".", ",", "\x1c",
          "\xa0", " ", "<|endoftext|>", "\0", "x" * 40, " .", "\r\n", "##", "\xad", "Ø", "ñ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


@pytest.fixture(scope="module")
def cached():
    return token_files.CachedTokenizer(vocabulary(), limit=50)


@settings(max_examples=400, deadline=None, derandomize=True)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join) | st.text(max_size=30), max_size=4))
def test_cached_ids_equal_the_library(library, cached, texts):
    got = [np.frombuffer(b, "<u4").tolist() for b in cached.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def expected(library, rows):
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_odd_rows_round_trip(spark, library):
    rows = [(3, "three words here", 1, "p"), (None, "no id", 2, "q"), (1, None, 3, "r"), (2, "", 4, "s"),
            (5, "long " * 60_000, 5, "t"), (6, "hello <|endoftext|> world", 7, "v"), (3, "three words here", 6, "u"), (4, "a b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long, path string").repartition(3)
    got = sorted(token_files.token_table(spark, docs, vocabulary(), file_bytes=64).collect(), key=lambda r: r["start"])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [tuple(r) for r in got] == expected(library, [r[:2] for r in order])
    assert token_files.token_table(spark, docs.limit(0), vocabulary()).collect() == []


def test_whole_table(spark, library):
    from conftest import SMALL

    got = sorted(QUERIES["op10_token_files"].run(spark, SMALL).collect(), key=lambda r: r["start"])
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(library, rows)


def test_damage_is_found_and_only_wanted_frames_are_read(spark, library):
    folder = scratch_path(spark, "frames")
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(9)], "doc_id long, text string").coalesce(1)
    files = token_files.write_token_files(docs, vocabulary(), folder).collect()
    path = max(files, key=lambda r: r["n_docs"])["path"]
    uri = f"file://{path}"
    first, *_, last = [i for i, _ in token_files.read_documents(uri, set(range(9)))]
    (doc_id, ids), = token_files.read_documents(uri, {last})
    assert doc_id == last
    assert ids.tolist() == library.encode(f"text number {last}", add_special_tokens=False).ids + [2]
    data = bytearray(open(path, "rb").read())
    data[-10] ^= 1  # the checksum of the last frame
    open(path + ".bad", "wb").write(data)
    assert [i for i, _ in token_files.read_documents(uri + ".bad", {first})] == [first]
    with pytest.raises(ValueError):
        list(token_files.read_documents(uri + ".bad", {last}))


def test_added_tokens_are_the_librarys(library, cached):
    text = "hello <|endoftext|> world"
    got = np.frombuffer(cached.encode([text])[0], "<u4").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids == [31373, 220, 50256, 995]


def test_paths_without_a_scheme_follow_the_default_file_system(spark):
    assert token_files.shared_uri(spark, "/tmp/x") == "file:///tmp/x"
    assert token_files.shared_uri(spark, "file:///tmp/x") == "file:///tmp/x"
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.store.link./shared", "file:///tmp")
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://store/")
    try:
        assert token_files.shared_uri(spark, "/shared/x") == "viewfs://store/shared/x"
        assert token_files.shared_uri(spark, "file:/tmp/x") == "file:///tmp/x"
    finally:
        conf.set("fs.defaultFS", before)


def test_many_different_words_are_kept():
    """A vocabulary of 400,000 different words is learned once, not again in every slice."""
    many = token_files.CachedTokenizer(vocabulary())
    many.new = {f"word{k}": b"" for k in range(400_000)}
    many.encode(["another text"])
    assert len(many.new) > 400_000 and not many.old
