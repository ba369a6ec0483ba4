from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from paperloom.llm import alignment
from paperloom.llm.queries import QUERIES
from paperloom.llm.token_files import byte_letters

A_PATH, B_PATH = (str(public_tokenizers.path(x)) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PARTS = ["a", "The", " ", "  ", "\n", "\n\n", "\t", "don't", "é", "日本", "123", "!!", ".", "\x1c", "\xa0", "<|endoftext|>", "<s>",
         "<0x0A>", "\0", "x" * 70, " .", "\r\n", "ﬁ", "▁", "é", "word", " "]
ODD = [(1, None), (2, ""), (3, " "), (4, "one two one two one"), (4, "one two one two one"), (None, "no id\nat all"), (5, "▁"),
       (6, "a  b\t c"), (7, "<|endoftext|> <s>"), (8, "long words " * 30_000), (9, "x" * 50_000), (10, "日本 é\n\nfin ")]


class Plain:
    """Whole texts by the two libraries, overlaps by comparing byte ranges."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        self.letters = {c: b for b, c in byte_letters().items()}

    def tokens(self, text):
        """Both lists of (id, start, end), or nothing."""
        if not text:
            return [], []
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode())
             for i in self.b.encode(text)]
        out = []
        for side in (a, b):
            if b"".join(x for _, x in side) != (" " + text).encode():
                return [], []
            at, placed = 0, []
            for i, x in side:
                placed.append((i, at, at + len(x)))
                at += len(x)
            out.append(placed)
        return out

    def document(self, text):
        a, b = self.tokens(text)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, links, i, j = [], [], 0, 0
        for end in ends:
            left, right = [], []
            while i < len(a) and a[i][2] <= end:
                left.append(a[i])
                i += 1
            while j < len(b) and b[j][2] <= end:
                right.append(b[j])
                j += 1
            links += [(x, y) for x, s, e in left for y, t, f in right if s < f and t < e]
            groups.append(",".join(str(x) for x, *_ in left) + "|" + ",".join(str(y) for y, *_ in right))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        return len(a), len(b), len(groups), links, digest

    def corpus(self, rows):
        done = [(i, *self.document(t)) for i, t in rows]
        count = Counter(x for d in done for x in d[4])
        docs = Counter(x for d in done for x in set(d[4]))
        most = defaultdict(int)
        for (_, b), n in count.items():
            most[b] = max(most[b], n)
        out = [(i, na, nb, ng, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), digest)
               for i, na, nb, ng, links, digest in done]
        return out, {x: (docs[x], n, n == most[x[1]]) for x, n in count.items()}


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A_PATH, B_PATH)


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.text(max_size=30))
def test_words_align_as_whole_texts(plain, aligner, text):
    na, nb, ng, links, digest = plain.document(text)
    units, = aligner.units([text])
    assert [sum(aligner.counts[u][k] for u in units) for k in range(4)] == [na, nb, ng, len(links)]
    got = Counter()
    for u in units:
        for k in range(aligner.starts[u], aligner.starts[u + 1]):
            got[aligner.codes[k] >> 16, aligner.codes[k] & 0xFFFF] += aligner.times[k]
    assert got == Counter(links)
    assert (hashlib.sha256(";".join(aligner.groups[u] for u in units).encode()).hexdigest() if units else "") == digest


def check(out, pairs, want):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted([tuple(r) for r in out.select(*columns).collect()], key=str) == sorted(want[0], key=str)
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"], r["best"]) for r in pairs.collect()} == want[1]


@pytest.mark.parametrize("block_units", [3, alignment.BLOCK_UNITS])
def test_odd_rows(spark, plain, block_units):
    rows = [(i, t, 1, "b", None) for i, t in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int, groups string, a int").repartition(3)
    check(*alignment.align(docs, A_PATH, B_PATH, block_units=block_units), plain.corpus(ODD))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out, pairs = alignment.align(docs, A_PATH, B_PATH)
    assert out.collect() == [] and pairs.collect() == []


def test_common_words_fill_bitmaps(spark, plain):
    rows = [(i, "the same words " + "again " * (i % 5) + f"and {i}") for i in range(alignment.BLOCK_DOCS + 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")  # no multiple of a slice
    check(*alignment.align(docs, A_PATH, B_PATH), plain.corpus(rows))


def test_whole_table(spark, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_alignment"].run(spark, SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(plain.corpus(rows)[0])
