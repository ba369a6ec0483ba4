"""Golden cases and comparison with plain Python on edge texts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from paperloom.functions import core, labels, payloads, records, text, vectors
from paperloom.functions.stopwords import english_stop_words

L = F.lit  # only called inside tests: a column needs a running session

# A text and what it becomes: cleaned, as author list, last names, words, trimmed, whether it is blank.
EDGE = [
    (None, '', '', '', [], '', True),
    ('', '', '', '', [], '', True),
    ('  \t ', '', '', '', [], '', True),
    (' x ', 'x', 'x', 'x', [], 'x', False),
    ('\xe9tude cafe\u0301', 'tude cafe', '\xe9tude cafe', 'cafe\u0301', ['\xe9tude', 'cafe'], '\xe9tude cafe\u0301', False),
    ('x\xb2 + y', 'x y', 'x\xb2  y', 'y', ['x\xb2'], 'x\xb2 + y', False),
    ('HTTP://a.b/C see http://q.r tail', 'see tail', 'HTTPabC see httpqr tail', 'tail', ['http', 'see', 'http', 'tail'], 'HTTP://a.b/C see http://q.r tail', False),
    ('a,,b, ,c', 'a b c', 'a, b, c', 'a b c', [], 'a,,b, ,c', False),
    ("O'Neil-Smith , ,A.  B. ", 'o neil-smith a b', 'ONeilSmith, A B', "o'neil-smith b.", ['neil', 'smith'], "O'Neil-Smith , ,A.  B.", False),
    ('Q', 'q', 'Q', 'q', [], 'Q', False),
    ('one, two, three, four', 'one two three four', 'one, two, three, four', 'one two three four', ['one', 'two', 'three', 'four'], 'one, two, three, four', False),
    ('tab\tin\nside', 'tab in side', 'tab in side', 'side', ['tab', 'in', 'side'], 'tab\tin\nside', False),
    ('\u0416\u0443\u043a \u03b1\u03b2', '', '\u0416\u0443\u043a \u03b1\u03b2', '\u03b1\u03b2', ['\u0436\u0443\u043a', '\u03b1\u03b2'], '\u0416\u0443\u043a \u03b1\u03b2', False),
    ('http and https://x', 'http and', 'http and httpsx', 'https://x', ['http', 'and', 'https'], 'http and https://x', False),
    ('5 & 6/7: a-b_c', '5 & 6/7: a-b c', '5  67 ab_c', 'a-b_c', ['b_c'], '5 & 6/7: a-b_c', False),
    ('\u3000wide\u3000', 'wide', 'wide', 'wide', ['wide'], 'wide', False),
    ('a\xa0b', 'a b', 'a b', 'b', [], 'a\xa0b', False),
    ('B. \xd6zt\xfcrk, \u738b \u5c0f', 'b zt rk', 'B \xd6zt\xfcrk, \u738b \u5c0f', '\xf6zt\xfcrk \u5c0f', ['\xf6zt\xfcrk'], 'B. \xd6zt\xfcrk, \u738b \u5c0f', False),
    ('0 \x1b\r0', '0 0', '0  0', '0', [], '0 \x1b\r0', False),
    ('A - B', 'a - b', 'A  B', 'b', [], 'A - B', False),
]
FUNCTIONS = [
    text.clean_text,
    text.normalize_author_list,
    text.author_last_names,
    text.tokenize_words,
    lambda c: core.trim_ws(core.safe_text(c)),
    core.is_blank,
]


@pytest.mark.parametrize("place", range(len(FUNCTIONS)))
def test_edge_texts(spark, place):
    df = spark.createDataFrame([(nr, row[0]) for nr, row in enumerate(EDGE)], "nr int, x string").repartition(3)
    got = {r["nr"]: r["y"] for r in df.select("nr", FUNCTIONS[place]("x").alias("y")).collect()}
    for nr, row in enumerate(EDGE):
        assert got[nr] == row[1 + place], ascii(row[0])


@pytest.mark.parametrize(
    "column, expected",
    [
        (lambda: records.normalize_doi(L("https://doi.org/10.1/x")), "10.1/x"),
        (lambda: records.normalize_doi(L("DOI:10.1/x")), "10.1/x"),
        (lambda: records.normalize_doi(L(" 10.1/x ")), "10.1/x"),
        (lambda: records.normalize_doi(L(None)), ""),
        (lambda: records.format_authors(F.array(L(" A B "), L(None), L("C"))), "A B, C"),
        (lambda: text.normalize_author_list(L("  O'Neil-Smith , ,A.  B. ")), "ONeilSmith, A B"),
        (lambda: text.clean_text(L("Hello http://x.y/z World_1: é-A&B/c.")), "hello world 1: -a&b/c"),
        (lambda: text.author_last_names(L("J. Smith, A. van Dyk")), "smith dyk"),
        (lambda: records.year_int(L("2020")), 2020),
        (lambda: records.year_int(L("2020.7")), 2020),
        (lambda: records.year_int(L("n/a")), 0),
        (lambda: records.year_int(L("nan")), 0),
        (lambda: records.year_int(L("2020d")), 0),
        (lambda: records.year_int(L("1e99")), 0),
        (lambda: records.year_int(L(None)), 0),
        (lambda: records.year_norm(L(2015)), 0.5),
        (lambda: records.year_norm(L("x")), 0.0),
        (lambda: records.year_norm(L(2015.7)), 0.5),
        (lambda: records.year_norm(L("2015.7")), 0.0),
        (lambda: records.year_int(L("3e10")), 30_000_000_000),
        (lambda: text.authors_flag(L(" , ")), 0),
        (lambda: text.authors_flag(L(" ,a")), 1),
        (lambda: labels.clamp(L(None).cast("int")), None),
        (lambda: labels.apply_thresholds(L(None).cast("double")), None),
        (lambda: labels.apply_thresholds(L(float("nan"))), 5),
        (lambda: text.prompt_scibert(L("T"), L("A"), L(2020), L("a,b,c,d")),
         "T [SEP] A [SEP] year: 2020, authors: a, b, c et al."),
        (lambda: text.author_count_raw(L(None)), 1),
        (lambda: text.author_count_raw(L("a,,b")), 3),
        (lambda: labels.ordinal_targets(L(3)), [1.0, 1.0, 0.0, 0.0]),
        (lambda: labels.apply_thresholds(L(1.49)), 1),
        (lambda: labels.apply_thresholds(L(1.5)), 2),
        (lambda: labels.apply_thresholds(L(9.0)), 5),
        (lambda: records.is_valid_result(L("a" * 30)), False),
        (lambda: records.is_valid_result(L("a" * 31)), True),
        (lambda: records.is_complete_result(L("a" * 31), L("")), False),
        (lambda: vectors.ev_ordinal(F.array(L(0.0), L(0.0))), 2.0),
        (lambda: vectors.argmax_label(F.array(L(1.0), L(3.0), L(3.0))), 1),
        (lambda: vectors.cosine_distance(F.array(L(0.0), L(0.0)), F.array(L(1.0), L(1.0))), 1.0),
        (lambda: text.ngrams_1_2(F.array(L("a"), L("b"), L("a"))), ["a", "b", "a", "a b", "b a"]),
        (lambda: text.ngrams_1_2(F.array().cast("array<string>")), []),
    ],
)
def test_golden(value, column, expected):
    got = value(column())
    assert got == pytest.approx(expected) if isinstance(expected, float) else got == expected


def test_year_norm_of_the_filled_year(value):
    assert value(records.year_norm(L(0))) == pytest.approx(-66.666667)


def test_term_counts_equal_counting(spark):
    words = ["b", "a", "b", "c", "a", "b", ""]
    df = spark.createDataFrame([(words,), ([],), (["x"],)], "t array<string>").repartition(2)
    got = [dict(map(tuple, r[0])) for r in df.select(text.term_counts("t")).collect()]
    assert {"b": 3, "a": 2, "c": 1, "": 1} in got and {} in got and {"x": 1} in got


def test_payloads(value):
    openalex = ('{"abstract_inverted_index":{"a":[0,3],"b":[1],"c":[2]},'
                '"authorships":[{"author":{"display_name":" X Y "}},{"author":{}}]}')
    assert value(payloads.parse_openalex(L(openalex)))[1:] == ("a b c a", "X Y")
    assert value(payloads.parse_openalex(L('{"abstract_inverted_index":null}')))[1:] == ("", "")
    crossref = ('{"message":{"abstract":"<jats:p>hi</jats:p> <p>ho</p>",'
                '"author":[{"given":"G","family":"F"},{"family":"Z"},{}]}}')
    assert value(payloads.parse_crossref(L(crossref)))[1:] == ("hi ho", "G F, Z")
    s2 = '{"abstract":" q ","authors":[{"name":"n1"},{"name":" "},{}]}'
    assert value(payloads.parse_semantic_scholar(L(s2)))[1:] == ("q", "n1")
    hit = '{"message":{"items":[{"abstract":"<jats:p>hi</jats:p>","DOI":"d"},{"DOI":"e"}]}}'
    assert tuple(value(payloads.search_crossref(L(hit)))) == ("d", "hi", "")
    assert value(payloads.search_crossref(L('{"message":{"items":[]}}'))) is None
    for parse in (payloads.parse_openalex, payloads.parse_crossref, payloads.parse_semantic_scholar):
        assert value(parse(L("no json"))) is None
        assert value(parse(L(None))) is None


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<META content='a > \"b\" &amp; c' Name=\"citation_abstract\"/>", 'a > "b" & c'),
        ('<meta name="citation_abstract" content=""><meta name=description content=zz>', "zz"),
        ('<meta name="description" content="d"><meta name="citation_abstract" content="c">', "c"),
        ('<meta name="dc.description" content=" x ">', "x"),
        ('<meta name="keywords" content="k">', ""),
        (None, ""),
    ],
)
def test_meta_abstract(value, html, expected):
    assert value(payloads.meta_abstract(L(html))) == expected


@pytest.mark.parametrize(
    "reply, expected",
    [
        ('```json\n{"score": 9, "reason": "r"}\n```', (5, "r")),
        ('{"score": "3", "reason": "a"}', (3, "a")),
        ('{"score": -2, "reason": "a"}', (1, "a")),
        ('{"score": 2.7, "reason": "q"}', (2, "q")),
        ("oops", (None, "invalid JSON")),
        ('{"reason": "a"}', (None, "missing score")),
        ('{"score": 1}', (None, "missing reason")),
        (None, (None, "invalid JSON")),
        ('{"score": 3, "reason": "a"} and more', (None, "invalid JSON")),
        ('{"score": 3, "reason": "a"}, {"score": 4, "reason": "b"}', (None, "invalid JSON")),
        ('{"score": "2.7", "reason": "a"}', (None, "score is no number")),
        ('{"score": 4, "reason": null}', (4, None)),
        ('[{"score": 4, "reason": "a"}]', (None, "invalid JSON")),
    ],
)
def test_replies(value, reply, expected):
    assert tuple(value(labels.parse_llm_json(L(reply)))) == expected


def test_stop_words_are_the_ones_spark_ships(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(english_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_an_indented_document_is_read_or_refused(spark, tmp_path):
    from paperloom.sources import io

    (tmp_path / "one.json").write_text('[\n  {\n    "id": 1,\n    "title": "t"\n  },\n  {"id": 2}\n]\n')
    read = io.load_json(spark, str(tmp_path), "id long, title string", document=True)
    assert sorted(map(tuple, read.collect())) == [(1, "t"), (2, None)]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        io.load_json(spark, str(tmp_path), "id long, title string").collect()


def test_doubled_answers_have_one_winner(spark):
    from paperloom.operators import enrich

    def answer(text):
        return '{"abstract":"%s","authors":[{"name":"n"}]}' % text

    rows = [(1, "semantic_scholar", 200, answer("short " * 8)), (1, "semantic_scholar", 200, answer("longer " * 8)),
            (2, "semantic_scholar", 200, answer("same length a " * 4)), (2, "semantic_scholar", 200, answer("same length b " * 4))]
    papers = spark.createDataFrame([(1, "10.1/a", "t"), (2, "10.1/b", "u")], "id long, doi string, title string")
    won = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id long, source string, status int, payload string").coalesce(1)
        won.append(sorted(map(tuple, enrich.priority_fallback(df, papers).collect())))
    assert won[0] == won[1] and won[0][0][2].startswith("longer")
