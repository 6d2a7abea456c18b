"""Text functions against golden rows and against a plain-Python model of the same rules."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from placepulse.functions import labels, text

# The rules as Python patterns, in cleaning order.
PATTERNS = {
    "html": r"<[^>]+>",
    "urls": r"https?://[a-zA-Z0-9$-_@.&+!]+",
    "emails": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phones": r"(\+?\d{1,4}[-.\s]?)?\(?\d{1,3}\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}",
    "mentions": r"@\w+",
    "hashtags": r"#\w+",
    "special": r"""[^\w\s.,!?;:'"()-]""",
}


def blank_out(name, value):
    return re.sub(PATTERNS[name], " ", value)


def unaccent(value):
    return "".join(c for c in unicodedata.normalize("NFD", value) if unicodedata.category(c) != "Mn")


def squeeze(value):
    kept = []
    for char in value:
        if char == "\n" or kept[-2:] != [char, char]:
            kept.append(char)
    return "".join(kept)


def one_mark(value):
    for mark in ".!?":
        value = re.sub(re.escape(mark) + "{2,}", mark, value)
    return value


def model_clean(value):
    for name in ("html", "urls", "emails", "phones", "mentions", "hashtags"):
        value = blank_out(name, value)
    value = blank_out("special", unaccent(value))
    return " ".join(one_mark(squeeze(value)).split()).lower() or None


def model_again(value):
    value = re.sub(r"(http|www)\S+", "", value or "")
    value = re.sub(r"\S+@\S+", "", value)
    return " ".join(re.sub(r"\b\d{10,}\b", "", value).split())


MODEL = {
    "html": (text.strip_html, lambda v: blank_out("html", v)),
    "urls": (text.strip_urls, lambda v: blank_out("urls", v)),
    "emails": (text.strip_emails, lambda v: blank_out("emails", v)),
    "phones": (text.strip_phones, lambda v: blank_out("phones", v)),
    "social": (text.strip_social, lambda v: blank_out("hashtags", blank_out("mentions", v))),
    "accents": (text.fold_accents, unaccent),
    "special": (text.strip_special, lambda v: blank_out("special", v)),
    "repeats": (text.squeeze_repeats, squeeze),
    "punct": (text.squeeze_punct, one_mark),
    "space": (text.squeeze_space, lambda v: re.sub(r"\s+", " ", v).strip()),
    "lower": (text.lower, str.lower),
    "clean": (text.clean_text, model_clean),
    "again": (text.clean_again, model_again),
    "length": (text.text_length, len),
    "words": (text.word_count, lambda v: len(v.split())),
    "split": (text.words, lambda v: v.split()),
    "blank": (text.is_blank, lambda v: not v.strip()),
}

PIECES = [
    *"aaabbcAZ@@..%+-_|##12345 \n\t\x0b\x1c\x85\xa0\r<>()!?éßøÉ한글각²½①😀—​́ก็ৌ٣/:",
    "http://", "https://", "www.", "httpx", "a@b.co", "éa", "x.y@z.com", "éab.c@d.org",
    "+66 53-123-456", "<b>", "</b>", "<>", "...", "???", "!!!", "1234567890", "@a_b", "#x1",
]


@pytest.fixture(scope="module")
def corpus(spark, sf):
    chance = random.Random(7)
    made = ["".join(chance.choice(PIECES) for _ in range(chance.randint(0, 24))) for _ in range(6000)]
    given = [
        row[0]
        for name, column in (("documents", "text"), ("pages", "html"), ("conversations", "text"))
        for row in spark.read.parquet(f"{sf}/{name}.parquet").select(column).collect()
    ]
    rows = made + given
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string").repartition(8).cache()
    return rows, df


@pytest.mark.parametrize("name", MODEL)
def test_function_equals_model(corpus, name):
    rows, df = corpus
    function, model = MODEL[name]
    for row in df.select("i", "t", function(F.col("t")).alias("o")).collect():
        expected = model(rows[row.i])
        assert row.o == expected, (rows[row.i], row.o, expected)


GOLDEN = [
    ("html", "a <b class=x>c</b> d", "a  c  d"),
    ("html", "1 < 2", "1 < 2"),
    ("html", '<a t="x>y">z', ' y">z'),
    ("html", "&amp; <>", "&amp; <>"),
    ("urls", "see https://x.org/a%20b#frag, ok", "see  #frag, ok"),
    ("emails", "a+b@c.de x@y.z", "  x@y.z"),
    ("phones", "50", "50"),
    ("phones", "a 100 b 2019, 5 5 5.", "a   b  ,  ."),
    ("phones", "24 7", " "),
    ("phones", "1,000", "1, "),
    ("phones", "10/10", "10/10"),
    ("phones", "4.5", "4.5"),
    ("phones", "٣٣٣", " "),
    ("phones", "+66 53-123-456", " "),
    ("social", "hi @a_b #x1 # é@ñu", "hi     # é "),
    ("accents", "ß\u00f8 e\u0301\u00e9 \uac01", "ß\u00f8 ee \u1100\u1161\u11a8"),
    ("special", "a²½①b😀c—d", "a²½①b c d"),
    ("repeats", "aa bbb cccc\n\n\n\r\r\r", "aa bb cc\n\n\n\r\r"),
    ("punct", "a.. b!!! c?? d,,", "a. b! c? d,,"),
    ("space", " a\xa0\x1cb\x85", "a b"),
    ("clean", "<p> </p>", None),
    ("clean", "", None),
    ("clean", "Sooooo GOOOD!!!  Visit https://a.b @me", "soo good! visit"),
    ("again", "www.x.y httpabc a@b 123456789 1234567890 12345678901 x", "123456789 x"),
    ("words", " ", 0),
    ("words", "a　b\x1cc", 3),
]


@pytest.mark.parametrize(("name", "value", "expected"), GOLDEN)
def test_golden(spark, name, value, expected):
    function = MODEL[name][0]
    assert spark.createDataFrame([(value,)], "t string").select(function(F.col("t"))).first()[0] == expected


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    for name, (function, _) in MODEL.items():
        expected = {"again": "", "blank": True}.get(name)
        assert df.select(function(F.col("t"))).first()[0] == expected, name


def test_very_long_tokens(spark):
    n = 200_000
    awkward = ["a" * n, "a." * n, "<" * n, "<a>" + "<" * n, "http://" + "a" * n, "1" * n, "@" * n, "x@" + "a." * n, "é" * n, "a@" * n]
    df = spark.createDataFrame([(value,) for value in awkward], "t string").repartition(8)
    for function in (text.clean_text, text.clean_again, text.word_count):
        assert df.select(function(F.col("t"))).where("false").count() == 0
        df.select(F.length(function(F.col("t")).cast("string")).alias("n")).agg(F.sum("n")).collect()


def test_cleaning_twice_changes_no_space_or_case(spark, corpus):
    _, df = corpus
    once = text.lower(text.squeeze_space(F.col("t")))
    assert df.where(text.lower(text.squeeze_space(once)) != once).count() == 0


def test_full_review_keeps_the_leading_space(spark):
    df = spark.createDataFrame([(None, "b"), ("a", None), ("a", "b")], "a string, b string")
    found = [row[0] for row in df.select(text.full_review(F.col("a"), F.col("b"))).collect()]
    assert found == [" b", "a ", "a b"]


def test_labels(spark):
    df = spark.createDataFrame([(i,) for i in [1, 2, 3, 4, 5, 0, 6, None]], "r int")
    r = F.col("r")
    five = [row[0] for row in df.select(labels.sentiment_label(r)).collect()]
    assert five == ["Very Negative", "Negative", "Neutral", "Positive", "Very Positive"] + ["unknown"] * 3
    three = [row[0] for row in df.select(labels.sentiment3(r)).collect()]
    assert three == ["Negative", "Negative", "Neutral", "Positive", "Positive", None, None, None]
    ids = [row[0] for row in df.select(labels.label_to_id(labels.sentiment_label(r))).collect()]
    assert ids == [0, 1, 2, 3, 4, None, None, None]
    back = [row[0] for row in df.select(labels.id_to_label(r)).collect()]
    assert back == ["Negative", "Neutral", "Positive", "Very Positive", None, "Very Negative", None, None]
    texts = spark.createDataFrame([("5 stars",), ("1 star",), ("x",), (None,)], "s string")
    assert [row[0] for row in texts.select(labels.parse_stars(F.col("s"))).collect()] == [5, 1, None, None]
    shown = spark.createDataFrame([("Very Positive",), ("unknown",), ("",)], "s string")
    assert [row[0] for row in shown.select(labels.display_label(F.col("s"))).collect()] == ["Very positive", "Unknown", ""]
