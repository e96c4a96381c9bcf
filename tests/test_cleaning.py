import pytest
from pyspark.sql import functions as F

from textforge.functions import cleaning as C
from textforge.functions import tokens as K
from textforge.functions.stages import TermTokenizer, TextCleaner
from textforge.functions.stopwords import KEPT_NEGATIONS, STOP_WORDS, without_negations, word_table
from textforge.session import scratch_path

ROWS = [
    None,
    "",
    "   ",
    "<b>Hi</b> &amp; bye",
    "&lt;b&gt;x",
    "see https://a.b/c?d=1 www.x.y ftp://z end",
    "snake_case don't stop!!",
    "abc123 ٣ ² ½",
    "smile 😀 ✂ flag 🇩🇪 漢字 한국어",
    "a\nb\tc d\u0085e  f\x1cg",
    "ÀÉ ß Straße",
    "I me the cat and THE dog",
    "&notit; &copy &#x41; &#66;",
    "<unclosed tag",
    "x" * 50_000 + " <i>tail</i> 9",
]


# What each row becomes, in the order of ROWS without the long one.
EXPECTED = {
    C.FULL: (
        [
            '',
            '',
            '',
            'hi bye',
            'bx',
            'see end',
            'snake_case dont stop',
            'abc \xb2 \xbd',
            'smile flag',
            'b c d e f g',
            'àé \xdf stra\xdfe',
            'cat dog',
            'b',
            'unclosed tag',
        ],
        ' tail',
    ),
    C.DEFAULT: (
        [
            '',
            '',
            '',
            'bhib bye',
            'bx',
            'see httpsabcd wwwxy ftpz end',
            'snake_case dont stop',
            'abc \xb2 \xbd',
            'smile flag \u6f22\u5b57 \ud55c\uad6d\uc5b4',
            'a b c d e f g',
            'àé \xdf stra\xdfe',
            'i me the cat and the dog',
            'it a b',
            'unclosed tag',
        ],
        ' itaili',
    ),
    C.LIGHT: (
        [
            '',
            '',
            '',
            'bhib amp bye',
            'ltbgtx',
            'see httpsabcd wwwxy ftpz end',
            'snake_case dont stop',
            'abc \xb2 \xbd',
            'smile flag \u6f22\u5b57 \ud55c\uad6d\uc5b4',
            'a b c d e f g',
            'àé \xdf stra\xdfe',
            'i me the cat and the dog',
            'notit copy x',
            'unclosed tag',
        ],
        ' itaili',
    ),
    C.options("full", null_text="nan"): (
        [
            'nan',
            '',
            '',
            'hi bye',
            'bx',
            'see end',
            'snake_case dont stop',
            'abc \xb2 \xbd',
            'smile flag',
            'b c d e f g',
            'àé \xdf stra\xdfe',
            'cat dog',
            'b',
            'unclosed tag',
        ],
        ' tail',
    ),
    C.options("full", remove_stopwords=False, wide_emoji=False): (
        [
            '',
            '',
            '',
            'hi bye',
            'bx',
            'see end',
            'snake_case dont stop',
            'abc \xb2 \xbd',
            'smile flag \u6f22\u5b57 \ud55c\uad6d\uc5b4',
            'a b c d e f g',
            'àé \xdf stra\xdfe',
            'i me the cat and the dog',
            'it a b',
            'unclosed tag',
        ],
        ' tail',
    ),
    C.options("light", remove_punctuation=False, lowercase=False): (
        [
            '',
            '',
            '',
            '<b>Hi</b> &amp; bye',
            '&lt;b&gt;x',
            'see https://a.b/c?d= www.x.y ftp://z end',
            "snake_case don't stop!!",
            'abc \xb2 \xbd',
            'smile \U0001f600 \u2702 flag \U0001f1e9\U0001f1ea \u6f22\u5b57 \ud55c\uad6d\uc5b4',
            'a b c d e f g',
            '\xc0\xc9 \xdf Stra\xdfe',
            'I me the cat and THE dog',
            '&notit; &copy &#x; &#;',
            '<unclosed tag',
        ],
        ' <i>tail</i>',
    ),
    C.options("light", remove_extra_whitespace=False, remove_numbers=False): (
        [
            '',
            '',
            '   ',
            'bhib amp bye',
            'ltbgtx',
            'see httpsabcd1 wwwxy ftpz end',
            'snake_case dont stop',
            'abc123 \u0663 \xb2 \xbd',
            'smile   flag  \u6f22\u5b57 \ud55c\uad6d\uc5b4',
            'a\nb\tc\xa0d\x85e  f\x1cg',
            'àé \xdf stra\xdfe',
            'i me the cat and the dog',
            'notit copy x41 66',
            'unclosed tag',
        ],
        ' itaili 9',
    ),
}


@pytest.mark.parametrize("opts", EXPECTED, ids=range(len(EXPECTED)))
def test_cleaner_gives_the_expected_texts(spark, opts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ROWS)], "id int, text string")
    got = [r.cleaned for r in C.with_clean(df, "text", opts=opts).orderBy("id").collect()]
    want, tail = EXPECTED[opts]
    assert got[:-1] == want
    assert got[-1] == "x" * 50_000 + tail


def test_cleaning_twice_changes_nothing(spark):
    df = spark.createDataFrame([(t,) for t in ROWS], "text string")
    opts = C.options("full", unescape=False)
    once = C.with_clean(df, "text", "once", opts)
    twice = C.with_clean(once, "once", "twice", opts)
    assert twice.filter("once <> twice").count() == 0


def test_stop_word_lists(spark):
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 76
    words = {r.word for r in without_negations(word_table(spark, STOP_WORDS)).collect()}
    assert words == set(STOP_WORDS) - set(KEPT_NEGATIONS)
    assert [r.word for r in word_table(spark, ["it's"]).collect()] == ["it's"]


def test_tokens_and_ngrams(spark):
    rows = [(0, "The cat a sat"), (1, "one"), (2, ""), (3, "b"), (4, "x1 y_2 É3")]
    df = spark.createDataFrame(rows, "id int, text string")
    df = df.withColumn("w", K.term_tokens(F.col("text"), ("the",)))
    got = {r.id: r.g for r in df.withColumn("g", K.ngrams(F.col("w"), 1, 3)).collect()}
    assert got == {
        0: ["cat", "sat", "cat sat"],
        1: ["one"],
        2: [],
        3: [],
        4: ["x1", "y_2", "é3", "x1 y_2", "y_2 é3", "x1 y_2 é3"],
    }
    only = {r.id: r.g for r in df.withColumn("g", K.ngrams(F.col("w"), 2, 2)).collect()}
    assert only[0] == ["cat sat"] and only[1] == []
    with pytest.raises(ValueError):
        K.ngrams(F.col("w"), 2, 1)


def test_term_counts_in_the_row(spark):
    df = spark.createDataFrame(
        [(0, ["b", "a", "b"]), (1, []), (2, ["z"])], "id int, t array<string>"
    )
    got = {r.id: [tuple(c) for c in r.counts] for r in K.with_term_counts(df, "t").collect()}
    assert got == {0: [("a", 1), ("b", 2)], 1: [], 2: [("z", 1)]}


def test_text_features(spark):
    df = spark.createDataFrame([(" the cat (sat). it's  me-!",)], "text string")
    features = K.text_features(F.col("text"), ("the", "me"))
    row = df.select(*(c.alias(n) for n, c in features.items())).first()
    assert row.asDict() == {
        "word_count": 5, "num_stop_words": 1, "num_chars": 26, "num_punc_chars": 6,
    }


def test_stages_survive_saving(spark):
    df = spark.createDataFrame([(t,) for t in ROWS], "text string")
    opts = C.options("full", stop_words=("cat",), null_text="nan")
    stage = TextCleaner.of(opts)
    path = scratch_path(spark, "cleaner")
    stage.save(path)
    loaded = TextCleaner.load(path)
    assert loaded.options() == opts
    assert loaded.transform(df).collect() == stage.transform(df).collect()
    tok = TermTokenizer(inputCol="text", outputCol="t", low=1, high=2, stopWords=["cat"])
    path = scratch_path(spark, "tokenizer")
    tok.save(path)
    assert TermTokenizer.load(path).transform(df).collect() == tok.transform(df).collect()


def test_light_cleaner_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("x",)], "text string")
    plan = C.with_clean(df, "text", opts=C.LIGHT)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    full = C.with_clean(df, "text")._jdf.queryExecution().executedPlan().toString()
    assert full.count("ArrowEvalPython") == 1


def test_space_characters_agree(spark):
    # The trimming set, the pattern class and Python's own idea of whitespace.
    codes = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in codes], "code int, text string")
    by_pattern = {r.code for r in df.filter(F.col("text").rlike(f"[{C.P.SPACE}]")).collect()}
    assert by_pattern == {c for c in codes if chr(c).isspace()} == set(map(ord, C.P.SPACE_CHARS))
    assert {r.code for r in df.filter(C.strip_ends(F.col("text")) == "").collect()} == by_pattern
