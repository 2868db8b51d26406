import pytest

ODD = [
    None, "", "  ", "\n", "a", "don't 'tis I'll", "a  b\n\nc \n d", "é×÷ à", "ÉCOLE À 12345 x1y2", "İstanbul ΣΑΣ", "<|endoftext|> a<|startoftext|>b <|end",
    "日本語 テキスト", "a b c　d", "café ́x", "x" * 500 + " " + "ab1!" * 100, "a\nb a\nb", "tab\tsep  \t x", "🙂🙂 hi🙂", " lead", "trail ",
    "\u0085x", "foo_bar __ -- 1.2.3", "same text again", "same text again", "word " * 30_000, "z" * 40_000,
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with extra columns whose names clash with ours, a null id and an id that two rows share."""
    rows = [(i, t, "en", "raw", "x", 1) for i, t in enumerate(ODD)]
    rows += [(None, "no id", "en", "raw", "x", 1), (3, "an id twice", "en", "raw", "x", 1), (22, "same text again", "en", "raw", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, raw string, start string, DOC_ID long")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
