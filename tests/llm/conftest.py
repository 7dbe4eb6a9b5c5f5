import pytest


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the package shipped to its workers."""
    from lampwatch.session import ship_package

    ship_package(spark)
    return spark


LONG = " ".join(f"w{i % 977} x{i % 13}" for i in range(30_000))
ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today again."),
    (2, "The  quick\tbrown fox\njumps over the lazy dog near the river bank today again. "),
    (3, None), (4, ""), (5, " \t\r\n"), (6, "word"), (7, "Two words"),
    (8, LONG), (9, LONG + " tail"), (10, "ÉCOLE é é 中文 \U0001f600 \x00 \x1c ▁ <s> </s> <0x0A> <|endoftext|>"),
    (11, "tie"), (12, "t i e"), (13, "ti e"),
    (14, "same same"), (14, "same same"), (14, "other text under one id"),
    (None, "no id"), (None, None), (15, "a\\b <|im_start|> \\n <|"), (16, "  lead and  trail  "),
]


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Odd documents, with extra columns named like the operators' own."""
    rows = [(i, t, "en", f"s{n}", n, float(n), "x", True, n) for n, (i, t) in enumerate(ODD_TEXTS)]
    return llm.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, row long, score double, "
              "digest string, kept boolean, part long").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
