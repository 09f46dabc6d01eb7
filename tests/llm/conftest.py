import pytest

SF = "/root/testdata/sf0.001"

CLASHES = ("size", "score", "key", "fp", "digits", "position", "shard", "bucket", "id", "n", "found", "target")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def awkward_rows():
    long_text = " ".join(f"word{i % 977} über" for i in range(20_000))
    same = (7, "the same row twice over and over", "en", "src1", 32)
    return [
        (1, None, "en", "src0", None), (2, "", None, None, 0), (3, " \t\n", "en", "src0", 3),
        (4, "one two", "fr", None, 7), (5, long_text, "en", "src2", len(long_text)), same, same, same,
        (None, "a row without an id that has some words", "en", "src1", 39),
        (8, "12 % 日本 😀 'tis o'clock <|endoftext|> end", "de", "srcé", 39),
        (9, "the same row twice over and over", "en", "src2", 32), (10, "x" * 5000, "en", "src0", 5000),
    ]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    df = spark.createDataFrame(awkward_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    for i, c in enumerate(CLASHES):
        df = df.selectExpr("*", f"cast({'null' if i % 2 else i} as int) as `{c}`")
    return df


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
