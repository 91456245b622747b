import os

import pytest

#: Before any worker starts: the tokenizers library must not use threads in forked workers.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SF = "/root/testdata/sf0.001"
#: Texts that stress word, white-space and control-string handling.
ODD = [None, "", " ", "   \n\t ", "a", "a  b\n c▁d <s> \x00", "x\n", "\n\nx  y \n z", " lead", "trail ", "ΑΣ ΣΑΣ İstanbul",
       "don't I'LL we've 12345 a1b2", "<|endoftext|>x <|ENDOFTEXT|>", "é é ́x", "日本語 テキスト", "a b c\x1cd\x85e",
       "▁ ▁▁a▁", "😀👍🏽 x", "\t\ttab\r\n\r\n", "a\n \nb", "a\n  b", " x ", " \n", "a \n", "!!!", "1234", "word " * 3000]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts with ids from -5 (ties and a NULL id among them), and columns whose names clash with
    those that operators make."""
    rows = [(i - 5, t) for i, t in enumerate(ODD)] + [(3, "same text twice"), (3, "same text twice"), (4, "another text"), (4, "and one more"), (None, "no id"), (None, None)]
    cols = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, chunk long, part int, fp string, label int, words string, rate double, content long, size int"
    return spark.createDataFrame([(*r, "en", None if k % 3 else "h", len(r[1] or ""), "s", "k", 1, 2, "f", 3, "w", 0.5, 4, 5) for k, r in enumerate(rows)], cols)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
