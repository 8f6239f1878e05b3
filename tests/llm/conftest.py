import numpy as np
import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])

#: Nulls, empty and long texts, ties, repeated rows, odd white space, marks and special tokens.
TEXTS = [
    None, "", " ", "\n", "one", "two words", "Dogs bark.  Cats\tmeow \r\n again ", "it's THE end, isn't it? 'tis", "<|endoftext|> in <|startoftext|>text<|endoftext|>",
    "naïve Éréou, J̌ İstanbul ǅ ﬁ ½ ٣ 漢字 漢字", "a\x00b \x1c c\x85d e f", "x" * 3000, "alpha beta gamma delta " * 700, "end with newline\n", "\n\nstart\n \n", "12,345.67 -- (fine) “quoted” ’s 'll 'S",
    "line one\nline two\nline one\n", "same text here twice", "same text here twice", "🙂🙂 👩‍👩‍👧 ok!!", "word...!? word;: a|b |c| d", "Á é İ",
]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[18], (None, "a row without an id", None, None, None), (None, None, None, None, None), (18, "same id, other text", "en", "src1", 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def labelled(spark, docs):
    rng = np.random.default_rng(7)
    rows, labels = [], []
    for i in range(100, 500):
        words = [f"w{x}" for x in rng.integers(0, 50, 30)]
        toxic = i % 4 == 0
        if toxic:
            for at in rng.integers(0, 30, 3):
                words[at] = str(rng.choice(["idiot", "scum", "trash"]))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    labels += [(1, 0, 0), (None, 0, 1), (2, None, None), (9999, 1, 1)]
    return spark.createDataFrame(rows, SCHEMA).unionByName(docs), spark.createDataFrame(labels, LABELS)
