import random

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that the operators use for their own columns.
CLASHING = (
    "n_words kept clean_text ids decoded n_tokens copies weight exponent shard slot size row recipe rep "
    "grp token label component_id node spans at keys lines n_lines n_dropped line id block _source h hash".split()
)


def invented(seed: int = 1, n: int = 40) -> list[tuple[int, str | None]]:
    """Texts with copies, near copies, shared passages and lines, and odd cases."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghäé") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def prose(words: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(words)) + "."

    passage, line = prose(90), "A Line that many documents share, word for word."
    texts: list[str | None] = []
    for k in range(n):
        text = prose(rng.choice([3, 12, 60, 150]))
        if k % 5 == 1:
            text = f"{text}\n{line if k % 2 else line.upper()}\n{prose(20)}"
        if k % 7 == 2:
            text = f"{text} {passage} {prose(10)}"
        if k % 6 == 3 and k > 6:
            words = (texts[k - 3] or "x").split(" ")
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        if k % 8 == 4:
            text = (texts[k - 4] or "").replace(" ", "  \n", 3)
        texts.append(text)
    texts += [None, "", " \n\t", "a", "a b", "same words", "Same  words", "🙂 é ü", "x" * 450, "x" * 450]
    texts += ["<|endoftext|> 's 'LL  \n\n  end", prose(6000), "one " * 400, "| a | b | c | d |" * 9]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table of (doc_id, text), with other columns and names that clash."""

    def make(docs, partitions: int = 3, clash: bool = True):
        rows = [(d, t, "en", f"src{(d or 0) % 3}", len(t or "")) for d, t in docs]
        df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
        for name in CLASHING if clash else ():
            df = df.withColumn(name, df["lang"])
        return df

    return make


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs():
    return invented()


def rows(df, *columns) -> set[tuple]:
    return set(map(tuple, df.select(*columns).collect()))


__all__ = ["Row", "invented", "rows"]
