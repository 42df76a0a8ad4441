"""Small inputs with every kind of awkward row."""

import random

from pyspark.sql import DataFrame, SparkSession

DOC_COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns whose names the operators use inside.
CLASHES = ["body", "owner", "first", "words", "lines", "host", "fingerprint", "component_id", "failures", "row", "doc", "slot", "n_dropped"]

WORDS = "the of and to in a is that for it was on are as with his they at be this from have or by one had not but what all were".split()


def prose(seed: int, words: int) -> str:
    """Random words in lines and sentences."""
    rng = random.Random(seed)
    out = []
    for i in range(words):
        word = rng.choice(WORDS) + str(rng.randint(0, 40)) * (rng.random() < 0.5)
        out.append(word + ("." if rng.random() < 0.1 else "") + ("\n" if rng.random() < 0.05 else " "))
    return "".join(out).strip()


def awkward() -> list[tuple]:
    """Documents with nulls, empty and blank texts, repeated rows and ids, a long text and odd characters."""
    long = prose(1, 6000)
    base = prose(2, 120)
    return [
        (0, base, "en", "a", len(base)),
        (1, base, "en", "a", None),
        (2, base.replace(" ", " x ", 1), "en", None, 3),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, " \n\t ", "en", "b", 4),
        (6, long, "de", "b", len(long)),
        (6, long, "de", "b", len(long)),
        (7, "One", "en", "b", 3),
        (8, "Zürich ß İ \U0001f600 é\u0085x\x0by\x0c z\r\nq", "de", "b", 1),
        (None, prose(3, 80), "fr", "c", 9),
        (None, None, None, "c", None),
        (9, "<|endoftext|> </s> ###$$$ a|b", "en", "c", 2),
        (-5, prose(4, 90) + "\n" + base, "en", "c", 1),
    ]


def documents(spark: SparkSession, rows: list[tuple] | None = None, clashing: bool = False) -> DataFrame:
    rows = awkward() if rows is None else rows
    df = spark.createDataFrame(rows, DOC_COLUMNS)
    if clashing:
        for name in CLASHES:
            df = df.selectExpr("*", f"'clash' as `{name}`")
    return df


def near_copies(texts: int, seed: int, words: int = 400) -> list[tuple]:
    """Documents of which some differ from an earlier one by a word or two, and some not at all."""
    rng = random.Random(seed)
    rows: list[tuple] = []
    for i in range(texts):
        if rows and rng.random() < 0.5:
            parts = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(0, 2)):
                parts[rng.randrange(len(parts))] = rng.choice(WORDS)
            text = " ".join(parts)
        else:
            text = prose(1000 + seed * 997 + i, words)
        rows.append((i, text, "en", f"s{rng.randint(0, 2)}", len(text)))
    return rows


def collected(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
