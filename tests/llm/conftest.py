import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus():
    """Documents with nulls, empty and long texts, copies, near copies, odd
    white space, special strings and clashing column names."""
    rng = random.Random(7)
    stems = ["the", "tion", "and", "ing", "ère", "ñol", "Straße", "eau", "of", "don't", "42", "日本", "É"]

    def prose(n):
        return " ".join("".join(rng.choices(stems, k=rng.randint(1, 3))) for _ in range(n))

    base = prose(300)
    swap = base.split()
    swap[150] = "changed"
    texts = [None, "", " ", "\n\t", "one", "Two words", base, base, base.upper(), " ".join(swap), base + " " + prose(80),
             prose(40) + " " + base[200:700] + " " + prose(30), "a" * 6000, "Orre " * 900, "xy" * 3000 + "<|endoftext|>" + "  z ",
             "<s> </s> <|startoftext|> ▁ ▁▁", "\x1c\x1d a᠎ b​", "tab\tnew\r\nline nb　wide", "12345 678 -- !!",
             "👍🏽 é é ́", prose(3000), "".join(rng.choices("abcdefé", k=9000))]
    texts += [prose(rng.randint(1, 60)) for _ in range(20)] + [base] * 5
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    schema = "doc_id bigint, text string, n_tokens string, id int, fp string, row int, shard int, node int, start int, lang_pred string"
    return spark.createDataFrame([(d, t, "x", 1, "x", 1, 1, 1, 1, "zz") for d, t in corpus], schema).repartition(5)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


@pytest.fixture(scope="session")
def same():
    def check(df, expected, *cols):
        got, want = rows(df, *cols), sorted(map(tuple, expected), key=repr)
        assert len(got) == len(want)
        for a, b in zip(got, want, strict=True):
            assert a == b
    return check


@pytest.fixture(scope="session")
def table(spark):
    """Rows of a table of the smallest test data."""
    def read(name, *cols):
        return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*cols).collect()]
    return read
