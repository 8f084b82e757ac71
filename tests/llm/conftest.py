import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table, with columns whose names clash with the operators' own, from (id, text) rows."""

    def make(rows):
        df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
        for name in ("tag", "score", "id", "row", "block", "spans", "m", "words", "key", "shard", "letters"):
            df = df.withColumn(name, df["source"])
        return df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a very long one, one without letters, repeated rows."""
    long = " ".join(f"w{k % 977}x{k % 13}" for k in range(30_000))
    return [(1, "the quick brown fox jumps over the lazy dog"), (1, "the quick brown fox jumps over the lazy dog"),
            (2, None), (3, ""), (4, " \t\n "), (None, "no id here"), (None, None), (5, long), (6, "42 !! 17"), (7, "é漢字😀 ñandú"),
            (8, "a" * 5_000), (9, long)]
