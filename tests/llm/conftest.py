import pytest

SMALL = "/root/testdata/sf0.001"

# Names that the operators use inside, to clash with.
EXTRA = ["size", "row", "kept", "text_a", "_hash", "component", "stratum", "node", "tie", "n_words", "key", "copies"]


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="session")
def given(spark):
    """(doc_id, text) of the smallest documents table."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="session")
def odd_rows(given):
    """Nulls, empty and long texts, ties and repeated rows, beside ordinary ones."""
    base = [t for _, t in given[:6]]
    long_text = "\n".join(" ".join(f"w{(i * 7 + j) % 501}" for j in range(40)) for i in range(900))
    return [
        (1000, None), (1001, ""), (1002, " \t\n\x0b\x0c\r "), (1003, "one"), (1004, "One"), (1005, "two words"),
        (1006, base[0]), (1006, base[0]), (1007, base[0]), (1008, base[1]), (1009, base[1] + " tail"),
        (1010, long_text), (1011, long_text), (1012, "x" * 150_000), (1013, "1" * 50_000), (1014, "é ß " * 40),
        (1015, "\n\n\n"), (1016, base[2].replace(" ", "  ")), (1017, "a\nb\na\nb\na\nb"), (1018, base[3].upper()),
    ]


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) with clashing extra columns."""

    def make(rows):
        full = [
            (i, t, None if n % 5 == 4 else ("en", "fr")[n % 2], None if n % 4 == 3 else f"s{n % 3}", None, *["x"] * len(EXTRA))
            for n, (i, t) in enumerate(rows)
        ]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, schema + "".join(f", `{c}` string" for c in EXTRA))

    return make


def by_id(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)
