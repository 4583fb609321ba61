import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()

#: Texts that every operator must bear: missing, empty, blank, one word, ties, odd characters, and a very long one.
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "\x00 null \x00",
    "Ünïcode ½ 漢字 🙂🙂 \u0085 x",
    "same same same " * 20,
    "same same same " * 20,
    "x" * 30_000,
    "lorem ipsum dolor " * 8_000,
    "it's we'll they've I'd   <|endoftext|> 'S 123  \n\n end",
]

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def documents_from(spark):
    """Documents from texts; ids count up, and clashing extra columns ride along."""

    def build(texts, first=0, **columns):
        rows = [
            (first + i, text, columns.get("lang", "en"), columns.get("source", "s"), len(text or ""))
            for i, text in enumerate(texts)
        ]
        frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
        for name in ("kept", "distance", "score", "lang_pred", "ids", "decoded", "n_replaced", "shard", "bucket", "n"):
            frame = frame.selectExpr("*", f"'clash' AS `{name}`")
        return frame

    return build


def rows_of(frame, *columns):
    return sorted(tuple(row[c] for c in columns or frame.columns) for row in frame.collect())


def passage(start, size):
    """A run of words that another start does not share."""
    return " ".join(f"{WORDS[(start * 7 + i * (start + 3)) % 20]}{start}x{i}" for i in range(size))
