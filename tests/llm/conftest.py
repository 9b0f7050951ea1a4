import pytest
from pyspark.sql import Row

#: Documents with the awkward cases every operator must take.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n \x0b"),
    (4, "one"),
    (5, "One two three four five six seven eight nine ten"),
    (6, "One two three four five six seven eight nine ten"),
    (6, "One two three four five six seven eight nine ten"),
    (None, "no id here, yet some words to read"),
    (7, "Don't <|endoftext|> x<|startoftext|>y 12.5 É,È ﬁne\x1cz  a\n\nb \n c "),
    (8, "long " * 9000 + "tail."),
    (9, "wordwithoutanyblank" * 700),
]


#: Names of columns that operators return or use inside.
CLASHING = (
    "length", "piece", "n_tokens", "rank_", "words_", "start", "offset", "sequence_id", "part_", "n_", "first_", "ids_crc32", "ids",
    "n_words", "n_removed", "shard", "salt", "to", "phrase", "gram", "stretch", "owner", "source_", "kept_sha256", "carried_0", "carried_text",
    "lang_pred", "score", "bits_per_symbol", "n_symbols", "place", "bound", "n", "own_id", "own_text", "severity", "p_toxic", "toxic", "grade",
    "n_shingles", "component_id", "kept", "kept_id", "kept_mark", "key", "root", "mark", "train", "base_score", "n_known", "word_chars",
    "n_bytes", "over_limit", "runs", "a.b", "column_5", "text_digest",
)


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward documents, with extra columns whose names operators use themselves."""
    rows = [Row(doc_id=i, text=t, lang=None if k % 3 else "en", source="s", n_chars=0, **dict.fromkeys(CLASHING, 7)) for k, (i, t) in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHING))


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
