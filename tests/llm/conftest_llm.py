"""Rows that the tests of this folder share."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LABELS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()),
    ]
)
VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
)
#: Names that operators use inside or return.
CLASHING = (
    "kept n_words ids n_tokens score size target taken fp component_id key n part copies line "
    "h1 h2 site chunk bucket content __x a.b __ll_kept __ll_id __ll_fp __ll_c5 q`r part vector"
).split()

WORDS = "the of and to in a is that for it as was with be by on not he his but at are".split()


def prose(seed: int, n: int) -> str:
    import random

    rnd = random.Random(seed)
    made = [rnd.choice(WORDS) if rnd.random() < 0.4 else f"w{rnd.randrange(3000)}" for _ in range(n)]
    return " ".join(made)


def awkward_rows() -> list[tuple]:
    """Nulls in any column, empty, blank and very long texts, ties and repeated rows."""
    long_text = prose(1, 30_000)
    return [
        (0, "", "en", "a", 0),
        (1, None, "en", "a", None),
        (2, " \t\n \r\n", None, "b", 5),
        (3, long_text, "en", None, 9),
        (4, "x" * 50_000, "en", "a", 9),
        (5, "the end of the line", "en", "a", 9),
        (5, "the end of the line", "en", "a", 9),
        (6, "the end of the line", "de", "b", 9),
        (7, prose(2, 300), "en", "b", 9),
        (8, prose(2, 300) + " tail", None, "c", 9),
        (9, "été ß 漢字 😀 <|endoftext|> 　 a  b", "en", "c", 9),
        (None, "no id here", "en", "a", 9),
        (None, None, None, None, None),
        (10, "one\n\none\n two \none", "en", "", 9),
        (11, prose(3, 40), "en", "a", 9),
        (-12, prose(3, 40), "en", "c", 9),
    ]
