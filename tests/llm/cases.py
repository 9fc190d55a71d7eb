"""Small tables with everything that may be odd about documents."""

import random

PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank".split()


def prose(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(PROSE) + str(pick.randrange(40)) for _ in range(n))


SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, fp long, score double, "
    "leaks string, taken int, features string, votes string, target string, slot int, law string, rank int, bucket int"
)
EXTRA = (7, 7, 7, 0.5, "mine", 7, "mine", "mine", "mine", 7, "mine", 7, 7)


def rows():
    long_text = prose(30_000, 1)
    texts = [
        (1, prose(120, 2), "a"),
        (2, prose(120, 2), "a"),  # exact copy
        (3, prose(120, 2) + " one more word", "b"),  # near copy
        (4, "", "b"),
        (5, None, None),
        (6, " \t\n ", "a"),
        (None, prose(80, 3), "c"),
        (None, None, None),
        (7, long_text, "a"),
        (8, long_text, "c"),
        (9, "naïve café — 東京 \U0001f600 " * 30, "é"),
        (10, "one", "b"),
        (10, "one", "b"),  # repeated row
        (11, "A! " * 200, None),
        (12, prose(60, 4) + "\n" + prose(60, 4), "b"),
    ]
    return [(i, t, "en", s, None, *EXTRA) for i, t, s in texts]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    """Runs of anything but the six ASCII white space characters."""
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
