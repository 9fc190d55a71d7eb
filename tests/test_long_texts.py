"""Whole texts are processed, however long and odd, in time that grows with them."""

import time

from pyspark.sql import functions as F

from answerloom.functions.columns import last_line
from answerloom.functions.extraction import last_box, robust_answer, simple_answer, simple_box
from answerloom.functions.normalization import bare_form, is_number, simple_form, text_form

N = 100_000
TEXTS = {
    "open boxes": "\\boxed{" * N,
    "early box": "\\boxed{5} " + "word " * N,
    "early open box": "\\boxed{5 " + "word " * N,
    "deep box": "\\boxed{" + "{" * N + "}" * N + "}",
    "closers": "\\boxed{1}" + "}" * N,
    "answers": "answer: 1\n" * N,
    "answers without marker": "answer " * N,
    "answers with gaps": ("answer" + " " * 200) * (N // 200),
    "hashes": "#" * N,
    "empty hash lines": "####\n" * N,
    "blank lines": "x" + " \n" * N,
    "spaces": " " * N,
    "one line": "x y " * N,
    "open wrappers": "\\text{" * N,
    "closed wrappers": "\\text{" * N + "}" * N,
}
FUNCTIONS = (simple_box, simple_answer, last_box, robust_answer, last_line,
             simple_form, bare_form, text_form, is_number)


def test_long_texts(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "name STRING, t STRING").repartition(4).cache()
    df.count()
    start = time.monotonic()
    rows = df.select("name", *[f(F.col("t")).alias(f.__name__) for f in FUNCTIONS]).collect()
    elapsed = time.monotonic() - start
    got = {row.name: row for row in rows}
    assert got["open boxes"].simple_box is None and got["open boxes"].last_box is None
    assert got["open boxes"].robust_answer == TEXTS["open boxes"]
    assert got["early box"].robust_answer == got["early box"].simple_answer == "5"
    assert got["early open box"].last_box is None
    assert got["deep box"].last_box == "{" * N + "}" * N
    assert got["closers"].last_box == "1"
    assert got["answers"].robust_answer == "1"
    assert got["answers without marker"].robust_answer == TEXTS["answers without marker"].strip()
    assert got["hashes"].simple_answer == "#" * (N - 4)
    assert got["blank lines"].last_line == "x" and got["spaces"].last_line == ""
    assert got["spaces"].robust_answer == ""
    assert got["one line"].bare_form == "xy" * N
    assert got["open wrappers"].bare_form == TEXTS["open wrappers"]
    # Quadratic work on any of these would take minutes to hours.
    assert elapsed < 60
