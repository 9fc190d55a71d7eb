import random

from answerloom.llm import decontaminate
from tests.llm import cases


def slow_tile(test, doc, least):
    """Longest common unmarked run, again and again."""
    least = min(least, len(test))
    free_t, free_d, tiles = [True] * len(test), [True] * len(doc), []
    while least:
        best = None
        for t in range(len(test)):
            for d in range(len(doc)):
                k = 0
                while t + k < len(test) and d + k < len(doc) and test[t + k] == doc[d + k] and free_t[t + k] and free_d[d + k]:
                    k += 1
                if k >= least and (best is None or (-k, t, d) < best):
                    best = (-k, t, d)
        if best is None:
            break
        k, t, d = -best[0], best[1], best[2]
        free_t[t : t + k] = [False] * k
        free_d[d : d + k] = [False] * k
        tiles.append((t, d, k))
    return tiles


def test_tiles_cover_what_the_plain_tiling_covers():
    pick = random.Random(11)
    for _ in range(300):
        test = [pick.randrange(1, 5) for _ in range(pick.randrange(1, 25))]
        doc = [pick.randrange(1, 5) for _ in range(pick.randrange(0, 40))]
        for least in (1, 2, 3):
            got, want = decontaminate.tile(test, doc, least), slow_tile(test, doc, least)
            assert sorted(k for *_, k in got) == sorted(k for *_, k in want)
            for t, d, k in got:
                assert test[t : t + k] == doc[d : d + k]


TESTS = [
    (1, "What is the capital of the small island where seven wise owls watch over an old harbour at night?"),
    (2, "Count the red apples."),
    (3, None),
    (4, "?!"),
    (1, "What is the capital of the small island where seven wise owls watch over an old harbour at night?"),
]


def leaks_of(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame(TESTS, "item_id long, text string")
    return decontaminate.leak_rows(docs, tests, **options).collect()


def test_copied_reordered_partial_and_clean(spark):
    whole = TESTS[0][1]
    filler = cases.prose(40, 1)
    reordered = "at night? seven wise owls watch over an old harbour " + filler + " What is the capital of the small island where"
    got = leaks_of(spark, [
        filler, f"{filler} {whole.upper()} {filler}", reordered, f"{filler} seven wise owls watch over an {filler}",
        "he said: COUNT the red apples, twice", None, "", "Count the apples red",
    ])
    found = {(r.doc_id, r.item_id) for r in got}
    assert found == {(1, 1), (2, 1), (4, 2)}
    assert len(got) == 5  # a test given twice is reported twice
    best = {r.doc_id: r for r in got}
    assert best[1].coverage == 1.0 and best[1].n_tiles == 1 and best[2].n_tiles == 2


def test_blocks_of_tests_give_the_same(spark, monkeypatch):
    texts = [f"{cases.prose(20, k)} {TESTS[k % 2][1]} {cases.prose(20, k + 50)}" for k in range(6)]
    want = sorted(map(tuple, leaks_of(spark, texts)))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 8)
    assert sorted(map(tuple, leaks_of(spark, texts))) == want and len(want) == 9


def test_tests_in_other_scripts_are_cut_into_blocks(spark, monkeypatch):
    """Each block is written before the next one is searched, and words count in every script."""
    letters = "абвгдежзиклмнопрст"
    pick = random.Random(3)
    items = [(k, " ".join("".join(pick.choice(letters) for _ in range(6)) for _ in range(12))) for k in range(20)]
    docs = spark.createDataFrame([(k, f"{cases.prose(9, k)} {t.upper()} конец") for k, t in items], "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    passes = []
    plain = decontaminate.land
    monkeypatch.setattr(decontaminate, "land", lambda df, name: passes.append(name) or plain(df, name))
    got = decontaminate.leaks(docs, tests, block_words=60).collect()
    assert len(passes) == 3  # 240 words in blocks of 60: four passes, three of them written on the way
    assert sorted((r.doc_id, [x.item_id for x in r.leaks]) for r in got) == [(k, [k]) for k in range(20)]


def test_keep_clean(spark):
    docs = cases.documents(spark)
    tests = spark.createDataFrame([(1, cases.prose(120, 2)[:300])], "item_id long, text string")
    kept = decontaminate.keep_clean(docs, tests)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(cases.rows()) - 3 and not {1, 2, 3} & set(ids)
    assert {r.leaks for r in kept.collect()} == {"mine"}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.keep_clean(docs, none).count() == len(cases.rows())
    assert decontaminate.leak_rows(cases.empty(spark), tests).collect() == []
