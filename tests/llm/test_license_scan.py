import random
import re

from answerloom.llm import license_scan
from tests.llm import cases


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def found(spark, texts, templates=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    known = templates or license_scan.default_templates(spark)
    return license_scan.scan(docs, known).collect()


def test_every_template_is_found_in_long_texts(spark):
    pick = random.Random(2)
    texts, want = [], {}
    for k in range(len(license_scan.TEMPLATES)):
        name, text = license_scan.TEMPLATES[k % len(license_scan.TEMPLATES)]
        texts.append(cases.prose(pick.randrange(400), k) + "\n" + text + "\n" + cases.prose(pick.randrange(400), k + 99))
        want[k] = name
    got = found(spark, texts)
    assert {(r.doc_id, r.license_id) for r in got if r.containment == 1.0} >= set(want.items())
    for r in got:  # nothing is reported that the text does not hold
        template = shingles(dict(license_scan.TEMPLATES)[r.license_id])
        if len(next(iter(template))) < 5:
            assert r.containment == 1.0
            continue
        assert len(template & shingles(texts[r.doc_id])) / len(template) >= r.containment >= 0.8


def test_against_all_documents_and_templates(spark):
    """Every document with every template: exact containment near each place decides."""
    pick = random.Random(7)
    texts = []
    for k in range(80):
        name, text = license_scan.TEMPLATES[pick.randrange(len(license_scan.TEMPLATES))]
        words = text.split()
        for _ in range(pick.randrange(3)):
            words[pick.randrange(len(words))] = "other"
        texts.append(" ".join([cases.prose(pick.randrange(120), k), *words, cases.prose(pick.randrange(120), k + 500)]))
    want = set()
    for k, text in enumerate(texts):
        w = re.findall(r"[^\W_]+", text.lower())
        for name, template in license_scan.TEMPLATES:
            t = re.findall(r"[^\W_]+", template.lower())
            if len(t) < 5:
                if any(w[i : i + len(t)] == t for i in range(len(w))):
                    want.add((k, name, 1.0))
                continue
            # Edits replace words, so a copy has the template's length: its best place decides.
            best = max(
                (len(shingles(template) & {tuple(w[i + j : i + j + 5]) for j in range(len(t) - 4)}) for i in range(len(w) - len(t) + 1)), default=0
            ) / len(shingles(template))
            if best >= 0.8:
                want.add((k, name, round(best, 9)))
    got = {(r.doc_id, r.license_id, round(r.containment, 9)) for r in found(spark, texts)}
    assert {x[:2] for x in want} <= {x[:2] for x in got}
    exact = {x[:2]: x[2] for x in want}
    for doc, name, share in got:  # a wider look than the best place can only find more shingles
        assert share >= exact.get((doc, name), 0.8)
        template = shingles(dict(license_scan.TEMPLATES)[name])
        whole = 1.0 if len(next(iter(template))) < 5 else len(template & shingles(texts[doc])) / len(template)
        assert share <= round(whole, 9)


def test_lines_of_many_licenses(spark):
    lines = [
        "This library is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: MIT",
        "Licensed under the Mozilla Public License, version 2.0.", "This is free and unencumbered software released into the public domain.",
        "Licensed under CC BY-SA 4.0.", "// SPDX-License-Identifier: GPL-2.0-or-later",
    ]
    got = {(r.doc_id, r.license_id) for r in found(spark, [f"{cases.prose(40, k)}\n{x}\n{cases.prose(40, k)}" for k, x in enumerate(lines)])}
    names = ["lgpl-3.0-notice", "spdx-MIT", "mpl-2.0-notice", "unlicense-notice", "cc-by-sa-4.0-notice", "spdx-GPL-2.0-or-later"]
    assert set(enumerate(names)) <= got
    assert len({n for n, _ in license_scan.TEMPLATES}) == len(license_scan.TEMPLATES) >= 80


def test_changed_words_lower_the_containment(spark):
    words = [f"w{k}" for k in range(200)]
    template = spark.createDataFrame([("long", " ".join(words))], "license_id string, text string")
    for changed, expected in (([], 1.0), ([50], 191 / 196), ([20, 60, 100, 140], 176 / 196), (list(range(0, 200, 12)), None)):
        copy = [("changed" if k in changed else w) for k, w in enumerate(words)]
        got = found(spark, [cases.prose(333, 1) + " " + " ".join(copy) + " " + cases.prose(100, 2)], template)
        assert [round(r.containment, 9) for r in got] == ([] if expected is None else [round(expected, 9)])


def test_collision_probability_of_the_bands(spark):
    assert license_scan.collision_probability() > 0.99


def test_case_signs_and_odd_texts(spark):
    got = found(spark, ["RELEASED -- under the 'MIT' license!", "released under the", "", None, "?!", "Released under the MIT Licence."])
    assert [(r.doc_id, r.license_id, r.start) for r in got] == [(0, "mit-notice", 0)]
    odd = spark.createDataFrame([("none", None), ("blank", " . "), ("tiny", "free text")], "license_id string, text string")
    # A template shorter than a shingle is held wherever its words stand side by side.
    short = found(spark, ["Free text.", "free text and more", None, "some free, text " * 3 + "with more", "free of text", "text free"], odd)
    assert sorted((r.doc_id, r.license_id, r.start, r.n_places) for r in short) == [(0, "tiny", 0, 1), (1, "tiny", 0, 1), (3, "tiny", 1, 3)]


def test_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "Released under the MIT License.", "x", 1), (1, "Released under the MIT License.", "x", 1), (None, "Released under the MIT License.", "x", 1)],
        "doc_id long, text string, license_id string, template int",
    )
    got = license_scan.scan(docs, license_scan.default_templates(spark)).collect()
    assert sorted((r.doc_id is None, r.license_id, r.n_places) for r in got) == [
        (False, "mit-notice", 1), (False, "mit-notice", 1), (True, "mit-notice", 1)
    ]
    assert license_scan.scan(cases.empty(spark), license_scan.default_templates(spark)).collect() == []
