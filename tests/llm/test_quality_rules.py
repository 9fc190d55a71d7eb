import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from answerloom.llm import quality_rules as rules
from answerloom.llm.common import words
from tests.llm import cases


def slow_counts(text):
    text = text or ""
    w = cases.words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    under = set()
    for k in range(len(w) - 2):
        if windows[tuple(w[k : k + 3])] > 1:
            under |= {k, k + 1, k + 2}
    lines = [line for line in text.split("\n") if cases.words(line)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(under),
    )


ODD = ["a a a a", "a b c a b c", "a b c d a b", "x\n\nx\n x\nx \ny", "#*$%&|<>", "one two", "p q r " * 3000, "  a b", "é|é|é\r\né|é|é\r\n"]


def test_counts(spark):
    rows = [(r[0], r[1]) for r in cases.rows()] + list(enumerate(ODD, 100))
    got = rules.judge(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = Counter()
    for doc_id, text in rows:
        c = slow_counts(text)
        want[(doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got
    ) == want
    for r in got:
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_repeats_with_clashing_short_hashes(spark, monkeypatch):
    """With a single bit of hash left beside the position, nearly all windows clash and the whole hashes decide."""
    texts = [cases.prose(300, 5), "a b c d e " * 30, cases.prose(50, 6) * 2]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    short = F.transform
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.crc32(F.concat_ws(" ", *c)))  # all but the low bits are 0
    got = [r.n for r in df.select(rules.repeat_words(words(F.col("text"))).alias("n")).collect()]
    monkeypatch.undo()
    assert short is F.transform and got == [slow_counts(t)[4] for t in texts]


def test_estimates_recover_accuracies(spark):
    """Votes drawn from known accuracies; the estimate must come close to them and to the share of good documents."""
    prior, right = 0.7, [0.9, 0.75, 0.85, 0.8, 0.95]
    patterns = []
    for code in range(3**5):
        votes = [code // 3**j % 3 - 1 for j in range(5)]
        cast = [(v, a) for v, a in zip(votes, right) if v]
        share = 0.8 ** len(cast) * 0.2 ** (5 - len(cast))
        good = math.prod(a if v == 1 else 1 - a for v, a in cast)
        bad = math.prod(a if v == -1 else 1 - a for v, a in cast)
        patterns.append((votes, round(1e7 * share * (prior * good + (1 - prior) * bad))))
    df = spark.createDataFrame(patterns, "votes array<int>, n long")
    got_prior, got = rules.estimate(df, rules=5, rounds=60, pseudo_votes=0.0)
    assert got_prior == pytest.approx(prior, abs=0.02)
    assert got == pytest.approx(right, abs=0.02)


def plain_em(patterns, rules_, rounds, pseudo):
    prior, right = rules.START_GOOD, [rules.START] * rules_
    for _ in range(rounds):
        good = []
        for votes, n in patterns:
            odds = math.log(prior / (1 - prior)) + sum(v * math.log(a / (1 - a)) for v, a in zip(votes, right))
            good.append(1 / (1 + math.exp(-odds)))
        prior = sum(n * g for (_, n), g in zip(patterns, good)) / sum(n for _, n in patterns)
        prior = min(0.99, max(0.01, prior))
        for j in range(rules_):
            cast = sum(n for v, n in patterns if v[j])
            agree = sum(n * (g if v[j] > 0 else 1 - g) for (v, n), g in zip(patterns, good) if v[j])
            right[j] = min(0.99, max(0.01, (agree + pseudo * rules.START) / (cast + pseudo)))
    return prior, right


def test_estimates_tend_to_plain_em_as_votes_grow(spark):
    shapes = [([1, -1, 0], 3), ([1, 1, 1], 9), ([-1, -1, -1], 4), ([0, -1, -1], 2), ([1, 0, 1], 5), ([-1, 1, 0], 1)]
    apart = []
    for size in (1, 100, 10_000):
        patterns = [(v, n * size) for v, n in shapes]
        df = spark.createDataFrame(patterns, "votes array<int>, n long")
        got_prior, got = rules.estimate(df, rules=3)
        want_prior, want = plain_em(patterns, 3, rules.ROUNDS, rules.PSEUDO_VOTES)
        assert (got_prior, *got) == pytest.approx((want_prior, *want))
        apart.append(max(abs(a - b) for a, b in zip(got, plain_em(patterns, 3, rules.ROUNDS, 0.0)[1])))
    assert apart[0] > 0.01 > apart[2] and apart[2] < apart[1] < apart[0]


def test_verdict_against_plain_recomputation(spark):
    """Votes as judged; estimate, posterior and verdict from plain Python."""
    rows = [(k, ". ".join(cases.prose(12, 100 * k + j).capitalize() for j in range(20)) + ".") for k in range(40)]
    rows += [(100 + k, " ".join(x.upper() + "%%%" for x in cases.prose(150, k).split())) for k in range(12)]
    rows += [(200 + k, "buy now! " * (60 + k)) for k in range(9)] + [(300, None), (301, "few words")]
    got = rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    patterns = sorted(Counter(tuple(r.votes) for r in got).items())
    prior, right = plain_em(patterns, len(rules.RULES), rules.ROUNDS, rules.PSEUDO_VOTES)
    for r in got:
        odds = math.log(prior / (1 - prior)) + sum(v * math.log(a / (1 - a)) for v, a in zip(r.votes, right))
        assert r.posterior == pytest.approx(1 / (1 + math.exp(-odds)))
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert (r.base_failed, r.kept) == (failed, not failed and r.posterior >= 0.5)


def test_posterior_formula(spark):
    right = [0.9, 0.7]
    df = spark.createDataFrame([([1, -1],), ([0, 0],), ([-1, 1],)], "votes array<int>")
    got = [r.p for r in df.select(rules.posterior(0.6, right).alias("p")).collect()]
    odds = lambda a: 0.6 * a[0] / (0.6 * a[0] + 0.4 * a[1])
    assert got == pytest.approx([odds((0.9 * 0.3, 0.1 * 0.7)), 0.6, odds((0.1 * 0.7, 0.9 * 0.3))])


def test_junk_goes_and_prose_stays(spark):
    good = [(k, ". ".join(cases.prose(12, 100 * k + j).capitalize() for j in range(20)) + ".") for k in range(60)]
    bad = [(1000 + k, " ".join(x.upper() + "%%%" for x in cases.prose(150, k).split())) for k in range(15)]
    got = rules.judge(spark.createDataFrame(good + bad, "doc_id long, text string")).collect()
    assert all(r.kept == (r.doc_id < 1000) for r in got)


def test_empty(spark):
    assert rules.judge(cases.empty(spark)).collect() == []
