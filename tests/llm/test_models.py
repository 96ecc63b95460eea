import collections
import math
import random
import re

import numpy as np
import pytest

from millrace.llm import quality, toxicity

WORDS = "the of and to in that it was for with river stone light table garden window bread winter music forest".split()
BAD = "vile rotten".split()
DOCS = "doc_id long, text string, lang string, p_toxic string, severity int"


def corpus(n, seed):
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [draw.choice(WORDS) + draw.choice(["", "s", "er"]) for _ in range(draw.randrange(5, 80))]
        grade = i % 3 == 0
        for _ in range(draw.choice([1, 3, 6]) if grade else 0):
            words.insert(draw.randrange(len(words)), draw.choice(BAD) + draw.choice(["", "ly", "ness"]))
        rows.append((i, " ".join(words), "en", "", 0))
        labels.append((i, int(grade)))
    return rows, labels


def test_toxicity_on_held_out_documents(spark):
    rows, labels = corpus(900, 1)
    docs = spark.createDataFrame(rows + [(5000, None, "en", "", 0), (5001, "", "en", "", 0), (5002, "x" * 200_000, "en", "", 0)], DOCS)
    shown = [r for r in labels if r[0] < 500] + [(None, 1), (3, None), (0, 0), (5000, 0)]
    model = toxicity.fit(docs, spark.createDataFrame(shown, "doc_id long, grade int"))
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert all(got[i].kept == (not grade) for i, grade in labels if i >= 500)
    assert all(got[i].kept for i in (5000, 5001, 5002))
    mild, severe = ([got[i].severity for i, t, *_ in rows if sum(w[:3] in ("vil", "rot") for w in t.split()) == k] for k in (1, 6))
    assert np.mean(severe) > np.mean(mild) + 0.5
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)


def test_the_fit_is_that_of_a_plain_optimiser():
    """Grades drawn from the model itself; the likelihood written out, its slopes by differences, small steps downhill."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(120, 3))
    chance = 1 / (1 + np.exp(np.array([0.0, 1.0, 2.5]) - (x @ [1.5, -1.0, 0.5])[:, None]))
    y = (draw.random(120)[:, None] < chance).sum(1)
    rows = [(int(g), [0, 1, 2], list(r)) for g, r in zip(y, x)]
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y == 0).sum())

    def loss(p):
        edges = np.cumsum([p[3], np.exp(p[4]), np.exp(p[5])])
        at_least = np.column_stack([np.ones(120), 1 / (1 + np.exp(edges - (x @ p[:3])[:, None])), np.zeros(120)])
        each = at_least[np.arange(120), y] - at_least[np.arange(120), y + 1]
        return -(weight * np.log(each)).sum() + 0.03 * (p[:3] ** 2).sum() / 6

    def slopes(p):
        return np.array([(loss(p + step) - loss(p - step)) / 2e-6 for step in 1e-6 * np.eye(6)])

    plain = np.array([0.0, 0.0, 0.0, 0.5, 0.0, 0.0])
    for _ in range(4000):
        plain = plain - 0.5 * slopes(plain)
    w, b = toxicity._fit_matrix(rows, 3, 3, penalty=0.03)
    own = np.concatenate([w, b[:1], np.log(np.diff(b))])
    assert abs(loss(own) - loss(plain)) < 1e-5 and np.allclose(own, plain, atol=0.02)
    value, by_total, by_first, by_gap = toxicity._loss_and_slopes(x @ own[:3], y, weight, own[3], own[4:])
    assert math.isclose(value + 0.03 * (w**2).sum() / 6, loss(own), rel_tol=1e-9)
    assert np.allclose([*(by_total @ x + 0.03 * w / 3), by_first, *by_gap], slopes(own), atol=1e-6)


def test_long_words_are_read_whole(spark):
    """Words that differ beyond their first hundred letters only."""
    rows = [(i, f"of the river {i} {'z' * 100}{'q' if i % 2 else 'k'}", "en", "", 0) for i in range(80)]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, grade int"))
    assert {r.doc_id for r in toxicity.scored(docs, model).collect() if not r.kept} == set(range(1, 80, 2))


def test_toxicity_with_given_grades_and_without_examples(spark):
    rows, labels = corpus(300, 2)
    docs = spark.createDataFrame(rows, DOCS)
    grades = [(i, g and min(3, 1 + sum(w[:3] in ("vil", "rot") for w in rows[i][1].split()) // 3)) for i, g in labels]
    model = toxicity.fit(docs, spark.createDataFrame(grades, "doc_id long, grade int"))
    assert len(model.thresholds) == 3 and list(model.thresholds) == sorted(model.thresholds)
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, grade int"))
    assert {(r.severity, r.kept) for r in toxicity.scored(docs, none).collect()} == {(0.0, True)}
    assert toxicity.scored(docs.limit(0), model).collect() == []


def kneser_ney(texts, order):
    """Losses of n-grams by a plain model."""
    raw = collections.Counter(int(g) for t in texts if t for g in quality._grams(t.encode(), order))
    counts = {order: raw}
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g & ((1 << 8 * k) - 1) for g in counts[k + 1])

    def off(k):
        n = [sum(v == c for v in counts[k].values()) for c in (1, 2, 3, 4)]
        if not all(n):
            d = (0.5, 0.75, 0.9)
        else:
            y = n[0] / (n[0] + 2 * n[1])
            d = tuple(min(max(c - (c + 1) * y * n[c] / n[c - 1], 0.01), c) for c in (1, 2, 3))
        return lambda c: d[min(c, 3) - 1]

    offs = {k: off(k) for k in counts}

    def p(gram, k):
        if k == 0:
            return 1 / 256
        own = gram & ((1 << 8 * k) - 1)
        same = [c for g, c in counts[k].items() if g >> 8 == own >> 8]
        lower = p(gram, k - 1)
        if not same:
            return lower
        taken = sum(map(offs[k], same))
        c = counts[k].get(own, 0)
        return (max(c - offs[k](c), 0) if c else 0) / sum(same) + taken / sum(same) * lower

    return lambda gram: -math.log(p(gram, order))


@pytest.mark.parametrize("broadcast_grams", [quality.BROADCAST_GRAMS, 0])
def test_perplexity_against_a_plain_model(spark, broadcast_grams):
    draw = random.Random(4)
    texts = ["".join(draw.choice("abcé ") for _ in range(draw.randrange(1, 40))) for _ in range(40)]
    rows = [(i, t, "en", "", 0) for i, t in enumerate(texts)] + [(90, None, "en", "", 0), (91, "", None, "", 0), (7, texts[7], "en", "", 0)]
    labels = [(i, int(i % 2 == 0)) for i in range(40)] + [(4, 0), (None, 1), (6, None)]
    trusted = [i for i in range(0, 40, 2) if i != 4]
    loss = kneser_ney([texts[i] for i in trusted], 3)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    given = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.perplexities(docs, given, order=3, broadcast_grams=broadcast_grams).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id >= 90:
            assert r.perplexity is None
            continue
        grams = quality._grams(texts[r.doc_id].encode(), 3)
        assert math.isclose(r.perplexity, math.exp(sum(map(loss, map(int, grams))) / len(grams)), rel_tol=1e-4)


def test_packed_losses_come_back(spark):
    draw = random.Random(3)
    known = {draw.randrange(1 << 40): -math.log(draw.random()) for _ in range(5000)}
    scores = spark.createDataFrame([*known.items()], "gram long, loss double").repartition(7, "gram")
    for table in (scores, scores.limit(1), scores.limit(0)):
        want = {r.gram: np.float32(r.loss) for r in table.collect()}
        grams, losses = quality._unpacked(quality._packed(table))
        assert len(grams) == len(want) and dict(zip(grams.tolist(), losses)) == want


def test_the_order_of_words_shows(spark):
    """Sentences of a grammar, and the same words shuffled or repeated."""
    draw = random.Random(11)

    def sentence():
        return f"{draw.choice(['The', 'A'])} {draw.choice(WORDS)} {draw.choice(['is', 'was'])} {draw.choice(['in', 'on'])} the {draw.choice(WORDS)}."

    def mixed_up(text):
        words = re.findall(r"\w+|[^\w\s]", text)
        draw.shuffle(words)
        return " ".join(words)

    good = [" ".join(sentence() for _ in range(12)) for _ in range(400)]
    bad = [mixed_up(t) for t in good[300:]] + [" ".join([w] * 60) for w in WORDS]
    docs = spark.createDataFrame([(i, t, "en", "", 0) for i, t in enumerate([*good, *bad])], DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.judged(docs, labels).collect() if r.kept}
    assert len(kept & set(range(300, 400))) >= 90  # SHARE loses one in twenty
    assert len(kept & set(range(400, 400 + len(bad)))) <= 5


def test_thresholds_by_language_and_empty_tables(spark):
    rows, _ = corpus(200, 5)
    docs = spark.createDataFrame(
        [(i, t, "en" if i % 2 else "fr", "", 0) for i, t, *_ in rows] + [(500, "ZQX#%!! " * 30, None, "", 0), (501, None, "en", "", 0)], DOCS
    )
    labels = spark.createDataFrame([(i, 1) for i in range(150)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judged(docs, labels, share=1.0).collect()}
    assert all(got[i].kept for i in range(150)) and got[501].kept and not got[500].kept
    assert len({r.threshold for r in got.values()}) == 2
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept for r in quality.judged(docs, none).collect())
    assert quality.judged(docs.limit(0), labels).collect() == []


def test_the_quantile_drops_bad_text_that_was_not_seen(spark):
    """A few trusted documents are noise, as labels have it; texts that are noise for the most part must go all the same."""
    draw = random.Random(9)
    noise = lambda: [("".join(draw.choice("bcdfghjkqvwxz0123456789#%") for _ in range(6))) for _ in range(60)]
    good = [(i, " ".join(draw.choice(WORDS) for _ in range(60)), "en", "", 0) for i in range(600)]
    noisy = [noise() for _ in range(5)]
    bad = [(2000 + i, " ".join(noisy[i % 5][i // 5 : i // 5 + 40] + [draw.choice(WORDS) for _ in range(15)]), "en", "", 0) for i in range(60)]
    labels = [(i, 1) for i in [*range(400), *range(1000, 1005)]]
    docs = spark.createDataFrame(good + [(1000 + i, " ".join(w), "en", "", 0) for i, w in enumerate(noisy)] + bad, DOCS)
    given = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality.judged(docs, given).collect()}
    assert sum(got[r[0]] for r in bad) <= 3
    assert sum(not got[r[0]] for r in good[400:]) <= 20
