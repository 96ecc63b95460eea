import random
import re

import pytest

from millrace.llm import components, near_dedup
from millrace.llm.common import saved

SCHEMA = "doc_id long, text string, kept int, CID long, sketch string"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(given):
    sets, parent = [shingle_set(r[1]) for r in given], list(range(len(given)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, one in enumerate(sets):
        for j in range(i):
            both = len(one & sets[j])
            if one and sets[j] and 100 * both >= 85 * (len(one) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, row in enumerate(given):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return [(r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(given, sets))]


def rows(seed):
    """Copies with some words changed, in groups from two to many, texts with a passage in common, and odd ones."""
    draw = random.Random(seed)
    text = lambda n: [f"w{draw.randrange(5000)}" for _ in range(n)]
    made, passage = [], text(40)
    for size in (2, 3, 5, 60):
        base = text(80)
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randrange(4)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(99)}"
            made.append(" ".join(copy).title() if draw.random() < 0.2 else " ".join(copy))
    made += [" ".join(text(20) + passage + text(20)) for _ in range(40)]
    made += [" ".join(passage)] * 30 + ["", None, " \n\t", "one", "ONE", "a b c d", "a b c d e", "é\x85x y", " ".join(text(30_000))]
    draw.shuffle(made)
    given = [(1000 - i, t, 1, i, "") for i, t in enumerate(made)]
    return given + [(None, "one", 1, 1, ""), (None, "alone here", 1, 1, ""), given[0], given[0], (given[1][0], "other text", 1, 1, "")]


@pytest.mark.parametrize("leaf", [near_dedup.LEAF, 6])
def test_components_against_brute_force(spark, leaf):
    given = rows(leaf)
    got = near_dedup.near_duplicates(spark.createDataFrame(given, SCHEMA).repartition(4), leaf).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(map(key, brute(given)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_are_found_again_where_all_rows_share_a_doc_id(spark, doc_id):
    given = [(doc_id, r[1], 1, 1, "") for r in rows(3)]
    docs = spark.createDataFrame(given, SCHEMA).repartition(4)
    got = near_dedup.near_duplicates(docs).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(map(key, brute(given)))
    join = near_dedup.Join(docs)
    found = near_dedup._sets(docs, join.classes.select("cid", "set_key", "min_id", "min_key"))
    texts = {r[1]: len(shingle_set(r[1])) > 0 for r in given}
    assert found.select("cid").distinct().count() == join.classes.count()
    assert found.count() <= sum(texts[r[1]] for r in given)


def test_dedup_keeps_columns_and_an_empty_table(spark):
    docs = spark.createDataFrame([(2, "a b c d e f", 1, 1, "s"), (1, "A b c d e f", 2, 2, "t"), (3, None, 1, 1, "")], SCHEMA)
    got = near_dedup.dedup(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.kept) for r in got.collect()) == [(1, 2), (3, 1)]
    assert near_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_another_threshold_against_brute_force(spark):
    """Pairs with two words changed, far apart, on both sides of 0.80 and of 0.85, through nodes that branch."""
    draw = random.Random(80)
    given, want = [], set()
    for n in range(80, 140):
        base = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        copy = list(base)
        copy[n // 3], copy[2 * n // 3] = "changed", "again"
        given += [(2 * n, " ".join(base), 1, 1, ""), (2 * n + 1, " ".join(copy), 1, 1, "")]
    sets = [(r[0], shingle_set(r[1])) for r in given]
    for i, (a, one) in enumerate(sets):
        want |= {(a, b) for b, two in sets[i + 1 :] if 100 * len(one & two) >= 80 * len(one | two)}
    got = near_dedup.near_duplicates(spark.createDataFrame(given, SCHEMA).repartition(4), 12, 80).collect()
    assert {(r.component_id, r.doc_id) for r in got if not r.kept} == want
    assert any(100 * len(dict(sets)[a] & dict(sets)[b]) < 85 * len(dict(sets)[a] | dict(sets)[b]) for a, b in want)


def test_recall_follows_from_the_threshold():
    for percent, roots, possible in ((85, 12, 66), (80, 15, 59)):
        law = near_dedup.Law(percent)
        missed = (1 - percent / 100) / (near_dedup.SHARED - percent / 100)
        assert (law.roots, law.possible) == (roots, possible) and missed**law.roots <= near_dedup.MISSED
    with pytest.raises(ValueError):
        near_dedup.Law(50)


def test_few_links_stay_together(spark, monkeypatch):
    """Components are the same whether links are kept in one partition or dealt out in each step."""
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(70, 60), (60, 65), (90, 90)], "a long, b long").repartition(3)
    want = {i: 0 for i in range(41)} | {60: 60, 65: 60, 70: 60}
    for few, parts in ((components.FEW, 1), (0, None)):
        monkeypatch.setattr(components, "FEW", few)
        written = []
        monkeypatch.setattr(components, "saved", lambda df: written.append(df.rdd.getNumPartitions()) or saved(df))
        assert {r.member: r.root for r in components.components(links).collect()} == want
        assert parts is None or set(written[1:-1]) == {parts}
