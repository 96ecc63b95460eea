import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup

SCHEMA = "doc_id long, text string, kept int, Digest string, keep string"


def rows():
    draw = random.Random(3)
    made = [(i, draw.choice(["a", "b", "c", "d", "", None, "A ", "x" * 50_000, f"only {i}"]), 1, "x", "y") for i in range(400)]
    made += [(i, "hot", 1, "x", "y") for i in range(400, 700)]
    return made + [(None, "a", 1, "x", "y"), (None, "lone", 2, "x", "y"), (699, "hot", 3, "x", "y"), (7, "twice", 1, "x", "y"), (7, "twice", 1, "x", "y")]


def expected(given):
    groups = {}
    for doc_id, text, *_ in given:
        groups.setdefault(text or "", []).append(doc_id)
    return groups


@pytest.mark.parametrize("bounds", [{}, {"capacity": 8, "share": 4, "least": 2}, {"capacity": 2000, "share": 1000, "least": 1}])
def test_groups_against_brute_force(spark, bounds):
    given = rows()
    docs = spark.createDataFrame(given, SCHEMA).repartition(5)
    got = exact_dedup.duplicate_groups(docs, **bounds).collect()
    groups = expected(given)
    assert len(got) == len(given)
    shas = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(shas.keys())
    for row in got:
        ids = groups[shas[row.text_sha256]]
        assert row.group_size == len(ids)
        assert row.keep_id == max((i for i in ids if i is not None), default=None)
        assert not row.kept or row.doc_id == row.keep_id


@pytest.mark.parametrize("bounds", [{}, {"capacity": 8, "share": 4, "least": 2}])
def test_dedup_keeps_one_row_and_all_columns(spark, bounds):
    given = rows()
    docs = spark.createDataFrame(given, SCHEMA).repartition(5)
    got = exact_dedup.dedup(docs, **bounds)
    assert got.columns == docs.columns
    want = {t: max((i for i in ids if i is not None), default=None) for t, ids in expected(given).items()}
    assert sorted((r.text or "", r.doc_id or -1) for r in got.collect()) == sorted((t, i or -1) for t, i in want.items())


def test_normalised_texts_and_empty_table(spark):
    docs = spark.createDataFrame([(1, " A", 1, "", ""), (2, "a ", 1, "", "")], SCHEMA)
    got = exact_dedup.duplicate_groups(docs, lambda text: F.lower(F.trim(text))).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(1, 2, False), (2, 2, True)}
    assert got[0].text_sha256 == hashlib.sha256(b"a").hexdigest()
    assert exact_dedup.duplicate_groups(docs.limit(0)).collect() == []
    assert exact_dedup.dedup(docs.limit(0)).collect() == []


def test_summaries_are_short_by_a_bounded_count():
    draw = random.Random(5)
    values = [min(int(draw.expovariate(0.2)), 60) for _ in range(5000)]
    total = Counter()
    for at in range(0, 5000, 500):
        total = exact_dedup.misra_gries(total + Counter(values[at : at + 500]), 20)
    true = Counter(values)
    assert len(total) <= 20
    assert all(true[v] - 5000 / 21 <= total[v] <= true[v] for v in true)
