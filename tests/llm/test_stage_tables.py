"""What the filtering stages make of odd tables: shared and null doc_ids, equal rows, clashing names, no rows."""

import pytest
from pyspark.sql import types as T

import corpus_pipeline
from millrace.llm import chat, decontamination, exact_dedup, near_dedup, toxicity

WORDS = "the of and to in that it was for with river stone light table garden window bread winter music forest".split()


def text(n, k=24):
    return " ".join(WORDS[(n * 7 + i * (n + 1)) % len(WORDS)] + str((n + i) % 5) for i in range(k))


NAMES = ["doc_id", "text", "Text", "TEXT", "__digest", "__rank", "__key", "_0", "key", "Doc_Id", "kept", "root"]


def odd(spark, rows):
    """Rows (doc_id, text) with columns whose names clash with each other and with what operators add."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), *(T.StructField(name, T.StringType()) for name in NAMES[1:])]
    )
    return spark.createDataFrame([(i, t, *(f"{name}{n}" for name in NAMES[2:])) for n, (i, t) in enumerate(rows)], schema)


def told(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=repr)


def places(df):
    return sorted(int(r[2].removeprefix("Text")) for r in told(df))


ROWS = [
    (7, text(1)), (7, text(1)), (3, text(2)), (5, text(2)), (5, text(3)), (None, text(4)), (None, text(4)),
    (None, text(2)), (8, None), (8, None), (9, ""), (7, text(5)), (6, text(5) + " more"), (None, text(6)),
]


def test_exact_dedup(spark):
    given = odd(spark, ROWS)
    kept = {r[2]: r for r in told(exact_dedup.dedup(given))}
    everything = {r[2]: r for r in told(given)}
    assert all(everything[name] == row for name, row in kept.items())
    assert {(r[0], r[1] or "") for r in kept.values()} == {
        (7, text(1)), (5, text(2)), (5, text(3)), (None, text(4)), (9, ""), (7, text(5)), (6, text(5) + " more"), (None, text(6)),
    }
    assert len(kept) == 8


def test_near_dedup_keeps_one_row_of_each_component(spark):
    """Equal rows, rows that share an id across components, and rows without one."""
    got = places(near_dedup.dedup(odd(spark, ROWS)))
    assert len([n for n in got if n in (0, 1)]) == 1
    assert len([n for n in got if n in (5, 6)]) == 1
    assert [n for n in got if n not in (0, 1, 5, 6)] == [2, 4, 8, 9, 10, 12, 13]


def test_near_dedup_agrees_with_the_query_where_ids_are_unique(spark):
    rows = [(i, text(i % 6) + (" more" if i % 4 == 3 else "")) for i in range(30)]
    given = odd(spark, rows)
    want = sorted(r.doc_id for r in near_dedup.near_duplicates(given).collect() if r.kept)
    assert sorted(r[0] for r in told(near_dedup.dedup(given))) == want


def test_without_leaks_and_toxic(spark):
    given = odd(spark, [*ROWS, (11, "vile " + text(9))])
    items = spark.createDataFrame([(1, text(3))], "item_id long, text string")
    assert places(decontamination.without_leaks(given, items)) == [n for n in range(15) if n != 4]
    labels = spark.createDataFrame([(i, int(i == 11)) for i in (3, 5, 7, 8, 9, 11)], "doc_id long, grade int")
    kept = toxicity.without_toxic(given, toxicity.fit(given, labels))
    whole = told(given)
    assert all(row in whole for row in told(kept)) and kept.count() >= 14


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table_and_on_clashing_names(spark, tmp_path, stage):
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    made = dict(corpus_pipeline.STAGES)[stage]
    assert made(spark, odd(spark, []), str(tmp_path)).collect() == []
    out = made(spark, odd(spark, ROWS), str(tmp_path))
    assert out.columns == NAMES or stage == "bpe"
    assert 0 < out.count() <= len(ROWS)


@pytest.mark.parametrize("kind", ["smallint", "decimal(20,0)", "string", "tinyint"])
def test_conversations_with_ids_of_any_type(spark, kind):
    given = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "x")], "conv_id long, turn int, role string, text string")
    cast = given.withColumn("conv_id", given["conv_id"].cast(kind))
    got = {str(r.conv_id): r.n_turns for r in chat.read_back(chat.formatted(cast)).collect()}
    assert got == {"1": 2, "2": 1}
