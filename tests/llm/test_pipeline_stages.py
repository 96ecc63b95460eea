import random
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def test_stages_against_plain_versions(spark, tmp_path):
    draw = random.Random(8)
    text = lambda n: " ".join(f"{draw.choice('abcdefgh')}o{draw.randrange(900)}" for _ in range(n))
    items = [(i, text(25)) for i in range(3)]
    rows = [(i, text(60)) for i in range(60)]
    toxic = [(100 + i, text(20) + " scumbag " + text(20)) for i in range(30)]
    copies = [(200, rows[0][1]), (201, rows[0][1]), (202, rows[1][1] + " more")]
    leaks = [(300 + i, f"{text(30)} {t} {text(5)}") for i, t in items]
    docs = [*rows, *toxic, *copies, *leaks, (400, None)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], columns)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in rows[:40]] + [(i, 1, 1) for i, _ in toxic[:20]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    gone = {i for i, _ in toxic}
    kept = [table]
    expected = [gone, {0, 200}, {202}, {i for i, _ in leaks}, set()]
    for (name, stage), out in zip(corpus_pipeline.STAGES, expected):
        made = stage(spark, kept[-1], str(tmp_path)).cache()
        before, after = ({r.doc_id for r in d.select("doc_id").collect()} for d in (kept[-1], made))
        assert before - after == out, name
        assert after <= before and (name == "bpe" or made.columns == table.columns)
        kept.append(made)
    library, texts = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), dict(docs)
    for r in kept[-1].collect():
        assert r.ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter(r.doc_id for r in kept[-1].collect())


def test_the_near_dedup_stage_links_pairs_from_80_percent(spark):
    draw = random.Random(80)
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    docs, gone = [], set()
    for n in range(86, 134, 2):
        base = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        copy = list(base)
        copy[n // 3], copy[2 * n // 3] = "changed", "again"
        one, two = " ".join(base), " ".join(copy)
        if 10 * len(shingles(one) & shingles(two)) >= 8 * len(shingles(one) | shingles(two)):
            gone.add(2 * n + 1)
        docs += [(2 * n, one), (2 * n + 1, two)]
    assert 0 < len(gone) < len(docs) // 2
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    kept = dict(corpus_pipeline.STAGES)["minhash near-dedup"](spark, table, "").collect()
    assert {i for i, _ in docs} - {r.doc_id for r in kept} == gone
