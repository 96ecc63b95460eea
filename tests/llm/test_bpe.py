import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, token_counts

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def texts():
    draw = random.Random(7)
    letters = "aeiourstnlAEÉéèßÑç's ,.!?0123456789<|>\n\t   ΣςİıŁ你好🙂é  \x1c\x85½²"
    made = ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(400)]
    return made + [
        "",
        " ",
        "a<|endoftext|>b <|startoftext|><|endoftext|>",
        "x" * 5000,
        "ab" * 3000 + "é" * 999,
        "ΟΔΟΣ ΣΑΣ'S 'Ll",
        "word  \n\n end \t ",
        "\0 nul ﻿​",
    ]


def odd():
    """Every character but surrogates and unassigned ones, between letters."""
    return ["".join(f"a{chr(c)}b " for c in range(s, s + 512) if unicodedata.category(chr(c)) not in ("Cs", "Cn")) for s in range(0, 0x30000, 512)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_the_library(path):
    library, own = Tokenizer.from_file(path), bpe.Encoder(bpe.read_vocabulary(path))
    for text in texts():
        want = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(own.packed_ids(text)).cast("i") if own.packed_ids(text) else []) == want, text


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_every_character(path):
    library, own = Tokenizer.from_file(path), bpe.Encoder(bpe.read_vocabulary(path))
    differ = [t for t in odd() if t and list(memoryview(own.packed_ids(t)).cast("i")) != library.encode(t, add_special_tokens=False).ids]
    assert not differ


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, DECODED string, n_tokens int")


def test_round_trip_on_frames(spark):
    given = [*texts(), None, "again", "again"]
    docs = frame(spark, [(i if i % 9 else None, t, "x", "y", 1) for i, t in enumerate(given)]).repartition(3)
    library = Tokenizer.from_file(WORD)
    got = bpe.decode(bpe.encode(docs, WORD), WORD).collect()
    want = [library.encode(t or "", add_special_tokens=False).ids for t in given]
    assert sorted((r.doc_id or -1, r.ids, r.decoded) for r in got) == sorted(
        ((i if i % 9 else None) or -1, ids, library.decode(ids, skip_special_tokens=False)) for i, ids in enumerate(want)
    )


def test_counts_equal_the_library_with_small_tables(spark):
    given = [*texts(), None]
    docs = frame(spark, [(i, t, "x", "y", 1) for i, t in enumerate(given)])
    library = Tokenizer.from_file(BYTE)
    for sizes in ({}, {"summary": 20, "frequent": 10}):
        got = {r.doc_id: tuple(r) for r in token_counts.token_counts(docs, BYTE, limit=20, **sizes).collect()}
        for i, t in enumerate(given):
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            assert got[i] == (i, len((t or "").encode()), n, n > 20), t


def test_frequent_words_come_from_all_documents(spark):
    """A word that fills the last documents only is found, with its length, whatever the summaries hold."""
    rows = [(i, f"once{i} other{i * 7}", "", "", 0) for i in range(400)] + [(1000 + i, "lately " * 50, "", "", 0) for i in range(100)]
    docs = frame(spark, rows).coalesce(3)
    source = spark.sparkContext.broadcast(bpe.read_vocabulary(BYTE))
    lengths = token_counts.Lengths(token_counts.frequent_lengths(docs, source, summary=8, frequent=4), None)
    found = {word.strip("Ġ "): n for word, n in lengths.frequent.items()}
    assert len(lengths.frequent) <= 4 and found["lately"] == len(Tokenizer.from_file(BYTE).encode(" lately").ids)


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert bpe.decode(bpe.encode(docs, WORD), WORD).collect() == []
    assert token_counts.token_counts(docs, BYTE).collect() == []


def test_cache_is_bounded():
    kept = bpe.Remembered(len, limit=3)
    assert [kept[w] for w in ("a", "bb", "a", "ccc", "dddd", "a")] == [1, 2, 1, 3, 4, 1]
    assert len(kept) <= 3
