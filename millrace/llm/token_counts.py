"""Token counts of a byte-level BPE vocabulary, without a shuffle of pre-tokens.

A pre-token's length in tokens is looked up in two tiers: a broadcast table of the
frequent pre-tokens, and behind it a cache in each worker, filled by encoding what
it misses. The broadcast table has FREQUENT entries at most. They are found over all
documents: each task that reads texts keeps a Misra-Gries summary of its pre-tokens, and
only the summaries, of SUMMARY counters at most, are shuffled and added up. The table
decides about speed only.

Defined results: a null text counts as empty: 0 bytes and 0 tokens. Rows that share
a doc_id are counted each for itself; a null doc_id stays null. An empty table gives
an empty result. Columns other than doc_id and text do not matter.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import BytePairs, Remembered, Splitter, read_vocabulary
from millrace.llm.common import pick, text_or_empty
from millrace.llm.exact_dedup import misra_gries

#: Entries of the broadcast table and the longest pre-token in it: it has 8 MB at most before compression.
FREQUENT = 65_536
FREQUENT_BYTES = 64
#: Counters of a task's summary.
SUMMARY = 65_536
#: Tasks that the frequent pre-tokens are encoded in.
ENCODERS = 16


class Lengths(Remembered):
    """Lengths of pre-tokens: the frequent ones in a table of their own, others remembered up to a limit."""

    def __init__(self, table: bytes, pairs: BytePairs):
        words, _, sizes = zlib.decompress(table).rpartition(b"\xff")
        self.frequent = dict(zip(words.decode("utf-8").split("\0"), array("H", sizes)))
        super().__init__(lambda word: self.frequent.get(word) or len(pairs.encode(word)))


def _packed(rows: list[tuple[str, int]]) -> bytes:
    """Words, then a byte that UTF-8 never has, then lengths of 16 bits."""
    words = "\0".join(word for word, _ in rows).encode("utf-8")
    return zlib.compress(words + b"\xff" + array("H", [n for _, n in rows]).tobytes())


def frequent_lengths(docs: DataFrame, source, summary: int = SUMMARY, frequent: int = FREQUENT) -> bytes:
    """The packed table of frequent pre-tokens; ``source`` is the broadcast vocabulary."""

    def count(batches):
        split, seen = Splitter(json.loads(source.value)), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, words in split.pieces(text or ""):
                    seen.update(words)
                # Room for as many again: the summary is sorted once in a while only.
                if len(seen) > 2 * summary:
                    seen = misra_gries(seen, summary)
        top = [(w, n) for w, n in misra_gries(seen, summary).items() if len(w.encode()) <= FREQUENT_BYTES and "\0" not in w]
        words, numbers = zip(*top) if top else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["word", "n"])

    def measure(batches):
        pairs = BytePairs(json.loads(source.value))
        for batch in batches:
            words = batch.column(0)
            sizes = [len(pairs.encode(word)) for word in words.to_pylist()]
            yield pa.RecordBatch.from_arrays([words, pa.array(sizes, pa.int64())], ["word", "n"])

    top = (
        docs.select("text")
        .mapInArrow(count, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(frequent)
        .repartition(ENCODERS)
    )
    return _packed([(row.word, row.n) for row in top.select("word", "n").mapInArrow(measure, "word string, n long").collect()])


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, **sizes) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every text."""
    docs = pick(docs, "doc_id", "text")
    context = docs.sparkSession.sparkContext
    source = context.broadcast(read_vocabulary(vocabulary))
    table = context.broadcast(frequent_lengths(docs, source, **sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec = json.loads(source.value)
        split = Splitter(spec)
        length = Lengths(table.value, BytePairs(spec)).__getitem__
        for batch in batches:
            counts = [
                sum(1 if special is not None else sum(map(length, words)) for special, words in split.pieces(text))
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    text = text_or_empty()
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return counted.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
