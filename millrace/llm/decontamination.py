"""Benchmark decontamination by templates, with DataFrame functions only.

Words become a template: numbers, units and names (capitalised words) turn into typed
slots, all others into lower case. Every window of WINDOW template words of a document
is looked up, by hash, in the windows of the benchmark. Windows that hit the same item
at the same distance, or one more or less, belong together; a document is a candidate for an item with
half of its windows or HITS of them, and for an item of fewer than EDITED words with all. So items that had a word
replaced, added or left out are found too. For candidates the slots are compared:
wherever the item repeats a value, the document must repeat one too, be it the same
or another. So copies are found, and questions asked anew with other numbers and names,
but not texts that only share a turn of phrase.

Of an item's windows only those count as templates that have LITERALS words outside slots, scaled
down for items shorter than a window. A text is cut into words once, for both forms; a window without slots is
one and the same in both. Beside its template every window has a literal form, the
words in lower case with their values, which always counts; so copies of items made of numbers or
names, and copies in capitals or in lower case, are found. Values are compared in lower case.

Defined results: null and empty texts hold no window and are clean; items without item_id or
text are left out; of items with equal templates and slots the smallest item_id stands for all;
rows that share a doc_id are judged each by its text, and equal rows alike. Empty tables give an
empty result, or all documents clean. Columns other than those named do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import apart, pick, saved, text_or_empty

WINDOW = 4
HITS = 10
EDITED = 12
LITERALS = 2
#: Fewer windows than that do not make a template.
FEWEST = 3
#: Windows of the benchmark that are broadcast, at most: 32 bytes each. More are joined by a shuffle.
BROADCAST_WINDOWS = 2_000_000

# Units, and words that stand first in sentences without being names.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds "
    "ton tons ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years cent cents dollar dollars euro euros percent degree degrees mph kmh"
).split()
SENTENCE_WORDS = (
    "a an the this that these those it he she they we you i in on at of for from to by with as if when while after before "
    "how what which who where why whose is are was were do does did can could will would should and or but not no each every "
    "all some many there then find given suppose let calculate compute"
).split()

_TOKEN = r"[0-9]+(?:[.,][0-9]+)*|[\p{L}\p{M}][\p{L}\p{M}\p{N}]*"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def _kind(token: Column, small: Column) -> Column:
    """The slot that a token fills, whose lower-case form is ``small``, or null for a literal."""
    return (
        F.when(F.ascii(token).between(48, 57), F.lit("<number>"))
        .when(small.isin(UNITS), F.lit("<unit>"))
        .when((F.substring(token, 1, 1) != F.substring(small, 1, 1)) & ~small.isin(SENTENCE_WORDS), F.lit("<name>"))
    )


def _slot(token: Column) -> Column:
    return _kind(token, F.lower(token))


def with_forms(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``typed`` and ``literal``: hashes of the words of ``text`` as templates and in lower case."""
    told = df.withColumn("__words", tokens(F.col(text))).withColumn("__small", tokens(F.lower(text)))
    # The words of the text in lower case are the words in lower case, but for letters that fall apart.
    aligned = F.size("__small") == F.size("__words")
    told = told.withColumn("__small", F.when(aligned, F.col("__small")).otherwise(F.transform("__words", F.lower)))
    literal = F.transform("__small", lambda small: F.xxhash64(small))
    typed = F.zip_with("__words", "__small", lambda token, small: F.xxhash64(F.coalesce(_kind(token, small), small)))
    return told.withColumns({"typed": typed, "literal": literal}).drop("__words", "__small")


def _windows_of(length: int) -> Column:
    def window(at: Column) -> Column:
        both = (F.xxhash64(F.slice(form, at + 1, length)).alias(form) for form in ("typed", "literal"))
        return F.struct(F.lit(length).alias("length"), at.alias("place"), *both)

    places = F.sequence(F.lit(0), F.greatest(F.size("typed") - length, F.lit(0)))
    return F.when(F.size("typed") >= length, F.transform(places, window))


def _windows(lengths: list[int]) -> Column:
    """length, place, typed and literal hash of every window of ``typed`` and ``literal``."""
    parts = [_windows_of(length) for length in lengths]
    return parts[0] if len(parts) == 1 else F.flatten(F.array_compact(F.array(*parts)))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item, its tokens and its template as hashes, equal items once."""
    return (
        pick(benchmark, "item_id", "text")
        .dropna()
        .select(F.col("item_id").alias("item"), tokens(F.col("text")).alias("item_tokens"))
        .filter(F.size("item_tokens") > 0)
        .groupBy("item_tokens")
        .agg(F.min("item").alias("item"))
    )


def _index(items: DataFrame, lengths: list[int]) -> DataFrame:
    """Windows of the items that count: length, window, as_is (the literal form), item, item_place and how many hits of the form the item needs."""
    told = items.withColumns(
        {
            "typed": F.transform("item_tokens", lambda t: F.xxhash64(F.coalesce(_slot(t), F.lower(t)))),
            "literal": F.transform("item_tokens", lambda t: F.xxhash64(F.lower(t))),
            "words": F.transform("item_tokens", lambda t: _slot(t).isNull().cast("int")),
            "size": F.size("item_tokens"),
        }
    )
    windows = told.select("item", "size", "words", F.explode(_windows(lengths)).alias("w")).filter(F.col("w.length") == F.least("size", F.lit(WINDOW)))
    words = F.aggregate(F.slice("words", F.col("w.place") + 1, F.col("w.length")), F.lit(0), lambda a, b: a + b)
    forms = F.array(*(F.struct(F.lit(as_is).alias("as_is"), F.col(f"w.{form}").alias("window")) for form, as_is in (("typed", False), ("literal", True))))
    both = windows.select("item", "size", "w.length", F.col("w.place").alias("item_place"), words.alias("words"), F.explode(forms).alias("f"))
    counting = both.filter(F.col("f.as_is") | (F.col("words") * WINDOW >= F.col("length") * LITERALS))
    counting = counting.select("item", "size", "length", "item_place", "f.as_is", "f.window")
    n = F.count("*")
    enough = F.least(F.greatest(F.ceil(n / 2), F.least(n, F.lit(FEWEST))), F.lit(HITS))
    needed = F.when(F.first("size") < EDITED, n).otherwise(enough).alias("needed")
    sums = counting.groupBy("item", "as_is").agg(needed, n.alias("n"), F.first("size").alias("words"), F.first("length").alias("long"))
    least = F.when(F.col("words") < EDITED, F.ceil((F.col("words") - F.col("long") + 1) / 2)).otherwise(FEWEST)
    sums = sums.filter(F.col("as_is") | (F.col("n") >= least)).drop("n", "words", "long")
    return counting.drop("size").join(sums, ["item", "as_is"])


def _key() -> Column:
    """One number for a row of documents, alike for equal rows."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """key (of the row, see ``_key``), item, hits, slots and exact for each leak; exact if all slots hold the same values."""
    docs = pick(docs, "doc_id", "text").withColumn("text", text_or_empty()).withColumn("key", _key())
    items = saved(benchmark_items(benchmark))
    lengths = [row.n for row in items.select(F.least(F.size("item_tokens"), F.lit(WINDOW)).alias("n")).distinct().collect()]
    index = saved(_index(items, sorted(lengths) or [WINDOW]))
    if index.count() <= BROADCAST_WINDOWS:
        index = F.broadcast(index)
    windows = with_forms(docs.select("key", "text"), "text").select("key", F.explode(_windows(sorted(lengths) or [WINDOW])).alias("w"))
    typed, literal = F.col("w.typed"), F.col("w.literal")
    asked = windows.select(
        "key", "w.length", "w.place", F.explode(F.when(typed == literal, F.array(typed)).otherwise(F.array(typed, literal))).alias("window")
    )
    hits = asked.join(index, ["length", "window"])
    aligned = (
        hits.withColumn("distance", F.col("place") - F.col("item_place"))
        .groupBy("key", "item", "distance", "as_is")
        .agg(
            F.count_distinct("item_place").alias("own"),
            F.first("needed").alias("needed"),
            F.min("item_place").alias("first"),
            F.max(F.col("item_place") + F.col("length")).alias("end"),
        )
    )
    near = Window.partitionBy("key", "item", "as_is").orderBy("distance").rangeBetween(-1, 1)
    aligned = aligned.withColumn("hits", F.sum("own").over(near)).filter("hits >= needed").drop("needed", "own")
    candidates = saved(aligned)
    texts = docs.join(candidates.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    both = candidates.join(texts.select("key", tokens(F.col("text")).alias("doc_tokens")), "key")
    both = both.join(items.select("item", "item_tokens"), "item")
    pairs = F.transform(
        # Slots beside the windows that hit are looked at too.
        F.sequence(F.greatest(F.col("first") - WINDOW, F.lit(0)), F.least(F.col("end") + WINDOW, F.size("item_tokens")) - 1),
        lambda at: F.struct(
            F.get("item_tokens", at).alias("asked"), F.get("doc_tokens", (at + F.col("distance")).cast("int")).alias("found")
        ),
    )
    slots = F.filter(pairs, lambda p: _slot(p["asked"]).isNotNull() & (_slot(p["asked"]) == _slot(p["found"])))
    small = F.transform(slots, lambda p: F.struct(F.lower(p["asked"]).alias("asked"), F.lower(p["found"]).alias("found")))
    judged = both.withColumn("pairs", small).withColumn("asked", F.transform("pairs", lambda p: p["asked"]))
    # Where literal forms hit, the values are the item's own; words between such windows do not undo that.
    consistent = F.col("as_is") | (F.size(F.array_distinct("asked")) == F.size(F.array_distinct("pairs")))
    return (
        judged.filter(consistent)
        .select("key", "item", "hits", F.size("pairs").alias("slots"), F.forall("pairs", lambda p: p["asked"] == p["found"]).alias("exact"))
        .groupBy("key", "item")
        .agg(F.max(F.struct("hits", "exact", "slots")).alias("best"))
        .select("key", "item", "best.hits", "best.slots", "best.exact")
    )


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, kept (no leak), items (sorted), hits and exact (of the best) for every row of ``docs``."""
    found = (
        leaks(docs, benchmark)
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"), F.max(F.struct("hits", "exact")).alias("best"))
    )
    narrow = pick(docs, "doc_id", "text").withColumn("text", text_or_empty()).select("doc_id", _key().alias("key"))
    return narrow.join(found, "key", "left").select(
        "doc_id",
        F.col("items").isNull().alias("kept"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("best.hits", F.lit(0)).cast("long").alias("hits"),
        F.coalesce("best.exact", F.lit(False)).alias("exact"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they were."""
    found = leaks(docs, benchmark).select(F.col("key").alias("__key")).distinct()
    told, back = apart(docs, "doc_id", "text")
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", text_or_empty())
    return back(told.withColumn("__key", key).join(found, "__key", "left_anti"))
