import re

from millrace.llm import decontamination

SCHEMA = "doc_id long, text string, key string, Item long, place int"
ITEMS = [
    (1, "Tom has 12 apples and gives 5 apples to Anna before he walks 3 km home and eats 5 more of the apples that were left."),
    (2, "the quick brown fox jumps over the lazy dog while seven small birds sing near the old stone bridge"),
    (3, "what is seven plus eight"),
    (4, None),
    (None, "no id for this long enough item text that would otherwise match any copy of it in here"),
    (5, "A B C D E F G H I J K L M N"),
    (6, "the quick brown fox jumps over the lazy dog while seven small birds sing near the old stone bridge"),
]


def documents():
    anew = "Kim has 40 apples and gives 7 apples to Maria before he walks 9 km home and eats 7 more of the apples that were left."
    mixed = anew.replace("eats 7", "eats 8")
    return [
        (1, f"Intro words here. {ITEMS[0][1]} And more.", "", 0, 0),
        (2, f"x y z {anew} tail", "", 0, 0),
        (3, f"x y z {mixed} tail", "", 0, 0),
        (4, "THE " + ITEMS[1][1].upper().lower() + " and on", "", 0, 0),
        (5, "the quick brown fox jumps over the lazy cat and that is all there is", "", 0, 0),
        (6, "so what is seven plus eight then", "", 0, 0),
        (7, None, "", 0, 0),
        (8, "", "", 0, 0),
        (9, "P Q R S T U V W X Y Z A B C D E F", "", 0, 0),
        (10, ITEMS[4][1], "", 0, 0),
        (11, "filler " * 20_000 + ITEMS[1][1], "", 0, 0),
        (None, ITEMS[1][1], "", 0, 0),
        (1, "the same id with clean words", "", 0, 0),
        (4, "THE " + ITEMS[1][1] + " and on", "", 0, 0),
    ]


def test_copies_and_questions_asked_anew(spark):
    docs = spark.createDataFrame(documents(), SCHEMA).repartition(3)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(((r.doc_id or 0, r.kept, tuple(r["items"]), r.exact) for r in decontamination.judged(docs, benchmark).collect()))
    clean = [(i, True, (), False) for i in (1, 3, 5, 7, 8, 9, 10)]
    leaks = [(0, (2,), True), (1, (1,), True), (2, (1,), False), (4, (2,), True), (4, (2,), True), (6, (3,), True), (11, (2,), True)]
    assert got == sorted(clean + [(i, False, items, exact) for i, items, exact in leaks])
    kept = decontamination.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 7, 8, 9, 10]


def test_the_shuffled_join_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(documents(), SCHEMA)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    before = sorted(map(str, decontamination.judged(docs, benchmark).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert sorted(map(str, decontamination.judged(docs, benchmark).collect())) == before


def test_empty_tables(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.kept for r in decontamination.judged(docs, none).collect())
    assert decontamination.judged(docs.limit(0), spark.createDataFrame(ITEMS, none.schema)).collect() == []


def test_copies_word_for_word_in_any_case_and_of_items_without_literals(spark):
    items = [
        (1, "What is 12 + 37 - 5 * 4 + 19 / 2 ?"),
        (2, "Compute 3 4 5 6 7 8 9 10 11."),
        (3, "Anna Bert Clara David Emma Fritz Greta Hans Ida Jakob"),
        (4, "Der Hund des Nachbarn bellt jeden Morgen vor dem Haus der alten Frau Meier"),
        (5, "Tom has 12 apples and gives 5 apples to Anna before he walks 3 km home and eats 5 more of them"),
    ]
    made = [f"some words before {form(text)} and others after" for _, text in items for form in (str, str.lower, str.upper)]
    made += ["Compute 3 4 5 6 7 8 9 10 12.", "Anna Bert Clara David Emma Karl Greta Hans Ida Jakob", "What is 13 + 37 - 5 * 4 + 18 / 2 ?"]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)
    words = lambda text: re.findall(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]\w*", text.lower())
    holds = lambda text, item: any(text[i : i + len(item)] == item for i in range(len(text)))
    want = {i: [n for n, item in items if holds(words(text), words(item))] for i, text in enumerate(made)}
    assert sum(map(len, want.values())) == 15
    got = {r.doc_id: r["items"] for r in decontamination.judged(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want


def test_items_with_a_word_replaced_added_or_left_out(spark):
    """Every single edit of items of 12 words or more is found; texts that share a few words are not."""
    items = [
        (1, "two large horses graze behind that red wooden barn until late evening"),
        (2, ITEMS[1][1]),
        (3, "Which river of the north flows past the garden where winter music was first heard by light of day and night?"),
    ]
    made, want = [], {}
    for item, text in items:
        words = text.split()
        for at in range(len(words)):
            for edit in (words[:at] + ["changed"] + words[at + 1 :], words[:at] + ["added"] + words[at:], words[:at] + words[at + 1 :]):
                want[len(made)] = [item]
                made.append(f"before it all {' '.join(edit)} and then some")
    for item, text in items:
        words = text.split()
        want[len(made)] = []
        made.append(f"before it all {' '.join(words[: len(words) // 3])} and then some")
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r["items"] for r in decontamination.judged(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    missed = [made[i] for i in want if want[i] and want[i] != got[i]]
    assert not missed, missed
    assert got == want


def template(text):
    """The words of a text with slots, and with their values, as a plain program has them."""
    words = re.findall(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]\w*", text)
    kinds = []
    for word in words:
        small = word.lower()
        number, unit = word[0].isdigit(), small in decontamination.UNITS
        name = word[0] != word[0].lower() and small not in decontamination.SENTENCE_WORDS
        kinds.append("<number>" if number else "<unit>" if unit else "<name>" if name else small)
    return kinds, [w.lower() for w in words]


def test_questions_asked_anew_against_a_plain_program(spark):
    """Names, numbers and units are exchanged, alike or not where the item repeats one."""
    import random

    draw = random.Random(12)
    names, units = ["Tom", "Anna", "Kim", "Maria", "Otto"], ["km", "hours", "dollars"]
    forms = [
        "{a} walks {x} {u} from the old mill and then {b} walks {x} {u} back to where {a} began the day",
        "if {a} sells {x} loaves for {y} {u} each how much more than {y} {u} does {a} have when all {x} are sold",
    ]

    def filled(form, a, b, x, y, u):
        return form.format(a=a, b=b, x=x, y=y, u=u)

    items = [(i, filled(form, "Tom", "Anna", 12, 5, "km")) for i, form in enumerate(forms)]
    made = []
    for form in forms:
        for _ in range(12):
            a, b = draw.sample(names, 2)
            x, y = draw.sample(range(2, 99), 2)
            text = filled(form, a, b, x, y, draw.choice(units))
            made += [text, text.replace(str(x), str(x + 1), 1), text.replace(a, "Fritz", 1)]
    made = [f"so then {text} and on" for text in made]
    want = {}
    for n, text in enumerate(made):
        kinds, values = template(text)
        want[n] = []
        for item, asked in items:
            own, given = template(asked)
            at = next((i for i in range(len(kinds)) if kinds[i : i + len(own)] == own), None)
            if at is not None:
                pairs = {(v, w) for v, w, k in zip(given, values[at:], own) if k[0] == "<"}
                consistent = len({v for v, _ in pairs}) == len(pairs)
                # Or half of the windows are the item's own, values and all.
                hits = sum(values[at + i : at + i + 4] == given[i : i + 4] for i in range(len(own) - 3))
                if consistent or hits >= min(10, -(-(len(own) - 3) // 2)):
                    want[n].append(item)
    assert 20 < sum(map(len, want.values())) < len(made)
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r["items"] for r in decontamination.judged(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want
