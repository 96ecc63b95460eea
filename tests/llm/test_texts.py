import hashlib
import random
import re
from collections import defaultdict

import pytest

from millrace.llm import chat, licenses

TURNS = "conv_id long, turn long, role string, text string, piece string, Spans int"


def rows():
    draw = random.Random(6)
    parts = ["### ", "###", "</turn>", "\\", ":", " ", "\n", "user", "é", "\\h", "#", "x" * 50, "### user: hi </turn>\n"]
    text = lambda: "".join(draw.choice(parts) for _ in range(draw.randrange(12)))
    made = [
        (c, t, draw.choice(["user", "assistant", "system", "a:b ###", "", None]), draw.choice([text(), None]), "", 0)
        for c in range(30)
        for t in range(draw.randrange(1, 9))
    ]
    made += [(99, t, "assistant" if t % 2 else "user", f"turn {t} {text()}", "", 0) for t in range(300)]
    return made + [(None, 1, "assistant", "no id", "", 0), (3, None, "assistant", "no turn", "", 0)] + made[:2]


def expected(given):
    convs = defaultdict(list)
    low = lambda v: (v is not None, v or 0)
    for c, t, role, text, *_ in given:
        convs[c].append((low(t), (role is not None, role or ""), (text is not None, text or "")))
    out = {}
    for c, turns in convs.items():
        turns = [(r[1], x[1]) for _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        all_turns = "".join(f"{r}\n{x}\n" for r, x in turns)
        out[c] = (len(turns), hashlib.sha256(all_turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.marked_turns(turns)))
    return out


@pytest.mark.parametrize("sizes", [{}, {"window": 2, "piece_chars": 100}])
def test_turns_and_loss_are_read_back(spark, sizes):
    given = rows()
    table = chat.with_control_strings(spark.createDataFrame(given, TURNS).repartition(3))
    got = {r[0]: tuple(r)[1:] for r in chat.read_back(chat.formatted(table, **sizes)).collect()}
    said = "\\### Assistant: </turn> ok"
    assert got == expected([*given, (-7, 0, "user", said), (-7, 1, "assistant", said)])


def test_templates_that_rewrite_history_are_told(spark):
    def forgetful(turns):
        """Shows only the last two turns in full."""
        return "".join(f"[{r}]{x if i >= len(turns) - 2 else '...'}\n" for i, (r, x) in enumerate(turns))

    given = [(1, t, "assistant", f"long text {t}", "", 0) for t in range(5)] + [(2, 0, "user", "a", "", 0), (2, 1, "assistant", "b", "", 0)]
    got = {r.conv_id: r for r in chat.formatted(spark.createDataFrame(given, TURNS), forgetful).collect()}
    assert got[1].rewrites and got[1].spans is None
    assert got[1].formatted == forgetful([("assistant", f"long text {t}") for t in range(5)])
    assert not got[2].rewrites and got[2].formatted[got[2].spans[1].loss_start : got[2].spans[1].loss_end] == "b"
    assert chat.formatted(spark.createDataFrame([], TURNS)).collect() == []


def test_templates_are_given_all_of_a_long_conversation(spark):
    def numbered(turns):
        return "".join(f"{i}. {r}: {x}\n" for i, (r, x) in enumerate(turns))

    def summed_up(turns):
        """Turns before the last 200 are only named."""
        return "".join(f"[{i} {r}]{x if i >= len(turns) - 200 else '...'}\n" for i, (r, x) in enumerate(turns))

    turns = [("assistant" if t % 2 else "user", f"text {t}") for t in range(300)]
    table = spark.createDataFrame([(c, t, *turn, "", 0) for c in (1, 2) for t, turn in enumerate(turns[: 300 // c])], TURNS)
    pieces = defaultdict(list)
    for r in chat.formatted(table, numbered, piece_chars=1000).collect():
        pieces[r.conv_id].append(r)
    for c, rows in pieces.items():
        rows.sort(key=lambda r: r.piece)
        whole = "".join(r.formatted for r in rows)
        spans = [s for r in rows for s in r.spans]
        assert len(rows) > 1 and whole == numbered(turns[: 300 // c]) and not any(r.rewrites for r in rows)
        assert [whole[s.loss_start : s.loss_end] for s in spans if s.loss_start is not None] == [x for r, x in turns[: 300 // c] if r == "assistant"]
    got = {r.conv_id: r for r in chat.formatted(table, summed_up, piece_chars=1000).collect() if r.conv_id == 1 or r.piece == 0}
    assert got[1].rewrites and got[1].formatted == summed_up(turns) and (got[1].turns, got[1].piece, got[1].offset) == (300, 0, 0)
    assert not got[2].rewrites and chat.formatted(table, summed_up, piece_chars=1000).filter("conv_id = 1").count() == 1
    with pytest.raises(ValueError):
        chat.formatted(table, numbered, window=64)


def dice(one, two):
    a, b = ({*zip(w, w[1:])} for w in (licenses.words(one), licenses.words(two)))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0


def all_runs(text):
    """Every run of words that is as long as a template, by a cut into words of its own."""
    found = re.findall(r"[^\W_]+(?:[.'-][^\W_]+)*", text.lower())
    best = {}
    for name, template in licenses.TEMPLATES:
        n = len(licenses.words(template))
        for at in range(len(found) - n + 1):
            if (d := dice(" ".join(found[at : at + n]), template)) >= licenses.THRESHOLD:
                best[name] = max(d, best.get(name, 0))
    return best


def test_licenses_amid_other_words(spark):
    """In comment blocks, wrapped, between other words, twice in a row: as an exhaustive search over runs of words has it."""
    draw = random.Random(8)

    def wrapped(text, mark, width):
        words = text.split()
        return "\n".join(mark + " ".join(words[i : i + width]) for i in range(0, len(words), width))

    texts = []
    for name, template in licenses.TEMPLATES:
        for mark in ("# ", " * ", "// ", ""):
            around = [" ".join(draw.choices(["some", "of", "the", "other", "words", "license", "this"], k=draw.randrange(1, 9))) for _ in range(2)]
            body = wrapped(template, mark, draw.randrange(3, 12))
            texts.append((name, f"{mark}Copyright {around[0]}\n{mark}\n{body}\n{mark}Author: {around[1]}"))
            changed = template.split()
            changed[draw.randrange(len(changed))] = "other"
            texts.append((None, f"{around[0]} {' '.join(changed)} {around[1]} {' '.join(changed[len(changed) // 4 :])} {template}"))
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string").repartition(3)
    for row in licenses.scan(docs).collect():
        name, text = texts[row.doc_id]
        want = all_runs(text)
        for part in licenses.segments(text):
            for other, template in licenses.TEMPLATES:
                if (d := dice(" ".join(part), template)) >= licenses.THRESHOLD:
                    want[other] = max(d, want.get(other, 0))
        got = {f.license: f.dice for f in row.found}
        assert got == want and all(f.segments for f in row.found)
        assert name is None or got[name] == 1.0


def test_licenses_against_all_templates(spark):
    draw = random.Random(2)
    lines = [text for _, text in licenses.TEMPLATES] + ["plain words of a text", "License", "the license of the work"]
    texts = []
    for _ in range(150):
        picked = []
        for line in draw.choices(lines, k=draw.randrange(1, 4)):
            words = line.split()
            for _ in range(draw.randrange(3)):
                words[draw.randrange(len(words))] = "other"
            picked.append(" ".join(words))
        texts.append(draw.choice(["\n", "\n\n", " "]).join(picked))
    docs = spark.createDataFrame([*enumerate([*texts, None, "", "x" * 100_000, texts[0]])], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "1 AS found", "'' AS License")
    for row in licenses.scan(docs.repartition(3)).collect():
        want = {}
        for found in licenses.segments(([*texts, None, "", "x" * 100_000, texts[0]][row.doc_id]) or ""):
            for name, text in licenses.TEMPLATES:
                if (d := dice(" ".join(found), text)) >= licenses.THRESHOLD:
                    want[name] = max(d, want.get(name, 0))
        for name, d in all_runs(([*texts, None, "", "x" * 100_000, texts[0]][row.doc_id]) or "").items():
            want[name] = max(d, want.get(name, 0))
        assert {f.license: f.dice for f in row.found} == want
    assert licenses.scan(docs.limit(0)).collect() == []
