"""State by bucket: writes stay in proportion to changes, later ones win, and batches go on from open members."""

import pyarrow as pa

import tests_folds as folds
from millrace.envelope import COLUMNS
from millrace.streaming.packets import Held, opened
from millrace.streaming.stages import _Batch

FIELDS = pa.schema([("kept", pa.int64())])


class Parts:
    def __init__(self):
        self.held, self.rows = [], 0

    def get(self):
        return iter(self.held)

    def appendList(self, new):
        self.held += new
        self.rows += sum(opened(packet).num_rows for (packet,) in new)

    def put(self, new):
        self.held = []
        self.appendList(new)

    def clear(self):
        self.held = []


def test_writes_of_new_keys_do_not_grow_with_the_state():
    parts = Parts()
    for part in range(50):
        Held(parts, FIELDS).save({f"{part}-{i}": (i,) for i in range(20)}, pa.string())
    assert len(Held(parts, FIELDS).everything()) == 1000
    assert parts.rows < 4 * 1000


def test_the_last_value_wins_and_none_forgets():
    parts = Parts()
    for changes in ({"a": (1,), "b": (2,), "c": (3,)}, {"a": (4,)}, {"b": None}):
        Held(parts, FIELDS).save(changes, pa.string())
    assert Held(parts, FIELDS).of(["a", "b"]) == {"a": (4,)}
    assert Held(parts, FIELDS).everything() == {"a": (4,), "c": (3,)}


def test_batches_go_on_from_open_members():
    rows = [("s", "t", "s", "e", at * at, str(at), at, True) for at in range(40)]
    held, got = {}, []
    for start in range(0, 40, 7):
        part = pa.table(list(map(list, zip(*rows[start : start + 7]))), names=[*COLUMNS, "_whole"])
        out, held = _Batch(4, 90, False).settled(part, ["s"] * part.num_rows, held, None)
        got += [(row["timestamp"], row["payload"]) for row in out.to_pylist()]
    want = [(at, "[" + ",".join(map(str, members)) + "]") for at, members in folds.batches([row[4] for row in rows], 4, 90)]
    assert got == want[: len(got)] and len(want) - len(got) <= 1 and len(got) > 5
