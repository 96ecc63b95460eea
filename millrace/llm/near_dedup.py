"""MinHash near-dedup as a chosen-path set similarity join.

A document is its set of word shingles, and a sketch of COORDINATES minwise tokens of it.
Documents with equal sets are one class. Each class goes down a forest: at the roots it
takes the branches of ROOTS fixed coordinates, and in every node of more than LEAF classes
those of one or two coordinates that the node's path draws, one branch for the token it has
there. A branch thus holds the classes that agree in all tokens drawn on its path. A pair
with similarity s stays together along a branch with chance s per level, and 1.275 / t branches
go on from a node, t being the threshold. A pair with s = t is missed by one root with chance
(1 - t) / (1.275 - t) however deep its branches get (0.35 at t = 0.85, 0.42 at 0.80), and there are
as many roots (12, 15) as bring the chance that all miss it to 4e-6; with no large nodes it
is 1e-10 and 3e-11. Nodes of up to LEAF classes are compared exhaustively: sketches first, and what
they leave (a pair at the threshold fails with chance 2e-5 at the most) on the full sets.

Only components are asked for, so links inside one need not be listed. Sketches cut a node into
the parts that possible links join; equal parts of several nodes are looked at once. A part gets
the full sets of its classes, and pairs are tested with the likeliest first until its classes are
joined or no pair is left; pairs of one component are passed over. Large nodes are thinned before
they branch: their classes are compared to one of them, and a node whose classes lie in one
component is done. One in which few lie outside its main component is compared in blocks, those few
against all. So no group, however large, is expanded into pairs or met by one task.

Defined results: a text without words has an empty set and is linked with nothing, nor
are two of them; a null text counts as empty; rows that share a doc_id are linked each by its
text; null doc_ids are left out of the smallest, and a component of nothing else has none. An empty
table gives an empty result. Columns other than doc_id and text do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import shingles
from millrace.llm.common import apart, pick, saved, text_or_empty
from millrace.llm.components import components

#: Minwise tokens of a sketch, 32 bits each.
COORDINATES = 96
#: Classes of a node that are compared exhaustively.
LEAF = 2048
#: Nodes this deep are compared in blocks whatever their size; paths get there only at similarities near 1.
DEEPEST = 24
#: Links have 100 * intersection >= PERCENT * union, if nothing else is asked for.
PERCENT = 85
#: Branches of a node that a pair at the threshold shares, on average; chances that it shares no
#: node however deep, and that its sketches do not propose it.
SHARED, MISSED, REFUSED = 1.275, 4e-6, 2e-5

_DRAW = np.random.Generator(np.random.PCG64(77))
_FACTORS = _DRAW.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(found: np.ndarray) -> np.ndarray:
    """Of each keyed order of the shingles the first one, as 32 mixed bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 4096):
        np.minimum(least, (found[at : at + 4096, None] * _FACTORS).min(0), out=least)
    return (shingles.mixed(least) >> np.uint64(32)).astype(np.uint32)


def set_key(found: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    sums = np.array([found.sum(dtype=np.uint64), shingles.mixed(found ^ np.uint64(len(found))).sum(dtype=np.uint64)])
    return sums.tobytes()


@dataclass(frozen=True)
class Law:
    """What follows from the threshold, so that pairs at it are found with the same chance at any."""

    percent: int = PERCENT

    def __post_init__(self):
        if not 65 <= self.percent <= 100:
            raise ValueError("the threshold lies between 65 and 100: below, two branches of a node do not suffice")

    @property
    def two(self) -> float:
        """Share of the nodes that have two branches, not one."""
        return SHARED * 100 / self.percent - 1

    @property
    def roots(self) -> int:
        share = self.percent / 100
        return max(1, math.ceil(math.log(MISSED) / math.log(max((1 - share) / (SHARED - share), MISSED))))

    @property
    def likely(self) -> float:
        """Equal tokens from which sketches propose a pair at first."""
        return (self.percent - 5) / 100 * COORDINATES

    @property
    def possible(self) -> int:
        """Equal tokens from which sketches propose a pair at all."""
        share, below, least = self.percent / 100, 0.0, 0
        while least < COORDINATES:
            below += math.comb(COORDINATES, least) * share**least * (1 - share) ** (COORDINATES - least)
            if below > REFUSED:
                break
            least += 1
        return least


def linked(one: np.ndarray, two: np.ndarray, percent: int = PERCENT) -> bool:
    small, large = (one, two) if len(one) <= len(two) else (two, one)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(one) + len(two) - shared)


def linked_to(one: np.ndarray, others: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which of several sets are linked to one."""
    sizes = np.array([len(o) for o in others])
    together = np.concatenate(others)
    at = np.searchsorted(one, together)
    at[at == len(one)] = 0
    shared = np.add.reduceat((one[at] == together).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * shared >= percent * (sizes + len(one) - shared)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and text_key, which with doc_id finds a text again: doc_ids alone may be null or shared by many rows."""
    docs = pick(docs, "doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    return docs.withColumn("text_key", F.xxhash64("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key and sketch of every row; the last two null without words."""
    docs = _keyed(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, drawn = [], [], []
            for found in shingles.text_sets(batch.column(1)):
                sizes.append(len(found))
                keys.append(set_key(found) if len(found) else None)
                drawn.append(sketch(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(drawn, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "set_key", "sketch"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, text_key long, n_shingles long, set_key binary, sketch binary")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """cid and ``found``, the full set, of the classes ``wanted`` (cid, set_key, min_id, min_key)."""
    docs = _keyed(docs)
    same = docs["doc_id"].eqNullSafe(wanted["min_id"]) & (docs["text_key"] == wanted["min_key"])
    rows = docs.join(wanted, same).select("cid", "set_key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_pylist()
            got = [f.tobytes() if len(f) and set_key(f) == k else None for k, f in zip(keys, shingles.text_sets(batch.column(2)))]
            found = pa.array(got, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["cid", "found"]).filter(found.is_valid())

    return rows.mapInArrow(run, "cid long, found binary")


def _token(coordinate: Column | int) -> Column:
    place = F.lit(coordinate) if isinstance(coordinate, int) else coordinate
    return F.substr(F.col("sketch"), place * 4 + 1, F.lit(4))


def _root_nodes(law: Law) -> Column:
    return F.explode(F.array(*(F.xxhash64(F.lit(c), _token(c)) for c in range(law.roots))))


def _branches(law: Law) -> Column:
    """The nodes below ``node``: for a share of the nodes two, else one, at coordinates that its path draws."""

    def child(salt: int) -> Column:
        drawn = F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(COORDINATES)).cast("int")
        return F.xxhash64("node", drawn, _token(drawn))

    two = F.pmod(F.xxhash64("node", F.lit(0)), F.lit(10_000)) < round(10_000 * law.two)
    return F.explode(F.when(two, F.array(child(1), child(2))).otherwise(F.array(child(1))))


def _sized(rows: DataFrame) -> DataFrame:
    """Rows (node, cid) of the nodes that hold two classes or more, with the node's size and a sum that tells its classes."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.sum(F.shiftright(F.xxhash64("cid"), 16)).alias("who"))
    return rows.join(sizes.filter("size > 1"), "node")


def _distinct_nodes(rows: DataFrame) -> DataFrame:
    """``rows`` without nodes that hold the same classes as another."""
    nodes = rows.select("node", "size", "who").groupBy("size", "who").agg(F.min("node").alias("node")).select("node")
    return rows.join(nodes, "node")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), COORDINATES)


def _pairs_by_sketch(rows: DataFrame, law: Law) -> DataFrame:
    """a, b of the rows (cid, n, sketch, other, other_n, other_sketch) whose sketches and sizes make a link likely."""
    likely = law.likely

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(batch.column(2)) == _matrix(batch.column(5))).sum(1) >= likely
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3)], ["a", "b"]).filter(pa.array(same))

    pairs = rows.select("cid", "n", "sketch", "other", "other_n", "other_sketch").filter("cid <> other")
    pairs = pairs.filter(100 * F.least("n", "other_n") >= law.percent * F.greatest("n", "other_n"))
    return _ordered(pairs.mapInArrow(run, "a long, b long"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows with one value in the first column, of rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            if held and held[0].column(0)[0].as_py() != values[begin]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


@dataclass
class Block:
    """Classes that are compared, those on the left with those on the right."""

    cids: np.ndarray
    labels: np.ndarray
    sizes: np.ndarray
    drawn: np.ndarray
    left: np.ndarray
    right: np.ndarray
    law: Law

    @classmethod
    def of(cls, table: pa.Table, law: Law) -> Block:
        get = lambda name: table.column(name).combine_chunks().to_numpy(zero_copy_only=False)
        drawn = _matrix(table.column("sketch").combine_chunks())
        return cls(get("cid"), np.unique(get("comp"), return_inverse=True)[1], get("n"), drawn, get("left"), get("right"), law)

    def equal_tokens(self) -> np.ndarray:
        """For each pair how many tokens agree; zero where it is out of the question or comes up twice."""
        m = len(self.cids)
        same = np.zeros((m, m), dtype=np.uint8)
        places = np.arange(m)
        for i in np.flatnonzero(self.left):
            fits = self.right & (self.labels != self.labels[i]) & ~(self.left & self.right[i] & (places <= i))
            sizes = self.sizes
            fits &= 100 * np.minimum(sizes, sizes[i]) >= self.law.percent * np.maximum(sizes, sizes[i])
            at = np.flatnonzero(fits)
            if len(at):
                same[i, at] = (self.drawn[at] == self.drawn[i]).sum(1)
        same[same < self.law.possible] = 0
        return same

    def parts(self) -> np.ndarray:
        """For each class a number of the part of the block that chains of possible links join it to; -1 without any."""
        same = self.equal_tokens() > 0
        same |= same.T
        part = np.arange(len(self.cids))
        for i in range(len(part)):
            near = np.unique(part[same[i]])
            if len(near) > 1 or len(near) == 1 and near[0] != part[i]:
                part[np.isin(part, near)] = part[i]
        return np.where(same.any(1), part, -1)

    def links(self, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        """A forest of links, tested on the full sets, that joins all classes that links join.

        Pairs come up with the likeliest first. Those of one component by then need no test, and no
        pair is tested twice.
        """
        same = self.equal_tokens()
        same = np.maximum(same, same.T)
        labels, made = self.labels.copy(), []
        for level in [*range(COORDINATES, int(self.law.likely), -4), 1]:
            for i in np.flatnonzero((same >= level).any(1)):
                step = 4
                while len(at := np.flatnonzero((same[i] >= level) & (labels != labels[i]))):
                    at = at[np.argsort(-same[i, at].astype(int), kind="stable")[:step]]
                    step *= 4
                    same[i, at] = same[at, i] = 0
                    for j in at[linked_to(sets[i], [sets[j] for j in at], self.law.percent)]:
                        if labels[j] != labels[i]:
                            made.append((i, j))
                            labels[labels == labels[j]] = labels[i]
        return made


class Join:
    """The steps of the join over the classes of a table."""

    def __init__(self, docs: DataFrame, leaf: int = LEAF, percent: int = PERCENT):
        self.docs, self.leaf, self.law = docs, leaf, Law(percent)
        self.rows = saved(sketches(docs))
        place = F.struct("doc_id", "text_key")
        first = F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), place)), F.min(place))
        self.classes = saved(
            self.rows.filter("n_shingles > 0")
            .groupBy("set_key")
            .agg(first.alias("first"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
            .select("set_key", F.col("first.doc_id").alias("min_id"), F.col("first.text_key").alias("min_key"), "n", "sketch")
            .withColumn("cid", F.monotonically_increasing_id())
        )
        self.sets: DataFrame | None = None
        self.tested = self.links = self.roots = None

    def sketched(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.classes.select("cid", "n", "sketch"), "cid")

    def labelled(self, rows: DataFrame) -> DataFrame:
        if self.roots is None:
            return rows.withColumn("comp", F.col("cid"))
        joined = rows.join(self.roots, rows["cid"] == self.roots["member"], "left")
        return joined.withColumn("comp", F.coalesce("root", "cid")).drop("member", "root")

    def confirm(self, pairs: DataFrame) -> None:
        """Test pairs on the full sets, and renew the components."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = saved(pairs)
        if pairs.isEmpty():
            return
        one = self.sets.select(F.col("cid").alias("a"), F.col("found").alias("one"))
        two = self.sets.select(F.col("cid").alias("b"), F.col("found").alias("two"))
        percent = self.law.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = ([np.frombuffer(f, dtype=np.uint64) for f in batch.column(i).to_pylist()] for i in (2, 3))
                keep = pa.array([linked(x, y, percent) for x, y in zip(*sets)], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

        joined = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
        links = saved(joined.mapInArrow(run, "a long, b long"))
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        if links.isEmpty():
            return
        self.links = links if self.links is None else self.links.union(links)
        self.roots = components(self.links)

    def compared(self) -> DataFrame:
        """Rows (block, cid, left, right) of all parts of nodes in which links are possible."""
        level = saved(_sized(self.classes.select("cid", _root_nodes(self.law).alias("node"))))
        first, later = self._parts(self._leaves(level)), []
        large = level.filter(F.col("size") > self.leaf).select("node", "cid")
        wanted = first.select("cid").union(large.select("cid")).distinct()
        wanted = wanted.join(self.classes, "cid").select("cid", "set_key", "min_id", "min_key")
        self.sets = saved(_sets(self.docs, wanted).dropDuplicates(["cid"]) if self._repeated() else _sets(self.docs, wanted))
        depth = 0
        while not large.isEmpty():
            self._thin(large, depth)
            rows = self.labelled(large)
            shares = rows.groupBy("node", "comp").agg(F.count("*").alias("n"))
            main = shares.groupBy("node").agg(F.sum("n").alias("size"), F.max(F.struct("n", "comp")).alias("main"))
            rest = main.select("node", "size", F.col("main.comp").alias("main"), (F.col("size") - F.col("main.n")).alias("outside"))
            rows = saved(rows.join(rest.filter("outside > 0"), "node"))
            few = F.lit(True) if depth >= DEEPEST else F.col("outside") <= self.leaf
            later.append(self._grid(rows.filter(few)))
            going = self.sketched(rows.filter(~few).select("node", "cid"))
            level = saved(_sized(going.select("cid", _branches(self.law).alias("node"))))
            later.append(self._leaves(level))
            large = level.filter(F.col("size") > self.leaf).select("node", "cid")
            depth += 1
        # Cut into parts once for all depths, with the components as they are by now.
        return first.union(self._parts(reduce(DataFrame.union, later))) if later else first

    def _leaves(self, level: DataFrame) -> DataFrame:
        small = _distinct_nodes(level.filter(F.col("size") <= self.leaf))
        return small.select(F.col("node").alias("block"), "cid", F.lit(True).alias("left"), F.lit(True).alias("right"))

    def _repeated(self) -> bool:
        """Whether rows share doc_id and text, and so would give a set twice."""
        return not self.rows.filter("n_shingles > 0").groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty()

    def _thin(self, large: DataFrame, depth: int) -> None:
        """Compare the classes of each large node to one of them."""
        rows = self.sketched(large)
        first = rows.groupBy("node").agg(F.min(F.struct(F.xxhash64("cid", F.lit(depth)).alias("h"), "cid", "n", "sketch")).alias("p"))
        pivots = first.select("node", F.col("p.cid").alias("other"), F.col("p.n").alias("other_n"), F.col("p.sketch").alias("other_sketch"))
        self.confirm(_pairs_by_sketch(rows.join(pivots, "node"), self.law))

    def _grid(self, rows: DataFrame) -> DataFrame:
        """Blocks in which those outside the main component of a node, by LEAF, meet all, by LEAF."""
        lefts = F.ceil(F.col("outside") / self.leaf).cast("int")
        rights = F.ceil(F.col("size") / self.leaf).cast("int")
        i, j = (F.pmod(F.xxhash64("cid", F.lit(salt)), n).cast("int") for salt, n in ((1, lefts), (2, rights)))
        left = rows.filter("comp <> main").select(
            "node", "cid", i.alias("i"), F.explode(F.sequence(F.lit(0), rights - 1)).alias("j"), F.lit(True).alias("left")
        )
        right = rows.select(
            "node", "cid", F.explode(F.sequence(F.lit(0), lefts - 1)).alias("i"), j.alias("j"), F.lit(False).alias("left")
        )
        both = left.union(right).select(F.xxhash64("node", "i", "j").alias("block"), "cid", "left")
        return both.groupBy("block", "cid").agg(F.max("left").alias("left"), F.max(~F.col("left")).alias("right"))

    def _parts(self, blocks: DataFrame) -> DataFrame:
        """The parts of blocks in which links are possible, as blocks of their own."""
        rows = self.labelled(self.sketched(blocks)).select("block", "cid", "comp", "n", "sketch", "left", "right")
        law = self.law

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _groups(batches):
                block = Block.of(table, law)
                part = block.parts()
                at = np.flatnonzero(part >= 0)
                if len(at):
                    name = table.column("block")[0].as_py() ^ shingles.mixed(block.cids[part[at]].astype(np.uint64)).astype(np.int64)
                    columns = [name, block.cids[at], block.left[at], block.right[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "cid", "left", "right"])

        rows = rows.repartition("block").sortWithinPartitions("block")
        return saved(rows.mapInArrow(run, "block long, cid long, left boolean, right boolean"))

    def _linked(self, blocks: DataFrame) -> DataFrame:
        """Links (a, b) that join the components of each block."""
        rows = self.labelled(self.sketched(blocks).join(self.sets, "cid"))
        rows = rows.select("block", "cid", "comp", "n", "sketch", "left", "right", "found")
        law = self.law

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _groups(batches):
                block = Block.of(table, law)
                sets = [np.frombuffer(f, dtype=np.uint64) for f in table.column("found").to_pylist()]
                if links := block.links(sets):
                    i, j = np.array(links).T
                    yield pa.RecordBatch.from_arrays([pa.array(block.cids[i]), pa.array(block.cids[j])], ["a", "b"])

        rows = rows.repartition("block").sortWithinPartitions("block")
        return saved(rows.mapInArrow(run, "a long, b long"))

    def run(self) -> DataFrame:
        """member (a class) and root of all classes that have links."""
        blocks = self.compared()
        parts = blocks.groupBy("block").agg(
            F.count("*").alias("size"),
            F.sum(F.shiftright(F.xxhash64("cid", "left", "right"), 16)).alias("who"),
        )
        distinct = parts.groupBy("size", "who").agg(F.min("block").alias("block")).select("block")
        links = self._linked(blocks.join(distinct, "block"))
        self.roots = components(links if self.links is None else links.union(self.links))
        return self.roots


def near_duplicates(docs: DataFrame, leaf: int = LEAF, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id is its component's) for every row of ``docs``."""
    join = Join(docs, leaf, percent)
    roots = join.run()
    classes = join.classes.select("set_key", "min_id", "cid").join(roots, F.col("cid") == F.col("member"), "left")
    classes = classes.withColumn("root", F.coalesce("root", "cid")).select("set_key", "min_id", "root")
    least = classes.groupBy("root").agg(F.min("min_id").alias("least"))
    named = saved(classes.join(least, "root").select("set_key", "least"))
    found = join.rows.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def dedup(docs: DataFrame, leaf: int = LEAF, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, all columns as they were.

    It is the row of the smallest doc_id (null if there is no other), of texts that share it the one
    with the smallest hash, and of equal rows any one. Rows without words are linked with nothing and all stay.
    """
    join = Join(docs, leaf, percent)
    roots = join.run()
    classes = join.classes.select("set_key", "cid").join(roots, F.col("cid") == F.col("member"), "left")
    found = join.rows.select("doc_id", "text_key", "n_shingles", "set_key").join(
        classes.select("set_key", F.coalesce("root", "cid").alias("root")), "set_key", "left"
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    worded = found.filter("n_shingles > 0")
    winners = worded.groupBy("root").agg(first.alias("w")).select("w.doc_id", "w.text_key", F.lit(True).alias("__one"))
    others = found.filter("n_shingles = 0").select("doc_id", "text_key", F.lit(False)).distinct()
    winners = saved(winners.union(others)).withColumnsRenamed({"doc_id": "__id", "text_key": "__text"})
    told, back = apart(docs, "doc_id", "text")
    keyed = told.withColumn("__key", F.xxhash64(text_or_empty()))
    kept = keyed.join(winners, keyed["doc_id"].eqNullSafe(winners["__id"]) & (keyed["__key"] == winners["__text"]))
    rows, pairs = (df.count() for df in (worded, worded.select("doc_id", "text_key").distinct()))
    if rows > pairs:
        # Of rows equal in doc_id and text one stays; each task first cuts its own.
        place = Window.partitionBy("__id", "__text").orderBy("__key")
        once = kept.filter("__one").withColumn("__place", F.row_number().over(place)).filter("__place = 1")
        kept = once.drop("__place").union(kept.filter("not __one"))
    return back(kept)
