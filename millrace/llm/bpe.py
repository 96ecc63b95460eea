"""BPE encoding and decoding with a vocabulary in the JSON form of the tokenizers library.

A word is held as a contiguous array of parts and, beside it, the merge ranks of
adjacent parts. The smallest rank is found by a scan, the boundary it stands for
is deleted and the two ranks next to it are looked up again. Scans beat any queue
on short words; words of more than SHORT parts are merged with a heap instead, so
that a text without a single break costs n log n. Each worker keeps the ids of
the words it has met in a cache of bounded size.

Defined results: a null text counts as empty and has no ids; rows that share a
doc_id are encoded each for itself; a null doc_id stays null; an empty table
gives an empty result. Columns other than those named do not matter. Special
tokens in a text become their ids, as the library does by default.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millrace.llm.common import pick

#: Words of up to so many parts are merged by scans.
SHORT = 200
#: Words a worker remembers; the cache starts again beyond.
REMEMBERED = 300_000
#: Characters of text handed on in one Arrow batch, one text at least.
BATCH_CHARS = 4_000_000

_NONE = 1 << 62
_ID_BITS = 24
_ID_MASK = (1 << _ID_BITS) - 1


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Bytes that print in Latin-1 stand for themselves; the others, in order, are
    the letters from 256 on.
    """
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = {b: chr(b) for b in prints}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


class BytePairs:
    """The merges of a vocabulary, applied to one word."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = [self.vocabulary[c] for c in letters]
        self.last = [self.vocabulary[c + end] for c in letters]
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            made = self.vocabulary[left + right]
            self.pairs.setdefault((self.vocabulary[left], self.vocabulary[right]), rank << _ID_BITS | made)

    def encode(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        inner = self.inner
        parts = [inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        if len(parts) > SHORT:
            return self._by_heap(parts)
        look = self.pairs.get
        ranks = [look(pair, _NONE) for pair in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != _NONE:
            at = ranks.index(low)
            parts[at] = low & _ID_MASK
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = look((parts[at - 1], parts[at]), _NONE)
            if at < len(ranks):
                ranks[at] = look((parts[at], parts[at + 1]), _NONE)
        return parts

    def _by_heap(self, parts: list[int]) -> list[int]:
        look, n = self.pairs.get, len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(rank, at) for at, pair in enumerate(zip(parts, parts[1:])) if (rank := look(pair, _NONE)) != _NONE]
        heapq.heapify(heap)
        alive = bytearray(b"\1" * n)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            if not alive[at] or right < 0 or look((parts[at], parts[right]), _NONE) != rank:
                continue
            parts[at], alive[right], after[at] = rank & _ID_MASK, 0, after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] >= 0:
                    if (made := look((parts[left], parts[after[left]]), _NONE)) != _NONE:
                        heapq.heappush(heap, (made, left))
        return [part for part, lives in zip(parts, alive) if lives]


class Remembered(dict):
    """What ``make`` gives for a key, kept for up to ``limit`` keys."""

    def __init__(self, make: Callable, limit: int = REMEMBERED):
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Splitter:
    """Cuts a text into words and special tokens, as a JSON vocabulary asks for."""

    # The pattern of byte-level vocabularies that name none.
    BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    # White space in Unicode, which the module's \s exceeds by four control characters.
    SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

    def __init__(self, spec: dict):
        steps = self._flat(spec.get("normalizer"), "normalizers")
        kinds = [step["type"] for step in steps]
        if set(kinds) - {"NFC", "Replace", "Lowercase"}:
            raise ValueError(f"normalizers {kinds} are not supported")
        cuts = self._flat(spec["pre_tokenizer"], "pretokenizers")
        self.composed, self.lower = "NFC" in kinds, "Lowercase" in kinds
        pattern = next((c["pattern"]["Regex"] for c in cuts if c["type"] == "Split"), self.BYTE_LEVEL)
        pattern = pattern.replace(r"[^\s", f"[^{self.SPACE}").replace(r"(?!\S)", f"(?![^{self.SPACE}])")
        self.words = regex.compile(pattern.replace(r"\s", f"[{self.SPACE}]")).findall
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        names = sorted(self.specials, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None

    @staticmethod
    def _flat(step: dict | None, inside: str) -> list[dict]:
        return [] if step is None else step[inside] if step["type"] == "Sequence" else [step]

    def pieces(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """(id, []) for a special token, (None, words) for what lies between."""
        if self.cut is None or not any(name in text for name in self.specials):
            yield None, self.words(self.normal(text))
            return
        for piece in self.cut(text):
            if piece in self.specials:
                yield self.specials[piece], []
            elif piece:
                yield None, self.words(self.normal(piece))

    def normal(self, text: str) -> str:
        if not text.isascii() and self.composed:
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            # Letter by letter: a final sigma is not told apart.
            text = text.replace("Σ", "σ").lower()
        return text


class Encoder:
    """Ids of whole texts."""

    def __init__(self, source: str):
        spec = json.loads(source)
        self.split = Splitter(spec)
        self.pairs = BytePairs(spec)
        self.packed = Remembered(lambda word: array("i", self.pairs.encode(word)).tobytes())
        self.tokens = {i: t for t, i in self.pairs.vocabulary.items()} | {i: t for t, i in self.split.specials.items()}

    def packed_ids(self, text: str) -> bytes:
        """The ids, 32 bits each."""
        return b"".join(
            array("i", [special]).tobytes() if special is not None else b"".join(map(self.packed.__getitem__, words))
            for special, words in self.split.pieces(text)
        )


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _in_parts(batch: pa.RecordBatch, column: int, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``chars`` bytes in a column of texts or lists."""
    start, held = 0, 0
    for at, size in enumerate(_sizes(batch.column(column))):
        if held and held + size > chars:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _sizes(values: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    sizes = pc.binary_length(values) if pa.types.is_string(values.type) else pc.list_value_length(values)
    return pc.fill_null(sizes, 0).to_pylist()


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and ``ids``, the array of token ids, for every text of ``docs``.

    ``vocabulary`` is the path of the JSON file on the driver; its content, some megabytes
    whatever the corpus is, goes to the workers in a broadcast.
    """
    docs = pick(docs, "doc_id", "text")
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(source.value)
        for whole in batches:
            for batch in _in_parts(whole, 1):
                texts = batch.column(1).to_pylist()
                packed = [encoder.packed_ids(text) if text else b"" for text in texts]
                starts = [0]
                for ids in packed:
                    starts.append(starts[-1] + len(ids) // 4)
                values = pa.Array.from_buffers(pa.int32(), starts[-1], [None, pa.py_buffer(b"".join(packed))])
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids and ``decoded``: the tokens of the ids, special ones too.

    The vocabulary names no decoder, and then the library puts a space between tokens.
    Null ids give an empty text.
    """
    encoded = pick(encoded, "doc_id", "ids")
    source = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec = json.loads(source.value)
        if spec.get("decoder") is not None:
            raise ValueError("only vocabularies without a decoder can be decoded")
        token = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        for whole in batches:
            for batch in _in_parts(whole, 1, BATCH_CHARS // 4):
                texts = [" ".join(map(token.__getitem__, ids or ())) for ids in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
