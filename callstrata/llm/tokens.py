"""Token ids of whole texts from a tokenizer file of the `tokenizers` library."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import STORES, limit_batches, remember_only, slices

# How two of the public tokenizers cut a text into words before they merge, written
# for texts of the letters below only. Other texts, and other tokenizers, go to the library whole.
BYTE_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:_|[^\s\w])+|\s+(?!\S)|\s+")
LOWER_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:_|[^\s\w])+")
OTHER = re.compile("[^\t\n\r -~¡§«°·»¿-įı-ňŊ-ž]")
BYTE_RULE = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
LOWER_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A space that does not stand before a word; such texts are cut by the pattern alone.
LOOSE_SPACE = re.compile(r" (?:\s|$)")
#: Marks behind a letter and before white space are a word of their own (an apostrophe may belong to a letter).
MARKS = r"(\p{L})([^\p{L}\p{N}\s']+)(\s)"
#: Words of a table before it is emptied (some 40 bytes each).
TABLED = 800_000
#: Words a Python worker remembers in each of two generations (some 80 MB in all).
REMEMBERED = 200_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, others numbered from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) if b in printable else chr(256 + hidden.index(b)) for b in range(256)}


class Known(dict):
    """What `make` says of a word, remembered; when full, words not met since the last time are forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}
        STORES.append(self)

    def clear(self) -> None:
        self.older = {}
        super().clear()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            older = dict(self)
            self.clear()
            self.older = older
        found = self.older.get(word)
        value = self[word] = self.make(word) if found is None else found
        return value


class Table:
    """Words numbered in the order met, and their ids one behind the other; when full, all are forgotten."""

    def __init__(self):
        STORES.append(self)
        self.clear()

    def clear(self) -> None:
        self.words, self.lengths, self.ids = pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, "<i4")

    def numbers(self, words: pa.Array, make) -> np.ndarray:
        """The number of each word; `make` gives the ids of a word that is not known yet."""
        if len(self.words) > TABLED:
            self.clear()
        words = words.cast(pa.string())
        found = pc.index_in(words, value_set=self.words)
        new = found.is_null()
        out = found.fill_null(0).to_numpy(zero_copy_only=False).copy()
        coded = words.filter(new).dictionary_encode()
        out[new.to_numpy(zero_copy_only=False)] = coded.indices.to_numpy() + len(self.words)
        ids = [make(x) for x in coded.dictionary.to_pylist()]
        self.words = pa.concat_arrays([self.words, coded.dictionary])
        self.lengths = np.concatenate([self.lengths, np.array([len(x) // 4 for x in ids], np.int32)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<i4")])
        return out


class Encoder:
    """Ids of texts. The merges of a word do not depend on its neighbours, so the library's model is
    asked once for each new word and the answer remembered."""

    _kept: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec.get("pre_tokenizer") or {}
        self.cut, self.lower = None, False
        if not spec.get("normalizer") and cut == BYTE_RULE:
            self.cut = BYTE_WORDS.findall
        elif LOWER_RULE in json.dumps(cut, ensure_ascii=False).replace("\\\\", "\\") and "Lowercase" in json.dumps(spec.get("normalizer")):
            self.cut, self.lower = LOWER_WORDS.findall, True
        added = [x["content"] for x in spec.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        letters, model = byte_letters(), self.library.model
        space = letters[32]

        def merged(word: str) -> bytes:
            return array("I", [t.id for t in model.tokenize(word)]).tobytes()

        def lettered(word: str) -> bytes:
            return merged(word.encode().decode("latin-1").translate(letters))

        def part(text: str) -> bytes:
            if text.isalpha():
                return merged(text) if text.isascii() else lettered(text)
            if text[:-1].isalpha() and not text[-1].isalnum() and not text[-1].isspace():
                return self.parts[text[:-1]] + self.words[text[-1]]  # a word and one mark, as most are
            return b"".join([self.parts[x] if x.isalpha() else self.words[x] for x in self.cut(text)])

        def spaced(text: str) -> bytes:
            if text.isalpha():
                return merged(space + text) if text.isascii() else lettered(" " + text)
            if text[:-1].isalpha() and not text[-1].isalnum() and not text[-1].isspace():
                return self.spaced[text[:-1]] + self.words[text[-1]]  # a word and one mark, as most are
            first, *rest = self.cut(" " + text)
            own = self.spaced[first[1:]] if first[1:].isalpha() else self.words[first]
            return own + b"".join(map(self.words.__getitem__, rest))

        #: ids of what stands between spaces, of the same with the space before it, and of its words
        self.parts, self.spaced, self.words = Known(part), Known(spaced), Known(lettered)
        self.part, self.table = part, Table()

    def _known(self, text: str) -> bool:
        """Whether the text falls apart into words here; others go to the library whole."""
        return bool(self.cut) and not OTHER.search(text) and not (self.added and self.added.search(text))

    def _plain(self, text: str) -> bytes:
        if self.lower:  # white space only separates
            return b"".join(map(self.parts.__getitem__, text.lower().split()))
        if LOOSE_SPACE.search(text):
            return b"".join(map(self.words.__getitem__, self.cut(text)))
        # a space before a word belongs to it, so the text falls apart at every space
        first, *rest = text.split(" ")
        return self.parts[first] + b"".join(map(self.spaced.__getitem__, rest))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes | None] = [self._plain(x) if self._known(x) else None for x in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self._whole([texts[i] for i in rest]), strict=True):
            out[i] = x
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def lists(self, column: pa.Array, texts: list[str], end: bytes) -> pa.ListArray:
        """Ids of each text of a column (`texts`: its texts), with the end id. Where white space only separates,
        words become numbers of the table, and ids are put together from these."""
        if not self.lower:
            return id_lists([x + end for x in self.encode(texts)])
        known = np.array([self._known(x) for x in texts], bool)
        rest = np.flatnonzero(~known)
        if len(rest):
            column = pc.if_else(pa.array(known), column, "")
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(column), MARKS, r"\1 \2\3"))
        ends = words.offsets.to_numpy()[1:]
        codes = self.table.numbers(words.flatten(), self.part)
        # a text that goes to the library is one more word, and so is the end
        more = [*self._whole([texts[i] for i in rest]), end]
        lengths = np.concatenate([self.table.lengths, [len(x) // 4 for x in more]]).astype(np.int32)
        ids = np.concatenate([self.table.ids, np.frombuffer(b"".join(more), "<i4")])
        last = len(lengths) - 1
        codes = np.insert(codes, np.concatenate([ends[rest], ends]), np.concatenate([last - len(rest) + np.arange(len(rest)), np.full(len(texts), last)]))
        own = lengths[codes]
        upto = np.concatenate([[0], np.cumsum(own, dtype=np.int64)])
        # where each id stands among the words' ids, in 32 bits as the offsets of a list are
        places = np.repeat(((np.cumsum(lengths) - lengths)[codes] - upto[:-1]).astype(np.int32), own)
        places += np.arange(upto[-1], dtype=np.int32)
        offsets = upto[np.concatenate([[0], ends + np.cumsum(1 + ~known)])].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[places]))


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """For runs of rows (doc_id, text): the ids of the rows, and their tokens with the end id."""
    encoder, end = Encoder.of(path), np.array([end_id], "<u4").tobytes()
    remember_only(encoder.parts, encoder.spaced, encoder.words)
    for batch in batches:
        for at, texts in slices(batch.column(1)):
            yield batch.column(0).slice(at, len(texts)), [x + end for x in encoder.encode(texts)]


def encoded_lists(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """As `encoded`, with the tokens in a column of lists."""
    encoder, end = Encoder.of(path), np.array([end_id], "<u4").tobytes()
    remember_only(encoder.parts, encoder.spaced, encoder.words, encoder.table)
    for batch in batches:
        column = batch.column(1)
        for at, texts in slices(column, 8_000_000):
            yield batch.column(0).slice(at, len(texts)), encoder.lists(column.slice(at, len(texts)), texts, end)


def id_lists(parts: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def with_crc(rows: DataFrame, column: str = "ids") -> DataFrame:
    """rows with ids_crc32 (of the ids as little-endian unsigned 32-bit integers) in place of the ids."""
    others = [f for f in rows.schema.fields if f.name != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values, offsets = lists.values.to_numpy(zero_copy_only=False).view("<u4"), lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(crc, pa.int64())], [*[f.name for f in others], "ids_crc32"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others)
    return rows.select(column, *[f.name for f in others]).mapInArrow(run, f"{schema}, ids_crc32 bigint")


def task_number() -> int:
    return TaskContext.get().partitionId()


def texts_of(docs: DataFrame) -> DataFrame:
    limit_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
