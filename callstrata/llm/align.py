"""Alignment of two tokenizers' ids over the same bytes, by diagonal run skipping."""

from __future__ import annotations

import hashlib
import uuid
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import STORES, limit_batches, remember_only, slices, stored
from callstrata.llm.tokens import BYTE_WORDS, LOOSE_SPACE, OTHER, byte_letters, task_number
from callstrata.session import use_checkpoint_dir

#: Pieces of text that are aligned at once, and pieces and texts between spaces a Python worker remembers.
PIECES, REMEMBERED = 100_000, 250_000
#: Id pairs whose counts are sent to every task at once (17 bytes each); more are taken in blocks.
PAIRS = 2_000_000
#: Id pairs in one row of a task's counts.
ROW = 100_000


def align(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Irregular groups of two lists of byte ends whose last ends are equal.

    Returns the places in a and b of every pair of tokens that overlap in an irregular group, and the places of
    the groups' last tokens. Tokens outside them match one to one, in order. As long as both lists have
    the same ends at the present shift of their places, blocks of doubling size are compared and jumped; the
    block that differs is halved down to the first difference. There a group is walked to its next common
    end, after which the shift is that group's.
    """
    i = j = 0
    n = len(a)
    left, right, last_left, last_right = [], [], [], []
    while i < n:
        size = 1
        while a[i:i + size] == b[j:j + size]:
            i, j, size = i + size, j + size, size + size
            if i >= n:
                return left, right, last_left, last_right
        while size > 1:
            size >>= 1
            if a[i:i + size] == b[j:j + size]:
                i, j = i + size, j + size
        x, y = a[i], b[j]
        while x != y:
            left.append(i)
            right.append(j)
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        left.append(i)
        right.append(j)
        last_left.append(i)
        last_right.append(j)
        i, j = i + 1, j + 1
    return left, right, last_left, last_right


class Side:
    """Ids of remembered pieces in one flat list, with the bytes each id stands for."""

    def __init__(self, parts: list[bytes]):
        self.parts = parts
        self.width = np.array([len(x) for x in parts], np.int64)
        self.clear()

    def clear(self) -> None:
        self.flat, self.first = array("i"), array("q", [0])

    def add(self, ids: Iterable[int], counts: np.ndarray) -> None:
        """Pieces with so many ids each."""
        self.flat.extend(ids)
        self.first.frombytes((self.first[-1] + np.cumsum(counts)).tobytes())

    def spell(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.parts.__getitem__, ids))

    def sizes(self, n: int) -> np.ndarray:
        """Bytes that each of the last n pieces' ids stand for."""
        first = np.frombuffer(self.first, np.int64)[-n - 1:]
        upto = np.concatenate([[0], np.cumsum(self.width[np.frombuffer(self.flat, np.int32)[first[0]:]])])
        return np.diff(upto[first - first[0]])

    def of(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and the number of ids of each."""
        flat, first = np.frombuffer(self.flat, np.int32) if self.flat else np.zeros(0, np.int32), np.frombuffer(self.first, np.int64)
        counts = first[slots + 1] - first[slots]
        before = np.cumsum(counts) - counts
        return flat[np.repeat(first[slots] - before, counts) + np.arange(counts.sum())], counts


class Both:
    """Ids of texts under a byte-level tokenizer and a piece model, piece by piece.

    A text is cut where neither tokenizer can merge across: at the first one's words, joined again
    where some entry of the piece model holds the two letters at the cut. Pieces are encoded once and
    remembered. Texts with letters outside Latin, or with spaces that do not stand before a word, are
    one piece each, encoded whole by both libraries.
    """

    _kept: dict[tuple[str, str], Both] = {}

    @classmethod
    def at(cls, bytes_file: str, pieces_file: str) -> Both:
        key = (bytes_file, pieces_file)
        if key not in cls._kept:
            cls._kept[key] = cls(*key)
        return cls._kept[key]

    def __init__(self, bytes_file: str, pieces_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(bytes_file)
        self.library.encode_special_tokens = True
        self.model, self.letters = self.library.model, byte_letters()
        back = {ord(c): b for b, c in self.letters.items()}
        named = {i: s for s, i in self.library.get_vocab(with_added_tokens=True).items()}
        ranks = range(max(named) + 1)
        self.a = Side([bytes(back.get(ord(c), 0) for c in named.get(i, "")) for i in ranks])
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
        size = self.pieces.get_piece_size()
        shown = [self.pieces.id_to_piece(i) for i in range(size)]
        self.b = Side([bytes([int(s[3:5], 16)]) if self.pieces.is_byte(i) else s.replace("▁", " ").encode()
                       for i, s in enumerate(shown)])
        self.joined = {s[k:k + 2] for i, s in enumerate(shown) if not self.pieces.is_byte(i) for k in range(len(s) - 1)}
        self.lead = self.pieces.encode("\n")  # no entry holds a line end, so what follows is cut off from it
        self.chunks: dict[str, bytes] = {}
        self.slots: dict[str, int] = {}
        self.good = bytearray()
        STORES.append(self)

    def clear(self) -> None:
        for x in (self.chunks, self.slots, self.a, self.b, self.good):
            x.clear()

    def _add(self, data: list[bytes], a: list[list[int]], b: list[list[int]]) -> int:
        """Remember pieces of text; returns the first one's slot."""
        for side, ids in ((self.a, a), (self.b, b)):
            side.add(chain.from_iterable(ids), np.fromiter(map(len, ids), np.int64, len(ids)))
        whole, sizes = b"".join(data), list(map(len, data))
        if all(side.spell(chain.from_iterable(ids)) == whole and np.array_equal(side.sizes(len(ids)), sizes)
               for side, ids in ((self.a, a), (self.b, b))):
            self.good += b"\1" * len(data)
        else:
            self.good += bytes(self.a.spell(x) == d == self.b.spell(y) for d, x, y in zip(data, a, b, strict=True))
        return len(self.good) - len(data)

    def _cut(self, chunk: str) -> list[str]:
        found = BYTE_WORDS.findall(chunk)
        out = found[:1]
        for piece in found[1:]:
            if out[-1][-1] + piece[0] in self.joined:
                out[-1] += piece
            else:
                out.append(piece)
        return out

    def learn(self, chunks: set[str]) -> None:
        """Remember what stands between spaces, as its pieces with the space before it."""
        cuts = [[" " + c] if c.isalpha() else self._cut(" " + c) for c in chunks]
        new = list(set(chain.from_iterable(cuts)).difference(self.slots))
        if new:
            lead, tokenize, letters = len(self.lead), self.model.tokenize, self.letters
            a = []
            for piece in new:
                words = (piece,) if piece[1:].isalpha() else BYTE_WORDS.findall(piece)
                a.append([t.id for w in words for t in tokenize(w.encode().decode("latin-1").translate(letters))])
            b = [x[lead:] for x in self.pieces.encode(["\n" + p for p in new], num_threads=1)]
            first = self._add([p.encode() for p in new], a, b)
            self.slots.update(zip(new, range(first, first + len(new))))
        slots = self.slots
        for c, own in zip(chunks, cuts, strict=True):
            self.chunks[c] = array("i", [slots[p] for p in own]).tobytes()

    def _whole(self, text: str) -> bytes:
        a = self.library.encode(" " + text, add_special_tokens=False).ids
        data = (" " + text).encode("utf-8", "surrogatepass")
        return array("i", [self._add([data], [a], [self.pieces.encode(text)])]).tobytes()

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """The slots of every text's pieces; none if a text is null, empty or not spelled by its ids."""
        if len(self.good) > REMEMBERED or len(self.chunks) > REMEMBERED:
            self.clear()
        cut = [x.split(" ") if x and not OTHER.search(x) and not LOOSE_SPACE.search(" " + x) else None for x in texts]
        known = self.chunks
        self.learn(set(chain.from_iterable(own for own in cut if own)).difference(known))
        out = []
        for text, own in zip(texts, cut, strict=True):
            if own:
                data = b"".join(map(known.__getitem__, own))
            else:
                data = self._whole(text) if text else b""
            slots = np.frombuffer(data, np.int32)
            out.append(slots if np.frombuffer(self.good, np.uint8)[slots].all() else slots[:0])
        return out


class Tally:
    """Sums by key, kept sorted and merged when as much again has been added."""

    def __init__(self):
        self.keys, self.sums, self.added = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.added.append((keys, times))
        if sum(len(k) for k, _ in self.added) > max(len(self.keys), 1_000_000):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.added]])
        times = np.concatenate([self.sums, *[t for _, t in self.added]])
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        at = np.flatnonzero(np.diff(keys, prepend=-1))
        self.keys, self.sums, self.added = keys[at], np.add.reduceat(times, at) if len(at) else times, []


class Aligner:
    """Aligns texts a bounded number of pieces at a time."""

    def __init__(self, both: Both):
        self.both, self.radix = both, len(both.b.parts)
        #: every id with what follows it inside its group and at the end of its group's half
        self.written = pa.array([f"{i}{m}" for side, marks in ((both.a, ",|"), (both.b, ",;"))
                                 for m in marks for i in range(len(side.parts))])

    def texts(self, texts: list[str | None]):
        """Per text [n_a, n_b, n_groups, n_links, digest, id pairs, times of each]."""
        out = [[0, 0, 0, 0, None, [], []] for _ in texts]
        held, size = [], 0
        for doc, slots in enumerate(self.both.of(texts)):
            for at in range(0, len(slots), PIECES):
                part = slots[at:at + PIECES]
                if size + len(part) > PIECES:
                    self._aligned(held, out)
                    held, size = [], 0
                held.append((doc, part))
                size += len(part)
        if held:
            self._aligned(held, out)
        for row in out:
            row[4] = row[4].hexdigest() if row[4] else ""
            if len(row[5]) > 1:
                tally = Tally()
                tally.added = list(zip(row[5], row[6], strict=True))
                tally.merge()
                row[5:] = [tally.keys], [tally.sums]
        return out

    def _aligned(self, held: list[tuple[int, np.ndarray]], out: list[list]) -> None:
        slots = np.concatenate([s for _, s in held])
        upto = np.cumsum([len(s) for _, s in held])
        (a, count_a), (b, count_b) = self.both.a.of(slots), self.both.b.of(slots)
        ends_a, ends_b = np.cumsum(self.both.a.width[a]), np.cumsum(self.both.b.width[b])
        odd_left, odd_right, last_left, last_right = (np.array(x, np.int64) for x in align(ends_a.tolist(), ends_b.tolist()))
        plain_a, plain_b = np.ones(len(a), bool), np.ones(len(b), bool)
        plain_a[odd_left] = plain_b[odd_right] = False
        left = np.concatenate([np.flatnonzero(plain_a), odd_left])
        right = np.concatenate([np.flatnonzero(plain_b), odd_right])
        plain_a[last_left] = plain_b[last_right] = True  # now: the last token of its group
        group_a, group_b = np.flatnonzero(plain_a) + 1, np.flatnonzero(plain_b) + 1  # tokens up to each group's end
        # where every token stands in "a,a|b;a|b,b;"
        place_a = np.arange(len(a)) + np.repeat(np.concatenate([[0], group_b[:-1]]), np.diff(group_a, prepend=0))
        place_b = np.arange(len(b)) + np.repeat(group_a, np.diff(group_b, prepend=0))
        order = np.empty(len(a) + len(b), np.int64)
        order[place_a] = a + plain_a * len(self.both.a.parts)
        order[place_b] = b + plain_b * self.radix + 2 * len(self.both.a.parts)
        spelled = self.written.take(pa.array(order))
        letters, places = memoryview(spelled.buffers()[2]), np.frombuffer(spelled.buffers()[1], np.int32)
        edge_a, edge_b = (np.concatenate([[0], np.cumsum(c)])[np.concatenate([[0], upto])] for c in (count_a, count_b))
        groups = np.searchsorted(group_a, edge_a, "right")
        owner = np.searchsorted(edge_a, left, "right") - 1
        links = np.bincount(owner, minlength=len(held))
        keys = np.sort(owner * (len(self.both.a.parts) * self.radix) + a[left].astype(np.int64) * self.radix + b[right])
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.diff(first, append=len(keys))
        keys = keys[first]
        span = len(self.both.a.parts) * self.radix
        cuts = np.searchsorted(keys, np.arange(len(held) + 1) * span)
        for k, (doc, _) in enumerate(held):
            row = out[doc]
            row[0] += int(edge_a[k + 1] - edge_a[k])
            row[1] += int(edge_b[k + 1] - edge_b[k])
            row[2] += int(groups[k + 1] - groups[k])
            row[3] += int(links[k])
            begin, end = places[edge_a[k] + edge_b[k]], places[edge_a[k + 1] + edge_b[k + 1]]
            if row[4] is None:
                row[4] = hashlib.sha256()
            else:
                row[4].update(b";")
            row[4].update(letters[begin:end - 1])
            row[5].append(keys[cuts[k]:cuts[k + 1]] - k * span)
            row[6].append(times[cuts[k]:cuts[k + 1]])

COLUMNS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def aligned(docs: DataFrame, bytes_file: str, pieces_file: str) -> DataFrame:
    """A row per row of docs (task null): doc_id, the counts and digest of its alignment, and its id pairs with
    their times; and rows of each task (task set) with the pairs of all its documents."""
    limit_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Both.at(bytes_file, pieces_file)
        remember_only(both)
        aligner, tally, kind = Aligner(both), Tally(), None

        def batch_of(ids, tasks, rows):
            offsets = pa.array(np.concatenate([[0], np.cumsum([sum(map(len, r[5])) for r in rows])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int64), *[x for r in rows for x in r[k]]]))) for k in (5, 6)]
            numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            return pa.RecordBatch.from_arrays(
                [ids, *numbers, pa.array([r[4] for r in rows], pa.string()), *lists, pa.array(tasks, pa.int32())],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", "task"])

        for batch in batches:
            kind = batch.column(0).type
            for at, texts in slices(batch.column(1)):
                rows = aligner.texts(texts)
                for r in rows:
                    for keys, times in zip(r[5], r[6], strict=True):
                        tally.add(keys, times)
                yield batch_of(batch.column(0).slice(at, len(texts)), [None] * len(texts), rows)
        tally.merge()
        for at in range(0, len(tally.keys), ROW):
            row = [0, 0, 0, 0, None, [tally.keys[at:at + ROW]], [tally.sums[at:at + ROW]]]
            yield batch_of(pa.nulls(1, kind), [task_number()], [row])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, {COLUMNS}, pairs array<bigint>, times array<bigint>, task int")


def _kept(rows: DataFrame) -> DataFrame:
    """Rows written to the shared folder; the ascending pairs as differences, which take three bytes each."""
    spark = rows.sparkSession
    path = f"{use_checkpoint_dir(spark).rstrip('/')}/callstrata/aligned-{uuid.uuid4().hex}"
    rows.write.option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false").option(
        "compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _summed(rows: DataFrame, counts) -> DataFrame:
    """rows with n_best and count_sum raised by what the given pairs (sorted; counts; best of their id) add."""
    shared = rows.sparkSession.sparkContext.broadcast(counts)  # at most PAIRS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_only()
        keys, totals, best = shared.value
        for batch in batches:
            lists, names = batch.column("pairs"), batch.schema.names
            pairs, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
            found = np.where(keys[at] == pairs, times, 0)
            upto = [np.concatenate([[0], np.cumsum(x)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()] for x in (found * best[at], found * totals[at])]
            columns = dict(zip(names, batch.columns, strict=True))
            for name, x in zip(("n_best", "count_sum"), upto, strict=True):
                columns[name] = pa.array(columns[name].to_numpy() + np.diff(x))
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return rows.mapInArrow(run, rows.schema)


def tokens_aligned(docs: DataFrame, bytes_file: str, pieces_file: str) -> DataFrame:
    """A row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Whole texts are encoded as space+text by the byte-level tokenizer (A) and as they are by the piece model (B,
    which adds the space), special tokens' strings as plain text. Byte offsets where tokens of both end cut
    them into groups; tokens whose bytes overlap are linked. A pair of ids counts the links that hold it in
    all documents; n_best are links whose pair has the highest count of its B id (ties too), count_sum
    adds up the counts over links. Null, empty and wordless-by-id texts (ids that do not spell the text) have
    zeros and an empty digest. Repeated rows are documents of their own; empty tables give no rows.

    Texts are encoded once. Counts are summed per task before they meet; distinct pairs are bounded by the
    two vocabularies and reach the tasks in blocks of two million, so no document's pairs are shuffled.
    """
    every = _kept(aligned(docs, bytes_file, pieces_file))
    pair = F.explode(F.arrays_zip("pairs", "times")).alias("p")
    counts = every.where("task IS NOT NULL").select(pair).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    radix = Both.at(bytes_file, pieces_file).b
    counts = stored(counts.withColumn("b", F.col("pair") % len(radix.parts)))
    tops = counts.groupBy("b").agg(F.max("n").alias("top"))
    counts = stored(counts.join(tops, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")))
    blocks = -(-counts.count() // PAIRS)
    zero = F.lit(0).cast("bigint")
    rows = every.where("task IS NULL").drop("task").withColumns({"n_best": zero, "count_sum": zero})
    for block in range(blocks):
        own = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == block).orderBy("pair").toArrow()
        rows = _summed(rows, tuple(own.column(c).to_numpy() for c in ("pair", "n", "best")))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
