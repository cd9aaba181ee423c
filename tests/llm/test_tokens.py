import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from callstrata.llm import packing as P
from callstrata.llm import token_store as T
from callstrata.llm import tokens as K
from callstrata.llm.tokens import Encoder, with_crc
from tests.llm.helpers import docs, empty, messy, prose, words

public = pytest.importorskip("public_tokenizers")
FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
TRICKY = [
    "", " ", "\n\n", "a", "it's IT'S we'll 'sx ''s '", "x  y   z \n\n  w\t", "naïve ÉCOLE Straße ÷×¿¡", "a1b22 333 4.5",
    "___ a_b _", "!!??...,, -- '’“”", "漢字かな 🙂🙃", "é é İstanbul ſ ²³ Σίσυφος", "<|endoftext|>a<|startoftext|>",
    "tab\tnl\nff\x0cvt\x0b\x1c\x85\xa0end", "​­", "#$%^&*()", " lead", "trail ", "'", "''ll're",
]


def library(file):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path(file))


@pytest.mark.parametrize("file", FILES)
def test_ids_equal_the_library(file):
    texts = [*TRICKY, prose(1, 40), " ".join(TRICKY), *["".join(x) for x in zip(TRICKY, TRICKY[1:], strict=False)]]
    got = Encoder(public.path(file)).encode(texts)
    want = [x.ids for x in library(file).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_words_are_forgotten_without_harm(monkeypatch):
    monkeypatch.setattr("callstrata.llm.tokens.REMEMBERED", 20)
    encoder = Encoder(public.path(FILES[0]))
    texts = [" ".join(words(i, 30)) for i in range(5)]
    for t in texts:
        assert np.frombuffer(encoder.encode([t])[0], "<u4").tolist() == encoder.library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("most", [800_000, 50])
@pytest.mark.parametrize("file", FILES)
def test_lists_equal_the_library(monkeypatch, file, most):
    """Across batches, with the words numbered once and with a table that is emptied all the time."""
    monkeypatch.setattr(K, "TABLED", most)
    marks = ["'", "',", ",'s", "'.", "!? ", "÷", "×", "é", "Éß", "7", "a", "B", " ", "\n", "re", ".x", "-"]
    rng = np.random.default_rng(3)
    texts = [*TRICKY, prose(1, 40), *["".join(rng.choice(marks, rng.integers(25))) for _ in range(2_000)], *TRICKY]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    got = list(K.encoded_lists(iter([batch.slice(0, 30), batch.slice(30, 900), batch.slice(930), batch.slice(0, 0)]), public.path(file), 2))
    assert [i for ids, _ in got for i in ids.to_pylist()] == list(range(len(texts)))
    want = [[*x.ids, 2] for x in library(file).encode_batch(texts, add_special_tokens=False)]
    assert [x for _, lists in got for x in lists.to_pylist()] == want


def test_a_word_is_looked_up_once():
    asked, table = [], K.Table()
    for words in (["b", "a", "b"], ["a", "", "c", "c"], []):
        numbers = table.numbers(pa.array(words, pa.string()), lambda x: asked.append(x) or np.full(len(x), ord(x or "0"), "<u4").tobytes())
        assert table.words.take(pa.array(numbers)).to_pylist() == words
    assert asked == ["b", "a", "", "c"] and table.lengths.tolist() == [1, 1, 0, 1] and table.ids.tolist() == [98, 97, 99]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, tmp_path):
    df = docs(spark, [(i * 37 % 400, prose(i, i % 9) if i % 11 else None) for i in range(400)])
    T.write_tokens(df, str(tmp_path / "t"), public.path(FILES[1]), 2)
    got = T.read_tokens(spark, str(tmp_path / "t")).orderBy("doc_id").collect()
    own, start = library(FILES[1]), 0
    by = {r["doc_id"]: r["text"] for r in df.collect()}
    for row, doc in zip(got, sorted(by), strict=True):
        ids = [*own.encode(by[doc] or "", add_special_tokens=False).ids, 2]
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids"]) == (doc, start, len(ids), ids)
        start += len(ids)
    crcs = {r["doc_id"]: r["ids_crc32"] for r in with_crc(T.read_tokens(spark, str(tmp_path / "t"))).collect()}
    assert crcs == {r["doc_id"]: crc(r["ids"]) for r in got}


def test_files_can_be_read_in_part(spark, tmp_path):
    import pyarrow.parquet as pq

    df = docs(spark, [(i, prose(i, 5)) for i in range(600)])
    path = str(tmp_path / "t")
    T.write_tokens(df, path, public.path(FILES[1]), 2, row_group_bytes=20_000, page_bytes=2_000, page_rows=50)
    files = sorted((tmp_path / "t" / "ids").glob("*.parquet"))
    meta = pq.ParquetFile(files[0]).metadata
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert any("DICTIONARY" in e for e in ids.encodings)
    assert any("DELTA" in e for e in columns["doc_id"].encodings) and columns["doc_id"].has_column_index
    few = T.read_tokens(spark, path, "doc_id", "start", "n_tokens").where("doc_id between 100 and 105")
    text = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(doc_id,100)" in text and "ids:array" not in text
    assert [r["doc_id"] for r in few.orderBy("doc_id").collect()] == list(range(100, 106))


def test_token_files_messy_and_empty(spark, tmp_path):
    df = messy(spark)
    T.write_tokens(df, str(tmp_path / "m"), public.path(FILES[1]), 2)
    rows = sorted(T.read_tokens(spark, str(tmp_path / "m")).collect(), key=lambda r: r["start"])
    assert len(rows) == df.count() and rows[0]["doc_id"] is None
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(len(rows))]
    T.write_tokens(empty(spark), str(tmp_path / "e"), public.path(FILES[1]), 2)
    assert T.read_tokens(spark, str(tmp_path / "e")).count() == 0


def fill(histogram, capacity):
    slots = P.best_fit(histogram, capacity)
    used, placed = Counter(), Counter()
    for length, low, high, first, offset in slots:
        assert low == placed[length]
        placed[length] = high
        for s in range(first, first + high - low):
            assert used[s] == offset  # gapless, in the order of the plan
            used[s] += length
    assert placed == Counter(histogram) and max(used.values(), default=0) <= capacity
    assert sorted(used) == list(range(len(used)))
    return len(used)


def test_best_fit_over_counts():
    assert fill({}, 10) == 0
    assert fill({10: 3}, 10) == 3
    assert fill({6: 5, 4: 5}, 10) == 5
    assert fill({3: 10}, 10) == 4
    assert fill({1: 95}, 10) == 10
    rng = np.random.default_rng(1)
    lengths = Counter(rng.integers(1, 1025, 4000).tolist())
    assert fill(lengths, 1024) <= -(-sum(k * n for k, n in lengths.items()) // 1024) * 1.01


def check_pack(df, rows, capacity):
    own = library(FILES[0])
    whole = Counter((r["doc_id"], tuple([*own.encode(r["text"] or "", add_special_tokens=False).ids, 2])) for r in df.collect())
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
        assert len(r["ids"]) == r["length"] and (r["piece"] == 0 or r["length"] == capacity)
    for inside in by.values():
        inside.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in inside] == [sum(x["length"] for x in inside[:i]) for i in range(len(inside))]
        assert sum(r["length"] for r in inside) <= capacity
    assert sum(len(r["ids"]) for r in rows) == sum(len(k[1]) * n for k, n in whole.items())
    return whole


def test_pack(spark):
    df = docs(spark, [(i, prose(i, i % 30)) for i in range(300)])
    rows = P.pack(df, public.path(FILES[0]), 2, capacity=64).collect()
    whole = check_pack(df, rows, 64)
    parts: dict = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(parts.get(r["doc_id"], []))
        parts.setdefault(r["doc_id"], []).extend(r["ids"])
    assert Counter((d, tuple(x)) for d, x in parts.items()) == whole
    full = P.sequences(P.pack(df, public.path(FILES[0]), 2, capacity=64)).collect()
    assert sum(len(r["ids"]) for r in full) == sum(len(x) for x in parts.values())


def test_pack_hot_length_messy_and_empty(spark):
    same = docs(spark, [(i, "the same words") for i in range(3_000)]).repartition(6)
    rows = P.pack(same, public.path(FILES[0]), 2, capacity=64).collect()
    check_pack(same, rows, 64)
    assert len({r["sequence_id"] for r in rows}) == -(-3_000 // (64 // rows[0]["length"]))
    df = messy(spark)
    check_pack(df, P.pack(df, public.path(FILES[0])).collect(), 1024)
    assert P.pack(empty(spark), public.path(FILES[0])).count() == 0
