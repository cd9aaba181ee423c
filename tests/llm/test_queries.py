"""Registered queries that SQL cannot express, against plain versions on the smallest given tables."""

import os
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from callstrata.llm import decontaminate as D
from callstrata.llm.licenses import NOTICES
from tests.llm.test_simhash import groups, plain_fingerprint
from tests.llm.test_spans import plain

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def given(table, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{table}.parquet' ORDER BY 1").fetchall()


def run(spark, name):
    return entry.queries()[name](spark, SF).collect()


def library(file):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public.path(file))
    return {d: [*own.encode(t or "", add_special_tokens=False).ids, 2] for d, t in given("documents", "doc_id, text")}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_quality(spark):
    rows = {r["doc_id"]: r for r in run(spark, "op1_quality")}
    assert rows.keys() == {d for d, _ in given("documents", "doc_id, text")}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    held = [(rows[d]["predicted"], q) for d, q in given("labels", "doc_id, quality") if rows[d]["held_out"]]
    assert len(held) > 10 and np.mean([p == q for p, q in held]) >= 0.9


def test_token_store(spark):
    start, got = 0, sorted(run(spark, "op2_token_store"))
    for row, (doc, ids) in zip(got, sorted(library("word_bpe_49k.json").items()), strict=True):
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc, start, len(ids), crc(ids))
        start += len(ids)


def test_simhash(spark):
    fps = {d: plain_fingerprint(t) for d, t in given("documents", "doc_id, text")}
    near = [(a, b) for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2]
    root = groups(near, fps)
    least = {}
    for d in sorted(fps):
        least.setdefault(root[d], d)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, "op3_simhash")}
    assert near and got == {d: (f"{f:016x}", least[root[d]]) for d, f in fps.items()}


def test_repeated_spans_equal_runs_of_every_length(spark):
    by: dict = {}
    for (doc, sentence), first in plain(given("documents", "doc_id, text")).items():
        by.setdefault((doc, first), []).append(sentence)
    got = sorted(tuple(r) for r in run(spark, "op4_repeated_spans"))
    assert got and got == sorted((d, f, len(x), min(x), max(x)) for (d, f), x in by.items())


def test_packing(spark):
    rows, ids = run(spark, "op5_packing"), library("byte_bpe_50k.json")
    inside: dict = {}
    for r in rows:
        assert r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"]: r["start"] + r["length"]]) and r["length"] <= 1024
        assert r["piece"] == 0 or r["length"] == 1024
        inside.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    pieces: dict = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == pieces.get(r["doc_id"], 0)
        pieces[r["doc_id"]] = r["start"] + r["length"]
    assert pieces == {d: len(x) for d, x in ids.items()}
    for own in inside.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024
    assert len(inside) <= 1.01 * sum(map(len, ids.values())) / 1024 + 1


def cut(text):
    return re.findall(r"\w+", (text or "").lower())


def test_licenses(spark):
    got = {(r["doc_id"], r["license"]) for r in run(spark, "op6_licenses") if r["containment"] == 1}
    want = {(d, name) for d, t in given("documents", "doc_id, text") for name, notice in NOTICES.items()
            if f" {' '.join(cut(notice))} " in f" {' '.join(cut(t))} "}
    assert want and got == want


def test_decontamination(spark):
    """All aligned stretches of 13 places of every document and item, by whole matrices."""
    width, beyond = D.WINDOW, iter(range(-1, -10**9, -1))
    numbers: dict = {}
    items, owner = [], []
    for i, text in given("benchmark", "item_id, text"):
        own = [numbers.setdefault(w, len(numbers)) for w in cut(text)]
        assert len(own) >= D.EQUAL
        pad = [next(beyond) for _ in range(width)]
        items += pad + own
        owner += [-1] * len(pad) + [i] * len(own)
    items, owner = np.array(items + [next(beyond) for _ in range(width)]), np.array(owner + [-1] * width)
    want = set()
    for d, text in given("documents", "doc_id, text"):
        own = np.array([next(beyond) for _ in range(width)] + [numbers.get(w, -2) for w in cut(text)] + [next(beyond) for _ in range(width)])
        own[own == -2] = 10**9
        same = (own[:, None] == items[None, :]).astype(np.int8)
        n, m = same.shape[0] - width + 1, same.shape[1] - width + 1
        total = sum(same[k: k + n, k: k + m] for k in range(width))
        for j in set(np.nonzero(total >= D.EQUAL)[1].tolist()):
            want |= {(d, int(i)) for i in owner[j: j + width] if i >= 0}
    got = {(r["doc_id"], r["item_id"]) for r in run(spark, "op8_decontamination")}
    assert want and got == want


def test_document_prints(spark):
    from callstrata.llm import docprints
    from tests.llm.test_docprints import check

    df = spark.read.parquet(f"{SF}/documents.parquet")
    found = check(df)
    assert np.mean([r["near_edited"] > r["near_next"] for r in found]) > 0.95
    assert sorted(map(tuple, run(spark, "op11_document_prints"))) == sorted(map(tuple, docprints.edited_likeness(df).collect()))


def test_token_alignment(spark):
    from callstrata.llm import align
    from tests.llm.test_align import FILES, check, libraries

    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = check(spark, libraries.__wrapped__(), df)
    assert align.Both.at(*FILES) and sorted(map(tuple, run(spark, "op13_token_alignment"))) == sorted(want)


def test_neighbours(spark):
    rows = given("embeddings", "vec_id, embedding")
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got: dict = {}
    for r in sorted(run(spark, "op10_neighbours"), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = []
    for q in ids[ids % 20 == 0].tolist():
        score = x @ x[np.nonzero(ids == q)[0][0]]
        best = [int(ids[i]) for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        at = dict(zip(ids.tolist(), score, strict=True))
        assert all(abs(at[v] - s) < 1e-9 for v, s in got[q]) and len(got[q]) == len(best)
        hits.append(len({v for v, _ in got[q]} & set(best)) / len(best))
    assert np.mean(hits) >= 0.9
