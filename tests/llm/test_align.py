import hashlib
import random
from bisect import bisect_left

import numpy as np
import pytest

from callstrata.llm import align as G
from tests.llm.helpers import docs, empty, messy, prose

public = pytest.importorskip("public_tokenizers")
FILES = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=FILES[1]), G.Both(*FILES)


def plain(libraries, text):
    """The counts and digest of one text, and its id pairs, from whole encodings and sets of ends."""
    nothing = (0, 0, 0, 0, ""), {}
    if not text:
        return nothing
    first, second, both = libraries
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    data = (" " + text).encode()
    parts = [[both.a.parts[t] for t in a], [both.b.parts[t] for t in b]]
    if any(b"".join(p) != data for p in parts):
        return nothing
    ends_a, ends_b = (np.cumsum([len(x) for x in p]).tolist() for p in parts)
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        i, j = k, m
    pairs: dict = {}
    ends = sorted({*ends_a, *ends_b})
    for end in ends:
        pair = a[bisect_left(ends_a, end)], b[bisect_left(ends_b, end)]
        pairs[pair] = pairs.get(pair, 0) + 1
    return (len(a), len(b), len(groups), len(ends), hashlib.sha256(";".join(groups).encode()).hexdigest()), pairs


AWKWARD = [
    "", None, "a", " a", "a ", "a  b", "▁x", "漢字 x", "it's <|endoftext|> <s> 12x x12 </s> <unk> <0x41>", "x\n\ny", "\n", " ", "\t",
    "don't'll 3.14 ...!!", "é ñ ß", "é", "x\x00y", "a.b,c;d x_y __", "A1B2 1.5e10 http://a.b/c?d=e&f#g", "🙂 ok", "ａｂ", "a b", "﻿x", "x" * 5_000]


def check(spark, libraries, df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    found = [(d, *plain(libraries, t)) for d, t in rows]
    total: dict = {}
    for _, _, pairs in found:
        for pair, n in pairs.items():
            total[pair] = total.get(pair, 0) + n
    top: dict = {}
    for (_, b), n in total.items():
        top[b] = max(top.get(b, 0), n)
    want = [(d, *c[:4], sum(n for p, n in pairs.items() if total[p] == top[p[1]]), sum(n * total[p] for p, n in pairs.items()), c[4])
            for d, c, pairs in found]
    got = [tuple(r) for r in G.tokens_aligned(df, *FILES).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_awkward_texts(spark, libraries):
    rng, letters = random.Random(1), "ab Zé.,'\n1 2_-%$#@|\"()sS tT"
    texts = AWKWARD + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    got = check(spark, libraries, docs(spark, list(enumerate(texts))))
    assert sum(r[1] > 0 for r in got) > 400


def test_prose_in_small_pieces_and_blocks(spark, libraries, monkeypatch):
    for name, value in (("PIECES", 7), ("PAIRS", 40), ("ROW", 9), ("REMEMBERED", 50)):
        monkeypatch.setattr(G, name, value)
    aligner = G.Aligner(G.Both(*FILES))
    texts = [prose(i, 4) + f" Don't 3.5 naïve{i}" for i in range(12)]
    for text, row in zip(texts, aligner.texts(texts), strict=True):
        counts, pairs = plain(libraries, text)
        keys = dict(zip(np.concatenate(row[5]).tolist(), np.concatenate(row[6]).tolist(), strict=True))
        assert tuple(row[:5]) == counts and keys == {a * aligner.radix + b: n for (a, b), n in pairs.items()}
    check(spark, libraries, docs(spark, [(i, t) for i, t in enumerate(texts)] * 2))


def test_messy_and_empty(spark, libraries):
    check(spark, libraries, messy(spark))
    assert G.tokens_aligned(empty(spark), *FILES).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_jumps_equal_sets_of_ends(seed):
    """Long one-to-one stretches, shifts that come back, and groups of any size."""
    rng = random.Random(seed)
    ends_a, ends_b, at = [], [], 0
    for _ in range(300):
        if rng.random() < 0.7:
            for _ in range(rng.randrange(1, 60)):
                at += rng.randrange(1, 4)
                ends_a.append(at)
                ends_b.append(at)
        width = rng.randrange(2, 9)
        for ends in (ends_a, ends_b):
            ends += sorted({at + rng.randrange(1, width) for _ in range(rng.randrange(4))}) + [at + width]
        at += width
    left, right, last_a, last_b = G.align(ends_a, ends_b)
    common = sorted(set(ends_a) & set(ends_b))
    odd_a, odd_b = set(left) - set(last_a), set(right) - set(last_b)
    assert [e for i, e in enumerate(ends_a) if i not in odd_a] == common == [e for j, e in enumerate(ends_b) if j not in odd_b]
    plain_a = [i for i in range(len(ends_a)) if i not in set(left)]
    plain_b = [j for j in range(len(ends_b)) if j not in set(right)]
    links = {*zip(left, right, strict=True), *zip(plain_a, plain_b, strict=True)}
    assert links == {(bisect_left(ends_a, e), bisect_left(ends_b, e)) for e in {*ends_a, *ends_b}}
