import random
import re

import numpy as np
import pytest

from callstrata.llm import licenses as N
from tests.llm.helpers import docs, empty, messy, prose, words


def cut(text):
    return re.findall(r"\w+", (text or "").lower())


def runs(w, n):
    return [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("name", sorted(N.NOTICES))
def test_each_notice_is_found_at_every_place(spark, name):
    templates = N.Templates(N.NOTICES)
    for before in range(0, 60, 7):
        text = " ".join([*words(before, before), N.NOTICES[name].upper(), *words(3, 25)])
        codes = N.word_codes(text)
        got = N.joined(templates.scan(codes, np.array([0]), np.array([len(codes)])))
        assert (0, name, before, before + len(cut(N.NOTICES[name])) - 1, 1.0) in got


def test_windows_cover_every_stretch_and_stay_in_their_text():
    for words_in_template in (1, 3, 5, 8, 30):
        shape = N.shape_of(words_in_template)
        sizes = np.array([0, 1, 4, 5, 9, 200, 31])
        first = np.cumsum(sizes) - sizes
        starts, lengths, texts = N.windows(first, sizes, shape)
        spans = {(t, s - first[t], s - first[t] + n + shape.width - 1) for s, n, t in zip(starts, lengths, texts, strict=True)}
        assert all(0 <= a and b <= sizes[t] for t, a, b in spans)
        for t, n in enumerate(sizes):
            for a in range(n - words_in_template + 1):
                assert any(x == t and s <= a and a + words_in_template <= e for x, s, e in spans)


def test_containment_is_exact(spark):
    """Changed templates are found down to 0.8 of their shingles, and not below."""
    template = " ".join(words(1, 40))
    rng = random.Random(1)
    rows, want = [], {}
    for d in range(60):
        w = template.split()
        for _ in range(rng.randrange(4)):
            w[rng.choice([0, 1, 38, 39, rng.randrange(40)])] = "other"
        rows.append((d, " ".join([*words(d + 9, d), *w, *words(d + 99, 20)])))
        part = len(set(runs(w, 5)) & set(runs(cut(template), 5))) / len(set(runs(cut(template), 5)))
        if part >= 0.8:
            want[d] = part
    got = {r["doc_id"]: r["containment"] for r in N.licenses(docs(spark, rows), {"t": template}).collect()}
    assert 5 < len(want) < 60 and got == pytest.approx(want)


def test_clean_texts_and_hot_notice(spark):
    df = docs(spark, [(i, prose(i, 10)) for i in range(100)] + [(500 + i, prose(i, 2) + "\n" + N.NOTICES["MIT"]) for i in range(900)])
    got = N.licenses(df).collect()
    assert {r["doc_id"] for r in got} == set(range(500, 1400)) and {r["license"] for r in got} == {"MIT"}


def test_too_many_templates_are_refused(monkeypatch):
    monkeypatch.setattr(N, "TEMPLATE_WORDS", 3)
    with pytest.raises(ValueError, match="every task"):
        N.Templates(N.NOTICES)


def test_messy_and_empty(spark):
    assert N.licenses(messy(spark)).count() == 0
    assert N.licenses(messy(spark), {"none": "", "one": "one"}).collect()[0]["doc_id"] == 4
    assert N.licenses(messy(spark), {}).count() == 0
    assert N.licenses(empty(spark)).count() == 0
    twice = docs(spark, [(1, N.NOTICES["MIT"])] * 2)
    assert N.licenses(twice).count() == 2
