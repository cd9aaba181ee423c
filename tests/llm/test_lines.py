import re

from callstrata.llm import lines as L
from tests.helpers import plan
from tests.llm.helpers import docs, empty, messy, unchanged


def rows(n=20, share=10):
    return [(i, f"own {i}\nHome | About \n{'footer' if i < share else 'other'}\n\nbody {i}", "a") for i in range(n)]


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_lines_on_many_pages_of_a_host_go(spark):
    got = L.drop_boilerplate(docs(spark, [*rows(), (99, "Home | About\nonly here", "b")]), max_ratio=0.5)
    by = texts(got)
    assert by[0] == "own 0\nfooter\n\nbody 0"  # ten of twenty is not more than half; blank lines stay
    assert by[99] == "Home | About\nonly here"  # another host, one page
    lengths = {r["doc_id"]: (r["n_chars"], r["__lines_dropped"]) for r in got.collect()}
    assert lengths[0] == (len(by[0]), 1) and lengths[99][1] == 0


def test_ratio_is_strict_and_pages_are_distinct_texts(spark):
    """Eight copies of one page are one page: its lines are on one of thirteen."""
    data = [(i, f"x {i}\ny {i}", "a") for i in range(12)] + [(100 + i, "copied\npage", "a") for i in range(8)]
    assert texts(L.drop_boilerplate(docs(spark, data)))[100] == "copied\npage"
    assert L.boilerplate(docs(spark, data)).count() == 0


def test_small_hosts_have_no_boilerplate(spark):
    data = [(i, f"x {i}\nmenu", "a") for i in range(4)]
    assert set(texts(L.drop_boilerplate(docs(spark, data))).values()) == {f"x {i}\nmenu" for i in range(4)}


def test_without_broadcast_the_result_is_the_same(spark, monkeypatch):
    df = docs(spark, rows())
    want = texts(L.drop_boilerplate(df))
    monkeypatch.setattr(L, "BROADCAST_LINES", -1)
    assert texts(L.drop_boilerplate(df)) == want


def test_messy_and_empty(spark):
    df = messy(spark)
    got = L.drop_boilerplate(df, count=None)
    unchanged(df, got)
    assert sorted(map(str, (r["text"] for r in got.collect()))) == sorted(map(str, (r["text"] for r in df.collect())))
    assert L.drop_boilerplate(empty(spark)).count() == 0


def test_no_python_on_the_path(spark):
    assert not re.search("Python|Pandas|Arrow", plan(L.drop_boilerplate(docs(spark, rows()))))
