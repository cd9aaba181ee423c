import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from callstrata.llm import queries
from callstrata.llm.common import stored
from tests.llm.helpers import docs, empty, messy, prose
from tools.check_oracle import compare

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
NAMES = ["quality classifier", "line dedup", "near dedup", "benchmark decontamination", "best-fit packing"]


@given
@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    assert compare(entry.queries()[name](spark, SF), con.sql(entry.oracle_sql()[name])) == ""


@given
def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


@given
def test_columns_of_the_contracts(spark):
    wanted = {
        "op1_quality": "doc_id bigint, held_out boolean, score double, predicted int",
        "op2_token_store": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
        "op3_simhash": "doc_id bigint, fingerprint string, component_id bigint",
        "op5_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
        "op7_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
        "op10_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
        "op11_document_prints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                "near_edited double, near_next double, class_id bigint, links bigint",
        "op12_ranked_search": "item_id bigint, rank int, doc_id bigint, score bigint",
        "op13_token_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
                                "groups_sha256 string",
    }
    for name, columns in wanted.items():
        got = dict(entry.queries()[name](spark, SF).dtypes)
        assert got == dict(c.split(" ") for c in columns.split(", ")), name


@given
def test_stages_in_order(spark):
    assert [n for n, _ in pipeline.STAGES] == NAMES and pipeline.ORACLE_SQL is None
    table = spark.read.parquet(f"{SF}/documents.parquet")
    seen, before = table, table.columns
    for name, stage in pipeline.STAGES[:-1]:
        out = stored(stage(spark, seen, SF))
        assert out.columns == before, name
        assert out.join(seen, "doc_id", "left_anti").count() == 0 and 0 < out.count() <= seen.count()
        seen = out
    packed = pipeline.STAGES[-1][1](spark, seen, SF)
    assert packed.select("doc_id").distinct().count() == seen.count()
    assert pipeline.run(spark, SF).count() == packed.count()


@given
def test_what_each_stage_takes_and_leaves(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = [(i, prose(i, 12)) for i in range(40)]
    menu = [(100 + i, prose(100 + i, 9) + "\nHome | Search | About") for i in range(20)]
    copies = [(200 + i, prose(7_000, 15)) for i in range(6)]
    leak = [(300, prose(300, 3) + " " + item + " " + prose(301, 3))]
    df = docs(spark, [*clean, *menu, *copies, *leak])
    lines = pipeline.line_dedup(spark, df, SF)
    assert not lines.where("text LIKE '%Search%'").count() and lines.count() == df.count()
    single = pipeline.near_dedup(spark, lines, SF)
    assert {r["doc_id"] for r in single.collect()} == {r[0] for r in [*clean, *menu, *copies[:1], *leak]}
    left = pipeline.decontamination(spark, single, SF)
    assert {r["doc_id"] for r in left.collect()} == {r[0] for r in [*clean, *menu, *copies[:1]]}


@given
def test_stages_on_messy_and_empty_tables(spark):
    for df in (messy(spark), empty(spark)):
        seen = df
        for _, stage in pipeline.STAGES[:-1]:
            seen = stored(stage(spark, seen, SF))
            assert seen.columns == df.columns
        packed = pipeline.STAGES[-1][1](spark, seen, SF)
        assert packed.where("piece = 0").count() == seen.count()
