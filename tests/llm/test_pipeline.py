import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from demandspark.llm.catalog import ORACLES, QUERIES
from tests.llm import samples, test_decontaminate, test_lines, test_quality, test_simhash

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {"op3_quality_rules", "op4_line_dedup", "op9_chat_format", "op10_url_reputation"} <= set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = sorted(tuple(r) for r in docs.collect())
        kept = corpus_pipeline.materialise(stage(spark, docs, SF), name)
        assert kept.columns == docs.columns
        got = sorted(tuple(r) for r in kept.collect())
        if name == "quality_rules":
            good = {r[0] for r in test_quality.brute(rows) if r[-1]}
            assert got == [r for r in rows if r[0] in good]
        elif name == "line_dedup":
            dropped = {r[0]: r[2] for r in test_lines.brute(rows, 0.05, 3)}
            assert [r[0] for r in got] == [r[0] for r in rows]
            for new, old in zip(got, rows):
                assert len(old[1].split("\n")) - (len(new[1].split("\n")) if new[1] or not dropped[old[0]] else 0) in (dropped[old[0]], dropped[old[0]] - 1)
                assert (new[1] == old[1]) == (dropped[old[0]] == 0) and new[4] == len(new[1])
        elif name == "near_duplicates":
            firsts = {c for _, _, c in test_simhash.brute(rows)}
            assert got == [r for r in rows if r[0] in firsts]
        else:
            bad = {r[0] for r in test_decontaminate.brute(rows, items, 10) if r[5]}
            assert got == [r for r in rows if r[0] not in bad]
        assert len(got) < len(rows) or name == "line_dedup"
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in docs.select("doc_id").collect()}
    used = packed.groupby("sequence_id").length.sum()
    assert used.max() <= 2048 and len(used) <= np.ceil(1.02 * used.sum() / 2048) + 1
    whole = corpus_pipeline.run(spark, SF).toPandas()
    assert sorted(zip(whole.doc_id, whole.piece, whole.ids_crc32)) == sorted(zip(packed.doc_id, packed.piece, packed.ids_crc32))


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_awkward_and_empty_tables(spark, stage):
    name, function = corpus_pipeline.STAGES[stage]
    for rows in (None, []):
        docs = samples.documents(spark, rows)
        out = function(spark, docs, SF)
        assert name == "best_fit_packing" or out.columns == docs.columns
        assert out.count() <= docs.count() + (name == "best_fit_packing") * 100


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for table in ("documents", "pages", "labels", "conversations", "benchmark", "embeddings"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    found = QUERIES[name](spark, SF).toPandas()
    want = connection.execute(ORACLES[name]).df()[list(found.columns)]
    key = list(found.columns)
    plain = lambda df: sorted(map(repr, df.astype(object).where(df.notna(), None)[key].itertuples(index=False, name=None)))
    assert plain(found) == plain(want)
