"""The corpus pipeline stage by stage, and the registered queries."""

import collections
import re

import corpus_pipeline as C
import public_tokenizers as P
import pyarrow as pa
import pytest
from llm_data import edge_docs, no_docs, prose

from siglake.llm import common
from siglake.llm.common import chunked
from siglake.llm.packing import pack, pieces_of
from siglake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def through(spark, docs, path):
    out = [docs]
    for i, (_, stage) in enumerate(C.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{path}/{i}")
        out.append(spark.read.parquet(f"{path}/{i}"))
    return out


def test_stages_in_order():
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "near_dedup", "substring_dedup", "packing"]


def test_pipeline_takes_out_what_is_planted(spark, scratch):
    passage = prose(70, 1)
    clean = [(i, prose(150, 100 + i), "en", "s", 0) for i in range(30)]
    bad = [(100, None, "en", "s", 0), (101, "12 34 ?!", "en", "s", 0), (102, clean[0][1].replace(" ", "\n"), "en", "s", 0),
           (103, " ".join([*clean[1][1].split()[:-1], "changed"]), "en", "s", 0)]
    shared = [(200 + i, prose(80, 900 + i) + " " + passage + " " + prose(80, 950 + i), "en", "s", 0) for i in range(3)]
    docs = spark.createDataFrame(clean + bad + shared, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = through(spark, docs, scratch)
    ids = [{r.doc_id for r in t.select("doc_id").collect()} for t in out]
    keep = {r[0] for r in clean} | {r[0] for r in shared}
    assert ids[1] == keep | {102, 103} and ids[2] == keep | {103} and ids[3] == keep and ids[4] == keep and ids[5] == keep
    assert all(t.columns == docs.columns for t in out[:5])
    texts = {r.doc_id: r.text for r in out[4].collect()}
    assert sum(passage in t for t in texts.values()) == 1 and passage in texts[200]
    assert texts[201] == f"{prose(80, 901)} {prose(80, 951)}"
    assert all(texts[r[0]] == r[1] for r in clean)
    assert out[5].groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_pipeline_edge_cases(spark, scratch):
    out = through(spark, edge_docs(spark), scratch + "/edge")
    assert out[4].columns == out[0].columns and out[5].count() > 0
    assert through(spark, no_docs(spark), scratch + "/none")[5].count() == 0


def test_run_reads_the_documents(spark):
    got = C.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100


def test_all_queries_are_registered():
    import __spark_entry__ as e
    numbers = collections.Counter(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == {n: 1 for n in range(1, 14)} and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(e.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    if name.startswith("op11_"):
        rows = QUERIES[name](spark, SF).collect()
        assert {r["lang"] for r in rows} and all(r["a"] >= 10 and r["rank"] >= 1 for r in rows)
        return
    if name.startswith("op12_"):
        root = QUERIES[name](spark, SF).where("depth = 0").first()
        assert root["n_convs"] == spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
        return
    table = "conversations" if name.startswith("op4_") else "documents"
    key = ["conv_id", "turn"] if table == "conversations" else ["doc_id"]
    got = QUERIES[name](spark, SF)
    if name.startswith("op5_"):
        assert {"doc_id", "match_id"} <= set(got.columns)
        return
    want = spark.read.parquet(f"{SF}/{table}.parquet").select(*key)
    assert got.select(*key).distinct().count() == want.distinct().count()
    assert got.join(want, key, "left_anti").count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    assert columns == sorted(got.columns)
    at = [[c[0] for c in want.description].index(c) for c in columns]
    assert sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str) == sorted(
        map(tuple, got.select(*columns).collect()), key=str)


def test_tables_of_a_stage_leave_the_workers_with_it(spark):
    docs = spark.createDataFrame([(i, prose(60, i)) for i in range(40)], "doc_id bigint, text string").repartition(8)
    assert pieces_of(docs, P.path(C.TOKENIZER), P.PATTERN).count() >= 40

    def left(batches):
        import gc

        from siglake.llm.tokens import BatchEncoder
        for _ in chunked(batches, 1 << 20):
            pass
        yield pa.RecordBatch.from_pydict({"n": [sum(isinstance(x, BatchEncoder) for x in gc.get_objects())]})

    assert {r.n for r in docs.select("text").mapInArrow(left, "n bigint").collect()} == {0}


def test_tables_are_made_once_a_stage(monkeypatch):
    made, stage = [], [1]
    monkeypatch.setattr(common, "_kept", {"stage": None, "tables": []})
    monkeypatch.setattr(common.TaskContext, "get", classmethod(lambda cls: cls.__new__(cls)))
    monkeypatch.setattr(common.TaskContext, "stageId", lambda self: stage[0])
    table = common.per_stage(lambda name: made.append(name) or object())
    first = table("a")
    assert table("a") is first and made == ["a"]
    stage[0] = 2
    assert table("a") is not first and made == ["a", "a"]


def test_local_rows_need_no_python_worker(spark, scratch):
    rows = [(1, b"x", None), (-(1 << 63), None, 3)]
    schema = "a bigint, b binary, c int"
    for given in (rows, []):
        got, usual = common.local_rows(spark, given, schema), spark.createDataFrame(given, schema)
        assert got.schema == usual.schema and got.collect() == usual.collect()
    pieces = spark.range(20).selectExpr("id doc_id", "0 piece", "id % 5 + 1 length")
    numbers = common.numbered(spark.range(9), "n", "test")
    for df in (common.local_rows(spark, rows, schema), pack(pieces), numbers):
        assert "ExistingRDD" not in df._jdf.queryExecution().toString()
    assert sorted(r.n for r in numbers.collect()) == list(range(9))
