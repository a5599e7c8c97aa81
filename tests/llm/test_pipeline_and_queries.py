"""The registered queries against DuckDB, and the pipeline's stages against brute force."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from airmart.llm import registry
from airmart.llm.quality_rules import line_verdict
from scripts.check_oracle import rows_of

from . import brute
from .test_dedup_operators import _brute_lines

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_operator_is_registered():
    names = entry.queries().keys()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(registry.oracle_sql()) <= set(names)
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    res = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(res.columns, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_covers_its_table(spark, name):
    df = entry.queries()[name](spark, SMALL)
    rows = df.collect()
    if name.startswith("op10_"):
        docs, items = ([tuple(r) for r in spark.read.parquet(f"{SMALL}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
        got, want = {(r.doc_id, r.item_id): r.distance for r in rows}, brute.contaminated(docs, items)
        assert want and got == want
    else:
        assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_stages_match_brute_force(spark, duck):
    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in source.collect()}
    docs = {}
    for name, stage in cp.STAGES[:-1]:
        got_df = cp.materialize(stage(spark, source, SMALL), f"test-{name}")
        assert got_df.columns == source.columns
        got = {r.doc_id: r for r in got_df.collect()}
        if name == "quality_rules":
            kept = {r[0] for r in duck.sql(f"SELECT doc_id FROM ({registry.oracle_sql()['op2_quality_rules']}) WHERE kept").fetchall()}
            docs = {i: "\n".join(x for x in rows[i].text.split("\n") if not x.split() or not line_verdict(x.encode(), x.encode().split())) for i in kept}
        elif name == "line_dedup":
            docs = {i: t.decode() for i, (_, gone, t) in _brute_lines(docs.items()).items() if not gone or t.split()}
        elif name == "ngram_jaccard_join":
            docs = {i: docs[i] for i, (_, c) in brute.components(list(docs.items()), 5, 80).items() if c == i}
        else:
            items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
            bad = {i for i, _ in brute.contaminated(list(docs.items()), items)}
            docs = {i: t for i, t in docs.items() if i not in bad}
        assert {i: r.text for i, r in got.items()} == docs, name
        assert all(r.n_chars == len(r.text) and (r.lang, r.source) == (rows[i].lang, rows[i].source) for i, r in got.items())
        source = got_df
    mixed = cp.STAGES[-1][1](spark, source, SMALL).collect()
    assert {r.doc_id: r.size for r in mixed} == {i: len(brute.words(t)) for i, t in docs.items()}
    target = {r.target for r in mixed}
    assert abs(sum(r.taken for r in mixed) - 1.5 * sum(r.size for r in mixed)) <= 0.5 * max(r.size for r in mixed) * len(target) + 1
    assert sorted(map(tuple, entry.queries()["pipeline"](spark, SMALL).collect())) == sorted(map(tuple, mixed))


def test_stages_take_edges(spark, make_docs):
    text = "\n".join("Some " + " ".join(f"word{i}x{j}" for j in range(8)) + "." for i in range(12))
    rows = [(1, text, "a"), (1, text, "a"), (2, text + "\nOne more line.", None), (None, text.replace("x", "y"), "a"), (None, None, None), (4, "", "a"), (5, None, "b"), (6, text.replace("word", "other") + " " + "z " * 200_000, "b")]
    for docs in (make_docs(rows), make_docs(rows).limit(0)):
        empty = docs.isEmpty()
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SMALL)
            ids = sorted((r[0] or 0) for r in out.select("doc_id").collect())
            assert name == "source_mix" or out.columns == docs.columns
            if empty:
                assert ids == [], name
            elif name == "quality_rules":
                assert ids == [0, 1, 1, 2]
            elif name == "ngram_jaccard_join":
                assert ids == [0, 0, 1, 4, 5, 6]
            elif name in ("benchmark_decontamination", "source_mix"):
                assert len(ids) == len(rows)


def test_near_duplicates_are_judged_row_by_row(spark, make_docs):
    """Rows that share an id, or have none, neither fall with each other's texts nor link them."""
    a, b, c, d, e = (" ".join(f"{k}{i}" for i in range(40)) for k in "abcde")
    rows = [(1, a), (None, a), (None, b), (5, b), (None, c), (None, c), (7, a + " tail"), (8, d), (8, e), (9, e), (None, ""), (None, "")]
    got = cp.keep_one_of_group(spark, make_docs(rows), SMALL).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in got) == sorted([(1, a), (5, b), (0, c), (8, d), (8, e), (0, ""), (0, "")])
    found = registry.jaccard_join.jaccard_components(make_docs(rows)).collect()
    none = sorted(str(r.component_id) for r in found if r.doc_id is None and r.n_shingles)
    assert none == ["1", "5", "None", "None"]
    assert {(r.doc_id, r.component_id) for r in found if r.doc_id} == {(1, 1), (5, 5), (7, 1), (8, 8), (9, 8)}
