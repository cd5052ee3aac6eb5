"""Queries against the SQL that they must equal."""

import os

import duckdb
import pytest

from strandline.plans import queries as core

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
HERE = ["loose_key", "chunk_lines", "bridge_rename", "predicate_distribution", "paren_merge", "similar_pairs", "resolve_apply", "master_schema", "sankey_flows", "catalog_totals", "pagerank", "major_paths", "layers", "edge_statements"]


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple("" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in frame.values.tolist())


@pytest.mark.parametrize("name", HERE)
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    assert rows(core.QUERIES[name](spark, sf_dir).toPandas()) == rows(con.execute(core.ORACLE_SQL[name]).df())


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert os.path.isdir(sf_dir)


def test_weak_components_of_all_documents(spark, sf_dir):
    label = {}
    edges = core.graph.edges(core.triples(spark, sf_dir)).select("doc_id", "src", "dst").distinct().collect()
    for r in edges:
        for name in (r["src"], r["dst"]):
            label.setdefault((r["doc_id"], name), name)
    moved = True
    while moved:
        moved = False
        for r in edges:
            a, b = (r["doc_id"], r["src"]), (r["doc_id"], r["dst"])
            low = min(label[a], label[b])
            moved |= label[a] != label[b]
            label[a] = label[b] = low
    got = core.QUERIES["weak_components"](spark, sf_dir).collect()
    assert {d for d, _ in label} == {"geo", "trade", "behaviour"}
    assert sorted((r["doc_id"], r["name"], r["component"]) for r in got) == sorted((d, n, c) for (d, n), c in label.items())
