import json

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from strandline import ontology
from strandline.operators import checks, chunking, graph, iterative, merge, predict, resolve, schema_state
from strandline.sources import documents, extractions, sinks


def doc(spark, n, text="line"):
    return spark.createDataFrame([("d", "\n".join([text] * n) + ("\n" if n else ""))], "doc_id string, text string")


@pytest.mark.parametrize(
    ("n", "density", "spans"),
    [(0, "low", [(0, 0)]), (1700, "low", [(0, 1700)]), (1701, "low", [(0, 851), (811, 1701)]), (900, "고밀", [(0, 451), (411, 900)])],
)
def test_chunk_windows(spark, n, density, spans):
    rows = chunking.plan(doc(spark, n), chunking.target_lines(F.lit(density), F.lit(0))).orderBy("chunk_no").collect()
    assert [(r["start"], r["end"]) for r in rows] == spans


def test_chunk_limits_and_text(spark):
    assert chunking.plan(doc(spark, 100), F.lit(1)).count() == 40
    rows = chunking.chunks(spark.createDataFrame([(1, "a\r\nb\rc\nd")], "doc_id int, text string"), F.lit(2), overlap=1).orderBy("chunk_no").collect()
    assert [(r["text"], r["file"]) for r in rows] == [("a\nb\nc\n", "chunk_00.txt"), ("c\nd", "chunk_01.txt")]
    found = chunking.extract_triples(chunking.chunks(doc(spark, 2), F.lit(9)), lambda t: [{"n": len(t)}]).first()
    assert json.loads(found["json"]) == {"triples": [{"n": 10}]}


def test_read_documents(spark, tmp_path):
    import zipfile

    (tmp_path / "a.txt").write_bytes(b"x\n\xff")
    with zipfile.ZipFile(tmp_path / "b.DOCX", "w") as z:
        z.writestr("word/document.xml", "<w:p>one &amp; two</w:p><w:p>three</w:p>")
    got = {r["ext"]: r["text"] for r in documents.read_documents(spark, str(tmp_path)).collect()}
    assert got == {".txt": "x\n�", ".docx": "one & two\nthree\n"}
    (tmp_path / "c.xls").write_text("x")
    with pytest.raises(Exception, match="unsupported"):
        documents.read_documents(spark, str(tmp_path)).collect()


def test_pdf_by_pdftotext(spark, tmp_path, monkeypatch):
    """A stand-in for the program, on the path of the workers too: it answers with what it is given, in capitals."""
    tool = tmp_path / "bin" / "pdftotext"
    tool.parent.mkdir()
    tool.write_text("#!/bin/sh\ntr a-z A-Z\n")
    tool.chmod(0o755)
    monkeypatch.setenv("PATH", f"{tool.parent}:{__import__('os').environ['PATH']}")
    assert documents.pdf_text("page é\nline\n".encode()) == "PAGE é\nLINE\n"


def node(name, type_, **more):
    return {"name": name, "type": type_, **more}


@pytest.fixture
def extracted(spark, tmp_path):
    first = [
        {"subject": node("Storm A", "NaturalHazard", properties={"origin": "meteorological"}), "predicate": {"code": "TRIGGERS", "properties": {"time": "t1"}}, "object": node("Flood", "Event", attributes={"deaths": 3, "order": "primary"}), "evidence": "e"},
        {"subject": node("Flood", "Event", properties=None, attributes={"order": "x"}), "predicate": "CAUSES", "object": node("Loss", "Damage")},
    ]
    second = [{"subject": node("STORM a", "Event"), "predicate": "TRIGGERS", "object": node("flood", "Robot")}, {"subject": node("Loss", "Damage"), "predicate": "LIKES", "object": node("Other", None)}]
    (tmp_path / "meta_01.json").write_text(json.dumps({"triples": first}))
    (tmp_path / "meta_02.json").write_text(json.dumps({"triples": second}))
    (tmp_path / "meta_03.json").write_text("{broken")
    (tmp_path / "other.json").write_text("{}")
    rows, bad = extractions.read_extractions(spark, str(tmp_path))
    return rows.withColumn("doc_id", F.lit("d")).withColumn("ord", F.struct("file", "pos")).drop("file", "pos"), bad


def test_merge(spark, extracted):
    rows, bad = extracted
    assert [r["file"] for r in bad.collect()] == ["meta_03.json"]
    triples = merge.with_ids(merge.dedup_first(rows))
    got = [(r["id"], r["s_name"], r["code"], r["o_name"], r["chunk_id"]) for r in triples.orderBy("seq").collect()]
    assert got == [("T0001", "Storm A", "TRIGGERS", "Flood", "01"), ("T0002", "Flood", "CAUSES", "Loss", "01"), ("T0003", "Loss", "LIKES", "Other", "02")]
    again = merge.with_ids(merge.dedup_first(triples.drop("seq", "id")))
    assert again.count() == triples.count()
    assert {(r["kind"], r["value"]) for r in merge.warnings(triples).collect()} == {("type", None), ("code", "LIKES")}
    renamed = merge.canonical_keys(triples, {"deaths": "death"}, {"time": "timing"})
    first = renamed.filter("seq = 1").first()
    assert first["o_props"] == {"death": "3", "order": "primary"} and first["p_props"] == {"timing": "t1"}
    assert triples.filter("seq = 2").first()["s_props"] == {}  # a null bag is a bag
    schema = {(r["owner"], r["key"]): r["cnt"] for r in merge.emergent_nodes(renamed).collect()}
    assert schema["Event", "death"] == 1 and schema["Damage", None] == 0
    assert merge.document_metadata(triples, "d", "v1").first()["triple_count"] == 3
    assert {r["attr"] for r in checks.missing_attributes(triples).collect()} == {"category", "order"}  # the null bag has no order
    assert checks.bad_values(triples).count() == 0
    assert [r["value"] for r in checks.bad_values(triples.withColumn("o_props", F.create_map(F.lit("order"), F.lit("x")))).collect()] == ["x"]
    assert checks.across_chunks(rows).count() == 0
    assert sinks.triple_json(triples).count() == 3


def test_empty_triples(spark, extracted):
    none = merge.with_ids(merge.dedup_first(extracted[0].limit(0)))
    assert none.count() == 0
    edge = graph.edges(none)
    assert graph.nodes(edge).count() == 0 and graph.catalog(none).count() <= 1
    assert iterative.pagerank(edge, graph.nodes(edge)).count() == 0
    assert iterative.all_causal_paths(edge, graph.nodes(edge)).count() == 0


def edges_of(spark, pairs, types=None):
    types = types or {}
    rows = [("d", k + 1, a, b, c, types.get(a, "Event"), types.get(b, "Event")) for k, (a, c, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "doc_id string, seq long, src string, dst string, code string, st string, ot string")


H = {"H": "NaturalHazard", "D": "Damage"}


@pytest.mark.parametrize(
    ("pairs", "found"),
    [
        ([("H", "TRIGGERS", "E1"), ("E1", "CASCADES_INTO", "E2"), ("E2", "CAUSES", "D")], {"H > E1 > E2 > D"}),
        ([("H", "TRIGGERS", "D")], set()),
        ([("H", "TRIGGERS", "D"), ("D", "CAUSES", "E")], {"H > D > E"}),
        ([(str(k), "CAUSES", str(k + 1)) for k in range(7)], set()),
        ([("H", "TRIGGERS", "A"), ("H", "TRIGGERS", "B"), ("A", "CASCADES_INTO", "E"), ("B", "CASCADES_INTO", "E"), ("E", "CAUSES", "D")], {"H > A > E > D"}),
    ],
)
def test_paths(spark, pairs, found):
    edge = edges_of(spark, pairs, H)
    nodes = graph.nodes(edge)
    best = iterative.best_paths(iterative.all_causal_paths(edge, nodes))
    assert {r["text"] for r in best.collect()} == found
    assert {r["text"] for r in iterative.paths_in_order(edge, nodes).collect()} == found


def test_layers_and_weights(spark):
    edge = edges_of(spark, [("H", "TRIGGERS", "E1"), ("E1", "CASCADES_INTO", "E2"), ("E2", "CAUSES", "D")], H)
    nodes = graph.nodes(edge)
    best = iterative.best_paths(iterative.all_causal_paths(edge, nodes))
    placed, links = iterative.connectivity(edge, nodes, best)
    assert {r["name"]: r["layer"] for r in placed.collect()} == {"H": 0, "E1": 1, "E2": 2, "D": 3}
    assert {(r["src"], r["code"], r["weight"]) for r in links.collect()} == {("H", "TRIGGERS", 1), ("E1", "CASCADES_INTO", 1), ("E2", "CAUSES", 1)}
    assert iterative.complete_paths(best, nodes).first()["complete"] == 1


def test_degree_and_pagerank(spark):
    edge = edges_of(spark, [("H", "TRIGGERS", "E"), ("H", "AFFECTS", "E"), ("E", "CAUSES", "E"), ("A", "CAUSES", "B")])
    nodes = graph.nodes(edge)
    assert {r["name"]: r["deg"] for r in nodes.collect()} == {"H": 2, "E": 4, "A": 1, "B": 1}
    one = {r["name"]: r["pagerank"] for r in iterative.pagerank(edge, nodes).collect()}
    two = {r["name"]: r["pagerank"] for r in iterative.pagerank_rounds(edge, nodes, rounds=5).collect()}
    five = {r["name"]: r["pagerank"] for r in iterative.pagerank(edge, nodes, rounds=5).collect()}
    assert sum(one.values()) == pytest.approx(1) and two == pytest.approx(five)
    assert graph.sources_and_sinks(edge).filter("role = 'source'").count() == 2


def test_communities(spark):
    edge = edges_of(spark, [("a", "CAUSES", "b"), ("b", "CAUSES", "c"), ("c", "CAUSES", "a"), ("x", "CAUSES", "y")])
    nodes = graph.nodes(edge)
    got = {r["name"]: r["community"] for r in iterative.communities_in_order(edge, nodes).collect()}
    assert got["a"] == got["b"] == got["c"] == 0 and got["x"] == got["y"] == 1
    step = {r["name"]: r["label"] for r in iterative.communities_in_step(edge, nodes).collect()}
    assert step["x"] == step["y"] == "x"
    table = iterative.community_table(iterative.communities_in_step(edge, nodes), nodes, "label")
    assert {r["size"] for r in table.collect()} == {3, 2}
    weak = graph.components(edge.select("doc_id", F.col("src").alias("a"), F.col("dst").alias("b")), "doc_id")
    assert {r["node"]: r["component"] for r in weak.collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}


def test_communities_settle(spark, monkeypatch):
    """A path that needs more than three rounds, and a second one that settles later."""
    from strandline.plans import queries as core

    pairs = [(f"{p}{k}", "CAUSES", f"{p}{k + 1}") for p, n in (("a", 8), ("b", 12)) for k in range(10, 10 + n)]
    pairs += [("b22", "CAUSES", "c1"), ("c1", "CAUSES", "c2"), ("c2", "CAUSES", "c3"), ("c3", "CAUSES", "c1")]
    edge = edges_of(spark, pairs)
    nodes = graph.nodes(edge)
    monkeypatch.setattr(core, "graph_of", lambda *_: (edge, nodes))
    near = {}
    for a, _, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def winner(labels):
        return min(set(labels), key=lambda x: (-labels.count(x), x))

    label, rounds = {x: x for x in near}, 0
    while rounds < iterative.LPA_ROUNDS:
        new = {x: winner([label[x], *(label[y] for y in near[x])]) for x in near}
        rounds += 1
        if new == label:
            break
        label = new
    assert 3 < rounds < iterative.LPA_ROUNDS
    assert {r["name"]: r["label"] for r in core.QUERIES["communities_sync"](spark, "").collect()} == label

    names = list(near)  # in order of appearance
    place = {x: k for k, x in enumerate(names)}
    for _ in range(iterative.LPA_ROUNDS):
        before = dict(place)
        for x in names:
            place[x] = winner([place[y] for y in near[x]])
        if place == before:
            break
    held = {}
    for x in names:
        held.setdefault(place[x], []).append(x)
    want = sorted(held.values(), key=lambda xs: -len(xs))
    deg = {x: sum(x in (a, b) for a, _, b in pairs) for x in names}
    got = {r["community"]: (r["size"], r["top_members"]) for r in core.QUERIES["community_table"](spark, "").collect()}
    assert got == {k: (len(xs), ", ".join(sorted(xs, key=lambda x: (-deg[x], x))[:6])) for k, xs in enumerate(want[:15])}


def test_resolution(spark):
    names = ["Flood", "FLOOD", "Big Flood (2008)", "Big Flood", "2010 flood", "2011 flood", "Fl"]
    rows = [("d", (k, 0), n, "Event", "CASCADES_INTO", "Sea", "Context") for k, n in enumerate(names)] + [("d", (9, 0), "Big Flood", "NaturalHazard", "TRIGGERS", "Sea", "Context")]
    triples = merge.with_ids(merge.dedup_first(spark.createDataFrame(rows, "doc_id string, ord struct<a:int,b:int>, s_name string, s_type string, code string, o_name string, o_type string")))
    out = resolve.resolve(triples, extractions.empty_registry(spark))
    registry = {r["canonical"]: r["aliases"] for r in out["registry"].collect()}
    assert registry == {"Big Flood": ["Big Flood (2008)"]} or registry == {"Big Flood (2008)": ["Big Flood"]}
    assert [r["base"] for r in out["cross_type"].collect()] == ["big flood"]
    clusters = [r["name"] for r in out["clusters"].collect()]
    assert "Fl" in clusters and "Flood" in clusters
    assert out["triples"].filter("s_name like 'Big%' and s_type = 'Event'").count() == 1


def test_later_alias_wins(spark):
    registry = spark.createDataFrame([("A", "Event", ["x"], None, False, 0, 1), ("B", "Event", ["x"], None, False, 1, 1)], "canonical string, type string, aliases array<string>, note string, merge_any_type boolean, pos long, version int")
    assert {r["norm"]: r["canonical"] for r in resolve.alias_index(registry).collect()} == {"a": "A", "b": "B", "x": "B"}


def test_schema_state(spark):
    rows = spark.createDataFrame([("d1", 1, "node", "death", "Event", 2), ("d2", 2, "node", "death", "Damage", 1), ("d2", 2, "node", "new", "Event", 1)], "doc_id string, doc_seq int, scope string, key string, owner string, cnt long")
    got = {r["key"]: r for r in schema_state.master(rows).collect()}
    assert got["death"]["count"] == 3 and got["death"]["owners"] == {"Event": 2, "Damage": 1} and got["death"]["docs"] == ["d1", "d2"] and got["death"]["first_seen"] == "d1"
    bridge = spark.createDataFrame([("node", "death", "death")], "scope string, alias string, canonical string")
    assert [r["key"] for r in schema_state.new_keys(rows, bridge).collect()] == ["new"]


def test_streaming_state(spark, tmp_path):
    from strandline.streaming import state

    schema = "doc_id string, doc_seq int, seq long, id string, s_name string, s_type string, code string, o_name string, o_type string, s_props map<string,string>, p_props map<string,string>, o_props map<string,string>"
    row = ("d1", 1, 1, "T0001", "a", "Event", "CAUSES", "b", "Damage", {"k": "1"}, {}, {"k": "2"})
    for n in (1, 2):  # the same document twice
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        state.start(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        assert state.master_schema(spark, str(tmp_path / "out")).filter("key = 'k'").first()["count"] == 2, n
    nodes, edges = state.graph(spark, str(tmp_path / "out"), ["d1"])
    assert nodes.count() == 2 and edges.count() == 1


def test_predictions(spark):
    times = spark.createDataFrame([("d", "x", "2002-08-30~2002-09-01"), ("d", "y", "2002-09"), ("d", "z", "later")], "doc_id string, name string, t string")
    rows = predict.precedes(times.withColumn("ts", predict.leading_time(F.col("t")))).collect()
    assert [(r["src"], r["dst"]) for r in rows] == [("x", "y")]
    edge = edges_of(spark, [("p", "AMPLIFIES", "D"), ("r", "INCREASES_RISK_OF", "E")], {"p": "Region", "D": "Damage", "r": "RiskFactor"})
    assert predict.amplifiers(edge).first()["damages"] == 1 and predict.risk_factors(edge).first()["event"] == "E"


def test_vocabulary(spark):
    assert len(ontology.ENTITY_TYPES) == 13 and len(ontology.RELATIONS) == 29
    assert {r["axis"] for r in ontology.entity_types(spark).collect()} == set(ontology.AXIS_TYPES)
    assert ontology.relations(spark).count() == 30


def test_statements(spark):
    nodes = spark.createDataFrame([("a'b", "Event", {"1k": "v"}, 1)], "name string, type string, props map<string,string>, seq long")
    edges = spark.createDataFrame([("a'b", "Event", "CAUSES", "c", "Damage", {}, "e", "T0001", 1), ("", "Event", "CAUSES", "c", "Damage", {}, "e", "T0002", 2)], "s_name string, s_type string, code string, o_name string, o_type string, p_props map<string,string>, evidence string, id string, seq long")
    lines = [r["line"] for r in sinks.graph_statements(nodes, edges, "doc").orderBy("part", "ord").collect()]
    assert lines[1] == "// nodes=1 relationships=2" and len(lines) == 4 and "a\\'b" in lines[2]
    back = sinks.parse_statements(spark.createDataFrame([(x,) for x in lines], "value string")).first()
    assert (back["s_name"], back["code"], back["o_name"]) == ("a'b", "CAUSES", "c")


MENTION = "doc_id string, ord struct<f:string,a:bigint,b:bigint>, s_name string, s_type string, code string, o_name string, o_type string"


def test_mentions_are_combined_in_hash_tables(spark):
    odd = [None, -(2**63), -1, 0, 1, 2**63 - 1]
    rows = [(d, (f, a, b), n, "Event", "CAUSES", "y", "Event") for d in ("d", None) for f in ("f", "g", None) for a in odd for b in odd for n in (f"x{a}", "X")]
    given = spark.createDataFrame(rows[::-1], MENTION)
    low = lambda r: tuple((x is not None, x) for x in r[1])
    first = {}
    for r in sorted(rows, key=lambda r: (low(r), r[2])):
        first.setdefault((r[0], r[2].lower()), r)
    found = merge.dedup_first(given)
    assert sorted(map(str, first.values())) == sorted(str((*r[:1], tuple(r[1]), *r[2:])) for r in found.collect())
    steps = [line for line in found._jdf.queryExecution().sparkPlan().toString().splitlines() if "Aggregate" in line]
    assert "HashAggregate" in steps[-1]


def test_ids_of_one_document_are_numbered_in_several_tasks(spark):
    n = 20000
    rows = spark.range(n).selectExpr("if(id % 10 = 0, null, 'd') AS doc_id", "named_struct('f', 'f', 'a', id, 'b', 0L) AS ord", "concat('n', id) AS s_name", "'Event' AS s_type", "'CAUSES' AS code", "'y' AS o_name", "'Event' AS o_type")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = merge.with_ids(rows.repartition(3, "s_name"))
        sizes = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        got = found.select("doc_id", "ord.a", "seq", "id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(sizes) > 1 and max(sizes) < n / 2
    assert sorted(r["seq"] for r in got if r["doc_id"]) == list(range(1, n - n // 10 + 1))
    assert all(r["seq"] == (r["a"] // 10 + 1 if r["doc_id"] is None else r["a"] - r["a"] // 10) and r["id"] == f"T{r['seq']:04d}" for r in got)


def test_large_triple_documents_are_written_in_parts(spark, tmp_path):
    names = "s_name string, s_type string, s_props map<string,string>, code string, p_props map<string,string>, o_name string, o_type string, o_props map<string,string>, evidence string, chunk_id string"
    rows = [(d, k, f"T{k:04d}", f"n{k}", "Event", {"k": "v"}, "CAUSES", {}, "y", "Event", {}, "e", "1") for d, n in (("long", 7), ("short", 3)) for k in range(1, n + 1)]
    given = spark.createDataFrame(rows, f"doc_id string, seq long, id string, {names}")
    values = sinks.triple_documents(given, merge.document_metadata(given, "none", "v1"), most=3)
    assert {(r["doc_id"], r["part"]): len(json.loads(r["value"])["triples"]) for r in values.collect()} == {("long", 0): 3, ("long", 1): 3, ("long", 2): 1, ("short", 0): 3}
    assert "first_seq" not in json.loads(values.filter("part = 0").first()["value"])["metadata"]
    values.repartition("doc_id", "part").write.partitionBy("doc_id", "part").text(str(tmp_path / "documents"))
    triples, about = extractions.read_triple_documents(spark, str(tmp_path / "documents"))
    assert sorted((r["doc_id"], r["seq"], r["id"], r["s_name"]) for r in triples.collect()) == sorted((r[0], r[1], r[2], r[3]) for r in rows)
    assert sorted((r["doc_id"], r["triple_count"]) for r in about.collect()) == [("long", 7), ("short", 3)]


def test_graphs_of_documents_go_to_python_as_numbers(spark):
    edge = spark.createDataFrame([(d, 2 * k, a, b) for d in ("d", None) for k, (a, b) in enumerate(["xy", "zz", "yw"])], "doc_id string, seq long, src string, dst string")
    node = spark.createDataFrame([(d, n, k) for d in ("d", None) for k, n in enumerate("xyzwv")], "doc_id string, name string, first long")
    found = iterative.communities_in_order(edge, node)
    assert sorted((r["name"], r["community"]) for r in found.filter("doc_id is null").collect()) == [("v", 2), ("w", 0), ("x", 0), ("y", 0), ("z", 1)]
    assert sum(r["pagerank"] for r in iterative.pagerank(edge, node).collect()) == pytest.approx(2)
    sent = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "FlatMapGroupsInArrow" in line]
    assert len(sent) == 1 and "name" not in sent[0].split("task(", 1)[1].split(")", 1)[0]


def test_a_streamed_document_is_many_files(spark, monkeypatch, tmp_path):
    from strandline.plans import queries as core

    rows = [(d, k, f"T{k:04d}", f"n{k}", "Event", "CAUSES", f"n{k % 7}", "Damage") for d in ("geo", "trade", "behaviour") for k in range(1, 40)]
    given = spark.createDataFrame(rows, "doc_id string, seq long, id string, s_name string, s_type string, code string, o_name string, o_type string").repartition(4).localCheckpoint()
    paths = iter([str(tmp_path / "inbox"), str(tmp_path / "state")])
    monkeypatch.setattr(core, "triples", lambda *_: given)
    monkeypatch.setattr(core, "scratch", lambda _: next(paths))
    streamed = core.QUERIES["streamed_schema"](spark, "").collect()
    assert len(list((tmp_path / "inbox").glob("*.parquet"))) > 3
    assert sorted(map(str, streamed)) == sorted(map(str, core.QUERIES["master_schema"](spark, "").collect())) and len(streamed) == 5


def test_bags_with_the_same_keys_are_merged_whole(spark):
    """Only the last of bags with the same keys is taken apart; the last value of each key is what counts, null values too."""
    bags = [{"a": "1"}, {"b": "2", "a": "x"}, {"a": "3", "b": "y"}, {"b": None}, {"c": "4"}, {"a": "5"}, None, {}]
    rows = [("d", k, "n", "Event", bag, "CAUSES", "m", "Event", None) for k, bag in enumerate(bags, 1)]
    given = spark.createDataFrame(rows, "doc_id string, seq long, s_name string, s_type string, s_props map<string,string>, code string, o_name string, o_type string, o_props map<string,string>")
    merged = graph.merged_nodes(given)
    assert {r["name"]: r["props"] for r in merged.collect()} == {"n": {"a": "5", "b": None, "c": "4"}, "m": {}}
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Generate explode") :]


def test_nodes_of_a_graph_file_are_merged_once(spark, sf_dir):
    from strandline.plans import queries as core

    assert "map_from_entries" not in core.QUERIES["graph_files"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_mentions_of_large_tables_are_not_sorted_whole(spark, sf_dir):
    """No table is small enough to be broadcast: line items are not sorted for their joins, and events are dealt by size."""
    from strandline.operators.durable import dealt
    from strandline.plans import corpus

    wanted = sorted(map(str, merge.dedup_first(corpus.mentions(spark, sf_dir)).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = merge.dedup_first(corpus.mentions(spark, sf_dir))
        plan = first._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, first.collect())) == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [line for line in plan.splitlines() if "SortMergeJoin" in line and ("l_orderkey" in line or "l_partkey" in line)]
    assert plan.count("ShuffledHashJoin") == 2
    assert dealt(spark.range(1 << 20), "id", mb=2).rdd.getNumPartitions() == 4
    assert dealt(spark.range(100).coalesce(1), "id").rdd.getNumPartitions() == 1


def test_centrality_needs_no_window_over_a_document(spark):
    node = spark.createDataFrame([(d, n, k) for d in ("d", None) for k, n in enumerate("xyz")] + [("one", "x", 2)], "doc_id string, name string, deg long")
    found = graph.with_centrality(node)
    assert sorted((str(r["doc_id"]), r["name"], r["deg_cent"]) for r in found.collect()) == sorted([(d, n, k / 2) for d in ("d", "None") for k, n in enumerate("xyz")] + [("one", "x", 0.0)])
    assert found.columns == [*node.columns, "deg_cent"] and "Window" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_a_document_is_sorted_in_packed_rows(spark):
    """Numbers of any width, null and single documents come through the packing, and a task sorts batches, not edges."""
    wide = 2**33
    rows = [("d", wide + k, -1) for k in range(5)] + [(None, 7, -1), (None, 2**31 - 1, -1)] + [("d", wide + k, wide + k + 1) for k in range(4)] + [("e", 1, -1)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "at": list(range(len(rows))), "a": [r[1] for r in rows], "b": [r[2] for r in rows]})
    packed = pa.Table.from_batches([*iterative._packed([batch, batch.slice(0, 0), batch.slice(11)])])
    assert packed.num_rows == 4
    given = {d: [x.tolist() for x in iterative._unpacked(packed.filter(pa.compute.is_null(packed["doc_id"]) if d is None else pa.compute.equal(packed["doc_id"], d)))] for d in ("d", None, "e")}
    assert given == {"d": [[wide + k for k in range(5)], [7, 8, 9, 10], [wide + k for k in range(4)], [wide + k + 1 for k in range(4)]], None: [[7, 2**31 - 1], [], [], []], "e": [[1, 1], [], [], []]}
    edge = spark.createDataFrame([("d", k, f"n{k}", f"n{k + 1}") for k in range(300)], "doc_id string, seq long, src string, dst string")
    node = spark.createDataFrame([("d", f"n{k}", 2 * k) for k in range(301)], "doc_id string, name string, first long")
    found = iterative.pagerank(edge, node)
    assert found.count() == 301 and sum(r["pagerank"] for r in found.collect()) == pytest.approx(1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan[plan.index("FlatMapGroupsInArrow") :]


def test_nodes_are_not_broadcast(spark):
    """Nodes grow with the input; what Spark takes for their size is that of compressed files."""
    edge = spark.createDataFrame([("d", k, f"n{k}", f"n{k + 1}") for k in range(3)], "doc_id string, seq long, src string, dst string")
    node = spark.createDataFrame([("d", f"n{k}", "Event", 2 * k) for k in range(4)], "doc_id string, name string, type string, first long")
    paths = spark.createDataFrame([("d", 1, ["n0", "n1", "n2"])], "doc_id string, place long, path array<string>")
    done = iterative.complete_paths(paths, node)
    assert [tuple(r) for r in done.collect()] == [("d", 1, 0)]
    sides = [iterative.pagerank(edge, node)._jdf.queryExecution().executedPlan().toString(), done._jdf.queryExecution().executedPlan().toString()]
    assert not any("BroadcastHashJoin" in side for side in sides)


def test_large_pages_are_parts(spark):
    from strandline.plans import dashboard

    paths = [("d", k, None if k % 2 else f"</{k}", [k, 1]) for k in range(9, 1, -1)]
    tables = {"paths": spark.createDataFrame(paths, "doc_id string, place long, text string, path array<long>").repartition(3), "b_none": spark.createDataFrame([], "doc_id string"), "a": spark.createDataFrame([(None, 2.5), ("d", 1.0), ("d", 1.0)], "doc_id string, x double"), "z_none": spark.createDataFrame([], "x long")}
    whole = dashboard.whole(tables, "<T>", "h.html").collect()
    assert [r["part"] for r in whole] == [0]
    page = whole[0]["html"]
    assert page.startswith("<!doctype html>") and page.endswith("</html>\n") and "<h1>&lt;T&gt;</h1>" in page and '<a href="h.html">' in page
    text = page.split('id="payload">')[1].split("</script>")[0]
    rows = ",".join(f'{{"doc_id":"d","place":{k},' + ("" if k % 2 else f'"text":"<\\/{k}",') + f'"path":[{k},1]}}' for k in range(2, 10))
    assert text == '{"a":[{"x":2.5},{"doc_id":"d","x":1.0},{"doc_id":"d","x":1.0}],"b_none":[],"paths":[' + rows + '],"z_none":[]}'
    for most in (1, 4, 15, 16, 17):  # 11 rows and 5 pieces between them
        parts = sinks.dashboard(dashboard.payload(tables), sorted(tables), "<T>", "h.html", most=most).orderBy("part").collect()
        assert [r["part"] for r in parts] == list(range(-(-16 // most))) and "".join(r["html"] for r in parts) == page
    assert "".join(r["html"] for r in dashboard.whole({"z_none": tables["z_none"]}, "", "").collect()).count('{"z_none":[]}') == 1


def test_a_page_is_written_part_by_part(spark, monkeypatch):
    from strandline.plans import dashboard

    names = "doc_id string, seq long, id string, s_name string, s_type string, code string, o_name string, o_type string"
    given = spark.createDataFrame([("d", k, f"T{k}", f"n{k}", "Event", "CAUSES", f"n{k + 1}", "Damage") for k in range(1, 6)], names)
    once, _ = dashboard.page(given, "t", "")
    make = sinks.dashboard
    monkeypatch.setattr(sinks, "dashboard", lambda *a: make(*a, most=4))
    parts, stats = dashboard.page(given, "t", "")
    parts = list(parts)
    assert len(parts) > 3 and "".join(parts) == "".join(once) and stats["edges"] == 5
