"""The commands from chunk extractions to a dashboard, each on the file that the one before wrote."""

import json
import re

import pytest
from pyspark.sql import functions as F

from strandline import __main__ as commands
from strandline import ontology
from strandline.functions import text as X
from strandline.operators import resolve
from strandline.sources import extractions, sinks


def node(name, type_, **more):
    return {"name": name, "type": type_, **more}


@pytest.fixture
def folder(tmp_path):
    vocabulary = {"entity_types": ontology.ENTITY_TYPES, "entity_axis": ontology.AXIS}
    for k, of in ((1, ontology.RELATIONS), (2, ontology.INFERRED_RELATIONS)):
        vocabulary[f"relations_phase{k}"] = [{"code": c, "from": a, "to": b} for c, (a, b) in of.items()]
    (tmp_path / "ontology.json").write_text(json.dumps(vocabulary))
    (tmp_path / "bridge.json").write_text(json.dumps({"node_keys": {"death": {"aliases": ["deaths", "killed"]}}, "relation_keys": {"timing": {"aliases": ["time"]}}}))
    (tmp_path / "chunks").mkdir()
    first = [
        {"subject": node("Storm", "NaturalHazard", properties={"origin": "x"}), "predicate": {"code": "TRIGGERS", "properties": {"time": "t1"}}, "object": node("Big Flood (2008)", "Event", attributes={"deaths": "3"}), "evidence": "</script> 'q'"},
        {"subject": node("Big Flood", "Event"), "predicate": "CAUSES", "object": node("Loss", "Damage", properties=None, attributes={"unread": "1"})},
    ]
    second = [{"subject": node("STORM", "Event"), "predicate": "TRIGGERS", "object": node("big flood (2008)", "Robot")}, {"subject": node("Big Flood", "Event"), "predicate": "LIKES", "object": node("Shore", None)}]
    (tmp_path / "chunks" / "meta_01.json").write_text(json.dumps({"triples": first}, ensure_ascii=False))
    (tmp_path / "chunks" / "meta_02.json").write_text(json.dumps({"triples": second}))
    (tmp_path / "chunks" / "meta_03.json").write_text("{broken")
    return tmp_path


def test_commands(spark, folder, capsys):
    run = lambda *args: commands.main([str(folder / a) if a.startswith("@") is False and "." in a or a == "chunks" else a.removeprefix("@") for a in args])
    run("merge_validate", "chunks", "doc.json", "--ontology", "ontology.json", "--bridge", "bridge.json", "--source-doc", "flood report")
    said = capsys.readouterr().out
    assert "raw=4 deduped=3" in said and "WARNINGS: 3" in said and "meta_03.json" in said and "LIKES" in said
    doc = json.loads((folder / "doc.json").read_text())
    assert [t["id"] for t in doc["triples"]] == ["T0001", "T0002", "T0003"] and doc["metadata"]["triple_count"] == 3
    assert doc["triples"][0]["object"]["properties"] == {"death": "3"} and doc["triples"][0]["predicate"]["properties"] == {"timing": "t1"}
    assert doc["triples"][1]["object"].get("properties", {}) == {} and doc["triples"][2]["source_chunk"] == "02"
    assert list(doc["metadata"]["entity_mention_distribution"].items())[0] == ("Event", 3)
    assert doc["metadata"]["emergent_property_schema"]["entity_node_properties"]["Event"] == {"death": 1}

    run("resolve_entities", "doc.json", "--registry", "registry.json", "--write")
    assert "APPLIED: names -> canonical, deduped to 3" in capsys.readouterr().out
    registry = json.loads((folder / "registry.json").read_text())
    assert registry["version"] == 2 and registry["entities"] == {"Big Flood": {"type": "Event", "aliases": ["Big Flood (2008)"], "note": "auto: bracket variant", "merge_any_type": False}}
    assert {t["subject"]["name"] for t in json.loads((folder / "doc.json").read_text())["triples"]} == {"Storm", "Big Flood"}

    for _ in range(2):  # the same document again changes nothing
        run("update_master_schema", "doc.json", "--master", "master.json", "--bridge", "bridge.json")
        master = json.loads((folder / "master.json").read_text())
        assert master["docs"] == ["flood report"] and master["node_keys"]["death"] == {"count": 1, "owners": {"Event": 1}, "docs": ["flood report"], "first_seen": "flood report"}
    run("update_master_schema", "doc.json", "--master", "master.json", "--bridge", "bridge.json", "--doc-id", "@other")
    assert json.loads((folder / "master.json").read_text())["node_keys"]["death"]["count"] == 2
    assert "[node_keys] origin" in capsys.readouterr().out

    run("to_cypher", "doc.json", "out.cypher")
    lines = (folder / "out.cypher").read_text().splitlines()
    assert sum(x.startswith("MERGE (n:") for x in lines) == 4 and sum(x.startswith("MATCH") for x in lines) == 3
    assert any("Exposure" not in x and "Other {name: 'Shore'}" in x for x in lines)

    run("visualize", "doc.json", "page.html", "--title", "@<Floods>", "--home", "@index.html")
    page = (folder / "page.html").read_text()
    assert "&lt;Floods&gt;" in page and "<a href=\"index.html\">" in page
    payload = json.loads(re.search(r'id="payload">(.*?)</script>', page, re.S)[1].replace("<\\/", "</"))
    assert payload["stats"][0]["nodes"] == 4 and payload["fragmentation"][0]["communities"] >= 1 and len(payload["edges"]) == 3
    assert payload["paths"][0]["text"] == "Storm > Big Flood > Loss" and payload["trunk"][0]["max_layer"] == 2 and payload["complete"][0]["complete"] == 1


def test_text_commands(spark, tmp_path, capsys):
    (tmp_path / "a.txt").write_bytes("é one\r\ntwo\n".encode() + b"\xff\n" + b"four")
    commands.main(["extract_text", str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    assert (tmp_path / "b.txt").read_bytes() == (tmp_path / "a.txt").read_bytes() and "4 lines" in capsys.readouterr().out
    commands.main(["chunk_text", str(tmp_path / "b.txt"), str(tmp_path / "out"), "--target-lines", "3", "--overlap", "1"])
    assert "CHUNKS=2" in capsys.readouterr().out
    assert [(tmp_path / "out" / f"chunk_{k:02d}.txt").read_text() for k in (0, 1)] == ["é one\ntwo\n�\n", "�\nfour"]
    commands.main(["chunk_text", str(tmp_path / "b.txt"), str(tmp_path / "out"), "--고밀"])
    assert "450 lines" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        commands.main(["extract_text", str(tmp_path / "a.xls"), str(tmp_path / "c")])


REGISTRY = "canonical string, type string, aliases array<string>, note string, merge_any_type boolean, pos long, version int"


def test_registry_without_types(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"version": 4, "entities": {"A": {"aliases": ["a1"]}, "B": {"aliases": ["b1"], "merge_any_type": True}, "C": {"type": "Event", "aliases": ["c1"]}}}))
    registry = extractions.read_registry(spark, str(tmp_path / "r.json"))
    assert {(r["canonical"], r["type"], r["pos"], r["version"]) for r in registry.collect()} == {("A", "", 0, 4), ("B", "", 1, 4), ("C", "Event", 2, 4)}
    rows = [("d", k, n, t, "CAUSES", "z", "Damage") for k, (n, t) in enumerate([("a1", "Other"), ("a1", None), ("b1", "Event"), ("c1", "Event"), ("c1", "Damage")])]
    found = spark.createDataFrame(rows, "doc_id string, ord long, s_name string, s_type string, code string, o_name string, o_type string")
    got = {(r["s_name"], r["s_type"]) for r in resolve.apply_registry(found, registry).collect()}
    assert got == {("a1", "Other"), ("B", "Other"), ("C", "Event"), ("c1", "Damage")}  # (a1, null) is a1 again


def test_captured_clusters_are_skipped(spark):
    nodes = spark.createDataFrame([("north river dam", "Event", 5), ("north river weir", "Event", 2), ("old mill", "Event", 9), ("old mill site", "Event", 3), ("old mill sites", "Event", 4)], "name string, type string, freq long")
    registry = spark.createDataFrame([("north river weir", "Event", ["north river dam"], None, False, 0, 1), ("the river", "Event", ["north river weir"], None, False, 1, 1)], REGISTRY)
    plain = {(r["cluster_place"], r["member_place"], r["name"]) for r in resolve.review_clusters(nodes).collect()}
    assert plain == {(1, 1, "old mill"), (1, 2, "old mill sites"), (1, 3, "old mill site"), (2, 1, "north river dam"), (2, 2, "north river weir")}
    assert {r["cluster"] for r in resolve.review_clusters(nodes, registry).collect()} == {"old mill"}


def test_registry_grows_in_place(spark):
    old = spark.createDataFrame([("B", "Event", ["b"], "n", True, 0, 3), ("A", "", [], None, False, 1, 3)], REGISTRY)
    merges = spark.createDataFrame([("Z", "Event", "z"), ("C", "Damage", "c"), ("B", "Event", "b2")], "canonical string, type string, alias string")
    got = [(r["canonical"], r["aliases"], r["note"], r["pos"], r["version"]) for r in resolve.extend_registry(old, merges, "auto").orderBy("pos").collect()]
    assert got == [("B", ["b", "b2"], "n", 0, 4), ("A", [], None, 1, 4), ("C", ["c"], "auto", 2, 4), ("Z", ["z"], "auto", 3, 4)]
    same = resolve.extend_registry(old, merges.limit(0), "auto").collect()
    assert {r["version"] for r in same} == {3} and resolve.extend_registry(old.limit(0), merges.limit(0), "x").count() == 0


def test_folding_beyond_ascii(spark):
    names = spark.createDataFrame([("Ｆｌｏｏｄ　（２００８）",), ("STRAßE ’x’",), ("Plain Name",), (None,), ("ﬁre №5",)], "s string")
    got = [tuple(r) for r in names.select(X.folded(F.col("s")), X.nfkc(F.col("s")), X.loose_key(F.col("s")), X.base_name(F.col("s"))).collect()]
    assert got == [("flood (2008)", "Flood (2008)", "flood", "flood"), ("strasse ’x’", "STRAßE ’x’", "strassex", "strasse ’x’"), ("plain name", "Plain Name", "plainname", "plain name"), ("", "", "", ""), ("fire no5", "fire No5", "fireno5", "fire no5")]


def test_added_properties_win(spark):
    bag = {"name": "old", "ekType": "old", "tripleId": "old", "evidence": "old", "k": "v"}
    nodes = spark.createDataFrame([("n", "Event", bag, 1)], "name string, type string, props map<string,string>, seq long")
    edges = spark.createDataFrame([("n", "Event", "CAUSES", "m", "Damage", bag, "new", "T9", 1)], "s_name string, s_type string, code string, o_name string, o_type string, p_props map<string,string>, evidence string, id string, seq long")
    lines = [r["line"] for r in sinks.graph_statements(nodes, edges, "doc").orderBy("part", "ord").collect()]
    assert all(x in lines[2] for x in ("name: 'n'", "ekType: 'Event'", "tripleId: 'old'", "k: 'v'")) and "ekType: 'old'" not in lines[2]
    assert all(x in lines[3] for x in ("tripleId: 'T9'", "evidence: 'new'", "k: 'v'", "sourceDoc: 'doc'", "name: 'old'")) and "tripleId: 'old'" not in lines[3]
