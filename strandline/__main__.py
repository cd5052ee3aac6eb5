"""Command lines: python -m strandline <command> ..., one for each step from a document to its dashboard.

The steps run on Spark and write one file each, as the next one reads it; rows are streamed through the driver into that file.
Tables of any size go through the functions that these commands call.
"""

from __future__ import annotations

import argparse
import json
import os
import shutil
import sys
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ontology
from .operators import chunking, graph, merge, resolve, schema_state
from .plans import dashboard
from .sources import documents, extractions, sinks


def uri(path: str) -> str:
    return f"file://{os.path.abspath(path)}"


def spark() -> SparkSession:
    return SparkSession.builder.appName("strandline").config("spark.ui.enabled", "false").getOrCreate()


def write_lines(path: str, lines: Iterator[str]) -> int:
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        for line in lines:
            f.write(line + "\n")
            n += 1
    return n


def extract_text(a: argparse.Namespace) -> None:
    ext = os.path.splitext(a.input)[1].lower()
    if ext not in documents.FORMATS:
        raise SystemExit(f"Unsupported extension: {ext} (use pdf/docx/txt)")
    if ext in (".txt", ".md"):
        shutil.copyfile(a.input, a.output)
    else:
        with open(a.output, "w", encoding="utf-8") as f:
            f.write(documents.read_documents(spark(), uri(a.input)).first()["text"])
    held = spark().read.text(uri(a.output), wholetext=True).select(F.lit(0).alias("doc_id"), F.col("value").alias("text"))
    lines = documents.size_report(held).first()
    print(f"OK: {a.output} ({os.path.getsize(a.output)} bytes, {lines['n_lines'] if lines else 0} lines)")


def chunk_text(a: argparse.Namespace) -> None:
    with open(a.src, encoding="utf-8", errors="replace", newline="") as f:
        source = spark().createDataFrame([(0, f.read())], "doc_id int, text string")
    target = chunking.target_lines(F.lit(a.density).cast("string"), F.lit(a.target_lines or 0))
    os.makedirs(a.out_dir, exist_ok=True)
    names = []
    for r in chunking.chunks(source, target, overlap=a.overlap, most=a.max_chunks).orderBy("chunk_no").toLocalIterator():
        with open(os.path.join(a.out_dir, r["file"]), "w", encoding="utf-8", newline="") as f:
            f.write(r["text"])
        names.append(r["file"])
    print(f"DENSITY={a.density or 'low'} (~{source.select(target.alias('n')).first()['n']} lines/chunk)")
    print("\n".join([f"CHUNKS={len(names)}", *[f"  {x}" for x in names]]))


def _counts(placed: DataFrame, key: str) -> dict:
    return {r[key]: r["mentions"] for r in placed.orderBy("place").collect()}


def _emergent(counted: DataFrame) -> dict:
    out: dict = {}
    for r in merge.ordered_schema(counted).orderBy("owner_place", "key_place").collect():
        out.setdefault(r["owner"], {}).update({r["key"]: r["cnt"]} if r["key"] is not None else {})
    return out


def write_document(triples: DataFrame, metadata: dict, path: str) -> int:
    """A triple document; its triples are streamed."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"metadata": ' + json.dumps(metadata, ensure_ascii=False, indent=2) + ',\n"triples": [')
        for r in sinks.triple_json(triples).orderBy("seq").toLocalIterator():
            f.write((",\n" if n else "\n") + r["json"])
            n += 1
        f.write("\n]}\n")
    return n


def described(triples: DataFrame, label: str, version: str) -> dict:
    """Metadata of a document, always of the triples as they are."""
    types, codes = _counts(merge.type_order(triples), "type"), _counts(merge.code_order(triples), "code")
    schema = {"entity_node_properties": _emergent(merge.emergent_nodes(triples)), "relation_edge_properties": _emergent(merge.emergent_relations(triples))}
    return {"source_document": label, "ontology_version": version, "triple_count": sum(codes.values()), "entity_mention_distribution": types, "predicate_distribution": codes, "emergent_property_schema": schema}


def merge_validate(a: argparse.Namespace) -> None:
    s = spark()
    types, relations = ontology.read_ontology(s, uri(a.ontology))
    valid_types, valid_codes = ([r[0] for r in df.collect()] for df in (types.select("type"), relations.select("code").distinct()))  # a vocabulary
    raw, bad = extractions.read_extractions(s, uri(a.chunks_dir), a.glob)
    raw = graph.cut_lineage(raw.withColumn("doc_id", F.lit(a.source_doc)).withColumn("ord", F.struct("file", "pos")).drop("file", "pos"))
    triples = merge.with_ids(merge.dedup_first(raw))
    if a.bridge and os.path.exists(a.bridge):
        flat = extractions.alias_map(extractions.read_bridge(s, uri(a.bridge)), None)
        triples = merge.canonical_keys(triples, flat, flat)
    triples = graph.cut_lineage(triples)
    metadata = described(triples, a.source_doc, "v1")
    n = write_document(triples, metadata, a.out)
    print(f"raw={raw.count()} deduped={n} -> {a.out}")
    print("entity types:", metadata["entity_mention_distribution"])
    print("relations:", metadata["predicate_distribution"])
    failed = [f"{r['file']}: {r['warning']}" for r in bad.orderBy("file").limit(40).collect()]
    rows = merge.first_warnings(triples, 40, valid_types, valid_codes).orderBy("place").collect()
    print(f"WARNINGS: {bad.count() + (rows[0]['total'] if rows else 0)}")
    for line in [*failed, *[f"[triple {r['seq']}] {'invalid entity type' if r['kind'] == 'type' else 'non-enum relation code'}: {r['value']!r}" for r in rows]][:40]:
        print("  -", line)


def read_document(path: str) -> tuple[DataFrame, str, str]:
    """Triples of one document with doc_id and ord, its label and the version of its vocabulary."""
    triples, about = extractions.read_triple_documents(spark(), uri(path))
    row = about.first()
    return graph.cut_lineage(triples.withColumn("ord", F.col("seq"))), row["doc_id"], row["ontology_version"] or "v1"


def resolve_entities(a: argparse.Namespace) -> None:
    triples, label, version = read_document(a.triples)
    held = extractions.read_registry(spark(), uri(a.registry)) if os.path.exists(a.registry) else extractions.empty_registry(spark())
    done = resolve.resolve(triples, graph.cut_lineage(held), a.jaccard)
    registry = done["registry"]
    text = sinks.registry_json(registry).first()["json"]
    print(f"registry: {registry.count()} canonical entities (aliases: {registry.agg(F.coalesce(F.sum(F.size('aliases')), F.lit(0))).first()[0]})")
    clashes, clusters = done["cross_type"], done["clusters"]
    if a.write:
        applied = done["triples"]
        n = applied.count()
        temporary = f"{a.triples}.new"
        write_document(applied, described(applied, label, version), temporary)
        os.replace(temporary, a.triples)
        print(f"APPLIED: names -> canonical, deduped to {n} triples")
    for r in clashes.orderBy(F.size("forms").desc(), "base").toLocalIterator():
        print(f"    base '{r['base']}': " + ", ".join(f"{f['name']}[{f['type']}]" for f in r["forms"]))
    print(f"REVIEW CLUSTERS (jaccard>={a.jaccard}): {clusters.select('cluster_place').distinct().count()}")
    now = None
    for r in clusters.orderBy("cluster_place", "member_place").toLocalIterator():
        if r["cluster_place"] != now:
            now = r["cluster_place"]
            print(f"  [{r['type']}]")
        print(f"      ({r['freq']})  {r['name']}")
    with open(a.registry, "w", encoding="utf-8") as f:
        f.write(text + "\n")


def update_master_schema(a: argparse.Namespace) -> None:
    """Contributions are kept beside the master file, by document, so that a document that comes again replaces its own."""
    s = spark()
    triples, label, _ = read_document(a.doc)
    label, parts = a.doc_id or label, f"{a.master}.parts"
    seen = s.read.parquet(uri(parts)).select("doc_id", "doc_seq").distinct() if os.path.isdir(parts) else s.createDataFrame([], "doc_id string, doc_seq int")
    known = {r["doc_id"]: r["doc_seq"] for r in seen.collect()}
    order = s.createDataFrame([(label, known.get(label, len(known) + 1))], "doc_id string, doc_seq int")
    bridge = extractions.read_bridge(s, uri(a.bridge)) if os.path.exists(a.bridge) else None
    rows = schema_state.contributions(triples.withColumn("doc_id", F.lit(label)), order, bridge)
    sinks.write_by_document(rows, uri(parts))
    master = schema_state.master(s.read.parquet(uri(parts))).orderBy("scope", F.desc("count"), "key")
    out: dict = {"version": 1, "docs": [k for k, _ in sorted({**known, label: known.get(label, len(known) + 1)}.items(), key=lambda x: x[1])], "node_keys": {}, "relation_keys": {}}
    for r in master.toLocalIterator():
        out[f"{r['scope']}_keys"][r["key"]] = {"count": r["count"], "owners": r["owners"], "docs": r["docs"], "first_seen": r["first_seen"]}
    with open(a.master, "w", encoding="utf-8") as f:
        json.dump(out, f, ensure_ascii=False, indent=2)
    print(f"master updated: {a.master}\n  node canonical keys total: {len(out['node_keys'])}\n  relation canonical keys total: {len(out['relation_keys'])}")
    new = schema_state.new_keys(rows, bridge).orderBy("scope", F.desc("count"), "key").collect()
    print("NEW (consolidation candidates) - " + ", ".join(f"{x}: {sum(r['scope'] == x for r in new)}" for x in ("node", "relation")))
    for r in new:
        print(f"  [{r['scope']}_keys] {r['key']}  (count={r['count']}, owners={r['owners']})")


def to_cypher(a: argparse.Namespace) -> None:
    triples, label, _ = read_document(a.src)
    label = a.doc_id or label
    first = merge.sides(triples).groupBy("name", F.coalesce(F.nullif("type", F.lit("")), F.lit("Other")).alias("type")).agg(F.min(2 * F.col("seq") + F.col("side")).alias("seq"))
    nodes = graph.merged_nodes(triples).join(first, ["name", "type"])
    other = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("Other"))
    edges = triples.withColumn("s_type", other("s_type")).withColumn("o_type", other("o_type"))
    lines = sinks.graph_statements(nodes, edges, label).orderBy("part", "ord").select("line")
    write_lines(a.out, (r["line"] for r in lines.toLocalIterator()))
    print(f"OK: {a.out}  ({nodes.count()} nodes, {triples.count()} relationships)")


def visualize(a: argparse.Namespace) -> None:
    triples, label, _ = read_document(a.src)
    page, stats = dashboard.page(triples.withColumn("doc_id", F.lit(label)), a.title or label, a.home, a.top)
    with open(a.out, "w", encoding="utf-8") as f:
        f.writelines(page)
    print(f"OK: {a.out}\n  " + " ".join(f"{k}={v}" for k, v in stats.items()))


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="strandline", description=__doc__)
    commands = ap.add_subparsers(required=True)

    def command(run, *names: str, **options: dict) -> argparse.ArgumentParser:  # noqa: ANN001
        p = commands.add_parser(run.__name__)
        p.set_defaults(run=run)
        for n in names:
            p.add_argument(n)
        for n, o in options.items():
            p.add_argument("--" + n.replace("_", "-"), **o)
        return p

    command(extract_text, "input", "output")
    p = command(chunk_text, "src", "out_dir", density={"choices": list(ontology.DENSITY_NAMES), "default": None}, target_lines={"type": int, "default": None}, overlap={"type": int, "default": chunking.OVERLAP}, max_chunks={"type": int, "default": chunking.MOST_CHUNKS})
    for name in [k for k in ontology.DENSITY_NAMES if not k.isascii()]:
        p.add_argument(f"--{name}", dest="density", action="store_const", const=name)
    command(merge_validate, "chunks_dir", "out", glob={"default": "meta_*.json"}, ontology={"required": True}, bridge={"default": None}, source_doc={"default": ""})
    command(resolve_entities, "triples", registry={"required": True}, write={"action": "store_true"}, jaccard={"type": float, "default": 0.45})
    command(update_master_schema, "doc", master={"required": True}, bridge={"required": True}, doc_id={"default": ""})
    command(to_cypher, "src", "out", doc_id={"default": ""})
    command(visualize, "src", "out", top={"type": int, "default": 30}, title={"default": ""}, home={"default": ""})
    return ap


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    a.run(a)


if __name__ == "__main__":
    main(sys.argv[1:])
