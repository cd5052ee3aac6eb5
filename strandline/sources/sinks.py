"""Writers: triple documents, chunks, graph statements, registries, dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_escape, safe_code
from ..functions.triples import literal, node_label, overlay, props_literal
from ..operators.durable import stored


def write_by_document(df: DataFrame, path: str, doc_col: str = "doc_id") -> None:
    """Parquet by document; only documents in df are replaced, so a rerun is idempotent."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(doc_col).parquet(path)


def triple_json(triples: DataFrame) -> DataFrame:
    """One JSON object per triple, in the shape of a triple document."""
    node = lambda p: F.struct(F.col(f"{p}_name").alias("name"), F.col(f"{p}_type").alias("type"), F.col(f"{p}_props").alias("properties"))
    return triples.select(
        "doc_id", "seq", F.to_json(F.struct("id", node("s").alias("subject"), F.struct("code", F.col("p_props").alias("properties")).alias("predicate"), node("o").alias("object"), "evidence", F.col("chunk_id").alias("source_chunk"))).alias("json")
    )


def triple_documents(triples: DataFrame, metadata: DataFrame, most: int = 10_000) -> DataFrame:
    """doc_id, part and value: triple documents, metadata first, triples in order. A document of more than `most` triples is
    several such values, so that none grows with it: their metadata says of which triple each is the first (first_seq)."""
    part = F.floor((F.col("seq") - 1) / most).cast("long")
    rows = triple_json(triples).groupBy("doc_id", part.alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "json"))), lambda t: t["json"]), ",\n").alias("rows"))
    first = F.when(F.col("part") > 0, F.col("part") * most + 1)
    about = F.to_json(F.struct(*[c for c in metadata.columns if c != "doc_id"], first.alias("first_seq")))
    # one line, for writers that end a row with one
    return metadata.join(rows, "doc_id").select("doc_id", "part", F.concat(F.lit('{"metadata":'), about, F.lit(',"triples":['), F.replace("rows", F.lit("\n"), F.lit("")), F.lit("]}")).alias("value"))


def node_statement(name: Column, type_: Column, bag: Column, source: Column) -> Column:
    """MERGE of one node; its source document is appended once."""
    doc = literal(source)
    return F.concat(
        F.lit("MERGE (n:"), node_label(type_), F.lit(" {name: "), literal(name), F.lit("}) SET n += "), props_literal(bag),
        F.lit(", n.sourceDocs = CASE WHEN "), doc, F.lit(" IN coalesce(n.sourceDocs, []) THEN n.sourceDocs ELSE coalesce(n.sourceDocs, []) + "), doc, F.lit(" END;"),
    )


def edge_statement(s_type: Column, s_name: Column, code: Column, o_type: Column, o_name: Column, bag: Column) -> Column:
    return F.concat(
        F.lit("MATCH (a:"), s_type, F.lit(" {name: "), literal(s_name), F.lit("}), (b:"), o_type, F.lit(" {name: "), literal(o_name),
        F.lit("}) MERGE (a)-[r:"), safe_code(code), F.lit("]->(b) SET r += "), props_literal(bag), F.lit(";"),
    )


def graph_statements(nodes: DataFrame, edges: DataFrame, label: str) -> DataFrame:
    """(part, ord, line): header comments, node statements, edge statements. nodes: name, type, props, seq; edges: s_*, code, o_*, p_props, evidence, id, seq."""
    spark = nodes.sparkSession
    head = spark.createDataFrame([(0, 0, f"// Property graph of {label}")], "part int, ord long, line string")
    counts = nodes.select(F.lit(0).alias("is_edge")).union(edges.select(F.lit(1))).agg(F.sum(1 - F.col("is_edge")).alias("n"), F.sum("is_edge").alias("m"))
    head = head.union(counts.select(F.lit(0), F.lit(1).cast("long"), F.format_string("// nodes=%d relationships=%d", F.coalesce("n", F.lit(0)), F.coalesce("m", F.lit(0)))))
    source = F.lit(label)
    node_lines = nodes.filter("name <> ''").select(F.lit(1), F.col("seq").cast("long"), node_statement(F.col("name"), F.col("type"), overlay(F.col("props"), F.create_map(F.lit("name"), F.col("name"), F.lit("ekType"), F.col("type"))), source))
    kept = edges.filter("s_name <> '' and o_name <> ''")
    extra = F.create_map(F.lit("evidence"), F.col("evidence"), F.lit("sourceDoc"), source, F.lit("tripleId"), F.col("id"))
    edge_lines = kept.select(F.lit(2), F.col("seq").cast("long"), edge_statement(F.col("s_type"), F.col("s_name"), F.col("code"), F.col("o_type"), F.col("o_name"), overlay(F.col("p_props"), extra)))
    return head.union(node_lines).union(edge_lines)


def write_statements(statements: DataFrame, path: str) -> None:
    statements.orderBy("part", "ord").select("line").write.mode("overwrite").text(path)


def registry_json(registry: DataFrame) -> DataFrame:
    entity = F.struct("type", "aliases", "note", "merge_any_type")
    return registry.agg(F.to_json(F.struct(F.coalesce(F.max("version"), F.lit(1)).alias("version"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("canonical", entity)))).alias("entities"))).alias("json"))


PAGE = """<!doctype html><html lang="en"><head><meta charset="utf-8"><title>{title}</title><style>
body{font:14px sans-serif;margin:1em auto;max-width:1100px;color:#222}section{margin:1.5em 0}h2{font-size:1.1em}
table{border-collapse:collapse}td,th{padding:2px 6px;text-align:left;font-size:12px}td.n{text-align:right}
svg,canvas{border:1px solid #ddd;width:100%}.bar{background:#4e79a7;height:10px;display:inline-block}</style></head>
<body><p>{home}</p><h1>{title}</h1><div id="views"></div><script type="application/json" id="payload">{payload}</script><script>
const data=JSON.parse(document.getElementById("payload").textContent),root=document.getElementById("views");
function part(title,note){const s=root.appendChild(document.createElement("section"));s.appendChild(document.createElement("h2")).textContent=title;if(note)s.appendChild(document.createElement("p")).textContent=note;return s}
function table(box,rows,paint){if(!rows||!rows.length)return;const t=box.appendChild(document.createElement("table")),keys=Object.keys(rows[0]),head=t.insertRow();
keys.forEach(k=>head.appendChild(document.createElement("th")).textContent=k);rows.forEach(r=>{const tr=t.insertRow();keys.forEach(k=>{const c=tr.insertCell();c.textContent=r[k];if(typeof r[k]=="number"){c.className="n";if(paint)paint(c,r[k])}})})}
function bars(box,rows,label,value){const most=Math.max(1,...rows.map(r=>r[value]));rows.forEach(r=>{const d=box.appendChild(document.createElement("div")),b=document.createElement("span");b.className="bar";b.style.width=60*r[value]/most+"%";d.append(b," "+r[label]+" "+r[value])})}
function heat(rows){const most=Math.max(1,...rows.flatMap(r=>Object.values(r).filter(x=>typeof x=="number")));return (c,x)=>{c.style.background="rgba(225,87,89,"+x/most+")"}}
const NS="http://www.w3.org/2000/svg";function el(svg,tag,at,text){const e=svg.appendChild(document.createElementNS(NS,tag));for(const k in at)e.setAttribute(k,at[k]);if(text)e.textContent=text;return e}
function flow(box,rows){const svg=el(box,"svg",{viewBox:"0 0 1000 600"}),place={},size={};rows.forEach(r=>{size[r.source_index]=(size[r.source_index]||0)+(r.stage=="in"?r.value:0);size[r.target_index]=(size[r.target_index]||0)+r.value});
const total=rows.filter(r=>r.stage=="in").reduce((a,r)=>a+r.value,0)||1,cols=[{},{},{}];rows.forEach(r=>{cols[r.stage=="in"?0:1][r.source_index]=r.source;cols[r.stage=="in"?1:2][r.target_index]=r.target});
cols.forEach((c,k)=>{let y=10;Object.keys(c).forEach(i=>{const h=Math.max(3,500*(size[i]||0)/total);place[i]={x:20+k*460,y,h,l:0,r:0};el(svg,"rect",{x:20+k*460,y,width:14,height:h,fill:"#76b7b2"});el(svg,"text",{x:40+k*440,y:y+10,"font-size":10},c[i]);y+=h+8})});
rows.forEach(r=>{const a=place[r.source_index],b=place[r.target_index],w=Math.max(1,500*r.value/total),y1=a.y+a.r+w/2,y2=b.y+b.l+w/2;a.r+=w;b.l+=w;el(svg,"path",{d:`M${a.x+14},${y1}C${a.x+230},${y1} ${b.x-200},${y2} ${b.x},${y2}`,fill:"none",stroke:"#4e79a7","stroke-opacity":.3,"stroke-width":w})})}
function layered(box,nodes,edges){const deep=Math.max(1,...nodes.map(n=>n.layer)),svg=el(box,"svg",{viewBox:"0 0 1000 500"}),at={};nodes.forEach(n=>at[n.name]={x:40+900*n.layer/deep,y:500*(n.slot+1)/(n.in_layer+1)});
const most=Math.max(1,...edges.map(e=>e.weight));edges.forEach(e=>{const a=at[e.src],b=at[e.dst];if(a&&b)el(svg,"line",{x1:a.x,y1:a.y,x2:b.x,y2:b.y,stroke:"#e15759","stroke-width":1+7*(e.weight-1)/Math.max(1,most-1),"stroke-opacity":.45+.5*(e.weight-1)/Math.max(1,most-1)})});
nodes.forEach(n=>{el(svg,"circle",{cx:at[n.name].x,cy:at[n.name].y,r:5+2.2*Math.sqrt(n.weight),fill:n.color});el(svg,"text",{x:at[n.name].x+8,y:at[n.name].y-6,"font-size":9},n.name.length>16?n.name.slice(0,15)+"…":n.name)})}
function force(box,nodes,links){const c=box.appendChild(document.createElement("canvas"));c.width=1000;c.height=700;const g=c.getContext("2d"),at={};nodes.forEach((n,i)=>at[n.id]={x:500+300*Math.cos(i),y:350+300*Math.sin(i),vx:0,vy:0,n});const all=Object.values(at);let left=200;
function step(){all.forEach(a=>{for(let k=0;k<30;k++){const b=all[Math.floor(Math.random()*all.length)],dx=a.x-b.x,dy=a.y-b.y,q=dx*dx+dy*dy+50;a.vx+=600*dx/q/30;a.vy+=600*dy/q/30}a.vx+=(500-a.x)*.002;a.vy+=(350-a.y)*.002});
links.forEach(l=>{const a=at[l.source],b=at[l.target];if(!a||!b||a===b)return;const dx=b.x-a.x,dy=b.y-a.y;a.vx+=dx*.005;a.vy+=dy*.005;b.vx-=dx*.005;b.vy-=dy*.005});all.forEach(a=>{a.x+=a.vx*=.8;a.y+=a.vy*=.8});
g.clearRect(0,0,1000,700);g.strokeStyle="rgba(0,0,0,.12)";links.forEach(l=>{const a=at[l.source],b=at[l.target];if(a&&b){g.beginPath();g.moveTo(a.x,a.y);g.lineTo(b.x,b.y);g.stroke()}});all.forEach(a=>{g.fillStyle=a.n.color;g.beginPath();g.arc(a.x,a.y,3+1.5*Math.sqrt(a.n.deg),0,7);g.fill()});if(left-->0)requestAnimationFrame(step)}step()}
const docs=[...new Set((data.stats||[]).map(r=>r.doc_id))];docs.forEach(d=>{const of=k=>(data[k]||[]).filter(r=>r.doc_id==d).map(({doc_id,...r})=>r),say=(of("interpretation")[0]||{});
table(part(d+": totals"),of("stats"));bars(part("Entity types","Most frequent: "+say.top_type+" ("+say.top_type_n+")"),of("types"),"type","mentions");bars(part("Relations","Most frequent: "+say.top_code+" ("+say.top_code_n+"); causal: "+say.causal),of("codes"),"code","mentions");
let h=of("pair_table");table(part("Subject types by object types"),h,heat(h));h=of("code_table");table(part("Subject types by relations"),h,heat(h));table(part("Central nodes"),of("central"));
const f=of("fragmentation")[0]||{};table(part("Communities",f.communities+" communities, the largest of "+f.largest+" nodes, "+f.singletons+" of one"),of("communities"));flow(part("Flows between axes"),of("flows"));
const t=of("trunk")[0];layered(part("Major causal paths",t?"Most shared: "+t.src.slice(0,18)+" → "+t.dst.slice(0,18)+" ("+t.weight+")":""),of("placed"),of("links"));table(part("Paths"),of("paths"));force(part("Network"),of("nodes"),of("edges"))})
</script></body></html>
"""


def dashboard(payload: DataFrame, views: list[str], title: str, home: str, most: int = 100_000) -> DataFrame:
    """part and html: the page with {view: [rows]}, views in the order given, title and home escaped. A page of more than `most`
    rows is several parts, so that no value grows with it; one after the other, by part, they are the page.

    payload: view, json and at (order in the view; its upper 31 bits are a range of rows, counted from the range's first)."""
    spark = payload.sparkSession
    escaped = spark.range(1).select(html_escape(F.lit(title)).alias("title"), html_escape(F.lit(home)).alias("home")).first()
    link = f'<a href="{escaped["home"]}">Home</a>' if home else ""
    before, after = PAGE.replace("{title}", escaped["title"]).replace("{home}", link).split("{payload}")
    rows = stored(payload).withColumn("range", F.shiftright("at", 33))
    held = rows.groupBy("view", "range").agg(F.min("at").alias("first"), F.count("*").alias("n")).collect()
    ranges, frame, place = [], [], 0
    for k, view in enumerate(views):
        frame.append((place, f'{"]," if k else before + "{"}"{view}":['))
        place += 1
        opens = place
        for r in sorted((r for r in held if r["view"] == view), key=lambda r: r["range"]):
            ranges.append((view, r["range"], place - r["first"], opens))
            place += r["n"]
    frame.append((place, ("]}" if views else before + "{}") + after))
    ranges = F.broadcast(spark.createDataFrame(ranges, "view string, range long, plus long, opens long"))
    rows = rows.join(ranges, ["view", "range"]).withColumn("place", F.col("at") + F.col("plus"))
    rows = rows.select("place", F.concat(F.when(F.col("place") == F.col("opens"), "").otherwise(","), F.replace("json", F.lit("</"), F.lit("<\\/"))).alias("text"))
    pieces = rows.union(spark.createDataFrame(frame, "place long, text string")).withColumn("part", F.floor(F.col("place") / most).cast("long"))
    if place >= most:
        pieces = pieces.repartition(place // most + 1, "part")  # before rows of a part are collected, as a task would collect those of many
    return pieces.groupBy("part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda t: t["text"]), "").alias("html"))


def parse_statements(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Triples (s_type, s_name, code, o_type, o_name) from edge statements: the way back from a graph file."""
    text = r"'((?:[^'\\]|\\.)*)'"
    pattern = rf"^MATCH \(a:(\S+) \{{name: {text}\}}\), \(b:(\S+) \{{name: {text}\}}\) MERGE \(a\)-\[r:(\w+)\]->\(b\)"
    line = F.col(line_col)
    back = lambda c: F.regexp_replace(c, r"\\(.)", "$1")
    part = lambda k: F.regexp_extract(line, pattern, k)
    return lines.filter(line.rlike(pattern)).select(part(1).alias("s_type"), back(part(2)).alias("s_name"), part(5).alias("code"), part(3).alias("o_type"), back(part(4)).alias("o_name"))

