import pytest
from pyspark.sql import functions as F

from strandline.functions import text as X
from strandline.functions import triples as P


def values(spark, rows, column, schema="s string"):
    return [r[0] for r in spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema).select(column).collect()]


def test_names(spark):
    assert values(spark, ["A b C　", None, ""], X.norm(F.col("s"))) == ["abc", "", ""]
    assert values(spark, ["  Ｆｏｏ  “x” `y` ", "Straße"], X.trivial_norm(F.col("s"))) == ["foo “x” 'y'", "strasse"]
    assert values(spark, ["화재(2008) A-1", "[x]", None], X.loose_key(F.col("s"))) == ["화재a1", "", ""]
    assert values(spark, ["태풍 루사 (RUSA) [2002]", "(a) b", "X（2010）"], X.base_name(F.col("s"))) == ["태풍 루사", "(a) b", "x(2010)"[:1]]
    assert values(spark, ["abcdef", "a b", "abc", " a "], X.is_specific(F.col("s"))) == [True, True, False, False]


def test_tokens_and_similarity(spark):
    rows = [("2010 산사태", "2011 산사태"), ("", "a"), ("a b", "b a")]
    got = values(spark, rows, X.jaccard(X.tokens(F.col("a")), X.tokens(F.col("b"))), "a string, b string")
    assert got == [pytest.approx(1 / 3), 0.0, 1.0]
    assert values(spark, [("ab", "xaby"), ("", "a")], X.contains_either(F.col("a"), F.col("b")), "a string, b string") == [True, False]


def test_markup(spark):
    assert values(spark, ["<w:p>a &amp; b</w:p>c<br/>", "&eacute;"], X.strip_markup(F.col("s"))) == ["a & b\nc", "é"]
    assert values(spark, ["<a b='\"'>"], X.html_escape(F.col("s"))) == ["&lt;a b=&#x27;&quot;&#x27;&gt;"]
    assert values(spark, ["x" * 17, "x" * 18], X.shortened(F.col("s"))) == ["x" * 17, "x" * 16 + "…"]
    assert values(spark, ["1h", "", "한", "ok"], X.safe_key(F.col("s"))) == ["p_1h", "p_", "_", "ok"]
    assert values(spark, ["a-b", None], X.safe_code(F.col("s"))) == ["A_B", "RELATED_TO"]


def test_predicates_and_bags(spark):
    rows = ['{"code": "CAUSES", "properties": {"a": 1, "b": null}}', "CAUSES", '{"x": 1}']
    assert values(spark, rows, P.pred_code(F.col("s"))) == ["CAUSES", "CAUSES", None]
    assert values(spark, rows, P.pred_props(F.col("s"))) == [{"a": "1", "b": None}, {}, {}]
    pairs = [(None, '{"k": 1}'), ('{"j": "x"}', '{"k": 1}'), (None, None)]
    assert values(spark, pairs, P.node_props(F.col("a"), F.col("b")), "a string, b string") == [{"k": "1"}, {"j": "x"}, {}]
    bag = F.from_json("s", P.BAG)
    aliases = F.create_map(F.lit("x"), F.lit("z"), F.lit("y"), F.lit("z"))
    got = values(spark, ['{"x": 1, "k": 2, "y": 3}'], P.rename_keys(bag, aliases))
    assert list(got[0].items()) == [("z", "3"), ("k", "2")]
    assert values(spark, ['{"a": "it\'s\\n \\\\ ", "e": "", "n": null}'], P.props_literal(bag)) == ["{a: 'it\\'s  \\\\'}"]
    kinds = P.json_kinds(F.col("s"))
    assert values(spark, ['{"a": 5, "b": true, "c": "5"}'], P.props_literal(bag, kinds)) == ["{a: 5, b: true, c: '5'}"]


def test_labels(spark):
    assert values(spark, ["Event", "RiskFactor", "Robot"], P.node_label(F.col("s"))) == ["Event", "Hazard:RiskFactor", "Other:Robot"]
    assert values(spark, [("", None, "/x/doc_1.json"), ("L", "s", "p"), ("", "s", "p")], P.document_label(F.col("a"), F.col("b"), F.col("c")), "a string, b string, c string") == ["doc_1", "L", "s"]
    assert values(spark, [7, 12345], P.triple_id(F.col("s")), "s int") == ["T0007", "T12345"]


def test_bags_are_computed_once_in_lambdas(spark):
    rows = spark.createDataFrame([('{"a":"1","b":"2"}', {"b": "3", "c": "4"}), (None, {"b": "3"})], "raw string, extra map<string,string>")
    bag = P.rename_keys(P.overlay(F.from_json("raw", P.BAG), F.col("extra")), F.create_map(F.lit("c"), F.lit("a")))
    found = rows.select(bag.alias("bag"))
    assert [r["bag"] for r in found.collect()] == [{"a": "4", "b": "3"}, None]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
