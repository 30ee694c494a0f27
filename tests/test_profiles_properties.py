"""Profile assembly and property mapping cases."""

import pytest

from pyspark.sql import functions as F

from quarry.operators.profiles import DEFAULTS, ProfileConfig, resolve_profiles
from quarry.operators.properties import RuleSet, map_properties
from quarry.operators.responses import parse_responses
from quarry.plans import fixture_profiles


def test_fixture_profiles(spark):
    got = {r.label: (r.status, r.content_strategy) for r in resolve_profiles(spark, fixture_profiles.config()).collect()}
    assert got["application/msword"] == ("complete", "combine")      # alias → chain
    assert got["image/jpeg"] == ("complete", "only_extracted")       # reference word accepted
    assert got["loop-a"][0] == "incomplete"                          # loop
    assert got["dangling"][0] == "incomplete"
    assert got["partial"][0] == "incomplete"
    assert got["application/x-blocked"][0] == "incomplete"           # off


def test_from_dict_inherits_alias(spark):
    cfg = ProfileConfig.from_dict({"base": dict(DEFAULTS), "x/y": {"inherits": "base", "allow_ocr": True},
                                   "x/z": False, "x/w": None})
    assert cfg.warnings and "inherits" in cfg.warnings[0]
    got = {r.label: (r.status, r.allow_ocr) for r in resolve_profiles(spark, cfg).collect()}
    assert got["x/y"] == ("complete", True)
    assert "x/w" not in got


def test_rule_precedence(spark):
    props = spark.createDataFrame([([(0, "dc:source", ["s"], False), (1, "meta:keyword", ["k"], False),
                                     (2, "Other", ["o"], False)],)],
                                  "p array<struct<pos:int,name:string,values:array<string>,is_list:boolean>>")

    def names(rules):
        return [(m.name, m.id) for m in props.select(map_properties(F.col("p"), rules).alias("m")).first().m]
    assert names(RuleSet()) == [("dc-source", "exif-dc-source"), ("Other", "exif-Other")]
    assert names(RuleSet({"*": False})) == [("dc-source", "exif-dc-source")]
    assert names(RuleSet({"meta:keyword": True})) == [("dc-source", "exif-dc-source"), ("meta:keyword", "exif-meta:keyword"), ("Other", "exif-Other")]
    assert names(RuleSet({"!": True})) == [("dc:source", "exif-dc:source"), ("meta:keyword", "exif-meta:keyword"), ("Other", "exif-Other")]


def test_parse_responses(spark):
    bodies = [(1, '{"z:name":"v","a:name":["x","y"],"X-TIKA:content":"  body  "}'),
              (2, '{"a":"1","b":"2","a":"3"}'), (3, '{"n":2,"t":true,"s":"[1]","e":null}'),
              (4, "{}"), (6, "[1,2]"), (7, "{bad")]
    df = parse_responses(spark.createDataFrame(bodies, "id int, body string"))
    got = {r.id: r for r in df.collect()}
    assert [(p.name, p.values, p.is_list) for p in got[1].properties] == [("z:name", ["v"], False), ("a:name", ["x", "y"], True)]
    assert got[1].text == "body"
    assert [(p.name, p.values) for p in got[2].properties] == [("a", ["3"]), ("b", ["2"])]
    assert [(p.name, p.values, p.is_list) for p in got[3].properties] == [
        ("n", ["2"], False), ("t", ["true"], False), ("s", ["[1]"], False), ("e", [None], False)]
    assert got[4].properties == [] and got[4].text == ""
    assert not got[6].parsed_ok and not got[7].parsed_ok


def test_batch_formatter_is_the_column_form(spark):
    from pyspark.sql import functions as F

    from quarry.operators import properties as P

    def upper(tags, values):
        import pyarrow.compute as pc
        return pc.binary_join_element_wise(tags, pc.utf8_upper(values), ":")

    P.register_batch_formatter("test_upper_arrow", upper)
    P.register_formatter("test_upper", lambda tag, v: F.concat(tag, F.lit(":"), F.upper(v)))
    P.register_batch_formatter("test_short", lambda tags, values: values[:1])
    kind = "array<struct<pos: int, name: string, values: array<string>, is_list: boolean>>"
    rows = [(1, [(0, "a", ["x", "y", None], True), (1, "b", [], True), (2, "c", ["<z>"], False)]), (2, []), (3, None), (4, [(0, "drop", ["q"], False)]), (5, [(0, "a", ["é"], False)])]
    df = spark.createDataFrame(rows, f"id int, p {kind}")
    user = {"a": ("Tag", "F"), "b": "B", "drop": False}
    both = [df.select("id", P.map_properties(F.col("p"), P.RuleSet(user, formatter=f)).alias("m")).orderBy("id").collect() for f in ("test_upper", "test_upper_arrow")]
    assert both[0] == both[1] and both[0][0].m[0]["values"] == ["F:X", "F:Y", None]
    with pytest.raises(Exception, match="as many values"):
        df.select("id", P.map_properties(F.col("p"), P.RuleSet(user, formatter="test_short")).alias("m")).orderBy("id").collect()
