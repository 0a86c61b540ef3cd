"""Serialisation (J1-J6) and store shapes."""

import json


from tagweave.functions import decode_positional, is_json, json_columns, record_json
from tagweave.operators import flatten_struct, to_item, to_json_row, to_keyed, to_wide_entity

VALID = ['{"k": 69}', "null", "1", '"a"', "[1,2]", ' {"k":1} ']
INVALID = ['{"k": 69}}', '{"k":', "", "1],[2", "{},{}", '{"a":1} x', "{a:1}", "abc", "1,2", "[1]]"]


def test_is_json_strict(spark):
    df = spark.createDataFrame([(v,) for v in VALID + INVALID], "v string")
    got = {r.v: r.ok for r in df.select("v", is_json("v").alias("ok")).collect()}
    assert all(got[v] for v in VALID)
    assert not any(got[v] for v in INVALID)
    cont = {r.v: r.ok for r in df.select("v", is_json("v", kind="container").alias("ok")).collect()}
    assert cont["null"] is False and cont["[1,2]"] is True


def test_record_json_orders(spark):
    df = spark.createDataFrame([(1, "x", "")], "id bigint, lemma string, codes string")
    declared = df.select(record_json(df, {"lemma": "lemma", "id": "id", "MorphologyString": "codes"}).alias("j")).first().j
    assert list(json.loads(declared)) == ["lemma", "id", "MorphologyString"]
    s = df.select(record_json(df, {"lemma": "lemma", "id": "id", "MorphologyString": "codes"}, key_order="sorted").alias("j")).first().j
    assert list(json.loads(s)) == ["MorphologyString", "id", "lemma"]


def test_omit_empty_nested(spark):
    df = spark.createDataFrame([("V-", "3AAI-S--", "")], "part string, codes string, note string")
    df = df.select(decode_positional("codes", part="part").alias("morphology"), "note")
    j = json.loads(df.select(record_json(df, omit_empty=("morphology", "note")).alias("j")).first().j)
    assert j == {"morphology": {"part": "verb", "person": "third", "tense": "aorist", "voice": "active", "mood": "indicative", "number": "singular"}}


def test_json_columns(spark):
    df = spark.createDataFrame([('{"k": 69, "t": "' + "a" * 300 + '"}',)], "c string")
    r = json_columns(df, "c", {"k": "$.k", "t": "$.t", "m": "$.missing"}).first()
    assert r.k == "69" and len(r.t) == 200 and r.m is None


def test_entities(spark):
    df = spark.createDataFrame([("31001001", 31001001001, "x", "1", "HNp", "Part=noun,Type=proper name")],
                               "verse string, id bigint, lemma string, coreid string, codes string, ms string")
    w = to_wide_entity(df, "verse", "id", {"Lemma": "lemma", "CoreID": "coreid", "MorphCodes": "ms", "UniqueID": "verse", "Codes": "codes"}).first()
    assert w.partition_key == "31001001" and w.row_key == "31001001001" and w.properties["MorphCodes"] == "Part=noun,Type=proper name"
    assert "language" not in w.properties
    k = to_keyed(df, "id").first()
    assert k.key == "31001001001" and k.record.lemma == "x"
    it = to_item(df, "verse", "id").first()
    assert it.attributes["id"].type == "N" and it.attributes["lemma"].type == "S"
    jr = to_json_row(df, "id", ["id", "verse", "lemma"]).first()
    assert jr.id == 31001001001 and json.loads(jr.content) == {"id": 31001001001, "verse": "31001001", "lemma": "x"}
    g = spark.createDataFrame([("V-", "3AAI-S--")], "part string, codes string").select(decode_positional("codes", part="part").alias("m"))
    flat = flatten_struct(g, "m").first()
    assert flat.part == "verb" and flat.degree == ""


def test_flat_entity_and_project_fields(spark):
    from tagweave.operators import project_fields, to_flat_entity

    df = spark.createDataFrame([(7, ["a", "b"])], "id bigint, f array<string>")
    fe = to_flat_entity(df, "id", ["id"]).first()
    assert fe.key == "7" and fe.id == 7
    pf = project_fields(df, "f", ["x", "y", "z"], keep=["id"]).first()
    assert (pf.id, pf.x, pf.y, pf.z) == (7, "a", "b", None)


def test_sorted_keys_inside_arrays_and_maps(spark):
    df = spark.sql("SELECT array(map('b', 1, 'B', 2), map('z', 3)) AS m, named_struct('y', array(named_struct('q', 1, 'P', 2)), 'X', map('k', map('n', 1, 'M', 2))) AS s")
    j = df.select(record_json(df, key_order="sorted").alias("j")).first().j
    assert j == '{"m":[{"B":2,"b":1},{"z":3}],"s":{"X":{"k":{"M":2,"n":1}},"y":[{"P":2,"q":1}]}}'


def test_item_types(spark):
    df = spark.sql("SELECT 'h' AS h, 1 AS n, true AS b, CAST(NULL AS STRING) AS e, array('x', 'y') AS l, map('k', 2.5D) AS m, named_struct('a', false) AS s")
    a = to_item(df, "h").first().attributes
    assert {k: (v.type, v.value) for k, v in a.items()} == {
        "h": ("S", "h"), "n": ("N", "1"), "b": ("BOOL", "true"), "e": ("NULL", None), "l": ("L", '[{"S":"x"},{"S":"y"}]'),
        "m": ("M", '{"k":{"N":"2.5"}}'), "s": ("M", '{"a":{"BOOL":false}}')}


def test_json_columns_of_containers(spark):
    df = spark.createDataFrame([('{"o":{"a":1},"l":[1],"b":true,"n":null,"x":"v"}',), ("not json",), (None,)], "c string")
    rows = json_columns(df, "c", {"o": "$.o", "l": "$.l", "b": "$.b", "n": "$.n", "x": "$.x"}).collect()
    assert tuple(rows[0])[1:] == (None, None, "true", None, "v")
    assert tuple(rows[1])[1:] == (None,) * 5 == tuple(rows[2])[1:]
