"""Store shapes of corpus words."""

import json

from pyspark.sql import functions as F


from tagweave.plans.gnt import read_gnt_words
from tagweave.plans.stores import flat_entities, items, json_rows, jsonl_records, wide_entities
from tagweave.plans.wlc import read_wlc_words


def _wlc(spark, tmp_path):
    d = tmp_path / "hebrew"
    d.mkdir()
    (d / "jonah.json").write_text(json.dumps([[[["a", "c/1961", "HC/Vqw3ms"], ["b", "1697", "HNcmsc"]]]]), encoding="utf-8")
    return read_wlc_words(spark, str(tmp_path), allow_missing=True)


def _gnt(spark, tmp_path):
    d = tmp_path / "gnt"
    d.mkdir()
    (d / "61-Mt-morphgnt.txt").write_text("010101 N- ----NSF- Βίβλος Βίβλος βίβλος βίβλος\n", encoding="utf-8")
    return read_gnt_words(spark, str(d))


def test_wlc_shapes(spark, tmp_path):
    w = _wlc(spark, tmp_path)
    rec = jsonl_records(w, "wlc")
    assert rec.columns == ["MorphologyString", "book", "codes", "coreid", "id", "language", "lemma", "morphology", "verse"]
    wide = wide_entities(w, "wlc").orderBy("row_key").first()
    assert wide.partition_key == "32001001" and wide.row_key == "32001001001"
    assert set(wide.properties) == {"Lemma", "CoreID", "MorphCodes", "UniqueID", "Codes"}
    flat = flat_entities(w, "wlc").orderBy("key").first()
    assert flat.key == "32001001001" and flat.record.morphology.startswith("Part=conjunction|")
    row = json_rows(w, "wlc").orderBy("id").first()
    assert list(json.loads(row.content))[:2] == ["codes", "language"] and row.id == 32001001001
    it = items(w, "wlc").first()
    assert it.hash_key == "32001001" and it.attributes["morphology"].type == "L"


def test_gnt_shapes(spark, tmp_path):
    w = _gnt(spark, tmp_path)
    wide = wide_entities(w, "gnt").first()
    assert len(wide.properties) == 14 and wide.properties["Person"] == "" and wide.properties["Case"] == "nominative"
    content = json.loads(json_rows(w, "gnt").first().content)
    assert content["morphology"] == {"part": "noun", "case": "nominative", "number": "singular", "gender": "feminine"}
    assert flat_entities(w, "gnt").first().key == "4001011"
    rec = jsonl_records(w, "gnt").first()
    assert rec.morphology.person is None


def test_write_words_to_stores(spark, tmp_path):
    from tagweave.plans.stores import write_words
    from recording import read_calls

    d = tmp_path / "hebrew"
    d.mkdir()
    book = [[[["w%d" % i, str(i), "HNcmsa"] for i in range(30)]], [[["x", "1", "HD"]] * 5]]
    (d / "jonah.json").write_text(json.dumps(book), encoding="utf-8")
    (d / "nahum.json").write_text(json.dumps([[[["y", "2", "HNp"]]]]), encoding="utf-8")
    words = read_wlc_words(spark, str(tmp_path), allow_missing=True)
    client = "recording:recording_client"
    for store, size, key in (("dynamo", 25, None), ("datastore", 200, "key"), ("table", 1000, "row_key")):
        rec = str(tmp_path / store)
        write_words(words, "wlc", store, client=client, options={"client.record_dir": rec, "base_sleep": "0.01"},
                    writers=2 if store == "dynamo" else None)
        calls = read_calls(rec)
        sent = [i for c in calls for i in c["accepted"]]
        assert len(sent) == 36 and all("book" not in i and "batch_no" not in i for i in sent)
        if store == "dynamo":
            sizes = sorted(c["n"] for c in calls)
            assert sizes == [1, 10, 25]  # Jonah 35 words -> 25 + 10, Nahum 1: batches never span books
        if key:
            assert len({i[key] for i in sent}) == 36
    out = str(tmp_path / "out")
    write_words(words, "wlc", "jsonl", path=out)
    assert spark.read.json(out + "/morphwlc").count() == 36


def test_store_key_has_parts(spark, tmp_path):
    from recording import read_calls
    from tagweave.plans.stores import json_view, write_words

    d = tmp_path / "hebrew"
    d.mkdir()
    (d / "jonah.json").write_text(json.dumps([[[["a", "1", "HC/Vqw3ms"]]]]), encoding="utf-8")
    (d / "nahum.json").write_text(json.dumps([[[["b", "2", "HD"]]]]), encoding="utf-8")
    words = read_wlc_words(spark, str(tmp_path), allow_missing=True).withColumn("id", F.lit(7).cast("bigint"))  # one id, two verses
    rec = str(tmp_path / "table")
    write_words(words, "wlc", "table", client="recording:recording_client", options={"client.record_dir": rec})
    calls = read_calls(rec)
    assert sorted(tuple(c["keys"][0]) for c in calls) == [("32001001", "7"), ("34001001", "7")]
    rows = json_rows(words, "wlc")
    first = rows.where("content LIKE '%HC/V%'").first().content
    assert '"morphology":[{"Part":"conjunction"},{"Conjugation":"sequential imperfect (wayyiqtol)","Gender":"masculine","Number":"singular","Part":"verb","Person":"third","Stem":"qal"}]' in first
    assert sorted(r.Verse for r in json_view(rows, "wlc").collect()) == ["32001001", "34001001"]
