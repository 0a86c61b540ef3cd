"""File sources and the two corpus plans on fixture files."""

import json
import os

import pytest

from tagweave.plans.gnt import read_gnt_words
from tagweave.plans.wlc import read_wlc_words
from tagweave.sources import check_manifest, read_nested_books, read_tagged_lines, variant_path

JONAH_V1 = [["וַֽ/יְהִי֙", "c/1961", "HC/Vqw3ms"], ["דְּבַר", "1697", "HNcmsc"], ["בֶן", "1121 a", "HNcmsc"]]


def _write_books(root, variant, books):
    folder = os.path.join(root, variant)
    os.makedirs(folder, exist_ok=True)
    for name, content in books.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
            json.dump(content, fh, ensure_ascii=False)
    return root


def test_variant_path():
    assert variant_path("/x", "english") == "/x/remapped"
    assert variant_path("/x/", "hebrew") == "/x/hebrew"
    assert variant_path("/x", None) == "/x/hebrew"


def test_wlc_words_end_to_end(spark, tmp_path):
    jonah = [[JONAH_V1, [["אֶל", "413", "HR"], ["ה/עִיר", "d/5892", "HTd/Ncfsa"]]], [[["וַ/יֹּאמֶר", "c/559", "HC/Vqw3ms"]]]]
    root = _write_books(str(tmp_path), "hebrew", {"jonah.json": jonah, "obadiah.json": [[[["x", "1", "HNp"]]]]})
    for dictionary in (True, False):
        words = read_wlc_words(spark, root, allow_missing=True, dictionary=dictionary).orderBy("book_no", "ordinal").collect()
        assert [w.book for w in words] == ["Obadiah"] + ["Jonah"] * 6
        j = [w for w in words if w.book == "Jonah"]
        assert [w.id for w in j] == [32001001001, 32001001002, 32001001003, 32001002004, 32001002005, 32002001006]
        assert [w.verse for w in j] == ["32001001"] * 3 + ["32001002"] * 2 + ["32002001"]
        assert j[0].lemma == "וַֽ/יְהִי֙" and j[0].coreid == "c/1961" and j[0].codes == "HC/Vqw3ms"
        assert j[0].language == "Hebrew"
        assert j[0].MorphologyString.startswith("Part=conjunction|Part=verb,Stem=qal")
        assert words[0].id == 31001001001


def test_wlc_manifest_missing_is_fatal(spark, tmp_path):
    root = _write_books(str(tmp_path), "hebrew", {"jonah.json": [[JONAH_V1]]})
    with pytest.raises(FileNotFoundError):
        read_wlc_words(spark, root, allow_missing=False)


def test_wlc_bad_json_is_fatal(spark, tmp_path):
    folder = tmp_path / "hebrew"
    folder.mkdir()
    (folder / "jonah.json").write_text("{not json", encoding="utf-8")
    with pytest.raises(Exception, match="not a nested book"):
        read_nested_books(spark, str(folder)).collect()


def test_check_manifest(spark):
    present = spark.createDataFrame([("jonah",)], "k string")
    manifest = spark.createDataFrame([("jonah",), ("nahum",)], "k string")
    assert [r.k for r in check_manifest(present, manifest, "k", allow_missing=True).collect()] == ["nahum"]


GNT_LINES = [
    "010101 N- ----NSF- Βίβλος Βίβλος βίβλος βίβλος",
    "010101 N- ----GSF- γενέσεως γενέσεως γενέσεως γένεσις",
    "010102 V- 3AAI-S-- ἐγέννησεν ἐγέννησεν ἐγέννησεν γεννάω",
    "010101 RA ----NSM- ὁ ὁ ὁ ὁ",
]


def test_gnt_words_end_to_end(spark, tmp_path):
    d = tmp_path / "gnt"
    d.mkdir()
    (d / "61-Mt-morphgnt.txt").write_text("\n".join(GNT_LINES) + "\n", encoding="utf-8")
    (d / "README.md").write_text("not a data file", encoding="utf-8")
    words = read_gnt_words(spark, str(d)).orderBy("block", "seq").collect()
    assert [w.verse for w in words] == ["400101", "400101", "400102", "400101"]
    assert [w.ord for w in words] == [1, 2, 1, 1]
    assert [w.id for w in words] == [4001011, 4001012, 4001021, 4001011]
    assert {w.book for w in words} == {"Matthew"}
    assert words[2].morphology.part == "verb" and words[2].morphology.tense == "aorist"
    assert words[0].morphology.person is None and words[0].lemma == "βίβλος"


def test_gnt_crlf_and_short_lines(spark, tmp_path):
    d = tmp_path / "g2"
    d.mkdir()
    (d / "62-Mk-morphgnt.txt").write_bytes(("\r\n".join(GNT_LINES[:2]) + "\r\n").encode("utf-8"))
    words = read_gnt_words(spark, str(d)).collect()
    assert {w.lemma for w in words} == {"βίβλος", "γένεσις"} and {w.book for w in words} == {"Mark"}
    (d / "63-Lk-morphgnt.txt").write_text("010101 N-\n", encoding="utf-8")
    with pytest.raises(Exception, match="malformed line"):
        read_gnt_words(spark, str(d)).collect()


def test_gnt_unmatched_file_name_fails(spark, tmp_path):
    d = tmp_path / "g3"
    d.mkdir()
    (d / "matthew.txt").write_text(GNT_LINES[0] + "\n", encoding="utf-8")
    with pytest.raises(Exception, match="invalid name"):
        read_gnt_words(spark, str(d)).collect()


def test_tagged_lines_keep_file_order_across_splits(spark, tmp_path):
    d = tmp_path / "big"
    d.mkdir()
    n = 20000
    (d / "a.txt").write_text("".join(f"{i:06d} x y z w v u\n" for i in range(n)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        lines = read_tagged_lines(spark, str(d))
        assert lines.rdd.getNumPartitions() > 4
        got = [int(r.line[:6]) for r in lines.orderBy("file", "block", "seq").select("line").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(n))


def test_quarantine_paths(spark, tmp_path):
    from tagweave.plans.gnt import quarantined_lines

    d = tmp_path / "q"
    d.mkdir()
    (d / "61-Mt-morphgnt.txt").write_text(GNT_LINES[0] + "\n010101 N-\n\n" + GNT_LINES[1] + "\n", encoding="utf-8")
    good = read_gnt_words(spark, str(d), on_error="quarantine").collect()
    assert [w.ord for w in sorted(good, key=lambda w: w.seq)] == [1, 2]
    assert sorted(r.line for r in quarantined_lines(spark, str(d)).collect()) == ["", "010101 N-"]
    root = _write_books(str(tmp_path / "w"), "hebrew", {"jonah.json": [[[["a", "1", "HNp"], ["b", "2", "HZ"]]]]})
    for dictionary in (True, False):
        words = read_wlc_words(spark, root, allow_missing=True, dictionary=dictionary, on_error="null").orderBy("ordinal").collect()
        assert words[0].decode_error is None and words[0].MorphologyString == "Part=noun,Type=proper name"
        assert words[1].decode_error == "unknown part of speech Z" and words[1].morphology is None


def test_wlc_english_variant_reads_remapped(spark, tmp_path):
    words = [["a", "1", "HNp"], ["b", "2", "HD"], ["c", "3", "HD"]]
    root = str(tmp_path)
    _write_books(root, "hebrew", {"jonah.json": [[words]]})            # 1 verse of 3 words
    _write_books(root, "remapped", {"jonah.json": [[words[:2], words[2:]]]})  # 2 verses
    heb = [w.id for w in read_wlc_words(spark, root, "hebrew", allow_missing=True).orderBy("ordinal").collect()]
    eng = [w.id for w in read_wlc_words(spark, root, "english", allow_missing=True).orderBy("ordinal").collect()]
    assert heb == [32001001001, 32001001002, 32001001003]
    assert eng == [32001001001, 32001001002, 32001002003]  # same word sequence, new verse boundary


def test_book_lines_and_unknown_books(spark, tmp_path):
    from tagweave.plans.wlc import unknown_books
    from tagweave.sources import list_books, read_nested_books

    d = tmp_path / "hebrew"
    d.mkdir()
    (d / "jonah.json").write_text(json.dumps([[[["a", "1", "HD"]]]]), encoding="utf-8")
    (d / "notes.json").write_text("[]", encoding="utf-8")
    assert sorted(r.book_key for r in list_books(spark, str(d)).collect()) == ["jonah", "notes"]
    assert [r.book_key for r in unknown_books(spark, str(tmp_path)).collect()] == ["notes"]
    lines = tmp_path / "lines"
    lines.mkdir()
    rows = [{"book_key": "jonah", "book": [[[["a", "1", "HD"]]]]}, {"book_key": "nahum", "book": [[[["b", "2", "HNp"]]]]}]
    (lines / "books.json").write_text("\n".join(map(json.dumps, rows)) + "\n", encoding="utf-8")
    got = read_nested_books(spark, str(lines), layout="lines").collect()
    assert sorted((r.book_key, r.book[0][0][0][2]) for r in got) == [("jonah", "HD"), ("nahum", "HNp")]
    (lines / "bad.json").write_text("not json\n", encoding="utf-8")
    with pytest.raises(Exception, match="not a nested book"):
        read_nested_books(spark, str(lines), layout="lines").collect()
