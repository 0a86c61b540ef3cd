"""Tree-shaped tag decode against the golden rows (FIXTURES §4)."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.functions import decode_tree, language, split_tag, tag_string, tree_error
from tagweave.operators import decode_by_dictionary, decode_tree_columns

GOLDEN = [
    ("HNcmsc", "Hebrew", "Part=noun,Type=common,Gender=masculine,Number=singular,State=construct"),
    ("HNp", "Hebrew", "Part=noun,Type=proper name"),
    ("HD", "Hebrew", "Part=adverb"),
    ("HVqp3ms", "Hebrew", "Part=verb,Stem=qal,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    ("HVqrmsa", "Hebrew", "Part=verb,Stem=qal,Conjugation=participle active,Gender=masculine,Number=singular,State=absolute"),
    ("HVqc", "Hebrew", "Part=verb,Stem=qal,Conjugation=infinitive construct"),
    ("HC/Vqw3ms", "Hebrew", "Part=conjunction|Part=verb,Stem=qal,Conjugation=sequential imperfect (wayyiqtol),Person=third,Gender=masculine,Number=singular"),
    ("HRd/Ncmsa", "Hebrew", "Part=preposition,preposition=definite article|Part=noun,Type=common,Gender=masculine,Number=singular,State=absolute"),
    ("HTd/Ncmsa", "Hebrew", "Part=particle,Type=definite article|Part=noun,Type=common,Gender=masculine,Number=singular,State=absolute"),
    ("HNcmpc/Sp1cs", "Hebrew", "Part=noun,Type=common,Gender=masculine,Number=plural,State=construct|Part=suffix,Type=pronominal,Person=first,Gender=common (verb),Number=singular"),
    ("HAcfda", "Hebrew", "Part=adjective,Type=cardinal number,Gender=feminine,Number=dual,State=absolute"),
    ("HPp3ms", "Hebrew", "Part=pronoun,Type=personal,Gender=masculine,Number=singular"),
    ("HPdxms", "Hebrew", "Part=pronoun,Type=demonstrative,Gender=masculine,Number=singular"),
    ("HPxms", "Hebrew", "Part=pronoun,Type=,Person=,Gender="),
    ("AVqp3ms", "Aramaic", "Part=Verb,Stem=peal,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    ("AVtp3ms", "Aramaic", "Part=Verb,Stem=hishtaphel,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    ("HVtp3ms", "Hebrew", "Part=verb,Stem=hithpael,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    ("HVap3ms", "Hebrew", "Part=verb,Stem=,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    ("HCx", "Hebrew", "Part=conjunction,conjunction="),
    ("XNcmsa", "", "Part=noun,Type=common,Gender=masculine,Number=singular,State=absolute"),
]
MUST_FAIL = ["", "H", "HC//Np", "HZ", "XVqp3ms", "HTdx", "HCxy", "HNcmsax"]


def test_golden_string_and_language(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in GOLDEN], "tag string")
    got = {r.tag: (r.lang, r.s) for r in df.select("tag", language("tag").alias("lang"), tag_string(decode_tree("tag")).alias("s")).collect()}
    for tag, lang, s in GOLDEN:
        assert got[tag] == (lang, s), tag


def test_map_keys_in_path_order_part_first(spark):
    df = spark.createDataFrame([("HVqrmsa",)], "tag string")
    keys = df.select(F.map_keys(decode_tree("tag")[0]).alias("k")).first().k
    assert keys == ["Part", "Stem", "Conjugation", "Gender", "Number", "State"]


@pytest.mark.parametrize("tag", MUST_FAIL)
def test_errors_raise(spark, tag):
    df = spark.createDataFrame([(tag,)], "tag string")
    with pytest.raises(Exception, match="invalid tag"):
        df.select(decode_tree("tag")).collect()


def test_errors_null_mode_and_reason(spark):
    df = spark.createDataFrame([(t,) for t in MUST_FAIL] + [("HNp",), (None,)], "tag string")
    rows = df.select("tag", tree_error("tag").alias("e"), decode_tree("tag", on_error="null").alias("d")).collect()
    for r in rows:
        if r.tag in MUST_FAIL:
            assert r.e is not None and r.d is None
        else:
            assert r.e is None
    reasons = {r.tag: r.e for r in rows}
    assert reasons["HZ"] == "unknown part of speech Z"
    assert reasons["XVqp3ms"] == "unknown part of speech VX"
    assert reasons["HC//Np"] == "empty segment"


def test_pronoun_person_opt_in(spark):
    df = spark.createDataFrame([("HPp3ms",), ("HPdxms",)], "tag string")
    got = [r.s for r in df.select(tag_string(decode_tree("tag", pronoun_person=True)).alias("s")).collect()]
    assert got == [
        "Part=pronoun,Type=personal,Person=third,Gender=masculine,Number=singular",
        "Part=pronoun,Type=demonstrative,Gender=masculine,Number=singular",
    ]


def test_split_tag(spark):
    df = spark.createDataFrame([("HNcmpc/Sp1cs",), ("HD",)], "tag string")
    assert [r.s for r in df.select(split_tag("tag").alias("s")).collect()] == [["Ncmpc", "Sp1cs"], ["D"]]


# --- property test: random valid tags vs an independent walk of the rules ---

_LOOK = {
    "A": "acgo", "N": "cgp", "P": "dfipr", "S": "dhnp", "T": "adeijmnor", "R": "d",
    "person": "123", "gender": "bcfm", "number": "dps", "state": "acd",
    "stemH": "qNpPhHtoOrmMkKQlLfDjiucvwyz", "stemA": "qQupPMahseHitvwozrfbcmlLOG", "conj": "pqiwhjvrsac",
}


def _random_segment(rng, lang):
    pos = rng.choice("CDANPRSTV")
    if pos in "CD":
        return pos + ("x" if rng.random() < 0.2 else "")
    if pos in "AN":
        letters = [rng.choice(_LOOK[pos]), rng.choice(_LOOK["gender"]), rng.choice(_LOOK["number"]), rng.choice(_LOOK["state"])]
    elif pos == "P":
        t = rng.choice(_LOOK["P"] + "x")
        if t == "x":
            letters = [t, rng.choice(_LOOK["person"]), rng.choice(_LOOK["gender"]), rng.choice(_LOOK["number"])]
        else:
            letters = [t, rng.choice("123x"), rng.choice(_LOOK["gender"]), rng.choice(_LOOK["number"]), rng.choice(_LOOK["state"])]
    elif pos in "RT":
        letters = [rng.choice(_LOOK[pos])]
    elif pos == "S":
        letters = [rng.choice(_LOOK["S"]), rng.choice(_LOOK["person"]), rng.choice(_LOOK["gender"]), rng.choice(_LOOK["number"])]
    else:
        c = rng.choice(_LOOK["conj"])
        letters = [rng.choice(_LOOK["stem" + lang]), c]
        if c in "rs":
            letters += [rng.choice(_LOOK["gender"]), rng.choice(_LOOK["number"]), rng.choice(_LOOK["state"])]
        else:
            letters += [rng.choice(_LOOK["person"]), rng.choice(_LOOK["gender"]), rng.choice(_LOOK["number"]), rng.choice(_LOOK["state"])]
    cut = rng.randint(0, len(letters))  # tags may stop early
    return pos + "".join(letters[:cut])


def _expected_keys(seg):
    """Attribute names in order, walking the rules independently."""
    pos, letters = seg[0], seg[1:]
    keys = ["Part"]
    if pos in "CD":
        names = ["conjunction" if pos == "C" else "adverb"]
    elif pos in "AN":
        names = ["Type", "Gender", "Number", "State"]
    elif pos == "P":
        names = ["Type", "Person", "Gender", "Number"] if letters[:1] == "x" else ["Type", None, "Gender", "Number", "State"]
    elif pos == "R":
        names = ["preposition"]
    elif pos == "T":
        names = ["Type"]
    elif pos == "S":
        names = ["Type", "Person", "Gender", "Number"]
    else:
        names = ["Stem", "Conjugation"] + (["Gender", "Number", "State"] if letters[1:2] in ("r", "s") else ["Person", "Gender", "Number", "State"])
    keys += [n for n in names[: len(letters)] if n]
    return keys


def test_random_tags_keys_and_dictionary_equal(spark):
    rng = random.Random(7)
    tags = []
    for _ in range(400):
        lang = rng.choice("HA")
        tags.append(lang + "/".join(_random_segment(rng, lang) for _ in range(rng.randint(1, 3))))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "i int, tag string")
    rows = df.select("i", "tag", decode_tree("tag").alias("m"), F.transform(decode_tree("tag"), F.map_keys).alias("k")).collect()
    for r in rows:
        segs = r.tag[1:].split("/")
        assert r.k == [_expected_keys(s) for s in segs], r.tag
    by_row = {r.i: r.m for r in rows}
    by_dict = {r.i: r.morphology for r in decode_by_dictionary(df, "tag").select("i", "morphology").collect()}
    assert by_row == by_dict


def test_wide_columns(spark):
    df = spark.createDataFrame([("HRd/Ncmsa",)], "tag string")
    rows = decode_tree_columns(df, "tag").orderBy("segment").collect()
    assert rows[0].Part == "preposition" and rows[0].preposition == "definite article" and rows[0].Type is None
    assert rows[1].State == "absolute" and rows[1].segment == 2


def test_no_path_repeats_an_attribute():
    # map_from_entries fails on a duplicate key; the grammar paths never repeat one
    from tagweave.functions import tables

    for key, path in tables.TREE_PATHS.items():
        names = [n for n, _ in path if n != tables.SKIP]
        assert len(names) == len(set(names)) and "Part" not in names, key
        for _, lut in path:
            assert lut is None or all(len(code) == 1 for code in tables.TREE_LOOKUPS[lut]), key


def test_decode_by_name_column_and_sql(spark):
    # column names that match lambda variable names must not be shadowed
    df = spark.createDataFrame([("HNcmsc", "HD")], "p string, s string")
    r = df.select(tag_string(decode_tree("p")).alias("a"), tag_string(decode_tree(F.col("s"))).alias("b"),
                  tag_string(decode_tree(F.concat(F.lit("H"), F.lit("Np")))).alias("c")).first()
    assert (r.a, r.b, r.c) == ("Part=noun,Type=common,Gender=masculine,Number=singular,State=construct", "Part=adverb",
                               "Part=noun,Type=proper name")
    from tagweave.functions.tree import register_sql_functions

    register_sql_functions(spark)
    df.createOrReplaceTempView("tw_tags")
    got = spark.sql("SELECT tagweave_tree_error('HZ') AS e, tagweave_decode_tree_pp('HPp3ms')[0]['Person'] AS person").first()
    assert (got.e, got.person) == ("unknown part of speech Z", "third")
