"""Independent DuckDB SQL for every query in ``catalog.QUERIES``.

Nothing here calls the operators: tag decodes come from golden literals
(written out by hand in ``k=v,...|...`` form), everything else is plain SQL
over the driver's views.
"""

from __future__ import annotations

import json

# Golden tree decodes: tag -> (language, segments as "k=v,k=v|k=v").
GOLDEN_TREE = {
    "HNcmsc": ("Hebrew", "Part=noun,Type=common,Gender=masculine,Number=singular,State=construct"),
    "HNp": ("Hebrew", "Part=noun,Type=proper name"),
    "HD": ("Hebrew", "Part=adverb"),
    "HVqp3ms": ("Hebrew", "Part=verb,Stem=qal,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    "HVqrmsa": ("Hebrew", "Part=verb,Stem=qal,Conjugation=participle active,Gender=masculine,Number=singular,State=absolute"),
    "HVqc": ("Hebrew", "Part=verb,Stem=qal,Conjugation=infinitive construct"),
    "HC/Vqw3ms": ("Hebrew", "Part=conjunction|Part=verb,Stem=qal,Conjugation=sequential imperfect (wayyiqtol),Person=third,Gender=masculine,Number=singular"),
    "HRd/Ncmsa": ("Hebrew", "Part=preposition,preposition=definite article|Part=noun,Type=common,Gender=masculine,Number=singular,State=absolute"),
    "HTd/Ncmsa": ("Hebrew", "Part=particle,Type=definite article|Part=noun,Type=common,Gender=masculine,Number=singular,State=absolute"),
    "HNcmpc/Sp1cs": ("Hebrew", "Part=noun,Type=common,Gender=masculine,Number=plural,State=construct|Part=suffix,Type=pronominal,Person=first,Gender=common (verb),Number=singular"),
    "HAcfda": ("Hebrew", "Part=adjective,Type=cardinal number,Gender=feminine,Number=dual,State=absolute"),
    "HPp3ms": ("Hebrew", "Part=pronoun,Type=personal,Gender=masculine,Number=singular"),
    "HPdxms": ("Hebrew", "Part=pronoun,Type=demonstrative,Gender=masculine,Number=singular"),
    "HPxms": ("Hebrew", "Part=pronoun,Type=,Person=,Gender="),
    "AVqp3ms": ("Aramaic", "Part=Verb,Stem=peal,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    "AVtp3ms": ("Aramaic", "Part=Verb,Stem=hishtaphel,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    "HVtp3ms": ("Hebrew", "Part=verb,Stem=hithpael,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    "HVap3ms": ("Hebrew", "Part=verb,Stem=,Conjugation=perfect (qatal),Person=third,Gender=masculine,Number=singular"),
    "HCx": ("Hebrew", "Part=conjunction,conjunction="),
    "XNcmsa": ("", "Part=noun,Type=common,Gender=masculine,Number=singular,State=absolute"),
}
TAG_ORDER = list(GOLDEN_TREE)  # the order orders are spread over (key % 20)

ATTRS = ["Part", "Type", "Stem", "Conjugation", "Person", "Gender", "Number", "State", "preposition", "conjunction", "adverb"]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _tag_list() -> str:
    return "[" + ", ".join(_q(t) for t in TAG_ORDER) + "]"


def _order_tags() -> str:
    return f"SELECT o_orderkey, {_tag_list()}[CAST(o_orderkey % {len(TAG_ORDER)} AS BIGINT) + 1] AS tag FROM orders"


def _tree_rows() -> str:
    rows = []
    for tag, (_, segs) in GOLDEN_TREE.items():
        for si, seg in enumerate(segs.split("|"), 1):
            for ai, kv in enumerate(seg.split(","), 1):
                k, _, v = kv.partition("=")
                rows.append(f"({_q(tag)}, {si}, {ai}, {_q(k)}, {_q(v)})")
    return "VALUES " + ", ".join(rows)


def _wide_rows() -> str:
    rows = []
    for tag, (_, segs) in GOLDEN_TREE.items():
        for si, seg in enumerate(segs.split("|"), 1):
            m = dict(kv.partition("=")[::2] for kv in seg.split(","))
            vals = ", ".join(_q(m[a]) if a in m else "CAST(NULL AS VARCHAR)" for a in ATTRS)
            rows.append(f"({_q(tag)}, {si}, {vals})")
    return "VALUES " + ", ".join(rows)


_WIDE_COLS = ", ".join(a.lower() for a in ATTRS)

_DOC_WORDS = """
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS chapter FROM documents),
v AS (SELECT doc_id, chapter, unnest(string_split(line, '. ')) AS sent,
             generate_subscripts(string_split(line, '. '), 1) AS verse FROM l),
w AS (SELECT doc_id, chapter, verse, unnest(string_split(sent, ' ')) AS token,
             generate_subscripts(string_split(sent, ' '), 1) AS word FROM v),
wo AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chapter, verse, word) AS ordinal FROM w)
"""

# Positional lookups written out for the oracle (code, label per position).
_POSITIONAL = {
    "person": {"1": "first", "2": "second", "3": "third"},
    "tense": {"P": "present", "I": "imperfect", "F": "future", "A": "aorist", "X": "perfect", "Y": "pluperfect"},
    "voice": {"A": "active", "M": "middle", "P": "passive"},
    "mood": {"I": "indicative", "D": "imperative", "S": "subjunctive", "O": "optative", "N": "infinitive", "P": "participle"},
    "case": {"N": "nominative", "G": "genitive", "D": "dative", "A": "accusative"},
    "number": {"S": "singular", "P": "plural"},
    "gender": {"M": "masculine", "F": "feminine", "N": "neuter"},
    "degree": {"C": "comparative", "S": "superlative"},
}


def _case_at(code: str, pos: int, name: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in _POSITIONAL[name].items())
    return f"CASE substr({code}, {pos}, 1) {whens} END"


def _positional_cols(code: str) -> str:
    return ", ".join(f'{_case_at(code, i + 1, n)} AS "{n}"' for i, n in enumerate(_POSITIONAL))


# Letters by position of a line item's code, as the queries make them.
_LETTERS = ["123-", "PIFAXY-", "AMP-", "IDSONP-", "NGDA-", "SP-", "MFN-", "CS-"]
_LI_CODE = " || ".join(
    f"substr('{x}', CAST((l_orderkey + {i} * l_linenumber) % {len(x)} AS BIGINT) + 1, 1)" for i, x in enumerate(_LETTERS, 1)
)

# Verb tags and their decoded text, written out for the oracle.
_HEBREW_STEMS = {
    "q": "qal", "N": "niphal", "p": "piel", "P": "pual", "h": "hiphil", "H": "hophal", "t": "hithpael", "o": "polel", "O": "polal",
    "r": "hithpolel", "m": "poel", "M": "poal", "k": "palel", "K": "pulal", "Q": "qal passive", "l": "pilpel", "L": "polpal",
    "f": "hithpalpel", "D": "nithpael", "j": "pealal", "i": "pilel", "u": "hothpaal", "c": "tiphil", "v": "hishtaphel",
    "w": "nithpalel", "y": "nithpoel", "z": "hithpoel",
}
_ARAMAIC_STEMS = {
    "q": "peal", "Q": "peil", "u": "hithpeel", "p": "pael", "P": "ithpaal", "M": "hithpaal", "a": "aphel", "h": "haphel",
    "s": "saphel", "e": "shaphel", "H": "hophal", "i": "ithpeel", "t": "hishtaphel", "v": "ishtaphel", "w": "hithaphel", "o": "polel",
    "z": "ithpoel", "r": "hithpolel", "f": "hithpalpel", "b": "hephal", "c": "tiphel", "m": "poel", "l": "palpel", "L": "ithpalpel",
    "O": "ithpolel", "G": "ittaphal",
}
_CONJUGATIONS = {
    "p": "perfect (qatal)", "q": "sequential perfect (weqatal)", "i": "imperfect (yiqtol)", "w": "sequential imperfect (wayyiqtol)",
    "h": "cohortative", "j": "jussive", "v": "imperative", "r": "participle active", "s": "participle passive",
    "a": "infinitive absolute", "c": "infinitive construct",
}


def _verb_rows() -> list[tuple[str, str, str]]:
    finite = ("3ms", ",Person=third,Gender=masculine,Number=singular")
    rest = {"r": ("msa", ",Gender=masculine,Number=singular,State=absolute"), "s": ("fpc", ",Gender=feminine,Number=plural,State=construct"),
            "a": ("", ""), "c": ("", "")}
    rows = []
    for letter, language, part, stems in (("H", "Hebrew", "verb", _HEBREW_STEMS), ("A", "Aramaic", "Verb", _ARAMAIC_STEMS)):
        for s, stem in stems.items():
            for c, conj in _CONJUGATIONS.items():
                tail, text = rest.get(c, finite)
                rows.append((f"{letter}V{s}{c}{tail}", language, f"Part={part},Stem={stem},Conjugation={conj}{text}"))
    return rows


_GREEK_BOOKS = [
    "Matthew", "Mark", "Luke", "John", "Acts", "Romans", "1 Corinthians", "2 Corinthians", "Galatians",
    "Ephesians", "Philippians", "Colossians", "1 Thessalonians", "2 Thessalonians", "1 Timothy", "2 Timothy",
    "Titus", "Philemon", "Hebrews", "James", "1 Peter", "2 Peter", "1 John", "2 John", "3 John", "Jude", "Revelation",
]


_HEBREW_NAMES = [
    "Genesis", "Exodus", "Leviticus", "Numbers", "Deuteronomy", "Joshua", "Judges", "Ruth", "I Samuel", "II Samuel", "I Kings",
    "II Kings", "I Chronicles", "II Chronicles", "Ezra", "Nehemiah", "Esther", "Job", "Psalms", "Proverbs", "Ecclesiastes",
    "Song of Solomon", "Isaiah", "Jeremiah", "Lamentations", "Ezekiel", "Daniel", "Hosea", "Joel", "Amos", "Obadiah", "Jonah",
    "Micah", "Nahum", "Habakkuk", "Zephaniah", "Haggai", "Zechariah", "Malachi",
]
_HEBREW_STEM_NAMES = [n.lower().replace(" ", "") for n in _HEBREW_NAMES]


def _greek_dim() -> str:
    return "VALUES " + ", ".join(f"({61 + i}, {_q(n)})" for i, n in enumerate(_GREEK_BOOKS))


def _lookup_values() -> str:
    return "VALUES " + ", ".join(f"({_q(n)}, {_q(k)}, {_q(v)})" for n, m in _POSITIONAL.items() for k, v in m.items())


def oracle_sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["gen_nested"] = f"""WITH {_DOC_WORDS}
SELECT doc_id, CAST(chapter AS BIGINT) AS chapter, CAST(verse AS BIGINT) AS verse, CAST(word AS BIGINT) AS word,
       CAST(ordinal AS BIGINT) AS ordinal, token FROM wo"""
    s["gen_levels"] = s["gen_nested"]
    s["src_chapters"] = """WITH d AS (SELECT doc_id, text, doc_id % 8 AS book, row_number() OVER (PARTITION BY doc_id % 8 ORDER BY doc_id) + 1 AS chapter FROM documents),
l AS (SELECT book, doc_id, chapter, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS verse FROM d),
w AS (SELECT book, doc_id, chapter, verse, unnest(string_split(line, ' ')) AS token,
             generate_subscripts(string_split(line, ' '), 1) AS word FROM l)
SELECT book, doc_id, chapter, CAST(verse AS BIGINT) AS verse, CAST(word AS BIGINT) AS word,
       row_number() OVER (PARTITION BY book ORDER BY chapter, verse, word) AS ordinal, token, '] "[\\\\" [' AS mark FROM w"""
    s["ord_global"] = f"""WITH {_DOC_WORDS}
SELECT doc_id, CAST(chapter AS BIGINT) AS chapter, CAST(verse AS BIGINT) AS verse, CAST(word AS BIGINT) AS word,
       CAST(ordinal AS BIGINT) AS ordinal FROM wo"""
    s["id_padded"] = """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS chapter FROM documents),
v AS (SELECT doc_id, chapter, generate_subscripts(string_split(line, '. '), 1) AS verse FROM l)
SELECT doc_id, CAST(chapter AS BIGINT) AS chapter, CAST(verse AS BIGINT) AS verse,
       printf('%02d%03d%03d', doc_id, chapter, verse) AS verse_id FROM v"""
    s["id_sequence"] = f"""WITH {_DOC_WORDS}
SELECT doc_id, CAST(ordinal AS BIGINT) AS ordinal, printf('%02d%03d%03d', doc_id, chapter, verse) AS verse_id,
       CAST(printf('%02d%03d%03d%03d', doc_id, chapter, verse, ordinal) AS BIGINT) AS id FROM wo"""
    s["src_lines"] = """WITH l AS (SELECT regexp_replace(unnest(string_split(text, chr(10))), '\\r$', '') AS line FROM documents)
SELECT line, CAST(len(string_split(line, ' ')) AS BIGINT) AS n_fields FROM l"""
    s["src_nested"] = """WITH l AS (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS chapter FROM conversations),
v AS (SELECT conv_id, turn, role, chapter, unnest(string_split(line, '. ')) AS sent,
             generate_subscripts(string_split(line, '. '), 1) AS verse FROM l),
w AS (SELECT conv_id, turn, role, chapter, verse, unnest(string_split(sent, ' ')) AS token,
             generate_subscripts(string_split(sent, ' '), 1) AS word FROM v)
SELECT conv_id, turn, CAST(chapter AS BIGINT) AS chapter, CAST(verse AS BIGINT) AS verse, CAST(word AS BIGINT) AS word,
       CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY chapter, verse, word) AS BIGINT) AS ordinal,
       token AS surface, role AS lexkey, CAST(turn AS VARCHAR) AS tag FROM w"""
    stems = "[" + ", ".join(_q(n) for n in _HEBREW_STEM_NAMES) + "]"

    def words(first: str, second: str) -> str:
        return f"""l AS (SELECT doc_id, unnest(string_split(text, {first})) AS line,
             generate_subscripts(string_split(text, {first}), 1) AS chapter FROM documents),
v AS (SELECT doc_id, chapter, unnest(string_split(line, {second})) AS sent,
             generate_subscripts(string_split(line, {second}), 1) AS verse FROM l),
w AS (SELECT doc_id, chapter, verse, unnest(string_split(sent, ' ')) AS token,
             generate_subscripts(string_split(sent, ' '), 1) AS word FROM v)"""

    one = f"""doc_id, {stems}[CAST(doc_id % 39 AS BIGINT) + 1] AS book_key, CAST(chapter AS BIGINT) AS chapter,
       CAST(verse AS BIGINT) AS verse, CAST(word AS BIGINT) AS word, token FROM w"""
    s["src_variant"] = f"""SELECT * FROM (WITH {words("chr(10)", "'. '")} SELECT 'hebrew' AS variant, {one})
UNION ALL SELECT * FROM (WITH {words("'. '", "chr(10)")} SELECT 'remapped' AS variant, {one})"""
    tag_rows = "VALUES " + ", ".join(f"({_q(t)}, {_q(lang)}, {_q(m)})" for t, (lang, m) in GOLDEN_TREE.items())
    names = "[" + ", ".join(_q(n) for n in _HEBREW_NAMES) + "]"
    s["wlc_words"] = f"""WITH {_DOC_WORDS}, g(tag, language, text) AS ({tag_rows}),
x AS (SELECT *, {_tag_list()}[CAST((doc_id + length(token)) % {len(TAG_ORDER)} AS BIGINT) + 1] AS codes, doc_id % 39 + 1 AS book_no FROM wo)
SELECT {names}[CAST(book_no AS BIGINT)] AS book, doc_id, CAST(chapter AS BIGINT) AS chapter, CAST(verse AS BIGINT) AS verse_no,
       CAST(word AS BIGINT) AS word_no, CAST(ordinal AS BIGINT) AS ordinal, codes, g.language, token AS lemma,
       CAST(printf('%02d%03d%03d%03d', book_no, chapter, verse, ordinal) AS BIGINT) AS id, printf('%02d%03d%03d', book_no, chapter, verse) AS verse,
       g.text AS tag_text FROM x JOIN g ON x.codes = g.tag"""
    verbs = _verb_rows()
    verb_list = "[" + ", ".join(_q(t) for t, _, _ in verbs) + "]"
    s["dec_tree_verbs"] = f"""WITH g(tag, language, tag_text) AS (VALUES {", ".join(f"({_q(t)}, {_q(lang)}, {_q(m)})" for t, lang, m in verbs)}),
t AS (SELECT o_orderkey, {verb_list}[CAST((o_orderkey * 31 + o_orderkey // 8) % {len(verbs)} AS BIGINT) + 1] AS tag FROM orders)
SELECT o_orderkey, tag, language, tag_text FROM t JOIN g USING (tag)"""
    s["src_manifest"] = """SELECT c_custkey, c_name, lower(replace(c_name, '#', '-')) AS file_stem FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')"""
    s["src_key_from_name"] = f"""WITH k AS (SELECT page_id, CAST(NULLIF(regexp_extract(url, '/[a-z]{{2}}/([0-9]+)', 1), '') AS BIGINT) AS book_number FROM pages),
d(file_number, name) AS ({_greek_dim()})
SELECT page_id, book_number, coalesce(d.name, '') AS book_name FROM k LEFT JOIN d ON k.book_number = d.file_number"""
    s["src_manifest_books"] = f"""WITH d(file_number, name) AS ({_greek_dim()}),
k AS (SELECT CAST(NULLIF(regexp_extract(url, '/[a-z]{{2}}/([0-9]+)', 1), '') AS BIGINT) AS n FROM pages)
SELECT CAST(file_number AS BIGINT) AS file_number, name FROM d WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.n = d.file_number)"""
    s["proj_fields"] = """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, """ + ", ".join(
        f"string_split(line, ' ')[{i + 1}] AS f{i}" for i in range(7)
    ) + " FROM l"
    s["proj_recode"] = """WITH r AS (SELECT o_orderkey, printf('%06d', o_orderkey) AS ref FROM orders)
SELECT o_orderkey, ref, CAST(CAST(substr(ref, 1, 2) AS INTEGER) + 39 AS VARCHAR) || substr(ref, 3, 2) || substr(ref, 5, 2) AS verse FROM r"""
    s["proj_category"] = """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status_label,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'urgent' WHEN '2' THEN 'high' WHEN '3' THEN 'medium'
       WHEN '4' THEN 'not specified' WHEN '5' THEN 'low' END AS priority_label FROM orders"""
    s["proj_language"] = """SELECT doc_id, CASE substr(text, 1, 1) WHEN 'H' THEN 'Hebrew' WHEN 'A' THEN 'Aramaic' ELSE '' END AS language FROM documents"""
    s["gen_segments"] = f"""WITH t AS ({_order_tags()})
SELECT o_orderkey, tag, CAST(generate_subscripts(string_split(substr(tag, 2), '/'), 1) AS BIGINT) AS seg_no,
       unnest(string_split(substr(tag, 2), '/')) AS segment FROM t"""
    s["dec_tree"] = f"""WITH t AS ({_order_tags()}), g(tag, seg_no, attr_no, attr, value) AS ({_tree_rows()})
SELECT o_orderkey, CAST(seg_no AS BIGINT) AS seg_no, CAST(attr_no AS BIGINT) AS attr_no, attr, value FROM t JOIN g USING (tag)"""
    wide = f"""WITH t AS ({_order_tags()}), g(tag, seg_no, {_WIDE_COLS}) AS ({_wide_rows()})
SELECT o_orderkey, CAST(seg_no AS BIGINT) AS seg_no, {_WIDE_COLS} FROM t JOIN g USING (tag)"""
    s["dec_tree_attr"] = wide
    s["dec_dictionary"] = wide
    ser_rows = "VALUES " + ", ".join(f"({_q(t)}, {_q(lang)}, {_q(m)})" for t, (lang, m) in GOLDEN_TREE.items())
    s["ser_string"] = f"""WITH t AS ({_order_tags()}), g(tag, language, morphology) AS ({ser_rows})
SELECT o_orderkey, language, morphology FROM t JOIN g USING (tag)"""
    s["dec_positional"] = f"""WITH c AS (SELECT l_orderkey, l_linenumber, {_LI_CODE} AS code FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, code, {_positional_cols('code')} FROM c"""
    s["dim_lookup"] = f"""WITH c AS (SELECT {_LI_CODE} AS code FROM lineitem),
names(i, lookup) AS (VALUES (1, 'person'), (2, 'tense'), (3, 'voice'), (4, 'mood'), (5, 'case'), (6, 'number'), (7, 'gender'), (8, 'degree')),
u AS (SELECT n.lookup, substr(c.code, n.i, 1) AS code, count(*) AS uses FROM c, names n WHERE n.i <= length(c.code) GROUP BY ALL),
d(lookup, code, label) AS ({_lookup_values()})
SELECT 'positional' AS scheme, d.lookup, d.code, d.label, CAST(coalesce(u.uses, 0) AS BIGINT) AS uses
FROM d LEFT JOIN u ON d.lookup = u.lookup AND d.code = u.code"""
    s["id_concat"] = """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) AS BIGINT) AS id FROM lineitem"""
    s["ord_run"] = """WITH a AS (SELECT event_id, user_id, event_type, ts,
         CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND lag(event_id) OVER w IS NOT NULL THEN 0 ELSE 1 END AS chg
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM a)
SELECT event_id, user_id, event_type, CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS BIGINT) AS ord FROM b"""
    s["ser_json"] = """SELECT o_orderkey, CAST(to_json({'id': o_orderkey, 'custkey': o_custkey, 'status': o_orderstatus, 'priority': o_orderpriority}) AS VARCHAR) AS content FROM orders"""
    s["ser_json_sorted"] = """SELECT o_orderkey, CAST(to_json({'Priority': o_orderpriority, 'custkey': o_custkey, 'id': o_orderkey, 'status': o_orderstatus}) AS VARCHAR) AS content FROM orders"""
    sorted_rows, item_rows = [], []
    for tag, (lang, segs) in GOLDEN_TREE.items():
        maps = [dict(kv.partition("=")[::2] for kv in seg.split(",")) for seg in segs.split("|")]
        content = {"Language": lang, "attributes": maps, "tag": tag}
        sorted_rows.append(f"({_q(tag)}, {_q(json.dumps(content, sort_keys=True, separators=(',', ':')))})")
        parts = json.dumps([{"M": {"Part": {"S": m["Part"]}, "n": {"N": str(len(m))}}} for m in maps], separators=(",", ":"))
        item_rows.append(f"({_q(tag)}, {_q(lang) if lang else 'CAST(NULL AS VARCHAR)'}, {_q(parts)})")
    s["ser_json_sorted_nested"] = f"""WITH t AS ({_order_tags()}), g(tag, content) AS (VALUES {", ".join(sorted_rows)})
SELECT o_orderkey, content FROM t JOIN g USING (tag)"""
    s["ent_item_nested"] = f"""WITH t AS ({_order_tags()}), g(tag, language, parts) AS (VALUES {", ".join(item_rows)}),
r AS (SELECT tag AS hash_key, CAST(o_orderkey AS VARCHAR) AS range_key, o_orderkey, language, parts FROM t JOIN g USING (tag))
SELECT hash_key, range_key, 'o_orderkey' AS attr, 'N' AS type, range_key AS value FROM r
UNION ALL SELECT hash_key, range_key, 'tag', 'S', hash_key FROM r
UNION ALL SELECT hash_key, range_key, 'even', 'BOOL', CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END FROM r
UNION ALL SELECT hash_key, range_key, 'language', CASE WHEN language IS NULL THEN 'NULL' ELSE 'S' END, language FROM r
UNION ALL SELECT hash_key, range_key, 'parts', 'L', parts FROM r"""
    person = _case_at("code", 1, "person")
    tense = _case_at("code", 2, "tense")
    s["ser_omit_empty"] = f"""WITH c AS (SELECT o_orderkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'O' THEN substr(o_orderpriority, 3) ELSE '' END AS comment,
         substr(o_orderpriority, 1, 1) || o_orderstatus AS code FROM orders),
m AS (SELECT *, {person} AS person, {tense} AS tense FROM c)
SELECT o_orderkey, '{{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '"'
  || CASE WHEN comment <> '' THEN ',"comment":"' || comment || '"' ELSE '' END
  || ',"morphology":{{' || concat_ws(',', CASE WHEN person IS NOT NULL THEN '"person":"' || person || '"' END,
                                      CASE WHEN tense IS NOT NULL THEN '"tense":"' || tense || '"' END) || '}}}}' AS content FROM m"""
    s["json_columns"] = """SELECT event_id, substr(json_extract_string(props, '$.k'), 1, 200) AS k,
       CAST(NULL AS VARCHAR) AS missing, CAST(NULL AS VARCHAR) AS object, CAST(NULL AS VARCHAR) AS list, 'true' AS flag,
       CAST(event_id AS VARCHAR) AS id_text FROM events"""
    s["json_valid"] = """WITH d AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN props || '}'
                                  WHEN event_id % 7 = 1 THEN substr(props, 2) ELSE props END AS doc FROM events)
SELECT event_id, doc, CAST(json_valid(doc) AS INTEGER) AS valid FROM d"""
    s["ent_wide"] = """SELECT CAST(o_custkey AS VARCHAR) AS partition_key, CAST(o_orderkey AS VARCHAR) AS row_key, 'Status' AS prop, o_orderstatus AS value FROM orders
UNION ALL SELECT CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), 'Priority', o_orderpriority FROM orders
UNION ALL SELECT CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), 'Customer', CAST(o_custkey AS VARCHAR) FROM orders"""
    s["ent_flatten"] = f"""WITH c AS (SELECT l_orderkey, l_linenumber, {_LI_CODE} AS code FROM lineitem)
SELECT CAST(l_orderkey AS VARCHAR) AS partition_key,
       CAST(CAST(CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) AS BIGINT) AS VARCHAR) AS row_key,
       code AS codes, """ + ", ".join(
        f'coalesce({_case_at("code", i + 1, n)}, \'\') AS "{n}"' for i, n in enumerate(_POSITIONAL)
    ) + " FROM c"
    s["ent_flat"] = """SELECT CAST(c_custkey AS VARCHAR) AS key, c_custkey AS id, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer"""
    s["ent_keyed"] = """SELECT CAST(c_custkey AS VARCHAR) AS key, c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer"""
    s["ent_item"] = """SELECT c_mktsegment AS hash_key, CAST(c_custkey AS VARCHAR) AS range_key, 'c_custkey' AS attr, 'N' AS type, CAST(c_custkey AS VARCHAR) AS value FROM customer
UNION ALL SELECT c_mktsegment, CAST(c_custkey AS VARCHAR), 'c_name', 'S', c_name FROM customer
UNION ALL SELECT c_mktsegment, CAST(c_custkey AS VARCHAR), 'c_nationkey', 'N', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT c_mktsegment, CAST(c_custkey AS VARCHAR), 'c_mktsegment', 'S', c_mktsegment FROM customer"""
    s["ent_json_row"] = """SELECT o_orderkey AS id, CAST(to_json({'id': o_orderkey, 'status': o_orderstatus, 'priority': o_orderpriority}) AS VARCHAR) AS content FROM orders"""
    s["batch_ranges"] = """SELECT o_orderkey, o_orderstatus,
       CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS BIGINT) AS seq,
       CAST(floor((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) / 100) AS BIGINT) AS batch_no FROM orders"""
    s["batch_progress"] = """WITH n AS (SELECT o_orderstatus, count(*) AS total FROM orders GROUP BY 1),
b AS (SELECT o_orderstatus, total, unnest(range(0, CAST(ceil(total / 100.0) AS BIGINT))) AS batch_no FROM n)
SELECT o_orderstatus, CAST(batch_no AS BIGINT) AS batch_no, CAST(batch_no * 100 AS BIGINT) AS lo,
       CAST(least((batch_no + 1) * 100, total) AS BIGINT) AS hi,
       round(least(100.0, ((batch_no + 1) * 100.0 / total) * 100.0), 2) AS pct FROM b"""
    s["upsert_latest"] = """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
    s["sink_jsonl"] = """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"""
    s["sink_profile"] = """WITH b AS (SELECT lang, strlen(CAST(to_json({'doc_id': doc_id, 'text': text, 'lang': lang, 'source': source, 'n_chars': n_chars}) AS VARCHAR)) AS n FROM documents)
SELECT lang, count(*) AS records, CAST(min(n) AS BIGINT) AS min_bytes, CAST(max(n) AS BIGINT) AS max_bytes,
       round(avg(n), 4) AS avg_bytes, CAST(sum(n) AS BIGINT) AS total_bytes FROM b GROUP BY lang"""
    s["exact_batches"] = """WITH r AS (SELECT o_orderkey, o_orderstatus,
         (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 200 AS batch_no FROM orders)
SELECT o_orderstatus, batch_no, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, CAST(count(*) AS BIGINT) AS n
FROM r GROUP BY o_orderstatus, batch_no"""
    parts = {"N-": "noun", "V-": "verb", "A-": "adjective", "RA": "definite article", "C-": "conjunction",
             "P-": "preposition", "D-": "adverb"}
    part_case = "CASE part " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in parts.items()) + " END"
    s["gnt_words"] = f"""WITH l AS (
  SELECT l_orderkey, l_linenumber, l_suppkey % 27 + 61 AS book, l_orderkey // 65536 AS chunk,
         printf('%02d%02d%02d', l_suppkey % 27 + 1, (l_orderkey // 100) % 100, l_orderkey % 100) AS ref,
         ['N-', 'V-', 'A-', 'RA', 'C-', 'P-', 'D-'][l_linenumber] AS part,
         {_LI_CODE} AS codes,
         l_returnflag || CAST(l_orderkey AS VARCHAR) AS text,
         l_linestatus || CAST(l_linenumber AS VARCHAR) AS word,
         lower(l_returnflag || CAST(l_orderkey AS VARCHAR)) AS normalized,
         CAST(l_partkey AS VARCHAR) AS lemma
  FROM lineitem),
lt AS (SELECT *, concat_ws(' ', ref, part, codes, text, word, normalized, lemma) AS line FROM l),
r AS (SELECT *, CASE WHEN lag(ref) OVER w = ref THEN 0 ELSE 1 END AS chg
      FROM lt WINDOW w AS (PARTITION BY book, chunk ORDER BY l_orderkey, l_linenumber, line)),
s AS (SELECT *, sum(chg) OVER (PARTITION BY book, chunk ORDER BY l_orderkey, l_linenumber, line
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY book, chunk, run ORDER BY l_orderkey, l_linenumber, line) AS ord,
             CAST(CAST(substr(ref, 1, 2) AS INTEGER) + 39 AS VARCHAR) || substr(ref, 3, 2) || substr(ref, 5, 2) AS verse FROM s),
d(file_number, name) AS ({_greek_dim()})
SELECT d.name AS book, verse, CAST(verse || CAST(ord AS VARCHAR) AS BIGINT) AS id, codes, text, word, normalized, lemma,
       {part_case} AS part, {_positional_cols('codes')}
FROM o JOIN d ON o.book = d.file_number"""
    s["stream_tokens"] = s["gen_nested"]
    return s
