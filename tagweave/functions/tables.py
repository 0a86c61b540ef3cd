"""Lookup tables, grammar paths and book dimensions — data only.

Everything in the FIXED VALUES block must equal the corpus conventions
for results to match; it is stated plainly, in the corpus' own order.
The grammar paths below are our own compact description of which attribute
each tag letter fills; the decoders in ``tree.py`` turn them into Column
expressions.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — tree-shaped (Hebrew/Aramaic) tag scheme
# ---------------------------------------------------------------------------

HEBREW_STEM = {
    "q": "qal", "N": "niphal", "p": "piel", "P": "pual", "h": "hiphil",
    "H": "hophal", "t": "hithpael", "o": "polel", "O": "polal",
    "r": "hithpolel", "m": "poel", "M": "poal", "k": "palel", "K": "pulal",
    "Q": "qal passive", "l": "pilpel", "L": "polpal", "f": "hithpalpel",
    "D": "nithpael", "j": "pealal", "i": "pilel", "u": "hothpaal",
    "c": "tiphil", "v": "hishtaphel", "w": "nithpalel", "y": "nithpoel",
    "z": "hithpoel",
}

ARAMAIC_STEM = {
    "q": "peal", "Q": "peil", "u": "hithpeel", "p": "pael", "P": "ithpaal",
    "M": "hithpaal", "a": "aphel", "h": "haphel", "s": "saphel",
    "e": "shaphel", "H": "hophal", "i": "ithpeel", "t": "hishtaphel",
    "v": "ishtaphel", "w": "hithaphel", "o": "polel", "z": "ithpoel",
    "r": "hithpolel", "f": "hithpalpel", "b": "hephal", "c": "tiphel",
    "m": "poel", "l": "palpel", "L": "ithpalpel", "O": "ithpolel",
    "G": "ittaphal",
}

CONJUGATION = {
    "p": "perfect (qatal)", "q": "sequential perfect (weqatal)",
    "i": "imperfect (yiqtol)", "w": "sequential imperfect (wayyiqtol)",
    "h": "cohortative", "j": "jussive", "v": "imperative",
    "r": "participle active", "s": "participle passive",
    "a": "infinitive absolute", "c": "infinitive construct",
}

ADJECTIVE_TYPE = {"a": "adjective", "c": "cardinal number", "g": "gentilic", "o": "ordinal number"}
NOUN_TYPE = {"c": "common", "g": "gentilic", "p": "proper name"}
PRONOUN_TYPE = {"d": "demonstrative", "f": "indefinite", "i": "interrogative", "p": "personal", "r": "relative"}
PREPOSITION = {"d": "definite article"}
SUFFIX_TYPE = {"d": "directional he", "h": "paragogic he", "n": "paragogic nun", "p": "pronominal"}
PARTICLE_TYPE = {
    "a": "affirmation", "d": "definite article", "e": "exhortation",
    "i": "interrogative", "j": "interjection", "m": "demonstrative",
    "n": "negative", "o": "direct object marker", "r": "relative",
}
PERSON = {"1": "first", "2": "second", "3": "third"}
GENDER = {"b": "both (noun)", "c": "common (verb)", "f": "feminine", "m": "masculine"}
NUMBER = {"d": "dual", "p": "plural", "s": "singular"}
STATE = {"a": "absolute", "c": "construct", "d": "determined"}

# Language discriminator: first letter of the whole tag.
LANGUAGE = {"H": "Hebrew", "A": "Aramaic"}

# Part-of-speech label written under "Part" (verbs depend on the language:
# the Aramaic verb label is capitalised in the corpus convention).
PART_LABEL = {
    "C": "conjunction", "D": "adverb", "A": "adjective", "N": "noun",
    "P": "pronoun", "R": "preposition", "S": "suffix", "T": "particle",
}
VERB_LABEL = {"H": "verb", "A": "Verb"}

# Hebrew book order (1-based ordinal).
HEBREW_BOOKS = [
    "Genesis", "Exodus", "Leviticus", "Numbers", "Deuteronomy", "Joshua",
    "Judges", "Ruth", "I Samuel", "II Samuel", "I Kings", "II Kings",
    "I Chronicles", "II Chronicles", "Ezra", "Nehemiah", "Esther", "Job",
    "Psalms", "Proverbs", "Ecclesiastes", "Song of Solomon", "Isaiah",
    "Jeremiah", "Lamentations", "Ezekiel", "Daniel", "Hosea", "Joel", "Amos",
    "Obadiah", "Jonah", "Micah", "Nahum", "Habakkuk", "Zephaniah", "Haggai",
    "Zechariah", "Malachi",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — positional (Greek) tag scheme
# ---------------------------------------------------------------------------

GREEK_PART = {
    "A-": "adjective", "C-": "conjunction", "D-": "adverb",
    "I-": "interjection", "N-": "noun", "P-": "preposition",
    "RA": "definite article", "RD": "demonstrative pronoun",
    "RI": "interrogative/indefinite pronoun", "RP": "personal pronoun",
    "RR": "relative pronoun", "V-": "verb", "X-": "particle",
}

GREEK_PERSON = {"1": "first", "2": "second", "3": "third"}
GREEK_TENSE = {"P": "present", "I": "imperfect", "F": "future", "A": "aorist", "X": "perfect", "Y": "pluperfect"}
GREEK_VOICE = {"A": "active", "M": "middle", "P": "passive"}
GREEK_MOOD = {"I": "indicative", "D": "imperative", "S": "subjunctive", "O": "optative", "N": "infinitive", "P": "participle"}
GREEK_CASE = {"N": "nominative", "G": "genitive", "D": "dative", "A": "accusative"}
GREEK_NUMBER = {"S": "singular", "P": "plural"}
GREEK_GENDER = {"M": "masculine", "F": "feminine", "N": "neuter"}
GREEK_DEGREE = {"C": "comparative", "S": "superlative"}

# Greek book order (1-based ordinal); file numbers are ordinal + 60 and the
# reference code BB in a line becomes BB + 39 in the verse id.
GREEK_BOOKS = [
    "Matthew", "Mark", "Luke", "John", "Acts", "Romans", "1 Corinthians",
    "2 Corinthians", "Galatians", "Ephesians", "Philippians", "Colossians",
    "1 Thessalonians", "2 Thessalonians", "1 Timothy", "2 Timothy", "Titus",
    "Philemon", "Hebrews", "James", "1 Peter", "2 Peter", "1 John", "2 John",
    "3 John", "Jude", "Revelation",
]
GREEK_FILE_OFFSET = 60
GREEK_VERSE_OFFSET = 39
GREEK_FILE_PATTERN = r"([0-9]+)-([a-zA-Z0-9]+)-morphgnt"

# Default source folders and table names of the two corpora.
DEFAULT_TAGGED_PATH = "./morphgnt/"
DEFAULT_NESTED_PATH = "./morphhb/"
DEFAULT_TAGGED_TABLE = "morphgnt"
DEFAULT_NESTED_TABLE = "morphwlc"

# Sink batch sizes and retry start of the store profiles.
BATCH_SIZE = {"print": 100, "jsonl": 100, "dynamo": 25, "datastore": 200, "table": 1000, "sql": 1000}
RETRY_FIRST_SLEEP_SEC = 1.0

# ---------------------------------------------------------------------------
# Derived structures (our own layout of the values above)
# ---------------------------------------------------------------------------

# Named lookups used by the grammar paths.  ``None`` = no lookup: the
# attribute is present with value "".
TREE_LOOKUPS: dict[str, dict[str, str]] = {
    "hebrew_stem": HEBREW_STEM,
    "aramaic_stem": ARAMAIC_STEM,
    "conjugation": CONJUGATION,
    "adjective_type": ADJECTIVE_TYPE,
    "noun_type": NOUN_TYPE,
    "pronoun_type": PRONOUN_TYPE,
    "preposition": PREPOSITION,
    "suffix_type": SUFFIX_TYPE,
    "particle_type": PARTICLE_TYPE,
    "person": PERSON,
    "gender": GENDER,
    "number": NUMBER,
    "state": STATE,
}

SKIP = "-"  # a slot that consumes a letter and emits nothing

_GNS = [("Gender", "gender"), ("Number", "number"), ("State", "state")]
_PGN = [("Person", "person"), ("Gender", "gender"), ("Number", "number")]

# Attribute path per part-of-speech letter: (attribute, lookup) per letter.
# Variants chosen by a decider letter are listed separately.
TREE_PATHS: dict[str, list[tuple[str, str | None]]] = {
    "C": [("conjunction", None)],
    "D": [("adverb", None)],
    "A": [("Type", "adjective_type")] + _GNS,
    "N": [("Type", "noun_type")] + _GNS,
    # pronoun: the type letter decides; "x" takes person/gender/number
    "P_x": [("Type", "pronoun_type")] + _PGN,
    "P": [("Type", "pronoun_type"), (SKIP, None)] + _GNS,
    # evident intent (opt-in): the person slot is read unless it is "x"
    "P_person": [("Type", "pronoun_type"), ("Person", "person"), ("Gender", "gender"), ("Number", "number")],
    "P_person_x": [("Type", "pronoun_type"), (SKIP, None), ("Gender", "gender"), ("Number", "number")],
    "R": [("preposition", "preposition")],
    "S": [("Type", "suffix_type")] + _PGN,
    "T": [("Type", "particle_type")],
    # verb: the conjugation letter decides; participles have no person
    "VH": [("Stem", "hebrew_stem"), ("Conjugation", "conjugation"), ("Person", "person")] + _GNS,
    "VH_participle": [("Stem", "hebrew_stem"), ("Conjugation", "conjugation")] + _GNS,
    "VA": [("Stem", "aramaic_stem"), ("Conjugation", "conjugation"), ("Person", "person")] + _GNS,
    "VA_participle": [("Stem", "aramaic_stem"), ("Conjugation", "conjugation")] + _GNS,
}
PARTICIPLE_LETTERS = ("r", "s")
PRONOUN_DECIDER_LETTER = "x"

# Attribute columns produced by the wide (one column per attribute) decode.
TREE_ATTRIBUTES = [
    "Part", "Type", "Stem", "Conjugation", "Person", "Gender", "Number",
    "State", "preposition", "conjunction", "adverb",
]

GREEK_POSITIONS = [
    ("person", GREEK_PERSON), ("tense", GREEK_TENSE), ("voice", GREEK_VOICE),
    ("mood", GREEK_MOOD), ("case", GREEK_CASE), ("number", GREEK_NUMBER),
    ("gender", GREEK_GENDER), ("degree", GREEK_DEGREE),
]
GREEK_MORPHOLOGY_FIELDS = ["part"] + [name for name, _ in GREEK_POSITIONS]


def book_file_name(book: str) -> str:
    """File stem of a Hebrew book: lower case, spaces removed."""
    return book.replace(" ", "").lower()


def hebrew_book_rows() -> list[tuple[int, str, str]]:
    return [(i + 1, name, book_file_name(name)) for i, name in enumerate(HEBREW_BOOKS)]


def greek_book_rows() -> list[tuple[int, int, str]]:
    """(ordinal, file number, name)."""
    return [(i + 1, i + 1 + GREEK_FILE_OFFSET, name) for i, name in enumerate(GREEK_BOOKS)]


def lookup_rows() -> list[tuple[str, str, str, str]]:
    """(scheme, lookup, code, label) for every lookup entry, both schemes."""
    rows = [("tree", name, code, label) for name, table in TREE_LOOKUPS.items() for code, label in table.items()]
    rows += [("positional", name, code, label) for name, table in GREEK_POSITIONS for code, label in table.items()]
    rows += [("positional", "part", code, label) for code, label in GREEK_PART.items()]
    return rows
