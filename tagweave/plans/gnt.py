"""Tagged-line corpus (Greek, one word per line) end to end:
text files -> fields -> run-reset ordinal per file -> recoded verse ->
concatenated id -> positional decode -> book name from the file name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tables
from ..functions.ids import concat_id, recode_ref
from ..functions.positional import decode_positional
from ..operators.decode import book_dimension
from ..operators.entities import project_fields
from ..operators.sequence import run_ordinal, run_ordinal_in_order
from ..sources.files import DEFAULT_TAGGED_PATH, read_tagged_lines, route_lines, split_quarantine, with_key_from_name

WORD_COLUMNS = ["verse", "id", "codes", "morphology", "text", "word", "normalized", "lemma"]
# Field order of a tagged line.
FIELD_NAMES = ["ref", "part", "codes", "text", "word", "normalized", "lemma"]


def read_gnt_words(
    spark: SparkSession,
    path: str = DEFAULT_TAGGED_PATH,
    strict32: bool = False,
    on_error: str = "fail",
    name_col: str = "file_name",
    name_pattern: str = tables.GREEK_FILE_PATTERN,
) -> DataFrame:
    """Word rows ``(book, file, <word columns>)``.

    ``name_col`` / ``name_pattern``: where the book's file number is read
    (default: the corpus file-name convention).

    ``on_error='quarantine'`` leaves malformed lines out (see
    ``quarantined_lines``) instead of failing.  Note the run ordinal is
    then computed over the good lines only.

    The ordinal restarts whenever the reference field changes from the
    previous line of the same file, so a verse that reappears later
    restarts (and repeats its ids) — the corpus convention.  Runs are
    numbered per file split and carried across splits, so one huge file is
    not one task.  ``strict32`` fails on ids above 2^31-1.
    """
    lines = read_tagged_lines(spark, path, on_error=on_error)
    if on_error == "quarantine":
        lines, _ = split_quarantine(lines)
    return words_from_lines(lines, strict32=strict32, name_col=name_col, name_pattern=name_pattern, in_order=True)


def read_routed_gnt_words(spark: SparkSession, path: str, out: str, strict32: bool = False, **names: str) -> tuple[DataFrame, DataFrame]:
    """``(words, malformed lines)`` of one read of ``path``: its lines are
    written once under ``out``, good and malformed ones to folders of their own,
    and both results come from there."""
    good, bad = route_lines(read_tagged_lines(spark, path, on_error="quarantine"), out)
    return words_from_lines(good, strict32=strict32, **names), bad


def quarantined_lines(spark: SparkSession, path: str = DEFAULT_TAGGED_PATH) -> DataFrame:
    """The lines ``read_gnt_words(on_error='quarantine')`` leaves out."""
    return split_quarantine(read_tagged_lines(spark, path, on_error="quarantine"))[1]


def words_from_lines(
    lines: DataFrame,
    strict32: bool = False,
    name_col: str = "file_name",
    name_pattern: str = tables.GREEK_FILE_PATTERN,
    in_order: bool = False,
) -> DataFrame:
    """Word rows from tagged lines ``(file, file_name, block, seq, fields)``
    — the part of ``read_gnt_words`` after the read, usable on a streaming
    micro-batch (a file never spans micro-batches).  ``in_order``: the lines
    come straight from their scan, so they need no sort."""
    spark = lines.sparkSession
    df = project_fields(lines, "fields", FIELD_NAMES, keep=["file", "file_name", "block", "seq"])
    if in_order:
        df = run_ordinal_in_order(df, by=["file"], chunk="block", value="ref", out="ord")
    else:
        df = run_ordinal(df, by=["file"], order=["block", "seq"], value="ref", out="ord", chunk=F.col("block"))
    df = df.withColumn("verse", recode_ref("ref", tables.GREEK_VERSE_OFFSET)).withColumn(
        "id", concat_id("verse", "ord", strict32=strict32)
    ).withColumn("morphology", decode_positional("codes", part="part"))
    dim = book_dimension(spark, "greek")
    df = with_key_from_name(df, name_col, name_pattern, dim, "file_number", "name",
                            out_key="book_number", out_name="book", on_no_match="fail")
    return df.select("book", "file", "block", "seq", "ord", *WORD_COLUMNS)
