"""Nested-book corpus (Hebrew/Aramaic word JSON) end to end:
variant folder -> whole-file JSON books -> manifest check -> words with
coordinates, ordinals and ids -> tree-tag decode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._util import fail_with
from ..functions.ids import padded_id, sequence_id
from ..functions.labels import language
from ..functions.serialize import tag_string
from ..functions.tree import decode_tree, tree_error
from ..operators.decode import book_dimension, decode_by_dictionary
from ..operators.explode import explode_chapters, explode_nested
from ..sources.chapters import read_nested_chapters
from ..sources.files import DEFAULT_NESTED_PATH, ManifestCheck, check_manifest, list_books, read_nested_books, variant_path

WORD_COLUMNS = ["codes", "language", "lemma", "coreid", "morphology", "id", "verse", "MorphologyString"]


def read_wlc_words(
    spark: SparkSession,
    root: str = DEFAULT_NESTED_PATH,
    variant: str | None = "hebrew",
    allow_missing: bool = False,
    dictionary: bool = True,
    pronoun_person: bool = False,
    partitions: int | None = None,
    on_error: str = "fail",
    layout: str = "files",
    glob: str = "*.json",
    check: ManifestCheck | None = None,
) -> DataFrame:
    """Word rows ``(book, book_no, chapter, verse_no, word_no, ordinal, <word columns>)``.

    * ``variant``: ``'english'`` reads the ``remapped`` numbering, anything
      else ``hebrew``.
    * ``allow_missing``: a manifest book without a file is an error unless set.
    * ``dictionary``: decode each distinct tag once and join back (same
      result as the row form, far less work on a real corpus).
    * ``layout``: ``'files'``, one book per file; ``'chapters'``, the same files
      cut at chapter ends, so that a large book is many tasks (see
      ``read_nested_chapters``); or ``'lines'``, one book per line of files of
      any size (see ``read_nested_books``).  ``glob``: which files.
    * ``check``: the manifest is checked by the job that reads the words instead
      of before it; call its ``verify`` after the action (``write_words`` does).
    * ``partitions``: the exploded words are spread over this many tasks, by
      default as adaptive execution sees fit — a book arrives as a single
      row, so what follows the explode must not stay in its task.
    * ``on_error='null'``: a tag that cannot be decoded keeps its row with a
      null morphology and the reason in ``decode_error`` (quarantine with
      ``where(decode_error is not null)``) instead of failing the job.
    """
    folder = variant_path(root, variant)
    dim = book_dimension(spark, "hebrew").withColumnRenamed("ordinal", "book_no")
    options = {"dictionary": dictionary, "pronoun_person": pronoun_person, "on_error": on_error}
    if layout == "chapters":
        files = read_nested_chapters(spark, folder, glob=glob)
    else:
        files = read_nested_books(spark, folder, glob=glob, layout=layout)
    if check is not None:
        files = check.watch(files, "book_key")
    else:
        present = files if layout == "lines" else list_books(spark, folder, glob)
        check_manifest(present.select(F.col("book_key").alias("file_stem")), dim, "file_stem", allow_missing=allow_missing)
    if layout == "chapters":
        return words_from_chapters(files, partitions=partitions, **options)
    # lines come in even splits of their files: the words stay where they are
    return words_from_books(files, partitions=partitions, even=layout == "lines", **options)


def manifest_check(spark: SparkSession) -> ManifestCheck:
    """A check of the books that ``read_wlc_words`` expects."""
    return ManifestCheck([r.file_stem for r in book_dimension(spark, "hebrew").orderBy("ordinal").collect()])


def unknown_books(spark: SparkSession, root: str = DEFAULT_NESTED_PATH, variant: str | None = "hebrew") -> DataFrame:
    """``(file, book_key)`` of files that ``read_wlc_words`` leaves out because
    their name is no known book."""
    dim = book_dimension(spark, "hebrew")
    listed = list_books(spark, variant_path(root, variant))
    return listed.join(dim, listed.book_key == dim.file_stem, "left_anti")


def words_from_books(
    files: DataFrame,
    dictionary: bool = True,
    pronoun_person: bool = False,
    partitions: int | None = None,
    on_error: str = "fail",
    even: bool = False,
) -> DataFrame:
    """Word rows from parsed book files ``(book_key, book)`` — the part of
    ``read_wlc_words`` after the read, usable on a streaming micro-batch.
    Files whose stem is not a known book are left out (``unknown_books``
    lists them).  ``even``: the books are spread over the tasks already, so the
    exploded words are not shuffled."""
    dim = book_dimension(files.sparkSession, "hebrew").withColumnRenamed("ordinal", "book_no")
    books = files.join(F.broadcast(dim), files.book_key == dim.file_stem).select(
        F.col("name").alias("book"), "book_no", F.col("book").alias("content")
    )
    words = explode_nested(
        books, "content", coords=("chapter", "verse_no"), position="word_no", ordinal="ordinal", value="word",
        keep=["book", "book_no"],
    )
    if partitions:
        words = words.repartition(partitions)
    elif not even:
        words = words.hint("rebalance")
    return _decoded(words, dictionary, pronoun_person, on_error)


def words_from_chapters(
    chapters: DataFrame,
    dictionary: bool = True,
    pronoun_person: bool = False,
    partitions: int | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Word rows from chapters ``(file, book_key, chapter, content)``: the
    chapters are dealt to all tasks already, ordinals run through a book by a
    prefix sum over its chapters' sizes."""
    dim = book_dimension(chapters.sparkSession, "hebrew").withColumnRenamed("ordinal", "book_no")
    books = chapters.join(F.broadcast(dim), chapters.book_key == dim.file_stem).select(
        "file", F.col("name").alias("book"), "book_no", F.col("chapter").cast("int").alias("chapter"), "content"
    )
    words = explode_chapters(books, by=["file"], coords=("verse_no",), position="word_no", ordinal="ordinal", value="word", keep=["book", "book_no"])
    words = words.withColumn("ordinal", F.col("ordinal").cast("int"))
    return _decoded(words.repartition(partitions) if partitions else words, dictionary, pronoun_person, on_error)


def _decoded(words: DataFrame, dictionary: bool, pronoun_person: bool, on_error: str) -> DataFrame:
    w = F.col("word")
    words = words.select(
        "book", "book_no", "chapter", "verse_no", "word_no", "ordinal",
        F.when(F.size(w) < 3, fail_with(F.concat(F.lit("word with fewer than 3 fields in "), F.col("book"))))
        .otherwise(F.get(w, 2)).alias("codes"),
        F.get(w, 0).alias("lemma"),
        F.get(w, 1).alias("coreid"),
        padded_id("book_no", "chapter", "verse_no").alias("verse"),
        sequence_id("book_no", "chapter", "verse_no", "ordinal").alias("id"),
    )
    if dictionary:
        # a grammar's tags are few, a corpus's words are not: these are not shuffled
        decoded = decode_by_dictionary(words, "codes", pronoun_person=pronoun_person, on_error=on_error, known_small=True).withColumnRenamed(
            "morphology_string", "MorphologyString"
        )
    else:
        decoded = words.withColumn("morphology", decode_tree("codes", pronoun_person=pronoun_person, on_error=on_error)).select(
            "*", language("codes").alias("language"), tag_string("morphology").alias("MorphologyString")
        )
        if on_error == "null":
            decoded = decoded.withColumn("decode_error", tree_error("codes", pronoun_person=pronoun_person))
    extra = ["decode_error"] if on_error == "null" else []
    return decoded.select("book", "book_no", "chapter", "verse_no", "word_no", "ordinal", *WORD_COLUMNS, *extra)
