"""Passage tables: (passage_id string, passage string)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.functions import text as T
from passageloom.operators.dedup import least_place, place_of
from passageloom.operators.lookup import BROADCAST_BYTES, fits_broadcast
from passageloom.operators.staging import spread, stage
from passageloom.sources.files import read_lines, with_file_number


def read_passages(
    spark: SparkSession, path: str | list[str], header: bool = True, unique: bool = True, keep_blank: bool = True
) -> DataFrame:
    """Read ``id,text`` lines of a file, a folder or several of them.

    ``header=True`` skips the first line of each file; with ``header=False`` it counts as a passage. ``unique=True``
    keeps one passage for each id: the last line of the first file by name. ``keep_blank=False`` drops the blank lines,
    which otherwise are passages with an empty id.
    """
    lines = read_lines(spark, path, header)
    if not keep_blank:
        lines = lines.where(F.col("value") != "")
    rows = lines.select(
        T.key_before_comma(F.col("value")).alias("passage_id"),
        T.text_after_comma(F.col("value")).alias("passage"),
        "file",
        "block",
        "row",
    )
    if unique:
        # Lines are read once and stored with their place, so that the aggregate and the rows it picks agree on it however
        # a scan is split. The numbers of a split grow with its lines.
        numbered = with_file_number(spark, rows, path)
        place = place_of(F.col("file"), F.col("block"), F.col("row").bitwiseAND(F.lit(2**33 - 1)))
        placed = stage(numbered.select("passage_id", "passage", place.alias("place")), "lines")
        rows = least_place(placed, "passage_id", "place")
    return rows.select("passage_id", "passage")


def passages_of_table(table: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """A table with unique ids as passages, commas read as blanks as in the text files and null as an empty text."""
    rows = table.select(
        F.col(id_column).cast("string").alias("passage_id"), F.coalesce(text_column, F.lit("")).alias("passage")
    )
    return spread(rows, "passage_id").select("passage_id", T.commas_to_blanks(F.col("passage")).alias("passage"))


def lookup_passage(passages: DataFrame, passage_id: str) -> DataFrame:
    """The passage with one id, or no row."""
    return passages.where(F.col("passage_id") == F.lit(passage_id))


def lookup_passages(passages: DataFrame, keys: DataFrame, budget: int = BROADCAST_BYTES) -> DataFrame:
    """The passages whose id is among ``keys``. A bounded list of keys is broadcast and no text is shuffled."""
    wanted = stage(keys.select("passage_id").distinct(), "keys")
    if fits_broadcast(wanted, "passage_id", budget):
        wanted = F.broadcast(wanted)
    return passages.join(wanted, "passage_id", "left_semi")


def passage_texts(passages: DataFrame) -> DataFrame:
    return passages.select("passage")
