"""Text and CSV files in the formats that the readers take back.

A dense line is as long as the word list, mostly zeros. With a codec as ``compression`` (``"lz4"``, ``"gzip"``) the same lines
take about as much room as the words that a passage has; Spark's readers take such files back by their ending. One file is then
read by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passageloom.functions.vectors import text_of_embedding

# The column names and the line of an answer, as the readers of these files expect them.
IDF_WORD, IDF_VALUE = "Key", "Value"
DENSE_ID = "passageId"
ANSWER_LINE = "(%d, %d)"


def write_vocabulary(vocabulary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One word for each line, ascending."""
    vocabulary.select("word").orderBy("word").write.mode(mode).text(path, lineSep="\n")


def write_idf(idf: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with the header ``Key,Value``, ascending by word."""
    idf.select(F.col("word").alias(IDF_WORD), F.col("idf").alias(IDF_VALUE)).orderBy(IDF_WORD).write.mode(mode).csv(
        path, header=True, escape='"', lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def dense_lines(vectors: DataFrame) -> DataFrame:
    """(passage_id, line) with ``id,v,v,...``, from vectors or from their text (``dense_tfidf(text=",")``)."""
    values = F.array_join(F.col("vector").cast("array<string>"), ",") if "vector" in vectors.columns else F.col("values")
    return vectors.select("passage_id", F.concat_ws(",", "passage_id", values).alias("line"))


def header_line(vocabulary: DataFrame) -> DataFrame:
    """(line): ``passageId,<word>,...``, one row."""
    named = vocabulary.agg(F.sort_array(F.collect_list(F.struct("word_idx", "word"))).alias("w"))
    return named.select(F.concat_ws(",", F.lit(DENSE_ID), F.transform("w", lambda x: x["word"])).alias("line"))


def in_order(vectors: DataFrame, ordered: bool) -> DataFrame:
    """The rows ascending by id; as they are if they have that order (``dense_tfidf(ordered=True)``)."""
    return vectors if ordered else vectors.orderBy("passage_id")


def write_dense_csv(
    vectors: DataFrame,
    vocabulary: DataFrame,
    path: str,
    mode: str = "errorifexists",
    ordered: bool = False,
    compression: str | None = None,
) -> None:
    """Header ``passageId,<word>,...`` on a line of its own, then ``id,v,v,...`` ascending by id.

    The files of the folder hold the lines in this order, the header first. The header is one line by its format, about
    as long as every line after it; it is the only thing that one task puts together. Vectors become text where they are
    written, and with ``ordered=True`` (rows ascending by id, as ``dense_tfidf(ordered=True)`` gives them) none is shuffled.
    """
    # A union keeps the partitions of its sides in their order.
    rows = dense_lines(in_order(vectors, ordered)).select("line")
    header_line(vocabulary).unionByName(rows).write.mode(mode).text(path, compression=compression, lineSep="\n")


def append_dense_csv(vectors: DataFrame, path: str, compression: str | None = None) -> None:
    """Add ``id,v,v,...`` lines of one more batch to a folder, without a header and in no special order."""
    dense_lines(vectors).select("line").write.mode("append").text(path, compression=compression, lineSep="\n")


def write_dense_vectors(
    vectors: DataFrame, path: str, mode: str = "errorifexists", ordered: bool = False, compression: str | None = None
) -> None:
    """``id,v:v:...:v`` ascending by id, from vectors or from their text (``dense_tfidf(text=":")``).

    No separator follows the last value, so ``read_embeddings`` takes it back.
    """
    values = text_of_embedding(F.col("vector")) if "vector" in vectors.columns else F.col("values")
    in_order(vectors, ordered).select(
        F.concat(F.col("passage_id"), F.lit(","), values)
    ).write.mode(mode).text(path, compression=compression, lineSep="\n")


def write_embeddings(embeddings: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``id,v:v:...:v``, in the order the rows have."""
    embeddings.select(
        F.concat(F.col("id").cast("string"), F.lit(","), text_of_embedding(F.col("embedding")))
    ).write.mode(mode).text(path, lineSep="\n")


def write_passages(passages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``id,text`` lines without a header; line feeds in a text are written as blanks."""
    text = F.replace(F.col("passage"), F.lit("\n"), F.lit(" "))
    passages.select(F.concat(F.col("passage_id"), F.lit(","), text)).write.mode(mode).text(path, lineSep="\n")


def write_answers(answers: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``(query, passage)`` for each answered query, in the order of the queries (by id if they have no position)."""
    order = ["pos"] if "pos" in answers.columns else ["query_id", "passage_id"]
    line = F.format_string(ANSWER_LINE, F.col("query_id"), F.col("passage_id"))
    answers.where(F.col("passage_id").isNotNull()).orderBy(*order).select(line).write.mode(mode).text(path, lineSep="\n")
