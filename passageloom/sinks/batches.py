"""Dense CSV lines that arrive batch by batch, each batch once and whole, under one header.

Spark writes the lines of a batch to a folder that readers do not see; when all tasks have committed, that folder gets the
name of the batch by one rename. A batch that is there already is not written again, and a job that fails takes its unseen
folder away. Readers take ``folder/*``: the header's folder comes first by name, then the batches by name.

One writer at a time, on a file system whose rename of a folder is one step. Defined cases: an empty batch is recorded and
has no lines; a batch over another word list is refused; names are of letters, digits, ``_``, ``.`` and ``-``.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.sinks.files import dense_lines, header_line, in_order

HEADER = "header"
_BATCH = "lines-"
_NAME = re.compile(r"[A-Za-z0-9_.-]+")


def _paths(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _put(lines: DataFrame, folder: str, name: str, compression: str | None) -> None:
    """Write under a hidden name, then rename; nothing is left of a job that fails."""
    spark = lines.sparkSession
    system, path = _paths(spark, folder)
    begun = f"{folder}/_begun-{uuid.uuid4().hex}"
    try:
        lines.write.text(begun, compression=compression, lineSep="\n")
        if not system.rename(path(begun), path(f"{folder}/{name}")):
            raise OSError(f"{begun} cannot be renamed to {name}")
    finally:
        system.delete(path(begun), True)


def batches_of(spark: SparkSession, folder: str) -> list[str]:
    """The names of the batches in a folder, ascending."""
    system, path = _paths(spark, folder)
    if not system.exists(path(folder)):
        return []
    names = [f.getPath().getName() for f in system.listStatus(path(folder))]
    return sorted(n.removeprefix(_BATCH) for n in names if n.startswith(_BATCH))


def add_dense_batch(
    vectors: DataFrame, vocabulary: DataFrame, folder: str, batch: str, ordered: bool = False, compression: str | None = None
) -> bool:
    """Add ``id,v,v,...`` lines ascending by id, unless the folder has the batch; true if they were added.

    Vectors become text where they are written, so no rendered line is shuffled, and with ``ordered=True`` (rows ascending
    by id, as ``dense_tfidf(ordered=True)`` gives them) no vector either. Batches of one folder may differ in ``compression``.
    """
    if not _NAME.fullmatch(batch):
        raise ValueError(f"no name of a batch: {batch!r}")
    spark = vectors.sparkSession
    system, path = _paths(spark, folder)
    header = header_line(vocabulary)
    if not system.exists(path(f"{folder}/{HEADER}")):
        system.mkdirs(path(folder))
        _put(header, folder, HEADER, compression)
    elif not header.exceptAll(spark.read.text(f"{folder}/{HEADER}", lineSep="\n").toDF("line")).isEmpty():
        raise ValueError(f"{folder} has lines over another word list")
    if batch in batches_of(spark, folder):
        return False
    lines = dense_lines(in_order(vectors, ordered)).select("line")
    _put(lines, folder, f"{_BATCH}{batch}", compression)
    return True
