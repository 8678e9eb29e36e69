"""TF-IDF weights: long (one row for each passage and word) and dense (one vector for each passage)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passageloom.functions import text as T
from passageloom.functions.weights import term_frequency, tfidf_of_product, tfidf_of_share
from passageloom.operators.frequency import frequency_of_counts, idf_of
from passageloom.operators.lookup import BROADCAST_BYTES, fits_broadcast, lookup_join
from passageloom.operators.staging import null_row, stage
from passageloom.operators.terms import counts_of, term_counts, term_counts_with_end, with_term_counts


def term_frequencies(passages: DataFrame, lowercase: bool = True) -> DataFrame:
    """(passage_id, word, tf) with tf the share of the passage's words."""
    counts = term_counts(passages, lowercase)
    return counts.select("passage_id", "word", term_frequency(F.col("tf"), F.col("n_words")).alias("tf"))


def tfidf_with_table(
    counts: DataFrame, idf: DataFrame, missing_idf: float | None = None, budget: int = BROADCAST_BYTES
) -> DataFrame:
    """Weights of given term counts and a given staged (word, idf) table.

    Words without an IDF are left out, or take ``missing_idf``.
    """
    joined = lookup_join(counts, idf.select("word", "idf"), "word", "inner" if missing_idf is None else "left", budget=budget)
    weight = F.col("idf") if missing_idf is None else F.coalesce("idf", F.lit(missing_idf))
    return joined.select("passage_id", "word", tfidf_of_share(F.col("tf"), F.col("n_words"), weight).alias("tfidf"))


def tfidf_sparse(passages: DataFrame, lowercase: bool = True, budget: int = BROADCAST_BYTES) -> DataFrame:
    """(passage_id, word, tfidf) over the vocabulary of the corpus.

    The texts are taken apart once: their term counts are staged, one row for each passage, and both the document
    frequencies and the weights read those. The frequencies tell the join which words are too frequent to be shuffled.
    """
    counted = stage(with_term_counts(passages, lowercase), "term-counts")
    frequency = frequency_of_counts(counted)
    idf = idf_of(frequency)
    occurrences = frequency.table.select("word", F.col("df").alias("n"))
    joined = lookup_join(
        counts_of(counted), idf.select("word", "idf"), "word", counts=occurrences, budget=budget, stored=True
    )
    return joined.select(
        "passage_id", "word", tfidf_of_share(F.col("tf"), F.col("n_words"), F.col("idf")).alias("tfidf")
    )


def tfidf_for_vocabulary(
    passages: DataFrame, idf: DataFrame, lowercase: bool = True, budget: int = BROADCAST_BYTES
) -> DataFrame:
    """(passage_id, word, tfidf) for the words of a given (word, idf) table, zeros left out."""
    joined = lookup_join(term_counts(passages, lowercase), idf.select("word", "idf"), "word", budget=budget)
    return joined.select(
        "passage_id", "word", tfidf_of_product(F.col("tf"), F.col("n_words"), F.col("idf")).alias("tfidf")
    )


def index_vocabulary(words: DataFrame, *order: str) -> DataFrame:
    """(word_idx, word): number a word list from 0 in the given order (by word if none is given).

    The list is sorted by range, written with the place of each row in its partition, and the sizes of the partitions
    before it are added: no task sees more than its own range.
    """
    order = order or ("word",)
    ranged = words.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = stage(
        ranged.select("word", F.shiftright(place, 33).alias("_range"), place.bitwiseAND(F.lit(2**33 - 1)).alias("_place")),
        "word-places",
    )
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    # One row for each partition of the list.
    numbered = placed.join(F.broadcast(offsets), "_range")
    return numbered.select((F.col("_offset") + F.col("_place")).alias("word_idx"), "word")


def attach_idf(vocabulary: DataFrame, idf: DataFrame) -> DataFrame:
    """Staged (word_idx, word, idf), idf null where the IDF table has no such word."""
    return stage(vocabulary.join(idf.select("word", "idf"), "word", "left").select("word_idx", "word", "idf"), "vocabulary-idf")


def dense_tfidf(
    passages: DataFrame,
    vocabulary_idf: DataFrame,
    lowercase: bool = True,
    unique_ids: bool = True,
    empty: str = "zero",
    share_first: bool = False,
    digits: int | None = None,
    budget: int = BROADCAST_BYTES,
    ordered: bool = False,
    text: str | None = None,
    staged: bool = False,
) -> DataFrame:
    """(passage_id, vector): the weights of every passage in vocabulary order, rounded if ``digits`` is given.

    ``vocabulary_idf`` is a staged (word_idx, word, idf) table with word_idx from 0. Words absent from a passage weigh
    0 (NaN when their idf is Infinity, as 0 * Infinity); words with a null idf weigh 0. ``empty="nan"`` makes the
    vector of a passage without words all NaN. With ``unique_ids=False`` equal ids stay separate rows.

    Only the words of the list are grouped: what gets shuffled is one short (index, weight) array for each passage.
    For the sinks, ``ordered=True`` gives the rows ascending by id: these short arrays are sorted, not the filled vectors.
    With a separator as ``text`` the rows are (passage_id, values), the numbers as text between separators: zeros are copied
    as text and never become numbers. For rows that are used more than once, ``staged=True`` stages the short arrays; vectors
    or their text are made from them for each use.
    """
    if empty not in ("zero", "nan"):
        raise ValueError(f"empty must be 'zero' or 'nan', not {empty!r}")
    size, infinite = _background(vocabulary_idf)

    source = passages
    group = ["passage_id"]
    if not unique_ids:
        source = passages.withColumn("_row", F.monotonically_increasing_id())
        group.append("_row")
    weighted = tfidf_of_share if share_first else tfidf_of_product
    weight = weighted(F.col("tf"), F.col("n_words"), F.col("idf"))
    if digits is not None:
        weight = F.round(weight, digits)
    hit = F.struct(F.col("word_idx").cast("int").alias("word_idx"), weight.alias("weight"))

    listed = vocabulary_idf.where(F.col("idf").isNotNull())
    if fits_broadcast(listed, "word", budget):
        # The null word joins a null row of the list, which keeps one row for each passage.
        wanted = listed.unionByName(null_row(vocabulary_idf)).withColumnRenamed("word", "_listed")
        found = term_counts_with_end(source, lowercase).join(
            F.broadcast(wanted), F.col("word").eqNullSafe(F.col("_listed")), "inner"
        )
        hits = found.select(*group, "n_words", F.when(F.col("word_idx").isNotNull(), hit).alias("hit"))
    else:
        if not unique_ids:
            source = stage(source, "numbered-passages")
        found = lookup_join(term_counts(source, lowercase), listed, "word", budget=budget)
        hits = found.select(*group, "n_words", hit.alias("hit"))
        lengths = source.select(*group, F.size(T.words(F.col("passage"), lowercase)).cast("bigint").alias("n_words"))
        hits = hits.unionByName(lengths.withColumn("hit", F.lit(None).cast(hits.schema["hit"].dataType)))
    grouped = hits.groupBy(*group).agg(F.max("n_words").alias("n_words"), F.sort_array(F.collect_list("hit")).alias("hits"))
    if staged:
        grouped = stage(grouped, "hits")
    order = "passage_id" if ordered else None
    if text is not None:
        values = F.col("values")
        if empty == "nan":
            values = F.when(F.col("n_words") == 0, joined(F.repeat(F.lit(f"NaN{text}"), F.lit(size)), text)).otherwise(values)
        return fill_text(grouped, "hits", size, text, infinite, order).select("passage_id", values.alias("values"))
    filled = fill_vector(grouped, "hits", size, infinite, order)
    vector = F.col("vector")
    if empty == "nan":
        vector = F.when(F.col("n_words") == 0, F.transform(vector, lambda x: F.lit(float("nan")))).otherwise(vector)
    return filled.select("passage_id", vector.alias("vector"))


def densify(
    sparse: DataFrame,
    vocabulary: DataFrame,
    passages: DataFrame,
    budget: int = BROADCAST_BYTES,
) -> DataFrame:
    """(passage_id, vector) from (passage_id, word, tfidf) for a staged (word_idx, word) list.

    Every passage of ``passages`` gets a vector; words it does not have weigh 0.
    """
    size = vocabulary.count()
    hits = lookup_join(sparse, vocabulary, "word", budget=budget).select(
        "passage_id", F.struct(F.col("word_idx").cast("int").alias("word_idx"), F.col("tfidf").alias("weight")).alias("hit")
    )
    every = passages.select("passage_id", F.lit(None).cast(hits.schema["hit"].dataType).alias("hit"))
    grouped = hits.unionByName(every).groupBy("passage_id").agg(F.sort_array(F.collect_list("hit")).alias("hits"))
    return fill_vector(grouped, "hits", size).select("passage_id", "vector")


def _background(vocabulary_idf: DataFrame) -> tuple[int, DataFrame | None]:
    """The number of words, and the indexes of those that weigh NaN where they are absent (idf is Infinity), if any.

    The indexes are one row (infinite), at most as long as each row of the result.
    """
    is_infinite = F.col("idf") == F.lit(float("inf"))
    found = vocabulary_idf.agg(F.count("*").alias("size"), F.count_if(is_infinite).alias("infinite")).first()
    if not found["infinite"]:
        return found["size"], None
    indexes = vocabulary_idf.where(is_infinite).agg(F.collect_list(F.col("word_idx").cast("int")).alias("infinite"))
    return found["size"], stage(indexes, "infinite")


def fill_vector(
    grouped: DataFrame, hits: str, size: int, infinite: DataFrame | None = None, order: str | None = None
) -> DataFrame:
    """Add ``vector``: the hits (sorted by word_idx) at their places, 0 between them, NaN at ``infinite`` places without one.

    Built from the gaps between one hit and the next, so the work is the length of the vector plus the hits. Rows ascend by
    ``order``, if given.
    """

    bounded, keep = _bounded_hits(grouped, hits, size, infinite, order)
    gap = lambda length: F.array_repeat(F.lit(0.0), length)
    pieces = F.transform("_hits", lambda hit, k: F.concat(F.array(hit["weight"]), gap(_zeros_behind(hit, k))))
    return bounded.select(*keep, F.flatten(F.concat(F.array(gap(F.get(F.col("_next"), F.lit(0)))), pieces)).alias("vector"))


def fill_text(
    grouped: DataFrame, hits: str, size: int, separator: str, infinite: DataFrame | None = None, order: str | None = None
) -> DataFrame:
    """As ``fill_vector``, but add ``values``: the numbers as text, with a separator between them."""
    bounded, keep = _bounded_hits(grouped, hits, size, infinite, order)
    gap = lambda length: F.repeat(F.lit(f"0.0{separator}"), length)
    pieces = F.transform("_hits", lambda hit, k: F.concat(hit["weight"].cast("string"), F.lit(separator), gap(_zeros_behind(hit, k))))
    whole = F.concat(gap(F.get(F.col("_next"), F.lit(0))), F.array_join(pieces, ""))
    return bounded.select(*keep, joined(whole, separator).alias("values"))


def joined(text: Column, separator: str) -> Column:
    """Without the separator at the end."""
    return F.rtrim(text, F.lit(separator))


def _zeros_behind(hit: Column, k: Column) -> Column:
    return F.get(F.col("_next"), k + 1) - hit["word_idx"] - 1


def _bounded_hits(
    grouped: DataFrame, hits: str, size: int, infinite: DataFrame | None, order: str | None
) -> tuple[DataFrame, list[str]]:
    """(``_hits``, ``_next``) beside the other columns: all hits, NaN included, and their places, the size at the end."""
    if infinite is not None:
        # One row, which every row takes along.
        one = F.broadcast(infinite.select(F.lit(1).alias("_one"), "infinite"))
        grouped = grouped.withColumn("_one", F.lit(1)).join(one, "_one", "left").drop("_one")
        placed = F.transform(F.col(hits), lambda hit: hit["word_idx"])
        nan = F.transform(
            F.array_except("infinite", placed), lambda i: F.struct(i.alias("word_idx"), F.lit(float("nan")).alias("weight"))
        )
        grouped = grouped.withColumn(hits, F.sort_array(F.concat(F.col(hits), nan))).drop("infinite")
    if order is not None:  # behind the join, below which the optimizer takes a sort away
        grouped = grouped.orderBy(order)
    keep = [c for c in grouped.columns if c != hits]
    bounded = grouped.select(
        *keep,
        F.col(hits).alias("_hits"),
        F.array_append(F.transform(F.col(hits), lambda hit: hit["word_idx"]), F.lit(size)).alias("_next"),
    )
    return bounded, keep
