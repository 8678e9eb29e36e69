"""Toxicity by a weighted lexicon, matched by Aho-Corasick after folding.

Folding makes one spelling of many: small letters, no accents, look-alike letters of other scripts and full-width forms
as Latin ones, digits and signs that stand for letters as those letters (l, 1 and i become one), everything else a
blank. Lexicon entries are beginnings of words in that spelling, or whole words. An automaton finds them all in one pass over the whole
text; at each word only the heaviest entry counts, and none counts inside an exception phrase. The weights found,
their largest and their number are set against the length of the text, and a logistic function makes a score of them.

A fixed list of insults with one weight starts the lexicon. Further entries and all weights are learnt from labelled rows
outside the held-out part (see ``held_out``): an entry weighs what its log odds between toxic and clean documents are
known to be at least. Entries come from one half of the training rows, the logistic function from the other.

Fitting uses a bounded sample of the labelled rows (TRAINING_TOXIC and TRAINING_CLEAN documents, picked by a hash of the
id); every entry of it that passes the weight test is learnt, and every row of the table is scored, whole.

Defined cases: null and empty texts have no matches and get the score of an empty text; equal rows get equal scores;
rows whose doc_id is null are scored and not held out; several labels of one id count as toxic if one is; without usable
labels the fixed list and fixed coefficients are used; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passageloom.llm.quality import fit
from passageloom.operators.staging import stage

TRAINING_TOXIC, TRAINING_CLEAN = 3000, 6000
SHORTEST, LONGEST = 4, 12
THRESHOLD = 0.3

# Insults and their starting weight, and phrases in which such words are harmless.
INSULTS = [
    "idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "imbecile", "dumbass", "bastard", "asshole",
    "retard", "dimwit", "halfwit", "jackass", "cretin", "vermin", "lowlife", "degenerate", "garbage", "filthy", "ugly", "shut up", "kill yourself",
]
INSULT_WEIGHT = 3.0
EXCEPTIONS = ["trash can", "trash bag", "trash bin", "trash collection", "garbage can", "garbage collect", "garbage truck", "clown fish", "class clown", "circus clown", "ugly duckling", "sore loser", "stupid mistake", "not stupid", "filthy rich"]
# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ɩ": "i", "ո": "n", "ս": "u", "օ": "o", "հ": "h", "ß": "b", "ø": "o", "đ": "d", "ł": "l", "ð": "d",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i", "|": "i"}


class _Folding(dict):
    """The folded form of each character, worked out at its first sight."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c in LOOK_ALIKES:
            c = LOOK_ALIKES[c]
        else:
            base = unicodedata.normalize("NFKD", c)
            c = "".join(x for x in base if not unicodedata.combining(x)).lower()
            c = "".join(LOOK_ALIKES.get(x, x) for x in c)
        c = "".join(DIGITS.get(x, x if x.isalpha() else " ") for x in c) if c else c
        self[code] = c
        return c


_folding = _Folding()


def folded(text: str | None) -> str:
    return f" {(text or '').lower().translate(_folding)} "


def _automaton(lexicon: dict[str, float]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for entry, weight in lexicon.items():
        found.add_word(f" {entry}", (len(entry) + 1, weight))
    for phrase in EXCEPTIONS:
        entry = folded(phrase).strip()
        found.add_word(f" {entry}", (len(entry) + 1, -1.0))
    found.make_automaton()
    return found


def _outside(best: dict[int, float], free: list[tuple[int, int]]) -> dict[int, float]:
    """The places that lie in none of the spans: both sides are sorted and walked once."""
    free.sort()
    kept, reach, i = {}, -1, 0
    for at in sorted(best):
        while i < len(free) and free[i][0] <= at:
            reach = max(reach, free[i][1])
            i += 1
        if at > reach:
            kept[at] = best[at]
    return kept


def measures(text: str | None, automaton) -> tuple[float, float, float, float]:
    """log of the weight found, weight for each root of the words, the largest weight, log of the number of words."""
    body = folded(text)
    best: dict[int, float] = {}
    free: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(body):
        start = end - size + 1
        if weight < 0:
            free.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    if free:
        best = _outside(best, free)
    words = body.count(" ")
    total = sum(best.values())
    return float(np.log1p(total)), total / (words + 1.0) ** 0.5, max(best.values(), default=0.0), float(np.log1p(words))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, half of a bounded sample of the labelled documents that are not held out."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("pick", F.xxhash64("doc_id"))
    some = [known.where(F.col("toxic") == t).orderBy("pick").limit(n) for t, n in ((1, TRAINING_TOXIC), (0, TRAINING_CLEAN))]
    picked = stage(some[0].union(some[1]), "labelled")
    # At most TRAINING_TOXIC + TRAINING_CLEAN rows of three numbers.
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic", F.pmod("pick", F.lit(2)).alias("half"))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Entries and weights from (text, toxic) rows. Counts are summed in the tasks and again by entry."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            size = [0, 0]
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = {w for w in folded(text).split() if len(w) >= SHORTEST}
                # Beginnings of SHORTEST to LONGEST letters, and longer words whole.
                entries = words | {w[:n] for w in {w[:LONGEST] for w in words} for n in range(SHORTEST, len(w) + 1)}
                (toxic if label else clean).update(entries)
                size[bool(label)] += 1
            toxic[""], clean[""] = size[1], size[0]
            every = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays([pa.array(every), pa.array([toxic[e] for e in every], pa.int64()), pa.array([clean[e] for e in every], pa.int64())], names=["entry", "toxic", "clean"])

    counts = stage(rows.mapInArrow(count, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "entries")
    whole = counts.where("entry = ''").first()
    lexicon = {folded(word).strip(): INSULT_WEIGHT for word in INSULTS}
    if not whole or not whole["toxic"] or not whole["clean"]:
        return lexicon
    odds = F.log((F.col("toxic") + 0.5) / (whole["toxic"] + 1.0)) - F.log((F.col("clean") + 0.5) / (whole["clean"] + 1.0))
    doubt = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    weighed = counts.where("entry != '' AND toxic >= 3").withColumn("weight", odds - 2.5 * doubt)
    # The sample bounds them, for an entry has to stand in three of its documents.
    best = weighed.where("weight > 0.5").collect()
    return lexicon | {r["entry"]: max(r["weight"], lexicon.get(r["entry"], 0.0)) for r in best}


def fit_score(rows: DataFrame, lexicon: dict[str, float]) -> np.ndarray:
    """Coefficients of the four measures and the constant."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(lexicon)
        for batch in batches:
            found = [measures(t, automaton) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), pa.array(batch.column("toxic").to_pylist(), pa.int32())], names=["x", "toxic"])

    # Rows of one id may repeat in the documents without bound; the limit keeps the sample within its documented size, and the
    # order makes it the same one in each run.
    sample = stage(rows.mapInArrow(measure, "x array<double>, toxic int"), "measures").orderBy(F.xxhash64("toxic", "x")).limit(TRAINING_TOXIC + TRAINING_CLEAN).toPandas()
    if sample["toxic"].nunique() < 2:
        return np.array([1.5, 2.0, 0.3, -0.2, -4.0])
    x = np.array(sample["x"].tolist())
    weights, constant = fit(x, sample["toxic"].to_numpy(dtype=float), ridge=1e-2)
    return np.append(weights, constant)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score of every document."""
    rows = training_rows(docs, labels)
    lexicon = learn_lexicon(rows.where("half = 0"))
    coefficients = fit_score(rows.where("half = 1"), lexicon)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(lexicon)
        for texts in batches:
            x = np.array([measures(t, automaton) for t in texts]).reshape(-1, 4)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ coefficients[:-1] + coefficients[-1], -30, 30))))

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scores = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scores.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
