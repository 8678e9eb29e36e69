"""A quality classifier from weak labels.

Nine overlapping heuristics vote good, bad or nothing on every document. Expectation-maximisation on the table of vote
patterns (at most 3 ** 9 rows, counted over all documents) estimates how often each heuristic is right when it votes, and so the
posterior of each pattern. The posteriors are the labels on which a linear scorer over hashed features
is trained, and the scorer decides; the true labels of the tables are never read.

The scorer is fitted on a bounded sample, TRAINING_ROWS documents picked by a hash of their id and text; votes, EM and
scores cover all documents.

Defined cases: null and empty texts, on which all heuristics are silent, are scored by the intercept and the empty
feature vector; equal rows get equal scores; if all documents have one vote pattern, or there is none, the scorer is flat
and keeps everything; an empty table gives no rows; extra columns are kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passageloom.llm.byte_words import NOT_SPACE, hashes, in_chunks, word_bounds
from passageloom.llm.numbering import free_names
from passageloom.operators.staging import stage

TRAINING_ROWS = 4096
HASHED = 1024
#: What a row adds to the bytes of a chunk, so that short rows do not fill the memory with features.
ROW_BYTES = 4096
#: Votes of the smoothing prior of each accuracy.
PRIOR_VOTES = 50
#: A document goes when the scorer holds it for bad with at least this probability.
REJECT_AT = 0.7

UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
SENTENCE_MARKS = b".,;:!?'\"()-"
ODD_MARK = np.array([0x21 <= b <= 0x7E and not chr(b).isalnum() and b not in SENTENCE_MARKS for b in range(256)])
MARK = np.array([0x21 <= b <= 0x7E and not chr(b).isalnum() for b in range(256)])
# For the hashed features a byte counts as its class: letters small, large or outside ASCII, digits, white space, or itself.
CLASS = np.array([1 if 0x61 <= b <= 0x7A else 2 if 0x41 <= b <= 0x5A else 3 if b >= 0x80 else 4 if 0x30 <= b <= 0x39 else 5 if b == 0x20 else 6 if b == 0x0A else 7 + b for b in range(256)], dtype=np.uint64)

#: name: (good from, good to, bad from, bad to); a heuristic without a good range votes bad or nothing.
NEVER = (2.0, -2.0)
HEURISTICS = {
    "large_letters": (*NEVER, 0.35, 1.0),
    "odd_marks": (*NEVER, 0.06, 1.0),
    "mark_runs": (*NEVER, 0.10, np.inf),
    "separators": (*NEVER, 0.10, np.inf),
    "repeated_lines": (*NEVER, 0.50, 1.0),
    "repeated_words": (*NEVER, 0.20, 1.0),
    "distinct_words": (0.35, 1.0, 0.0, 0.15),
    "short_words": (0.15, 0.60, 0.0, 0.05),
    "sentence_ends": (0.03, 0.30, 0.0, 0.01),
}
BINS = 8


def measures(texts: list[str | None]) -> np.ndarray:
    """The measure behind each heuristic for each text; NaN where it says nothing."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    out = np.full((len(texts), len(HEURISTICS)), np.nan)
    for part in in_chunks([len(e) for e in encoded]):
        chunk = encoded[part]
        joined = b"\n".join(chunk)
        data = np.frombuffer(joined, dtype=np.uint8)
        if not len(data):
            continue
        sizes = np.array([len(e) + 1 for e in chunk])
        text_ends = np.cumsum(sizes)
        text_starts = text_ends - sizes

        def per_text(mask: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(mask), [0]])
            sums[-1] = sums[-2]
            return (sums[text_ends] - sums[text_starts]).astype(float)

        def counted(positions: np.ndarray) -> np.ndarray:
            return np.bincount(np.searchsorted(text_ends, positions, side="right"), minlength=len(chunk)).astype(float)

        starts, ends = word_bounds(data, NOT_SPACE)
        of = np.searchsorted(text_ends, starts, side="right")
        words = np.bincount(of, minlength=len(chunk)).astype(float)
        word_hash = hashes(data, starts, ends)
        same = (word_hash[1:] == word_hash[:-1]) & (of[1:] == of[:-1])
        by_word = np.lexsort((word_hash, of))
        fresh = np.ones(len(by_word), dtype=bool)
        fresh[1:] = (word_hash[by_word][1:] != word_hash[by_word][:-1]) | (of[by_word][1:] != of[by_word][:-1])
        distinct = np.bincount(of[by_word], weights=fresh, minlength=len(chunk))
        visible = per_text(NOT_SPACE[data])
        mark = MARK[data]
        runs = np.flatnonzero(mark[1:] & (data[1:] == data[:-1]))
        line = data != 0x0A
        line_starts, line_ends = word_bounds(line.astype(np.uint8), np.array([False, True] + [False] * 254))
        line_of = np.searchsorted(text_ends, line_starts, side="right")
        line_hash = hashes(data, line_starts, line_ends)
        order = np.lexsort((line_hash, line_of))
        again = np.zeros(len(order), dtype=bool)
        again[1:] = (line_hash[order][1:] == line_hash[order][:-1]) & (line_of[order][1:] == line_of[order][:-1])
        lines = np.bincount(line_of, minlength=len(chunk)).astype(float)
        with np.errstate(invalid="ignore", divide="ignore"):
            letters = per_text(LETTER[data])
            out[part, 0] = np.where(letters >= 20, per_text(UPPER[data]) / letters, np.nan)
            out[part, 1] = per_text(ODD_MARK[data]) / visible
            out[part, 2] = counted(runs) / words
            out[part, 3] = per_text((data == 0x7C) | (data == 0x7E) | (data == 0x5F) | (data == 0x23)) / words
            out[part, 4] = np.where(lines > 1, np.bincount(line_of[order], weights=again, minlength=len(chunk)) / lines, np.nan)
            out[part, 6] = np.where(words > 30, distinct / words ** 0.9, np.nan)
            out[part, 7] = np.where(words > 20, np.bincount(of, weights=ends - starts <= 3, minlength=len(chunk)) / words, np.nan)
            out[part, 5] = np.where(words > 5, np.bincount(of[1:], weights=same, minlength=len(chunk)) / words, np.nan)
            ended = np.isin(data[ends - 1], np.frombuffer(b".!?", dtype=np.uint8))
            out[part, 8] = np.where(words > 5, np.bincount(of, weights=ended, minlength=len(chunk)) / words, np.nan)
    return out


def votes(measured: np.ndarray) -> np.ndarray:
    """1 good, 0 bad, 2 nothing."""
    good_from, good_to, bad_from, bad_to = np.array(list(HEURISTICS.values())).T
    with np.errstate(invalid="ignore"):
        is_good = (measured >= good_from) & (measured <= good_to)
        is_bad = (measured >= bad_from) & (measured <= bad_to)
    return np.where(is_good, 1, np.where(is_bad, 0, 2))


def patterns(measured: np.ndarray) -> np.ndarray:
    """The votes of each text as one number in base 3."""
    return votes(measured) @ 3 ** np.arange(len(HEURISTICS))


def label_model(counts: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of being bad of each pattern, and the accuracy of each heuristic.

    A heuristic that votes is right with its accuracy among votes of that kind; silence says nothing, and a text on which
    all are silent is held for good. The classes are taken as equally likely, since a prior learnt from the same votes
    would let the larger class swallow the other. Starts from: any vote for bad makes a document bad. Accuracies are
    smoothed by PRIOR_VOTES votes that are right 9 times in 10, and kept from 0.6 to 0.995; a vote for good stays at 0.9
    or less, for it sees the absence of one kind of junk only. Most junk shows to one heuristic only, so votes alone do not
    tell such a heuristic from a noisy one: thresholds have to be set so that a vote for bad is mostly right.
    """
    keys = np.array(sorted(counts), dtype=np.int64)
    weight = np.array([counts[k] for k in keys.tolist()], dtype=float)
    given = keys[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3
    says_bad, says_good = (given == 0).astype(float), (given == 1).astype(float)
    posterior = np.where(says_bad.any(axis=1), 0.9, 0.1)
    accuracy = np.full((2, len(HEURISTICS)), 0.9)
    for _ in range(rounds if len(keys) else 0):
        right = np.stack([(weight * posterior) @ says_bad, (weight * (1 - posterior)) @ says_good])
        cast = np.stack([weight @ says_bad, weight @ says_good])
        accuracy = np.clip((right + 0.9 * PRIOR_VOTES) / (cast + PRIOR_VOTES), 0.6, [[0.995], [0.9]])
        odds = np.log(accuracy / (1 - accuracy))
        # Good votes say how far a text looks like prose; they are three views of one thing and share one voice.
        margin = says_bad @ odds[0] - (says_good @ odds[1]) / np.maximum(1, says_good.sum(axis=1))
        margin -= np.where(says_bad.any(axis=1) | says_good.any(axis=1), 0.0, 2.0)
        updated = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        if np.abs(updated - posterior).max() < 1e-9:
            break
        posterior = updated
    return dict(zip(keys.tolist(), posterior.tolist())), accuracy


def features(texts: list[str | None], measured: np.ndarray) -> np.ndarray:
    """Shares of the hashed trigrams of byte classes, and one of BINS marks for each measure."""
    out = np.zeros((len(texts), HASHED + len(HEURISTICS) * BINS), dtype=np.float32)
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    for part in in_chunks([len(e) + ROW_BYTES for e in encoded]):
        chunk = encoded[part]
        data = CLASS[np.frombuffer(b"\n".join([*chunk, b""]), dtype=np.uint8)]
        if len(data) < 3:
            continue
        gram = (data[:-2] << np.uint64(18)) + (data[1:-1] << np.uint64(9)) + data[2:]
        slot = (gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(54)).astype(np.int64)
        of = np.repeat(np.arange(len(chunk)), [len(e) + 1 for e in chunk])[: len(slot)]
        found = np.bincount(of * HASHED + slot, minlength=len(chunk) * HASHED).reshape(-1, HASHED)
        out[part, :HASHED] = np.sqrt(found / np.maximum(1, found.sum(axis=1, keepdims=True)))
    # Bin 0: nothing measured; 1 for zero, then one for each halving from 1 downwards.
    with np.errstate(divide="ignore", invalid="ignore"):
        halvings = np.where(measured > 0, np.clip(BINS - 2 + np.floor(np.log2(measured)), 1, BINS - 1), 1)
    bin_of = np.where(np.isnan(measured), 0, halvings).astype(np.int64)
    columns = HASHED + np.arange(len(HEURISTICS)) * BINS + bin_of
    out[np.arange(len(texts))[:, None], columns] = 0.3
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 15) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(float)
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge * max(1, len(x)) / 100)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        curvature = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", training_rows: int = TRAINING_ROWS) -> DataFrame:
    """The documents with two more columns: the posterior of the vote pattern, the scorer's probability of being bad."""
    source = docs.select(F.xxhash64(doc_id, text).alias("pick"), F.col(text).alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = patterns(measures(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["pattern"])

    cast = source.mapInArrow(vote, "pattern long").groupBy("pattern").count()
    counts = {row[0]: row[1] for row in stage(cast, "votes").collect()}
    posterior, _ = label_model(counts)
    total = sum(counts.values())
    # By the hash, about training_rows of all rows; the limit only holds if copies of one row crowd the same hash.
    share = int(min(1.0, training_rows / max(1, total)) * 2**62)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("text").to_pylist()
            for part in in_chunks([len(t or "") + ROW_BYTES for t in every]):
                texts = every[part]
                measured = measures(texts)
                x, y = features(texts, measured), [posterior[k] for k in patterns(measured).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(y, pa.float64()), pa.array([row.tobytes() for row in x], pa.binary())], names=["y", "x"])

    picked = source.where(F.shiftrightunsigned("pick", 2) < share)
    sample = stage(picked.mapInArrow(learn, "y double, x binary"), "sample").limit(2 * training_rows).toArrow()
    width = HASHED + len(HEURISTICS) * BINS
    x = np.frombuffer(b"".join(sample.column("x").to_pylist()), dtype=np.float32).reshape(-1, width)
    weights, constant = fit(x, sample.column("y").to_numpy()) if len(posterior) > 1 and len(x) else (np.zeros(width), -5.0)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in free_names(docs.columns, 2)]])
    at = docs.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            bad, labels = [], []
            for part in in_chunks([len(t or "") + ROW_BYTES for t in texts]):
                measured = measures(texts[part])
                margin = features(texts[part], measured) @ weights + constant
                bad.append(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
                labels += [posterior.get(k) for k in patterns(measured).tolist()]
            done = np.concatenate(bad) if bad else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.float64()), pa.array(done, pa.float64())], names=schema.names)

    return docs.mapInArrow(score, schema)


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the scorer does not reject, with all their columns."""
    found = scored(docs, doc_id, text)
    return found.where(F.col(found.columns[-1]) < REJECT_AT).drop(*found.columns[-2:])


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scored(docs).toDF("doc_id", "text", "bad_posterior", "bad_score")
    return found.select("doc_id", "bad_posterior", "bad_score", (F.col("bad_score") < REJECT_AT).alias("kept"))
