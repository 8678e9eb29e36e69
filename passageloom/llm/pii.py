"""Personal data: entities by pattern, and the words that reveal them, by information theory.

E-mail addresses, IP addresses, card and phone numbers are found in every text. Each different value is a protected
entity c. What the corpus tells about c when one knows a word t beside it is their pointwise mutual information
log(N n(c, t) / (n(c) n(t))), over documents; what there is to tell is the information log(N / n(c)) of c itself. A word
whose share of it reaches DISCLOSURE gives the entity away and is sanitised too, at each of its places beside c: it is
generalised to its class (number or word) if the class alone stays below the threshold, and removed otherwise.

Words count as beside an entity within CONTEXT_WORDS words, so pairs grow with the mentions and not with the texts. One
context says nothing, nor do its copies: a pair has to stand in two different ones. How many documents have a word is
counted over the whole corpus, for the words that such pairs ask for; they are sent to the tasks as a filter of fixed
size, and what passes it is counted exactly.

Every pattern is read in one forward pass, however long the text is.

Defined cases: null and empty texts have no spans; rows whose doc_id is null are documents like any other; equal rows are
documents each, with the same context; an entity in all documents protects nothing; an empty table gives no rows; extra
columns are kept by ``sanitise`` and ignored by ``find_personal_data``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passageloom.llm.byte_words import ALNUM, LOWER, hashes, word_bounds, word_chunks
from passageloom.llm.hash_filter import hash_filter, passes
from passageloom.llm.numbering import free_names
from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import stage

CONTEXT_WORDS = 6
#: Share of an entity's information that a word may tell.
DISCLOSURE = 0.8
#: Words that a task holds while it adds up their documents.
HELD_TERMS = 1 << 18

# The kinds in their order, and the patterns of the contract, cut so that each is read forwards once.
KINDS = ["email", "ip", "card", "phone", "generalise", "remove"]
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
NUMBERS_AND_DOTS = re.compile(r"(?<![0-9])(?<![0-9]\.)[0-9]++(?:\.[0-9]++){3,}+")
LONG_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){13,}+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """The sum of the digits, every second one from the right doubled (and its digits added), ends in 0."""
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    at = text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL_PART))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the entities, sorted."""
    text = text or ""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for chain in NUMBERS_AND_DOTS.finditer(text):
            at, parts = chain.start(), chain[0].split(".")
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    found.append((at, 1, end))
                at = end + 1
        for number in LONG_NUMBER.finditer(text):
            digits = re.sub("[ -]", "", number[0]) if number.end() - number.start() < 64 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((number.start(), 2, number.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(DIGIT.findall(m[0])) <= 15]
    return sorted(found)


def entity(text: str, span: tuple[int, int, int]) -> int:
    """A 64-bit name of the value: small letters, and digits only where a number may be written in several ways."""
    start, kind, end = span
    value = text[start:end].lower() if kind < 2 else "".join(DIGIT.findall(text[start:end]))
    return int(np.uint64(xxhash.xxh64_intdigest(f"{kind}:{value}".encode(), 1)).view(np.int64))


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """For each entity and each word beside it: their names, the places of the word, the least and the largest of its contexts."""
    bounds = np.array([x for m in WORD.finditer(text) for x in m.span()], dtype=np.int64).reshape(-1, 2)
    taken = np.zeros(len(bounds), dtype=bool)
    near: list[tuple[int, int, int]] = []
    for span in spans:
        before, behind = int(np.searchsorted(bounds[:, 1], span[0], side="right")), bisect_left(bounds[:, 0], span[2])
        taken[before:behind] = True
        near.append((entity(text, span), before, behind))

    def around(before: int, behind: int) -> list[int]:
        places = [*range(max(0, before - CONTEXT_WORDS), before), *range(behind, min(behind + CONTEXT_WORDS, len(bounds)))]
        return [i for i in places if not taken[i]]

    wanted = sorted({i for _, before, behind in near for i in around(before, behind)})
    words = [text[a:b].encode("utf-8", "surrogatepass").translate(LOWER) for a, b in bounds[wanted].tolist()] if wanted else []
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    starts, ends = word_bounds(data, ALNUM)
    name = dict(zip(wanted, hashes(data, starts, ends).view(np.int64).tolist() if words else []))
    is_number = {i: 0x30 <= w[0] <= 0x39 for i, w in zip(wanted, words)}
    pairs: dict[tuple[int, int], dict] = {}
    for who, before, behind in near:
        beside = around(before, behind)
        context = xxhash.xxh64_intdigest(np.array([name[i] for i in beside], dtype=np.int64).tobytes()) >> 1
        for i in beside:
            pair = pairs.setdefault((who, name[i]), {"entity": who, "term": name[i], "number": is_number[i], "context": context, "last": context, "places": {}})
            pair["context"], pair["last"] = min(pair["context"], context), max(pair["last"], context)
            pair["places"][i] = bounds[i].tolist()
    return [p | {"places": [{"start": a, "end": b} for a, b in p["places"].values()]} for p in pairs.values()]


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType())]))
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_PAIR = pa.list_(
    pa.struct(
        [("entity", pa.int64()), ("term", pa.int64()), ("number", pa.bool_()), ("context", pa.int64()), ("last", pa.int64())]
        + [("places", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
    )
)
PAIR = T.ArrayType(
    T.StructType(
        [T.StructField(n, T.BooleanType() if n == "number" else T.LongType()) for n in ("entity", "term", "number", "context", "last")]
        + [T.StructField("places", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))]
    )
)


def mentions(docs: DataFrame, text: str, keep_text: bool, base_name: str, pairs_name: str) -> DataFrame:
    """The other columns, with the base spans and the pairs of ``contexts``, and the text if asked for."""
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*kept, T.StructField(base_name, SPAN), T.StructField(pairs_name, PAIR)])
    at = docs.columns.index(text)
    own = [i for i, f in enumerate(docs.schema.fields) if keep_text or f.name != text]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                base, pairs = [], []
                for value in batch.column(at):
                    body = value.as_py() or ""
                    spans = base_spans(body)
                    base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                    pairs.append(contexts(body, spans) if spans else [])
                columns = [*[batch.column(i) for i in own], pa.array(base, _SPAN), pa.array(pairs, _PAIR)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(find, schema)


def documents_with(docs: DataFrame, text: str, terms: DataFrame) -> tuple[DataFrame, dict[bool, int]]:
    """Staged (term, n_t): the documents that have each term; and how many documents have a number and a word at all."""
    sent = docs.sparkSession.sparkContext.broadcast(hash_filter(terms, "term"))

    def counted(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        terms, place = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
        return terms, np.bincount(place, np.concatenate([n for _, n in held]), len(terms)).astype(np.int64)

    def rows(terms: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(sizes), pa.nulls(len(terms), pa.bool_())], names=["term", "n", "number"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counts of a task are added up before they leave it, as far as HELD_TERMS goes.
        held = [(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))]
        classes = np.zeros(2, dtype=np.int64)
        for batch in batches:
            for part, joined, starts, ends, of_text in word_chunks(batch.column(0).to_pylist(), ALNUM):
                if not len(starts):
                    continue
                data = np.frombuffer(joined, dtype=np.uint8)
                number = (data[starts] >= 0x30) & (data[starts] <= 0x39)
                for i, mask in enumerate((~number, number)):
                    classes[i] += len(np.unique(of_text[mask]))
                values = hashes(data, starts, ends)
                some = np.flatnonzero(passes(sent.value, values))
                order = np.lexsort((of_text[some], values[some]))
                value, text_no = values[some][order], of_text[some][order]
                fresh = np.ones(len(value), dtype=bool)
                fresh[1:] = (value[1:] != value[:-1]) | (text_no[1:] != text_no[:-1])
                held.append(np.unique(value[fresh], return_counts=True))
                if sum(len(t) for t, _ in held) > HELD_TERMS:
                    held = [counted(held)]
                    if 2 * len(held[0][0]) > HELD_TERMS:
                        yield rows(*held.pop())
        if held:
            yield rows(*counted(held))
        yield pa.RecordBatch.from_arrays([pa.nulls(2, pa.int64()), pa.array(classes), pa.array([False, True])], names=["term", "n", "number"])

    found = docs.select(text).mapInArrow(count, "term long, n long, number boolean")
    totals = stage(found.groupBy("term", "number").agg(F.sum("n").alias("n_t")), "pii-terms")
    classes = {row["number"]: row["n_t"] for row in totals.where("number IS NOT NULL").collect()}
    return totals.where("number IS NULL").select("term", "n_t"), classes


def told(n: int, n_ct: Column, n_c: Column, n_t: Column) -> Column:
    """The share of the information of c that t tells; null where c has none."""
    information = F.log(F.lit(float(n)) / n_c)
    return F.when(information > 0, F.log(n_ct * float(n) / (n_c * n_t)) / information)


def disclosing(found: DataFrame, docs: DataFrame, text: str, threshold: float = DISCLOSURE) -> DataFrame:
    """Staged (pair, kind): pairs of an entity and a word that gives it away, and what is to be done about the word."""
    total = found.count()
    pairs = found.select(F.explode("pairs").alias("p")).select("p.entity", "p.term", "p.number", "p.context", "p.last")
    beside = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_ct"), F.min("context").alias("a"), F.max("last").alias("b"), F.max("number").alias("number"))
    beside = stage(beside.where("a != b").drop("a", "b"), "pii-pairs")
    mentioned = stage(found.select(F.explode(F.array_distinct(F.transform("pairs", lambda p: p["entity"]))).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_c")), "pii-entities")
    # A word is in no fewer documents than those in which it is beside some entity: pairs that would not disclose even
    # then need no count over the corpus.
    seen = found.select(F.explode(F.array_distinct(F.transform("pairs", lambda p: p["term"]))).alias("term"))
    seen = stage(seen.groupBy("term").agg(F.count(F.lit(1)).alias("n_seen")), "pii-seen")
    beside = lookup_join(lookup_join(beside, mentioned, "entity"), seen, "term")
    beside = stage(beside.where(told(total, F.col("n_ct"), F.col("n_c"), F.col("n_seen")) >= threshold).drop("n_seen"), "pii-candidates")
    n_t, classes = documents_with(docs, text, beside.select("term").distinct())
    known = lookup_join(beside, n_t, "term")
    given = known.where(told(total, F.col("n_ct"), F.col("n_c"), F.col("n_t")) >= threshold)
    # What the class of a word tells: the documents in which the entity stands beside any word of the class.
    by_class = found.select(F.explode(F.array_distinct(F.transform("pairs", lambda p: F.struct(p["entity"].alias("entity"), p["number"].alias("number"))))).alias("p"))
    by_class = by_class.groupBy("p.entity", "p.number").agg(F.count(F.lit(1)).alias("n_cg"))
    by_class = stage(by_class.select(F.concat_ws(":", "entity", F.col("number").cast("string")).alias("class"), "n_cg"), "pii-classes")
    known = lookup_join(given.withColumn("class", F.concat_ws(":", "entity", F.col("number").cast("string"))), by_class, "class")
    n_g = F.when(F.col("number"), F.lit(classes.get(True, 0))).otherwise(F.lit(classes.get(False, 0)))
    general = told(total, F.col("n_cg"), F.col("n_c"), n_g) < threshold
    kind = F.when(general, F.lit(KINDS.index("generalise"))).otherwise(F.lit(KINDS.index("remove")))
    return stage(known.select(F.concat_ws(":", "entity", "term").alias("pair"), kind.cast("int").alias("kind")), "pii-disclosing")


def _with_spans(docs: DataFrame, text: str, keep_text: bool, threshold: float) -> tuple[DataFrame, str, str]:
    """A staged copy of the documents' columns with the sorted spans, and the names of the columns for base and all spans."""
    row, base, pairs, spans = free_names(docs.columns, 4)
    found = stage(mentions(docs.withColumn(row, F.monotonically_increasing_id()), text, keep_text, base, pairs), "pii-mentions")
    given = disclosing(found.select(F.col(pairs).alias("pairs")), docs, text, threshold)
    beside = found.select(F.col(row).alias("row"), F.explode(pairs).alias("p")).select("row", F.concat_ws(":", "p.entity", "p.term").alias("pair"), "p.places")
    hit = lookup_join(beside, given, "pair").select("row", "kind", F.explode("places").alias("p"))
    # A word beside two entities is removed if it has to be for one of them.
    hit = hit.groupBy("row", "p.start", "p.end").agg(F.max("kind").alias("kind"))
    more = hit.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias(spans))
    joined = lookup_join(found.drop(pairs), stage(more.withColumnRenamed("row", row), "pii-words"), row, "left")
    every = F.array_sort(F.concat(F.col(base), F.coalesce(F.col(spans), F.array().cast(SPAN))))
    return joined.withColumn(spans, every).drop(row), base, spans


def rendered(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = DISCLOSURE) -> DataFrame:
    """doc_id, base and spans (arrays of start, number of the kind, end) of every document."""
    rows, base, spans = _with_spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", False, threshold)
    return rows.select("doc_id", F.col(base).alias("base"), F.col(spans).alias("spans"))


def sanitise(docs: DataFrame, text: str = "text", threshold: float = DISCLOSURE) -> DataFrame:
    """All documents and columns; entities become the label of their kind, words that give them away their class or nothing."""
    rows, _, spans = _with_spans(docs, text, True, threshold)

    def clean(body: str | None, found: list[dict]) -> str | None:
        if body is None or not found:
            return body
        out, at = [], 0
        for span in found:
            start, kind, end = span["start"], KINDS[span["kind"]], span["end"]
            if start < at:  # inside an entity of another kind
                out, at = [*out, ""], max(at, end)
                continue
            word = "[NUMBER]" if body[start : start + 1].isdigit() else "[WORD]"
            out += [body[at:start], LABELS.get(kind, word if kind == "generalise" else "")]
            at = end
        return "".join(out) + body[at:]

    schema = T.StructType(docs.schema.fields)
    where, at, places = rows.columns.index(spans), rows.columns.index(text), [rows.columns.index(c) for c in docs.columns]

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [clean(b.as_py(), s.as_py()) for b, s in zip(batch.column(at), batch.column(where))]
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in places]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(rewrite, schema)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def n_of(kind: int) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind))

    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [n_of(i).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(rendered(F.col("base")), 256).alias("base_sha256"), rendered(F.col("spans")).alias("spans"))
