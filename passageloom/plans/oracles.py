"""The same jobs as ANSI SQL over the given tables."""

from __future__ import annotations

_SPLIT = r"regexp_split_to_array({text}, '[\t\n\v\f\r\p{{Zs}}]+')"

_DOCUMENTS = "docs AS (SELECT CAST(doc_id AS VARCHAR) AS passage_id, replace(text, ',', ' ') AS passage FROM documents)"
_BENCHMARK = "items AS (SELECT CAST(item_id AS VARCHAR) AS passage_id, replace(text, ',', ' ') AS passage FROM benchmark)"


def _words(name: str, source: str, lowercase: bool = True) -> str:
    text = "lower(passage)" if lowercase else "passage"
    pieces = f"SELECT passage_id, unnest({_SPLIT.format(text=text)}) AS word FROM {source}"
    return f"{name} AS (SELECT passage_id, word FROM ({pieces}) WHERE word <> '')"


_DOC_WORDS = f"{_DOCUMENTS}, {_words('doc_words', 'docs')}"
_DOC_WORDS_CASED = f"{_DOCUMENTS}, {_words('doc_words', 'docs', lowercase=False)}"
_ITEM_WORDS = f"{_BENCHMARK}, {_words('item_words', 'items')}"
_TF = "tf AS (SELECT passage_id, word, count(*) AS tf FROM doc_words GROUP BY passage_id, word)"
_LENGTHS = "lengths AS (SELECT passage_id, count(*) AS n_words FROM doc_words GROUP BY passage_id)"
_DF = "df AS (SELECT word, count(DISTINCT passage_id) AS df FROM doc_words GROUP BY word)"
_N = "total AS (SELECT count(*) AS n FROM docs)"
_IDF = "idf AS (SELECT word, log2(n / CAST(df AS DOUBLE)) AS idf FROM df, total)"
_LIST = "listed AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS word_idx FROM (SELECT DISTINCT word FROM item_words))"

_WEIGHTS = f"{_TF}, {_LENGTHS}, {_DF}, {_N}, {_IDF}"

_SPARSE = """SELECT passage_id, word, round(CAST(tf AS DOUBLE) / n_words * idf, 6) AS tfidf
FROM tf JOIN lengths USING (passage_id) JOIN idf USING (word)"""


def _dense(weight: str) -> str:
    return f"""hits AS (SELECT passage_id, word, {weight} AS w
FROM tf JOIN lengths USING (passage_id) JOIN idf USING (word))
SELECT docs.passage_id, list(round(coalesce(hits.w, 0.0), 6) ORDER BY listed.word_idx) AS vector
FROM docs CROSS JOIN listed LEFT JOIN hits ON hits.passage_id = docs.passage_id AND hits.word = listed.word
GROUP BY docs.passage_id"""


def _dense_rows() -> str:
    """dense: (passage_id, vector) of the documents over the list, by the product form."""
    return f"""hits AS (SELECT passage_id, word, CAST(tf AS DOUBLE) * idf / n_words AS w
FROM tf JOIN lengths USING (passage_id) JOIN idf USING (word)),
dense AS (SELECT docs.passage_id, list(round(coalesce(hits.w, 0.0), 6) ORDER BY listed.word_idx) AS vector
FROM docs CROSS JOIN listed LEFT JOIN hits ON hits.passage_id = docs.passage_id AND hits.word = listed.word
GROUP BY docs.passage_id)"""


_SHARE_FIRST = "CAST(tf AS DOUBLE) / n_words * idf"
_PRODUCT_FIRST = "CAST(tf AS DOUBLE) * idf / n_words"

_DENSE_SHARE = f"WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_WEIGHTS}, {_LIST}, {_dense(_SHARE_FIRST)}"
_DENSE_PRODUCT = f"WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_WEIGHTS}, {_LIST}, {_dense(_PRODUCT_FIRST)}"
_DENSE_CASED = f"WITH {_DOC_WORDS_CASED}, {_ITEM_WORDS}, {_WEIGHTS}, {_LIST}, {_dense(_SHARE_FIRST)}"

_IDF_FIXED = f"""WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_DF}, {_N}, {_IDF}
SELECT word, round(idf, 6) AS idf FROM idf WHERE word IN (SELECT word FROM item_words)"""

_VECTORS = "vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
_MEANS = """parts AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,
  unnest(generate_series(1, len(embedding))) AS i FROM embeddings),
averages AS (SELECT label, i, avg(x) AS x FROM parts GROUP BY label, i),
means AS (SELECT CAST(label AS BIGINT) AS id, list(x ORDER BY i) AS v FROM averages GROUP BY label)"""


def _best(queries: str, passages: str) -> str:
    return f"""{_VECTORS}, {_MEANS}, scores AS (
  SELECT q.id AS query_id, p.id AS passage_id, list_cosine_similarity(q.v, p.v) AS score, p.v AS v
  FROM {queries} q CROSS JOIN {passages} p),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, passage_id DESC) AS place FROM scores)"""


_BEST_FEW = f"WITH {_best('means', 'vectors')} SELECT query_id, passage_id, round(score, 6) AS score FROM best WHERE place = 1"

_REQUESTS = f"""WITH {_best('means', 'vectors')},
asked AS (SELECT CAST(conv_id AS VARCHAR) AS request FROM conversations UNION ALL SELECT role FROM conversations),
parsed AS (SELECT request, CASE WHEN regexp_matches(request, '^\\s*-?[0-9]+$') THEN TRY_CAST(request AS BIGINT) END AS query_id
  FROM asked)
SELECT request, parsed.query_id,
  CASE WHEN parsed.query_id IS NULL THEN 'invalid' WHEN best.query_id IS NULL THEN 'not_found' ELSE 'ok' END AS status,
  best.passage_id
FROM parsed LEFT JOIN best ON best.query_id = parsed.query_id AND best.place = 1"""

_VOCABULARY = f"WITH {_DOC_WORDS} SELECT DISTINCT word FROM doc_words"

_LINES = """lines AS (
  SELECT concat(conv_id, ',', turn, ':', length(text)) AS value FROM conversations
  UNION ALL SELECT concat(conv_id, role, ',', turn) FROM conversations
  UNION ALL SELECT concat(role, ',', turn) FROM conversations
  UNION ALL SELECT concat(conv_id, ',', text) FROM conversations)"""

_DENSE_ROWS = f"WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_WEIGHTS}, {_LIST}, {_dense_rows()}"
_DENSE_LINES = f"""{_DENSE_ROWS}
SELECT 0 AS place, 'passageId' AS passage_id, 'passageId,' || string_agg(word, ',' ORDER BY word_idx) AS header,
  CAST(NULL AS DOUBLE[]) AS vector FROM listed
UNION ALL SELECT row_number() OVER (ORDER BY passage_id), passage_id, NULL, vector FROM dense"""
_ONE_LINE = "replace(passage, chr(10), ' ')"

SQL: dict[str, str] = {
    "tfidf_sparse_beyond_a_broadcast": f"WITH {_DOC_WORDS}, {_WEIGHTS} {_SPARSE}",
    "tfidf_dense_ieee": f"""WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_WEIGHTS}, {_LIST}, hits AS (
  SELECT passage_id, word, {_PRODUCT_FIRST} AS w FROM tf JOIN lengths USING (passage_id) JOIN idf USING (word))
SELECT docs.passage_id,
  list(CASE WHEN df.word IS NULL THEN NULL ELSE round(coalesce(hits.w, 0.0), 6) END ORDER BY listed.word_idx) AS vector
FROM docs CROSS JOIN listed LEFT JOIN df ON df.word = listed.word
  LEFT JOIN hits ON hits.passage_id = docs.passage_id AND hits.word = listed.word
GROUP BY docs.passage_id""",
    "tfidf_dense_empty_nan": f"""{_DENSE_ROWS} SELECT passage_id, vector FROM dense UNION ALL
SELECT 'item' || passage_id, (SELECT list(CAST(NULL AS DOUBLE)) FROM listed) FROM items""",
    "passages_from_files_with_header": f"""WITH {_DOCUMENTS}
SELECT passage_id, {_ONE_LINE} || chr(65535) AS passage FROM docs UNION ALL SELECT '', ''""",
    "passages_from_folders": f"""WITH {_DOCUMENTS}, {_BENCHMARK}
SELECT passage_id, {_ONE_LINE} AS passage FROM docs UNION ALL
SELECT passage_id, {_ONE_LINE} FROM items WHERE passage_id NOT IN (SELECT passage_id FROM docs)""",
    "passage_shown": f"WITH {_DOCUMENTS} SELECT passage_id, {_ONE_LINE} AS passage FROM docs WHERE passage_id = '1'",
    "passage_shown_from_store": f"WITH {_DOCUMENTS} SELECT passage_id, {_ONE_LINE} AS passage FROM docs WHERE passage_id = '1'",
    "passage_lookup_from_store": f"""WITH {_DOCUMENTS}
SELECT passage_id, passage FROM docs WHERE passage_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""",
    "passage_text_column": f"WITH {_DOCUMENTS} SELECT passage FROM docs",
    "dense_csv_lines": _DENSE_LINES,
    "dense_csv_batches": _DENSE_LINES,
    "dense_csv_appended": f"{_DENSE_ROWS} SELECT passage_id, vector FROM dense UNION ALL SELECT passage_id, vector FROM dense",
    "dense_vector_lines": f"""{_DENSE_ROWS}
SELECT row_number() OVER (ORDER BY passage_id) - 1 AS place, passage_id, vector FROM dense""",
    "answer_lines": f"""WITH {_best('means', 'vectors')}
SELECT row_number() OVER (ORDER BY query_id) - 1 AS place, '(' || query_id || ', ' || passage_id || ')' AS line
FROM best WHERE place = 1""",
    "best_passage_row_many_queries": f"""WITH {_best('vectors', 'means')}
SELECT query_id, passage_id, list_transform(v, lambda x: round(x, 6)) AS embedding FROM best WHERE place = 1""",
    "best_passage_all_vectors": f"""WITH {_VECTORS}, {_MEANS}, moved AS (
  SELECT vectors.id, list_transform(list_zip(vectors.v, means.v), lambda p: p[1] + p[2]) AS v
  FROM vectors JOIN means ON means.id = vectors.label),
scores AS (SELECT q.id AS query_id, p.id AS passage_id, list_cosine_similarity(q.v, p.v) AS score FROM moved q CROSS JOIN vectors p),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, passage_id DESC) AS place FROM scores)
SELECT query_id, passage_id, round(score, 6) AS score FROM best WHERE place = 1""",
    "passage_stream_with_header": _DENSE_PRODUCT,
    "passage_words": f"""WITH {_DOCUMENTS}, lists AS (
  SELECT passage_id, list_filter({_SPLIT.format(text='lower(passage)')}, lambda w: w <> '') AS ws FROM docs)
SELECT passage_id, unnest(generate_series(0, len(ws) - 1)) AS position, unnest(ws) AS word FROM lists""",
    "term_count": f"WITH {_DOC_WORDS}, {_TF} SELECT passage_id, word, tf FROM tf",
    "term_count_cased": f"WITH {_DOC_WORDS_CASED}, {_TF} SELECT passage_id, word, tf FROM tf",
    "term_frequency": f"""WITH {_DOC_WORDS}, {_TF}, {_LENGTHS}
SELECT passage_id, word, round(CAST(tf AS DOUBLE) / n_words, 6) AS tf FROM tf JOIN lengths USING (passage_id)""",
    "passage_length": f"""WITH {_DOC_WORDS}, {_LENGTHS}
SELECT passage_id, coalesce(n_words, 0) AS n_words FROM docs LEFT JOIN lengths USING (passage_id)""",
    "distinct_passage_words": f"WITH {_DOC_WORDS} SELECT DISTINCT passage_id, word FROM doc_words",
    "vocabulary": _VOCABULARY,
    "vocabulary_union": f"""WITH {_DOC_WORDS}, {_ITEM_WORDS}
SELECT word FROM doc_words UNION SELECT word FROM item_words""",
    "vocabulary_indexed": f"WITH {_ITEM_WORDS}, {_LIST} SELECT word_idx, word FROM listed",
    "doc_count": "SELECT count(DISTINCT doc_id) AS n_passages FROM documents",
    "doc_frequency": f"WITH {_DOC_WORDS}, {_DF} SELECT word, df FROM df",
    "doc_frequency_fixed_vocab": f"""WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_DF}
SELECT DISTINCT item_words.word, coalesce(df, 0) AS df FROM item_words LEFT JOIN df ON df.word = item_words.word""",
    "df_merge": f"""WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_DF},
item_df AS (SELECT word, count(DISTINCT passage_id) AS df FROM item_words GROUP BY word)
SELECT word, CAST(sum(df) AS BIGINT) AS df FROM (SELECT * FROM df UNION ALL SELECT * FROM item_df) GROUP BY word""",
    "df_running": f"""WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_DF},
item_df AS (SELECT word, count(DISTINCT passage_id) AS df FROM item_words GROUP BY word)
SELECT word, CAST(sum(df) AS BIGINT) AS df FROM (SELECT * FROM df UNION ALL SELECT * FROM item_df) GROUP BY word""",
    "idf": f"WITH {_DOC_WORDS}, {_DF}, {_N}, {_IDF} SELECT word, round(idf, 6) AS idf FROM idf",
    "idf_fixed_vocab": _IDF_FIXED,
    "idf_fixed_vocab_ieee": f"""WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_DF}, {_N}, {_IDF}
SELECT DISTINCT item_words.word, round(idf, 6) AS idf, CASE WHEN idf IS NULL THEN 1 ELSE 0 END AS infinite
FROM item_words LEFT JOIN idf ON idf.word = item_words.word""",
    "tfidf_sparse": f"WITH {_DOC_WORDS}, {_WEIGHTS} {_SPARSE}",
    "tfidf_sparse_cased": f"WITH {_DOC_WORDS_CASED}, {_WEIGHTS} {_SPARSE}",
    "tfidf_missing_idf": f"""WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_DF}, {_N}, {_IDF},
counts AS (SELECT passage_id, word, count(*) AS tf FROM item_words GROUP BY passage_id, word),
sizes AS (SELECT passage_id, count(*) AS n_words FROM item_words GROUP BY passage_id)
SELECT passage_id, word, round(CAST(tf AS DOUBLE) / n_words * coalesce(idf, 1.0), 6) AS tfidf
FROM counts JOIN sizes USING (passage_id) LEFT JOIN idf USING (word)""",
    "tfidf_fixed_vocab": f"""WITH {_DOC_WORDS}, {_ITEM_WORDS}, {_WEIGHTS}
SELECT passage_id, word, round({_PRODUCT_FIRST}, 6) AS tfidf
FROM tf JOIN lengths USING (passage_id) JOIN idf USING (word) WHERE word IN (SELECT word FROM item_words)""",
    "tfidf_dense": _DENSE_PRODUCT,
    "tfidf_densified": _DENSE_SHARE,
    "vector_norm": f"""WITH {_VECTORS}
SELECT id AS vec_id, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS norm FROM vectors""",
    "cosine_pairs": f"""WITH {_VECTORS}, {_MEANS}
SELECT vectors.id AS vec_id, round(list_dot_product(vectors.v, means.v), 6) AS dot,
  round(list_cosine_similarity(vectors.v, means.v), 6) AS cosine, 0.0::DOUBLE AS cosine_with_empty
FROM vectors JOIN means ON means.id = vectors.label""",
    "similarity_rows": f"""WITH {_best('means', 'vectors')}
SELECT query_id, passage_id, round(score, 6) AS score FROM scores""",
    "similarity_rows_in_blocks": f"""WITH {_best('means', 'vectors')}
SELECT query_id, passage_id, round(score, 6) AS score FROM scores""",
    "best_passage": _BEST_FEW,
    "best_passage_many_queries": f"""WITH {_best('vectors', 'means')}
SELECT query_id, passage_id, round(score, 6) AS score FROM best WHERE place = 1""",
    "best_passage_row": f"""WITH {_best('means', 'vectors')}
SELECT query_id, passage_id, list_transform(v, lambda x: round(x, 6)) AS embedding FROM best WHERE place = 1""",
    "best_passage_requests": _REQUESTS,
    "passages_dedup": """SELECT passage_id, passage FROM (
  SELECT CAST(conv_id AS VARCHAR) AS passage_id, text AS passage,
    row_number() OVER (PARTITION BY conv_id ORDER BY role, turn DESC) AS place FROM conversations) WHERE place = 1""",
    "passage_lookup": f"""WITH {_DOCUMENTS}
SELECT passage_id, passage FROM docs WHERE passage_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""",
    "passages_from_files": f"WITH {_DOCUMENTS} SELECT passage_id, replace(passage, chr(10), ' ') AS passage FROM docs",
    "vocabulary_from_files": _VOCABULARY,
    "idf_from_files": _IDF_FIXED,
    "tfidf_first_generation": _DENSE_CASED,
    "tfidf_saved_idf": _DENSE_PRODUCT,
    "tfidf_one_shot": _DENSE_PRODUCT,
    "embedding_parse": f"""WITH {_LINES}, fields AS (SELECT value, string_split(value, ',') AS f FROM lines),
ids AS (SELECT value, f, TRY_CAST(regexp_extract(f[1], '^([0-9]+)', 1) AS BIGINT) AS line_id,
  CASE WHEN len(f) = 2 THEN list_transform(string_split(f[2], ':'), lambda x: TRY_CAST(x AS DOUBLE)) END AS numbers FROM fields),
checked AS (SELECT *, CASE WHEN len(f) <> 2 THEN 'invalid line: ' || value WHEN line_id IS NULL THEN 'invalid id: ' || value
  WHEN list_count(numbers) < len(numbers) THEN 'invalid number: ' || value END AS error FROM ids)
SELECT value, CASE WHEN error IS NULL THEN line_id END AS id, CASE WHEN error IS NULL THEN numbers END AS embedding, error
FROM checked""",
    "embeddings_from_files": f"WITH {_VECTORS} SELECT id, v AS embedding FROM vectors",
    "best_passage_from_files": _BEST_FEW,
    "request_stream": _REQUESTS,
    "passage_stream": _DENSE_PRODUCT,
}
