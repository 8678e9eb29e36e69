"""Licenses, toxicity, quality, page text, and the pipeline."""

import os
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from passageloom.llm import queries, toxicity
from passageloom.llm.exact_dedup import drop_exact_copies
from passageloom.llm.extraction import OPEN_SHARE, OPEN_TEXTS, RUN_TOKENS, blocks_of, extract_text, suffix_array, suffix_runs, texts_by_run
from passageloom.llm.license_texts import WHOLE_TEXTS
from passageloom.llm.licenses import BASE_PHRASES, scan_licenses
from passageloom.llm.quality import HEURISTICS, label_model, patterns, scored, votes
from tests.llm.test_copies import LOWER, brute_hits, plain_fingerprint, union_find
from tests.oracle_check import compare, connect

SMALL = "/root/testdata/sf0.001"
given_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not there")


def base_of(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for phrase, label in BASE_PHRASES for i in range(len(found)) if found[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(found), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_licenses(spark, awkward, awkward_rows, nothing):
    texts = [
        "Released under the MIT License. cc by nc cc by nc; CC-BY-NC!",
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "redistribution AND use in source and (some) binary forms with or without any modification are permitted provided the following conditions are met",
        "under the mit licensee, apache license version 3, cc by nd",
        "under the mit " * 3 + "license",
    ]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(0, texts[0], "x", "y")]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, w string, label string")).collect()
    labels = {r.doc_id: r.labels for r in got}
    assert len(got) == len(rows)
    assert labels == {0: "cc-by-nc,mit", 1: "apache-2", 2: "gpl-3", 3: "bsd", 4: "", 5: "mit"}
    got += scan_licenses(awkward).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter((d[0], *base_of(d[1])) for d in [*rows, *awkward_rows])
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in got)
    assert scan_licenses(nothing).count() == 0


def test_whole_licenses_and_partial_copies(spark):
    """Texts of far more runs than a bitmap holds, counted by distinct runs; related wordings; words left out."""
    whole = dict((label, text) for text, label in WHOLE_TEXTS)
    texts = {i: f"opening words of a file {text} and the code after it" for i, text in enumerate(whole.values())}
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {i: r.labels for i, r in got.items()} == dict(enumerate(whole)) and {r.score for r in got.values()} == {1.0}
    headless = " ".join(whole["mit"].split()[40:])
    parts = [
        (0, headless), (1, " ".join(headless.split()[:20])), (2, headless.replace("AUTHORS OR", "WRITERS AND")),
        (3, f"{headless} some words between {whole['zlib']}"),
    ]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(parts, "doc_id long, text string")).collect()}
    assert {i: r.labels for i, r in got.items()} == {0: "mit", 1: "", 2: "mit", 3: "mit,zlib"}
    assert 0.6 <= got[2].score < got[0].score < 1.0 == got[3].score


def test_coverage_of_a_long_template_is_that_of_brute_force(spark):
    """A template of 298 runs: its share in a text against runs counted one by one."""
    words = [f"w{i}" for i in range(300)]
    rng = random.Random(11)

    def runs(found):
        return {tuple(found[i : i + 3]) for i in range(len(found) - 2)}

    cut = [words[:n] for n in (300, 250, 190, 181, 180, 170, 64, 32)]
    cut += [words[:100] + words[102:260], words[:60] + ["new"] + words[60:240], [w for w in words if rng.random() > 0.01][:260]]
    rows = [(i, " ".join(["before"] * i + found + ["after"])) for i, found in enumerate(cut)]
    got = {r.doc_id: r.score for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), notices=[(" ".join(words), "long")]).collect()}
    share = [len(runs(found) & runs(words)) / 298 for found in cut]
    assert got == {i: pytest.approx(s if s >= 0.6 else 0.0) for i, s in enumerate(share)}


def test_folding_and_exceptions():
    automaton = toxicity._automaton({toxicity.folded(w).strip(): 3.0 for w in toxicity.INSULTS})
    clean = toxicity.measures("the river and the paper house", automaton)
    for text in ("you IDIOT", "you 1d10t!", "you іdіоt", "you ｉｄｉｏｔ", "you ídíôt", "that $cum", "shut up, shut up"):
        assert toxicity.measures(text, automaton)[0] > clean[0] == 0.0, text
    for text in ("put it in the trash can", "a clown fish", "unidiotic paper", "", None):
        assert toxicity.measures(text, automaton)[0] == 0.0, text
    assert toxicity.measures("trash can, you trash", automaton)[0] > 0


def test_toxicity_scores(spark, awkward, awkward_rows, nothing):
    vocabulary = "river stone paper light green house music window garden table".split()
    rng = np.random.default_rng(0)
    docs, labels = [], []
    for i in range(400):
        toxic = int(i % 5 == 0)
        body = list(rng.choice(vocabulary, 30)) + ["grumbleface", "snarkwart"] * toxic
        docs.append((i, " ".join(rng.permutation(body)), "x"))
        labels.append((i, 1, toxic))
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic string")
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxicity.score_toxicity(frame, known).collect()}
    assert all((rows[i].score >= toxicity.THRESHOLD) == bool(t) for i, _, t in labels)
    assert 0 < sum(r.held_out for r in rows.values()) < 200
    # Labels of held-out rows change nothing.
    turned = known.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score_toxicity(frame, turned).collect()}
    assert all(abs(again[i] - rows[i].score) < 1e-9 for i in again)
    odd = toxicity.score_toxicity(awkward, known.limit(0)).collect()
    assert Counter(r.doc_id for r in odd) == Counter(d[0] for d in awkward_rows) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score_toxicity(nothing, known).count() == 0


def test_label_model_weighs_the_heuristics():
    rng = np.random.default_rng(1)
    bad = rng.random(5000) < 0.2
    n = len(HEURISTICS)
    given = np.full((5000, n), 2)
    for j in range(n):
        says_bad = rng.random(5000) < np.where(bad, 0.2 if j == 2 else 0.5, 0.02 if j == 2 else 0.002)
        says_good = (rng.random(5000) < np.where(bad, 0.2, 0.8)) & (j >= n - 3)
        given[:, j] = np.where(says_bad, 0, np.where(says_good, 1, 2))
    keys, counts = np.unique(given @ 3 ** np.arange(n), return_counts=True)
    posterior, accuracy = label_model(dict(zip(keys.tolist(), counts.tolist())))
    found = np.array([posterior[k] > 0.5 for k in (given @ 3 ** np.arange(n)).tolist()])
    assert (found == bad).mean() > 0.97 and accuracy[0, 2] < accuracy[0, 0] and (accuracy[1, -3:] < accuracy[0, -3:]).all()
    assert label_model({})[0] == {}
    assert votes(np.full((1, n), np.nan)).tolist() == [[2] * n] and patterns(np.full((1, n), np.nan)) == [3**n - 1]


def test_quality_of_awkward_rows(awkward, awkward_rows, nothing):
    rows = scored(awkward).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in awkward_rows)
    assert all(0 <= r[-1] <= 1 for r in rows)
    assert scored(nothing).count() == 0


@given_tables
def test_quality_against_labels(spark):
    rows = queries.QUERIES["op7_quality_classifier"](spark, "/root/testdata/sf0.01")
    judged = rows.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").groupBy("quality", "kept").count().collect()
    count = {(r["quality"], r["kept"]): r["count"] for r in judged}
    assert count.get((1, False), 0) <= 0.02 * count[1, True] and count.get((0, True), 0) <= 0.1 * count[0, False]


def test_blocks():
    page = "<!DOCTYPE html><title>t</title><nav><a>menu</a></nav><article><header><h1>Head &amp; line</h1></header><p>one <b>two<br>three<p>four</p><aside>no</aside><form>no</form><div class='user comments'>no</div><script>'</p>'</script><ul><li>a<li>b</ul></article><footer>no"
    assert blocks_of(page) == (["Head & line", "one two three", "four", "a", "b"], True)
    assert blocks_of("<body><div id=sidebar>x</div><div>Hello</div><p hidden>x</p>text &lt; &#233; <") == (["Hello", "text < é <"], False)
    assert blocks_of("<nav>open <article>in</article>") == (["in"], True)
    assert blocks_of("<body class='nav-open'><div class='with-sidebar'><div class='wrap has-comments'><p>kept</p></div></div>") == (["kept"], False)
    assert blocks_of("<article class='post comments-open'><p>kept<article class='comment'>no</article></article>") == (["kept"], True)
    assert blocks_of("<div class='page-header'>no</div><article><div class='entry-header'><h1>kept</h1></div></article>") == (["kept"], True)
    assert blocks_of(None) == blocks_of("") == blocks_of("<p> </p>") == ([], False)
    assert blocks_of("<article>cut off <b>here") == (["cut off here"], True)
    assert blocks_of("<p>a<!-- <p>no --><p>b<!-- open <p>no") == (["a", "b"], False)


def test_suffix_runs_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        streams = [[[str(t) for t in rng.integers(0, 3, rng.integers(1, 14))] for _ in range(rng.integers(0, 4))] for _ in range(6)]
        run = int(rng.integers(2, 6))
        texts_of, expected = {}, []
        for text, blocks in enumerate(streams):
            for no, block in enumerate(blocks):
                for i in range(max(1, len(block) - run + 1)):
                    texts_of.setdefault(tuple(block[i : i + run]), set()).add(text)
                    expected.append((text, no, i, tuple(block[i : i + run])))
        text, block, place, runs = suffix_runs(streams, run)
        named = {}
        got = list(zip(text.tolist(), block.tolist(), place.tolist(), runs.tolist()))
        assert [g[:3] for g in got] == [e[:3] for e in expected]
        for g, e in zip(got, expected):
            assert named.setdefault(g[3], e[3]) == e[3]
        assert len(named) == len(texts_of)
        one, counts = texts_by_run(text, runs)
        assert {expected[i][3]: n for i, n in zip(one.tolist(), counts.tolist())} == {r: len(t) for r, t in texts_of.items()}


def plain_extraction(pages):
    """(url, html) to text: all runs of all different texts of a host in one dictionary."""
    hosts = {}
    for url, html in pages:
        blocks, article = blocks_of(html)
        if not article and blocks:
            hosts.setdefault(url.split("/")[2], set()).add(tuple(blocks))
    runs = {}
    for host, texts in hosts.items():
        found = runs.setdefault(host, {})
        for text in texts:
            for b in text:
                words = b.split(" ")
                for i in range(max(1, len(words) - RUN_TOKENS + 1)):
                    found.setdefault(tuple(words[i : i + RUN_TOKENS]), set()).add(text)
    out = []
    for url, html in pages:
        blocks, article = blocks_of(html)
        host, kept = url.split("/")[2], []
        for b in blocks:
            words, covered = b.split(" "), set()
            for i in range(max(1, len(words) - RUN_TOKENS + 1)):
                if not article and len(runs[host][tuple(words[i : i + RUN_TOKENS])]) >= max(OPEN_TEXTS, OPEN_SHARE * len(hosts[host])):
                    covered |= set(range(i, min(len(words), i + RUN_TOKENS)))
            if len(covered) < len(words):
                kept.append(b)
        out.append((url, "\n\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize(("bin_bytes", "tasks"), [(1 << 22, 1), (700, 5), (60, 3)])
def test_what_a_host_repeats(spark, bin_bytes, tasks):
    rng = random.Random(4)
    line = "sign up today for our weekly letter and many more offers"
    clause = "as the ministry said on Tuesday in a short note"

    def story(i):
        return f"Story {i}: " + " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(20)) + "."

    pages = []
    for i in range(40):
        body = [line, "Home", story(i), f"{story(i)} {clause} {story(i)}" if i % 4 == 0 else story(i)]
        pages.append((f"http://open.org/{i}", "".join(f"<p>{b}</p>" for b in body)))
    # Copies of whole pages and mirrored articles stay, inside an article element or not.
    pages += [("http://mirror.org/a", f"<article><p>{line}</p><p>{story(99)}</p></article>")] * 12
    pages += [(f"http://mirror.org/{i}", f"<article><p>{story(i)}</p></article>") for i in range(5)]
    pages += [("http://two.org/a", f"<p>{line}</p><p>{story(1)}</p>")] * 2 + [(f"http://two.org/{i}", f"<p>{story(i)}</p>") for i in range(3)]
    pages += [("http://copy.org/", f"<div>{story(7)}</div><div>{line}</div>")] * 12
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(tasks)
    got = Counter((r.url, r.text) for r in extract_text(frame, bin_bytes).collect())
    assert got == plain_extraction(pages)
    texts = {url: text for url, text in got}
    assert line not in texts["http://open.org/3"] and clause in texts["http://open.org/4"]
    assert all(line in texts[u] and "Story" in texts[u] for u in ("http://mirror.org/a", "http://two.org/a", "http://copy.org/"))


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(3)
    for n in range(80):
        tokens = [*rng.integers(0, 1 + n % 4, n).tolist(), 9]
        assert suffix_array(np.array(tokens)).tolist() == sorted(range(n + 1), key=lambda i: tokens[i:])
    # Equal far beyond a run: the array has the full order.
    long = [*[0, 1] * 3000, *[0, 1] * 2000, 2]
    order = suffix_array(np.array(long)).tolist()
    assert all(long[a:] < long[b:] for a, b in zip(order[::97], order[1::97]))


@pytest.mark.parametrize(("bin_bytes", "tasks"), [(1 << 22, 2), (20_000, 5), (60, 3)])
def test_pages_with_an_article_pass_the_suffix_array(spark, bin_bytes, tasks):
    rng = random.Random(5)
    words = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(n))
    lines = [words(n) for n in (1, 3, 8, 9, 30)]
    pages = []
    for i in range(500):
        # Shares about OPEN_SHARE, where bins disagree; more of the host's pages have an article than not.
        body = [line for j, line in enumerate(lines) if rng.random() < 0.18 + 0.02 * j] + [words(rng.randint(1, 20)), f"{words(2)} {lines[4]} {words(2)}"]
        element = "article" if i % 3 else "div"
        pages.append((f"http://mixed.org/{i}", f"<{element}>{''.join(f'<p>{b}</p>' for b in body)}</{element}>"))
    pages += pages[:60] + [(f"http://few.org/{i}", f"<article><p>{lines[3]}</p><p>{words(9)}</p></article>") for i in range(2)]
    texts, standing = {}, {}
    for url, html in pages:
        blocks, article = blocks_of(html)
        texts.setdefault((url.split("/")[2], article), set()).add(tuple(blocks))
    runs_of = lambda b: [(i, tuple(b.split(" ")[i : i + RUN_TOKENS])) for i in range(max(1, len(b.split(" ")) - RUN_TOKENS + 1))]
    for group, found in texts.items():
        standing[group] = Counter(run for blocks in found for run in {run for b in blocks for _, run in runs_of(b)})
    expected = Counter()
    for url, html in pages:
        blocks, article = blocks_of(html)
        group, kept = (url.split("/")[2], article), []
        for b in blocks:
            least = max(OPEN_TEXTS, OPEN_SHARE * len(texts[group]))
            covered = {j for i, run in runs_of(b) if standing[group][run] >= least for j in range(i, i + len(run))}
            kept.append(len(covered) < len(b.split(" ")))
        expected[url, "\n\n".join(b for b, keep in zip(blocks, kept) if article or keep), kept.count(False)] += 1
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(tasks)
    got = Counter((r.url, r.text, r.n_repeated) for r in extract_text(frame, bin_bytes).collect())
    assert got == expected
    assert sum(n for (url, text, repeated), n in got.items() if repeated and lines[4] + "\n" in text) > 50


def test_very_long_html_takes_one_pass():
    for piece in ("<a b='", '<a b="', "<", "<a ", "<a b=\"'>", "<!--", "<b>", "</i><b>", "<p>", "<script>", "&", "<a href='x\"> ", "<div class='", "a=", "<a " + " " * 50):
        start = time.time()
        blocks_of(piece * (300_000 // len(piece)))
        assert time.time() - start < 3, piece
    assert blocks_of("<article><p>one</p><a href='never closed>two</a><p>three</p></article>") == (["one", "two", "three"], True)
    assert blocks_of("<article><a title='a > b'>kept</a> <a title=it's>too</a></article>") == (["kept too"], True)


def test_extraction(spark):
    page = "<article><p>{}</p></article>"
    rows = [(i, f"https://Host{i % 3}.org/a?{i}", page.format(f"text {i}"), "x", 1) for i in range(30)]
    rows += [(100, None, page.format("no url"), None, 1), (101, "not a url", None, "", 1), (None, "http://host1.org", "", "", 1), (102, "http://h/", page.format("w " * 100_000), "", 1), rows[4], rows[4]]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, blocks string, key long")
    got = Counter((r.page_id, r.url, r.text) for r in extract_text(frame, bin_bytes=100).collect())
    assert got == Counter((r[0], r[1], " ".join(re.sub("<[^>]*>", "", r[2] or "").split())) for r in rows)
    assert extract_text(frame.limit(0)).count() == 0


@given_tables
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    assert compare(spark, connect(SMALL), SMALL, name) is None


@given_tables
def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, SMALL)
    assert good.columns == docs.columns
    good = good.collect()
    first = {}
    for r in sorted(good, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r)
    single = list(first.values())
    prints = [plain_fingerprint(r.text) for r in single]
    root = union_find(len(single), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    apart = {}
    for r, group in zip(single, root):
        apart[group] = min(apart.get(group, r), r, key=lambda r: r.doc_id)
    clean = {r.doc_id for r in apart.values() for n, hit, _ in [brute_hits(r.text, items)] if not (hit and 20 * len(hit) >= n)}
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in packed} == clean
    assert all(r.offset + r.length <= 4096 for r in packed)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    assert drop_exact_copies(docs).count() <= docs.count()


def test_exception_phrases_against_brute_force():
    automaton = toxicity._automaton({"clown": 2.0, "uglo": 1.0, "fi": 0.5})
    rng = random.Random(9)
    for _ in range(300):
        text = " ".join(rng.choice(["clown", "fish", "class", "ugly", "duckling", "river"]) for _ in range(rng.randint(0, 12)))
        body = toxicity.folded(text)
        best, free = {}, []
        for end, (size, weight) in automaton.iter(body):
            start = end - size + 1
            if weight < 0:
                free.append((start, end))
            else:
                best[start] = max(weight, best.get(start, 0.0))
        kept = sum(w for at, w in best.items() if not any(a <= at <= b for a, b in free))
        assert abs(np.expm1(toxicity.measures(text, automaton)[0]) - kept) < 1e-9
    start = time.time()
    toxicity.measures("class clown fish " * 60_000, automaton)
    assert time.time() - start < 6
