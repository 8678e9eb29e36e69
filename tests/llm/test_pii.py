"""Personal data against the patterns themselves, and disclosure against a plain count of all pairs."""

import hashlib
import math
import random
import re
import time
from collections import defaultdict

import pytest

from passageloom.llm.pii import CONTEXT_WORDS, DISCLOSURE, KINDS, base_spans, find_personal_data, luhn, op11_pii, sanitise

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digits(s):
    return re.sub("[^0-9]", "", s)


def plain_luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and plain_luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for alphabet in ("a@.1 ", "ab@.-_+%", "0123456789.- ", "+1 ().-23456789", "a1@.+-( é日\n", "4. -0"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
            assert base_spans(text) == plain_spans(text), text
    real = "mail a.b+c@x-y.example.com, 010.2.255.9 1.2.3.256 1.2.3.4.5.6.7.8 x 4111 1111 1111 1111 +1 (052) 555-0934 x@y @z.de"
    assert base_spans(real) == plain_spans(real) and len(base_spans(real)) == 6
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert base_spans(None) == base_spans("") == []


@pytest.mark.parametrize("piece", ["a", "1", "1.", "1 ", "@", "a@", "@a", "+", "+1", "+1 ", "(", "1-", ".", "a@b", "1.1.1.", "é", "a@b.c"])
def test_very_long_texts_take_one_pass(piece):
    start = time.time()
    base_spans(piece * (3_000_000 // len(piece)))
    assert time.time() - start < 8


def plain_disclosure(texts):
    """All spans of each text, pairs counted in plain dictionaries."""
    near, with_pair, contexts, n_c, n_t, with_class, n_g = [], defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for d, text in enumerate(texts):
        text = text or ""
        spans, words = plain_spans(text), [(m.start(), m.end(), m[0].translate(LOWER)) for m in WORDS.finditer(text)]
        inside = {i for i, (a, b, _) in enumerate(words) for s, _, e in spans if a < e and b > s}
        for _, _, w in words:
            n_t[w].add(d)
            n_g[w[0] in "0123456789"].add(d)
        for s, kind, e in spans:
            value = text[s:e].lower() if kind < 2 else digits(text[s:e])
            left = [i for i, (a, b, _) in enumerate(words) if b <= s][-CONTEXT_WORDS:]
            right = [i for i, (a, b, _) in enumerate(words) if a >= e][:CONTEXT_WORDS]
            around = [i for i in left + right if i not in inside]
            for i in around:
                w = words[i][2]
                pair = (kind, value), w
                n_c[pair[0]].add(d)
                with_pair[pair].add(d)
                contexts[pair].add(tuple(words[j][2] for j in around))
                with_class[pair[0], w[0] in "0123456789"].add(d)
                near.append((d, pair, words[i][:2]))
    n, out = len(texts), [set(plain_spans(t)) for t in texts]
    kinds = {}
    for d, (c, w), (a, b) in near:
        if len(contexts[c, w]) < 2 or len(n_c[c]) == n:
            continue
        information = math.log(n / len(n_c[c]))
        if math.log(n * len(with_pair[c, w]) / (len(n_c[c]) * len(n_t[w]))) / information >= DISCLOSURE - 1e-12:
            g = w[0] in "0123456789"
            kind = 4 if math.log(n * len(with_class[c, g]) / (len(n_c[c]) * len(n_g[g]))) / information < DISCLOSURE else 5
            kinds[d, a, b] = max(kind, kinds.get((d, a, b), 0))
    for (d, a, b), kind in kinds.items():
        out[d].add((a, kind, b))
    return [sorted(s) for s in out]


def some_texts(rng):
    filler = "river stone paper light green house music window garden street".split()
    people = [("Erika", "Mustermann", "e.muster@example.com", "4711"), ("Jan", "Novak", "+420 555 123 4567", "K0815"), ("Ann", "Lee", "10.0.0.7", "99x")]
    texts = []
    for i in range(200):
        words = rng.choices(filler, k=rng.randint(5, 60))
        if i % 7 == 0:
            first, last, mark, number = rng.choice(people)
            at = rng.randint(0, len(words))
            words[at:at] = rng.sample([first, last, mark, number], 4)
        if i % 31 == 0:
            words.insert(3, "x@y.org")
        texts.append(" ".join(words) + rng.choice([".", "", " é日"]))
    return texts + [None, "", texts[0], texts[0], texts[7] + " " + texts[14], "only@one.de beside unique words", "4111 1111 1111 1111"]


def test_disclosure_equals_plain_counts(spark):
    texts = some_texts(random.Random(2))
    rows = [(i if i % 50 else None, t, "x", 1, [1], "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string, pairs long, spans array<long>, _0 string").repartition(4)
    found = find_personal_data(docs).collect()
    got = sorted(((r.doc_id or -1, [(s.start, s.kind, s.end) for s in r.spans], [(s.start, s.kind, s.end) for s in r.base]) for r in found), key=str)
    expected = sorted(((r[0] or -1, spans, plain_spans(r[1])) for r, spans in zip(rows, plain_disclosure(texts))), key=str)
    assert got == expected
    assert {s[1] for _, spans, _ in expected for s in spans} >= {0, 1, 2, 3, 4}

    cleaned = {r.text for r in sanitise(docs).collect()}
    assert sanitise(docs).columns == docs.columns and len(cleaned) > 100 and None in cleaned
    assert not any(t and ("Mustermann" in t or "@example" in t or "555 123" in t) for t in cleaned)
    assert "[CARD]" in cleaned and any(t and "[EMAIL]" in t and "[WORD]" in t for t in cleaned)
    assert {t for t in texts if t and not plain_spans(t)} <= cleaned


def test_query_and_awkward_documents(spark, awkward, awkward_rows, nothing, tmp_path):
    awkward.write.parquet(str(tmp_path / "a" / "documents.parquet"))
    rows = op11_pii(spark, str(tmp_path / "a")).collect()
    assert len(rows) == len(awkward_rows) and {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert find_personal_data(nothing).count() == 0 and sanitise(nothing).count() == 0
    docs = [(1, "write to a@b.de or call +1 (052) 555-0934"), (2, "none")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "b" / "documents.parquet"))
    one = {r.doc_id: r for r in op11_pii(spark, str(tmp_path / "b")).collect()}
    assert one[1].spans == "email:9:15,phone:24:41" and (one[1].n_email, one[1].n_ip, one[1].n_card, one[1].n_phone) == (1, 0, 0, 1)
    assert one[1].base_sha256 == hashlib.sha256(one[1].spans.encode()).hexdigest() and one[2].spans == ""
    assert KINDS[:4] == ["email", "ip", "card", "phone"]


def test_very_long_text(spark):
    body = "river stone 10.0.0.1 " * 150_000
    (row,) = find_personal_data(spark.createDataFrame([(1, body)], "doc_id long, text string")).collect()
    assert len(row.base) == 150_000 and row.base == row.spans
