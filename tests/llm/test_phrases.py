import random
import re
from collections import Counter

import pytest

from strataspark.llm import phrases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, most, covered, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    longest = Counter()
    for (lang, *w), a in cands.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                p = (lang, *w[i : i + k])
                longest[p] = max(longest[p], a)
    out = []
    for (lang, *w), a in cands.items():
        if p_longer := longest[(lang, *w)]:
            if 100 * p_longer >= covered * a:
                continue
        s, _, left, right = min((1_000_000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        out.append((lang, -s, -a, " ".join(w).encode(), left, right))
    ranked, rank = [], Counter()
    for lang, s, a, p, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], p.decode(), -a, left, right, n[lang], -s))
    return ranked


def mined(df, least=10, most=3, covered=50, top=2000):
    got = phrases.collocations(*phrases.phrase_counts(df, least=least, most_words=most), covered=covered, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = ["new", "York", "CITY", "the", "of", "a", "b", "b", "é", "É", "x y", "z\0z", "don't", "e"]
    rows = []
    for _ in range(n):
        w = []
        for _ in range(rng.randint(0, 60)):
            w += rng.choice([["New", "york"], ["new", "YORK", "city"], [rng.choice(vocabulary)], [rng.choice(vocabulary)]])
        rows.append((rng.choice(["en", "de", None, "", "und"]), "".join(x + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", "?!"]) for x in w)))
    return rows + [("en", None), (None, ""), ("en", " \t.\n"), ("en", "a a a a a a a a a a a a"), ("fr", "only here"), *[("en", "new york city")] * 30]


@pytest.mark.parametrize(("least", "most", "covered", "top"), [(10, 3, 50, 2000), (3, 3, 50, 7), (2, 5, 90, 40), (4, 2, 50, 2000)])
def test_same_as_a_plain_count(spark, least, most, covered, top):
    rows = corpus(least, 150)
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, text string, Phrase string").repartition(6)
    assert mined(df, least, most, covered, top) == sorted(plain(rows, least, most, covered, top))


def test_slices_do_not_matter(spark, monkeypatch):
    rows = corpus(5, 120)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    want = mined(df)
    source = phrases.postings
    assert want == sorted(plain(rows, 10, 3, 50, 2000)) and source([b"a b a"])[1].tolist() == [2, 1]
    held = [list(phrases._by_language(iter(df.where("text is not null").toArrow().to_batches())))]
    monkeypatch.setattr(phrases, "SLICE_BYTES", 200)
    held.append(list(phrases._by_language(iter(df.where("text is not null").toArrow().to_batches()))))
    assert len(held[1]) > 3 * len(held[0]) and all(sum(map(len, t[:-1])) < 200 for _, t in held[1])
    assert sorted(t for _, ts in held[0] for t in ts) == sorted(t for _, ts in held[1] for t in ts)


def test_top_through_shares_and_edges(spark):
    words = [f"w{i}" for i in range(40)]
    text = " . ".join(f"{a} {b}" for a in words for b in words)
    df = spark.createDataFrame([("en", text)] * 2, "lang string, text string")
    assert mined(df, least=2, top=3) == sorted(plain([("en", text)] * 2, 2, 3, 50, 3))
    assert mined(df.limit(0)) == [] and mined(spark.createDataFrame([(None, None)], "lang string, text string")) == []
    long_text = "alpha beta " * 400_000
    got = mined(spark.createDataFrame([(None, long_text)], "lang string, text string"))
    assert got == sorted(plain([(None, long_text)], 10, 3, 50, 2000)) and got[0][0] == "und"


def test_products_beyond_64_bits(spark):
    big = 2 * 10**14 + 1
    counts = spark.createDataFrame([("en", 1, "a", big + 7), ("en", 1, "b", big + 9), ("en", 2, "a b", big)], "lang string, words int, phrase string, f long")
    got = phrases.collocations(counts, spark.createDataFrame([("en", 10**15)], "lang string, n long")).head()
    assert got.score == 1_000_000 * big * big // ((big + 7) * (big + 9))
