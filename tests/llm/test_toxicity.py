import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strataspark.llm import toxicity, words

BAD = ["idiot", "moron", "scum", "trash", "loser", "clown"]


def corpus(seed, n):
    rng = random.Random(seed)
    plain = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"] + ["the", "of"]
    rows = []
    for i in range(n):
        w = rng.choices(plain, k=rng.randint(5, 200))
        bad = rng.random() < 0.15
        for _ in range(rng.randint(1, 8) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["", "("]) + rng.choice(BAD).title() + rng.choice(["", ",", "."]))
        rows.append((i, " ".join(w), int(bad)))
    return rows


def test_held_out_accuracy_and_order():
    rows = corpus(1, 1500)
    model = toxicity.OrdinalModel().fit([r[1] for r in rows[:900]], [r[2] for r in rows[:900]])
    assert (np.diff(model.theta) > 0).all()
    found = [model.severity(r[1])[1] >= toxicity.CUT for r in rows[900:]]
    truth = [bool(r[2]) for r in rows[900:]]
    assert np.mean([f for f, t in zip(found, truth, strict=True) if t]) > 0.9
    assert not any(f for f, t in zip(found, truth, strict=True) if not t)
    assert 0 <= model.severity("idiot")[0] < model.severity("idiot moron scum trash")[0] <= toxicity.GRADES - 1


def test_score_keeps_rows_and_columns(spark):
    rows = [*corpus(2, 400), (900, None, 0), (901, "", 0), (None, "idiot", 1)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, Toxic string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows[:300]] + [(5, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels))
    assert got.columns == ["doc_id", "text", "Toxic", "severity", "p_toxic", "toxic_"] and got.count() == len(rows)
    none = toxicity.score(docs, toxicity.fit(docs, labels.limit(0)))
    assert none.where("toxic_").count() == 0 and toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0


def plain_bag(text):
    """Words with A-Z lower-cased and outer non-letters stripped, one by one."""
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    stripped = (re.sub(rb"^[^a-z\x80-\xff]+|[^a-z\x80-\xff]+$", b"", w) for w in (text or "").encode().translate(low).split())
    return Counter(w for w in stripped if w)


def plain_fit(rows):
    """Chosen words with their z, by definition, and a plain gradient check of the likelihood at the fitted weights."""
    bad, clean, total = Counter(), Counter(), Counter(y for _, _, y in rows)
    for _, t, y in rows:
        (bad if y else clean).update(set(plain_bag(t)))
    z = {}
    for w in bad | clean:
        p = (bad[w] + clean[w]) / (total[0] + total[1])
        z[w] = (bad[w] / total[1] - clean[w] / total[0]) / math.sqrt(max(p * (1 - p), 1e-9) * (1 / total[1] + 1 / total[0]))
    return {w: v for w, v in z.items() if bad[w] + clean[w] >= 3 and abs(v) >= toxicity.MIN_Z}


def test_distributed_fit_equals_plain_one(spark):
    rows = [*corpus(7, 500), (600, "Idiot!! idiot É-moron 12", 1), (601, None, 0), (602, "  ", 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(600, "zzz later text")], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got, local = toxicity.fit(docs, labels), toxicity.OrdinalModel().fit([t for _, t, _ in rows], [y for *_, y in rows])
    want = plain_fit(rows)
    name = {int(words.word_hashes([w])[0][0]): w for w in want}
    assert len(want) > 5 and {name[k] for k in got.keys.tolist()} == set(want)
    assert got.keys.tolist() == local.keys.tolist() and got.weight == pytest.approx(local.weight, abs=1e-6) and got.theta == pytest.approx(local.theta, abs=1e-6)

    def loss(weight, theta):
        total = 0.0
        for _, t, y in rows:
            bag = plain_bag(t)
            s = (1 + 100 / (100 + sum(bag.values()))) * sum(weight[w] * math.log1p(n) for w, n in bag.items() if w in weight)
            tied = sum(want.get(w, 0) > 0 for w in bag)
            g = (1 + (tied >= 3) + (tied >= 6)) if y else 0
            cdf = [0.0, *(1 / (1 + math.exp(-(x - s))) for x in theta), 1.0]
            total -= math.log(max(cdf[g + 1] - cdf[g], 1e-12))
        return total / len(rows) + 0.5e-4 * sum(w * w for w in weight.values())

    weight = {name[k]: w for k, w in zip(got.keys.tolist(), got.weight.tolist(), strict=True)}
    at_fit = loss(weight, got.theta)
    rng = random.Random(1)
    for _ in range(5):  # no nearby weights are clearly better, none at all much worse
        assert loss({w: x + rng.gauss(0, 0.3) for w, x in weight.items()}, got.theta) > at_fit - 1e-4
    assert loss(dict.fromkeys(weight, 0.0), got.theta) > at_fit + 0.05
    for text in ("idiot", "(Idiot), moron & SCUM " * 3, "plain words", None, "", "trash " * 60_000):
        bag = plain_bag(text)
        s = (1 + 100 / (100 + sum(bag.values()))) * sum(weight[w] * math.log1p(n) for w, n in bag.items() if w in weight)
        above = [1 / (1 + math.exp(-(s - x))) for x in got.theta]
        assert got.severity(text) == pytest.approx((sum(above), above[0]))
