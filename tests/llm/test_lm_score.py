import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strataspark.llm import lm_score, words


def plain_log_p(net, context, token):
    """One window, by definition: softmax over groups, then inside the group."""
    h = [math.tanh(float(net.bias[i]) + sum(float(net.embed[p][t][i]) for p, t in enumerate(context))) for i in range(len(net.bias))]

    def softmax(rows, bias):
        x = [sum(a * float(b) for a, b in zip(h, r, strict=True)) + float(c) for r, c in zip(rows, bias, strict=True)]
        return [v - math.log(sum(map(math.exp, x))) for v in x]

    g = token // net.group
    lo, hi = g * net.group, min((g + 1) * net.group, len(net.token_bias))
    return softmax(net.to_group.T, net.group_bias)[g] + softmax(net.to_token[lo:hi], net.token_bias[lo:hi])[token - lo]


def small(seed=1, v=23):
    rng = np.random.default_rng(seed)
    net = lm_score.Network(rng.integers(0, 50, v), hidden=4, reach=2, group=5)
    return net, rng.integers(0, v, (4, 40)), rng.integers(0, v, 40)


def test_probabilities_are_those_of_a_plain_loop_and_sum_to_one():
    net, context, token = small()
    got = net.log_p(context, token)
    assert got == pytest.approx([plain_log_p(net, context[:, k], t) for k, t in enumerate(token.tolist())], abs=1e-4)
    every = np.arange(23)
    assert np.exp(net.log_p(np.repeat(context[:, :1], 23, 1), every)).sum() == pytest.approx(1, abs=1e-5)


def test_gradients_are_those_of_finite_differences():
    net, context, token = small()
    for k in ("embed", "bias", "to_group", "group_bias", "to_token", "token_bias"):
        setattr(net, k, getattr(net, k).astype(np.float64))
    loss, g = net.gradients(context, token)
    assert loss == pytest.approx(-net.log_p(context, token).mean())
    embed = np.zeros_like(net.embed)
    for place in range(4):
        np.add.at(embed[place], context[place], g["embed"])
    for name, grad in (g | {"embed": embed}).items():
        x = getattr(net, name)
        for at in list(np.ndindex(x.shape))[:: max(1, x.size // 12)]:
            x[at] += 1e-5
            up = net.gradients(context, token)[0]
            x[at] -= 2e-5
            down = net.gradients(context, token)[0]
            x[at] += 1e-5
            assert grad[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_training_beats_frequencies_on_held_out_windows():
    rng = np.random.default_rng(2)
    chain = rng.permutation(60)
    start = rng.integers(0, 60, 6_000)
    windows = np.stack([start := chain[start] if k else start for k in range(5)], axis=1)
    windows = np.where(rng.random(windows.shape) < 0.1, rng.integers(0, 60, windows.shape), windows)
    counts = np.bincount(windows[:5_000, 2], minlength=60)
    held = windows[5_000:]
    context, token = np.delete(held.T, 2, axis=0), held[:, 2]
    before = lm_score.Network(counts, group=8).log_p(context, token).mean()
    after = lm_score.Network(counts, group=8).train(windows[:5_000], epochs=6).log_p(context, token).mean()
    assert after > before + 1.0
    again = lm_score.Network(counts, group=8).train(windows[:5_000], epochs=6).log_p(context, token).mean()
    assert after == again


def plain_scores(rows, model, part):
    """Log-likelihood of each text, word by word, from the model's weights and counts made anew."""
    (known, rank), net = model.lookup, model.network
    n, pairs, of_token, token = Counter(), Counter(), Counter(), {}
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    split = [(t or "").encode().translate(low).split() for t in rows]
    for w in split:
        n.update(w)
        pairs.update(zip(w, w[1:], strict=False))
    place = dict(zip(known.tolist(), rank.tolist(), strict=True))
    for w in n:
        letters = sum(not (c >= 128 or 97 <= c | 32 <= 122) for c in w) > 1
        token[w] = place.get(int(words.word_hashes([w])[0][0]), 2 * min(len(w), lm_score.SHAPES // 2) - 1 + letters)
        of_token[token[w]] += n[w]
    rare = lambda t: t <= lm_score.SHAPES or t > lm_score.SHAPES + model.frequent
    out = []
    for w in split:
        total, t = 0.0, [0, 0, *(token[x] for x in w), 0, 0]
        for k, x in enumerate(w):
            p = math.exp(plain_log_p(net, [t[k], t[k + 1], t[k + 3], t[k + 4]], t[k + 2]))
            if t[k + 2] <= lm_score.SHAPES:
                p *= max(n[x] - 1, 0.5) / of_token[t[k + 2]]
            top, bottom = 0.0, 0.0
            for near, pair in ((w[k - 1] if k else None, (w[k - 1], x)), (w[k + 1] if k + 1 < len(w) else None, (x, w[k + 1] if k + 1 < len(w) else None))):
                if near is not None and rare(token[near]):
                    top, bottom = top + pairs[pair] - 1, bottom + n[near] - 1
            least = lm_score.PARTS[part]
            e = least + (1 - least) * lm_score.SMOOTH / (bottom + lm_score.SMOOTH)
            total += math.log(e * p + (1 - e) * top / bottom if bottom else p)
        out.append((len(w), total))
    return out


def corpus():
    rng = random.Random(4)
    common = [f"k{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    rows = [" ".join(common * 4) for _ in range(3)]
    rare = ["planet", "garden", "Window", "silver", "x-1.2", "é"]
    for _ in range(50):
        rows.append(" ".join(x for _ in range(6) for x in (rng.choice(common), *rare[: rng.randint(1, 6)])))
    return rows + ["planet garden window silver", "qqxzjv wwkrpt zzvbnm xxlkjh", "planet", None, " \n", ""]


#: So few tokens that all three kinds of words occur: commonest, in the vocabulary, in shape classes only.
NARROW = {"vocabulary": 1 + lm_score.SHAPES + 62, "frequent": 40}


def test_scores_equal_a_plain_loop(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(rows)] + [(None, rows[0], 1)], "doc_id long, text string, N_words int").repartition(3)
    model = lm_score.fit(docs, **NARROW)
    got = {r.doc_id: r for r in lm_score.score(docs, model).collect()}
    assert len(got) == len(rows) + 1
    tried = [plain_scores([*rows, rows[0]], model, part) for part in range(len(lm_score.PARTS))]
    whole = [sum(total for _, total in scores) for scores in tried]
    assert whole[model.part] == pytest.approx(max(whole), rel=1e-4)
    want = tried[model.part]
    for i, (n, total) in enumerate(want[:-1]):
        assert got[i].n_words == n and got[i].log_likelihood == pytest.approx(total, abs=2e-3 * max(1, n))
        assert got[i].mean_log_likelihood == (pytest.approx(total / n, abs=2e-3) if n else None)
    assert got[None].log_likelihood == pytest.approx(got[0].log_likelihood) and got[53].mean_log_likelihood > got[54].mean_log_likelihood + 1
    again = {r.doc_id: r.log_likelihood for r in lm_score.score(docs.select("*"), model).collect()}
    assert all(again[i] == pytest.approx(got[i].log_likelihood, abs=1e-6) for i in again) and len(again) == len(got)
    rerun = lm_score.fit(docs.repartition(2), **NARROW)
    assert np.array_equal(rerun.network.embed, model.network.embed) and np.array_equal(rerun.n_token, model.n_token)


def test_counts_grow_with_the_corpus_and_tell_repeats_apart(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = [" ".join(word() for _ in range(60)) for _ in range(80)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:10]])], "doc_id long, text string")
    got = {r.doc_id: r.mean_log_likelihood for r in lm_score.score(docs, lm_score.fit(docs)).collect()}
    assert min(got[i] for i in range(10)) > max(got[i] for i in range(10, 80)) + 1
    swapped = spark.createDataFrame([(0, " ".join("".join(rng.sample(w, 6)) for w in texts[0].split()))], "doc_id long, text string")
    assert lm_score.score(swapped, lm_score.fit(docs)).head().mean_log_likelihood < got[0] - 1  # same shapes, other words


def test_the_networks_part_does_not_shrink_with_the_corpus(spark):
    """Its least weight in a word's probability, on a corpus and on ten times it, whose words come from one source."""
    rng = random.Random(12)
    names = [f"{a}{b}{c}" for a in "abcdefgh" for b in "klmnop" for c in "uvwx"]
    follows = {x: rng.sample(names, 4) for x in names}

    def chain(n):
        out = [rng.choice(names)]
        while len(out) < n:
            out.append(rng.choice(follows[out[-1]]))
        return " ".join(out)

    texts = [chain(40) for _ in range(2_000)]
    found = []
    for some in (texts[:200], texts):
        docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
        model = lm_score.fit(docs, vocabulary=1 + lm_score.SHAPES + 150, frequent=10)
        judged = lm_score._at_parts(docs, model, "doc_id", "text")
        model.part = lm_score._likeliest(judged)
        # The sums at the other parts differ by far, so what the network says enters every one of them.
        assert lm_score.PARTS[model.part] >= lm_score.PARTS[0] and judged.where("abs(sums[0] - sums[8]) < 0.01 * abs(sums[0])").count() < len(some) // 10
        model.network.token_bias -= 1.0 * (np.arange(len(model.network.token_bias)) % 2)  # another network, other scores
        other = lm_score._at_parts(docs, model, "doc_id", "text")
        moved = [j - o for j, o in (judged.selectExpr(f"sum(sums[{k}]) / sum(n_words)").head()[0:1] + other.selectExpr(f"sum(sums[{k}]) / sum(n_words)").head()[0:1] for k in (0, model.part))]
        found.append(moved)
    small, great = found
    assert all(abs(g) > 0.3 * abs(s) for s, g in zip(small, great, strict=True))


def test_several_slices_long_texts_and_an_empty_table(spark, monkeypatch):
    rows = [(i, "the same few words " * 20 + f"only{i}") for i in range(40)] + [(None, None), (99, " "), (98, "a long text " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_score.fit(docs, **NARROW)
    one = {r.doc_id: r.log_likelihood for r in lm_score.score(docs, model).collect()}
    monkeypatch.setattr(lm_score, "SLICE_WORDS", 300)
    many = {r.doc_id: r.log_likelihood for r in lm_score.score(docs, model).collect()}
    assert one.keys() == many.keys() and all(math.isclose(one[i], many[i], rel_tol=1e-6, abs_tol=1e-6) for i in one)
    none = docs.limit(0)
    assert lm_score.score(none, lm_score.fit(none)).count() == 0


def test_the_network_learns_from_every_window(spark, monkeypatch):
    """With a start that draws next to nothing, what it knows of neighbours comes from the pass over all texts."""
    rng = random.Random(3)
    names = [f"{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    follows = dict(zip(names, rng.sample(names, len(names)), strict=True))

    def chain(n):
        out = [rng.choice(names)]
        while len(out) < n:
            out.append(follows[out[-1]])
        return " ".join(out)

    docs = spark.createDataFrame([(i, chain(rng.randint(5, 90))) for i in range(3_000)], "doc_id long, text string")
    for k in ("START_WINDOWS", "TRAIN_WINDOWS"):
        monkeypatch.setattr(lm_score, k, 50, raising=False)
    model = lm_score.fit(docs)
    token, _, first = lm_score._tokens([chain(40).encode() for _ in range(50)], *model.lookup)
    context = lm_score._context(token, first, lm_score.REACH)
    assert model.network.log_p(context, token).mean() > lm_score.Network(model.n_token).log_p(context, token).mean() + 1
    monkeypatch.setattr(lm_score, "PASS_WORDS", 3_000)
    many = lm_score.fit(docs.repartition(7)), lm_score.fit(docs.repartition(3))
    assert np.array_equal(many[0].network.embed, many[1].network.embed) and not np.array_equal(many[0].network.embed, model.network.embed)


def test_equal_texts_weigh_as_many_and_slices_are_averaged_by_windows():
    net, context, token = small()
    weight = np.arange(40) % 3 + 1.0
    again = np.repeat(np.arange(40), weight.astype(int))
    loss, g = net.gradients(context, token, weight)
    want, h = net.gradients(context[:, again], token[again])
    assert loss == pytest.approx(want, rel=1e-5)
    for k in net.DENSE:
        assert g[k] == pytest.approx(h[k], abs=1e-6)
    values = np.arange(4, dtype=np.float32)
    mean = lm_score._averaged(pa.concat_tables([lm_score._weights(17, 3.0, values), lm_score._weights(16, 1.0, 5 * values)]))
    assert mean.column("slice").to_pylist() == [1] and mean.column("mass").to_pylist() == [4.0]
    assert np.frombuffer(mean.column("weights")[0].as_py(), "<f4") == pytest.approx(2 * values)


def test_blocks_and_shifted_logits_change_nothing(monkeypatch):
    net, context, token = small()
    loss, g = net.gradients(context, token)
    got = net.log_p(context, token)
    monkeypatch.setattr(lm_score, "FLAT", 0.0)  # every logit is shifted
    monkeypatch.setattr(lm_score, "BLOCK", 3)
    monkeypatch.setattr(lm_score, "CHUNK", 7)
    again, h = net.gradients(context, token)
    assert again == pytest.approx(loss, rel=1e-5) and net.log_p(context, token) == pytest.approx(got, abs=1e-5)
    for k in g:
        assert h[k] == pytest.approx(g[k], abs=1e-6)
    monkeypatch.setattr(lm_score, "FLAT", 60.0)
    net.token_bias += 300 * (np.arange(23) % 2).astype(np.float32)  # beyond what float32 can exponentiate
    got = net.log_p(context, token)
    assert np.isfinite(got).all() and got == pytest.approx([plain_log_p(net, context[:, k], t) for k, t in enumerate(token.tolist())], rel=1e-4)


def test_hashes_and_tokens_are_those_of_look_ups():
    rng = random.Random(6)
    every = bytes(range(256))
    texts = [bytes(rng.choices(every, k=rng.randint(0, 900))) for _ in range(300)] + [b"", b"A b-1 " * 20_000, b" ", b"z"]
    want, starts = words.word_hashes(texts, lower=True)
    found = list(words.lowered(texts))
    assert len(found) > 3 and np.array_equal(np.concatenate([f[3] for f in found]), want)
    known = np.unique(np.random.default_rng(1).choice(want, 400))
    rank = 1 + lm_score.SHAPES + np.arange(len(known))[::-1]
    place = dict(zip(known.tolist(), rank.tolist(), strict=True))
    for some in (known, known[:1], known[:0]):
        token, hashes, first = lm_score._tokens(texts, some, rank)
        assert np.array_equal(hashes, want) and np.array_equal(first, starts)
        split = [w for t in texts for w in t.split()]
        shape = [2 * min(len(w), lm_score.SHAPES // 2) - 1 + (sum(not (c >= 128 or 97 <= c | 32 <= 122) for c in w) > 1) for w in split]
        have = set(some.tolist())
        assert token.tolist() == [place[x] if x in have else s for x, s in zip(want.tolist(), shape, strict=True)]


def test_logits_are_held_for_a_block_of_windows_only():
    """Logits of a whole mini-batch fit no core's cache."""
    rng = np.random.default_rng(1)
    net = lm_score.Network(np.full(1_000, 9), hidden=4, group=1_000)
    context, token = rng.integers(0, 1_000, (4, 16_384)), rng.integers(0, 1_000, 16_384)
    for work in (net.log_p, net.gradients):
        tracemalloc.start()
        try:
            work(context, token)
            assert tracemalloc.get_traced_memory()[1] < 12e6  # all logits at once: 65 MB, those of a block: 4 MB
        finally:
            tracemalloc.stop()


def test_a_batch_of_weights_leaves_room_in_a_small_heap():
    """Parquet is read in batches of 4,096 rows, whose room doubles as it fills; four tasks share 1 GB in these tests."""
    rows = lm_score._weights(0, 1.0, np.zeros(1_000_000, np.float32)).column("weights").to_pylist()
    assert sum(map(len, rows)) == 4_000_000 and 4_096 * max(map(len, rows)) <= 1 << 24
