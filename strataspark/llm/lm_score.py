"""Operator 9, LM scoring by masked pseudo-likelihood: a bidirectional window network trained in numpy, and the counts
of all words and word pairs of the corpus.

Words are mapped to at most ``VOCABULARY`` tokens: the most frequent words of the whole corpus, and shape classes
(length, letters or not) for the others. The network reads ``REACH`` tokens on either side, h = tanh(sum of one
embedding per place + b), and predicts the masked token between in two steps, softmax over groups of tokens and softmax
inside the group, so that a normalised probability costs two short products. It is trained by mini-batches on every
window of the corpus: texts travel as tokens to slices of ``PASS_WORDS`` words, each slice goes through all its windows
from a common start, and the weights of the slices are averaged by their windows. Texts of equal tokens are gone through
once, weighted by their number. The start is trained on windows drawn by hash over the whole corpus, ``START_WINDOWS``
at most; it only sets where the passes begin.

What tells the words of a shape apart, and holds what a small network cannot, are counts that grow with the corpus and
stay distributed: n(w) of every word outside the ``FREQUENT`` commonest, and n(v, w) of every pair of neighbours that
are not both among these. The probability of w between v and x is

    e * net(token of w) * share of w in its token + (1 - e) * (n(v, w) + n(w, x)) / (n(v) + n(x))

where v and x among the commonest, which the network knows well, add nothing (e is 1 where both are), and the share is
n(w) / n(token of w) in a shape class, else 1. The masked occurrence itself is left out of each word's and pair's count
(none below 0; 1/2 for a word seen nowhere else). Counts travel as packed hashes (``tally``).

The network's part e is that of ``SMOOTH`` observations beside n(v) + n(x), and goes down to ``part`` where these are
many: e = part + (1 - part) * SMOOTH / (n(v) + n(x) + SMOOTH). So counts that grow with the corpus never push it out.
``part`` is one of ``PARTS``, the one at which the words of the corpus, each left out of the counts, are likeliest; all
documents are scored at each of them at once, so fitting it reads nothing twice.
A document's score is the sum of the log-probabilities of its words, each given its neighbours.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm import tally, words
from strataspark.llm.common import dropped, slices, table, written

#: Tokens: the boundary, shape classes, and frequent words; of these, the commonest that pair counts leave out.
SHAPES, VOCABULARY, FREQUENT = 32, 8_192, 95
#: Tokens read on either side; hidden width; tokens of an output group.
REACH, HIDDEN, GROUP = 2, 24, 90
#: Windows that the start is trained on, at most; of a mini-batch; passes; step size.
START_WINDOWS, BATCH, EPOCHS, RATE = 300_000, 1_500, 2, 0.4
#: The pass over all windows: words of a slice, about; words that are mixed at once; of a mini-batch; slices averaged at once.
PASS_WORDS, PASS_MIXED, PASS_BATCH, PASS_MEAN = 4_000_000, 200_000, 8_192, 16
#: Weight of the network beside the counts; words of the corpus for each slice of documents and bucket of hashes.
SMOOTH, SLICE_WORDS = 4.0, tally.SLICE_KEYS
#: The network's part of a probability, however many counts there are: what is tried on the corpus.
PARTS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
#: Windows that are sorted by group at once for scoring; whose logits are held at once, so that they stay in a core's cache.
CHUNK, BLOCK = 65_536, 1_024
#: Logits that cannot go beyond this need no shift before they are exponentiated.
FLAT = 60.0


class Network:
    """Weights, and the sums of squares of past gradients. Groups are runs of ``GROUP`` tokens; an untrained network gives the tokens' frequencies."""

    DENSE = ("to_group", "group_bias", "to_token", "token_bias", "bias")

    def __init__(self, counts: np.ndarray, hidden: int = HIDDEN, reach: int = REACH, group: int = GROUP, seed: int = 5):
        rng, v = np.random.default_rng(seed), len(counts)
        self.reach, self.group, self.past = reach, group, None
        self.edges = list(range(0, v, group)) + [v]
        seen = counts + 0.01
        mass = np.add.reduceat(seen, self.edges[:-1])
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.embed, self.bias = draw(2 * reach, v, hidden), np.zeros(hidden, np.float32)
        self.to_group, self.group_bias = draw(hidden, len(mass)), np.log(mass / mass.sum()).astype(np.float32)
        self.to_token = draw(v, hidden)
        self.token_bias = np.log(seen / np.repeat(mass, np.diff(self.edges))).astype(np.float32)

    def hidden(self, context: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Of windows (places, n) in an order; the last column is 1, for biases."""
        total, some = np.empty((2, len(order), len(self.bias)), self.embed.dtype)
        for place, token in enumerate(context):
            np.take(self.embed[place], token.take(order), axis=0, out=some if place else total, mode="clip")  # any other mode copies
            if place:
                total += some
        total += self.bias
        out = np.empty((len(order), len(self.bias) + 1), total.dtype)
        out[:, :-1], out[:, -1] = np.tanh(total, out=total), 1
        return out

    def _layers(self) -> tuple[Layer, list[Layer], np.ndarray, np.ndarray]:
        """The softmax over groups, those inside each group, and the gradients of both by widened weights, to be added up."""
        groups, most = _widened(self.to_group.T, self.group_bias)
        tokens, each = _widened(self.to_token, self.token_bias)
        inner = np.maximum.reduceat(each, self.edges[:-1]).tolist()
        of_group, of_token = np.zeros_like(groups), np.zeros_like(tokens)
        room = np.empty(BLOCK * max(len(groups), self.group), groups.dtype)
        parts = [Layer(tokens[a:b], of_token[a:b], top, room) for a, b, top in zip(self.edges, self.edges[1:], inner, strict=False)]
        return Layer(groups, of_group, most.max(), room), parts, of_group, of_token

    def _by_group(self, token: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """The order of windows by group, and (group, windows in that order) in blocks."""
        own = (token // self.group).astype(np.uint16)
        order = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[order], np.arange(len(self.edges))).tolist()
        return order, [(g, rows) for g, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) for rows in _blocks(a, b)]

    def log_p(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Log-probability of the masked tokens."""
        out = np.empty(len(token), np.float64)
        top, inner, _, _ = self._layers()
        for lo in range(0, len(token), CHUNK):
            own = token[lo : lo + CHUNK]
            order, parts = self._by_group(own)
            h, own, part = self.hidden(context[:, lo : lo + CHUNK], order), own.take(order), np.empty(len(order))
            group = own // self.group
            for rows in _blocks(0, len(order)):
                part[rows] = top.read(h[rows], group[rows])
            for g, rows in parts:
                part[rows] += inner[g].read(h[rows], own[rows] - self.edges[g])
            out[lo + order] = part
        return out

    def gradients(self, context: np.ndarray, token: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-probability of windows, and its gradients; ``embed``'s is per window, for its rows."""
        order, parts = self._by_group(token)
        h, token = self.hidden(context, order), token.take(order)
        share = np.full(len(token), 1 / len(token), h.dtype) if weight is None else (weight.take(order) / weight.sum()).astype(h.dtype)
        top, inner, of_group, of_token = self._layers()
        group, gain, dh = token // self.group, np.empty_like(share), np.empty_like(h)
        for rows in _blocks(0, len(token)):
            gain[rows], dh[rows] = top.learn(h[rows], group[rows], share[rows])
        for g, rows in parts:
            told, back = inner[g].learn(h[rows], token[rows] - self.edges[g], share[rows])
            gain[rows] += told
            dh[rows] += back
        h *= h
        dh *= np.subtract(1, h, out=h)
        found = {"to_group": of_group[:, :-1].T, "group_bias": of_group[:, -1], "to_token": of_token[:, :-1], "token_bias": of_token[:, -1], "bias": dh.sum(0)[:-1]}
        found["embed"] = np.empty((len(dh), len(self.bias)), dh.dtype)
        found["embed"][order] = dh[:, :-1]
        return -float(gain @ share), found

    def step(self, context: np.ndarray, token: np.ndarray, weight: np.ndarray | None = None, rate: float = RATE) -> None:
        """One mini-batch of Adagrad."""
        if self.past is None:
            self.past = {k: np.full_like(getattr(self, k), 1e-4) for k in self.DENSE} | {"embed": np.full_like(self.embed[..., 0], 1e-4)}
        _, g = self.gradients(context, token, weight)
        for k in self.DENSE:
            change = np.ascontiguousarray(g[k])
            self.past[k] += change * change
            change *= rate
            change /= np.sqrt(self.past[k])
            getattr(self, k)[...] -= change
        told, place_of = g["embed"].astype(np.float64).ravel(), np.empty(self.embed.shape[1], np.int64)
        for place, own in enumerate(context):
            rows = np.flatnonzero(np.bincount(own, minlength=len(place_of)))
            place_of[rows] = np.arange(len(rows))
            cell = np.arange(len(rows) * len(self.bias)).reshape(len(rows), -1)
            total = np.bincount(cell.take(place_of.take(own), axis=0).ravel(), told).astype(self.embed.dtype).reshape(cell.shape)
            past = self.past["embed"][place].take(rows) + np.einsum("ij,ij->i", total, total) / len(self.bias)
            self.past["embed"][place, rows] = past
            total *= (rate / np.sqrt(past))[:, None]
            self.embed[place, rows] = self.embed[place].take(rows, axis=0) - total

    def train(self, windows: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 9) -> Network:
        """Mini-batches of ``windows``(n, 2 reach + 1), the masked token in the middle."""
        rng = np.random.default_rng(seed)
        for _ in range(epochs if len(windows) else 0):
            order = rng.permutation(len(windows))
            for lo in range(0, len(order), batch):
                some = windows[order[lo : lo + batch]].T
                self.step(np.delete(some, self.reach, axis=0), some[self.reach], rate=rate)
        return self

    def train_whole(self, texts: list[tuple[np.ndarray, int]], seed: int = 9) -> Network:
        """Every window of texts (tokens, times) once, weighted by times."""
        rng, held, size = np.random.default_rng(seed), [], 0
        for n, k in enumerate(rng.permutation(len(texts)).tolist()):
            held.append(texts[k])
            size += len(texts[k][0])
            if size >= PASS_MIXED or n == len(texts) - 1:
                token, lengths = np.concatenate([t for t, _ in held]), [len(t) for t, _ in held]
                context, weight = _context(token, np.cumsum([0, *lengths]), self.reach).astype(token.dtype), np.repeat([float(x) for _, x in held], lengths)
                order = rng.permutation(len(token))
                for lo in range(0, len(order), PASS_BATCH):
                    some = order[lo : lo + PASS_BATCH]
                    self.step(context.take(some, axis=1), token.take(some), weight.take(some))
                held, size = [], 0
        return self

    def weights(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in ("embed", *self.DENSE)])

    def with_weights(self, values: np.ndarray) -> Network:
        """This network with other weights, ready to score."""
        at = 0
        for k in ("embed", *self.DENSE):
            own = getattr(self, k)
            setattr(self, k, values[at : at + own.size].reshape(own.shape).astype(own.dtype))
            at += own.size
        self.past = None
        return self


class Layer:
    """A softmax over the rows of ``weights``, whose last column is the bias; ``most``: what no logit exceeds, either way.

    ``gradient`` is added to by ``learn``; logits are written to ``room``, which other layers use as well.
    """

    def __init__(self, weights: np.ndarray, gradient: np.ndarray, most: float, room: np.ndarray):
        self.weights, self.gradient, self.room = weights, gradient, room
        self.steep, self.ones = not most < FLAT, np.ones(len(weights), weights.dtype)

    def _read(self, h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Exponentials of the logits, their sums, the place of each row's own column, and its log-probability."""
        x = self.room[: len(h) * len(self.weights)].reshape(len(h), -1)
        np.matmul(h, self.weights.T, out=x)
        if self.steep:
            x -= x.max(1, keepdims=True)
        at = np.arange(0, x.size, x.shape[1]) + own
        told = x.ravel().take(at)
        np.exp(x, out=x)
        total = x @ self.ones
        return x, total, at, told - np.log(total)

    def read(self, h: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Log-probabilities of each row's own column."""
        return self._read(h, own)[3]

    def learn(self, h: np.ndarray, own: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities, and the gradient by ``h`` of their weighted sum, negated; that by the weights is added up."""
        x, total, at, told = self._read(h, own)
        x.reshape(-1)[at] -= total
        scale = (share / total)[:, None]
        self.gradient += x.T @ (h * scale)
        back = x @ self.weights
        back *= scale
        return told, back


def _widened(weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights with the bias as last column, and what each row's logit cannot exceed, as a hidden value is within 1."""
    out = np.concatenate([weights, bias[:, None]], axis=1)
    return out, np.abs(out) @ np.ones(out.shape[1], out.dtype)


def _blocks(start: int, stop: int) -> list[slice]:
    return [slice(lo, min(lo + BLOCK, stop)) for lo in range(start, stop, BLOCK)]


class Model:
    """Known word hashes (sorted) with their tokens, the network, corpus counts of tokens, and the corpus itself.

    ``part``: the place in ``PARTS`` of the network's part, fitted when the corpus is first scored.
    """

    part: int | None = None

    def __init__(self, known: np.ndarray, rank: np.ndarray, frequent: int, network: Network, n_token: np.ndarray, n_words: int, docs: DataFrame, text: str):
        self.lookup, self.frequent, self.network, self.n_token, self.n_words = (known, rank), frequent, network, n_token, n_words
        self.docs, self.text = docs, text


def _tokens(texts: list[bytes], known: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token and hash of each word, and each text's first word."""
    token, hashes, first = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for buf, begin, end, own, starts in words.lowered(texts):
        letter = (buf >= 128) | ((buf | 32) >= 97) & ((buf | 32) <= 122)
        odd = np.zeros(len(buf) + 1, np.int32)
        np.cumsum(~letter, out=odd[1:])
        token.append(1 + 2 * np.minimum(end - begin, SHAPES // 2) - 2 + (odd.take(end) - odd.take(begin) > 1))
        hashes.append(own)
        first.append(starts[1:] + first[-1][-1])
    token, hashes, first = np.concatenate(token), np.concatenate(hashes), np.concatenate(first)
    if len(known):
        found, at = _found(hashes, known)
        token = np.where(found, rank.take(at, mode="clip"), token)
    return token, hashes, first


def _found(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash is among the sorted distinct ``known``, and where; by its first 16 bits, then in steps."""
    size = np.bincount((known >> np.uint64(48)).view(np.int64), minlength=1 << 16)
    at = (np.cumsum(size) - size).take((hashes >> np.uint64(48)).view(np.int64))
    most = int(size.max())
    padded = np.concatenate((known, np.repeat(known[-1:], most)))
    for _ in range(most - 1):
        at += padded.take(at) < hashes
    return padded.take(at) == hashes, at


def _context(token: np.ndarray, first: np.ndarray, reach: int) -> np.ndarray:
    """(places, n): the tokens around each word of its own text; 0 stands beyond either end."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.zeros((2 * reach, len(token)), np.int64)
    for place, d in enumerate([d for d in range(-reach, reach + 1) if d]):
        a, b = (slice(-d, None), slice(None, d)) if d < 0 else (slice(None, -d or None), slice(d, None))
        if len(token) > abs(d):
            out[place, a] = np.where(owner[a] == owner[b], token[b], 0)
    return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [own for _, texts in slices(batch.column(0)) for _, _, _, own, _ in words.lowered(texts)]
        if found:
            value, count = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count)], names=["word", "n"])


def _drawn(hashes: np.ndarray, context: np.ndarray, rate: float) -> np.ndarray:
    """Places of the windows that the start draws: by a hash of what stands there, so reruns agree."""
    around = words.mix(hashes + words.mix(context.astype(np.uint64) * words.constant(3)).sum(0, dtype=np.uint64))
    return np.flatnonzero(around >> np.uint64(11) < np.uint64(min(1.0, rate) * (1 << 53)))


_GATHERED = pa.schema([("token", pa.int32()), ("n", pa.int64()), ("windows", pa.binary()), ("tokens", pa.binary()), ("times", pa.int64())])


def _gathered(batches: Iterator[pa.RecordBatch], known: np.ndarray, rank: np.ndarray, vocabulary: int, rate: float) -> Iterator[pa.RecordBatch]:
    """A task's token counts, the windows it draws as packed 16-bit tokens, and its texts as such; equal ones of a batch once."""
    total = np.zeros(vocabulary, np.int64)

    def rows(token, n, windows, tokens, times):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((token, n, windows, tokens, times), _GATHERED.types, strict=True)], schema=_GATHERED)

    for batch in batches:
        drawn, texts_seen = [], {}
        for _, texts in slices(batch.column(0)):
            token, hashes, first = _tokens(texts, known, rank)
            total += np.bincount(token, minlength=vocabulary)
            context = _context(token, first, REACH)
            at = _drawn(hashes, context, rate)
            drawn.append(np.insert(context[:, at], REACH, token[at], axis=0).T.astype("<u2").tobytes())
            raw, edge = token.astype("<u2").tobytes(), (2 * first).tolist()
            for a, b in zip(edge, edge[1:], strict=False):
                if a < b:
                    texts_seen[raw[a:b]] = texts_seen.get(raw[a:b], 0) + 1
        yield rows([None], [0], [b"".join(drawn)], [None], [None])
        if texts_seen:
            none = [None] * len(texts_seen)
            yield rows(none, none, none, list(texts_seen), list(texts_seen.values()))
    some = np.flatnonzero(total)
    none = [None] * len(some)
    yield rows(some.astype(np.int32), total[some], none, none, none)


#: Weights travel in rows of at most this many, as Parquet is read in batches of 4,096 rows, one for each running task.
WEIGHTS_ROW = 1 << 10
_WEIGHTS = "slice long, part long, mass double, weights binary"


def _weights(number: int, mass: float, values: np.ndarray, part: int = 0) -> pa.Table:
    rows = [values[k : k + WEIGHTS_ROW].astype("<f4").tobytes() for k in range(0, len(values), WEIGHTS_ROW)]
    return pa.table({"slice": pa.array([number] * len(rows), pa.int64()), "part": pa.array(range(part, part + len(rows)), pa.int64()), "mass": pa.array([mass] * len(rows)), "weights": pa.array(rows, pa.binary())})


def _trained(part: pa.Table, start: Network) -> pa.Table:
    """A slice's texts, gone through from the common start: their windows and the weights after them."""
    times: dict[bytes, int] = {}
    for tokens, n in zip(part.column("tokens").to_pylist(), part.column("times").to_pylist(), strict=True):
        times[tokens] = times.get(tokens, 0) + n
    texts = [(np.frombuffer(t, "<u2"), n) for t, n in sorted(times.items())]  # the order of rows does not matter
    network = copy.deepcopy(start).train_whole(texts)
    return _weights(part.column("slice")[0].as_py(), float(sum(len(t) * n for t, n in texts)), network.weights())


def _averaged(part: pa.Table) -> pa.Table:
    """One part of the weights of some slices, averaged by their windows."""
    part = part.sort_by("slice")
    total, mass = 0.0, sum(part.column("mass").to_pylist())
    for m, raw in zip(part.column("mass"), part.column("weights"), strict=True):
        total = total + np.frombuffer(raw.as_buffer(), "<f4") * (m.as_py() / mass)
    return _weights(part.column("slice")[0].as_py() // PASS_MEAN, mass, total, part.column("part")[0].as_py())


def _whole(gathered: DataFrame, start: Network, n_words: int) -> Network:
    """The network after all windows."""
    count = max(1, -(-n_words // PASS_WORDS))
    told = gathered.sparkSession.sparkContext.broadcast(start)
    texts = gathered.where("tokens is not null").select("tokens", "times", F.pmod(F.xxhash64("tokens"), F.lit(count)).alias("slice"))
    means = written(texts.groupBy("slice").applyInArrow(lambda t: _trained(t, told.value), _WEIGHTS))
    while count > 1:
        count = -(-count // PASS_MEAN)
        some = F.floor(F.col("slice") / F.lit(PASS_MEAN))
        before, means = means, written(means.groupBy(some, "part").applyInArrow(_averaged, _WEIGHTS))
        dropped(before)
    found = b"".join(bytes(r.weights) for r in means.orderBy("part").collect())
    dropped(means)
    return start.with_weights(np.frombuffer(found, "<f4") if found else start.weights())


def fit(docs: DataFrame, text: str = "text", vocabulary: int = VOCABULARY, frequent: int = FREQUENT) -> Model:
    """Vocabulary, token counts and the network, from all texts of ``docs``."""
    source = docs.select(F.col(text).cast("string").alias("text")).where("text is not null")
    counts = written(source.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    n_words = counts.agg(F.sum("n")).head()[0] or 0
    top = counts.orderBy(F.desc("n"), "word").limit(vocabulary - 1 - SHAPES).toPandas()  # commonest first
    dropped(counts)
    hashes = top.word.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    known, rank = hashes[order], 1 + SHAPES + order
    rate = START_WINDOWS / max(1, n_words)
    gathered = written(source.mapInArrow(lambda parts: _gathered(parts, known, rank, vocabulary, rate), "token int, n long, windows binary, tokens binary, times long"))
    n_token = np.zeros(vocabulary, np.int64)
    for r in gathered.where("token is not null").groupBy("token").agg(F.sum("n").alias("n")).collect():  # a row per token
        n_token[r.token] = r.n
    packed = sorted(bytes(r.windows) for r in gathered.where("length(windows) > 0").select("windows").collect())  # bounded by START_WINDOWS
    windows = np.frombuffer(b"".join(packed), "<u2").reshape(-1, 2 * REACH + 1).astype(np.int64)
    windows = windows[np.lexsort(windows.T)]  # the order of tasks does not matter
    network = _whole(gathered, Network(n_token).train(windows), n_words)
    dropped(gathered)
    return Model(known, rank, frequent, network, n_token, n_words, docs, text)


def _keys(token: np.ndarray, hashes: np.ndarray, first: np.ndarray, frequent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words are counted by themselves; keys of each word with the next, and which of these count."""
    rare = (token <= SHAPES) | (token > SHAPES + frequent)
    paired = rare[:-1] | rare[1:]
    inner = first[1:-1]
    paired[inner[(inner > 0) & (inner < len(hashes))] - 1] = False
    return rare, words.gram_hashes(hashes, 2), paired


def _pieces(part: pa.Table, lookup: tuple, frequent: int) -> list[tuple]:
    """(token, first word, rare, hashes, pair keys, which count) of a slice's texts, some texts at a time."""
    out = []
    for chunk in part.column("text").chunks:
        for _, texts in slices(chunk):
            token, hashes, first = _tokens(texts, *lookup)
            rare, pairs, paired = _keys(token, hashes, first, frequent)
            out.append((token, first, rare, hashes, pairs, paired))
    return out


def _flat(pieces: list[tuple]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(k for _, _, rare, hashes, pairs, paired in pieces for k in (hashes[rare], pairs[paired]))])


def _sent(part: pa.Table, lookup: tuple, frequent: int, buckets: int, counted: bool, asked: bool) -> pa.Table:
    """A slice's distinct keys by bucket; ``counted``: with their counts, ``asked``: wanting an answer."""
    keys, counts = np.unique(_flat(_pieces(part, lookup, frequent)), return_counts=True)
    return tally.sent(part.column("slice")[0].as_py() if asked else None, keys, counts if counted else None, buckets)


_JUDGED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("sums", pa.list_(pa.float64()))])


def _judged(part: pa.Table, answers: pa.Table, model: tuple, buckets: int) -> pa.Table:
    """A slice's documents with their scores at each of ``PARTS``."""
    lookup, frequent, network, n_token = model
    pieces = _pieces(part, lookup, frequent)
    keys, at = np.unique(_flat(pieces), return_inverse=True)
    others = np.maximum(tally.told(answers, keys, buckets)[at] - 1, 0).astype(np.float64)  # without the masked occurrence
    done, n, total = 0, [], []
    for token, first, is_rare, _, _, paired in pieces:
        m = len(token)
        word, follows, precedes, pair = np.zeros(m), np.zeros(m), np.zeros(m), np.zeros(max(0, m - 1))
        for where, values in ((is_rare, word), (paired, pair)):
            some = np.count_nonzero(where)
            values[where] = others[done : done + some]
            done += some
        # A context counts where it is rare and of the same text, which ``paired`` tells.
        left, right = paired & is_rare[:-1], paired & is_rare[1:]
        follows[1:], precedes[:-1] = np.where(left, pair, 0), np.where(right, pair, 0)
        seen = np.zeros(m)
        seen[1:] += np.where(left, word[:-1], 0)
        seen[:-1] += np.where(right, word[1:], 0)
        base = network.log_p(_context(token, first, network.reach), token)
        shape = token <= SHAPES
        base[shape] += np.log(np.maximum(word[shape], 0.5) / np.maximum(n_token[token[shape]], 1))
        told = np.flatnonzero(seen)
        c = seen[told]
        few, pairs = SMOOTH / (c + SMOOTH), ((follows + precedes)[told] / c)
        above = np.exp(base[told]) - pairs  # the network over the counts
        low, rest, sums = (pairs + few * above).astype(np.float32), ((1 - few) * above).astype(np.float32), np.empty((len(first) - 1, len(PARTS)))
        base[told] = 0
        run, where, at = np.zeros(m + 1), np.searchsorted(told, first), np.zeros(len(told) + 1)
        np.cumsum(base, out=run[1:])
        alone, mixed = run[first[1:]] - run[first[:-1]], np.empty_like(low)
        for k, least in enumerate(PARTS):
            np.multiply(rest, np.float32(least), out=mixed)
            mixed += low
            np.cumsum(np.log(mixed, out=mixed), dtype=np.float64, out=at[1:])
            sums[:, k] = alone + at[where[1:]] - at[where[:-1]]
        n.append(np.diff(first))
        total.append(sums)
    flat = np.concatenate([np.zeros(0), *(x.ravel() for x in total)])
    sums = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(PARTS)), pa.int32()), pa.array(flat))
    return pa.Table.from_arrays([part.column("doc_id").combine_chunks(), pa.array(np.concatenate([np.zeros(0, np.int64), *n])), sums], schema=_JUDGED)


def _at_parts(docs: DataFrame, model: Model, doc_id: str | None, text: str) -> DataFrame:
    """(doc_id, n_words, sums) of each row: its log-likelihood at each of ``PARTS``; no ids without ``doc_id``."""
    told = docs.sparkSession.sparkContext.broadcast((model.lookup, model.frequent, model.network, model.n_token))
    count = max(1, -(-model.n_words // SLICE_WORDS))
    named = (F.col(doc_id) if doc_id else F.lit(None)).cast("long").alias("doc_id")
    rows = docs.select(named, F.col(text).cast("string").alias("text")).withColumn("slice", F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)))

    def sent(source: DataFrame, counted: bool, asked: bool) -> DataFrame:
        return source.groupBy("slice").applyInArrow(lambda t: _sent(t, *told.value[:2], count, counted, asked), tally.SENT)

    if model.docs is docs and model.text == text:
        keys = sent(rows, True, True)  # the corpus itself: what is counted is what is asked
    else:
        corpus = model.docs.select(F.col(model.text).cast("string").alias("text")).where("text is not null")
        corpus = corpus.withColumn("slice", F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(count)))
        keys = sent(corpus, True, False).union(sent(rows, False, True))
    answers = keys.groupBy("bucket").applyInArrow(tally.answered, tally.ANSWER)
    judged = rows.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(lambda t, a: _judged(t, a, told.value, count), "doc_id long, n_words long, sums array<double>")
    return written(judged)


def _likeliest(judged: DataFrame) -> int:
    """The place in ``PARTS`` that gives all words together the greatest likelihood; of equals, the first."""
    sums = judged.agg(*(F.sum(F.col("sums")[k]) for k in range(len(PARTS)))).head()
    return max(range(len(PARTS)), key=lambda k: (sums[k] or 0.0, -k))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) per row; null and blank texts have 0 words, sum 0, null mean.

    Repeated rows score alike. A text of any length is scored whole and is at most one slice's data; other columns are
    ignored, an empty table gives no rows. Words of one frequency enter the vocabulary in the order of their hashes.
    ``model.part`` is fitted on the model's corpus, which is scored for it first if ``docs`` are others.
    """
    judged = _at_parts(docs, model, doc_id, text)
    if model.part is None and model.docs is docs and model.text == text:
        model.part = _likeliest(judged)
    elif model.part is None:
        corpus = _at_parts(model.docs, model, None, model.text)
        model.part = _likeliest(corpus)
        dropped(corpus)
    total = F.col("sums")[model.part].alias("log_likelihood")
    return judged.select("doc_id", "n_words", total).withColumn("mean_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs))
