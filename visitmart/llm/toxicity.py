"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own vector, if it was frequent enough in training, beside the mean vector of its
first and last character trigrams. A word of more than ``PARTS`` bytes is followed by overlapping pieces of itself
that hold all its other trigrams, so a text without blanks is read whole, too. Windows of ``WINDOW`` words and pieces overlap; every window of a text is scored,
and the text's score comes from its highest window. Labels are of whole texts, so in training a toxic
text gives the windows whose words speak most for the label, and the other texts give any windows.
Fitted by Adam on a bounded sample of labelled rows; all rows are scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.wordhash import Words, mix, texts

WINDOW, STRIDE = 32, 24
HIDDEN, EMBED = 8, 8
TRIGRAMS = 1 << 11
HEAD, PARTS = 5, 8  # trigrams at a word's start, and in all
LEAST_TEXTS = 8  # a word in fewer sampled texts has no vector of its own
SPEAKS = 1.5  # log ratio from which a word speaks for the label


@dataclass
class Tokens:
    """hash, trigram buckets and word number of each word and piece; first[i]: number of the first one of text i."""

    hash: np.ndarray
    grams: np.ndarray
    word: np.ndarray
    first: np.ndarray


def tokens(found: Words, data: np.ndarray) -> Tokens:
    """Words with the buckets of their first five and last three trigrams, long ones followed by their pieces.

    A trigram has its middle at one byte of the word, and the word's borders are marked. A piece holds ``PARTS``
    neighbouring trigrams; the last piece of a word reaches back so that it is full.
    """
    size = found.end - found.start
    count = 1 + -(-np.maximum(size - PARTS, 0) // PARTS)
    edge = np.concatenate([[0], np.cumsum(count)])
    word = np.repeat(np.arange(len(size)), count)
    piece = np.arange(len(word)) - edge[word]
    start, end = found.start[word], found.end[word]

    def byte(at: np.ndarray) -> np.ndarray:
        inside = (at >= start) & (at < end)
        b = data[np.where(inside, at, start)].astype(np.int64)
        b += 0x20 * ((b >= 0x41) & (b <= 0x5A))
        return np.where(inside, b, np.where(at < start, 256, 257))

    low = np.minimum(HEAD + (piece - 1) * PARTS, end - start - PARTS)
    grams = np.empty((len(word), PARTS), dtype=np.int16)
    name = np.zeros(len(word), dtype=np.uint64)
    for k in range(PARTS):
        ends = np.minimum(k, end - start - 1) if k < HEAD else end - start - 1 - np.minimum(k - HEAD, end - start - 1)
        middle = start + np.where(piece == 0, ends, low + k)
        code = (byte(middle - 1) * 260 + byte(middle)) * 260 + byte(middle + 1)
        mixed = mix(code.astype(np.uint64))
        grams[:, k] = (mixed % np.uint64(TRIGRAMS)).astype(np.int16)
        name = mix(name * np.uint64(0x9FB21C651E98DF25) + mixed)
    return Tokens(np.where(piece == 0, found.hash[word], name), grams, word, edge[found.first])


def cut(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and number of words of each window; an empty text has one empty window."""
    count = np.diff(first)
    many = np.maximum(1, -(-(count - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(count)), many)
    begin = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE
    return row, begin + first[:-1][row], np.minimum(count[row] - begin, WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Net:
    vocabulary: np.ndarray  # ascending hashes; vector 0 is for all others
    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0

    def ids(self, word: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(word), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, word), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == word, at + 1, 0)

    def inputs(self, ids: np.ndarray, grams: np.ndarray) -> np.ndarray:
        return np.concatenate([self.p["word"][ids], self.p["gram"][grams].mean(axis=-2)], axis=-1)


def new_net(vocabulary: np.ndarray, hint: np.ndarray, seed: int = 3) -> Net:
    """``hint``: how much each word speaks for the label, as a start for its vector."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * (1 / np.sqrt(shape[0]))).astype(np.float32)
    p = {"word": (rng.standard_normal((len(vocabulary) + 1, EMBED)) * 0.1).astype(np.float32)}
    p["word"][1:, 0] += hint.astype(np.float32)
    p["gram"] = (rng.standard_normal((TRIGRAMS, EMBED)) * 0.1).astype(np.float32)
    p["in"], p["in_b"] = draw(2 * EMBED, 6 * HIDDEN), np.zeros(6 * HIDDEN, np.float32)
    for d in "fb":
        p[f"zr_{d}"], p[f"n_{d}"] = draw(HIDDEN, 2 * HIDDEN), draw(HIDDEN, HIDDEN)
    p["attend"], p["query"] = draw(2 * HIDDEN, HIDDEN), draw(HIDDEN)
    p["out"], p["out_b"] = draw(2 * HIDDEN), np.zeros(1, np.float32)
    return Net(vocabulary, p)


def run_net(p: dict, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logit of each window. gates: windows x words x 6 HIDDEN; mask: windows x words, 1 where there is a word."""
    n, t, _ = gates.shape
    states = np.zeros((n, t, 2 * HIDDEN), np.float32)
    tape = {"f": [], "b": []}
    for d, steps, base in (("f", range(t), 0), ("b", range(t - 1, -1, -1), 3 * HIDDEN)):
        h = np.zeros((n, HIDDEN), np.float32)
        side = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
        for k in steps:
            x, m = gates[:, k, base : base + 3 * HIDDEN], mask[:, k : k + 1]
            zr = _sigmoid(x[:, : 2 * HIDDEN] + h @ p[f"zr_{d}"])
            z, r = zr[:, :HIDDEN] * m, zr[:, HIDDEN:]
            c = 2 * _sigmoid(2 * (x[:, 2 * HIDDEN :] + (r * h) @ p[f"n_{d}"])) - 1
            if keep:
                tape[d].append((k, h, zr[:, :HIDDEN], r, c))
            h = h + z * (c - h)
            states[:, k, side] = h
    key = np.tanh(states @ p["attend"])
    weight = np.exp(key @ p["query"]) * mask
    weight /= weight.sum(axis=1, keepdims=True) + 1e-9
    pooled = (weight[:, :, None] * states).sum(axis=1)
    logit = pooled @ p["out"] + p["out_b"]
    return (logit, (states, key, weight, pooled, tape)) if keep else logit


def _backward(p: dict, gates, mask, saved, g) -> tuple[dict, np.ndarray]:
    """Gradients by parameter, and of the gates. g: gradient of each logit."""
    states, key, weight, pooled, tape = saved
    d = {"out": pooled.T @ g, "out_b": g.sum(keepdims=True)}
    d_pooled = g[:, None] * p["out"]
    d_states = weight[:, :, None] * d_pooled[:, None, :]
    d_weight = (states * d_pooled[:, None, :]).sum(axis=2)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    d["query"] = np.einsum("nt,nth->h", d_score, key)
    d_key = d_score[:, :, None] * p["query"] * (1 - key * key)
    d["attend"] = np.einsum("nts,nth->sh", states, d_key)
    d_states += d_key @ p["attend"].T
    d_gates = np.zeros_like(gates)
    for side, base, cols in (("f", 0, slice(0, HIDDEN)), ("b", 3 * HIDDEN, slice(HIDDEN, 2 * HIDDEN))):
        zr_w, n_w = p[f"zr_{side}"], p[f"n_{side}"]
        d_zr_w, d_n_w = np.zeros_like(zr_w), np.zeros_like(n_w)
        dh = np.zeros((len(g), HIDDEN), np.float32)
        for k, h, z, r, c in reversed(tape[side]):
            dh = dh + d_states[:, k, cols]
            new = dh * mask[:, k : k + 1]
            d_c = new * z * (1 - c * c)
            d_rh = d_c @ n_w.T
            d_zr = np.concatenate([new * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)], axis=1)
            d_gates[:, k, base : base + 3 * HIDDEN] = np.concatenate([d_zr, d_c], axis=1)
            d_zr_w += h.T @ d_zr
            d_n_w += (r * h).T @ d_c
            dh = dh - new * z + d_rh * r + d_zr @ zr_w.T
        d[f"zr_{side}"], d[f"n_{side}"] = d_zr_w, d_n_w
    return d, d_gates


def fit(net: Net, ids: np.ndarray, grams: np.ndarray, mask: np.ndarray, label: np.ndarray, steps: int = 600, rate: float = 0.01, seed: int = 11) -> Net:
    """Adam on the log loss of windows, half of each batch from either label.

    From a third of the steps on, half of the clean windows are drawn from those that scored highest just before.
    """
    rng = np.random.default_rng(seed)
    p, groups = net.p, [np.flatnonzero(label == v) for v in (0, 1)]
    if not all(map(len, groups)):
        return net
    hard = groups[0]
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        if step * 3 >= steps and step % 100 == 0:
            value = [
                run_net(p, net.inputs(ids[g], grams[g]) @ p["in"] + p["in_b"], mask[g])
                for g in np.array_split(groups[0], -(-len(groups[0]) // 1024))
            ]
            hard = groups[0][np.argsort(-np.concatenate(value), kind="stable")[:1000]]
        batch = np.concatenate([rng.choice(g, n) for g, n in ((groups[0], 64), (hard, 64), (groups[1], 96))])
        x = net.inputs(ids[batch], grams[batch])
        gates = x @ p["in"] + p["in_b"]
        logit, saved = run_net(p, gates, mask[batch], keep=True)
        g = ((_sigmoid(logit) - label[batch]) / len(batch)).astype(np.float32)
        d, d_gates = _backward(p, gates, mask[batch], saved, g)
        d["in"], d["in_b"] = np.einsum("nti,ntg->ig", x, d_gates), d_gates.sum(axis=(0, 1))
        d_x = d_gates @ p["in"].T
        d["word"], d["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(d["word"], ids[batch].ravel(), d_x[..., :EMBED].reshape(-1, EMBED))
        share = np.repeat(d_x[..., EMBED:].reshape(-1, EMBED) / PARTS, PARTS, axis=0)
        np.add.at(d["gram"], grams[batch].ravel(), share)
        for k, v in p.items():
            first[k] += 0.1 * (d[k] - first[k])
            second[k] += 0.001 * (d[k] ** 2 - second[k])
            v -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _calibrate(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (value, label), by Newton steps with a weak prior."""
    x = np.stack([value, np.ones(len(value))], axis=1)
    start = w = np.array([0.5, 0.0])
    loss = lambda v: (np.logaddexp(0, x @ v) - label * (x @ v)).sum() + ((v - start) ** 2).sum()
    for _ in range(50):
        q = _sigmoid(x @ w)
        h = (x * (q * (1 - q))[:, None]).T @ x + 2 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (q - label) + 2 * (w - start))
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
    return float(max(w[0], 1e-3)), float(w[1])


def _highest(net: Net, word: np.ndarray, grams: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logit of every window, its text and its first word."""
    row, begin, size = cut(first)
    distinct, at, inverse = np.unique(word, return_index=True, return_inverse=True)
    table = np.zeros((max(len(distinct), 1), 6 * HIDDEN), np.float32)
    for low in range(0, len(distinct), 1 << 15):
        part = slice(low, low + (1 << 15))
        table[part] = net.inputs(net.ids(distinct[part]), grams[at[part]]) @ net.p["in"] + net.p["in_b"]
    out = np.empty(len(row), np.float32)
    for low in range(0, len(row), 4096):
        b, s = begin[low : low + 4096, None], size[low : low + 4096, None]
        there = np.arange(WINDOW) < s
        where = np.where(there, b + np.arange(WINDOW), 0)
        gates = table[inverse[where]] if len(word) else np.zeros((*there.shape, 6 * HIDDEN), np.float32)
        out[low : low + 4096] = run_net(net.p, gates.astype(np.float32), there.astype(np.float32))
    return out, row, begin - first[:-1][row]


def held_out(doc_id):
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = 3000, most_words: int = 4096) -> Net:
    """Fit on at most ``most`` labelled rows outside the held-out fifth, in the order of a hash of their id.

    At most ``most_words`` words and pieces of a row are fitted to, from evenly spread windows of a longer one. Rows with
    null id or label take no part; an id that many rows have adds rows up to ``most``, the least by their words. Without
    rows of both labels all scores follow from the few rows there are.
    """
    sample = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # more than ``most``, if ids repeat

    def run(batches):
        for part, found, data, _ in texts(batches):
            token = tokens(found, data)
            blobs = []
            for a, b in zip(token.first[:-1], token.first[1:]):
                pick = np.arange(a, b)
                if b - a > most_words:
                    starts = np.linspace(a, b - WINDOW, most_words // WINDOW).astype(np.int64)
                    pick = (starts[:, None] + np.arange(WINDOW)).ravel()
                blobs.append((token.hash[pick].tobytes(), token.grams[pick].tobytes()))
            word, gram = ([x[k] for x in blobs] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array(word, pa.binary()), pa.array(gram, pa.binary())],
                names=["doc_id", "label", "word", "gram"],
            )

    read = rows.mapInArrow(run, "doc_id long, label int, word binary, gram binary")
    got = read.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "word", "gram").limit(most).toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("word", "ascending")])
    label_ = np.array(got.column("label").to_pylist(), dtype=np.int64)
    word = [np.frombuffer(b, np.uint64) for b in got.column("word").to_pylist()]
    gram = [np.frombuffer(b, np.int16).reshape(-1, PARTS) for b in got.column("gram").to_pylist()]
    if not len(label_):
        return new_net(np.zeros(0, np.uint64), np.zeros(0))
    sizes = np.array([len(w) for w in word])
    word, gram = np.concatenate(word), np.concatenate(gram).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    once = np.unique(np.stack([word, owner.astype(np.uint64)], axis=1), axis=0)
    value, where = np.unique(once[:, 0], return_inverse=True)
    of_label = label_[once[:, 1].astype(np.int64)]
    toxic, clean = (np.bincount(where, of_label == v, minlength=len(value)) for v in (1, 0))
    often = toxic + clean >= LEAST_TEXTS
    # log ratio of the label's share among a word's texts to its share in all, drawn to 0 for rare words
    share = np.clip(label_.mean(), 1e-3, 1 - 1e-3)
    odds = np.log((toxic + 10 * share) / (toxic + clean + 10) / share)
    net = new_net(value[often], np.clip(odds[often], -2, 2) / 2)

    first = np.concatenate([[0], np.cumsum(sizes)])
    row, begin, size = cut(first)
    mask = np.arange(WINDOW) < size[:, None]
    at = np.where(mask, begin[:, None] + np.arange(WINDOW), 0)
    if not len(word):
        return net
    speaks = np.concatenate([[0.0], odds[often]])[net.ids(word)]
    top = np.where(mask, speaks[at], -9).max(axis=1)
    best = np.full(len(sizes), -9.0)
    np.maximum.at(best, row, top)
    # a toxic text in which no word speaks for the label tells nothing about its windows, unless all are so
    least = SPEAKS if (best[label_ == 1] >= SPEAKS).any() else -9.0
    use = (label_[row] == 0) | ((top >= least) & (top >= np.minimum(best[row], SPEAKS)))
    rng = np.random.default_rng(1)
    clean_ = np.sort(rng.permutation(np.flatnonzero(use & (label_[row] == 0)))[:20_000])
    toxic_ = np.flatnonzero(use & (label_[row] == 1))
    for _ in range(2):
        chosen = np.concatenate([clean_, toxic_[:20_000]])
        ids = net.ids(word)[at[chosen]]
        fit(net, ids, gram[at[chosen]], mask[chosen].astype(np.float32), label_[row[chosen]])
        # the second time each toxic text gives the window that the network itself finds highest
        logit = _highest(net, word, gram, first)[0]
        order = np.lexsort((-logit, row))
        own = order[np.searchsorted(row[order], np.flatnonzero(label_ == 1))]
        toxic_ = np.union1d(toxic_, own)
    logit, text, _ = _highest(net, word, gram, first)
    high = np.full(len(sizes), -np.inf)
    np.maximum.at(high, text, logit)
    net.slope, net.shift = _calibrate(np.clip(high, -12, 12), label_)
    return net


def score(docs: DataFrame, net: Net, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted (1 from ``threshold`` on), windows and worst_word (first word of the highest window) of every row.

    All overlapping windows of the whole text are scored, and every trigram of it is in one. Null and empty texts have
    one empty window; equal texts have equal scores.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)  # its size follows from the bounded sample

    def run(batches):
        own = sent.value
        for part, found, data, _ in texts(batches):
            token = tokens(found, data)
            logit, row, begin = _highest(own, token.hash, token.grams, token.first)
            order = np.lexsort((begin, -logit, row))
            lead = order[np.searchsorted(row[order], np.arange(part.num_rows))]
            # number of the word that the window begins with, or begins inside
            at = (token.first[:-1] + begin[lead])[np.diff(token.first) > 0]
            worst = np.zeros(part.num_rows, dtype=np.int64)
            worst[np.diff(token.first) > 0] = token.word[at]
            worst -= np.where(np.diff(token.first) > 0, found.first[:-1], 0)
            p = _sigmoid(own.slope * np.clip(logit[lead], -12, 12).astype(np.float64) + own.shift)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(p),
                    pa.array((p >= threshold).astype(np.int32)),
                    pa.array(np.bincount(row, minlength=part.num_rows).astype(np.int32)),
                    pa.array(worst),
                ],
                names=["doc_id", "score", "predicted", "windows", "worst_word"],
            )

    schema = "doc_id long, score double, predicted int, windows int, worst_word long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
