"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Pairwise interactions have rank ``FACTORS``: their sum over all pairs of a document's features is
half of (square of the sum minus sum of the squares) in each factor, so scoring is linear in the
number of features. Fitted on a bounded sample of labelled rows; all rows are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.wordhash import SOLID, Words, texts

WORD_BITS = 16
BINS = 16
STATISTICS = 11
FEATURES = (1 << WORD_BITS) + BINS * STATISTICS
FACTORS = 8

_UPPER = np.zeros(256, np.float32)
_UPPER[0x41:0x5B] = 1
_DIGIT = np.zeros(256, np.float32)
_DIGIT[0x30:0x3A] = 1
_SIGN = np.zeros(256, np.float32)
_SIGN[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 1
_WIDE = np.zeros(256, np.float32)
_WIDE[0x80:] = 1
_BREAK = np.zeros(256, np.float32)
_BREAK[0x0A] = 1
_SPACE = (~SOLID).astype(np.float32)


def _share_bin(share: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.sqrt(np.clip(share, 0, 1)) * (BINS - 1)), BINS - 1).astype(np.int64)


def _log_bin(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(x, 0) + 1), BINS - 1).astype(np.int64)


def features(found: Words, data: np.ndarray, starts: np.ndarray, n_chars: np.ndarray):
    """(edge, id, value): the features of text i lie at edge[i] to edge[i+1].

    Words are counted per hash bucket and scaled to length one; each statistic sets one of its bins.
    ``n_chars`` (metadata) is below zero where it is missing.
    """
    rows = len(starts) - 1
    row = found.row()
    key = (row.astype(np.uint64) << np.uint64(WORD_BITS)) | (found.hash >> np.uint64(64 - WORD_BITS))
    key, count = np.unique(key, return_counts=True)
    word_row = (key >> np.uint64(WORD_BITS)).astype(np.int64)
    word_id = (key & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
    value = np.log1p(count).astype(np.float32)
    norm = np.sqrt(np.bincount(word_row, value * value, minlength=rows))
    value = (value / np.maximum(norm, 1e-9)[word_row]).astype(np.float32)

    size = np.diff(starts)
    body = data[starts[0] : starts[-1]]
    filled = size > 0
    edges = (starts[:-1] - starts[0])[filled]

    def per_text(values: np.ndarray) -> np.ndarray:
        out = np.zeros(rows)
        if filled.any():
            out[filled] = np.add.reduceat(values[body], edges)
        return out

    n_words = np.bincount(row, minlength=rows)
    letters = np.maximum(size - per_text(_SPACE), 1)
    signs, uppers = per_text(_SIGN), per_text(_UPPER)
    distinct = np.bincount(word_row, minlength=rows)
    ends_in_sign = np.bincount(row, _SIGN[data[found.end - 1]], minlength=rows) if len(row) else np.zeros(rows)
    lone_sign = np.bincount(row, _SIGN[data[found.start]], minlength=rows) if len(row) else np.zeros(rows)
    many = np.maximum(n_words, 1)
    bins = np.stack(
        [
            _share_bin(uppers / letters),
            _share_bin(per_text(_DIGIT) / letters),
            _share_bin(signs / letters),
            _share_bin(per_text(_WIDE) / letters),
            _share_bin(ends_in_sign / many),
            _share_bin(lone_sign / many),
            _share_bin(distinct / many),
            _share_bin(per_text(_BREAK) / many),
            _log_bin(n_words),
            np.minimum((letters / many), BINS - 1).astype(np.int64),
            np.where(n_chars < 0, BINS - 1, np.minimum(_log_bin(n_chars / 16), BINS - 2)),
        ],
        axis=1,
    )
    bin_id = (1 << WORD_BITS) + np.arange(STATISTICS) * BINS + bins
    ids = np.concatenate([word_id, bin_id.ravel()])
    values = np.concatenate([value, np.full(bin_id.size, STATISTICS**-0.5, np.float32)])
    owner = np.concatenate([word_row, np.repeat(np.arange(rows), STATISTICS)])
    order = np.argsort(owner, kind="stable")
    edge = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
    return edge, ids[order], values[order]


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, edge: np.ndarray, ids: np.ndarray, x: np.ndarray):
        """Log-odds, and the sum of each factor (every text has at least its statistics)."""
        xv = x[:, None] * self.factor[ids]
        total = np.add.reduceat(xv, edge[:-1], axis=0)
        squares = np.add.reduceat((xv * xv).sum(1), edge[:-1])
        linear = np.add.reduceat(x * self.weight[ids], edge[:-1])
        return self.bias + linear + 0.5 * ((total * total).sum(1) - squares), total


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(edge, ids, x, label, epochs: int = 25, rate: float = 0.3, decay: float = 1e-5, seed: int = 7) -> Machine:
    """Mini-batch AdaGrad on the log loss; the same rows in the same order give the same machine."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(label.mean(), 0.01, 0.99)) if len(label) else 0.5
    m = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(FEATURES, np.float32),
        (rng.standard_normal((FEATURES, FACTORS)) * 0.02).astype(np.float32),
    )
    seen_w, seen_v = np.full(FEATURES, 1e-2), np.full((FEATURES, FACTORS), 1e-2)
    for _ in range(epochs if len(label) else 0):
        for batch in np.array_split(rng.permutation(len(label)), max(1, len(label) // 128)):
            count = (edge[1:] - edge[:-1])[batch]
            at = np.arange(count.sum()) + np.repeat(edge[batch] - np.cumsum(count) + count, count)
            e = np.concatenate([[0], np.cumsum(count)])
            i, v = ids[at], x[at]
            z, total = m.raw(e, i, v)
            g = ((_sigmoid(z) - label[batch]) / len(batch)).astype(np.float32)
            gv = np.repeat(g, count) * v
            used, where = np.unique(i, return_inverse=True)
            gw = np.bincount(where, gv) + decay * m.weight[used]
            seen_w[used] += gw * gw
            m.weight[used] -= rate * gw / np.sqrt(seen_w[used])
            part = gv[:, None] * (np.repeat(total, count, axis=0) - v[:, None] * m.factor[i])
            gf = np.stack([np.bincount(where, part[:, k]) for k in range(FACTORS)], 1) + decay * m.factor[used]
            seen_v[used] += gf * gf
            m.factor[used] -= 0.3 * rate * gf / np.sqrt(seen_v[used])
            m.bias -= rate * float(g.sum())
    return m


def _featured(batches: Iterator[pa.RecordBatch]):
    for part, found, data, starts in texts(batches):
        length = np.full(part.num_rows, -1)
        if "n_chars" in part.schema.names:
            length = np.asarray(part.column("n_chars").fill_null(-1).cast(pa.int64()))
        yield part, features(found, data, starts, length)


def held_out(doc_id):
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def _inputs(docs: DataFrame) -> list[str]:
    return ["doc_id", "text", *(["n_chars"] if "n_chars" in docs.columns else [])]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 8000) -> Machine:
    """Fit on at most ``most`` labelled rows outside the held-out fifth, taken in the order of a hash of their id.

    Rows with null id or label take no part; an id that many rows have adds rows up to ``most``, the least by their
    features. Without any labelled row all scores are one half.
    """
    sample = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(most)
    )
    rows = docs.select(_inputs(docs)).join(F.broadcast(sample), "doc_id")  # more than ``most``, if ids repeat

    def run(batches):
        for part, (edge, ids, x) in _featured(batches):
            lists = [pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(v)) for v in (ids.astype(np.int32), x)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), *lists], names=["doc_id", "label", "ids", "x"]
            )

    read = rows.mapInArrow(run, "doc_id long, label int, ids array<int>, x array<float>")
    got = read.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "ids", "x").limit(most).toArrow().combine_chunks()
    if not got.num_rows:
        return Machine(0.0, np.zeros(FEATURES, np.float32), np.zeros((FEATURES, FACTORS), np.float32))
    got = got.sort_by([("doc_id", "ascending"), ("label", "ascending")]).combine_chunks()
    ids = got.column("ids").chunk(0)
    edge = np.asarray(ids.offsets).astype(np.int64)
    x = np.asarray(got.column("x").chunk(0).values)
    return fit(edge, np.asarray(ids.values).astype(np.int64), x, np.asarray(got.column("label")).astype(np.float32))


def score(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted (1 from ``threshold`` on) of every row; empty and null texts are scored by their statistics."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # a fixed size: FEATURES x (FACTORS + 1)

    def run(batches):
        for part, (edge, ids, x) in _featured(batches):
            p = _sigmoid(sent.value.raw(edge, ids, x)[0]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select(_inputs(docs)).mapInArrow(run, "doc_id long, score double, predicted int")


def good_documents(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns unchanged; null and empty texts are scored, too."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for part, (edge, ids, x) in _featured(batches):
            yield part.filter(pa.array(_sigmoid(sent.value.raw(edge, ids, x)[0]) >= threshold))

    return docs.mapInArrow(run, docs.schema)
