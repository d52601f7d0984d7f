"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary file.

The split pattern cuts a text into pieces; the tokenizers library encodes each piece that a worker
has not met yet, over the printable stand-ins of its bytes, and gives the characters each token
covers. A piece's tokens are kept in flat arrays, so a text is put together from them by numpy.
Decoding reverses the byte table: tokens that hold part of a character join to whole characters.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmart.llm.wordhash import pieces, text_bytes

PIECES_KEPT = 300_000


def stand_ins() -> list[str]:
    """The printable character for each byte: itself where it prints, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def piece_tokenizer(ranks: dict[bytes, int]):
    """A tokenizer of single pieces. Two neighbours merge whenever their bytes together have a rank, lowest rank first."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    chars = stand_ins()
    name = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = [
        (name[token[:k]], name[token[k:]])
        for token in sorted(ranks, key=ranks.get)
        for k in range(1, len(token))
        if token[:k] in ranks and token[k:] in ranks
    ]
    made = Tokenizer(models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges))
    made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return made


def _places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (count[0] of them), first[1], ..."""
    total = int(count.sum())
    return np.arange(total) + np.repeat(first - np.cumsum(count) + count, count)


class _Known(dict):
    """Numbers of pieces; a new one gets the next number and waits in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    def __init__(self, path: str, pattern: str):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.find = regex.compile(pattern).findall
        self.tokenizer = piece_tokenizer(read_ranks(path))
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        none = np.zeros(0, dtype=np.int32)
        self.count, self.length, self.ids, self.starts, self.ends = none, none, none, none, none

    def _learn(self) -> None:
        new, self.known.new = self.known.new, []
        got = self.tokenizer.encode_batch(new, add_special_tokens=False)
        add = lambda old, values: np.concatenate([old, np.fromiter(values, dtype=np.int32)])
        self.count = add(self.count, (len(e.ids) for e in got))
        self.length = add(self.length, map(len, new))
        self.ids = add(self.ids, (i for e in got for i in e.ids))
        self.starts = add(self.starts, (o[0] for e in got for o in e.offsets))
        self.ends = add(self.ends, (o[1] for e in got for o in e.offsets))
        self.first = np.cumsum(self.count) - self.count

    def __call__(self, texts: list[str], offsets: bool = True):
        """Tokens of all texts: number in each text, ids, and the characters each token starts and ends at."""
        if len(self.known) > PIECES_KEPT:
            self._forget()
        found = [self.find(t) for t in texts]
        per_text = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        slot = np.fromiter((n for f in found for n in map(self.known.__getitem__, f)), np.int64, int(per_text.sum()))
        if self.known.new:
            self._learn()
        if not len(slot):
            none = np.zeros(0, dtype=np.int32)
            return np.zeros(len(texts), dtype=np.int64), none, none, none
        count = self.count[slot].astype(np.int64)
        at = _places(self.first[slot], count)
        edges = np.concatenate([[0], np.cumsum(per_text)])
        sums = np.concatenate([[0], np.cumsum(count)])
        per_text_tokens = sums[edges[1:]] - sums[edges[:-1]]
        if not offsets:
            return per_text_tokens, self.ids[at], None, None
        length = self.length[slot].astype(np.int64)
        begin = np.cumsum(length) - length
        sums = np.concatenate([[0], np.cumsum(length)])
        begin -= np.repeat(sums[edges[:-1]], per_text)  # pieces fill a text without gaps
        begin = np.repeat(begin, count).astype(np.int32)
        return per_text_tokens, self.ids[at], begin + self.starts[at], begin + self.ends[at]


def _without(df: DataFrame, *names: str) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


def encode(df: DataFrame, path: str, pattern: str, column: str = "text", offsets: bool = True) -> DataFrame:
    """``df`` with ``ids`` and, with ``offsets``, ``starts`` and ``ends`` (characters, end exclusive), one a token.

    A character whose bytes lie in several tokens is covered by each of them. Null and empty texts have
    no tokens; special tokens' strings are ordinary text. Every other column is kept, but one that has a
    result's name is replaced. ``path`` must exist on each executor.
    """
    added = ["ids", "starts", "ends"] if offsets else ["ids"]
    df = _without(df, *added)
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.ArrayType(T.IntegerType(), False)) for c in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Encoder(path, pattern)  # goes with the task, so a worker that serves others later holds no pieces
        for batch in batches:
            if not batch.num_rows:
                continue
            _, starts = text_bytes(batch.column(column))
            for low, high in pieces(starts):
                part = batch.slice(low, high - low)
                texts = part.column(column).fill_null("").to_pylist()
                count, *values = work(texts, offsets)
                edge = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(edge, pa.array(v)) for v in values[: len(added)]]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=[*part.schema.names, *added])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, column: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for, in place of ``column`` and of any column named ``into``; null ids count as none.

    ``F.decode(bytes, 'UTF-8')`` makes text of them: any ids of a whole text give its characters back, cut
    ones may begin or end inside a character. An id without a token is an error.
    """
    if into.lower() != column.lower():
        df = _without(df, into.lower())
    kept = [f for f in df.schema.fields if f.name != column]
    schema = T.StructType(kept + [T.StructField(into, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = {c: b for b, c in enumerate(stand_ins())}
        chars = stand_ins()
        ranks = read_ranks(path)
        names = [""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            names[rank] = "".join(chars[b] for b in token)
        tokens = [bytes(back[c] for c in n) for n in names]
        flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        length = np.array([len(t) for t in tokens], dtype=np.int64)
        first = np.cumsum(length) - length
        for batch in batches:
            lists = batch.column(column)
            if lists.null_count:
                lists = pa.array([x or [] for x in lists.to_pylist()], type=lists.type)
            edge = np.asarray(lists.offsets).astype(np.int64)
            base, edge = edge[0], edge - edge[0]
            step = 1 << 20  # tokens at once
            low = 0
            while low < batch.num_rows:
                high = max(int(np.searchsorted(edge, edge[low] + step, side="right")) - 1, low + 1)
                ids = np.asarray(lists.values)[base + edge[low] : base + edge[high]]
                if len(ids) and (ids.min() < 0 or ids.max() >= len(length) or not length[ids].all()):
                    raise ValueError("an id has no token")
                size = length[ids]
                sums = np.concatenate([[0], np.cumsum(size)])
                ends = sums[edge[low : high + 1] - edge[low]]
                raw = flat[_places(first[ids], size)] if len(ids) else np.zeros(0, np.uint8)
                made = pa.Array.from_buffers(
                    pa.binary(), high - low, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)]
                )
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), made], names=schema.names)
                low = high

    return df.mapInArrow(run, schema)


def round_trip_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token count and digests of ids and of the decoded bytes of each row of ``docs`` (doc_id, text)."""
    coded = encode(docs.select("doc_id", "text"), path, pattern, offsets=False)
    narrow = coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256).alias("ids_sha256"),
        "ids",
    )
    return decode(narrow, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
