"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words under a fixed mask; positions the mask ignores may be substituted.
The seeds of the test items are joined to those of every document position, in blocks of items of
bounded size, and each hit is verified on its diagonal: some ``WINDOW`` neighbouring words of the
item (all, if it has fewer) must agree in ``SHARE`` of their places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.wordhash import Words, mix, texts, words

#: Six of up to twelve neighbouring words each.
MASKS = ("1110111", "11010010011", "10101100011", "110001011001")
#: Five words each, for items of ``SHORT`` words; with them every pattern of agreeing words that is accepted is hit.
SHORT_MASKS = ("11111", "1101011", "11100101")
SHORT = range(7, 12)
#: Items of fewer words are reported, but too common in clean texts to remove a document.
LEAST_TO_REMOVE = 3
WINDOW = 13
SHARE = 0.8
_SIEVE_BITS = 20


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def _seeds(found: Words, mask: list[int], tag: int) -> tuple[np.ndarray, np.ndarray]:
    """Seed of each place where the mask fits into a text, and the place (number of its first word)."""
    count = np.diff(found.first)
    fits = np.maximum(count - mask[-1], 0)
    row = np.repeat(np.arange(len(count)), fits)
    place = np.arange(len(row)) - np.repeat(np.cumsum(fits) - fits, fits) + found.first[:-1][row]
    h = np.full(len(place), tag + 1, dtype=np.uint64)
    for k in mask:
        h = h * np.uint64(0x9FB21C651E98DF25) + found.hash[place + k]
    return mix(h), place


@dataclass
class Block:
    """Items' words, and their seeds in order with the item and the place inside it."""

    item: np.ndarray
    words: np.ndarray
    first: np.ndarray
    masks: list[list[int]]
    seed: np.ndarray
    seed_item: np.ndarray
    seed_place: np.ndarray
    sieve: np.ndarray


def index_items(item: np.ndarray, texts_: list[str]) -> Block:
    """Seeds of a block. An item shorter than the shortest mask has one seed: all of its words."""
    raw = [t.encode() for t in texts_]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    found = words(np.frombuffer(b"".join(raw), dtype=np.uint8), starts)
    count = np.diff(found.first)
    shortest = min(map(len, MASKS))
    sizes = {int(n) for n in count}
    # masks, and the sizes of the items they are for (None: any)
    masks = [(_offsets(m), None) for m in MASKS]
    if not sizes.isdisjoint(SHORT):  # texts are not searched by masks that no item needs
        masks += [(_offsets(m), SHORT) for m in SHORT_MASKS]
    masks += [(list(range(n)), [n]) for n in sorted(sizes) if 0 < n < shortest]
    parts = []
    for tag, (mask, of) in enumerate(masks):
        seed, place = _seeds(found, mask, tag)
        owner = np.searchsorted(found.first, place, side="right") - 1
        if of is not None:
            keep = np.isin(count[owner], list(of))
            seed, place, owner = seed[keep], place[keep], owner[keep]
        parts.append((seed, owner, place - found.first[owner]))
    seed, owner, place = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(seed, kind="stable")
    sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
    sieve[(seed >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)] = True
    return Block(item, found.hash, found.first, [m for m, _ in masks], seed[order], owner[order], place[order], sieve)


def overlaps(found: Words, block: Block):
    """Verified overlaps: row, item number, agreeing words in the best window and in all, first word in the text."""
    hits = []
    for tag, mask in enumerate(block.masks):
        seed, place = _seeds(found, mask, tag)
        maybe = np.flatnonzero(block.sieve[(seed >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)])
        low = np.searchsorted(block.seed, seed[maybe], side="left")
        many = np.searchsorted(block.seed, seed[maybe], side="right") - low
        at = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
        word = np.repeat(place[maybe], many)
        row = np.searchsorted(found.first, word, side="right") - 1
        # the last value: the word of the text under the item's first one, which may lie before the text
        hits.append(np.stack([row, block.seed_item[at], word - block.seed_place[at]], 1))
    row, item, begin = np.unique(np.concatenate(hits), axis=0).T
    if not len(row):
        return (np.zeros(0, dtype=np.int64),) * 5
    size = np.diff(block.first)[item]
    edge = np.cumsum(size) - size
    k = np.arange(size.sum()) - np.repeat(edge, size)
    at = np.repeat(begin, size) + k
    inside = (at >= np.repeat(found.first[row], size)) & (at < np.repeat(found.first[row + 1], size))
    same = np.zeros(len(at), dtype=bool)
    same[inside] = found.hash[at[inside]] == block.words[(np.repeat(block.first[item], size) + k)[inside]]
    sums = np.concatenate([[0], np.cumsum(same)])
    window = np.minimum(size, WINDOW)
    width = np.repeat(window, size)
    whole = k + width <= np.repeat(size, size)
    in_window = np.where(whole, sums[np.minimum(np.arange(len(at)) + width, len(at))] - sums[:-1], 0)
    best = np.maximum.reduceat(in_window, edge)
    good = best >= np.ceil(SHARE * window)
    total = sums[edge + size] - sums[edge]
    return row[good], item[good], best[good], total[good], begin[good] - found.first[row[good]]


SCHEMA = "doc_id long, item_id long, window_words int, agreeing_words int, item_words int, start_word int"


def find_overlaps(docs: DataFrame, items: DataFrame, block_items: int = 20_000) -> DataFrame:
    """Each verified overlap of a row of ``docs`` (doc_id, text) with an item (item_id, text).

    Words are compared with A-Z as a-z. ``window_words`` of the best ``WINDOW`` neighbouring words and
    ``agreeing_words`` of all ``item_words`` agree; ``start_word`` is where the item begins in the text (below
    zero if its head is cut off). An item of fewer than seven words must occur whole. Null and empty texts
    overlap with nothing; repeated rows and items each give their own rows. Items go to the tasks in blocks
    of about ``block_items`` with one pass over ``docs`` each, so no task holds more than a block.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    blocks = -(-items.count() // block_items)
    out = spark.createDataFrame([], SCHEMA)
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        if not rows:
            continue
        sent = spark.sparkContext.broadcast(index_items(np.array([r.item_id for r in rows], dtype=object), [r.text for r in rows]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for part, found, _, _ in texts(batches):
                row, item, best, total, begin = overlaps(found, block)
                size = np.diff(block.first)[item]
                ids = part.column("doc_id").take(pa.array(row))
                numbers = [pa.array(x.astype(np.int32)) for x in (best, total, size, begin)]
                names = pa.array(list(block.item[item]), type=pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, names, *numbers],
                    names=["doc_id", "item_id", "window_words", "agreeing_words", "item_words", "start_word"],
                )

        out = out.unionByName(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA))
    return out


def clean_documents(docs: DataFrame, items: DataFrame, block_items: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that overlap with no item of at least ``LEAST_TO_REMOVE`` words, all columns unchanged.

    Shorter items ('yes', '42') stand in clean texts too and are left to ``find_overlaps``. A row is judged by its own text, so equal or null ids do not matter.
    """
    spark = docs.sparkSession
    items = items.select("item_id", "text").where("text IS NOT NULL")
    blocks = -(-items.count() // block_items)
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        if not rows:
            continue
        sent = spark.sparkContext.broadcast(index_items(np.arange(len(rows)), [r.text for r in rows]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for part, found, _, _ in texts(batches):
                keep = np.ones(part.num_rows, dtype=bool)
                row, item, *_ = overlaps(found, sent.value)
                keep[row[np.diff(sent.value.first)[item] >= LEAST_TO_REMOVE]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
