"""N-gram Jaccard join by token-combination prefixes.

The tokens of a document are its distinct word shingles, as 64-bit hashes, in one order for all
documents: rare ones first, then frequent ones, by hash within each class. A document of n tokens
may lack at most m = n - ceil(t n) of them in any partner, so of m + l tokens from the front at least
l are shared; l is a quarter of m, and at least one. Rare tokens are indexed singly. Where they do not suffice, the prefix goes on into the
frequent class, whose tokens are dealt over sub-classes and indexed as pairs within a sub-class: k
tokens of one sub-class then stand for k - 1, and the prefix is extended until the sum reaches what is
needed. Two partners share l of these tokens and pairs, for the smaller l. How many documents hold a token is counted over all.

Equal sets are one node. Candidates are verified by exact intersection. In the buckets of pairs, which
copies may fill, each member is first compared with the bucket's first and last set. Buckets with members that are
still in different components and mostly the same sets are then put together, and of their members just those of
different components are compared, once for each pair, whose parity bitmaps differ in no more places than the two
sets may (each token in one set alone changes one place at most).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmart.llm.components import components
from visitmart.llm.shared import folder, remove, stored
from visitmart.llm.wordhash import mix, shingles, texts, unique_in_rows

#: A token in so many documents is frequent.
FREQUENT = 24
#: Most frequent tokens sent to the tasks; beyond, those in the fewest documents count as rare, which loses no link.
MOST_FREQUENT = 2_000_000
#: Below this size frequent tokens are indexed singly.
SMALL = 64
_FLUSH = 1_000_000
_SIEVE_BITS = 24
MAPS = [f"m{k}" for k in range(16)]  # a parity bitmap of 1024 places
_SEEN = 100_000  # rows a task remembers
STARS = 3  # rounds of comparing buckets with two of their sets
PLACES = 64  # buckets by which a set tells where it first meets another


def _tokens(batches: Iterator[pa.RecordBatch], n: int):
    """Slices of the batches with their rows' tokens: edge, token (ascending in a row), set id."""
    for part, found, _, _ in texts(batches):
        h, row = unique_in_rows(*shingles(found, n))
        count = np.bincount(row, minlength=part.num_rows)
        edge = np.concatenate([[0], np.cumsum(count)])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(0x632BE59BD9B4E019)))])
        ids = mix(sums[edge[1:]] - sums[edge[:-1]] + count.astype(np.uint64)).view(np.int64)
        yield part, edge, h, ids


def token_sets(docs: DataFrame, n: int) -> DataFrame:
    """All columns of ``docs`` but ``text``, n_shingles and set_id (null for an empty set) of every row."""
    names = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in names]).add("n_shingles", "long").add("set_id", "long")

    def run(batches):
        for part, edge, _, ids in _tokens(batches, n):
            count = np.diff(edge)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in names), pa.array(count), pa.array(ids, mask=count == 0)],
                names=[*names, "n_shingles", "set_id"],
            )

    return docs.mapInArrow(run, schema)


def frequent_tokens(docs: DataFrame, n: int, total: int, least: int, most: int) -> tuple[np.ndarray, int]:
    """Ascending heads of the tokens in at least ``least`` rows, and how many low bits they leave out.

    A head is a range number (the more tokens, the more ranges) and 32 bits more. Tasks sum equal tokens
    before sending them.
    """
    bits = max(6, (max(total, 1) >> 21).bit_length())
    drop = np.uint64(32 - bits)

    def count(batches):
        def flush(held):
            head, many = np.unique(np.concatenate(held) >> drop, return_counts=True)
            for lone in (True, False):
                kept = (many == 1) == lone
                part = (head[kept] >> np.uint64(32)).astype(np.int64)
                low = (head[kept] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                times = many[kept].astype(np.uint32)
                where = np.flatnonzero(np.diff(part, prepend=-1))
                for a, b in zip(where, np.append(where[1:], len(part))):
                    yield int(part[a]), low[a:b].tobytes(), b"" if lone else times[a:b].tobytes()

        def rows():
            held, size = [], 0
            for _, _, h, _ in _tokens(batches, n):
                held.append(h)
                size += len(h)
                if size >= _FLUSH:
                    yield list(flush(held))
                    held, size = [], 0
            if size:
                yield list(flush(held))

        for made in rows():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*made), (pa.int64(), pa.binary(), pa.binary()))],
                names=["part", "low", "times"],
            )

    def pick(group: pa.Table) -> pa.Table:
        low, times = [], []
        for a, b in zip(group.column("low").to_pylist(), group.column("times").to_pylist()):
            low.append(np.frombuffer(a, np.uint32))
            times.append(np.frombuffer(b, np.uint32) if b else np.ones(len(low[-1]), np.uint32))
        value, where = np.unique(np.concatenate(low), return_inverse=True)
        many = np.bincount(where, np.concatenate(times)).astype(np.int64)
        kept = many >= least
        head = (group.column("part")[0].as_py() << 32) + value[kept].astype(np.int64)
        return pa.table({"head": head, "many": many[kept]})

    counted = docs.select("doc_id", "text").mapInArrow(count, "part long, low binary, times binary")
    found = counted.groupBy("part").applyInArrow(pick, "head long, many long")
    heads = found.orderBy(F.desc("many"), "head").limit(most).select("head").toArrow().column("head")
    return np.sort(np.asarray(heads).astype(np.uint64)), int(drop)


def _pairs(tokens: np.ndarray, need: int, level: int) -> np.ndarray:
    """Signatures of the pairs within sub-classes of the shortest prefix that stands for ``need`` tokens."""
    classes = (mix(tokens ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64((1 << level) // 8)).astype(np.int64)
    again = np.ones(len(tokens), dtype=np.int64)
    again[np.unique(classes, return_index=True)[1]] = 0
    end = int(np.searchsorted(np.cumsum(again), need)) + 1
    order = np.argsort(classes[:end], kind="stable")
    kind, token, out = classes[:end][order], tokens[:end][order], []
    step = 1
    while step < end and (same := kind[step:] == kind[:-step]).any():
        left, right = token[:-step][same], token[step:][same]
        out.append(mix(mix(left) * np.uint64(0x9FB21C651E98DF25) + right + np.uint64(level)))
        step += 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shared_least(size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens may be lacking in a partner, and how many of so many more the two then share."""
    lacking = size - (percent * size + 99) // 100
    return lacking, np.minimum(1 + lacking // 4, size - lacking)


def signatures(edge: np.ndarray, h: np.ndarray, frequent: np.ndarray, percent: int):
    """(row, signature, whether it is of frequent tokens) of all prefixes, and l of each set."""
    size = np.diff(edge)
    row = np.repeat(np.arange(len(size)), size)
    many = np.bincount(row, frequent, minlength=len(size)).astype(np.int64)
    lacking, least = shared_least(size, percent)
    least = np.clip(size - many - lacking, np.minimum(1, least), least)  # no pairs are made for more than one
    need = lacking + least
    order = np.lexsort((frequent, row)) if frequent.any() else np.arange(len(h))  # stable: by hash within a class
    place = np.arange(len(h)) - np.repeat(edge[:-1], size)
    token, rare = h[order], ~frequent[order]
    lone = rare & (place < need[row])
    rows, sigs, heavy = [row[lone]], [token[lone]], [np.zeros(lone.sum(), bool)]
    for r in np.flatnonzero((size > 0) & (size - many < need)):
        common = token[edge[r + 1] - many[r] : edge[r + 1]]
        rest = int(need[r] - (size[r] - many[r]))
        own = int(size[r]).bit_length() - 1
        levels = [own] + [own + 1] * (int(size[r]) * 100 >= percent << (own + 1))
        if 1 << own < SMALL:
            made = [common[:rest]]
            levels = [x for x in levels if 1 << x >= SMALL]
        else:
            made = []
        made += [_pairs(common, rest, x) for x in levels]
        made = np.concatenate(made)
        rows.append(np.full(len(made), r))
        sigs.append(made)
        heavy.append(np.ones(len(made), bool))
    return np.concatenate(rows), np.concatenate(sigs), np.concatenate(heavy), least


_POSTING = "sig long, set_id long, n int, least int, heavy boolean"


def parity_maps(edge: np.ndarray, h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each of ``rows`` words of bits: whether an odd number of its tokens fall on the place."""
    size = np.diff(edge)
    number = np.full(len(size), -1)
    number[rows] = np.arange(len(rows))
    own = np.repeat(number, size)
    place = (mix(h + np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(54)).astype(np.int64)
    odd = np.bincount((own * 1024 + place)[own >= 0], minlength=1024 * len(rows)) & 1
    return np.packbits(odd.astype(bool).reshape(len(rows), 1024), axis=1).view(np.int64)


def _postings(docs: DataFrame, n: int, percent: int, heads: np.ndarray, drop: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(heads)  # at most MOST_FREQUENT

    def run(batches):
        frequent, seen = sent.value, set()
        for _, edge, h, ids in _tokens(batches, n):
            if len(seen) > 200_000:
                seen.clear()
            new = np.zeros(len(ids), dtype=bool)
            for i, x in enumerate(ids.tolist()):  # a copy adds nothing
                if edge[i] < edge[i + 1] and x not in seen:
                    seen.add(x)
                    new[i] = True
            size = np.diff(edge)
            kept = np.repeat(new, size)
            size, ids, h = size[new], ids[new], h[kept]
            edge = np.concatenate([[0], np.cumsum(size)])
            head = h >> np.uint64(drop)
            flag = np.zeros(len(h), dtype=bool)
            if len(frequent):
                flag = frequent[np.minimum(np.searchsorted(frequent, head), len(frequent) - 1)] == head
            row, sig, heavy, least = signatures(edge, h, flag, percent)
            # the shared signatures of a set without pairs are all in the light buckets
            paired = np.unique(row[heavy])
            least[paired] = 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sig.view(np.int64)),
                    pa.array(ids[row]),
                    pa.array(size[row].astype(np.int32)),
                    pa.array(least[row].astype(np.int32)),
                    pa.array(heavy),
                ],
                names=["sig", "set_id", "n", "least", "heavy"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, _POSTING)


def _sizes_fit(percent: int):
    return F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent


def _side(df: DataFrame, name: str, *more) -> DataFrame:
    """One side of a join on ``sig``: the set as ``name``, and its other columns with that prefix."""
    rest = df.select("sig", "set_id", "n", *more)
    return rest.toDF("sig", name, *(f"{name}_{c}" for c in rest.columns[2:]))


def _maps_fit(percent: int):
    """Whether the bitmaps differ in no more places than sets of these sizes may."""
    differ = sum((F.bit_count(F.col(f"a_{m}").bitwiseXOR(F.col(f"b_{m}"))) for m in MAPS), F.lit(0))
    return differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)


def _tokens_of(docs: DataFrame, sets: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """set_id, tokens and parity bitmap of the sets in ``wanted`` (set_id), each from one of its rows."""
    spark = docs.sparkSession
    picks = stored(
        sets.join(wanted, "set_id").groupBy("set_id").agg(F.min(F.coalesce("doc_id", F.lit(0))).alias("pick")), "picks"
    )
    # one bit for each picked row, in a bitmap of fixed size, spares moving the other rows' tokens
    bit = F.shiftrightunsigned(F.col("set_id").bitwiseXOR(F.shiftleft("pick", 64 - _SIEVE_BITS)), 64 - _SIEVE_BITS)
    rows = (
        picks.select(bit.alias("bit"))
        .groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
        .collect()
    )
    sieve = np.zeros((1 << _SIEVE_BITS) // 8 + 4096, dtype=np.uint8)
    for r in rows:  # value v is bit v - 1; bucket k from 1 on has 32768 bits, and bucket 0 just value 0
        low = 4096 * (r.bucket - 1) if r.bucket else 0
        sieve[low : low + 4096] |= np.frombuffer(bytes(r.bits), np.uint8)
    sent = spark.sparkContext.broadcast(sieve)

    def run(batches):
        for part, edge, h, ids in _tokens(batches, n):
            pick = np.asarray(part.column("doc_id").fill_null(0)).astype(np.int64)
            drop = np.uint64(64 - _SIEVE_BITS)
            bit = ((ids.view(np.uint64) ^ (pick.view(np.uint64) << drop)) >> drop).astype(np.int64)
            size = np.diff(edge)
            keep = _bit_is_set(sent.value, np.maximum(bit - 1, 0)) & (size > 0)
            edges = np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(h[np.repeat(keep, size)].view(np.int64)))
            maps = parity_maps(edge, h, np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pick[keep]), pa.array(ids[keep]), lists, *map(pa.array, maps.T)],
                names=["pick", "set_id", "tokens", *MAPS],
            )

    schema = "pick long, set_id long, tokens array<long>, " + ", ".join(f"{m} long" for m in MAPS)
    held = docs.mapInArrow(run, schema).join(picks, ["set_id", "pick"], "left_semi")
    return stored(held.groupBy("set_id").agg(F.first(F.struct("tokens", *MAPS)).alias("held")).select("set_id", "held.*"), "tokens")


def _merged(apart: DataFrame) -> DataFrame:
    """Rows of ``apart`` (sig, set_id, ...) by group in place of sig: buckets with mostly the same sets are one group.

    Buckets with the same set of lowest hash are put together where the pairs of all their sets are no more than the
    pairs bucket by bucket; a group of near copies, which fills many buckets, is then compared about once.
    """
    least = F.min(F.struct(F.xxhash64("set_id").alias("h"), "set_id"))["set_id"].alias("owner")
    buckets = apart.groupBy("sig").agg(least, (F.count("*") * (F.count("*") - 1)).alias("apart_pairs"))
    owned = apart.join(buckets.select("sig", "owner"), "sig").select("owner", "set_id").distinct()
    joint = owned.groupBy("owner").agg((F.count("*") * (F.count("*") - 1)).alias("joint_pairs"))
    sums = buckets.groupBy("owner").agg(F.sum("apart_pairs").alias("apart_pairs")).join(joint, "owner")
    whole = buckets.join(sums.where("joint_pairs <= apart_pairs").select("owner", F.lit(True).alias("joint")), "owner", "left")
    place = F.when(F.col("joint"), F.xxhash64(F.lit("joint"), "owner")).otherwise(F.col("sig")).alias("place")
    groups = whole.select("sig", place)
    return stored(apart.join(groups, "sig").drop("sig").dropDuplicates(["place", "set_id"]).withColumnRenamed("place", "sig"), "apart")


def _with_places(apart: DataFrame) -> DataFrame:
    """``apart`` with the first ``PLACES`` of each set's buckets in ascending order."""
    bucket = W.partitionBy("set_id").orderBy("sig")
    firsts = apart.select("set_id", "sig", F.row_number().over(bucket).alias("number")).where(F.col("number") <= PLACES)
    return apart.join(firsts.groupBy("set_id").agg(F.sort_array(F.collect_list("sig")).alias("places")), "set_id")


def _met_first():
    """Whether the bucket is the first that both sets are in, as far as ``places`` tell.

    Both lists hold a set's first buckets; if they have any in common, the least of these is the first of all.
    """
    return F.coalesce(F.array_min(F.array_intersect("a_places", "b_places")) == F.col("sig"), F.lit(True))


def _bit_is_set(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _verify(held: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, ...) whose sets, in ``held``, are similar."""
    left = held.select(F.col("set_id").alias("a"), F.col("tokens").alias("a_tokens"))
    right = held.select(F.col("set_id").alias("b"), F.col("tokens").alias("b_tokens"))
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    compared = (
        pairs.join(right, "b")
        .join(left, "a")
        .select(*pairs.columns, both.alias("both"), (F.size("a_tokens") + F.size("b_tokens")).alias("n"))
    )
    return stored(compared.where(F.col("both") * 100 >= (F.col("n") - F.col("both")) * percent).select(pairs.columns), "links")


def _by_set(rows: DataFrame, *more: str) -> DataFrame:
    """One row per set of ``rows`` (sig, set_id, n, ...), with its buckets as ``sigs``; ``more`` columns follow from the set."""
    same = [F.first(c).alias(c) for c in ("n", *more)]
    return rows.groupBy("set_id").agg(*same, F.collect_list("sig").alias("sigs"))


def _linked(comps: DataFrame, edges: DataFrame) -> DataFrame:
    """``comps`` after ``edges`` (a, b) between its components, or sets that are in none of them, have joined these."""
    step = components(edges)
    told = comps.join(step.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
    told = told.select("node", F.coalesce("to", "comp").alias("comp"))
    return stored(told.unionByName(step.join(comps.select("node"), "node", "left_anti")), "components")


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    A set holds the distinct runs of ``n`` words (A-Z as a-z); a text with fewer words is one run, a null, empty or
    blank one has no set and stands alone. Rows are linked when ``100 * intersection >= percent * union``; a component
    is named by its smallest doc_id. Repeated rows and ids keep a row each. No rows give no rows; further columns are
    not read.
    """
    return _named(*_sets_and_components(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), n, percent))


def _sets_and_components(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``token_sets`` of ``docs``, and the component (comp) of each linked set (node)."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    spark = docs.sparkSession
    sets = stored(token_sets(docs, n), "sets")
    docs = docs.select("doc_id", "text")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    heads, drop = frequent_tokens(docs, n, total, FREQUENT, MOST_FREQUENT)
    path = folder(spark, "postings")
    _postings(docs, n, percent, heads, drop).write.parquet(path)
    try:
        postings = spark.read.schema(_POSTING).parquet(path)
        bucket = W.partitionBy("sig")
        light = stored(
            postings.where("NOT heavy")
            .select("sig", "set_id", "n", "least", F.min("set_id").over(bucket).alias("low"), F.max("set_id").over(bucket).alias("high"))
            .where("low < high")
            .select("sig", "set_id", "n", "least")
            .distinct(),
            "light",
        )
        heavy = postings.where("heavy").select("sig", "set_id", "n").dropDuplicates(["sig", "set_id"])
        shared = heavy.groupBy("sig").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low < high")
        heavy = stored(heavy.join(shared.select("sig"), "sig", "left_semi"), "heavy")
    finally:
        remove(spark, path)

    within = (
        _side(light, "a", F.col("least"))
        .join(_side(light, "b", F.col("least")), "sig")
        .where((F.col("a") < F.col("b")) & _sizes_fit(percent))
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"), F.max("a_least").alias("a_least"), F.max("b_least").alias("b_least"))
        # 0 marks a set with pairs: then the number may be that set's, and more may be shared in pairs
        .where(
            F.when((F.col("a_least") == 0) | (F.col("b_least") == 0), F.col("shared") >= 1).otherwise(
                F.col("shared") >= F.least("a_least", "b_least")
            )
        )
    )
    pairs = stored(within.select("a", "b"), "pairs")
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).union(heavy.select("set_id")).distinct()
    held = _tokens_of(docs, sets, wanted, n)
    comps = components(_verify(held, pairs, percent))
    apart = _by_set(heavy)
    for turn in range(STARS + 1):
        # what is known of a set is joined to its one row, not to a row for each of its buckets
        known = comps.select(F.col("node").alias("set_id"), "comp")
        placed = apart.select("set_id", "n", "sigs").join(known, "set_id", "left")
        placed = placed.select(F.explode("sigs").alias("sig"), "set_id", "n", F.coalesce("comp", "set_id").alias("comp"))
        mixed = placed.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
        apart = _by_set(placed.join(mixed.select("sig"), "sig", "left_semi"), "comp")
        apart = stored(apart.join(held.drop("tokens"), "set_id"), "apart")
        if apart.isEmpty():
            break
        members = apart.select(F.explode("sigs").alias("sig"), "set_id", "n", "comp", *MAPS)
        fit = _sizes_fit(percent) & _maps_fit(percent)
        more = [F.col("comp"), *map(F.col, MAPS)]
        if turn < STARS:
            whole = F.struct(F.xxhash64("set_id", F.lit(turn)).alias("h"), "set_id", "n", "comp", *MAPS)
            ends = members.groupBy("sig").agg(F.min(whole).alias("low"), F.max(whole).alias("high"))
            ends = ends.select("sig", F.explode(F.array("low", "high")).alias("e")).select("sig", "e.*")
            fit = (F.col("a_comp") != F.col("b_comp")) & fit
        else:
            members = ends = _with_places(_merged(members.drop(*MAPS))).join(held.drop("tokens"), "set_id")
            more.append(F.col("places"))
            fit = (F.col("a_comp") < F.col("b_comp")) & fit & _met_first()
        met = _side(members, "a", *more).join(_side(ends, "b", *more), "sig").where(fit)
        met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "a_comp", "b_comp")
        fresh = stored(met.dropDuplicates(["a", "b"]).join(pairs, ["a", "b"], "left_anti"), "pairs")
        pairs = pairs.union(fresh.select("a", "b"))
        found = _verify(held, fresh, percent)
        if not found.isEmpty():
            comps = _linked(comps, found.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")))
    return sets, comps


def _named(sets: DataFrame, comps: DataFrame) -> DataFrame:
    """The smallest doc_id of each row's component."""
    own = sets.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"))
    placed = own.join(comps.select(F.col("node").alias("set_id"), "comp"), "set_id", "left")
    linked = placed.where((F.col("copies") > 1) | F.col("comp").isNotNull())
    linked = linked.select("set_id", "low", F.coalesce("comp", "set_id").alias("comp"))
    least = linked.groupBy("comp").agg(F.min("low").alias("component"))
    named = linked.join(least, "comp").select("set_id", "component")
    out = sets.join(named, "set_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _with_sets(rows: DataFrame, n: int, row_name: str, set_name: str) -> DataFrame:
    """``rows`` with the set of their text in ``set_name``.

    A row equal in id, set and ``row_name`` to one that its task has just seen is left out. Empty sets, which have
    no equals, get numbers in ``row_name`` that spread them.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField(set_name, T.LongType())])

    def run(batches):
        seen: set = set()
        for part, edge, _, ids in _tokens(batches, n):
            empty = np.diff(edge) == 0
            digest = np.asarray(part.column(row_name)).copy()
            digest[empty] = np.arange(len(digest))[empty]
            keys = list(zip(part.column("doc_id").to_pylist(), ids.tolist(), digest.tolist()))
            keep = np.ones(len(keys), dtype=bool)
            for k in np.flatnonzero(~empty):
                keep[k] = keys[k] not in seen
                seen.add(keys[k])
            if len(seen) > _SEEN:
                seen.clear()
            columns = dict(zip(part.schema.names, part.columns))
            columns |= {row_name: pa.array(digest), set_name: pa.array(ids, mask=empty)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)).filter(pa.array(keep))

    return rows.mapInArrow(run, schema)


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` of each component, all columns unchanged.

    Rows are judged by their texts' sets and not by their ids: the row that stays has the component's smallest doc_id (null
    last), then the smallest set and the smallest hash of all its columns. Of rows equal in all columns one stays. Rows
    without a set (null, empty and blank texts) have no equals and stay.
    """
    own = "near"  # work columns have names that no column of ``docs`` begins with
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    row_name, set_name = f"{own}_row", f"{own}_set"
    hashed = [f"`{f.name}`" for f in docs.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    rows = docs.withColumn(row_name, F.xxhash64(*hashed))
    slim = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(row_name).alias("near_row"))
    sets, comps = _sets_and_components(slim, n, percent)
    # equal rows are summed first, so a text that fills a third of the rows is one row here
    each = sets.where("set_id IS NOT NULL").groupBy("set_id", "doc_id", "near_row").agg(F.count("*").alias("times"))
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "set_id", "near_row", "times")).alias("first")
    placed = each.groupBy("set_id").agg(first).join(comps.select(F.col("node").alias("set_id"), "comp"), "set_id", "left")
    best = placed.groupBy(F.coalesce("comp", "set_id").alias("comp")).agg(F.min("first").alias("first"))
    best = stored(best.select("first.*").withColumn("stays", F.lit(True)), "best")
    best = best.toDF(*(f"{own}_b_{c}" for c in ("no_id", "doc_id", "set", "row", "times", "stays")))
    told = _with_sets(rows, n, row_name, set_name)
    # an id of null is compared as 0 beside a flag, so that both sides are dealt by all of the key
    same = (
        (F.col(set_name) == F.col(f"{own}_b_set"))
        & (F.col(row_name) == F.col(f"{own}_b_row"))
        & (F.coalesce(F.col("doc_id").cast("long"), F.lit(0)) == F.coalesce(f"{own}_b_doc_id", F.lit(0)))
        & (F.isnull("doc_id") == F.col(f"{own}_b_no_id"))
    )
    names = [F.col(f"`{c}`") for c in docs.columns]
    once = best.where(F.col(f"{own}_b_times") == 1)
    kept = told.join(once, same, "left").where(F.col(set_name).isNull() | F.col(f"{own}_b_stays")).select(names)
    again = best.where(F.col(f"{own}_b_times") > 1)
    if not again.isEmpty():
        more = told.join(again, same).dropDuplicates([set_name, row_name, "doc_id"])
        kept = kept.unionByName(more.select(names))
    return kept
