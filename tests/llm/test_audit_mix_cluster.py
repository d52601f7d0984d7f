"""Clustering over zone maps, the filter audit and entropy-balanced mixing, against plain versions written here."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from visitmart.llm import interactions, mixing, zonemaps
from visitmart.llm.shared import importable, stored

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module", autouse=True)
def session(spark):
    importable(spark)


def plain_clusters(rows, k=8, rounds=10):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest) of every usable row, in Python integers."""
    good = lambda v: v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(x) < 1000 for x in v)
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if good(v)]
    named = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted((named(i), v) for i, v in kept)[:k]]
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min((apart(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = Counter()
    for _, n, d in last:
        own[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, n, d, own[n], sum(own.values()), digest[n]) for i, n, d in last)


VECTORS = "vec_id long, embedding array<float>, key string, vec int, ids int, cluster string"


def vector_rows(seed, n, groups=6):
    r = np.random.default_rng(seed)
    middles = r.standard_normal((groups, 64))
    return [(i, [float(np.float32(x)) for x in middles[i % groups] + 0.05 * r.standard_normal(64)]) for i in range(n)]


def clustered(spark, rows):
    frame = spark.createDataFrame([(i, v, "x", 1, 2, "y") for i, v in rows], VECTORS).repartition(5)
    return Counter(tuple(r) for r in zonemaps.cluster(frame).collect())


def test_clusters_equal_whole_number_rounds(spark):
    rows = vector_rows(1, 700)
    rows += [rows[3]] * 300 + [(5000 + i, rows[4][1]) for i in range(300)]  # repeated rows, and copies
    rows += [(None, rows[7][1]), (None, None), (9001, None), (9002, []), (9003, [0.5] * 63), (9004, [0.5] * 65)]
    bad = [math.nan, math.inf, -math.inf, None, 3e38]
    rows += [(9100 + i, [x] + [0.25] * 63) for i, x in enumerate(bad)]
    rows += [(9200, [0.0] * 64), (9201, [-0.0] * 64)]
    assert clustered(spark, rows) == plain_clusters(rows)


def test_few_equal_or_no_vectors(spark):
    few = vector_rows(2, 5)
    assert clustered(spark, few) == plain_clusters(few)
    same = [(i, [0.125] * 64) for i in range(40)]  # all ties go to centroid 0
    got = clustered(spark, same)
    assert got == plain_clusters(same) and {row[1] for row in got} == {0}
    assert not clustered(spark, []) and not clustered(spark, [(1, None)])


def test_boxes_exclude_only_hopeless_centroids():
    r = np.random.default_rng(3)
    for _ in range(200):
        points = r.integers(-50, 50, (20, 4)) + r.integers(-100, 100, 4)
        centroids = r.integers(-100, 100, (8, 4))
        near = set(zonemaps.candidates(points.min(axis=0), points.max(axis=0), centroids).tolist())
        distance = ((points[:, None] - centroids) ** 2).sum(axis=2)
        ties = {int(c) for row in distance for c in np.flatnonzero(row == row.min())}
        assert ties <= near


def test_blocks_of_grouped_vectors_spare_comparisons(spark):
    rows = spark.createDataFrame([(i, v, "x", 1, 2, "y") for i, v in vector_rows(4, 4000)], VECTORS)
    whole = zonemaps.whole_vectors(rows)
    blocks = stored(zonemaps.hilbert_blocks(whole, 64), "blocks")
    assert sorted(i for r in blocks.collect() for i in r.ids) == list(range(4000))
    _, compared = zonemaps.move(blocks, zonemaps.first_centroids(whole, 8, "3"))
    assert compared < 0.6 * 8 * 4000


def plain_audit(docs, labels):
    """The rows of the report, by walking every document through every order."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = Counter()
    parts = {s or "" for _, _, s in docs}
    for order in permutations("ABCDE"):
        for i, text, source in docs:
            text = text or ""
            w = WORD.findall(text)
            fails = {
                "A": len(w) < 200,
                "B": 100 * len(set(w)) < 50 * len(w),
                "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                "D": bool(re.search("[#$%&*|]", text)),
                "E": i is not None and i > first[text],
            }
            gone = False
            for letter in order:
                at = (source or "", "".join(order), letter)
                if fails[letter] and not gone:
                    out[at, "removed"] += 1
                    out[at, "good_lost"] += i in good
                    out[at, "toxic_lost"] += i in toxic
                out[at, "redundant"] += fails[letter] and gone
                out[at, "unique_fails"] += fails[letter] and sum(fails.values()) == 1
                gone = gone or fails[letter]
                out[at, "kept"] += not gone
    orders = ["".join(o) for o in permutations("ABCDE")]
    shapley = Counter()
    for p in parts:
        for o in orders:
            for letter in o:
                shapley[p, letter] += out[(p, o, letter), "removed"]
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {(p, o, s + 1, *(out[(p, o, c), n] for n in names), shapley[p, c]) for p in parts for o in orders for s, c in enumerate(o)}


DOCS = "doc_id long, text string, source string, digest string, mask string, part int, n int, good int, size string, copies int"
LABELS = "doc_id long, quality int, toxic int, key string"


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", "y", 1, 2, 3, "z", 4) for d in docs], DOCS).repartition(4)


def audited(spark, docs, labels):
    rows = interactions.audit(frame(spark, docs), spark.createDataFrame([(*x, "k") for x in labels], LABELS)).collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


def test_audit_equals_walking_every_order(spark):
    r = random.Random(5)
    long = " ".join(f"w{k}" for k in range(5000))
    docs = [(1, None, "a"), (2, "", None), (3, "", "a"), (4, " \n\t", ""), (5, long, "b"), (6, long + " #", "b"), (None, long, None), (None, "", "a")]
    for i in range(150):
        text = " ".join(r.choice(["aa", "Bb", "CCC", "d%", "eé", f"x{r.randint(0, 400)}"]) for _ in range(r.choice([3, 150, 199, 200, 320])))
        docs.append((100 + i, text, r.choice(["a", "b", None, "c"])))
    docs += [(1000 + k, docs[20][1], "a") for k in range(200)]  # copies of one text
    docs += [docs[30]] * 50 + [(docs[31][0], docs[32][1], "c")]  # repeated rows, and an id of two texts
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(90, 260)] + [(110, 1, 0), (110, 0, 1), (None, 1, 1)]
    assert audited(spark, docs, labels) == plain_audit(docs, labels)
    assert audited(spark, docs[:40], []) == plain_audit(docs[:40], [])
    assert audited(spark, [], labels) == set()


def test_packed_fields_do_not_carry():
    letters = "ABCDE"
    table, many = interactions.packed(letters), (1 << 58) - 1
    total = sum(many * value for value in table)
    fields = interactions.unpacked(total, letters)
    apart = sum(many * interactions.unpacked(value, letters).astype(object) for value in table)
    assert fields.tolist() == list(apart) and fields[1200] == 32 * many
    # every order removes a failing document once, and repeats its other failures
    for mask, value in enumerate(table):
        f = interactions.unpacked(value, letters)
        assert f[:600].sum() == (120 if mask else 0) and f[600:1200].sum() == 120 * max(mask.bit_count() - 1, 0)


def plain_targets(sizes, most=3):
    """Target of each source by raising the level until all words are given out."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    free, target = dict(weight), {}
    left = sum(sizes.values())
    while free:
        level = left / sum(free.values())
        above = [s for s in free if free[s] * level > most * sizes[s]]
        if not above:
            return target | {s: w * level for s, w in free.items()}
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
            del free[s]
    return target


def mixed(spark, docs):
    return [tuple(r) for r in mixing.mix(frame(spark, docs)).collect()]


def test_mix_meets_targets_by_exponential_tilts(spark):
    r = random.Random(6)
    docs = [(1, None, "a"), (2, "", None), (3, " \n", "z"), (None, "one two", "a"), (None, None, None), (4, "w " * 30_000, "b")]
    docs += [(10 + i, "w " * int(r.paretovariate(1.1) * 20), r.choice(["a", "b", "B", "é", None, "c", "c", "c", "c"])) for i in range(900)]
    docs += [docs[20]] * 700 + [(5000 + i, "same words here", "c") for i in range(900)]  # repeated rows, and a hot class
    docs += [(9000, "tiny", "aa")]
    rows = mixed(spark, docs)
    assert sorted(rows, key=repr) == sorted(mixed(spark, list(reversed(docs))), key=repr)  # reruns agree
    words = lambda t: len(WORD.findall(t or ""))
    assert Counter((x[0], x[1], x[2]) for x in rows) == Counter((i, s, words(t)) for i, t, s in docs)
    sizes = Counter({s: 0 for _, _, s in docs})
    for _, t, s in docs:
        sizes[s] += words(t)
    want, got, count = plain_targets(sizes), Counter(), Counter()
    for i, s, size, source_size, target, rate, copies, taken in rows:
        assert source_size == sizes[s] and target == pytest.approx(want[s]) and taken == copies * size <= 3 * size
        assert 0 <= rate <= 3 + 1e-9
        got[s] += taken
        count[s] += rate * size
    for s in sizes:
        least = min([words(t) for _, t, x in docs if x == s and words(t)], default=0)
        assert count[s] == pytest.approx(want[s], rel=1e-6)  # the rates meet the constraint
        assert abs(got[s] - want[s]) <= max(least, 0.001 * want[s])  # and so, nearly, do whole copies
        tilted = {(size, rate) for _, x, size, _, target, rate, *_ in rows if x == s and size and 1e-9 < rate < 3 * (1 - 1e-9)}
        slopes = [math.log(rate) / size for size, rate in tilted if rate > 1e-200]
        if want[s] < 3 * sizes[s] and slopes:
            assert max(slopes) - min(slopes) <= 1e-9 * max(1, max(map(abs, slopes)) * 1e3)


def test_mix_of_nothing_and_of_empty_texts(spark):
    assert mixed(spark, []) == []
    rows = mixed(spark, [(1, None, "a"), (2, "", "b"), (2, "", "b")])
    assert sorted((x[0], x[1], x[2], x[4], x[7]) for x in rows) == [(1, "a", 0, 0.0, 0), (2, "b", 0, 0.0, 0), (2, "b", 0, 0.0, 0)]
