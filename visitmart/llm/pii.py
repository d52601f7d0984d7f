"""Personal data by a semi-Markov conditional random field, beside exact patterns.

A region is a run of neighbouring words with a digit or an @, over lone dots too. Segments of a region, up to ``LONGEST``
tokens, are scored as wholes: how many digits, dots and @ they have, their shape, checksum, both ends
and both neighbours. Dynamic programming over bounded entities chooses boundaries and kinds together;
every other token is outside. The weights maximise the likelihood of what the patterns mark in a
bounded sample of regions. The patterns' own spans always stay; the field adds spans that touch none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmart.llm.wordhash import pieces, text_bytes

# The kinds in the order of the report.
KINDS = ("email", "ip", "card", "phone")
LONGEST = 16
ADJACENT = -2.0  # score of an entity right after another

_TRIGGER = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (right := _DOMAIN.match(text, at + 1)):
            done = right.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in _CHAIN.finditer(text):
        parts = list(_PART.finditer(text, chain.start(), chain.end()))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            if all(len(d := p[0].lstrip("0")) <= 3 and int(d or 0) <= 255 for p in four):
                yield four[0].start(), four[3].end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the patterns' matches, leftmost and non-overlapping in each kind."""
    if not _TRIGGER.search(text):
        return []
    out = [(0, *s) for s in _emails(text)] + [(1, *s) for s in _addresses(text)]
    for m in _CARD.finditer(text):
        if len(m[0]) >= 16 and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Runs of words with a digit or an @, joined over single spaces and lone dots."""
    done, size = 0, len(text)
    start = end = -1
    hit = _TRIGGER.search(text)
    while hit:
        low = hit.start()
        while low > done and not text[low - 1].isspace():
            low -= 1
        high = hit.end()
        while high < size and not text[high].isspace():
            high += 1
        if start >= 0 and (low - end <= 1 or text[end:low] == " . "):
            end = high
        else:
            if start >= 0:
                yield start, end
            start, end = low, high
        done = high
        hit = _TRIGGER.search(text, done)
    if start >= 0:
        yield start, end


def _around(char: str) -> int:
    if not char:
        return 0
    if char.isspace():
        return 1
    if char.isdigit():
        return 2
    if char.isalpha():
        return 3
    return 4 + ".,;:@+-()/&%$#*_".find(char) + 1


_SIZES = (3 * 6, 25 * 2, 21 * 21, 21 * 21, 6 * 7 * 2, 2 * 6, 3, LONGEST + 1, 16)
_SHIFTS = np.concatenate([[0], np.cumsum(_SIZES)])
FEATURES = int(_SHIFTS[-1])


@dataclass
class Lattice:
    """Tokens of a region and its candidate segments, in the order of their ends."""

    bounds: np.ndarray
    outside: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray


def lattice(text: str, start: int, end: int) -> Lattice | None:
    """None, if no segment can be an entity: such has an @, at least seven digits, or (an address) four runs of digits."""
    tokens = list(_TOKEN.finditer(text, start, end))
    n = len(tokens)
    kind = np.array([_around(t[0][0]) for t in tokens])
    length = np.array([t.end() - t.start() for t in tokens])
    count = lambda where: np.concatenate([[0], np.cumsum(np.where(where, length, 0))])
    runs = lambda where: np.concatenate([[0], np.cumsum(where)])
    char = lambda c: np.array([t[0] == c for t in tokens])
    digit = kind == 2
    digits, ats, dots = count(digit), count(char("@")), count(char("."))
    i = np.repeat(np.arange(n), LONGEST)
    j = i + np.tile(np.arange(1, LONGEST + 1), n)
    keep = j <= n
    i, j = i[keep], j[keep]
    of = lambda sums: sums[j] - sums[i]
    solid = np.array([not t[0].isspace() for t in tokens])
    keep = ((of(ats) > 0) | (of(digits) >= 7) | (of(runs(digit)) == 4)) & solid[i] & solid[j - 1]
    if not keep.any():
        return None
    order = np.lexsort((i[keep], j[keep]))
    i, j = i[keep][order], j[keep][order]
    letters = np.minimum(of(count(kind == 3)), 1)
    big = runs(np.array([d and (len(v := t[0].lstrip("0")) > 3 or int(v or 0) > 255) for d, t in zip(digit, tokens)]))
    numbers = np.minimum(of(runs(digit)), 6)
    few = np.minimum(of(dots), 5)
    total = of(digits)
    check = np.zeros(len(i), dtype=np.int64)
    for k in np.flatnonzero((total >= 16) & (total <= 19) & (letters == 0)):
        check[k] = 1 + luhn("".join(t[0] for t, d in zip(tokens[i[k] : j[k]], digit[i[k] : j[k]]) if d))
    side = lambda at: _around(text[at : at + 1]) if at >= 0 else 0
    before = np.array([side(tokens[a].start() - 1) for a in range(n)])
    after = np.array([side(t.end()) for t in tokens])
    has = lambda c: np.minimum(of(runs(char(c))), 1)
    features = np.stack(
        [
            np.minimum(of(ats), 2) * 6 + few,
            np.minimum(total, 24) * 2 + letters,
            kind[i] * 21 + kind[j - 1],
            before[i] * 21 + after[j - 1],
            (few * 7 + numbers) * 2 + letters,
            np.minimum(of(big), 1) * 6 + few,
            check,
            np.minimum(j - i, LONGEST),
            has(" ") * 8 + has("-") * 4 + has("(") * 2 + has("+"),
        ],
        axis=1,
    )
    bounds = np.array([t.start() for t in tokens] + [tokens[-1].end()])
    return Lattice(bounds, np.minimum(kind, 4) - 1, i, j, features + _SHIFTS[:-1])


@dataclass
class Field:
    inside: np.ndarray  # feature x kind
    outside: np.ndarray  # token class


def _log_sum(x: np.ndarray, axis: int = 0) -> np.ndarray:
    top = x.max(axis=axis)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(x - np.expand_dims(safe, axis)).sum(axis=axis))


def _scores(field: Field, lat: Lattice) -> tuple[np.ndarray, np.ndarray]:
    return field.inside[lat.features].sum(axis=1), field.outside[lat.outside]


def _gradient(field: Field, lat: Lattice, gold: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
    """Observed minus expected use of each segment and kind, and of each outside token."""
    inner, outer = _scores(field, lat)
    n, kinds = len(outer), len(KINDS)
    # states: 0 outside, 1 an entity has just ended
    enter = np.array([0.0, ADJACENT])
    ahead = np.full((n + 1, 2), -np.inf)
    ahead[0, 0] = 0
    by_end = np.searchsorted(lat.end, np.arange(n + 2))
    for j in range(1, n + 1):
        ahead[j, 0] = np.logaddexp(ahead[j - 1, 0], ahead[j - 1, 1]) + outer[j - 1]
        a, b = by_end[j], by_end[j + 1]
        if a < b:
            ahead[j, 1] = _log_sum((_log_sum(ahead[lat.start[a:b]] + enter, 1)[:, None] + inner[a:b]).ravel())
    order = np.argsort(lat.start, kind="stable")
    by_start = np.searchsorted(lat.start[order], np.arange(n + 1))
    back = np.full((n + 1, 2), -np.inf)
    back[n] = 0
    for i in range(n - 1, -1, -1):
        out = outer[i] + back[i + 1, 0]
        back[i] = out
        own = order[by_start[i] : by_start[i + 1]]
        if len(own):
            into = _log_sum((inner[own] + back[lat.end[own], 1][:, None]).ravel())
            back[i] = np.logaddexp(out, into + enter)
    whole = np.logaddexp(ahead[n, 0], ahead[n, 1])
    first = _log_sum(ahead[lat.start] + enter, 1)
    use = -np.exp(first[:, None] + inner + back[lat.end, 1][:, None] - whole)
    out_use = -np.exp(np.logaddexp(ahead[:-1, 0], ahead[:-1, 1]) + outer + back[1:, 0] - whole)
    covered = np.zeros(n, dtype=bool)
    for s, (i, j) in enumerate(zip(lat.start.tolist(), lat.end.tolist())):
        if (k := gold.get((i, j))) is not None:
            use[s, k] += 1
            covered[i:j] = True
    out_use[~covered] += 1
    assert use.shape[1] == kinds
    return use, out_use


def best_segments(field: Field, lat: Lattice) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the highest-scoring segmentation, in characters; ties keep tokens outside."""
    inner, outer = _scores(field, lat)
    n = len(outer)
    kind = inner.argmax(axis=1)
    value = inner.max(axis=1)
    best = np.zeros((n + 1, 2))
    best[0, 1] = -np.inf
    came = np.full(n + 1, -1)
    by_end = np.searchsorted(lat.end, np.arange(n + 2))
    for j in range(1, n + 1):
        best[j, 0] = best[j - 1].max() + outer[j - 1]
        best[j, 1] = -np.inf
        a, b = by_end[j], by_end[j + 1]
        if a < b:
            from_ = best[lat.start[a:b]]
            total = np.maximum(from_[:, 0], from_[:, 1] + ADJACENT) + value[a:b]
            came[j] = a + int(total.argmax())
            best[j, 1] = total.max()
    out, j, state = [], n, int(best[n, 1] > best[n, 0])
    while j > 0:
        if state == 0:
            j -= 1
            state = int(best[j, 1] > best[j, 0])
        else:
            s = int(came[j])
            i = int(lat.start[s])
            out.append((int(kind[s]), int(lat.bounds[i]), int(lat.bounds[j])))
            state = int(best[i, 1] + ADJACENT > best[i, 0])
            j = i
    return out[::-1]


def _decoys(text: str) -> Iterator[str]:
    """Copies of ``text`` with a card's checksum or an address's range broken, which must stay unmarked."""
    for k, a, b in base_spans(text):
        if KINDS[k] == "card":
            yield f"{text[: b - 1]}{(int(text[b - 1]) + 1) % 10}{text[b:]}"
        elif KINDS[k] == "ip":
            yield f"{text[:a]}9{text[a:b].split('.')[0]:0>2}{text[text.index('.', a):]}"


def fit(samples: list[str], epochs: int = 6, rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> Field:
    """Maximise the likelihood of the patterns' spans in ``samples`` (regions with a character on each side), and none in decoys."""
    field = Field(np.zeros((FEATURES, len(KINDS))), np.zeros(4))
    data = []
    for text in [*samples, *(d for s in samples for d in _decoys(s))]:
        spans = sorted(base_spans(text), key=lambda s: s[1] - s[2])
        for low, high in regions(text):
            lat = lattice(text, low, high)
            if lat is None:
                continue
            place, taken, gold = {int(b): k for k, b in enumerate(lat.bounds)}, set(), {}
            for k, a, b in spans:  # the longest of those that overlap
                if a in place and b in place and place[b] - place[a] <= LONGEST:
                    cells = range(place[a], place[b])
                    if not taken & set(cells):
                        taken |= set(cells)
                        gold[place[a], place[b]] = k
            data.append((lat, gold))
    seen = np.full(field.inside.shape, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            lat, gold = data[k]
            use, out_use = _gradient(field, lat, gold)
            rows = np.flatnonzero(np.abs(use).max(axis=1) > 1e-4)
            ids, where = np.unique(lat.features[rows].ravel(), return_inverse=True)
            g = np.zeros((len(ids), len(KINDS)))
            np.add.at(g, where, np.repeat(use[rows], lat.features.shape[1], axis=0))
            g -= decay * field.inside[ids]
            seen[ids] += g * g
            field.inside[ids] += rate * g / np.sqrt(seen[ids])
            field.outside += 0.02 * np.bincount(lat.outside, out_use, minlength=4)
    return field


def train(docs: DataFrame, most: int = 1200) -> Field:
    """Fit on at most ``most`` regions of ``docs``, those whose hashes come first. No region gives a field that adds nothing."""

    def run(batches):
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                for low, high in regions(text or ""):
                    if high - low <= 200 and lattice(text, low, high) is not None:
                        found.append(text[max(low - 1, 0) : high + 1])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["region"])

    found = docs.where(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(run, "region string").distinct()
    rows = found.orderBy(F.xxhash64("region"), "region").limit(most).collect()
    return fit([r.region for r in rows])


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
)


class Finder:
    """All spans of a text: (kind number, start, end, whether a pattern's), by kind and start."""

    def __init__(self, field: Field):
        self.field, self.known = field, {}

    def _added(self, text: str, low: int, high: int) -> list[tuple[int, int, int]]:
        key = text[max(low - 1, 0) : high + 1], low == 0
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            lat = lattice(text, low, high)
            got = best_segments(self.field, lat) if lat is not None else []
            got = [(k, a - low, b - low) for k, a, b in got]
            if high - low > 1000:
                return [(k, a + low, b + low) for k, a, b in got]
            self.known[key] = got
        return [(k, a + low, b + low) for k, a, b in self.known[key]]

    def __call__(self, text: str) -> list[tuple[int, int, int, bool]]:
        base = base_spans(text)
        if not base and not _TRIGGER.search(text):
            return []
        out = [(*s, True) for s in base]
        fixed = sorted((a, b) for _, a, b in base)
        starts = np.array([a for a, _ in fixed])
        reach = np.maximum.accumulate([b for _, b in fixed]) if fixed else np.zeros(0)
        for low, high in regions(text):
            for k, a, b in self._added(text, low, high):
                before = int(np.searchsorted(starts, b)) if len(starts) else 0
                if not before or reach[before - 1] <= a:
                    out.append((k, a, b, False))
        return sorted(out)


def _slices(batches, column: str = "text"):
    for batch in batches:
        if batch.num_rows:
            _, starts = text_bytes(batch.column(column))
            for low, high in pieces(starts):
                yield batch.slice(low, high - low)


def find(docs: DataFrame, field: Field, into: str = "pii_spans") -> DataFrame:
    """``docs`` with all spans of ``text``: kind, start and end in code points, and whether a pattern found it.

    Null and empty texts have none. Every column is kept, but one named ``into`` is replaced.
    """
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()])
    sent = docs.sparkSession.sparkContext.broadcast(field)  # a fixed size
    schema = T.StructType(docs.schema.fields + [T.StructField(into, SPANS)])

    def run(batches):
        finder = Finder(sent.value)
        for part in _slices(batches):
            rows = [
                [{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in finder(text or "")]
                for text in part.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, _ARROW_SPANS)], names=schema.names)

    return docs.mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one, of the first's kind."""
    out, done = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b, _ in spans):
        if a >= done:
            out += [text[done:a], f"[{KINDS[k]}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind, and ``n_chars`` brought up to date; other columns unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        finder = Finder(sent.value)
        for part in _slices(batches):
            before = part.column("text").to_pylist()
            after = [masked(t, s) if t and (s := finder(t)) else t for t in before]
            columns = dict(zip(part.schema.names, part.columns))
            columns["text"] = pa.array(after, part.schema.field("text").type)
            if "n_chars" in columns:
                sizes = columns["n_chars"].to_pylist()
                sizes = [len(b) if a != b else n for a, b, n in zip(before, after, sizes)]
                columns["n_chars"] = pa.array(sizes, part.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, docs.schema)


def _written(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(rank[s["kind"]], s["start"], s["end"], s["kind"].alias("kind")))
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def pii_report(docs: DataFrame, field: Field) -> DataFrame:
    """Digest columns of ``find``: counts of the patterns' spans by kind, their hash, and all spans."""
    found = find(docs.select("doc_id", "text"), field).select("doc_id", "pii_spans")
    base = F.filter("pii_spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.encode(_written(base), "UTF-8"), 256).alias("base_sha256"),
        _written(F.col("pii_spans")).alias("spans"),
    )
