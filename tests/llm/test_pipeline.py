"""The pipeline's stages against plain versions over the smallest tables."""

import base64

import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.llm.test_operators import plain_components, plain_pii, words
from visitmart.llm import pii
from visitmart.llm.shared import stored


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], sf), name))
    rows = [{r.doc_id: r for r in step.collect()} for step in steps]
    assert all(step.columns == docs.columns for step in steps[:5])

    lost = [i for i in rows[0] if i not in rows[1]]
    assert sum(labels.get(i, 0) for i in lost) <= 0.1 * len(lost)  # few labels here: it may lose none

    named = plain_components([(i, r.text) for i, r in rows[1].items()], 5, 80)
    assert set(rows[2]) == {i for i, _, low in named if i == low}

    items = [words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    whole = {tuple(w) for w in items}
    sizes = {len(w) for w in whole}
    hit = {
        i for i, r in rows[2].items() for w in [words(r.text)] for n in sizes for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in whole
    }
    assert hit and not hit & set(rows[3]) and len(rows[2]) - len(rows[3]) <= len(hit) + 2

    assert set(rows[4]) == set(rows[3])
    for i, r in rows[3].items():
        base = plain_pii(r.text or "")
        assert (rows[4][i].text == r.text) or "[" in rows[4][i].text
        assert not base or not plain_pii(rows[4][i].text)
    assert pii.masked("a b@c.de f", [(0, 2, 8, True)]) == "a [email] f"

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, r in rows[5].items():
        assert r.ids == coder.encode_ordinary(rows[4][i].text or "") and r.n_tokens == len(r.ids) and r.whole


def test_near_duplicates_keep_columns_with_any_names(spark):
    """Names that the stage might use itself come back unchanged, and equal rows are still one."""
    from visitmart.llm import jaccard

    words = " ".join(f"w{k}" for k in range(60))
    names = ["near_row", "near_set", "near_b_row", "near__row", "b_row", "b_doc_id", "comp", "times"]
    rows = [(i, words if i < 4 else f"{words} other {i * 'x '}", *[f"{n}{i}" for n in names]) for i in range(6)]
    rows += [rows[0], (7, None, *names), (8, "", *names)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema).repartition(3)
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    got = {tuple(r) for r in kept.collect()}
    assert got <= set(rows) and {0, 7, 8} <= {r[0] for r in got} and not {1, 2, 3} & {r[0] for r in got}


def test_stages_on_an_empty_table_and_odd_rows(spark, sf):
    """Every stage in turn takes null, empty, blank and repeated texts, null ids and no rows at all."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"word{k % 977} 12 {k}" for k in range(9000))
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (3, " \n ", "en", "a", 3), (None, "short text", "en", "a", 9)]
    rows += [(None, None, None, None, None), (5, long, "en", "b", len(long))] + [(6, "twice the same row of text", "en", "b", 5)] * 3
    for docs in (spark.createDataFrame([], schema), spark.createDataFrame(rows, schema)):
        for name, stage in corpus_pipeline.STAGES:
            made = corpus_pipeline.stored(stage(spark, docs, sf), name)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert made.columns == docs.columns
                docs = made if made.count() else docs
        assert made.count() == docs.count()


def test_group_of_near_copies_meets_about_once(spark, monkeypatch):
    """Components of a group of copies with few changes equal brute force; hardly a pair is met twice."""
    import random

    from visitmart.llm import jaccard

    r = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(260):
        text = list(base)
        for k in r.sample(range(120), r.randint(1, 5)):
            text[k] = f"x{r.randint(0, 10**6)}"
        rows.append((i, " ".join(text)))
    sets = [{tuple(t.split()[k : k + 4]) for k in range(117)} for _, t in rows]
    link = lambda a, b: 100 * len(a & b) >= 85 * len(a | b)
    low = list(range(len(rows)))
    find = lambda x: x if low[x] == x else find(low[x])
    for a in range(len(rows)):
        for b in range(a):
            if link(sets[a], sets[b]):
                x, y = sorted((find(a), find(b)))
                low[y] = x
    met = []
    first = jaccard._met_first
    monkeypatch.setattr(jaccard, "_met_first", lambda: met.append(1) or first())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.component_id for x in jaccard.jaccard_components(docs).collect()}
    assert got == {i: find(i) for i, _ in rows} and len(set(got.values())) > 1
    assert met  # the last comparison took place
