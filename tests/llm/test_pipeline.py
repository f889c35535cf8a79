"""The stages on odd rows, and run() stage by stage against plain Python on the smallest tables."""

from __future__ import annotations

import collections
import math
import re

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from marlstone.llm import decontam, quality, stages, toxicity

D = "/root/testdata/sf0.001"


def components(sets: dict, num: int) -> dict:
    """Least id reachable over links of 100 * common >= num * all, by comparing all pairs."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) or frozenset([tuple(w)] if w else [])


def overlap(item: list, words: list):
    """Best score of the item over all its places in the document."""
    best = 0
    at = collections.defaultdict(list)
    for k, w in enumerate(words):
        at[w].append(k)
    hits = collections.Counter(k - i for i, w in enumerate(item) for k in at.get(w, ()))
    least = min(decontam.LEAST, math.ceil(decontam.SHARE * len(item)))
    for d, n in hits.items():
        if n >= max(least, 1):
            best = max(best, decontam._best([0 <= i + d < len(words) and words[i + d] == w for i, w in enumerate(item)]))
    return best


def accepted(item: list, words: list) -> bool:
    s = overlap(item, words)
    return s > 0 and (s >= decontam.LEAST or s >= decontam.SHARE * len(item))


def test_stages_on_odd_rows(spark, docs):
    columns = docs.columns
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, D)
        if name != "mixing":
            assert out.columns == columns
            assert out.count() <= rows.count()
            assert stage(spark, rows.limit(0), D).count() == 0
            rows = out


def test_near_duplicates_stage_keeps_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    rows = [(1, text)] * 3 + [(2, text), (3, text + " more"), (4, other), (4, other), (5, None), (5, None), (None, text), (None, text), (6, "")]
    d = spark.createDataFrame([(*r, "x", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, r.text or "") for r in stages.near_duplicates(spark, d, D).collect())
    assert got == [(0, text), (0, text), (1, text), (4, other), (5, ""), (6, "")]


def test_run_by_brute_force(spark):
    docs, labels = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    # the trained stages: a document goes as its own prediction says
    left = dict(texts)
    for op, bad in ((quality, 0), (toxicity, 1)):
        rows = docs.where(F.col("doc_id").isin(sorted(left)))
        gone = {r.doc_id for r in op.score(rows, op.learn(rows, labels)).collect() if r.predicted == bad}
        left = {i: t for i, t in left.items() if i not in gone}
    # one of each component of near copies
    root = components({i: shingles(t, 5) for i, (t, _) in left.items()}, 80)
    left = {i: t for i, t in left.items() if root[i] == i}
    # no overlap with any item of the benchmark
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = [words(r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    left = {i: t for i, t in left.items() if not any(accepted(x, words(t[0])) for x in items)}
    # targets by sharing again and again
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (t, _) in left.items()}
    source_size = collections.Counter()
    for i, (_, s) in left.items():
        source_size[s] += size[i]
    order = sorted((s for s in source_size if s is not None)) + [s for s in source_size if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, rest, open_ = {}, float(sum(size.values())), set(order)
    while open_:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * source_size[s] + 1e-9]
        target |= share if not over else {s: 3.0 * source_size[s] for s in over}
        rest -= sum(target[s] for s in over)
        open_ = open_ - set(over) if over else set()
    out = corpus_pipeline.run(spark, D)
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == set(left)
    taken = collections.Counter()
    for i, r in got.items():
        s = left[i][1]
        assert (r["size"], r.source_size) == (size[i], source_size[s]) and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 3 * r["size"] and r.taken >= math.floor(target[s] / source_size[s]) * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_good_documents_stay(spark):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.run(spark, D).collect()}
    good = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert len([i for i in good if i in kept]) >= 0.8 * len(good)
    assert len([i for i, r in labels.items() if r.quality == 0 and i in kept]) <= 0.2 * sum(r.quality == 0 for r in labels.values())


def test_decontamination_by_brute_force(spark):
    """All pairs of the smallest tables, every place of every item."""
    docs, items = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/benchmark.parquet")
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    found = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs, items).collect()}
    bench = {r.item_id: words(r.text) for r in items.collect()}
    want = {}
    for r in docs.collect():
        own = words(r.text)
        for i, item in bench.items():
            if accepted(item, own):
                want[r.doc_id, i] = overlap(item, own)
    assert found == want and want
    assert np.mean(list(want.values())) > 10
