"""Near-duplicate documents by SetSketch registers.

Every document becomes its set of distinct k-word shingles (64-bit hashes) and a sketch: `registers` truncated,
exponentially spaced minima floor(1 - log_b(min / RATE)) in 16 bits, which merge by maximum and whose positions agree more often
the larger the Jaccard similarity is. Bands of registers propose pairs; a likelihood-ratio test on the joint
register counts drops pairs that are far below the threshold (by 4 standard deviations); the rest is verified on
full shingle sets. Only edges that can join two components are proposed: first each bucket's members against its
smallest member, then, within buckets that still hold several components, pairs across components. A pair is
looked at in its first common band only. Open buckets of more than BLOCK members are cut into blocks, those of their
largest component apart from the others, which alone have to meet one another and those; where a member would be in more
than WIDE pairs of blocks, the bucket is banded again instead: its members meet where they share a second band too, or, if
that is still too many, a third (DEPTH). Buckets of more than `FEW` members get the full sets in their tasks and return
links that join components, not pairs.

Rows: texts that are null or empty have no set and are linked with nothing; a null id is never linked
(component_id null, kept true); repeated rows share their set and so their component; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, arrow_batches, discard, pieces, shingle_hashes, written

BASE = 1.001  #: spacing of the register values
RATE = 20.0  #: minima above it are truncated to 0
BLOCK = 512  #: members of a bucket that one task compares with as many others
DEPTH = 3  #: bands that members of large buckets must share to be compared, at most
WIDE = 64  #: pairs of blocks that a member is in, on average, before its bucket is banded again
BATCH = 8 << 20  #: bytes of rows that Python gets at a time: sets and sketches are large, and Spark and Python both hold them
FEW = 64  #: members of a bucket whose pairs are verified by a join
SIGMAS = 4.0  #: a pair goes unverified only if the threshold is so many deviations above its estimate


def _multipliers(m: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 31, (m, 2), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def sketch_sets(hashes: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """Registers (sets x m, uint16) of the sets that begin at starts."""
    lo, hi = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), m), np.uint16)
    for i, (a, b) in enumerate(_multipliers(m)):
        v = lo * a + hi * b
        v ^= v >> np.uint32(15)
        least = np.minimum.reduceat(v * np.uint32(0x2C1B3C6D), starts)
        x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
        out[:, i] = np.clip(np.floor(1 - np.log(x / RATE) / np.log(BASE)), 0, 65535)
    return out


def _sets(texts: pa.Array, shingle: int):
    """Per text: its sorted distinct shingle hashes (or None), and the flat hashes with the starts of non-empty texts."""
    w = Words(texts)
    flat, doc = shingle_hashes(w.hashes, w.counts, shingle)
    n = np.bincount(doc, minlength=len(texts))
    full = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[full]
    sets = []
    for a, k in zip(starts.tolist(), n[full].tolist()):
        s = np.sort(flat[a : a + k])
        sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
    return full, sets, flat, starts


def _signature(s: np.ndarray) -> int:
    import xxhash

    h = xxhash.xxh3_64_intdigest(s.tobytes())
    return h - (1 << 64) if h >> 63 else h


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, m: int) -> DataFrame:
    def run(batches):
        for batch in pieces(batches):
            full, sets, flat, starts = _sets(batch.column("text"), shingle)
            size, sig, sk = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows, [None] * batch.num_rows
            if len(full):
                size[full] = [len(s) for s in sets]
                for i, s, r in zip(full.tolist(), sets, sketch_sets(flat, starts, m)):
                    sig[i], sk[i] = _signature(s), r.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size), pa.array(sig, pa.int64()), pa.array(sk, pa.binary())], names=["id", "n", "sig", "sketch"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, n long, sig long, sketch binary")


def log_likelihood(j: np.ndarray, nu: np.ndarray, nv: np.ndarray, up: np.ndarray, down: np.ndarray, m: int) -> np.ndarray:
    """Of similarity j, given set sizes and the counts of registers that are larger in the one set and in the other."""
    u = nu / (nu + nv)
    v = 1 - u
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
    a, b = p(u - v * j), p(v - u * j)
    tiny = 1e-9
    return up * np.log(a + tiny) + down * np.log(b + tiny) + (m - up - down) * np.log(np.maximum(1 - a - b, tiny))


def plausible(nu, nv, up, down, m: int, threshold: float) -> np.ndarray:
    """Whether similarity >= threshold is possible by the sizes and not refuted by the registers."""
    nu, nv, up, down = (np.asarray(x, np.float64) for x in (nu, nv, up, down))
    most = np.minimum(nu, nv) / np.maximum(nu, nv)
    keep = most >= threshold - 1e-12
    at = np.flatnonzero(keep)
    nu, nv, up, down, most = nu[at], nv[at], up[at], down[at], most[at]
    here = log_likelihood(np.full(len(at), threshold), nu, nv, up, down, m)
    below = np.full(len(at), -np.inf)
    for x in np.linspace(0, threshold, 12, endpoint=False):
        below = np.maximum(below, log_likelihood(np.full(len(at), x), nu, nv, up, down, m))
    keep[at] = 2 * (below - here) <= SIGMAS**2
    return keep


def _bands(classes: DataFrame, rows: int, bands: int) -> DataFrame:
    key = F.xxhash64(F.col("band"), F.substring(F.col("sketch"), F.col("band") * (2 * rows) + 1, F.lit(2 * rows)))
    return classes.select("sig", "sketch", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")).select(key.alias("key"), "band", "sig")


def _estimated(pairs: DataFrame, classes: DataFrame, m: int, threshold: float) -> DataFrame:
    """Pairs (a, b) that the sketches do not refute."""
    side = lambda x: classes.select(F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, m) for c in ("sa", "sb"))
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            keep = plausible(na, nb, (x > y).sum(1), (x < y).sum(1), m, threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def _reaches(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    both = np.concatenate((x, y))
    both.sort()
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    return den * same >= num * (len(both) - same)


def _elements(sigs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(sig, elements) of the given signatures, read from one document of each: a written table."""

    def sets(batches):
        for batch in pieces(batches):
            _, found, _, _ = _sets(batch.column("text"), shingle)
            yield pa.RecordBatch.from_arrays([pa.array([_signature(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["sig", "elements"])

    ids = sigs.join(classes, "sig").select(F.col("least").alias("id"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(ids, "id", "left_semi")
    return written(texts.select("text").mapInArrow(sets, "sig long, elements binary").dropDuplicates(["sig"]), "sets")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, num: int, den: int) -> DataFrame:
    """Pairs whose full sets reach num / den, as a written table."""

    def exact(batches):
        for batch in batches:
            of = lambda c: [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(c)]
            keep = [_reaches(x, y, num, den) for x, y in zip(of("ea"), of("eb"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = written(pairs, "pairs")
    elements = _elements(pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct(), classes, docs, id_col, text_col, shingle)
    side = lambda x: elements.select(F.col("sig").alias(x), F.col("elements").alias(f"e{x}"))
    links = written(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(exact, "a long, b long"), "links")
    discard(pairs, elements)
    return links


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the least node that it reaches. Large-star and small-star rounds until nothing changes."""

    def stars(e: DataFrame, large: bool) -> DataFrame:
        near = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        out = near.join(least, "u")
        far = out.where(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            far = far.union(least.select("u", F.col("m").alias("v")))
        return far.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = state(edges)
    while seen[0]:
        following = written(stars(stars(edges, True), False), "edges")
        now = state(following)
        discard(edges)
        edges = following
        if now == seen:
            break
        seen = now
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _held(multi: DataFrame, labels: DataFrame) -> DataFrame:
    return multi.join(labels.withColumnRenamed("node", "sig"), "sig", "left").select("key", "band", "sig", F.coalesce("component", "sig").alias("component"))


def _groups(batches):
    """Per piece of rows sorted by (key, lo, hi): the rows as a table with whole groups, and where the groups begin and end."""
    rest = None
    for last, batch in _with_last(batches):
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        if not t.num_rows:
            continue
        marks = [t.column(c).to_numpy() for c in ("key", "lo", "hi")]
        cuts = np.flatnonzero(np.concatenate(([True], np.any([x[1:] != x[:-1] for x in marks], axis=0), [True])))
        if not last:
            rest, cuts = t.slice(int(cuts[-2])), cuts[:-1]
        if len(cuts) > 1:
            yield t, cuts.tolist()


def _first_common(common: np.ndarray, code: np.ndarray, base: int) -> np.ndarray:
    """Whether the bands of each code (digits to the base, from 1) are the first that are common (pairs x bands)."""
    ok, left, code = np.ones(len(code), bool), common.copy(), code.copy()
    while code.any():
        want, code = code % base, code // base
        at = left.argmax(1)
        ok &= (want == 0) | ((at + 1 == want) & left[np.arange(len(left)), at])
        left[np.arange(len(left)), at] = False
    return ok


class _Members:
    """Columns of a table of bucket members, and the pairs of them that are worth verifying."""

    def __init__(self, t: pa.Table, m: int, rows: int, threshold: float):
        self.sig, self.comp, self.n, self.own, self.lo, self.hi, self.band = (t.column(c).to_numpy() for c in ("sig", "component", "n", "own", "lo", "hi", "band"))
        self.sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint16).reshape(-1, m)
        self.m, self.rows, self.threshold, self.base = m, rows, threshold, m // rows + 1

    def triangles(self, a: int, b: int):
        """All x < y within rows a to b, in parts."""
        step = max(1, 50_000 // (b - a))
        for r in range(a, b, step):
            x, y = np.nonzero(np.arange(r, min(r + step, b))[:, None] < np.arange(a, b)[None, :])
            yield x + r, y + a

    def passing(self, x: np.ndarray, y: np.ndarray):
        n = self.n
        keep = (self.comp[x] != self.comp[y]) & ((self.lo[x] == self.hi[x]) | (self.own[x] != self.own[y])) & (np.minimum(n[x], n[y]) >= self.threshold * np.maximum(n[x], n[y]) - 1e-9)
        x, y = x[keep], y[keep]
        p, q = self.sk[x], self.sk[y]
        first = _first_common((p == q).reshape(len(x), self.m // self.rows, self.rows).all(2), self.band[x], self.base)
        x, y, p, q = x[first], y[first], p[first], q[first]
        keep = plausible(n[x], n[y], (p > q).sum(1), (p < q).sum(1), self.m, self.threshold)
        return x[keep], y[keep]


def _across(multi: DataFrame, classes: DataFrame, labels: DataFrame, m: int, rows: int, threshold: float) -> DataFrame:
    """A written table. Pairs (a, b) of different components that share a small bucket; for larger buckets, the members (a) that have such pairs, with their block."""
    sketch = classes.select("sig", "n", "sketch")
    base = m // rows + 1
    # (key, band, last, sig, component): band has the numbers of the bands that make the key, as digits; last is the last of them
    held, found = _held(multi, labels).select("key", (F.col("band") + 1).cast("int").alias("band"), F.col("band").cast("int").alias("last"), "sig", "component"), []
    used = []
    for depth in range(1, DEPTH + 1):
        sizes = held.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("most")).where("size > most.n")
        some, many = F.ceil((F.col("size") - F.col("most.n")) / BLOCK), F.ceil(F.col("most.n") / BLOCK)  # blocks of the others, and of the largest component
        cost = ((F.col("size") - F.col("most.n")) * (some + many) + F.col("most.n") * some) / F.col("size")
        one = F.col("size") <= BLOCK
        groups = written(sizes.select("key", F.col("most.component").alias("major"), F.when(one, 1).otherwise(some).cast("int").alias("some"), F.when(one, 0).otherwise(many).cast("int").alias("many"), (~one & (cost > WIDE) & F.lit(depth < DEPTH)).alias("again")), "groups")
        found.append(held.join(groups.where("not again"), "key"))
        used += [groups, held]
        if groups.where("again").isEmpty():
            break
        crowd = held.join(groups.where("again").select("key"), "key").where(F.col("last") < base - 2).join(sketch.select("sig", "sketch"), "sig")
        crowd = crowd.withColumn("next", F.explode(F.sequence(F.col("last") + 1, F.lit(base - 2))))
        key = F.xxhash64(F.col("key"), F.col("next"), F.substring(F.col("sketch"), F.col("next") * (2 * rows) + 1, F.lit(2 * rows)))
        held = written(crowd.select(key.alias("key"), (F.col("band") + (F.col("next") + 1) * base**depth).cast("int").alias("band"), F.col("next").cast("int").alias("last"), "sig", "component"), "again")
    members = functools.reduce(DataFrame.union, (x.select("key", "band", "sig", "component", "major", "some", "many") for x in found)).join(sketch, "sig")
    minor = (F.col("many") == 0) | (F.col("component") != F.col("major"))
    members = members.withColumn("own", F.when(minor, F.pmod(F.xxhash64("sig", "key"), F.col("some"))).otherwise(F.col("some") + F.pmod(F.xxhash64("sig", "key"), F.col("many"))).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(minor, F.col("some") + F.col("many")).otherwise(F.col("some")) - 1)))
    members = members.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "band", "own", "sig", "component", "n", "sketch")

    def run(batches):
        kinds = (("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("band", pa.int32()), ("own", pa.int32()), ("component", pa.int64()))
        out = lambda **x: pa.RecordBatch.from_arrays([pa.array(x[c], k) if c in x else pa.nulls(size, k) for c, k in kinds], names=[c for c, _ in kinds])
        for t, cuts in _groups(batches):
            g, key, waiting, count = _Members(t, m, rows, threshold), t.column("key").to_numpy(), [], 0
            for a, b in zip(cuts, cuts[1:]):
                if b - a <= FEW:
                    waiting += g.triangles(a, b)
                    count += (b - a) * (b - a)
                else:
                    hit = np.zeros(b - a, bool)
                    for x, y in g.triangles(a, b):
                        x, y = g.passing(x, y)
                        hit[x - a] = hit[y - a] = True
                    at = np.flatnonzero(hit) + a
                    size = len(at)
                    yield out(a=g.sig[at], key=key[at], lo=g.lo[at], hi=g.hi[at], band=g.band[at], own=g.own[at], component=g.comp[at])
                if waiting and (count > 50_000 or b == cuts[-1]):
                    x, y = g.passing(*(np.concatenate(z) for z in zip(*waiting)))
                    x, y, waiting, count = g.sig[x], g.sig[y], [], 0
                    size = len(x)
                    yield out(a=np.minimum(x, y), b=np.maximum(x, y))

    out = written(members.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(run, "a long, b long, key long, lo int, hi int, band int, own int, component long"), "across")
    discard(*used)
    return out


def _dense(members: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, m: int, rows: int, threshold: float, num: int, den: int) -> DataFrame:
    """Links that join components within blocks of large buckets, verified on full sets in the blocks' own tasks."""
    members = members.withColumnRenamed("a", "sig")
    elements = _elements(members.select("sig").distinct(), classes, docs, id_col, text_col, shingle)
    held = members.join(classes.select("sig", "n", "sketch"), "sig").join(elements, "sig").select("key", "lo", "hi", "band", "own", "sig", "component", "n", "sketch", "elements")

    def run(batches):
        for t, cuts in _groups(batches):
            g, sets = _Members(t, m, rows, threshold), [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("elements")]
            for a, b in zip(cuts, cuts[1:]):
                parent: dict[int, int] = {}

                def root(c: int) -> int:
                    while (up := parent.get(c, c)) != c:
                        parent[c] = c = parent.get(up, up)
                    return c

                found = []
                for xs, ys in g.triangles(a, b):
                    for x, y in zip(*(z.tolist() for z in g.passing(xs, ys))):
                        p, q = root(int(g.comp[x])), root(int(g.comp[y]))
                        if p != q and _reaches(sets[x], sets[y], num, den):
                            parent[max(p, q)] = min(p, q)
                            found.append((int(g.sig[x]), int(g.sig[y])))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(z, pa.int64()) for z in zip(*found)], names=["a", "b"])

    links = written(held.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(run, "a long, b long"), "dense")
    discard(elements)
    return links


def _with_last(items):
    """(whether it is the last, item) for each item; at least one call with the last."""
    before = None
    for x in items:
        if before is not None:
            yield False, before
        before = x
    if before is not None:
        yield True, before


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100, registers: int = 96, rows: int = 4) -> DataFrame:
    """(id, n_shingles, component_id, kept): documents link when den * |A and B| >= num * |A or B|."""
    with arrow_batches(docs.sparkSession, BATCH):  # all that runs in Python is written before it ends
        return _near_duplicates(docs, id_col, text_col, shingle, num, den, registers, rows)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int, num: int, den: int, registers: int, rows: int) -> DataFrame:
    threshold = num / den
    rows_all = written(sketches(docs, id_col, text_col, shingle, registers), "sketches")
    classes = written(rows_all.where("sig is not null and id is not null").groupBy("sig").agg(F.min("id").alias("least"), F.max("n").alias("n"), F.max("sketch").alias("sketch")), "classes")
    bands = _bands(classes, rows, registers // rows)
    shared = bands.groupBy("key").agg(F.min("sig").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1")
    multi = written(bands.join(shared.select("key", "leader"), "key"), "buckets")
    stars = multi.where("sig <> leader").select(F.col("leader").alias("a"), F.col("sig").alias("b")).distinct()
    check = lambda pairs: _verified(pairs, classes, docs, id_col, text_col, shingle, num, den)
    links = check(_estimated(stars, classes, registers, threshold))
    labels = written(components(links), "labels")
    found = _across(multi, classes, labels, registers, rows, threshold)
    lists = [check(found.where("key is null").select("a", "b"))]
    crowded = found.where("key is not null")
    if not crowded.isEmpty():
        lists.append(_dense(crowded.drop("b"), classes, docs, id_col, text_col, shingle, registers, rows, threshold, num, den))
    more = functools.reduce(DataFrame.union, lists)
    linked = components(more.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    discard(links, multi, labels, found, *lists)
    named = classes.select("sig", "least").join(linked.withColumnRenamed("node", "sig"), "sig", "left").select("sig", "least", F.coalesce("component", "sig").alias("component"))
    least = linked.withColumnRenamed("node", "sig").join(classes, "sig").groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component", "left").select("sig", F.coalesce("component_id", "least").alias("component_id"))
    out = rows_all.select("id", "n", "sig").join(named, "sig", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op8_setsketch(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, num=85, den=100)
