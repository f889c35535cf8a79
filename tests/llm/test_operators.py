"""The corpus operators against plain Python, on rows with nulls, empty and very long texts, repeats and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from marlstone.llm import chat, decontam, licenses, lm, media, mixing, neardup, quality, toxicity, warc
from marlstone.llm.common import Words


def tokens(t):
    return (t or "").encode().lower().split()


# ---- 1 media


def test_media_round_trip(spark, docs, nothing):
    got = media.from_media(media.to_media(docs)).collect()
    want = collections.Counter(rows_of(docs))
    seen = collections.Counter()
    for r in got:
        pad = bytes(r.payload)
        text = pad[: r.n_bytes].decode()
        assert len(pad) % 64 == 0 and len(pad) > 0 and not any(pad[r.n_bytes :])
        assert len(r.rgb) == r.height * r.width * 3
        seen[r.doc_id, text] += 1
    assert seen == collections.Counter({(i, t or ""): sum(n for (j, u), n in want.items() if (j, u or "") == (i, t or "")) for i, t in want})
    assert media.from_media(media.to_media(nothing)).count() == 0


def test_media_reads_any_progressive_coding():
    """A file with zeros, runs, end-of-band runs, restart intervals and new coefficients in refinement, written symbol by symbol."""
    r = np.random.default_rng(1)
    blocks = np.zeros((12, 64), np.int64)
    for b in blocks:
        b[0] = r.integers(-300, 300)
        for k in r.choice(np.arange(1, 64), r.integers(0, 9), replace=False):
            b[k] = r.choice([-5, -3, -2, -1, 1, 2, 3, 9])
    blocks[4:7, 1:] = 0
    lengths = {s: 8 for s in [*range(0, 12), *(n << 4 for n in range(1, 15)), 0xF0, *((z << 4) | s for z in range(16) for s in range(1, 5))]}
    codes = media.canonical(lengths)
    size = lambda v: int(abs(v)).bit_length()
    mag = lambda v: v if v >= 0 else v + (1 << size(v)) - 1

    def pack(bits):
        return media._bytes(np.array([int(x) for s in bits for x in s], np.uint8)) if bits else b""

    def emit(s):
        c, n = codes[s]
        return f"{c:0{n}b}"

    def dc():
        parts, out, last = [], [], 0
        for i, b in enumerate(blocks):
            if i % 4 == 0:
                parts.append([])
                last = 0
            v = b[0] >> 1
            d = v - last
            last = v
            parts[-1].append(emit(size(d)) + (f"{mag(d):0{size(d)}b}" if d else ""))
        for i, p in enumerate(parts):
            out.append(pack(p) + (bytes([0xFF, 0xD0 + i]) if i < len(parts) - 1 else b""))
        return b"".join(out)

    def first():
        out, run = [], 0

        def flush():
            nonlocal run
            if run:
                k = run.bit_length() - 1
                out.append(emit(k << 4) + (f"{run - (1 << k):0{k}b}" if k else ""))
                run = 0

        for b in blocks:
            v = np.sign(b[1:]) * (np.abs(b[1:]) >> 1)
            at = np.flatnonzero(v)
            last = -1
            if len(at):
                flush()
            for k in at:
                zeros = k - last - 1
                while zeros > 15:
                    out.append(emit(0xF0))
                    zeros -= 16
                out.append(emit(zeros << 4 | size(v[k])) + f"{mag(int(v[k])):0{size(v[k])}b}")
                last = k
            if last < 62:
                run += 1
        flush()
        return pack(out)

    def refine():
        out = []
        for b in blocks:
            old, new = np.abs(b[1:]) >> 1, np.abs(b[1:]) == 1
            tail = max(np.flatnonzero(new), default=-1)
            zeros, fixes = 0, ""
            for k in range(63):
                if k > tail:
                    break
                if old[k]:
                    fixes += str(int(abs(b[k + 1]) & 1))
                elif new[k]:
                    out.append(emit(zeros << 4 | 1) + ("1" if b[k + 1] > 0 else "0") + fixes)
                    zeros, fixes = 0, ""
                else:
                    if zeros == 15:
                        # a run of sixteen zeros, then the corrections met on the way
                        out.append(emit(0xF0) + fixes)
                        zeros, fixes = 0, ""
                        continue
                    zeros += 1
            if tail < 62:
                rest = "".join(str(int(abs(v) & 1)) for k, v in enumerate(b[1:]) if k > tail and abs(v) >> 1)
                out.append(emit(0) + fixes + rest)
        return pack(out)

    body = [b"\xff\xd8", media._HEAD, media._segment(0xC2, b"\x08" + (24).to_bytes(2, "big") + (32).to_bytes(2, "big") + bytes([1, 1, 0x11, 0])), media._huffman_segment(0, 0, lengths), media._huffman_segment(1, 0, lengths)]
    body += [media._segment(0xDD, b"\0\4"), media._scan([(1, 0)], 0, 0, 0, 1, dc()), media._segment(0xDD, b"\0\0")]
    body += [media._scan([(1, 0)], 1, 63, 0, 1, first()), media._scan([(1, 0)], 1, 63, 1, 0, refine()), media._scan([(1, 0)], 0, 0, 1, 0, pack([str(b[0] & 1) for b in blocks])), b"\xff\xd9"]
    p = media.read_coefficients(b"".join(body))
    assert p["components"][0][4].reshape(-1, 64).tolist() == blocks.tolist()
    rgb = media.to_rgb(p)
    assert rgb.shape == (24, 32, 3)
    # inverse transform by its definition, for one sample
    c = lambda u: math.sqrt(0.5) if u == 0 else 1.0
    block = np.zeros(64)
    block[media.ZIGZAG] = blocks[0]
    s = sum(c(i // 8) * c(i % 8) * block[i] * math.cos((2 * 3 + 1) * (i // 8) * math.pi / 16) * math.cos((2 * 5 + 1) * (i % 8) * math.pi / 16) for i in range(64)) / 4 + 128
    assert abs(float(rgb[3, 5, 0]) - min(255, max(0, s))) <= 1


# ---- 2 chat


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(2)
    m = chat.model()
    start, move = m["start"], m["move"]
    counts = np.array([3, 1, 4])
    e = r.integers(-1000, 0, (8, 6))
    got = chat.viterbi(e, counts, m)
    for a, n in zip((0, 3, 4), counts):
        score = lambda p: start[p[0]] + e[a, p[0]] + sum(move[p[i - 1], p[i]] + e[a + i, p[i]] for i in range(1, n))
        assert score(tuple(got[a : a + n])) == max(map(score, np.ndindex(*[6] * n)))


def test_observations_and_emissions():
    lines = ["User: how?", "", "  ", "Assistant:", "[system] x", "plain", "### human", "**AI:** yes", "a: b", "abba: c"]
    o, cuts = chat.observations(lines, np.array([0, 5]))
    assert o.tolist() == [[2, 0, 0, 1], [0, 1, 0, 0], [0, 1, 1, 0], [3, 0, 1, 0], [1, 0, 0, 0], [0, 0, 0, 0], [2, 0, 0, 0], [3, 0, 0, 0], [3, 0, 0, 0], [0, 0, 0, 0]]
    assert [x[c:] for x, c in zip(lines, cuts)] == ["how?", "", "  ", "", "x", "plain", "", "yes", "b", "abba: c"]
    p = lambda yes, x: x if yes else 1 - x
    e = chat.emissions(o, chat.model()) / chat.SCALE
    for i, (mark, blank, after, question) in enumerate(o.tolist()):
        for s in range(6):
            want = math.log(chat.MARKS[s][mark]) + math.log(p(blank, chat.BLANK[s])) + math.log(p(after, chat.AFTER_BLANK[s])) + math.log(p(question, chat.QUESTION[s]))
            assert abs(e[i, s] - want) < 1e-5


def chat_rows():
    rows = [(c, t, ("user", "assistant")[t % 2], f"some text {c} {t}" + ("?" if t % 2 == 0 else "."), 9) for c in range(30) for t in range(6)]
    rows += [(None, 0, "user", "hello", 9), (None, 1, "assistant", "a\n\nb", 9), (99, None, None, None, 9), (98, 0, "user", "", 9), rows[0], rows[0]]
    rows += [(77, 5, "user", f"copy {i}", 9) for i in range(300)] + [(78, 5, "user", "the same", 9)] * 50
    rows += [(80, t, ("user", "assistant")[t % 2], f"line {t}\n\nmore of it" + ("?" if t % 2 == 0 else "."), 9) for t in range(100)]
    return rows + [(79, t, ("user", "assistant")[t % 2], f"line {t}\nmore of it" + ("?" if t % 2 == 0 else "."), 9) for t in range(1000)]


def decoded(spark, rows, m=None):
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_lines long").repartition(3)
    out = {}
    for r in sorted(chat.parse_turns(chat.shown(conv), m).collect(), key=lambda r: (r.conv_id or -1, r.chunk)):
        out.setdefault(r.conv_id, []).append(r)
    return {c: ("".join(r.rendered for r in x), sum(r.n_lines for r in x), sum(r.n_roles_right for r in x), [t.role for r in x for t in r.turns if t.role]) for c, x in out.items()}, {c: len(x) for c, x in out.items()}


def test_chat_recovers_roles_whatever_the_chunks(spark, monkeypatch):
    rows = chat_rows()
    whole, sizes = decoded(spark, rows)
    assert set(sizes.values()) == {1}
    assert all(whole[c][3] == ["user", "assistant"] * 3 for c in range(1, 30))
    assert whole[79][3] == ["user", "assistant"] * 500 and whole[79][2] == 1000
    # the chain over whole conversations, by plain loops
    m = chat.model()
    for c, (text, n, _, _) in whole.items():
        if c in (77, 78):  # turns that share a number stand by a hash
            continue
        t = spark.createDataFrame(sorted({(i, (t is not None, t or 0), r, x) for i, t, r, x, _ in rows if i == c}) or [], "c long, t struct<a:boolean,b:long>, role string, text string").select(F.col("c").alias("conv_id"), F.when(F.col("t.a"), F.col("t.b")).alias("turn"), "role", "text")
        shown = [r.shown for r in sorted(chat.shown(t).collect(), key=lambda r: (r.turn is not None, r.turn))]
        if c == 0:
            shown[:1] *= 3
        lines = [x for s in shown for x in [*s.split("\n"), ""]]
        o, cuts = chat.observations(lines, np.array([0]))
        states = chat.viterbi(chat.emissions(o, m), np.array([len(lines)]), m).tolist()
        assert (text, n) == (chat.turns_of(lines, cuts, o[:, 0].tolist(), states, True)[1], len(lines))
    for chunk in (1, 100):
        monkeypatch.setattr(chat, "CHUNK", chunk)
        cut, sizes = decoded(spark, rows)
        assert cut == whole and sizes[79] > 100
    assert decoded(spark, rows[:0] + rows[-1:])[0][79][1] == 3


def test_chat_learns(spark):
    conv = spark.createDataFrame(chat_rows(), "conv_id long, turn long, role string, text string, n_lines long")
    turns = chat.shown(conv.where("conv_id < 30 or conv_id = 79"))
    m = chat.learn(turns)
    q = np.exp(m["question"][1] / chat.SCALE)
    assert q[2] < chat.QUESTION[2] and q[4] > chat.QUESTION[4] and m["start"].shape == (6,) and np.exp(m["move"][:, :] / chat.SCALE).sum(1) == pytest.approx(np.ones(6), abs=1e-3)
    assert (chat.learn(turns.limit(0))["move"] == chat.model()["move"]).all()
    got, _ = decoded(spark, chat_rows(), m)
    assert got[79][2] == 1000


def test_chat_of_raw_transcripts(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (3, "User: a?\n\nAssistant: b\nc\n\n"), (3, "\n")], "i long, text string")
    got = sorted((r.i, r.n_lines, r.rendered) for r in chat.parse(d, ["i"]).collect())
    assert got == [(1, 0, ""), (2, 0, ""), (3, 2, got[2][2]), (3, 6, "<|user|>\na?\n<|end|>\n<|assistant|>\nb\nc\n\n<|end|>\n")]
    assert chat.parse(d.limit(0), ["i"]).count() == 0
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.parse_turns(chat.shown(empty)).count() == 0


# ---- 3 toxicity and 7 quality


def slow_segments(x):
    """Maximal segments by their definition: best segment, then recursively left and right of it."""
    best = max(((sum(x[i : j + 1]), -(j - i), -i) for i in range(len(x)) for j in range(i, len(x))), default=None)
    if best is None or best[0] <= 0:
        return []
    i = -best[2]
    j = i - best[1]
    return [*slow_segments(x[:i]), (i, j, best[0]), *((a + j + 1, b + j + 1, s) for a, b, s in slow_segments(x[j + 1 :]))]


def test_segments_are_the_maximal_ones():
    r = np.random.default_rng(4)
    for _ in range(200):
        x = (r.integers(-9, 10, r.integers(0, 14)) + r.random() * 0.001).tolist()
        got, want = toxicity.maximal_segments(x), slow_segments(x)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]


def test_segments_take_linear_time():
    """A million tokens that go up and down, up and up, and at random: entries looked at stay below the tokens."""
    r = np.random.default_rng(9)
    n = 500_000
    for x in ([1.0, -2.0] * n, [2.0, -1.0] * n, r.uniform(-1, 1, 2 * n).tolist(), r.uniform(-1, 0.9, 2 * n).tolist()):
        steps: list[int] = []
        toxicity.maximal_segments(x, steps)
        assert steps[0] <= 2 * n


@pytest.fixture(scope="module")
def labelled(spark):
    import random

    r = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        t = " ".join(r.choice(["river", "stone", "cloud", "tree", "grass", "bird"]) for _ in range(r.randrange(20, 60)))
        bad, toxic = i % 5 == 0, i % 4 == 0
        if toxic:
            w = t.split()
            for k in r.sample(range(len(w)), 3):
                w[k] = r.choice(["vermin", "wretch", "scoundrel"])
            t = " ".join(w)
        if bad:
            t = "\n".join("$$$ ### " + x.upper() + " %%%" for x in t.split()[:12])
        rows.append((i, t))
        labels.append((i, int(not bad), int(toxic), 1))
    labels += [(None, 1, 1, 1), (1000, None, None, 1), labels[0]]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text int")


@pytest.mark.parametrize(("op", "label", "k", "held"), [(toxicity, "toxic", 3, 1), (quality, "quality", 5, 0)])
def test_classifiers(spark, docs, nothing, labelled, op, label, k, held):
    d, labels = labelled
    model = op.learn(d, labels)
    y = {r.doc_id: r[label] for r in labels.collect()}
    out = op.score(d, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % k == held) for r in out)
    held_rows = [r for r in out if r.held_out]
    assert np.mean([r.predicted == y[r.doc_id] for r in held_rows]) >= 0.95
    scored = op.score(docs, model)
    assert scored.count() == docs.count()
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    assert op.score(nothing, model).count() == 0
    assert op.learn(d.limit(0), labels) is None
    assert op.score(docs, None).where("score <> 0.5").count() == 0
    kept = op.keep(docs, model)
    assert kept.columns == docs.columns
    want = 1 if label == "quality" else 0
    assert kept.count() == scored.where(f"predicted = {want}").count()


def test_forward_backward_sums_over_all_paths():
    r = np.random.default_rng(3)
    counts = np.array([4, 1])
    scores, moves = r.normal(size=(5, 2)), r.normal(size=(2, 2))
    p, pairs, _ = quality.forward_backward(scores, moves, counts)
    paths = {q: math.exp(sum(scores[i, s] for i, s in enumerate(q)) + sum(moves[a, b] for a, b in zip(q, q[1:]))) for q in np.ndindex(2, 2, 2, 2)}
    z = sum(paths.values())
    for i in range(4):
        assert abs(p[i] - sum(v for q, v in paths.items() if q[i]) / z) < 1e-9
    assert abs(pairs[1, 0] - sum(v * sum(a == 1 and b == 0 for a, b in zip(q, q[1:])) for q, v in paths.items()) / z) < 1e-9


def test_repeats_do_not_cross_texts():
    """Copies of a one-word text, and texts that begin as the one before ends, get the segments they get alone; within a text a repeated word counts once."""
    w = Words(pa.array(["vermin"]), toxicity._NOT_LETTER)
    h = np.unique(np.concatenate([h for _, h in toxicity._features(w, np.array([0]))]))
    model = toxicity.Model(h, np.full(len(h), 50), np.zeros(len(h)), 0.1)
    texts = ["vermin", "vermin", "", None, "vermin", "vermin here vermin", "vermin here vermin", "vermin vermin"]
    got = model.segments(pa.array(texts))
    alone = [model.segments(pa.array([t], pa.string()))[0] for t in texts]
    same = lambda a, b: [(x[:2], round(x[2], 9)) for x in a] == [(x[:2], round(x[2], 9)) for x in b]
    assert got[0] and all(same(a, b) for a, b in zip(got, alone))
    assert round(sum(v for _, _, v in got[7]), 9) == round(got[0][0][2], 9)


def test_quality_learns_from_all_lines(spark):
    """Documents that differ only after their 250th line, where a few long lines hold most bytes."""
    head = "\n".join("A plain line of words that all texts share." for _ in range(250))
    tails = ("\n".join("$$$ ### %%% ||| " * 30 for _ in range(100)), "\n".join("The last part goes on with good words, one after another. " * 8 for _ in range(100)))
    d = spark.createDataFrame([(i, f"{head}\n{tails[i % 2]}") for i in range(60)], "doc_id long, text string")
    model = quality.learn(d, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int"))
    assert all(r.predicted == r.doc_id % 2 for r in quality.score(d, model).collect())


def test_quality_relabels_lines_of_bad_documents():
    """Lines that look good are good also in bad documents; the worst half of the bytes stays bad."""
    p = np.array([0.9, 0.1, 0.9, 0.2, 0.9, 0.8])
    size = np.array([10, 10, 10, 10, 10, 90])
    got = quality.line_labels(p, size, np.array([2, 2, 2]), np.array([1, 0, 0]))
    assert got.tolist() == [1, 1, 1, 0, 1, 0]


def test_quality_fit_is_bounded_in_rows(spark):
    """An id with many texts, and with many equal rows, brings at most `rows` of them."""
    d = spark.createDataFrame([(1, f"good words {i % 40}") for i in range(400)] + [(3, "$$$ ### %%%")] * 300, "doc_id long, text string")
    model = quality.learn(d, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int"), rows=30)
    assert model is not None and quality.score(d, model).where("doc_id = 3").count() == 300


# ---- 4 WARC


def page_rows():
    big = "<p>same</p>" * 200
    return [(1, "http://a", big), (5, "http://b c\n", big), (3, None, big), (None, "u", big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", "é" * 600), (9, "u", "é" * 600), (10, "u", "long " * 200000), (5, "again", big)]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*r, "x", 1) for r in page_rows()], "page_id long, url string, html string, digest string, payload int")
    back = warc.read(warc.archives(warc.typed(pages.repartition(3)))).collect()
    assert all(r.kind == "record" for r in back)
    got = sorted((r.id, r.payload_bytes, r.payload_digest, r.type, r.refers_to or "") for r in back)
    want = []
    for i, _, h in page_rows():
        b = (h or "").encode()
        ids = [j for j, _, g in page_rows() if g == h and j is not None]
        revisit = len(b) >= 1000 and i != max(ids)
        want.append((f"<urn:page:{'' if i is None else i}>", len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", f"<urn:page:{max(ids)}>" if revisit else ""))
    assert got == sorted(want)
    assert warc.read(warc.archives(warc.typed(pages.limit(0)))).count() == 0


@pytest.mark.parametrize("shape", [lambda r: r, warc._member])
def test_warc_salvage(shape):
    parts = [shape(warc.record(i, "u", b"payload %d " % i * 50, hashlib.sha1(b"payload %d " % i * 50).hexdigest(), "response", None)) for i in range(8)]
    data = bytearray(b"".join(parts))
    at = sum(map(len, parts[:3])) + len(parts[3]) * 2 // 3
    data[at : at + 4] = b"\0\0\0\0"
    data = bytes(data[:-9]) if shape is warc._member else bytes(data[:-2])
    out = list(warc.salvage(data))
    assert [x["id"] for k, _, _, x in out if k == "record"] == [f"<urn:page:{i}>" for i in (0, 1, 2, 4, 5, 6)]
    gaps = [(a, n) for k, a, n, _ in out if k == "gap"]
    assert gaps[0] == (sum(map(len, parts[:3])), len(parts[3])) and gaps[1][0] + gaps[1][1] == len(data)
    assert list(warc.salvage(b"")) == [] and [k for k, *_ in warc.salvage(b"junk")] == ["gap"]


def test_warc_salvage_inside_a_member():
    parts = [warc.record(i, "u", b"payload %d " % i * 50, hashlib.sha1(b"payload %d " % i * 50).hexdigest(), "response", None) for i in range(8)]
    spoiled = bytearray(b"".join(parts))
    at = sum(map(len, parts[:3])) + len(parts[3]) * 2 // 3
    spoiled[at : at + 4] = b"\0\0\0\0"
    ids = lambda data: [x["id"] for k, _, _, x in warc.salvage(data) if k == "record"]
    member = warc._member(bytes(spoiled))
    assert ids(b"junk" + member + warc._member(parts[0])) == [f"<urn:page:{i}>" for i in (0, 1, 2, 4, 5, 6, 7, 0)]
    gap = next(x for x in warc.salvage(b"junk" + member) if x[0] == "gap" and x[1] == 4)
    assert gap[2] == len(member) and f"bytes {sum(map(len, parts[:3]))} to {sum(map(len, parts[:4]))}" in gap[3]
    whole = warc._member(b"".join(parts))
    crc = whole[:-8] + b"\0\0\0\0" + whole[-4:]
    assert ids(crc + warc._member(parts[0])) == [f"<urn:page:{i}>" for i in (*range(8), 0)]
    assert len(ids(whole[: len(whole) * 9 // 10])) >= 4
    assert [k for k, *_ in warc.salvage(crc)][-1] == "gap"


# ---- 5 licences


def test_licences(spark, docs, nothing):
    rows = [(1, "text\nReleased under the MIT License.\nmore"), (2, "Licensed under CC BY-NC 4.0."), (3, "He lost his driving licence."), (4, None), (5, ""), (5, "Licensed under the Apache License, Version 2.0.\nLicensed under the Apache License, Version 2.0."), (None, "This work is licensed under the GNU General Public License, version 3.")]
    d = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, line string, families int")
    got = sorted((r.doc_id or 0, ",".join(r.families), sum(p.family != "unknown" for p in r.paragraphs)) for r in licenses.license_families(d).collect())
    assert got == [(0, "gpl", 1), (1, "mit", 1), (2, "cc-by-nc", 1), (3, "", 0), (4, "", 0), (5, "", 0), (5, "apache-2.0", 2)]
    assert licenses.license_families(docs).count() == docs.count()
    assert licenses.license_families(nothing).count() == 0


def test_licences_wrapped_and_short(spark):
    wrapped = {
        "mpl": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files to deal in\nthe Software without restriction.",
        "proprietary": "All rights reserved.",
    }
    texts = [*wrapped.values(), *(f"Some words before.\n\n{t}\n \t\nSome words after." for t in wrapped.values())]
    prose = ["All human rights\nwere debated.", "The rights of all\npeople.\n\nA table reserved."]
    d = spark.createDataFrame(list(enumerate([*texts, *prose])), "doc_id long, text string")
    got = {r.doc_id: r.families for r in licenses.license_families(d).collect()}
    assert [got[i] for i in range(len(got))] == [[f] for f in wrapped] * 2 + [[], []]
    assert all(any(p.family != "unknown" for p in r.paragraphs) for r in licenses.license_families(d.where("doc_id < 6")).collect())


PROBES = {
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use it.',
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    "lgpl": "The library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    "cc-by-sa": "This text is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nd": "This text is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "epl": "This program is made available under the terms of the Eclipse Public License 2.0.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "boost": "Distributed under the Boost Software License, Version 1.0. (See accompanying file.)",
    "": "Licensed under the European Union Public Licence, version 1.1 or later.",
}


def test_licences_told_apart(spark):
    """Whole and wrapped at 70 columns; what is calibrated on is not fitted on; other licences are unknown."""
    import textwrap

    rows = [(f, text) for f, p in PROBES.items() for text in (p, textwrap.fill(p, 70), f"A title\n\n{textwrap.fill(p, 50)}\n\nSome words after.")]
    d = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: ",".join(r.families) for r in licenses.license_families(d).collect()}
    assert [got[i] for i in range(len(rows))] == [f for f, _ in rows]
    fitted = {" ".join(licenses._tokens(s)) for s in (*licenses.OTHERS, *(s for n in licenses.NOTICES.values() for s in n))}
    held = [(f, s) for f, x in licenses.HELD.items() for s in x]
    assert not fitted & {" ".join(licenses._tokens(s)) for _, s in held}
    d = spark.createDataFrame([(i, s) for i, (_, s) in enumerate(held)], "doc_id long, text string")
    got = {r.doc_id: ",".join(r.families) or "unknown" for r in licenses.license_families(d).collect()}
    assert np.mean([got[i] == f for i, (f, _) in enumerate(held)]) >= 0.85
    assert all(got[i] in (f, "unknown") for i, (f, _) in enumerate(held))


def test_licence_probabilities_by_plain_python(spark):
    names, weights, bias = licenses.trained()
    texts = [s.lower() for n in licenses.NOTICES.values() for s in n]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.license_families(d).collect():
        words = licenses._tokens(texts[r.doc_id])
        z = np.array(bias) + sum(np.array(weights[g]) for g in licenses._grams(words) if g in weights)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        (found,) = r.paragraphs
        share = max(len(set(licenses._tokens(s)) & set(words)) / len(set(licenses._tokens(s))) for s in licenses.NOTICES[names[p.argmax()]])
        assert (found.family, found.probability, found.share) == (names[p.argmax()], round(p.max(), 6), round(share, 6))


def test_licence_prefilter_drops_nothing():
    """Without all its needed words, a notice has too few words left to be confirmed."""
    for s in (s for n in licenses.NOTICES.values() for s in n):
        words = set(licenses._tokens(s))
        left = [w for w in words if not w.startswith(licenses._needed())]
        assert len(left) / len(words) < (licenses.SHARE if len(words) >= licenses.WHOLE else 1)


# ---- 6 language model


def test_language_model(spark, docs, nothing):
    out = lm.score_corpus(docs).collect()
    rows = rows_of(docs)
    c = collections.Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            c.update([*tokens(t), b" end"])
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if i is None else i, len(w := [*tokens(t), b" end"]), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 4)) for i, t in rows)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out)
    assert got == want
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert lm.score_corpus(nothing).count() == 0


def hashes_of(t):
    return Words(pa.array([t], pa.string())).hashes.tolist()


def test_language_model_by_brute_force(spark, docs, monkeypatch):
    """score is the product of both softmaxes, summed outcome by outcome, and of the words' shares of their cells."""
    w = np.random.default_rng(0).normal(size=(2, 256, lm.CLASSES)).astype(np.float32)
    monkeypatch.setattr(lm, "train", lambda tokens, rows, n_cell: w)
    rows = [(i, t) for i, t in rows_of(docs) if len(t or "") < 3000]
    end, start, mask = int(lm.END), int(lm.START), (1 << 64) - 1
    c = collections.Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            c.update([*hashes_of(t), end])
    cell = lambda h: h >> 64 - 2 * lm.DIGIT
    n, ones = collections.Counter(), collections.Counter()
    for h, k in c.items():
        n[cell(h)] += k
        ones[cell(h)] += k == 1 and h != end

    def mixed(x):
        x ^= x >> 32
        x = x * 0x9E3779B97F4A7C15 & mask
        x ^= x >> 29
        x = x * 0xD6E8FEB86659FD93 & mask
        return x ^ x >> 32

    row = lambda kind, x, least: least + mixed(x + kind * 0x9E3779B97F4A7C15 & mask) % (256 - least)

    def share(level, features, target):
        z = [sum(float(w[level, f, k]) for f in features) for k in range(lm.CLASSES)]
        return math.exp(z[target]) / sum(map(math.exp, z))

    def logp(t):
        seq, total = [start, start, *hashes_of(t), end], 0.0
        for two, one, h in zip(seq, seq[1:], seq[2:]):
            kind, group = divmod(cell(h), lm.CLASSES)
            own = kind * 0xD6E8FEB86659FD93
            p = share(0, (0, row(1, one, 1), row(2, two, 1)), kind)
            p *= share(1, (kind, row(4, one + own, lm.CLASSES), row(5, two + own, lm.CLASSES)), group)
            unseen = (ones[cell(h)] + 0.5) / (n[cell(h)] + 1) if n[cell(h)] else 1.0
            total += math.log10(p * ((1 - unseen) * c[h] / n[cell(h)] if c[h] else unseen))
        return total

    got = sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in lm.score_corpus(docs.where("text is null or length(text) < 3000")).collect())
    want = sorted((-1 if i is None else i, logp(t)) for i, t in rows)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [x for _, x in got] == pytest.approx([x for _, x in want], abs=0.01)


def test_sums_of_rows_by_key():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 1000):
        keys, values, table = r.integers(0, 9, n) ** 2, r.normal(size=(n, 3)), np.zeros((81, 3))
        lm.add_rows(table, keys, values)
        assert all(np.allclose(table[k], values[keys == k].sum(0)) for k in range(81))


def test_counts_do_not_depend_on_what_goes_together(spark, docs, monkeypatch):
    one = sorted(map(tuple, lm.score_corpus(docs).select("doc_id", "n_known", "base_score").collect()), key=repr)
    monkeypatch.setattr(lm, "TOGETHER", 3)
    monkeypatch.setattr(lm, "PIECE", 500)
    two = sorted(map(tuple, lm.score_corpus(docs.repartition(7)).select("doc_id", "n_known", "base_score").collect()), key=repr)
    assert [x[:2] for x in one] == [x[:2] for x in two] and np.allclose([x[2] for x in one], [x[2] for x in two])


def test_gradient_is_that_of_the_likelihood():
    r = np.random.default_rng(3)
    w = r.normal(size=(2, 128, lm.CLASSES)).astype(np.float32)
    hashes, counts = r.integers(0, 1 << 63, 12, dtype=np.uint64)[r.integers(0, 12, 60)], np.array([0, 40, 20])
    seq, one, two, _ = lm.sequence(hashes, counts)
    sums, seen = np.zeros((2, 128, lm.CLASSES), np.float32), np.zeros((2, 128, lm.CLASSES))
    lm.gradient(w, seq, one, two, sums, seen)
    assert seen[0, 0].sum() == len(seq) == 63 and seen.sum() == 6 * 63
    for level, row, k in ((0, 0, 5), (1, *divmod(int(lm.cells(seq[:1])[0]), lm.CLASSES)), (0, int(lm.class_rows(one, two, 128)[2][7]), 9)):
        up, down = w.astype(np.float64), w.astype(np.float64)
        up[level, row, k] += 1e-3
        down[level, row, k] -= 1e-3
        slope = (lm.log_probability(up, seq, one, two).sum() - lm.log_probability(down, seq, one, two).sum()) / 2e-3
        assert abs(slope - sums[level, row, k]) < 1e-2


def test_training_raises_the_score(spark):
    """Words that depend on the word before are told apart from their frequencies, on texts that training did not see."""
    import random

    r = random.Random(6)
    nxt = {f"w{i}": [f"w{(i * 7 + j) % 50}" for j in (1, 2)] for i in range(50)}
    rows = []
    for i in range(400):
        w = ["w0"]
        while len(w) < 60:
            w.append(r.choice(nxt[w[-1]]))
        rows.append((i, " ".join(w)))
    out = [r for r in lm.score_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.held_out]
    assert sum(r.score for r in out) > 0.6 * sum(r.base_score for r in out)


# ---- 8 near duplicates


@pytest.mark.parametrize(("k", "num"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, docs, nothing, k, num):
    out = {(r.doc_id, r.n_shingles): r for r in neardup.near_duplicates(docs, shingle=k, num=num).collect()}
    sets = {}
    for i, t in rows_of(docs):
        w = tokens(t)
        s = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) or frozenset([tuple(w)] if w else [])
        sets[i] = s
    root = {i: i for i in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if sets[a] and sets[b] and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    for (i, n), r in out.items():
        assert n == len(sets[i])
        assert (r.component_id, r.kept) == ((None, True) if i is None else (root[i], root[i] == i))
    assert len(out) == len(sets)
    assert neardup.near_duplicates(nothing).count() == 0


def test_blocks_of_large_buckets(spark, monkeypatch):
    """Buckets beyond the limits of one block give the same components."""
    import random

    r = random.Random(1)
    base = [str(r.randrange(10**6)) for _ in range(60)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(r.randrange(0, 7)):
            w[r.randrange(60)] = str(r.randrange(10**6))
        rows.append((i, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    one = {r.doc_id: r.component_id for r in neardup.near_duplicates(d, shingle=3, num=85).collect()}
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "FEW", 2)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(d, shingle=3, num=85).collect()} == one
    monkeypatch.setattr(neardup, "WIDE", 0)  # every bucket of two blocks is banded again
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(d, shingle=3, num=85).collect()} == one


def test_recall_of_bands_and_registers():
    """Pairs at the threshold: how many the bands, the bands that share two and three (large buckets), and the register test let through."""
    r = np.random.default_rng(12)
    pairs, n, j = 400, 200, 0.85
    common = round(2 * n * j / (1 + j))
    hits = np.zeros(4)
    for _ in range(pairs):
        x = r.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64)
        a, b = (neardup.sketch_sets(s, np.array([0]), 96)[0] for s in (x[:n], x[n - common :]))
        shared = (a == b).reshape(24, 4).all(1).sum()
        fine = neardup.plausible([n], [n], [(a > b).sum()], [(a < b).sum()], 96, j)[0]
        hits += [shared >= 1, shared >= 2, shared >= 3, fine]
    assert (hits >= [pairs, pairs, pairs - 1, pairs - 1]).all()


def test_first_common_bands():
    r = np.random.default_rng(3)
    common = r.random((200, 5)) < 0.4
    code = r.integers(0, 6**3, 200)
    got = neardup._first_common(common, code, 6)
    for x, c, ok in zip(common, code.tolist(), got):
        want = [c // 6**k % 6 for k in range(3)]
        while want and not want[-1]:
            want.pop()
        have = (np.flatnonzero(x) + 1).tolist()
        if 0 not in want:
            assert ok == (have[: len(want)] == want)


def test_sketches_estimate_and_merge():
    r = np.random.default_rng(5)
    a, b = r.integers(0, 1 << 63, 900, dtype=np.uint64), r.integers(0, 1 << 63, 300, dtype=np.uint64)
    both = np.concatenate((a[:600], b))
    x, y = (neardup.sketch_sets(s, np.array([0]), 2048)[0] for s in (a, both))
    assert abs((x == y).mean() - 0.5) < 0.05
    parts = [neardup.sketch_sets(s, np.array([0]), 64)[0] for s in (a[:500], a[500:])]
    assert (np.maximum(*parts) == neardup.sketch_sets(a, np.array([0]), 64)[0]).all()


# ---- 9 mixing


def test_mixing(spark, docs, nothing):
    out = mixing.mix(docs).collect()
    rows = [(r.doc_id, r.source, len(tokens(r.text))) for r in docs.select("doc_id", "source", "text").collect()]
    sizes = collections.Counter()
    for _, s, n in rows:
        sizes[s] += n
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    got = collections.Counter()
    for r in out:
        assert r.taken <= 3 * r.size
        got[r.source_size, round(r.target, 4)] += r.taken
    for (_, t), taken in got.items():
        assert abs(taken - t) <= 1
    assert {t for _, t in got} == {round(t, 4) for t in target.values()}
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=repr) == sorted(map(tuple, out), key=repr)
    assert mixing.mix(nothing).count() == 0


# ---- 10 decontamination


@pytest.mark.parametrize("small", [200_000, 0])
def test_decontamination(spark, docs, nothing, monkeypatch, small):
    monkeypatch.setattr(decontam, "SMALL", small)
    words = [f"w{i}" for i in range(40)]
    spoiled = list(words)
    for i in (5, 14, 23, 31):
        spoiled[i] = "other"
    rows = [(1, "a b c " + " ".join(words).upper() + " d e"), (2, "x " + " ".join(spoiled)), (3, " ".join(words[:6])), (4, None), (5, ""), (6, "clean text with nothing in it"), (None, " ".join(words)), (1, "repeat"), (7, ", ".join(words[10:30]))]
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, id long")
    items = spark.createDataFrame([(11, " ".join(words), 1), (12, None, 1), (13, "too short", 1), (None, " ".join(f"v{i}" for i in range(20)), 1)], "item_id long, text string, hash long")
    got = sorted((r.doc_id or 0, r.item_id, r.score, r.first_word, r.last_word) for r in decontam.contaminated(d, items).collect())
    assert got == [(0, 11, 40, 0, 39), (1, 11, 40, 3, 42), (2, 11, 32, 1, 40), (7, 11, 20, 0, 19)]
    assert decontam.contaminated(nothing, items).count() == 0
    assert decontam.contaminated(docs, items).count() == 0
    assert decontam.contaminated(d, items.limit(0)).count() == 0


@pytest.mark.parametrize("small", [200_000, 0])
def test_decontamination_of_short_items_and_regular_substitutions(spark, monkeypatch, small):
    monkeypatch.setattr(decontam, "SMALL", small)
    name = lambda n: [f"n{n}w{i}" for i in range(n)]
    every = [w if i % 4 else "other" for i, w in enumerate(name(30))]
    rows = [(n, "before " + " ".join(name(n)) + " after") for n in range(1, 10)] + [(30, " ".join(every)), (77, "x n7w0 n7w1 n7w2 x n7w4 n7w5 n7w6 x")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(n, " ".join(name(n))) for n in (*range(1, 10), 30)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.score) for r in decontam.contaminated(d, items).collect())
    assert got == [*((n, n, n) for n in range(1, 10)), (30, 30, 15), (77, 7, 5)]


def test_short_masks_hit_all_that_is_accepted():
    for n in range(1, decontam.SHORT):
        for p in np.ndindex(*[2] * n):
            if decontam._best(p) >= decontam.SHARE * n:
                assert decontam._hit(p, (*decontam.MASKS, *decontam.short_masks(n)))


def test_words_are_those_of_the_contract(texts):
    import pyarrow as pa

    w = Words(pa.array(texts, pa.string()))
    assert w.counts.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
