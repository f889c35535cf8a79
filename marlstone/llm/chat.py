"""Roles of transcript lines by a hidden Markov model, and canonical turns.

States are pairs of a role (system, user, assistant) and whether a line begins a turn or goes on with it. A line is
observed as a speaker marker (of a role, or none) and features: blank, after a blank line, ending in a question mark.
Viterbi finds the most likely states; every line that begins a turn opens one, markers are taken off, and turns are
rendered as <|role|> blocks; a blank line before a turn or at the end is what parts turns and is dropped. Log
probabilities are whole numbers, so a path's sum does not depend on how it is added up.

parse() decodes transcripts that are rows. parse_turns() decodes conversations of any length, whose turns are rows: they
are put in order by range, cut into chunks of whole turns (CHUNK bytes or one turn), and decoded as one chain: each
chunk's best sums from its first to its last line's states are composed in order, then the states at the chunks' ends are
traced back, and last each chunk is decoded between its known ends. What passes between tasks is some numbers per
chunk; results don't depend on where chunks are cut.

learn() estimates the probabilities from a bounded sample of conversations whose roles are known, with the values below
as prior counts; parse() takes these values as they are unless it is given a model.

Rows: null and empty transcripts have no turns and an empty rendering; ids may be null (one conversation) or repeated; a
null turn comes first, turns with one number stand by a hash of role and text; repeated rows are repeated turns; null texts and
roles count as empty and as user; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, remainder, written

ROLES = ("system", "user", "assistant")
CHUNK = 1 << 18  #: bytes of turns that are decoded together
FIT_CONVERSATIONS = 2000  #: conversations that the probabilities are estimated from, at most: those whose ids hash lowest
FIT_TURNS = 20_000  #: and turns of them, at most
PRIOR = 50.0  #: lines that the values below count as
SCALE = 1 << 20
NEVER = -(1 << 40)

#: How speakers are marked.
_NAMES = {"system": 0, "sys": 0, "context": 0, "user": 1, "human": 1, "q": 1, "customer": 1, "prompter": 1, "assistant": 2, "ai": 2, "bot": 2, "a": 2, "agent": 2, "model": 2}
_MARK = re.compile(r"^\s*(?:#{1,4}\s*|\*\*|\[|<\|)?(" + "|".join(_NAMES) + r")(?:\*\*|\]|\|>)?\s*(?::\*\*|:|(?<=[\]>])|$)[ \t]*", re.IGNORECASE)
_HEAD = re.compile(r"^\s*#{1,4}\s*(" + "|".join(_NAMES) + r")\s*:?\s*$", re.IGNORECASE)


def _begin(p_system: float, p_user: float, p_assistant: float) -> list[float]:
    return [p_system, p_user, p_assistant]


#: P(next role | role) at a change of turn, and at the start.
CHANGE = np.array([_begin(0.02, 0.93, 0.05), _begin(0.02, 0.08, 0.90), _begin(0.02, 0.90, 0.08)])
START = np.array(_begin(0.25, 0.70, 0.05))
TURN = 0.3  #: chance that a turn ends after a line
#: P(marker | state): none, then system, user, assistant.
MARKS = np.array([[0.25, *(0.73 if r == s else 0.01 for s in range(3))] for r in range(3)] + [[0.985, 0.005, 0.005, 0.005]] * 3)
#: P(after a blank line | state), P(blank | state), P(question mark at the end | state); states are begin x 3, then go on x 3.
AFTER_BLANK = np.array([0.6, 0.6, 0.6, 0.02, 0.02, 0.02])
BLANK = np.array([0.001, 0.001, 0.001, 0.2, 0.2, 0.2])
QUESTION = np.array([0.05, 0.35, 0.12, 0.05, 0.25, 0.12])




def _whole(p) -> np.ndarray:
    return np.round(np.log(np.clip(p, 1e-9, 1)) * SCALE).astype(np.int64)


def model(start=START, change=CHANGE, turn: float = TURN, marks=MARKS, after=AFTER_BLANK, blank=BLANK, question=QUESTION) -> dict[str, np.ndarray]:
    """Log probabilities: start (6), move (6 x 6), and per kind of observation (outcomes x 6)."""
    first, move = np.full(6, NEVER), np.full((6, 6), NEVER)
    first[:3] = _whole(start)
    for r in range(3):
        for s in (r, r + 3):
            move[s, :3] = _whole(np.array(change[r]) * turn)
            move[s, r + 3] = _whole(1 - turn)
    either = lambda p: _whole(np.stack((1 - np.asarray(p), p)))
    return {"start": first, "move": move, "marks": _whole(np.asarray(marks).T), "after": either(after), "blank": either(blank), "question": either(question)}


def observe(line: str) -> tuple[int, int]:
    """Marker (0: none, else 1 + role) and the length of its text."""
    m = _MARK.match(line) or _HEAD.match(line)
    if not m:
        return 0, 0
    return 1 + _NAMES[m[1].lower()], m.end()


def observations(lines: list[str], first: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(lines x 4: marker, blank, after a blank line, question; lengths of the markers). first: whether a line has none before it; then it is not after a blank one."""
    seen = [observe(x) for x in lines]
    blank = np.array([not x.strip() for x in lines], bool)
    after = np.zeros(len(lines), bool)
    after[1:] = blank[:-1]
    after[first] = False
    question = np.array([x.rstrip().endswith("?") for x in lines], bool)
    return np.stack([np.array([m for m, _ in seen], np.int64), blank, after, question], 1).astype(np.int64).reshape(-1, 4), [c for _, c in seen]


def emissions(o: np.ndarray, m: dict) -> np.ndarray:
    return m["marks"][o[:, 0]] + m["blank"][o[:, 1]] + m["after"][o[:, 2]] + m["question"][o[:, 3]]


class Chains:
    """Chains of lines, one after another in e (lines x 6), decoded in step: the work per line is a few numpy operations."""

    def __init__(self, e: np.ndarray, counts: np.ndarray, m: dict):
        self.e, self.move = e, m["move"]
        self.order = np.argsort(-counts, kind="stable")
        self.first, self.length = (np.cumsum(counts) - counts)[self.order], counts[self.order]
        self.most = int(self.length[0]) if len(counts) else 0
        self.live = np.searchsorted(-self.length, -np.arange(1, self.most + 1), side="right")

    def forward(self, begin: np.ndarray) -> None:
        """begin: best sums at the chains' first lines (chains x 6)."""
        self.best, self.back = np.empty_like(self.e), np.zeros(self.e.shape, np.int8)
        self.best[self.first] = begin[self.order]
        for t in range(1, self.most):
            at = self.first[: self.live[t]] + t
            through = self.best[at - 1][:, :, None] + self.move
            self.back[at] = through.argmax(1)
            self.best[at] = through.max(1) + self.e[at]

    def last(self) -> np.ndarray:
        """Best sums at the chains' last lines."""
        out = np.empty((len(self.order), 6), np.int64)
        out[self.order] = self.best[self.first + self.length - 1]
        return out

    def states(self, ends: np.ndarray) -> np.ndarray:
        """The best path's states, given the last one of each chain."""
        out = np.zeros(len(self.e), np.int64)
        out[self.first + self.length - 1] = ends[self.order]
        for t in range(self.most - 1, 0, -1):
            at = self.first[: self.live[t]] + t
            out[at - 1] = self.back[at, out[at]]
        return out


def viterbi(e: np.ndarray, counts: np.ndarray, m: dict) -> np.ndarray:
    """Best state of every line of whole transcripts."""
    c = Chains(e, counts, m)
    c.forward(m["start"] + e[np.cumsum(counts) - counts])
    return c.states(c.last().argmax(1))


def transfer(e: np.ndarray, counts: np.ndarray, m: dict) -> np.ndarray:
    """Chains x 6 x 6: the best sums from each state at the first line to each at the last, without the first line's own emission."""
    out = np.empty((len(counts), 6, 6), np.int64)
    c = Chains(e, counts, m)
    for s in range(6):
        begin = np.full((len(counts), 6), NEVER)
        begin[:, s] = 0
        c.forward(begin)
        out[:, s] = c.last()
    return out


def turns_of(lines: list[str], cuts: list[int], marks: list[int], states: list[int], closes: bool) -> tuple[list[dict], str]:
    """(turns, rendering) of the lines. A turn whose role is null goes on with one begun before; closes: the last turn ends here."""
    turns: list[dict] = []
    for i, line in enumerate(lines):
        s = states[i]
        if s < 3:
            turns.append({"role": ROLES[s], "text": [line[cuts[i] :] if marks[i] == s + 1 else line]})
            continue
        if not line.strip() and (closes if i + 1 == len(lines) else states[i + 1] < 3):
            line = None
        if not turns:
            turns.append({"role": None, "text": []})
        if line is not None:
            turns[-1]["text"].append(line)
    out, shown = [], []
    for k, t in enumerate(turns):
        body = "\n".join(t["text"])
        shown.append(f"<|{t['role']}|>\n{body}" if t["role"] else "".join(f"\n{x}" for x in t["text"]))
        if k + 1 < len(turns) or closes:
            shown.append("\n<|end|>\n")
        out.append({"role": t["role"], "text": body})
    if closes and lines and not turns:
        shown.append("\n<|end|>\n")
    return out, "".join(shown)


TURNS = "array<struct<role:string,text:string>>"
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def parse(df: DataFrame, id_cols: list[str], text_col: str = "text", m: dict | None = None) -> DataFrame:
    """(ids, n_lines, turns, rendered) of raw transcripts, one a row."""
    m = m or model()

    def run(batches):
        for batch in pieces(batches, column=text_col):
            lines = [x.split("\n") if x else [] for x in batch.column(text_col).to_pylist()]
            counts = np.array([len(x) for x in lines], np.int64)
            first = (np.cumsum(counts) - counts)[counts > 0]
            o, cuts = observations([y for x in lines for y in x], first)
            states = viterbi(emissions(o, m), counts[counts > 0], m).tolist()
            marks, at, turns, rendered = o[:, 0].tolist(), 0, [], []
            for x in lines:
                s = slice(at, at + len(x))
                t, shown = turns_of(x, cuts[s], marks[s], states[s], True)
                turns.append(t)
                rendered.append(shown)
                at += len(x)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in id_cols), pa.array(counts), pa.array(turns, _TURNS), pa.array(rendered, pa.string())], names=[*id_cols, "n_lines", "turns", "rendered"])

    ids = df.select(*id_cols).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ids)
    return df.select(*id_cols, text_col).mapInArrow(run, f"{schema}, n_lines long, turns {TURNS}, rendered string")


def shown(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, shown) of a table of turns: what a transcript of them shows, in one of four styles by conversation; every fifth or so turn lacks its marker."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    style = F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(4))
    short = F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise("System")
    mark = F.when(style == 0, F.concat(F.initcap("role"), F.lit(": "))).when(style == 1, F.concat(F.lit("### "), F.col("role"), F.lit("\n"))).when(style == 2, F.concat(short, F.lit(": "))).otherwise(F.concat(F.lit("["), F.col("role"), F.lit("] ")))
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) == 0) & (F.col("turn") > 0)
    return c.select("conv_id", "turn", "role", F.concat(F.when(bare, "").otherwise(mark), "text").alias("shown"))


def learn(turns: DataFrame, k: int = 5, held: int = 0) -> dict[str, np.ndarray]:
    """The model, from turns as shown() gives them, of conversations whose remainder is not the held-out one."""
    ids = turns.select("conv_id").where(F.col("conv_id").isNotNull() & (remainder(F.col("conv_id"), k) != held)).distinct()
    ids = ids.orderBy(F.xxhash64("conv_id"), "conv_id").limit(FIT_CONVERSATIONS)
    sample = turns.join(F.broadcast(ids), "conv_id").withColumn("h", F.xxhash64("role", "shown"))

    def count(batches):
        for batch in batches:
            rows = []
            for text, role in zip(batch.column("shown").to_pylist(), batch.column("role").to_pylist()):
                o, _ = observations([*text.split("\n"), ""], np.array([0]))
                rest = [np.bincount(o[1:, 0], minlength=4), o[1:, 1:].sum(0)]
                rows.append([ROLES.index(role) if role in ROLES else -1, *o[0].tolist(), *np.concatenate(rest).tolist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "turn", "h")), pa.array(rows, pa.list_(pa.int64()))], names=["conv_id", "turn", "h", "x"])

    found = sample.select("conv_id", "turn", "h", "shown", "role").mapInArrow(count, "conv_id long, turn long, h long, x array<long>")
    rows = found.orderBy(F.xxhash64("conv_id"), "conv_id", F.col("turn").asc_nulls_first(), "h", "x").limit(FIT_TURNS).collect()
    start, change, turn = PRIOR * START, PRIOR * CHANGE, np.array([PRIOR * TURN, PRIOR])
    marks, yes, n = PRIOR * MARKS, PRIOR * np.stack((BLANK, AFTER_BLANK, QUESTION)), np.full(6, PRIOR)
    before = None
    for r in rows:
        role, rest, last = r.x[0], r.x[5:], before
        before = (r.conv_id, role)
        if role < 0:
            continue
        same = last is not None and last[0] == r.conv_id
        if not same:
            start[role] += 1
        elif last[1] >= 0:
            change[last[1], role] += 1
        turn += (1, 1 + sum(rest[:4]))
        marks[role, r.x[1]] += 1
        marks[role + 3] += rest[:4]
        yes[:, role] += (r.x[2], float(same), r.x[4])
        yes[:, role + 3] += rest[4:]
        n[role] += 1
        n[role + 3] += sum(rest[:4])
    blank, after, question = yes / n
    return model(start / start.sum(), change / change.sum(1, keepdims=True), turn[0] / turn[1], marks / marks.sum(1, keepdims=True), after, blank, question)


_CHUNKS = "part long, seq long, conv_id long, alone boolean, text string, roles array<string>, sizes array<int>"


def chunks(turns: DataFrame) -> DataFrame:
    """The turns in order, in chunks: a written table. (part, seq) orders chunks; alone: no other chunk has turns of this conversation; sizes: lines of each turn, a blank one at its end included."""
    schema = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("conv_id", pa.int64()), ("alone", pa.bool_()), ("text", pa.string()), ("roles", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32()))])

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        conv, texts, roles, size, pieces_, ready = None, [], [], 0, 0, []  # the open chunk, how many its conversation has, chunks to give out

        def close() -> None:
            nonlocal texts, roles, size, pieces_, seq
            ready.append({"part": part, "seq": seq, "conv_id": conv, "alone": False, "text": "".join(f"{x}\n\n" for x in texts), "roles": roles, "sizes": [x.count("\n") + 2 for x in texts]})
            texts, roles, size, pieces_, seq = [], [], 0, pieces_ + 1, seq + 1

        first = True  # the partition's first conversation may have begun in the one before, its last may go on in the next
        for batch in batches:
            for c, text, role in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "shown", "role"))):
                if texts and (c != conv or size >= CHUNK):
                    close()
                if c != conv and pieces_:
                    ready[-1]["alone"] = pieces_ == 1 and not first
                    first, pieces_ = False, 0
                conv = c
                texts.append(text)
                roles.append(role)
                size += len(text.encode("utf-8", "surrogatepass"))
            if len(ready) > 1:
                yield pa.RecordBatch.from_pylist(ready[:-1], schema=schema)
                del ready[:-1]
        if texts:
            close()
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=schema)

    keyed = turns.select("conv_id", "turn", F.xxhash64("role", "shown").alias("h"), F.monotonically_increasing_id().alias("row"), "shown", "role")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "h", "row"]
    return written(keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "shown", "role").mapInArrow(run, _CHUNKS), "chunks")


def _lines(text: str) -> list[str]:
    return text.split("\n")[:-1]  # every turn ends in a blank line


def _observed(batch):
    """(lines of each chunk, all lines' observations, marker lengths, counts, first lines, which are taken to be after no blank one)."""
    lines = [_lines(x) for x in batch.column("text").to_pylist()]
    counts = np.array([len(x) for x in lines], np.int64)
    first = np.cumsum(counts) - counts
    o, cuts = observations([y for x in lines for y in x], first)
    return lines, o, cuts, counts, first


def _ints(x: np.ndarray) -> pa.Array:
    return pa.array(x.reshape(len(x), -1).tolist(), pa.list_(pa.int64()))


def _ends(open_: DataFrame, m: dict) -> DataFrame:
    """(part, seq, number, begin, last, closes) of chunks that are not alone: the chunk's number in its conversation, the best sums at its first line, the state of its last, and whether a turn ends there."""

    def summed(batches):
        for batch in pieces(batches):
            _, o, _, counts, first = _observed(batch)
            e = emissions(o, m)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "part", "seq")), _ints(e[first] - m["after"][0]), _ints(transfer(e, counts, m))], names=["conv_id", "part", "seq", "own", "through"])

    def onward(batches):
        conv, v, number, some = None, None, 0, False
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                own, through = np.array(r["own"]), np.array(r["through"]).reshape(6, 6)
                if some and r["conv_id"] == conv:
                    reach = v[:, None] + m["move"]
                    begin, before, number = reach.max(0) + own + m["after"][1], reach.argmax(0), number + 1
                else:
                    begin, before, number = m["start"] + own + m["after"][0], np.full(6, -1), 0
                v = (begin[:, None] + through).max(0)
                low = v.max()  # sums stay small; what is best stays so
                begin, v = begin - low, v - low
                conv, some = r["conv_id"], True
                rows.append((r["part"], r["seq"], number, begin.tolist(), before.tolist()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=["part", "seq", "number", "begin", "before"])

    ordered = lambda df, *by: df.repartition("conv_id").sortWithinPartitions("conv_id", *by)
    sums = open_.select("conv_id", "part", "seq", "text").mapInArrow(summed, "conv_id long, part long, seq long, own array<long>, through array<long>")
    reached = written(ordered(sums, "part", "seq").mapInArrow(onward, "part long, seq long, number long, begin array<long>, before array<long>"), "reached")

    def traced(batches):
        for batch in pieces(batches):
            _, o, _, counts, first = _observed(batch)
            c = Chains(emissions(o, m), counts, m)
            c.forward(np.array(batch.column("begin").to_pylist()).reshape(-1, 6))
            to_first = np.stack([c.states(np.full(len(counts), s))[first] for s in range(6)], 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("conv_id", "part", "seq", "number", "begin", "before")), _ints(to_first), pa.array(c.last().argmax(1))], names=["conv_id", "part", "seq", "number", "begin", "before", "to_first", "best"])

    def back(batches):
        conv, some, last, closes = None, False, 0, True
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if not some or r["conv_id"] != conv:
                    last, closes = r["best"], True
                rows.append((r["part"], r["seq"], r["number"], r["begin"], last, closes))
                begun = r["to_first"][last]
                conv, some, last, closes = r["conv_id"], True, r["before"][begun], begun < 3
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=["part", "seq", "number", "begin", "last", "closes"])

    maps = open_.select("conv_id", "part", "seq", "text").join(reached, ["part", "seq"]).mapInArrow(traced, "conv_id long, part long, seq long, number long, begin array<long>, before array<long>, to_first array<long>, best long")
    return written(ordered(maps, F.desc("part"), F.desc("seq")).mapInArrow(back, "part long, seq long, number long, begin array<long>, last long, closes boolean"), "ends")


def parse_turns(turns: DataFrame, m: dict | None = None) -> DataFrame:
    """(conv_id, chunk, n_lines, turns, rendered, n_turns_written, n_roles_right) of conversations whose turns are rows (conv_id, turn, role, shown).

    A conversation's renderings in the order of chunk, joined, are that of the whole; a chunk's first turn has a null role where it
    goes on with a turn of the chunk before. n_roles_right: turns whose first line was found to begin a turn of their role."""
    m = m or model()
    every = chunks(turns)
    ends = _ends(every.where("not alone"), m)
    alone = every.where("alone").select("*", F.lit(0).cast("long").alias("number"), F.lit(None).cast("array<long>").alias("begin"), F.lit(-1).cast("long").alias("last"), F.lit(True).alias("closes"))
    known = every.where("not alone").join(ends, ["part", "seq"]).select(alone.columns)

    def run(batches):
        for batch in pieces(batches):
            lines, o, cuts, counts, first = _observed(batch)
            e = emissions(o, m)
            last = batch.column("last").to_numpy()
            begin = m["start"] + e[first]
            for i in np.flatnonzero(last >= 0).tolist():
                begin[i] = batch.column("begin")[i].as_py()
            c = Chains(e, counts, m)
            c.forward(begin)
            states = c.states(np.where(last >= 0, last, c.last().argmax(1))).tolist()
            marks, turns_, rendered, right, at = o[:, 0].tolist(), [], [], [], 0
            for x, closes, roles, sizes in zip(lines, *(batch.column(c).to_pylist() for c in ("closes", "roles", "sizes"))):
                s = slice(at, at + len(x))
                t, text = turns_of(x, cuts[s], marks[s], states[s], closes)
                turns_.append(t)
                rendered.append(text)
                starts = np.cumsum(sizes) - sizes
                right.append(sum(states[at + a] < 3 and ROLES[states[at + a]] == r for a, r in zip(starts.tolist(), roles)))
                at += len(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("number"), pa.array(counts), pa.array(turns_, _TURNS), pa.array(rendered, pa.string()), pa.array([len(x) for x in batch.column("roles").to_pylist()], pa.int64()), pa.array(right, pa.int64())],
                names=["conv_id", "chunk", "n_lines", "turns", "rendered", "n_turns_written", "n_roles_right"],
            )

    return alone.union(known).drop("part", "seq", "alone").mapInArrow(run, f"conv_id long, chunk long, n_lines long, turns {TURNS}, rendered string, n_turns_written long, n_roles_right long")


def op2_viterbi(spark, sf_dir: str) -> DataFrame:
    from .common import table

    turns = shown(table(spark, sf_dir, "conversations"))
    out = parse_turns(turns, learn(turns))
    began = F.filter("turns", lambda t: t["role"].isNotNull())
    return out.select("conv_id", "chunk", (remainder(F.col("conv_id"), 5) == 0).alias("held_out"), "n_lines", F.size(began).cast("long").alias("n_turns"), F.array_join(F.transform(began, lambda t: t["role"]), ",").alias("roles"), "n_turns_written", "n_roles_right", F.sha2("rendered", 256).alias("rendered_sha256"))
