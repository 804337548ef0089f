"""Chat formatting: roles of a raw transcript's lines by a hidden Markov model.

A line's hidden state is its role and whether it opens a turn or continues one.
It emits what can be seen of it: the kind of its speaker marker, if any, and
whether nothing else stands on the line, its length, its last and first
characters.  Viterbi finds the likeliest states of all lines together, so turns
without a marker get the role that fits their lines and their neighbours.  Lines
of a turn are joined without their marker and rendered in one canonical form.

A transcript of any length comes in parts of bounded size.  The best scores of a
part from each state before it to each state at its end are a small matrix, and
such matrices chain: up a tree of groups of parts, then down again, where each
group gives its parts their states on the best path of the whole transcript.  Each part
is then decoded between the two states at its ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written
from .texts import per_text

ROLES = ("system", "user", "assistant")
STATES = tuple((r, first) for r in ROLES for first in (True, False))

# Names that speakers go by
NAMES = {
    "system": ("system", "sys", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "client", "question", "q", "me", "prompt"),
    "assistant": ("assistant", "ai", "bot", "chatbot", "agent", "answer", "a", "model", "response"),
}
_ROLE_OF = {n: r for r, names in NAMES.items() for n in names}
_NAME = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
# a name with a colon, a name in brackets, stars or tags, or a heading
MARKER = re.compile(
    rf"\s*(?:(?:\*\*|__)?({_NAME})(?:\*\*|__)?\s*[:>](?:\*\*|__)?|\[({_NAME})\]:?|<\|?/?({_NAME})\|?>:?|#+\s*({_NAME})\s*:?\s*$)[ \t]*",
    re.IGNORECASE)

_LENGTHS = (0, 20, 60, 120, 250, 500, 1000)
# sizes of the features: marker kind, marker alone, length, last character, first character
SIZES = (4, 2, len(_LENGTHS) + 1, 4, 4)


def observe(line: str) -> tuple[tuple[int, ...], str]:
    """What a line emits, and the line without its marker."""
    m = MARKER.match(line)
    kind = 1 + ROLES.index(_ROLE_OF[next(filter(None, m.groups())).lower()]) if m else 0
    rest = line[m.end():] if m else line
    body = rest.strip()
    last = 0 if not body else 1 if body[-1] == "?" else 2 if body[-1] in ".!:" else 3
    first = 0 if not body else 1 if body[0].isupper() else 2 if body[0].islower() else 3
    return (kind, int(bool(m) and not body), sum(len(body) > x for x in _LENGTHS), last, first), rest


@dataclass(frozen=True)
class Model:
    """Log probabilities: of the first state, of a state after a state, and of
    each feature's values in a state."""

    start: np.ndarray
    step: np.ndarray
    emit: tuple[np.ndarray, ...]


def counts(transcripts: Iterable[Sequence[tuple[str, str]]]) -> np.ndarray:
    """Counts of first states, state pairs and emissions of transcripts whose
    turns (role, raw text) are known, one after the other in one vector.  Turns of
    other roles than ROLES are passed over and cut the transcript there."""
    s = len(STATES)
    start, step, emit = np.zeros(s), np.zeros((s, s)), [np.zeros((s, n)) for n in SIZES]
    for turns in transcripts:
        before = None
        for role, raw in turns:
            if role not in ROLES:
                before = None
                continue
            for k, line in enumerate(raw.split("\n")):
                at = STATES.index((role, k == 0))
                for table, value in zip(emit, observe(line)[0], strict=True):
                    table[at, value] += 1
                if before is None:
                    start[at] += 1
                else:
                    step[before, at] += 1
                before = at
    return np.concatenate([t.ravel() for t in (start, step, *emit)])


def model_of(counted: np.ndarray, smooth: float = 0.5) -> Model:
    """The model of such counts, smoothed.  A line continues only a turn of its own role."""
    s = len(STATES)
    cuts = np.cumsum([s, s * s, *(s * n for n in SIZES)])[:-1]
    start, step, *emit = np.split(np.asarray(counted, float) + smooth, cuts)
    step, emit = step.reshape(s, s), [t.reshape(s, -1) for t in emit]
    for j, (role, first) in enumerate(STATES):
        if not first:
            start[j] = 0
            for i, (other, _) in enumerate(STATES):
                if other != role:
                    step[i, j] = 0
    with np.errstate(divide="ignore"):
        return Model(np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)),
                     tuple(np.log(t / t.sum(1, keepdims=True)) for t in emit))


def learn(transcripts: Iterable[Sequence[tuple[str, str]]], smooth: float = 0.5) -> Model:
    """The model of transcripts whose turns (role, raw text) are known."""
    return model_of(counts(transcripts), smooth)


def learn_table(turns: Column, rows: DataFrame, smooth: float = 0.5) -> Model:
    """The same of a column of turns (an array of structs with role and raw):
    counted in the tasks, so only sums reach the driver.  No rows give equal odds."""
    def each(got: list) -> pa.Array:
        return pa.array([counts([[(t["role"], t["raw"]) for t in r or ()]]).tolist() for r in got], pa.list_(pa.float64()))

    one = rows.select(F.posexplode(per_text(lambda: each, "array<double>")(turns)).alias("at", "n"))
    total = np.zeros(len(counts([])))
    for r in one.groupBy("at").agg(F.sum("n").alias("n")).collect():  # as many rows as counts
        total[r["at"]] = r["n"]
    return model_of(total, smooth)


NOTHING = len(STATES)  # what stands before a transcript


def _scores(model: Model, seen: Sequence[tuple[int, ...]]) -> np.ndarray:
    """Emission scores (states x lines)."""
    return sum(t[:, list(v)] for t, v in zip(model.emit, zip(*seen, strict=True), strict=True))


def viterbi(model: Model, seen: Sequence[tuple[int, ...]], before: int = NOTHING, last: int | None = None) -> list[int]:
    """The likeliest states of a sequence of emissions, after the state
    ``before`` and, if it is given, with the state ``last`` at the end; of equal ones the first of STATES."""
    if not seen:
        return []
    score = _scores(model, seen)
    best = (model.start if before == NOTHING else model.step[before]) + score[:, 0]
    back = np.zeros((len(seen), len(STATES)), np.int8)
    for k in range(1, len(seen)):
        ways = best[:, None] + model.step
        back[k] = ways.argmax(0)
        best = ways.max(0) + score[:, k]
    out = [int(best.argmax()) if last is None else last]
    for k in range(len(seen) - 1, 0, -1):
        out.append(int(back[k, out[-1]]))
    return out[::-1]


def transfer(model: Model, seen: Sequence[tuple[int, ...]]) -> np.ndarray:
    """The best score of a part from each state before it, or NOTHING (rows), to each state at its end."""
    score = _scores(model, seen)
    out = np.vstack([model.step, model.start]) + score[:, 0]
    for k in range(1, len(seen)):
        out = (out[:, :, None] + model.step).max(1) + score[:, k]
    return out


def chained(parts: Sequence[np.ndarray]) -> np.ndarray:
    """The transfer of parts that follow each other."""
    out = parts[0]
    for m in parts[1:]:
        out = (out[:, :, None] + m[:NOTHING]).max(1)
    return out


def ends(parts: Sequence[np.ndarray], before: int, last: int) -> list[int]:
    """The state at the end of each part on the best path from ``before`` to ``last``."""
    best, back = parts[0][before], []
    for m in parts[1:]:
        ways = best[:, None] + m[:NOTHING]
        back.append(ways.argmax(0))
        best = ways.max(0)
    out = [last]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


FAN = 64  # parts of a group, groups of a group


def _matrices(group: list[dict]) -> list[np.ndarray]:
    return [np.frombuffer(p["m"]).reshape(NOTHING + 1, NOTHING) for p in group]


def part_states(parts: DataFrame, model: Model) -> DataFrame:
    """key, part, before and last of every row of ``parts`` (key, part, text): the
    states in front of and at the end of each part, on the best path through all
    parts of its key.  ``part`` counts from 0 without gaps; an empty text is one empty line."""
    def measure(texts: list) -> pa.Array:
        return pa.array([transfer(model, [observe(x)[0] for x in (t or "").split("\n")]).tobytes() for t in texts], pa.binary())

    def up(groups: list) -> pa.Array:
        return pa.array([chained(_matrices(g)).tobytes() for g in groups], pa.binary())

    def top(wholes: list) -> pa.Array:
        return pa.array([int(np.frombuffer(m).reshape(NOTHING + 1, NOTHING)[NOTHING].argmax()) for m in wholes], pa.int32())

    state = pa.struct([("part", pa.int64()), ("before", pa.int32()), ("last", pa.int32())])

    def down(rows: list) -> pa.Array:
        out = []
        for r in rows:
            at = ends(_matrices(r["g"]), r["before"], r["last"])
            out.append([{"part": p["part"], "before": b, "last": e} for p, b, e in zip(r["g"], [r["before"], *at], at)])
        return pa.array(out, pa.list_(state))

    level = written(parts.select("key", F.col("part").cast("long").alias("part"),
                                 per_text(lambda: measure, "binary")(F.col("text")).alias("m")), "transfers")
    levels: list[DataFrame] = []
    while not levels or not level.where("part > 0").isEmpty():
        grouped = level.groupBy("key", F.expr(f"part div {FAN}").alias("part")).agg(
            F.sort_array(F.collect_list(F.struct("part", "m"))).alias("g"))
        level = written(grouped.withColumn("m", per_text(lambda: up, "binary")(F.col("g"))), "groups")
        levels.append(level)
    found = level.select("key", "part", F.lit(NOTHING).alias("before"), per_text(lambda: top, "int")(F.col("m")).alias("last"))
    for groups in reversed(levels):
        both = groups.select("key", "part", "g").join(found, ["key", "part"])
        below = per_text(lambda: down, "array<struct<part long, before int, last int>>")(F.struct("g", "before", "last"))
        found = written(both.select("key", F.explode(below).alias("s")).select("key", "s.*"), "states")
    return found


def _turns(model: Model, text: str, before: int, last: int | None) -> tuple[int, bool, list[tuple[str, str]]]:
    """Number of lines, whether the first goes on with the turn before it, and the turns (role, content)."""
    lines = [observe(x) for x in text.split("\n")]
    states = viterbi(model, [o for o, _ in lines], before, last)
    turns: list[tuple[str, list[str]]] = []
    for state, (_, rest) in zip(states, lines, strict=True):
        role, first = STATES[state]
        if first or not turns:
            turns.append((role, []))
        turns[-1][1].append(rest)
    return len(lines), not STATES[states[0]][1], [(role, "\n".join(x).strip()) for role, x in turns]


def parse_text(model: Model, text: str) -> tuple[int, list[tuple[str, str]]]:
    """Number of lines, and the turns (role, content); no lines and no turns for the empty text."""
    if not text:
        return 0, []
    n, _, turns = _turns(model, text, NOTHING, None)
    return n, turns


PARSED = "n_lines long, continues boolean, turns array<struct<role string, content string>>"
_TURN = pa.struct([("role", pa.string()), ("content", pa.string())])


def parse(text: Column, model: Model, before: Column | None = None, last: Column | None = None) -> Column:
    """Struct ``PARSED`` of a transcript; null and empty texts have no turns.
    A row with the states ``before`` and ``last`` is a part of a longer transcript;
    ``continues`` says that its first turn goes on with the last of the part before it."""
    def setup():
        def each(rows: list[dict]) -> pa.Array:
            got = [(0, False, []) if not r["text"] and r["last"] is None else
                   _turns(model, r["text"] or "", NOTHING if r["before"] is None else r["before"], r["last"]) for r in rows]
            return pa.StructArray.from_arrays(
                [pa.array([n for n, _, _ in got], pa.int64()), pa.array([c for _, c, _ in got], pa.bool_()),
                 pa.array([[{"role": r, "content": c} for r, c in t] for _, _, t in got], pa.list_(_TURN))],
                ["n_lines", "continues", "turns"])
        return each

    none = F.lit(None).cast("int")
    return per_text(setup, PARSED)(F.struct(text.alias("text"), (none if before is None else before).alias("before"),
                                            (none if last is None else last).alias("last")))


def render(turns: Column) -> Column:
    """The canonical form: a tag line and the content for each turn.  ``<|`` in
    a content becomes ``< |``, so tags can't be forged."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit("<|"), t["role"], F.lit("|>\n"), F.replace(t["content"], F.lit("<|"), F.lit("< |")), F.lit("\n<|end|>"))), "\n")
