"""Transcripts to canonical chat turns by a hidden Markov model.

The hidden state of a line is its speaker's role. A line is seen as a speaker marker at its beginning, whether it
opens a turn (the first line of a message does, and one with a marker), how long it and its turn are, and how it
ends. Roles follow each other by one transition table where a turn opens, and elsewhere by another, in which a
change of speaker is rare. Tables are
counted over all labelled messages; where a feature is never seen, as markers in messages that are split
already, the stated prior remains. Viterbi finds the best roles of a whole conversation, and each message is
rendered as canonical turns, the markers taken off.

Conversations of any length: messages are range-partitioned by (conversation, turn, text), so that a long one
spans tasks. Each task reduces what it has of a conversation that may go on in another task to a small matrix of
best scores between its first and last role; the driver chains those matrices, at most two a task, which fixes the
roles at every border; then the tasks decode on their own. No task or driver holds a whole long conversation.

Null texts count as empty: one blank line. Null conversation ids form one conversation each message of which
stands alone, and so does a message with a null turn. Ties in turn go by a hash of the text; rows that repeat are
messages that repeat. Roles outside ROLES and null ones are not learned from. Other columns are not looked at. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import bounded_batches
from wxspark.session import scratch_base

ROLES = ("user", "assistant", "system")
#: Names that mark a speaker when a colon follows at the beginning of a line.
SPEAKERS = {
    "user": ("user", "human", "customer", "client", "prompter", "question", "q", "you"),
    "assistant": ("assistant", "ai", "bot", "agent", "model", "answer", "a", "response"),
    "system": ("system", "instruction", "instructions", "context"),
}
MARKER = re.compile(
    r"^\s*[#*\[<|]*\s*(" + "|".join(n for names in SPEAKERS.values() for n in names) + r")\s*[\]>|*]*\s*:\s*[*]*\s*",
    re.IGNORECASE,
)
_ROLE_OF = {name: role for role, names in SPEAKERS.items() for name in names}
#: Values of each feature of a line.
FEATURES = {"marker": 4, "opens": 2, "length": 8, "message": 8, "ending": 4}
#: Prior: counts before any is seen. A marker names its own role, but for one in 100,000.
PRIOR, MARKED, OTHERWISE = 1.0, 1_000.0, 0.01
#: Chance that the speaker changes between two lines of a message.
CHANGE = 0.01
RESULT = "conv_id long, turn long, n_lines int, roles string, role string, rendered string"


class Model(NamedTuple):
    start: np.ndarray
    across: np.ndarray
    within: np.ndarray
    emit: tuple[np.ndarray, ...]  # per feature: a row per role


def _size(n: int) -> int:
    """0 for none, then by powers of two from 16 on."""
    return 0 if n == 0 else min(7, max(1, n.bit_length() - 3))


def observe(text: str | None) -> np.ndarray:
    """A row of feature values for each line of a message."""
    lines = (text or "").split("\n")
    found = [MARKER.match(line) for line in lines]
    opens = [k == 0 or m is not None for k, m in enumerate(found)]
    starts = [k for k, o in enumerate(opens) if o]
    sizes: list[int] = []
    for start, stop in zip(starts, [*starts[1:], len(lines)], strict=True):
        sizes += [sum(map(len, lines[start:stop])) + stop - start - 1] * (stop - start)
    rows = []
    for line, m, o, size in zip(lines, found, opens, sizes, strict=True):
        marker = 0 if m is None else 1 + ROLES.index(_ROLE_OF[m[1].lower()])
        end = line.rstrip()[-1:]
        ending = 1 if end == "?" else 2 if end in (".", "!") and end else 3 if end == ":" else 0
        rows.append((marker, int(o), _size(len(line)), _size(size), ending))
    return np.array(rows, dtype=np.int64)


def _counts(messages: DataFrame) -> list:
    """Rows of (kind, role, other, n): how often each feature value and each neighbour occurs with a role."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, int] = {}
        for batch in batches:
            for role, before, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                r = ROLES.index(role)
                if before is not None:
                    key = ("across", r, ROLES.index(before) if before in ROLES else -1)
                    found[key] = found.get(key, 0) + 1
                for row in observe(text):
                    for name, value in zip(FEATURES, row.tolist(), strict=True):
                        key = (name, r, value)
                        found[key] = found.get(key, 0) + 1
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array([k[2] for k in keys], pa.int64()),
                pa.array(list(found.values()), pa.int64()),
            ],
            ["kind", "role", "other", "n"],
        )

    rows = messages.select("role", "before", "text").mapInArrow(counted, "kind string, role long, other long, n long")
    return rows.groupBy("kind", "role", "other").agg(F.sum("n").alias("n")).collect()  # at most a hundred rows


def learn(messages: DataFrame) -> Model:
    """Tables from all messages with a known role. The message before is the one a turn earlier."""
    known = messages.where(F.col("role").isin(*ROLES))
    # One role a turn: ties count as the smallest name, so that the join does not multiply rows.
    earlier = known.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.min("role").alias("before"))
    paired = known.select("conv_id", "turn", "role", "text").join(earlier, ["conv_id", "turn"], "left")
    paired = paired.withColumn("before", F.when(F.col("turn") == 0, F.lit("")).otherwise(F.col("before")))
    k = len(ROLES)
    start, across = np.full(k, PRIOR), np.full((k, k), PRIOR)
    emit = {name: np.full((k, size), PRIOR) for name, size in FEATURES.items()}
    emit["marker"] = np.full((k, k + 1), OTHERWISE) + np.eye(k, k + 1, 1) * MARKED
    for kind, role, other, n in _counts(paired):
        if kind != "across":
            emit[kind][role, other] += n
        elif other < 0:
            start[role] += n
        else:
            across[other, role] += n
    # Markers are told from one another by the prior alone, whatever the share of lines that have one.
    marked = emit["marker"]
    named = (np.full((k, k), OTHERWISE) + np.eye(k) * MARKED) / (OTHERWISE * k + MARKED)
    share = marked[:, 1:].sum() / marked.sum()
    marked[:, 0], marked[:, 1:] = 1 - share, share * named
    within = np.full((k, k), CHANGE / (k - 1)) + np.eye(k) * (1 - CHANGE - CHANGE / (k - 1))
    log = lambda m: np.log(m / m.sum(axis=-1, keepdims=True))
    return Model(log(start), log(across), log(within), tuple(log(emit[name]) for name in FEATURES))


def scores(lines: np.ndarray, model: Model) -> np.ndarray:
    """Log emission of each line under each role. What holds for a message as a whole counts once, at its first."""
    out = np.zeros((len(lines), len(ROLES)))
    for f, name in enumerate(FEATURES):
        part = model.emit[f][:, lines[:, f]].T
        out += np.where(lines[:, 1:2] == 1, part, 0.0) if name in ("message", "opens") else part
    return out


def viterbi(emit: np.ndarray, opens: np.ndarray, first: np.ndarray, last: np.ndarray, model: Model) -> np.ndarray:
    """Best roles, given the scores of the first line's role and of what follows the last."""
    n, k = emit.shape
    back = np.zeros((n, k), dtype=np.int8)
    best = first + emit[0]
    for i in range(1, n):
        step = best[:, None] + (model.across if opens[i] else model.within)
        back[i] = step.argmax(axis=0)
        best = step.max(axis=0) + emit[i]
    path = np.empty(n, dtype=np.int64)
    path[-1] = int((best + last).argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def _matrix(emit: np.ndarray, opens: np.ndarray, model: Model) -> np.ndarray:
    """Best score of a stretch of lines from each first to each last role, the first line's emission included."""
    k = emit.shape[1]
    out = np.where(np.eye(k, dtype=bool), emit[0][None, :], -np.inf)
    for i in range(1, len(emit)):
        step = model.across if opens[i] else model.within
        out = (out[:, :, None] + step[None]).max(axis=1) + emit[i]
    return out


def render(text: str | None, roles: np.ndarray) -> str:
    """Lines of one role run together as a turn; blank turns are left out unless all are."""
    turns: list[tuple[int, list[str]]] = []
    for line, role in zip((text or "").split("\n"), roles.tolist(), strict=True):
        found = MARKER.match(line)
        if not turns or turns[-1][0] != role or (found and any(x.strip() for x in turns[-1][1])):
            turns.append((role, []))
        turns[-1][1].append(line[found.end() :] if found else line)
    parts = [(role, "\n".join(lines).strip()) for role, lines in turns]
    parts = [p for p in parts if p[1]] or parts[:1]
    return "".join(f"<|{ROLES[role]}|>\n{body}\n<|end|>\n" for role, body in parts)


def _alone() -> Column:
    return F.col("conv_id").isNull() | F.col("turn").isNull()


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, messages) of sorted rows; a message that stands alone is a conversation of its own."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and (row[3] or rows[-1][3] or row[0] != rows[-1][0]):
                yield rows[0][0], rows
                rows = []
            rows.append(row)
    if rows:
        yield rows[0][0], rows


def _lines(rows: list, model: Model) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    seen = [observe(r[2]) for r in rows]
    lines = np.concatenate(seen)
    return seen, scores(lines, model), lines[:, 1]


def turns(messages: DataFrame, model: Model) -> DataFrame:
    """The columns of RESULT, a row for each of ``messages``: conv_id, turn, its number of lines, the role of each
    line, the role of most lines (the first of those), and the canonical turns."""
    spark = messages.sparkSession
    bounded_batches(spark)
    scratch_base(spark)  # names the folder of checkpoint() where the session has none
    ordered = (
        messages.select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "text",
            _alone().alias("alone"), F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("copy"),
        )
        .repartitionByRange("alone", "conv_id", "turn", "tie", "copy")  # equal rows may be parted too
        .sortWithinPartitions("alone", "conv_id", "turn", "tie", "copy")
        .select("conv_id", "turn", "text", "alone")
        .checkpoint()  # both passes must see the same borders
    )
    k = len(ROLES)

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first and the last conversation of the task, as matrices."""
        ends: list[tuple] = []
        place = 0
        for key, rows in _stretches(batches):
            if not rows[0][3]:
                entry = (key, place, rows)
                ends = [entry] if not ends else [ends[0], entry]
            place += 1
        out = []
        for key, at, rows in ends:
            _, emit, opens = _lines(rows, model)
            out.append((TaskContext.get().partitionId(), at, place, key, _matrix(emit, opens, model).ravel().tolist()))
        if out:
            kinds = [pa.int64()] * 4 + [pa.list_(pa.float64())]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "at", "n", "conv_id", "best"])

    found = ordered.mapInArrow(borders, "part long, at long, n long, conv_id long, best array<double>").collect()
    fixed = _chained(sorted(found, key=lambda r: (r.part, r["at"])), model)
    sent = spark.sparkContext.broadcast(fixed)  # two roles for each border between tasks

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value.get(TaskContext.get().partitionId(), {})
        for place, (_, rows) in enumerate(_stretches(batches)):
            seen, emit, opens = _lines(rows, model)
            first, last = own.get(place, (None, None))
            only = lambda role: np.where(np.arange(k) == role, 0.0, -np.inf)
            path = viterbi(
                emit, opens, model.start if first is None else only(first), np.zeros(k) if last is None else only(last), model
            )
            out, done = [], 0
            for row, lines in zip(rows, seen, strict=True):
                roles = path[done : done + len(lines)]
                done += len(lines)
                counts = np.bincount(roles, minlength=k)
                most = next(r for r in roles.tolist() if counts[r] == counts.max())
                named = ",".join(ROLES[r] for r in roles.tolist())
                out.append((row[0], row[1], len(lines), named, ROLES[most], render(row[2], roles)))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in RESULT.split(", ")])

    return ordered.mapInArrow(decoded, RESULT)


def _chained(ends: list, model: Model) -> dict[int, dict[int, tuple[int | None, int | None]]]:
    """For each task and place in it, the first and last role of a stretch that goes on in another task.

    A conversation spans tasks if it is the last of one and the first of the next; all tasks between have it alone.
    """
    k = len(ROLES)
    runs: list[list] = []
    for end in ends:
        if runs and runs[-1][-1]["conv_id"] == end["conv_id"] and runs[-1][-1]["part"] < end["part"]:
            runs[-1].append(end)
        else:
            runs.append([end])
    fixed: dict[int, dict[int, tuple[int | None, int | None]]] = {}
    for run in (r for r in runs if len(r) > 1):
        matrices = [np.array(e["best"]).reshape(k, k) for e in run]
        best, pointers = model.start, []
        for i, m in enumerate(matrices):
            entry = best if i == 0 else (best[:, None] + model.across).max(axis=0)
            came = None if i == 0 else (best[:, None] + model.across).argmax(axis=0)
            through = entry[:, None] + m
            pointers.append((came, through.argmax(axis=0)))
            best = through.max(axis=0)
        last = int(best.argmax())
        for e, (came, firsts) in zip(reversed(run), reversed(pointers), strict=True):
            first = int(firsts[last])
            fixed.setdefault(e["part"], {})[e["at"]] = (first, last)
            last = int(came[first]) if came is not None else last
    return fixed
