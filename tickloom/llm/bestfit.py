"""Packing documents whole into fixed windows: vector best fit, planned on the counts of lengths.

A document longer than the window is cut into whole windows behind a shorter
first piece; whole windows are sequences of their own, first pieces are the
items. An item of s tokens needs the vector (s, 1, s^2): tokens, documents and
attention cost. Items go by falling size. Each goes into the open sequence that
has room in every dimension and whose residual suits it best, by the weighted
dot product of need and residual or by the weighted norm of what would be left;
a new sequence is opened only where none has room.

Items of one length are interchangeable, so the plan is made on the number of
items of each length: sequences with the same contents are one group with a
count. It is as large as the window, however many documents there are, and
takes the driver a second. Then each item's number among those of its length
says where it goes: the task that tokenized it numbers its own, and the sums of
the tasks before it are joined to it. No task sees more than its own documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.bpe_fst import BLOCK, Transducer
from tickloom.llm.common import blocks_of, release, stored, text_bytes, valid_utf8
from tickloom.llm.packing import id_type

WINDOW = 1024
END_ID = 2
CRITERIA = ("norm", "dot")


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most. ``attention`` counts the square of every piece's length."""

    tokens: int = WINDOW
    documents: int = WINDOW
    attention: int = WINDOW * WINDOW

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.int64)


def need(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], np.int64)


@dataclass
class Plan:
    """Groups of sequences: how many there are, and their contents as (length, copies)."""

    count: list[int]
    contents: list[list[tuple[int, int]]]

    @property
    def sequences(self) -> int:
        return sum(self.count)

    def slots(self) -> np.ndarray:
        """Rows (length, number of the first item, group's sequences, its first sequence, offset), by length and number."""
        rows, taken, base = [], {}, 0
        for n, contents in zip(self.count, self.contents, strict=True):
            offset = 0
            for length, copies in contents:
                first = taken.get(length, 0)
                rows.append((length, first, n, base, offset))
                taken[length] = first + copies * n
                offset += copies * length
            base += n
        return np.array(sorted(rows), np.int64).reshape(-1, 5)


def weights_of(lengths: dict[int, int], capacity: np.ndarray) -> np.ndarray:
    """The load of each dimension in sequences, the largest being 1: scarce dimensions weigh most."""
    load = sum(need(s) * float(n) for s, n in lengths.items()) / capacity
    return load / load.max()


def best_fit(lengths: dict[int, int], capacity: Capacity, criterion: str, weights: np.ndarray) -> Plan:
    """Sequences for ``lengths`` (length: items), by falling length; every capacity holds."""
    full = capacity.vector()
    scale = weights / full.astype(float) ** 2
    room = np.zeros((0, 3), np.int64)
    count = np.zeros(0, np.int64)
    contents: list[list[tuple[int, int]]] = []
    done = Plan([], [])
    for s in sorted(lengths, reverse=True):
        wanted, left = need(s), lengths[s]
        if (wanted > full).any():
            raise ValueError(f"a piece of {s} tokens fits no sequence of {capacity}")
        while left:
            fits = np.flatnonzero((room >= wanted).all(1))
            if len(fits):
                residual = room[fits]
                score = ((residual - wanted).astype(float) ** 2 @ scale) if criterion == "norm" else (residual * wanted.astype(float)) @ scale
                g = int(fits[score.argmin()])
                base, there, held = room[g], int(count[g]), contents[g]
            else:
                g, base, there, held = -1, full, left, []
            copies = int((base // wanted).min())
            whole = min(there, left // copies)
            made = [(whole, copies)] if whole else []
            if there > whole and left > whole * copies and left - whole * copies < copies:
                made.append((1, left - whole * copies))
            left -= sum(n * c for n, c in made)
            if g >= 0:
                count[g] -= sum(n for n, _ in made)
            for n, c in made:
                room = np.vstack([room, base - c * wanted])
                count = np.append(count, n)
                contents.append([*held, (s, c)])
            # what is full or used up needs no more looking at
            closed = (room < 1).any(1)
            for k in np.flatnonzero(closed & (count > 0)).tolist():
                done.count.append(int(count[k]))
                done.contents.append(contents[k])
            keep = ~closed & (count > 0)
            if not keep.all():
                room, count = room[keep], count[keep]
                contents = [c for c, k in zip(contents, keep.tolist(), strict=True) if k]
    done.count += count.tolist()
    done.contents += contents
    return done


def plan(lengths: dict[int, int], capacity: Capacity) -> Plan:
    """The plan with the fewest sequences of both criteria, by load and by the scarcest dimension alone."""
    if not lengths:
        return Plan([], [])
    load = weights_of(lengths, capacity.vector())
    plans = [best_fit(lengths, capacity, criterion, w) for w in (load, (load == 1).astype(float)) for criterion in CRITERIA]
    return min(plans, key=lambda p: p.sequences)


def tokenize(docs: DataFrame, vocabulary: str, window: int, end_id: int, key: str, text: str) -> DataFrame:
    """``key``, ``ids`` and the place of each document among those of its task; a last row a task with its counts of lengths.

    ``first``: tokens of the first piece. ``turn``: documents of the task before
    it with the same ``first``. ``whole``: whole windows of the task before its own.
    """
    width = id_type(vocabulary, end_id)
    names = [key, "ids", "task", "first", "turn", "whole", "lengths"]
    pairs = pa.list_(pa.struct([("first", pa.int32()), ("items", pa.int64())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.of(vocabulary)
        task, key_type = TaskContext.get().partitionId(), None
        seen, whole = np.zeros(window + 1, np.int64), 0
        for part in parts:
            key_type = part.column(0).type
            for rows in blocks_of(part, BLOCK):
                ids, counts = machine.encode(valid_utf8([data for _, data in rows]))
                begin = np.cumsum([0, *counts.tolist()])
                with_end = np.insert(ids, begin[1:], end_id)
                cut = begin + np.arange(len(begin))
                size = np.diff(cut)
                first = (size - 1) % window + 1
                order = np.argsort(first, kind="stable")
                run_first = np.searchsorted(first[order], first[order])
                turn = np.empty(len(rows), np.int64)
                turn[order] = seen[first[order]] + np.arange(len(rows)) - run_first
                seen += np.bincount(first, minlength=window + 1)
                wholes = (size - 1) // window
                before = whole + np.cumsum(wholes) - wholes
                whole += int(wholes.sum())
                ends = cut.tolist()
                yield pa.record_batch(
                    [
                        pa.array([k for k, _ in rows], key_type),
                        pa.array([with_end[a:b].astype(width).tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary()),
                        pa.array(np.full(len(rows), task, np.int64)),
                        pa.array(first.astype(np.int32)),
                        pa.array(turn),
                        pa.array(before.astype(np.int64)),
                        pa.nulls(len(rows), pairs),
                    ],
                    names=names,
                )
        if key_type is not None:
            found = [{"first": int(s), "items": int(seen[s])} for s in np.flatnonzero(seen)]
            nothing = [pa.nulls(1, key_type), pa.nulls(1, pa.binary()), pa.array([task], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())]
            yield pa.record_batch([*nothing, pa.array([found], pairs)], names=names)

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, ids binary, task long, first int, turn long, whole long, lengths array<struct<first int, items long>>"
    return docs.select(F.col(key), text_bytes(text).alias("text")).mapInArrow(run, schema)


def pack_best_fit(docs: DataFrame, vocabulary: str, capacity: Capacity = Capacity(), end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``key``, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``, ``offset``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers.
    A document is cut only where it is longer than ``capacity.tokens``: then all
    pieces but the first have just so many. No sequence holds more tokens,
    documents or attention cost than ``capacity``; a length that fits no
    sequence is a ValueError, since no document is left out. Sequences of items
    are numbered from 0, whole windows of long documents from -1 downwards. A
    null text counts as empty and still has its end id. Rows with a repeated or
    null key are documents of their own; equal texts may lie in any order.
    Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    window = capacity.tokens
    kind = docs.schema[key].dataType.simpleString()
    tokens = stored(tokenize(docs, vocabulary, window, end_id, key, text).withColumnRenamed(key, "k"), "tokens")
    tasks = tokens.filter("lengths IS NOT NULL").select("task", F.explode("lengths").alias("l")).select("task", "l.first", "l.items")
    # as many rows as a sequence has tokens
    lengths = {r.first_tokens: r.n for r in tasks.groupBy(F.col("first").alias("first_tokens")).agg(F.sum("items").alias("n")).collect()}
    width = id_type(vocabulary, end_id)
    if capacity.attention < window * window and tokens.filter(F.octet_length("ids") > window * np.dtype(width).itemsize).limit(1).count():
        raise ValueError(f"a piece of {window} tokens fits no sequence of {capacity}")
    slots = plan(lengths, capacity).slots()
    earlier = Window.partitionBy("first").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = tasks.select("task", "first", F.coalesce(F.sum("items").over(earlier), F.lit(0)).alias("earlier"))
    numbered = (
        tokens.filter("lengths IS NULL")
        .join(before, ["task", "first"])
        .select("k", "ids", "first", (F.col("earlier") + F.col("turn")).alias("number"), (F.shiftleft("task", 36) + F.col("whole")).alias("whole"))
    )
    names = [key, "piece", "start", "length", "ids", "sequence_id", "offset"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        code = slots[:, 0] << 44 | slots[:, 1]
        for part in parts:
            key_type = part.column(0).type
            for begin in range(0, part.num_rows, 256):
                rows = part.slice(begin, 256)
                first = rows.column(2).to_numpy().astype(np.int64)
                number = rows.column(3).to_numpy()
                slot = slots[np.searchsorted(code, first << 44 | number, side="right") - 1]
                copy, at = np.divmod(number - slot[:, 1], slot[:, 2])
                sequence, offset = (slot[:, 3] + at).tolist(), (slot[:, 4] + copy * first).tolist()
                out: list[tuple] = []
                for i, (doc, data, tokens_first, _, whole) in enumerate(zip(*(c.to_pylist() for c in rows.columns), strict=True)):
                    ids = np.frombuffer(data, width).astype("<u4")
                    out.append((doc, 0, 0, tokens_first, ids[:tokens_first].tobytes(), sequence[i], offset[i]))
                    for p, start in enumerate(range(tokens_first, len(ids), window)):
                        out.append((doc, p + 1, start, window, ids[start : start + window].tobytes(), -1 - whole - p, 0))
                types = [key_type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return numbered.mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long")
