"""Documents packed into as few sequences as possible: dominance reduction, then best fit.

Only lengths matter to a packing, and a sequence of ``capacity`` tokens knows ``capacity`` lengths.
So the instance is the number of pieces of each length: at most ``capacity`` rows, however large
the corpus. On them the driver plans:

* Reduction (Martello and Toth): a set of at most three pieces that dominates every other set with
  the same longest piece is fixed for good, as often as the counts allow. Removing pieces only
  removes rivals, so what dominates once keeps dominating.
* Best fit: what remains, longest first, goes into the fullest sequences that still have room.

The plan is a list of placements, each saying where a run of equal lengths goes. Every step uses
up a length or a set of sequences with equal room, so there are a few times ``capacity``
placements at most; pieces are joined to those of their length and looked up by number. Ids leave
the encoder a slice of text at a time, and pass through no Python after that.

A null text is empty; an empty text is its end id alone. A very long text is cut into pieces, the
last of which may be shorter. Pieces of equal length are interchangeable: which goes where follows
from their numbers. Rows that repeat are packed each. Only
doc_id and text are read, doc_id may be null. No documents give no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import in_slices, ragged, released
from tidemark.llm.numbering import Running, moves_by_task
from tidemark.llm.tokens import encoder, vocabulary_path
from tidemark.sources.shared import save_shared

CAPACITY = 4096


# --- the plan ---


@dataclass
class Plan:
    """``placements``: (length, first number, count, first sequence, per sequence, offset)."""

    capacity: int
    placements: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    n_sequences: int = 0
    n_fixed: int = 0
    _numbered: Counter = field(default_factory=Counter)

    def open(self, n: int) -> int:
        first, self.n_sequences = self.n_sequences, self.n_sequences + n
        return first

    def place(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.placements.append(
            (length, self._numbered[length], count, sequence, each, offset)
        )
        self._numbered[length] += count


def _take_smallest(present: list[int], left: Counter, n: int) -> list[int]:
    found: list[int] = []
    for length in present:
        found += [length] * min(left[length], n - len(found))
        if len(found) == n:
            break
    return found


def _largest(present: list[int], left: Counter, most: int) -> int:
    """The largest length up to ``most`` of which one is left, or 0."""
    i = bisect_right(present, most) - 1
    while i >= 0 and not left[present[i]]:
        i -= 1
    return present[i] if i >= 0 else 0


def _best_pair(present: list[int], left: Counter, most: int) -> int:
    best, i, j = 0, 0, len(present) - 1
    while i <= j:
        a, b = present[i], present[j]
        if not left[a] or (i == j and left[a] < 2):
            i += 1
        elif not left[b]:
            j -= 1
        elif a + b > most:
            j -= 1
        else:
            best, i = max(best, a + b), i + 1
    return best


def _dominant(longest: int, present: list[int], left: Counter, capacity: int) -> list[int] | None:
    """The others in a set that dominates all sets with ``longest``; None where none is known.

    ``left`` counts the pieces without that one. A set dominates another if the pieces of the other
    can be dealt out to pieces of the set without exceeding any of them.
    """
    room = capacity - longest
    smallest = _take_smallest(present, left, 3)
    if not smallest or smallest[0] > room:
        return []  # nothing fits beside it
    a = _largest(present, left, room)
    if a == room or len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return [a]  # fills the room, or no two fit
    if len(smallest) == 3 and sum(smallest) <= room:
        return None  # more than two fit
    if a >= _best_pair(present, left, room):
        return [a]
    rest = left.copy()
    rest[a] -= 1
    b = _largest(present, rest, room - a)
    above = [x for x in present[bisect_right(present, b) :] if left[x]]
    two = _take_smallest(above, left, 2)
    # Any single piece fits in a. Of any two, the larger fits in a and, unless both exceed b, the
    # smaller in b.
    return [a, b] if b and (len(two) < 2 or sum(two) > room) else None


def reduce_instance(left: Counter, plan: Plan) -> None:
    """Fix dominant sets until none is found; takes their pieces out of ``left``."""
    changed = True
    while changed:
        changed = False
        for longest in sorted((x for x in left if left[x]), reverse=True):
            while left[longest]:
                present = sorted(x for x in left if left[x])
                left[longest] -= 1
                others = _dominant(longest, present, left, plan.capacity)
                left[longest] += 1
                if others is None:
                    break
                chosen = Counter([longest, *others])
                times = min(left[x] // n for x, n in chosen.items())
                first, offset = plan.open(times), 0
                for length, n in chosen.items():
                    plan.place(length, n * times, first, n, offset)
                    left[length] -= n * times
                    offset += n * length
                plan.n_fixed += times
                changed = True


def best_fit(left: Counter, plan: Plan) -> None:
    """Longest first into the least room that suffices; sequences with equal room go together."""
    rooms: list[int] = []
    groups: dict[int, list[tuple[int, int]]] = {}

    def add(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in groups:
                rooms.insert(bisect_left(rooms, room), room)
                groups[room] = []
            groups[room].append((first, n))

    def fill(length: int, count: int, room: int, first: int, n: int) -> int:
        """Put ``count`` pieces into ``n`` sequences; returns how many are left over."""
        each, offset = room // length, plan.capacity - room
        full = min(n, count // each)
        if full:
            plan.place(length, full * each, first, each, offset)
            add(room - each * length, first, full)
        rest = min(count - full * each, each - 1) if full < n else 0
        if rest:
            plan.place(length, rest, first + full, rest, offset)
            add(room - rest * length, first + full, 1)
        add(room, first + full + (rest > 0), n - full - (rest > 0))
        return count - full * each - rest

    for length in sorted((x for x in left if left[x]), reverse=True):
        count = left[length]
        while count:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                n = -(-count // (plan.capacity // length))
                count = fill(length, count, plan.capacity, plan.open(n), n)
                continue
            room = rooms[i]
            first, n = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[i]
            count = fill(length, count, room, first, n)
        left[length] = 0


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan, left = Plan(capacity), Counter(counts)
    reduce_instance(left, plan)
    best_fit(left, plan)
    return plan


# --- pieces ---

PIECE = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"
)


def _cut(
    path: str, capacity: int, with_ids: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, running = encoder(path).encode, Running(capacity + 1)
        task = TaskContext.get().partitionId()
        for batch in in_slices(released(batches), "text"):
            ids, bounds = encode(batch.column("text"))
            ids, sizes = ids.astype("<u4", copy=False), np.diff(bounds)
            pieces = -(-sizes // capacity)
            piece = ragged(np.zeros(len(pieces)), pieces)
            document = np.repeat(np.arange(len(pieces)), pieces)
            starts = piece * capacity
            lengths = np.minimum(sizes[document] - starts, capacity)
            at = bounds[document] + starts
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(document)),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(
                    [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(at, lengths)], pa.int64()
                ),
                "task": pa.array(np.full(len(piece), task), pa.int32()),
                "number": pa.array(running.number(lengths), pa.int64()),
            }
            if with_ids:
                parts = np.append(0, np.cumsum(lengths)).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(parts), pa.array(ids.view(np.int32))
                )
            yield pa.RecordBatch.from_pydict(columns)

    return cut


def cut_pieces(
    documents: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's pieces, written out, numbered within (task, length)."""
    cut = _cut(vocabulary or vocabulary_path(), capacity, with_ids)
    schema = PIECE + (", ids array<int>" if with_ids else "")
    columns = documents.select(F.col("doc_id").cast("long"), "text")
    return save_shared(columns.mapInArrow(cut, schema), "pieces")


def _placements(spark: SparkSession, plan: Plan) -> DataFrame:
    """``length, places``: where the plan puts the pieces of each length, one row per length."""
    rows = spark.createDataFrame(
        plan.placements,
        "length long, first long, count long, sequence long, each long, begin long",
    )
    place = F.struct("first", "count", "sequence", "each", "begin")
    return rows.groupBy("length").agg(F.collect_list(place).alias("places"))


def _locate(pieces: DataFrame, plan: Plan) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``, without ``task`` and ``number``.

    A task's pieces of one length need only those places that their numbers reach, so few come with
    each. The ids stay in Spark's rows: only the narrow columns are looked at.
    """

    def reached(place: Column, first: Column, n: Column) -> Column:
        return (place["first"] < first + n) & (place["first"] + place["count"] > first)

    move, n = F.col("move"), F.col("n")
    moves = moves_by_task(pieces, "length").join(_placements(pieces.sparkSession, plan), "length")
    moves = moves.select(
        "length", "task", "move",
        F.filter("places", lambda place: reached(place, move, n)).alias("places"),
    )
    number = F.col("number") + move
    place = F.filter("places", lambda place: reached(place, number, F.lit(1)))[0]
    kept = [name for name in pieces.columns if name not in ("task", "number")]
    return (
        pieces.join(moves, ["length", "task"])
        .select(*kept, place.alias("place"), number.alias("number"))
        .withColumn("nth", F.expr("number - place.first"))
        .select(
            *kept,
            F.expr("place.sequence + nth div place.each").alias("sequence_id"),
            F.expr("place.begin + nth % place.each * length").alias("offset"),
        )
    )


def pack(
    documents: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) per piece."""
    pieces = cut_pieces(documents, capacity, vocabulary, with_ids)
    counted = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    plan = plan_packing({row["length"]: row["n"] for row in counted}, capacity)
    return _locate(pieces, plan)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from pieces packed with their ids; a group is one sequence at most."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(ordered["ids"]).alias("ids"))
