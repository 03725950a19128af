"""Best-fit packing of documents into sequences of a fixed number of tokens.

A document is its tokens and an end id; only documents longer than a sequence
are cut, into full pieces and one shorter rest. How pieces share sequences
depends on lengths alone, so the plan is made from the length histogram (at
most ``capacity`` numbers whatever the corpus): a configuration linear program
(how often to use each combination of lengths) is solved by multiplicative
weights, the best configurations for the current weights coming from a
knapsack dynamic program; the solution is rounded down, and what is left is
packed best-fit decreasing, group by group of equal sequences.

The plan is a set of rank intervals: the pieces of a length, numbered 0, 1, ..
over the whole corpus, fall into intervals that each name a first sequence and
an offset. Numbering is distributed: pieces are counted per (partition,
length), only those counts are summed over partitions, and each piece adds its
rank within its own partition, so a length that a third of all pieces share
never meets in one task.

Defined cases: null and empty texts are the end id alone. Repeated rows are
packed like any others. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, map_texts, saved, ship_package
from .word_tokens import encoder

CAPACITY = 2048
END = 0
ROUNDS = 120
STEP = 0.3
PER_ROUND = 96
#: Characters that are encoded at once; a longer text stands alone.
ENCODE_CHARS = 500_000


def pieces(
    docs: DataFrame, spec: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (little-endian unsigned 32-bit ids)."""

    def run(texts):
        counts, out = [], {"piece": [], "start": [], "length": [], "ids_crc32": []}
        # a few at a time: the arrays over a batch's characters and words are many times its size
        encoded = (ids for part in batches(texts, ENCODE_CHARS) for ids in encoder(spec).encode(texts[part]))
        for ids in encoded:
            whole = np.append(ids, END).astype("<u4")
            at = range(0, len(whole), capacity)
            cuts = [whole[i : i + capacity] for i in at]
            counts.append(len(cuts))
            out["piece"].extend(range(len(cuts)))
            out["start"].extend(at)
            out["length"].extend(map(len, cuts))
            out["ids_crc32"].extend(zlib.crc32(c.tobytes()) for c in cuts)
        return counts, out

    return map_texts(docs, run, "piece int, start bigint, length bigint, ids_crc32 bigint", id_col, text_col)


def _best_loads(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack with repetition over lengths 1..capacity: best value per load, and the length taken last."""
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    for load in range(1, capacity + 1):
        total = best[load - 1 :: -1][:load] + value[1 : load + 1]
        k = load - 1 - int(total[::-1].argmax())  # of equal values the longest
        if total[k] > best[load - 1]:
            best[load], last[load] = total[k], k + 1
        else:
            best[load] = best[load - 1]
    return best, last


def _fill(first: int, last: np.ndarray, capacity: int) -> tuple[int, ...]:
    """The lengths of a best configuration that holds ``first``, longest first."""
    chosen, load = [first], capacity - first
    while load > 0:
        if last[load]:
            chosen.append(int(last[load]))
            load -= int(last[load])
        else:
            load -= 1
    return tuple(sorted(chosen, reverse=True))


def solve_configurations(demand: np.ndarray, capacity: int) -> dict[tuple[int, ...], float]:
    """Fractional use of configurations by multiplicative weights.

    Weights start at the share of a sequence that a length takes. Each round
    prices configurations with the knapsack program; the best ones take a
    ``STEP`` of what their scarcest length still allows, and the weights of the
    lengths they serve fall by the share of the demand that they served.
    """
    lengths = np.flatnonzero(demand)
    value = np.zeros(capacity + 1)
    value[lengths] = (lengths / capacity) ** 1.001  # slightly in favour of long pieces
    use: dict[tuple[int, ...], float] = {}
    left = demand.astype(float)
    for _ in range(ROUNDS):
        open_ = lengths[left[lengths] >= 1]
        if not len(open_):
            break
        priced = np.zeros(capacity + 1)
        priced[open_] = value[open_]
        best, last = _best_loads(priced, capacity)
        worth = priced[open_] + best[capacity - open_]
        for first in open_[np.argsort(-worth, kind="stable")][:PER_ROUND].tolist():
            config = _fill(first, last, capacity)
            kinds, counts = np.unique(config, return_counts=True)
            most = float((left[kinds] / counts).min())
            if most < 1:
                continue
            take = max(1.0, STEP * most)
            use[config] = use.get(config, 0.0) + take
            left[kinds] -= take * counts
            value[kinds] *= np.exp(-STEP * take * counts / demand[kinds])
    return use


def plan_sequences(demand: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Configurations with whole multiplicities that hold exactly ``demand[length]`` pieces of each length."""
    left = demand.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:  # full pieces fill a sequence each
        plan.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    fractional = solve_configurations(left, capacity)
    for config, amount in sorted(fractional.items(), key=lambda x: (-sum(x[0]), -x[1], x[0])):
        if sum(config) < capacity:
            break  # rounding keeps full sequences; what others held is packed with the rest
        kinds, counts = np.unique(config, return_counts=True)
        times = min(int(amount), int((left[kinds] // counts).min()))
        if times > 0:
            plan.append((config, times))
            left[kinds] -= times * counts
    plan += _best_fit_rest(left, capacity)
    # the rounded program is nearly always the better plan, but never let it be the worse one
    plain = _best_fit_rest(demand.astype(np.int64), capacity)
    return min(plan, plain, key=lambda groups: sum(times for _, times in groups))


def _best_fit_rest(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing; equal sequences are one group, so the work follows the lengths, not the counts."""
    by_room: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for length in range(capacity, 0, -1):
        need = int(left[length])
        room = length
        while need and room <= capacity:
            if not by_room[room]:
                room += 1
                continue
            group, times = by_room[room].pop()
            used = min(need, times)
            if used < times:
                by_room[room].append((group, times - used))
            by_room[room - length].append((group + (length,), used))
            need -= used
            # a fuller sequence may now fit once more
            room = length
        if need:
            per = capacity // length
            full, rest = divmod(need, per)
            if full:
                by_room[capacity - per * length].append(((length,) * per, full))
            if rest:
                by_room[capacity - rest * length].append(((length,) * rest, 1))
    return [group for groups in by_room for group in groups]


def intervals(plan: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first ranks (ascending), first sequence and offset of each interval."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks = [0] * (capacity + 1)
    sequence = 0
    for config, times in plan:
        offset = 0
        for length in config:
            found.setdefault(length, []).append((ranks[length], sequence, offset))
            ranks[length] += times
            offset += length
        sequence += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for n, rows in found.items()}


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (one row per piece, with ``length``) with sequence_id and offset.

    The pieces are written together with the number of the part they are
    ranked in: both the ranks and the parts' offsets rest on that column.
    """
    columns = cut.columns
    here = saved(cut.withColumn("part", F.spark_partition_id()), "pieces")
    counts = here.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    demand = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        demand[row["length"]] = row["n"]
    table = intervals(plan_sequences(demand, capacity), capacity)
    local = Window.partitionBy("part", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = here.withColumn("local", F.row_number().over(local) - 1)
    met = ranked.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))

    def place(record_batches):
        for batch in record_batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence = np.zeros(len(rank), np.int64)
            offset = np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    first, sequences, offsets = table[int(length[rows[0]])]
                    at = np.searchsorted(first, rank[rows], side="right") - 1
                    sequence[rows] = sequences[at] + rank[rows] - first[at]
                    offset[rows] = offsets[at]
            arrays = [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "sequence_id", "offset"])

    ship_package(cut.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return met.select(*columns, "rank").mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame, spec: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, spec, capacity, id_col, text_col), capacity)
