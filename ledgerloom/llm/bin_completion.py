"""Best-fit packing of documents into token sequences by bin completion (operator 9).

Lengths are whole numbers up to the sequence length, so a packing problem of any size is a histogram of at most that
many counts. The histogram is solved; documents then take the slots of their length by rank:

1. One pass over the texts encodes and cuts them and numbers the pieces per partition and length.
2. Counts per (partition, length) are summed up to ranks; the histogram (at most ``capacity`` rows) goes to the driver.
3. ``complete_bins`` finds fillings: it opens a sequence with the largest piece left, enumerates undominated fillings of
   the rest and applies the best as often as the counts allow, branching over alternatives within a node budget. Waste
   bounds prune; the best-fit-decreasing packing is the first incumbent.
4. Pieces look up the slot that their length and rank name.

Rows: a null or empty text is the end token alone; repeated rows are separate documents; extra columns are ignored;
an empty table gives no rows; a null doc_id is kept as null.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import RANK_FILE, TOKENIZER_FILE, byte_bpe
from ledgerloom.session import materialize

CAPACITY, END_ID = 1024, 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"

Plan = list[tuple[tuple[int, ...], int]]  # fillings (lengths, largest first) and how often each is used


# --- the packing of a histogram -------------------------------------------------------------

def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing over equal lengths at once: each length goes to the fullest open bins it fits."""
    open_bins: dict[int, Counter] = {}  # room left -> contents -> how many bins
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_bins if r >= length and open_bins[r]), default=None)
            if room is None:
                per_bin = min(capacity // length, left)
                times = left // per_bin
                source, room = Counter({(): times}), capacity
            else:
                per_bin, source = 1, open_bins[room]
            content, times = next(iter(source.items()))
            per_bin = min(room // length, left) if room != capacity else per_bin
            times = min(times, left // per_bin)
            source[content] -= times
            source += Counter()
            if room != capacity:
                open_bins[room] = source
            open_bins.setdefault(room - per_bin * length, Counter())[content + (length,) * per_bin] += times
            left -= times * per_bin
    return [(content, times) for bins in open_bins.values() for content, times in bins.items() if times]


def fillings(room: int, sizes: np.ndarray, counts: np.ndarray, most: int = 6, effort: int = 400) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from the lengths in stock (``sizes`` ascending), least waste first.

    A filling is dominated if another piece still fits or if one of its pieces can be replaced by a larger one in stock.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    spent = 0
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, len(sizes), ())]
    while stack and spent < effort:
        rest, upto, chosen = stack.pop()
        spent += 1
        last = int(np.searchsorted(sizes[:upto], rest, side="right")) - 1
        used = Counter(chosen)
        while last >= 0 and counts[sizes[last]] <= used[int(sizes[last])]:
            last -= 1
        if last < 0:
            fits = int(np.searchsorted(sizes, rest, side="right"))
            if any(counts[s] > used[int(s)] for s in sizes[:fits]):
                continue  # a smaller branch of the same search holds the larger filling
            if all(not _larger(sizes, counts, used, piece, rest) for piece in used):
                found.append((rest, chosen))
                if len([1 for waste, _ in found if waste == 0]) >= most:
                    break
            continue
        piece = int(sizes[last])
        if last and len(chosen) < 5:
            stack.append((rest, last, chosen))
        stack.append((rest - piece, last + 1, chosen + (piece,)))
    return [chosen for _, chosen in sorted(set(found), key=lambda x: (x[0], len(x[1]), x[1]))[:most]]


def every_filling(room: int, sizes: np.ndarray, counts: np.ndarray, effort: int = 400) -> Iterator[tuple[int, ...] | None]:
    """All undominated fillings of ``room``, one by one; None after every ``effort`` steps of the search."""
    spent = 0
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, len(sizes), ())]
    while stack:
        rest, upto, chosen = stack.pop()
        spent += 1
        if spent % effort == 0:
            yield None
        last = int(np.searchsorted(sizes[:upto], rest, side="right")) - 1
        used = Counter(chosen)
        while last >= 0 and counts[sizes[last]] <= used[int(sizes[last])]:
            last -= 1
        if last >= 0:
            piece = int(sizes[last])
            if last:
                stack.append((rest, last, chosen))
            stack.append((rest - piece, last + 1, chosen + (piece,)))
            continue
        fits = int(np.searchsorted(sizes, rest, side="right"))
        if not any(counts[s] > used[int(s)] for s in sizes[:fits]) and all(not _larger(sizes, counts, used, piece, rest) for piece in used):
            yield chosen


def _larger(sizes: np.ndarray, counts: np.ndarray, used: Counter, piece: int, rest: int) -> bool:
    lo, hi = np.searchsorted(sizes, [piece, piece + rest], side="right")
    return any(counts[s] > used[int(s)] for s in sizes[lo:hi])


def bins_of(plan: Plan) -> int:
    return sum(times for _, times in plan)


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: by volume, and by pieces no two of which fit together (for every threshold below one half)."""
    total = sum(length * n for length, n in counts.items())
    bound = -(-total // capacity)
    for small in {0, *(length for length in counts if 2 * length <= capacity)}:
        alone = sum(n for length, n in counts.items() if length > capacity - small)
        large = {length: n for length, n in counts.items() if capacity / 2 < length <= capacity - small}
        spare = sum((capacity - length) * n for length, n in large.items())
        middle = sum(length * n for length, n in counts.items() if small <= length <= capacity / 2)
        bound = max(bound, alone + sum(large.values()) + max(0, -(-(middle - spare) // capacity)))
    return bound


def complete_bins(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = 3000) -> Plan:
    """Fillings for every piece of the histogram, in few bins; exact unless the node budget ends the search.

    Depth first: a node takes the largest piece left, tries its fillings in order of waste and applies one as often as
    stock allows. A branch ends when its waste so far cannot beat the incumbent any more. A first search tries at most six
    fillings of a node, at full multiples; if it runs out of options, a second one tries all undominated fillings at all multiples
    with the nodes left (400 steps of looking for a filling count as a node).
    """
    histogram = {int(k): int(n) for k, n in histogram.items() if n > 0}
    best = best_fit_decreasing(histogram, capacity)
    goal = least_bins(histogram, capacity)
    total = sum(length * n for length, n in histogram.items())
    stock = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        stock[length] = n
    # A frame is the stock, the plan's length before it and the fillings still to try.
    plan: Plan = []
    frames: list[tuple[np.ndarray, int, int, Iterator]] = []

    def open_frame(counts: np.ndarray, waste: int) -> None:
        sizes = np.flatnonzero(counts)
        largest = int(sizes[-1])
        counts = counts.copy()
        counts[largest] -= 1
        inside = np.flatnonzero(counts[: capacity - largest + 1])
        if whole:
            options = all_options(largest, every_filling(capacity - largest, inside, counts.copy()), counts.copy())
        else:
            options = iter([((largest, *option), None) for option in fillings(capacity - largest, inside, counts) or [()]])
        counts[largest] += 1
        frames.append((counts, len(plan), waste, options))

    def all_options(largest: int, found: Iterator, counts: np.ndarray) -> Iterator:
        counts[largest] += 1
        for option in found:
            if option is None:
                yield None, None
                continue
            most = min(int(counts[length]) // n for length, n in Counter((largest, *option)).items())
            yield from (((largest, *option), times) for times in range(most, 0, -1))

    whole = False
    if total:
        open_frame(stock, 0)
    while nodes and bins_of(best) > goal:
        if not frames:
            if whole or not total:
                break
            whole = True
            plan.clear()
            open_frame(stock, 0)
        counts, depth, waste, options = frames[-1]
        del plan[depth:]
        option = next(options, None)
        if option is None:
            frames.pop()
            continue
        nodes -= 1
        filling, times = option
        if filling is None:
            continue
        need = Counter(filling)
        if times is None:
            times = min(int(counts[length]) // n for length, n in need.items())
        waste = waste + times * (capacity - sum(filling))
        if waste + total > (bins_of(best) - 1) * capacity:
            continue  # even without further waste no fewer bins than the incumbent
        plan.append((filling, times))
        after = counts.copy()
        for length, n in need.items():
            after[length] -= times * n
        if after.any():
            open_frame(after, waste)
        elif bins_of(plan) < bins_of(best):
            best = list(plan)
    return best


# --- on Spark --------------------------------------------------------------------------------

def cut_pieces(docs: DataFrame, capacity: int, end_id: int | None, tokenizer_file: str, rank_file: str) -> DataFrame:
    """Pieces of every document with their crc; rank counts pieces of one length within one partition."""
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen, part = byte_bpe(tokenizer_file, rank_file), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = bpe.id_bytes(text.as_py() or "") + end
                total = len(ids) // 4
                first = total - capacity * (max(total - 1, 0) // capacity)
                start, length, piece = 0, first, 0
                while start < total or piece == 0:
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start: 4 * (start + length)]), part, seen[length]))
                    seen[length] += 1
                    start, length, piece = start + length, capacity, piece + 1
            columns = list(zip(*rows)) or [()] * 7
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "rank")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECES)


def slots_of(plan: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first sequence and offset of its runs of slots, in rank order."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken: Counter = Counter()
    sequence = 0
    for filling, times in plan:
        offset = 0
        for length in filling:
            runs.setdefault(length, []).append((taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*r)) for length, r in runs.items()}


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int | None = END_ID, nodes: int = 3000,
         tokenizer_file: str = TOKENIZER_FILE, rank_file: str = RANK_FILE) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32, sequence_id, offset) of the packed documents (doc_id, text)."""
    pieces = materialize(cut_pieces(docs, capacity, end_id, tokenizer_file, rank_file), "pieces")
    counts = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    # One row per length: at most capacity + 1 of them, whatever the input.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slots_of([*complete_bins({k: n for k, n in histogram.items() if k > 0}, capacity, nodes),
                      ((0,), histogram.get(0, 0))])
    before = counts.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n"))
                           .alias("before"))
    # Merged, never broadcast: the counts grow with the partitions. A piece is a few numbers, and a length that many share is many keys.
    ranked = pieces.join(before.hint("merge"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    first, to, at = slots[int(length[rows[0]])]
                    run = np.searchsorted(first, rank[rows], side="right") - 1
                    sequence[rows], offset[rows] = to[run] + rank[rows] - first[run], at[run]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[
                "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
