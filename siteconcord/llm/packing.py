"""Best-fit packing of token sequences by bin completion.

Every document becomes its tokens and an end token. Longer ones than a sequence are cut, the remainder first, and all pieces
are placed whole. What matters for the packing is how many pieces there are of each length, and that is at most `CAPACITY`
numbers however large the corpus: tasks count, and the driver solves the histogram.

* Incumbent: best-fit decreasing on the histogram.
* Bin completion: the longest piece left opens a sequence, and the fillings of the rest that no other filling dominates are
  tried, least waste first. A filling is used as often as the counts allow, so the steps follow the number of lengths.
* A branch is cut when the waste so far, or the tokens left, show that it cannot beat the incumbent; the search ends at
  the lower bound of total tokens, or after `NODES` steps with the best packing found.

Pieces are numbered within their length (per written part, plus the counts of earlier parts), and a run of equal sequences
takes pieces by number. So nothing of any document passes through the driver, and no group is gathered.

Defined cases: null and empty texts are one piece, the end token; equal rows are pieces of their own; empty tables give an empty
result; a text that spells a special token gets the id the tokenizer gives it; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteconcord.llm.batches import chunks
from siteconcord.llm.common import small
from siteconcord.session import materialized

CAPACITY = 1024
END_ID = 2
# Steps of the search over histograms.
NODES = 3_000
# Fillings kept for one opening piece.
FILLINGS = 8
_LOOKS = 400


# --- pieces -----------------------------------------------------------------------------------------------------------


class Encoder:
    """Ids as the tokenizer file gives them.

    The rank file beside it holds the same vocabulary for a library that is four times as fast; texts that spell an added
    token go to the tokenizer itself.
    """

    def __init__(self, tokenizer_file: str, rank_file: str | None, pattern: str | None):
        import json

        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.fast = None
        if rank_file:
            import tiktoken

            with open(rank_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(t in text for t in self.added):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def pieces(docs: DataFrame, tokenizer_file: str, rank_file: str | None, pattern: str | None, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """One row per piece, with the number of the part it was made in and its place among that part's pieces of its length."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_file, rank_file, pattern)
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for rows in chunks(batch, "text"):
                at, number, starts, lengths, crcs, places, held = [], [], [], [], [], [], []
                for row, text in enumerate(rows.column("text").to_pylist()):
                    ids = np.array([*encoder.ids(text or ""), end_id], "<u4")
                    for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                        own = ids[start : start + length]
                        at.append(row)
                        number.append(k)
                        starts.append(start)
                        lengths.append(length)
                        crcs.append(zlib.crc32(own.tobytes()))
                        places.append(seen[length])
                        seen[length] += 1
                        if keep_ids:
                            held.append(own.tolist())
                columns = {
                    "doc_id": rows.column("doc_id").take(pa.array(at, pa.int64())),
                    "piece": pa.array(number, pa.int32()),
                    "start": pa.array(starts, pa.int64()),
                    "length": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                    "part": pa.array([part] * len(at), pa.int32()),
                    "place": pa.array(places, pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array(held, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = f"doc_id {doc_id}, piece int, start long, length long, ids_crc32 long, part int, place long"
    return docs.select("doc_id", "text").mapInArrow(make, schema + (", ids array<long>" if keep_ids else ""))


# --- the histogram ----------------------------------------------------------------------------------------------------

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first


@dataclass(frozen=True)
class Run:
    """`times` equal sequences."""

    filling: Filling
    times: int


def _times(filling: Filling, counts: list[int]) -> int:
    return min(counts[length] // number for length, number in filling)


def best_fit(counts: list[int], capacity: int) -> list[Run]:
    """Best-fit decreasing: each length, longest first, goes to the open sequences with the least room that suffices."""
    rooms: dict[int, list[list]] = {r: [] for r in range(capacity + 1)}  # room left: [filling, how many]
    for length in range(capacity, 0, -1):
        left = counts[length]
        room = length
        while left:
            while room <= capacity and not rooms[room]:
                room += 1
            if room > capacity:
                fit = min(capacity // length, left)
                times = left // fit
                rooms[capacity - fit * length].append([((length, fit),), times])
                left -= times * fit
                room = length
                continue
            filling, times = rooms[room].pop()
            used = min(times, left)
            if used < times:
                rooms[room].append([filling, times - used])
            rooms[room - length].append([(*filling, (length, 1)), used])
            left -= used
            room = length
    merged: dict[Filling, int] = {}
    for opened in rooms.values():
        for filling, times in opened:
            totals: dict[int, int] = {}
            for length, number in filling:
                totals[length] = totals.get(length, 0) + number
            key = tuple(sorted(totals.items(), reverse=True))
            merged[key] = merged.get(key, 0) + times
    return [Run(f, t) for f, t in merged.items()]


def fillings(counts: list[int], lengths: list[int], capacity: int) -> list[Filling]:
    """Undominated fillings around the longest piece left, least waste first.

    `lengths`: those with pieces left, ascending. Depth first, longer pieces first. A filling to which another piece could
    be added is dominated; so is one whose last piece could be exchanged for a longer one that fits. A filling without waste ends the look.
    """
    longest = lengths[-1]
    found: dict[Filling, int] = {}
    looks = 0

    def look(room: int, top: int, chosen: dict[int, int]) -> bool:
        """Fill the room with lengths up to index `top`; true once nothing can be better."""
        nonlocal looks
        looks += 1
        while top >= 0 and (lengths[top] > room or counts[lengths[top]] <= chosen.get(lengths[top], 0)):
            top -= 1
        if top < 0:
            key = tuple(sorted(chosen.items(), reverse=True))
            found.setdefault(key, room)
            return room == 0
        # An exact last piece beats any other way to end.
        if counts[room] > chosen.get(room, 0):
            return look(0, top, {**chosen, room: chosen.get(room, 0) + 1})
        for at in range(top, max(-1, top - 24), -1):
            length = lengths[at]
            had = chosen.get(length, 0)
            # As many as fit, or one: a filling has few lengths, so the look stays shallow.
            for number in dict.fromkeys((min(room // length, counts[length] - had), 1)):
                if 0 < number <= counts[length] - had and look(room - number * length, at, {**chosen, length: had + number}):
                    return True
            if looks > _LOOKS:
                break
        return False

    look(capacity - longest, len(lengths) - 1, {longest: 1})
    return [f for f, _ in sorted(found.items(), key=lambda x: (x[1], len(x[0])))][:FILLINGS]


def bin_completion(counts: list[int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Run]:
    """Runs that hold all pieces; `counts[l]` pieces have length l."""
    counts = list(counts)
    total = sum(length * number for length, number in enumerate(counts))
    bound = -(-total // capacity)
    best = best_fit(counts, capacity)
    fewest = sum(r.times for r in best)
    # A branch: counts left, tokens left, sequences used, runs so far as a linked list.
    stack = [(counts, total, 0, None)]
    while stack and fewest > bound and nodes:
        counts, left, used, runs = stack.pop()
        nodes -= 1
        if used + -(-left // capacity) >= fewest:
            continue
        if not left:
            fewest, best = used, []
            while runs:
                run, runs = runs
                best.append(run)
            best.reverse()
            continue
        lengths = [length for length, number in enumerate(counts) if number]
        for filling in reversed(fillings(counts, lengths, capacity)):
            times = _times(filling, counts)
            after = list(counts)
            for length, number in filling:
                after[length] -= number * times
            held = sum(length * number for length, number in filling)
            stack.append((after, left - held * times, used + times, (Run(filling, times), runs)))
    return best


def takes(runs: list[Run]) -> dict[int, np.ndarray]:
    """Per length, ascending: (first piece number, how many a sequence takes, first sequence, offset of the first)."""
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for run in runs:
        offset = 0
        for length, number in run.filling:
            first = taken.get(length, 0)
            rows.setdefault(length, []).append((first, number, sequence, offset))
            taken[length] = first + number * run.times
            offset += length * number
        sequence += run.times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


# --- the operator -----------------------------------------------------------------------------------------------------


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    rank_file: str | None = None,
    pattern: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): every piece of every row of `docs`."""
    made = materialized(pieces(docs, tokenizer_file, rank_file, pattern, capacity, end_id, keep_ids), "pieces")
    by_part = materialized(made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("number")), "counts")
    counts = [0] * (capacity + 1)
    for row in by_part.groupBy("length").agg(F.sum("number").alias("number")).collect():
        counts[row["length"]] = row["number"]
    placed = takes(bin_completion(counts, capacity))
    sent = docs.sparkSession.sparkContext.broadcast(placed)
    earlier = "sum(number) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = materialized(by_part.selectExpr("part", "length", f"coalesce({earlier}, 0L) AS before"), "offsets")
    numbered = made.join(small(offsets), ["part", "length"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    kept = numbered.select(*names, (F.col("before") + F.col("place")).alias("ordinal"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = sent.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ordinals = batch.column("ordinal").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                runs = taken[length]
                run = runs[np.searchsorted(runs[:, 0], ordinals[rows], "right") - 1]
                behind = ordinals[rows] - run[:, 0]
                sequence[rows] = run[:, 2] + behind // run[:, 1]
                offset[rows] = run[:, 3] + behind % run[:, 1] * length
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, piece int, start long, length long, ids_crc32 long{', ids array<long>' if keep_ids else ''}, sequence_id long, offset long"
    return kept.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences themselves, from `pack(..., keep_ids=True)`. A sequence holds at most `capacity` ids."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    return rows.select("sequence_id", F.flatten(F.col("held.ids")).alias("ids"))
