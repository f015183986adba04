"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Only lengths matter to the packing, and there are at most ``capacity`` of them. The tasks tokenise and count lengths;
the driver plans on that histogram (1,024 numbers, whatever the corpus): fill a sequence greedily with the longest piece
that fits, then try to replace its shortest piece with two unpacked ones that fill the widened gap more tightly. A
filling repeats as often as the counts allow, so the plan is a few thousand lines for any corpus. Pieces then find
their sequence by their rank among pieces of the same length; ranks are made in salted groups with prefix sums, so a
length that most pieces have is no hot key.

Defined cases: a null text is empty and gives the end token alone. A document longer than ``capacity`` is cut into full
pieces, only the first may be shorter. Rows with equal ids are packed separately, as they come. An empty table packs
into nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circlet.llm.common import lean_worker, materialize
from circlet.llm.tokens import ByteTokenizer

CAPACITY = 1024
END_ID = 2
RANK_ROWS = 20_000
_RANKS = 1 << 44


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def token_pieces(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids as little-endian unsigned 32-bit, if asked for)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lean_worker()
        tokenizer = ByteTokenizer.load(vocabulary)
        end = int(end_id).to_bytes(4, "little")
        for pdf in batches:
            rows = []
            for doc_id, ids in zip(pdf["doc_id"], tokenizer.encode_batch(pdf["text"])):
                ids += end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(part), part if with_ids else None))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            yield (out if with_ids else out.drop(columns="ids")).astype({"doc_id": pdf["doc_id"].dtype})

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    fields = [narrow.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    return narrow.mapInPandas(run, T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids))


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY, least_to_swap: int = 2) -> list[tuple[list[int], int]]:
    """(lengths in one bin, how many such bins), best-two-fit over a histogram of lengths."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[list[int], int]] = []
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return plan
        taken: dict[int, int] = {}

        def free(length: int) -> bool:
            return left[length] > taken.get(length, 0)

        def longest(limit: int) -> int:
            i = int(np.searchsorted(there, limit, "right")) - 1
            while i >= 0 and not free(int(there[i])):
                i -= 1
            return int(there[i]) if i >= 0 else 0

        gap = capacity
        while length := longest(gap):
            times = min(gap // length, int(left[length]) - taken.get(length, 0))
            taken[length] = taken.get(length, 0) + times
            gap -= times * length
        if gap and sum(taken.values()) >= least_to_swap:
            smallest = min(taken)
            room, best = gap + smallest, (smallest, 0, 0)
            for a in (int(x) for x in there[: np.searchsorted(there, room, "right")][::-1]):
                if 2 * a <= best[0]:
                    break
                if not free(a):
                    continue
                b = longest(min(a, room - a))
                if b == a and left[a] - taken.get(a, 0) < 2:
                    b = longest(min(a - 1, room - a))
                if b and a + b > best[0]:
                    best = (a + b, a, b)
            if best[2]:
                taken[smallest] -= 1
                for x in best[1:]:
                    taken[x] = taken.get(x, 0) + 1
        used = {k: v for k, v in taken.items() if v}
        times = min(int(left[k]) // v for k, v in used.items())
        for k, v in used.items():
            left[k] -= times * v
        plan.append(([k for k in sorted(used, reverse=True) for _ in range(used[k])], times))


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """The shorter of the plans that swap in bins of one piece too, or only in fuller ones."""
    return min((plan_bins(counts, capacity, k) for k in (2, 1)), key=lambda p: sum(n for _, n in p))


def _lookup(plan: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each length, which ranks go to which bins, as sorted arrays."""
    rows, used, start = [], {}, 0
    for lengths, times in plan:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            each = lengths.count(length)
            low = used.get(length, 0)
            rows.append((length * _RANKS + low, low, start, each, offset))
            used[length] = low + times * each
            offset += each * length
        start += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("key", "low", "bin", "each", "offset"), table.T))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` from 1 to ``capacity``."""
    pieces = materialize(pieces, "pieces")
    total = pieces.count()
    salts = max(1, -(-total // RANK_ROWS))
    salted = pieces.withColumn("pack_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "pack_salt").agg(F.count(F.lit(1)).alias("pack_n"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("pack_n").alias("n")).collect()}  # at most `capacity` rows
    if not histogram:
        return pieces.withColumn("sequence_id", F.lit(0).cast("bigint")).withColumn("offset", F.lit(0).cast("bigint"))
    before = F.sum("pack_n").over(Window.partitionBy("length").orderBy("pack_salt")) - F.col("pack_n")
    offsets = sizes.select("length", "pack_salt", before.alias("pack_before"))
    inside = F.row_number().over(Window.partitionBy("length", "pack_salt").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("pack_inside", inside).join(offsets, ["length", "pack_salt"])
    look = _lookup(best_plan(histogram, capacity))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(), pdf.pop("pack_rank").to_numpy()
            i = np.searchsorted(look["key"], length * _RANKS + rank, "right") - 1
            q = rank - look["low"][i]
            yield pdf.assign(sequence_id=look["bin"][i] + q // look["each"][i], offset=look["offset"][i] + q % look["each"][i] * length)

    placed = ranked.select(*pieces.columns, (F.col("pack_inside") + F.col("pack_before")).alias("pack_rank"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return placed.mapInPandas(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their place."""
    return pack_pieces(token_pieces(docs, vocabulary, id_column, text_column, capacity, end_id), capacity)


def packed_sequences(docs: DataFrame, placed: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """sequence_id and its token ids (little-endian unsigned 32-bit): the training input itself. Ids must be unique."""
    pieces = token_pieces(docs, vocabulary, id_column, text_column, capacity, end_id, with_ids=True).select("doc_id", "piece", "ids")
    parts = placed.select("doc_id", "piece", "sequence_id", "offset").join(pieces, ["doc_id", "piece"])
    return parts.groupBy("sequence_id").agg(
        F.expr("aggregate(transform(array_sort(collect_list(struct(offset, ids))), x -> x.ids), cast('' as binary), (a, b) -> concat(a, b))").alias("ids")
    )
