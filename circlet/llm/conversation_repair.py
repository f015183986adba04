"""Conversation structure repair: cheapest edits by a Viterbi search that runs in parallel over chunks of rows.

A repaired conversation has role initials ``(s?(ua)+)?``. The states of that pattern are 0 (nothing yet), 1 (after
system), 2 (after user) and 3 (after assistant). Each row is kept, re-roled or deleted, and empty turns are inserted before
it or at the end; a row so is a 4 x 4 matrix over (min, +), and the least costs to repair the rest, from each
state, are products of matrices, taken from the last row back.

Rows are cut into chunks of at most ``2**chunk_bits``, also inside one conversation. Every chunk starts from a speculative
vector of costs at its right end. Fix-up passes give each chunk the vector that its right neighbour found, and run
it again only until the new vectors differ from the old ones by a constant: from there on both choose the same edits.
When no chunk's vector moves any more, the backward costs fit together, and the forward trace takes at each place the
first of D, I, K, R that keeps the least cost: the least audit of the cheapest. Its state at the start of a chunk is
found the same way, from all four states at once, in passes until none changes.

What is not split: the hash of a repaired conversation, which SHA-256 computes in the order of its text. Its rows stream
through one task, a batch at a time.

Defined cases: null roles and texts are one space; a null conversation id is a conversation of its own. Rows of equal turn
go by role, then by the hash of the text. Chunks of rows that have to be deleted only pass on what they
get, and are left out of the passes. A long row of chunks whose vectors never become equal up to a constant takes as many
passes as chunks, with the same result. Extra columns are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from circlet.llm.common import attach_group, lean_worker, materialize, small_batches

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
CHUNK_BITS = 12
FAR = 1 << 28
PASS = 16  # code of padding: changes nothing
_NO_BLANK = r"[^\x20\x09-\x0D]"
ROLES = {0: "user", 1: "user", 2: "assistant", 3: "user"}  # what an insertion or a new role is, from each state
AFTER = {0: 2, 1: 2, 2: 3, 3: 2}
KEEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
END = np.array([0, 2 * INSERT, INSERT, 0])  # least costs to finish without further rows


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code (4 initial + fault): least costs with insertions before the row, costs and next states of D, K, R."""
    inserts = np.full((4, 4), FAR)
    for s in range(4):
        inserts[s, s] = 0
        inserts[s, AFTER[s]] = INSERT
    inserts = _product(inserts, inserts)
    whole, costs, states = np.full((17, 4, 4), FAR), np.full((17, 3, 4), FAR), np.zeros((17, 3, 4), dtype=np.int64)
    np.fill_diagonal(whole[PASS], 0)
    for code in range(16):
        initial, fault = "sua."[code // 4], code % 4
        step = np.full((4, 4), FAR)
        extra = TRUNCATED if fault == 1 else 0
        for s in range(4):
            ways = [(DELETE, s)]
            if fault < 2:
                ways += [(extra, KEEPS[initial][s]) if s in KEEPS.get(initial, {}) else (FAR, s), (REROLE + extra, AFTER[s])]
            for k, (cost, t) in enumerate(ways):
                costs[code, k, s], states[code, k, s] = cost, t
                step[s, t] = min(step[s, t], cost)
        whole[code] = _product(inserts, step)
    return whole, costs, states


WHOLE, COSTS, STATES = _tables()
_AFTER = np.array([AFTER[s] for s in range(4)])


def padded(codes: list[bytes]) -> np.ndarray:
    """Codes of chunks as columns, one row for each place; short chunks are padded at their end."""
    out = np.full((max(map(len, codes)), len(codes)), PASS, dtype=np.int64)
    for i, row in enumerate(codes):
        out[: len(row), i] = np.frombuffer(row, dtype=np.uint8)
    return out


def backward(codes: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least costs at every place of every chunk and state, given those at the right ends."""
    costs = np.empty((len(codes) + 1, codes.shape[1], 4), dtype=np.int64)
    costs[-1] = right
    for t in range(len(codes) - 1, -1, -1):
        costs[t] = (WHOLE[codes[t]] + costs[t + 1][:, None, :]).min(axis=2)
    return costs


def level(vectors: np.ndarray) -> np.ndarray:
    """Vectors less their least entry: equal if they differ by a constant."""
    return vectors - vectors.min(axis=-1, keepdims=True)


def fix_up(codes: np.ndarray, old: np.ndarray, new: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, int]:
    """Vectors at the left ends for new vectors at the right ends, and the number of places run.

    ``left`` holds those of the old ones. A chunk is left alone from the place on where both differ by a constant.
    """
    out, live, places = left.copy(), np.arange(codes.shape[1]), 0
    old, new = old.copy(), new.copy()
    for t in range(len(codes) - 1, -2, -1):
        live = live[(level(old[live]) != level(new[live])).any(axis=1)]
        if t < 0 or not len(live):
            break
        step = WHOLE[codes[t, live]]
        old[live] = level((step + old[live][:, None, :]).min(axis=2))
        new[live] = level((step + new[live][:, None, :]).min(axis=2))
        places += len(live)
    out[live] = level(new[live])
    return out, places


def trace(codes: np.ndarray, costs: np.ndarray, entry: np.ndarray, letters: bool = True) -> tuple[np.ndarray, list[bytes]]:
    """States at the right ends and, for each chunk, its edits: ``I`` before a row, then D, K or R with the row's fault."""
    n = codes.shape[1]
    state, every = entry.copy(), np.arange(n)
    text, size = np.zeros((n, 4 * len(codes)), dtype=np.uint8), np.zeros(n, dtype=np.int64)

    def put(rows: np.ndarray, what) -> None:
        text[rows, size[rows]] = what
        size[rows] += 1

    for t in range(len(codes)):
        code = codes[t]
        waiting = every[code != PASS]
        while len(waiting):
            s, c = state[waiting], code[waiting]
            here = costs[t, waiting, s]
            ahead = costs[t + 1, waiting[:, None], STATES[c, :, s]] + COSTS[c, :, s] == here[:, None]
            insert = ~ahead[:, 0] & (costs[t, waiting, _AFTER[s]] + INSERT == here)
            going, way = waiting[~insert], ahead[~insert].argmax(axis=1)
            state[going] = STATES[code[going], way, state[going]]
            state[waiting[insert]] = _AFTER[s[insert]]
            if letters:
                put(waiting[insert], ord("I"))
                put(going, np.frombuffer(b"DKR", dtype=np.uint8)[way])
                put(going, ord("0") + code[going] % 4)
            waiting = waiting[insert]
    return state, [text[i, : size[i]].tobytes() for i in range(n)] if letters else []


def _groups(sizes: list[int], room: int = 1 << 19) -> Iterator[list[int]]:
    """Indices of chunks of like sizes, so that padding stays small and arrays bounded."""
    group: list[int] = []
    for i in sorted(range(len(sizes)), key=sizes.__getitem__):
        if group and (len(group) + 1) * sizes[i] > room:
            yield group
            group = []
        group.append(i)
    if group:
        yield group


# ---- rows ---------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults planted by the hash of conversation and turn, as the query asks for them."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``pos``, a number that grows along each conversation, and ``line``, equal for equal role and text in one.

    A range sort over all rows: a conversation of any size spreads over tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    name = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    line = F.sha2(F.concat_ws(":", name, F.length(role).cast("string"), role, text), 256)
    keyed = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), line.alias("line"), F.sha2(text, 256).alias("key"))
    keys = ["conv_id", "turn", "role", "key"]
    spread = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialize(spread.drop("key").withColumn("pos", F.monotonically_increasing_id()), "conversation-rows")


def _code() -> Column:
    initial = F.coalesce(F.try_element_at(F.array(F.lit(0), F.lit(4), F.lit(8)), F.nullif(F.instr(F.lit("sua"), F.substring("role", 1, 1)), F.lit(0))), F.lit(12))
    initial = F.when(F.col("role") == "", F.lit(12)).otherwise(initial)
    fault = F.when(~F.col("text").rlike(_NO_BLANK), F.lit(2)).when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), F.lit(0)).otherwise(F.lit(1))
    return (initial + fault).cast("byte")


def _chunks(rows: DataFrame, chunk_bits: int) -> DataFrame:
    """conv_id, block, first (its first pos) and codes of at most ``2**chunk_bits`` rows each."""
    narrow = rows.select("conv_id", "pos", "line", _code().alias("code"))
    lines = narrow.groupBy("line").agg(F.count(F.lit(1)).alias("size"), F.min("pos").alias("first")).where("size > 1")
    later = attach_group(narrow.select("conv_id", "pos", "line"), lines, "line", "size", rows.count()).where("pos > first")
    marks = narrow.select("conv_id", "pos", "code").unionByName(later.select("conv_id", "pos", F.lit(PASS).cast("byte").alias("code")))
    packed = marks.groupBy("conv_id", F.shiftright("pos", chunk_bits).alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("marks"))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out, first = [], []
            for marks in pdf["marks"]:
                row = bytearray()
                for mark in marks:
                    if mark["code"] == PASS:
                        row[-1] = row[-1] if row[-1] % 4 == 2 else row[-1] // 4 * 4 + 3
                    else:
                        row.append(mark["code"])
                out.append(bytes(row))
                first.append(marks[0]["pos"])
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "block": pdf["block"], "first": first, "codes": out, "free": [any(c % 4 < 2 for c in row) for row in out]})

    schema = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string("block long, first long, codes binary, free boolean").fields])
    return packed.mapInPandas(code, schema)


# ---- passes over chunks ---------------------------------------------------------------------------


def _settle_costs(chunks: DataFrame) -> DataFrame:
    """Adds ``at_right`` and ``at_left``, levelled vectors of least costs that fit together along each conversation."""
    schema = T.StructType([*chunks.schema.fields, *T._parse_datatype_string("at_right array<long>, at_left array<long>, moved boolean").fields])

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes, left = list(pdf["codes"]), [None] * len(pdf)
            for group in _groups([len(c) for c in codes]):
                block = padded([codes[i] for i in group])
                vectors = np.tile(END, (len(group), 1))
                for t in range(len(block) - 1, -1, -1):
                    vectors = (WHOLE[block[t]] + vectors[:, None, :]).min(axis=2)
                for i, row in zip(group, level(vectors)):
                    left[i] = row
            yield pdf.assign(at_right=[END] * len(pdf), at_left=left, moved=True)

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes, right, left, moved = list(pdf["codes"]), list(pdf["at_right"]), list(pdf["at_left"]), [False] * len(pdf)
            stale = [i for i, given in enumerate(pdf["given"]) if given is not None and list(given) != list(right[i])]
            for group in ([stale[j] for j in g] for g in _groups([len(codes[i]) for i in stale])):
                new = np.array([pdf["given"].iloc[i] for i in group])
                found, _ = fix_up(padded([codes[i] for i in group]), np.array([right[i] for i in group]), new, np.array([left[i] for i in group]))
                for i, at_right, at_left in zip(group, new, found):
                    right[i], left[i], moved[i] = at_right, at_left, True
            yield pdf.drop(columns="given").assign(at_right=right, at_left=left, moved=moved)

    state = materialize(chunks.mapInPandas(start, schema), "conversation-costs")
    while True:
        given = state.select(F.col("conv_id").alias("their_id"), F.col("block").alias("their_block"), F.col("at_left").alias("given"))
        near = state.drop("moved").join(given, F.col("conv_id").eqNullSafe(F.col("their_id")) & (F.col("next_block") == F.col("their_block")), "left").drop("their_id", "their_block")
        state = materialize(near.mapInPandas(again, schema), "conversation-costs")
        if state.where("moved").isEmpty():
            return state.drop("moved")


def _settle_entries(chunks: DataFrame) -> DataFrame:
    """Adds ``entry``: the state in which the least-audit trace comes to each chunk."""

    def exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.zeros((len(pdf), 4), dtype=np.int64)
            codes, right = list(pdf["codes"]), list(pdf["at_right"])
            for group in _groups([len(c) for c in codes]):
                block = padded([codes[i] for i in group])
                costs = backward(block, np.array([right[i] for i in group]))
                for s in range(4):
                    out[group, s] = trace(block, costs, np.full(len(group), s), letters=False)[0]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "block": pdf["block"], "prev_block": pdf["prev_block"], "exits": list(out)})

    id_field = chunks.schema["conv_id"]
    schema = T.StructType([id_field, *T._parse_datatype_string("block long, prev_block long, exits array<long>").fields])
    guess = F.when(F.col("prev_block").isNull(), F.lit(0)).otherwise(F.lit(3))
    state = materialize(chunks.select("conv_id", "block", "prev_block", "codes", "at_right").mapInPandas(exits, schema).withColumn("entry", guess), "conversation-entries")
    while True:
        given = state.select(F.col("conv_id").alias("their_id"), F.col("block").alias("their_block"), F.element_at("exits", F.col("entry") + 1).cast("int").alias("given"))
        near = state.join(given, F.col("conv_id").eqNullSafe(F.col("their_id")) & (F.col("prev_block") == F.col("their_block")), "left")
        new = F.coalesce(F.col("given"), F.col("entry"))
        state = materialize(near.select("conv_id", "block", "prev_block", "exits", new.alias("entry"), (new != F.col("entry")).alias("moved")), "conversation-entries")
        if state.where("moved").isEmpty():
            break
        state = state.drop("moved")
    entries = state.select(F.col("conv_id").alias("their_id"), F.col("block").alias("their_block"), "entry")
    return chunks.join(entries, F.col("conv_id").eqNullSafe(F.col("their_id")) & (F.col("block") == F.col("their_block"))).drop("their_id", "their_block")


def _edits(chunks: DataFrame) -> DataFrame:
    """conv_id, pos, edit of all rows; ``edit`` is ``I*[DKR]`` and the digit of the row's fault."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes, right, entry = list(pdf["codes"]), list(pdf["at_right"]), pdf["entry"].to_numpy()
            for group in _groups([len(c) for c in codes]):
                block = padded([codes[i] for i in group])
                _, letters = trace(block, backward(block, np.array([right[i] for i in group])), entry[group])
                yield pd.DataFrame({"conv_id": pdf["conv_id"].iloc[group].to_numpy(), "first": pdf["first"].iloc[group].to_numpy(), "edits": [x.decode() for x in letters]}).astype({"conv_id": pdf["conv_id"].dtype})

    schema = T.StructType([chunks.schema["conv_id"], *T._parse_datatype_string("first long, edits string").fields])
    traced = chunks.select("conv_id", "first", "codes", "at_right", "entry").mapInPandas(run, schema)
    each = traced.select("conv_id", "first", F.posexplode(F.regexp_extract_all("edits", F.lit("I*[DKR][0-3]"), F.lit(0))).alias("step", "edit"))
    return each.select("conv_id", (F.col("first") + F.col("step")).alias("pos"), "edit")


def edits(rows: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """The edit of every row of a table made by ``ordered``."""
    chunks = materialize(_chunks(rows, chunk_bits), "conversation-chunks")
    along = "partition by conv_id order by block"  # one row for each chunk that has something to choose
    free = chunks.where("free").select("*", F.expr(f"lead(block) over ({along})").alias("next_block"), F.expr(f"lag(block) over ({along})").alias("prev_block"))
    several = materialize(free.where("next_block is not null or prev_block is not null"), "conversation-several")
    linked = _settle_entries(_settle_costs(several)).drop("next_block", "prev_block")
    alone = free.where("next_block is null and prev_block is null").drop("next_block", "prev_block")
    only = F.array(*[F.lit(int(x)).cast("long") for x in END]).alias("at_right")
    deleted = chunks.where("not free")
    simple = alone.unionByName(deleted).select("*", only, F.lit(0).alias("entry"))
    return _edits(simple.unionByName(linked.select(*simple.columns)))


# ---- results --------------------------------------------------------------------------------------


class _Repair:
    """Follows one conversation row by row and gathers its results."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.rows = conv_id, 0, []
        self.turns, self.low, self.turn = 0, None, None
        self.faults, self.cost, self.illegal, self.before = [0] * 4, 0, 0, None
        self.audit, self.hash, self.any = bytearray(), hashlib.sha256(), False

    def write(self, letter: str, role: str, text: str) -> None:
        self.hash.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.any = True
        self.rows.append((letter, role, text))

    def insert(self) -> None:
        self.audit += b"I"
        self.cost += INSERT
        self.write("I", ROLES[self.state], "")
        self.state = AFTER[self.state]

    def row(self, turn, role: str, text: str, edit: str) -> None:
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.turn = turn
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        letter, fault = edit[-2], int(edit[-1])
        self.faults[fault] += 1
        for _ in edit[:-2]:
            self.insert()
        self.audit += letter.encode()
        if letter == "D":
            self.cost += DELETE
            return
        self.cost += (REROLE if letter == "R" else 0) + (TRUNCATED if fault == 1 else 0)
        if letter == "R":
            role, self.state = ROLES[self.state], AFTER[self.state]
        else:
            self.state = KEEPS[role[0]][self.state]
        self.write(letter, role, text)

    def end(self) -> tuple:
        while self.state in (1, 2):
            self.insert()
        gaps = self.turn - self.low + 1 - self.turns if self.turns else 0
        _, truncated, blank, duplicate = self.faults
        return (self.conv_id, gaps, blank, duplicate, truncated, self.illegal, self.cost, self.audit.decode(), self.hash.hexdigest())


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROWS = "place long, edit string, role string, text string"


def repair(rows: DataFrame, ids: DataFrame | None = None, chunk_bits: int = CHUNK_BITS, as_rows: bool = False) -> DataFrame:
    """Faults, least cost, audit and hash of every conversation, or the repaired rows themselves.

    ``rows``: conv_id, turn, role, text. ``ids``: conversations to report even if they have no row.
    """
    placed = ordered(rows)
    id_field = placed.schema["conv_id"]
    lines = placed.select("conv_id", "pos", "turn", "role", "text", F.lit(None).cast("string").alias("edit"))
    none = {c: F.lit(None).cast(placed.schema[c].dataType) for c in ("turn", "role", "text")}
    marks = edits(placed, chunk_bits).select("conv_id", "pos", *[v.alias(c) for c, v in none.items()], "edit")
    named = (rows if ids is None else ids).select("conv_id").distinct()
    heads = named.select(F.col("conv_id").cast(id_field.dataType).alias("conv_id"), F.lit(-1).cast("long").alias("pos"), *[v.alias(c) for c, v in none.items()], F.lit(None).cast("string").alias("edit"))
    events = lines.unionByName(marks).unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "pos", F.col("edit").desc_nulls_last())
    schema = T.StructType([id_field, *T._parse_datatype_string(ROWS if as_rows else REPORT).fields])
    arrow = [to_arrow_type(f.dataType) for f in schema]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(zip(*out) if out else [[]] * len(arrow), arrow)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        now, edit, written = None, None, 0
        for batch in batches:
            out: list[tuple] = []
            for conv_id, pos, turn, role, text, given in zip(*(c.to_pylist() for c in batch.columns)):
                if pos < 0:  # head of a conversation
                    if now is not None:
                        closing = now.end()
                        out += [(now.conv_id, written + k, *row) for k, row in enumerate(now.rows)] if as_rows else [closing]
                    now, written = _Repair(conv_id), 0
                elif given is not None:
                    edit = given
                else:
                    now.row(turn, role, text, edit)
                    if as_rows:
                        out += [(conv_id, written + k, *row) for k, row in enumerate(now.rows)]
                        written += len(now.rows)
                    now.rows.clear()
            if out:
                yield batch_of(out)
        if now is not None:
            closing = now.end()
            yield batch_of([(now.conv_id, written + k, *row) for k, row in enumerate(now.rows)] if as_rows else [closing])

    with small_batches(rows.sparkSession):
        return events.mapInArrow(run, schema)
