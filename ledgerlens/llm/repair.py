"""Conversation structure repair by rank-convergent parallel Viterbi.

The cheapest edits that give a conversation the role order ``(s?(ua)+)?`` (system, user, assistant) are the cheapest path
through four states. What matters of a vector of four backward costs is how they differ, and only few such vectors can
occur: a vector times a row is a step between them.

1. Rows get a place in the order of all conversations; a chunk is the part of one conversation in a run of ``CHUNK``
   places, so a conversation of any length is many small rows.
2. Every chunk runs backward from speculative cost vectors at its end: all that can occur. Where they end up differing
   only by constants, the chunk has converged: its cost vector is known whatever follows it.
3. Fix-up passes: a chunk that has not converged is run together with the chunks behind it, twice as many in each pass,
   until it has. So even rows that change no vector (all deleted) take a logarithmic number of passes.
4. With the vectors stitched, chunks run again from the true one, and the least cheapest edits are traced forward; which
   state a chunk starts in is found in the same way.

Costs: keep 0, new role 3, delete 4, insert an empty turn 3, and 3 for a truncated row that is not deleted. Blank and
repeated rows must go. Of equally cheap edits those with the least string of initials (D, I, K, R) count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordering import with_global_index
from ..session import materialize

CHUNK = 256  # rows of a conversation that are run together at most
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or renamed turn leads to, and where a kept one may lead.
EXPECTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
#: A row's code: d must go, else the initial of its role (o: any other), as a capital letter if the text is truncated.
CODES = "dsuaoSUAO"
LETTER = {USER: "u", ASSISTANT: "a"}

Vector = tuple[float, ...]


def _closed(costs: list[float]) -> list[float]:
    """Costs after any inserts in front."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[EXPECTED[s]]) for s, c in enumerate(costs)]
    return costs


def _before(after: Vector, code: str) -> list[float]:
    """Backward costs in front of a row, from those behind it."""
    out = []
    for state, cost in enumerate(after):
        best = DELETE + cost
        if code != "d":
            extra = TRUNCATED if code.isupper() else 0
            best = min(best, REROLE + extra + after[EXPECTED[state]])
            if state in KEPT[code.lower()]:
                best = min(best, KEEP + extra + after[KEPT[code.lower()][state]])
        out.append(best)
    return _closed(out)


def _normal(costs: list[float]) -> Vector:
    return tuple(c - min(costs) for c in costs)


@cache
def machine() -> tuple[list[Vector], dict[str, np.ndarray]]:
    """All vectors that occur, up to a constant (number 0 is the one at the end of a conversation), and the steps."""
    vectors = [_normal(_closed([0.0, np.inf, np.inf, 0.0]))]
    number = {vectors[0]: 0}
    steps: dict[str, list[int]] = {c: [] for c in CODES}
    for vector in vectors:  # grows meanwhile
        for code in CODES:
            before = _normal(_before(vector, code))
            if before not in number:
                number[before] = len(vectors)
                vectors.append(before)
            steps[code].append(number[before])
    return vectors, {c: np.array(to) for c, to in steps.items()}


@cache
def _edit(after: int, code: str, state: int) -> tuple[str, int]:
    """The least cheapest edits at a row: (inserted roles as u or a; then D, K, or the new role as U or A), next state."""
    vector = machine()[0][after]
    before = _before(vector, code)
    extra = TRUNCATED if code.isupper() else 0
    done = ""
    while True:
        to = EXPECTED[state]
        if before[state] == DELETE + vector[state]:
            return done + "D", state
        if before[state] == INSERT + before[to]:
            done, state = done + LETTER[to], to
        elif state in KEPT[code.lower()] and before[state] == KEEP + extra + vector[KEPT[code.lower()][state]]:
            return done + "K", KEPT[code.lower()][state]
        else:
            return done + LETTER[to].upper(), to


def _vectors_behind(codes: str, last: int) -> list[int]:
    """The number of the cost vector behind each row and, first, in front of all; ``last`` stands behind the chunk."""
    steps = machine()[1]
    out = [last]
    for code in reversed(codes):
        out.append(int(steps[code][out[-1]]))
    return out[::-1]


def trace(codes: str, last: int, state: int) -> tuple[list[str], int]:
    """The edits of a chunk's rows and the state behind it."""
    edits = []
    for code, after in zip(codes, _vectors_behind(codes, last)[1:]):
        edit, state = _edit(after, code, state)
        edits.append(edit)
    return edits, state


def _tail(state: int) -> str:
    """Inserted roles at the end of a conversation."""
    vector, out = machine()[0][0], ""
    while vector[state]:
        state = EXPECTED[state]
        out += LETTER[state]
    return out


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with planted faults, by crc32(conv:turn) modulo 20; null roles and texts are one space.

    0 leaves the row out, 1 empties its text, 2 removes its ends of sentences, 3 repeats it, 4 sets its role to user.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank(conv), blank(turn))) % 20
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"),
        kind.alias("kind"),
    )
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select(
        "conv",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        changed.alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def faults(df: DataFrame) -> DataFrame:
    """Stored rows (conv, turn, role, text) with place, block, fault (blank, duplicate, truncated or null) and code.

    The order is conv, turn (null first), role, text; equal rows follow each other. A row is a duplicate if its
    conversation has the same role and text earlier (compared by MD5). Null roles and texts count as empty.
    """
    rows = df.select("conv", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    placed = with_global_index(rows, ["conv", "turn", "role", "text"], "place")
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    placed = placed.withColumns(
        {
            "block": F.floor(F.col("place") / CHUNK),
            "mark": F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")),
            "blank": end == "",
            "truncated": ~F.right(end, F.lit(1)).isin(".", "!", "?"),
        }
    )
    narrow = placed.select("conv", "place", "mark").where(~F.col("blank"))
    first = narrow.groupBy("conv", "mark").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = narrow.join(
        first.select(F.col("conv").alias("c"), F.col("mark").alias("m"), "first"),
        F.col("conv").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")) & (F.col("place") > F.col("first")),
    ).select(F.col("place").alias("again"))
    joined = placed.join(repeated, F.col("place") == F.col("again"), "left")
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("again").isNotNull(), "duplicate").when(F.col("truncated"), "truncated")
    )
    initial = F.left("role", F.lit(1))
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(fault.isin("blank", "duplicate"), "d").when(fault == "truncated", F.upper(code)).otherwise(code)
    told = joined.withColumn("fault", fault).withColumn("code", code)
    return materialize(told.select("conv", "turn", "role", "text", "place", "block", "fault", "code"), "faults")


def _next(table: DataFrame, neighbours: DataFrame, columns: list[Column], away: int) -> DataFrame:
    """``table`` with ``columns`` of the chunk ``away`` chunks on, null where the conversation has none."""
    other = neighbours.select(F.col("conv").alias("c"), (F.col("block") - away).alias("b"), *columns)
    return table.join(other, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left").drop("c", "b")


def _converged(maps: DataFrame, direction: int) -> DataFrame:
    """(conv, block, value): what each chunk gives on, from ``map`` (what it gives on for whatever it is given).

    The chunk at a conversation's end must have a constant map. Passes end when every map is constant.
    """
    away = direction
    maps = materialize(maps, "chunk-maps")
    same = F.array_min("map") == F.array_max("map")
    found = maps.where(same)
    opened = maps.where(~same)
    while not opened.isEmpty():
        both = _next(opened, maps, [F.col("map").alias("on")], away)
        both = both.select("conv", "block", F.transform("on", lambda v: F.col("map")[v]).alias("map"))
        maps = materialize(found.unionByName(both), "chunk-maps")
        found, opened = maps.where(same), maps.where(~same)
        away *= 2
    return maps.select("conv", "block", F.col("map")[0].alias("value"))


def plan(rows: DataFrame) -> DataFrame:
    """Stored chunks of ``faults``: conv, block, codes, edits (one for each row, in order), tail (inserts at the end)."""
    chunk = rows.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("place", "code"))).alias("rows"))
    ends = rows.groupBy("conv").agg(F.min("block").alias("head"), F.max("block").alias("foot"))
    ends = ends.withColumnRenamed("conv", "c")
    chunks = chunk.join(ends, F.col("conv").eqNullSafe(F.col("c"))).select(
        "conv",
        "block",
        F.array_join("rows.code", "").alias("codes"),
        (F.col("block") == F.col("head")).alias("is_first"),
        (F.col("block") == F.col("foot")).alias("is_last"),
    )
    chunks = materialize(chunks, "chunks")
    kind = chunks.schema["conv"].dataType.simpleString()

    def speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, steps = machine()
        for batch in batches:
            out = []
            for codes, last in zip(batch.column("codes").to_pylist(), batch.column("is_last").to_pylist()):
                at = np.zeros(len(vectors), dtype=np.int64) if last else np.arange(len(vectors))
                for code in reversed(codes):
                    at = steps[code][at]
                out.append(at)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], ["conv", "block", "map"])

    shape = f"conv {kind}, block bigint"
    vectors = _converged(chunks.select("conv", "block", "codes", "is_last").mapInArrow(speculate, f"{shape}, map array<int>"), 1)
    given = _next(chunks, vectors, [F.col("value").alias("last")], 1).withColumn("last", F.coalesce("last", F.lit(0)))
    given = materialize(given, "stitched")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                starts = [START] * 4 if row["is_first"] else range(4)
                out.append([trace(row["codes"], row["last"], s)[1] for s in starts])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], ["conv", "block", "map"])

    states = _converged(given.select("conv", "block", "codes", "is_first", "last").mapInArrow(walk, f"{shape}, map array<int>"), -1)
    given = _next(given, states, [F.col("value").alias("state")], -1).withColumn("state", F.coalesce("state", F.lit(START)))

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits, tails = [], []
            for row in batch.to_pylist():
                found, state = trace(row["codes"], row["last"], row["state"])
                edits.append(found)
                tails.append(_tail(state) if row["is_last"] else "")
            columns = [*(batch.column(c) for c in ("conv", "block", "codes")), pa.array(edits, pa.list_(pa.string())), pa.array(tails, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "block", "codes", "edits", "tail"])

    wanted = given.select("conv", "block", "codes", "is_last", "last", "state")
    return materialize(wanted.mapInArrow(edit, f"{shape}, codes string, edits array<string>, tail string"), "edits")


_NAMES = {"u": "user", "a": "assistant"}


def _inserted(letters: Column) -> Column:
    """Lines of inserted turns, given as letters."""
    name = lambda c: F.when(c == "u", "user:").otherwise("assistant:")
    return F.transform(F.filter(F.split(letters, ""), lambda c: c != ""), name)


def repaired(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """conv, block, audit and lines (``role:text``, with inserted turns) of each chunk; a chunk has ``CHUNK`` rows at most."""
    texts = rows.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("rows")
    )
    joined = texts.withColumnsRenamed({"conv": "c", "block": "b"}).join(
        chunks, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    )

    def own(row: Column, edit: Column) -> Column:
        last = F.right(edit, F.lit(1))
        name = F.when(last == "U", "user").when(last == "A", "assistant").otherwise(row["role"])
        line = F.concat(name, F.lit(":"), row["text"])
        return F.when(last == "D", F.array().cast("array<string>")).otherwise(F.array(line))

    each = F.zip_with(
        "rows",
        "edits",
        lambda row, edit: F.concat(_inserted(F.regexp_replace(edit, "[A-Z]", "")), own(row, edit)),
    )
    audit = F.translate(F.concat(F.array_join("edits", ""), F.col("tail")), "uaUA", "IIRR")
    return joined.select("conv", "block", audit.alias("audit"), F.concat(F.flatten(each), _inserted(F.col("tail"))).alias("lines"))


def streamed(pieces: DataFrame, key: str, order: str, text: str, sep: str, keep: str) -> DataFrame:
    """(key, digest, kept): SHA-256 of the pieces (null: none) of each key in order, joined by ``sep``; ``keep`` joined plainly.

    A digest is sequential, so the pieces of one key pass through one task; only the hash state and ``keep`` are held.
    """
    kind = pieces.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, some, held = None, None, False, []
        done: dict[str, list] = {"key": [], "digest": [], "kept": []}

        def close() -> None:
            done["key"].append(now)
            done["digest"].append(state.hexdigest())
            done["kept"].append("".join(held))

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(done["key"], keys), pa.array(done["digest"]), pa.array(done["kept"])], list(done))
            for column in done.values():
                column.clear()
            return out

        keys = None
        for batch in batches:
            keys = batch.column(0).type
            for one, piece, kept in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if state is None or one != now:
                    if state is not None:
                        close()
                    now, state, some, held = one, hashlib.sha256(), False, []
                if piece is not None:
                    state.update(((sep if some else "") + piece).encode())
                    some = True
                held.append(kept)
            if done["key"]:
                yield batch_of()
        if state is not None:
            close()
            yield batch_of()

    narrow = pieces.select(F.col(key).alias("key"), F.col(order).alias("order"), F.col(text).alias("text"), F.col(keep).alias("kept"))
    sorted_ = narrow.repartition("key").sortWithinPartitions("key", "order")
    return sorted_.mapInArrow(run, f"key {kind}, digest string, kept string")


def _illegal(rows: DataFrame) -> DataFrame:
    """(conv, illegal): neighbouring turns whose roles may not follow each other."""
    chunk = rows.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list(F.struct("place", F.left("role", F.lit(1)).alias("r")))).alias("rows")
    )
    chunk = materialize(chunk.select("conv", "block", F.col("rows.r").alias("roles")), "initials")
    both = _next(chunk, chunk, [F.element_at("roles", 1).alias("follows")], 1)
    whole = F.when(F.col("follows").isNull(), F.col("roles")).otherwise(F.concat("roles", F.array("follows")))
    both = both.select("conv", whole.alias("roles"))
    pairs = F.zip_with(F.slice("roles", 1, F.size("roles") - 1), F.slice("roles", 2, F.size("roles")), lambda x, y: F.concat(x, y))
    wrong = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))
    return both.groupBy("conv").agg(F.sum(F.when(F.size("roles") > 1, wrong).otherwise(0)).alias("illegal"))


def digest(original: DataFrame, df: DataFrame) -> DataFrame:
    """One row per conversation of ``original`` (conv): its figures after repairing the rows ``df`` (conv, turn, role, text).

    conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Without rows the figures are zero, the
    audit is empty and the digest that of an empty text. Rows with a null conv are one conversation.
    """
    rows = faults(df)
    chunks = plan(rows)
    pieces = repaired(rows, chunks)
    line = F.when(F.size("lines") > 0, F.array_join("lines", "\n"))
    read = materialize(pieces.select("conv", "block", line.alias("piece"), "audit"), "repaired")
    told = streamed(read, "conv", "block", "piece", "\n", "audit")
    turns = rows.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    letters = F.concat(F.array_join("edits", ""), F.col("tail"))
    count = lambda chars: F.length(letters) - F.length(F.translate(letters, chars, ""))
    stay = F.zip_with(F.split("codes", ""), "edits", lambda c, e: c.isin("S", "U", "A", "O") & (F.right(e, F.lit(1)) != "D"))
    cost = INSERT * count("ua") + REROLE * count("UA") + DELETE * count("D") + TRUNCATED * F.size(F.filter(stay, lambda x: x))
    costs = chunks.groupBy("conv").agg(F.sum(cost).alias("cost"))
    out = original.select("conv").distinct()
    for table in (turns, _illegal(rows), costs, told.withColumnRenamed("key", "conv")):
        other = table.withColumnRenamed("conv", "c")
        out = out.join(other, F.col("conv").eqNullSafe(F.col("c")), "left").drop("c")
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv",
        *[whole(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("kept", F.lit("")).alias("audit"),
        F.coalesce("digest", F.lit(empty)).alias("repaired_sha256"),
    )
