"""Repair of conversation structure by a parallel Viterbi search whose chunks converge in rank."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import add_columns
from tidemark.operators.ranking import with_position
from tidemark.shared import new_folder

#: Rows of a conversation that one task searches at a time.
CHUNK_ROWS = 1 << 14

# --- fixed values: costs of edits, and the form that role initials must have: (s?(ua)+)? ---
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
#: States: nothing yet, after s, after u, after a. ``NEXT`` is where an accepted u or a leads to, ``WANTED`` which of them it is.
START, DONE = 0, (0, 3)
NEXT, WANTED = (2, 2, 3, 2), "uuau"
# --------------------------------------------------------------------------------------------

#: Codes of rows: the role's initial, in upper case if the row is truncated, or ``x`` for a row that has to be deleted.
MUST_GO = "x"

Vector = tuple[int, ...]
ACCEPT: Vector = (0, 2 * INSERT, INSERT, 0)
"""Costs of ending from each state, by insertions alone."""


def _options(state: int, code: str) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row."""
    out = [("D", DELETE, state)]
    if code != MUST_GO:
        more, role = (TRUNCATED if code.isupper() else 0), code.lower()
        if role == WANTED[state]:
            out.append(("K", more, NEXT[state]))
        elif role == "s" and state == START:
            out.append(("K", more, 1))
        out.append(("R", REROLE + more, NEXT[state]))
    return out


@lru_cache(maxsize=1 << 16)
def before_row(after: Vector, code: str) -> tuple[Vector, int]:
    """Cost vector before a row, less its least entry, and that entry."""
    costs = [min(cost + after[then] for _, cost, then in _options(state, code)) for state in range(4)]
    closed = [min(costs[s], INSERT + costs[NEXT[s]], 2 * INSERT + costs[NEXT[NEXT[s]]]) for s in range(4)]
    least = min(closed)
    return tuple(c - least for c in closed), least


def vectors_before(codes: str, after: Vector) -> list[Vector]:
    """The vectors before each row of a chunk and after its last, each but for a constant."""
    out = [after]
    for code in reversed(codes):
        after, _ = before_row(after, code)
        out.append(after)
    out.reverse()
    return out


@lru_cache(maxsize=1 << 16)
def traced_row(state: int, code: str, after: Vector) -> tuple[str, str, int]:
    """(roles inserted before a row, its edit, next state) of the least audit among the cheapest ones."""
    before, least = before_row(after, code)
    inserted = ""
    while True:
        edits = {edit: then for edit, cost, then in _options(state, code) if cost + after[then] == before[state] + least}
        if "D" in edits:
            return inserted, "D", edits["D"]
        if INSERT + before[NEXT[state]] == before[state]:
            inserted, state = inserted + WANTED[state], NEXT[state]
            continue
        edit = min(edits)
        return inserted, edit, edits[edit]


def trace(codes: str, after: Vector, state: int) -> tuple[list[tuple[str, str, int]], int]:
    """The rows of a chunk traced from ``state``, and the state after them."""
    out = []
    for code, costs in zip(codes, vectors_before(codes, after)[1:]):
        out.append(traced_row(state, code, costs))
        state = out[-1][2]
    return out, state


def ending(state: int) -> str:
    """Roles that have to be inserted at the end."""
    out = ""
    while state not in DONE:
        out, state = out + WANTED[state], NEXT[state]
    return out


def name(vector: Vector) -> str:
    return ",".join(map(str, vector))


def vector(name_: str) -> Vector:
    return tuple(map(int, name_.split(",")))


# --- Spark steps -------------------------------------------------------------------------------

_TABLE = "array<struct<after:string,before:string>>"


def _speculate(chunks: DataFrame) -> DataFrame:
    """Add to the ``table`` of each chunk the vectors ``missing`` from it: cost vector after the chunk -> before it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = []
            for row in batch.select(["codes", "table", "missing"]).to_pylist():
                for after in row["missing"]:
                    row["table"].append({"after": after, "before": name(vectors_before(row["codes"], vector(after))[0])})
                tables.append(row["table"])
            yield batch.select(["conv", "chunk", "codes"]).append_column("table", pa.array(tables, batch.schema.field("table").type))

    return chunks.select("conv", "chunk", "codes", "table", "missing").mapInArrow(work, f"conv string, chunk long, codes string, table {_TABLE}")


def _converged(chunks: DataFrame) -> DataFrame:
    """Tables of all chunks that hold every vector that can come from the chunk after.

    All chunks start from the vector after the last row. Each pass gathers what came out of the chunks of a conversation;
    vectors count as equal if they differ by a constant only, so there are few. A chunk runs again for those it has not
    had. Passes end when no chunk has one to run for; how many there are doesn't depend on the number of chunks.
    """
    spark = chunks.sparkSession
    tables = _speculate(chunks.select("conv", "chunk", "codes", F.array().cast(_TABLE).alias("table"), F.array(F.lit(name(ACCEPT))).alias("missing")))
    while True:
        folder = new_folder(spark, "viterbi-pass")
        tables.write.parquet(folder)
        tables = spark.read.parquet(folder)
        # vectors have small entries that differ by the costs of a few edits, so a conversation has a bounded set of them
        came = tables.select("conv", F.explode("table.before").alias("before")).distinct().groupBy("conv").agg(F.collect_list("before").alias("came"))
        wanted = tables.join(came, "conv").withColumn("missing", F.array_except("came", F.col("table.after")))
        if not wanted.where(F.size("missing") > 0).take(1):
            return tables
        tables = _speculate(wanted)


def _before(table: Column, after: Column) -> Column:
    return F.filter(table, lambda x: x["after"] == after)[0]["before"]


def _stitched(tables: DataFrame) -> DataFrame:
    """(conv, chunk, last, after): the true vector after each chunk, and the last chunk's number.

    Chunk tables are composed by doubling: after k rounds a table leads over 2^k chunks.
    """
    spark = tables.sparkSession
    last = tables.groupBy("conv").agg(F.max("chunk").alias("last"))
    span = tables.join(last, "conv").select("conv", "chunk", "last", "table")
    most = span.agg(F.max("last")).first()[0] or 0
    step = 1
    while step <= most:
        folder = new_folder(spark, "viterbi-spans")
        ahead = span.select("conv", (F.col("chunk") - step).alias("chunk"), F.col("table").alias("ahead"))
        joined = span.join(ahead, ["conv", "chunk"], "left")
        both = F.transform("ahead", lambda x: F.struct(x["after"].alias("after"), _before(F.col("table"), x["before"]).alias("before")))
        joined.select("conv", "chunk", "last", F.when(F.col("ahead").isNull(), F.col("table")).otherwise(both).alias("table")).write.parquet(folder)
        span = spark.read.parquet(folder)
        step *= 2
    following = span.select("conv", (F.col("chunk") - 1).alias("chunk"), _before(F.col("table"), F.lit(name(ACCEPT))).alias("after"))
    after = F.coalesce("after", F.lit(name(ACCEPT))).alias("after")
    return span.select("conv", "chunk", "last").join(following, ["conv", "chunk"], "left").select("conv", "chunk", "last", after)


def _entry_states(known: DataFrame) -> DataFrame:
    """(conv, chunk, state): where the cheapest audit with the least letters enters each chunk."""
    spark = known.sparkSession

    def work():
        return lambda part: {"leads": [[trace(c, vector(a), s)[1] for s in range(4)] for c, a in zip(part["codes"], part["after"])]}

    leads = add_columns(known, ["conv", "chunk", "last"], ["codes", "after"], work, {"leads": "array<int>"})
    folder = new_folder(spark, "viterbi-states")
    leads.write.parquet(folder)
    span = spark.read.parquet(folder)
    most = span.agg(F.max("last")).first()[0] or 0
    step = 1
    while step <= most:
        folder = new_folder(spark, "viterbi-leads")
        behind = span.select("conv", (F.col("chunk") + step).alias("chunk"), F.col("leads").alias("behind"))
        joined = span.join(behind, ["conv", "chunk"], "left")
        both = F.when(F.col("behind").isNull(), F.col("leads")).otherwise(F.transform("behind", lambda s: F.get("leads", s)))
        joined.select("conv", "chunk", "last", both.alias("leads")).write.parquet(folder)
        span = spark.read.parquet(folder)
        step *= 2
    return span.select("conv", (F.col("chunk") + 1).alias("chunk"), F.get("leads", F.lit(START)).alias("state"))


def cheapest_audits(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cheapest edits of conversations given as (conv, chunk, codes), chunks counted from 0.

    Returns (conv, chunk, audit, edits), where ``edits`` has "inserted roles,edit,new role" for each row of the chunk and one more at
    the end of a conversation, and (conv, cost). Conversations of one chunk take no further pass.
    """
    spark = chunks.sparkSession
    more = chunks.where("chunk > 0").select("conv").distinct()
    long_, short = chunks.join(more, "conv", "left_semi"), chunks.join(more, "conv", "left_anti")
    folder = new_folder(spark, "viterbi-entries")
    alone = short.select("conv", "chunk", "codes", F.lit(name(ACCEPT)).alias("after"), F.lit(START).alias("state"), F.lit(True).alias("ends"))
    if chunks.where("chunk > 0").take(1):
        tables = _converged(long_)
        stitched = _stitched(tables)
        known = tables.select("conv", "chunk", "codes").join(stitched, ["conv", "chunk"])
        entries = known.join(_entry_states(known), ["conv", "chunk"], "left")
        entered = entries.select("conv", "chunk", "codes", "after", F.coalesce("state", F.lit(START)).alias("state"), (F.col("chunk") == F.col("last")).alias("ends"))
        alone = alone.unionByName(entered)
    alone.write.parquet(folder)

    def work():
        def one(codes, after, state, ends):
            rows, state = trace(codes, vector(after), state)
            edits, letters, cost = [], [], 0
            for code, (inserted, edit, then) in zip(codes, rows):
                role = ROLES[WANTED[2] if then == 3 else WANTED[3]]
                edits.append(f"{';'.join(ROLES[x] for x in inserted)},{edit},{role if edit == 'R' else ''}")
                letters.append("I" * len(inserted) + edit)
                cost += INSERT * len(inserted) + {"D": DELETE, "K": 0, "R": REROLE}[edit] + TRUNCATED * (edit != "D" and code.isupper())
            if ends:
                inserted = ending(state)
                edits.append(f"{';'.join(ROLES[x] for x in inserted)},,")
                letters.append("I" * len(inserted))
                cost += INSERT * len(inserted)
            return edits, "".join(letters), cost

        def step(part):
            found = [one(*x) for x in zip(part["codes"], part["after"], part["state"], part["ends"])]
            return {"edits": [e for e, _, _ in found], "audit": [a for _, a, _ in found], "cost": [c for _, _, c in found]}

        return step

    traced = new_folder(spark, "viterbi-edits")
    entries = spark.read.parquet(folder)
    add_columns(entries, ["conv", "chunk"], ["codes", "after", "state", "ends"], work, {"edits": "array<string>", "audit": "string", "cost": "long"}).write.parquet(traced)
    found = spark.read.parquet(traced)
    return found.select("conv", "chunk", "audit", "edits"), found.groupBy("conv").agg(F.sum("cost").alias("cost"))


_SPACES = " \t\n\x0b\x0c\r"


def row_faults(placed: DataFrame) -> DataFrame:
    """Rows (conv, position, role, text) with ``fault``: blank, duplicate (seen earlier in the conversation), truncated, or null."""
    key = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    keyed = placed.withColumn("key", key)
    first = keyed.groupBy("conv", "key").agg(F.min("position").alias("first"))
    bare = F.rtrim(F.col("text"), F.lit(_SPACES))
    fault = F.when(bare == "", "blank").when(F.col("position") > F.col("first"), "duplicate").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    return keyed.join(first, ["conv", "key"]).withColumn("fault", fault).drop("key", "first")


def row_codes(faulty: DataFrame) -> DataFrame:
    """(conv, chunk, codes and raw initials of up to ``CHUNK_ROWS`` rows in order)."""
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    rows = faulty.select("conv", F.floor((F.col("position") - 1) / CHUNK_ROWS).alias("chunk"), F.struct("position", code.alias("code"), known.alias("role")).alias("r"))
    ordered = rows.groupBy("conv", "chunk").agg(F.array_sort(F.collect_list("r")).alias("r"))  # at most CHUNK_ROWS small structs
    return ordered.select("conv", "chunk", F.array_join("r.code", "").alias("codes"), F.array_join("r.role", "").alias("initials"))


def illegal_pairs(codes: DataFrame) -> DataFrame:
    """(conv, illegal): neighbours whose initials are no legal pair, within chunks and over their borders."""
    inside = F.length("initials") - 1 - F.regexp_count("initials", F.lit(f"(?={'|'.join(LEGAL_PAIRS)})"))
    ends = codes.select("conv", "chunk", F.substring("initials", 1, 1).alias("head"), F.substring("initials", -1, 1).alias("tail"), inside.alias("inside"))
    before = ends.select("conv", (F.col("chunk") + 1).alias("chunk"), F.col("tail").alias("before"))
    border = F.col("before").isNotNull() & ~F.concat("before", "head").isin(*LEGAL_PAIRS)
    return ends.join(before, ["conv", "chunk"], "left").groupBy("conv").agg(F.sum(F.col("inside") + border.cast("int")).cast("long").alias("illegal"))


def repaired_lines(faulty: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, position, role, text) of the repaired conversations in order of ``position`` and ``place``."""
    edits = audits.select("conv", "chunk", F.posexplode("edits").alias("at", "edit"))
    edits = edits.select("conv", (F.col("chunk") * CHUNK_ROWS + F.col("at") + 1).alias("position"), F.split("edit", ",").alias("e"))
    both = edits.join(faulty.select("conv", "position", "role", "text"), ["conv", "position"], "left")
    line = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    inserted = F.transform(F.filter(F.split(F.col("e")[0], ";"), lambda x: x != ""), lambda x: line(x, F.lit("")))
    role = F.when(F.col("e")[1] == "R", F.col("e")[2]).otherwise(F.col("role"))
    kept = F.filter(F.array(line(role, F.col("text"))), lambda x: F.col("e")[1].isin("K", "R"))
    return both.select("conv", "position", F.posexplode(F.concat(inserted, kept)).alias("place", "line")).select("conv", "position", "place", "line.role", "line.text")


def digests(lines: DataFrame) -> DataFrame:
    """(conv, sha): SHA-256 of the ``role:text`` lines, newline-joined. A hash goes over its text in order, so the rows of a
    conversation stream through one task, which holds none of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or number != conv:
                    if state is not None:
                        out[0].append(conv)
                        out[1].append(state.hexdigest())
                    conv, state = number, hashlib.sha256(text)
                else:
                    state.update(b"\n" + text)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string())], names=["conv", "sha"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.string()), pa.array([state.hexdigest()])], names=["conv", "sha"])

    ordered = lines.repartition("conv").sortWithinPartitions("conv", "position", "place")
    return ordered.select("conv", F.concat_ws(":", "role", "text").cast("binary").alias("line")).mapInArrow(run, "conv string, sha string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults planted by the CRC-32 of ``conv_id:turn``; a null counts as one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", text("conv_id"), text("turn"))) % 20
    rows = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    new_text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    new_role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", new_role.alias("role"), new_text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Faults, cheapest edits and repaired rows of conversations (conv_id, turn, role, text), none of these columns null but the first two.

    Rows count in the order of turn (null first), then role and text, so that equal rows are neighbours. The first frame has a row for
    each conversation, by its ``conversation_key`` ``conv``, with ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost`` and ``audit``; the second one the repaired rows: ``conv``,
    ``position`` and ``place`` (their order), ``role``, ``text``.

    A conversation may be of any length: its rows get their places by a range shuffle, are cut into chunks of ``CHUNK_ROWS`` codes, and no
    task holds more than a chunk of them (its audit, which is one value, is joined at the end). Null ids are one conversation. An
    empty text or a very long one is a text like others, other columns are not read, an empty table gives empty results.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, "conversation-rows")
    rows.select("conv_id", "turn", "role", "text").write.parquet(folder)
    whole = spark.read.parquet(folder)
    places = with_position(whole, ["turn", "role", "text"], within=["conv_id"], copies=True)
    numbered = new_folder(spark, "conversation-places")
    places.select(*whole.columns, "position", conversation_key("conv_id").alias("conv")).write.parquet(numbered)
    faults = new_folder(spark, "conversation-faults")
    row_faults(spark.read.parquet(numbered)).write.parquet(faults)
    faulty = spark.read.parquet(faults)
    coded = new_folder(spark, "conversation-codes")
    row_codes(faulty).write.parquet(coded)
    codes = spark.read.parquet(coded)
    audits, costs = cheapest_audits(codes.select("conv", "chunk", "codes"))
    count = lambda fault: F.count_if(F.coalesce(F.col("fault") == fault, F.lit(False))).alias(fault)
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = faulty.groupBy("conv").agg(F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"), count("blank"), count("duplicate"), count("truncated"))
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "")
    joined = audits.groupBy("conv").agg(audit.alias("audit"))
    report = counts.join(illegal_pairs(codes), "conv").join(costs, "conv").join(joined, "conv")
    return report, repaired_lines(faulty, audits)


def conversation_key(id_column: str) -> Column:
    """A text for each conversation that is never null, whatever the type of its id."""
    return F.coalesce(F.concat(F.lit("="), F.col(id_column).cast("string")), F.lit(""))
