"""Conversation structure repair by a run-length dynamic programme.

A repaired conversation is empty or alternates user and assistant, ending with the
assistant, after at most one system row. The cheapest edits come from a min-plus dynamic
programme over four states (start, after system, after user, after assistant): each row's
symbol (class of its role, fault) has a 4 x 4 matrix of costs, in which insertions before
the row are closed over. Equal consecutive symbols are one run; the costs to go before a
run of length L are T**L times those after it, by the cached binary powers of T. Then the
choices are unrolled run by run, always the edit whose initial is least in ASCII among
the cheapest, which gives the least audit as costs to go cover all that follows.

How the work is spread: rows are sorted over the cluster by conversation and turn and cut
into ranges, so a conversation is one block or, where it crosses ranges, a few. Each block
is one matrix; of conversations with several blocks (at most two of them a range), the
matrices are composed from the end to get each block's costs to go, then its exit for
each entry state from the start. After that every block is unrolled alone, in parallel.
Texts are shuffled twice and never held together: a block's repaired text is streamed; the
digest of a conversation with several blocks, serial by nature, is streamed over them by
one task, in pieces of bounded size. Repeated texts are found by digest, with the smallest
place of each by a partial aggregate, so a very common text is one row a task.

Defined results: null roles and texts count as one space (so do nulls in the damage key);
null turns come first; rows of one turn go by role, then the first 64 characters of the
text, then its digest; rows alike in all are interchangeable. A role counts by its first
letter, and is otherwise kept as it is. Rows without a conversation id form one
conversation. Empty tables give no rows; other columns, whatever their names, are left
behind. Very long texts are streamed; very long conversations are many blocks.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from casebook.llm.common import stage
from casebook.operators.ranges import cut

SPACES = " \t\n\x0b\x0c\r"
CLASSES = "sua"  # others: class 3
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)  # faults; a symbol is 4 x class + fault
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
ROWS_AT_ONCE = 10_000
PIECE_CHARS = 1 << 20  # of repaired text handed on at a time

# ------------------------------------------------------------------ min-plus matrices


def _times(a, b):
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in range(4)), NEVER) for j in range(4)) for i in range(4))


def _apply(a, v):
    return tuple(min(min(a[i][k] + v[k] for k in range(4)), NEVER) for i in range(4))


IDENTITY = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))
TO_USER = {START, SYSTEM, ASSISTANT}  # states that a user row may follow
# any number of insertions: none, one, two (more never pay)
_ONE = tuple(tuple(0 if i == j else 2 if (i in TO_USER and j == USER) or (i == USER and j == ASSISTANT) else NEVER for j in range(4)) for i in range(4))
INSERTED = _times(_ONE, _ONE)


def edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of a row, in ASCII order."""
    kind, fault = divmod(symbol, 4)
    found = [("D", 3, state)]
    if fault in (FINE, TRUNCATED):
        extra = 1 if fault == TRUNCATED else 0
        kept = {0: SYSTEM if state == START else None, 1: USER if state in TO_USER else None, 2: ASSISTANT if state == USER else None}.get(kind)
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", 2 + extra, USER if state in TO_USER else ASSISTANT))
    return found


def _own(symbol: int):
    """The symbol that behaves alike: rows to be deleted are one, whatever their role."""
    return symbol if symbol % 4 in (FINE, TRUNCATED) else BLANK


def _one_row(symbol: int):
    """The transition of one row, insertions before it included."""
    costs = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, after in edits(symbol, state):
            costs[state][after] = min(costs[state][after], cost)
    return _times(INSERTED, tuple(map(tuple, costs)))


POWERS: dict[int, list] = {}  # per symbol the transitions of 1, 2, 4, 8, ... rows
CHOSEN: dict[tuple, tuple[str, int]] = {}  # few, as costs to go differ by little


def power(symbol: int, bit: int):
    known = POWERS.setdefault(symbol, [_one_row(symbol)])
    while len(known) <= bit:
        known.append(_times(known[-1], known[-1]))
    return known[bit]


def before_run(symbol: int, length: int, after):
    """Costs to go before ``length`` rows of one symbol, from those after them."""
    bit = 0
    while length:
        if length & 1:
            after = _apply(power(symbol, bit), after)
        length, bit = length >> 1, bit + 1
    return after


AT_END = _apply(INSERTED, (0, NEVER, NEVER, 0))  # costs to go after the last row


def runs(symbols: str) -> list[tuple[int, int]]:
    return [(s, sum(1 for _ in g)) for s, g in groupby(map(_own, map(ord, symbols)), key=lambda s: s)]


def block_matrix(symbols: str):
    out = IDENTITY
    for symbol, length in reversed(runs(symbols)):
        bit = 0
        while length:
            if length & 1:  # powers of one matrix commute
                out = _times(power(symbol, bit), out)
            length, bit = length >> 1, bit + 1
    return out


def _choose(symbol: int, state: int, after) -> tuple[str, int]:
    """Edits (insertions first) of one row and the next state; ``after``: costs to go
    less their smallest."""
    if (symbol, state, after) in CHOSEN:
        return CHOSEN[symbol, state, after]
    here, done, now = _apply(power(symbol, 0), after), "", state
    while not done or done[-1] == "I":
        options = [(name, after[to] + cost, to) for name, cost, to in edits(symbol, now)]
        into = USER if now in TO_USER else ASSISTANT
        options.append(("I", 2 + here[into], into))
        name, _, now = min((o for o in options if o[1] == here[now]), key=lambda o: o[0])
        done += name
    CHOSEN[symbol, state, after] = done, now
    return done, now


def _less(after):
    least = min(after)
    return tuple(c - least for c in after)


def unroll(symbols: str, state: int, after, last: bool) -> tuple[list[str], int]:
    """Each row's edits, from the entry state and the costs to go after the block; with
    ``last`` the insertions at the end as one more entry."""
    parts, ends = runs(symbols), [after]
    for symbol, length in reversed(parts):
        ends.append(before_run(symbol, length, ends[-1]))
    out = []
    for (symbol, length), end in zip(parts, ends[-2::-1], strict=True):
        within = [_less(end)]
        for _ in range(length - 1):
            within.append(_less(_apply(power(symbol, 0), within[-1])))
        for left in reversed(within):
            done, state = _choose(symbol, state, left)
            out.append(done)
    if last:
        done = ""
        while AT_END[state]:
            done, state = done + "I", USER if state in TO_USER else ASSISTANT
        out.append(done)
    return out, state


# ------------------------------------------------------------------ rows and their faults


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the contract's damage by
    crc32(conv_id:turn) % 20: 0 drops the row, 1 empties the text, 2 takes out its
    ``[.!?]``, 3 repeats the row, 4 makes it the user's."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    t = _clean(rows).withColumn("_what", F.crc32(key.cast("binary")) % 20).where(F.col("_what") != 0)
    text = F.when(F.col("_what") == 1, "").when(F.col("_what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_what") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(1), F.when(F.col("_what") == 3, 2).otherwise(1))
    return t.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_")).drop("_")


def _clean(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def _base_symbol() -> Column:
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(end == "", BLANK).when(F.substring(end, -1, 1).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    return (kind * 4 + fault).cast("int")


def ordered_rows(rows: DataFrame) -> DataFrame:
    """The rows in order, with place ``at``, range ``part``, their ``symbol`` without
    regard to duplicates, and the text's digest. Rows alike are split over ranges."""
    # straight from the source, so a row's number is the same whenever it is read
    t = _clean(rows).withColumn("nth", F.monotonically_increasing_id())
    t = t.withColumns({"head": F.substring("text", 1, 64), "digest": F.unhex(F.sha2(F.col("text"), 256)), "symbol": _base_symbol()})
    return cut(t, ["conv_id", "turn", "role", "head", "digest", "nth"], "conversations", "at", "part").drop("head", "nth")


def blocks_of(ordered: DataFrame) -> DataFrame:
    """One row for each conversation and range: conv_id, part, its first place ``block``, and the
    ``symbols`` of its rows in order, duplicates marked."""
    narrow = ordered.select("conv_id", "part", "at", "role", "digest", "symbol")
    # the first of rows alike, however many, is known by its place: the join has no hot key
    first = narrow.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    marked = narrow.select("conv_id", "part", "at", "symbol").join(first, "at", "left")
    symbol = F.when(F.col("first").isNull() & (F.col("symbol") % 4 != BLANK), F.col("symbol") - F.col("symbol") % 4 + DUPLICATE).otherwise(F.col("symbol"))
    letters = F.transform(F.array_sort(F.collect_list(F.struct("at", F.char(symbol + 65).alias("c")))), lambda x: x["c"])
    return marked.groupBy("conv_id", "part").agg(F.min("at").alias("block"), F.array_join(letters, "").alias("symbols"))


# symbols travel as letters, A = 0
def _codes(symbols: str) -> str:
    return "".join(chr(ord(c) - 65) for c in symbols)


# ------------------------------------------------------------------ blocks joined up


def _per_row(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` maps a row (as a dict) to any number of tuples."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)

    def run(batches):
        held = []
        for batch in batches:
            for row in batch.to_pylist():
                for out in function(row):
                    held.append(out)
                    if len(held) == ROWS_AT_ONCE:
                        yield table(held)
                        held = []
        yield table(held)

    return df.mapInArrow(run, schema)


def _several(blocks: DataFrame) -> DataFrame:
    """Blocks of conversations with more than one: block, nth (from 0), of, symbols,
    ``conv`` (the conversation's first block). At most two conversations a range cross it."""
    lists = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("block")).alias("all")).where(F.size("all") > 1)
    places = lists.select(F.posexplode("all").alias("nth", "block"), F.size("all").alias("of"), F.col("all")[0].alias("conv"))
    return blocks.join(places, "block").select("block", "conv", "nth", "of", "symbols")


def link(blocks: DataFrame) -> DataFrame:
    """``block, entry, after, last`` of the blocks of conversations that have several."""
    several = stage(_several(blocks), "conversations-several")
    matrix = _per_row(several, lambda r: [(r["conv"], r["nth"], r["block"], [c for line in block_matrix(_codes(r["symbols"])) for c in line])],
                      "conv bigint, nth int, block bigint, costs array<bigint>")
    chains = matrix.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("nth", "block", "costs"))).alias("chain"))

    def backwards(row):
        after = AT_END
        for link in reversed(row["chain"]):
            yield link["block"], list(after)
            after = _apply([link["costs"][i:i + 4] for i in range(0, 16, 4)], after)

    after = stage(several.join(_per_row(chains, backwards, "block bigint, after array<bigint>"), "block"), "conversations-after")
    exits = _per_row(after, lambda r: [(r["conv"], r["nth"], r["block"], [unroll(_codes(r["symbols"]), s, tuple(r["after"]), False)[1] for s in range(4)])],
                     "conv bigint, nth int, block bigint, exits array<int>")
    chains = exits.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("nth", "block", "exits"))).alias("chain"))

    def forwards(row):
        state = START
        for link in row["chain"]:
            yield link["block"], state
            state = link["exits"][state]

    entries = _per_row(chains, forwards, "block bigint, entry int")
    return after.join(entries, "block").select("block", "entry", "after", (F.col("nth") == F.col("of") - 1).alias("last"))


# ------------------------------------------------------------------ audits and texts


PRICE = {"K": 0, "R": 2, "D": 3, "I": 2}
LEGAL = {(0, 1), (1, 2), (2, 1)}  # classes of adjacent rows: su, ua, au


def plans(blocks: DataFrame) -> DataFrame:
    """One row a block: conv_id, part, block, whole (the conversation has no other), its
    audit, the edits of each row (``steps``), the state on entry, the counts of faults and
    of illegal neighbours, the cost, and the classes of its first and last row."""
    linked = link(blocks)

    def run(row):
        symbols, whole = _codes(row["symbols"]), row["entry"] is None
        entry, after, last = (START, AT_END, True) if whole else (row["entry"], tuple(row["after"]), row["last"])
        steps, _ = unroll(symbols, entry, after, last)
        counts = [sum(ord(s) % 4 == f for s in symbols) for f in (BLANK, DUPLICATE, TRUNCATED)]
        kinds = [ord(s) // 4 for s in symbols]
        illegal = sum(pair not in LEGAL for pair in zip(kinds, kinds[1:], strict=False))
        cost = sum(PRICE[e] for step in steps for e in step)
        cost += sum(ord(s) % 4 == TRUNCATED and step[-1] != "D" for s, step in zip(symbols, steps, strict=False))
        yield row["conv_id"], row["part"], row["block"], whole, "".join(steps), steps, row["symbols"], entry, *counts, illegal, cost, kinds[0], kinds[-1]

    schema = f"conv_id {_id_type(blocks)}, part bigint, block bigint, whole boolean, audit string, steps array<string>, symbols string, entry int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, first int, final int"
    return _per_row(blocks.join(linked, "block", "left"), run, schema)


def _id_type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _lines(row):
    """What becomes of a block: (conv_id, part, whole, place, order at the place, role,
    kept) for each row inserted, and each one kept (empty role: its own)."""
    state = row["entry"]
    symbols = _codes(row["symbols"])
    for i, step in enumerate(row["steps"]):
        for j, e in enumerate(step):
            if e == "D":
                continue
            if e == "K":
                state = next(to for name, _, to in edits(ord(symbols[i]), state) if name == "K")
                role = ""
            else:
                state = USER if state in TO_USER else ASSISTANT
                role = "user" if state == USER else "assistant"
            yield row["conv_id"], row["part"], row["whole"], row["block"] + i, j, role, e != "I"


def repaired_rows(ordered: DataFrame, planned: DataFrame) -> DataFrame:
    """The repaired conversations row by row: conv_id, part, whole, at, line, role, text.

    The rows of a block are in one partition, in order: what is to be done comes first at
    each place, then the old row, so one pass over both merges them."""
    told = _per_row(planned, _lines, f"conv_id {_id_type(planned)}, part bigint, whole boolean, at bigint, line int, role string, kept boolean")
    told = told.withColumn("text", F.lit(None).cast("string"))
    old = ordered.select("conv_id", "part", F.lit(None).cast("boolean").alias("whole"), "at", F.lit(None).cast("int").alias("line"), "role", F.lit(None).cast("boolean").alias("kept"), "text")
    both = told.unionByName(old).repartition("conv_id", "part").sortWithinPartitions("part", "conv_id", "at", F.col("line").asc_nulls_last())

    def run(batches):
        keep = None  # the order to keep the row that comes next
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["line"] is None:  # the old row, after its orders
                    if keep is not None and keep["at"] == row["at"]:
                        out.append((row["conv_id"], row["part"], keep["whole"], row["at"], keep["line"], keep["role"] or row["role"], row["text"]))
                    keep = None
                elif row["kept"]:
                    keep = row
                else:
                    out.append((row["conv_id"], row["part"], row["whole"], row["at"], row["line"], row["role"], ""))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

    schema = f"conv_id {_id_type(planned)}, part bigint, whole boolean, at bigint, line int, role string, text string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return both.mapInArrow(run, schema)


def _streamed(rows: DataFrame, schema: str) -> DataFrame:
    """``role:text`` of consecutive rows of a block, newline-joined: the digest of a whole
    conversation, or pieces of the text where the block is a part of one."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        out, now, held, chars, piece, digest = [], None, [], 0, 0, None

        def hand_on():  # a piece of text, or to the digest
            nonlocal held, chars, piece
            text = "\n".join(held)
            if now[2]:
                digest.update((("\n" if piece else "") + text).encode())
            else:
                out.append((now[0], now[1], piece, text, None))
            held, chars, piece = [], 0, piece + 1

        def close():
            if now is not None:
                hand_on()
                if now[2]:
                    out.append((now[0], now[1], 0, None, digest.hexdigest()))

        for batch in batches:
            for row in batch.to_pylist():
                if (row["conv_id"], row["part"], row["whole"]) != now:
                    close()
                    now, piece, digest = (row["conv_id"], row["part"], row["whole"]), 0, hashlib.sha256()
                elif chars >= PIECE_CHARS:
                    hand_on()
                line = f"{row['role']}:{row['text']}"
                held.append(line)
                chars += len(line)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)
            out.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def text_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of each repaired conversation with a row left."""
    schema = f"conv_id {_id_type(repaired)}, part bigint, piece int, text string, sha256 string"
    found = stage(_streamed(repaired, schema), "conversations-digests")
    pieces = found.where(F.col("sha256").isNull()).repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")

    def run(batches):
        now, digest, begun = None, None, False
        for batch in batches:
            out = []
            for conv, text in zip(batch.column("conv_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not begun or conv != now:
                    if begun:
                        out.append((now, digest.hexdigest()))
                    now, digest, begun = conv, hashlib.sha256(text.encode()), True
                else:
                    digest.update(b"\n" + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([now], arrow[0].type), pa.array([digest.hexdigest()])], schema=arrow)

    last = f"conv_id {_id_type(repaired)}, sha256 string"
    arrow = to_arrow_schema(StructType.fromDDL(last))
    return found.where(F.col("sha256").isNotNull()).select("conv_id", "sha256").unionByName(pieces.mapInArrow(run, last))


class Repair:
    """The steps of a repair as tables: ``rows`` in order, ``planned`` blocks, and
    :meth:`repaired`, the new rows."""

    def __init__(self, rows: DataFrame):
        self.rows = ordered_rows(rows)
        self.planned = stage(plans(stage(blocks_of(self.rows), "conversations-blocks")), "conversations-plans")

    def repaired(self) -> DataFrame:
        return repaired_rows(self.rows, self.planned)

    def summary(self) -> DataFrame:
        """A row for each conversation: conv_id, gaps, blank, duplicate, truncated,
        illegal, cost, audit."""
        ends = F.array_sort(F.collect_list(F.struct("block", "first", "final", "audit")))
        sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
        per = self.planned.groupBy("conv_id").agg(*sums, ends.alias("ends"))
        pairs = F.zip_with(F.expr("slice(ends, 1, size(ends) - 1)"), F.expr("slice(ends, 2, size(ends) - 1)"), lambda x, y: x["final"] * 4 + y["first"])
        across = F.size(F.filter(pairs, lambda p: ~p.isin(*[a * 4 + b for a, b in LEGAL])))
        audit = F.array_join(F.transform("ends", lambda x: x["audit"]), "")
        turns = self.rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("_")).groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
        per = per.select("conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + across).alias("illegal"), "cost", audit.alias("audit"))
        same = per["conv_id"].eqNullSafe(turns["conv_id"])
        return per.join(turns, same).select(per["conv_id"], F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repair_report(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """The summary of ``damaged`` with the digest of its repaired text, for every
    conversation of ``conversations``; one that has lost all rows gets zeros."""
    repair = Repair(damaged)
    every = conversations.select("conv_id").distinct()
    found, texts = repair.summary(), text_digests(repair.repaired())
    report = every.join(found, every["conv_id"].eqNullSafe(found["conv_id"]), "left").drop(found["conv_id"])
    report = report.join(texts, report["conv_id"].eqNullSafe(texts["conv_id"]), "left").drop(texts["conv_id"])
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return report.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(nothing)).alias("repaired_sha256"))


# The same report in DuckDB SQL: damage (its crc32 from a table of 256 entries), faults,
# costs to go row by row from the end, then the walk from the start.
SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) AS entries),
keyed AS (
  SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
         COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
dealt AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ord(k[i]) AS BIGINT))),
                         lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS what
  FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE what WHEN 4 THEN 'user' ELSE role END AS role,
         CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM dealt, generate_series(1, 2) AS g(copy) WHERE what <> 0 AND (copy = 1 OR what = 3)),
placed AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(text, 1, 64), sha256(text)) AS pos,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged),
judged AS (
  SELECT conv_id, turn, role, text, pos, left(role, 1) AS i,
         CASE WHEN bare = '' THEN 'b' WHEN ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         LAG(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM placed),
counts AS (
  SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (WHERE fault = 'b') AS blank,
         COUNT(*) FILTER (WHERE fault = 'd') AS duplicate, COUNT(*) FILTER (WHERE fault = 't') AS truncated,
         COUNT(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, MAX(pos) AS n
  FROM judged GROUP BY conv_id),
togo AS (  -- costs to go from each place: at the start, after system, user, assistant
  SELECT conv_id, n + 1 AS pos, CAST(0 AS BIGINT) AS v0, CAST(4 AS BIGINT) AS v1, CAST(2 AS BIGINT) AS v2, CAST(0 AS BIGINT) AS v3 FROM counts
  UNION ALL
  SELECT conv_id, pos, LEAST(e0, 2 + e2, 4 + e3), LEAST(e1, 2 + e2, 4 + e3), LEAST(e2, 2 + e3), LEAST(e3, 2 + e2) FROM (
    SELECT j.conv_id, j.pos,
           LEAST(v0 + 3, stay + v2 + 2, stay + CASE i WHEN 's' THEN v1 WHEN 'u' THEN v2 ELSE 1000000 END) AS e0,
           LEAST(v1 + 3, stay + v2 + 2, stay + CASE i WHEN 'u' THEN v2 ELSE 1000000 END) AS e1,
           LEAST(v2 + 3, stay + v3 + 2, stay + CASE i WHEN 'a' THEN v3 ELSE 1000000 END) AS e2,
           LEAST(v3 + 3, stay + v2 + 2, stay + CASE i WHEN 'u' THEN v2 ELSE 1000000 END) AS e3
    FROM togo t JOIN (SELECT *, CASE fault WHEN '' THEN 0 WHEN 't' THEN 1 ELSE 1000000 END AS stay FROM judged) j
      ON t.conv_id IS NOT DISTINCT FROM j.conv_id AND j.pos = t.pos - 1)),
costs AS (SELECT conv_id, pos, [v0, v1, v2, v3] AS v FROM togo),
steps AS (
  SELECT here.conv_id, here.pos, here.v AS here, after.v AS after, j.role, j.text, j.i, CASE j.fault WHEN '' THEN 0 WHEN 't' THEN 1 ELSE 1000000 END AS stay
  FROM costs here LEFT JOIN costs after ON here.conv_id IS NOT DISTINCT FROM after.conv_id AND after.pos = here.pos + 1
  LEFT JOIN judged j ON here.conv_id IS NOT DISTINCT FROM j.conv_id AND j.pos = here.pos),
walk AS (  -- states 1 to 4 as above; next: where a user's or assistant's row leads
  SELECT conv_id, CAST(1 AS BIGINT) AS pos, 1 AS state, '' AS audit, CAST(NULL AS VARCHAR) AS repaired FROM counts
  UNION ALL
  SELECT conv_id, pos + CASE edit WHEN 'I' THEN 0 ELSE 1 END,
         CASE edit WHEN 'D' THEN state WHEN 'K' THEN kept ELSE next END, audit || edit,
         CASE edit WHEN 'D' THEN repaired ELSE COALESCE(repaired || chr(10), '') ||
           CASE WHEN edit = 'K' THEN role ELSE CASE next WHEN 3 THEN 'user' ELSE 'assistant' END END || ':' || CASE edit WHEN 'I' THEN '' ELSE text END END
  FROM (
    SELECT *, CASE WHEN after IS NOT NULL AND after[state] + 3 = here[state] THEN 'D' WHEN here[next] + 2 = here[state] THEN 'I'
                   WHEN kept IS NOT NULL AND after[kept] + stay = here[state] THEN 'K' WHEN after[next] + 2 + stay = here[state] THEN 'R' END AS edit
    FROM (
      SELECT w.*, s.here, s.after, s.role, s.text, s.stay, CASE w.state WHEN 3 THEN 4 ELSE 3 END AS next,
             CASE WHEN s.i = 's' AND w.state = 1 THEN 2 WHEN s.i = 'u' AND w.state <> 3 THEN 3 WHEN s.i = 'a' AND w.state = 3 THEN 4 END AS kept
      FROM walk w JOIN steps s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.pos = s.pos))
  WHERE edit IS NOT NULL),
ended AS (
  SELECT w.conv_id, w.audit, w.repaired FROM walk w JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id
  JOIN costs s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.pos = w.pos WHERE w.pos = c.n + 1 AND s.v[w.state] = 0)
SELECT o.conv_id, COALESCE(c.gaps, 0) AS gaps, COALESCE(c.blank, 0) AS blank, COALESCE(c.duplicate, 0) AS duplicate, COALESCE(c.truncated, 0) AS truncated,
       COALESCE(c.illegal, 0) AS illegal, COALESCE(t.v[1], 0) AS cost, COALESCE(e.audit, '') AS audit, sha256(COALESCE(e.repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN costs t ON o.conv_id IS NOT DISTINCT FROM t.conv_id AND t.pos = 1
LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id"""
