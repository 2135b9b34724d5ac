"""Repair of conversation structure by lightest derivations.

The roles of a sound conversation read ``s?(ua)+`` or nothing.  Repair is a deduction over weighted items: the
item [i, q] says that the first i rows are settled and the roles so far have led to state q.  A hyperedge joins an item
with an edit of the next row, or with an inserted turn, to the next item, and its weight function adds the
costs and appends the edit's initial: neither makes a weight smaller, so it is superior, and an agenda that pops items by
(cost, audit) settles each at its lightest derivation once and for all.  The goal is an item of all rows in an accepting state.

A conversation streams through in chunks: the settled items at the end of one are the axioms of the next, and the audit they
share is put aside.  Comparing (cost, audit) stays right across chunks, as an audit that another one begins with is
cheaper by the insertions it lacks.

Rows travel without their texts for the derivation; texts are shuffled once, to be hashed in order
while they stream past the audit.  Nothing of a conversation but its audit is held.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import BLANKS, query, stored, table

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a.  Where a role's initial leads.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
ACCEPTING = (START, ASSISTANT)
#: The role that an inserted or reroled turn takes in each state, and where it leads.
NEXT_ROLE = {START: "user", SYSTEM: "user", ASSISTANT: "user", USER: "assistant"}
FREE = {q: STEPS[role[0]][q] for q, role in NEXT_ROLE.items()}
#: Faults of a row.
SOUND, BLANK, DUPLICATE, CUT = range(4)
CHUNK = 512
LEGAL = frozenset(("su", "ua", "au"))


def edits(state: int, initial: str, fault: int) -> Iterator[tuple[int, str, int]]:
    """Edits of a row in a state: cost, initial of the edit, state after it."""
    yield DELETE, "D", state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED if fault == CUT else 0
    kept = STEPS.get(initial, {}).get(state)
    if kept is not None:
        yield more, "K", kept
    yield REROLE + more, "R", FREE[state]


def derive(axioms: dict[int, tuple[int, str]], rows: list[tuple[str, int]], last: bool = True) -> dict[int, tuple[int, str]]:
    """Lightest (cost, audit) of the items after ``rows``: of the goal alone if ``last``, else of every state."""
    agenda = [(cost, audit, 0, state) for state, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    settled: set[tuple[int, int]] = set()
    ends: dict[int, tuple[int, str]] = {}
    n = len(rows)
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in settled:
            continue
        settled.add((i, state))
        if i == n:
            if not last:
                ends[state] = (cost, audit)
            elif state in ACCEPTING:
                return {state: (cost, audit)}
        if (i, FREE[state]) not in settled:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", i, FREE[state]))
        if i < n:
            for more, letter, after in edits(state, *rows[i]):
                if (i + 1, after) not in settled:
                    heapq.heappush(agenda, (cost + more, audit + letter, i + 1, after))
    return ends


class _Derivation:
    """The rows of one conversation as they stream in."""

    def __init__(self) -> None:
        self.items, self.done, self.rows = {START: (0, "")}, [], []
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.least = self.most = self.turn = self.initial = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn
            self.turns += 1
        self.rows.append((initial, fault))
        if len(self.rows) == CHUNK:
            ends = derive(self.items, self.rows, last=False)
            shared = os.path.commonprefix([audit for _, audit in ends.values()])
            self.done.append(shared)
            self.items = {state: (cost, audit[len(shared) :]) for state, (cost, audit) in ends.items()}
            self.rows = []

    def result(self) -> tuple:
        ((cost, audit),) = derive(self.items, self.rows).values()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, cost, "".join([*self.done, audit])


DERIVED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _derive_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DERIVED.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()]
    conv, now = None, None

    def batch_of(out: list) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    for batch in batches:
        out = []
        for of, turn, initial, fault, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "n"))):
            if now is None or of != conv:
                if now is not None:
                    out.append((conv, *now.result()))
                conv, now = of, _Derivation()
            now.add(turn, initial, fault)
            for _ in range(n - 1):
                now.add(turn, initial, BLANK if fault == BLANK else DUPLICATE)
        yield batch_of(out)
    if now is not None:
        yield batch_of([(conv, *now.result())])


class _Repaired:
    """Hash of a repaired conversation; its rows come in order after its audit."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.hash, self.first = audit, 0, START, hashlib.sha256(), True

    def _turn(self, role: str, text: bytes) -> None:
        self.hash.update((b"" if self.first else b"\n") + role.encode() + b":" + text)
        self.first = False
        self.state = STEPS[role[0]][self.state]

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._turn(NEXT_ROLE[self.state], b"")

    def row(self, role: str, text: bytes) -> None:
        self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            self._turn(role if letter == "K" else NEXT_ROLE[self.state], text)

    def digest(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


def _hash_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by conversation: its audit, then its rows."""
    conv, now = None, None

    def batch_of(out: list) -> pa.RecordBatch:
        columns = list(zip(*out)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], ["conv_id", "sha"])

    for batch in batches:
        out = []
        for of, audit, role, text, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "n"))):
            if audit is not None:
                if now is not None:
                    out.append((conv, now.digest()))
                conv, now = of, _Repaired(audit)
                continue
            for _ in range(n):
                now.row(role, text)
        yield batch_of(out)
    if now is not None:
        yield batch_of([(conv, now.digest())])


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the contract: ``conv_id, turn, role, text, n`` with n the copies of a row; dropped rows are gone.

    In the key, a role and a text, null is one space.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    read = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    return read.filter("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def repair(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text, n)`` to one row per conversation: faults, cost, audit and hash of the repair.

    Rows are ordered by turn, null first, then by a digest of role and text, so that copies are neighbours and the order is
    the same in every run.  ``n`` counts copies of a row.  A null conv_id is one more conversation.  A role is kept only
    if its initial is s, u or a.  One conversation is one task, since its hash is of all its texts in order,
    but it streams: memory holds its audit, not its rows.
    """
    ended = F.rtrim("text", F.lit(BLANKS))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    bare = rows.select(
        "conv_id", "turn", "digest", F.substring("role", 1, 1).alias("initial"), "n",
        F.when(ended == "", BLANK).when(~F.substring(ended, -1, 1).isin(".", "!", "?"), CUT).otherwise(SOUND).alias("flaw"),
    )
    bare = stored(bare.groupBy("conv_id", "turn", "digest", "initial", "flaw").agg(F.sum("n").alias("n")))
    seen = bare.groupBy(F.col("conv_id").alias("__conv"), F.col("digest").alias("__digest")).agg(
        F.bool_or(F.col("turn").isNull()).alias("__null"), F.min("turn").alias("__least")
    )
    marked = bare.join(seen, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("digest") == F.col("__digest")))
    again = F.col("turn").isNotNull() & (F.col("__null") | (F.col("turn") > F.col("__least")))
    fault = F.when(F.col("flaw") == BLANK, BLANK).when(again, DUPLICATE).otherwise(F.col("flaw"))
    marked = marked.select("conv_id", "turn", "digest", "initial", fault.alias("fault"), "n")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = marked.repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "digest")
    derived = stored(ordered.mapInArrow(_derive_stream, DERIVED))
    none = {"turn": "long", "digest": "binary", "role": "string", "text": "binary", "n": "long"}
    audits = derived.select("conv_id", F.lit(0).alias("kind"), "audit", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    texts = rows.select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "turn", "digest", "role", F.col("text").cast("binary").alias("text"), "n")
    stream = audits.unionByName(texts).repartition(parts, "conv_id").sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "digest")
    hashes = stream.mapInArrow(_hash_stream, "conv_id long, sha string").withColumnRenamed("conv_id", "__conv")
    return derived.join(hashes, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv").withColumnRenamed("sha", "repaired_sha256")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Every conv_id of the table with the repair of what the damage left of it; other columns are ignored."""
    found = repair(damaged(conversations)).withColumnRenamed("conv_id", "__conv")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


SQL = r"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce("text", ' ') as txt,
    encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')) as k
  from conversations),
crc as (
  select * exclude (k), xor(4294967295::bigint, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, octet_length(k) + 1), lambda i: ('0x' || hex(k)[2 * i - 1 : 2 * i])::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: xor(x // 2, 3988292384 * (x % 2))))) % 20 as d
  from keyed),
hurt as (
  select conv_id, turn, case d when 4 then 'user' else role end as role,
    case d when 1 then '' when 2 then translate(txt, '.!?', '') else txt end as txt, unnest(range(case d when 3 then 2 else 1 end)) as copy
  from crc where d <> 0),
marked as (
  select *, row_number() over w as i, sha256(length(role) || ':' || role || txt) as h,
    rtrim(txt, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as e
  from hurt window w as (partition by conv_id order by turn nulls first, sha256(length(role) || ':' || role || txt), copy)),
flawed as (
  select *, left(role, 1) as c, case when e = '' then 1
    when row_number() over (partition by conv_id, h order by i) > 1 then 2
    when right(e, 1) not in ('.', '!', '?') then 3 else 0 end as fault
  from marked),
pairs as (select *, lag(c) over (partition by conv_id order by i) || c as pair from flawed),
facts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from flawed f join pairs using (conv_id, turn, role, txt, copy, i, h, e, c, fault) group by conv_id),
arcs as (  -- an edit of a row, after no or one inserted turn: from state, to state, cost, letters
  select conv_id, i, q, 5 * ins + coalesce(cost, 0) as cost, repeat('I', ins) || letter as letters, to_
  from flawed f, (values (0), (1)) t(ins), (values (0), (1), (2), (3)) s(q),
    lateral (select case when ins = 0 then q when q = 2 then 3 else 2 end as m),
    lateral (values
      ('D', 2, m), ('R', case when fault in (1, 2) then null else 1 + case fault when 3 then 5 else 0 end end, case m when 2 then 3 else 2 end),
      ('K', case when fault in (1, 2) or not (c = 's' and m = 0 or c = 'u' and m <> 2 or c = 'a' and m = 2) then null else case fault when 3 then 5 else 0 end end,
       case c when 's' then 1 when 'u' then 2 else 3 end)) e(letter, cost, to_)
  where cost is not null),
walk as (
  select conv_id, 0::bigint as i, 0 as q, 0::bigint as cost, '' as audit from facts
  union all
  select conv_id, i, q, best.cost, best.audit from (
    select w.conv_id, a.i, a.to_ as q, min({'cost': (w.cost + a.cost)::bigint, 'audit': w.audit || a.letters}) as best
    from walk w join arcs a on w.conv_id = a.conv_id and a.i = w.i + 1 and a.q = w.q group by all)),
goal as (
  select f.conv_id, min({'cost': w.cost + case q when 2 then 5 else 0 end, 'audit': w.audit || case q when 2 then 'I' else '' end}) as best
  from facts f join walk w on w.conv_id = f.conv_id and w.i = f.n where q <> 1 group by f.conv_id),
letters as (
  select conv_id, best.audit as audit, unnest(range(1, length(best.audit) + 1)) as p from goal),
steps as (
  select conv_id, p, audit[p] as letter, count(*) filter (audit[p] <> 'I') over (partition by conv_id order by p) as i from letters),
said as (
  select s.conv_id, s.p, letter, case letter when 'I' then '' else txt end as txt, role, c,
    row_number() over (partition by s.conv_id order by s.p) as place, max((letter = 'K' and c = 's')::int) over (partition by s.conv_id) as led
  from steps s left join flawed f on f.conv_id = s.conv_id and f.i = s.i and letter <> 'I' where letter <> 'D'),
told as (
  select conv_id, string_agg(case letter when 'K' then role else case (place - led) % 2 when 1 then 'user' else 'assistant' end end || ':' || txt, chr(10) order by place) as t
  from said group by conv_id)
select a.conv_id, coalesce(f.gaps, 0)::bigint as gaps, coalesce(f.blank, 0)::bigint as blank, coalesce(f.duplicate, 0)::bigint as duplicate,
  coalesce(f.truncated, 0)::bigint as truncated, coalesce(f.illegal, 0)::bigint as illegal, coalesce(best.cost, 0)::bigint as cost,
  coalesce(best.audit, '') as audit, sha256(coalesce(t, '')) as repaired_sha256
from (select distinct conv_id from conversations) a left join facts f on f.conv_id = a.conv_id left join goal g on g.conv_id = a.conv_id
  left join told on told.conv_id = a.conv_id
"""


@query(SQL)
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
