"""Repair of the structure of conversations: cheapest edits, and of equally cheap ones the least in writing.

A repair keeps, reroles, deletes or inserts turns so that the initials of the roles read
(s?(ua)+)?. Its states are: nothing yet (0), after s (1), after u (2), after a (3). The audit
is the initials of the edits in order.

* Rows are dealt by ranges of (conversation, turn, role, digest of the text), so a conversation of a third of all
  rows is cut in blocks of many tasks. A block is a row of its own: one byte for each turn.
* Each block's cost from every state to every other one is a 4 x 4 table. The tables of conversations that
  have several blocks, a few numbers for each block, meet, and give the cost from each block's end to the end of all.
* With that, a backward pass inside every block gives each place's cost to the end, and the arcs that lie
  on cheapest paths. These arcs are ranked by their first 1, 2, 4, 8 ... letters of the audit: a rank
  of twice the length is that of the pair (rank here, rank at the doubled pointer). At each place the
  arc of least rank is the way on; a path is read by its doubled pointers, all its letters at once. Arcs out of one
  place have different letters, so a least path is unique, and what lies behind a block can't change it.
* Texts are shuffled once, behind their conversation's audit, and hashed as they stream past: a digest can't be taken in
  parts, so a conversation streams through one task, which holds its audit and a batch of rows.

Damage and faults are as in `damaged` and `faults`. Nulls and odd input: a null role or text counts as one blank, a
null turn or conversation as a blank in the damage's key; a null turn comes first; null conv_id is a
conversation of its own; equal turns follow by role and a digest of the text; rows that repeat are
duplicates; a conversation of which no row is left has zeros and an empty audit; an empty table gives an
empty result; other columns are not looked at. Texts and conversations may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import common

DELETE, INSERT, REROLE, PENALTY = 2, 5, 1, 5
#: Letters of the edits, in the order of their ASCII codes.
LETTERS = b"DIKR"
D, I, K, R = range(4)
#: The state behind an inserted or reroled turn, which is the only one that goes on from each state.
NEXT = np.array([2, 2, 3, 2])
INSERTED = [b"user:", b"user:", b"assistant:", b"user:"]
FAR = np.int64(1) << 40
#: What is left from each state at the end of all turns, by insertions.
AT_END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
#: Turns of a block, at most, and of a step through several small ones, about.
BLOCK = 1 << 16
#: Codes of a turn in a block: the role's initial, and what its fault demands.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER, MUST_GO, CUT_OFF = 3, 4, 8


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with `fault` (0 to 19) and `copies`, after the damage that crc32 of `conv_id:turn` picks: 0 drops the row, 1
    empties the text, 2 takes its `.!?`, 3 repeats it, 4 sets the role user."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        (F.crc32(key.cast("binary")) % 20).cast("int").alias("fault"),
    )
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("copies"),
    )


def digest(role: Column, text: Column) -> Column:
    """Of role and text together: what tells rows of a conversation apart."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def faults(rows: DataFrame) -> DataFrame:
    """Damaged rows without their texts, in ranges of their order: place, conv_id, turn, digest, code, live. Staged."""
    last = r"[^\x20\x09-\x0D][\x20\x09-\x0D]*\z"
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), MUST_GO).when(
        ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT_OFF
    )
    slim = rows.select(
        "conv_id", "turn", "role", digest(F.col("role"), F.col("text")).alias("digest"),
        (role + F.coalesce(fault, F.lit(0))).cast("int").alias("code"), (F.col("copies") > 0).alias("live"),
        F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))).alias("copy"),
    )
    slim = slim.withColumn("place", F.monotonically_increasing_id())
    slim = common.stage(slim, "turns")
    order = ["conv_id", "turn", "role", "digest", "place"]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select(
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
        "conv_id", "turn", "digest", "code", "live",
    )
    dealt = common.stage(dealt, "turns-dealt")
    common.unstage(slim)
    return dealt


def with_duplicates(dealt: DataFrame) -> DataFrame:
    """The rows with `again`: an earlier live row of the conversation has the same role and text. Only the first place of
    what occurs more than once is joined back, so no group of equal rows meets in one task."""
    live = dealt.filter("live")
    firsts = live.groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1").select(F.col("conv_id").alias("of"), F.col("digest").alias("same"), "first")
    joined = dealt.join(firsts, dealt["conv_id"].eqNullSafe(firsts["of"]) & (dealt["digest"] == firsts["same"]), "left")
    again = F.col("live") & F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    return joined.select("part", "place", "conv_id", "turn", "code", "live", again.alias("again"))


BLOCKS = (
    "conv_id long, begin long, codes binary, costs array<long>, low long, high long, turns long, "
    "first_turn long, last_turn long, first_role int, last_role int, blank long, duplicate long, truncated long, illegal long"
)
LEGAL = np.zeros((4, 4), bool)
LEGAL[0, 1] = LEGAL[1, 2] = LEGAL[2, 1] = True


def moves(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For turns (any shape) and each state: cost of keeping, state behind it, and what keeping or reroling costs besides."""
    role, state = codes[..., None] & 3, np.arange(4)
    fits = ((role == 0) & (state == 0)) | ((role == 1) & (state != 2)) | ((role == 2) & (state == 2))
    besides = np.where(codes & MUST_GO, FAR, np.where(codes & CUT_OFF, PENALTY, 0))[..., None]
    keep = np.where(fits, besides, FAR)
    behind = np.where(role == 0, 1, NEXT[state])
    return keep, behind, np.broadcast_to(besides + REROLE, keep.shape)


def step_back(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs to the end before a turn of each row, from those behind it; `after` is (rows, 4, ...)."""
    keep, behind, rerole = moves(codes)
    extra = (1,) * (after.ndim - 2)
    rows = np.arange(len(codes))[:, None]
    best = np.minimum(DELETE + after, keep.reshape(*keep.shape, *extra) + after[rows, behind])
    best = np.minimum(best, rerole.reshape(*rerole.shape, *extra) + after[:, NEXT])
    return with_insertions(best)


def with_insertions(cost: np.ndarray) -> np.ndarray:
    """Costs at a place, where turns may be inserted first: two in a row lead back, so one from u or a, two from others."""
    out = cost.copy()
    out[:, 2] = np.minimum(cost[:, 2], INSERT + cost[:, 3])
    out[:, 3] = np.minimum(cost[:, 3], INSERT + cost[:, 2])
    for state in (0, 1):
        out[:, state] = np.minimum(cost[:, state], INSERT + out[:, 2])
    return out


def in_step(blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks longest first, side by side: their order, their lengths, and the number longer than each t."""
    length = np.array([len(b) for b in blocks], np.int64)
    order = np.argsort(-length, kind="stable")
    alive = len(length) - np.searchsorted(np.sort(length), np.arange(length.max(initial=0)), "right")
    return order, length, alive


def tables(blocks: list[np.ndarray]) -> np.ndarray:
    """For each block the 4 x 4 costs from a state before it to one behind it."""
    out = np.full((len(blocks), 4, 4), FAR)
    out[:, range(4), range(4)] = 0
    order, length, alive = in_step(blocks)
    for back in range(len(alive)):
        rows = order[: alive[back]]
        codes = np.array([blocks[r][length[r] - 1 - back] for r in rows])
        out[rows] = np.minimum(step_back(codes, out[rows]), FAR)
    return out


def block_rows(dealt: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each `block` turns, at most, of a conversation in a range of the order. Staged."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        carry: pa.Table | None = None
        for b in batches:
            rows = pa.Table.from_batches([b])
            rows = pa.concat_tables([carry, rows]).combine_chunks() if carry is not None else rows
            if not rows.num_rows:
                continue
            first = starts(rows)
            held.extend(cut(rows, first))
            carry = rows.slice(first[-1])
            while sum(len(h[2]) for h in held) >= block or len(held) >= 4096:
                yield packed(held)
                held = []
        if carry is not None:
            held.extend(cut(carry, [0, carry.num_rows]))
        if held:
            yield packed(held)

    def starts(rows: pa.Table) -> np.ndarray:
        conv = rows["conv_id"].combine_chunks()
        none, conv = conv.is_null().to_numpy(False), conv.fill_null(0).to_numpy()
        part = rows["part"].to_numpy()
        new = (conv[1:] != conv[:-1]) | (none[1:] != none[:-1]) | (part[1:] != part[:-1])
        run = np.concatenate([[0], np.flatnonzero(new) + 1])
        at = np.arange(len(conv))
        return np.flatnonzero((at - np.repeat(run, np.diff(np.append(run, len(conv))))) % block == 0)

    def cut(rows: pa.Table, bounds) -> Iterator[tuple]:
        conv = rows["conv_id"].to_pylist()
        turn = rows["turn"].combine_chunks()
        given, turn = turn.is_valid().to_numpy(False), turn.fill_null(0).to_numpy()
        begin, codes, live, again = (rows[c].to_numpy() for c in ("place", "code", "live", "again"))
        blank, role = codes & MUST_GO > 0, codes & 3
        duplicate = again & ~blank
        codes = np.where(duplicate, role | MUST_GO, codes).astype(np.uint8)
        pick = lambda x, k: int(x[k]) if len(x) else None
        for x, y in zip(bounds, bounds[1:], strict=False):
            on = slice(x, y) if live[x:y].all() else x + np.flatnonzero(live[x:y])
            turns, roles, code = turn[on][given[on]], role[on], codes[on]
            distinct = int((np.diff(turns) != 0).sum()) + 1 if len(turns) else 0
            counts = [blank[on], duplicate[on], code & CUT_OFF > 0, ~LEGAL[roles[:-1], roles[1:]]]
            low, high = pick(turns, 0), pick(turns, -1)
            yield (
                conv[x], int(begin[x]), code, low, high, distinct, low, high, pick(roles, 0), pick(roles, -1),
                *[int(c.sum()) for c in counts],
            )

    def packed(held: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        codes = list(columns[2])
        columns[2] = [c.tobytes() for c in codes]
        columns.insert(3, tables(codes).reshape(len(codes), 16).tolist())
        return batch_of(columns, BLOCKS)

    # The turns of a range stay together and in order; ranges are as small as Spark's partitions.
    in_order = with_duplicates(dealt).repartition("part").sortWithinPartitions("part", "place")
    return common.stage(in_order.mapInArrow(task, BLOCKS), "blocks")


def batch_of(columns, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    arrays = [pa.array(c, KINDS[k]) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}


def ends(blocks: DataFrame) -> DataFrame:
    """(conv_id, begin, later, last) of the blocks of conversations that have several: the cost from each state behind the
    block, and whether no block follows. Sixteen numbers for each block meet here, and no block of other conversations."""

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("begin", ascending=False)
        later, out = AT_END, []
        for costs in rows["costs"]:
            out.append(later.tolist())
            later = (np.array(costs).reshape(4, 4) + later).min(1)
        last = [True] + [False] * (len(rows) - 1)
        return pd.DataFrame({"conv_id": rows["conv_id"], "begin": rows["begin"], "later": out, "last": last})

    return several(blocks).select("conv_id", "begin", "costs").groupBy("conv_id").applyInPandas(
        group, "conv_id long, begin long, later array<long>, last boolean"
    )


def several(blocks: DataFrame) -> DataFrame:
    """The blocks of conversations that have more than one."""
    many = blocks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv_id").alias("of"))
    return blocks.join(many, blocks["conv_id"].eqNullSafe(many["of"]), "left_semi")


PATHS = "conv_id long, begin long, costs array<long>, leads array<long>, audits array<binary>"


def paths(blocks: DataFrame, later: DataFrame) -> DataFrame:
    """For each block: costs to the end, state behind it, and audit of its least path, from each state before it (of a
    conversation's only block, from state 0 alone)."""
    later = later.select(F.col("begin").alias("of"), "later", "last")
    rows = blocks.join(later, blocks["begin"] == later["of"], "left").select("conv_id", "begin", "codes", "later", "last")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            upto = np.cumsum([len(c) + 1 for c in b.column(2).to_pylist()])
            # Steps of about BLOCK turns bound the arrays of places.
            steps = np.unique(np.append(np.searchsorted(upto, np.arange(0, upto[-1:].sum(), BLOCK), "right"), b.num_rows))
            for x, y in zip([0, *steps.tolist()], steps.tolist(), strict=False):
                if x < y:
                    yield step(b.slice(x, y - x))

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        codes = [np.frombuffer(c, np.uint8) for c in b.column(2).to_pylist()]
        behind = np.array([AT_END if e is None else e for e in b.column(3).to_pylist()], np.int64).reshape(len(codes), 4)
        alone = b.column(3).is_null().to_numpy(False)
        last = b.column(4).fill_null(True).to_numpy(False)
        cost, lead, audit = least_paths(codes, behind, alone, last)
        return batch_of([b.column(0), b.column(1), cost.tolist(), lead.tolist(), audit], PATHS)

    return rows.mapInArrow(task, PATHS)


def least_paths(
    blocks: list[np.ndarray], behind: np.ndarray, alone: np.ndarray, final: np.ndarray
) -> tuple[np.ndarray, np.ndarray, list]:
    """Costs (blocks, 4), states behind (blocks, 4) and audits (4 each, or 1 of a block alone in its conversation).

    Places are numbered block by block, turn by turn, state by state; a block ends in four places of its own. The end of a
    final block allows insertions; between blocks they belong to the next one.
    """
    order, length, alive = in_step(blocks)
    first = np.concatenate([[0], np.cumsum(length + 1)]) * 4
    cost = np.empty(int(first[-1]), np.int64)
    cost[first[1:, None] - 4 + np.arange(4)] = behind
    now = behind.copy()
    for back in range(len(alive)):
        rows = order[: alive[back]]
        codes = np.array([blocks[r][length[r] - 1 - back] for r in rows])
        now[rows] = step_back(codes, now[rows])
        cost[first[rows][:, None] + 4 * (length[rows] - 1 - back)[:, None] + np.arange(4)] = now[rows]

    codes = np.concatenate([np.zeros(0, np.uint8), *[np.append(b, np.uint8(0)) for b in blocks]])
    last = np.zeros(len(codes), bool)
    last[first[1:] // 4 - 1] = True
    at = np.arange(len(cost)).reshape(-1, 4)
    keep, kept_to, rerole = moves(codes)
    after = np.where(last[:, None], at, at + 4) - np.arange(4)  # the first place of the next turn
    target = np.stack([after + np.arange(4), at - np.arange(4) + NEXT, after + kept_to, after + NEXT])
    price = np.stack([np.full_like(keep, DELETE), np.full_like(keep, INSERT), keep, rerole])
    price[[D, K, R], :, :] = np.where(last[:, None], FAR, price[[D, K, R]])
    end_open = np.zeros(len(codes), bool)
    end_open[first[1:] // 4 - 1] = final
    price[I] = np.where((last & ~end_open)[:, None], FAR, price[I])
    grid = cost.reshape(-1, 4)
    optimal = (price < FAR) & (price + cost[target] == grid[None])
    # At the end of all turns a path is over where nothing more is due.
    optimal[I] &= ~(last[:, None] & (grid == 0))
    letter, turn, state = np.nonzero(optimal)
    way, length_of = rank_paths(letter, 4 * turn + state, target[letter, turn, state], len(cost))

    audits, lead = [], np.zeros((len(blocks), 4), np.int64)
    entries = [(k, s) for k in range(len(blocks)) for s in range(1 if alone[k] else 4)]
    place = np.array([first[k] + s for k, s in entries], np.int64)
    letters, finish = way(place, length_of(place))
    for (k, s), text, stop in zip(entries, letters, finish, strict=True):
        if s == 0:
            audits.append([])
        audits[k].append(text)
        lead[k, s] = stop % 4
    return np.array([cost[first[k] : first[k] + 4] for k in range(len(blocks))]).reshape(-1, 4), lead, audits


def rank_paths(letter: np.ndarray, source: np.ndarray, target: np.ndarray, places: int):
    """Ranks arcs by the first 1, 2, 4 ... letters of the least path that begins with them, and gives functions for the
    letters, the end and the length of a place's least path.

    `places` is also the arc (rank 0) of every place without one, at which paths are over.
    """
    over = len(letter)
    rank = np.append(letter + 1, 0).astype(np.int64)

    def least(rank: np.ndarray) -> np.ndarray:
        """The arc of least rank of each place."""
        order = np.lexsort((rank[:over], source))
        out = np.full(places, over, np.int64)
        heads = np.concatenate([[True], source[order][1:] != source[order][:-1]]) if over else np.zeros(0, bool)
        out[source[order][heads]] = order[heads]
        return out

    goes_to = np.append(target, 0)
    chosen = least(rank)
    jumps = [np.append(chosen[target], over)]
    while (jumps[-1] != over).any():
        jump = jumps[-1]
        pair = rank * (rank.max() + 1) + rank[jump]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        chosen = least(rank)
        jumps.append(jump[jump])

    def length_of(place: np.ndarray) -> np.ndarray:
        """Letters of the least path, by the largest jumps that don't end it."""
        arc = chosen[place]
        n = (arc != over).astype(np.int64)
        for power in range(len(jumps) - 1, -1, -1):
            on = jumps[power][arc]
            go = on != over
            n[go] += 1 << power
            arc = np.where(go, on, arc)
        return n

    signs = np.append(np.frombuffer(LETTERS, np.uint8)[letter], 0).astype(np.uint8)

    def way(place: np.ndarray, n: np.ndarray) -> tuple[list[bytes], list[int]]:
        upto = np.cumsum(n)
        step = np.arange(int(n.sum())) - np.repeat(upto - n, n)
        arc = np.repeat(chosen[place], n)
        for power in range(len(jumps)):
            on = step >> power & 1 == 1
            arc[on] = jumps[power][arc[on]]
        text = signs[arc].tobytes()
        stop = place.copy()
        some = n > 0
        stop[some] = goes_to[arc[upto[some] - 1]]
        return [text[e - k : e] for e, k in zip(upto.tolist(), n.tolist(), strict=True)], stop.tolist()

    return way, length_of


HEADS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
MEASURES = ["low", "high", "turns", "first_turn", "last_turn", "first_role", "last_role", "blank", "duplicate", "truncated", "illegal"]


def heads(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """A row for each conversation: its counts, cost and audit. Staged."""
    found = found.select(F.col("begin").alias("of"), F.col("costs").alias("to_end"), "leads", "audits")
    rows = blocks.join(found, blocks["begin"] == found["of"]).select("conv_id", "begin", *MEASURES, "to_end", "leads", "audits")
    span = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    alone = rows.filter("size(audits) = 1").select(
        "conv_id", span.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        F.col("to_end")[0].alias("cost"), F.col("audits")[0].cast("string").alias("audit"),
    )

    def group(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("begin")
        state, audit, illegal, turns, role, turn = 0, [], 0, 0, None, None
        for r in part.itertuples():
            audit.append(r.audits[state])
            state = int(r.leads[state])
            turns += int(r.turns) - (not pd.isna(r.first_turn) and turn == r.first_turn)
            turn = turn if pd.isna(r.last_turn) else r.last_turn
            if not pd.isna(r.first_role):
                illegal += role is not None and not LEGAL[role, int(r.first_role)]
                role = int(r.last_role)
        first = part.iloc[0]
        gaps = 0 if part["low"].isna().all() else int(part["high"].max() - part["low"].min()) + 1 - turns
        sums = [int(part[c].sum()) for c in ("blank", "duplicate", "truncated", "illegal")]
        sums[3] += illegal
        row = (first.conv_id, gaps, *sums, int(first.to_end[0]), b"".join(audit).decode())
        return pd.DataFrame([row], columns=[c.split()[0] for c in HEADS.split(", ")])

    many = rows.filter("size(audits) > 1").groupBy("conv_id").applyInPandas(group, HEADS)
    return common.stage(alone.unionByName(many), "audits")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The audits' rows with repaired_sha256: texts stream past behind their conversation's audit."""
    out = HEADS + ", repaired_sha256 string"
    names = [c.split()[0] for c in HEADS.split(", ")]
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    texts = rows.filter("copies > 0").select(
        *[F.col(c) if c == "conv_id" else none(c, k) for c, k in (x.split() for x in HEADS.split(", "))],
        F.lit(1).alias("kind"), "turn", "role", "text", "copies", digest(F.col("role"), F.col("text")).alias("digest"),
    )
    tops = audits.select(
        *names, F.lit(0).alias("kind"), none("turn", "long"), none("role", "string"), none("text", "string"),
        none("copies", "int"), none("digest", "binary"),
    )
    order = ["conv_id", "kind", "turn", "role", "digest"]
    stream = tops.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).select(*names, "role", "text", "copies")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if row[7] is not None:
                    if writer:
                        done.append(writer.finish())
                    writer = Writer(row[:8])
                else:
                    for _ in range(row[10]):
                        writer.turn(row[8], row[9])
            if done:
                yield batch_of(zip(*done, strict=True), out)
                done = []
        if writer:
            yield batch_of(zip(writer.finish(), strict=True), out)

    return stream.mapInArrow(task, out)


class Writer:
    """Follows an audit and hashes the repaired turns."""

    def __init__(self, head: tuple):
        self.head, self.audit, self.at = head, head[7].encode(), 0
        self.state, self.any, self.hash = 0, False, hashlib.sha256()

    def write(self, what: bytes) -> None:
        if self.any:
            self.hash.update(b"\n")
        self.hash.update(what)
        self.any = True

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == LETTERS[I]:
            self.write(INSERTED[self.state])
            self.state, self.at = int(NEXT[self.state]), self.at + 1

    def turn(self, role: str, text: str) -> None:
        self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == LETTERS[D]:
            return
        if edit == LETTERS[K]:
            self.write(role.encode() + b":")
            self.state = 1 if role.startswith("s") else int(NEXT[self.state])
        else:
            self.write(INSERTED[self.state])
            self.state = int(NEXT[self.state])
        self.hash.update(text.encode())

    def finish(self) -> tuple:
        self.inserted()
        return (*self.head, self.hash.hexdigest())


def repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each conv_id of `conversations` (conv_id, turn, role, text), damaged first: gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    common.small_batches(conversations.sparkSession)
    rows = damaged(conversations)
    blocks = block_rows(faults(rows), block)
    found = common.stage(paths(blocks, ends(blocks)), "paths")
    return repaired(rows, heads(blocks, found))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return repair(common.read(spark, sf_dir, "conversations"))
