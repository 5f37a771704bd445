"""Repair of the structure of conversations at the least cost.

The role initials of a sound conversation are ``(s?(ua)+)?``. Rows are kept, given another
role or deleted, and empty ones inserted, so that this holds; of all cheapest edits those
are taken whose letters, the audit, come first in ASCII order.

A conversation is cut into blocks of consecutive rows, each one short string of signs. A
cost DP runs over the rows of many blocks at once. Its optimal arcs make a graph, in which
every node is ranked by its least audit of one letter, then of two, four and so on, while
pointers to the node reached are doubled (prefix doubling); equal ranks have one audit, which
the doubled pointers spell out. Blocks of one conversation are put together in the same
way: products of their cost tables, then of the states they lead to, over doubled distances
by joins. So no task needs a whole conversation to find its edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import stage
from tickweave.operators.paging import with_positions

BLOCK = 1024  # rows of a block
CELLS = 1 << 18  # rows of blocks worked on at a time
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5  # costs; CUT is added for a truncated row that stays
BLANKS = " \t\n\v\f\r"
DAMAGES = 20  # rows in so many take each kind of damage

# States: nothing yet, after s, after u, after a.
_FAR = 1 << 40
_NEED = np.array([2, 2, 3, 2])  # where the only role that may be given leads to
_ROLE = {2: "user", 3: "assistant"}
_STEP = {"s": [1, 4, 4, 4], "u": [2, 2, 4, 2], "a": [4, 4, 3, 4], "o": [4, 4, 4, 4]}  # 4: not allowed
_ENDS = [0, 2 * INSERT, INSERT, 0]  # what it costs to end here
_SIGNS = "suaoSUAOx$-"  # truncated ones in capitals, x must go, $ ends a conversation, - fills up
_CODE = np.zeros(256, np.int64)
_CODE[list(_SIGNS.encode())] = range(len(_SIGNS))
_LETTERS = np.array(["", "D", "I", "K", "R"])  # in ASCII order


def _tables() -> tuple[np.ndarray, ...]:
    """By sign and state: where keeping leads, and the costs of passing, deleting, keeping
    and giving a role."""
    keeps = np.full((len(_SIGNS), 4), 4)
    costs = np.full((4, len(_SIGNS), 4), _FAR)
    for i, sign in enumerate(_SIGNS[:8]):
        more = CUT if sign.isupper() else 0
        keeps[i] = _STEP[sign.lower()]
        costs[2, i], costs[3, i] = KEEP + more, REROLE + more
    costs[1, :9] = DELETE
    costs[0, 9, [0, 3]] = 0
    costs[0, 10] = 0
    return keeps, *costs


_KEEPS, _PASS, _DELETE, _KEEP, _REROLE = _tables()


def _graph(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For blocks of signs (blocks x rows) and the costs from their ends on: the cost from
    each node (layer x block x state), the least letter of its optimal arcs, and the node
    that this arc leads to."""
    n, rows = codes.shape
    cost = np.empty((rows + 1, n, 5), np.int64)
    cost[..., 4] = _FAR
    cost[rows, :, :4] = ends
    at = np.arange(n)[:, None]
    for i in range(rows - 1, -1, -1):
        sign, after = codes[:, i], cost[i + 1]
        best = np.minimum(_PASS[sign] + after[:, :4], _DELETE[sign] + after[:, :4])
        best = np.minimum(best, _KEEP[sign] + after[at, _KEEPS[sign]])
        best = np.minimum(best, _REROLE[sign] + after[:, _NEED])
        more = np.minimum(best, INSERT + best[:, _NEED])
        more = np.minimum(more, INSERT + more[:, _NEED])
        cost[i, :, :4] = np.where((sign == 10)[:, None], best, more)
    sign = codes.T  # layers first
    here, after = cost[:-1, :, :4], cost[1:]
    to = np.arange(4) + np.zeros_like(here)
    layer, block = np.indices(sign.shape)
    kept = after[layer[..., None], block[..., None], _KEEPS[sign]]
    letter, target, inside = np.zeros(here.shape, np.int64), to, np.zeros(here.shape, np.int64)
    for code, price, goes, same in (  # the least letter comes last and stays
        (4, _REROLE[sign] + after[:, :, _NEED], _NEED + np.zeros_like(here), 0),
        (3, _KEEP[sign] + kept, _KEEPS[sign], 0),
        (2, np.where((sign == 10)[..., None], _FAR, INSERT + here[:, :, _NEED]), _NEED + np.zeros_like(here), 1),
        (1, _DELETE[sign] + after[..., :4], to, 0),
        (0, _PASS[sign] + after[..., :4], to, 0),
    ):
        optimal = price == here
        letter, target, inside = np.where(optimal, code, letter), np.where(optimal, goes, target), np.where(optimal, same, inside)
    width = n * 4
    nodes = np.arange((rows + 1) * width).reshape(rows + 1, n, 4)
    follow = nodes.copy()
    follow[:-1] = (layer + 1 - inside.transpose(2, 0, 1)).transpose(1, 2, 0) * width + block[..., None] * 4 + np.minimum(target, 3)
    letters = np.zeros_like(nodes)
    letters[:-1] = letter
    letters[cost[..., :4] >= _FAR] = 0  # no way from here
    return cost[..., :4], letters.ravel(), follow.ravel()


def least_paths(codes: np.ndarray, ends: np.ndarray, starts: np.ndarray | None = None):
    """Of blocks of signs: the costs from their first nodes, the state that the least path
    from each leads to, and with ``starts``, one state per block, the audits from there."""
    cost, letters, follow = _graph(codes, ends)
    n, rows = codes.shape
    first = np.arange(n * 4).reshape(n, 4)
    rank, pointers = letters, [follow]
    while 1 << len(pointers) <= 3 * rows + 1:  # no audit is longer
        last = pointers[-1]
        _, rank = np.unique(rank * (rank.max() + 1) + rank[last], return_inverse=True)
        pointers.append(last[last])
    leads = pointers[-1][first] % 4
    if starts is None:
        return cost[0], leads, None
    chosen = first[np.arange(n), starts]
    _, one, which = np.unique(rank[chosen], return_index=True, return_inverse=True)
    path = chosen[one][:, None]
    for pointer in pointers[:-1]:
        path = np.concatenate([path, pointer[path]], 1)
    audits = np.array(["".join(row) for row in _LETTERS[letters[path]].tolist()], object)
    return cost[0], leads, audits[which]


def _slices(signs: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Blocks of about one length together, as codes filled up to the longest."""
    order = sorted(range(len(signs)), key=lambda i: len(signs[i]))
    while order:
        rows = len(signs[order[0]])
        some = [i for i in order[: max(CELLS // max(rows, 1), 1)] if len(signs[i]) <= 2 * rows + 8]
        order = order[len(some) :]
        width = len(signs[some[-1]])
        data = "".join(signs[i].ljust(width, "-") for i in some).encode()
        yield some, _CODE[np.frombuffer(data, np.uint8)].reshape(len(some), width)


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cost table of each block: from every state to every state, in one list."""
    for batch in batches:
        signs = batch.column("signs").to_pylist()
        tables = np.zeros((len(signs), 4, 4), np.int64)
        for some, codes in _slices(signs):
            for state in range(4):
                ends = np.full((len(some), 4), _FAR)
                ends[:, state] = 0
                tables[some, :, state] = np.minimum(_graph(codes, ends)[0][0], _FAR)
        held = {name: batch.column(name) for name in ("conv", "block")}
        yield pa.record_batch(held | {"costs": pa.array(list(tables.reshape(-1, 16)), pa.list_(pa.int64()))})


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each block leads to from every state, under the costs after it."""
    for batch in batches:
        signs, ends = batch.column("signs").to_pylist(), np.array(batch.column("ends").to_pylist(), np.int64)
        leads = np.zeros((len(signs), 4), np.int64)
        for some, codes in _slices(signs):
            leads[some] = least_paths(codes, ends[some])[1]
        held = {name: batch.column(name) for name in ("conv", "block")}
        yield pa.record_batch(held | {"leads": pa.array(list(leads), pa.list_(pa.int64()))})


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit of each block from the state it starts in, and the cost from there on."""
    for batch in batches:
        signs, ends = batch.column("signs").to_pylist(), np.array(batch.column("ends").to_pylist(), np.int64)
        start = batch.column("start").to_numpy(zero_copy_only=False)
        audits, costs = np.empty(len(signs), object), np.zeros(len(signs), np.int64)
        for some, codes in _slices(signs):
            cost, _, audits[some] = least_paths(codes, ends[some], start[some])
            costs[some] = cost[np.arange(len(some)), start[some]]
        held = {name: batch.column(name) for name in ("conv", "block")}
        yield pa.record_batch(held | {"audit": pa.array(audits, pa.string()), "cost": pa.array(costs)})


def _key(column: str = "conv_id") -> Column:
    """A text for each conversation, also for that without an id."""
    return F.when(F.col(column).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(column).cast("string")))


def _told(rows: DataFrame) -> DataFrame:
    """Rows with the columns that the repair needs; a null role or text is one blank."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.select(_key().alias("conv"), "turn", role.alias("role"), text.alias("text")).withColumn(
        "same", F.substring(F.unhex(F.sha2("text", 256)), 1, 16)
    )


_ORDER = ("turn", "role", "same")


def _order() -> list[Column]:
    """By turn, nulls first; rows of one turn by role and text. What still ties is alike."""
    return [F.col(c).asc_nulls_first() for c in _ORDER]


def faults(rows: DataFrame) -> DataFrame:
    """Each row without its text, written down: ``conv``, ``position`` in the conversation,
    its columns of order, ``initial`` (s, u, a or o for any other) and its first fault,
    ``blank``, ``duplicate``, ``truncated`` or null."""
    told = _told(rows)
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    marked = told.select(
        "conv",
        *_ORDER,
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (bare == "").alias("is_blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("is_cut"),
    )
    placed = with_positions(marked, _order(), ("conv",))
    said = placed.filter(~F.col("is_blank")).groupBy("conv", "role", "same").agg(F.min("position").alias("position"))
    # Joined by place, which no two rows share, so that a text said again and again is no hot key.
    first = said.select("conv", "position", F.lit(True).alias("is_first"))
    fault = (
        F.when(F.col("is_blank"), "blank")
        .when(F.col("is_first").isNull(), "duplicate")
        .when(F.col("is_cut"), "truncated")
    )
    known = placed.join(first, ["conv", "position"], "left")
    return known.select("conv", "position", *_ORDER, "initial", fault.alias("fault"))


def _blocks(marked: DataFrame) -> DataFrame:
    """One row per block of a conversation: its signs, its initials and the next one, and
    how many rows have each fault."""
    initial, fault = F.col("initial"), F.col("fault")
    gone = fault.isin("blank", "duplicate")
    sign = F.when(gone, "x").when(fault == "truncated", F.upper(initial)).otherwise(initial)
    block = F.expr(f"position div {BLOCK}")
    # The first row of a block is also seen by the block before, for their border.
    opens = (F.col("position") > 0) & (F.col("position") % BLOCK == 0)
    seen = F.when(opens, F.array(block, block - 1)).otherwise(F.array(block))
    each = marked.select("conv", "position", sign.alias("sign"), "initial", "fault", block.alias("own"), F.explode(seen).alias("block"))
    own = F.col("own") == F.col("block")
    held = F.sort_array(F.collect_list(F.struct("position", F.when(own, F.col("sign")).otherwise("").alias("sign"), "initial")))

    def joined(name: str) -> Column:
        return F.array_join(F.transform("held", lambda r: r[name]), "")

    counts = [F.count_if(own & (fault == name)).alias(name) for name in ("blank", "duplicate", "truncated")]
    grouped = each.groupBy("conv", "block").agg(held.alias("held"), *counts)
    pairs = F.length("initials") - 1 - F.regexp_count("initials", F.lit("(?=su|ua|au)"))
    found = grouped.select("conv", "block", joined("sign").alias("signs"), joined("initial").alias("initials"), "blank", "duplicate", "truncated")
    return stage(found.withColumn("illegal", pairs.cast("long")).drop("initials"), "conversation-blocks")


def _shifted(table: DataFrame, by: int, name: str) -> DataFrame:
    return table.select("conv", (F.col("block") + by).alias("block"), F.col(name).alias("other"))


def _least_sum(a: Column, b: Column) -> Column:
    """The product of two 4 x 4 cost tables, sums for products and minima for sums."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(15)),
        lambda at: F.array_min(
            F.array(*(a[at - at % 4 + k] + b[at % 4 + 4 * k] for k in range(4)))
        ),
    )


def _linked(blocks: DataFrame, most: int) -> DataFrame:
    """``blocks`` with ``ends``, the costs after each, and ``start``, the state before it."""
    last = F.array(*(F.lit(0).cast("long") for _ in range(4)))
    if most == 1:
        return blocks.withColumns({"ends": last, "start": F.lit(0).cast("long")})
    long = blocks.filter("n_blocks > 1").select("conv", "block", "signs")
    costs = stage(long.mapInArrow(_crossed, "conv string, block long, costs array<long>"), "block-costs")
    reach = 1
    while reach < most:
        joined = costs.join(_shifted(costs, -reach, "costs"), ["conv", "block"], "left")
        product = F.when(F.col("other").isNull(), F.col("costs")).otherwise(_least_sum(F.col("costs"), F.col("other")))
        costs, reach = stage(joined.select("conv", "block", product.alias("costs")), "block-costs"), reach * 2
    best = F.array(*(F.array_min(F.slice("costs", 4 * s + 1, 4)) for s in range(4)))
    after = costs.select("conv", (F.col("block") - 1).alias("block"), best.alias("ends"))
    ended = stage(long.join(after, ["conv", "block"], "left").withColumn("ends", F.coalesce("ends", last)), "block-ends")
    leads = stage(ended.mapInArrow(_led, "conv string, block long, leads array<long>"), "block-leads")
    reach = 1
    while reach < most:
        joined = leads.join(_shifted(leads, reach, "leads"), ["conv", "block"], "left")
        chain = F.transform("other", lambda s: F.element_at("leads", (s + 1).cast("int")))
        leads, reach = stage(joined.select("conv", "block", F.coalesce(chain, "leads").alias("leads")), "block-leads"), reach * 2
    starts = leads.select("conv", (F.col("block") + 1).alias("block"), F.col("leads")[0].alias("start"))
    known = ended.select("conv", "block", "ends").join(starts, ["conv", "block"], "left")
    return blocks.join(known, ["conv", "block"], "left").withColumns(
        {"ends": F.coalesce("ends", last), "start": F.coalesce("start", F.lit(0).cast("long"))}
    )


def audits(marked: DataFrame) -> DataFrame:
    """One row per block of each conversation of ``faults``, written down: its audit, the
    cost from its first row to the end, and the counts of ``_blocks``."""
    blocks = _blocks(marked)
    sizes = blocks.groupBy("conv").agg((F.max("block") + 1).alias("n_blocks"))
    sized = blocks.join(sizes, "conv")
    most = sizes.agg(F.max("n_blocks")).first()[0] or 1
    closed = F.when(F.col("block") == F.col("n_blocks") - 1, F.concat("signs", F.lit("$"))).otherwise(F.col("signs"))
    linked = _linked(sized.withColumn("signs", closed), most).select("conv", "block", "signs", "ends", "start")
    found = linked.mapInArrow(_audited, "conv string, block long, audit string, cost long")
    return stage(found.join(blocks.drop("signs"), ["conv", "block"]), "audits")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole conversations in order, each led by its audit, with the edits made."""
    conv, audit, place, state = None, [], 0, 0

    def inserted(out: list) -> None:
        nonlocal place, state
        while place < len(audit) and audit[place] == "I":
            place, state = place + 1, int(_NEED[state])
            out.append((conv, "I", None, _ROLE[state], ""))

    def packed(out: list) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
        columns = list(zip(*out)) or [()] * 5
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "edit", "turn", "role", "text"])

    out: list = []
    for batch in batches:
        for key, kind, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "kind", "turn", "role", "text"))):
            if key != conv:
                inserted(out)
                conv, audit, place, state = key, "", 0, 0
            if not kind:
                audit += text
                continue
            inserted(out)
            edit, place = audit[place], place + 1
            if edit == "R":
                state = int(_NEED[state])
                role = _ROLE[state]
            elif edit == "K":
                state = _STEP[role[0]][state]
            out.append((key, edit, turn, role, text))
        yield packed(out)
        out = []
    inserted(out)
    yield packed(out)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of each conversation after its edits, in order, from ``audits``: ``conv``,
    ``edit``, ``turn``, ``role`` and ``text``. Deleted rows are there, with edit D; inserted
    ones have no turn.

    All rows of a conversation stand together in one partition, so that what follows can
    read it from beginning to end; they are sorted on disk and passed on one by one.
    """
    # Texts move once: the order is that of the positions, so none needs to be carried.
    texts = _told(rows).select("conv", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("block"), *_ORDER, "text")
    none = {c: F.lit(None).cast(texts.schema[c].dataType) for c in _ORDER}
    leads = found.select("conv", F.lit(0).alias("kind"), "block", F.col("audit").alias("text")).withColumns(none)
    dealt = texts.unionByName(leads).repartition("conv").sortWithinPartitions("conv", "kind", "block", *_order())
    return dealt.select("conv", "kind", "turn", "role", "text").mapInArrow(
        _applied, "conv string, edit string, turn long, role string, text string"
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, whose rows come one after another."""
    conv, digest, names, digests = None, None, [], []
    for batch in batches:
        for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            if key != conv:
                if conv is not None:
                    names.append(conv)
                    digests.append(digest.hexdigest())
                conv, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pa.record_batch({"conv": pa.array(names, pa.string()), "repaired_sha256": pa.array(digests, pa.string())})
        names, digests = [], []
    if conv is not None:
        yield pa.record_batch({"conv": [conv], "repaired_sha256": [digest.hexdigest()]})


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the damage that the hash of conversation and turn picks; a
    null counts as one blank."""
    blank = F.lit(" ")
    mark = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(mark.cast("binary")) % DAMAGES
    text = F.coalesce("text", blank)
    marked = conversations.select("conv_id", "turn", "role", "text", kind.alias("kind")).filter("kind != 0")
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``faults``, ``audits`` and ``repaired`` rows of conversations (conv_id, turn, role,
    text and any other columns).

    Null ids make one conversation; a null role or text is one blank, and a null turn comes
    first. Rows of one turn are ordered by role and text; repeated ones are duplicates. A
    conversation of any length is cut into blocks; an empty table gives empty tables.
    """
    marked = stage(faults(rows), "faults")
    found = audits(marked)
    return marked, found, repaired(rows, found)


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the table, damaged and repaired."""
    given = conversations.select("conv_id", "turn", "role", "text")
    marked, found, rows = repair(damaged(given))
    turns = marked.filter("turn is not null").select("conv", "turn").distinct().groupBy("conv")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    counted = ("blank", "duplicate", "truncated", "illegal")
    parts = F.sort_array(F.collect_list(F.struct("block", "audit")))
    whole = found.groupBy("conv").agg(
        *(F.sum(c).alias(c) for c in counted),
        F.min_by("cost", "block").alias("cost"),
        F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"),
    )
    hashed = rows.filter("edit != 'D'").mapInArrow(_hashed, "conv string, repaired_sha256 string")
    ids = given.select("conv_id").distinct().withColumn("conv", _key())
    joined = ids.join(whole, "conv", "left").join(gaps, "conv", "left").join(hashed, "conv", "left")
    return joined.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *counted, "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
