"""Sharding by balanced label propagation.

Documents of equal texts are neighbours.  All linked documents start spread evenly over the shards, and
move, round by round, to the shard that most of their neighbours have reached and that still holds the
others.  Copies in one shard are alike, so a round works on cells: the count of a group's documents in
a shard.  A group that no shard holds whole moves as much as fits.  Moves between two shards are matched
against moves the other way and the free room of the target.  Large groups come first.  Until the end a
shard may exceed its quota by small groups; what it has too many goes on, whole groups at a time.  Documents without
links fill what is left, so that in the end the row counts of any two shards differ by one at most.

``propagate`` is the same for any graph of single links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from .frames import cut


def quotas(rows: int, shards: int) -> list[int]:
    """Rows of each shard: at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def allowed_moves(wanted: dict[tuple[int, int], int], load: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """Moves granted of those wanted from shard a to shard b: as many as go the other way, and more
    while b has free room.  Both tables have at most shards x shards entries."""
    grant = {(a, b): min(n, wanted.get((b, a), 0)) for (a, b), n in wanted.items()}
    room = [q - x for q, x in zip(quota, load)]
    for (a, b), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
        more = max(0, min(n - grant[a, b], room[b]))
        grant[a, b] += more
        room[b] -= more
        room[a] += more
    return grant


def _segment(place, room: list[int]):
    """The shard whose segment holds a place (from 1) when the shards' rooms stand in line; null beyond."""
    ends = [sum(room[:s + 1]) for s in range(len(room))]
    shard = F.lit(None).cast("int")
    for s in reversed(range(len(room))):
        shard = F.when(place <= ends[s], s).otherwise(shard)
    return shard


def _ranked(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    return global_rank(df, group, order, "place")


def propagate(nodes: DataFrame, edges: DataFrame, shards: int, quota: list[int], rounds: int = 8,
              start: DataFrame | None = None) -> DataFrame:
    """(id, shard) of the linked nodes: the balanced label propagation proper.

    ``start`` (id, shard) places every node within the quotas; without it they start spread evenly.
    ``edges`` (a, b) name nodes, once each and in either direction.  A node that gains neighbours by
    moving wants to move; in the first round only nodes with a smaller neighbour do, later a random
    half in each round, so that neighbours do not swap places for ever.  Ends when no move would
    gain anything or after ``rounds`` rounds.
    """
    state = cut(start) if start is not None else cut(_ranked(nodes.select("id", F.xxhash64("id").alias("h")), [], ["h", "id"])
                .select("id", F.pmod(F.col("place") - 1, F.lit(shards)).cast("int").alias("shard")))
    both = edges.select(F.inline(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")),
                                         F.struct(F.col("b").alias("id"), F.col("a").alias("other")))))
    both = cut(both.where("id <> other"))
    for r in range(rounds):
        near = (both.join(state.withColumnRenamed("id", "other"), "other")
                .groupBy("id", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("other").alias("least")))
        liked = near.groupBy("id").agg(F.max(F.struct("n", (-F.col("shard")).alias("s"))).alias("top"),
                                       F.min("least").alias("least"),
                                       F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("by"))  # <= shards entries
        moves = (state.join(liked, "id")
                 .select("id", "least", F.col("shard").alias("frm"), (-F.col("top.s")).alias("to"),
                         (F.col("top.n") - F.coalesce(F.col("by")[F.col("shard")], F.lit(0))).alias("gain"))
                 .where("gain > 0"))
        moves = cut(moves)
        if moves.isEmpty():
            break
        active = moves.where("least < id") if r == 0 else moves.where(F.pmod(F.xxhash64("id", F.lit(r)), F.lit(2)) == 0)
        wanted = {(x["frm"], x["to"]): x["n"] for x in active.groupBy("frm", "to").agg(F.count(F.lit(1)).alias("n")).collect()}
        load = {x["shard"]: x["n"] for x in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        grant = allowed_moves(wanted, [load.get(s, 0) for s in range(shards)], quota)
        if not any(grant.values()):
            continue
        short = sorted(k for k in wanted if grant[k] < wanted[k])
        if short:   # of these only the moves that gain most go
            key = F.struct("frm", "to")
            tight = active.where(key.isin([F.struct(F.lit(a).alias("frm"), F.lit(b).alias("to")) for a, b in short]))
            most = F.create_map(*[F.lit(x) for k in short for x in (k[0] * shards + k[1], grant[k])])
            best = _ranked(tight.select("id", "frm", "to", (-F.col("gain")).alias("loss")), ["frm", "to"], ["loss", "id"])
            active = (active.join(tight.select("id"), "id", "left_anti").select("id", "to")
                      .unionByName(best.where(F.col("place") <= most[F.col("frm") * shards + F.col("to")]).select("id", "to")))
        state = cut(state.join(active.select("id", "to"), "id", "left").select("id", F.coalesce("to", "shard").alias("shard")))
    return state


FAN = 1024                           # residues of ids by which a group's rows meet its name
LEVELS = 1024                        # by which a pair of shards lets a part of its moves pass
LARGE = 1000                         # groups of over 1/LARGE of a quota, and over ONE_BY_ONE rows, move one after the other
ONE_BY_ONE = 64
SLACK = 0.05                         # of a quota that small groups may exceed it by until the end


def _small(quota: list[int]) -> int:
    """Rows of the largest group that moves together with all others; at most LARGE * shards are larger."""
    return max(ONE_BY_ONE, min(quota) // LARGE)


def _place(grp: int, shard: int) -> int:
    """An order of the shards for each group, to break ties."""
    return ((grp * 0x9E3779B97F4A7C15 + shard * 0xD6E8FEB86659FD93) >> 7) % (1 << 31)


def gather_large(cells: dict[int, dict[int, int]], room: list[int]) -> int:
    """Move the large groups (group: shard: rows), the largest first: whole to the shard that has most
    of it and room for the rest, else from the shards that have least of it to those that have most as
    far as there is room.  Returns the rows moved; changes both arguments."""
    moved = 0
    for grp, by in sorted(cells.items(), key=lambda x: (-sum(x[1].values()), x[0])):
        total = sum(by.values())
        order = sorted(by, key=lambda s: (by[s], _place(grp, s)), reverse=True)
        fits = [s for s in order if room[s] >= total - by[s]]
        for to in fits[:1] or order:
            for frm in reversed(order):
                if frm == to or (not fits and order.index(frm) < order.index(to)):
                    continue
                n = min(by[frm], room[to])
                by[frm], by[to], moved = by[frm] - n, by[to] + n, moved + n
                room[frm], room[to] = room[frm] + n, room[to] - n
    return moved


def _wishes(cells: DataFrame, room: list[int], turn: int) -> DataFrame:
    """(grp, frm, to, n): each group gathers in the shard that has most of it among those with room for
    the rest; where none has, rows go from a shard that has less of the group to the one with most."""
    seen = F.array(*[F.lit(x).cast("bigint") for x in room])
    by = cells.groupBy("grp").agg(F.sum("n").alias("total"), F.collect_list(F.struct("n", "shard")).alias("by"))   # <= shards entries
    ranked = F.transform("by", lambda e: F.struct(e["n"].alias("n"), F.xxhash64("grp", e["shard"]).alias("h"), e["shard"].alias("shard")))
    by = by.where(F.size("by") > 1).select("grp", "total", ranked.alias("by"))
    fits = F.array_max(F.filter("by", lambda e: F.get(seen, e["shard"]) >= F.col("total") - e["n"]))
    some = F.array_max(F.filter("by", lambda e: F.get(seen, e["shard"]) > 0)) if turn % 2 == 0 else F.array_max("by")
    by = by.select("grp", "by", fits.isNotNull().alias("whole"), F.coalesce(fits, some).alias("goal")).where("goal IS NOT NULL")
    moves = F.filter("by", lambda e: (e["shard"] != F.col("goal")["shard"]) & (F.col("whole") | (e < F.col("goal"))))
    return (by.select("grp", F.col("goal")["shard"].alias("to"), F.explode(moves).alias("e"))
            .select("grp", F.col("e")["shard"].alias("frm"), "to", F.col("e")["n"].alias("n")))


def _granted(moves: DataFrame, grant: dict[tuple[int, int], int], wanted: dict[tuple[int, int], int], shards: int, turn: int) -> DataFrame:
    """The moves that pass: all of a pair of shards, or those of its lowest hashes up to what is granted."""
    short = [k for k in wanted if grant[k] < wanted[k]]
    if not short:
        return moves
    level = F.pmod(F.xxhash64("grp", F.lit(turn)), F.lit(LEVELS)).cast("int")
    pair = F.col("frm") * shards + F.col("to")
    most = F.create_map(*[F.lit(x) for k in short for x in (k[0] * shards + k[1], grant[k])])
    upto = Window.partitionBy("pair").orderBy("level")
    line = (moves.select(pair.alias("pair"), level.alias("level"), "n").where(F.col("pair").isin([a * shards + b for a, b in short]))
            .groupBy("pair", "level").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(upto)))      # <= pairs * LEVELS rows
    passed = {r["pair"]: r["l"] for r in line.where(F.col("upto") <= most[F.col("pair")]).groupBy("pair").agg(F.max("level").alias("l")).collect()}
    limit = F.create_map(*[F.lit(x) for a, b in short for x in (a * shards + b, passed.get(a * shards + b, -1))])
    return moves.where(level <= F.coalesce(limit[pair], F.lit(LEVELS)))


def gather(cells: DataFrame, shards: int, quota: list[int], rounds: int = 12, trace: list | None = None) -> DataFrame:
    """(grp, shard, n): the cells after label propagation under the quotas.

    ``cells`` counts the rows of each group in each shard, within the quotas.  Large groups, of which there
    can be only LARGE * shards, move one after the other; of the small ones all that wish to move and are let pass do so
    at once, a round being one aggregate of the cells.  ``trace`` gets (rows moved, groups in several shards, rows outside
    the shard that has most of their group) of the start and of every round.
    """
    small = _small(quota)
    slack = [int(q * SLACK) + min(small, q // 8 + 1) for q in quota]
    cells = cut(cells)

    def note(moved):
        if trace is not None:
            by = cells.groupBy("grp").agg(F.sum("n").alias("total"), F.max("n").alias("top"), F.count(F.lit(1)).alias("c"))
            r = by.agg(F.count(F.when(F.col("c") > 1, 1)).alias("split"), F.coalesce(F.sum(F.col("total") - F.col("top")), F.lit(0)).alias("out")).first()
            trace.append((moved, r["split"], r["out"]))

    def room():
        load = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        return [q - load.get(s, 0) for s, q in enumerate(quota)]

    note(0)
    if not rounds:
        return cells
    sizes = cells.groupBy("grp").agg(F.sum("n").alias("total"))
    large = cut(sizes.where(F.col("total") > small).select("grp"))
    for turn in range(rounds):
        by: dict[int, dict[int, int]] = {}
        for r in cells.join(F.broadcast(large), "grp").collect():            # at most LARGE * shards * shards cells
            by.setdefault(r["grp"], {})[r["shard"]] = r["n"]
        # large groups come first: small ones make room for them at the end
        moved = gather_large(by, [q - sum(b.get(s, 0) for b in by.values()) for s, q in enumerate(quota)])
        if moved:
            spark = cells.sparkSession
            placed = spark.createDataFrame([(g, s, n) for g, b in by.items() for s, n in b.items() if n], "grp long, shard int, n long")
            cells = cut(cells.join(F.broadcast(large), "grp", "left_anti").select("grp", "shard", "n").unionByName(placed))
        loose = [x + y for x, y in zip(room(), slack)]
        moves = cut(_wishes(cells.join(F.broadcast(large), "grp", "left_anti"), loose, turn))
        wanted = {(r["frm"], r["to"]): r["n"] for r in moves.groupBy("frm", "to").agg(F.sum("n").alias("n")).collect()}
        grant = allowed_moves(wanted, [0] * shards, loose)
        if any(grant.values()):
            passed = cut(_granted(moves, grant, wanted, shards, turn))
            moved += passed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            to, frm = passed.select("grp", F.col("to").alias("shard"), "n"), passed.select("grp", F.col("frm").alias("shard"), (-F.col("n")).alias("n"))
            cells = cut(cells.unionByName(to).unionByName(frm).groupBy("grp", "shard").agg(F.sum("n").alias("n")).where("n > 0"))
        note(moved)
        if not wanted and not moved:
            break
    return cells


def _members(members: DataFrame, cells: DataFrame, small: int) -> DataFrame:
    """(id, grp, total, shard) of every linked row: the rows of a group, in order, go to its cells in order."""
    line = Window.partitionBy("grp").orderBy("shard")
    total = Window.partitionBy("grp")
    table = cut(cells.select("grp", "shard", (F.sum("n").over(line) - F.col("n") + 1).alias("first"), F.sum("n").over(line).alias("last"),
                             F.sum("n").over(total).alias("total"), F.count(F.lit(1)).over(total).alias("in")))
    one = table.where("`in` = 1").select("grp", "shard", "total")
    many = table.where("`in` > 1")
    big = F.broadcast(table.where(F.col("total") > small).select("grp").distinct())     # at most LARGE * shards groups
    hot = members.join(big, "grp")
    rest = members.join(big, "grp", "left_anti")
    some = many.select("grp").distinct()
    parts = [hot.join(F.broadcast(one.where(F.col("total") > small)), "grp"), rest.join(one.where(F.col("total") <= small), "grp")]
    for rows, cond in ((hot, F.col("total") > small), (rest, F.col("total") <= small)):
        table_ = many.where(cond)
        if table_.isEmpty():
            continue
        names = some.join(table_.select("grp").distinct(), "grp")
        if rows is hot:
            table_, names = F.broadcast(table_), F.broadcast(names)
        ranked = _ranked(rows.join(names, "grp", "left_semi"), ["grp"], ["id"])
        parts.append(ranked.join(table_, "grp").where("place BETWEEN first AND last"))
    out = parts[0].select("id", "grp", "total", "shard")
    for p in parts[1:]:
        out = out.unionByName(p.select("id", "grp", "total", "shard"))
    return cut(out)


def _back(placed: DataFrame, quota: list[int], small: int) -> DataFrame:
    """(id, shard) with every shard within its quota: what it has too many of small groups goes, in the order of
    groups, to the shards with room, so that one group at most is split where a shard's excess or room ends."""
    load = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    over = {s: load.get(s, 0) - q for s, q in enumerate(quota) if load.get(s, 0) > q}
    if not over:
        return placed.select("id", "shard")
    room = [max(0, q - load.get(s, 0)) for s, q in enumerate(quota)]
    before, at = {}, 0
    for s in sorted(over):
        before[s], at = at, at + over[s]
    lookup = lambda d: F.create_map(*[F.lit(x) for k, v in d.items() for x in (k, v)])[F.col("shard")]
    rows = placed.where(F.col("shard").isin(list(over)) & (F.col("total") <= small))
    line = _ranked(rows.select("id", "shard", "grp", F.xxhash64("grp").alias("h")), ["shard"], ["h", "grp", "id"])
    gone = cut(line.where(F.col("place") <= lookup(over)).select("id", _segment(F.col("place") + lookup(before), room).alias("to")))
    return placed.join(gone, "id", "left").select("id", F.coalesce("to", "shard").alias("shard"))


def gather_members(members: DataFrame, shards: int, quota: list[int], rounds: int = 12, trace: list | None = None) -> DataFrame:
    """(id, shard) of the linked rows (id, grp) after label propagation from an even start."""
    small = _small(quota)
    start = _ranked(members.select("id", "grp", F.xxhash64("id").alias("h")), [], ["h", "id"])
    cells = (start.select("grp", F.pmod(F.col("place") - 1, F.lit(shards)).cast("int").alias("shard"))
             .groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n")))
    cells = gather(cells, shards, quota, rounds, trace)
    return _back(_members(members, cells, small), quota, small)


def balanced_shards(nodes: DataFrame, edges: DataFrame, shards: int, rounds: int = 8,
                    start: DataFrame | None = None) -> DataFrame:
    """(id, shard, slot) of every node: row counts of shards at most one apart, linked nodes together
    as far as the quotas allow, ``slot`` gapless from 0 within a shard by id.

    ``nodes`` has a distinct, non-null ``id``; ``edges`` has ``a`` and ``b`` (null ends and unknown ids are
    ignored).  ``start`` is that of ``propagate``.  No nodes give no rows.
    """
    nodes = cut(nodes.select("id"))
    quota = quotas(nodes.count(), shards)
    edges = edges.select("a", "b").where("a <> b").distinct()
    known = nodes.select(F.col("id").alias("a"))
    edges = cut(edges.join(known, "a").join(known.withColumnRenamed("a", "b"), "b").select("a", "b"))
    linked = cut(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    return fill(nodes, propagate(linked, edges, shards, quota, rounds, start), quota)


def fill(nodes: DataFrame, placed: DataFrame, quota: list[int]) -> DataFrame:
    """(id, shard, slot) of all ``nodes``: those not ``placed`` fill the free room of the shards in line."""
    shards, placed = len(quota), cut(placed)
    load = {x["shard"]: x["n"] for x in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    # the rest, in order, fills the free room of shard 0, then 1, and so on
    free = _ranked(nodes.select("id").join(placed.select("id"), "id", "left_anti").select("id", F.xxhash64("id").alias("h")), [], ["h", "id"])
    ends, total = [], 0
    for s in range(shards):
        total += quota[s] - load.get(s, 0)
        ends.append(total)
    shard = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        shard = F.when(F.col("place") <= ends[s], s).otherwise(shard)
    whole = placed.unionByName(free.select("id", shard.cast("int").alias("shard")))
    return _ranked(whole, ["shard"], ["id"]).select("id", "shard", (F.col("place") - 1).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = 12, trace: list | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null) of every document.

    Documents of equal texts are neighbours; see ``gather`` for how they move and what ``trace`` gets.  A group
    larger than a shard's quota is spread over as few shards as have room, as the law demands.

    Null text counts as empty (size 1, CRC 0) and equals it.  Rows that repeat an id are placed on
    their own; their order among themselves is that of their checksums.  Null ids are placed too.
    Other columns are ignored, also such as are named like a column of the result.  No rows give no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("sha"))
    rows = cut(rows)
    # A row is named by its place in the order of ids, so that repeated and null ids have names too.
    rows = cut(_ranked(rows, [], ["doc_id", "text_crc32", "sha"]).withColumnRenamed("place", "id"))
    # A group is named by its first row.  The first of each residue meets the rows of its residue, so that
    # no key gathers all rows of a large group.
    part = F.pmod("id", F.lit(FAN)).alias("part")
    parts = cut(rows.groupBy("sha", part).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    groups = parts.groupBy("sha").agg(F.min("first").alias("grp"), F.sum("n").alias("n")).where("n > 1")
    names = cut(parts.join(groups.select("sha", "grp"), "sha").select("sha", "part", "grp"))
    members = cut(rows.select("id", "sha", part).join(names, ["sha", "part"]).select("id", "grp"))
    quota = quotas(rows.count(), shards)
    placed = fill(rows, gather_members(members, shards, quota, rounds, trace), quota)
    return rows.join(placed, "id").select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                          F.lit(None).cast("int").alias("grown_shard"))
