"""Sharding by balanced label propagation."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, inside, running, small

SHARDS = 16


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def ranges(quota: list[int], large: int, linked: int, widest: int) -> list[tuple[bool, int, int, int]]:
    """(linked, from, until, shard): where the rows start, by their place among the linked or the unlinked ones.

    The rows of groups larger than a shard fill shards whole. The other linked ones spread evenly over what is left, so
    that unlinked rows are everywhere, but no shard takes less of them than the widest group while it has room.
    """
    out, rest, at, free = [], [], 0, 0
    for q in quota:
        n = min(q, large - at)
        rest.append(q - n)
        at += n
    more, room, place = linked - large, sum(rest), 0
    for s, q in enumerate(quota):
        share = max(widest, -(-(linked - large) * rest[s] // max(1, room)))
        n = min(rest[s], share, more)
        more -= n
        n += q - rest[s]
        out += [(True, place, place + n, s), (False, free, free + q - n, s)]
        place, free = place + n, free + q - n
    return [r for r in out if r[1] < r[2]]


def flows(wanted: dict[tuple[int, int], int], free: list[int], over: list[int]) -> dict[tuple[int, int], int]:
    """How many of the wanted moves (from, to) fit: moves in opposite directions pay for each other; a further move
    into a shard needs a free (unlinked) row there that can give way, or a place below the quota (over < 0)."""
    got = {k: min(n, wanted.get((k[1], k[0]), 0)) for k, n in wanted.items()}
    room = [f - o for f, o in zip(free, over, strict=True)]
    for k in sorted(wanted, key=lambda k: (-(wanted[k] - got[k]), k)):
        more = max(0, min(wanted[k] - got[k], room[k[1]]))
        got[k] += more
        room[k[1]] -= more
        room[k[0]] += more
    return {k: n for k, n in got.items() if n}


def _place(ws: Workspace, name: str, now: DataFrame, shards: int, quota: list[int]) -> DataFrame:
    """Rows of shards above their quota, unlinked ones first, fill the shards below it."""
    counts = {r[0]: r[1] for r in now.groupBy("_shard").count().collect()}  # one row for each shard
    over = {s: counts.get(s, 0) - quota[s] for s in range(shards)}
    if not any(over.values()):
        return now
    # of each shard that is too large, the first rows in a fixed order leave
    spec = ws.spark.createDataFrame([(s, n) for s, n in over.items() if n > 0], "_shard int, _leave long")
    ranked = running(ws, f"{name}_leave", now.join(F.broadcast(spec), "_shard"), "_shard", ["_linked", "_mix", "_row"], F.lit(1))
    leaving = ws.put(f"{name}_go", ranked.filter("before < _leave").select("_row", "_mix"))
    pool = running(ws, f"{name}_pool", leaving.withColumn("_all", F.lit(0)), "_all", ["_mix", "_row"], F.lit(1))
    holes, at = [], 0
    for s, n in over.items():
        if n < 0:
            holes.append((s, at, at - n))
            at -= n
    spec = F.broadcast(ws.spark.createDataFrame(holes, "_to int, _from long, _until long"))  # one row for each shard
    placed = pool.join(spec, (F.col("before") >= F.col("_from")) & (F.col("before") < F.col("_until"))).select("_row", "_to")
    return now.join(placed.hint("merge"), "_row", "left").withColumn("_shard", F.coalesce("_to", "_shard")).drop("_to")


def cut_links(held: DataFrame) -> int:
    """How many pairs of linked rows lie in different shards, of the rows of each group by shard."""
    by_group = held.groupBy("_group").agg(F.sum("_n").cast("decimal(38,0)").alias("_all"), F.sum(F.col("_n").cast("decimal(19,0)") * F.col("_n")).cast("decimal(38,0)").alias("_same"))
    return int(by_group.agg(F.sum(F.col("_all") * F.col("_all") - F.col("_same"))).first()[0] or 0) // 2


def shard_rows(ws: Workspace, rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(_row, _group) to (_row, _shard, _slot, _cut): shard sizes at most one apart, few links cut. _cut counts the rows
    of a row's group that lie in other shards; half their sum is the number of cut links.

    Linked rows start in the order of their groups, those of groups larger than a shard first, so that a group has at
    most ceil(size / quota) + 1 shards and all groups together are cut at most once at each border of two shards. In
    each round a join tells every linked row how many of its neighbours (the rows of its group) each shard holds; it
    wants the shard with most of them that isn't full of the group, unless its own is. Of the wanted moves, counted by
    (from, to), as many are done as the quotas let; whole groups move first to last in a fixed order. Then unlinked
    rows of shards above their quota fill those below. A move never gives a group a further shard. Rounds go on until
    no move fits or a round cuts no fewer links than the one before, so they end.
    _group null: unlinked. _row must be unique. Slots count from 0 in each shard without gaps.
    """
    sizes = rows.filter("_group is not null").groupBy("_group").agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    sizes = ws.put("groups", sizes)
    linked = rows.join(sizes, "_group", "left").select("_row", F.when(F.col("_size") > 1, F.col("_group")).alias("_group"), F.xxhash64("_row").alias("_mix"), "_size")
    linked = linked.withColumn("_linked", F.col("_group").isNotNull())
    total = rows.count()
    quota = quotas(total, shards)
    is_large = F.col("_size") > total // shards
    large, all_linked, widest = (x or 0 for x in sizes.agg(F.sum(F.when(is_large, F.col("_size"))), F.sum("_size"), F.max(F.when(~is_large, F.col("_size")))).first())
    order = linked.withColumns({"_small": (~F.coalesce(is_large, F.lit(False))).cast("int"), "_gmix": F.xxhash64("_group")})
    ranked = running(ws, "start", order, "_linked", ["_small", "_gmix", "_group", "_mix", "_row"], F.lit(1))
    spec = F.broadcast(ws.spark.createDataFrame(ranges(quota, large, all_linked, widest), "_of boolean, _from long, _until long, _shard int"))  # two rows for each shard
    placed = ranked.join(spec, (F.col("_linked") == F.col("_of")) & (F.col("before") >= F.col("_from")) & (F.col("before") < F.col("_until")))
    now = ws.put("shards0", placed.select("_row", "_group", "_mix", "_linked", "_shard"))
    ws.drop("start", "groups")
    has_room = F.col("_n") < F.lit(total // shards) + (F.col("_shard") < total % shards).cast("int")
    cuts, was = None, None
    for k in itertools.count(1):
        # neighbours by shard: at most `shards` rows for each group, pre-aggregated
        held = ws.put(f"held{k}", now.filter("_linked").groupBy("_group", "_shard").agg(F.count(F.lit(1)).alias("_n")))
        before, cuts = cuts, cut_links(held)
        if was and cuts > before:
            now, held = was
        if cuts == 0 or was and cuts >= before:
            break
        if was:
            ws.drop(f"shards{k - 2}", f"held{k - 1}")
        was = now, held
        full = F.broadcast(held.filter(~has_room).select("_group", "_shard"))  # one row for each shard at most
        best = held.filter(has_room).groupBy("_group").agg(F.max(F.struct("_n", (-F.xxhash64("_group", "_shard")).alias("_tie"), "_shard")).alias("_best")).select("_group", F.col("_best._shard").alias("_to"))
        best = ws.put(f"best{k}", best)
        moves = ws.put(f"moves{k}", now.filter("_linked").join(full, ["_group", "_shard"], "left_anti").join(best, "_group").filter("_shard <> _to").select("_row", "_group", "_shard", "_to", F.xxhash64("_group").alias("_gmix")))
        wanted = {(r[0], r[1]): r[2] for r in moves.groupBy("_shard", "_to").count().collect()}  # shards x shards rows
        stats = {r[0]: r for r in now.groupBy("_shard").agg(F.count(F.lit(1)), F.sum((~F.col("_linked")).cast("long"))).collect()}
        n = [stats[s][1] if s in stats else 0 for s in range(shards)]
        got = flows(wanted, [stats[s][2] if s in stats else 0 for s in range(shards)], [n[s] - quota[s] for s in range(shards)])
        if not got:
            break
        spec = F.broadcast(ws.spark.createDataFrame([(s, t, x) for (s, t), x in got.items()], "_shard int, _to int, _most long"))
        fit = running(ws, f"fit{k}", moves.join(spec, ["_shard", "_to"]).withColumn("_pair", F.col("_shard") * shards + F.col("_to")), "_pair", ["_gmix", "_group", "_row"], F.lit(1))
        done = ws.put(f"done{k}", fit.filter("before < _most").select("_row", "_to"))
        moved = ws.put(f"moved{k}", now.join(done.hint("merge"), "_row", "left").withColumn("_shard", F.coalesce("_to", "_shard")).drop("_to"))
        now = ws.put(f"shards{k}", _place(ws, f"place{k}", moved, shards, quota))
        ws.drop(f"best{k}", f"moves{k}", f"fit{k}", f"done{k}", f"moved{k}", f"place{k}_leave", f"place{k}_go", f"place{k}_pool")
    sizes = held.groupBy("_group").agg(F.sum("_n").alias("_all"))
    elsewhere = held.join(small(sizes), "_group").select("_group", "_shard", (F.col("_all") - F.col("_n")).alias("_cut")).filter("_cut > 0")
    slots = running(ws, "slots", now.select("_row", "_group", "_shard", "_mix"), "_shard", ["_mix", "_row"], F.lit(1))
    slots = slots.join(small(elsewhere), ["_group", "_shard"], "left")
    return ws.put("placed", slots.select("_row", "_shard", F.col("before").alias("_slot"), F.coalesce("_cut", F.lit(0)).alias("_cut")))


def text_key(text_col: str):
    """Equal texts share it; null texts count as equal to each other."""
    return F.coalesce(F.sha2(F.col(text_col).cast("binary"), 256), F.lit("null"))


def shard_documents(ws: Workspace, docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", cut_col: str | None = None) -> DataFrame:
    """docs with shard (0 to shards - 1) and slot (gapless from 0 in each shard); links: equal texts.

    Rows get a number of their own first, so repeated ids and null ids are rows like others; null texts are
    links of each other. Columns named shard or slot are replaced, others pass through, whatever their names. `cut_col`
    names a further column: how many rows with the same text lie in other shards.
    """
    pair = F.concat_ws("/", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_key(text_col))
    keyed = docs.select(pair.alias("_pair"), text_key(text_col).alias("_group"))
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"), pair.alias("_pair"), text_key(text_col).alias("_group"))
    if keyed.groupBy("_pair").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").limit(1).count():
        # the n-th of several equal rows: they differ in nothing that decides a shard, so any numbering of them serves
        numbered = running(ws, "numbered", base.withColumn("_any", F.monotonically_increasing_id()), "_pair", ["_any"], F.lit(1))
        base = numbered.withColumn("_nth", F.col("before") + 1)
        keyed = base.select("_pair", "_group", "_nth")
    else:
        base, keyed = (df.withColumn("_nth", F.lit(1)) for df in (base, keyed))
    key = F.concat_ws("/", "_pair", F.col("_nth").cast("string"))
    placed = shard_rows(ws, ws.put("rows", keyed.select(key.alias("_row"), "_group")), shards)
    joined = base.withColumn("_key", key).join(placed.hint("merge"), F.col("_key") == F.col("_row"))
    added = {"shard": F.col("_shard"), "slot": F.col("_slot")} | ({cut_col: F.col("_cut")} if cut_col else {})
    others = [inside(c).alias(c) for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    return joined.select(*others, *[c.alias(n) for n, c in added.items()])


def assignments(ws: Workspace, docs: DataFrame) -> DataFrame:
    """The shards of all documents under the law `rows`, with size and CRC of each text, and n_cut: how many
    documents with the same text lie in other shards.

    A null text has no bytes: size 1, CRC 0.
    """
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    narrow = docs.select("doc_id", "text").withColumns({"size": (F.octet_length(raw) + 1).cast("long"), "text_crc32": F.crc32(raw).cast("long")})
    out = shard_documents(ws, narrow, cut_col="n_cut")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "n_cut")
