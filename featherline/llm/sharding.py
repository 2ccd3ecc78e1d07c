"""Sharding by a k-d tree over metadata, with DataFrame functions only on the rows' path."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featherline.llm.common import materialize, table

#: Histogram cells of a node in one pass; a pass brings at most shards x BINS rows to the driver, whatever the table's size.
BINS = 512


def _code(c: Column) -> Column:
    """Nominal metadata as a number of 20 bits; null is 0."""
    return F.coalesce(F.pmod(F.xxhash64(c), F.lit(1 << 20)) + 1, F.lit(0))


def _cell(x: Column, lo: Column, hi: Column) -> Column:
    width = F.greatest(F.lit(1), F.floor((hi - lo) / BINS) + 1)
    return F.least(F.lit(BINS - 1), F.floor((x - lo) / width)).cast("int")


def fit_tree(points: DataFrame, dims: list[str], room: list[float], slack: float = 0.002) -> list[dict]:
    """Inner nodes of the tree: {node, left, right, dim, value, tie}. points: dims and tie (long), w (bytes).

    room: what each leaf is to hold, in proportion. All nodes of a level are split together. A node of k leaves is cut where
    the left part's weight is nearest to the share of room that its first floor(k/2) leaves have. The cut is found by histograms of weights, each narrowing the cell that holds the target; once
    the cell is one value of the dimension, its points are told apart by `tie`. It ends when the target is met within
    `slack` of a leaf or the cell is one point.
    """
    nodes = [{"id": 1, "first": 0, "room": room}]
    tree: list[dict] = []
    spans = None
    while nodes:
        todo = [n for n in nodes if len(n["room"]) > 1]
        if not todo:
            break
        at = points.withColumn("node", walk(tree, dims))
        stats = at.filter(F.col("node").isin([n["id"] for n in todo])).groupBy("node").agg(F.sum("w").alias("w"), *[f(d).alias(f"{g}_{d}") for d in [*dims, "tie"] for g, f in (("lo", F.min), ("hi", F.max))]).collect()
        stats = {r.node: r for r in stats}
        if spans is None:
            if not stats:
                return []
            r = stats[1]
            spans = {d: max(1, r[f"hi_{d}"] - r[f"lo_{d}"]) for d in dims}
        state = []
        for n in todo:
            r = stats.get(n["id"])
            if r is None:
                continue
            dim = max(dims, key=lambda d: (r[f"hi_{d}"] - r[f"lo_{d}"]) / spans[d])
            phase = "dim" if r[f"hi_{dim}"] > r[f"lo_{dim}"] else "tie"
            s = {"node": n["id"], "first": n["first"], "room": n["room"], "dim": dim, "phase": phase, "value": r[f"lo_{dim}"], "lo": r[f"lo_{dim}" if phase == "dim" else "lo_tie"], "hi": r[f"hi_{dim}" if phase == "dim" else "hi_tie"], "target": r["w"] * sum(n["room"][: len(n["room"]) // 2]) / (sum(n["room"]) or 1), "below": 0, "slack": slack * r["w"] / len(n["room"]), "done": False, "tie_lo": r["lo_tie"], "tie_hi": r["hi_tie"]}
            state.append(s)
        while open_ := [s for s in state if not s["done"]]:  # each pass leaves a 512th of a span; two spans of 63 bits at most
            pick = lambda key, s=open_: F.element_at(F.create_map(*[F.lit(v) for x in s for v in (x["node"], x[key])]), F.col("node"))
            rows = at.filter(F.col("node").isin([s["node"] for s in open_]))
            rows = rows.select("node", "w", "tie", _pick_dim(open_, dims).alias("x"), pick("lo").alias("lo"), pick("hi").alias("hi"), pick("value").alias("value"), pick("phase").alias("phase"))
            rows = rows.withColumn("y", F.when(F.col("phase") == "dim", F.col("x")).when(F.col("x") == F.col("value"), F.col("tie"))).filter("y >= lo and y <= hi")
            cells = rows.groupBy("node", _cell(F.col("y"), F.col("lo"), F.col("hi")).alias("cell")).agg(F.sum("w").alias("w"), F.min("y").alias("a"), F.max("y").alias("b"), F.min("tie").alias("ta"), F.max("tie").alias("tb")).collect()
            by: dict[int, list] = {}
            for c in cells:
                by.setdefault(c.node, []).append(c)
            for s in open_:
                _narrow(s, sorted(by.get(s["node"], []), key=lambda c: c.cell))
        nodes = []
        for s in state:
            left, right = 2 * s["node"], 2 * s["node"] + 1
            tree.append({"node": s["node"], "left": left, "right": right, "dim": s["dim"], "value": s["value"], "tie": s.get("cut", s["lo"])})
            half = len(s["room"]) // 2
            nodes += [{"id": left, "first": s["first"], "room": s["room"][:half]}, {"id": right, "first": s["first"] + half, "room": s["room"][half:]}]
            tree[-1] |= {"first": {left: s["first"], right: s["first"] + half}}
    return tree


def _narrow(s: dict, cells: list) -> None:
    """Move a node's search to the cell that holds the target, or end it at the border nearest to the target."""
    below = s["below"]
    for c in cells:
        if below + c.w < s["target"]:
            below += c.w
            continue
        low, high = s["target"] - below, below + c.w - s["target"]  # distance to the target at either border of the cell
        single = c.a == c.b and (s["phase"] == "tie" or c.ta == c.tb)
        if single or min(low, high) <= s["slack"]:
            s["done"] = True
            over = high <= low  # the cell goes left
            if s["phase"] == "tie":
                s["cut"] = c.b if over else c.a - 1
            else:
                s["value"], s["cut"] = (c.b, 1 << 62) if over else (c.a, -1)
        elif s["phase"] == "dim" and c.a == c.b:
            s |= {"phase": "tie", "value": c.a, "lo": c.ta, "hi": c.tb, "below": below, "cut": c.tb}
        else:
            s |= {"lo": c.a, "hi": c.b, "below": below} | ({"cut": c.b} if s["phase"] == "tie" else {"value": c.b, "cut": 1 << 62})
        return
    s["done"] = True
    if cells:
        s |= {"cut": cells[-1].b} if s["phase"] == "tie" else {"value": cells[-1].b, "cut": 1 << 62}


def _pick_dim(state: list[dict], dims: list[str]) -> Column:
    out = F.lit(None).cast("long")
    for d in dims:
        if own := [s["node"] for s in state if s["dim"] == d]:
            out = F.when(F.col("node").isin(own), F.col(d)).otherwise(out)
    return out


def walk(tree: list[dict], dims: list[str]) -> Column:
    """The leaf that a row's dims and tie lead to: at most one step a level over a literal table of nodes."""
    if not tree:
        return F.lit(1)
    table_ = F.create_map(*[x for t in tree for x in (F.lit(t["node"]), F.struct(F.lit(dims.index(t["dim"])).alias("d"), F.lit(t["value"]).cast("long").alias("v"), F.lit(t["tie"]).cast("long").alias("t")))])
    point = F.struct(F.array(*[F.col(d) for d in dims]).alias("x"), F.col("tie").alias("tie"))
    depth = 1 + max(int(math.log2(t["node"])) for t in tree)

    def step(node: Column, _: Column) -> Column:
        t = F.try_element_at(table_, node)
        x = F.get(point["x"], t["d"])
        return F.when(t.isNull(), node).when((x < t["v"]) | ((x == t["v"]) & (point["tie"] <= t["t"])), node * 2).otherwise(node * 2 + 1)

    return F.aggregate(F.array(*[F.lit(i) for i in range(depth)]), F.lit(1), step)


def shard(docs: DataFrame, *, shards: int = 40, text: str = "text", nominal: tuple[str, ...] = ("source", "lang"), doc_id: str = "doc_id", heavy: float = 1 / 16, salt: int = 64) -> DataFrame:
    """Shards of near equal bytes: a k-d tree over text length, source and language, cut at weighted medians.

    Equal texts are one point (bytes summed, the least of their codes), so copies share a shard and the tree reads one row a
    text. Groups of more than `heavy` of a shard's bytes (at most shards / heavy of them) are placed first, each whole in the
    emptiest shard, and the tree fills what room is left; only a group that no shard has room for is dealt document by
    document, as equal bytes ask. Null texts count as empty, null metadata as code 0, and columns besides those named are
    ignored. Slots are numbered within a shard over `salt` parts, so no task holds a whole shard. Repeated rows keep a slot
    each; an empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    dims = ["bytes", *[f"c{i}" for i in range(len(nominal))]]
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("g"), *[_code(F.col(c)).alias(f"c{i}") for i, c in enumerate(nominal)])
    base = materialize(base.withColumn("bytes", F.col("size")).withColumn("own", F.shiftrightunsigned(F.xxhash64("doc_id", "g", F.monotonically_increasing_id()), 3)), "shard-docs")
    total = base.agg(F.sum("size")).first()[0] or 0
    codes = dims[1:]
    grouped = base.groupBy("g").agg(F.sum("size").alias("w"), F.min("bytes").alias("bytes"), *[F.min(c).alias(c) for c in codes])
    large = sorted((-r.w, r.g) for r in grouped.filter((F.col("w") > total / shards * heavy) & (F.col("w") > F.col("bytes"))).select("w", "g").collect())
    load, whole, split = [0] * shards, {}, []
    for w, g in large:
        i = min(range(shards), key=load.__getitem__)
        if load[i] - w <= total / shards * 1.005:
            load[i] -= w
            whole[g] = i
        else:
            split.append(g)
    alone, is_whole = (F.col("g").isin(list(x)) if x else F.lit(False) for x in (split, whole))
    groups = grouped.filter(~alone & ~is_whole).withColumn("tie", F.shiftrightunsigned(F.xxhash64("g"), 3))
    single = base.filter(alone)
    points = groups.select("w", "tie", *dims).unionByName(single.select(F.col("size").alias("w"), F.col("own").alias("tie"), *dims))
    points = materialize(points, "shard-points")
    tree = fit_tree(points, dims, [max(0.0, total / shards - x) for x in load])
    leaves = sorted({c for t in tree for c in (t["left"], t["right"])} - {t["node"] for t in tree}) or [1]
    first = {1: 0} | {n: i for t in tree for n, i in t["first"].items()}
    number = F.element_at(F.create_map(*[F.lit(v) for n in leaves for v in (n, first[n])]), walk(tree, dims)).alias("shard")
    of_group = groups.select("g", number)
    if whole:
        of_group = of_group.unionByName(grouped.filter(is_whole).select("g", F.element_at(F.create_map(*[F.lit(v) for g, i in whole.items() for v in (g, i)]), F.col("g")).alias("shard")))
    placed = base.filter(~alone).select("doc_id", "size", "text_crc32", "g", "own").join(of_group, "g")
    placed = placed.unionByName(single.withColumn("tie", F.col("own")).select("doc_id", "size", "text_crc32", "g", "own", number))
    placed = materialize(placed.withColumn("part", F.pmod(F.col("own"), F.lit(salt)).cast("int")), "shard-placed")
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    within = placed.withColumn("i", F.row_number().over(Window.partitionBy("shard", "part").orderBy("own")))
    out = within.join(F.broadcast(before), ["shard", "part"])  # at most shards x salt rows
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("i") - 1 + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
