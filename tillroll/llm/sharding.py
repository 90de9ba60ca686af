"""Sharding by a k-d tree: splits at weighted medians along the widest metadata dimension until shards are small.

Every dimension is scaled to a 62-bit integer: 22 bits of the value, then 40 bits of hashes of the row, so that
values that many rows share still split anywhere. Where rows form groups, the group's hash comes first. A node that
is to become n shards is cut where the weight below is as n // 2 to n, a median for even n. Cuts of all nodes of a
level are found together: a histogram of weights per node, refined around the cut until one bin is light enough.
The driver keeps the first ``DRIVER_NODES`` nodes; below them, nodes and histograms are tables like the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.llm.common import forget, keep, lookup

VALUE_BITS, TIE_BITS, ROW_BITS, BIN_BITS = 22, 40, 22, 12
#: A cut is fine enough when the bin around it has at most this share of a shard's target weight, or, if the bin is
#: a single group, the second share.
TOLERANCE, GROUP_TOLERANCE = 0.001, 0.005
#: Leaves of the tree that the driver holds; it reads at most so many histograms of 2 ** ``BIN_BITS`` bins at a time.
DRIVER_NODES = 256
#: Slots are numbered in parts of a shard, each by one task: so many of a shard, and of all shards together, where
#: there are fewer shards than that. Their counts are broadcast.
SLOT_PARTS, ALL_PARTS = 256, 10_240


@dataclass
class Node:
    """A box of the tree: ``shards`` from ``first`` on; after its split the cut's dimension, key and two halves."""

    first: int
    shards: int
    dim: int = -1
    cut: int = 0
    halves: tuple[Node, Node] | None = None

    def leaves(self) -> list[Node]:
        return [x for h in self.halves for x in h.leaves()] if self.halves else [self]

    def shard(self, keys: list[Column]) -> Column:
        """First shard and number of shards of the leaf that a row with these keys falls into."""
        if not self.halves:
            return F.struct(F.lit(self.first).alias("first"), F.lit(self.shards).alias("shards"))
        low, high = self.halves
        return F.when(keys[self.dim] <= self.cut, low.shard(keys)).otherwise(high.shard(keys))


def dimension_keys(df: DataFrame, dims: list[Column], tie: Column, group: Column | None = None) -> list[Column]:
    """The scaled dimensions of ``df``; NULL values lie below all others. One aggregate finds their ranges.

    Rows of one value follow each other by ``group``, if given, and then by ``tie``.
    """
    dims = [d.cast("double") for d in dims]
    bounds = df.agg(*[f(F.nanvl(d, F.lit(None))).alias(f"{n}{k}") for k, d in enumerate(dims)
                      for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if group is None:
        tie = F.pmod(F.xxhash64(F.lit(17), tie), F.lit(1 << TIE_BITS))
    else:
        tie = F.pmod(F.xxhash64(F.lit(19), group), F.lit(1 << (TIE_BITS - ROW_BITS))) * (1 << ROW_BITS) + F.pmod(
            F.xxhash64(F.lit(17), tie), F.lit(1 << ROW_BITS))
    out = []
    for k, d in enumerate(dims):
        lo, hi = bounds[f"lo{k}"], bounds[f"hi{k}"]
        lo, width = (0.0, 0.0) if lo is None else (lo, hi - lo)
        scaled = F.nanvl((d - lo) / width, F.lit(None)) * ((1 << VALUE_BITS) - 2) + 1 if width else d * 0 + 1
        value = F.coalesce(F.least(scaled, F.lit(float((1 << VALUE_BITS) - 1))).cast("long"), F.lit(0).cast("long"))
        out.append(value * (1 << TIE_BITS) + tie)
    return out


def fit_tree(keyed: DataFrame, keys: list[str], weight: str, shards: int, light: float, heavy: float) -> Node:
    """The tree of ``shards`` leaves with near equal ``weight``; ``keyed`` has the scaled dimensions.

    Bins up to ``light`` are not refined, nor those up to ``heavy`` that part rows of one group only. With more than
    ``DRIVER_NODES`` shards the tree ends at that many leaves at most, of several shards each.
    """
    root = Node(0, shards)
    columns = [F.col(k) for k in keys]
    while open_nodes := [x for x in root.leaves() if x.shards > 1]:
        if shards > DRIVER_NODES < 2 * len(root.leaves()):
            break
        placed = keyed.withColumn("__node", root.shard(columns)["first"])
        ids = [x.first for x in open_nodes]
        stats = {r["__node"]: r for r in placed.where(F.col("__node").isin(ids)).groupBy("__node").agg(
            F.sum(weight).alias("w"), *[f(k).alias(f"{n}_{k}") for k in keys for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
        search = {}
        for node in open_nodes:
            found = stats.get(node.first)
            widths = [found[f"hi_{k}"] - found[f"lo_{k}"] if found else 0 for k in keys]
            node.dim = max(range(len(keys)), key=lambda k: widths[k])
            name = keys[node.dim]
            lo, hi = (found[f"lo_{name}"], found[f"hi_{name}"]) if found else (0, 0)
            goal = (found["w"] if found else 0) * (node.shards // 2) / node.shards
            search[node.first] = [lo, hi, goal]  # the cut is in [lo, hi], with weight `goal` still to come from lo on
            node.cut = hi
        while search:
            shifts = {n: max(0, (hi - lo).bit_length() - BIN_BITS) for n, (lo, hi, _) in search.items()}
            key = bin_of = None
            for node in (x for x in open_nodes if x.first in search):
                lo, hi, _ = search[node.first]
                is_node, k = F.col("__node") == node.first, F.col(keys[node.dim])
                inside = is_node & (k >= lo) & (k <= hi)
                cell = F.shiftright(k - lo, shifts[node.first])
                key = inside if key is None else key | inside
                bin_of = F.when(is_node, cell) if bin_of is None else bin_of.when(is_node, cell)
            bins = placed.where(key).groupBy("__node", bin_of.alias("__bin")).agg(F.sum(weight).alias("w")).collect()
            by_node: dict[int, list] = {}
            for r in bins:
                by_node.setdefault(r["__node"], []).append((r["__bin"], r["w"]))
            for node in open_nodes:
                if node.first not in search:
                    continue
                lo, hi, goal = search.pop(node.first)
                below = 0
                for cell, w in sorted(by_node.get(node.first, [])):
                    if below + w >= goal:
                        start = lo + (cell << shifts[node.first])
                        end = min(hi, start + (1 << shifts[node.first]) - 1)
                        node.cut = end if goal - below > below + w - goal else start - 1
                        if shifts[node.first] and w > (heavy if shifts[node.first] <= ROW_BITS else light):
                            search[node.first] = [start, end, goal - below]
                        break
                    below += w
        for node in open_nodes:
            half = node.shards // 2
            node.halves = (Node(node.first, half), Node(node.first + half, node.shards - half))
    return root


def split_level(rows: DataFrame, keys: list[str], weight: str, light: float, heavy: float) -> DataFrame:
    """Cuts each node of several shards in two; ``rows`` have their node's first shard and number of shards as
    ``__first`` and ``__shards``. The rule is that of ``fit_tree``, but nodes, histograms and cuts stay on executors."""
    few = rows.where(F.col("__shards") > 1)
    ranges = few.groupBy("__first", "__shards").agg(
        F.sum(weight).alias("w"), F.array(*[F.min(k) for k in keys]).alias("los"), F.array(*[F.max(k) for k in keys]).alias("his"))
    widths = F.zip_with("his", "los", lambda hi, lo: hi - lo)
    ranges = ranges.withColumn("dim", F.array_position(widths, F.array_max(widths)).cast("int"))
    state = keep(ranges.select("__first", "dim", F.element_at("los", F.col("dim")).alias("lo"), F.element_at("his", F.col("dim")).alias("hi"),
                               (F.col("w") * F.floor(F.col("__shards") / 2) / F.col("__shards")).alias("goal")), "shard-search")
    key, shift = F.element_at(F.array(*keys), F.col("dim")), F.greatest(F.lit(0), F.length(F.bin(F.col("hi") - F.col("lo"))) - BIN_BITS)
    found, read = None, [state]
    while state.limit(1).count():
        near = few.join(state, "__first").withColumn("key", key).where(F.col("key").between(F.col("lo"), F.col("hi")))
        near = near.withColumn("shift", shift).withColumn("cell", F.call_function("shiftright", F.col("key") - F.col("lo"), F.col("shift")))
        same = ["__first", "dim", "lo", "hi", "goal", "shift"]
        bins = near.groupBy(*same, "cell").agg(F.sum(weight).alias("w"))
        upto = F.sum("w").over(W.partitionBy("__first").orderBy("cell").rowsBetween(W.unboundedPreceding, W.currentRow))
        hit = bins.withColumn("upto", upto).where(F.col("upto") >= F.col("goal")).groupBy(*same).agg(
            F.min(F.struct("cell", "w", "upto")).alias("bin")).select(*same, "bin.*")
        start = F.col("lo") + F.call_function("shiftleft", F.col("cell"), F.col("shift"))
        hit = hit.withColumn("start", start).withColumn("below", F.col("upto") - F.col("w")).withColumn(
            "end", F.least("hi", F.col("start") + F.call_function("shiftleft", F.lit(1).cast("long"), F.col("shift")) - 1))
        late = F.col("goal") - F.col("below") > F.col("upto") - F.col("goal")
        enough = F.when(F.col("shift") <= ROW_BITS, F.lit(heavy)).otherwise(F.lit(light))
        hit = keep(hit.select("__first", "dim", F.when(late, F.col("end")).otherwise(F.col("start") - 1).alias("cut"),
                              F.col("start").alias("lo"), F.col("end").alias("hi"), (F.col("goal") - F.col("below")).alias("goal"),
                              ((F.col("shift") > 0) & (F.col("w") > enough)).alias("more")), "shard-search")
        read.append(hit)
        cuts = hit.where(~F.col("more")).select("__first", "dim", "cut")
        found = cuts if found is None else found.union(cuts)
        state = hit.where("more").drop("cut", "more")
    if found is None:
        return rows
    half = F.floor(F.col("__shards") / 2).cast("int")
    low, node = F.col("__key") <= F.col("cut"), F.col("cut").isNotNull()
    out = rows.join(found, "__first", "left").withColumn("__key", key).select(
        *[c for c in rows.columns if c not in ("__first", "__shards")],
        F.when(node & ~low, F.col("__first") + half).otherwise(F.col("__first")).alias("__first"),
        F.when(node & low, half).when(node, F.col("__shards") - half).otherwise(F.col("__shards")).alias("__shards"))
    out = keep(out, "shard-level")
    forget(*read)
    return out


def shard_rows(df: DataFrame, dims: list[Column], weight: Column, tie: Column, shards: int | None = None,
               target_bytes: int | None = None, group: Column | None = None) -> DataFrame:
    """Adds ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard) to every row of ``df``.

    Give the number of shards, or ``target_bytes`` for the weight a shard is to have at most, nearly. ``dims`` are
    the metadata dimensions; ``tie`` tells rows apart whose dimensions are equal. Rows that agree in ``group`` and
    ``dims`` stay together unless the group is heavier than ``GROUP_TOLERANCE`` of a shard and lies on a cut; without
    ``group``, rows that agree in ``dims`` are parted anywhere. NULL dimensions lie below all others; an empty table
    gives no rows. Columns called ``shard`` or ``slot`` are replaced. Only keys and weights are read while the tree
    is fitted.
    """
    weighted = df.withColumn("__weight", weight.cast("long"))
    total = weighted.agg(F.coalesce(F.sum("__weight"), F.lit(0)).alias("w")).first()["w"]
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    light = max(1.0, TOLERANCE * total / shards)
    heavy = light if group is None else max(light, GROUP_TOLERANCE * total / shards)
    names = [f"__dim{k}" for k in range(len(dims))]
    keyed = keep(weighted.withColumns(dict(zip(names, dimension_keys(df, dims, tie, group)))), "shard-keys")
    tree = fit_tree(keyed.select(*names, "__weight"), names, "__weight", shards, light, heavy)
    leaf = tree.shard([F.col(n) for n in names])
    rows = keyed.withColumn("__leaf", leaf).withColumns({"__first": F.col("__leaf.first"), "__shards": F.col("__leaf.shards")}).drop("__leaf")
    older = keyed
    for _ in range((max(x.shards for x in tree.leaves()) - 1).bit_length()):
        rows = split_level(rows, names, "__weight", light, heavy)
        forget(older)
        older = rows
    parts = max(1, min(SLOT_PARTS, ALL_PARTS // shards))
    placed = rows.withColumnRenamed("__first", "__shard").withColumn("__part", F.pmod(F.xxhash64(F.lit(23), tie), F.lit(parts)).cast("int"))
    placed = placed.drop(*names, "__weight", "__shards", "shard", "slot")
    order = W.partitionBy("__shard", "__part").orderBy(F.xxhash64(F.lit(29), tie), tie)
    out = placed.withColumn("__row", F.row_number().over(order))
    if parts > 1:
        counts = placed.groupBy("__shard", "__part").agg(F.count(F.lit(1)).alias("__n"))
        before = F.sum("__n").over(W.partitionBy("__shard").orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
        counts = counts.select("__shard", "__part", F.coalesce(before, F.lit(0)).alias("__before"))
        out = out.join(F.broadcast(counts), ["__shard", "__part"])  # ALL_PARTS rows at most
    else:
        out = out.withColumn("__before", F.lit(0))
    plain = [c for c in df.columns if c not in ("shard", "slot")]
    return out.select(*plain, F.col("__shard").alias("shard"), (F.col("__before") + F.col("__row") - 1).cast("long").alias("slot"))


def op10_kd_sharding(spark, sf_dir: str, shards: int = 40) -> DataFrame:
    """The copies of a text share one place in all dimensions, that of the group's least source and language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    meta = keep(docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                            F.hex(F.xxhash64(text)).alias("key"), F.xxhash64("source").alias("source"), F.xxhash64("lang").alias("lang")), "shard-meta")
    copies = meta.groupBy("key").agg(F.min("source").alias("source"), F.min("lang").alias("lang"), F.count(F.lit(1)).alias("copies"))
    copies = keep(copies.where(F.col("copies") > 1), "shard-copies").withColumnsRenamed({"source": "least_source", "lang": "least_lang"})
    meta = lookup(meta, copies, "key", "copies", F.xxhash64("doc_id"))
    dims = [F.log2("size"), F.coalesce("least_source", "source"), F.coalesce("least_lang", "lang"), F.col("text_crc32")]
    out = shard_rows(meta, dims, F.col("size"), F.struct("doc_id", "text_crc32"), shards, group=F.col("key"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
