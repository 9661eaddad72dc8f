"""Balanced label propagation: shards of exactly even row counts that keep linked documents together.

Documents with the same link value (by default: the same text) are linked. All documents start in shards
by hash. Linked ones are kept as lots (link, slice of the hash) with their counts, so that a group of any
size is a bounded number of rows. In each round every lot joins what its group has in each shard, and wants
to go where most of its neighbours are (a group larger than a shard: to its fullest shards). Moves obey
quotas for each pair of shards: what wants the opposite way can be exchanged, and a shard with room left
takes more, those with the greatest gain first. Rounds end when nothing moves. At last unlinked documents
fill the shards up, and where they do not suffice the last rows of overfull shards go to others, so that
row counts differ by one at most; every row gets its slot in its shard.

Only DataFrame operations. What reaches the driver is one row per shard; the one broadcast has a row per
pair of shards at most.

Defined results: null texts are linked to nothing, empty texts to each other; equal rows are told apart
only by their slots; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rhythmica.session import settled

ROUNDS = 8
#: Lots of a group for each shard, and slices of equal gain.
LOTS, SLICES = 8, 64
#: Buckets of a shard in which rows are numbered, at least, and rows in one, about.
BUCKETS, BUCKET_ROWS = 32, 200_000


def cut_links(placed: DataFrame, link: str, shard: str = "shard") -> int:
    """Pairs of linked documents in different shards."""
    cells = placed.where(F.col(link).isNotNull()).groupBy(link, shard).agg(F.count(F.lit(1)).alias("n"))
    pairs = lambda n: n * (n - 1) / 2
    groups = cells.groupBy(link).agg((pairs(F.sum("n")) - F.sum(pairs(F.col("n")))).alias("cut"))
    return int(groups.agg(F.coalesce(F.sum("cut"), F.lit(0))).first()[0])


def propagate(lots: DataFrame, capacity: int, shards: int, rounds: int) -> DataFrame:
    """Lots (link, lot, n, shard) after the moves."""
    for turn in range(rounds):
        votes = lots.groupBy("link", "shard").agg(F.sum("n").alias("v"))
        ordered = Window.partitionBy("link").orderBy(F.desc("v"), F.xxhash64("link", "shard"))
        ranked = votes.withColumn("place", F.row_number().over(ordered)).withColumn("all", F.sum("v").over(Window.partitionBy("link")))
        goals = ranked.where(F.col("place") <= F.ceil(F.col("all") / max(1, capacity))).groupBy("link").agg(F.array_sort(F.collect_list(F.struct("place", "shard", "v"))).alias("goals"))
        goal = F.element_at("goals", (F.pmod(F.xxhash64("link", "lot"), F.size("goals")) + 1).cast("int"))
        seen = lots.join(goals, "link").join(votes, ["link", "shard"]).withColumn("goal", goal)
        wants = ~F.exists("goals", lambda g: g["shard"] == F.col("shard")) & (F.col("goal.v") >= F.col("v"))
        gain = F.floor(F.log2(F.col("goal.v") - F.col("v") + 1)).cast("int")
        turn_slice = F.pmod(F.xxhash64("link", "lot", F.lit(turn)), F.lit(SLICES)).cast("int")
        seen = settled(seen.select("link", "lot", "n", "shard", F.when(wants, F.col("goal.shard")).alias("to"), F.when(wants, (63 - gain) * SLICES + turn_slice).alias("queue")), "wishes")

        wanted = seen.where("to IS NOT NULL").groupBy(F.col("shard").alias("s"), F.col("to").alias("t")).agg(F.sum("n").alias("w"))
        back = wanted.select(F.col("s").alias("t"), F.col("t").alias("s"), F.col("w").alias("back"))
        room = seen.groupBy(F.col("shard").alias("t")).agg((F.lit(capacity) - F.sum("n")).alias("room"))
        flows = wanted.join(back, ["s", "t"], "left").join(room, "t", "left")
        flows = flows.withColumn("swap", F.least("w", F.coalesce("back", F.lit(0)))).withColumn("over", F.col("w") - F.col("swap"))
        share = F.greatest(F.lit(0), F.coalesce("room", F.lit(capacity))) * F.col("over") / F.greatest(F.lit(1), F.sum("over").over(Window.partitionBy("t")))
        quotas = flows.select("s", "t", (F.col("swap") + F.least(F.col("over"), F.floor(share))).alias("quota"))
        queue = seen.where("to IS NOT NULL").groupBy(F.col("shard").alias("s"), F.col("to").alias("t"), "queue").agg(F.sum("n").alias("n"))
        queue = queue.withColumn("so_far", F.sum("n").over(Window.partitionBy("s", "t").orderBy("queue")))
        last = queue.join(quotas, ["s", "t"]).where("so_far <= quota").groupBy("s", "t").agg(F.max("queue").alias("last"))

        goes = F.coalesce(F.col("queue") <= F.col("last"), F.lit(False))
        moved = seen.join(F.broadcast(last), (F.col("shard") == F.col("s")) & (F.col("to") == F.col("t")), "left")
        moved = moved.select("link", "lot", "n", F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard"), goes.alias("moved"))
        moved = settled(moved, "lots")
        lots = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    return lots


def balanced_shards(docs: DataFrame, shards: int, link: Column | None = None, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size (bytes of the text and 8), text_crc32, link, shard, slot."""
    content = F.col(text_col).cast("string").cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(content), F.lit(0)).cast("bigint") + 8).alias("size"),
        F.coalesce(F.crc32(content), F.lit(0)).cast("bigint").alias("text_crc32"),
        (F.unhex(F.sha2(content, 256)) if link is None else link).alias("link"),
    )
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text_crc32", "size"))
    rows = settled(rows.withColumn("lot", F.pmod("key", F.lit(shards * LOTS)).cast("int")), "rows")
    total = rows.count()
    even, extra = divmod(total, shards)

    known = rows.where("link IS NOT NULL").groupBy("link", "lot").agg(F.count(F.lit(1)).alias("n"))
    known = settled(known.withColumn("all", F.sum("n").over(Window.partitionBy("link"))).where("all > 1").select("link", "lot", "n", (F.col("lot") % shards).alias("shard")), "lots")
    lots = propagate(known, even, shards, rounds).select("link", "lot", F.col("shard").alias("moved_to"))

    # rows of a shard: linked ones first, numbered bucket by bucket
    buckets = max(BUCKETS, -(-even // BUCKET_ROWS))
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)) + F.when(F.col("moved_to").isNull(), buckets).otherwise(0)
    placed = rows.join(lots, ["link", "lot"], "left").withColumn("bucket", bucket.cast("int")).withColumn("shard", F.coalesce("moved_to", F.col("lot") % shards))
    placed = settled(placed.select("doc_id", "size", "text_crc32", "link", "key", "bucket", "shard"), "placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("key", "doc_id")) - 1
    numbered = placed.withColumn("own", own).join(before, ["shard", "bucket"]).withColumn("at", F.col("before") + F.col("own"))

    found = {r.shard: r.n for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    loads = [found.get(s, 0) for s in range(shards)]
    capacity = [even + (s < extra) for s in range(shards)]
    over, under = [0], [0]  # running sums of rows above and places below the capacity
    for n, c in zip(loads, capacity, strict=True):
        over.append(over[-1] + max(0, n - c))
        under.append(under[-1] + max(0, c - n))
    of = lambda values, at: F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), at.cast("int") + 1)
    surplus = F.col("at") >= of(capacity, F.col("shard"))
    numbered = numbered.withColumn("rest", F.when(surplus, of(over, F.col("shard")) + F.col("at") - of(capacity, F.col("shard"))))
    target = F.size(F.filter(F.array(*[F.lit(v).cast("bigint") for v in under[1:]]), lambda end: end <= F.col("rest")))
    numbered = numbered.withColumn("target", F.when(F.col("rest").isNotNull(), target))
    slot = F.when(F.col("target").isNull(), F.col("at")).otherwise(of(loads, F.col("target")) + F.col("rest") - of(under, F.col("target")))
    return numbered.select("doc_id", "size", "text_crc32", "link", F.coalesce("target", "shard").cast("int").alias("shard"), slot.cast("bigint").alias("slot"))
