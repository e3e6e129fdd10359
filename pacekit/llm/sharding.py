"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Rows fall into P hashed partitions; their counts are P numbers.
2. The matrix of rows that partition p sends to shard s is drawn row by row
   from the multivariate hypergeometric law with the shard sizes as margins, so
   every shard gets exactly its size. P is at most ``MAX_PARTITIONS`` whatever
   the input, so the P x S matrix is bounded (4096 x 8 numbers by default) and
   is drawn on the driver and broadcast.
3. Each partition permutes its rows (ranks of a seeded hash) and cuts the
   permutation by its row of the matrix. The hashes at the cuts, at most P x S
   numbers, are broadcast: with them a row finds its shard where it is read. Rows
   of one hash on both sides of a cut (repeated keys) are ranked among themselves.
4. Each shard is permuted again: a second hash orders the rows, in blocks by
   ranges of it, and prefix sums over the blocks give gapless slots without
   sorting a shard in one task.
5. Steps 1 to 3 and the sizes of the blocks see the key columns only. The rows
   themselves, all columns, go through one exchange that sends each block to a
   task of its own, where they are sorted by the second hash.

So a task writes one shard, one file, in the order of its slots: each file and folder
that an executor makes on a local file system may cost it a command (``chmod``), and
until that starts, its process counts with all the memory of the JVM.

The law is ``rows``: shard counts are at most one apart. Defined cases: null
texts have size 1 and the CRC of no bytes; repeated rows are separate listings;
an empty table gives no rows; a null id is an ordinary value.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacekit.llm.common import unit_hash

MAX_PARTITIONS = 4096
PARTITION_ROWS = 20_000
LEAST_BLOCK_ROWS = 500


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows from each partition to each shard; column sums differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(counts)
    left = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    out = []
    for n in counts:
        drawn = rng.multivariate_hypergeometric(left, n, method="marginals") if n else 0 * left
        left = left - drawn
        out.append([int(x) for x in drawn])
    return out


def shuffle_to_shards(docs: DataFrame, shards: int = 8, keys: tuple[str, ...] = ("doc_id",),
                      seed: int = 20240, max_partitions: int = MAX_PARTITIONS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (gapless from 0 in each shard), replaced if present.

    ``keys`` are the columns that tell rows apart; rows equal in all of them are
    interchangeable. A partition of the result holds one block: a run of slots of one shard, in order.
    """
    docs = docs.drop("shard", "slot")
    names = list(keys)
    rows = docs.select(*names)
    total = rows.count()
    parts = max(1, min(max_partitions, -(-total // PARTITION_ROWS)))
    bounds, tied = cuts(parted(rows, names, seed, parts), parts, shards, seed)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, min(-(-tasks // shards), total // (shards * LEAST_BLOCK_ROWS)))

    def placed(df: DataFrame) -> DataFrame:
        sent = sent_to_shards(parted(df, names, seed, parts), bounds, tied, names)
        unit = unit_hash(F.lit(seed + 2), *names)
        return (sent.withColumn("_unit", unit)
                .withColumn("_block", F.col("shard") * blocks + F.floor(F.col("_unit") * blocks).cast("int")))

    sizes = placed(rows).groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy("shard", "_block").orderBy("_unit", *names)
    return (placed(docs).repartitionById(shards * blocks, F.col("_block"))
            .withColumn("_in", F.row_number().over(inner) - 1)
            .join(F.broadcast(offsets), "_block")          # a row a task
            .withColumn("slot", (F.col("_off") + F.col("_in")).cast("long"))
            .select(*docs.columns, "shard", "slot"))


def parted(df: DataFrame, names: list[str], seed: int, parts: int) -> DataFrame:
    """``df`` with the hashed partition ``_part`` and ``_hash``, by which a partition permutes its rows."""
    part = F.pmod(F.xxhash64(F.lit(seed), *names), F.lit(parts)).cast("int")
    return df.withColumn("_part", part).withColumn("_hash", F.xxhash64(F.lit(seed + 1), *names))


def cuts(rows: DataFrame, parts: int, shards: int, seed: int) -> tuple[DataFrame, bool]:
    """Per ``_part`` of ``parted`` rows: ``_to``, the row of the matrix summed up; ``_cuts``, the hash at each
    of these places that has a row; ``_runs``, where a hash on both sides of a cut begins. And whether any is.
    """
    spark = rows.sparkSession
    rows = rows.select("_part", "_hash")
    counts = {r["_part"]: r["count"] for r in rows.groupBy("_part").count().collect()}
    matrix = communication_matrix([counts.get(p, 0) for p in range(parts)], shards, seed)
    to = [[int(x) for x in np.cumsum(row)] for row in matrix]
    local = Window.partitionBy("_part").orderBy("_hash")
    at = (rows.withColumn("_at", F.row_number().over(local) - 1).withColumn("_start", F.rank().over(local) - 1)
          .join(F.broadcast(spark.createDataFrame(list(enumerate(to)), "_part int, _to array<bigint>")), "_part")
          .filter(F.array_contains("_to", F.col("_at").cast("long"))))
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for r in at.select("_part", "_at", "_hash", "_start").collect():     # at most parts x shards rows
        found.setdefault(r["_part"], {})[r["_at"]] = (r["_hash"], r["_start"])
    table = []
    for p, places in enumerate(to):
        here = found.get(p, {})
        table.append((p, places, [here[x][0] for x in places if x in here],
                      [h for x, h in here.items() if h[1] < x]))
    bounds = spark.createDataFrame(
        table, "_part int, _to array<bigint>, _cuts array<bigint>, _runs array<struct<hash: bigint, start: bigint>>")
    return bounds, any(runs for *_, runs in table)


def sent_to_shards(df: DataFrame, bounds: DataFrame, tied: bool, names: list[str]) -> DataFrame:
    """``parted`` rows with their shard: the number of cuts at or before them in the partition's permutation."""
    df = df.join(F.broadcast(bounds), "_part")
    by_hash = F.size(F.filter("_cuts", lambda c: c <= F.col("_hash"))).cast("int")
    if not tied:
        return df.withColumn("shard", by_hash).drop("_part", "_hash", "_to", "_cuts", "_runs")
    run = F.filter("_runs", lambda r: r["hash"] == F.col("_hash"))
    df = df.withColumn("_start", F.get(run, F.lit(0))["start"])
    rank = F.row_number().over(Window.partitionBy("_part", "_hash").orderBy(*names)) - 1
    ranked = (df.filter("_start is not null").withColumn("_at", F.col("_start") + rank)
              .withColumn("shard", F.size(F.filter("_to", lambda x: x <= F.col("_at"))).cast("int")).drop("_at"))
    return (df.filter("_start is null").withColumn("shard", by_hash).unionAll(ranked)
            .drop("_part", "_hash", "_to", "_cuts", "_runs", "_start"))
