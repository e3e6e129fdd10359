import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pacekit.llm import sharding
from pacekit.llm.common import stored, unit_hash
from pacekit.llm.exact_dedup import build_index, directory, drop_exact_copies, exact_dedup, look_up, routed
from pacekit.llm.mixing import mix, targets
from pacekit.llm.sharding import communication_matrix, shuffle_to_shards
from tests.llm.helpers import awkward, clashing, docs


def test_exact_dedup_matches_brute_force(spark):
    df = clashing(awkward(spark))
    got = exact_dedup(df).collect()
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    assert len(got) == len(rows)
    for r in got:
        ids = next(v for t, v in groups.items()
                   if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    left = drop_exact_copies(df)
    assert left.columns == df.columns and left.count() == len(groups)
    assert exact_dedup(docs(spark, [])).count() == 0


def test_directory_doubles_only_overfull_buckets(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("key"))
    hot = keys.unionAll(keys.limit(1).crossJoin(spark.range(5000)).select("key"))
    d = {r.cell: r.depth for r in directory(hot, capacity=100, max_depth=10).collect()}
    fill, cells = Counter(), Counter()
    for r in keys.collect():
        c = (r.key % (1 << 64)) >> 54
        fill[d[c], c >> (10 - d[c])] += 1
    assert max(fill.values()) <= 100 and len(fill) > 10   # copies of one key do not split buckets


def fill_by_rounds(sizes, weights, total, most):
    """Reference: share by weight, cap, share the excess again until none is above."""
    target, free, left = {}, dict(weights), total
    while free:
        level = left / sum(free.values())
        over = [s for s in free if level * free[s] >= most * sizes[s]]
        if not over:
            target.update({s: level * w for s, w in free.items()})
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            del free[s]
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 500, "d": 3, None: 77}, {"a": 5}, {"a": 0, "b": 0}, {"x": 100, "y": 0},
    {f"s{i}": (i * 37) % 101 for i in range(30)}])
def test_targets_match_water_filling_by_rounds(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    want = fill_by_rounds(sizes, weights, 1.5 * sum(sizes.values()), 2.0)
    assert got == pytest.approx(want)


def test_mix_is_near_targets_and_reruns_agree(spark):
    df = docs(spark, [(i, "w " * (1 + i * 7919 % 60), f"s{min(i % 7, 3)}") for i in range(3000)])
    got = mix(df).collect()
    assert sorted(got) == sorted(mix(df.repartition(5)).collect())
    by = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        s = by.setdefault(r.source, [0, r.target])
        s[0] += r.taken
    assert all(abs(t - target) <= 60 for t, target in by.values())
    assert sum(t for _, t in by.values()) == pytest.approx(1.5 * sum(r.size for r in got), rel=0.01)


def test_mix_reads_the_texts_once(spark, tmp_path):
    docs(spark, [(i, "w " * (i % 9), f"s{i % 2}") for i in range(50)]).write.parquet(f"{tmp_path}/d")
    out = mix(spark.read.parquet(f"{tmp_path}/d"))
    assert out.count() == 50
    assert not [f for f in out.inputFiles() if str(tmp_path) + "/d" in f]     # sizes were stored, and are read from there


def test_mix_awkward_rows(spark):
    df = clashing(awkward(spark))
    got = mix(df).collect()
    assert len(got) == df.count()
    assert {r.size for r in got if r.doc_id in (1, 2, 10)} == {0}
    assert mix(docs(spark, [])).count() == 0


def test_word_count_is_ascii_white_space_only(spark):
    text = "a b c\x1cd\te\x0b f g \n"
    got = mix(docs(spark, [(1, text)])).collect()
    assert got[0].size == 4


def test_matrix_margins():
    m = communication_matrix([10, 0, 7, 24], 8, 3)
    assert [sum(r) for r in m] == [10, 0, 7, 24]
    assert sorted(sum(r[s] for r in m) for s in range(8)) == [5] * 7 + [6]


def test_shards_exact_gapless_and_reproducible(spark):
    df = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit("clash").alias("slot"))
    a = shuffle_to_shards(df)
    rows = a.collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(8))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sorted(rows) == sorted(shuffle_to_shards(df.repartition(3)).collect())
    # uniform: a shard holds about an eighth of any id range
    low = sum(1 for r in rows if r.shard == 3 and r.doc_id < 10_000)
    assert 1000 < low < 1500


def test_shards_awkward_rows(spark):
    df = awkward(spark).withColumn("crc", F.crc32(F.coalesce("text", F.lit(""))))
    got = shuffle_to_shards(df, keys=("doc_id", "crc")).collect()
    assert len(got) == df.count()
    assert {r.crc for r in got if r.doc_id == 1} == {zlib.crc32(b"")}
    assert shuffle_to_shards(df.filter("false"), keys=("doc_id", "crc")).count() == 0


def test_shards_carry_every_column_of_repeated_and_null_rows(spark):
    df = clashing(awkward(spark)).drop("shard", "slot")
    df = df.unionAll(df).unionAll(df.filter("doc_id = 4"))
    got = shuffle_to_shards(df, shards=3, keys=("doc_id", "text"))
    assert got.columns == [*df.columns, "shard", "slot"]
    assert Counter(got.select(df.columns).collect()) == Counter(df.collect())
    assert len(got.select("shard", "slot").distinct().collect()) == df.count()


def test_a_task_writes_one_shard_in_the_order_of_its_slots(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
        out = stored(shuffle_to_shards(df), "shards-test", ["shard"])
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(out.inputFiles()) == 16                     # one a task; 8 a task if a task holds rows of all shards
    files = {}
    for r in out.select("slot", "_metadata.file_path", "_metadata.row_index").collect():
        files.setdefault(r.file_path, []).append((r.row_index, r.slot))
    for rows in files.values():
        slots = [slot for _, slot in sorted(rows)]
        assert slots == list(range(slots[0], slots[0] + len(slots)))


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_by_brute_force_where_repeated_keys_lie_across_cuts(spark, monkeypatch, shards):
    monkeypatch.setattr(sharding, "PARTITION_ROWS", 300)
    null, few, one = F.col("id") < 900, F.col("id") < 1500, F.col("id")
    df = spark.range(3000).select(F.when(~null, F.when(few, one % 7).otherwise(one)).alias("doc_id"), "id")
    parts, seed = 10, 20240
    rows = df.select("doc_id", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(parts)).alias("p"),
                     F.xxhash64(F.lit(seed + 1), "doc_id").alias("h"), unit_hash(F.lit(seed + 2), "doc_id").alias("u")).collect()
    of = [sorted((r for r in rows if r.p == p), key=lambda r: r.h) for p in range(parts)]
    want, members = [], [[] for _ in range(shards)]
    for part, sizes in zip(of, communication_matrix([len(x) for x in of], shards, seed)):
        for s, n in enumerate(sizes):
            members[s] += part[:n]
            part = part[n:]
    for s, m in enumerate(members):
        want += [(r.doc_id, s, slot) for slot, r in enumerate(sorted(m, key=lambda r: r.u))]
    got = shuffle_to_shards(df, shards=shards).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in got) == Counter(want)
    assert sorted(r.id for r in got) == list(range(3000))


def test_rows_find_their_entry_by_bucket_and_chain(spark):
    """Keys are made to collide: chains tell texts apart, and a row sent to another bucket finds nothing."""
    rows = docs(spark, [(k, f"text {k % 40}") for k in range(300)]).select(
        "doc_id", "text", ((F.crc32("text") % 3 - 1) * (1 << 62)).cast("long").alias("key"))
    cells = directory(rows, capacity=1, max_depth=8)
    index = build_index(rows, cells, 8)
    assert index.agg(F.max("chain")).first()[0] > 5 and index.count() == 40
    probe = routed(rows.select("doc_id", "key", F.sha2("text", 256).alias("text_sha256")), cells, 8)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in look_up(probe, index).collect()}
    size = {k: sum(1 for j in range(300) if j % 40 == k) for k in range(40)}
    assert got == {k: (max(j for j in range(300) if j % 40 == k % 40), size[k % 40]) for k in range(300)}
    astray = probe.withColumn("bucket", F.col("bucket") + 1)
    assert look_up(astray, index).count() == 0
    with pytest.raises(ValueError):
        drop_exact_copies(docs(spark, [(1, "a")]).withColumnRenamed("lang", "doc_id"))
