"""Stored states: sets of ids, loads and compactions under one read view, roll-ups from the cheapest grain."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from footfall import samples
from footfall.jobs import JOBS
from footfall.operators.distinct_state import FEW, _bits_of, _either, build_state, merge_state, read_state
from footfall.plans import olap, traffic_states
from footfall.sinks import loads
from footfall.sinks.partitions import bytes_in, matching, write_batch
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def loaded(spark, sf):
    return olap.traffic_olap(samples.dwd(spark, sf, users=True, geo=True, pages=True)).persist()


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, user_id long, session_id string, pv long")


def test_unions_are_exact_whatever_the_form(spark):
    """Listed, full and mixed buckets, merged in several rounds, against plain sets."""
    rng = random.Random(6)
    kinds = {"sparse": range(0, 10 ** 10, 10 ** 7), "dense": range(40_000), "edge": range(1, FEW + 2), "just": range(1, FEW + 1),
             "signs": range(-70_000, 70_000, 997)}
    rows = [(g, rng.choice(ids), f"s{k % 50}", 1) for g, ids in kinds.items() for k in range(4000)]
    rows += [(g, None, None, 2) for g in ("sparse", "empty")] + [(None, 5, "s", 1)]
    rows += [("edge", i, "s", 1) for i in kinds["edge"]] + [("just", i, "s", 1) for i in kinds["just"]]
    rng.shuffle(rows)
    parts = [build_state(frame(spark, rows[k::5]), ["g"]) for k in range(5)]
    first = merge_state(parts[0].unionByName(parts[1]), ["g"])
    states = merge_state(first.unionByName(parts[2]).unionByName(merge_state(parts[3].unionByName(parts[4]), ["g"])), ["g"])
    wanted = {g: (sum(r[3] for r in rows if r[0] == g), len({r[1] for r in rows if r[0] == g and r[1] is not None}))
              for g in {r[0] for r in rows}}
    assert {r.g: (r.pv, r.uv) for r in read_state(states, ["g"]).collect()} == wanted
    whole = read_state(states, []).first()
    assert (whole.pv, whole.uv) == (sum(r[3] for r in rows), len({r[1] for r in rows if r[1] is not None}))
    forms = {r.g: (r.ids, r.bits) for r in states.where("uv_bucket = 1").groupBy("g").agg(
        F.max(F.col("uv_ids").isNotNull()).alias("ids"), F.max(F.col("uv_bits").isNotNull()).alias("bits")).collect()}
    assert forms["edge"] == (False, True) and forms["just"] == (True, False) and forms["dense"] == (False, True)


def test_sparse_ids_are_small(spark, tmp_path):
    rows = spark.range(1000).select(F.lit("x").alias("g"), (F.col("id") * 100_000).alias("user_id"),
                                    F.concat(F.lit("s"), "id").alias("session_id"), F.lit(1).cast("long").alias("pv"))
    path = str(tmp_path / "states")
    build_state(rows, ["g"]).coalesce(1).write.parquet(path)
    assert bytes_in(spark, path) < 50_000
    assert read_state(spark.read.parquet(path), ["g"]).first().uv == 1000


def test_groups_of_few_ids_never_take_a_bitmap(spark):
    """A bitmap buffer of 4 KB a group made many small groups cost far more than their rows."""
    states = build_state(frame(spark, [("a", 1, "s", 1)]), ["g"])
    assert "bitmap_construct_agg" not in states._jdf.queryExecution().optimizedPlan().toString()
    plan = merge_state(states, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" not in plan
    assert plan.count("bitmap_or_agg") == 1 and "isnotnull" in plan.split("bitmap_or_agg")[1].lower()


def test_bitmaps_of_ids_are_those_of_spark(spark):
    rng = random.Random(4)
    sets = [[0], [32767], [63, 64], list(range(32768)), *[sorted(rng.sample(range(32768), n)) for n in (3, 1500, 9000)]]
    ids = spark.createDataFrame(list(enumerate(sets)), "k int, ids array<smallint>")
    wanted = {r.k: bytes(r.b) for r in ids.select("k", F.explode("ids").alias("i")).groupBy("k").agg(
        F.bitmap_construct_agg(F.col("i").cast("long")).alias("b")).collect()}
    made = ids.select("k", _bits_of(F.col("ids")).alias("b"))
    assert {r.k: bytes(r.b) for r in made.collect()} == wanted
    pairs = made.alias("x").crossJoin(made.alias("y")).select(
        F.col("x.k").alias("i"), F.col("y.k").alias("j"), _either(F.col("x.b"), F.col("y.b")).alias("b"))
    assert all(bytes(r.b) == bytes(p | q for p, q in zip(wanted[r.i], wanted[r.j], strict=True)) for r in pairs.collect())


DDL = "k STRING, pv BIGINT, dt DATE"


def merged(rows):
    return rows.groupBy("dt", "k").agg(F.sum("pv").alias("pv")).select("k", "pv", "dt")


def test_every_load_counts_once_at_any_time(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [date(2024, 1, 1), date(2024, 1, 2), None]

    def load(number, factor=1):
        rows = [("ab"[k % 2], factor * (number + 1), days[k % 3]) for k in range(12)]
        write_batch(spark.createDataFrame(rows, DDL), path, number)
        return sum(r[1] for r in rows)

    def total():
        return loads.read_loads(spark, path, DDL).agg(F.sum("pv")).first()[0]

    assert loads.read_loads(spark, path, DDL) is None
    wanted = sum(load(n) for n in range(4))
    assert total() == wanted
    assert loads.compact_loads(spark, path, DDL, "2024-01-01", merged) == 2, "the newest batch may still be repeated"
    assert total() == wanted
    load(3, 10)
    load(3)
    assert total() == wanted, "a repeated batch replaces itself"
    assert loads.compact_loads(spark, path, DDL, None, merged, upto=3) == 3
    assert loads.compact_loads(spark, path, DDL, None, merged, upto=3) is None
    assert total() == wanted
    wanted += load(4)
    assert total() == wanted, "a load to a compacted day"
    assert loads.compact_loads(spark, path, DDL, "2024-01-01", merged, upto=4) == 4
    assert total() == wanted
    write_batch(spark.createDataFrame([("a", 999, date(2024, 1, 2))], DDL), path, -7, whole=False)
    assert total() == wanted, "a compaction that was not finished is not seen"
    gone = loads.drop_merged(spark, path, keep_ms=-1)
    assert len(gone) == 5 + 1 + 4 and total() == wanted
    assert loads.drop_merged(spark, path, keep_ms=10 ** 9) == []
    read = loads.read_loads(spark, path, DDL).where("dt = '2024-01-01'")
    assert {r.f.split("/")[-2] for r in read.select(F.input_file_name().alias("f")).collect()} == {"batch_id=-6"}
    scan = read._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert "batch_id" in scan.split("PushedFilters")[0], "directories are pruned"


def test_roll_ups_read_the_cheapest_grain(spark, loaded, tmp_path):
    path = str(tmp_path / "states")
    part = F.pmod(F.xxhash64("session_id", "time_trunk_1m"), F.lit(3))
    for number in range(3):
        traffic_states.store_load(loaded.where(part == number), number, path)
    traffic_states.store_load(loaded.where(part == 1), 1, path)
    cases = {("dt",): "day", ("dt", "time_trunk_1h", "province"): "area_hour", ("region",): "area_hour",
             ("dt", "time_trunk_30m", "page_type"): "page_half_hour", ("time_trunk_1h", "device_type"): "terminal_ten",
             ("dt", "time_trunk_5m", "is_new"): "new_five", ("province", "device_type"): "minute",
             ("dt", "time_trunk_1m"): "minute"}
    for compacted in (False, True):
        for dims, grain in cases.items():
            assert traffic_states.cheapest(spark, path, dims) == grain
            found = traffic_states.rollup(spark, path, list(dims))
            scanned = {f.split(f"{path}/")[1].split("/")[0] for f in found.inputFiles()}
            assert scanned == {grain}
            exact = olap.traffic_rollup(loaded, list(dims))
            assert rows_of(found, *dims, "pv", "uv") == rows_of(exact, *dims, "pv", "uv")
            near = found.join(exact.select(*dims, F.col("session_cnt").alias("exact")), list(dims)).where(
                "abs(session_cnt - exact) > greatest(1, 0.05 * exact)")
            assert near.isEmpty()
        for day in loads.compacted_upto(spark, f"{path}/day") or [
                p.rsplit("=", 1)[1] for p in matching(spark, f"{path}/day/dt=*")]:
            traffic_states.compact_states(spark, path, day, upto=2)
        traffic_states.sweep_states(spark, path, -1)
    assert all(p.endswith("batch_id=-4") for p in matching(spark, f"{path}/area_hour/dt=*/batch_id=*"))
    with pytest.raises(ValueError, match="planet"):
        traffic_states.cheapest(spark, path, ["planet"])


def test_job_stores_states_and_survives_a_replay(spark, sf, loaded, tmp_path):
    """The stream in two runs over several files; a batch done again and a compaction in between change nothing."""
    dwd = samples.dwd(spark, sf, users=True, geo=True, pages=True)
    lines = [r.v for r in dwd.orderBy("event_time").select(F.to_json(F.struct(*olap_columns())).alias("v")).collect()]
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    source.mkdir()
    clock = json.dumps({"event_time": 1_704_067_200_000 + 40 * 86_400_000})
    third = len(lines) // 3
    pieces = [lines[:third], lines[third:2 * third], lines[2 * third:], [clock]]
    for number, piece in enumerate(pieces[:2]):
        (source / f"{number}.json").write_text("\n".join(piece) + "\n")
    run = JOBS["traffic_states"]
    run(spark, {"path": str(source)}, out, check, delay="40 days").awaitTermination()
    for number, piece in enumerate(pieces[2:], start=2):
        (source / f"{number}.json").write_text("\n".join(piece) + "\n")
    run(spark, {"path": str(source)}, out, check, delay="0 seconds").awaitTermination()
    dims = ["dt", "time_trunk_1h", "province"]
    wanted = rows_of(olap.traffic_rollup(loaded, dims), *dims, "pv", "uv")
    stored = rows_of(traffic_states.rollup(spark, out, dims), *dims, "pv", "uv")
    assert stored == wanted
    newest = max(int(p.rsplit("=", 1)[1]) for p in matching(spark, f"{out}/minute/dt=*/batch_id=*"))
    again = spark.read.parquet(f"{out}/minute").where(F.col("batch_id") == newest).drop("batch_id").select(*loaded.columns)
    traffic_states.store_load(spark.createDataFrame(again.collect(), again.schema), newest, out)
    assert rows_of(traffic_states.rollup(spark, out, dims), *dims, "pv", "uv") == wanted
    for day in sorted({p.rsplit("dt=", 1)[1] for p in matching(spark, f"{out}/day/dt=*")}):
        JOBS["compact_traffic_states"](spark, out, day, upto=newest, keep_ms=-1)
    assert rows_of(traffic_states.rollup(spark, out, dims), *dims, "pv", "uv") == wanted


def olap_columns():
    return ["user_id", "session_id", "event_id", "event_time", "properties", "gps_province", "gps_city", "gps_region",
            "device_type", "release_channel", "page_type", "page_service", "register_time"]
