"""Versions behind one map: readers see all of a commit or nothing, one writer at a time, torn records."""

import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from tripmart.plans import flow, publish
from tripmart.plans.monthly import run_months
from tripmart.plans.publish import FileOps, LakeBusy, LeaseLost, acquire, commit, current_map, folder_of, new_version, partitions, vacuum, writing
from tripmart.plans.warehouse import load_months
from tripmart.session import scratch_path
from tripmart.sources import fixture
from tripmart.sources.lake import Lake, read_table
from tripmart.sources.reference import read_zones_csv

SF = "/root/testdata/sf0.001"
JAN = "year=2024/month=1"


@pytest.fixture()
def small(spark):
    """A lake with three tables of tiny partitions, written in one commit."""
    lake = Lake(scratch_path(spark, "versions"))
    with writing(spark, lake) as lease:
        commit(lease, {**put(spark, lake, lake.clean, JAN, 3), **put(spark, lake, lake.rejected, "source_month=2024-01", 2)})
    return lake


def put(spark, lake, table, part, rows):
    folder = f"{table}/{new_version()}/{part}"
    spark.range(rows).coalesce(1).write.parquet(folder)
    return {(table, part): folder}


def sizes(spark, lake):
    return tuple(read_table(spark, lake, t).count() if partitions(FileOps(spark), lake, t) else None for t in (lake.clean, lake.rejected))


def test_a_reader_at_every_step_sees_old_or_new(spark, lake, monkeypatch):
    fixture.raw_month(spark, SF).write.parquet(lake.raw_month("2024-01"))
    fixture.zones(spark, SF).coalesce(1).write.option("header", True).csv(lake.raw_zones)
    zones = read_zones_csv(spark, lake.raw_zones)
    run_months(spark, lake, ["2024-01"], zones)
    old = sizes(spark, lake)
    before = read_table(spark, lake, lake.clean)
    seen = []
    for name in ("create_new", "write_text", "delete", "rename", "mkdirs"):
        real = getattr(FileOps, name)

        def step(self, *args, real=real):
            seen.append(sizes(spark, lake))
            out = real(self, *args)
            seen.append(sizes(spark, lake))
            return out
        monkeypatch.setattr(FileOps, name, step)
    fixture.raw_month(spark, SF).limit(300).write.mode("overwrite").parquet(lake.raw_month("2024-01"))
    run_months(spark, lake, ["2024-01"], zones)
    new = sizes(spark, lake)
    assert new != old and sum(new) == 300
    assert set(seen) == {old, new} and seen == sorted(seen, key=[old, new].index)  # both tables switch together, once
    assert before.count() == old[0]  # who began before still reads what they saw


def test_a_stop_at_any_step_leaves_old_or_new_and_the_next_writer_goes_on(spark, small, monkeypatch):
    real = {n: getattr(FileOps, n) for n in ("create_new", "write_text", "delete")}
    for stop in range(1, 8):
        old = sizes(spark, small)
        rows = 10 + stop
        changes = {**put(spark, small, small.clean, JAN, rows), **put(spark, small, small.rejected, "source_month=2024-01", rows)}
        left = [stop]
        with monkeypatch.context() as patch:
            for name, call in real.items():
                def step(self, *args, call=call):
                    left[0] -= 1
                    if left[0] == 0:
                        raise KeyboardInterrupt
                    return call(self, *args)
                patch.setattr(FileOps, name, step)
            try:
                lease = acquire(FileOps(spark), small, seconds=0.2)  # never released: the process died
                commit(lease, changes)
            except KeyboardInterrupt:
                pass
        assert sizes(spark, small) in (old, (rows, rows))
        time.sleep(0.3)
        with writing(spark, small) as lease:
            commit(lease, changes)
        assert sizes(spark, small) == (rows, rows)


def test_a_writer_whose_time_is_over_publishes_nothing_after_the_next_one(spark, small):
    ops = FileOps(spark)
    slow = acquire(ops, small, seconds=0.2)
    with pytest.raises(LakeBusy):
        acquire(ops, small)
    mine = put(spark, small, small.clean, JAN, 50)
    time.sleep(0.3)
    other = acquire(ops, small)
    with pytest.raises(LeaseLost):  # even before the other one publishes
        commit(slow, mine)
    commit(other, {**put(spark, small, small.clean, "year=2024/month=2", 7)})
    with pytest.raises(LeaseLost):
        commit(slow, mine)
    slow.release()  # ends nobody else's lease
    with pytest.raises(LakeBusy):
        acquire(ops, small)
    other.release()
    assert sizes(spark, small) == (10, 2)
    acquire(ops, small).release()


def test_a_late_commit_is_refused_by_the_map_itself(spark, small, monkeypatch):
    """The fence: a writer that passed its check before another took over finds the other's number in the map."""
    ops = FileOps(spark)
    slow = acquire(ops, small, seconds=0.1)
    time.sleep(0.2)
    fast = acquire(ops, small)
    commit(fast, put(spark, small, small.clean, "year=2024/month=2", 7))
    monkeypatch.setattr(publish.Lease, "check", lambda self: None)
    with pytest.raises(LeaseLost):
        commit(slow, put(spark, small, small.clean, JAN, 50))
    assert sizes(spark, small) == (10, 2)


def test_two_commits_at_one_number_lose_no_month(spark, small, monkeypatch):
    with writing(spark, small) as lease:
        real, raced = FileOps.create_new, []

        def second(self, path, text):
            if "/_current/" in path and not raced:
                raced.append(path)
                commit(lease, put(spark, small, small.clean, "year=2024/month=3", 4))  # someone is faster
            return real(self, path, text)
        monkeypatch.setattr(FileOps, "create_new", second)
        commit(lease, put(spark, small, small.clean, "year=2024/month=2", 7))
    assert raced and sizes(spark, small) == (14, 2)


def test_only_one_of_many_creates_a_file(spark, small):
    ops = FileOps(spark)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: ops.create_new(f"{small.root}/race.json", str(i)), range(8)))
    assert sum(won) == 1 and ops.read_text(f"{small.root}/race.json") == str(won.index(True))
    assert not [f for f in ops.list_files(small.root) if f.endswith(".part")]


@pytest.mark.parametrize("torn", ["", "{\"epoch\": 1, \"fold", "[1, 2]", "null"])
def test_torn_records_are_passed_over(spark, small, torn):
    ops = FileOps(spark)
    number = current_map(ops, small).number
    ops.write_text(f"{small.maps}/{number + 1:012d}.json", torn)
    epoch = current_map(ops, small).epoch
    ops.write_text(f"{small.leases}/{epoch + 1:012d}.json", torn)
    assert sizes(spark, small) == (3, 2)
    with writing(spark, small) as lease:
        assert lease.epoch == epoch + 2
        commit(lease, put(spark, small, small.clean, "year=2024/month=2", 7))
    assert current_map(ops, small).number == number + 2 and sizes(spark, small) == (10, 2)


def test_plain_partitions_are_read_until_a_version_takes_their_place(spark, small):
    plain = Lake(scratch_path(spark, "plain"))
    for m, n in ((1, 5), (2, 6)):
        spark.range(n).write.parquet(f"{plain.clean}/year=2024/month={m}")
    assert read_table(spark, plain, plain.clean).count() == 11
    with writing(spark, plain) as lease:
        commit(lease, put(spark, plain, plain.clean, JAN, 1))
        assert {(r["month"], r["count"]) for r in read_table(spark, plain, plain.clean).groupBy("month").count().collect()} == {(1, 1), (2, 6)}
        commit(lease, put(spark, plain, plain.clean, "year=2024/month=3", 2), whole=(plain.clean,))
    assert list(partitions(FileOps(spark), plain, plain.clean)) == ["year=2024/month=3"]
    assert read_table(spark, plain, plain.clean, ["year=2030/month=1"]).count() == 0
    with pytest.raises(FileNotFoundError):
        read_table(spark, plain, plain.rejected)
    assert read_table(spark, small, small.clean).columns == ["id", "year", "month"]


def test_vacuum_keeps_what_maps_of_the_kept_time_name(spark, small):
    ops = FileOps(spark)
    first = folder_of(ops, small, small.clean, JAN)
    with writing(spark, small) as lease:
        commit(lease, put(spark, small, small.clean, JAN, 9))
    spark.range(1).write.parquet(f"{small.clean}/{new_version()}/year=2024/month=9")  # of a run that died
    assert len(vacuum(spark, small, keep_seconds=3600)) == 1 and ops.exists(first)
    time.sleep(0.05)
    assert vacuum(spark, small, keep_seconds=0.01) == [first[len(small.root) + 1:].rsplit("/year", 1)[0]]
    assert not ops.exists(first) and sizes(spark, small) == (9, 2)


def test_flow_ends_with_a_status_whatever_fails(spark, lake, monkeypatch):
    fixture.raw_month(spark, SF).write.parquet(lake.raw_month("2024-01"))
    fixture.zones(spark, SF).coalesce(1).write.option("header", True).csv(lake.raw_zones)
    other = acquire(FileOps(spark), lake)
    busy = flow.run_flow(spark, lake, ["2024-01"], max_hard_reject_rate=1.0)
    assert busy.stages == {"lease": "failed"} and busy.code == 1 and "writes to" in busy.detail["error"]
    other.release()

    def fails(*_, **__):
        raise RuntimeError("simulated")
    for stage, name in (("marts", "build_marts"), ("load", "load_months"), ("clean", "run_months_batched")):
        with monkeypatch.context() as patch:
            patch.setattr(flow, name, fails)
            res = flow.run_flow(spark, lake, ["2024-01"], max_non_clean_rate=1.0, max_hard_reject_rate=1.0)
        assert res.code == 3 and res.stages[stage] == "failed" and res.month_status == {"2024-01": f"failed:{stage}"}
        assert res.detail["error"] == "RuntimeError: simulated"


def test_a_named_table_follows_the_versions(spark, lake):
    fixture.raw_month(spark, SF).write.parquet(lake.raw_month("2024-01"))
    fixture.zones(spark, SF).coalesce(1).write.option("header", True).csv(lake.raw_zones)
    zones = read_zones_csv(spark, lake.raw_zones)
    run_months(spark, lake, ["2024-01"], zones)
    load_months(spark, lake, ["2024-01"])
    flow.register_lake_table(spark, "t_versions", lake, lake.staging_table)
    assert spark.table("t_versions").count() == 947
    fixture.raw_month(spark, SF).limit(300).write.mode("overwrite").parquet(lake.raw_month("2024-01"))
    run_months(spark, lake, ["2024-01"], zones)
    load_months(spark, lake, ["2024-01"])
    flow.register_lake_table(spark, "t_versions", lake, lake.staging_table, months=["2024-01"])
    assert spark.table("t_versions").filter("month = 1").count() == read_table(spark, lake, lake.staging_table).count() < 300
    with writing(spark, lake) as lease:
        commit(lease, {(lake.staging_table, JAN): None})
    flow.register_lake_table(spark, "t_versions", lake, lake.staging_table)
    assert spark.table("t_versions").count() == 0
    spark.sql("DROP TABLE t_versions")
