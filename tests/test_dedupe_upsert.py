import datetime
import os
import random
import shutil
from collections import Counter
from contextlib import suppress

import pytest

from shelfwise.operators import upsert as upserts
from shelfwise.operators.dedupe import keep_one, latest_per_key, losers
from shelfwise.operators.ranking import top_k_per_group
from shelfwise.operators.upsert import upsert
from shelfwise.sources import silver
from shelfwise.sources.scratch import scratch_root
from shelfwise.sources.silver import SilverTable, read_silver

SCHEMA = "k string, v int, p string, t int"


@pytest.fixture(params=[1, 3])
def table(tmp_path, request):
    return SilverTable(str(tmp_path / "table"), ("k",), "p", "t", buckets=request.param)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def snapshot(spark, table, columns=("k", "v", "p", "t")):
    return sorted(tuple(r) for r in read_silver(spark, table).select(*columns).collect())


def test_keep_one_is_total_and_treats_null_keys_as_equal(spark):
    rows = [("a", 2), ("a", 1), (None, 5), (None, 4), ("b", None), ("b", 3)]
    got = {tuple(r) for r in keep_one(frame(spark, rows, "k string, v int"), ["k"]).collect()}
    assert got == {("a", 1), (None, 4), ("b", None)}


def test_losers_are_all_rows_but_the_kept(spark):
    rows = [("a", 2), ("a", 1), ("a", 1), ("a", 2), (None, 5), (None, 4), (None, 4), ("b", None), ("b", 3), ("c", 1)]
    df = frame(spark, rows, "k string, v int")
    kept = Counter(map(tuple, keep_one(df, ["k"]).collect()))
    lost = {(r.k, r.v): r.n_copies for r in losers(df, ["k"]).collect()}
    assert kept + Counter(lost) == Counter(rows)
    nan = frame(spark, [("a", float("nan")), ("a", float("nan")), ("a", -0.0), ("a", 0.0)], "k string, v double")
    assert sum(r.n_copies for r in losers(nan, ["k"]).collect()) == 3


def test_keep_one_does_not_depend_on_row_order_or_partitions(spark):
    rng = random.Random(7)
    rows = [(str(rng.randrange(50)), rng.randrange(5), str(rng.randrange(3)), rng.randrange(4)) for _ in range(2000)]
    results = set()
    for parts in (1, 3, 16):
        rng.shuffle(rows)
        got = keep_one(frame(spark, rows).repartition(parts), ["k"]).collect()
        results.add(tuple(sorted(map(tuple, got))))
    best = {}
    for k, *rest in rows:
        best[k] = min(best.get(k, rest), rest)
    assert results == {tuple(sorted((k, *rest) for k, rest in best.items()))}


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = keep_one(frame(spark, [("a", 1, "p", 1)]), ["k"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan") :]
    exchange = physical.index("Exchange hashpartitioning")
    assert "Partial" in physical[exchange:] and "WindowGroupLimit" in physical[exchange:]


def test_top_k_keeps_at_most_k_and_puts_null_last(spark):
    rows = [("g", i) for i in range(12)] + [("h", None), ("h", 1)]
    df = frame(spark, rows, "g string, v int")
    top = top_k_per_group(df, ["g"], [df.v.desc_nulls_last()], 10)
    assert sorted((r["g"], r["v"]) for r in top.where("v IS NOT NULL").collect()) == [("g", i) for i in range(2, 12)] + [("h", 1)]
    assert top.count() == 12
    assert top_k_per_group(df, ["g"], [df.v.desc_nulls_last()], 1).where("g = 'h'").first()["v"] == 1


def test_latest_per_key_prefers_ordering_then_values(spark):
    rows = [("a", 1, "p", 1), ("a", 9, "p", 0), ("b", 1, "p", 2), ("b", 3, "p", 2)]
    got = {tuple(r) for r in latest_per_key(frame(spark, rows), ["p", "k"], "t").collect()}
    assert got == {("a", 1, "p", 1), ("b", 3, "p", 2)}


def test_update_insert_and_untouched_partitions(spark, table, tmp_path):
    upsert(frame(spark, [("a", 1, "x", 1), ("b", 1, "x", 1), ("c", 1, "y", 1)]), table)
    before = {f.name for f in (tmp_path / "table" / "p=y").rglob("*.parquet")}
    upsert(frame(spark, [("a", 2, "x", 2), ("d", 2, "z", 2)]), table)
    assert snapshot(spark, table) == [("a", 2, "x", 2), ("b", 1, "x", 1), ("c", 1, "y", 1), ("d", 2, "z", 2)]
    assert {f.name for f in (tmp_path / "table" / "p=y").rglob("*.parquet")} == before


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    table = SilverTable(str(tmp_path / "table"), ("k",), "p", "t", buckets=16)
    upsert(frame(spark, [(str(i), 1, "x", 1) for i in range(200)]), table)
    before = {str(f) for f in (tmp_path / "table").rglob("*.parquet")}
    upsert(frame(spark, [("7", 2, "x", 2)]), table)
    after = {str(f) for f in (tmp_path / "table").rglob("*.parquet")}
    assert len(before) == 16 and len(before & after) == 15
    assert read_silver(spark, table).count() == 200
    assert read_silver(spark, table).where("k = '7'").first()["v"] == 2


def test_equal_ordering_wins_older_loses(spark, table):
    upsert(frame(spark, [("a", 1, "x", 5), ("b", 9, "x", 5), ("c", 1, "x", None), ("d", 1, "x", 5)]), table)
    upsert(frame(spark, [("a", 2, "x", 4), ("b", 2, "x", 5), ("c", 2, "x", 1), ("d", 2, "x", None)]), table)
    assert [r[:2] for r in snapshot(spark, table)] == [("a", 1), ("b", 2), ("c", 2), ("d", 1)]


def test_same_key_in_another_partition_stays(spark, table):
    upsert(frame(spark, [("a", 1, "x", 1)]), table)
    upsert(frame(spark, [("a", 2, "y", 2)]), table)
    assert snapshot(spark, table) == [("a", 1, "x", 1), ("a", 2, "y", 2)]


def test_repeating_a_batch_changes_nothing(spark, table):
    batch = frame(spark, [("a", 1, "x", 1), ("a", 2, "x", 1), (None, 3, "x", 1), ("", 4, "y", 1)])
    upsert(batch, table)
    first = read_silver(spark, table).collect()
    upsert(batch, table)
    assert sorted(map(str, read_silver(spark, table).collect())) == sorted(map(str, first))
    assert len(first) == 3


def test_an_empty_batch_changes_nothing(spark, table):
    upsert(frame(spark, []), table)
    upsert(frame(spark, [("a", 1, "x", 1)]), table)
    upsert(frame(spark, []), table)
    assert snapshot(spark, table) == [("a", 1, "x", 1)]


def test_added_and_missing_columns(spark, table):
    upsert(frame(spark, [("a", 1, "x", 1), ("b", 1, "y", 1)]), table)
    upsert(frame(spark, [("a", 2, "x", 2, "n")], SCHEMA + ", extra string"), table)
    upsert(frame(spark, [("c", 3, "x", 3)]), table)
    columns = ("k", "v", "p", "t", "extra")
    assert sorted(map(str, read_silver(spark, table).select(*columns).collect())) == sorted(
        str(r)
        for r in frame(
            spark,
            [("a", 2, "x", 2, "n"), ("b", 1, "y", 1, None), ("c", 3, "x", 3, None)],
            SCHEMA + ", extra string",
        ).collect()
    )


def test_partition_values_keep_their_text(spark, table):
    rows = [("a", 1, "", 1), ("b", 1, "007", 1), ("c", 1, "7", 1), ("d", 1, "a/b c=d", 1)]
    upsert(frame(spark, rows), table)
    assert snapshot(spark, table) == sorted(rows)
    upsert(frame(spark, [("a", 2, "", 2), ("b", 2, "007", 2)]), table)
    assert snapshot(spark, table) == sorted([("a", 2, "", 2), ("b", 2, "007", 2), *rows[2:]])


def test_date_partitions(spark, tmp_path):
    table = SilverTable(str(tmp_path / "t"), ("k",), "d", "d", "date")
    day = datetime.date(2026, 7, 28)
    upsert(frame(spark, [("a", 1, day), ("a", 5, day)], "k string, v int, d date"), table)
    upsert(frame(spark, [("a", 2, day), ("a", 7, datetime.date(2026, 1, 1))], "k string, v int, d date"), table)
    got = sorted((r["d"], r["v"]) for r in read_silver(spark, table).collect())
    assert got == [(datetime.date(2026, 1, 1), 7), (day, 2)]


@pytest.mark.parametrize("rows_per_file", [1, 7, 1_000_000])
def test_large_directories_are_written_as_several_files(spark, table, monkeypatch, rows_per_file):
    monkeypatch.setattr(upserts, "ROWS_PER_FILE", rows_per_file)
    old = [(str(i), 1, f"p{i % 5}", 1) for i in range(100)]
    new = [(str(i), 2, f"p{i % 5}", 2) for i in range(50, 120) if i % 5 < 3]
    upsert(frame(spark, old), table)
    upsert(frame(spark, new), table)
    expected = {(k, p): (k, v, p, t) for k, v, p, t in old + new}
    assert snapshot(spark, table) == sorted(expected.values())


def merge_plan(spark, monkeypatch, table):
    """The plan by which an upsert into a table that is there writes its rows."""
    plans = []

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, *args)

    stage = upserts.stage
    monkeypatch.setattr(upserts, "ROWS_PER_FILE", 7)
    monkeypatch.setattr(upserts, "stage", seen)
    for t in (1, 2):
        upsert(frame(spark, [(str(i), t, f"p{i % 3}", t) for i in range(100)]), table)
    assert snapshot(spark, table) == sorted((str(i), 2, f"p{i % 3}", 2) for i in range(100))
    (plan,) = plans
    return plan


def test_a_merge_shuffles_its_rows_once(spark, table, monkeypatch):
    plan = merge_plan(spark, monkeypatch, table)
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    # Sorts begin with the key, which has more values than the partition.
    assert table.row_key == ["k", "p"]


def test_a_global_merge_shuffles_its_rows_by_key_and_by_directory(spark, tmp_path, monkeypatch):
    table = SilverTable(str(tmp_path / "t"), ("k",), "p", "t", scope="global")
    plan = merge_plan(spark, monkeypatch, table)
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" not in plan


def test_rows_of_both_sides_meet_at_null_and_equal_orderings(spark, tmp_path):
    table = SilverTable(str(tmp_path / "t"), ("k",), "p", "t")
    upsert(frame(spark, [("a", 1, "x", None), ("b", 1, "x", 5), (None, 1, "x", 5), ("d", 1, "x", 9), ("e", 1, None, 1)]), table)
    upsert(frame(spark, [("a", 2, "x", None), ("b", 2, "x", None), (None, 2, "x", 5), ("d", 2, "x", 8), ("e", 2, "", 1)]), table)
    got = {(r.k, r.p): r.v for r in read_silver(spark, table).collect()}
    assert got == {("a", "x"): 2, ("b", "x"): 1, (None, "x"): 2, ("d", "x"): 1, ("e", ""): 2}


class Cut(Exception):
    pass


def cut_after(patch, steps):
    """Let an upsert's commit do so many of its steps only; each directory is one."""
    done = []

    def limited(step):
        def run(*args):
            if len(done) >= steps:
                raise Cut
            done.append(step)
            return step(*args)

        return run

    for name in ("delete", "write_note"):
        patch.setattr(silver, name, limited(getattr(silver, name)))
    move = silver.replace_folders
    one = limited(lambda spark, source, target, name: move(spark, source, target, [name]))
    patch.setattr(silver, "replace_folders", lambda s, a, b, names: [one(s, a, b, n) for n in sorted(names)])


@pytest.mark.parametrize("steps", [0, 1, 3, 5])
def test_an_upsert_that_is_cut_off_loses_nothing(spark, table, tmp_path, monkeypatch, steps):
    """Cut off once the note is there: before, between and after the directories are replaced."""
    old = [(str(i), 1, f"p{i % 4}", 1) for i in range(30)]
    new = [(str(i), 2, f"p{i % 4}", 2) for i in range(20, 40) if i % 4 < 3]
    expected = {(k, p): (k, v, p, t) for k, v, p, t in old + new}
    upsert(frame(spark, old), table)
    with monkeypatch.context() as patch:
        cut_after(patch, steps)
        with suppress(Cut):
            upsert(frame(spark, new), table)
    # A reader sees the commit as done, whole, wherever it was cut off.
    assert snapshot(spark, table) == sorted(expected.values())
    upsert(frame(spark, [("x", 3, "p3", 3)]), table)
    assert snapshot(spark, table) == sorted([*expected.values(), ("x", 3, "p3", 3)])
    assert {f.name for f in (tmp_path / "table").glob("_*")} == {"_schema", "_SUCCESS"}


def test_a_directory_deleted_but_not_yet_moved_is_read_from_its_new_rows(spark, table, tmp_path, monkeypatch):
    upsert(frame(spark, [("a", 1, "x", 1), ("b", 1, "y", 1)]), table)
    with monkeypatch.context() as patch:
        cut_after(patch, 0)
        with pytest.raises(Cut):
            upsert(frame(spark, [("a", 2, "x", 2), ("c", 2, "x", 2)]), table)
    shutil.rmtree(tmp_path / "table" / "p=x")
    assert snapshot(spark, table) == [("a", 2, "x", 2), ("b", 1, "y", 1), ("c", 2, "x", 2)]


def test_a_first_load_that_is_cut_off_leaves_no_table(spark, table, tmp_path, monkeypatch):
    with monkeypatch.context() as patch:
        cut_after(patch, 0)
        with pytest.raises(Cut):
            upsert(frame(spark, [("a", 1, "x", 1)]), table)
    assert not (tmp_path / "table").exists()
    upsert(frame(spark, [("b", 1, "x", 1)]), table)
    assert snapshot(spark, table) == [("b", 1, "x", 1)]
    assert [f.name for f in tmp_path.iterdir()] == ["table"]


def test_a_cut_off_before_the_note_changes_nothing(spark, table, tmp_path, monkeypatch):
    upsert(frame(spark, [("a", 1, "x", 1)]), table)
    with monkeypatch.context() as patch:
        patch.setattr(upserts, "write_note", lambda *args: (_ for _ in ()).throw(Cut()))
        with pytest.raises(Cut):
            upsert(frame(spark, [("a", 2, "x", 2)]), table)
    assert snapshot(spark, table) == [("a", 1, "x", 1)]
    upsert(frame(spark, [("b", 2, "x", 2)]), table)
    assert snapshot(spark, table) == [("a", 1, "x", 1), ("b", 2, "x", 2)]
    assert {f.name for f in (tmp_path / "table").glob("_*")} == {"_schema", "_SUCCESS"}


def test_a_table_that_changes_while_it_is_listed_is_listed_again(spark, table, monkeypatch):
    upsert(frame(spark, [("a", 1, "x", 1), ("b", 1, "y", 1)]), table)
    plain, looks = silver._scan, []

    def meanwhile(*args):
        df = plain(*args)
        looks.append(1)
        if len(looks) == 1:
            upsert(frame(spark, [("a", 2, "x", 2), ("b", 2, "y", 2)]), table)
        return df

    with monkeypatch.context() as patch:
        patch.setattr(silver, "_scan", meanwhile)
        seen = read_silver(spark, table)
    assert sorted((r.k, r.v) for r in seen.collect()) == [("a", 2), ("b", 2)]


def test_only_files_of_touched_directories_are_opened(spark, table, tmp_path):
    """All other files are broken: opening a footer for its columns would fail."""
    upsert(frame(spark, [(str(i), 1, f"p{i}", 1) for i in range(1000)]), table)
    for file in (tmp_path / "table").rglob("*.parquet"):
        if "p=p7" not in file.parts:
            file.write_bytes(b"broken")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    batch = frame(spark, [("7", 2, "p7", 2, "n"), ("new", 2, "q", 2, "n")], SCHEMA + ", extra string")
    upsert(batch, table)
    rows = read_silver(spark, table).where("p IN ('p7', 'q')").select("k", "v", "p", "t", "extra").collect()
    assert sorted(map(tuple, rows)) == [("7", 2, "p7", 2, "n"), ("new", 2, "q", 2, "n")]


def test_a_column_keeps_its_type(spark, table):
    upsert(frame(spark, [("a", 1, "x", 1)]), table)
    with pytest.raises(ValueError, match="column v is int in the table and string in the batch"):
        upsert(frame(spark, [("a", "1", "x", 1)], "k string, v string, p string, t int"), table)
    assert snapshot(spark, table) == [("a", 1, "x", 1)]


def test_a_table_without_a_record_is_read_by_its_files(spark, tmp_path):
    table = SilverTable(str(tmp_path / "table"), ("k",), "p", "t")
    frame(spark, [("a", 1, "x", 1)]).write.partitionBy("p").parquet(table.path)
    more = frame(spark, [("b", 1, "y", 1, "n")], SCHEMA + ", extra string")
    more.write.mode("append").partitionBy("p").parquet(table.path)
    assert "extra" in read_silver(spark, table).columns
    upsert(frame(spark, [("c", 1, "x", 1)]), table)
    rows = read_silver(spark, table).select("k", "extra").collect()
    assert sorted(map(tuple, rows)) == [("a", None), ("b", "n"), ("c", None)]


@pytest.fixture(params=[1, 4])
def global_table(request, tmp_path):
    return SilverTable(str(tmp_path / "table"), ("k",), "p", "t", buckets=request.param, scope="global")


def test_a_global_key_leaves_its_old_partition(spark, global_table, tmp_path):
    upsert(frame(spark, [("a", 1, "x", 1), ("b", 1, "x", 1), ("c", 1, "y", 1), ("d", 1, "z", 1)]), global_table)
    before = {f for f in (tmp_path / "table").rglob("*.parquet") if "p=z" in str(f)}
    upsert(frame(spark, [("a", 2, "y", 2), ("c", 2, "w", 2), ("e", 2, "v", 1)]), global_table)
    assert snapshot(spark, global_table) == [("a", 2, "y", 2), ("b", 1, "x", 1), ("c", 2, "w", 2), ("d", 1, "z", 1), ("e", 2, "v", 1)]
    assert {f for f in (tmp_path / "table").rglob("*.parquet") if "p=z" in str(f)} == before
    # The last row of a partition leaves: its directory goes, and a newer stored row stays where it is.
    upsert(frame(spark, [("b", 3, "y", 3), ("a", 9, "q", 1)]), global_table)
    assert snapshot(spark, global_table) == [("a", 2, "y", 2), ("b", 3, "y", 3), ("c", 2, "w", 2), ("d", 1, "z", 1), ("e", 2, "v", 1)]
    assert not list((tmp_path / "table" / "p=x").rglob("*.parquet"))


@pytest.mark.parametrize("steps", [0, 1, 3, 4])
def test_a_global_upsert_that_is_cut_off(spark, global_table, monkeypatch, steps):
    upsert(frame(spark, [("a", 1, "x", 1), ("b", 1, "y", 1), ("", 1, "", 1)]), global_table)
    with monkeypatch.context() as patch:
        cut_after(patch, steps)
        with suppress(Cut):
            upsert(frame(spark, [("a", 2, "y", 2), ("", 2, "n", 2)]), global_table)
    wanted = [("", 2, "n", 2), ("a", 2, "y", 2), ("b", 1, "y", 1)]
    assert snapshot(spark, global_table) == wanted
    upsert(frame(spark, []), global_table)
    assert snapshot(spark, global_table) == wanted


@pytest.mark.parametrize("ordering", ["t", "p"])
def test_a_replayed_older_batch_undoes_nothing(spark, tmp_path, ordering):
    table = SilverTable(str(tmp_path / "table"), ("k",), "p", ordering, sequence="batch")
    first = frame(spark, [("a", 1, "x", 1), ("b", 1, "x", 1), ("c", 5, "x", 7 if ordering == "t" else 1)])
    second = frame(spark, [("a", 2, "x", 1), ("c", 2, "x", 1), ("d", 2, "y", 1)])
    upsert(first, table, sequence=1)
    upsert(second, table, sequence=2)
    rows = sorted((r.k, r.v, r.batch) for r in read_silver(spark, table).collect())
    c = ("c", 5, 1) if ordering == "t" else ("c", 2, 2)
    assert rows == [("a", 2, 2), ("b", 1, 1), c, ("d", 2, 2)]
    upsert(first, table, sequence=1)
    upsert(second, table, sequence=2)
    assert sorted((r.k, r.v, r.batch) for r in read_silver(spark, table).collect()) == rows
    with pytest.raises(ValueError, match="sequence number"):
        upsert(first, table)


def test_scratch_tables_of_an_upsert_are_freed(spark, table):
    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    upsert(frame(spark, [("a", 1, "x", 1)]), table)
    upsert(frame(spark, [("a", 2, "x", 2)]), table)
    assert set(os.listdir(root)) == before
