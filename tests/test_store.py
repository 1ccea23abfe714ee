"""Commits by several drivers, snapshots, and what is deleted."""

import os
import threading

import pytest

from talkscout.plans import commits
from talkscout.plans.store import Store

WP = "ordinal LONG, domain STRING, hostname STRING, sample_url STRING"
RESULTS = (
    "ordinal LONG, domain STRING, wp_confirmed LONG, comments_endpoint LONG, comment_count_hint LONG, api_root STRING, error STRING"
)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"{tmp_path}/store", buckets=8)


def add(store, table, *rows, ddl=None, commit=True):
    (batch,) = store.new_batches()
    store.append(table, store.spark.createDataFrame(list(rows), ddl or (WP if table.startswith("wp") else RESULTS)), batch)
    if commit:
        store.commit([batch])
    return batch


def result(domain, hint, error=""):
    return (0, domain, 1, 1, hint, "root", error)


def hints(store):
    return {r.domain: r.comment_count_hint for r in store.table("results").collect()}


def test_threads_that_commit_at_once_get_numbers_of_their_own(spark, tmp_path):
    root, got, errors = f"{tmp_path}/store", [], []

    def commit(writer):
        try:
            own = Store(spark, root)
            for i in range(25):
                got.append((own.commit([f"{writer}-{i:08d}"]), writer, i))
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=commit, args=(w,)) for w in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert sorted(n for n, *_ in got) == list(range(150))
    log = Store(spark, root).commits.commits()
    assert [log[n]["batches"] for n, *_ in got] == [[f"{w}-{i:08d}"] for _, w, i in got]
    for writer in range(6):  # each writer's own order is kept
        assert [i for n, w, i in sorted(got) if w == writer] == list(range(25))
    assert not [name for name in os.listdir(f"{root}/commits") if not name.endswith(".json") and ".crc" not in name]


def test_two_writers_of_tables(spark, tmp_path):
    stores = [Store(spark, f"{tmp_path}/store") for _ in range(2)]

    def write(store, name):
        for i in range(4):
            add(store, "results", result("both", 10 * i + len(name)), result(f"{name}{i}", i))

    threads = [threading.Thread(target=write, args=(s, n)) for s, n in zip(stores, ("x", "yy"), strict=True)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = [hints(s) for s in stores]
    assert found[0] == found[1] and found[0].keys() == {"both", *(f"{n}{i}" for n in ("x", "yy") for i in range(4))}
    last = stores[0].commits.commits()[7]["batches"]
    assert found[0]["both"] == stores[0].batches("results", last).where("domain = 'both'").first().comment_count_hint


def test_unfinished_commit_files_do_not_count_and_block_nobody(spark, store):
    add(store, "results", result("a", 1))
    unfinished = f"{store.root}/commits/{1:020d}.json"
    with open(unfinished, "w") as f:
        f.write('{"batches"')
    late = add(store, "results", result("b", 9), commit=False)
    add(store, "results", result("b", 2))
    assert sorted(store.commits.commits()) == [0, 2]
    store.compact("results")
    assert hints(store) == {"a": 1, "b": 2}
    with open(unfinished, "w") as f:  # its driver was only slow: the commit has its place before the next one's
        f.write('{"batches": ["%s"], "series": null}\n' % late)
    other = Store(spark, store.root)
    assert hints(other) == {"a": 1, "b": 2}
    other.compact("results")
    assert hints(other) == {"a": 1, "b": 2} and other.log("results").count() == 2


def test_creating_on_another_file_system(spark, tmp_path, monkeypatch):
    files = commits.SharedFiles(spark, str(tmp_path))
    files.local = False  # by the file system's own create
    assert files.create(f"{tmp_path}/c/1.json", "one\n") and not files.create(f"{tmp_path}/c/1.json", "two\n")
    assert files.read(f"{tmp_path}/c/1.json") == "one\n"
    assert files.entries(f"{tmp_path}/none") == []


def test_compacted_table_is_read_without_shuffle(store):
    for i in range(3):
        add(store, "results", *[result(f"d{j}", i) for j in range(i, 40)])
        add(store, "wp_candidates", *[(0, f"d{j}", f"h{i}", "") for j in range(i, 40)])
    before = hints(store), sorted(map(tuple, store.table("wp_candidates").collect()))
    for table in ("results", "wp_candidates"):
        assert "Exchange" in plan(store.table(table))
        store.compact(table)
        assert "Exchange" not in plan(store.table(table))
    assert (hints(store), sorted(map(tuple, store.table("wp_candidates").collect()))) == before


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_buckets_with_new_keys_are_written_again(store):
    add(store, "results", *[result(f"d{j}", 0) for j in range(200)])
    store.compact("results")
    first = snapshot(store).folders
    assert set(first) == set(range(8))
    add(store, "results", result("d5", 7), result("new", 8))
    assert hints(store) == {**{f"d{j}": 0 for j in range(200)}, "d5": 7, "new": 8}
    store.compact("results")
    second = snapshot(store).folders
    assert 1 <= sum(first[k] != second[k] for k in first) <= 2
    assert hints(store) == {**{f"d{j}": 0 for j in range(200)}, "d5": 7, "new": 8}
    store.compact("results")  # nothing to do
    assert snapshot(store).folders == second and len(store.commits.commits()) == 4


def snapshot(store, table="results"):
    return store._snapshot(table, store.commits.commits())


def test_batches_since_a_snapshot_plan_no_shuffle_of_it(store):
    add(store, "results", *[result(f"d{j}", 0) for j in range(200)])
    store.compact("results")
    add(store, "results", result("d5", 7))
    text = plan(store.table("results"))
    assert "SortMergeJoin" not in text and "LeftSemi" in text and "LeftAnti" in text


def test_commits_during_a_compaction_are_kept(spark, store, monkeypatch):
    add(store, "results", result("a", 1), result("b", 1))
    other = Store(spark, store.root, buckets=8)
    append = store.commits.append

    def late(body):
        add(other, "results", result("b", 2), result("c", 2))
        other.compact("results")  # covers more than the one that is about to be committed
        return append(body)

    monkeypatch.setattr(store.commits, "append", late)
    store.compact("results")
    assert hints(other) == hints(Store(spark, store.root)) == {"a": 1, "b": 2, "c": 2}


def test_first_rows_stay_first_through_snapshots(store):
    add(store, "wp_candidates", (5, "a", "first", ""), (6, "b", "first", ""))
    store.compact("wp_candidates")
    add(store, "wp_candidates", (0, "a", "later", ""), (0, "c", "new", ""))
    want = [("a", "first", ""), ("b", "first", ""), ("c", "new", "")]
    assert sorted(map(tuple, store.table("wp_candidates").collect())) == want
    store.compact("wp_candidates")
    assert sorted(map(tuple, store.table("wp_candidates").collect())) == want


def test_null_keys_and_empty_tables(store):
    store.compact("results")  # nothing was committed
    assert hints(store) == {}
    add(store, "results", result(None, 1))
    store.compact("results")
    add(store, "results", result(None, 2), result("a", 3))
    assert hints(store) == {None: 2, "a": 3}
    store.compact("results")
    assert hints(store) == {None: 2, "a": 3}
    add(store, "wp_candidates", (0, "w", "h", ""))  # no batch of it has results
    assert hints(store) == {None: 2, "a": 3}


def test_vacuum_deletes_what_nothing_refers_to(store):
    one = add(store, "results", result("a", 1))
    lost = add(store, "results", result("lost", 1), commit=False)
    store.compact("results")
    two = add(store, "results", result("a", 2))
    store.compact("results")
    three = add(store, "results", result("b", 3))
    kept = add(store, "wp_candidates", (0, "w", "h", ""))
    for name in ("selections/s1", "scanned/q1"):
        store.spark.range(1).write.parquet(f"{store.root}/{name}")
    assert store.vacuum(grace_seconds=3600) == []
    before = hints(store)
    old_snapshots = set(os.listdir(f"{store.root}/snapshots/results")) - set(snapshot(store).folders.values())
    gone = store.vacuum(grace_seconds=0)
    assert set(gone) == {
        *(f"results/batch_id={b}" for b in (one, lost, two)), *(f"snapshots/results/{s}" for s in old_snapshots),
        "selections/s1", "scanned/q1",
    }
    assert os.listdir(f"{store.root}/wp_candidates") == [f"batch_id={kept}"]
    assert f"batch_id={three}" in os.listdir(f"{store.root}/results")
    assert hints(store) == before == {"a": 2, "b": 3}
    add(store, "results", result("a", 4))
    store.compact("results")
    assert hints(store) == {"a": 4, "b": 3} and store.vacuum(grace_seconds=0) and hints(store) == {"a": 4, "b": 3}
