"""Growing snapshots: splits, deletes, repeated batches, untouched files."""

import random

from pyspark.sql import functions as F

from casequarry.sources.snapshots import Leaf, Snapshot

SCHEMA = "k long, v int, depth string"


def rows_of(snapshot):
    return sorted((tuple(r) for r in snapshot.read().collect()), key=str)


def snapshot(spark, folder, capacity=20):
    return Snapshot(spark, str(folder), "k", "v", spark.createDataFrame([], SCHEMA).schema, capacity)


def covers(leaves):
    """Every hash has one leaf."""
    return sum((1 << 40) >> x.depth for x in leaves) == 1 << 40 and len({(x.depth, x.code) for x in leaves}) == len(leaves)


def test_grows_and_forgets_like_a_dictionary(spark, tmp_path):
    r, snap, want, paths = random.Random(5), snapshot(spark, tmp_path), {}, {}
    for number in range(4):
        batch = [(r.randrange(150), r.randrange(9), r.choice("xyz")) for _ in range((10, 80, 60, 3)[number])]
        for k, v, d in batch:
            old = want.get(k)
            # The greater version; of equal ones the change, and of equal changes the last by content.
            if old is None or (v, 1, d) >= ((old[0], old[2] == number, old[1]) if old[0] == v else (old[0], 0, "")):
                want[k] = (v, d, number)
        snap.upsert(spark.createDataFrame(batch, SCHEMA), number)
        assert rows_of(snap) == sorted(((k, v, d) for k, (v, d, _) in want.items()), key=str)
        _, leaves = snap.leaves()
        assert covers(leaves) and all(x.n <= 20 for x in leaves) and sum(x.n for x in leaves) == len(want)
        if number == 3:
            kept = {p for p in paths if p in {x.path for x in leaves}}
            assert len(kept) >= len(paths) - 3  # three changes touch three leaves at most
        paths = {x.path for x in leaves if x.path}
    assert len(leaves) > 4
    snap.upsert(spark.createDataFrame([(1, 99, "again")], SCHEMA), 3)  # a number that is done
    assert (1, 99, "again") not in rows_of(snap)

    gone = [k for k in want if k % 3 == 0]
    snap.delete(spark.createDataFrame([(k,) for k in [*gone, 5000, None]], "k long"), 4)
    for k in gone:
        del want[k]
    assert rows_of(snap) == sorted(((k, v, d) for k, (v, d, _) in want.items()), key=str)
    assert {x.path for x in snap.leaves()[1] if x.path} == paths  # no row was written
    snap.upsert(spark.createDataFrame([(gone[0], 0, "back")], SCHEMA), 5)
    want[gone[0]] = (0, "back", 5)
    assert rows_of(snap) == sorted(((k, v, d) for k, (v, d, _) in want.items()), key=str)
    snap.vacuum(6)
    assert rows_of(snap) == sorted(((k, v, d) for k, (v, d, _) in want.items()), key=str)
    assert not any(x.hidden for x in snap.leaves()[1]) and covers(snap.leaves()[1])


def test_empty_and_null(spark, tmp_path):
    snap = snapshot(spark, tmp_path)
    assert rows_of(snap) == [] and snap.leaves() == (-1, [Leaf(0, 0)])
    snap.delete(spark.createDataFrame([(1,)], "k long"), 0)
    snap.upsert(spark.createDataFrame([], SCHEMA), 1)
    assert rows_of(snap) == []
    snap.upsert(spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, None, "c")], SCHEMA), 2)
    assert rows_of(snap) == [(1, None, "c"), (None, 2, "b")]


def test_a_batch_that_failed_is_replaced(spark, tmp_path):
    snap = snapshot(spark, tmp_path)
    snap.upsert(spark.createDataFrame([(i, 1, "a") for i in range(50)], SCHEMA), 0)
    before = rows_of(snap)
    spark.createDataFrame([(9, 9, "junk")], SCHEMA).withColumns({"__depth": F.lit(2), "__code": F.lit(1)}).write.partitionBy(
        "__depth", "__code").parquet(f"{tmp_path}/batches/batch=00000001")  # written, but no manifest
    assert rows_of(snap) == before
    snap.upsert(spark.createDataFrame([(3, 5, "new")], SCHEMA), 1)
    assert rows_of(snap) == sorted([*(r for r in before if r[0] != 3), (3, 5, "new")], key=str)


def test_leaves_share_files(spark, tmp_path, monkeypatch):
    """Files are as many as the rows need, not as there are leaves; a leaf's old rows and tombstones do not count in a shared folder."""
    from casequarry.sources import snapshots
    monkeypatch.setattr(snapshots, "SHELF_ROWS", 500)
    snap = snapshot(spark, tmp_path)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(2)
    snap.upsert(frame([(i, 1, "a") for i in range(2000)]), 0)
    leaves = snap.leaves()[1]
    assert len(leaves) > 100 and covers(leaves) and len({x.path for x in leaves}) == 4
    assert len(list((tmp_path / "batches").rglob("part-*.parquet"))) <= 16
    want = {i: (1, "a") for i in range(2000)}
    ids = lambda keys: spark.createDataFrame([(k,) for k in keys], "k long")
    snap.delete(ids(range(0, 2000, 2)), 1)  # hides rows in every leaf
    snap.upsert(frame([(4, 2, "back"), (5, 2, "new")]), 2)
    snap.delete(ids([7, 8, 9, *range(100, 300)]), 3)  # in leaves with and without tombstones
    for k in [*range(0, 2000, 2), 7, 8, 9, *range(100, 300)]:
        want.pop(k, None)
    want |= {4: (2, "back"), 5: (2, "new")}
    state = lambda: sorted(((k, *v) for k, v in want.items()), key=str)
    assert rows_of(snap) == state()
    code = {r["k"]: r["c"] for r in ids(range(2000)).selectExpr("k", "shiftrightunsigned(xxhash64(k), 24) AS c").collect()}
    leaf = next(x for x in snap.leaves()[1] if x.path and code[4] >> 40 - x.depth == x.code)
    near = [k for k in want if k != 4 and code[k] >> 40 - leaf.depth == leaf.code]
    snap.delete(ids(near[:1]), 4)  # the first delete hid 4, in tombstones that other leaves of the folder still have
    for k in near[:1]:
        del want[k]
    assert rows_of(snap) == state() and 4 in want
    snap.vacuum(5)
    assert rows_of(snap) == state() and covers(snap.leaves()[1]) and sum(x.n for x in snap.leaves()[1]) == len(want)
