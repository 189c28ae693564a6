"""The commit log, pinned readers, changed keys, and refreshes of changed parts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from touchtrail.sources import files, store, versions

SCHEMA = "id int, month string, amount int"
ROWS = [(i, ("2001-01", "2001-02", "2001-03", None)[i % 4], i * 10) for i in range(40)]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_only_one_writer_creates_a_file(spark, tmp_path):
    path = f"file://{tmp_path}/log/1.json"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: files.create_text(spark, path, f"writer {i}é"), range(8)))
    assert made.count(True) == 1
    assert files.read_text(spark, path) == f"writer {made.index(True)}é"
    assert files.names(spark, f"file://{tmp_path}/log") == ["1.json"]


def test_concurrent_publishers_are_all_visible_in_order(spark, tmp_path):
    root = str(tmp_path)

    def publish(i):
        store.publish_tables(spark, {f"t{i % 3}": table(spark, [(i, "m", i)])}, root)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(publish, range(6)))
    assert versions.numbers(spark, root) == [1, 2, 3, 4, 5, 6]
    seen = set()
    for n in range(1, 7):
        now = versions.entry(spark, root, n)
        new = [t for t in now.tables.values() if t.origin == n]
        assert len(new) == 1
        seen |= {r["id"] for name in now.tables for r in versions.read(spark, now, name).collect()}
    assert seen == set(range(6))
    assert set(versions.entry(spark, root).tables) == {"t0", "t1", "t2"}


def test_readers_stay_with_their_version(spark, tmp_path):
    root = str(tmp_path)
    store.publish_tables(spark, {"t": table(spark, ROWS)}, root)
    pinned = store.read_published(spark, root, ["t"], store.current_version(spark, root))["t"]
    store.publish_tables(spark, {"t": table(spark, ROWS[:3])}, root)
    assert pinned.count() == 40
    assert store.read_published(spark, root, ["t"])["t"].count() == 3
    assert store.read_published(spark, root, ["t"], 1)["t"].count() == 40


def test_expiry_removes_what_no_kept_version_reads(spark, tmp_path):
    root = str(tmp_path)
    store.publish_tables(spark, {"a": table(spark, ROWS), "b": table(spark, ROWS)}, root)
    for n in (5, 7):
        store.publish_tables(spark, {"a": table(spark, ROWS[:n])}, root)
    at_work = versions.write(table(spark, ROWS), root, "c")
    gone = versions.expire(spark, root, keep=1)
    assert len(gone) == 2 and not any(files.exists(spark, f) for f in gone)
    assert versions.numbers(spark, root) == [3]
    left = store.read_published(spark, root, ["a", "b"])
    assert (left["a"].count(), left["b"].count()) == (7, 40)
    assert files.exists(spark, at_work.parts[""])
    with pytest.raises(ValueError):
        versions.expire(spark, root, keep=0)


def test_changed_keys(spark):
    old = table(spark, [(1, "a", 1), (2, "a", 2), (2, "a", 2), (3, "a", 3), (None, "a", 4), (5, None, 5)])
    new = table(spark, [(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, "a", 4), (None, "a", 4), (5, None, None)])
    found = versions.changed_keys(old, new, ["id"])
    assert rows(found) == [(2, "changed"), (3, "changed"), (4, "added"), (5, "changed")]
    assert rows(versions.changed_keys(new, old.where("id = 1"), ["id"])) == [
        (2, "removed"), (3, "removed"), (4, "removed"), (5, "removed"), (None, "removed")]
    assert versions.changed_keys(new, new.repartition(3), ["id"]).count() == 0


def doubled(df):
    return df.select("id", "month", (F.col("amount") * 2).alias("twice"))


def refresh(spark, root, source, **more):
    return versions.refresh(
        spark, root, "fact", source, F.col("month"), doubled, F.col("month"), **more)


def test_refresh_rewrites_changed_parts_alone(spark, tmp_path):
    root = str(tmp_path)
    first = refresh(spark, root, table(spark, ROWS))
    assert first.rewritten == ("2001-01", "2001-02", "2001-03", "NULL") and first.removed == ()
    folders = versions.entry(spark, root).tables["fact"].parts

    # Nothing new; rows in another order and files.
    same = refresh(spark, root, table(spark, ROWS[::-1]).repartition(5))
    assert same.rewritten == () and versions.entry(spark, root).tables["fact"].parts == folders

    # A late row, a changed row, a deleted row, a month gone, a new month: all but 2001-03 stay.
    late = [*ROWS, (99, "2001-02", 7)]
    for source, rewritten, removed in (
        (late, ("2001-02",), ()),
        ([r if r[0] != 1 else (1, "2001-02", -1) for r in late], ("2001-02",), ()),
        ([r for r in late if r[0] != 2], ("2001-02", "2001-03"), ()),
        ([r for r in late if r[1] is not None], ("2001-03",), ("NULL",)),
        ([r for r in late if r[1] != "2001-01"] + [(100, "2002-01", 1)], ("2002-01", "NULL"), ("2001-01",)),
    ):
        before = versions.entry(spark, root).tables["fact"].parts
        done = refresh(spark, root, table(spark, source))
        assert (done.rewritten, done.removed) == (rewritten, removed)
        now = versions.entry(spark, root)
        assert rows(versions.read(spark, now, "fact")) == rows(doubled(table(spark, source)))
        for part, folder in now.tables["fact"].parts.items():
            assert (before.get(part) == folder) == (part not in rewritten)


def test_equal_rows_do_not_cancel_in_digests(spark):
    one = table(spark, [(1, "m", 1), (2, "m", 2)])
    more = table(spark, [(1, "m", 1), (2, "m", 2), (3, "m", 3), (3, "m", 3)])
    other = table(spark, [(1, "m", 1), (2, "m", 2), (4, "m", 4), (4, "m", 4)])
    digests = {str(versions.part_digests(t, F.col("month"))) for t in (one, more, other)}
    assert len(digests) == 3


def test_touched_parts_and_tables_of_the_same_commit(spark, tmp_path):
    root = str(tmp_path)
    refresh(spark, root, table(spark, ROWS))
    done = refresh(spark, root, table(spark, ROWS), touched=["2001-03", "1999-01"],
                   others={"note": table(spark, ROWS[:1])})
    assert done.rewritten == ("2001-03",) and done.number == 2
    assert versions.read(spark, versions.entry(spark, root), "note").count() == 1


def test_two_refreshes_at_once_conflict(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    refresh(spark, root, table(spark, ROWS))
    original = versions.write_parts

    def slow(*args):
        written = original(*args)
        monkeypatch.setattr(versions, "write_parts", original)
        refresh(spark, root, table(spark, ROWS[:20]))
        return written

    monkeypatch.setattr(versions, "write_parts", slow)
    with pytest.raises(versions.Conflict):
        refresh(spark, root, table(spark, ROWS[:30]))
    assert versions.read(spark, versions.entry(spark, root), "fact").count() == 20


def test_a_failed_build_leaves_the_last_version(spark, tmp_path):
    root = str(tmp_path)
    refresh(spark, root, table(spark, ROWS))
    with pytest.raises(Exception, match="no good"):
        versions.refresh(
            spark, root, "fact", table(spark, ROWS[:9]), F.col("month"),
            lambda df: doubled(df).withColumn("twice", F.raise_error(F.lit("no good")).cast("int")),
            F.col("month"))
    assert versions.numbers(spark, root) == [1]
    assert versions.read(spark, versions.entry(spark, root), "fact").count() == 40


def test_all_rows_gone(spark, tmp_path):
    root = str(tmp_path)
    refresh(spark, root, table(spark, ROWS))
    done = refresh(spark, root, table(spark, []))
    assert len(done.removed) == 4 and versions.read(spark, versions.entry(spark, root), "fact").count() == 0


def test_the_fact_is_rewritten_in_few_months(spark, sf_dir):
    from touchtrail.plans import registry

    root, done = registry.refreshed(spark, sf_dir)
    fact = registry.stored(spark, sf_dir).fct_attributed_revenue
    new = versions.entry(spark, root, done.number).tables["fct_attributed_revenue"]
    old = versions.entry(spark, root, done.number - 1).tables["fct_attributed_revenue"]
    assert done.removed == ("19900101",) and 2 <= len(done.rewritten) < len(new.parts) / 2
    assert sum(old.parts.get(p) == f for p, f in new.parts.items()) == len(new.parts) - len(done.rewritten)
    got = versions.read(spark, versions.entry(spark, root, done.number), "fct_attributed_revenue")
    assert got.exceptAll(fact).count() == fact.exceptAll(got).count() == 0
