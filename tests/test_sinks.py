import os

import pytest

from footfall import schemas
from footfall.sinks import tables
from footfall.sinks.jdbc import (
    _execute, ledger_statement, merge_statements, quoted, replace_task_statements, staging_name, write_options,
)
from footfall.sources.jdbc import jdbc_options

KEYS = ["date", "user_id", "ad_id"]


@pytest.fixture
def counts(spark):
    def make(*rows):
        return spark.createDataFrame([("2024-01-01", u, a, n) for u, a, n in rows], schemas.AD_USER_CLICK_COUNT)

    return make


@pytest.fixture
def content(spark, folder):
    def read(path=folder):
        rows = tables.read_table(spark, path, schemas.AD_USER_CLICK_COUNT).collect()
        return sorted((r["user_id"], r["ad_id"], r["click_count"]) for r in rows)

    return read


def test_append_keeps_sink_order_and_duplicates(spark, folder):
    df = spark.createDataFrame([(5, 1, 2, 3, 4)], "pay_count long, task_id long, category_id long, click_count long, order_count long")
    for _ in range(2):
        tables.append_table(df, f"{folder}/t", schemas.TOP10_CATEGORY)
    back = spark.read.parquet(f"{folder}/t")
    assert back.columns == schemas.TOP10_CATEGORY.names
    assert [tuple(r) for r in back.collect()] == [(1, 2, 3, 4, 5)] * 2


def test_upsert_replace(counts, content, folder):
    tables.upsert_table(counts((1, 1, 5), (2, 1, 7)), folder, KEYS, 0)
    tables.upsert_table(counts((1, 1, 9), (3, 1, 1)), folder, KEYS, 1)
    assert content() == [(1, 1, 9), (2, 1, 7), (3, 1, 1)]


def test_upsert_add_counts_a_write_sent_again_once(counts, content, folder):
    tables.upsert_table(counts((1, 1, 5)), folder, KEYS, 0, how="add")
    for _ in range(3):
        tables.upsert_table(counts((1, 1, 2), (2, 1, 1), (2, 1, 1)), folder, KEYS, 1, how="add")
    assert content() == [(1, 1, 7), (2, 1, 2)]
    with pytest.raises(ValueError):
        tables.upsert_table(counts(), folder, KEYS, 2, how="multiply")


def test_a_write_that_died_while_folders_were_replaced_is_put_right(spark, counts, content, folder, monkeypatch):
    tables.upsert_table(counts((1, 1, 5), (2, 1, 7)), folder, KEYS, 0, how="add")
    overwrite = tables._overwrite_folders

    def dies(rows, path, by):
        tables._remove(spark, f"{path}/date=2024-01-01")
        raise RuntimeError("executor and driver gone")

    monkeypatch.setattr(tables, "_overwrite_folders", dies)
    with pytest.raises(RuntimeError):
        tables.upsert_table(counts((1, 1, 1)), folder, KEYS, 1, how="add")
    monkeypatch.setattr(tables, "_overwrite_folders", overwrite)
    tables.upsert_table(counts((1, 1, 1)), folder, KEYS, 1, how="add")
    assert content() == [(1, 1, 6), (2, 1, 7)]


def test_other_days_are_left_alone(spark, folder):
    def day(d, n):
        return spark.createDataFrame([(f"2024-01-0{d}", 1, 1, n)], schemas.AD_USER_CLICK_COUNT)

    files = lambda d: sorted(os.listdir(f"{folder}/date=2024-01-0{d}"))
    tables.upsert_table(day(1, 1).union(day(2, 1)), folder, KEYS, 0)
    before = files(1), files(2)
    tables.upsert_table(day(2, 5), folder, KEYS, 1)
    assert files(1) == before[0] and files(2) != before[1]
    # Merged rows of earlier writes are cleared away.
    assert os.listdir(f"{folder}.writes") == ["1"]


def test_insert_new(spark, folder):
    def users(*ids):
        return spark.createDataFrame([(i,) for i in ids], schemas.AD_BLACKLIST)

    tables.insert_new(users(1, 2, 2), folder, ["user_id"], 0)
    for _ in range(2):
        tables.insert_new(users(2, 3), folder, ["user_id"], 1)
    read = tables.read_table(spark, folder, schemas.AD_BLACKLIST)
    assert sorted(r["user_id"] for r in read.collect()) == [1, 2, 3]


def test_replace_groups(spark, folder):
    def top(*rows):
        return spark.createDataFrame(rows, schemas.AD_PROVINCE_TOP3)

    keys = ["date", "province"]
    tables.replace_groups(top(("d1", "p", 1, 9), ("d1", "p", 2, 8), ("d1", "q", 3, 1)), folder, keys, 0)
    tables.replace_groups(top(("d1", "p", 5, 10)), folder, keys, 1)
    read = tables.read_table(spark, folder, schemas.AD_PROVINCE_TOP3)
    assert sorted(tuple(r) for r in read.collect()) == [("d1", "p", 5, 10), ("d1", "q", 3, 1)]


def test_nothing_written_yet(spark, counts, content, folder):
    assert content(f"{folder}/none") == []
    tables.upsert_table(counts(), f"{folder}/none", KEYS, 0)
    assert content(f"{folder}/none") == []


class Database:
    """Stands for a connection: notes what is run, and knows which ledger entries it has seen."""

    def __init__(self):
        self.ran, self.open, self.ledger = [], [], set()

    getConnection = createStatement = lambda self, *_: self
    setAutoCommit = close = lambda self, *_: None

    def executeUpdate(self, sql):
        if "FAIL" in sql:
            raise RuntimeError("lost connection")
        known = sql.startswith("INSERT INTO ledger") and sql in self.ledger
        if not known:
            self.open.append(sql)
        return 0 if known else 1

    def commit(self):
        self.ledger |= {s for s in self.open if s.startswith("INSERT INTO ledger")}
        self.ran, self.open = self.ran + [s for s in self.open if not s.startswith("INSERT INTO ledger")], []

    def rollback(self):
        self.open = []


def test_a_delivery_is_merged_once():
    database, guard = Database(), ledger_statement("ledger", ("ad_stat", 7))
    with pytest.raises(RuntimeError):
        _execute(database, "u", None, None, ["UPDATE t", "FAIL"], guard)
    assert database.ran == [] and database.ledger == set()
    for _ in range(3):
        _execute(database, "u", None, None, ["UPDATE t", "INSERT t"], guard)
    assert database.ran == ["UPDATE t", "INSERT t"]
    _execute(database, "u", None, None, ["UPDATE t"], ledger_statement("ledger", ("ad_stat", 8)))
    _execute(database, "u", None, None, ["DROP s"])
    assert database.ran == ["UPDATE t", "INSERT t", "UPDATE t", "DROP s"]


def test_ledger_statement():
    assert ledger_statement("l", ("it's", 3)) == (
        "INSERT INTO l (query_name, batch_id) SELECT 'it''s', 3 FROM (SELECT 1 AS one_row) o "
        "WHERE NOT EXISTS (SELECT 1 FROM l l WHERE l.query_name = 'it''s' AND l.batch_id = 3)"
    )
    with pytest.raises(ValueError):
        ledger_statement("l", ("q", "1 OR 1=1"))


def test_jdbc_options():
    assert jdbc_options("u", "t", user="a", password="b", split=("id", 0, 100, 8)) == {
        "url": "u", "dbtable": "t", "fetchsize": "10000", "user": "a", "password": "b",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }


def test_writers_have_few_connections_and_large_batches():
    options = write_options("u", "t", user="a", connections=4)
    assert (options["numPartitions"], options["batchsize"], options["user"]) == ("4", "5000", "a")
    assert "partitionColumn" not in options


def test_merge_statements():
    columns, keys = ["date", "ad_id", "n"], ["date", "ad_id"]
    assert merge_statements("t", "st", columns, keys, "replace") == [
        "UPDATE t t JOIN st s ON t.`date` = s.`date` AND t.`ad_id` = s.`ad_id` SET t.`n` = s.`n`",
        "INSERT INTO t (`date`, `ad_id`, `n`) SELECT s.`date`, s.`ad_id`, s.`n` FROM st s "
        "WHERE NOT EXISTS (SELECT 1 FROM t t WHERE t.`date` = s.`date` AND t.`ad_id` = s.`ad_id`)",
    ]
    (merge,) = merge_statements("t", "st", columns, keys, "replace", "standard")
    assert merge.startswith('MERGE INTO t t USING st s ON t."date" = s."date" AND') and 'SET "n" = s."n"' in merge
    assert merge_statements("t", "st", ["user_id"], ["user_id"], "insert_new")[0].endswith(
        "WHERE NOT EXISTS (SELECT 1 FROM t t WHERE t.`user_id` = s.`user_id`)"
    )
    delete, insert = merge_statements("t", "st", columns, ["date"], "replace_groups")
    assert delete == "DELETE FROM t WHERE EXISTS (SELECT 1 FROM st s WHERE t.`date` = s.`date`)"
    assert insert == "INSERT INTO t (`date`, `ad_id`, `n`) SELECT s.`date`, s.`ad_id`, s.`n` FROM st s"
    with pytest.raises(ValueError):
        merge_statements("t", "st", columns, keys, "append")


def test_merge_adds_to_known_keys():
    columns, keys = ["date", "n"], ["date"]
    assert merge_statements("t", "st", columns, keys, "add")[0].endswith("SET t.`n` = COALESCE(t.`n`, 0) + s.`n`")
    (merge,) = merge_statements("t", "st", columns, keys, "add", "standard")
    assert 'SET "n" = COALESCE(t."n", 0) + s."n" WHEN NOT MATCHED' in merge
    # Keys alone: a known row has nothing to change.
    assert len(merge_statements("t", "st", keys, keys, "replace")) == 1


def test_names_are_quoted():
    assert quoted("a`b", "mysql") == "`a``b`" and quoted('a"b', "standard") == '"a""b"'


def test_replacing_a_task_names_it_even_without_rows():
    assert replace_task_statements("t", "st", ["task_id", "n"], 7) == [
        "DELETE FROM t WHERE `task_id` = 7",
        "INSERT INTO t (`task_id`, `n`) SELECT `task_id`, `n` FROM st",
    ]
    with pytest.raises(ValueError):
        replace_task_statements("t", "st", ["task_id"], "7 OR 1=1")


def test_every_call_stages_apart():
    assert staging_name("t") != staging_name("t")
