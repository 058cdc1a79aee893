"""No database runs here: options, statements and the order of the transaction are checked instead."""

import pytest
from pyspark.sql import types as T

from rowhaul.sinks.jdbc import JdbcTable, move_sql, write_options
from rowhaul.sources.jdbc import DRIVERS, Split, scan_options


def test_query_text_is_not_changed():
    text = "select id from public.users order by id"
    assert scan_options("postgresql", "jdbc:postgresql://h/d", text)["query"] == text
    split = scan_options("oracle", "jdbc:oracle:thin:@h", text, Split("id", 0, 1000, 16), 500)
    assert split["dbtable"] == f"({text}) q" and split["numPartitions"] == "16" and split["fetchsize"] == "500"
    assert "query" not in split and split["driver"] == DRIVERS["oracle"]


def test_bulk_and_single_row_writes():
    assert write_options("postgresql", "u", "t", 1000)["reWriteBatchedInserts"] == "true"
    assert write_options("mysql", "u", "t", 1000)["rewriteBatchedStatements"] == "true"
    single = write_options("mysql", "u", "t", 1000, native_bulk=False)
    assert single["batchsize"] == "1" and "rewriteBatchedStatements" not in single


def test_move_statement_quotes_names():
    assert move_sql("mysql", ("d", "t"), ("d", "s"), ["a`b"]) == (
        "INSERT INTO `d`.`t` (`a``b`) SELECT `a``b` FROM (SELECT `a``b`, ROW_NUMBER() OVER (PARTITION BY `haul_row` ORDER BY "
        "`haul_row`) AS haul_copy FROM `d`.`s` WHERE `haul_commit` = ?) AS s WHERE haul_copy = 1"
    )


class FakeConnection:
    """Records statements; fails on request; knows whether a commit is already logged."""

    def __init__(self, logged=False, broken=None, missing=()):
        self.events, self.logged, self.broken, self.missing = [], logged, broken, missing

    def setAutoCommit(self, on):
        self.events.append(("auto", on))

    def createStatement(self):
        return FakeStatement(self)

    def prepareStatement(self, text):
        return FakeStatement(self, text)

    def commit(self):
        self.events.append(("commit",))

    def rollback(self):
        self.events.append(("rollback",))

    def close(self):
        self.events.append(("close",))


class FakeStatement:
    def __init__(self, connection, text=None):
        self.connection, self.text = connection, text

    def setString(self, index, value):
        self.value = value

    def executeQuery(self, text):
        if any(m in text for m in self.connection.missing):
            raise RuntimeError("no such table")
        return self

    def executeUpdate(self, text=None):
        text = text or self.text
        self.connection.events.append(text)
        if self.connection.broken and text.startswith(self.connection.broken):
            raise RuntimeError("broken")
        if text.startswith("UPDATE"):
            return int(self.connection.logged)
        return 3 if text.startswith("INSERT") and "SELECT" in text else 1

    def close(self):
        pass


def _table(spark, connection):
    return JdbcTable(spark, "postgresql", "jdbc:postgresql://h/d", ("public", "t"), connect=lambda: connection)


def test_move_is_one_transaction(spark):
    connection = FakeConnection()
    assert _table(spark, connection).move(["id"], "c1") == 3
    kinds = [e if isinstance(e, tuple) else e.split()[0] for e in connection.events]
    assert kinds == [("auto", False), "UPDATE", "INSERT", "INSERT", "DELETE", ("commit",), ("close",)]


def test_logged_commit_is_not_moved_again(spark):
    connection = FakeConnection(logged=True)
    assert _table(spark, connection).move(["id"], "c1") == 0
    assert not [e for e in connection.events if isinstance(e, str) and e.startswith("INSERT")]


def test_failed_move_rolls_back(spark):
    connection = FakeConnection(broken="INSERT")
    with pytest.raises(RuntimeError):
        _table(spark, connection).move(["id"], "c1")
    assert connection.events[-2:] == [("rollback",), ("close",)] and ("commit",) not in connection.events


def test_prepare_creates_what_is_missing(spark):
    connection = FakeConnection(missing=("haul_stage", "haul_log"))
    schema = T.StructType([T.StructField("id", T.LongType(), False)])
    _table(spark, connection).prepare(schema, True)
    assert [e for e in connection.events if isinstance(e, str)] == [
        'CREATE TABLE "public"."t" ("id" bigint NOT NULL)',
        'CREATE TABLE "public"."t_haul_stage" ("id" bigint NOT NULL, "haul_row" bigint NOT NULL, "haul_commit" varchar(64) NOT NULL)',
        'CREATE TABLE "public"."t_haul_log" ("haul_commit" varchar(64) NOT NULL)',
    ]
    connection = FakeConnection()
    _table(spark, connection).prepare(schema, False)
    assert not [e for e in connection.events if isinstance(e, str)]
    with pytest.raises(ValueError):
        _table(spark, connection).prepare(T.StructType([T.StructField("at", T.TimestampType())]), True)


def test_an_earlier_attempt_is_cleared(spark):
    connection = FakeConnection()
    assert _table(spark, connection).begin("c1")
    assert [e.split()[0] for e in connection.events if isinstance(e, str)] == ["DELETE", "UPDATE"]
    assert not _table(spark, FakeConnection(logged=True)).begin("c1")


def test_table_lookup(spark):
    assert _table(spark, FakeConnection()).exists() and not _table(spark, FakeConnection(missing=('"t"',))).exists()
