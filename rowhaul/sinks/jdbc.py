"""JDBC tables as a destination.

Spark's JDBC writer commits once per task, and a task that is repeated after
its commit would add its rows twice. So rows go to a staging table together
with their commit and a row number; a single transaction on the driver then
moves one copy of each row to the destination and records the commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowhaul import storage
from rowhaul.operators.schema import check_names, require_flat
from rowhaul.sources.jdbc import DRIVERS
from rowhaul.types import SINK_CAPABILITIES, create_table_sql, quote_identifier, quote_name, sql_type

# Driver settings that turn batches into bulk inserts (fixed values).
BULK_URL_OPTIONS = {
    "postgresql": {"reWriteBatchedInserts": "true", "stringtype": "unspecified"},
    "sqlserver": {"useBulkCopyForBatchInsert": "true"},
    "mysql": {"rewriteBatchedStatements": "true"},
    "oracle": {},
}
ROW, COMMIT = "haul_row", "haul_commit"


def write_options(provider: str, url: str, table: str, batch_rows: int, native_bulk: bool = True) -> dict[str, str]:
    options = {
        "url": url, "driver": DRIVERS[provider], "dbtable": table,
        "batchsize": str(batch_rows if native_bulk else 1),
    }
    return {**options, **BULK_URL_OPTIONS[provider]} if native_bulk else options


def move_sql(provider: str, table: tuple[str, ...], staging: tuple[str, ...], columns: list[str]) -> str:
    """One copy of every staged row of a commit into the destination."""
    names = ", ".join(quote_identifier(provider, c) for c in columns)
    row, commit = quote_identifier(provider, ROW), quote_identifier(provider, COMMIT)
    alias = "" if provider == "oracle" else "AS "
    return (
        f"INSERT INTO {quote_name(provider, *table)} ({names}) SELECT {names} FROM (SELECT {names}, "
        f"ROW_NUMBER() OVER (PARTITION BY {row} ORDER BY {row}) {alias}haul_copy "
        f"FROM {quote_name(provider, *staging)} WHERE {commit} = ?) {alias}s WHERE haul_copy = 1"
    )


class JdbcTable:
    """Destination table in one of the four databases."""

    case_sensitive = False

    def __init__(
        self, spark: SparkSession, provider: str, url: str, table: tuple[str, ...],
        batch_rows: int = 1000, native_bulk: bool = True, properties: dict[str, str] | None = None, connect=None,
    ):
        self.spark, self.provider, self.url, self.table = spark, provider, url, table
        self.batch_rows, self.native_bulk, self.properties = batch_rows, native_bulk, dict(properties or {})
        self.staging = (*table[:-1], f"{table[-1]}_haul_stage")
        self.log = (*table[:-1], f"{table[-1]}_haul_log")
        self.capabilities = SINK_CAPABILITIES[provider]
        self._connect = connect or self._driver_connection

    @property
    def location(self) -> list[str]:
        return [self.url, *self.table]

    def _driver_connection(self):
        jvm = self.spark._jvm
        settings = jvm.java.util.Properties()
        for key, value in self.properties.items():
            settings.setProperty(key, value)
        return jvm.java.sql.DriverManager.getConnection(self.url, settings)

    def validate(self, schema: T.StructType) -> None:
        check_names(schema.fieldNames(), "destination columns", case_sensitive=False)
        require_flat(schema)
        for field in schema.fields:
            sql_type(self.provider, field)

    def prepare(self, schema: T.StructType, create: bool) -> None:
        """Run ``CREATE TABLE`` when asked for (it fails if the table is there) and set up staging and commit log."""
        self.validate(schema)
        texts = [create_table_sql(self.provider, self.table, schema)] if create else []
        staging, log = quote_name(self.provider, *self.staging), quote_name(self.provider, *self.log)
        helpers = {
            staging: self._staging_sql(schema),
            log: f"CREATE TABLE {log} ({quote_identifier(self.provider, COMMIT)} varchar(64) NOT NULL)",
        }
        connection = self._connect()
        try:
            connection.setAutoCommit(True)
            for text in texts:
                self._run(connection, text)
            for name, text in helpers.items():
                if not self._has(connection, name):
                    self._run(connection, text)
        finally:
            connection.close()

    def _staging_sql(self, schema: T.StructType) -> str:
        text = create_table_sql(self.provider, self.staging, T.StructType([*schema.fields, T.StructField(ROW, T.LongType(), False)]))
        return f"{text[:-1]}, {quote_identifier(self.provider, COMMIT)} varchar(64) NOT NULL)"

    @staticmethod
    def _run(connection, text: str) -> None:
        statement = connection.createStatement()
        try:
            statement.executeUpdate(text)
        finally:
            statement.close()

    @staticmethod
    def _has(connection, name: str) -> bool:
        statement = connection.createStatement()
        try:
            statement.executeQuery(f"SELECT 1 FROM {name} WHERE 1 = 0").close()
            return True
        except Exception:  # the database says the table is not there
            return False
        finally:
            statement.close()

    def exists(self) -> bool:
        connection = self._connect()
        try:
            return self._has(connection, quote_name(self.provider, *self.table))
        finally:
            connection.close()

    def write(self, df: DataFrame, commit: str, info: dict | None = None) -> None:
        """Stage the rows in parallel, then move them in one transaction."""
        if not self.begin(commit):
            return
        rows = storage.new_folder(self.spark, "stage")
        # Row numbers must survive a repeated task, so they are fixed in a written copy first.
        df.withColumn(ROW, F.monotonically_increasing_id()).write.parquet(rows)
        staged = self.spark.read.parquet(rows).withColumn(COMMIT, F.lit(commit))
        options = write_options(
            self.provider, self.url, quote_name(self.provider, *self.staging), self.batch_rows, self.native_bulk
        )
        staged.write.format("jdbc").mode("append").options(**options, **self.properties).save()
        self.move(df.columns, commit)
        storage.delete(self.spark, rows)

    def begin(self, commit: str) -> bool:
        """Clear what an earlier attempt at this commit staged; False when the commit is already logged."""
        column = quote_identifier(self.provider, COMMIT)
        connection = self._connect()
        try:
            connection.setAutoCommit(True)
            self._update(connection, f"DELETE FROM {quote_name(self.provider, *self.staging)} WHERE {column} = ?", commit)
            return not self._update(connection, self._touch_log(), commit)
        finally:
            connection.close()

    def _touch_log(self) -> str:
        """Locks the commit's log row; the update count tells whether there is one."""
        column = quote_identifier(self.provider, COMMIT)
        return f"UPDATE {quote_name(self.provider, *self.log)} SET {column} = {column} WHERE {column} = ?"

    def move(self, columns: list[str], commit: str) -> int:
        """The transaction: record the commit, move its rows, empty its staging; all or nothing."""
        column = quote_identifier(self.provider, COMMIT)
        connection = self._connect()
        try:
            connection.setAutoCommit(False)
            try:
                moved = 0
                if not self._update(connection, self._touch_log(), commit):
                    moved = self._update(connection, move_sql(self.provider, self.table, self.staging, columns), commit)
                    self._update(connection, f"INSERT INTO {quote_name(self.provider, *self.log)} ({column}) VALUES (?)", commit)
                self._update(connection, f"DELETE FROM {quote_name(self.provider, *self.staging)} WHERE {column} = ?", commit)
                connection.commit()
                return moved
            except Exception:
                connection.rollback()
                raise
        finally:
            connection.close()

    @staticmethod
    def _update(connection, text: str, commit: str) -> int:
        statement = connection.prepareStatement(text)
        try:
            statement.setString(1, commit)
            return statement.executeUpdate()
        finally:
            statement.close()

    def complete(self) -> None:
        """Remove the helper tables."""
        connection = self._connect()
        try:
            connection.setAutoCommit(True)
            for name in (self.staging, self.log):
                self._run(connection, f"DROP TABLE {quote_name(self.provider, *name)}")
        finally:
            connection.close()
