"""K8 for streams and reruns: rows reach a relational table once, with a batch ledger.

Executors load a batch into a staging table over parallel connections (Spark's JDBC writer).  One
transaction in the database then moves it: rows whose key the target lacks are inserted, and the
ledger's row of the query is set to the batch's number.  Either both are there or neither; a
replayed batch finds its number and does nothing.  A task that was repeated after its rows had
been committed leaves them in the staging table twice; the move takes each key's first.  No row passes
through the driver, which only sends the statements.

The target's primary key is (Timestamp, UUID): a key stored by anyone is not stored again.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from eventlake.functions.envelope import ENVELOPE_COLUMNS
from eventlake.sinks.writers import DEFAULT_PARALLELISM, DEFAULT_TABLE, jdbc_frame, writer_options

KEY = ("Timestamp", "UUID")
# Column types of the relational table (payloads are text there).
TYPES = {"UUID": "VARCHAR(36) NOT NULL", "Name": "VARCHAR(255) NOT NULL", "Timestamp": "TIMESTAMP NOT NULL",
         "XEventStartOffsetInBytes": "BIGINT", "XEventEndOffsetInBytes": "BIGINT", "XEventSizeInBytes": "BIGINT",
         "Actions": "CLOB", "Fields": "CLOB"}
STAGE_ID = "stage_id"


class JdbcLedgerSink:
    """A relational target with its staging table and ledger (made if absent).  ``types`` overrides the
    columns' SQL types where the database names them otherwise (``{"Actions": "TEXT"}``)."""

    def __init__(self, spark: SparkSession, url: str, table: str = DEFAULT_TABLE, properties: Mapping[str, str] | None = None,
                 types: Mapping[str, str] | None = None, batch_size: int | None = None, parallelism: int = DEFAULT_PARALLELISM):
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", table):
            raise ValueError(f"not a table name: {table!r}")
        self.spark, self.url, self.table = spark, url, table
        self.stage, self.ledger = f"{table}_stage", f"{table}_ledger"
        self.properties, self.types = dict(properties or {}), {**TYPES, **(types or {})}
        self.options = writer_options(batch_size=batch_size, parallelism=parallelism, kind="jdbc")
        self._make()

    # --- statements ------------------------------------------------------------------------------

    @contextmanager
    def _transaction(self):
        """A statement runner; commits at the end, rolls everything back on an error."""
        jvm = self.spark._jvm
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        settings = jvm.java.util.Properties()
        for k, v in self.properties.items():
            if k != "driver":
                settings.setProperty(k, str(v))
        db = jvm.java.sql.DriverManager.getConnection(self.url, settings)
        try:
            db.setAutoCommit(False)
            yield lambda sql, *args: self._run(db, sql, args)
            db.commit()
        except BaseException:
            db.rollback()
            raise
        finally:
            db.close()

    @staticmethod
    def _run(db, sql: str, args: tuple):
        """Rows changed, or the first column of the first row (None: no row)."""
        statement = db.prepareStatement(sql)
        try:
            for i, a in enumerate(args, 1):
                statement.setString(i, a) if isinstance(a, str) else statement.setLong(i, a)
            if not statement.execute():
                return statement.getUpdateCount()
            rows = statement.getResultSet()
            return rows.getObject(1) if rows.next() else None
        finally:
            statement.close()

    def _listed(self, table: str) -> bool:
        with self._transaction() as run:
            try:
                run(f"SELECT 1 FROM {table} WHERE 1 = 0")
                return True
            except Exception as error:  # noqa: BLE001 - the driver's own error type, told apart by its state
                state = getattr(getattr(error, "java_exception", None), "getSQLState", lambda: None)()
                # Fixed values: "table does not exist" in Derby and PostgreSQL
                if state in ("42X05", "42P01", "42Y07"):
                    return False
                raise

    def _make(self) -> None:
        columns = ", ".join(f'"{c}" {self.types[c]}' for c in ENVELOPE_COLUMNS)
        loose = ", ".join(f'"{c}" {self.types[c].replace(" NOT NULL", "")}' for c in ENVELOPE_COLUMNS)
        key = ", ".join(f'"{k}"' for k in KEY)
        for name, ddl in (
                (self.table, [f"CREATE TABLE {self.table} ({columns}, PRIMARY KEY ({key}))"]),
                (self.stage, [f"CREATE TABLE {self.stage} ({loose}, {STAGE_ID} BIGINT GENERATED ALWAYS AS IDENTITY)",
                              f"CREATE INDEX {self.stage}_key ON {self.stage} ({key})"]),
                (self.ledger, [f"CREATE TABLE {self.ledger} (query VARCHAR(64) NOT NULL PRIMARY KEY, batch BIGINT NOT NULL)"])):
            if not self._listed(name):
                with self._transaction() as run:
                    for statement in ddl:
                        run(statement)

    # --- batches ---------------------------------------------------------------------------------

    def last_batch(self, query: str) -> int:
        """The newest batch of ``query`` in the table (-1: none)."""
        with self._transaction() as run:
            found = run(f"SELECT batch FROM {self.ledger} WHERE query = ?", query)
        return -1 if found is None else int(found)

    def store(self, batch: DataFrame, query: str, number: int) -> int:
        """Store batch ``number`` of ``query``; returns the rows inserted (0 for a replay).  One batch at a
        time; batches of a query come in ascending order."""
        if number <= self.last_batch(query):
            return 0
        self.load(batch)
        return self.move(query, number)

    def load(self, batch: DataFrame) -> None:
        """Fill the staging table, whatever an earlier attempt left there."""
        with self._transaction() as run:
            run(f"DELETE FROM {self.stage}")
        (jdbc_frame(batch).repartition(int(self.options["numPartitions"])).write.format("jdbc").mode("append")
            .option("url", self.url).option("dbtable", self.stage).options(**self.options).options(**self.properties).save())

    def move(self, query: str, number: int) -> int:
        """The transaction: rows into the target, the batch into the ledger."""
        columns = ", ".join(f'"{c}"' for c in ENVELOPE_COLUMNS)

        def same(a: str, b: str) -> str:
            return " AND ".join(f'{a}."{k}" = {b}."{k}"' for k in KEY)

        with self._transaction() as run:
            n = run(f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {self.stage} s "
                    f"WHERE NOT EXISTS (SELECT 1 FROM {self.table} t WHERE {same('t', 's')}) "
                    f"AND NOT EXISTS (SELECT 1 FROM {self.stage} u WHERE {same('u', 's')} AND u.{STAGE_ID} < s.{STAGE_ID})")
            if not run(f"UPDATE {self.ledger} SET batch = ? WHERE query = ? AND batch < ?", number, query, number):
                run(f"INSERT INTO {self.ledger} (query, batch) VALUES (?, ?)", query, number)
            run(f"DELETE FROM {self.stage}")
        return int(n)
