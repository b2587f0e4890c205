"""Append to a table behind a JDBC driver (which has to be on the classpath)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from clickweir.sinks.tables import table_rows
from clickweir.sources.catalog import schema_of
from clickweir.sources.kafka import from_environment


@dataclass(frozen=True)
class JdbcTarget:
    """``url`` may use ``{host}``, ``{port}`` and ``{database}``; user and password
    may be ``$NAME``."""

    url: str
    table: str
    host: str = ""
    port: int | None = None
    database: str = ""
    user: str = ""
    password: str = ""
    driver: str = ""
    batch_size: int = 500_000
    writers: int = 1

    def options(self, environ: Mapping[str, str] | None = None) -> dict[str, str]:
        options = {
            "url": self.url.format(
                host=self.host, port=self.port or "", database=self.database
            ),
            "dbtable": self.table,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.writers),
        }
        for name in ("user", "password"):
            text = getattr(self, name)
            if text:
                options[name] = from_environment(text, environ)
        if self.driver:
            options["driver"] = self.driver
        return options


def append_to_jdbc(
    messages: DataFrame,
    target: JdbcTarget,
    types: dict[str, str],
    nulls: str = "default",
) -> None:
    """Append messages; ``types`` from ``sources.catalog.columns_from_table``.

    ``writers`` bounds the connections. Rows are dealt out to them after parsing, which
    keeps its own parallelism.
    """
    rows = table_rows(messages, schema_of(types), nulls, types).repartition(target.writers)
    rows.write.format("jdbc").options(**target.options()).mode("append").save()
