"""JDBC sink for the marts.

``overwrite`` drops and recreates the target table on every run, so the table
always reflects the latest full recompute.  The URL and driver class are
parameters (PostgreSQL in production).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "overwrite",
    num_partitions: int | None = None,
) -> None:
    """Write ``df`` to ``table``.  ``num_partitions`` caps concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.jdbc(url=url, table=table, mode=mode, properties=properties or {})


class JdbcMarts:
    """The marts of one run, shown together: each is written beside its table, and ``show`` swaps all in one transaction.

    A run that dies before ``show`` leaves the old tables as they were; its own ones are written over by the next.
    Needs a database whose DDL is transactional, as PostgreSQL's and Derby's is.
    """

    BESIDE = "_next"

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str] | None = None, num_partitions: int | None = None):
        self.spark, self.url, self.properties, self.num_partitions = spark, url, properties or {}, num_partitions
        self.tables: list[str] = []

    def write(self, name: str, mart: DataFrame) -> None:
        write_jdbc(mart, self.url, f"{name}{self.BESIDE}", self.properties, num_partitions=self.num_partitions)
        self.tables.append(name)

    def show(self) -> None:
        jvm = self.spark._jvm
        if "driver" in self.properties:
            jvm.org.apache.spark.util.Utils.classForName(self.properties["driver"], True, False)
        settings = jvm.java.util.Properties()
        for key, value in self.properties.items():
            settings.setProperty(key, value)
        rename = "RENAME TABLE {} TO {}" if self.url.startswith("jdbc:derby") else "ALTER TABLE {} RENAME TO {}"
        link = jvm.java.sql.DriverManager.getConnection(self.url, settings)
        try:
            link.setAutoCommit(False)
            known = self._known(link)
            run = link.createStatement()
            for name in self.tables:
                if name.lower() in known:
                    run.executeUpdate(f"DROP TABLE {name}")
                run.executeUpdate(rename.format(f"{name}{self.BESIDE}", name))
            link.commit()
        except BaseException:
            link.rollback()
            raise
        finally:
            link.close()

    @staticmethod
    def _known(link) -> set[str]:
        """The tables of the connection's schema, in lower case."""
        found, names = link.getMetaData().getTables(link.getCatalog(), link.getSchema(), None, None), set()
        while found.next():
            names.add(found.getString("TABLE_NAME").lower())
        found.close()
        return names


def write_marts(
    marts: dict[str, DataFrame],
    url: str,
    properties: dict[str, str] | None = None,
    num_partitions: int | None = None,
) -> None:
    """Replace all mart tables at once; ``num_partitions`` caps the connections that write at once."""
    store = JdbcMarts(next(iter(marts.values())).sparkSession, url, properties, num_partitions)
    for name, mart in marts.items():
        store.write(name, mart)
    store.show()
