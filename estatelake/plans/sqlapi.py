"""SQL surface over the marts: dashboard panels, ad-hoc SQL, documented examples.

The marts are registered as temp views under the names the dashboard uses, and
every statement runs through Spark SQL (parser → Catalyst → AQE).  Joins,
windows, CTEs and set operations come from Spark SQL itself.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Fixed value: what the assistant answers when the marts cannot answer a question.
NO_ANSWER_SQL = "SELECT 'Cannot answer from available data' AS message"

# The three dashboard panel queries (NULL order stated explicitly,
# ties broken by the key so that LIMIT is deterministic).
DASH_TOP_DISTRICTS = """
    SELECT district, avg_price, avg_price_per_sqm, listing_count
    FROM   mart_avg_price_by_district
    ORDER  BY avg_price DESC NULLS LAST, district ASC NULLS LAST
    LIMIT  15"""

DASH_DAILY = """
    SELECT listing_date, listings_count, avg_price
    FROM   mart_listings_by_day
    ORDER  BY listing_date ASC NULLS LAST"""

DASH_ROOMS = """
    SELECT rooms, avg_price, avg_price_per_sqm, listing_count
    FROM   mart_avg_price_by_rooms
    ORDER  BY rooms ASC NULLS LAST"""

# The documented example questions, as SQL over the marts / silver.
TOP5_PRICE_PER_SQM = """
    SELECT district, avg_price_per_sqm
    FROM   mart_avg_price_by_district
    ORDER  BY avg_price_per_sqm DESC NULLS LAST, district ASC NULLS LAST
    LIMIT  5"""

DAY_COUNT = """
    SELECT listing_date, listings_count
    FROM   mart_listings_by_day
    WHERE  listing_date = :d"""

DAY_COUNT_LATEST = """
    SELECT listing_date, listings_count
    FROM   mart_listings_by_day
    WHERE  listing_date = (SELECT date_sub(max(listing_date), 1) FROM mart_listings_by_day)"""

# Exact like ``functions.exact.exact_avg``: decimals where they fit, doubles beside them.
TWO_ROOM_BY_DISTRICT = """
    SELECT district,
           round(try_divide(coalesce(CAST(sum(try_cast(price AS DECIMAL(28,6))) AS DOUBLE), 0D)
                              + coalesce(sum(CASE WHEN try_cast(price AS DECIMAL(28,6)) IS NULL THEN price END), 0D),
                            CAST(count(price) AS DOUBLE)), 2) AS avg_price,
           count(*) AS listing_count
    FROM   silver_listings
    WHERE  rooms = 2
    GROUP  BY district"""

# A join without equal keys may multiply so many bytes by bytes at most: marts with marts, but not silver with silver.
PRODUCT_BYTES = 10**13

# Leaves of an analysed plan that read no table.
_TABLELESS = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef"}


def register(tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames as session temp views under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


# What a statement is made of, as far as its end is concerned: literals and names in quotes, comments, the rest.
_PIECES = re.compile(r"""'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|`[^`]*`|(--[^\n]*|/\*.*?\*/|;|\s+)|.""", re.DOTALL)


def _clean(sql: str) -> str:
    """The statement without the blanks, comments and semicolons at its end."""
    end = 0
    for piece in _PIECES.finditer(sql):
        if piece.group(1) is None:
            end = piece.end()
    return sql[:end].strip()


def _objection(df: DataFrame) -> str | None:
    """Why an analysed statement may not run: a call into the JVM, or anything read but session views."""
    items = lambda seq: [seq.apply(i) for i in range(seq.size())]
    todo = [df._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "View" and node.isTempView():
            continue
        if hasattr_jvm(node, "expressions"):
            below = items(node.children())
            if not below and kind not in _TABLELESS:
                return f"only the registered views can be read, not {node.simpleString(100)}"
            todo += below + items(node.expressions())
        else:
            if "Reflect" in kind:
                return f"{node.prettyName()} is not allowed"
            todo += items(node.children())
            if hasattr_jvm(node, "plan"):  # a subquery
                todo.append(node.plan())
    return None


def _size(plan) -> int:
    return int(str(plan.stats().sizeInBytes()))


def _unbounded_product(spark: SparkSession, df: DataFrame, limit: int = PRODUCT_BYTES) -> str | None:
    """Why an optimised plan may not run: a join without an equality whose sides are both large."""
    equal_keys = spark._jvm.org.apache.spark.sql.catalyst.planning.ExtractEquiJoinKeys
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "Join" and equal_keys.unapply(node).isEmpty():
            if _size(node.left()) * _size(node.right()) > limit:
                return "a join of two large tables needs an equality between their columns"
        for seq in (node.children(), node.subqueries()):
            todo += [seq.apply(i) for i in range(seq.size())]
    return None


def hasattr_jvm(node, name: str) -> bool:
    """Whether a JVM object has a public method without arguments of that name."""
    return any(m.getName() == name and m.getParameterCount() == 0 for m in node.getClass().getMethods())


def run_sql(
    spark: SparkSession, sql: str, args: dict | None = None
) -> tuple[DataFrame | None, str | None]:
    """Plan one read-only statement: ``(frame, None)`` or ``(None, error text)``.

    The text is wrapped as ``SELECT * FROM (<sql>)``, so the parser itself
    rejects DDL, DML (also after ``WITH``), ``SET`` and a second statement;
    ``WITH … ORDER BY`` queries still run.  On the analysed plan, calls of JVM methods
    (``reflect``, ``java_method``) and reads of anything but the session's temp views (catalog
    tables, files by path) are refused.  Analysis errors (unknown table or
    column) come back as text instead of failing the caller; the frame is lazy, so
    what fails while running fails in its action (``execute_sql`` returns that as text too).
    """
    text = _clean(sql)
    try:
        df = spark.sql(f"SELECT * FROM (\n{text}\n)", args=args)
        refused = _objection(df)
        return (None, refused) if refused else (df, None)
    except PySparkException as exc:  # ParseException, AnalysisException, ...
        return None, str(exc)


def preview(
    spark: SparkSession, sql: str, n: int = 20, args: dict | None = None
) -> tuple[DataFrame | None, str | None]:
    """First ``n`` rows of a statement plus its total row count (``total_rows``).

    The count is a scalar subquery over the same statement, planned by Spark as
    its own aggregate job; nothing is collected to the driver here.
    """
    text = _clean(sql)
    frame, err = run_sql(spark, text, args)
    if err:
        return None, err
    try:
        df = spark.sql(
            f"SELECT *, (SELECT count(*) FROM (\n{text}\n)) AS total_rows FROM (\n{text}\n) LIMIT {int(n)}",
            args=args,
        )
        return df, None
    except PySparkException as exc:
        return None, str(exc)


@dataclass
class SqlResult:
    """What a statement gave: its columns as named (names may repeat), its first rows, how many there are, or the error text."""

    columns: list[str] = field(default_factory=list)
    rows: list[tuple] = field(default_factory=list)
    total: int = 0
    error: str | None = None


class Deadline:
    """Cancels the Spark jobs that this thread starts within the context once ``seconds`` have passed."""

    def __init__(self, spark: SparkSession, seconds: float | None):
        self._context, self.seconds, self.passed = spark.sparkContext, seconds, False
        self._tag, self._over = f"deadline-{uuid.uuid4().hex}", threading.Event()

    def _watch(self) -> None:
        if self._over.wait(self.seconds):
            return
        self.passed = True
        while not self._over.wait(0.2):  # again: a query that is cancelled between two jobs starts the next
            self._context.cancelJobsWithTag(self._tag)

    def __enter__(self) -> Deadline:
        if self.seconds is not None:
            self._context.addJobTag(self._tag)
            threading.Thread(target=self._watch, daemon=True).start()
        return self

    def __exit__(self, *_exc) -> None:
        self._over.set()
        if self.seconds is not None:
            self._context.removeJobTag(self._tag)


def execute_sql(
    spark: SparkSession, sql: str, n: int = 20, args: dict | None = None, seconds: float | None = 60.0
) -> SqlResult:
    """Run one read-only statement once: its first ``n`` rows, and its row count observed on the way.

    The rows are numbered in the order of the statement and the first ones taken as each task's
    smallest numbers, so all of its rows are passed by the counter and none but ``n`` per task are kept.
    Whatever fails, in parsing, analysis or at run time, comes back as text with no rows; so does a
    statement that takes more than ``seconds`` or joins two large tables without an equality.
    """
    frame, err = run_sql(spark, sql, args)
    if err:
        return SqlResult(error=err)
    seen, names = Observation(), frame.columns
    # Columns by place: names may clash with each other and with the number.
    placed = frame.toDF(*[f"c{i}" for i in range(len(names))]).observe(seen, F.count(F.lit(1)).alias("rows"))
    first = placed.withColumn("at", F.monotonically_increasing_id()).orderBy("at").limit(n).drop("at")
    try:
        refused = _unbounded_product(spark, first)
        if refused:
            return SqlResult(error=refused)
        with Deadline(spark, seconds) as deadline:
            rows = [tuple(r) for r in first.collect()]  # ``n`` rows at most
    except (PySparkException, Py4JJavaError) as exc:
        late = "deadline" in locals() and deadline.passed
        return SqlResult(error=f"stopped after {seconds:g} s" if late else str(exc))
    counted = seen._jo.getRow()  # none if Spark finds while it runs that there is nothing to read
    return SqlResult(names, rows, int(counted.getLong(0)) if counted.length() else 0)


def day_count(spark: SparkSession, day: dt.date | None = None) -> DataFrame:
    """Listings on ``day`` (default: the day before the latest listing date)."""
    if day is None:
        return spark.sql(DAY_COUNT_LATEST)
    return spark.sql(DAY_COUNT, args={"d": day})
