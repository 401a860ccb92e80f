"""Registry of queries: each pairs a Spark plan with the SQL that defines its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_document(df: DataFrame) -> DataFrame:
    """Documents dealt to tasks by ``doc_id``. What is exploded from them afterwards stays there, so groups and
    windows within a document shuffle each text once instead of a row for every word. Sixteen parts for each part
    that is read: words take far more memory than the text they come from."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 16 * df.rdd.getNumPartitions())
    return df.repartition(parts, "doc_id")


def by_row(df: DataFrame) -> DataFrame:
    """Rows dealt evenly to tasks, for rows that are small to read and dear to work on: a file of a few megabytes
    is read by one task, which would do all of that work."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 16 * df.rdd.getNumPartitions())
    return df.repartition(parts)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pick(key, values):
    """Spark side of a template choice: row ``key`` takes template ``key % n``."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.col(key) % len(values)).cast("int") + 1)


def pick_sql(key: str, values) -> str:
    return f"[{', '.join(sql_text(v) for v in values)}][1 + {key} % {len(values)}]"


def scalar_cases(name: str, fn, cases, key: str = "p_partkey", source: str = "part",
                 placeholder: str = "p_name"):
    """Register a scalar over every row of ``source``.

    Each row builds its text from a template (``{n}`` stands for a column of the row);
    the SQL side states the expected outcome of that template.
    """
    inputs, expected = [c[0] for c in cases], [c[1] for c in cases]

    def run(spark, sf_dir):
        df = table(spark, sf_dir, source)
        text = F.replace(pick(key, inputs), F.lit("{n}"), F.expr(placeholder))
        return (df.select(key, text.alias("raw")).select(
            F.col(key).alias("row_key"), fn(F.col("raw")).cast("string").alias("outcome")))

    sql = (f"SELECT {key} AS row_key, replace({pick_sql(key, expected)}, '{{n}}', {placeholder}) AS outcome "
           f"FROM {source}")
    REGISTRY[name] = (run, sql)
