"""Where transactions, scored rows and models come from."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from txscore.constants import ORDINAL, TOPIC
from txscore.schema import TRANSACTION, TRANSACTION_FILE

CORRUPT = "_corrupt_record"


def read_kafka(
    spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "earliest", **options: str
) -> DataFrame:
    """The message stream of a topic. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )


def _parsed(messages: DataFrame, parsed: Column) -> DataFrame:
    # As a generator the parse stays below any filter on its fields. In a projection the
    # optimizer would repeat it in the filter, once per field.
    return messages.select(F.inline(F.array(parsed)))


def decode_messages(messages: DataFrame, schema: StructType = TRANSACTION) -> DataFrame:
    """JSON text in `value` to flat columns. Bad text gives a row of nulls."""
    text = F.col("value").cast("string")
    # Text without a brace holds no object. The parser would find that out by an exception, which
    # costs more than a message that parses.
    return _parsed(messages, F.when(text.contains("{"), F.from_json(text, schema)))


def bad_messages(messages: DataFrame, schema: StructType = TRANSACTION) -> DataFrame:
    """The messages that do not parse, as text: what decoding turns into nulls."""
    extended = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    parsed = F.from_json(F.col("value").cast("string"), extended, {"columnNameOfCorruptRecord": CORRUPT})
    return _parsed(messages, parsed).select(
        F.col(CORRUPT).alias("message")).filter(F.col("message").isNotNull())


def read_transactions_csv(spark: SparkSession, path: str, ordinal: bool = True) -> DataFrame:
    """Transactions from CSV with a header; the leading row ordinal is dropped.

    Spark matches a given schema by position, so a file with one column more or less
    would shift into nulls. The first header is compared here, and that of every file when
    it is read: a file that differs ends the query with an error.
    """
    rows = _checked_csv(spark, path, TRANSACTION_FILE if ordinal else TRANSACTION)
    return rows.drop(ORDINAL)


def read_transactions_csv_with_ordinal(spark: SparkSession, path: str) -> DataFrame:
    """As above, keeping the ordinal: it says which copy of a row came first."""
    return _checked_csv(spark, path, TRANSACTION_FILE)


def _checked_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    header = spark.read.csv(path, header=True).columns
    if len(header) != len(schema) or header[-len(TRANSACTION):] != TRANSACTION.names:
        raise ValueError(f"{path}: the header does not match the schema: {header}")
    # The ordinal column often has an empty name, which Spark shows as _c0.
    names = ["" if name == "_c0" else name for name in header]
    as_filed = StructType([StructField(name, field.dataType) for name, field in zip(names, schema)])
    return spark.read.csv(path, header=True, schema=as_filed, enforceSchema=False).toDF(*schema.names)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def read_scored(
    spark: SparkSession, path: str, table: str | None = None, **options: str
) -> DataFrame:
    """Scored rows from a Parquet folder, or from a database for a JDBC url."""
    if path.startswith("jdbc:"):
        return spark.read.format("jdbc").options(url=path, dbtable=table, **options).load()
    return spark.read.parquet(path)


#: What a batch is known by in the manifest, and which of its attempts counts.
COMMIT = "run_id STRING, batch_id BIGINT, attempt BIGINT"


def commits_of(path: str) -> str:
    """Where the manifest of a folder of batches is; readers of the folder itself pass over it."""
    return f"{path}/_commits"


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a folder with a manifest: of each batch the last attempt that was committed.

    The manifest's files are listed before the rows' files, so every attempt in it is found. There
    is nothing to read before the first commit: that raises as for a folder that is not there.
    """
    commits = spark.read.schema(COMMIT).parquet(commits_of(path))
    latest = commits.groupBy("run_id", "batch_id").agg(F.max("attempt").alias("attempt"))
    rows = spark.read.parquet(path)
    named = rows.withColumns({"run_id": F.col("run_id").cast("string"), "batch_id": F.col("batch_id").cast("long"),
                              "attempt": F.col("attempt").cast("long")})
    return named.join(latest, ["run_id", "batch_id", "attempt"], "left_semi").select(
        [c for c in rows.columns if c != "attempt"])


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def tag_split(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("split", F.lit(name))
