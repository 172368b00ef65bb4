"""S2 incremental table source, S3 JSON-lines scan, C3 table-or-empty,
C2 object-store settings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kpiflow.schemas import ENVELOPE



def envelope_schema() -> StructType:
    from pyspark.sql.types import StringType, StructField

    return StructType(list(ENVELOPE.fields) + [StructField("source_name", StringType())])


def read_table_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """A table directory read incrementally as a stream (parquet here,
    ``delta`` where the Delta jars exist)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def envelope_stream(spark: SparkSession, path: str, source_name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One topic of an envelope landing table (partitioned by ``source_name``)
    as a stream with the Kafka record columns."""
    df = read_table_stream(spark, path, envelope_schema(), "parquet", max_files_per_trigger)
    return df.filter(F.col("source_name") == source_name).select("key", "value", "timestamp", "partition", "offset")


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """S3: JSON-lines files as an envelope (blank lines skipped). Position
    within the file stands in for the offset; the file path for the key."""
    lines = spark.read.text(path).filter(F.trim(F.col("value")) != "")
    return lines.select(
        F.col("_metadata.file_path").alias("key"),
        F.col("value"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
    )


def table_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A missing table reads as an empty frame with the expected schema."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def object_store_conf(endpoint: str, access_key: str, secret_key: str, ssl: bool = False) -> dict[str, str]:
    """s3a settings to pass at session build (``spark.hadoop.*``).

    Credentials are always explicit arguments; there are no defaults.
    """
    if not access_key or not secret_key:
        raise ValueError("object store credentials must be given explicitly")
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "true" if ssl else "false",
        "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    }
