"""The append-only metric log: one JSON object per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The numbers that JSON lines may hold though JSON has no name for them.
NOT_FINITE = ("NaN", "Infinity", "-Infinity")
_BARE = r"(?<=[:\[,\s])(-?Infinity|NaN)(?=\s*[,}\]])"
_MARK = "number:"


def append_metrics_log(records: DataFrame, path: str) -> None:
    """Append the records as JSON lines; absent metrics are left out, NaN is written bare."""
    line = F.to_json(F.struct(*[F.col(c) for c in records.columns]))
    quoted = r'":"(NaN|Infinity|-Infinity)"'
    records.select(F.regexp_replace(line, quoted, '":$1').alias("value")).write.mode("append").text(path)


def load_metrics_log(
    spark: SparkSession, path: str, ids: Sequence[str] = ("run_id", "record_seq")
) -> DataFrame:
    """The log as (ids, global_step, name, value). A missing log is an empty one."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return parse_metric_lines(lines, ids)


def parse_metric_lines(
    lines: DataFrame, ids: Sequence[str] = ("run_id", "record_seq")
) -> DataFrame:
    """Read tolerant: blank lines, broken JSON and lines whose step is no integer are skipped.

    Of the others every field that is a number counts, whatever its name; booleans, strings and
    nulls do not. A boolean step counts as malformed.
    """
    spark = lines.sparkSession
    text = F.col("value")
    marked = F.regexp_replace(text, _BARE, f'"{_MARK}$1"')
    parsed = F.coalesce(F.try_parse_json(text), F.try_parse_json(marked))

    def whole(name: str) -> Column:
        found = F.try_variant_get("__record", f"$.{name}", "variant")
        kind = F.schema_of_variant(found)
        return F.when(kind == "BIGINT", F.try_variant_get("__record", f"$.{name}", "bigint"))

    records = (
        lines.filter(F.length(F.trim(text)) > 0)
        .select(parsed.alias("__record"))
        .filter(F.schema_of_variant("__record").startswith("OBJECT"))
        .select("__record", *[whole(name).alias(name) for name in (*ids, "global_step")])
        .filter(F.col("global_step").isNotNull())
    )
    fields = records.lateralJoin(spark.tvf.variant_explode(F.col("__record").outer()))
    kind = F.schema_of_variant("value")
    word = F.try_variant_get("value", "$", "string")
    number = F.when(
        (kind == "BIGINT") | (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL"),
        F.try_variant_get("value", "$", "double"),
    ).when(
        (kind == "STRING") & word.isin([_MARK + name for name in NOT_FINITE]),
        F.substring(word, len(_MARK) + 1, 9).cast("double"),
    )
    return (
        fields.filter(~F.col("key").isin([*ids, "global_step"]))
        .select(*ids, "global_step", F.col("key").alias("name"), number.alias("value"))
        .filter(F.col("value").isNotNull())
    )
