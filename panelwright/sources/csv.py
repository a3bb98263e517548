"""CSV panels: discovery, typed scan, NA tokens, load profile, sinks.

The scan never infers a schema: dirty numeric columns are declared as text
and repaired by expressions. pandas writes quotes doubled, so ``escape='"'``.
Discovery keeps every matching file with its path (``source_file``), so
several samples of one schema run through the same plan (P5); picking the
first match is ``first_only=True`` (lexicographically smallest path, since a
file system listing has no order).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NA_TOKENS


class PanelLoadError(FileNotFoundError):
    """A4: the panel files are missing or unreadable (one typed error, never None)."""


def read_panel_csv(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                   recursive: bool = True, na_tokens: list[str] | None = NA_TOKENS,
                   with_source: bool = True, first_only: bool = False, corrupt: str | None = None) -> DataFrame:
    """A1-A4: header CSV with a declared schema; NA tokens -> NULL on text
    columns; ``source_file`` column from the scan's file metadata. With
    ``corrupt`` a column of that name holds the line of every row with a cell
    that does not parse (its typed value is NULL either way)."""
    declared = schema
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    reader = (spark.read.schema(schema).option("header", True).option("escape", '"')
              .option("enforceSchema", corrupt is not None).option("mode", "PERMISSIVE"))
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        df = reader.csv(path)
        if with_source:
            df = df.withColumn("source_file", F.col("_metadata.file_path"))
        # resolve the file listing now so a missing path fails here, typed
        df.schema  # noqa: B018
    except AnalysisException as e:
        raise PanelLoadError(f"cannot read panel at {path}: {e}") from e
    if first_only:
        files = sorted(df.inputFiles())  # from the listing, no rows are read
        if not files:
            raise PanelLoadError(f"no panel file at {path}")
        return read_panel_csv(spark, files[0], declared, None, False, na_tokens, with_source, corrupt=corrupt)
    if na_tokens:
        text_cols = [f.name for f in declared.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: F.when(F.col(c).isin(*na_tokens), F.lit(None)).otherwise(F.col(c))
                             for c in text_cols})
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Cleaned-table sink (parquet by default; ``fmt='csv'`` writes a
    header). Writes are task-atomic through Spark's output committer, so a
    lost executor's partial files never become visible."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def write_predictions(scored: DataFrame, path: str, id_col: str = "ID", label_col: str = "predicted_label",
                      out_label: str = "Credit_Score") -> None:
    """``(ID, Credit_Score)`` CSV; the id travels with each scored row."""
    write_table(scored.select(id_col, F.col(label_col).alias(out_label)), path, "csv")
