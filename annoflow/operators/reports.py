"""Report tables (A22-A27): each report is a DataFrame, not formatted text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoflow.operators.stats import exact_median


# Fixed value: files of the stream are named so; all others come from historic collection.
STREAM_FILE = r"/tweets[^/]*$"


def raw_files(files: DataFrame) -> DataFrame:
    """Raw files and their bytes by kind (streaming, historic), from a listing (source_file, size)."""
    kind = F.when(F.col("source_file").rlike(STREAM_FILE), "streaming").otherwise("historic")
    return files.groupBy(kind.alias("kind")).agg(F.count("*").alias("n_files"), F.sum("size").alias("n_bytes"))


def full_report(overview: DataFrame | None = None, files: DataFrame | None = None, sample: DataFrame | None = None, annotation: DataFrame | None = None,
                outliers: DataFrame | None = None, cleaned: DataFrame | None = None) -> DataFrame:
    """All reports that are given in one table (report, item, value).

    ``overview`` has (stage, n); ``files`` is a listing; ``sample`` and ``cleaned`` are one row of figures; ``annotation`` has (item, value); ``outliers`` one
    row a criterion.
    """
    def row(df: DataFrame, report: str, *names: str) -> DataFrame:
        figures = [c for c in df.columns if c not in names]
        label = F.concat_ws(".", *names, F.col("_f.item")) if names else F.col("_f.item")
        pairs = F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in figures])
        return df.select(*names, F.explode(pairs).alias("_f")).select(F.lit(report).alias("report"), label.alias("item"), F.col("_f.value").alias("value"))

    parts = []
    if overview is not None:
        parts.append(overview.select(F.lit("overview").alias("report"), F.col("stage").alias("item"), F.col("n").cast("double").alias("value")))
    if files is not None:
        parts.append(row(raw_files(files), "raw_files", "kind"))
    if sample is not None:
        parts.append(row(sample, "sample"))
    if annotation is not None:
        parts.append(annotation.select(F.lit("annotation").alias("report"), F.col("item").cast("string"), F.col("value").cast("double")))
    if outliers is not None:
        parts.append(row(outliers, "outliers", "criterion"))
    if cleaned is not None:
        parts.append(row(cleaned, "cleaned"))
    if not parts:
        raise ValueError("no report to make")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stage_overview(raw_lines: DataFrame | None = None, parsed: DataFrame | None = None,
                   sampled: DataFrame | None = None, annotations: DataFrame | None = None,
                   cleaned: DataFrame | None = None) -> DataFrame:
    """Rows at every data stage; annotations per mode. Columns: stage, n."""
    parts = []
    for name, df in (("raw_lines", raw_lines), ("parsed", parsed), ("sampled", sampled),
                     ("cleaned_labels", cleaned)):
        if df is not None:
            parts.append(df.agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), "n"))
    if annotations is not None:
        parts.append(annotations.groupBy("mode").agg(F.count("*").alias("n"))
                     .select(F.concat(F.lit("annotations_"), F.col("mode")).alias("stage"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def outlier_summary(outliers: DataFrame) -> DataFrame:
    """Per criterion (agreement, time) the number and share of outliers,
    non-outliers and not-considered annotators, and mean/median/min/max value.

    The annotators are stored once, as the exact medians read them several times."""
    outliers = outliers.checkpoint(eager=True)
    rows = []
    total = F.count("*")
    for by in ("agreement", "time"):
        tag, val = F.col(f"{by}_outlier"), F.col(f"{by}_values")
        rows.append(outliers.agg(
            F.lit(by).alias("criterion"),
            total.alias("n_annotators"),
            F.count_if(tag == "outlier").alias("n_outlier"),
            F.count_if(tag == "no_outlier").alias("n_no_outlier"),
            F.count_if(tag.isNull()).alias("n_not_considered"),
            F.round(100.0 * F.count_if(tag == "outlier") / total, 9).alias("pct_outlier"),
            F.round(F.avg(val), 9).alias("mean_value"),
            F.round(F.lit(exact_median(outliers, val)).cast("double"), 9).alias("median_value"),
            F.round(F.min(val), 9).alias("min_value"),
            F.round(F.max(val), 9).alias("max_value")))
    return rows[0].unionByName(rows[1])


def outliers_in_both(outliers: DataFrame) -> DataFrame:
    """Annotators flagged by both criteria."""
    return outliers.where((F.col("time_outlier") == "outlier") & (F.col("agreement_outlier") == "outlier")) \
        .select("annotator_id")


def outlier_list(outliers: DataFrame) -> DataFrame:
    """The outliers of each criterion with their value and z-score, sorted by value."""
    rows = [outliers.where(F.col(f"{by}_outlier") == "outlier").select(
        F.lit(by).alias("criterion"), "annotator_id", F.col(f"{by}_values").alias("value"), F.col(f"{by}_zscores").alias("zscore"))
        for by in ("agreement", "time")]
    return rows[0].unionByName(rows[1]).orderBy("criterion", "value", "annotator_id")
