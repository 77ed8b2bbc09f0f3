"""Model predictions and membership flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: prediction file names carry the model name before a date and a 5-character hash.
PREDICTION_FILE = r"predicted_(.+)_(\d{4}-\d{2}-\d{2})_.{5}\.csv$"
PRED_FIELDS = ("label", "probability", "labels", "probabilities")


def model_name(file_name: F.Column) -> F.Column:
    """Model name from the file name, else the name minus prefix and extension."""
    base = F.regexp_extract(file_name, r"([^/]+)$", 1)
    m = F.regexp_extract(base, PREDICTION_FILE, 1)
    plain = F.regexp_replace(F.regexp_replace(base, r"^predicted_", ""), r"\.csv$", "")
    return F.when(m != "", m).otherwise(plain)


def read_predictions(spark: SparkSession, paths) -> DataFrame:
    """Long form: id, model, label, probability, labels, probabilities (files carry ``id``),
    run_date (from the file name, if there) and file.  A "file" may also be a folder that Spark wrote."""
    schema = "id string, label string, probability double, labels string, probabilities string"
    df = spark.read.schema(schema).option("header", True).csv(paths)
    file = F.regexp_extract(F.regexp_replace(F.col("_metadata.file_path"), r"\.csv/part-[^/]+$", ".csv"), r"([^/]+)$", 1)
    day = F.to_date(F.nullif(F.regexp_extract(file, PREDICTION_FILE, 2), F.lit("")))
    return df.withColumns({"model": model_name(file), "run_date": day, "file": file})


def wide_predictions(long: DataFrame, models: list[str] | None = None) -> DataFrame:
    """One row per id with ``label_<model>``, ``probability_<model>``, ...

    ``models`` fixes the pivot values (otherwise they are taken from the data,
    a small distinct list).  If a model has several files the newest ``run_date`` counts,
    then the last file name."""
    if models is None:
        models = sorted(r[0] for r in long.select("model").distinct().collect())
    dated = [c for c in ("run_date", "file") if c in long.columns]

    def newest(m, f):
        given = (F.col("model") == m) & F.col(f).isNotNull()
        return F.max_by(F.col(f), F.when(given, F.struct(*dated, f)))

    aggs = [newest(m, f).alias(f"{f}_{m}") for m in models for f in PRED_FIELDS if f in long.columns]
    return long.groupBy("id").agg(*aggs)


def attach_predictions(parsed: DataFrame, wide: DataFrame, flag: str | None = None,
                       drop_retweets: bool = False) -> DataFrame:
    """S12 with raw data: join on id (never by row position), optional flag filter (F13), F7."""
    df = parsed.join(wide, "id", "left")
    if flag is not None:
        df = df.where(F.col(flag))
    if drop_retweets:
        df = df.where(~F.col("is_retweet"))
    return df


def membership_flags(parsed: DataFrame, uploaded: DataFrame | None = None, labelled: DataFrame | None = None,
                     cleaned: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    """Flags S (uploaded for annotation), L (annotated), A (cleaned label)."""
    out = parsed
    for flag, ids, col in (("S", uploaded, "tweet_id"), ("L", labelled, "tweet_id"), ("A", cleaned, "id")):
        if ids is None:
            continue
        marks = ids.select(F.col(col).alias(id_col)).distinct().withColumn(flag, F.lit(True))
        out = out.join(marks, id_col, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return out


def all_data(parsed: DataFrame, wide: DataFrame | None = None, s_date=None, e_date=None,
             uploaded: DataFrame | None = None, labelled: DataFrame | None = None,
             cleaned: DataFrame | None = None, geo: DataFrame | None = None,
             # Fixed value: the columns of the all-data view.
             usecols=("id", "token_count", "is_retweet", "contains_keywords", "created_at", "lang")) -> DataFrame:
    """Parsed statuses with predictions, an inclusive created_at window
    (both ends, as coded in the reference), membership flags and optional
    inferred-geo columns, all attached by ``id``."""
    df = parsed.select(*usecols) if usecols else parsed
    if wide is not None:
        df = df.join(wide, "id", "left")
    if s_date:
        df = df.where(F.col("created_at") >= F.lit(s_date).cast("timestamp"))
    if e_date:
        df = df.where(F.col("created_at") <= F.lit(e_date).cast("timestamp"))
    df = membership_flags(df, uploaded, labelled, cleaned)
    if geo is not None:
        df = df.join(geo, "id", "left")
    return df
