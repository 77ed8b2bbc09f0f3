"""Cleaned-label access and dataset splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoflow.functions.hashing import sample_key
from annoflow.operators.topk import label_by_position, top_k_by_key


def has_label_filter(labels: DataFrame, has_label: str) -> DataFrame:
    """',' separates AND terms, '|' OR alternatives; a term keeps every row
    of the statuses that carry one of its label tags (exact match)."""
    out = labels
    for term in has_label.split(","):
        tags = term.split("|")
        ids = out.where(F.col("label_tag").isin(*tags)).select("id").distinct()
        out = out.join(ids, "id", "left_semi")
    return out


def cleaned_for_question(labels: DataFrame, question=None, has_label: str = "",
                         return_label_ids: bool = False) -> DataFrame:
    """Rows of one question (tag or id), with ``label`` = tag (or id).  Raises for a question that has no labels."""
    if has_label:
        labels = has_label_filter(labels, has_label)
    label = F.col("label_id") if return_label_ids else F.col("label_tag")
    if question is None or question == "":
        return labels.select("id", "text", "question_tag", label.alias("label"))
    # A survey has few questions: their tags and ids fit into a list.
    asked = labels.select("question_tag", "question_id").distinct().collect()
    known = sorted({r.question_tag if isinstance(question, str) else r.question_id for r in asked} - {None})
    if question not in known:
        raise ValueError(f"no cleaned labels for the question {question!r}; there are {known}")
    ids = [r.question_id for r in asked if question in (r.question_tag, r.question_id)]
    sel = labels.where(F.col("question_id").isin(*ids))
    return sel.select("id", "text", "question_tag", label.alias("label"))


def class_counts(df: DataFrame, by=("question_tag",), label: str = "label") -> DataFrame:
    """Rows per class and the size of the smallest class."""
    c = df.groupBy(*by, label).agg(F.count("*").alias("n"))
    m = c.groupBy(*by).agg(F.min("n").alias("min_class"))
    return c.join(m, list(by))


def balance_classes(df: DataFrame, seed: int, by=("question_tag",), label: str = "label",
                    id_col: str = "id") -> DataFrame:
    """Undersample every class to the smallest class of its question."""
    m = class_counts(df, by, label).select(*by, "min_class").distinct()
    keyed = df.join(m, list(by)).withColumn("_key", sample_key(id_col, seed))
    return top_k_by_key(keyed, [*by, label], "_key", "min_class", id_col).drop("_key", "min_class")


def split_fractions(dev_size: float, test_size: float):
    """Cut fractions in the reference's double arithmetic: (1-dev-test), (1-test)."""
    return (1 - dev_size - test_size), (1 - test_size)


def train_dev_test_split(df: DataFrame, seed: int = 42, dev_size: float = 0.2, test_size: float = 0.2,
                         by=("question_tag",), id_col: str = "id", label_tags=(), balanced: bool = False,
                         label: str = "label") -> DataFrame:
    """Shuffle each question by a seeded key and cut at int(f1*n), int(f2*n).

    Balancing (T7) happens before the label filter (F11), as in the reference.
    Rows are compared with the keys at the cuts; no row is numbered.
    """
    if balanced:
        df = balance_classes(df, seed, by, label, id_col)
    if label_tags:
        df = df.where(F.col(label).isin(*label_tags))
    f1, f2 = split_fractions(dev_size, test_size)
    keyed = df.withColumn("_key", sample_key(id_col, seed))
    cuts = [lambda n: F.lit(f1) * n, lambda n: F.lit(f2) * n]
    return label_by_position(keyed, by, "_key", id_col, cuts, ("train", "dev", "test"), "split").drop("_key")


def pretrain_split(df: DataFrame, seed: int, id_col: str = "id", dev_cap: int = 200_000) -> DataFrame:
    """Shuffle; train gets max(int(0.8 n), n - dev_cap) rows, dev the rest."""
    keyed = df.withColumn("_key", sample_key(id_col, seed))
    cuts = [lambda n: F.greatest((F.lit(0.8) * n).cast("bigint"), n - dev_cap)]
    return label_by_position(keyed, (), "_key", id_col, cuts, ("train", "dev"), "split").drop("_key")
