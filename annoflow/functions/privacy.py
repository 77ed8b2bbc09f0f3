"""Reversible, keyed pseudonymisation of columns.

AES from Spark's built-ins, base64 text out.  ``deterministic=True`` uses ECB
so equal plaintexts give equal ciphertexts (ids still join after encryption);
otherwise GCM with a random IV.  Nulls stay null; null list items are dropped
and an empty list becomes null; integers are encrypted through their decimal
string.  The key (16, 24 or 32 bytes) should come from a key table (``key_from_table``): it is then read when the query runs,
and neither plans nor event logs show it.  A key given as a string stands in the plan as a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def key_from_table(spark: SparkSession, path: str, name: str) -> Column:
    """The key of that name from a Parquet table (name string, key binary), as a scalar subquery: the plan names the table only."""
    return spark.read.schema("name string, key binary").parquet(path).where(F.col("name") == name).select("key").scalar()


def _key(key) -> Column:
    return key if isinstance(key, Column) else F.lit(key).cast("binary")


def _mode(deterministic: bool) -> str:
    return "ECB" if deterministic else "GCM"


def encrypt_value(c: Column, key, deterministic: bool = True) -> Column:
    return F.base64(F.aes_encrypt(c.cast("string").cast("binary"), _key(key), F.lit(_mode(deterministic))))


def decrypt_value(c: Column, key, deterministic: bool = True) -> Column:
    return F.aes_decrypt(F.unbase64(c), _key(key), F.lit(_mode(deterministic))).cast("string")


def _deterministic(kind: str, deterministic: bool | None) -> bool:
    return kind == "id" if deterministic is None else deterministic


def encrypt_columns(df: DataFrame, spec: dict, key, deterministic: bool | None = None) -> DataFrame:
    """``spec`` maps column -> 'id' | 'str' | 'int' | 'list'.

    Ids are encrypted so that they still join (ECB), all else so that equal values look different (GCM), unless ``deterministic``
    says otherwise for all.
    """
    out = df
    for name, kind in spec.items():
        c, fixed = F.col(name), _deterministic(kind, deterministic)
        if kind == "list":
            kept = F.filter(c, lambda x: x.isNotNull())
            enc = F.transform(kept, lambda x: encrypt_value(x, F.col("_aes_key"), fixed))
            out = out.withColumn("_aes_key", _key(key)).withColumn(name, F.when(F.size(kept) > 0, enc)).drop("_aes_key")
        else:
            out = out.withColumn(name, encrypt_value(c, key, fixed))
    return out


def decrypt_columns(df: DataFrame, spec: dict, key, deterministic: bool | None = None) -> DataFrame:
    out = df
    for name, kind in spec.items():
        c, fixed = F.col(name), _deterministic(kind, deterministic)
        if kind == "list":
            out = (out.withColumn("_aes_key", _key(key))
                   .withColumn(name, F.transform(c, lambda x: decrypt_value(x, F.col("_aes_key"), fixed))).drop("_aes_key"))
        else:
            out = out.withColumn(name, decrypt_value(c, key, fixed).cast("bigint" if kind == "int" else "string"))
    return out
