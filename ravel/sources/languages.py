"""English names of language codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names that are sent to every task at most; a longer table is joined by shuffle.
MAX_BROADCAST = 10_000


def language_names(spark: SparkSession) -> DataFrame:
    """(code, name) of the two-letter codes the JVM's locale data knows."""
    locale = spark._jvm.java.util.Locale
    rows = [(c, locale.forLanguageTag(c).getDisplayLanguage(locale.ENGLISH))
            for c in locale.getISOLanguages()]
    return spark.createDataFrame(rows, "code string, name string")


def with_language_name(df: DataFrame, names: DataFrame, code_col: str = "lang",
                       out: str = "language") -> DataFrame:
    """``df`` with the name of its code as ``out``, whatever the code's case; the
    code itself where it has no name, null for a null code. ``names`` is
    (code, name), one row per code; it is broadcast if it is small."""
    names = names.select(F.lower("code").alias("_code"), F.col("name").alias("_name")) \
        .dropDuplicates(["_code"])
    if names.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        names = F.broadcast(names)
    rows = df.join(names, F.lower(df[code_col]) == F.col("_code"), "left")
    return rows.withColumn(out, F.coalesce("_name", df[code_col])).drop("_code", "_name")
