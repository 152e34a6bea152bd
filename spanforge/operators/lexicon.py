"""Lexicon and corpus shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.functions.labels import class_names
from spanforge.functions.text import py_float_text


def to_offset_format(df: DataFrame, sentence: str = "sentence", labels: str = "ner_labels") -> DataFrame:
    """B1: canonical record -> offset record; the original columns are dropped."""
    nl = F.col(labels)
    return df.withColumn("text", F.col(sentence)).withColumn("ent_starts", nl["start"]) \
        .withColumn("ent_stops", nl["stop"]).withColumn("ent_classes", class_names(nl["ner_class"])) \
        .drop(sentence, labels)


def dropna_any(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with NULL in any column of ``subset``."""
    return df.dropna("any", subset=subset)


def dropna_single_count(df: DataFrame, col: str, count_col: str) -> DataFrame:
    """Drop NULLs of one column (from the original frame), count non-null names."""
    return df.dropna(subset=[col]).agg(F.count(count_col).alias("n_names"))


def as_strings(c: Column, numeric: bool = False) -> Column:
    """Text form of a column as pandas ``astype(str)`` renders it; NULL -> 'nan'."""
    txt = py_float_text(c) if numeric else c.cast("string")
    return F.coalesce(txt, F.lit("nan"))


def cast_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast every column of ``df`` to the type of the same-named target field."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def append_to_split(corpus: DataFrame, extra: DataFrame, split: str = "train",
                    split_col: str = "split") -> DataFrame:
    """Bag union of ``extra`` into one split only (``unionByName``)."""
    return corpus.unionByName(extra.withColumn(split_col, F.lit(split)), allowMissingColumns=True)


def split_counts(df: DataFrame, split_col: str = "split", flag: str = "synthetic") -> DataFrame:
    """Rows per split, how many were appended, and the size before."""
    return df.groupBy(split_col).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(flag)).alias("n_synthetic"),
        (F.count("*") - F.count_if(F.col(flag))).alias("n_before"))


def describe_splits(df: DataFrame, columns: dict[str, Column], split_col: str = "split",
                    edges: tuple[int, ...] = (1, 10, 100, 1000, 10000), accuracy: int = 10000,
                    rsd: float = 0.02) -> DataFrame:
    """One row per split and described column, all from one aggregation.

    ``columns`` maps a name to the value to describe: a string or an array is measured
    by its length, a number by itself.  Output: split, name, n_rows, n_null, minimum,
    maximum, mean, median, p90 (of the measure, nulls left out), ``histogram`` (rows
    below the first of the ascending ``edges``, then from each edge up to the next) and
    ``n_distinct``.

    ``n_distinct`` is a HyperLogLog++ estimate with relative standard deviation ``rsd``;
    median and p90 are off by at most 1/``accuracy`` of the rows in rank.  Each
    task sends one bounded sketch per split, so a split with most of the rows is no hot
    key.  A column of nulls only has null measures, a zero histogram and no distinct
    value; an empty frame gives no row."""
    names, values = list(columns), list(columns.values())
    types = [f.dataType for f in df.select(*[v.alias(f"c{k}") for k, v in enumerate(values)]).schema]
    plain = df.select(F.col(split_col).alias("split"), *[v.alias(f"v{k}") for k, v in enumerate(values)],
                      *[_measure(v, t).alias(f"m{k}") for k, (v, t) in enumerate(zip(values, types))])
    per = []
    for k in range(len(names)):
        v, m = F.col(f"v{k}"), F.col(f"m{k}")
        bins = ([F.count_if(m < edges[0])] + [F.count_if((m >= a) & (m < b)) for a, b in zip(edges, edges[1:])]
                + [F.count_if(m >= edges[-1])])
        ranks = F.percentile_approx(m, [0.5, 0.9], accuracy)
        per.append(F.struct(F.lit(names[k]).alias("name"), F.count("*").alias("n_rows"),
                            (F.count("*") - F.count(v)).alias("n_null"), F.min(m).alias("minimum"),
                            F.max(m).alias("maximum"), F.avg(m).alias("mean"), F.get(ranks, 0).alias("median"),
                            F.get(ranks, 1).alias("p90"), F.array(*bins).alias("histogram"),
                            F.approx_count_distinct(v, rsd).alias("n_distinct")))
    return plain.groupBy("split").agg(F.array(*per).alias("d")).select("split", F.inline("d"))


def _measure(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.length(value).cast("double")
    if isinstance(kind, T.ArrayType):
        return F.when(value.isNotNull(), F.size(value)).cast("double")
    return value.cast("double")


def lexicon_by_source(lex: DataFrame, source: str, source_col: str = "source") -> DataFrame:
    """Choose one lexicon source (code list, curated list, fallback...)."""
    return lex.where(F.col(source_col) == F.lit(source))
