"""Share-of-total tables over replicates and their files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.functions.names import safe_file_name
from massloom.operators.shares import fold_small, with_shares

# The cuts that are reported and the share below which a group is small.
CUT_COLUMNS = ["source_type", "material", "condition"]
GLOBAL_COLUMNS = ["repository_id", "organism"]
THRESHOLD = 0.005


def dataset(replicates: DataFrame, files: DataFrame) -> DataFrame:
    """Replicates with the repository and size of their file."""
    return replicates.join(files.select("id", "repository_id", "size_bytes"), "id")


def count_share(data: DataFrame, column: str, threshold: float = THRESHOLD) -> DataFrame:
    """Replicates per value of ``column`` with small groups folded."""
    grouped = data.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("value"))
    return _one_cut(grouped, threshold)


def size_share(data: DataFrame, column: str, threshold: float = THRESHOLD) -> DataFrame:
    """Bytes per value of ``column`` with small groups folded."""
    grouped = data.groupBy(F.col(column).alias("label")).agg(F.sum("size_bytes").alias("value"))
    return _one_cut(grouped, threshold)


def _one_cut(grouped: DataFrame, threshold: float) -> DataFrame:
    cut = grouped.withColumn("cut", F.lit("all"))
    return with_shares(fold_small(cut, ["cut"], threshold=threshold), ["cut"]).select(
        "label", "value", "pct", "legend", "rank"
    )


def olap_cuts(data: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All cuts in one pass over the data.

    Globally by repository and by organism (replicates and bytes), and within
    each organism by the other columns (replicates). One grouping-sets
    aggregate takes the place of a scan per chart and organism.
    """
    inner = [c for c in CUT_COLUMNS if c in data.columns]
    columns = [*GLOBAL_COLUMNS, *inner]
    sets = [[F.col(c)] for c in GLOBAL_COLUMNS] + [[F.col("organism"), F.col(c)] for c in inner]
    grouped = data.groupingSets(sets, *[F.col(c) for c in columns]).agg(
        F.count("*").alias("replicates"),
        F.sum("size_bytes").alias("size_bytes"),
        *[F.grouping(c).alias(f"_{c}") for c in columns],
    )
    by_organism = F.col("_organism") == 0
    column, label = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in columns:
        # Inner cuts group by organism too; theirs is the other column.
        used = (F.col(f"_{name}") == 0) & (F.lit(name != "organism") | _only_organism(inner))
        column = F.coalesce(column, F.when(used, F.lit(name)))
        label = F.coalesce(label, F.when(used, F.col(name)))
    organism = F.when(by_organism & ~_only_organism(inner), F.col("organism"))
    shaped = grouped.select(
        column.alias("cut_column"),
        organism.alias("organism"),
        (by_organism & ~_only_organism(inner)).alias("_inner"),
        label.alias("label"),
        "replicates",
        "size_bytes",
    ).where(~F.col("_inner") | F.col("organism").isNotNull())
    measures = F.when(
        F.col("_inner"), F.array(F.struct(F.lit("replicates").alias("measure"), F.col("replicates").alias("value")))
    ).otherwise(
        F.array(
            F.struct(F.lit("replicates").alias("measure"), F.col("replicates").alias("value")),
            F.struct(F.lit("size_bytes").alias("measure"), F.col("size_bytes").alias("value")),
        )
    )
    # Global cuts have no organism; an empty one keeps the join key free of nulls.
    long = shaped.select(
        F.when(F.col("_inner"), F.lit("organism")).otherwise(F.lit("global")).alias("scope"),
        F.coalesce("organism", F.lit("")).alias("organism"),
        "cut_column",
        "label",
        F.inline(measures),
    )
    cut = ["scope", "organism", "cut_column", "measure"]
    return with_shares(fold_small(long, cut, threshold=threshold), cut).select(
        *cut, "label", "value", "pct", "legend", "rank", safe_file_name(F.col("organism")).alias("slug")
    )


def _only_organism(inner: list[str]):
    """True on rows of the plain organism grouping."""
    test = F.col("_organism") == 0
    for name in inner:
        test = test & (F.col(f"_{name}") == 1)
    return test
