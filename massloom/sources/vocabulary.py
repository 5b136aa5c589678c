"""Controlled vocabularies: terms from files of ontology stanzas, and the closure of ``is_a``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.session import durable, forget

# What ends one stanza and begins the next, and the kind that holds a term.
STANZA_BREAK = "\n["
TERM_STANZA = "Term]"


def _values(lines: Column, tag: str) -> Column:
    """Values of all lines ``tag: value`` in order."""
    mark = f"{tag}:"
    found = F.filter(lines, lambda line: F.startswith(line, F.lit(mark)))
    return F.transform(found, lambda line: F.trim(F.substring(line, F.lit(len(mark) + 1), F.length(line))))


def _target(value: Column) -> Column:
    """The accession of a reference: what stands before qualifiers in braces and the comment after ``!``."""
    return F.trim(F.regexp_extract(value, r"^([^!{]*)", 1))


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """Terms of ontology files: accession, term, is_a (array of accessions), obsolete.

    Every stanza is a record of its own, so that large files are split. Stanzas
    of other kinds and the head of a file are left out, and so are terms without
    id. A stanza without name has a null ``term``; an accession stated in several
    stanzas, or in several files, is one row: the least name that is given, all
    of its parents, obsolete only if all its stanzas say so.
    """
    stanza = F.regexp_replace(F.col("value"), r"^(?:\x{FEFF})?\[", "")
    lines = F.transform(F.split(stanza, "\n"), lambda line: F.rtrim(F.rtrim(line), F.lit("\r")))
    stanzas = spark.read.option("lineSep", STANZA_BREAK).text(path).select(lines.alias("lines"))
    terms = stanzas.where(F.get("lines", F.lit(0)) == TERM_STANZA).select(
        F.nullif(F.get(_values(F.col("lines"), "id"), F.lit(0)), F.lit("")).alias("accession"),
        F.nullif(F.get(_values(F.col("lines"), "name"), F.lit(0)), F.lit("")).alias("term"),
        F.filter(F.transform(_values(F.col("lines"), "is_a"), _target), lambda a: a != "").alias("is_a"),
        F.exists(_values(F.col("lines"), "is_obsolete"), lambda x: x == "true").alias("obsolete"),
    )
    return (
        terms.where(F.col("accession").isNotNull())
        .groupBy("accession")
        .agg(
            F.min("term").alias("term"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("is_a")))).alias("is_a"),
            F.bool_and("obsolete").alias("obsolete"),
        )
    )


def ancestors(terms: DataFrame) -> DataFrame:
    """Closure of ``is_a``: accession, ancestor, distance (the fewest steps, from 1).

    Each round makes the ways up to twice as long as those known: the shortest way
    to an ancestor further off passes a term that is exactly ``reach`` steps away,
    so only the ways of that length are joined with all that are known. The rounds
    number as the logarithm of the depth, and each way is made as often as there
    are terms at that place. Of several ways to one ancestor the shortest is kept;
    a vocabulary that runs in a circle ends too (its terms are their own
    ancestors). Parents without a stanza are ancestors as well.
    """
    known = durable(
        terms.select("accession", F.explode_outer("is_a").alias("ancestor"))
        .where(F.col("ancestor").isNotNull())
        .distinct()
        .withColumn("distance", F.lit(1)),
        "ancestors",
    )
    reach = 1
    while True:
        upper = known.select(
            F.col("accession").alias("ancestor"), F.col("ancestor").alias("_above"), F.col("distance").alias("_more")
        )
        longer = (
            known.where(F.col("distance") == reach)
            .join(upper, "ancestor")
            .groupBy("accession", F.col("_above").alias("ancestor"))
            .agg((F.min("_more") + F.lit(reach)).alias("distance"))
        )
        # A shorter way is known already.
        further = durable(longer.join(known, ["accession", "ancestor"], "left_anti"), "ancestors")
        if further.isEmpty():
            forget(further)
            return known
        known = known.unionByName(further)
        reach *= 2


def under(rows: DataFrame, closure: DataFrame, ancestor: str, accession: str = "accession") -> DataFrame:
    """Rows whose accession is ``ancestor`` or a term below it; null accessions are left out.

    The terms below one ancestor are distinct, so no row is repeated.
    """
    below = closure.where(F.col("ancestor") == ancestor).select(F.col("accession").alias("_term"))
    named = below.unionByName(below.sparkSession.createDataFrame([(ancestor,)], "_term string")).distinct()
    return rows.join(named, F.col(accession) == F.col("_term"), "left_semi")
