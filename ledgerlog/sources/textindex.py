"""Which files of a table hold which three-character stretches of its text columns.

A pattern such as ``%deadlock%`` cannot be compared with the bounds of a file. But a file whose texts lack one of the pattern's
stretches holds no match, so only the others are read; the predicate itself is checked on their rows. Files the index does not
know yet are read too, so it may lag behind an appended table. Files must not be changed in place, as Spark never does.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import any_col_like

GRAM = 3
_LITERAL = re.compile(r"\\.|[%_]|[^\x00-\x7f]")


def grams(text: Column) -> Column:
    """Distinct stretches of the lower-cased text, found in one pass; none of a shorter one, or of NULL."""
    found = F.regexp_extract_all(F.lower(text), F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1))
    return F.array_distinct(F.coalesce(found, F.array().cast("array<string>")))


def _tagged(column: str) -> Column:
    return F.transform(grams(F.col(column)), lambda g: F.struct(F.lit(column).alias("column"), g.alias("gram")))


def needed(pattern: str) -> list[str]:
    """Stretches every text that is LIKE the pattern, in any case, holds.

    They are taken between wildcards and characters outside ASCII, whose lower case is left to Spark; so are those after an escape.
    """
    runs = [run.lower() for run in _LITERAL.split(pattern)]
    return sorted({run[i:i + GRAM] for run in runs for i in range(len(run) - GRAM + 1)})


def file_key(uri: str) -> str:
    """A file's path without the ways of writing its scheme."""
    return unquote(urlsplit(uri).path)


def files_of(spark: SparkSession, path: str) -> dict[str, str]:
    """The files of a table by their keys. Only names reach the driver, as for any scan."""
    return {file_key(uri): uri for uri in spark.read.parquet(path).inputFiles()}


def index_files(spark: SparkSession, path: str, columns: Sequence[str], index: str) -> int:
    """Add the files of ``path`` that ``index`` does not know yet; how many there were.

    A file gives each stretch once, found in the tasks that read it. Stretches are sorted, so a lookup reads few of their files.
    The names of the files are written last: after a failure in between they count as unknown, and are added again.
    """
    known = _known(spark, index)
    new = {key: uri for key, uri in files_of(spark, path).items() if key not in known}
    if not new:
        return 0
    rows = spark.read.option("basePath", path).parquet(*new.values())
    each = F.flatten(F.array(*(_tagged(c) for c in columns)))
    found = rows.select(F.col("_metadata.file_path").alias("file"), F.inline(each)).distinct()
    found.repartitionByRange("column", "gram", "file").sortWithinPartitions("column", "gram", "file").write.mode(
        "append").parquet(f"{index}/grams")
    spark.createDataFrame([(key, c) for key in new for c in columns], "file string, column string").write.mode(
        "append").parquet(f"{index}/files")
    return len(new)


def _known(spark: SparkSession, index: str, columns: Iterable[str] | None = None) -> set[str]:
    """Files that are indexed, for all of ``columns`` if given."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{index}/files")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return set()
    rows = spark.read.schema("file string, column string").parquet(f"{index}/files")
    if columns is None:
        return {r["file"] for r in rows.select("file").distinct().collect()}
    wanted = sorted(set(columns))
    held = rows.where(F.col("column").isin(wanted)).groupBy("file").agg(F.countDistinct("column").alias("n"))
    return {r["file"] for r in held.where(F.col("n") == len(wanted)).collect()}


def candidate_files(spark: SparkSession, path: str, index: str, pairs: Sequence[tuple[str, str]]) -> list[str]:
    """Files of ``path`` that may hold a row of which any (column, pattern) pair is true."""
    files = files_of(spark, path)
    known = _known(spark, index, [c for c, _ in pairs])
    wanted = [(c, needed(p)) for c, p in pairs]
    if not known or not all(held for _, held in wanted):
        return sorted(files.values())
    asked = sorted({(c, g) for c, held in wanted for g in held})
    here = None
    for column in sorted({c for c, _ in asked}):
        one = (F.col("column") == column) & F.col("gram").isin([g for c, g in asked if c == column])
        here = one if here is None else here | one
    rows = spark.read.schema("file string, column string, gram string").parquet(f"{index}/grams").where(here)
    # at most as many stretches as the patterns have reach a file's list
    held = rows.groupBy("file").agg(F.collect_set(F.struct("column", "gram")).alias("held"))
    whole = None
    for column, parts in wanted:
        every = F.size(F.array_intersect("held", F.array(*(
            F.struct(F.lit(column).alias("column"), F.lit(g).alias("gram")) for g in parts)))) == len(parts)
        whole = every if whole is None else whole | every
    found = {file_key(r["file"]) for r in held.where(whole).select("file").collect()}
    return sorted(uri for key, uri in files.items() if key in found or key not in known)


def search(spark: SparkSession, path: str, index: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of the table at ``path`` where any column is LIKE its pattern, in any case; other files are not opened.

    Patterns without a stretch of three ASCII characters need all files.
    """
    files = candidate_files(spark, path, index, pairs)
    whole = spark.read.parquet(path)
    if not files:
        return whole.where("false")
    rows = spark.read.schema(whole.schema).option("basePath", path).parquet(*files)
    return rows.where(any_col_like(pairs))
