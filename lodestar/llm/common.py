"""Helpers that several corpus operators use: staging, row ranks, components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.session import unique_dir

# words of the word-based operators: runs of anything but blank, tab, LF, VT, FF, CR
WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so the loss of
    an executor never recomputes what lies before.
    """
    path = unique_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_places(df: DataFrame) -> tuple[DataFrame, str, str]:
    """The rows with two longs that name each: a hash of its file and its place there (and their column names).

    A DataFrame that is not a plain file table is staged first.
    """
    file, row = free_name(df, "_file"), free_name(df, "_row")

    def places(table: DataFrame) -> DataFrame:
        where = table.metadataColumn("_metadata")
        return table.withColumns({file: F.xxhash64(where["file_path"]), row: where["row_index"]})

    try:
        return places(df), file, row
    except AnalysisException:
        return places(staged(df, "placed")), file, row


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (Spark resolves names without case)."""
    used = {c.lower() for c in df.columns}
    name = base
    while name.lower() in used:
        name = "_" + name
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), as a long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_totals(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str | Column],
                   amount: str | Column, total: str) -> DataFrame:
    """Add ``total``: the sum of ``amount`` over all rows before this one in its group.

    Rows are ordered by ``bucket``, then by ``order``. A group may hold any
    share of the rows: only one (group, bucket) is ever sorted in one task,
    and the buckets' sums are a table of groups x buckets, whose own running
    sums add up before a join puts them back. ``df`` should be cheap to read
    twice (staged). Group and bucket are never null.
    """
    keys = [*group, bucket]
    amount = F.col(amount) if isinstance(amount, str) else amount
    sums = df.groupBy(*keys).agg(F.sum(amount).alias("_bucket_sum"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                        F.coalesce(F.sum("_bucket_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # plain equality, so that the join uses the window's partitioning and moves the rows no second time
    match = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    cond = match[0]
    for m in match[1:]:
        cond = cond & m
    return (df.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0)))
            .join(bases, cond, "left")
            .withColumn(total, F.col("_within") + F.coalesce("_base", F.lit(0)))
            .drop("_within", "_base", *[f"_k{i}" for i in range(len(keys))]))


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has a link.

    Alternates two joins until nothing changes. The *large* step ties every
    larger neighbour of a node to the node's smallest neighbour, the *small*
    step does so for the smaller neighbours; both keep the components and
    together they turn each component into one star around its smallest id.
    Minima are partial aggregates, and they are staged before they are joined
    back, so that a hub holding a third of the links is a skewed equi-join
    that the adaptive planner can split, not one task.
    """
    spark = links.sparkSession
    pairs = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    edges = staged(pairs, "cc-edges")
    last = None
    for _ in range(max_rounds):
        # large step: the smallest of a node and its neighbours, offered to its larger neighbours
        both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionByName(
            edges.select(F.col("lo").alias("n"), F.col("hi").alias("m")))
        low = staged(both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low")), "cc-low")
        large = (edges.join(low, F.col("lo") == F.col("n"))
                 .select("hi", F.col("low").alias("lo")).distinct())
        large = staged(large, "cc-large")
        # small step: the smaller neighbours and the node itself are tied to the smallest of them
        low = staged(large.groupBy(F.col("hi").alias("n")).agg(F.min("lo").alias("low")), "cc-low")
        small = (large.join(low, F.col("hi") == F.col("n"))
                 .select(F.explode(F.array(F.struct(F.col("hi").alias("hi"), F.col("low").alias("lo")),
                                           F.struct(F.col("lo").alias("hi"), F.col("low").alias("lo")))).alias("e"))
                 .select("e.hi", "e.lo").where("hi != lo").distinct())
        edges = staged(small, "cc-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == last:
            break
        last = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots)
