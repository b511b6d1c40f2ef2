"""Ordered dataflow operators. All take and give DataFrames; order is a list of columns with a total order, and key the
columns within which the order holds. Operators without key number rows across partitions with ordinal()."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..adapters import settled


def _w(key, order):
    return Window.partitionBy(*key).orderBy(*order)


def ordinal(df: DataFrame, order: list, name: str = "ord") -> DataFrame:
    """Rows numbered from 1 in a global order: range partitions are numbered apart, and each is shifted by the rows of those
    before it. Only one row for each partition meets in one place. Ranges come from a sample that differs from run to run, so the
    partitions are settled before they are counted."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    d = settled(d.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    ahead = d.groupBy("_p").agg(F.count("*").alias("_n"))
    ahead = ahead.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return d.join(ahead, "_p").withColumn(name, (F.col("_b") + F.col("_i") + 1).cast("long")).drop("_p", "_i", "_b")


def where(df: DataFrame, p: Column) -> DataFrame:
    return df.filter(p)


def transform(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def counts(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n"))


def group_all(df: DataFrame, key: list[str], value: str, name: str = "items") -> DataFrame:
    return df.groupBy(*key).agg(F.sort_array(F.collect_list(value)).alias(name))


def islands(df: DataFrame, key: list[str], order: list, starts: Column, name: str = "island") -> DataFrame:
    """Numbers runs within key; starts says whether a row opens a new one (null: it does)."""
    return df.withColumn(name, F.sum(F.coalesce(starts, F.lit(True)).cast("long")).over(_w(key, order).rowsBetween(Window.unboundedPreceding, 0)))


def group_adjacent(df: DataFrame, key: list[str], order: list, by: str, name: str = "island") -> DataFrame:
    return islands(df, key, order, ~F.lag(by).over(_w(key, order)).eqNullSafe(F.col(by)) | (F.row_number().over(_w(key, order)) == 1), name)


def group_adjacent_if(df: DataFrame, key: list[str], order: list, together: Column, name: str = "island") -> DataFrame:
    """together: over columns and their lag() in the same window."""
    return islands(df, key, order, ~together, name)


def lagged(df: DataFrame, key, order, column: str, n: int = 1) -> Column:
    return F.lag(column, n).over(_w(key, order))


def in_groups_of(df: DataFrame, n: int, order: list, name: str = "batch") -> DataFrame:
    return ordinal(df, order).withColumn(name, F.floor((F.col("ord") - 1) / n).cast("long"))


def sliding_window(df: DataFrame, key: list[str], order: list, value: str, n: int, name: str = "window") -> DataFrame:
    """Whole windows of n; a key with fewer rows gives its one short window."""
    w = _w(key, order).rowsBetween(0, n - 1)
    size = F.count("*").over(Window.partitionBy(*key))
    out = df.withColumn(name, F.collect_list(value).over(w)).withColumn("_size", size).withColumn("_at", F.row_number().over(_w(key, order)))
    return out.filter((F.size(name) == n) | ((F.col("_size") < n) & (F.col("_at") == 1))).drop("_size", "_at")


def take_while(df, key, order, p: Column) -> DataFrame:
    return _prefix(df, key, order, p).filter("_bad = 0").drop("_bad")


def drop_while(df, key, order, p: Column) -> DataFrame:
    return _prefix(df, key, order, p).filter("_bad > 0").drop("_bad")


def _prefix(df, key, order, p):
    return df.withColumn("_bad", F.sum((~p).cast("int")).over(_w(key, order).rowsBetween(Window.unboundedPreceding, 0)))


def take_first(df, n: int, order: list) -> DataFrame:
    return df.orderBy(*order).limit(n)


def take_last(df, n: int, descending: list) -> DataFrame:
    return df.orderBy(*descending).limit(n)


def drop_first(df, n: int, order: list) -> DataFrame:
    return ordinal(df, order).filter(F.col("ord") > n).drop("ord")


def drop_last(df, n: int, descending: list) -> DataFrame:
    return ordinal(df, descending).filter(F.col("ord") > n).drop("ord")


def where_in(df, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_semi")


def where_not_in(df, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_anti")


def where_extreme_by(df, key: list[str], by: Column) -> DataFrame:
    """All ties of the first value of by (a sort expression) within key."""
    return df.withColumn("_r", F.rank().over(Window.partitionBy(*key).orderBy(by))).filter("_r = 1").drop("_r")


def exists_where(df, key: list[str], p: Column, name: str = "found") -> DataFrame:
    return df.groupBy(*key).agg(F.bool_or(p).alias(name))


def top_n_by(df, n: int, descending: list) -> DataFrame:
    return df.orderBy(*descending).limit(n)


def unique_adjacent(df, key, order, by: str) -> DataFrame:
    w = _w(key, order)
    return df.withColumn("_new", ~F.lag(by).over(w).eqNullSafe(F.col(by)) | (F.row_number().over(w) == 1)).filter("_new").drop("_new")


def unique_all(df, by: list[str], order: list) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(_w(by, order))).filter("_r = 1").drop("_r")


def concat(df, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(column)).drop(column)


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def zip_with(a: DataFrame, b: DataFrame, order_a: list, order_b: list) -> DataFrame:
    """Positional join; the shorter side ends it. Columns of the two sides must differ."""
    return ordinal(a, order_a).join(ordinal(b, order_b), "ord")


def zip_adjacent(df, key, order, column: str, f, name: str) -> DataFrame:
    before = F.lag(column).over(_w(key, order))
    return df.withColumn("_b", before).withColumn("_first", F.row_number().over(_w(key, order)) == 1).filter("not _first").withColumn(name, f(F.col("_b"), F.col(column))).drop("_b", "_first")


def cartesian(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.crossJoin(b)


def fold(df, key: list[str], order: list[str], value: str, start: Column, merge, name: str) -> DataFrame:
    """Left fold in order within key; a key's values must fit one row."""
    items = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_v")))), lambda x: x["_v"])
    return df.groupBy(*key).agg(items.alias("_items")).select(*key, F.aggregate("_items", start, merge).alias(name))


def fold_first(df, key, order, value, merge, name) -> DataFrame:
    items = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_v")))), lambda x: x["_v"])
    return df.groupBy(*key).agg(items.alias("_i")).select(*key, F.aggregate(F.slice("_i", 2, F.size("_i")), F.element_at("_i", 1), merge).alias(name))


def first_or(df, key, order_by: str, value: str, p: Column, default, name: str) -> DataFrame:
    return df.groupBy(*key).agg(F.coalesce(F.min(F.when(p, F.struct(order_by, value)))[value], F.lit(default)).alias(name))


def last_or(df, key, order_by: str, value: str, p: Column, default, name: str) -> DataFrame:
    return df.groupBy(*key).agg(F.coalesce(F.max(F.when(p, F.struct(order_by, value)))[value], F.lit(default)).alias(name))


def get_unique(df: DataFrame, key: list[str], p: Column, value: str, name: str) -> DataFrame:
    """The one value of each key where p holds; keys with none or several raise an error."""
    g = df.groupBy(*key).agg(F.count_if(p).alias("_n"), F.max(F.when(p, F.col(value))).alias(name))
    return g.select(*key, F.when(F.col("_n") == 1, F.col(name)).otherwise(F.raise_error(F.lit("expected exactly one element"))).alias(name))


def reverse(df, order: list) -> DataFrame:
    return df.orderBy(*order)


def sum_by(df, key, value: Column, name: str = "total") -> DataFrame:
    return df.groupBy(*key).agg(F.sum(value).alias(name))


def gmean_by(df, key, value: str, name: str = "gmean") -> DataFrame:
    """exp(mean(ln(1 + y))) - 1 over positive y."""
    y = F.when(F.col(value) > 0, F.log1p(F.col(value)))
    return df.groupBy(*key).agg((F.exp(F.avg(y)) - 1).alias(name))


def at_or_default(df, lookup: DataFrame, key: str, value: str, default) -> DataFrame:
    return df.join(lookup, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def fold_default(df, key: list[str], order: list[str], value: str, merge, name: str, kind: str = "long") -> DataFrame:
    """Left fold from the default of a kind: 0, or an empty text."""
    return fold(df, key, order, value, F.lit("" if kind == "string" else 0).cast(kind), merge, name)


def sort_by(df, key: list, order: list) -> DataFrame:
    """Sorted by key; rows of equal keys stay in the order of order."""
    return df.orderBy(*key, *order)


def lazy_sort(df, key: list, n: int) -> DataFrame:
    """The first n of a sort, without sorting the rest."""
    return df.orderBy(*key).limit(n)


def set_unique(df: DataFrame, key: list[str], value: str, default, name: str) -> DataFrame:
    """The one value of each key, or the default where all are null; several different ones are an error."""
    g = df.groupBy(*key).agg(F.count_distinct(value).alias("_n"), F.max(value).alias(name))
    wrong = F.raise_error(F.lit("expected one value at most"))
    return g.select(*key, F.when(F.col("_n") > 1, wrong).otherwise(F.coalesce(name, F.lit(default))).alias(name))


def adapt(df: DataFrame, key: list[str], order: list[str], step, schema: str) -> DataFrame:
    """A stage of one's own that pulls rows in order: step takes an iterator of row dictionaries and yields dictionaries. It runs once
    for each key; rows come and go as a stream, so a key's rows need not fit memory."""
    import itertools

    import pandas as pd

    names = [x.split()[0] for x in schema.split(", ")]

    def run(parts):
        rows = (r for pdf in parts for r in pdf.to_dict("records"))
        out = (x for _, mine in itertools.groupby(rows, lambda r: tuple(r[k] for k in key)) for x in step(mine))
        while some := list(itertools.islice(out, 20_000)):
            yield pd.DataFrame(some, columns=names)

    return df.repartition(*key).sortWithinPartitions(*key, *order).mapInPandas(run, schema)


def map_groups(df: DataFrame, key: list[str], order: list, by: str, f, name: str) -> DataFrame:
    """Runs of neighbours with one value of by, each row given f(window of its run)."""
    g = group_adjacent(df, key, order, by, "_run")
    return g.withColumn(name, f(Window.partitionBy(*key, "_run").orderBy(*order))).drop("_run")


def map_groups_if(df: DataFrame, key: list[str], order: list, together: Column, f, name: str) -> DataFrame:
    """The same for runs of rows that hold together with the row before."""
    g = group_adjacent_if(df, key, order, together, "_run")
    return g.withColumn(name, f(Window.partitionBy(*key, "_run").orderBy(*order))).drop("_run")


def counter(added: DataFrame, removed: DataFrame, *key: str) -> DataFrame:
    """Elements of a multiset after additions and removals; those that are used up are gone."""
    both = added.select(*key, F.lit(1).alias("_n")).unionAll(removed.select(*key, F.lit(-1).alias("_n")))
    return both.groupBy(*key).agg(F.sum("_n").alias("n")).filter("n > 0")


def irange(spark, start: int, stop: int, step: int = 1) -> DataFrame:
    return spark.range(start, stop, step)
