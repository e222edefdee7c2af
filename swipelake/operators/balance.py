"""Oversampling of the smaller classes by points between near neighbours."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from swipelake.functions.hashing import digest_word, unit_draw
from swipelake.operators.joins import broadcast_if_small
from swipelake.operators.neighbours import CHUNK_ROWS, distinct_points, nearest_neighbours
from swipelake.operators.sampling import grant_quotas
from swipelake.operators.vectors import DENSE, entries, sparse_struct, stored_vectors
from swipelake.session import cut_lineage, remove_folder, stored, stored_at

# Fixed value: neighbours to choose from.
NEIGHBOURS = 5

# New points made from one row in one go; a row that needs more is spread over several tasks.
POINTS_PER_STEP = 100_000


def missing_rows(counts: DataFrame, label: str) -> DataFrame:
    """(label, n, need): rows each class lacks to be as large as the largest. ``counts`` has one
    row per class."""
    return counts.select(label, "n", (F.max("n").over(Window.partitionBy()) - F.col("n")).alias("need"))


def neighbour_slots(points: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """(pid, slots): the k neighbours to draw from, as vectors; copies take a slot each.

    The point's own copies are its nearest neighbours. At most k entries per point are collected.
    """
    own = points.where("copies > 1").select(
        "grp", "pid", F.col("pid").alias("near_pid"), (F.col("copies") - 1).alias("near_copies"), F.lit(0.0).alias("dist")
    )
    nearest = Window.partitionBy("grp", "pid").orderBy("dist", F.col("near_pid") != F.col("pid"), "near_pid")
    before = F.coalesce(F.sum("near_copies").over(nearest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = (
        near.unionByName(own)
        .withColumn("place", F.row_number().over(nearest))
        .where(F.col("place") <= k)
        .withColumn("before", before)
        .where(F.col("before") < k)
        .withColumn("times", F.least("near_copies", F.lit(k) - F.col("before")).cast("int"))
    )
    vectors = points.select("grp", F.col("pid").alias("near_pid"), F.col("vec").alias("near_vec"))
    slot = F.struct("place", "times", "near_vec")
    return (
        chosen.join(vectors, ["grp", "near_pid"])
        .groupBy("grp", "pid")
        .agg(F.array_sort(F.collect_list(slot)).alias("slots"))
        .select(
            "grp", "pid", F.flatten(F.transform("slots", lambda s: F.array_repeat(s["near_vec"], s["times"]))).alias("slots")
        )
    )


def packed(vector: Column) -> Column:
    """A sparse vector as one array: the places that aren't zero, then as many values."""
    held = entries(vector)
    return F.concat(held["indices"].cast("array<double>"), held["values"])


def halves(points: Column) -> tuple[Column, Column]:
    """Places and values of a packed vector."""
    n = (F.size(points) / 2).cast("int")
    return F.slice(points, F.lit(1), n), F.slice(points, n + 1, n)


def between_packed(x: Column, y: Column, share: Column) -> Column:
    """The packed vector at a share of the way from x to y."""
    (x_places, x_values), (y_places, y_values) = halves(x), halves(y)
    of_x, of_y = F.map_from_arrays(x_places, x_values), F.map_from_arrays(y_places, y_values)

    def value(place: Column) -> Column:
        a, b = (F.coalesce(F.try_element_at(m, place), F.lit(0.0)) for m in (of_x, of_y))
        return a + share * (b - a)

    places = F.sort_array(F.array_union(x_places, y_places))
    return F.concat(places, F.transform(places, value))


def synthetic_points(
    df: DataFrame,
    label: str,
    key: str,
    vector: str,
    k: int = NEIGHBOURS,
    cell_rows: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    sparse: bool = False,
) -> DataFrame:
    """(label, base key, draw, vector) of the points that make all classes equally large.

    Every row of a smaller class serves as a base equally often; the remainder goes to the rows
    first in digest order. A point lies at a drawn place between its base and a drawn one of the
    base's k nearest neighbours in the class; only bases are looked at for neighbours. All draws
    depend on base key and number only.
    A class with one distinct vector can only repeat it. Keys are whole numbers. With ``sparse`` the
    vectors are packed (see ``packed``), and so are the new ones.
    """
    classes = cut_lineage(missing_rows(df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")), label))
    small = classes.where("need > 0").select(F.col(label).alias("grp"), "n", "need")
    minor = df.join(broadcast_if_small(small.select(F.col("grp").alias(label))), label, "left_semi")
    rest = small.select("grp", (F.col("need") % F.col("n")).alias("quota"))
    per_row = broadcast_if_small(small.select("grp", F.expr("need div n").alias("each")))
    with stored(distinct_points(minor, label, key, vector)) as found:
        points, folder = stored_at(
            grant_quotas(found, "grp", "pid", rest, F.col("copies"))
            .join(per_row, "grp")
            .withColumn("quota", F.col("each") * F.col("copies") + F.col("granted"))
            .drop("each", "granted")
        )
    near = nearest_neighbours(points, k, "quota > 0", cell_rows, chunk_rows, sparse)
    with stored(neighbour_slots(points, near, k)) as slots:
        # the search must not run again for every reader
        bases, _ = stored_at(points.where("quota > 0").join(slots, ["grp", "pid"], "left"))
    remove_folder(df.sparkSession, folder)
    steps = F.ceil(F.col("quota") / F.lit(POINTS_PER_STEP)).cast("bigint")
    bases = bases.withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), steps - 1)))
    first = F.col("step") * POINTS_PER_STEP
    last = F.least(first + POINTS_PER_STEP, F.col("quota")) - 1
    # Each draw takes one mate out of the slots before it becomes a row: the slots are not copied per draw.
    digest = F.md5(F.concat_ws(":", "pid", F.col("draw")))

    def mate_of(draw):
        choice = F.pmod(digest_word(F.md5(F.concat_ws(":", F.col("pid"), draw)), 1), F.size("slots")).cast("int")
        mate = F.when(F.size("slots") > 0, F.get("slots", choice)).otherwise(F.col("vec"))
        return F.struct(draw.alias("draw"), F.coalesce(mate, F.col("vec")).alias("mate"))

    draws = bases.repartition("grp", "pid", "step").select(
        "grp", "pid", "vec", F.explode(F.transform(F.sequence(first, last), mate_of)).alias("d")
    )
    placed = draws.select("grp", "pid", "d.draw", "vec", "d.mate").withColumn("u", unit_draw(digest, 0))
    if sparse:
        between = between_packed(F.col("vec"), F.col("mate"), F.col("u"))
    else:
        between = F.zip_with("vec", "mate", lambda x, y: x + F.col("u") * (y - x))
    return placed.select(
        F.col("grp").alias(label), F.col("pid").alias("base_key"), "draw", between.alias(vector)
    )


def balance_classes(df: DataFrame, label: str, key: str, vector: str, k: int = NEIGHBOURS) -> DataFrame:
    """The rows of ``df`` (label, vector) and the synthetic ones; one class only stays as it is.

    ``vector`` is an array or an ML vector. Rows of the largest class are passed on untouched.
    """
    kind = df.schema[vector].dataType
    if isinstance(kind, ArrayType):  # new points come from expressions that may be null
        kind = ArrayType(kind.elementType, True)
        df = df.withColumn(vector, F.col(vector).cast(kind))
    rows = df.select(label, vector, F.lit(False).alias("is_synthetic"))
    if len(df.where(F.col(label).isNotNull()).select(label).distinct().head(2)) < 2:
        return rows
    if isinstance(kind, VectorUDT):
        return _balanced_vectors(df, label, key, vector, k)
    made = synthetic_points(df, label, key, vector, k)
    return rows.unionByName(made.select(label, F.col(vector).cast(kind), F.lit(True).alias("is_synthetic")))


def _balanced_vectors(df: DataFrame, label: str, key: str, vector: str, k: int) -> DataFrame:
    """The same for ML vectors, which stay as sparse as they are: only a column of dense ones is searched with all its values."""
    held = F.unwrap_udt(F.col(vector))
    size = F.when(held["type"] == DENSE, F.size(held["values"])).otherwise(held["size"])
    seen = df.where(F.col(label).isNotNull()).agg(F.min(size).alias("low"), F.max(size).alias("high"), F.count_if(held["type"] != DENSE).alias("sparse")).first()
    if seen["low"] != seen["high"]:
        raise ValueError(f"vectors of {seen['low']} and of {seen['high']} places")
    if seen["sparse"]:
        made = synthetic_points(df.withColumn(vector, packed(F.col(vector))), label, key, vector, k, sparse=True)
        point = sparse_struct(F.lit(seen["high"]), *halves(F.col(vector)))
    else:
        made = synthetic_points(df.withColumn(vector, held["values"]), label, key, vector, k)
        none = F.lit(None)
        point = F.struct(F.lit(DENSE).cast("tinyint").alias("type"), none.cast("int").alias("size"), none.cast("array<int>").alias("indices"), F.col(vector).alias("values"))
    rows = df.select(label, held.alias(vector), F.lit(False).alias("is_synthetic"))
    return stored_vectors(rows.unionByName(made.select(label, point.alias(vector), F.lit(True).alias("is_synthetic"))), [vector])
