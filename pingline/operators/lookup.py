"""As-of, weighted range and nearest-neighbour lookups from equi-joins and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingline.functions.columns import haversine_km
from pingline.operators.joins import spread_join
from pingline.operators.ordered import carry_last, id_chunk, running_total, time_chunk
from pingline.session import stored

# fixed values
ALWAYS_NEIGHBOURS = 3
MORE_NEIGHBOURS = 2
MORE_WITHIN_KM = 10.0
SITE_EXPONENT = 0.8


def as_of(mixed: DataFrame, by: list[str], order: list[str], value: str, out: str, chunk_seconds: int = 3600) -> DataFrame:
    """Value in force at each row of a table that holds changes (``value`` set) and
    probes (``value`` null). Before its first change a key has its first value."""
    return carry_last(mixed, by, order, value, out, time_chunk(order[0], chunk_seconds), default_first=True)


# ---- weighted pick ------------------------------------------------------


def cumulative_shares(items: DataFrame, rank: str = "rank", exponent: float = SITE_EXPONENT) -> DataFrame:
    """Half-open share interval ``(lo, hi]`` of each ranked item, weight ``1/rank^exponent``.

    The weights are summed as decimals: the sums are exact, so one item's ``lo`` is
    the very number that is its neighbour's ``hi``.
    """
    weighted = items.withColumn("__w", (1 / F.pow(F.col(rank), exponent)).cast("decimal(28,18)"))
    summed = running_total(weighted, [], [rank], {"__upto": "__w"}, id_chunk(rank))
    total, last = weighted.select(F.sum("__w").cast("double"), F.max(rank)).first()
    upto, before = F.col("__upto"), F.col("__upto") - F.col("__w")
    return (
        summed.withColumn("hi", F.when(F.col(rank) == last, 1.0).otherwise(upto.cast("double") / total))
        .withColumn("lo", F.when(before == 0, -1.0).otherwise(before.cast("double") / total))
        .drop("__w", "__upto")
    )


def weighted_pick(probes: DataFrame, shares: DataFrame, u: str = "u") -> DataFrame:
    """The item whose interval holds each probe's ``u`` in [0, 1].

    [0, 1] is cut into as many cells as there are items. An item is repeated for
    the cells it touches, at most twice the number of items in all, so a heavy
    item is spread over many join keys and no probe meets more than the few items
    of its own cell.
    """
    cells = float(max(shares.count(), 1))
    spread = shares.withColumn(
        "__cell",
        F.explode(
            F.sequence(
                F.floor(F.greatest("lo", F.lit(0.0)) * cells).cast("bigint"), F.floor(F.col("hi") * cells).cast("bigint")
            )
        ),
    )
    located = probes.withColumn("__cell", F.floor(F.col(u) * cells).cast("bigint"))
    return (
        located.join(spread, "__cell")
        .filter((F.col(u) > F.col("lo")) & (F.col(u) <= F.col("hi")))
        .drop("__cell", "lo", "hi")
    )


# ---- nearest neighbours -------------------------------------------------

_PLACE = ["lat", "lon"]
_AXES = ["x", "y", "z"]
_CUBE = ["level", "cx", "cy", "cz"]
_COARSE = range(0, 10)  # cubes from half the globe down to 50 km
_FINE = range(10, 29)  # 25 km down to 10 cm
_FAN = 64


def _cell(coordinate: str, level: Column) -> Column:
    """Cubes of side 4/2^level over the box the unit sphere lies in."""
    return F.floor((F.col(coordinate) + 2) * F.pow(F.lit(2.0), level) / 4).cast("bigint")


def _in_cubes(places: DataFrame, levels: range) -> DataFrame:
    """Every place once per level with the cube it lies in."""
    level = F.explode(F.sequence(F.lit(levels.start), F.lit(levels.stop - 1)))
    return places.withColumn("level", level).select(
        *places.columns, "level", *[_cell(a, F.col("level")).alias(f"c{a}") for a in _AXES]
    )


def _smallest_ids(points: DataFrame, k: int) -> DataFrame:
    """The k smallest ids of every place; a crowded place is cut into parts first."""
    part = F.pmod(F.xxhash64("id"), F.lit(_FAN))
    first = Window.partitionBy(*_PLACE, "__part").orderBy("id")
    few = points.withColumn("__part", part).withColumn("__n", F.row_number().over(first)).filter(F.col("__n") <= k)
    final = Window.partitionBy(*_PLACE).orderBy("id")
    few = few.withColumn("__n", F.row_number().over(final)).filter(F.col("__n") <= k)
    return few.groupBy(*_PLACE).agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _finest_full_cube(asking: DataFrame, cubes: DataFrame, k: int, levels: range) -> DataFrame:
    """Level of the smallest cube around each asking place that holds k ids."""
    holding = cubes.groupBy(*_CUBE).agg(F.sum(F.size("ids")).alias("n"))
    enough = holding.filter((F.col("n") >= k) | (F.col("level") == 0)).select(*_CUBE)
    return (
        _in_cubes(asking.select(*_PLACE, *_AXES), levels)
        .join(enough, _CUBE)
        .groupBy(*_PLACE)
        .agg(F.max("level").alias("finest"), *[F.first(a).alias(a) for a in _AXES])
    )


def nearest_neighbours(
    towers: DataFrame,
    always: int = ALWAYS_NEIGHBOURS,
    more: int = MORE_NEIGHBOURS,
    within_km: float = MORE_WITHIN_KM,
) -> DataFrame:
    """The ``always`` nearest towers, and up to ``more`` further ones within ``within_km``.

    Exact, ties by id, without comparing all towers of a region:

    * towers at one place share one search, and a place stands in it with its
      ``k`` smallest ids (no more of them can be among anybody's neighbours);
    * places lie in nested cubes around the globe. A place takes the finest cube
      that holds ``k`` ids; all ``k`` nearest are then within the cube's diagonal
      (1.74 sides), so the 27 cubes around it one level up (two sides wide) hold
      them all. As the next finer cube holds fewer than ``k`` ids, dense regions
      use small cubes, and few places of any cube ask at its size;
    * only places with no company within a fine cube go on to the coarse ones.
      A coarse cube may hold a large share of all places, so there the candidates
      are spread over ``_FAN`` parts and the few who ask are repeated for each.
    """
    k = always + more + 1  # a place meets itself too
    points = towers.select(F.col("tower_id").alias("id"), *_PLACE)
    rad_lat, rad_lon = F.radians("lat"), F.radians("lon")
    places = _smallest_ids(points, k).select(
        *_PLACE, "ids",
        (F.cos(rad_lat) * F.cos(rad_lon)).alias("x"),
        (F.cos(rad_lat) * F.sin(rad_lon)).alias("y"),
        F.sin(rad_lat).alias("z"),
    )
    places = stored(places, "places")  # read by every step below
    fine, coarse = _in_cubes(places, _FINE), _in_cubes(places, _COARSE)
    in_company = _finest_full_cube(places, fine, k, _FINE)
    alone = places.join(in_company.select(*_PLACE), _PLACE, "left_anti")
    found = stored(in_company.unionByName(_finest_full_cube(alone, coarse, k, _COARSE)), "cubes")

    search = found.withColumn("level", F.greatest(F.col("finest") - 1, F.lit(0)))
    search = search.select(
        *[F.col(p).alias(f"q_{p}") for p in _PLACE], "level", *[_cell(a, F.col("level")).alias(f"c{a}") for a in _AXES]
    )
    for axis in _AXES:
        step = F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)]))
        search = search.withColumn("__d", step).withColumn(f"c{axis}", F.col(f"c{axis}") + F.col("__d")).drop("__d")
    candidate = [*_PLACE, "ids", *_CUBE]
    near = search.filter(F.col("level") >= _FINE.start).join(fine.select(*candidate), _CUBE)
    part = F.pmod(F.xxhash64(*_PLACE), F.lit(_FAN)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(_FAN - 1)))
    far = (
        search.filter(F.col("level") < _FINE.start)
        .withColumn("__part", parts)
        .join(coarse.select(*candidate, part.alias("__part")), [*_CUBE, "__part"])
        .drop("__part")
    )
    distance = haversine_km("q_lat", "q_lon", "lat", "lon")
    met = near.unionByName(far).select("q_lat", "q_lon", distance.alias("d"), F.explode("ids").alias("id"))
    closest = Window.partitionBy("q_lat", "q_lon").orderBy("d", "id")
    lists = (
        met.withColumn("__n", F.row_number().over(closest))
        .filter(F.col("__n") <= k)
        .groupBy(F.col("q_lat").alias("lat"), F.col("q_lon").alias("lon"))
        .agg(F.array_sort(F.collect_list(F.struct("d", "id"))).alias("near"))
    )
    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("tower_id")), 1, always + more)
    return (
        spread_join(towers.select("tower_id", *_PLACE), lists, _PLACE)
        .select("tower_id", F.posexplode(others).alias("pos", "n"))
        .select(
            "tower_id",
            (F.col("pos") + 1).alias("rank"),
            F.col("n.id").alias("neighbor_id"),
            F.col("n.d").alias("distance_km"),
        )
        .filter((F.col("rank") <= always) | (F.col("distance_km") <= within_km))
    )


def city_index(towers: DataFrame) -> DataFrame:
    """Towers by city, one row each, with the size of the city's list."""
    sizes = towers.groupBy("city").agg(F.count(F.lit(1)).alias("towers_in_city"))
    return spread_join(towers.select("city", "tower_id"), sizes, ["city"])
