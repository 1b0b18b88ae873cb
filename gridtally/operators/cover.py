"""Coverage: which ids (base stations, cells, customers) serve each group.

``topn_with_others`` keeps, per group, the ``n`` ids with the most rows and
folds the rest into one ``others`` row; ``coverage`` runs it per grid cell at
several resolutions from one scan.

Plan shape, chosen so that no group -- however hot -- has to sit in one task:

1. ``pair_counts``: ``groupBy(group, id).count()``. Partial aggregation
   combines rows map-side, so a grid cell holding a third of all records
   costs one row per (cell, id) per map task in the shuffle.
2. Coarser resolutions re-aggregate these pair counts (``rollup_pairs``, or
   ``rank_resolutions`` for all levels in one pass) instead of re-reading
   raw rows.
3. The pairs are read twice. Once for the top ``n``: ``row_number() <= n``,
   which Spark plans as a map-side ``WindowGroupLimit``, so at most ``n`` rows
   per group per map task are shuffled. Once for a histogram, (group, count) ->
   number of ids, by partial aggregation: ids with ``k`` rows fold into one
   histogram row, and a group of ``r`` rows has at most about ``sqrt(2 r)``
   different counts. Totals and the sum of all rounded shares come from the
   histogram; the ``others`` row is what the top rows leave of them. No join
   or window ever holds a group's ids.

Shares are integer hundredths of a percent, rounded half up by integer division;
the ``others`` share is the sum of the per-id rounded shares, as in the original
job, but without floating-point noise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.functions.grid import coarsen, located, with_mgrs

OTHERS = "others"  # fixed value: label of the folded row

# metres -> MGRS digits per axis
RESOLUTIONS = {100: 3, 1000: 2, 10000: 1}


def pair_counts(df: DataFrame, group: str, id_col: str, count_col: str = "cnt") -> DataFrame:
    """Rows per (group, id); NULL groups and NULL ids are groups of their own."""
    return df.groupBy(group, id_col).agg(F.count(F.lit(1)).alias(count_col))


def rollup_pairs(pairs: DataFrame, group: str, new_group: Column, id_col: str,
                 count_col: str = "cnt") -> DataFrame:
    """Re-aggregate pair counts onto a coarser group (e.g. a shorter grid id)."""
    return (pairs.select(new_group.alias(group), id_col, count_col)
            .groupBy(group, id_col)
            .agg(F.sum(count_col).alias(count_col)))


def _null_default_sql(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return "''"
    if isinstance(dtype, T.BooleanType):
        return "false"
    if isinstance(dtype, T.DateType):
        return "DATE '1970-01-01'"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return f"CAST(TIMESTAMP_NTZ '1970-01-01 00:00:00' AS {dtype.simpleString()})"
    return f"CAST(0 AS {dtype.simpleString()})"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Spark limits a window's rows map-side up to this rank only
#: (spark.sql.optimizer.windowGroupLimitThreshold).
MAX_TOP = 1000


def topn_with_others(pairs: DataFrame, group, id_col: str, n: int = 10,
                     count_col: str = "cnt", others_label: str = OTHERS,
                     unique: bool = False) -> DataFrame:
    """Top ``n`` ids per group by count, plus one ``others`` row per group.

    ``pairs`` has counts per (group, id); ``group`` is a column name or a list
    of them. Repeated (group, id) rows are summed first; ``unique=True`` says
    that there are none, as after ``pair_counts``, and saves that shuffle.
    Output columns: the group columns, ``id (string), cnt bigint, pct double,
    rank int, is_other boolean``. Ties are broken by id ascending with NULL ids
    last, so results are deterministic; ``rank`` is NULL on the ``others`` row,
    and ``is_other`` tells it apart from a real id spelt like the label.
    ``n`` is at most ``MAX_TOP``: beyond it Spark would sort whole groups.

    Written as one SQL statement over the ``pairs`` DataFrame: the CTEs are
    inlined by Catalyst into the same plan the DataFrame calls would build,
    with one parse and one analysis. NULL group values are carried as
    (value, is-null) key pairs so that every step can use plain equi-joins.
    """
    if not 1 <= n <= MAX_TOP:
        raise ValueError(f"n must be between 1 and {MAX_TOP}")
    groups = [group] if isinstance(group, str) else list(group)
    i, c = _q(id_col), _q(count_col)
    label = others_label.replace("'", "''")
    if not unique:
        pairs = pairs.groupBy(*groups, id_col).agg(F.sum(count_col).alias(count_col))
    keys, key_defs, back = [], [], []
    for k, g in enumerate(groups):
        qg = _q(g)
        default = _null_default_sql(pairs.schema[g].dataType)
        key_defs.append(f"coalesce({qg}, {default}) AS _g{k}_val, {qg} IS NULL AS _g{k}_null")
        keys += [f"_g{k}_val", f"_g{k}_null"]
        back.append(f"CASE WHEN NOT _g{k}_null THEN _g{k}_val END AS {qg}")
    key_list = ", ".join(keys)

    def hund(cnt: str, total: str) -> str:
        return f"({cnt} * 20000 + {total}) div ({total} * 2)"

    sql = f"""
    WITH keyed AS (
      SELECT {", ".join(key_defs)}, CAST({i} AS STRING) AS _id, CAST({c} AS BIGINT) AS _cnt
      FROM {{pairs}}),
    histogram AS (
      SELECT {key_list}, _cnt, count(1) AS _ids FROM keyed GROUP BY {key_list}, _cnt),
    totals AS (
      SELECT {key_list}, sum(_cnt * _ids) AS _total, sum(_ids) AS _n_ids,
             collect_list(struct(_cnt, _ids)) AS _counts
      FROM histogram GROUP BY {key_list}),
    shares AS (
      SELECT {key_list}, _total, _n_ids, aggregate(_counts, 0L, (acc, x) ->
             acc + x._ids * ({hund("x._cnt", "_total")})) AS _hundredths
      FROM totals),
    ranked AS (
      SELECT {key_list}, _id, _cnt, row_number() OVER (
        PARTITION BY {key_list} ORDER BY _cnt DESC, _id ASC NULLS LAST) AS _rank
      FROM keyed),
    tops AS (
      SELECT {key_list}, collect_list(struct(_rank, _id, _cnt)) AS _top,
             sum(_cnt) AS _top_cnt
      FROM ranked WHERE _rank <= {n} GROUP BY {key_list}),
    lists AS (
      SELECT {key_list}, _total, _n_ids, _hundredths, _top_cnt,
             transform(_top, x -> struct(x._id AS id, x._cnt AS cnt,
               {hund("x._cnt", "_total")} AS hundredths, x._rank AS rank,
               false AS is_other)) AS _rows
      FROM tops JOIN shares USING ({key_list})),
    flat AS (
      SELECT {key_list}, explode(concat(_rows, CASE WHEN _n_ids > {n} THEN array(struct(
        '{label}' AS id, _total - _top_cnt AS cnt,
        _hundredths - aggregate(_rows, 0L, (acc, x) -> acc + x.hundredths) AS hundredths,
        CAST(NULL AS INT) AS rank, true AS is_other)) ELSE array() END)) AS r
      FROM lists)
    SELECT {", ".join(back)}, r.id AS {i}, r.cnt AS {c}, r.hundredths / 100.0D AS pct,
           r.rank AS rank, r.is_other AS is_other
    FROM flat
    """
    return pairs.sparkSession.sql(sql, pairs=pairs)


def grid_pairs(calls: DataFrame, id_col: str, precision: int = 3,
               keep_unlocated: bool = True, lat: str = "end_latitude",
               lon: str = "end_longitude") -> DataFrame:
    """``(gridid, <id_col>, cnt)`` at one precision: the input of every resolution.

    ``keep_unlocated=False`` drops rows without a grid id first, with a cheap
    range test on the coordinates rather than a filter on the grid id.
    """
    points = calls.select(id_col, lat, lon)
    if not keep_unlocated:
        points = points.filter(located(lat, lon))
    gridded = with_mgrs(points, lat, lon, {"gridid": precision}).select(id_col, "gridid")
    return pair_counts(gridded, "gridid", id_col)


def coverage_from_pairs(base: DataFrame, id_col: str, base_precision: int,
                        resolution: int, n: int = 10, date_td: str | None = None,
                        id_name: str = "enb") -> DataFrame:
    """Top-``n`` + others per grid cell at ``resolution`` metres from pair counts
    at ``base_precision`` (coarser resolutions re-aggregate them)."""
    p = RESOLUTIONS[resolution]
    if p > base_precision:
        raise ValueError(f"resolution {resolution} is finer than the pair counts")
    pairs = base if p == base_precision else rollup_pairs(
        base, "gridid", coarsen(F.col("gridid"), p, base_precision), id_col)
    ranked = topn_with_others(pairs, "gridid", id_col, n=n, unique=True)
    return ranked.select(
        F.lit(date_td).cast("string").alias("date_td"),
        F.col("cnt"),
        F.col(id_col).alias(id_name),
        F.col("gridid"),
        F.col("pct"),
        F.col("rank"),
        F.col("is_other"),
    )


def coverage(calls: DataFrame, id_col: str = "current_enodeb_id",
             resolutions: Sequence[int] = (100, 1000, 10000), n: int = 10,
             date_td: str | None = None, id_name: str = "enb",
             keep_unlocated: bool = True, lat: str = "end_latitude",
             lon: str = "end_longitude") -> dict[int, DataFrame]:
    """Top-``n`` + others coverage per grid cell for each resolution (metres).

    One scan: the grid id is computed once at the finest requested precision,
    pair counts are built once, and every coarser resolution re-aggregates the
    pair counts of the finest one. Returns ``{resolution: DataFrame}`` with
    columns ``date_td, cnt, <id_name>, gridid, pct, rank, is_other``.
    """
    for r in resolutions:
        if r not in RESOLUTIONS:
            raise ValueError(f"resolution {r} not in {sorted(RESOLUTIONS)}")
    finest = max(RESOLUTIONS[r] for r in resolutions)
    base = grid_pairs(calls, id_col, finest, keep_unlocated, lat, lon)
    return {r: coverage_from_pairs(base, id_col, finest, r, n, date_td, id_name)
            for r in resolutions}


def rank_resolutions(base: DataFrame, id_col: str, base_precision: int,
                     resolutions: Sequence[int], n: int = 10, date_td: str | None = None,
                     id_name: str = "enb") -> DataFrame:
    """Top-``n`` + others for every resolution in ONE ranking pass.

    Each pair count at ``base_precision`` is exploded into its (resolution,
    coarse cell) keys, re-aggregated (partial aggregation merges the coarse
    cells map-side), and ranked once with (resolution_m, gridid) as the group:
    one window and one histogram for all levels.
    """
    for r in resolutions:
        if r not in RESOLUTIONS or RESOLUTIONS[r] > base_precision:
            raise ValueError(f"resolution {r} not available from precision {base_precision}")
    levels = F.array(*[
        F.struct(F.lit(r).alias("resolution_m"),
                 coarsen(F.col("gridid"), RESOLUTIONS[r], base_precision).alias("gridid"))
        for r in resolutions])
    pairs = (base.select(F.explode(levels).alias("_lvl"), id_col, "cnt")
             .groupBy(F.col("_lvl.resolution_m").alias("resolution_m"),
                      F.col("_lvl.gridid").alias("gridid"), id_col)
             .agg(F.sum("cnt").alias("cnt")))
    ranked = topn_with_others(pairs, ["resolution_m", "gridid"], id_col, n=n, unique=True)
    return ranked.select(
        F.lit(date_td).cast("string").alias("date_td"),
        F.col("cnt"),
        F.col(id_col).alias(id_name),
        F.col("gridid"),
        F.col("pct"),
        F.col("rank"),
        F.col("is_other"),
        F.col("resolution_m"),
    )


def coverage_all(calls: DataFrame, id_col: str = "current_enodeb_id",
                 resolutions: Sequence[int] = (100, 1000, 10000), n: int = 10,
                 date_td: str | None = None, id_name: str = "enb",
                 keep_unlocated: bool = True) -> DataFrame:
    """All resolutions as one DataFrame with a ``resolution_m`` column: one
    scan and one ranking pass (``rank_resolutions``). Write it with
    ``partition_by=["resolution_m"]``."""
    for r in resolutions:
        if r not in RESOLUTIONS:
            raise ValueError(f"resolution {r} not in {sorted(RESOLUTIONS)}")
    finest = max(RESOLUTIONS[r] for r in resolutions)
    base = grid_pairs(calls, id_col, finest, keep_unlocated)
    return rank_resolutions(base, id_col, finest, resolutions, n, date_td, id_name)
