"""MGRS grid ids as plain Column expressions (no Python UDF).

``mgrs(lat, lon, p)`` returns the Military Grid Reference System id of a
WGS84 point: two-digit zone, latitude band, two 100 km square letters, then
``p`` easting digits and ``p`` northing digits (p=3: 100 m cells, p=2: 1 km,
p=1: 10 km). Digits are truncated, so a coarser id is a prefix of each axis of
a finer one and ``coarsen`` can derive it from the string alone.

Beyond latitudes -80 and 84 the id is that of the polar grid: a letter (A and B in
the south, Y and Z in the north, west and east of the 0-180 meridian), two 100 km
square letters and the digits, from the polar stereographic projection.

The transverse Mercator projection uses the Krueger series to fourth order in
the third flattening n (Karney 2011, "Transverse Mercator with an accuracy of a
few nanometers"; Snyder, USGS PP 1395). The whole computation is built-in math
functions, so it stays inside whole-stage codegen and Catalyst's common
subexpression elimination evaluates the shared terms once per row.

Points outside latitudes [-90, 90] or longitudes [-180, 180], NULL or NaN give
NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: WGS84 ellipsoid, UTM scale, MGRS lettering -------------
SEMI_MAJOR_AXIS = 6378137.0
FLATTENING = 1 / 298.257223563
UTM_SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0
LAT_BANDS = "CDEFGHJKLMNPQRSTUVWXX"  # 8 degree bands from -80; X also covers 80-84
COLUMN_LETTERS = ("ABCDEFGH", "JKLMNPQR", "STUVWXYZ")  # by (zone - 1) % 3
ROW_LETTERS_ODD = "ABCDEFGHJKLMNPQRSTUV"  # odd zones
ROW_LETTERS_EVEN = "FGHJKLMNPQRSTUVABCDE"  # even zones
# polar grid (UPS): scale at the pole, the pole's easting and northing, and the
# square letters: columns west of the pole from 800 km, east of it from 2000 km, rows
# from 800 km in the south and from 1300 km in the north
UPS_SCALE = 0.994
UPS_POLE = 2000000.0
UPS_WEST_COLUMNS = "JKLPQRSTUXYZ"
UPS_EAST_COLUMNS = "ABCFGHJKLPQR"
UPS_ROWS = "ABCDEFGHJKLMNPQRSTUVWXYZ"
UPS_FIRST_WEST = 800000.0
UPS_FIRST_ROW_SOUTH = 800000.0
UPS_FIRST_ROW_NORTH = 1300000.0
DEG = math.pi / 180.0
# ---------------------------------------------------------------------------

_n = FLATTENING / (2 - FLATTENING)
_RECTIFYING_RADIUS = SEMI_MAJOR_AXIS / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
ECC = math.sqrt(FLATTENING * (2 - FLATTENING))
K0A = UTM_SCALE * _RECTIFYING_RADIUS
# metres from the pole for each unit of exp(-isometric latitude)
UPS_RADIUS = (2 * SEMI_MAJOR_AXIS * UPS_SCALE
              / math.sqrt((1 + ECC) ** (1 + ECC) * (1 - ECC) ** (1 - ECC)))
ALPHA = (
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16 + 41 * _n**4 / 180,
    13 * _n**2 / 48 - 3 * _n**3 / 5 + 557 * _n**4 / 1440,
    61 * _n**3 / 240 - 103 * _n**4 / 140,
    49561 * _n**4 / 161280,
)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def utm_zone(lat: Column, lon: Column) -> Column:
    """UTM zone number with the Norway and Svalbard exceptions (bigint).

    NULL out of range (NaN and infinities too), before any arithmetic that could
    overflow; all that follows from the zone is NULL then.
    """
    base = F.floor((lon + 180.0) / 6.0) + 1
    return (
        F.when(~lat.between(-80.0, 84.0) | ~lon.between(-180.0, 180.0), F.lit(None))
        .when((lat >= 56.0) & (lat < 64.0) & (lon >= 3.0) & (lon < 12.0), F.lit(32))
        .when((lat >= 72.0) & (lon >= 0.0) & (lon < 9.0), F.lit(31))
        .when((lat >= 72.0) & (lon >= 9.0) & (lon < 21.0), F.lit(33))
        .when((lat >= 72.0) & (lon >= 21.0) & (lon < 33.0), F.lit(35))
        .when((lat >= 72.0) & (lon >= 33.0) & (lon < 42.0), F.lit(37))
        .otherwise(base)
        .cast("bigint")
    )


def utm_easting_northing(lat: Column, lon: Column, zone: Column) -> tuple[Column, Column]:
    """UTM easting and northing in metres (doubles) for a zone."""
    sin_phi = F.sin(lat * DEG)
    lam = (lon - (zone * 6 - 183)) * DEG
    t = F.sinh(F.atanh(sin_phi) - F.atanh(sin_phi * ECC) * ECC)
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(t * t + 1.0))
    e_sum = eta
    n_sum = xi
    for j, a in enumerate(ALPHA, start=1):
        e_sum = e_sum + F.cos(xi * (2.0 * j)) * F.sinh(eta * (2.0 * j)) * a
        n_sum = n_sum + F.sin(xi * (2.0 * j)) * F.cosh(eta * (2.0 * j)) * a
    easting = e_sum * K0A + FALSE_EASTING
    northing = n_sum * K0A + F.when(lat < 0.0, FALSE_NORTHING_SOUTH).otherwise(0.0)
    return easting, northing


def _digits(metres: Column, precision: int) -> Column:
    within = F.floor(metres) % 100000
    return F.lpad(F.floor(within / 10 ** (5 - precision)).cast("string"), precision, "0")


def _square_id(lat: Column, lon: Column, zone: Column, easting: Column,
               northing: Column) -> Column:
    """Zone, band and 100 km square letters; NULL where the id is undefined."""
    band = F.substring(F.lit(LAT_BANDS), (F.floor((lat + 80.0) / 8.0) + 1).cast("int"), 1)
    col_set = (
        F.when(zone % 3 == 1, F.lit(COLUMN_LETTERS[0]))
        .when(zone % 3 == 2, F.lit(COLUMN_LETTERS[1]))
        .otherwise(F.lit(COLUMN_LETTERS[2]))
    )
    col_idx = F.floor(easting / 100000.0)
    row_set = F.when(zone % 2 == 1, F.lit(ROW_LETTERS_ODD)).otherwise(F.lit(ROW_LETTERS_EVEN))
    row_idx = F.floor(northing / 100000.0) % 20 + 1
    square = F.concat(
        F.substr(col_set, col_idx.cast("int"), F.lit(1)),
        F.substr(row_set, row_idx.cast("int"), F.lit(1)),
    )
    valid = lat.between(-80.0, 84.0) & lon.between(-180.0, 180.0) & col_idx.between(1, 8)
    return F.when(valid, F.concat(F.lpad(zone.cast("string"), 2, "0"), band, square))


def _polar(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """(polar?, easting, northing) on the polar stereographic grid."""
    inside = ((lat > 84.0) & (lat <= 90.0)) | ((lat < -80.0) & (lat >= -90.0))
    radius = (F.tan((90.0 - F.abs(lat)) * (DEG / 2))
              * F.exp(F.atanh(F.sin(F.abs(lat) * DEG) * ECC) * ECC) * UPS_RADIUS)
    # the 0-180 meridian is exactly the pole's easting, and 90 degrees its northing
    sin = F.when(lon.isin(0.0, -180.0), 0.0).otherwise(F.sin(lon * DEG))
    cos = F.when(F.abs(lon) == 90.0, 0.0).otherwise(F.cos(lon * DEG))
    return (inside & lon.between(-180.0, 180.0), radius * sin + UPS_POLE,
            F.lit(UPS_POLE) - radius * F.sign(lat) * cos)


def _polar_square(lat: Column, easting: Column, northing: Column) -> Column:
    """Polar letter and 100 km square letters."""
    east, north = easting >= UPS_POLE, lat > 0.0
    letter = F.when(north, F.when(east, "Z").otherwise("Y")).otherwise(
        F.when(east, "B").otherwise("A"))

    def nth(letters: str, metres: Column) -> Column:
        return F.substr(F.lit(letters), (F.floor(metres / 100000.0) + 1).cast("int"), F.lit(1))

    column = F.when(east, nth(UPS_EAST_COLUMNS, easting - UPS_POLE)).otherwise(
        nth(UPS_WEST_COLUMNS, easting - UPS_FIRST_WEST))
    first = F.when(north, UPS_FIRST_ROW_NORTH).otherwise(UPS_FIRST_ROW_SOUTH)
    return F.concat(letter, column, nth(UPS_ROWS, northing - first))


def _grid_string(lat: Column, lon: Column, zone: Column, easting: Column,
                 northing: Column, precision: int) -> Column:
    def spelt(prefix: Column, e: Column, n: Column) -> Column:
        if not precision:
            return prefix
        return F.concat(prefix, _digits(e, precision), _digits(n, precision))

    polar, e, n = _polar(lat, lon)
    return F.when(polar, spelt(_polar_square(lat, e, n), e, n)).otherwise(
        spelt(_square_id(lat, lon, zone, easting, northing), easting, northing))


def _check(precision: int) -> None:
    if not 0 <= precision <= 5:
        raise ValueError("precision must be between 0 and 5")


def _inputs(lat, lon) -> tuple[Column, Column]:
    lat = _c(lat).try_cast("double")
    lon_raw = _c(lon).try_cast("double")
    return lat, F.when(lon_raw == 180.0, F.lit(-180.0)).otherwise(lon_raw)


def located(lat, lon) -> Column:
    """True where ``mgrs`` gives an id: both coordinates numeric and in range.

    Filter on this rather than on ``gridid IS NOT NULL``: the predicate is
    cheap, reaches the scan, and does not drag the projection into a filter.
    """
    lat, lon = _c(lat).try_cast("double"), _c(lon).try_cast("double")
    return F.coalesce(lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), F.lit(False))


def mgrs(lat, lon, precision: int = 3) -> Column:
    """MGRS id of (lat, lon) with ``precision`` digits per axis (0-5), as one Column.

    ``lat``/``lon`` may be Columns or column names, numeric or text; text is
    read with ``try_cast`` so bad values give NULL instead of failing the job.
    The single expression repeats its shared terms, which makes analysis slow;
    ``with_mgrs`` is the form for DataFrames and for several precisions.
    """
    _check(precision)
    lat, lon = _inputs(lat, lon)
    zone = utm_zone(lat, lon)
    easting, northing = utm_easting_northing(lat, lon, zone)
    return _grid_string(lat, lon, zone, easting, northing, precision)


def _d(x: float) -> str:
    """Exact Spark SQL double literal."""
    return f"({float(x)!r}D)"


def _zone_sql(lat: str, lon: str) -> str:
    return (f"CAST(CASE WHEN NOT {lat} BETWEEN -80.0D AND 84.0D "
            f"OR NOT {lon} BETWEEN -180.0D AND 180.0D THEN NULL WHEN {lat} >= 56.0D AND {lat} < 64.0D AND "
            f"{lon} >= 3.0D AND {lon} < 12.0D THEN 32 WHEN {lat} >= 72.0D AND {lon} >= 0.0D AND {lon} < 9.0D THEN 31 "
            f"WHEN {lat} >= 72.0D AND {lon} >= 9.0D AND {lon} < 21.0D THEN 33 "
            f"WHEN {lat} >= 72.0D AND {lon} >= 21.0D AND {lon} < 33.0D THEN 35 "
            f"WHEN {lat} >= 72.0D AND {lon} >= 33.0D AND {lon} < 42.0D THEN 37 "
            f"ELSE floor(({lon} + 180.0D) / 6.0D) + 1 END AS BIGINT)")


def _square_sql(lat: str, lon: str, zone: str, e: str, n: str) -> str:
    col_idx = f"floor({e} / 100000.0D)"
    band = f"substring('{LAT_BANDS}', CAST(floor(({lat} + 80.0D) / 8.0D) + 1 AS INT), 1)"
    col_set = (f"CASE WHEN {zone} % 3 = 1 THEN '{COLUMN_LETTERS[0]}' WHEN {zone} % 3 = 2 "
               f"THEN '{COLUMN_LETTERS[1]}' ELSE '{COLUMN_LETTERS[2]}' END")
    row_set = f"CASE WHEN {zone} % 2 = 1 THEN '{ROW_LETTERS_ODD}' ELSE '{ROW_LETTERS_EVEN}' END"
    row_idx = f"floor({n} / 100000.0D) % 20 + 1"
    valid = (f"{lat} BETWEEN -80.0D AND 84.0D AND {lon} BETWEEN -180.0D AND 180.0D "
             f"AND {col_idx} BETWEEN 1 AND 8")
    return (f"CASE WHEN {valid} THEN concat(lpad(CAST({zone} AS STRING), 2, '0'), {band}, "
            f"substring({col_set}, CAST({col_idx} AS INT), 1), "
            f"substring({row_set}, CAST({row_idx} AS INT), 1)) END")


def _polar_radius_sql(lat: str, lon: str) -> str:
    """Metres from the pole on the polar grid; NULL outside the polar areas."""
    return (f"CASE WHEN ({lat} > 84.0D AND {lat} <= 90.0D OR {lat} < -80.0D AND {lat} >= -90.0D) "
            f"AND {lon} BETWEEN -180.0D AND 180.0D THEN "
            f"tan((90.0D - abs({lat})) * {_d(DEG / 2)}) "
            f"* exp(atanh(sin(abs({lat}) * {_d(DEG)}) * {_d(ECC)}) * {_d(ECC)}) * {_d(UPS_RADIUS)} END")


def _polar_easting_sql(lon: str, radius: str) -> str:
    # the 0-180 meridian is exactly the pole's easting
    return (f"{_d(UPS_POLE)} + {radius} * CASE WHEN {lon} IN (0.0D, -180.0D) THEN 0.0D "
            f"ELSE sin({lon} * {_d(DEG)}) END")


def _polar_northing_sql(lat: str, lon: str, radius: str) -> str:
    return (f"{_d(UPS_POLE)} - {radius} * sign({lat}) * CASE WHEN abs({lon}) = 90.0D THEN 0.0D "
            f"ELSE cos({lon} * {_d(DEG)}) END")


def _polar_square_sql(lat: str, e: str, n: str) -> str:
    east = f"{e} >= {_d(UPS_POLE)}"
    first = (f"CASE WHEN {lat} > 0.0D THEN {_d(UPS_FIRST_ROW_NORTH)} "
             f"ELSE {_d(UPS_FIRST_ROW_SOUTH)} END")
    letter = (f"CASE WHEN {lat} > 0.0D THEN if({east}, 'Z', 'Y') ELSE if({east}, 'B', 'A') END")
    column = (f"if({east}, substring('{UPS_EAST_COLUMNS}', "
              f"CAST(floor(({e} - {_d(UPS_POLE)}) / 100000.0D) + 1 AS INT), 1), "
              f"substring('{UPS_WEST_COLUMNS}', "
              f"CAST(floor(({e} - {_d(UPS_FIRST_WEST)}) / 100000.0D) + 1 AS INT), 1))")
    row = (f"substring('{UPS_ROWS}', "
           f"CAST(floor(({n} - ({first})) / 100000.0D) + 1 AS INT), 1)")
    return f"concat({letter}, {column}, {row})"


def with_mgrs(df: DataFrame, lat, lon, precisions: dict[str, int] | None = None) -> DataFrame:
    """Add MGRS id columns ``{name: precision}`` (default ``{"gridid": 3}``).

    The projection runs in stages (inputs, zone, the projection's shared
    terms, easting/northing, the zone/band/square or polar prefix and the metres
    within the square, then one short string per precision). Each stage refers
    to the one before by name, so the plan stays small and every term is
    evaluated once per row; Catalyst keeps the stages apart because their
    terms are reused. Stages are written as SQL expressions (``selectExpr``):
    the same Catalyst expressions as the Column form, built with one call to
    the JVM per column instead of one per function.
    """
    precisions = precisions or {"gridid": 3}
    for p in precisions.values():
        _check(p)
    lat_c, lon_c = _inputs(lat, lon)
    names = ("lat", "lon", "zone", "sin", "lam", "t", "xi", "eta", "rho", "e", "n", "sq", "e5",
             "n5")
    t = {k: f"_mgrs_{k}" for k in names}
    out = df.select("*", lat_c.alias(t["lat"]), lon_c.alias(t["lon"]))
    out = out.selectExpr("*", f"{_zone_sql(t['lat'], t['lon'])} AS {t['zone']}")
    out = out.selectExpr(
        "*", f"sin({t['lat']} * {_d(DEG)}) AS {t['sin']}",
        f"({t['lon']} - ({t['zone']} * 6 - 183)) * {_d(DEG)} AS {t['lam']}",
        f"{_polar_radius_sql(t['lat'], t['lon'])} AS {t['rho']}")
    out = out.selectExpr(
        "*", f"sinh(atanh({t['sin']}) - atanh({t['sin']} * {_d(ECC)}) * {_d(ECC)}) AS {t['t']}")
    out = out.selectExpr(
        "*", f"atan2({t['t']}, cos({t['lam']})) AS {t['xi']}",
        f"atanh(sin({t['lam']}) / sqrt({t['t']} * {t['t']} + 1.0D)) AS {t['eta']}")
    e_sum, n_sum = t["eta"], t["xi"]
    for j, a in enumerate(ALPHA, start=1):
        k = _d(2.0 * j)
        e_sum = f"({e_sum} + cos({t['xi']} * {k}) * sinh({t['eta']} * {k}) * {_d(a)})"
        n_sum = f"({n_sum} + sin({t['xi']} * {k}) * cosh({t['eta']} * {k}) * {_d(a)})"
    utm = f"CASE WHEN {t['rho']} IS NULL THEN"
    out = out.selectExpr(
        "*", f"{utm} {e_sum} * {_d(K0A)} + {_d(FALSE_EASTING)} "
        f"ELSE {_polar_easting_sql(t['lon'], t['rho'])} END AS {t['e']}",
        f"{utm} {n_sum} * {_d(K0A)} + CASE WHEN {t['lat']} < 0.0D THEN {_d(FALSE_NORTHING_SOUTH)} "
        f"ELSE 0.0D END ELSE {_polar_northing_sql(t['lat'], t['lon'], t['rho'])} END AS {t['n']}")
    out = out.selectExpr(
        "*", f"{utm} {_square_sql(t['lat'], t['lon'], t['zone'], t['e'], t['n'])} "
        f"ELSE {_polar_square_sql(t['lat'], t['e'], t['n'])} END AS {t['sq']}",
        f"floor({t['e']}) % 100000 AS {t['e5']}", f"floor({t['n']}) % 100000 AS {t['n5']}")

    def digits(c: str, p: int) -> str:
        return f"lpad(CAST(floor({c} / {10 ** (5 - p)}) AS STRING), {p}, '0')"

    out = out.selectExpr("*", *[
        (f"concat({t['sq']}, {digits(t['e5'], p)}, {digits(t['n5'], p)})" if p else t["sq"])
        + f" AS `{name}`" for name, p in precisions.items()])
    return out.drop(*t.values())


def coarsen(gridid, precision: int, from_precision: int = 3) -> Column:
    """Shorten an MGRS id of ``from_precision`` digits to ``precision`` digits.

    Exact because digits are truncated: the coarse cell of a point is the fine
    cell's id with the trailing digits of each axis dropped.
    """
    if not 0 <= precision <= from_precision <= 5:
        raise ValueError("need 0 <= precision <= from_precision <= 5")
    g = _c(gridid)
    if precision == from_precision:
        return g
    # all but the digits: five characters, or three on the polar grid
    prefix = F.length(g) - 2 * from_precision
    return F.concat(
        F.substr(g, F.lit(1), prefix + precision),
        F.substr(g, prefix + 1 + from_precision, F.lit(precision)),
    )
