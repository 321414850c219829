"""Map projections as column arithmetic (published series, JVM-side only)."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ellipsoids (semi-major axis, inverse flattening); fixed values of the EPSG registry.
WGS84 = (6378137.0, 298.257223563)
GRS80 = (6378137.0, 298.257222101)


def tm_constants(a: float, inv_f: float) -> dict:
    """Krüger n-series constants up to the fourth order."""
    n = 1.0 / (2.0 * inv_f - 1.0)
    return {
        "radius": a / (1 + n) * (1 + n**2 / 4 + n**4 / 64),
        "k": 2 * math.sqrt(n) / (1 + n),
        "alpha": (
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
            13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
            61 * n**3 / 240 - 103 * n**4 / 140,
            49561 * n**4 / 161280,
        ),
    }


def transverse_mercator(
    lon: Column, lat: Column, lon0: Column, ellipsoid=WGS84, k0=0.9996, false_east=500000.0
) -> tuple[Column, Column]:
    """Easting and northing with the equator as northing 0."""
    c = tm_constants(*ellipsoid)
    phi, lam = F.radians(lat), F.radians(lon - lon0)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(c["k"]) * F.atanh(F.lit(c["k"]) * s))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + t * t))
    east, north = eta, xi
    for j, alpha in enumerate(c["alpha"], start=1):
        m = F.lit(2.0 * j)
        east = east + F.lit(alpha) * F.cos(m * xi) * F.sinh(m * eta)
        north = north + F.lit(alpha) * F.sin(m * xi) * F.cosh(m * eta)
    scale = F.lit(k0 * c["radius"])
    return F.lit(false_east) + scale * east, scale * north


def utm_zone(lon: Column) -> Column:
    """Zone 1..60; longitude 180 belongs to zone 60."""
    return F.least(F.floor((lon + F.lit(180.0)) / F.lit(6.0)).cast("int") + 1, F.lit(60))


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, F.lit(32600)).otherwise(F.lit(32700)) + utm_zone(lon)


def utm(lon: Column, lat: Column, epsg: Column) -> tuple[Column, Column]:
    """Coordinates in the UTM zone that the EPSG code (326zz or 327zz) names."""
    zone = epsg % 100
    x, y = transverse_mercator(lon, lat, zone.cast("double") * F.lit(6.0) - F.lit(183.0))
    return x, y + F.when(epsg >= 32700, F.lit(1e7)).otherwise(F.lit(0.0))


def laea_constants(a: float = GRS80[0], inv_f: float = GRS80[1], lat0: float = 52.0) -> dict:
    f = 1.0 / inv_f
    e = math.sqrt(2 * f - f * f)

    def q(s):
        return (1 - e * e) * (s / (1 - e * e * s * s) - 1 / (2 * e) * math.log((1 - e * s) / (1 + e * s)))

    s0 = math.sin(math.radians(lat0))
    qp = q(1.0)
    beta0 = math.asin(q(s0) / qp)
    rq = a * math.sqrt(qp / 2)
    d = a * math.cos(math.radians(lat0)) / math.sqrt(1 - e * e * s0 * s0) / (rq * math.cos(beta0))
    return {"e": e, "qp": qp, "sin_b0": math.sin(beta0), "cos_b0": math.cos(beta0), "rq": rq, "d": d}


def laea_europe(lon: Column, lat: Column) -> tuple[Column, Column]:
    """EPSG:3035: ellipsoidal Lambert azimuthal equal area, centre 52 N 10 E."""
    c = laea_constants()
    e, one = F.lit(c["e"]), F.lit(1.0)
    s = F.sin(F.radians(lat))
    q = (one - e * e) * (
        s / (one - e * e * s * s) - F.lit(1 / (2 * c["e"])) * F.log((one - e * s) / (one + e * s))
    )
    beta = F.asin(q / F.lit(c["qp"]))
    lam = F.radians(lon - F.lit(10.0))
    sb, cb = F.sin(beta), F.cos(beta)
    b = F.lit(c["rq"]) * F.sqrt(F.lit(2.0) / (one + F.lit(c["sin_b0"]) * sb + F.lit(c["cos_b0"]) * cb * F.cos(lam)))
    x = F.lit(4321000.0) + b * F.lit(c["d"]) * cb * F.sin(lam)
    y = F.lit(3210000.0) + b / F.lit(c["d"]) * (F.lit(c["cos_b0"]) * sb - F.lit(c["sin_b0"]) * cb * F.cos(lam))
    return x, y


def project(lon: Column, lat: Column, epsg: Column) -> tuple[Column, Column]:
    """Route by EPSG code: 4326 unchanged, 3035, UTM 326zz/327zz; any other code gives NULL."""
    ux, uy = utm(lon, lat, epsg)
    ex, ey = laea_europe(lon, lat)
    is_utm = epsg.between(32601, 32660) | epsg.between(32701, 32760)

    def pick(ll, e, u):
        return F.when(epsg == 4326, ll).when(epsg == 3035, e).when(is_utm, u)

    return pick(lon, ex, ux), pick(lat, ey, uy)


def project_rings(rings: Column, epsg: Column) -> Column:
    def point(p):
        x, y = project(p["x"], p["y"], epsg)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(
        rings,
        lambda g: F.struct(g["part"].alias("part"), g["hole"].alias("hole"), F.transform(g["pts"], point).alias("pts")),
    )


def metric_square(bbox: Column, size: float) -> tuple[Column, Column]:
    """EPSG code and square extent of the given side around the centre of bbox, in its UTM zone."""
    lon, lat = (bbox["minx"] + bbox["maxx"]) / F.lit(2.0), (bbox["miny"] + bbox["maxy"]) / F.lit(2.0)
    epsg = utm_epsg(lon, lat)
    x, y = utm(lon, lat, epsg)
    half = F.lit(size / 2.0)
    extent = F.struct(
        (x - half).alias("west"), (y - half).alias("south"), (x + half).alias("east"), (y + half).alias("north")
    )
    return epsg, extent
