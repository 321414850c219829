"""Calendar queries."""

from pyspark.sql import functions as F

from cellsheaf.functions import instants
from cellsheaf.operators import cells as cell_ops
from cellsheaf.operators import slots
from workloads.case import case
from workloads.fixtures import view

ERA5_VARS = ["t2m", "ssrd", "tp", "swvl1"]


@case(
    "t1_month_slots",
    """
SELECT request_id, cast(unnest(generate_series(date_trunc('month', start), date_trunc('month', "end"), INTERVAL 1 MONTH)) AS timestamp) AS slot_start
FROM {fx_frame}""",
)
def month_slots(spark, sf):
    return slots.month_slots(view(spark, sf, "fx_frame")).select("request_id", "slot_start")


@case(
    "t2_year_slots",
    """
SELECT request_id, unnest(range(year(start), year("end") + 1)) AS year FROM {fx_frame}""",
)
def year_slots(spark, sf):
    return slots.year_slots(view(spark, sf, "fx_frame")).select("request_id", F.col("year").cast("long").alias("year"))


@case(
    "t3_slot_of",
    """
WITH s AS (SELECT scene_id, acq_start,
       CASE scene_id % 5 WHEN 0 THEN 'era5' WHEN 1 THEN 'ecira' WHEN 2 THEN 'sen2_aws' WHEN 3 THEN 'spei' ELSE 'sen3_openeo' END AS source FROM {fx_scene})
SELECT scene_id, source, cast(CASE WHEN source IN ('era5','spei') THEN date_trunc('month', acq_start)
       WHEN source = 'ecira' THEN date_trunc('year', acq_start) ELSE date_trunc('day', acq_start) END AS timestamp) AS slot,
       cast(date_trunc('month', acq_start) AS timestamp) AS month_stamp, cast(date_trunc('year', acq_start) AS timestamp) AS year_stamp FROM s""",
)
def slot_of(spark, sf):
    names = ["era5", "ecira", "sen2_aws", "spei", "sen3_openeo"]
    source = F.get(F.array(*[F.lit(n) for n in names]), (F.col("scene_id") % 5).cast("int"))
    df = view(spark, sf, "fx_scene").select("scene_id", "acq_start", source.alias("source"))
    year, month = F.year("acq_start"), F.month("acq_start")
    stamps = (instants.slot_stamp(year, month).alias("month_stamp"), instants.slot_stamp(year).alias("year_stamp"))
    return slots.with_slot(df, "source", "acq_start").select("scene_id", "source", "slot", *stamps)


@case(
    "t4_in_days",
    "SELECT scene_id, acq_start FROM {fx_scene} WHERE cast(acq_start AS date) BETWEEN DATE '1996-03-05' AND DATE '1997-08-20'",
)
def in_days(spark, sf):
    df = view(spark, sf, "fx_scene")
    keep = instants.in_days(F.col("acq_start"), instants.ntz("1996-03-05 13:00:00"), instants.ntz("1997-08-20 01:00:00"))
    return df.where(keep).select("scene_id", "acq_start")


@case(
    "t5_contained",
    """
SELECT scene_id, acq_start, acq_end FROM {fx_scene}
WHERE acq_start >= TIMESTAMP '1996-03-05 13:00:00' AND acq_end <= TIMESTAMP '1997-08-20 01:00:00'""",
)
def contained(spark, sf):
    keep = instants.contained(
        F.col("acq_start"), F.col("acq_end"), instants.ntz("1996-03-05 13:00:00"), instants.ntz("1997-08-20 01:00:00")
    )
    return view(spark, sf, "fx_scene").where(keep).select("scene_id", "acq_start", "acq_end")


@case(
    "t6_in_extent",
    "SELECT scene_id FROM {fx_scene} WHERE acq_start >= TIMESTAMP '1996-03-05' AND acq_start < TIMESTAMP '1997-08-20'",
)
def in_extent(spark, sf):
    keep = instants.in_extent(F.col("acq_start"), instants.ntz("1996-03-05"), instants.ntz("1997-08-20"))
    return view(spark, sf, "fx_scene").where(keep).select("scene_id")


ORDER = ["t", "l_orderkey", "l_linenumber", "l_extendedprice", "v"]


@case(
    "t7_first_step_in_month",
    """
WITH m AS (SELECT *, date_trunc('month', t) AS slot FROM {fx_cube}),
f AS (SELECT *, min(t) OVER (PARTITION BY source, var, slot) AS t0 FROM m)
SELECT source, var, cast(slot AS timestamp) AS slot, t, r, c, v FROM (
  SELECT *, row_number() OVER (PARTITION BY source, var, slot, r, c ORDER BY t, l_orderkey, l_linenumber, l_extendedprice, v) AS k
  FROM f WHERE t = t0) WHERE k = 1""",
)
def first_step_in_month(spark, sf):
    df = slots.first_step_in_month(view(spark, sf, "fx_cube"), ["source", "var"])
    return slots.one_value_per_pixel(df, ["source", "var", "slot", "t", "r", "c"], ORDER)


@case(
    "t8_first_step",
    """
WITH f AS (SELECT *, min(t) OVER (PARTITION BY source, var) AS t0 FROM {fx_cube})
SELECT source, var, t, r, c, v FROM (
  SELECT *, row_number() OVER (PARTITION BY source, var, r, c ORDER BY t, l_orderkey, l_linenumber, l_extendedprice, v) AS k
  FROM f WHERE t = t0) WHERE k = 1""",
)
def first_step(spark, sf):
    df = slots.first_step(view(spark, sf, "fx_cube"), ["source", "var"])
    return slots.one_value_per_pixel(df, ["source", "var", "t", "r", "c"], ORDER)


@case(
    "t9_parse_iso",
    """
SELECT scene_id, CASE WHEN scene_id % 4 = 3 THEN NULL WHEN scene_id % 4 = 2 THEN acq_start - INTERVAL 2 HOUR
       ELSE acq_start END AS parsed FROM {fx_scene}""",
)
def parse_iso(spark, sf):
    iso = F.translate(F.substring(F.col("acq_start").cast("string"), 1, 19), " ", "T")
    text = (
        F.when(F.col("scene_id") % 4 == 0, F.concat(iso, F.lit(".000Z")))
        .when(F.col("scene_id") % 4 == 1, iso)
        .when(F.col("scene_id") % 4 == 2, F.concat(iso, F.lit("+02:00")))
        .otherwise(F.lit("not a time"))
    )
    return view(spark, sf, "fx_scene").select("scene_id", instants.parse_iso(text).alias("parsed"))


@case(
    "t11_completeness",
    """
WITH slot AS (SELECT DISTINCT date_trunc('month', start) AS slot FROM {fx_frame}
              UNION SELECT date_trunc('month', start) + INTERVAL 84 MONTH FROM {fx_frame}),
v AS (SELECT * FROM (VALUES ('t2m','2m_temperature'),('ssrd','surface_solar_radiation_downwards'),('tp','total_precipitation'),('swvl1','volumetric_soil_water_layer_1')) AS v(var, long)),
have AS (SELECT DISTINCT date_trunc('month', t) AS slot, var AS long FROM {fx_cube})
SELECT cast(s.slot AS timestamp) AS slot, v.var, h.long IS NOT NULL AS present,
       CASE WHEN h.long IS NULL THEN concat('Variable ''', v.var, ''' missing in downloaded file.') END AS error
FROM slot s CROSS JOIN v LEFT JOIN have h ON h.slot = s.slot AND h.long = v.long""",
)
def completeness(spark, sf):
    start = view(spark, sf, "fx_frame").select(instants.month_start(F.col("start")).alias("slot")).distinct()
    later = start.select(F.add_months("slot", 84).cast("timestamp_ntz").alias("slot"))
    expected = slots.expected_outputs(start.union(later).distinct(), ERA5_VARS)
    cells = cell_ops.rename_vars(slots.with_slot(view(spark, sf, "fx_cube")))
    return slots.completeness(expected, cells, ["slot", "var"])


@case(
    "p2_expected_outputs",
    """
WITH s AS (SELECT request_id, unnest(generate_series(date_trunc('month', start), date_trunc('month', "end"), INTERVAL 1 MONTH)) AS slot FROM {fx_frame})
SELECT request_id, var, concat('era5_', strftime(slot, '%Y%m'), '_', var, '.tif') AS path
FROM s CROSS JOIN (VALUES ('t2m'),('ssrd'),('tp'),('swvl1')) AS v(var)""",
)
def expected_outputs(spark, sf):
    months = slots.month_slots(view(spark, sf, "fx_frame"))
    out = slots.expected_outputs(
        months, ERA5_VARS, slots.output_path("era5", F.col("slot_start"), F.col("var"))
    )
    return out.select("request_id", "var", "path")


@case(
    "p5_plan_requests",
    """
WITH y AS (SELECT request_id, unnest(range(year(start), year("end") + 1)) AS y FROM {fx_frame}),
m AS (SELECT request_id, unnest(generate_series(date_trunc('month', start), date_trunc('month', "end"), INTERVAL 1 MONTH)) AS m FROM {fx_frame})
SELECT request_id, 'esacci_landcover' AS source, concat('ESACCI-LC-L4-LCCS-Map-300m-P1Y-', y, '-v2.0.7.tif') AS request FROM y
UNION ALL SELECT request_id, 'era5', concat('ERA5_', strftime(m, '%Y%m'), '.nc') FROM m
UNION ALL SELECT request_id, 'modis_ndvi', concat(strftime(m, '%Y'), '/MODIS-C061_MOD13C2_NDVI__LPDAAC__0.05deg__MONTHLY__UHAM-ICDC__', strftime(m, '%Y%m'), '__fv0.01.nc') FROM m""",
)
def plan_requests(spark, sf):
    frame = view(spark, sf, "fx_frame")
    years, months = slots.year_slots(frame), slots.month_slots(frame)
    parts = [
        slots.plan_requests(s, key).select("request_id", F.lit(key).alias("source"), "request")
        for s, key in ((years, "esacci_landcover"), (months, "era5"), (months, "modis_ndvi"))
    ]
    return parts[0].union(parts[1]).union(parts[2])
