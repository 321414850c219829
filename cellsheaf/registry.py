"""What each data source delivers. A new source is a new row here, not a new class.

The names, codes, templates and limits below are fixed values that results depend on.
"""

from dataclasses import dataclass


@dataclass(frozen=True)
class Source:
    key: str
    cadence: str
    data_source: str
    variables: tuple[str, ...]
    basename: str
    clip_rule: str = "touched"
    every_band: tuple[str, ...] = ()
    max_cloud: float | None = None
    scale: float | None = None
    least_bytes: int = 0
    must_open: bool = False
    archive: str = ""
    record: str = ""


# Asset key of every band name a scene request may use.
BAND_ASSETS = {
    "B1": "coastal",
    "B2": "blue",
    "B3": "green",
    "B4": "red",
    "B5": "rededge1",
    "B6": "rededge2",
    "B7": "rededge3",
    "B8": "nir",
    "B8A": "nir08",
    "B9": "nir09",
    "B10": "cirrus",
    "B11": "swir16",
    "B12": "swir22",
    "AOT": "aot",
    "WVP": "wvp",
    "SCL": "scl",
    "VISUAL": "visual",
}

# Bands a datacube request gets when it names none.
S2_BANDS = ("B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B09", "B11", "B12")
S3_BANDS = (
    "B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B09", "B10", "B11", "B12", "B13", "B14", "B15", "B16",
    "B17", "B18", "B19", "B20", "B21", "FLAGS", "IWV", "CHL_OC4ME", "TSM_NN", "PAR", "KD490_M07", "A865", "T865",
    "CHL_NN", "ADG443_NN",
)

# Short name of every monthly reanalysis variable.
SHORT_NAMES = {
    "2m_temperature": "t2m",
    "surface_solar_radiation_downwards": "ssrd",
    "total_precipitation": "tp",
    "volumetric_soil_water_layer_1": "swvl1",
}

# Files of a water product besides the 21 reflectance files.
WATER_FILES = (
    "chl_nn.nc", "chl_oc4me.nc", "tsm_nn.nc", "iop_nn.nc", "w_aer.nc", "iwv.nc", "wqsf.nc", "lqsf.nc",
)

# Limits and sizes of the default requests.
MAX_CLOUD = 30.0
REFLECTANCE_SCALE = 1e-4
MIN_ARCHIVE_BYTES = 100_000_000
PATCH_METRES = 10240.0
SWATH_PIXEL_METRES = 300.0
SEARCH_RADIUS_METRES = 1500.0
METRES_PER_DEGREE = 111320.0

# Value a variable takes where the swath has no sample; every other variable gets NULL.
SWATH_FILL = {"WQSF": 0.0}

# Cadence, label, variables and output base name per source.
SOURCES = {
    s.key: s
    for s in (
        Source("era5", "monthly", "era5", tuple(SHORT_NAMES.values()), "era5_{ym}_{var}"),
        Source("modis_ndvi", "monthly", "terra", ("modis_ndvi",), "modis_ndvi_{ym}", least_bytes=-1),
        Source("spei", "monthly", "CSIC", ("spei",), "SPEI_{ym}", "centre"),
        Source("esacci_landcover", "yearly", "ESA CCI", ("landcover",), "ESACCI_LC_{y}"),
        Source("ecira", "yearly", "Uni Goettingen", ("ecira",), "ECIRA_{y}", must_open=True, archive="Total_IR.zip", record="15569388"),
        Source("sen2_aws", "daily", "S2", ("VISUAL",), "S2_{tile}_{t}_{aoi}", "centre"),
        Source("sen3_cdse", "daily", "Sen3_OLCI", ("OL_2_WFR",), "S3_{scene}_{var}", least_bytes=MIN_ARCHIVE_BYTES),
        Source("sen2_openeo", "daily", "Sentinel2-openeo", S2_BANDS, "S2_L2A_{t}", every_band=S2_BANDS, max_cloud=MAX_CLOUD, scale=REFLECTANCE_SCALE),
        Source("sen3_openeo", "daily", "Sentinel3Water-openeo", ("B08", "B04", "B03"), "S3_WATER_{t}", every_band=S3_BANDS),
    )
}

# Request templates, filled with year and month.
REQUEST_TEMPLATES = {
    "era5": "ERA5_{ym}.nc",
    "modis_ndvi": "{y}/MODIS-C061_MOD13C2_NDVI__LPDAAC__0.05deg__MONTHLY__UHAM-ICDC__{ym}__fv0.01.nc",
    "spei": "spei01.nc",
    "esacci_landcover": "ESACCI-LC-L4-LCCS-Map-300m-P1Y-{y}-v2.0.7.tif",
    "ecira": "Total_IR.zip",
    "sen3_cdse": "{name}.zip",
}

# Fixed value: where a product is fetched from, filled with its id.
PRODUCT_ADDRESS = "https://download.dataspace.copernicus.eu/odata/v1/Products({id})/$value"

# Texts of failed rows.
NOT_A_POLYGON = "polygon must be a GeoJSON geometry of type Polygon or MultiPolygon in EPSG:4326"
FILE_MISSING = "File missing from download stream"
FILE_INVALID = "Corrupted or unreadable GeoTIFF"
NO_OVERLAP = "Input shapes do not overlap raster."
ARCHIVE_UNUSABLE = "Archive is absent or not a valid ZIP"
