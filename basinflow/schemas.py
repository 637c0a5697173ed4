"""Explicit schemas of the data model."""

from pyspark.sql import types as T

TEXT, INT, LONG, FLOAT, DOUBLE = (
    T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
)
TIME = T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CHUNKS = _struct(var=TEXT, time=TIME, y0=INT, x0=INT, ny=INT, nx=INT, data=T.ArrayType(FLOAT))
CELLS = _struct(var=TEXT, time=TIME, j=INT, i=INT, value=FLOAT)
GRID_CELLS = _struct(grid_id=TEXT, j=INT, i=INT, x=DOUBLE, y=DOUBLE, lon=DOUBLE, lat=DOUBLE)
ATTRS = _struct(dataset=TEXT, variable=TEXT, name=TEXT, type=TEXT, value=T.ArrayType(TEXT))
POLYGONS = _struct(poly_id=TEXT, part=INT, ring=INT, seq=INT, x=DOUBLE, y=DOUBLE)
WEIGHTS = _struct(i_index=INT, j_index=INT, IDmask=LONG, weight=DOUBLE, regridweight=DOUBLE)
POLYS = _struct(polyid=LONG, overlaps=INT)
LINKS = _struct(
    link=LONG, to=LONG, lon=DOUBLE, lat=DOUBLE, gages=TEXT, order=INT, ascendingIndex=INT,
    NHDWaterbodyComID=LONG, ind=LONG,
)
BUCKETS = _struct(ComID=LONG, Basin=INT, ind=LONG)
LAKES = _struct(lake_id=LONG, ascendingIndex=INT)
LAKE_TYPES = _struct(LINKID=LONG, TYPEL=INT)
STATIONS = _struct(
    stationId=TEXT, R=DOUBLE, G=DOUBLE, tau=DOUBLE, qThresh=T.ArrayType(DOUBLE),
    expCoeff=T.ArrayType(T.ArrayType(DOUBLE)),
)
MANIFEST = _struct(path=TEXT, year=INT)
WINDOWS = _struct(window_id=TEXT, start=TIME, end=TIME)
