"""Declared schemas of the raw feeds and of the tables made from them."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the events feed, in order.
EVENT_COLUMNS = (
    "globaleventid sqldate monthyear event_year fractiondate actor1code actor1name actor1countrycode actor1knowngroupcode actor1ethniccode actor1religion1code "
    "actor1religion2code actor1type1code actor1type2code actor1type3code actor2code actor2name actor2countrycode actor2knowngroupcode actor2ethniccode "
    "actor2religion1code actor2religion2code actor2type1code actor2type2code actor2type3code isrootevent eventcode eventbasecode eventrootcode quadclass "
    "goldsteinscale nummentions numsources numarticles avgtone actor1geo_type actor1geo_fullname actor1geo_countrycode actor1geo_adm1code actor1geo_lat "
    "actor1geo_long actor1geo_featureid actor2geo_type actor2geo_fullname actor2geo_countrycode actor2geo_adm1code actor2geo_lat actor2geo_long "
    "actor2geo_featureid actiongeo_type actiongeo_fullname actiongeo_countrycode actiongeo_adm1code actiongeo_lat actiongeo_long actiongeo_featureid dateadded sourceurl"
).split()
_LONG = {"globaleventid", "dateadded"}
_INT = {"sqldate", "monthyear", "event_year", "isrootevent", "quadclass", "nummentions", "numsources", "numarticles", "actor1geo_type", "actor2geo_type", "actiongeo_type"}
_DOUBLE = {"fractiondate", "goldsteinscale", "avgtone", *(f"{a}_{x}" for a in ("actor1geo", "actor2geo", "actiongeo") for x in ("lat", "long"))}

# The columns of the record feed, in order; all are text.
RECORD_COLUMNS = (
    "gkgrecordid gkg_date sourcecollectionidentifier sourcecommonname documentidentifier counts v2counts themes v2themes locations v2locations persons v2persons "
    "organizations v2organizations v2tone dates gcam sharingimage relatedimages socialimageembeds socialvideoembeds quotations allnames amounts translationinfo extras"
).split()
#: Columns of the record feed that are dropped when days are consolidated.
WIDE_RECORD_COLUMNS = "gcam sharingimage relatedimages socialimageembeds socialvideoembeds extras".split()


def _kind(name: str) -> T.DataType:
    return T.LongType() if name in _LONG else T.IntegerType() if name in _INT else T.DoubleType() if name in _DOUBLE else T.StringType()


EVENTS = T.StructType([T.StructField(c, _kind(c)) for c in EVENT_COLUMNS])
RECORDS = T.StructType([T.StructField(c, T.StringType()) for c in RECORD_COLUMNS])
SCORES = T.StructType([*(T.StructField(c, T.StringType()) for c in ("admin0", "admin1", "admin2", "period")), T.StructField("cs_score", T.DoubleType())])
PAGES = T.StructType([T.StructField(c, T.StringType()) for c in ("url", "header", "body")])
