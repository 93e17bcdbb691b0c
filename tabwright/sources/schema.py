"""The patient table as it arrives: 56 nullable text columns."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the patient table, in file order.
PATIENT_COLUMNS = (
    "age sex painloc painexer relrest pncaden cp trestbps htn chol smoke cigs years fbs dm famhist "
    "restecg ekgmo ekgday ekgyr dig prop nitr pro diuretic proto thaldur thaltime met thalach "
    "thalrest tpeakbps tpeakbpd dummy trestbpd exang xhypo oldpeak slope rldv5 rldv5e ca restckm "
    "exerckm restef restwm exeref exerwm thal thalsev thalpul earlobe cmo cday cyr target"
).split()

# Fixed value: the file's header spells this column differently.
RAW_HEADER = {"ekgday": "ekgday(day"}

PATIENT_SCHEMA = T.StructType(
    [T.StructField(RAW_HEADER.get(c, c), T.StringType(), True) for c in PATIENT_COLUMNS]
)
