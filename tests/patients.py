"""A dirty patient table: 1,000 patients and 5 junk rows, made from hashes of a row number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.sources.schema import PATIENT_COLUMNS, PATIENT_SCHEMA

SHARE = {"age": 0.01, "sex": 0.01, "cp": 0.03, "slope": 0.03, "restecg": 0.03, "ca": 0.6, "thal": 0.5, "smoke": 0.7}
SHARE |= dict.fromkeys("ekgmo ekgday ekgyr cmo cday cyr".split(), 0.02)
SPARSE = "relrest pncaden cigs years famhist proto restckm exerckm restef restwm exeref exerwm thalsev thalpul".split()
SPREAD = {  # mean and half width of roughly normal columns
    "chol": (240, 90), "thaldur": (9, 5), "thalach": (140, 40), "thalrest": (75, 25), "tpeakbps": (170, 50),
    "tpeakbpd": (88, 25), "dummy": (130, 40), "trestbpd": (84, 20), "trestbps": (130, 45),
}
CHOICES = {"cp": 4, "slope": 3, "restecg": 3, "ekgmo": 12, "ekgday": 31, "ekgyr": 6, "cmo": 12, "cday": 31, "cyr": 6}


def _draw(c: str, what: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(hash_seed(c, what)), "i"), F.lit(1_000_003)) / 1_000_003


def hash_seed(c: str, what: str) -> int:
    return 1000 * (1 + PATIENT_COLUMNS.index(c)) + {"value": 0, "gap": 1, "far": 2, "b": 3}[what]


def _value(c: str) -> Column:
    u = _draw(c, "value")
    if c == "age":
        return F.floor(28 + u * 53)
    if c == "oldpeak":
        return F.round(u * 7 - 1, 1)
    if c in SPREAD:
        mean, half = SPREAD[c]
        bell = F.round(mean + (u + _draw(c, "b") - 1) * half, 1)
        return F.when(_draw(c, "far") < 0.02, bell + half * 6).otherwise(bell)
    if c in CHOICES:
        return F.floor(u * CHOICES[c]) + 1
    if c in ("fbs", "prop", "nitr", "pro", "diuretic"):
        return F.when(_draw(c, "far") < 0.02, 22).otherwise(F.floor(u * 2))
    return F.floor(u * 2)


def patients(spark: SparkSession, n: int = 1000) -> DataFrame:
    """All-text patient rows with three ways of missing."""
    ids = spark.range(n).select(F.col("id").alias("i"))
    risk = (_value("age") - 28) / 53 + F.greatest(_value("oldpeak"), F.lit(0)) / 6 + _draw("target", "value")
    cols = []
    for c, field in zip(PATIENT_COLUMNS, PATIENT_SCHEMA):
        share = SHARE.get(c, 0.4 if c in SPARSE else 0.05)
        if c == "target":
            text = F.when(risk > 1.4, "1").otherwise("0")
        else:
            value = _value(c).cast("double").cast("string")
            how = _draw(c, "b") * 3
            gap = F.when(how < 1, F.lit(None).cast("string")).when(how < 2, "").otherwise("NaN")
            if c == "xhypo":  # exactly one in ten
                missing = F.col("i") % 10 == 3
            else:
                missing = _draw(c, "gap") < share
            text = F.when(missing, gap).otherwise(value)
        cols.append(text.alias(field.name))
    junk = spark.range(5).select(*[
        (F.lit("junk") if f.name == "age" else F.lit("") if f.name == "target" else F.lit(None).cast("string")).alias(f.name)
        for f in PATIENT_SCHEMA
    ])
    return ids.select(*cols).unionByName(junk)


BANDS_PAGE = """<html><table><tr><th>Age</th><th>Share</th></tr>
<tr><th scope="row">18-24</th><td>7.1</td><td>9</td></tr><tr><th>25-34</th><td>12.0</td></tr>
<tr><th>35-44</th><td>11.6</td></tr><tr><th>45-54</th><td>13.4</td></tr><tr><th>55-64</th><td>14.9</td></tr>
<tr><th>65-74</th><td>8.7</td></tr><tr><th>75+</th><td>2.9</td></tr></table><table><tr><td>x</td></tr></table></html>"""

_AGE = "About {} of every 100 adults aged {} years ({}%)"


def _at(*pieces: tuple[int, str]) -> str:
    """A text with the given pieces at the given offsets."""
    text = ""
    for at, piece in pieces:
        text = text.ljust(at, ".") + piece
    return text


LISTS_PAGE = "<ul><li>a</li></ul><ul><li>b</li></ul><ul>" + "".join(f"<li>{t}</li>" for t in [
    _at((28, "men"), (33, "13.1"), (37, "%)")), _at((28, "women"), (35, "10.1"), (39, "%)")),
]) + "</ul><ul>" + "".join(f"<li>{t}</li>" for t in [
    _at((33, "18–24"), (46, "5.3"), (49, "%")), _at((35, "25–44"), (48, "12.6"), (52, "%")),
    _at((35, "45–64"), (48, "14.9"), (52, "%")), _at((33, "65"), (53, "8.3"), (56, "%")),
]) + "</ul>"

_POINT = '<span class="ds-data-point ds-2017"><span class="dp-data-estimate">{}</span><span class="dp-ci">±1</span></span>'
SCHOOL_PAGE = (
    '<div class="ds-data-table-container"><div><span class="ds-data-point ds-2016"><span class="dp-data-estimate">99</span></span>'
    + "".join(_POINT.format(x) for x in ["8.8", "9.8", "7.6", "", "5.4", "7.5", "9.8", "13.4"]) + "</div></div>"
    + '<div class="ds-data-table-container">' + _POINT.format("77") + "</div>"
)


def page(spark: SparkSession, html: str) -> DataFrame:
    return spark.createDataFrame([(1, html)], "page_id int, html string")
