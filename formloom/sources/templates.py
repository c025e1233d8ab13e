"""Region templates: named bands of a page, from a file where there is a valid one, else the defaults."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.functions.geometry import denormalise

# Fixed values: (band, start, end) as shares of the page's height.
_THIRDS = [("header", 0.0, 0.33), ("defects", 0.33, 0.66), ("analysis", 0.66, 1.0)]
_EXTENDED = [("header", 0.0, 0.28), ("defects", 0.28, 0.64), ("analysis", 0.64, 1.0)]
DEFAULTS = {"otk_v1": _THIRDS, "otk_v2": _EXTENDED, "otk_standard": _THIRDS, "otk_extended": _EXTENDED}


def parse_templates(text: str | None) -> dict[str, list[tuple[str, float, float]]]:
    """JSON of {template: [{region_id, y_start_norm, y_end_norm}]}; entries out of order or range are left out.

    The defaults stand in for null or broken JSON, and where no template is left.
    """
    try:
        read = json.loads(text) if text else {}
    except ValueError:
        read = {}
    out = {}
    for name, bands in read.items() if isinstance(read, dict) else ():
        own = []
        for b in bands if isinstance(bands, list) else ():
            ok = isinstance(b, dict) and isinstance(b.get("region_id"), str) and all(isinstance(b.get(k), int | float) and not isinstance(b.get(k), bool) for k in ("y_start_norm", "y_end_norm"))
            if ok and 0 <= b["y_start_norm"] < b["y_end_norm"] <= 1:
                own.append((b["region_id"], float(b["y_start_norm"]), float(b["y_end_norm"])))
        if own:
            out[name] = own
    return out or DEFAULTS


def load_templates(spark: SparkSession, path: str) -> dict[str, list[tuple[str, float, float]]]:
    """From a file that Spark can read; the defaults where there is none."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return DEFAULTS
    return parse_templates(spark.read.text(path, wholetext=True).first()[0])


def template(spark: SparkSession, name: str, templates: dict | None = None) -> DataFrame:
    """(band, start, end) of a template; of the first where the name is unknown."""
    known = templates or DEFAULTS
    return spark.createDataFrame(known.get(name) or next(iter(known.values())), "band string, start double, end double")


def bands(rows: DataFrame, height: Column) -> DataFrame:
    """(band, y_start, y_end) in pixels."""
    spot = denormalise(F.col("start"), F.col("end"), height)
    return rows.select("band", spot.start.alias("y_start"), spot.end.alias("y_end"))
