"""Land products out of one clip: all and public layers, the table of failures, and the counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.operators import attributes as T
from quadrille.operators import spatial as S
from quadrille.sources import files, geopackage
from quadrille.sources.staging import staged

NUMBER_COLUMN = "source_fid"


def land_layers(features: DataFrame, boundary: DataFrame, out: str, srid: int = 5070, tolerance: float = 15.0, cell: float = 50_000.0, overwrite: bool = False) -> dict[str, int]:
    """Clip features (fid, geom and the codes of ``attributes.is_public``) once and write all products of it.

    ``out/layers/all`` and ``out/layers/public`` are GeoPackage layers that one pass deals
    out and that come to stand together or not at all; ``out/failures`` is a CSV of
    (source_fid, reason), there only if something failed. Returns the counters: a status
    each, and the rows of both layers.
    """
    geopackage.register(features.sparkSession)
    clipped = staged(S.clip(features, boundary, tolerance, cell), "land")
    products = T.land_products(clipped.filter("status = 'ok'")).select("land_type", F.col("fid").cast("long").alias(NUMBER_COLUMN), "geom")
    products.write.format("geopackage").mode("overwrite" if overwrite else "append").option("layerColumn", "land_type").option("srid", srid).save(f"{out}/layers")
    files.write_failures(clipped.withColumnRenamed("fid", NUMBER_COLUMN), f"{out}/failures", [NUMBER_COLUMN])
    ok = F.col("status") == "ok"
    told = clipped.groupBy("status").agg(F.count("*").alias("n"), F.count_if(ok & T.is_public()).alias("public")).collect()  # a row a status
    counts = {r["status"]: r["n"] for r in told}
    return counts | {"all": counts.get("ok", 0), "public": sum(r["public"] for r in told)}


#: Which folder a layer cut by zones belongs to, by how its name starts; fixed values.
FOLDERS = {"padus_all_lands_": "padus_all_lands", "padus_public_lands_": "padus_public_lands"}


def zone_product(stem: str, stamp: str, unit: str = "county", default: str = "other") -> tuple[str, str]:
    """(layer, path) of a layer cut by zones: named after its input without time stamp, ``clipped_by_<unit>`` in place of ``clipped_to_usa``."""
    base = T.output_name(stem)
    layer = base.replace("_clipped_to_usa", f"_clipped_by_{unit}") if "_clipped_to_usa" in base else f"{base}_clipped_by_{unit}"
    folder = next((f for start, f in FOLDERS.items() if layer.startswith(start)), default)
    return layer, f"{folder}/{layer}_{stamp}.gpkg"


def job_suffix(name: str, stem: str) -> str:
    """What follows a job's stem in a file name, without the underscores between them."""
    return name.removeprefix(stem).lstrip("_")
