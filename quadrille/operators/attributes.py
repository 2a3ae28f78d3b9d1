"""Attribute rules, batches, keyed tables and result files, as DataFrame expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quadrille.sources.staging import staged

# Codes of the protected-area inventory; fixed values.
NO_ACCESS, PRIVATE_OWNERS, MILITARY_NAMES, MILITARY_TYPES = ["XA"], ["PVT"], ["DOD", "DOE"], ["MIL"]
PUBLIC_MANAGERS, PUBLIC_OWNERS = ["FED", "STAT", "LOC", "DIST", "JNT", "TERR"], ["LOC", "DIST", "FED", "JNT", "STAT"]
# Feature types of the hydrography layers; fixed values.
WATER_TYPES = {"NHDWaterbody": {390: "LakePond", 436: "Reservoir", 466: "SwampMarsh"}, "NHDArea": {460: "StreamRiver", 537: "AreaOfComplexChannels"}}


def one_of(c: Column, values: list) -> Column:
    """Membership that is false, not unknown, for null."""
    return F.coalesce(c.isin(values), F.lit(False))


def is_public(manager: str = "Mang_Type", owner: str = "Own_Type", manager_name: str = "Mang_Name", owner_name: str = "Own_Name", kind: str = "Des_Tp", access: str = "Pub_Access") -> Column:
    c = F.col
    shut = one_of(c(access), NO_ACCESS) | one_of(c(owner), PRIVATE_OWNERS) | one_of(c(manager_name), MILITARY_NAMES) | one_of(c(owner_name), MILITARY_NAMES) | one_of(c(kind), MILITARY_TYPES)
    return ~shut & (one_of(c(manager), PUBLIC_MANAGERS) | (one_of(c(manager), ["UNK"]) & one_of(c(owner), PUBLIC_OWNERS)))


def land_products(df: DataFrame) -> DataFrame:
    """All rows as land_type ``all`` and, out of the same scan, the public ones once more as ``public``."""
    kinds = F.when(is_public(), F.array(F.lit("all"), F.lit("public"))).otherwise(F.array(F.lit("all")))
    return df.select("*", F.explode(kinds).alias("land_type"))


def water_features(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows of the allowed types of each layer, with source_layer and feature_type."""
    parts = []
    for name, types in WATER_TYPES.items():
        if name in layers:
            label = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
            rows = layers[name].filter(F.col("ftype").isin(sorted(types)))
            parts.append(rows.select("*", F.lit(name).alias("source_layer"), label[F.col("ftype")].alias("feature_type")))
    return reduce(DataFrame.unionByName, parts)


def finite_nonzero(c: Column) -> Column:
    """A number out of text: null where it is missing, no number, not finite or zero."""
    text = F.trim(c.cast("string"))
    plain = F.when(text.rlike(r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"), F.regexp_replace(text, "_", "")).try_cast("double")
    return F.when((F.abs(plain) < float("inf")) & (plain != 0), plain)


def last_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key; rows without a key go."""
    rest = [c for c in df.columns if c != key]
    last = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return last.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def repeated_keys(df: DataFrame, key: str, order: str) -> DataFrame:
    """The second and later rows of every key."""
    return df.withColumn("nth", F.row_number().over(W.partitionBy(key).orderBy(order))).filter("nth > 1")


STAMP = r"(\d{8}_\d{6}|\d{4}(_\d{2}){5})$"


def stamped(files: DataFrame, stem: str = "stem") -> DataFrame:
    """Add ``job`` (the stem without its trailing time stamp) and ``ts`` (null without one)."""
    tail = F.regexp_extract(stem, STAMP, 1)
    ts = F.coalesce(F.try_to_timestamp(tail, F.lit("yyyyMMdd_HHmmss")), F.try_to_timestamp(tail, F.lit("yyyy_MM_dd_HH_mm_ss")))
    return files.withColumn("job", F.regexp_replace(F.regexp_replace(stem, STAMP, ""), "_+$", "")).withColumn("ts", ts)


def newest(files: DataFrame) -> DataFrame:
    """(job, stem) of the newest file of each job, by time stamp and then by ``mtime``."""
    seen = stamped(files).withColumn("ts", F.coalesce("ts", F.lit("0001-01-01").cast("timestamp")))
    return seen.groupBy("job").agg(F.max_by("stem", F.struct("ts", "mtime", "stem")).alias("stem"))


def combine(frames: list[tuple[str, DataFrame]], key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Tables with the same keys side by side; shared columns have to agree.

    The tables are stacked, each row as the struct of its table, and grouped by key once,
    whatever their number; what comes out is written, and all checks are sums over it:
    keys that repeat, that a table lacks (a null key has no partner), and shared columns
    that differ from the first table with them (nulls and NaN being equal). Errors name
    up to ten keys, in order; only those reach the driver.
    """
    rest = [[c for c in df.columns if c != key] for _, df in frames]
    whole = lambda df, i: F.struct(F.lit(True).alias("__in"), *[F.col(f"`{c}`") for c in rest[i]])
    kinds = [df.select(whole(df, i).alias("s")).schema["s"].dataType for i, (_, df) in enumerate(frames)]
    rows = [df.select(key, *[(whole(df, i) if i == k else F.lit(None).cast(kinds[k])).alias(f"__{k}") for k in range(len(frames))]) for i, (_, df) in enumerate(frames)]
    met = reduce(DataFrame.union, rows).groupBy(key).agg(*[F.count(f"__{k}").alias(f"__n{k}") for k in range(len(frames))], *[F.first(f"__{k}", ignorenulls=True).alias(f"__{k}") for k in range(len(frames))])
    met = staged(met, "combined")
    has = lambda k: (F.col(f"__n{k}") > 0) & F.col(key).isNotNull()
    checks = [(f"{label}: repeated keys", F.col(f"__n{k}") > 1) for k, (label, _) in enumerate(frames)]
    source = dict.fromkeys(rest[0], 0)
    for k, (label, df) in enumerate(frames[1:], 1):
        checks.append((f"{label}: keys without a partner in {label}", (F.col("__n0") > 0) & ~has(k)))
        checks.append((f"{label}: keys without a partner in {frames[0][0]}", (F.col(f"__n{k}") > 0) & ~has(0)))
        for c in sorted(set(source) & set(rest[k]) - set(ignore)):
            a, b = F.col(f"__{source[c]}")[c], F.col(f"__{k}")[c]
            checks.append((f"{label}: columns that differ: {c}", has(k) & ~same_value(a, b, dict(df.dtypes)[c])))
        source |= {c: k for c in rest[k] if c not in source}
    counts = met.agg(*[F.count_if(wrong).alias(f"c{n}") for n, (_, wrong) in enumerate(checks)]).first()
    for n, (message, wrong) in enumerate(checks):
        if counts[f"c{n}"]:
            examples = [r[0] for r in met.filter(wrong).select(key).orderBy(key).limit(10).collect()]
            raise ValueError(f"{message} {examples}")
    columns = [c for c in frames[0][1].columns if c == key or source[c] == 0] + [c for c, k in source.items() if k]
    return met.select(*[F.col(key) if c == key else F.col(f"__{source[c]}")[c].alias(c) for c in columns])


def same_value(a: Column, b: Column, kind: str) -> Column:
    """Equality under which nulls are equal and, in columns of floating-point numbers, NaN is null."""
    if kind not in ("double", "float"):
        return a.eqNullSafe(b)
    plain = lambda c: F.when(~F.isnan(c), c)
    return plain(a).eqNullSafe(plain(b))


def class_areas(df: DataFrame, classes: list[str], area_prefix: str = "area_ha_valid_reclassified_NLCD2023_", share_prefix: str = "proportion_valid_nonzero_reclassified_NLCD2023_") -> DataFrame:
    """area_ha_nlcd_<class> = valid area x share for each class; the two columns it is made of go."""
    for c in classes:
        found = [[x for x in df.columns if x.startswith(p + c)] for p in (area_prefix, share_prefix)]
        if any(len(x) > 1 for x in found) or len(found[0]) != len(found[1]):
            raise ValueError(f"class {c}: columns {found}")
        if found[0]:
            (a,), (p,) = found
            df = df.withColumn(f"area_ha_nlcd_{c}", F.col(f"`{a}`") * F.col(f"`{p}`")).drop(a, p)
    return df


def require(df: DataFrame, fields: list[str]) -> None:
    missing = sorted(set(fields) - set(df.columns))
    if missing:
        raise ValueError(f"missing fields: {', '.join(missing)}")


def output_name(stem: str) -> str:
    """A file stem without the time stamp at its end."""
    return re.sub(STAMP, "", stem).rstrip("_")
