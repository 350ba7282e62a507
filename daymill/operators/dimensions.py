"""Dimension tables: lookups, category and area hierarchies, rules as text.

No join here carries a broadcast hint.  Spark broadcasts a side whose size it
has measured to be small and shuffles by key otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions.days import as_date
from daymill.operators.trees import chains


def code_lookup(df: DataFrame, codes: DataFrame, decode: Mapping[str, str], parents: Mapping[str, str] | None = None):
    """Add the name of each code column from one shared dictionary.

    ``decode`` maps code column to name column; ``parents`` limits a code
    column to one parent group of the dictionary.  Codes are compared as text
    because sources hold them as numbers or as text.
    """
    for code, name in decode.items():
        entries = codes
        if parents and code in parents:
            entries = entries.where(F.col("parent_code") == parents[code])
        entries = entries.select(F.col("dic_code").cast("string").alias(f"__{code}"), F.col("dic_name").alias(name))
        df = df.join(entries, F.col(code).cast("string") == F.col(f"__{code}"), "left").drop(f"__{code}")
    return df


def with_names(df: DataFrame, dim: DataFrame, key: str, dim_key: str, names: Mapping[str, str], how: str = "left"):
    """Join a dimension on one key and take some of its columns under new names."""
    side = dim.select(F.col(dim_key).alias("__key"), *[F.col(c).alias(a) for c, a in names.items()])
    return df.join(side, F.col(key) == F.col("__key"), how).drop("__key")


def geo_dim(provinces: DataFrame, regions: DataFrame) -> DataFrame:
    """Province with its codes and the name of its region."""
    codes = [c for c in ("area_code", "iso_code", "iso_3166_2") if c in provinces.columns]
    return with_names(provinces, regions, "region_id", "id", {"region_name": "region_name"}).select(
        F.col("id").alias("province_id"), F.col("name").alias("province_name"), *codes, "region_id", "region_name"
    )


def sku_dim(
    sku: DataFrame,
    spu: DataFrame,
    category3: DataFrame,
    category2: DataFrame,
    category1: DataFrame,
    brands: DataFrame,
    attributes: DataFrame,
    sale_attributes: DataFrame,
) -> DataFrame:
    """Product with its category chain, brand and attribute lists, one row each.

    Attributes are made distinct per product before they are listed, so the
    length of a list is bounded by the attribute catalogue, not by the rows
    of the attribute tables.  A list holds ids and names.
    """

    def listed(table: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        distinct = table.select("sku_id", *columns).distinct()
        return distinct.groupBy("sku_id").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))

    out = with_names(sku, spu, "spu_id", "id", {"spu_name": "spu_name", "category3_id": "category3_id"})
    out = with_names(out, category3, "category3_id", "id", {"name": "category3_name", "category2_id": "category2_id"})
    out = with_names(out, category2, "category2_id", "id", {"name": "category2_name", "category1_id": "category1_id"})
    out = with_names(out, category1, "category1_id", "id", {"name": "category1_name"})
    out = with_names(out, brands, "tm_id", "id", {"tm_name": "tm_name"})
    attrs = listed(attributes, ["attr_id", "value_id", "attr_name", "value_name"], "attrs").withColumnRenamed("sku_id", "__a")
    named = ["sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"]
    sales = listed(sale_attributes, named, "sale_attrs").withColumnRenamed("sku_id", "__s")
    return (
        out.join(attrs, F.col("id") == F.col("__a"), "left")
        .join(sales, F.col("id") == F.col("__s"), "left")
        .drop("__a", "__s")
        .withColumn("is_sale", F.col("is_sale").cast("boolean"))
        .withColumnRenamed("id", "sku_id")
    )


def benefit_rule(df: DataFrame, kind: str) -> Column:
    """Rule sentence of a promotion (``activity``) or voucher (``coupon``); null if a part is null."""
    threshold_cut = F.concat(
        F.lit("满"), F.col("condition_amount").cast("string"), F.lit("元减"), F.col("benefit_amount").cast("string"), F.lit("元")
    )
    count_discount = F.concat(
        F.lit("满"), F.col("condition_num").cast("string"), F.lit("件打"), F.col("benefit_discount").cast("string"), F.lit(" 折")
    )
    if kind == "activity":
        plain = F.concat(F.lit("打"), F.col("benefit_discount").cast("string"), F.lit("折"))
        codes = ("3101", "3102", "3103")
    else:
        plain = F.concat(F.lit("减"), F.col("benefit_amount").cast("string"), F.lit("元"))
        codes = ("3201", "3202", "3203")
    rule_type = F.col("rule_type")
    return (
        F.when(rule_type == codes[0], threshold_cut)
        .when(rule_type == codes[1], count_discount)
        .when(rule_type == codes[2], plain)
    )


def benefit_dim(rules: DataFrame, codes: DataFrame, kind: str) -> DataFrame:
    """Promotion or voucher dimension: decoded type and the rule as a sentence."""
    parent = "31" if kind == "activity" else "32"
    decoded = code_lookup(rules, codes, {"rule_type": "rule_type_name"}, {"rule_type": parent})
    return decoded.withColumn("benefit_rule", benefit_rule(decoded, kind))


def snapshot_projection(
    df: DataFrame,
    day: str | dt.date,
    columns: Sequence[str],
    soft_delete: str | None = None,
    source_day: str | None = None,
) -> DataFrame:
    """Named columns of one daily snapshot, stamped with the target day ``ds``."""
    rows = df.where(F.col(soft_delete) == "0") if soft_delete else df
    if source_day:
        rows = rows.where(F.col("dt") == F.lit(as_date(source_day)))
    return rows.select(*columns, F.lit(as_date(day)).alias("ds"))


def complex_dim(areas: DataFrame, regions: DataFrame) -> DataFrame:
    """Delivery area with province and city names, one row per area.

    Areas without a known province or city are left out.  The couriers of an
    area are rows of :func:`complex_couriers`, as there may be any number.
    """
    out = with_names(areas, regions, "province_id", "id", {"name": "province_name"}, "inner")
    return with_names(out, regions, "city_id", "id", {"name": "city_name"}, "inner")


def complex_couriers(couriers: DataFrame) -> DataFrame:
    """Bridge between areas and couriers: each pair once, ids as text."""
    return couriers.select("complex_id", F.col("courier_emp_id").cast("string").alias("courier_emp_id")).distinct()


def org_dim(orgs: DataFrame, regions: DataFrame) -> DataFrame:
    """Organisation with region name and code and the name of its parent."""
    out = with_names(orgs, regions, "region_id", "id", {"name": "region_name", "dict_code": "region_code"})
    return with_names(out, orgs, "org_parent_id", "id", {"org_name": "org_parent_name"})


def courier_dim(couriers: DataFrame, orgs: DataFrame, codes: DataFrame) -> DataFrame:
    """Courier with organisation and type name, phone hashed; unmatched couriers drop out."""
    out = with_names(couriers, orgs, "org_id", "id", {"org_name": "org_name"}, "inner")
    out = with_names(out, codes, "express_type", "dic_code", {"dic_name": "express_type_name"}, "inner")
    return out.withColumn("working_phone", F.md5("working_phone"))


def shift_dim(shifts: DataFrame, lines: DataFrame, codes: DataFrame) -> DataFrame:
    """Shift with the ends, distance, cost and planned minutes of its line."""
    line = {
        "name": "line_name",
        "line_type_id": "line_type_id",
        "start_org_id": "start_org_id",
        "end_org_id": "end_org_id",
        "distance": "distance",
        "cost": "cost",
        "estimated_time": "estimated_time",
    }
    out = with_names(shifts, lines, "line_id", "id", line, "inner")
    return with_names(out, codes, "line_type_id", "dic_code", {"dic_name": "line_type_name"}, "inner")


def driver_dim(drivers: DataFrame, orgs: DataFrame, teams: DataFrame) -> DataFrame:
    out = with_names(drivers, orgs, "org_id", "id", {"org_name": "org_name"}, "inner")
    return with_names(out, teams, "truck_team_id", "id", {"name": "truck_team_name"}, "inner")


MODEL_COLUMNS = [
    "model_name", "model_type", "model_no", "brand", "truck_weight", "load_weight", "total_weight", "eev",
    "boxcar_len", "boxcar_wd", "boxcar_hg", "max_speed", "oil_vol",
]


def truck_dim(trucks: DataFrame, teams: DataFrame, models: DataFrame, orgs: DataFrame, codes: DataFrame) -> DataFrame:
    """Truck with team, organisation and model measures, type and brand decoded, plate hashed."""
    team = {"name": "team_name", "team_no": "team_no", "org_id": "org_id", "manager_emp_id": "manager_emp_id"}
    out = with_names(trucks, teams, "team_id", "id", team, "inner")
    out = with_names(out, orgs, "org_id", "id", {"org_name": "org_name"}, "inner")
    out = with_names(out, models, "model_id", "id", {c: c for c in MODEL_COLUMNS}, "inner")
    out = with_names(out, codes, "model_type", "dic_code", {"dic_name": "model_type_name"}, "inner")
    out = with_names(out, codes, "brand", "dic_code", {"dic_name": "brand_name"}, "inner")
    return out.withColumn("truck_no", F.md5("truck_no"))


def region_chains(regions: DataFrame) -> DataFrame:
    """The region tree with the ``chain`` of each node, which :func:`climb_regions` takes instead of the plain tree."""
    return chains(regions.select("id", "name", "parent_id"), ["name"])


def _chained(regions: DataFrame) -> DataFrame:
    """(id, chain) of a region tree, for the two steps up that are needed, from the tree alone."""
    if "chain" in regions.columns:
        return regions.select("id", "chain")
    nodes = regions.select("id", "name", "parent_id")

    def above(n: str) -> DataFrame:
        return nodes.select(*[F.col(c).alias(f"__{n}_{c}") for c in nodes.columns])

    up = nodes.join(above("b"), F.col("parent_id") == F.col("__b_id"), "left")
    up = up.join(above("c"), F.col("__b_parent_id") == F.col("__c_id"), "left")
    links = [F.struct(F.col(f"{n}id").alias("id"), F.col(f"{n}name").alias("name")) for n in ("", "__b_", "__c_")]
    return up.select("id", F.array(*links).alias("chain"))


def climb_regions(df: DataFrame, regions: DataFrame, start: str, level: Column | None = None) -> DataFrame:
    """City and province of a row whose ``start`` column names a node of the region tree.

    Without ``level`` the start is a district: its parent is the city, the
    next one up the province.  With ``level`` a hub of level 1 sits on the
    city itself and any other hub one step below it.  The rows meet the tree
    in one join: its nodes hold their chains, see :func:`region_chains`.
    """
    side = _chained(regions).select(F.col("id").alias("__node"), F.col("chain").alias("__chain"))
    at_city = F.lit(False) if level is None else F.coalesce(level == 1, F.lit(False))
    joined = df.join(side, F.col(start) == F.col("__node"), "left")
    city, province = (F.get("__chain", F.when(at_city, n).otherwise(n + 1)) for n in (0, 1))
    return joined.select(
        *df.columns,
        city["id"].alias("city_id"),
        city["name"].alias("city_name"),
        province["id"].alias("province_id"),
        province["name"].alias("province_name"),
    )
