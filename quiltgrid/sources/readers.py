"""Readers and writers of function tests, recipes, engine results and inventories.

Cells that may hold any type are read as variants and tagged with their kind. A file
is one JSON document, or with ``multi_line`` false one document per line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CASES = "function string, cases array<struct<id:string,formula:string,description:string,setup_cells:map<string,variant>,expected:variant,expected_note:string,check_range:string>>"
RECIPES = (
    "slug string, title string, task string, explanation string, keywords array<string>, solutions map<string,struct<formula:string,note:string>>, "
    "verify struct<setup_cells:map<string,variant>,setup_sheets:map<string,map<string,variant>>,formula:string,expected:variant,check_range:string>"
)
RESULTS = (
    "generated_at string, engine string, engine_version string, recalc_method string, trusted boolean, function_results map<string,map<string,struct<"
    "description:string,formula_display:string,value:variant,range_values:array<variant>,error:string,expected:variant,matched_expected:boolean,canary_ok_this_sheet:boolean,notes:string>>>"
)
VERIFIED = "recipes map<string,struct<verified:boolean,engine:string,engine_version:string,formula:string,expected:variant,actual:variant>>"
INVENTORY = "generated_at string, functions array<struct<name:string,category:string,apps:map<string,struct<documented:boolean,url:string>>>>"


def kind_of(value: Column) -> Column:
    """The kind of a variant cell: num, str, bool, err, array or null."""
    schema = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(schema == "VOID", "null").when(schema == "BOOLEAN", "bool").when(schema.startswith("ARRAY"), "array")
        .when((schema == "STRING") & text.startswith("#"), "err").when(schema == "STRING", "str").otherwise("num")
    )


def text_of(value: Column) -> Column:
    """A cell as text; arrays as JSON."""
    return F.when(kind_of(value) == "array", F.to_json(value)).otherwise(F.try_variant_get(value, "$", "string"))


def read_cases(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A row per test case."""
    files = spark.read.schema(CASES).option("multiLine", multi_line).json(path)
    rows = files.where("function is not null").select("function", F.explode("cases").alias("c")).select("function", "c.*")
    return rows.withColumns({"expected_kind": kind_of(F.col("expected")), "expected_text": text_of(F.col("expected")), "n_cells": F.coalesce(F.size("setup_cells"), F.lit(0))})


def read_recipes(spark: SparkSession, path: str, verified_path: str | None = None, multi_line: bool = True) -> DataFrame:
    """A row per recipe with its verification, if there is one; array results as joined text."""
    recipes = spark.read.schema(RECIPES).option("multiLine", multi_line).json(path).where("slug is not null")
    if verified_path is None:
        return recipes
    found = spark.read.schema(VERIFIED).option("multiLine", multi_line).json(verified_path).select(F.explode("recipes").alias("slug", "v"))
    joined = F.array_join(F.try_variant_get("v.actual", "$", "array<string>"), ", ")
    actual = F.when(kind_of(F.col("v.actual")) == "array", joined).otherwise(F.try_variant_get("v.actual", "$", "string"))
    return recipes.join(found.select("slug", "v.verified", "v.engine", "v.engine_version", actual.alias("actual")), "slug", "left")


def read_results(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """S3: a row per engine, version, function and case; unknown engines are dropped."""
    from quiltgrid.operators.compat import normalize_label

    files = spark.read.schema(RESULTS).option("multiLine", multi_line).json(path)
    files = files.withColumn("app", normalize_label(F.col("engine"))).where("app is not null")
    by_function = files.select("app", "engine_version", "trusted", F.explode("function_results").alias("function", "_cases"))
    rows = by_function.select("app", "engine_version", "trusted", "function", F.explode("_cases").alias("id", "r"))
    return rows.select("app", "engine_version", "trusted", "function", "id", text_of(F.col("r.value")).alias("value"), F.transform("r.range_values", lambda v: F.try_variant_get(v, "$", "string")).alias("range_values"), "r.error", F.col("r.matched_expected").alias("matched"), "r.canary_ok_this_sheet", "r.notes")


def read_inventory(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A row per function and application."""
    files = spark.read.schema(INVENTORY).option("multiLine", multi_line).json(path)
    rows = files.select(F.explode("functions").alias("f")).select("f.name", "f.category", F.explode("f.apps").alias("app", "a"))
    return rows.select("name", "category", "app", F.coalesce("a.documented", F.lit(False)).alias("documented"), "a.url")


def read_named_tables(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    """Several named tables of one folder."""
    return {n: spark.read.parquet(f"{path}/{n}.parquet") for n in names}


def write_wide(df: DataFrame, path: str, form: str = "json") -> None:
    """Compact records per function; ``lnew`` is written only for what became supported."""
    df.withColumn("lnew", F.when(F.col("lnew"), True)).write.format(form).option("ignoreNullFields", True).save(path)
