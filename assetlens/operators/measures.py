"""Aggregations, top-k and de-duplication in forms that pre-aggregate before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean


def first_kept(df: DataFrame, key: list[Column], ordinal: list[str]) -> DataFrame:
    """Exact de-duplication: the first row per key by ordinal. A minimum over structs is
    combined on the map side, so copies of one key never meet in one task unreduced."""
    names = df.columns
    keyed = df.select(*[k.alias(f"_k{i}") for i, k in enumerate(key)],
                      F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(ordinal)],
                               F.struct(*names).alias("row")).alias("r"))
    return keyed.groupBy(*[f"_k{i}" for i in range(len(key))]).agg(F.min("r").alias("r")).select("r.row.*")


def newest(df: DataFrame, key: list[str], by: list[str], keep: list[str]) -> DataFrame:
    """Newest row per key, by a descending list of columns."""
    return df.groupBy(*key).agg(F.max(F.struct(*by, *[c for c in keep if c not in by])).alias("m")).select(
        *key, *[F.col(f"m.{c}").alias(c) for c in keep])


def top_n(df: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows per key; the limit is applied in every map task before the shuffle."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def slot_profile(df: DataFrame, by: list[str], phase: str, slots: dict[str, str]) -> DataFrame:
    """Fixed phase slots plus total, zero when empty."""
    return df.groupBy(*by).agg(
        *[F.coalesce(F.sum(F.when(F.col(phase) == v, 1)), F.lit(0)).cast("long").alias(k) for k, v in slots.items()],
        F.count("*").alias("total"))


def duplicate_surplus(df: DataFrame, by: list[str], key: list[str]) -> DataFrame:
    """Rows beyond the first of each exact key, per group."""
    return (df.groupBy(*by, *key).agg(F.count("*").alias("n")).groupBy(*by)
            .agg(F.sum(F.col("n") - 1).alias("surplus"), F.count("*").alias("distinct_rows")))


def variant_collisions(df: DataFrame, key: list[str], description: str) -> DataFrame:
    """Coarse keys that carry more than one description."""
    per = df.groupBy(*key, description).agg(F.count("*").alias("n"))
    return per.groupBy(*key).agg(F.sum("n").alias("rows"), F.count("*").alias("variants")).filter("variants > 1")


def attribute_union(df: DataFrame, key: str, attributes: dict[str, Column]) -> DataFrame:
    """Distinct non-blank values of several attributes, one row per (key, attribute, value)."""
    pairs = F.array(*[F.struct(F.lit(k).alias("attribute"), F.trim(v.cast("string")).alias("value"))
                      for k, v in attributes.items()])
    return (df.select(key, F.explode(pairs).alias("p")).select(key, "p.attribute", "p.value")
            .filter("value is not null and value <> ''").distinct())


def programme_rollup(trials: DataFrame) -> DataFrame:
    """Trial rows -> programmes by (asset, condition): best phase and status, number of
    distinct trials, and the remaining fields from the first row."""
    return trials.groupBy("asset_key", "condition_key").agg(
        F.count_distinct("nct").alias("trials"), F.max("phase_rank").alias("phase_rank"),
        F.max("status_rank").alias("status_rank"),
        F.min(F.struct("ordinal", "title")).getField("title").alias("title"))


def programme_details(trials: DataFrame) -> DataFrame:
    """Trial rows -> (asset_key, condition_key, trial_ids, phase, status, additional_information) of every programme.

    ``trial_ids`` are distinct and sorted, blank and null ones left out; phase and status are the best by rank, the first
    by ordinal on ties; null ranks count as 0. Texts follow each other by ordinal, joined by "; ", each unless it stands
    in what is gathered before it; null is blank. Repeated ids and texts are reduced before they are shuffled, so a group
    holds what its row returns and the texts found inside others.
    """
    by = ["asset_key", "condition_key"]
    d = trials.select(*by, "ordinal", "nct", "phase", "status", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("phase_rank", "status_rank")],
                      clean("information").alias("text"))
    best = lambda c: F.max(F.struct(f"{c}_rank", (-F.col("ordinal")).alias("o"), c)).getField(c).alias(c)
    heads = d.groupBy(*by).agg(best("phase"), best("status"))
    ids = d.filter("nct is not null and nct <> ''").select(*by, "nct").distinct().groupBy(*by).agg(F.sort_array(F.collect_list("nct")).alias("trial_ids"))
    texts = d.filter("text <> ''").groupBy(*by, "text").agg(F.min("ordinal").alias("first"))
    texts = texts.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("first", "text"))), lambda t: t["text"]).alias("texts"))
    gathered = F.aggregate("texts", F.lit(""), lambda all_, t: F.when(all_.contains(t), all_).when(all_ == "", F.btrim(t, F.lit("; ")))
                           .otherwise(F.btrim(F.concat(all_, F.lit("; "), t), F.lit("; "))))
    # Keys may be null: they are one group each, so the joins take null as equal.
    out = heads.alias("h")
    for name, other in (("i", ids), ("t", texts.select(*by, gathered.alias("additional_information")))):
        same = [F.col(f"h.{k}").eqNullSafe(F.col(f"{name}.{k}")) for k in by]
        out = out.join(other.alias(name), same[0] & same[1], "left")
    return out.select("h.*", F.coalesce("i.trial_ids", F.array().cast("array<string>")).alias("trial_ids"),
                      F.coalesce("t.additional_information", F.lit("")).alias("additional_information"))


def missing_fields(fields: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(v.cast("string"), F.lit("")) == "", F.lit(k))
                                     for k, v in fields.items()]))


def ingredient_cover(products: DataFrame, rows: DataFrame) -> DataFrame:
    """Which rows of an exact-brand family belong to a product.

    Rows holding every component win. Without one, a product of several components accepts
    rows without foreign ingredients when together they hold all components.
    """
    d = products.join(rows, "product_id")
    size = F.size("components")
    strict = (F.size("ingredients") > 0) & (F.size(F.array_except("components", "ingredients")) == 0)
    clean = (F.size("ingredients") > 0) & (F.size(F.array_except("ingredients", "components")) == 0)
    d = d.withColumns({"strict": strict, "clean": clean})
    any_strict = d.groupBy("product_id").agg(F.max("strict").alias("any_strict"))
    covered = (d.filter("clean").select("product_id", "components", F.explode("ingredients").alias("c")).distinct()
               .groupBy("product_id", "components").agg(F.count("*").alias("n"))
               .select("product_id", (F.col("n") == F.size("components")).alias("covered")))
    d = d.join(any_strict, "product_id").join(covered, "product_id", "left")
    mode = (F.when(size == 0, "NO_MOLECULE_GUARD").when(F.col("any_strict"), "STRICT_ALL_COMPONENTS")
            .when((size > 1) & F.coalesce("covered", F.lit(False)), "ALTERNATE_FORMULATION_COMPONENTS")
            .otherwise("NO_COMPATIBLE_ROW"))
    d = d.withColumn("mode", mode)
    accepted = (F.when(F.col("mode") == "NO_MOLECULE_GUARD", True).when(F.col("mode") == "STRICT_ALL_COMPONENTS", F.col("strict"))
                .when(F.col("mode") == "ALTERNATE_FORMULATION_COMPONENTS", F.col("clean")).otherwise(False))
    return d.withColumn("accepted", accepted).select("product_id", "row_id", "mode", "accepted")


def pool_choice(rows: DataFrame, key: list[str], prefer: list[str], keep: list[str]) -> DataFrame:
    """Best pool then best row: the rows at the highest sponsor score, the best of them by
    ``prefer`` (earliest ordinal on ties), the size of the pool and its distinct statements."""
    lead = F.struct(*prefer, (-F.col("ordinal")).alias("_o"), *[c for c in keep if c not in prefer])
    per = rows.groupBy(*key, "sponsor_score").agg(
        F.max(lead).alias("b"), F.count("*").alias("pool_size"), F.count_distinct("statement").alias("statements"))
    best = per.groupBy(*key).agg(F.max(F.struct("sponsor_score", "pool_size", "statements", "b")).alias("m"))
    return best.select(*key, F.col("m.sponsor_score").alias("sponsor_score"), F.col("m.pool_size").alias("pool_size"),
                       F.col("m.statements").alias("statements"), *[F.col(f"m.b.{c}").alias(c) for c in keep])
