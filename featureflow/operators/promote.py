"""Model promotion decisions as tables (M3-M5): the registry's alias and tag state is
kept as DataFrames, so each decision is a plan over the validation log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.operators.aggregate import latest_per_key

# Alias names, status tags and the date format of tag values.
CHAMPION, CHALLENGER, PRIOR = "champion", "challenger", "prior_champion"
DEMOTED, PROMOTED = "demoted_to_prior_champion", "promoted_to_champion"
TAG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def choose_champion(model_info: DataFrame, aliases: DataFrame, strict: bool = True) -> DataFrame:
    """M3: per model, the newest validation of the champion and challenger versions
    decides: higher score -> champion, other -> challenger; a tie keeps the incumbent.

    ``aliases``: (model_name, champion_version, challenger_version).
    Output: (model_name, model_version, f1_score, previous_alias, new_alias, changed).
    ``strict``: raise if any model lacks a validation row for either version.
    """
    a = aliases.select("model_name", F.explode(F.array(
        F.struct(F.col("champion_version").alias("model_version"), F.lit(CHAMPION).alias("previous_alias")),
        F.struct(F.col("challenger_version").alias("model_version"), F.lit(CHALLENGER).alias("previous_alias")),
    )).alias("a")).select("model_name", "a.*")
    cand = model_info.join(a.drop("previous_alias"), ["model_name", "model_version"], "left_semi")
    newest = latest_per_key(cand, ["model_name", "model_version"], ["validation_timestamp"])
    latest = a.join(newest, ["model_name", "model_version"], "left")  # from the aliases: no model gets lost
    latest = latest.withColumn("_valid", F.col("f1_score").isNotNull().cast("int"))
    incumbent_first = F.when(F.col("previous_alias") == CHAMPION, 0).otherwise(1)
    w = Window.partitionBy("model_name").orderBy(F.desc("f1_score"), incumbent_first)
    ranked = latest.withColumn("_rn", F.row_number().over(w)).withColumn(
        "_n", F.sum("_valid").over(Window.partitionBy("model_name")))
    if strict:
        short = ranked.where(F.col("_n") < 2).select("model_name").limit(1).collect()
        if short:
            raise ValueError(f"missing validation results for the champion or challenger of {short[0][0]}")
    out = ranked.where(F.col("_n") >= 2).select(
        "model_name", "model_version", "f1_score", "previous_alias",
        F.when(F.col("_rn") == 1, F.lit(CHAMPION)).otherwise(F.lit(CHALLENGER)).alias("new_alias"))
    return out.withColumn("changed", F.col("previous_alias") != F.col("new_alias"))


def apply_aliases(decision: DataFrame, at: dt.datetime) -> DataFrame:
    """M4: alias and tag rows after a decision.

    Rows (model_name, model_version, kind, name, value): every model gets its new
    champion/challenger aliases; when the champion changed, the old champion also
    becomes ``prior_champion`` and both versions get status and date tags.
    """
    when_txt = F.date_format(F.lit(at).cast("timestamp_ntz"), TAG_TIME_FORMAT)
    none = F.lit(None).cast("string")

    def row(kind, name, value=none):
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"), value.alias("value"))
    changed = F.max("changed").over(Window.partitionBy("model_name"))
    d = decision.withColumns({"_old": changed & (F.col("previous_alias") == CHAMPION), "_new": changed & (F.col("new_alias") == CHAMPION)})
    old = [row("alias", F.lit(PRIOR)), row("tag", F.lit("status"), F.lit(DEMOTED)), row("tag", F.lit("demoted_on"), when_txt)]
    new = [row("tag", F.lit("status"), F.lit(PROMOTED)), row("tag", F.lit("promoted_on"), when_txt)]
    rows = F.array(row("alias", F.col("new_alias")), *[F.when(F.col("_old"), r) for r in old], *[F.when(F.col("_new"), r) for r in new])
    return d.select("model_name", "model_version", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select(
        "model_name", "model_version", "r.kind", "r.name", "r.value")


def register_version(aliases: DataFrame, versions: DataFrame) -> DataFrame:
    """M5: add ``versions`` (model_name, model_version; one a model) to the alias table (model_name,
    model_version, alias). A model's first version becomes champion; a later one becomes challenger and the
    challenger before it loses its alias; the champion stays whoever it is."""
    new = versions.select("model_name", F.col("model_version").alias("_new"))
    a = aliases.select("model_name", "model_version", "alias").join(new, "model_name", "left")
    outdated = F.col("_new").isNotNull() & (F.col("alias") == CHALLENGER)
    same = F.coalesce(F.col("model_version") == F.col("_new"), F.lit(False))
    kept = a.where(~same).select("model_name", "model_version", F.when(~F.coalesce(outdated, F.lit(False)), F.col("alias")).alias("alias"))
    known = aliases.select("model_name").distinct().withColumn("_known", F.lit(True))
    held = aliases.where(F.col("alias") == CHAMPION).select("model_name", F.col("model_version").alias("_champion"))
    added = (versions.select("model_name", "model_version").join(known, "model_name", "left").join(held, "model_name", "left")
             .select("model_name", "model_version",
                     F.when(F.col("_known").isNull() | (F.col("model_version") == F.col("_champion")), F.lit(CHAMPION))
                     .otherwise(F.lit(CHALLENGER)).alias("alias")))
    return kept.unionByName(added)


def initial_aliases(versions: DataFrame, description_col: str | None = None) -> DataFrame:
    """M5: alias assignment for a model's whole history, registered in order without a promotion.

    Per model: the first version is the champion; the newest later version is the
    challenger; others carry no alias. Tags/description go into a map column.
    Output: (model_name, model_version, alias, tags).
    """
    w_first = Window.partitionBy("model_name").orderBy(F.asc("model_version"))
    w_last = Window.partitionBy("model_name").orderBy(F.desc("model_version"))
    v = versions.select("model_name", "model_version", *([description_col] if description_col else []))
    v = v.withColumn("_first", F.row_number().over(w_first)).withColumn("_last", F.row_number().over(w_last))
    alias = (F.when(F.col("_first") == 1, F.lit(CHAMPION))
             .when(F.col("_last") == 1, F.lit(CHALLENGER)))
    desc = F.col(description_col).cast("string") if description_col else F.lit(None).cast("string")
    tags = F.create_map(F.lit("first_version"), (F.col("_first") == 1).cast("string"),
                        F.lit("description"), desc)
    return v.select("model_name", "model_version", alias.alias("alias"), tags.alias("tags"))


def validation_record(scored: DataFrame, model_name: str, model_version: int, model_alias: str,
                      modeling_method: str, at: dt.datetime, label: str = "label", pred: str = "prediction",
                      positive=1, metric: str = "binary_f1", splits: tuple[str, ...] | None = ("test",),
                      split_col: str = "split") -> DataFrame:
    """The validation log row (model-info schema) for one scored model, as a plan.

    ``metric``: ``binary_f1`` (F1 of ``positive``) or ``weighted_f1`` (class-weighted);
    the two are different metrics, so the row says which one it holds. ``splits``:
    rows to score (default: the test split); ``None`` scores every row. The F1 is an
    aggregation over the scored rows; the metadata are literals -- nothing is
    collected to build the row.
    """
    from featureflow.functions.columns import round_metric
    from featureflow.operators.metrics import binary_metrics, weighted_f1
    rows = scored if splits is None else scored.where(F.col(split_col).isin(*splits))
    if metric == "binary_f1":
        m = binary_metrics(rows, label, pred, positive, digits=None).select(F.col("f1").alias("_f1"))
    elif metric == "weighted_f1":
        m = weighted_f1(rows, label, pred, digits=None).select(F.col("weighted_f1").alias("_f1"))
    else:
        raise ValueError(metric)
    return m.select(F.lit(model_name).alias("model_name"), F.lit(model_version).cast("bigint").alias("model_version"),
                    round_metric(F.col("_f1"), 4).alias("f1_score"), F.lit(metric).alias("metric"),
                    F.lit(model_alias).alias("model_alias"), F.lit(modeling_method).alias("modeling_method"),
                    F.lit(at).cast("timestamp_ntz").alias("validation_timestamp"))


def deploy_version(aliases: DataFrame, versions: DataFrame) -> DataFrame:
    """M5 deploy: make ``versions`` (model_name, model_version) the champion of their
    model; a challenger alias on the deployed version is dropped; other aliases stay.

    ``aliases``: (model_name, model_version, alias) with null alias = no alias.
    Returns the alias table after deployment (one row per model_name, model_version).
    """
    dep = versions.select("model_name", F.col("model_version").alias("_dep"))
    a = aliases.join(dep, "model_name", "left")
    deployed = F.col("_dep").isNotNull()
    is_dep = deployed & (F.col("model_version") == F.col("_dep"))
    alias = (F.when(is_dep, F.lit(CHAMPION))
             .when(deployed & (F.col("alias") == CHAMPION), F.lit(None).cast("string"))
             .otherwise(F.col("alias")))
    return a.select("model_name", "model_version", alias.alias("alias"))
