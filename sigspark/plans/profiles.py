"""Clinical profile classification (inventory H1–H7)."""

from __future__ import annotations

import warnings

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark import config
from sigspark.errors import ValidationError
from sigspark.functions.columns import profile_rule
from sigspark.operators.sides import joined
from sigspark.operators.stats import sequence_index

FEATURES = ("biomarker_count", "avg_response", "max_response", "response_variability")


# H1
def profile_rules(features: DataFrame) -> DataFrame:
    return features.withColumn("clinical_profile", profile_rule("max_response", "biomarker_count"))


# H2: training labels
def labelled_features(features: DataFrame) -> DataFrame:
    """The rule profile as the label of each feature row (missing features are 0)."""
    labelled = profile_rules(features).fillna(0, subset=list(FEATURES)).fillna(0.0, subset=list(FEATURES))
    return labelled.select("pert_iname", *[F.col(c).cast("double").alias(c) for c in FEATURES],
                           F.col("clinical_profile").alias("rule_profile"))


def held_out(share: int = 5):
    """One compound in ``share``, by key hash: kept from training, scored for the metrics."""
    return F.pmod(F.xxhash64("pert_iname"), F.lit(share)) == 0


# H3
def fit_profile_forest(features: DataFrame, trees: int = 100, seed: int = 42, max_depth: int = 30):
    """Train the forest on the rule labels of the compounds not held out:
    label indexer, assembler, standard scaler, random forest (trees as deep as
    Spark grows them). Training is distributed over the feature rows (one row
    per compound)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler

    indexer = StringIndexer(inputCol="rule_profile", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    forest = RandomForestClassifier(numTrees=trees, seed=seed, maxDepth=max_depth, labelCol="label",
                                    featuresCol="features", maxMemoryInMB=1024)
    # One row per compound, read by the three fits: held only while fitting.
    held = labelled_features(features).where(~held_out()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[indexer, assembler, scaler, forest]).fit(held)
    finally:
        held.unpersist()


def score_profile_forest(model, features: DataFrame) -> DataFrame:
    """Predicted profile per compound next to its rule label, and whether it was held out from training."""
    from pyspark.ml.feature import IndexToString

    scored = model.transform(labelled_features(features))
    back = IndexToString(inputCol="prediction", outputCol="clinical_profile", labels=[*model.stages[0].labels, config.PROFILE_UNKNOWN])
    return back.transform(scored).select("pert_iname", *FEATURES, "rule_profile", "clinical_profile", held_out().alias("held_out"))


def profile_forest(features: DataFrame, trees: int = 100, seed: int = 42, max_depth: int = 30) -> DataFrame:
    """Random forest trained on four compounds in five and scored on all."""
    return score_profile_forest(fit_profile_forest(features, trees, seed, max_depth), features)


def forest_metrics(scored: DataFrame) -> DataFrame:
    """H4 of the forest, over the compounds it was not trained on."""
    return classification_metrics(scored.where("held_out"))


# H4
def classification_metrics(df: DataFrame, true_col: str = "rule_profile", pred_col: str = "clinical_profile") -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 (zero division → 0),
    all from the counts of each (true, predicted) pair, an exchange that both
    sides of the join reuse: the rows are made once."""
    pairs = df.groupBy(F.col(true_col).alias("t"), F.col(pred_col).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    hits = F.sum((F.col("t") == F.col("p")).cast("long") * F.col("n"))  # null where nothing compares
    support = pairs.groupBy(F.col("t").alias("label")).agg(F.sum("n").alias("support"), hits.alias("hits"))
    predicted = pairs.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    per = (support.join(predicted, "label", "full_outer").withColumn("tp", F.col("hits"))
           .select("label", "hits", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in ("support", "predicted", "tp")]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    out = per.agg(F.sum("support").alias("__n"), F.sum("hits").alias("__hit"), F.sum(F.col("support") * prec).alias("__wp"),
                  F.sum(F.col("support") * rec).alias("__wr"), F.sum(F.col("support") * f1).alias("__wf"))
    nn = F.col("__n")
    return out.select(F.round(F.try_divide(F.col("__hit"), nn), 6).alias("accuracy"),
                      F.round(F.try_divide(F.col("__wp"), nn), 6).alias("precision_weighted"),
                      F.round(F.try_divide(F.col("__wr"), nn), 6).alias("recall_weighted"),
                      F.round(F.try_divide(F.col("__wf"), nn), 6).alias("f1_weighted"))


# H5
def classify_clinical_profiles(features: DataFrame, use_ml: bool = True) -> DataFrame:
    """H5: the forest (trained eagerly here) or the rules; ``profile_source``
    says which. A failed fit falls back to the rules, as the reference does,
    with a warning; an empty feature frame is an error."""
    if any(c not in features.columns for c in ("pert_iname", "max_response", "biomarker_count")):
        raise ValidationError("feature frame lacks the profile columns")
    if features.isEmpty():
        raise ValidationError("feature frame is empty")
    if use_ml:
        try:
            return profile_forest(features).withColumn("profile_source", F.lit("forest"))
        except Exception as exc:
            warnings.warn(f"profile forest failed, rules used instead: {exc}", stacklevel=2)
    return profile_rules(features).withColumn("profile_source", F.lit("rules"))


# H6
def predict_response(gs: DataFrame, names: DataFrame) -> DataFrame:
    """Batch prediction for requested compounds over all their rows.

    Missing features become 0; a compound with no rows at all is 'Unknown'.
    """
    az = F.abs(F.nanvl(F.col("z_score"), F.lit(None).cast("double")))
    feats = gs.groupBy("pert_iname").agg(
        F.countDistinct("pr_gene_symbol").alias("biomarker_count"), F.round(F.avg(az), 6).alias("avg_response"),
        F.max(az).alias("max_response"), F.round(F.stddev_samp("z_score"), 6).alias("response_variability"))
    req = joined(names.select("pert_iname").distinct(), feats, "pert_iname", "left")
    filled = req.select("pert_iname", F.coalesce("biomarker_count", F.lit(0)).cast("long").alias("biomarker_count"),
                        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("avg_response", "max_response",
                                                                       "response_variability")])
    rule = profile_rule("max_response", "biomarker_count")
    return filled.withColumn("predicted_profile",
                             F.when(F.col("biomarker_count") == 0, F.lit(config.PROFILE_UNKNOWN)).otherwise(rule))


# H7
def profile_report(profiles: DataFrame, with_stamp: bool = True) -> DataFrame:
    """Profiles with a 0-based ``temporal_index`` by compound (and a generated-at stamp)."""
    out = sequence_index(profiles, ["pert_iname"], "temporal_index")
    if with_stamp:
        out = out.withColumn("report_generated_at", F.current_timestamp())
    return out
