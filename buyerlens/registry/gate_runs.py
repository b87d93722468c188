"""The gate run end to end: candidates measured, scored into a store, read back, judged and tagged."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.operators import gates, preprocess, quality, selection
from buyerlens.operators.clustering import CentroidModel
from buyerlens.oracle_base import AS_OF, SOURCES
from buyerlens.plans import feature_table as plan
from buyerlens.plans import training
from buyerlens.registry import register
from buyerlens.registry.given import CENTRES, given_model
from buyerlens.registry.models import _CENTRES, _DB, _SQUARED, ONE_PERIOD
from buyerlens.session import checkpointed, scratch_path
from buyerlens.sources import adapters
from buyerlens.sources.versions import VersionedTable

#: What is measured elsewhere and given here: agreement of subsamples, and a champion for one candidate.
ARI = 0.9
CHAMPION = (0.95, 0.05)

_Z = ", ".join(f"z_{c}" for c in [*preprocess.LOG_COLUMNS, *[c for c in preprocess.FEATURE_COLUMNS if c not in preprocess.LOG_COLUMNS]])
_TWO = f"list_transform({CENTRES[:2]}::DOUBLE[][], lambda c: list_distance(c, [{_Z}]))"


def _measured(name: str, label: str) -> str:
    return f"""{name} AS (WITH pts AS (SELECT customer_unique_id AS vec_id, {label} AS label, [{_Z}] AS v FROM assigned), {_CENTRES}, {_DB}, {_SQUARED},
  n AS (SELECT count(*) AS size FROM pts GROUP BY label)
  SELECT (SELECT silhouette FROM sil) AS sil, (SELECT avg(w) FROM worst) AS db, (SELECT count(*) FROM n) AS k,
    (SELECT min(size) FROM n) AS least, (SELECT min(size) / sum(size) FROM n) AS share, (SELECT count(*) FROM pts) AS n)"""


_RUNS = f"""WITH {ONE_PERIOD}, {_measured("four", "segment_id")}, {_measured("two", f"list_position({_TWO}, list_min({_TWO})) - 1")},
run AS (
  SELECT 'plain' AS version, *, {ARI}::DOUBLE AS ari, NULL::DOUBLE AS cs, NULL::DOUBLE AS cd, true AS sig, true AS stored FROM four
  UNION ALL SELECT 'lost store', *, {ARI}, NULL, NULL, true, false FROM four
  UNION ALL SELECT 'beaten', *, {ARI}, {CHAMPION[0]}, {CHAMPION[1]}, true, true FROM four
  UNION ALL SELECT 'two clusters', *, {ARI}, NULL, NULL, true, true FROM two
  UNION ALL SELECT 'refuses', NULL, NULL, 0, 0, 0.0, n, -1.0, NULL, NULL, false, false FROM four),
judged AS (
  SELECT version, true AS data_failure, concat('rows=', n) AS d1,
    coalesce(sil, -1) >= 0.2 AND (cs IS NULL OR (cs - sil <= 0.05 AND db - cd <= 0.4)) AS metric_regression,
    CASE WHEN cs IS NULL THEN printf('sem champion prévio; silhouette=%.3f (min 0.2)', coalesce(sil, -1))
      ELSE printf('sil %.3f vs champion %.3f (drop=%.3f); db Δ=%.3f', sil, cs, cs - sil, db - cd) END AS d2,
    least >= 20 AND share >= 0.002 AND k BETWEEN 3 AND 10 AND ari >= 0.5 AS unstable_or_empty_clusters,
    printf('k=%d min_size=%d min_share=%.4f ari=%.3f', k, least, share::DOUBLE, ari::DOUBLE) AS d3,
    sig AS signature_incompatible, CASE WHEN sig THEN 'ok' ELSE 'failed' END AS d4,
    stored AS integration_failure, CASE WHEN stored THEN concat('scores rows=', n) ELSE 'failed' END AS d5,
    sig AS smoke, CASE WHEN sig THEN 'ok' ELSE 'smoke: predição vazia ou não finita' END AS d6 FROM run),
failed AS (
  SELECT *, list_filter([CASE WHEN NOT data_failure THEN 'data_failure' END, CASE WHEN NOT metric_regression THEN 'metric_regression' END,
    CASE WHEN NOT unstable_or_empty_clusters THEN 'unstable_or_empty_clusters' END, CASE WHEN NOT signature_incompatible THEN 'signature_incompatible' END,
    CASE WHEN NOT integration_failure THEN 'integration_failure' END], lambda x: x IS NOT NULL) AS f FROM judged),
tags AS (
  SELECT version, unnest([
    {{'tag': 'decision', 'value': CASE WHEN len(f) = 0 THEN 'approved' ELSE 'rejected' END}},
    {{'tag': 'approved', 'value': CASE WHEN len(f) = 0 THEN 'true' ELSE 'false' END}},
    {{'tag': 'blocking_failed', 'value': concat('[', list_aggregate(list_transform(f, lambda x: concat('"', x, '"')), 'string_agg', ', '), ']')}},
    {", ".join(f"{{'tag': '{name}', 'value': CASE WHEN {name} THEN 'pass' ELSE 'fail' END}}, {{'tag': '{name}_detail', 'value': d{i}}}"
               for i, name in enumerate(["data_failure", "metric_regression", "unstable_or_empty_clusters", "signature_incompatible", "integration_failure", "smoke"], 1))}]) AS t FROM failed)
SELECT version AS model_version, concat('quality_gate_', t.tag) AS tag, t.value AS value, '1.0.0' AS feature_set_version, '{AS_OF}' AS as_of_date FROM tags"""


@register("quality_gate_run", _RUNS)
def quality_gate_run(spark, sf_dir) -> DataFrame:
    """Five candidates with all their tags: one as given, one whose store fails, one beaten by its champion, one
    of too few clusters and one that does not take the features. Texts of errors and paths are left out."""
    features = checkpointed(plan.feature_table(adapters.retail(spark, sf_dir), AS_OF))
    model, path = given_model(features), scratch_path(spark)
    prepared = model.preprocessor
    odd = replace(prepared, linear_columns=[*prepared.linear_columns, "shoe_size"], medians={**prepared.medians, "shoe_size": 0.0},
                  means={**prepared.means, "shoe_size": 0.0}, stds={**prepared.stds, "shoe_size": 1.0})
    # a file where the folder of the store should be
    spark.range(1).write.parquet(f"{path}/file")
    taken = [name for name in spark.read.parquet(f"{path}/file").inputFiles()][0]
    champions = spark.createDataFrame([(model.name, *CHAMPION)], "model_name string, silhouette double, davies_bouldin double")
    runs = {
        "plain": (model, f"{path}/plain", None), "lost store": (model, taken, None), "beaten": (model, f"{path}/beaten", champions),
        "two clusters": (replace(model, clusters=CentroidModel(prepared.outputs, CENTRES[:2])), f"{path}/two", None),
        "refuses": (replace(model, preprocessor=odd), f"{path}/odd", None),
    }
    rows = []
    for version, (candidate, probe, known) in runs.items():
        given = {} if version == "refuses" else {"stability_ari_subsample": ARI}
        judged = training.run_quality_gates(features, replace(candidate, version=version), probe, known, metrics=given)
        rows.append(gates.gate_tags(judged, ["model_version"]))
    tags, value, tag = reduce(DataFrame.unionByName, rows), F.col("value"), F.col("tag")
    plain = F.when(tag.endswith("integration_failure_detail"), F.when(
        value.startswith("scores uri="), F.regexp_replace(value, "uri=\\S+ ", "")).otherwise("failed")).when(
        tag.endswith("signature_incompatible_detail") & (value != "ok"), "failed").otherwise(value)
    lineage = selection.with_lineage(tags.withColumn("value", plain), "1.0.0", AS_OF, path, "")
    return lineage.drop("features_uri", "parent_run_id")


@register("write_read_stored", f"""WITH {SOURCES}
SELECT stage, (SELECT count(*) FROM item_src) AS n, true AS reconciled FROM (VALUES ('input'), ('committed'), ('reloaded')) v(stage)""")
def write_read_stored(spark, sf_dir):
    """The raw items, as counted by the write that stored them, and as read back."""
    items = adapters.order_items(spark, sf_dir)
    store = VersionedTable(spark, scratch_path(spark), items.schema, "order_items")
    commit = store.write(items, AS_OF)
    return quality.reconcile_counts({
        "input": items, "committed": spark.range(commit["row_count"]), "reloaded": store.read(store.snapshot().newest)})
