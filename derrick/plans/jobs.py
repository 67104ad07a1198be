"""The jobs a scheduler calls: read from one store, write to another."""

from __future__ import annotations

from derrick.plans import failure_risk, features, marts, production_model, views
from derrick.schemas import TABLES
from derrick.sources.export import export_all
from derrick.sources.scratch import materialize, scratch_scope
from derrick.sources.stores import Store, reconcile_content, replace_counted, replace_verified

MARTS = ("mart_production", "mart_failures", "mart_logistics", "mart_ml_dataset")


def run_export(source: Store, target_root: str, refresh: str = "days") -> dict[str, bool]:
    """All source tables to a Parquet lake."""
    return export_all(source, target_root, refresh=refresh)


def run_features(source: Store, *targets: Store) -> dict[str, int]:
    """Daily and per-well features, to one target or to several copies."""
    counts = {}
    with scratch_scope(source.spark):
        daily = materialize(
            features.features_daily(
                source.read("production"), source.read("telemetry"), source.read("wells")
            ),
            "features-daily",
        )
        tables = {"features_daily": daily, "features_by_well": features.features_by_well(daily)}
        for target in targets:
            for name, df in tables.items():
                counts[name] = replace_counted(target, name, df)
    return counts


def run_marts(source: Store, target: Store) -> dict[str, int]:
    """The four marts; a table whose content reads back other than written is an error."""
    t = {name: source.read(name) for name in TABLES}
    tables = {
        "mart_production": marts.mart_production(t["production"], t["wells"], t["telemetry"]),
        "mart_failures": marts.mart_failures(t["pump_sensors"], t["pump_failures"]),
        "mart_logistics": marts.mart_logistics(t["deliveries"]),
        "mart_ml_dataset": marts.mart_ml_dataset(t["well_targets"], t["wells"]),
    }
    written = {name: replace_verified(target, name, df) for name, df in tables.items()}
    lost = [r["table_name"] for r in reconcile_content(target, written).filter("not matches").collect()]
    if lost:
        raise RuntimeError(f"rows read back differ from rows written: {lost}")
    return {name: seen.rows for name, seen in written.items()}


def run_ml_dataset(source: Store, target: Store) -> int:
    return replace_counted(target, "ml_dataset", marts.ml_dataset(source.read("well_targets")))


def run_production_model(target: Store, **options) -> dict[str, int]:
    """Train on ``ml_dataset``; options as in ``train_production_model``."""
    with scratch_scope(target.spark):
        made = production_model.train_production_model(target.read("ml_dataset"), **options)
        return {
            "ml_predictions": replace_counted(target, "ml_predictions", made.predictions),
            "ml_metrics": replace_counted(target, "ml_metrics", made.metrics),
        }


def run_failure_model(source: Store, target: Store, **options) -> dict[str, int]:
    """Anomalies, daily risk and metrics; options as in ``train_failure_model``."""
    with scratch_scope(source.spark):
        made = failure_risk.train_failure_model(
            source.read("pump_sensors"), source.read("pump_failures"), **options
        )
        # The daily table reads the written anomalies instead of scoring again.
        counts = {
            "mart_pump_anomalies": replace_counted(target, "mart_pump_anomalies", made.anomalies)
        }
        daily = failure_risk.pump_risk_daily(target.read("mart_pump_anomalies"))
        counts["mart_pump_risk_daily"] = replace_counted(target, "mart_pump_risk_daily", daily)
        counts["ml_failure_metrics"] = replace_counted(target, "ml_failure_metrics", made.metrics)
    return counts


def run_views(source: Store, target: Store) -> list[str]:
    """Register all views whose tables exist; run it again after a rebuild."""
    needed = {table for table, _ in views.VIEWS.values() if table not in views.VIEWS}
    tables = {n: target.read(n) for n in needed if n not in TABLES and target.exists(n)}
    tables |= {n: source.read(n) for n in needed if n in TABLES and source.exists(n)}
    return views.register_views(tables)
