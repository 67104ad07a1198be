"""The 17 BI datasets. Names and columns are the contract of the dashboards."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions import band, per_unit, round_half_up
from derrick.operators.aggregates import service_kpi
from derrick.operators.ranking import dense_row_id, top_n
from derrick.schemas import as_measures
from derrick.sources.catalog import ViewGraph


def daily_production(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("date")
        .agg(
            round_half_up(F.sum("oil_tons")).alias("total_oil_tons"),
            round_half_up(F.avg("oil_tons")).alias("avg_oil_tons"),
        )
        .orderBy(F.col("date").asc_nulls_last())
    )


def _highest_first(df: DataFrame, measure: str, key: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc_nulls_first(), F.col(key).asc_nulls_last())


def well_kpi(mart: DataFrame) -> DataFrame:
    kpi = mart.groupBy("well_id", "well_name").agg(
        round_half_up(F.avg("oil_tons")).alias("avg_oil_tons"),
        round_half_up(F.avg("downtime_pct")).alias("downtime_percent"),
        round_half_up(F.avg("avg_pressure")).alias("avg_pressure"),
        round_half_up(F.avg("avg_temperature")).alias("avg_temperature"),
    )
    return _highest_first(kpi, "avg_oil_tons", "well_id")


def best_wells(kpi: DataFrame) -> DataFrame:
    return top_n(kpi, "avg_oil_tons", ["well_id"], 5, largest=True)


def worst_wells(kpi: DataFrame) -> DataFrame:
    return top_n(kpi, "avg_oil_tons", ["well_id"], 5, largest=False)


def pressure_temperature(mart: DataFrame) -> DataFrame:
    groups = band("avg_pressure", [(90, "low"), (110, "medium")], "high")
    return mart.select(
        "date",
        "well_id",
        "well_name",
        "avg_pressure",
        "avg_temperature",
        "oil_tons",
        groups.alias("pressure_group"),
    )


def line_chart(daily: DataFrame) -> DataFrame:
    return daily.select("date", "total_oil_tons").orderBy(F.col("date").asc_nulls_last())


def bar_chart(kpi: DataFrame) -> DataFrame:
    """All wells, highest first."""
    chart = kpi.select("well_name", "avg_oil_tons", "downtime_percent")
    return _highest_first(chart, "avg_oil_tons", "well_name")


def heatmap(mart: DataFrame) -> DataFrame:
    cells = {
        "pressure_bucket": round_half_up("avg_pressure", 0),
        "temperature_bucket": round_half_up("avg_temperature", 0),
    }
    return (
        mart.groupBy(*(c.alias(n) for n, c in cells.items()))
        .agg(round_half_up(F.avg("oil_tons")).alias("avg_oil_tons"))
        .orderBy(*(F.col(n).asc_nulls_last() for n in cells))
    )


def ml_predictions(predictions: DataFrame) -> DataFrame:
    return dense_row_id(predictions, ["production_date", "well_id"]).select(
        "id",
        "well_id",
        "production_date",
        "actual",
        "predicted",
        "error",
        "avg_pressure",
        "avg_temperature",
        "avg_power",
        "avg_pump_hours",
    )


def ml_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select("model_name", "mae", "rmse")


def pump_anomalies_time(anomalies: DataFrame) -> DataFrame:
    return anomalies.select(
        "sensor_datetime",
        "sensor_date",
        "pump_id",
        "well_id",
        "vibration",
        "temperature",
        "current_amp",
        "rpm",
        "zscore_max",
        "is_zscore_anomaly",
        "is_isolation_anomaly",
        "risk_score",
        "failure_probability",
    )


def vibration_before_failure(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter(F.col("failure_next_7d") == 1).select(
        "sensor_datetime",
        "sensor_date",
        "pump_id",
        "well_id",
        "vibration",
        "failure_next_7d",
        "risk_score",
    )


def pump_risk_score(daily: DataFrame) -> DataFrame:
    return daily.select(
        "sensor_date",
        "pump_id",
        "well_id",
        "avg_vibration",
        "avg_temperature",
        "avg_current_amp",
        "avg_rpm",
        "anomalies_count",
        "avg_risk_score",
        "max_risk_score",
        "failure_probability",
    )


def weather_delay(deliveries: DataFrame) -> DataFrame:
    kpi = service_kpi(
        deliveries,
        "weather",
        means={"avg_delay_hours": "delay_hours"},
        maxima={"max_delay_hours": "delay_hours"},
        ratios={},
        sums={},
    )
    return _highest_first(kpi, "avg_delay_hours", "weather")


def cost_distance(deliveries: DataFrame) -> DataFrame:
    cost = per_unit(F.col("cost_rub").cast("double"), "distance_km")
    return as_measures(deliveries).select(
        "delivery_id",
        "delivery_date",
        "route",
        "driver",
        "weather",
        "distance_km",
        "volume_tons",
        "cost_rub",
        "delay_hours",
        round_half_up(cost).alias("cost_per_km"),
    )


def driver_kpi(deliveries: DataFrame) -> DataFrame:
    return service_kpi(
        deliveries,
        "driver",
        means={"avg_delay_hours": "delay_hours", "avg_delivery_cost_rub": "cost_rub"},
        maxima={"max_delay_hours": "delay_hours"},
        ratios={"avg_cost_per_km": ("cost_rub", "distance_km")},
        sums={"total_volume_tons": "volume_tons"},
    ).orderBy(F.col("avg_delay_hours").asc_nulls_last(), F.col("driver").asc_nulls_last())


def route_analytics(deliveries: DataFrame) -> DataFrame:
    kpi = service_kpi(
        deliveries,
        "route",
        means={
            "avg_distance_km": "distance_km",
            "avg_delay_hours": "delay_hours",
            "avg_cost_rub": "cost_rub",
        },
        maxima={"max_delay_hours": "delay_hours"},
        ratios={"avg_cost_per_km": ("cost_rub", "distance_km")},
        sums={"total_volume_tons": "volume_tons"},
    )
    return _highest_first(kpi, "avg_delay_hours", "route")


# View name -> (the table or view it reads, how it is made). A view over a view
# comes after it.
VIEWS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "vw_daily_production": ("mart_production", daily_production),
    "vw_well_kpi": ("mart_production", well_kpi),
    "vw_best_wells": ("vw_well_kpi", best_wells),
    "vw_worst_wells": ("vw_well_kpi", worst_wells),
    "vw_pressure_temperature_analysis": ("mart_production", pressure_temperature),
    "vw_line_chart_production": ("vw_daily_production", line_chart),
    "vw_bar_chart_top_wells": ("vw_well_kpi", bar_chart),
    "vw_heatmap_pressure_debit": ("mart_production", heatmap),
    "vw_ml_predictions": ("ml_predictions", ml_predictions),
    "vw_ml_metrics": ("ml_metrics", ml_metrics),
    "vw_pump_anomalies_time": ("mart_pump_anomalies", pump_anomalies_time),
    "vw_vibration_before_failure": ("mart_pump_anomalies", vibration_before_failure),
    "vw_pump_risk_score": ("mart_pump_risk_daily", pump_risk_score),
    "vw_logistics_weather_delay": ("deliveries", weather_delay),
    "vw_logistics_cost_distance": ("deliveries", cost_distance),
    "vw_driver_kpi": ("deliveries", driver_kpi),
    "vw_route_analytics": ("deliveries", route_analytics),
}


def build_views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every view whose table is given."""
    known = dict(tables)
    made = {}
    for name, (source, build) in VIEWS.items():
        if source in known:
            made[name] = known[name] = build(known[source])
    return made


def view_graph(tables: Mapping[str, DataFrame]) -> ViewGraph:
    """The views whose table is given, with their dependencies, not registered yet."""
    graph = ViewGraph(dict(tables))
    for name, (source, build) in VIEWS.items():
        if source in graph.tables or source in graph.views:
            graph.define(name, [source], build)
    return graph


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Register the tables and their views in the session catalog; the views' names."""
    graph = view_graph(tables)
    graph.create()
    return list(graph.views)
