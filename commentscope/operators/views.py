"""Presentation views over finished reports.

A view is stated once, as SQL expressions over the report's columns. It is read as a DataFrame,
registered for a session, or created in the catalog, where it stays.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    DAY_NAMES,
    NEGATIVE_CLASS,
    POSITIVE_CLASS,
    RANKING_NEUTRAL_CLASS,
)


@dataclass(frozen=True)
class View:
    """A view: its name, the report it shows, its columns as SQL, and which rows in what order."""

    name: str
    table: str
    columns: Mapping[str, str]
    where: str = "true"
    order: tuple[str, ...] = ()

    def over(self, report: DataFrame) -> DataFrame:
        """The view over a given report."""
        rows = report.where(self.where).selectExpr(*self._selected())
        order = [F.desc(o.removesuffix(" DESC")) if o.endswith(" DESC") else F.asc(o) for o in self.order]
        return rows.orderBy(*order) if order else rows

    def statement(self, database: str) -> str:
        """DDL that creates the view over the table of its report, or replaces it at once."""
        order = f" ORDER BY {', '.join(self.order)}" if self.order else ""
        return (
            f"CREATE OR REPLACE VIEW {database}.{self.name} AS "
            f"SELECT {', '.join(self._selected())} FROM {database}.{self.table} "
            f"WHERE {self.where}{order}"
        )

    def _selected(self) -> list[str]:
        return [f"{sql} AS {name}" for name, sql in self.columns.items()]


# Name, report and columns of each view.
HEATMAP = View(
    "view_heatmap_semanal",
    "patrones_horarios",
    {
        "dia_nombre": "CASE dia_semana "
        + " ".join(f"WHEN {n} THEN '{day}'" for n, day in DAY_NAMES.items())
        + " END",
        "dia_semana": "dia_semana",
        "hora": "hora",
        "intensidad_actividad": "volumen",
        "sentimiento": "sentiment_promedio",
    },
)

ALERTS = View(
    "view_alertas_recientes",
    "anomalias",
    {
        "periodo": "periodo",
        "tipo_anomalia": "es_anomalia",
        "volumen": "volumen",
        "sentiment_promedio": "sentiment_promedio",
    },
    order=("periodo DESC",),
)


def ranking(more_than: int = 50, sentiment_cut: float = 0.2) -> View:
    """Communities with more than `more_than` comments, largest first, with a sentiment label."""
    label = (
        f"CASE WHEN sentiment_promedio > {sentiment_cut}D THEN '{POSITIVE_CLASS}' "
        f"WHEN sentiment_promedio < -{sentiment_cut}D THEN '{NEGATIVE_CLASS}' "
        f"ELSE '{RANKING_NEUTRAL_CLASS}' END"
    )
    return View(
        "view_ranking_subreddits",
        "comparativa_subreddits",
        {
            "subreddit_name": "subreddit_name",
            "total_comentarios": "total_comentarios",
            "sentiment_promedio": "sentiment_promedio",
            "etiqueta_sentimiento": label,
            "velocidad_actividad": "comentarios_por_dia",
        },
        where=f"total_comentarios > {more_than}",
        order=("total_comentarios DESC", "subreddit_name"),
    )


VIEWS = {view.table: view for view in (HEATMAP, ranking(), ALERTS)}
VIEW_NAMES = {table: view.name for table, view in VIEWS.items()}


def weekly_heatmap(pattern: DataFrame) -> DataFrame:
    """Hourly pattern for a heat map; an unknown day has no name."""
    return HEATMAP.over(pattern)


def community_ranking(
    comparison: DataFrame, *, more_than: int = 50, sentiment_cut: float = 0.2
) -> DataFrame:
    """Communities with more than `more_than` comments, largest first, with a sentiment label."""
    return ranking(more_than, sentiment_cut).over(comparison)


def recent_alerts(anomalies: DataFrame) -> DataFrame:
    """Alerts, newest first."""
    return ALERTS.over(anomalies)


def register_views(results: Mapping[str, DataFrame]) -> list[str]:
    """Register the views of those reports that are given, for this session only; returns their
    names."""
    names = []
    for table, view in VIEWS.items():
        if table in results:
            view.over(results[table]).createOrReplaceTempView(view.name)
            names.append(view.name)
    return names


def create_views(spark: SparkSession, database: str) -> list[str]:
    """Create the views of those reports that are tables or views of `database`, in its catalog;
    returns their full names.

    The catalog keeps them for other sessions and, if it is a metastore, beyond the application.
    They follow their tables: a report published later shows without creating them again.
    """
    names = []
    for table, view in VIEWS.items():
        if spark.catalog.tableExists(f"{database}.{table}"):
            spark.sql(view.statement(database))
            names.append(f"{database}.{view.name}")
    return names
