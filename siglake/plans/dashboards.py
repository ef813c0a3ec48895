"""The dashboard panels as Spark SQL over the serving tables.

Users of the platform asked their questions as SQL against five tables. The
statements are written from the panels' titles (``serving.PANELS``), so they
and the DataFrame panels cannot drift apart; ``recent_*`` adds ``event_id`` as
a tie-break in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siglake.plans.serving import PANELS, PanelSpec
from siglake.sinks.tables import has_table, read_serving

RECENT_ROWS = 50


def panel_statements(spec: PanelSpec) -> dict[str, str]:
    """``panel name -> SQL`` of one serving table."""
    t = spec.table

    def grouped(column: str, title: str) -> str:
        return f"SELECT {column} AS {title}, count(*) AS count FROM {t} GROUP BY {column}"

    titles = ", ".join(f"{c} AS `{title}`" for c, title in spec.recent_cols.items())
    return {
        f"total_{t}": f"SELECT count(*) AS {spec.total_alias} FROM {t}",
        f"{t}_by_severity": grouped("severity_clean", spec.severity_alias),
        **{f"{t}_by_{title}": grouped(column, title) for column, title in spec.dims.items()},
        f"{t}_hourly": f"SELECT date_trunc('hour', event_timestamp) AS time, count(*) AS {spec.hourly_alias} "
                       f"FROM {t} GROUP BY ALL ORDER BY time",
        f"recent_{t}": f"SELECT {titles} FROM {t} ORDER BY event_timestamp DESC NULLS LAST, event_id DESC NULLS LAST "
                       f"LIMIT {RECENT_ROWS}",
    }


PANEL_SQL = {name: sql for spec in PANELS.values() for name, sql in panel_statements(spec).items()}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Register serving tables (``table name -> DataFrame``) as temp views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_serving(spark: SparkSession, output: str, since=None, until=None) -> list[str]:
    """Register the tables that ``materialize`` or the streams wrote under ``output``; their names.

    With ``since`` / ``until`` the views hold the events of that time alone, and only ids of its dates are folded.
    It is an error if there is none. A table that nothing has been written to yet is left out.
    """
    found = {t: read_serving(spark, output, t, since=since, until=until) for t in PANELS if has_table(spark, output, t)}
    if not found:
        raise FileNotFoundError(f"no serving table under {output}")
    register_views(found)
    return sorted(found)


def run_panel(spark: SparkSession, name: str) -> DataFrame:
    """One dashboard statement over the registered views."""
    return spark.sql(PANEL_SQL[name])
