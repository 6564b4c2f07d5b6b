"""The tables of one lakehouse: named SQL views and the callable tools over them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flightlake.constants import DEFAULT_DAYS_BACK, DEFAULT_TOP_K
from flightlake.operators import facts, logs, views
from flightlake.plans.questions import search_requests


@dataclass
class Warehouse:
    """Tables by role; one that does not exist yet is None.

    ``documents`` carries embeddings made by ``embed_documents``. ``as_of``
    is the day the look-back windows end on.
    """

    spark: SparkSession
    documents: DataFrame
    as_of: dt.date
    silver: DataFrame | None = None
    gold: DataFrame | None = None
    run_log: DataFrame | None = None

    @property
    def routes(self) -> DataFrame | None:
        return None if self.silver is None else views.route_risk(self.silver)

    def views(self) -> dict[str, DataFrame]:
        """Every view whose tables exist, under the name dashboards and SQL use."""
        found = {"ai_rag_documents": self.documents}
        if self.silver is not None:
            found["silver_flights_ext"] = self.silver
            found["ai_delay_explanations_v"] = views.delay_explanations(self.silver)
            found["ai_route_risk_v"] = self.routes
        if self.gold is not None:
            found["gold_summary_ext"] = self.gold
            found["bi_airline_performance_v"] = views.bi_airline_performance(self.gold)
            found["bi_route_performance_v"] = views.bi_route_performance(self.gold)
            found["bi_daily_delays_v"] = views.bi_daily_delays(self.gold)
            found["bi_pipeline_refresh_v"] = views.gold_refresh(self.gold)
        if self.silver is not None and self.gold is not None:
            found["ai_nl_analytics_facts_v"] = views.nl_facts(
                found["ai_route_risk_v"], found["bi_airline_performance_v"]
            )
        if self.run_log is not None:
            found["monitoring_token_usage_v"] = logs.token_usage_rows(self.run_log)
            found["monitoring_guardrails_v"] = logs.guardrail_rows(self.run_log)
        return found

    def register(self) -> list[str]:
        """Make the views available to ``spark.sql`` in this session."""
        found = self.views()
        for name, rows in found.items():
            rows.createOrReplaceTempView(name)
        return sorted(found)

    def search_flight_records(self, question: str, top_k: int = DEFAULT_TOP_K) -> DataFrame:
        asked = self.spark.createDataFrame(
            [(1, question, top_k)], "request_id bigint, question string, top_k int"
        )
        return search_requests(asked, self.documents).drop("request_id")

    def query_analytics(
        self, query_type: str, airline: str = "", route: str = "", days_back: int = DEFAULT_DAYS_BACK
    ) -> DataFrame:
        return facts.query_analytics(
            query_type, self.documents, self.silver, self.routes, self.as_of, airline, route, days_back
        )

    def query_facts(
        self,
        query_type: str,
        airline: str | None = None,
        route: str | None = None,
        days_back: int = DEFAULT_DAYS_BACK,
    ) -> DataFrame:
        """The service's facts when a search finds too little."""
        return facts.service_facts(
            query_type, self.documents, self.silver, self.routes, self.as_of, airline, route, days_back
        )

    def get_status(self) -> DataFrame:
        return facts.freshness_status(self.gold, self.documents)

    def check_health(self) -> DataFrame:
        return facts.freshness_status(self.gold, self.documents, brief=True)

    def detect_delay_risk(
        self, airline: str = "", route: str = "", days_back: int = DEFAULT_DAYS_BACK
    ) -> DataFrame:
        return facts.delay_risk(self.documents, self.as_of, airline, route, days_back)

    def detect_weather_impact(
        self, airline: str = "", days_back: int = DEFAULT_DAYS_BACK
    ) -> DataFrame:
        return facts.weather_impact(self.documents, self.as_of, airline, days_back)
