"""The model graph: staging frames -> dimensions/facts -> marts.

``GRAPH`` declares every model once: its layer, what it reads (staging tables and models)
and how it is made from them. ``Models`` builds each model lazily once and reuses the same
DataFrame for every consumer, so a mart and the constraint suite share one plan per
model. ``replace`` swaps in a written copy: ``jobs.build_models`` writes each model to the
shared folder and continues from the written table, which cuts lineage between models
(the original pipeline materialises every model as a table).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidepool.operators import calendar
from tidepool.plans import dims, facts, graph, marts

# Fixture parameters: orders and line items fall in 1995-2001, events in 2024, so the
# declared calendar spans 1995-01-01 .. 2024-12-31; recency is measured as of 2002-01-01.
FIXTURE_CALENDAR_START = "1995-01-01"
FIXTURE_CALENDAR_DAYS = 10958
FIXTURE_AS_OF = "2002-01-01"


@dataclass(frozen=True)
class Model:
    """``build`` gets the run (session and parameters), then the frames of ``inputs`` in order."""
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


GRAPH: dict[str, Model] = {
    "dim_date": Model("warehouse", (), lambda run: dims.dim_date(run.spark, run.calendar_start, run.calendar_days)),
    "dim_customer": Model("warehouse", ("booking_groups", "transactions", "members"), lambda run, *frames: dims.dim_customer(*frames)),
    "dim_product": Model("warehouse", ("spa_products",), lambda run, products: dims.dim_product(products)),
    "dim_treatment": Model("warehouse", ("treatments",), lambda run, treatments: dims.dim_treatment(treatments)),
    "fact_transactions": Model("warehouse", ("transactions",), lambda run, transactions: facts.fact_transactions(transactions)),
    "fact_completed_items": Model("warehouse", ("completed_items",), lambda run, items: facts.fact_completed_items(items)),
    "fact_treatment_activities": Model("warehouse", ("booking_logs", "booking_groups"),
                                       lambda run, *frames: facts.fact_treatment_activities(*frames, run.hot_share)),
    "mart_revenue_daily": Model("mart", ("fact_transactions", "dim_date"), lambda run, *frames: marts.mart_revenue_daily(*frames)),
    "mart_customer_analytics": Model("mart", ("dim_customer", "fact_transactions"),
                                     lambda run, *frames: marts.mart_customer_analytics(*frames, run.as_of)),
    "mart_operations_booking": Model("mart", ("fact_treatment_activities", "booking_logs", "dim_date"),
                                     lambda run, *frames: marts.mart_operations_booking(*frames, run.hot_share)),
    "mart_product_analytics": Model("mart", ("dim_product", "fact_completed_items"), lambda run, *frames: marts.mart_product_analytics(*frames)),
    "mart_treatment_analytics": Model("mart", ("dim_treatment", "fact_treatment_activities"),
                                      lambda run, *frames: marts.mart_treatment_analytics(*frames)),
}
INPUTS: dict[str, tuple[str, ...]] = {name: model.inputs for name, model in GRAPH.items()}
LAYER_OF: dict[str, str] = {name: model.layer for name, model in GRAPH.items()}

WAREHOUSE_MODELS = [name for name, model in GRAPH.items() if model.layer == "warehouse"]
MART_MODELS = [name for name, model in GRAPH.items() if model.layer == "mart"]
ALL_MODELS = WAREHOUSE_MODELS + MART_MODELS


def selected(terms=None, exclude=()) -> list[str]:
    """The models that ``terms`` select (see ``graph``), each after what it reads."""
    return graph.select(INPUTS, LAYER_OF, terms, exclude)


@dataclass
class Models:
    """``calendar_start`` / ``calendar_days`` declare the calendar. A fact dated outside
    it has no calendar date, which is what the not_null test on the marts' dates finds.
    ``hot_share`` salts the joins of the bookings (J1, J4) for keys above that share of the
    rows; None leaves hot keys to adaptive execution. The customers' join (J2) has one left
    row per phone, so there is nothing to spread."""
    spark: SparkSession
    staging: Mapping[str, DataFrame]
    calendar_start: str = calendar.DEFAULT_START
    calendar_days: int = calendar.DEFAULT_DAYS
    as_of: str = "2030-01-01"
    hot_share: float | None = None
    _built: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            model = GRAPH[name]
            self._built[name] = model.build(self, *[self[i] if i in GRAPH else self.staging[i] for i in model.inputs])
        return self._built[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Swap in a materialised copy; later consumers read it instead of recomputing."""
        self._built[name] = df


def fixture_models(spark: SparkSession, staging: Mapping[str, DataFrame]) -> Models:
    return Models(spark, staging, FIXTURE_CALENDAR_START, FIXTURE_CALENDAR_DAYS, FIXTURE_AS_OF)
