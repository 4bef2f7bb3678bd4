"""Links that go with an alert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encoded(value: Column) -> Column:
    """URL-encoded text with %20 for blanks."""
    return F.replace(F.url_encode(value.cast("string")), F.lit("+"), F.lit("%20"))


def query_link(base: str, params: dict[str, Column]) -> Column:
    pieces = [F.concat(F.lit(f"{name}="), encoded(value)) for name, value in params.items()]
    return F.concat(F.lit(f"{base}?"), F.concat_ws("&", *pieces))


def dashboard_event(event: Column) -> Column:
    """Tag name as the dashboards know it."""
    return (F.when(event == "itempageview", "product")
            .when(event == "homepage", "page").otherwise(event))
