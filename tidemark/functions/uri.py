"""Page type and product id of a request path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
POST_PURCHASE_ROOTS = ("cancel", "return")


def uri_parts(uri: Column) -> Column:
    """Non-empty path segments, still percent-encoded."""
    return F.filter(F.split(uri, "/"), lambda part: part != "")


def _decoded(part: Column) -> Column:
    # url_decode reads '+' as a blank, which a path does not; a malformed escape leaves the text as it is.
    return F.coalesce(F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))), part)


def page_type(uri: Column) -> Column:
    root = _decoded(F.get(uri_parts(uri), F.lit(0)))
    return (
        F.when(uri.isNull() | (uri == ""), "unknown")
        .when(root.isNull(), "home")
        .when(root.isin(*POST_PURCHASE_ROOTS), "post_purchase")
        .otherwise(root)
    )


def uri_product_id(uri: Column) -> Column:
    parts = uri_parts(uri)
    number = _decoded(F.get(parts, F.lit(1)))
    return F.when(
        (_decoded(F.get(parts, F.lit(0))) == "product") & number.rlike("^[0-9]+$"), number.try_cast("bigint")
    )
